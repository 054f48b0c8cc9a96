"""Plan shape: shredding is one narrow stage, the discriminator filter runs
before the payload parse, the wide payload is parsed once, scans are pruned."""

from docshred.operators.shredder import shred
from docshred.plans.clinical import spec_by_name
from docshred.sources.documents import read_documents, stage_documents
from tests.test_shred import DICTS, HAPPY


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_shred_has_no_shuffle(spark, write_lines):
    docs = read_documents(spark, write_lines([HAPPY]))
    for name in ("patientInfo", "diagnoses", "payors", "discharge", "Contacts", "mds"):
        plan = _plan(shred(docs, spec_by_name(name), DICTS))
        # AQE wraps a plan only when it has an exchange (shuffle or broadcast)
        assert "Exchange" not in plan and "AdaptiveSparkPlan" not in plan, name


def test_discriminator_filter_below_payload_parse(spark, write_lines, tmp_path):
    docs = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "p"))
    plan = _optimized(shred(docs, spec_by_name("oasis"), DICTS))
    lines = plan.splitlines()
    parse = max(i for i, ln in enumerate(lines) if "from_json" in ln)
    filt = max(i for i, ln in enumerate(lines) if "Filter" in ln and "oasis" in ln)
    assert filt > parse            # deeper in the tree = evaluated first
    assert len([ln for ln in lines if "from_json" in ln]) == 1


def test_scan_reads_only_needed_sections(spark, write_lines, tmp_path):
    staged = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "s"))
    plan = _plan(shred(staged, spec_by_name("diagnoses")))
    schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    text = " ".join(schema)
    assert "diagnoses" in text and "assessments" not in text and "demographics" not in text


def test_wide_dedup_shuffles_text_not_struct(spark, write_lines):
    from docshred.operators.combine import drop_complete_duplicates
    docs = read_documents(spark, write_lines([HAPPY]))
    plan = _optimized(drop_complete_duplicates(shred(docs, spec_by_name("oasis"), DICTS, widen=False)))
    agg = [ln for ln in plan.splitlines() if "Aggregate" in ln][0]
    keys = agg.split("Aggregate [", 1)[1].split("]", 1)[0]
    assert "_items_json" in keys and "_items#" not in keys   # grouped by the text, not the struct
    assert "StructsToJson" in plan or "to_json" in plan   # Spark 4 prints to_json as its evaluator


def test_checks_do_not_read_wide_payloads(spark, write_lines, tmp_path):
    import contextlib
    import io

    from docshred.operators.shredder import keys_only
    staged = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "k"))
    df = keys_only(staged, spec_by_name("mds")).groupBy().count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    schema = [ln for ln in buf.getvalue().splitlines() if "ReadSchema" in ln]
    assert schema and "assessmentData" not in " ".join(schema)
    assert keys_only(staged, spec_by_name("oasis")).count() == 1


def test_dedup_collapses_hot_group_of_copies_map_side(spark, write_lines):
    """A third (here: most) of all rows are copies of one document: the partial
    aggregate before the shuffle turns them into one row per task."""
    from docshred.operators.combine import drop_complete_duplicates
    other = dict(HAPPY, id="other")
    docs = read_documents(spark, write_lines([HAPPY] * 2000 + [other] * 10))
    out = drop_complete_duplicates(shred(docs, spec_by_name("diagnoses")))
    assert out.count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "Exchange" in plan


def test_building_all_tables_runs_no_job(spark, write_lines):
    from docshred.plans.pipeline import assemble
    docs = read_documents(spark, write_lines([HAPPY]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        res = assemble(docs, DICTS)
        assert len(res.tables) == 12 and list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_destination_alternates_parse_the_discharge_text_once(spark, write_lines, tmp_path):
    staged = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "d"))
    plan = _optimized(shred(staged, spec_by_name("dischargeDestinationIdentifiers")))
    assert plan.count("from_json(StructField(destination,") == 1


def test_report_reads_the_documents_twice_and_no_payload(spark, write_lines, tmp_path):
    import contextlib
    import io

    from docshred.operators.quality import quality_report
    from docshred.plans.clinical import clinical_specs
    staged = stage_documents(read_documents(spark, write_lines([HAPPY])), str(tmp_path / "q"))
    report = quality_report(staged, None, clinical_specs())
    assert _plan(report).count("FileScan parquet") <= 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        report.explain("formatted")
    schema = [ln for ln in buf.getvalue().splitlines() if "ReadSchema" in ln]
    assert schema and "assessmentData" not in " ".join(schema)
