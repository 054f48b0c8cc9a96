import os
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np

import corpus_pipeline
from docshred.llm import queries as llm
from docshred.llm.cost_packing import TokenBytes
from tests.llm.fixtures import documents, frame
from tests.llm.test_jaccard_join import slow

SF = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(llm.oracle_sql()) <= names


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "docshred"):
        os.symlink(REPO / name, tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "docshred").mkdir()
    for p in (REPO / "docshred").iterdir():
        if p.name != "llm":
            os.symlink(p, tmp_path / "docshred" / p.name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((REPO / "__spark_entry__.py").read_text())
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=tmp_path,
                         capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert run.returncode == 0, run.stderr
    assert "dq_report" in run.stdout and "op1_" not in run.stdout


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokens = TokenBytes(llm.TOKENIZER)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = out.collect()
        assert 0 < len(rows) <= before
        if name == "near_duplicates":
            want = slow([tuple(r) for r in docs.collect()])
            assert {r["doc_id"] for r in rows} == {i for (i, _), (_, c) in want.items() if i == c}
        if name == "secrets":
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        docs, before = spark.createDataFrame(rows, out.schema), len(rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    want = {r["doc_id"]: len(tokens.encode([r["text"]])[0]) // 4 + 1 for r in docs.collect()}
    got = defaultdict(int)
    for r in packed:
        got[r["doc_id"]] += r["length"]
    assert got == want and np.all([r["length"] <= 1024 for r in packed])


def test_near_duplicate_stage_on_awkward_rows(spark):
    rows = documents()
    out = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF).collect()
    ids = [r["doc_id"] for r in out]
    assert all(i in ids for i in (3, 4, 5, 10, None)) and not any(i in ids for i in (11, 12, 7))
    assert ids.count(0) == 2  # two texts under one id; the repeated row counts once


def test_near_duplicate_stage_keeps_every_row_without_a_word(spark):
    rows = [(None, None, "en", "a", None), (None, None, "de", "b", None), (1, "", "en", "a", 0), (1, "", "fr", "c", 0),
            (2, "one text of words", "en", "a", 17), (2, "one text of words", "en", "a", 17)]
    out = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(rows[:5], key=repr)


def test_warc_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = con.execute(llm.oracle_sql()["op2_warc_dictionary"])
    cols = [d[0] for d in want.description]
    got = llm.queries()["op2_warc_dictionary"](spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
