"""Streaming: files landing in a folder are shredded batch by batch."""

import copy
import json

from docshred.streaming import compact, start
from tests.test_shred import DICTS, HAPPY


def _drop(folder, name, records):
    with open(folder / name, "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def test_stream_shreds_new_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out = str(tmp_path / "out")
    other = copy.deepcopy(HAPPY)
    other["id"] = "p2"
    _drop(inbox, "a.json", [HAPPY, HAPPY, "{bad"])
    q = start(spark, str(inbox), out, DICTS, checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    _drop(inbox, "b.json", [other, HAPPY])
    q = start(spark, str(inbox), out, DICTS, checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)

    diag = spark.read.parquet(f"{out}/diagnoses")
    assert diag.select("_batch").distinct().count() == 2       # one partition per batch
    assert diag.count() == 2 + 4                                # dedup within each batch only
    tables = compact(spark, out, ["diagnoses", "patientInfo", "oasis"])
    assert tables["diagnoses"].count() == 4                     # p1 x2 + p2 x2 after compaction
    assert tables["patientInfo"].count() == 2
    assert tables["oasis"].columns[-5:] == DICTS["oasis"]
    rep = spark.read.parquet(f"{out}/_quality")
    assert rep.where("table = 'patientInfo'").select("_batch", "actual_rows").distinct().count() == 2
    assert spark.read.parquet(f"{out}/_rejected").count() == 1


def test_restart_reads_no_file_twice_and_compact_takes_empty_tables(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out = str(tmp_path / "out")
    _drop(inbox, "a.json", [{"id": "p", "version": "1", "diagnoses": [{"code": "x"}]}])
    for _ in range(2):          # the default checkpoint belongs to the output root
        start(spark, str(inbox), out, DICTS, available_now=True).awaitTermination(120)
    assert spark.read.parquet(f"{out}/diagnoses").count() == 1
    tables = compact(spark, out, dictionaries=DICTS)
    assert len(tables) == 12
    assert tables["diagnoses"].count() == 1
    assert tables["Contacts"].count() == 0 and tables["Contacts"].columns[2] == "phoneNumer"
    assert tables["oasis"].count() == 0 and tables["oasis"].columns[-5:] == DICTS["oasis"]
    assert compact(spark, out, ["mds"])["mds"].columns[:2] == ["patient_id", "PAA_version"]


def test_dedup_across_batches_equals_one_dedup_of_everything(spark, tmp_path, monkeypatch):
    from docshred.operators.combine import drop_complete_duplicates
    from docshred.operators.shredder import shred
    from docshred.plans.clinical import clinical_specs
    from docshred.sources.documents import read_documents, well_formed
    from docshred.streaming import incremental
    from tests.conftest import rows

    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out = str(tmp_path / "out")
    batches = []
    for k in range(3):
        doc = copy.deepcopy(HAPPY)
        doc["id"] = f"p{k // 2}"            # the third batch brings a new patient
        doc["diagnoses"].append({"code": f"new{k % 2}"})
        batches.append([HAPPY, doc, doc, "{bad"])
    for k, recs in enumerate(batches):
        monkeypatch.setattr(incremental, "BROADCAST_KEYS", 1 if k == 2 else 200_000)     # either way of joining
        _drop(inbox, f"{k}.json", recs)
        start(spark, str(inbox), out, DICTS, checkpoint=str(tmp_path / "ckpt"), available_now=True,
              across_batches=True, keep_staged=False).awaitTermination(180)

    def tables():
        found = {}
        for s in clinical_specs():
            schema = shred(docs, s, DICTS).schema
            found[s.name] = rows(spark.read.schema(schema).parquet(f"{out}/{s.name}").select(*schema.names))
        return found

    docs = well_formed(read_documents(spark, str(inbox)))
    want = {s.name: rows(drop_complete_duplicates(shred(docs, s, DICTS, widen=False))) for s in clinical_specs()}
    assert tables() == want
    assert len(want["diagnoses"]) > 4
    # a batch that runs again gives the same tables
    again = read_documents(spark, str(inbox / "1.json"))
    incremental.shred_batch(again, 1, out, DICTS, across_batches=True)
    assert tables() == want


def test_staged_documents_can_be_emptied(spark, tmp_path):
    from docshred.sources.documents import read_documents
    from docshred.streaming.incremental import shred_batch
    _drop(tmp_path, "a.json", [HAPPY])
    out = str(tmp_path / "out")
    shred_batch(read_documents(spark, str(tmp_path / "a.json")), 0, out, DICTS, across_batches=True, keep_staged=False)
    assert spark.read.parquet(f"{out}/diagnoses").count() == 2
    files = [p for folder in ("_staged", "_new") for p in (tmp_path / "out" / folder).rglob("part-*") if p.is_file()]
    assert sum(p.stat().st_size for p in files if p.suffix != ".crc") == 0
