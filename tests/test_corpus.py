"""The documents are read as they are derived: no copy of them on disk."""

import os
import re

from docshred.plans import nest, queries
from docshred.sources.documents import CORRUPT, MISFITS, ORDINAL, read_documents, well_formed
from tests.conftest import rows
from tests.test_shred import HAPPY

SF = "/root/testdata/sf0.001"
LINES = ['{"id":"a","version":"2.7","diagnoses":[{"code":"c"},"bad"],"assessments":[{"id":"x","assessmentData":{"A":1}}]}',
         '{"id":"b","demographics":"text","facility":["x"]}', '{"id":"c","documents":[{"filename":"f', "[1]", "42", "", "  "]


def _size(folder) -> int:
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_lines_of_a_frame_read_like_a_file(spark, write_lines):
    from json import dumps
    lines = [*LINES, dumps(HAPPY, separators=(",", ":"))]
    file = read_documents(spark, write_lines(lines))
    frame = read_documents(spark, spark.createDataFrame([(x,) for x in lines] + [(None,)], "value string"))
    assert frame.schema == file.schema and CORRUPT in frame.columns and MISFITS in frame.columns
    assert rows(frame) == rows(file) and frame.count() == 6
    assert rows(well_formed(frame), "id") == rows(well_formed(file), "id")


def test_queries_write_no_copy_of_the_documents(spark, tmp_path, monkeypatch):
    text = sum(len(r[0]) for r in nest.build_documents(spark, SF).select("value").collect())
    for name in ("scan_documents", "oasis_wide"):
        monkeypatch.setattr(nest, "shared_dir", lambda s, n=name: str(tmp_path / n))
        queries.queries()[name](spark, SF).collect()
        assert _size(tmp_path / name) < text / 50, name


def test_conversations_need_no_other_table(spark, tmp_path):
    turns = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (2, 0, "user", None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.q_conversation_roles(spark, str(tmp_path))
    assert rows(got, "conv_id", "TEXT") == [("1", "hello"), ("2", None)]
    assert {r["table"] for r in queries.q_dq_report_sparse(spark, str(tmp_path)).collect()} >= {"oasis", "mds"}


def test_documents_are_ordered_by_their_keys(spark):
    docs = read_documents(spark, nest.build_documents(spark, SF), sections=["documents"], ordinal=True)
    first = [r["documents"][0]["filename"] for r in docs.orderBy(ORDINAL).limit(50).collect()]
    keys = [tuple(map(int, f.removesuffix(".pdf").split("-"))) for f in first]
    assert keys == sorted(keys) and len(keys) == 50


def test_part_texts_join_after_suppliers(spark):
    """They are the widest columns of a line: joined last, they are shuffled once."""
    plan = nest.joined_rows(spark, SF)._jdf.queryExecution().analyzed().toString()
    at = [re.search(rf"Join Inner, \(\w+#\w+ = {key}#", plan).start() for key in ("o_orderkey", "p_partkey", "s_suppkey")]
    assert at == sorted(at)     # the plan names the last join first
