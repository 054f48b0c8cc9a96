"""Runs published by a pointer record."""

import threading

from docshred.plans import nest
from docshred.sources.runs import current, expire, publish, publish_once, records


def test_two_writers_agree_on_one_run(spark, tmp_path):
    root = str(tmp_path / "data")
    assert current(spark, root) is None
    gate, got = threading.Barrier(2), []

    def writer(k: int) -> None:
        def write(path: str) -> None:
            gate.wait(60)                       # both write at a time
            spark.range(5).selectExpr(f"concat('w{k}-', id) AS value").write.text(path)
        got.append(publish(spark, root, write))

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert len(records(spark, root)) == 2
    path = current(spark, root)
    assert path in got and spark.read.text(path).count() == 5
    other = expire(spark, root)
    assert len(other) == 1 and other[0] != path
    assert spark.read.text(other[0]).count() == 0 and spark.read.text(path).count() == 5
    assert current(spark, root) == path


def test_unfinished_run_is_never_read(spark, tmp_path):
    root = str(tmp_path / "data")

    def breaks(path: str) -> None:
        spark.range(5).write.parquet(path)
        raise OSError("lost")
    try:
        publish(spark, root, breaks)
    except OSError:
        pass
    assert current(spark, root) is None
    first = publish_once(spark, root, lambda p: spark.range(3).write.parquet(p))
    assert publish_once(spark, root, breaks) == first and spark.read.parquet(first).count() == 3
    assert expire(spark, root, older_than=3600) == []


def test_no_gateway_to_the_jvm_in_the_corpus():
    with open(nest.__file__) as f:
        text = f.read()
    assert "_jvm" not in text and "_jsc" not in text
