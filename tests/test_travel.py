"""Columns packed for a shuffle come back as they were, whatever they hold."""

import datetime as dt
import re

from pyspark.sql import functions as F

from docshred.plans import nest, travel
from tests.shuffles import shuffled

DAY = dt.datetime(1996, 9, 13)


def test_small_columns_come_back(spark):
    kinds = {"d": travel.DAY, "q": travel.NUMBER, "n": travel.DIGITS, "f": travel.LETTER, "g": travel.LETTER}
    rows = [(DAY, 17.0, 3, "A", "F"), (None, 17.0, 3, "A", "F"), (DAY, None, 3, "A", "F"), (DAY, 1.0, None, "A", "F"),
            (DAY, 1.0, 3, None, "F"), (DAY, 1.0, 3, "", "F"), (DAY, 1.0, 3, "AB", "F"), (DAY, 1.0, 3, "é", "F"),
            (DAY + dt.timedelta(hours=5), 1.0, 3, "A", "F"), (dt.datetime(1901, 1, 1), 1.0, 3, "A", "F"),
            (dt.datetime(2900, 1, 1), 1.0, 3, "A", "F"), (DAY, 1.5, 3, "A", "F"), (DAY, -1.0, 3, "A", "F"), (DAY, 70000.0, 3, "A", "F"),
            (DAY, float("inf"), 3, "A", "F"), (DAY, 1e300, 3, "A", "F"), (DAY, 0.0, 255, "\0", "\x7f"), (DAY, 65535.0, 256, "A", "F"),
            (DAY, 1.0, -1, "A", "F"), (None, None, None, None, None)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"d {kind}, q double, n int, f string, g string")
        packed = travel.small(df, "_s", kinds)
        assert packed.where(F.col("_s").isNotNull()).count() >= 1
        assert packed.where(F.col("_s").isNotNull() & F.greatest(*(F.col(c).isNotNull() for c in kinds))).isEmpty()
        back = travel.small_unpacked(packed, "_s", kinds)
        assert back.schema == df.schema
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_texts_come_back(spark):
    long = "x" * 65535
    rows = [("a", "bc", "def"), (None, "bc", "def"), ("a", None, "def"), ("a", "bc", None), ("", "", ""), (None, None, None),
            ("é\n", "\0", "日本"), (long[:65534], "b", "c"), (long, "b", "c"), ("a", "b", long * 2)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    packed = travel.texts(df, "_t", ["a", "b", "c"])
    assert packed.where("_t IS NULL").count() == 2
    back = travel.texts_unpacked(packed, "_t", ["a", "b", "c"])
    assert back.schema == df.schema
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_cells_of_parts_and_suppliers():
    for n in (1, 2, 7, 100, 3000):
        for parts, suppliers in ((0, 0), (20000, 1000), (10, 10), (1, 10 ** 6)):
            a, b = nest._cells(n, parts, suppliers)
            assert 1 <= a and 1 <= b and a * b <= n


def _write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def _tables(spark, folder, n_orders):
    """A part and a supplier given twice, null keys, keys without a partner, and values that do not pack."""
    lines = [(o, (o * 7 + i) % 50, (o * 3 + i) % 20, i, float(o % 50), "ARN"[o % 3], "FO"[i % 2], DAY + dt.timedelta(days=o % 2000))
             for o in range(n_orders) for i in range(4)]
    lines += [(None, 1, 1, 1, 1.0, "A", "F", DAY), (1, None, 1, 1, 1.0, "A", "F", DAY), (1, 1, None, 1, 1.0, "A", "F", DAY),
              (1, 99, 1, 1, 1.0, "A", "F", DAY), (1, 1, 99, 1, 1.0, "A", "F", DAY), (2, 3, 4, 300, 1.5, "long", None, DAY + dt.timedelta(hours=3)),
              (2, 3, 4, None, None, None, None, None)]
    _write(spark, folder, "lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
           "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    parts = [(p, f"part {p}", f"Brand#{(p or 0) % 9}", None if p == 3 else "SMALL", p) for p in [*range(50), 7, None]]
    _write(spark, folder, "part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    _write(spark, folder, "supplier", [(s, f"Supplier#{s or 0:09d}") for s in [*range(20), 5, None]], "s_suppkey long, s_name string")
    orders = [(o, o % 30, "FOP"[o % 3], DAY + dt.timedelta(days=o % 900), "1-URGENT") for o in [*range(n_orders), 2]]
    _write(spark, folder, "orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string")
    customers = [(c, None if c == 4 else f"Customer#{c:09d}", c % 3, "BUILDING") for c in range(30)]
    _write(spark, folder, "customer", customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    _write(spark, folder, "nation", [(k, f"N{k}", k % 2) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int")
    _write(spark, folder, "region", [(0, "R0"), (1, "R1")], "r_regionkey int, r_name string")


def test_star_join_is_the_plain_join(spark, tmp_path):
    _tables(spark, tmp_path, 40)
    t = {name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in nest.SOURCE_COLUMNS}
    plain = t["lineitem"]
    for name, on in (("supplier", "l_suppkey = s_suppkey"), ("part", "l_partkey = p_partkey"), ("orders", "l_orderkey = o_orderkey"),
                     ("customer", "o_custkey = c_custkey"), ("nation", "c_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey")):
        plain = plain.join(t[name], F.expr(on))
    plain = plain.select("*", *[F.expr(nest.render(sql, "spark")).alias(c) for c, sql in nest.BASE_FIELDS.items()])
    for partitions in ("1", "7"):
        was = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            rows = nest.joined_rows(spark, str(tmp_path))
            assert rows.columns == plain.columns
            assert rows.count() == plain.count() > 160
            assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)


def test_lines_are_shuffled_once_for_suppliers_and_parts(spark, tmp_path):
    """Three times before: to their suppliers, to their parts, to their orders."""
    _tables(spark, tmp_path, 40)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = nest.joined_rows(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    depth, above = len(plan), []
    for line in reversed(plan[:next(i for i, x in enumerate(plan) if "FileScan" in x and "l_orderkey" in x) + 1]):
        at = re.search(r"\w", line).start()
        if at < depth or not above:
            depth = at
            above.append(line)
        if "Join" in line and "o_orderkey" in line:
            break
    shuffled = [x for x in above if "Exchange" in x]
    assert "o_orderkey" in above[-1] and len(shuffled) == 2, above


def test_longs_and_joined_texts_come_back(spark):
    kinds = {"k": 40, "j": 30, "d": travel.DAY, "q": travel.NUMBER, "n": travel.DIGITS, "f": travel.LETTER}
    texts = ["a", "b", "m"]
    good = (2 ** 40 - 1, 2 ** 30 - 1, DAY, 17.0, 3, "A", "x y", "", 7)
    odd = [None, -1, 2 ** 62, dt.datetime(2900, 1, 1), DAY + dt.timedelta(hours=5), 1.5, float("nan"), 70000.0, 40, "", "AB", "é", "a\0b", "\0", "日本"]
    rows = [good, (0, 0, dt.datetime(1970, 1, 1), 0.0, 0, "\0", "", "", 0), (None,) * len(good)]
    for i, kept in enumerate(good):
        rows += [(*good[:i], x, *good[i + 1:]) for x in odd if x is None or isinstance(x, type(kept))]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"k long, j long, d {kind}, q double, n long, f string, a string, b string, m long")
        packed = travel.joined(travel.longs(df, "_l", kinds), "_t", texts)
        names = list(travel.in_longs("_l", kinds))
        assert names == ["_l_0", "_l_1", "_l_2"]
        assert set(packed.columns) == {c for n in (*names, "_t") for c in (n, f"{n}_apart")}
        for n in (*names, "_t"):
            assert packed.where(F.col(n).isNull() == F.col(f"{n}_apart").isNull()).isEmpty()
            assert not packed.where(F.col(n).isNull()).isEmpty() and packed.where(F.col(n).isNotNull()).count() > 2
        columns = travel.longs_columns(packed, "_l", kinds) | travel.joined_columns(packed, "_t", texts)
        back = packed.select(*(x.alias(c) for c, x in columns.items()))
        assert back.dtypes == df.dtypes
        assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_bits_of_keys():
    assert [travel.key_bits(x) for x in (None, -5, 0, 1, 2, 255, 256, 2 ** 63 - 1)] == [1, 3, 1, 1, 2, 8, 9, 63]
    assert travel.in_longs("_l", {"a": 63, "b": 1, "c": 62, "d": 1}) == {"_l_0": {"a": 63}, "_l_1": {"b": 1, "c": 62}, "_l_2": {"d": 1}}


def test_star_join_shuffles_few_bytes_a_line(spark, tmp_path):
    """57 when only some columns were packed; nation and region are broadcast, as they always are."""
    _tables(spark, tmp_path, 10000)
    with shuffled(spark) as total:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
        rows = nest.joined_rows(spark, str(tmp_path))
        n = rows.agg(F.count(F.lit(1)), F.max(F.xxhash64(*rows.columns))).first()[0]
    assert total[0] / n < 40
