"""Column helpers: key presence, fallbacks, parallel arrays (P6, P7, P9, E9)."""

from pyspark.sql import functions as F

from docshred.functions import array_len, has_key, key_fallback, raw_array_len, zip_arrays


def _one(spark, text):
    return spark.createDataFrame([(text,)], "raw string")


def test_has_key_sees_present_null(spark):
    df = spark.createDataFrame([('{"a": null}',), ('{"b": 1}',), ('"s"',), (None,), ("[1]",)], "raw string")
    got = [r[0] for r in df.select(has_key("raw", "a")).collect()]
    assert got == [True, False, False, False, False]


def test_key_fallback_present_null_wins(spark):
    schema = "destination string, destinationDescription string"
    df = spark.createDataFrame([
        ('{"destinationDescription": null, "destination": "D"}',),
        ('{"destination": "D"}',),
        ('{"destinationDescription": "X", "destination": "D"}',),
        ('{}',)], "raw string")
    parsed = F.from_json("raw", schema)
    got = [r[0] for r in df.select(key_fallback("destinationDescription", parsed, "raw", "destination")).collect()]
    assert got == [None, "D", "X", None]


def test_zip_pads_shorter_and_broadcasts_missing(spark):
    df = spark.createDataFrame([
        (["p1", "p2"], ["e1"]), (None, ["e1", "e2"]), (["p1"], None), (None, None), ([], [])],
        "a array<string>, b array<string>")
    z = df.select(zip_arrays("a", "b", ("phone", "em")).alias("z"))
    got = [[tuple(x) for x in r.z] for r in z.collect()]
    assert got == [[("p1", "e1"), ("p2", None)], [(None, "e1"), (None, "e2")], [("p1", None)], [], []]
    assert z.schema["z"].dataType.elementType.names == ["phone", "em"]


def test_lengths(spark):
    df = spark.createDataFrame([(["x", "y"], None, '{"a":[1,{"b":[2,3]},"s"]}')],
                               "a array<string>, b array<string>, raw string")
    r = df.select(array_len("a"), array_len("b"), raw_array_len("raw", "$.a"), raw_array_len("raw", "$.zz")).first()
    assert tuple(r) == (2, 0, 3, 0)
