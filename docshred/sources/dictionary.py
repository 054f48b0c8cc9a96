"""Column dictionaries (S3): one-column CSV files, header ``Colnames``.

A dictionary names the item columns of a wide table in output order.  It is
schema metadata, not data: it is read to the driver once to build a
``StructType`` and its size is checked, since a table wider than a few
thousand columns is not a usable Spark table anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

COLUMN = "Colnames"
MAX_DICTIONARY_NAMES = 10_000


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Scan a dictionary CSV (CRLF or LF, header line) into a one-column frame."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .csv(path).select(F.col(COLUMN).cast("string").alias(COLUMN)))


def dictionary_names(dictionary: DataFrame | list[str], max_names: int = MAX_DICTIONARY_NAMES) -> list[str]:
    """Names in file order; checked for blanks and case-insensitive clashes, and a
    frame for size before it comes to the driver (``max_names``; more raises).  A list
    is on the driver already and may have any length."""
    if isinstance(dictionary, DataFrame):
        rows = dictionary.select(COLUMN).limit(max_names + 1).collect()
        names = [r[0] for r in rows]
        if len(names) > max_names:
            raise ValueError(f"dictionary has more than {max_names} names (max_names)")
    else:
        names = list(dictionary)
    seen: set[str] = set()
    for n in names:
        if n is None or not n.strip():
            raise ValueError("dictionary holds a blank name")
        if n.lower() in seen:
            raise ValueError(f"dictionary name {n!r} repeats (ignoring case)")
        seen.add(n.lower())
    return names


def dictionary_schema(dictionary: DataFrame | list[str]) -> StructType:
    """All-string struct with one field per dictionary name, in order."""
    return StructType([StructField(n, StringType()) for n in dictionary_names(dictionary)])


def write_dictionary(spark: SparkSession, names: list[str], path: str) -> str:
    """Write names as a dictionary CSV (single file, CRLF line ends)."""
    df = spark.createDataFrame([(n,) for n in names], f"{COLUMN} string")
    (df.coalesce(1).write.mode("overwrite").option("header", True)
       .option("lineSep", "\r\n").csv(path))
    return path
