"""Output of the shredded tables (S5).

The result is a ``dict`` of lazy DataFrames.  To use them from SQL register
temp views; to keep them, write each one (Parquet by default).  Nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    df.write.mode(mode).format(fmt).save(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> dict[str, str]:
    """Write every table to ``root/<name>``; returns name → path."""
    return {name: write_table(df, f"{root.rstrip('/')}/{name}", fmt, mode)
            for name, df in tables.items()}


def read_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: spark.read.format(fmt).load(p) for name, p in paths.items()}
