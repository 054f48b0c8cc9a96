"""Column → Column helpers for loosely typed JSON (P6, P7, P9, E9).

All of them are compositions of built-in functions, so they stay inside the
JVM and whole-stage code generation; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_key(raw: Column | str, key: str) -> Column:
    """True when the JSON object text ``raw`` has ``key``, even with a null value.

    False for null text, scalars and arrays.  This is the key-presence test,
    distinct from a null test on the value."""
    keys = F.json_object_keys(_c(raw))
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def key_fallback(present_key: str, parsed: Column, raw: Column | str, fallback: str) -> Column:
    """Value of ``present_key`` if the key exists in ``raw`` (its value may be
    null), else the value of ``fallback``; ``parsed`` is ``from_json(raw, ...)``
    holding both fields.  Not a ``coalesce``: a present null wins."""
    return F.when(has_key(raw, present_key), parsed[present_key]).otherwise(parsed[fallback])


def array_len(arr: Column | str) -> Column:
    """Number of elements, 0 for a null or missing array."""
    return F.coalesce(F.size(_c(arr)), F.lit(0))


def raw_array_len(raw_doc: Column | str, path: str) -> Column:
    """Elements of the array at JSON ``path`` in raw document text, 0 if absent.
    Used for source counts of records whose typed parse failed."""
    return F.coalesce(F.json_array_length(F.get_json_object(_c(raw_doc), path)), F.lit(0))


def zip_arrays(a: Column | str, b: Column | str, names: tuple[str, str],
               element_type=StringType()) -> Column:
    """Zip two parallel arrays into an array of structs ``names``.

    The shorter (or missing) side is padded with nulls, so the result has
    ``max(len(a), len(b))`` elements; two missing arrays give ``[]``."""
    empty = F.array().cast(ArrayType(element_type))
    za = F.coalesce(_c(a), empty)
    zb = F.coalesce(_c(b), empty)
    out = ArrayType(StructType([StructField(names[0], element_type),
                                StructField(names[1], element_type)]))
    # arrays_zip names its fields by position; the cast renames them
    return F.arrays_zip(za, zb).cast(out)

