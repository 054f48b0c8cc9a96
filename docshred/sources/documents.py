"""Scan of line-delimited JSON documents (S1, S2) and Parquet staging.

The read schema is explicit: inference would turn every assessment item into a
nested field, fail on duplicate keys, and cost an extra pass over the data.
Sections whose shape varies between documents are read as ``string``: Spark
then keeps the raw JSON text of an object (or the bare text of a scalar), and
the shredding functions decide per row what the text holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"
MISFITS = "_misfits"        # sections and elements of the wrong kind, by path
ORDINAL = "_doc"            # place of a document among all input lines
ELEMENTS = "[]"             # suffix of a path: an element of that array


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


IDENTIFIER = StructType(_strings("id", "authority", "type", "facility"))
ALT_IDENTIFIER = StructType(_strings("id", "authority", "facility", "type"))

# expirationIndicator is the one boolean of the contract; it is read as text and
# converted in the projection, so a stray "false" string or number cannot make
# the typed parse fail and null the whole demographics section
DEMOGRAPHICS = StructType(
    _strings("id", "dob", "sex", "expirationIndicator", "patientClass")
    + [
        StructField("name", StructType(_strings("first", "last", "middle", "title", "suffix"))),
        StructField("identifiers", ArrayType(IDENTIFIER)),
        # element type is not fixed by the format: keep each element as text
        StructField("phoneNumbers", ArrayType(StringType())),
        StructField("emergencyContacts", ArrayType(StringType())),
    ])

FACILITY = StructType(
    _strings("id", "name", "careSetting")
    + [StructField("alternateIdentifiers", ArrayType(ALT_IDENTIFIER))])

ASSESSMENT = StructType(_strings("id", "type", "occurredAt", "assessmentData"))

# The full document schema.  dischargeInfo (destination is an object or a
# scalar) and payors (flat or nested under ``policy``) stay raw JSON text.
DOCUMENT_SCHEMA = StructType(
    _strings("id", "version", "admitDate", "dischargeDate")
    + [
        StructField("demographics", DEMOGRAPHICS),
        StructField("dischargeInfo", StringType()),
        StructField("diagnoses", ArrayType(StructType(
            _strings("method", "code", "description", "priority", "type")))),
        StructField("payors", ArrayType(StringType())),
        StructField("facility", FACILITY),
        StructField("documents", ArrayType(StructType(
            _strings("filename", "displayFilename", "filetype", "dataType")))),
        StructField("assessments", ArrayType(ASSESSMENT)),
    ])


def _elements_as_text(kind):
    """The type with every array read as ``array<string>``: Spark then keeps each
    element's raw text, so one element that does not fit cannot null its array."""
    if isinstance(kind, ArrayType):
        return ArrayType(StringType())
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _elements_as_text(f.dataType)) for f in kind])
    return kind


def _typed(value: Column, kind, mode: str) -> Column:
    """A value read with ``_elements_as_text`` in its own type: every array
    element is parsed by itself (a bad one becomes a row of nulls, or raises
    under FAILFAST)."""
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return F.transform(value, lambda e: F.from_json(e, kind.elementType, {"mode": mode}))
    if isinstance(kind, StructType):
        for f in kind:
            if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType):
                value = value.withField(f.name, _typed(value[f.name], f.dataType, mode))
    return value


def _sections(kind: StructType, prefix: str = "") -> list[tuple[str, object]]:
    """(path, type) of every section that is no text, children after their parents."""
    out = []
    for f in kind:
        if isinstance(f.dataType, (ArrayType, StructType)):
            out.append((prefix + f.name, f.dataType))
        if isinstance(f.dataType, StructType):
            out += _sections(f.dataType, f"{prefix}{f.name}.")
    return out


# array of texts whose elements are objects all the same; sections read as text that are objects
OBJECT_ELEMENTS = ("payors",)
OBJECT_TEXTS = ("dischargeInfo",)


def _is_object(text: Column) -> Column:
    return F.substring(F.ltrim(text), 1, 1) == "{"


def _texts_misfit(columns: Mapping[str, Column]) -> list[Column]:
    return [F.when(columns[p].isNotNull() & F.json_object_keys(columns[p]).isNull(), F.lit(p)) for p in OBJECT_TEXTS if p in columns]


def _field(columns: Mapping[str, Column], path: str) -> Column:
    first, *more = path.split(".")
    return reduce(lambda c, name: c[name], more, columns[first])


def _elements_misfit(out: Column, columns: Mapping[str, Column], sections: Sequence[tuple[str, object]], typed: bool) -> Column:
    for p, t in sections:
        if isinstance(t, ArrayType) and (isinstance(t.elementType, StructType) or p in OBJECT_ELEMENTS):
            no_object = Column.isNull if typed and p not in OBJECT_ELEMENTS else lambda e: e.isNull() | ~_is_object(e)
            bad = F.size(F.filter(_field(columns, p), lambda e: no_object(e)))
            out = F.concat(out, F.array_repeat(F.lit(p + ELEMENTS), F.coalesce(bad, F.lit(0))))
    return out


def _found(found: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def misfits(columns: Mapping[str, Column]) -> Column:
    """Paths of what a document holds in the wrong kind: a section once (it reads as
    null, but the raw line has a value there), ``path[]`` once for every element of
    an array of objects that is no object.  Empty for a document that fits; lines
    that are no documents are not looked at.  ``columns`` as read, elements as text."""
    sections = [(p, t) for p, t in _sections(DOCUMENT_SCHEMA) if p.split(".")[0] in columns]
    corrupt = columns[CORRUPT]
    # the typed parse sets the corrupt record whenever a section did not fit
    partly = corrupt.isNotNull() & ~not_object(columns)
    found = [F.when(partly & _field(columns, p).isNull() & F.get_json_object(corrupt, f"$.{p}").isNotNull(), F.lit(p)) for p, _ in sections]
    return _elements_misfit(_found(found + _texts_misfit(columns)), columns, sections, typed=False)


def fitting_misfits(names: Iterable[str]) -> Column:
    """``misfits`` of a document that was read in its own types without a corrupt record:
    every section fits, and an element that is none is null."""
    columns = {c: F.col(c) for c in names}
    sections = [(p, t) for p, t in _sections(DOCUMENT_SCHEMA) if p.split(".")[0] in columns]
    return _elements_misfit(_found(_texts_misfit(columns)), columns, sections, typed=True)


def typed_documents(docs: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Documents read with ``document_schema`` with their array elements parsed; in a
    permissive read with ``misfits`` beside them."""
    known = {f.name: f.dataType for f in DOCUMENT_SCHEMA}
    extra = [misfits({c: F.col(c) for c in docs.columns}).alias(MISFITS)] if CORRUPT in docs.columns else []
    return docs.select(*[_typed(F.col(c), known[c], mode).alias(c) if c in known else F.col(c) for c in docs.columns], *extra)


def _pruned(schema: StructType, sections: list[str] | None, corrupt: bool) -> StructType:
    fields = schema.fields
    if sections is not None:
        keep = {"id", "version", *sections}
        fields = [f for f in fields if f.name in keep]
    if corrupt:
        fields = list(fields) + [StructField(CORRUPT, StringType())]
    return StructType(list(fields))


def document_schema(sections: list[str] | None = None, corrupt: bool = False) -> StructType:
    """The read schema (array elements as text, see ``typed_documents``),
    optionally pruned to ``id``, ``version`` and ``sections``."""
    return _pruned(_elements_as_text(DOCUMENT_SCHEMA), sections, corrupt)


def read_documents(spark: SparkSession, path: str | list[str] | DataFrame, mode: str = "PERMISSIVE",
                   sections: list[str] | None = None, ordinal: bool = False) -> DataFrame:
    """Scan JSON-lines documents with the explicit schema, from files or from a frame
    of lines (column ``value``), which is read as it is derived, without a copy.

    ``mode="FAILFAST"`` raises on a malformed line or on an array element that
    does not fit its type, as a strict loader would.  ``mode="PERMISSIVE"`` keeps
    a malformed line's text in ``_corrupt_record``; array elements are parsed one
    by one, so a bad element is a row of nulls and its neighbours are kept.
    Blank lines are skipped by the JSON source.  A missing path raises
    ``PATH_NOT_FOUND`` at analysis time.

    ``ordinal`` adds ``_doc``, which orders the documents as they stand in the input:
    by path of the file, then start of the split, then line.  The numbers depend on
    how the files were split, their order does not.
    """
    mode = mode.upper()
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"mode must be PERMISSIVE or FAILFAST, not {mode}")
    schema = document_schema(sections, corrupt=(mode == "PERMISSIVE"))
    if isinstance(path, DataFrame):
        keep = [ORDINAL] if ordinal else []
        if mode == "PERMISSIVE":
            return _parsed_documents(path, "value", sections, keep)
        return typed_documents(_parsed(path, "value", schema, mode, keep), mode)
    reader = spark.read.schema(schema).option("mode", mode)
    if mode == "PERMISSIVE":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    docs = reader.json(path)
    if ordinal:
        # lines of a split are read in order by one task, so the id ascends within it
        docs = docs.select("*", F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line")).alias(ORDINAL))
    return typed_documents(docs, mode)


def parse_documents(lines: DataFrame, text_col: str = "value",
                    sections: list[str] | None = None) -> DataFrame:
    """Same parse as ``read_documents`` over a column of JSON text (e.g. a stream
    or a table of raw lines).  Blank lines are dropped like the file source does."""
    return _parsed_documents(lines, text_col, sections)


def _parsed_documents(lines: DataFrame, text_col: str, sections: list[str] | None, keep: Sequence[str] = ()) -> DataFrame:
    """``typed_documents`` of the lines.  A line is parsed once, in its own types; only one that
    does not fit them is parsed again, elements as text, so that what fits of it is kept."""
    typed, text = _pruned(DOCUMENT_SCHEMA, sections, True), document_schema(sections, corrupt=True)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    raw = F.col(text_col)
    # generated, so that a line is parsed once whatever filters and columns follow
    docs = lines.where(F.trim(raw) != "").select(*keep, raw.alias("_raw"), F.inline(F.array(F.from_json(raw, typed, options))))
    again = F.when(F.col(CORRUPT).isNotNull(), F.from_json("_raw", text, options))
    docs = docs.select(*keep, *typed.names, F.explode(F.array(again)).alias("_again"))
    fits, parts = F.col(CORRUPT).isNull(), {f.name: f.dataType for f in typed}
    misfit = misfits({c: F.col("_again")[c] for c in parts})
    out = [F.when(fits, F.col(c)).otherwise(_typed(F.col("_again")[c], kind, "PERMISSIVE")).alias(c) for c, kind in parts.items()]
    return docs.select(*out, *keep, F.when(fits, fitting_misfits(parts)).otherwise(misfit).alias(MISFITS))


def _parsed(lines: DataFrame, text_col: str, schema: StructType, mode: str, keep: Sequence[str] = ()) -> DataFrame:
    """The lines with the columns of ``schema``, elements as text.  Generated, so that a
    line is parsed once whatever filters and columns follow."""
    raw = F.col(text_col)
    options = {"mode": mode} | ({"columnNameOfCorruptRecord": CORRUPT} if mode == "PERMISSIVE" else {})
    parsed = lines.where(F.trim(raw) != "").select(*keep, F.inline(F.array(F.from_json(raw, schema, options))))
    return parsed.select(*schema.names, *keep)


# A line that is not a JSON object has every field null, ``id`` included.  The
# ``id`` test changes nothing in meaning but makes the scan read a real column:
# Spark refuses raw JSON queries that read ``_corrupt_record`` alone.
def not_object(columns: Mapping[str, Column] | None = None) -> F.Column:
    corrupt, key = (columns[c] if columns else F.col(c) for c in (CORRUPT, "id"))
    return corrupt.isNotNull() & F.json_object_keys(corrupt).isNull() & key.isNull()


def malformed(docs: DataFrame) -> DataFrame:
    """Lines that are not a JSON object at all (PERMISSIVE scans only)."""
    if CORRUPT not in docs.columns:
        return docs.limit(0)
    return docs.where(not_object())


def well_formed(docs: DataFrame) -> DataFrame:
    """Drop lines that are not JSON objects; keep partially typed records."""
    if CORRUPT not in docs.columns:
        return docs
    return docs.where(~not_object())


def stage_documents(docs: DataFrame, path: str) -> DataFrame:
    """Write the parsed documents once to Parquet and read them back.

    One JSON parse feeds all twelve tables and the checks; Parquet then gives
    nested column pruning per table, and the written files cut the lineage so
    a lost executor does not re-parse the JSON.
    """
    spark = docs.sparkSession
    docs.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
