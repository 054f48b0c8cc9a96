"""Shredding: one nested document frame → one flat table per ``TableSpec``.

Each table is a single narrow stage over the documents:
``Filter → Generate(explode) → Filter → Project`` (plus a second Generate for
the wide payload).  No shuffle, no join: parent keys ride along in the same
row, so a document id repeated over several lines never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docshred.plans.spec import Element, TableSpec
from docshred.sources.dictionary import dictionary_schema

WIDE_STRUCT = "_items"
POSITION = "_pos"
ITEMS_META = "docshred.dictionary"      # column metadata: all dictionary names, in order


def _rows(docs: DataFrame, spec: TableSpec, positions: bool = False) -> DataFrame:
    df = docs
    if spec.where is not None:
        df = df.where(spec.where())
    df = with_document_helpers(df, [spec])
    if spec.rows is not None:
        # non-outer explode: a null or empty array yields no rows
        generator = F.posexplode(spec.rows()).alias(POSITION, "e") if positions else F.explode(spec.rows()).alias("e")
        df = df.select("*", generator)
        if spec.element_where is not None:
            df = df.where(spec.element_where())
    if spec.prepare:
        # a separate projection: each helper is evaluated once per row and
        # stays un-inlined because several output columns reference it
        df = df.select("*", *[fn().alias(name) for name, fn in spec.prepare])
    return df


def with_document_helpers(docs: DataFrame, specs: Sequence[TableSpec]) -> DataFrame:
    """The documents with the document helper columns of all specs, each once; those
    that a stage holds already are not made again."""
    for s in specs:
        if s.document_prepare and s.document_prepare[-1][0] not in docs.columns:
            for name, fn in s.document_prepare:     # a helper may read the one before it
                docs = docs.withColumn(name, fn())
    return docs


def with_stored_helpers(docs: DataFrame, specs: Sequence[TableSpec]) -> DataFrame:
    """What a stage stores: the documents and the last helper column of every spec, so
    that raw sections are parsed once, not once a table."""
    keep = [*docs.columns, *dict.fromkeys(s.document_prepare[-1][0] for s in specs if s.document_prepare)]
    return with_document_helpers(docs, specs).select(*keep)


def value_of(fn, e: Column | None) -> Column:
    """A column rule applied to a given element (document columns need none)."""
    return fn.of(e) if isinstance(fn, Element) else fn()


def row_array(spec: TableSpec, of: Callable[[Column | None], Column], none: Column, keys_only: bool = False) -> Column:
    """A table's rows as one array per document, ``of`` applied to each row's element
    (None for a table with one row per document); ``none`` is the typed empty array.
    ``keys_only`` takes the rows of a wide table without payloads."""
    if spec.rows is None:
        rows = F.array(of(None))
    else:
        rows = ((keys_only and spec.wide and spec.wide.keys_only_rows) or spec.rows)()
        if spec.element_where is not None:
            rows = F.filter(rows, spec.element_where.of)
        rows = F.transform(rows, of)
    rows = F.coalesce(rows, none)
    return rows if spec.where is None else F.when(spec.where(), rows).otherwise(none)


def wide_schema(spec: TableSpec, dictionaries: Mapping[str, object]) -> StructType:
    schema = dictionary_schema(dictionaries[spec.wide.dictionary])
    clash = {c.lower() for c in spec.column_names} & {f.name.lower() for f in schema.fields}
    if clash:
        raise ValueError(f"{spec.name}: dictionary names clash with key columns: {sorted(clash)}")
    return schema


def keys_only(docs: DataFrame, spec: TableSpec, dictionaries: Mapping[str, object] | None = None) -> DataFrame:
    """The table's rows with its fixed columns only (no dictionary items) —
    what row counts and key null counts need.  For a wide spec the exploded
    array is rebuilt without payloads, so Parquet never reads them."""
    if spec.wide is None or spec.wide.keys_only_rows is None:
        return shred(docs, spec, dictionaries, widen=False)
    df = docs.where(spec.where()) if spec.where is not None else docs
    df = df.select("*", F.explode(spec.wide.keys_only_rows()).alias("e"))
    if spec.element_where is not None:
        df = df.where(spec.element_where())
    return df.select(*[fn().alias(name) for name, fn in spec.columns])


def _named_keys(spec: TableSpec) -> Callable[[Column | None], Column]:
    return lambda e: F.struct(F.lit(spec.wide.dictionary).alias("dictionary"),
                              F.json_object_keys(spec.wide.payload.of(e)).alias("names"))


def occurring_items(docs: DataFrame, specs, dictionaries: Mapping[str, object]) -> DataFrame:
    """(dictionary, name): dictionary names that occur as a payload key of a
    wide table.  Keys are semi-joined to the broadcast dictionary (its size is
    checked by the caller's reader) before the distinct, which combines map-side,
    so the result has at most one row per dictionary name."""
    wide = [s for s in specs if s.wide is not None]
    known = docs.sparkSession.createDataFrame([(s.wide.dictionary, n) for s in wide for n in wide_schema(s, dictionaries).names],
                                              "dictionary string, name string")
    if all(isinstance(fn, Element) for s in wide for fn in (s.wide.payload, s.element_where) if fn is not None):
        # all tables' payloads in one pass over the documents
        none = F.array().cast("array<struct<dictionary:string,names:array<string>>>")
        payloads = F.concat(*[row_array(s, _named_keys(s), none) for s in wide])
        rows = with_document_helpers(docs, wide).select(F.explode(payloads).alias("r"))
        keys = rows.select("r.dictionary", F.explode("r.names").alias("name"))
    else:
        keys = reduce(DataFrame.unionByName, [_rows(docs, s).select(
            F.lit(s.wide.dictionary).alias("dictionary"), F.explode(F.json_object_keys(s.wide.payload())).alias("name")) for s in wide])
    return keys.join(F.broadcast(known), ["dictionary", "name"], "left_semi").distinct()


def items_by_dictionary(found: DataFrame) -> dict[str, list[str]]:
    """The rows of ``occurring_items`` as lists (bounded by the dictionaries)."""
    out: dict[str, list[str]] = {}
    for r in found.collect():
        out.setdefault(r["dictionary"], []).append(r["name"])
    return out


def _strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shred(docs: DataFrame, spec: TableSpec, dictionaries: Mapping[str, object] | None = None,
          widen: bool = True, discover_items: bool = False,
          items: Mapping[str, list[str]] | None = None, positions: bool = False,
          rename_fixes: bool = False, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Build one table.  For a wide spec the dictionary items follow the fixed
    columns; with ``widen=False`` they stay packed in one struct column
    ``_items`` (cheaper to deduplicate, see ``combine.drop_complete_duplicates``).

    The frame is lazy: no job runs.  ``items`` (dictionary name → item names that
    occur, e.g. found while staging) narrows the parse to those names;
    ``discover_items`` finds them here, with one aggregate job over the payloads.
    The result is the same either way.

    ``positions`` adds ``_pos``, the element's place in its array (0 for a table
    with one row per document), ``rename_fixes`` corrects misspelt column names.
    ``carry`` adds columns of the document to every row (e.g. its ordinal)."""
    df = _rows(docs, spec, positions)
    fixes = dict(spec.renames) if rename_fixes else {}
    fixed = [fn().alias(fixes.get(name, name)) for name, fn in spec.columns]
    if positions:
        fixed.append(F.col(POSITION) if spec.rows is not None else F.lit(0).alias(POSITION))
    fixed += [c.alias(name) for name, c in (carry or {}).items()]
    if spec.wide is None:
        return df.select(*fixed)
    if discover_items:
        items = {spec.wide.dictionary: [], **items_by_dictionary(occurring_items(docs, [spec], dictionaries))}
    parsed, names = parsed_items(spec, spec.wide.payload(), dictionaries or {}, items)
    narrow = df.select(*fixed, parsed.alias(WIDE_STRUCT, metadata={ITEMS_META: names}))
    return narrow if not widen else widen_items(narrow)


def parsed_items(spec: TableSpec, payload: Column, dictionaries: Mapping[str, object],
                 items: Mapping[str, list[str]] | None = None) -> tuple[Column, list[str]]:
    """The payload's dictionary items as a struct that is never null, and all names."""
    names = wide_schema(spec, dictionaries).names
    parse = names
    if items is not None and spec.wide.dictionary in items:
        known = set(items[spec.wide.dictionary])
        parse = [n for n in names if n in known]
    schema = _strings(parse or names[:1])       # keep a non-empty struct when nothing occurs
    # from_json to a struct keeps the last of duplicate keys and drops keys
    # outside the struct.  A missing payload reads as {}: rows that are equal in
    # every item column must have equal structs, too.
    return F.coalesce(F.from_json(payload, schema), F.from_json(F.lit("{}"), schema)), names


def item_names(df: DataFrame) -> tuple[list[str], StructType]:
    """(all dictionary names in order, parsed struct type) of a narrow wide table."""
    field = df.schema[WIDE_STRUCT]
    return list(field.metadata.get(ITEMS_META) or field.dataType.names), field.dataType


def widen_items(df: DataFrame) -> DataFrame:
    """Fixed columns, then one column per dictionary name read from the
    ``_items`` struct (parsed once: Catalyst does not inline a costly
    expression that several columns reference) or a typed null if unparsed."""
    names, struct = item_names(df)
    parsed = set(struct.names)
    keep = [c for c in df.columns if c != WIDE_STRUCT]
    # one selectExpr call: building ~1250 Column objects through py4j costs seconds
    items = [f"{WIDE_STRUCT}.{_q(n)} AS {_q(n)}" if n in parsed else f"CAST(NULL AS STRING) AS {_q(n)}"
             for n in names]
    return df.selectExpr(*[_q(c) for c in keep], *items)


def widen(df: DataFrame) -> DataFrame:
    """Unpack the ``_items`` struct of a narrow wide table into columns."""
    if WIDE_STRUCT not in df.columns:
        return df
    return widen_items(df)


def project_dictionary(df: DataFrame, keep: list[str], payload, names) -> DataFrame:
    """Wide projection of a JSON-object text column by a dictionary (P10): the
    ``keep`` columns, then one string column per dictionary name."""
    schema = dictionary_schema(names)
    return df.select(*keep, F.inline(F.array(F.from_json(payload, schema))))
