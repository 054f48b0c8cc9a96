"""Relational tables → nested patient-record documents (JSON lines).

This is the round trip that makes every shredding operator checkable against
plain SQL: each ``lineitem`` row becomes one document, enriched by
many-to-one joins to ``orders``, ``customer``, ``nation``, ``region``,
``supplier`` and ``part``.  No table is grouped: every array inside a document
is built from that one joined row by a fixed rule (0-3 elements), so document
size is bounded whatever the key distribution, and the work is a star join
that Spark plans as shuffle or broadcast joins by measured size (AQE).

Shapes vary by row attributes so that missing keys, explicit nulls, empty
arrays, scalar-vs-object values, two payor shapes and unequal parallel arrays
all occur.  ``BASE_FIELDS`` (SQL shared with the DuckDB oracle) defines the
scalar values; ``document_sections`` decides the structure.

The documents are many times larger than the tables, so the queries read them as
they are derived (``build_documents``).  ``corpus`` and ``staged`` write copies of them
under the shared folder named by ``spark.checkpoint.dir``, for users who read them
many times and have the room.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docshred.operators.shredder import items_by_dictionary, occurring_items, with_stored_helpers
from docshred.plans import travel
from docshred.plans.clinical import clinical_specs
from docshred.session import shared_dir
from docshred.sources.dictionary import write_dictionary
from docshred.sources.documents import ORDINAL, read_documents, well_formed
from docshred.sources.runs import publish_once

CORPUS_VERSION = "v9"

# ---- scalar fields of one document, as SQL over the joined row -----------------------
# {ts:x} → 'yyyy-MM-dd HH:mm:ss.SSS' text, {day:x} → 'yyyy-MM-dd' text, per dialect.
BASE_FIELDS: dict[str, str] = {
    "pid": "CAST(c_custkey AS STRING)",
    "ver": "CASE WHEN l_linestatus = 'O' THEN '2.7' ELSE '2.6' END",
    "admit": "{ts:o_orderdate}",
    "disch": "{ts:l_shipdate}",
    "dem_id": "'D' || CAST(c_custkey AS STRING)",
    "dob": "{day:o_orderdate}",
    "sex": "CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD') THEN 'female' ELSE 'male' END",
    "expired": "o_orderstatus = 'F'",
    "pclass": "lower(o_orderpriority)",
    "first_name": "c_name",
    "last_name": "c_mktsegment",
    "middle": "substr(n_name, 1, 1)",
    "n_ids": "CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END",
    "id1": "'MC' || CAST(l_orderkey AS STRING)",
    "id2": "'MRN' || CAST(c_custkey AS STRING)",
    "phone1": "'tel:' || CAST(c_custkey AS STRING) || '-1'",
    "phone2": "'tel:' || CAST(c_custkey AS STRING) || '-2'",
    "emerg1": "s_name",
    "emerg2": "n_name",
    "disposition": "o_orderpriority",
    "dest_id": "'N' || CAST(n_nationkey AS STRING)",
    "dest_name": "n_name",
    "dest_text": "CASE WHEN l_returnflag = 'R' THEN '{' || (n_name) || '} unit' ELSE n_name END",
    "dest_care": "r_name",
    "alt_s_id": "'S' || CAST(l_suppkey AS STRING)",
    "alt_p_id": "'P' || CAST(l_partkey AS STRING)",
    "alt_c_id": "'C' || CAST(c_custkey AS STRING)",
    "dx1_code": "p_brand || '.' || CAST(p_size AS STRING)",
    "dx2_code": "CAST(l_partkey AS STRING)",
    "dx3_code": "CAST(l_suppkey AS STRING)",
    "policy1": "CAST(o_orderkey AS STRING)",
    "policy2": "'PN' || CAST(l_orderkey AS STRING)",
    "x_company": "'x-' || r_name",
    "fac_id": "'F' || CAST(n_nationkey AS STRING)",
    "file1": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '.pdf'",
    "file2": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '.xml'",
    "display1": "c_name || ' - ' || p_type || '.pdf'",
    "asmt1_id": "'A' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "asmt3_id": "'C' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "asmt2_id": "'B' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "asmt1_type": "CASE l_returnflag WHEN 'R' THEN 'oasis' WHEN 'A' THEN 'mds' ELSE 'other' END",
    "k_orderkey": "CAST(l_orderkey AS STRING)",
    "k_partkey": "CAST(l_partkey AS STRING)",
    "k_suppkey": "CAST(l_suppkey AS STRING)",
    "k_quantity": "CAST(CAST(l_quantity AS BIGINT) AS STRING)",
    "k_shipday": "{day:l_shipdate}",
}

# Raw columns the documents read, per table.
SOURCE_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "supplier": ["s_suppkey", "s_name"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
}

# Item keys the assessment payloads carry, in the order the dictionaries list them.
PAYLOAD_ITEMS = ("L_ORDERKEY", "L_PARTKEY", "L_SUPPKEY", "L_LINENUMBER", "L_QUANTITY",
                 "L_RETURNFLAG", "L_LINESTATUS", "L_SHIPDATE")
OASIS_WIDTH, MDS_WIDTH = 557, 1247
# Rows whose payloads fill two of every five other dictionary positions as well, and
# the item of position i in them: given, null, and its text (a bare number or quoted).
DENSE = "l_orderkey % 64 = 0"
ITEM_GIVEN, ITEM_NULL, ITEM_TEXT = "(l_orderkey + i) % 5 < 2", "(l_orderkey + i) % 13 = 0", "(l_orderkey + i) % 7"
ITEM_BARE = "i % 11 = 0"
ITEM_PERIOD = 5 * 13 * 7        # keys from 0 that are so far apart have the same items
# ---------------------------------------------------------------------------------------


def render(sql: str, dialect: str) -> str:
    """Expand the {ts:x} / {day:x} macros of a BASE_FIELDS entry."""
    import re
    if dialect == "spark":
        ts, day = "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSS')", "date_format({}, 'yyyy-MM-dd')"
    elif dialect == "duckdb":
        ts, day = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')", "strftime({}, '%Y-%m-%d')"
    else:
        raise ValueError(dialect)
    sql = re.sub(r"\{ts:(\w+)\}", lambda m: ts.format(m.group(1)), sql)
    return re.sub(r"\{day:(\w+)\}", lambda m: day.format(m.group(1)), sql)


def dictionary_items(kind: str) -> list[str]:
    """Item names of a generated dictionary: the keys of every payload, then those
    that only dense payloads carry (about 220 and 500 of them each)."""
    return list(PAYLOAD_ITEMS) + [f"{kind.upper()}_ITEM_{i:04d}" for i in dense_positions(kind)]


def dense_positions(kind: str) -> range:
    return range(len(PAYLOAD_ITEMS) + 1, {"oasis": OASIS_WIDTH, "mds": MDS_WIDTH}[kind] + 1)


def dense_items(kind: str) -> str:
    """SQL for the further members of a dense payload, as JSON text."""
    at = dense_positions(kind)
    text = f"CAST({ITEM_TEXT} AS STRING)"
    return f"""concat_ws(',', transform(filter(sequence({at[0]}, {at[-1]}), i -> {ITEM_GIVEN}),
        i -> concat('"{kind.upper()}_ITEM_', lpad(CAST(i AS STRING), 4, '0'), '":',
                    CASE WHEN {ITEM_NULL} THEN 'null' WHEN {ITEM_BARE} THEN {text} ELSE concat('"', {text}, '"') END)))"""


# How the columns travel through the star join: what is mostly small, and texts or near them,
# the name that is nearly each row's own last.
LINE_SMALL = {"l_shipdate": travel.DAY, "l_quantity": travel.NUMBER, "l_linenumber": travel.DIGITS,
              "l_returnflag": travel.LETTER, "l_linestatus": travel.LETTER}
ORDER_SMALL = {"o_orderstatus": travel.LETTER, "o_orderdate": travel.DAY}
LINE_TEXTS = ("p_name", "p_brand", "p_type", "p_size", "s_name")
ORDER_TEXTS = ("c_mktsegment", "o_orderpriority", "c_nationkey", "c_name")
CELL = "_cell"


def _cells(n: int, parts: int, suppliers: int) -> tuple[int, int]:
    """How many classes of parts and of suppliers make at most ``n`` cells; a part is
    copied for each class of suppliers and the other way round, in all as little as can be."""
    by_supplier = min(n, max(1, round((n * suppliers / max(1, parts)) ** 0.5)))
    return n // by_supplier, by_supplier


def _class(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(n)).cast("int")


def _lines(t: dict[str, DataFrame], n: int, kinds: dict[str, travel.Kind], by_part: int, by_supplier: int) -> DataFrame:
    """Lines with their supplier and part, dealt out by their order.  Lines are shuffled once for
    both joins, to a cell of one class of parts and one of suppliers, whose rows are copied to
    every cell of their class: far fewer bytes than the lines' second shuffle."""
    cell = (_class("l_partkey", by_part) * by_supplier + _class("l_suppkey", by_supplier)).alias(CELL)
    lines = t["lineitem"].where("l_orderkey IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL")      # others join nothing
    lines = travel.longs(lines.select(cell, "*"), "_line", kinds).repartitionById(n, CELL)
    keys = travel.longs_columns(lines, "_line", kinds)
    suppliers = t["supplier"].select("*", F.explode(F.sequence(F.lit(0), F.lit(by_part - 1))).alias("_s_cell"))
    suppliers = suppliers.withColumn("_s_cell", F.col("_s_cell") * by_supplier + _class("s_suppkey", by_supplier))
    parts = t["part"].select("*", F.explode(F.sequence(F.lit(0), F.lit(by_supplier - 1))).alias("_p_cell"))
    parts = parts.withColumn("_p_cell", F.col("_p_cell") + _class("p_partkey", by_part) * by_supplier)
    lines = (lines.withColumns({c: keys[c] for c in ("l_suppkey", "l_partkey")})
             .join(suppliers.repartitionById(n, "_s_cell").hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))
             .where(F.col(CELL) == F.col("_s_cell"))
             .join(parts.repartitionById(n, "_p_cell").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
             .where(F.col(CELL) == F.col("_p_cell")))
    # equal texts next to each other, and what varies side by side, which compresses best
    lines = travel.joined(lines.sortWithinPartitions(*LINE_TEXTS[:-1]), "_texts", LINE_TEXTS)
    longs = travel.in_longs("_line", kinds)
    lines = lines.select(*longs, *(f"{c}_apart" for c in (*longs, "_texts")), "_texts")
    columns = travel.longs_columns(lines, "_line", kinds)
    lines = lines.repartition(n, columns["l_orderkey"])
    return lines.select(*(x.alias(c) for c, x in (columns | travel.joined_columns(lines, "_texts", LINE_TEXTS)).items()))


def _orders(t: dict[str, DataFrame], n: int, kinds: dict[str, travel.Kind]) -> DataFrame:
    """Orders with their customer, likewise."""
    orders = t["orders"].where("o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
    longs = travel.in_longs("_order", kinds)
    orders = travel.longs(orders, "_order", kinds).select("o_custkey", *longs, *(f"{c}_apart" for c in longs), "o_orderpriority")
    orders = orders.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).sortWithinPartitions(*ORDER_TEXTS[:-1])
    orders = travel.joined(orders, "_texts", ORDER_TEXTS)
    orders = orders.select("c_custkey", *longs, *(f"{c}_apart" for c in (*longs, "_texts")), "_texts")
    columns = travel.longs_columns(orders, "_order", kinds)
    orders = orders.repartition(n, columns["o_orderkey"])
    return orders.select("c_custkey", *(x.alias(c) for c, x in (columns | travel.joined_columns(orders, "_texts", ORDER_TEXTS)).items()))


def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star join behind the documents, with ``BASE_FIELDS`` evaluated."""
    t = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)
         for name, cols in SOURCE_COLUMNS.items()}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_rows, bits = {}, {}
    for name, key in (("part", "p_partkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")):
        n_rows[name], greatest = t[name].agg(F.count(F.lit(1)), F.max(key)).first()
        bits[name] = travel.key_bits(greatest)
    # the widest rows travel last and once, dealt as the next join needs it, so that small tables
    # make their documents in many tasks, too; nation and region, which stay small, come when
    # nothing is shuffled any more.  A key that a join makes equal to another is not carried.
    lines = _lines(t, n, {"l_orderkey": bits["orders"], "l_partkey": bits["part"], "l_suppkey": bits["supplier"], **LINE_SMALL},
                   *_cells(n, n_rows["part"], n_rows["supplier"]))
    o = _orders(t, n, {"o_orderkey": bits["orders"], **ORDER_SMALL})
    rows = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    keys = {"s_suppkey": "l_suppkey", "p_partkey": "l_partkey", "o_custkey": "c_custkey"}
    rows = rows.withColumns({k: F.col(same) for k, same in keys.items()})
    rows = (rows.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")))
    order = ("lineitem", "supplier", "part", "orders", "customer", "nation", "region")
    return rows.select(*[c for name in order for c in SOURCE_COLUMNS[name]],
                       *[F.expr(render(sql, "spark")).alias(name) for name, sql in BASE_FIELDS.items()])


# A field whose value is this one-character string is an explicit JSON null, an SQL NULL
# field is left out (missing key).
NULL = "chr(1)"
# which rows carry assessments without any item, and the item values of the others
BARE = "l_linestatus = 'O' AND l_returnflag = 'N'"
ALT_KEYS = ("id", "authority", "facility", "type", "ty pe")

# ---- one document's JSON text, put together from pieces -------------------------------
# Table texts and what is made of them, as JSON texts in columns (``json_columns``); every
# other field below is made of whole numbers, days and literals, which need no escape.
TEXTS = ("first_name", "last_name", "middle", "pclass", "n_name", "r_name", "s_name", "p_name", "p_brand", "p_type",
         "o_orderpriority", "l_returnflag", "l_linestatus", "dest_text", "dx1_code", "x_company", "display1")
IGNORED = "ignored"
# Characters that JSON escapes.
SPECIAL = r'["\\\x00-\x1f]'


class Lit(str):
    """A piece that stands in the text as it is; any other piece is SQL for a text."""


class Json(tuple):
    """Pieces of a JSON value; null, which leaves its key out, where one of them is."""


class Always(Json):
    """A value that is never null."""


def _concat(pieces) -> str:
    """SQL for the pieces' text, neighbouring literals as one."""
    out: list[str] = []
    for p in pieces:
        if isinstance(p, Lit) and out and isinstance(out[-1], Lit):
            out[-1] = Lit(out[-1] + p)
        else:
            out.append(p)
    return "concat(" + ", ".join(f"'{p}'" if isinstance(p, Lit) else p for p in out) + ")"


def _lit(text: str) -> Always:
    """A literal text (without anything to escape) or null."""
    return Always([Lit(f'"{text}"')])


_NULL = Always([Lit("null")])


def _cell(column: str) -> Json:
    """One of ``TEXTS``."""
    return Json([f"json_{column}"])


def _bare(column: str) -> Json:
    """A field without anything to escape."""
    return Json([Lit('"'), column, Lit('"')])


def _key(column: str) -> Always:
    """Likewise, made of a key that a join has found, so that it is never null."""
    return Always(_bare(column))


def _obj(**members: Json | None) -> Always:
    """An object; keys of null values are left out."""
    pieces, given, seen = [Lit("{")], {k: v for k, v in members.items() if v is not None}, False
    sure = any(isinstance(v, Always) for v in given.values())
    for k, v in given.items():
        name, comma = f'"{k}":', Lit(",")
        if isinstance(v, Always):
            pieces += [*([comma] if seen else []), Lit(name), *v]
            seen = True
        else:       # the comma stands on the side of a member that is always there
            member = [Lit(name), *v, comma] if sure and not seen else [Lit("," + name), *v]
            pieces.append(f"coalesce({_concat(member)}, '')")
    if not sure and len(given) == 1:
        ((k, v),) = given.items()
        pieces[1:] = [f"coalesce({_concat([Lit(chr(34) + k + chr(34) + ':'), *v])}, '')"]
    elif not sure:
        pieces[1:] = [f"substr({_concat(pieces[1:])}, 2)"]
    return Always([*pieces, Lit("}")])


def _list(*elements: tuple[str, Json]) -> Always:
    """An array, each element in it when its condition holds."""
    if elements[0][0] != "true":
        some = ", ".join(f"CASE WHEN {cond} THEN {_concat(v)} END" for cond, v in elements)
        return Always([Lit("["), f"concat_ws(',', {some})", Lit("]")])
    more = [f"CASE WHEN {cond} THEN {_concat([Lit(','), *v])} ELSE '' END" for cond, v in elements[1:]]
    return Always([Lit("["), *elements[0][1], *more, Lit("]")])


def _case(*branches: tuple[str, Json | None], default: Json | None = None) -> Json:
    def value(v):
        return "CAST(NULL AS STRING)" if v is None else _concat(v)
    whens = " ".join(f"WHEN {cond} THEN {value(v)}" for cond, v in branches)
    return Json([f"CASE {whens} ELSE {value(default)} END"])


def json_columns(rows: DataFrame) -> DataFrame:
    """``TEXTS`` and the destination to be ignored as JSON texts, ``json_<name>``.  A row without
    any special character, as nearly all are, is looked through once, not once a text."""
    rows = rows.withColumn("_special", F.concat_ws(
        "", "c_name", "c_mktsegment", "n_name", "r_name", "s_name", "p_name", "p_brand", "p_type", "o_orderpriority",
        "l_returnflag", "l_linestatus").rlike(SPECIAL))

    def escaped(text: Column) -> Column:
        # a lambda, which keeps this projection out of whole-stage code, too (``with_document_text``)
        return F.transform(F.array(text), lambda x: F.when(x == F.expr(NULL), "null").when(
            x.isNotNull(), F.trim(F.to_json(F.array(x)), F.lit("[]"))))[0]

    texts = {t: t for t in TEXTS} | {IGNORED: "'ignored-' || dest_name"}
    return rows.withColumns({f"json_{t}": F.when(F.col("_special"), escaped(F.expr(sql))).otherwise(F.concat(F.lit('"'), F.expr(sql), F.lit('"')))
                             for t, sql in texts.items()}).drop("_special")


def document_sections() -> dict[str, Json]:
    """The sections of one document over ``json_columns``, in order.  Of the assessments, those
    with a payload lack what dense payloads add and all that follows it (``_assessments``)."""
    def alt(**f):
        return _obj(**{k: f.get(k) for k in ALT_KEYS})

    dest = _obj(id=_key("dest_id"), name=_cell("n_name"), careSetting=_cell("r_name"), alternateIdentifiers=_list(
        ("l_returnflag <> 'N'", alt(id=_key("alt_s_id"), authority=_lit("npi"), facility=_cell("s_name"), type=_lit("supplier"))),
        ("l_returnflag <> 'N' AND l_linestatus = 'O'", alt(id=_key("alt_p_id"), authority=_cell("p_brand"), type=_cell("p_type")))))
    disposition = _cell("o_orderpriority")
    discharge = _case(
        ("c_mktsegment = 'AUTOMOBILE'", None),
        ("c_mktsegment = 'BUILDING'", _obj(disposition=disposition, destination=dest)),
        ("c_mktsegment = 'FURNITURE'", _obj(disposition=disposition, destination=_cell("dest_text"))),
        ("c_mktsegment = 'HOUSEHOLD'", _obj(disposition=disposition, inception=_bare("admit"), destinationDescription=dest,
                                            destination=_cell(IGNORED))),
        default=_obj(disposition=_NULL, destinationDescription=_NULL, destination=dest))
    name = _case(
        ("c_mktsegment = 'AUTOMOBILE'", None),
        ("c_mktsegment = 'HOUSEHOLD'", _obj(first=_NULL, last=_NULL, middle=_NULL, title=_NULL, suffix=_NULL)),
        default=_obj(first=_cell("first_name"), last=_cell("last_name"), middle=_cell("middle"), title=_NULL, suffix=_NULL))
    identifiers = _case(("n_ids = 0 AND l_returnflag = 'N'", None), default=_list(
        ("n_ids >= 1", _obj(id=_key("id1"), authority=_lit("cms"), type=_lit("mc"))),
        ("n_ids >= 2", _obj(id=_key("id2"), authority=_cell("r_name"), type=_lit("mrn"), facility=_cell("n_name")))))
    flags, none = "l_returnflag || l_linestatus", Always([Lit("[]")])
    emerg1, emerg2 = (Always([f"coalesce(json_{c}, 'null')"]) for c in ("s_name", "n_name"))
    phones = _case((f"({flags}) IN ('AF', 'AO')", _list(("true", _key("phone1")), ("true", _key("phone2")))),
                   (f"({flags}) = 'NF'", _list(("true", _key("phone1")))), (f"({flags}) = 'RF'", none))
    emergency = _case((f"({flags}) IN ('AO', 'NF')", _list(("true", emerg1))), (f"({flags}) = 'RF'", none),
                      (f"({flags}) = 'RO'", _list(("true", emerg1), ("true", emerg2))))
    demographics = _obj(id=_key("dem_id"), name=name, dob=_bare("dob"), sex=_key("sex"), identifiers=identifiers,
                        expirationIndicator=Json(["CAST(expired AS STRING)"]), patientClass=_cell("pclass"),
                        phoneNumbers=phones, emergencyContacts=emergency)
    diagnoses = _case(("o_orderstatus = 'P'", None), default=_list(
        ("true", _obj(method=_lit("icd10"), code=_cell("dx1_code"), description=_cell("p_name"), priority=_lit("primary"),
                      type=_lit("admitting"))),
        ("l_returnflag <> 'N'", _obj(method=_lit("icd9"), code=_key("dx2_code"), priority=_lit("secondary"), type=_lit("working"))),
        ("l_linestatus = 'F'", _obj(method=_lit("snomed"), code=_key("dx3_code"), description=_cell("s_name"),
                                    type=_cell("o_orderpriority")))))
    payors = _list(
        ("true", _obj(companyName=_cell("last_name"), policyNumber=_key("policy1"), effectiveDate=_bare("admit"), expiresDate=_NULL,
                      priority=_lit("primary"))),
        ("l_linestatus = 'O'", _obj(policy=_obj(payor=_obj(name=_obj(name=_cell("n_name"))), policyNumber=_key("policy2")),
                                    effectiveDate=_bare("disch"), priority=_lit("secondary"))),
        ("l_returnflag = 'R'", _obj(policy=_NULL, companyName=_cell("x_company"))))
    npi = {"id": _key("alt_s_id"), "authority": _lit("npi")}
    fac_alts = Always(_case(
        ("l_returnflag = 'A'", _list(("true", alt(**npi, facility=_NULL, **{"ty pe": _lit("npi")})))),
        ("l_linestatus = 'O'", _list(("true", alt(**npi, type=_lit("npi"))),
                                     ("true", alt(id=_key("alt_c_id"), authority=_lit("tin"), facility=_cell("s_name"), type=_lit("tin"))))),
        default=none))
    facility = _case(("n_regionkey = 0", None), ("n_regionkey = 1", _NULL),
                     default=_obj(id=_key("fac_id"), name=_cell("n_name"), careSetting=_cell("r_name"), alternateIdentifiers=fac_alts))
    documents = _list(
        ("true", _obj(filename=_bare("file1"), displayFilename=_cell("display1"), filetype=_lit("pdf"), dataType=_lit("wardReport"))),
        ("l_returnflag = 'R'", _obj(filename=_bare("file2"), filetype=_lit("xml"), dataType=_lit("labResults"))))

    note = _lit("outside the dictionary")
    status = _case(("l_linestatus = 'O'", _NULL), default=_cell("l_linestatus"))
    items = _obj(L_ORDERKEY=_key("k_orderkey"), L_PARTKEY=_key("k_partkey"), L_SUPPKEY=_key("k_suppkey"),
                 L_LINENUMBER=Json(["CAST(l_linenumber AS STRING)"]), L_QUANTITY=_bare("k_quantity"),
                 L_RETURNFLAG=_cell("l_returnflag"), L_LINESTATUS=status, L_SHIPDATE=_bare("k_shipday"), EXTRA_NOTE=note)

    # payloads without any dictionary item, in three writings: {}, unknown keys
    # only, and no payload at all
    empty, unknown = _obj(), _obj(EXTRA_NOTE=note)

    def asmt(id, type, at, data):
        return _obj(id=_bare(id), type=type, occurredAt=_bare(at), assessmentData=data)

    first = Always(asmt("asmt1_id", _key("asmt1_type"), "disch", items)[:-2])       # both braces open
    second = Always(asmt("asmt2_id", _lit("mds"), "admit", items)[:-2])
    others = _list(
        *((BARE, asmt("asmt3_id", _lit("mds"), "admit", p)) for p in (
            empty, unknown, _case(("l_linenumber < 0", empty)))),
        *((BARE, asmt("asmt3_id", _lit("oasis"), "admit", p)) for p in (empty, unknown)))[1]
    return {"demographics": demographics, "diagnoses": diagnoses, "documents": documents, "dischargeInfo": discharge,
            "payors": payors, "facility": facility, "first": first, "second": _case(("l_linestatus = 'F'", second)),
            "others": Json([f"nullif({others}, '')"])}


def _assessments() -> Always:
    """The assessments, whole; in some documents the second one comes twice."""
    second = ["second", "more_second", Lit("}}")]
    twice = f"CASE WHEN twice THEN {_concat([Lit(','), *second])} ELSE '' END"
    return Always([Lit("["), "first", "more_first", Lit("}}"), f"coalesce({_concat([Lit(','), *second, twice])}, '')",
                   f"coalesce({_concat([Lit(','), 'others'])}, '')", Lit("]")])


def with_dense_items(rows: DataFrame) -> DataFrame:
    """What dense payloads add, ``more_oasis`` and ``more_mds``, null in other rows.  There are
    but so many of them, which are made once and joined (some MB); keys below 0 have their own."""
    kinds = ("oasis", "mds")
    more = {kind: f"concat(',', {dense_items(kind)})" for kind in kinds}
    periods = rows.sparkSession.range(ITEM_PERIOD).withColumnRenamed("id", "l_orderkey").select(
        F.col("l_orderkey").alias("_period"), *[F.expr(sql).alias(f"_{kind}") for kind, sql in more.items()])
    period = F.expr(f"CASE WHEN {DENSE} AND l_orderkey >= 0 THEN l_orderkey % {ITEM_PERIOD} END")
    rows = rows.join(F.broadcast(periods), period == F.col("_period"), "left")
    return rows.withColumns({f"more_{kind}": F.expr(f"CASE WHEN {DENSE} AND l_orderkey < 0 THEN {more[kind]} ELSE _{kind} END")
                             for kind in kinds}).drop("_period", *[f"_{kind}" for kind in kinds])


def with_document_text(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the JSON text ``value`` of the documents over ``joined_rows``."""
    sections = document_sections()
    # One projection, whose lambdas keep it out of whole-stage code: there it would be one method
    # of 20 kB, which the JVM never compiles; as it is, it is many small ones.
    text = json_columns(with_dense_items(rows)).select(
        *keep, "ver", "pid", "admit", "disch", F.expr("l_returnflag = 'A'").alias("twice"),
        F.expr("coalesce(CASE l_returnflag WHEN 'R' THEN more_oasis ELSE more_mds END, '')").alias("more_first"),
        F.expr("transform(array(more_mds), x -> coalesce(x, ''))[0]").alias("more_second"),
        *[F.expr(_concat(v)).alias(name) for name, v in sections.items()])
    given = {name: type(v)([name]) for name, v in sections.items()}
    whole = _obj(version=_key("ver"), id=_key("pid"), admitDate=_bare("admit"), dischargeDate=_bare("disch"),
                 demographics=given["demographics"], diagnoses=given["diagnoses"], documents=given["documents"],
                 assessments=_assessments(), dischargeInfo=given["dischargeInfo"], payors=given["payors"], facility=given["facility"])
    # a generated column is computed once, however many filters and columns above read it
    return text.select(*keep, F.explode(F.array(F.expr(_concat(whole)))).alias("value"))


# Documents that do not fit, one per supplier, by s_suppkey % 10: sections and
# elements of the wrong kind, and a line that breaks off (6).
MISFIT_SECTIONS = {
    0: """'"documents":"zz"'""",
    1: """'"demographics":"text"'""",
    2: """'"demographics":{"id":"D' || k || '","identifiers":{"id":"x"}}'""",
    3: """'"dischargeInfo":"text"'""",
    4: """'"facility":["x"]'""",
    5: """'"diagnoses":[{"method":"m","code":"c' || k || '"},"bad"]'""",
    6: """'"documents":[{"filename":"f'""",
    7: """'"dischargeInfo":{"disposition":"d","destination":{"id":"i' || k || '","alternateIdentifiers":{"id":"x"}}}'""",
    8: """'"payors":{"companyName":"x"}'""",
    9: """'"assessments":"none"'""",
}


def ordinal(part: str, first: str, second: str) -> str:
    """SQL for a document's place: part of the corpus, then the two keys."""
    return f"named_struct('part', {part}, 'first', CAST({first} AS BIGINT), 'second', CAST({second} AS BIGINT))"


def misfit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document that does not fit for every supplier, as ``build_documents`` gives them."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.expr("CAST(s_suppkey AS STRING)").alias("k"), "s_suppkey")
    section = "CASE s_suppkey % 10 " + " ".join(f"WHEN {n} THEN {sql}" for n, sql in MISFIT_SECTIONS.items()) + " END"
    return s.select(F.expr(ordinal("1", "s_suppkey", "NULL")).alias(ORDINAL), F.expr(f"""concat('{{"id":"S', k, '","version":"2.7",', {section},
        CASE WHEN s_suppkey % 10 = 6 THEN '' ELSE '}}' END)""").alias("value"))


def build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON document text ``value``, one row per lineitem, and those that do not fit.
    ``_doc`` orders them: by their keys, so that "first" has a meaning that SQL can
    state, then the misfits.  Nothing is sorted or stored for it."""
    rows = joined_rows(spark, sf_dir).withColumn(ORDINAL, F.expr(ordinal("0", "l_orderkey", "l_linenumber")))
    text = with_document_text(rows, ORDINAL)
    return text.unionAll(misfit_documents(spark, sf_dir))


TURN_ITEMS = ("TURN", "ROLE", "TEXT")
_NULL_TEXT = '"\\\\u0001"'     # how to_json writes ``NULL``, escaped for an SQL literal


def conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per conversation turn (no grouping): the turn is an
    assessment whose type is the speaker role and whose payload holds the
    whole text."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    asmt = f"""named_struct('id', CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING), 'type', role, 'occurredAt', CAST(turn AS STRING),
        'assessmentData', named_struct('TURN', turn, 'ROLE', role, 'TEXT', coalesce(text, {NULL})))"""
    doc = (f"replace(to_json(named_struct('version', '2.7', 'id', CAST(conv_id AS STRING), "
           f"'assessments', array({asmt}))), '{_NULL_TEXT}', 'null')")
    return c.select(F.expr(doc).alias("value"))


_KEYS: dict[tuple[str, str], str] = {}


def _corpus_key(spark: SparkSession, sf_dir: str) -> str:
    """Names the corpus by what it is made of: the document rule, and name,
    length and time of every input file (listed once per application)."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _KEYS:
        paths = [f"{sf_dir}/{t}.parquet" for t in [*SOURCE_COLUMNS, "conversations"]]
        files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime").collect()
        parts = [CORPUS_VERSION, repr(document_sections()), repr(_assessments()), dense_items("oasis"), dense_items("mds"), repr(MISFIT_SECTIONS), repr(sorted(BASE_FIELDS.items())),
                 *sorted(f"{r[0]} {r[1]} {r[2]}" for r in files)]
        _KEYS[known] = hashlib.sha1("\n".join(parts).encode()).hexdigest()[:16]
    return _KEYS[known]


def _root(spark: SparkSession, sf_dir: str) -> str:
    return f"{shared_dir(spark)}/docshred-corpus/{_corpus_key(spark, sf_dir.rstrip('/'))}"


def corpus(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write (once) the documents and the two dictionaries for ``sf_dir``: a copy for
    the bench and the scripts, about 75 times the tables' size.  The queries read
    ``build_documents`` and ``dictionaries`` instead.

    Returns paths: ``documents`` and ``conversations`` (JSON lines), ``oasis`` and
    ``mds`` (dictionary CSV).  Every part is a published run (``sources.runs``), so
    sessions that build the same corpus at a time never meet each other's files."""
    root = _root(spark, sf_dir)
    paths = {"documents": publish_once(spark, f"{root}/documents", lambda p: build_documents(spark, sf_dir).orderBy(ORDINAL).select("value").write.text(p)),
             "conversations": publish_once(spark, f"{root}/conversations",
                                           lambda p: conversation_documents(spark, sf_dir).write.text(p))}
    return paths | dictionaries(spark, sf_dir)


def dictionaries(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write (once) the two dictionaries; returns their paths by name."""
    return {kind: publish_once(spark, f"{_root(spark, sf_dir)}/dict_{kind}",
                               lambda p, k=kind: write_dictionary(spark, dictionary_items(k), p))
            for kind in ("oasis", "mds")}


def staged(spark: SparkSession, sf_dir: str) -> str:
    """Parquet copy of the parsed documents (one JSON parse, then nested column
    pruning per table); written once next to the corpus.  Returns its path."""
    return publish_once(spark, f"{_root(spark, sf_dir)}/staged",
                        lambda p: stage(spark, corpus(spark, sf_dir)["documents"], p))


def stage(spark: SparkSession, json_path: str, out: str) -> None:
    with_stored_helpers(read_documents(spark, json_path, ordinal=True), clinical_specs()).write.mode("overwrite").parquet(out)


def staged_items(spark: SparkSession, sf_dir: str, specs, dictionaries) -> dict[str, list[str]]:
    """Dictionary items that occur in the documents, found once and stored (at most
    one row per dictionary name)."""
    path = publish_once(spark, f"{_root(spark, sf_dir)}/items", lambda p: occurring_items(
        well_formed(read_documents(spark, build_documents(spark, sf_dir), sections=["assessments"])),
        specs, dictionaries).coalesce(1).write.parquet(p))
    return items_by_dictionary(spark.read.parquet(path))
