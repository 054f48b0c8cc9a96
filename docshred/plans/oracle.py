"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement computes, straight from the relational driver tables, the table
that shredding the generated documents must give.  The scalar values come from
``nest.BASE_FIELDS``; which rows exist and which values are null is written out
here independently, as plain UNION ALL / CASE / GROUP BY SQL.
"""

from __future__ import annotations

from docshred.plans import nest
from docshred.plans.clinical import TABLE_NAMES
from docshred.plans.queries import EVENT_ITEMS, TABLE_QUERIES, USER_ROLE

V = "CAST(NULL AS VARCHAR)"
KEYS = 'pid AS patient_id, ver AS "PAA_version"'


def base_cte() -> str:
    cols = ", ".join(c for cols in nest.SOURCE_COLUMNS.values() for c in cols)
    fields = ",\n  ".join(f"{nest.render(sql, 'duckdb')} AS {name}" for name, sql in nest.BASE_FIELDS.items())
    return f"""base AS (
  SELECT {cols},
  {fields}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey)"""


# documents that do not fit: one per supplier, its kind by the last digit of the key
MISFIT_CTE = """bad AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS k, 'S' || CAST(s_suppkey AS VARCHAR) AS pid, '2.7' AS ver, s_suppkey % 10 AS kind
  FROM supplier)"""

# what they hold all the same
MISFIT_ROWS = {
    "patientInfo": f"""SELECT {KEYS}, {V}, {V}, CASE WHEN kind = 2 THEN 'D' || k END, {V}, {V}, {V}, {V}, {V}, {V}, {V},
  CAST(NULL AS BOOLEAN), {V} FROM bad WHERE kind <> 6""",
    "discharge": f"""SELECT {KEYS}, {V}, CASE WHEN kind = 7 THEN 'd' END, CASE WHEN kind = 7 THEN 'i' || k END, {V}, {V}
FROM bad WHERE kind IN (3, 7)""",
    "diagnoses": f"""SELECT {KEYS}, 'm', 'c' || k, {V}, {V}, {V} FROM bad WHERE kind = 5
UNION ALL SELECT {KEYS}, {V}, {V}, {V}, {V}, {V} FROM bad WHERE kind = 5""",
}
MISFIT_EXPECTED = {"patientInfo": "(kind <> 6)::INT", "discharge": "(kind IN (3, 7))::INT", "diagnoses": "2 * (kind = 5)::INT",
                   "facility": "(kind = 4)::INT"}       # there, so a row is called for; its kind gives none
# kinds whose section a table's rows come from, and kinds with an element that is no object
MISFIT_KINDS = {
    "patientInfo": "1", "demographicIdentifiers": "1, 2", "Contacts": "1", "discharge": "3",
    "dischargeDestinationIdentifiers": "3, 7", "payors": "8", "facility": "4", "facilityIdentifiers": "4",
    "documents": "0", "oasis": "9", "mds": "9"}
MISFIT_ELEMENT_KINDS = {"diagnoses": "5"}


def _payload(kind: str, narrow: bool) -> str:
    items = [
        'k_orderkey AS "L_ORDERKEY"', 'k_partkey AS "L_PARTKEY"', 'k_suppkey AS "L_SUPPKEY"',
        'CAST(l_linenumber AS VARCHAR) AS "L_LINENUMBER"', 'k_quantity AS "L_QUANTITY"',
        'l_returnflag AS "L_RETURNFLAG"',
        "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_linestatus END AS \"L_LINESTATUS\"",
        'k_shipday AS "L_SHIPDATE"',
    ]
    if not narrow:
        items += [f"""CASE WHEN l_orderkey % 64 = 0 AND (l_orderkey + {i}) % 5 < 2 AND (l_orderkey + {i}) % 13 <> 0
  THEN CAST((l_orderkey + {i}) % 7 AS VARCHAR) END AS "{kind.upper()}_ITEM_{i:04d}\"""" for i in nest.dense_positions(kind)]
    return ", ".join(items)


BARE = "l_linestatus = 'O' AND l_returnflag = 'N'"


def _no_items(kind: str, narrow: bool) -> str:
    names = nest.PAYLOAD_ITEMS if narrow else nest.dictionary_items(kind)
    return ", ".join(f'{V} AS "{n}"' for n in names)


def table_sql(name: str, narrow: bool = False) -> str:
    """Body (no WITH) of one of the twelve tables, before dedup.  ``narrow``
    leaves out the dictionary columns that follow from ``L_ORDERKEY``."""
    more = MISFIT_ROWS.get(name)
    return _fitting_sql(name, narrow) + (f"\nUNION ALL {more}" if more else "")


def _fitting_sql(name: str, narrow: bool) -> str:
    fs = "l_returnflag || l_linestatus"
    seg = "c_mktsegment"
    if name == "patientInfo":
        named = f"{seg} NOT IN ('AUTOMOBILE', 'HOUSEHOLD')"
        return f"""SELECT {KEYS}, admit AS "admitDate", disch AS "dischargeDate", dem_id AS "demographicID",
  CASE WHEN {named} THEN first_name END AS "firstName",
  CASE WHEN {named} THEN last_name END AS "lastName",
  CASE WHEN {named} THEN middle END AS "middleInitial",
  {V} AS title, {V} AS suffix, dob, sex, expired AS "expirationIndicator", pclass AS "patientClass"
FROM base"""
    if name == "demographicIdentifiers":
        return f"""SELECT {KEYS}, id1 AS "additionalDemID", 'cms' AS "additionalDemAuthority",
  'mc' AS "additionalDemType", {V} AS "additionalDemFacility" FROM base WHERE n_ids >= 1
UNION ALL SELECT {KEYS}, id2, r_name, 'mrn', n_name FROM base WHERE n_ids >= 2"""
    if name == "Contacts":
        return f"""SELECT {KEYS}, phone1 AS "phoneNumer", emerg1 AS "emergencyContacts" FROM base WHERE {fs} IN ('AO', 'NF')
UNION ALL SELECT {KEYS}, phone1, {V} FROM base WHERE {fs} = 'AF'
UNION ALL SELECT {KEYS}, phone2, {V} FROM base WHERE {fs} IN ('AF', 'AO')
UNION ALL SELECT {KEYS}, {V}, emerg1 FROM base WHERE {fs} = 'RO'
UNION ALL SELECT {KEYS}, {V}, emerg2 FROM base WHERE {fs} = 'RO'"""
    if name == "discharge":
        return f"""SELECT {KEYS},
  CASE WHEN {seg} = 'HOUSEHOLD' THEN admit END AS inception,
  CASE WHEN {seg} = 'MACHINERY' THEN NULL ELSE disposition END AS disposition,
  CASE {seg} WHEN 'BUILDING' THEN dest_id WHEN 'FURNITURE' THEN dest_text WHEN 'HOUSEHOLD' THEN dest_id END AS destination_id,
  CASE {seg} WHEN 'BUILDING' THEN dest_name WHEN 'FURNITURE' THEN dest_text WHEN 'HOUSEHOLD' THEN dest_name END AS destination_name,
  CASE {seg} WHEN 'BUILDING' THEN dest_care WHEN 'FURNITURE' THEN dest_text WHEN 'HOUSEHOLD' THEN dest_care END AS "destination_careSetting"
FROM base WHERE {seg} <> 'AUTOMOBILE'"""
    if name == "dischargeDestinationIdentifiers":
        obj = f"{seg} IN ('BUILDING', 'HOUSEHOLD') AND l_returnflag <> 'N'"
        return f"""SELECT {KEYS}, alt_s_id AS destination_id, 'npi' AS destination_authority,
  s_name AS destination_facility, 'supplier' AS destination_type FROM base WHERE {obj}
UNION ALL SELECT {KEYS}, alt_p_id, p_brand, {V}, p_type FROM base WHERE {obj} AND l_linestatus = 'O'"""
    if name == "diagnoses":
        return f"""SELECT {KEYS}, 'icd10' AS method, dx1_code AS code, p_name AS description,
  'primary' AS priority, 'admitting' AS type FROM base WHERE o_orderstatus <> 'P'
UNION ALL SELECT {KEYS}, 'icd9', dx2_code, {V}, 'secondary', 'working' FROM base
  WHERE o_orderstatus <> 'P' AND l_returnflag <> 'N'
UNION ALL SELECT {KEYS}, 'snomed', dx3_code, s_name, {V}, o_orderpriority FROM base
  WHERE o_orderstatus <> 'P' AND l_linestatus = 'F'"""
    if name == "payors":
        return f"""SELECT {KEYS}, c_mktsegment AS "companyName", policy1 AS "policyNumber",
  admit AS "effectiveDate", {V} AS "expiresDate", 'primary' AS priority FROM base
UNION ALL SELECT {KEYS}, n_name, policy2, disch, {V}, 'secondary' FROM base WHERE l_linestatus = 'O'
UNION ALL SELECT {KEYS}, {V}, {V}, {V}, {V}, {V} FROM base WHERE l_returnflag = 'R'"""
    if name == "facility":
        return f"""SELECT {KEYS}, fac_id AS "facilityId", n_name AS "facilityName",
  r_name AS "facilityCareSetting" FROM base WHERE n_regionkey NOT IN (0, 1)"""
    if name == "facilityIdentifiers":
        fac = "n_regionkey NOT IN (0, 1)"
        return f"""SELECT {KEYS}, alt_s_id AS "facilityAltid", 'npi' AS "facilityAltauthority",
  {V} AS "facilityAltfacility", {V} AS "facilityAlttype" FROM base WHERE {fac} AND l_returnflag = 'A'
UNION ALL SELECT {KEYS}, alt_s_id, 'npi', {V}, 'npi' FROM base
  WHERE {fac} AND l_returnflag <> 'A' AND l_linestatus = 'O'
UNION ALL SELECT {KEYS}, alt_c_id, 'tin', s_name, 'tin' FROM base
  WHERE {fac} AND l_returnflag <> 'A' AND l_linestatus = 'O'"""
    if name == "documents":
        return f"""SELECT {KEYS}, file1 AS "fileName", display1 AS "displayFilename", 'pdf' AS filetype,
  'wardReport' AS "dataType" FROM base
UNION ALL SELECT {KEYS}, file2, {V}, 'xml', 'labResults' FROM base WHERE l_returnflag = 'R'"""
    if name == "oasis":
        return f"""SELECT {KEYS}, asmt1_id AS oasis_id, disch AS "oasis_occurredAt", {_payload('oasis', narrow)}
FROM base WHERE l_returnflag = 'R'
UNION ALL SELECT {KEYS}, asmt3_id, admit, {_no_items('oasis', narrow)} FROM base, range(2) WHERE {BARE}"""
    if name == "mds":
        p = _payload("mds", narrow)
        return f"""SELECT {KEYS}, asmt1_id AS mds_id, disch AS "mds_occurredAt", {p} FROM base WHERE l_returnflag = 'A'
UNION ALL SELECT {KEYS}, asmt2_id, admit, {p} FROM base WHERE l_linestatus = 'F'
UNION ALL SELECT {KEYS}, asmt2_id, admit, {p} FROM base WHERE l_linestatus = 'F' AND l_returnflag = 'A'
UNION ALL SELECT {KEYS}, asmt3_id, admit, {_no_items('mds', narrow)} FROM base, range(3) WHERE {BARE}"""
    raise KeyError(name)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((base_cte(), MISFIT_CTE) + ctes) + "\n"


def _tables_cte(narrow: bool = True) -> list[str]:
    return [f't_{n} AS ({table_sql(n, narrow)})' for n in TABLE_NAMES]


# ---- fixed values: the checked columns of every table, and whether a null fails the check ----
CHECKED = {
    "patientInfo": (("patient_id", "PAA_version", "admitDate", "firstName"), ()),
    "demographicIdentifiers": (("patient_id", "PAA_version", "additionalDemID"), ()),
    "Contacts": (("patient_id", "PAA_version"), ()),
    "discharge": (("patient_id", "PAA_version", "disposition"), ()),
    "dischargeDestinationIdentifiers": (("patient_id", "PAA_version", "destination_id"), ()),
    "diagnoses": (("patient_id", "PAA_version", "code", "method"), ("type",)),
    "payors": (("patient_id", "PAA_version", "companyName", "policyNumber"), ()),
    "facility": (("patient_id", "PAA_version", "facilityId", "facilityName"), ("facilityCareSetting",)),
    "facilityIdentifiers": (("patient_id", "PAA_version", "facilityAltid", "facilityAlttype"), ()),
    "documents": (("patient_id", "PAA_version", "fileName", "displayFilename"), ()),
    "oasis": (("patient_id", "PAA_version", "oasis_id"), ()),
    "mds": (("patient_id", "PAA_version", "mds_id"), ()),
}
# -----------------------------------------------------------------------------------------------

# rows that the source documents call for, counted from the document rule alone
EXPECTED = {
    "patientInfo": "1",
    "demographicIdentifiers": "least(n_ids, 2)",
    "Contacts": "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 2 WHEN 'AO' THEN 2 WHEN 'RO' THEN 2 WHEN 'NF' THEN 1 ELSE 0 END",
    "discharge": "(c_mktsegment <> 'AUTOMOBILE')::INT",
    "dischargeDestinationIdentifiers": """CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AND l_returnflag <> 'N'
      THEN 1 + (l_linestatus = 'O')::INT ELSE 0 END""",
    "diagnoses": """CASE WHEN o_orderstatus = 'P' THEN 0
      ELSE 1 + (l_returnflag <> 'N')::INT + (l_linestatus = 'F')::INT END""",
    "payors": "1 + (l_linestatus = 'O')::INT + (l_returnflag = 'R')::INT",
    "facility": "(n_regionkey NOT IN (0, 1))::INT",
    "facilityIdentifiers": """CASE WHEN n_regionkey IN (0, 1) THEN 0 WHEN l_returnflag = 'A' THEN 1
      WHEN l_linestatus = 'O' THEN 2 ELSE 0 END""",
    "documents": "1 + (l_returnflag = 'R')::INT",
    "oasis": f"(l_returnflag = 'R')::INT + 2 * ({BARE})::INT",
    "mds": f"""(l_returnflag = 'A')::INT + (l_linestatus = 'F')::INT
      + (l_linestatus = 'F' AND l_returnflag = 'A')::INT + 3 * ({BARE})::INT""",
}


def _checked():
    return [(n, [(c, True) for c in gates] + [(c, False) for c in reported]) for n, (gates, reported) in CHECKED.items()]


def _expected_sql() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{n}' AS "table", CAST(coalesce((SELECT sum({e}) FROM base), 0)
  + coalesce((SELECT sum({MISFIT_EXPECTED.get(n, '0')}) FROM bad), 0) AS BIGINT) AS expected_rows"""
        for n, e in EXPECTED.items())


def _misfit_counts_sql() -> str:
    def count(kinds: str) -> str:
        return f"(SELECT CAST(count(*) AS BIGINT) FROM bad WHERE kind IN ({kinds}))"
    return "\nUNION ALL ".join(
        f"""SELECT '{n}' AS "table", {count(MISFIT_KINDS.get(n, 'NULL'))} AS misfit_sections,
  {count(MISFIT_ELEMENT_KINDS.get(n, 'NULL'))} AS misfit_elements""" for n in TABLE_NAMES)


def _report_sql() -> str:
    """The report from ex (expected rows), rc (rows), nc (null counts), mf (misfits) and rj (rejected lines)."""
    return """SELECT nc."table",
  ex.expected_rows, rc.n AS actual_rows,
  CASE WHEN ex.expected_rows = rc.n AND mf.misfit_sections = 0 THEN 'PASS' ELSE 'FAIL' END AS row_count_status,
  nc."column", nc.null_count, nc.gates,
  CASE WHEN rc.n = 0 THEN 'NOT_APPLICABLE'
       WHEN bool_or(nc.gates AND nc.null_count > 0) OVER (PARTITION BY nc."table") THEN 'FAIL'
       ELSE 'PASS' END AS completeness_status,
  CASE WHEN mf.misfit_sections > 0
       THEN printf('Row count for %s table not comparable: %d sections of the wrong kind (source %d, table %d)',
                   nc."table", mf.misfit_sections, ex.expected_rows, rc.n)
       WHEN ex.expected_rows = rc.n THEN printf('Row count for %s table matched: %d', nc."table", rc.n)
       ELSE printf('Row count mismatch for %s table: source %d, table %d', nc."table", ex.expected_rows, rc.n) END AS message,
  CASE WHEN rc.n = 0 THEN printf('Completeness of %s not applicable: no rows', nc."table")
       WHEN nc.null_count = 0 THEN printf('Completeness of %s.%s passed', nc."table", nc."column")
       ELSE printf('Null values in %s.%s: %d', nc."table", nc."column", nc.null_count) END AS completeness_message,
  rj.n AS rejected_lines, mf.misfit_sections, mf.misfit_elements
FROM nc JOIN rc ON nc."table" = rc."table" JOIN ex ON nc."table" = ex."table" JOIN mf ON nc."table" = mf."table", rj"""


def _row_counts_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", CAST(count(*) AS BIGINT) AS n FROM t_{n}" for n in TABLE_NAMES)


def _null_counts_sql() -> str:
    parts = []
    for name, cols in _checked():
        for c, gate in cols:
            parts.append(f"""SELECT '{name}' AS "table", '{c}' AS "column",
  CAST(count(*) FILTER (WHERE "{c}" IS NULL) AS BIGINT) AS null_count, {str(gate).lower()} AS gates FROM t_{name}""")
    return "\nUNION ALL ".join(parts)


def _sparse_report_sql() -> str:
    """Documents of one conversation turn each: a patientInfo row with its keys and nothing else."""
    def n(name: str) -> str:
        return "(SELECT CAST(count(*) AS BIGINT) FROM conversations)" if name == "patientInfo" else "CAST(0 AS BIGINT)"
    rows = "\nUNION ALL ".join(f"""SELECT '{t}' AS "table", {n(t)} AS expected_rows, {n(t)} AS n,
  CAST(0 AS BIGINT) AS misfit_sections, CAST(0 AS BIGINT) AS misfit_elements""" for t in TABLE_NAMES)
    nulls = "\nUNION ALL ".join(f"""SELECT '{t}' AS "table", '{c}' AS "column",
  {n(t) if c in ('admitDate', 'firstName') else 'CAST(0 AS BIGINT)'} AS null_count, {str(gate).lower()} AS gates"""
                               for t, cols in _checked() for c, gate in cols)
    return (f"WITH mf AS ({rows}), ex AS (SELECT * FROM mf), rc AS (SELECT * FROM mf), nc AS ({nulls}),\n"
            "rj AS (SELECT CAST(0 AS BIGINT) AS n)\n" + _report_sql())


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["scan_documents"] = _with() + """SELECT ver AS "PAA_version", CAST(count(*) AS BIGINT) AS n_documents,
  CAST(count(*) FILTER (WHERE no_discharge) AS BIGINT) AS n_without_discharge,
  CAST(count(*) FILTER (WHERE no_facility) AS BIGINT) AS n_without_facility
FROM (SELECT ver, c_mktsegment = 'AUTOMOBILE' AS no_discharge, n_regionkey IN (0, 1) AS no_facility FROM base
      UNION ALL SELECT ver, kind NOT IN (3, 7), true FROM bad WHERE kind <> 6)
GROUP BY ver"""
    for q, t in TABLE_QUERIES.items():
        out[q] = _with() + table_sql(t)
    items = ", ".join([f"json_extract_string(props, '$.k') AS k"]
                      + [f'{V} AS "{n}"' for n in EVENT_ITEMS[1:]])
    out["event_props_wide"] = f"SELECT event_id, event_type, {items} FROM events"
    out["conversation_roles"] = f"""SELECT CAST(conv_id AS VARCHAR) AS conv_id, '2.7' AS "PAA_version",
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS turn_id,
  CAST(turn AS VARCHAR) AS "turn_occurredAt", CAST(turn AS VARCHAR) AS "TURN", role AS "ROLE", text AS "TEXT"
FROM conversations WHERE role = '{USER_ROLE}'"""
    ids = ["demographicIdentifiers", "dischargeDestinationIdentifiers", "facilityIdentifiers"]
    out["union_tables"] = _with() + "\nUNION ALL BY NAME ".join(
        f"SELECT *, '{n}' AS source_table FROM ({table_sql(n)})" for n in ids)
    out["payor_positions"] = _with() + f"""SELECT {KEYS}, c_mktsegment AS "companyName", policy1 AS "policyNumber",
  admit AS "effectiveDate", {V} AS "expiresDate", 'primary' AS priority, CAST(0 AS INTEGER) AS _pos FROM base
UNION ALL SELECT {KEYS}, n_name, policy2, disch, {V}, 'secondary', CAST(1 AS INTEGER) FROM base WHERE l_linestatus = 'O'
UNION ALL SELECT {KEYS}, {V}, {V}, {V}, {V}, {V}, CAST(CASE WHEN l_linestatus = 'O' THEN 2 ELSE 1 END AS INTEGER)
FROM base WHERE l_returnflag = 'R'"""
    out["written_tables"] = _with() + "\nUNION ALL BY NAME ".join(
        f"SELECT *, '{n}' AS source_table FROM ({table_sql(n)})" for n in ("facility", "facilityIdentifiers"))
    out["drop_complete_duplicates"] = _with() + f"SELECT DISTINCT * FROM ({table_sql('diagnoses')})"
    out["first_facilities"] = _with() + f"""SELECT {KEYS}, fac_id AS "facilityId", n_name AS "facilityName",
  r_name AS "facilityCareSetting", arg_min(file1, (l_orderkey, l_linenumber)) AS first_file
FROM base WHERE n_regionkey NOT IN (0, 1) GROUP BY ALL"""
    out["row_stream_tables"] = _with() + "\nUNION ALL BY NAME ".join(
        f"SELECT DISTINCT *, '{n}' AS source_table FROM ({table_sql(n)})" for n in ids)
    out["mds_dedup"] = _with() + f"SELECT DISTINCT * FROM ({table_sql('mds')})"
    out["dq_expected_counts"] = _with() + _expected_sql()
    checks = (f"ex AS ({_expected_sql()})", f"rc AS ({_row_counts_sql()})", f"mf AS ({_misfit_counts_sql()})")
    out["dq_row_counts"] = _with(*_tables_cte(), *checks) + """SELECT rc."table", ex.expected_rows, rc.n AS actual_rows,
  CASE WHEN ex.expected_rows = rc.n AND mf.misfit_sections = 0 THEN 'PASS' ELSE 'FAIL' END AS row_count_status
FROM rc JOIN ex ON rc."table" = ex."table" JOIN mf ON rc."table" = mf."table\""""
    out["dq_null_counts"] = _with(*_tables_cte()) + _null_counts_sql()
    out["dq_report"] = _with(*_tables_cte(), *checks, f"nc AS ({_null_counts_sql()})",
                             "rj AS (SELECT CAST(count(*) AS BIGINT) AS n FROM bad WHERE kind = 6)") + _report_sql()
    out["dq_report_sparse"] = _sparse_report_sql()
    out["pipeline_summary"] = _with(*_tables_cte()) + "\nUNION ALL ".join(
        f"""SELECT '{n}' AS "table", (SELECT CAST(count(*) AS BIGINT) FROM t_{n}) AS rows_before_dedup,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT * FROM t_{n})) AS rows_after_dedup""" for n in TABLE_NAMES)
    return out
