"""The twelve patient-record tables (T1-T8 / C1-C8) and their checks (Q1-Q12).

Output names, column names and column order are the fixed values of the
original output contract (including the ``phoneNumer`` spelling).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docshred.functions.json_fields import array_len, has_key, key_fallback, raw_array_len, zip_arrays
from docshred.plans.spec import Element, TableSpec, WideSpec
from docshred.sources.documents import CORRUPT

# ---- fixed values of the output contract ---------------------------------------------
TABLE_NAMES = (
    "patientInfo", "demographicIdentifiers", "Contacts", "discharge",
    "dischargeDestinationIdentifiers", "diagnoses", "payors", "facility",
    "facilityIdentifiers", "documents", "oasis", "mds",
)
CONTACT_PHONE_COLUMN = "phoneNumer"       # spelled so in the output contract
OASIS_TYPE, MDS_TYPE = "oasis", "mds"
DISCHARGE_FIELDS = "disposition string, inception string, destination string, destinationDescription string"
DESTINATION_FIELDS = ["id", "name", "careSetting"]
ALT_ID = "id string, authority string, facility string, type string"
DESTINATION_OBJECTS = ", ".join(
    f"{key} struct<id:string,name:string,careSetting:string,alternateIdentifiers:array<string>>"
    for key in ("destination", "destinationDescription"))
PAYOR_FIELDS = ("companyName string, policyNumber string, effectiveDate string, expiresDate string, "
                "priority string, policy struct<payor:struct<name:struct<name:string>>,policyNumber:string>")
# ---------------------------------------------------------------------------------------

col = F.col


def _keys():
    return (("patient_id", lambda: col("id")), ("PAA_version", lambda: col("version")))


def _e(field: str):
    return Element(lambda e: e[field])


def _discharge():
    return F.from_json(col("dischargeInfo"), DISCHARGE_FIELDS)


def _destination_object():
    """The destination as an object, null for any other kind.  The kind is
    decided by the parser, before quotes are gone: text that merely looks like
    an object stays text.  destinationDescription counts when that key exists."""
    return key_fallback("destinationDescription", F.from_json(col("dischargeInfo"), DESTINATION_OBJECTS),
                        col("dischargeInfo"), "destination")


# helper columns of the discharge tables: two parses of dischargeInfo (as text
# and as objects), each once per document; the last one holds what the tables read
DISCHARGE_PREPARE = (
    ("_d", _discharge),
    ("_dest_obj", _destination_object),
    ("_discharge", lambda: F.struct(
        col("_d")["inception"].alias("inception"), col("_d")["disposition"].alias("disposition"),
        F.when(col("_dest_obj").isNull(), key_fallback("destinationDescription", col("_d"), col("dischargeInfo"), "destination")
               ).alias("scalar"),
        col("_dest_obj").alias("object"))),
)


def _destination_part(i: int):
    field = DESTINATION_FIELDS[i]
    d = "_discharge"
    return lambda: F.when(col(d)["object"].isNotNull(), col(d)["object"][field]).otherwise(col(d)["scalar"])


def _alternates():
    return col("_discharge")["object"]["alternateIdentifiers"]


def _destination_alternates():
    return F.transform(_alternates(), lambda e: F.from_json(e, ALT_ID))


def _destination_alternates_misfit():
    """1 where the destination's alternates are there but no array."""
    raw = F.when(has_key(col("dischargeInfo"), "destinationDescription"),
                 F.get_json_object("dischargeInfo", "$.destinationDescription.alternateIdentifiers")
                 ).otherwise(F.get_json_object("dischargeInfo", "$.destination.alternateIdentifiers"))
    # the text is looked at only where there is an object without alternates
    doubtful = col("_discharge")["object"].isNotNull() & _alternates().isNull()
    return F.when(doubtful, raw.isNotNull().cast("int")).otherwise(0)


def _destination_alternates_bad():
    """Alternates that are no objects."""
    return F.coalesce(F.size(F.filter(_alternates(), lambda e: e.isNull() | (
        F.substring(F.ltrim(e), 1, 1) != "{"))), F.lit(0))


def _destination_alternate_count():
    return F.coalesce(F.size(_alternates()), F.lit(0))


# helper column of the payors table: one parse and one key test per element
PAYOR_PREPARE = (
    ("_payors", lambda: F.transform("payors", lambda e: F.struct(
        F.from_json(e, PAYOR_FIELDS).alias("q"), has_key(e, "policy").alias("nested")))),
)


def _by_shape(nested_value, flat: str):
    """Element column of a parsed payor by its shape."""
    return Element(lambda x: F.when(x["nested"], nested_value(x["q"]["policy"])).otherwise(x["q"][flat]))


def _flat(field: str):
    return Element(lambda x: x["q"][field])


_payor_company = _by_shape(lambda policy: policy["payor"]["name"]["name"], "companyName")
_payor_policy_number = _by_shape(lambda policy: policy["policyNumber"], "policyNumber")


def _contacts():
    return zip_arrays(col("demographics.phoneNumbers"), col("demographics.emergencyContacts"),
                      (CONTACT_PHONE_COLUMN, "emergencyContacts"))


def _assessment_count(kind: str):
    # ``assessments.type`` (not a lambda over the element) lets the scan read
    # only that field of the staged documents
    return lambda: F.coalesce(F.size(F.filter(col("assessments.type"), lambda t: t == kind)), F.lit(0))


def _raw_assessment_count(kind: str):
    def fn():
        raw = F.from_json(F.get_json_object(col(CORRUPT), "$.assessments"), "array<string>")
        types = F.transform(raw, lambda x: F.get_json_object(x, "$.type"))
        return F.coalesce(F.size(F.filter(types, lambda t: t == kind)), F.lit(0))
    return fn


def _assessment_keys():
    """The assessments with every field but the payload: same elements, same
    order, built from field arrays so the scan can skip the payload column."""
    a = "assessments"
    return F.arrays_zip(col(f"{a}.id"), col(f"{a}.type"), col(f"{a}.occurredAt"),
                        F.array_repeat(F.lit(None).cast("string"), F.size(col(f"{a}.id")))
                        ).cast("array<struct<id:string,type:string,occurredAt:string,assessmentData:string>>")


def _raw_contacts():
    return F.greatest(raw_array_len(col(CORRUPT), "$.demographics.phoneNumbers"),
                      raw_array_len(col(CORRUPT), "$.demographics.emergencyContacts"))


def _wide_columns(prefix: str):
    return _keys() + ((f"{prefix}_id", _e("id")), (f"{prefix}_occurredAt", _e("occurredAt")))


def clinical_specs() -> tuple[TableSpec, ...]:
    k = _keys()
    return (
        TableSpec(
            "patientInfo", ("admitDate", "dischargeDate", "demographics"),
            k + (("admitDate", lambda: col("admitDate")),
                 ("dischargeDate", lambda: col("dischargeDate")),
                 ("demographicID", lambda: col("demographics.id")),
                 ("firstName", lambda: col("demographics.name.first")),
                 ("lastName", lambda: col("demographics.name.last")),
                 ("middleInitial", lambda: col("demographics.name.middle")),
                 ("title", lambda: col("demographics.name.title")),
                 ("suffix", lambda: col("demographics.name.suffix")),
                 ("dob", lambda: col("demographics.dob")),
                 ("sex", lambda: col("demographics.sex")),
                 ("expirationIndicator", lambda: col("demographics.expirationIndicator").try_cast("boolean")),
                 ("patientClass", lambda: col("demographics.patientClass"))),
            expected=lambda: F.lit(1), expected_raw=lambda: F.lit(1),
            depends=("demographics", "demographics.name"),
            gates=("patient_id", "PAA_version", "admitDate", "firstName")),
        TableSpec(
            "demographicIdentifiers", ("demographics",),
            k + (("additionalDemID", _e("id")), ("additionalDemAuthority", _e("authority")),
                 ("additionalDemType", _e("type")), ("additionalDemFacility", _e("facility"))),
            rows=lambda: col("demographics.identifiers"),
            expected=lambda: array_len("demographics.identifiers"),
            expected_raw=lambda: raw_array_len(col(CORRUPT), "$.demographics.identifiers"),
            depends=("demographics", "demographics.identifiers"),
            gates=("patient_id", "PAA_version", "additionalDemID")),
        TableSpec(
            "Contacts", ("demographics",),
            k + ((CONTACT_PHONE_COLUMN, _e(CONTACT_PHONE_COLUMN)),
                 ("emergencyContacts", _e("emergencyContacts"))),
            rows=_contacts, renames=((CONTACT_PHONE_COLUMN, "phoneNumber"),),
            # one row per position of the longer array (the zip pads the other)
            expected=lambda: F.greatest(array_len("demographics.phoneNumbers"),
                                        array_len("demographics.emergencyContacts")),
            expected_raw=_raw_contacts,
            depends=("demographics", "demographics.phoneNumbers", "demographics.emergencyContacts"),
            gates=("patient_id", "PAA_version")),
        TableSpec(
            "discharge", ("dischargeInfo",),
            k + (("inception", lambda: col("_discharge")["inception"]),
                 ("disposition", lambda: col("_discharge")["disposition"]),
                 ("destination_id", _destination_part(0)),
                 ("destination_name", _destination_part(1)),
                 ("destination_careSetting", _destination_part(2))),
            where=lambda: col("dischargeInfo").isNotNull(),
            document_prepare=DISCHARGE_PREPARE,
            expected=lambda: col("dischargeInfo").isNotNull().cast("int"),
            expected_raw=lambda: col("dischargeInfo").isNotNull().cast("int"),
            depends=("dischargeInfo",),
            gates=("patient_id", "PAA_version", "disposition")),
        TableSpec(
            "dischargeDestinationIdentifiers", ("dischargeInfo",),
            k + (("destination_id", _e("id")), ("destination_authority", _e("authority")),
                 ("destination_facility", _e("facility")), ("destination_type", _e("type"))),
            document_prepare=DISCHARGE_PREPARE, rows=_destination_alternates,
            expected=_destination_alternate_count,
            misfit=_destination_alternates_misfit, misfit_elements=_destination_alternates_bad,
            depends=("dischargeInfo",),
            gates=("patient_id", "PAA_version", "destination_id")),
        TableSpec(
            "diagnoses", ("diagnoses",),
            k + (("method", _e("method")), ("code", _e("code")), ("description", _e("description")),
                 ("priority", _e("priority")), ("type", _e("type"))),
            rows=lambda: col("diagnoses"),
            expected=lambda: array_len("diagnoses"),
            expected_raw=lambda: raw_array_len(col(CORRUPT), "$.diagnoses"),
            depends=("diagnoses",),
            gates=("patient_id", "PAA_version", "code", "method"), reported=("type",)),
        TableSpec(
            "payors", ("payors",),
            k + (("companyName", _payor_company), ("policyNumber", _payor_policy_number),
                 ("effectiveDate", _flat("effectiveDate")),
                 ("expiresDate", _flat("expiresDate")),
                 ("priority", _flat("priority"))),
            rows=lambda: col("_payors"), document_prepare=PAYOR_PREPARE,
            expected=lambda: array_len("payors"),
            expected_raw=lambda: raw_array_len(col(CORRUPT), "$.payors"),
            depends=("payors",),
            gates=("patient_id", "PAA_version", "companyName", "policyNumber")),
        TableSpec(
            "facility", ("facility",),
            k + (("facilityId", lambda: col("facility.id")),
                 ("facilityName", lambda: col("facility.name")),
                 ("facilityCareSetting", lambda: col("facility.careSetting"))),
            where=lambda: col("facility").isNotNull(),
            expected=lambda: col("facility").isNotNull().cast("int"),
            expected_raw=lambda: F.expr(
                f"CASE WHEN get_json_object({CORRUPT}, '$.facility') IS NULL THEN 0 ELSE 1 END"),
            depends=("facility",),
            gates=("patient_id", "PAA_version", "facilityId", "facilityName"),
            reported=("facilityCareSetting",)),
        TableSpec(
            "facilityIdentifiers", ("facility",),
            k + (("facilityAltid", _e("id")), ("facilityAltauthority", _e("authority")),
                 ("facilityAltfacility", _e("facility")), ("facilityAlttype", _e("type"))),
            rows=lambda: col("facility.alternateIdentifiers"),
            expected=lambda: array_len("facility.alternateIdentifiers"),
            expected_raw=lambda: raw_array_len(col(CORRUPT), "$.facility.alternateIdentifiers"),
            depends=("facility", "facility.alternateIdentifiers"),
            gates=("patient_id", "PAA_version", "facilityAltid", "facilityAlttype")),
        TableSpec(
            "documents", ("documents",),
            k + (("fileName", _e("filename")), ("displayFilename", _e("displayFilename")),
                 ("filetype", _e("filetype")), ("dataType", _e("dataType"))),
            rows=lambda: col("documents"),
            expected=lambda: array_len("documents"),
            expected_raw=lambda: raw_array_len(col(CORRUPT), "$.documents"),
            depends=("documents",),
            gates=("patient_id", "PAA_version", "fileName", "displayFilename")),
        TableSpec(
            "oasis", ("assessments",), _wide_columns("oasis"),
            rows=lambda: col("assessments"),
            element_where=Element(lambda e: e["type"] == OASIS_TYPE),
            wide=WideSpec(payload=_e("assessmentData"), dictionary="oasis", keys_only_rows=_assessment_keys),
            expected=_assessment_count(OASIS_TYPE), expected_raw=_raw_assessment_count(OASIS_TYPE),
            depends=("assessments",),
            gates=("patient_id", "PAA_version", "oasis_id")),
        TableSpec(
            "mds", ("assessments",), _wide_columns("mds"),
            rows=lambda: col("assessments"),
            element_where=Element(lambda e: e["type"] == MDS_TYPE),
            wide=WideSpec(payload=_e("assessmentData"), dictionary="mds", keys_only_rows=_assessment_keys),
            expected=_assessment_count(MDS_TYPE), expected_raw=_raw_assessment_count(MDS_TYPE),
            depends=("assessments",),
            gates=("patient_id", "PAA_version", "mds_id")),
    )


def spec_by_name(name: str) -> TableSpec:
    for s in clinical_specs():
        if s.name == name:
            return s
    raise KeyError(name)
