"""Shredding the patient-record shape: the edge records of FIXTURES.md §3,
"""

import copy

import pytest

from docshred.operators.shredder import shred, widen
from docshred.plans.clinical import TABLE_NAMES, clinical_specs, spec_by_name
from docshred.sources.documents import read_documents, well_formed
from tests.conftest import rows

DICTS = {"oasis": ["M0010", "M0020", "M0030", "M0040", "M0050"], "mds": ["A0100", "A0200"]}

HAPPY = {
    "version": "2.7", "id": "p1", "admitDate": "2020-01-01 10:00:00.000", "dischargeDate": "2020-01-09 10:00:00.000",
    "demographics": {
        "id": "d1", "name": {"first": "MIRA", "last": "TOLL", "middle": "Q", "title": None, "suffix": None},
        "dob": "1940-02-02", "sex": "female", "expirationIndicator": False, "patientClass": "inpatient",
        "identifiers": [{"id": "X1", "authority": "reg", "type": "card"},
                        {"id": "X2", "authority": "site", "type": "chart", "facility": "F"}]},
    "dischargeInfo": {"disposition": "home", "destination": {
        "id": "h1", "name": "Home", "careSetting": "hha",
        "alternateIdentifiers": [{"id": "n1", "authority": "npi", "type": "npi"}]}},
    "diagnoses": [{"method": "icd10", "code": "Q11.1", "description": "first", "priority": "primary", "type": "admitting"},
                  {"method": "icd10", "code": "Q22.2", "description": "second", "priority": "primary", "type": "working"}],
    "payors": [{"companyName": "Medicare", "policyNumber": "9", "effectiveDate": "2019-01-01",
                "expiresDate": None, "priority": "primary"}],
    "facility": {"id": "f1", "name": "General", "careSetting": "acc",
                 "alternateIdentifiers": [{"id": "58", "authority": "npi", "facility": None, "ty pe": "npi"}]},
    "documents": [{"filename": "a.pdf", "displayFilename": "A", "filetype": "pdf", "dataType": "report"}],
    "assessments": [{"id": "as1", "type": "oasis", "occurredAt": "2020-01-02",
                     "assessmentData": {"M0010": "1", "M0020": "2"}}],
}


def _docs(spark, write_lines, records):
    return well_formed(read_documents(spark, write_lines(records)))


def _table(spark, write_lines, records, name):
    return shred(_docs(spark, write_lines, records), spec_by_name(name), DICTS)


def test_happy_path_all_tables(spark, write_lines):
    docs = _docs(spark, write_lines, [HAPPY])
    counts = {s.name: shred(docs, s, DICTS).count() for s in clinical_specs()}
    assert counts == {"patientInfo": 1, "demographicIdentifiers": 2, "Contacts": 0, "discharge": 1,
                      "dischargeDestinationIdentifiers": 1, "diagnoses": 2, "payors": 1, "facility": 1,
                      "facilityIdentifiers": 1, "documents": 1, "oasis": 1, "mds": 0}
    pi = shred(docs, spec_by_name("patientInfo")).first().asDict()
    assert pi == {"patient_id": "p1", "PAA_version": "2.7", "admitDate": "2020-01-01 10:00:00.000",
                  "dischargeDate": "2020-01-09 10:00:00.000", "demographicID": "d1", "firstName": "MIRA",
                  "lastName": "TOLL", "middleInitial": "Q", "title": None, "suffix": None, "dob": "1940-02-02",
                  "sex": "female", "expirationIndicator": False, "patientClass": "inpatient"}
    # the misspelled "ty pe" key leaves the type null
    assert rows(shred(docs, spec_by_name("facilityIdentifiers"))) == [("p1", "2.7", "58", "npi", None, None)]


def test_column_order_is_the_contract(spark, write_lines):
    docs = _docs(spark, write_lines, [HAPPY])
    assert shred(docs, spec_by_name("patientInfo")).columns == [
        "patient_id", "PAA_version", "admitDate", "dischargeDate", "demographicID", "firstName", "lastName",
        "middleInitial", "title", "suffix", "dob", "sex", "expirationIndicator", "patientClass"]
    assert shred(docs, spec_by_name("Contacts")).columns == [
        "patient_id", "PAA_version", "phoneNumer", "emergencyContacts"]
    oasis = shred(docs, spec_by_name("oasis"), DICTS)
    assert oasis.columns == ["patient_id", "PAA_version", "oasis_id", "oasis_occurredAt"] + DICTS["oasis"]


def test_missing_sections_give_no_child_rows(spark, write_lines):
    only = {"id": "p2", "version": "2.6", "demographics": {"id": "d2"}}
    nulls = {"id": "p3", "version": "2.6", "demographics": None, "dischargeInfo": None, "diagnoses": None,
             "payors": None, "facility": None, "documents": None, "assessments": None}
    empty = {"id": "p4", "version": "2.6", "demographics": {"identifiers": [], "phoneNumbers": [],
                                                            "emergencyContacts": []},
             "dischargeInfo": {"destination": {"alternateIdentifiers": []}}, "diagnoses": [], "payors": [],
             "facility": {"alternateIdentifiers": []}, "documents": [], "assessments": []}
    docs = _docs(spark, write_lines, [only, nulls, empty])
    counts = {s.name: shred(docs, s, DICTS).count() for s in clinical_specs()}
    assert counts == {"patientInfo": 3, "demographicIdentifiers": 0, "Contacts": 0, "discharge": 1,
                      "dischargeDestinationIdentifiers": 0, "diagnoses": 0, "payors": 0, "facility": 1,
                      "facilityIdentifiers": 0, "documents": 0, "oasis": 0, "mds": 0}


def test_missing_or_empty_name_keeps_row(spark, write_lines):
    a = {"id": "a", "version": "1", "demographics": {"id": "d"}}
    b = {"id": "b", "version": "1", "demographics": {"id": "d", "name": {}}}
    got = rows(_table(spark, write_lines, [a, b], "patientInfo"), "patient_id", "firstName", "lastName")
    assert got == [("a", None, None), ("b", None, None)]


def test_destination_text_that_looks_like_an_object_stays_text(spark, write_lines):
    recs = [{"id": str(i), "version": "1", "dischargeInfo": d} for i, d in enumerate([
        {"destination": "{Home} unit"}, {"destination": '{"id": "quoted"}'}, {"destination": {}}, {"destination": 7},
        {"destinationDescription": "{x}", "destination": {"id": "no"}}, {"destinationDescription": None, "destination": "no"},
        {"destination": {"id": "i", "name": 5, "alternateIdentifiers": [{"id": "a"}, "bad"]}}])]
    got = rows(_table(spark, write_lines, recs, "discharge"), "patient_id", "destination_id", "destination_name")
    assert got == [("0", "{Home} unit", "{Home} unit"), ("1", '{"id": "quoted"}', '{"id": "quoted"}'), ("2", None, None),
                   ("3", "7", "7"), ("4", "{x}", "{x}"), ("5", None, None), ("6", "i", "5")]
    alts = rows(_table(spark, write_lines, recs, "dischargeDestinationIdentifiers"), "patient_id", "destination_id")
    assert alts == [("6", "a"), ("6", None)]


def test_destination_scalar_fills_three_columns(spark, write_lines):
    rec = {"id": "s", "version": "1", "dischargeInfo": {"disposition": "snf", "destination": "Sunrise SNF"}}
    t = _table(spark, write_lines, [rec], "discharge")
    assert rows(t) == [("s", "1", None, "snf", "Sunrise SNF", "Sunrise SNF", "Sunrise SNF")]
    assert _table(spark, write_lines, [rec], "dischargeDestinationIdentifiers").count() == 0


def test_destination_description_present_null_wins(spark, write_lines):
    rec = {"id": "n", "version": "1", "dischargeInfo": {
        "disposition": "x", "destinationDescription": None,
        "destination": {"id": "z", "alternateIdentifiers": [{"id": "q"}]}}}
    assert rows(_table(spark, write_lines, [rec], "discharge"),
                "destination_id", "destination_name") == [(None, None)]
    assert _table(spark, write_lines, [rec], "dischargeDestinationIdentifiers").count() == 0


def test_destination_description_object_used(spark, write_lines):
    rec = {"id": "d", "version": "1", "dischargeInfo": {
        "inception": "2020", "destinationDescription": {"id": "dd", "name": "N", "careSetting": "c",
                                                        "alternateIdentifiers": [{"id": "a1", "type": "t"}]},
        "destination": "ignored"}}
    assert rows(_table(spark, write_lines, [rec], "discharge")) == [("d", "1", "2020", None, "dd", "N", "c")]
    assert rows(_table(spark, write_lines, [rec], "dischargeDestinationIdentifiers")) == [
        ("d", "1", "a1", None, None, "t")]


def test_payor_shapes(spark, write_lines):
    rec = {"id": "p", "version": "1", "payors": [
        {"policy": {"payor": {"name": {"name": "Aetna"}}, "policyNumber": "A7"}, "companyName": "ignored",
         "priority": "secondary", "effectiveDate": "e"},
        {"companyName": "Medicare", "policyNumber": "9", "priority": "primary"},
        {"policy": None, "companyName": "x"}]}
    got = rows(_table(spark, write_lines, [rec], "payors"), "companyName", "policyNumber", "effectiveDate", "priority")
    assert got == [("Aetna", "A7", "e", "secondary"), ("Medicare", "9", None, "primary"), (None, None, None, None)]


def test_contacts_zip_pads_and_broadcasts(spark, write_lines):
    recs = [{"id": "a", "version": "1", "demographics": {"phoneNumbers": ["1", "2"]}},
            {"id": "b", "version": "1", "demographics": {"phoneNumbers": ["1", "2"], "emergencyContacts": ["e"]}},
            {"id": "c", "version": "1", "demographics": {"phoneNumbers": ["1"], "emergencyContacts": ["e"]}},
            {"id": "d", "version": "1", "demographics": {"phoneNumbers": [{"n": 1}]}}]
    got = rows(_table(spark, write_lines, recs, "Contacts"))
    assert got == [("a", "1", "1", None), ("a", "1", "2", None), ("b", "1", "1", "e"), ("b", "1", "2", None),
                   ("c", "1", "1", "e"), ("d", "1", '{"n": 1}', None)]


def test_assessment_types_and_payload_rules(spark, write_lines):
    rec = {"id": "w", "version": "1", "assessments": [
        {"id": "o1", "type": "oasis", "occurredAt": "t",
         "assessmentData": {"M0010": "1", "M0020": None, "UNKNOWN": "dropped", "M0030": {"nested": [1, 2]},
                            "M0040": 5}},
        {"id": "m1", "type": "mds", "assessmentData": None},
        {"id": "x1", "type": "other", "assessmentData": {"M0010": "no"}},
        {"id": "n1", "type": None, "assessmentData": {"M0010": "no"}},
        {"id": "q1"}]}
    oasis = _table(spark, write_lines, [rec], "oasis")
    assert rows(oasis) == [("w", "1", "o1", "t", "1", None, '{"nested":[1,2]}', "5", None)]
    mds = _table(spark, write_lines, [rec], "mds")
    assert rows(mds) == [("w", "1", "m1", None, None, None)]       # null payload: kept, items null


def test_duplicate_key_last_wins(spark, write_lines):
    line = '{"id":"k","version":"1","assessments":[{"id":"m","type":"mds","assessmentData":{"A0100":"x","A0100":"y"}}]}'
    assert rows(_table(spark, write_lines, [line], "mds"), "A0100") == [("y",)]


def test_same_id_twice_no_cross_product(spark, write_lines):
    a = copy.deepcopy(HAPPY)
    b = copy.deepcopy(HAPPY)
    b["diagnoses"] = b["diagnoses"][:1]
    docs = _docs(spark, write_lines, [a, b])
    assert shred(docs, spec_by_name("patientInfo")).count() == 2
    assert shred(docs, spec_by_name("diagnoses")).count() == 3
    assert shred(docs, spec_by_name("demographicIdentifiers")).count() == 4


def test_null_keys_kept(spark, write_lines):
    rec = {"id": None, "version": "1", "diagnoses": [{"method": "m", "code": None}],
           "dischargeInfo": {"disposition": None}}
    assert rows(_table(spark, write_lines, [rec], "diagnoses"), "patient_id", "code") == [(None, None)]
    assert rows(_table(spark, write_lines, [rec], "discharge"), "disposition") == [(None,)]


def test_narrow_wide_form_widens_to_same_rows(spark, write_lines):
    docs = _docs(spark, write_lines, [HAPPY])
    spec = spec_by_name("oasis")
    assert rows(widen(shred(docs, spec, DICTS, widen=False))) == rows(shred(docs, spec, DICTS))


def test_dictionary_clash_with_key_column(spark, write_lines):
    docs = _docs(spark, write_lines, [HAPPY])
    with pytest.raises(ValueError):
        shred(docs, spec_by_name("oasis"), {"oasis": ["M0010", "oasis_id"]})


def test_specs_cover_the_twelve_tables():
    assert tuple(s.name for s in clinical_specs()) == TABLE_NAMES


def test_boolean_as_text_does_not_sink_demographics(spark, write_lines):
    recs = [{"id": "a", "version": "1", "demographics": {"expirationIndicator": "false", "identifiers": [{"id": "x"}]}},
            {"id": "b", "version": "1", "demographics": {"expirationIndicator": True}},
            {"id": "c", "version": "1", "demographics": {"expirationIndicator": "maybe"}}]
    assert rows(_table(spark, write_lines, recs, "patientInfo"), "patient_id", "expirationIndicator") == [
        ("a", False), ("b", True), ("c", None)]
    assert _table(spark, write_lines, recs, "demographicIdentifiers").count() == 1


def test_payload_keys_are_case_sensitive(spark, write_lines):
    rec = {"id": "k", "version": "1", "assessments": [{"id": "o", "type": "oasis",
                                                       "assessmentData": {"m0010": "lower", "M0020": "upper"}}]}
    assert rows(_table(spark, write_lines, [rec], "oasis"), "M0010", "M0020") == [(None, "upper")]


def test_positions_and_corrected_names_on_request(spark, write_lines):
    rec = {"id": "p", "version": "1", "payors": [{"companyName": "b"}, {"companyName": "a"}],
           "demographics": {"phoneNumbers": ["1", "2"]}}
    docs = _docs(spark, write_lines, [rec])
    assert rows(shred(docs, spec_by_name("payors"), positions=True), "_pos", "companyName") == [(0, "b"), (1, "a")]
    assert rows(shred(docs, spec_by_name("patientInfo"), positions=True), "_pos") == [(0,)]
    assert rows(shred(docs, spec_by_name("Contacts"), rename_fixes=True), "phoneNumber") == [("1",), ("2",)]
    assert "phoneNumer" in shred(docs, spec_by_name("Contacts")).columns
