"""Section-level entry points cover the twelve tables exactly once."""

from docshred.plans import sections as S
from docshred.plans.clinical import TABLE_NAMES
from docshred.sources.documents import read_documents
from tests.test_shred import DICTS, HAPPY


def test_sections_cover_all_tables_once():
    names = [t for ts in S.SECTIONS.values() for t in ts]
    assert sorted(names) == sorted(TABLE_NAMES) and len(names) == len(set(names))


def test_section_calls(spark, write_lines):
    docs = read_documents(spark, write_lines([HAPPY]))
    got = {}
    for fn in (S.patient_info, S.discharge_info, S.diagnoses_info, S.payor_info, S.facility_info,
               S.documents_info):
        got.update({k: v.count() for k, v in fn(docs).items()})
    got.update({k: v.count() for k, v in S.oasis_info(docs, DICTS["oasis"]).items()})
    got.update({k: v.count() for k, v in S.mds_info(docs, DICTS["mds"]).items()})
    assert got == {"patientInfo": 1, "demographicIdentifiers": 2, "Contacts": 0, "discharge": 1,
                   "dischargeDestinationIdentifiers": 1, "diagnoses": 2, "payors": 1, "facility": 1,
                   "facilityIdentifiers": 1, "documents": 1, "oasis": 1, "mds": 0}
