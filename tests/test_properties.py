"""
zipped contacts = Σ max(len) of the two arrays, checks agree with tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docshred.operators.quality import expected_counts
from docshred.operators.shredder import shred
from docshred.plans.clinical import clinical_specs, spec_by_name
from docshred.sources.documents import read_documents, well_formed

text = st.sampled_from(["a", "b", None])
maybe_list = st.one_of(st.none(), st.lists(text, max_size=4))
doc = st.fixed_dictionaries({
    "id": st.sampled_from(["p1", "p2"]), "version": st.just("1"),
    "demographics": st.fixed_dictionaries({
        "identifiers": st.one_of(st.none(), st.lists(st.fixed_dictionaries({"id": text}), max_size=3)),
        "phoneNumbers": maybe_list, "emergencyContacts": maybe_list}),
    "diagnoses": st.one_of(st.none(), st.lists(st.fixed_dictionaries({"code": text, "method": text}), max_size=4)),
    "payors": st.lists(st.one_of(st.fixed_dictionaries({"companyName": text}),
                                 st.fixed_dictionaries({"policy": st.none()})), max_size=3),
    "assessments": st.lists(st.fixed_dictionaries({"id": text, "type": st.sampled_from(["oasis", "mds", "x"]),
                                                   "assessmentData": st.fixed_dictionaries({"M0010": text})}),
                            max_size=3),
})


def _n(xs):
    return len(xs) if xs else 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(doc, min_size=1, max_size=6))
def test_row_counts_follow_array_sizes(spark, write_lines, docs):
    df = well_formed(read_documents(spark, write_lines(docs)))
    dicts = {"oasis": ["M0010"], "mds": ["M0010"]}
    got = {s.name: shred(df, s, dicts).count() for s in clinical_specs()}
    assert got["patientInfo"] == len(docs)
    assert got["demographicIdentifiers"] == sum(_n(d["demographics"]["identifiers"]) for d in docs)
    assert got["Contacts"] == sum(max(_n(d["demographics"]["phoneNumbers"]),
                                      _n(d["demographics"]["emergencyContacts"])) for d in docs)
    assert got["diagnoses"] == sum(_n(d["diagnoses"]) for d in docs)
    assert got["payors"] == sum(_n(d["payors"]) for d in docs)
    assert got["oasis"] == sum(1 for d in docs for a in d["assessments"] if a["type"] == "oasis")
    assert got["mds"] == sum(1 for d in docs for a in d["assessments"] if a["type"] == "mds")
    exp = {r.table: r.expected_rows for r in expected_counts(df, clinical_specs()).collect()}
    assert exp == got                                       # checks agree with the tables
    assert shred(df, spec_by_name("Contacts")).where("patient_id IS NULL").count() == 0
