"""Section-level entry points: one call per document section, returning that
section's tables (T1-T8 / C1-C8), for users who build one section at a time.

Each returns ``{table name: DataFrame}`` over a documents frame (from
``read_documents`` or a staged copy); nothing runs until an action.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from docshred.operators.shredder import shred
from docshred.plans.clinical import spec_by_name

# ---- fixed values: which tables each document section produces ------------------------
SECTIONS: dict[str, tuple[str, ...]] = {
    "pat_info": ("patientInfo", "demographicIdentifiers", "Contacts"),
    "dischargeInfo": ("discharge", "dischargeDestinationIdentifiers"),
    "diagnosesInfo": ("diagnoses",),
    "payorInfo": ("payors",),
    "facilityInfo": ("facility", "facilityIdentifiers"),
    "documentsInfo": ("documents",),
    "oasisInfo": ("oasis",),
    "mdsInfo": ("mds",),
}
# ---------------------------------------------------------------------------------------


def section_tables(docs: DataFrame, section: str,
                   dictionaries: Mapping[str, object] | None = None) -> dict[str, DataFrame]:
    return {name: shred(docs, spec_by_name(name), dictionaries) for name in SECTIONS[section]}


def patient_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "pat_info")


def discharge_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "dischargeInfo")


def diagnoses_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "diagnosesInfo")


def payor_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "payorInfo")


def facility_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "facilityInfo")


def documents_info(docs: DataFrame) -> dict[str, DataFrame]:
    return section_tables(docs, "documentsInfo")


def oasis_info(docs: DataFrame, dictionary) -> dict[str, DataFrame]:
    """``dictionary``: list of item names or a frame with column ``Colnames``."""
    return section_tables(docs, "oasisInfo", {"oasis": dictionary})


def mds_info(docs: DataFrame, dictionary) -> dict[str, DataFrame]:
    return section_tables(docs, "mdsInfo", {"mds": dictionary})
