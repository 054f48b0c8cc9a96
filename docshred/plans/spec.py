"""Declarative description of one output table (S4).

A ``TableSpec`` says which document sections a table reads, which array (if
any) becomes its rows, which filters apply, how each output column is
projected, and what the data-quality check expects.  Column expressions are
built by callables so specs can be declared before a session exists.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnFn = Callable[[], Column]


class Element:
    """A column of a row's element: as a projection of the exploded ``e``, or of any
    given element (``of``), for passes that look at all tables' rows at once."""

    def __init__(self, of: Callable[[Column], Column]):
        self.of = of

    def __call__(self) -> Column:
        return self.of(F.col("e"))


@dataclass(frozen=True)
class WideSpec:
    """Dictionary-driven projection of an open JSON object (P10)."""
    payload: ColumnFn           # raw JSON object text, per row after explode
    dictionary: str             # key into the dictionaries mapping given at build time
    # the exploded array without payloads (same elements): row counts and key
    # null counts need no payload, and this lets the scan skip reading it
    keys_only_rows: ColumnFn | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    sections: tuple[str, ...]                     # top-level fields read (scan pruning)
    columns: tuple[tuple[str, ColumnFn], ...]     # output name → projection, in order
    rows: ColumnFn | None = None                  # array whose elements become rows (alias ``e``)
    where: ColumnFn | None = None                 # document-level filter, before explode
    element_where: ColumnFn | None = None         # element-level filter, after explode
    wide: WideSpec | None = None
    # helper columns computed once per document, before the explode; the rules read
    # the last one only, which a stage may hold already
    document_prepare: tuple[tuple[str, ColumnFn], ...] = ()
    # helper columns computed once per row before ``columns`` (e.g. one parse
    # of a JSON text that several output columns read)
    prepare: tuple[tuple[str, ColumnFn], ...] = ()
    # corrected spellings of output columns, used on request only
    renames: tuple[tuple[str, str], ...] = ()
    # data quality
    expected: ColumnFn | None = None              # per-document source count (typed columns)
    expected_raw: ColumnFn | None = None          # same, from the raw line of a partially failed record
    depends: tuple[str, ...] = ()                 # paths of the sections the rows come from
    misfit: ColumnFn | None = None                # per-document count of misfit parts that no path names
    misfit_elements: ColumnFn | None = None       # same for elements
    gates: tuple[str, ...] = ()                   # null in any → completeness FAIL
    reported: tuple[str, ...] = ()                # null counts shown, never failing

    @property
    def column_names(self) -> list[str]:
        return [n for n, _ in self.columns]
