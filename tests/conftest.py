from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docshred.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=8, app="docshred-tests")
    yield s


@pytest.fixture
def write_lines(tmp_path):
    """Write JSON lines (dicts are dumped, strings written as is) to a file."""
    counter = {"n": 0}

    def _write(lines) -> str:
        counter["n"] += 1
        p = tmp_path / f"docs{counter['n']}.json"
        with open(p, "w") as f:
            for ln in lines:
                f.write((ln if isinstance(ln, str) else json.dumps(ln)) + "\n")
        return str(p)
    return _write


def rows(df, *cols):
    """Rows as sorted tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
