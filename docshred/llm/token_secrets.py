"""Secret scan by token efficiency.

Text that a tokenizer has learnt takes few tokens; random strings take many.  A
run of ``min_run`` or more key characters whose characters per token (tiktoken
vocabulary) fall to a limit or below is reported as ``random``, after known
digests (hexadecimal of a digest's length), UUIDs, plain numbers and word-like
identifiers are excluded; so are dates, phone and article numbers (no letter) in
runs of under 20 characters.  What a UUID or a pattern's span leaves of a run is
judged by itself, by the same rules.
Three fixed patterns (``assign``, ``access``, ``hex``) are always reported.

Null text counts as empty (no span).  Spans are code-point offsets, end
exclusive; no character of a pattern's span is reported a second time.
Repeated rows give one output row each; a null id stays null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import slices

# The patterns, their least lengths and the order of kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
DIGEST_LENGTHS = frozenset((32, 40, 48, 56, 64, 96, 128))
UUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
# End of fixed values.

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
_ACCESS = re.compile(ACCESS)
_HEX_RUN = re.compile(HEX)
_UUID = re.compile(UUID)
_PURE_HEX = re.compile(r"[0-9A-Fa-f]+")
# every access and hex match of its least length lies inside such a run
_BASE_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_JOINERS = "+/_=-"
_WORDLIKE = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|\d{1,4})(?:[_/=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|\d{1,4}))*")

SCHEMA = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
          "spans array<struct<kind:string,start:bigint,end:bigint>>")
MAX_CHARS_PER_TOKEN = 2.0
MIN_RUN = 16  # characters of the shortest run judged by its tokens
LONG_RUN = 20


@lru_cache(maxsize=4)
def _run(min_run: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9+/_=-]{{{min_run},}}")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    """The tiktoken encoding of a ranks file (one per worker process)."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def is_known(run: str) -> bool:
    """Digests, UUIDs, numbers and identifiers made of words and short numbers."""
    if run.isdigit() or _UUID.fullmatch(run):
        return True
    if len(run) < LONG_RUN and not any(c.isalpha() for c in run):
        return True
    if _PURE_HEX.fullmatch(run):
        return len(run) in DIGEST_LENGTHS
    return _WORDLIKE.fullmatch(run) is not None


def _parts(text: str, a: int, b: int, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """What the pattern spans and UUIDs leave of a run."""
    at = a
    taken = [(s, e) for _, s, e in base if s < b and a < e]
    for s, e in sorted([*taken, *((a + m.start(), a + m.end()) for m in _UUID.finditer(text[a:b]))]):
        if s > at:
            yield at, s
        at = max(at, e)
    if at < b:
        yield at, b


def scan(text: str, enc, max_ratio: float,
         min_run: int = MIN_RUN) -> tuple[list[tuple[str, int, int]], tuple[int, int, int]]:
    """All spans of one text by start then kind, and the counts of the fixed kinds."""
    spans: list[tuple[str, int, int]] = []
    folded = text.lower()
    if any(word in folded for word in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_VALUE_LENGTH]
    n_assign = len(spans)
    runs = [m.span() for m in _BASE_RUN.finditer(text)]
    n_access = n_hex = 0
    if runs:
        if "AKIA" in text:
            spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
        n_access = len(spans) - n_assign
        for a, b in runs:
            spans += [("hex", a + m.start(), a + m.end()) for m in _HEX_RUN.finditer(text[a:b])
                      if m.end() - m.start() >= HEX_LENGTH]
        n_hex = len(spans) - n_assign - n_access
    base = list(spans)
    for m in _run(min_run).finditer(text):
        for a, b in _parts(text, *m.span(), base):
            part = text[a:b]
            bare = part if (a, b) == m.span() else part.strip(_JOINERS)
            if b - a < min_run or is_known(bare):
                continue
            if len(part) <= max_ratio * len(enc.encode_ordinary(part)):
                spans.append(("random", a, b))
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans, (n_assign, n_access, n_hex)


def find_secrets(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 max_chars_per_token: float = MAX_CHARS_PER_TOKEN, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, counts, spans) per row of ``docs``; narrow, no shuffle.

    ``vocabulary`` is a tiktoken ranks file that every executor can read,
    ``pattern`` its split pattern."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(vocabulary, pattern)
        for batch in slices(batches):
            found = [scan(t or "", enc, max_chars_per_token, min_run) for t in batch.column(1).to_pylist()]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[k] for _, c in found], pa.int64()) for k in range(3)),
                 pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in sp] for sp, _ in found], pa.list_(kind))],
                ["doc_id", "n_assign", "n_access", "n_hex", "spans"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, SCHEMA)


def span_list(spans, base_only: bool = False):
    """Spans as ``kind:start:end`` joined by commas (a Spark expression)."""
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"] != "random")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(docs: DataFrame, vocabulary: str, pattern: str, mark: str = "[SECRET]", text_col: str = "text",
           max_chars_per_token: float = MAX_CHARS_PER_TOKEN, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping
    spans as one); other columns stay as they are.  Null text stays null."""

    @F.pandas_udf("string")
    def clean(texts):
        enc = encoding(vocabulary, pattern)
        return texts.map(lambda t: t if t is None or t != t else _replace(
            t, scan(t, enc, max_chars_per_token, min_run)[0], mark))

    return docs.withColumn(text_col, clean(F.col(text_col)))


def _replace(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
