import hashlib

import pytest
import zstandard

from docshred.llm.warc_zstd import (DICTIONARY_MAGIC, frames, parse_record, read_archives, record_bytes,
                                    train_dictionary, with_record_types, write_archives)

SCHEMA = "page_id bigint, url string, html string, payload_digest string, _first string"
BIG = "<p>" + "héllo " * 40 + "</p>"
ROWS = [(5, "http://a/", BIG), (2, "http://b/", BIG), (9, None, BIG), (3, "u", "tiny"), (4, "u", "tiny"), (6, "u", None),
        (7, "u", ""), (8, "line\nbreak", "P*M\x18\0\0\0\0" * 50), (None, "n", BIG), (2, "http://b/", BIG),
        (11, "u", "x" * 300_000)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def round_trip(spark, rows, path, dictionary=None):
    df = pages(spark, rows)
    write_archives(with_record_types(df), path, train_dictionary(df) if dictionary is None else dictionary)
    return read_archives(spark, path).collect()


def want(rows):
    """Record type and reference of every row by plain grouping."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = min(ids) if ids and len(raw) >= 100 else None
        again = first is not None and i != first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip_with_awkward_pages(spark, tmp_path):
    got = round_trip(spark, ROWS, str(tmp_path / "w"))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got), key=repr) == want(ROWS)
    assert all(r["digest_ok"] for r in got if r["record_type"] == "response")
    texts = {(r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response"}
    assert (8, ("P*M\x18\0\0\0\0" * 50).encode()) in texts and (11, b"x" * 300_000) in texts


def test_archive_starts_with_its_dictionary_and_holds_a_frame_a_record(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html><body>page number {i} of the same site " + "word " * (i % 7) + "</body></html>" * 3)
            for i in range(200)]
    df = pages(spark, rows).coalesce(1)
    dictionary = train_dictionary(df)
    assert dictionary
    write_archives(with_record_types(df).coalesce(1), str(tmp_path / "w"), dictionary)
    archive = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert archive[:4] == DICTIONARY_MAGIC.to_bytes(4, "little") and archive[8:8 + len(dictionary)] == dictionary
    data = [f for skip, f in frames(archive) if not skip]
    assert len(data) == 200
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert {parse_record(unpack.decompress(f))["page_id"] for f in data} == set(range(200))
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[0])


def test_no_dictionary_and_no_rows(spark, tmp_path):
    assert len(round_trip(spark, ROWS[:3], str(tmp_path / "a"), b"")) == 3
    assert round_trip(spark, [], str(tmp_path / "b")) == []


def test_damaged_record_is_refused():
    raw = record_bytes(1, "u", "response", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None)
    assert parse_record(raw)["digest_ok"]
    with pytest.raises(ValueError):
        parse_record(raw[:-3])
    assert not parse_record(raw.replace(b"abc", b"abd"))["digest_ok"]
