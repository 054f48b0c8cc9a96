"""WARC archives compressed record by record with an embedded Zstandard dictionary.

Writing: payloads are digested (SHA-256); of records with equal payloads of at
least ``min_revisit`` bytes the one with the smallest id is the ``response`` and
the others are ``revisit`` records without payload.  A dictionary is trained on
a bounded sample of the records (``dictionary_sample`` bytes, a documented bound
on the one driver-side step).  Every partition becomes one archive: a leading
skippable frame (magic 0x184D2A5D) that holds the dictionary, then one frame per
record.  Archives are written by Spark's text writer: a row is one frame's raw
bytes and the line separator is an empty skippable frame, which readers skip.

Reading: each archive is read whole by ``binaryFile`` (its size follows the
input split that made it), its dictionary is taken from its own leading frame,
and every record is decompressed and its digest checked.

Null payload counts as empty.  Rows that repeat the smallest id are all
responses; null ids come last, and a class with no id at all has only responses.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docshred.llm.common import bounded_sample, slices, stored

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable frame 0x184D2A50 of length 0
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# End of fixed values.

RECORD_SCHEMA = ("page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
                 "payload_digest string, refers_to bigint, digest_ok boolean")


def record_bytes(page_id, url, record_type: str, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC record.  Header values hold no line breaks."""
    body = payload if record_type == "response" else b""
    head = [VERSION, f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if record_type == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join([*head, "", ""]).encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if len(body) != int(fields["Content-Length"]) or rest[len(body):] != b"\r\n\r\n":
        raise ValueError("WARC record is cut short")

    def urn(name: str):
        value = fields.get(name, "<urn:page:>")[len("<urn:page:"):-1]
        return int(value) if value else None

    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    response = fields["WARC-Type"] == "response"
    return {"page_id": urn("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "payload": body if response else None,
            "payload_bytes": int(fields["WARC-Payload-Length"]), "payload_digest": digest,
            "refers_to": urn("WARC-Refers-To"),
            "digest_ok": hashlib.sha256(body).hexdigest() == digest if response else None}


def frames(archive: bytes) -> Iterator[tuple[bool, bytes]]:
    """(is skippable, bytes) of each frame of an archive; a data frame's end is
    where the next skippable frame stands, as the writer puts one after each."""
    import zstandard

    at = 0
    while at < len(archive):
        magic, = struct.unpack_from("<I", archive, at)
        if SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
            size, = struct.unpack_from("<I", archive, at + 4)
            yield True, archive[at:at + 8 + size]
            at += 8 + size
            continue
        if archive[at:at + 4] != zstandard.FRAME_HEADER:
            raise ValueError("not a Zstandard frame")
        end = at + frame_size(archive, at)
        yield False, archive[at:end]
        at = end


def frame_size(data: bytes, at: int) -> int:
    """Length of the Zstandard frame at ``at``, from its header and block headers."""
    import zstandard

    view = memoryview(data)[at:at + 18]
    end = at + zstandard.frame_header_size(view)
    checksum = zstandard.get_frame_parameters(view).has_checksum
    last = False
    while not last:
        header = int.from_bytes(data[end:end + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        end += 3 + (1 if kind == 1 else size)  # a run-length block holds one byte
    return end - at + (4 if checksum else 0)


def train_dictionary(pages: DataFrame, dictionary_bytes: int = 64 << 10, dictionary_sample: int = 8 << 20,
                     id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> bytes:
    """A dictionary from whole records of a bounded sample; empty when there is
    too little to learn from."""
    import zstandard

    rows = pages.where(F.octet_length(payload_col) > 0).select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.encode(payload_col, "utf-8").alias("payload"))
    # no single record may fill the sample
    chosen = bounded_sample(rows.where(F.octet_length("payload") <= dictionary_sample // 16),
                            F.octet_length("payload"), dictionary_sample, F.struct("page_id", "payload"))
    samples = sorted(record_bytes(r["page_id"], r["url"], "response", bytes(r["payload"]), len(r["payload"]),
                                  hashlib.sha256(r["payload"]).hexdigest(), None) for r in chosen.collect())
    if len(samples) < 8:
        return b""
    try:
        size = min(dictionary_bytes, sum(map(len, samples)) // 8)
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_record_types(pages: DataFrame, min_revisit: int = 100, id_col: str = "page_id", payload_col: str = "html",
                      url_col: str = "url") -> DataFrame:
    """Pages with size, digest, record type and the response a revisit refers to.

    Digests are grouped with map-side combining; only digests of more than one
    id reach the join.  They are written first, so that the join shuffles both
    sides itself and adaptive execution may split a hot digest, or broadcast
    them where they are few."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.encode(F.col(payload_col).cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"),
                             "payload_digest": F.sha2("payload", 256)})
    first = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy(F.col("payload_digest").alias("_digest"))
             .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"), F.count("*").alias("_n"),
                  F.count("page_id").alias("_ids"))
             .where((F.col("_first") != F.col("_last")) | ((F.col("_ids") > 0) & (F.col("_ids") < F.col("_n"))))
             .select("_digest", "_first"))
    first = stored(first, "warc-first")
    joined = rows.join(first, F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("_first")).alias("refers_to"))


def write_archives(typed: DataFrame, path: str, dictionary: bytes, level: int = 3) -> None:
    """Write one archive per partition of ``typed`` (see ``with_record_types``) below ``path``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            out = [packer.compress(record_bytes(i, u, kind, p, n, d, ref))
                   for i, p, u, n, d, kind, ref in zip(*columns, strict=True)]
            if head:
                out.insert(0, head)
                head = b""
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = typed.select("page_id", "payload", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    (rows.mapInArrow(work, "frame binary").select(F.col("frame").cast("string"))
     .write.option("lineSep", EMPTY_FRAME).option("compression", "none").text(path))


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """All records of the archives below ``path`` (``keep_payload=False`` returns null payloads)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("refers_to", pa.int64()), ("digest_ok", pa.bool_())])
        for batch in batches:
            for content in batch.column(0):
                unpacker, out, held = zstandard.ZstdDecompressor(), [], 0
                for skippable, frame in frames(content.as_py()):
                    if skippable:
                        if frame[:4] == struct.pack("<I", DICTIONARY_MAGIC) and len(frame) > 8:
                            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame[8:]))
                        continue
                    record = parse_record(unpacker.decompress(frame))
                    held += len(record["payload"] or b"")
                    out.append(record if keep_payload else record | {"payload": None})
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(work, RECORD_SCHEMA)
