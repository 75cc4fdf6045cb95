"""WARC archives as seekable Zstandard bundles.

Every page becomes one WARC record. Records are grouped into independent Zstandard frames and frames
into bundle files; a bundle ends in a seek table (a skippable frame with the sizes of all frames), so
a reader finds a frame from the last bytes of the file alone. The index maps each record to its bundle,
frame and offset within the uncompressed frame; it is written next to the bundles, once all are there.

Of records with equal payloads (SHA-1) of at least ``least`` bytes, the one with the largest page_id
is a response with the payload, the others are revisits that refer to it. Deciding that moves digests
and page ids; only rows whose digest occurs again are then shuffled with their payload.

A bundle gets its final name by a rename from a name of its own attempt, and the index, written by
Spark's committer, names the bundles of the attempts that count: a retried task leaves at most a file
that nothing refers to. Files go through pyarrow, in the store that Spark means by the folder's path.

Defined results: null html is the empty payload; a null page_id counts as smaller than any other, has
no id in its record and is never referred to unless all are null (then all such rows are responses,
as are rows that tie on the largest page_id); very long payloads fill a frame of their own; a null
url is written as an empty target; an empty table writes an index without rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare
from tessera.session import scratch_path
from tessera.sources.ledger import Store, store_of

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
#: Packed bytes that a reading task fetches.
READ_BYTES = 4 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
# Magic numbers of the Zstandard seekable format.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = ("page_id bigint, bundle string, frame int, frame_start bigint, frame_size bigint, "
         "record_start bigint, record_size bigint")
READ = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "payload binary")


def folder_store(spark: SparkSession, folder: str) -> Store:
    """How tasks open files below ``folder``: the store that Spark's own file system means by that path."""
    store = store_of(spark, folder)
    if store is None:
        raise ValueError(f"{folder} lies in a store that pyarrow does not open")
    return store


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, record_type: str,
                 refers_to: int | None, length: int) -> bytes:
    """One WARC record; a revisit has the HTTP head without the payload."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    if record_type == "response":
        body += payload
    name = lambda n: f"<urn:page:{'' if n is None else n}>"
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}",
            "WARC-Target-URI: " + "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in url or ""),
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {name(refers_to)}"]
    head += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; payload is None for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(dict(h.split(": ", 1) for h in http.decode().split("\r\n")[1:])["Content-Length"])
    number = lambda s: int(s[len("<urn:page:"):-1]) if len(s) > len("<urn:page:>") else None
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "url": fields["WARC-Target-URI"],
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": length,
            "refers_to": number(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload}


class BundleWriter:
    """One bundle: frames are written as they fill up, the seek table at the end."""

    def __init__(self, store: Store):
        import zstandard
        self.fs, root = store.open(), store.place(store.prefix)
        self.fs.create_dir(root, recursive=True)
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.root = root
        self.out = self.fs.open_output_stream(f"{root}/.{self.name}", compression=None)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.written = 0
        self.frame = bytearray()
        self.in_frame: list[tuple] = []
        self.index: list[tuple] = []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.in_frame.append((page_id, len(self.frame), len(record)))
        self.frame += record
        if len(self.frame) >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.in_frame:
            return
        packed = self.compressor.compress(bytes(self.frame))
        self.out.write(packed)
        self.index += [(page_id, self.name, len(self.frames), self.written, len(packed), start, size)
                       for page_id, start, size in self.in_frame]
        self.frames.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame, self.in_frame = bytearray(), []

    def close(self) -> list[tuple]:
        """Finish the file under its final name; the index rows of its records."""
        self.end_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(f"{self.root}/.{self.name}", f"{self.root}/{self.name}")
        return self.index


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, packed size, size) of every frame, from the end of an open bundle."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * entry)
    table = file.read(count * entry)
    out, at = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", table, k * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` with digest (hex SHA-1 of the payload), record_type and refers_to."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    named = pages.withColumn("digest", F.sha1(payload))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= least
    # Which payloads occur again is decided by page ids and digests alone.
    again = (pages.select("page_id", F.sha1(payload).alias("digest"), long_enough.alias("counts")).filter("counts")
                  .groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).filter("n > 1").select("digest", "newest"))
    # Written first, so that a digest that most pages share can be split over tasks in the join.
    again = persist(again, "warc-again")
    # A bit set of their digests, of a fixed size: rows that miss it have a payload of their own and stay where they
    # are, so that such payloads are not shuffled. (A row that hits it by chance is looked up in vain.)
    place = lambda digest: F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")
    word, bit = F.shiftright(F.col("place"), 6), F.pmod(F.col("place"), F.lit(64)).cast("int")
    bits = (again.select(place("digest").alias("place")).groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")))
    bits = F.broadcast(persist(bits, "warc-bits"))  # 2^18 words at most
    placed = named.withColumn("place", place("digest")).withColumn("word", word).join(bits, "word", "left")
    hit = F.coalesce(F.call_function("shiftright", F.col("bits"), bit).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False))
    columns = named.columns
    revisit = (F.col("newest").isNotNull() & F.coalesce(F.col("page_id") < F.col("newest"), F.lit(True))
               if least == 0 else long_enough & F.col("newest").isNotNull() & F.coalesce(F.col("page_id") < F.col("newest"), F.lit(True)))
    alone = placed.filter(~hit).select(*columns, F.lit(None).cast(again.schema["newest"].dataType).alias("newest"))
    looked_up = placed.filter(hit).select(*columns).join(again, "digest", "left").select(*columns, "newest")
    return (alone.unionByName(looked_up)
                 .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
                 .withColumn("refers_to", F.when(revisit, F.col("newest"))))


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a record; returns the stored index."""
    prepare(pages.sparkSession)
    rows = decide(pages.select("page_id", "url", "html"), least).select("page_id", "url", "html", "digest", "record_type", "refers_to")
    store = folder_store(pages.sparkSession, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "bundle", "frame", "frame_start", "frame_size", "record_start", "record_size"]
        # Column by column: a null among the ids must not turn them into floats.
        frame = lambda rows: pd.DataFrame({n: pd.Series(c, dtype="str" if n == "bundle" else "Int64")
                                           for n, c in zip(names, zip(*rows))})
        writer = None
        for batch in batches:
            for page_id, url, html, digest, kind, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["digest"],
                                                                batch["record_type"], batch["refers_to"]):
                writer = writer or BundleWriter(store)
                payload = (html or "").encode("utf-8", "surrogatepass")
                page_id = None if pd.isna(page_id) else int(page_id)
                writer.add(page_id, record_bytes(page_id, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), kind,
                                                 None if pd.isna(refers) else int(refers), len(payload)))
                if writer.written >= BUNDLE_BYTES:
                    yield frame(writer.close())
                    writer = None
        if writer:
            yield frame(writer.close())

    # Nullable ids come as floats in pandas, which would round large ones: they travel as text.
    as_text = rows.withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    index = as_text.mapInPandas(write, INDEX)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str, verify: bool = True) -> DataFrame:
    """The records the index names, read back by frame: page_id, payload_bytes, payload_digest, record_type,
    refers_to and payload (null for revisits). ``verify`` recomputes the digests of stored payloads."""
    prepare(index.sparkSession)
    # A frame is fetched once: its records come together. Frames, not bundles, are the unit of work.
    place = ["bundle", "frame", "frame_start", "frame_size"]
    frames = index.groupBy(*place).agg(F.collect_list(F.struct("record_start", "record_size")).alias("records"))
    # The index is small beside what it names: frames are dealt out by their bytes, not by the index's.
    size = index.select(*place).distinct().agg(F.sum("frame_size")).first()[0] or 0
    frames = frames.repartition(max(1, -(-size // READ_BYTES)), "bundle", "frame")
    store = folder_store(index.sparkSession, folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        fs, root = store.open(), store.place(store.prefix)
        for batch in batches:
            for bundle, part in batch.groupby("bundle"):
                with fs.open_input_file(f"{root}/{bundle}") as file:
                    table = seek_table(file, file.size())
                    for number, records in zip(part["frame"], part["records"]):
                        start, packed, _ = table[number]
                        file.seek(start)
                        data = unpack.decompress(file.read(packed))
                        out = []
                        for r in records:
                            got = parse_record(data[r["record_start"]:r["record_start"] + r["record_size"]])
                            if verify and got["payload"] is not None and (
                                    digest_of(got["payload"]) != got["payload_digest"] or len(got["payload"]) != got["payload_bytes"]):
                                raise ValueError(f"damaged record {got['page_id']}")
                            out.append(got)
                        kinds = {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"}
                        columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
                        yield pd.DataFrame({c: pd.Series([r[c] for r in out], dtype=kinds.get(c, "object")) for c in columns})

    return frames.mapInPandas(read, READ)


def fetch(spark: SparkSession, folder: str, page_ids: list[int]) -> DataFrame:
    """Random access: the records of some pages, touching only their frames."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    return read_records(index.filter(F.col("page_id").isin(page_ids)), folder)


def archive_report(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archive, read it back: (page_id, payload_bytes, payload_digest, record_type, refers_to) per row."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_records(write_archive(pages, folder), folder).drop("payload")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT h, max(page_id) AS newest FROM p GROUP BY h)
SELECT page_id, strlen(x) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN newest IS NULL OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM p JOIN d USING (h)
"""
