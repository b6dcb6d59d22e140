"""WARC archives: a deterministic sharded writer and a reader.

Writing is one range shuffle of the pages. Shard bounds come from exact byte counts of key ranges, records are sorted
within a shard, and a file is closed once its compressed size passes a limit; so the same pages give the same
files, however the job is cut into tasks and however often a task is repeated. A task writes under temporary names of
its own attempt and returns a manifest row per file. Only files in the manifest, which holds what successful
attempts returned, are moved to their final names; the manifest is written last and says what is valid.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.cluster import checkpoint_folder
from scarmap.llm.registry import query
from scarmap.llm.shared import stored, table

#: payload bytes that a task writes, and compressed bytes after which a file is closed
SHARD_BYTES, FILE_BYTES = 32 << 20, 16 << 20
DATE = "2000-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: parts into which a key range that holds too much is cut
FAN = 64


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder that driver and executors share: a plain path, file:, hdfs:, s3: ..."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), re.sub(r"^file:(//)?", "", uri)
    return pafs.FileSystem.from_uri(uri)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: bytes, copy: int) -> str:
    name = hashlib.sha1(f"{page_id}/{digest.hex()}/{copy}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def _head(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def _record(kind: str, ident: str, date: str, block: bytes, content: str, more: list[tuple[str, str | None]]) -> bytes:
    """One record as a gzip member of its own."""
    head = _head("WARC/1.1", [
        ("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", date), *more,
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"), ("Content-Type", content), ("Content-Length", str(len(block))),
    ])
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join((z.compress(head), z.compress(block), z.compress(b"\r\n\r\n"), z.flush()))


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, copy: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response, or a revisit without payload. Control characters and blanks in a url are percent-encoded."""
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    more = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{base32(digest)}"), ("X-Page-ID", None if page_id is None else str(page_id))]
    if revisit:
        more += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page-ID", None if refers_to is None else str(refers_to))]
    return _record("revisit" if revisit else "response", record_id(page_id, digest, copy), date, http if revisit else http + payload, "application/http; msgtype=response", more)


MANIFEST = "file string, part string, shard long, n_records long, n_bytes long, sha1 string"


class _Files:
    """The files of one shard after the other, under temporary names; ``done`` collects manifest rows."""

    def __init__(self, folder: str, limit: int, date: str):
        self.fs, self.path = file_system(folder)
        self.limit, self.date, self.out, self.done, self.shard = limit, date, None, [], None
        context = TaskContext.get()
        self.attempt = context.taskAttemptId() if context else 0

    def write(self, shard: int, record: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.size >= self.limit):
            self.close()
        if self.out is None:
            self.number = self.number + 1 if shard == self.shard else 0
            self.shard, self.size, self.records, self.sha = shard, 0, 0, hashlib.sha1()
            self.name = f"pages-{shard:06d}-{self.number:05d}.warc.gz"
            self.part = f"_parts/{self.name}.{self.attempt}"
            self.out = self.fs.open_output_stream(posixpath.join(self.path, self.part), compression=None)
            info = _head("", [("software", "scarmap"), ("format", "WARC File Format 1.1")])[2:]
            ident = record_id(None, hashlib.sha1(self.name.encode()).digest(), 0)
            self._put(_record("warcinfo", ident, self.date, info, "application/warc-fields", [("WARC-Filename", self.name)]))
        self._put(record)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.name, self.part, self.shard, self.records, self.size, self.sha.hexdigest()))


def _bounds(weights: DataFrame, target: int) -> np.ndarray:
    """Least keys of consecutive shards of about ``target`` bytes, from exact counts of ``weights`` (key, bytes)."""
    lo, hi = weights.agg(F.min("key"), F.max("key")).first()
    if lo is None:
        return np.zeros(0, dtype=np.int64)
    cells = {(lo, hi + 1): None}
    while split := [c for c, w in cells.items() if w is None or (w > target // 4 and c[1] - c[0] > 1)]:
        for a, b in split:
            del cells[a, b]
        new = [(a + (b - a) * i // FAN, a + (b - a) * (i + 1) // FAN) for a, b in split for i in range(FAN)]
        new = [c for c in new if c[0] < c[1]]
        starts, ends = (np.array([int(c[i]) - (i == 1) for c in new], dtype=np.int64) for i in (0, 1))  # closed at the end

        def count(batches: Iterator[pa.RecordBatch], starts=starts, ends=ends) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(starts), dtype=np.int64)
            for batch in batches:
                key, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                at = np.searchsorted(starts, key, "right") - 1
                inside = (at >= 0) & (key <= ends[at])
                np.add.at(total, at[inside], size[inside])
            some = np.flatnonzero(total)
            yield pa.record_batch([pa.array(some), pa.array(total[some])], ["cell", "bytes"])

        rows = weights.where("key is not null").mapInArrow(count, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("w")).collect()
        cells |= {new[r.cell]: r.w for r in rows}
    first, held = [lo], 0
    for (a, _), w in sorted(cells.items()):
        if held and held + w > target:
            first.append(a)
            held = 0
        held += w
    return np.array(first, dtype=np.int64)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to WARC files in ``folder``, which must not hold any; returns the manifest.

    Payload is the html in UTF-8, empty if null. Of pages with equal payloads of at least ``min_bytes``, that with the
    smallest page_id becomes a response and the others revisits of it; of repeated rows one is the response.
    Records are sorted by page_id (none first in the last shard) and digest. A null url gives a record without target. No
    pages give an empty manifest. Other columns are disregarded.
    """
    spark = pages.sparkSession
    if file_system(folder)[0].get_file_info(file_system(folder)[1]).type != pafs.FileType.NotFound:
        raise FileExistsError(folder)
    file_system(folder)[0].create_dir(posixpath.join(file_system(folder)[1], "_parts"))
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.select(F.col("page_id").cast("long").alias("key"), "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    narrow = stored(keyed.select("key", "digest", F.octet_length("payload").cast("long").alias("bytes")))
    first = _bounds(narrow.select("key", (F.col("bytes") + 300).alias("bytes")), shard_bytes)
    sent = spark.sparkContext.broadcast(first)  # one number per shard

    @F.pandas_udf("long")
    def shard(key: pd.Series) -> pd.Series:
        at = np.searchsorted(sent.value, key.fillna(np.iinfo(np.int64).max).astype("int64"), "right") - 1
        return pd.Series(np.maximum(at, 0))

    groups = narrow.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1")
    flags = narrow.join(groups, "digest").select("key", "digest", "first").distinct()
    rows = (
        keyed.select("key", "digest", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first"))
        .unionByName(flags.select("key", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first"))
        .withColumn("shard", shard("key"))
        .repartitionById(max(len(first), 1), F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "digest", "kind", "url")
        .select("shard", "key", "digest", "kind", "first", "url", "payload")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, file_bytes, date)
        now, copy, flagged, refers_to = None, 0, False, None
        for batch in batches:
            small = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            for (at, key, digest, kind, head, url), body in zip(small, batch.column(6), strict=True):
                if (key, digest) != now:
                    now, copy, flagged = (key, digest), 0, False
                if kind == 0:
                    flagged, refers_to = True, head
                    continue
                revisit = flagged and (copy > 0 or key != refers_to)
                files.write(at, page_record(key, url, body.as_py(), digest, copy, refers_to, revisit, date))
                copy += 1
        files.close()
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(list(zip(*files.done, strict=True)) or [()] * 6, [pa.string(), pa.string(), *[pa.int64()] * 3, pa.string()], strict=True)], ["file", "part", "shard", "n_records", "n_bytes", "sha1"])

    parts = stored(rows.mapInArrow(write, MANIFEST))
    spread(parts.select("file", "part")).mapInArrow(_mover(folder), "file string").count()
    parts.drop("part").coalesce(1).write.parquet(posixpath.join(folder, "manifest"))
    where, path = file_system(folder)
    where.delete_dir(posixpath.join(path, "_parts"))  # what is left there belongs to attempts that did not count
    return spark.read.parquet(posixpath.join(folder, "manifest"))


def _mover(folder: str):
    """Moves parts to their final names; a repeated attempt finds its work done."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = file_system(folder)
        for batch in batches:
            for name, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, target = posixpath.join(path, part), posixpath.join(path, name)
                if where.get_file_info(source).type != pafs.FileType.NotFound:
                    where.move(source, target)
                elif where.get_file_info(target).type == pafs.FileType.NotFound:
                    raise FileNotFoundError(source)
            yield batch.select(["file"])

    return move


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    data = stream.read(1 << 16)
    while data:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not data and not (data := stream.read(1 << 16)):
                raise EOFError("a gzip member ends early")
            out.append(z.decompress(data))
            data = z.unused_data
        yield b"".join(out)
        data = data or stream.read(1 << 16)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of a record; lengths and the block digest are verified."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not version.startswith("WARC/1.") or rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


RECORDS = "file string, offset_no long, record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per page record of the files in ``manifest``, verified; payload is null for revisits (or if not asked for).

    Files are read one record at a time, each by a task of its own.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with where.open_input_stream(posixpath.join(path, name), compression=None) as stream:
                    for i, member in enumerate(_members(stream)):
                        fields, block = parse_record(member)
                        if fields["WARC-Type"] not in ("response", "revisit"):
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = fields["WARC-Type"] == "response"
                        if response and (len(body) != length or base32(hashlib.sha1(body).digest()) != digest):
                            raise ValueError(f"damaged payload {fields['WARC-Record-ID']} in {name}")
                        number = lambda k, fields=fields: int(fields[k]) if k in fields else None
                        rows.append((name, i, fields["WARC-Record-ID"], fields["WARC-Type"], number("X-Page-ID"), fields.get("WARC-Target-URI"), length, digest, number("X-Refers-To-Page-ID"), body if response and payloads else None))
                        held += len(body) if payloads else 100
                        if held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    return spread(manifest.select("file")).mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in RECORDS.split(", ")])


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages),
n AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INT * (16 >> j::INT)))::INT, 1)), 'string_agg', '') AS payload_digest,
         row_number() OVER (PARTITION BY html ORDER BY page_id) AS nr, min(page_id) OVER (PARTITION BY html) AS least
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nr = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nr > 1 THEN least END AS refers_to
FROM n
"""


def spread(files: DataFrame) -> DataFrame:
    """Rows that name files, dealt one by one to as many partitions as there are files."""
    return files.repartition(max(files.count(), 1))


def folder_for(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"


@query("op3_warc", ORACLE)
def op3(spark, sf_dir):
    folder = folder_for(spark)
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
