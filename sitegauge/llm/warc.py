"""WARC archives: a deterministic sharded writer, and a reader.

Records are dealt to shards by ranges of the page id. The ranges come from a
histogram of bytes over ``BINS`` equal id intervals, so they depend on the
data alone. Each task writes its shards in id order, record by record:

* headers are made anew (ids from a name-based UUID, a fixed date, lengths,
  SHA-256 digests of payload and block);
* every record is a gzip member of its own; a file is closed when its
  compressed size reaches ``roll_bytes``;
* files have temporary names that no other attempt uses, and a task's manifest
  rows name them. The manifest is written by Spark, so exactly one attempt of
  each task is in it; a second job then moves the files it names to their final
  names (a repeated move finds the work done), and ``_SUCCESS`` ends the
  commit. What lost attempts leave keeps its temporary name.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the
smallest page id is a response, the others are revisits that refer to it.

Defined results: a null payload is empty; a null url leaves out the target
header; line ends in urls are percent-encoded. Null ids sort first, never are the
one referred to, and have no page id header. Of repeated rows of the referred id one is
the response. An empty table gives a manifest without files. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.llm.tables import ensure_checkpoint_dir, forget, freeze, read

BINS = 4096
#: Tasks that read archives back; beyond as many files, a task reads several.
READ_TASKS = 20_000
MIN_REVISIT = 100
#: Date of all records (the writer is deterministic).
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def file_system(uri: str):
    """(file system, path) of a folder on any store that Arrow knows."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False, order: int = 0) -> bytes:
    """The bytes of one record; ``order`` tells repeated rows apart."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    block = CRLF.join(http) + CRLF * 2 + (b"" if revisit else payload)
    name = record_id(page_id, digest if not order else f"{digest}:{order}")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%0D", "%250D").replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogateescape") + CRLF * 2 + block + CRLF * 2


def read_records(stream, chunk: int = 1 << 20) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of every gzip member of an open archive; digests are checked."""
    member, held, data = zlib.decompressobj(31), [], stream.read(chunk)
    while data:
        held.append(member.decompress(data))
        data = member.unused_data if member.eof else b""
        if member.eof:
            yield _parse(b"".join(held))
            member, held = zlib.decompressobj(31), []
        if not data:
            data = stream.read(chunk)
    if any(held):
        raise ValueError("the archive ends inside a record")


def _parse(data: bytes) -> tuple[dict, bytes]:
    head, _, rest = data.partition(CRLF * 2)
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != CRLF * 2:
        raise ValueError("not a record")
    if headers["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"block digest of {headers['WARC-Record-ID']} differs")
    return headers, block


class _Files:
    """Open archives of one task: temporary names, rolled by compressed size."""

    def __init__(self, root: str, roll_bytes: int):
        self.store, self.root = file_system(root)
        self.roll, self.attempt, self.out = roll_bytes, uuid.uuid4().hex, None
        self.rows: list = []

    def write(self, shard: int, data: bytes) -> None:
        if self.out is not None and (self.shard != shard or self.size >= self.roll):
            self.close()
        if self.out is None:
            self.seq = self.seq + 1 if getattr(self, "shard", None) == shard else 0
            self.shard, self.size, self.count = shard, 0, 0
            self.temp = f"_tmp/{shard:06d}-{self.seq:05d}.{self.attempt}"
            self.out = self.store.open_output_stream(f"{self.root}/{self.temp}")
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = pack.compress(data) + pack.flush()
        self.out.write(data)
        self.size += len(data)
        self.count += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.seq, self.temp, f"part-{self.shard:06d}-{self.seq:05d}.warc.gz", self.count, self.size))
            self.out = None


MANIFEST = "shard int, seq int, temp string, name string, records long, bytes long"


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   shard_bytes: int = 32 << 20, roll_bytes: int = 4 << 20) -> DataFrame:
    """Write all pages below ``root`` and return the committed manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # Everything that is decided over all pages is decided on this narrow table.
    keys = freeze(rows.select("id", F.octet_length("payload").cast("long").alias("size"), "digest"), "keys")
    shared = (keys.where(F.col("size") >= MIN_REVISIT).groupBy("digest")
              .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
              .where("n > 1 and first_id is not null").select("digest", "first_id"))

    lo, hi = keys.agg(F.min("id"), F.max("id")).first()
    width = max(1, ((hi or 0) - (lo or 0)) // BINS + 1)
    place = F.coalesce(F.floor((F.col("id") - F.lit(lo or 0)) / F.lit(width)), F.lit(-1)).cast("int")
    bins = (keys.select(place.alias("bin"), (F.col("size") + F.lit(500)).alias("b"))
            .groupBy("bin").agg(F.sum("b").alias("b")).orderBy("bin").toPandas())
    before = np.cumsum(bins["b"].to_numpy(dtype=np.int64)) - bins["b"].to_numpy(dtype=np.int64) if len(bins) else np.zeros(0)
    shards = (before // shard_bytes).astype(int).tolist()
    edges = [(int(b), s) for b, s, p in zip(bins["bin"], shards, [None, *shards]) if s != p]
    # the first bin of every shard, at most BINS of them
    starts = F.array(*[F.lit(b) for b, _ in edges]) if edges else F.array(F.lit(0))
    shard = F.size(F.filter(starts, lambda b: b <= place)) - 1

    def write(batches):
        files, last, order = _Files(root, roll_bytes), None, 0
        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "id", "url", "payload", "digest", "first_id")]
            for i in range(batch.num_rows):
                number, page, url, data, digest, first = (c[i].as_py() for c in cols)
                order = order + 1 if last == (page, digest) else 0
                last = (page, digest)
                revisit = first is not None and (page != first or order > 0)
                files.write(number, record(page, url, data, digest, first, revisit, order))
        files.close()
        names = ["shard", "seq", "temp", "name", "records", "bytes"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        columns = zip(*files.rows) if files.rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    store, folder = file_system(root)
    store.create_dir(f"{folder}/_tmp", recursive=True)
    count = max(1, len(edges))
    marks = freeze(keys.join(shared, "digest").select(shard.alias("shard"), "digest", "first_id").distinct(), "marks")
    # Payloads move once: both sides are dealt by shard alone, which the join accepts
    # as it is when Spark need not hash all join keys.
    ordered = (rows.withColumn("shard", shard).repartition(count, "shard")
               .join(marks.repartition(count, "shard"), ["shard", "digest"], "left")
               .sortWithinPartitions("shard", "id", "digest", "url"))
    every_key = spark.conf.get(ALL_KEYS, "true")
    spark.conf.set(ALL_KEYS, "false")
    try:
        manifest = freeze(ordered.select("shard", "id", "url", "payload", "digest", "first_id").mapInArrow(write, MANIFEST), "manifest")
    finally:
        spark.conf.set(ALL_KEYS, every_key)
    forget(keys, marks)

    def move(batches):
        store, folder = file_system(root)
        for batch in batches:
            for temp, name in zip(batch.column("temp").to_pylist(), batch.column("name").to_pylist()):
                if store.get_file_info(f"{folder}/{temp}").type != fs.FileType.NotFound:
                    store.move(f"{folder}/{temp}", f"{folder}/{name}")
                elif store.get_file_info(f"{folder}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(name)
            yield batch

    done = manifest.mapInArrow(move, MANIFEST).agg(F.count("*"), F.sum("records"), F.sum("bytes")).first()
    with store.open_output_stream(f"{folder}/_SUCCESS") as out:
        out.write(json.dumps({"files": done[0], "records": done[1] or 0, "bytes": done[2] or 0}).encode())
    return manifest


def read_archives(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    def run(batches):
        store, folder = file_system(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for headers, block in read_records(stream):
                        rows.append(_row(headers, block))
                        if len(rows) == 4096:
                            yield _rows_batch(rows)
                            rows = []
                yield _rows_batch(rows)
    # Files are bounded by the roll size. A stated number of tasks, since names are so
    # small that Spark would bring all of them, and so all archives, into one task.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    return (manifest.select("name").repartition(tasks)
            .mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def _row(headers: dict, block: bytes):
    head, _, payload = block.partition(CRLF * 2)
    size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its headers")
    page, first = headers.get("Page-ID"), headers.get("Refers-To-Page-ID")
    return (None if page is None else int(page), size, digest, kind, None if first is None else int(first))


def _rows_batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def op10_warc_writer(spark, sf_dir: str) -> DataFrame:
    """All pages written as archives to the shared folder and read back."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(read(spark, sf_dir, "pages"), root)
    return read_archives(spark, manifest, root)
