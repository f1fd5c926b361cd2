"""Deterministic sharded WARC writer, and a reader of what it wrote.

``write`` range-sorts records by page id, writes each range as gzip files that
roll by compressed size, and commits: every file is written under a temporary
name of its task attempt and then renamed, and a manifest of the files follows
when all ranges are done.  The number of ranges and their bounds follow from the
rows alone (their bytes, and quantiles of the rows that a hash of id and digest
picks), whatever their partitions, so every run, retry or repeated task writes
the same bytes to the same names; only files that the manifest names count, and
others are removed after it.  Headers and digests are generated from the rows
alone.  Of records with equal payloads the smallest page id carries the payload
(response); the others are revisit records that refer to it.

Defined cases: null html is an empty payload; an empty table gives an empty
manifest; rows that repeat the first page id and its payload are each a
response; a row without a page id comes last and is a response only if no row
with an id has its payload; rows equal in id and payload lie in one range;
other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_root, partitions
from .skew import keyed_join, written

#: A file is closed at the first record that brings it to this many compressed bytes.
ROLL_BYTES = 64 << 20
GZIP_LEVEL = 3
#: Payload bytes of a range; a smaller table still has up to MOST_SMALL ranges of SMALL_BYTES.
RANGE_BYTES, SMALL_BYTES, MOST_SMALL = 512 << 20, 1 << 20, 64
#: Rows of the sample for each range.
SAMPLE_PER_RANGE = 40
#: Equal-width cells of the ids through which a row finds the bounds near it.
CELLS = 1 << 14
# The date of all records and the profile of revisit records.
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, records long, bytes long, sha1 string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _id_text(page_id) -> str:
    return "null" if page_id is None else str(page_id)


def record(page_id, url, payload: bytes, first) -> bytes:
    """One WARC record; ``first`` is the page that carries the payload, None for itself."""
    digest = base32_sha1(payload)
    block = payload if first is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
             f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {WARC_DATE}",
             "WARC-Target-URI: " + " ".join((url or "about:blank").split()),
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             f"X-Page-ID: {_id_text(page_id)}", f"X-Payload-Length: {len(payload)}"]
    if first is not None:
        lines += [f"WARC-Refers-To: {_record_id(first, digest)}", f"X-Refers-To-Page: {first}",
                  f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=GZIP_LEVEL, mtime=0) as f:
        f.write(data)
    return out.getvalue()


def open_store(uri: str):
    """File system and path of a folder that driver and executors share."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def settle(fs, temporary: str, target: str, sha1: str) -> None:
    """Give a finished file its name; one of that name and content is kept (an earlier attempt wrote it)."""
    if fs.get_file_info(target).type == pafs.FileType.File:
        found = hashlib.sha1()
        with fs.open_input_stream(target, compression=None) as f:
            while data := f.read(1 << 20):
                found.update(data)
        if found.hexdigest() == sha1:
            fs.delete_file(temporary)
            return
        fs.delete_file(target)
    fs.move(temporary, target)


def remove_unlisted(fs, path: str, listed: set[str]) -> None:
    """Delete archives and temporary files that the manifest does not name (of failed or repeated attempts)."""
    for info in fs.get_file_info(pafs.FileSelector(path)):
        name = info.base_name
        if info.type == pafs.FileType.File and name not in listed and (
                name.startswith("_temporary-") or (name.startswith("pages-") and name.endswith(".warc.gz"))):
            fs.delete_file(info.path)


def page_rows(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return rows.withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html")})


def links_of(keys: DataFrame) -> DataFrame:
    """``(page_id, digest, bytes, first)``: the pages that revisit another one, from the written keys.

    A payload that many pages share (an empty or an error page) is a hot key of this join.
    """
    keys = keys.withColumn("payload", F.concat_ws(":", "digest", "bytes"))
    firsts = written(keys.groupBy("payload").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages")))
    return (keyed_join(keys.select("page_id", "digest", "bytes", "payload"), firsts, "payload", "pages").drop("payload")
            .filter(~F.col("page_id").eqNullSafe(F.col("first"))).distinct())


def ranges_of(keys: DataFrame) -> tuple[list[tuple], int | None, int | None]:
    """Lower bounds ``(no id, page_id, digest)`` of all ranges but the first, and the least and greatest id.

    The rows alone decide: a hash of id and digest picks the sample, so its size is about
    SAMPLE_PER_RANGE rows a range, and the same rows are picked in every run.
    """
    total = keys.agg(F.sum("bytes"), F.count(F.lit(1)), F.min("page_id"), F.max("page_id")).first()
    size, rows, low, high = total[0] or 0, total[1], total[2], total[3]
    n = max(-(-size // RANGE_BYTES), min(MOST_SMALL, -(-size // SMALL_BYTES)), 1)
    if n == 1:
        return [], low, high
    every = max(1, rows // (n * SAMPLE_PER_RANGE))
    picked = (keys.filter(F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0)
              .groupBy(F.col("page_id").isNull().alias("none"), "page_id", "digest").agg(F.sum("bytes").alias("b")).collect())
    picked = sorted((r.none, r.page_id or 0, r.digest, r.b) for r in picked)
    step, seen, out = sum(r[3] for r in picked) / n, 0, []
    for *key, b in picked:
        if step and seen >= step * (len(out) + 1):
            out.append(tuple(key))
        seen += b
    return out, low, high


def with_range(rows: DataFrame, bounds: list[tuple], low: int | None, high: int | None) -> DataFrame:
    """Adds ``range``: the number of bounds that are not above the row's key.

    Bounds are found through cells of the id (a table of CELLS rows and the bounds, broadcast).
    """
    if not bounds:
        return rows.withColumn("range", F.lit(0))
    low, high = low or 0, high or 0
    width = max(1, -(-(high - low + 1) // CELLS))
    cells, before = {}, []
    for none, page_id, digest in bounds:
        cells.setdefault(CELLS if none else (page_id - low) // width, []).append((none, page_id, digest))
    count = 0
    for c in range(CELLS + 1):
        before.append((c, count, cells.get(c, [])))
        count += len(cells.get(c, []))
    table = rows.sparkSession.createDataFrame(
        before, "cell int, base int, bounds array<struct<none:boolean,page_id:bigint,digest:string>>")
    key = F.struct(F.col("page_id").isNull().alias("none"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "digest")
    # of ids up to 64 bits the difference is taken as a decimal
    place = F.floor((F.col("page_id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
    cell = F.coalesce(place.cast("int"), F.lit(CELLS))
    return (rows.withColumn("cell", cell).join(F.broadcast(table), "cell")
            .withColumn("range", F.col("base") + F.size(F.filter("bounds", lambda b: b <= key))).drop("cell", "base", "bounds"))


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, **columns) -> DataFrame:
    """Write the archives and their manifest; return the manifest's rows.

    The payloads are shuffled once: digests meet by digest, and a page that revisits
    another gets a small row in front of it that says which.
    """
    rows = page_rows(pages, **columns)
    keys = written(rows.select("page_id", "digest", "bytes"))
    bounds, low, high = ranges_of(keys)
    none = F.lit(None).cast("string")
    both = rows.select("page_id", "digest", "bytes", F.lit(1).alias("is_page"), "url", "html",
                       F.lit(None).cast("long").alias("first")).union(
        links_of(keys).select("page_id", "digest", "bytes", F.lit(0), none, none, "first"))
    by_id = F.col("page_id").asc_nulls_last()
    ranged = (with_range(both, bounds, low, high).repartitionById(len(bounds) + 1, F.col("range"))
              .sortWithinPartitions(by_id, "digest", "bytes", "is_page", "url"))

    def shard(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, path = open_store(folder)
        done, state = [], {"out": None}
        link = (None, None, None)  # id and digest of the last link, and the page it refers to

        def close():
            state["out"].close()
            name = f"pages-{state['range']:06d}-{len(done):05d}.warc.gz"
            settle(fs, state["temp"], f"{path}/{name}", state["sha"].hexdigest())
            done.append((name, state["records"], state["bytes"], state["sha"].hexdigest()))
            state["out"] = None

        for batch in batches:
            ids, digests, pages_, urls, html, firsts, place = (batch.column(c) for c in (
                "page_id", "digest", "is_page", "url", "html", "first", "range"))
            for i in range(batch.num_rows):
                own = ids[i].as_py(), digests[i].as_py()
                if not pages_[i].as_py():
                    link = (*own, firsts[i].as_py())
                    continue
                first = link[2] if link[:2] == own else None
                if state["out"] is None:
                    temp = f"{path}/_temporary-{task.partitionId()}-{task.taskAttemptId()}-{len(done)}"
                    state.update(out=fs.open_output_stream(temp), temp=temp, records=0, bytes=0, sha=hashlib.sha1(),
                                 range=place[i].as_py())
                data = _member(record(own[0], urls[i].as_py(), html[i].as_py().encode(), first))
                state["out"].write(data)
                state["sha"].update(data)
                state["records"] += 1
                state["bytes"] += len(data)
                if state["bytes"] >= roll_bytes:
                    close()
        if state["out"] is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["file", "records", "bytes", "sha1"])

    fs, path = open_store(folder)
    fs.create_dir(path, recursive=True)
    spark = pages.sparkSession
    ranged.mapInArrow(shard, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    remove_unlisted(fs, path, {r.file for r in manifest.select("file").toLocalIterator()})
    return manifest


def records(stream):
    """Headers (lower-case names) and block of every record of an open archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives that the manifest names, digests verified.

    ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)``
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")

    def load(batches):
        fs, path = open_store(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{file}", compression=None) as raw, gzip.open(raw) as stream:
                    for h, block in records(stream):
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        if h["warc-type"] == "response" and (base32_sha1(block) != digest
                                                             or len(block) != int(h["x-payload-length"])):
                            raise ValueError(f"{file}: digest of {h['warc-record-id']} does not match")
                        page = h["x-page-id"]
                        rows.append((None if page == "null" else int(page), h["warc-target-uri"],
                                     int(h["x-payload-length"]), digest, h["warc-type"],
                                     int(h["x-refers-to-page"]) if "x-refers-to-page" in h else None))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = manifest.select("file").repartition(partitions(spark), "file")
    return files.mapInArrow(load, "page_id long, url string, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long")


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write to a fresh folder under the shared root, then read back."""
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex[:12]}"
    write(pages, folder, **options)
    return read(spark, folder)
