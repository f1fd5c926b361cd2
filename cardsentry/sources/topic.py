"""A topic replayed from files, read by offsets like the broker's topic.

``write_topic`` appends Kafka records to a folder, cut into segments by topic
partition and offset, and then publishes an index of the written files.
``stream_topic`` reads them as a stream with one offset per topic partition:
``startingOffsets`` matters on the first run only, later runs go on from the
offsets in the checkpoint, and ``max_offsets_per_trigger`` bounds a
micro-batch.  ``read_topic`` reads offset ranges as a batch.

Only published files are visible, so a write that is under way, or that failed,
never moves the end of the topic.  As in a broker, offsets only grow: a later
write must not add offsets below the published end of a partition.

The source is a Python data source: the driver sees the index (one row per
file), tasks read the files as Arrow batches and skip row groups outside their
range.  The folder must lie where Python can read it (a mounted path, or a
scheme that ``pyarrow.fs`` knows).
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# executors need pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The record a Kafka source delivers.
ENVELOPE = ("key binary, value binary, topic string, partition int, offset long, "
            "timestamp timestamp, timestampType int")
#: Offsets of one segment folder.
SEGMENT_OFFSETS = 1 << 20
#: Records that one task reads at most, unless a single file holds more.
RECORDS_PER_TASK = 1_000_000
EARLIEST, LATEST = -2, -1


def write_topic(records: DataFrame, path: str, segment_offsets: int = SEGMENT_OFFSETS) -> None:
    """Append records (columns of the Kafka source) to the topic at ``path`` and publish them."""
    spark, write = records.sparkSession, uuid.uuid4().hex
    data = f"{path}/write={write}"
    base = (F.floor(F.col("offset") / segment_offsets) * segment_offsets).alias("base")
    (records.select("*", F.col("partition").alias("topic_partition"), base)
     .hint("rebalance", "topic_partition", "base").sortWithinPartitions("topic_partition", "base", "offset")
     .write.partitionBy("topic_partition", "base").parquet(data))
    # the files themselves say what they hold; their index appears as one committed folder
    (spark.read.parquet(data).groupBy("partition", F.col("_metadata.file_path").alias("file"))
     .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("records"))
     .withColumn("file", F.regexp_extract("file", f"(write={write}/.*)$", 1))
     .coalesce(1).write.json(f"{path}/_index/write={write}"))


# --- file access of the reader (driver's Python and tasks) --------------------

def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _names(path: str) -> list[str]:
    from pyarrow import fs

    system, folder = _filesystem(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found)


def _text(path: str) -> str:
    system, file = _filesystem(path)
    with system.open_input_stream(file) as stream:
        return stream.read().decode()


def _last_offsets(checkpoint: str, topic: str) -> dict[str, int] | None:
    """End offsets of the newest micro-batch planned in a checkpoint; None before the first."""
    batches = [int(n) for n in _names(f"{checkpoint}/offsets") if n.isdigit()]
    if not batches:
        return None
    for line in _text(f"{checkpoint}/offsets/{max(batches)}").splitlines()[2:]:
        try:
            found = json.loads(line)
        except ValueError:          # a source without an offset yet
            continue
        if isinstance(found, dict) and isinstance(found.get(topic), dict):
            return {p: int(o) for p, o in found[topic].items()}
    return None


class Index:
    """Published files of a topic: ``(first, last, records, file)`` by partition."""

    def __init__(self, path: str):
        self.path, self.seen, self.files = path, set(), {}

    def refresh(self) -> "Index":
        for write in _names(f"{self.path}/_index"):
            if write in self.seen:
                continue
            parts = _names(f"{self.path}/_index/{write}")
            if "_SUCCESS" not in parts:
                continue
            for part in parts:
                if part.endswith(".json"):
                    for line in _text(f"{self.path}/_index/{write}/{part}").splitlines():
                        r = json.loads(line)
                        self.files.setdefault(str(r["partition"]), []).append(
                            (r["first"], r["last"], r["records"], r["file"]))
            self.seen.add(write)
        for rows in self.files.values():
            rows.sort()
        return self

    def earliest(self) -> dict[str, int]:
        return {p: rows[0][0] for p, rows in self.files.items()}

    def latest(self) -> dict[str, int]:
        return {p: max(r[1] for r in rows) + 1 for p, rows in self.files.items()}

    def resolve(self, wanted: str, topic: str) -> dict[str, int]:
        """Offsets named by ``earliest``, ``latest`` or ``{"topic": {"0": 7, "1": -2}}``
        (-2 earliest, -1 latest; a partition left out: earliest)."""
        first, end = self.earliest(), self.latest()
        if wanted == "earliest":
            return first
        if wanted == "latest":
            return end
        named = json.loads(wanted).get(topic, {})
        return {p: {EARLIEST: first[p], LATEST: end[p]}.get(named.get(p, EARLIEST), named.get(p)) for p in first}

    def ranges(self, start: dict[str, int], end: dict[str, int], records: int) -> list["OffsetRange"]:
        """Input partitions of the offsets ``[start, end)``: files of a topic partition, whole, up to ``records``."""
        out = []
        for p, until in end.items():
            begin, files, held = start.get(p, 0), [], 0
            for first, last, count, file in self.files.get(p, []):
                if first >= until or last < begin:
                    continue
                if files and held + count > records:
                    out.append(OffsetRange(int(p), begin, until, tuple(files)))
                    files, held = [], 0
                files.append(file)
                held += count
            if files:
                out.append(OffsetRange(int(p), begin, until, tuple(files)))
        return out


@dataclass
class OffsetRange(InputPartition):
    partition: int
    start: int
    end: int
    files: tuple[str, ...]


def _read_range(path: str, part: OffsetRange):
    """Arrow batches of the envelope for one range."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    names = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    for name in part.files:
        system, file = _filesystem(f"{path}/{name}")
        with system.open_input_file(file) as source:
            parquet = pq.ParquetFile(source)
            at = parquet.schema_arrow.names.index("offset")
            groups = []
            for g in range(parquet.num_row_groups):
                s = parquet.metadata.row_group(g).column(at).statistics
                if s is None or not s.has_min_max or (s.max >= part.start and s.min < part.end):
                    groups.append(g)
            for batch in parquet.iter_batches(row_groups=groups, columns=names):
                inside = pc.and_(pc.greater_equal(batch.column("offset"), part.start), pc.less(batch.column("offset"), part.end))
                batch = batch.filter(inside)
                if not batch.num_rows:
                    continue
                time = batch.column("timestamp")
                if time.type.tz is None:        # an instant written without its zone
                    time = time.cast(pa.timestamp("us")).cast(pa.timestamp("us", tz="UTC"))
                columns = [time if n == "timestamp" else batch.column(n) for n in names]
                kinds = [pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.int32()]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names)


class TopicReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.options = options["path"], dict(options)

    def partitions(self):
        index, topic = Index(self.path).refresh(), self.options.get("topic", "")
        return index.ranges(index.resolve(self.options.get("startingoffsets", "earliest"), topic),
                            index.resolve(self.options.get("endingoffsets", "latest"), topic),
                            int(self.options.get("recordspertask", RECORDS_PER_TASK)))

    def read(self, partition):
        return _read_range(self.path, partition)


class TopicStreamReader(DataSourceStreamReader):
    """Offsets are ``{topic: {partition: next offset}}``, the form of the Kafka source's checkpoint."""

    def __init__(self, options: dict[str, str]):
        self.path, self.topic, self.options = options["path"], options["topic"], dict(options)
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.index = Index(self.path)
        self.planned = None          # end of the newest planned micro-batch

    def initialOffset(self) -> dict:
        start = self.index.refresh().resolve(self.options.get("startingoffsets", "earliest"), self.topic)
        self.planned = self.planned or start
        return {self.topic: start}

    def latestOffset(self) -> dict:
        self.index.refresh()
        latest = self.index.latest()
        if self.limit:
            latest = self._admitted(latest)
        self.planned = latest
        return {self.topic: latest}

    def _admitted(self, latest: dict[str, int]) -> dict[str, int]:
        """At most ``limit`` offsets past the planned end, shared out in proportion to what waits."""
        if self.planned is None:     # a restarted query: its checkpoint knows where it stands
            checkpoint = self.options.get("checkpoint")
            if not checkpoint:
                raise ValueError("max_offsets_per_trigger needs the query's checkpoint to resume from")
            self.planned = _last_offsets(checkpoint, self.topic)
            if self.planned is None:
                self.planned = self.index.resolve(self.options.get("startingoffsets", "earliest"), self.topic)
        first = self.index.earliest()
        begin = {p: max(self.planned.get(p, first[p]), first[p]) for p in latest}
        waiting = {p: max(latest[p] - begin[p], 0) for p in latest}
        total = sum(waiting.values())
        if total <= self.limit:
            return {p: max(latest[p], begin[p]) for p in latest}
        share = {p: self.limit * w // total for p, w in waiting.items()}
        for p in sorted(waiting, key=lambda p: (-waiting[p], p)):       # what rounding left over
            if sum(share.values()) < self.limit and share[p] < waiting[p]:
                share[p] += 1
        return {p: begin[p] + share[p] for p in latest}

    def partitions(self, start: dict, end: dict):
        self.index.refresh()
        return self.index.ranges(start.get(self.topic, {}), end.get(self.topic, {}),
                                 int(self.options.get("recordspertask", RECORDS_PER_TASK)))

    def read(self, partition):
        return _read_range(self.path, partition)


class ReplayedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replayed_topic"

    def _lowered(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def schema(self) -> str:
        return ENVELOPE

    def reader(self, schema):
        return TopicReader(self._lowered())

    def streamReader(self, schema):
        return TopicStreamReader(self._lowered())


def read_topic(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest",
               ending_offsets: str = "latest") -> DataFrame:
    """Records of the offset ranges as a batch."""
    spark.dataSource.register(ReplayedTopic)
    return (spark.read.format("replayed_topic").option("path", path).option("topic", topic)
            .option("startingOffsets", starting_offsets).option("endingOffsets", ending_offsets).load())


def stream_topic(spark: SparkSession, path: str, topic: str, starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None, checkpoint: str | None = None,
                 records_per_task: int = RECORDS_PER_TASK) -> DataFrame:
    """The topic as a stream.

    ``max_offsets_per_trigger`` bounds every micro-batch; it needs the
    ``checkpoint`` of the query, whose newest planned batch tells a restarted
    reader where it stands.  A run with ``availableNow`` plans its end once, so
    with a bound it takes a single step; leave the bound out there.
    """
    spark.dataSource.register(ReplayedTopic)
    reader = (spark.readStream.format("replayed_topic").option("path", path).option("topic", topic)
              .option("startingOffsets", starting_offsets).option("recordsPerTask", str(records_per_task)))
    if max_offsets_per_trigger:
        if not checkpoint:
            raise ValueError("max_offsets_per_trigger needs the query's checkpoint to resume from")
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).option("checkpoint", checkpoint)
    return reader.load()
