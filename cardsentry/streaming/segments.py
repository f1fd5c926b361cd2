"""A table that grows by micro-batches, as segments behind a versioned manifest.

Every micro-batch adds one segment (a folder); segments of closed batches are
merged by size, ``fan_in`` of a tier into one of the next, so their number grows
with the logarithm of the table and not with the number of batches::

    <path>/segment=b<batch>/<partition columns>/...       rows of one batch
    <path>/segment=m<first>-<last>-<id>/...               merged batches
    <path>/_companion/segment=.../...                     derived rows of a segment (optional)
    <path>/_manifest/<version>.json                       the live segments

A reader takes the newest manifest and sees the segments it names, the old set
or the new one, never both; replaced segments stay for ``keep_versions`` more
versions.  A replayed batch writes its own segment again, and only batches
before the running one are ever merged, so a replay finds the history it found
the first time.  There is one writer: the streaming query.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from cardsentry.sources.paths import folder_size, glob_exists, list_names, publish, read_small, remove


@dataclass(frozen=True)
class Segment:
    name: str
    first: int          # batches whose rows it holds
    last: int
    bytes: int
    files: int


class SegmentTable:
    """``arrange(df)`` clusters and sorts rows before they are written;
    ``companion(df, segment_name)`` gives rows to keep beside a segment (e.g. a
    filter over its keys)."""

    def __init__(self, path: str, partition_by: list[str], arrange: Callable[[DataFrame], DataFrame] = lambda df: df,
                 companion: Callable[[DataFrame, str], DataFrame] | None = None, fan_in: int = 8,
                 small_bytes: int = 1 << 20, largest_bytes: int = 64 << 30, keep_versions: int = 8,
                 options: dict[str, str] | None = None):
        self.path, self.partition_by, self.arrange, self.companion = path, list(partition_by), arrange, companion
        self.fan_in, self.small_bytes, self.largest_bytes = fan_in, small_bytes, largest_bytes
        self.keep_versions, self.options = keep_versions, dict(options or {})
        self._tidy = False

    # -- manifest ----------------------------------------------------------

    def _manifest(self, spark: SparkSession) -> tuple[int, list[Segment], list[dict]]:
        names = [n for n in list_names(spark, f"{self.path}/_manifest") if n.endswith(".json") and n[0] != "_"]
        if not names:
            return 0, [], []
        found = json.loads(read_small(spark, f"{self.path}/_manifest/{names[-1]}"))
        return int(names[-1][:-5]), [Segment(**s) for s in found["live"]], found["dropped"]

    def segments(self, spark: SparkSession, before: int | None = None) -> list[Segment]:
        """Live segments, those of batches before ``before`` only if given."""
        return [s for s in self._manifest(spark)[1] if before is None or s.last < before]

    def _commit(self, spark: SparkSession, live: list[Segment]) -> None:
        version, old, dropped = self._manifest(spark)
        now = version + 1
        names = {s.name for s in live}
        dropped = [d for d in dropped if d["name"] not in names]
        dropped += [{"name": s.name, "at": now} for s in old if s.name not in names]
        expired = [d["name"] for d in dropped if d["at"] <= now - self.keep_versions]
        dropped = [d for d in dropped if d["name"] not in expired]
        live = sorted(live, key=lambda s: (s.first, s.last))
        publish(spark, f"{self.path}/_manifest/{now:020d}.json",
                json.dumps({"live": [asdict(s) for s in live], "dropped": dropped}))
        for name in expired:
            self._remove(spark, name)
        for name in list_names(spark, f"{self.path}/_manifest"):
            if name.endswith(".json") and name[0] != "_" and int(name[:-5]) <= now - self.keep_versions:
                remove(spark, f"{self.path}/_manifest/{name}")

    def _remove(self, spark: SparkSession, name: str) -> None:
        remove(spark, f"{self.path}/segment={name}")
        remove(spark, f"{self.path}/_companion/segment={name}")

    def _remove_leftovers(self, spark: SparkSession) -> None:
        """Merged segments that no manifest names (their writer was lost before the commit)."""
        if self._tidy:
            return
        _, live, dropped = self._manifest(spark)
        known = {s.name for s in live} | {d["name"] for d in dropped}
        for folder in list_names(spark, self.path):
            name = folder.removeprefix("segment=")
            if folder.startswith("segment=m") and name not in known:
                self._remove(spark, name)
        self._tidy = True

    # -- rows ----------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, first: int, last: int) -> Segment | None:
        folder = f"{self.path}/segment={name}"
        self.arrange(df).write.mode("overwrite").options(**self.options).partitionBy(*self.partition_by).parquet(folder)
        size, files = folder_size(df.sparkSession, folder)
        if not files:
            return None
        if self.companion is not None:
            rows = df.sparkSession.read.parquet(folder)
            self.companion(rows, name).write.mode("overwrite").parquet(f"{self.path}/_companion/segment={name}")
        return Segment(name, first, last, size, files)

    def append(self, df: DataFrame, batch_id: int) -> Segment | None:
        """Rows of a micro-batch; a replay replaces what the batch wrote before."""
        spark = df.sparkSession
        self._remove_leftovers(spark)
        version, live, _ = self._manifest(spark)
        segment = self._write(df, f"b{batch_id:012d}", batch_id, batch_id)
        now = [s for s in live if s.last < batch_id] + ([segment] if segment else [])
        if now != live or not version:
            self._commit(spark, now)
        return segment

    def read(self, spark: SparkSession, segments: list[Segment], folders: str = "") -> DataFrame | None:
        """Rows of the segments; ``folders`` is a glob of partition folders below each."""
        if not segments:
            return None
        pattern = f"{self.path}/segment={{{','.join(s.name for s in segments)}}}{folders and '/' + folders}"
        if not glob_exists(spark, pattern):
            return None
        return spark.read.option("basePath", self.path).parquet(pattern)

    def companions(self, spark: SparkSession, segments: list[Segment]) -> DataFrame | None:
        """Companion rows of the segments (column ``segment`` added)."""
        if not segments:
            return None
        base = f"{self.path}/_companion"
        return spark.read.option("basePath", base).parquet(*[f"{base}/segment={s.name}" for s in segments])

    # -- merging ---------------------------------------------------------------

    def tier(self, segment: Segment) -> int:
        if segment.bytes <= self.small_bytes:
            return 0
        return 1 + int(math.log(segment.bytes / self.small_bytes, self.fan_in))

    def _due(self, segments: list[Segment]) -> list[Segment]:
        """The oldest segments of the lowest tier that has ``fan_in`` of them.

        Merged segments of small batches count by the batches they hold as well, so that
        a history of tiny batches is not merged into the same segment again and again.
        """
        tiers: dict[int, list[Segment]] = {}
        for s in segments:
            if s.bytes < self.largest_bytes:
                batches = s.last - s.first + 1
                tiers.setdefault(max(self.tier(s), int(math.log(batches, self.fan_in) + 1e-9)), []).append(s)
        for tier in sorted(tiers):
            if len(tiers[tier]) >= self.fan_in:
                return sorted(tiers[tier], key=lambda s: s.first)[:self.fan_in]
        return []

    def compact(self, spark: SparkSession, before: int) -> int:
        """Merge segments of batches before ``before`` until no tier is full; the number of merges."""
        merges = 0
        while True:
            live = self.segments(spark)
            due = self._due([s for s in live if s.last < before])
            if not due:
                return merges
            self._remove_leftovers(spark)
            first, last = min(s.first for s in due), max(s.last for s in due)
            rows = self.read(spark, due).drop("segment")
            merged = self._write(rows, f"m{first:012d}-{last:012d}-{uuid.uuid4().hex[:8]}", first, last)
            self._commit(spark, [s for s in live if s not in due] + ([merged] if merged else []))
            merges += 1
