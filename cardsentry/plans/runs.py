"""One run of a dataset against a fresh folder under the shared root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardsentry.session import prepare, run_folder
from cardsentry.sources.tables import stream_path
from cardsentry.streaming.metrics import ProgressLog
from cardsentry.streaming.sinks import finish, stream_to_path

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class DriverTables:
    """The driver's parquet tables (``<dir>/<name>.parquet``), static or as a
    file stream that picks up the file of one table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
        schema = self.table(name).schema
        return stream_path(self.spark, self.sf_dir, schema=schema, path_glob=f"{name}.parquet",
                           max_files_per_trigger=max_files_per_trigger)


class Run:
    """Folder, checkpoints and sinks of one run."""

    recent: list = []          # the latest runs, for plan inspection

    def __init__(self, spark: SparkSession, label: str):
        self.spark = prepare(spark)
        ProgressLog.of(spark)
        self.root = run_folder(spark, label)
        self.queries = []
        Run.recent = (Run.recent + [self])[-4:]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def materialize(self, df: DataFrame, name: str = "out", output_mode: str = "append",
                    partition_by: list[str] | None = None) -> DataFrame:
        """Run a stream until its input is consumed; return what it wrote."""
        q = stream_to_path(df, self.path(name), self.checkpoint(name), output_mode=output_mode,
                           partition_by=partition_by, query_name=None)
        self.queries.append(finish(q))
        return self.spark.read.parquet(self.path(name))
