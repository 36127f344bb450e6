"""Versioned tables: one folder per run, made visible by a commit row."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("rows", T.LongType(), False),
    T.StructField("buckets", T.IntegerType()),
])
KEY = "hostname"


class SnapshotStore:
    """Tables under ``root/<table>/run_id=<id>/``.

    A run is first staged, then committed. Readers take the greatest committed
    run, so a job that fails half-way leaves the previous snapshot current, and
    no plan overwrites a path it reads. Older runs stay as history.

    With ``buckets`` set, runs are bucketed and sorted by hostname, and joins
    between them need no shuffle. Spark keeps bucketing in the catalog, so each
    run is then also an external table named ``fleetmatch_...`` there; the
    number of ``spark.sql.shuffle.partitions`` gives one file per bucket.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _path(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/run_id={run_id}"

    def _catalog_name(self, table: str, run_id: str) -> str:
        store = hashlib.md5(self.root.encode()).hexdigest()[:8]
        return f"fleetmatch_{store}_{table}_{run_id}".lower()

    def _existing(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _open(self, table: str, run_id: str, schema: T.StructType, buckets: int | None) -> DataFrame:
        path = self._path(table, run_id)
        if buckets is None:
            return self.spark.read.schema(schema).parquet(path)
        name = self._catalog_name(table, run_id)
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
        # Another session may have written the run; this one has to learn its buckets.
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) "
            f"SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def commits(self) -> DataFrame:
        return self._existing(f"{self.root}/commits", COMMIT_SCHEMA)

    def _current(self, table: str) -> tuple[str | None, int | None]:
        last = self.commits().where(F.col("table_name") == table).agg(
            F.max(F.struct("run_id", "buckets")).alias("last")).first()["last"]
        return (last["run_id"], last["buckets"]) if last else (None, None)

    def current_run(self, table: str) -> str | None:
        return self._current(table)[0]

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The current run of a table; empty before the first commit."""
        run_id, buckets = self._current(table)
        if run_id is None:
            return self.spark.createDataFrame([], schema)
        return self._open(table, run_id, schema, buckets)

    def read_run(self, table: str, run_id: str, schema: T.StructType) -> DataFrame:
        """A committed run; empty if it is not committed or has expired."""
        found = self.commits().where((F.col("table_name") == table) & (F.col("run_id") == run_id)).first()
        if found is None:
            return self.spark.createDataFrame([], schema)
        if found["buckets"] is None:
            return self._existing(self._path(table, run_id), schema)
        return self._open(table, run_id, schema, found["buckets"])

    def stage(self, table: str, run_id: str, rows: DataFrame, schema: T.StructType) -> DataFrame:
        """Write a run without making it current, and return what was written.

        Counts and joins that follow read this copy, so the export is parsed once.
        """
        current = self.current_run(table)
        if current is not None and run_id <= current:  # one that was not committed is written again
            raise ValueError(f"run {run_id} of {table} is not newer than the current run {current}")
        path = self._path(table, run_id)
        writer = rows.select(schema.fieldNames()).write.mode("overwrite")
        if self.buckets is None:
            writer.parquet(path)
        else:
            (writer.format("parquet").option("path", path).bucketBy(self.buckets, KEY).sortBy(KEY)
             .saveAsTable(self._catalog_name(table, run_id)))
        return self._open(table, run_id, schema, self.buckets)

    def commit(self, table: str, run_id: str, rows: int) -> None:
        values = zip(COMMIT_SCHEMA.fields, (table, run_id, rows, self.buckets))
        row = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(value).cast(field.dataType).alias(field.name) for field, value in values])
        row.write.mode("append").parquet(f"{self.root}/commits")

    def committed_rows(self, table: str, run_id: str) -> int | None:
        """Rows of a committed run; None if it is not committed."""
        found = self.commits().where((F.col("table_name") == table) & (F.col("run_id") == run_id)).first()
        return found["rows"] if found else None

    def append(self, dataset: str, append_id: str, rows: DataFrame) -> None:
        """Add rows once: the same ``append_id`` again replaces them."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{dataset}/append_id={append_id}")

    def read_appended(self, dataset: str, schema: T.StructType) -> DataFrame:
        return self._existing(f"{self.root}/{dataset}", schema).select(schema.fieldNames())

    def expire(self, table: str, keep: int) -> list[str]:
        """Delete all committed runs of a table but the last ``keep``; returns the runs deleted.

        Their commit rows stay, as the history of what was loaded.
        """
        if keep < 1:
            raise ValueError("at least the current run has to stay")
        runs = [row["run_id"] for row in self.commits().where(F.col("table_name") == table)
                .select("run_id").distinct().orderBy(F.desc("run_id")).collect()]  # one row per run
        gone = []
        for run_id in runs[keep:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(table, run_id)}")
            if self._delete(self._path(table, run_id)):
                gone.append(run_id)
        return gone

    def _delete(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
