"""Versioned tables that share unchanged buckets between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.session import moment_of
from fleetmatch.sources.snapshots import KEY, SnapshotStore

MANIFEST_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("data_run", T.StringType()),
])
MANIFESTS = "manifests"
RUN_TIME_COLUMNS = ("imported_at", "updated_at", "last_updated")  # the same in all rows of a run
HASHES = ("row_hash_1", "row_hash_2")
BUCKET = "bucket"


class MergedSnapshots(SnapshotStore):
    """A store whose runs write only the buckets in which a row was inserted, changed or removed.

    Rows lie in ``merge_buckets`` hash buckets of the hostname, under
    ``root/<table>/data_run=<id>/bucket=<n>/``, each with a hash of its content. A
    run's manifest names, for every bucket that has rows, the run that wrote it.
    Staging a run compares hostnames and hashes with the current run, in one join
    of three narrow columns, and writes the buckets in which they differ; an equal
    export writes no data. The times of a run, which are the same in all of its
    rows, are taken from the run and not kept with the rows.

    A manifest has at most ``merge_buckets`` rows, which come to the driver.
    """

    def __init__(self, spark: SparkSession, root: str, merge_buckets: int):
        super().__init__(spark, root)
        self.merge_buckets = merge_buckets

    def _bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.merge_buckets)).cast("int")

    def _manifest(self, table: str, run_id: str | None) -> dict[int, str]:
        if run_id is None:
            return {}
        rows = self._existing(f"{self.root}/{MANIFESTS}", MANIFEST_SCHEMA).where(
            (F.col("table_name") == table) & (F.col("run_id") == run_id))
        return {row[BUCKET]: row["data_run"] for row in rows.collect()}

    def _data_path(self, table: str, data_run: str) -> str:
        return f"{self.root}/{table}/data_run={data_run}"

    def _rows(self, table: str, manifest: dict[int, str], schema: T.StructType) -> DataFrame:
        paths = [f"{self._data_path(table, run)}/{BUCKET}={bucket}" for bucket, run in sorted(manifest.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _as_of(self, table: str, manifest: dict[int, str], run_id: str, schema: T.StructType) -> DataFrame:
        """The rows of a run, with its times."""
        kept = T.StructType([field for field in schema.fields if field.name not in RUN_TIME_COLUMNS])
        moment = F.lit(moment_of(run_id)).cast("timestamp_ntz")
        return self._rows(table, manifest, kept).select(*[
            moment.alias(name) if name in RUN_TIME_COLUMNS else F.col(name) for name in schema.fieldNames()])

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        run_id = self.current_run(table)
        return self._as_of(table, self._manifest(table, run_id), run_id, schema) if run_id else (
            self.spark.createDataFrame([], schema))

    def read_run(self, table: str, run_id: str, schema: T.StructType) -> DataFrame:
        if self.committed_rows(table, run_id) is None:
            return self.spark.createDataFrame([], schema)
        return self._as_of(table, self._manifest(table, run_id), run_id, schema)

    def _keys(self, table: str, manifest: dict[int, str]) -> DataFrame:
        return self._rows(table, manifest, T.StructType([
            T.StructField(KEY, T.StringType()), *[T.StructField(name, T.LongType()) for name in HASHES]]))

    @staticmethod
    def _compared(before: DataFrame, after: DataFrame) -> DataFrame:
        """Hostnames whose rows differ, with the ``change``: inserted, changed or stale."""
        old, new = before.alias("old"), after.alias("new")
        same = [F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}")) for name in HASHES]
        joined = old.join(new, F.col(f"old.{KEY}") == F.col(f"new.{KEY}"), "full_outer").where(~(same[0] & same[1]))
        change = (F.when(F.col(f"old.{KEY}").isNull(), "inserted").when(F.col(f"new.{KEY}").isNull(), "stale")
                  .otherwise("changed"))
        return joined.select(F.coalesce(f"new.{KEY}", f"old.{KEY}").alias(KEY), change.alias("change"))

    def changes(self, table: str, before: str, after: str) -> DataFrame | None:
        """What differs between two runs; only the buckets they do not share are read. None if one has expired."""
        for run_id in (before, after):
            if not self._is_kept(table, run_id):
                return None
        old, new = self._manifest(table, before), self._manifest(table, after)
        shared = {bucket for bucket in old if old[bucket] == new.get(bucket)}
        return self._compared(*[self._keys(table, {bucket: run for bucket, run in manifest.items() if bucket not in shared})
                                for manifest in (old, new)])

    def _is_kept(self, table: str, run_id: str) -> bool:
        rows = self.committed_rows(table, run_id)
        return rows is not None and (rows == 0 or bool(self._manifest(table, run_id)))

    def stage(self, table: str, run_id: str, rows: DataFrame, schema: T.StructType) -> DataFrame:
        current = self.current_run(table)
        if current is not None and run_id <= current:
            raise ValueError(f"run {run_id} of {table} is not newer than the current run {current}")
        content = [name for name in schema.fieldNames() if name not in RUN_TIME_COLUMNS]
        # A hash passes over NULLs, so it gets their places too.
        missing = F.concat(*[F.col(name).isNull().cast("string") for name in content])
        hashed = rows.select(*content, F.xxhash64(*content, missing).alias(HASHES[0]),
                             F.xxhash64(F.lit("second"), *content, missing).alias(HASHES[1]))
        old = self._manifest(table, current)
        if old:
            differing = self._compared(self._keys(table, old), hashed.select(KEY, *HASHES))
            changed = [row[0] for row in differing.select(self._bucket_of(F.col(KEY))).distinct().collect()]
        else:
            changed = list(range(self.merge_buckets))
        written: list[int] = []
        if changed:
            path = self._data_path(table, run_id)
            hashed = hashed.withColumn(BUCKET, self._bucket_of(F.col(KEY))).where(F.col(BUCKET).isin(changed))
            hashed.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
            found = self._existing(path, T.StructType([T.StructField(KEY, T.StringType()), T.StructField(BUCKET, T.IntegerType())]))
            written = [row[0] for row in found.select(BUCKET).distinct().collect()]
        manifest = {bucket: run for bucket, run in old.items() if bucket not in set(changed)}
        manifest.update({bucket: run_id for bucket in written})
        listed = [(table, run_id, bucket, run) for bucket, run in sorted(manifest.items())]
        self.append(MANIFESTS, f"{run_id}-{table}", self.spark.createDataFrame(listed, MANIFEST_SCHEMA).coalesce(1))
        return self._as_of(table, manifest, run_id, schema)

    def expire(self, table: str, keep: int) -> list[str]:
        """Delete the manifests of all committed runs but the last ``keep``, and the buckets that no other run names."""
        if keep < 1:
            raise ValueError("at least the current run has to stay")
        runs = [row["run_id"] for row in self.commits().where(F.col("table_name") == table)
                .select("run_id").distinct().orderBy(F.desc("run_id")).collect()]  # one row per run
        named = {(bucket, run) for run_id in runs[:keep] for bucket, run in self._manifest(table, run_id).items()}
        gone = []
        for run_id in runs[keep:]:
            manifest = self._manifest(table, run_id)
            own = [bucket for bucket, run in manifest.items() if run == run_id]
            unnamed = [bucket for bucket in own if (bucket, run_id) not in named]
            paths = [f"{self._data_path(table, run_id)}/{BUCKET}={bucket}" for bucket in unnamed]
            if len(unnamed) == len(own):
                paths = [self._data_path(table, run_id)]
            deleted = [self._delete(path) for path in [*paths, f"{self.root}/{MANIFESTS}/append_id={run_id}-{table}"]]
            if any(deleted):
                gone.append(run_id)
        return gone
