"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "fleetmatch", **settings: str) -> SparkSession:
    """A session with the settings the jobs are designed for.

    On a cluster, leave ``master`` unset and let spark-submit supply it together
    with ``spark.checkpoint.dir``. ``shuffle_partitions`` should give partitions
    of 100 to 200 MB; adaptive execution merges the ones that turn out small.
    Further ``settings`` are Spark options with ``_`` for ``.`` in their names.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="fleetmatch-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, under the application's own folder.

    Results may be read lazily from it, so it has to stay until the application
    ends; then the whole application folder can go.
    """
    application = spark.sparkContext.applicationId
    return os.path.join(shared_folder(spark), "fleetmatch", application, f"{name}-{uuid.uuid4().hex}")


def iso_text(moment: datetime) -> str:
    """ISO-8601 in UTC with milliseconds, e.g. 2024-01-31T00:00:00.000Z."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime("%Y-%m-%dT%H:%M:%S.") + f"{moment.microsecond // 1000:03d}Z"


def moment_of(run_id: str) -> datetime:
    """The moment, in UTC, that a run id stands for."""
    return datetime.strptime(run_id, "%Y%m%dT%H%M%S%f")


def run_id_of(moment: datetime) -> str:
    """Run ids sort like the moments they stand for."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime("%Y%m%dT%H%M%S%f")
