"""Column picking, batching and scratch tables shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Mapping
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetmatch
from fleetmatch.session import scratch_path


BATCH_BYTES = 1 << 22

_shipped: set[str] = set()
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; they need not have it installed.

    Arrow batches, which tasks hold several times, get small unless the user set their size.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    if not context.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    root = Path(fleetmatch.__file__).parent
    if root.is_dir():  # else it came to this process in an archive already
        archive = Path(tempfile.mkdtemp(prefix="fleetmatch-code-")) / "fleetmatch-code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def position_of(df: DataFrame, name: str) -> int:
    """Index of a column: the exact name wins over one that differs in case."""
    names = df.columns
    if name in names:
        return names.index(name)
    alike = [i for i, other in enumerate(names) if other.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"no column {name!r} among {names}")
    return alike[0]


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The columns ``{new name: name}`` alone; other columns, whatever their names, do not matter."""
    ship(df.sparkSession)
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{position_of(df, name)}").alias(new) for new, name in columns.items()])


def numbered(df: DataFrame) -> DataFrame:
    """The same columns under the names ``_0``, ``_1``, ..., which clash with nothing an operator adds."""
    ship(df.sparkSession)
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there and every branch reads the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_latin_1(text: str) -> bool:
    """Whether all characters are below U+0100; much faster than a search."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` text bytes, so that arrays made from them stay small.

    A single longer text is a slice of its own; nothing is cut inside a text.
    """
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False))
        group = np.cumsum(lengths, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), rows]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)
