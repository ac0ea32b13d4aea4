"""What the operators share: the shared folder, written intermediate tables, batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerstats import files


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which driver and executors share.

    Where the setting is absent, a temporary folder is made, on a local master only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='ledgerstats-llm-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: the lineage ends
    at files that outlive any executor, and later jobs do not compute the rows again."""
    path = new_folder(df.sparkSession, name)
    _WRITTEN.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders of intermediate tables, by application.
_WRITTEN: dict[str, list[str]] = {}


def clear_written(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written so far. Only results
    that are themselves stored may be read after that. Returns how many there were."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        files.delete(spark, path)
    return len(paths)


#: Bytes of input for a partition of a shuffle, and partitions at most.
PARTITION_BYTES, MOST_PARTITIONS = 128 * 1024**2, 200_000


def size_session(spark: SparkSession, input_bytes: int) -> None:
    """Shuffles start with partitions in proportion to the stored input, at least
    `spark.sql.shuffle.partitions`, and adaptive execution merges what turns out small."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_PARTITIONS, -(-input_bytes // PARTITION_BYTES))
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", max(least, wanted)
    )


def dealt_to_tasks(files: DataFrame, per_task: int) -> DataFrame:
    """A list of files, a row each, in about so many a task, but in as many tasks as run at
    once where there are fewer. The number is stated, as adaptive execution would else merge
    the short list into one task, which would read all files."""
    n, at_once = files.count(), files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(n, at_once), -(-n // per_task)))


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once an application."""
    context = spark.sparkContext
    if getattr(context, "_ledgerstats_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="ledgerstats-code-")) / "ledgerstats.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    context._ledgerstats_shipped = True


def by_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: T.StructType
) -> DataFrame:
    """Rows of `schema` from each Arrow batch. `make()` is called once a task and returns
    the function of a batch, which gives columns by name."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns_of = make()
        for batch in batches:
            # Part of a batch at a time, as texts may be very long.
            for at in range(0, batch.num_rows, 2000):
                columns = columns_of(batch.slice(at, 2000))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)
