"""The rows of each key in order where one key may hold a third of all rows.

Rows are sorted by key and order over all tasks, so the rows of a large key lie in several
parts that follow one another. What one part knows of a key is small, and there is one such row
a key and part: running numbers and sums of a key are those of a part after those of the parts
before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ledgerstats.llm.common import ship, written

#: A part has about so many rows at most.
PART_ROWS = 1 << 18
PART_BITS = 33  # of a monotonically increasing id: the row within its task
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_CHUNK = 1 << 10


def n_parts(rows: DataFrame) -> int:
    """Parts for these rows: so many that each has a bounded number of them."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() // PART_ROWS))


def sorted_parts(rows: DataFrame, parts: int, key: Sequence[Column], order: Sequence[Column]):
    """The rows sorted by key and order over `parts` tasks."""
    return rows.repartitionByRange(parts, *key, *order).sortWithinPartitions(*key, *order)


def in_parts(rows: DataFrame, key: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The rows, written, with `part` and, ascending in the order of all rows, `place`."""
    dealt = sorted_parts(rows, n_parts(rows), [F.col(k) for k in key], order)
    placed = written(dealt.withColumn("place", F.monotonically_increasing_id()), name)
    return placed.withColumn("part", F.shiftright("place", PART_BITS))


def before(parts: DataFrame, key: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """To each row (key, part): running aggregates over the key's parts before it."""
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns(
        {name: F.coalesce(total.over(earlier), F.lit(0)) for name, total in sums.items()}
    )


def numbered(rows: DataFrame, key: str, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with `part` and their `position` within the key, from 1."""
    placed = in_parts(rows, [key], order, name)
    parts = placed.groupBy(key, "part").agg(
        F.count("*").alias("n"), F.min("place").alias("first")
    )
    begins = before(parts, [key], {"begin": F.sum("n")}).select(
        key, "part", (F.col("begin") - F.col("first") + 1).alias("shift")
    )
    return (
        placed.join(begins, [key, "part"])
        .withColumn("position", F.col("place") + F.col("shift"))
        .drop("place", "shift")
    )


def streamed_sha256(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], text: str, separator: str
) -> DataFrame:
    """(key, sha256): lowercase hex digest of each key's texts in order, with a separator.

    A digest of this kind has no parts that could be put together, so the texts of one key pass
    one task, as a stream: only a batch of them is held at a time.
    """
    ship(rows.sparkSession)
    keys = [rows.schema[k] for k in key]
    schema = T.StructType([*keys, T.StructField("sha256", T.StringType())])
    sorted_rows = (
        rows.repartition(*key)
        .sortWithinPartitions(*key, *order)
        .select(*key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, current, digest, done = to_arrow_schema(schema), None, None, []

        def batch_of(found):
            columns = [pa.array(x, f.type) for x, f in zip(zip(*found), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            values = [batch.column(i).to_pylist() for i in range(len(keys))]
            for own, line in zip(zip(*values), batch.column(len(keys))):
                if digest is None or own != current:
                    if digest is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = own, hashlib.sha256()
                else:
                    digest.update(separator.encode())
                digest.update(line.as_py().encode())
            if done:
                yield batch_of(done)
                done = []
        if digest is not None:
            yield batch_of([(*current, digest.hexdigest())])

    return sorted_rows.mapInArrow(run, schema)


def id_list_sha256(rows: DataFrame, key: Sequence[str], id_: str, name: str) -> DataFrame:
    """(key, sha256): digest of each key's ids as decimals, ascending, joined by commas.

    The ids become lines of many before they are digested, so few rows meet in one task.
    """
    placed = in_parts(rows.select(*key, id_), key, [F.col(id_)], name)
    ids = F.transform(F.array_sort(F.collect_list(id_)), lambda x: x.cast("string"))
    lines = placed.groupBy(
        *key, F.floor(F.col("place") / ROWS_PER_CHUNK).cast("long").alias("line")
    ).agg(F.array_join(ids, ",").alias("ids"))
    return streamed_sha256(lines, key, ["line"], "ids", ",")
