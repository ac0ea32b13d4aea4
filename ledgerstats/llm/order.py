"""Sequences of token ids in training order: fixed-stride shards by a keyed permutation.

A sequence is known by its document's id and its number there; the two make one index. A
Feistel network over pairs of numbers, keyed by a seed, permutes the domain of these indices,
and a value that falls outside is permuted again until it falls inside. The domain has many
more indices than there are sequences, which need not be counted before they are made: shards
are equal ranges of the permuted domain, and a sequence's global slot is its rank there. So
texts are tokenized and shuffled once, and the order depends on ids and key alone.

Each shard has the records of a range of slots, all of one stride: record s of a shard begins
at byte s * stride. A reader that stopped at a slot goes on there with one seek.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ledgerstats.llm.common import by_batch, dealt_to_tasks, new_folder, ship, written
from ledgerstats.llm.tokens import tokenizer

#: Ids of a sequence at most; a record has a count before them and is filled up with zeros.
LENGTH = 256
END = 0
ID, ID_BYTES = "<u2", 2
STRIDE = ID_BYTES * (LENGTH + 1)
#: Bytes of text for a shard, which give 20 to 30 MB of records.
SHARD_BYTES = 32 * 1024**2
#: Shards at most; of larger tables they are larger.
MOST_SHARDS = 1 << 16
#: Shards that a task reads, about, where there are many.
SHARDS_PER_TASK = 8
ROUNDS = 6
#: A value is permuted again at most so often. Fewer values lie outside than one side of the
#: domain has, so for small domains this always suffices; for others the chance that it does
#: not, which raises an error, is the inverse of the other side to this power.
WALKS = 48
LARGEST_DOMAIN = 1 << 61

SEQUENCES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("sequence", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("row", T.LongType()),
    ]
)


def sequences(docs: DataFrame, files: tuple[str, str, str], length: int = LENGTH) -> DataFrame:
    """The ids of each whole text and an end id, cut into sequences, with the text's row."""

    def make():
        own = tokenizer(*files)
        if own.size > np.iinfo(ID).max + 1:
            raise ValueError(f"ids of {own.size} tokens do not fit {ID_BYTES} bytes")

        def columns(batch):
            doc_ids, numbers, parts, of = [], [], [], []
            for doc_id, text, row in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            ):
                ids = np.append(own.encode(text.as_py() or ""), END).astype(ID).tobytes()
                cuts = range(0, len(ids), length * ID_BYTES)
                doc_ids += [doc_id] * len(cuts)
                of += [row] * len(cuts)
                numbers += range(len(cuts))
                parts += [ids[at : at + length * ID_BYTES] for at in cuts]
            return {"doc_id": doc_ids, "sequence": numbers, "ids": parts, "row": of}

        return columns

    row = F.monotonically_increasing_id().alias("row")
    return by_batch(docs.select(F.col("doc_id").cast("long"), "text", row), make, SEQUENCES)


def sides(n: int) -> tuple[int, int]:
    """A number of bits and a number whose product, as sizes, is n or a little more."""
    bits = (n - 1).bit_length() // 2
    return bits, -(-n >> bits)


def permuted(index: Column, n: int, key: int) -> Column:
    """The place of an index, both from 0 to n - 1."""
    bits, b = sides(n)
    a = 1 << bits

    def once(x: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            left, right = state["l"], state["r"]
            moved_l = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(key), i), F.lit(a)), F.lit(a))
            moved_r = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(key), i), F.lit(b)), F.lit(b))
            odd = i % 2 == 1
            return F.struct(
                F.when(odd, moved_l).otherwise(left).cast("long").alias("l"),
                F.when(odd, right).otherwise(moved_r).cast("long").alias("r"),
            )

        low, high = x.bitwiseAND(F.lit(a - 1)), F.shiftright(x, bits)
        start = F.struct(low.cast("long").alias("l"), high.cast("long").alias("r"))
        rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(rounds, start, step, lambda s: F.shiftleft(s["r"], bits) + s["l"])

    def walk(x: Column, i: Column) -> Column:
        return F.when((i > 1) & (x < n), x).otherwise(once(x))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), index.cast("long"), walk)
    return F.when(found < n, found).otherwise(F.raise_error(F.lit("a walk did not end")))


SLOTS = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("byte_offset", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("sequence", T.IntegerType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


RANKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("path", T.StringType()),
        *SLOTS.fields[4:],
    ]
)


def in_training_order(
    docs: DataFrame,
    files: tuple[str, str, str],
    key: int,
    folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write all sequences to shards below `folder`; one row a sequence with its slot and place.

    A null or empty text is the end id alone. Rows that repeat a doc_id, or have none, are
    written each; where there are such, which may be very many of one id, every row's place
    follows from its id and its number in the table's files, so that they spread over all
    shards. Ids that span too wide a range for the domain are replaced by a hash of them, and
    the few that then meet stand next to one another. An empty table gives no shards and no
    rows. Further columns are ignored. A task that is tried again writes under another name;
    only shards that the rows name count.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "shards")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.agg(
        F.count("*").alias("n"),
        F.coalesce(F.min("doc_id"), F.lit(0)).alias("least"),
        F.coalesce(F.max("doc_id"), F.lit(0)).alias("most"),
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("longest"),
    ).first()
    if not known["n"]:
        return spark.createDataFrame([], SLOTS)
    # An id is a byte or more, so no text has more sequences than this.
    per_doc = -(-(known["longest"] + 1) // LENGTH)
    span = known["most"] - known["least"] + 2
    unique = docs.agg(F.count_distinct("doc_id")).first()[0] == known["n"]
    if not unique:
        span = LARGEST_DOMAIN // per_doc
        place = F.pmod(F.xxhash64("doc_id", "row"), F.lit(span))
    elif span * per_doc <= LARGEST_DOMAIN:
        place = F.col("doc_id") - known["least"] + 1
    else:
        span = LARGEST_DOMAIN // per_doc
        place = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    domain = span * per_doc
    shards = min(MOST_SHARDS, max(1, -(-known["bytes"] // shard_bytes)))
    index = place.cast("long") * per_doc + F.col("sequence")
    width = F.lit(-(-domain // shards))
    numbered = sequences(docs, files).withColumn("place", permuted(index, domain, key))
    ranges = (
        numbered.select(
            F.round((F.col("place") - F.pmod("place", width)) / width).cast("int").alias("shard"),
            "place",
            "doc_id",
            "sequence",
            "ids",
        )
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("place", "doc_id", "sequence", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, path, rank = None, "", 0
        schema = to_arrow_schema(RANKS)
        for batch in batches:
            rows, records = [], []
            for shard, _, doc_id, sequence, ids in zip(
                *(batch.column(i).to_pylist() for i in range(5))
            ):
                if out is None:
                    system.create_dir(base, recursive=True)
                    path = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
                    out = system.open_output_stream(f"{base}/{path}")
                count = len(ids) // ID_BYTES
                record = np.array([count], ID).tobytes() + ids
                records.append(record.ljust(STRIDE, b"\0"))
                crc = zlib.crc32(np.frombuffer(ids, ID).astype("<u4").tobytes())
                rows.append((shard, rank, path, doc_id, sequence, count, crc))
                rank += 1
            if rows:
                out.write(b"".join(records))
                columns = [pa.array(x, f.type) for x, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if out is not None:
            out.close()

    ranked = written(ranges.mapInArrow(run, RANKS), "slots")
    # One row a shard, `MOST_SHARDS` at most.
    counts = ranked.groupBy("shard").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    return ranked.join(F.broadcast(begins), "shard").select(
        (F.col("begin") + F.col("rank")).alias("slot"),
        "shard",
        F.concat(F.lit(f"{folder}/"), "path").alias("path"),
        (F.col("rank") * STRIDE).alias("byte_offset"),
        "doc_id",
        "sequence",
        "n_tokens",
        "ids_crc32",
    )


RECORDS = T.StructType(
    [T.StructField("slot", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
)


def read_from(slots: DataFrame, first: int = 0) -> DataFrame:
    """The ids of every slot from `first` on, read from the shards that `slots` names, each
    from one seek to its end."""
    ship(slots.sparkSession)
    shards = slots.filter(F.col("slot") >= first).groupBy("path").agg(
        F.min("slot").alias("slot"), F.min("byte_offset").alias("byte_offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(RECORDS)
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                slot = row["slot"]
                with system.open_input_file(path) as stream:
                    stream.seek(row["byte_offset"])
                    while block := stream.read(4096 * STRIDE):
                        records = np.frombuffer(block, ID).reshape(-1, LENGTH + 1)
                        ids = [r[1 : 1 + r[0]].astype(np.int32) for r in records]
                        columns = [pa.array(range(slot, slot + len(ids)), pa.int64())]
                        columns.append(pa.array(ids, schema[1].type))
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)
                        slot += len(ids)

    shards = dealt_to_tasks(written(shards, "shards-to-read"), SHARDS_PER_TASK)
    return shards.mapInArrow(run, RECORDS)
