"""Packing documents into sequences of a fixed number of tokens.

How many pieces there are of each length is a table of at most `CAPACITY` rows, whatever the
corpus. Its configuration linear program asks for the fewest sequences such that the chosen
configurations, multisets of lengths that fit one sequence, cover all pieces. Multiplicative
weights solve it: each length has a price, a knapsack by dynamic programming finds the
configurations of most value, and the prices of what these cover fall. The program's solution
is rounded down to whole sequences; what is left, again by length, is packed by best fit.
The plan is then dealt out to the pieces by their rank among those of their length.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerstats.llm.common import by_batch, written
from ledgerstats.llm.tokens import tokenizer

CAPACITY = 2048
END = 0  # the id that ends every document
#: Rounds of prices and the step they fall by.
ROUNDS, STEP = 60, 0.15
#: Parts that the pieces of one length are numbered in: so many per shuffle partition, and
#: more where all pieces, of which most may have one length, are more than this a part.
PARTS_PER_PARTITION = 4
PART_ROWS = 1 << 20

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: all but the first have full length."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """Place, length and checksum of each piece of every whole text's ids and the end id."""

    def make():
        own = tokenizer(*files)

        def columns(batch):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(own.encode(text.as_py() or ""), END).astype("<u4")
                data = memoryview(ids.tobytes())
                for i, (at, n) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, i, at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
            found = list(zip(*rows)) or [()] * len(PIECES)
            return {f.name: found[i] for i, f in enumerate(PIECES)}

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), make, PIECES)


class Knapsack:
    """The most valuable multiset of lengths for each capacity, at given prices."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, capacity: int):
        self.lengths = lengths
        self.value = np.zeros(capacity + 1)
        self.choice = np.full(capacity + 1, -1)
        fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
        for c in range(1, capacity + 1):
            if n := fitting[c]:
                worth = self.value[c - lengths[:n]] + prices[:n]
                best = int(worth.argmax())
                if worth[best] > self.value[c]:
                    self.value[c], self.choice[c] = worth[best], best

    def configuration(self, first: int, capacity: int) -> tuple[int, ...]:
        """Indices of the lengths of the best configuration that holds length `first`."""
        held, room = [first], capacity - int(self.lengths[first])
        while room > 0 and self.choice[room] >= 0:
            held.append(int(self.choice[room]))
            room -= int(self.lengths[held[-1]])
        return tuple(sorted(held, reverse=True))


def solve(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS
) -> dict[tuple[int, ...], float]:
    """How often each configuration is used, covering every length's count about once.

    In a round one knapsack serves all configurations whose value at current prices is
    within a step of the best; each is used until one of its lengths is covered once more
    by a share, and the prices of its lengths fall accordingly.
    """
    used: dict[tuple[int, ...], float] = {}
    log_price = np.log(lengths / capacity)  # a start at which full sequences are worth one
    covered = np.zeros(len(lengths))
    for _ in range(rounds):
        prices = np.exp(log_price - log_price.max())
        table = Knapsack(lengths, prices, capacity)
        most = table.value[capacity]
        worth = prices + table.value[capacity - lengths]
        for first in np.argsort(-worth, kind="stable"):
            if worth[first] < (1 - STEP) * most:
                break
            held = table.configuration(int(first), capacity)
            index, times = np.unique(held, return_counts=True)
            if (np.exp(log_price[index] - log_price.max()) * times).sum() < (1 - STEP) * most:
                continue
            amount = float((counts[index] / times).min())
            used[held] = used.get(held, 0.0) + amount
            share = times * amount / counts[index]
            covered[index] += share
            log_price[index] -= STEP * share
    typical = max(float(np.median(covered)), 1e-9)
    return {held: x / typical for held, x in used.items()}


@dataclass
class Group:
    """Sequences with the same pieces: how many, and (length, times) in order."""

    number: int
    held: list[tuple[int, int]]


def best_fit(left: dict[int, int], capacity: int, groups: list[Group]) -> list[Group]:
    """Pack what is left, the longest first, each where the least room stays; sequences with
    the same pieces are handled together, so the work depends on lengths alone."""
    by_room: dict[int, list[Group]] = {}
    for group in groups:
        room = capacity - sum(n * times for n, times in group.held)
        by_room.setdefault(room, []).append(group)
    for length in sorted(left, reverse=True):
        n = left[length]
        for room in sorted(r for r in by_room if r >= length):
            fits = room // length
            while n and by_room[room]:
                group = by_room[room].pop()
                whole = min(group.number, n // fits)
                few = n % fits if whole < group.number and n < fits * (whole + 1) else 0
                rest = group.number - whole - (1 if few else 0)
                for number, times in ((whole, fits), (1 if few else 0, few)):
                    if number:
                        after = Group(number, [*group.held, (length, times)])
                        by_room.setdefault(room - times * length, []).append(after)
                if rest:
                    by_room[room].append(Group(rest, group.held))
                n -= whole * fits + few
            if not n:
                break
        fits = capacity // length
        for number, times in ((n // fits, fits), (1 if n % fits else 0, n % fits)):
            if number:
                by_room.setdefault(capacity - times * length, []).append(
                    Group(number, [(length, times)])
                )
    return [g for same in by_room.values() for g in same]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of sequences that hold every piece of the histogram once."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], float)
    left = dict(histogram)
    groups: list[Group] = []
    solution = solve(lengths, counts, capacity) if len(lengths) else {}
    ordered = sorted(solution.items(), key=lambda x: (-x[1], x[0]))
    for rounded in (math.floor, math.ceil):
        for held, amount in ordered:
            index, times = np.unique(held, return_counts=True)
            needs = [(int(lengths[i]), int(t)) for i, t in zip(index, times)][::-1]
            room = capacity - sum(n * t for n, t in needs)
            if rounded is math.ceil and room:
                continue  # a sequence more than the program asks for must be full
            most = rounded(amount) if rounded is math.floor else 1
            number = min(most, *(left[n] // t for n, t in needs))
            if number > 0:
                groups.append(Group(number, needs))
                for n, t in needs:
                    left[n] -= t * number
    return best_fit({n: c for n, c in left.items() if c}, capacity, groups)


def slots(groups: list[Group]) -> dict[str, np.ndarray]:
    """For every length and group: the ranks it takes, the first sequence and the offset."""
    rows, ranks, sequence = [], {}, 0
    for group in sorted(groups, key=lambda g: g.held, reverse=True):
        offset = 0
        for length, times in group.held:
            rank = ranks.get(length, 0)
            rows.append((length, rank, times, sequence, offset))
            ranks[length] = rank + times * group.number
            offset += length * times
        sequence += group.number
    found = np.array(sorted(rows), np.int64).reshape(-1, 5)
    names = ("length", "rank", "times", "sequence", "offset")
    return dict(zip(names, found.T))


PLACES = T.StructType(
    [
        *PIECES.fields,
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def pack(docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and place there.

    A null or empty text is the end id alone. Rows that repeat a doc_id are packed each, and a
    null doc_id is carried through. An empty table gives no rows. Further columns are ignored.
    `files` are the vocabulary as JSON, its ranks, and the pattern of words.
    """
    spark = docs.sparkSession
    cut_up = written(pieces(docs, files, capacity), "pieces")
    least = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, math.ceil(cut_up.count() / PART_ROWS))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    cut_up = cut_up.withColumn("part", part)
    counted = written(cut_up.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    # One row a length: at most `capacity`.
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    table = slots(plan({r["length"]: r["n"] for r in histogram}, capacity))
    shared = spark.sparkContext.broadcast(table)
    # A length's parts are numbered one after the other, each within itself.
    parts_before = Window.partitionBy("length").orderBy("part")
    earlier = parts_before.rowsBetween(Window.unboundedPreceding, -1)
    begins = counted.select(
        "length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        cut_up.withColumn("rank", F.row_number().over(within) - 1)
        .join(begins, ["length", "part"])
        .select(*PIECES.names, (F.col("rank") + F.col("begin")).alias("rank"))
    )

    def make():
        own = shared.value
        keys = (own["length"] << 44) | own["rank"]

        def columns(batch):
            given = {f.name: batch.column(i) for i, f in enumerate(PIECES)}
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            nth, times = rank - own["rank"][at], own["times"][at]
            return given | {
                "sequence_id": own["sequence"][at] + nth // times,
                "offset": own["offset"][at] + nth % times * length,
            }

        return columns

    return by_batch(ranked, make, PLACES)
