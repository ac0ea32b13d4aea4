"""Near-duplicate documents by one-permutation hashing, confirmed on full shingle sets.

A document's sketch takes one hash of its shingles: its range is cut into bins, and each keeps
the smallest value in it. An empty bin borrows from the first filled one in an order of bins of
its own, drawn once for all documents, so that filled and borrowed bins agree as often as sets
overlap. Bands of bins make buckets. A bucket's candidates are the edges of a star from its
centre, the member that shares most buckets with others, so a bucket of copies costs one edge a
member. Where confirmed edges do not make a bucket one component, the members that they leave
apart are compared in blocks, each in a task that gives only what links components. So no link
between documents that share a bucket is lost, and pairs are never rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch, ship, written
from ledgerstats.llm.components import components
from ledgerstats.llm.shingles import combined, shingle_set

WIDTH = 5
#: Documents are linked from this similarity on, in hundredths.
PERCENT = 85
#: The chance at most that no band of two sets agrees in all its bins at the least similarity.
MISS = 3e-7
#: Shingles of the members of a block, about, where a bucket is compared in blocks.
BLOCK_SHINGLES = 1 << 19
#: And members of a block: those of two blocks meet in matrices of their number squared.
BLOCK_MEMBERS = 1 << 11
#: Rows of such a matrix that are compared at a time.
SLAB = 1 << 8
#: Shingles whose counts in two members are multiplied at a time.
COLUMNS = 1 << 12


def shape(percent: int) -> tuple[int, int]:
    """Bands, and bins of each, for links from `percent` on: 32 of 6 at 85, 38 of 5 at 80."""
    rows = 6 if percent >= 85 else 5
    differ = max(1 - (percent / 100) ** rows, MISS)
    return math.ceil(math.log(MISS) / math.log(differ)), rows


@lru_cache
def _bins(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each of n bins begins, and whom it borrows from in turn."""
    edges = np.array([(i << 64) // n for i in range(n)], dtype=np.uint64)
    return edges, np.stack([np.random.default_rng(i).permutation(n) for i in range(n)])


SKETCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType(), False)),
    ]
)
SETS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shingles", T.ArrayType(T.LongType(), False)),
    ]
)


def sketch(shingles: np.ndarray, n: int) -> np.ndarray:
    """The smallest hash of each of n bins, empty bins filled from others."""
    edges, borrowed = _bins(n)
    at = np.searchsorted(shingles, edges)
    filled = np.diff(np.append(at, len(shingles))) > 0
    values = shingles[np.minimum(at, len(shingles) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        orders = borrowed[empty]
        lender = orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]
        values[empty] = values[lender]
    return values


def band_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    bands, rows = shape(percent)
    bins = sketch(shingles, bands * rows).reshape(bands, rows)
    return combined(bins, np.arange(bands)).view(np.int64)


def sketches(
    docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Set size, digest of the set and bucket keys of every whole text."""

    def make():
        def one(text: str | None):
            shingles = shingle_set(text or "", width)
            if not len(shingles):
                return 0, None, None
            digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
            return len(shingles), digest, band_keys(shingles, percent)

        def columns(batch):
            rows = [one(x.as_py()) for x in batch.column(1)]
            return {
                "doc_id": batch.column(0),
                "n_shingles": [r[0] for r in rows],
                "digest": [r[1] for r in rows],
                "bands": [r[2] for r in rows],
            }

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), text), make, SKETCHES)


def shingle_sets(docs: DataFrame, text: str, width: int) -> DataFrame:
    def make():
        def columns(batch):
            sets = [shingle_set(x.as_py() or "", width).view(np.int64) for x in batch.column(1)]
            return {"doc_id": batch.column(0), "shingles": sets}

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), text), make, SETS)


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (leaf, centre) whose full sets are similar enough, as (u, v), u before v.

    A leaf's set moves once for each of its edges, a centre's once for each `BLOCK_MEMBERS` of
    them: a centre of more has its edges dealt into shares.
    """
    counts = edges.groupBy("centre").agg(F.count("*").alias("n"))
    shares = written(
        counts.select("centre", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int").alias("shares")),
        "centres",
    )
    share = F.pmod(F.xxhash64("leaf"), F.coalesce("shares", F.lit(1))).cast("int")
    leaves = sets.select(F.col("doc_id").alias("leaf"), F.col("shingles").alias("a"))
    dealt = (
        edges.join(shares.filter("shares > 1"), "centre", "left")
        .select("leaf", "centre", share.alias("share"))
        .join(leaves, "leaf")
    )
    centres = sets.select(F.col("doc_id").alias("centre"), F.col("shingles").alias("b")).join(
        shares, "centre"
    )
    copies = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")
    pairs = dealt.join(centres.select("centre", copies, "b"), ["centre", "share"])
    small, large = F.least(F.size("a"), F.size("b")), F.greatest(F.size("a"), F.size("b"))
    both = F.size(F.array_intersect("a", "b"))
    near = pairs.filter(100 * small >= percent * large).filter(
        100 * both >= percent * (small + large - both)
    )
    u, v = F.least("leaf", "centre").alias("u"), F.greatest("leaf", "centre").alias("v")
    return near.select(u, v).distinct()


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets have in common."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[element]
    owner, column = owner[shared[element]], column[shared[element]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.int32)
    for at in range(0, int(shared.sum()), COLUMNS):
        first, last = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[first:last], column[first:last] - at] = 1
        for row in range(0, len(sets), SLAB):
            total[row : row + SLAB] += (held[row : row + SLAB] @ held.T).astype(np.int32)
    return total


def linking(ids: np.ndarray, names: np.ndarray, sets: list[np.ndarray], percent: int):
    """Pairs of ids, fewer than there are members, that tie together all members which links
    between different components tie together."""
    both, sizes = common(sets), np.array([len(x) for x in sets])
    similar = np.empty(both.shape, bool)
    slabs = [slice(at, at + SLAB) for at in range(0, len(ids), SLAB)]
    for rows in slabs:
        shared = both[rows].astype(np.int64)
        similar[rows] = 100 * shared >= percent * (sizes[rows, None] + sizes[None] - shared)
        similar[rows] &= names[rows, None] != names[None]
    del both
    label = np.arange(len(ids))
    while True:
        least = [np.where(similar[rows], label, len(ids)).min(axis=1) for rows in slabs]
        least = np.concatenate(least)
        after = np.minimum(label, least)
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[moved]], ids[moved]


PAIRS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def dealt_to_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of each bucket with their sets, for each two blocks (low, high) that meet.

    A bucket whose sets or members are too many for one task has several blocks.
    """
    sized = members.join(sets, "doc_id").withColumn("size", F.size("shingles").cast("long"))
    loads = F.sum("size") / F.lit(BLOCK_SHINGLES), F.count("*") / F.lit(BLOCK_MEMBERS)
    blocks = (
        members.join(sets.select("doc_id", F.size("shingles").alias("size")), "doc_id")
        .groupBy("bucket")
        .agg(F.greatest(*[F.ceil(x) for x in loads]).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    return (
        sized.join(blocks, "bucket")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )


def compared_in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What links different components of (bucket, doc_id, component) within a bucket, each
    two of its blocks compared in a task."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        found = linking(
            rows["doc_id"].to_numpy(),
            rows["component"].to_numpy(),
            list(rows["shingles"]),
            percent,
        )
        return pd.DataFrame({"u": found[0], "v": found[1]})

    ship(members.sparkSession)
    # Rows dealt by bucket would also serve a grouping by its three columns, and a bucket's
    # blocks would all run in one task; they do not serve one by a column of its own.
    blocks = dealt_to_blocks(members, sets).withColumn("pair", F.struct("bucket", "low", "high"))
    blocks = blocks.select("pair", "doc_id", "component", "shingles")
    return blocks.groupBy("pair").applyInPandas(compare, PAIRS).distinct()


def near_links(docs: DataFrame, classes: DataFrame, text: str, width: int, percent: int):
    """(node, component) over the documents of `classes` that are linked with others."""
    # Two different sets have n of n + 1 shingles in common at most, n those of the smaller.
    # So a set below this size is near no other one.
    able = classes.filter(F.lit(100) * F.col("n_shingles") >= percent * (F.col("n_shingles") + 1))
    keys = able.select("doc_id", F.explode("bands").alias("bucket"))
    shared = (
        keys.groupBy("bucket")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n"))
        .filter("a < b")
        .select("bucket", "n")
    )
    members = written(keys.join(shared, "bucket").distinct(), "members")
    # The member with most others in its buckets: of copies with edits, likely the original.
    company = members.groupBy("doc_id").agg(F.sum("n").alias("company"))
    # The ids grow with the corpus, so the join is one that holds at any size.
    shared_docs = docs.join(company.hint("merge"), "doc_id", "left_semi")
    sets = written(shingle_sets(shared_docs, text, width).distinct(), "sets")
    centre = F.max(F.struct("company", (-F.col("doc_id")).alias("minus")))
    stars = (
        members.join(company, "doc_id")
        .groupBy("bucket")
        .agg(centre.alias("c"))
        .select("bucket", (-F.col("c.minus")).alias("centre"))
    )
    # The centre is compared with every other member here, so it need not be again.
    leaves = written(
        members.join(stars, "bucket").filter("doc_id <> centre").drop("n"), "leaves"
    )
    # Two documents that are each other's centre, in different buckets, are compared once.
    pair = F.least("doc_id", "centre"), F.greatest("doc_id", "centre")
    once = leaves.groupBy(pair[0].alias("u"), pair[1].alias("v")).agg(
        F.max("centre").alias("centre")
    )
    leaf = F.when(F.col("centre") == F.col("u"), F.col("v")).otherwise(F.col("u"))
    edges = written(once.select(leaf.alias("leaf"), "centre"), "edges")
    links = written(confirmed(edges, sets, percent), "links")
    found = written(components(links), "components")
    current = leaves.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    apart = (
        current.groupBy("bucket")
        .agg(F.min("component").alias("a"), F.max("component").alias("b"))
        .filter("a < b")
        .select("bucket")
    )
    rest = written(current.join(apart, "bucket", "left_semi"), "apart")
    more = written(compared_in_blocks(rest, sets, percent), "links")
    return found if more.isEmpty() else written(components(links.unionByName(more)), "components")


def near_duplicates(
    docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Set size, component and whether it is its component's first, for each document.

    Documents with equal sets are linked, as are those whose sets' intersection has at least
    `percent` hundredths of the union. A null text, or one without words, has the empty set
    and is linked with nothing. Rows that repeat a doc_id and text are one document, and
    repeat in the result. A row without doc_id is linked with nothing: its component is null
    and it is kept. Further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    drawn = written(sketches(docs, text, width, percent), "sketches")
    own = drawn.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    # Equal digests have equal bands, so any of them will do.
    classes = written(
        own.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    found = near_links(docs, classes, text, width, percent)
    named = classes.select("digest", F.col("doc_id").alias("node"))
    named = named.join(found, "node", "left")
    named = named.select("digest", F.coalesce("component", "node").alias("component"))
    rows = drawn.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    known = F.col("doc_id").isNotNull()
    component = F.when(known, F.coalesce("component", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.when(known, F.col("doc_id") == component).otherwise(True).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of one document of each group, with all their columns."""
    found = near_duplicates(docs, text, percent=percent)
    gone = found.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
