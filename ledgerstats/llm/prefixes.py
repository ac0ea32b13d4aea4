"""The prefix trie of conversations, by collapsing whole sequences.

Conversations with the same turns become one sequence with a weight, the smallest of their ids
and the list of all. A sequence that is a proper prefix of another is none of the trie's leaves.
A node is what sequences with the same first turns share, so every figure of a node is a sum or
minimum over the weighted prefixes of distinct sequences.

A prefix is known by 128 bits: the exclusive or of a digest of each turn with its place. It adds
up over the parts of a conversation that is too long for one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerstats.llm.common import written
from ledgerstats.llm.ordered import WORD, before, id_list_sha256, numbered

#: Conversations of one block share the first turns of the block's first conversation, up to so
#: many less one.
BLOCK, SHARED = 20, 4
NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of no bytes
NODE = ["depth", "a", "b"]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turn_digest() -> Column:
    """Of role and text; the length of the role keeps the two apart."""
    size = F.octet_length(_text("role")).cast("string")
    return F.sha2(F.concat(size, F.lit(":"), _text("role"), _text("text")), 256)


def _lane(digest: Column, start: int) -> Column:
    high = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digest, start + 8, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def with_lanes(rows: DataFrame) -> DataFrame:
    """`a` and `b`: 128 bits of the turn's digest with its place among the rebuilt turns."""
    placed = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("turn_digest")), 256)
    rows = rows.withColumn("placed", placed)
    return rows.select(
        "conv_id", "part", "place", "words",
        _lane(F.col("placed"), 1).alias("a"), _lane(F.col("placed"), 17).alias("b"),
    )


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, position, turn_digest, words) in the order of turns, nulls first.

    Rows of one turn stand in the order of their digests. The texts stay behind.
    """
    light = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest().alias("turn_digest"),
        F.regexp_count(_text("text"), F.lit(WORD)).cast("long").alias("words"),
        # Equal rows have equal sort keys but for this, and may be very many.
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("turn_digest"), F.col("row")]
    return numbered(light, "conv_id", order, "turns").drop("turn", "row")


def rebuilt(conversations: DataFrame, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id), and their turns (conv_id, part, place, words, a, b) after
    the first of each are replaced by those of its block's first conversation."""
    rows = written(turns(conversations), "numbered")
    ids = rows.select("conv_id").distinct().select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"),
        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).alias("h"),
    )
    ids = written(ids, "ids")
    # At most `shared` - 1 turns of a base, for the BLOCK conversations of its block.
    heads = rows.filter(F.col("position") < shared).select(
        F.col("conv_id").alias("base"), "position", "turn_digest", "words"
    )
    first = written(
        ids.join(heads, "base")
        .filter("position <= h")
        .select(
            "conv_id", F.lit(-1).cast("long").alias("part"), F.col("position").alias("place"),
            "turn_digest", "words",
        ),
        "heads",
    )
    taken = first.groupBy("conv_id").agg(F.count("*").alias("taken"))
    moved = ids.join(taken, "conv_id", "left").select(
        "conv_id", "h", (F.coalesce("taken", F.lit(0)) - F.col("h")).alias("shift")
    )
    own = rows.join(moved, "conv_id").filter("position > h").select(
        "conv_id", "part", (F.col("position") + F.col("shift")).alias("place"),
        "turn_digest", "words",
    )
    return ids.select("conv_id"), written(with_lanes(first.unionByName(own)), "rebuilt")


def collapsed(ids: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each conversation ends (conv_id, depth, a, b), and the distinct sequences with
    their weight and smallest id (depth, a, b, weight, sequence, words)."""
    whole = rows.groupBy("conv_id").agg(
        F.count("*").alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.sum("words").alias("words"),
    )
    names = ["depth", "a", "b", "words"]
    ends = written(
        ids.join(whole, "conv_id", "left").select(
            "conv_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names]
        ),
        "ends",
    )
    sequences = ends.groupBy(*NODE).agg(
        F.count("*").alias("weight"),
        F.min("conv_id").alias("sequence"),
        F.max("words").alias("words"),
    )
    return ends.drop("words"), written(sequences, "sequences")


def prefixes(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence, the empty one too: (sequence, weight, depth, a,
    b, parent_a, parent_b, rest), `rest` the words of the turns from its last on."""
    whole = sequences.select("sequence", "weight", F.col("words").alias("total"))
    kept = rows.withColumnRenamed("conv_id", "sequence").join(
        whole.select("sequence"), "sequence", "left_semi"
    )
    # Within a part the rows of a sequence are as many as a part has at most.
    parts = kept.groupBy("sequence", "part").agg(
        F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum("words").alias("sw")
    )
    begins = before(
        parts, ["sequence"],
        {"a0": F.bit_xor("xa"), "b0": F.bit_xor("xb"), "w0": F.sum("sw")},
    ).select("sequence", "part", "a0", "b0", "w0")
    so_far = Window.partitionBy("sequence", "part").orderBy("place")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = kept.withColumns(
        {
            "ra": F.bit_xor("a").over(so_far),
            "rb": F.bit_xor("b").over(so_far),
            "rw": F.sum("words").over(so_far),
        }
    ).join(begins, ["sequence", "part"])
    a, b = (F.col(x).bitwiseXOR(F.col(y)) for x, y in (("ra", "a0"), ("rb", "b0")))
    nodes = running.join(whole, "sequence").select(
        "sequence",
        "weight",
        F.col("place").alias("depth"),
        a.alias("a"),
        b.alias("b"),
        a.bitwiseXOR(F.col("a")).alias("parent_a"),
        b.bitwiseXOR(F.col("b")).alias("parent_b"),
        (F.col("total") - F.col("rw") - F.col("w0") + F.col("words")).alias("rest"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = whole.select(
        "sequence", "weight", zero.alias("depth"), zero.alias("a"), zero.alias("b"),
        none.alias("parent_a"), none.alias("parent_b"), F.col("total").alias("rest"),
    )
    return written(nodes.unionByName(roots), "prefixes")


def prefix_trie(conversations: DataFrame, shared: int = SHARED) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations.

    A null role or text is an empty one. Rows without conv_id belong to no conversation and
    take no part. Repeated rows are turns each; rows of one turn, which nothing orders, stand in
    the order of a digest of role and text. Texts are read whole and digested where they are.
    An empty table gives no rows, not even a root. Further columns are ignored.
    """
    ids, rows = rebuilt(conversations, shared)
    ends, sequences = collapsed(ids, rows)
    paths = prefixes(rows, sequences)
    counted = written(
        paths.groupBy(*NODE).agg(
            F.sum("weight").alias("n_convs"),
            F.min("sequence").alias("conv_id"),
            F.max("parent_a").alias("parent_a"),
            F.max("parent_b").alias("parent_b"),
            F.sum(F.col("weight") * F.col("rest")).alias("all_words"),
        ),
        "nodes",
    )
    # A sequence is a leaf unless it is a proper prefix, that is the parent of some prefix.
    parent = [(F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"),
              F.col("parent_b").alias("b")]
    children = written(
        counted.filter("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children")),
        "children",
    )
    leaves = sequences.join(children, NODE, "left_anti").select("sequence", F.lit(1).alias("leaf"))
    # A sequence stands for the nodes whose smallest member it is: those from some depth on. The
    # words of a node are counted once, with the sequence that stands for it.
    stands = counted.groupBy(F.col("conv_id").alias("sequence")).agg(F.min("depth").alias("own"))
    flagged = sequences.select("sequence").join(leaves, "sequence", "left")
    known = written(flagged.join(stands, "sequence", "left"), "known")
    own_rest = (
        paths.join(known.filter("own IS NOT NULL").select("sequence", "own"), "sequence")
        .filter("depth = own")
        .select("sequence", "own", F.col("rest").alias("own_rest"))
    )
    known = written(known.drop("own").join(own_rest, "sequence", "left"), "known-words")
    once = F.when(F.col("own").isNull(), 0).when(F.col("depth") < F.col("own"), F.col("own_rest"))
    below = (
        paths.join(known, "sequence")
        .groupBy(*NODE)
        .agg(
            F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
            F.sum(once.otherwise(F.col("rest"))).alias("distinct_words"),
        )
    )
    parents = counted.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"),
        F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"),
    )
    lists = id_list_sha256(ends, NODE, "conv_id", "end-lists")
    return (
        counted.join(parents, ["depth", "parent_a", "parent_b"], "left")
        .join(children, NODE, "left")
        .join(below, NODE)
        .join(lists, NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            (F.col("all_words") - F.col("distinct_words")).alias("saved_tokens"),
            F.coalesce("sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
