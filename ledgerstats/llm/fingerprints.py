"""Document fingerprints that add up: a multiset hash of a text's paragraphs.

A paragraph is a line, divided at sentence ends so that an edit within a long line leaves the
rest of it alone. Each is hashed with several seeds, 64 bits a seed: the first gives a sign for
each of its bits, each of the others two numbers below 2^32, so that all lanes are of the
paragraph itself and not of one hash of it. The fingerprint is the sum of these wide vectors over
all paragraphs, modulo 2^32. So it does not depend on the order of paragraphs, and those of an
added or removed paragraph are added or subtracted lane by lane.

The signs also tell how alike two texts are: the squared distance of two sums, by lane, is in
expectation the number of paragraphs in one text but not in the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SIGNS, WIDE = 64, 8
#: Of each lane. Sums of signs are told apart from negative ones up to 2^31 paragraphs.
MOD = 1 << 32
#: Ranges of ids that documents are dealt out by, per shuffle partition.
RANGES_PER_PARTITION = 4
PARAGRAPHS = r"\n+|(?<=[.!?]) +"


def bound(value: Column, use) -> Column:
    """`use(value)`, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def paragraphs(text: Column) -> Column:
    """Non-empty paragraphs, without spaces around them."""
    parts = F.transform(F.split(text, PARAGRAPHS), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def vector(text: Column) -> Column:
    """The fingerprint as lanes: `SIGNS` sums of signs, then `WIDE` sums of numbers."""
    zero = F.lit(0).cast("long")

    def signs(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(SIGNS - 1)),
            lambda i: F.aggregate(
                hashes,
                zero,
                lambda total, h: total + F.getbit(h, i) * 2 - 1,
                lambda total: F.pmod(total, F.lit(MOD)),
            ),
        )

    def numbers(hashes: Column) -> Column:
        def lane(part) -> Column:
            return F.aggregate(
                hashes, zero, lambda total, h: F.pmod(total + part(h), F.lit(MOD))
            )

        return F.array(
            lane(lambda h: h.bitwiseAND(F.lit(MOD - 1))),
            lane(lambda h: F.shiftrightunsigned(h, 32)),
        )

    def seeded(own: Column, seed: int) -> Column:
        # The seed comes first: the text is then hashed anew from the seed's hash on.
        return F.transform(own, lambda p: F.xxhash64(F.lit(seed), p))

    def lanes(own: Column) -> Column:
        rest = [bound(seeded(own, seed), numbers) for seed in range(1, 1 + WIDE // 2)]
        return F.concat(bound(seeded(own, 0), signs), *rest)

    return bound(paragraphs(text), lanes)


def insert(lanes: Column, added: Column) -> Column:
    """The fingerprint of a text with the paragraphs of another one added."""
    return F.transform(lanes, lambda x, i: F.pmod(x + F.get(added, i), F.lit(MOD)))


def delete(lanes: Column, removed: Column) -> Column:
    """The fingerprint of a text without the paragraphs of another one."""
    return F.transform(lanes, lambda x, i: F.pmod(x - F.get(removed, i), F.lit(MOD)))


def text_of(lanes: Column) -> Column:
    """The lanes in hexadecimal, eight digits each."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _signed(lane: Column) -> Column:
    return (F.pmod(lane + MOD // 2, F.lit(MOD)) - MOD // 2).cast("double")


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: one for equal fingerprints, near 0 for texts without a common paragraph."""

    def squares(lanes: Column) -> Column:
        signs = F.slice(lanes, 1, SIGNS)
        return F.aggregate(signs, F.lit(0.0), lambda t, x: t + _signed(x) * _signed(x))

    apart = squares(F.transform(left, lambda x, i: x - F.get(right, i)))
    sizes = squares(left) + squares(right)
    share = F.lit(1.0) - apart / F.greatest(sizes, F.lit(1.0))
    inside = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    return F.when(left == right, F.lit(1.0)).otherwise(inside)


def constants(values: list[int | None], kind: str) -> Column:
    """An array of numbers as one constant, however many: the plan holds one expression, which
    is worked out when the plan is optimized."""
    text = ",".join("" if x is None else str(x) for x in values)
    return F.split(F.lit(text), ",").try_cast(f"array<{kind}>")


def with_next(docs: DataFrame, carried: list[str], ranges: int | None = None) -> DataFrame:
    """Rows of (doc_id, body, ...) with `next_<name>` of the row after each, for each name.

    Rows are ordered by doc_id, null first, then body; the row after the last is the first.
    They are dealt out by ranges of ids that hold about as many rows each; a range also gets
    the first id's rows of the next range that has any. So a task sees one range at a time
    and whole texts are shuffled once. The driver reads at most one pair of ids a range, and
    hands them back as three constants of the plan.
    """
    spark = docs.sparkSession
    n = ranges or RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    docs = docs.withColumn("_key", key)
    ids = docs.select("_key")
    shares = [i / n for i in range(1, n)] or [0.5]
    ends = sorted(set(ids.agg(F.percentile_approx("_key", shares, 20 * n)).first()[0] or [0]))
    ends_array = constants(ends, "bigint")
    steps = [1 << k for k in reversed(range(len(ends).bit_length()))]

    def advanced(at: Column, step: Column) -> Column:
        below = F.get(ends_array, at + step - 1) < F.col("_key")
        return F.when((at + step <= len(ends)) & below, at + step).otherwise(at)

    # How many ends lie below the id, found by halving.
    number = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), advanced)
    found = ids.select("_key", number.alias("_range")).groupBy("_range").agg(F.min("_key"))
    first = dict(sorted(tuple(r) for r in found.collect()))
    held = list(first) or [0]
    before = {r: held[i - 1] for i, r in enumerate(held)}
    slots = range(len(ends) + 1)
    firsts = constants([first.get(r) for r in slots], "bigint")
    befores = constants([before.get(r) for r in slots], "int")
    numbered = docs.withColumn("_range", number)
    own = F.struct(F.col("_range").alias("range"), F.lit(0).alias("copy"))
    guard = F.struct(F.get(befores, F.col("_range")).alias("range"), F.lit(1).alias("copy"))
    is_first = F.col("_key") == F.get(firsts, F.col("_range"))
    places = F.when(is_first, F.array(own, guard)).otherwise(F.array(own))
    dealt = numbered.withColumn("_at", F.explode(places)).drop("_range")
    order = Window.partitionBy("_at.range").orderBy("_at.copy", "_key", F.xxhash64("body"), "body")
    ahead = F.lead(F.struct(*carried)).over(order)
    return (
        dealt.withColumn("_next", ahead)
        .filter("_at.copy = 0")
        .select(
            *[c for c in docs.columns if c != "_key"],
            *[F.col(f"_next.{c}").alias(f"next_{c}") for c in carried],
        )
    )


def fingerprint_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The lanes of every whole text.

    A null text counts as empty; an empty text, or one of white space, has no paragraph and
    its lanes are all 0. Rows are independent of one another, so repeated rows repeat; a null
    doc_id is carried through; further columns are ignored.
    """
    body = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("body")
    )
    return body.withColumn("lanes", vector(F.col("body")))


def compare_with_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, which ends as the next text begins.

    The last quarter of a text's characters, rounded down, is replaced by as many of the first
    of the next document, or by all it has. Two texts without paragraphs have likeness 1, one
    with and one without have 0. A table of one row takes that row as the next.
    """
    rows = with_next(fingerprint_documents(docs, text), ["body", "lanes"])
    n = F.length("body")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("body", F.lit(1), n - tail), F.substring("next_body", F.lit(1), tail)
    )
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_lanes", vector(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        text_of(F.col("lanes")).alias("fingerprint"),
        text_of(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
