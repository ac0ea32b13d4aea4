"""Repairing the structure of conversations at least cost.

A conversation should be `(s?(ua)+)?` in the initials of its roles. What a repaired prefix ends
with is one of four states, so a run of rows is known by the least cost from each state to each
other. Rows are sorted by conversation and turn over all tasks, and a segment, the rows of a
conversation in one task, is summed up by such costs. A conversation's segments, few and small,
are joined by the cheapest states between them, and each segment is then solved between its
two states by Hirschberg's method: costs forward to its middle and backward to it meet in the
cheapest state, and either half is solved in the same way, with space in proportion to its rows.

Of several cheapest ways the one whose edits, written as letters, come first in ASCII is taken.
Inserted rows belong to the row that they precede, so no way's letters for a run of rows are the
beginning of another's, and the order of ways is that of their first halves. The forward pass
therefore keeps, with the costs, the rank of each state's way among those of the other states.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerstats.llm.common import ship, written
from ledgerstats.llm.ordered import n_parts, sorted_parts, streamed_sha256

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1  # costs; keeping a row costs nothing
#: From each state: the role that may follow and the state after it.
FOLLOWS = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER),
           USER: ("assistant", ASSISTANT)}
#: The rows to insert at the end of a conversation.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
SPACE = " \t\n\x0b\f\r"
#: Rows of segments that one Arrow batch carries, about.
BATCH_ROWS = 1 << 13

# A row is one letter: x must go; else s, u, a by the role's initial or o, a capital if truncated.
FORCED, LETTERS = "x", "suaoSUAO"


def kept(letter: str, state: int) -> int | None:
    """The state after a kept row; none where its role may not follow."""
    if letter == "s":
        return SYSTEM if state == START else None
    if letter == "u":
        return USER if state != USER else None
    return ASSISTANT if letter == "a" and state == USER else None


def _ways(letter: str, state: int) -> dict[int, tuple[int, str]]:
    """To each state: the cheapest edits of a row, with rows inserted before it."""
    found: dict[int, tuple[int, str]] = {}
    for inserted in range(3):
        before = INSERT * inserted, "I" * inserted
        ways = [(state, DELETE, "D")]
        if letter != FORCED:
            extra = TRUNCATED if letter.isupper() else 0
            ways.append((FOLLOWS[state][1], REROLE + extra, "R"))
            if (after := kept(letter.lower(), state)) is not None:
                ways.append((after, extra, "K"))
        for after, cost, edit in ways:
            way = before[0] + cost, before[1] + edit
            found[after] = min(found.get(after, way), way)
        state = FOLLOWS[state][1]
    return found


WAYS = {x: [_ways(x, p) for p in STATES] for x in FORCED + LETTERS}
Vector = tuple[tuple[int, int] | None, ...]  # by state: cost and rank of the cheapest way there
_FORWARD: dict[tuple[Vector, str], tuple[Vector, int]] = {}
_BACKWARD: dict[tuple[tuple, str], tuple[tuple, int]] = {}


def _ranked(best: dict[int, tuple]) -> tuple[Vector, int]:
    """best: (cost, what orders the ways) by state. Costs become those above the least."""
    least = min(cost for cost, _ in best.values())
    order = sorted(best, key=lambda q: best[q][1])
    return (
        tuple((best[q][0] - least, order.index(q)) if q in best else None for q in STATES),
        least,
    )


def _step(vector: Vector, letter: str) -> tuple[Vector, int]:
    best: dict[int, tuple] = {}
    for p, known in enumerate(vector):
        if known is not None:
            for q, (cost, edits) in WAYS[letter][p].items():
                way = known[0] + cost, (known[1], edits)
                best[q] = min(best.get(q, way), way)
    return _ranked(best)


def _step_back(costs: tuple, letter: str) -> tuple[tuple, int]:
    found: list = []
    for p in STATES:
        ways = [
            cost + costs[q] for q, (cost, _) in WAYS[letter][p].items() if costs[q] is not None
        ]
        found.append(min(ways, default=None))
    least = min(x for x in found if x is not None)
    return tuple(None if x is None else x - least for x in found), least


def forward(letters: str, state: int) -> tuple[Vector, int]:
    """Costs and ranks after the rows, from a state; and what all costs have in common."""
    vector: Vector = tuple((0, 0) if p == state else None for p in STATES)
    total = 0
    for letter in letters:
        key = vector, letter
        if (after := _FORWARD.get(key)) is None:
            after = _FORWARD[key] = _step(vector, letter)
        vector, total = after[0], total + after[1]
    return vector, total


def backward(letters: str, state: int) -> tuple:
    """By state before the rows: the cost of ending in `state`, above the least such cost."""
    costs: tuple = tuple(0 if p == state else None for p in STATES)
    for letter in reversed(letters):
        key = costs, letter
        if (after := _BACKWARD.get(key)) is None:
            after = _BACKWARD[key] = _step_back(costs, letter)
        costs = after[0]
    return costs


def cheapest_edits(letters: str, first: int, last: int) -> str:
    """The edits of the rows from one state to another: least cost, then least in ASCII."""
    done, waiting = [], [(0, len(letters), first, last)]
    while waiting:
        low, high, p, q = waiting.pop()
        if high - low == 1:
            done.append(WAYS[letters[low]][p][q][1])
        elif high > low:
            middle = (low + high) // 2
            there, _ = forward(letters[low:middle], p)
            back = backward(letters[middle:high], q)
            crossing = min(
                (there[m][0] + back[m], there[m][1], m)
                for m in STATES
                if there[m] is not None and back[m] is not None
            )[2]
            waiting += [(middle, high, crossing, q), (low, middle, p, crossing)]
    return "".join(done)


def joined(segments: list[tuple[list, list]]) -> tuple[int, list[int]]:
    """The cost of a conversation and the states between its segments, tail included.

    A segment is its costs and ranks, by first and last state, with -1 where there is no way.
    """
    vector, total, came = {START: (0, 0)}, 0, []
    for costs, ranks in segments:
        best, origin = {}, {}
        for p, (cost, rank) in vector.items():
            for q in STATES:
                if costs[4 * p + q] >= 0:
                    way = cost + costs[4 * p + q], (rank, ranks[4 * p + q])
                    if q not in best or way < best[q]:
                        best[q], origin[q] = way, p
        after, least = _ranked(best)
        vector, total = {q: x for q, x in enumerate(after) if x is not None}, total + least
        came.append(origin)
    ends = [(x[0] + INSERT * len(TAIL[q]), x[1], q) for q, x in vector.items()]
    cost, _, state = min(ends)
    states = [state]
    for origin in reversed(came):
        states.append(origin[states[-1]])
    return total + cost, states[::-1]


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_LONG, _TEXT = T.LongType(), T.StringType()
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
SEGMENTS = _schema(
    conv_id=_LONG, part=_LONG, letters=_TEXT, turns=T.ArrayType(_LONG),
    digests=T.ArrayType(_TEXT), copies=T.ArrayType(_LONG), costs=T.ArrayType(_LONG),
    ranks=T.ArrayType(_LONG), edges=T.ArrayType(_TEXT), extent=T.ArrayType(_LONG),
    **{name: _LONG for name in _COUNTS},
)
PLANS = _schema(
    conv_id=_LONG, part=_LONG, first=T.IntegerType(), last=T.IntegerType(), tail=_TEXT,
    gaps=_LONG, cost=_LONG, **{name: _LONG for name in _COUNTS},
)
EDIT = _schema(at=_LONG, edit=_TEXT, times=_LONG, role=_TEXT, turn=_LONG, digest=_TEXT)
PIECES = _schema(conv_id=_LONG, part=_LONG, audit=_TEXT, edits=T.ArrayType(EDIT))


def _streamed(
    rows: DataFrame, schema: T.StructType, of: Callable[[Iterator[tuple]], Iterator[tuple]]
) -> DataFrame:
    """Rows of `schema` from the rows of each task, one after another."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, found, load = to_arrow_schema(schema), [], 0
        single = (x for b in batches for x in zip(*[c.to_pylist() for c in b.columns]))

        def batch():
            columns = [pa.array(x, f.type) for x, f in zip(zip(*found), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for row in of(single):
            found.append(row)
            load += 1 + sum(len(x) for x in row if isinstance(x, list))
            if load > BATCH_ROWS:
                yield batch()
                found, load = [], 0
        if found:
            yield batch()

    return rows.mapInArrow(run, schema)


def _segment(conv_id, part: int, rows: list[tuple]) -> tuple:
    """rows: (turn, digest, copies, initial, letter) in order; copies after the first go."""
    counts, turns, last = dict.fromkeys(_COUNTS, 0), [], None
    letters = []
    for turn, _, copies, initial, letter, fault in rows:
        letters.append(letter + FORCED * (copies - 1))
        if fault in ("blank", "duplicate"):
            counts[fault] += copies
        else:
            counts["truncated"] += fault == "truncated"
            counts["duplicate"] += copies - 1
        counts["illegal"] += copies - 1
        if last is not None and (last, initial) not in LEGAL:
            counts["illegal"] += 1
        last = initial
        if turn is not None and (not turns or turns[-1] != turn):
            turns.append(turn)
    whole = "".join(letters)
    costs, ranks = [], []
    for p in STATES:
        vector, total = forward(whole, p)
        costs += [-1 if x is None else x[0] + total for x in vector]
        ranks += [-1 if x is None else x[1] for x in vector]
    return (
        conv_id, part, whole, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
        costs, ranks, [rows[0][3], last], [turns[0], turns[-1], len(turns)] if turns else [],
        *counts.values(),
    )


def _segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    part = TaskContext.get().partitionId()
    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        yield _segment(conv_id, part, [r[1:] for r in own])


def _plans(rows: Iterator[tuple]) -> Iterator[tuple]:
    """rows: segments without their rows, those of a conversation in order."""
    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        segments = [dict(zip(_SUMMARY, r)) for r in own]
        cost, states = joined([(s["costs"], s["ranks"]) for s in segments])
        totals = {name: sum(s[name] for s in segments) for name in _COUNTS}
        for one, two in zip(segments, segments[1:]):
            totals["illegal"] += (one["edges"][1], two["edges"][0]) not in LEGAL
        spans = [s["extent"] for s in segments if s["extent"]]
        gaps = 0
        if spans:
            repeated = sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            gaps = spans[-1][1] - spans[0][0] + 1 - sum(x[2] for x in spans) + repeated
            gaps = (gaps + 2**63) % 2**64 - 2**63  # turns further apart than a long wrap
        for i, s in enumerate(segments):
            closes = i == len(segments) - 1
            known = (gaps, cost, *totals.values()) if closes else [None] * (2 + len(_COUNTS))
            tail = TAIL[states[-1]] if closes else ""
            yield conv_id, s["part"], states[i], states[i + 1], tail, *known


_SUMMARY = ["conv_id", "part", "costs", "ranks", "edges", "extent", *_COUNTS]


def _pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, part, letters, turns, digests, copies, first, last, tail in rows:
        audit = cheapest_edits(letters, first, last) + tail
        state, at, row, left, edits = first, 0, -1, 0, []
        for edit in audit:
            if edit != "I" and not left:
                row, left = row + 1, copies[row + 1]
            role = None
            if edit in "IR":
                role, state = FOLLOWS[state]
            elif edit == "K":
                state = kept(letters[at].lower(), state)
            known = (turns[row], digests[row]) if edit != "I" else (None, None)
            if edit == "D" and edits and edits[-1][1] == "D" and edits[-1][4:] == known:
                edits[-1] = (*edits[-1][:2], edits[-1][2] + 1, *edits[-1][3:])
            else:
                edits.append((len(edits), edit, 1, role, *known))
            if edit != "I":
                at, left = at + 1, left - 1
        yield conv_id, part, audit, [dict(zip(EDIT.names, e)) for e in edits]


def joined_on(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null, with the left side's keys."""
    renamed = right.withColumnsRenamed({n: f"_{n}" for n in names})
    on = [left[n].eqNullSafe(renamed[f"_{n}"]) for n in names]
    return left.join(renamed, on, how).drop(*[f"_{n}" for n in names])


KEY = ["conv_id", "turn", "digest"]


def facts(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, copies, initial, letter, fault) of each different row.

    Equal rows, of which there may be very many, are counted before they move. A row repeats an
    earlier one if a row of the same digest has an earlier turn.
    """
    end = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    light = rows.select(
        *KEY,
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        "copies",
    )
    names = ["initial", "blank", "cut"]
    different = written(
        light.groupBy(*KEY, *names).agg(F.sum("copies").alias("copies")), "different-rows"
    )
    earliest = different.groupBy("conv_id", "digest").agg(
        F.min("turn").alias("earliest"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    known = joined_on(different, earliest, ["conv_id", "digest"])
    first = F.when(F.col("unnumbered"), F.col("turn").isNull()).otherwise(
        F.col("turn") == F.col("earliest")
    )
    fault = (
        F.when(F.col("blank"), "blank").when(~first, "duplicate").when(F.col("cut"), "truncated")
    )
    letter = F.when(fault.isin("blank", "duplicate"), FORCED).when(
        F.col("cut"), F.upper("initial")
    )
    return known.select(
        "conv_id", "turn", "digest", "copies", "initial",
        F.coalesce(letter, F.col("initial")).alias("letter"), fault.alias("fault"),
    )


@dataclass(frozen=True)
class Repaired:
    """`rows`: (conv_id, part, at, edit, role, text), ordered within a conversation by part and
    at; `conversations`: a row each with its faults, cost and audit."""

    rows: DataFrame
    conversations: DataFrame


def repair(conversations: DataFrame) -> Repaired:
    """Repair every conversation that has a row.

    `conversations` has conv_id, turn, role, text and, optionally, `copies`, how many times a row
    stands there. Rows are taken by turn, nulls first; rows of one turn, which nothing orders, by
    a digest of role and text. A null role or text is one space. A null conv_id is a conversation
    too. Equal rows count as repeats of the first. The audit has a letter for each row, so a
    conversation's rows and insertions are as many as a string can hold. Further columns are
    ignored; an empty table gives no rows.
    """
    number = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        number.cast("long").alias("copies"),
    )
    size = F.octet_length("role").cast("string")
    digest = F.sha2(F.concat(size, F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = rows.withColumn("digest", F.substring(digest, 1, 32))
    known = written(facts(rows), "facts")
    ordered = sorted_parts(
        known,
        n_parts(known),
        [F.col("conv_id").asc_nulls_first()],
        [F.col("turn").asc_nulls_first(), F.col("digest")],
    )
    segments = written(_streamed(ordered, SEGMENTS, _segments), "segments")
    # A segment without its rows is small, and there is one a conversation and task at most.
    gathered = (
        segments.select(*_SUMMARY)
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    )
    plans = written(_streamed(gathered, PLANS, _plans), "plans")
    solved = joined_on(
        segments.select("conv_id", "part", "letters", "turns", "digests", "copies"),
        plans.select("conv_id", "part", "first", "last", "tail"),
        ["conv_id", "part"],
    )
    pieces = written(_streamed(solved, PIECES, _pieces), "pieces")
    audits = (
        pieces.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("part", "audit"))).alias("all"))
        .select("conv_id", F.array_join(F.col("all.audit"), "").alias("audit"))
    )
    summary = joined_on(
        plans.filter("cost IS NOT NULL").select("conv_id", "gaps", *_COUNTS, "cost"),
        audits,
        ["conv_id"],
    )
    edits = pieces.select("conv_id", "part", F.explode("edits").alias("e")).select(
        "conv_id", "part", "e.*"
    )
    texts = rows.select(*KEY, F.col("role").alias("own_role"), "text").dropDuplicates(KEY)
    named = ["conv_id", "part", "at", "edit"]
    old = joined_on(edits.filter("edit IN ('K', 'R')"), texts, KEY).select(
        *named, F.coalesce("role", "own_role").alias("role"), "text"
    )
    new = edits.filter("edit = 'I'").select(*named, "role", F.lit("").alias("text"))
    return Repaired(old.unionByName(new), summary)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a checksum of conversation and turn: some are dropped,
    emptied, stripped of their ends, repeated or given the role of a user."""
    whole = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")}
    name = F.concat(whole["conv_id"], F.lit(":"), whole["turn"]).cast("binary")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.col("_fault")
    names = ["conv_id", "turn", "role", "text"]
    return (
        conversations.select(*names, (F.crc32(name) % 20).alias("_fault"))
        .filter(fault != 0)
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(role).alias("role"),
            F.when(fault == 1, "")
            .when(fault == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.when(fault == 3, 2).otherwise(1).alias("copies"),
        )
    )


def repair_digests(conversations: DataFrame, broken: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired text for each conversation of the first
    table, from the rows of the second."""
    repaired = repair(broken)
    lines = repaired.rows.select(
        "conv_id", "part", "at", F.concat("role", F.lit(":"), F.col("text")).alias("line")
    )
    digests = streamed_sha256(lines, ["conv_id"], ["part", "at"], "line", "\n")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = joined_on(every, repaired.conversations, ["conv_id"], "left")
    found = joined_on(found, digests, ["conv_id"], "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return found.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
