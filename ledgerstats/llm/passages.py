"""Passages that occur before: lines and sentences by digest, all but the first removed.

A text is divided into units, lines and within them sentences. The words of each, in lower
case, have a digest; the earliest unit of a digest, by doc_id and place, stays. The other lines
go. The other sentences inside lines go where a run of them, one after the other but for short
ones, has enough words, so that a sentence of a few words that two authors happened to write is
left alone. What goes is given with its place in the original text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch, written

#: Units of fewer words are neither compared nor end a run.
LEAST_UNIT = 4
#: A run of repeated units goes if it has so many words, or if it is a whole line.
LEAST_RUN = 13
BREAK = re.compile(r"(?:[.!?][^\S\n]++|[。！？｡][^\S\n]*+)(?!\n)|\n+")
#: Scripts without spaces: two characters count as a word in Chinese and Japanese, four in the
#: alphabets of Thai, Lao, Burmese and Khmer.
_CHINESE = r"\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_THAI = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
UNSPACED = re.compile(f"[{_CHINESE}{_THAI}]")
PIECES = re.compile(f"[{_CHINESE}]{{1,2}}|[{_THAI}]{{1,4}}|[^\\s{_CHINESE}{_THAI}]+")


UNITS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("version", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("digest", T.BinaryType()),
    ]
)


def words_of(unit: str) -> list[str]:
    """The words in lower case; of scripts without spaces, pieces about as long as words."""
    lowered = unit.lower()
    if lowered.isascii() or not UNSPACED.search(lowered):
        return lowered.split()
    return PIECES.findall(lowered)


def units(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and words of every sentence, and after its last one, of every line of
    several; ends include the white space that follows. A line of one sentence is that
    sentence. The start of a line of several is given as its complement, ~start."""
    found, line, at = [], [], 0
    for end in [*(m.end() for m in BREAK.finditer(text)), len(text)]:
        if end > at:
            line.append((at, end, words_of(text[at:end])))
            at = end
        if line and (end == len(text) or text[end - 1] == "\n"):
            found += line
            if len(line) > 1:
                found.append((~line[0][0], end, [w for _, _, words in line for w in words]))
            line = []
    return found


def unit_digests(docs: DataFrame) -> DataFrame:
    """Digest and first place of each distinct unit of a (doc_id, version, text) with enough
    words."""

    def make():
        def columns(batch):
            ids, versions, starts, digests = [], [], [], []
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for doc_id, version, text in rows:
                own: dict[str, int] = {}
                for start, _, words in units(text):
                    if len(words) >= LEAST_UNIT:
                        own.setdefault(" ".join(words), start)
                ids += [doc_id] * len(own)
                versions += [version] * len(own)
                starts += own.values()
                digests += [hashlib.blake2b(u.encode(), digest_size=16).digest() for u in own]
            return {"doc_id": ids, "version": versions, "start": starts, "digest": digests}

        return columns

    return by_batch(docs, make, UNITS)


def repeated_units(docs: DataFrame) -> DataFrame:
    """Starts of the units of each (doc_id, version) that a smaller doc_id has too.

    Digests are counted with partial results, and only those of two documents or more are
    joined back, where adaptive execution splits a frequent one over tasks.
    """
    placed = written(unit_digests(docs), "units")
    firsts = (
        placed.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("digest", "first")
    )
    again = placed.join(firsts, "digest").filter("doc_id > first")
    return again.groupBy("doc_id", "version").agg(F.collect_set("start").alias("starts"))


def removed_spans(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """The spans, merged where they meet, of the lines and of the runs that are long enough of
    units that begin at `starts` or stand earlier in the text too."""
    again, seen, gone, run, words = set(starts), set(), [], [], 0

    def close():
        if words >= LEAST_RUN:
            gone.extend(run)

    for start, end, unit in units(text):
        if len(unit) < LEAST_UNIT:
            continue
        normal = " ".join(unit)
        repeated = start in again or normal in seen
        seen.add(normal)
        if start < 0:  # a line of several sentences, which were here before
            if repeated:
                gone.append((~start, end))
            continue
        whole = (start == 0 or text[start - 1] == "\n") and (
            end == len(text) or text[end - 1] == "\n"
        )
        if repeated:
            if whole:
                gone.append((start, end))
            run.append((start, end))
            words += len(unit)
        else:
            close()
            run, words = [], 0
    close()
    spans = []
    for start, end in sorted(gone):
        if spans and spans[-1][1] >= start:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((start, end))
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for start, end in spans:
        parts.append(text[at:start])
        at = end
    return "".join([*parts, text[at:]])


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with the repeated passages cut from their text, and a last column,
    `removed_spans`, of the places cut, in characters of the original.

    A null text stays null, an empty one empty; a row without doc_id has no rank, so it loses
    only what it repeats itself and makes no other go. Rows with one doc_id have one
    rank and do not make each other's units go. Other columns are kept; one named
    `removed_spans` is replaced.
    """
    columns = [c for c in docs.columns if c != "removed_spans"]
    version = F.xxhash64(text)
    known = docs.filter(F.col("doc_id").isNotNull() & F.col(text).isNotNull())
    named = known.select(F.col("doc_id").cast("long"), version.alias("version"), text)
    again = repeated_units(named).select(
        F.col("doc_id").alias("again_id"), F.col("version").alias("again_version"), "starts"
    )
    # All columns of the rows in one, so that none has a name of those used here.
    whole = docs.select(
        F.struct(*[F.col(c) for c in columns]).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        version.alias("own_version"),
    )
    same = "own_id = again_id AND own_version = again_version"
    rows = whole.join(again, F.expr(same), "left").select("row", "starts")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    row = T.StructType([docs.schema[c] for c in columns])
    schema = T.StructType(
        [
            T.StructField("row", row),
            T.StructField("cut", T.StringType()),
            T.StructField("removed_spans", T.ArrayType(span)),
        ]
    )

    def make():
        def columns_of(batch):
            whole = batch.column(0)
            texts = whole.field(whole.type.get_field_index(text)).to_pylist()
            starts = batch.column(1).to_pylist()
            spans = [removed_spans(t or "", s or []) for t, s in zip(texts, starts)]
            cut = [without(t, s) if s else t for t, s in zip(texts, spans)]
            return {
                "row": pa.array(whole, whole.type),
                "cut": cut,
                "removed_spans": [[{"start": a, "end": b} for a, b in s] for s in spans],
            }

        return columns_of

    done = by_batch(rows, make, schema)
    return done.select(
        *[F.col("cut").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in columns],
        "removed_spans",
    )
