"""Toxicity of texts: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from a bounded sample of labelled texts: words, and beginnings of words
for languages that inflect them, found in far more toxic texts than others. Each text gives a row
of dense features: how densely lexicon words stand, how near to a second person, capitals,
punctuation, disguised spellings. The lexicon's features of a sampled text are those of a lexicon
learned without its fold. Boosted trees are fitted on all folds but the last, and the last turns
their probabilities into calibrated ones that never fall where the trees' rise.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from math import log, log1p, sqrt

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch, written

#: So many labelled texts of either label are learned from at most, about.
SAMPLE = 4_000
FOLDS = 4
#: A term is learned from this share of the toxic texts on, and this many at least.
COMMON, RARE, LEAST = 0.02, 0.004, 4
#: How much likelier a term is in toxic texts, as a logarithm, and how certainly.
ODDS, CERTAIN = log(12), 2.5
#: So many terms, those of most weight, are kept of each kind.
TERMS = 2_000
STEMS = (4, 5)
LONGEST_WORD = 24
TREES, DEPTH, STEP = 30, 4, 0.2
STEPS = 1 << 53
#: Share of the trees' own probability in a score, to tell apart what calibration makes equal.
OWN_SHARE = 0.01

#: Words that are insults whatever the labelled texts hold.
SEED = frozenset(
    "bastard coward creep cretin degenerate disgusting dumb dumbass fool freak garbage hateful "
    "idiot idiotic idiots imbecile jerk kill liar loser losers moron moronic morons pathetic "
    "pervert pig retard scum shit shut stupid sucker trash ugly vermin vile worthless".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner ihr euch euer tu te toi "
    "ton ta tes vous votre vos usted ustedes tú ti tus vosotros vuestro".split()
)
FEATURES = (
    "seed", "common", "rare", "different", "weight", "person", "near_person", "capitals",
    "shouted", "exclamations", "questions", "runs", "disguised", "disguised_hits", "stretched",
    "length",
)

WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(
    r"\b[^\W\d_]++(?:[0-9@$!*#|]++[^\W\d_]++)+|\b(?:[^\W\d_][.\-* ]){3,}+[^\W\d_]\b"
)
RUNS = re.compile(r"[!?]{2,}|\.{4,}")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
CAPITALS = bytes(range(0x41, 0x5B))
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
PLAIN = str.maketrans("013457@$!|", "oieastasil", "*#.- ")
NEAR = 6  # words
MOST_REMEMBERED = 1 << 20


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, which end in a star."""
    return [word[:LONGEST_WORD], *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


class Lexicon(dict):
    """What each word is, found once: (place in FEATURES of its density, weight), or None.

    `terms` are the learned ones: kind (0 common, 1 rare) and weight of each.
    """

    def __init__(self, terms: dict[str, tuple[int, float]]):
        self.terms = terms

    def __missing__(self, word: str) -> tuple[bool, bool, tuple[int, float] | None] | None:
        if len(self) > MOST_REMEMBERED:
            self.clear()
        hits = [self.terms[t] for t in terms_of(word) if t in self.terms]
        best = min(hits, key=lambda x: (x[0], -x[1]), default=None)
        seed, person = word in SEED, word in SECOND_PERSON
        found = (seed, person, best) if seed or person or best else None
        self[word] = found
        return found

    def is_insult(self, word: str) -> bool:
        found = self[word]
        return found is not None and (found[0] or found[2] is not None)


def stretched(data: bytes) -> int:
    """Places where an ASCII letter stands for the third time in a row or more."""
    b = np.frombuffer(data, np.uint8)
    same = b[1:] == b[:-1]
    return int((same[1:] & same[:-1] & LETTER[b[2:]]).sum()) if len(b) > 2 else 0


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a whole text; all 0 of one without words."""
    words = WORD.findall(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    data = text.encode()
    hundreds, letters = len(words) / 100, sum(map(len, words))
    marked = [(i, m) for i, m in enumerate(map(lexicon.__getitem__, words)) if m is not None]
    hits = [(words[i], best) for i, (_, _, best) in marked if best is not None]
    persons = np.array([i for i, (_, person, _) in marked if person])
    places = np.array([i for i, (seed, _, best) in marked if seed or best is not None])
    near = 0.0
    if len(persons) and len(places):
        after = np.searchsorted(persons, places)
        right = np.abs(persons[np.minimum(after, len(persons) - 1)] - places)
        left = np.abs(places - persons[np.maximum(after - 1, 0)])
        near = float((np.minimum(left, right) <= NEAR).mean())
    mixed = [m.lower().translate(PLAIN) for m in MIXED.findall(text)]
    return [
        sum(seed for _, (seed, _, _) in marked) / hundreds,
        sum(kind == 0 for _, (kind, _) in hits) / hundreds,
        sum(kind == 1 for _, (kind, _) in hits) / hundreds,
        log1p(len({w for w, _ in hits})),
        max((weight for _, (_, weight) in hits), default=0.0),
        len(persons) / hundreds,
        near,
        (len(data) - len(data.translate(None, CAPITALS))) / letters,
        len(SHOUTED.findall(text)) / hundreds,
        text.count("!") / hundreds,
        text.count("?") / hundreds,
        len(RUNS.findall(text)) / hundreds,
        len(mixed) / hundreds,
        sum(map(lexicon.is_insult, mixed)) / hundreds,
        stretched(data) / hundreds,
        log1p(len(words)),
    ]


def held_out() -> Column:
    """Whether a document is of the fifth whose labels are never learned from."""
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.coalesce(fifth, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """About `sample` documents of either label (doc_id, text, toxic, fold), by a hash of the id,
    and how many there are of each. A document with both labels is toxic."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    ids = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    known = written(known.join(ids, "doc_id"), "labelled")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    steps = {k: min(STEPS, int(STEPS * (sample / n))) for k, n in counts.items()}
    limit = F.when(F.col("toxic") == 1, steps.get(1, 0)).otherwise(steps.get(0, 0))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(STEPS)) < limit)
    # About twice `sample` rows of two numbers. Rows that repeat an id are one.
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    rows = texts.agg(F.min("text").alias("text")).filter("text IS NOT NULL")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return written(rows.withColumn("fold", fold), "sampled"), counts


TERM_COUNTS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("toxic", T.IntegerType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def learned_lexicons(rows: DataFrame) -> list[Lexicon]:
    """For each fold the lexicon of the other folds, and last that of all.

    Texts with a term are counted on Spark. The driver gets the terms of enough toxic texts
    that are likelier there.
    """

    def count():
        def columns(batch):
            found: Counter = Counter()
            for text, toxic, fold in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms = {t for w in set(WORD.findall(text.lower())) for t in terms_of(w)}
                found.update((t, toxic, fold) for t in terms)
            return {
                "term": [k[0] for k in found],
                "toxic": [k[1] for k in found],
                "fold": [k[2] for k in found],
                "n": list(found.values()),
            }

        return columns

    sizes = np.zeros((2, FOLDS))
    for toxic, fold, n in rows.groupBy("toxic", "fold").count().collect():
        sizes[toxic, fold] += n
    n_clean, n_toxic = (max(float(x), 1.0) for x in sizes.sum(axis=1))
    by_fold = []
    for t in (0, 1):
        for f in range(FOLDS):
            own = F.when((F.col("toxic") == t) & (F.col("fold") == f), F.col("n"))
            by_fold.append(F.coalesce(F.sum(own), F.lit(0)).alias(f"n{t}{f}"))
    counted = by_batch(rows.select("text", "toxic", "fold"), count, TERM_COUNTS)
    total = [sum((F.col(f"n{t}{f}") for f in range(FOLDS)), F.lit(0)) for t in (0, 1)]
    likelier = total[1] / F.lit(n_toxic) > 2 * total[0] / F.lit(n_clean)
    table = (
        counted.groupBy("term")
        .agg(*by_fold)
        .filter((total[1] >= max(LEAST // 2, RARE * n_toxic / 2)) & likelier)
        .orderBy("term")
        .collect()
    )
    lexicons = []
    for left_out in [*range(FOLDS), None]:
        folds = [f for f in range(FOLDS) if f != left_out]
        n = sizes[:, folds].sum(axis=1)
        terms: list[tuple[float, str, int]] = []
        for row in table:
            clean, toxic = (sum(row[f"n{t}{f}"] for f in folds) for t in (0, 1))
            odds = log((toxic + 0.5) / (n[1] + 1)) - log((clean + 0.5) / (n[0] + 1))
            certain = odds / sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
            if toxic >= max(LEAST, RARE * n[1]) and odds >= ODDS and certain >= CERTAIN:
                terms.append((odds, row["term"], int(toxic < COMMON * n[1])))
        kept = {}
        for kind in (0, 1):
            best = sorted((x for x in terms if x[2] == kind), key=lambda x: (-x[0], x[1]))
            kept |= {term: (kind, odds) for odds, term, _ in best[:TERMS]}
        lexicons.append(Lexicon(kept))
    return lexicons


@dataclass(frozen=True)
class ToxicityModel:
    """The lexicon of all folds, and the trees with their calibration; these are absent, and
    every score is `constant`, where the labels are all of one kind."""

    lexicon: Lexicon
    stages: PipelineModel | None
    constant: float = 0.0


def _with_features(rows: DataFrame, lexicons: list[Lexicon], names: list[str]) -> DataFrame:
    """The columns of `names` with `dense`; a column `fold`, if there, chooses the lexicon."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast([x.terms for x in lexicons])
    dense = T.StructField("dense", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*[rows.schema[c] for c in names], dense])
    rows = rows.select(*names, "text", *(["fold"] if "fold" in rows.columns else []))

    def make():
        own = [Lexicon(terms) for terms in shared.value]

        def columns(batch):
            at = {c: i for i, c in enumerate(batch.schema.names)}
            folds = batch.column(at["fold"]).to_pylist() if "fold" in at else None
            found = [
                features(x.as_py() or "", own[folds[i] if folds else -1])
                for i, x in enumerate(batch.column(at["text"]))
            ]
            return {**{c: batch.column(at[c]) for c in names}, "dense": found}

        return columns

    return by_batch(rows, make, schema)


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    rows, counts = sampled(docs.select("doc_id", "text"), labels, sample)
    if len(counts) < 2:
        return ToxicityModel(Lexicon({}), None, float(next(iter(counts), 0)))
    lexicons = learned_lexicons(rows)
    folded = rows.withColumn("part", F.col("fold"))
    dense = written(_with_features(folded, lexicons, ["doc_id", "toxic", "part"]), "dense")
    sizes = dense.groupBy("toxic", "part").count().collect()
    found = {(r["toxic"], r["part"]) for r in sizes}
    n = {t: max(1, sum(r["count"] for r in sizes if r["toxic"] == t)) for t in (0, 1)}
    # Either label weighs in the calibration as it does among all labelled documents.
    weight = F.when(F.col("toxic") == 1, counts[1] / n[1]).otherwise(counts[0] / n[0])
    ready = dense.select(
        array_to_vector("dense").alias("vector"),
        F.col("toxic").cast("double").alias("label"),
        weight.alias("weight"),
        (F.col("part") == FOLDS - 1).alias("last"),
    )
    whole = {t for (t, part) in found if part < FOLDS - 1} == {0, 1}
    split = whole and {t for (t, part) in found if part == FOLDS - 1} == {0, 1}
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
        maxBins=64, seed=20240229,
    ).fit(ready.filter(~F.col("last")) if split else ready)
    own = _probability(trees.transform(ready.filter("last") if split else ready))
    calibration = IsotonicRegression(
        featuresCol="own", labelCol="label", weightCol="weight", predictionCol="calibrated"
    ).fit(own)
    return ToxicityModel(lexicons[-1], PipelineModel([trees, calibration]))


def _probability(rows: DataFrame) -> DataFrame:
    return rows.withColumn("own", vector_to_array("probability")[1])


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    A null or empty text, or one without letters, has features of 0 and is scored by them.
    Labels of the held-out fifth are never learned from; a null doc_id has no label and is not
    held out; rows that repeat an id are scored each and learned from once. Without labels every
    score is 0, and with labels of one kind alone it is that label. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit_toxicity_model(docs, labels.select("doc_id", "toxic"), sample)
    rows = docs.withColumn("held_out", held_out())
    if model.stages is None:
        scored = rows.select("doc_id", "held_out", F.lit(model.constant).alias("score"))
    else:
        trees, calibration = model.stages.stages
        dense = _with_features(rows, [model.lexicon], ["doc_id", "held_out"])
        own = _probability(
            trees.transform(dense.withColumn("vector", array_to_vector("dense")))
        )
        score = (1 - OWN_SHARE) * F.col("calibrated") + OWN_SHARE * F.col("own")
        scored = calibration.transform(own).select(
            "doc_id", "held_out", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score")
        )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
