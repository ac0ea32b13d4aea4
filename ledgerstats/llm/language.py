"""Language identification by error-correcting output codes over byte trigrams.

Each language has a codeword of signs. For each position a binary classifier, the log odds
of byte trigrams under the languages with either sign, predicts that sign from the text.
The languages' codewords are then compared with the margins of all positions: each position
costs the logistic loss of its margin, weighted by how often it was right in training, and
the codeword of the least loss is chosen. Where the next one is about as near, the text is
flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch

BINS = 1 << 15
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: The classifiers are fitted on about so many labelled texts of each language at most, and on
#: all of a language that has fewer.
SAMPLE = 3_000
#: Hashes of ids are compared with shares in so many steps.
STEPS = 1 << 53
#: Up to so many languages have all distinct splits as positions; more get random ones.
EXHAUSTIVE = 6
#: A text is ambiguous if its second codeword has at least this share of the first's score.
AMBIGUOUS = 0.9
CHUNK = 1 << 20


def trigrams(text: str) -> np.ndarray:
    """The bin of each byte trigram of the lower-cased text with a space at either end."""
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(17)


def codewords(n: int) -> np.ndarray:
    """A row of signs for each of n languages, each column a different split of them."""
    if n < 2:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        # The first language is + everywhere; the others take all patterns but all +.
        patterns = np.arange(2 ** (n - 1) - 1)
        rows = [(patterns >> k) & 1 for k in range(n - 1)]
        return np.vstack([np.ones(len(patterns)), *(2 * np.array(rows) - 1)])
    width = 15 * int(np.ceil(np.log2(n)))
    tries = [np.random.default_rng(seed).choice([-1.0, 1.0], (n, width)) for seed in range(50)]
    return max(tries, key=lambda code: -(code @ code.T - width * np.eye(n)).max())


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # bins x positions
    scale: np.ndarray  # usual size of the margin, by position
    trust: np.ndarray  # weight of the loss, by position

    def margins(self, text: str) -> np.ndarray:
        """The mean log odds of the text's trigrams, by position."""
        bins = trigrams(text)
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(bins), CHUNK):
            total += self.weights[bins[at : at + CHUNK]].sum(axis=0, dtype=np.float64)
        return total / (len(bins) + 4.0)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether another codeword is about as near."""
        if text is None or not LETTER.search(text) or not self.languages:
            return UNKNOWN, 0.0, False
        z = 4.0 * self.code * (self.margins(text) / self.scale)
        loss = (self.trust * np.logaddexp(0.0, -z)).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(share.argmax())
        second = float(np.delete(share, best).max(initial=0.0))
        return self.languages[best], float(share[best]), second > AMBIGUOUS * share[best]


def labelled(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: those with a language, outside the held-out third."""
    usable = F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").isNotNull()
    return docs.filter(usable & ~held_out()).select("doc_id", "text", "lang")


def held_out():
    """Whether a document is of the third that is never learned from; a null id is not."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return F.coalesce(third, F.lit(False))


def sampled(rows: DataFrame, sample: int) -> DataFrame:
    """About `sample` rows of each language that has more, all of the others."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    steps = {x: int(STEPS * (sample / n)) for x, n in counts.items() if n > sample}
    if not steps:
        return rows
    limits = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])
    limit = F.coalesce(F.try_element_at(limits, F.col("lang")), F.lit(STEPS))
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(STEPS)) < limit)


COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)
MARGINS = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("right", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("size", T.DoubleType()),
    ]
)


def fit_language_model(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Fit the classifiers on whole texts of about `sample` labelled rows of each language.

    Rows are chosen by a hash of the id. A language's share follows from its own count over all
    documents, so the languages that are learned are the same at any size of the table. Trigram
    counts are summed on Spark; the driver gets one row a language and bin at most.
    """
    rows = sampled(labelled(docs), sample).select("text", "lang")

    def count():
        def columns(batch):
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if LETTER.search(text):
                    found = sums.setdefault(lang, np.zeros(BINS, np.int64))
                    found += np.bincount(trigrams(text), minlength=BINS)
            kept = {lang: np.flatnonzero(x) for lang, x in sums.items()}
            return {
                "lang": [lang for lang, bins in kept.items() for _ in bins],
                "bin": np.concatenate([[], *kept.values()]).astype(np.int32),
                "n": np.concatenate([[], *(sums[x][b] for x, b in kept.items())]).astype(np.int64),
            }

        return columns

    counted = by_batch(rows, count, COUNTS).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    code = codewords(len(languages))
    counts = np.full((len(languages), BINS), 0.5)
    row = table["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)
    counts[row, table["bin"].to_numpy(dtype=int)] += table["n"].to_numpy(dtype=float)
    # Each language counts the same, however many of its texts were seen.
    shares = counts / counts.sum(axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        parts = [
            [shares[code[:, j] == sign].mean(axis=0) for sign in (1, -1)]
            for j in range(code.shape[1])
            if len(languages) > 1
        ]
    weights = np.array([np.log(p / q) for p, q in parts], np.float32).T
    if not parts:
        weights = np.zeros((BINS, code.shape[1]), np.float32)
    ones = np.ones(code.shape[1])
    model = LanguageModel(languages, code, weights, ones, ones)
    return calibrated(model, rows) if len(languages) > 1 else model


def calibrated(model: LanguageModel, rows: DataFrame) -> LanguageModel:
    """The model with each position's usual margin and reliability on the sample."""

    def measure():
        def columns(batch):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            known = {x: i for i, x in enumerate(model.languages)}
            seen = [
                model.margins(text) * model.code[known[lang]]
                for text, lang in pairs
                if lang in known and LETTER.search(text)
            ]
            all_ = np.array(seen).reshape(-1, model.code.shape[1])
            return {
                "position": np.arange(model.code.shape[1], dtype=np.int32),
                "right": (all_ > 0).sum(axis=0),
                "n": np.full(model.code.shape[1], len(all_)),
                "size": np.abs(all_).sum(axis=0),
            }

        return columns

    found = (
        by_batch(rows, measure, MARGINS)
        .groupBy("position")
        .agg(*[F.sum(c).alias(c) for c in ("right", "n", "size")])
        .orderBy("position")
        .toPandas()
    )
    n = np.maximum(found["n"].to_numpy(dtype=float), 1)
    trust = np.maximum(2 * found["right"].to_numpy(dtype=float) / n - 1, 0.01)
    scale = np.maximum(found["size"].to_numpy(dtype=float) / n, 1e-6)
    return LanguageModel(model.languages, model.code, model.weights, scale, trust)


LANGUAGES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)


def only_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows, with all their columns, whose text has a language that is not ambiguous.

    Rows whose text is null or has no letters go, as do those that two languages fit alike;
    where no row has a label to learn from, none stays.
    """
    model = fit_language_model(docs.select("doc_id", "text", "lang"), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index("text")

    def make():
        own = shared.value

        def columns(batch):
            kept = []
            for text in batch.column(place):
                language, _, ambiguous = own.predict(text.as_py())
                kept.append(language != UNKNOWN and not ambiguous)
            found = batch.filter(pa.array(kept, pa.bool_()))
            return dict(zip(names, found.columns))

        return columns

    return by_batch(docs, make, docs.schema)


def identify_languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The language of every whole text.

    A text that is null or has no letter gets `und` with score 0, as does every text where no
    row has a label to learn from. With one learned language every text with letters gets it.
    Rows are independent of one another, so repeated rows repeat; a null doc_id is carried
    through and counts as not held out; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit_language_model(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def columns(batch):
            rows = [own.predict(x.as_py()) for x in batch.column(2)]
            return {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "lang_pred": [r[0] for r in rows],
                "score": [r[1] for r in rows],
                "ambiguous": [r[2] for r in rows],
            }

        return columns

    return by_batch(docs.select("doc_id", held_out().alias("held_out"), "text"), make, LANGUAGES)
