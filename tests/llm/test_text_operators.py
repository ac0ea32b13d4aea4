"""Encoding, licences, languages and fingerprints, against plain code of their definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerstats.llm import fingerprints, language, licences, pieces
from ledgerstats.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_those_of_the_library(spark, documents):
    model = library()
    found = {r.doc_id: r for r in QUERIES["op3_sentencepiece"](spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        ids = model.encode(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(model.decode(ids).encode()).hexdigest()
        row = found[doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha, decoded)


def test_pieces_of_odd_texts_and_ids():
    model, own, draw = library(), pieces.encoder(MODEL), random.Random(3)
    parts = ["  ", " ", "\n", "a", "the", "in", "▁", "▁▁", "é", "中", "🙂", "<s>", "<0x41>", " " * 17,
             "\x00", "ing", "́", "tion"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        ids = model.encode(text)
        assert own.encode(text) == ",".join(map(str, ids))
        assert own.table.decode(list(map(str, ids))) == model.decode(ids).encode()
    for _ in range(1000):
        ids = [draw.choice([1, 2, draw.randrange(3, 259), draw.randrange(259, 32000)])
               for _ in range(draw.randint(0, 8))]
        assert own.table.decode(list(map(str, ids))) == model.decode(ids).encode(), ids


def test_pieces_of_awkward_rows(frame):
    model = library()
    found = pieces.encode_pieces(frame(AWKWARD), MODEL).collect()
    assert len(found) == len(AWKWARD)
    texts = sorted(model.decode(model.encode(t or "")) for _, t in AWKWARD)
    assert sorted(r.decoded for r in found) == texts
    assert pieces.piece_digests(frame([]), MODEL).count() == 0


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_licence_phrases_are_those_of_a_plain_search(spark, documents):
    found = {r.doc_id: r for r in QUERIES["op9_licences"](spark, SF).collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        own, hits = words(text or ""), []
        for phrase, label in licences.PHRASES.items():
            p = phrase.split()
            hits += [(i, label) for i in range(len(own)) if own[i : i + len(p)] == p]
        row = found[doc_id]
        assert (row.n_words, row.n_base) == (len(own), len(hits))
        assert row.first_word == min((i for i, _ in hits), default=None)
        assert row.last_word == max((i for i, _ in hits), default=None)
        assert row.base_labels == ",".join(sorted({x for _, x in hits}))
        assert set(row.base_labels.split(",")) <= {*row.labels.split(","), ""}


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Released under the MIT License.", "mit"),
        ("Available under the terms of the MIT license", "mit"),
        ("Released beneath the MIT License.", ""),
        ("Licensed under the Apache License Version 2.0", "apache-2.0"),
        ("Licensed under the Apache License, revised Version 2.0", ""),
        ("This program is licensed under the GNU General Public License, version 3.",
         "gpl,gpl-3.0"),
        ("This thing is licensed under the GNU General Public License, version 3.", "gpl"),
        ("licensed under a CC BY-SA 4.0", "cc-by,cc-by-sa-4.0"),
        ("All rights reserved", "reserved"),
    ],
)
def test_templates_want_their_mandatory_words(text, labels):
    scanner = licences.Scanner(licences.PHRASES, licences.TEMPLATES)
    for whole in (text, f"before {text} after", "x " * 5000 + text):
        assert scanner.scan(whole)["labels"] == labels


def test_any_words_of_a_template_are_bounded():
    scanner = licences.Scanner({}, {"t": "start here <<any:1-2>> end"})
    accepted = {n: bool(scanner.scan("start here " + "w " * n + "end")["labels"]) for n in range(4)}
    assert accepted == {0: False, 1: True, 2: True, 3: False}


def test_licences_of_awkward_rows(frame):
    found = licences.scan_licences(frame(AWKWARD)).collect()
    assert len(found) == len(AWKWARD) and {r.labels for r in found} == {""}
    assert licences.scan_licences(frame([])).count() == 0


def test_held_out_languages_are_found(spark):
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.join(docs, "doc_id").filter("held_out").select("lang", "lang_pred").collect()
    assert len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)


def test_labels_of_the_held_out_third_do_not_matter(frame, documents):
    rows = documents.select("doc_id", "text", "lang", language.held_out().alias("h"))
    changed = rows.withColumn("lang", F.when(F.col("h"), "xx").otherwise(F.col("lang"))).drop("h")
    one, two = (
        {r.doc_id: r for r in language.identify_languages(d).collect()}
        for d in (rows.drop("h"), changed)
    )
    assert one == two


def test_languages_of_awkward_rows(frame):
    learned = [(100 + i, f"the words of text {i} the", "en") for i in range(6)]
    learned += [(200 + i, f"die wörter des textes {i}", "de") for i in range(6)]
    found = language.identify_languages(frame(learned + AWKWARD)).collect()
    assert len(found) == len(learned) + len(AWKWARD)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert by_id[100].lang_pred == "en" and by_id[200].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in language.identify_languages(frame(AWKWARD)).collect()} == {"und"}
    assert language.identify_languages(frame([])).count() == 0
    kept = language.only_identified(frame(learned + AWKWARD))
    assert kept.columns == frame([]).columns
    assert {1, 2, 3}.isdisjoint({r.doc_id for r in kept.collect()})


@pytest.mark.parametrize("n", [2, 3, 4, 6, 12])
def test_codewords_differ_from_one_another(n):
    code = language.codewords(n)
    assert len({tuple(r) for r in code}) == n
    assert all((a != b).sum() >= code.shape[1] // 4 for i, a in enumerate(code) for b in code[:i])


def fingerprint_of(spark, text):
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return fingerprints.fingerprint_documents(rows).first().lanes


def test_edits_are_those_of_a_plain_loop(spark, documents):
    rows = sorted(tuple(r) for r in documents.select("doc_id", "text").collect())
    found = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, SF).collect()}
    assert len(found) == len(rows)
    better = 0
    for (doc_id, text), (next_id, following) in zip(rows, rows[1:] + rows[:1]):
        text, following, row = text or "", following or "", found[doc_id]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + following[:tail]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.near_next == 1) == (row.fingerprint == found[next_id].fingerprint)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        better += row.near_edited > row.near_next
    assert better > 0.9 * len(rows)
    texts = {}
    for doc_id, text in rows:
        assert texts.setdefault(text, found[doc_id].fingerprint) == found[doc_id].fingerprint


def test_fingerprints_add_up_in_any_order(spark):
    one, two = "First part.\nSecond part. Third.", "Another\nline."
    a, b = fingerprint_of(spark, one), fingerprint_of(spark, two)
    assert fingerprint_of(spark, "Third.\nFirst part. Second part.") == a
    assert a != b and fingerprint_of(spark, "") == [0] * (fingerprints.SIGNS + fingerprints.WIDE)
    row = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    both = row.select(fingerprints.insert(F.col("a"), F.col("b")).alias("x"), "b")
    back = both.select("x", fingerprints.delete(F.col("x"), F.col("b")).alias("y")).first()
    assert back.x == fingerprint_of(spark, f"{two}\n{one}") and back.y == a


def test_fingerprints_of_awkward_rows(frame):
    found = fingerprints.compare_with_edits(frame(AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    assert fingerprints.compare_with_edits(frame([])).count() == 0
    (alone,) = fingerprints.compare_with_edits(frame([(1, "Just one. Text here.")])).collect()
    assert alone.near_next == 1


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_the_next_row_crosses_ranges(spark, ranges):
    ids = [3, 9, 10, 11, 50, 51, 52, 1000, None, -7]
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, body string")
    following = fingerprints.with_next(rows, ["body"], ranges).collect()
    found = {r.doc_id: r.next_body for r in following}
    order = [None, *sorted(i for i in ids if i is not None)]
    assert found == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def paragraphs_of(text):
    parts = (p.strip(" ") for p in re.split(r"\n+|(?<=[.!?]) +", text))
    return [p for p in parts if p]


def rotated(x, n):
    return (x << n | x >> (64 - n)) & M64


M64 = 2**64 - 1
P1, P2, P3, P4, P5 = (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5,
)


def mixed(h):
    h = ((h ^ h >> 33) * P2) & M64
    h = ((h ^ h >> 29) * P3) & M64
    return h ^ h >> 32


def hash_of_int(i, seed=42):
    """xxHash64 of a four-byte whole number."""
    h = (seed + P5 + 4) & M64
    h ^= (i * P1) & M64
    h = (rotated(h, 23) * P2 + P3) & M64
    return mixed(h)


def plain_lanes(text):
    """The lanes from the published xxHash64, each paragraph hashed once a seed."""
    import xxhash

    lanes = [0] * (fingerprints.SIGNS + fingerprints.WIDE)
    for p in paragraphs_of(text):
        own = [xxhash.xxh64(p.encode(), seed=hash_of_int(i)).intdigest() for i in range(5)]
        for bit in range(64):
            lanes[bit] += 1 if own[0] >> bit & 1 else -1
        for i, h in enumerate(own[1:]):
            lanes[64 + 2 * i] += h & 0xFFFFFFFF
            lanes[65 + 2 * i] += h >> 32
    return [x % 2**32 for x in lanes]


def plain_likeness(a, b):
    if a == b:
        return 1.0

    def squares(x):
        return sum(float((v + 2**31) % 2**32 - 2**31) ** 2 for v in x[:64])

    apart = squares([x - y for x, y in zip(a, b)])
    return min(max(1 - apart / max(squares(a) + squares(b), 1), 0), 1)


def test_lanes_and_likeness_are_those_of_plain_code(spark, documents):
    rows = sorted(tuple(r) for r in documents.select("doc_id", "text").collect())
    found = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, SF).collect()}
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following, row = text or "", following or "", found[doc_id]
        tail = len(text) // 4
        own, edited, after = (
            plain_lanes(x) for x in (text, text[: len(text) - tail] + following[:tail], following)
        )
        assert row.fingerprint == "".join(f"{x:08x}" for x in own)
        assert row.edited_fingerprint == "".join(f"{x:08x}" for x in edited)
        assert row.near_edited == pytest.approx(plain_likeness(own, edited))
        assert row.near_next == pytest.approx(plain_likeness(own, after))


@pytest.mark.parametrize("n", [32_768, 49_152, 65_536])
def test_very_many_equal_paragraphs_do_not_wrap(spark, n):
    whole, part, none = ("same line\n" * m for m in (n, n * 3 // 4, 0))
    a, b, c = (fingerprint_of(spark, x) for x in (whole, part, none))
    row = spark.createDataFrame([(a, b, c)], "a array<long>, b array<long>, c array<long>")
    near, far = row.select(
        fingerprints.likeness(F.col("a"), F.col("b")), fingerprints.likeness(F.col("a"), F.col("c"))
    ).first()
    assert near == pytest.approx(0.96) and far == 0


def test_thousands_of_ranges_are_few_constants(spark):
    rows = spark.range(40_000).selectExpr("id * 7 AS doc_id", "concat('t', id * 7) AS body")
    found = fingerprints.with_next(rows, ["body"], 4_000)
    wrong = found.filter(
        F.col("next_body") != F.concat(F.lit("t"), F.pmod(F.col("doc_id") + 7, F.lit(280_000)))
    )
    assert found.count() == 40_000 and wrong.count() == 0


def wordings(markup, draw):
    """One wording that the markup allows, by choosing for each part, and its words."""
    out = []
    for part in re.split(r"(<<beginOptional>>.*?<<endOptional>>|<<.*?>>)", markup, flags=re.S):
        if part.startswith("<<beginOptional>>"):
            out.append(part[17:-15] if draw.random() < 0.5 else "")
        elif part.startswith("<<any:"):
            low, high = map(int, part[6:-2].split("-"))
            out.append(" ".join(f"x{i}" for i in range(draw.randint(low, high))))
        elif part.startswith("<<one:"):
            out.append(draw.choice(part[6:-2].split("|")))
        else:
            out.append(part)
    return " ".join(out)


@pytest.mark.parametrize("label", sorted(licences.TEMPLATES))
def test_every_wording_of_a_template_holds_it_and_none_without_a_mandatory_word(label):
    draw, markup = random.Random(label), licences.TEMPLATES[label]
    own = licences.Scanner({}, {label: markup})
    for _ in range(20):
        whole = wordings(markup, draw)
        assert own.scan(f"before it. {whole}. After it")["labels"] == label
    # Without any one of its mandatory words the text holds nothing.
    bare = re.sub(r"<<beginOptional>>.*?<<endOptional>>", " ", markup, flags=re.S)
    parts = re.split(r"(<<.*?>>)", bare)
    mandatory = [(i, j) for i, p in enumerate(parts) if not p.startswith("<<")
                 for j in range(len(words(p)))]
    for i, j in draw.sample(mandatory, min(40, len(mandatory))):
        kept = words(parts[i])
        less = [*parts[:i], " ".join(kept[:j] + ["zzz"] + kept[j + 1 :]), *parts[i + 1 :]]
        assert own.scan(wordings("".join(f" {p} " for p in less), draw))["labels"] == ""


@pytest.mark.parametrize("label", ["mit-text", "bsd-2-clause", "bsd-3-clause", "isc"])
def test_the_beginning_of_a_licence_is_none(label):
    whole = wordings(licences.TEMPLATES[label], random.Random(1)).split()
    scanner = licences.Scanner(licences.PHRASES, licences.TEMPLATES)
    assert scanner.scan(" ".join(whole))["labels"] == label
    for share in (0.3, 0.6, 0.95):
        cut = " ".join(whole[: int(len(whole) * share)])
        assert scanner.scan(f"{cut} you may not do any of this")["labels"] == ""


def plain_language_model(texts):
    """texts: (text, language). Byte trigrams counted in 32,768 bins, a log-odds classifier for
    each split of the languages, and how far and how often its margin is right."""
    bins, known = 32_768, sorted({lang for _, lang in texts})
    counts = {lang: [0.5] * bins for lang in known}
    for text, lang in texts:
        if any(c.isalpha() for c in text):
            for b in plain_trigrams(text):
                counts[lang][b] += 1
    shares = {x: [c / sum(row) for c in row] for x, row in counts.items()}
    # Every split but the one that puts all on one side; the first language is always plus.
    n = len(known)
    splits = [
        [1, *(1 if p >> k & 1 else -1 for k in range(n - 1))] for p in range(2 ** (n - 1) - 1)
    ]
    weights = []
    for split in splits:
        sides = [[shares[x] for x, s in zip(known, split) if s == sign] for sign in (1, -1)]
        means = [[sum(column) / len(side) for column in zip(*side)] for side in sides]
        weights.append([math.log(p / q) for p, q in zip(*means)])

    def margins(text):
        own = plain_trigrams(text)
        return [sum(w[b] for b in own) / (len(own) + 4) for w in weights]

    signed = [
        [m * split[known.index(lang)] for m, split in zip(margins(text), splits)]
        for text, lang in texts
        if any(c.isalpha() for c in text)
    ]
    trust = [max(2 * sum(m > 0 for m in col) / len(col) - 1, 0.01) for col in zip(*signed)]
    scale = [max(sum(map(abs, col)) / len(col), 1e-6) for col in zip(*signed)]

    def predict(text):
        own = margins(text)
        loss = [
            sum(
                t * math.log1p(math.exp(-4 * split[i] * m / s))
                for split, m, s, t in zip(splits, own, scale, trust)
            )
            for i in range(n)
        ]
        odds = [math.exp(min(loss) - x) for x in loss]
        best = max(range(n), key=lambda i: odds[i])
        return known[best], odds[best] / sum(odds)

    return predict


def plain_trigrams(text):
    data = f" {text.lower()} ".encode()
    codes = ((a << 16) + (b << 8) + c for a, b, c in zip(data, data[1:], data[2:]))
    return [code * 2654435761 % 2**32 >> 17 for code in codes]


def test_predictions_are_those_of_plain_code(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    learned = [(t, x) for i, t, x in rows if x is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    predict = plain_language_model(learned)
    found = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, SF).collect()}
    for doc_id, text, _ in rows[:60]:
        lang, score = predict(text)
        assert found[doc_id].lang_pred == lang
        assert found[doc_id].score == pytest.approx(score, rel=1e-4)
        assert found[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
