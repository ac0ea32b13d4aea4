"""Conversation repair, the prefix trie and toxicity, against plain code of their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm import ordered, prefixes, repair, toxicity
from ledgerstats.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF

SPACE = " \t\n\x0b\f\r"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}  # by the initial before: the one that may follow
NAMES = {"u": "user", "a": "assistant"}

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # Names that the operators use for columns of their own.
        T.StructField("part", T.StringType()),
        T.StructField("place", T.StringType()),
        T.StructField("letter", T.StringType()),
        T.StructField("depth", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def talks(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], TURNS)

    return make


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        conv, number, role, text = (" " if x is None else x for x in (conv_id, turn, role, text))
        fault = zlib.crc32(f"{conv}:{number}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = conv_id, turn, "user" if fault == 4 else role, text
        out += [row] * {0: 0, 3: 2}.get(fault, 1)
    return out


def plain_repair(rows):
    """rows: (role, text, must go, truncated). All ways are carried on with their whole letters;
    of those that end alike the least is kept, which is safe as later edits only depend on that."""
    ways = {"": (0, "", ())}
    for role, text, gone, cut in rows:
        found = defaultdict(list)
        for state, (cost, audit, lines) in ways.items():
            for _ in range(4):
                found[state].append((cost + 3, f"{audit}D", lines))
                follow = AFTER[state]
                if not gone:
                    line = f"{NAMES[follow]}:{text}"
                    found[follow].append((cost + 2 + cut, f"{audit}R", (*lines, line)))
                    initial = role[:1]
                    if initial == follow or (initial == "s" and state == ""):
                        found[initial].append((cost + cut, f"{audit}K", (*lines, f"{role}:{text}")))
                state, cost, audit = follow, cost + 2, f"{audit}I"
                lines = (*lines, f"{NAMES[follow]}:")
        ways = {state: min(all_, key=lambda w: w[:2]) for state, all_ in found.items()}
    ends = []
    for state, (cost, audit, lines) in ways.items():
        while state in ("s", "u"):
            state, cost, audit = AFTER[state], cost + 2, f"{audit}I"
            lines = (*lines, f"{NAMES[state]}:")
        ends.append((cost, audit, lines))
    return min(ends, key=lambda w: w[:2])


def tie(row):
    _, role, text = row
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain_repairs(rows, damage=plain_damage):
    by_conv, out = defaultdict(list), []
    for conv_id, turn, role, text in damage(rows):
        by_conv[conv_id].append((turn, role, text))
    for conv_id in {r[0] for r in rows}:
        own, seen, counts, marked = by_conv[conv_id], set(), Counter(), []
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie(r)))
        for _, role, text in own:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None
            cut = fault is None and end[-1] not in ".!?"
            counts[fault or ("truncated" if cut else "fine")] += 1
            seen.add((role, text))
            marked.append((role, text, fault is not None, cut))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        numbers = {t for t, _, _ in own if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit, lines = plain_repair(marked)
        faults = (counts[x] for x in ("blank", "duplicate", "truncated"))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, *faults, illegal, cost, audit, digest))
    return Counter(out)


def repaired(conversations, damage=repair.damaged):
    found = repair.repair_digests(conversations, damage(conversations)).collect()
    return Counter(tuple(r) for r in found)


def test_edits_of_every_short_conversation_are_the_cheapest_and_first():
    for n in range(1, 6):
        for letters in product("xsuaoSUA" if n < 5 else "xsuaU", repeat=n):
            marked = [(x.lower(), "", x == "x", x.isupper()) for x in letters]
            cost, audit, _ = plain_repair(marked)
            whole = "".join(letters)
            vector, total = repair.forward(whole, repair.START)
            costs = [-1 if x is None else x[0] + total for x in vector] * 4
            ranks = [-1 if x is None else x[1] for x in vector] * 4
            found, (first, last) = repair.joined([(costs, ranks)])
            edits = repair.cheapest_edits(whole, first, last) + repair.TAIL[last]
            assert (found, edits) == (cost, audit), whole


def test_segments_join_to_what_the_whole_gives():
    draw = np.random.default_rng(4)
    for _ in range(300):
        letters = "".join(draw.choice(list("xsuaoUA"), draw.integers(2, 30)))
        cuts = sorted({0, len(letters), *draw.integers(1, len(letters), 3).tolist()})
        pieces = [letters[a:b] for a, b in zip(cuts, cuts[1:])]
        segments = [
            repair._segment(1, i, [(j, "", 1, "u", x, None) for j, x in enumerate(piece)])
            for i, piece in enumerate(pieces)
        ]
        cost, states = repair.joined([(s[6], s[7]) for s in segments])
        edits = "".join(
            repair.cheapest_edits(p, a, b) for p, a, b in zip(pieces, states, states[1:])
        )
        expected = plain_repair([(x.lower(), "", x == "x", x.isupper()) for x in letters])[:2]
        assert (cost, edits + repair.TAIL[states[-1]]) == expected


def test_repairs_are_those_of_a_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = Counter(tuple(r) for r in QUERIES["op11_conversation_repair"](spark, SF).collect())
    assert found == plain_repairs(rows)


TALKS = [
    (1, 0, "user", "A question?"), (1, 1, "assistant", "An answer."),
    (1, 1, "assistant", "An answer."), (1, 4, "assistant", "no end"),
    (2, None, None, None), (2, None, "system", ""), (2, 3, "", " \x0b "),
    (3, None, "system", "Be short."), (3, None, "user", "Why?"), (3, 0, "user", "Why?"),
    (None, 1, "user", "Nobody's."), (None, None, None, "text"),
    (4, 5, "tool", "x" * 200_000), (4, 6, "user", "naïve 中文 🙂 \x00。"),
    (-7, 2**62, "assistant", "far."), (-7, -(2**61), "user", "away!"),
    *[(20, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(6)],
    *[(i, j, "user", "the same!") for i in range(21, 30) for j in range(3)],
    *[(31, 7, "user", "again.")] * 40,
]


def test_repairs_of_awkward_rows(talks):
    assert repaired(talks(TALKS)) == plain_repairs(TALKS)
    assert repaired(talks([])) == Counter()


def test_a_conversation_in_many_parts_is_repaired_as_one(talks, monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 8)
    draw = np.random.default_rng(5)
    roles, texts = ["system", "user", "assistant", "tool"], ["a.", "b", "c!", "", "d e"]
    rows = [
        (int(c), int(t), roles[draw.integers(4)], texts[draw.integers(5)] + "x?" * int(t % 3))
        for c, t in zip([5] * 150 + [6] * 30 + [7] * 4, [*range(150), *range(30), *range(4)])
    ]
    assert repaired(talks(rows)) == plain_repairs(rows)
    parts = repair.repair(talks(rows)).rows.filter("conv_id = 5").select("part").distinct().count()
    assert parts > 3


def test_undamaged_conversations_stay_as_they_are(talks):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A!")]
    rows.append((2, 0, "user", "?"))
    found = repair.repair(talks(rows))
    summary = {r.conv_id: (r.audit, r.cost) for r in found.conversations.collect()}
    assert summary == {1: ("KKK", 0), 2: ("KI", 2)}
    lines = sorted((r.conv_id, r.part, r.at, r.edit, r.role, r.text) for r in found.rows.collect())
    assert [x[0::3][:1] + x[3:] for x in lines] == [
        (1, "K", "system", "S."), (1, "K", "user", "U?"), (1, "K", "assistant", "A!"),
        (2, "K", "user", "?"), (2, "I", "assistant", ""),
    ]


def plain_trie(rows):
    talk = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            talk[conv_id].append((turn, role or "", text or ""))
    for own in talk.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(
            f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()))
    talk = {c: [r[1:] for r in own] for c, own in talk.items()}
    whole = {}
    for c, own in talk.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = tuple(talk.get(base, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
    out = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum(
            (len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1]))
            for x in below
            if x
        )
        ends = ",".join(str(c) for c in sorted(own) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not children[x] for x in below)
        digest, n = hashlib.sha256(ends.encode()).hexdigest(), len(children[node])
        out.append((min(own), len(node), parent, len(own), n, leaves, saved, digest))
    return Counter(out)


def trie(conversations):
    return Counter(tuple(r) for r in prefixes.prefix_trie(conversations).collect())


def test_tries_are_those_of_a_plain_loop(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = QUERIES["op13_prefix_trie"](spark, SF).collect()
    assert Counter(tuple(r) for r in found) == plain_trie(rows)


def test_tries_of_awkward_rows(talks):
    rows = [r for r in TALKS if r[0] is None or r[0] >= 0]
    assert trie(talks(rows)) == plain_trie(rows)
    assert trie(talks([])) == Counter()
    assert trie(talks([(None, 1, "user", "x")])) == Counter()


def test_tries_of_hot_conversations_in_many_parts(talks, monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 16)
    monkeypatch.setattr(ordered, "ROWS_PER_CHUNK", 4)
    rows = [(40, i, "user", f"long {i % 7}") for i in range(120)]
    rows += [(c, i, "user", f"the same {i}") for c in range(100, 160) for i in range(2)]
    rows += [(c, i, "user", f"long {i % 7}") for c in range(200, 204) for i in range(8)]
    assert trie(talks(rows)) == plain_trie(rows)


def test_ids_are_digested_in_order_over_lines(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_CHUNK", 3)
    monkeypatch.setattr(ordered, "PART_ROWS", 10)
    rows = spark.range(100).selectExpr("id % 3 AS k", "cast(id * 7919 % 101 AS bigint) AS v")
    expected = defaultdict(list)
    for k, v in rows.collect():
        expected[k].append(v)
    found = dict(ordered.id_list_sha256(rows, ["k"], "v", "ids").collect())
    assert found == {
        k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest()
        for k, v in expected.items()
    }


def plain_features(text, common, rare):
    """common, rare: whole words."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    n = len(words) / 100
    return {
        "seed": sum(w in toxicity.SEED for w in words) / n,
        "common": sum(w in common for w in words) / n,
        "rare": sum(w in rare for w in words) / n,
        "person": sum(w in toxicity.SECOND_PERSON for w in words) / n,
        "capitals": sum(c.isupper() for c in text) / sum(map(len, words)),
        "exclamations": text.count("!") / n,
        "length": np.log1p(len(words)),
    }


def test_features_are_those_of_a_plain_count():
    lexicon = toxicity.Lexicon({"blarg": (0, 3.0), "foo": (1, 2.0)})
    text = "YOU are a blarg! foo FOO moron, id10t and s t u p i d!!! nooo?"
    found = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon)))
    for name, value in plain_features(text, {"blarg"}, {"foo"}).items():
        assert found[name] == pytest.approx(value), name
    assert found["near_person"] == 1 and found["weight"] == 3
    far = "you blarg " + "and " * 6 + "blarg"  # one word and seven away
    assert dict(zip(toxicity.FEATURES, toxicity.features(far, lexicon)))["near_person"] == 0.5
    assert found["disguised"] > 0 and found["stretched"] > 0 and found["runs"] > 0
    assert toxicity.features("12 !", lexicon) == [0.0] * len(toxicity.FEATURES)


def labelled_texts(draw, n):
    plain = [f"word{i}" for i in range(200)]
    bad = ["grumblewort", "snarkling", "snarklings"]
    rows, labels = [], []
    for i in range(n):
        words = list(draw.choice(plain, draw.integers(20, 60)))
        toxic = i % 4 == 0
        if toxic:
            for place in draw.integers(0, len(words), 3):
                words[place] = str(draw.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark, frame):
    rows, labels = labelled_texts(np.random.default_rng(6), 600)
    kind = "doc_id long, toxic int, text string"
    labels = spark.createDataFrame([(*x, "y") for x in labels], kind)
    return rows, labels, toxicity.toxicity(frame(rows), labels).collect()


def test_held_out_toxic_texts_are_found(scored):
    _, labels, found = scored
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in found if r.held_out]
    assert len(held) > 80
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_held_out_labels_do_not_matter(frame, scored):
    rows, labels, found = scored
    flipped = F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    changed = labels.withColumn("toxic", flipped.cast("int"))
    again = toxicity.toxicity(frame(rows), changed).collect()
    assert sorted(again) == sorted(found)


def test_scores_of_awkward_rows_and_labels(spark, frame, scored):
    rows, labels, _ = scored
    found = toxicity.toxicity(frame(rows[:200] + AWKWARD), labels).collect()
    assert len(found) == 200 + len(AWKWARD)
    assert all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == 0 for r in found if r.doc_id is not None and r.doc_id < 0)
    none = labels.limit(0)
    assert {r.score for r in toxicity.toxicity(frame(AWKWARD), none).collect()} == {0.0}
    one = spark.createDataFrame([(3, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(frame(AWKWARD), one).collect()} == {1.0}
    assert toxicity.toxicity(frame([]), labels).count() == 0


def test_labels_are_sampled_by_kind_and_repeats_are_learned_once(spark):
    docs = spark.range(20_000).selectExpr("id % 10000 AS doc_id", "'some text' AS text")
    labels = spark.range(10_000).selectExpr("id AS doc_id", "cast(id % 50 = 0 AS int) AS toxic")
    rows, counts = toxicity.sampled(docs, labels, 500)
    kept = dict(rows.groupBy("toxic").count().collect())
    assert kept[1] == counts[1] < 250 and 400 < kept[0] < 600
    assert rows.select("doc_id").distinct().count() == rows.count()


NAMED = ["grobian", "lummox", "numpty", "wazzock"]


def test_lexicons_of_a_fold_do_not_know_its_texts(spark):
    rows = [(f"{NAMED[f]} common", 1, f) for f in range(4) for _ in range(30)]
    rows += [("clean words alone", 0, f) for f in range(4) for _ in range(60)]
    table = spark.createDataFrame(rows, "text string, toxic int, fold int")
    lexicons = toxicity.learned_lexicons(table)
    for fold in range(4):
        assert NAMED[fold] not in lexicons[fold].terms and NAMED[fold] in lexicons[4].terms
    assert "clean" not in lexicons[4].terms and "common" in lexicons[4].terms
