"""The store with a log: several writers, an index of keys, merges by size."""

from __future__ import annotations

import datetime as dt
import itertools
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerstats import files
from ledgerstats.commits import CommitLog, Part, Version
from ledgerstats.logged import LoggedStore, parts_bound, rewritten_bound, tier, to_merge
from ledgerstats.operators.periods import Period
from ledgerstats.plans.registry import STATISTICS, compute
from ledgerstats.run import run
from ledgerstats.schemas import DERIVED_TABLES
from ledgerstats.sources import EventLedger
from tests.ledgers import MONDAY, rows

SMALL = "/root/testdata/sf0.001"
DAY0, DAY1 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
COUNTS = "daily_transactions_count"
PER_ACCOUNT = "daily_outgoing_transactions_per_account_count"
ADDED = "daily_accounts_added_per_ecosystem_entity"


def frame(spark, name, data):
    return spark.createDataFrame(data, DERIVED_TABLES[name].schema)


def added(spark, numbers, value):
    return frame(spark, ADDED, [(f"e{i % 7}", f"a{i}", value) for i in numbers])


@pytest.mark.parametrize("local", [True, False])
def test_a_name_is_taken_once(spark, tmp_path, monkeypatch, local):
    if not local:  # the way of file systems whose rename does not replace
        monkeypatch.setattr(files, "_open", scheme_of_another_kind(files._open))
    path = f"{tmp_path}/log/1.json"
    assert files.create_once(spark, path, "first é") and not files.create_once(spark, path, "2")
    assert files.read_text(spark, path) == "first é"
    assert [n for n in files.children(spark, f"{tmp_path}/log") if "crc" not in n] == ["1.json"]


def scheme_of_another_kind(open_):
    class Other:
        def __init__(self, fs):
            self.fs = fs

        def getScheme(self):
            return "other"

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def opened(spark, path):
        fs, p = open_(spark, path)
        return Other(fs), p

    return opened


def test_of_many_writers_of_a_version_one_succeeds(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    base = log.latest()
    assert base == Version()
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: log.commit(base, (Part(str(i), 1, 1),)), range(16)))
    (one,) = [v for v in made if v is not None]
    assert log.latest() == one and one.number == 1 and len(one.parts) == 1


def test_a_writer_far_behind_does_not_take_a_forgotten_number(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    old = version = log.commit(Version(), (Part("0", 1, 1),))
    for i in range(1, 6):
        version = log.commit(version, (Part(f"{i}", 1, 1),))
    log.forget(1, before=0.0)
    assert log.numbers() == [1, 2, 3, 4, 5, 6]
    log.forget(1, before=float("inf"))
    assert log.numbers() == [6]
    assert log.commit(old, (Part("late", 1, 1),)) is None
    assert log.latest() == version


@pytest.mark.parametrize("period", [None, Period("day", MONDAY, MONDAY + 2)])
def test_first_write_wins(spark, tmp_path, period):
    store = LoggedStore(spark, str(tmp_path))
    assert store.read(PER_ACCOUNT).count() == 0
    store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, [(DAY0, "a", 1)]), period)
    again = [(DAY0, "a", 2), (DAY0, "b", 3), (DAY1, "a", 4)]
    assert store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, again), period).rows == 2
    assert store.insert(PER_ACCOUNT, frame(spark, PER_ACCOUNT, again), period).rows == 0
    assert rows(store.read(PER_ACCOUNT)) == [(DAY0, "a", 1), (DAY0, "b", 3), (DAY1, "a", 4)]
    assert store.version(PER_ACCOUNT).number == 2
    assert rows(store.read(PER_ACCOUNT, version=1)) == [(DAY0, "a", 1)]


@pytest.mark.parametrize("name", [ADDED, PER_ACCOUNT])
@pytest.mark.parametrize("step", ["compared", "written"])
@pytest.mark.parametrize("other", ["insert", "merge", "replace"])
def test_two_writers_keep_the_first_row_of_each_key(spark, tmp_path, name, step, other):
    """While one insert is under way, at each of its steps, another writer commits."""

    def batch(numbers, value):
        if name == ADDED:
            return added(spark, numbers, value)
        return frame(spark, name, [(DAY0, f"a{i}", value) for i in numbers])

    def values():
        return {r[1]: r[2] for r in rows(store.read(name))}

    second = LoggedStore(spark, str(tmp_path), fanout=2 if other == "merge" else 8)
    todo = [step]

    def interfere(at):
        if todo and at == todo[0]:
            todo.clear()
            if other == "replace":
                second.replace(name, batch(range(5, 15), 2))
            else:
                second.insert(name, batch(range(5, 15), 2))

    store = LoggedStore(spark, str(tmp_path), before_commit=interfere)
    second.insert(name, batch(range(3), 0))
    found = store.insert(name, batch(range(10, 20), 1))
    assert found.retries == 1 and found.rows == 5
    expected = {f"a{i}": 1 for i in range(15, 20)} | {f"a{i}": 2 for i in range(5, 15)}
    if other != "replace":
        expected |= {f"a{i}": 0 for i in range(3)}
    assert values() == expected
    assert store.insert(name, batch(range(20), 9)).rows == 20 - len(expected)


def test_writers_side_by_side_store_each_key_once(spark, tmp_path):
    def write(value):
        store = LoggedStore(spark, str(tmp_path), fanout=3)
        for start in range(0, 40, 10):
            store.insert(ADDED, added(spark, range(start, start + 15), value))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    found = LoggedStore(spark, str(tmp_path)).read(ADDED)
    assert found.count() == 45 and found.select("account_id").distinct().count() == 45
    # Rows of one insert that nobody forestalled keep its value.
    assert {r[2] for r in rows(found)} <= {0, 1, 2}


def test_an_insert_that_was_cut_short_is_not_there(spark, tmp_path):
    def fail(step):
        if step == "written":
            raise OSError("lost")

    with pytest.raises(OSError):
        LoggedStore(spark, str(tmp_path), before_commit=fail).insert(ADDED, added(spark, [1], 1))
    store = LoggedStore(spark, str(tmp_path))
    assert store.read(ADDED).count() == 0
    assert store.insert(ADDED, added(spark, [1, 2], 2)).rows == 2
    folder = f"{tmp_path}/{ADDED}/parts"
    assert len(files.children(spark, folder)) == 2
    store.vacuum(ADDED, seconds=3600)
    assert len(files.children(spark, folder)) == 2
    store.vacuum(ADDED, seconds=0)
    assert len(files.children(spark, folder)) == 1 and store.read(ADDED).count() == 2


def test_files_opened_follow_the_batch(spark, tmp_path):
    store = LoggedStore(spark, str(tmp_path), rows_per_file=50)
    store.insert(ADDED, added(spark, range(3000), 1))
    (part,) = store.version(ADDED).parts
    stored = 1 << part.bucket_bits
    assert stored == 64 and part.rows == 3000
    # Keys that are not stored open no file; k stored ones open k files at most.
    assert store.insert(ADDED, added(spark, range(10_000, 10_400), 2)).opened == 0
    for k in (1, 5, 20):
        found = store.insert(ADDED, added(spark, [*range(k), 20_000 + k], 3))
        assert found.rows == 1 and 1 <= found.opened <= k
    whole = store.insert(ADDED, added(spark, range(3000), 4))
    assert whole.rows == 0 and whole.opened == stored
    values = store.read(ADDED).groupBy("added_at_block_timestamp").count().collect()
    assert dict(values) == {1: 3000, 2: 400, 3: 3}


def test_large_batches_are_compared_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerstats.logged.BROADCAST_KEYS", 10)
    store = LoggedStore(spark, str(tmp_path), rows_per_file=20)
    store.insert(ADDED, added(spark, range(100), 1))
    assert store.insert(ADDED, added(spark, range(50, 150), 2)).rows == 50
    assert store.read(ADDED).count() == 150


@pytest.mark.parametrize("fanout", [2, 4, 8])
def test_merges_rewrite_n_log_n_rows(fanout):
    """The choice of parts alone, over 2,000 inserts of one row and of differing sizes."""
    sizes = {"equal": itertools.repeat(1), "mixed": itertools.cycle([1, 50, 3, 700, 2])}
    for kind in sizes.values():
        parts, rewritten, total = (), 0, 0
        for i, n in zip(range(2000), kind):
            parts, total = (*parts, Part(f"{i}", n, n)), total + n
            while chosen := to_merge(parts, fanout):
                merged = sum(p.rows for p in chosen)
                rewritten += merged
                gone = {p.id for p in chosen}
                rest = tuple(p for p in parts if p.id not in gone)
                parts = (*rest, Part(f"m{i}-{merged}-{len(rest)}", merged, merged))
            assert len(parts) <= parts_bound(total, fanout)
        assert sum(p.rows for p in parts) == total
        assert rewritten <= rewritten_bound(total, fanout) and rewritten > total


def test_tiers():
    assert [tier(n, 8) for n in (1, 7, 8, 63, 64, 512)] == [0, 0, 1, 1, 2, 3]


def test_many_inserts_leave_few_parts(spark, tmp_path):
    store = LoggedStore(spark, str(tmp_path), fanout=4)
    days = [DAY0 + dt.timedelta(days=i) for i in range(40)]
    for i, day in enumerate(days):
        number = MONDAY + i
        store.insert(COUNTS, frame(spark, COUNTS, [(day, i)]), Period("day", number, number + 1))
    assert rows(store.read(COUNTS)) == [(day, i) for i, day in enumerate(days)]
    version = store.version(COUNTS)
    assert len(version.parts) <= parts_bound(40, 4) == 9
    # A part knows its days, so that a run opens those of its period alone.
    assert sum(p.meets(MONDAY + 39, MONDAY + 40) for p in version.parts) == 1
    found = store.insert(
        COUNTS, frame(spark, COUNTS, [(days[5], 99)]), Period("day", MONDAY + 5, MONDAY + 6)
    )
    assert (found.rows, found.opened) == (0, 1)
    store.vacuum(COUNTS, keep=2, seconds=0)
    assert len(files.children(spark, f"{tmp_path}/{COUNTS}/parts")) <= 9 + 4


def test_sixty_daily_inserts_equal_a_rebuild(spark, tmp_path):
    """Accounts added, whose key holds no date: a batch a day, of old and new accounts."""
    batches = [
        spark.range(30).select(
            F.concat(F.lit("e"), F.col("id") % 4).alias("entity_id"),
            F.concat(F.lit("u"), (F.col("id") * 31 + d * 17) % 400).alias("account_id"),
            F.lit(d * 10).cast("bigint").alias("added_at_block_timestamp"),
        )
        for d in range(60)
    ]
    store = LoggedStore(spark, str(tmp_path / "daily"), rows_per_file=16)
    for batch in batches:
        store.insert(ADDED, batch.dropDuplicates(["entity_id", "account_id"]))
    whole = None
    for batch in batches:
        whole = batch if whole is None else whole.unionByName(batch)
    first = whole.groupBy("entity_id", "account_id").agg(F.min("added_at_block_timestamp"))
    assert rows(store.read(ADDED)) == rows(first)
    rebuilt = LoggedStore(spark, str(tmp_path / "rebuilt"))
    rebuilt.replace(ADDED, first.toDF(*DERIVED_TABLES[ADDED].columns))
    assert rows(rebuilt.read(ADDED)) == rows(first)


def test_an_empty_result_and_a_null_key(spark, tmp_path):
    store = LoggedStore(spark, str(tmp_path))
    for name in (COUNTS, ADDED):
        store.replace(name, frame(spark, name, []))
        assert rows(store.read(name)) == []
        assert store.insert(name, frame(spark, name, [])).rows == 0
    with pytest.raises(Exception, match=f"NULL in {ADDED}.account_id"):
        store.insert(ADDED, frame(spark, ADDED, [("e", None, 1)]))
    store.insert(ADDED, added(spark, [1], 1))
    store.replace(ADDED, added(spark, [2], 2))
    assert rows(store.read(ADDED)) == [("e2", "a2", 2)]
    store.drop(ADDED)
    assert store.read(ADDED).count() == 0


def test_runs_use_it_like_the_other_store(spark, tmp_path):
    ledger = EventLedger(spark, SMALL)
    names = [ADDED, PER_ACCOUNT, "daily_active_accounts_count", "deployed_contracts"]
    rebuilt = LoggedStore(spark, str(tmp_path / "rebuilt"))
    run(ledger, rebuilt, names, rebuild=True)
    for name in names:
        key = STATISTICS[name].table.key
        expected = compute(ledger, name).orderBy(*key).collect()
        assert rebuilt.read(name).orderBy(*key).collect() == expected
    daily = LoggedStore(spark, str(tmp_path / "daily"), fanout=2)
    for day in (MONDAY, MONDAY + 1, MONDAY + 1, MONDAY + 2):
        run(ledger, daily, [ADDED], timestamp=day * 86_400)
    end = (MONDAY + 3) * 86_400 * 10**9
    expected = rebuilt.read(ADDED).filter(F.col("added_at_block_timestamp") < end)
    assert rows(daily.read(ADDED)) == rows(expected)
