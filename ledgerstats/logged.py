"""Stored derived tables for several writers, with an index of keys and merges by size.

A table is `<root>/<name>`: `parts/<id>` with rows, `keys/<id>` with the hashes of the keys of a
part, `log` with the versions. It has the interface of `store.Store`.

An insert adds a part with the rows whose key is not stored. Where the key fixes a row's period,
only parts of that period are read. Where it does not, the parts' hashes are: they are eight
bytes a key, and name the few files that may hold a key of the batch; only these are opened.

Of two writers the one that commits first has its rows stored. The other one drops from its part
what the first has added meanwhile, and commits again.

Parts of like size are merged when there are `FANOUT` of them. A row is rewritten once for each
power of `FANOUT` that the table grows by, and there are fewer than `FANOUT` parts for each.
"""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats import files
from ledgerstats.commits import CommitLog, Part, Version
from ledgerstats.operators.firstwrite import new_rows
from ledgerstats.operators.periods import Period
from ledgerstats.schemas import DERIVED_TABLES, DerivedTable
from ledgerstats.store import declared_rows, within

#: Parts of like size that are merged into one.
FANOUT = 8
#: A file of a part with an index has about so many rows.
ROWS_PER_FILE = 1 << 18
#: A batch of at most so many keys is broadcast to where the stored hashes are read: 64 MB.
BROADCAST_KEYS = 1 << 22
HASH = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("hash", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Inserted:
    """What an insert did: rows stored, key files opened, and commits that others forestalled."""

    rows: int
    opened: int
    retries: int = 0


def tier(rows: int, fanout: int = FANOUT) -> int:
    """Parts of one tier are of like size: their rows differ by less than a factor of `fanout`."""
    found = 0
    while rows >= fanout:
        rows, found = rows // fanout, found + 1
    return found


def to_merge(parts: tuple[Part, ...], fanout: int = FANOUT) -> tuple[Part, ...]:
    """The parts of the lowest tier that has `fanout` of them; none where no tier has."""
    tiers: dict[int, list[Part]] = defaultdict(list)
    for part in parts:
        tiers[tier(part.rows, fanout)].append(part)
    full = [t for t in sorted(tiers) if len(tiers[t]) >= fanout]
    return tuple(tiers[full[0]]) if full else ()


class LoggedStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, DerivedTable] = DERIVED_TABLES,
        fanout: int = FANOUT,
        rows_per_file: int = ROWS_PER_FILE,
        before_commit: Callable[[str], None] = lambda step: None,
    ):
        """`before_commit` is told when a batch was compared, when it was written and when it
        is about to be committed."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables
        self.fanout = fanout
        self.rows_per_file = rows_per_file
        self.reached = before_commit

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as it is now, or was at a version; empty while nothing is stored."""
        log = self._log(name)
        return self._rows(name, (log.latest() if version is None else log.read(version)).parts)

    def version(self, name: str) -> Version:
        return self._log(name).latest()

    def insert(
        self,
        name: str,
        rows: DataFrame,
        period: Period | None = None,
        complete: Callable[[DataFrame, Version], DataFrame] | None = None,
    ) -> Inserted:
        """Add the rows whose key is not stored yet; the rows are unique on the key.

        `period` is the one the rows belong to. Repeating an insert that was cut short completes
        it, as what was not committed is not there. `complete` makes the rows to store from the
        new ones and the version that they will follow, for values that depend on it.
        """
        log = self._log(name)
        base, retries = log.latest(), 0
        with self._staged(name, rows) as (batch, n):
            fresh, opened = self._unseen(name, batch, n, base.parts, period)
            self.reached("compared")
            part = self._write(name, self._complete(name, fresh, base, complete), n)
        while part is not None:
            self.reached("written")
            after = log.commit(base, (*base.parts, part))
            if after is not None:
                self._merge(name, after)
                return Inserted(part.rows, opened, retries)
            newest, own = log.latest(), part
            batch, n = self._rows(name, (own,)), own.rows
            left, more = self._unseen(name, batch, n, newest.since(base), period)
            base = newest
            part = self._write(name, self._complete(name, left, base, complete), n)
            self._delete(name, own)
            opened, retries = opened + more, retries + 1
        return Inserted(0, opened, retries)

    def _complete(self, name: str, rows: DataFrame, base: Version, complete) -> DataFrame:
        if complete is None:
            return rows
        return declared_rows(name, self.tables[name], complete(rows, base))

    def replace(self, name: str, rows: DataFrame) -> None:
        """Make the rows the whole table, whatever others have committed before."""
        with self._staged(name, rows) as (batch, n):
            part = self._write(name, batch, n)
        self.reached("written")
        log = self._log(name)
        while log.commit(log.latest(), (part,) if part else ()) is None:
            pass
        self.vacuum(name)

    def drop(self, name: str) -> None:
        files.delete(self.spark, f"{self.root}/{name}")

    def vacuum(self, name: str, keep: int = 100, seconds: int = 7 * 86_400) -> None:
        """Delete versions older than `seconds` but the newest `keep`, and parts as old that
        no version names. No query or writer may take longer than that, as it may use them.

        Merges and replacements do this by themselves. Several may do it at a time.
        """
        log, before = self._log(name), time.time() - seconds
        log.forget(keep, before)
        folder = f"{self.root}/{name}/parts"
        old = {
            found
            for found in files.children(self.spark, folder)
            if (changed := files.changed(self.spark, f"{folder}/{found}")) and changed <= before
        }
        # Versions are read after the parts are listed, so a part committed since is used.
        kept = [log.find(number) for number in log.numbers()]
        for found in old - {part.id for version in kept if version for part in version.parts}:
            self._delete(name, Part(found, 0, 0))

    @contextmanager
    def _staged(self, name: str, rows: DataFrame) -> Iterator[tuple[DataFrame, int]]:
        """The declared rows; of a table with an index they are written and counted, as they
        are read for their hashes and again for their keys."""
        table = self.tables[name]
        rows = declared_rows(name, table, rows)
        if table.dated_by is not None:
            yield rows, 0
            return
        path = f"{self.root}/{name}/staged/{uuid.uuid4().hex}"
        rows.hint("rebalance").write.parquet(path)
        try:
            staged = self.spark.read.schema(table.schema).parquet(path)
            yield staged, staged.count()
        finally:
            files.delete(self.spark, path)

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{name}/log")

    def _path(self, name: str, part: Part, kind: str = "parts") -> str:
        return f"{self.root}/{name}/{kind}/{part.id}"

    def _rows(self, name: str, parts: tuple[Part, ...]) -> DataFrame:
        return self._files(name, [self._path(name, part) for part in parts])

    def _files(self, name: str, paths: list[str]) -> DataFrame:
        table = self.tables[name]
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        # The directories of buckets are not columns.
        reader = self.spark.read.schema(table.schema).option("recursiveFileLookup", True)
        return reader.parquet(*paths).select(*table.columns)

    def _unseen(
        self, name: str, batch: DataFrame, n: int, parts: tuple[Part, ...], period: Period | None
    ) -> tuple[DataFrame, int]:
        """The batch, of a table with an index n rows, without those whose key is in the parts,
        and the key files opened for it."""
        table = self.tables[name]
        if not parts:
            return batch, 0
        if table.dated_by is None:
            return self._unseen_by_index(name, batch, n, parts)
        if period is not None:
            first, stop = _bounds(table, period)
            parts = tuple(part for part in parts if part.meets(first, stop))
        stored = self._rows(name, parts)
        if period is not None:
            stored = stored.filter(within(period, table.schema[table.dated_by]))
        return new_rows(stored, batch, table.key), len(parts)

    def _unseen_by_index(
        self, name: str, batch: DataFrame, n: int, parts: tuple[Part, ...]
    ) -> tuple[DataFrame, int]:
        key = self.tables[name].key
        hashes = batch.select(F.xxhash64(*key).alias("hash"))
        if n <= BROADCAST_KEYS:
            hashes = F.broadcast(hashes)
        paths = [self._path(name, part, "keys") for part in parts]
        index = self.spark.read.schema(HASH).parquet(*paths)
        hits = index.join(hashes, "hash", "left_semi").select("part", "bucket").distinct()
        # A row a file that may hold a key of the batch: no more than the table has files.
        opened = [
            f"{self.root}/{name}/parts/{row['part']}/bucket={row['bucket']}"
            for row in hits.collect()
        ]
        return new_rows(self._files(name, sorted(opened)), batch, key), len(opened)

    def _write(self, name: str, rows: DataFrame, at_most: int) -> Part | None:
        """The rows as a part that no version names yet; none where there are no rows. Of a table
        with an index there are `at_most` so many."""
        table, id_ = self.tables[name], uuid.uuid4().hex
        path = self._path(name, Part(id_, 0, 0))
        if table.dated_by is None:
            return self._write_indexed(name, id_, rows, at_most)
        order = [c for c in (table.partition_by, *table.key) if c]
        spread = rows.hint("rebalance", *[table.partition_by] * bool(table.partition_by))
        spread.sortWithinPartitions(*order).write.parquet(path)
        date = F.col(table.dated_by)
        if isinstance(table.schema[table.dated_by].dataType, T.DateType):
            date = F.unix_date(date)
        known = self.spark.read.schema(table.schema).parquet(path)
        found = known.agg(F.count("*").alias("n"), F.min(date).alias("a"), F.max(date).alias("b"))
        n, first, last = found.first()
        part = Part(id_, n, files.size_in_bytes(self.spark, path), first, last)
        return self._unless_empty(name, part)

    def _write_indexed(self, name: str, id_: str, rows: DataFrame, at_most: int) -> Part | None:
        """Rows by the first bits of their key's hash, and the hashes beside them."""
        key, part = self.tables[name].key, Part(id_, 0, 0)
        path, keys = (self._path(name, part, kind) for kind in ("parts", "keys"))
        bits = 0
        while at_most > self.rows_per_file << bits:
            bits += 1
        hash_ = F.xxhash64(*key)
        bucket = F.shiftrightunsigned(hash_, 64 - bits).cast("int") if bits else F.lit(0)
        placed = rows.withColumn("bucket", bucket).repartitionById(1 << bits, F.col("bucket"))
        placed.sortWithinPartitions(*key).write.partitionBy("bucket").parquet(path)
        written = self._rows(name, (part,))
        columns = [F.lit(id_).alias("part"), bucket.alias("bucket"), hash_.alias("hash")]
        written.select(*columns).write.parquet(keys)
        n = self.spark.read.schema(HASH).parquet(keys).count()
        size = files.size_in_bytes(self.spark, path)
        return self._unless_empty(name, Part(id_, n, size, bucket_bits=bits))

    def _unless_empty(self, name: str, part: Part) -> Part | None:
        if part.rows:
            return part
        self._delete(name, part)
        return None

    def _delete(self, name: str, part: Part) -> None:
        for kind in ("parts", "keys"):
            files.delete(self.spark, self._path(name, part, kind))

    def _merge(self, name: str, version: Version) -> None:
        """Merge parts of like size while there are as many as that takes.

        A merge changes no rows. It is given up where somebody else has merged or replaced one
        of its parts, and committed again where others were added.
        """
        while chosen := to_merge(version.parts, self.fanout):
            merged = self._write(name, self._rows(name, chosen), sum(p.rows for p in chosen))
            while True:
                gone = {part.id for part in chosen}
                if not gone <= {part.id for part in version.parts}:
                    self._delete(name, merged)
                    break
                rest = tuple(part for part in version.parts if part.id not in gone)
                after = self._log(name).commit(version, (*rest, merged))
                if after is not None:
                    version = after
                    self.vacuum(name)
                    break
                version = self._log(name).latest()


def _bounds(table: DerivedTable, period: Period) -> tuple[int, int]:
    if isinstance(table.schema[table.dated_by].dataType, T.DateType):
        return period.first, period.stop
    return period.from_ns, period.to_ns


def parts_bound(rows: int, fanout: int = FANOUT) -> int:
    """The parts that a table of so many rows has at most after an insert."""
    return (fanout - 1) * (tier(rows, fanout) + 1)


def rewritten_bound(rows: int, fanout: int = FANOUT) -> int:
    """The rows that all merges of a table that has grown to so many have written at most."""
    return reduce(lambda total, _: total + rows, range(tier(rows, fanout)), 0)
