"""Sources give the declared columns, and a range of a table is that range of it."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerstats.functions.calendar import DAY_NS
from ledgerstats.operators.periods import between
from ledgerstats.schemas import SOURCE_TABLES, TIME_COLUMN
from ledgerstats.sources import CatalogSource, EventLedger, ParquetSource, read_entities
from tests.ledgers import at

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SOURCE_TABLES))
def test_event_tables_have_the_declared_types(spark, name):
    columns = {f.name: f.dataType for f in EventLedger(spark, SMALL).table(name).schema.fields}
    assert columns == {f.name: f.dataType for f in SOURCE_TABLES[name].fields}


@pytest.mark.parametrize("name", sorted(TIME_COLUMN))
@pytest.mark.parametrize("bounds", [(at(2), at(4)), (at(2, 1_234, 567), at(3, 600, 1))])
def test_a_range_of_events_is_that_range_of_the_table(spark, name, bounds):
    ledger = EventLedger(spark, SMALL)
    ranged = ledger.between(name, *bounds)
    expected = between(ledger.table(name), TIME_COLUMN[name], *bounds)
    assert ranged.schema.simpleString() == expected.schema.simpleString()
    assert sorted(ranged.collect()) == sorted(expected.collect())
    assert ranged.count() > 0


def test_times_do_not_depend_on_the_session_zone(spark):
    def first():
        return EventLedger(spark, SMALL).extent()

    utc = first()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert first() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_types_may_be_wider(spark, tmp_path):
    """A catalog or database may hold times and gas as wide decimals."""
    spark.sql("CREATE DATABASE IF NOT EXISTS wide_ledger")
    try:
        wide = EventLedger(spark, SMALL).table("blocks").select(
            "block_hash",
            F.col("block_timestamp").cast("decimal(20,0)").alias("block_timestamp"),
            F.col("gas_price").alias("gas_price"),
            F.lit("not used").alias("author"),
        )
        wide.write.option("path", str(tmp_path / "blocks")).saveAsTable("wide_ledger.blocks")
        source = CatalogSource(spark, "wide_ledger")
        rows = source.between("blocks", at(2), at(4))
        assert rows.schema.simpleString() == SOURCE_TABLES["blocks"].simpleString()
        expected = EventLedger(spark, SMALL).between("blocks", at(2), at(4))
        assert sorted(rows.collect()) == sorted(expected.collect())
        assert source.extent() == EventLedger(spark, SMALL).extent()
    finally:
        spark.sql("DROP DATABASE wide_ledger CASCADE")


def test_the_catalogue_document(spark, tmp_path):
    records = [
        {"slug": "b", "category": "app", "contract": "c1", "unknown": {"x": [1]}},
        {"slug": "a", "title": None},
    ]
    path = tmp_path / "entities.json"
    path.write_text(json.dumps(records, indent=1))
    found = read_entities(spark, str(path)).orderBy("_position").collect()
    assert [(r.slug, r.category, r.contract, r.title) for r in found] == [
        ("b", "app", "c1", None), ("a", None, None, None),
    ]
    path.write_text('[{"slug": "b", ')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_entities(spark, str(path)).collect()


def test_a_landed_ledger_has_its_catalogue_beside_it(spark):
    assert ParquetSource(spark, "/data/ledger/").entities_path == "/data/ledger/entities.json"


def test_times_landed_as_wide_decimals(spark, tmp_path):
    """A table exported with numeric(20,0) times is read, and bounds still reach its scan."""
    source = EventLedger(spark, SMALL)
    blocks = source.table("blocks")
    time = F.col("block_timestamp").cast("decimal(20,0)")
    blocks.withColumn("block_timestamp", time).write.parquet(f"{tmp_path}/blocks")
    landed = ParquetSource(spark, str(tmp_path))
    assert landed.extent() == source.extent()
    assert landed.table("blocks").schema["block_timestamp"].dataType.simpleString() == "bigint"
    bounds = (source.extent().first_ns, source.extent().first_ns + DAY_NS)
    day = landed.between("blocks", *bounds)
    assert day.count() == source.between("blocks", *bounds).count()
    assert "GreaterThanOrEqual(block_timestamp" in day._jdf.queryExecution().toString()


def by_day(source, name, root):
    time = F.expr(f"date_from_unix_date(CAST({TIME_COLUMN[name]} div {DAY_NS} AS INT))")
    source.table(name).withColumn("day", time).write.partitionBy("day").parquet(f"{root}/{name}")


@pytest.mark.parametrize("day_column", [None, "day"])
def test_the_extent_comes_from_the_files_statistics(spark, tmp_path, monkeypatch, day_column):
    source = EventLedger(spark, SMALL)
    if day_column:
        by_day(source, "blocks", tmp_path)
    else:
        source.table("blocks").repartition(3).write.parquet(f"{tmp_path}/blocks")
    landed = ParquetSource(spark, str(tmp_path), day_column=day_column)
    with monkeypatch.context() as m:
        m.setattr("ledgerstats.sources.base.ledger_extent", None)  # no scan
        found = landed.extent()
    assert found == landed.extent() == source.extent()
    # Past a number of files the column is scanned.
    monkeypatch.setattr("ledgerstats.sources.parquet.MOST_FOOTERS", 0)
    assert landed.extent() == source.extent()


def test_files_without_statistics_are_scanned(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    source = EventLedger(spark, SMALL)
    times = [r.block_timestamp for r in source.table("blocks").collect()]
    (tmp_path / "blocks").mkdir()
    table = pa.table(
        {
            "block_hash": pa.array([str(t) for t in times]),
            "block_timestamp": pa.array(times, pa.int64()),
            "gas_price": pa.array([None] * len(times), pa.decimal128(38, 0)),
        }
    )
    pq.write_table(table, tmp_path / "blocks" / "a.parquet", write_statistics=False)
    pq.write_table(table.slice(0, 0), tmp_path / "blocks" / "b.parquet")
    assert ParquetSource(spark, str(tmp_path)).extent() == source.extent()
    (tmp_path / "empty" / "blocks").mkdir(parents=True)
    pq.write_table(table.slice(0, 0), tmp_path / "empty" / "blocks" / "b.parquet")
    assert ParquetSource(spark, str(tmp_path / "empty")).extent() is None
