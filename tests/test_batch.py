from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfline.operators import clean, innovation, promotion, sales
from shelfline.operators.adhoc import row_count_audit
from shelfline.operators.dims import CalendarBounds
from shelfline.plans import batch
from shelfline.plans.catalog import QUERIES
from shelfline.sources.lake import read_clean, read_ordered, read_parquet, read_raw, read_table, recorded_rows, row_counts, write_table
from shelfline.sources.sample_sources import SampleSources
from shelfline.sources.schemas import FOLDERS, RAW_COLUMNS
from shelfline.sources.staging import own_staging, shared_folder, stage

from .conftest import SAMPLE, plan_of, rows_of
from .fixtures import natural

SAMPLE_BOUNDS = CalendarBounds(date(1995, 1, 1), date(2001, 12, 31))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    raw, cleaned, warehouse = (str(base / name) for name in ("raw", "clean", "warehouse"))
    source = SampleSources(spark, SAMPLE)
    for table, path in FOLDERS.items():
        writer = source.dirty(table).write.option("header", True)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{raw}/{path}.csv")
    rows = batch.build_clean(spark, raw, cleaned)
    rows |= batch.build_warehouse(spark, cleaned, warehouse, SAMPLE_BOUNDS)
    rows |= batch.build_marts(spark, cleaned, warehouse)
    return raw, cleaned, warehouse, rows


def test_clean_tables_are_those_of_the_operators(spark, built):
    _, cleaned, _, rows = built
    for table, spec in clean.CLEAN_SPECS.items():
        direct = clean.clean_table(SampleSources(spark, SAMPLE).dirty(table), spec)
        written = read_clean(spark, cleaned, table)
        assert tuple(written.columns) == RAW_COLUMNS[FOLDERS[table]]
        assert rows_of(written) == rows_of(direct)
        assert rows[table] == direct.count()


def test_recorded_row_counts_are_the_real_ones(spark, built):
    _, _, warehouse, rows = built
    names = (*batch.DIMENSIONS, *batch.FACTS, *batch.MARTS)
    df = row_counts(spark, warehouse, names)
    assert "FileScan" not in plan_of(df)
    assert {r.table_name: r.n for r in df.collect()} == {name: read_table(spark, warehouse, name).count() for name in names}
    assert {name: recorded_rows(spark, warehouse, name) for name in names} == {name: rows[name] for name in names}


def test_a_count_belongs_to_its_version(spark, tmp_path):
    base = str(tmp_path)
    for n in (4, 0, 7):
        write_table(spark.range(n), f"{base}/t")
        assert recorded_rows(spark, base, "t") == n == read_table(spark, base, "t").count()
    # A write that did not get to its end leaves the version before, and its count.
    broken = tmp_path / "t" / f"{9:010d}-{'0' * 32}"
    broken.mkdir()
    (broken / "_rows-99").touch()
    assert recorded_rows(spark, base, "t") == 7 == read_table(spark, base, "t").count()


def test_counts_of_tables_of_other_writers(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(3), f"{base}/own")
    spark.range(5).write.parquet(f"{base}/other")
    assert recorded_rows(spark, base, "other") is None
    assert rows_of(row_counts(spark, base, ["own", "other"])) == [("other", 5), ("own", 3)]
    assert rows_of(row_counts(spark, base, ["other"])) == [("other", 5)]


def _market_share(spark, *rows):
    return spark.createDataFrame(list(rows), "year int, brand string, market_share double")


def test_plain_parquet_folder(spark, tmp_path):
    rows = [(2023, "A", 0.5), (2024, "B", None)]
    _market_share(spark, *rows).repartition(2).write.parquet(f"{tmp_path}/external/market_share")
    assert rows_of(read_clean(spark, str(tmp_path), "market_share")) == rows
    assert read_clean(spark, str(tmp_path), "market_share").dtypes == [("year", "int"), ("brand", "string"), ("market_share", "double")]


def test_folder_of_another_writer_by_partition_values(spark, tmp_path):
    rows = [("A", 0.5, 2023), ("B", 0.25, 2024)]
    df = spark.createDataFrame(rows, "brand string, market_share double, year int")
    df.write.partitionBy("year").parquet(f"{tmp_path}/external/market_share")
    assert rows_of(read_clean(spark, str(tmp_path), "market_share")) == [(2023, "A", 0.5), (2024, "B", 0.25)]
    with pytest.raises(ValueError, match="year=2023"):
        write_table(df, f"{tmp_path}/external/market_share")
    assert read_table(spark, str(tmp_path), "external/market_share").count() == 2


def test_parquet_files_by_glob_and_one_file(spark, tmp_path):
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.parquet(f"{tmp_path}/part{i}")
    assert rows_of(read_parquet(spark, f"{tmp_path}/part*/*.parquet")) == [(0,), (1,), (2,)]
    one = next((tmp_path / "part2").glob("*.parquet"))
    assert rows_of(read_parquet(spark, str(one))) == [(2,)]


def test_files_that_differ_are_merged_or_refused(spark, tmp_path):
    table = f"{tmp_path}/external/market_share"
    _market_share(spark, (2023, "A", 0.5)).write.parquet(table)
    # More columns, in another order, and one less.
    spark.createDataFrame([("x", "B", 2024)], "note string, brand string, year int").write.mode("append").parquet(table)
    assert rows_of(read_clean(spark, str(tmp_path), "market_share")) == [(2023, "A", 0.5), (2024, "B", None)]
    spark.createDataFrame([("2025", "C", 0.1)], "year string, brand string, market_share double").write.mode("append").parquet(table)
    with pytest.raises(Exception, match="(?i)merge"):
        read_clean(spark, str(tmp_path), "market_share").collect()


def test_types_of_other_writers(spark, tmp_path):
    df = spark.sql("SELECT 3L AS Year, 'A' AS brand, 0.5BD AS market_share, true AS more")
    df.write.parquet(f"{tmp_path}/external/market_share")
    assert rows_of(read_clean(spark, str(tmp_path), "market_share")) == [(3, "A", 0.5)]
    days = spark.sql("SELECT TIMESTAMP '2024-02-03 00:00:00' AS date, 'P' AS product_id, CAST(7 AS SMALLINT) AS stock_on_hand")
    days.write.parquet(f"{tmp_path}/supply_chain/inventory")
    assert rows_of(read_clean(spark, str(tmp_path), "inventory")) == [(date(2024, 2, 3), "P", 7)]


def test_tables_that_are_not_the_declared_ones(spark, tmp_path):
    base, table = str(tmp_path), f"{tmp_path}/external/market_share"
    spark.sql("SELECT 3 AS year, 'A' AS brand").write.parquet(table)
    with pytest.raises(ValueError, match=r"lacks the columns \['market_share'\]"):
        read_clean(spark, base, "market_share")
    spark.sql("SELECT 'x' AS year, 'A' AS brand, 1D AS market_share").write.mode("overwrite").parquet(table)
    with pytest.raises(ValueError, match="year"):
        read_clean(spark, base, "market_share")
    spark.sql("SELECT 3000000000 AS year, 'A' AS brand, 1D AS market_share").write.mode("overwrite").parquet(table)
    with pytest.raises(Exception, match="no room in an int for 3000000000"):
        read_clean(spark, base, "market_share").collect()


def test_batch_from_plain_parquet_of_another_writer(spark, built, tmp_path):
    _, cleaned, warehouse, rows = built
    for table in FOLDERS:
        read_clean(spark, cleaned, table).write.parquet(f"{tmp_path}/clean/{FOLDERS[table]}")
    again = batch.build_warehouse(spark, f"{tmp_path}/clean", f"{tmp_path}/warehouse", SAMPLE_BOUNDS)
    assert again == {name: rows[name] for name in again}
    for name in ("dim_store", "fact_sellout"):
        assert rows_of(read_table(spark, f"{tmp_path}/warehouse", name)) == rows_of(read_table(spark, warehouse, name))


def test_reported_row_counts(spark, built):
    _, _, warehouse, rows = built
    names = (*batch.DIMENSIONS, *batch.FACTS, *batch.MARTS)
    audit = row_count_audit({name: read_table(spark, warehouse, name) for name in names})
    assert {r.table_name: r.n for r in audit.collect()} == {name: rows[name] for name in names}


def test_mart_equals_the_one_from_the_clean_tables(spark, built):
    _, cleaned, warehouse, _ = built
    table = {name: read_clean(spark, cleaned, name) for name in FOLDERS}
    dims = natural(
        spark,
        table["product_master"],
        table["distributor_master"],
        (table["store_master"], table["retailer_master"]),
        bounds=SAMPLE_BOUNDS,
    )
    direct = sales.sales_mart(table["sellin"], table["sellout"], table["pos_sales"], table["ecommerce_orders"], dims)
    written = read_table(spark, warehouse, "sales_mart")
    assert written.columns == direct.columns
    assert rows_of(written) == rows_of(direct)


def test_views_can_be_queried(spark, built):
    batch.register_views(spark, built[2])
    assert len(spark.sql("SELECT * FROM v_si_vs_so LIMIT 20").collect()) == 20
    total = spark.sql("SELECT year, month, channel, SUM(revenue) AS revenue FROM sales_mart GROUP BY ALL")
    assert total.count() == spark.sql("SELECT DISTINCT year, month, channel FROM v_monthly_sales").count()
    assert spark.sql("SELECT * FROM v_promotion_effectiveness ORDER BY avg_uplift_pct DESC").count() > 0
    assert spark.sql("SELECT * FROM v_innovation_cohort WHERE sku_name LIKE '%widget%'").count() > 0


def test_a_report_on_one_year_reads_that_year(spark, built):
    batch.register_views(spark, built[2])
    plan = plan_of(spark.sql("SELECT * FROM v_regional_performance WHERE year = 1998"))
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1998)" in plan
    for name in (*batch.FACTS, "promotion_mart", "innovation_mart"):
        plan = plan_of(spark.sql(f"SELECT * FROM {name} WHERE year = 1998"))
        assert "PartitionFilters: [isnotnull(year" in plan and "= 1998)" in plan, name


def test_facts_have_the_year_of_their_day(spark, built):
    days = read_table(spark, built[2], "dim_date").select("date_key", F.col("year").alias("of_day"))
    for name in batch.FACTS:
        assert read_table(spark, built[2], name).join(days, "date_key").filter("year != of_day").isEmpty()


def test_marts_equal_those_from_the_stored_facts(spark, built):
    d = batch.read_dimensions(spark, built[2])
    fact = {name: read_table(spark, built[2], name) for name in batch.FACTS}
    pos, sellout = fact["fact_pos_sales"], fact["fact_sellout"]
    from_facts = {
        "sales_mart": sales.sales_mart(fact["fact_sellin"], sellout, pos, fact["fact_ecommerce_sales"], d),
        "promotion_mart": promotion.promotion_mart(pos, d),
        "innovation_mart": innovation.innovation_mart(pos, sellout, d),
    }
    for name, df in from_facts.items():
        assert rows_of(read_table(spark, built[2], name).select(df.columns)) == rows_of(df), name


def test_cards_can_be_queried_in_another_session(spark, built):
    other = spark.newSession()
    batch.register_views(other, built[2])
    cards = [name for name in QUERIES if name.startswith("card_")]
    assert len(cards) == 11
    assert all(not other.table(name).isEmpty() for name in cards)


def test_nothing_staged_remains(built):
    assert not [path for path in Path(built[2]).iterdir() if path.name.startswith("_")]


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    write_table(spark.range(10), str(tmp_path / "t"))
    failing = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_table(failing, str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path), "t").count() == 10
    assert write_table(spark.range(5), str(tmp_path / "t")) == 5
    assert read_table(spark, str(tmp_path), "t").count() == 5
    assert write_table(spark.range(6), str(tmp_path / "t")) == 6
    assert len(list((tmp_path / "t").iterdir())) == 2


def test_reader_of_the_version_before_is_not_disturbed(spark, tmp_path):
    write_table(spark.range(10), str(tmp_path / "t"))
    old = read_table(spark, str(tmp_path), "t")
    write_table(spark.range(5), str(tmp_path / "t"))
    assert old.count() == 10


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path), "t")


def test_building_again_replaces_the_tables(spark, built):
    _, cleaned, warehouse, rows = built
    again = batch.build_warehouse(spark, cleaned, warehouse, SAMPLE_BOUNDS)
    again |= batch.build_marts(spark, cleaned, warehouse)
    assert again == {name: rows[name] for name in again}


def test_raw_file_with_byte_order_mark(spark, tmp_path):
    folder = tmp_path / "external"
    folder.mkdir()
    (folder / "market_share.csv").write_text("﻿Year, Brand ,market share\n2023,Côla,0.5\n", encoding="utf-8")
    df = read_raw(spark, str(tmp_path), "market_share")
    assert rows_of(clean.clean_market_share(df)) == [(2023, "Côla", 0.5)]


def test_raw_file_without_an_expected_column(spark, tmp_path):
    folder = tmp_path / "external"
    folder.mkdir()
    (folder / "market_share.csv").write_text("year,brand\n2023,A\n")
    with pytest.raises(ValueError, match="market_share"):
        read_raw(spark, str(tmp_path), "market_share")


def test_raw_files_with_different_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "external" / "market_share.csv"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("year,brand,market_share\n2023,A,0.5\n")
    (folder / "b.csv").write_text("brand,year,market_share\nA,2023,0.5\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path), "market_share").collect()


def test_hot_value_of_the_partition_column_is_written_whole(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 7, id % 50) AS year")
    assert write_table(df, str(tmp_path / "t"), ["year"]) == 1000
    assert sorted(r.id for r in read_table(spark, str(tmp_path), "t").collect()) == list(range(1000))


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark).removeprefix("file:").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_own_staging_is_deleted_also_after_a_failure(spark, tmp_path):
    before = shared_folder(spark)
    with pytest.raises(KeyError), own_staging(spark, str(tmp_path)) as folder:
        assert shared_folder(spark) == folder
        assert stage(spark.range(3), "x").count() == 3 and list(tmp_path.iterdir())
        raise KeyError
    assert not list(tmp_path.iterdir()) and shared_folder(spark) == before


def _rows_scanned(df):
    """Rows that left the scan: a row group that its statistics rule out gives none."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_a_filter_reads_few_row_groups_of_a_sorted_file(spark, tmp_path, settings):
    settings(adaptive__enabled="false")
    # Small blocks, so that a small file has many row groups.
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "20000"), conf.set("parquet.page.size.row.check.min", "10"), conf.set("parquet.page.size.row.check.max", "10")
    try:
        df = spark.range(60_000).selectExpr("2024 AS year", "date_add(DATE '2024-01-01', int(id * 7919 % 366)) AS date", "'P' || (id * 31 % 500) AS product_id", "rand(1) AS revenue")
        write_table(df, f"{tmp_path}/sorted", ["year"], sort_by=("date", "product_id"))
        write_table(df, f"{tmp_path}/plain", ["year"])
    finally:
        for name in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.page.size.row.check.max"):
            conf.unset(name)
    chosen = "product_id = 'P77' AND date BETWEEN DATE '2024-05-01' AND DATE '2024-05-31'"
    ordered, plain = (read_table(spark, str(tmp_path), name).filter(chosen) for name in ("sorted", "plain"))
    assert rows_of(ordered) == rows_of(plain) and ordered.count() > 0
    assert _rows_scanned(ordered) < 0.3 * _rows_scanned(plain)


def test_stored_tables_are_sorted_within_files(spark, built):
    for name in ("sales_mart", "fact_pos_sales"):
        table = read_table(spark, built[2], name)
        day, thing = ("date", "product_name") if name == "sales_mart" else ("date_key", "product_key")
        files = {}
        for row in table.select(F.input_file_name().alias("f"), day, thing).collect():
            files.setdefault(row.f, []).append((row[day], row[thing]))
        assert all(rows == sorted(rows) for rows in files.values()) and files


def test_the_launch_mart_comes_in_its_order(spark, built):
    rows = [(r.product_id, r.channel, r.date) for r in read_ordered(spark, built[2], "innovation_mart").collect()]
    assert rows == sorted(rows) and len(rows) > 100
    batch.register_views(spark, built[2])
    assert [(r.product_id, r.channel, r.date) for r in spark.sql("SELECT * FROM innovation_mart LIMIT 50").collect()] == rows[:50]
    # What does not show the order does not sort.
    assert "Sort" not in plan_of(spark.sql("SELECT SUM(qty) FROM innovation_mart"))
    assert read_ordered(spark, built[2], "dim_date").columns == read_table(spark, built[2], "dim_date").columns
