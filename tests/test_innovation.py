from datetime import date

from pyspark.sql import functions as F

from shelfline.operators import adhoc, cards, facts, innovation, views
from shelfline.plans.catalog import QUERIES
from shelfline.sources.sample_sources import SampleSources

from .conftest import SAMPLE, rows_of
from .fixtures import natural, pos_sales, products, sellout


def mart(spark, pos, gt=(), launch=date(2023, 3, 31)):
    product = products(spark, ("P", "BrandA", launch, 1), ("Q", "BrandA", launch, 0))
    return innovation.innovation_mart(pos_sales(spark, *pos), sellout(spark, *gt), natural(spark, product))


def test_sales_before_the_launch_count_in_the_running_total_only(spark):
    rows = mart(
        spark,
        [
            (date(2023, 2, 1), "S", "P", 1, 100.0),
            (date(2023, 3, 2), "S", "P", 1, 10.0),
            (date(2023, 4, 1), "S", "P", 1, 40.0),
            (date(2023, 4, 1), "S", "Q", 1, 999.0),
        ],
        [(date(2023, 4, 1), "R", "D", "P", 1, 7.0)],
    )
    columns = "channel", "date", "month_since_launch", "revenue", "cumulative_revenue", "adoption_rate_pct"
    assert rows_of(rows.select(*columns)) == [
        ("GT", date(2023, 4, 1), 1, 7.0, 7.0, 100.0),
        ("POS", date(2023, 3, 2), 0, 10.0, 110.0, 25.0),
        ("POS", date(2023, 4, 1), 1, 40.0, 150.0, 100.0),
    ]


def test_peak_of_zero(spark):
    row = mart(spark, [(date(2023, 4, 1), "S", "P", 1, 0.0)]).first()
    assert row.adoption_rate_pct is None and row.revenue == 0.0


def test_invariants_on_the_sample(spark):
    m = QUERIES["innovation_mart"](spark, SAMPLE)
    assert m.filter("adoption_rate_pct > 100 OR month_since_launch < 0").count() == 0
    peaks = m.groupBy("product_id", "channel").agg(F.max("adoption_rate_pct").alias("peak"))
    assert peaks.filter("peak <> 100").count() == 0


def test_mart_is_the_same_from_facts_and_from_clean_tables(spark):
    s = SampleSources(spark, SAMPLE)
    d = s.dimensions("product", "store")
    pos = facts.fact_pos_sales(s.typed("pos_sales"), d)
    gt = facts.fact_sellout(s.typed("sellout"), d)
    assert rows_of(innovation.innovation_mart(pos, gt, d)) == rows_of(QUERIES["innovation_mart"](spark, SAMPLE))


def test_cohort_report_shows_the_best_day_of_the_month(spark):
    sales = [(date(2023, 4, 1), "S", "P", 1, 5.0), (date(2023, 4, 2), "S", "P", 1, 9.0), (date(2023, 9, 2), "S", "P", 1, 4.0)]
    assert rows_of(cards.card_cohort_revenue(mart(spark, sales))) == [
        ("Name P", date(2023, 3, 31), "POS", 9.0, None, 4.0, None)
    ]


def test_part_of_a_name(spark):
    cohort = views.v_innovation_cohort(mart(spark, [(date(2023, 4, 1), "S", "P", 1, 5.0)]))
    assert adhoc.adhoc_cohort_like(cohort, "ame P").count() == 1
    assert adhoc.adhoc_cohort_like(cohort, "ame_P").count() == 0
