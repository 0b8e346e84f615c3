"""Every operator as a query on the sample tables: name -> (spark, folder) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import demand_columns
from ..operators import adhoc, cards, clean, dims, facts, innovation, promotion, sales, views
from ..operators.keys import dense_key
from ..sources.sample_sources import SampleSources
from ..sources.staging import stage, stage_together

Query = Callable[[SparkSession, str], DataFrame]


# Marts. They join on natural keys, so no surrogate keys have to be computed for them.


def _sales_mart(s: SampleSources) -> DataFrame:
    return sales.sales_mart(
        s.typed("sellin"),
        s.typed("sellout"),
        s.typed("pos_sales"),
        s.typed("ecommerce_orders"),
        s.natural_dimensions("product", "distributor", "store"),
    )


def _promotion_mart(s: SampleSources) -> DataFrame:
    return promotion.promotion_mart(s.typed("pos_sales"), s.natural_dimensions("product", "promotion"))


def _innovation_daily(s: SampleSources) -> DataFrame:
    return innovation.innovation_daily(s.typed("pos_sales"), s.typed("sellout"), s.natural_dimensions("product"))


def _innovation_mart(s: SampleSources) -> DataFrame:
    return innovation.innovation_mart(s.typed("pos_sales"), s.typed("sellout"), s.natural_dimensions("product"))


def _promotion_effectiveness(s: SampleSources) -> DataFrame:
    return views.v_promotion_effectiveness(_promotion_mart(s), s.natural_dimensions("product").product)


def _row_count_audit(s: SampleSources) -> DataFrame:
    """Row counts of the warehouse. The marts are built from the fact tables here, on surrogate keys, and each fact
    is written once, so that no count and no mart computes it again. The three that come from the order lines are
    written together: the lines are shuffled once for them.
    """
    d = s.dimensions("product", "distributor", "store", "promotion")
    of_orders = {
        "fact_sellout": facts.fact_sellout(s.typed("sellout"), d),
        "fact_pos_sales": facts.fact_pos_sales(s.typed("pos_sales"), d),
        "fact_ecommerce_sales": facts.fact_ecommerce_sales(s.typed("ecommerce_orders"), d),
    }
    fact = {
        "fact_sellin": stage(facts.fact_sellin(s.typed("sellin"), d), "fact_sellin"),
        **stage_together(of_orders, "facts_of_orders"),
        "fact_inventory": stage(facts.fact_inventory(s.typed("inventory"), d), "fact_inventory"),
    }
    pos, sellout = fact["fact_pos_sales"], fact["fact_sellout"]
    return adhoc.row_count_audit(
        {
            "dim_date": d.date,
            "dim_product": d.product,
            "dim_distributor": d.distributor,
            "dim_store": d.store,
            "dim_promotion": d.promotion,
            **fact,
            "sales_mart": sales.sales_mart(
                fact["fact_sellin"], sellout, pos, fact["fact_ecommerce_sales"], d
            ),
            "promotion_mart": promotion.promotion_mart(pos, d),
            "innovation_mart": innovation.innovation_mart(pos, sellout, d),
        }
    )


def _clean_query(source: str) -> Callable[[SampleSources], DataFrame]:
    return lambda s: clean.clean_table(s.dirty(source), clean.CLEAN_SPECS[source])


_QUERIES: dict[str, Callable[[SampleSources], DataFrame]] = {
    **{f"clean_{source}": _clean_query(source) for source in clean.CLEAN_SPECS},
    # Dimensions
    "dim_date": lambda s: s.calendar(),
    "dim_product": lambda s: dims.dim_product(s.typed("product_master")),
    "dim_distributor": lambda s: dims.dim_distributor(s.typed("distributor_master")),
    "dim_store": lambda s: dims.dim_store(s.typed("store_master"), s.typed("retailer_master")),
    "dim_promotion": lambda s: dims.dim_promotion(s.typed("promotions")),
    "dense_key_bucketed": lambda s: dense_key(
        s.table("part").select("p_partkey", "p_name"), ["p_partkey"], "part_key"
    ),
    # Facts
    "fact_sellin": lambda s: facts.fact_sellin(s.typed("sellin"), s.dimensions("product", "distributor")),
    "fact_sellout": lambda s: facts.fact_sellout(s.typed("sellout"), s.dimensions("product", "store")),
    "fact_pos_sales": lambda s: facts.fact_pos_sales(s.typed("pos_sales"), s.dimensions("product", "store")),
    "fact_ecommerce_sales": lambda s: facts.fact_ecommerce_sales(s.typed("ecommerce_orders"), s.dimensions("product")),
    "fact_inventory": lambda s: facts.fact_inventory(s.typed("inventory"), s.dimensions("product")),
    # Marts
    "sales_mart": _sales_mart,
    "promo_calendar": lambda s: promotion.promo_calendar(
        s.natural_dimensions("promotion").promotion, s.natural_dimensions().date
    ),
    "promotion_mart": _promotion_mart,
    "innovation_daily": _innovation_daily,
    "innovation_mart": _innovation_mart,
    # Views
    "v_monthly_sales": lambda s: views.v_monthly_sales(_sales_mart(s)),
    "v_si_vs_so": lambda s: views.v_si_vs_so(_sales_mart(s)),
    "v_innovation_cohort": lambda s: views.v_innovation_cohort(_innovation_mart(s)),
    "v_promotion_effectiveness": _promotion_effectiveness,
    "v_regional_performance": lambda s: views.v_regional_performance(_sales_mart(s)),
    # Dashboard cards
    "card_monthly_revenue_by_channel": lambda s: cards.card_monthly_revenue_by_channel(_sales_mart(s)),
    "card_si_vs_so_summary": lambda s: cards.card_si_vs_so_summary(_sales_mart(s)),
    "card_sales_by_region": lambda s: cards.card_sales_by_region(_sales_mart(s)),
    "card_top_brands": lambda s: cards.card_top_brands(_sales_mart(s)),
    "card_ecommerce_by_platform": lambda s: cards.card_ecommerce_by_platform(
        s.typed("ecommerce_orders"), s.natural_dimensions("product")
    ),
    "card_promo_uplift_by_type": lambda s: cards.card_promo_uplift_by_type(_promotion_mart(s)),
    "card_promo_vs_nonpromo": lambda s: cards.card_promo_vs_nonpromo(_promotion_mart(s)),
    "card_top_promoted_products": lambda s: cards.card_top_promoted_products(_promotion_mart(s)),
    "card_adoption_curve": lambda s: cards.card_adoption_curve(_innovation_mart(s)),
    "card_innovation_by_brand": lambda s: cards.card_innovation_by_brand(_innovation_mart(s)),
    "card_cohort_revenue": lambda s: cards.card_cohort_revenue(_innovation_mart(s)),
    # Ad-hoc queries
    "adhoc_si_vs_so_limit": lambda s: adhoc.adhoc_si_vs_so_limit(views.v_si_vs_so(_sales_mart(s))),
    "adhoc_cohort_like": lambda s: adhoc.adhoc_cohort_like(
        views.v_innovation_cohort(_innovation_mart(s)), "widget"
    ),
    "adhoc_promo_ranked": lambda s: adhoc.adhoc_promo_ranked(_promotion_effectiveness(s)),
    "adhoc_regional_year": lambda s: adhoc.adhoc_regional_year(
        views.v_regional_performance(_sales_mart(s)), 1998
    ),
    "row_count_audit": _row_count_audit,
    "demand_index": lambda s: demand_columns(
        _innovation_daily(s), "date", "launch_date", s.calendar().agg(F.min("year")).scalar()
    ),
}


def _on_samples(query: Callable[[SampleSources], DataFrame]) -> Query:
    return lambda spark, folder: query(SampleSources(spark, folder))


QUERIES: dict[str, Query] = {name: _on_samples(query) for name, query in _QUERIES.items()}
