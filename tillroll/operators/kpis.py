"""The ten business KPIs over enriched orders, or over a rollup of them.

All but the status distribution read valid sales only. Each is an aggregate
with partial results before the shuffle, so a dominant group (`Unknown` states,
one best seller) costs one row per task. Rankings are whole; `top` cuts one.

The measures are sums of a few facts per order, or quotients of such sums. So
the same KPI comes out of the orders and out of `sales_rollup`, which has the
facts summed up by all the small keys in one scan. That holds for the spread of
order values too: it is a quotient of sums of amounts and of their squares.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.money import cents, exact_part, percent, rest_part, total, two_places
from tillroll.schema import DELIVERED

TOP_K = 10
# Squares of such amounts are exact, and so are the sums of a trillion of them.
EVEN = "decimal(13,4)"


@dataclass(frozen=True)
class Kpi:
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    ranked_by: str | None = None
    sorted_by: tuple[str, ...] = ()

    def order(self, df: DataFrame) -> DataFrame:
        """Largest first with the keys for ties, or by keys, or as it comes."""
        if self.ranked_by:
            return df.orderBy(F.desc(self.ranked_by), *self.keys)
        return df.orderBy(*self.sorted_by) if self.sorted_by else df


# ---- facts: what an order adds to the sums ---------------------------------

# Name -> (column it comes from, its value in one order). Money is decimal, so
# the sums are exact in whatever order and in however many steps they are made;
# the facts named rest hold what no decimal does.
FACTS: dict[str, tuple[str, Callable[[DataFrame], Column]]] = {
    "fact_revenue": ("amount", lambda df: exact_part(F.col("amount"))),
    "fact_revenue_rest": ("amount", lambda df: rest_part(F.col("amount"))),
    "fact_profit": ("profit", lambda df: exact_part(F.col("profit"))),
    "fact_profit_rest": ("profit", lambda df: rest_part(F.col("profit"))),
    "fact_units": ("qty", lambda df: _units_fact(df)),
    "fact_units_rest": ("qty", lambda df: _units_rest(df)),
    "fact_orders": ("order_id", lambda df: F.col("order_id").isNotNull().cast("bigint")),
    "fact_delivered": ("status", lambda df: F.when(_delivered(), 1).otherwise(0).cast("bigint")),
    "fact_rows": ("is_valid_sale", lambda df: F.lit(1).cast("bigint")),
    # For the spread: amounts of at most four decimals, below a billion, and all others.
    "fact_even": ("amount", lambda df: _even()),
    "fact_even_square": ("amount", lambda df: _even() * _even()),
    "fact_even_rows": ("amount", lambda df: _even().isNotNull().cast("bigint")),
    "fact_odd": ("amount", lambda df: _odd()),
    "fact_odd_square": ("amount", lambda df: _odd() * _odd()),
    "fact_odd_rows": ("amount", lambda df: _odd().isNotNull().cast("bigint")),
    "fact_highest": ("amount", lambda df: F.col("amount").cast("double")),
    "fact_lowest": ("amount", lambda df: F.col("amount").cast("double")),
}


def _whole_units(df: DataFrame, name: str = "qty") -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def _units_fact(df: DataFrame) -> Column:
    """Whole units stay integers; fractional ones are summed like money."""
    return F.col("qty").cast("bigint") if _whole_units(df) else exact_part(F.col("qty"))


def _units_rest(df: DataFrame) -> Column:
    return F.lit(None).cast("double") if _whole_units(df) else rest_part(F.col("qty"))


def _even() -> Column:
    return exact_part(F.col("amount"), EVEN)


def _odd() -> Column:
    return F.when(_even().isNull(), F.col("amount").cast("double"))


def _delivered() -> Column:
    return F.col("status").contains(DELIVERED)


def with_facts(df: DataFrame) -> DataFrame:
    """Facts for the columns that `df` has; a rollup has its facts already."""
    if "fact_rows" in df.columns:
        return df
    known = set(df.columns)
    return df.withColumns({n: fact(df) for n, (source, fact) in FACTS.items() if source in known})


def _sum_of(fact: str) -> Column:
    return total(F.col(fact), F.col(f"{fact}_rest"))


def _units(df: DataFrame) -> Column:
    whole = _whole_units(df, "fact_units")
    return F.sum("fact_units") if whole else cents(_sum_of("fact_units"))


def _average(df: DataFrame) -> Column:
    return two_places(_sum_of("fact_revenue") / F.sum("fact_rows"))


def _spread() -> Column:
    """The sample standard deviation from first and second moments.

    The squares are taken around `middle`, the mean to four decimals: their sum
    is Sum x^2 - middle * (2 Sum x - n middle), exact in decimals, so nothing is
    lost where the amounts are large and close together, and the result is the
    same however the sums were made. What is left of the mean beside `middle` is
    small. Amounts that are not even come in as doubles.
    """
    n, others = F.sum("fact_even_rows"), F.sum("fact_odd_rows")
    rows = (n + others).cast("double")
    evens = F.coalesce(F.try_sum("fact_even"), F.lit(0)).try_cast("decimal(23,4)")
    squares = F.coalesce(F.try_sum("fact_even_square").try_cast("decimal(38,8)"), F.lit(0))
    odds = F.coalesce(F.sum("fact_odd"), F.lit(0.0))
    odd_squares = F.coalesce(F.sum("fact_odd_square"), F.lit(0.0))
    middle = F.try_divide(evens.cast("double"), n.cast("double")).try_cast(EVEN)
    middle = F.coalesce(middle, F.lit(0).cast(EVEN))
    twice = (evens * 2 - n.cast("decimal(18,0)") * middle).try_cast("decimal(23,4)")
    around = (squares - middle * twice).cast("double")
    near = middle.cast("double")
    around += odd_squares - near * (odds * 2 - others * near)
    rest = F.try_divide(evens.cast("double") - n * near + odds - others * near, rows)
    variance = F.try_divide(around - rows * rest * rest, rows - 1)
    return F.sqrt(F.when(variance < 0, 0.0).otherwise(variance))


MEASURES: dict[str, Callable[[DataFrame], Column]] = {
    "total_revenue": lambda df: cents(_sum_of("fact_revenue")),
    "total_profit": lambda df: cents(_sum_of("fact_profit")),
    "profit_margin_pct": lambda df: percent(_sum_of("fact_profit"), _sum_of("fact_revenue")),
    "order_count": lambda df: F.sum("fact_orders"),
    "total_units": _units,
    "total_units_sold": _units,
    "avg_order_value": _average,
    "delivery_success_rate": lambda df: percent(F.sum("fact_delivered"), F.sum("fact_rows")),
    "average_order_value": _average,
    "max_order_value": lambda df: two_places(F.max("fact_highest")),
    "min_order_value": lambda df: two_places(F.min("fact_lowest")),
    "std_dev": lambda df: two_places(_spread()),
}

VALID_SALE_KPIS = {
    "monthly_revenue": Kpi(
        ("year", "month", "month_name"),
        ("total_revenue", "order_count", "total_units_sold"),
        sorted_by=("year", "month", "month_name"),
    ),
    "profit_margin": Kpi((), ("total_revenue", "total_profit", "profit_margin_pct")),
    "region_sales": Kpi(
        ("ship_state",),
        ("total_revenue", "order_count", "total_units", "avg_order_value"),
        ranked_by="total_revenue",
    ),
    "aov": Kpi((), ("average_order_value", "max_order_value", "min_order_value", "std_dev")),
    "category_performance": Kpi(
        ("category",),
        ("total_revenue", "order_count", "total_units", "avg_order_value", "total_profit"),
        ranked_by="total_revenue",
    ),
    "fulfillment_performance": Kpi(
        ("fulfilled_by",),
        ("total_revenue", "order_count", "avg_order_value", "delivery_success_rate"),
        ranked_by="total_revenue",
    ),
    "b2b_analysis": Kpi(
        ("b2b",),
        ("total_revenue", "order_count", "avg_order_value", "total_units"),
        ranked_by="total_revenue",
    ),
    "promotion_impact": Kpi(
        ("has_promotion",), ("total_revenue", "order_count", "avg_order_value")
    ),
    "top_products": Kpi(
        ("asin", "category", "style"),
        ("total_revenue", "total_units_sold", "order_count"),
        ranked_by="total_revenue",
    ),
}

STATUS_DISTRIBUTION = Kpi(
    ("status",), ("order_count", "total_amount", "percentage"), ranked_by="order_count"
)


def valid_sales(df: DataFrame) -> DataFrame:
    return df.filter("is_valid_sale")


def kpi_groups(df: DataFrame, name: str) -> DataFrame:
    """One KPI over valid sales, not yet in order."""
    kpi = VALID_SALE_KPIS[name]
    sales = with_facts(valid_sales(df))
    return sales.groupBy(*kpi.keys).agg(*[MEASURES[m](sales).alias(m) for m in kpi.measures])


def _ordered(df: DataFrame, name: str) -> DataFrame:
    return VALID_SALE_KPIS[name].order(kpi_groups(df, name))


def _top(df: DataFrame, name: str, k: int) -> DataFrame:
    return _ordered(df, name).limit(k)


def monthly_revenue(df: DataFrame) -> DataFrame:
    return _ordered(df, "monthly_revenue")


def profit_margin(df: DataFrame) -> DataFrame:
    return _ordered(df, "profit_margin")


def region_sales(df: DataFrame) -> DataFrame:
    return _ordered(df, "region_sales")


def top_states(df: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top(df, "region_sales", k)


def aov(df: DataFrame) -> DataFrame:
    """Average, largest, smallest and spread (sample) of order values."""
    return _ordered(df, "aov")


def category_performance(df: DataFrame) -> DataFrame:
    return _ordered(df, "category_performance")


def fulfillment_performance(df: DataFrame) -> DataFrame:
    return _ordered(df, "fulfillment_performance")


def b2b_analysis(df: DataFrame) -> DataFrame:
    return _ordered(df, "b2b_analysis")


def promotion_impact(df: DataFrame) -> DataFrame:
    return _ordered(df, "promotion_impact")


def top_products(df: DataFrame) -> DataFrame:
    return _ordered(df, "top_products")


def top_products_10(df: DataFrame, k: int = TOP_K) -> DataFrame:
    return _top(df, "top_products", k)


def status_distribution(df: DataFrame) -> DataFrame:
    """All orders by status. Orders without an id count in the percentage only.

    The total is an aggregate of the aggregated rows, one per status, joined back:
    however many different statuses there are, no task sees all of them.
    """
    statuses = (
        with_facts(df)
        .groupBy("status")
        .agg(
            F.sum("fact_orders").alias("order_count"),
            cents(_sum_of("fact_revenue")).alias("total_amount"),
            F.sum("fact_rows").alias("_rows"),
        )
    )
    # One row.
    whole = F.broadcast(statuses.agg(F.sum("_rows").alias("_all")))
    shared = statuses.join(whole, F.col("_all").isNotNull())
    share = percent(F.col("_rows"), F.col("_all"))
    return STATUS_DISTRIBUTION.order(
        shared.withColumn("percentage", share).drop("_rows", "_all")
    )


KPIS = {
    "monthly_revenue": monthly_revenue,
    "profit_margin": profit_margin,
    "region_sales": region_sales,
    "aov": aov,
    "category_performance": category_performance,
    "fulfillment_performance": fulfillment_performance,
    "b2b_analysis": b2b_analysis,
    "promotion_impact": promotion_impact,
    "top_products": top_products,
    "status_distribution": status_distribution,
}


def calculate_kpis(df: DataFrame) -> dict[str, DataFrame]:
    """All ten, unevaluated. `df` should be stored, as each one scans it."""
    return {name: kpi(df) for name, kpi in KPIS.items()}


# ---- several KPIs from one scan --------------------------------------------

# Keys with few values each. Products have many and are left to their own scan.
ROLLUP_KEYS = (
    "year",
    "month",
    "month_name",
    "ship_state",
    "category",
    "fulfilled_by",
    "b2b",
    "has_promotion",
    "status",
    "is_valid_sale",
)
ROLLUP_KPIS = tuple(n for n in KPIS if n != "top_products")


def _summed(orders: DataFrame) -> list[Column]:
    """The facts added up. A decimal sum that is too large moves to the rest."""
    sums = []
    for fact in FACTS:
        if f"{fact}_rest" in FACTS and not (fact == "fact_units" and _whole_units(orders, fact)):
            exact, rest = F.col(fact), F.sum(f"{fact}_rest")
            held = F.try_sum(exact).try_cast("decimal(38,10)")
            lost = F.when(held.isNull(), F.sum(exact.cast("double")))
            both = F.when(lost.isNull(), rest).otherwise(F.coalesce(rest, F.lit(0.0)) + lost)
            sums += [held.alias(fact), both.alias(f"{fact}_rest")]
        elif fact == "fact_units_rest":
            if _whole_units(orders, "fact_units"):
                sums.append(F.lit(None).cast("double").alias(fact))
        elif fact == "fact_highest":
            sums.append(F.max(fact).alias(fact))
        elif fact == "fact_lowest":
            sums.append(F.min(fact).alias(fact))
        elif not fact.endswith("_rest"):
            sums.append(F.try_sum(fact).alias(fact))
    return sums


def sales_rollup(df: DataFrame) -> DataFrame:
    """Facts of all orders by `ROLLUP_KEYS`; the KPIs in `ROLLUP_KPIS` can be taken of it.

    Each order is aggregated once, in its task, for nine KPIs together.
    """
    orders = with_facts(df)
    more = [F.sum("source_rows").alias("source_rows")] if "source_rows" in df.columns else []
    return orders.groupBy(*ROLLUP_KEYS).agg(*_summed(orders), *more)


def as_measures(kpis: dict[str, DataFrame]) -> DataFrame:
    """KPIs as one long frame: (kpi, grp, measure, value), the keys joined with ``|``."""
    longs = []
    for name, df in kpis.items():
        kpi = {**VALID_SALE_KPIS, "status_distribution": STATUS_DISTRIBUTION}[name]
        keys = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in kpi.keys]
        wide = df.select(
            F.lit(name).alias("kpi"),
            F.concat_ws("|", *keys).alias("grp"),
            *[F.col(m).cast("double") for m in kpi.measures],
        )
        longs.append(wide.unpivot(["kpi", "grp"], list(kpi.measures), "measure", "value"))
    return reduce(DataFrame.unionAll, longs)
