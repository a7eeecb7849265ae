"""DuckDB SQL for the registered queries, written against the same Parquet tables."""

from __future__ import annotations

# ---- expressions -----------------------------------------------------------


def money_sum(x: str) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(18,6))), 2) AS DOUBLE)"


def two_places(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def money_avg(x: str) -> str:
    return two_places(f"avg(CAST({x} AS DECIMAL(18,4)))")


def percent(part: str, whole: str) -> str:
    return two_places(
        f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100"
    )


# ---- the flat table and its stages -----------------------------------------

LINE_ORDER = (
    "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

UNIQUE_LINES = f"""(
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) = 1
)"""

FLAT_COLUMNS = {
    "order_id": "CASE WHEN NOT (l_linenumber = 7 AND l_tax = 0.06) THEN 'O' || l_orderkey END",
    "status": """CASE WHEN o_orderstatus = 'P' THEN 'Cancelled'
        WHEN l_returnflag = 'A' THEN 'Shipped - Delivered to Buyer'
        WHEN l_returnflag = 'R' THEN 'Shipped' END""",
    "amount": """CASE WHEN l_linenumber = 7 AND l_tax = 0.08 THEN NULL
        WHEN l_linenumber = 7 AND l_tax = 0.07 THEN 0.0::DOUBLE ELSE l_extendedprice END""",
    "qty": """CASE WHEN l_linenumber = 6 AND l_tax = 0.08 THEN 0
        WHEN l_linenumber = 5 AND l_tax = 0.08 THEN NULL ELSE CAST(l_quantity AS INTEGER) END""",
    "fulfilled_by": """CASE WHEN l_linestatus = 'F' THEN 'Platform'
        WHEN l_returnflag <> 'N' THEN 'Merchant' END""",
    "b2b": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'True' ELSE 'False' END",
    "promotion_ids": """CASE WHEN CAST(round(l_discount * 100) AS INTEGER) = 2 THEN ' '
        WHEN l_discount > 0 THEN 'PROMO-' || CAST(round(l_discount * 100) AS INTEGER) END""",
    "ship_city": """CASE c_nationkey % 10 WHEN 0 THEN NULL WHEN 3 THEN '' WHEN 7 THEN '   '
        ELSE 'CITY-' || (c_nationkey % 10) END""",
    "ship_state": "CASE WHEN n_name <> 'NATION_0' THEN n_name END",
    "courier_status": "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END",
    "category": "p_type",
    "style": "p_brand",
    "asin": "'P' || l_partkey",
    "year": "CAST(year(o_orderdate) AS INTEGER)",
    "month": "CAST(month(o_orderdate) AS INTEGER)",
    "month_name": "strftime(o_orderdate, '%b')",
}
EXTRA_COLUMNS = {
    "customer_id": "o_custkey",
    "order_date": "o_orderdate",
    "ship_date": "l_shipdate",
    "amount_text": f"""CASE l_partkey % 20 WHEN 0 THEN 'abc' WHEN 1 THEN '1-2' WHEN 2 THEN ''
        WHEN 3 THEN '   ' WHEN 4 THEN CAST(l_quantity AS INTEGER) || 'e2'
        WHEN 5 THEN 'Rs ' || format('{{:,.2f}}', CAST({PRICE} AS DOUBLE))
        ELSE 'INR ' || CAST({PRICE} AS VARCHAR) END""",
}
NAMES = ", ".join(FLAT_COLUMNS)


def flat(lines: str) -> str:
    columns = ",\n    ".join(f"{x} AS {n}" for n, x in {**FLAT_COLUMNS, **EXTRA_COLUMNS}.items())
    return f"""flat AS (
    SELECT {columns}
    FROM {lines}
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN part ON l_partkey = p_partkey
)"""


FILLED = """filled AS (
    SELECT * REPLACE (
        coalesce(amount, 0.0::DOUBLE) AS amount,
        coalesce(qty, 0) AS qty,
        coalesce(status, 'Unknown') AS status,
        coalesce(courier_status, 'Unknown') AS courier_status,
        coalesce(ship_city, 'Unknown') AS ship_city,
        coalesce(ship_state, 'Unknown') AS ship_state,
        coalesce(promotion_ids, 'No Promotion') AS promotion_ids)
    FROM {source}
)"""

SETTLED = """settled AS (
    SELECT *, coalesce(status <> 'Cancelled' AND amount > 0, false) AS is_valid_sale FROM filled
)"""

ENRICHED = """enriched AS (
    SELECT *,
        amount * 0.7::DOUBLE AS cost,
        amount * 0.3::DOUBLE AS profit,
        30.0::DOUBLE AS profit_margin_pct,
        CASE WHEN qty > 0 THEN amount / qty ELSE amount END AS price_per_item,
        CASE WHEN b2b = 'True' THEN 1 ELSE 0 END AS is_b2b,
        CASE WHEN fulfilled_by = 'Platform' THEN 1 ELSE 0 END AS is_platform_fulfilled,
        CASE WHEN promotion_ids <> 'No Promotion' THEN 1 ELSE 0 END AS has_promotion
    FROM settled
)"""

# All lines; one line per order by line order; one line per order by all columns.
LINES = f"WITH {flat('lineitem')}"
UNIQUE = f"WITH {flat(UNIQUE_LINES)}"
FIRST_BY_ALL = f"""firsts AS (
    SELECT {NAMES} FROM flat
    QUALIFY row_number() OVER (
        PARTITION BY order_id
        ORDER BY {', '.join(f'{n} NULLS FIRST' for n in FLAT_COLUMNS if n != 'order_id')}) = 1
)"""


def stages(start: str, source: str = "flat") -> str:
    return f"{start}, {FILLED.format(source=source)}, {SETTLED}, {ENRICHED}"


ALL_STAGES = stages(UNIQUE) + ", valid AS (SELECT * FROM enriched WHERE is_valid_sale)"
JOB_STAGES = (
    stages(f"{LINES}, {FIRST_BY_ALL}", "firsts")
    + ", valid AS (SELECT * FROM enriched WHERE is_valid_sale)"
)
ENRICHED_NAMES = f"""{NAMES}, is_valid_sale, cost, profit, profit_margin_pct, price_per_item,
    is_b2b, is_platform_fulfilled, has_promotion"""

# ---- KPIs: name -> (keys, measures, rows read) -----------------------------

REVENUE = {"total_revenue": money_sum("amount")}
ORDERS = {"order_count": "count(order_id)"}
UNITS = {"total_units": "CAST(sum(qty) AS BIGINT)"}
UNITS_SOLD = {"total_units_sold": "CAST(sum(qty) AS BIGINT)"}
AVERAGE = {"avg_order_value": money_avg("amount")}
PROFIT = {"total_profit": money_sum("profit")}
MARGIN = {
    "profit_margin_pct": percent(
        "sum(CAST(profit AS DECIMAL(18,4)))", "sum(CAST(amount AS DECIMAL(18,4)))"
    )
}
DELIVERY = {
    "delivery_success_rate": percent("count(*) FILTER (contains(status, 'Delivered'))", "count(*)")
}

KPIS = {
    "monthly_revenue": (
        ("year", "month", "month_name"), {**REVENUE, **ORDERS, **UNITS_SOLD}, "valid"),
    "profit_margin": ((), {**REVENUE, **PROFIT, **MARGIN}, "valid"),
    "region_sales": (("ship_state",), {**REVENUE, **ORDERS, **UNITS, **AVERAGE}, "valid"),
    "aov": (
        (),
        {
            "average_order_value": money_avg("amount"),
            "max_order_value": two_places("max(amount)"),
            "min_order_value": two_places("min(amount)"),
            "std_dev": two_places("stddev_samp(amount)"),
        },
        "valid",
    ),
    "category_performance": (
        ("category",), {**REVENUE, **ORDERS, **UNITS, **AVERAGE, **PROFIT}, "valid"),
    "fulfillment_performance": (
        ("fulfilled_by",), {**REVENUE, **ORDERS, **AVERAGE, **DELIVERY}, "valid"),
    "b2b_analysis": (("b2b",), {**REVENUE, **ORDERS, **AVERAGE, **UNITS}, "valid"),
    "promotion_impact": (("has_promotion",), {**REVENUE, **ORDERS, **AVERAGE}, "valid"),
    "top_products": (
        ("asin", "category", "style"), {**REVENUE, **UNITS_SOLD, **ORDERS}, "valid"),
    "status_distribution": (
        ("status",),
        {
            **ORDERS,
            "total_amount": money_sum("amount"),
            "percentage": percent("count(*)", "(SELECT count(*) FROM enriched)"),
        },
        "enriched",
    ),
}


def kpi_select(name: str) -> str:
    keys, measures, rows = KPIS[name]
    columns = [*keys, *[f"{x} AS {n}" for n, x in measures.items()]]
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT {', '.join(columns)} FROM {rows}{group}"


def kpi_measures(name: str) -> str:
    """One KPI as (kpi, grp, measure, value) rows."""
    keys, measures, _ = KPIS[name]
    parts = [f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys]
    grp = f"concat_ws('|', {', '.join(parts)})" if parts else "''"
    labels = ", ".join(f"'{m}'" for m in measures)
    values = ", ".join(f"CAST({m} AS DOUBLE)" for m in measures)
    return f"""SELECT '{name}' AS kpi, {grp} AS grp,
        unnest([{labels}]) AS measure, unnest([{values}]) AS value
        FROM ({kpi_select(name)})"""


SUMMARY = f"""{stages(UNIQUE)}, totals AS (
    SELECT CAST(count(*) AS DOUBLE) AS orders,
        CAST(count(*) FILTER (is_valid_sale) AS DOUBLE) AS valid FROM enriched)
SELECT 'Total_Orders' AS metric, orders AS value FROM totals
UNION ALL SELECT 'Valid_Sales', valid FROM totals
UNION ALL SELECT 'Cancellation_Rate_Pct', {two_places('(1 - valid / orders) * 100')} FROM totals"""

# ---- data quality ----------------------------------------------------------

TEXT = set(FLAT_COLUMNS) - {"amount", "qty", "year", "month"}


def missing(name: str) -> str:
    blank = f"count(*) FILTER (trim({name}, ' ') = '')" if name in TEXT else "CAST(0 AS BIGINT)"
    null = f"count(*) FILTER ({name} IS NULL)"
    return f"""SELECT '{name}' AS column_name, {null} AS null_count, {blank} AS blank_count,
        {percent(blank, 'count(*)')} AS blank_pct,
        {percent(f'({null} + {blank})', 'count(*)')} AS missing_pct FROM flat"""


# ---- streams: sessions are open until the watermark has passed them ----------

PURCHASES = "purchases AS (SELECT * FROM events WHERE event_type = 'purchase')"
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM purchases)"

SESSIONS = f"""WITH {PURCHASES}, marked AS (
            SELECT *, coalesce(ts - lag(ts) OVER by_user >= INTERVAL 4 HOUR, true) AS opens
            FROM purchases WINDOW by_user AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (
            SELECT *, count(*) FILTER (opens) OVER (PARTITION BY user_id ORDER BY ts) AS run
            FROM marked)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 4 HOUR AS session_end,
            count(*) AS purchases, {money_sum('value')} AS revenue,
            max(ts) + INTERVAL 4 HOUR > {CLOSED} AS is_open
        FROM numbered GROUP BY user_id, run"""

PERCENTILES = f"""{ALL_STAGES}, shares AS (
        SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.99])::DOUBLE AS share),
    placed AS (
        SELECT amount, row_number() OVER (ORDER BY amount) AS place,
            count(*) OVER () AS orders FROM valid)"""

ORACLES = {
    "ingest_profile": f"""{LINES}
        SELECT count(*) AS row_count, {len(FLAT_COLUMNS)} AS column_count FROM flat""",
    "missing_profile": f"{LINES} " + " UNION ALL ".join(missing(n) for n in FLAT_COLUMNS),
    "dedup_orders": f"{UNIQUE} SELECT {NAMES} FROM flat",
    "dedup_report": f"""{LINES}, ids AS (SELECT DISTINCT order_id FROM flat)
        SELECT (SELECT count(*) FROM flat) AS row_count, (SELECT count(*) FROM ids) AS order_rows,
            (SELECT count(*) FROM flat) - (SELECT count(*) FROM ids) AS duplicates_removed""",
    "filled_sales": f"{UNIQUE}, {FILLED.format(source='flat')} SELECT {NAMES} FROM filled",
    "normalise_amount": f"""{LINES}
        SELECT order_id, asin, amount_text,
            CASE WHEN trim(amount_text, ' ') = '' THEN NULL
                WHEN regexp_full_match(amount_text, '[0-9]+e[0-9]+')
                    THEN CAST(amount_text AS DOUBLE)
                ELSE TRY_CAST(regexp_replace(amount_text, '[^0-9.-]', '', 'g') AS DOUBLE)
            END AS amount
        FROM flat""",
    "clean_sales": f"""{LINES}, {FIRST_BY_ALL}, {FILLED.format(source='firsts')}, {SETTLED}
        SELECT {NAMES}, is_valid_sale FROM settled""",
    "valid_sales": f"{ALL_STAGES} SELECT {NAMES}, is_valid_sale FROM valid",
    "enriched_sales": f"{stages(UNIQUE)} SELECT {ENRICHED_NAMES} FROM enriched",
    **{name: f"{ALL_STAGES} {kpi_select(name)}" for name in KPIS},
    "top_states": f"""{ALL_STAGES} {kpi_select('region_sales')}
        ORDER BY total_revenue DESC, ship_state LIMIT 10""",
    "top_products_10": f"""{ALL_STAGES} {kpi_select('top_products')}
        ORDER BY total_revenue DESC, asin, category, style LIMIT 10""",
    "summary_report": SUMMARY,
    "summary_roundtrip": SUMMARY,
    "csv_roundtrip": f"""{LINES}
        SELECT * REPLACE (CAST(qty AS DOUBLE) AS qty) FROM (SELECT {NAMES} FROM flat)""",
    "enriched_parquet_roundtrip": f"{stages(UNIQUE)} SELECT {ENRICHED_NAMES} FROM enriched",
    "kpi_parquet_roundtrip": f"{JOB_STAGES} " + " UNION ALL ".join(kpi_measures(n) for n in KPIS),
    "external_table_query": f"{stages(UNIQUE)} SELECT {ENRICHED_NAMES} FROM enriched",
    "managed_table_roundtrip": f"{stages(UNIQUE)} SELECT {ENRICHED_NAMES} FROM enriched",
    "json_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "stream_json_ingest": f"{LINES} SELECT {NAMES} FROM flat",
    "stream_ingest_parquet": f"{stages(LINES)} SELECT {ENRICHED_NAMES} FROM enriched",
    "stream_kpis": f"{JOB_STAGES} " + " UNION ALL ".join(kpi_measures(n) for n in KPIS),
    "stream_daily_revenue": f"""WITH {PURCHASES}
        SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS purchases,
            {money_sum('value')} AS revenue
        FROM purchases GROUP BY 1""",
    "stream_dedup": f"WITH {PURCHASES} SELECT event_id, ts, user_id, value FROM purchases",
    "stream_sliding_revenue": f"""WITH {PURCHASES}, starts AS (
            SELECT unnest(generate_series(
                (SELECT date_trunc('day', min(ts)) - INTERVAL 1 DAY FROM purchases),
                (SELECT max(ts) FROM purchases), INTERVAL 2 HOUR)) AS window_start)
        SELECT window_start::TIMESTAMP AS window_start,
            (window_start + INTERVAL 6 HOUR)::TIMESTAMP AS window_end,
            count(*) AS purchases, {money_sum('value')} AS revenue
        FROM starts JOIN purchases ON ts >= window_start AND ts < window_start + INTERVAL 6 HOUR
        GROUP BY window_start""",
    "stream_sessions": SESSIONS,
    "stream_late_sessions": SESSIONS,
    "period_columns": f"{UNIQUE} SELECT order_id, order_date, year, month, month_name FROM flat",
    "distinct_buyers_by_month": f"""{ALL_STAGES}
        SELECT year, month, count(DISTINCT customer_id) AS buyers
        FROM valid GROUP BY year, month""",
    "ship_lag": f"""{ALL_STAGES}
        SELECT year, month, count(*) AS orders,
            {two_places("avg(date_diff('day', order_date, ship_date))")} AS avg_ship_days
        FROM valid GROUP BY year, month""",
    "aov_percentiles": f"""{PERCENTILES}
        SELECT share, min(amount) AS amount FROM shares, placed
        WHERE place >= share * orders GROUP BY share""",
    # On the tables of the driver's scale the sketches hold every value, so they are exact there.
    "approximate_aov_percentiles": f"""{PERCENTILES}
        SELECT share, min(amount) AS amount, true AS within_bound FROM shares, placed
        WHERE place >= share * orders GROUP BY share""",
    "buyers_by_period": f"""{ALL_STAGES}
        SELECT year, month, count(DISTINCT customer_id) AS buyers,
            count(DISTINCT customer_id) AS estimate, 0.0::DOUBLE AS error_pct
        FROM valid GROUP BY ROLLUP (year, month)""",
    "append_new_orders": f"{LINES}, {FIRST_BY_ALL} SELECT * FROM firsts WHERE order_id IS NOT NULL",
    "top_products_per_category": f"""{ALL_STAGES}, products AS ({kpi_select('top_products')}),
        ranked AS (
            SELECT category, row_number() OVER (
                PARTITION BY category ORDER BY total_revenue DESC, asin, style) AS place,
                asin, style, total_revenue FROM products)
        SELECT category, CAST(place AS INTEGER) AS place, asin, style, total_revenue
        FROM ranked WHERE place <= 10""",
    "revenue_mom_growth": f"""{ALL_STAGES}, months AS ({kpi_select('monthly_revenue')}),
        steps AS (
            SELECT year, month, total_revenue,
                lag(total_revenue) OVER (ORDER BY year, month) AS previous_revenue FROM months)
        SELECT *, {percent('(total_revenue - previous_revenue)', 'previous_revenue')} AS growth_pct
        FROM steps""",
}
