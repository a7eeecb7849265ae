"""Column names, types and default values of the order table.

Inside the package columns are snake_case. Files written for others carry the
column headers of the published order extract, so `canonical` and `headed`
rename at the edges. Columns that are not listed here pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Headers of the order extract, by internal name.
INPUT_HEADERS = {
    "order_id": "Order ID",
    "amount": "Amount",
    "qty": "Qty",
    "status": "Status",
    "courier_status": "Courier Status",
    "ship_city": "ship-city",
    "ship_state": "ship-state",
    "promotion_ids": "promotion-ids",
    "b2b": "B2B",
    "fulfilled_by": "fulfilled-by",
    "category": "Category",
    "asin": "ASIN",
    "style": "Style",
    "year": "Year",
    "month": "Month",
    "month_name": "MonthName",
}

# Headers of derived columns and of KPI measures.
DERIVED_HEADERS = {
    "source_rows": "Source_Rows",
    "is_valid_sale": "Is_Valid_Sale",
    "cost": "Cost",
    "profit": "Profit",
    "profit_margin_pct": "Profit_Margin_Pct",
    "price_per_item": "Price_Per_Item",
    "is_b2b": "Is_B2B",
    "is_platform_fulfilled": "Is_Platform_Fulfilled",
    "has_promotion": "Has_Promotion",
    "total_revenue": "Total_Revenue",
    "total_profit": "Total_Profit",
    "total_units": "Total_Units",
    "total_units_sold": "Total_Units_Sold",
    "total_amount": "Total_Amount",
    "order_count": "Order_Count",
    "avg_order_value": "Avg_Order_Value",
    "average_order_value": "Average_Order_Value",
    "max_order_value": "Max_Order_Value",
    "min_order_value": "Min_Order_Value",
    "std_dev": "Std_Dev",
    "delivery_success_rate": "Delivery_Success_Rate",
    "percentage": "Percentage",
    "metric": "Metric",
    "value": "Value",
}

# What a missing cell is replaced with.
FILL_DEFAULTS = {
    "amount": 0.0,
    "qty": 0,
    "status": "Unknown",
    "courier_status": "Unknown",
    "ship_city": "Unknown",
    "ship_state": "Unknown",
    "promotion_ids": "No Promotion",
}

CANCELLED = "Cancelled"
DELIVERED = "Delivered"
NO_PROMOTION = FILL_DEFAULTS["promotion_ids"]

# Text cells that hold numbers; cleaned after the defaults are filled in.
NUMERIC_TEXT = ("amount", "qty")


def canonical(df: DataFrame) -> DataFrame:
    """Extract headers to internal names."""
    headers = {**INPUT_HEADERS, **DERIVED_HEADERS}
    return df.withColumnsRenamed({header: name for name, header in headers.items()})


def headed(df: DataFrame) -> DataFrame:
    """Internal names to the headers that readers of the output expect."""
    return df.withColumnsRenamed({**INPUT_HEADERS, **DERIVED_HEADERS})
