"""KPIs that follow a stream of order lines.

A micro-batch's changes (`survivors`) become facts with a sign: those of a line
that came are added to the sums, those of one that went are taken away. Money is
summed as decimals, so what is taken away leaves nothing behind. The sums by the
small keys, by product and by order value are stored after each micro-batch, and
the KPIs are made of these; neither reads the orders that are stored already.

What a batch job over all lines so far gives, these give too. Only amounts that
no decimal holds are summed as doubles, whose last digits depend on the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.enrich import MARGIN, PLATFORM_LABEL, enrich_sales
from tillroll.operators.kpis import FACTS, KPIS, ROLLUP_KEYS, VALID_SALE_KPIS, with_facts
from tillroll.operators.quality import settle
from tillroll.plans.report import summary_report
from tillroll.plans.run import checked, with_period
from tillroll.sinks.tables import write_kpis, write_summary
from tillroll.sinks.versions import publish
from tillroll.sources.orders import read_orders_parquet
from tillroll.staging import delete
from tillroll.streaming.session import batch_folder, finish
from tillroll.streaming.survivors import (
    COPIES,
    ORDER_KEY,
    SIGN,
    batch_survivors,
    survivor_changes,
)

_EXTREMES = ("fact_highest", "fact_lowest")
_SUMS = [f for f in FACTS if f not in _EXTREMES]
# The sums' types, so that they are the same after any number of micro-batches.
_KINDS = {
    "fact_revenue": "decimal(38,10)",
    "fact_profit": "decimal(38,10)",
    "fact_even": "decimal(38,4)",
    "fact_even_square": "decimal(38,8)",
}
_PRODUCT = VALID_SALE_KPIS["top_products"].keys
TABLES = {
    "rollup": ROLLUP_KEYS,
    "products": (*_PRODUCT, "is_valid_sale"),
    "order_values": ("amount", "is_valid_sale"),
}


def _signed(fact: str) -> Column:
    return F.when(F.col(SIGN) == 1, F.col(fact)).when(F.col(SIGN) == -1, -F.col(fact))


def signed_facts(changes: DataFrame) -> DataFrame:
    """Facts of enriched changes with their sign, and for each fact the rows that have it."""
    facts = with_facts(changes)
    counts = {f"n_{f}": F.when(F.col(f).isNotNull(), F.col(SIGN).cast("bigint")) for f in _SUMS}
    sums = {f: _signed(f) for f in _SUMS}
    return facts.withColumns({**counts, **sums, "source_rows": F.col(COPIES)})


def _added_up(facts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Facts, or sums of them, by `keys`. A group without a row left is no group."""

    def total(fact: str) -> Column:
        kind = _KINDS.get(fact)
        return (F.sum(fact).cast(kind) if kind else F.sum(fact)).alias(fact)

    names = [*_SUMS, *[f"n_{f}" for f in _SUMS], "source_rows"]
    summed = facts.groupBy(*keys).agg(*[total(n) for n in names])
    return summed.filter("fact_rows <> 0 OR source_rows <> 0")


def _as_rollup(sums: DataFrame) -> DataFrame:
    """Sums as `kpis.sales_rollup` has them: null where no row has the fact."""
    held = {f: F.when(F.col(f"n_{f}") > 0, F.col(f)) for f in _SUMS if f != "fact_rows"}
    none = {f: F.lit(None).cast("double") for f in _EXTREMES}
    return sums.withColumns({**held, **none}).drop(*[f"n_{f}" for f in _SUMS])


def fold(changes: DataFrame, before: str | None, folder: str) -> None:
    """Stores the sums in `before` with `changes` added to them in `folder`."""
    spark = changes.sparkSession
    facts = signed_facts(changes)
    for name, keys in TABLES.items():
        mine = facts if name == "rollup" else facts.filter("is_valid_sale")
        table = _added_up(mine, keys)
        if before:
            table = _added_up(spark.read.parquet(f"{before}/{name}").unionByName(table), keys)
        table.write.mode("overwrite").parquet(f"{folder}/{name}")


def kpis_of(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The ten KPIs, and the rollup, of the sums in `folder`."""
    rollup, products = (
        _as_rollup(spark.read.parquet(f"{folder}/{n}")) for n in ("rollup", "products")
    )
    # Largest and smallest cannot be taken back from; they are those of the values still there.
    values = spark.read.parquet(f"{folder}/order_values").filter("fact_rows > 0")
    ends = values.agg(F.max("amount").alias("high"), F.min("amount").alias("low")).first()
    whole = rollup.withColumns(
        {f: F.lit(v).cast("double") for f, v in zip(_EXTREMES, (ends.high, ends.low), strict=True)}
    )
    sources = {"aov": whole, "top_products": products}
    return {n: kpi(sources.get(n, rollup)) for n, kpi in KPIS.items()}, rollup


def _sums_folder(store: str, batch_id: int) -> str:
    return f"{store}/sums/{batch_id:09d}"


def stored_orders(spark: SparkSession, store: str) -> DataFrame:
    """The enriched orders that stay, of all changes that `serve_kpis` has stored.

    The line that came last of each order, with `source_rows`, the lines it stands for.
    """
    changes = read_orders_parquet(spark, f"{store}/changes")
    columns = [c for c in changes.columns if c not in (ORDER_KEY, SIGN, COPIES, "stored_batch")]
    line = F.struct(*columns)
    came = F.when(F.col(SIGN) == 1, F.col("stored_batch"))
    last = changes.groupBy(ORDER_KEY).agg(
        F.max_by(line, came).alias("line"), F.sum(COPIES).alias("source_rows")
    )
    return last.select("line.*", "source_rows")


def serve_kpis(
    orders: DataFrame,
    store: str,
    output: str,
    checkpoint: str,
    key: str = "order_id",
    order_by: tuple[str, ...] = (),
    margin: float = MARGIN,
    platform_label: str = PLATFORM_LABEL,
    date: str = "order_date",
    files_per_batch: int = 1000,
) -> None:
    """Follows a stream of order lines with the KPIs, which are published after each micro-batch.

    Two queries run one after the other. The first stores each micro-batch's
    smallest lines; the second takes what has been stored since, and keeps the
    sums. `store` gets lines, changes and sums, `output` the versions of KPIs,
    rollup and summary; `sinks.versions.current` tells the last one. A
    micro-batch that is repeated after a failure overwrites its own folders and
    starts from the same sums. The orders go on in the state, so `checkpoint`
    belongs to `store`.
    """
    lines = checked(with_period(orders, date))
    spark, landed = orders.sparkSession, f"{store}/lines"

    def land(batch: DataFrame, batch_id: int) -> None:
        smallest = batch_survivors(batch, key, order_by)
        smallest.write.mode("overwrite").parquet(batch_folder(landed, batch_id))

    def follow(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = batch_folder(f"{store}/changes", batch_id)
        enrich_sales(settle(batch), margin, platform_label).write.mode("overwrite").parquet(folder)
        sums = _sums_folder(store, batch_id)
        before = _sums_folder(store, batch_id - 1) if batch_id else None
        fold(session.read.parquet(folder), before, sums)
        delete(session, _sums_folder(store, batch_id - 2))

        def write(version: str) -> None:
            kpis, rollup = kpis_of(session, sums)
            write_kpis(kpis, version)
            rollup.write.parquet(f"{version}/sales_rollup")
            write_summary(summary_report(rollup), version)

        publish(session, output, write)

    def drain(stream: DataFrame, mode: str, name: str, sink) -> None:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True)
            .foreachBatch(sink)
            .start()
        )
        finish(query, allow_late=False)

    drain(lines, "append", "land", land)
    schema = batch_survivors(lines, key, order_by).schema
    stored = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    smallest = stored.parquet(f"{landed}/stored_batch=*")
    drain(survivor_changes(smallest), "update", "follow", follow)
