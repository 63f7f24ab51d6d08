"""Gold tables over growing silver sales: a run reads the new sales and the state of the last.

Two things are kept. Pairs of customer and product with their measures give the totals of
both, and their distinct counts. Sums and sets by day, category and segment give the
analytics; a sale whose customer or product is not known yet waits among the pending ones,
counts without its attribute meanwhile, and is settled by the run that knows both.

State is written per run, and the run is in the log once all of it lies there: a run that dies is
done over from the state before it. The older state is deleted then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions import classes
from lakejobs.operators import gold, partials, tables
from lakejobs.paths import LakePaths
from lakejobs.plans.together import together
from lakejobs.session import path_exists, remove

FACTS = ["sale_id", "sale_date", "customer_id", "product_id", "sale_amount"]
GROUP = ["sale_date", "category_standardized", "customer_segment"]
PAIR = ["customer_id", "product_id"]
SIZES = {"customer_id": "unique_customers", "product_id": "unique_products"}
_RUNS = T.StructType([T.StructField("run", T.LongType()), T.StructField("until", T.LongType())])


def refresh(
    spark: SparkSession, lake: LakePaths, sales_after: Callable[[int | None], DataFrame],
    until: int, customers: DataFrame, products: DataFrame, as_of: str | Column | None = None,
    high: float = 1000, medium: float = 500,
) -> dict[str, DataFrame]:
    """The gold tables up to the epoch ``until``; ``sales_after`` gives the sales behind one."""
    log = lake.table("_state", "gold_runs")
    last = None
    if path_exists(spark, log):
        last = spark.read.schema(_RUNS).parquet(log).orderBy(F.desc("run")).first()
    run = last.run + 1 if last else 0

    def at(name: str, number: int) -> str:
        return f"{lake.table('_state', name)}/run-{number}"

    def before(name: str) -> list[DataFrame]:
        return [spark.read.parquet(at(name, last.run))] if last else []

    new = sales_after(last.until if last else None).select(FACTS)
    waiting = [df.select(FACTS) for df in before("pending")]
    facts = known = new
    for df in waiting:
        known = known.unionByName(df)
    marked = (
        known.join(customers.select("customer_id", "customer_segment", F.lit(True).alias("_c")),
                   "customer_id", "left")
        .join(products.select("product_id", "category_standardized", F.lit(True).alias("_p")),
              "product_id", "left")
        .withColumn("settled", (F.col("customer_id").isNull() | F.col("_c").isNotNull())
                    & (F.col("product_id").isNull() | F.col("_p").isNotNull()))
        .drop("_c", "_p")
    )
    # Written whole, so the joins run once for the settled and the pending sales.
    marked.write.mode("overwrite").parquet(at("marked", run))
    marked = spark.read.parquet(at("marked", run))
    settled = marked.filter("settled").drop("settled")
    state = {
        "sums": partials.merged_sums([partials.sums(settled, GROUP), *before("sums")], GROUP),
        "sets": partials.merged_sets(
            [partials.values(settled, GROUP, list(SIZES)), *before("sets")]),
        "pairs": packed(partials.added_sums(
            facts, [unpacked(df) for df in before("pairs")], PAIR)),
        "pending": marked.filter("NOT settled").drop("settled"),
    }
    # Sets and pairs shuffle about as much as the sales: one behind the other takes half the disk.
    for names in (("sums", "pending"), ("sets",), ("pairs",)):
        if names == ("pairs",):  # read from the sales
            remove(spark, [at("marked", run)])
        together(*[partial(state[name].write.mode("overwrite").parquet, at(name, run))
                   for name in names])
    tables.few_rows(spark, [{"run": run, "until": until}], _RUNS).write.mode("append").parquet(log)
    remove(spark, [at(name, last.run) for name in state if last])
    pending = spark.read.parquet(at("pending", run))
    pairs = unpacked(spark.read.parquet(at("pairs", run)))
    return {
        "sales_analytics": analytics(
            spark.read.parquet(at("sums", run)), spark.read.parquet(at("sets", run)), pending),
        "customer_360": gold.with_purchases(customers, purchases(pairs), high, medium),
        "product_performance": gold.with_performance(products, performance(pairs), as_of),
    }


def analytics(sums: DataFrame, sets: DataFrame, pending: DataFrame) -> DataFrame:
    """The groups of settled and pending sales.

    A pending sale lacks its category or its segment, so it shares values only with sets that
    lack one.  The other sets hold each value once and are counted as they lie."""
    groups = partials.merged_sums([sums, partials.sums(pending, GROUP)], GROUP)
    lacking = F.col("category_standardized").isNull() | F.col("customer_segment").isNull()
    shared = partials.merged_sets(
        [sets.filter(lacking), partials.values(pending, GROUP, list(SIZES))])
    values = sets.filter(~lacking).unionByName(shared)
    sized = partials.with_sizes(
        groups, partials.set_sizes(values, GROUP, SIZES), GROUP, list(SIZES.values()))
    return sized.select(
        *GROUP, F.col("n").alias("transaction_count"), F.col("total").alias("total_sales"),
        classes.ratio("total", "amounts").alias("avg_transaction_value"),
        F.col("low").alias("min_transaction_value"), F.col("high").alias("max_transaction_value"),
        *SIZES.values(),
    ).transform(gold.with_analytics_ratios)


def packed(pairs: DataFrame) -> DataFrame:
    """Pairs without what another measure tells: most are of one sale, whose amount and day would
    lie there three times and twice.  A NULL in ``low``, ``high`` or ``last`` stands for the same
    value as in ``total``, ``low`` or ``first``."""
    told = {"low": "total", "high": "low", "last": "first"}
    return pairs.withColumns({
        name: F.when(~F.col(name).eqNullSafe(F.col(like)), F.col(name))
        for name, like in told.items()})


def unpacked(pairs: DataFrame) -> DataFrame:
    """The pairs that :func:`packed` was given; pairs that lie there in full stay as they are."""
    kinds = {f.name: f.dataType for f in pairs.schema.fields}
    low = F.coalesce("low", F.col("total").cast(kinds["low"]))
    return pairs.withColumns({
        "low": low, "high": F.coalesce(F.col("high"), low), "last": F.coalesce("last", "first")})


def _of(pairs: DataFrame, key: str, other: str) -> DataFrame:
    """Measures of one side of the pairs, and how many of the other it met."""
    kinds = {f.name: f.dataType for f in pairs.schema.fields}
    return pairs.groupBy(key).agg(
        *[how(name).cast(kinds[name]).alias(name) for name, how in partials.MERGES.items()],
        F.count(other).alias("met"))


def purchases(pairs: DataFrame) -> DataFrame:
    return _of(pairs, "customer_id", "product_id").select(
        "customer_id", F.col("n").alias("total_transactions"),
        F.col("total").alias("lifetime_value"),
        classes.ratio("total", "amounts").alias("avg_order_value"),
        F.col("first").alias("first_purchase_date"), F.col("last").alias("last_purchase_date"),
        F.col("met").alias("unique_products_purchased"))


def performance(pairs: DataFrame) -> DataFrame:
    return _of(pairs, "product_id", "customer_id").select(
        "product_id", F.col("n").alias("total_sales_count"),
        F.col("total").alias("total_revenue"),
        classes.ratio("total", "amounts").alias("avg_sale_price"),
        F.col("met").alias("unique_customers"), F.col("first").alias("first_sale_date"),
        F.col("last").alias("last_sale_date"))
