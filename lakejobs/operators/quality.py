"""Expectations, quarantine, profiles and quality reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs import schemas
from lakejobs.functions import classes, clock, text

# Highest accepted share of NULLs and of duplicates, in percent.
LEVELS = {
    "lenient": {"null_percentage": 20.0, "duplicate_percentage": 10.0},
    "strict": {"null_percentage": 5.0, "duplicate_percentage": 2.0},
    "critical": {"null_percentage": 1.0, "duplicate_percentage": 0.1},
}
TABLE_THRESHOLDS = {
    "min_rows": 1, "max_null_percentage": 5.0, "max_duplicate_percentage": 2.0,
}


@dataclass(frozen=True)
class Expectation:
    """A named rule: SQL text, or a function giving a boolean column.

    ``action`` is ``drop`` (failing rows leave) or ``warn`` (they are counted).
    """

    name: str
    rule: str | Callable[[], Column]
    action: str = "drop"

    def condition(self) -> Column:
        return F.expr(self.rule) if isinstance(self.rule, str) else self.rule()

    def holds(self) -> Column:
        """True or false, never unknown."""
        return F.coalesce(self.condition(), F.lit(False))


# Rules of the three silver tables.
SALES_RULES = (
    Expectation("valid_sale_amount", "sale_amount > 0"),
    Expectation("valid_sale_date", "sale_date IS NOT NULL"),
    Expectation("valid_customer_id", "customer_id IS NOT NULL"),
    Expectation("valid_sale_id", "sale_id IS NOT NULL", "warn"),
)
CUSTOMER_RULES = (
    Expectation("valid_customer_id", "customer_id IS NOT NULL"),
    Expectation("valid_email", lambda: text.is_email("email")),
    Expectation("has_contact_info", "email IS NOT NULL OR phone IS NOT NULL", "warn"),
)
PRODUCT_RULES = (
    Expectation("valid_product_id", "product_id IS NOT NULL"),
    Expectation("valid_product_name", "product_name IS NOT NULL"),
    Expectation("valid_price", "price >= 0"),
)

# Filled by the JSON reader for lines it cannot fit to the schema.
SERVICE_COLUMNS = ("_corrupt_record",)

# Reasons a raw sale is rejected for, in the order they are reported.  A missing
# amount is a reason of its own, so that every row is either valid or rejected.
SALES_REJECTS = (
    Expectation("negative_sale_amount", "sale_amount > 0 OR sale_amount IS NULL"),
    Expectation("null_customer_id", "customer_id IS NOT NULL"),
    Expectation("null_sale_amount", "sale_amount IS NOT NULL"),
)


def apply_expectations(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Rows on which every ``drop`` rule is true.

    A filter on the bare condition already loses unknown results, and in this
    form it can be pushed to the scan.
    """
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.condition())
    return df


def _rule_counts(rules: tuple[Expectation, ...]) -> list[Column]:
    counts = [F.count(F.lit(1)).alias("rows")]
    return counts + [F.count_if(r.holds()).alias(r.name) for r in rules]


def expectation_metrics(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Passed and failed rows of every rule, counted in one pass."""
    records = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
            F.col(r.name).alias("passed"), (F.col("rows") - F.col(r.name)).alias("failed"),
        )
        for r in rules
    ])
    return df.agg(*_rule_counts(rules)).select(F.inline(records))


def observe_expectations(
    df: DataFrame, rules: tuple[Expectation, ...], name: str
) -> tuple[DataFrame, Observation]:
    """The kept rows, and counts that fill in while the rows are written."""
    seen = Observation(name)
    return apply_expectations(df.observe(seen, *_rule_counts(rules)), rules), seen


def with_failures(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Add ``failed_rules``: names of the rules the row breaks, in rule order."""
    names = F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules])
    return df.withColumn("failed_rules", F.array_compact(names))


def split_quarantine(
    df: DataFrame, rules: tuple[Expectation, ...], reason: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with all broken rules and the first as reason.

    The two sides are complements: a row with an unknown rule is rejected.
    """
    valid = df
    for rule in rules:
        valid = valid.filter(rule.condition())
    any_failed = reduce(lambda a, b: a | b, [~r.holds() for r in rules], F.lit(False))
    rejected = with_failures(df.filter(any_failed), rules).withColumn(
        "quarantine_reason", F.lit(reason) if reason else F.element_at("failed_rules", 1)
    )
    return valid, rejected


def tagged(
    df: DataFrame, rules: tuple[Expectation, ...], reason: str | None = None
) -> DataFrame:
    """All rows in one pass: ``failed_rules``, and the reason where a row is rejected."""
    first = F.lit(reason) if reason else F.element_at("failed_rules", 1)
    return with_failures(df, rules).withColumn(
        "quarantine_reason", F.when(F.size("failed_rules") > 0, first))


def convention_rules(columns: list[str]) -> tuple[Expectation, ...]:
    """Rules read from column names: ``*_id`` is set, ``*_email`` is an address."""
    rules = []
    for c in columns:
        if c.endswith("_id"):
            rules.append(Expectation(f"{c}_set", lambda c=c: F.col(c).isNotNull()))
        elif c.endswith("_email"):
            rules.append(Expectation(f"{c}_form", lambda c=c: text.is_email(c)))
    return tuple(rules)


# Fixed value: the reason given for rows that break a rule of their column names.
CONVENTION_REASON = "Validation failed"


def convention_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_quarantine(df, convention_rules(df.columns), CONVENTION_REASON)


def convention_tagged(df: DataFrame) -> DataFrame:
    return tagged(df, convention_rules(df.columns), CONVENTION_REASON)


def quarantine_breakdown(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("quarantine_reason").count().orderBy(F.desc("count"))


def quality_rate(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Total, valid and rejected rows and the valid share in percent, in one pass."""
    good = reduce(lambda a, b: a & b, [r.holds() for r in rules], F.lit(True))
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(good).alias("valid_rows")
    )
    return counts.select(
        "total_rows", "valid_rows",
        (F.col("total_rows") - F.col("valid_rows")).alias("rejected_rows"),
        F.round(classes.ratio(F.col("valid_rows") * 100, "total_rows"), 1).alias("quality_rate"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column: (column_name, total_rows, null_count, null_percentage)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    records = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("_rows").alias("total_rows"),
            F.col(c).alias("null_count"),
        )
        for c in df.columns
    ])
    return counts.select(F.inline(records)).withColumn(
        "null_percentage", classes.ratio(F.col("null_count") * 100, "total_rows")
    )


def duplicate_pct(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and duplicate share; NULL keys count as one key.

    Keys are counted per task first, so only distinct keys are shuffled and a
    key with very many rows is one record by then.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    )
    return totals.withColumn(
        "duplicate_percentage",
        classes.ratio((F.col("total_rows") - F.col("distinct_keys")) * 100, "total_rows"),
    )


def freshness(
    df: DataFrame, date_col: str, as_of: str | None = None, max_age_hours: int = 24
) -> DataFrame:
    """Age of the newest row: (latest, age_hours, threshold, passed).

    Dates count from midnight.  An empty input has no age and fails.
    """
    if isinstance(df.schema[date_col].dataType, T.DateType):
        df = df.withColumn(date_col, F.col(date_col).cast("timestamp"))
    now = clock.moment(df, date_col, as_of)
    newest = df.agg(F.max(date_col).alias("latest"))
    age = clock.seconds_between("latest", now).cast("double") / 3600.0
    return newest.select(
        F.col("latest"), age.alias("age_hours"),
        F.lit(float(max_age_hours)).alias("threshold"),
        F.coalesce(age <= max_age_hours, F.lit(False)).alias("passed"),
    )


@dataclass(frozen=True)
class Checks:
    """What to check on a frame: a quality level, key columns and a time column."""

    level: str = "strict"
    keys: tuple[str, ...] = ()
    date_col: str | None = None
    as_of: str | None = None
    max_age_hours: int = 24


# Columns a load checks when they are there.
USUAL_KEY, USUAL_DATE = "id", "created_date"


def usual_checks(columns: list[str], checks: Checks) -> Checks:
    """The checks with the usual key and date column, where none are named and a table has them."""
    keys = checks.keys or ((USUAL_KEY,) if USUAL_KEY in columns else ())
    date_col = checks.date_col or (USUAL_DATE if USUAL_DATE in columns else None)
    return replace(checks, keys=keys, date_col=date_col)


def _signed(schema: T.StructType) -> list[str]:
    """Numeric ``*_amount`` and ``*_price`` columns, which may not be negative."""
    return [
        f.name for f in schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name.endswith(("_amount", "_price"))
    ]


def check_counts(schema: T.StructType, checks: Checks) -> list[Column]:
    """Aggregates behind every check but uniqueness; all fit one pass or one ``observe``."""
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(schema.names)]
    counts += [F.count_if(F.col(c) < 0).alias(f"neg_{i}") for i, c in enumerate(_signed(schema))]
    if checks.date_col in schema.names:
        counts.append(F.max(F.col(checks.date_col).try_cast("timestamp")).alias("latest"))
    return counts


def _record(name: str, column: str | None, value: Column, limit: float, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
        value.cast("double").alias("value"), F.lit(float(limit)).alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def check_report(wide: DataFrame, schema: T.StructType, checks: Checks) -> DataFrame:
    """Report rows from the one-row frame of :func:`check_counts`."""
    limit = LEVELS[checks.level]["null_percentage"]
    records = [_record("not_empty", None, F.col("n"), 1, F.col("n") >= 1)]
    for i, c in enumerate(schema.names):
        pct = classes.ratio(F.col(f"null_{i}") * 100, "n")
        records.append(_record("completeness", c, pct, limit, pct <= limit))
    for i, c in enumerate(_signed(schema)):
        bad = F.col(f"neg_{i}")
        records.append(_record("business_rule", c, bad, 0, bad == 0))
    if "latest" in wide.columns:
        now = clock.moment(wide, "latest", checks.as_of)
        age = clock.seconds_between("latest", now).cast("double") / 3600.0
        hours = checks.max_age_hours
        records.append(_record("freshness", checks.date_col, age, hours, age <= hours))
    return wide.select(F.inline(F.array(*records)))


def uniqueness_report(df: DataFrame, checks: Checks) -> DataFrame:
    """The report row of the key columns."""
    limit = LEVELS[checks.level]["duplicate_percentage"]
    pct = F.col("duplicate_percentage")
    row = _record("uniqueness", ",".join(checks.keys), pct, limit, pct <= limit)
    return duplicate_pct(df, list(checks.keys)).select(F.inline(F.array(row)))


def check(df: DataFrame, checks: Checks) -> DataFrame:
    """The quality report: (check_name, column_name, value, threshold, passed).

    Completeness of every column, sign of amounts and prices, age and emptiness
    come from one aggregate over the input; uniqueness is a second one, because
    it alone needs a shuffle, and then only of the keys.
    """
    report = check_report(df.agg(*check_counts(df.schema, checks)), df.schema, checks)
    if checks.keys:
        report = report.unionByName(uniqueness_report(df, checks))
    return report


class QualityGateError(RuntimeError):
    """Raised before anything is written when a critical load fails its checks."""


def gate(report: DataFrame, level: str) -> list[str]:
    """Failed checks as text; at level ``critical`` they stop the load.

    The report has one row per column, so reading it on the driver is safe.
    """
    failed = report.filter(~F.col("passed")).collect()
    issues = [
        f"{r.check_name} of {r.column_name or 'table'}: {r.value} (limit {r.threshold})"
        for r in failed
    ]
    if issues and level == "critical":
        raise QualityGateError("; ".join(issues))
    return issues


def table_metrics(
    df: DataFrame,
    table_name: str,
    layer: str,
    keys: list[str] | None = None,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Rows, share of NULL cells, time and status of one table; an empty table fails.

    With keys the duplicate share counts as well.  Columns the reader adds for
    its own use are no data and are left out of the share.
    """
    limits = TABLE_THRESHOLDS if thresholds is None else thresholds
    data = [c for c in df.columns if c not in SERVICE_COLUMNS]
    cells = sum((F.col(c).isNull().cast("long") for c in data), F.lit(0).cast("long"))
    counts = [F.count(F.lit(1)).alias("_rows"), F.sum(cells).alias("_nulls")]
    # one pass either way: with keys the counts are taken per key, then summed
    parts = (df.groupBy(*keys) if keys else df.groupBy()).agg(*counts)
    rows = F.coalesce(F.sum("_rows"), F.lit(0))
    row = parts.agg(
        rows.alias("total_rows"), F.sum("_nulls").alias("_nulls"),
        F.count(F.lit(1)).alias("_keys"),
    )
    row = row.withColumn(
        "null_percentage",
        F.coalesce(
            classes.ratio(F.col("_nulls") * 100, F.col("total_rows") * len(data)),
            F.lit(100.0),
        ),
    )
    good = (F.col("total_rows") >= limits["min_rows"]) & (
        F.col("null_percentage") <= limits["max_null_percentage"]
    )
    if keys:
        copies = classes.ratio((F.col("total_rows") - F.col("_keys")) * 100, "total_rows")
        good = good & (copies <= limits["max_duplicate_percentage"])
    return row.select(
        F.lit(table_name).alias("table_name"), F.lit(layer).alias("layer"),
        "total_rows", "null_percentage", F.current_timestamp().alias("check_timestamp"),
        F.when(good, "PASSED").otherwise("FAILED").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def all_table_metrics(
    spark: SparkSession,
    tables: list[tuple[DataFrame | Callable[[], DataFrame], str, str, list[str] | None]],
) -> DataFrame:
    """Metrics of several tables as one frame.

    A table may be given as a function that opens it.  One that cannot be opened has an
    ERROR row with the reason, and the others are measured all the same.
    """
    frames = []
    for source, name, layer, keys in tables:
        try:
            df = source() if callable(source) else source
            frames.append(table_metrics(df, name, layer, keys))
        except PySparkException as error:
            row = (name, layer, 0, 100.0, None, "ERROR", str(error))
            failed = spark.createDataFrame([row], schemas.DATA_QUALITY_METRICS)
            frames.append(failed.withColumn("check_timestamp", F.current_timestamp()))
    empty = spark.createDataFrame([], schemas.DATA_QUALITY_METRICS)
    return reduce(DataFrame.unionByName, frames or [empty])


def schema_frame(df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a frame."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def schema_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Changes between two (column_name, data_type) frames."""
    n, o = new.alias("n"), old.alias("o")
    both = n.join(o, F.col("n.column_name") == F.col("o.column_name"), "full_outer")
    change = (
        F.when(F.col("o.column_name").isNull(), "column_added")
        .when(F.col("n.column_name").isNull(), "column_removed")
        .when(F.col("n.data_type") != F.col("o.data_type"), "type_changed")
    )
    return both.select(
        change.alias("change"),
        F.coalesce("n.column_name", "o.column_name").alias("column_name"),
        F.col("o.data_type").alias("old_type"),
        F.col("n.data_type").alias("new_type"),
    ).filter("change IS NOT NULL")


def json_fields(df: DataFrame, column: str, group: str) -> DataFrame:
    """Fields seen in a JSON text column per group: (group, column_name, data_type).

    Types are those of the values themselves, merged over all rows: numbers to the kind
    that holds them all, and values that have nothing in common to variant.  A field that
    was only ever null is void.  Text that is no JSON object, or names a field twice, has
    no fields.
    """
    named = F.try_variant_get(F.try_parse_json(F.col(column)), "$", "map<string,variant>")
    seen = df.select(F.col(group), F.explode(named).alias("column_name", "_value"))
    kinds = seen.groupBy(group, "column_name").agg(F.schema_of_variant_agg("_value").alias("_type"))
    # names of nested fields keep their case
    nested = F.col("_type").contains("<")
    return kinds.select(
        group, "column_name",
        F.when(nested, F.col("_type")).otherwise(F.lower("_type")).alias("data_type"),
    )
