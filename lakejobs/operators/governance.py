"""Classification, tags, value scans and governance records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs import schemas
from lakejobs.functions import classes, clock
from lakejobs.operators import quality, tables
from lakejobs.operators.quantiles import exact_quantiles

# Column-name patterns of each class, the number of patterns that
# must match, and the order in which classes win.
CLASS_PATTERNS = {
    "PII": ("email", "phone", "ssn", "credit_card", "address"),
    "PHI": ("medical_record", "diagnosis", "treatment", "patient_id"),
    "FINANCIAL": ("account_number", "routing_number", "salary", "revenue"),
    "CONFIDENTIAL": ("api_key", "password", "secret", "private_key"),
}
CLASS_MINIMUM = {"PHI": 1, "PII": 2, "FINANCIAL": 2, "CONFIDENTIAL": 1}
CLASS_ORDER = ("PHI", "PII", "FINANCIAL", "CONFIDENTIAL")

# Tags set per class.
CLASS_TAGS = {
    "PHI": {"compliance_required": "true", "retention_policy": "7_YEARS",
            "encryption_required": "true"},
    "PII": {"compliance_required": "true", "retention_policy": "7_YEARS",
            "anonymization_required": "true"},
    "FINANCIAL": {"compliance_required": "false", "retention_policy": "10_YEARS",
                  "audit_required": "true"},
    "CONFIDENTIAL": {"compliance_required": "false"},
}

# What personal data looks like inside text values.
VALUE_PATTERNS = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "phone": r"\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
    "credit_card": r"\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}

# A character every match of a pattern contains; values without it are skipped cheaply.
VALUE_MARKERS = {"email": "@", "ssn": "-", "ip_address": "."}


def catalog_frame(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) of given frames."""
    rows = [(name, c) for name, df in tables.items() for c in df.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def classify(
    columns: DataFrame, patterns: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Class of every table from its column names; NULL when none applies.

    A pattern counts once per table, however many columns contain it.  The
    rules become expressions of one aggregate, so no join is needed.
    """
    rules = CLASS_PATTERNS if patterns is None else patterns
    name = F.lower("column_name")
    seen = [
        F.bool_or(F.contains(name, F.lit(p))).cast("int").alias(f"{kind}:{p}")
        for kind, words in rules.items() for p in words
    ]
    tables = columns.groupBy("table_name").agg(*seen)
    hits = {
        kind: reduce(lambda a, b: a + b, [F.col(f"`{kind}:{p}`") for p in words])
        for kind, words in rules.items()
    }
    chosen = reduce(
        lambda chain, kind: chain.when(hits[kind] >= CLASS_MINIMUM[kind], kind),
        [k for k in CLASS_ORDER if k in hits], F,
    )
    return tables.select(
        "table_name", *[hits[k].cast("long").alias(f"{k.lower()}_matches") for k in rules],
        chosen.alias("classification"),
    )


def classification_tags(classified: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Tables with a class and their tag map."""
    when = clock.day(as_of).cast("string")
    tags = reduce(
        lambda chain, kind: chain.when(
            F.col("classification") == kind,
            F.create_map(
                F.lit("data_classification"), F.lit(kind), F.lit("auto_classified"),
                F.lit("true"), F.lit("classification_date"), when,
                *[F.lit(x) for kv in CLASS_TAGS[kind].items() for x in kv],
            ),
        ),
        CLASS_ORDER, F,
    )
    return classified.filter("classification IS NOT NULL").select(
        "table_name", "classification", tags.alias("tags")
    )


def classification_summary(classified: DataFrame) -> DataFrame:
    """Every class with its number of tables and one row per table.

    One row per table instead of a list per class: a class may hold any number
    of tables.  A class without tables keeps one row with a NULL table.
    """
    spark = classified.sparkSession
    kinds = spark.createDataFrame([(k,) for k in CLASS_ORDER], "classification string")
    tables = classified.filter("classification IS NOT NULL").select(
        "classification", "table_name"
    )
    counts = tables.groupBy("classification").agg(F.count(F.lit(1)).alias("n"))
    # one row per class
    totals = kinds.join(counts, "classification", "left").select(
        "classification", F.coalesce("n", F.lit(0)).alias("table_count")
    )
    listed = tables.join(F.broadcast(totals), "classification")
    empty = totals.filter("table_count = 0").withColumn(
        "table_name", F.lit(None).cast("string")
    )
    return listed.unionByName(empty).select("classification", "table_count", "table_name")


def pii_value_scan(
    tables: dict[str, tuple[DataFrame, list[str]]],
    patterns: dict[str, str] | None = None,
    min_share: float = 0.0,
) -> DataFrame:
    """Share of values in text columns that contain each pattern.

    One pass per table over whole values; ``flagged`` marks shares above
    ``min_share`` percent.
    """
    rules = VALUE_PATTERNS if patterns is None else patterns

    def found(column: str, name: str, pattern: str) -> Column:
        match = F.col(column).rlike(pattern)
        marker = VALUE_MARKERS.get(name) if patterns is None else None
        return F.contains(F.col(column), F.lit(marker)) & match if marker else match

    frames = []
    for name, (df, columns) in tables.items():
        hits = df.agg(
            *[F.count(F.col(c)).alias(f"{c}:rows") for c in columns],
            *[F.count_if(found(c, p, rx)).alias(f"{c}:{p}")
              for c in columns for p, rx in rules.items()],
        )
        records = F.array(*[
            F.struct(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit(p).alias("pattern"), F.col(f"`{c}:rows`").alias("value_count"),
                F.col(f"`{c}:{p}`").alias("match_count"),
            )
            for c in columns for p in rules
        ])
        frames.append(hits.select(F.inline(records)))
    share = classes.ratio(F.col("match_count") * 100, "value_count")
    return reduce(DataFrame.unionByName, frames).withColumns({
        "match_percentage": share,
        "flagged": F.coalesce(share > min_share, F.lit(False)),
    })


def _luhn(number: Column) -> Column:
    """Whether 16 digits have the check digit of a card number."""
    digits = F.translate(number, "- ", "")
    at = [F.substring(digits, i + 1, 1).cast("int") for i in range(16)]
    doubled = [d * 2 - F.when(d > 4, 9).otherwise(0) if i % 2 == 0 else d
               for i, d in enumerate(at)]
    return reduce(lambda a, b: a + b, doubled) % 10 == 0


def _ssn(number: Column) -> Column:
    """Area, group and serial that are given out."""
    area = F.substring(number, 1, 3)
    return (~area.isin("000", "666") & (area < "900") & (F.substring(number, 5, 2) != "00")
            & (F.substring(number, 8, 4) != "0000"))


def _ipv4(address: Column) -> Column:
    return F.forall(F.split(address, "[.]"), lambda part: part.cast("int") <= 255)


# What a match of a pattern has to satisfy besides its form.
VALID = {"ssn": _ssn, "credit_card": _luhn, "ip_address": _ipv4}


def valid_values(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Values of text columns with a match of each pattern, and with a valid one.

    Numbers that only look like one are told apart: card numbers by their check digit, social
    security numbers and addresses by their ranges. All columns and patterns take one pass."""
    def matches(column: str, kind: str) -> Column:
        return F.regexp_extract_all(F.col(column), F.lit(VALUE_PATTERNS[kind]), F.lit(0))

    found = df.select(*[
        F.filter(matches(c, kind), valid).alias(f"{c}:{kind}:valid")
        for c in columns for kind, valid in VALID.items()
    ], *[
        F.size(matches(c, kind)).alias(f"{c}:{kind}") for c in columns for kind in VALID
    ], *[F.col(c).isNotNull().alias(f"{c}:set") for c in columns])
    cells = []
    for c in columns:
        for kind in VALID:
            good = F.when(F.col(f"`{c}:set`"), F.size(F.col(f"`{c}:{kind}:valid`")))
            cells.append(F.struct(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit(kind).alias("pattern"), F.count_if(f"`{c}:set`").alias("value_count"),
                F.count_if(F.col(f"`{c}:set`") & (F.col(f"`{c}:{kind}`") > 0)).alias("match_count"),
                F.count_if(good > 0).alias("valid_count"),
                F.coalesce(F.sum(good), F.lit(0)).cast("long").alias("valid_matches")))
    return found.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


def outlier_fences(
    df: DataFrame, group: str, value: str, spread: float = 1.5
) -> DataFrame:
    """(g, low, high): Q1 - spread * IQR and Q3 + spread * IQR of every group."""
    q1, q3 = F.element_at("q", 1), F.element_at("q", 2)
    # Equal quartiles have no spread, infinite ones included.
    reach = F.when(q1 == q3, F.lit(0.0)).otherwise((q3 - q1) * spread)
    return exact_quantiles(df, group, value, (0.25, 0.75)).select(
        "g", (q1 - reach).alias("low"), (q3 + reach).alias("high"))


def outlier_counts(df: DataFrame, group: str, value: str, spread: float = 1.5) -> DataFrame:
    """Rows and values outside the fences of their group."""
    fences = outlier_fences(df, group, value, spread).toDF("_kind", "_low", "_high")
    v = F.col("_v")
    rows = df.select(F.col(group), F.col(group).cast("string").alias("_g"),
                     F.col(value).cast("double").alias("_v"))
    outside = (v < F.col("_low")) | (v > F.col("_high"))
    return rows.join(fences, F.col("_g") == F.col("_kind"), "left").groupBy(group).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(v.isNull()).alias("null_count"),
        F.count_if(F.coalesce(outside, F.lit(False))).alias("outlier_count"),
    )


def quality_metric_records(
    df: DataFrame, table_name: str, keys: list[str], value: str, as_of: str | None = None
) -> DataFrame:
    """Quality-log rows of one table: completeness, uniqueness and outliers."""
    nulls = reduce(
        lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns]
    )
    # One group for all rows; as it is no constant to the planner, joins on it stay equi-joins.
    nothing = F.substring(F.col(value).cast("string"), 1, 0)
    one = df.withColumn("_all", F.concat_ws("", F.lit(table_name), nothing))
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_count"))
    dups = quality.duplicate_pct(df, keys).select(
        (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_count"),
        F.col("total_rows").alias("row_count"),
    )
    outliers = outlier_counts(one, "_all", value).select("row_count", "outlier_count")

    def record(frame: DataFrame, name: str, bad: str, cells: Column) -> DataFrame:
        score = F.lit(100.0) - classes.ratio(F.col(bad) * 100, cells)
        kinds = ("null_count", "duplicate_count", "outlier_count")
        return frame.select(
            F.lit(table_name).alias("table_name"), F.lit(name).alias("quality_check_name"),
            F.when(F.col(bad) == 0, "PASSED").otherwise("FAILED").alias("check_result"),
            score.alias("quality_score"), "row_count",
            *[F.col(k) if k == bad else F.lit(0).cast("long").alias(k) for k in kinds],
        )

    rows = F.col("row_count")
    report = (
        record(counts, "completeness", "null_count", rows * len(df.columns))
        .unionByName(record(dups, "uniqueness", "duplicate_count", rows))
        .unionByName(record(outliers, f"outliers:{value}", "outlier_count", rows))
    )
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return report.withColumns({
        "check_timestamp": stamp,
        "remediation_action": F.lit(None).cast("string"),
        "created_at": stamp,
    }).select(*schemas.QUALITY_METRICS.names)


def lineage_record(
    spark: SparkSession, source: str, target: str, kind: str, flow: str,
    mapping: dict[str, str], user: str, score: float, record_id: str, when,
) -> DataFrame:
    """One lineage row; ``mapping`` goes from target column to source column."""
    row = (record_id, source, target, kind, flow, when, user, mapping, score, when)
    cells = dict(zip(schemas.DATA_LINEAGE.names, row, strict=True))
    return tables.few_rows(spark, [cells], schemas.DATA_LINEAGE)


def access_by_day(audit: DataFrame) -> DataFrame:
    """Audit rows with the date column the audit table is partitioned by."""
    return audit.withColumn("access_date", F.col("access_timestamp").cast("date"))
