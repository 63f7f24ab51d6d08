"""Queries: classification, tags, value scan, quality records."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators import governance
from lakejobs.registry.case import case
from lakejobs.sources import star_tables as star

_CLASSIFIED = """
    WITH cols AS (
        SELECT concat('table_', user_id) AS table_name, lower(
            ['event_id', 'contact_email', 'Phone_Number', 'ssn', 'billing_address', 'amount',
             'account_number', 'routing_number', 'monthly_revenue', 'api_key', 'diagnosis_code',
             'created_date', 'password_hash', 'region', 'status', 'quantity'][(user_id + event_id % 4) % 16 + 1]
        ) AS c FROM events),
    counted AS (
        SELECT table_name,
            CAST(max(CAST(contains(c, 'email') AS INT)) + max(CAST(contains(c, 'phone') AS INT))
              + max(CAST(contains(c, 'ssn') AS INT)) + max(CAST(contains(c, 'credit_card') AS INT))
              + max(CAST(contains(c, 'address') AS INT)) AS BIGINT) AS pii_matches,
            CAST(max(CAST(contains(c, 'medical_record') AS INT))
              + max(CAST(contains(c, 'diagnosis') AS INT))
              + max(CAST(contains(c, 'treatment') AS INT))
              + max(CAST(contains(c, 'patient_id') AS INT)) AS BIGINT) AS phi_matches,
            CAST(max(CAST(contains(c, 'account_number') AS INT))
              + max(CAST(contains(c, 'routing_number') AS INT))
              + max(CAST(contains(c, 'salary') AS INT))
              + max(CAST(contains(c, 'revenue') AS INT)) AS BIGINT) AS financial_matches,
            CAST(max(CAST(contains(c, 'api_key') AS INT))
              + max(CAST(contains(c, 'password') AS INT))
              + max(CAST(contains(c, 'secret') AS INT))
              + max(CAST(contains(c, 'private_key') AS INT)) AS BIGINT) AS confidential_matches
        FROM cols GROUP BY 1),
    classified AS (
        SELECT *, CASE WHEN phi_matches >= 1 THEN 'PHI' WHEN pii_matches >= 2 THEN 'PII'
                       WHEN financial_matches >= 2 THEN 'FINANCIAL'
                       WHEN confidential_matches >= 1 THEN 'CONFIDENTIAL' END AS classification
        FROM counted)
    """


def _classified(spark, d):
    return governance.classify(star.catalog_columns(spark, d))


@case("gov_classify_tables", _CLASSIFIED + "SELECT * FROM classified")
def _(spark, d):
    return _classified(spark, d)


@case("gov_classification_tags", _CLASSIFIED + """
    SELECT table_name, classification,
        'auto_classified=true;classification_date=2024-01-31;compliance_required='
        || CASE WHEN classification IN ('PHI', 'PII') THEN 'true' ELSE 'false' END
        || ';data_classification=' || classification
        || CASE classification WHEN 'PHI' THEN ';encryption_required=true' ELSE '' END
        || CASE classification WHEN 'CONFIDENTIAL' THEN ''
             WHEN 'FINANCIAL' THEN ';retention_policy=10_YEARS'
             ELSE ';retention_policy=7_YEARS' END AS tags,
        CASE classification WHEN 'PII' THEN 'anonymization_required=true'
             WHEN 'FINANCIAL' THEN 'audit_required=true' ELSE '' END AS handling
    FROM classified WHERE classification IS NOT NULL""")
def _(spark, d):
    tagged = governance.classification_tags(_classified(spark, d), "2024-01-31")
    pairs = tagged.select(
        "table_name", "classification", F.array_sort(F.map_entries("tags")).alias("entries")
    )

    def joined(keep):
        return F.array_join(F.transform(
            F.filter("entries", keep), lambda e: F.concat_ws("=", e["key"], e["value"])
        ), ";")

    special = ["anonymization_required", "audit_required"]
    return pairs.select(
        "table_name", "classification",
        joined(lambda e: ~e["key"].isin(special)).alias("tags"),
        joined(lambda e: e["key"].isin(special)).alias("handling"),
    )


@case("gov_classification_summary", _CLASSIFIED + """
    SELECT k.classification, CAST(count(c.table_name) OVER (PARTITION BY k.classification)
           AS BIGINT) AS table_count, c.table_name
    FROM (VALUES ('PHI'), ('PII'), ('FINANCIAL'), ('CONFIDENTIAL')) AS k(classification)
    LEFT JOIN classified c ON k.classification = c.classification""")
def _(spark, d):
    return governance.classification_summary(_classified(spark, d))


@case("gov_pii_value_scan", r"""
    WITH vals AS (
        SELECT 'documents' AS table_name, 'text' AS column_name, text AS v FROM documents
        UNION ALL SELECT 'conversations', 'text', text FROM conversations
        UNION ALL SELECT 'pages', 'url', url FROM pages
        UNION ALL SELECT 'pages', 'html', html FROM pages),
    rules AS (SELECT * FROM (VALUES
        ('email', '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'),
        ('ssn', '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b'),
        ('phone', '\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b'),
        ('credit_card', '\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b'),
        ('ip_address', '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS r(pattern, rx))
    SELECT table_name, column_name, pattern, count(v) AS value_count,
           count(*) FILTER (regexp_matches(v, rx)) AS match_count,
           CAST(count(*) FILTER (regexp_matches(v, rx)) * 100 AS DOUBLE) / count(v)
             AS match_percentage,
           CAST(count(*) FILTER (regexp_matches(v, rx)) * 100 AS DOUBLE) / count(v) > 1.0
             AS flagged
    FROM vals, rules GROUP BY ALL""")
def _(spark, d):
    return governance.pii_value_scan({
        "documents": (star.table(spark, d, "documents"), ["text"]),
        "conversations": (star.table(spark, d, "conversations"), ["text"]),
        "pages": (star.table(spark, d, "pages"), ["url", "html"]),
    }, min_share=1.0)


@case("gov_pii_valid_values", r"""
    WITH vals AS (
        -- planted: numbers that only look valid, and valid ones
        SELECT text || ' ' || CASE doc_id % 6
                   WHEN 0 THEN '900-12-3456' WHEN 1 THEN '123-45-6789'
                   WHEN 2 THEN '10.0.300.' || (doc_id % 256) WHEN 3 THEN '10.0.30.' || (doc_id % 256)
                   WHEN 4 THEN '4111-1111-1111-1111' ELSE '4111 1111 1111 1112' END AS v
        FROM documents),
    found AS (
        SELECT regexp_extract_all(v, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b') AS ssn,
               regexp_extract_all(v, '\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b') AS card,
               regexp_extract_all(v, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b') AS ip
        FROM vals WHERE v IS NOT NULL),
    judged AS (
        SELECT len(ssn) AS s, len(list_filter(ssn, lambda x: left(x, 3) NOT IN ('000', '666')
                   AND left(x, 3) < '900' AND substr(x, 5, 2) <> '00' AND substr(x, 8) <> '0000')) AS s_ok,
               len(card) AS c, len(list_filter(card, lambda x: list_sum(list_transform(range(1, 17),
                   lambda i: CASE WHEN i % 2 = 0 THEN CAST(translate(x, '- ', '')[i] AS INT)
                       WHEN CAST(translate(x, '- ', '')[i] AS INT) > 4
                       THEN CAST(translate(x, '- ', '')[i] AS INT) * 2 - 9
                       ELSE CAST(translate(x, '- ', '')[i] AS INT) * 2 END)) % 10 = 0)) AS c_ok,
               len(ip) AS p, len(list_filter(ip, lambda x: list_max(list_transform(
                   string_split(x, '.'), lambda y: CAST(y AS INT))) <= 255)) AS p_ok
        FROM found)
    SELECT 'documents' AS table_name, 'text' AS column_name, pattern, count(*) AS value_count,
           count(*) FILTER (n > 0) AS match_count, count(*) FILTER (ok > 0) AS valid_count,
           CAST(coalesce(sum(ok), 0) AS BIGINT) AS valid_matches
    FROM (SELECT 'ssn' AS pattern, s AS n, s_ok AS ok FROM judged
          UNION ALL SELECT 'credit_card', c, c_ok FROM judged
          UNION ALL SELECT 'ip_address', p, p_ok FROM judged)
    GROUP BY pattern""")
def _(spark, d):
    planted = star.table(spark, d, "documents").selectExpr("""text || ' ' || case doc_id % 6
        when 0 then '900-12-3456' when 1 then '123-45-6789'
        when 2 then '10.0.300.' || (doc_id % 256) when 3 then '10.0.30.' || (doc_id % 256)
        when 4 then '4111-1111-1111-1111' else '4111 1111 1111 1112' end as text""")
    return governance.valid_values(planted, "documents", ["text"])


@case("gov_outliers", """
    WITH fences AS (
        SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
        FROM events GROUP BY 1)
    SELECT e.event_type, count(*) AS row_count, count(*) - count(value) AS null_count,
           count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
             AS outlier_count
    FROM events e JOIN fences USING (event_type) GROUP BY 1""")
def _(spark, d):
    return governance.outlier_counts(star.table(spark, d, "events"), "event_type", "value")


@case("gov_quality_metrics", """
    WITH base AS (SELECT event_id, user_id, event_type,
                         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value FROM events),
    fences AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM base),
    counts AS (
        SELECT count(*) AS n, count(*) - count(value) AS nulls,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM base))
                 AS dups,
               count(*) FILTER (value < (SELECT q1 - 1.5 * (q3 - q1) FROM fences)
                             OR value > (SELECT q3 + 1.5 * (q3 - q1) FROM fences)) AS outs
        FROM base)
    SELECT 'events' AS table_name, r.name AS quality_check_name,
           CASE WHEN r.bad = 0 THEN 'PASSED' ELSE 'FAILED' END AS check_result,
           CAST(100 AS DOUBLE) - CAST(r.bad * 100 AS DOUBLE) / r.cells AS quality_score,
           n AS row_count, CASE WHEN r.name = 'completeness' THEN r.bad ELSE 0 END AS null_count,
           CASE WHEN r.name = 'uniqueness' THEN r.bad ELSE 0 END AS duplicate_count,
           CASE WHEN r.name = 'outliers:value' THEN r.bad ELSE 0 END AS outlier_count
    FROM counts, LATERAL (VALUES ('completeness', nulls, n * 4), ('uniqueness', dups, n),
                                 ('outliers:value', outs, n)) AS r(name, bad, cells)""")
def _(spark, d):
    base = star.table(spark, d, "events").selectExpr(
        "event_id", "user_id", "event_type",
        "case when event_id % 17 = 0 then null else value end as value",
    )
    records = governance.quality_metric_records(
        base, "events", ["user_id", "event_type"], "value", star.EVENTS_AS_OF
    )
    return records.drop("check_timestamp", "created_at", "remediation_action")
