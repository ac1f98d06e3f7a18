"""Catalogue: cleaning, profiling, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import clean, profile, validate
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.session import settled
from sparktab.spec import infer_spec

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "clean_profile",
    f"""
    WITH d AS (SELECT DISTINCT text, lang, source, n_chars FROM documents),
    s AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS sd FROM d),
    k AS (SELECT d.* FROM d, s WHERE abs((d.n_chars - s.m) / s.sd) < 3)
    SELECT lang, CAST(count(*) AS BIGINT) AS n_rows, {fx('avg(n_chars)')} AS mean_n_chars
    FROM k GROUP BY lang
    """,
)
def clean_profile(spark, sf_dir):
    """Drop the key, drop repeats, drop outliers, then average by category."""
    docs = table(spark, sf_dir, "documents")
    spec = infer_spec(docs, keys=["doc_id"], target="lang")
    rows = settled(clean.distinct_rows(docs, spec.keys, keep=["lang", *spec.outlier_columns]))
    kept = clean.zscore_filter(rows, spec.outlier_columns)
    return kept.groupBy("lang").agg(
        F.count("*").alias("n_rows"),
        *[fixed(F.avg(c)).alias(f"mean_{c}") for c in spec.outlier_columns],
    )


# ----------------------------------------------------------------- shapes and gaps


def _orders_with_gaps(spark, sf_dir):
    """Orders with one status and one priority turned into gaps."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        "o_totalprice",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )


GAPPY = """
    g AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
                 nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)
"""
GAPPY_COLUMNS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "null_profile",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
        f"CAST(count(*) AS BIGINT) AS n_rows FROM g"
        for c in GAPPY_COLUMNS
    ),
)
def null_profile(spark, sf_dir):
    return profile.null_counts(_orders_with_gaps(spark, sf_dir))


@query(
    "table_info",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS position, '{t}' AS type, "
        f"CAST(count({c}) AS BIGINT) AS n_present FROM g"
        for i, (c, t) in enumerate(zip(GAPPY_COLUMNS, ("bigint", "string", "double", "string")))
    ),
)
def table_info(spark, sf_dir):
    return profile.table_info(_orders_with_gaps(spark, sf_dir))


@query(
    "dup_count",
    """
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_distinct,
           CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates
    FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)
    """,
)
def dup_count(spark, sf_dir):
    return clean.duplicate_count(table(spark, sf_dir, "documents"), ["doc_id"])


@query("dedup_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedup_rows(spark, sf_dir):
    return clean.distinct_rows(table(spark, sf_dir, "documents"), ["doc_id"])


@query(
    "dedup_keep_first",
    """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)
    """,
)
def dedup_keep_first(spark, sf_dir):
    """One document per distinct text."""
    docs = table(spark, sf_dir, "documents")
    return clean.keep_first(docs, ["doc_id"], ["text"]).select("doc_id", "lang", "n_chars")


@query(
    "shape_by_step",
    """
    WITH d AS (SELECT DISTINCT text, lang, source, n_chars FROM documents)
    SELECT 'as read' AS step, CAST(count(*) AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM documents
    UNION ALL SELECT 'key dropped', CAST(count(*) AS BIGINT), CAST(4 AS BIGINT) FROM documents
    UNION ALL SELECT 'repeats dropped', CAST(count(*) AS BIGINT), CAST(4 AS BIGINT) FROM d
    """,
)
def shape_by_step(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    body = docs.drop("doc_id")
    counts = clean.duplicate_count(body)
    last = counts.select(
        F.lit("repeats dropped").alias("step"),
        F.col("n_distinct").alias("n_rows"),
        F.lit(len(body.columns)).cast("bigint").alias("n_columns"),
    )
    return (
        clean.table_shape(docs, "as read")
        .unionByName(clean.table_shape(body, "key dropped"))
        .unionByName(last)
    )


# --------------------------------------------------------- summaries and frequencies


@query(
    "numeric_summary",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, {fx(f'avg({c})', 3)} AS mean,
               {fx(f'stddev_samp({c})', 3)} AS std, min({c}) AS min,
               {fx(f'quantile_cont({c}, 0.25)')} AS q25, {fx(f'quantile_cont({c}, 0.5)')} AS q50,
               {fx(f'quantile_cont({c}, 0.75)')} AS q75, max({c}) AS max
        FROM lineitem"""
        for c in MEASURES
    ),
)
def numeric_summary(spark, sf_dir):
    out = profile.summary(table(spark, sf_dir, "lineitem"), MEASURES)
    for name, digits in (("mean", 3), ("std", 3), ("q25", 6), ("q50", 6), ("q75", 6)):
        out = out.withColumn(name, fixed(name, digits))
    return out


CATEGORIES = ("o_orderstatus", "o_orderpriority")


@query(
    "category_freq",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, CAST(count(*) AS BIGINT) AS n "
        f"FROM g WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORIES
    ),
)
def category_freq(spark, sf_dir):
    return profile.by_frequency(profile.category_counts(_orders_with_gaps(spark, sf_dir), CATEGORIES))


@query(
    "category_share",
    f"WITH {GAPPY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, CAST(count(*) AS BIGINT) AS n, "
        f"{fx('count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER ()')} AS pct "
        f"FROM g WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORIES
    ),
)
def category_share(spark, sf_dir):
    shares = profile.category_shares(_orders_with_gaps(spark, sf_dir), CATEGORIES)
    return shares.withColumn("pct", fixed("pct"))


# ------------------------------------------------------------------------- outliers

FENCES = """
    q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
    f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS low,
                 q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS high FROM q)
"""


@query(
    "iqr_report",
    f"""
    WITH {FENCES}
    SELECT 'value' AS "column", CAST(count(value) AS BIGINT) AS n, {fx('any_value(q1)')} AS q1,
           {fx('any_value(q3)')} AS q3, {fx('any_value(iqr)')} AS iqr, {fx('any_value(low)')} AS low,
           {fx('any_value(high)')} AS high,
           CAST(count(*) FILTER (value < low OR value > high) AS BIGINT) AS n_outside
    FROM events, f
    """,
)
def iqr_report(spark, sf_dir):
    out = clean.fence_report(table(spark, sf_dir, "events"), ["value"])
    for name in ("q1", "q3", "iqr", "low", "high"):
        out = out.withColumn(name, fixed(name))
    return out


@query(
    "iqr_rows",
    f"WITH {FENCES} SELECT event_id, event_type, value FROM events, f WHERE value < low OR value > high",
)
def iqr_rows(spark, sf_dir):
    """The rows a fence would flag."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    flagged = clean.beyond_fences(clean.fit_fences(events, ["value"]))
    return events.where(flagged["value"])


@query(
    "zscore_rows",
    f"""
    WITH s AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS sd FROM documents)
    SELECT doc_id, {fx('(n_chars - m) / sd')} AS z_n_chars FROM documents, s
    """,
)
def zscore_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    fitted = clean.fit_moments(docs, ["n_chars"])
    return docs.select("doc_id", fixed(clean.zscore("n_chars", fitted["n_chars"])).alias("z_n_chars"))


LINE_Z = (
    "s AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in MEASURES)
    + " FROM lineitem)"
)
LINE_KEEP = " AND ".join(f"abs(({c} - m_{c}) / d_{c}) < CAST(1.7 AS DOUBLE)" for c in MEASURES)


@query(
    "zscore_filter",
    f"WITH {LINE_Z} SELECT {', '.join(LINE_KEY)}, l_returnflag FROM lineitem, s WHERE {LINE_KEEP}",
)
def zscore_filter(spark, sf_dir):
    """Uniform measures have no value three deviations out, so the limit here is 1.7."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag", *MEASURES)
    return clean.zscore_filter(lines, MEASURES, limit=1.7).drop(*MEASURES)


@query(
    "step_audit",
    f"""
    WITH s AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS sd FROM documents),
    k AS (SELECT abs((n_chars - m) / sd) < 3 AS keep FROM documents, s)
    SELECT 'zscore n_chars' AS step, CAST(count(*) AS BIGINT) AS rows_before,
           CAST(count(*) FILTER (keep) AS BIGINT) AS rows_after,
           CAST(count(*) FILTER (NOT keep) AS BIGINT) AS rows_removed,
           {fx('count(*) FILTER (NOT keep) * CAST(100.0 AS DOUBLE) / count(*)')} AS pct_removed
    FROM k
    """,
)
def step_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("n_chars")
    keep = clean.within_deviations(clean.fit_moments(docs, ["n_chars"]))
    return clean.step_audit(docs, keep, "zscore n_chars").withColumn("pct_removed", fixed("pct_removed"))


# ----------------------------------------------------------------------- validation

LINE_RULES = [
    validate.InRange("l_quantity", 5, 45),
    validate.InRange("l_discount", 0.0, 0.08),
    validate.OneOf("l_returnflag", ("A", "R")),
    validate.InRange("l_absent", 0, 1),
]


@query(
    "range_violations",
    f"""
    WITH v AS (
        SELECT {', '.join(LINE_KEY)},
               CASE WHEN l_quantity BETWEEN 5 AND 45 THEN '' ELSE 'l_quantity:range;' END
               || CASE WHEN l_discount BETWEEN 0 AND CAST(0.08 AS DOUBLE) THEN '' ELSE 'l_discount:range;' END
               || CASE WHEN l_returnflag IN ('A', 'R') THEN '' ELSE 'l_returnflag:allowed;' END AS violations
        FROM lineitem)
    SELECT * FROM v WHERE violations <> ''
    """,
)
def range_violations(spark, sf_dir):
    """Rejected rows with the broken rules; the rule on an absent column is skipped."""
    lines = table(spark, sf_dir, "lineitem")
    checked = validate.rejected(validate.with_violations(lines, LINE_RULES))
    joined = F.concat(F.array_join("violations", ";"), F.lit(";"))
    return checked.select(*LINE_KEY, joined.alias("violations"))


@query(
    "range_rule_counts",
    """
    SELECT 'c_acctbal:range' AS rule, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (NOT coalesce(c_acctbal BETWEEN 0 AND 9000, false)) AS BIGINT) AS n_violations
    FROM customer
    UNION ALL
    SELECT 'c_mktsegment:allowed', CAST(count(*) AS BIGINT),
           CAST(count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')) AS BIGINT)
    FROM customer
    """,
)
def range_rule_counts(spark, sf_dir):
    rules = [
        validate.InRange("c_acctbal", 0, 9000),
        validate.OneOf("c_mktsegment", ("BUILDING", "MACHINERY", "HOUSEHOLD")),
    ]
    return validate.rule_counts(table(spark, sf_dir, "customer"), rules)
