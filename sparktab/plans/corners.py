"""Catalogue: the corner cases of other queries, on whole tables: gaps in groups and
features, constant groups, selection as the path of quantiles, categories of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import attribution, charts, prepare, quantile, relate
from sparktab.plans.explaining import TEXT_FEATURES, TEXT_SCORED, _text_model, _texts
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.sources import tables

# A group column with gaps: one of the five types becomes NULL.
GAPPED = "SELECT nullif(event_type, 'view') AS kind, value FROM events"


def _gapped(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.nullif(F.col("event_type"), F.lit("view")).alias("kind"), "value")


def _cuts(q):
    return q.withColumns({f"q{i}": fixed(F.col("q")[i]) for i in range(3)}).drop("q")


def _cuts_sql(group: str, source: str) -> str:
    cuts = ", ".join(f"{fx(f'quantile_cont(value, {p})')} AS q{i}" for i, p in enumerate((0.25, 0.5, 0.75)))
    return f"SELECT {group}'value' AS \"column\", CAST(count(value) AS BIGINT) AS n, {cuts} FROM ({source}) GROUP BY ALL"


@query("quantiles_selected", _cuts_sql("", "SELECT value FROM events"))
def quantiles_selected(spark, sf_dir):
    """Exact quartiles by selection, which is the path of large inputs."""
    return _cuts(quantile.quantiles(table(spark, sf_dir, "events"), ["value"], [0.25, 0.5, 0.75], small_bytes=0))


@query("quantiles_selected_groups", _cuts_sql("kind, ", GAPPED))
def quantiles_selected_groups(spark, sf_dir):
    """The same per group, one of which is NULL."""
    return _cuts(quantile.quantiles(_gapped(spark, sf_dir), ["value"], [0.25, 0.5, 0.75], ["kind"], small_bytes=0))


@query(
    "box_null_group",
    f"""
    WITH g AS ({GAPPED}),
    q AS (SELECT kind, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM g GROUP BY kind)
    SELECT g.kind, CAST(count(value) AS BIGINT) AS n, {fx('any_value(q1)')} AS q1, {fx('any_value(q3)')} AS q3,
           CAST(count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_fliers
    FROM g JOIN q ON g.kind IS NOT DISTINCT FROM q.kind GROUP BY g.kind
    """,
)
def box_null_group(spark, sf_dir):
    """Boxes per group; rows without a group are a group."""
    boxes = charts.box_stats(_gapped(spark, sf_dir), ["value"], ["kind"], small_bytes=0)
    return boxes.select("kind", "n", fixed("q1").alias("q1"), fixed("q3").alias("q3"), "n_fliers")


@query(
    "violin_constant_group",
    f"""
    WITH g AS (SELECT event_type, CASE WHEN event_type = 'view' THEN 7.0 ELSE value END AS value FROM events)
    SELECT event_type, CASE WHEN event_type = 'view' THEN CAST(1 AS BIGINT) ELSE CAST(20 AS BIGINT) END AS n_points,
           CAST(CASE WHEN event_type = 'view' THEN 0 ELSE 20 END AS BIGINT) AS n_on_curve,
           {fx('quantile_cont(value, 0.25)')} AS q1, {fx('quantile_cont(value, 0.5)')} AS median, {fx('quantile_cont(value, 0.75)')} AS q3
    FROM g GROUP BY event_type
    """,
)
def violin_constant_group(spark, sf_dir):
    """A group of equal values has no curve but keeps its quartiles."""
    value = F.when(F.col("event_type") == "view", 7.0).otherwise(F.col("value")).alias("value")
    shape = charts.violin(table(spark, sf_dir, "events").select("event_type", value), ["value"], ["event_type"], points=20)
    return shape.groupBy("event_type").agg(
        F.count("*").alias("n_points"), F.count("density").alias("n_on_curve"), *[fixed(F.first(c)).alias(c) for c in ("q1", "median", "q3")]
    )


@query(
    "hist_heavy_tail",
    """
    WITH v AS (SELECT CASE WHEN o_orderkey % 1000 = 0 THEN o_totalprice * 1000 ELSE o_totalprice END AS value FROM orders),
    e AS (SELECT count(value) AS n, min(value) AS low, max(value) AS high,
                 quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM v),
    b AS (SELECT low, high, ceil((high - low) / least((high - low) / (log2(n) + 1), CAST(2 AS DOUBLE) * iqr * pow(n, CAST(-1 AS DOUBLE) / 3))) AS bins FROM e),
    c AS (SELECT CAST(least(floor((value - low) / ((high - low) / bins)), bins - 1) AS BIGINT) AS bin, count(*) AS n FROM v, b GROUP BY ALL)
    SELECT bin, CAST(n AS BIGINT) AS n FROM c
    """,
)
def hist_heavy_tail(spark, sf_dir):
    """Automatic bins of a column with a long tail, without a limit: the bins with rows."""
    price = F.when(F.col("o_orderkey") % 1000 == 0, F.col("o_totalprice") * 1000).otherwise(F.col("o_totalprice")).alias("value")
    bins = charts.histogram(table(spark, sf_dir, "orders").select(price), ["value"], listed_bins=0)
    return bins.select("bin", "n")


@query(
    "crosstab_customers",
    f"""
    WITH p AS (SELECT o_orderstatus, o_custkey, count(*) AS n FROM orders GROUP BY ALL)
    SELECT o_orderstatus, o_custkey, CAST(n AS BIGINT) AS n, {fx('n * 100.0 / sum(n) OVER (PARTITION BY o_orderstatus)', 9)} AS pct FROM p
    """,
)
def crosstab_customers(spark, sf_dir):
    """A tabulation with as many columns as customers, in long and sparse form."""
    out = relate.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_custkey", listed_levels=16)
    return out.withColumn("pct", fixed("pct", 9))


@query(
    "one_hot_parts",
    """
    WITH c AS (SELECT l_partkey, dense_rank() OVER (ORDER BY l_partkey) - 1 AS code FROM (SELECT DISTINCT l_partkey FROM lineitem)),
    w AS (SELECT CAST(count(*) AS BIGINT) AS width FROM c)
    SELECT l_orderkey, l_linenumber, CAST(code AS BIGINT) AS l_partkey_index, width AS l_partkey_width
    FROM lineitem JOIN c USING (l_partkey), w
    """,
)
def one_hot_parts(spark, sf_dir):
    """Sparse indicators of a category with as many levels as parts."""
    return prepare.one_hot_sparse(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")


@query(
    "label_encode_nulls",
    """
    WITH g AS (SELECT event_id, nullif(user_id, (SELECT min(user_id) FROM events)) AS u FROM events),
    c AS (SELECT u, dense_rank() OVER (ORDER BY u) - 1 AS code FROM (SELECT DISTINCT u FROM g WHERE u IS NOT NULL))
    SELECT event_id, CAST(code AS BIGINT) AS code FROM g LEFT JOIN c USING (u)
    """,
)
def label_encode_nulls(spark, sf_dir):
    """Codes by a join; rows without a level have none."""
    events = table(spark, sf_dir, "events")
    first = events.agg(F.min("user_id")).first()[0]
    rows = events.select("event_id", F.nullif(F.col("user_id"), F.lit(first)).alias("u"))
    return prepare.encode_joined(rows, "u", "code").select("event_id", "code")


@query(
    "score_with_gaps",
    f"""
    WITH {TEXT_SCORED}
    SELECT doc_id, CASE WHEN n_digits = 0 THEN NULL ELSE prediction END AS prediction,
           CASE WHEN n_digits = 0 THEN NULL ELSE {fx('confidence')} END AS confidence,
           CASE WHEN n_digits = 0 THEN 0 ELSE 3 END AS n_factors
    FROM s
    """,
)
def score_with_gaps(spark, sf_dir):
    """A missing feature leaves its row without a prediction and without factors; the others are scored."""
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    gaps = rows.withColumn("n_digits", F.nullif(F.col("n_digits"), F.lit(0)))
    r = F.col("result")
    return attribution.score(gaps, model, ["doc_id"]).select(
        "doc_id", r.prediction.alias("prediction"), fixed(r.confidence).alias("confidence"), F.size(r.top_factors).alias("n_factors")
    )


@query(
    "presented_scores",
    f"""
    WITH {TEXT_SCORED}
    SELECT doc_id, prediction, round_even(confidence, 1) AS confidence, round_even(p1 * 100, 1) AS p_en FROM s
    """,
)
def presented_scores(spark, sf_dir):
    """Scores as people read them: percentages to one digit."""
    rows = _texts(spark, sf_dir)
    r = F.col("result")
    shown = attribution.presented_scores(attribution.score(rows, _text_model(rows), ["doc_id"]))
    return shown.select("doc_id", r.prediction.alias("prediction"), r.confidence.alias("confidence"), r.probabilities["en"].alias("p_en"))


@query(
    "records_in_order",
    f"""
    WITH {TEXT_SCORED}, k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id DESC) AS place FROM s)
    SELECT doc_id, prediction, {fx('confidence')} AS confidence FROM k WHERE place = 1
    """,
)
def records_in_order(spark, sf_dir):
    """Literal records, their keys in any order, put in the trained order and scored: each
    language's longest text, found over the whole table."""
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    fields = F.struct("doc_id", *TEXT_FEATURES)
    longest = rows.groupBy("lang").agg(F.max_by(fields, F.struct("n_chars", "doc_id")).alias("r")).select("r.*")
    some = [dict(reversed(r.asDict().items())) for r in longest.collect()]  # one per language
    kinds = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in sorted(TEXT_FEATURES))
    frame = tables.from_records(spark, some, kinds, ["doc_id", *TEXT_FEATURES])
    r = F.col("result")
    return attribution.score(frame, model, ["doc_id"]).select("doc_id", r.prediction.alias("prediction"), fixed(r.confidence).alias("confidence"))
