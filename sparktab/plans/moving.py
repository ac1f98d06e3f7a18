"""Catalogue: reading, writing, reports and streams.

Streams read the given table file by file from its folder and process what is there;
each has a counterpart over the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import clean, profile, validate
from sparktab.plans.explaining import (
    TEXT_PHI,
    TEXT_SCORED,
    _scored_sql,
    _text_model,
    text_measures,
)
from sparktab.operators.attribution import LinearModel, with_scores
from sparktab.plans.profiling import LINE_KEY
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.session import fresh_path
from sparktab.sources import reports, tables
from sparktab.streaming import flows

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query(
    "scan_rename",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer
    """,
)
def scan_rename(spark, sf_dir):
    """The table as a delimited file: written, read with a schema, renamed by position."""
    path = fresh_path(spark, "customer")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    read = tables.read_delimited(spark, path, CUSTOMER_SCHEMA)
    return tables.rename_all(read, ["id", "name", "nation", "balance", "segment"])


@query(
    "cast_roles",
    """
    SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal, c_mktsegment AS label FROM customer
    """,
)
def cast_roles(spark, sf_dir):
    """Roles from the schema: numbers as double, the last text column as the label."""
    from sparktab.functions.scalar import measure
    from sparktab.spec import infer_spec

    customers = table(spark, sf_dir, "customer")
    spec = infer_spec(customers, keys=["c_custkey"], exclude=["c_name"])
    rows = spec.features_and_label(tables.without_nan(customers))
    return rows.withColumns({c: measure(c) for c in spec.numeric})


@query(
    "scan_inferred",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def scan_inferred(spark, sf_dir):
    """A delimited file whose types are inferred, then cast by name."""
    path = fresh_path(spark, "supplier")
    table(spark, sf_dir, "supplier").write.option("header", True).option("sep", ";").csv(path)
    read = tables.read_delimited(spark, path, sep=";")
    return read.withColumns({"s_suppkey": F.col("s_suppkey").cast("bigint"), "s_acctbal": F.col("s_acctbal").cast("double")})


@query(
    "report_manifest",
    """
    SELECT 'categories' AS report_group, CAST(2 AS BIGINT) AS n_reports,
           CAST((SELECT count(DISTINCT o_orderstatus) + count(DISTINCT o_orderpriority) FROM orders)
                + (SELECT count(DISTINCT c_mktsegment) FROM customer) AS BIGINT) AS n_rows
    UNION ALL SELECT 'quality', CAST(2 AS BIGINT), CAST((SELECT count(*) FROM orders) + 6 AS BIGINT)
    """,
)
def report_manifest(spark, sf_dir):
    """Write four reports, then count reports and rows per group."""
    store = reports.ReportStore(spark, fresh_path(spark, "reports"))
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    fitted = clean.fit_moments(orders, ["o_totalprice"])
    scored = orders.select("o_orderkey", clean.zscore("o_totalprice", fitted["o_totalprice"]).alias("z"))
    saved = [
        store.save("categories", "orders", profile.category_counts(orders, ["o_orderstatus", "o_orderpriority"])),
        store.save("categories", "customers", profile.category_counts(customers, ["c_mktsegment"])),
        store.save("quality", "gaps", profile.null_counts(orders)),
        store.save("quality", "zscores", scored),
    ]
    return store.manifest(saved)


# -------------------------------------------------------------------------- streams


def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return flows.read_table_stream(spark, sf_dir, schema, f"{name}.parquet")


@query(
    "stream_score",
    f"""
    WITH {TEXT_SCORED}, {TEXT_PHI},
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(phi) DESC, feature) AS place
          FROM phi WHERE class = prediction)
    SELECT doc_id, prediction, {fx('confidence')} AS confidence, feature AS top_feature FROM k WHERE place = 1
    """,
)
def stream_score(spark, sf_dir):
    model = _text_model(text_measures(table(spark, sf_dir, "documents")))
    records = text_measures(_stream(spark, sf_dir, "documents"))
    out = fresh_path(spark, "scored")
    flows.write_tables(flows.score_stream(records, model, ["doc_id"]), out, fresh_path(spark, "progress")).awaitTermination()
    r = F.col("result")
    return spark.read.parquet(out).select(
        "doc_id",
        r.prediction.alias("prediction"),
        fixed(r.confidence).alias("confidence"),
        r.top_factors[0].feature.alias("top_feature"),
    )


@query(
    "stream_validate",
    f"""
    SELECT {', '.join(LINE_KEY)}, CASE WHEN l_quantity BETWEEN 5 AND 45 AND l_returnflag IN ('A', 'R')
           THEN 'accepted' ELSE 'rejected' END AS sent_to FROM lineitem
    """,
)
def stream_validate(spark, sf_dir):
    rules = [validate.InRange("l_quantity", 5, 45), validate.OneOf("l_returnflag", ("A", "R"))]
    good, bad = fresh_path(spark, "accepted"), fresh_path(spark, "rejected")
    flows.route_stream(_stream(spark, sf_dir, "lineitem"), rules, good, bad, fresh_path(spark, "progress")).awaitTermination()
    sides = [spark.read.parquet(p).select(*LINE_KEY, F.lit(n).alias("sent_to")) for p, n in ((good, "accepted"), (bad, "rejected"))]
    return sides[0].unionByName(sides[1])


@query(
    "stream_dedup",
    "SELECT DISTINCT user_id, event_type, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour FROM events",
)
def stream_dedup(spark, sf_dir):
    """One record per user, event type and hour. Copies are at most an hour apart, so six hours of
    state are enough; records that come later than that are dropped."""
    events = _stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    hourly = events.withColumn("hour", F.unix_seconds(F.date_trunc("hour", "ts")))
    once = flows.dedup_stream(hourly, ["user_id", "event_type", "hour"], "ts", "6 hours")
    out = fresh_path(spark, "distinct")
    flows.write_tables(once, out, fresh_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select("user_id", "event_type", "hour")


# A model of two measures of an event, for the windowed counts.
EVENT_FEATURES = ("value", "user_id")
EVENT_CLASSES = ("high", "low")
EVENT_WEIGHTS = ((0.06, 0.004), (-0.02, -0.001))
EVENT_INTERCEPTS = (-1.0, 0.5)
EVENT_SCORED = _scored_sql(
    "SELECT ts, user_id, value FROM events", EVENT_FEATURES, EVENT_CLASSES, EVENT_WEIGHTS, EVENT_INTERCEPTS
)


@query(
    "stream_triage",
    f"""
    WITH {EVENT_SCORED}
    SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, prediction, confidence < 70 AS borderline,
           CAST(count(*) AS BIGINT) AS n
    FROM s GROUP BY ALL
    """,
)
def stream_triage(spark, sf_dir):
    """Counts per hour of event time. Each window's latest update is its count. A window is
    closed six hours after its end; records that come later are dropped."""
    means = clean.fit_moments(table(spark, sf_dir, "events"), EVENT_FEATURES)
    model = LinearModel(
        EVENT_FEATURES, EVENT_CLASSES, EVENT_WEIGHTS, EVENT_INTERCEPTS, tuple(means[c].mean for c in EVENT_FEATURES)
    )
    records = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = flows.triage_stream(with_scores(records, model), "ts", "1 hour", "6 hours")
    out = fresh_path(spark, "triage")
    flows.write_batches(counts, out, fresh_path(spark, "progress")).awaitTermination()
    latest = F.max_by("n", "batch").alias("n")
    updates = spark.read.parquet(out).withColumn("window_start", F.unix_seconds("window_start"))
    return updates.groupBy("window_start", "prediction", "borderline").agg(latest)


