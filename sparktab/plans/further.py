"""Catalogue: hashed neighbours, wide correlations, calibration, repeats over a stream's history."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparktab.operators import attribution, calibrate, gradient, gram, landmarks, neighbours, prepare
from sparktab.plans.explaining import TEXT_CLASSES, TEXT_FEATURES, TEXT_INTERCEPTS, TEXT_SOURCE, TEXT_WEIGHTS, _scored_sql, _text_model, _texts
from sparktab.plans.modelling import KNN, _vectors
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.session import fresh_path, settled
from sparktab.streaming import history


@query(
    "knn_lsh",
    f"WITH {KNN} SELECT asked AS vec_id, CAST(count(*) AS BIGINT) AS n_neighbours, true AS in_order, true AS distances_right, true AS recall_reached FROM k WHERE place <= 5 GROUP BY asked",
)
def knn_lsh(spark, sf_dir):
    """Five neighbours of each test vector through hashed planes: their distances computed anew, and the
    share of the exact neighbours found, which must be 0.9 or more."""
    train, test = _vectors(spark, sf_dir)
    found = settled(neighbours.nearest_by_planes(train, test, "vec_id", "embedding", "label"))
    exact = neighbours.nearest(train, test, "vec_id", "embedding", "label").select("asked", "neighbour")
    counts = exact.join(found.select("asked", "neighbour", F.lit(1).alias("hit")), ["asked", "neighbour"], "left").agg(F.count("*").alias("n"), F.count("hit").alias("hits")).first()
    recall = counts["hits"] / max(counts["n"], 1)
    x = lambda df, key, out: df.select(F.col("vec_id").alias(key), F.col("embedding").cast("array<double>").alias(out))
    both = found.join(x(test, "asked", "a"), "asked").join(x(train, "neighbour", "b"), "neighbour")
    d2 = F.aggregate(F.zip_with("a", "b", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    rows = both.select(F.col("asked").alias("vec_id"), "place", "distance2", (F.abs(d2 - F.col("distance2")) < 1e-9 * (1 + d2)).alias("right"))
    listed = F.array_sort(F.collect_list(F.struct("place", "distance2")))
    checked = rows.groupBy("vec_id").agg(F.count("*").alias("n_neighbours"), listed.alias("all"), F.min("right").alias("distances_right"))
    in_order = (F.col("all.distance2") == F.array_sort("all.distance2")) & (F.col("all.place") == F.sequence(F.lit(1), F.size("all")))
    return checked.select("vec_id", "n_neighbours", in_order.alias("in_order"), "distances_right", F.lit(recall >= 0.9).alias("recall_reached"))


# 200 columns of 64 numbers: the numbers, their squares, products of neighbours (missing where negative), differences.
WIDE = [f"e{i}" for i in range(64)] + [f"s{i}" for i in range(64)] + [f"p{i}" for i in range(63)] + [f"d{i}" for i in range(9)]
WIDE_SQL = ", ".join(
    [f"v[{i + 1}] AS e{i}" for i in range(64)]
    + [f"v[{i + 1}] * v[{i + 1}] AS s{i}" for i in range(64)]
    + [f"CASE WHEN v[{i + 1}] * v[{i + 2}] >= 0 THEN v[{i + 1}] * v[{i + 2}] END AS p{i}" for i in range(63)]
    + [f"v[{i + 1}] - v[{i + 10}] AS d{i}" for i in range(9)]
)


@query(
    "corr_wide",
    f"""
    WITH w AS (SELECT vec_id, {WIDE_SQL} FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)),
    l AS (UNPIVOT w ON COLUMNS(* EXCLUDE vec_id) INTO NAME c VALUE x),
    n AS (SELECT unnest({WIDE}) AS c, unnest(range({len(WIDE)})) AS i)
    SELECT a.c AS a, b.c AS b, CAST(count(*) AS BIGINT) AS n, {fx('corr(a.x, b.x)')} AS r
    FROM l a JOIN n na ON na.c = a.c JOIN l b ON a.vec_id = b.vec_id JOIN n nb ON nb.c = b.c WHERE na.i < nb.i GROUP BY a.c, b.c
    """,
)
def corr_wide(spark, sf_dir):
    """All 19,900 pairs of 200 columns, pairwise complete, from one scan."""
    v = F.col("v")
    at = lambda i: F.get(v, F.lit(i))
    columns = [at(i).alias(f"e{i}") for i in range(64)] + [(at(i) * at(i)).alias(f"s{i}") for i in range(64)]
    columns += [F.when(at(i) * at(i + 1) >= 0, at(i) * at(i + 1)).alias(f"p{i}") for i in range(63)] + [(at(i) - at(i + 9)).alias(f"d{i}") for i in range(9)]
    rows = table(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("v")).select(*columns)
    return gram.wide_correlations(rows, WIDE).select("a", "b", "n", fixed("r").alias("r"))


STEPS = 1000
ENGLISH = TEXT_CLASSES.index("en")
CALIBRATED = f"""
    WITH {_scored_sql(TEXT_SOURCE, TEXT_FEATURES, TEXT_CLASSES, TEXT_WEIGHTS, TEXT_INTERCEPTS)},
    r AS (SELECT p{ENGLISH} AS score, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS hit, CAST(floor(p{ENGLISH} * {STEPS} + 0.5) AS INTEGER) AS level FROM s),
    l AS (SELECT level, count(*) AS n, sum(hit) AS h FROM r GROUP BY level),
    m AS (SELECT a.level AS a, b.level AS b, sum(b.h) OVER w / CAST(sum(b.n) OVER w AS DOUBLE) AS mean FROM l a JOIN l b ON b.level >= a.level
          WINDOW w AS (PARTITION BY a.level ORDER BY b.level)),
    u AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM m),
    i AS (SELECT b AS level, max(least) AS value FROM u GROUP BY b),
    t AS (SELECT 'raw' AS kind, score, hit FROM r UNION ALL SELECT 'calibrated', value, hit FROM r JOIN i USING (level))
    SELECT kind, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, {fx('avg(score)')} AS mean_score, {fx('avg(hit)')} AS share
    FROM t GROUP BY ALL
"""


@query("calibration_bins", CALIBRATED)
def calibration_bins(spark, sf_dir):
    """How often documents are English, by tenths of the model's score and of its isotonic fit."""
    rows = _texts(spark, sf_dir)
    scored = attribution.with_scores(rows, _text_model(rows)).select(F.get("probability", F.lit(ENGLISH)).alias("score"), (F.col("lang") == "en").alias("hit"))
    scored = settled(scored)
    fitted = calibrate.fit_isotonic(scored, F.col("score"), F.col("hit"), STEPS)
    both = [calibrate.reliability(scored, s, F.col("hit")).select(F.lit(k).alias("kind"), "*") for k, s in (("raw", F.col("score")), ("calibrated", fitted.apply(F.col("score"))))]
    return both[0].unionByName(both[1]).select("kind", "bin", "n", fixed("mean_score").alias("mean_score"), fixed("share").alias("share"))


@query("stream_dedup_all", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_all(spark, sf_dir):
    """One record per user and event type of all events, which arrive in eight batches in no order of time."""
    source = fresh_path(spark, "arrivals")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    events.repartition(8, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = fresh_path(spark, "first-seen")
    history.first_seen(stream, ["user_id", "event_type"], out, fresh_path(spark, "seen"), fresh_path(spark, "progress"), snapshot_every=3).awaitTermination()
    return history.kept(spark, out, ["user_id", "event_type"])


SCALED = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS x{i}" for i, f in enumerate(TEXT_FEATURES))
SQUARES = " + ".join(f"(x{i} - lead(x{i}) OVER w) ** 2" for i in range(len(TEXT_FEATURES)))


@query(
    "kernel_error",
    f"""
    SELECT doc_id, {fx('k')} AS kernel, true AS is_near, true AS better_than_fourier FROM (
        SELECT doc_id, exp(-({SQUARES}) / {len(TEXT_FEATURES)}) AS k FROM (SELECT doc_id, {SCALED} FROM ({TEXT_SOURCE})) WINDOW w AS (ORDER BY doc_id)
    ) WHERE k IS NOT NULL
    """,
)
def kernel_error(spark, sf_dir):
    """The kernel of each document and the next one, exact and through 100 landmarks: within 0.05; and over all
    pairs of each block the landmarks' mean error is under that of as many Fourier features."""
    rows = _texts(spark, sf_dir)
    scaled = prepare.fit_standardiser(rows, TEXT_FEATURES).apply(rows)
    x, gamma = F.array(*[F.col(c) for c in TEXT_FEATURES]), 1.0 / len(TEXT_FEATURES)
    kept = settled(scaled.select("doc_id", x.alias("x")))
    found = landmarks.fit_landmarks(kept, F.col("x"), ["doc_id"], 100, gamma)
    fourier = gradient.PairMachine(len(TEXT_FEATURES), 2, components=100, gamma=gamma)
    errors = [landmarks.kernel_errors(kept, F.col("x"), f, gamma).agg((F.sum(F.col("mean_error") * F.col("pairs")) / F.sum("pairs")).alias("e")).first()["e"] for f in (found.features, fourier.seen)]

    @F.pandas_udf("array<double>")
    def features(x: pd.Series) -> pd.Series:
        return pd.Series(list(found.features(np.stack(x.to_numpy())))) if len(x) else pd.Series([], dtype=object)

    numbered = _placed(kept.withColumn("z", features("x")))
    after = numbered.select((F.col("place") - 1).alias("place"), F.col("x").alias("x2"), F.col("z").alias("z2"))
    both = numbered.join(after, "place")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    square = F.aggregate(F.zip_with("x", "x2", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    kernel = F.exp(-square * gamma)
    near = F.abs(dot("z", "z2") - kernel) < 0.05
    return both.select("doc_id", fixed(kernel).alias("kernel"), near.alias("is_near"), F.lit(errors[0] < errors[1]).alias("better_than_fourier"))


def _placed(df):
    """Rows with their place in the order of doc_id."""
    codes = prepare.code_table(df, "doc_id").select("doc_id", F.col("code").alias("place"))
    return df.join(codes, "doc_id")
