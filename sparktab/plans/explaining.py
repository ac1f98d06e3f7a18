"""Catalogue: probabilities, confidence, attribution and scoring of a linear model.

The weights are fixed, the training means are the table's, so every number here has a
closed form that SQL can state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.functions.scalar import file_label, title_label
from sparktab.operators import attribution, charts, clean, evaluate
from sparktab.operators.attribution import LinearModel
from sparktab.plans.profiling import LINE_KEY, MEASURES
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.session import settled

# Classes, weights and intercepts of the two models of this module.
LINE_CLASSES = ("A", "N", "R")
LINE_WEIGHTS = (
    (0.05, 0.00001, -6.0, 4.0),
    (-0.03, 0.00002, 3.0, -9.0),
    (-0.02, -0.00003, 3.0, 5.0),
)
LINE_INTERCEPTS = (0.2, -0.1, -0.1)

TEXT_FEATURES = ("n_chars", "n_spaces", "n_lines", "n_stops", "n_commas", "n_digits")
TEXT_CLASSES = ("de", "en", "es", "fr")
TEXT_WEIGHTS = (
    (0.0004, -0.002, 0.01, 0.02, -0.01, 0.003),
    (-0.0001, 0.001, -0.01, 0.01, 0.02, -0.002),
    (-0.0002, 0.0005, 0.02, -0.01, -0.03, 0.001),
    (-0.0001, 0.0005, -0.02, -0.02, 0.02, -0.002),
)
TEXT_INTERCEPTS = (0.1, 0.3, -0.2, -0.2)


def _line_model(lines) -> LinearModel:
    fitted = clean.fit_moments(lines, MEASURES)
    means = tuple(fitted[c].mean for c in MEASURES)
    return LinearModel(MEASURES, LINE_CLASSES, LINE_WEIGHTS, LINE_INTERCEPTS, means)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag", *MEASURES)


def _counted(sign: str):
    return F.length("text") - F.length(F.replace(F.col("text"), F.lit(sign)))


def text_measures(docs):
    """Counts over the whole text of each document."""
    return docs.select(
        "doc_id",
        "lang",
        "n_chars",
        _counted(" ").cast("bigint").alias("n_spaces"),
        (_counted("\n") + 1).cast("bigint").alias("n_lines"),
        _counted(".").cast("bigint").alias("n_stops"),
        _counted(",").cast("bigint").alias("n_commas"),
        F.regexp_count("text", F.lit("[0-9]")).cast("bigint").alias("n_digits"),
    )


def _texts(spark, sf_dir):
    """Read by the fit of the means and by the query, so the texts are measured once."""
    return settled(text_measures(table(spark, sf_dir, "documents")))


def _text_model(rows) -> LinearModel:
    fitted = clean.fit_moments(rows, TEXT_FEATURES)
    means = tuple(fitted[c].mean for c in TEXT_FEATURES)
    return LinearModel(TEXT_FEATURES, TEXT_CLASSES, TEXT_WEIGHTS, TEXT_INTERCEPTS, means)


# ----------------------------------------------------------- SQL for the two models


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _margin(features, weights, intercept) -> str:
    return "(" + " + ".join(f"{_d(w)} * {f}" for f, w in zip(features, weights)) + f" + {_d(intercept)})"


def _scored_sql(source: str, features, classes, weights, intercepts) -> str:
    """CTEs x (margins z0..), p (probabilities p0..), s (prediction, confidence)."""
    n = range(len(classes))
    top = f"greatest({', '.join(f'z{i}' for i in n)})"
    total = " + ".join(f"exp(z{i} - mx)" for i in n)
    best = f"greatest({', '.join(f'p{i}' for i in n)})"
    name = "CASE " + " ".join(f"WHEN p{i} = {best} THEN '{classes[i]}'" for i in n) + " END"
    return f"""
    src AS ({source}),
    x0 AS (SELECT *, {', '.join(f'{_margin(features, weights[i], intercepts[i])} AS z{i}' for i in n)} FROM src),
    x AS (SELECT *, {top} AS mx FROM x0),
    p AS (SELECT *, {', '.join(f'exp(z{i} - mx) / ({total}) AS p{i}' for i in n)} FROM x),
    s AS (SELECT *, {name} AS prediction, {best} * 100 AS confidence FROM p)
    """


def _phi_sql(features, classes, weights) -> str:
    """CTEs t (means) and phi (long attributions), after _scored_sql."""
    rows = " UNION ALL ".join(
        f"SELECT s.*, '{c}' AS class, {i} AS ci, '{f}' AS feature, CAST(s.{f} AS DOUBLE) AS v, "
        f"{_d(weights[i][j])} * (s.{f} - m_{f}) AS phi FROM s, t"
        for i, c in enumerate(classes)
        for j, f in enumerate(features)
    )
    return f"t AS (SELECT {', '.join(f'avg({f}) AS m_{f}' for f in features)} FROM src), phi AS ({rows})"


LINE_SCORED = _scored_sql("SELECT * FROM lineitem", MEASURES, LINE_CLASSES, LINE_WEIGHTS, LINE_INTERCEPTS)
LINE_PHI = _phi_sql(MEASURES, LINE_CLASSES, LINE_WEIGHTS)
TEXT_SOURCE = r"""
    SELECT doc_id, lang, n_chars, length(text) - length(replace(text, ' ', '')) AS n_spaces,
           length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines,
           length(text) - length(replace(text, '.', '')) AS n_stops,
           length(text) - length(replace(text, ',', '')) AS n_commas,
           length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits
    FROM documents
"""
TEXT_SCORED = _scored_sql(TEXT_SOURCE, TEXT_FEATURES, TEXT_CLASSES, TEXT_WEIGHTS, TEXT_INTERCEPTS)
TEXT_PHI = _phi_sql(TEXT_FEATURES, TEXT_CLASSES, TEXT_WEIGHTS)
TEXT_BASE = "CASE prediction " + " ".join(
    f"WHEN '{c}' THEN " + " + ".join(f"{_d(w)} * m_{f}" for f, w in zip(TEXT_FEATURES, TEXT_WEIGHTS[i])) + f" + {_d(TEXT_INTERCEPTS[i])}"
    for i, c in enumerate(TEXT_CLASSES)
) + " END"


# ------------------------------------------------------- probabilities and confidence


@query(
    "proba_softmax",
    f"WITH {TEXT_SCORED} SELECT doc_id, {', '.join(f'{fx(f'p{i}', 8)} AS p_{c}' for i, c in enumerate(TEXT_CLASSES))}, prediction FROM s",
)
def proba_softmax(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    scored = attribution.with_scores(rows, _text_model(rows))
    return scored.select(
        "doc_id",
        *[fixed(F.col("probability")[i], 8).alias(f"p_{c}") for i, c in enumerate(TEXT_CLASSES)],
        "prediction",
    )


@query(
    "confidence_rows",
    f"WITH {TEXT_SCORED} SELECT doc_id, prediction, {fx('confidence')} AS confidence FROM s ORDER BY doc_id",
)
def confidence_rows(spark, sf_dir):
    """Prediction and confidence per row, in key order."""
    rows = _texts(spark, sf_dir)
    scored = attribution.with_scores(rows, _text_model(rows))
    return scored.select("doc_id", "prediction", fixed("confidence").alias("confidence")).orderBy("doc_id")


@query(
    "confidence_sample",
    f"WITH {TEXT_SCORED} SELECT doc_id, prediction, {fx('confidence')} AS confidence FROM s ORDER BY doc_id LIMIT 5",
)
def confidence_sample(spark, sf_dir):
    """The report on the first five rows."""
    return confidence_rows(spark, sf_dir).limit(5)


@query(
    "confidence_summary",
    f"""
    WITH {LINE_SCORED}
    SELECT prediction, CAST(count(*) AS BIGINT) AS n, {fx('avg(confidence)')} AS mean_confidence,
           {fx('avg(CASE WHEN confidence >= 90 THEN CAST(1 AS DOUBLE) ELSE 0 END)')} AS share_high
    FROM s GROUP BY prediction
    """,
)
def confidence_summary(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    scored = attribution.with_scores(lines, _line_model(lines))
    out = evaluate.confidence_summary(scored, ["prediction"])
    return out.withColumns({c: fixed(c) for c in ("mean_confidence", "share_high")})


@query(
    "confidence_hist",
    f"""
    WITH {LINE_SCORED},
    w AS (SELECT prediction, floor(confidence * 1e9 + 0.5) / 1e9 AS confidence FROM s),
    e AS (SELECT prediction, min(confidence) AS low, max(confidence) AS high, 20 AS bins FROM w GROUP BY prediction),
    c AS (SELECT prediction, CAST(least(floor((confidence - low) / ((high - low) / bins)), bins - 1) AS BIGINT) AS bin,
                 count(*) AS n FROM w JOIN e USING (prediction) GROUP BY ALL),
    b AS (SELECT e.*, CAST(unnest(generate_series(0, bins - 1)) AS BIGINT) AS bin FROM e)
    SELECT prediction, 'confidence' AS "column", bin, {fx('low + bin * ((high - low) / bins)')} AS "left",
           {fx('low + (bin + 1) * ((high - low) / bins)')} AS "right", CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM b LEFT JOIN c USING (prediction, bin)
    """,
)
def confidence_hist(spark, sf_dir):
    """Twenty bins per predicted class, each over the class's own range."""
    lines = _lines(spark, sf_dir)
    scored = attribution.with_scores(lines, _line_model(lines))
    shown = scored.select("prediction", fixed("confidence", 9).alias("confidence"))
    out = charts.histogram(shown, ["confidence"], bins=20, by=["prediction"])
    return out.withColumns({c: fixed(c) for c in ("left", "right")})


@query(
    "triage",
    f"""
    WITH {LINE_SCORED}
    SELECT prediction, confidence < 70 AS borderline, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY ALL
    """,
)
def triage(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return evaluate.triage(attribution.with_scores(lines, _line_model(lines)))


# ---------------------------------------------------------------------- attribution


@query(
    "linear_phi",
    f"WITH {TEXT_SCORED}, {TEXT_PHI} SELECT doc_id, class, feature, v AS value, {fx('phi', 9)} AS phi FROM phi",
)
def linear_phi(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    return attribution.attributions(rows, _text_model(rows), ["doc_id"]).withColumn("phi", fixed("phi", 9))


@query(
    "phi_adds_up",
    f"""
    WITH {TEXT_SCORED}, u AS (SELECT doc_id, unnest([{', '.join(f"'{c}'" for c in TEXT_CLASSES)}]) AS class,
                                     unnest([{', '.join(f'z{i}' for i in range(4))}]) AS z FROM s)
    SELECT doc_id, class, {fx('z', 9)} AS margin FROM u
    """,
)
def phi_adds_up(spark, sf_dir):
    """Base value plus attributions; the counterpart computes the margin itself."""
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    base = F.element_at(
        F.create_map(*[F.lit(v) for i, c in enumerate(model.classes) for v in (c, model.base(i))]), F.col("class")
    )
    long = attribution.attributions(rows, model, ["doc_id"])
    return long.groupBy("doc_id", "class").agg(fixed(F.sum("phi") + F.first(base), 9).alias("margin"))


@query(
    "importance",
    f"WITH {LINE_SCORED}, {LINE_PHI} SELECT class, feature, {fx('avg(abs(phi))', 5)} AS importance FROM phi GROUP BY ALL",
)
def importance(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return attribution.ranked_importance(lines, _line_model(lines)).withColumn("importance", fixed("importance", 5))


@query(
    "phi_summary",
    f"""
    WITH {LINE_SCORED}, {LINE_PHI},
    e AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM phi GROUP BY feature)
    SELECT class, feature, CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin,
           CAST(count(*) AS BIGINT) AS n, {fx('avg(phi)', 5)} AS mean_phi, {fx('min(phi)', 5)} AS low_phi, {fx('max(phi)', 5)} AS high_phi
    FROM phi JOIN e USING (feature) GROUP BY ALL
    """,
)
def phi_summary(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    out = attribution.attribution_summary(lines, _line_model(lines))
    return out.withColumns({c: fixed(c, 5) for c in ("mean_phi", "low_phi", "high_phi")})


RANKED_PHI = """
    k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(phi) DESC, feature) AS place
          FROM phi WHERE class = prediction)
"""


@query(
    "top_factors",
    f"""
    WITH {TEXT_SCORED}, {TEXT_PHI}, {RANKED_PHI}
    SELECT doc_id, prediction, CAST(place AS INTEGER) AS place, feature,
           CASE WHEN phi > 0 THEN 'toward' ELSE 'away' END AS direction, {fx('abs(phi)', 9)} AS impact
    FROM k WHERE place <= 3
    """,
)
def top_factors(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    ready = attribution.with_top_factors(attribution.with_scores(rows, model), model, 3)
    return ready.select("doc_id", "prediction", F.posexplode_outer("top_factors").alias("i", "f")).select(
        "doc_id",
        "prediction",
        (F.col("i") + 1).alias("place"),
        "f.feature",
        "f.direction",
        fixed(F.col("f.impact"), 9).alias("impact"),
    )


@query(
    "waterfall",
    f"""
    WITH {TEXT_SCORED}, {TEXT_PHI}, {RANKED_PHI},
    g AS (SELECT doc_id, any_value(prediction) AS prediction, least(place, 4) AS step,
                 CASE WHEN least(place, 4) < 4 THEN any_value(feature) ELSE 'other' END AS feature, sum(phi) AS phi
          FROM k GROUP BY doc_id, least(place, 4))
    SELECT doc_id, CAST(step AS INTEGER) AS step, feature, {fx('phi', 9)} AS phi,
           {fx(f'{TEXT_BASE} + sum(phi) OVER (PARTITION BY doc_id ORDER BY step)', 9)} AS running
    FROM g, t
    """,
)
def waterfall(spark, sf_dir):
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    out = attribution.waterfall(attribution.with_scores(rows, model), model, ["doc_id"], shown=3)
    return out.withColumns({c: fixed(c, 9) for c in ("phi", "running")})


@query(
    "best_example",
    f"""
    WITH {LINE_SCORED},
    b AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY confidence DESC, {', '.join(LINE_KEY)}) AS place
          FROM s WHERE prediction = l_returnflag)
    SELECT l_returnflag AS label, {', '.join(LINE_KEY)}, {fx('confidence / 100')} AS top_probability FROM b WHERE place = 1
    """,
)
def best_example(spark, sf_dir):
    """Per class, the most confident correct row."""
    lines = _lines(spark, sf_dir)
    scored = attribution.with_scores(lines, _line_model(lines)).withColumn("label", F.col("l_returnflag"))
    out = evaluate.surest_correct(scored, LINE_KEY)
    return out.withColumn("top_probability", fixed("top_probability"))


@query(
    "best_example_waterfall",
    f"""
    WITH {TEXT_SCORED}, {TEXT_PHI}, {RANKED_PHI},
    b AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY confidence DESC, doc_id) AS p
                              FROM s WHERE prediction = lang) WHERE p = 1)
    SELECT doc_id, CAST(place AS INTEGER) AS step, feature, {fx('phi', 9)} AS phi,
           {fx(f'{TEXT_BASE} + sum(phi) OVER (PARTITION BY doc_id ORDER BY place)', 9)} AS running
    FROM k, t WHERE doc_id IN (SELECT doc_id FROM b)
    """,
)
def best_example_waterfall(spark, sf_dir):
    """The full path from base value to margin for each class's surest correct row."""
    rows = _texts(spark, sf_dir)
    model = _text_model(rows)
    scored = attribution.with_scores(rows, model).withColumn("label", F.col("lang"))
    chosen = evaluate.surest_correct(scored, ["doc_id"]).select("doc_id")
    picked = scored.join(chosen, "doc_id", "left_semi")
    out = attribution.waterfall(picked, model, ["doc_id"], shown=len(TEXT_FEATURES))
    return out.withColumns({c: fixed(c, 9) for c in ("phi", "running")})


@query(
    "score_batch",
    f"""
    WITH {TEXT_SCORED}, {TEXT_PHI}, {RANKED_PHI}
    SELECT doc_id, prediction, {fx('any_value(confidence)')} AS confidence,
           {', '.join(f'{fx(f"any_value(p{i})", 8)} AS p_{c}' for i, c in enumerate(TEXT_CLASSES))},
           string_agg(feature || ':' || CASE WHEN phi > 0 THEN 'toward' ELSE 'away' END, ',' ORDER BY place) AS factors
    FROM k WHERE place <= 5 GROUP BY doc_id, prediction
    """,
)
def score_batch(spark, sf_dir):
    """The whole scoring record, its map and list spread over plain columns."""
    rows = _texts(spark, sf_dir)
    scored = attribution.score(rows, _text_model(rows), ["doc_id"], k=5)
    r = F.col("result")
    factors = F.transform(r.top_factors, lambda t: F.concat_ws(":", t.feature, t.direction))
    return scored.select(
        "doc_id",
        r.prediction.alias("prediction"),
        fixed(r.confidence).alias("confidence"),
        *[fixed(r.probabilities[c], 8).alias(f"p_{c}") for c in TEXT_CLASSES],
        F.array_join(factors, ",").alias("factors"),
    )


@query(
    "factor_labels",
    f"""
    WITH {LINE_SCORED}, {LINE_PHI},
    k AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY abs(phi) DESC, feature) AS place
          FROM phi WHERE class = prediction)
    SELECT prediction, array_to_string(list_transform(string_split(feature, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS shown,
           lower(replace(feature || ' by class', ' ', '_')) AS file, CAST(count(*) AS BIGINT) AS n
    FROM k WHERE place = 1 GROUP BY ALL
    """,
)
def factor_labels(spark, sf_dir):
    """How often each feature is the strongest factor of a prediction, under its display and file names."""
    lines = _lines(spark, sf_dir)
    model = _line_model(lines)
    ready = attribution.with_top_factors(attribution.with_scores(lines, model), model, 1)
    feature = F.col("top_factors")[0].feature
    named = ready.select("prediction", title_label(feature).alias("shown"), file_label(F.concat(feature, F.lit(" by class"))).alias("file"))
    return named.groupBy("prediction", "shown", "file").agg(F.count("*").alias("n"))
