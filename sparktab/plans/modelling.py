"""Catalogue: encoding, splitting, prediction and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import evaluate, models, neighbours, prepare
from sparktab.plans.profiling import LINE_KEY, MEASURES
from sparktab.plans.registry import fixed, fx, query, table

KEY_TEXT = "concat_ws('|', '54', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in LINE_KEY) + ")"

# ------------------------------------------------------------------- category codes


@query(
    "label_encode",
    """
    SELECT p_partkey, p_type, CAST(code AS BIGINT) AS code
    FROM part JOIN (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
                    FROM (SELECT DISTINCT p_type FROM part)) USING (p_type)
    """,
)
def label_encode(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return prepare.ordinal(parts, "p_type", "code")


@query(
    "label_encode_many",
    """
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, CAST(any_value(code) AS BIGINT) AS code
    FROM orders JOIN (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS code
                      FROM (SELECT DISTINCT o_custkey FROM orders)) USING (o_custkey)
    GROUP BY o_custkey
    """,
)
def label_encode_many(spark, sf_dir):
    """The join form, for categories with any number of levels."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    coded = prepare.encode_joined(orders, "o_custkey", "code")
    return coded.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("code").alias("code"))


@query("label_decode", "SELECT p_partkey, p_type FROM part")
def label_decode(spark, sf_dir):
    """Encode, then decode again."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    levels = prepare.fit_levels(parts, "p_type")
    coded = parts.select("p_partkey", levels.encode().alias("code"))
    return coded.select("p_partkey", levels.decode(F.col("code")).alias("p_type"))


@query(
    "one_hot",
    f"""
    SELECT {', '.join(LINE_KEY)}, l_quantity, CASE WHEN f = 'A' THEN 1 ELSE 0 END AS "l_returnflag_A",
           CASE WHEN f = 'R' THEN 1 ELSE 0 END AS "l_returnflag_R"
    FROM (SELECT *, nullif(l_returnflag, 'N') AS f FROM lineitem)
    """,
)
def one_hot(spark, sf_dir):
    """Indicators of a category with gaps: a gap is all zero."""
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_quantity", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag")
    )
    return prepare.one_hot(lines, "l_returnflag")


# -------------------------------------------------------------------- splits, folds

RANKED = f"""
    r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5({KEY_TEXT})) AS rn FROM lineitem),
    c AS (SELECT l_returnflag, count(*) AS n, CAST(ceil(CAST(0.3 AS DOUBLE) * sum(count(*)) OVER ()) AS BIGINT) AS wanted,
                 CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM lineitem GROUP BY l_returnflag),
    f AS (SELECT l_returnflag, n * wanted // total AS base, wanted,
                 row_number() OVER (ORDER BY n * wanted % total DESC, l_returnflag) AS place FROM c),
    q AS (SELECT l_returnflag, base + CASE WHEN place <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f),
    s AS (SELECT r.*, rn <= quota AS is_test FROM r JOIN q USING (l_returnflag))
"""


def _split_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag", *MEASURES)
    return prepare.fit_split(lines, LINE_KEY, "l_returnflag").mark(lines)


@query("strat_split", f"WITH {RANKED} SELECT {', '.join(LINE_KEY)}, l_returnflag, is_test FROM s")
def strat_split(spark, sf_dir):
    return _split_lines(spark, sf_dir).drop(*MEASURES)


@query(
    "split_invariants",
    f"""
    WITH {RANKED}
    SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (is_test) AS BIGINT) AS n_test,
           CAST(count(*) FILTER (NOT is_test) AS BIGINT) AS n_train, CAST(0 AS BIGINT) AS n_both
    FROM s GROUP BY l_returnflag
    """,
)
def split_invariants(spark, sf_dir):
    """Both sides together are the table, no key is on both sides, quotas hold."""
    marked = _split_lines(spark, sf_dir)
    per_key = marked.groupBy("l_returnflag", *LINE_KEY).agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("test"), F.count_if(~F.col("is_test")).alias("train")
    )
    return per_key.groupBy("l_returnflag").agg(
        F.sum("n").alias("n_rows"),
        F.sum("test").alias("n_test"),
        F.sum("train").alias("n_train"),
        F.count_if((F.col("test") > 0) & (F.col("train") > 0)).alias("n_both"),
    )


@query(
    "strat_split_hash",
    f"""
    SELECT {', '.join(LINE_KEY)}, l_returnflag,
           CAST('0x' || substr(md5({KEY_TEXT}), 1, 8) AS BIGINT) < CAST(0.3 AS DOUBLE) * 4294967296 AS is_test
    FROM lineitem
    """,
)
def strat_split_hash(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    return prepare.hash_split(lines, LINE_KEY)


@query(
    "strat_folds",
    f"""
    SELECT {', '.join(LINE_KEY)}, l_returnflag,
           CAST((row_number() OVER (PARTITION BY l_returnflag ORDER BY md5({KEY_TEXT})) - 1) % 5 AS INTEGER) AS fold
    FROM lineitem
    """,
)
def strat_folds(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag")
    return prepare.stratified_folds(lines, LINE_KEY, "l_returnflag", 5)


@query(
    "standardise",
    f"""
    WITH {RANKED},
    t AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}' for c in MEASURES)} FROM s WHERE NOT is_test)
    SELECT {', '.join(LINE_KEY)}, {', '.join(f"{fx(f'({c} - m_{c}) / d_{c}')} AS {c}" for c in MEASURES)} FROM s, t
    """,
)
def standardise(spark, sf_dir):
    """All rows, scaled by the statistics of the train rows."""
    rows = _split_lines(spark, sf_dir)
    scaler = prepare.fit_standardiser(rows.where(~F.col("is_test")), MEASURES)
    return scaler.apply(rows).select(*LINE_KEY, *[fixed(c).alias(c) for c in MEASURES])


# --------------------------------------------------------------- neighbours and Bayes

IS_TEST = "CAST('0x' || substr(md5(concat_ws('|', '54', CAST(vec_id AS VARCHAR))), 1, 8) AS BIGINT) < CAST(0.3 AS DOUBLE) * 4294967296"
SPLIT_VECTORS = f"e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x, {IS_TEST} AS is_test FROM embeddings)"

KNN = f"""
    {SPLIT_VECTORS},
    d AS (SELECT q.vec_id AS asked, t.vec_id AS neighbour, t.label AS vote,
                 list_sum(list_transform(generate_series(1, 64), lambda i: (q.x[i] - t.x[i]) * (q.x[i] - t.x[i]))) AS d2
          FROM e q JOIN e t ON q.is_test AND NOT t.is_test),
    k AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY d2, neighbour) AS place FROM d),
    v AS (SELECT asked, vote, count(*) AS n FROM k WHERE place <= 5 GROUP BY asked, vote),
    knn AS (SELECT asked AS vec_id, vote AS prediction
            FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY n DESC, vote) AS p FROM v) WHERE p = 1)
"""

GNB = f"""
    {SPLIT_VECTORS},
    l AS (SELECT vec_id, label, is_test, unnest(generate_series(1, 64)) AS j, unnest(x) AS v FROM e),
    eps AS (SELECT CAST(1e-9 AS DOUBLE) * max(vp) AS eps FROM (SELECT j, var_pop(v) AS vp FROM l WHERE NOT is_test GROUP BY j)),
    st AS (SELECT label AS cls, j, avg(v) AS m, var_pop(v) + any_value(eps) AS s2 FROM l, eps WHERE NOT is_test GROUP BY label, j),
    pr AS (SELECT label AS cls, ln(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)) AS prior FROM e WHERE NOT is_test GROUP BY label),
    sc AS (SELECT l.vec_id, st.cls,
                  any_value(prior) + sum(CAST(-0.5 AS DOUBLE) * ln(2 * pi() * s2) - (v - m) * (v - m) / (2 * s2)) AS score
           FROM l JOIN st USING (j) JOIN pr ON pr.cls = st.cls WHERE l.is_test GROUP BY l.vec_id, st.cls),
    gnb AS (SELECT vec_id, cls AS prediction
            FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls) AS p FROM sc) WHERE p = 1)
"""


def _vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    marked = prepare.hash_split(rows, ["vec_id"])
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def _knn(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return neighbours.predict_nearest(train, test, "vec_id", "embedding", "label")


def _gnb(spark, sf_dir):
    train, test = _vectors(spark, sf_dir)
    return models.predict_bayes(train, test, "vec_id", "embedding", "label")


@query("knn_predict", f"WITH {KNN} SELECT vec_id, prediction FROM knn")
def knn_predict(spark, sf_dir):
    return _knn(spark, sf_dir)


@query("gnb_predict", f"WITH {GNB} SELECT vec_id, prediction FROM gnb")
def gnb_predict(spark, sf_dir):
    return _gnb(spark, sf_dir)


# ----------------------------------------------------------------------- evaluation


def _judged(spark, sf_dir, predicted):
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return labels.join(predicted, "vec_id")


JUDGED = "j AS (SELECT vec_id, label, prediction FROM gnb JOIN embeddings USING (vec_id))"
CLASSES = "k AS (SELECT label AS c FROM j UNION SELECT prediction FROM j)"
MATRIX = f"""
    {JUDGED}, {CLASSES},
    m AS (SELECT a.c AS label, b.c AS prediction, CAST(count(j.vec_id) AS BIGINT) AS n
          FROM k a CROSS JOIN k b LEFT JOIN j ON j.label = a.c AND j.prediction = b.c GROUP BY a.c, b.c)
"""
REPORT = """
    h AS (SELECT c, (SELECT sum(n) FROM m WHERE label = c) AS support, (SELECT sum(n) FROM m WHERE prediction = c) AS said,
                 (SELECT sum(n) FROM m WHERE label = c AND prediction = c) AS hit FROM k),
    g AS (SELECT c, support, hit, coalesce(hit / nullif(CAST(said AS DOUBLE), 0), 0) AS precision,
                 coalesce(hit / nullif(CAST(support AS DOUBLE), 0), 0) AS recall FROM h),
    r AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM g)
"""
SHOWN = ("precision", "recall", "f1")


@query("confusion", f"WITH {GNB}, {MATRIX} SELECT label, prediction, n FROM m")
def confusion(spark, sf_dir):
    judged = _judged(spark, sf_dir, _gnb(spark, sf_dir))
    return evaluate.confusion(judged, evaluate.classes_of(judged))


@query(
    "class_report",
    f"""
    WITH {GNB}, {MATRIX}, {REPORT}
    SELECT CAST(c AS VARCHAR) AS class, {', '.join(f'{fx(c)} AS {c}' for c in SHOWN)},
           CAST(support AS BIGINT) AS support FROM r
    UNION ALL SELECT 'accuracy', {', '.join([fx("sum(hit) / CAST(sum(support) AS DOUBLE)")] * 3)}, CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', {', '.join(fx(f'avg({c})') for c in SHOWN)}, CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', {', '.join(fx(f'sum({c} * support) / CAST(sum(support) AS DOUBLE)') for c in SHOWN)},
           CAST(sum(support) AS BIGINT) FROM r
    """,
)
def class_report(spark, sf_dir):
    judged = _judged(spark, sf_dir, _gnb(spark, sf_dir))
    report = evaluate.class_report(evaluate.confusion(judged, evaluate.classes_of(judged)))
    return report.withColumns({c: fixed(c) for c in SHOWN})


@query(
    "accuracy",
    f"""
    WITH {GNB}, {JUDGED}
    SELECT CAST(count(*) AS BIGINT) AS n, {fx('avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE 0 END)')} AS accuracy FROM j
    """,
)
def accuracy(spark, sf_dir):
    judged = _judged(spark, sf_dir, _gnb(spark, sf_dir))
    return evaluate.accuracy(judged).withColumn("accuracy", fixed("accuracy"))


@query(
    "fold_accuracy",
    f"""
    WITH {GNB}, {JUDGED},
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '54', CAST(vec_id AS VARCHAR)))) - 1) % 5 AS fold FROM j),
    a AS (SELECT fold, avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE 0 END) AS acc FROM f GROUP BY fold)
    SELECT {fx('avg(acc)')} AS cv_mean, {fx('stddev_pop(acc)')} AS cv_std FROM a
    """,
)
def fold_accuracy(spark, sf_dir):
    """Mean and deviation of the accuracy over five stratified folds of the predictions."""
    judged = _judged(spark, sf_dir, _gnb(spark, sf_dir))
    folds = prepare.stratified_folds(judged, ["vec_id"], "label", 5)
    out = evaluate.fold_summary(folds, "fold")
    return out.withColumn("cv_mean", fixed("cv_mean")).withColumn("cv_std", fixed("cv_std"))


BOTH = f"""
    {GNB}, {KNN.replace(SPLIT_VECTORS + ',', '')},
    res AS (
        SELECT 'bayes' AS model, avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE 0 END) AS accuracy
        FROM gnb JOIN embeddings USING (vec_id)
        UNION ALL SELECT 'nearest', avg(CASE WHEN label = prediction THEN CAST(1 AS DOUBLE) ELSE 0 END)
        FROM knn JOIN embeddings USING (vec_id))
"""


def _results(spark, sf_dir, k: int = 5):
    train, test = _vectors(spark, sf_dir)
    found = {
        "bayes": _gnb(spark, sf_dir),
        "nearest": neighbours.predict_nearest(train, test, "vec_id", "embedding", "label", k),
    }
    out = None
    for name, predicted in found.items():
        line = evaluate.accuracy(_judged(spark, sf_dir, predicted)).select(F.lit(name).alias("model"), "accuracy")
        out = line if out is None else out.unionByName(line)
    return out


@query("model_rank", f"WITH {BOTH} SELECT model, {fx('accuracy')} AS accuracy FROM res ORDER BY res.accuracy DESC, model")
def model_rank(spark, sf_dir):
    return evaluate.rank_models(_results(spark, sf_dir)).withColumn("accuracy", fixed("accuracy"))


@query(
    "best_model",
    f"WITH {BOTH} SELECT model, {fx('accuracy')} AS accuracy FROM res ORDER BY res.accuracy DESC, model LIMIT 1",
)
def best_model(spark, sf_dir):
    return evaluate.best_model(_results(spark, sf_dir)).withColumn("accuracy", fixed("accuracy"))


@query(
    "before_after",
    f"""
    WITH {BOTH},
    k1 AS (SELECT 'nearest' AS model, avg(CASE WHEN vote = label THEN CAST(1 AS DOUBLE) ELSE 0 END) AS accuracy
           FROM k JOIN embeddings ON vec_id = asked WHERE place = 1),
    b AS (SELECT * FROM k1 UNION ALL SELECT * FROM res WHERE model = 'bayes'),
    j2 AS (SELECT b.model, b.accuracy AS bef, res.accuracy AS aft FROM b JOIN res USING (model))
    SELECT model, {fx('bef')} AS before, {fx('aft')} AS after, {fx('aft - bef')} AS gain,
           {fx('max(bef) OVER ()')} AS best_before, {fx('max(aft) OVER ()')} AS best_after FROM j2
    """,
)
def before_after(spark, sf_dir):
    """One neighbour against five: the gain of a setting, per model."""
    out = evaluate.before_after(_results(spark, sf_dir, k=1), _results(spark, sf_dir, k=5))
    return out.withColumns({c: fixed(c) for c in ("before", "after", "gain", "best_before", "best_after")})
