"""Catalogue: trained classifiers and searches.

Documents are described by counts over their whole text; the label is their quality. Models
are trained with the registry's own settings, saved and loaded. Predictions have no SQL
form, so each query gives what must hold of them: the test rows of each class, how many of
these have valid probabilities, and how many the loaded model predicts as the fitted one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import attribution, evaluate, models, prepare, tuning
from sparktab.plans.explaining import text_measures
from sparktab.plans.registry import fixed, query, table
from sparktab.session import fresh_path, settled
from sparktab.sources import artifacts
from sparktab.streaming import flows

NUMERIC = ("n_chars", "n_spaces", "n_lines", "n_stops", "n_commas", "n_digits")
CATEGORIES = ("lang",)


def _rows(spark, sf_dir):
    """Labelled documents with their measures, split by quality."""
    texts = text_measures(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return texts.join(labels, "doc_id")


def _prepared(spark, sf_dir, target="quality"):
    rows, classes = models.training_frame(_rows(spark, sf_dir), ["doc_id"], target)
    split = prepare.fit_split(rows, ["doc_id"], "label")
    marked = split.mark(rows)
    return rows, classes, marked.where(~F.col("is_test")), marked.where("is_test")


LABELLED = """
    l AS (SELECT doc_id, CAST(quality AS VARCHAR) AS label FROM documents JOIN labels USING (doc_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('54|' || CAST(doc_id AS VARCHAR))) AS rn FROM l),
    c AS (SELECT label, count(*) AS n, CAST(ceil(CAST(0.3 AS DOUBLE) * sum(count(*)) OVER ()) AS BIGINT) AS wanted,
                 CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM l GROUP BY label),
    f AS (SELECT label, n * wanted // total AS base, wanted,
                 row_number() OVER (ORDER BY n * wanted % total DESC, label) AS place FROM c),
    q AS (SELECT label, base + CASE WHEN place <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f),
    s AS (SELECT r.*, rn <= quota AS is_test FROM r JOIN q USING (label))
"""
TRAINED = f"""
    WITH {LABELLED}
    SELECT label, CAST(count(*) AS BIGINT) AS n_test, CAST(count(*) AS BIGINT) AS n_valid,
           CAST(count(*) AS BIGINT) AS n_same_when_loaded
    FROM s WHERE is_test GROUP BY label
"""


def _checks(test, loaded, fitted, classes):
    """Per class: test rows, rows whose probabilities are valid and name the prediction, rows predicted alike."""
    again = fitted.predict(test).select("doc_id", F.col("prediction").alias("fitted"))
    rows = models.with_label_name(loaded.predict(test), classes).join(again, "doc_id")
    total = F.aggregate("probability", F.lit(0.0), lambda acc, p: acc + p)
    named = F.get(F.array(*[F.lit(c) for c in classes]), (F.array_position("probability", F.array_max("probability")) - 1).cast("int"))
    valid = (F.abs(total - 1.0) < 1e-9) & F.forall("probability", lambda p: (p >= 0) & (p <= 1)) & (F.abs(F.col("confidence") - 100 * F.array_max("probability")) < 1e-9)
    return rows.groupBy("label").agg(
        F.count("*").alias("n_test"),
        F.count_if(valid & named.isNotNull()).alias("n_valid"),
        F.count_if(F.col("prediction") == F.col("fitted")).alias("n_same_when_loaded"),
    )


def _trained(spark, sf_dir, name, params=None, categories=CATEGORIES):
    """Fit on train rows, save, load again, check the predictions of the test rows."""
    cached, classes, train, test = _prepared(spark, sf_dir)
    shape = models.shape_of(train, NUMERIC, categories, classes)
    fitted = models.train(name, train, classes, NUMERIC, categories, params, shape)
    loaded = artifacts.load_model(spark, artifacts.save_model(spark, fitted, fresh_path(spark, f"model-{name}")))
    out = settled(_checks(test, loaded, fitted, classes))
    cached.unpersist()
    return out


@query("train_lr", TRAINED)
def train_lr(spark, sf_dir):
    """C = 100 and up to 1,000 iterations, as the final model."""
    return _trained(spark, sf_dir, "logistic", {"C": 100.0})


@query(
    "train_lr_shares",
    f"""
    WITH {LABELLED}
    SELECT label, CAST(count(*) AS BIGINT) AS n_train, true AS mean_probability_is_share FROM s WHERE NOT is_test GROUP BY label
    """,
)
def train_lr_shares(spark, sf_dir):
    """A free intercept makes the mean predicted probability of a class its share of the train rows."""
    cached, classes, train, _ = _prepared(spark, sf_dir)
    fitted = models.train("logistic", train, classes, NUMERIC, CATEGORIES, {"C": 100.0})
    n = train.count()
    rows = fitted.predict(train.withColumn("doc_label", F.col("label")))
    means = rows.agg(*[F.avg(F.get("probability", F.lit(i))).alias(f"m{i}") for i in range(len(classes))]).first()
    counts = models.with_label_name(train, classes).groupBy("label").agg(F.count("*").alias("n_train"))
    mean = F.coalesce(*[F.when(F.col("label") == c, F.lit(means[f"m{i}"])) for i, c in enumerate(classes)])
    out = settled(counts.select("label", "n_train", (F.abs(mean - F.col("n_train") / n) < 1e-3).alias("mean_probability_is_share")))
    cached.unpersist()
    return out


@query("train_rf", TRAINED)
def train_rf(spark, sf_dir):
    """100 trees, as deep as Spark allows (30)."""
    return _trained(spark, sf_dir, "forest")


@query("train_svm_rff", TRAINED)
def train_svm_rff(spark, sf_dir):
    """100 random Fourier features, 100 iterations."""
    return _trained(spark, sf_dir, "kernel_svm")


@query("train_svm_landmarks", TRAINED)
def train_svm_landmarks(spark, sf_dir):
    """100 landmark rows drawn by leverage."""
    return _trained(spark, sf_dir, "kernel_svm", {"map": "landmarks"})


@query("train_nb", TRAINED)
def train_nb(spark, sf_dir):
    return _trained(spark, sf_dir, "bayes")


@query("train_dt", TRAINED)
def train_dt(spark, sf_dir):
    """Depth up to 30."""
    return _trained(spark, sf_dir, "tree")


@query("train_gbt", TRAINED)
def train_gbt(spark, sf_dir):
    """100 rounds of depth 6 at rate 0.3."""
    return _trained(spark, sf_dir, "boosted_level")


@query("train_mlp", TRAINED)
def train_mlp(spark, sf_dir):
    """100 hidden units, up to 500 iterations."""
    return _trained(spark, sf_dir, "perceptron")


def _linear(spark, sf_dir):
    """The final logistic model over numbers and encoded categories, as weights, saved and loaded; its test rows."""
    cached, classes, train, test = _prepared(spark, sf_dir)
    fitted = models.train("logistic", train, classes, NUMERIC, CATEGORIES, {"C": 100.0})
    path = artifacts.save_linear(spark, fitted.linear(train), fresh_path(spark, "linear"))
    kept = settled(test)
    same = settled(fitted.predict(kept).select("doc_id", F.col("probability").alias("trained")))
    cached.unpersist()
    return artifacts.load_linear(spark, path), kept, same


def _result_checks(rows, model):
    """Does a scoring result hold together: probabilities, confidence, factors."""
    r = F.col("result")
    total = F.aggregate(F.map_values(r.probabilities), F.lit(0.0), lambda acc, p: acc + p)
    return {
        "n_probabilities": F.size(r.probabilities),
        "sums_to_one": F.abs(total - 1.0) < 1e-9,
        "confidence_is_top": F.abs(r.confidence - 100.0 * F.array_max(F.map_values(r.probabilities))) < 1e-9,
        "n_factors": F.size(r.top_factors),
    }


@query(
    "explain_trained",
    f"""
    WITH {LABELLED}
    SELECT doc_id, 2 AS n_probabilities, true AS sums_to_one, true AS confidence_is_top, 3 AS n_factors,
           true AS as_the_pipeline, true AS adds_up
    FROM s WHERE is_test
    """,
)
def explain_trained(spark, sf_dir):
    """A trained, saved and loaded logistic model with encoded categories: it scores as its
    pipeline does, and base value and attributions add up to the margins."""
    model, test, same = _linear(spark, sf_dir)
    scored = attribution.score(test, model, ["doc_id"], k=3)
    phi = attribution.attributions(test, model, ["doc_id"]).groupBy("doc_id", "class").agg(F.sum("phi").alias("phi"))
    base = F.coalesce(*[F.when(F.col("class") == c, F.lit(model.base(i))) for i, c in enumerate(model.classes)])
    weight = F.exp(base + F.col("phi"))
    shares = phi.select("doc_id", "class", weight.alias("w")).groupBy("doc_id").agg(
        F.sum("w").alias("all"), F.map_from_entries(F.collect_list(F.struct("class", "w"))).alias("by_class")
    )
    rows = scored.join(same, "doc_id").join(shares, "doc_id")
    r = F.col("result")
    near = lambda i, c: F.abs(r.probabilities[c] - F.get("trained", F.lit(i))) < 1e-6
    adds = lambda c: F.abs(r.probabilities[c] - F.col("by_class")[c] / F.col("all")) < 1e-6
    return rows.select(
        "doc_id",
        *[v.alias(k) for k, v in _result_checks(rows, model).items()],
        F.array_min(F.array(*[near(i, c) for i, c in enumerate(model.classes)])).alias("as_the_pipeline"),
        F.array_min(F.array(*[adds(c) for c in model.classes])).alias("adds_up"),
    )


@query(
    "stream_score_saved",
    """
    SELECT doc_id, 2 AS n_probabilities, true AS sums_to_one, true AS confidence_is_top, 3 AS n_factors, true AS as_in_batch
    FROM documents
    """,
)
def stream_score_saved(spark, sf_dir):
    """A stream of all documents scored by the saved model, against the batch scores."""
    model, _, _ = _linear(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    stream = text_measures(flows.read_table_stream(spark, sf_dir, docs.schema, "documents.parquet"))
    out = fresh_path(spark, "scored")
    flows.write_tables(flows.score_stream(stream, model, ["doc_id"]), out, fresh_path(spark, "progress")).awaitTermination()
    batch = attribution.score(text_measures(docs), model, ["doc_id"]).select("doc_id", F.col("result").alias("batch"))
    rows = spark.read.parquet(out).join(batch, "doc_id")
    same = (F.col("result.prediction") == F.col("batch.prediction")) & (F.abs(F.col("result.confidence") - F.col("batch.confidence")) < 1e-9)
    return rows.select("doc_id", *[v.alias(k) for k, v in _result_checks(rows, model).items()], same.alias("as_in_batch"))


def _searched(spark, sf_dir, run, folds=5):
    cached, classes, train, test = _prepared(spark, sf_dir)
    folded, pieces = prepare.stratified_folds(train, ["doc_id"], "label", folds), cached.rdd.getNumPartitions()
    if pieces > 1:  # numbering the folds dealt the rows over as many tasks as a shuffle has
        folded = models.laid_out(folded, ["doc_id"], pieces)
    folded = folded.persist()
    out = settled(run(folded, classes, test))
    folded.unpersist()
    cached.unpersist()
    return out


def _search_line(found, test, classes, spark):
    """What must hold of a search: candidates, scores that are shares, one best candidate
    that no other beats, and the test accuracy of the refitted best."""
    judged = evaluate.accuracy(models.with_label_name(found.model.predict(test), classes)).first()
    lines = found.table(spark)
    return lines.groupBy("model").agg(
        F.count("*").alias("n_candidates"),
        F.count_if(F.col("cv_mean").between(0, 1) & (F.col("cv_std") >= 0) & (F.col("search_seconds") > 0)).alias("n_scored"),
        F.count_if("is_best").alias("n_best"),
        (F.max("cv_mean") == F.max(F.when(F.col("is_best"), F.col("cv_mean")))).alias("best_is_highest"),
        F.lit(judged["n"]).cast("bigint").alias("n_test"),
        F.lit(0 <= judged["accuracy"] <= 1).alias("accuracy_is_share"),
    )


def _search_sql(model: str, n: int) -> str:
    return f"""
    WITH {LABELLED}
    SELECT '{model}' AS model, CAST({n} AS BIGINT) AS n_candidates, CAST({n} AS BIGINT) AS n_scored, CAST(1 AS BIGINT) AS n_best,
           true AS best_is_highest, CAST(count(*) AS BIGINT) AS n_test, true AS accuracy_is_share
    FROM s WHERE is_test
    """


# The grids that are searched. The solver does not change a convex optimum, so C is the grid.
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "max_iter": [500, 1000]}
TREE_GRID = {"max_depth": [3, 5, 8, 10, 15, 20, 30], "min_leaf": [1, 2, 3, 4, 6, 8, 12, 16]}


@query("tune_grid", _search_sql("logistic", 10))
def tune_grid(spark, sf_dir):
    """All ten combinations, five folds."""
    grid = tuning.grid_of(LR_GRID)
    return _searched(spark, sf_dir, lambda rows, classes, test: _search_line(tuning.search("logistic", grid, rows, classes, NUMERIC, CATEGORIES), test, classes, spark))


def _random(rows, classes):
    return tuning.search("tree", tuning.sample_of(TREE_GRID, 50), rows, classes, NUMERIC, CATEGORIES)


@query("tune_random", _search_sql("tree", 50))
def tune_random(spark, sf_dir):
    """Fifty sampled combinations of 56, five folds."""
    return _searched(spark, sf_dir, lambda rows, classes, test: _search_line(_random(rows, classes), test, classes, spark))


@query(
    "best_params",
    f"""
    WITH {LABELLED}
    SELECT 'logistic' AS model, unnest(['C', 'max_iter']) AS param, true AS in_grid, CAST(count(*) AS BIGINT) AS n_train
    FROM s WHERE NOT is_test
    """,
)
def best_params(spark, sf_dir):
    """The parameters of the best of ten candidates, each a value of the grid."""

    def run(rows, classes, _):
        found = tuning.search("logistic", tuning.grid_of(LR_GRID), rows, classes, NUMERIC, CATEGORIES).best_params(spark)
        options = F.coalesce(*[F.when(F.col("param") == k, F.array(*[F.lit(str(x)) for x in v])) for k, v in LR_GRID.items()])
        return found.select("model", "param", F.array_contains(options, F.col("value")).alias("in_grid"), F.lit(rows.count()).cast("bigint").alias("n_train"))

    return _searched(spark, sf_dir, run)


# The other grids of the surveyed search. With this solver the learning-rate
# schedule of the network has no effect, so each of its two options is the same candidate.
SVM_GRID = {"C": [0.1, 1, 10, 50], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"]}
NETWORK_GRID = {"hidden": [(64,), (128,), (64, 64), (128, 64)], "activation": ["relu", "tanh"], "alpha": [0.0001, 0.001, 0.01]}


def _tuned(spark, sf_dir, name, candidates):
    return _searched(spark, sf_dir, lambda rows, classes, test: _search_line(tuning.search(name, candidates, rows, classes, NUMERIC, CATEGORIES), test, classes, spark))


@query("tune_svm", _search_sql("kernel_svm", 16))
def tune_svm(spark, sf_dir):
    """All sixteen combinations, five folds: eighty machines in the same passes."""
    return _tuned(spark, sf_dir, "kernel_svm", tuning.grid_of(SVM_GRID))


@query("tune_network", _search_sql("perceptron", 24))
def tune_network(spark, sf_dir):
    """All 24 networks that differ, five folds: 120 networks in the same passes."""
    return _tuned(spark, sf_dir, "perceptron", tuning.grid_of(NETWORK_GRID))


@query("train_network", TRAINED)
def train_network(spark, sf_dir):
    """Two layers of tanh units with an L2 penalty, mini-batches."""
    return _trained(spark, sf_dir, "perceptron", {"hidden": (32, 16), "activation": "tanh", "alpha": 0.01, "batch": 64, "max_iter": 60})


def _many_sql(names) -> str:
    return f"""
    WITH {LABELLED}, m AS (SELECT unnest([{", ".join(f"'{n}'" for n in sorted(names))}]) AS model)
    SELECT model, CAST(count(*) FILTER (is_test) AS BIGINT) AS n_test, CAST(count(*) FILTER (NOT is_test) AS BIGINT) AS n_train, 15 AS n_folds,
           true AS accuracy_is_share, true AS cv_is_share, true AS in_order
    FROM s, m GROUP BY model
    """


def _figures(spark, wanted, rows, classes, test, folds=15):
    """A line per model on one cached frame: test rows and accuracy, fold mean and deviation."""
    results = tuning.train_many(wanted, rows, classes, NUMERIC, CATEGORIES, folds=folds, key="doc_id")
    lines = []
    for name, found in results.items():
        judged = evaluate.accuracy(models.with_label_name(found.model.predict(test), classes)).first()
        lines.append((name, judged["n"], judged["accuracy"], found.means[0], found.deviations[0], found.seconds))
    return spark.createDataFrame(lines, "model string, n bigint, accuracy double, cv_mean double, cv_std double, seconds double")


def _many(spark, wanted, rows, classes, test, folds=15):
    """What must hold of the figures, and that they rank the models."""
    summary = _figures(spark, wanted, rows, classes, test, folds)
    ranked = [r["cv_mean"] for r in evaluate.rank_models(summary, "cv_mean").collect()]  # one row per model
    share = lambda c: F.col(c).between(0, 1)
    return summary.select(
        "model",
        F.col("n").alias("n_test"),
        F.lit(rows.count()).cast("bigint").alias("n_train"),
        F.lit(rows.select("fold").distinct().count()).cast("int").alias("n_folds"),
        share("accuracy").alias("accuracy_is_share"),
        (share("cv_mean") & (F.col("cv_std") >= 0)).alias("cv_is_share"),
        F.lit(ranked == sorted(ranked, reverse=True)).alias("in_order"),
    )


# All ten models with their own settings, in queries of some minutes each. A thousand rounds of the
# symmetric trees would be 7,000 passes; a hundred at a higher rate take their place.
MANY = {"logistic": {"C": 100.0}, "bayes": {}, "tree": {}, "forest": {}, "neighbours": {"k": 5}}
MANY_BOOSTED = {"boosted_level": {}, "boosted_leaf": {}, "boosted_symmetric": {"rounds": 100, "rate": 0.1}}
MANY_BY_GRADIENT = {"kernel_svm": {}, "perceptron": {}}


@query("train_many", _many_sql(MANY))
def train_many(spark, sf_dir):
    """Five models on one cached frame, fifteen folds: test accuracy, fold mean and deviation, best first."""
    return _searched(spark, sf_dir, lambda rows, classes, test: _many(spark, MANY, rows, classes, test), 15)


@query("train_many_boosted", _many_sql(MANY_BOOSTED))
def train_many_boosted(spark, sf_dir):
    """The three boosted ensembles, as ``train_many``: 48 fits in the same passes."""
    return _searched(spark, sf_dir, lambda rows, classes, test: _many(spark, MANY_BOOSTED, rows, classes, test), 15)


@query("train_many_by_gradient", _many_sql(MANY_BY_GRADIENT))
def train_many_by_gradient(spark, sf_dir):
    """Kernel machine and network, as ``train_many``: 32 fits in the same passes."""
    return _searched(spark, sf_dir, lambda rows, classes, test: _many(spark, MANY_BY_GRADIENT, rows, classes, test), 15)


@query("model_figures")
def model_figures(spark, sf_dir):
    """The figures themselves, for all models that need no long passes: test accuracy, mean and
    deviation of five folds, seconds so far. Trained models have no SQL form."""
    wanted = {**MANY, "kernel_svm": {}, "boosted_level": {"rounds": 20}, "boosted_leaf": {"rounds": 20}, "boosted_symmetric": {"rounds": 20, "rate": 0.2}, "perceptron": {"max_iter": 100}}

    def run(rows, classes, test):
        found = _figures(spark, wanted, rows, classes, test, 5)
        return evaluate.rank_models(found.withColumns({c: fixed(c, 4) for c in ("accuracy", "cv_mean", "cv_std")}), "cv_mean")

    return _searched(spark, sf_dir, run, 5)


@query("search_figures")
def search_figures(spark, sf_dir):
    """Every candidate of the logistic and the kernel machine's grid: fold mean, deviation, which is best."""

    def run(rows, classes, _):
        grids = {"logistic": tuning.grid_of(LR_GRID), "kernel_svm": tuning.grid_of(SVM_GRID)}
        found = tuning.searched_together(grids, rows, classes, NUMERIC, CATEGORIES)
        tables = [r.table(spark) for r in found.values()]
        both = tables[0].unionByName(tables[1]).withColumns({c: fixed(c, 4) for c in ("cv_mean", "cv_std")})
        return both.select("model", "candidate", F.to_json("params").alias("params"), "cv_mean", "cv_std", "is_best")

    return _searched(spark, sf_dir, run)
