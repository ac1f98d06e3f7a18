"""Catalogue: boosted trees of three kinds and category statistics.

From a constant start the first round's trees have a closed form: SQL tries every cut of
every leaf, with gradients and hessians that are the same for all rows of a class.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sparktab.operators import boosting, exact_tree, learners, target_stats
from sparktab.operators.blocks import blocks_of
from sparktab.plans.explaining import TEXT_SOURCE, text_measures
from sparktab.plans.registry import fixed, fx, query, table
from sparktab.plans.training import NUMERIC
from sparktab.session import settled

SHOWN = ("path", "n_rows", "feature", "cut", "gain", "value")


def _tree_sql(name: str, s: boosting.Settings, splits: int, features, y: str) -> str:
    """CTEs of one first tree: ``name`` has path, n_rows, feature, cut, gain, value.

    Needs r (doc_id, features, label). ``y`` is the condition of the wanted class. Leaf-wise
    growth makes ``splits`` single splits, the others that many levels.
    """
    score = lambda g, h: f"CASE WHEN {h} + {s.l2} > 0 THEN ({g}) * ({g}) / ({h} + {s.l2}) ELSE 0 END"
    allowed = "true" if s.growth == "symmetric" else f"nl >= {s.min_leaf} AND n - nl >= {s.min_leaf} AND hl >= {s.min_hessian} AND h - hl >= {s.min_hessian}"
    parts = [
        f"{name}_p AS (SELECT CAST(count(*) FILTER ({y}) AS DOUBLE) / count(*) AS p FROM r)",
        f"{name}_g AS (SELECT doc_id, p - CASE WHEN {y} THEN 1 ELSE 0 END AS g, p * (1 - p) AS h FROM r, {name}_p)",
        f"{name}_n0 AS (SELECT '' AS path, doc_id FROM r)",
    ]
    for k in range(splits):
        gain = f"0.5 * ({score('gl', 'hl')} + {score('g - gl', '(h - hl)')} - {score('g', 'h')})"
        one = "path" if s.growth != "symmetric" else "1"
        spread = "gain" if s.growth != "symmetric" else "sum(gain) OVER (PARTITION BY f, cut)"
        chosen = "ORDER BY gain DESC, path LIMIT 1" if s.growth == "leaf" else ""
        parts += [
            f"""{name}_s{k} AS (SELECT path, f, cut, coalesce(sum(g) FILTER (v <= cut), 0) AS gl, coalesce(sum(h) FILTER (v <= cut), 0) AS hl,
                 count(*) FILTER (v <= cut) AS nl, sum(g) AS g, sum(h) AS h, count(*) AS n
                 FROM {name}_n{k} JOIN {name}_g USING (doc_id) JOIN long USING (doc_id) JOIN cuts USING (f) GROUP BY path, f, cut)""",
            f"{name}_o{k} AS (SELECT path, f, cut, n, {gain} AS gain FROM {name}_s{k} WHERE {allowed})",
            f"{name}_t{k} AS (SELECT path, f, cut, n, {spread} AS gain FROM {name}_o{k})",
            f"{name}_u{k} AS (SELECT *, max(gain) OVER (PARTITION BY {one}) AS top FROM {name}_t{k})",
            f"""{name}_c{k} AS (SELECT path, f, cut, n, gain FROM {name}_u{k} WHERE gain >= top * (1 - 1e-9) AND gain > 0
                 QUALIFY row_number() OVER (PARTITION BY path ORDER BY f, cut) = 1 {chosen})""",
            f"""{name}_n{k + 1} AS (SELECT n.path || CASE WHEN c.path IS NULL THEN '' WHEN l.v <= c.cut THEN 'L' ELSE 'R' END AS path, n.doc_id
                 FROM {name}_n{k} n LEFT JOIN {name}_c{k} c ON n.path = c.path LEFT JOIN long l ON l.doc_id = n.doc_id AND l.f = c.f)""",
        ]
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    inner = " UNION ALL ".join(f"SELECT path, n, f, cut, gain FROM {name}_c{k}" for k in range(splits))
    parts.append(
        f"""{name} AS (
            SELECT path, CAST(n AS BIGINT) AS n_rows, {names}[f + 1] AS feature, {fx('cut')} AS cut, {fx('gain')} AS gain, CAST(NULL AS DOUBLE) AS value FROM ({inner})
            UNION ALL
            SELECT path, CAST(count(*) AS BIGINT), NULL, NULL, NULL, {fx(f'-sum(g) / (sum(h) + {s.l2})')}
            FROM {name}_n{splits} JOIN {name}_g USING (doc_id) GROUP BY path)"""
    )
    return ", ".join(parts)


def _source_sql(rows: str, features) -> str:
    """CTEs r, long (doc_id, f, v) and cuts (f, cut): the ranks ceil(n i / 64) of every feature."""
    long = " UNION ALL ".join(f"SELECT doc_id, {i} AS f, CAST({f} AS DOUBLE) AS v FROM r" for i, f in enumerate(features))
    return f"""r AS ({rows}), long AS ({long}),
        ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS rn, count(*) OVER (PARTITION BY f) AS n FROM long),
        cuts AS (SELECT DISTINCT f, v AS cut FROM ranked JOIN range(1, {boosting.BINS}) t(i) ON rn = greatest(1, CAST(ceil(CAST(i AS DOUBLE) / {boosting.BINS} * n) AS BIGINT)))"""


def _grown(rows, label, features, classes, settings):
    x = F.array(*[F.col(c).cast("double") for c in features])
    kept = settled(rows.select("doc_id", *features, label.alias("label")))
    blocks = blocks_of(kept, x, F.col("label"), ["doc_id"])
    made, _ = boosting.fit(blocks, [boosting.Model(settings)], classes, boosting.fit_cuts(kept, features))
    blocks.unpersist()
    return made[0]


def _nodes(tree: boosting.Tree, features) -> list[tuple]:
    """A tree's nodes as the SQL lists them."""
    out, todo = [], [(0, "")]
    while todo:
        node, path = todo.pop()
        f = int(tree.feature[node])
        if f >= 0:
            todo += [(int(tree.left[node]), path + "L"), (int(tree.right[node]), path + "R")]
            out.append((path, int(tree.rows[node]), features[f], float(tree.cut[node]), float(tree.gain[node]), None))
        else:
            out.append((path, int(tree.rows[node]), None, None, None, float(tree.value[node])))
    return out


KINDS = "path string, n_rows bigint, feature string, cut double, gain double, value double"


def _shown(df):
    return df.withColumns({c: fixed(c) for c in ("cut", "gain", "value")})


def _labelled(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"))
    return text_measures(table(spark, sf_dir, "documents")).join(labels, "doc_id")


LABELLED = f"SELECT m.*, quality FROM ({TEXT_SOURCE}) m JOIN labels USING (doc_id)"
LEAFWISE = boosting.Settings("leaf", rounds=5, rate=0.1, depth=0, leaves=4, l2=0.5, min_leaf=10, min_hessian=0.001)


@query("boost_leafwise", f"WITH {_source_sql(LABELLED, NUMERIC)}, {_tree_sql('t', LEAFWISE, 3, NUMERIC, 'quality = 1')} SELECT {', '.join(SHOWN)} FROM t")
def boost_leafwise(spark, sf_dir):
    """The first tree of four leaves, always splitting the leaf that gains most."""
    made = _grown(_labelled(spark, sf_dir), F.col("quality"), NUMERIC, 2, LEAFWISE)
    return _shown(spark.createDataFrame(_nodes(made.rounds[0][0], NUMERIC), KINDS))


LANGS = ("de", "en", "es", "fr")
SOFTMAX = boosting.Settings("level", rounds=5, depth=2, l2=1.0, min_hessian=1.0, min_gain=0.0)


@query(
    "boost_softmax",
    f"""
    WITH {_source_sql(TEXT_SOURCE, NUMERIC)}, {', '.join(_tree_sql(f't_{c}', SOFTMAX, 2, NUMERIC, f"lang = '{c}'") for c in LANGS)}
    {' UNION ALL '.join(f"SELECT '{c}' AS class, {', '.join(SHOWN)}, (SELECT count(*) FROM r) AS n_sum_to_one FROM t_{c}" for c in LANGS)}
    """,
)
def boost_softmax(spark, sf_dir):
    """The first round's tree of each language, fitted under shared probabilities; after five
    rounds all documents' probabilities sum to one without normalising."""
    rows = text_measures(table(spark, sf_dir, "documents"))
    label = F.array_position(F.array(*[F.lit(c) for c in LANGS]), F.col("lang")) - 1
    made = _grown(rows, label, NUMERIC, len(LANGS), SOFTMAX)
    nodes = [(c, *n) for c, tree in zip(LANGS, made.rounds[0]) for n in _nodes(tree, NUMERIC)]
    from pyspark.ml.functions import array_to_vector, vector_to_array

    packed = rows.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in NUMERIC])).alias("features"))
    scored = learners.fitted_stage(made).transform(packed).select(vector_to_array("probability").alias("p"))
    whole = F.aggregate("p", F.lit(0.0), lambda a, v: a + v)
    valid = scored.agg(F.count_if((F.abs(whole - 1) < 1e-12) & F.forall("p", lambda v: (v > 0) & (v < 1)))).first()[0]
    return _shown(spark.createDataFrame(nodes, f"class string, {KINDS}")).withColumn("n_sum_to_one", F.lit(valid).cast("bigint"))


STATS = f"""
    SELECT l.*, (coalesce(sum(quality) OVER w, 0) + q) / (count(quality) OVER w + 1) AS lang_rate
    FROM ({LABELLED}) l, (SELECT avg(quality) AS q FROM labels JOIN documents USING (doc_id))
    WINDOW w AS (PARTITION BY lang ORDER BY md5('54|' || CAST(doc_id AS VARCHAR)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""


def _with_rate(spark, sf_dir):
    return target_stats.ordered(_labelled(spark, sf_dir), "lang", {"lang_rate": F.col("quality")}, ["doc_id"])


@query("ordered_target_stats", f"SELECT doc_id, lang, quality, {fx('lang_rate', 9)} AS lang_rate FROM ({STATS})")
def ordered_target_stats(spark, sf_dir):
    """Each labelled document's language as the mean quality of those before it in md5 order."""
    return _with_rate(spark, sf_dir).select("doc_id", "lang", "quality", fixed("lang_rate", 9).alias("lang_rate"))


@query(
    "target_stats_whole",
    f"""
    SELECT doc_id, {fx('(coalesce(s, 0) + q) / (coalesce(n, 0) + 1)', 9)} AS lang_rate
    FROM documents JOIN (SELECT avg(quality) AS q FROM labels JOIN documents USING (doc_id)) ON true
    LEFT JOIN (SELECT lang, sum(quality) AS s, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY lang) USING (lang)
    """,
)
def target_stats_whole(spark, sf_dir):
    """What rows that come later get: the statistics of all labelled rows of their language."""
    fitted = target_stats.fit(_labelled(spark, sf_dir), "lang", {"lang_rate": F.col("quality")})
    return fitted.apply(table(spark, sf_dir, "documents").select("doc_id", "lang")).select("doc_id", fixed("lang_rate", 9).alias("lang_rate"))


WITH_RATE = (*NUMERIC, "lang_rate")
SYMMETRIC = boosting.Settings("symmetric", rounds=5, rate=0.03, depth=3, l2=3.0)


@query("boost_symmetric", f"WITH {_source_sql(STATS, WITH_RATE)}, {_tree_sql('t', SYMMETRIC, 3, WITH_RATE, 'quality = 1')} SELECT {', '.join(SHOWN)} FROM t")
def boost_symmetric(spark, sf_dir):
    """The first tree of three cuts, one per level, over numbers and the ordered statistics of the language."""
    made = _grown(_with_rate(spark, sf_dir), F.col("quality"), WITH_RATE, 2, replace(SYMMETRIC))
    return _shown(spark.createDataFrame([n for n in _nodes(made.rounds[0][0], WITH_RATE) if n[1]], KINDS))


EXACT = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EXACT_LEVELS, EXACT_SPLIT, EXACT_LEAF = 3, 100, 20


def _exact_sql() -> str:
    """Every value of every node tried as a cut, three levels deep."""
    long = " UNION ALL ".join(f"SELECT id, y, {i} AS f, CAST({f} AS DOUBLE) AS v FROM r" for i, f in enumerate(EXACT))
    keys = "path, f"
    ctes = [
        "r AS (SELECT row_number() OVER () AS id, l_returnflag AS y, * FROM lineitem WHERE l_returnflag IS NOT NULL)",
        "classes AS (SELECT y, row_number() OVER (ORDER BY y) AS k FROM (SELECT DISTINCT y FROM r))",
        f"long AS MATERIALIZED ({long})",
        "n0 AS (SELECT '' AS path, id FROM r)",
    ]
    squares = lambda x: " + ".join(f"CAST({x}{k} AS DOUBLE) * CAST({x}{k} AS DOUBLE)" for k in (1, 2, 3))
    for d in range(EXACT_LEVELS):
        counts = ", ".join(f"count(*) FILTER (k = {k}) AS c{k}" for k in (1, 2, 3))
        sums = ", ".join(f"sum(c{k}) OVER (PARTITION BY {keys} ORDER BY v) AS l{k}, sum(c{k}) OVER (PARTITION BY {keys}) AS t{k}" for k in (1, 2, 3))
        ctes += [
            f"v{d} AS (SELECT {keys}, v, {counts} FROM n{d} JOIN long USING (id) JOIN classes USING (y) GROUP BY {keys}, v)",
            f"s{d} AS (SELECT {keys}, v, lead(v) OVER (PARTITION BY {keys} ORDER BY v) AS after, {sums} FROM v{d})",
            f"u{d} AS (SELECT *, l1 + l2 + l3 AS nl, t1 + t2 + t3 AS n, t1 - l1 AS r1, t2 - l2 AS r2, t3 - l3 AS r3 FROM s{d})",
            f"""g{d} AS (SELECT {keys}, (v + after) / 2 AS cut, n, round((({squares('l')}) / nl + ({squares('r')}) / (n - nl) - ({squares('t')}) / n) / n, 12) AS gain
                FROM u{d} WHERE after IS NOT NULL AND n >= {EXACT_SPLIT} AND greatest(t1, t2, t3) < n AND nl >= {EXACT_LEAF} AND n - nl >= {EXACT_LEAF})""",
            f"b{d} AS (SELECT * FROM g{d} QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, cut) = 1)",
            f"""n{d + 1} AS (SELECT n.path || CASE WHEN l.v <= b.cut THEN 'L' ELSE 'R' END AS path, n.id
                FROM n{d} n JOIN b{d} b ON n.path = b.path JOIN long l ON l.id = n.id AND l.f = b.f)""",
        ]
    every = " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(EXACT_LEVELS + 1))
    cuts = " UNION ALL ".join(f"SELECT path, f, cut, gain FROM b{d}" for d in range(EXACT_LEVELS))
    names = "[" + ", ".join(f"'{f}'" for f in EXACT) + "]"
    return f"""WITH {", ".join(ctes)}, every AS ({every}), cuts AS ({cuts}),
        sizes AS (SELECT path, y, count(*) AS n, sum(count(*)) OVER (PARTITION BY path) AS total FROM every JOIN r USING (id) GROUP BY path, y),
        tops AS (SELECT * FROM sizes QUALIFY row_number() OVER (PARTITION BY path ORDER BY n DESC, y) = 1)
        SELECT path AS node, CAST(length(path) AS INTEGER) AS depth, CAST(total AS BIGINT) AS n_rows, {names}[f + 1] AS feature,
        {fx('cut')} AS cut, {fx('gain', 9)} AS gain, y AS prediction FROM tops LEFT JOIN cuts USING (path)"""


@query("exact_tree", _exact_sql())
def exact_tree_nodes(spark, sf_dir):
    """The first three levels of a tree that tries every price, quantity, discount and tax as a cut."""
    tree = exact_tree.grow(table(spark, sf_dir, "lineitem"), EXACT, "l_returnflag", EXACT_LEVELS, EXACT_SPLIT, EXACT_LEAF)
    return tree.described().withColumn("cut", fixed("cut")).withColumn("gain", fixed("gain", 9))
