"""Catalogue: the tables behind charts, and relations between columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.operators import charts, clean, relate
from sparktab.plans.profiling import MEASURES
from sparktab.plans.registry import fixed, fx, query, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "value")


# ----------------------------------------------------------------------- histograms


def _histogram_sql(edges: str, group: str | None = None) -> str:
    """Histogram of events.value given a query for (group, low, high, bins)."""
    g = f"{group}, " if group else ""
    on = f"USING ({group})" if group else "ON true"
    return f"""
    WITH e AS ({edges}),
    c AS (
        SELECT {g}CAST(least(CASE WHEN high > low THEN floor((value - low) / ((high - low) / bins)) ELSE 0 END,
                        bins - 1) AS BIGINT) AS bin, count(*) AS n
        FROM events JOIN e {on} GROUP BY ALL),
    b AS (SELECT e.*, CAST(unnest(generate_series(0, CAST(bins - 1 AS BIGINT))) AS BIGINT) AS bin FROM e)
    SELECT {g}'value' AS "column", b.bin, {fx('low + b.bin * ((high - low) / bins)')} AS "left",
           {fx('low + (b.bin + 1) * ((high - low) / bins)')} AS "right",
           CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM b LEFT JOIN c USING ({g}bin)
    """


def _shown(df):
    return df.withColumn("left", fixed("left")).withColumn("right", fixed("right"))


@query(
    "hist_auto",
    _histogram_sql(
        """
        SELECT low, high, CAST(CASE WHEN high > low THEN ceil((high - low) / CASE
                   WHEN 2.0 * iqr * pow(n, CAST(-1 AS DOUBLE) / 3) > 0
                   THEN least((high - low) / (log2(n) + 1), CAST(2 AS DOUBLE) * iqr * pow(n, CAST(-1 AS DOUBLE) / 3))
                   ELSE (high - low) / (log2(n) + 1) END) ELSE 1 END AS BIGINT) AS bins
        FROM (SELECT count(value) AS n, min(value) AS low, max(value) AS high,
                     quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events)
        """
    ),
)
def hist_auto(spark, sf_dir):
    return _shown(charts.histogram(_events(spark, sf_dir), ["value"]))


@query(
    "hist_fixed30",
    _histogram_sql("SELECT min(value) AS low, max(value) AS high, 30 AS bins FROM events"),
)
def hist_fixed30(spark, sf_dir):
    return _shown(charts.histogram(_events(spark, sf_dir), ["value"], bins=30))


@query(
    "hist_group20",
    _histogram_sql(
        "SELECT event_type, min(value) AS low, max(value) AS high, 20 AS bins FROM events GROUP BY event_type",
        "event_type",
    ),
)
def hist_group20(spark, sf_dir):
    """Each category over its own range."""
    return _shown(charts.histogram(_events(spark, sf_dir), ["value"], bins=20, by=["event_type"]))


# -------------------------------------------------------------------------- density


@query(
    "kde_grid",
    f"""
    WITH s AS (
        SELECT count(value) AS n, stddev_samp(value) * pow(count(value), CAST(-0.2 AS DOUBLE)) AS h,
               min(value) AS lo, (max(value) - min(value)) / 99 AS step FROM events),
    g AS (SELECT n, h, lo, step, CAST(unnest(generate_series(0, 99)) AS INTEGER) AS point FROM s)
    SELECT 'value' AS "column", point, {fx('any_value(lo) + point * any_value(step)')} AS x,
           {fx('sum(exp(CAST(-0.5 AS DOUBLE) * pow((lo + point * step - value) / h, 2)))'
               ' / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 8)} AS density
    FROM events, g GROUP BY point
    """,
)
def kde_grid(spark, sf_dir):
    out = charts.density(_events(spark, sf_dir), ["value"], points=100)
    return out.withColumn("x", fixed("x")).withColumn("density", fixed("density", 8))


@query(
    "kde_binned",
    f"""
    WITH s AS (
        SELECT count(value) AS n, stddev_samp(value) * pow(count(value), CAST(-0.2 AS DOUBLE)) AS h,
               min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT least(floor((value - lo) / ((hi - lo) / 4096)), 4095) AS bin, avg(value) AS value,
                 count(*) AS weight FROM events, s GROUP BY bin),
    g AS (SELECT n, h, lo, (hi - lo) / 199 AS step, CAST(unnest(generate_series(0, 199)) AS INTEGER) AS point FROM s)
    SELECT 'value' AS "column", point, {fx('any_value(lo) + point * any_value(step)')} AS x,
           {fx('sum(weight * exp(CAST(-0.5 AS DOUBLE) * pow((lo + point * step - value) / h, 2)))'
               ' / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 8)} AS density
    FROM b, g GROUP BY point
    """,
)
def kde_binned(spark, sf_dir):
    """The form for very long columns: kernels over counted bins."""
    out = charts.density(_events(spark, sf_dir), ["value"], points=200, method="binned")
    return out.withColumn("x", fixed("x")).withColumn("density", fixed("density", 8))


@query(
    "violin_stats",
    f"""
    WITH s AS (
        SELECT event_type, count(value) AS n, stddev_samp(value) * pow(count(value), CAST(-0.2 AS DOUBLE)) AS h,
               min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1,
               quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
        FROM events GROUP BY event_type),
    g AS (SELECT event_type, n, h, q1, median, q3, lo - 2 * h AS lo, (hi - lo + 4 * h) / 99 AS step,
                 CAST(unnest(generate_series(0, 99)) AS INTEGER) AS point FROM s)
    SELECT event_type, 'value' AS "column", point, {fx('any_value(lo) + point * any_value(step)')} AS x,
           {fx('sum(exp(CAST(-0.5 AS DOUBLE) * pow((lo + point * step - value) / h, 2)))'
               ' / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 8)} AS density,
           {fx('any_value(q1)')} AS q1, {fx('any_value(median)')} AS median, {fx('any_value(q3)')} AS q3
    FROM events JOIN g USING (event_type) GROUP BY event_type, point
    """,
)
def violin_stats(spark, sf_dir):
    out = charts.violin(_events(spark, sf_dir), ["value"], ["event_type"]).withColumn("density", fixed("density", 8))
    for name in ("x", "q1", "median", "q3"):
        out = out.withColumn(name, fixed(name))
    return out


# ---------------------------------------------------------------------------- boxes


def _box_sql(group: str | None = None, source: str = "events") -> str:
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    on = f"JOIN f USING ({group})" if group else ", f"
    return f"""
    SELECT {g}'value' AS "column", CAST(count(*) AS BIGINT) AS n, {fx('any_value(q1)')} AS q1,
           {fx('any_value(median)')} AS median, {fx('any_value(q3)')} AS q3,
           {fx('min(value) FILTER (value >= q1 - CAST(1.5 AS DOUBLE) * (q3 - q1))')} AS whisker_low,
           {fx('max(value) FILTER (value <= q3 + CAST(1.5 AS DOUBLE) * (q3 - q1))')} AS whisker_high,
           CAST(count(*) FILTER (value < q1 - CAST(1.5 AS DOUBLE) * (q3 - q1)
                              OR value > q3 + CAST(1.5 AS DOUBLE) * (q3 - q1)) AS BIGINT) AS n_fliers
    FROM {source} {on.replace(' f', f' (SELECT {g}quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM {source} {by}) f')}
    {by}
    """


BOX_NUMBERS = ("q1", "median", "q3", "whisker_low", "whisker_high")


def _box_shown(df, suffixes=("",)):
    for name in BOX_NUMBERS:
        for s in suffixes:
            df = df.withColumn(name + s, fixed(name + s))
    return df


@query("box_stats", _box_sql())
def box_stats(spark, sf_dir):
    return _box_shown(charts.box_stats(_events(spark, sf_dir), ["value"]))


@query("box_by_group", _box_sql("event_type"))
def box_by_group(spark, sf_dir):
    return _box_shown(charts.box_stats(_events(spark, sf_dir), ["value"], ["event_type"]))


_STATS = ("n", *BOX_NUMBERS, "n_fliers")


@query(
    "box_before_after",
    f"""
    WITH k AS (
        SELECT event_type, value
        FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events) WHERE abs((value - m) / sd) < 3),
    b AS ({_box_sql('event_type')}),
    a AS ({_box_sql('event_type', 'k')})
    SELECT event_type, "column", {', '.join(f'b.{c} AS {c}_before' for c in _STATS)},
           {', '.join(f'a.{c} AS {c}_after' for c in _STATS)}, b.n - a.n AS rows_removed,
           {fx('(a.q3 - a.q1) - (b.q3 - b.q1)', 5)} AS iqr_change, a.n_fliers - b.n_fliers AS fliers_change
    FROM b JOIN a USING (event_type, "column")
    """,
)
def box_before_after(spark, sf_dir):
    """Box statistics before and after the three-deviation filter."""
    rows = _events(spark, sf_dir)
    before = charts.box_stats(rows, ["value"], ["event_type"])
    after = charts.box_stats(clean.zscore_filter(rows, ["value"]), ["value"], ["event_type"])
    out = charts.compare_boxes(before, after, ["event_type"])
    return _box_shown(out, ("_before", "_after")).withColumn("iqr_change", fixed("iqr_change", 5))


# ------------------------------------------------------------------------ relations

_PAIRS = [(MEASURES[i], MEASURES[j], i, j) for i in range(len(MEASURES)) for j in range(i)]


@query(
    "corr_lower",
    " UNION ALL ".join(
        f"SELECT {i} AS position_a, '{a}' AS a, {j} AS position_b, '{b}' AS b, {fx(f'corr({a}, {b})', 9)} AS r FROM lineitem"
        for a, b, i, j in _PAIRS
    ),
)
def corr_lower(spark, sf_dir):
    return relate.correlations(table(spark, sf_dir, "lineitem"), MEASURES).withColumn("r", fixed("r", 9))


@query(
    "corr_long",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + ("CAST(1 AS DOUBLE)" if a == b else fx(f"corr({a}, {b})", 9))
        + " AS r FROM lineitem"
        + (" HAVING count(*) > 0" if a == b else "")
        for a in MEASURES
        for b in MEASURES
    ),
)
def corr_long(spark, sf_dir):
    return relate.correlation_matrix(table(spark, sf_dir, "lineitem"), MEASURES).withColumn("r", fixed("r", 9))


@query(
    "corr_with_score",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature, {fx(f'corr({a}, l_extendedprice)', 9)} AS r, "
        f"{fx(f'abs(corr({a}, l_extendedprice))', 9)} AS strength, "
        f"CASE WHEN corr({a}, l_extendedprice) > 0 THEN 'positive' ELSE 'negative' END AS sign FROM lineitem"
        for a in MEASURES
        if a != "l_extendedprice"
    ),
)
def corr_with_score(spark, sf_dir):
    out = relate.score_correlations(table(spark, sf_dir, "lineitem"), MEASURES, "l_extendedprice")
    return out.withColumn("r", fixed("r", 9)).withColumn("strength", fixed("strength", 9))


@query(
    "group_means",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS \"column\", {fx(f'avg({c})', 3)} AS mean FROM lineitem GROUP BY l_returnflag"
        for c in MEASURES
    ),
)
def group_means(spark, sf_dir):
    out = relate.group_means(table(spark, sf_dir, "lineitem"), MEASURES, "l_returnflag")
    return out.withColumn("mean", fixed("mean", 3))


@query(
    "group_means_scaled",
    "WITH m AS ("
    + " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS \"column\", avg({c}) AS mean FROM lineitem GROUP BY l_returnflag"
        for c in MEASURES
    )
    + f"""), r AS (SELECT "column", min(mean) AS lo, max(mean) AS hi FROM m GROUP BY "column")
    SELECT l_returnflag, "column", {fx('mean', 3)} AS mean,
           {fx('(mean - lo) / (hi - lo + CAST(1e-9 AS DOUBLE))')} AS scaled
    FROM m JOIN r USING ("column")
    """,
)
def group_means_scaled(spark, sf_dir):
    out = relate.scaled_group_means(table(spark, sf_dir, "lineitem"), MEASURES, "l_returnflag")
    return out.withColumn("mean", fixed("mean", 3)).withColumn("scaled", fixed("scaled"))


def _crosstab_sql(rows: str, a: str, b: str) -> str:
    return f"""
    WITH x AS ({rows}), c AS (SELECT {a}, {b}, count(*) AS n FROM x GROUP BY ALL),
    t AS (SELECT {a}, sum(n) AS total FROM c GROUP BY {a}),
    p AS (SELECT t.{a}, v.{b}, total FROM t, (SELECT DISTINCT {b} FROM x) v)
    SELECT p.{a}, p.{b}, CAST(coalesce(n, 0) AS BIGINT) AS n,
           {fx('coalesce(n, 0) * CAST(100.0 AS DOUBLE) / total')} AS pct
    FROM p LEFT JOIN c ON p.{a} = c.{a} AND p.{b} = c.{b}
    """


@query(
    "crosstab_pct",
    _crosstab_sql("SELECT l_returnflag, l_linestatus FROM lineitem", "l_returnflag", "l_linestatus"),
)
def crosstab_pct(spark, sf_dir):
    out = relate.crosstab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    return out.withColumn("pct", fixed("pct"))


@query(
    "crosstab_joined",
    _crosstab_sql("SELECT lang, quality FROM documents JOIN labels USING (doc_id)", "lang", "quality"),
)
def crosstab_joined(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return relate.crosstab(rows, "lang", "quality").withColumn("pct", fixed("pct"))
