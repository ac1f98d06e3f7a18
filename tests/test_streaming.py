from pyspark.sql import functions as F

from sparktab.operators import attribution, evaluate, validate
from sparktab.operators.attribution import LinearModel
from sparktab.session import fresh_path
from sparktab.streaming import flows

MODEL = LinearModel(("x",), ("a", "b"), ((1.0,), (-1.0,)), (0.0, 0.0), (4.5,))


def _folder(spark):
    """Three files of records."""
    folder = fresh_path(spark, "in")
    rows = spark.range(30).select(
        F.col("id").alias("key"),
        (F.col("id") % 10 - 4.5).cast("double").alias("x"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).alias("ts"),
    )
    rows.repartition(3).write.parquet(folder)
    return folder, rows


def _run(query):
    query.awaitTermination()


def test_scored_stream_equals_batch(spark):
    folder, rows = _folder(spark)
    out = fresh_path(spark, "out")
    stream = flows.read_stream(spark, folder, rows.schema)
    _run(flows.write_tables(flows.score_stream(stream, MODEL, ["key"]), out, fresh_path(spark, "cp")))
    got = {r["key"]: r["result"] for r in spark.read.parquet(out).collect()}
    assert got == {r["key"]: r["result"] for r in attribution.score(rows, MODEL, ["key"]).collect()}


def test_routed_stream_keeps_every_record_once(spark):
    folder, rows = _folder(spark)
    good, bad, cp = (fresh_path(spark, n) for n in ("good", "bad", "cp"))
    rules = [validate.InRange("x", 0, 3)]
    for _ in range(2):  # a second run finds nothing new
        _run(flows.route_stream(flows.read_stream(spark, folder, rows.schema), rules, good, bad, cp))
    checked = validate.with_violations(rows, rules)
    assert spark.read.parquet(good).count() == validate.accepted(checked).count()
    assert spark.read.parquet(bad).count() == validate.rejected(checked).count()


def test_deduplicated_stream(spark):
    folder, rows = _folder(spark)
    out = fresh_path(spark, "out")
    stream = flows.read_stream(spark, folder, rows.schema)
    _run(flows.write_tables(flows.dedup_stream(stream, ["x"], "ts", "1 day"), out, fresh_path(spark, "cp")))
    assert spark.read.parquet(out).count() == 10


def test_triage_counts_per_window(spark):
    folder, rows = _folder(spark)
    out = fresh_path(spark, "out")
    scored = attribution.with_scores(flows.read_stream(spark, folder, rows.schema), MODEL)
    _run(flows.write_batches(flows.triage_stream(scored, "ts", "1 hour", "1 day"), out, fresh_path(spark, "cp")))
    got = spark.read.parquet(out).groupBy("window_start", "prediction", "borderline").agg(F.max_by("n", "batch").alias("n"))
    expected = evaluate.triage(attribution.with_scores(rows, MODEL), by=[F.window("ts", "1 hour").alias("w")])
    flat = expected.select(F.col("w.start").alias("window_start"), "prediction", "borderline", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flat.collect()))


def test_a_table_streams_as_a_file_and_as_a_folder(spark, tmp_path):
    """All its rows and those of no other table, however it lies in the folder of tables."""
    rows = spark.range(30).withColumn("x", F.col("id") * 0.5)
    folder = str(tmp_path)
    rows.repartition(3).write.parquet(f"{folder}/many.parquet")
    rows.limit(4).write.parquet(f"{folder}/many.parquet.old")
    rows.toPandas().to_parquet(f"{folder}/one.parquet")
    for name in ("many.parquet", "one.parquet"):
        out = fresh_path(spark, "out")
        _run(flows.write_tables(flows.read_table_stream(spark, folder, rows.schema, name), out, fresh_path(spark, "cp")))
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(30))
