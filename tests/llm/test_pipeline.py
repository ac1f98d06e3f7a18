import glob

import corpus_pipeline
from llm_fixtures import SCHEMA, prose

from sparktab.llm import decontaminate, mixing, queries, simhash, toxicity


def test_stage_names_and_queries():
    import __spark_entry__ as entry

    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "benchmark decontamination", "mixing to target weights", "sharding"]
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())


def test_each_stage_against_its_plain_form(spark, tables):
    """Every stage's rows, from its own input, without Spark."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("labels", "benchmark"))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.settled(stage(spark, docs, tables), "stage")
        rows, kept = [tuple(r) for r in docs.collect()], [tuple(r) for r in out.select(*columns).collect()]
        if name == "toxicity":
            machine = toxicity.trained(docs, labels)
            reader = toxicity.Reader(machine)
            want = [r for r in rows if machine.score(reader.tops([r[1]]))[0] < 0.3]
        elif name == "near duplicates":
            fps, want = {}, []
            for r in sorted(rows):
                mine = simhash.fingerprint(r[1].encode())
                near = {g for g, members in fps.items() if any((mine ^ m).bit_count() <= 2 for m in members)}
                group = min(near) if near else r[0]
                fps[group] = [mine, *(m for g in near for m in fps.pop(g))]
            want = [r for r in rows if r[0] in fps]
        elif name == "benchmark decontamination":
            index = decontaminate.Index([(r["item_id"], *decontaminate.question_and_answer(r["text"])) for r in items.collect()])
            want = [r for r in rows if not index.leaks(r[1], 0.5, 0.8)]
        else:
            want = rows
        if name.startswith("mixing"):
            assert set(kept) == set(want) and len(kept) >= len(want)
        else:
            assert sorted(kept) == sorted(want), name
        if name != "sharding":
            assert out.columns == columns
        seen.append(len(kept))
        docs = out
    assert seen[0] > seen[1] > seen[2] <= seen[3] == seen[4]


def test_run_on_odd_and_empty_tables(spark, odd, tmp_path):
    labels = spark.createDataFrame([(i, 1, int(i == 4)) for i in range(30)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, prose(3, 50))], "item_id long, text string")
    for name, docs in (("odd", odd), ("none", spark.createDataFrame([], SCHEMA))):
        folder = str(tmp_path / name)
        for table, rows in (("documents", docs), ("labels", labels), ("benchmark", items)):
            rows.write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == [*docs.columns, "shard", "slot"]
        n = [r["n"] for r in out.groupBy("shard").count().withColumnRenamed("count", "n").collect()]
        assert (not n) == (name == "none") and (not n or max(n) - min(n) <= 1)


def test_mix_stage_writes_the_scheduled_order(spark, tmp_path):
    import pyarrow.parquet as pq

    spark.createDataFrame([(i, f"s{min(i % 7, 2)}") for i in range(900)], "doc_id long, source string").write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    corpus_pipeline.mix_sources(spark, docs, "").write.parquet(f"{tmp_path}/out")
    got = [i for f in sorted(glob.glob(f"{tmp_path}/out/part-*")) for i in pq.read_table(f)["doc_id"].to_pylist()]
    want = [r["doc_id"] for r in mixing.mixed(docs, scan=True).orderBy("block_slot", "place").collect()]
    assert got == want
