import zlib

import numpy as np
from llm_fixtures import SCHEMA, prose

from sparktab.llm import language


def test_vectors_by_definition():
    text = "Äb, c1D"
    data = b" ".join("äb, c1d".encode().translate(language.KEPT).split())
    assert data == "äb c d".encode()
    want = np.zeros(language.BINS)
    for k, prime in ((2, 2654435761), (3, 2246822519)):
        for i in range(len(data) - k + 1):
            want[(int.from_bytes(data[i : i + k], "big") * prime % 2**32) >> 20] += 1
    assert (language.counts(text) == want).all()
    assert language.counts("").sum() == 0 == language.counts("7 .").sum()


def test_clusters_find_groups():
    rng = np.random.default_rng(2)
    rows = language.unit(np.concatenate([np.eye(6)[k] + rng.normal(0, 0.05, (50, 6)) for k in range(3)]))
    centres, limits = language.clusters(rows, 3)
    assert sorted(np.argmax(centres, axis=1).tolist()) == [0, 1, 2] and (limits > 0.9).all()
    assert len(language.clusters(np.tile(rows[:1], (5, 1)), 4)[0]) == 1


def test_held_out_accuracy_and_rule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.language_table(docs).collect()
    assert len(rows) == len(known)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == known[r["doc_id"]] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and np.mean([r["rejected"] for r in rows]) < 0.05


def test_rows_by_hand_equal_the_table(spark):
    """Nearest centroids, text by text, give the table's rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    training = docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 <> 1").selectExpr("text", "lang", "doc_id AS key")
    model = language.fit(training)
    texts = [r["text"] for r in training.collect()]
    have = sum(language.counts(t) > 0 for t in texts)
    assert np.allclose(model.weights, np.log((1 + len(texts)) / (1 + have)) + 1)
    by_doc = {r["doc_id"]: r for r in language.language_table(docs).collect()}
    for r in docs.collect():
        v = np.log1p(language.counts(r["text"])) * model.weights
        near = model.centres @ (v / np.linalg.norm(v))
        assert by_doc[r["doc_id"]]["lang_pred"] == model.names[int(near.argmax())]
        assert abs(by_doc[r["doc_id"]]["score"] - near.max()) < 1e-5


def test_odd_tables(odd, nothing, clashing, odd_rows):
    out = language.language_table(odd).collect()
    assert len(out) == len(odd_rows)
    by = {r["doc_id"]: r for r in out}
    assert {by[i]["lang_pred"] for i in (60, 61, 62)} == {"und"} and by[63]["lang_pred"] != "und"
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)
    assert language.language_table(nothing).count() == 0 and language.language_table(clashing).count() == len(odd_rows)
    unlabelled = odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in language.language_table(unlabelled).collect()} == {"und"}


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.selectExpr("text", "lang", "doc_id AS key"))
    assert model.predict(["日本語の文章です。これは長い文章で、学習していません。" * 5])[0][2]


def test_number_forms_are_no_letters(spark):
    rows = [(i, prose(i, 30), "en" if i % 2 else "de", "s", 1) for i in range(40)] + [(100, "① ② ③", "en", "s", 1), (101, "Ⅷ ² ½", "de", "s", 1), (102, "ª", "de", "s", 1)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.language_table(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[100] == got[101] == "und" != got[102]
