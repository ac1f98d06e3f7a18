"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's letters give counts of byte bigrams and trigrams in ``BINS`` hashed bins. A vector
is the logarithm of the counts times the inverse document frequency, at length 1. Document
frequencies come from all training documents. Each language has several centroids,
clustered by cosine on a bounded sample of its training documents. A text has the
language of the nearest centroid; it is rejected if it is farther from it than
nearly all the centroid's own members are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import arrow, crc_mod, text_slices

BINS = 4_096
SLICE = 128
#: Bytes as read: ASCII letters in lower case, bytes of other characters, all else a blank.
KEPT = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def counts(text: str) -> np.ndarray:
    """How often the text's bigrams and trigrams fall into each bin."""
    data = np.frombuffer(b" ".join(text.lower().encode("utf-8", "replace").translate(KEPT).split()), dtype=np.uint8).astype(np.uint32)
    if len(data) < 2:
        return np.zeros(BINS, dtype=np.float32)
    two = (data[:-1] << 8) | data[1:]
    three = (two[:-1] << 8) | data[2:]
    bins = np.concatenate([two * np.uint32(2654435761), three * np.uint32(2246822519)]) >> np.uint32(20)
    return np.bincount(bins, minlength=BINS).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def clusters(rows: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` centroids by cosine, and the similarity below which 1 of 500 members is.

    The first is the row nearest to the mean, each further one the row farthest from those chosen.
    """
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(k, len(rows)):
        nearest = (rows @ rows[chosen].T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(np.argmin(nearest)))
    centres = rows[chosen]
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        centres = unit(np.stack([rows[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    near = rows @ centres.T
    own = near.argmax(axis=1)
    limit = [np.quantile(near[own == j, j], 0.002) if (own == j).any() else 1.0 for j in range(len(centres))]
    return centres, np.array(limit)


@dataclass
class Languages:
    """Centroids (rows), their languages and rejection limits, and the weights of bins."""

    weights: np.ndarray
    names: list[str]
    centres: np.ndarray
    limits: np.ndarray

    def vectors(self, found: np.ndarray) -> np.ndarray:
        return unit(np.log1p(found) * self.weights)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, cosine and whether it is rejected; ``und`` for a text without a letter."""
        out = []
        for at in range(0, len(texts), SLICE):
            part = texts[at : at + SLICE]
            near = self.vectors(np.stack([counts(t) for t in part])) @ self.centres.T if self.names else np.zeros((len(part), 0))
            for t, row in zip(part, near):
                if not self.names or not any(map(str.isalpha, t)):
                    out.append(("und", 0.0, True))
                    continue
                j = int(row.argmax())
                out.append((self.names[j], float(min(max(row[j], 0.0), 1.0)), bool(row[j] < self.limits[j])))
        return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bin and task: documents that have it. Bin -1 counts all documents."""
    have, n = np.zeros(BINS, dtype=np.int64), 0
    for batch in batches:
        for _, texts in text_slices(batch, "text"):
            for t in texts:
                have += counts(t) > 0
            n += len(texts)
    bins = np.flatnonzero(have)
    cells = [pa.array(np.r_[-1, bins]), pa.array(np.r_[n, have[bins]])]
    yield pa.RecordBatch.from_arrays(cells, schema=arrow("bin long, n long"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = arrow("lang string, counts binary")
    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([counts(t).tobytes() for t in texts], type=pa.binary())], schema=kinds)


def fit(training: DataFrame, sample: int = 2_000, centroids: int = 4) -> Languages:
    """Centroids from (text, lang, key) rows; rows with a NULL text or lang don't count.

    Document frequencies and language counts cover all rows. About ``sample`` rows, evenly
    from all languages and chosen by hash of ``key`` and text, are clustered on the driver.
    """
    rows = training.where("text IS NOT NULL AND lang IS NOT NULL").withColumn("lang", F.col("lang").cast("string"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Languages(np.ones(BINS), [], np.zeros((0, BINS)), np.zeros(0))
    have = {r["bin"]: r["n"] for r in rows.select("text").mapInArrow(_frequencies, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    n = have.pop(-1)
    weights = np.array([np.log((1 + n) / (1 + have.get(b, 0))) + 1 for b in range(BINS)], dtype=np.float32)
    each = max(20, sample // len(sizes))
    share = F.create_map(*[x for lang, size in sizes.items() for x in (F.lit(lang), F.lit(each / size))])
    even = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 20)) / float(1 << 20)
    some = rows.where(even < share[F.col("lang")]).select("lang", "text").mapInArrow(_counted, "lang string, counts binary").collect()
    model = Languages(weights, [], np.zeros((0, BINS)), np.zeros(0))
    centres, limits = [], []
    for lang in sorted({r["lang"] for r in some}):
        found = model.vectors(np.stack([np.frombuffer(r["counts"], dtype=np.float32) for r in some if r["lang"] == lang]))
        found = found[np.lexsort(found.T[:8])]  # the order that rows arrive in must not matter
        c, limit = clusters(found, centroids)
        centres.append(c)
        limits.append(limit)
        model.names += [lang] * len(c)
    model.centres = np.concatenate(centres) if centres else model.centres
    model.limits = np.concatenate(limits) if limits else model.limits
    return model


PREDICTION = "struct<lang_pred:string,score:double,rejected:boolean>"


def language(df: DataFrame, model: Languages, text: str = "text") -> Column:
    """lang_pred, score and rejected of a text column. The model has at most BINS numbers per centroid."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(held.value.predict(part.fillna("").tolist()), columns=["lang_pred", "score", "rejected"])

    return run(F.col(text))


def language_table(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document.

    Learned from documents whose crc32(doc_id) mod 3 is not 1; a NULL doc_id is neither
    learned from nor held out. ``lang_pred`` is the nearest language even where
    ``rejected`` says that it is too far; it is ``und`` for texts that are NULL or have no
    letter. Without any training document all are ``und``.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    training = slim.where(crc_mod("doc_id", 3) != 1).select("text", "lang", F.col("doc_id").alias("key"))
    found = slim.withColumn("found", language(docs, fit(training)))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "found.*")
