"""Exact k nearest neighbours without pairing every test row with every train row.

Train rows are grouped into cells around pivots. From each cell's distances to its pivot
follow, by the triangle inequality, an upper bound for a test row's k-th nearest distance
and a lower bound for its distance to any row of a cell; cells whose lower bound exceeds
the upper bound cannot hold a neighbour and are never visited. The rest are visited block
by block: cells are cut into blocks of bounded size, so that a cell holding much of the
table is many tasks, and each block returns at most k candidates per test row. A block's
distances come from one matrix product, which only chooses rows whose distances are then
computed one by one, so rounding decides nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.hashing import key_digest
from sparktab.operators.support import spread_join
from sparktab.session import settled

BLOCK = 8192
#: Asked rows whose distances to a block are held at once.
ASKED = 512
MAX_PIVOTS = 512
SLACK = 1e-9


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64") if len(column) else np.zeros((0, 0))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] - 2.0 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.sqrt(np.maximum(square, 0.0))


def _pivots(train: DataFrame, key: str, features: str, n: int) -> np.ndarray:
    """A repeatable sample of train rows; its size is bounded by ``MAX_PIVOTS``."""
    count = max(1, min(MAX_PIVOTS, math.isqrt(n) // 2))
    rows = train.select(features).orderBy(key_digest([key], 0), key).limit(count).collect()
    return np.array([r[0] for r in rows], dtype="float64")


def _cells(train: DataFrame, key: str, features: str, label: str, pivots: np.ndarray, apart: str | None = None) -> DataFrame:
    """Train rows with their nearest pivot, written once as several passes read them."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = _distances(_matrix(batch["x"]), pivots)
                cell = d.argmin(1)
                yield batch.assign(cell=cell.astype("int32"), reach=d[np.arange(len(d)), cell])

    kind = dict(train.dtypes)[label]
    part = (F.lit(-1) if apart is None else F.col(apart)).cast("int").alias("part")
    rows = train.select(F.col(key).alias("neighbour"), F.col(features).cast("array<double>").alias("x"), F.col(label).alias("vote"), part)
    out = f"neighbour {dict(train.dtypes)[key]}, x array<double>, vote {kind}, part int, cell int, reach double"
    return settled(rows.mapInPandas(nearest, out), "cells")


def _cell_table(cells: DataFrame, k: int) -> pd.DataFrame:
    """Per cell and part: rows, widest and k smallest reaches. At most ``MAX_PIVOTS`` cells.

    The k smallest come from a ranking that drops all others before the shuffle.
    """
    by_reach = Window.partitionBy("cell", "part").orderBy("reach", "neighbour")
    closest = (
        cells.select("cell", "part", "reach", "neighbour")
        .withColumn("r", F.row_number().over(by_reach))
        .where(F.col("r") <= k)
        .groupBy("cell", "part")
        .agg(F.array_sort(F.collect_list("reach")).alias("closest"))
    )
    return (
        cells.groupBy("cell", "part")
        .agg(F.count("*").alias("n"), F.max("reach").alias("far"), F.min("reach").alias("near"))
        .join(closest, ["cell", "part"])
        .orderBy("cell", "part")
        .toPandas()
    )


def _visits(test: DataFrame, key: str, features: str, pivots: np.ndarray, table: pd.DataFrame, k: int, apart: str | None = None) -> DataFrame:
    """Test rows with the cells that may hold one of their neighbours."""
    whole = table.groupby("cell").agg({"far": "max", "near": "min"})
    ids = whole.index.to_numpy()
    centres, far, near = pivots[ids], whole["far"].to_numpy(), whole["near"].to_numpy()
    counts = [len(c) for c in table["closest"]]
    owner = np.repeat(np.searchsorted(ids, table["cell"].to_numpy()), counts)
    parts = np.repeat(table["part"].to_numpy(), counts)
    reach = np.concatenate([np.asarray(c, dtype="float64") for c in table["closest"]])

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            d = _distances(_matrix(batch["x"]), centres)
            upper = np.where(batch["part"].to_numpy()[:, None] == parts[None, :], np.inf, d[:, owner] + reach[None, :])
            bound = np.sort(upper, axis=1)[:, min(k, upper.shape[1]) - 1] * (1 + SLACK) + SLACK
            lower = np.maximum(d - far[None, :], near[None, :] - d)
            yield batch.assign(cell=[ids[row].tolist() for row in lower <= bound[:, None]])

    part = (F.lit(-2) if apart is None else F.col(apart)).cast("int").alias("part")
    rows = test.select(F.col(key).alias("asked"), F.col(features).cast("array<double>").alias("x"), part)
    chosen = rows.mapInPandas(choose, f"asked {dict(test.dtypes)[key]}, x array<double>, part int, cell array<int>")
    return chosen.withColumn("cell", F.explode("cell"))


def _spread(rows: DataFrame, id_column: str, pieces: dict[int, int], out: str) -> DataFrame:
    """Number the pieces of each cell and put each row into one of them."""
    count = F.element_at(F.array(*[F.lit(pieces.get(c, 1)) for c in range(max(pieces, default=0) + 1)]), F.col("cell") + 1)
    return rows.withColumn(out, F.pmod(F.xxhash64(id_column), count).cast("int"))


def _copied(rows: DataFrame, pieces: dict[int, int], out: str) -> DataFrame:
    """One copy of each row for every piece of its cell on the other side."""
    count = F.element_at(F.array(*[F.lit(pieces.get(c, 0)) for c in range(max(pieces, default=0) + 1)]), F.col("cell") + 1)
    return rows.withColumn(out, F.explode(F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: i < count)))


def ranked(rows: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k rows of a block nearest to each asked one (asked, neighbour, vote, distance2), parts of
    the same number left out; equal distances by neighbour. ``rows`` are sorted by neighbour."""
    points, found = _matrix(rows["x"]), []
    parts = rows["part"].to_numpy()
    norms = (points**2).sum(1)
    for at in range(0, len(asked), ASKED):
        some = asked.iloc[at : at + ASKED]
        x = _matrix(some["x"])
        near = norms[None, :] - 2.0 * x @ points.T + (x**2).sum(1)[:, None]
        near[some["part"].to_numpy()[:, None] == parts[None, :]] = np.inf
        last = np.partition(near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
        slack = 1e-9 * (norms.max(initial=0.0) + (x**2).sum(1)) + 1e-12
        q, p = np.nonzero((near <= (last + slack)[:, None]) & np.isfinite(near))
        exact = ((points[p] - x[q]) ** 2).sum(1)
        order = np.lexsort((p, exact, q))
        q, p, exact = q[order], p[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        found.append((some["asked"].to_numpy()[q[keep]], p[keep], exact[keep]))
    p = np.concatenate([f[1] for f in found])
    return pd.DataFrame(
        {"asked": np.concatenate([f[0] for f in found]), "neighbour": rows["neighbour"].to_numpy()[p], "vote": rows["vote"].to_numpy()[p], "distance2": np.concatenate([f[2] for f in found])}
    )


def nearest(
    train: DataFrame,
    test: DataFrame,
    key: str,
    features: str,
    label: str,
    k: int = 5,
    block: int = BLOCK,
    apart: str | None = None,
) -> DataFrame:
    """asked, neighbour, vote, distance2, place (1..k); equal distances by neighbour key.

    ``apart`` names an int column of both tables (from 0); rows of equal values are no neighbours,
    so that with a fold there every row is asked among the other folds at once.
    """
    n = train.count()
    pivots = _pivots(train, key, features, n)
    cells = _cells(train, key, features, label, pivots, apart)
    table = _cell_table(cells, k)
    visits = _visits(test, key, features, pivots, table, k, apart)
    visitors = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}

    width, sizes = len(pivots), table.groupby("cell")["n"].sum()
    train_pieces = {c: 0 for c in range(width)}
    train_pieces.update({int(c): math.ceil(m / block) for c, m in sizes.items()})
    test_pieces = {c: math.ceil(visitors.get(c, 0) / block) for c in range(width)}

    left = _copied(_spread(cells.drop("reach"), "neighbour", train_pieces, "tb"), test_pieces, "qb")
    right = _copied(_spread(visits, "asked", test_pieces, "qb"), train_pieces, "tb")
    kinds = dict(cells.dtypes)
    out = f"asked {dict(visits.dtypes)['asked']}, neighbour {kinds['neighbour']}, vote {kinds['vote']}, distance2 double"

    def scan(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"asked": [], "neighbour": [], "vote": [], "distance2": []})
        return ranked(rows.sort_values("neighbour", kind="stable"), asked, k)

    where = ["cell", "tb", "qb"]
    candidates = left.groupBy(*where).cogroup(right.groupBy(*where)).applyInPandas(scan, out)
    order = Window.partitionBy("asked").orderBy("distance2", "neighbour")
    return candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _voted(found: DataFrame, key: str) -> DataFrame:
    votes = found.groupBy("asked", "vote").agg(F.count("*").alias("n"))
    best = votes.groupBy("asked").agg(F.min(F.struct((-F.col("n")).alias("n"), "vote")).alias("best"))
    return best.select(F.col("asked").alias(key), F.col("best.vote").alias("prediction"))


def predict_nearest(
    train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, block: int = BLOCK, apart: str | None = None
) -> DataFrame:
    """key, prediction: the most frequent label among the k nearest, the lowest on ties."""
    return _voted(nearest(train, test, key, features, label, k, block, apart), key)


# --------------------------------------------------------------------- approximate


@dataclass(frozen=True)
class Planes:
    """Hash tables of random planes: a row's bucket in a table is the side it has of each plane.

    ``probes`` further buckets are asked per table: those across the planes that are nearest.
    """

    directions: np.ndarray
    shifts: np.ndarray
    probes: int

    def codes(self, x: np.ndarray, probes: int) -> np.ndarray:
        """(rows, tables, 1 + probes) bucket codes: the own one, then by single planes crossed, nearest first."""
        margin = np.einsum("nf,tbf->ntb", x, self.directions) + self.shifts[None]
        bits = 1 << np.arange(margin.shape[2], dtype=np.int64)
        own = ((margin > 0) * bits).sum(axis=2)
        cross = np.argsort(np.abs(margin), axis=2, kind="stable")[:, :, :probes]
        return np.concatenate([own[:, :, None], own[:, :, None] ^ bits[cross]], axis=2)


def fit_planes(train: DataFrame, features: str, tables: int = 12, rows_per_bucket: int = 64, probes: int = 6, seed: int = 54) -> Planes:
    """Planes through the table's middle, scaled by its deviations; as many as make buckets of
    about ``rows_per_bucket`` rows."""
    x = F.col(features).cast("array<double>")
    width = train.select(F.size(x).alias("n")).agg(F.max("n")).first()[0] or 1
    row = train.agg(F.count("*").alias("n"), *[f(F.get(x, F.lit(i))).alias(f"{f.__name__}_{i}") for i in range(width) for f in (F.avg, F.stddev_pop)]).first()
    middle = np.array([row[f"avg_{i}"] or 0.0 for i in range(width)])
    spread = np.array([row[f"stddev_pop_{i}"] or 0.0 for i in range(width)])
    planes = max(1, min(40, round(math.log2(max(row["n"] / rows_per_bucket, 2)))))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(tables, planes, width)) / np.where(spread > 0, spread, 1.0)
    return Planes(directions, -(directions @ middle), min(probes, planes))


def nearest_by_planes(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, planes: Planes | None = None, block: int = BLOCK) -> DataFrame:
    """asked, neighbour, vote, distance2, place: as ``nearest``, among the rows that share a bucket.

    Buckets are cut into blocks of bounded size like cells, so a bucket that holds much of
    the table is many tasks; candidates are ranked by their exact distances. A row with fewer than k
    candidates is asked again in the exact way, so every row has k neighbours (or all there are).
    """
    planes = planes or fit_planes(train, features)

    def bucketed(own: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    codes = planes.codes(_matrix(batch["x"]), own)
                    tables = np.arange(codes.shape[1], dtype=np.int64)[None, :, None] << 48
                    yield batch.assign(bucket=list((codes + tables).reshape(len(batch), -1)))

        return run

    kinds = dict(train.dtypes)
    rows = train.select(F.col(key).alias("neighbour"), F.col(features).cast("array<double>").alias("x"), F.col(label).alias("vote"), F.lit(-1).alias("part"))
    left = rows.mapInPandas(bucketed(0), f"neighbour {kinds[key]}, x array<double>, vote {kinds[label]}, part int, bucket array<bigint>").withColumn("bucket", F.explode("bucket"))
    asked = test.select(F.col(key).alias("asked"), F.col(features).cast("array<double>").alias("x"), F.lit(-2).alias("part"))
    right = asked.mapInPandas(bucketed(planes.probes), f"asked {dict(test.dtypes)[key]}, x array<double>, part int, bucket array<bigint>").withColumn("bucket", F.explode("bucket"))
    left, right = settled(left, "buckets"), settled(right, "asked")
    pieces = left.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("tn"))
    pieces = settled(pieces.join(right.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("qn")), "bucket"), "pieces")
    # each side is dealt over its own pieces and copied to every piece of the other
    left = spread_join(left, pieces, ["bucket"], spread=F.xxhash64("neighbour")).withColumn("tb", F.pmod(F.xxhash64("neighbour"), F.col("tn")).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qn") - 1)))
    right = spread_join(right, pieces, ["bucket"], spread=F.xxhash64("asked")).withColumn("qb", F.pmod(F.xxhash64("asked"), F.col("qn")).cast("int")).withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("tn") - 1)))
    out = f"asked {dict(test.dtypes)[key]}, neighbour {kinds[key]}, vote {kinds[label]}, distance2 double"

    def scan(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"asked": [], "neighbour": [], "vote": [], "distance2": []})
        return ranked(rows.sort_values("neighbour", kind="stable"), asked, k)

    where = ["bucket", "tb", "qb"]
    met = left.drop("tn", "qn").groupBy(*where).cogroup(right.drop("tn", "qn").groupBy(*where)).applyInPandas(scan, out)
    order = Window.partitionBy("asked").orderBy("distance2", "neighbour")
    best = settled(met.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "near")
    enough = best.where(F.col("place") == F.lit(min(k, train.count()))).select(F.col("asked").alias(key))
    poor = settled(test.join(enough, key, "left_anti"), "poor")
    if poor.isEmpty():
        return best
    exact = nearest(train, poor, key, features, label, k, block)
    return best.join(poor.select(F.col(key).alias("asked")), "asked", "left_anti").unionByName(exact)


def predict_by_planes(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, planes: Planes | None = None) -> DataFrame:
    """key, prediction: as ``predict_nearest``, among approximate neighbours."""
    return _voted(nearest_by_planes(train, test, key, features, label, k, planes), key)


@dataclass(frozen=True)
class NeighbourModel:
    """Rows that vote: prepared features, class codes and how many are asked."""

    prepared: PipelineModel
    rows: DataFrame
    classes: tuple[str, ...]
    key: str
    k: int = 5

    def features(self, df: DataFrame) -> DataFrame:
        return self.prepared.transform(df).withColumn("_x", vector_to_array("features"))

    def predict(self, df: DataFrame) -> DataFrame:
        """The input columns with prediction, probability (shares of the votes) and confidence."""
        found = nearest(self.features(self.rows), self.features(df), self.key, "_x", "label", self.k)
        share = [F.avg((F.col("vote") == float(i)).cast("double")) for i in range(len(self.classes))]
        voted = found.groupBy(F.col("asked").alias(self.key)).agg(F.array(*share).alias("probability"))
        top = F.array_position("probability", F.array_max("probability")).cast("int")
        named = voted.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), top))
        return df.join(named.withColumn("confidence", F.array_max("probability") * 100.0), self.key)
