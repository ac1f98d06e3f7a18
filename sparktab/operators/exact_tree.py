"""A classification tree that tries every value as a cut, grown by level without a depth limit.

A level counts classes per (node, feature, value), where copies are combined before they are
shuffled, and range-sorts these counts into files. Each file adds up its own counts, and the
few sums per file are added up across files, so no task holds a whole feature of a node.
Only rows of nodes that were cut go on to the next level; nodes and cuts stay tables, since
a tree without a limit may have as many as there are rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.functions.scalar import measure
from sparktab.operators.support import SMALL_ROWS, lookup
from sparktab.session import settled


@dataclass(frozen=True)
class ExactTree:
    """``nodes``: node (its path of L and R from the root ''), n, c0.. (rows of each class), f, cut, gain; leaves lack the last three."""

    features: tuple[str, ...]
    classes: tuple
    means: tuple[float, ...]
    depth: int
    nodes: DataFrame

    def described(self) -> DataFrame:
        """node, depth, n_rows, feature, cut, gain, prediction."""
        names = F.array(*[F.lit(f) for f in self.features])
        return self.nodes.select(
            "node", F.length("node").alias("depth"), F.col("n").alias("n_rows"), F.when(F.col("f").isNotNull(), names[F.col("f")]).alias("feature"),
            "cut", "gain", self._majority().alias("prediction"),
        )

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """All rows of ``df`` with their leaf's most frequent class, the first one at a tie."""
        routed = df.withColumn("_x", _vector(self.features, self.means)).withColumn("node", F.lit(""))
        small = self.nodes.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
        for depth in range(self.depth):
            cuts = self.nodes.where((F.length("node") == depth) & F.col("f").isNotNull()).select("node", "f", "cut")
            routed = lookup(routed, cuts, ["node"], small, "left").withColumn("node", _next_node()).drop("f", "cut")
            if depth % 8 == 7:
                routed = settled(routed, "routed")
        leaves = self.nodes.where("f IS NULL").select("node", self._majority().alias(prediction))
        return lookup(routed, leaves, ["node"], small, "left").drop("node", "_x")

    def _majority(self) -> Column:
        if not self.classes:  # grown without rows
            return F.lit(None).cast("string")
        counts = F.array(*[F.col(f"c{k}") for k in range(len(self.classes))])
        return F.array(*[F.lit(c) for c in self.classes])[F.array_position(counts, F.array_max(counts)).cast("int") - 1]


def _vector(features: Sequence[str], means: Sequence[float]) -> Column:
    return F.array(*[F.coalesce(measure(f), F.lit(m)) for f, m in zip(features, means)])


def _next_node() -> Column:
    """The child that a row goes to; a row of a node without a cut stays."""
    side = F.when(F.col("f").isNull(), "").when(F.col("_x")[F.col("f")] <= F.col("cut"), "L").otherwise("R")
    return F.concat("node", side)


def _squares(counts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("double") * c.cast("double") for c in counts])


def _best_cuts(active: DataFrame, classes: int, min_split: int, min_leaf: int) -> DataFrame:
    """node, f, cut, gain: of each node that can be cut, the cut that lowers Gini impurity most; at a tie the first feature's lowest."""
    ks = range(classes)
    values = active.select("node", "_y", F.posexplode("_x").alias("f", "v"))
    counted = values.groupBy("node", "f", "v").agg(*[F.count_if(F.col("_y") == k).alias(f"c{k}") for k in ks])
    entries = settled(counted.repartitionByRange("node", "f", "v"), "tree-values")
    entries = entries.withColumn("part", entries.metadataColumn("_metadata")["file_path"])
    sums = entries.groupBy("node", "f", "part").agg(*[F.sum(f"c{k}").alias(f"s{k}") for k in ks], F.min("v").alias("first"))
    whole = Window.partitionBy("node", "f")
    ordered = whole.orderBy("first")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "node", "f", "part", F.lead("first").over(ordered).alias("following"),
        *[F.coalesce(F.sum(f"s{k}").over(before), F.lit(0)).alias(f"b{k}") for k in ks],
        *[F.sum(f"s{k}").over(whole).alias(f"t{k}") for k in ks],
    )
    inside = Window.partitionBy("node", "f", "part").orderBy("v")
    until = inside.rowsBetween(Window.unboundedPreceding, 0)
    running = entries.select("node", "f", "part", "v", F.lead("v").over(inside).alias("after"), *[F.sum(f"c{k}").over(until).alias(f"r{k}") for k in ks])
    left = [F.col(f"b{k}") + F.col(f"r{k}") for k in ks]
    total = [F.col(f"t{k}") for k in ks]
    right = [t - x for t, x in zip(total, left)]
    n, nl = (reduce(lambda a, b: a + b, part) for part in (total, left))
    following = F.coalesce("after", "following")
    middle = (F.col("v") + following) / 2
    tried = running.join(starts, ["node", "f", "part"]).where(
        following.isNotNull() & (n >= min_split) & (F.greatest(*total, F.lit(0)) < n) & (nl >= min_leaf) & (n - nl >= min_leaf)
    )
    gain = (_squares(left) / nl + _squares(right) / (n - nl) - _squares(total) / n) / n
    tried = tried.select("node", F.struct((-F.round(gain, 12)).alias("loss"), "f", F.when(middle < following, middle).otherwise(F.col("v")).alias("cut")).alias("c"))
    return tried.groupBy("node").agg(F.min("c").alias("c")).select("node", "c.f", "c.cut", (-F.col("c.loss")).alias("gain"))


def grow(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1) -> ExactTree:
    """Grows until each node is pure, too small or alike in all features, or ``max_depth`` deep.

    Cuts lie halfway between neighbouring values; a row goes left up to the cut. An impure node
    is cut even if its best cut gains nothing. A missing measurement counts as the training
    mean; rows without a label are left out. The driver holds the classes and one mean per feature.
    """
    known = df.where(F.col(label).isNotNull())
    classes = tuple(r[0] for r in known.select(label).distinct().orderBy(label).collect())
    found = known.agg(*[F.avg(measure(f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    means = tuple(0.0 if m is None else float(m) for m in found)
    ks = range(len(classes))
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("int") - 1 if classes else F.lit(0)
    active = settled(known.select(F.lit("").alias("node"), _vector(features, means).alias("_x"), number.alias("_y")), "tree-rows")
    levels, depth = [], 0
    while classes:
        sizes = active.groupBy("node").agg(F.count("*").alias("n"), *[F.count_if(F.col("_y") == k).alias(f"c{k}") for k in ks])
        if depth == max_depth:
            nothing = [F.lit(None).cast(t).alias(c) for c, t in (("f", "int"), ("cut", "double"), ("gain", "double"))]
            levels.append(settled(sizes.select("*", *nothing), "tree-nodes"))
            break
        cuts = settled(_best_cuts(active, len(classes), min_samples_split, min_samples_leaf), "tree-cuts")
        levels.append(settled(sizes.join(cuts, ["node"], "left"), "tree-nodes"))
        count = cuts.count()
        if not count:
            break
        active = settled(lookup(active, cuts.drop("gain"), ["node"], count <= SMALL_ROWS).withColumn("node", _next_node()).drop("f", "cut"), "tree-rows")
        depth += 1
    schema = "node string, n long, f int, cut double, gain double"
    nodes = reduce(DataFrame.unionByName, levels) if levels else df.sparkSession.createDataFrame([], schema)
    return ExactTree(tuple(features), classes, means, depth, nodes)
