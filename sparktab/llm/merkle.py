"""A Merkle manifest of a dataset, with an inclusion proof for every row.

Every row is a leaf, the digest of its named columns. The leaves of a source ascend by key;
runs of 16 consecutive nodes become one node until a single one is left, the source's
subroot; the subroots, in the order of their sources, likewise become the root.

A leaf's rank is written in base 16. Blocks of 16^2 leaves are exchanged once, and there the
rank's digits are grouped away one after the other, each time nesting the children as an
array of structs in their parent. A block is thus one row that holds its whole subtree, and
its top digest is a leaf of the next tier, which is built alike: 5 * 10^10 rows need five
tiers. On the way down a tier's rows hand their siblings to the nested children by
``transform`` and ``explode``, without a join of leaves; only block rows, one for 256
leaves, are matched with the proofs of the tier above. No row of any tier grows with the
table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.llm.common import FILE, ROW, crc_mod, positions
from sparktab.session import settled

FAN = 16
DIGITS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The siblings of one level: what stands left and right of a node in its run.
STEP = "array<struct<left:string,right:string>>"


def digest(*inputs: Column) -> Column:
    """H: the lowercase hex SHA-256 of the inputs one after the other."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value as a leaf takes it: ``-`` for NULL, else its UTF-8 byte count, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _numbered(rows: DataFrame, tree: str, order: Sequence[Column], stay: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0 in its tree, by ``order``) and ``n`` (rows of the tree).

    A range partition by tree and order, written so that it holds for good; the files'
    counts per tree, at most one per file and tree border, give each file's first rank.
    """
    keys = [F.col(tree).asc_nulls_first(), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = settled(ranged.select(*stay, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")), "ranks")
    pieces = dealt.groupBy("__part", F.col(tree).alias("__tree")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    all_of = Window.partitionBy("__tree")
    earlier = all_of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("__part").alias("__p"),
        "__tree",
        "__first",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(all_of).alias("n"),
    )
    same = (F.col("__part") == F.col("__p")) & F.col(tree).eqNullSafe(F.col("__tree"))
    rank = (F.col("__before") + F.col("__at") - F.col("__first")).alias("rank")
    return dealt.join(starts, same).select(*stay, rank, "n")


def _rolled(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """The blocks of ``nodes`` (tree, rank, n, digest, payload...): tree, rank, n, digest, kids.

    ``kids`` nests all below, one array of structs (at, digest, kids) per digit. A level is
    hashed only in trees where multiple nodes remain, else the single node is passed on.
    """
    at = [F.shiftright("rank", 4 * k).bitwiseAND(FAN - 1).cast("int").alias(f"__d{k}") for k in range(DIGITS)]
    block = F.shiftright("rank", 4 * DIGITS).alias("__block")
    rows = nodes.select("tree", "n", block, *at, "digest", *payload).repartition("tree", "__block")
    inside = list(payload)
    for k in range(DIGITS):
        keys = ["tree", "n", "__block", *[f"__d{j}" for j in range(k + 1, DIGITS)]]
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"__d{k}").alias("at"), "digest", *inside)))
        rows = rows.groupBy(*keys).agg(kids.alias("kids"))
        remain = F.col("n") > F.lit(FAN**k)
        rows = rows.withColumn("digest", F.when(remain, digest(F.array_join("kids.digest", ""))).otherwise(F.col("kids")[0]["digest"]))
        inside = ["kids"]
    return rows.select("tree", F.col("__block").alias("rank"), "n", "digest", "kids")


def _up(nodes: DataFrame, payload: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """All tiers' block rows, written, and the last one's (tree, digest): one row per tree."""
    tiers, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tiers.append(settled(_rolled(nodes, payload), "tier"))
        most = -(-most // FAN**DIGITS)
        if most <= 1:
            return tiers, tiers[-1].select("tree", "digest")
        size = F.ceil(F.col("n") / F.lit(FAN**DIGITS)).cast("long").alias("n")
        nodes, payload = tiers[-1].select("tree", "rank", size, "digest"), []


def _siblings(kids: str, remain: Column) -> Column:
    """Each child with the step that its run adds to a proof (none where nothing is hashed)."""
    digests = F.transform(kids, lambda kid: kid["digest"])

    def step(kid: Column, i: Column) -> Column:
        left = F.array_join(F.slice(digests, F.lit(1), i), "")
        right = F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "")
        return F.struct(kid.alias("kid"), F.when(remain, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(STEP)).alias("step"))

    return F.transform(kids, step)


def _down(tiers: list[DataFrame], tops: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(tree, rank, digest, path, root, payload...) of every leaf of the first tier.

    ``tops`` has, per tree, ``path`` from its top to the root and ``root``. Its rows and each
    tier's are matched by block; what a block nests gets its path by explode.
    """
    above = tops.withColumn("rank", F.lit(0).cast("long"))
    for k, tier in reversed(list(enumerate(tiers))):
        theirs = above.select(F.col("tree").alias("__tree"), F.col("rank").alias("__rank"), "path", "root")
        rows = tier.join(theirs, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("rank") == F.col("__rank"))).drop("__tree", "__rank")
        for level in reversed(range(DIGITS)):
            remain = F.col("n") > F.lit(FAN**level)
            opened = rows.select("tree", "rank", "n", "path", "root", F.explode(_siblings("kids", remain)).alias("one"))
            last = level == 0
            inside = [F.col(f"one.kid.{c}").alias(c) for c in (["digest", *(payload if k == 0 else [])] if last else ["kids"])]
            rank = (F.col("rank") * FAN + F.col("one.kid.at")).alias("rank")
            rows = opened.select("tree", rank, "n", F.concat("one.step", "path").alias("path"), "root", *inside)
        above = rows
    return above.drop("n")


def proofs(leaves: DataFrame, tree: str, order: Sequence[Column], stay: Sequence[str]) -> DataFrame:
    """Proofs for ``leaves`` with a column ``leaf``: ``stay`` columns, leaf, subroot, root, path.

    ``path`` lists the steps (left, right) from the leaf to the root: a node is the digest of
    left, its child and right. ``tree`` names the column whose values have subtrees of their
    own (NULL is one), ``order`` the order of leaves inside.
    """
    kept = [c for c in stay if c != tree]
    ranked = _numbered(leaves, tree, order, [*stay, "leaf"])
    nodes = ranked.select(F.col(tree).alias("tree"), "rank", "n", F.col("leaf").alias("digest"), *kept)
    tiers, subroots = _up(nodes, kept)
    tops = subroots.select(F.lit(0).alias("__all"), "tree", "digest")
    ordered = _numbered(tops, "__all", [F.col("tree").asc_nulls_first()], ["__all", "tree", "digest"])
    upper, root = _up(ordered.select(F.col("__all").alias("tree"), "rank", "n", "digest", F.col("tree").alias("name")), ["name"])
    start = root.select("tree", F.array().cast(STEP).alias("path"), F.col("digest").alias("root"))
    subtrees = settled(_down(upper, start, ["name"]).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path", "root"), "subroots")
    below = subtrees.select("tree", "path", F.struct("subroot", "root").alias("root"))
    found = _down(tiers, below, kept)
    return found.select(*kept, F.col("tree").alias(tree), F.col("digest").alias("leaf"), "root.subroot", "root.root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def document_leaf(text: Column) -> Column:
    return digest(*[framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], framed(text))


def manifest(docs: DataFrame, scan: bool = False) -> DataFrame:
    """doc_id, source, leaf, subroot, root, path and ``changed``, the tampered leaf, of every row.

    Every fifth document (by the checksum of its doc_id) is tampered with: its text's A-Z are
    lower-cased. A NULL doc_id is never chosen, NULL texts stay NULL. NULL doc_ids come
    first; equal doc_ids stand in the order of their leaves, so a manifest doesn't depend
    on files. Repeated rows are equal leaves with places and proofs of their own. An empty
    table has no rows; other columns aren't read.
    """
    text = F.col("text")
    chosen = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    rows = positions(docs.select("doc_id", "source", "lang", "n_chars", "text"), scan)
    changed = F.when(chosen, document_leaf(F.translate(text, UPPER, LOWER)))
    leaves = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "source", FILE, ROW, document_leaf(text).alias("leaf"), changed.alias("changed"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col(FILE), F.col(ROW)]
    # the range partition samples its rows first: texts are read and digested once
    return proofs(settled(leaves, "leaves"), "source", order, ["doc_id", "source", "changed"])


def proof_table(docs: DataFrame, scan: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row (see ``manifest``)."""
    found = manifest(docs, scan)
    back = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
