"""SimHash near-duplicates: fingerprints linked at few differing bits, found with BK-trees.

Two fingerprints that differ in at most ``bits`` bits agree on one of ``bits + 1`` bands
whole. So a fingerprint goes to one shard per band, named by the band's value, and each
shard builds a BK-tree: children hang under their integer Hamming distance to the
parent, and a search follows only edges within the radius. A shard of more than
``tree_size`` fingerprints is dealt out again by bands of the bits that are still
free, which loses no link, until its tree is small. Shards reach their tasks by a
shuffle: broadcasting all trees to all tasks would have no bound.

Equal fingerprints are one node, so groups of copies never meet in a task. A tree reports
a spanning forest of its links, which is what components need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import FILE, ROW, SLICE, arrow, positions
from sparktab.llm.graph import component_roots
from sparktab.operators.support import spread_join
from sparktab.session import settled

BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
CHUNK = 65_536


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the XXH64 hashes of all word runs; 0 without a word.

    ASCII letters are lower-cased, words are split at ASCII white space, fewer words than
    ``shingle`` are one run, and a bit is set if over half the hashes have it.
    """
    words = text.lower().split()
    if len(words) <= shingle:
        runs = [b" ".join(words)] if words else []
    else:
        runs = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    ones = np.zeros((8, 8), dtype=np.int64)
    for at in range(0, len(runs), CHUNK):
        part = runs[at : at + CHUNK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(r, 42) for r in part), dtype="<u8", count=len(part))
        cells = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        ones += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ BITS
    kept = np.packbits((2 * ones > len(runs)).astype(np.uint8), axis=1, bitorder="little")
    return int(kept.ravel().view("<u8")[0])


def fingerprinted(rows: DataFrame, shingle: int = 3) -> DataFrame:
    """Adds ``fp`` (long) to the columns of ``rows``, whose column ``text`` goes. NULL is the empty text."""
    keep = [c for c in rows.columns if c != "text"]
    plain = rows.select(*keep, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    kinds = ", ".join(f"{c} {k}" for c, k in plain.drop("text").dtypes) + ", fp long"
    schema = arrow(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = []
            for at in range(0, batch.num_rows, SLICE):
                fps += [fingerprint(t, shingle) for t in batch.slice(at, SLICE).column("text").to_pylist()]
            found = pa.array(np.array(fps, dtype="<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], found], schema=schema)

    return plain.mapInArrow(run, kinds)


class Tree:
    """A BK-tree over integers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        while at < new:
            apart = (value ^ self.values[at]).bit_count()
            if apart == 0:
                return
            at = self.children[at].setdefault(apart, new)
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Indexes of the values at most ``radius`` bits from ``value``."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            apart = (value ^ self.values[at]).bit_count()
            if apart <= radius:
                found.append(at)
            below = self.children[at]
            open_nodes += [below[e] for e in range(max(1, apart - radius), apart + radius + 1) if e in below]
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links at most ``radius`` bits long that connect all values that any such links connect."""
    tree, owner, links = Tree(), [], []

    def top(i: int) -> int:
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    for value in values:
        near = tree.within(value, radius)
        before = len(tree.values)
        tree.add(value)
        if len(tree.values) == before:
            continue
        owner.append(before)
        for i in near:
            a, b = top(i), top(before)
            if a != b:
                owner[b] = a
                links.append((tree.values[i], value))
    return links


def band_masks(free: int, bands: int) -> list[int]:
    """The set bits of ``free`` in ``bands`` parts of nearly equal size."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in bits[k * len(bits) // bands : (k + 1) * len(bits) // bands]) for k in range(bands)]


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _dealt(nodes: DataFrame, parents: list[int], bands: int) -> tuple[DataFrame, list[int]]:
    """(fp, mask, key): each fingerprint once per band under its shard's mask so far."""
    masks = {m: [m | k for k in band_masks(~m & 2**64 - 1, bands)] for m in parents}
    options = F.create_map(*[x for m, ms in masks.items() for x in (F.lit(signed(m)), F.array(*[F.lit(signed(k)) for k in ms]))])
    rows = nodes.select("fp", F.explode(options[F.col("mask")]).alias("mask"))
    return rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), sorted({k for ms in masks.values() for k in ms})


def _tree_links(radius: int):
    kinds = arrow("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; the last shard of a batch may go on in the next."""
        rest = np.empty((3, 0), dtype=np.int64)
        for batch in _and_end(batches):
            last = batch is None
            if not last:
                got = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp")])
                rest = np.concatenate([rest, got], axis=1)
            if not rest.shape[1]:
                continue
            starts = np.flatnonzero(np.r_[True, (rest[:2, 1:] != rest[:2, :-1]).any(axis=0)])
            ends = np.r_[starts[1:], rest.shape[1]]
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            links: list[tuple[int, int]] = []
            values = rest[2].view(np.uint64)
            for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                links += forest(values[s:e].tolist(), radius)
            rest = rest[:, ends[-1] if len(ends) else 0 :]
            ab = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], schema=kinds)

    return run


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def fingerprint_links(nodes: DataFrame, bits: int = 2, tree_size: int = 1_024) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` at most ``bits`` bits apart.

    A shard with more than ``tree_size`` fingerprints is dealt out again, until so few
    bits are free that it can't hold more.
    """
    rows, masks = _dealt(nodes.select("fp", F.lit(0).cast("long").alias("mask")), [0], bits + 1)
    ready = None
    while True:
        most_free = max((~m & 2**64 - 1).bit_count() for m in masks)
        large = None
        if 2**most_free > tree_size:
            large = settled(rows.groupBy("mask", "key").count().where(F.col("count") > tree_size).drop("count"), "large")
            parents = [r["mask"] % 2**64 for r in large.select("mask").distinct().collect()]  # at most one per band and level
        if large is None or not parents:
            ready = rows if ready is None else ready.unionByName(rows)
            break
        small = rows.join(large, ["mask", "key"], "left_anti").select("fp", "mask", "key")
        ready = small if ready is None else ready.unionByName(small)
        rows, masks = _dealt(rows.join(large, ["mask", "key"], "left_semi"), parents, bits + 1)
    shards = ready.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return shards.mapInArrow(_tree_links(bits), "a long, b long")


def _components(marked: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """From rows (doc_id, file, row, fp): (fp, first), first being the component's smallest (no doc_id, doc_id, file, row)."""
    me = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW)
    nodes = settled(marked.groupBy("fp").agg(F.min(me).alias("first")), "nodes")
    roots = component_roots(fingerprint_links(nodes, bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root"), firsts


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, scan: bool = False) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    ``component_id`` is the smallest doc_id of the rows that links reach (NULL if none of
    them has one). NULL and empty texts have the fingerprint 0 and link like any other.
    Repeated rows are rows of the same component; other columns aren't read.
    """
    rows = positions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan)
    marked = settled(fingerprinted(rows, shingle), "fingerprints")
    rooted, firsts = _components(marked, bits)
    named = rooted.join(firsts, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    found = spread_join(marked, named, ["fp"], spread=F.xxhash64(FILE, ROW))  # copies of one text are many rows of one key
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2, scan: bool = False) -> DataFrame:
    """The rows of ``docs`` that come first in their component, by doc_id and then by place."""
    rows = positions(docs if scan else settled(docs, "rows"), True)
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), FILE, ROW, "text")
    marked = settled(fingerprinted(slim, shingle), "fingerprints")
    _, firsts = _components(marked, bits)
    kept = firsts.select(F.col(f"first.{FILE}").alias(FILE), F.col(f"first.{ROW}").alias(ROW))
    return rows.join(kept, [FILE, ROW], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
