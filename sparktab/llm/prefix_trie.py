"""A trie over conversations that share their first turns, for counting tokens saved.

Conversations are sequences of turns; a turn is its 128-bit digest and its number of code
points. Sorted by these sequences, a trie's nodes stand in preorder. The sorted rows are
cut into shards of bounded size, and each shard writes its part of the trie as balanced
parentheses, one pair per node:

* the excess (open minus closed) is kept with its minimum per block of ``BLOCK`` places;
  ``find_close`` skips blocks whose minimum is too high and so delimits every subtree,
* the rank of pairs ``()`` counts the leaves of a subtree,
* cumulative arrays over the preorder give sums over subtrees: members, turns' sizes.

Only the nodes on a shard's first and last sequence can stand in other shards too. What a
shard says of them adds up: a node's own row, its link to its parent and its size once are
counted by the shard in which it opens, and its last shard knows whether it is a leaf, as
each shard knows the sequences before and after it. So shared spines merge by one sum per
node, and all other nodes are final where they are made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.llm.common import arrow
from sparktab.operators.support import lookup, pinned
from sparktab.session import settled

#: Parentheses whose least excess is kept together.
BLOCK = 256
#: Turns and conversations of a shard together.
SHARD = 1 << 18
WIDTH = 16
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, gross long, once long, ends_sha256 string, "
    "spine binary, above binary, shard long, chars long, ends string"
)


def find_close(opens: np.ndarray, excess: np.ndarray) -> np.ndarray:
    """For each open parenthesis the place that closes it: the next one of one less excess.

    ``excess`` is that after each place. All are searched together, at first in their own
    block, then over the blocks' minima, then in the block found.
    """
    n = len(excess)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
    padded[:n] = excess
    least = padded.reshape(blocks, BLOCK).min(axis=1)
    close, target = np.full(len(opens), -1, dtype=np.int64), excess[opens] - 1

    def in_block(todo: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Walks from ``at`` to the ends of their blocks; those of ``todo`` not found."""
        while len(todo):
            hit = padded[at] == target[todo]
            close[todo[hit]] = at[hit]
            todo, at = todo[~hit], at[~hit] + 1
            inside = at % BLOCK != 0
            if not inside.all():
                missed.append(todo[~inside])
                todo, at = todo[inside], at[inside]
        return np.concatenate(missed) if missed else np.empty(0, dtype=np.int64)

    missed: list[np.ndarray] = []
    start = opens + 1
    fresh = start % BLOCK != 0
    left = np.concatenate([in_block(np.flatnonzero(fresh), start[fresh]), np.flatnonzero(~fresh)])
    block, found_in = (start[left] - fresh[left]) // BLOCK + fresh[left], np.empty(len(left), dtype=np.int64)
    waiting = np.arange(len(left))
    while len(waiting):
        ok = least[block[waiting]] <= target[left[waiting]]
        found_in[waiting[ok]] = block[waiting[ok]]
        waiting = waiting[~ok]
        block[waiting] += 1
    missed = []
    in_block(left, found_in * BLOCK)
    return close


class Shard:
    """The trie of some consecutive conversations, as balanced parentheses.

    ``paths``: one digest of ``WIDTH`` bytes per turn, ascending; ``sizes``: code points per
    turn; ``names``: conv_ids. ``before`` and ``after`` are the neighbouring paths or None.
    """

    def __init__(self, paths: list[bytes], sizes: np.ndarray, names: np.ndarray, before: bytes | None, after: bytes | None) -> None:
        self.paths, self.names = paths, names
        lengths = np.array([len(p) // WIDTH for p in paths], dtype=np.int64)
        shared = np.zeros(len(paths), dtype=np.int64)
        turns = np.frombuffer(b"".join(paths), dtype="<u8").reshape(-1, 2)
        starts = np.cumsum(lengths) - lengths
        self._common(turns, starts, lengths, shared)
        made = lengths - shared
        made[0] += 1  # the root
        self.n = int(made.sum())
        owner = np.repeat(np.arange(len(paths)), made)
        inside = np.arange(self.n) - np.repeat(np.cumsum(made) - made, made)
        self.depth = shared[owner] + 1 + inside
        self.depth[: made[0]] -= 1
        self.chars = np.zeros(self.n, dtype=np.int64)
        real = self.depth > 0
        self.chars[real] = sizes[starts[owner[real]] + self.depth[real] - 1]
        self.end = np.cumsum(made) - 1  # the node at which each conversation ends
        # parentheses: what a conversation doesn't share with the next is closed
        closes = np.r_[lengths[:-1] - shared[1:], lengths[-1] + 1]
        runs = np.stack([made, closes], axis=1).ravel()
        self.bits = np.repeat(np.tile([True, False], len(paths)), runs)
        excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int32)
        self.open = np.flatnonzero(self.bits)
        self.close = find_close(self.open, excess)
        self.size = (self.close - self.open + 1) // 2
        self.owner = owner
        self.known = self._shared_with(paths[0], before)
        self.to_come = self._shared_with(paths[-1], after)
        self.after_open = after is not None and self.to_come == lengths[-1]

    @staticmethod
    def _common(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray, shared: np.ndarray) -> None:
        """Turns that each path has in common with the one before it."""
        both = np.minimum(lengths[1:], lengths[:-1])
        some = np.flatnonzero(both)
        if not len(some):
            return
        size = both[some]
        ends = np.cumsum(size)
        inside = np.arange(ends[-1]) - np.repeat(ends - size, size)
        a, b = np.repeat(starts[some], size) + inside, np.repeat(starts[some + 1], size) + inside
        differs = (turns[a] != turns[b]).any(axis=1)
        first = np.where(differs, inside, np.iinfo(np.int64).max)
        shared[some + 1] = np.minimum(np.minimum.reduceat(first, ends - size), size)

    @staticmethod
    def _shared_with(path: bytes, other: bytes | None) -> int:
        """Depth of the deepest node of ``path`` that ``other`` has too; -1 without other."""
        if other is None:
            return -1
        n = min(len(path), len(other)) // WIDTH
        return next((d for d in range(n) if path[d * WIDTH : (d + 1) * WIDTH] != other[d * WIDTH : (d + 1) * WIDTH]), n)

    def _over_subtrees(self, values: np.ndarray) -> np.ndarray:
        """Sums over each node's subtree, from one cumulative array."""
        total = np.r_[0, np.cumsum(values)]
        at = np.arange(self.n)
        return total[at + self.size] - total[at]

    def nodes(self, number: int) -> pa.RecordBatch:
        """Every node's row of ``NODES``; rows with ``spine`` are this shard's part only."""
        ended = np.bincount(self.end, minlength=self.n)
        members = self._over_subtrees(ended)
        pairs = np.zeros(len(self.bits), dtype=np.int64)
        pairs[:-1] = self.bits[:-1] & ~self.bits[1:]
        rank = np.r_[0, np.cumsum(pairs)]
        leaves = rank[self.close] - rank[self.open]
        owned = np.ones(self.n, dtype=np.int64)
        first_spine = np.arange(self.end[0] + 1)  # nodes of the first path, root first
        owned[first_spine[self.depth[first_spine] <= self.known]] = 0
        keyed = np.sort(self.depth * self.n + np.arange(self.n))
        parent = keyed[np.searchsorted(keyed, (self.depth - 1) * self.n + np.arange(self.n)) - 1] % self.n
        parent[0] = -1
        children = np.bincount(parent[1:], weights=owned[1:], minlength=self.n).astype(np.int64)
        last_spine = self._last_spine()
        if self.after_open:  # the last node goes on in the next shard, which says if it is a leaf
            leaves[last_spine] -= 1
        first_member = np.searchsorted(self.end, np.arange(self.n))
        bounds = np.stack([first_member, first_member + members], axis=1).ravel()
        least = np.minimum.reduceat(np.r_[self.names, np.iinfo(np.int64).max], bounds)[::2]
        spine = np.zeros(self.n, dtype=bool)
        spine[first_spine[self.depth[first_spine] <= self.known]] = True
        spine[last_spine[self.depth[last_spine] <= self.to_come]] = True
        gross, once = self._over_subtrees(members * self.chars), self._over_subtrees(owned * self.chars)
        marks = self._marks(first_spine, last_spine, spine)
        texts = self._ends(ended, spine)
        above = parent.clip(0)
        columns = {
            "conv_id": pa.array(least),
            "depth": pa.array(self.depth),
            "parent_conv_id": pa.array(least[above], mask=(parent < 0) | spine[above]),
            "n_convs": pa.array(members),
            "n_children": pa.array(children),
            "n_leaves": pa.array(leaves),
            "gross": pa.array(gross),
            "once": pa.array(once),
            "ends_sha256": pa.array([None if s else hashlib.sha256(t).hexdigest() for s, t in zip(spine.tolist(), texts)], type=pa.string()),
            "spine": pa.array([marks.get(i) for i in range(self.n)], type=pa.binary()),
            "above": pa.array([marks.get(p) for p in parent.tolist()], type=pa.binary()),
            "shard": pa.array(np.full(self.n, number)),
            "chars": pa.array(self.chars),
            "ends": pa.array([t.decode() if s and t else None for s, t in zip(spine.tolist(), texts)], type=pa.string()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), schema=arrow(NODES))

    def _last_spine(self) -> np.ndarray:
        """The nodes of the last path, root first: those that only the last places close."""
        return np.flatnonzero(self.close >= len(self.bits) - 1 - self.depth[self.end[-1]])

    def _marks(self, first: np.ndarray, last: np.ndarray, spine: np.ndarray) -> dict[int, bytes]:
        """What names the nodes that other shards may have: the digest of all turns to them."""
        found: dict[int, bytes] = {}
        for nodes, path in ((first, self.paths[0]), (last, self.paths[-1])):
            running = hashlib.md5(usedforsecurity=False)
            for d, node in enumerate(nodes.tolist()):
                if not spine[node]:
                    break
                if d:
                    running.update(path[(d - 1) * WIDTH : d * WIDTH])
                found[node] = running.copy().digest()
        return found

    def _ends(self, ended: np.ndarray, spine: np.ndarray) -> list[bytes]:
        """The conv_ids that end at each node, comma-joined in the order of the rows."""
        texts, at = [], 0
        names = self.names.tolist()
        for n in ended.tolist():
            texts.append(",".join(map(str, names[at : at + n])).encode() if n else b"")
            at += n
        return texts


def _shards(limit: int):
    """Turns rows (part, kind, path, sizes, conv_id), sorted, into node rows. Kinds 0 and 2 are
    the paths of the parts before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before, weight = None, 0, None, 0
        paths: list[bytes] = []
        sizes: list[np.ndarray] = []
        names: list[int] = []

        def close(after: bytes | None) -> Iterator[pa.RecordBatch]:
            if paths:
                done = Shard(paths, np.concatenate(sizes), np.array(names, dtype=np.int64), before, after).nodes((part << 32) + number)
                for at in range(0, done.num_rows, 65_536):
                    yield done.slice(at, 65_536)

        for batch in batches:
            flat, ends = batch.column("sizes").flatten().to_numpy(zero_copy_only=False), np.cumsum(batch.column("sizes").value_lengths().to_numpy(zero_copy_only=False))
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "path", "conv_id")), [0, *ends.tolist()], ends.tolist())
            for its, kind, path, name, a, b in rows:
                if its != part or kind == 2 or weight > limit:
                    yield from close(path if its == part else None)
                    before = paths[-1] if paths and its == part else None
                    number = number + 1 if its == part else 0
                    part, weight, paths, sizes, names = its, 0, [], [], []
                if kind == 0:
                    before = path
                elif kind == 1:
                    paths.append(path)
                    sizes.append(flat[a:b])
                    names.append(name)
                    weight += 1 + b - a
        yield from close(None)

    return run


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (spine, shard, ends) sorted: the digest of each node's ids, piece by piece."""
    mark, running, any_yet = None, hashlib.sha256(), False
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for its, text in zip(batch.column("spine").to_pylist(), batch.column("ends").to_pylist()):
            if its != mark:
                if mark is not None:
                    done.append((mark, running.hexdigest()))
                mark, running, any_yet = its, hashlib.sha256(), False
            if text:
                running.update(("," if any_yet else "").encode() + text.encode())
                any_yet = True
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in done], type=pa.binary()), pa.array([x for _, x in done], type=pa.string())], names=["spine", "ends_sha256"])
    if mark is not None:
        yield pa.RecordBatch.from_arrays([pa.array([mark], type=pa.binary()), pa.array([running.hexdigest()])], names=["spine", "ends_sha256"])


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD) -> DataFrame:
    """The trie of ``convs`` (conv_id long; path binary, ``WIDTH`` bytes per turn; sizes array<long>).

    Per node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256, as long but for the last. Equal sequences, however many
    conversations have them, are spread over shards by conv_id.
    """
    keys = ["path", "conv_id"]
    ranged = convs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = settled(ranged.select(F.spark_partition_id().cast("long").alias("part"), "path", "sizes", "conv_id"), "sequences")
    in_order = Window.orderBy("part")  # one row per part
    borders = rows.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    borders = borders.select("part", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("after"))
    no_sizes, no_id = F.array().cast("array<bigint>").alias("sizes"), F.lit(None).cast("long").alias("conv_id")
    kind = lambda k: F.lit(k).alias("kind")
    stream = rows.select("part", kind(1), "path", "sizes", "conv_id")
    for k, side in ((0, "before"), (2, "after")):
        stream = stream.unionByName(borders.where(F.col(side).isNotNull()).select("part", kind(k), F.col(side).alias("path"), no_sizes, no_id))
    dealt = stream.repartition("part").sortWithinPartitions("part", "kind", "path", "conv_id")
    found = settled(dealt.mapInArrow(_shards(shard_turns), NODES), "nodes")
    whole = found.where("spine IS NULL")
    pieces = found.where("spine IS NOT NULL")
    digests = pieces.select("spine", "shard", "ends").repartition("spine").sortWithinPartitions("spine", "shard").mapInArrow(_digest_ends, "spine binary, ends_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "gross", "once")]
    spines = pieces.groupBy("spine").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("above").alias("above"), *sums)
    spines = settled(spines.join(digests, "spine"), "spines")
    links = spines.select(F.col("spine").alias("above"), F.col("conv_id").alias("merged"))
    table, few = pinned(links)
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "gross", "once", "ends_sha256"]
    below = whole.where("above IS NOT NULL").select(*columns, "above").unionByName(spines.select(*columns, "above"))
    joined = lookup(below, table, ["above"], few, "left", spread=F.xxhash64("conv_id", "depth"))
    every = joined.select(*columns, F.col("merged").alias("parent_conv_id")).unionByName(whole.where("above IS NULL").select(*columns, "parent_conv_id"))
    saved = (F.col("gross") - F.col("once")).alias("saved_tokens")
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved, "ends_sha256")


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def rebuilt(conversations: DataFrame, shared: int = 6, family: int = 100) -> DataFrame:
    """(conv_id, path, sizes) of every conversation: the first h turns of the one that leads its
    family, then its own after the first h; h is the checksum of its conv_id modulo ``shared``.

    Turns ascend by ``turn`` (NULL first; equal ones by the digest of role and text); NULL role or
    text is empty. Of a turn only its digest and its size are gathered, so a conversation's
    row has 24 bytes per turn, whatever its texts hold.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().alias("given"),
        F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("mark"),
        F.char_length(text).cast("long").alias("size"),
    )
    listed = F.array_sort(F.collect_list(F.struct("given", "turn", "mark", "size")))
    own = settled(turns.groupBy("conv_id").agg(listed.alias("own")).select("conv_id", F.col("own.mark").alias("marks"), F.col("own.size").alias("sizes")), "turns")
    lead = F.col("conv_id") - F.col("conv_id") % family
    leads = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("lead"), *[F.slice(c, 1, shared - 1).alias(f"lead_{c}") for c in ("marks", "sizes")])
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    both = own.withColumn("lead", lead).join(leads, "lead", "left").withColumn("h", h)

    def spliced(c: str) -> Column:
        first = F.slice(F.coalesce(F.col(f"lead_{c}"), F.slice(c, 1, 0)), F.lit(1), F.col("h"))
        return F.concat(first, F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1))))

    path = F.unhex(F.array_join(F.transform(spliced("marks"), F.hex), ""))
    return both.select("conv_id", path.alias("path"), spliced("sizes").alias("sizes"))


def trie_table(conversations: DataFrame, shard_turns: int = SHARD) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see ``rebuilt`` and ``prefix_nodes``).

    Rows without conv_id belong to no conversation. A conversation whose rebuilt form has no turn
    ends at the root. An empty table has no conversation and so no node. Repeated rows
    are repeated turns; other columns aren't read.
    """
    return prefix_nodes(rebuilt(conversations), shard_turns)
