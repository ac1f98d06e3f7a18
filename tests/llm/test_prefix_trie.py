import hashlib
import random
import zlib

import numpy as np
import pytest

from sparktab.llm import prefix_trie as t

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def tie(row) -> bytes:
    role, text = row[2] or "", row[3] or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def expected(rows) -> list[tuple]:
    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=lambda r: (r[1] is not None, r[1] or 0, tie(r)))] for c, rs in own.items()}
    nodes: dict[tuple, dict] = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(seq) + 1):
            node = nodes.setdefault(tuple(seq[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(seq):
                node["ends"].append(c)
    kids = {k: [] for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(nodes[k]["members"]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[x] for x in kids[k])
    return [
        (min(v["members"]), len(k), min(nodes[k[:-1]]["members"]) if k else None, len(v["members"]), len(kids[k]), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(v["ends"]))).encode()).hexdigest())
        for k, v in nodes.items()
    ]


def same(got, want):
    assert got.columns == COLUMNS
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def talk(seed: int, convs: int, words: int = 3, most: int = 9) -> list[tuple]:
    rng = random.Random(seed)
    return [(c * 7 % 950, i, rng.choice(["user", "bot"]), "".join(rng.choice("ab😀") for _ in range(rng.randint(0, words)))) for c in range(convs) for i in range(rng.randint(1, most))]


@pytest.mark.parametrize("limit", [1, 7, 60, t.SHARD])
def test_shards_of_any_size(spark, limit):
    """Few distinct turns, so that prefixes, whole conversations and borders are shared."""
    rows = talk(limit, 300, 1)
    same(t.trie_table(spark.createDataFrame(rows, SCHEMA).repartition(6), limit), expected(rows))


def test_odd_rows(spark):
    rows = talk(3, 60) + [(None, 1, "user", "lost"), (100, None, None, None), (100, None, "x", None), (100, 0, "x", "y"), (100, 0, "a", "z"), (101, 5, None, "q"), (-3, 1, "user", "n"), (-250, 1, "user", "n"), (-200, 1, "u", "v")]
    rows += [(600 + i, 0, "user", "word " * 20_000) for i in range(3)] + [(700, i, "bot", "x") for i in range(1500)] + rows[:9]
    same(t.trie_table(spark.createDataFrame(rows, SCHEMA), 50), expected(rows))
    from pyspark.sql import functions as F

    more = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in "path sizes own lead h part kind spine above shard n size mark given".split()])
    same(t.trie_table(more), expected(rows))


def test_one_hot_conversation_and_first_turn(spark):
    """All start alike, a third are equal throughout: they are spread over shards."""
    rows = [(i, 0, "system", "same") for i in range(900)] + [(i, 1, "user", f"{i}") for i in range(900) if i % 3]
    same(t.trie_table(spark.createDataFrame(rows, SCHEMA).repartition(4), 40), expected(rows))


def test_turnless(spark):
    """h is beyond each one's own turns and its family has no lead: all end at the root."""
    rows = [(c, 0, "user", "a") for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 >= 1]
    want = expected(rows)
    assert len(want) == 1 and want[0][3] == len(rows)
    for limit in (1, 5, 1000):
        same(t.trie_table(spark.createDataFrame(rows, SCHEMA), limit), want)


def test_nothing(spark):
    same(t.trie_table(spark.createDataFrame([], SCHEMA)), [])


def test_whole_table(spark, tables):
    rows = spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text")
    same(t.trie_table(rows, 100), expected([tuple(r) for r in rows.collect()]))


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 4000])
def test_find_close(n):
    rng = random.Random(n)
    bits, depth, left = [True], 1, n - 1
    while depth:
        if left and rng.random() < 0.5 + (0.4 if len(bits) % 900 < 500 else -0.3):
            bits, depth, left = bits + [True], depth + 1, left - 1
        elif depth > 1 or not left:
            bits, depth = bits + [False], depth - 1
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    bits = np.array(bits)
    opens = np.flatnonzero(bits)
    assert t.find_close(opens, np.cumsum(np.where(bits, 1, -1)).astype(np.int32)).tolist() == [want[i] for i in opens.tolist()]
