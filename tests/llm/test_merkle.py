import hashlib
import zlib
from collections import defaultdict

import pytest

from sparktab.llm import merkle
from llm_fixtures import SCHEMA


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    cells = [row[0], row[3], row[2], row[4], text]
    return h(*["-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells])


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The top, and per node its steps (left, right) up to it."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for k, _ in enumerate(run):
                for i in members[at + k]:
                    paths[i].append((run[:k], run[k + 1 :]))
            above.append(h(*run))
            held.append([i for m in members[at : at + 16] for i in m])
        nodes, members = above, held
    return nodes[0], paths


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for source in order:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1]), r) for r in by[source]), key=lambda x: x[:3])
        subs[source] = (tree([x[2] for x in mine]), [x[3] for x in mine])
    root, tops = tree([subs[s][0][0] for s in order])
    out = []
    for source, top in zip(order, tops):
        (subroot, paths), mine = subs[source]
        for r, path in zip(mine, paths):
            text, whole = r[1], path + top
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in whole:
                node = h(*left, node, *right)
            out.append((r[0], leaf(r, r[1]), subroot, root, h(*[x for a, b in whole for x in a + b]), node, node == root))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, *r[:1], *map(str, r[1:])) if r[0] is not None else (False, 0, *map(str, r[1:]))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_odd_rows(odd, odd_rows, clashing):
    want = expected(odd_rows)
    same(merkle.proof_table(odd).collect(), want)
    same(merkle.proof_table(clashing).collect(), want)
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 4097])
def test_sizes_around_full_runs(spark, n):
    """One source of n rows, lone leaves in last runs, and many sources of one row."""
    rows = [(i, f"Text {i}", "en", "one", i) for i in range(n)] + [(n + i, "A", None, f"s{i:03d}", 1) for i in range(20 if n < 4000 else 300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    same(merkle.proof_table(df).collect(), expected(rows))


def test_hot_source_and_repeats(spark):
    """A source with most rows and one row many times: every copy has a proof of its own."""
    rows = [(5, "Same Text", "en", "hot", 9)] * 700 + [(i, f"b{i}", "en", "hot", 1) for i in range(900)] + [(i, "c", "en", None, 1) for i in range(40)]
    got = merkle.proof_table(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    same(got, expected(rows))
    assert len({r["proof_sha256"] for r in got if r["leaf"] == leaf(rows[0], "Same Text")}) > 1


def test_nothing(nothing):
    out = merkle.proof_table(nothing)
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_whole_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    same(merkle.proof_table(docs, scan=True).collect(), expected([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]))


def test_no_join_of_leaves(odd):
    """Leaves meet block rows by explode: the only join of leaves is that with their file's first ranks."""
    plan = merkle.proof_table(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "ArrowEval" not in plan and "MapInArrow" not in plan and "Window" not in plan
