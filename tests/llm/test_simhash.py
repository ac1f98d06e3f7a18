import random

import xxhash
from llm_fixtures import SCHEMA, prose

from sparktab.llm import graph, simhash


def plain_fingerprint(text: str) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def classes(pairs, nodes):
    """Smallest member of each node's component, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    top = {}
    for n in sorted(nodes):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in top:
                top[x] = n
                todo += near[x]
    return top


def test_fingerprint_matches_its_definition():
    texts = ["", " \n", "one", "One TWO", "a b c", "É é\x85x \x1c y Z", "w " * 9, prose(1, 300), "x\x0by\x0cz\tq"]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t), t
    simhash.CHUNK, kept = 7, simhash.CHUNK
    try:
        assert simhash.fingerprint(texts[7].encode()) == plain_fingerprint(texts[7])
    finally:
        simhash.CHUNK = kept


def test_tree_finds_all_within_the_radius():
    rng = random.Random(4)
    values = [rng.getrandbits(10) for _ in range(300)]
    tree = simhash.Tree()
    for v in values:
        tree.add(v)
    assert len(tree.values) == len(set(values))
    for q in range(0, 1024, 37):
        for r in (0, 1, 2, 3):
            assert {tree.values[i] for i in tree.within(q, r)} == {v for v in values if (v ^ q).bit_count() <= r}


def clouds(n: int, seed: int) -> list[int]:
    """Fingerprints in clouds, chains and alone, both signs."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            out.append(x)
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    return out[:n]


def test_links_connect_what_all_pairs_connect(spark):
    values = sorted({simhash.signed(v) for v in clouds(400, 5)})
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    pairs = [(a, b) for a in values for b in values if a < b and ((a ^ b) & 2**64 - 1).bit_count() <= 2]
    want = classes(pairs, values)
    for size in (1_024, 8):  # the small trees are reached through bands of bands
        links = [tuple(r) for r in simhash.fingerprint_links(nodes, 2, size).collect()]
        assert all(((a ^ b) & 2**64 - 1).bit_count() <= 2 for a, b in links)
        assert classes(links, values) == want


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    roots = {r["node"]: r["root"] for r in graph.component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    for group in (range(0, 61), range(100, 160), (299, 300)):
        assert len({roots[n] for n in group}) == 1
    assert len(set(roots.values())) == 3
    assert graph.component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows():
    base = prose(77, 400)
    rows = [(5, base), (3, base), (9, base.upper()), (4, base + " one more"), (8, None), (7, ""), (6, prose(78, 200)), (6, prose(78, 200)), (None, base), (20, prose(90, 30))]
    return rows


def test_near_duplicates_against_all_pairs(spark):
    rows = near_rows()
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    top = classes(pairs, range(len(rows)))
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[top[i]] = min(name, least.get(top[i], name))
    want = sorted(((n, f"{fps[i]:016x}", least.get(top[i])) for i, (n, _) in enumerate(rows)), key=str)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_odd_tables(odd, nothing, clashing, odd_rows):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(odd_rows)
    empty = {r["component_id"] for r in out if r["fingerprint"] == "0" * 16}
    assert empty == {60}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.without_near_duplicates(nothing).count() == 0
    assert simhash.without_near_duplicates(clashing).columns == clashing.columns


def test_one_hot_fingerprint(spark):
    """Half of the rows are copies of one text: all of one component, others apart."""
    rows = [(i, prose(7, 60) if i % 2 else prose(100 + i, 60), "en", "s", 1) for i in range(300)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {i: 1 if i % 2 else i for i in range(300)}
