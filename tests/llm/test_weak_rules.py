import random
import re
from collections import Counter

from sparktab.llm import weak_rules as w


def plain(text):
    """The counts by definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in w.SYMBOLS for c in "".join(words)), len(lines) - len(set(lines)), len(covered)


def check(docs):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        rows.setdefault(r["doc_id"], set()).add(plain(r["text"]))
    out = w.rule_table(docs).collect()
    for r in out:
        counts = tuple(r[c] for c in w.COUNTS)
        assert counts in rows[r["doc_id"]], r
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    return out


def test_counts_by_definition(spark, odd, nothing, clashing, odd_rows, tables):
    assert len(check(odd)) == len(odd_rows)
    assert check(nothing) == [] and len(check(clashing)) == len(odd_rows)
    check(spark.read.parquet(f"{tables}/documents.parquet"))
    rng = random.Random(6)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) + rng.choice(["", "\n", " \x0b#|"]) for n in range(0, 70)]
    texts += [" a b \x1c c \x85", "\ta\n\nb\n a \nb\n", "a b c a b", "a b c d a b c", "x\n" * 40, "\r\n\r\n"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def plain_em(patterns, rounds=100):
    """The same estimates over documents one by one."""
    docs = [v for v, n in patterns for _ in range(n)]
    belief = [0.95 if -1 not in v else max(0.05, 0.4 - 0.1 * v.count(-1)) for v in docs]
    for _ in range(rounds):
        share = (sum(belief) + 1) / (len(docs) + 2)
        tables = []
        for r in range(len(docs[0])):
            g, gb = (1 + sum(b for b, v in zip(belief, docs) if v[r] == x) for x in (1, -1))
            b, bb = (1 + sum(1 - b for b, v in zip(belief, docs) if v[r] == x) for x in (1, -1))
            tables.append((g / (g + gb), b / (b + bb)))
        for i, v in enumerate(docs):
            good, bad = share, 1 - share
            for (p, q), x in zip(tables, v):
                if x:
                    good, bad = good * (p if x > 0 else 1 - p), bad * (q if x > 0 else 1 - q)
            belief[i] = good / (good + bad)
    return share, tables


def test_em_finds_the_accuracies_of_rules():
    rng, seen = random.Random(8), Counter()
    accuracy = [0.95, 0.9, 0.85, 0.8]
    for _ in range(4000):
        good = rng.random() < 0.8
        seen[tuple(0 if rng.random() < 0.1 else (1 if (rng.random() < a) == good else -1) for a in accuracy)] += 1
    share, tables = w.expectation_maximisation(sorted(seen.items()))
    assert abs(share - 0.8) < 0.05
    assert all(abs(g - a) < 0.06 and abs(b - (1 - a)) < 0.12 for (g, b), a in zip(tables, accuracy))
    small = [((1, 1, 0), 30), ((-1, -1, 1), 9), ((1, -1, 1), 5), ((0, 0, -1), 4)]
    want, got = plain_em(small), w.expectation_maximisation(small)
    assert abs(want[0] - got[0]) < 1e-6
    assert all(abs(x - y) < 1e-6 for a, b in zip(want[1], got[1]) for x, y in zip(a, b))


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    out = w.rule_table(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = out.join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
