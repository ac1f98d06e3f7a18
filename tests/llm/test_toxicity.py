import itertools
import pickle
import random

import numpy as np
import pytest
from llm_fixtures import prose

from sparktab.llm import toxicity as x

INSULTS = ["grobnak", "zlotface", "vurmling"]


def plain_kernel(s, t, kernel, decay):
    """The kernel by listing all subsequences."""

    def parts(word):
        word, found = [kernel.codes[ord(c)] for c in f"^{word}$"], {}
        for at in itertools.combinations(range(len(word)), kernel.order):
            if at[-1] - at[0] < 7:
                key = tuple(word[i] for i in at)
                found[key] = found.get(key, 0) + decay ** (at[-1] - at[0] + 1)
        return found

    a, b = parts(s), parts(t)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5 if a and b else 0.0


def test_kernel_by_listing_subsequences():
    kernel = x.StringKernel(decay=0.4)
    words = ["idiot", "idi-ot", "moron", "aaaa", "ab", "a", "banana", "zz", "melodrama"]
    got = kernel.against(words, words)
    want = np.array([[plain_kernel(a, b, kernel, 0.4) for b in words] for a in words])
    assert np.allclose(got, want, atol=1e-9)


def test_letters_of_all_scripts_are_told_apart():
    kernel = x.StringKernel()
    words = ["дурак", "дура", "привет", "白痴", "你好", "idiot", "①②"]
    got = kernel.against(words, words)
    assert np.allclose(got, [[plain_kernel(a, b, kernel, 0.4) for b in words] for a in words], atol=1e-9)
    assert got[0, 1] > 0.3 and got[0, 2] == 0 == got[3, 4] and np.allclose(np.diag(got), 1)


def test_margins_are_kernel_sums():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 14))) for _ in range(300)]
    kernel = x.StringKernel()
    weights = np.random.default_rng(1).normal(0, 1, 40)
    machine = x.Machine(kernel, words[:40], weights, -0.2)
    want = kernel.against(words, words[:40]) @ weights - 0.2
    assert np.allclose(machine.margins(words), np.maximum(np.where(kernel.against(words, words[:40]) @ weights > 0, want, x.FLOOR), x.FLOOR), atol=1e-5)


def test_nystrom_of_all_words_is_the_kernel():
    kernel = x.StringKernel()
    words = ["abcdef", "badge", "cabbage", "faced", "hedge"]
    square = kernel.against(words, words)
    values, vectors = np.linalg.eigh(square)
    mapped = square @ vectors @ np.diag(values**-0.5) @ vectors.T
    assert np.allclose(mapped @ mapped.T, square)


def test_words_of_texts():
    assert x.words_of("You I D I O T, fool!\nx\ny z") >= {"you", "fool", "x", "y", "z"}
    assert "idiot" in x.words_of("an i d i o t here") and x.words_of(" \n") == set() == x.words_of("")
    long = x.words_of("q" * 100 + "grobnak" + "q" * 100)
    assert all(len(w) <= x.WINDOW for w in long) and any("grobnak" in w for w in long)
    assert x.contexts("A b.\nc") == {("", "a"), ("a", "b"), ("", "c")}


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows, labels = random.Random(3), [], []
    for i in range(400):
        words = prose(i, 80).split()
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").persist()
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").persist()


def test_held_out_documents_and_gapped_insults(spark, corpus):
    docs, labels = corpus
    rows = x.toxicity_table(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 400 and np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    machine = x.trained(docs, labels)
    clean = prose(999, 60)
    texts = [clean, *[f"{clean} {a} and {b} then" for a, b in (("grob-nak", "vurm.ling"), ("g r o b n a k", "zlot*face"), ("GROBNAK!!", "vurmling###"))]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    scores = [r["s"] for r in frame.select("i", x.toxicity(frame, machine).alias("s")).orderBy("i").collect()]
    assert scores[0] < 0.1 and min(scores[1:]) >= 0.3
    kept = x.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 300 <= kept.count() <= 325


def test_scores_equal_reading_every_word(spark, corpus):
    """The same machine, word by word and without remembered margins."""
    docs, labels = corpus
    machine = x.trained(docs, labels)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", x.toxicity(docs, machine).alias("s")).collect()}
    for r in docs.limit(40).collect():
        tops = sorted((float(machine.margins([w])[0]) for w in x.words_of(r["text"])), reverse=True)[:3]
        assert abs(machine.score(np.array([tops]))[0] - got[r["doc_id"]]) < 1e-6


def test_held_out_accuracy_on_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = x.toxicity_table(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.9


def test_odd_tables(spark, odd, nothing, clashing, odd_rows):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)] + [(31, 1, None), (None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (odd, clashing):
        rows = x.toxicity_table(docs, labels).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert x.toxicity_table(nothing, labels).count() == 0 and x.without_toxic(nothing, labels).count() == 0
    none = labels.limit(0)
    assert {r["predicted"] for r in x.toxicity_table(odd, none).collect()} == {0}
    assert x.without_toxic(clashing, none).columns == clashing.columns


def test_words_taken_apart_are_closed_up():
    for text in ("an i--d--i--o--t here", "i  d  i  o  t", "he is an i d iot or so", "id iot", "i.. d__i ** o - t!", "idi\t \tot"):
        assert "idiot" in x.closed_up(text), text
    assert "grobnak" in x.closed_up("you grob--..nak!") and "idiot" not in x.closed_up("id\niot")
    assert x.closed_up("12 34 56 7") == set() == x.closed_up("longer word") and "it" * 8 in x.closed_up("it-" * 30)


def test_wide_gaps_and_split_words_score(spark, corpus):
    docs, labels = corpus
    machine = x.trained(docs, labels)
    clean = prose(999, 60)
    apart = ["g--r--o--b--n--a--k and v..u..r..m..l..i..n..g", "g  r  o  b  n  a  k and v  u  r  m  l  i  n  g", "gro bn ak and zlo tfa ce", "g r ob nak and vu rml ing"]
    scores = machine.score(x.Reader(machine).tops([clean, *(f"{clean} {a} then" for a in apart)]))
    assert scores[0] < 0.1 and min(scores[1:]) >= 0.3


def test_a_sent_machine_is_small_and_equal():
    words = [f"{a}{b}{c}" for a in INSULTS for b in "aeiou" for c in ("x", "tel", "ming")]
    machine = x.Machine(x.StringKernel(), words, np.random.default_rng(2).normal(0, 1, len(words)), -0.1)
    sent = pickle.dumps(machine)
    assert len(sent) < 500_000 and (pickle.loads(sent).margins(words + ["other"]) == machine.margins(words + ["other"])).all()


def test_witnesses_are_the_worst_words_of_sentences(spark):
    """By margins word by word: of a toxic document its worst sentence if it is on the toxic side, of clean ones all above FLOOR."""
    words = {w: 1.0 for w in prose(5, 60).lower().replace(".", "").split() if len(w) > 3}
    machine = x.train(dict.fromkeys(INSULTS, 1.0), words, True)
    rng, rows = random.Random(8), []
    for i in range(40):
        sentences = [prose(100 * i + k, 6) for k in range(5)]
        if i % 4 == 0:
            sentences[2] += " " + rng.choice(INSULTS) + " so."
        rows += [(". ".join(sentences[:3]) + "\n" + "! ".join(sentences[3:]), int(i % 4 == 0))] * (1 + i % 3)
    want = {}
    for text, label in set(rows):
        found = []
        for t in {t for t in x.SENTENCE.split(text) if t}:
            bag = x.words_of(t)
            hot = [(float(machine.margins([w])[0]), w) for w in bag]
            hot += [(m, w) for w in x.closed_up(t.lower()) - bag if (m := float(machine.margins([w])[0])) >= x.JOINED]
            m, w = max(hot, default=(x.FLOOR, ""))
            if m > x.FLOOR:
                found.append((m, w, t))
        if label:
            found = [f for f in [max(found, default=(0.0, "", ""))] if f[0] > 0]
        for _, w, t in found:
            want.setdefault((w, bool(label)), set()).add(t)
    frame = spark.createDataFrame(rows, "text string, label int").repartition(3)
    got = {(r["word"], r["toxic"]): r["times"] for r in x._witnesses(frame, machine).collect()}
    assert got == {k: len(v) for k, v in want.items()} and any(toxic for _, toxic in got)


def test_two_scripts_learn_their_own_insults(spark):
    rng, rows, labels = random.Random(4), [], []
    insults, plain = ["дурак", "болван", "тупица"], "утро город река поле книга дорога песня работа ветер голос дерево привет".split()
    for i in range(400):
        words = prose(i, 40).split() if i % 2 else [rng.choice(plain) for _ in range(40)]
        if bad := i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS if i % 2 else insults))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    machine = x.trained(docs, marked)
    clean = " ".join(plain)
    scores = machine.score(x.Reader(machine).tops([clean, f"{clean} дурак и болван", f"{clean} ду-рак и т у п и ц а", f"{clean} grobnak vurmling"]))
    assert scores[0] < 0.1 and min(scores[1:]) >= 0.3
    rows = x.toxicity_table(docs, marked).join(marked, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.97
