import random

from llm_fixtures import prose

from sparktab.llm import decontaminate as d


def brute(index, terms, threshold):
    """Scores of all items, one by one."""
    found = []
    for i in range(len(index.items)):
        score = 0.0
        for t in terms:
            ids, impacts, *_ = index.postings.get(t, ([], []))
            if i in ids:
                score += impacts[ids.index(i)]
        if score >= threshold - 1e-9:
            found.append((i, round(score, 9)))
    return found


def test_search_and_bound_agree_with_scoring_all_items():
    rng = random.Random(2)
    items = [(i, *d.question_and_answer(prose(1000 + i, rng.randint(6, 60)))) for i in range(90)]
    items += [(200, ["the"], ["the"]), (201, [], []), (202, ["the", "of"], ["the"])]
    index = d.Index(items)
    texts = [prose(i, 300) + " " + prose(1000 + i, 40) + " the of " * (i % 3) for i in range(12)]
    for text in texts:
        words = d.words_of(text)
        starts = set(index.passages(words, 0.5))
        for at in range(0, len(words), index.reach):
            terms = set(words[at : at + 2 * index.reach])
            for threshold in (0.3, 0.5, 0.9):
                want = brute(index, terms, threshold)
                assert [(i, round(s, 9)) for i, s in index.search(terms, threshold)] == want
            if brute(index, terms, 0.5):
                assert at in starts
    some = index.passages(d.words_of(texts[0]), 0.5)
    d.DENSE, kept = 0, d.DENSE
    try:
        assert index.passages(d.words_of(texts[0]), 0.5) == some
    finally:
        d.DENSE = kept


def test_question_and_answer():
    assert d.question_and_answer("What is it? A stone.") == (["what", "is", "it"], ["a", "stone"])
    assert d.question_and_answer("one two three") == (["one", "two"], ["three"])
    assert d.question_and_answer("") == ([], [])


ITEMS = [(1, prose(501, 40)), (2, prose(502, 30)), (3, None), (4, ""), (None, prose(503, 30)), (5, prose(502, 30))]


def documents(spark):
    first, second = ITEMS[0][1], ITEMS[1][1]
    question = " ".join(first.split()[:25])
    rows = [
        (10, prose(1, 200) + "\n" + first + "\n" + prose(2, 90)),  # whole item inside
        (11, first.upper()),  # other case, nothing around
        (12, prose(3, 200) + " " + question),  # a question without its answer
        (13, prose(4, 300)),
        (14, None),
        (15, ""),
        (16, second + " " + prose(5, 5000) + " " + first),  # both, at either end of a long text
        (16, second + " " + prose(5, 5000) + " " + first),
        (None, first),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_leaks_are_found_and_clean_documents_left(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted([(10, 1), (11, 1), (16, 1), (16, 2), (16, 5), (16, 1), (16, 2), (16, 5), (None, 1)], key=str)
    figures = []
    for size in (20_000, 2):
        rows = d.leak_table(documents(spark), items, index_items=size).collect()
        assert sorted([(r["doc_id"], r["item_id"]) for r in rows], key=str) == want
        assert all(r["question_overlap"] == 1 and r["answer_overlap"] == 1 and 0.5 <= r["score"] <= 1 for r in rows)
        figures.append(sorted((tuple(r) for r in rows), key=repr))
        kept = d.without_leaks(documents(spark), items, index_items=size)
        assert sorted(r["doc_id"] for r in kept.collect()) == [12, 13, 14, 15] and kept.columns == ["doc_id", "text"]
    assert figures[0] == figures[1]


def edited(text, count, rng, how="changed"):
    words = text.split()
    for at in rng.sample(range(len(words)), count):
        words[at] = {"changed": f"qq{at}", "lost": "", "more": f"{words[at]} qq{at}"}[how]
    return " ".join(w for w in words if w)


def test_common_words_in_order_against_the_table():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert d.common_in_order(a, b) == best[-1][-1]
    assert d.held(list("abc"), list("xaxbxxcxx")) == 2 and d.held(list("abc"), list("xxxaxbcx")) == 3 and d.held([], ["a"]) == 0


def test_edited_items_are_found_through_any_number_of_indexes(spark):
    rng = random.Random(5)
    items = [(i, prose(3000 + i, rng.randint(15, 55))) for i in range(60)]
    edits = [(0, "changed"), (1, "changed"), (2, "changed"), (3, "changed"), (2, "lost"), (3, "more")]
    docs = [(i * 10 + k, prose(i, 120) + "\n" + edited(t, edits[k][0], rng, edits[k][1]) + "\n" + prose(900 + i, 80)) for i, t in items for k in range(len(edits))]
    table = spark.createDataFrame(items, "item_id long, text string")
    texts = spark.createDataFrame(docs + [(10_000 + i, prose(5000 + i, 300)) for i in range(60)], "doc_id long, text string").repartition(4)
    found = [sorted(tuple(r) for r in d.leak_table(texts, table, index_items=n).collect()) for n in (20_000, 25)]
    assert found[0] == found[1]
    pairs = {(x[0], x[1]) for x in found[0]}
    assert all(name == doc // 10 for doc, name in pairs)
    caught = [sum((i * 10 + n, i) in pairs for i, _ in items) / len(items) for n in range(6)]
    assert caught[0] == 1 and min(caught) >= 0.9


def test_no_items_or_documents(spark, odd, nothing, clashing):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.leak_table(odd, none).count() == 0 and d.without_leaks(odd, none).count() == odd.count()
    assert d.leak_table(nothing, items).count() == 0
    assert d.without_leaks(clashing, items).columns == clashing.columns


def test_query_table(spark, tables):
    """All planted items of the smallest tables, by searching their text plainly."""
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = {r["item_id"]: " ".join(d.words_of(r["text"])) for r in items.collect()}
    want = set()
    for r in docs.collect():
        text = " " + " ".join(d.words_of(r["text"] or "")) + " "
        want |= {(r["doc_id"], i) for i, t in plain.items() if f" {t} " in text}
    got = {(r["doc_id"], r["item_id"]) for r in d.leak_table(docs, items).collect()}
    assert want and want <= got
