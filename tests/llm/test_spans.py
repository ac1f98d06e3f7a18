from llm_fixtures import SCHEMA, prose

from sparktab.llm import spans


def plain(rows, span=3, least=13):
    """The sentences to remove of each row, by a dictionary over all spans."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    parts = [[" ".join(w) for _, _, w in spans.sentences(t or "")] for _, t in rows]
    seen, gone = set(), {i: set() for i in order}
    for i in order:
        for k in range(len(parts[i]) - span + 1):
            size = span
            while k + size < len(parts[i]) and sum(len(s.split()) for s in parts[i][k : k + size]) < least:
                size += 1
            run = tuple(parts[i][k : k + size])
            if sum(len(s.split()) for s in run) < least:
                continue
            if run in seen:
                gone[i] |= set(range(k, k + size))
            seen.add(run)
    return gone


def rows_with_passages():
    passage = prose(700, 60)
    tail = " ".join(passage.split()[7:])  # starts within a sentence
    rows = [(i, prose(i, 120)) for i in range(8)]
    rows += [(20, passage + "\n" + prose(50, 60)), (21, prose(51, 60) + "\n" + passage.upper()), (22, prose(52, 40) + " " + tail + "\n" + prose(53, 40))]
    rows += [(30, "Of. In. The. Of. In. The. Of. In."), (31, "Of. In. The."), (32, None), (33, ""), (34, prose(60, 5)), (35, prose(60, 5))]
    shouted = "!! ".join(prose(800, 60).upper().split())
    rows += [(50, shouted + "!! " + prose(81, 20)), (51, prose(82, 30) + "\n" + shouted)]
    rows += [(40, (prose(61, 40) + "\n") * 3), (41, "word " * 400), (42, "word " * 90), (None, passage), (43, "y" * 50_000)]
    return rows


def test_sentences_cover_the_text():
    for text in (prose(1, 90), "A b. C\n\n d! e", "x " * 50, "", "  \n", "one. two", " lead in. tail  "):
        found = spans.sentences(text)
        assert [w for _, _, ws in found for w in ws] == text.lower().split()
        assert all(len(w) <= spans.PIECE and text[a:b].lower().split() == w for a, b, w in found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))


def test_passages_within_a_sentence(spark):
    """No mark around or inside the passage: it is found all the same."""
    bare = lambda seed, n: prose(seed, n).lower().replace(".", "")
    passage = bare(900, 70)
    rows = [(i, f"{bare(i, 37 + i)} {passage} {bare(50 + i, 41)}") for i in range(4)] + [(9, bare(70, 150))]
    out = spans.repeat_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3} and {r["first_doc_id"] for r in out} == {0}
    words = {i: [w for _, _, w in spans.sentences(t)] for i, t in rows}
    for i in (1, 2, 3):
        gone = [w for r in out if r["doc_id"] == i for s in words[i][r["first_sentence"] : r["first_sentence"] + r["n_sentences"]] for w in s]
        assert len(gone) >= 35 and " ".join(gone) in passage


def test_runs_against_a_dictionary(spark):
    rows = rows_with_passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {rows[i][0]: g for i, g in plain(rows).items() if g}
    got = {}
    for r in spans.repeat_table(docs).collect():
        new = set(range(r["first_sentence"], r["first_sentence"] + r["n_sentences"]))
        assert not new & got.get(r["doc_id"], set())
        got[r["doc_id"]] = got.get(r["doc_id"], set()) | new
    assert got == want and {21, 22, 40, 51, None} <= set(got) and not {20, 30, 31, 34, 35} & set(got)
    first = {r["doc_id"]: r["first_doc_id"] for r in spans.repeat_table(docs).collect()}
    assert first[21] == 20 and first[None] == 20


def test_removal_keeps_the_rest(spark):
    rows = rows_with_passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in spans.without_repeats(docs).collect()}
    gone = plain(rows)
    assert len(out) == len(rows)
    for i, (name, text) in enumerate(rows):
        if not gone[i]:
            assert out[name] == text
        else:
            kept = [w for k, (_, _, ws) in enumerate(spans.sentences(text)) if k not in gone[i] for w in ws]
            assert out[name].lower().split() == kept


def test_repeated_rows_and_odd_tables(spark, odd, nothing, clashing, odd_rows):
    rows = [(1, prose(5, 80)), (1, prose(5, 80)), (1, prose(5, 80))]
    out = spans.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(len(r["text"]) for r in out)[-1] == len(rows[0][1]) and sum(not r["text"].strip() for r in out) == 2
    assert spans.repeat_table(nothing).count() == 0 and spans.without_repeats(nothing).count() == 0
    assert spans.without_repeats(odd).count() == len(odd_rows)
    assert spans.without_repeats(clashing).columns == clashing.columns


def test_one_hot_span(spark):
    """A passage that half of all spans are: removed from all documents but the first."""
    passage = prose(77, 40)
    rows = [(i, f"{prose(1000 + i, 30)}\n{passage}" if i % 4 else prose(5000 + i, 30), "en", "s", 1) for i in range(240)]
    got = spans.repeat_table(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r["doc_id"] for r in got} == {i for i in range(240) if i % 4 and i != 1}
    assert sum(r["first_doc_id"] == 1 for r in got) > 170  # a run may begin in a sentence that two others share
