"""Benchmark decontamination: a BM25 index of test items, searched by block-max WAND.

Every training text is read in passages of twice the longest item's words, which overlap
by half, so that any copy of an item lies whole in a passage. A passage queries the
index of items for all those that score at least ``threshold`` of what they score for
themselves. An item found is a leak if the passage has at least ``overlap`` of the item's
words and ``part_overlap`` of its question's and of its answer's, each part's in their order
and within twice its length. A changed, lost or inserted word so costs one word, not a run.

Nearly all passages are cleared by a bound that is summed up for all passages of a text at
once: rare words add their impact on the items that have them, common words what they can
add to any item at most. The passages left are searched with block maxima.

The index is broadcast, so it holds about ``index_items`` items at most; more items make more
indexes, one pass over the texts each, in tasks that hold one index. Document frequencies,
mean length and passage length come from all items, so their scores don't depend on the cut.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.llm.common import FILE, ROW, positions
from sparktab.session import settled

K1, B = 1.2, 0.75
#: Common words may be left out of an item's sum up to this part of its score; thresholds are higher.
MOST_SLACK = 0.25
#: Postings in a block of the search.
POSTING_BLOCK = 16
#: Cells that a task may lay out to add up a text's passages.
DENSE = 1 << 20
#: Words in more than this part of the items are common.
COMMON = 0.1
LEAKS = "array<struct<item_id:bigint,passages:int,score:double,question_overlap:double,answer_overlap:double>>"
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of all sentences but the last, and of the last; halves if there is just one."""
    sentences = [w for s in re.split(r"(?<=[.!?])\s+|\n", text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    return words[: -(-len(words) // 2)], words[-(-len(words) // 2) :]


def common_in_order(part: list[str], words: list[str]) -> int:
    """Length of the longest common subsequence, one bit per word of ``part``."""
    places: dict[str, int] = defaultdict(int)
    for k, w in enumerate(part):
        places[w] |= 1 << k
    full = open_bits = (1 << len(part)) - 1
    for w in words:
        if w in places:
            taken = open_bits & places[w]
            open_bits = ((open_bits + taken) | (open_bits - taken)) & full
    return len(part) - open_bits.bit_count()


def held(part: list[str], passage: list[str]) -> int:
    """How many words of a part the passage has in order, within a stretch of twice the part's length."""
    size = len(part)
    stretches = range(0, max(1, len(passage) - size), size) if size else []
    return max((common_in_order(part, passage[k : k + 2 * size]) for k in stretches), default=0)


def share(count: int, size: int) -> float:
    return count / size if size else 1.0


def distinct(keys: np.ndarray, size: int) -> np.ndarray:
    """The different keys (all under ``size``) in order; small ranges are marked, not sorted."""
    if size > DENSE:
        return np.unique(keys)
    marks = np.zeros(size, dtype=bool)
    marks[keys] = True
    return np.flatnonzero(marks)


def summed(keys: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys and the sum of positive values at each."""
    if size > DENSE:
        found, back = np.unique(keys, return_inverse=True)
        return found, np.bincount(back, values)
    sums = np.bincount(keys, values, minlength=size)
    found = np.flatnonzero(sums)
    return found, sums[found]


class Statistics(NamedTuple):
    """Of all items with words: their number, words and longest, and how many have each term."""

    items: int
    words: int
    longest: int
    having: dict[str, int]


class Index:
    """An inverted index of items (id, question words, answer words).

    Impacts are BM25 weights divided by the item's score for its own text. Items without
    words can't be found. ``known`` is given if the items are a part of all.
    """

    def __init__(self, items: list[tuple[int, list[str], list[str]]], known: Statistics | None = None) -> None:
        self.items = sorted((x for x in items if x[1] or x[2]), key=lambda x: (x[1] + x[2], x[0]))
        counts = [Counter(q + a) for _, q, a in self.items]
        lengths = [sum(c.values()) for c in counts]
        if known is None:
            known = Statistics(len(counts), sum(lengths), max(lengths, default=1), Counter(t for c in counts for t in c))
        self.reach, docs = known.longest, known.having
        mean = known.words / max(1, known.items)
        idf = {t: math.log(1 + (known.items - docs[t] + 0.5) / (docs[t] + 0.5)) for c in counts for t in c}
        self.postings: dict[str, tuple[list[int], list[float], list[float], float]] = {}
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.slack = np.zeros(len(counts))
        rare: dict[str, dict[int, float]] = defaultdict(dict)
        for i, c in enumerate(counts):
            weight = {t: idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * lengths[i] / mean)) for t, n in c.items()}
            own = sum(weight.values())
            common = {t for t in weight if docs[t] > max(1, COMMON * known.items)}
            if sum(weight[t] for t in common) > MOST_SLACK * own:
                common = set()  # an item of common words: all of them are summed up
            for t, w in weight.items():
                lists[t].append((i, w / own))
                if t in common:
                    self.slack[i] += w / own
                else:
                    rare[t][i] = w / own
        for t, pairs in lists.items():
            impacts = [w for _, w in pairs]
            tops = [max(impacts[k : k + POSTING_BLOCK]) for k in range(0, len(impacts), POSTING_BLOCK)]
            self.postings[t] = ([i for i, _ in pairs], impacts, tops, max(impacts))
        self.number = {t: k for k, t in enumerate(rare)}
        self.starts = np.cumsum([0, *(len(r) for r in rare.values())])
        self.having = np.array([i for r in rare.values() for i in r], dtype=np.int64)
        self.impacts = np.array([w for r in rare.values() for w in r.values()])

    def passages(self, words: list[str], threshold: float) -> list[int]:
        """Starts of the passages that the bound doesn't clear."""
        known = np.fromiter(map(self.number.get, words, [-1] * len(words)), dtype=np.int64, count=len(words))
        at = np.flatnonzero(known >= 0)
        if not len(at):
            return []
        step = at // self.reach  # a passage is two steps long
        words_known, items = len(self.number), len(self.items)
        steps = int(step[-1]) + 1
        keys = np.r_[step, step[step > 0] - 1] * words_known + known[np.r_[at, at[step > 0]]]
        passage, term = np.divmod(distinct(keys, steps * words_known), words_known)
        size = self.starts[term + 1] - self.starts[term]
        where = np.repeat(self.starts[term] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        cells, reached = summed(np.repeat(passage, size) * items + self.having[where], self.impacts[where], steps * items)
        reached += self.slack[cells % items]
        return (np.unique(cells[reached >= threshold - 1e-9] // items) * self.reach).tolist()

    def search(self, terms: set[str], threshold: float) -> list[tuple[int, float]]:
        """All items that score ``threshold`` or more for a passage's words, by block-max WAND."""
        lists = [(*self.postings[t], [0]) for t in terms if t in self.postings]  # ids, impacts, tops, top, place
        found, bar = [], threshold - 1e-9
        while lists:
            lists.sort(key=lambda x: x[0][x[4][0]])
            reach, pivot = 0.0, -1
            for k, x in enumerate(lists):
                reach += x[3]
                if reach >= bar:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][4][0]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][4][0]] == item:
                pivot += 1
            bound, until = 0.0, lists[pivot + 1][0][lists[pivot + 1][4][0]] if pivot + 1 < len(lists) else len(self.items)
            for ids, _, tops, _, place in lists[: pivot + 1]:
                p = bisect.bisect_left(ids, item, place[0])
                if p < len(ids):
                    bound += tops[p // POSTING_BLOCK]
                    ends = min(len(ids), (p // POSTING_BLOCK + 1) * POSTING_BLOCK) - 1
                    until = min(until, ids[ends] + 1)
            if bound >= bar:
                score = 0.0
                for ids, impacts, _, _, place in lists[: pivot + 1]:
                    place[0] = bisect.bisect_left(ids, item, place[0])
                    if place[0] < len(ids) and ids[place[0]] == item:
                        score += impacts[place[0]]
                        place[0] += 1
                if score >= bar:
                    found.append((item, score))
            else:  # no item before `until` can make it with these lists
                for ids, _, _, _, place in lists[: pivot + 1]:
                    place[0] = bisect.bisect_left(ids, max(until, item + 1), place[0])
            lists = [x for x in lists if x[4][0] < len(x[0])]
        return found

    def leaks(self, text: str, threshold: float, overlap: float, part_overlap: float = 0.5) -> list[dict]:
        """The items that a text leaks: passages that do so, and the best one's figures."""
        words = words_of(text)
        best: dict[int, dict] = {}
        for start in self.passages(words, threshold) if self.items else []:
            passage = words[start : start + 2 * self.reach]
            for i, exact in self.search(set(passage), threshold):
                name, question, answer = self.items[i]
                score = round(min(exact, 1.0), 9)  # the order of the sum isn't part of it
                had = held(question, passage), held(answer, passage)
                parts = share(had[0], len(question)), share(had[1], len(answer))
                if min(parts) < part_overlap or share(sum(had), len(question) + len(answer)) < overlap:
                    continue
                row = best.setdefault(i, {"item_id": name, "passages": 0, "score": 0.0, "question_overlap": 0.0, "answer_overlap": 0.0})
                row["passages"] += 1
                if (score, *parts) > (row["score"], row["question_overlap"], row["answer_overlap"]):
                    row["score"], row["question_overlap"], row["answer_overlap"] = score, *parts
        return [best[i] for i in sorted(best, key=lambda i: self.items[i][0])]


@F.pandas_udf(T.ArrayType(T.StringType()))
def item_words(texts: pd.Series) -> pd.Series:
    return pd.Series([[w for part in question_and_answer(t) for w in part] for t in texts], dtype=object)


def indexes(items: DataFrame, index_items: int) -> Iterator[Index]:
    """Indexes of (item_id, text), of about ``index_items`` items each; the driver holds one at a time."""
    slim = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    parts = -(-slim.count() // index_items)
    if parts <= 1:
        yield Index(split_items(slim))
        return
    worded = settled(slim.withColumn("words", item_words("text")), "items")
    size = F.size("words")
    totals = worded.where(size > 0).agg(F.count("*"), F.sum(size), F.max(size)).first()
    having = settled(worded.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").count(), "item-terms")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        mine = worded.where(part == k)
        terms = mine.select(F.explode("words").alias("term")).distinct()
        known = {r["term"]: r["count"] for r in having.join(terms, "term").collect()}
        yield Index(split_items(mine), Statistics(totals[0], totals[1] or 0, totals[2] or 1, known))


def split_items(items: DataFrame) -> list[tuple[int, list[str], list[str]]]:
    return [(r["item_id"], *question_and_answer(r["text"])) for r in items.select("item_id", "text").collect()]


def searches(spark: SparkSession, items: DataFrame, threshold: float, overlap: float, part_overlap: float, index_items: int) -> list[Callable[[Column], Column]]:
    """For each index, the array of the items that a text leaks, with their figures; empty for NULL and empty texts."""
    if threshold <= MOST_SLACK:
        raise ValueError(f"threshold must be over {MOST_SLACK}")
    return [_leaks_of(spark.sparkContext.broadcast(index), threshold, overlap, part_overlap) for index in indexes(items, index_items)]


def _leaks_of(index, threshold: float, overlap: float, part_overlap: float) -> Callable[[Column], Column]:
    @F.pandas_udf(LEAKS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([index.value.leaks(t, threshold, overlap, part_overlap) for t in part.fillna("").tolist()], dtype=object)

    return run


def leak_table(
    docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.8, part_overlap: float = 0.5, index_items: int = 20_000
) -> DataFrame:
    """doc_id, item_id, passages, score, question_overlap, answer_overlap of every leak.

    ``passages`` counts the passages with the whole item (two where it lies in their
    overlap). Repeated rows give repeated rows. Items and texts that are NULL or without
    words leak nothing; an item repeated under several ids leaks under each. Each index
    has tasks of its own.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [slim.select("doc_id", F.inline(search(F.col("text")))) for search in searches(docs.sparkSession, items, threshold, overlap, part_overlap, index_items)]
    return reduce(DataFrame.unionByName, found) if found else slim.select("doc_id", F.inline(F.array().cast(LEAKS)))


def without_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.8, part_overlap: float = 0.5, index_items: int = 20_000
) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns.

    With several indexes, the rows that each of them finds are named by file and row and taken out together.
    """
    found = searches(docs.sparkSession, items, threshold, overlap, part_overlap, index_items)
    if len(found) == 1:
        return docs.where(F.size(found[0](F.col("text"))) == 0)
    if not found:
        return docs
    rows = positions(docs)
    leaky = [rows.where(F.size(search(F.col("text"))) > 0).select(FILE, ROW) for search in found]
    return rows.join(reduce(DataFrame.unionByName, leaky), [FILE, ROW], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
