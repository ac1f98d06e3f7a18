"""Toxicity by a subsequence string-kernel support vector machine with Nystrom landmarks.

A sentence is read as its words. Two words are compared by the subsequence kernel:
every ordered choice of ``order`` characters within ``span`` counts, weighted by
``decay`` to the length it stretches over, so inserted characters weaken a match but
don't break it. The kernel is normalised by both words' own values.

Learning: a document is a bag of sentences, a sentence a bag of words, and a bag's margin is
that of its worst word. A first machine is trained on words: those that occur in far more
toxic contexts than chance gives against words of clean documents. It is then trained on
sentences by what each stands or falls by: of every toxic document the sentence taken for
toxic most, if it is on the toxic side, of clean documents every sentence; sentences whose
hinge loss is zero don't count. Words of earlier rounds stay examples. Copies of examples
with inserted characters are added. ``landmarks`` words span the Nystrom features, in which
a linear machine is trained by hinge loss. A document's score is a logistic function of its
three highest word margins, fitted on labelled documents.

Scoring: the kernel is an inner product over subsequences, so landmarks and weights fold
into one table of a weight per subsequence, which is looked up for all words at once.
Subsequences are told by hashes, so letters of every script are symbols of their own.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import SLICE, arrow, crc_mod, logistic, text_slices
from sparktab.session import settled

#: A word's margin is told exactly above this, and as this below.
FLOOR = -1.0
#: Slots of a machine's table of weights, told by the first bits of a subsequence's hash (33.5 MB).
SLOT_BITS = 23
#: What two subsequences in one slot may shift a word's quick margin by.
SLACK = 0.1
#: A sentence ends here or at the end of a line.
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
#: Longer words are read in overlapping windows of so many characters.
WINDOW = 16
#: Words that a task remembers the margins of.
REMEMBERED = 150_000
SPACED = re.compile(r"(?<!\S)\w(?:[^\S\n]\w){2,}(?!\S)")
#: Closed-up words count for a document from this margin on: joined words of clean text often have small ones.
JOINED = 0.5
#: Letters of a fragment that is read together with the fragments next to it.
SHORT = 3
#: Trainings on sentences, each with the words that the machine before finds in them.
ROUNDS = 2
FRAGMENT = re.compile(r"[^\W_]+")
FRAGMENTS = re.compile(rf"(?<![^\W_])[^\W_]{{1,{SHORT}}}(?:(?:(?!\n)[\W_])+[^\W_]{{1,{SHORT}}})+(?![^\W_])")
EDGE = "\"'.,;:!?()[]{}<>|/\\#*$%&-_~`^+="


@functools.cache
def symbols() -> np.ndarray:
    """The symbol of each character: letters and digits have their own, marks share one, ^ and $ are word ends."""
    codes = np.fromiter((c + 4 if chr(c).isalnum() else 1 for c in range(0x110000)), np.uint64, 0x110000)
    codes[[ord("^"), ord("$")]] = 2, 3
    return codes


class StringKernel:
    """The subsequence kernel. Every letter and digit of any script is a symbol of its own, all marks are one.

    Subsequences are told by a 64-bit multilinear hash of their symbols.
    """

    def __init__(self, order: int = 4, span: int = 7, decay: float = 0.4) -> None:
        self.order, self.options = order, (order, span, decay)
        self.codes = symbols()
        self.factors = np.random.default_rng(5).integers(1 << 63, size=order, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shapes = [(*s, decay ** (s[-1] + 1)) for s in itertools.combinations(range(1, span), order - 1)]

    def __reduce__(self):
        return StringKernel, self.options

    def stream(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' symbols one after the other, each word between ^ and $, and whose they are."""
        marked = [f"^{w}$" for w in words]
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, marked), dtype=np.int64, count=len(words)))
        return self.codes[chars], owner

    def terms(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each shape of subsequence: whose they are, their hashes, their weight."""
        chars, owner = self.stream(words)
        placed = [chars * f for f in self.factors]
        for *offsets, weight in self.shapes:
            n = len(chars) - offsets[-1]
            if n <= 0:
                continue
            inside = np.flatnonzero(owner[:n] == owner[offsets[-1] :])
            which = placed[0][inside]
            for o, p in zip(offsets, placed[1:]):
                which += p[inside + o]
            yield owner[inside], which, weight

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors of length 1 of at most 65,536 words as (word, 48 bits of the hash, value) entries."""
        low = np.uint64(16)
        parts = [((o.astype(np.uint64) << np.uint64(48)) | (w >> low), np.full(len(o), v)) for o, w, v in self.terms(words)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
        keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        values = np.bincount(back, np.concatenate([v for _, v in parts]))
        word = (keys >> np.uint64(48)).astype(np.int64)
        norms = np.sqrt(np.bincount(word, values**2, minlength=len(words)))
        return word, keys & np.uint64((1 << 48) - 1), values / norms[word]

    def against(self, words: list[str], others: list[str]) -> np.ndarray:
        """Kernel values, a row for each word and a column for each of ``others``."""
        owner, which, value = self.features(others)
        known, back = np.unique(which, return_inverse=True)
        table = np.zeros((len(known), len(others)))
        table[back, owner] = value
        out = np.zeros((len(words), len(others)))
        for at in range(0, len(words), 500):
            word, sub, val = self.features(words[at : at + 500])
            where = np.searchsorted(known, sub)
            hit = (where < len(known)) & (known[np.minimum(where, len(known) - 1)] == sub)
            word, where, val = word[hit], where[hit], val[hit]
            if len(word):
                sums = np.add.reduceat(table[where] * val[:, None], starts := np.flatnonzero(np.r_[True, word[1:] != word[:-1]]))
                out[at + word[starts]] = sums
        return out


class Machine:
    """A trained machine: margins of words, scores of documents."""

    def __init__(self, kernel: StringKernel, landmarks: list[str], weights: np.ndarray, bias: float) -> None:
        self.kernel, self.bias = kernel, bias
        owner, which, value = kernel.features(landmarks)
        self.known, back = np.unique(which, return_inverse=True)
        self.weights = np.bincount(back, value * weights[owner], minlength=len(self.known))
        self.calibration = np.array([0.0, 1.0, 0.0, 0.0])
        self.fill()

    def fill(self) -> None:
        """Makes the table of slots, which does not travel with the machine."""
        self.table = np.zeros(1 << SLOT_BITS, dtype=np.float32)
        rising = np.argsort(self.weights)  # of two subsequences in a slot the larger weight stays
        self.table[(self.known >> np.uint64(48 - SLOT_BITS))[rising]] = self.weights[rising]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.fill()

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins of words, not below FLOOR; FLOOR for words that take more after clean examples.

        A vector's length is at least what it would be if no subsequence came twice; that
        bound and the table's slots settle most words, and only the rest are worked out exactly.
        """
        total, least = np.zeros(len(words)), np.zeros(len(words))
        for owner, which, weight in self.kernel.terms(words):
            total += np.bincount(owner, self.table[which >> np.uint64(64 - SLOT_BITS)], minlength=len(words)) * weight
            least += np.bincount(owner, minlength=len(words)) * weight**2
        out = np.full(len(words), FLOOR)
        most = total / np.sqrt(np.maximum(least, 1e-12)) + SLACK
        near = np.flatnonzero((most > 0) & (most + self.bias > FLOOR) & (least > 0)) if len(self.known) else []
        for at in range(0, len(near), 8_192):
            part = near[at : at + 8_192]
            word, which, value = self.kernel.features([words[i] for i in part])
            where = np.minimum(np.searchsorted(self.known, which), len(self.known) - 1)
            hit = self.known[where] == which
            exact = np.bincount(word[hit], self.weights[where[hit]] * value[hit], minlength=len(part))
            out[part] = np.where(exact > 0, np.maximum(exact + self.bias, FLOOR), FLOOR)
        return out

    def score(self, tops: np.ndarray) -> np.ndarray:
        """Scores from the three highest margins of documents."""
        return logistic(self.calibration[0] + tops @ self.calibration[1:])


def closed_up(text: str) -> set[str]:
    """Words that marks or blanks take apart, of a text in lower case.

    A word with marks in it is given without them. Fragments of up to ``SHORT`` letters, whatever marks
    and blanks of a line stand between them, are joined: each row of neighbours of 4 to ``WINDOW`` characters.
    """
    found = set()
    for w in set(text.split()):
        if not (w := w.strip(EDGE)).isalnum() and len(whole := "".join(FRAGMENT.findall(w))) >= 4:
            found.add(whole)
    for run in FRAGMENTS.findall(text):
        parts = FRAGMENT.findall(run)
        for i, word in enumerate(parts):
            for part in parts[i + 1 : i + WINDOW]:
                word += part
                if len(word) > WINDOW:
                    break
                if len(word) >= 4:
                    found.add(word)
    return windows({w for w in found if not w.isdecimal()})


def windows(words: set[str]) -> set[str]:
    """The words, long ones as overlapping windows."""
    long = [w for w in words if len(w) > WINDOW]
    return words.difference(long).union(w[i : i + WINDOW] for w in long for i in range(0, len(w) - WINDOW // 2, WINDOW // 2))


def words_of(text: str) -> set[str]:
    """The distinct words of a text, lower case, without punctuation around them.

    Runs of single letters are one word more, without their spaces; long words are given
    as overlapping windows. All of the text is read.
    """
    text = text.lower()
    words = {w.strip(EDGE) for w in set(text.split())}
    words.update(re.sub(r"\s", "", m) for m in SPACED.findall(text))
    words.discard("")
    return windows(words)


def contexts(text: str) -> set[tuple[str, str]]:
    """The distinct (word before, word) pairs of a text's sentences, words as in ``words_of``.

    A pair that many copies of a text share is one piece of evidence, not many.
    """
    found = set()
    for sentence in text.lower().split("\n"):
        words = [w.strip(EDGE) for w in sentence.split()]
        for before, word in zip(["", *words], words):
            if len(word) <= WINDOW:
                found.add((before, word))
            else:
                found.update((before, word[i : i + WINDOW]) for i in range(0, len(word) - WINDOW // 2, WINDOW // 2))
    return {x for x in found if x[1]}


class Reader:
    """Top margins of texts, with the margins of words seen before."""

    def __init__(self, machine: Machine) -> None:
        self.machine, self.seen, self.hot = machine, set(), {}

    def learn(self, words: set[str]) -> None:
        """Sees to it that ``hot`` has the words' margins above FLOOR."""
        if len(self.seen) > REMEMBERED:
            self.seen, self.hot = set(), {}
        new = list(words - self.seen)
        for at in range(0, len(new), 8_192):
            part = new[at : at + 8_192]
            margins = self.machine.margins(part)
            self.hot.update((part[i], margins[i]) for i in np.flatnonzero(margins > FLOOR))
        self.seen.update(new)

    def found(self, texts: list[str]) -> list[list[tuple[float, str]]]:
        """The words above FLOOR of each text with their margins, closed-up ones from JOINED on."""
        bags = [words_of(t) for t in texts]
        joins = [closed_up(t.lower()) - bag for t, bag in zip(texts, bags)]
        self.learn(set().union(*bags, *joins))
        hot = self.hot
        return [[(hot[w], w) for w in bag & hot.keys()] + [(m, w) for w in joined & hot.keys() if (m := hot[w]) >= JOINED] for bag, joined in zip(bags, joins)]

    def tops(self, texts: list[str]) -> np.ndarray:
        """The three highest margins of each text."""
        out = np.full((len(texts), 3), FLOOR)
        for i, words in enumerate(self.found(texts)):
            best = sorted((m for m, _ in words), reverse=True)[:3]
            out[i, : len(best)] = best
        return out

    def witnesses(self, text: str) -> dict[str, tuple[float, str]]:
        """Each different sentence's highest margin and the word that has it, of the sentences above FLOOR."""
        sentences = [t for t in dict.fromkeys(SENTENCE.split(text)) if t]
        return {t: max(words) for t, words in zip(sentences, self.found(sentences)) if words}


def hinge(features: np.ndarray, sign: np.ndarray, weight: np.ndarray, cost: float = 2.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """A linear machine by dual coordinate ascent; the bias is a feature held at 1."""
    x = np.c_[features, np.ones(len(features))]
    rng, alpha, w = np.random.default_rng(7), np.zeros(len(x)), np.zeros(x.shape[1])
    square, limit = (x**2).sum(axis=1), cost * weight
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (sign[i] * (x[i] @ w) - 1) / square[i], 0.0), limit[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def with_insertions(word: str, rng: np.random.Generator) -> str:
    """A copy with one symbol put into it, or one between all letters."""
    mark = "-.*_x1"[rng.integers(6)]
    if len(word) < 3 or rng.random() < 0.3:
        return mark.join(word)
    at = int(rng.integers(1, len(word)))
    return word[:at] + mark + word[at:]


def train(positive: dict[str, float], negative: dict[str, float], balanced: bool, landmarks: int = 256) -> Machine:
    """A machine from words and how often each counts; ``balanced``: either side counts as much as the other.

    Without examples of both kinds it calls nothing toxic.
    """
    rng = np.random.default_rng(11)
    kernel = StringKernel()
    if not positive or not negative:
        return Machine(kernel, [], np.empty(0), FLOOR)
    gapped = {with_insertions(w, rng): n for w, n in positive.items() for _ in range(2)}
    broken = {with_insertions(w, rng): n for w, n in itertools.islice(negative.items(), len(gapped))}
    spread = lambda xs, n: [xs[i] for i in np.linspace(0, len(xs) - 1, min(n, len(xs))).astype(int)]
    toxic = spread(list(positive), landmarks * 2 // 3)
    chosen = list(dict.fromkeys(toxic + spread(list(negative), landmarks - len(toxic))))
    sides = [(1.0, [*positive.items(), *gapped.items()]), (-1.0, [*negative.items(), *broken.items()])]
    words = [w for _, side in sides for w, _ in side]
    sign = np.concatenate([np.full(len(side), kind) for kind, side in sides])
    share = np.array([n for _, side in sides for _, n in side])
    if balanced:
        share = share * np.where(sign > 0, len(sign) / (2 * (sign > 0).sum()), len(sign) / (2 * (sign < 0).sum()))
    values, vectors = np.linalg.eigh(kernel.against(chosen, chosen))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    w, bias = hinge(kernel.against(words, chosen) @ root, sign, share)
    return Machine(kernel, chosen, root @ w, bias)


def calibrate(machine: Machine, tops: np.ndarray, labels: np.ndarray) -> None:
    """Fits the logistic function from three margins to the label, by Newton steps."""
    if len(set(labels.tolist())) < 2:
        machine.calibration = np.array([-4.0 if not labels.any() else 0.0, 1.0, 0.0, 0.0])
        return
    x, theta = np.c_[np.ones(len(tops)), tops], np.zeros(4)
    for _ in range(30):
        p = logistic(x @ theta)
        slope = x.T @ (labels - p) - 0.01 * theta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(4)
        step = np.linalg.solve(curve, slope)
        theta += step
        if np.abs(step).max() < 1e-8:
            break
    machine.calibration = theta


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = arrow("before string, word string, clean boolean")
    for batch in batches:
        for part, texts in text_slices(batch, "text"):
            rows = {(*x, not y) for t, y in zip(texts, part.column("label").to_pylist()) for x in contexts(t)}
            before, word, clean = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip((before, word, clean), kinds)], schema=kinds)


def _witnesses(labelled: DataFrame, machine: Machine) -> DataFrame:
    """word, toxic, times: how many different sentences of toxic or clean documents stand or fall by a word.

    Of a toxic document only the sentence that the machine takes for toxic most counts, of a clean one all;
    sentences at FLOOR are on the right side or out of reach and don't count.
    """
    held = labelled.sparkSession.sparkContext.broadcast(machine)
    kinds = arrow("word string, toxic boolean, sentence string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value)
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                rows = []
                for text, label in zip(texts, part.column("label").to_pylist()):
                    found = [(m, w, t) for t, (m, w) in reader.witnesses(text).items()]
                    worst = [x for x in [max(found, default=(0.0, "", ""))] if x[0] > 0]
                    rows += [(w, bool(label), t) for _, w, t in (worst if label else found)]
                columns = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, kinds)], schema=kinds)

    pairs = labelled.mapInArrow(run, "word string, toxic boolean, sentence string")
    return pairs.groupBy("word", "toxic", F.xxhash64("sentence")).count().groupBy("word", "toxic").agg(F.count("*").alias("times"))


def fit(labelled: DataFrame, examples: int = 1_500, rounds: int = ROUNDS, most: int = 50_000) -> Machine:
    """Trains on rows (text, label). The caller bounds their number; every one is read whole.

    The first machine is trained on words: counts are made by Spark over all the rows, and
    ``examples`` words of each kind (often and by chance clean, toxic) reach the driver. The
    next ones are trained on sentences, by the words that they stand or fall by, of which the
    ``most`` that decide most sentences reach the driver in each round.
    """
    pairs = labelled.mapInArrow(_contexts, "before string, word string, clean boolean")
    by_pair = pairs.groupBy("before", "word").agg(F.max("clean").alias("clean"))
    words = settled(by_pair.groupBy("word").agg(F.count_if(~F.col("clean")).alias("bad"), F.count_if("clean").alias("good")), "words")
    sums = words.agg(F.sum("bad"), F.sum("good"), F.count_if(F.col("bad") > 0)).first()
    bad, good, kinds = (x or 0 for x in sums)
    if not bad or not good:
        return train({}, {}, True)
    # a word of so many toxic contexts and no clean one is not expected once by chance
    least = max(3, math.ceil(math.log(kinds + 1) / -math.log(bad / (bad + good))))
    first = lambda df, *by: [r["word"] for r in df.orderBy(*by, "word").limit(examples).collect()]
    toxic = first(words.where((F.col("bad") >= least) & (F.col("good") * 50 <= F.col("bad"))), F.desc("bad"))
    seen_clean = words.where("good > 0")
    clean = dict.fromkeys(first(seen_clean, F.desc("good")) + first(seen_clean, F.xxhash64("word")), 1.0)
    guilty = dict.fromkeys(toxic, 1.0)
    machine = train(guilty, clean, True)
    for _ in range(rounds if toxic else 0):
        found = _witnesses(labelled, machine).orderBy(F.desc("times"), "word", "toxic").limit(most).collect()
        for r in found:
            side = guilty if r["toxic"] else clean
            side[r["word"]] = max(side.get(r["word"], 0.0), float(r["times"]))
        machine = train(guilty, clean, False)
    tops = labelled.select(F.col("label"), top_margins(labelled, machine)(F.col("text")).alias("tops")).collect()
    calibrate(machine, np.array([r["tops"] for r in tops]).reshape(-1, 3), np.array([r["label"] for r in tops], dtype=float))
    return machine


def top_margins(df: DataFrame, machine: Machine):
    """A pandas UDF: text -> its three highest word margins."""
    held = df.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(held.value)
        for part in parts:
            texts = part.fillna("").tolist()
            yield pd.Series([row for at in range(0, len(texts), SLICE) for row in reader.tops(texts[at : at + SLICE])])

    return run


def toxicity(df: DataFrame, machine: Machine, text: str = "text") -> Column:
    """The score (0 to 1) of a text column. NULL counts as the empty text, which has the score of no insult."""
    held = df.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(held.value)
        for part in parts:
            texts = part.fillna("").tolist()
            scores = [held.value.score(reader.tops(texts[at : at + SLICE])) for at in range(0, len(texts), SLICE)]
            yield pd.Series(np.concatenate(scores) if scores else np.empty(0))

    return run(F.col(text))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled documents for which ``learn`` holds, by hash of doc_id.

    A document labelled twice has the higher label; rows without a doc_id or label don't count.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("label"))
    some = settled(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labels")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settled(slim.join(F.broadcast(some), "doc_id").select("text", "label"), "labelled")  # at most `most` rows


def trained(docs: DataFrame, labels: DataFrame, most: int = 12_000) -> Machine:
    """A machine from the labelled documents that aren't held out (crc32 of doc_id mod 4 is 2)."""
    return fit(labelled_sample(docs, labels, "toxic", crc_mod("doc_id", 4) != 2, most))


def toxicity_table(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    NULL and empty texts have the score of a text without insults; a NULL doc_id is not
    held out; repeated rows get equal scores. Without labels of both kinds all scores are low.
    """
    machine = trained(docs, labels)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text")
    scored = slim.withColumn("score", toxicity(docs, machine)).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, with all their columns."""
    return docs.where(toxicity(docs, trained(docs, labels)) < threshold)
