"""Substring dedup by sliding spans of sentences.

A text is cut into sentences (after ``.``, ``!`` or ``?`` and white space, and at line ends).
A sentence of more than ``LONGEST`` words is cut into pieces after words that their checksum
chooses, or ``PIECE`` words, so that a passage is cut alike wherever in a long sentence it
stands; the pieces count as sentences. From every sentence on, the run of ``span``
sentences, or of as many more as it takes for ``least_words`` words, is hashed to 96 bits,
in lower case and with single blanks. Equal hashes meet in a global join; the occurrence in
the smallest doc_id (then row, then place) is the first and stays. A sentence that any
other occurrence covers is removed.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.llm.common import FILE, ROW, arrow, positions, text_slices
from sparktab.operators.support import spread_join
from sparktab.session import settled

LONGEST, PIECE = 16, 16
#: A cut falls after one word of so many, at least so many words after the last cut.
CUTS, APART = 4, 4
SPANS = f"doc_id long, {FILE} long, {ROW} long, at int, upto int, h1 long, h2 int"
END = re.compile(r"[.!?]+\s+|\n\s*")
WORD = re.compile(r"\S+")


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """The sentences with words: start, end (up to the next one's start) and words in lower case."""
    found, at = [], 0
    for cut in [*(m.end() for m in END.finditer(text)), len(text)]:
        piece = text[at:cut]
        words = piece.lower().split()
        if len(words) > LONGEST:
            starts, first = [m.start() for m in WORD.finditer(piece)], 0
            for i, word in enumerate(words, 1):
                if i == len(words) or i - first == PIECE or (i - first >= APART and zlib.crc32(word.encode("utf-8", "replace")) % CUTS == 0):
                    begin, end = starts[first] if first else 0, starts[i] if i < len(words) else len(piece)
                    found.append((at + begin, at + end, words[first:i]))
                    first = i
        elif words:
            found.append((at, cut, words))
        at = cut
    return found


def span_hashes(text: str, span: int, least_words: int) -> tuple[list[int], list[int], list[bytes]]:
    """Where spans start, where they end (not included) and their 96-bit hashes."""
    parts = [w for _, _, w in sentences(text)]
    joined, before = [" ".join(w) for w in parts], [0, *itertools.accumulate(map(len, parts))]
    starts, ends, end = [], [], 0
    for i in range(len(parts)):
        end = max(end, i + span)
        while end < len(parts) and before[end] - before[i] < least_words:
            end += 1
        if end > len(parts) or before[end] - before[i] < least_words:
            break
        starts.append(i)
        ends.append(end)
    return starts, ends, [xxhash.xxh3_128_digest("\n".join(joined[i:j]))[:12] for i, j in zip(starts, ends)]


def _spans(span: int, least_words: int):
    kinds = arrow(SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                found = [span_hashes(t, span, least_words) for t in texts]
                counts = [len(at) for at, _, _ in found]
                owner = pa.array(np.repeat(np.arange(len(texts)), counts))
                hashes = np.frombuffer(b"".join(h for _, _, hs in found for h in hs), dtype=[("h1", "<i8"), ("h2", "<i4")])
                at, upto = (pa.array([i for x in found for i in x[k]], type=pa.int32()) for k in (0, 1))
                columns = [part.column(c).take(owner) for c in ("doc_id", FILE, ROW)]
                yield pa.RecordBatch.from_arrays([*columns, at, upto, pa.array(hashes["h1"]), pa.array(hashes["h2"])], schema=kinds)

    return run


def _runs(rows: DataFrame, span: int, least_words: int) -> DataFrame:
    """(doc_id, file, row, first_sentence, n_sentences, first_doc_id) of all runs to remove."""
    spans = settled(rows.select("doc_id", FILE, ROW, "text").mapInArrow(_spans(span, least_words), SPANS), "spans")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW, "at")
    firsts = settled(spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    # a span that many documents share is spread over tasks
    joined = spread_join(spans, firsts.drop("n"), ["h1", "h2"], spread=F.xxhash64(FILE, ROW, "at"), counts=firsts)
    later = joined.where(place != F.col("first"))
    by_row = Window.partitionBy(FILE, ROW).orderBy("at")  # a window of one document's spans
    opens = (F.col("at") > F.lag("upto", 1).over(by_row)).cast("int")
    numbered = later.withColumn("__opens", F.coalesce(opens, F.lit(0))).withColumn("__run", F.sum("__opens").over(by_row))
    return numbered.groupBy(FILE, ROW, "__run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("at").alias("first_sentence"),
        (F.max("upto") - F.min("at")).cast("int").alias("n_sentences"),
        F.min_by("first.doc_id", "at").alias("first_doc_id"),
    )


def repeat_table(docs: DataFrame, span: int = 3, least_words: int = 13, scan: bool = False) -> DataFrame:
    """doc_id, first_sentence (from 0), n_sentences and first_doc_id of every removed run.

    ``first_doc_id`` is the document whose copy of the run's beginning stays. NULL and
    empty texts and texts of fewer sentences than a span have none; of repeated rows the
    first stays whole.
    """
    rows = positions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan)
    return _runs(rows, span, least_words).select("doc_id", "first_sentence", "n_sentences", "first_doc_id")


def without_repeats(docs: DataFrame, span: int = 3, least_words: int = 13, scan: bool = False) -> DataFrame:
    """``docs`` with its removed sentences cut out of ``text``; every row stays."""
    rows = positions(docs if scan else settled(docs, "rows"), True)
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), FILE, ROW, "text")
    cuts = _runs(slim, span, least_words).groupBy(FILE, ROW).agg(F.collect_list(F.struct("first_sentence", "n_sentences")).alias("__cuts"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(text, runs):
            if t is not None and r is not None and len(r):
                gone = {i for x in r for i in range(x["first_sentence"], x["first_sentence"] + x["n_sentences"])}
                t = "".join(t[a:b] for i, (a, b, _) in enumerate(sentences(t)) if i not in gone)
            out.append(t)
        return pd.Series(out, dtype=object)

    joined = rows.join(cuts, [FILE, ROW], "left").withColumn("text", cut("text", "__cuts"))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
