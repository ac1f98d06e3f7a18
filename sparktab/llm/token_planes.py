"""Token ids in files of shuffled byte planes.

Documents are put in ascending doc_id order by a range partition and encoded; each
document ends with an end id. Ids are gathered into segments of whole documents, one row
of a Parquet table each, whose payload is

    magic, version, blocks                               3 x uint32
    the chunk index: per block                           offset uint64, ids uint32, bytes of each plane 4 x uint32
    the planes of all blocks                             zstandard frames

A block has ``BLOCK`` ids (the last fewer) as little-endian uint32, transposed: plane k has
byte k of all of them. High planes are nearly constant and shrink to nothing. The index
gives any id's block without decoding the rest. A segment's row also names its
documents and their numbers of ids. Lost tasks are run again by Spark's own writer.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.llm.common import FILE, ROW, arrow, positions
from sparktab.session import fresh_path

MAGIC, VERSION = 0x4C504449, 1
BLOCK = 65_536
HEAD, ENTRY = struct.Struct("<III"), struct.Struct("<QI4I")
SEGMENT = "part int, segment int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
#: Words whose ids a task remembers.
REMEMBERED = 1_200_000
#: Pieces that are encoded as one text.
TOGETHER = 256
#: Texts that are encoded together.
SLICE = 8_192
TEXT_BYTES = 16 << 20
#: Letters with or without ASCII marks behind them. No apostrophe, which tokenizers may treat
#: apart, and nothing that special tokens have.
PIECES = r"^(?P<letters>\p{L}+)(?P<marks>[!-&(-/:;=?@\[-`{}~|]*)$"


def pack(ids: np.ndarray, level: int = 1) -> bytes:
    """The payload of ids (uint32)."""
    squeeze = zstandard.ZstdCompressor(level=level)
    entries, frames, offset = [], [], 0
    for at in range(0, len(ids), BLOCK):
        block = np.ascontiguousarray(ids[at : at + BLOCK], dtype="<u4")
        planes = np.ascontiguousarray(block.view(np.uint8).reshape(-1, 4).T)
        made = [squeeze.compress(p.tobytes()) for p in planes]
        entries.append(ENTRY.pack(offset, len(block), *map(len, made)))
        frames += made
        offset += sum(map(len, made))
    return b"".join([HEAD.pack(MAGIC, VERSION, len(entries)), *entries, *frames])


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (not included; None: all)."""
    magic, version, blocks = HEAD.unpack_from(payload)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a payload of id planes")
    grow, data, out = zstandard.ZstdDecompressor(), HEAD.size + blocks * ENTRY.size, []
    for k in range(first, blocks if last is None else min(last, blocks)):
        offset, size, *lengths = ENTRY.unpack_from(payload, HEAD.size + k * ENTRY.size)
        planes, at = np.empty((4, size), dtype=np.uint8), data + offset
        for plane, length in zip(planes, lengths):
            plane[:] = np.frombuffer(grow.decompress(payload[at : at + length], max_output_size=size), dtype=np.uint8)
            at += length
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
    return np.concatenate(out) if out else np.empty(0, dtype="<u4")


class WordTable:
    """The ids of words one after the other, and how many each has."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids, self.sizes, self.starts = ids, sizes, np.cumsum(sizes) - sizes

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at ``index`` one after the other, and where each one's end."""
        count = self.sizes[index]
        ends = np.cumsum(count)
        where = np.repeat(self.starts[index] - ends + count, count)
        where += np.arange(len(where))
        return self.ids[where], ends


class WordEncoder:
    """Encodes texts word by word, with the ids of words seen before.

    Right for tokenizers that drop white space and never join characters across it, as
    word-end BPE does: the ids of a text are then those of its words one after the other.
    Text is cut at blanks and line ends only; other white space is left to the tokenizer.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.batch = 0
        self._hold(pa.array([""], type=pa.string()), np.empty(0, dtype="<u4"), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))

    def _hold(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> None:
        """The words known, their ids, and the batch in which each was last met."""
        self.words, self.table, self.last = words, WordTable(ids, sizes), last

    def _forget(self) -> None:
        """Keeps the words of the latest batches, at most half of what may be remembered."""
        order = np.sort(self.last)
        kept = np.union1d([0], np.flatnonzero(self.last > order[-(REMEMBERED // 2)]))
        ids, _ = self.table.gather(kept)
        self._hold(self.words.take(pa.array(kept)), ids, self.table.sizes[kept], self.last[kept])

    def _learn(self, words: pa.Array) -> None:
        """Remembers the ids of new words.

        Letters are one piece and the marks behind them another, so a word's ids are those of
        both; all other words are pieces whole. Only distinct pieces are encoded.
        """
        cut = pc.extract_regex(words, PIECES)
        core, marks = pc.struct_field(cut, 0), pc.struct_field(cut, 1)
        odd = pc.or_kleene(pc.is_null(core), pc.match_substring(words, "\u0130"))
        letters = pc.if_else(odd, "", core).dictionary_encode()
        behind = pc.if_else(odd, words, marks).dictionary_encode()
        ids, sizes = self._encoded(letters.dictionary.to_pylist())
        more, more_sizes = self._alone(behind.dictionary.to_pylist())
        parts = np.stack([letters.indices.to_numpy(), behind.indices.to_numpy() + len(sizes)], axis=1).ravel()
        pieces = WordTable(np.concatenate([ids, more]), np.concatenate([sizes, more_sizes]))
        made, ends = pieces.gather(parts)
        size = np.diff(np.r_[0, ends[1::2]])
        last = np.concatenate([self.last, np.full(len(size), self.batch)])
        self._hold(pa.concat_arrays([self.words, words]), np.concatenate([self.table.ids, made]), np.concatenate([self.table.sizes, size]), last)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of letters, many encoded as one text: a piece's last id is one that
        ends a word, which tells them apart. Where they don't add up, each is encoded alone."""
        parts, sizes = [np.empty(0, dtype="<u4")], [np.empty(0, dtype=np.int64)]
        for k in range(0, len(pieces), TOGETHER * 64):
            groups = [pieces[i : i + TOGETHER] for i in range(k, min(k + TOGETHER * 64, len(pieces)), TOGETHER)]
            for group, tokens in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
                ids = np.array(tokens.ids, dtype="<u4")
                size = np.diff(np.r_[-1, np.flatnonzero(self.ends[ids])])
                if len(size) != len(group) or size.sum() != len(ids):
                    ids, size = self._alone(group)
                parts.append(ids)
                sizes.append(size)
        return np.concatenate(parts), np.concatenate(sizes)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in found for i in x], dtype="<u4"), np.array([len(x) for x in found], dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids end.

        Arrow finds the words among those known; only new words are handled one by one.
        """
        self.batch += 1
        if len(self.words) > REMEMBERED:
            self._forget()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        tokens = lists.flatten()
        index = pc.fill_null(pc.index_in(tokens, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(index < 0)
        if len(new):
            coded, base = tokens.take(pa.array(new)).dictionary_encode(), len(self.words)
            self._learn(coded.dictionary)
            index[new] = base + coded.indices.to_numpy()
        self.last[index] = self.batch
        ids, ends = self.table.gather(index)
        count = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return ids, np.r_[0, ends][count]


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches put together up to about ``size`` bytes."""
    held, bytes_held = [], 0
    for batch in batches:
        held.append(batch)
        bytes_held += batch.nbytes
        if bytes_held >= size:
            yield pa.Table.from_batches(held)
            held, bytes_held = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _segments(path: str, end_id: int, segment_ids: int):
    kinds, end = arrow(SEGMENT), np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(path).encode
        names: list = []
        lengths: list[int] = []
        made: list[np.ndarray] = []
        number, held = 0, 0

        def row() -> pa.RecordBatch:
            cells = [part, number, held, names, lengths, pack(np.concatenate(made))]
            return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(cells, kinds)], schema=kinds)

        for some in _gathered(batches, TEXT_BYTES):
            for at in range(0, some.num_rows, SLICE):
                rows = some.slice(at, SLICE)
                ids, ends = encode(pc.fill_null(rows.column("text").combine_chunks(), ""))
                for name, a, b in zip(rows.column("doc_id").to_pylist(), [0, *ends.tolist()], ends.tolist()):
                    names.append(name)
                    lengths.append(b - a + 1)
                    made += [ids[a:b], end]
                    held += lengths[-1]
                    if held >= segment_ids:
                        yield row()
                        names, lengths, made, number, held = [], [], [], number + 1, 0
        if names:
            yield row()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, segment_ids: int = 1 << 20, scan: bool = False) -> None:
    """Writes the ids of all documents, in ascending doc_id order, to a folder.

    NULL doc_ids come first, equal ones in the order of their rows. NULL and empty texts
    are the end id alone. A segment has ``segment_ids`` ids and the rest of its last document.
    """
    rows = positions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan)
    order = [F.col("doc_id").asc_nulls_first(), F.col(FILE), F.col(ROW)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(_segments(tokenizer, end_id, segment_ids), SEGMENT).write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = arrow("part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            data, ends = unpack(row["payload"]).tobytes(), np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(sums)
            cells = [[row["part"]] * n, [row["segment"]] * n, row["doc_ids"], starts, row["lengths"], sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cells, kinds)], schema=kinds)


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the ids in the files."""
    files = spark.read.schema(SEGMENT).parquet(path)
    found = files.mapInArrow(_documents, "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    index = files.select("part", "segment", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = index.withColumn("ahead", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(parts, "part")
    placed = found.join(bases.select("part", "segment", (F.col("before") + F.col("ahead")).alias("base")), ["part", "segment"])
    return placed.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, scan: bool = False) -> DataFrame:
    """Writes the ids of all documents to the shared folder and reads them back (see above).

    An empty table writes no segments and gives no rows; repeated rows are encoded one by one.
    """
    path = fresh_path(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, path, scan=scan)
    return read_documents(docs.sparkSession, path)
