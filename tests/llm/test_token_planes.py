import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparktab.llm import token_planes as t

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def whole(text: str) -> list[int]:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, t.BLOCK - 1, t.BLOCK, 2 * t.BLOCK + 5])
def test_planes_round_trip(n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    payload = t.pack(ids)
    assert (t.unpack(payload) == ids).all()
    assert (t.unpack(payload, 1, 2) == ids[t.BLOCK : 2 * t.BLOCK]).all()
    with pytest.raises(ValueError):
        t.unpack(b"\0" * 12)


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]


def test_words_encode_as_their_text(monkeypatch):
    texts = ["", " ", "a\x1cb c\x85d", "É é ́x\n\nit's ### 12345", "<|startoftext|> a<|endoftext|>b < <|", "ΑΣ Σ\tq İ ǅ ﬁ", "日本語 😀😀", "a" * 3000, "İstanbul plain İ. x", "e\u0301. o\u0308 x², ½ Ⅷ. \u1100\u1161. a|b| c<| d|> e<>| word*** w### <\u0338 x_. y`", "don't. (it) x.y a.. ..a ª² ǅ, été!"]
    encoder = t.WordEncoder(PATH)
    for _ in range(3):  # new words, words seen before, words forgotten in between
        if _ == 2:
            monkeypatch.setattr(t, "REMEMBERED", 6)
            assert encoder.encode(pa.array(["plain words w*** plain"]))[0].tolist() == whole("plain words w*** plain")
        assert split(*encoder.encode(pa.array(texts))) == [whole(x) for x in texts]


def expected(rows):
    """By encoding every whole text and concatenating on the spot."""
    out, at = [], 0
    for name, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole(text or ""), 2]
        out.append((name, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_table_equals_whole_encoding(spark, odd, odd_rows, tmp_path):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = sorted((tuple(r) for r in t.token_table(odd, PATH).collect()), key=lambda r: r[1])
    want = expected(rows)
    assert [r[1] for r in got] == sorted(r[1] for r in got) and got[-1][1] + got[-1][2] == want[-1][1] + want[-1][2]
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in want if r[0] is not None)
    assert [r[0] for r in got] == [r[0] for r in want]
    t.write_ids(odd, PATH, str(tmp_path / "small"), segment_ids=100)
    again = sorted((tuple(r) for r in t.read_documents(spark, str(tmp_path / "small")).collect()), key=lambda r: r[1])
    assert [r[0::2] for r in again] == [r[0::2] for r in got]
    assert spark.read.parquet(str(tmp_path / "small")).count() > 5


def test_no_documents(nothing, clashing, odd_rows):
    assert t.token_table(nothing, PATH).count() == 0
    assert t.token_table(clashing, PATH).count() == len(odd_rows)
