from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rolescope.llm.queries import BYTE_TOKENIZER, QUERIES
from rolescope.llm.token_files import (ChunkIds, TokenFile, bits_for, pack_bits, read_tokens,
                                       token_index, unpack_bits, write_tokens)

from .conftest import frame


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(BYTE_TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]


def digest(ids):
    return len(ids), zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def check(got, rows, encode):
    """Rows in ascending id order (NULL first), gapless starts, lengths and digests."""
    got = sorted(got, key=lambda r: r["start"])
    assert len(got) == len(rows)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"])
                  for r in got) == sorted((i is None, i or 0, *digest(encode(t)))
                                          for i, t, *_ in rows)


def test_equals_the_tokenizer(docs, corpus, encode):
    check(token_index(docs, BYTE_TOKENIZER).collect(), corpus, encode)


def test_query_on_whole_table(spark, sf_dir, encode):
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op11_token_files"](spark, sf_dir).collect(), rows, encode)


def test_small_files_and_blocks_give_the_same(docs, corpus, encode, tmp_path):
    path = str(tmp_path / "ids")
    got = token_index(docs, BYTE_TOKENIZER, path=path, file_ids=700, block_ids=64).collect()
    check(got, corpus, encode)
    files = [TokenFile(open(f, "rb").read()) for f in glob.glob(f"{path}/part-*")]
    files.sort(key=lambda f: (f.task, f.number))
    assert len(files) > 8 and all(f.bits == 16 for f in files)
    stream = np.concatenate([f.read(0, f.ids) for f in files])
    for r in got:  # random access across the files
        assert digest(stream[r["start"]:r["start"] + r["n_tokens"]]) \
            == (r["n_tokens"], r["ids_crc32"])
    for f in files[:5]:
        whole = f.read(0, f.ids)
        for a, b in ((0, 1), (63, 65), (64, 128), (f.ids - 1, f.ids + 9), (5, 5)):
            assert (f.read(a, b) == whole[a:b]).all()
        assert (np.concatenate([f.block(k) for k in range(f.blocks)]) == whole).all()


def test_empty_table(empty_docs, spark, tmp_path):
    assert token_index(empty_docs, BYTE_TOKENIZER).count() == 0


def test_one_id_for_many_rows_and_long_text(spark, encode):
    rows = [(7, f"text {i}", None) for i in range(300)] + [(None, None, None)] * 5 \
        + [(1, "word, " * 30000, None)] + [(7, "text 1", None)] * 3
    check(token_index(frame(spark, rows), BYTE_TOKENIZER).collect(), rows, encode)


def test_other_types_of_id(spark, tmp_path):
    df = spark.createDataFrame([("b", "x y"), ("a", "z"), (None, "")], "key string, body string")
    write_tokens(df, str(tmp_path / "t"), BYTE_TOKENIZER, id_col="key", text_col="body")
    got = read_tokens(spark, str(tmp_path / "t"), "string").collect()
    assert sorted((r["id"] or "", r["n_tokens"]) for r in got) == [("", 1), ("a", 2), ("b", 3)]


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 15, 16, 17, 24, 31, 32])
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1003):
        ids = rng.integers(0, 1 << bits, n).astype("<u4")
        data = pack_bits(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert (unpack_bits(data, bits, n) == ids).all()


def test_bits_for():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] \
        == [1, 1, 2, 8, 9, 16, 16, 17]


def test_chunks_give_what_whole_texts_give(encode):
    known = ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    pool = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "\x0b", "\xa0", " ", "\x1c",
            "\x85", "\x00", "a", "Thon", "naïve", "漢字", "don't", "it's", "'s", "1", "23", "4a",
            "!", "...", "#$", "<|endoftext|>", "_", "É", "ß", "é", "ǅ", "ⅷ", "½", "\U0001d4b3"]
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))
        assert np.frombuffer(known.encode(text), "<u4").tolist() + [2] == encode(text), text


def test_white_space_of_any_kind_and_marks_match_whole_texts():
    """Texts with uneven spaces take another path than those without; both give the whole's ids."""
    known = ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["", " ", "\n", "a\n", "a ", " a", "\na", "a\n\nb", "a  b", "a \nb", "a\n b", "a \tb",
             "a\t b", "a\xa0b \xa0c", "x  y", "a\n\tb", "été, naïve!!", " ½x", "x² y²,", "don't",
             "a_b c_", "_x", "ǅ ʰ a", "[x] (y)z", "Ünï,", "漢字 漢字.", "\x00 \x1f a", "1a a1, 2",
             "word " * 40 + "end", "x" * 200 + ", " + "y" * 200]
    for _ in range(2):  # from scratch, and from what is remembered
        for text in texts:
            assert known.encode(text) == known.whole(text), text


def test_frequent_chunks_stay_when_the_dictionaries_fill(monkeypatch):
    monkeypatch.setattr("rolescope.llm.token_files.REMEMBERED", 20)
    known = ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    asked, plain = [], known.tokenize
    known.tokenize = lambda text: (asked.append(text), plain(text))[1]
    for i in range(200):
        text = f"so common w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uv'[i // 100]}x"
        assert known.encode(text) == known.whole(text)
    assert sum(t.endswith("common") for t in asked) == 1
    assert all(len(d) <= 20 and len(d.old) <= 20 for d in
               (known.chunks, known.after_space, known.words))
