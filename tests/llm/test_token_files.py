import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import token_store as T
from tidemark.llm.queries import VOCABULARY, op13_token_files

from .conftest import SF

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


def plain(name=VOCABULARY):
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(name))


def expected(rows, tokenizer, end_id=1):
    """(key, start, tokens, checksum, ids) of rows (key, text) that are in order."""
    out, at = [], 0
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def read(spark, path):
    return [tuple(r) for r in T.token_rows(spark, path, with_ids=True).orderBy("start").collect()]


@given(st.lists(st.integers(0, 2**63), max_size=300))
@settings(max_examples=150, deadline=None)
def test_elias_fano_returns_every_value(values):
    v = sorted(values)
    coded = T.EliasFano(b"x" * 3 + T.EliasFano.encode(np.array(v, np.uint64)), 3)
    assert coded.all().tolist() == v
    assert [coded.select(i) for i in range(len(v))] == v


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 400, 10_000)).astype(np.uint64)
    bits = 8 * len(T.EliasFano.encode(ends)) / len(ends)
    assert bits < 2 + np.log2(int(ends[-1]) / len(ends)) + 32 / T.SAMPLE + 0.1


def test_block_round_trip_and_random_access():
    ids = [np.arange(n, dtype=np.uint32) % 50_000 for n in (1, 5, 1, 40_000, 3)]
    for keys in ([None, -7, -7, 0, 2**62], [None, "a", "bé", "bé", "z"], [None] * 5):
        data = (T.encode_block(3, 9, keys, [x.astype("<u2").tobytes() for x in ids], 2) + b"\n"
                + T.encode_block(3, 10, keys, [x.astype("<u4").tobytes() for x in ids], 4) + b"\n")
        first, second = T.blocks(data)
        assert (first.part, first.number, second.number) == (3, 9, 10)
        for b in (first, second):
            assert b.keys == keys and b.n_ids == sum(map(len, ids))
            assert all(np.array_equal(b.document(i), x) for i, x in enumerate(ids))
    with pytest.raises(ValueError):
        T.Block(b"NOTABLOCK" * 10)


def test_query_equals_plain_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected(sorted(map(tuple, docs)), plain())
    assert sorted(map(tuple, op13_token_files(spark, SF).collect())) == [w[:4] for w in want]


def test_small_blocks_and_files(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    path = str(tmp_path / "ids")
    T.write_token_files(df, path, T.Vocabulary(public_tokenizers.path(VOCABULARY), by_piece=True, kept_pieces=50),
                        block_ids=500, max_blocks=3)
    assert read(spark, path) == expected(sorted((r["doc_id"], r["text"]) for r in df.collect()), plain())
    files = sorted((tmp_path / "ids").glob("part-*"))
    assert len(files) > 4 and max(sum(1 for _ in T.blocks(f.read_bytes())) for f in files) <= 3


@pytest.mark.parametrize("name, by_piece", [("byte_bpe_50k.json", False), (VOCABULARY, False), (VOCABULARY, True)])
def test_odd_texts(spark, tmp_path, name, by_piece):
    texts = ["", None, " ", "\n\n", "don't  Stop", "İstanbul ΑΣ ΑΣΑ", "é ́x H̱", "\x1c a\x85b c　d",
             "a<|endoftext|>b <|endoftext|> <|startoftext|>", "½ ² 12 345", "😀👍🏽 x\ty\rz\x0bq", "word" * 5000,
             "many words " * 20_000, "'s 's ' s", "ﬁ ﬂ Ⅳ ­​﻿"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    path = str(tmp_path / "ids")
    T.write_token_files(df, path, T.Vocabulary(public_tokenizers.path(name), end_id=2, by_piece=by_piece), block_ids=100)
    assert read(spark, path) == expected(list(enumerate(texts)), plain(name), 2)


PIECES = st.text(alphabet="abcXYZÀéßœ019 \n\t.,!?;:()\"/-_%&@#*+=$¿¡|~^`{}[]\\>'<ĂŉΣİ\u0301ªº²½\x1c\x85\u2028字", max_size=60)


@given(st.lists(PIECES, max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_equal_whole_texts(texts):
    tokenizer = _PLAIN_TOKENIZER
    got = T._Pieces(tokenizer, 20, "<u2").ids(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


_PLAIN_TOKENIZER = plain()


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(T.pd, "factorize", lambda keys: (np.zeros(len(keys), np.int64), None))
    data = b"one two one 12 longer than sixteen bytes: abcdefghijklmnopqrstuvw abcdefghijklmnopqrstuvx two"
    starts, ends = T.split_pieces(data)
    numbers, distinct = T.number_pieces(data, starts, ends)
    assert [distinct[n] for n in numbers] == [data[a:b].decode() for a, b in zip(starts, ends)]
    assert len(set(distinct)) == len(distinct)


def test_the_table_of_pieces_is_bounded():
    pieces = T._Pieces(_PLAIN_TOKENIZER, 100, "<u4")
    texts = [f"Words w{chr(97 + i % 26)}x{'q' * (i % 40)} are met again, and {'again ' * (i % 7)}\nnot kept." for i in range(600)]
    for i in [*range(0, 600, 10), *range(0, 600, 10)]:
        for text, ids in zip(texts[i:i + 10], pieces.ids(texts[i:i + 10])):
            assert np.frombuffer(ids, "<u4").tolist() == _PLAIN_TOKENIZER.encode(text, add_special_tokens=False).ids
        assert len(pieces.young) + len(pieces.old) <= 250


def test_every_plain_character_splits_as_the_tokenizer_does():
    chars = [chr(i) for i in range(0x180) if T._PLAIN.fullmatch(chr(i))]
    texts = [f"{a}{c}{b}" for c in chars for a in "aé1. " for b in "Zß0, "]
    got = T._Pieces(_PLAIN_TOKENIZER, 10_000, "<u2").ids(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [_PLAIN_TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_tokenizer_without_word_ends_is_refused():
    with pytest.raises(ValueError):
        T._Pieces(plain("byte_bpe_50k.json"), 10, "<u2")


def test_edge_rows(spark, tmp_path, edge_docs, no_docs):
    vocabulary = T.Vocabulary(public_tokenizers.path(VOCABULARY), by_piece=True)
    path = str(tmp_path / "ids")
    T.write_token_files(edge_docs, path, vocabulary)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in edge_docs.collect()))
    got, at = read(spark, path), 0
    assert [r[0] for r in got] == [k if known else None for known, k, _ in rows]
    for _, start, n, crc, ids in got:
        assert start == at and n == len(ids) and crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += n
    whole = plain()
    assert sorted(r[4] for r in got) == sorted(whole.encode(t, add_special_tokens=False).ids + [1] for _, _, t in rows)
    T.write_token_files(no_docs, str(tmp_path / "none"), vocabulary)
    assert T.token_rows(spark, str(tmp_path / "none")).collect() == []


def test_text_keys(spark, tmp_path):
    df = spark.createDataFrame([("b", "one"), ("a", "two"), (None, "three"), ("b", "zero")], "doc_id string, text string")
    T.write_token_files(df, str(tmp_path / "ids"), T.Vocabulary(public_tokenizers.path(VOCABULARY)))
    got = read(spark, str(tmp_path / "ids"))
    assert [r[0] for r in got] == [None, "a", "b", "b"]
