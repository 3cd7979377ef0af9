"""Wavelet matrices and token files: exact round trips."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loomframe.llm.token_files import WordEncoder, default_tokenizer, read_documents, token_shards, write_token_files
from loomframe.llm.wavelet import WaveletMatrix


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 3), (513, 50_257), (3000, 12), (1500, 70_000)])
def test_wavelet_access_rank_select(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    for w in (WaveletMatrix.of(ids), WaveletMatrix.from_bytes(WaveletMatrix.of(ids, 17).to_bytes())):
        assert (w.to_array() == ids).all()
        assert [w.access(i) for i in range(0, n, 37)] == ids[::37].tolist()
        for token in [*ids[:5].tolist(), top + 1]:
            places = np.flatnonzero(ids == token).tolist()
            assert w.count(token) == len(places) and w.occurrences(token) == places
            assert w.count(token, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)
        assert w.select(int(ids[0]) if n else 0, n + 1) == -1
        with pytest.raises(IndexError):
            w.access(n)


TEXTS = ["a  b", "", "x\n\ny z", "  lead", "tail ", "a\nb c.\nd", "<|endoftext|> x <|endoftext|>.", "it's John's. \tq", "a b c  d", "\n", " ",
         "é’s l’été", "a .b c,.; d1.5", "foo... bar!?\nBaz 12,3", "\x00 a b", "foo<|endoftext|>bar, x", "e\n f\n\ng"]


@pytest.mark.parametrize("most", [0, 5, 100_000])
def test_words_encode_as_whole_texts(most):
    plain, encoder = Tokenizer.from_file(default_tokenizer()), WordEncoder(default_tokenizer(), most)
    for _ in range(2):
        got = encoder.encode(TEXTS)
        for t, g in zip(TEXTS, got):
            assert np.frombuffer(g, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_files_round_trip(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    write_token_files(docs, str(tmp_path / "t"), default_tokenizer(), shard_tokens=5000)
    assert token_shards(spark, str(tmp_path / "t")).count() > 5
    rows = {r["doc_id"]: r for r in read_documents(spark, str(tmp_path / "t"), tokens=True).collect()}
    plain, at = Tokenizer.from_file(default_tokenizer()), 0
    for r in docs.orderBy("doc_id").collect():
        ids = plain.encode(r["text"], add_special_tokens=False).ids + [2]
        got = rows[r["doc_id"]]
        assert (got["ids"], got["start"], got["n_tokens"]) == (ids, at, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_odd_rows(spark, odd, empty, tmp_path):
    write_token_files(odd, str(tmp_path / "odd"), default_tokenizer())
    rows = read_documents(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert len(rows) == odd.count() and [r["doc_id"] for r in rows][:4] == [None, None, 1, 1]
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:i]) for i in range(len(rows))]
    write_token_files(empty, str(tmp_path / "empty"), default_tokenizer())
    assert read_documents(spark, str(tmp_path / "empty")).count() == 0


def test_line_breaks_make_no_words_of_their_own():
    plain, encoder = Tokenizer.from_file(default_tokenizer()), WordEncoder(default_tokenizer())
    texts = [f"{a}\n{b}" for a in ("one two.", "x é", "three,") for b in ("Two x", " y", "1 a", "\nTwo", "\x1cq", "Été!", "a\nb\nc")]
    for t, g in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(g, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t
    # the words around a line break are learned once each, not once for every pair of them
    assert "\nTwo" in encoder.kept and "two.\nTwo" not in encoder.kept


def test_texts_of_many_blocks(monkeypatch):
    """Words are kept with their marks, ids are put together by few texts at a time, and blocks are bounded in bytes."""
    import pyarrow as pa

    from loomframe.llm import token_files
    words = ["one", "one,", "two.", "two", "\u00e4ther", "x1!", "--", "<s>", "", "end\nstart", "a\tb"]
    draw = random.Random(9)
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(30))) for _ in range(200)] + ["", " ", "z" * 500]
    plain = Tokenizer.from_file(default_tokenizer())
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(token_files, "GATHERED", 7)
    monkeypatch.setattr(token_files, "BLOCK_TEXTS", 40)
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 2000)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    blocks = [b.column(1).to_pylist() for b in token_files.blocks_of(batch)]
    assert sum(blocks, []) == texts and all(len(b) <= 40 and sum(map(len, b)) <= 2000 for b in blocks)
    for most in (0, 6, 100):
        encoder = WordEncoder(default_tokenizer(), most)
        found = [np.frombuffer(d, "<u4").tolist() for b in blocks for d in encoder.encode(b)]
        assert found == want
        assert len(encoder.kept) <= most and ("two." in encoder.kept) == (most == 100)
