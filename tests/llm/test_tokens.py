"""Token files: exact round trip, against the tokenizer and zlib alone."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clicklens.llm import queries, tokens
from clicklens.session import scratch_path

from .conftest import SF

tokenizer = pytest.fixture(scope="module")(lambda: queries.word_tokenizer())


def written(spark, docs, tokenizer):
    path = scratch_path(spark, "tokens")
    tokens.write_token_files(tokens.token_ids(docs, tokenizer, 1), path)
    return path


def expected(rows, tokenizer):
    from tokenizers import Tokenizer

    t, start, out = Tokenizer.from_str(tokenizer), 0, []
    for doc_id, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_brute_force(lspark, tokenizer):
    docs = lspark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = [tuple(r) for r in queries.QUERIES["op1_token_files"](lspark, SF).orderBy("doc_id").collect()]
    assert got == expected([tuple(r) for r in docs], tokenizer)


def test_documents_cut_over_blocks(lspark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_TOKENS", 700)
    docs = lspark.createDataFrame([(i, f"word{i} is here " * (i * 37 % 900)) for i in range(40)], "doc_id long, text string")
    got = [tuple(r) for r in tokens.read_token_digests(lspark, written(lspark, docs, tokenizer)).orderBy("doc_id").collect()]
    assert got == expected([tuple(r) for r in docs.orderBy("doc_id").collect()], tokenizer)


def test_ids_read_back(lspark, tokenizer):
    docs = lspark.createDataFrame([(2, "b c"), (1, "a")], "doc_id long, text string")
    got = tokens.read_token_ids(lspark, written(lspark, docs, tokenizer)).orderBy("doc_id").collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer)
    assert [r["ids"] for r in got] == [[*t.encode(x, add_special_tokens=False).ids, 1] for x in ("a", "b c")]


def test_damaged_block_is_refused(lspark, tokenizer):
    docs = lspark.createDataFrame([(1, "some words")], "doc_id long, text string")
    path = written(lspark, docs, tokenizer)
    bad = lspark.read.parquet(f"{path}/blocks").selectExpr("*").withColumnRenamed("crc", "c").selectExpr("*", "c + 1 AS crc").drop("c")
    other = scratch_path(lspark, "tokens")
    bad.write.parquet(f"{other}/blocks")
    lspark.read.parquet(f"{path}/table").write.parquet(f"{other}/table")
    with pytest.raises(Exception, match="checksum"):
        tokens.read_token_digests(lspark, other).collect()


def test_odd_rows(lspark, tokenizer, odd_docs):
    got = tokens.read_token_digests(lspark, written(lspark, odd_docs, tokenizer)).orderBy("start").collect()
    assert len(got) == odd_docs.count()
    assert [r["doc_id"] for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4)} == {1}
    assert [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]))


def test_empty_table(lspark, tokenizer, no_docs):
    assert tokens.read_token_digests(lspark, written(lspark, no_docs, tokenizer)).collect() == []


def test_texts_with_special_marks(tokenizer):
    import pyarrow as pa

    e = tokens.TextEncoder(tokenizer)
    texts = ["<|endoftext|> A", "", "ΑΣ, σ’ς. İ ﬁ x a\x85b \x1c c", "x,\n y.  z.", "a),b, (c). 'tis, don't.", "É.é,Ê", "3.5, 4,5. 6"]
    want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    ids, cuts = e.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == want


@pytest.mark.parametrize("n, steps", [(2, 1), (300, 5), (50_000, 600)])
def test_coder_round_trip(n, steps):
    rng = np.random.default_rng(n)
    symbols = np.minimum(rng.zipf(1.3, (3, steps, tokens.LANES)) - 1, n - 1).astype(np.uint32)
    bits = tokens.scale_bits(n)
    freq = tokens.scaled(np.bincount(symbols.ravel(), minlength=n), bits)
    assert freq.sum() == 1 << bits and (freq[np.bincount(symbols.ravel(), minlength=n) > 0] > 0).all()
    rows = []
    for words, states, per_seg in tokens.encode_blocks(symbols, freq, bits):
        crc = zlib.crc32(per_seg, zlib.crc32(states, zlib.crc32(words)))
        rows.append({"words": words, "states": states, "segment_words": per_seg, "crc": crc, "n_tokens": steps * tokens.LANES, "block": 0, "shard": 0})
    f = freq.astype(np.uint64)
    slots = np.repeat(np.arange(n, dtype=np.uint32), freq)
    for (_, got), want in zip(tokens._decoded(rows, f, np.cumsum(f) - f, slots, bits), symbols):
        assert (got == want.ravel()).all()


def test_joined_checksums():
    a, b = b"some bytes", b"and the rest of them" * 100
    assert tokens._combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_random_texts_as_the_library_encodes_them():
    """Letters whose lower case is longer, marks, digits, scripts without spaces, controls and punctuation."""
    r = random.Random(11)
    alphabet = [*"aAbBzZ09.,;!?'\"-_<|> \n\t\r", "\u0130", "\u0131", "\u0307", "\u0301", "\u00df", "\u1e9e", "\u01c5", "\u03a3", "\u4e2d", "\u6587", "\u3042", "\u0e01", "\u0e31", "\u0915", "\u094d", "\u0660", "\u00b2", "\u00bd", "\u2019", "\u00a0", "\u200d", "\x00", "\x1c", "\x85", "\U0001f600", "\u00e9", "e\u0301", "\u00c9"]
    texts = ["".join(r.choices(alphabet, k=r.randint(1, 12))) for _ in range(20_000)]
    encoder = tokens.TextEncoder(queries.word_tokenizer())
    ids, cuts = encoder.encode(pa.array(texts))
    want = encoder._whole(texts)
    wrong = [(t, got.tolist(), w) for t, got, w in zip(texts, np.split(ids, cuts[1:-1]), want, strict=True) if got.tolist() != w]
    assert wrong == []
