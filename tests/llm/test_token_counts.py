import random

import numpy as np
import public_tokenizers
import pytest
from conftest import LONG, ODD
from landsurvey.llm import queries
from landsurvey.llm import token_counts as op
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, len((r.text or "").encode()), n, n > 2048) for r, n in zip(docs, whole([r.text for r in docs]), strict=True)}
    assert set(map(tuple, queries.op6_token_counts(spark, sf_dir).collect())) == want


def test_odd_rows(spark, odd, nothing):
    rows = op.token_counts(spark, odd, PATH).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(whole([t for _, t in ODD]))
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert op.token_counts(spark, nothing, PATH).count() == 0


def array(raw):
    return np.frombuffer(raw, np.uint8)


def test_chunks_equal_whole_encoding():
    rng = random.Random(1)
    counter = op.Counter(PATH)
    letters = "ab 'sé É\n\t<|endoftext|>0 9 .,́  \x1c\x85Σς中日.,. "
    for i in range(400):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 900)))
        t += "<|endoftext|>" + t[: i % 50] if i % 3 == 0 else ""
        t += "a" * 400 + "é" * 300 if i % 7 == 0 else ""
        raw, want = t.encode(), counter.whole([t])[0]
        bounds = np.array([0, 0, len(raw), 2 * len(raw)])
        for chunk, overlap in ((1 << 20, 256), (rng.choice([40, 100, 200]), rng.choice([4, 16, 30]))):
            counter.chunk, counter.overlap = chunk, overlap
            assert counter.counts(array(raw + raw), bounds).tolist() == [0, want, want]
        assert counter.widened(array(raw)) == want
    counter.chunk, counter.overlap = op.CHUNK, op.OVERLAP
    assert counter.counts(array(LONG.encode()), np.array([0, len(LONG)])).tolist() == counter.whole([LONG])


def test_many_texts_of_the_corpus_are_spliced(monkeypatch):
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    sizes = [len(t.encode()) for t in texts]
    assert sum(n for n in sizes if n > op.CHUNK) > 0.4 * sum(sizes)
    splices, splice = [], op.Counter.splice
    monkeypatch.setattr(op.Counter, "splice", staticmethod(lambda *a: splices.append(splice(*a)) or splices[-1]))
    got = op.Counter(PATH).counts(array("".join(texts).encode()), np.concatenate([[0], np.cumsum(sizes)]))
    assert got.tolist() == whole(texts)
    assert len(splices) > 200 and None not in splices


def test_a_text_without_blanks_takes_time_in_proportion():
    rng = random.Random(2)
    text = "".join(rng.choice("abc01中é/+") for _ in range(300_000))
    counter, sizes, pieces = op.Counter(PATH), [], op.Counter.pieces
    counter.pieces = lambda raw, bounds: sizes.append(len(raw)) or pieces(counter, raw, bounds)
    text += " and words after it" * 500
    assert counter.counts(array(text.encode()), np.array([0, len(text.encode())])).tolist() == counter.whole([text])
    assert sum(sizes) < 8 * len(text.encode())


def test_equal_hashes_of_different_words_are_told_apart(monkeypatch):
    monkeypatch.setattr(op, "word_hashes", lambda raw, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    counter = op.Counter(PATH)
    for text in ("cat dogs dog cats extraordinarily cat", "dog ab xyzzyq cat ÀÉ dogs"):
        assert counter.counts(array(text.encode()), np.array([0, len(text.encode())])).tolist() == counter.whole([text])


def test_unproven_tokenizers_are_refused():
    with pytest.raises(ValueError, match="stable"):
        op.Counter(public_tokenizers.path("byte_bpe_50k.json"))
