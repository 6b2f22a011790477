"""Operators 4 and 5 against the tokenizers library itself."""

import hashlib
import random
import tracemalloc

import pytest
from public_tokenizers import path as tokenizer_path

from tallyline.llm import bpe, token_counts
from tallyline.llm.common import tokenizer

PATH = tokenizer_path("word_bpe_49k.json")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

random.seed(5)
WORDS = ["the", "Don't", "naïve", "Ünïcode", "😀😀", "x<|endoftext|>y", "3.14159", "hello,world", "éte", "\x1cz", "İstanbul"]
TEXTS = [
    None, "", "   \n\t ", "a", "Hello  World\r\nagain there x", "<|startoftext|><|endoftext|>", "'s 're don'T",
    " ".join(random.choice(WORDS) for _ in range(500)), "ab" * 3000, "the cat", "the cat", "1\x1c2 \x85 3",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "clash", 1) for k, t in enumerate(TEXTS)] + [(None, "no id", "c", None), (3, "repeated id", None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n_tokens int")


def reference(text):
    t = tokenizer(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("head", [0, 3, 200_000])
def test_encoding_equals_the_library(docs, head):
    got = sorted(tuple(r) for r in bpe.encode(docs, PATH, head=head).collect() if r.doc_id is not None)
    want = sorted((r.doc_id, *reference(r.text)) for r in docs.collect() if r.doc_id is not None)
    assert got == want
    assert bpe.encode(docs, PATH).where("doc_id is null").count() == 1


def test_a_task_holds_little_beside_the_table(docs, monkeypatch):
    # 150,000 words that occur once each: what a task keeps of them must not grow to all of them.
    passes, made = [], bpe.per_partition
    monkeypatch.setattr(bpe, "per_partition", lambda df, schema, fn, **k: passes.append(fn) or made(df, schema, fn, **k))
    bpe.encode(docs, PATH, head=3, keep_ids=True)
    slices = ({"doc_id": [k], "text": [" ".join(f"w{k}x{j}" for j in range(1_000))]} for k in range(150))
    tokenizer(PATH)
    tracemalloc.start()
    n = sum(sum(out["n_tokens"]) for out in passes[-1](slices))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 150_000 and peak < 30e6


def test_decoding_through_the_join(docs):
    kept = bpe.encode(docs, PATH, keep_ids=True).cache()
    joined = sorted((r.doc_id or -1, r.decoded) for r in bpe.decode(kept, PATH).collect())
    assert joined == sorted((r.doc_id or -1, r.decoded) for r in kept.collect())
    assert all(sha(r.decoded) == r.decoded_sha256 for r in kept.collect())


def test_counts_equal_the_library(docs):
    # Small bounds, so that most texts are cut, and some seams need wider overlaps.
    got = token_counts.count_tokens(docs, PATH, limit=5, huge=60, step=40, overlap=12)
    found = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect() if r.doc_id is not None)
    want = []
    for r in docs.collect():
        if r.doc_id is not None:
            n = reference(r.text)[0]
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 5))
    assert found == sorted(want)


def test_widening_without_any_white_space():
    text = "abc" * 500
    assert token_counts.chunked(PATH, text, 40, 12) is None
    assert token_counts.widened(PATH, text, 40, 12) == reference(text)[0]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, PATH).count() == 0
    assert token_counts.count_tokens(none, PATH).count() == 0
