"""The corpus pipeline against its stages done the plain way."""

import random

import pytest
from public_tokenizers import path as tokenizer_path

import corpus_pipeline
from tallyline.llm import decontamination, pii, toxicity
from tallyline.llm.common import tokenizer
from tests.llm import brute

rng = random.Random(29)
WORDS = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(300)]
prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    items = [(k, prose(rng.randint(20, 40))) for k in range(6)]
    texts = [prose(rng.randint(20, 150)) for _ in range(140)]
    for k in range(0, 140, 4):
        texts[k] += f" snortling you {prose(6)} snortling"
    near = prose(200).split()
    texts += [" ".join(near), " ".join(near[:100] + ["changed"] + near[101:]), " ".join(near)]
    texts += [f"{prose(30)} {t} {prose(30)}" for _, t in items] + [f"write to {prose(1)}@{prose(1)}.example at 10.1.2.3 {prose(20)}", "", None, "ok"]
    docs = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(k, 1, int("snortling" in (t or ""))) for k, t in enumerate(texts[:140])]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs, items


def test_stages_in_order(spark, folder):
    path, docs, items = folder
    frames, df = {}, spark.read.parquet(f"{path}/documents.parquet")
    columns = df.columns
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, path)
        frames[name] = {r["doc_id"]: r for r in df.collect()}
        if name != "encoding":
            assert df.columns == columns
    left = {d[0]: d[1] for d in docs if "snortling" not in (d[1] or "")}
    assert set(frames["toxicity"]) == set(left)
    rows = sorted(left.items())
    left = {d: left[d] for d in {c for c, _ in brute.similar_groups(rows)}}
    assert set(frames["near_duplicates"]) == set(left)
    dirty = {d for d, t in left.items() for _, i in items if brute.edit_distance(brute.words(i), brute.words(t)) <= int(0.2 * len(brute.words(i)))}
    left = {d: t for d, t in left.items() if d not in dirty}
    assert len(dirty) == len(items) and set(frames["decontamination"]) == set(left)
    left = {d: None if t is None else pii.redacted(t) for d, t in left.items()}
    assert {d: r["text"] for d, r in frames["personal_data"].items()} == left and "[email] at [ip]" in " ".join(t or "" for t in left.values())
    t = tokenizer(tokenizer_path("word_bpe_49k.json"))
    want = {d: t.encode(x or "", add_special_tokens=False).ids for d, x in left.items()}
    assert {d: r["ids"] for d, r in frames["encoding"].items()} == want


def test_run_gives_the_last_stage(spark, folder):
    path, docs, _ = folder
    result = corpus_pipeline.run(spark, path)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and 0 < result.count() < len(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] and decontamination.DISTANCE == 0.2 and toxicity.FOLDS == 5
