"""Operators 1, 2 and 3 against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import decontamination, jaccard_join, suffix_dedup
from tests.llm import brute

rng = random.Random(11)
VOCABULARY = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
prose = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, share):
    w = text.split()
    for p in rng.sample(range(len(w)), int(share * len(w))):
        w[p] = rng.choice(["", rng.choice(VOCABULARY), w[p] + " " + rng.choice(VOCABULARY)])
    return " ".join(x for x in w if x)


@pytest.fixture(scope="module")
def near(spark):
    """Groups of near copies of two to sixty, copies, short, empty, null and repeated rows, rows without an id."""
    texts = [None, "", "  ", "one", "One", "one two three four", "one two three four five six"]
    for size in (2, 3, 5, 60):
        base = prose(120)
        texts += [base, base.upper()] + [edited(base, 0.01 * rng.randint(0, 4)) for _ in range(size)]
    texts += [prose(90) for _ in range(30)]
    line = prose(40)
    texts += [f"{prose(20)} {line} {prose(20)}" for _ in range(20)]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, texts[-1]), (None, "nobody else says this at all today")]
    return rows, spark.createDataFrame([(i, t, "c", "s") for i, t in rows], "doc_id long, text string, c string, sig string")


def test_links_equal_those_of_all_pairs(near, monkeypatch):
    rows, df = near
    monkeypatch.setattr(jaccard_join, "SIGNATURE_BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", 8)
    got = jaccard_join.linked(df).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or 0, x[2])
    want = [(i, c, n) for (i, _), (c, n) in zip(rows, brute.similar_groups(rows), strict=True)]
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=key) == sorted(want, key=key)


def test_one_document_of_each_group_stays(near):
    rows, df = near
    classes = {c for c, _ in brute.similar_groups(rows) if c is not None}
    kept = jaccard_join.deduplicated(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(classes) and ids.count(None) == 1


def test_pruning_is_monotonous_and_keeps_what_reaches_the_threshold():
    least = jaccard_join.needed(0.8, 1e-6)
    assert list(least) == sorted(least) and least[-1] < 0.8 * jaccard_join.HASHES
    a = np.arange(jaccard_join.HASHES, dtype=np.uint16)[None, :]
    b = a.copy()
    b[0, :16] += 1000
    zero = np.zeros(1, int)
    assert len(jaccard_join.pruned(a, a, zero, zero, least)[0]) == 1
    assert len(jaccard_join.pruned(a, b, zero, zero, least)[0]) == 0


@pytest.fixture(scope="module")
def repeats(spark):
    """Passages around the length that counts, at text edges, periodic, overlapping, and in one text only."""
    passage = prose(200)
    texts = [None, "", "short", passage[:399], passage[:400], f"x{passage[:400]}y", f"{prose(60)} {passage[100:500]}", f"{passage[300:701]} {prose(70)}",
             "ab" * 500, "z" * 450, "z" * 399, f"{passage[:250]}#{passage[250:650]}", "é" * 300, "é" * 300]
    texts += [f"{prose(rng.randint(1, 60))} {passage[a:a + n]} {prose(rng.randint(1, 60))}"
              for a in (0, 57, 200, 333) for n in (380, 399, 400, 401, 430, 520, 700)]
    own = prose(90)[:450]
    texts += [f"{own} {prose(30)} {own}", prose(300)]
    rows = list(enumerate(texts)) + [(4, texts[4]), (None, prose(100)), (len(texts) - 1, texts[-1])]
    return rows, spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, at int, key string")


@pytest.mark.parametrize("options", [{}, {"share": 1.0, "times": 3}])
@pytest.mark.parametrize("split", [10_000, 3])
def test_removed_bytes_equal_those_of_all_positions(repeats, options, split, monkeypatch):
    rows, df = repeats
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    key = lambda x: (x[0] is None, x[0] or 0, x)
    assert sorted((tuple(r) for r in suffix_dedup.without_repeats(df, **options).collect()), key=key) == sorted(brute.without_repeats(rows), key=key)


def test_near_copies_in_groups_of_any_size(spark, monkeypatch):
    """Copies that differ in single bytes anywhere, so that of a part's windows all, some or none repeat."""
    monkeypatch.setattr(suffix_dedup, "SPLIT", 2)
    base, texts = prose(150)[:700], []
    for k in range(40):
        made = list(base)
        for p in rng.sample(range(700), k % 3):
            made[p] = "#"
        texts.append("".join(made)[rng.randint(0, 40):700 - rng.randint(0, 40)])
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in suffix_dedup.without_repeats(df).collect()) == sorted(brute.without_repeats(rows))


@pytest.mark.parametrize("unit", ["to ", "the ", "from "])
def test_a_suffix_is_not_held_against_itself(spark, unit, monkeypatch):
    """Periodic stretches look alike from several distances to one anchor; what stands before and after them is found once only."""
    monkeypatch.setattr(suffix_dedup, "SPLIT", 200)
    texts = [f"{prose(40)}{(unit * 160)[:n]}{prose(40)}" for n in (450, *[320] * 40)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in suffix_dedup.without_repeats(df).collect()) == sorted(brute.without_repeats(rows))


def test_interleaving_gives_suffix_order_and_common_prefixes():
    rows = [bytes(rng.choice(b"ab") for _ in range(16)) for _ in range(300)]
    shards = sorted(rows[:100]) + sorted(rows[100:220]) + sorted(rows[220:])
    symbols = np.frombuffer(b"".join(shards), np.uint8).reshape(-1, 16)
    order, common = suffix_dedup.interleave(symbols, np.zeros(300, int))
    merged = [shards[k] for k in order]
    assert merged == sorted(rows)
    for a, b, n in zip(merged[:-1], merged[1:], common[1:], strict=True):
        assert a[:n] == b[:n] and (n == 16 or a[n] != b[n])


def test_contamination_within_the_distance_is_found_and_nothing_else(spark):
    items = [(k, prose(rng.randint(15, 60))) for k in range(40)] + [(40, None), (41, ""), (42, "too short"), (43, prose(30).upper()), (None, prose(25))]
    texts = [None, "", "a", prose(2000)]
    for k, t in items:
        if t and len(t.split()) > 5:
            texts += [f"{prose(40)} {t} {prose(30)}", t, f"{prose(5)} {edited(t, 0.1)}", f"{edited(t, 0.15)} {prose(300)}", edited(t, 0.6)]
    docs = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)] + [(None, texts[4], 8), (4, texts[4], 9)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in [(r.doc_id, r.text) for r in docs.collect()]:
        for k, t in items:
            w = brute.words(t)
            if len(w) >= decontamination.LEAST_WORDS and (n := brute.edit_distance(w, brute.words(text))) <= int(0.2 * len(w)):
                want.add((d, k, n))
    got = {(r.doc_id, r.item_id, r.distance) for r in decontamination.find(docs, bench, block=17).collect()}
    assert {g[:2] for g in got} <= {w[:2] for w in want}
    assert len({g[:2] for g in got}) >= 0.98 * len({w[:2] for w in want})
    clean = decontamination.clean(docs, bench, block=17)
    assert clean.columns == docs.columns
    dirty = {r[0] for r in got}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - dirty


def test_edits_of_the_rarest_words_hide_no_item():
    """A fifth of the words changed, those first that the fewest items have and that are longest."""
    items = [(k, prose(n)) for k, n in enumerate(rng.choices(range(6, 90), k=60))]
    spread = [x for _, t in items for x in set(t.split())]
    index, texts = decontamination.Index(items), []
    for _, t in items:
        w = t.split()
        starts = sorted(range(len(w)), key=lambda o, w=w: (spread.count(w[o]), -len(w[o]), o))
        for n, o in enumerate(starts[:len(w) // 5]):
            w[o] = f"changed{n}"
        texts += [f"{prose(30)} {' '.join(w)} {prose(30)}", " ".join(w)]
    for n, found in enumerate(index.matches(texts)):
        k, want = n // 2, brute.edit_distance(brute.words(items[n // 2][1]), brute.words(texts[n]))
        assert found[k][0] == want <= int(0.2 * len(items[k][1].split()))


@pytest.mark.parametrize("share", [0.05, 0.1, 0.2])
def test_walks_alone_reach_their_recall(share):
    """Without the lookup of unchanged runs: words exchanged at random, and the rarest and longest first."""
    items = [(k, prose(n)) for k, n in enumerate(rng.choices(range(10, 90), k=150))]
    spread = Counter(x for _, t in items for x in set(t.split()))
    index = decontamination.Index(items, exact=False)
    assert not index.runs
    for rarest in (False, True):
        texts = []
        for _, t in items:
            w = t.split()
            order = sorted(range(len(w)), key=lambda o, w=w: (spread[w[o]], -len(w[o]), o)) if rarest else rng.sample(range(len(w)), len(w))
            for n, o in enumerate(order[:int(share * len(w))]):
                w[o] = f"changed{n}"
            texts.append(f"{prose(30)} {' '.join(w)} {prose(30)}")
        found = index.matches(texts)
        assert sum(k in f for k, f in enumerate(found)) >= decontamination.RECALL * len(items)


def test_longer_windows_get_more_walks():
    assert decontamination.walks_for(4, share=0.0) == 1 and decontamination.walks_for(16) < decontamination.walks_for(64)


def test_short_items_and_items_without_spaces_are_searched():
    chinese, thai = "一个农夫有十七只羊，除了九只以外都死了，还剩几只？", "ชาวนามีแกะสิบเจ็ดตัวตายไปเหลือเก้าตัว"
    items = [(0, "Two words"), (1, "one"), (2, chinese), (3, thai), (4, "five words stand right here"), (5, " "), (6, "羊")]
    texts = ["those two WORDS here", "two other words", f"前言。{chinese}后记", f"前言{chinese.replace('农夫', '牧民')}", chinese[:9], f"x{thai}x",
             "five words stand right there", "so five words stand right here", "", "no one"]
    index = decontamination.Index(items)
    found = [{index.items[k][0]: d for k, (d, _) in m.items()} for m in index.matches(texts)]
    assert found == [{0: 0}, {}, {2: 0, 6: 0}, {2: 2, 6: 0}, {6: 0}, {3: 0}, {}, {4: 0}, {}, {1: 0}]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert jaccard_join.linked(docs).count() == 0 and jaccard_join.deduplicated(docs).count() == 0
    assert suffix_dedup.without_repeats(docs).count() == 0
    assert decontamination.find(docs, bench).count() == 0 and decontamination.clean(some, bench).count() == 1


def test_copies_go_whatever_columns_are_called(spark):
    text = prose(60)
    rows = [(1, text, "x", 7), (2, text, "y", 8), (3, prose(60), "z", 9), (3, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key string, _row_key long")
    got = jaccard_join.deduplicated(df)
    assert got.schema == df.schema
    assert sorted((r.doc_id, r.row_key or "") for r in got.collect()) == [(1, "x"), (3, ""), (3, "z")]
