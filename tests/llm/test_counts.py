"""Operators 11, 12 and 13 against plain versions, and against their SQL on the given tables."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect, differences
from tallyline.llm import divergence, line_dedup, queries, ranked_search
from tallyline.llm.terms import term_table, terms

SF = "/root/testdata/sf0.001"
rng = random.Random(5)
WORDS = [f"{a}{b}" for a in ["ka", "Lo", "mi", "été", "ßu", "7x"] for b in ["n", "R", "s2", "ü", "", "日本"]]
FOLD = {k: k + 32 for k in range(65, 91)}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, rank string, term string, value long, batch int, keys int"


def prose(n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", ",", "\t", "-\n", "\x00", "ÉÄ"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Long and short texts, copies, repeated rows, nulls in every column, and ties."""
    texts = [None, "", " ,.", "ka", "KA ka", "same words here", "same words here"] + [prose(rng.randint(1, 60)) for _ in range(80)] + [prose(20_000)]
    made = [(k, t, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None, "Ž", "z"])) for k, t in enumerate(texts)]
    return made + [made[9], made[9], (None, texts[9], "en", "s1"), (None, "ka lon", None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", "x", "x", 1, 1, 1) for r in rows], COLUMNS)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aZz09@[`{\x7f\x80é日😀 \n_-"), max_size=30))
def test_terms_equal_the_patterns(text):
    low = text.translate(FOLD)
    for with_digits, pattern in [(True, "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), (False, "[^\x00-\x40\x5B-\x60\x7B-\x7F]+")]:
        assert [t.decode() for t in terms(text.encode(), term_table(with_digits))] == re.findall(pattern, low)


# --- ranked search ---------------------------------------------------------------------------------


def plain_search(rows, items, k):
    find = lambda t: re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    count = [collections.Counter(find(r[1])) for r in rows]
    lengths = [c.total() for c in count]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    holding = collections.Counter(t for c in count for t in c)
    out = []
    for item_id, text in items:
        asked, found = collections.Counter(find(text)), []
        for (doc_id, *_), c, n in zip(rows, count, lengths):
            m = total and 100 - 75 + 75 * n * n_docs // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return collections.Counter(out)


ITEMS = [(1, "ka ka lon nowhere"), (2, None), (3, ""), (4, "same"), (4, "same"), (None, "Lo été 7x"), (7, "missing only"), (8, " ".join(WORDS))]


@pytest.mark.parametrize(("shard", "first", "block"), [(8192, 256, 2000), (7, 1, 3)])
def test_best_documents_equal_those_of_scoring_everything(spark, docs, rows, monkeypatch, shard, first, block):
    monkeypatch.setattr(ranked_search, "SHARD", shard)
    monkeypatch.setattr(ranked_search, "FIRST", first)
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    for k in (3, 10):
        got = collections.Counter(map(tuple, ranked_search.search(docs, items, k, block).collect()))
        assert got == plain_search(rows, ITEMS, k)
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    assert ranked_search.search(docs.where("text IS NULL"), items).count() == 0


def test_ids_may_be_texts(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in ranked_search.search(docs, items).orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_reading_in_order_of_impact_resolves_members_ties_and_scores(data):
    n_docs, n_terms = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 6))
    count = np.array(data.draw(st.lists(st.lists(st.integers(0, 3), min_size=n_terms, max_size=n_terms), min_size=n_docs, max_size=n_docs)))
    doc, term = np.nonzero(count)
    m = np.array(data.draw(st.lists(st.integers(25, 400), min_size=n_docs, max_size=n_docs)))
    weight = np.array(data.draw(st.lists(st.integers(0, 9), min_size=n_terms, max_size=n_terms)))
    lists = ranked_search.make_lists(doc, term, count[doc, term].astype(np.int64), m, n_terms)
    score = (np.where(count > 0, 10**9 * count // (1000 * count + 8 * m[:, None]), 0) * weight).sum(axis=1)
    may, found, _ = ranked_search.resolve(lists, np.arange(n_terms), weight, 3)
    third = sorted(score)[-3] if n_docs >= 3 else 0
    assert dict(zip(may.tolist(), found.tolist())) == {d: s for d, s in enumerate(score.tolist()) if s >= max(third, 1)}


def test_lists_are_left_once_nothing_below_can_matter():
    """One document is far ahead on both terms; the long tails of the lists stay unread."""
    n = 20_000
    doc, term = np.repeat(np.arange(n), 2), np.tile([0, 1], n)
    count = np.where(doc < 10, 50, 1)
    lists = ranked_search.make_lists(doc, term, count, np.full(n, 100), 2)
    may, score, read = ranked_search.resolve(lists, np.arange(2), np.array([5, 7]), 10)
    assert sorted(may) == list(range(10)) and len(set(score.tolist())) == 1 and read < 1500


# --- divergence ------------------------------------------------------------------------------------


def plain_audit(rows, least, top):
    found = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(FOLD))) for _, t, lang, source in rows]
    out = []
    for lang in {f[0] for f in found}:
        own = [f for f in found if f[0] == lang]
        holding = collections.Counter(t for f in own for t in set(f[2]))
        kept = sorted(t for t, n in holding.items() if n >= least)
        count = collections.defaultdict(collections.Counter)
        for _, source, ts in own:
            count[source].update(t for t in ts if holding[t] >= least)
        whole = sum(count.values(), collections.Counter())
        price = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (c.total() + 5 * len(kept)) for t in kept}
        p, q = {s: price(c) for s, c in count.items()}, price(whole)
        for s in p:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in p if o != s]
            marked = [(t, p[s][t] - q[t]) for t in kept if count[s][t] > 0 and p[s][t] > q[t]]
            for part, got, most in (("pair", pairs, len(pairs)), ("term", marked, top)):
                ranked = sorted(got, key=lambda f: (-f[1], f[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1)]
    return collections.Counter(out)


@pytest.mark.parametrize(("least", "top", "columns", "each"), [(3, 50, 1024, 32), (2, 3, 4, 2), (1, 4, 2, 1), (1000, 50, 1024, 32)])
def test_audit_equals_the_full_matrix(docs, rows, least, top, columns, each):
    got = collections.Counter(map(tuple, divergence.audit(docs, least, top, columns, each).collect()))
    assert got == plain_audit(rows, least, top)


def test_audit_of_nothing(docs):
    assert divergence.audit(docs.limit(0)).count() == 0
    assert {r.value for r in divergence.audit(docs.where("text IS NULL OR doc_id = 1")).collect()} <= {0}


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_joint_walk_equals_cell_by_cell(data):
    height, width = data.draw(st.integers(2, 9)), data.draw(st.integers(0, 20))
    zero = np.array(data.draw(st.lists(st.integers(0, 9), min_size=height, max_size=height)), np.int64)
    cells = data.draw(st.dictionaries(st.tuples(st.integers(0, height - 1), st.integers(0, max(width - 1, 0))), st.integers(0, 50), max_size=60 if width else 0))
    matrix = np.repeat(zero[:, None], width, axis=1)
    for (r, c), v in cells.items():
        matrix[r, c] = v
    rows, columns = (np.array([k[i] for k in cells], np.int64) for i in (0, 1))
    a, b = np.triu_indices(height, 1)
    got = divergence.joint_walk(rows, columns, np.array(list(cells.values()), np.int64), zero, width, a, b)
    assert got.tolist() == np.abs(matrix[a] - matrix[b]).sum(axis=1).tolist()


# --- line dedup ------------------------------------------------------------------------------------


def plain_lines(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    count = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return collections.Counter(out)


@pytest.fixture(scope="module")
def paged():
    lines = ["", " ", "Menu", " menu\t", "MENU", "Ärger", "ärger", "x ", "x", "\x1fx", "İ", "a\rb"]
    texts = [None, "", "\n", "\n\n", "menu", "Menu\nmenu"] + ["\n".join(rng.choice(lines + [prose(2, ["q", "r"])]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    made = list(enumerate(texts))
    return [*made, made[5], made[5], (None, "menu"), (None, None), *((100 + k, "copy of a page\nMENU\nend") for k in range(15))]


@pytest.mark.parametrize(("least", "batches"), [(10, 8), (3, 5), (1, 1), (500, 3)])
def test_lines_of_many_documents_go(spark, paged, least, batches):
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in paged], "doc_id long, text string, n_lines long, keys string, k1 int")
    found = line_dedup.without_common_lines(docs, least, batches)
    assert collections.Counter(map(tuple, found.drop("kept").collect())) == plain_lines(paged, least)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found.collect())
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_lines_of_empty_and_very_long_texts(spark):
    schema = "doc_id string, text string"
    assert line_dedup.without_common_lines(spark.createDataFrame([], schema)).count() == 0
    long = "\n".join(f"line {k}" if k % 3 else "common" for k in range(120_000))
    rows = [(str(k), long if k == 0 else f"common\nX {k}\n{'z' * 200_000 if k == 1 else ''}") for k in range(14)]
    got = collections.Counter(map(tuple, line_dedup.without_common_lines(spark.createDataFrame(rows, schema)).drop("kept").collect()))
    assert got == plain_lines(rows, 10)


def test_settled_keys_are_left_out_and_runs_are_merged_without_a_shuffle(spark):
    keys = lambda ks: spark.createDataFrame([(k, -k) for k in ks], "k1 long, k2 long")
    runs = line_dedup.LineRuns(spark, 3)
    for batch in ([1, 1, 1, 2, 5], [1, 2, 4], [1, 2, 4, 6], [6]):
        runs.add(keys(batch))
    assert [level for _, level in runs.runs] == [2]
    assert {(r.k1, r.docs) for r in spark.table(runs.runs[0][0]).collect()} == {(1, 3), (2, 3), (4, 2), (5, 1), (6, 2)}
    runs.add(keys([6, 2, 9]))
    assert {r.k1 for r in spark.table(runs.runs[-1][0]).collect()} == {6, 9}
    left, right = (spark.table(name) for name, _ in runs.runs)
    plan = left.hint("merge").join(right, line_dedup.KEY, "full")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert {r.k1 for r in runs.frequent().collect()} == {1, 2, 6}
    runs.drop()


def test_the_main_path_of_line_dedup_has_no_python(spark):
    found = queries.op13_line_dedup(spark, SF)
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().toString())


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_divergence", "op13_line_dedup"])
def test_same_result_as_sql(spark, name):
    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == []
