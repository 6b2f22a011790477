"""Operators 6 to 10 against plain versions, exact properties, and held-out rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import fingerprints, html_text, pii, quality, toxicity

rng = random.Random(3)
COMMON = ["the", "house", "garden", "walks", "over", "green", "light", "table", "slowly", "and", "river", "paper", "window", "said", "not"]
prose = lambda n: " ".join(rng.choice(COMMON) for _ in range(n))

# --- personal data ---------------------------------------------------------------------------------

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    found = []
    for order, (kind, p) in enumerate(PATTERNS.items()):
        for m in p.finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


FRAGMENTS = st.sampled_from(["a", "Z.", "@", "@@", "x@y", ".de", "b@c.d@e.f", "1.2.3.4", "256.1.1.1", "1.2.3", ".", "4111 1111 1111 1111", "4111-1111",
                             "1" * 14, "0000000000000000", "+1 (212) 555-0100", "+", "++49", " ", "-", "(", "9", "é", "😀", "%", "IBAN ", "\n", "5.6.7.8.9"])


@settings(max_examples=600, deadline=None)
@given(st.lists(FRAGMENTS, max_size=14).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.find(text) if s[0] in pii.KINDS] == plain_spans(text)


def test_added_spans_and_redaction():
    text = "Pay to IBAN DE89 3704 0044 0532 0130 00 or ftp://me:secret@host.example/x, not IBAN DE00 3704 0044 0532 0130 00."
    kinds = [k for k, _, _ in pii.find(text)]
    assert kinds.count("iban") == 1 and kinds.count("login") == 1
    assert "secret" not in pii.redacted(text) and "3704 0044 0532 0130 00." in pii.redacted(text)
    assert pii.redacted("mail a.b@c.de, 10.0.0.1!") == "mail [email], [ip]!"


def test_personal_data_rows(spark):
    rows = [(1, None), (2, ""), (3, "x@y.zz"), (3, "x@y.zz"), (None, "1.1.1.1")]
    df = spark.createDataFrame([(i, t, 5, 9) for i, t in rows], "doc_id long, text string, n_chars long, spans int")
    got = sorted((r.doc_id or 0, r.n_email, r.n_ip, r.spans) for r in pii.find_spans(df).collect())
    assert got == [(0, 0, 1, "ip:0:7"), (1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "email:0:6"), (3, 1, 0, "email:0:6")]
    assert pii.find_spans(df).where("doc_id = 3").first().base_sha256 == hashlib.sha256(b"email:0:6").hexdigest()
    new = pii.redact(df)
    assert new.schema == df.schema
    assert sorted(("?" if r.text is None else r.text, r.n_chars) for r in new.collect()) == [("", 0), ("?", 5), ("[email]", 7), ("[email]", 7), ("[ip]", 4)]
    assert pii.find_spans(df.limit(0)).count() == 0


# --- fingerprints ----------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=40), st.text("ab", max_size=40))
def test_spans_and_extensions(a, b):
    x, y = fingerprints.PrefixHash(a), fingerprints.PrefixHash(b)
    for i in range(0, len(a), 7):
        for j in range(0, len(b), 5):
            common = 0
            while i + common < len(a) and j + common < len(b) and a[i + common] == b[j + common]:
                common += 1
            assert x.extension(y, i, j) == common
    for n in (1, 3):
        spans = x.spans(n).tolist()
        assert len(set(spans)) == len({a[k:k + n] for k in range(len(a) - n + 1)}) and len(spans) == max(0, len(a) - n + 1)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fingerprints_against_a_plain_version(spark, parts):
    texts = [None, "", "x", "same", "same", "😀 naïve 😀"] + [prose(rng.randint(1, 200)) for _ in range(40)]
    rows = [(k * 3, t) for k, t in enumerate(texts)] + [(9, "other text of id nine"), (None, prose(20)), (None, "first")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    plain = [(i if some else None, t) for some, i, t in order]
    want = []
    for k, (i, t) in enumerate(plain):
        following = plain[(k + 1) % len(plain)][1]
        new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        mark, new_mark, next_mark = (fingerprints.fingerprint(fingerprints.PrefixHash(x)) for x in (t, new, following))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), mark, new_mark, fingerprints.likeness(mark, new_mark), fingerprints.likeness(mark, next_mark)))
    got = [tuple(r)[:7] for r in fingerprints.fingerprints(df, parts).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert fingerprints.fingerprints(df.limit(0), parts).count() == 0
    one = fingerprints.fingerprints(df.where("doc_id = 0"), parts).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_ids_of_fingerprints_may_be_texts_or_very_large(spark):
    big = 2**62
    for ids, kind in ([["b", "a", "é", None, "a", "ab", ""], "string"], [[big + 3, big + 1, big + 2, None, big + 1, big, -5], "long"]):
        rows = [(i, f"text {k} " + prose(9)) for k, i in enumerate(ids)]
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or (0 if kind == "long" else ""), r[1]))
        marks = [fingerprints.fingerprint(fingerprints.PrefixHash(t)) for _, t in order]
        want = {(i, marks[k], fingerprints.likeness(marks[k], marks[(k + 1) % len(order)])) for k, (i, _) in enumerate(order)}
        for parts in (1, 4):
            got = fingerprints.fingerprints(spark.createDataFrame(rows, f"doc_id {kind}, text string"), parts).collect()
            assert {(r.doc_id, r.fingerprint, r.near_next) for r in got} == want and len(got) == len(rows)


def test_likeness_follows_what_texts_share():
    words = [f"w{k * 7919 % 10007}" for k in range(4000)]
    a, b = " ".join(words[:1000]), " ".join(words[2000:3000])
    marks = [fingerprints.fingerprint(fingerprints.PrefixHash(x)) for x in (a, b, fingerprints.edited(a, b), a + " more")]
    assert fingerprints.likeness(marks[0], marks[0]) == 1 and fingerprints.likeness(marks[0], marks[1]) < 0.1
    assert 0.3 < fingerprints.likeness(marks[0], marks[2]) < 0.7 and 0.9 < fingerprints.likeness(marks[0], marks[3]) < 1


# --- pages -----------------------------------------------------------------------------------------


def test_main_text_of_broken_pages():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class=ad>
      <nav><ul><li>menu</ul></nav><div class="ad">buy</div><article><header><h1>A &amp; B&nbsp;&lt;c&gt;</h1></header>
      <p><b>First<br>line.<p>Second   &eacute;t&#233;\n more<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>
      <div class="comments"><p>reader</div><aside>side</aside><form>f</form><!-- <p>c</p> --></article><footer>foot</footer>"""
    assert html_text.parse(page) == "A & B <c>\nFirst line.\nSecond été more\nx\ny\n1\n2"
    assert html_text.parse("") == "" and html_text.parse("plain & simple") == "plain & simple"
    assert html_text.parse("<p>a<div>b</div>c") == "a\nb\nc"
    assert html_text.parse("<script>only") == "" and html_text.parse("<p>x<!-- open") == "x"


def test_what_a_site_repeats_goes(spark):
    body = "<html><body><div>Our great site</div>{}<div><span>Read us</span> daily</div></body></html>"
    pages = [(k, f"https://A.example/{k}", body.format(f"<p>text {k}</p><p>often said</p>")) for k in range(8)]
    pages += [(20 + k, "http://b.example/", body.format(f"<p>alone {k}</p>")) for k in range(2)]
    pages += [(30, None, "<p>no url</p>"), (31, "http://[bad", None), (32, "x", ""), (0, pages[0][1], pages[0][2])]
    df = spark.createDataFrame([(i, u, h, "h") for i, u, h in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[1] == "text 1" and got[20].split("\n") == ["Our great site", "alone 0", "Read us daily"]
    assert got[30] == "no url" and got[31] == "" and got[32] == "" and html_text.extract(df).count() == len(pages)
    inside = [(k, "http://c.example/", f"<article><p>same</p><p>{k}</p></article>") for k in range(9)]
    kept = html_text.extract(spark.createDataFrame(inside, "page_id long, url string, html string")).collect()
    assert all(r.text == f"same\n{r.page_id}" and r.n_chars == 6 for r in kept)
    assert html_text.extract(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    wrapped = "<body><div id=content><article><div class=entry><p>story</p><p>end</p></div></article></div></body>"
    plain = "<body><div id=content><p>story</p></div></body>"
    pages = [(k, f"http://a.example/?v={k}", wrapped) for k in range(6)] + [(k, "http://b.example/", plain) for k in range(6)]
    pages += [(10 + k, "http://a.example/x", f"<body><nav>{k}</nav>{wrapped}") for k in range(6)]
    got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == 18 and {r.text for r in got} == {"story\nend", "story"}
    # A listing that stands on pages of different main text keeps its article as well.
    teaser = "<body><div><article><p>news</p></article></div><main><p>page {}</p></main></body>"
    shared = [(k, "http://c.example/", teaser.format(k)) for k in range(8)]
    got = html_text.extract(spark.createDataFrame(shared, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"news\npage {k}" for k in range(8)}


def test_template_of_a_part_of_a_host_goes(spark):
    layout = "<body><div class=l{0}><p>hello from {0}</p></div><section><p>{1}</p><table><tr><td>kg<td>{1}</table></section><div>join {0}</div></body>"
    pages = [(k, "http://a.example/", layout.format(k % 3, f"text {k}")) for k in range(30)]
    pages += [(100 + k, "http://b.example/", f"<p>text {k}</p>" + "<div>far and wide</div>" * (k < 110) + "<ul><li>salt</ul>" * (k < 3)
               + f"<ul><li>pepper<li>{k}</ul>" * (k % 5 == 0)) for k in range(1200)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"text {k}\ntext {k}" for k in range(30))
    assert got[101] == "text 1\nsalt" and got[111] == "text 11" and got[105] == "text 5\npepper\n5" and got[300] == "text 200\npepper\n200"


def test_names_do_not_take_articles():
    story = "<p>story</p><div class=comments><article class=comment><p>reader</p></article></div>"
    for start in ("div class='content has-sidebar'", "div class='wrapper nav-open'", "div id=sidebar class=widget", "app-root class=modal"):
        assert html_text.parse(f"<body><{start}><article class='post category-social'>{story}</article></{start.split()[0]}>") == "story"
    assert html_text.parse(f"<main class='no-comments'>{story}</main>") == "story"
    for start in ("content has-sidebar", "wrapper nav-open", "post category-social", "no-comments", "container sidebar-left"):
        assert html_text.parse(f"<div class='{start}'><p>story</p></div>") == "story"
    for start in ("class=sidebar-inner", "class='box ad'", "id=sidebar-left", "class='x site-footer'", "class=ad_300", "class=ad2"):
        assert html_text.parse(f"<p>story</p><div {start}><p>aside</p></div>") == "story"
    assert html_text.parse("<article>a</article><div class=related><article>b</article></div>") == "a"
    hashes = []
    html_text.parse("<div class=sidebar><div>x</div><main><div>y</div></main></div>", hashes=hashes)
    assert len(hashes) == 2


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>" + "İ" * 20 + "</title></head><body><article><p>story</p></article></body>", "story"),
    ("<textarea>" + "İ" * 30 + "</TEXTAREA><p>story", "story"),
    ("<form action=x><div><header>h</header><div><p>story</p></div><footer>f</footer></div></form>", "story"),
    ("<form><nav>m</nav><div>story</div><div>end</div></form>", "story\nend"),
    ("<form><article><p>story</p></article></form>", "story"),
    ("<article><p>story</p></article><form><article>x</article></form>", "story"),
    ("<div><p>story</p></div><form><p>sign up</p><input></form>", "story"),
    ("<article><p>story</p><form><p>sign up</p></form></article>", "story"),
    ("<form><label>only a login</label><input></form>", ""),
    ("<article><p>story</p></article><article class='comment'><p>c</p></article>", "story"),
    ("<div><p>story</p></div><article class='comment'><p>c</p></article>", "story"),
    ("<article><p>story</p><article id=comment-12><p>c</p></article></article>", "story"),
    ("<article>story<ol class=commentlist><li>c</ol><div class='post-comments'>x</div><div class='user-reviews'>y</div></article>", "story"),
    ("<article class=comment><p>only</p></article>", "only"),
    ("<footer><article>only</article></footer>", "only"),
    ("<article class=review><p>story</p></article>", "story"),
    ("<div class='post-comments-closed'><p>story</p></div>", "story"),
    ("", ""), ("<form></form>", ""),
])
def test_articles_stay_and_comments_go(page, text):
    assert html_text.parse(page) == text


def test_raw_elements_take_time_in_proportion():
    page = "<p>story</p>" + "<noscript>x</noscript><title>İ</title>" * 20_000 + "<p>end</p>"
    assert html_text.parse(page) == "story\nend"


def _page(r):
    """A page made of parts that are known to be main text or not, and its main text."""
    kept, parts = [], []
    asides = ["<nav><ul><li>{}</ul></nav>", "<div class='sidebar'><p>{}</p></div>", "<form><p>{}</p><input></form>", "<aside>{}</aside>", "<script>{}</script>",
              "<section id=comments><article class=comment><p>{}</p></article></section>", "<div class='x ad'>{}</div>", "<!-- {} -->", "<ol class=commentlist><li>{}</ol>",
              "<div role=search>{}</div>", "<style>{}</style>", "<article class=comment>{}</article>"]
    for k in range(r.randint(1, 12)):
        words = " ".join(r.choice(COMMON) for _ in range(r.randint(1, 9)))
        if r.random() < 0.5:
            parts.append(r.choice(asides).format(f"not {words}"))
            continue
        shape = r.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div>{}</div>", "<div class='entry has-sidebar'><p>{}</p></div>", "<ul><li>{}</ul>", "<table><tr><td>{}</table>", "<blockquote>{}</blockquote>"])
        parts.append(shape.format(words.replace(" ", r.choice([" ", "\n\t", "&#32;", " <b></b>", "&nbsp;"]))))
        kept.append(words)
    body = "".join(parts)
    frame = r.choice(["<body>{}</body>", "<article>{}</article>", "<div id=page><main>{}</main></div>", "<body><header>not</header><div class='content nav-open'>{}</div><footer>not</footer>",
                      "<form id=all><nav>not</nav>{}</form>", "<div class=widget><article>{}</article></div>", "<title>İİİ not</title><body>{}"])
    return frame.format(body), kept, parts


def test_made_pages_give_what_they_were_made_of():
    r = random.Random(9)
    for _ in range(600):
        page, kept, parts = _page(r)
        if kept:
            assert html_text.parse(page) == "\n".join(kept), page


# --- classifiers -----------------------------------------------------------------------------------


def test_clauses_are_scored_not_words():
    s = toxicity.Scorer({"blarg*": 4.0})
    plain, negated, quoted, aimed = (s.clause(c.split()) for c in ("a blargish day", "never a blargish day", "they said blargish", "you blargish"))
    assert negated < plain < aimed and s.clause("said blargish".split()) < plain
    assert s.inputs("i will kill time")[0] == 0 and s.inputs("i will kill you")[0] > 0
    assert s.inputs("")[0] == 0 and quoted > 0


def test_composition_runs_both():
    both = toxicity.compose(toxicity.negation(), toxicity.targeted())
    state, weight = 0, 1.0
    for c in (toxicity.TARGET, toxicity.NEGATION, toxicity.INSULT):
        state, w = both[state, c]
        weight *= w
    assert weight == 0.5 * 1.5


def _plain(kinds, negated, told, aimed):
    """What each word's weight is multiplied by, from the words before it."""
    out = []
    for i, k in enumerate(kinds):
        clause = kinds[max((j + 1 for j in range(i) if kinds[j] == toxicity.BREAK), default=0):i]
        last = max((j for j, c in enumerate(clause) if c in (toxicity.THREAT, toxicity.TARGET, toxicity.ADDRESS)), default=None)
        if k in (toxicity.TARGET, toxicity.ADDRESS):
            f = float(last is not None and clause[last] == toxicity.THREAT)
        elif k == toxicity.HARMED:
            f = float(last is not None and clause[last] == toxicity.ADDRESS and toxicity.BE in clause[last:])
        else:
            f = float(k != toxicity.THREAT)
        if k == toxicity.INSULT and {toxicity.TARGET, toxicity.ADDRESS} & set(clause):
            f *= aimed
        if k in toxicity.PAID:
            f *= (told if toxicity.REPORT in kinds[:i] else 1) * (negated if toxicity.NEGATION in clause[-3:] else 1)
        out.append(f)
    return out


def test_the_composed_transducer_weighs_as_its_rules_say():
    for _ in range(3000):
        kinds, factors = [rng.choice(toxicity.CLASSES) for _ in range(rng.randint(0, 14))], rng.choice(toxicity.GRID)
        machine, state, got = toxicity.grammar(factors), 0, []
        for k in kinds:
            state, f = machine[state, k]
            got.append(f)
        assert np.allclose(got, _plain(kinds, *factors)), kinds


def test_speech_is_reported_over_marks_and_threats_have_forms():
    one = lambda t: toxicity.Scorer({}).inputs(t)[0]
    said = one("you are an idiot")
    for text in ('he said, "you are an idiot"', "he said: you are an idiot", '"you are an idiot", he said', "he said you are an idiot"):
        assert one(text) == pytest.approx(0.7 * said), text
    assert one("he said so. you are an idiot") == one("you know, you are an idiot") == said
    assert one("you, says one idiot") < said  # no clause but its own is aimed at
    for text in ("you will be killed", "you are going to be murdered", "du wirst getötet", "i am killing you", "we will kill them"):
        assert one(text) > 0, text
    for text in ("a man was killed", "killed time", "you kill time", "you know, they will be shot", "killing, you know"):
        assert one(text) == 0, text
    assert 0 < one("you will not be killed") < one("you will be killed")


def test_the_grammar_changes_predictions_for_the_better(spark):
    """Insults that are thrown and insults that are told of: the same words, told apart by the grammar alone."""
    docs, labels = [], []
    for k in range(500):
        kind = (0, 0, 1, 2, 2)[k % 5]
        middle = ("you are an idiot", 'she said, "you are an idiot"', prose(4))[kind]
        docs.append((k, f"{prose(15)}. {middle}. {prose(10)}"))
        labels.append((k, int(kind == 0)))
    df, marked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    right = []
    for grid in (toxicity.GRID, [(1.0, 1.0, 1.0)]):
        learned, factors, beta = toxicity.fitted(df, marked, grid=grid)
        p = toxicity.probabilities(toxicity.Scorer(learned, factors), beta, [t for _, t in docs])
        right.append(np.mean([(x >= 0.5) == bool(y) for x, (_, y) in zip(p, labels, strict=True)]))
    assert right[0] == 1.0 and right[1] <= 0.8


def test_labels_choose_the_factors():
    y = np.array([1.0, 0.0] * 100)
    inputs = np.stack([np.stack([np.where(y == 1, 3, 3 * told), np.where(y == 1, 3, 3 * told)], axis=1) for _, told, _ in toxicity.GRID], axis=1)
    assert toxicity.chosen(inputs, y)[0] == (0.5, 0.3, 1.5)
    assert toxicity.chosen(np.ones_like(inputs), y)[0] == toxicity.GRID[0]


def _corpus(spark, bad):
    docs, labels = [], []
    for k in range(600):
        y = k % 3 == 0
        docs.append((k, bad(k) if y else prose(40), 1))
        labels.append((k, int(y)))
    docs += [(600, None, 1), (601, "", 1), (None, prose(5), 1), (3, docs[3][1], 1)]
    labels += [(5, None), (None, 1), (9999, 1), (3, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score int"), labels


def test_toxicity_of_held_out_rows(spark):
    docs, labels = _corpus(spark, lambda k: f"{prose(25)} {['zorgling', 'zorglet', 'quatsh'][k % 3]}{'ae'[k % 2]} {prose(10)}")
    df = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, df).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert 60 < len(held) < 180 and all((r.predicted == 1) == (r.doc_id % 3 == 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.clean(docs, df).columns == docs.columns
    assert {r.doc_id for r in toxicity.clean(docs, df).collect() if r.doc_id is not None and r.doc_id < 600} == {k for k in range(600) if k % 3}
    assert toxicity.score(docs.limit(0), df).count() == 0 and toxicity.score(docs, df.limit(0)).count() == docs.count()


def test_quality_of_held_out_rows(spark):
    docs, labels = _corpus(spark, lambda k: "!! ".join(prose(20).upper().split()))
    df = spark.createDataFrame([(i, None if y is None else 1 - y) for i, y in labels], "doc_id long, quality int")
    got = quality.score(docs, df).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(got) == docs.count() and sum((r.predicted == 0) == (r.doc_id % 3 == 0) for r in held) > 0.97 * len(held)
    assert quality.score(docs.limit(0), df).count() == 0
    assert all(r.score == 0.5 for r in quality.score(docs, df.limit(0)).collect())


def test_buckets_of_words_do_not_depend_on_where_they_stand():
    one, two = quality.buckets("alpha beta"), quality.buckets("  alpha\n\nbeta ")
    words = lambda f: sorted(x for x in f.tolist() if x >> quality.BITS >= 2)
    assert words(one) == words(two) and len(words(one)) == 3
    assert len(quality.buckets("")) == 0 and np.all(quality.buckets("é" * 500) < quality.KINDS << quality.BITS)
