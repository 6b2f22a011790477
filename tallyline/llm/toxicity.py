"""Operator 6, toxicity by a weighted finite-state pattern grammar.

Words map to classes (insult, threat, harm done, target, negation, reported speech, ...); insults carry a
weight. Each pattern is a small transducer over classes: an insult is stronger near a target, a threat
counts only with one (before it, or in the passive with "you ... be" before it), either is weaker in the
scope of a negation or of reported speech. Commas, colons and quotation marks end a clause, which all forget
but reported speech: that goes on to the end of the sentence, and begins with the sentence where the verb
of saying follows a mark ("..., he said"). The transducers are composed into one, which runs over every
sentence that holds an insult or a threat; a document is scored from its matched clauses, never from a
word by itself.

What is learned, from labelled rows outside the held-out fold: the weights of insults (words and
stems whose document frequency among toxic rows is significantly higher), how much negation, reported
speech and targets change them (the likeliest of ``GRID``, held to the first by ``PULL``), and the
three coefficients that turn clause scores into a probability. All are fitted on at
most ``SAMPLE`` labelled rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import held_out, per_partition, per_slice, texts

SAMPLE = 20_000
#: Entries of the learned lexicon, strongest evidence first.
ENTRIES = 20_000
STEMS = (4, 5, 6, 7)
#: Evidence (log-likelihood ratio) and precision an entry needs.
EVIDENCE, PRECISION = 20.0, 0.9
FOLDS, FOLD = 5, 0

CLASSES = INSULT, THREAT, HARMED, TARGET, ADDRESS, NEGATION, REPORT, BE, BREAK, OTHER = range(10)
#: Classes on which weight is paid out.
PAID = INSULT, HARMED, TARGET, ADDRESS
#: What negation, reported speech and a target make of a weight: tried values, the first where labels do not tell.
GRID = list(itertools.product((0.5, 0.2, 1.0), (0.7, 0.3, 1.0), (1.5, 1.0, 2.25)))
#: How many units of log-likelihood a factor e times another must gain.
PULL = 2.0

#: Grammar words of four languages; insults in it only matter where labels say nothing about them.
GRAMMAR = {
    TARGET: "he she they him her them sie",
    ADDRESS: "you your yours you're you'll u ur du dich dir ihr euch tu te toi vous ton ta tes usted tú ti vosotros ustedes",
    NEGATION: "not no never neither nor isn't aren't don't doesn't won't nicht kein keine keinen nie niemals pas jamais aucun nunca jamás ningún tampoco",
    REPORT: "said says say saying called calls claimed claims reported quote quoted wrote sagte sagt sagten nannte nennt schrieb dit disait disent "
            "appelé appelle écrit dijo dice decía llamó escribió",
    THREAT: "kill kills killing murder murders murdering hurt hurts hurting destroy destroys destroying beat beats beating strangle strangling "
            "stab stabs stabbing shoot shoots shooting töten töte tötet umbringen schlagen schlage vernichten vernichte tuer tuerai frapper frapperai "
            "détruire matar mataré golpear golpearé destruir destruiré",
    HARMED: "killed murdered destroyed beaten strangled stabbed shot getötet umgebracht erschlagen vernichtet tué tuée frappé détruit "
            "asesinado asesinada golpeado destruido",
    BE: "be get wirst werdet seras serez serás",
    INSULT: "idiot idiots moron morons stupid scum scumbag worthless loser losers pathetic disgusting trash imbecile dumbass bastard "
            "dummkopf abschaum arschloch imbécile connard salaud ordure estúpido imbécil basura",
}
PRIOR = 3.0

_WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_TOKENS = re.compile(_WORDS.pattern + "|[,:\"“”„«»]")
_MARKS = set(",:\"“”„«»")
_SENTENCE = re.compile(r"[.!?;\n\r|]+")
#: Words after a mark among which a verb of saying is looked for.
AHEAD = 3

Transducer = dict[tuple, tuple]


def negation(scope: int = 3, factor: float = 0.5) -> Transducer:
    """Within ``scope`` words after a negation, in its clause, insults and threats (paid out on their target) weigh less."""
    return {(s, c): (scope if c == NEGATION else 0 if c == BREAK else max(s - 1, 0), factor if s and c in PAID else 1.0)
            for s in range(scope + 1) for c in CLASSES}


def reported(factor: float = 0.7) -> Transducer:
    """After a verb of saying, to the end of the sentence."""
    return {(s, c): (1 if c == REPORT else s, factor if s and c in PAID else 1.0) for s in (0, 1) for c in CLASSES}


def targeted(factor: float = 1.5) -> Transducer:
    """After somebody was addressed or named, in its clause, insults weigh more."""
    return {(s, c): (1 if c in (TARGET, ADDRESS) else 0 if c == BREAK else s, factor if s and c == INSULT else 1.0) for s in (0, 1) for c in CLASSES}


def threatened() -> Transducer:
    """A threat weighs nothing until it meets a target, on which it is paid out; harm done pays after "you" and "be".

    States: nothing, a threat open, "you" seen, "you ... be" seen. Clauses start anew.
    """
    nothing, threat, you, you_be = range(4)
    made = {(s, c): (s, 0.0 if c in (THREAT, *PAID) and c != INSULT else 1.0) for s in range(4) for c in CLASSES}
    for s in range(4):
        made[s, THREAT] = (threat, 0.0)
        made[s, TARGET] = (nothing, float(s == threat))
        made[s, ADDRESS] = (you, float(s == threat))
        made[s, BREAK] = (nothing, 1.0)
    made[you, BE] = (you_be, 1.0)
    made[you_be, HARMED] = (you_be, 1.0)
    return made


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Run both side by side: states pair up, weights multiply. States are renamed to 0, 1, ... with the start at 0."""
    names, made, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for c in CLASSES:
            (a2, w), (b2, v) = first[a, c], second[b, c]
            if (a2, b2) not in names:
                names[a2, b2] = len(names)
                todo.append((a2, b2))
            made[names[a, b], c] = (names[a2, b2], w * v)
    return made


@cache
def grammar(factors: tuple[float, float, float] = GRID[0]) -> Transducer:
    negated, told, aimed = factors
    return compose(compose(compose(threatened(), targeted(aimed)), reported(told)), negation(factor=negated))


def clause_scores(symbols: list[tuple[int, float]], machine: Transducer) -> list[float]:
    """The scores of a sentence's clauses that have any."""
    told = any(k == BREAK and any(c == REPORT for c, _ in symbols[at + 1:at + 1 + AHEAD]) for at, (k, _) in enumerate(symbols))
    state, score, scores = machine[0, REPORT][0] if told else 0, 0.0, []
    for kind, weight in symbols:
        state, factor = machine[state, kind]
        score += factor * weight
        if kind == BREAK:
            scores.append(score)
            score = 0.0
    return [x for x in (*scores, score) if x > 0]


def features(text: str) -> set[str]:
    """Distinct words of a text, and the stems (``abcd*``) of the longer ones."""
    words = set(_WORDS.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


class Lexicon:
    """Class and weight of words: grammar words, learned insults, learned stems; most specific first."""

    def __init__(self, learned: dict[str, float]):
        self.learned = learned
        self.known: dict[str, tuple[int, float]] = {}
        for kind, words in GRAMMAR.items():
            for w in words.split():
                self.known[w] = (kind, PRIOR if kind in (INSULT, THREAT, *PAID) else 0.0)

    def __getitem__(self, word: str) -> tuple[int, float]:
        if word in _MARKS:
            return BREAK, 0.0
        if word in self.learned:
            w = self.learned[word]
            return (INSULT, w) if w > 0 else (OTHER, 0.0)
        if word in self.known:
            return self.known[word]
        best = max((self.learned.get(f"{word[:k]}*", 0.0) for k in STEMS if len(word) > k), default=0.0)
        return (INSULT, best) if best > 0 else (OTHER, 0.0)


class Scorer:
    """Clause scores of texts, with a table of the words met so far."""

    def __init__(self, learned: dict[str, float], factors: tuple[float, float, float] = GRID[0], held: int = 300_000):
        self.lexicon, self.machine, self.held = Lexicon(learned), grammar(factors), held
        self.seen: dict[str, tuple[int, float]] = {}

    def _classes(self, words: list[str]) -> list[tuple[int, float]]:
        if len(self.seen) > self.held:
            self.seen.clear()
        for w in set(words).difference(self.seen):
            self.seen[w] = self.lexicon[w]
        return [self.seen[w] for w in words]

    def clause(self, words: list[str]) -> float:
        """The score of words as one clause."""
        return sum(clause_scores(self._classes(words), self.machine))

    def sentences(self, text: str) -> list[list[tuple[int, float]]]:
        """Classes and weights of the sentences of a text that hold an insult or a threat."""
        low = text.lower()
        words = set(_WORDS.findall(low))
        hot = [w for w, (kind, _) in zip(words, self._classes(list(words)), strict=True) if kind in (INSULT, THREAT, HARMED)]
        return [self._classes(_TOKENS.findall(c)) for c in _SENTENCE.split(low) if any(w in c for w in hot)] if hot else []

    def inputs(self, text: str, machine: Transducer | None = None) -> tuple[float, float]:
        """The strongest clause, and the sum of all, of a text."""
        return _strongest(self.sentences(text), machine or self.machine)


def _strongest(sentences: list[list[tuple[int, float]]], machine: Transducer) -> tuple[float, float]:
    scores = [x for symbols in sentences for x in clause_scores(symbols, machine)]
    return max(scores, default=0.0), sum(scores)


def design(strongest: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(strongest), strongest, np.log1p(total)], axis=1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; the slopes are kept from falling below zero."""
    beta, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - penalty @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        beta = beta + np.linalg.solve(curve, slope)
    return np.concatenate([beta[:1], np.maximum(beta[1:], 0)])


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, sample: int) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows outside the held-out fold, by hash of the id.

    The sampled labels, whose number is bounded, go to all tasks; documents are not shuffled.
    An id that was labelled or stored more than once gives all its pairs.
    """
    chosen = (labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
              .select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "label")


def learn(train: DataFrame) -> dict[str, float]:
    """Weights of insult words and stems from labelled texts: document frequencies counted in Spark."""
    def count(slices: Iterator[dict]) -> Iterator[dict]:
        held: Counter[tuple[str, int]] = Counter()

        def flush() -> dict:
            items = list(held.items())
            held.clear()
            return {"feature": [f for (f, _), _ in items], "label": [y for (_, y), _ in items], "n": [n for _, n in items]}

        for rows in slices:
            for text, y in zip(rows["text"], rows["label"], strict=True):
                held.update((f, y) for f in features(text))
                held["", y] += 1
            if len(held) > 300_000:
                yield flush()
        yield flush()

    counts = (per_partition(train, "feature string, label int, n long", count).groupBy("feature")
              .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
                   F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("b")))
    # The grammar's own insults are looked at whatever their counts, so that labels can overrule them.
    own = [w for k in (INSULT, THREAT, HARMED) for w in GRAMMAR[k].split()]
    rows = (counts.where((F.col("a") >= 4) & (F.col("a") >= PRECISION * (F.col("a") + F.col("b"))) | (F.col("feature") == "")
                         | F.col("feature").isin(own))
            .orderBy((F.col("feature") != ""), F.desc("a"), "b", "feature").limit(ENTRIES).collect())
    if not rows or rows[0].feature != "" or not rows[0].a or not rows[0].b:
        return {}
    pos, neg = rows[0].a, rows[0].b
    learned = {}
    for r in rows[1:]:
        weight = math.log((r.a + 0.5) / (pos + 1)) - math.log((r.b + 0.5) / (neg + 1))
        base = pos / (pos + neg)
        n = r.a + r.b
        evidence = 2 * sum(k * math.log(k / (n * q)) for k, q in ((r.a, base), (r.b, 1 - base)) if k)
        if r.a >= PRECISION * n and evidence >= EVIDENCE:
            learned[r.feature] = weight
        elif r.feature in own and n >= 5 and r.a < 0.5 * n:
            learned[r.feature] = 0.0
    return learned


def likelihood(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> float:
    z = np.clip(x @ beta, -30, 30)
    return float((y * z - np.logaddexp(0, z)).sum())


def chosen(inputs: np.ndarray, y: np.ndarray, grid: list[tuple[float, float, float]] = GRID) -> tuple[tuple[float, float, float], np.ndarray]:
    """The factors of ``grid`` under which the labels are likeliest, and the coefficients that go with them.

    ``inputs``: rows by grid by (strongest, sum). Each factor is held to that of the first by ``PULL``.
    """
    best = None
    for k, factors in enumerate(grid):
        x = design(inputs[:, k, 0], inputs[:, k, 1])
        beta = fit(x, y)
        value = likelihood(x, y, beta) - PULL * sum(abs(math.log(f / g)) for f, g in zip(factors, grid[0], strict=True))
        if best is None or value > best[0]:
            best = value, factors, beta
    return best[1], best[2]


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
           grid: list[tuple[float, float, float]] = GRID) -> tuple[dict[str, float], tuple[float, float, float], np.ndarray]:
    """Weights of words and stems, factors of the grammar, and coefficients of the clause scores, from labelled rows of ``docs``.

    Without usable labels the grammar's own weights are used as they are.
    """
    train = labelled(docs, labels, "toxic", FOLDS, FOLD, sample)
    learned = learn(train)

    def inputs(rows: dict) -> dict:
        scorer = Scorer(learned)
        found = [scorer.sentences(t) for t in rows["text"]]
        return {"label": rows["label"], "x": [[v for f in grid for v in _strongest(s, grammar(f))] for s in found]}

    seen = per_slice(train, "label int, x array<double>", inputs).toPandas()
    if seen["label"].nunique() < 2:
        return learned, grid[0], np.array([-3.0, 1.0, 0.0])
    return learned, *chosen(np.stack(seen["x"]).reshape(len(seen), len(grid), 2), seen["label"].to_numpy(float), grid)


def probabilities(scorer: Scorer, beta: np.ndarray, texts: list[str]) -> np.ndarray:
    found = np.array([scorer.inputs(t) for t in texts]).reshape(-1, 2)
    return 1 / (1 + np.exp(-np.clip(design(found[:, 0], found[:, 1]) @ beta, -30, 30)))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5).

    One row for each row of ``docs``, repeated ids included; null and empty texts get the score of
    a text without any match. Columns other than doc_id and text are ignored.
    """
    learned, factors, beta = fitted(docs, labels, sample)

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(learned, factors)
        for rows in slices:
            p = probabilities(scorer, beta, rows["text"])
            yield {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": p.tolist(), "predicted": (p >= 0.5).astype(int).tolist()}

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "text")
    return per_partition(rows, f"doc_id {key}, held_out boolean, score double, predicted int", run)


def clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, with all columns, whose score is below a half; null texts stay."""
    learned, factors, beta = fitted(docs, labels, sample)

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(learned, factors)
        for rows in slices:
            stays = probabilities(scorer, beta, [t or "" for t in rows["text"]]) < 0.5
            yield {k: [x for x, s in zip(v, stays, strict=True) if s] for k, v in rows.items()}

    return per_partition(docs, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), run)
