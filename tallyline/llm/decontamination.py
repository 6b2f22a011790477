"""Operator 1, benchmark decontamination through CGK embeddings.

A text is a sequence of words. The CGK embedding walks along it: at every step it puts out the
word it stands on, and a random bit for (step, word) says whether it moves on. Two sequences of
small edit distance meet again after an edit, so their outputs have a small Hamming distance. Each
walk is one LSH table, whose key is a sample of ``BITS`` outputs.

Windows begin at words that items are known by: of each item those that the fewest items have, one
more than it may have edits, so that edits cannot hit all of them. They are as long as what the item has
from there, rounded down to a size of ``SIZES``. How many walks a size gets follows from ``RECALL``: as many as
let that share of windows with ``DISTANCE`` of their words edited, tried on random ones, share a key with what
they were. An item has several windows, so that the whole finds more. Windows of texts and of items
that share a key in any table are verified exactly: the item's least edit distance, in words, to any
stretch of the text around must be at most ``DISTANCE`` of its length.

What the walks miss is made up for, unless ``exact`` is off: each item is also cut into one run of words
more than it may have edits, of which one at least stands unchanged wherever the item is. Every position
of every text is looked up among these runs, and what is found is verified the same way. With them nothing
within the distance is missed.

Words stand between white space; in scripts that write none between words, each character is a word.
Items of fewer than ``LEAST_WORDS`` words are searched as they are, without edits.

Items are searched in blocks of at most ``BLOCK``, which bounds what is sent to the workers; every
block sees every text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import per_slice, texts
from tallyline.llm.jaccard_join import _mixed, word_hashes

DISTANCE = 0.2
#: Items of fewer words must stand unchanged.
LEAST_WORDS = 6
#: Share of edited windows that the walks find, outputs in a key, and edited windows tried to know how many walks that takes.
RECALL, BITS, TRIED = 0.95, 3, 200
SIZES = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512)
BLOCK = 20_000

_END = np.uint64(0x5851F42D4C957F2D)


#: Thai, Lao, Burmese, Khmer, Chinese and Japanese, with their signs.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff])")


@cache
def _seeds(walks: int) -> np.ndarray:
    return _mixed(np.arange(1, walks + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def spaced(text: str) -> str:
    """A text with white space around each character of a script that has none between words."""
    return text if text.isascii() else _UNSPACED.sub(r" \1 ", text)


@cache
def _samples(size: int, walks: int) -> np.ndarray:
    """For each walk the steps whose outputs make its key; never the first, where windows stand on the same word anyway."""
    last = max(3, 3 * size // 2)
    rng = np.random.default_rng(size)
    return np.stack([np.sort(rng.choice(np.arange(2, last), min(BITS, last - 2), replace=False)) for _ in range(walks)])


def keys(words: np.ndarray, starts: np.ndarray, limits: np.ndarray, size: int, walks: int) -> np.ndarray:
    """A key for each window ``words[start:start + size]`` and walk, as a matrix.

    All windows walk side by side, on an end mark once beyond ``limits``, where their text ends.
    """
    sample, seeds = _samples(size, walks), _seeds(walks)
    limits = np.minimum(limits, size)[:, None]
    at = np.zeros((len(starts), walks), np.int64)
    out = np.repeat(seeds[None, :] ^ np.uint64(size), len(starts), axis=0)
    for step in range(int(sample.max()) + 1):
        word = np.where(at < limits, words[np.minimum(starts[:, None] + at, len(words) - 1)], _END)
        taken = (sample == step).any(axis=1)
        if taken.any():
            out[:, taken] = _mixed(out[:, taken] * np.uint64(0x100000001B3) + word[:, taken])
        at += (_mixed(word ^ (seeds + _mixed(np.array([step + 1], np.uint64)))[None, :]) >> np.uint64(63)).astype(np.int64)
    return out


@cache
def walks_for(size: int, share: float = DISTANCE, recall: float = RECALL) -> int:
    """The least number of walks of which one at least gives ``recall`` of edited windows the key they had.

    Windows of random words are tried, ``share`` of their words, rounded up, exchanged, dropped or added to, never the first.
    """
    rng = np.random.default_rng(size)
    edited, edits = [], min(math.ceil(share * size), size - 1)
    whole = rng.integers(1 << 62, size=(TRIED, size)).astype(np.uint64)
    for words in whole:
        made = words.tolist()
        for at in np.sort(rng.choice(np.arange(1, size), edits, replace=False))[::-1]:
            kind = rng.integers(4)
            made[at:at + (kind != 3)] = [] if kind == 2 else [int(rng.integers(1 << 62))]
        edited.append(np.array(made, np.uint64))
    length = np.array([len(w) for w in edited])
    walks = 8
    while True:
        same = (keys(whole.ravel(), np.arange(TRIED) * size, np.full(TRIED, size), size, walks)
                == keys(np.concatenate(edited), np.cumsum(length) - length, length, size, walks))
        found = np.maximum.accumulate(same, axis=1).mean(axis=0)
        if found[-1] >= recall or walks >= 1024:
            return int(np.argmax(found >= recall)) + 1 if found[-1] >= recall else walks
        walks *= 2


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of an item to any stretch of a text, and where in the text the best stretch ends."""
    columns = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        step = np.empty_like(row)
        step[0] = k + 1
        step[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(step - columns) + columns
    end = int(row.argmin())
    return int(row[end]), end


def runs(n: int, allowed: int) -> list[tuple[int, int]]:
    """(offset, length) of ``allowed + 1`` runs that make up an item of ``n`` words; as many edits leave one of them whole."""
    cuts = [n * k // (allowed + 1) for k in range(allowed + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of so many words."""
    h = np.zeros(max(0, len(words) - length + 1), np.uint64)
    for k in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(h)]
    return _mixed(h)


class Index:
    """The windows of a block of items, by key."""

    def __init__(self, items: list[tuple[object, str]], share: float = DISTANCE, exact: bool = True):
        self.share = share
        kept = [(i, t, w) for i, t in ((i, spaced(t)) for i, t in items) if len(w := word_hashes(t))]
        self.items = [(i, w) for i, _, w in kept]
        spread = Counter(x for _, w in self.items for x in np.unique(w).tolist())
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        anchors: dict[int, set[int]] = defaultdict(set)
        for k, (_, text, words) in enumerate(kept):
            if len(words) < LEAST_WORDS:
                continue
            # Starting words with most of the item after them; a repeated word counts once. Long words are rare in texts, too.
            room = max(len(words) // 2, len(words) - SIZES[-1])
            length = [len(x) for x in text.lower().split()]
            first = {int(w): o for o, w in reversed(list(enumerate(words[: room + 1].tolist())))}
            for word, o in sorted(first.items(), key=lambda x: (spread[x[0]], -length[x[1]], x[1]))[:self.allowed(k) + 1]:
                size = max((s for s in SIZES if s <= len(words) - o), default=0)
                if size:
                    by_size[size].append((k, o))
                    anchors[size].add(word)
        self.anchors = {s: np.array(sorted(a), np.uint64) for s, a in anchors.items()}
        self.walks = {s: walks_for(s, share) for s in by_size}
        self.tables: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for size, windows in by_size.items():
            table: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for k, o in windows:
                words = self.items[k][1]
                for key in set(keys(words, np.array([o]), np.array([len(words) - o]), size, self.walks[size])[0].tolist()):
                    table[key].append((k, o))
            self.tables[size] = dict(table)
        self.sorted = {s: np.array(sorted(t), np.uint64) for s, t in self.tables.items()}
        # By length of run: sorted hashes, items and offsets of the runs, and which first bits any hash has.
        by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(self.items if exact else ()):
            for o, length in runs(len(words), self.allowed(k)):
                by_length[length].append((int(run_hashes(words[o:o + length], length)[0]), k, o))
        self.runs = {}
        for length, found in by_length.items():
            h, k, o = zip(*sorted(found), strict=True)
            hashes = np.array(h, np.uint64)
            bits = np.zeros(1 << 20, bool)
            bits[hashes >> np.uint64(44)] = True
            self.runs[length] = hashes, np.array(k), np.array(o), bits

    def allowed(self, k: int) -> int:
        """How many words of an item may be changed."""
        n = len(self.items[k][1])
        return int(self.share * n) if n >= LEAST_WORDS else 0

    def unchanged(self, words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """As ``candidates``, of texts and items that have a run of words in common."""
        for length, (hashes, items, offsets, bits) in self.runs.items():
            made = run_hashes(words, length)
            starts = np.flatnonzero(bits[made >> np.uint64(44)])
            low, high = (np.searchsorted(hashes, made[starts], side=s) for s in ("left", "right"))
            text = np.searchsorted(ends, starts, side="right")
            n = np.where(starts + length <= ends[text], high - low, 0)
            row = np.repeat(np.arange(len(starts)), n)
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(row))
            yield from zip(text[row].tolist(), items[at].tolist(), (starts[row] - offsets[at]).tolist(), strict=True)

    def candidates(self, words: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, where the item would begin) of windows that share a key; ``ends``: where each text's words end."""
        for size, known in self.anchors.items():
            place = np.searchsorted(known, words)
            place[place == len(known)] = 0
            every = np.flatnonzero(known[place] == words)
            for part in range(0, len(every), 16_384):
                starts = every[part:part + 16_384]
                text = np.searchsorted(ends, starts, side="right")
                made = keys(words, starts, ends[text] - starts, size, self.walks[size])
                at = np.searchsorted(self.sorted[size], made)
                at[at == len(self.sorted[size])] = 0
                for row, walk in zip(*np.nonzero(self.sorted[size][at] == made), strict=True):
                    for k, o in self.tables[size][int(made[row, walk])]:
                        yield int(text[row]), k, int(starts[row]) - o

    def matches(self, texts: list[str]) -> list[dict[int, tuple[int, int]]]:
        """Items found in each text: number of the item to (least distance, last word of that stretch)."""
        each = [word_hashes(spaced(t)) for t in texts]
        ends = np.cumsum([len(w) for w in each])
        words = np.concatenate([*each, np.array([_END])])
        found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        seen: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for t, k, begin in sorted({*self.candidates(words[:-1], ends), *self.unchanged(words[:-1], ends)}):
            best, item, begin = found[t], self.items[k][1], begin - int(ends[t]) + len(each[t])
            allowed = self.allowed(k)
            low, high = max(0, begin - allowed), min(len(each[t]), begin + len(item) + allowed)
            if any(a <= low and high <= b for a, b in seen[t, k]) or k in best and best[k][0] == 0:
                continue
            seen[t, k].append((low, high))
            # What is to be kept of the item must occur in the stretch at all.
            if np.isin(item, each[t][low:high]).sum() < len(item) - allowed:
                continue
            d, end = distance(item, each[t][low:high])
            if d <= allowed and (k not in best or d < best[k][0]):
                best[k] = (d, low + end)
        return found


def _blocks(benchmark: DataFrame, share: float, block: int, exact: bool) -> Iterator[Index]:
    """Indexes of the benchmark's items, block after block; null and empty texts are left out."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    held: list[tuple[object, str]] = []
    for r in rows.toLocalIterator():
        held.append((r.item_id, r.text))
        if len(held) == block:
            yield Index(held, share, exact)
            held = []
    if held:
        yield Index(held, share, exact)


def find(docs: DataFrame, benchmark: DataFrame, share: float = DISTANCE, block: int = BLOCK, exact: bool = True) -> DataFrame:
    """Benchmark items in whole texts: one row for each row of ``docs`` and item found in it.

    Returns doc_id, item_id, n_words (of the item), distance (words to change) and end_word (where the
    closest stretch ends). Texts that hold no item, null and empty ones among them, give no row; equal
    items give one each. Other columns, even of equal names, are ignored.
    """
    key, item = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {key}, item_id {item}, n_words long, distance long, end_word long"
    result = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark, share, block, exact):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(r: dict, sent=sent) -> dict:
            out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "n_words", "distance", "end_word")}
            for doc_id, found in zip(r["doc_id"], sent.value.matches(r["text"]), strict=True):
                for k, (d, end) in found.items():
                    item_id, words = sent.value.items[k]
                    for name, v in zip(out, (doc_id, item_id, len(words), d, end), strict=True):
                        out[name].append(v)
            return out

        result = result.unionByName(per_slice(texts(docs), schema, run))
    return result


def clean(docs: DataFrame, benchmark: DataFrame, share: float = DISTANCE, block: int = BLOCK, exact: bool = True) -> DataFrame:
    """The rows of ``docs``, with all columns, whose texts hold no benchmark item."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for index in _blocks(benchmark, share, block, exact):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(r: dict, sent=sent) -> dict:
            stays = [not found for found in sent.value.matches([t or "" for t in r["text"]])]
            return {k: [x for x, s in zip(v, stays, strict=True) if s] for k, v in r.items()}

        docs = per_slice(docs, schema, run)
    return docs
