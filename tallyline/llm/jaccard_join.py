"""Operator 3, the n-gram Jaccard join with Bayesian candidate pruning.

Documents with equal sets of word shingles form one class and go on as one. Classes that agree in
a band of MinHash values meet in a bucket; there, values are compared a few at a time, and a pair
is dropped as soon as the posterior probability that its similarity reaches the threshold falls
below ``TOLERANCE``. What is left joins classes to clusters. Inside a cluster every pair is pruned
the same way and, if it stays, verified exactly on the shingle sets.

Nothing is ever emitted for each pair. Buckets and clusters of any size are cut into blocks, and
each pair of blocks is one unit of work that returns at most a row for each of its members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyline.llm.common import per_slice, saved, texts
from tallyline.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
#: A pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
STEP = 16
#: Members of a block when signatures, and when shingle sets are compared.
SIGNATURE_BLOCK, SET_BLOCK = 1024, 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of a lower-cased text, words standing between white space."""
    raw = np.frombuffer((" ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) < 2:
        return np.empty(0, np.uint64)
    begins = np.concatenate([[0], np.flatnonzero(raw[:-1] == 32) + 1])
    place = np.arange(len(raw)) - np.repeat(begins, np.diff(np.append(begins, len(raw))))
    table = np.full(int(place.max()) + 1, _BASE, np.uint64)
    table[0] = 1
    return _mixed(np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(table)[place], begins))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; a shorter text is one run, an empty one has none."""
    w = word_hashes(text)
    if not len(w):
        return w
    size = min(words, len(w))
    h = np.zeros(len(w) - size + 1, np.uint64)
    for k in range(size):
        h = h * _BASE + w[k:k + len(h)]
    return np.unique(_mixed(h + np.uint64(size)))


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of each MinHash value of a shingle set."""
    if not len(s):
        return np.zeros(HASHES, np.uint16)
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for k in range(0, len(s), 4096):
        part = s[k:k + 4096]
        least = np.minimum(least, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1))
    return (_mixed(least) >> np.uint64(48)).astype(np.uint16)


@cache
def needed(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Fewest agreeing values after STEP, 2 * STEP, ... comparisons with which a pair stays.

    Values agree with probability J, or by chance of 16 bits; with a flat prior the posterior is a
    Beta distribution, integrated here on a grid in logarithms.
    """
    s = (np.arange(200_000) + 0.5) / 200_000
    high = s >= threshold
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            p = np.exp(log - log.max())
            if p[high].sum() / p.sum() >= tolerance:
                least.append(m)
                break
    return tuple(least)


def pruned(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a[i], b[j]) of signatures that stay after each step of comparisons."""
    agree = np.zeros(len(i), np.int16)
    for k, m in enumerate(least):
        cut = slice(k * STEP, (k + 1) * STEP)
        agree = agree + (a[i, cut] == b[j, cut]).sum(axis=1, dtype=np.int16)
        stay = agree >= m
        i, j, agree = i[stay], j[stay], agree[stay]
    return i, j


def _pairs(n: int, m: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two blocks, or of one with itself, some tens of thousands at a time."""
    rows = max(1, 65_536 // max(1, m))
    for k in range(0, n, rows):
        i, j = np.meshgrid(np.arange(k, min(n, k + rows)), np.arange(m), indexing="ij")
        i, j = i.ravel(), j.ravel()
        keep = i < j if same else slice(None)
        yield i[keep], j[keep]


class Forest:
    """Union-find over the members of one unit of work."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def _units(members: DataFrame, key: list[str], size: int) -> DataFrame:
    """Deal the members of each group into blocks of about ``size``, and each block to its pairs of blocks."""
    counts = members.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / size).cast("int")
    own = F.pmod(F.xxhash64("c", F.lit(17)), F.col("blocks")).cast("int")
    return (members.join(counts.select(*key, blocks.alias("blocks")), key)
            .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other"))


def _by_unit(units: DataFrame, key: list[str], schema: str, fn: Callable[[pa.Table], dict[str, list]]) -> DataFrame:
    """Call ``fn`` with the rows of each unit; units stream through sorted partitions."""
    out_schema = T._parse_datatype_string(schema)
    order = [*key, "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out_schema)
        held: list[pa.RecordBatch] = []

        def marks(b: pa.RecordBatch) -> list[tuple]:
            return list(zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in order), strict=True))

        now, out, rows = None, {f.name: [] for f in out_schema}, 0

        def done() -> None:
            for k, v in fn(pa.Table.from_batches(held)).items():
                out[k] += v
            held.clear()

        for b in batches:
            at = marks(b)
            start = 0
            for k in range(1, len(at) + 1):
                if k == len(at) or at[k] != at[start]:
                    if held and now != at[start]:
                        done()
                    now = at[start]
                    held.append(b.slice(start, k - start))
                    start = k
            if len(next(iter(out.values()))) > 4096:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)
                out = {f.name: [] for f in out_schema}
        if held:
            done()
        yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return units.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, out_schema)


def _split(t: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Row numbers of the two blocks of a unit, and whether they are one."""
    own, i, j = t["own"].to_numpy(), t["i"][0].as_py(), t["j"][0].as_py()
    return np.flatnonzero(own == i), np.flatnonzero(own == j), i == j


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, HASHES)


def _near_in_bucket(threshold: float, tolerance: float):
    least = needed(threshold, tolerance)

    def run(t: pa.Table) -> dict[str, list]:
        c, sig, band = t["c"].to_pylist(), _signatures(t), t["band"][0].as_py()
        left, right, same = _split(t)
        forest = Forest(len(c))
        for i, j in _pairs(len(left), len(right), same):
            i, j = left[i], right[j]
            for b in range(band):  # met before
                new = (sig[i, b * ROWS:(b + 1) * ROWS] != sig[j, b * ROWS:(b + 1) * ROWS]).any(axis=1)
                i, j = i[new], j[new]
            for x, y in zip(*pruned(sig, sig, i, j, least), strict=True):
                forest.link(int(x), int(y))
        roots = [(k, r) for k in range(len(c)) if (r := forest.root(k)) != k]
        return {"u": [c[k] for k, _ in roots], "v": [c[r] for _, r in roots]}

    return run


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections between two blocks, by products of incidence matrices."""
    both = np.concatenate([left, right])
    values, column = np.unique(np.concatenate([sets[k] for k in both]), return_inverse=True)
    row = np.repeat(np.arange(len(both)), [len(sets[k]) for k in both])
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    found = np.zeros((len(left), len(right)), np.float64)
    width = 8192
    for k in range(0, len(values), width):
        a, b = np.searchsorted(column, [k, k + width])
        m = np.zeros((len(both), min(width, len(values) - k)), np.float32)
        m[row[a:b], column[a:b] - k] = 1
        found += m[: len(left)] @ m[len(left):].T
    return found


def _linked_in_cluster(threshold: float, tolerance: float):
    least = needed(threshold, tolerance)

    def run(t: pa.Table) -> dict[str, list]:
        c, sig, n_docs = t["c"].to_pylist(), _signatures(t), t["n_docs"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
        left, right, same = _split(t)
        kept = [pruned(sig, sig, left[i], right[j], least) for i, j in _pairs(len(left), len(right), same)]
        i, j = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.empty(0, int),) * 2
        sizes = np.array([len(s) for s in sets])
        if len(i) > 4 * (len(left) + len(right)):
            at = np.zeros(len(c), int)
            at[left] = np.arange(len(left))
            to = np.zeros(len(c), int)
            to[right] = np.arange(len(right))
            shared = _overlaps(sets, left, right)[at[i], to[j]]
        else:
            shared = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], float)
        # In whole numbers, so that a similarity of exactly the threshold counts.
        linked = shared * 1000 >= round(threshold * 1000) * (sizes[i] + sizes[j] - shared)
        i, j = i[linked], j[linked]
        links = np.bincount(i, n_docs[j], len(c)) + np.bincount(j, n_docs[i], len(c)) if len(i) else np.zeros(len(c))
        forest = Forest(len(c))
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            forest.link(x, y)
        rows = [k for k in range(len(c)) if links[k]]
        return {"u": [c[k] for k in rows], "v": [c[forest.root(k)] for k in rows], "links": [int(links[k]) for k in rows]}

    return run


def _row_key() -> Column:
    return F.xxhash64("text")


def linked(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Groups of similar documents: one row for each row of ``docs``.

    Returns doc_id, row_key (hash of the text, which with doc_id names a row), class_id (least
    doc_id of the group of documents joined by links), n_links (other documents whose similarity
    reaches the threshold), n_class (rows in the group), and stays (true for the rows of the
    group's first document, by doc_id and row_key; rows without an id come last). Null and empty
    texts have no shingles and are copies of each other; a text of fewer than ``words`` words is one
    shingle. Columns other than doc_id and text are ignored.
    """
    def sketch(rows: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "row_key", "c", "sig")}
        for doc_id, key, text in zip(rows["doc_id"], rows["row_key"], rows["text"], strict=True):
            s = shingles(text, words)
            total = [int(np.bitwise_xor.reduce(_mixed(s ^ f))) ^ int((s * f).sum()) for f in (_FACTORS[0], _FACTORS[1])] if len(s) else [0, 0]
            for k, v in zip(out, (doc_id, key, total[0].to_bytes(8, "big") + total[1].to_bytes(8, "big"), signature(s).tobytes()), strict=True):
                out[k].append(v)
        return out

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).withColumn("row_key", _row_key())
    sketched = saved(per_slice(rows, f"doc_id {key}, row_key long, c binary, sig binary", sketch), "signatures")
    classes = saved(sketched.groupBy("c").agg(F.count(F.lit(1)).alias("n_docs"), F.first("sig").alias("sig"),
                                              F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")).alias("first")), "classes")
    # Sets without shingles are similar to nothing but each other.
    filled = classes.where(F.col("c") != F.lit(bytes(16)))
    band = F.posexplode(F.array(*[F.substring("sig", 2 * ROWS * b + 1, 2 * ROWS) for b in range(BANDS)])).alias("band", "key")
    bucketed = _units(filled.select("c", band), ["band", "key"], SIGNATURE_BLOCK)
    near = _by_unit(bucketed.join(filled.select("c", "sig"), "c"), ["band", "key"], "u binary, v binary", _near_in_bucket(threshold, tolerance))
    clusters = saved(components(near).select(F.col("node").alias("c"), F.col("root").alias("cluster")), "clusters")

    members = clusters.join(classes, "c")
    named = members.select("c", "cluster", "sig", "n_docs", F.col("first.doc_id").alias("doc_id"), F.col("first.row_key").alias("row_key"))
    unit_rows = _units(named, ["cluster"], SET_BLOCK)
    wanted = named.select("doc_id", "row_key", "c")

    def sets(r: dict) -> dict:
        return {"c": r["c"], "shingles": [shingles(t, words).tobytes() for t in r["text"]]}

    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["row_key"] == wanted["row_key"])
    # Repeated rows give equal sets, of which one is kept.
    found = saved(per_slice(rows.join(wanted, same).select("c", "text"), "c binary, shingles binary", sets).dropDuplicates(["c"]), "shingle-sets")
    links = saved(_by_unit(unit_rows.drop("doc_id", "row_key").join(found, "c"), ["cluster"], "u binary, v binary, links long",
                           _linked_in_cluster(threshold, tolerance)), "links")

    groups = components(links.select("u", "v"))
    per_class = (classes.select("c", "n_docs", "first").join(groups.withColumnRenamed("node", "c"), "c", "left")
                 .join(links.groupBy(F.col("u").alias("c")).agg(F.sum("links").alias("links")), "c", "left")
                 .withColumn("root", F.coalesce("root", "c")))
    per_class = saved(per_class, "groups")
    leads = per_class.groupBy("root").agg(F.min("first").alias("lead"), F.sum("n_docs").alias("n_class"))
    result = (per_class.join(leads, "root")
              .select("c", "lead", "n_class", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")))
    lead_row = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("row_key") == F.col("lead.row_key"))
    return (sketched.drop("sig").join(result, "c")
            .select("doc_id", "row_key", F.col("lead.doc_id").alias("class_id"), "n_links", "n_class", lead_row.alias("stays")))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each group, with all columns of ``docs``, whatever their names; of repeated rows that would stay, one does."""
    groups = linked(docs, **options)
    stays = groups.where("stays").groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias("times"))
    flags = saved(stays, "staying")
    own = "row_key"
    while own in docs.columns:
        own = f"_{own}"
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = keyed["doc_id"].eqNullSafe(flags["doc_id"]) & (keyed[own] == flags["row_key"])
    once = keyed.join(flags.where("times = 1"), same, "left_semi").select(*docs.columns)
    more = keyed.join(flags.where("times > 1"), same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
    return once.unionByName(more)
