"""Source divergence audit: how far the word use of each source is from every other one's, and what marks it.

Counts are a sparse matrix of sources by terms for each language. It is cut into blocks of columns by a hash of
the term and into bands of rows by a hash of the source; each pair of bands of a block is one task's K-squared quadtree. Quadrants
without any count are priced from their number of columns; the others are walked down to the cells, all pairs of sources together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import per_partition, saved
from tallyline.llm.terms import term_table, terms

#: Documents of a language that must hold a term for it to be kept.
DOCUMENTS = 30
#: Terms of a source that are reported.
TOP = 50
#: Columns of a block and rows of a band, on average: what one task's tree holds.
COLUMNS, ROWS = 1024, 32
#: Pairs of sources walked together.
PAIRS = 1024
#: Distinct (language, source, term) a task holds before it passes them on.
HELD = 400_000

_TABLE = term_table(with_digits=False)
_SCALE = 1_000_000_000
GROUP = ["lang", "source"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in (*GROUP, "text")])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each source, and documents that hold it.

    Tasks add up what they have read before it is shuffled.
    """
    def run(slices: Iterator[dict]) -> Iterator[dict]:
        count: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def out() -> Iterator[dict]:
            for (lang, source), (n, docs) in count.items():
                keys = list(n)
                for k in range(0, len(keys), 10_000):
                    part = keys[k:k + 10_000]
                    yield {"lang": [lang] * len(part), "source": [source] * len(part), "term": [t.decode() for t in part],
                           "n": [n[t] for t in part], "docs": [docs[t] for t in part]}
            count.clear()

        for r in slices:
            for lang, source, text in zip(r["lang"], r["source"], r["text"], strict=True):
                n, docs = count.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                found = terms(text, _TABLE)
                n.update(found)
                docs.update(set(found))
                size += len(n)
                if size >= HELD:
                    yield from out()
                    size = 0
        yield from out()

    rows = _rows(docs).withColumn("text", F.col("text").cast("binary"))
    counted = per_partition(rows, "lang string, source string, term string, n long, docs long", run)
    return counted.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _price(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share in billionths: p = 1 + floor(10^9 (n + 5) / (total + 5 kept)), in whole numbers of any size."""
    part = (n.cast("decimal(20,0)") + 5).cast("decimal(21,0)") * _SCALE
    return F.call_function("div", part, (total + 5 * kept).cast("decimal(20,0)")) + 1


def _quadrants(rows: np.ndarray, columns: np.ndarray, depth: int) -> list[np.ndarray]:
    """The tree as its non-empty quadrants: at level k, sorted codes of squares of 2^k by 2^k cells."""
    return [np.unique((rows >> k) << 32 | (columns >> k)) for k in range(depth + 1)]


def _holds(codes: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    code = row << 32 | column
    at = np.searchsorted(codes, code)
    return codes[np.minimum(at, len(codes) - 1)] == code if len(codes) else np.zeros(len(code), bool)


def _cell(codes: np.ndarray, values: np.ndarray, zero: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Prices of cells; those without a count have their source's price of nothing."""
    code = row << 32 | column
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    return np.where(codes[at] == code, values[at], zero[row])


def joint_walk(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, zero: np.ndarray, width: int,
               left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sum over ``width`` columns of the differences of prices, for each pair of rows (left, right).

    The matrix has ``values`` at (rows, columns) and ``zero[row]`` elsewhere. Columns are numbered so that
    those with any value come first. Each level of the tree is taken for all pairs at once: where the quadrants of both rows
    are empty, the gap between their prices of nothing counts once for each column; the others go down to cells.
    """
    total = np.zeros(len(left), np.int64)
    gap = np.abs(zero[left] - zero[right])
    depth = max(int(max(len(zero), width, 1) - 1).bit_length(), 0)
    levels = _quadrants(rows, columns, depth)
    order = np.argsort(rows << 32 | columns)
    codes, cells = (rows << 32 | columns)[order], values[order]
    pair, column = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k in range(depth, -1, -1):
        inside = column << k < width
        pair, column = pair[inside], column[inside]
        used = _holds(levels[k], left[pair] >> k, column) | _holds(levels[k], right[pair] >> k, column)
        spare, at = pair[~used], column[~used]
        np.add.at(total, spare, gap[spare] * (np.minimum((at + 1) << k, width) - (at << k)))
        pair, column = pair[used], column[used]
        if k:
            pair, column = np.repeat(pair, 2), np.repeat(column << 1, 2) | np.tile([0, 1], len(column))
    if len(pair):
        a = _cell(codes, cells, zero, left[pair], column)
        b = _cell(codes, cells, zero, right[pair], column)
        np.add.at(total, pair, np.abs(a - b))
    return total


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """One pair of bands of one block: the part of each pair of sources in it.

    Rows without a term stand for sources, with the price of nothing as ``p``.
    """
    first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
    marks, cells = rows[rows["term_hash"].isna()], rows[rows["term_hash"].notna()]
    marks = marks.sort_values("source").reset_index(drop=True)
    number = pd.Series(marks.index.to_numpy(), index=marks["source"])
    row = number.loc[cells["source"]].to_numpy(np.int64) if len(cells) else np.zeros(0, np.int64)
    # The hash keeps columns apart up to collisions within a block; the term itself decides.
    column = pd.factorize(cells["term"], sort=True)[0].astype(np.int64) if len(cells) else np.zeros(0, np.int64)
    band = marks["band"].to_numpy()
    a, b = np.nonzero((band[:, None] == first) & (band[None, :] == second))
    if first == second:
        a, b = a[a < b], b[a < b]
    matrix = (row, column, cells["p"].to_numpy(np.int64), marks["p"].to_numpy(np.int64), int(rows["width"].iloc[0]))
    parts = [joint_walk(*matrix, a[k:k + PAIRS], b[k:k + PAIRS]) for k in range(0, len(a), PAIRS)]
    names = marks["source"].to_numpy(object)
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "source": names[a], "item": names[b], "part_value": np.concatenate([np.zeros(0, np.int64), *parts])})


def _bands(size: Column, each: int) -> Column:
    return F.greatest(F.ceil(size / each), F.lit(1)).cast("long")


def _pairs(cells: DataFrame, groups: DataFrame, widths: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways round."""
    marks = groups.join(widths, "lang").select(
        "lang", "source", "band", "bands", "block", "width", F.lit(None).cast("long").alias("term_hash"),
        F.lit("").alias("term"), F.col("p0").alias("p"))
    filled = cells.join(widths, ["lang", "block"]).select(*marks.columns)
    rows = marks.unionByName(filled)
    # A row meets every band, its own included: once for each pair of bands it belongs to.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))
    dealt = rows.select("*", other.alias("_other")).select(
        "*", F.least("band", "_other").alias("first"), F.greatest("band", "_other").alias("second"))
    parts = dealt.groupBy("lang", "block", "first", "second").applyInPandas(
        _block, "lang string, source string, item string, part_value long")
    value = parts.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value"))
    turned = value.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return value.unionByName(turned)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    window = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    return rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(window).alias("rank"))


def audit(docs: DataFrame, least: int = DOCUMENTS, top: int = TOP, columns: int = COLUMNS, rows: int = ROWS) -> DataFrame:
    """Every source of a language against each other one, and the terms it uses more than its language does.

    Returns lang, source, part, item, value, rank. Part ``pair``: item is another source of the language, value the sum
    over the language's kept terms (in ``least`` of its documents) of the differences of their smoothed shares. Part ``term``:
    item is a kept term the source has, value its share less the language's, if above 0; only ``top`` of them. Shares are billionths.
    Null texts, languages and sources count as ''. Repeated rows count as often as they stand. A source without terms has
    the smoothed share of nothing; a language without kept terms has pairs of value 0. An empty table gives no rows. Other
    columns, even of equal names, are ignored.
    """
    counts = saved(term_counts(docs), "term-counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = saved(of_lang.where(F.col("docs") >= least).drop("docs"), "kept-terms")
    by_lang = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("kept"))
    used = saved(counts.join(kept, ["lang", "term"]), "used-terms")
    totals = used.groupBy(*GROUP).agg(F.sum("n").alias("total"))

    # Every source, also one without terms; its languages' sizes; its band among the bands of its language.
    sources = _rows(docs).select(*GROUP).distinct()
    bands = sources.groupBy("lang").agg(_bands(F.count("*"), rows).alias("bands"))
    groups = saved(
        sources.join(bands, "lang").join(by_lang, "lang", "left").join(totals, GROUP, "left")
        .na.fill(0, ["lang_total", "kept", "total"]).select(
            *GROUP, "bands", "lang_total", "kept", "total", F.pmod(F.xxhash64("source"), F.col("bands")).alias("band"),
            _bands(F.col("kept"), columns).alias("blocks"), F.when(F.col("kept") > 0, _price(F.lit(0), F.col("total"), F.col("kept")))
            .otherwise(0).alias("p0")), "source-groups")

    hashed = F.xxhash64("term")
    cells = used.join(groups, GROUP).select(
        *GROUP, "band", "bands", F.pmod(hashed, F.col("blocks")).alias("block"), hashed.alias("term_hash"), "term",
        _price(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _price(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    sizes = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    width = kept.join(sizes, "lang").groupBy("lang", F.pmod(hashed, F.col("blocks")).alias("block")).agg(F.count("*").alias("width"))
    every = sizes.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    widths = every.join(width, ["lang", "block"], "left").na.fill(0, ["width"])

    pairs = _pairs(cells, groups, widths)
    marked = cells.where("p > q").select(*GROUP, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(marked, "term").where(F.col("rank") <= top))
