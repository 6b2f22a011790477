"""Ranked lexical search: the best documents for each item, by reading postings in the order of their impact.

Documents are dealt into shards, a few thousand each. A task ranks every item over each of its shards with no random access:
it reads the item's posting lists from the highest impact on and keeps, for every document, the score so far and the highest
it may still reach, until all that may be among the best are known exactly. The best of all tasks are then ranked by Spark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyline.llm.common import per_slice, saved
from tallyline.llm.terms import term_table, terms

#: Documents reported for an item.
TOP = 10
#: Items taken at once; every block of them sees all documents.
BLOCK = 2_000
#: Documents of a shard, and entries of each list in the first round; later rounds double that.
SHARD, FIRST = 8_192, 256

_TABLE = term_table(with_digits=True)


class Item(NamedTuple):
    item_id: object
    terms: np.ndarray  #: distinct terms, as numbers
    times: np.ndarray  #: how often each stands in the item


def _blocks(items: DataFrame, block: int) -> Iterator[tuple[list[Item], dict[bytes, int]]]:
    """Items as numbered terms, block after block, with the numbers."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    number: dict[bytes, int] = {}
    held: list[Item] = []
    for r in rows.toLocalIterator():
        found = Counter(number.setdefault(t, len(number)) for t in terms(bytes(r.text), _TABLE))
        held.append(Item(r.item_id, np.array(list(found), np.int64), np.array(list(found.values()), np.int64)))
        if len(held) == block:
            yield held, number
            held, number = [], {}
    if held:
        yield held, number


def _postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): a document's length, and which of the numbered terms it has how often."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(r: dict) -> dict:
        out: dict[str, list] = {"doc_id": r["doc_id"], "n": [], "terms": [], "counts": []}
        for text in r["text"]:
            found = terms(text, _TABLE)
            count = Counter(found)
            known = count.keys() & number.keys()
            out["n"].append(len(found))
            out["terms"].append([number[t] for t in known])
            out["counts"].append([count[t] for t in known])
        return out

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return per_slice(rows, f"doc_id {key}, n long, terms array<int>, counts array<long>", run)


class Lists(NamedTuple):
    """The posting lists of a shard, one after the other, each from its highest impact on."""

    begin: np.ndarray
    doc: np.ndarray
    impact: np.ndarray
    documents: int


def make_lists(doc: np.ndarray, term: np.ndarray, count: np.ndarray, m: np.ndarray, n_terms: int) -> Lists:
    """Lists of a shard's postings (doc, term, count); ``m`` is the weight of each document's length."""
    impact = 1_000_000_000 * count // (1000 * count + 8 * m[doc])
    order = np.lexsort((-impact, term))
    return Lists(np.searchsorted(term[order], np.arange(n_terms + 1)), doc[order], impact[order], len(m))


def resolve(lists: Lists, wanted: np.ndarray, weight: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may be among the ``k`` best with ``least`` or more, and their exact scores, and entries read.

    ``weight`` is that of each wanted term in the item. Lists are read in rounds, those only that some open
    document may still stand in. A document is open while it may reach the k-th best lower bound and its bounds differ. Those of equal score
    at the end are all returned, so that the caller can settle ties.
    """
    begin, end = lists.begin[wanted], lists.begin[wanted + 1]
    used = (end > begin) & (weight > 0)
    at, end, weight = begin[used].copy(), end[used], weight[used]
    low = np.zeros(lists.documents, np.int64)
    seen = np.zeros((lists.documents, len(at)), bool)
    last = weight * lists.impact[at]
    reading, step, read = np.ones(len(at), bool), FIRST, 0
    while True:
        for t in np.flatnonzero(reading):
            part = slice(at[t], min(at[t] + step, end[t]))
            docs = lists.doc[part]
            low[docs] += weight[t] * lists.impact[part]
            seen[docs, t] = True
            at[t] = part.stop
            last[t] = weight[t] * lists.impact[part.stop - 1] if part.stop < end[t] else 0
            read += len(docs)
        best = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else 0
        high = low + last.sum() - seen @ last
        may = np.flatnonzero(high >= max(best, least))
        still = may[high[may] > low[may]]
        if not len(still):
            return may, low[may], read
        reading = (at < end) & ~seen[still].all(axis=0)
        step *= 2


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for k in range(0, batch.num_rows, size):
            held.append(batch.slice(k, size))
            if sum(b.num_rows for b in held) >= size:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _order(found: tuple[int, object]) -> tuple:
    score, doc_id = found
    return (-score, doc_id is None, doc_id)


def _best(postings: DataFrame, items: list[Item], weight: np.ndarray, n: int, total: int, k: int, schema: str) -> DataFrame:
    """The ``k`` best documents of every task for each item."""
    out_schema = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, object]]] = [[] for _ in items]
        for shard in _shards(batches, SHARD):
            term = shard.column("terms").combine_chunks()
            sizes = np.diff(term.offsets.to_numpy())
            # Documents by their place in the shard; a document's m grows with its length against the mean.
            m = 25 + 75 * shard.column("n").to_numpy() * n // total
            lists = make_lists(
                np.repeat(np.arange(len(sizes)), sizes), term.flatten().to_numpy().astype(np.int64),
                shard.column("counts").combine_chunks().flatten().to_numpy(), m, len(weight))
            ids = shard.column("doc_id")
            for held, item in zip(best, items, strict=True):
                least = held[-1][0] if len(held) == k else 1
                may, score, _ = resolve(lists, item.terms, item.times * weight[item.terms], k, least)
                found = [(int(s), ids[int(d)].as_py()) for d, s in zip(may, score, strict=True)]
                held[:] = sorted([*held, *found], key=_order)[:k]
        rows = [(i, item.item_id, doc_id, score) for i, (held, item) in enumerate(zip(best, items, strict=True)) for score, doc_id in held]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(out_schema), strict=True)], schema=to_arrow_schema(out_schema))

    return postings.mapInArrow(run, out_schema)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """The ``k`` documents of highest score for each row of ``items`` (item_id, text); equal scores by ascending doc_id.

    Returns item_id, rank, doc_id, score. A document with score 0 is none of them. A term's weight goes by the number of documents that
    have it, an occurrence's by the document's length, all in whole numbers. Null texts have no terms. Each row is a document, or an item, of its
    own: repeated documents rank one after the other, those without an id last among equals, repeated items come out repeatedly.
    An empty table gives no rows. Other columns, even of equal names, are ignored.
    """
    spark = docs.sparkSession
    key, name = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"item int, item_id {name}, doc_id {key}, score long"
    result = [spark.createDataFrame([], f"item_id {name}, rank int, doc_id {key}, score long")]
    for held, number in _blocks(items, block):
        postings = saved(_postings(docs, number), "postings")
        n, total = postings.agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if total == 0:
            continue
        # One row for each term of the block.
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weight = np.zeros(len(number), np.int64)
        for term, documents in holding:
            weight[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * documents + 1)))
        best = _best(postings, held, weight, n, total, k, schema)
        window = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
        result.append(ranked.select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, result)
