"""Operator 5, token counts with overlap resynchronisation.

A text of at most ``huge`` characters is counted whole, word by word through a table of the
words met so far. A longer one is cut into chunks of ``step`` characters that overlap by
``overlap``; the chunks are spread over the cluster and encoded with offsets. Two neighbours
are spliced at a position inside their overlap that both encodings prove stable: white space
stands before it, both have a token that starts there, and the next ``PROOF`` tokens have equal
ids and offsets. Texts for which a seam has no such position are encoded again with overlaps
doubled until every seam aligns or the chunk is the whole rest.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.bpe import HELD, split_words
from tallyline.llm.common import per_slice, saved, texts, tokenizer

PROOF = 4
#: Stable positions a chunk reports for each seam.
KEPT = 64


def _encoded(path: str, text: str, start: int) -> tuple[list[int], list[int]]:
    """Ids and absolute starts of the tokens of one chunk."""
    made = tokenizer(path).encode(text, add_special_tokens=False)
    return made.ids, [start + a for a, _ in made.offsets]


def seams(path: str, text: str, start: int, low: int, high: int) -> tuple[int, list, list]:
    """Number of tokens, and the stable positions in [start, low) and in [high, end) of one chunk.

    Each position comes as (where, tokens before it, ids and offsets of the tokens that follow).
    """
    ids, at = _encoded(path, text, start)

    def stable(a: int, b: int) -> list:
        found = []
        for k in range(len(at) - PROOF):
            p = at[k]
            if a < p < b and text[p - start - 1].isspace() and (k == 0 or at[k - 1] < p):
                proof = " ".join(f"{i}:{x - p}" for i, x in zip(ids[k:k + PROOF], at[k:k + PROOF], strict=True))
                found.append((p, k, proof))
        return found[:KEPT]

    return len(ids), stable(start, low), stable(high, start + len(text))


def splice(chunks: list[tuple]) -> int | None:
    """Tokens of a text from its chunks in order, None where a seam has no common stable position."""
    total, skip = 0, 0
    for k, (n, _, tail) in enumerate(chunks):
        if k + 1 == len(chunks):
            return total + n - skip
        after = {(p, proof): before for p, before, proof in chunks[k + 1][1]}
        # A position at or before the last splice would count tokens twice.
        common = [(before, after[p, proof]) for p, before, proof in tail if (p, proof) in after and before >= skip]
        if not common:
            return None
        cut, behind = common[len(common) // 2]
        total, skip = total + cut - skip, behind
    return total


def chunked(path: str, text: str, step: int, overlap: int) -> int | None:
    """The same work on one text, chunk after chunk."""
    found, start = [], 0
    while True:
        last = start + step + overlap >= len(text)
        part = text[start:] if last else text[start:start + step + overlap]
        found.append(seams(path, part, start, start + overlap if start else start, start + step))
        if last:
            return splice(found)
        start += step


def widened(path: str, text: str, step: int, overlap: int) -> int:
    """Double the overlap, and the chunk with it, until every seam aligns."""
    while step < len(text):
        overlap *= 2
        step = max(step, 2 * overlap)
        if (n := chunked(path, text, step, overlap)) is not None:
            return n
    return len(_encoded(path, text, 0)[0])


def _small(docs: DataFrame, path: str) -> DataFrame:
    held: dict[str, int] = {}

    def count(rows: dict) -> dict:
        split = [split_words(t) for t in rows["text"]]
        if len(held) > HELD:
            held.clear()
        new = [w for w in set().union(*split) if w not in held]
        made = tokenizer(path).encode_batch_fast(new, add_special_tokens=False)
        held.update((w, len(x.ids)) for w, x in zip(new, made, strict=True))
        return {"doc_id": rows["doc_id"], "n_bytes": rows["n_bytes"],
                "n_tokens": [sum(map(held.__getitem__, words)) for words in split]}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_slice(docs, f"doc_id {key}, n_bytes long, n_tokens long", count)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, huge: int = 32_768, step: int = 16_384,
                 overlap: int = 1_024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit``) of every whole text.

    One row for each row of ``docs``, repeated ids included; null and empty texts have no bytes
    and no tokens. The tokenizer must never join across white space. Columns other than doc_id
    and text are ignored.
    """
    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    small = _small(rows.where(F.char_length("text") <= huge), path)
    # Repeated or missing ids must not mix chunks of different rows.
    long = (rows.where(F.char_length("text") > huge)
            .select("doc_id", "n_bytes", "text", F.xxhash64("text").alias("h")))
    key = docs.schema["doc_id"].dataType.simpleString()

    def cut(r: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("h", "n_bytes", "start", "last", "text")}
        for h, n, text in zip(r["h"], r["n_bytes"], r["text"], strict=True):
            start, last = 0, False
            while not last:
                last = start + step + overlap >= len(text)
                for k, v in zip(out, (h, n, start, last, text[start:start + step + overlap]), strict=True):
                    out[k].append(v)
                start += step
        return out

    def encode(r: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("h", "n_bytes", "start", "n", "head", "tail")}
        for h, n_bytes, start, last, text in zip(*(r[k] for k in ("h", "n_bytes", "start", "last", "text")), strict=True):
            n, head, tail = seams(path, text, start, start + overlap if start else start, start + step)
            for k, v in zip(out, (h, n_bytes, start, n, head, [] if last else tail), strict=True):
                out[k].append(v)
        return out

    seam = "array<struct<p:long,k:long,proof:string>>"
    # Equal texts are encoded once; their chunks spread by where they begin.
    distinct = long.select("h", "n_bytes", "text").dropDuplicates(["h", "n_bytes"])
    chunks = per_slice(distinct, "h long, n_bytes long, start long, last boolean, text string", cut, rows=16)
    summed = (per_slice(chunks.repartition("h", "start"), f"h long, n_bytes long, start long, n long, head {seam}, tail {seam}",
                        encode, rows=64)
              .groupBy("h", "n_bytes").agg(F.array_sort(F.collect_list(F.struct("start", "n", "head", "tail"))).alias("c")))

    @F.pandas_udf("long")
    def spliced(c: pd.Series) -> pd.Series:
        point = lambda s: [(x["p"], x["k"], x["proof"]) for x in s]
        return pd.Series([splice([(x["n"], point(x["head"]), point(x["tail"])) for x in row]) for row in c], dtype="Int64")

    counted = saved(summed.select("h", "n_bytes", spliced("c").alias("n_tokens")), "token-seams")
    ids = long.select("doc_id", "h", "n_bytes")
    done = ids.join(counted.where("n_tokens is not null"), ["h", "n_bytes"]).select("doc_id", "n_bytes", "n_tokens")

    def widen(r: dict) -> dict:
        return {"doc_id": r["doc_id"], "n_bytes": r["n_bytes"], "n_tokens": [widened(path, t, step, overlap) for t in r["text"]]}

    failed = long.join(counted.where("n_tokens is null").select("h", "n_bytes"), ["h", "n_bytes"], "left_semi")
    again = per_slice(failed.select("doc_id", "n_bytes", "text"), f"doc_id {key}, n_bytes long, n_tokens long", widen)
    return small.unionByName(done).unionByName(again).withColumn("over_limit", F.col("n_tokens") > limit)
