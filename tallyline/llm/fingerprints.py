"""Operator 8, document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for one text, the running sums of code point times power of a base, modulo
two primes. Differences of two sums give the hash of any span, so that spans compare in constant
time and longest common extensions take a binary search. A fingerprint is the hash of the whole
text and, for two span lengths, the smallest span hashes of all positions: likeness is the share
of text that two documents have in common, estimated from those.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import per_partition, sha256, texts

#: Primes and bases; products of two residues stay below 2**63.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 69_069_069)
#: (span length, number of hashes kept); the short spans speak for texts below ``SHORT`` code points.
LONG_SPANS, SHORT_SPANS, SHORT = (16, 48), (4, 24), 96

#: Ids drawn for each range where ids have no quantiles.
SAMPLED = 100

_powers = [np.ones(1, np.int64) for _ in PRIMES]


def _power(which: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of a base, kept in the worker and doubled as longer texts come."""
    have, p = _powers[which], PRIMES[which]
    while len(have) < n:
        step = int(have[-1]) * BASES[which] % p
        have = np.concatenate([have, have * step % p])
    _powers[which] = have
    return have


_inverses = [np.ones(1, np.int64) for _ in PRIMES]


def _inverse(which: int, n: int) -> np.ndarray:
    have, p = _inverses[which], PRIMES[which]
    unit = pow(BASES[which], -1, p)
    while len(have) < n:
        have = np.concatenate([have, have * (int(have[-1]) * unit % p) % p])
    _inverses[which] = have
    return have


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        self.n = len(points)
        self.sums = []
        for which, p in enumerate(PRIMES):
            terms = points * _power(which, self.n)[: self.n] % p
            self.sums.append(np.concatenate([[0], np.cumsum(terms) % p]))

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of one length, wherever in whichever text they stand."""
        count = max(0, self.n - length + 1)
        made = []
        for which, p in enumerate(PRIMES):
            diff = (self.sums[which][length:length + count] - self.sums[which][:count]) % p
            made.append(diff * _inverse(which, count)[:count] % p)
        return made[0] << np.int64(31) | made[1]

    def span(self, start: int, length: int) -> tuple[int, int]:
        """Residues of one span, as if it stood at the start of a text."""
        out = []
        for which, p in enumerate(PRIMES):
            diff = int(self.sums[which][start + length] - self.sums[which][start]) % p
            out.append(diff * int(_inverse(which, start + 1)[start]) % p)
        return out[0], out[1]

    def extension(self, other: PrefixHash, i: int = 0, j: int = 0) -> int:
        """Length of the longest common extension of this text from i and the other from j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(i, mid) == other.span(j, mid):
                low = mid
            else:
                high = mid - 1
        return low


def _smallest(hashes: np.ndarray, keep: int) -> np.ndarray:
    """The smallest distinct values of mixed span hashes, as 32-bit numbers."""
    x = (hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
    if len(x) > 8 * keep:
        few = np.unique(np.partition(x, 4 * keep)[: 4 * keep])
        if len(few) >= keep:
            return few[:keep]
    return np.unique(x)[:keep]


def fingerprint(prefix: PrefixHash) -> str:
    """Length and hash of the whole text, then the smallest hashes of long and of short spans."""
    whole = prefix.span(0, prefix.n) if prefix.n else (0, 0)
    parts = [_smallest(prefix.spans(min(length, max(1, prefix.n))), keep) for length, keep in (LONG_SPANS, SHORT_SPANS)]
    return f"{prefix.n:x}.{whole[0]:08x}{whole[1]:08x}." + ".".join("".join(f"{v:08x}" for v in part) for part in parts)


def _read(mark: str, keep: int) -> list[int]:
    return [int(mark[k:k + 8], 16) for k in range(0, len(mark), 8)][:keep]


def likeness(a: str, b: str) -> float:
    """Share of spans in common, 0 to 1, from two fingerprints alone; 1 only for equal texts."""
    if a == b:
        return 1.0
    (na, _, long_a, short_a), (nb, _, long_b, short_b) = a.split("."), b.split(".")
    pick, keep = ((short_a, short_b), SHORT_SPANS[1]) if min(int(na, 16), int(nb, 16)) < SHORT else ((long_a, long_b), LONG_SPANS[1])
    x, y = set(_read(pick[0], keep)), set(_read(pick[1], keep))
    union = sorted(x | y)[:keep]
    if not union or not x or not y:
        return 0.0
    jaccard = sum(v in x and v in y for v in union) / len(union)
    return min(2 * jaccard / (1 + jaccard), 0.9999)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame, parts: int) -> list:
    """First ids of up to ``parts`` ranges of about equal row counts; each is an id that occurs, or None where ids are missing.

    Whole numbers have quantiles; of texts a bounded random sample has.
    """
    known = docs.where("doc_id IS NOT NULL")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        shares = [k / parts for k in range(1, parts)] or [0.5]
        found = known.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * parts))).first()[0] or []
    else:
        drawn = sorted(r[0] for r in known.select("doc_id").orderBy(F.rand(1)).limit(SAMPLED * parts).collect())
        found = drawn[::SAMPLED]
    low, rows, with_id = docs.agg(F.min("doc_id"), F.count("*"), F.count("doc_id")).first()
    ids = sorted(set(found) | ({low} if with_id else set()))
    return [None, *ids] if rows > with_id else ids


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, each row's next one being that of the next id.

    Rows are dealt once, by ranges of ids; the first row of each range also goes to the range before,
    the very first to the last range, so that every row finds its successor where it is. Rows of one
    id are ordered by their text, rows without an id come first. Ids are whole numbers or texts. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and common_prefix, the
    longest common extension of text and edited text from their starts. Null texts count as
    empty; an empty text is like another empty one only.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs)
    first = _ranges(rows, parts)
    missing = bool(first) and first[0] is None
    known = [x for x in first if x is not None]
    number = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)

    @F.pandas_udf("array<int>")
    def dealt(ids: pd.Series) -> pd.Series:
        """The range of an id; for the first id of a range also the range before, as -1 - range."""
        out = []
        for x in ids:
            x = int(x) if number and x is not None else x
            at = 0 if x is None else bisect_right(known, x) - 1 + missing
            lead = x is None if at == 0 and missing else x == known[at - missing]
            out.append([at, -1 - (at - 1) % len(first)] if lead else [at])
        return pd.Series(out)

    placed = (rows.select("doc_id", "text", F.explode(dealt(F.col("doc_id").cast("string"))).alias("to"))
              .select(F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("part"), (F.col("to") < 0).alias("guard"), "doc_id", "text"))
    order = ("part", "guard", "doc_id", "text")

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        held, at, over = None, None, False

        def made(text: str, own: PrefixHash, mark: str, following: str, next_mark: str) -> tuple:
            new = edited(text, following)
            changed = PrefixHash(new)
            new_mark = fingerprint(changed)
            return (len(text), sha256(new.encode("utf-8", "surrogatepass")), mark, new_mark, likeness(mark, new_mark), likeness(mark, next_mark),
                    own.extension(changed))

        for s in slices:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                     "near_edited", "near_next", "common_prefix")}
            for part, guard, doc_id, text in zip(*(s[k] for k in order), strict=True):
                if part != at:
                    held, at, over = None, part, False
                if over:
                    continue
                own = PrefixHash(text)
                mark = fingerprint(own)
                if held is not None:
                    for values, v in zip(out.values(), (held[0], *made(*held[1:], text, mark)), strict=True):
                        values.append(v)
                held, over = (doc_id, text, own, mark), guard
            yield out

    key = docs.schema["doc_id"].dataType.simpleString()
    sorted_rows = placed.repartitionById(max(1, len(first)), "part").sortWithinPartitions(*order)
    return per_partition(sorted_rows, f"doc_id {key}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                      "near_edited double, near_next double, common_prefix long", run)
