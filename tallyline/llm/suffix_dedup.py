"""Operator 2, exact substring dedup by merging shard Burrows-Wheeler transforms.

The suffixes looked at start at anchors: positions at which an 8-byte gram has the least hash in
some stretch of ``REACH`` positions. A stretch lies inside any repeated string, so that its
anchor is the same in all copies, at most ``REACH`` - 1 bytes from their beginnings.

1. Every text gives its anchors with three hashes: of the ``LENGTH`` - ``REACH`` + 1 bytes after the
   anchor, which all copies share (``key``), of the ``LENGTH`` bytes after it (``right``) and of the
   ``REACH`` - 1 bytes before it (``left``). Sorted by these, neighbours tell whether an anchor's key
   repeats, whether its right side does (then those bytes go), and whether both sides do
   (then all of its window goes). Hashes have 64 bits.
2. What is then undecided lies at the edges of repeated strings. There the bytes themselves are
   fetched. Each task holds shards of suffixes, in suffix order within a shard, with what stands
   before them: the shards' transforms, the preceding text being the transform's column. They
   are merged by sorting by their bytes, eight at a time and only inside intervals that are still
   repeated, not through the transforms' mapping; where an interval splits, its depth is the common prefix. Reading the column
   backwards refines it in the same way. A window repeats when another suffix falls into the same
   interval on both sides.
3. Covered stretches are joined with the texts and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import per_slice, saved, sha256, texts

LENGTH = 400
REACH = 120
GRAM = 8
#: Text bytes whose anchors are found at once.
PIECE = 8 << 20
#: Share of the texts looked at for very frequent keys, and how often such a key occurs among them.
SAMPLE, FREQUENT, KEYS = 0.01, 200, 10_000
#: Suffixes merged at once; a larger group is dealt by more of its bytes.
MERGED, SPLIT, PARTS = 8_192, 4_096, 4

_MIX = np.uint64(0x9E3779B97F4A7C15)


def anchors(raw: bytes, length: int = LENGTH, reach: int = REACH) -> np.ndarray:
    """Positions of the anchors of one text, ascending, that have a whole key after them."""
    n, found = len(raw), []
    if n < length:
        return np.empty(0, np.int64)
    for start in range(0, n, PIECE):
        b = np.frombuffer(raw, np.uint8, min(n - start, PIECE + reach + GRAM), start)
        if len(b) < reach + GRAM - 1:
            break
        grams = np.zeros(len(b) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            grams |= b[k:k + len(grams)].astype(np.uint64) << np.uint64(8 * k)
        grams = (grams ^ (grams >> np.uint64(29))) * _MIX
        # The hash above, the position below: of equal hashes the leftmost is least.
        least = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while 2 * span <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: len(least) - (reach - span)], least[reach - span:])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64) + start
        found.append(at[np.concatenate([[True], at[1:] != at[:-1]])])
    at = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return at[at + length - reach + 1 <= n]


def _hash(data: memoryview, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(data, seed=seed) - (1 << 63)


def _anchor_rows(r: dict, length: int, reach: int) -> dict:
    out: dict[str, list] = {k: [] for k in ("row", "at", "key", "right", "left", "cut")}
    for row, text in zip(r["row"], r["text"], strict=True):
        raw = text.encode("utf-8", "surrogatepass")
        view, at = memoryview(raw), anchors(raw, length, reach).tolist()
        out["row"] += [row] * len(at)
        out["at"] += at
        out["key"] += [_hash(view[a:a + length - reach + 1]) for a in at]
        out["right"] += [_hash(view[a:a + length]) for a in at]
        out["left"] += [_hash(view[max(0, a - reach + 1):a]) for a in at]
        out["cut"] += [a + length > len(raw) for a in at]
    return out


_ANCHOR = "row long, at long, key long, right long, left long, cut boolean"


def _flags(batches: Iterator[pa.RecordBatch], frequent: dict[str, set[int]]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, right, left) whose key repeats, with whether the sides do, too."""
    names = ("row", "at", "key", "right", "left")
    arrow = pa.schema([pa.field(n, pa.int64()) for n in names] + [pa.field(n, pa.bool_()) for n in ("long", "full")])
    known = {k: np.array(sorted(v), np.int64) for k, v in frequent.items()}

    def marked(rows: dict[str, np.ndarray], before: tuple | None, after: tuple | None) -> pa.RecordBatch:
        same, flags = None, []
        for k, name in enumerate(("key", "right", "left")):
            x = rows[name]
            eq = x[1:] == x[:-1]
            same = eq if same is None else same & eq
            flag = np.zeros(len(x), bool)
            flag[1:] |= same
            flag[:-1] |= same
            flag[0] |= before is not None and all(before[i] == rows[n][0] for i, n in enumerate(("key", "right", "left")[:k + 1]))
            flag[-1] |= after is not None and all(after[i] == rows[n][-1] for i, n in enumerate(("key", "right", "left")[:k + 1]))
            flags.append(flag)
        repeated, long, full = flags
        repeated |= np.isin(rows["key"], known["key"])
        long |= np.isin(rows["right"], known["right"])
        full |= long & np.isin(rows["left"] ^ rows["right"], known["both"])
        keep = repeated | long | full
        long &= ~rows["cut"]  # equal, but shorter than what counts
        return pa.RecordBatch.from_arrays([pa.array(rows[n][keep]) for n in names] + [pa.array(long[keep]), pa.array(full[keep])], schema=arrow)

    held, before = None, None
    for b in batches:
        if not b.num_rows:
            continue
        rows = {n: b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in (*names, "cut")}
        if held is not None:
            yield marked(held, before, tuple(rows[n][0] for n in ("key", "right", "left")))
            before = tuple(held[n][-1] for n in ("key", "right", "left"))
        held = rows
    if held is not None:
        yield marked(held, before, None)


def interleave(symbols: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted shards: the common order of all rows, and each row's common prefix with the one before.

    ``symbols``: one row of bytes for each suffix. ``block``: the interval each starts in. Each
    round looks at eight bytes of the rows whose interval still holds several, and places
    them inside it; a stable sort leaves each shard's own order alone, so that rounds only interleave.
    """
    n, width = symbols.shape
    words = np.ascontiguousarray(symbols).view(">u8")
    order = np.argsort(block, kind="stable")
    block = block[order]
    first = np.concatenate([[True], block[1:] != block[:-1]])
    common = np.where(first, 0, width).astype(np.int32)
    interval = np.cumsum(first)
    for k in range(words.shape[1]):
        size = np.bincount(interval, minlength=interval[-1] + 1)
        live = np.flatnonzero(size[interval] > 1)
        if not len(live):
            break
        word = words[order[live], k].astype(np.uint64)
        by = np.lexsort((word, interval[live]))
        order[live], word, at = order[live][by], word[by], interval[live]
        splits = np.flatnonzero((word[1:] != word[:-1]) & (at[1:] == at[:-1])) + 1
        if len(splits):
            differ = word[splits] ^ word[splits - 1]
            zeros = np.zeros(len(splits), np.int32)
            for byte in range(7, 0, -1):  # equal leading bytes of the two words
                zeros += (differ >> np.uint64(8 * byte) == 0).astype(np.int32)
            common[live[splits]] = 8 * k + zeros
            first[live[splits]] = True
            interval = np.cumsum(first)
    return order, common


def repeated_offsets(left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, block: np.ndarray,
                     length: int = LENGTH, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, the least and the greatest number of bytes before it at which a repeated window starts; -1 if none.

    ``left`` is the text before each suffix, read backwards. Windows between the two are covered anyway.
    """
    n = len(block)
    low, high = np.full(n, -1), np.full(n, -1)
    orders = []
    for symbols in (left, right):
        order, common = interleave(symbols, block)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        group = block[order]
        common[np.concatenate([[True], group[1:] != group[:-1]])] = -1  # groups share nothing
        orders.append((back, common))
    for o in range(reach):
        valid = np.flatnonzero((n_left >= o) & (n_right >= length - o))
        if len(valid) < 2:
            continue
        side = []
        for (back, common), depth in zip(orders, (o, length - o), strict=True):
            side.append(np.cumsum(common < depth)[back[valid]])
        pair = side[0].astype(np.int64) * (n + 1) + side[1]
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        hit = valid[count[inverse] > 1]
        low[hit] = np.where(low[hit] < 0, o, low[hit])
        high[hit] = o
    return low, high


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width)


def _edges(batches: Iterator[pa.RecordBatch], length: int, reach: int) -> Iterator[pa.RecordBatch]:
    """Merge the shards of each group of suffixes; groups stream by, many at a time."""
    arrow = pa.schema([pa.field(n, pa.int64()) for n in ("row", "low", "high")])
    width = -(-reach // 8) * 8
    long = -(-length // 8) * 8

    def done(rows: dict[str, list]) -> pa.RecordBatch:
        _, block = np.unique(np.array(rows["unit"], np.int64), return_inverse=True)
        before = [x[::-1] for x in rows["before"]]
        n_left, n_right = (np.array([len(x) for x in rows[k]]) for k in ("before", "after"))
        low, high = repeated_offsets(_padded(before, width), n_left, _padded(rows["after"], long), n_right, block, length, reach)
        at = np.array(rows["at"])
        hit = np.flatnonzero(high >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(rows["row"], np.int64)[hit]), pa.array(at[hit] - high[hit]), pa.array(at[hit] - low[hit] + length)], schema=arrow)

    names = ("unit", "row", "at", "before", "after")
    held: dict[str, list] = {n: [] for n in names}
    for b in batches:
        d = b.to_pydict()
        for n in names:
            held[n] += d[n]
        if len(held["unit"]) >= MERGED:
            cut = len(held["unit"])
            last = held["unit"][-1]
            while cut and held["unit"][cut - 1] == last:  # the last group may go on
                cut -= 1
            if cut:
                yield done({n: held[n][:cut] for n in names})
                held = {n: held[n][cut:] for n in names}
    if held["unit"]:
        yield done(held)


def _frequent(rows: DataFrame, length: int, reach: int, share: float, times: int) -> dict[str, set[int]]:
    """Hashes that a sample of texts shows to be very frequent: at most KEYS in all.

    They are known to repeat. Their rows need not meet, so they are dealt by more of their bytes.
    """
    part = rows.where(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(10_000)) < int(10_000 * share))
    found = per_slice(part, _ANCHOR, lambda r: _anchor_rows(r, length, reach))
    kinds = {"key": F.col("key"), "right": F.col("right"), "both": F.col("left").bitwiseXOR(F.col("right"))}
    names = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("h")) for k, v in kinds.items()])).alias("x")
    top = (found.select(names).groupBy("x.kind", "x.h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)
           .orderBy(F.desc("n"), "h").limit(KEYS))
    made: dict[str, set[int]] = {k: set() for k in kinds}
    for r in top.collect():
        made[r.kind].add(r.h)
    return made


def _packed(rows: DataFrame, names: list[str]) -> DataFrame:
    """Texts as compressed bytes, so that the shuffles to come carry less than half."""
    def pack(r: dict) -> dict:
        press = zstandard.ZstdCompressor(level=3)
        return {**{n: r[n] for n in names}, "packed": [press.compress(t.encode("utf-8", "surrogatepass")) for t in r["text"]]}

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return per_slice(rows.select(*names, "text"), ", ".join(f"{n} {kinds[n]}" for n in names) + ", packed binary", pack, rows=128)


@cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _unpacked(packed: bytes) -> bytes:
    return _decompressor().decompress(packed)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): rows get a key of their id and text, which repeated rows share."""
    return texts(docs).withColumn("row", F.xxhash64("doc_id", "text"))


def _anchored(rows: DataFrame, length: int, reach: int, share: float, times: int) -> DataFrame:
    """Anchors whose key repeats: (row, at, key, right, left, long, full)."""
    frequent = rows.sparkSession.sparkContext.broadcast(_frequent(rows, length, reach, share, times))

    def deal(r: dict) -> dict:
        """By key; a key known to be frequent goes by the right side, that by both sides, and these by row."""
        out, known = _anchor_rows(r, length, reach), frequent.value
        out["deal"] = [
            key if key not in known["key"] else right if right not in known["right"] else left ^ right if left ^ right not in known["both"] else row
            for row, key, right, left in zip(out["row"], out["key"], out["right"], out["left"], strict=True)]
        return out

    found = per_slice(rows, f"{_ANCHOR}, deal long", deal, rows=128)
    return (found.repartition("deal").drop("deal")
            .sortWithinPartitions("key", "right", "left")
            .mapInArrow(lambda it: _flags(it, frequent.value), "row long, at long, key long, right long, left long, long boolean, full boolean"))


def _with_points(rows: DataFrame, contexts: DataFrame, columns: list[str]) -> DataFrame:
    """(row, packed, points): the texts that have any of the contexts, with these as an array."""
    points = contexts.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("points"))
    return _packed(rows, ["row"]).join(points, "row")


def _parted(rows: DataFrame, contexts: DataFrame, length: int, reach: int) -> DataFrame:
    """Contexts of very large groups, dealt by more of their bytes: (unit, span, row, at, low, high, begin, end).

    Windows that start between ``low`` and ``high`` bytes before an anchor have all but some thirty bytes in common,
    whose hash is their new group, with the distance: in a periodic text the bytes of several distances are the same, and a context that met
    itself would count as repeated. Contexts alone in theirs are done. ``span`` is the hash of all bytes that these
    windows hold, from ``begin`` to ``end``, and of where among them the anchor stands: of contexts of one span every window repeats.
    """
    step = -(-reach // PARTS)

    def part(r: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("unit", "span", "row", "at", "low", "high", "begin", "end")}
        for row, packed, points in zip(r["row"], r["packed"], r["points"], strict=True):
            raw = memoryview(_unpacked(packed))
            for p in points:
                for low in range(0, reach, step):
                    high = min(low + step, reach) - 1
                    a = p["at"]
                    if a >= low and a - high + length <= len(raw):
                        begin, end = max(0, a - high), min(a - low + length, len(raw))
                        span = _hash(raw[begin:end], a - begin)
                        for k, v in zip(out, (_hash(raw[a - low:a - high + length], low), span, row, a, low, high, begin, end), strict=True):
                            out[k].append(v)
        return out

    found = per_slice(_with_points(rows, contexts, ["at"]), "unit long, span long, row long, at long, low int, high int, begin long, end long", part, rows=128)
    return saved(found, "parts")


def _fetched(rows: DataFrame, contexts: DataFrame, length: int, reach: int) -> DataFrame:
    """The shards' transforms: (shard, rank, unit, row, at, before, after), ranks in suffix order within a unit.

    Of contexts marked ``split`` come the hashes of their windows instead: (unit, row, at) without bytes.
    """
    names = ("unit", "row", "at", "before", "after")

    def fetch(r: dict) -> dict:
        found: list[tuple] = []
        for row, packed, points in zip(r["row"], r["packed"], r["points"], strict=True):
            raw = memoryview(_unpacked(packed))
            for p in points:
                a = p["at"]
                if p["split"]:
                    starts = range(max(0, a - p["high"]), min(a - p["low"], len(raw) - length) + 1)
                    found += [(_hash(raw[x:x + length]), row, x, None, None) for x in starts]
                else:
                    found.append((p["unit"], row, a, bytes(raw[max(0, a - reach + 1):a]), bytes(raw[a:a + length])))
        found.sort(key=lambda x: (x[0], x[4] or b""))
        columns = zip(*found, strict=True) if found else ((),) * 5
        shard = r["row"][0] if r["row"] else 0
        return {"shard": [shard] * len(found), "rank": list(range(len(found))), **dict(zip(names, map(list, columns), strict=True))}

    joined = _with_points(rows, contexts, ["at", "unit", "low", "high", "split"])
    return per_slice(joined, "shard long, rank int, unit long, row long, at long, before binary, after binary", fetch, rows=128)


def covered(rows: DataFrame, length: int = LENGTH, reach: int = REACH, share: float = SAMPLE, times: int = FREQUENT) -> DataFrame:
    """(row, low, high): stretches of bytes that repeated strings cover, of ``keyed`` documents.

    Stretches may overlap, and reach beyond a text's end.
    """
    rows = rows.where(F.octet_length("text") >= length).select("row", "text")
    flagged = saved(_anchored(rows, length, reach, share, times), "anchors")

    # What hashes decide: the stretch of a right side, or of a whole window, that repeats.
    low = F.when(F.col("full"), F.greatest(F.col("at") - (reach - 1), F.lit(0))).when(F.col("long"), F.col("at"))
    w = Window.partitionBy("row").orderBy("at")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    placed = (flagged.withColumn("low", low).withColumn("high", F.when(F.col("low").isNotNull(), F.col("at") + length))
              .withColumn("reached", F.max("high").over(before))
              .withColumn("begins", F.when(F.col("low").isNotNull() & (F.col("reached").isNull() | (F.col("low") > F.col("reached"))), F.col("low")))
              .withColumn("island", F.last("begins", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    # Left open is an anchor unless all bytes of all its windows are decided.
    behind = F.greatest(F.col("at") - (reach - 1), F.lit(0))
    placed = saved(placed.withColumn("open", ~F.col("full") & ~(F.col("long") & (F.col("island") <= behind)))
                   .select("row", "at", "key", "right", "left", "low", "high", "open"), "stretches")

    # Every context of a group with something open, once; very large groups are dealt again, by more of their bytes.
    contexts = saved(placed.join(placed.where("open").select("key").distinct(), "key", "left_semi").dropDuplicates(["key", "right", "left"])
                     .select("row", "at", F.col("key").alias("unit")), "contexts")
    members = contexts.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    counted = contexts.join(members, "unit")
    small = counted.where(F.col("n") <= SPLIT).select("row", "at", "unit", F.lit(0).alias("low"), F.lit(reach - 1).alias("high"), F.lit(False).alias("split"))
    parts = _parted(rows, counted.where(F.col("n") > SPLIT), length, reach)
    # Of contexts with the same bytes in all windows of a part one goes on, for the others of the group to be held against.
    spans = saved(parts.groupBy("unit", "span").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "at", "low", "high")).alias("first")), "spans")
    by_span = (parts.join(spans.where("n > 1").select("unit", "span"), ["unit", "span"], "left_semi")
               .select("row", F.col("begin").alias("low"), F.col("end").alias("high")))
    ones = spans.select("unit", "first.*")
    shared = ones.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    large = ones.join(shared, "unit").select("row", "at", "unit", "low", "high", (F.col("n") > SPLIT).alias("split"))
    fetched = saved(_fetched(rows, small.unionByName(large), length, reach), "suffixes")
    windows = fetched.where("after is null").select("unit", "row", "at").distinct()
    twice = windows.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    by_hash = windows.join(twice, "unit", "left_semi").select("row", F.col("at").alias("low"), (F.col("at") + length).alias("high"))
    by_merge = (fetched.where("after is not null").repartition("unit").sortWithinPartitions("unit", "shard", "rank")
                .mapInArrow(lambda it: _edges(it, length, reach), "row long, low long, high long"))
    return placed.where("low is not null").select("row", "low", "high").unionByName(by_span).unionByName(by_hash).unionByName(by_merge)


def without_repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH, keep_bytes: bool = False, share: float = SAMPLE,
                    times: int = FREQUENT) -> DataFrame:
    """Every whole text without the bytes that a string of ``length`` bytes covers which also starts elsewhere.

    One row for each row of ``docs``, repeated ids included: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and, with ``keep_bytes``, spans and the kept bytes, which need not be valid UTF-8.
    Null and empty texts have no bytes; a repeated row repeats all of its text. Columns other than doc_id and text are ignored.
    """
    rows = keyed(docs)
    spans = covered(rows, length, reach, share, times).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def cut(r: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
        for doc_id, packed, spans in zip(r["doc_id"], r["packed"], r["spans"], strict=True):
            raw, runs = _unpacked(packed), []
            for a, b in sorted((s["low"], min(s["high"], len(raw))) for s in spans or ()):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            ends = [0, *(x for run in runs for x in run), len(raw)]
            kept = b"".join(raw[ends[k]:ends[k + 1]] for k in range(0, len(ends), 2))
            for k, v in zip(out, (doc_id, len(raw), len(raw) - len(kept), len(runs), sha256(kept), [f"{a}:{b}" for a, b in runs], kept), strict=True):
                out[k].append(v)
        if not keep_bytes:
            del out["spans"], out["kept"]
        return out

    key = docs.schema["doc_id"].dataType.simpleString()
    extra = ", spans array<string>, kept binary" if keep_bytes else ""
    joined = _packed(rows, ["row", "doc_id"]).join(spans, "row", "left")
    return per_slice(joined, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}", cut, rows=128)
