"""Operator 4, BPE encoding and decoding over a table of distinct words.

Words are what stands between spaces, tabs and line ends. The tokenizer at hand drops white
space and never joins across it, so a text's ids are its words' ids in order of position.

``word_table`` counts words over all documents in Spark and encodes each frequent one once;
its most frequent ``head`` words (a bound on rows and, by ``HEAD_CHARS``, on bytes) go to all
workers. ``encode`` splits every text again and looks ids up in order of position. A word outside
that table is encoded where it is met, once for each task that meets it: sending each of its
positions through two shuffles is estimated, not measured, at several times the input in disk.
Decoding looks each id up in the vocabulary's id-to-piece table, whose size the vocabulary
bounds; ``decode`` does the same as a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import per_partition, per_slice, sha256, texts, tokenizer

#: Words in the broadcast table, and the longest of them, in characters: at most about 40 MB.
HEAD = 200_000
HEAD_CHARS = 48
#: Words a task holds before it passes its counts, and words outside the table before it forgets its own encodings: few of these recur.
HELD, RARE = 300_000, 50_000
#: Words the tokenizer encodes at once, each of which takes about a kilobyte then, and texts split into words at once.
AT_ONCE = 1_000
TEXTS = 64


def split_words(text: str) -> list[str]:
    """Pieces between spaces, tabs and line ends; empty ones are kept and encode to nothing."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents: counted inside tasks first, so hot words arrive as one row a task.

    A task leaves out what it met once between two flushes; such words never reach the head.
    """
    def count(slices: Iterator[dict]) -> Iterator[dict]:
        held: Counter[str] = Counter()

        def flush() -> dict:
            kept = [(w, n) for w, n in held.items() if n > 1 and 0 < len(w) <= HEAD_CHARS]
            held.clear()
            return {"word": [w for w, _ in kept], "n": [n for _, n in kept]}

        for rows in slices:
            for text in rows["text"]:
                held.update(split_words(text))
            if len(held) > HELD:
                yield flush()
        yield flush()

    return per_partition(texts(docs).select("text"), "word string, n long", count).groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, path: str, head: int = HEAD) -> DataFrame:
    """(word, ids) of the most frequent words, each encoded once."""
    top = word_counts(docs).orderBy(F.desc("n"), "word").limit(head).select("word")

    def encode(rows: dict) -> dict:
        made = tokenizer(path).encode_batch_fast(rows["word"], add_special_tokens=False)
        return {"word": rows["word"], "ids": [x.ids for x in made]}

    parts = docs.sparkSession.sparkContext.defaultParallelism
    return per_slice(top.repartition(parts), "word string, ids array<int>", encode, rows=AT_ONCE)


def vocabulary(spark, path: str) -> DataFrame:
    """The id-to-piece table of a tokenizer file, added tokens included."""
    pieces = sorted((i, piece) for piece, i in tokenizer(path).get_vocab(with_added_tokens=True).items())
    return spark.createDataFrame(pieces, "id int, piece string")


def _packed(ids: list[int]) -> bytes:
    """Ids as four bytes each: a fourth of what they take as a tuple of numbers, and joined without a look at each."""
    return np.array(ids, np.int32).tobytes()


def _words(path: str, head: dict[str, bytes]):
    """A lookup from words to their packed ids: those of the table, and rare ones as they are met."""
    rare: dict[str, bytes] = {}

    def look(words: set[str]) -> dict[str, bytes]:
        if len(rare) > RARE:
            rare.clear()
        found = {w: head[w] for w in words if w in head}
        rest = [w for w in words if w not in found]
        new = [w for w in rest if w not in rare]
        for k in range(0, len(new), AT_ONCE):
            some = new[k:k + AT_ONCE]
            encoded = tokenizer(path).encode_batch_fast(some, add_special_tokens=False)
            rare.update((w, _packed(x.ids)) for w, x in zip(some, encoded, strict=True))
        found.update((w, rare[w]) for w in rest)
        return found

    return look


def encode(docs: DataFrame, path: str, head: int = HEAD, keep_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text; one row a document, repeated rows included.

    Returns doc_id, n_tokens, ids_sha256 (decimal ids joined by one space), decoded_sha256 and,
    with ``keep_ids``, ids and decoded themselves. A null or empty text gives no tokens. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    top = {r.word: _packed(r.ids) for r in word_table(docs, path, head).toLocalIterator()}
    table = spark.sparkContext.broadcast((top, {r.id: r.piece for r in vocabulary(spark, path).toLocalIterator()}))
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        top, pieces = table.value
        look, numbers = _words(path, top), {i: str(i) for i in pieces}
        for rows in slices:
            split = [split_words(t) for t in rows["text"]]
            known = look(set().union(*split))
            out: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
            for words in split:
                found = np.frombuffer(b"".join([known[w] for w in words]), np.int32)
                ids = found.tolist()
                decoded = " ".join([pieces[i] for i in ids])
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha256(" ".join([numbers[i] for i in ids]).encode()))
                out["decoded_sha256"].append(sha256(decoded.encode()))
                if keep_ids:
                    out["ids"].append(found)
                    out["decoded"].append(decoded)
            if not keep_ids:
                del out["ids"], out["decoded"]
            yield {"doc_id": rows["doc_id"], **out}

    key = docs.schema["doc_id"].dataType.simpleString()
    return per_partition(texts(docs), f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}", run, rows=TEXTS)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Text of id lists: (doc_id, ids) to (doc_id, decoded), through a join with the id-to-piece table.

    Pieces are joined by one space, as a tokenizer without a decoder of its own does. Equal
    doc_ids stay separate rows; a null or empty list gives an empty text.
    """
    rows = encoded.select("doc_id", "ids", F.monotonically_increasing_id().alias("row"))
    pieces = F.broadcast(vocabulary(encoded.sparkSession, path))
    placed = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id")).join(pieces, "id", "left")
    joined = F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("at", "piece"))))
    return (placed.groupBy("row", "doc_id").agg(joined.alias("p"))
            .select("doc_id", F.array_join(F.transform("p", lambda x: x["piece"]), " ").alias("decoded")))
