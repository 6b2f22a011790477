"""Line dedup: lines that stand in many documents leave all of them.

Lines are known by 128 bits of their key. Documents come in batches. Each batch counts the documents of its keys,
leaves out what earlier runs have settled by a merge anti-join, and adds the rest as a run of its own. Runs are
tables bucketed and sorted by key, so neither that join nor their compaction, level by level, shuffles a run again.
Only DataFrame functions are used.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import saved, texts
from tallyline.session import scratch_dir
from tallyline.sources.lake import delete_path

#: Documents that must hold a line for it to go.
DOCUMENTS = 10
#: Parts in which the documents of one call come to the runs.
BATCHES = 8
#: Stripped from both ends of a line.
BLANK = " \t\n\x0b\x0c\r"
KEY = ["k1", "k2"]


def _hashes(value: Column) -> list[Column]:
    """128 bits of a text, as two whole numbers."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def line_keys(text: Column) -> Column:
    """The keys of a text's lines in order, hashed; NULL for a line of white space only."""
    # The quick form is the same for a text of one-byte characters.
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))

    def key(line: Column) -> Column:
        bare = F.btrim(line, F.lit(BLANK))
        return F.when(bare != "", F.struct(*[h.alias(k) for h, k in zip(_hashes(bare), KEY, strict=True)]))

    return F.transform(F.split(folded, "\n"), key)


def _once(keys: Column) -> Column:
    """Every key of a document once: sorted, equal neighbours left out."""
    ordered = F.array_compact(F.sort_array(keys))
    return F.explode(F.array(ordered)).alias("_sorted")


class LineRuns:
    """Levelled sorted runs of line keys and the number of documents that hold them.

    ``add`` takes a batch, ``frequent`` reads the outcome, ``drop`` removes the runs. Two runs of a level become one of the next. A key that some run shows to
    have reached ``least`` is settled: later batches leave it out. Counts of a key are otherwise spread
    over runs, and add up.
    """

    def __init__(self, spark: SparkSession, least: int = DOCUMENTS) -> None:
        self.spark, self.least = spark, least
        self.root = scratch_dir(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: Name and level of each run, the newest last. No two neighbours are of one level for long.
        self.runs: list[tuple[str, int]] = []

    def add(self, keys: DataFrame) -> None:
        """``keys`` has one row (k1, k2) for each document of the batch and key in it."""
        counts = keys.groupBy(*KEY).agg(F.count("*").alias("docs"))
        for name, _ in self.runs:
            # An outer join and a test: Catalyst would move an anti-join below the counts, and shuffle every line.
            known = self.spark.table(name).where(F.col("docs") >= self.least)
            settled = known.select(*KEY, F.lit(True).alias("_settled")).hint("merge")
            counts = counts.join(settled, KEY, "left").where("_settled IS NULL").drop("_settled")
        self._write(counts, 0)
        while len(self.runs) > 1 and self.runs[-1][1] == self.runs[-2][1]:
            self._compact()

    def frequent(self) -> DataFrame:
        """(k1, k2) of the keys that ``least`` documents hold."""
        while len(self.runs) > 1:
            self._compact()
        total = self.spark.table(self.runs[0][0])
        return saved(total.where(F.col("docs") >= self.least).select(*KEY), "frequent-lines")

    def drop(self) -> None:
        for name, _ in self.runs:
            self._forget(name)
        self.runs = []

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        counts.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.root}/{name}").saveAsTable(name)
        self.runs.append((name, level))

    def _compact(self) -> None:
        """The two newest runs become one of the next level: a merge of sorted buckets."""
        (old, level), (new, _) = self.runs[-2:]
        self.runs = self.runs[:-2]
        left, right = self.spark.table(old), self.spark.table(new).withColumnRenamed("docs", "more")
        docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
        self._write(left.hint("merge").join(right, KEY, "full").select(*KEY, docs.alias("docs")), level + 1)
        self._forget(old)
        self._forget(new)

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        delete_path(self.spark, f"{self.root}/{name}")


def _keyed(docs: DataFrame, batches: int) -> DataFrame:
    """(t1, t2, keys, batch) of every row: the hash of its text, the keys of its lines, the batch it comes in."""
    path = scratch_dir(docs.sparkSession, "line-keys")
    keyed = texts(docs).select(
        *[h.alias(t) for h, t in zip(_hashes(F.col("text")), ("t1", "t2"), strict=True)], line_keys(F.col("text")).alias("keys"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
    )
    keyed.write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(keyed.schema).parquet(path)


def _frequent(keyed: DataFrame, least: int, batches: int) -> DataFrame:
    runs = LineRuns(keyed.sparkSession, least)
    for batch in range(batches):
        ordered = keyed.where(F.col("batch") == batch).select(_once(F.col("keys")))
        once = F.filter("_sorted", lambda k, n: (n == 0) | (k != F.col("_sorted")[n - 1]))
        runs.add(ordered.select(F.inline(once)))
    found = runs.frequent()
    runs.drop()
    return found


def without_common_lines(docs: DataFrame, least: int = DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """Every row of ``docs`` without the lines that ``least`` documents hold.

    A line's key is the line without white space at its ends, A-Z lower-cased; lines without a key always stay.
    Returns doc_id, n_lines (before), n_dropped, kept_sha256 and kept, the text of the other lines. A null
    text counts as an empty one, which is one empty line. Every row is a document of its own, repeated rows and rows without
    an id as well. An empty table gives no rows; other columns, even of equal names, are ignored.
    """
    keyed = _keyed(docs, batches)
    frequent = _frequent(keyed, least, batches)
    # What goes depends on the text alone, so copies are looked at once and rows need no identity.
    lines = keyed.groupBy("t1", "t2").agg(F.first("keys").alias("keys")).select("t1", "t2", F.posexplode("keys").alias("at", "key"))
    gone = (
        lines.where("key IS NOT NULL").select("t1", "t2", "at", "key.*").join(frequent, KEY)
        .groupBy("t1", "t2").agg(F.sort_array(F.collect_list("at")).alias("gone"))
    )
    rows = texts(docs).withColumns(dict(zip(("t1", "t2"), _hashes(F.col("text")), strict=True)))
    # A one-row generator, so that the text is split once and not for each stretch that stays.
    split = rows.join(gone, ["t1", "t2"], "left").select(
        "doc_id", "text", "gone", F.explode(F.array(F.split("text", "\n"))).alias("_lines"))
    begin = F.concat(F.array(F.lit(0)), F.transform("gone", lambda at: at + 1))
    end = F.concat("gone", F.array(F.size("_lines")))
    stretches = F.transform(
        F.arrays_zip(begin.alias("begin"), end.alias("end")),
        lambda s: F.slice("_lines", s["begin"] + 1, s["end"] - s["begin"]))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(stretches), "\n"))
    return split.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"),
    ).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "kept")
