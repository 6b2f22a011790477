"""Fleet telemetry reports over collected snapshots (``instance, snapshot_ts, ...``) and log text.

Every report is per instance and snapshot. Shares of a total come from grouped totals
joined back, and top-n lists are cut by rank within tasks before they are shuffled, so an
instance with a large share of all rows is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.months import instant
from tallyline.session import scratch_dir

SNAPSHOT = ["instance", "snapshot_ts"]

# Limits of the health bands and the thresholds of the reports.
SLOW_STATEMENT_MS = 200
POOL_LIMIT = 90
CACHE_BANDS = ((99, "healthy"), (95, "acceptable"))
DEAD_ROW_BANDS = ((10, "healthy"), (20, "monitor"))
INDEX_SHARE_HEALTHY = 90
LAG_HEALTHY_MS, LAG_INVESTIGATE_MS = 1000, 5000
# A duration entry: time and zone, process, the connection's fields where the prefix has them, what was run and its text.
LOG_ENTRY = (
    r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d{1,6})?) (\S+) \[(\d+)\]: "
    r"(?:user=([^,]*),db=([^,]*),app=([^,]*),client=(\S*) )?"
    r"LOG:  duration: (\d+(?:\.\d+)?) ms(?:  ((?:statement|execute|bind|parse|fastpath function call)[^:\n]*): ((?s:.*)))?$"
)
# How any entry begins. What else stands in a log goes on with the entry before it.
ENTRY_START = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d{1,6})? \S+ \[\d+\]: "


def _two_decimals(value: Column) -> Column:
    return F.round(value.cast("decimal(30,10)"), 2).cast("decimal(18,2)")


def _percent(part: Column, whole: Column) -> Column:
    """Two-decimal percentage of whole numbers; NULL for an empty whole."""
    scaled = part.cast("decimal(28,0)") * 20000
    usable = F.when(whole > 0, whole).cast("decimal(20,0)")
    return (F.call_function("div", scaled + usable, usable * 2).cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def _top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*SNAPSHOT).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).withColumnRenamed("_rank", "rank")


def statement_top_total(stats: DataFrame, n: int = 10) -> DataFrame:
    """Statements by total time, with their share of the snapshot's total over all statements."""
    nanos = (F.col("total_exec_time").cast("decimal(20,6)") * 1_000_000).cast("decimal(28,0)")
    totals = stats.groupBy(*SNAPSHOT).agg(F.sum(nanos).alias("_all"))
    top = _top(stats, n, F.desc_nulls_first("total_exec_time"), F.asc_nulls_last("query"))
    return top.join(totals, SNAPSHOT).select(
        *SNAPSHOT, "rank", "query", "calls", _two_decimals(F.col("total_exec_time")).alias("total_ms"),
        _two_decimals(F.col("mean_exec_time")).alias("mean_ms"), _percent(nanos, F.col("_all")).alias("pct_of_total"),
    )


def statement_top_mean(stats: DataFrame, n: int = 10, min_calls: int = 50) -> DataFrame:
    """Statements called more than ``min_calls`` times, by mean time."""
    return _top(stats.where(F.col("calls") > min_calls), n, F.desc_nulls_first("mean_exec_time"), F.asc_nulls_last("query")).select(
        *SNAPSHOT, "rank", "query", "calls", _two_decimals(F.col("mean_exec_time")).alias("mean_ms"),
        _two_decimals(F.col("max_exec_time")).alias("max_ms"),
    )


def statement_top_spread(stats: DataFrame, n: int = 10, min_calls: int = 10) -> DataFrame:
    """Statements called more than ``min_calls`` times, by the gap between maximum and mean."""
    spread = stats.where(F.col("calls") > min_calls).withColumn(
        "variance_ms", _two_decimals(F.col("max_exec_time") - F.col("mean_exec_time")),
    )
    return _top(spread, n, F.desc_nulls_first("variance_ms"), F.asc_nulls_last("query")).select(
        *SNAPSHOT, "rank", "query", "calls", _two_decimals(F.col("mean_exec_time")).alias("mean_ms"),
        _two_decimals(F.col("max_exec_time")).alias("max_ms"), "variance_ms",
    )


def read_slow_log(spark: SparkSession, path: str) -> DataFrame:
    """Server log files as lines; ``instance`` is taken from a folder of that name, if any."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_log_entries(spark: SparkSession, path: str) -> DataFrame:
    """Duration entries of server log files, each whole as one ``line``, with those that go on over several lines.

    Lines are ordered by where Spark has split the file and by their place in that split, so a task sorts one split, never a file. The lines
    before a split's first entry belong to the last entry of an earlier one, which one small row a split tells. The result
    does not depend on how files are split. A tab that marks a line as continued goes; lines before a file's first entry belong
    to none. Other columns are those of folders, as in ``read_slow_log``.
    """
    lines = spark.read.text(path)
    kept = [c for c in lines.columns if c != "value"]
    split = ["_file", "_block"]
    start = F.col("value").rlike(ENTRY_START)
    placed = lines.select(
        *kept, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), start.alias("_start"), (start & F.col("value").contains("duration:")).alias("_timed"), "value")
    # Of other entries only that they begin matters.
    placed = placed.withColumn("value", F.when(~F.col("_start") | F.col("_timed"), F.col("value")))
    inside = Window.partitionBy(*split).orderBy("_at")
    entry = F.when(F.col("_start"), F.struct(F.col("_block").alias("block"), F.col("_at").alias("at"), F.col("_timed").alias("timed")))
    numbered = placed.withColumns({"_entry": F.last(entry, ignorenulls=True).over(inside), "_end": F.lead(F.lit(1)).over(inside).isNull()})
    # Written once: read again, a file might be split elsewhere. Lines of entries without a duration are left out here.
    stage = scratch_dir(spark, "log-entries")
    numbered.where(F.col("_entry").isNull() | F.col("_entry.timed") | F.col("_end")).drop("_start", "_timed").write.parquet(stage)
    numbered = spark.read.parquet(stage)
    ends = numbered.groupBy(*split).agg(F.max_by("_entry", "_at").alias("_last"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*split, F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    whole = numbered.join(carried, split).withColumn("_entry", F.coalesce("_entry", "_carried")).where("_entry.timed")
    text = F.when(F.col("_at") == F.col("_entry.at"), F.col("value")).otherwise(F.regexp_replace("value", "^\t", ""))
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_at", text.alias("text"))))
    return whole.groupBy(*kept, "_file", "_entry").agg(F.array_join(pieces["text"], "\n").alias("line")).select(*kept, "line")


def _matched(lines: DataFrame) -> tuple[DataFrame, list[str]]:
    """Lines that speak of a duration, with the parts of each as ``_fields``; other lengths mean no match.

    A plain substring test comes first, so the pattern only meets lines that can match, and
    each of those is matched once: its parts come out joined by a control character.
    """
    names = ["_time", "_zone", "pid", "user", "db", "app", "client", "duration_ms", "kind", "statement"]
    kept = [c for c in lines.columns if c != "line"]
    joined = F.regexp_replace("line", LOG_ENTRY, "\x01".join(f"${n}" for n in range(1, len(names) + 1)))
    # A one-row generator: filters and fields below see its result and do not match again.
    rows = lines.where(F.col("line").contains("duration:")).select(
        *kept, "line", F.explode(F.array(F.split(joined, "\x01", len(names)))).alias("_fields"))
    return rows, names


def parse_slow_log(lines: DataFrame, threshold_ms: float = SLOW_STATEMENT_MS) -> DataFrame:
    """Duration entries of a server log, one row each, slower than ``threshold_ms``.

    ``lines`` are single lines (``read_slow_log``), or whole entries (``read_log_entries``), whose statements may have several.
    ``kind`` is what was run: ``statement``, ``execute`` with the name of what was prepared, and so on; NULL, as is
    ``statement``, for an entry that gives the time only. Times are instants, whatever zone they are logged in. What
    else speaks of a duration is left to ``unparsed_durations``.
    """
    rows, names = _matched(lines)
    kept = [c for c in lines.columns if c != "line"]
    parsed = rows.where(F.size("_fields") == len(names)).select(
        *kept, *[F.nullif(F.col("_fields")[n], F.lit("")).alias(name) if name in ("kind", "statement") else F.col("_fields")[n].alias(name)
                 for n, name in enumerate(names)])
    at = F.concat_ws(" ", "_time", "_zone")
    typed = parsed.withColumns({
        "logged_at": F.coalesce(F.try_to_timestamp(at, F.lit("yyyy-MM-dd HH:mm:ss z")), F.try_to_timestamp(at, F.lit("yyyy-MM-dd HH:mm:ss.[SSSSSS][SSS][SS][S] z"))),
        "pid": F.col("pid").cast("int"), "duration_ms": F.col("duration_ms").cast("decimal(18,3)"),
    })
    return typed.where(F.col("duration_ms") > F.lit(threshold_ms)).select(
        *kept, "logged_at", "pid", "user", "db", "app", "client", "duration_ms", "kind", "statement")


def unparsed_durations(lines: DataFrame) -> DataFrame:
    """Lines that speak of a duration and fit no known form, each with how often it stands there."""
    rows, names = _matched(lines)
    return rows.where(F.size("_fields") != len(names)).groupBy("line").agg(F.count("*").alias("lines"))


def slowest_statements(lines: DataFrame, n: int = 20, threshold_ms: float = SLOW_STATEMENT_MS) -> DataFrame:
    """The ``n`` slowest logged statements, by the parsed duration."""
    return parse_slow_log(lines, threshold_ms).orderBy(
        F.desc_nulls_first("duration_ms"), F.asc_nulls_last("logged_at"), F.asc_nulls_last("pid"), F.asc_nulls_last("statement"),
    ).limit(n)


def _cache_status(ratio: Column) -> Column:
    (healthy, first), (acceptable, second) = CACHE_BANDS
    return (
        F.when(ratio.isNull(), "no reads").when(ratio > healthy, first).when(ratio >= acceptable, second)
        .otherwise("investigate")
    )


def cache_hit_ratio(table_io: DataFrame) -> DataFrame:
    """Share of block reads served from cache, with its health band."""
    summed = table_io.groupBy(*SNAPSHOT).agg(
        F.sum("heap_blks_hit").alias("cache_hits"), F.sum("heap_blks_read").alias("disk_reads"),
    )
    ratio = _percent(F.col("cache_hits"), F.col("cache_hits") + F.col("disk_reads"))
    return summed.withColumn("cache_hit_ratio", ratio).withColumn("status", _cache_status(F.col("cache_hit_ratio")))


def cache_hit_by_table(table_io: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` tables with most disk reads and their cache ratio."""
    hit, read = F.col("heap_blks_hit"), F.col("heap_blks_read")
    return _top(table_io, n, F.desc_nulls_first("heap_blks_read"), F.asc_nulls_last("relname")).select(
        *SNAPSHOT, "rank", "relname", "heap_blks_hit", "heap_blks_read",
        _percent(hit, hit + read).alias("cache_hit_ratio"),
    )


def index_usage(table_stats: DataFrame) -> DataFrame:
    """Share of a table's scans that used an index."""
    share = _percent(F.col("idx_scan"), F.col("seq_scan") + F.col("idx_scan"))
    return table_stats.select(
        *SNAPSHOT, "relname", "seq_scan", "idx_scan", share.alias("pct_via_index"),
        (share > INDEX_SHARE_HEALTHY).alias("healthy"),
    )


def unused_indexes(index_stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Indexes never scanned, largest first."""
    unused = index_stats.where(F.col("idx_scan") == 0).select(
        *SNAPSHOT, F.col("relname").alias("table_name"), F.col("indexrelname").alias("index_name"), "idx_scan",
        "index_bytes",
    )
    return unused.orderBy(F.desc_nulls_first("index_bytes"), *SNAPSHOT, "table_name", "index_name") if ordered else unused


def replication_health(replication: DataFrame) -> DataFrame:
    """Lag of each standby with its health band. NULL lag means no lag."""
    lag = F.coalesce("replay_lag_ms", F.lit(0))
    status = (
        F.when(F.col("state") != "streaming", "not streaming")
        .when(F.col("sync_state") != "sync", "not synchronous")
        .when(lag < LAG_HEALTHY_MS, "healthy")
        .when(lag <= LAG_INVESTIGATE_MS, "watch")
        .otherwise("investigate")
    )
    return replication.select(
        *SNAPSHOT, "application_name", "state", "sync_state", "write_lag_ms", "flush_lag_ms", "replay_lag_ms",
        (F.col("current_lsn") - F.col("replay_lsn")).alias("lag_bytes"), status.alias("status"),
    )


def retained_log(slots: DataFrame) -> DataFrame:
    """Log kept for each replication slot; at risk when its reader is away."""
    retained = F.col("current_lsn") - F.col("restart_lsn")
    return slots.select(
        *SNAPSHOT, "slot_name", "active", retained.alias("retained_bytes"),
        (~F.col("active") & (retained > 0)).alias("at_risk"),
    )


def sessions_by_state(sessions: DataFrame) -> DataFrame:
    """Number of sessions in each state."""
    return sessions.groupBy(*SNAPSHOT, "state").agg(F.count("*").alias("sessions"))


def idle_in_transaction(sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """Sessions that hold a transaction open without working, longest first."""
    idle = sessions.where(F.col("state") == "idle in transaction").select(
        *SNAPSHOT, "pid", "usename", "application_name", "state",
        (F.unix_micros("snapshot_ts") - F.unix_micros("state_change")).alias("idle_micros"), "query",
    )
    return idle.orderBy(F.desc_nulls_first("idle_micros"), *SNAPSHOT, "pid") if ordered else idle


def longest_statements(sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """Statements at work when the snapshot was taken, longest first."""
    active = sessions.where(F.col("state") == "active").select(
        *SNAPSHOT, "pid", (F.unix_micros("snapshot_ts") - F.unix_micros("query_start")).alias("running_micros"), "query",
    )
    return active.orderBy(F.desc_nulls_first("running_micros"), *SNAPSHOT, "pid") if ordered else active


def pool_pressure(sessions: DataFrame, limit: int = POOL_LIMIT) -> DataFrame:
    """Sessions in use against what the connection pool may open."""
    counted = sessions.groupBy(*SNAPSHOT).agg(F.count("*").alias("sessions"))
    return counted.select(*SNAPSHOT, "sessions", F.lit(limit).alias("pool_limit"), (F.col("sessions") > limit).alias("over_limit"))


def dead_rows(table_stats: DataFrame, prefix: str = "invoices") -> DataFrame:
    """Share of dead rows per ledger partition, with its health band."""
    share = _percent(F.col("n_dead_tup"), F.col("n_live_tup") + F.col("n_dead_tup"))
    (low, healthy), (high, monitor) = DEAD_ROW_BANDS
    status = (
        F.when(share.isNull() | (share < low), healthy).when(share <= high, monitor).otherwise("investigate")
    )
    return table_stats.where(F.col("relname").startswith(prefix)).select(
        *SNAPSHOT, "schemaname", "relname", "n_live_tup", "n_dead_tup", share.alias("pct_dead"), status.alias("status"),
        "last_autovacuum", "last_vacuum",
    )


def health_check(
    table_io: DataFrame, replication: DataFrame, sessions: DataFrame, table_stats: DataFrame, partition: str,
) -> DataFrame:
    """One row per instance and snapshot: cache ratio, worst replication lag, idle transactions
    and dead rows of the ledger partition ``partition``. All sides are grouped before they meet.
    """
    cache = cache_hit_ratio(table_io).select(*SNAPSHOT, "cache_hit_ratio")
    lag = replication_health(replication).groupBy(*SNAPSHOT).agg(
        F.max(F.coalesce("replay_lag_ms", F.lit(0))).alias("replay_lag_ms"),
        F.count_if(F.col("status") != "healthy").alias("unhealthy_standbys"),
    )
    idle = sessions.groupBy(*SNAPSHOT).agg(
        F.count_if(F.col("state") == "idle in transaction").alias("idle_in_transaction"),
    )
    dead = table_stats.where(F.col("relname") == partition).groupBy(*SNAPSHOT).agg(
        F.sum("n_live_tup").alias("n_live_tup"), F.sum("n_dead_tup").alias("n_dead_tup"),
    )
    return cache.join(lag, SNAPSHOT, "full").join(idle, SNAPSHOT, "full").join(dead, SNAPSHOT, "full")


def latest_snapshot(stats: DataFrame, as_of: object | None = None) -> DataFrame:
    """Rows of each instance's newest snapshot not after ``as_of``."""
    newest = stats.where(F.col("snapshot_ts") <= instant(as_of)).groupBy("instance").agg(
        F.max("snapshot_ts").alias("snapshot_ts"),
    )
    return stats.join(newest, SNAPSHOT)
