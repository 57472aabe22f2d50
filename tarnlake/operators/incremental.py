"""Extraction windows, watermark state, sync planning, backfill chunks and capped reads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage
from tarnlake.sources.keyed_layer import KeyedLayer

# Defaults of windows, sync planning and backfill.
OVERLAP_HOURS = 2
GAP_HOURS = 6
WINDOW_DAYS = 1
EPOCH = datetime(1970, 1, 1)
ROWS_PER_SECOND = 500.0
CHUNK_SECONDS = 600.0
MIN_CHUNK_DAYS = 1
MAX_CHUNK_DAYS = 90
MAX_CHUNKS = 2_000

ENTITY_KEY = ["source_id", "connection_id", "entity_id"]


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n)


def _days(n: Column) -> Column:
    return F.make_dt_interval(n)


def current_watermarks(state: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Latest version of every entity in the append-only state table."""
    key = key or ENTITY_KEY
    rest = [c for c in state.columns if c not in key]
    latest = state.groupBy(*key).agg(F.max_by(F.struct(*rest), "version").alias("s"))
    return latest.select(*key, "s.*")


def extraction_windows(
    configs: DataFrame, state: DataFrame, now: datetime, key: list[str] | None = None
) -> DataFrame:
    """Half-open window of every configured entity.

    ``configs`` adds ``load_type``, ``overlap_hours`` and ``window_days`` to the entity key.
    Incremental loads start at the last watermark less the overlap, or at the epoch on the first
    run; full loads carry the configured number of days for the record.
    """
    key = key or ENTITY_KEY
    marks = current_watermarks(state, key).select(*key, "last_watermark")
    upper = _ntz(now)
    last = F.col("last_watermark").cast("timestamp_ntz")
    lower = (
        F.when(F.col("load_type") == "full", upper - _days(F.col("window_days")))
        .when(last.isNull(), _ntz(EPOCH))
        .otherwise(last - _hours(F.col("overlap_hours")))
    )
    return configs.join(marks, key, "left").select(
        *key, "load_type", lower.alias("lower_bound"), upper.alias("upper_bound")
    )


def replay_window(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """Explicit historic bounds; a replay never advances the watermark."""
    if start >= end:
        raise ValueError("the replay window ends before it starts")
    return start, end


def read_window(
    df: DataFrame,
    watermark: str,
    lower: datetime | None = None,
    upper: datetime | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows with lower <= watermark < upper; a full load passes no bounds. Bounds reach the scan."""
    rows = df
    if lower is not None:
        rows = rows.where(F.col(watermark) >= F.lit(lower).cast(df.schema[watermark].dataType))
    if upper is not None:
        rows = rows.where(F.col(watermark) < F.lit(upper).cast(df.schema[watermark].dataType))
    return rows.select(*columns) if columns else rows


def advance_watermarks(
    state: DataFrame, updates: DataFrame, key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """State rows to append after successful runs, and refused updates with the reason.

    ``updates`` gives ``new_watermark``, ``run_id`` and ``expected_version`` per entity. An update
    is refused when the version has moved on, or when it would move the watermark back. An entity
    without state expects version 0.
    """
    key = key or ENTITY_KEY
    now = current_watermarks(state, key).select(
        *key, F.col("last_watermark").alias("_last"), F.col("version").alias("_version")
    )
    joined = updates.join(now, key, "left")
    reason = F.when(
        F.coalesce("_version", F.lit(0)) != F.col("expected_version"), "version_conflict"
    ).when(F.col("new_watermark") < F.col("_last"), "moves_backwards")
    judged = joined.withColumn("reason", reason)
    accepted = judged.where(F.col("reason").isNull()).select(
        *key,
        F.col("new_watermark").alias("last_watermark"),
        (F.coalesce("_version", F.lit(0)) + 1).cast("long").alias("version"),
        "run_id",
    )
    return accepted, judged.where(F.col("reason").isNotNull()).select(*key, "run_id", "reason")


def advance_stored(
    layer: KeyedLayer, updates: DataFrame, key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``advance_watermarks`` on a stored state table, as one compare-and-set.

    The table is a ``KeyedLayer`` kept by the entity key. Of two runs that read the same state one
    writes the next version, and the other gets a ``VersionConflict`` with nothing changed; it reads
    again and decides anew. Returns accepted rows and refused updates.
    """
    key = key or ENTITY_KEY
    read = layer.version()
    state = layer.read_near(updates, read)
    if state is None:
        kinds = {f.name: f.dataType.simpleString() for f in updates.schema}
        columns = [*((k, kinds[k]) for k in key), ("last_watermark", kinds["new_watermark"])]
        columns += [("version", "long"), ("run_id", kinds["run_id"])]
        state = updates.sparkSession.createDataFrame([], ", ".join(f"`{n}` {k}" for n, k in columns))
    accepted, refused = advance_watermarks(state, updates, key)
    stored = cut_lineage(accepted, "watermarks")
    layer.merge(stored, ["version"], read=read)
    return stored, refused


def sync_plans(
    configs: DataFrame, state: DataFrame, now: datetime, key: list[str] | None = None
) -> DataFrame:
    """How to bring each entity up to date.

    ``configs`` adds ``strategy`` (``watermark_polling``, ``webhook_ingest`` or ``log_based_cdc``),
    ``load_type``, ``overlap_hours``, ``window_days`` and ``cdc_position``. A webhook entity more
    than six hours behind, and a CDC entity without position, fall back to a backfill window.
    """
    key = key or ENTITY_KEY
    marks = current_watermarks(state, key).select(*key, "last_watermark")
    joined = configs.join(marks, key, "left")
    upper = _ntz(now)
    last = F.col("last_watermark").cast("timestamp_ntz")
    fresh = last.isNotNull() & (last >= upper - _hours(F.lit(GAP_HOURS)))
    strategy = F.col("strategy")
    mode = (
        F.when(
            strategy == "watermark_polling",
            F.when(F.col("load_type") == "full", "full").otherwise("incremental_window"),
        )
        .when(strategy == "webhook_ingest", F.when(fresh, "webhook_drain").otherwise("gap_backfill"))
        .otherwise(
            F.when(F.coalesce("cdc_position", F.lit("")) != "", "cdc_stream").otherwise("gap_backfill")
        )
    )
    window = F.coalesce(last - _hours(F.col("overlap_hours")), upper - _days(F.col("window_days")))
    lower = F.when(mode == "webhook_drain", last).when(
        mode.isin("incremental_window", "gap_backfill"), window
    )
    return joined.select(
        *key,
        mode.alias("mode"),
        lower.alias("lower_bound"),
        F.when(~mode.isin("full", "cdc_stream"), upper).alias("upper_bound"),
        F.when(mode == "cdc_stream", F.col("cdc_position")).alias("cdc_position"),
    )


# ---------------------------------------------------------------- backfill


def chunk_days(rows_per_second: Column, rows_per_day: Column) -> Column:
    """Days per chunk so that a chunk takes about ten minutes; 1 to 90.

    A throughput that is not positive fails the query.
    """
    fitting = F.floor(rows_per_second * CHUNK_SECONDS / rows_per_day)
    bounded = F.greatest(F.lit(MIN_CHUNK_DAYS), F.least(F.lit(MAX_CHUNK_DAYS), fitting))
    refused = F.raise_error(F.lit("the throughput must be positive")).cast("int")
    sized = F.when(rows_per_day <= 0, F.lit(MAX_CHUNK_DAYS)).otherwise(bounded).cast("int")
    return F.when(rows_per_second <= 0, refused).otherwise(sized)


def plan_chunks(jobs: DataFrame, max_chunks: int | None = MAX_CHUNKS) -> DataFrame:
    """Contiguous chunks of every job, the last one possibly short.

    ``jobs`` gives ``window_start``, ``window_end`` (included) and ``chunk_days``. A job that would
    need more than ``max_chunks`` chunks fails the query instead of running without end; without a
    limit a job has at most as many chunks as its window has days.
    """
    days = F.date_diff("window_end", "window_start") + 1
    count = F.ceil(days / F.col("chunk_days")).cast("int")
    checked = F.when(
        F.col("window_end") < F.col("window_start"), F.raise_error(F.lit("window ends before it starts")).cast("int")
    )
    if max_chunks is not None:
        checked = checked.when(count > max_chunks, F.raise_error(F.lit(f"more than {max_chunks} chunks")).cast("int"))
    checked = checked.otherwise(count)
    numbered = jobs.withColumn("sequence", F.explode(F.sequence(F.lit(0), checked - 1)))
    start = F.date_add("window_start", F.col("sequence") * F.col("chunk_days"))
    return numbered.withColumn("chunk_start", start).withColumn(
        "chunk_end",
        F.least(F.date_add("chunk_start", F.col("chunk_days") - 1), F.col("window_end")),
    )


def chunk_of(day: Column, window_start: Column, days: Column) -> Column:
    """Chunk number a day belongs to; equals ``sequence`` of ``plan_chunks``."""
    return F.floor(F.date_diff(day, window_start) / days).cast("int")


def chunk_ledger(events: DataFrame, key: list[str]) -> DataFrame:
    """State of every chunk from its event log ``(key, sequence, event, rows,
    happened_at)``.

    Completing a completed chunk again changes nothing: rows count from the first completion after
    the last compensation. Compensation removes the chunk's rows.
    """
    by = [*key, "sequence"]
    undone = F.max(F.when(F.col("event") == "compensated", F.col("happened_at")))
    resets = events.groupBy(*by).agg(undone.alias("_reset"))
    joined = events.join(resets, by)
    live = F.col("_reset").isNull() | (F.col("happened_at") > F.col("_reset"))
    done = live & (F.col("event") == "completed")
    latest = F.max_by("event", "happened_at")
    completed_at = F.min(F.when(done, F.col("happened_at")))
    return joined.groupBy(*by).agg(
        F.when(completed_at.isNotNull(), "completed").otherwise(latest).alias("state"),
        F.coalesce(F.min_by("rows", F.when(done, F.col("happened_at"))), F.lit(0)).alias("rows_processed"),
        F.count_if(F.col("event") == "running").alias("attempts"),
    )


def resume_pointer(ledger: DataFrame, key: list[str]) -> DataFrame:
    """First chunk of each job that is not completed; null when all are."""
    return ledger.groupBy(*key).agg(
        F.min(F.when(F.col("state") != "completed", F.col("sequence"))).alias("next_sequence")
    )


# ---------------------------------------------------------------- capped reads


_SECOND = "yyyy-MM-dd HH:mm:ss"


def _cut(counts: DataFrame, limit: int) -> tuple[str, int] | None:
    """First slot at which the running count passes the limit, with the count before it.

    ``counts`` has one row per day, or per second of one day.
    """
    running = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = counts.withColumn("_upto", F.sum("n").over(running)).where(F.col("_upto") > limit)
    row = total.orderBy("slot").select("slot", (F.col("_upto") - F.col("n")).alias("before")).first()
    return None if row is None else (row[0], int(row[1]))


def capped_read(
    df: DataFrame, watermark: str, limit: int, tie_break: list[str]
) -> tuple[DataFrame, bool]:
    """The ``limit`` earliest rows by watermark, and whether more rows remain.

    Rows without a watermark come after all others. One pass counts rows per second; the second in
    which the limit falls is found from those counts, so only its rows are sorted, and all earlier
    ones pass a plain comparison of the watermark that reaches the scan.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    mark = F.col(watermark)
    kind = df.schema[watermark].dataType
    counts = cut_lineage(
        df.groupBy(F.date_format(mark, _SECOND).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("n"))), F.lit(0)).alias("marked"),
    ).first()
    if totals["rows"] <= limit:
        return df, False
    if totals["marked"] <= limit:
        marked = df.where(mark.isNotNull())
        left = limit - totals["marked"]
        if left == 0:
            return marked, True
        return marked.unionByName(df.where(mark.isNull()).orderBy(*tie_break).limit(left)), True
    known = counts.where(F.col("slot").isNotNull())
    day = F.substring("slot", 1, 10)
    days = known.groupBy(day.alias("slot")).agg(F.sum("n").alias("n"))
    cut_day, before_day = _cut(days, limit)
    cut_second, before_second = _cut(known.where(day == cut_day), limit - before_day)
    lower = F.lit(cut_second).cast(kind)
    upper = F.lit(str(datetime.fromisoformat(cut_second) + timedelta(seconds=1))).cast(kind)
    before = df.where(mark < lower)
    left = limit - before_day - before_second
    if left == 0:
        return before, True
    last = df.where((mark >= lower) & (mark < upper)).orderBy(watermark, *tie_break).limit(left)
    return before.unionByName(last), True


def checkpoint_watermark(df: DataFrame, watermark: str) -> DataFrame:
    """One row: rows read and the watermark to resume from."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.max(watermark).alias("resume_from"))


