"""Within a run: streaks, early stop, export batches. Across runs: outcome, mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanframe.functions.text import blank_to_null
from gleanframe.operators.ordered import CHUNK, OrderedRows, running_count

EARLY_STOP_AFTER = 24
BATCH_ROWS = 50


def _stretches(local: DataFrame, threshold: int) -> DataFrame:
    """What each stretch (one run's rows in one chunk) adds up to, and what those before it do.

    A stretch is summed up by its rows, its new rows, its leading and trailing known rows and
    its own first hit. Summaries of neighbours add up to that of both, so a running sum and
    maximum over the few stretches of a run give each one the streak it starts with.
    """
    n, new_at = F.count(F.lit(1)), F.when(~F.col("is_known"), F.col("_nth"))
    sums = local.groupBy("_run", CHUNK).agg(
        n.alias("n"),
        F.count_if(~F.col("is_known")).alias("new"),
        F.coalesce(F.min(new_at) - 1, n).alias("lead"),
        F.max(new_at).alias("last_new"),
        F.min(F.when((F.col("_own") >= threshold) & F.col("_stoppable"), F.col("_nth"))).alias("hit"),
        F.bool_or("_stoppable").alias("stoppable"),
    )
    before = Window.partitionBy("_run").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    streak_in = F.col("start") - F.coalesce(F.max(F.col("start") + F.col("last_new")).over(before), F.lit(0))
    placed = placed.withColumn("_streak_in", streak_in)
    in_lead = F.col("stoppable") & (F.col("_streak_in") + F.col("lead") >= threshold)
    first = F.when(in_lead, F.greatest(threshold - F.col("_streak_in"), F.lit(1))).otherwise(F.col("hit"))
    hits = placed.withColumn("hit", first)
    stopped = F.coalesce(F.count("hit").over(before) > 0, F.lit(False))
    return hits.select(
        "_run",
        CHUNK,
        "_streak_in",
        F.coalesce(F.sum("new").over(before), F.lit(0)).alias("_new_before"),
        F.when(stopped, 0).otherwise(F.col("hit")).alias("_stop_at"),
    )


def scan_runs(
    marked: DataFrame,
    order: list[str],
    threshold: int = EARLY_STOP_AFTER,
    run: str = "run_id",
    mode: Column | None = None,
    batch_rows: int = BATCH_ROWS,
    chunks: int | None = None,
) -> DataFrame:
    """Everything that order decides about the rows of a run, from one range partition.

    ``is_known`` must be set. Adds ``streak`` (known rows in a row that end here), ``stops``
    (the row at which the run stops), ``examined`` (up to that row, itself included) and
    ``batch_no`` (from 1, of examined new rows; else null). ``mode`` says ``daily`` or
    ``resume`` for a run, alike in all its rows; resume runs never stop.
    """
    stoppable = F.lit(True) if mode is None else F.coalesce(mode == "daily", F.lit(False))
    given = marked.withColumns({"_run": F.struct(run), "_stoppable": stoppable})
    rows = OrderedRows.of(given, [run], order, chunks=chunks).chunked
    inside = Window.partitionBy("_run", CHUNK).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_nth", F.row_number().over(inside).cast("long"))
    new_at = F.when(~F.col("is_known"), F.col("_nth"))
    local = local.withColumns({"_reset": F.max(new_at).over(so_far), "_new": F.count(new_at).over(so_far)})
    local = local.withColumn("_own", F.col("_nth") - F.coalesce("_reset", F.lit(0)))
    scanned = local.join(_stretches(local, threshold), ["_run", CHUNK])
    streak = F.col("_own") + F.when(F.col("_reset").isNull(), F.col("_streak_in")).otherwise(0)
    examined = F.coalesce(F.col("_nth") <= F.col("_stop_at"), F.lit(True))
    batch = F.floor((F.col("_new_before") + F.col("_new") - 1) / batch_rows) + 1
    return scanned.withColumns(
        {
            "streak": streak,
            "stops": F.coalesce(F.col("_nth") == F.col("_stop_at"), F.lit(False)),
            "examined": examined,
            "batch_no": F.when(examined & ~F.col("is_known"), batch),
        }
    ).drop("_run", CHUNK, "_stoppable", "_nth", "_reset", "_new", "_own", "_streak_in", "_new_before", "_stop_at")


def known_streak(
    marked: DataFrame, order: list[str], run: str = "run_id", chunks: int | None = None
) -> DataFrame:
    """Add ``streak``: how many known rows in a row end here; ``is_known`` must be set."""
    return scan_runs(marked, order, run=run, chunks=chunks).drop("stops", "examined", "batch_no")


def early_stop(
    marked: DataFrame,
    order: list[str],
    threshold: int = EARLY_STOP_AFTER,
    run: str = "run_id",
    mode: Column | None = None,
    chunks: int | None = None,
    hit_name: str | None = None,
) -> DataFrame:
    """Rows a run examines: up to the first streak of ``threshold``, that row included; see ``scan_runs``.

    ``hit_name`` adds a column that is true on the row that stops the run.
    """
    examined = scan_runs(marked, order, threshold, run, mode, chunks=chunks).filter("examined").drop("examined", "batch_no")
    return examined.drop("stops") if hit_name is None else examined.withColumnRenamed("stops", hit_name)


def export_batches(
    new_rows: DataFrame,
    order: list[str],
    batch_rows: int = BATCH_ROWS,
    run: str = "run_id",
    chunks: int | None = None,
) -> DataFrame:
    """Number the new rows of a run into batches, from 1; the last may be partial."""
    counted = OrderedRows.of(new_rows, [run], order, chunks=chunks).running(_nth=running_count())
    return counted.df.withColumn("batch_no", F.floor((F.col("_nth") - 1) / batch_rows) + 1).drop("_nth")


def last_exported(
    batched: DataFrame, order: list[str], run: str = "run_id", key: str = "property_id"
) -> DataFrame:
    """Per run, the id that ends the latest batch which ends in a row with an id."""
    ends = batched.groupBy(run, "batch_no").agg(F.max_by(blank_to_null(key), F.struct(*order)).alias(key))
    return ends.filter(F.col(key).isNotNull()).groupBy(run).agg(F.max_by(key, "batch_no").alias("last_exported_id"))


def run_summary(examined: DataFrame, run: str = "run_id", batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Rows scraped, skipped as known, exported, and batches, per run, in one grouping."""
    exported = F.count_if(~F.col("is_known"))
    return examined.groupBy(run).agg(
        F.count(F.lit(1)).alias("scraped"),
        F.count_if("is_known").alias("skipped"),
        exported.alias("exported"),
        F.ceil(exported / batch_rows).alias("batches"),
    )


def run_outcome() -> Column:
    """COMPLETED, EARLY_STOP or INTERRUPTED from the flags of a run row."""
    return (
        F.when(F.col("stream_exhausted") & F.col("pages_exhausted"), "COMPLETED")
        .when(F.col("early_stop"), "EARLY_STOP")
        .otherwise("INTERRUPTED")
    )


def following_mode(outcome: Column, errors: Column) -> Column:
    """Mode of the run after this one."""
    clean = outcome.isin("COMPLETED", "EARLY_STOP") & (F.coalesce(errors, F.lit(0)) == 0)
    return F.when(clean, "daily").otherwise("resume")


def run_modes(runs: DataFrame, site: str = "site", started: str = "started") -> DataFrame:
    """Add outcome, the mode each run had (a site's first run resumes), and the next mode."""
    outcome = runs.withColumn("outcome", run_outcome()).withColumn(
        "next_mode", following_mode(F.col("outcome"), F.col("errors"))
    )
    moded = OrderedRows.of(outcome, [site], [started]).previous(mode=F.col("next_mode"))
    return moded.df.withColumn("mode", F.coalesce("mode", F.lit("resume")))


def begin_run(runs: DataFrame, site: str, started: Column) -> DataFrame:
    """Run flags as a run starts: nothing exhausted yet, outcome open."""
    row = runs.sparkSession.range(1).select(
        F.lit(site).alias("site"),
        started.alias("started"),
        *[F.lit(False).alias(name) for name in ("stream_exhausted", "pages_exhausted", "early_stop")],
        F.lit(0).cast("long").alias("errors"),
    )
    return runs.unionByName(row, allowMissingColumns=True)
