"""Ledger, source health and run counters as table-to-table steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listweave.config import DISABLE_AFTER_FAILURES, DISABLE_DAYS, DRIFT_MIN_PREVIOUS_COUNT, LEDGER_TITLE_RATIO, Settings
from listweave.functions import similarity


#: Runs that the log keeps.
KEPT_RUNS = 30
LEDGER = ("id", "t", "d", "s", "u")


def recorded(ledger: DataFrame, shown: DataFrame, today: Column) -> DataFrame:
    """The ledger with a row for each listing that was just shown: its id,
    normalized title and day, today, and the last day on which it could be shown
    again. Rows are only appended."""
    until = F.coalesce(F.col("end").cast("date"), F.col("effective_date"))
    new = shown.select("id", F.col("title_norm").alias("t"), F.col("effective_date").alias("d"), today.alias("s"), until.alias("u"))
    return ledger.select(*LEDGER).unionByName(new)


def purged(ledger: DataFrame, today: Column) -> DataFrame:
    """Rows whose listing may still be offered; those of a running one stay."""
    return ledger.filter(F.col("u") >= today)


def sent_ids(listings: DataFrame, ledger: DataFrame) -> DataFrame:
    """(id) of the listings that the ledger holds: by id, or on the same day with
    a title that comes to the ledger's ratio. Both are semi joins on equality; one
    title alike settles it."""
    by_id = listings.select("id").join(ledger.select("id"), "id", "left_semi")
    day = lambda rows, d, t: rows.select(F.col(d).alias("effective_date"), F.col(t).alias("text"))
    alike = similarity.with_similar(day(listings, "effective_date", "title_norm"), day(ledger, "d", "t"), LEDGER_TITLE_RATIO, ["effective_date"])
    by_title = listings.join(alike.select("effective_date", F.col("a").alias("title_norm")), ["effective_date", "title_norm"], "left_semi").select("id")
    return by_id.union(by_title).distinct()


def unsent(listings: DataFrame, sent: DataFrame) -> DataFrame:
    """``listings`` without those in ``sent`` (id)."""
    return listings.join(sent, "id", "left_anti")


def scope(published: DataFrame, displayed: DataFrame, delivered: bool, settings: Settings) -> DataFrame:
    """What a run records: all that the site shows or only what the mail shows,
    and nothing if nothing was delivered."""
    rows = published if settings.ledger_scope == "web" else displayed
    return rows if delivered else rows.limit(0)


def due(health: DataFrame, today: Column) -> DataFrame:
    """Sources that are not disabled beyond today."""
    return health.filter(~F.coalesce(F.col("disabled_until") > today, F.lit(False)))


def status(health: DataFrame) -> DataFrame:
    """The health table for display: by source, a dash for what is missing."""
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("—"))
    return health.select("source_id", dash("last_ok").alias("last_ok"), dash("last_count").alias("last_count"), dash("disabled_until").alias("disabled_until"), "consecutive_failures").orderBy("source_id")


def health_line(health: DataFrame) -> DataFrame:
    return health.agg(F.count("*").alias("sources"), F.count_if(F.col("consecutive_failures") == 0).alias("working"))


def health(previous: DataFrame, run: DataFrame, today: Column) -> DataFrame:
    """Source health after a run: ``previous`` (source_id, consecutive_failures,
    last_ok, last_count, disabled_until) and ``run`` (source_id, n; n is null
    where the source failed). A source that the run left out stays as it is; one
    that fails often is disabled for a while, one that works again is enabled."""
    at = previous.join(run.withColumn("ran", F.lit(True)), "source_id", "full")
    ran, ok = F.coalesce("ran", F.lit(False)), F.col("n").isNotNull()
    before = F.coalesce("consecutive_failures", F.lit(0))
    failures = F.when(~ran, before).when(ok, 0).otherwise(before + 1)
    until = F.when(~ran, F.col("disabled_until")).when(~ok, F.when(failures >= DISABLE_AFTER_FAILURES, F.date_add(today, DISABLE_DAYS)).otherwise(F.col("disabled_until")))
    return at.select(
        "source_id", failures.alias("consecutive_failures"),
        F.when(ok, today).otherwise(F.col("last_ok")).alias("last_ok"),
        F.coalesce("n", "last_count").alias("last_count"), until.alias("disabled_until"),
        F.coalesce((F.col("n") == 0) & (F.col("last_count") > DRIFT_MIN_PREVIOUS_COUNT), F.lit(False)).alias("drifted"),
    )


def kept_runs(log: DataFrame, seq: str, most: int = KEPT_RUNS) -> DataFrame:
    """The last ``most`` runs of a log; each task hands on no more than that."""
    return log.orderBy(F.desc(seq)).limit(most)
