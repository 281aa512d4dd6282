"""Watermarks, freshness, volume and roster checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import vocab as V


def realert_level(age: Column, threshold: Column, interval: float = V.REALERT_HOURS) -> Column:
    """Which interval past the threshold an age is in; -1 within it."""
    return F.when(age <= threshold, -1).otherwise(F.floor((age - threshold) / interval)).cast("int")


def freshness(watermarks: DataFrame, age_hours: Column, threshold: Column) -> DataFrame:
    """age_hours, threshold_hours and stale; thresholds of 0 or less leave a source out, no watermark is not stale."""
    rows = watermarks.withColumns({"age_hours": age_hours, "threshold_hours": threshold}).where("threshold_hours > 0")
    return rows.withColumn("stale", F.coalesce(F.col("age_hours") > F.col("threshold_hours"), F.lit(False)))


def realerts(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Stale sources with send or hold: an alert goes out when the level rises."""
    p = previous.select("source_id", F.col("age_hours").alias("age_before"), F.col("threshold_hours").alias("threshold_before"))
    rows = current.where("stale").join(p, "source_id", "left")
    level = realert_level(F.col("age_hours"), F.col("threshold_hours"))
    known = F.col("age_before").isNotNull() & (F.col("threshold_before") == F.col("threshold_hours"))
    before = F.when(known, realert_level(F.col("age_before"), F.col("threshold_hours"))).otherwise(-1)
    rows = rows.withColumns({"level": level, "level_before": before})
    hold = F.round(F.col("threshold_hours") + (F.col("level") + 1) * V.REALERT_HOURS - F.col("age_hours"), 1)
    send = F.col("level") > F.col("level_before")
    return rows.select("source_id", "level", "level_before", send.alias("send"), F.when(~send, hold).alias("hours_to_next"))


def volume_anomalies(counts: DataFrame, days: DataFrame, sigma: int = V.SIGMA, least: int = V.MIN_BASELINE) -> DataFrame:
    """Latest day's counts that lie over sigma deviations from the earlier days' mean.

    counts: source_id, run_day, n. days: run_day, one row a run, a few hundred at most.
    Missing days count 0. All in integers: |k x - s| * k > sigma * sqrt(k q - s s) * k squared.
    """
    last = days.agg(F.max("run_day").alias("last_day"), (F.count("*") - 1).alias("k"))  # one row
    c = counts.join(F.broadcast(last))
    past = F.col("run_day") < F.col("last_day")
    n = F.col("n").cast("bigint")
    sums = c.groupBy("source_id").agg(F.first("k").alias("k"), F.sum(F.when(~past, n).otherwise(0)).alias("today"), F.sum(F.when(past, n).otherwise(0)).alias("s"), F.sum(F.when(past, n * n).otherwise(0)).alias("q"))
    k, s, q, x = (F.col(v) for v in ("k", "s", "q", "today"))
    gap, spread = (k * x - s) * (k * x - s), k * q - s * s
    far = F.when(spread == 0, k * x != s).otherwise(gap > sigma * sigma * spread)
    found = sums.where((k >= 2) & (s >= least * k) & far)
    return found.select("source_id", "today", F.round(s / k, 1).alias("baseline"), F.when(k * x < s, "drop").otherwise("spike").alias("direction"))


def cliffs(counts: DataFrame, today: Column, before: Column) -> DataFrame:
    """Sources that had items the run before and have none now."""
    per = counts.groupBy("source_id").agg(F.sum(F.when(today, F.col("n")).otherwise(0)).alias("now"), F.sum(F.when(before, F.col("n")).otherwise(0)).alias("before"))
    return per.where("before > 0 AND now = 0").select("source_id", "before")


def recent_cliffs(counts: DataFrame, run: str, history: int = 5) -> DataFrame:
    """Sources of the run before the last that the last one lacks, among the last `history` runs; runs without counts are passed over after that.

    counts: source_id, n (null: the run has no counts), and the run.
    """
    recent = latest_rows(counts, run, history).where("n IS NOT NULL")
    two = recent.select(run).distinct().orderBy(F.desc(run)).limit(2).agg(F.max(run).alias("last"), F.min(run).alias("before"))  # one row
    told = recent.join(F.broadcast(two))
    return cliffs(told, F.col(run) == F.col("last"), (F.col(run) == F.col("before")) & (F.col("before") < F.col("last")))


def latest_rows(df: DataFrame, run: str, runs: int = 1) -> DataFrame:
    """Rows of the last runs; the list of runs is a distinct of the run column."""
    last = df.select(run).distinct().orderBy(F.desc(run)).limit(runs)
    return df.join(F.broadcast(last), run, "left_semi")  # `runs` rows


def roster_staleness(cycle: DataFrame, recent: DataFrame, players: DataFrame, least: int = 2) -> DataFrame:
    """Players whose reported stages their roster status doesn't know yet.

    cycle: links of this run, of which one must trigger; recent: links of the last seven days,
    of which `least` must. stages are those of this run, total is of the recent ones.
    """
    status = F.col("status")
    early, finish = F.col("stage").isin(V.EARLY), F.col("stage").isin(V.ADVANCED + V.CLOSING)
    start = status.isin("in_done", "out_done")
    open_ = status.isin("in_link", "out_link")
    triggers = lambda links: links.join(players, "player_id").where((start & early) | (open_ & finish))
    per = triggers(cycle).groupBy("player_id", "status", "stage").agg(F.count("*").alias("n"))
    total = triggers(recent).groupBy("player_id").agg(F.count("*").alias("total")).where(F.col("total") >= least)
    said = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "stage", F.col("n").cast("string")))), ",")  # ten stages at most
    out = per.groupBy("player_id", "status").agg(said.alias("stages")).join(total, "player_id")
    return out.select("player_id", F.when(status.isin("in_done", "out_done"), "start").otherwise("finish").alias("kind"), "total", "stages")
