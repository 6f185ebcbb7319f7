"""Retraining triggers with a cooldown."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tabwarden import fixed
from tabwarden.functions import sizing

#: Steps along the pointers in one round of a replay.
RADIX = 8


def cooldown_active(now: Column, last: Column, days: int = fixed.COOLDOWN_DAYS) -> Column:
    """True while less than the cooldown has passed; no earlier trigger means inactive."""
    return F.coalesce(now < last + F.expr(f"INTERVAL {days} DAYS"), F.lit(False))


def decide(verdicts: DataFrame, last_triggers: DataFrame, monitor: Sequence[str], days: int = fixed.COOLDOWN_DAYS) -> DataFrame:
    """One decision per new verdict row against stored trigger state."""
    state = last_triggers.select(*monitor, "last_trigger")
    joined = verdicts.join(state, list(monitor), "left")
    cooling = cooldown_active(F.col("at"), F.col("last_trigger"), days)
    return joined.withColumn("action", action(F.col("drifted"), cooling))


def action(drifted: Column, cooling: Column) -> Column:
    return F.when(~drifted, "healthy").when(cooling, "suppressed").otherwise("fire")


def replay(verdicts: DataFrame, monitor: Sequence[str], days: int = fixed.COOLDOWN_DAYS) -> DataFrame:
    """Decisions for a whole history ``(monitor…, at, drifted)``; a verdict without a value is healthy.

    A suppressed verdict does not restart the clock, so which drift fires depends on those before it.
    Each drift time points to the first one after its pause; those that fire are reached from a
    monitor's first by these pointers. Pointers are joined with themselves, ``RADIX`` steps a round, so
    the rounds grow with the logarithm of the history. No history of a monitor meets in one task: drift
    times are looked up per day, and a row a day carries the rest.

    Of drifts at one time, one fires; drift without a time is suppressed; monitors may hold NULLs.
    """
    monitor, pause = list(monitor), F.expr(f"INTERVAL {days} DAYS")
    key = F.struct(*monitor).alias("_m")  # equal where its cells are, NULLs too
    rows = sizing.cut_lineage(verdicts.withColumn("_m", key), "verdicts")
    times = rows.where("drifted AND at IS NOT NULL").select("_m", "at").distinct()
    seen = Observation()
    watched = _first_after(times, pause).observe(seen, F.min("at").cast("date").alias("a"), F.max("at").cast("date").alias("b"))
    pointers = sizing.cut_lineage(watched, "pointers")
    reached = pointers.groupBy("_m").agg(F.min("at").alias("at"))
    steps = (seen.get["b"] - seen.get["a"]).days // max(days, 1) + 2 if seen.get.get("a") else 1
    while steps > 1:
        found = [reached]
        for _ in range(RADIX - 1):
            found.append(_step(found[-1], pointers))
        reached = sizing.cut_lineage(functools.reduce(DataFrame.unionByName, found), "reached")
        steps = -(-steps // RADIX)
        if steps > 1:
            far = pointers
            for _ in range(RADIX - 1):
                far = far.withColumnsRenamed({"at": "_from", "next": "at"}).join(pointers, ["_m", "at"]).select("_m", F.col("_from").alias("at"), "next")
            pointers = sizing.cut_lineage(far.where("next IS NOT NULL"), "pointers")
    # Of drifts at one time the first row fires.
    marked = rows.join(reached.distinct().withColumn("_fires", F.lit(True)), ["_m", "at"], "left").withColumn("_fires", F.coalesce("_fires", F.lit(False)) & F.coalesce("drifted", F.lit(False)))
    again = F.row_number().over(Window.partitionBy("_m", "at").orderBy(F.lit(1))) > 1
    fired = marked.where("_fires").withColumn("_again", again)
    both = fired.unionByName(marked.where("NOT _fires").withColumn("_again", F.lit(True)))
    decided = F.when(~F.coalesce("drifted", F.lit(False)), "healthy").when(F.col("_again"), "suppressed").otherwise("fire")
    return both.select(*verdicts.columns, decided.alias("action")).withColumn("reason", F.when(F.col("action") == "fire", fixed.TRIGGER_REASON))


def _step(reached: DataFrame, pointers: DataFrame) -> DataFrame:
    return reached.join(pointers, ["_m", "at"]).where("next IS NOT NULL").select("_m", F.col("next").alias("at"))


def _first_after(times: DataFrame, pause: Column) -> DataFrame:
    """``_m``, ``at``, ``next``: for each time the first one of its monitor that is at least ``pause`` later, or NULL."""
    nothing = F.lit(None).cast(times.schema["at"].dataType)
    wanted = times.select("_m", (F.col("at") + pause).alias("due"), F.col("at").alias("asks"), nothing.alias("has"), F.lit(1).alias("side"))
    there = times.select("_m", F.col("at").alias("due"), nothing.alias("asks"), F.col("at").alias("has"), F.lit(0).alias("side"))
    both = wanted.unionByName(there).withColumn("day", F.to_date("due"))
    inside = Window.partitionBy("_m", "day").orderBy(F.desc("due"), "side").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("near", F.last("has", ignorenulls=True).over(inside)).where("side = 1")
    later = Window.partitionBy("_m").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy("_m", "day").agg(F.min("has").alias("first")).withColumn("carry", F.last("first", ignorenulls=True).over(later))
    return local.join(carried.select("_m", "day", "carry"), ["_m", "day"]).select("_m", F.col("asks").alias("at"), F.coalesce("near", "carry").alias("next"))
