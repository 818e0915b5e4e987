"""Resource samples: differences, time-weighted means, attribution to intervals, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def deltas(samples: DataFrame) -> DataFrame:
    """samples with the time, work and mean memory since the one before; time that doesn't pass gives no row, work that falls counts as 0.

    A run is one window. Times are whole microseconds and work whole hundredths, so that sums don't depend on order.
    """
    w = Window.partitionBy("run_id").orderBy("seq")
    d = lambda c: F.col(c) - F.lag(c).over(w)
    rows = samples.withColumns({"us": d("elapsed_us"), "work": F.greatest(F.lit(0), d("cpu_hundredths")), "twice_memory": F.col("memory_bytes") + F.lag("memory_bytes").over(w)})
    return rows.where("us > 0")


def summarise(intervals: DataFrame, samples: DataFrame, keys: list[str], capacity: float) -> DataFrame:
    """Cores used and memory held by keys: time-weighted means, peaks, and the peak above the first sample's memory."""
    cores = F.col("work") / 100.0 / (F.col("us") / 1e6)
    a = intervals.groupBy(*keys).agg(
        F.round(F.try_divide(F.sum("work") / 100.0, F.sum("us") / 1e6), 3).alias("average_cores"),
        F.round(F.max(cores), 3).alias("max_cores"),
        F.round(F.sum(F.col("twice_memory").cast("decimal(38,0)") * F.col("us")).cast("double") / 2 / F.sum("us")).cast("bigint").alias("average_memory"),
    )
    b = samples.groupBy(*keys).agg(F.max("memory_bytes").alias("max_memory"), F.min_by("memory_bytes", "seq").alias("baseline"), F.round(F.avg("memory_bytes")).cast("bigint").alias("plain"))
    rows = b.join(a, keys, "left")
    return rows.select(*keys, "average_cores", "max_cores", F.round(F.col("average_cores") / capacity * 100, 2).alias("average_percent"), F.coalesce("average_memory", "plain").alias("average_memory"), "max_memory", F.greatest(F.lit(0), F.col("max_memory") - F.col("baseline")).alias("max_above_baseline"))


def attribute(samples: DataFrame, intervals: DataFrame, width_us: int) -> DataFrame:
    """samples joined with the intervals(run_id, token, begin_us, end_us) that hold them, bounds included.

    A range join by run and slot of time: an interval is put into each slot it touches, so that a run with many
    samples and intervals isn't compared pair by pair.
    """
    slots = intervals.withColumn("slot", F.explode(F.sequence(F.floor(F.col("begin_us") / width_us), F.floor(F.col("end_us") / width_us))))
    mine = samples.withColumn("slot", F.floor(F.col("elapsed_us") / width_us))
    return mine.join(slots, ["run_id", "slot"]).where("elapsed_us BETWEEN begin_us AND end_us").drop("slot")


def eta(finished: DataFrame, workers: int) -> DataFrame:
    """finished(run_id, seq, seconds_us, total) with done, the mean of the positive durations so far, and the time that the rest will take."""
    w = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.try_divide(F.sum(F.when(F.col("seconds_us") > 0, F.col("seconds_us"))).over(w), F.count_if(F.col("seconds_us") > 0).over(w))
    rows = finished.withColumns({"done": F.count("*").over(w), "mean_us": mean})
    return rows.withColumn("remaining_us", F.greatest(F.lit(0), F.col("total") - F.col("done")) * F.col("mean_us") / workers)


def gpu_readings(lines: DataFrame) -> DataFrame:
    """(reading, devices, utilisation, used_bytes, total_bytes) of lines(reading, line) as 'percent, MiB, MiB': the mean of what is known, sums only where all devices report."""
    part = lambda i: F.expr(f"try_cast(trim(split(line, ',')[{i}]) AS double)")
    rows = lines.select("reading", part(0).alias("u"), part(1).alias("m"), part(2).alias("t"))
    whole = lambda c: F.when(F.count(c) == F.count("*"), F.sum(F.round(F.col(c) * 1048576))).cast("bigint")
    return rows.groupBy("reading").agg(F.count("*").alias("devices"), F.round(F.avg("u"), 6).alias("utilisation"), whole("m").alias("used_bytes"), whole("t").alias("total_bytes"))
