"""Queries over resource samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import metrics
from pagewright.plans import views
from pagewright.plans.registry import query
from pagewright.session import table

_SM = """sm AS (SELECT user_id AS run_id, row_number() OVER w AS seq, event_type, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS elapsed_us,
    (sum(round(value * 100)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT - CASE WHEN event_id % 11 = 0 THEN 300 ELSE 0 END AS cpu_hundredths, round(value * 1000)::BIGINT AS memory_bytes
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
dl AS (SELECT * FROM (SELECT *, elapsed_us - lag(elapsed_us) OVER v AS us, greatest(0, cpu_hundredths - lag(cpu_hundredths) OVER v) AS work, memory_bytes + lag(memory_bytes) OVER v AS twice_memory FROM sm WINDOW v AS (PARTITION BY run_id ORDER BY seq)) WHERE us > 0)"""


def _summary(keys: str) -> str:
    return f"""WITH {_SM}, a AS (SELECT {keys}, round(sum(work) / 100.0 / (sum(us) / 1e6), 3) AS average_cores, round(max(work / 100.0 / (us / 1e6)), 3) AS max_cores, round(sum(twice_memory::HUGEINT * us)::DOUBLE / 2 / sum(us))::BIGINT AS average_memory FROM dl GROUP BY ALL),
    b AS (SELECT {keys}, max(memory_bytes) AS max_memory, arg_min(memory_bytes, seq) AS baseline, round(avg(memory_bytes))::BIGINT AS plain FROM sm GROUP BY ALL)
    SELECT {keys}, average_cores, max_cores, round(average_cores / 8.0 * 100, 2) AS average_percent, coalesce(average_memory, plain) AS average_memory, max_memory, greatest(0, max_memory - baseline) AS max_above_baseline FROM b LEFT JOIN a USING ({keys})"""


@query(f"WITH {_SM} SELECT run_id, seq, us, work::BIGINT AS work FROM dl")
def w6_sample_deltas(spark, sf_dir):
    return metrics.deltas(views.samples(spark, sf_dir)).select("run_id", "seq", "us", "work")


@query(_summary("run_id"))
def m1_resource_summary(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    return metrics.summarise(metrics.deltas(s), s, ["run_id"], 8.0)


@query(_summary("event_type").replace("arg_min(memory_bytes, seq)", "arg_min(memory_bytes, (seq, run_id))"))
def m2_workload_summary(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    d = metrics.deltas(s)
    # The least place of a workload is shared by runs; the run decides then.
    return metrics.summarise(d, s.withColumn("seq", F.struct("seq", "run_id")), ["event_type"], 8.0)


@query(_summary("run_id, event_type"))
def m3_pool_summary(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    return metrics.summarise(metrics.deltas(s), s, ["run_id", "event_type"], 8.0)


@query("SELECT event_type, count(*) AS samples, round(avg(CASE WHEN event_id % 9 <> 0 THEN value END), 6) AS average, max(CASE WHEN event_id % 9 <> 0 THEN value END) AS peak FROM events GROUP BY ALL")
def m4_gpu_summary(spark, sf_dir):
    known = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("samples"), F.round(F.avg(known), 6).alias("average"), F.max(known).alias("peak"))


_IV = "iv AS (SELECT run_id, seq AS token, elapsed_us AS begin_us, elapsed_us + 7200000000 AS end_us FROM sm WHERE seq % 10 = 1)"


def _intervals(s):
    return s.where("seq % 10 = 1").select("run_id", F.col("seq").alias("token"), F.col("elapsed_us").alias("begin_us"), (F.col("elapsed_us") + 7_200_000_000).alias("end_us"))


@query(f"WITH {_SM}, {_IV} SELECT run_id, token, seq FROM sm JOIN iv USING (run_id) WHERE elapsed_us BETWEEN begin_us AND end_us")
def m6_interval_attribution(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    return metrics.attribute(s, _intervals(s), 7_200_000_000).select("run_id", "token", "seq")


@query(f"WITH {_SM}, {_IV} SELECT run_id, token, count(*) AS samples, max(memory_bytes) AS max_memory, max(elapsed_us) - min(elapsed_us) AS span_us FROM sm JOIN iv USING (run_id) WHERE elapsed_us BETWEEN begin_us AND end_us GROUP BY ALL")
def m7_workload_report(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    rows = metrics.attribute(s, _intervals(s), 7_200_000_000)
    return rows.groupBy("run_id", "token").agg(F.count("*").alias("samples"), F.max("memory_bytes").alias("max_memory"), (F.max("elapsed_us") - F.min("elapsed_us")).alias("span_us"))


@query(f"""WITH {_SM}, f AS (SELECT run_id, seq, CASE WHEN seq % 6 = 0 THEN 0 ELSE memory_bytes * 1000 END AS seconds_us, count(*) OVER (PARTITION BY run_id) AS total FROM sm),
    m AS (SELECT run_id, seq, total, count(*) OVER w AS done, sum(CASE WHEN seconds_us > 0 THEN seconds_us END) OVER w / nullif(count(CASE WHEN seconds_us > 0 THEN 1 END) OVER w, 0) AS mean_us FROM f WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS UNBOUNDED PRECEDING))
    SELECT run_id, seq, done, round(mean_us, 3) AS mean_us, round(greatest(0, total - done) * mean_us / 2, 3) AS remaining_us FROM m""")
def m9_eta(spark, sf_dir):
    s = views.samples(spark, sf_dir)
    f = s.select("run_id", "seq", F.when(F.col("seq") % 6 == 0, 0).otherwise(F.col("memory_bytes") * 1000).alias("seconds_us"), F.count("*").over(Window.partitionBy("run_id")).alias("total"))
    return metrics.eta(f, 2).select("run_id", "seq", "done", F.round("mean_us", 3).alias("mean_us"), F.round("remaining_us", 3).alias("remaining_us"))


@query("""WITH r AS (SELECT DISTINCT doc_id, round(extraction_time_seconds * 97)::BIGINT AS s FROM pdf_extractions WHERE extraction_time_seconds IS NOT NULL),
    p AS (SELECT doc_id, s, list_filter([CASE WHEN s // 86400 > 0 THEN (s // 86400)::VARCHAR || 'd' END, CASE WHEN s // 3600 % 24 > 0 THEN (s // 3600 % 24)::VARCHAR || 'h' END, CASE WHEN s // 60 % 60 > 0 THEN (s // 60 % 60)::VARCHAR || 'm' END, CASE WHEN s % 60 > 0 THEN (s % 60)::VARCHAR || 's' END], lambda x: x IS NOT NULL) AS l FROM r)
    SELECT doc_id, CASE WHEN s > 0 THEN array_to_string(l[1:2], ' ') ELSE '0s' END AS duration FROM p""")
def x12_duration_format(spark, sf_dir):
    rows = views.extractions(spark, sf_dir).where("extraction_time_seconds IS NOT NULL")
    return rows.select("doc_id", T.duration(F.round(F.col("extraction_time_seconds") * 97)).alias("duration"))


@query("""WITH g AS (SELECT event_id // 3 AS reading, value::VARCHAR || ', ' || CASE WHEN event_id % 7 = 0 THEN '[N/A]' ELSE (event_id % 4000)::VARCHAR END || ', 4096' AS line FROM events),
    p AS (SELECT reading, try_cast(trim(split_part(line, ',', 1)) AS DOUBLE) AS u, try_cast(trim(split_part(line, ',', 2)) AS DOUBLE) AS m, try_cast(trim(split_part(line, ',', 3)) AS DOUBLE) AS t FROM g)
    SELECT reading, count(*) AS devices, round(avg(u), 6) AS utilisation, CASE WHEN count(m) = count(*) THEN sum(round(m * 1048576))::BIGINT END AS used_bytes, CASE WHEN count(t) = count(*) THEN sum(round(t * 1048576))::BIGINT END AS total_bytes FROM p GROUP BY reading""")
def s13_gpu_parse(spark, sf_dir):
    k = F.col("event_id")
    line = F.concat(F.col("value").cast("string"), F.lit(", "), F.when(k % 7 == 0, "[N/A]").otherwise((k % 4000).cast("string")), F.lit(", 4096"))
    return metrics.gpu_readings(table(spark, sf_dir, "events").select(F.floor(k / 3).alias("reading"), line.alias("line")))
