"""Resource samples as a stream: running summaries by run, and metrics written again after each batch."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SAMPLE = "run_id bigint, seq bigint, elapsed_us bigint, cpu_hundredths bigint, memory_bytes bigint"
SUMMARY = "run_id bigint, samples bigint, average_cores double, max_cores double, average_memory bigint, max_memory bigint, max_above_baseline bigint"
STATE = "elapsed bigint, cpu bigint, memory bigint, us bigint, work bigint, twice_memory_us string, peak double, most bigint, first bigint, samples bigint, plain bigint"


def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples that appear as JSON files in a folder."""
    return spark.readStream.schema(SAMPLE).json(folder)


def _summarise(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    rows = sorted((r for b in batches for r in zip(b["seq"], b["elapsed_us"], b["cpu_hundredths"], b["memory_bytes"])))
    s = list(state.get) if state.exists else None
    if s is not None:
        s[5] = int(s[5])
    for _, at, cpu, memory in map(lambda r: tuple(map(int, r)), rows):
        if s is None:
            s = [at, cpu, memory, 0, 0, 0, -1.0, memory, memory, 0, 0]
        elif at > s[0]:
            us, work = at - s[0], max(0, cpu - s[1])
            s[3], s[4], s[5] = s[3] + us, s[4] + work, s[5] + (memory + s[2]) * us
            s[6] = max(s[6], work / 100 / (us / 1e6))
        s[0], s[1], s[2] = at, cpu, memory
        s[7], s[9], s[10] = max(s[7], memory), s[9] + 1, s[10] + memory
    if s is None:
        return
    state.update((*s[:5], str(s[5]), *s[6:]))
    timed = s[3] > 0
    yield pd.DataFrame({
        "run_id": [key[0]], "samples": [s[9]], "average_cores": [round(s[4] / 100 / (s[3] / 1e6), 3) if timed else None], "max_cores": [round(s[6], 3) if s[6] >= 0 else None],
        "average_memory": [round(s[5] / 2 / s[3]) if timed else round(s[10] / s[9])], "max_memory": [s[7]], "max_above_baseline": [max(0, s[7] - s[8])],
    })


def running_summaries(samples: DataFrame) -> DataFrame:
    """A run's summary after each batch that has samples of it.

    The state of a run is one row of sums, however many samples it has. Samples of a run must come in the order of seq
    between batches, as a sampler writes them; within a batch they are sorted.
    """
    return samples.groupBy("run_id").applyInPandasWithState(_summarise, SUMMARY, STATE, "update", "NoTimeout")


def checkpoint_metrics(summaries: DataFrame, path: str, checkpoint: str, every: str | None = "10 minutes") -> tuple[StreamingQuery, list[str]]:
    """Write the latest summary of each run to a JSON file after each batch; every None takes what is there and stops.

    A failed write is kept in the list that is returned and doesn't end the stream; the next batch writes again. The
    number of runs bounds the file; it is meant for the few runs of one driver.
    """
    latest: dict[int, dict] = {}
    errors: list[str] = []

    def write(batch: DataFrame, _: int) -> None:
        for r in batch.toLocalIterator():
            latest[r["run_id"]] = r.asDict()
        try:
            temp = f"{path}.tmp"
            with open(temp, "w", encoding="utf-8") as f:
                json.dump(sorted(latest.values(), key=lambda x: x["run_id"]), f)
            os.replace(temp, path)
        except OSError as e:
            errors.append(str(e))

    out = summaries.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start(), errors
