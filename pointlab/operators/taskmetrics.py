"""Spark task metrics from the event log, and the speed-up of runs."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The part of a task-end event that the report needs.
TASK_END = """
  `Task End Reason` struct<Reason: string>,
  `Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint, `Getting Result Time`: bigint,
    Speculative: boolean>,
  `Task Metrics` struct<
    `Executor Deserialize Time`: bigint, `Executor Deserialize CPU Time`: bigint,
    `Executor Run Time`: bigint, `Executor CPU Time`: bigint, `Peak Execution Memory`: bigint,
    `Result Size`: bigint, `JVM GC Time`: bigint, `Result Serialization Time`: bigint,
    `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint,
    `Shuffle Read Metrics`: struct<`Remote Blocks Fetched`: bigint, `Local Blocks Fetched`: bigint,
      `Fetch Wait Time`: bigint, `Remote Bytes Read`: bigint, `Remote Bytes Read To Disk`: bigint,
      `Local Bytes Read`: bigint, `Total Records Read`: bigint>,
    `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint, `Shuffle Write Time`: bigint,
      `Shuffle Records Written`: bigint>,
    `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
    `Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>>
"""

def read_event_log(spark: SparkSession, path: str, application: str | None = None) -> DataFrame:
    """Lines of one or many event logs, written without compression; ``path`` may be a folder.

    With ``application`` only the files named after that application id are read.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if application:
        reader = reader.option("pathGlobFilter", f"*{application}*")
    return reader.text(path)


def parse_task_ends(lines: DataFrame) -> DataFrame:
    """Task-end events out of the lines of an event log; lines that cannot be read are left out.

    Most lines are told apart by their text, so only those that may be task ends are parsed, once.
    """
    event = F.from_json("value", "Event string, " + TASK_END, {"mode": "PERMISSIVE"})
    maybe = lines.where(F.col("value").contains("SparkListenerTaskEnd"))
    # A cut-off line may still parse up to where it ends, but lacks what every task end has.
    whole = (F.col("e.Event") == "SparkListenerTaskEnd") & F.col("e.`Task Info`.`Finish Time`").isNotNull()
    return maybe.select(event.alias("e")).where(whole & F.col("e.`Task End Reason`").isNotNull()).select("e.*")


def task_metrics(lines: DataFrame, begin_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """One row of 32 counters over the tasks that ran between two times, or over all tasks.

    Times are in milliseconds and sizes in bytes. Counters are sums over tasks; the result size and
    the peak memory are those of the largest task.
    """
    tasks = parse_task_ends(lines)
    if begin_ms is not None:
        tasks = tasks.where(F.col("`Task Info`.`Launch Time`") >= begin_ms)
    if end_ms is not None:
        tasks = tasks.where(F.col("`Task Info`.`Finish Time`") <= end_ms)

    def metric(*path: str) -> Column:
        return F.coalesce(F.col(".".join(f"`{p}`" for p in ("Task Metrics", *path))), F.lit(0))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    def total_ms(nanoseconds: Column) -> Column:
        return F.call_function("div", F.coalesce(F.sum(nanoseconds), F.lit(0)), F.lit(1_000_000))

    def largest(value: Column) -> Column:
        return F.coalesce(F.max(value), F.lit(0)).cast("long")

    info = {k: F.col(f"`Task Info`.`{k}`") for k in ("Launch Time", "Finish Time", "Getting Result Time")}
    duration = info["Finish Time"] - info["Launch Time"]
    fetching = F.when(info["Getting Result Time"] > 0, info["Finish Time"] - info["Getting Result Time"]).otherwise(0)
    run, load = metric("Executor Run Time"), metric("Executor Deserialize Time")
    pack = metric("Result Serialization Time")
    delay = F.greatest(F.lit(0), duration - run - load - pack - fetching)
    read, write = "Shuffle Read Metrics", "Shuffle Write Metrics"
    local_blocks, remote_blocks = metric(read, "Local Blocks Fetched"), metric(read, "Remote Blocks Fetched")
    local_bytes, remote_bytes = metric(read, "Local Bytes Read"), metric(read, "Remote Bytes Read")

    counters = {
        "numTasks": F.count(F.lit(1)),
        "successfulTasks": F.count_if(F.col("`Task End Reason`.Reason") == "Success"),
        "speculativeTasks": F.count_if(F.col("`Task Info`.Speculative")),
        "taskDuration": total(duration),
        "schedulerDelayTime": total(delay),
        "executorRunTime": total(run),
        "executorCpuTime": total_ms(metric("Executor CPU Time")),
        "executorDeserializeTime": total(load),
        "executorDeserializeCpuTime": total_ms(metric("Executor Deserialize CPU Time")),
        "resultSerializationTime": total(pack),
        "jvmGCTime": total(metric("JVM GC Time")),
        "shuffleFetchWaitTime": total(metric(read, "Fetch Wait Time")),
        "shuffleWriteTime": total_ms(metric(write, "Shuffle Write Time")),
        "gettingResultTime": total(fetching),
        "resultSize": largest(metric("Result Size")),
        "diskBytesSpilled": total(metric("Disk Bytes Spilled")),
        "memoryBytesSpilled": total(metric("Memory Bytes Spilled")),
        "peakExecutionMemory": largest(metric("Peak Execution Memory")),
        "recordsRead": total(metric("Input Metrics", "Records Read")),
        "bytesRead": total(metric("Input Metrics", "Bytes Read")),
        "recordsWritten": total(metric("Output Metrics", "Records Written")),
        "bytesWritten": total(metric("Output Metrics", "Bytes Written")),
        "shuffleRecordsRead": total(metric(read, "Total Records Read")),
        "shuffleTotalBlocksFetched": total(local_blocks + remote_blocks),
        "shuffleLocalBlocksFetched": total(local_blocks),
        "shuffleRemoteBlocksFetched": total(remote_blocks),
        "shuffleTotalBytesRead": total(local_bytes + remote_bytes),
        "shuffleLocalBytesRead": total(local_bytes),
        "shuffleRemoteBytesRead": total(remote_bytes),
        "shuffleRemoteBytesReadToDisk": total(metric(read, "Remote Bytes Read To Disk")),
        "shuffleBytesWritten": total(metric(write, "Shuffle Bytes Written")),
        "shuffleRecordsWritten": total(metric(write, "Shuffle Records Written")),
    }
    return tasks.agg(*[value.alias(name) for name, value in counters.items()])


@dataclass
class Meter:
    """Begin and end of a measured stretch of work, in milliseconds since 1970."""

    begin_ms: int = 0
    end_ms: int = 0


@contextmanager
def measured():
    """Time a block; the block must contain its actions, for a lazy plan has no tasks yet."""
    meter = Meter(begin_ms=int(time.time() * 1000))
    try:
        yield meter
    finally:
        meter.end_ms = int(time.time() * 1000)


def speedup_table(runs: DataFrame) -> DataFrame:
    """Speed-up of each run over the smallest number of executors with the same data fraction.

    ``runs`` has ``fraction``, ``executors`` and ``seconds``. Efficiency is the speed-up divided by
    the growth in executors.
    """
    smallest_first = Window.partitionBy("fraction").orderBy("executors", "seconds")
    base_seconds = F.first("seconds").over(smallest_first)
    base_executors = F.first("executors").over(smallest_first)
    speedup = F.try_divide(base_seconds, F.col("seconds"))
    return runs.select(
        "fraction",
        "executors",
        "seconds",
        speedup.alias("speedup"),
        (speedup / (F.col("executors") / base_executors)).alias("efficiency"),
    )
