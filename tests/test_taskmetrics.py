from __future__ import annotations

import json
import time

import pytest
from conftest import collect

from pointlab.operators.taskmetrics import measured, read_event_log, speedup_table, task_metrics


def task_end(launch, finish, run, *, reason="Success", getting=0, metrics=True, speculative=False):
    event = {
        "Event": "SparkListenerTaskEnd",
        "Stage ID": 0,
        "Task End Reason": {"Reason": reason},
        "Task Info": {"Launch Time": launch, "Finish Time": finish, "Getting Result Time": getting, "Speculative": speculative},
    }
    if metrics:
        event["Task Metrics"] = {
            "Executor Deserialize Time": 5, "Executor Deserialize CPU Time": 2_500_000, "Executor Run Time": run,
            "Executor CPU Time": 7_500_000, "Peak Execution Memory": run, "Result Size": 1000 + run, "JVM GC Time": 1,
            "Result Serialization Time": 2, "Memory Bytes Spilled": 0, "Disk Bytes Spilled": 3,
            "Shuffle Read Metrics": {"Remote Blocks Fetched": 1, "Local Blocks Fetched": 2, "Fetch Wait Time": 4,
                                     "Remote Bytes Read": 10, "Remote Bytes Read To Disk": 1, "Local Bytes Read": 20,
                                     "Total Records Read": 6},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 30, "Shuffle Write Time": 1_500_000, "Shuffle Records Written": 7},
            "Input Metrics": {"Bytes Read": 100, "Records Read": 50},
            "Output Metrics": {"Bytes Written": 40, "Records Written": 20},
        }
    return json.dumps(event, separators=(",", ":"))


LINES = [
    json.dumps({"Event": "SparkListenerTaskStart", "note": '"SparkListenerTaskEnd"'}, separators=(",", ":")),
    task_end(1000, 1100, 80),
    task_end(1000, 1200, 150, getting=1190),
    task_end(5000, 5010, 1, reason="ExceptionFailure", metrics=False, speculative=True),
]
EXPECTED = {
    "numTasks": 3, "successfulTasks": 2, "speculativeTasks": 1, "taskDuration": 310, "schedulerDelayTime": 13 + 33 + 10,
    "executorRunTime": 230, "executorCpuTime": 15, "executorDeserializeTime": 10, "executorDeserializeCpuTime": 5,
    "resultSerializationTime": 4, "jvmGCTime": 2, "shuffleFetchWaitTime": 8, "shuffleWriteTime": 3, "gettingResultTime": 10,
    "resultSize": 1150, "diskBytesSpilled": 6, "memoryBytesSpilled": 0, "peakExecutionMemory": 150, "recordsRead": 100,
    "bytesRead": 200, "recordsWritten": 40, "bytesWritten": 80, "shuffleRecordsRead": 12, "shuffleTotalBlocksFetched": 6,
    "shuffleLocalBlocksFetched": 4, "shuffleRemoteBlocksFetched": 2, "shuffleTotalBytesRead": 60, "shuffleLocalBytesRead": 40,
    "shuffleRemoteBytesRead": 20, "shuffleRemoteBytesReadToDisk": 2, "shuffleBytesWritten": 60, "shuffleRecordsWritten": 14,
}


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


def test_counters_of_a_fixed_log(lines):
    row = task_metrics(lines).first().asDict()
    assert row == EXPECTED
    assert len(row) == 32


def test_time_window_and_empty_log(lines, spark):
    assert task_metrics(lines, 0, 2000).first().numTasks == 2
    empty = task_metrics(lines, 9000).first().asDict()
    assert set(empty.values()) == {0}


def test_log_of_this_session(spark, event_log):
    with measured() as meter:
        spark.range(0, 1000, 1, 5).repartition(4).count()
    deadline = time.time() + 20
    while True:
        row = task_metrics(event_log(), meter.begin_ms, meter.end_ms).first()
        if row.numTasks >= 6 or time.time() > deadline:
            break
        time.sleep(0.5)
    assert row.numTasks >= 6
    assert row.successfulTasks == row.numTasks
    assert row.shuffleRecordsWritten >= 1000
    assert row.shuffleRecordsRead == row.shuffleRecordsWritten
    assert 0 < row.executorRunTime <= row.taskDuration


def test_odd_lines(spark):
    """The event's name need not come first; a cut-off line and one of another event count for nothing."""
    event = json.loads(LINES[1])
    later = json.dumps({k: event[k] for k in reversed(event)})
    cut = [LINES[1][:n] for n in (60, 120, len(LINES[1]) - 40)]
    got = task_metrics(spark.createDataFrame([(x,) for x in (later, *cut, LINES[0], "SparkListenerTaskEnd", "")], "value string")).first()
    assert got.numTasks == 1 and got.executorRunTime == 80


def test_large_sums_keep_their_digits(spark):
    event = json.loads(LINES[1])
    event["Task Metrics"]["Executor CPU Time"] = 2**53 + 999_999
    lines = spark.createDataFrame([(json.dumps(event),)] * 3, "value string")
    assert task_metrics(lines).first().executorCpuTime == 3 * (2**53 + 999_999) // 1_000_000


def test_only_logs_of_the_application_are_read(spark, tmp_path):
    for name in ("local-1", "local-2.inprogress"):
        (tmp_path / name).write_text(LINES[1] + "\n")
    assert task_metrics(read_event_log(spark, str(tmp_path))).first().numTasks == 2
    assert task_metrics(read_event_log(spark, str(tmp_path), "local-2")).first().numTasks == 1


def test_speedup_table(spark):
    runs = spark.createDataFrame(
        [(0.01, 8, 100.0), (0.01, 16, 60.0), (0.01, 32, 25.0), (0.05, 16, 30.0), (0.05, 32, 0.0)],
        "fraction double, executors int, seconds double",
    )
    got = collect(speedup_table(runs), "fraction", "executors")
    assert [(r[3], r[4]) for r in got] == [(1.0, 1.0), (pytest.approx(5 / 3), pytest.approx(5 / 6)), (4.0, 1.0), (1.0, 1.0), (None, None)]
