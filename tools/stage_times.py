"""Stage and task times of the staged batch run, from Spark's event log.

Usage: python tools/stage_times.py [sf_dir] [top_n]
Writes the event log to a fresh scratch folder (the Spark UI stays off) and
prints the slowest stages with their task counts, shuffle bytes and spill.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    scratch = tempfile.mkdtemp(prefix="claimlens-eventlog-")
    from pyspark.sql import SparkSession

    from claimlens.plans import warranty as W
    from claimlens.plans.runner import run_batch
    from claimlens.session import ensure_checkpoint_dir

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", scratch)
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    ensure_checkpoint_dir(spark)
    run_batch(spark, W.view_inputs(spark, sf), folder=os.path.join(scratch, "run"))
    spark.stop()

    stages = []
    for path in glob.glob(os.path.join(scratch, "**", "events_*"), recursive=True):
        for line in _lines(path):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
            took = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
            stages.append((took, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:60],
                           acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                           acc.get("internal.metrics.diskBytesSpilled", 0)))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f} s in total")
    for took, sid, tasks, name, shuffled, spilled in stages[:top]:
        print(f"{took:7.2f}s stage {sid:4d} tasks={tasks:4d} shuffle_write={int(shuffled or 0):>11,d} spill={int(spilled or 0):>9,d}  {name}")


def _lines(path: str):
    """Lines of an event-log file (plain or zstd-compressed, as Spark 4 writes it)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


if __name__ == "__main__":
    main()
