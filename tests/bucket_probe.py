"""Build the master from bucketed tables in a process of its own, without
broadcasts and runtime re-planning, and print whether it equals the directly
built one and the most input rows of any task (JSON)."""

import glob
import json
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortlens.operators import master as MA  # noqa: E402
from cohortlens.plans.ingest import read_bucketed  # noqa: E402
from cohortlens.session import build_session  # noqa: E402


def main(folder, direct, log_dir):
    os.makedirs(log_dir)
    spark = build_session("local[4]", 8, "bucket-probe", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false", "spark.sql.files.openCostInBytes": "1g"})   # a task per file
    tables = read_bucketed(spark, folder)
    spark.sparkContext.setJobGroup("measured", "bucket probe")
    rows = sorted(map(tuple, tables.per_trial(MA.master_trial_sql).collect()))
    spark.sparkContext.setJobGroup("other", "")
    equal = rows == sorted(map(tuple, spark.read.parquet(direct).collect()))
    spark.stop()
    events = [json.loads(line) for f in glob.glob(os.path.join(log_dir, "*")) for line in open(f)]
    stages = {s for e in events if e.get("Event") == "SparkListenerJobStart"
              and (e.get("Properties") or {}).get("spark.jobGroup.id") == "measured" for s in e["Stage IDs"]}
    # a task of a bucketed join reads one bucket of every table; the accumulators count each scan alone
    most = 0
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and e.get("Stage ID") in stages:
            most = max([most, *(int(a["Update"]) for a in e["Task Info"].get("Accumulables", [])
                                if a.get("Name") == "number of output rows" and str(a.get("Update", "")).isdigit())])
    print(json.dumps({"equal": equal, "max_task_input": most}))


if __name__ == "__main__":
    main(*sys.argv[1:])
