"""Run the top-reasons query and the master build over inputs where one trial
holds most withdrawal rows (and doubled facility rows), with an event log;
print the largest shuffle read of any task in those queries and the hot
trial's row count (JSON)."""

import glob
import json
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from cohortlens.adapters.fixtures import fixture_tables  # noqa: E402
from cohortlens.operators import cohort as CO  # noqa: E402
from cohortlens.operators import topk as TK  # noqa: E402
from cohortlens.session import build_session  # noqa: E402


def main(sf_dir, log_dir):
    spark = build_session("local[4]", 8, "skew-probe", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # the large-scale plan shape: no broadcasts, no runtime re-planning
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    t = fixture_tables(spark, sf_dir)
    hot = CO.cohort_ids(t.studies).agg(F.min("nct_id")).first()[0]
    wd = t.drop_withdrawals
    n = wd.count()
    # the hot trial gets as many extra rows as all others together (a third after doubling twice)
    extra = wd.withColumn("nct_id", F.lit(hot).cast("long"))
    skewed = wd.unionByName(extra).unionByName(extra)
    hot_rows = skewed.where(F.col("nct_id") == hot).count()
    # materialize the skewed inputs first, so only the measured queries' own
    # shuffles are counted (the fixture mapping has joins of its own)
    base = os.path.join(log_dir, "..", "inputs")
    skewed.write.mode("overwrite").parquet(os.path.join(base, "wd"))
    fac = t.facilities.unionByName(t.facilities.withColumn("nct_id", F.lit(hot).cast("long")))
    fac.write.mode("overwrite").parquet(os.path.join(base, "fac"))
    for name in ("studies", "sponsors", "outcomes"):
        getattr(t, name).write.mode("overwrite").parquet(os.path.join(base, name))
    r = lambda n: spark.read.parquet(os.path.join(base, n))
    tables = t.replace(studies=r("studies"), sponsors=r("sponsors"), outcomes=r("outcomes"),
                       drop_withdrawals=r("wd"), facilities=r("fac"))
    from cohortlens.operators import master as MA
    spark.sparkContext.setJobGroup("measured", "skew probe")
    TK.withdrawal_reasons(tables.drop_withdrawals, CO.cohort_ids(tables.studies)).collect()
    MA.master_trial(tables).collect()
    spark.stop()
    measured, max_read = set(), 0
    events = []
    for f in glob.glob(os.path.join(log_dir, "*")):
        if not os.path.isdir(f):
            events += [json.loads(line) for line in open(f)]
    for e in events:
        if e.get("Event") == "SparkListenerJobStart" and \
                (e.get("Properties") or {}).get("spark.jobGroup.id") == "measured":
            measured.update(e.get("Stage IDs", []))
    per_stage = {}
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and e.get("Stage ID") in measured:
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            rec = m.get("Total Records Read", 0)
            max_read = max(max_read, rec)
            per_stage[e["Stage ID"]] = max(per_stage.get(e["Stage ID"], 0), rec)
    if os.environ.get("SKEW_PROBE_DEBUG"):
        print(json.dumps(per_stage), file=sys.stderr)
    print(json.dumps({"rows": 3 * n, "hot_rows": hot_rows, "max_task_shuffle_read": max_read,
                      "measured_stages": len(measured)}))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
