"""The five-stage funnel over the master table.

The reference counts each stage independently over the same rows (so stage
k+1 can exceed stage k); ``nested=True`` ANDs the stage predicates instead,
which is the strict funnel its prose describes. Either way it is one
aggregation pass with partial counts per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C

STAGE_COLUMNS = (
    "stage1_registered",
    "stage2_enrollment_recorded",
    "stage3_primary_completion",
    "stage4_completed",
    "stage5_results_posted",
)

# fixed values: stage display names, in stage order
STAGE_NAMES = (
    "Registered (Phase 2/3)",
    "Enrollment Data Recorded",
    "Reached Primary Completion Date",
    "Completed (Not Terminated)",
    "Results Posted",
)


def stage_predicates():
    """Stage 1..5 conditions over master columns."""
    return [
        F.lit(True),
        F.col("enrollment_actual").isNotNull(),
        F.col("primary_completion_date").isNotNull(),
        F.col("overall_status") == F.lit(K.STATUS_COMPLETED),
        F.col("results_posted") == F.lit(1),
    ]


def funnel_stages(master: DataFrame, nested: bool = False) -> DataFrame:
    """One row, five BIGINT stage counts (0 on an empty cohort)."""
    preds = stage_predicates()
    if nested:
        acc, cum = None, []
        for p in preds:
            acc = p if acc is None else (acc & p)
            cum.append(acc)
        preds = cum
    return master.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n)
                        for p, n in zip(preds, STAGE_COLUMNS)])


def funnel_with_rates(master: DataFrame, nested: bool = False) -> DataFrame:
    """Stage counts, % of stage 1 (NULL if stage 1 is 0) and drop-offs."""
    return rates_of(funnel_stages(master, nested))


def rates_of(stages: DataFrame) -> DataFrame:
    """The columns of E2 from the one row of E1."""
    s = [F.col(c) for c in STAGE_COLUMNS]
    return stages.select(
        *STAGE_COLUMNS,
        *[C.pct(s[i], s[0]).alias(f"stage{i + 1}_pct_of_total") for i in range(1, 5)],
        *[(s[i - 1] - s[i]).alias(f"drop_stage{i}_to_{i + 1}") for i in range(1, 5)],
    )


def funnel_long(master: DataFrame, nested: bool = False) -> DataFrame:
    """Five rows: stage number and name, count, % of total, drop-off from the
    previous stage and stage-to-stage conversion (0 when the previous is 0).

    The one-row frame is unpivoted with ``stack``; each row carries its
    previous count, so no window is needed."""
    cols = list(STAGE_COLUMNS)
    rows = []
    for i, (c, name) in enumerate(zip(cols, STAGE_NAMES)):
        prev = cols[i - 1] if i else "CAST(NULL AS BIGINT)"
        rows.append(f"{i + 1}, '{name}', {c}, {prev}, stage1_registered")
    stacked = funnel_stages(master, nested).selectExpr(
        f"stack(5, {', '.join(rows)}) AS (stage_no, stage, stage_count, prev_count, first_count)")
    return stacked.select(
        F.col("stage_no").cast("int").alias("stage_no"), "stage",
        F.col("stage_count").cast("long").alias("stage_count"),
        C.pct("stage_count", "first_count").alias("pct_of_total"),
        (F.col("prev_count") - F.col("stage_count")).cast("long").alias("dropoff"),
        F.when(F.col("prev_count").isNull(), F.lit(None).cast("double"))
        .when(F.col("prev_count") > 0, C.pct("stage_count", "prev_count"))
        .otherwise(F.lit(0.0)).alias("conversion_pct"),
    )
