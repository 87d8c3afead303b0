"""Hand-made micro tables (<= 12 rows each) covering the reference's quirks."""

import datetime as dt

from cohortlens import schemas
from cohortlens.sources.tables import TrialTables

D = dt.date


def studies_rows():
    # nct_id, status, phase, enrollment, enrollment_type, study_type, start, completion, primary,
    # first_submitted, results_submitted, arms, groups, why_stopped, expanded
    I = "INTERVENTIONAL"
    return [
        ("T1", "COMPLETED", "PHASE2", 100.0, "ACTUAL", I, D(2020, 1, 1), D(2021, 1, 1), D(2020, 12, 1), None, D(2021, 6, 1), 2.0, None, None, None),
        ("T2", "TERMINATED", "PHASE3", 50.0, "ESTIMATED", I, D(2020, 1, 1), D(2019, 12, 1), None, None, None, None, None, "Low accrual", None),
        ("T3", "COMPLETED", "PHASE2/PHASE3", None, "ACTUAL", I, None, D(2021, 1, 1), D(2020, 12, 1), None, None, 3.0, None, None, None),
        ("T4", "TERMINATED", "PHASE2", 10.0, "ACTUAL", I, D(2018, 3, 1), D(2019, 3, 1), D(2019, 1, 1), None, D(2019, 6, 1), 1.0, None, None, None),
        ("T5", "RECRUITING", "PHASE2", 10.0, "ACTUAL", I, None, None, None, None, None, None, None, None, None),
        ("T6", "COMPLETED", "PHASE1", 10.0, "ACTUAL", I, None, None, None, None, None, None, None, None, None),
        ("T7", "COMPLETED", "PHASE3", 10.0, "ACTUAL", "OBSERVATIONAL", None, None, None, None, None, None, None, None, None),
        ("T8", None, "PHASE3", 10.0, "ACTUAL", I, None, None, None, None, None, None, None, None, None),
    ]


def make_tables(spark) -> TrialTables:
    S = schemas
    sponsors = [
        ("T1", "INDUSTRY", "lead", "Beta"), ("T1", "NIH", "lead", "Alpha"),   # two leads -> Alpha
        ("T2", "NIH", "collaborator", "Gamma"),                              # collaborator only
        ("T3", None, "lead", "Delta"),                                       # lead with NULL class
        ("T4", "INDIV", "lead", "Eps"), ("T4", "INDIV", "lead", "Eps2"),     # duplicate leads, same class
    ]
    facilities = [("T1", None), ("T1", None),                  # all-NULL country
                  ("T2", "France"), ("T2", "France"),          # one country twice
                  ("T4", "France"), ("T4", "Spain")]           # two countries
    withdrawals = [
        ("T1", "Overall", " x ", 5.0), ("T1", "Overall", "X", 7.0),    # pad/case variants -> 'X'
        ("T2", "Overall", "Adverse Event", None), ("T2", "Overall", None, 3.0),  # all-NULL count for a reason
        ("T4", "Overall", "Adverse Event", 200.0),
        ("T9", "Overall", "X", 1000.0),                                # not in the cohort
    ]
    outcomes = [("T1", "PRIMARY", None, None, None), ("T1", "SECONDARY", None, None, None),
                ("T2", None, None, None, None)]
    events = [("T1", "serious", 1.0, 10.0), ("T1", "serious", None, None), ("T1", "other", 2.0, 3.0)]
    empty = lambda fn: spark.createDataFrame([], fn())
    return TrialTables(
        studies=spark.createDataFrame(studies_rows(), S.studies()),
        sponsors=spark.createDataFrame(sponsors, S.sponsors()),
        eligibilities=empty(S.eligibilities),
        drop_withdrawals=spark.createDataFrame(withdrawals, S.drop_withdrawals()),
        outcomes=spark.createDataFrame(outcomes, S.outcomes()),
        conditions=empty(S.conditions),
        facilities=spark.createDataFrame(facilities, S.facilities()),
        reported_events=spark.createDataFrame(events, S.reported_events()),
        interventions=empty(S.interventions),
    )
