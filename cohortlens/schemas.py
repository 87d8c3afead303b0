"""Fixed schemas of the nine registry tables and the scored output.

Inference costs an extra pass over text at scale and flips types when a column
is all-null, so every reader takes one of these ``StructType``s. Identifiers are
strings in a registry export; the id type is a parameter so numeric ids (as in
the test fixtures) use the same code.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, DT, I, L = T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(), T.LongType()


def studies(id_type: T.DataType = S) -> T.StructType:
    return _s(
        ("nct_id", id_type), ("overall_status", S), ("phase", S), ("enrollment", D),
        ("enrollment_type", S), ("study_type", S), ("start_date", DT),
        ("completion_date", DT), ("primary_completion_date", DT),
        ("study_first_submitted_date", DT), ("results_first_submitted_date", DT),
        ("number_of_arms", D), ("number_of_groups", D), ("why_stopped", S),
        ("has_expanded_access", S),
    )


def studies_text(id_type: T.DataType = S) -> T.StructType:
    """Studies as read from delimited text: dates stay text until coerced."""
    return T.StructType([
        T.StructField(f.name, S if isinstance(f.dataType, T.DateType) else f.dataType, True)
        for f in studies(id_type).fields
    ])


def sponsors(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("agency_class", S), ("lead_or_collaborator", S), ("name", S))


def eligibilities(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("gender", S), ("minimum_age", S), ("maximum_age", S),
              ("healthy_volunteers", S), ("criteria", S))


def drop_withdrawals(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("period", S), ("reason", S), ("count", D))


def outcomes(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("outcome_type", S), ("title", S), ("time_frame", S),
              ("population", S))


def conditions(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("name", S), ("downcase_name", S))


def facilities(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("country", S))


def reported_events(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("event_type", S), ("subjects_affected", D),
              ("subjects_at_risk", D))


def interventions(id_type: T.DataType = S) -> T.StructType:
    return _s(("nct_id", id_type), ("intervention_type", S), ("name", S))


TABLES = {
    "studies": studies,
    "sponsors": sponsors,
    "eligibilities": eligibilities,
    "drop_withdrawals": drop_withdrawals,
    "outcomes": outcomes,
    "conditions": conditions,
    "facilities": facilities,
    "reported_events": reported_events,
    "interventions": interventions,
}


def risk_scores(id_type: T.DataType = S) -> T.StructType:
    """The scored table the dashboard reads (typed as the BI source declares)."""
    return _s(
        ("nct_id", id_type), ("overall_status", S), ("is_terminated", I), ("phase", S),
        ("agency_class", S), ("enrollment", D), ("duration_months", D), ("site_count", D),
        ("total_withdrawals", D), ("risk_score", D), ("risk_band", S),
    )
