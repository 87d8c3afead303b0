"""Scalar column expressions (all JVM-side built-ins, no Python UDF).

Every function returns a ``Column`` so it composes into one whole-stage-codegen
projection wherever it is used.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 INT with NULL -> 0 (as ``astype(int)`` / ``CASE ... ELSE 0``)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def is_terminated(status: str | Column = "overall_status",
                  terminated: str = K.STATUS_TERMINATED) -> Column:
    """B2: 1 if the status is the terminated value, else 0 (NULL -> 0)."""
    return flag(_c(status) == F.lit(terminated))


def code_map(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Dict lookup as a ``when`` chain; unmapped -> ``default`` (NULL if None)."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def phase_numeric(phase: str | Column = "phase", codes: Mapping = K.PHASE_CODES) -> Column:
    """PHASE2 -> 2, PHASE2/PHASE3 -> 2.5, PHASE3 -> 3, else NULL (DOUBLE)."""
    return code_map(phase, codes).cast("double")


def sponsor_code(agency_class: str | Column = "agency_class",
                 codes: Mapping = K.AGENCY_CLASS_CODES,
                 default: int = K.AGENCY_CLASS_DEFAULT) -> Column:
    """Sponsor class ordinal; unknown and NULL -> default."""
    return code_map(agency_class, codes, default).cast("double")


def coerce_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> DATE; unparseable text -> NULL (``errors='coerce'``)."""
    return F.try_to_date(_c(c), fmt)


def duration_days(end: str | Column = "completion_date",
                  start: str | Column = "start_date") -> Column:
    """Whole days between two dates; negatives kept, NULL if either is NULL."""
    return F.datediff(_c(end), _c(start))


def duration_months(days: str | Column = "duration_days",
                    days_per_month: float = K.DAYS_PER_MONTH) -> Column:
    """Days / 30.44 rounded half-up to 1 decimal, exact decimal arithmetic."""
    return F.round(_c(days).cast("decimal(18,0)") / F.lit(days_per_month).cast("decimal(6,2)"), 1).cast("double")


def not_null_flag(c: str | Column) -> Column:
    """B6/B13 style: 1 if present else 0."""
    return _c(c).isNotNull().cast("int")


def only_when(c: str | Column, cond: Column) -> Column:
    """The value where ``cond`` holds, else NULL."""
    return F.when(cond, _c(c))


def enrollment_actual(enrollment: str | Column = "enrollment",
                      enrollment_type: str | Column = "enrollment_type") -> Column:
    return only_when(enrollment, _c(enrollment_type) == F.lit(K.ENROLLMENT_ACTUAL))


def log1p0(c: str | Column) -> Column:
    """log1p with NULL -> 0 first."""
    return F.log1p(F.coalesce(_c(c).cast("double"), F.lit(0.0)))


def normalize_reason(c: str | Column = "reason") -> Column:
    """Strip leading/trailing whitespace (Unicode's, as a text strip does), then
    upper-case."""
    return F.upper(F.regexp_replace(_c(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def na_to_null(c: str | Column, tokens: Iterable[str] = K.NA_TOKENS) -> Column:
    """A2: a field equal to one of the missing-value tokens becomes NULL
    (exact match, as a text reader compares whole fields)."""
    col = _c(c)
    return F.when(~col.isin(list(tokens)), col)


def pct(num: str | Column, den: str | Column, places: int = 1) -> Column:
    """Percentage rounded half-up; NULL when the denominator is 0 (``NULLIF``)."""
    return F.round(_c(num).cast("double") * F.lit(100.0) / F.nullif(_c(den).cast("double"), F.lit(0.0)),
                   places)


def ratio(num: str | Column, den: str | Column) -> Column:
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def band(score: str | Column, edges: Sequence[float] = K.BAND_EDGES,
         labels: Sequence[str] = K.BAND_LABELS) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; outside (incl. e0) -> NULL."""
    s = _c(score)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (s > F.lit(lo)) & (s <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def band_order(band_col: str | Column, labels: Sequence[str] = K.BAND_LABELS) -> Column:
    """Explicit order for a band label (1..n), NULL for no band."""
    return code_map(band_col, {lab: i + 1 for i, lab in enumerate(labels)}).cast("int")


def bin_index(c: str | Column, width: float) -> Column:
    """Integer bin ``floor(x / width)`` (integer labels, no float bin names)."""
    return F.floor(_c(c) / F.lit(width)).cast("long")


def hash_key(id_col: str | Column, seed: int = K.SAMPLE_SEED) -> Column:
    """Stable pseudo-random key of an id: md5 of ``'<seed>:<id>'``.

    Depends only on the id, so a sample or split is the same at any
    partitioning and on recompute after an executor loss."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))


def in_test_split(id_col: str | Column, fraction: float = K.TEST_FRACTION,
                  seed: int = K.SAMPLE_SEED) -> Column:
    """M1: hash split; the first 8 hex digits below ``fraction * 16**8`` -> test."""
    bound = format(int(fraction * 16 ** 8), "08x")
    return F.substring(hash_key(id_col, seed), 1, 8) < F.lit(bound)
