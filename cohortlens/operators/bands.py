"""Risk bands over a score and the per-band outcome summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C


def with_bands(df: DataFrame, score: str = "risk_score", out: str = "risk_band",
               labels: Sequence[str] = K.BAND_LABELS, edges: Sequence[float] = K.BAND_EDGES) -> DataFrame:
    """Right-closed bands (0, .25], (.25, .5], (.5, .75], (.75, 1]; a score
    of 0, above 1 or NULL gets no band. ``<out>_ord`` orders the labels."""
    return (df.withColumn(out, C.band(score, edges, labels))
              .withColumn(f"{out}_ord", C.band_order(out, labels)))


def band_summary(df: DataFrame, band: str = "risk_band", score: str = "risk_score",
                 label: str = K.TARGET, by: Sequence[str] = ()) -> DataFrame:
    """Per band (and ``by``): scored rows, actual positives and their rate;
    rows without a band are dropped, empty bands are absent."""
    return (df.where(F.col(band).isNotNull())
            .groupBy(*by, band)
            .agg(F.count(score).alias("n"), F.sum(label).cast("long").alias("actual_terminated"))
            .withColumn("termination_rate_pct", C.pct("actual_terminated", "n")))
