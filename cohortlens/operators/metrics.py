"""Exact classification metrics as distributed aggregations.

Ranking metrics need, for every distinct score, how many positives and
negatives score below it. A single global window would pull every distinct
score into one task, so the prefix sums are computed in two levels:

1. group rows by score (partial aggregation: one row per distinct score);
2. cut the distinct scores into ranges of about equal size, by default about
   ``ROWS_PER_RANGE`` distinct scores each
   (cut points from a seeded sample of the distinct scores of bounded
   expected size, as Spark's range partitioner does) and assign each score
   its range with a JVM binary search (``Bucketizer``);
3. total each range (<= ``buckets`` rows), prefix-sum those totals in one
   small window, broadcast the offsets back (size bounded by ``buckets``);
4. a window partitioned by range finishes the exact prefix inside each range.

Equal-size ranges keep every window task about the same size, whatever the
score distribution looks like.

All of this works per key with ``by``: several score columns, learners or
segments share one grouping, one checkpoint and one set of cut points. The cuts
of all keys are united, so a range holds no more of a key than the key's own
cuts would leave in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

DEFAULT_BUCKETS = None          # as many ranges as the distinct scores need
ROWS_PER_RANGE = 100_000        # distinct scores of one range, about


def score_groups(df: DataFrame, score: str = "score", label: str = "label",
                 weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per key and distinct score (NULL scores
    dropped); with ``weight``, rows are pre-aggregated counts and their weights
    add."""
    y = F.col(label)
    if weight is None:
        pos, neg = F.count_if(y == 1), F.count_if(y == 0)
    else:
        w = F.col(weight).cast("long")
        pos = F.coalesce(F.sum(F.when(y == 1, w)), F.lit(0).cast("long"))
        neg = F.coalesce(F.sum(F.when(y == 0, w)), F.lit(0).cast("long"))
    return (df.where(F.col(score).isNotNull())
            .groupBy(*by, F.col(score).alias("score"))
            .agg(pos.alias("pos"), neg.alias("neg")))


def _equal_cuts(vals: list[float], ranges: int) -> list[float]:
    """At most ``ranges - 1`` increasing values that cut ``vals`` evenly."""
    vals = sorted(vals)
    out: list[float] = []
    for i in range(1, ranges if vals else 0):
        v = float(vals[min(len(vals) - 1, (i * len(vals)) // ranges)])
        if not out or v > out[-1]:
            out.append(v)
    return out


def _cut_points(groups: DataFrame, buckets: int | None, per_bucket: int = 32, seed: int = 17,
                by: Sequence[str] = ()) -> list[float]:
    """Increasing cut points over the distinct scores, those of all keys
    united: per key one fewer than its ranges (``buckets``, or as many as its
    scores need).

    As Spark's range partitioner does: a seeded Bernoulli sample of about
    ``per_bucket`` values per range (its expected size follows the number of
    ranges, not the rows) is sorted on the driver and cut at equal counts. A
    global quantile sketch would merge every task's sketch in one reducer
    instead. Keys whose scores fit one range are not sampled. The cuts only
    balance the ranges; results do not depend on them."""
    sizes = groups.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > (ROWS_PER_RANGE if buckets is None else 1)).collect()    # only keys of several ranges
    if not sizes or (buckets is not None and buckets <= 1):
        return []
    ranges = {tuple(r[c] for c in by): buckets or -(-r["_n"] // ROWS_PER_RANGE) for r in sizes}
    fraction = min(1.0, per_bucket * sum(ranges.values()) / sum(r["_n"] for r in sizes))
    vals: dict[tuple, list[float]] = {k: [] for k in ranges}
    for r in groups.select(*by, "score").sample(withReplacement=False, fraction=fraction, seed=seed).collect():
        k = tuple(r[c] for c in by)
        if k in vals:
            vals[k].append(r["score"])
    return sorted({c for k, n in ranges.items() for c in _equal_cuts(vals[k], n)})


def cumulative(df: DataFrame, score: str = "score", label: str = "label",
               buckets: int | None = DEFAULT_BUCKETS, with_lower: bool = False,
               weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per key and distinct score with ``pos``, ``neg`` and the exact
    counts of positives/negatives of the key strictly below it (``pos_below``,
    ``neg_below``) plus the key's class totals ``P`` and ``N``. Without ``by``
    all rows are one key; null key values are a key like any other. Runs jobs
    when called: the distinct scores are checkpointed, counted and sampled."""
    # The distinct-score frame feeds the cut-point job and both sides of the
    # offset join; its input is usually a model transform. Materialize it once
    # as a reliable checkpoint in the shared checkpoint folder.
    checkpoint_dir(df.sparkSession)
    by = list(by)
    g = score_groups(df, score, label, weight, by).checkpoint(eager=True)
    cuts = _cut_points(g, buckets, by=by)
    if cuts:
        g = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="score",
                       outputCol="_b", handleInvalid="keep").transform(g)
    else:
        g = g.withColumn("_b", F.lit(0.0))
    g = g.withColumn("_b", F.col("_b").cast("int"))
    totals = g.groupBy(*by, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # one row per range of a key: a small window per key is fine here
    key_window = Window.partitionBy(*by) if by else Window
    w_all = key_window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    w_tot = key_window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        *by, "_b",
        F.coalesce(F.sum("_bp").over(w_all), F.lit(0)).alias("_pos_off"),
        F.coalesce(F.sum("_bn").over(w_all), F.lit(0)).alias("_neg_off"),
        F.sum("_bp").over(w_tot).alias("P"),
        F.sum("_bn").over(w_tot).alias("N"))
    w_in = Window.partitionBy(*by, "_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    extra = []
    if with_lower:
        # (pos, neg) of the next lower distinct score: a lag inside the range,
        # and for a range's lowest score the highest row of the range below
        # (an edge row per range, joined like the offsets)
        w_edge = key_window.orderBy("_b")
        edges = (g.groupBy(*by, "_b").agg(F.max_by(F.struct("pos", "neg"), "score").alias("_top"))
                 .select(*by, "_b", F.lag("_top").over(w_edge).alias("_below_top")))
        offsets = _join_ranges(offsets, edges, by)
        w_lag = Window.partitionBy(*by, "_b").orderBy("score")
        lower = F.coalesce(F.lag(F.struct("pos", "neg")).over(w_lag), F.col("_below_top"))
        extra = [lower.getField("pos").alias("pos_lower"), lower.getField("neg").alias("neg_lower")]
    # without keys there are few ranges; keys may be many, so Spark decides there
    return (_join_ranges(g, offsets if by else F.broadcast(offsets), by)
            .select(*by, "score", "pos", "neg", "P", "N",
                    (F.col("_pos_off") + F.coalesce(F.sum("pos").over(w_in), F.lit(0))).alias("pos_below"),
                    (F.col("_neg_off") + F.coalesce(F.sum("neg").over(w_in), F.lit(0))).alias("neg_below"),
                    *extra))


def _join_ranges(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on the key columns, null matching null, and the range."""
    if not by:
        return left.join(right, "_b")
    names = {c: f"_r{i}" for i, c in enumerate([*by, "_b"])}
    right = right.withColumnsRenamed(names)
    on = F.lit(True)
    for c, r in names.items():
        on = on & F.col(c).eqNullSafe(F.col(r))
    return left.join(right, on).drop(*names.values())


def _auc_expr():
    # pairs (positive, negative) with the positive scored higher; ties count half
    return (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5)))
            / F.nullif(F.max("P").cast("double") * F.max("N").cast("double"), F.lit(0.0)))


def _ap_expr():
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return F.sum(F.when(F.col("pos") > 0, (F.col("pos") / F.nullif(F.col("P"), F.lit(0)))
                        * (tp / F.nullif(tp + fp, F.lit(0)))))


def _rounded(df: DataFrame, places: int | None, by: Sequence[str] = ()) -> DataFrame:
    return df if places is None else df.select(
        [F.col(c) if c in by else F.round(c, places).alias(c) for c in df.columns])


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "label",
                    places: int | None = 9, buckets: int | None = DEFAULT_BUCKETS,
                    by: Sequence[str] = ()) -> DataFrame:
    """AUC and average precision from one cumulative pass, one row (per key)."""
    c = cumulative(df, score, label, buckets, by=by)
    return _rounded(c.groupBy(*by).agg(_auc_expr().alias("auc"), _ap_expr().alias("average_precision")), places, by)


def auc(df: DataFrame, score: str = "score", label: str = "label", places: int | None = 9,
        buckets: int | None = DEFAULT_BUCKETS, by: Sequence[str] = ()) -> DataFrame:
    """M7: exact ROC-AUC with ties counted half (Mann-Whitney), one row (per
    key; NULL where a key lacks a class)."""
    return _rounded(cumulative(df, score, label, buckets, by=by).groupBy(*by).agg(_auc_expr().alias("auc")), places, by)


def average_precision(df: DataFrame, score: str = "score", label: str = "label", places: int | None = 9,
                      buckets: int | None = DEFAULT_BUCKETS, by: Sequence[str] = ()) -> DataFrame:
    """M9: step-wise average precision, sum over distinct thresholds of
    (recall gain) x (precision at that threshold); not the trapezoid area."""
    c = cumulative(df, score, label, buckets, by=by)
    return _rounded(c.groupBy(*by).agg(_ap_expr().alias("average_precision")), places, by)


def roc_points(df: DataFrame, score: str = "score", label: str = "label", places: int | None = 9,
               buckets: int | None = DEFAULT_BUCKETS, thin: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score as threshold
    (predict positive when score >= threshold), with the TP/FP counts.

    ``thin=True`` drops collinear points as the reference's ROC curves do:
    in descending threshold order the second difference of the cumulative
    counts at a threshold is the (pos, neg) of the next lower score minus its
    own, so a point is dropped exactly when both are equal; the highest and
    lowest thresholds are always kept."""
    c = cumulative(df, score, label, buckets, with_lower=thin, by=by)
    if thin:
        keep = (F.col("pos_lower").isNull()                               # lowest threshold
                | (F.col("pos_below") + F.col("pos") == F.col("P")) & (F.col("neg_below") + F.col("neg") == F.col("N"))
                | (F.col("pos") != F.col("pos_lower")) | (F.col("neg") != F.col("neg_lower")))
        c = c.where(keep)
    tp = (F.col("P") - F.col("pos_below")).cast("long")
    fp = (F.col("N") - F.col("neg_below")).cast("long")
    r = (lambda x: F.round(x, places)) if places is not None else (lambda x: x)
    return c.select(*by, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    r(fp / F.nullif(F.col("N").cast("double"), F.lit(0.0))).alias("fpr"),
                    r(tp / F.nullif(F.col("P").cast("double"), F.lit(0.0))).alias("tpr"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """One row (per key) of the four confusion counts (one aggregation pass)."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                               F.count_if((y == 0) & (p == 1)).alias("fp"),
                               F.count_if((y == 0) & (p == 0)).alias("tn"),
                               F.count_if((y == 1) & (p == 0)).alias("fn"))


def _prf(tp, fp, fn):
    prec = F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0))
    rec = F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(F.lit(2.0) * prec * rec / F.nullif(prec + rec, F.lit(0.0)), F.lit(0.0))
    return prec, rec, f1


def f1_macro(df: DataFrame, label: str = "label", prediction: str = "prediction",
             places: int | None = 9, by: Sequence[str] = ()) -> DataFrame:
    """M8: unweighted mean of the two classes' F1 (0 where undefined)."""
    c = confusion(df, label, prediction, by)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    _, _, f1_pos = _prf(tp, fp, fn)
    _, _, f1_neg = _prf(tn, fn, fp)
    v = (f1_pos + f1_neg) / F.lit(2.0)
    return c.select(*by, (F.round(v, places) if places is not None else v).alias("f1_macro"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          names: tuple[str, str] = ("Completed", "Terminated"),
                          places: int = 4) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and
    support-weighted averages, as rows (from one confusion pass)."""
    c = confusion(df, label, prediction)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    p1, r1, f1 = _prf(tp, fp, fn)
    p0, r0, f0 = _prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = (tp + tn) / F.nullif(n, F.lit(0.0))
    wavg = (lambda a, b: (a * s0 + b * s1) / F.nullif(n, F.lit(0.0)))
    rows = [
        (names[0], p0, r0, f0, s0),
        (names[1], p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n),
    ]
    structs = [F.struct(F.lit(i).alias("row_no"), F.lit(nm).alias("row_label"),
                        F.round(p, places).alias("precision"), F.round(r, places).alias("recall"),
                        F.round(f, places).alias("f1_score"), s.cast("long").alias("support"))
               for i, (nm, p, r, f, s) in enumerate(rows)]
    return c.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
