"""Model quality from scored rows, for any number of groups in one plan.

Rows are folded to one count pair per (group, score) before any ordering, and ordered totals come from
``cumulate``, so neither a large group nor a frequent score ends up in a single task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.constants import (
    AVERAGE_LOAN,
    BALANCED_THRESHOLD,
    CONSERVATIVE_RATE,
    GROWTH_RATE,
    LOSS_GIVEN_DEFAULT,
    OVERFIT_GAP,
    THRESHOLDS,
)
from riskflow.operators.ordered import cumulate, wide_as_long


# ---- predictions and labels ----


def join_outcomes(
    predictions: DataFrame,
    labels: DataFrame,
    mode: str = "maturity",
    mob: int = 1,
    key: str = "Customer_ID",
) -> DataFrame:
    """Predictions with the label that later came true: month, label, score, weight.

    maturity: the label of the snapshot ``mob`` months after the prediction
    snapshot: the label of the same snapshot
    customer: every label of the customer with every prediction of the customer. Equal rows are counted
              first and the product is a weight, so a customer gives at most one row per pair of months.
    """
    y = labels.select(key, F.col("snapshot_date").alias("month"), "label")
    p = predictions.select(key, "snapshot_date", F.col("model_predictions").alias("score"))
    if mode == "customer":
        y = y.groupBy(key, "month", "label").agg(F.count(F.lit(1)).alias("n_y"))
        p = p.groupBy(key, "snapshot_date", "score").agg(F.count(F.lit(1)).alias("n_p"))
        return y.join(p, key).select(key, "month", "label", "score", (F.col("n_y") * F.col("n_p")).alias("weight"))
    shift = {"maturity": mob, "snapshot": 0}[mode]
    p = p.select(key, F.add_months("snapshot_date", shift).alias("month"), "score")
    return y.join(p, [key, "month"]).select(key, "month", "label", "score", F.lit(1).alias("weight"))


# ---- ranking ----


def _known(score: str) -> Column:
    """Neither null nor NaN."""
    return F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))


def score_counts(scored: DataFrame, groups: Sequence[str], label: str, score: str, weight: str | None = None) -> DataFrame:
    """Positives and negatives per (groups, score)."""
    w = F.col(weight) if weight else F.lit(1)
    y = F.col(label)
    return (
        scored.where(F.col(label).isin(0, 1) & _known(score))
        .groupBy(*groups, F.col(score).cast("double").alias("score"))
        .agg(
            F.sum(F.when(y == 1, w).otherwise(0)).alias("pos"),
            F.sum(F.when(y == 0, w).otherwise(0)).alias("neg"),
        )
    )


def _runs(scored: DataFrame, groups: Sequence[str], label: str, score: str, weight: str | None) -> DataFrame:
    return cumulate(score_counts(scored, groups, label, score, weight), "score", ["pos", "neg"], groups)


def _ranking() -> dict[str, Column]:
    p, n = F.col("tot_pos"), F.col("tot_neg")
    both = (p > 0) & (n > 0)
    below = F.col("cum_neg") - F.col("neg") / 2
    auc = F.sum(F.when(both, F.col("pos") / p * (below / n)))
    return {
        "auc": auc,
        "gini": 2 * auc - 1,
        "ks": F.max(F.when(both, F.abs(F.col("cum_pos") / p - F.col("cum_neg") / n))),
    }


def ranking_metrics(
    scored: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score", weight: str | None = None
) -> DataFrame:
    """AUC (ties count half), Gini and KS per group; null where only one class is present."""
    return _runs(scored, groups, label, score, weight).groupBy(*groups).agg(
        *[c.alias(name) for name, c in _ranking().items()], F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )


def _partial_areas(n_groups: int):
    """Of a sorted range: (groups, low, pos, neg, area) for each group in it; area counts pairs of a positive and a smaller
    negative of the range, ties half. Rows pass in batches, only the totals of the current group are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, low, pos, neg, area, kept = None, None, 0, 0, 0.0, []
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = pa.schema([*list(batch.schema)[: n_groups + 1], *[pa.field(c, pa.int64()) for c in ("pos", "neg")], pa.field("area", pa.float64())])
            change = np.zeros(batch.num_rows, bool)
            for c in range(n_groups):
                column = batch.column(c)
                change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            score, p, n = batch.column(n_groups), *(batch.column(n_groups + i).to_numpy() for i in (1, 2))
            for i, j in zip(starts, starts[1:]):
                here = tuple(batch.column(c)[i].as_py() for c in range(n_groups))
                if low is None or here != group:
                    if low is not None:
                        kept.append((*group, low, pos, neg, area))
                    group, low, pos, neg, area = here, score[i].as_py(), 0, 0, 0.0
                below = neg + np.cumsum(n[i:j]) - n[i:j]
                area += float((p[i:j] * (below + n[i:j] / 2)).sum())
                pos, neg = pos + int(p[i:j].sum()), neg + int(n[i:j].sum())
        if low is not None:
            kept.append((*group, low, pos, neg, area))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)

    return run


def area_under_curve(scored: DataFrame, groups: Sequence[str], label: str = "label", score: str = "score") -> DataFrame:
    """AUC (ties count half) per group with the numbers of positives and negatives; null where only one class is present.

    The counts per score are dealt into ranges of the order and sorted there once; each range gives one row per group,
    and only these are joined to totals. Where no curve is asked for this spares the written ranges of ``cumulate``.
    """
    keys = list(groups)
    counts = score_counts(scored, keys, label, score).where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, "score"]))
    ranges = counts.select(*keys, "score", "pos", "neg").repartitionByRange(*keys, "score").sortWithinPartitions(*keys, "score")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema[: len(keys) + 1])
    parts = ranges.mapInArrow(_partial_areas(len(keys)), f"{kinds}, pos long, neg long, area double")
    earlier = Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.withColumn("__base", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    p, n = F.sum("pos"), F.sum("neg")
    auc = F.when((p > 0) & (n > 0), F.sum(F.col("area") + F.col("pos") * F.col("__base").cast("double")) / p / n)
    return whole.groupBy(*keys).agg(auc.alias("auc"), p.alias("n_pos"), n.alias("n_neg"))


def monitoring(
    scored: DataFrame,
    group: str = "month",
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
    digits: int = 4,
) -> DataFrame:
    """One row per month: size, AUC, Gini, KS, Brier, mean prediction, default rate and their gap. All of them
    follow from the counts per score, so the scored rows are read once."""
    p, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    n = F.sum(pos + neg)
    mean, rate = F.sum((pos + neg) * p) / n, F.sum(pos) / n
    rank = _ranking()
    measures = {
        "AUC": rank["auc"],
        "Gini": rank["gini"],
        "KS": rank["ks"],
        "Brier": F.sum(pos * (p - 1) * (p - 1) + neg * p * p) / n,
        "Pred_Mean": mean,
        "Actual_Default_Rate": rate,
        "Default_Rate_Diff": F.abs(mean - rate),
    }
    return _runs(scored, [group], label, score, weight).groupBy(group).agg(
        n.cast("bigint").alias("n_samples"), *[F.round(c, digits).alias(name) for name, c in measures.items()]
    )


def auc_by_date(
    scored: DataFrame, oot_start: str, date: str = "snapshot_date", label: str = "label", score: str = "score"
) -> DataFrame:
    """AUC and Gini per date with two classes, tagged as out-of-time or train/test."""
    ranks = ranking_metrics(scored, [date], label, score).where(F.col("auc").isNotNull())
    later = F.col(date) >= F.lit(oot_start).cast("date")
    return ranks.select(
        date,
        F.round("auc", 6).alias("auc"),
        F.round("gini", 3).alias("gini"),
        F.when(later, "OOT").otherwise("Train/Test").alias("dataset"),
        (F.col("n_pos") + F.col("n_neg")).alias("sample_size"),
    )


def _descending(scored: DataFrame, groups: Sequence[str], label: str, score: str) -> DataFrame:
    counts = score_counts(scored, groups, label, score)
    return cumulate(counts, "score", ["pos", "neg"], groups, descending=True)


def roc_points(scored: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct score used as a threshold."""
    return _descending(scored, groups, label, score).select(
        *groups,
        F.col("score").alias("threshold"),
        F.when(F.col("tot_neg") > 0, F.col("cum_neg") / F.col("tot_neg")).alias("fpr"),
        F.when(F.col("tot_pos") > 0, F.col("cum_pos") / F.col("tot_pos")).alias("tpr"),
    )


def precision_recall_points(
    scored: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    return _descending(scored, groups, label, score).select(
        *groups,
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(F.col("tot_pos") > 0, F.col("cum_pos") / F.col("tot_pos")).alias("recall"),
        F.when(F.col("tot_pos") > 0, F.col("pos") / F.col("tot_pos")).alias("recall_step"),
    )


def average_precision(
    scored: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    points = precision_recall_points(scored, groups, label, score)
    return points.groupBy(*groups).agg(F.sum(F.col("precision") * F.col("recall_step")).alias("average_precision"))


# ---- calibration and distribution ----


def calibration(scored: DataFrame, bins: int = 10, label: str = "label", score: str = "score") -> DataFrame:
    """Equal-width bins of the known scores, closed on the right: rows, mean score and default rate of each bin in use."""
    edge = F.lit(bins)
    for k in range(bins - 1, 0, -1):
        edge = F.when(F.col(score) <= k / bins, k).otherwise(edge)
    return (
        scored.where(_known(score))
        .groupBy(edge.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias("mean_score"),
            F.avg(label).alias("default_rate"),
        )
    )


def score_histogram(scored: DataFrame, bins: int = 50, label: str = "label", score: str = "score") -> DataFrame:
    """Rows per class and equal-width score bin, with the density within the class."""
    slot = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    counts = scored.where(_known(score)).groupBy(label, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(label).agg(F.sum("n").alias("n_class"))
    return counts.join(sizes, label).select(
        label, "bin", "n", (F.col("n") * bins / F.col("n_class")).alias("density")
    )


# ---- decisions at a threshold ----


def _cells(label: str, score: str, threshold: float) -> dict[str, Column]:
    high, low = F.col(score) >= threshold, F.col(score) < threshold
    bad, good = F.col(label) == 1, F.col(label) == 0
    return {
        "tp": F.count_if(high & bad),
        "fp": F.count_if(high & good),
        "fn": F.count_if(low & bad),
        "tn": F.count_if(low & good),
    }


def confusion(
    scored: DataFrame, threshold: float = 0.5, groups: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    return scored.groupBy(*groups).agg(*[c.alias(name) for name, c in _cells(label, score, threshold).items()])


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def threshold_sweep(
    scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS, label: str = "label", score: str = "score"
) -> DataFrame:
    """One row per threshold. All thresholds are counted in the same pass; rows are not multiplied."""
    aggregates, fields = [], {}
    for i, t in enumerate(thresholds):
        cells = _cells(label, score, t)
        aggregates += [c.alias(f"{name}{i}") for name, c in cells.items()]
        fields[str(t)] = {name: f"{name}{i}" for name in cells}
    counts = wide_as_long(scored.agg(*aggregates), fields, "threshold")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    return counts.withColumn("threshold", F.col("threshold").cast("double")).withColumns(
        {
            "approval_rate": _share(tn + fn, total),
            "rejection_rate": _share(tp + fp, total),
            "default_rate_in_approved": _share(fn, tn + fn),
            "sensitivity": _share(tp, tp + fn),
            "specificity": _share(tn, tn + fp),
            "precision": _share(tp, tp + fp),
        }
    )


def expected_loss(sweep: DataFrame, loan: float = AVERAGE_LOAN, lgd: float = LOSS_GIVEN_DEFAULT) -> DataFrame:
    return sweep.withColumn("expected_loss_per_approved", F.col("default_rate_in_approved") * loan * lgd)


def threshold_choice(
    sweep: DataFrame,
    conservative: float = CONSERVATIVE_RATE,
    balanced: float = BALANCED_THRESHOLD,
    growth: float = GROWTH_RATE,
) -> DataFrame:
    """One row: highest threshold that keeps defaults at the conservative rate, the balanced threshold if it
    was tried, lowest threshold that keeps them at the growth rate."""
    t, rate = F.col("threshold"), F.col("default_rate_in_approved")
    return sweep.agg(
        F.max(F.when(rate <= conservative, t)).alias("conservative"),
        F.max(F.when(t == balanced, t)).alias("balanced"),
        F.min(F.when(rate <= growth, t)).alias("growth"),
    )


def class_report(
    scored: DataFrame, threshold: float = 0.5, groups: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Precision, recall, F1 and support of both classes."""
    cells = confusion(scored, threshold, groups, label, score)

    def row(of: int, hit: str, wrong: str, missed: str) -> Column:
        h, w, m = F.col(hit), F.col(wrong), F.col(missed)
        return F.struct(
            F.lit(of).alias("class"),
            _share(h, h + w).alias("precision"),
            _share(h, h + m).alias("recall"),
            _share(2 * h, 2 * h + w + m).alias("f1"),
            (h + m).alias("support"),
        )

    both = F.array(row(0, "tn", "fn", "fp"), row(1, "tp", "fp", "fn"))
    return cells.select(*groups, F.inline(both))


def overfit_check(by_split: DataFrame, split: str = "split", gap: float = OVERFIT_GAP) -> DataFrame:
    """One row: AUC of train and test, their gap, and whether it is too large."""
    auc = by_split.agg(
        F.max(F.when(F.col(split) == "train", F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col(split) == "test", F.col("auc"))).alias("test_auc"),
    )
    diff = F.col("train_auc") - F.col("test_auc")
    return auc.withColumns({"auc_gap": diff, "overfit": diff > gap})
