"""Binary-classification measures (CH-6 ... CH-6d) on a frame with an
integer ``label``, an integer ``prediction`` and a DOUBLE ``score``.

All are aggregates; the ROC measures use running sums over distinct scores
(distributed, see :mod:`starmart.operators.ordered`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.ordered import with_running_sums


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"),
                  F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
                  F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
                  F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"))


def _ratio(num, den):
    return F.when(den != 0, num.cast("double") / den)


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """CH-6: confusion matrix, accuracy, precision and recall of class 1."""
    c = _counts(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return c.select("tn", "fp", "fn", "tp",
                    _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
                    _ratio(tp, fp + tp).alias("precision_churn"),
                    _ratio(tp, fn + tp).alias("recall_churn"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """CH-6b: per-class precision, recall, F1 and support, then accuracy,
    macro and weighted averages (long form ``class_name, precision, recall,
    f1_score, support``)."""
    c = _counts(df, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)

    def f1(p, r):
        return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))

    s0, s1 = tn + fp, fn + tp
    p0z, r0z, p1z, r1z = (F.coalesce(x, F.lit(0.0)) for x in (p0, r0, p1, r1))
    rows = [
        F.struct(F.lit("0").alias("class_name"), p0z.alias("precision"), r0z.alias("recall"),
                 f1(p0z, r0z).alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("1").alias("class_name"), p1z.alias("precision"), r1z.alias("recall"),
                 f1(p1z, r1z).alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class_name"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 _ratio(tn + tp, n).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class_name"), ((p0z + p1z) / 2).alias("precision"),
                 ((r0z + r1z) / 2).alias("recall"),
                 ((f1(p0z, r0z) + f1(p1z, r1z)) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class_name"),
                 _ratio(p0z * s0 + p1z * s1, n).alias("precision"),
                 _ratio(r0z * s0 + r1z * s1, n).alias("recall"),
                 _ratio(f1(p0z, r0z) * s0 + f1(p1z, r1z) * s1, n).alias("f1_score"),
                 n.alias("support")),
    ]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            num_partitions: int | None = None) -> DataFrame:
    """CH-6c: area under the ROC curve, ties counted one half (Mann-Whitney).
    ``2 * sum_s pos_s * neg_below_s + sum_s pos_s * neg_s`` is an integer,
    so the result does not depend on summation order."""
    counts = _score_counts(df, label, score)
    cum, tot = with_running_sums(counts, [F.col("score").asc()], {"cneg": F.col("neg")},
                                 num_partitions)
    below = F.col("cneg") - F.col("neg")
    num = cum.agg(F.sum(2 * F.col("pos") * below + F.col("pos") * F.col("neg")).alias("num"),
                  F.sum("pos").alias("p"))
    n_neg = float(tot["cneg"] or 0)
    return num.select(F.when((F.col("p") > 0) & (F.lit(n_neg) > 0),
                             F.col("num").cast("double") / (2 * F.col("p") * F.lit(n_neg)))
                      .alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              num_partitions: int | None = None) -> DataFrame:
    """CH-6d: one point per distinct score (threshold ``score >= t``):
    ``threshold, fpr, tpr``."""
    counts = _score_counts(df, label, score)
    cum, tot = with_running_sums(counts, [F.col("score").desc()],
                                 {"tp": F.col("pos"), "fp": F.col("neg")}, num_partitions)
    p, n = float(tot["tp"] or 0), float(tot["fp"] or 0)
    return cum.select(F.col("score").alias("threshold"),
                      (F.col("fp") / F.lit(n)).alias("fpr") if n else F.lit(None).alias("fpr"),
                      (F.col("tp") / F.lit(p)).alias("tpr") if p else F.lit(None).alias("tpr"))
