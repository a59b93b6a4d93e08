"""Classification metrics (M1-M9).

Rows are reduced once to the confusion counts (≤ classes² rows, partial
aggregation per task); every metric is then a tiny aggregate over that
table. Losses are one pass of per-row log-probabilities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import nan_to_zero
from tessera.session import written


def confusion(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """M1: (y, yhat, n)."""
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))


def per_class(conf: DataFrame) -> DataFrame:
    """Support, predicted count and true positives per class (union of the
    classes seen in y and in yhat)."""
    sup = conf.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"),
                                                  F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n"))
                                                        .otherwise(0)).alias("tp"))
    prd = conf.groupBy(F.col("yhat").alias("c")).agg(F.sum("n").alias("predicted"))
    j = sup.join(prd, "c", "full")
    return j.select("c", F.coalesce("support", F.lit(0)).alias("support"),
                    F.coalesce("predicted", F.lit(0)).alias("predicted"),
                    F.coalesce("tp", F.lit(0)).alias("tp"))


def scores(conf: DataFrame) -> DataFrame:
    """M2-M6 in one row: accuracy, balanced accuracy, weighted precision /
    recall / F1 (0 where nothing was predicted)."""
    pc = per_class(conf)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    pc = pc.withColumn("p", prec).withColumn("r", rec)
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))) \
          .otherwise(F.lit(0.0))
    pc = pc.withColumn("f1", f1)
    n = F.sum("support")
    return pc.agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("r"))).alias("balanced_accuracy"),
        (F.sum(F.col("support") * F.col("p")) / n).alias("precision"),
        (F.sum(F.col("support") * F.col("r")) / n).alias("recall"),
        (F.sum(F.col("support") * F.col("f1")) / n).alias("f1"))


def log_prob(logits: Column, y: Column, nan_to_zero_logits: bool = True, n_classes: int | None = None) -> Column:
    """log softmax(logits)[y] (stable: x_y - max - log Σ exp(x - max)).

    With a known ``n_classes`` the expression is written element by element
    (stays in whole-stage codegen); otherwise array lambdas are used."""
    if n_classes:
        xs = [logits.getItem(i) for i in range(n_classes)]
        if nan_to_zero_logits:
            xs = [F.when(F.isnan(x) | x.isNull(), F.lit(0.0)).otherwise(x) for x in xs]
        m = F.greatest(*xs) if n_classes > 1 else xs[0]
        lse = F.log(sum((F.exp(x - m) for x in xs[1:]), F.exp(xs[0] - m)))
        picked = F.coalesce(*[F.when(y.cast("int") == i, x) for i, x in enumerate(xs)])
        return picked - m - lse
    lg = nan_to_zero(logits) if nan_to_zero_logits else logits
    m = F.array_max(lg)
    lse = F.log(F.aggregate(F.transform(lg, lambda x: F.exp(x - m)), F.lit(0.0), lambda a, x: a + x))
    return F.element_at(lg, y.cast("int") + 1) - m - lse


def cross_entropy(df: DataFrame, logits: str = "logits", y: str = "y", weight: str | None = None,
                  batch: str | None = None, n_classes: int | None = None) -> DataFrame:
    """M7 mean (optionally class-weighted: Σ w·l / Σ w) cross-entropy;
    M8 with ``batch``: mean of per-batch means."""
    loss = -log_prob(F.col(logits), F.col(y), n_classes=n_classes)
    w = F.col(weight) if weight else F.lit(1.0)
    if batch is None:
        return df.agg((F.sum(w * loss) / F.sum(w)).alias("loss"))
    per = df.groupBy(batch).agg((F.sum(w * loss) / F.sum(w)).alias("bl"))
    return per.agg(F.avg("bl").alias("loss"))


def report(df: DataFrame, logits: str = "logits", y: str = "y", yhat: str = "yhat",
           batch: str | None = None, n_classes: int | None = None) -> DataFrame:
    """M9: loss, accuracy, balanced accuracy, precision, recall, F1 in one row
    (plain accuracy and unweighted loss).

    The rows are read once: counts and loss sums by (batch, y, yhat) are
    written, and everything else is an aggregate of those."""
    loss = -log_prob(F.col(logits), F.col(y), n_classes=n_classes)
    by = [F.col(batch).alias("b")] if batch else []
    cells = written(df.groupBy(*by, F.col(y).alias("y"), F.col(yhat).alias("yhat"))
                    .agg(F.count(F.lit(1)).alias("n"), F.count(loss).alias("k"), F.sum(loss).alias("s")), "report")
    mean = (F.sum("s") / F.sum("k")).alias("loss")
    total = (cells.groupBy("b").agg(mean).agg(F.avg("loss")) if batch else cells.agg(mean)).first()[0]
    conf = cells.groupBy("y", "yhat").agg(F.sum("n").alias("n"))
    return scores(conf).withColumn("loss", F.lit(total).cast("double"))
