"""Classification and regression reports as grouped aggregates.

Inputs are long tables (keys..., y, yhat[, p]); every report is a
``groupBy(keys)`` over a confusion table that is pre-aggregated first, so the
shuffle carries (keys x classes x classes) rows, not one row per prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.windows import KEYS


def confusion_counts(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys, F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, label, support, predicted, tp, precision, recall, f1); zero division -> 0.

    Each confusion cell is emitted twice (once as a true label, once as a
    predicted label) and re-aggregated: one shuffle, no join.
    """
    cm = confusion_counts(df, y, yhat, keys)
    roles = F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("s"), F.lit(0).alias("pc"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("yhat").alias("label"), F.lit(0).cast("long").alias("s"),
                 F.col("n").alias("pc"), F.lit(0).cast("long").alias("tp")),
    )).alias("r")
    pc = (cm.select(*keys, roles).groupBy(*keys, F.col("r.label").alias("label"))
          .agg(F.sum("r.s").alias("support"), F.sum("r.pc").alias("predicted"), F.sum("r.tp").alias("tp")))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    pc = pc.withColumns({"precision": precision, "recall": recall})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return pc.withColumn("f1", f1)


def classification_report(df: DataFrame, y: str = "y", yhat: str = "yhat",
                          keys: Sequence[str] = KEYS) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 per key."""
    pc = per_class(df, y, yhat, keys)
    tot = F.sum("support")
    return pc.groupBy(*keys).agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
    )


def per_class_report(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per class plus 'macro avg' and 'weighted avg' rows."""
    pc = per_class(df, y, yhat, keys).filter(F.col("support") + F.col("predicted") > 0)
    rows = pc.select(*keys, F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                     F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    macro = pc.groupBy(*keys).agg(
        F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.cast("long").alias("support"))
    weighted = pc.groupBy(*keys).agg(
        F.lit("weighted avg").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.cast("long").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = KEYS) -> DataFrame:
    """Counts for every (true, predicted) pair of the labels seen, zeros included.

    The label set per key is tiny (the classes), so the pairs are generated
    by exploding that set twice; the counts are joined back on the full key.
    """
    cm = confusion_counts(df, y, yhat, keys)
    labels = (cm.select(*keys, F.explode(F.array("y", "yhat")).alias("label"))
              .groupBy(*keys).agg(F.array_sort(F.collect_set("label")).alias("labels")))
    cells = (labels.select(*keys, F.explode("labels").alias("y"), "labels")
             .select(*keys, "y", F.explode("labels").alias("yhat")))
    return (cells.join(cm, [*keys, "y", "yhat"], "left")
            .select(*keys, "y", "yhat", F.coalesce("n", F.lit(0)).cast("long").alias("count")))


def regression_report(df: DataFrame, y: str = "y", yhat: str = "yhat", keys: Sequence[str] = KEYS) -> DataFrame:
    """MAE, MSE, RMSE and R^2 (constant truth: 1 if exact, else 0)."""
    e = F.col(yhat) - F.col(y)
    agg = df.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")))
    return agg.select(*keys, "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", keys: Sequence[str] = KEYS) -> DataFrame:
    """Area under the ROC curve by the rank-sum statistic, ties averaged.

    NULL when a key has a single class. The sort per key is over that key's
    scored rows (a calendar-bounded series of predictions).
    """
    w_rank = Window.partitionBy(*keys).orderBy(p)
    w_tie = Window.partitionBy(*keys, p)
    ranked = df.select(*keys, F.col(y).alias("_y"), F.col(p).alias(p)).withColumn(
        "_r", F.rank().over(w_rank) + (F.count(F.lit(1)).over(w_tie) - 1) / 2.0)
    agg = ranked.groupBy(*keys).agg(
        F.sum(F.when(F.col("_y") == 1, F.col("_r"))).alias("_rs"),
        F.count_if(F.col("_y") == 1).alias("_np"), F.count_if(F.col("_y") == 0).alias("_nn"))
    auc = F.when((F.col("_np") > 0) & (F.col("_nn") > 0),
                 (F.col("_rs") - F.col("_np") * (F.col("_np") + 1) / 2.0) / (F.col("_np") * F.col("_nn")))
    return agg.select(*keys, auc.alias("roc_auc"))


def class_weights(df: DataFrame, y: str = "y", keys: Sequence[str] = KEYS) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.groupBy(*keys, F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy(*keys)
    return counts.select(*keys, "label", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))
                         .alias("weight"))


def majority_baseline(train: DataFrame, test: DataFrame, y: str = "y", keys: Sequence[str] = KEYS) -> DataFrame:
    """Accuracy on test rows of always predicting the most frequent
    training label (the smallest label on a tie)."""
    counts = train.groupBy(*keys, F.col(y).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy(*keys).agg(
        F.max_by("label", F.struct(F.col("n"), -F.col("label"))).alias("majority_label"))
    scored = test.join(mode, list(keys), "inner")
    return scored.groupBy(*keys, "majority_label").agg(
        F.avg((F.col(y) == F.col("majority_label")).cast("double")).alias("baseline_accuracy"))
