"""Direction classifier on lookback windows.

The reference trains a two-layer LSTM on 30-step windows of 45 standardised
features with balanced class weights, holds the last fifth of the training
rows back, stops after ten epochs without a better validation loss and
restores the best weights. Here the same samples feed one weight per window
cell and a sigmoid, trained in the same epochs: an epoch is one distributed
pass that sums loss, gradient and validation loss over all tickers (features
are standardised per ticker, so tickers share the model, not the scales) and
one Adam step on the driver's 1,351 weights.

Windows overlap, so they are never stored. ``sample_blocks`` keeps each
scaled row once, in blocks of ``BLOCK`` rows of a ticker with the ``lookback``
rows before them; readers slide over a block: a row's score is a sum of 30
shifted products of the block with the weights, the gradient likewise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quiver.functions.scalar import safe_div
from quiver.functions.windows import KEYS, rolling_mean, rolling_std, rolling_sum, series_window
from quiver.operators import evaluation as EV
from quiver.operators.features import three_way_direction
from quiver.operators.market import INSTRUMENT_MOMENTUM
from quiver.operators.recursions import row_blocks

# The 45 model inputs, in the order the notebook lists them.
FEATURES = (
    "log_return", "log_return_squared", "garch_conditional_volatility", "garch_volatility_change",
    "garch_volatility_lag_1", "garch_volatility_lag_2", "return_lag_1", "return_lag_2", "return_lag_3",
    "return_lag_5", "momentum_3", "momentum_5", "momentum_10", "rolling_mean_5", "rolling_std_5",
    "rolling_mean_20", "rolling_std_20", "volatility_ratio", "vix_close", "vix_return", "vix_change",
    "vix_lag_1", "spy_return", "spy_momentum_5", "iwm_return", "iwm_momentum_5", "iwm_spy_relative_strength",
    "credit_risk_appetite", "xlk_return", "xlk_momentum_5", "qqq_spy_market_strength", "tech_vs_staples",
    "discretionary_vs_staples", "financials_vs_market", "industrials_vs_market", "tnx_close", "rate_change",
    "uup_return", "dollar_momentum_5", "tlt_return", "bond_momentum_5", "hyg_return", "credit_momentum_5",
    "gld_return", "gold_vs_market",
)
LOOKBACK = 30
THRESHOLD = 0.55
VALIDATION = 0.2
#: Rows of a sample block.
BLOCK = 512
EPOCHS, PATIENCE = 100, 10
#: Step size and decay rates of Adam, weight of the squared weights in the loss.
RATE, DECAY, L2 = 0.001, (0.9, 0.999), 1e-3


def feature_matrix(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """I16: every notebook feature in one projection (one shared sort), target
    added, incomplete rows dropped. ``df`` is the processed table with the
    GARCH features (I14)."""
    w = series_window(keys)
    r = F.col("log_return")
    cols = {
        "log_return_squared": F.pow(r, 2),
        **{f"return_lag_{n}": F.lag(r, n).over(w) for n in (1, 2, 3, 5)},
        **{f"momentum_{n}": rolling_sum("log_return", n, keys) for n in (3, 5, 10)},
        "rolling_mean_5": rolling_mean("log_return", 5, keys),
        "rolling_std_5": rolling_std("log_return", 5, keys),
        "rolling_mean_20": rolling_mean("log_return", 20, keys),
        "rolling_std_20": rolling_std("log_return", 20, keys),
        "vix_change": F.col("vix_close") - F.lag("vix_close").over(w),
        "vix_lag_1": F.lag("vix_close").over(w),
        "rate_change": F.col("tnx_close") - F.lag("tnx_close").over(w),
        **{name: rolling_sum(f"{src}_return", 5, keys) for name, src in INSTRUMENT_MOMENTUM},
        "target": F.coalesce(F.lead(r).over(w) > 0, F.lit(False)).cast("int"),
    }
    out = df.withColumns(cols).withColumn("volatility_ratio", safe_div("rolling_std_5", "rolling_std_20"))
    return out.select(*keys, "date", *FEATURES, "target").na.drop("any", subset=[*FEATURES, "target"])


def chrono_flags(df: DataFrame, train_share: float = 0.8, keys: Sequence[str] = KEYS) -> DataFrame:
    """Row number and the training flag (first int(n * share) rows)."""
    w = series_window(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumns({"_rn": F.row_number().over(w), "_n": n}).withColumn(
        "is_train", F.col("_rn") <= F.floor(F.col("_n") * train_share))


def standardize(df: DataFrame, cols: Sequence[str] = FEATURES, keys: Sequence[str] = KEYS,
                fit_on: str = "train") -> DataFrame:
    """H5: (x - mean) / population std per ticker and feature; std 0 -> 1.

    ``fit_on="train"`` fits on training rows (the notebook); ``"all"`` fits
    on every row, as the package code does despite its comment.
    """
    part = Window.partitionBy(*keys)
    sel = F.col("is_train") if fit_on == "train" else F.lit(True)
    out = {}
    for c in cols:
        mu = F.avg(F.when(sel, F.col(c))).over(part)
        sd = F.stddev_pop(F.when(sel, F.col(c))).over(part)
        out[c] = (F.col(c) - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return df.withColumns(out)


def lookback_windows(df: DataFrame, cols: Sequence[str] = FEATURES, lookback: int = LOOKBACK,
                     keys: Sequence[str] = KEYS, corrected: bool = False) -> DataFrame:
    """For row i the feature rows i-lookback .. i-1 (the source) or
    i-lookback+1 .. i (``corrected``), flattened in time order, labelled with
    target[i]; rows without a full window are dropped."""
    lo, hi = (-(lookback - 1), 0) if corrected else (-lookback, -1)
    w = series_window(keys).rowsBetween(lo, hi)
    vec = F.array(*[F.col(c) for c in cols])
    seq = F.collect_list(F.struct(F.col("date").alias("d"), vec.alias("v"))).over(w)
    out = df.withColumn("_seq", seq).filter(F.size("_seq") == lookback)
    flat = F.flatten(F.transform(F.array_sort("_seq"), lambda s: s["v"]))
    return out.withColumns({
        "window_start": F.col("_seq")[0]["d"], "window_end": F.element_at("_seq", -1)["d"],
        "features": flat,
    }).drop("_seq")


def latest_window(df: DataFrame, cols: Sequence[str] = FEATURES, lookback: int = LOOKBACK,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """The last ``lookback`` rows of every series as one inference sample."""
    win = lookback_windows(df, cols, lookback, keys, corrected=True)
    last = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return win.withColumn("_k", F.row_number().over(last)).filter("_k = 1").drop("_k")


def validation_tail(samples: DataFrame, share: float = 0.2, keys: Sequence[str] = KEYS) -> DataFrame:
    """The last ``share`` of each ticker's training samples is validation
    (Keras ``validation_split`` takes the tail)."""
    w = series_window(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rn = F.row_number().over(w)
    return samples.withColumn("is_validation", rn > F.floor(n * (1.0 - share)))


def sample_blocks(features: DataFrame, cols: Sequence[str] = FEATURES, keys: Sequence[str] = KEYS, lookback: int = LOOKBACK,
                  fit_on: str = "train", validation: float = VALIDATION, block: int = BLOCK) -> DataFrame:
    """E17 + H5 + E18 + E20 + D9 as one row per (series, block): arrays of the
    block's rows and the ``lookback`` rows before it. ``use`` is 1 for training
    samples, 2 for validation, 3 for test and 0 for rows without a full window.

    Training samples are the rows after the first ``lookback`` among the first
    80 %; their last ``validation`` share is held back. Weights are balanced
    over all of a series' training samples.
    """
    df = standardize(chrono_flags(features, keys=keys), cols, keys, fit_on)
    part = Window.partitionBy(*keys)
    sample = F.col("is_train") & (F.col("_rn") > lookback)
    n_train = F.count_if(sample).over(part)
    up, down = F.count_if(sample & (F.col("target") == 1)).over(part), F.count_if(sample & (F.col("target") != 1)).over(part)
    classes = (up > 0).cast("int") + (down > 0).cast("int")
    weight = F.coalesce(F.try_divide(n_train, classes * F.when(F.col("target") == 1, up).otherwise(down)), F.lit(1.0))
    held = F.col("_rn") - lookback > F.floor(n_train * (1.0 - validation))
    use = (F.when(F.col("_rn") <= lookback, 0).when(~F.col("is_train"), 3).when(held, 2).otherwise(1))
    rows = df.select(*keys, "date", F.col("_n").alias("n"), (F.col("_rn") - 1).cast("long").alias("row"), F.array(*cols).alias("x"),
                     F.col("target").cast("int").alias("target"), weight.alias("weight"), use.alias("use"))
    put = F.array_sort(F.collect_list(F.struct("row", "date", "x", "target", "weight", "use")))
    out = row_blocks(rows, block, lookback).groupBy(*keys, "block").agg(F.first("n").alias("n"), put.alias("s"))
    return out.select(*keys, (F.col("block") * block).alias("begin"), F.lit(block).alias("size"), "n", F.col("s.row").alias("row"), F.col("s.date").alias("date"),
                      F.flatten("s.x").alias("x"), F.col("s.target").alias("target"), F.col("s.weight").alias("weight"),
                      F.col("s.use").alias("use"))


def _own_rows(batch: pa.RecordBatch, i: int, width: int, lookback: int) -> tuple[np.ndarray, dict[str, np.ndarray], int]:
    """(values of a block's rows, its columns, index of the first row with a full window that the block owns)."""
    get = {c: batch.column(c)[i].values.to_numpy() for c in ("row", "x", "target", "weight", "use")}
    x = get.pop("x").reshape(-1, width)
    begin = batch.column("begin")[i].as_py()
    first = max(int(np.searchsorted(get["row"], begin)), lookback)
    return x, get, first


def _scores(x: np.ndarray, at: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    """w . (the len(w) rows before each index in ``at``) + b."""
    shifted = x @ w.T
    return b + sum(shifted[at - len(w) + k, k] for k in range(len(w)))


@dataclass
class DirectionModel:
    """Weights [lookback, features] and intercept of the best epoch, and the history (epoch, loss, val_loss)."""

    weights: np.ndarray
    intercept: float
    history: list[tuple[int, float, float | None]]
    best_epoch: int

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per weight (step, feature), the intercept as step -1; loads back with ``from_table``."""
        steps, width = self.weights.shape
        rows = [(k, j, float(self.weights[k, j])) for k in range(steps) for j in range(width)]
        return spark.createDataFrame([*rows, (-1, 0, float(self.intercept))], "step int, feature int, weight double")

    @classmethod
    def from_table(cls, table: DataFrame) -> DirectionModel:
        rows = table.collect()  # one row per weight
        w = np.zeros((max(r.step for r in rows) + 1, max(r.feature for r in rows) + 1))
        intercept = 0.0
        for r in rows:
            if r.step < 0:
                intercept = r.weight
            else:
                w[r.step, r.feature] = r.weight
        return cls(w, intercept, [], -1)


def _bce(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z) - y * z


def _epoch(blocks: DataFrame, w: np.ndarray, b: float) -> np.ndarray:
    """[gradient of the weights, of the intercept, loss, samples, validation loss, validation samples], summed over all blocks."""
    lookback, width = w.shape

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, rest = np.zeros_like(w), np.zeros(5)
        for batch in it:
            for i in range(batch.num_rows):
                x, get, first = _own_rows(batch, i, width, lookback)
                own = get["use"][first:]
                at = first + np.flatnonzero((own == 1) | (own == 2))
                if not len(at):
                    continue
                z, y = _scores(x, at, w, b), get["target"][at].astype(float)
                train = get["use"][at] == 1
                loss = _bce(z, y)
                c = np.where(train, get["weight"][at], 0.0)
                d = c * (1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))) - y)
                for k in range(lookback):
                    g[k] += d @ x[at - lookback + k]
                rest += d.sum(), (c * loss).sum(), train.sum(), loss[~train].sum(), (~train).sum()
        values = np.concatenate((g.ravel(), rest))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

    sums = blocks.mapInArrow(tasks, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(w.size + 5)  # one row per weight comes back
    for r in sums:
        out[r["at"]] = r["value"]
    return out


def train_direction(blocks: DataFrame, width: int = len(FEATURES), lookback: int = LOOKBACK, epochs: int = EPOCHS,
                    patience: int = PATIENCE, rate: float = RATE, l2: float = L2) -> DirectionModel:
    """Epochs of full-batch Adam with early stopping on the validation loss.

    Loss is the class-weighted cross entropy of the training samples over their
    number plus ``l2`` / 2 times the squared weights; validation loss is
    unweighted and without that term. Both are those of the weights after the
    epoch's step. Training stops after ``patience`` epochs without a smaller
    validation loss; the model has the weights of the smallest one. Without
    validation rows all epochs run and the last weights stay.
    """
    w, b = np.zeros((lookback, width)), 0.0
    m, v = np.zeros(w.size + 1), np.zeros(w.size + 1)
    history: list[tuple[int, float, float | None]] = []
    best = (np.inf, 0, w, b)
    for epoch in range(epochs + 1):  # pass 0 only has the first gradient
        sums = _epoch(blocks, w, b)
        g, loss, n, val, n_val = sums[:w.size + 1], *sums[w.size + 1:].tolist()
        if not n:
            break
        if epoch:
            val_loss = val / n_val if n_val else None
            history.append((epoch, loss / n + l2 / 2 * float((w * w).sum()), val_loss))
            if val_loss is None or val_loss < best[0]:
                best = (np.inf if val_loss is None else val_loss, epoch, w, b)
            elif epoch - best[1] >= patience:
                break
        g = g / n + l2 * np.append(w.ravel(), 0.0)
        m, v = DECAY[0] * m + (1 - DECAY[0]) * g, DECAY[1] * v + (1 - DECAY[1]) * g * g
        step = rate * (m / (1 - DECAY[0] ** (epoch + 1))) / (np.sqrt(v / (1 - DECAY[1] ** (epoch + 1))) + 1e-8)
        w, b = w - step[:-1].reshape(w.shape), b - float(step[-1])
    return DirectionModel(best[2], best[3], history, best[1])


def training_history(spark: SparkSession, model: DirectionModel) -> DataFrame:
    """Loss and validation loss per epoch, and which epoch's weights stayed."""
    return spark.createDataFrame([(e, x, y, e == model.best_epoch) for e, x, y in model.history],
                                 "epoch int, loss double, val_loss double, best boolean")


def score_samples(model: DirectionModel, blocks: DataFrame, keys: Sequence[str] = KEYS, ahead: bool = False) -> DataFrame:
    """(keys, date, use, target, p): probability of up for every sample; with
    ``ahead`` (E19 + I21) only for the row after each series' last one, dated as the last."""
    lookback, width = model.weights.shape
    types = {k: blocks.schema[k].dataType for k in keys}
    date = blocks.schema["date"].dataType.elementType
    w, b = model.weights, model.intercept
    arrow = pa.schema([*[(k, to_arrow_type(t)) for k, t in types.items()], ("date", to_arrow_type(date)),
                       ("use", pa.int32()), ("target", pa.int32()), ("p", pa.float64())])

    def tasks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                x, get, first = _own_rows(batch, i, width, lookback)
                n, begin, size = (batch.column(c)[i].as_py() for c in ("n", "begin", "size"))
                if ahead:
                    # the row after the last one belongs to the last block that holds its window
                    last = len(x) >= lookback and get["row"][-1] == n - 1 and begin <= n < begin + size
                    at = np.array([len(x)] if last else [], np.int64)
                else:
                    at = np.arange(first, len(x))
                if not len(at):
                    continue
                shown = at - 1 if ahead else at
                p = 1.0 / (1.0 + np.exp(-np.clip(_scores(x, at, w, b), -700, 700)))
                own = [batch.column(k).take(pa.array(np.full(len(at), i))) for k in keys]
                use = np.zeros(1, np.int32) if ahead else get["use"][at].astype(np.int32)
                target = pa.nulls(1, pa.int32()) if ahead else pa.array(get["target"][at].astype(np.int32))
                cols = [*own, batch.column("date")[i].values.take(pa.array(shown)), pa.array(use), target, pa.array(p)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    kinds = ", ".join(f"{k} {t.simpleString()}" for k, t in types.items())
    return blocks.mapInArrow(tasks, f"{kinds}, date {date.simpleString()}, use int, target int, p double")


def classifier_predictions(model: DirectionModel, blocks: DataFrame, threshold: float = THRESHOLD,
                           keys: Sequence[str] = KEYS) -> DataFrame:
    """Date, truth, probability of up and thresholded direction on test rows."""
    scored = score_samples(model, blocks, keys).where("use = 3")
    return scored.select(*keys, "date", F.col("target").alias("actual_direction"), F.col("p").alias("predicted_probability_up"),
                         (F.col("p") >= threshold).cast("int").alias("predicted_direction"))


def train_targets(blocks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, y, is_train): the labels of all samples."""
    rows = blocks.select(*keys, "begin", F.explode(F.arrays_zip("row", "target", "use")).alias("r"))
    return rows.where("r.row >= begin AND r.use > 0").select(*keys, F.col("r.target").alias("y"), (F.col("r.use") < 3).alias("is_train"))


def classifier_metrics(pred: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keys: Sequence[str] = KEYS) -> DataFrame:
    """I20 as long rows (keys, section, label, metric, value): accuracy, majority
    baseline, ROC-AUC and threshold; class weights of the training labels;
    precision, recall, F1 and support per class with the averages; and the
    confusion matrix (label = truth, metric = prediction). ``pred`` as from
    ``classifier_predictions``, ``labels`` as from ``train_targets``."""
    y = pred.select(*keys, F.col("actual_direction").alias("y"), F.col("predicted_direction").alias("yhat"),
                    F.col("predicted_probability_up").alias("p"))
    train, test = labels.where("is_train").select(*keys, "y"), labels.where("NOT is_train").select(*keys, "y")

    def rows(df: DataFrame, section: str, metrics: Sequence[str], label=None) -> DataFrame:
        items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        name = (F.lit(None) if label is None else F.col(label)).cast("string").alias("label")
        return df.select(*keys, F.lit(section).alias("section"), name, F.explode(items).alias("m")).select(
            *keys, "section", "label", "m.metric", "m.value")

    cells = EV.confusion_matrix(y, keys=keys).select(
        *keys, F.lit("confusion_matrix").alias("section"), F.col("y").cast("string").alias("label"),
        F.col("yhat").cast("string").alias("metric"), F.col("count").cast("double").alias("value"))
    scores = EV.classification_report(y, keys=keys).withColumn("prediction_threshold", F.lit(threshold))
    return (rows(scores, "scores", ["accuracy", "precision", "recall", "f1", "prediction_threshold"])
            .unionByName(rows(EV.majority_baseline(train, test, keys=keys), "baseline", ["majority_label", "baseline_accuracy"]))
            .unionByName(rows(EV.roc_auc(y, keys=keys), "ranking", ["roc_auc"]))
            .unionByName(rows(EV.class_weights(train, keys=keys), "class_weights", ["weight"], "label"))
            .unionByName(rows(EV.per_class_report(y, keys=keys), "per_class", ["precision", "recall", "f1", "support"], "label"))
            .unionByName(cells))


def next_day_probability(model: DirectionModel, blocks: DataFrame, threshold: float = THRESHOLD, keys: Sequence[str] = KEYS) -> DataFrame:
    """The latest window of every series scored, with its three-way direction."""
    p = score_samples(model, blocks, keys, ahead=True).select(*keys, "date", F.col("p").alias("lstm_garch_probability_up"))
    return p.withColumns({"threshold": F.lit(threshold),
                          "lstm_garch_predicted_direction": three_way_direction("lstm_garch_probability_up", threshold)})
