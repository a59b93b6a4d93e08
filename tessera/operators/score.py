"""Model fitting and batch scoring.

Scoring runs where the rows are: ``mapInArrow`` hands each task Arrow
batches, the network weights travel once per executor as a broadcast, and
numpy does the matrix products per batch (float64). Softmax / arg-max over an
existing logits column stay JVM-side array expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, nan_to_zero, softmax


# ------------------------------------------------------------- weights
def rule_weights(rows: int, cols: int, salt: int, scale: float = 0.5) -> list:
    """Deterministic weights from a rule (for supplied-weight demos/tests):
    w[i][j] = scale · sin(1.7·i + 0.9·j + salt)."""
    return [[round(scale * float(np.sin(1.7 * i + 0.9 * j + salt)), 6) for j in range(cols)] for i in range(rows)]


def rule_bias(n: int, salt: int, scale: float = 0.1) -> list:
    return [round(scale * float(np.cos(1.3 * i + salt)), 6) for i in range(n)]


def mlp_weights(sizes, salt=0):
    """[(W, b)] for layer sizes [in, h1, …, out] (W is out × in)."""
    return [(rule_weights(sizes[i + 1], sizes[i], salt + i), rule_bias(sizes[i + 1], salt + i))
            for i in range(len(sizes) - 1)]


# ------------------------------------------------------------- forward passes (numpy, per batch)
def _relu(x):
    return np.maximum(x, 0.0)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))   # overflow-free logistic


def mlp_forward(X, layers):
    """Linear → ReLU → … → Linear."""
    h = X
    for i, (W, b) in enumerate(layers):
        h = h @ np.asarray(W).T + np.asarray(b)
        if i < len(layers) - 1:
            h = _relu(h)
    return h


def highway_forward(X, net):
    """Optional input projection; per layer x ← t·relu(Wx+b) + (1−t)·x with
    t = σ(Vx+c); output layer. Dropout is off at inference."""
    x = X
    if net.get("proj") is not None:
        W, b = net["proj"]
        x = x @ np.asarray(W).T + np.asarray(b)
    for (W, b), (V, c) in zip(net["layers"], net["gates"]):
        h = _relu(x @ np.asarray(W).T + np.asarray(b))
        t = _sigmoid(x @ np.asarray(V).T + np.asarray(c))
        x = t * h + (1.0 - t) * x
    W, b = net["out"]
    return x @ np.asarray(W).T + np.asarray(b)


def lstm_last(seq, lstm_layers):
    """Stacked LSTM (PyTorch gate order i, f, g, o) over one [T, F]
    sequence; returns the last step's top-layer hidden state."""
    x = np.asarray(seq, dtype=np.float64)
    for (Wih, Whh, bih, bhh) in lstm_layers:
        Wih, Whh = np.asarray(Wih), np.asarray(Whh)
        H = Whh.shape[1]
        h, c = np.zeros(H), np.zeros(H)
        out = np.zeros((x.shape[0], H))
        bias = np.asarray(bih) + np.asarray(bhh)
        for t in range(x.shape[0]):
            z = Wih @ x[t] + Whh @ h + bias
            i, f, g, o = _sigmoid(z[:H]), _sigmoid(z[H:2 * H]), np.tanh(z[2 * H:3 * H]), _sigmoid(z[3 * H:])
            c = f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
        x = out
    return x[-1] if x.shape[0] else np.zeros(np.asarray(lstm_layers[-1][1]).shape[1])


def lstm_last_batch(X, lstm_layers):
    """``lstm_last`` for a batch of equal-length sequences X[B, T, F]."""
    x = np.asarray(X, dtype=np.float64)
    B, T = x.shape[0], x.shape[1]
    for (Wih, Whh, bih, bhh) in lstm_layers:
        Wih, Whh = np.asarray(Wih), np.asarray(Whh)
        H = Whh.shape[1]
        h, c = np.zeros((B, H)), np.zeros((B, H))
        out = np.zeros((B, T, H))
        bias = np.asarray(bih) + np.asarray(bhh)
        for t in range(T):
            z = x[:, t, :] @ Wih.T + h @ Whh.T + bias
            i, f = _sigmoid(z[:, :H]), _sigmoid(z[:, H:2 * H])
            g, o = np.tanh(z[:, 2 * H:3 * H]), _sigmoid(z[:, 3 * H:])
            c = f * c + i * g
            h = o * np.tanh(c)
            out[:, t, :] = h
        x = out
    return x[:, -1, :] if T else np.zeros((B, np.asarray(lstm_layers[-1][1]).shape[1]))


def hybrid_forward_batch(seqs, statics, net):
    """Hybrid scores for many samples: sequences of equal length are run
    through the LSTM together (one matrix product per step per group)."""
    n = len(seqs)
    H = np.asarray(net["lstm"][-1][1]).shape[1]
    hl = np.zeros((n, H))
    by_len = {}
    for idx, s in enumerate(seqs):
        by_len.setdefault(len(s), []).append(idx)
    for L, idxs in by_len.items():
        if L == 0:
            continue
        X = np.stack([np.asarray([np.asarray(step, dtype=np.float64) for step in seqs[i]]) for i in idxs])
        hl[idxs] = lstm_last_batch(X, net["lstm"])
    Ws, bs = net["static"]
    S = np.vstack([np.asarray(st, dtype=np.float64) for st in statics])
    hs = _relu(S @ np.asarray(Ws).T + np.asarray(bs))
    z = np.concatenate([hl, hs], axis=1)
    W1, b1 = net["fc1"]
    W2, b2 = net["fc2"]
    return _relu(z @ np.asarray(W1).T + np.asarray(b1)) @ np.asarray(W2).T + np.asarray(b2)


def hybrid_forward(seq, static, net):
    """LSTM last step ∥ relu(static branch) → relu → logits."""
    hl = lstm_last(seq, net["lstm"])
    Ws, bs = net["static"]
    hs = _relu(np.asarray(Ws) @ np.asarray(static) + np.asarray(bs))
    z = np.concatenate([hl, hs])
    W1, b1 = net["fc1"]
    W2, b2 = net["fc2"]
    return np.asarray(W2) @ _relu(np.asarray(W1) @ z + np.asarray(b1)) + np.asarray(b2)


# ------------------------------------------------------------- Spark operators
def _finish(logits):
    logits = np.nan_to_num(logits, nan=0.0)             # E7
    m = logits.max(axis=1, keepdims=True)
    e = np.exp(logits - m)
    p = e / e.sum(axis=1, keepdims=True)
    return p, logits.argmax(axis=1)                      # first max on ties


def _score_rows(df: DataFrame, keep, col: str, forward, payload) -> DataFrame:
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(payload)
    keep = list(keep)
    schema = df.select(*keep).schema.simpleString()[len("struct<"):-1]
    out_schema = f"{schema}, logits array<double>, probability array<double>, prediction int" if keep else \
        "logits array<double>, probability array<double>, prediction int"

    def run(batches):
        import pyarrow as pa
        net = bc.value
        for b in batches:
            if b.num_rows == 0:
                continue
            # the list column's values as one matrix: no row becomes a Python object
            X = b.column(col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            logits = forward(X, net)
            p, yhat = _finish(logits)
            at = pa.array(np.arange(0, logits.size + 1, logits.shape[1]), pa.int32())
            made = [pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(m, np.float64).ravel())) for m in (logits, p)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *made, pa.array(yhat.astype(np.int32))],
                                             names=[*keep, "logits", "probability", "prediction"])
    return df.select(*keep, F.col(col).cast("array<double>").alias(col)).mapInArrow(run, out_schema)


def score_mlp(df: DataFrame, layers, col: str = "features", keep=("id",)) -> DataFrame:
    """Batch-score an MLP given [(W, b), …] (W: out × in)."""
    return _score_rows(df, keep, col, mlp_forward, [(np.asarray(W), np.asarray(b)) for W, b in layers])


def score_highway(df: DataFrame, net: dict, col: str = "features", keep=("id",)) -> DataFrame:
    """Batch-score a highway network (keys proj, layers, gates, out)."""
    return _score_rows(df, keep, col, highway_forward, net)


def score_hybrid(df: DataFrame, net: dict, seq_col: str = "seq", static_col: str = "static",
                 keep=("id",)) -> DataFrame:
    """E5: hybrid LSTM + static branch, one sample per row (unpadded
    sequence), parallel over subjects."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(net)
    keep = list(keep)
    schema = df.select(*keep).schema.simpleString()[len("struct<"):-1]

    def run(batches):
        n = bc.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            logits = hybrid_forward_batch(list(pdf[seq_col]), list(pdf[static_col]), n)
            p, yhat = _finish(logits)
            res = pdf[keep].copy()
            res["logits"] = list(logits)
            res["probability"] = list(p)
            res["prediction"] = yhat.astype("int32")
            yield res
    return df.select(*keep, seq_col, static_col).mapInPandas(
        run, f"{schema}, logits array<double>, probability array<double>, prediction int")


def softmax_argmax(df: DataFrame, logits: str = "logits", nan_zero: bool = True,
                   n_classes: int | None = None) -> DataFrame:
    """E6/E7 on an existing logits column: probabilities and arg-max, JVM-side
    (element-wise expressions when the class count is known)."""
    from tessera.functions.arrays import nan_to_zero_n
    if n_classes:
        lg = nan_to_zero_n(F.col(logits), n_classes) if nan_zero else F.col(logits)
    else:
        lg = nan_to_zero(F.col(logits)) if nan_zero else F.col(logits)
    return df.withColumn("_lg", lg).withColumn("probability", softmax(F.col("_lg"), n_classes)) \
             .withColumn("prediction", argmax(F.col("_lg"))).drop("_lg")


# ------------------------------------------------------------- fitting (distributed learners)
def fit_mlp(df: DataFrame, label: str, col: str = "features", hidden=(8,), seed=42, max_iter=100):
    """``MultilayerPerceptronClassifier`` (distributed L-BFGS). Its
    hidden units are sigmoid, not ReLU — a documented deviation."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector
    d = df.withColumn("_v", array_to_vector(col)).withColumn("_y", F.col(label).cast("double"))
    p = d.select(F.size(col)).first()[0]
    k = d.agg(F.max("_y")).first()[0]
    m = MultilayerPerceptronClassifier(featuresCol="_v", labelCol="_y", layers=[p, *hidden, int(k) + 1],
                                       seed=seed, maxIter=max_iter)
    return m.fit(d)


def fit_weighted_linear(df: DataFrame, label: str, weight: str, col: str = "features", reg: float = 0.0,
                        max_iter=200):
    """Class-weighted multinomial logistic regression (weighted
    cross-entropy); returns [(W, b)] usable by ``score_mlp``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    d = df.withColumn("_v", array_to_vector(col)).withColumn("_y", F.col(label).cast("double"))
    m = LogisticRegression(featuresCol="_v", labelCol="_y", weightCol=weight, family="multinomial",
                           regParam=reg, maxIter=max_iter).fit(d)
    return [(m.coefficientMatrix.toArray().tolist(), list(m.interceptVector.toArray()))]
