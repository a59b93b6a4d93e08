"""Training of linear-ReLU-…-linear networks with class weights.

The loss and its gradient over all rows are one Spark aggregate a step: each
task runs its Arrow batches through the network and back and adds up, and the
partial sums are added by weight position. The driver holds the weights and
the last few steps only, and moves by L-BFGS until the loss stops falling.
Without hidden layers it is the class-weighted multinomial logistic regression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import written


def unpack(theta: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(W, b), …] of one vector; W is out × in."""
    out, at = [], 0
    for n, m in zip(sizes, sizes[1:]):
        out.append((theta[at:at + n * m].reshape(m, n), theta[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def initial(sizes: list[int], seed: int) -> np.ndarray:
    """Weights of spread sqrt(2 / inputs), no offsets."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.concatenate([rng.normal(0, np.sqrt(2 / n), n * m), np.zeros(m)]) for n, m in zip(sizes, sizes[1:])])


def batch_loss(theta: np.ndarray, sizes: list[int], x: np.ndarray, c: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of weighted cross-entropies of some rows, and its gradient."""
    layers = unpack(theta, sizes)
    at = [x]
    for i, (weights, offset) in enumerate(layers):
        z = at[-1] @ weights.T + offset
        at.append(np.maximum(z, 0.0) if i < len(layers) - 1 else z)
    z = at.pop()
    z = z - z.max(1, keepdims=True)
    e = np.exp(z)
    total = e.sum(1)
    loss = float((w * (np.log(total) - z[np.arange(len(c)), c])).sum())
    back = e / total[:, None]
    back[np.arange(len(c)), c] -= 1.0
    back *= w[:, None]
    parts = []
    for (weights, _), h in zip(reversed(layers), reversed(at)):
        parts.append(np.concatenate([(back.T @ h).ravel(), back.sum(0)]))
        back = (back @ weights) * (h > 0)
    return loss, np.concatenate(parts[::-1])


def full_loss(rows: DataFrame, sizes: list[int], theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over all rows ``x`` array<double>, ``c`` class index, ``w`` weight."""
    shared = rows.sparkSession.sparkContext.broadcast(theta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value) + 1)
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                loss, gradient = batch_loss(shared.value, sizes, x, b.column("c").to_numpy(), b.column("w").to_numpy())
                total[0] += loss
                total[1:] += gradient
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    got = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(len(theta) + 1)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    shared.unpersist()
    return float(out[0]), out[1:]


@dataclass
class Fit:
    """Weights [(W, b), …] for ``score_mlp``, the classes in order, the mean loss, steps taken, and whether it stopped by itself."""

    layers: list
    classes: list
    loss: float
    steps: int
    converged: bool


def lbfgs(fun: Callable, theta: np.ndarray, tol: float, max_steps: int | None, memory: int = 10) -> tuple[np.ndarray, float, int, bool]:
    """Minimum of ``fun`` (value and gradient): steps until the value falls by less than ``tol`` of itself (or of ``tol`` itself) five
    times running, or no step along the direction lowers it. ``max_steps``: none by default."""
    value, gradient = fun(theta)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    small = steps = 0
    while max_steps is None or steps < max_steps:
        q, alphas = gradient.copy(), []
        for s, y in reversed(pairs):
            alphas.append(s @ q / (s @ y))
            q -= alphas[-1] * y
        if pairs:
            s, y = pairs[-1]
            q *= s @ y / (y @ y)
        else:
            q /= max(1.0, float(np.abs(gradient).sum()))
        for (s, y), alpha in zip(pairs, reversed(alphas)):
            q += s * (alpha - y @ q / (s @ y))
        slope = -(gradient @ q)
        if slope > -1e-300:
            return theta, value, steps, True
        step = 1.0
        while True:
            new = theta - step * q
            new_value, new_gradient = fun(new)
            if np.isfinite(new_value) and new_value <= value + 1e-4 * step * slope:
                break
            step /= 4
            if step < 1e-12:
                if not pairs:
                    return theta, value, steps, True
                pairs, step = [], None  # the curvature misled: once more along the gradient
                break
        if step is None:
            continue
        steps += 1
        s, y = new - theta, new_gradient - gradient
        if s @ y > 1e-12 * (y @ y) ** 0.5 * (s @ s) ** 0.5:
            pairs = [*pairs, (s, y)][-memory:]
        small = small + 1 if value - new_value <= tol * max(abs(value), tol) else 0
        theta, value, gradient = new, new_value, new_gradient
        if small == 5:
            return theta, value, steps, True
    return theta, value, steps, False


def fit_network(df: DataFrame, label: str, col: str = "features", hidden=(8,), weight: str | None = None, l2: float = 0.0, seed: int = 42,
                tol: float = 1e-6, max_steps: int | None = None) -> Fit:
    """Network of ``hidden`` ReLU layers (none: linear) that minimises the mean weighted cross-entropy, as the
    library's loss with class weights does (sum of w · loss over sum of w), plus l2/2 of the squared weights.

    Rows without a label do not count. Full-batch steps until the loss stops falling; ``max_steps`` may end them earlier, which
    ``Fit.converged`` then tells.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = df.where(F.col(label).isNotNull()).select(F.col(col).cast("array<double>").alias("x"), F.col(label).alias("y"), w.alias("w"))
    d = written(d, "training")
    classes = sorted(r["y"] for r in d.select("y").distinct().collect())  # as many as the network has outputs
    if not classes:
        return Fit([], [], 0.0, 0, True)
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")) - 1
    rows = written(d.select("x", index.cast("int").alias("c"), "w"), "training")
    first = rows.agg(F.sum("w").alias("w"), F.max(F.size("x")).alias("p")).first()
    sizes = [first["p"], *hidden, len(classes)]
    decay = np.concatenate([np.concatenate([np.ones(n * m), np.zeros(m)]) for n, m in zip(sizes, sizes[1:])]) * l2

    def fun(theta: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = full_loss(rows, sizes, theta)
        return loss / first["w"] + 0.5 * float((decay * theta * theta).sum()), gradient / first["w"] + decay * theta

    start = initial(sizes, seed) if hidden else np.zeros(sum(n * m + m for n, m in zip(sizes, sizes[1:])))
    theta, loss, steps, converged = lbfgs(fun, start, tol, max_steps)
    return Fit([(a.tolist(), b.tolist()) for a, b in unpack(theta, sizes)], classes, loss, steps, converged)
