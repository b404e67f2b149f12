"""Next-day learners over rows that are never stored: each look at them adds up numbers in the tasks that make them (ML-11).

A source is a DataFrame and ``blocks``, which makes of an Arrow batch blocks of rows of the first to the last part wanted: (part, delta, y,
y_lag1, weight, raw), with part 0 to learn, 1 to stop, 2 held out, and raw an array of features by rows. Spark adds the tasks' sums; the driver takes steps on them.
"""

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Deviations from which a residual counts linearly, weight of the squared coefficients of standardised features, and steps at most.
EPSILON, RIDGE, ROUNDS = 1.35, 1e-4, 30
#: Cells of a feature's values, of which bins are made up; bins; rows in a block of them.
CELLS, BINS, BLOCK = 512, 32, 8192


def packed(source: DataFrame) -> DataFrame:
    """``source`` as Arrow streams of some hundred rows each, so that nested columns are taken apart once for many looks."""

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema) as stream:
                    stream.write_batch(batch.slice(k, 512))
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], ["packed"])

    return source.mapInArrow(pack, "packed binary")


def unpacked(batches: Iterable) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        if batch.schema.names == ["packed"]:
            for x in batch.column(0).to_pylist():
                yield from pa.ipc.open_stream(x)
        else:
            yield batch


def sums(source: DataFrame, add: Callable[[Iterable], np.ndarray], length: int = 0) -> np.ndarray:
    """The sum over tasks of the numbers that ``add`` makes of a task's batches, at least ``length`` of them."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        v = np.asarray(add(unpacked(batches)), float).ravel()
        at = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype("int32")), pa.array(v[at])], ["at", "v"])

    told = source.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    at, v = told.column("at").to_numpy(), told.column("v").to_numpy()
    out = np.zeros(max(length, int(at.max()) + 1 if len(at) else 0))
    out[at] = v
    return out


def spread_of(source: DataFrame, blocks: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and reciprocal deviation of each feature (0 where it has none), and (weight, mean, deviation) of delta, over the rows to learn from."""

    def add(batches):
        out = np.zeros(0)
        for batch in batches:
            for _, delta, _, _, w, x in blocks(batch, (0, 0)):
                head = [x.shape[1], w.sum(), w @ delta, w @ delta**2]
                out = out if len(out) else np.concatenate([[1, len(x)], np.zeros(4 + 2 * len(x))])
                out[2:] += np.concatenate([head, x.sum(1), np.einsum("ij,ij->i", x, x)])
        return out

    v = sums(source, add, 2)
    if not v[0]:
        raise ValueError("there are no rows to learn from")
    k = round(v[1] / v[0])
    v = np.concatenate([v, np.zeros(6 + 2 * k - len(v))])
    n, w, s, ss = v[2:6]
    mean = v[6 : 6 + k] / n
    var = v[6 + k :] / n - mean**2
    flat = var <= 1e-12 * np.maximum(mean**2, 1e-6)
    return mean, np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, var))), np.array([w, s / w, np.sqrt(max(ss / w - (s / w) ** 2, 0.0))])


def robust_linear(source: DataFrame, blocks: Callable, mean: np.ndarray, inverse: np.ndarray, label: np.ndarray) -> dict:
    """Huber's regression with its scale, as Spark ML states it: Newton steps on the whole sum, each from one look at all rows, until it is at its least."""
    k, total = len(mean), label[0]

    def look(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        beta, scale = at[: k + 1], at[k + 1]

        def add(batches):
            loss, slope, bend = 0.0, np.zeros(k + 2), np.zeros((k + 2, k + 2))
            for batch in batches:
                for _, delta, _, _, weight, raw in blocks(batch, (0, 0)):
                    z = np.ones((k + 2, len(delta)))
                    np.subtract(raw, mean[:, None], out=z[:k])
                    z[:k] *= inverse[:, None]
                    r, w = delta - beta @ z[: k + 1], weight / total
                    near = np.abs(r) <= EPSILON * scale
                    z[k + 1] = r / scale
                    loss += 0.5 * (w @ np.where(near, scale + r**2 / scale, scale + 2 * EPSILON * np.abs(r) - scale * EPSILON**2))
                    slope[: k + 1] -= z[: k + 1] @ (w * np.where(near, r / scale, EPSILON * np.sign(r)))
                    slope[k + 1] += 0.5 * (w @ np.where(near, 1 - (r / scale) ** 2, 1 - EPSILON**2))
                    z *= np.sqrt(w * near / scale)
                    bend += z @ z.T
            return np.concatenate([[loss], slope, bend.ravel()])

        v = sums(source, add, 1 + (k + 2) * (k + 3))
        v, slope, bend = v[0], v[1 : k + 3], v[k + 3 :].reshape(k + 2, k + 2)
        ridge = np.r_[np.full(k, RIDGE), 0, 0]
        return v + 0.5 * (ridge * at) @ at, slope + ridge * at, bend + np.diag(ridge + 1e-12)

    at = np.r_[np.zeros(k), label[1], max(label[2], 1e-9)]
    loss, slope, bend = look(at)
    for _ in range(ROUNDS):
        step = -np.linalg.solve(bend, slope)
        if -(slope @ step) < 1e-9 * abs(loss) or at[k + 1] <= 1e-9:
            break
        share = 1.0 if at[k + 1] + step[k + 1] > 0.1 * at[k + 1] else 0.9 * at[k + 1] / -step[k + 1]
        for _ in range(10):
            to = at + share * step
            found = look(to)
            if found[0] <= loss:
                break
            share /= 4
        if found[0] > loss:
            break
        at, (loss, slope, bend) = to, found
    beta = at[:k] * inverse
    return {"intercept": float(at[k] - beta @ mean), "coefficients": beta.tolist()}


def cells(raw: np.ndarray, mean: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Which of ``CELLS`` cells each value lies in: narrow at the mean, wider far from it, without end on both sides."""
    z = (raw - mean[:, None]) * inverse[:, None]
    z /= 1 + np.abs(z)
    z += 1
    z *= CELLS // 2
    return np.minimum(z.astype("uint16"), CELLS - 1)


def bins_of(source: DataFrame, blocks: Callable, mean: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """The bin of each feature's cells: cells are put together so that bins hold about as many rows, by the counts of all rows to learn from."""
    k = len(mean)

    def add(batches):
        out = np.zeros((k, CELLS))
        for batch in batches:
            for *_, raw in blocks(batch, (0, 0)):
                c = cells(raw, mean, inverse)
                for f in range(k):
                    out[f] += np.bincount(c[f], minlength=CELLS)
        return out

    n = sums(source, add, k * CELLS).reshape(k, CELLS)
    before = np.cumsum(n, 1) - n
    return np.minimum(before * BINS / np.maximum(n.sum(1, keepdims=True), 1), BINS - 1).astype("uint8")


def leaves(tree: list, x: np.ndarray, levels: int | None = None) -> np.ndarray:
    """The node after some levels that each row comes to; ``tree`` has (feature, cut) of each split by level, and values above the cut go right."""
    node = np.zeros(x.shape[1], "uint8")
    for level in range(len(tree) if levels is None else levels):
        right = np.zeros(x.shape[1], bool)
        for j, (f, cut) in enumerate(tree[level]):
            if f >= 0:
                right |= (node == j) & (x[f] > cut)
        node = 2 * node + right
    return node


def summed_trees(trees: list, x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape[1])
    for tree, values in trees:
        out += np.asarray(values)[leaves(tree, x)]
    return out


def boosted_trees(source: DataFrame, blocks: Callable, mean: np.ndarray, inverse: np.ndarray, bin_of: np.ndarray, most: int, depth: int, step: float) -> dict:
    """Boosted regression trees as Spark ML grows them, until the error on the rows to stop by rises: squared loss, the first tree whole, others by ``step``.

    Rows are kept as the bins of their features, a byte each, in blocks, while the trees grow. A level is one look, at which only the lesser child of a split
    is counted; the other is its parent's rest.
    """
    k = len(mean)

    def pack(batches):
        import pyarrow as pa

        held, n = [], 0
        names = ["bins", "delta", "weight", "learn"]

        def out():
            told = [np.concatenate(c, -1) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in told], names)

        for batch in batches:
            for part, delta, _, _, weight, raw in blocks(batch, (0, 1)):
                c = cells(raw, mean, inverse)
                held.append((np.stack([bin_of[f][c[f]] for f in range(k)]), delta, weight, part == 0))
                n += len(part)
                if n >= BLOCK:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    def read(batches):
        for batch in batches:
            for b, d, w, u in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                yield np.frombuffer(b, "uint8").reshape(k, -1), np.frombuffer(d), np.frombuffer(w), np.frombuffer(u, bool)

    kept_rows = source.mapInArrow(pack, "bins binary, delta binary, weight binary, learn binary").persist()
    trees: list = []

    def count(tree: list, wanted: list[int]) -> tuple[float, np.ndarray]:
        """Weighted squared error of the trees so far on the rows to stop by, and (weight, weighted label) of each wanted node, feature and bin."""
        place = np.full(256, 255, "uint8")
        place[wanted] = np.arange(len(wanted))
        size = max(len(wanted), 1) * BINS
        told, level = list(trees), len(tree)
        known = level == 0 and len(trees) > 0

        def add(batches):
            out, off = np.zeros((2, k, size)), 0.0
            for x, delta, weight, learn in read(batches):
                rest = delta - summed_trees(told, x)
                if level == 0:
                    off += weight[~learn] @ rest[~learn] ** 2
                node = place[leaves(tree, x)]
                at = np.flatnonzero(learn & (node < 255))
                if len(at):
                    w = weight[at]
                    s, start = w * rest[at], node[at].astype("intp") * BINS
                    for f in range(k):
                        key = start + x[f][at]
                        out[1, f] += np.bincount(key, s, size)
                        if not known:
                            out[0, f] += np.bincount(key, w, size)
            return np.concatenate([[off], out.ravel()])

        v = sums(kept_rows, add, 1 + 2 * k * size)
        return v[0], v[1:].reshape(2, k, -1, BINS).transpose(2, 0, 1, 3)

    try:
        best, kept = np.inf, 0
        while True:
            off, found = count([], [0] if len(trees) < most else [])
            if trees and off > best:
                break
            if trees and (off < best or off == 0):
                best, kept = off, len(trees)
            if len(trees) == most:
                break
            if trees:
                found[0, 0] = weights  # the same for each tree
            else:
                weights = found[0, 0].copy()
            nodes = [found[0]]
            tree: list = []
            for level in range(depth):
                splits = [_split(h) for h in nodes]
                tree.append([s[:2] for s in splits])
                if level == depth - 1:
                    break
                lesser = [2 * j + int(s[2] > s[3]) for j, s in enumerate(splits) if s[0] >= 0]  # of a split's weights left and right
                got = dict(zip(lesser, count(tree, lesser)[1], strict=True)) if lesser else {}
                below = []
                for j, s in enumerate(splits):
                    for c in (2 * j, 2 * j + 1):
                        below.append(got[c] if c in got else nodes[j] - got[c ^ 1] if s[0] >= 0 else nodes[j] * (c == 2 * j))
                nodes = below
            label = 1.0 if not trees else 2 * step  # the loss's slope is twice the rest
            values = []
            for h, (f, cut) in zip(nodes, tree[-1], strict=True):
                both = h[:, max(f, 0)].cumsum(1)
                left, right = (both[:, cut], both[:, -1] - both[:, cut]) if f >= 0 else (both[:, -1], np.zeros(2))
                values += [float(label * s / w) if w > 0 else 0.0 for w, s in (left, right)]
            trees.append((tree, values))
    finally:
        kept_rows.unpersist()
    top = np.array([[np.flatnonzero(bin_of[f] <= b)[-1] if (bin_of[f] <= b).any() else -1 for b in range(BINS)] for f in range(k)])  # a bin's last cell
    told = [([[(int(f), int(top[f, cut]) if f >= 0 else 0) for f, cut in level] for level in tree], values) for tree, values in trees[: kept or most]]
    return {"mean": mean.tolist(), "inverse": inverse.tolist(), "trees": told}


def _split(h: np.ndarray) -> tuple[int, int, float, float]:
    """(feature, last bin that goes left, weights left and right) of the split that lowers the squared error most; feature -1 if none does."""
    w, s = h.cumsum(2)
    total, whole = w[:, -1:], s[:, -1:]
    rest = total - w
    fine = (w > 1e-9 * total) & (rest > 1e-9 * total)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fine, s**2 / w + (whole - s) ** 2 / rest - whole**2 / total, -np.inf)
        floor = 1e-12 * np.abs(whole[0, 0] ** 2 / total[0, 0]) if total[0, 0] > 0 else 0.0
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return (int(f), int(b), float(w[f, b]), float(rest[f, b])) if gain[f, b] > floor else (-1, 0, 0.0, 0.0)


def predicted(model: dict, raw: np.ndarray) -> np.ndarray:
    """The model's delta of each row of ``raw`` (features by rows); the same for a row in any block."""
    if "trees" in model:
        return summed_trees(model["trees"], cells(raw, np.array(model["mean"]), np.array(model["inverse"])))
    out = np.full(raw.shape[1], model["intercept"])
    for c, x in zip(model["coefficients"], raw, strict=True):
        out += c * x
    return out


def errors(source: DataFrame, blocks: Callable, models: list[dict]) -> list[tuple]:
    """(rows, mae, rmse, weighted mae) of each model's level on the rows held out, at one look."""

    def add(batches):
        out = np.zeros((len(models), 5))
        for batch in batches:
            for _, _, y, last, w, x in blocks(batch, (2, 2)):
                for i, model in enumerate(models):
                    e = np.abs(last + predicted(model, x) - y)
                    out[i] += [len(e), e.sum(), e @ e, w @ e, w.sum()]
        return out

    told = sums(source, add, 5 * len(models)).reshape(-1, 5)
    return [(int(n), float(e / n), float(np.sqrt(ee / n)), float(we / w)) if n else (0, None, None, None) for n, e, ee, we, w in told]


class DeltaModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A learned model as a stage that Spark ML stores and loads: ``prediction`` of the vector ``raw``."""

    told = Param(Params._dummy(), "told", "the model's numbers as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, told: str = "{}") -> None:
        super().__init__()
        self._set(told=told)

    def model(self) -> dict:
        return json.loads(self.getOrDefault(self.told))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        model = self.model()

        def told(raw: pd.Series) -> pd.Series:
            return pd.Series(predicted(model, np.stack(raw.to_numpy()).T) if len(raw) else [], dtype=float)

        return dataset.withColumn("prediction", F.pandas_udf(told, "double")(vector_to_array("raw")))
