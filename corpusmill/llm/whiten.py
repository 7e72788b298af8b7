"""Whitening of embeddings: exact covariance, float32 eigenvectors, Ogita-Aishima refinement in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import materialize

SCALE, OFFSET = 1024, 100_000     # an entry c becomes floor(SCALE * c) + OFFSET
WIDEST = 2.0 ** 40                # entries whose integer is not below this in size are no numbers to whiten
COMPONENTS = 8
ROUNDS = 30                       # of refinement, a limit that convergence does not reach
EPS = 2.0 ** -52


# Products with more than double precision.

def _slices(a: np.ndarray, axis: int, parts: int = 3) -> list[np.ndarray]:
    """``a`` as a sum of matrices with so few bits that products of two of them, summed along ``axis``, are exact."""
    bits = int(np.ceil((53 + np.log2(max(2, a.shape[axis]))) / 2))
    out, rest = [], a.astype(np.float64)
    for _ in range(parts):
        most = np.abs(rest).max(axis=axis, keepdims=True, initial=0)
        anchor = np.where(most > 0, np.ldexp(0.75, np.frexp(most)[1] + bits), 0)
        part = (rest + anchor) - anchor
        out.append(part)
        rest = rest - part
    return out


def _add(high: np.ndarray, low: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(high + low) + term, with the rounding error of the sum kept in ``low``."""
    total = high + term
    back = total - high
    return total, low + ((high - (total - back)) + (term - back))


def product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a @ b as an unevaluated sum of two matrices, by exact products of slices."""
    high, low = np.zeros((a.shape[0], b.shape[1])), np.zeros((a.shape[0], b.shape[1]))
    left, right = _slices(a, 1), _slices(b, 0)
    for i, j in sorted(((i, j) for i in range(3) for j in range(3)), key=sum):
        high, low = _add(high, low, left[i] @ right[j])
    return high, low


def _residuals(high: np.ndarray, low: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """I - X'X, and X'VX as two parts, for V = high + low."""
    gram, rest = product(x.T, x)
    r = (np.eye(x.shape[1]) - gram) - rest
    image, image_low = product(high, x)
    s, s_low = product(x.T, image)
    return r, s, s_low + x.T @ (image_low + low @ x)


def _chains(values: np.ndarray, gap: float) -> list[slice]:
    """Runs of falling values whose neighbours are at most ``gap`` apart."""
    cuts = [0, *(np.flatnonzero(values[:-1] - values[1:] > gap) + 1).tolist(), len(values)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def refined_eigenvectors(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors of the symmetric high + low, to double precision.

    The start are float32 eigenvectors. A round corrects X by X E, where E
    follows from I - X'X and X'VX. Eigenvalues nearer to each other than the
    bound of the round's error are a cluster: there E only restores
    orthogonality, and a small eigenproblem on V less the cluster's mean turns
    the cluster's vectors. The error is squared by each round, so clusters
    break up until only values equal in double precision stay together.
    Signs: the largest entry of a vector is positive.
    """
    n = len(high)
    size = np.abs(high).max(initial=0)
    if not size:
        return np.zeros(n), np.eye(n)
    _, x = np.linalg.eigh((high / size).astype(np.float32))
    x = x[:, ::-1].astype(np.float64)
    before = np.inf
    for _ in range(ROUNDS):
        r, s, s_low = _residuals(high, low, x)
        values = (np.diag(s) + np.diag(s_low)) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        r, s, s_low = (m[np.ix_(order, order)] for m in (r, s, s_low))
        off = s - np.diag(np.diag(s))
        bound = 2 * (np.linalg.norm(off) + np.abs(values).max() * np.linalg.norm(r))
        runs = _chains(values, bound)
        with np.errstate(divide="ignore", invalid="ignore"):
            e = ((s + values * r) + s_low) / (values - values[:, None])
        np.fill_diagonal(e, np.diag(r) / 2)
        for run in runs:
            e[run, run] = r[run, run] / 2
        x = x + x @ e
        turned = 0.0
        for run in runs:
            if run.stop - run.start > 1:
                part = x[:, run]
                shift = values[run].mean()
                image, image_low = product(high, part)
                mean, mean_low = product(part, -shift * np.eye(part.shape[1]))
                shifted, lost = _add(image, image_low, mean)
                t = part.T @ (shifted + (lost + mean_low + low @ part))
                _, turn = np.linalg.eigh((t + t.T) / 2)
                turn = turn[:, ::-1]
                turn = turn * np.where(np.diag(turn) < 0, -1.0, 1.0)
                x[:, run] = part @ turn
                turned = max(turned, np.abs(turn - np.eye(len(turn))).max())
        change = max(np.abs(e).max(), turned)
        if change < 4 * EPS or before < 1e-9 and change > before / 2:
            break
        before = change
    x = x + x @ (_residuals(high, low, x)[0] / 2)
    values = np.einsum("ij,ij->j", x, product(high, x)[0] + low @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order] / np.linalg.norm(x[:, order], axis=0), values[order]
    return values, x * np.where(x[np.abs(x).argmax(axis=0), np.arange(n)] < 0, -1.0, 1.0)


# The distributed part.

def _integers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that count, and their entries as integers."""
    sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
    fits = np.asarray(column.is_valid()) & (sizes == dim)
    flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * flat) + OFFSET
        good = (np.isfinite(scaled) & (np.abs(scaled) < WIDEST)).all(axis=1)
    return np.flatnonzero(fits)[good], scaled[good].astype(np.int64)


def dimension(vectors: DataFrame, column: str = "embedding") -> int:
    """The most frequent length of a vector, the larger of equally frequent ones; 0 without vectors."""
    sizes = vectors.select(F.size(column).alias("size")).where("size > 0").groupBy("size").agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return top["size"] if top else 0


def sums(vectors: DataFrame, dim: int, column: str = "embedding") -> tuple[int, list[int]]:
    """Exact number of remaining rows and sums per dimension: each task adds up its rows, Spark the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            rows, x = _integers(batch.column(0), dim)
            n += len(rows)
            total += np.array(x.sum(axis=0).tolist() if len(x) < 1 << 22 else [sum(c) for c in x.T.tolist()], object)
        yield pa.RecordBatch.from_arrays([pa.array([n, *total.tolist()], pa.decimal128(38, 0)), pa.array(range(-1, dim), pa.int32())], ["part", "i"])

    rows = vectors.select(column).mapInArrow(run, "part decimal(38,0), i int").groupBy("i").agg(F.sum("part").cast("decimal(38,0)").alias("total")).collect()
    found = {r["i"]: int(r["total"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dim)]


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact y'y of integers below 2**41, as Python integers where doubles cannot hold it."""
    most = int(np.abs(y).max(initial=0))
    at_once = (1 << 52) // max(1, most * most)
    if at_once:
        parts = [y[i:i + at_once].astype(np.float64) for i in range(0, len(y), at_once)]
        total = np.zeros((y.shape[1],) * 2, np.int64)
        exact = sum(len(p) for p in parts) * most * most < 1 << 62
        total = total if exact else total.astype(object)
        for p in parts:
            g = (p.T @ p).astype(np.int64)
            total = total + (g if exact else g.astype(object))
        return total.astype(object)
    high, low = y >> 21, y & ((1 << 21) - 1)
    cross = lambda a, b: sum(((a[i:i + 256].astype(np.float64).T @ b[i:i + 256].astype(np.float64)).astype(np.int64).astype(object) for i in range(0, len(a), 256)), np.zeros((y.shape[1],) * 2, object))
    mixed = cross(high, low)
    return cross(high, high) * (1 << 42) + (mixed + mixed.T) * (1 << 21) + cross(low, low)


def covariance(vectors: DataFrame, dim: int, n: int, total: list[int], column: str = "embedding") -> tuple[np.ndarray, np.ndarray]:
    """Covariance of the integers, divisor n, as the sum of two double matrices.

    Rows are centred on the integers next to the means before they are
    multiplied; the products are summed exactly (one triangle of decimals per
    task), and the means' fractions are taken off exactly. So the result does
    not depend on partitions or order.
    """
    centre = np.array([(2 * t + n) // (2 * n) for t in total], np.int64)
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]), object)
        for batch in batches:
            _, x = _integers(batch.column(0), dim)
            total = total + _gram(x - centre)[upper]
        places = pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32())
        yield pa.RecordBatch.from_arrays([*places, pa.array([Decimal(v) for v in total.tolist()], pa.decimal128(38, 0))], ["i", "j", "part"])

    rows = vectors.select(column).mapInArrow(run, "i int, j int, part decimal(38,0)").groupBy("i", "j").agg(
        F.sum("part").cast("decimal(38,0)").alias("total")).collect()
    high, low = np.zeros((dim, dim)), np.zeros((dim, dim))
    rest = [t - n * int(c) for t, c in zip(total, centre)]
    for r in rows:
        exact = n * int(r["total"]) - rest[r["i"]] * rest[r["j"]]
        first = exact / (n * n)
        top, bottom = first.as_integer_ratio()
        second = (exact * bottom - top * n * n) / (n * n * bottom)
        for i, j in ((r["i"], r["j"]), (r["j"], r["i"])):
            high[i, j], low[i, j] = first, second
    return high, low


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) per remaining row; two arrays with an entry per component.

    Dropped are vectors that are null, empty, not of the most frequent length,
    or hold an entry that is null, not finite or of 2**30 and more (whose
    integers no long sum could hold). ``deviation`` is null where it exceeds a
    long. A component without variance (fewer distinct rows than components)
    has null in ``whitened`` and no part in ``identity_error``; ``explained``
    is null if nothing varies. Repeated rows and ids count each; an empty
    table gives no rows; other columns are not read. The driver gets n, the
    sums and one covariance, sized by the dimension alone.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    dim = dimension(vectors, column)
    n, total = sums(vectors, dim, column) if dim else (0, [])
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    high, low = covariance(vectors, dim, n, total, column)
    values, axes = refined_eigenvectors(high, low)
    kept = min(components, dim)
    live = values[:kept] > dim * EPS * values[0] if values[0] > 0 else np.zeros(kept, bool)
    directions = np.where(live, axes[:, :kept] / np.sqrt(np.where(live, values[:kept], 1)), 0)
    trace = np.trace(high)
    explained = [float(v) / float(trace) for v in np.maximum(values[:kept], 0)] if trace > 0 else [None] * kept
    centre = np.array([(2 * t + n) // (2 * n) for t in total], np.int64)
    rest = [t - n * int(c) for t, c in zip(total, centre)]
    shift = np.array([t / n for t in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _integers(batch.column(1), dim)
            y = x - centre
            white = (y - shift) @ directions
            most = n * (int(np.abs(y).max(initial=0)) + 1)
            wide = n * y - np.array(rest, np.int64) if dim * most * most < 1 << 62 else n * y.astype(object) - np.array(rest, object)
            squares = (wide ** 2).sum(axis=1).tolist()
            arrays = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel(), mask=~np.tile(live, len(white))), kept).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()), arrays],
                                             ["id", "deviation", "whitened"])

    rows = materialize(vectors.select(F.col(id_col).alias("id"), column).mapInArrow(run, f"id {id_type}, deviation bigint, whitened array<double>"), "whitened")
    error = identity_error(rows, [i for i in range(kept) if live[i]])
    return rows.select("id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.array(*[F.lit(v).cast("double") for v in explained]).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def identity_error(rows: DataFrame, live: list[int]) -> float | None:
    """Largest absolute entry of the covariance of ``whitened``, as measured over all rows, minus the identity."""
    if not live:
        return None
    w = {i: F.col("whitened")[i] for i in live}
    means = rows.agg(*[F.avg(w[i]).alias(f"m{i}") for i in live]).first()
    centred = {i: w[i] - F.lit(means[f"m{i}"]) for i in live}
    moments = rows.agg(*[F.avg(centred[i] * centred[j]) for i in live for j in live if i <= j]).first()
    identity = [float(i == j) for i in live for j in live if i <= j]
    return max(abs(m - t) for m, t in zip(moments, identity))


def components_of(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1 by falling eigenvalue."""
    return whitened.select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained"))).select(
        "id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error")
