"""Near-duplicate embeddings by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import materialize
from corpusmill.llm.components import connected_components

SIMILARITY = 0.9
SAMPLE = 20_000        # most vectors that the lists and codes are fitted on, chosen by a hash
LIST_ROWS = 1024       # vectors that a coarse list is meant to hold
MOST_LISTS = 4096      # of coarse lists, so that their centres stay a small broadcast
WIDTH, CODES = 8, 256  # entries of a subspace, codes of a subspace
DEVIATIONS = 4.0       # two linked vectors find each other across a border up to so many deviations of their offset
BLOCK = 2048           # vectors of a list, and queries of it, that a task compares at once
ROUNDS = 8             # of k-means


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows without length stay zero."""
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ centres.T) + np.einsum("ij,ij->i", centres, centres), 0)


def kmeans(x: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x``, seeded far apart and moved ``ROUNDS`` times."""
    rng = np.random.default_rng(seed)
    x = x[np.lexsort(x.T[::-1])] if len(x) else x
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([_squares(x[i:i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)])
        order = np.argsort(near, kind="stable")
        held, first = np.unique(near[order], return_index=True)
        centres = centres.copy()
        centres[held] = np.add.reduceat(x[order], first, axis=0) / np.diff([*first, len(x)])[:, None]
        empty = np.setdiff1d(np.arange(len(centres)), held)
        centres[empty] = x[rng.choice(len(x), len(empty))]
    return centres


@dataclass
class Quantizer:
    """Centres of the lists, and per subspace the centres of residuals."""
    lists: np.ndarray       # (lists, dim)
    codes: np.ndarray       # (subspaces, codes, WIDTH)

    @property
    def padded(self) -> int:
        return self.codes.shape[0] * WIDTH

    def split(self, residual: np.ndarray) -> np.ndarray:
        """Residuals as (rows, subspaces, WIDTH), filled up with zeros."""
        return np.pad(residual, ((0, 0), (0, self.padded - residual.shape[1]))).reshape(len(residual), -1, WIDTH)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the distance of each from what its codes stand for."""
        parts = self.split(residual)
        out, error = np.empty(parts.shape[:2], np.uint8), np.zeros(len(parts))
        for m in range(parts.shape[1]):
            far = _squares(parts[:, m], self.codes[m])
            out[:, m] = far.argmin(axis=1)
            error += np.square(parts[:, m] - self.codes[m][out[:, m]]).sum(axis=1)
        return out, np.sqrt(error)

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of each residual's parts from all codes: (rows, subspaces, codes)."""
        parts = self.split(residual)
        return np.stack([_squares(parts[:, m], self.codes[m]) for m in range(parts.shape[1])], axis=1).astype(np.float32)

    def probes(self, x: np.ndarray, similarity: float, deviations: float = DEVIATIONS) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each row, and a mask of the lists to search.

        Two linked vectors are in two lists only on both sides of the plane
        between the centres. One finds the other if the nearer of them searches
        across, so a list is searched if its plane is within half the reach. The
        offset of linked vectors has length r = sqrt(2 - 2 similarity) at most,
        the largest reach, which misses none; along one direction it is
        r / sqrt(dim) in the mean square, and the reach is ``deviations`` of it.
        """
        far = _squares(x, self.lists)
        own = far.argmin(axis=1)
        apart = np.sqrt(_squares(self.lists, self.lists))[own]
        plane = (far - far[np.arange(len(x)), own][:, None]) / (2 * np.where(apart > 0, apart, 1))
        reach = min(1.0, deviations / np.sqrt(x.shape[1])) * np.sqrt(2 - 2 * similarity)
        return own, (plane <= reach / 2 + 1e-9) | (apart == 0)


def fit(sample: np.ndarray, rows: int) -> Quantizer:
    """Lists and codes from unit vectors, for a table of ``rows`` vectors."""
    lists = kmeans(sample, int(min(MOST_LISTS, max(1, rows // LIST_ROWS), max(1, len(sample) // 4))))
    residual = sample - lists[np.concatenate([_squares(sample[i:i + 4096], lists).argmin(axis=1) for i in range(0, len(sample), 4096)])]
    subspaces = -(-sample.shape[1] // WIDTH)
    empty = Quantizer(lists, np.zeros((subspaces, 1, WIDTH)))
    parts = empty.split(residual)
    books = [kmeans(parts[:, m], CODES, m) for m in range(subspaces)]
    return Quantizer(lists, np.stack(books))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Byte strings of doubles as rows, filled up with zeros to ``dim``; a power of two, which no cosine notices, brings each near 1."""
    out = np.zeros((len(column), dim))
    for i, value in enumerate(column.to_pylist()):
        row = np.frombuffer(value, np.float64)
        out[i, :len(row)] = row
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, keepdims=True, initial=0))[1])


def classes_of(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows (id, class) with a null class where a vector links with nothing, and classes (class, node, vector, rows, first) of equal vectors.

    ``vector`` is the entries as doubles without zeros at the end, so vectors
    of unequal length compare as if filled up with zeros; ``node`` numbers the
    classes, ``first`` is the smallest id.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for v in batch.column(1):
                x = np.zeros(0) if v.values is None else v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                good = len(x) and v.values.null_count == 0 and np.isfinite(x).all() and x.any()
                values.append(x[:np.flatnonzero(x)[-1] + 1].tobytes() if good else None)
                keys.append(xxhash.xxh3_128_digest(values[-1]) if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], ["id", "class", "vector"])

    rows = materialize(vectors.select(F.col(id_col).alias("id"), column).mapInArrow(run, f"id {id_type}, class binary, vector binary"), "vectors")
    classes = rows.where("class is not null").groupBy("class").agg(F.count("*").alias("rows"), F.min("id").alias("first"), F.first("vector").alias("vector"))
    return rows.select("id", "class"), materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


def index(classes: DataFrame, similarity: float = SIMILARITY, sample: int = SAMPLE, deviations: float = DEVIATIONS) -> tuple[DataFrame, Quantizer | None]:
    """Every class with its list, codes, code error and the lists that it searches; the fitted quantizer.

    The fit takes the ``sample`` classes of smallest hash at most, a bounded
    number; all classes are indexed.
    """
    total = classes.count()
    if not total:
        return classes, None
    share = int(min(1.0, 1.2 * sample / total) * (1 << 32))
    picked = classes.where(F.pmod(F.xxhash64("class"), F.lit(1 << 32)) < share).select("class", "vector").orderBy(F.xxhash64("class"), "class").limit(sample).collect()
    picked = picked or classes.select("class", "vector").limit(sample).collect()
    dim = classes.agg(F.max(F.length("vector"))).first()[0] // 8
    model = fit(unit(_matrix(pa.array([r["vector"] for r in picked], pa.binary()), dim)), total)
    shared = classes.sparkSession.sparkContext.broadcast((model.lists, model.codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Quantizer(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x = unit(_matrix(batch.column(2), dim))
                own, mask = model.probes(x, similarity, deviations)
                codes, error = model.encode(x - model.lists[own])
                probes = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(mask.sum(axis=1)))), pa.int32()), pa.array(np.nonzero(mask)[1], pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), probes],
                                                 ["node", "rows", "vector", "list", "code", "error", "probes"])

    return materialize(classes.select("node", "rows", "vector").mapInArrow(
        run, "node bigint, rows bigint, vector binary, list int, code binary, error double, probes array<int>"), "pq-index"), model


def _candidates(tables: np.ndarray, codes: np.ndarray, errors: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(queries, members) whose looked-up distance, less the error of the member's code, is within ``radius``.

    By the triangle inequality no pair within the radius is left out; the
    margin covers sums in single precision.
    """
    limit = (np.square(radius + errors) + 1e-4).astype(np.float32)
    columns = codes.T.astype(np.intp)
    far = np.take(tables[:, 0], columns[0], axis=1)
    for m in range(1, len(columns)):
        far += np.take(tables[:, m], columns[m], axis=1)
    return np.nonzero(far <= limit)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links that connect what all links (a, b) connect."""
    root: dict[int, int] = {}
    kept = []

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            kept.append(i)
    return np.array(kept, np.int64)


def search(indexed: DataFrame, model: Quantizer, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (a, b, n): ``n`` vectors linked to class ``a`` where b is null, else a link of a's and b's classes.

    Members and searching vectors of a list are dealt into blocks, so that a
    task holds two blocks whatever the size of a list. A task returns sums per
    vector and a spanning forest of the links it found, never the pairs. A
    link found from one side only counts for both.
    """
    spark = indexed.sparkSession
    shared = spark.sparkContext.broadcast((model.lists, model.codes))
    dim, radius = model.lists.shape[1], float(np.sqrt(2 - 2 * similarity))
    asked = indexed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count("*").alias("asked"))
    held = indexed.groupBy("list").agg(F.count("*").alias("held"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = F.broadcast(asked.join(held, "list").select("list", blocks("asked").alias("ask_blocks"), blocks("held").alias("held_blocks")))   # MOST_LISTS rows at most
    salt = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = indexed.join(sizes, "list").select("list", salt("held_blocks").alias("held_block"), every("ask_blocks").alias("ask_block"), "node", "rows", "vector", "code", "error", "probes")
    queries = indexed.select(F.explode("probes").alias("list"), F.col("list").alias("own"), "node", "rows", "vector").join(sizes, "list").select(
        F.col("list").alias("q_list"), every("held_blocks").alias("q_held"), salt("ask_blocks").alias("q_ask"), "own", F.col("node").alias("q_node"), F.col("rows").alias("q_rows"), F.col("vector").alias("q_vector"))

    def compare(members: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not members.num_rows or not queries.num_rows:
            return empty
        model = Quantizer(*shared.value)
        raw_m, raw_q = _matrix(members["vector"].combine_chunks(), dim), _matrix(queries["q_vector"].combine_chunks(), dim)
        node_m, rows_m, node_q, rows_q = (np.asarray(c) for c in (members["node"], members["rows"], queries["q_node"], queries["q_rows"]))
        codes = np.frombuffer(b"".join(members["code"].to_pylist()), np.uint8).reshape(members.num_rows, -1)
        errors, own = np.asarray(members["error"]), np.asarray(queries["own"])
        here = members["list"][0].as_py()
        searched = members["probes"].combine_chunks()
        answers = np.zeros((len(raw_m), len(model.lists)), bool)      # lists that each member searches itself
        answers[np.repeat(np.arange(len(raw_m)), np.diff(np.asarray(searched.offsets))), searched.flatten().to_numpy()] = True
        found_m, found_q = [], []
        for at in range(0, len(raw_q), 64):
            tables = model.tables(unit(raw_q[at:at + 64]) - model.lists[here])
            q, m = _candidates(tables, codes, errors, radius)
            for part in np.array_split(np.arange(len(q)), -(-len(q) // 16384)) if len(q) else ():
                x, y = q[part] + at, m[part]
                near = (node_q[x] != node_m[y]) & (cosines(raw_q[x], raw_m[y]) >= similarity)
                found_q.append(x[near])
                found_m.append(y[near])
        m, q = np.concatenate([*found_m, np.zeros(0, np.int64)]), np.concatenate([*found_q, np.zeros(0, np.int64)])
        lone = ~answers[m, own[q]]                                    # the member does not search the query's list
        counts_q = np.bincount(q, rows_m[m], len(raw_q)).astype(np.int64)
        counts_m = np.bincount(m[lone], rows_q[q[lone]], len(raw_m)).astype(np.int64)
        tree = _forest(node_q[q], node_m[m])
        keep_q, keep_m = np.flatnonzero(counts_q), np.flatnonzero(counts_m)
        a = np.concatenate([node_q[keep_q], node_m[keep_m], node_q[q[tree]]])
        n = np.concatenate([counts_q[keep_q], counts_m[keep_m], np.zeros(len(tree), np.int64)])
        b = np.concatenate([np.zeros(len(keep_q) + len(keep_m), np.int64), node_m[m[tree]]])
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=np.arange(len(a)) < len(keep_q) + len(keep_m)), "n": pa.array(n)})

    return materialize(members.groupBy("list", "held_block", "ask_block").cogroup(queries.groupBy("q_list", "q_held", "q_ask")).applyInArrow(compare, "a bigint, b bigint, n bigint"), "pq-links")


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, sample: int = SAMPLE, deviations: float = DEVIATIONS,
                    id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per row.

    Vectors that are null, empty, zero or hold null or non-finite entries link
    with nothing and are components of their own. Equal vectors are compared
    once and link each other. ``component_id`` is the smallest id of the
    component, null ids aside; ``kept`` marks the rows whose id it is, so all
    rows of a component that has none but null ids. Repeated rows count each.
    An empty table gives no rows; other columns are not read.
    """
    rows, classes = classes_of(vectors, id_col, column)
    indexed, model = index(classes, similarity, sample, deviations)
    if model is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = search(indexed, model, similarity)
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    roots = connected_components(found.where("b is not null").select("a", "b").distinct(), "a", "b")
    placed = classes.join(links, "node", "left").join(roots, "node", "left").select(
        "class", "first", (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = placed.join(smallest, "root").select("class", "n_links", "component_id")
    out = rows.join(of_class, "class", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
