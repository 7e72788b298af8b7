"""Near-duplicate embeddings against all cosines."""

import numpy as np
import pytest

from corpusmill.llm import pq
from corpusmill.llm.queries import QUERIES


def brute_force(vectors, similarity=0.9):
    """(n_links, component) per place; vectors that cannot link are None."""
    n = len(vectors)
    good = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    width = max((len(vectors[i]) for i in good), default=0)
    x = np.array([[*map(float, vectors[i]), *[0.0] * (width - len(vectors[i]))] for i in good]).reshape(len(good), width)
    x /= np.abs(x).max(axis=1, keepdims=True)
    norm = np.sqrt((x * x).sum(axis=1))
    linked = (x @ x.T) / (norm[:, None] * norm) >= similarity
    links, component = [0] * n, list(range(n))
    for k, i in enumerate(good):
        links[i] = int(linked[k].sum()) - 1
    seen = set()
    for k in range(len(good)):
        todo, group = [k], set()
        while todo:
            v = todo.pop()
            if v not in seen:
                seen.add(v)
                group.add(v)
                todo += np.flatnonzero(linked[v]).tolist()
        for v in group:
            component[good[v]] = good[min(group)]
    return links, component


def clustered(rng, dim=32, groups=40, size=12, hot=400):
    centres = rng.normal(size=(groups, dim))
    near = [c + rng.normal(size=dim) * s for c in centres for s in rng.uniform(0.05, 0.4, size)]
    crowd = rng.normal(size=dim)
    return near + [crowd + rng.normal(size=dim) * 0.15 for _ in range(hot)] + [rng.normal(size=dim) for _ in range(600)]


@pytest.mark.parametrize("block", [pq.BLOCK, 64])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(pq, "BLOCK", block)
    monkeypatch.setattr(pq, "LIST_ROWS", 100)
    vectors = clustered(np.random.default_rng(1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>").repartition(6)
    links, component = brute_force(vectors)
    got = {r.id: r for r in pq.near_duplicates(table).collect()}
    assert sum(links) > 100_000 and len(got) == len(vectors)
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(links)
    assert np.mean([got[i].component_id == c and got[i].kept == (c == i) for i, c in enumerate(component)]) > 0.99


def test_all_lists_give_all_links(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST_ROWS", 50)
    vectors = clustered(np.random.default_rng(2), dim=20, hot=100)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    links, component = brute_force(vectors)
    got = {r.id: r for r in pq.near_duplicates(table, deviations=1e9).collect()}
    assert [(got[i].n_links, got[i].component_id) for i in range(len(vectors))] == list(zip(links, component))


def test_query_by_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    links, component = brute_force([r.embedding for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op12_pq_near_duplicates"](spark, sf_dir).collect()}
    assert [got[r.vec_id] for r in rows] == [(n, rows[c].vec_id, i == c) for i, (n, c) in enumerate(zip(links, component))]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (None, [1.0, 0.1]), (9, None), (9, None), (8, []), (7, [0.0, 0.0]), (6, [nan, 1.0]), (2, [inf, 1.0]),
            (1, [None, 1.0]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (4, [1.0]), (11, [1e300, 1e200]), (12, [1e-320, -1e-320])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as node", "'a' as class", "2 as rows").repartition(3)
    got = sorted(((r.id is None, r.id, r.n_links, r.component_id, r.kept) for r in pq.near_duplicates(table).collect()), key=str)
    first = 6      # 5, both 3, a null id, 4 and 11 point the same way
    want = [(False, i, first - 1, 3, i == 3) for i in (5, 3, 3, 4, 11)] + [(True, None, first - 1, 3, False)] + [
        (False, i, 0, i, True) for i in (9, 9, 8, 7, 6, 2, 1, 12)] + [(True, None, 1, None, True)] * 2
    assert got == sorted(want, key=str)


def test_tables_without_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert pq.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in pq.near_duplicates(spark.createDataFrame([(1, [0.0])], schema)).collect()] == [(1, 0, 1, True)]


def test_looked_up_distances_leave_nothing_out():
    rng = np.random.default_rng(3)
    x = pq.unit(rng.normal(size=(500, 20)))
    model = pq.fit(x, 3000)
    own = pq._squares(x, model.lists).argmin(axis=1)
    here = np.flatnonzero(own == own[0])
    codes, errors = model.encode(x[here] - model.lists[own[0]])
    decoded = np.stack([model.codes[m][codes[:, m]] for m in range(codes.shape[1])], axis=1).reshape(len(here), -1)
    assert np.allclose(errors, np.linalg.norm(model.split(x[here] - model.lists[own[0]]).reshape(len(here), -1) - decoded, axis=1))
    tables = model.tables(x[:50] - model.lists[own[0]])
    for radius in (0.3, 0.9):
        found = set(zip(*(v.tolist() for v in pq._candidates(tables, codes, errors, radius))))
        assert {(i, j) for i in range(50) for j in np.flatnonzero(np.linalg.norm(x[here] - x[i], axis=1) <= radius).tolist()} <= found


def test_a_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 60, 80), rng.integers(0, 60, 80)

    def groups(pairs):
        part = {v: {v} for v in range(60)}
        for x, y in pairs:
            if part[x] is not part[y]:
                part[x] |= part[y]
                for v in part[y]:
                    part[v] = part[x]
        return {frozenset(p) for p in part.values()}

    kept = pq._forest(a, b)
    assert groups(zip(a.tolist(), b.tolist())) == groups(zip(a[kept].tolist(), b[kept].tolist())) and len(kept) < 60
