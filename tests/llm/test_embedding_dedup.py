import math

import numpy as np
import pyarrow as pa

from brambler.llm import embedding_dedup
from brambler.llm.common import NO_ID
from brambler.llm.embedding_dedup import near_vectors, op3_embedding_dedup


def rows():
    rng = np.random.default_rng(4)
    out, n = [], 0
    for _ in range(40):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 12)):
            out.append((n, [float(x) for x in base + rng.standard_normal(16) * rng.choice([0.0, 0.02, 0.1, 0.2])], int(rng.integers(0, 2))))
            n += 1
    out += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [1.0, None] + [0.0] * 14, 1), (n + 3, [math.nan] * 16, 1), (n + 4, out[0][1], None), (n + 5, [2.0] * 3, 0), (n + 6, [1e300] * 16, 0), (n + 7, [1e-300] * 16, 0), (n + 8, [], 0)]
    return out


def brute(data):
    ids, links = [r[0] for r in data], {r[0]: set() for r in data}
    ok = [r for r in data if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v[1]) / max(abs(c) for c in v[1]) for v in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[a[0]].add(b[0])
                    links[b[0]].add(a[0])
    group = {}
    for i in ids:
        if i not in group:
            todo = [i]
            while todo:
                v = todo.pop()
                if v not in group:
                    group[v] = i
                    todo += links[v]
    return {i: (len(links[i]), group[i]) for i in ids}


def check(spark):
    data = rows()
    frame = spark.createDataFrame([(*r, 1.0) for r in data], "vec_id long, embedding array<double>, label int, weight double").repartition(3)
    assert {r.id: (r.n_links, r.component_id) for r in near_vectors(frame).collect()} == brute(data)


def test_against_brute_force(spark):
    check(spark)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 3)
    check(spark)


def test_odd_tables(spark, tmp_path):
    frame = spark.createDataFrame([(None, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (8, [2.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op3_embedding_dedup(spark, f"file://{tmp_path}").collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got) == [("7", 1, 7, True), ("8", 0, 8, True), ("None", 1, 7, False)]
    assert near_vectors(frame.limit(0)).count() == 0


def test_large_and_small_cells_agree(monkeypatch):
    """Cells of many members are compared row by row, small ones side by side; both count the same links."""
    rng = np.random.default_rng(6)
    x = np.repeat(rng.standard_normal((6, 8)), 5, 0) + rng.standard_normal((30, 8)) * 0.1
    hashes = np.sort(rng.integers(0, 3, (30, embedding_dedup.TABLES)).astype(np.int64) + np.arange(embedding_dedup.TABLES) * 10, 0)
    rows = []
    for t in (0, 3):
        for c in np.unique(hashes[:, t]):
            own = np.flatnonzero(hashes[:, t] == c)
            rows += [{"rep": int(i), "side": 0, "weight": 1 + int(i) % 2, "cell": int(c), "p": 0, "q": 0, "size": 64, "vector": x[i].tobytes(), "hashes": hashes[i].tobytes()} for i in own]
    found = []
    for few in (1, 2, 32):
        monkeypatch.setattr(embedding_dedup, "FEW", few)
        out = embedding_dedup._compare(pa.Table.from_pylist(rows)).to_pylist()
        found.append((sorted((r["a"], r["n"]) for r in out if r["b"] is None), {frozenset((r["a"], r["b"])) for r in out if r["b"] is not None}))
    assert found[0][0] == found[1][0] == found[2][0] and found[2][0]
    assert found[0][1] <= found[2][1]


def test_vectors_that_share_an_id(spark):
    """Null and repeated ids: each row is linked by its own components."""
    a, b, c, d = np.eye(4).tolist()
    near = lambda v: [x + 0.01 for x in v]
    data = [(2, a), (3, b), (None, near(a)), (None, near(b)), (7, c), (7, d), (7, near(a)), (9, near(d)), (None, c), (None, c), (5, None), (None, None)]
    want = [(2, 2, 2), (3, 1, 3), (None, 2, 2), (None, 1, 3), (7, 2, 7), (7, 1, 7), (7, 2, 2), (9, 1, 7), (None, 2, 7), (None, 2, 7), (5, 0, 5), (None, 0, None)]
    for k in (1, 4):
        frame = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, label int").repartition(k)
        got = sorted((r.id, r.n_links, r.component_id) for r in near_vectors(frame).collect())
        assert got == sorted((NO_ID if i is None else i, n, NO_ID if g is None else g) for i, n, g in want)
