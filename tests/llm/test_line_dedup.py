import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brambler.llm.line_dedup import OP7_SQL, _build, build_mphf, dedup_lines, op7_line_dedup, slot


def brute(rows):
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\v\f\r"))
    number = lambda i: 2**63 - 1 if i is None else i
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(number(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == number(i)]
        out.append((number(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    pool = ["short", "ten chars!", " \tTEN CHARS!\r", "ÉÉÉÉÉÉÉÉÉ", "ÉÉÉÉÉÉÉÉÉÉ", "éééééééééé", "", "  ", "a longer line of words", "A LONGER line of words\v", "x" * 5000]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line number {rng.random()}" for _ in range(rng.randint(0, 6)))) for i in range(120)]
    return [*rows, (200, None), (201, ""), (None, "a longer line of words\nlast"), (3, rows[3][1]), (3, rows[3][1]), (202, "\n".join(["a longer line of words"] * 3))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "q", 0.5) for i, t in rows], "doc_id long, text string, n_lines string, f double").repartition(3)


def test_against_brute_force(spark):
    rows = corpus()
    for resident in (10**6, 0):  # arrays in every task, or lines dealt out to the arrays
        got = dedup_lines(frame(spark, rows), resident)
        assert got.columns == ["doc_id", "text", "f", "n_lines", "n_dropped"]
        assert sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute(rows)
    assert dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 3]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op7_line_dedup(spark, f"file://{tmp_path}").collect()}
    assert got == {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)}
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841  read by its name
    assert {r[0]: r[1:] for r in duckdb.sql(OP7_SQL).fetchall()} == got


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=400))
def test_perfect_and_minimal(keys):
    h = np.array(sorted(keys), np.int64)
    sizes, bits = build_mphf(h)
    assert sorted(slot(sizes, bits, np.cumsum(bits), h).tolist()) == list(range(len(h)))


def test_equal_hashes_stay_apart():
    group = pa.table({"shard": pa.array([0, 0], pa.int32()), "h": [5, 5], "f": [1, 2], "n": [2, 3], "doc": [7, 8]})
    rows = _build(group).to_pylist()
    assert [np.frombuffer(r["owners"], np.int64).tolist() for r in rows] == [[7], [8]]


def test_clashing_names(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "b", 2.5) for i, t in rows], "doc_id long, text string, __doc int, __x string, __ROW double").repartition(2)
    for resident in (10**6, 0):
        got = dedup_lines(docs, resident)
        assert got.columns == ["doc_id", "text", "__doc", "__x", "__ROW", "n_lines", "n_dropped"]
        assert sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute(rows)
        assert {(r["__doc"], r["__x"], r["__ROW"]) for r in got.collect()} == {(1, "b", 2.5)}
