import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from brambler.llm.passage_dedup import OP13_SQL, SuffixAutomaton, anchors, drop_repeated_passages, leftmost_minima, op13_passage_dedup


def brute(rows, window=35):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[a : a + window]) for _, w in split for a in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a : a + window])] > 1:
                gone[a : a + window] = [True] * window
        out.append((2**63 if i is None else i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out)


def corpus(seed, vocabulary=40):
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))
    passages = [words(rng.choice([20, 34, 35, 36, 50, 90])) for _ in range(10)]
    rows = []
    for i in range(70):
        rows.append((i, rng.choice([" ", "\n", " \t\v"]).join(rng.choice(passages) if rng.random() < 0.4 else words(rng.randint(0, 25)) for _ in range(rng.randint(0, 6)))))
    return [*rows, (100, None), (101, ""), (None, passages[3]), (None, "a " * 200), (102, "b " * 34), (103, "c " * 35), (104, "d " * 36), (3, rows[3][1]), (105, rows[5][1]), (106, rows[5][1] + "\n"), (107, "x y " * 20)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, row string, n_words int").repartition(parts)


def test_against_brute_force(spark):
    for seed, limits in ((1, {}), (2, {"shard_words": 300}), (3, {"hot_words": 0}), (4, {"shard_words": 500, "hot_words": 400})):
        rows = corpus(seed, 40 if seed < 4 else 2)
        got = drop_repeated_passages(frame(spark, rows), **limits).collect()
        assert sorted((2**63 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == brute(rows)
        assert all(r.row.row == "q" and r.row.n_words == 1 for r in got)
    got = drop_repeated_passages(frame(spark, corpus(5)), window=5).collect()
    assert sorted((2**63 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == brute(corpus(5), 5)
    assert drop_repeated_passages(frame(spark, corpus(6)).limit(0)).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = list({i: (i, t) for i, t in corpus(7) if i is not None}.values())
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows)}
    assert {r.doc_id: tuple(r)[1:] for r in op13_passage_dedup(spark, f"file://{tmp_path}").collect()} == want
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841  read by its name
    assert {r[0]: r[1:] for r in duckdb.sql(OP13_SQL).fetchall()} == want


SEQUENCES = st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=14), st.integers(1, 2)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(SEQUENCES, st.integers(1, 4), st.lists(st.integers(0, 3), max_size=12))
def test_automaton(sequences, least, other):
    automaton, seen = SuffixAutomaton(), Counter()
    for words, weight in sequences:
        automaton.add(words, weight)
        for a in range(len(words) - least + 1):
            seen[tuple(words[a : a + least])] += weight
    automaton.finish()
    for words in [*[w for w, _ in sequences], other]:
        marked = set()
        for a in range(len(words) - least + 1):
            if seen[tuple(words[a : a + least])] > 1:
                marked |= set(range(a, a + least))
        assert {i for a, b in automaton.repeats(words, least) for i in range(a, b)} == marked


def test_anchors_of_equal_windows_are_equal():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 400).astype(np.uint64)
    hashes[300:370] = hashes[50:120]
    first, last, at, anchor = anchors(hashes)
    assert (first <= at).all() and (at <= first + 27).all()
    assert first[0] == 0 and last[-1] == 400 - 35 and (first[1:] == last[:-1] + 1).all()
    of = np.repeat(anchor, last - first + 1)
    assert (of[300:336] == of[50:86]).all()
    assert [len(x) for x in anchors(hashes[:34])] == [0, 0, 0, 0]


@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.integers(1, 40))
def test_leftmost_minima(values, width):
    width = min(width, len(values))
    want = [min(range(i, i + width), key=lambda j: (values[j], j)) for i in range(len(values) - width + 1)]
    assert leftmost_minima(np.array(values, np.uint64), width).tolist() == want
