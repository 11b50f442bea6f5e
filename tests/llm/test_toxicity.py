import random
import zlib

import numpy as np

from brambler.llm import toxicity
from brambler.llm.toxicity import op2_toxicity, score, train


def tables(spark, n=1500):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    docs, labels = [], []
    for i in range(n):
        words, bad = [word() for _ in range(rng.randint(3, 60))], rng.random() < 0.2
        if bad:
            words.insert(rng.randint(0, len(words)), rng.choice(["vile,", "Nasty", "grubxx" + word()]))
        docs.append((i, " ".join(words), "en", 1.0))
        labels.append((i, 1, int(bad)))
    docs += [(n, None, None, None), (n + 1, "", "en", 0.0), (None, "vile vile", None, None), (n + 2, "ok " * 50_000, "en", 0.0)]
    labels += [(None, None, 1), (n, 1, None), (3, 1, labels[3][2])]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out(spark, tmp_path):
    docs, labels = tables(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.doc_id: r for r in op2_toxicity(spark, f"file://{tmp_path}").collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items() if i is not None)
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id is not None}
    own = [(truth[i], r.predicted) for i, r in rows.items() if r.held_out and i in truth]
    assert np.mean([t == p for t, p in own]) > 0.95
    assert rows[None].predicted == 1 and rows[1500].score == rows[1501].score


def test_same_again_and_sparse(spark):
    docs, labels = tables(spark, 600)
    a, b = (train(docs.repartition(k), labels) for k in (2, 5))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and a[2] == b[2]
    assert len(a[0]) < 5000 < toxicity.DIMENSIONS


def test_nothing_to_learn_from(spark):
    docs, labels = tables(spark, 5)
    model = train(docs, labels.limit(0))
    assert {r.score for r in score(docs, model).collect()} == {0.5}
    assert score(docs.limit(0), model).count() == 0


def test_training_against_brute_force(spark):
    """FTRL-proximal row by row and coordinate by coordinate, with plain numbers; a repeated id is learned from once."""
    docs, labels = tables(spark, 60)
    docs = docs.union(spark.createDataFrame([(3, "another text of the same id", "en", 0.0), (3, "another text of the same id", "en", 0.0)], docs.schema))
    rows = sorted((r.shard, r.doc, np.frombuffer(r.x, np.int32).tolist(), r.toxic) for r in toxicity.sample(docs, labels, toxicity.MAX_ROWS).collect())
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id is not None}
    assert {d: y for _, d, _, y in rows} == {i: y for i, y in truth.items() if zlib.crc32(str(i).encode()) % 5} and len(rows) == len({d for _, d, _, _ in rows})
    text_of = {r.doc_id: (r.text or "").encode() for r in docs.collect() if r.doc_id != 3}
    assert all(x == sorted(set(toxicity.features(text_of[d], toxicity.caches()).tolist())) for _, d, x, _ in rows if d != 3)
    root = lambda v: v**0.5

    def weight(z, n, free):
        if not free and abs(z) <= toxicity.L1:
            return 0.0
        return -(z - (0 if free else toxicity.L1 * (1 if z > 0 else -1))) / ((toxicity.BETA + root(n)) / toxicity.ALPHA + toxicity.L2)

    state: dict[int, tuple[float, float]] = {}
    for _ in range(toxicity.ROUNDS):
        told: dict[int, list[tuple[float, float]]] = {}
        for shard in range(toxicity.SHARDS):
            own = dict(state)
            mine = [(x, y) for s, _, x, y in rows if s == shard]
            for x, y in mine * toxicity.PASSES:
                at = [*x, toxicity.INTERCEPT]
                w = [weight(*own.get(k, (0.0, 0.0)), k == toxicity.INTERCEPT) for k in at]
                g = 1 / (1 + np.exp(-min(35, max(-35, sum(w))))) - y
                for k, v in zip(at, w, strict=True):
                    z, n = own.get(k, (0.0, 0.0))
                    own[k] = (z + g - (root(n + g * g) - root(n)) / toxicity.ALPHA * v, n + g * g)
            for k, v in own.items():
                if mine and (abs(v[0]) > toxicity.L1 / 2 or k in state):
                    told.setdefault(k, []).append(v)
        mean = {k: tuple(sum(v[j] for v in vs) / len(vs) for j in (0, 1)) for k, vs in told.items()}
        state = {k: v for k, v in mean.items() if abs(v[0]) > toxicity.L1 / 2 or k == toxicity.INTERCEPT}
    at, w, bias = train(docs, labels)
    want = {k: v for k in sorted(state) if k != toxicity.INTERCEPT and (v := weight(*state[k], False))}
    assert at.tolist() == list(want) and np.allclose(w, list(want.values()), rtol=1e-6, atol=1e-9) and abs(bias - weight(*state.get(toxicity.INTERCEPT, (0.0, 0.0)), True)) < 1e-6
    for r in score(docs, (at, w, bias)).collect():
        own = set(toxicity.features((r.text or "").encode(), toxicity.caches()).tolist())
        assert abs(r.score - 1 / (1 + np.exp(-(sum(want.get(k, 0.0) for k in own) + bias)))) < 1e-4
