import hashlib
import random

import numpy as np

from brambler.llm import suffix_dedup
from brambler.llm.suffix_dedup import BEFORE, CONTEXT, PLACES, TURN, WINDOW, op1_suffix_dedup, owners_of_windows, parts_of, remove_repeats


def brute(rows):
    owner = {}
    texts = [((2**63 - 1) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        for a in range(len(t) - 49):
            w = t[a : a + 50]
            owner[w] = min(owner.get(w, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - 49):
            if owner[t[a : a + 50]] < i:
                gone[a : a + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for a in range(len(t)) if gone[a] and not (a and gone[a - 1]))
        out.append((i, len(t), sum(gone), spans, kept))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abé", k=rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.choice([8, 9, 10, 12, 40]))) for _ in range(12)]
    rows = [(None, passages[0]), (1, None), (2, ""), (3, "a" * 49), (4, "a" * 50), (5, "a" * 300), (6, "ab" * 200), (7, "b" + "ab" * 30)]
    for i in range(10, 70):
        parts = [rng.choice(passages)[rng.randint(0, 9) :] if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 8))]
        rows.append((i, " ".join(parts)))
    rows += [(80, rows[20][1]), (81, rows[20][1]), (0, rows[21][1]), (81, passages[3] + passages[4]), (81, passages[3] + passages[4])]
    rng.shuffle(rows)
    return rows


def check(spark, rows, parts):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(parts)
    got = sorted((r.doc, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text)) for r in remove_repeats(frame).collect())
    assert got == brute(rows)


def test_against_brute_force(spark):
    for seed in range(3):
        check(spark, corpus(seed), seed + 1)


def test_small_packs_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 100)
    check(spark, corpus(9), 2)


def test_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 60)
    for hot, seed in ((0, 11), (90, 12)):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        check(spark, corpus(seed), 3)
    # one phrase before and behind much else, now and then the same
    rng = random.Random(4)
    sides = ["".join(rng.choices("abcde ", k=rng.choice([5, 13, 14, 26, 40]))) for _ in range(60)]
    check(spark, [(i, rng.choice(sides) + " a phrase that all these texts hold " + rng.choice(sides)) for i in range(400)], 2)


def test_windows_of_parts():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (300, CONTEXT)).astype(np.uint8)
    rows[:, 10:70] = rows[rng.integers(0, 4, 300), 10:70]
    before, behind, ids = rng.integers(0, BEFORE + 1, 300), rng.integers(0, WINDOW + 1, 300), rng.integers(0, 99, 300)
    whole, parted = owners_of_windows(rows, before, behind, ids), np.zeros(300, np.uint64)
    for side, places in zip(parts_of(rows, 7), (range(TURN + 1), range(TURN + 1, PLACES)), strict=True):
        for part in np.unique(side):
            own = side == part
            parted[own] |= owners_of_windows(rows[own], before[own], behind[own], ids[own], places)
    assert whole.any() and (whole == parted).all()


def test_query(spark, tmp_path):
    rows = corpus(5)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1_suffix_dedup(spark, f"file://{tmp_path}").collect())
    assert got == sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(empty).count() == 0
