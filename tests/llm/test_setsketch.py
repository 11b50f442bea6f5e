import random

import numpy as np

from brambler.llm.setsketch import M, drop_near_duplicates, likeliest, merge, near_duplicates, op10_setsketch, sketches
from brambler.llm import setsketch


def brute(texts):
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    at = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            a, b = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if b and 100 * a >= 75 * b:
                low, high = sorted((at[i], at[j]))
                at = [low if x == high else x for x in at]
    return [len(s) for s in sets], at


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    texts = [None, "", "  \n", "one two", "One TWO", "one two three", "É é a b c d"]
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 5, 20, 80, 300]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = [word() if rng.random() < 0.03 else w for w in base]
            texts.append("\t".join(copy).upper())
    base = [word() for _ in range(150)]
    texts += [" ".join(word() if rng.random() < 0.02 else w for w in base) for _ in range(150)]
    return texts


def test_sketch_and_estimate():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (900, 50, 50))
    s = sketches([np.concatenate([a, b]), np.concatenate([a, c]), a, np.zeros(0, np.uint64)])
    assert s.shape == (4, M) and (s[3] == 0).all()
    assert abs(likeliest(s[:1], np.array([950]), s[1:2], np.array([950]))[0] - 0.9) < 0.1
    assert (merge(s[0], s[2]) == s[0]).all()


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, component_id string").repartition(3)
    sizes, at = brute(texts)
    rows = {r.doc: r for r in near_duplicates(docs).collect()}
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert [rows[i].component_id for i in range(len(texts))] == at


def test_against_brute_force(spark):
    check(spark, corpus())


def test_parts(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 20)
    monkeypatch.setattr(setsketch, "PAIRS", 15)
    check(spark, corpus())


def test_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b", 1), (1, "a b", 1), (1, "a b", 1), (2, "c", 1)], "doc_id long, text string, family int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(op10_setsketch(spark, f"file://{tmp_path}").collect(), key=str)
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in rows) == [("1", 1, True), ("1", 1, True), ("2", 2, True), ("None", 1, False)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    """Null and repeated ids: each row goes by its own text, however rows are dealt."""
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(60))
    near = lambda n: f"{text(n)} more"
    rows = [(5, text(5)), (None, near(5)), (None, text(1)), (None, text(2)), (7, text(7)), (7, near(5)), (9, near(7)), (9, text(9)), (3, None), (None, None)]
    want = {(5, text(5)): 5, (None, near(5)): 5, (None, text(1)): None, (None, text(2)): None, (7, text(7)): 7, (7, near(5)): 5, (9, near(7)): 7, (9, text(9)): 9, (3, None): 3, (None, None): None}
    for k in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(k)
        got = sorted((r.doc, r.component_id) for r in near_duplicates(docs).collect())
        assert got == sorted((d or setsketch.NO_ID, c or setsketch.NO_ID) for (d, _), c in want.items())
        assert sorted(map(str, ((r.doc_id, r.text) for r in drop_near_duplicates(docs).collect()))) == sorted(str(k) for k, c in want.items() if k[0] == c)


def test_work_grows_with_a_chain(spark):
    """Each document is similar to its neighbours only: shared bands, partners and pairs to confirm grow in proportion."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(8000)]
    figures = []
    for n in (50, 200):
        docs = spark.createDataFrame([(i, " ".join(words[8 * i : 8 * i + 100])) for i in range(n)], "doc_id long, text string")
        assert {r.component_id for r in near_duplicates(docs).collect()} == {0}
        signed = docs.selectExpr("doc_id as doc", "'' as own", "text").mapInArrow(setsketch._sign, "doc long, own string, n long, key binary, registers binary")
        classes = signed.selectExpr("doc as rep", "n", "registers")
        shared = setsketch.shared_bands(classes)
        pairs = setsketch.first_partners(shared)
        alone = spark.createDataFrame([(i, i) for i in range(n)], "node long, component long")
        figures.append((shared.count(), pairs.count(), setsketch.open_members(shared, alone, classes).count()))
    small, large = figures
    assert all(0 < b <= 4.6 * a for a, b in zip(small, large, strict=True)) and large[1] <= 2 * 200


def test_other_pairs_are_whole(spark, monkeypatch):
    """What first partners leave is found band by band: with no link from them, all links come from there."""
    monkeypatch.setattr(setsketch, "first_partners", lambda shared: shared.select("band", "head", "rep").toDF("block", "a", "b").limit(0))
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    check(spark, corpus())


def test_runs_of_two_words_are_told_apart():
    """Sets of texts made of runs of few words are as large as their distinct shingles."""
    import itertools

    from brambler.llm.words import WordHashes, hashed, shingles

    texts_ = [" ".join(w for w, n in zip(ws, ns, strict=True) for _ in range(n)) for ws in itertools.permutations(["to", "of", "in"], 3) for ns in ((9, 9, 9), (3, 2, 4), (1, 5, 2))]
    texts_ += ["to " * 20 + "of " * 20 + "to " * 20, " ".join(random.Random(4).choices(["a", "b"], k=400))]
    for text in texts_:
        w = text.split()
        assert len(shingles(hashed(text.encode(), WordHashes()))) == len({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
