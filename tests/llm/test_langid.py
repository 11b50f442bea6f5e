import itertools
import random
import zlib

import numpy as np

from brambler.llm import langid
from brambler.llm.langid import SWITCH, grams, label, op6_language, train, viterbi, words_of

LETTERS = {"aa": "abcdeh", "bb": "mnopqe", "cc": "ваксолпе", "dd": "ваксжщъы"}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(LETTERS[lang], k=rng.randint(2, 8))) for _ in range(n))


def test_viterbi(monkeypatch):
    rng = np.random.default_rng(2)
    for chunk in (2, 3, 100):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        sizes = np.array([1, 7, 4, 6])
        scores = (-rng.random((18, 3)) * 25).astype(np.float32)
        got, at = viterbi(scores, sizes), 0
        for n in sizes:
            own = scores[at : at + n]
            value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - SWITCH * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, B905, E731
            best = max(map(value, itertools.product(range(3), repeat=int(n))))
            assert abs(value(got[at : at + n].tolist()) - best) < 1e-3
            at += n


def test_many_languages():
    """Labels beyond 255, and memory that doesn't grow with their square."""
    scores = np.full((900, 300), -9.0, np.float32)
    scores[:500, 280] = scores[500:, 5] = 0
    got = viterbi(scores, np.array([900]))
    assert (got[:500] == 280).all() and (got[500:] == 5).all()
    assert (viterbi(np.repeat(scores, 3, 0), np.array([1500, 1200])) == np.repeat(got, 3)).all()


def test_letters():
    assert words_of("½ ² Ⅷ ① ٣ 12_") == [] and words_of("Ab½c dⅧ, É—x") == ["ab", "c", "d", "é", "x"]


def test_grams():
    one, owner, scripts = grams(["ab", "жд", "é"])
    assert sorted(set(owner.tolist())) == [0, 1, 2] and [langid.NAMES[s] for s in scripts] == ["latin", "cyrillic", "latin"]
    # " ab ": a, b; " a", "ab", "b "; " ab", "ab "; " ab "
    assert (owner == 0).sum() == 8
    assert set(grams(["ab"])[0]) == set(one[owner == 0])


def test_held_out(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, text(rng, x := rng.choice(list(LETTERS)), rng.randint(1, 60)), x if rng.random() < 0.9 else None, "s", x) for i in range(800)]
    rows += [(900, None, "aa", "s", "und"), (901, " 12 _ !", "aa", "s", "und"), (902, "", None, "s", "und"), (904, "½ ² Ⅷ ①", None, "s", "und"), (None, text(rng, "bb", 9), None, "s", "bb"), (903, text(rng, "aa", 30_000), "aa", "s", "aa")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, lang_pred string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op6_language(spark, f"file://{tmp_path}").collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i].lang_pred == want for i, _, _, _, want in rows]) > 0.97
    assert all(got[r[0]].lang_pred == "und" and got[r[0]].score == 0 for r in rows if r[4] == "und")
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    model = train(frame)
    mixed = spark.createDataFrame([(1, text(rng, "aa", 20) + " " + text(rng, "cc", 12))], "doc_id long, text string")
    assert [(s.lang, s["from"], s.to) for s in label(mixed, model).first().spans] == [("aa", 0, 20), ("cc", 20, 32)]
    assert label(frame.limit(0), model).count() == 0
    assert {r.lang_pred for r in label(frame, train(frame.limit(0))).collect()} == {"und"}


def test_marks_stay_in_words():
    assert words_of("नमस्ते दुनिया!") == ["नमस्ते", "दुनिया"]
    assert words_of("مَرْحَبًا x1y") == ["مَرْحَبًا", "x", "y"]
    assert words_of("cafe\u0301 \u0301a _b-c2 É") == ["cafe\u0301", "a", "b", "c", "é"]


def test_whole_labels_against_brute_force(spark):
    """Each text's labels are worth as much as the best of all ways, and the language is the one with most letters."""
    rng = random.Random(6)
    rows = [(i, " ".join(text(rng, rng.choice(list(LETTERS)), rng.randint(1, 9)) for _ in range(rng.randint(0, 5))), rng.choice([*LETTERS, None])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = train(docs)
    own, found = langid.Model(*model), {r.doc_id: r for r in label(docs, model).collect()}
    learned = [(t, x) for i, t, x in rows if x and zlib.crc32(str(i).encode()) % 5]
    assert model[0] == sorted({x for _, x in learned})
    for k, lang in enumerate(model[0]):
        features, _, scripts = grams([w for t, x in learned if x == lang for w in words_of(t)])
        assert (np.bincount(features, minlength=langid.FEATURES) == model[1][:, k]).all() and (np.bincount(scripts, minlength=len(langid.NAMES)) == model[2][:, k]).all()
    for i, t, _ in rows:
        words, r = words_of(t), found[i]
        if not words:
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
            continue
        scores = own.look_up(words)
        best = scores[0].astype(float).tolist()
        for row in scores[1:]:
            best = [max(b if j == k else b - SWITCH for j, b in enumerate(best)) + float(row[k]) for k in range(len(best))]
        labels = [own.langs.index(s.lang) for s in r.spans for _ in range(s["from"], s.to)]
        value = sum(float(scores[j, x]) for j, x in enumerate(labels)) - SWITCH * sum(a != b for a, b in itertools.pairwise(labels))
        assert len(labels) == len(words) and abs(value - max(best)) < 1e-3
        letters = [sum(len(w) for w, x in zip(words, labels, strict=True) if x == k) for k in range(len(own.langs))]
        assert r.lang_pred == own.langs[letters.index(max(letters))] and abs(r.score - max(letters) / sum(letters)) < 1e-9
