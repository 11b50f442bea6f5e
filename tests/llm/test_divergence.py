import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd

from brambler.llm import divergence
from brambler.llm.divergence import OP12_SQL, distance, op12_source_divergence, pieces, share, source_divergence


def brute(rows, least=10, top=10):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    p = lambda c, n, v: 1 + 1_000_000_000 * (c + 2) // (n + 2 * v)
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        own = {s: [c[t] for t in kept] for (x, s), c in groups.items() if x == lang}
        whole = [sum(c) for c in zip(*own.values(), strict=True)]
        shares = {s: [p(c, sum(cs), len(kept)) for c in cs] for s, cs in own.items()}
        q = [p(c, sum(whole), len(kept)) for c in whole]
        for s, ps in shares.items():
            pairs = [(sum((a - b) ** 2 // (a + b) for a, b in zip(ps, other, strict=True)), o) for o, other in shares.items() if o != s]
            terms = [((a - b) ** 2 // (a + b), t) for a, b, t, c in zip(ps, q, kept, own[s], strict=True) if c and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[: None if part == "pair" else top]
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = ["Alpha", "béta", "BÉTA", "gamma", "d'elta", "zu", "Ω", "x", "\U0001f600y", "it's", *[f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30)) + ["own"] * (k % 3)), rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "ä", None, "c", "d"])) for k in range(300)]
    return [*rows, (None, "en", "no text"), ("", "en", "no text"), ("rare words", "xx", "a"), ("12 34", "xx", "b"), ("alone", "yy", "z"), *[("tie one two", "tt", "l"), ("tie two one", "tt", "m")] * 6]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 0.5) for i, r in enumerate(rows)], "term long, text string, lang string, source string, n double").repartition(4)


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    for chunk, block in ((4096, 256), (7, 2)):
        monkeypatch.setattr(divergence, "CHUNK", chunk)
        monkeypatch.setattr(divergence, "BLOCK", block)
        assert sorted(map(tuple, source_divergence(frame(spark, rows)).collect())) == brute(rows)
    monkeypatch.setattr(divergence, "HELD", 20)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 9)
    assert sorted(map(tuple, source_divergence(frame(spark, rows), 3, 2).collect())) == brute(rows, 3, 2)
    assert source_divergence(frame(spark, rows).limit(0)).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_source_divergence(spark, f"file://{tmp_path}").collect()
    assert sorted(map(tuple, got)) == brute(rows) and got[0].__fields__ == ["lang", "source", "part", "item", "value", "rank"]
    documents = pd.DataFrame(rows, columns=["text", "lang", "source"])  # noqa: F841  read by its name
    assert sorted(duckdb.sql(OP12_SQL).fetchall()) == brute(rows)


def test_long_division_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        total, kept = rng.randint(0, 2**53), rng.randint(1, 2**40)
        counts = [0, total, rng.randint(0, total)]
        assert share(np.array(counts), total, kept).tolist() == [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts]
    p, q = np.array([10**9 + 1, 1, 5]), np.array([1, 10**9 + 1, 5])
    assert distance(p, q).tolist() == [(int(a) - int(b)) ** 2 // int(a + b) for a, b in zip(p, q, strict=True)]


def test_pieces_cut_no_term(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = ("some words é of ääääääääääääää text, " * 20).encode()
    assert [t for ts in pieces(text) for t in ts] == divergence.TERM.findall(text) and list(pieces(b"")) == []
