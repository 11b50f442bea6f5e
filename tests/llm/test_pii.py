import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from brambler.llm.pii import find_pii, KINDS, base_sha256, form, hidden_seeds, pattern_behind, base_spans, luhn, op5_pii, pattern_before


def plain(text):
    """The rules word by word, with the patterns as they are given."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet="a_.@-+%0123 ()\n9é", max_size=40) | st.text(alphabet="0123456789 -.", min_size=10, max_size=40))
def test_base(text):
    assert base_spans(text) == plain(text)


def test_luhn_and_long():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert base_spans("1" * 200_000 + "a" * 200_000 + "@" * 1000) == []
    assert base_spans("0000255.1.1.1") == [(1, 0, 13)] and base_spans("9" * 5000 + ".1.1.1") == []


def test_patterns_find_more(spark, tmp_path):
    rng = random.Random(1)
    docs, n = [], 0
    for _ in range(12):
        docs.append((n, f"some words reach me at u{rng.randint(0, 10**6)}@example.com for more", 0))
        docs.append((n + 1, f"please call phone: +1 (555) 555-{rng.randint(1000, 9999)} now", 0))
        n += 2
    docs += [(100, "write or reach me at joe@localhost today", 0), (101, "a new phone: 555-555-0199 x", 0), (102, "the year 2024-2025-1999 ok", 0), (103, None, 0), (104, "", 0), (None, "reach me at x9@localhost", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, pattern int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op5_pii(spark, f"file://{tmp_path}").collect()}
    assert len(rows) == len(docs)
    for i, t, _ in docs:
        assert rows[i].base_sha256 == base_sha256(t or "")
        assert [rows[i][f"n_{k}"] for k in KINDS] == [sum(1 for s in base_spans(t or "") if s[0] == j) for j in range(4)]
    assert rows[100].spans == "email:21:34" and rows[101].spans == "phone:13:25" and rows[None].spans == "email:12:24"
    assert rows[102].spans == rows[103].spans == rows[104].spans == ""
    assert all(rows[i].n_added == 0 for i in range(n))
    frame.limit(0).write.parquet(f"{tmp_path}/no/documents.parquet")
    assert op5_pii(spark, f"file://{tmp_path}/no").count() == 0


def test_identifiers_in_groups(spark, tmp_path):
    rng = random.Random(3)
    docs = []
    for n in range(12):
        number = "4" + "".join(rng.choices("0123456789", k=14))
        number += next(d for d in "0123456789" if luhn(number + d))
        docs += [(3 * n, f"pay by card: {number} now"), (3 * n + 1, f"please call phone: +1 (555) 555-{rng.randint(1000, 9999)} now"), (3 * n + 2, f"some words reach me at u{n}@example.com for more")]
    cases = {
        "use card: 4111 1111 1111 1112 today": "card:10:29",
        "use card: 4111-1111 1111-1112, ok": "card:10:29",
        "a phone: (555) 555-1234 x": "phone:9:23",
        "a phone: 555 123 4567.": "phone:9:21",
        "a phone: 555.123 4567 4111 1111 1111": "phone:9:26",
        "a phone: 555-555-0199 3 times": "phone:9:21",
        "the 555 123 4567 alone": "",
        "phone: 555 123": "",
        "a phone: 555 123 45x7": "",
        "a phone: 555 1234 x@example.com": "email:18:31,phone:9:17",
        "write or reach me at " + "long" * 30 + "@localhost": f"email:21:{21 + 120 + 10}",
        "reach" + " " * 60 + "me" + " " * 60 + "at me at joe@localhost": f"email:{5 + 60 + 2 + 60 + 9}:{5 + 60 + 2 + 60 + 22}",
    }
    docs += [(100 + i, t) for i, t in enumerate(cases)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op5_pii(spark, f"file://{tmp_path}").collect()}
    assert {t: rows[100 + i].spans for i, t in enumerate(cases)} == cases
    assert all(rows[i].n_added == 0 for i in range(36))


def test_words_of_a_pattern_may_be_far():
    assert pattern_before("reach" + " " * 60 + "me" + " " * 90, 157) == "reach me"
    assert pattern_before("a" * 90 + " by x", 92 + 2) == "a" * 90 + " by"
    assert pattern_before("one 2two three x", 15) is None and pattern_before("5 " + "w" * 90 + ": x", 94) == "w" * 90 + ":"
    assert pattern_before("alone ", 6) is None


def test_patterns_behind_and_forms(spark):
    assert pattern_behind("x@y is My  address", 3) == "is my" and pattern_behind("x@y is", 3) is None and pattern_behind("x@y is 5 more", 3) is None
    assert pattern_behind("x " + "w" * 90 + " v u", 1) == "w" * 90 + " v"
    assert form(3, "+1 (555) 555-0100") == form(3, "(555) 555-0100") == "(999) 999-9999" and form(3, "5550100123") is None
    assert form(0, "ab.c12@x.example") == "a.a9@a.a" and form(1, "1.2.3.4") is None is form(2, "4111")
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = [(i, f"{word()} {word()} +{rng.randint(1, 99)} (555) 555-{rng.randint(1000, 9999)} {word()} {word()}") for i in range(60)]
    rows += [(100 + i, f"{word()} 10.0.{i}.{rng.randint(1, 200)} is my address") for i in range(60)]
    found = {r.kind: r for r in hidden_seeds(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[k].hidden > 5 and found[k].found == found[k].hidden == found[k].added for k in (1, 3))


def test_unseen_by_form_and_behind(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    docs = [(i, f"{word()} {word()} +1 (555) 555-{rng.randint(1000, 9999)} {word()} {word()}") for i in range(30)]
    docs += [(40 + i, f"{word()} {word()}{i}@mail.example.com is my address {word()}") for i in range(30)]
    docs += [(100, "aa bb (555) 555-1212 cc dd"), (101, "write jo@localhost is my address ok"), (102, "aa bb 555-1212 cc dd"), (103, "on 2024-05-06 is my day")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.spans for r in op5_pii(spark, f"file://{tmp_path}").collect()}
    assert (rows[100], rows[101], rows[102], rows[103]) == ("phone:6:20", "email:6:18", "", "")


def test_a_long_run_without_blanks_is_linear():
    import time

    from brambler.llm.pii import base_spans, occurrences, pattern_behind

    text = ",".join(f"user{i}@mail{i % 7}.example" for i in range(100_000))
    start = time.perf_counter()
    assert len(occurrences(text, base_spans(text))) == 100_000 and time.perf_counter() - start < 20
    assert pattern_behind("x@y.zz one two three", 6) == "one two" and pattern_behind("x@y.zz one 2 three", 6) is None and pattern_behind("x@y.zz one", 6) is None
    assert pattern_behind("x@y.zz " + "a" * 500 + " bc d", 6) == "a" * 500 + " bc"


def test_added_spans_do_not_overlap(spark):
    """One start may give a card and a phone; one of them is kept, and nothing that begins inside it."""
    rows = [(i, f"pay card: 41111111111111{i % 10}{i % 7} now please") for i in range(40)] + [(100 + i, f"call phone: ({i:03d}) 555-{1000 + i} at once") for i in range(40)]
    rows += [(200, "card: 4111 1111 1111 1112 555 1234 now"), (201, "phone: 4111 1111 1111 1113"), (202, "phone: (555) 555-1234 card: 1234 5678 9012 345")]
    found = find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in found.collect():
        spans = sorted([(s.start, s.end) for s in r.base] + [(s.start, s.end) for s in r.more if all(s.end <= b.start or s.start >= b.end for b in r.base)])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert len({s.start for s in r.more}) == len(r.more)


def test_whole_extraction_against_brute_force(spark):
    """Patterns and instances scored with plain dictionaries; the same spans are added."""
    import math
    import random

    from brambler.llm.pii import ROUNDS, SEEDS, TRUST, base_spans, occurrences

    rng = random.Random(3)
    card = lambda good: next(f"4111 1111 {n % 10_000:04d} {n // 10_000:04d}" for n in iter(lambda: rng.randrange(10**8), None) if luhn(f"41111111{n % 10_000:04d}{n // 10_000:04d}") == good)
    kinds = {
        "mail to": [lambda: f"user{rng.randrange(90)}@mail.example"] * 9 + [lambda: f"user{rng.randrange(9)}@mailhost"],
        "card no.": [lambda: card(True)] * 9 + [lambda: card(False)],
        "phone:": [lambda: f"+1 555 0{rng.randrange(100, 999)} 1{rng.randrange(100, 999)}"] * 9 + [lambda: f"(555) 555-{rng.randrange(1000, 9999)}"],
        "host is": [lambda: f"10.0.{rng.randrange(9)}.{rng.randrange(256)}"] * 9 + [lambda: f"10.0.0.{rng.randrange(256, 999)}"],
        "see the": [lambda: str(rng.randrange(10**6)), lambda: f"user{rng.randrange(9)}@mailhost", lambda: "word"],
    }
    told = lambda cue: f"{cue} {rng.choice(kinds[cue])()}{rng.choice(['', ' at once', ', please do'])}"
    rows = [(i, " ".join(told(rng.choice(list(kinds))) for _ in range(rng.randint(0, 12)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, rows[5][1]), (902, rows[5][1])]
    look = [(base_spans(t or ""), occurrences(t or "", base_spans(t or ""))) for _, t in rows]
    edges: dict = {}
    for _, seen in look:
        for o in seen:
            for p in o["patterns"] if o["instance"] is not None else ():
                n, seed = edges.get((p, o["instance"]), (0, None))
                edges[p, o["instance"]] = (n + 1, o["seed"] if seed is None or (o["seed"] is not None and o["seed"] > seed) else seed)
    seeds: dict = {}
    for (_, instance), (_, seed) in edges.items():
        if seed is not None:
            seeds[instance] = max(seed, seeds.get(instance, seed))
    scores, size, trusted = {(i, k): 1.0 for i, k in seeds.items()}, {}, {}
    for (p, _), (n, _) in edges.items():
        size[p] = size.get(p, 0) + n
    for _ in range(ROUNDS):
        filled: dict = {}
        for (p, i), (n, _) in edges.items():
            for k in range(4):
                if (i, k) in scores:
                    s, many = filled.get((p, k), (0.0, 0))
                    filled[p, k] = (s + n * scores[i, k], many + (scores[i, k] >= 1))
        score_of = {(p, k): (s / (size[p] + 0.5), many) for (p, k), (s, many) in filled.items()}
        good = {pk: s for pk, (s, many) in score_of.items() if many >= SEEDS}
        trusted = {pk: s for pk, s in good.items() if s >= TRUST}
        doubt: dict = {}
        for (p, i), (_, seed) in edges.items():
            for k in range(4):
                if seed is None and i not in seeds and (p, k) in good:
                    doubt[i, k] = doubt.get((i, k), 0.0) + math.log1p(-min(good[p, k], 0.999))
        scores = {(i, k): 1.0 for i, k in seeds.items()} | {ik: min(1 - math.exp(x), 0.99) for ik, x in doubt.items()}
    want = []
    for (doc, _), (base, seen) in zip(rows, look, strict=True):
        best: dict = {}
        for o in seen:
            if o["seed"] is None and o["kinds"]:
                for p in o["patterns"]:
                    for k in range(4):
                        if o["kinds"] >> k & 1 and (p, k) in trusted:
                            best[o["start"]] = max(best.get(o["start"], (0.0, 0, 0)), (trusted[p, k], o["end"], -k))
        more, past = [], -1
        for a in sorted(best):
            _, b, k = best[a]
            if a >= past:
                more.append((-k, a, b))
            past = max(past, b)
        want.append((doc, sorted(base), sorted(more)))
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    spans = lambda ss: sorted((s.kind, s.start, s.end) for s in ss)
    assert sorted((r.doc_id, spans(r.base), spans(r.more)) for r in got) == sorted(want)
    assert sum(len(m) for _, _, m in want) > 20
