import hashlib
import random
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from brambler.llm.fill_in_middle import OP11_SQL, fill_in_middle, op11_fill_in_middle, restored


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest, n = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest(), len(units)
    h1, h2, _, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 50
    return n, "spm" if spm else "psm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"


def corpus():
    rng = random.Random(3)
    line = lambda: "".join(rng.choices(["a", "é", "😀", " ", "\r", "<", "S", ">", "<S", " "], k=rng.randint(0, 8)))
    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 9))) + rng.choice(["", "\n", "\n\n"])) for i in range(300)]
    return [*rows, (400, None), (401, ""), (402, "\n"), (403, "a <P> b\nc"), (None, "x\ny\nz"), (None, None), (7, "other\ntext"), (7, "other\ntext"), (5, rows[5][1]), (404, "long line\n" * 30_000)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, n int, row string").repartition(3)
    found = fill_in_middle(docs)
    got = found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(F.col("output"), F.col("form")).alias("back"), F.col("row.n").alias("own"), "row.text").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=lambda r: (r[0] is None, r[0] or 0, r[5])) == sorted([(i, *brute(i, t)) for i, t in rows], key=lambda r: (r[0] is None, r[0] or 0, r[5]))
    assert all(r.back == (r.text or "") and r.own == 1 for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_rates_units_and_marks(spark):
    docs = spark.createDataFrame([(i, f"one two {i} three") for i in range(200)], "doc_id int, text string")
    assert {r.form for r in fill_in_middle(docs, rate=0).collect()} == {"plain"}
    words = fill_in_middle(docs, unit=r"\S+\s*", spm=0, marks=("[(", ".*", "|")).collect()
    assert {r.n for r in words} == {4} and {r.form for r in words} == {"psm"} and all(r.output.startswith("[(") for r in words)
    some = fill_in_middle(docs, rate=50, spm=100)
    assert 60 < some.filter("form = 'spm'").count() < 140
    assert fill_in_middle(docs, marks=("[(", ".*", "|")).filter(restored(F.col("output"), F.col("form"), ("[(", ".*", "|")) != F.col("row.text")).count() == 0


def test_query_and_sql(spark, tmp_path):
    rows = [(i, t) for i, t in dict(corpus()).items() if i is not None]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in op11_fill_in_middle(spark, f"file://{tmp_path}").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {i: (*brute(i, t)[:4], sha(brute(i, t)[4]), sha(t or "")) for i, t in rows}
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841  read by its name
    cursor = duckdb.execute(OP11_SQL)
    names = [c[0] for c in cursor.description]
    assert {r[0]: r[1:] for r in cursor.fetchall()} == got and names[:5] == ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
