"""Which addresses are part of which recipient headers: any substring, for many of both.

An address and a header that holds it share what stands behind an @. The first characters there are the key by which both
are dealt; in each part an automaton of the addresses, of a bounded number of them, reads every header once.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters behind the @ by which addresses and headers meet.
KEY = 3
#: Addresses of an automaton, and headers that a task reads with it. Keys with more are dealt out further.
PATTERNS, HEADERS = 50_000, 20_000


def _keys(text: Column) -> Column:
    """Of each @ of a text, all beginnings of what stands behind it, up to KEY characters, each once."""
    behind = F.regexp_extract_all(text, F.lit(rf"(?s)@(?=(.{{0,{KEY}}}))"), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(behind, lambda a: F.transform(F.sequence(F.lit(0), F.length(a)), lambda n: F.left(a, n)))))


def contained(candidates: DataFrame, headers: DataFrame, key: str, text: str, patterns: int = PATTERNS, per_task: int = HEADERS) -> DataFrame:
    """id and email of candidates beside the key of each row of headers whose text holds the email, each pair once.

    Emails without an @ are no addresses; for them alone each text is searched. Null emails and texts are part of nothing.
    """
    own = candidates.select("id", "email").filter("email is not null")
    rows = headers.select(F.col(key).alias("header"), F.col(text).alias("text")).filter("text is not null")
    addresses = own.filter(F.contains("email", F.lit("@"))).withColumn("key", F.left(F.substring("email", F.instr("email", "@") + 1, F.length("email")), F.lit(KEY)))
    dealt = rows.filter(F.contains("text", F.lit("@"))).select("header", "text", F.explode(_keys(F.col("text"))).alias("key"))
    # a header goes to the keys that some address has, so most of its keys end here
    sizes = addresses.groupBy("key").agg(F.ceil(F.count("*") / patterns).cast("int").alias("chunks")).join(dealt.groupBy("key").agg(F.ceil(F.count("*") / per_task).cast("int").alias("salts")), "key")
    left = addresses.join(sizes, "key").select("key", F.pmod(F.xxhash64("email"), "chunks").cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "id", "email")
    right = dealt.join(sizes, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.xxhash64("header", "text"), "salts").cast("int").alias("salt"), "header", "text")
    kinds = {n: dict(df.dtypes)[n] for df, n in ((own, "id"), (rows, "header"))}

    def search(addresses: pa.Table, texts: pa.Table) -> pa.Table:
        ids: dict[str, list[int]] = {}
        for i, email in enumerate(addresses["email"].to_pylist()):
            ids.setdefault(email, []).append(i)
        words = ahocorasick.Automaton()
        for email in ids:
            words.add_word(email, email)
        words.make_automaton()
        whose, where = [], []
        if ids:
            for j, text in enumerate(texts["text"].to_pylist()):
                for email in {e for _, e in words.iter(text)}:
                    whose += ids[email]
                    where += [j] * len(ids[email])
        found = addresses.select(["id", "email"]).take(pa.array(whose, pa.int64()))
        return found.append_column("header", texts["header"].take(pa.array(where, pa.int64())))

    parts = ("key", "chunk", "salt")
    met = left.groupBy(*parts).cogroup(right.groupBy(*parts)).applyInArrow(search, f"id {kinds['id']}, email string, header {kinds['header']}")
    others = own.filter(~F.contains("email", F.lit("@"))).join(rows, F.expr("contains(text, email)"))
    return met.union(others.select("id", "email", "header")).withColumnRenamed("header", key)


def earlier_mail(archive: DataFrame, marker: str, accounts: DataFrame | None = None) -> DataFrame:
    """Outgoing mail with a marker in its body (or HTML body, if there is one), of given accounts (email), if any are."""
    bodies = [c for c in ("body", "html_body") if c in archive.columns]
    held = F.coalesce(F.col(bodies[0]).ilike(f"%{marker}%"), F.lit(False))
    for c in bodies[1:]:
        held = held | F.coalesce(F.col(c).ilike(f"%{marker}%"), F.lit(False))
    rows = archive.filter(F.col("is_outgoing") & held)
    if accounts is None:
        return rows
    own = accounts.select(F.lower(F.trim("email")).alias("account")).filter("account <> ''").distinct()
    return rows.join(own, F.lower("account_email") == F.col("account"), "left_semi")
