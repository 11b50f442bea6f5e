"""Fill-in-middle transformation over relational units (operator 11).

Texts become rows of units (lines); a window sums their lengths up to each unit's end. A document asks for two cuts by the
ordinal of a unit; the requests are joined to the units, the offsets of a document come together in one row, and the parts
are substrings of its text. All of it is DataFrame functions. Only lengths travel for units; texts travel once, to the
offsets.

Results for odd input: a null text is an empty one; an empty text and one that holds a mark is left plain; a null doc_id
draws as an id without digits; rows that share a doc_id (or have none) are cut each by its own text, and equal ones
alike; very long texts go like any other (a document's units are sorted, and spill); columns of docs come back in `row`,
whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read

#: A line with its end; the last one may have none.
UNIT = r"[^\n]*\n|[^\n]+"
#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
RATE, SPM, SEED = 100, 50, 7
KEY = ["id", "x1", "x2"]


def draw(k: int, seed: int = SEED) -> Column:
    """The k-th (from 0) number that an id draws: a group of 8 hex digits of sha256(seed:id)."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id")).cast("binary"), 256), 8 * k + 1, 8), 16, 10).cast("long")


def cuts(n: Column, seed: int = SEED) -> tuple[Column, Column]:
    """How many units the prefix takes, and the prefix with the middle."""
    one, two = draw(0, seed) % (n + 1), draw(1, seed) % (n + 1)
    return F.least(one, two), F.greatest(one, two)


def _keyed(docs: DataFrame) -> DataFrame:
    """id, text and a 128-bit hash of it: equal rows are cut alike, so these name what is cut."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), text.alias("text"), F.xxhash64(text).alias("x1"), F.xxhash64(F.lit(1), text).alias("x2"))


def offsets(rows: DataFrame, unit: str = UNIT, seed: int = SEED) -> DataFrame:
    """id, x1, x2 with the number of units and where prefix and middle end, in code points; nothing for empty texts."""
    parts = F.regexp_extract_all("text", F.lit(unit), F.lit(0))
    units = rows.select(*KEY, F.posexplode(F.transform(parts, lambda u: F.length(u))).alias("pos", "chars"))
    units = units.groupBy(*KEY, "pos").agg(F.max("chars").alias("chars"))  # equal rows have the same units
    line = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = units.select(*KEY, (F.col("pos") + 1).alias("ordinal"), F.sum("chars").over(line).alias("end"))
    asked = rows.filter("text <> ''").select(*KEY, F.size(parts).cast("long").alias("n")).groupBy(*KEY).agg(F.max("n").alias("n"))
    first, second = cuts(F.col("n"), seed)
    asked = asked.select(*KEY, "n", F.posexplode(F.array(first, second)).alias("cut", "asked"))
    # ordinals are compared beside the key, as both sides are dealt by the key alone
    met = asked.join(ends, (F.col("asked") - F.col("ordinal") == 0) & (asked.id == ends.id) & (asked.x1 == ends.x1) & (asked.x2 == ends.x2), "left")
    end = lambda k: F.coalesce(F.max(F.when(F.col("cut") == k, F.col("end"))), F.lit(0)).alias(f"end{k}")
    return met.groupBy(*[asked[c] for c in KEY]).agg(F.max("n").alias("n"), end(0), end(1))


def fill_in_middle(docs: DataFrame, unit: str = UNIT, rate: int = RATE, spm: int = SPM, seed: int = SEED, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output and row (docs' columns).

    unit is a Java pattern of which every match is a unit and whose matches make up the whole text; rate percent of the
    documents that can be cut are, spm percent of these with the suffix first.
    """
    rows = _keyed(docs)
    rows = rows.join(offsets(rows, unit, seed), KEY, "left")
    whole = (F.col("text") == "") | (draw(2, seed) % 100 >= rate)
    for m in marks:
        whole = whole | F.contains(F.col("text"), F.lit(m))
    form = F.when(whole, "plain").when(draw(3, seed) % 100 < spm, "spm").otherwise("psm")
    rows = rows.select("row", "doc_id", "text", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "end0", "end1", form.alias("form"))
    rest = F.length("text")
    prefix, middle, suffix = F.substring("text", F.lit(1), F.col("end0")), F.substring("text", F.col("end0") + 1, F.col("end1") - F.col("end0")), F.substring("text", F.col("end1") + 1, rest)
    p, s, m = map(F.lit, marks)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", "n", "form", F.when(cut, F.col("end0")).cast("long").alias("prefix_chars"), F.when(cut, F.col("end1") - F.col("end0")).cast("long").alias("middle_chars"), output.alias("output"), "row")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from: no text that is cut holds a mark, so the three marks are the only ones."""
    parts = F.split(output, "|".join(f"{re.escape(m)}" for m in marks), -1)
    one, two, three = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


#: Whole-table SQL for the same rows.
OP11_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
d AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
