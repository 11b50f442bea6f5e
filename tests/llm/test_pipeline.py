import zlib

import corpus_pipeline
from tests.llm.test_setsketch import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    """Each stage is held against what it says about its own input."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, at, sf_dir).cache()
        old_rows, rows = at.collect(), new.collect()
        if name != "bpe":
            assert new.columns == COLUMNS and all(r.n_chars == len(r.text) for r in rows)
        if name == "line dedup":
            assert {r.doc_id for r in rows} == {r.doc_id for r in old_rows}
            owner: dict = {}
            for r in sorted(old_rows, key=lambda r: r.doc_id):
                for line in {x.strip(" \t\n\v\f\r").lower() for x in r.text.split("\n")}:
                    owner.setdefault(line, []).append(r.doc_id)
            kept = {r.doc_id: r.text for r in rows}
            for r in old_rows:
                own = [x for x in r.text.split("\n") if len(k := x.strip(" \t\n\v\f\r").lower()) < 10 or owner[k][0] == r.doc_id]
                assert kept[r.doc_id] == "\n".join(own)
        if name == "near duplicates":
            old_rows.sort(key=lambda r: r.doc_id)
            _, group = brute([r.text for r in old_rows])
            assert sorted(r.doc_id for r in rows) == [r.doc_id for i, r in enumerate(old_rows) if group[i] == i]
        if name == "bpe":
            assert all(r.n_tokens == len(r.ids) for r in rows) and len(rows) == len(old_rows)
        at = new
    assert corpus_pipeline.run(spark, sf_dir).count() == at.count()


def test_odd_rows_and_extra_columns(spark):
    """Nulls in every column, repeated rows, a long text, and columns named like the operators' own."""
    names = ["n_lines", "n_dropped", "score", "size", "target", "taken", "rounds", "pieces", "ids", "n_tokens", "doc", "rep", "key", "held_out", "component_id", "__row", "__x", "__doc", "__own", "__score", "__shard", "__s", "__order", "__block", "own0_row", "__TIE", "own_n_lines"]
    extra = {n: i for i, n in enumerate(names)}
    line = "the same line of words here"
    rows = [(1, f"{line}\nown words one two three", "en", "a", 5), (2, line, "en", "a", 5), (2, line, "en", "a", 5), (None, None, None, None, None), (None, "x", None, None, None), (3, "", "en", None, 0), (4, "long " * 40_000, None, "b", 1), (5, " \n\t", "de", "b", 3), (6, f"{line}\r\nmore of it", None, None, None)]
    docs = spark.createDataFrame([(*r, *extra.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)).repartition(2)
    sf_dir = "/root/testdata/sf0.001"
    for table in (docs, docs.limit(0)):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            new = stage(spark, at, sf_dir).cache()
            if name != "bpe":
                assert new.columns == docs.columns
                assert all(r[n] == i for r in new.collect() for n, i in extra.items())
            at = new
        assert at.count() == 0 if table is not docs else at.count() > 0


def test_all_stay_if_nothing_was_learned(spark, tmp_path):
    """Labels that are empty, null, held out, or of no document: the first stage drops nothing."""
    docs = spark.createDataFrame([(i, f"words of text {i}", "en", "a", 5) for i in (1, 2, None)], "doc_id long, text string, lang string, source string, n_chars long")
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    more = docs.union(docs.limit(1).selectExpr(f"{held}L", "text", "lang", "source", "n_chars"))
    for k, rows in enumerate([[], [(1, 1, None)], [(held, 1, 1)], [(999, 1, 1)]]):
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        kept = corpus_pipeline.toxicity(spark, more, f"file://{tmp_path}/{k}")
        assert kept.columns == COLUMNS and kept.count() == 4
