import hashlib
import zlib

from hypothesis import given
from hypothesis import strategies as st

from brambler.llm.media import FEATURES, from_png, op9_media, payload_of, read_range, store, to_png


@given(st.binary(max_size=3000))
def test_png_round_trip(data):
    payload = payload_of(data)
    assert len(payload) % 64 == 0 and payload
    assert from_png(to_png(payload)) == payload


def test_query(spark, tmp_path):
    texts = [None, "", "a", "a", "é" * 64, "x" * 64, "long " * 50_000, "a"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "b", 2)], "doc_id long, text string, digest int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op9_media(spark, f"file://{tmp_path}").collect()}
    assert len(rows) == 9
    for i, t in [*enumerate(texts), (None, "b")]:
        payload = payload_of((t or "").encode())
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.width, r.height) == (64, len(payload) // 64)
        assert r.media_sha256 == hashlib.sha256(to_png(payload)).hexdigest() and r.media_bytes == r.length
    assert [rows[2][c] for c in FEATURES] == [rows[7][c] for c in FEATURES] and rows[2].offset == rows[3].offset
    uri, index = store(docs)
    assert index.count() == 6  # distinct payloads
    one = index.first()
    assert hashlib.sha256(from_png(read_range(uri, one.shard, one.offset, one.length))).digest() == one.digest
    assert store(docs, resident=0)[1].count() == 6
    assert store(docs.limit(0))[1].count() == 0
