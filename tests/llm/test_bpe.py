import hashlib
import random
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from brambler.llm.bpe import PrefixBpe, decode, default_path, encode

SAMPLES = ["", " ", "Hello, World's best: don't they'll I'VE 'S", "x" * 5000, "aaaa aaaaaaa aaaaaaaaaaaaaa", "É́ ÀÉÎ ﬁ ΟΔΟΣ ΣΑΣ İstanbul ß", "<|startoftext|>a<|endoftext|> <|end", "1234 ½ Ⅷ ²", "\x1c\x1d\x1e\x1f\x85\xa0 ​﻿ a\x00b", "日本語 テスト 😀👍🏽 é", "''s'' ---- ...!!! _under_score", "aͅb ǅ ẞ"]


@pytest.fixture(scope="module")
def both():
    return PrefixBpe(open(default_path(), "rb").read()), Tokenizer.from_file(default_path())


def test_matches_library(both):
    own, lib = both
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzéüñ'.,-0123456789 \n"
    more = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000)]
    more += ["".join(rng.choices("thinganderlo", k=rng.randint(1, 40))) for _ in range(3000)]
    more += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x3000)])) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    # code points that the Python at hand doesn't know yet have no settled class
    more = ["".join(c for c in t if unicodedata.category(c) != "Cn") for t in more]
    for text in SAMPLES + more:
        want = lib.encode(text, add_special_tokens=False).ids
        ids, decoded = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert decoded == lib.decode(want, skip_special_tokens=False), repr(text)


def test_frame(spark, both):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*SAMPLES, None])], "doc_id long, text string, n_tokens string")
    rows = {r.doc_id: r for r in encode(docs, default_path(), ["n_tokens", "ids", "ids_sha256"]).collect()}
    for i, t in enumerate([*SAMPLES, None]):
        want = both[1].encode(t or "", add_special_tokens=False).ids
        assert rows[i].ids == want and rows[i].n_tokens == len(want)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    back = {r.doc_id: r.decoded for r in decode(encode(docs, default_path(), ["ids"]), default_path()).collect()}
    assert back[2] == both[1].decode(rows[2].ids, skip_special_tokens=False)
    assert encode(docs.limit(0), default_path()).count() == 0
