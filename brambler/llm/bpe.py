"""BPE encoding and decoding by per-prefix dynamic programming (operator 8).

For every prefix of a word exactly one vocabulary token can be the last one of its encoding. Tokens that end at
a position come from a suffix automaton over the vocabulary; a token is right if its start is the end of a prefix
whose own last token forms a compatible pair with it, i.e. BPE would leave both as they are side by side. The
tokens found are stored per prefix and back-pointers give the ids, in time linear in the word.

The vocabulary file is a parameter; its content is broadcast (a vocabulary, so bounded). A null or empty text has no
tokens; ids of an empty text are no bytes; repeated rows are encoded each on their own; columns of docs that have the
name of a result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches, tidy

END = "</w>"
#: Stands for END inside the automaton; no byte of a text is mapped to it.
CLOSE = "\n"
#: Entries in each of the two generations of a worker's cache of text pieces, and the longest piece kept there.
CACHE, CACHED_CHARS = 150_000, 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


def of_category(major: str) -> str:
    """Ranges, as in a character class, of the code points of a major category (as the Python at hand knows them)."""
    codes = np.array([c for c in range(0x110000) if unicodedata.category(chr(c))[0] == major])
    ends = np.flatnonzero(np.diff(codes) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[[0, *ends + 1]], codes[[*ends, -1]], strict=True))


class PrefixBpe:
    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.strings = dict((i, s) for s, i in vocab.items()) | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", SPACES).replace(r"\p{L}", of_category("L")).replace(r"\p{N}", of_category("N")))
        self.blank = regex.compile(f"[{SPACES}]+")
        self.rank = [-1] * (max(self.strings) + 1)
        self.halves: list[tuple[int, int] | None] = [None] * len(self.rank)
        self.pairs: dict[tuple[int, int], int] = {}
        for k, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            t, pair = vocab[left + right], (vocab[left], vocab[right])
            self.pairs.setdefault(pair, k)
            if self.halves[t] is None:
                self.rank[t], self.halves[t] = k, pair
        self.size = [0] * len(self.rank)
        self.automaton = ahocorasick.Automaton()
        for s, t in vocab.items():
            letters = s.removesuffix(END)
            self.size[t] = len(letters)
            if self._stands(t):
                self.automaton.add_word(letters + CLOSE * s.endswith(END), t)
        self.automaton.make_automaton()
        self.letters = byte_letters()
        self.fit: dict[int, bool] = {}
        self.young: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def _stands(self, t: int) -> bool:
        """Whether a token's own letters are encoded as that token."""
        if self.halves[t] is None:
            return self.size[t] == 1
        return self.fits(*self.halves[t], below=self.rank[t])

    def fits(self, a: int, b: int, below: int = 1 << 60) -> bool:
        """Whether no merge of rank under `below` joins what stands at the border of a and b while they are built.

        Both are taken apart, the later merge first; at each step the two symbols that meet may have been joined
        before either was used up. Of equal merges the left one comes first.
        """
        limit = below
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:
                return False
            if self.rank[a] > self.rank[b]:
                limit, a = min(limit, self.rank[a]), self.halves[a][1]
            elif self.rank[b] >= 0:
                limit, b = min(limit, self.rank[b] + 1), self.halves[b][0]
            else:
                return True

    def word(self, letters: str) -> list[int]:
        """Ids of one pre-token, given as byte letters."""
        n, size, fit = len(letters), self.size, self.fit
        last, done = [0] * (n + 1), 0
        for end, t in self.automaton.iter(letters + CLOSE):
            at = n if end == n else end + 1
            if at <= done or end == n - 1:
                continue
            start = at - size[t]
            if start:
                key = last[start] << 20 | t
                good = fit.get(key)
                if good is None:
                    if len(fit) > 1_000_000:
                        fit.clear()
                    good = fit[key] = self.fits(last[start], t)
                if not good:
                    continue
            last[at], done = t, at
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= size[last[at]]
        return ids[::-1]

    def piece(self, text: str) -> tuple[bytes, str]:
        """Ids (4 bytes each) and decoded text of what stands between two blanks, lower case already."""
        found = self.old.get(text)
        if found is None:
            ids: list[int] = []
            letters = self.letters
            for w in self.pieces.findall(text):
                ids += self.word(w if w.isascii() and w.isprintable() else "".join([letters[b] for b in w.encode()]))
            found = np.array(ids, "<u4").tobytes(), " ".join([self.strings[i] for i in ids])
        if len(text) <= CACHED_CHARS:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[text] = found
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text they decode to."""
        ids: list[bytes] = []
        decoded: list[str] = []
        at = 0
        for m in self.cut.finditer(text):
            self._plain(text[at : m.start()], ids, decoded)
            ids.append(np.array([self.special[m[0]]], "<u4").tobytes())
            decoded.append(m[0])
            at = m.end()
        self._plain(text[at:] if at else text, ids, decoded)
        return b"".join(ids), " ".join(decoded)

    def _plain(self, text: str, ids: list[bytes], decoded: list[str]) -> None:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # capital sigma has one lower case here
        parts = self.blank.split(text) if ODD.search(text) else text.split()
        get, piece = self.young.get, self.piece
        for p in parts:
            a, b = get(p) or piece(p)
            if a:
                ids.append(a)
                decoded.append(b)


#: What the vocabulary's own patterns take as a blank, as a character class.
SPACES = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where str.split() and SPACES differ.
ODD = regex.compile(r"[\x1c-\x1f]")


@functools.lru_cache(maxsize=2)
def _loaded(digest: str, content: bytes) -> PrefixBpe:
    return PrefixBpe(content)


KINDS = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encoder_of(spark: SparkSession, path: str):
    """The vocabulary, broadcast; calling the result in a task gives the encoder."""
    with open(path, "rb") as file:
        content = file.read()
    shared, digest = spark.sparkContext.broadcast(content), hashlib.sha256(content).hexdigest()
    return lambda: _loaded(digest, shared.value)


def encode(docs: DataFrame, path: str, results: Iterable[str] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """docs with the named results (see KINDS) for each row's text, in place of columns of these names."""
    results = list(results)
    small_batches(docs.sparkSession)
    get = encoder_of(docs.sparkSession, path)
    keep = [c for c in docs.columns if c not in results]

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = get()
        for batch in batches:
            got: dict[str, list] = {r: [] for r in results}
            for text in batch["text"].to_pylist():
                ids, decoded = bpe.encode(text or "")
                for r, values in got.items():
                    if r == "n_tokens":
                        values.append(len(ids) // 4)
                    elif r == "ids":
                        values.append(np.frombuffer(ids, "<i4"))
                    elif r == "decoded":
                        values.append(decoded)
                    elif r == "ids_sha256":
                        values.append(hashlib.sha256(ids).hexdigest())
                    else:
                        values.append(hashlib.sha256(decoded.encode()).hexdigest())
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + [pa.array(got[r], kinds.get(r, pa.string())) for r in results], names=[*keep, *results])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep] + [f"{r} {KINDS[r]}" for r in results])
    return docs.select(*[F.col(f"`{c}`") for c in (keep if "text" in keep else [*keep, "text"])]).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """rows with `decoded`, the text of the ids in a column, special tokens included."""
    get = encoder_of(rows.sparkSession, path)

    @F.pandas_udf("string")
    def text(ids):
        strings = get().strings
        return ids.map(lambda row: " ".join([strings[i] for i in row]) if row is not None else "")

    return rows.withColumn("decoded", text(column))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, default_path(), ["n_tokens", "ids_sha256", "decoded_sha256"]).drop("text")
