"""BPE encoding and decoding with a pair occurrence index.

Each task gathers the new words of a batch of documents, maps every adjacent pair of symbols to
all its positions, and applies the pairs that occur in ascending order of rank; a merge updates
the lists of the neighbouring pairs. Encoded words are kept per worker, up to a bound.
The vocabulary file is a parameter: executors read it from the path where they have it.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, table

CHARS_AT_ONCE = 200_000
KEPT_WORDS = 200_000


def _byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code
    points from 256 on, in byte order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PairIndexBpe:
    """One vocabulary file of kind BPE with word ends (lower case, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"]
        alphabet = _byte_symbols()
        self.inner = [vocab[s] for s in alphabet]
        self.last = [vocab[s + end] for s in alphabet]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(self.merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text; strings of special tokens stay whole, as the only entries that
        contain them."""
        parts = self.marks.split(text) if self.marks and "<|" in text else [text]
        out: list[str] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(part)
            elif part:
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += self.word.findall(plain)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, all at once, by the pair index."""
        new = [w for w in words if w not in self.known]
        sym: list[int] = []
        starts: list[int] = []
        ahead: list[int] = []
        for w in new:
            starts.append(len(sym))
            raw = w.encode("utf-8", "surrogatepass")
            sym += [self.inner[b] for b in raw[:-1]]
            sym.append(self.last[raw[-1]])
        first = set(starts)
        n = len(sym)
        ahead = [i + 1 if i + 1 < n and i + 1 not in first else -1 for i in range(n)]
        back = [i - 1 if i not in first else -1 for i in range(n)]
        index: dict[int, list[int]] = {}
        rank = self.rank
        for i, j in enumerate(ahead):
            if j >= 0 and (r := rank.get((sym[i], sym[j]))) is not None:
                index.setdefault(r, []).append(i)
        active = list(index)
        heapq.heapify(active)
        while active:
            now = heapq.heappop(active)
            a, b, c = self.merges[now]
            for i in sorted(index.pop(now)):
                if sym[i] != a or (j := ahead[i]) < 0 or sym[j] != b:
                    continue
                sym[i], sym[j] = c, -1
                k = ahead[i] = ahead[j]
                if k >= 0:
                    back[k] = i
                    if (r := rank.get((c, sym[k]))) is not None:
                        if r not in index:
                            index[r] = []
                            heapq.heappush(active, r)
                        index[r].append(i)
                if (h := back[i]) >= 0 and (r := rank.get((sym[h], c))) is not None:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(active, r)
                    index[r].append(h)
        flat = np.array(sym, dtype="<i8")
        bounds = [*starts, n]
        for w, s, e in zip(new, bounds, bounds[1:]):
            own = flat[s:e]
            self.known[w] = own[own >= 0].astype("<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.words(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        for s, i in self.special.items():
            self.known[s] = np.array([i], dtype="<u4").tobytes()
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids joined by blanks: the file names no decoder."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_loaded: dict[str, PairIndexBpe] = {}


def bpe(path: str) -> PairIndexBpe:
    if path not in _loaded:
        _loaded[path] = PairIndexBpe(path)
    return _loaded[path]


def default_vocabulary() -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path("word_bpe_49k.json")
    except ImportError:
        return os.path.join("/opt/tokenizers", "word_bpe_49k.json")


def _encoder(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = bpe(path)
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            done = 0
            while done < len(texts):
                end, size = done, 0
                while end < len(texts) and (end == done or size + len(texts[end]) <= CHARS_AT_ONCE):
                    size += len(texts[end])
                    end += 1
                ids = model.encode_batch(texts[done:end])
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[done:end].reset_index(drop=True),
                        "ids": ids,
                        "decoded": [model.decode(x) for x in ids],
                    }
                )
                done = end

    return run


def encode_documents(
    docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (packed little-endian unsigned 32-bit integers) and
    ``decoded``. A null text is an empty one and has no ids; repeated rows and null ids are
    encoded like any other; other columns are ignored. A batch holds about
    ``CHARS_AT_ONCE`` characters; a longer text is a batch of its own."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema[doc_id].dataType.simpleString()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if kind in ("bigint", "int"):  # pandas would turn ids with nulls into floating point
        rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(releasing(_encoder(path)), f"doc_id {'string' if kind in ('bigint', 'int') else kind}, ids binary, decoded string")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def op7_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    made = encode_documents(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
