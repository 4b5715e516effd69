"""Language-model score by the marginal likelihood of subword lattices.

All segmentations of a word into pieces of an existing vocabulary, and the word as a whole where
the training texts hold it, carry weight; forward recursion in log space sums them. Piece weights
start from the vocabulary's own scores and are re-estimated by forward-backward counts over
the training words; whole words have their discounted training counts, and the discounted mass
goes to the lattice. Words are scored once each and joined to the documents: the most frequent
ones by broadcast, the others by shuffle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .textbytes import batches, prefix_sums, span_hashes

# So many of the most frequent words are broadcast (about 100 bytes each).
FREQUENT = 10_000
ROUNDS = 2
WORD_MARK = "▁"
CELLS = 2_000_000


def default_vocabulary() -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path("piece_bpe_32k.model")
    except ImportError:
        return os.path.join("/opt/tokenizers", "piece_bpe_32k.model")


class Pieces:
    """The vocabulary's pieces as bytes; a blank marks the start of a word. A piece that the file
    lists twice (as a character and as a byte) is one."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        best: dict[bytes, int] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i):
                continue
            if model.is_byte(i):
                raw = bytes([int(model.id_to_piece(i)[3:-1], 16)])
            else:
                raw = model.id_to_piece(i).replace(WORD_MARK, " ").encode()
            if raw and b" " not in raw[1:]:
                # the file's scores fall by one a rank; bytes have none and come last
                rank = model.get_piece_size() if model.is_byte(i) else max(0, int(-model.get_score(i)))
                best[raw] = min(rank, best.get(raw, rank))
        best.setdefault(b" ", model.get_piece_size())
        self.pieces = sorted(best)
        start = np.array([1.0 / (best[p] + 10) for p in self.pieces])
        self.prior = np.log(start / start.sum())
        raw = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in self.pieces])
        hashes = span_hashes(prefix_sums(raw), ends - np.diff(ends, prepend=0), ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.sizes = sorted({len(p) for p in self.pieces})

    def arcs(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Word, start, end and piece of every piece that occurs in the marked words."""
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        size = np.array([len(t) for t in texts])
        close = np.cumsum(size)
        word = np.repeat(np.arange(len(texts)), size)
        first = (close - size)[word]
        rest = close[word] - np.arange(len(raw))
        sums = prefix_sums(raw)
        found = []
        for k in self.sizes:
            at = np.flatnonzero(rest >= k)
            if not len(at):
                break
            h = span_hashes(sums, at, at + k)
            on = self.maybe[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[on], h[on]
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[place] == h
            at, piece = at[hit], self.order[place[hit]]
            start = at - first[at]
            found.append((word[at], start, start + k, piece))
        return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _slices(by: np.ndarray, size: np.ndarray) -> list[slice]:
    """Runs of equal (by, size) of sorted arcs: no word occurs twice in one."""
    if not len(by):
        return []
    new = np.flatnonzero(np.concatenate(([True], (by[1:] != by[:-1]) | (size[1:] != size[:-1]))))
    return [slice(a, b) for a, b in zip(new, [*new[1:], len(by)])]


def forward(texts: list[bytes], arcs: tuple[np.ndarray, ...], weight: np.ndarray) -> np.ndarray:
    """Log marginals of all prefixes of each word, one row a word."""
    word, start, end, piece = arcs
    alpha = np.full((len(texts), max(map(len, texts)) + 1), -np.inf)
    alpha[:, 0] = 0.0
    order = np.lexsort((end - start, end))
    word, start, end, gain = word[order], start[order], end[order], weight[piece[order]]
    for s in _slices(end, end - start):
        w, e = word[s], end[s.start]
        alpha[w, e] = np.logaddexp(alpha[w, e], alpha[w, start[s]] + gain[s])
    return alpha


def marginals(texts: list[bytes], vocabulary: Pieces, weight: np.ndarray) -> np.ndarray:
    alpha = forward(texts, vocabulary.arcs(texts), weight)
    return alpha[np.arange(len(texts)), [len(t) for t in texts]]


def expected(texts: list[bytes], vocabulary: Pieces, weight: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations of each word, summed over the words."""
    arcs = word, start, end, piece = vocabulary.arcs(texts)
    size = np.array([len(t) for t in texts])
    alpha = forward(texts, arcs, weight)
    beta = np.full(alpha.shape, -np.inf)
    beta[np.arange(len(texts)), size] = 0.0
    order = np.lexsort((end - start, -start))
    w2, s2, e2, g2 = word[order], start[order], end[order], weight[piece[order]]
    for s in _slices(s2, e2 - s2):
        w, b = w2[s], s2[s.start]
        beta[w, b] = np.logaddexp(beta[w, b], beta[w, e2[s]] + g2[s])
    whole = alpha[np.arange(len(texts)), size]
    share = np.exp(alpha[word, start] + weight[piece] + beta[word, end] - whole[word])
    return np.bincount(piece, weights=share, minlength=len(weight))


def _marked(found: pd.Series) -> list[bytes]:
    return [b" " + w.encode("utf-8", "surrogatepass") for w in found]


def _grids(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Numbers of words of like size, whose tables stay under ``CELLS`` cells; a longer word is
    alone."""
    order = np.argsort([len(t) for t in texts], kind="stable")
    start = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or (i + 1 - start) * (len(texts[order[i]]) + 1) > CELLS // 8:
            yield order[start:i]
            start = i


def piece_weights(seen: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of the pieces: ``rounds`` of expected counts over the distinct training words
    ``word``, summed in the cluster. A round returns one number a piece, whatever the corpus."""
    vocabulary = pieces(path)
    weight = vocabulary.prior
    for _ in range(rounds):
        weight = _one_round(seen, path, weight)
    return weight


def _one_round(seen: DataFrame, path: str, weight: np.ndarray) -> np.ndarray:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = pieces(path)
        total = np.zeros(len(vocabulary.pieces))
        for frame in frames:
            texts = _marked(frame["word"])
            for g in _grids(texts):
                total += expected([texts[i] for i in g], vocabulary, weight)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used, "n": total[used]})

    counts = seen.select("word").mapInPandas(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    n = np.full(len(weight), 0.01)
    for r in counts:
        n[r["piece"]] += r["n"]
    return np.log(n / n.sum())


def _words(tokens: DataFrame) -> DataFrame:
    """``doc_id, text_hash, held_out, word`` of every word, A-Z in lower case: bytes know no other
    letters and no other blanks. About a megabyte of text is split at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in batches([len(t) for t in frame["text"]]):
                part = frame.iloc[a:b]
                found = [b" ".join(t.encode("utf-8", "surrogatepass").lower().split()).decode("utf-8", "surrogatepass") for t in part["text"]]
                yield part.drop(columns="text").assign(words=[t.split(" ") if t else [] for t in found])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    made = tokens.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        run, "doc_id string, text_hash long, held_out boolean, words array<string>"
    )
    return made.select(F.col("doc_id").cast(kind).alias("doc_id"), "text_hash", "held_out", F.explode("words").alias("word"))


def _tokens(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10, F.lit(0)) == 0
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), held.alias("held_out"), whole.alias("text"))


def lattice_scores(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    (log10 probabilities). Each row counts as a document in training, repeated ones too. A null
    text is empty: its only token is the end. A null id is held out. Without training texts all
    words are scored by the vocabulary's own weights alone. Other columns are ignored."""
    path = vocabulary or default_vocabulary()
    tokens = _tokens(docs, doc_id, text)
    trained = F.when(~F.col("held_out"), 1).otherwise(0)
    counts = stored(
        _words(tokens).select(trained.alias("t"), "word").groupBy("word").agg(F.sum("t").alias("c")), "words"
    )
    ends = tokens.agg(F.coalesce(F.sum(trained), F.lit(0))).first()[0]
    known = counts.where("c > 0")
    figures = known.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
        F.coalesce(F.sum((F.col("c") == 1).cast("int")), F.lit(0)).alias("once"), F.coalesce(F.sum((F.col("c") == 2).cast("int")), F.lit(0)).alias("twice"),
    ).first()
    n, v = figures["n"] + ends, figures["v"] + (1 if ends else 0)
    discount = figures["once"] / (figures["once"] + 2 * figures["twice"]) if figures["once"] else 0.5
    discount = min(0.95, max(0.1, discount))
    types = figures["v"]
    weight = piece_weights(known, path) if types else pieces(path).prior

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        for frame in frames:
            texts = _marked(frame["word"])
            lattice = np.zeros(len(texts))
            for g in _grids(texts):
                lattice[g] = marginals([texts[i] for i in g], model, weight)
            c = frame["c"].to_numpy(dtype=float)
            if types:
                with np.errstate(divide="ignore"):
                    whole = np.log(np.maximum(c - discount, 0.0) / n)
                lattice = np.logaddexp(whole, np.log(discount * types / n) + lattice)
            yield pd.DataFrame({"word": frame["word"], "c": frame["c"], "lp": lattice / np.log(10.0)})

    lexicon = stored(counts.mapInPandas(scored, "word string, c long, lp double"), "lexicon")
    base = F.log10((F.col("c") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    valued = lexicon.select(F.col("word").alias("key"), (F.col("c") > 0).cast("long").alias("known"), base.alias("base"), "lp")
    top = stored(lexicon.orderBy(F.desc("c"), "word").limit(frequent).select(F.col("word").alias("top")), "frequent")
    first = F.broadcast(valued.join(F.broadcast(top), F.col("key") == F.col("top"), "left_semi"))
    spread = _words(tokens).select("doc_id", "text_hash", "word")
    common = spread.join(first, F.col("word") == F.col("key"))
    rare = spread.join(F.broadcast(top), F.col("word") == F.col("top"), "left_anti").join(valued, F.col("word") == F.col("key"))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id", "text_hash").agg(
            F.count("*").alias("n"), F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("lp").alias("lp")
        )

    sums = (
        summed(common).union(summed(rare)).groupBy("doc_id", "text_hash")
        .agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("lp").alias("lp"))
        .toDF("d", "h", "n", "known", "base", "lp")
    )
    end_base = float(np.log10((ends + 0.1) / (n + 0.1 * (v + 1))))
    end_model = float(np.log10(ends / n)) if ends else end_base
    # equal rows are summed together: each has its share
    rows = tokens.groupBy("doc_id", "text_hash", "held_out").agg(F.count("*").alias("copies"))
    joined = rows.join(sums, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    joined = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    def part(c: Column) -> Column:
        return F.coalesce(c / F.col("copies"), F.lit(0.0))

    return joined.select(
        "doc_id",
        "held_out",
        (F.round(part(F.col("n"))).cast("long") + 1).alias("n_tokens"),
        (F.round(part(F.col("known"))).cast("long") + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (part(F.col("base")) + end_base).alias("base_score"),
        (part(F.col("lp")) + end_model).alias("score"),
    )


def op6_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base and lattice scores."""
    return lattice_scores(table(spark, sf_dir, "documents"))
