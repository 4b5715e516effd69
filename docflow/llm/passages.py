"""Removal of passages that an earlier place holds word for word.

A passage is ``WINDOW`` words or more, whatever lines they stand in. Each window of that many words
names one of the runs of ``ANCHOR`` words inside it, the one with the least hash, so equal windows
name equal runs. Only windows whose run occurs at several places are hashed and compared; words in a
window that an earlier place holds go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators import bloom

from .common import releasing, split_by_hash, stored
from .textbytes import U, batches, distinct, mix, plain_words, prefix_sums, span_hashes

WINDOW = 50
ANCHOR = 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPOT = ("doc_id", "text_hash", "place")


def _word_runs(texts: list[bytes], widths: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of all runs of each width of words, over the joined texts, by their first word; the
    text of each word and the first word of each text. Runs across texts are for the caller to drop."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    full = ends > starts
    starts, ends = starts[full], ends[full]
    closing = np.cumsum([len(t) + 1 for t in texts]) - 1
    owner = np.searchsorted(closing, starts, side="left")
    firsts = np.searchsorted(owner, np.arange(len(texts)))
    sums = prefix_sums(raw)
    runs = [span_hashes(sums, starts[: len(starts) - w + 1], ends[w - 1 :]) if len(starts) >= w else np.zeros(0, dtype=U) for w in widths]
    return runs, owner, firsts


def _named(anchors: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` windows, the first word of the anchor that it names: the leftmost least."""
    width = WINDOW - ANCHOR + 1
    best = np.arange(len(anchors))
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(anchors[right] < anchors[left], right, left)
        covered += step
    return best[:n]


def _windows(texts: list[bytes]):
    """Text, place and hash of every window, with the hash of the anchor that it names."""
    (anchors, whole), owner, firsts = _word_runs(texts, (ANCHOR, WINDOW))
    inside = owner[: len(whole)] == owner[WINDOW - 1 :] if len(whole) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(inside)
    named = _named(anchors, len(whole))[at]
    return owner[at], at - firsts[owner[at]], whole[at], anchors[named], named


def _source(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("row_id").cast("string").alias("doc_id"), F.col("row_hash").alias("text_hash"), "text")


def _anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [plain_words(t) for t in frame["text"]]
        for a, b in batches([len(t) for t in texts]):
            own, _, _, anchor, named = _windows(texts[a:b])
            _, firsts = np.unique(named, return_index=True)
            who, anchor, n = distinct(own[firsts], anchor[firsts])
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].iloc[a + who].reset_index(drop=True),
                    "text_hash": frame["text_hash"].iloc[a + who].reset_index(drop=True),
                    "anchor": anchor.view(np.int64),
                    "n": n.astype(np.int64),
                }
            )


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [plain_words(t) for t in frame["text"]]
        for a, b in batches([len(t) for t in texts]):
            own, place, whole, anchor, _ = _windows(texts[a:b])
            wanted = [np.asarray(x, dtype=np.int64) for x in frame["shared"].iloc[a:b]]
            size = [len(x) for x in wanted]
            # anchors are looked up text by text
            keys = mix(np.concatenate(wanted).view(U)) + np.repeat(np.arange(b - a), size).astype(U)
            on = np.isin(mix(anchor) + own.astype(U), keys)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].iloc[a + own[on]].reset_index(drop=True),
                    "text_hash": frame["text_hash"].iloc[a + own[on]].reset_index(drop=True),
                    "place": place[on].astype(np.int32),
                    "window": whole[on].view(np.int64),
                }
            )


def repeated_windows(rows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, windows``: the first words, counted from 0, of the windows that an earlier
    place of ``rows`` (``row_id, row_hash, text``) holds. Places come in the order of id, text hash and
    word; a window that overlaps the first place in its own text is no repetition of it."""
    kind = rows.schema["row_id"].dataType.simpleString()
    found = stored(_source(rows).mapInPandas(releasing(_anchors), "doc_id string, text_hash long, anchor long, n long"), "anchors")
    shared = stored(found.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "shared_anchors")
    maybe = bloom.build(shared, "anchor").split(found, "anchor").where("_maybe").drop("_maybe")
    wanted = stored(maybe.join(shared, "anchor").groupBy("doc_id", "text_hash").agg(F.collect_set("anchor").alias("shared")), "wanted")
    own, _ = split_by_hash(_source(rows), "text_hash", wanted)
    named = wanted.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "shared")
    same = (F.col("text_hash") == F.col("own_hash")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    hashed = own.join(named, same).select("doc_id", "text_hash", "text", "shared").mapInPandas(
        releasing(_hashed), "doc_id string, text_hash long, place int, window long"
    )
    windows = stored(hashed.withColumn("doc_id", F.col("doc_id").cast(kind)), "windows")
    spot = F.struct(*SPOT)
    first = windows.groupBy("window").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
    first = stored(first.where(~F.col("first").eqNullSafe(F.col("last"))).select("window", "first"), "first_windows")
    own_text = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    again = windows.join(first, "window").where(~own_text | (F.col("place") >= F.col("first.place") + WINDOW))
    return again.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("place")).alias("windows"))


def cut(text: str, windows: np.ndarray) -> tuple[str, list[list[int]]]:
    """``text`` without the words of the windows that start at the given words, each run with the
    blank that follows it; and the runs, as first and last word."""
    runs: list[list[int]] = []
    for w in windows:
        if runs and w <= runs[-1][1] + 1:
            runs[-1][1] = int(w) + WINDOW - 1
        else:
            runs.append([int(w), int(w) + WINDOW - 1])
    words = [m.span() for m in WORD.finditer(text)]
    out, done = [], 0
    for a, b in runs:
        out.append(text[done : words[a][0]])
        done = words[b][1]
        done += text[done : done + 1] == " "
    return "".join(out) + text[done:], runs


def remove_passages(rows: DataFrame) -> DataFrame:
    """``rows`` (``row_id, row_hash, text`` and others; stored) with the text that is left, and the words
    removed as ``removed_passages``, runs of first and last word of the text given (empty if none)."""
    gone = stored(repeated_windows(rows), "passages")

    def run(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, windows in frames:
            made = [(t, []) if w is None else cut(t, w) for t, w in zip(texts, windows)]
            yield pd.DataFrame({"text": [t for t, _ in made], "runs": [r for _, r in made]})

    cutting = F.pandas_udf(run, "text string, runs array<array<int>>")
    others = [c for c in rows.columns if c != "text"]
    none = F.array().cast("array<array<int>>").alias("removed_passages")
    hit, whole = split_by_hash(rows, "row_hash", gone.select(F.col("text_hash").alias("row_hash")))
    same = (F.col("row_hash") == F.col("text_hash")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
    made = hit.join(gone, same, "left").select(*others, cutting("text", "windows").alias("made"))
    made = made.select(*others, F.col("made.text").alias("text"), F.col("made.runs").alias("removed_passages"))
    return made if whole is None else made.union(whole.select(*others, "text", none))
