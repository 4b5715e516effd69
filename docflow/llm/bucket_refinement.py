"""Exact substring removal by bucket-pointer refinement.

Every position belongs to the bucket of its q-gram. Buckets are refined as in suffix sorting: a
position's next identifier is made of its own one and that of a later offset, and each round
reuses the identifiers of the round before: 20 bytes, then 40, 80 and 100. Identifiers are
64-bit hashes, so a later offset's identifier is known without a lookup.

Not all positions travel. A window of 100 bytes is represented by the position of its smallest
q-gram (the rightmost of equal ones), which depends on the window's bytes alone; successive windows
with one representative form a run. Runs are shuffled by the bucket of their representative;
buckets of one run are done; the others are refined by the identifiers of the runs' ends, which
fix all their bytes. Of each refined bucket only the first run goes on. Its windows fall into four
parts by their distance from the representative; all windows of a part hold the same core of 80
bytes, and a part whose core no other run of the bucket has is done. What is left is opened into
positions and refined to the full length. Whole copies of a document are recognised beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import MAX_BROADCAST_IDS, stored, table, with_ids
from .textbytes import U, batches, mix, prefix_sums, span_hashes

LENGTH = 100
GRAM = 20
PARTS = 4
STEP = (LENGTH - GRAM) // PARTS
CORE = LENGTH - STEP

# Bytes of text that a task refines at a time.
BATCH = 300_000

WEIGHTS = mix(np.arange(2001, 2005, dtype=U)) | U(1)


def identifiers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position of ``raw``: the identifier of its q-gram, and those of its ``CORE`` and of its
    ``LENGTH`` bytes, each refined from the one before by that of a later offset. Positions
    without enough bytes after them have none."""
    starts = np.arange(len(raw) - GRAM + 1)
    known = [span_hashes(prefix_sums(raw), starts, starts + GRAM)]
    depth = GRAM
    for goal in (2 * GRAM, CORE, LENGTH):
        now, later = known[-1], goal - depth
        known.append(mix(now[: len(now) - later] * WEIGHTS[0] + now[later:] * WEIGHTS[1]))
        depth = goal
    return known[0], known[2], known[3]


def runs(ends: np.ndarray, gram: np.ndarray):
    """Owner, representative, first and last window of every run. ``ends`` closes the texts that
    ``raw`` concatenates; windows do not cross them."""
    width = LENGTH - GRAM + 1
    bits = U(max(24, len(gram).bit_length()))
    rank = (gram >> bits << bits) | np.arange(len(gram) - 1, -1, -1, dtype=U)
    best, span = rank, 1
    while span < width:
        step = min(span, width - span)
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    at = (len(gram) - 1) - (best & ((U(1) << bits) - U(1))).astype(np.int64)
    start = np.arange(len(at))
    owner = np.searchsorted(ends, start, side="right")
    inside = start + LENGTH <= ends[np.minimum(owner, len(ends) - 1)]
    start, at, owner = start[inside], at[inside], owner[inside]
    if not len(start):
        return owner, at, start, start
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return owner[first], at[first], start[first], start[last]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _concatenated(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([len(t) for t in texts])


def _runs_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a, b in batches([len(t) for t in frame["text"]], BATCH):
            raw, ends = _concatenated([_bytes(t) for t in frame["text"].iloc[a:b]])
            if len(raw) < LENGTH:
                continue
            gram, half, full = identifiers(raw)
            owner, at, lo, hi = runs(ends, gram)
            content = mix(full[lo] * WEIGHTS[2] + full[hi] * WEIGHTS[3] + (hi - lo).astype(U))
            base = (ends - np.diff(ends, prepend=0))[owner]
            cores = np.zeros(len(at), dtype=U)
            for j in range(PARTS):
                core = half[np.clip(at - STEP * j, 0, len(half) - 1)]
                cores |= (core >> U(48)) << U(16 * j)
            yield pd.DataFrame(
                {
                    "bucket": gram[at].view(np.int64),
                    "content": content.view(np.int64),
                    "doc": frame["doc"].to_numpy()[a:b][owner],
                    "lo": lo - base,
                    # how far the representative lies behind the first and behind the last window
                    "far": (at - lo).astype(np.int8),
                    "near": (at - hi).astype(np.int8),
                    # 16 bits of the core of each part
                    "cores": cores.view(np.int64),
                }
            )


def _positions_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bucket, identifier and place of every window of the wanted runs."""
    for frame in frames:
        for a, b in batches([len(t) for t in frame["text"]], BATCH):
            raw, ends = _concatenated([_bytes(t) for t in frame["text"].iloc[a:b]])
            _, _, full = identifiers(raw)
            base = ends - np.diff(ends, prepend=0)
            parts = []
            for k in range(a, b):
                wanted = frame["wanted"].iloc[k]
                lo = np.array([w["lo"] for w in wanted], dtype=np.int64)
                n = np.array([w["more"] for w in wanted], dtype=np.int64) + 1
                bucket = np.repeat(np.array([w["bucket"] for w in wanted], dtype=np.int64), n)
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pos = np.repeat(lo, n) + inner
                parts.append((bucket, full[base[k - a] + pos].view(np.int64), np.full(len(pos), frame["doc"].iloc[k]), pos))
            yield pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(["bucket", "content", "doc", "pos"])})


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row_id, doc, text``: the rows with a number for each document, in the order of their ids.

    Whole-number ids of one text each are the numbers themselves. Where there are other ids (null
    ones, strings, several texts under one id), a document is an id with a text, ordered by id, null
    first, then by the text's hash; the sorted list of these is stored, with its row numbers."""
    own = docs.select(F.col(doc_id).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = own.select("row_id", F.xxhash64("text").alias("hash"))
    if isinstance(docs.schema[doc_id].dataType, IntegralType):
        texts = keys.groupBy("row_id").agg(F.min("hash").alias("least"), F.max("hash").alias("most"))
        if texts.where("row_id is null or least < most").isEmpty():
            return own.select("row_id", F.col("row_id").cast("long").alias("doc"), "text")
    in_order = keys.distinct().orderBy("row_id", "hash").select(F.col("row_id").alias("id"), "hash", F.monotonically_increasing_id().alias("doc"))
    numbers = stored(in_order, "numbers")
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash"))
    return stored(own.join(numbers, same).select("row_id", "doc", "text"), "numbered")


def repeated_spans(own: DataFrame) -> DataFrame:
    """``doc, copy, found`` of every document of ``numbered`` rows with bytes to remove: ``copy`` if an
    earlier document has the same text, else ``found``, byte ranges ``(lo, hi)`` that cover them.

    Repeated rows are one document. Texts under 100 bytes have no windows."""
    sized = own.where(F.octet_length("text") >= LENGTH).select("doc", F.unhex(F.md5(F.encode("text", "utf-8"))).alias("digest"))
    firsts = sized.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = stored(sized.join(firsts, "digest").where("doc > first").select("doc").distinct(), "copies")
    source = own.where(F.octet_length("text") >= LENGTH).join(copies, "doc", "left_anti")
    made = source.mapInPandas(_runs_of, "bucket long, content long, doc long, lo long, far byte, near byte, cores long")
    several = made.groupBy("bucket").count().where(F.col("count") > 1).select(F.col("bucket").alias("b"))
    shared = stored(made.join(several, F.col("bucket") == F.col("b")).drop("b"), "shared")
    # the first run of each content, and the buckets that hold different contents
    firsts = stored(
        shared.groupBy("bucket", "content").agg(F.min(F.struct("doc", "lo", "far", "near", "cores")).alias("first"), F.count("*").alias("n")), "contents"
    )
    place = F.struct("doc", "lo")
    repeated = firsts.where("n > 1").select(F.col("bucket").alias("b"), F.col("content").alias("c"), "first")
    whole = (
        shared.join(repeated, (F.col("bucket") == F.col("b")) & (F.col("content") == F.col("c")))
        .where(place != F.struct("first.doc", "first.lo"))
        .select("doc", "lo", (F.col("lo") + F.col("far") - F.col("near") + LENGTH).alias("hi"))
    )
    parts = firsts.select("bucket", "first.*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    least = F.greatest(F.col("near").cast("int"), F.col("part") * STEP)
    most = F.least(F.col("far").cast("int"), F.col("part") * STEP + F.when(F.col("part") == PARTS - 1, STEP).otherwise(STEP - 1))
    parts = parts.select(
        "bucket",
        "doc",
        "part",
        F.expr("shiftright(cores, 16 * part) & 65535").alias("core"),
        (F.col("lo") + F.col("far") - most).alias("lo"),
        (most - least).alias("more"),
    ).where("more >= 0")
    held = parts.groupBy("bucket", "part", "core").count().where(F.col("count") > 1).select(
        F.col("bucket").alias("b"), F.col("part").alias("p"), F.col("core").alias("c")
    )
    wanted = stored(
        parts.join(held, (F.col("bucket") == F.col("b")) & (F.col("part") == F.col("p")) & (F.col("core") == F.col("c")))
        .groupBy("doc")
        .agg(F.collect_list(F.struct("bucket", "lo", "more")).alias("wanted")),
        "wanted",
    )
    opened = with_ids(own, "doc", wanted.select("doc")).join(wanted, "doc").select("doc", "text", "wanted")
    positions = stored(opened.mapInPandas(_positions_of, "bucket long, content long, doc long, pos long"), "positions")
    earliest = (
        positions.groupBy("bucket", "content")
        .agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("bucket").alias("b"), F.col("content").alias("c"), "first")
    )
    single = (
        positions.join(earliest, (F.col("bucket") == F.col("b")) & (F.col("content") == F.col("c")))
        .where(F.struct("doc", "pos") != F.col("first"))
        .select("doc", F.col("pos").alias("lo"), (F.col("pos") + LENGTH).alias("hi"))
    )
    ranges = whole.union(single).groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("found"), F.lit(False).alias("copy"))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    return ranges.select("doc", "copy", "found").union(copies.select("doc", F.lit(True), none))


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a, b in batches([len(t) for t in frame["text"]], BATCH):
            spans, left, sizes = [], [], []
            for text, copy, found in zip(frame["text"].iloc[a:b], frame["copy"].iloc[a:b], frame["found"].iloc[a:b]):
                raw = _bytes(text)
                ranges = sorted((r["lo"], r["hi"]) for r in found) if found is not None else []
                if copy is True:
                    ranges = [(0, len(raw))]
                merged: list[list[int]] = []
                for lo, hi in ranges:
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                done, kept = 0, []
                for lo, hi in merged:
                    kept.append(raw[done:lo])
                    done = hi
                kept.append(raw[done:])
                spans.append(merged)
                left.append(b"".join(kept))
                sizes.append(len(raw))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy()[a:b], "n_bytes": sizes, "spans": spans, "kept": left})


def remove_repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, spans`` (the removed byte ranges, in order, as pairs)
    and ``kept`` (the bytes that are left; cutting may split a character).

    Ids of any type that can be ordered; null ids come first, and of different texts under one id the
    one with the smaller hash. Null texts are empty. Repeated rows are one document and lose the same
    bytes. An empty table gives no rows. Other columns are ignored, whatever their names."""
    rows = numbered(docs, doc_id, text)
    found = stored(repeated_spans(rows), "found")
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = None
    ids = found.select("doc")
    if ids.count() <= MAX_BROADCAST_IDS:  # texts that stay whole need no shuffle
        whole, rows = rows.join(F.broadcast(ids), "doc", "left_anti"), with_ids(rows, "doc", ids)
    joined = rows.join(found, "doc", "left")
    made = joined.select(F.col("row_id").cast("string").alias("doc_id"), "text", "copy", "found").mapInPandas(
        _cut, "doc_id string, n_bytes long, spans array<array<long>>, kept binary"
    )
    if whole is not None:
        made = made.union(
            whole.select(
                F.col("row_id").cast("string"),
                F.octet_length("text").cast("long"),
                F.array().cast("array<array<bigint>>"),
                F.encode("text", "utf-8"),
            )
        )
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))


def op5_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the bytes it loses and the digest of the rest."""
    made = remove_repeated_spans(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
