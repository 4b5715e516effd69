"""Import an existing token tree.

A tracker tree holds one file per document at ``<root>/<...>/<status>/<year>/<ack_id>.txt``;
most are zero-byte, which Spark's file sources skip, so the tree is listed explicitly: the
driver walks folders down to the year level only (statuses x years, a few hundred folders),
and the year folders - which hold the files - are listed by executors in a ``mapInPandas`` job.
Bodies of processed tokens are read with the ``binaryFile`` source and joined on path.
File access goes through ``pyarrow.fs``, so local, HDFS and object-store roots all work.
"""

from __future__ import annotations

import fnmatch

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.paths import parse_status_path
from docflow.sources.fs import filesystem, uri_prefix


def _fs(root: str):
    return filesystem(root)


def _exists(path: str) -> bool:
    from pyarrow import fs as pafs

    filesystem, p = _fs(path)
    return filesystem.get_file_info(p).type != pafs.FileType.NotFound


def _year_dirs(root: str, years=None) -> list[str]:
    from pyarrow import fs as pafs

    filesystem, base = _fs(root)
    out, stack = [], [base]
    while stack:
        d = stack.pop()
        for info in filesystem.get_file_info(pafs.FileSelector(d, allow_not_found=True)):
            if info.type != pafs.FileType.Directory:
                continue
            if len(info.base_name) == 4 and info.base_name.isdigit():
                if years is None or int(info.base_name) in years:
                    out.append(info.path)
            else:
                stack.append(info.path)
    return sorted(out)


def scan_status_tree(spark: SparkSession, root: str, years=None, pattern: str = "*.txt",
                     dirs_per_task: int = 4) -> DataFrame:
    """Every token file (zero-byte ones included) under year folders of ``root``:
    (path, size). Names not matching ``pattern`` - such as '.claiming.' markers - are skipped.
    Paths keep the scheme and host of ``root``."""
    dirs = _year_dirs(root, set(years) if years is not None else None)
    scheme_root, prefix = root, uri_prefix(root)

    def list_dirs(batches):
        from pyarrow import fs as pafs

        filesystem, _ = _fs(scheme_root)
        for pdf in batches:
            paths, sizes = [], []
            for d in pdf["dir"]:
                for info in filesystem.get_file_info(pafs.FileSelector(d, allow_not_found=True)):
                    if info.type == pafs.FileType.File and fnmatch.fnmatchcase(info.base_name, pattern):
                        paths.append(prefix + info.path)
                        sizes.append(info.size)
            yield pd.DataFrame({"path": paths, "size": pd.Series(sizes, dtype="int64")})

    n = max(1, -(-len(dirs) // dirs_per_task))
    listing = spark.createDataFrame([(d,) for d in dirs] or [], "dir string").repartition(n)
    return listing.mapInPandas(list_dirs, "path string, size long")


def status_records(listing: DataFrame) -> DataFrame:
    """P10 over a listing: (ack_id, year, status, path, size) for valid year folders."""
    return parse_status_path(listing.select("path", "size"))


def _plain(col):
    # 'file:/x', 'file:///x' and 'hdfs://host/x' -> '/x', 's3a://bucket/x' -> '/x': both sides compare
    return F.regexp_replace(col, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def read_payload(spark: SparkSession, recs: DataFrame, root: str, status: str = C.PROCESSED) -> DataFrame:
    """The body of every token in ``status``; a zero-byte body is '' and a body that cannot be
    read becomes '[Error reading file: ...]'. Other statuses get null (they are dropped later)."""
    want = recs.where(F.col("status") == status)
    # only that status's folder is read: bodies of other tokens are neither read nor shuffled
    folder = f"{root.rstrip('/')}/{STATUS_FOLDERS.get(status, status)}"
    if _exists(folder):
        bodies = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.txt").load(folder)
            .select(_plain(F.col("path")).alias("_p"), F.col("content").cast("string").alias("value"))
        )
    else:  # no token has that status yet
        bodies = spark.createDataFrame([], "_p string, value string")
    joined = want.withColumn("_p", _plain(F.col("path"))).join(bodies, "_p", "left")
    text = (
        F.when(F.col("size") == 0, F.lit(""))
        .when(F.is_valid_utf8(F.col("value")), F.col("value"))
        .when(F.col("value").isNotNull(), F.concat(F.lit("[Error reading file: invalid UTF-8 in "), F.col("path"),
                                                   F.lit("]")))
        .otherwise(F.concat(F.lit("[Error reading file: "), F.col("path"), F.lit("]")))
    )
    done = joined.select("ack_id", "year", "status", "path", text.alias(C.OCR_TEXT_COL))
    rest = recs.where(F.col("status") != status).select(
        "ack_id", "year", "status", "path", F.lit(None).cast("string").alias(C.OCR_TEXT_COL))
    return done.unionByName(rest)


STATUS_FOLDERS = {C.TO_DOWNLOAD: "queue/to_download", C.TO_PROCESS: "queue/to_process"}
STATUS_FOLDERS.update({s: f"error/{s}" for s in C.ERROR_STATUSES})


def write_token_tree(current: DataFrame, root: str, body: str | None = "body") -> int:
    """Materialise a ledger state as a token tree (for tests and for handing work to the
    original scripts): one file per (status, year, id), empty unless ``body`` is set.
    Executors write the files; a retried task rewrites the same paths."""
    folder = F.col("status")
    for s, f in STATUS_FOLDERS.items():
        folder = F.when(F.col("status") == s, F.lit(f)).otherwise(folder)
    rel = F.concat_ws("/", folder, F.col("year").cast("string"), F.concat(F.col("ack_id"), F.lit(".txt")))
    cols = [rel.alias("rel"), (F.coalesce(F.col(body), F.lit("")) if body else F.lit("")).alias("body")]
    base_root = root

    def write(batches):
        filesystem, base = _fs(base_root)
        for pdf in batches:
            for rel_path, text in zip(pdf["rel"], pdf["body"]):
                full = f"{base.rstrip('/')}/{rel_path}"
                filesystem.create_dir(full.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(full) as fh:
                    fh.write(text.encode("utf-8"))
            yield pd.DataFrame({"n": [len(pdf)]})

    return current.select(*cols).mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0
