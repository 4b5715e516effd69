"""Document files (S6) and page extraction.

Tasks list the folders and read the files (one row per file: path, length, content), so that the driver
holds no listing. Two layouts are understood: the original ``<root>/<year>/<ack_id>.<ext>`` and the Hive layout
``<root>/year=<y>/ack_id=<id>/<file>`` that Spark's partitioned writer produces.

Extraction is pluggable. The built-in text-layer format - UTF-8 text with a form feed after
every page, as text-layer tools write it - is decoded natively in the JVM. Any other codec (a
PDF text layer, OCR) is a Python callable ``bytes -> list[str | None]`` run by ``mapInPandas``
on Arrow batches; it may raise for a document it cannot open (-> ``error``) and return None for
a page it cannot read. The PDF/OCR codecs themselves are not part of this library.
"""

from __future__ import annotations

import os
import re
import traceback
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.pages import first_hit_page, first_null_page, pages_from_form_feeds
from docflow.session import cores, scratch_path
from docflow.sources.fs import filesystem, read_bytes, uri_prefix

Extractor = Callable[[bytes], Sequence[str | None]]
PAGESET_SCHEMA = "ack_id string, extractor int, pages array<string>, error string"

# begins the error of a file that could not be read, as opposed to one that could not be decoded
UNREAD = "unread: "


# Starting a task (four Python workers, generated code) costs more than reading a small file, so a task
# reads this many. Rows stream through a task: its memory does not depend on their number.
FILES_PER_TASK = 2048
MAX_TASKS = 50_000  # beyond that tasks read more files
LISTED_ROWS = 10_000  # rows of a listing that a task hands over at once
READ_BYTES = 16 << 20  # file bytes that a task holds before it hands them over, one file at least
LISTING = "path string, length long, modified long"


def _listable(spark: SparkSession, root: str | list[str], glob: str) -> tuple[str, str] | None:
    """The full URI of ``root`` and the pattern of file names, if tasks can list it: one folder, without
    wildcards, on a file system that ``sources.fs`` knows."""
    if not isinstance(root, str) or re.search(r"[{}\[\]*?\\]", root):
        return None
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs
        at = hadoop.Path(root)
        fs_ = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs_.getFileStatus(at).isDirectory():
            return None
        full = fs_.makeQualified(at).toString()
        filesystem(full)
        return full, hadoop.GlobPattern(glob).compiled().pattern()
    except Exception:  # noqa: BLE001 - no such folder or file system (Spark's reader says so), or Spark Connect
        return None


def _hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(fs_, folder: str):
    """(name, is a folder, length, modified in microseconds) of what stands in ``folder``; in a local one
    entries come one by one, however many there are. A folder that is gone is empty."""
    from pyarrow import fs as pafs

    if isinstance(fs_, pafs.LocalFileSystem):
        try:
            with os.scandir(folder) as found:
                for e in found:
                    if e.is_dir():
                        yield e.name, True, 0, 0
                    elif e.is_file():
                        st = e.stat()
                        yield e.name, False, st.st_size, st.st_mtime_ns // 1000
        except FileNotFoundError:
            return
    else:
        for e in fs_.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if e.type == pafs.FileType.Directory:
                yield e.base_name, True, 0, 0
            elif e.type == pafs.FileType.File:
                yield e.base_name, False, e.size or 0, (e.mtime_ns or 0) // 1000


def list_files(spark: SparkSession, root: str | list[str], glob: str = "*") -> DataFrame:
    """(path, length, modified) of the files under ``root`` that Spark's file sources would read: names that
    match ``glob``, no hidden and no empty ones. Tasks list the folders, level by level, and write what they
    find to the shared folder; the driver holds neither files nor folders, whatever their number, and
    the listing stays the same however often it is read. Lists of paths, wildcards and file systems that only
    Spark's readers open are listed by Spark, which takes memory of the driver for each file."""
    found = _listable(spark, root, glob)
    if found is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        return reader.load(root).select("path", "length", F.unix_micros("modificationTime").alias("modified"))
    full, pattern = found
    prefix = "file:" if full.startswith("file:") else uri_prefix(full)
    where = scratch_path(spark, "listing")

    def run(batches):
        wanted = re.compile(pattern, re.DOTALL)
        fs_, _ = filesystem(full)
        for pdf in batches:
            rows = []
            for folder in pdf["path"]:
                base = filesystem(folder)[1].rstrip("/")
                for name, is_folder, length, modified in _entries(fs_, base or "/"):
                    if not _hidden(name) and (is_folder or (length > 0 and wanted.fullmatch(name))):
                        rows.append((f"{prefix}{base}/{name}", length, modified, is_folder))
                    if len(rows) == LISTED_ROWS:
                        yield pd.DataFrame(rows, columns=["path", "length", "modified", "folder"])
                        rows = []
            yield pd.DataFrame(rows, columns=["path", "length", "modified", "folder"]).astype(
                {"path": "object", "length": "int64", "modified": "int64", "folder": "bool"})

    folders, n, level = spark.createDataFrame([(full,)], "path string"), 1, 0
    while n:
        tasks = min(n, 4 * cores(spark))
        listed = folders.repartition(tasks, F.xxhash64("path")) if level else folders.coalesce(1)
        listed.mapInPandas(run, f"{LISTING}, folder boolean").write.partitionBy("folder").parquet(f"{where}/level={level}")
        at = spark.read.schema(f"{LISTING}, folder boolean, level int").parquet(where)
        folders = at.where(f"folder and level = {level}").select("path")
        n, level = folders.count(), level + 1
    return at.where("not folder").select("path", "length", "modified")


def scan_documents(spark: SparkSession, root: str | list[str], glob: str = "*", with_content: bool = True) -> DataFrame:
    """(ack_id, year, path, length[, content]) for every document file under ``root``. Without
    ``with_content`` only the listing is read. The listing is dealt out by path, ``FILES_PER_TASK`` files a task (four
    tasks a core at least), and each task reads its own files; a file that is gone or cannot be read fails the job."""
    files = list_files(spark, root, glob).select("path", "length")
    n = files.count()
    tasks = min(max(4 * cores(spark), min(MAX_TASKS, -(-n // FILES_PER_TASK))), max(n, 1))
    df = files.repartition(tasks, F.xxhash64("path")).select(*document_keys(), "path", "length")
    return read_content(df, errors=None) if with_content else df


def document_keys(path: str = "path") -> list[Column]:
    """``ack_id`` and ``year`` from the path of a document file, in either layout."""
    p = F.col(path)
    hive_id = F.regexp_extract(p, r"/ack_id=([^/]+)/[^/]*$", 1)
    hive_year = F.regexp_extract(p, r"/year=([^/]+)/", 1)
    name = F.regexp_extract(p, r"/([^/]+)$", 1)
    plain_id = F.regexp_replace(name, r"\.[^.]+$", "")
    plain_year = F.regexp_extract(p, r"/([^/]+)/[^/]+$", 1)
    ack_id = F.when(hive_id != "", hive_id).otherwise(plain_id)
    year = F.when(hive_id != "", hive_year).otherwise(plain_year).try_cast("int")
    return [ack_id.alias("ack_id"), year.alias("year")]


def missing_documents(expected: DataFrame, found: DataFrame, keys: Sequence[str] = ("ack_id", "year")) -> DataFrame:
    """Documents the ledger expects but no file holds (D11: a side output, not a crash)."""
    return expected.join(found.select(*keys), list(keys), "left_anti")


def form_feed_pages(content: bytes) -> list[str]:
    """Python twin of the native text-layer decoder (for use as a pluggable extractor)."""
    text = content.decode("utf-8")
    parts = text.split("\f")
    if parts and parts[-1] == "":
        parts = parts[:-1]
    return parts


def extract_pages_native(docs: DataFrame, extractor_id: int = 1, content: str = "content") -> DataFrame:
    """S7, built-in format, JVM only: invalid UTF-8 makes the document unreadable. Columns other
    than ``content`` pass through."""
    raw = F.col(content).cast("string")
    ok = F.is_valid_utf8(raw)
    return docs.select(
        *[c for c in docs.columns if c != content],
        F.lit(extractor_id).alias("extractor"),
        F.when(ok, pages_from_form_feeds(raw)).alias("pages"),
        F.when(~ok, F.lit("invalid UTF-8")).alias("error"),
    )


def read_content(docs: DataFrame, path: str = "path", errors: str | None = "read_error") -> DataFrame:
    """Adds ``content`` (the bytes of the file at ``path``) and the column ``errors`` (null, or why it could
    not be read); without such a column a file that cannot be read raises. Files are read in the tasks of
    ``docs``, so bytes are never shuffled, and handed over ``READ_BYTES`` at a time."""
    fields = [*docs.schema.fields, T.StructField("content", T.BinaryType())]
    if errors:
        fields.append(T.StructField(errors, T.StringType()))

    def run(batches):
        for pdf in batches:
            begin, held, blobs, why = 0, 0, [], []
            for i, p in enumerate(pdf[path], 1):
                try:
                    blobs.append(read_bytes(p))
                    why.append(None)
                    held += len(blobs[-1])
                except OSError as e:
                    if not errors:
                        raise
                    blobs.append(None)
                    why.append(f"{UNREAD}{e}")
                if held >= READ_BYTES or i == len(pdf):
                    more = {"content": blobs, **({errors: why} if errors else {})}
                    yield pdf.iloc[begin:i].assign(**more)
                    begin, held, blobs, why = i, 0, [], []

    return docs.mapInPandas(run, T.StructType(fields))


def _decode(extractor: Extractor, blob) -> tuple[list | None, str | None]:
    try:
        return list(extractor(bytes(blob))), None
    except Exception:  # noqa: BLE001 - the class of failure is data, not control flow
        return None, traceback.format_exc(limit=1)


def extract_pages(docs: DataFrame, extractor: Extractor, extractor_id: int = 1, content: str = "content") -> DataFrame:
    """S7, pluggable codec: ``mapInPandas`` over (ack_id, content) Arrow batches."""

    def run(batches):
        for pdf in batches:
            out = [_decode(extractor, blob) for blob in pdf[content]]
            yield pd.DataFrame({"ack_id": pdf["ack_id"], "extractor": extractor_id,
                                "pages": [o[0] for o in out], "error": [o[1] for o in out]})

    return docs.select("ack_id", content).mapInPandas(run, PAGESET_SCHEMA)


def codec_where(df: DataFrame, extractor: Extractor, pages_col: str, error_col: str, run: str,
                content: str = "content", path: str = "path") -> DataFrame:
    """Run ``extractor`` on the rows whose ``run`` column is true and add its pages and error
    (null elsewhere). Every other column passes through, so no join is needed afterwards.
    Without a ``content`` column the task reads each file it processes from ``path`` itself:
    bytes are never shuffled or carried between stages. The error of a file that cannot be read
    begins with ``UNREAD``: it says nothing about the document, which may be tried again."""
    by_path = content not in df.columns
    schema = T.StructType(list(df.schema.fields) + [T.StructField(pages_col, T.ArrayType(T.StringType())),
                                                     T.StructField(error_col, T.StringType())])

    def run_batches(batches):
        for pdf in batches:
            pages, errors = [], []
            blobs = pdf[path] if by_path else pdf[content]
            for go, blob in zip(pdf[run], blobs):
                if go and by_path:
                    try:
                        blob = read_bytes(blob)
                    except OSError as e:
                        pages.append(None)
                        errors.append(f"{UNREAD}{e}")
                        continue
                p, e = _decode(extractor, blob) if go else (None, None)
                pages.append(p)
                errors.append(e)
            yield pdf.assign(**{pages_col: pages, error_col: errors})

    return df.mapInPandas(run_batches, schema)


def run_cascade(docs: DataFrame, extractors: Sequence[tuple[int, Extractor | None, bool]], terms: Sequence[str],
                ocr_window: bool = True, n: int = 4, content: str = "content", keep_errors: bool = False) -> DataFrame:
    """S7 + A7 with the original's short-circuit, as one narrow chain (no join, no shuffle).

    ``docs`` carries either ``content`` (bytes travel along the row) or only ``path`` (each stage
    reads the files it processes; use this after a join, so that bytes are never shuffled).
    ``extractors``: (id, callable or None for the native decoder, tolerant) in cascade order,
    text layer first and OCR last. Extractor k runs only on rows that no earlier extractor
    decided (a hit, an open error, or an unreadable page before the hit); the decision is made
    in the JVM between the ``mapInPandas`` stages, and the binary content travels along the row
    instead of being joined back. With ``ocr_window`` the last (OCR) codec also runs where the
    cascade chose a page but the text layer's window lacks "the" (the text choice of A10 needs
    the OCR of that window). Returns the wide layout: ``pages_<id>``, ``error`` (the first
    extractor's) and the input columns without ``content``. With ``keep_errors`` also ``reader_error``
    (the first error of a later extractor that is not tolerant) and ``read_error`` (why the file itself
    could not be read by any of them)."""
    terms = list(terms)
    df = docs
    undecided = F.lit(True)
    tmp = []
    for k, fn, tolerant in extractors:
        pages_k, err_k = f"pages_{k}", f"_err_{k}"
        df = df.withColumn("_run", undecided)
        if fn is None and content not in df.columns:
            fn = form_feed_pages  # the built-in format, decoded in the task that reads the file
        if fn is None:
            raw = F.col(content).cast("string")
            ok = F.is_valid_utf8(raw)
            df = df.withColumn(pages_k, F.when(F.col("_run") & ok, pages_from_form_feeds(raw)))
            df = df.withColumn(err_k, F.when(F.col("_run") & ~ok, F.lit("invalid UTF-8")))
        else:
            df = codec_where(df, fn, pages_k, err_k, "_run", content)
        if k != extractors[0][0]:
            # a later codec that raises is an unreadable page before any hit: the cascade rule
            # then gives pdf_reader_failed, or no match for a tolerant reader
            df = df.withColumn(pages_k, F.when(F.col(err_k).isNotNull(), F.array(F.lit(None).cast("string")))
                               .otherwise(F.col(pages_k)))
        h, b = first_hit_page(pages_k, terms), first_null_page(pages_k)
        raises = F.lit(False) if tolerant else (b >= 0) & ((h < 0) | (b < h))
        decided = F.col(err_k).isNotNull() | F.coalesce((h >= 0) | raises, F.lit(False))
        df = df.withColumn(f"_dec_{k}", F.col("_run") & decided)
        undecided = F.col("_run") & ~F.col(f"_dec_{k}")
        tmp += [err_k, f"_dec_{k}"]
    first_id, last_id = extractors[0][0], extractors[-1][0]
    df = df.withColumn("error", F.col(f"_err_{first_id}"))
    if ocr_window and len(extractors) > 1:
        from docflow.functions.text import has_text
        from docflow.operators.pages import join_pages, page_window, with_cascade

        cols = [f"pages_{k}" for k, _, _ in extractors]
        tol = [f"pages_{k}" for k, _, t in extractors if t]
        chosen = with_cascade(df, cols, terms, tol)
        text_layer = join_pages(page_window(f"pages_{first_id}", "page_no", n), "\f")
        need = (F.col("page_no") >= 0) & F.col(f"pages_{last_id}").isNull() & ~has_text(text_layer)
        df = chosen.withColumn("_run", need).drop("extractor", "page_no", "_failed")
        ocr = [fn for k, fn, _ in extractors if k == last_id][0]
        if ocr is None and content not in df.columns:
            ocr = form_feed_pages
        df = codec_where(df, ocr, "_ocr_pages", "_ocr_err", "_run", content) if ocr is not None else df.withColumn(
            "_ocr_pages", F.when(F.col("_run"), pages_from_form_feeds(F.col(content).cast("string"))))
        df = df.withColumn(f"pages_{last_id}", F.coalesce(F.col(f"pages_{last_id}"), F.col("_ocr_pages")))
        tmp += ["_ocr_pages", "_ocr_err"]
    if keep_errors:
        errs = [c for c in tmp if c.startswith("_err_") or c == "_ocr_err"]
        strict = [f"_err_{k}" for k, _, tol in extractors[1:] if not tol]
        df = df.withColumn("reader_error", F.coalesce(*strict) if strict else F.lit(None).cast("string"))
        df = df.withColumn("read_error", F.coalesce(*[F.when(F.startswith(F.col(c), F.lit(UNREAD)), F.col(c)) for c in errs
                                                      if c in df.columns]))
    return df.drop("_run", *[c for c in [content, *tmp] if c in df.columns])


def write_document_files(pagesets: DataFrame, root: str, key: str = "ack_id", year: str = "year",
                         pages: str = "pages") -> str:
    """Materialise page sets as one text-layer file per document, ``root/<year>/<id>.txt`` (UTF-8,
    a form feed after each page; an unreadable page is written empty), the layout of a
    year-foldered archive; used to build test inputs from tables. The file body is built
    JVM-side and executors write the files themselves - no per-file output commit - so a retried
    task rewrites the same paths."""
    p = F.col(pages)
    body = F.when(F.size(p) > 0, F.concat(F.array_join(F.transform(p, lambda x: F.coalesce(x, F.lit(""))), "\f"),
                                          F.lit("\f"))).otherwise(F.lit(""))
    rel = F.concat_ws("/", F.col(year).cast("string"), F.concat(F.col(key).cast("string"), F.lit(".txt")))
    base_root = root

    def write(batches):
        fs_, base = filesystem(base_root)
        made = set()
        for pdf in batches:
            for rel_path, text in zip(pdf["rel"], pdf["body"]):
                full = f"{base.rstrip('/')}/{rel_path}"
                folder = full.rsplit("/", 1)[0]
                if folder not in made:
                    fs_.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs_.open_output_stream(full) as fh:
                    fh.write(text.encode("utf-8"))
            yield pd.DataFrame({"n": [len(pdf)]})

    pagesets.select(rel.alias("rel"), body.alias("body")).mapInPandas(write, "n long").agg(F.sum("n")).first()
    return root
