"""Page selection and document routing.

Data layout. A *page set* is one row per document and extractor with ``pages array<string>``
(index = 0-based page number, a null element = a page the extractor could not read) and an
optional document-level ``error``. Every per-document step - hit test, first hit, page count,
window, text join - is then a higher-order expression on the row: no shuffle, no Python.

The *wide* layout keeps several extractors of one document side by side (``pages_1``,
``pages_2`` ...); the extractor cascade (A7) and the text choice (A10) are narrow on it.
``to_wide`` turns a long page-set table into it with one aggregation by document.
The *row* layout ``(doc_id, [extractor,] page_no, text)`` is supported for tables that arrive
one page per row (``explode_pages`` / ``collect_pages``, ``first_hit_page_rows``,
``page_window_rows``, ``join_page_texts_rows``, ``terms_table_join``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions import text as tx
from docflow.operators import term_index


def _c(col):
    return F.col(col) if isinstance(col, str) else col


let = tx.let


# ---- building page arrays -------------------------------------------------------------------
def pages_from_lines(text: Column | str, lines_per_page: int = 3) -> Column:
    """Cut a text into pages of ``lines_per_page`` lines (the page model of the test tables).
    One regex pass: each match is up to ``lines_per_page`` lines, led by the newline that ends
    the previous page (equal to splitting on newlines and re-joining groups of lines, at half
    the cost). A null text has no pages."""
    if lines_per_page == 1:  # the regex's first match may be empty there; a split is exact
        pages = F.split(_c(text), "\n")
    else:
        pat = r"(?:^|\n)((?:[^\n]*+\n){0,%d}[^\n]*+)" % (lines_per_page - 1)
        pages = F.regexp_extract_all(_c(text), F.lit(pat), 1)
    return F.when(_c(text).isNull(), F.array().cast("array<string>")).otherwise(pages)


def pages_from_form_feeds(text: Column | str) -> Column:
    """Form-feed paged text (one form feed after every page, as text-layer tools write it)."""
    parts = F.split(_c(text), "\f")
    # the piece after the final form feed is not a page
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def explode_pages(df: DataFrame, pages: str = "pages") -> DataFrame:
    """Array layout -> row layout (doc columns kept, ``page_no`` 0-based, ``text``).

    ``posexplode_outer`` and a filter on the generated position: for a plain ``posexplode`` of a
    column the optimizer infers ``size(pages) > 0`` and pushes it below the projection that
    computes the pages, which would build every page array three times."""
    keep = [c for c in df.columns if c != pages]
    out = df.select(*keep, F.posexplode_outer(pages).alias("page_no", "text"))
    return out.where(F.col("page_no").isNotNull())


def collect_pages(rows: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Row layout -> array layout. One group per document (bounded by the document's pages);
    missing page numbers become null elements."""
    g = rows.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("page_no"), F.col("text")))).alias("_m"),
        F.max("page_no").alias("_n"),
    )
    return g.select(
        *keys,
        F.transform(F.sequence(F.lit(0), F.col("_n")), lambda i: F.element_at(F.col("_m"), i)).alias("pages"),
    )


# ---- P15 / A6 / A8 / J5 / A9 on arrays ------------------------------------------------------
def page_hits(pages: Column | str, terms: Iterable[str]) -> Column:
    """P15 per page; a null page never hits."""
    lowered = F.transform(_c(pages), lambda p: F.lower(p))
    return tx.find_terms_in(lowered, terms)


def first_hit_page(pages: Column | str, terms: Iterable[str]) -> Column:
    """Lowest 0-based page with a hit, -1 when none (also for a missing page array)."""
    return F.coalesce(F.array_position(page_hits(pages, terms), F.lit(True)) - 1, F.lit(-1)).cast("int")


def first_null_page(pages: Column | str) -> Column:
    """0-based index of the first page the extractor could not read, -1 when none."""
    pos = F.array_position(F.transform(_c(pages), lambda p: p.isNull()), F.lit(True)) - 1
    return F.coalesce(pos, F.lit(-1)).cast("int")


def page_count(pages: Column | str) -> Column:
    """Pages per document (0 for a missing page array; ``size(null)`` is -1 when a session
    runs with ANSI off, so the null case is explicit)."""
    p = _c(pages)
    return F.when(p.isNull(), F.lit(0)).otherwise(F.size(p))


def page_window(pages: Column | str, start: Column | str, n: int = C.NUMBER_PAGES_TO_SAVE) -> Column:
    """Pages start .. min(start+n-1, last); empty when start < 0."""
    s = _c(start)
    return F.when(s >= 0, F.slice(_c(pages), s + 1, n)).otherwise(F.array().cast("array<string>"))


def join_pages(window: Column | str, sep: str = "\n") -> Column:
    """Page texts in page order joined by ``sep`` (unreadable pages contribute nothing)."""
    return F.array_join(_c(window), sep)


# ---- P16 / P17 / P18 / P22 ------------------------------------------------------------------
def is_corrupted(pages: Column | str, error: Column | str | None = None) -> Column:
    """Document could not be opened, or has no page at all."""
    flag = page_count(pages) == 0
    if error is not None:
        flag = flag | _c(error).isNotNull()
    return flag


def is_too_long(pages: Column | str, limit_pages: int = C.PAGE_LIMIT) -> Column:
    """Strictly more than ``limit_pages`` pages."""
    return page_count(pages) > limit_pages


def classify_outcome(corrupted: Column, too_long: Column, reader_failed: Column, start: Column, text: Column) -> Column:
    """First matching class wins."""
    return (
        F.when(corrupted, F.lit(C.CORRUPTED_FILE))
        .when(too_long, F.lit(C.FILE_TOO_LONG))
        .when(reader_failed, F.lit(C.PDF_READER_FAILED))
        .when(start < 0, F.lit(C.PLAN_NOT_FOUND))
        .when(~tx.has_text(text), F.lit(C.TEXT_EXTRACTION_EMPTY))
        .otherwise(F.lit(C.PROCESSED))
    )


def route_documents(
    pagesets: DataFrame,
    terms: Iterable[str] = C.TERMS,
    n: int = C.NUMBER_PAGES_TO_SAVE,
    limit_pages: int = C.PAGE_LIMIT,
    pages: str = "pages",
    error: str | None = None,
    sep: str = "\n",
    nfkc: bool = True,
) -> DataFrame:
    """Single-extractor processing of every document: validate, find the first hit page, keep the
    window, extract and normalise its text, and route the document. Narrow: two projections.

    Adds ``n_pages``, ``page_no`` (first hit, -1 none), ``status`` and ``text`` (null unless a
    window was selected)."""
    terms = list(terms)
    err = F.col(error) if error else F.lit(None).cast("string")

    def per_doc(p):
        def with_hit(h):
            def with_bad(b):
                # the reader raises on an unreadable page it meets before the first hit
                failed = F.coalesce((b >= 0) & ((h < 0) | (b < h)), F.lit(False))
                corrupted = is_corrupted(p, err)
                too_long = is_too_long(p, limit_pages)
                selected = (~corrupted) & (~too_long) & (~failed) & (h >= 0)
                return F.struct(
                    page_count(p).alias("n_pages"), h.alias("page_no"), corrupted.alias("corrupted"),
                    too_long.alias("too_long"), failed.alias("failed"),
                    F.when(selected, join_pages(page_window(p, h, n), sep)).alias("raw"),
                )
            return let(first_null_page(p), with_bad)
        return let(first_hit_page(p, terms), with_hit)

    staged = pagesets.withColumn("_r", let(F.col(pages), per_doc))
    r = lambda f: F.col(f"_r.{f}")
    norm = tx.normalize_text(r("raw")) if nfkc else tx.normalize_text_native(r("raw"))
    out = staged.select("*", r("n_pages").alias("n_pages"), r("page_no").alias("page_no"), norm.alias("text"))
    out = out.withColumn(
        "status", classify_outcome(r("corrupted"), r("too_long"), r("failed"), F.col("page_no"), F.col("text"))
    )
    return out.drop("_r")


# ---- A7 / A10: extractor cascade on the wide layout -----------------------------------------
def cascade_columns(
    page_cols: Sequence[str], terms: Iterable[str], tolerant: Iterable[str] = ()
) -> tuple[Column, Column, Column]:
    """A7 on one row holding each extractor's pages (in priority order).

    Extractor k raises (-> pdf_reader_failed) when it meets an unreadable page before its first
    hit, unless it is *tolerant* (skips such pages as no-match). The first extractor that raises
    or hits decides. Returns (extractor 1-based or null, page or -1, reader_failed).
    Prefer ``with_cascade``, which evaluates each extractor's scan once."""
    terms = list(terms)
    hits = [first_hit_page(c, terms) for c in page_cols]
    bads = [None if c in set(tolerant) else first_null_page(c) for c in page_cols]
    return _cascade(hits, bads)


def _cascade(hits, bads):
    winner = F.lit(None).cast("int")
    page = F.lit(-1)
    failed = F.lit(False)
    # build the CASE from the last extractor backwards so the first decisive one is outermost
    for k in range(len(hits), 0, -1):
        hit, bad = hits[k - 1], bads[k - 1]
        raises = F.lit(False) if bad is None else (bad >= 0) & ((hit < 0) | (bad < hit))
        winner = F.when(raises, F.lit(None).cast("int")).when(hit >= 0, F.lit(k)).otherwise(winner)
        page = F.when(raises, F.lit(-1)).when(hit >= 0, hit).otherwise(page)
        failed = F.when(raises, F.lit(True)).when(hit >= 0, F.lit(False)).otherwise(failed)
    return winner, page, failed


def with_cascade(df: DataFrame, page_cols: Sequence[str], terms: Iterable[str], tolerant: Iterable[str] = ()) -> DataFrame:
    """Adds ``extractor``, ``page_no`` and ``_failed``.

    Lazy like the original cascade: extractor k+1's pages are scanned only when extractor k
    decided nothing (CASE evaluates only the branch taken; each extractor's first hit and first
    unreadable page are bound once with ``let``)."""
    terms = list(terms)
    tolerant = set(tolerant)
    none = F.struct(F.lit(None).cast("int").alias("extractor"), F.lit(-1).alias("page_no"), F.lit(False).alias("failed"))

    def stage(k: int) -> Column:
        if k == len(page_cols):
            return none
        col = page_cols[k]
        probe = F.struct(first_hit_page(col, terms).alias("h"),
                         (F.lit(-1) if col in tolerant else first_null_page(col)).alias("b"))

        def decide(s):
            h, b = s["h"], s["b"]
            raises = (b >= 0) & ((h < 0) | (b < h))
            return (
                F.when(raises, F.struct(F.lit(None).cast("int").alias("extractor"), F.lit(-1).alias("page_no"),
                                        F.lit(True).alias("failed")))
                .when(h >= 0, F.struct(F.lit(k + 1).alias("extractor"), h.alias("page_no"), F.lit(False).alias("failed")))
                .otherwise(stage(k + 1))
            )

        return let(probe, decide)

    staged = df.withColumn("_c", stage(0))
    return staged.select("*", F.col("_c.extractor").alias("extractor"), F.col("_c.page_no").alias("page_no"),
                         F.col("_c.failed").alias("_failed")).drop("_c")


def text_or_ocr(text_pages: Column | str, ocr_pages: Column | str, start: Column | str,
                n: int = C.NUMBER_PAGES_TO_SAVE, text_sep: str = "\f", ocr_sep: str = "\n") -> Column:
    """A10: the text-layer text of the window if it contains "the", else the OCR text of the same
    window - whichever extractor found the page."""
    t1 = join_pages(page_window(text_pages, start, n), text_sep)
    t3 = join_pages(page_window(ocr_pages, start, n), ocr_sep)
    return let(t1, lambda a: F.when(tx.has_text(a), a).otherwise(t3))  # the window joined once


def route_cascade(
    wide: DataFrame,
    page_cols: Sequence[str] = ("pages_1", "pages_2", "pages_3"),
    text_col: str = "pages_1",
    ocr_col: str = "pages_3",
    tolerant: Iterable[str] = ("pages_2",),
    terms: Iterable[str] = C.TERMS,
    n: int = C.NUMBER_PAGES_TO_SAVE,
    limit_pages: int = C.PAGE_LIMIT,
    error: str | None = None,
    text_sep: str = "\f",
    ocr_sep: str = "\n",
    nfkc: bool = True,
) -> DataFrame:
    """Full processing rule with the extractor cascade (narrow on the wide layout).

    Validation (corrupted / too long) uses the first extractor's pages. Adds ``extractor``,
    ``page_no``, ``n_pages``, ``text`` and ``status``."""
    first = page_cols[0]
    err = F.col(error) if error else None
    corrupted = is_corrupted(first, err)
    too_long = is_too_long(first, limit_pages)
    out = with_cascade(wide, list(page_cols), terms, tolerant).withColumn("n_pages", page_count(first))
    selected = (~corrupted) & (~too_long) & (~F.col("_failed")) & (F.col("page_no") >= 0)
    # the chosen window text is a column of its own: the normalisation refers to its input several
    # times, and a column referenced more than once is not inlined again by the optimizer
    out = out.withColumn("_raw", F.when(selected, text_or_ocr(text_col, ocr_col, "page_no", n, text_sep, ocr_sep)))
    raw = F.col("_raw")
    out = out.withColumn("text", tx.normalize_text(raw) if nfkc else tx.normalize_text_native(raw))
    out = out.withColumn(
        "status", classify_outcome(corrupted, too_long, F.col("_failed"), F.col("page_no"), F.col("text"))
    )
    return out.drop("_failed", "_raw")


def to_wide(long: DataFrame, extractors: Sequence[int] = (1, 2, 3), key: str = "doc_id") -> DataFrame:
    """Long page sets ``(doc_id, extractor, pages[, error])`` -> one row per document with
    ``pages_<k>`` columns and the first extractor's ``error``. One aggregation by document
    (each group holds one row per extractor)."""
    def only(k):  # max_by ignores rows whose ordering value is null
        return F.when(F.col("extractor") == k, F.col("extractor"))

    aggs = [F.max_by(F.col("pages"), only(k)).alias(f"pages_{k}") for k in extractors]
    if "error" in long.columns:
        aggs.append(F.max_by(F.col("error"), only(extractors[0])).alias("error"))
    return long.groupBy(key).agg(*aggs)


# ---- row-layout forms -----------------------------------------------------------------------
def first_hit_page_rows(rows: DataFrame, terms: Iterable[str], keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A6 on a row table: ``coalesce(min(page_no) FILTER (WHERE hit), -1)`` per document.
    Partial aggregation keeps the shuffle at one small row per document and map task."""
    hit = F.coalesce(tx.find_terms(F.col("text"), list(terms)), F.lit(False))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(hit, F.col("page_no"))), F.lit(-1)).alias("page_no"),
        F.count(F.lit(1)).alias("n_pages"),
    )


def page_window_rows(rows: DataFrame, starts: DataFrame, n: int = C.NUMBER_PAGES_TO_SAVE,
                     keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """J5 on a row table: equi-join on the document, range condition on the page number."""
    s = starts.select(*keys, F.col("page_no").alias("_start")).where(F.col("_start") >= 0)
    return rows.join(s, list(keys)).where(
        F.col("page_no").between(F.col("_start"), F.col("_start") + (n - 1))
    ).drop("_start")


def join_page_texts_rows(rows: DataFrame, sep: str = "\n", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A9 on a row table: ``listagg(text, sep) WITHIN GROUP (ORDER BY page_no)``."""
    sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'")
    return rows.groupBy(*keys).agg(
        F.expr(f"listagg(text, '{sep_sql}') WITHIN GROUP (ORDER BY page_no)").alias("text")
    )


def terms_table(spark, terms: Iterable[str]) -> DataFrame:
    """The term list as a (tiny, constant-size) table of lower-cased and folded terms."""
    rows = [(t, t.lower(), tx.alnum_fold_py(t.lower())) for t in dict.fromkeys(terms)]
    return spark.createDataFrame(rows, "term string, term_lower string, term_folded string")


# Up to this many terms the predicate holds them; it is one narrow pass, without an index.
MAX_INLINE_TERMS = 200


def terms_table_join(rows: DataFrame, terms: DataFrame, text: str = "text", max_inline: int = MAX_INLINE_TERMS) -> DataFrame:
    """Pages that contain any term when the terms are a table of any size (column ``term``).

    The size is checked first: up to ``max_inline`` terms are compiled into the predicate, a plain
    filter; more of them are joined by an inverted index of q-grams (``term_index``), which neither
    collects nor broadcasts the terms. A null term matches nothing."""
    head = terms.select("term").limit(max(0, max_inline + 1)).collect()  # reads at most this many
    if len(head) > max_inline:
        return term_index.pages_with_terms(rows, terms, text)
    lits = [r[0] for r in head if r[0] is not None]
    return rows.where(F.coalesce(tx.find_terms(F.col(text), lits), F.lit(False)))
