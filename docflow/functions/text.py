"""Column -> Column text functions.

All are built-in Spark expressions (JVM-side, whole-stage codegen) except ``nfkc``, which is
an Arrow-batched UDF because Spark has no Unicode normaliser.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.constants import HAS_TEXT_WORD, NA_TOKENS, PREVIEW_CHARS, WHITESPACE

ALNUM_DELETE = r"[^a-z0-9() ]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- F1 / F2 --------------------------------------------------------------------------------
def lower(col: Column | str) -> Column:
    """lower-case (Spark's lower agrees with Python's str.lower on the data we see)."""
    return F.lower(_c(col))


def alnum_fold(col: Column | str) -> Column:
    """delete every character outside ``[a-z0-9() ]`` (apply to lower-cased text)."""
    return F.regexp_replace(_c(col), ALNUM_DELETE, "")


def alnum_fold_py(s: str) -> str:
    """Driver-side twin of ``alnum_fold`` for literal terms."""
    return re.sub(ALNUM_DELETE, "", s)


# ---- F3-F8 ----------------------------------------------------------------------------------
NFKC_ROWS = 64  # texts that are Python strings at one time; the rest of a batch stays Arrow memory


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    done = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in texts.slice(at, NFKC_ROWS).to_pylist()],
                     texts.type) for at in range(0, len(texts), NFKC_ROWS)]
    return pa.concat_arrays(done) if done else texts


# NFKC is deterministic; the flag only stops the optimizer from invoking the UDF more often than
# written (filters on derived columns would otherwise be evaluated with their own copy of it).
_nfkc_udf = _nfkc.asNondeterministic()


# Characters NFKC can change: anything outside U+0000-U+009F and U+00C0-U+00FF. Those two
# ranges (ASCII, C1 controls, precomposed Latin-1 letters) are NFKC-stable and cannot combine
# with each other, so a string made only of them is its own NFKC form.
NFKC_UNSTABLE = r"[^\x{00}-\x{9F}\x{C0}-\x{FF}]"


def nfkc(col: Column | str) -> Column:
    """Unicode NFKC. The single Arrow UDF of the library (Arrow batches, a few texts as Python strings at a time).
    Strings that cannot change are answered in the JVM; only the others cross to Python (the
    rest are sent as nulls, which cost next to nothing in an Arrow batch)."""
    c = _c(col)
    # the UDF runs below the projection that uses its result, so the check is written once: a
    # string that can change comes back normalised (never null), every other one as null
    return F.coalesce(_nfkc_udf(F.when(c.rlike(NFKC_UNSTABLE), c)), c)


def drop_bad_utf8(col: Column | str) -> Column:
    """a Spark string from Python cannot carry lone surrogates; only a string cast from bytes
    can hold invalid UTF-8. Valid strings pass unchanged, invalid sequences are dropped."""
    c = _c(col)
    return F.when(F.is_valid_utf8(c) | c.isNull(), c).otherwise(
        F.regexp_replace(F.make_valid_utf8(c), "\ufffd", "")
    )


def unify_newlines(col: Column | str) -> Column:
    """CRLF and lone CR become LF."""
    return F.regexp_replace(_c(col), "\r\n?", "\n")


def strip_text(col: Column | str) -> Column:
    """Trim the 29 characters Python's str.strip() removes (plain trim only does space)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def normalize_text(col: Column | str) -> Column:
    """NFKC, drop bad UTF-8, unify newlines, strip. NFKC neither creates nor removes invalid
    sequences, so F3 and F4 commute; dropping bad bytes first lets the UDF's input be used once."""
    return strip_text(unify_newlines(nfkc(drop_bad_utf8(col))))


def normalize_text_native(col: Column | str) -> Column:
    """F7 without NFKC, for callers that know their text is already NFKC-stable."""
    return strip_text(unify_newlines(drop_bad_utf8(col)))


def repair_mojibake(col: Column | str) -> Column:
    """F8: encode as Latin-1 dropping code points above U+00FF, decode as UTF-8 dropping invalid
    bytes. Repairs double-encoded text and deletes legitimate non-Latin-1 characters. A double-encoded
    U+FFFD is kept: the text is cut at its three characters (their first byte starts a sequence
    wherever it stands) before U+FFFD marks invalid bytes."""
    latin1 = F.regexp_replace(_c(col), r"[^\x{00}-\x{FF}]", "")

    def repaired(part: Column) -> Column:
        as_utf8 = F.encode(part, "ISO-8859-1").cast("string")
        return F.replace(F.make_valid_utf8(as_utf8), F.lit("\ufffd"), F.lit(""))

    return F.array_join(F.transform(F.split(latin1, "\u00ef\u00bf\u00bd"), repaired), "\ufffd")


# ---- P5 / P6 / S3 ---------------------------------------------------------------------------
def trim_all_strings(df, columns: Iterable[str] | None = None):
    """P5: trim every string column with the Python whitespace set; other types untouched."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    wanted = set(columns) if columns is not None else string_cols

    def q(c):  # header names may hold dots ("note.1"): quote, not struct access
        return F.col("`" + c.replace("`", "``") + "`")

    return df.select(*[strip_text(q(c)).alias(c) if c in wanted and c in string_cols else q(c) for c in df.columns])


def strip_quotes(col: Column | str) -> Column:
    """Remove leading and trailing double quotes."""
    return F.btrim(_c(col), F.lit('"'))


def null_tokens(col: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """S3: exact-match NA tokens become null (applied before trimming)."""
    c = _c(col)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


# ---- P15 / P18 / P21 ------------------------------------------------------------------------
def fold_terms(terms: Iterable[str]) -> tuple[list[str], list[str]]:
    """Compile a term list once on the driver.

    Returns (direct, folded): lower-cased terms for the first check and their ``alnum_fold``
    for the second. Duplicates and terms that contain another term of the same list are
    removed: ``any(t in s)`` is unchanged by this, and the predicate gets shorter.
    """

    def minimal(items: list[str]) -> list[str]:
        uniq = sorted(set(items), key=lambda t: (len(t), t))
        keep: list[str] = []
        for t in uniq:
            if not any(k in t for k in keep):
                keep.append(t)
        return keep

    lowered = [t.lower() for t in terms]
    return minimal(lowered), minimal([alnum_fold_py(t) for t in lowered])


def folded_pattern(folded: Iterable[str]) -> str:
    """Regex for the second check without building the folded text: ``fold(page)`` contains
    ``f`` exactly when ``page`` contains f's characters in order with only deletable characters
    (``[^a-z0-9() ]``) between them. Deleting characters keeps the rest of a match contiguous,
    so the two are equivalent; the regex needs no per-page string copy.

    Gaps are possessive (``*+``): the character after a gap is never a gap character, so giving
    characters back cannot help and backtracking is skipped. A lookahead on the terms' first
    characters rejects most start positions with one class test (together about 1.5x faster)."""
    folded = [f for f in folded if f]
    if not folded:
        return ""

    def lit(ch):
        return re.escape(ch) if ch in "()" else ch

    gap = "[^a-z0-9() ]*+"
    firsts = "".join(sorted({lit(f[0]) for f in folded}))
    return f"(?=[{firsts}])(?:" + "|".join(gap.join(lit(ch) for ch in f) for f in folded) + ")"


# Up to so many terms are tested one after another in generated code, more in a loop over a literal
# array; both give the same answer.
MAX_CHAINED_TERMS = 32


def find_terms_lowered(lowered: Column, terms: Iterable[str]) -> Column:
    """P15 on text that is already lower-cased."""
    direct, folded = fold_terms(terms)
    if not direct:
        return F.lit(False)
    if len(direct) > MAX_CHAINED_TERMS:  # a chain of thousands would be too deep a tree to analyse
        first = F.exists(F.array(*[F.lit(t) for t in direct]), lambda t: lowered.contains(t))
    else:
        first = F.lit(False)
        for t in direct:
            first = first | lowered.contains(t)
    if any(f == "" for f in folded):
        return first | F.lit(True)
    # Or short-circuits in generated code: the regex runs only for pages the first check missed
    return first | lowered.rlike(folded_pattern(folded))


def find_terms_in(lowered_pages: Column, terms: Iterable[str]) -> Column:
    """P15 per element of an array of lower-cased pages (lambda variables bind the lowered page
    once; there is no common-subexpression elimination inside lambdas)."""
    terms = list(terms)
    return F.transform(lowered_pages, lambda lp: F.coalesce(find_terms_lowered(lp, terms), F.lit(False)))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and bind it to ``body``'s lambda variable. Spark SQL has no LET;
    a one-element ``transform`` is the idiom. Without it, a value used several times is copied
    into every use (filters get no common-subexpression elimination, and a filter pushed
    through a projection receives a copy of the projection's expressions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find_terms(col: Column | str, terms: Iterable[str]) -> Column:
    """Any term in lower(text), or any folded term in the folded text (newlines deleted)."""
    terms = list(terms)
    return let(F.lower(_c(col)), lambda lp: find_terms_lowered(lp, terms))


def has_text(col: Column | str, word: str = HAS_TEXT_WORD) -> Column:
    """The extraction counts as non-empty when it contains "the" in any case."""
    return F.coalesce(F.lower(_c(col)).contains(word), F.lit(False))


def preview_text(col: Column | str, n: int = PREVIEW_CHARS) -> Column:
    """First n characters."""
    return F.substring(_c(col), 1, n)


# ---- F10 ------------------------------------------------------------------------------------
def backoff_seconds(attempt: Column | str, backoff: float = 2.0) -> Column:
    """backoff * 2^(attempt-1)."""
    return F.lit(backoff) * F.pow(F.lit(2.0), _c(attempt) - 1)
