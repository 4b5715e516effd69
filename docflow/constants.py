"""Fixed values of the pipeline.

Everything in this module must equal the values the original pipeline uses, so the lists are
stated plainly and in their natural order. Operators take them as default arguments only;
every function accepts its own list.
"""

# --- fixed values: search terms for the plan description page, in configured order ---------
TERMS = [
    "Description of Plan",
    "Description Of Plan",
    "DESCRIPTION OF PLAN",
    "Description of the Plan",
    "Description Of The Plan",
    "DESCRIPTION OF THE PLAN",
    "Description of Plans",
    "Description of the Plans",
    "Plan Description",
    "PLAN DESCRIPTION",
    "SUMMARY OF SIGNIFICANT ACCOUNTING POLICIES",
    "DESCRIPTION OF THE 401(k) PENSION PLAN",
]

# --- fixed values: status names -------------------------------------------------------------
TO_DOWNLOAD = "to_download"
CLAIMED = "claimed"
TO_PROCESS = "to_process"
PROCESSED = "processed"
DOWNLOAD_FAILED = "download_failed"
PLAN_NOT_FOUND = "plan_not_found"
CORRUPTED_FILE = "corrupted_file"
FILE_TOO_LONG = "file_too_long"
TEXT_EXTRACTION_EMPTY = "text_extraction_empty"
PDF_READER_FAILED = "pdf_reader_failed"

STATUSES = [
    TO_DOWNLOAD,
    CLAIMED,
    TO_PROCESS,
    PROCESSED,
    DOWNLOAD_FAILED,
    PLAN_NOT_FOUND,
    CORRUPTED_FILE,
    FILE_TOO_LONG,
    TEXT_EXTRACTION_EMPTY,
    PDF_READER_FAILED,
]
QUEUE_STATUSES = [TO_DOWNLOAD, TO_PROCESS]
ERROR_STATUSES = [
    DOWNLOAD_FAILED,
    PLAN_NOT_FOUND,
    CORRUPTED_FILE,
    FILE_TOO_LONG,
    TEXT_EXTRACTION_EMPTY,
    PDF_READER_FAILED,
]
TERMINAL_STATUSES = [PROCESSED] + ERROR_STATUSES

# --- fixed values: sizes and limits ---------------------------------------------------------
YEARS = list(range(1999, 2025))
NUMBER_PAGES_TO_SAVE = 4
PAGE_LIMIT = 100
DOWNLOAD_BATCH_SIZE = 500
PROCESS_BATCH_SIZE = 20
DOWNLOAD_AND_PROCESS_BATCH_SIZE = 20
MAX_RETRIES = 5
BACKOFF_SECONDS = 2.0
PREVIEW_CHARS = 500
SAMPLE_K = 5
PREVIEW_TOKENS = 10
SHUFFLE_SEED = 42
INDEX_PREAMBLE_LINES = 3
CODE_PATTERN = "2J|2L"
HAS_TEXT_WORD = "the"
OCR_TEXT_COL = "ocr_text"

# --- fixed values: cell tokens a CSV reader in the original pipeline turns into null --------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: characters Python's str.strip() removes (Unicode White_Space + 1C-1F) ----
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f"
    "\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
