"""How the driver's tables stand in for the pipeline's inputs.

The pipeline's real inputs (yearly index files, id lists, document files, a status ledger,
fetch attempts) are not among the test tables, so each is *derived by Spark* from a table
so that its size grows with the data. Every binding here is a plain DataFrame expression;
the SQL twins used by the correctness check live in ``plans/registry.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.pages import pages_from_lines

# terms that occur in the test prose (the configured terms never do: no document says "plan")
FIXTURE_TERMS = ["that the", "nicht", "the of"]
# the test documents have at most ~34 pages; 20 keeps the too-long class non-empty
FIXTURE_PAGE_LIMIT = 20
LINES_PER_PAGE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def filing_year(source: str = "source"):
    """src0..src19 -> 1999..2018."""
    return (F.lit(1999) + F.substring(F.col(source), 4, 10).cast("int")).cast("int")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index row per document: ack_id, filing_year, sponsor_name, link, facsimile_link."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(
        k.cast("string").alias("ack_id"),
        filing_year().alias("filing_year"),
        F.col("lang").alias("sponsor_name"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("https://a/"), k.cast("string")))
        .alias("link"),
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://b/"), k.cast("string")))
        .alias("facsimile_link"),
    )


def index_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with a second row for some documents: equal to the first, or of another sponsor."""
    once = index(spark, sf_dir)
    k = F.col("ack_id").cast("long") % 7
    again = once.where(k.isin(3, 4)).withColumn(
        "sponsor_name", F.when(k == 3, F.concat("sponsor_name", F.lit("?"))).otherwise(F.col("sponsor_name")))
    return once.unionByName(again)


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acceptable-id list without a code column (labels)."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("ack_id"))


def train_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training list: labels with quality = 1."""
    return (
        table(spark, sf_dir, "labels")
        .where(F.col("quality") == 1)
        .select(F.col("doc_id").cast("string").alias("ack_id"))
    )


CODE_FIXTURE_PATTERN = "ECO|PRO"


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id list with a code column (part: p_partkey as id, p_type as code)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("ack_id"), F.col("p_type").alias("pension_benefit_code")
    )


def pagesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, year, pages (3 lines per page, 0-based)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", filing_year().alias("year"), pages_from_lines("text", LINES_PER_PAGE).alias("pages"))


def page_texts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three extractor views per document; 1 and 2 are blank for some documents, as for scans."""
    base = pagesets(spark, sf_dir)
    blank1 = F.col("doc_id") % 3 == 0
    blank2 = F.col("doc_id") % 6 == 0
    return base.select(
        "doc_id",
        "year",
        F.when(blank1, F.transform("pages", lambda p: F.lit(""))).otherwise(F.col("pages")).alias("pages_1"),
        F.when(blank2, F.transform("pages", lambda p: F.lit(""))).otherwise(F.col("pages")).alias("pages_2"),
        F.col("pages").alias("pages_3"),
    )


def page_texts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three views in the long layout (doc_id, extractor, pages)."""
    w = page_texts_wide(spark, sf_dir)
    return w.select(
        "doc_id",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("extractor"), F.col("pages_1").alias("pages")),
                F.struct(F.lit(2).alias("extractor"), F.col("pages_2").alias("pages")),
                F.struct(F.lit(3).alias("extractor"), F.col("pages_3").alias("pages")),
            )
        ),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status transitions: (ack_id, year, status, ts, seq, message, overwrite_)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("ack_id"),
        (F.lit(1999) + (F.col("user_id") % 20).cast("int")).cast("int").alias("year"),
        ledger_status().alias("status"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("props").alias("message"),
        (F.col("event_type") == "purchase").alias("overwrite_"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts: (doc, event_id, status_code)."""
    return attempt_log(spark, sf_dir).select("doc", "event_id", "status_code")


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts with their messages, also cut into short logs: (doc, lot, event_id, status_code, said)."""
    e = table(spark, sf_dir, "events")
    code = (
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, 404).otherwise(503))
        .when(F.col("event_type") == "purchase", 200)
        .otherwise(503)
    )
    return e.select(F.col("user_id").alias("doc"), (F.col("event_id") % 40).cast("int").alias("lot"), "event_id",
                    code.cast("int").alias("status_code"), F.col("props").alias("said"))


def _status_folder():
    s = ledger_status()
    group = F.when(s.isin("to_download", "to_process"), "queue/").when(
        s.isin("plan_not_found"), "error/").otherwise("")
    return F.concat(group, s)


def ledger_status():
    return (
        F.when(F.col("event_type") == "signup", "to_download")
        .when(F.col("event_type") == "view", "claimed")
        .when(F.col("event_type") == "click", "to_process")
        .when(F.col("event_type") == "purchase", "processed")
        .otherwise("plan_not_found")
    )


def token_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token paths as a tracker tree would hold them, one per event: status folders (nested
    under queue/ and error/), a year folder (an invalid one for some), the id as file name
    (some still carrying a '.claiming.' marker), and Windows separators for some."""
    e = table(spark, sf_dir, "events")
    year_dir = F.when(F.col("event_id") % 17 == 0, F.lit("abcd")).otherwise(
        (F.lit(1999) + F.col("user_id") % 20).cast("string"))
    fname = F.when(
        F.col("event_id") % 11 == 0,
        F.concat(F.col("user_id").cast("string"), F.lit(".txt.claiming."), F.col("event_id").cast("string")),
    ).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".txt")))
    p = F.concat_ws("/", F.lit("/srv/tracker"), _status_folder(), year_dir, fname)
    p = F.when(F.col("event_id") % 13 == 0, F.replace(p, F.lit("/"), F.lit("\\"))).otherwise(p)
    return e.select("event_id", p.alias("path"))
