"""Golden cases for the scalar functions (FIXTURES section C)."""

from pyspark.sql import functions as F

from docflow.functions import text as tx
from docflow.operators import ledger as lg


def one(spark, col_fn, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_nfkc(spark):
    assert one(spark, tx.nfkc, ["ﬁ①", None]) == ["fi1", None]


def test_unify_newlines(spark):
    assert one(spark, tx.unify_newlines, ["a\r\nb\rc"]) == ["a\nb\nc"]


def test_repair_mojibake(spark):
    assert one(spark, tx.repair_mojibake, ["Ã©", "é", "a漢"]) == ["é", "", "a"]


def test_normalize_text(spark):
    assert one(spark, tx.normalize_text, [" x　"]) == ["x"]


def test_strip_quotes(spark):
    assert one(spark, tx.strip_quotes, ['"A" "', '""', '"']) == ['A" ', "", ""]


def test_null_tokens(spark):
    assert one(spark, tx.null_tokens, ["NA", "None", "", " null", '""', "x"]) == [None, None, None, " null", '""', "x"]


def test_find_terms(spark):
    terms = ["Description of Plan"]
    got = one(spark, lambda c: tx.find_terms(c, terms),
              ["DESCRIPTION,  OF PLAN", "descrip-tion of plan", "description\nof plan", "Description of Plans"])
    assert got == [False, True, False, True]
    assert one(spark, lambda c: tx.find_terms(c, ["401(K)"]), ["the 401(k) pension"]) == [True]


def test_fold_terms_configured():
    from docflow.constants import TERMS

    direct, folded = tx.fold_terms(TERMS)
    assert len(direct) == 5 and "description of plan" in direct and "description of plans" not in direct
    assert len(folded) == 5


def test_has_text(spark):
    assert one(spark, tx.has_text, ["The end", "nothing", None]) == [True, False, False]


def test_resolve_url(spark):
    df = spark.createDataFrame([("", "f"), ("  ", "f"), (None, "f"), ("u", "f"), (None, None)],
                               "link string, facsimile_link string")
    assert [r[0] for r in df.select(lg.resolve_url()).collect()] == ["f", "f", "f", "u", None]


def test_backoff(spark):
    df = spark.range(1, 5).select(tx.backoff_seconds(F.col("id")).alias("w"))
    assert [r.w for r in df.collect()] == [2.0, 4.0, 8.0, 16.0]


def test_drop_bad_utf8(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    broken = F.concat(F.encode("v", "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    assert df.select(tx.drop_bad_utf8(broken)).first()[0] == "abc"
