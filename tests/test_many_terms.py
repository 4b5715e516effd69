"""Term tables of many sizes (J7): one plan, equal to a scan of every term, with null, short and empty terms."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from docflow.operators import pages as pg
from docflow.operators import term_index

TERMS = "term string, term_lower string, term_folded string"


def fold(text):
    return re.sub("[^a-z0-9() ]", "", text.lower())


@pytest.mark.parametrize("n", [10, 3000, 200_000])
def test_terms_tables_of_many_sizes(spark, n):
    pages = spark.createDataFrame([(1, "x needle1q y"), (2, f"Needle{n - 1}Q"), (3, "need le2q-"), (4, "nothing"), (5, None), (6, "nee-dle\n2q")], "id int, text string")
    terms = spark.range(n).select(F.concat(F.lit("needle"), "id", F.lit("q")).alias("term"))
    terms = terms.union(spark.createDataFrame([(None,)], "term string"))
    for limit in (0, pg.MAX_INLINE_TERMS):
        assert sorted(r.id for r in pg.terms_table_join(pages, terms, max_inline=limit).collect()) == [1, 2, 6]


def test_matches_a_scan_of_every_term(spark):
    rnd = random.Random(5)
    letters = "abAB1 (-\né"
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(0, 60))) for _ in range(150)] + [None, ""]
    pages = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "id int, text string")
    for size in (1, 2, 3, 5, 9):
        terms = ["".join(rnd.choices(letters, k=size + rnd.randrange(3))) for _ in range(12)]
        terms = [t for t in terms if fold(t)]
        got = sorted(r.id for r in pg.terms_table_join(pages, pg.terms_table(spark, terms), max_inline=0).collect())
        want = sorted(i for i, t in [*enumerate(texts), (0, texts[0])] if t is not None and any(fold(x) in fold(t) for x in terms))
        assert got == want, terms


def test_empty_term_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "", 0)], "id int, text string, gram int")
    none = spark.createDataFrame([], TERMS)
    assert sorted(r.id for r in pg.terms_table_join(pages, pg.terms_table(spark, ["-", "q"]), max_inline=0).collect()) == [1, 3]
    assert pg.terms_table_join(pages, none, max_inline=-1).count() == 0
    assert pg.terms_table_join(pages.limit(0), pg.terms_table(spark, ["abcde"]), max_inline=0).count() == 0
    assert pg.terms_table_join(pages, pg.terms_table(spark, ["A"]), max_inline=0).columns == pages.columns


def test_plan_has_no_nested_loop(spark):
    pages = spark.range(100).select("id", F.concat(F.lit("some text of page"), "id").alias("text"))
    terms = spark.range(50_000).select(F.concat(F.lit("page"), "id").alias("term"))
    plan = pg.terms_table_join(pages, terms)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_terms_longer_than_a_probe(spark):
    rnd = random.Random(8)
    body = ["".join(rnd.choices("ab ", k=rnd.randrange(30, 200))) for _ in range(80)]
    pages = spark.createDataFrame(list(enumerate(body)), "id int, text string")
    terms = [b[at:at + n] for b, n in zip(body[:40], [39, 40, 41, 60, 90] * 8) for at in (0, len(b) // 3)]
    terms += [t[:-1] + ("b" if t[-1] == "a" else "a") for t in terms if len(t) > 41]
    got = sorted(r.id for r in pg.terms_table_join(pages, pg.terms_table(spark, terms), max_inline=0).collect())
    assert got == [i for i, t in enumerate(body) if any(x in t for x in terms)]


def test_only_pages_with_a_term_are_written(spark, monkeypatch, tmp_dir):
    """Pages that share blocks with many terms but hold none leave no rows behind."""
    monkeypatch.setattr(term_index, "scratch_path", lambda _, name: f"{tmp_dir}/{name}")
    pages = spark.createDataFrame([(i, "abcdefg hijklmnop " * 3 + str(i)) for i in range(50)], "id int, text string")
    terms = [f"cdefgxyz{n}" for n in range(30)] + [f"zzabcdef{n}" for n in range(30)] + ["hijklmno", "klmnop ab"]
    assert pg.terms_table_join(pages, pg.terms_table(spark, terms), max_inline=0).count() == 50
    assert spark.read.parquet(f"{tmp_dir}/met").count() == 50


@pytest.mark.parametrize("scanned", [0, term_index.SCANNED_BYTES])
def test_index_and_scan_agree_with_a_search(spark, monkeypatch, scanned):
    """Terms beyond what tasks hold go through the index; either way the rows are those of a plain search."""
    monkeypatch.setattr(term_index, "SCANNED_BYTES", scanned)
    rnd = random.Random(11)
    texts = ["".join(rnd.choices("abcde (-\n", k=rnd.randrange(0, 90))) for _ in range(120)] + [None, "", "eee"]
    pages = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "id int, text string")
    cut = [t[at:at + n] for t in texts[:40] for n in (1, 7, 8, 9, 16, 17, 50) for at in (rnd.randrange(len(t) + 1),)]
    terms = [t for t in cut if len(fold(t)) > 5] + ["eee"] + ["e" * 9 + t for t in cut if fold(t)] + [None]
    got = sorted(r.id for r in pg.terms_table_join(pages, spark.createDataFrame([(t,) for t in terms], "term string"), max_inline=0).collect())
    want = sorted(i for i, t in [*enumerate(texts), (0, texts[0])] if t is not None and any(fold(x) in fold(t) for x in terms if x is not None))
    assert got == want and 0 < len(got) < len(texts)


def test_pages_are_read_without_a_row_for_each_block(spark, monkeypatch, tmp_dir):
    """Short terms: no postings to join with every character of every page, which is what the index has."""
    monkeypatch.setattr(term_index, "scratch_path", lambda _, name: f"{tmp_dir}/{name}")
    pages = spark.range(50).select("id", F.concat(F.lit("the quick brown fox "), "id").alias("text"))
    terms = spark.range(300).select(F.concat(F.lit("z"), F.conv(F.col("id").cast("string"), 10, 36)).alias("term"))
    terms = terms.union(spark.createDataFrame([("x 7",)], "term string"))
    assert sorted(r.id for r in pg.terms_table_join(pages, terms).collect()) == [7]
    assert os.listdir(tmp_dir) == ["met"]


@pytest.mark.parametrize("chunk", [8, 16, 1 << 16])
def test_scan_across_chunks_and_texts(monkeypatch, chunk):
    import numpy as np

    from docflow.operators import term_scan

    monkeypatch.setattr(term_scan, "CHUNK", chunk)
    rnd = random.Random(chunk)
    for letters in ("ab ", "abcdefgh "):
        texts = ["".join(rnd.choices(letters, k=rnd.randrange(0, 80))) for _ in range(60)]
        terms = {t[at:at + n] for t in texts[::3] for n in (2, 5, 8, 11, 24, 25) for at in (rnd.randrange(len(t) + 1),)}
        terms = sorted({(t[:-1] + rnd.choice(letters)) for t in terms if len(t) > 4} | {"abababab" * 4})
        data = [t.encode() + b"\n" for t in texts]
        scan = term_scan.TermScan([t.encode() for t in terms])
        got = scan.matches(np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(t) for t in data]))
        assert list(got) == [any(x in t for x in terms) for t in texts]
