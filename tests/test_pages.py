"""Page selection and routing (P15-P18, P22, A6-A10, J5, J7) and extraction."""

import os

import pytest
from pyspark.sql import functions as F

from docflow.operators import pages as pg
from docflow.sources import documents as dc

TERMS = ["plan description"]


def pageset(spark, rows, schema="doc_id int, pages array<string>"):
    return spark.createDataFrame(rows, schema)


def test_first_hit_and_window(spark):
    ps = pageset(spark, [(1, ["a", "b", "c", "d", "Plan Description", "x"]), (2, ["nothing"])])
    out = ps.select("doc_id", pg.first_hit_page("pages", TERMS).alias("p"),
                    pg.page_window("pages", pg.first_hit_page("pages", TERMS)).alias("w")).orderBy("doc_id").collect()
    assert out[0].p == 4 and out[0].w == ["Plan Description", "x"]  # J5: 6 pages, start 4 -> pages 4, 5
    assert out[1].p == -1 and out[1].w == []  # A6: no hit


def test_too_long_boundary(spark):
    ps = pageset(spark, [(1, ["p"] * 100), (2, ["p"] * 101)])
    got = [r[0] for r in ps.orderBy("doc_id").select(pg.is_too_long("pages", 100)).collect()]
    assert got == [False, True]


def test_route_documents_classes(spark):
    hit = "Plan Description and the text"
    rows = [
        (1, [], None),  # no pages -> corrupted
        (2, ["x"] * 5, "cannot open"),  # open error -> corrupted
        (3, ["x"] * 11, None),  # too long (limit 10)
        (4, ["x", None, hit], None),  # unreadable page before the hit -> reader failed
        (5, [hit, None], None),  # unreadable page after the hit -> fine
        (6, ["x", "y"], None),  # not found
        (7, ["plan description"], None),  # no "the" -> empty
    ]
    ps = spark.createDataFrame(rows, "doc_id int, pages array<string>, error string")
    got = {r.doc_id: r.status for r in pg.route_documents(ps, TERMS, limit_pages=10, error="error").collect()}
    assert got == {1: "corrupted_file", 2: "corrupted_file", 3: "file_too_long", 4: "pdf_reader_failed",
                   5: "processed", 6: "plan_not_found", 7: "text_extraction_empty"}


def test_cascade_first_extractor_wins(spark):
    w = spark.createDataFrame(
        [(1, ["a"] * 5 + ["plan description"], ["plan description"], ["x"])],
        "doc_id int, pages_1 array<string>, pages_2 array<string>, pages_3 array<string>")
    winner, page, failed = pg.cascade_columns(["pages_1", "pages_2", "pages_3"], TERMS, tolerant=["pages_2"])
    r = w.select(winner.alias("e"), page.alias("p"), failed.alias("f")).first()
    assert (r.e, r.p, r.f) == (1, 5, False)


def test_cascade_tolerant_and_failing(spark):
    w = spark.createDataFrame(
        [(1, ["a"], [None, "plan description"], ["x"]), (2, ["a"], ["b"], [None, "plan description"])],
        "doc_id int, pages_1 array<string>, pages_2 array<string>, pages_3 array<string>")
    winner, page, failed = pg.cascade_columns(["pages_1", "pages_2", "pages_3"], TERMS, tolerant=["pages_2"])
    got = {r.doc_id: (r.e, r.p, r.f) for r in w.select("doc_id", winner.alias("e"), page.alias("p"),
                                                        failed.alias("f")).collect()}
    assert got == {1: (2, 1, False), 2: (None, -1, True)}


def test_text_or_ocr(spark):
    w = spark.createDataFrame([(["", "", "scan"], ["o0", "o1", "the ocr"], 2), (["x", "the text"], ["z", "q"], 0)],
                              "t array<string>, o array<string>, s int")
    got = [r[0] for r in w.select(pg.text_or_ocr("t", "o", "s")).collect()]
    assert got == ["the ocr", "x\fthe text"]


def test_to_wide_equals_wide(spark):
    long = spark.createDataFrame([(1, 2, ["b"]), (1, 1, ["a"]), (1, 3, ["c"])],
                                 "doc_id int, extractor int, pages array<string>")
    r = pg.to_wide(long).first()
    assert (r.pages_1, r.pages_2, r.pages_3) == (["a"], ["b"], ["c"])


def test_row_layout_forms(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "plan description"), (1, 2, "b"), (1, 3, "c"), (2, 0, "z")],
                                 "doc_id int, page_no int, text string")
    starts = pg.first_hit_page_rows(rows, TERMS)
    got = {r.doc_id: (r.page_no, r.n_pages) for r in starts.collect()}
    assert got == {1: (1, 4), 2: (-1, 1)}
    window = pg.page_window_rows(rows, starts, n=2)
    joined = pg.join_page_texts_rows(window).first()
    assert joined.text == "plan description\nb"
    back = pg.collect_pages(rows).orderBy("doc_id").first()
    assert back.pages == ["a", "plan description", "b", "c"]
    semi = pg.terms_table_join(rows, pg.terms_table(spark, ["PLAN description", "zz"]))
    assert [(r.doc_id, r.page_no) for r in semi.collect()] == [(1, 1)]


def test_document_files_and_extractors(spark, tmp_dir):
    ps = spark.createDataFrame([("7", 2001, ["p0", "the p1", "p2"]), ("8", 2002, ["only"])],
                               "ack_id string, year int, pages array<string>")
    root = dc.write_document_files(ps, os.path.join(tmp_dir, "docs"))
    docs = dc.scan_documents(spark, root)
    got = {r.ack_id: (r.year, r.length) for r in docs.collect()}
    assert got == {"7": (2001, len("p0\fthe p1\fp2\f")), "8": (2002, 5)}
    native = {r.ack_id: r.pages for r in dc.extract_pages_native(docs).collect()}
    py = {r.ack_id: r.pages for r in dc.extract_pages(docs, dc.form_feed_pages).collect()}
    assert native == py == {"7": ["p0", "the p1", "p2"], "8": ["only"]}


def test_extract_errors_and_staged_cascade(spark):
    docs = spark.createDataFrame([("1", b"plan description"), ("2", b"nothing\fhere"), ("3", b"\xff")],
                                 "ack_id string, content binary")

    def failing(b):
        if b == b"\xff":
            raise ValueError("cannot open")
        return [None if p == "here" else p for p in b.decode().split("\f")]

    def ocr(b):
        return ["plan description ocr"]

    wide = dc.run_cascade(docs, [(1, failing, False), (2, ocr, False)], TERMS)
    rows = {r.ack_id: (r.pages_1, r.pages_2, r.error is not None) for r in wide.collect()}
    # 1: extractor 1 hits; its window lacks "the", so OCR runs for the text choice (A10)
    assert rows["1"] == (["plan description"], ["plan description ocr"], False)
    # 2: extractor 1 meets an unreadable page before any hit: decided, OCR never runs
    assert rows["2"] == (["nothing", None], None, False)
    # 3: cannot be opened: decided, error kept
    assert rows["3"] == (None, None, True)
    plain = {r.ack_id: r.pages_2 for r in dc.run_cascade(docs, [(1, failing, False), (2, ocr, False)], TERMS,
                                                         ocr_window=False).collect()}
    assert plain == {"1": None, "2": None, "3": None}
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()


def test_terms_table_join_both_paths(spark):
    # "Descrip-tion" matches only after the fold; "plan-description" and a line break between
    # the words do not (deleting them leaves no blank)
    rows = spark.createDataFrame([(1, 0, "the Plan Descrip-tion"), (1, 1, "plan-description"),
                                  (2, 0, "Plan\nDescription")], "doc_id int, page_no int, text string")
    terms = pg.terms_table(spark, ["Plan Description", "zz"])
    inline = sorted(tuple(r) for r in pg.terms_table_join(rows, terms).collect())
    joined = pg.terms_table_join(rows, terms, max_inline=0)  # by the index: joined on keys, not term by term
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Join" in plan
    assert inline == [(1, 0, "the Plan Descrip-tion")]
    assert sorted(tuple(r) for r in joined.collect()) == inline


def test_original_layout_and_codec_by_path(spark, tmp_dir):
    root = os.path.join(tmp_dir, "downloaded")
    for year, ack, body in [("2001", "12", b"p0\fthe plan description\f"), ("2002", "x.y", b"only\f")]:
        os.makedirs(os.path.join(root, year), exist_ok=True)
        with open(os.path.join(root, year, f"{ack}.pdf"), "wb") as fh:
            fh.write(body)
    listing = dc.scan_documents(spark, root, glob="*.pdf", with_content=False)
    got = {r.ack_id: r.year for r in listing.collect()}
    assert got == {"12": 2001, "x.y": 2002}
    from pyspark.sql import functions as F

    ps = dc.codec_where(listing.withColumn("_run", F.col("ack_id") == "12"), dc.form_feed_pages, "pages", "err", "_run")
    pages = {r.ack_id: r.pages for r in ps.collect()}
    assert pages == {"12": ["p0", "the plan description"], "x.y": None}


def test_missing_pages_are_corrupted_without_ansi(spark):
    ps = spark.createDataFrame([(1, None)], "doc_id int, pages array<string>")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        r = pg.route_documents(ps, ["x"]).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert (r.n_pages, r.page_no, r.status) == (0, -1, "corrupted_file")


def test_later_codec_failure_is_reader_failure(spark):
    docs = spark.createDataFrame([("1", b"nothing"), ("2", b"nothing")], "ack_id string, content binary")

    def failing_ocr(b):
        raise RuntimeError("renderer crashed")

    def text_layer(b):
        return [b.decode()]

    strict = dc.run_cascade(docs, [(1, text_layer, False), (2, failing_ocr, False)], TERMS)
    r = pg.route_cascade(strict, ["pages_1", "pages_2"], "pages_1", "pages_2", [], TERMS).first()
    assert r.status == "pdf_reader_failed"
    tolerant = dc.run_cascade(docs, [(1, text_layer, False), (2, failing_ocr, True)], TERMS)
    r = pg.route_cascade(tolerant, ["pages_1", "pages_2"], "pages_1", "pages_2", ["pages_2"], TERMS).first()
    assert r.status == "plan_not_found"


def test_small_files_share_tasks(spark, tmp_dir):
    cores = spark.sparkContext.defaultParallelism
    n = 32 * 6 * cores  # files of some 4 MB each, as Spark counts them, in lots of 32
    pages = spark.range(n).select(F.col("id").cast("string").alias("ack_id"), (F.lit(2000) + F.col("id") % 3).cast("int").alias("year"),
                                  F.array(F.lit("p")).alias("pages"))
    root = dc.write_document_files(pages, os.path.join(tmp_dir, "docs"))
    docs = dc.scan_documents(spark, root)
    assert docs.rdd.getNumPartitions() <= 4 * cores
    assert docs.count() == n and docs.select("path").distinct().count() == n
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    assert docs.select("path", "length").exceptAll(plain.select("path", "length")).isEmpty()


def test_hidden_and_loose_files(spark, tmp_dir):
    for rel in ("2001/a.txt", ".x/b.txt", "_y/c.txt", "year=2002/ack_id=7/d.txt"):
        os.makedirs(os.path.join(tmp_dir, "r", os.path.dirname(rel)), exist_ok=True)
        open(os.path.join(tmp_dir, "r", rel), "w").write("t")

    def listed():
        return sorted((r.ack_id, r.year) for r in dc.scan_documents(spark, os.path.join(tmp_dir, "r")).collect())

    assert listed() == [("7", 2002), ("a", 2001)]
    open(os.path.join(tmp_dir, "r", "loose.txt"), "w").write("t")  # beside folders: the root is read as it is
    assert [k for k, _ in listed()] == ["7", "a", "loose"]


def test_listing_is_a_table_made_by_tasks(spark, tmp_dir):
    """The driver holds no file of the archive; what is listed is what Spark's reader lists, in any layout."""
    root = os.path.join(tmp_dir, "r")
    names = ["2001/a.txt", "2001/b c%20+.txt", "2001/.hid.txt", "2001/_tmp", "2001/_k=1", "2001/none.txt", "2001/x.pdf", "2001/deep/er/y.txt",
             "_t/z.txt", "_metadata", "loose.txt", "2002/é.txt", "2002/w._COPYING_", *[f"year=2003/ack_id={i}/d.txt" for i in range(50)]]
    for rel in names:
        os.makedirs(os.path.join(root, os.path.dirname(rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write("" if "none" in rel else rel)
    for glob in ("*", "*.txt", "*.{txt,pdf}", "[a-c]*"):
        plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        docs = dc.scan_documents(spark, root, glob)
        want = sorted((r.path, r.length, bytes(r.content)) for r in plain.collect())
        assert sorted((r.path, r.length, bytes(r.content)) for r in docs.collect()) == want and len(want) > 1
        assert not [f for f in docs.inputFiles() if f.startswith(f"file://{root}/")]
    assert dc.scan_documents(spark, os.path.join(root, "200{1,2}")).count() == 6  # wildcards: by Spark's reader
    assert dc.scan_documents(spark, [os.path.join(root, "2002")]).count() == 1
    os.makedirs(os.path.join(tmp_dir, "empty"))
    assert dc.scan_documents(spark, os.path.join(tmp_dir, "empty")).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dc.scan_documents(spark, os.path.join(tmp_dir, "absent"))


def test_extraction_hands_files_over_in_lots(spark, tmp_dir, monkeypatch):
    """Whatever the bound of bytes held at once, every file comes out whole; an unreadable one is told or raises."""
    root = os.path.join(tmp_dir, "docs")
    os.makedirs(os.path.join(root, "2001"))
    for i in range(40):
        with open(os.path.join(root, "2001", f"{i}.txt"), "wb") as fh:
            fh.write(f"page {i}\f".encode() * (i + 1))
    monkeypatch.setattr(dc, "READ_BYTES", 500)
    docs = dc.scan_documents(spark, root).coalesce(1)
    ps = {r.ack_id: r.pages for r in dc.extract_pages(docs, dc.form_feed_pages).collect()}
    assert ps == {str(i): [f"page {i}"] * (i + 1) for i in range(40)}
    seen = dc.read_content(dc.scan_documents(spark, root, with_content=False).withColumn(
        "path", F.when(F.col("ack_id") == "7", F.lit(f"{root}/gone")).otherwise(F.col("path")))).collect()
    assert {r.ack_id for r in seen if r.content is None} == {"7"} and len(seen) == 40
    assert [r.read_error.startswith(dc.UNREAD) for r in seen if r.read_error] == [True]
    gone = dc.scan_documents(spark, root)
    os.remove(os.path.join(root, "2001", "7.txt"))
    with pytest.raises(Exception, match="7.txt"):
        gone.collect()


@pytest.mark.parametrize("query", ["scan_documents", "extract_pages", "staged_cascade"])
def test_queries_over_document_files_list_none_of_them_on_the_driver(spark, query):
    import __spark_entry__ as e

    d = "/root/testdata/sf0.001"
    df = e.queries()[query](spark, d)
    assert not [f for f in df.inputFiles() if f.endswith(".txt")]
    assert df.select("ack_id").distinct().count() == spark.read.parquet(f"{d}/documents.parquet").select("doc_id").distinct().count()
