"""Plan shapes that the design relies on at scale."""


import __spark_entry__ as E
from docflow.operators import ledger as lg

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    p = physical(df)
    return p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning") + p.count("Exchange RoundRobin")


def test_document_routing_is_narrow(spark):
    qs = E.queries()
    for key in ("classify_outcome", "extractor_cascade", "text_or_ocr", "process_cascade", "join_page_texts"):
        assert exchanges(qs[key](spark, SF)) == 0, key
    assert exchanges(qs["process_waterfall"](spark, SF)) == 1  # the per-year count only


def test_routing_scan_is_pruned(spark):
    p = physical(E.queries()["classify_outcome"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    assert "BatchEvalPython" not in p  # no row-at-a-time Python


def test_ledger_reports_use_partial_aggregation(spark):
    p = physical(E.queries()["status_waterfall"](spark, SF))
    assert "partial_max_by" in p and "partial_count" in p


def test_fetch_outcome_error_kinds(spark):
    a = spark.createDataFrame([(1, 1, 503, "timeout"), (1, 2, 200, None), (2, 1, 599, "other")],
                              "doc int, event_id int, status_code int, kind string")
    got = {r.doc: r.outcome for r in lg.fetch_outcome(a, error_kind="kind").collect()}
    assert got == {1: "ok", 2: "permanent"}  # D12: a non-network error is not retried


def test_page_arrays_built_once_when_exploded(spark):
    # no inferred size(...) > 0 filter: it would copy the page split / page scan below the
    # projection that computes the arrays
    qs = E.queries()
    for key in ("terms_table_join", "page_window", "extract_pages"):
        p = qs[key](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "size(" not in p, key


def test_scan_documents_reads_the_bytes(spark):
    import __spark_entry__

    df = __spark_entry__.queries()["scan_documents"](spark, "/root/testdata/sf0.001")
    assert "content" in df._jdf.queryExecution().executedPlan().toString()
