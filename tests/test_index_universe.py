"""Index files (S1-S3), universe operators (P1-P9, A1-A4, U1-U2, J1), sinks (K1, K2)."""

import os
import warnings

import pytest

from docflow.operators import universe as uv
from docflow.sources import index_files as ix
from docflow.sources import tables as tb

HEADER = " id | filing_year |sponsor_name| link"


def write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_scan_index_golden(spark, tmp_dir):
    write(os.path.join(tmp_dir, "2001.txt"), [
        "Listing", "", "as of today",  # 3 physical preamble lines, one blank
        "",  # blank before the header
        HEADER,
        "---|---|---|---",
        r"2|2001|x\|y|v",
        '1|2001|"A"|u',
        "5|2001|a|b|c",  # too many fields
        "4|2001",  # too few: padded
        "",
        "NA|2001| None | null",
    ])
    scan = ix.read_index(spark, tmp_dir)
    rows = sorted(scan.rows.collect(), key=lambda r: str(r.ack_id))
    assert scan.rows.columns == ["ack_id", "filing_year", "sponsor_name", "link"]
    got = [(r.ack_id, r.filing_year, r.sponsor_name, r.link) for r in rows]
    assert ("2", 2001, "x|y", "v") in got
    assert ("1", 2001, "A", "u") in got
    assert ("4", 2001, None, None) in got
    assert (None, 2001, "None", "null") in got  # NA tokens match before trimming only
    assert len(got) == 4
    bad = scan.bad_lines.collect()
    assert [(b.line, b.n_fields, b.n_header) for b in bad] == [("5|2001|a|b|c", 5, 4)]


def test_scan_index_split_files_and_headers(spark, tmp_dir):
    """Files split across partitions and files with different headers."""
    big = ["p1", "p2", "p3", "id|filing_year|sponsor_name"] + [f"{i}|2002|s{i}" for i in range(3000)]
    write(os.path.join(tmp_dir, "2002.txt"), big)
    write(os.path.join(tmp_dir, "2003.txt"), ["p", "p", "p", "id|filing_year|extra|sponsor_name", "z9|2003|e|s"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = ix.scan_index(spark, tmp_dir)
        assert df.count() == 3001
        assert set(df.columns) == {"ack_id", "filing_year", "sponsor_name", "extra"}
        assert df.where("ack_id = 'z9'").first().extra == "e"
        assert df.where("ack_id is null or sponsor_name like 'p%'").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_drop_ruler_rows(spark):
    df = spark.createDataFrame([("--", 1), (None, 2), ("-a", 3)], "a string, b int")
    assert sorted(r.b for r in uv.drop_ruler_rows(df).collect()) == [2, 3]


def test_filter_codes(spark):
    df = spark.createDataFrame([("1", "2J2K"), ("2", "2l"), ("3", None), ("4", "1A2L")],
                               "ack_id string, pension_benefit_code string")
    assert sorted(r.ack_id for r in uv.filter_codes(df).collect()) == ["1", "4"]
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert uv.filter_codes(df.drop("pension_benefit_code")).count() == 4
        assert w


def test_all_valid_empty_and_blank(spark):
    empty = spark.createDataFrame([], "filing_year int")
    assert uv.all_valid(empty).first().all_valid is True
    some = spark.createDataFrame([("2001",), (" ",)], "filing_year string")
    assert uv.all_valid(some).first().all_valid is False


def test_coerce_and_cast_year(spark):
    df = spark.createDataFrame([("2001",), ("x",), (None,)], "y string")
    assert [r[0] for r in df.select(uv.coerce_year("y")).collect()] == [2001, None, None]
    with pytest.raises(Exception):
        uv.cast_year(df.toDF("filing_year")).collect()


def test_distinct_ids_and_union(spark):
    a = spark.createDataFrame([(" 1",), ("2",), (None,)], "ack_id string")
    b = spark.createDataFrame([("2 ",), ("3",)], "ack_id string")
    assert sorted(r.ack_id for r in uv.union_ids([a, b]).collect()) == ["1", "2", "3"]


def test_build_universe(spark):
    idx = spark.createDataFrame([("1", "2001", "a"), ("1", "2001", "a"), ("2", "x", "b"), ("3", "2003", "c")],
                                "ack_id string, filing_year string, sponsor_name string")
    ids = spark.createDataFrame([("1",), ("2",)], "ack_id string")
    u = uv.build_universe(idx, ids).orderBy("ack_id").collect()
    assert [(r.ack_id, r.filing_year) for r in u] == [("1", 2001), ("2", None)]


def test_csv_round_trip_keeps_text(spark, tmp_dir):
    text = 'a\nb "q" \\ c, d\r\ne'
    df = spark.createDataFrame([("1", 2001, text), ("2", 2001, " pad ")], "ack_id string, year int, ocr_text string")
    path = tb.write_year_text(df, os.path.join(tmp_dir, "t"), fmt="csv")
    back = {r.ack_id: r.ocr_text for r in tb.scan_year_results(spark, path, fmt="csv", glob="*.csv").collect()}
    assert back == {"1": text, "2": " pad "}


def test_write_by_year_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(str(i), 2000 + i % 3) for i in range(30)], "ack_id string, filing_year int")
    path = tb.write_by_year(df, os.path.join(tmp_dir, "u"))
    assert sorted(os.listdir(path))[-3:] == ["filing_year=2000", "filing_year=2001", "filing_year=2002"]
    y = tb.scan_universe(spark, path, 2001)
    assert y.count() == 10
    plan = y._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(filing_year" in plan


def test_read_id_list_prunes_columns(spark):
    df = tb.read_id_list(spark, "/root/testdata/sf0.001/part.parquet", id_col="p_partkey", code_col="p_type",
                         pattern="ECO|PRO")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan


def test_repeated_header_names(spark, tmp_dir):
    write(os.path.join(tmp_dir, "2004.txt"), ["p", "p", "p", "id|filing_year|note|note", "7|2004|a|b"])
    r = ix.scan_index(spark, tmp_dir).first()
    assert (r["ack_id"], r["note"], r["note.1"]) == ("7", "a", "b")


def test_files_with_different_headers_one_pass(spark, tmp_dir):
    # two header layouts: columns are the union, a file lacking a column gives nulls, a short
    # line is null-padded, a long one is quarantined; lines are split and named in one pass
    write(os.path.join(tmp_dir, "2001.txt"), ["p", "p", "p", "id|filing_year|sponsor_name", "1|2001|A", "2|2001"])
    write(os.path.join(tmp_dir, "2002.txt"), ["p", "p", "p", "", "id|filing_year|plan|sponsor_name",
                                              "3|2002|x|C", "4|2002|y|D|extra"])
    write(os.path.join(tmp_dir, "2003.txt"), ["p", "p", "p", "a|a|a.1", "5|6|7"])
    scan = ix.read_index(spark, tmp_dir)
    rows = {r["ack_id"]: r.asDict() for r in scan.rows.collect() if r["ack_id"]}
    assert rows["1"]["sponsor_name"] == "A" and rows["1"]["plan"] is None
    assert rows["2"]["sponsor_name"] is None
    assert rows["3"]["plan"] == "x" and rows["3"]["filing_year"] == 2002
    assert "4" not in rows
    assert [(r.n_fields, r.n_header) for r in scan.bad_lines.collect()] == [(5, 4)]
    r = [x.asDict() for x in scan.raw.where("a is not null").collect()][0]
    assert (r["a"], r["a.1"], r["a.1.1"]) == ("5", "6", "7")  # a taken suffix is skipped
    assert "Union" not in scan.rows._jdf.queryExecution().optimizedPlan().toString()


def test_layout_of_splits_changes_between_build_and_action(spark, tmp_dir):
    for y in (2001, 2002, 2003):
        write(os.path.join(tmp_dir, f"{y}.txt"), ["p", "", "p", "", "id|filing_year|sponsor_name", "--|--|--"]
              + [f"{y}-{i}|{y}|s{i}" for i in range(4000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        scan = ix.read_index(spark, tmp_dir)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        spark.conf.set("spark.sql.files.minPartitionNum", "3")
        assert scan.rows.count() == scan.rows.distinct().count() == 12000
        assert scan.raw.count() == 12003  # rulers are rows there
    finally:
        for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{k}")
    plan = scan.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan and " text" not in plan  # rows come from the written lines


def test_padded_headers_rulers_and_files_without_a_header(spark, tmp_dir):
    write(os.path.join(tmp_dir, "2001.txt"), ["p", "p", "p", "first|id|filing_year", "---|---|---", "a|1|2001"])
    write(os.path.join(tmp_dir, "2002.txt"), ["p", "p", "p", " id |filing_year ", "---|----", "2|2002"])
    write(os.path.join(tmp_dir, "2003.txt"), ["p", "p", "p", "", " "])
    scan = ix.read_index(spark, tmp_dir)
    assert scan.rows.columns == ["first", "ack_id", "filing_year"]
    assert sorted(map(tuple, scan.rows.collect()), key=str) == [("a", "1", 2001), (None, "2", 2002)]
    assert [r[0].rsplit("/", 1)[1] for r in scan.no_header.collect()] == ["2003.txt"]


def test_index_without_files(spark, tmp_dir):
    scan = ix.read_index(spark, tmp_dir)
    assert scan.rows.columns == ["ack_id", "filing_year"] and scan.rows.count() == 0
    assert scan.bad_lines.count() == 0 and scan.no_header.count() == 0
