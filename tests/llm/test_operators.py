"""Small fixtures with nulls, blanks, ties, repeated rows, empty tables and clashing column names."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docflow.llm import bucket_refinement, common, decontaminate, lattice, line_blocks, line_frequency, paragraphs, probminhash, site_quality

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(60))
NEAR = LONG.replace("word30", "other")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, LONG, "en", "a"), (2, NEAR, "en", "a"), (3, LONG, "en", None), (3, LONG, "en", None), (4, None, None, "a"),
        (5, "", "en", "a"), (6, " \n\t ", "en", "a"), (None, "short text", "de", "b"), (7, "x " * 30000, "de", "b"),
        (8, "unrelated words of one\n" + LONG, "de", "b"), (9, "short text", "de", "b"),
    ]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("id", "label", "node", "row", "spans", "copy", "bands", "word", "n"):  # names the operators use
        made = made.withColumn(c, F.lit("z"))
    return made


def test_line_frequency(spark, docs):
    many = docs.unionByName(spark.range(100, 112).select(F.col("id").alias("doc_id"), F.lit("Common line 12\nown").alias("text"), F.lit("en").alias("lang"), F.lit("h").alias("source"), *[F.lit("z").alias(c) for c in docs.columns[4:]]))
    found = {r.doc_id: r for r in line_frequency.line_frequency(many).collect()}
    assert found[100].depleted and found[100].n_removed_chars == 17 and not found[1].depleted
    kept = line_frequency.clean_lines(many)
    assert kept.columns == many.columns and kept.count() == docs.count()
    assert line_frequency.line_frequency(docs.limit(0)).count() == 0


def test_decontaminate(spark, docs):
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(10, 25))), (2, "Short TEXT"), (3, None), (None, "unrelated")], "item_id long, text string")
    for limit in (10, 10**6):  # shuffled and broadcast
        got = {(r.doc_id, tuple(r["items"])): r.n_hit for r in decontaminate.find_contamination(docs, bench, max_broadcast=limit).collect()}
        assert got == {(1, ("1",)): 15, (2, ("1",)): 15, (3, ("1",)): 15, (None, ("2",)): 2, (9, ("2",)): 2, (8, ("1",)): 16}
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert "word9 word25" in cut[1] and cut[9] == "" and cut[4] is None
    assert decontaminate.find_contamination(docs, bench.limit(0)).count() == 0


def test_windows_of_all_sizes_match_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = ["a", "b", "c", "d"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 60))) for _ in range(40)]
    items = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (4, 5, 6, 7, 9)]
    items += [" ".join(texts[i].split()[rnd.randrange(0, 9) :][:n]) for i, n in enumerate(range(2, 30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {}
    for d, text in enumerate(texts):
        w = text.split()
        for item in items:
            x = item.split()
            n = min(len(x), 13)
            for k in range(len(x) - n + 1 if x else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == x[k : k + n]:
                        want.setdefault(d, set()).add((i + 1, n))
    for limit in (1, 10**6):
        rows = decontaminate.find_contamination(docs, bench, max_broadcast=limit).collect()
        assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows} == {d: sorted(s) for d, s in want.items()}


def test_documents_are_cut_into_few_seeds(spark):
    for size in range(1, 14):
        made = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(130)), lambda i: i.cast("string")).alias("w"))
        seeds = made.select(F.explode(decontaminate._seeds(F.col("w"), [size])).alias("x")).select("x.*").collect()
        windows = [(s["first"] + k, s.near[k : k + size]) for s in seeds for k in range(len(s.near) - size + 1)]
        assert sorted(p for p, _ in windows) == list(range(1, 130 - size + 2))
        assert all(w == [str(p + i) for i in range(size)] for p, w in windows)
        assert len(seeds) <= 130 // (size // 2 + 1) + 1


def test_near_duplicates(docs):
    got = [(r.doc_id, r.class_id) for r in probminhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 1), (3, 1), (4, 4), (5, 5), (6, 6), (7, 7), (8, 1), (9, 9), (None, 9)], key=str)
    kept = probminhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 9]
    assert probminhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_with_null_ids(spark):
    rows = [(1, LONG), (None, NEAR), (None, "alone " + LONG[::-1]), (None, "alone " + LONG[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in probminhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, 2), (None, 1, 2), (None, None, 2), (None, None, 2)], key=str)


def test_paragraphs(docs):
    got = {r.doc_id: r for r in paragraphs.remove_repeated(docs).collect()}
    assert got[1].text == LONG and got[2].text == "" and got[8].text == "unrelated words of one" and got[4].text is None
    assert got[7].removed_places == [] and got[3].removed_places == [0]
    assert paragraphs.remove_repeated(docs.limit(0)).count() == 0


def test_paragraphs_without_broadcast(docs, monkeypatch):
    def rows():
        return sorted(map(repr, paragraphs.remove_repeated(docs).select("doc_id", "text", "removed_places").collect()))

    split = rows()
    monkeypatch.setattr(common, "MAX_BROADCAST_IDS", -1)  # all texts go through the shuffle
    assert rows() == split and len(split) == docs.count()


def test_bucket_refinement(docs):
    got = {r.doc_id: (r.n_bytes, bytes(r.kept)) for r in bucket_refinement.remove_repeated_spans(docs).collect()}
    assert got[1][1] == LONG.encode() and got[3][1] == b"" and got[4] == (0, b"") and got[None][1] == b"short text"
    assert got[8][1] == b"unrelated words of one\n" and got[7][1] == b"x "
    assert bucket_refinement.remove_repeated_spans(docs.limit(0)).count() == 0


def test_lattice(docs):
    got = lattice.lattice_scores(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == docs.count() and by[4].n_tokens == by[5].n_tokens == 1 and by[7].n_tokens == 30001 and by[3].n_tokens == 61
    assert by[None].held_out and all(r.score < 0 for r in got)
    assert lattice.lattice_scores(docs.limit(0)).count() == 0


def test_site_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert site_quality.site_quality(docs, labels).count() == docs.count()
    none = site_quality.site_quality(docs, labels.limit(0))
    assert none.where("kept").count() == docs.count()
    assert site_quality.keep_good(docs, labels).columns == docs.columns
    assert site_quality.site_quality(docs.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    found = site_quality.site_quality(docs, labels.where(half)).join(labels.where(~half), "doc_id")
    right = found.where(F.col("kept") == ((F.col("quality") == 1) & (F.col("toxic") == 0))).count()
    assert right >= 0.85 * found.count()


def test_pages(spark):
    page = "<body><nav>m</nav><div class=ad>x</div><article><h1>T</h1><p>a &amp;\n b<p>c<br>d</article><footer>f</footer>"
    rows = [(1, page, "k"), (1, page, "k"), (2, None, None), (3, "", ""), (4, "<script>x</script>", "")]
    df = spark.createDataFrame(rows, "page_id long, html string, main_text string")
    assert [r.main_text for r in line_blocks.extract_pages(df).orderBy("page_id").collect()] == ["T a & b c d"] * 2 + [""] * 3
    assert line_blocks.extract_pages(df.limit(0)).count() == 0


def test_spans_match_brute_force(spark):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: tuple(r)[1:] for r in bucket_refinement.op5_bucket_refinement(spark, SF).collect()}
    seen = set()
    for d, raw in rows:
        cover = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                cover[p : p + 100] = b"\x01" * 100
            seen.add(raw[p : p + 100])
        kept = bytes(x for x, c in zip(raw, cover) if not c)
        spans = sum(1 for s in bytes(cover).split(b"\x00") if s)
        assert got[d] == (len(raw), sum(cover), spans, hashlib.sha256(kept).hexdigest())


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _classes(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {k: find(k) for k in sets}


def test_classes_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = _classes({r.doc_id: _shingles(r.text) for r in rows})
    assert {r.doc_id: r.class_id for r in probminhash.op9_probminhash(spark, SF).collect()} == want


def test_paragraphs_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = _classes({(r.doc_id, i): _shingles(p) for r in rows for i, p in enumerate((r.text or "").split("\n")) if len(p.split()) >= 20})
    got = {(r.doc_id, i) for r in paragraphs.op3_paragraph_minhash(spark, SF).collect() for i in r.removed_places}
    assert got == {k for k, c in found.items() if k != c}
