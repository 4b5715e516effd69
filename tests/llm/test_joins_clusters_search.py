"""PartEnum join, dimension-sharded clustering and tree search against plain Python, with edge rows."""
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import clusters, dimension_lloyd, fp_tree, partenum

VOCABULARY = [f"w{i}" for i in range(400)]


def extra(df):
    for c in ("id", "label", "node", "codes", "code", "n", "text_hash", "item", "terms", "rank", "score", "chunk", "block", "x"):
        df = df.withColumn(c, F.lit("z"))
    return df


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def test_partenum_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(None, "a b c d e f g"), (1, "A b\tc d e f g"), (2, None), (3, " \n"), (4, "É x"), (5, "é x"), (6, "é X"), (7, "one"), (7, "one"), (8, "a b c d e f g"), (None, "alone in the null id row")]
    for size in (6, 9, 12, 20, 33, 60, 150, 700):
        base = [rnd.choice(VOCABULARY) for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, size // 25) + 1)):
                copy[rnd.randrange(len(copy))] = rnd.choice(VOCABULARY)
            copy = copy[: len(copy) - rnd.randrange(0, 1 + size // 12)]
            rows.append((100 + len(rows), " ".join(copy)))
    docs = extra(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in partenum.jaccard_components(docs).collect()]
    assert sorted(got, key=str) == brute_components(rows)
    assert partenum.jaccard_components(docs.limit(0)).count() == 0


def test_members_of_many_codes_meet_once(spark):
    rnd = random.Random(5)
    held = {(rnd.randrange(-(2**60), 2**60), node) for node in range(6) for _ in range(3)}
    held |= {(code, node) for code in (rnd.randrange(-(2**60), 2**60) for _ in range(partenum.EARLIER + 14)) for node in range(9) if rnd.random() < 0.8}
    known = spark.createDataFrame([(c, n, n % 3, n % 4) for c, n in held], "code long, node long, degree long, label long")
    first = known.where("node >= 4")
    small = spark.createDataFrame([(n, 100, [7] * partenum.SKETCH) for n in range(9)], "id long, n long, sketch array<long>")
    met = Counter((r.a, r.b) for r in partenum._meet(first, known, small, 80).collect())
    want = {(a, b) for c, a in held if a >= 4 for d, b in held if c == d and a % 4 != b % 4 and (b % 3, b) < (a % 3, a)}
    assert set(met) == want and set(met.values()) == {1}


def test_parities_leave_out_only_pairs_below_the_threshold(spark):
    rnd = np.random.default_rng(7)
    whole = rnd.integers(0, 2**63, 900, dtype=np.uint64)
    # 300 values of each set, of which 250 or more are shared: J from 0.71
    held = [np.concatenate((whole[:c], whole[300 + 30 * k : 600 + 30 * k - c])) for k, c in enumerate((280, 250, 268, 255, 300))]
    sets = [np.sort(h) for h in held]
    owner = np.repeat(np.arange(len(sets)), [len(h) for h in sets])
    values = np.concatenate(sets)
    sketch = np.hstack((partenum.sketches(owner, values, len(sets), partenum.MINHASH), partenum.parities(owner, values, len(sets), partenum.PARITY)))
    rows = [(i, len(h), sketch[i].tolist()) for i, h in enumerate(sets)]
    small = spark.createDataFrame(rows, "id long, n long, sketch array<long>")
    pairs = partenum._sided(small, "a").crossJoin(partenum._sided(small, "b")).where("a < b")
    kept = {(r.a, r.b) for r in pairs.where(partenum._may_be_similar(80)).collect()}
    jaccard = {(a, b): len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) for a in range(len(sets)) for b in range(a + 1, len(sets))}
    assert {p for p, j in jaccard.items() if j >= 0.8} <= kept
    assert min(jaccard.values()) < 0.72 and kept <= {p for p, j in jaccard.items() if j >= 0.75}


def test_comparing_sketches_is_short_enough_to_be_compiled(spark, tmp_dir, capsys):
    spark.createDataFrame([(c, n, n, n) for c in range(2) for n in range(9)], "code long, node long, degree long, label long").write.parquet(f"{tmp_dir}/known")
    spark.createDataFrame([(n, 100, [7] * partenum.SKETCH) for n in range(9)], "id long, n long, sketch array<long>").write.parquet(f"{tmp_dir}/small")
    known, small = spark.read.parquet(f"{tmp_dir}/known"), spark.read.parquet(f"{tmp_dir}/small")
    pairs = known.select(F.col("node").alias("a"), F.col("label").alias("b"))
    settings = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in settings}
    try:
        spark.conf.set(settings[0], "false")
        for limit in ("-1", "10m"):
            spark.conf.set(settings[1], limit)
            partenum._meet(known.where("node > 3"), known, small, 80).explain("codegen")
        spark.conf.set(settings[1], "-1")  # as with many pairs
        sides = pairs.join(partenum._sided(small, "a"), "a").join(partenum._sided(small, "b"), "b")
        sides.where(partenum._may_be_similar(80)).select("a", "b").explain("codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    # the JVM interprets longer methods
    assert len(sizes) > 20 and max(sizes) <= 8000


def test_pieces_of_a_large_code_are_taken_together(spark, tmp_dir):
    spark.createDataFrame([(0, n, n, n) for n in range(400)], "code long, node long, degree long, label long").write.parquet(f"{tmp_dir}/known")
    spark.createDataFrame([(n, 100, [n] * partenum.SKETCH) for n in range(400)], "id long, n long, sketch array<long>").write.parquet(f"{tmp_dir}/small")
    known, small = spark.read.parquet(f"{tmp_dir}/known"), spark.read.parquet(f"{tmp_dir}/small")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        met = partenum._meet(known.where("node >= 200"), known, small, 80)
        assert met.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sets_without_a_pair_are_not_shuffled(spark, tmp_dir):
    spark.range(2000).select(F.col("id"), F.array("id", F.lit(-1)).alias("grams")).write.parquet(f"{tmp_dir}/sets")
    pairs = spark.createDataFrame([(1, 2), (5, 9), (5, 5000)], "a long, b long")
    found = clusters.similar(pairs, spark.read.parquet(f"{tmp_dir}/sets"), 0.3)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (5, 9)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


def test_codes_of_one_id_are_not_shuffled_again(spark, monkeypatch):
    sets = spark.createDataFrame([(i, [i // 2, 70 + i // 2], [0] * 16) for i in range(8)], "id long, grams array<long>, sketch array<long>")
    items = spark.createDataFrame([(i, [i // 4, 100 + i]) for i in range(8)], "id long, bands array<long>")
    seen, stored = {}, clusters.stored
    monkeypatch.setattr(clusters, "stored", lambda df, name: seen.setdefault(name, df) and stored(df, name))
    labels = clusters.link_buckets(items, lambda ids: sets.join(ids, "id"), 0.8)
    assert {tuple(r) for r in labels.collect()} == {(i, i // 2 * 2) for i in range(8)}
    assert "Join LeftOuter" in seen["gathered"]._jdf.queryExecution().optimizedPlan().toString()


def test_similar_sets_always_share_a_signature():
    rnd = np.random.default_rng(7)
    for size in (5, 8, 11, 17, 40, 130):
        for _ in range(60):
            a = rnd.integers(1, 2**63, size).astype(np.uint64)
            most = partenum.differences(size, size)
            gone = rnd.integers(0, most // 2 + 1)
            b = np.concatenate((a[gone:], rnd.integers(1, 2**63, most - gone).astype(np.uint64)))
            jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            if jaccard < 0.8 or len(np.setxor1d(a, b)) == 0:
                continue
            x, y = (partenum.signatures(np.zeros(len(s), dtype=int), np.sort(s), 1)[0] for s in (a, b))
            assert np.intersect1d(x, y).size


def brute_lloyd(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    keys = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, hashlib.sha256(f"1:{kept[n][0]}".encode()).hexdigest(), kept[n][1]))
    centroids = [kept[n][1] for n in keys[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        found = [near(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            own = [x for (_, x), f in zip(kept, found, strict=True) if f == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = [(i, *near(x)) for i, x in kept]
    sums = Counter()
    for _, d, j in out:
        sums[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, sums[j], sum(sums.values()), digest[j]) for i, d, j in out), key=str)


@pytest.mark.parametrize("count", [3, 120])
def test_lloyd_matches_brute_force(spark, count):
    rnd = random.Random(count)
    rows = [(i, [rnd.gauss(i % 5 - 2, 1) for _ in range(64)]) for i in range(count)]
    rows += [(1, rows[1][1]), (None, rows[0][1]), (900, None), (901, [0.5] * 63), (902, [0.5] * 63 + [None]), (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] + [0.0] * 63), (905, [])]
    table = extra(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    for options in ({}, {"block": 7, "chunk": 10}):
        got = [tuple(r) for r in dimension_lloyd.cluster_vectors(table, **options).select(names).collect()]
        assert sorted(got, key=str) == brute_lloyd(rows)
    assert dimension_lloyd.cluster_vectors(table.limit(0)).count() == 0


def brute_ranking(docs, items, top):
    split = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(t):
        return split.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))

    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def test_tree_search_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rnd.choices(VOCABULARY, weights, k=rnd.randrange(1, 80)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(90)] + [(None, docs[5][1]), (3, docs[3][1]), (2000, None), (2001, " -\n"), (2002, "W1,w1 É é " * 40_000)]
    items = [(i, " ".join(rnd.choices(VOCABULARY, k=12))) for i in range(12)] + [(1, "w0 w1"), (None, "W7"), (50, None), (51, "--"), (52, "É"), (53, "nowhere"), (54, docs[5][1])]
    left = extra(spark.createDataFrame(docs, "doc_id long, text string"))
    right = extra(spark.createDataFrame(items, "item_id long, text string"))
    want = brute_ranking(docs, items, 50)
    names = ["item_id", "rank", "doc_id", "score"]
    for cells, terms, leaf, block in ((8_000_000, 4_000, 64, 100_000), (2_000, 20, 4, 60)):  # many small trees, several blocks
        for name, value in (("TREE_CELLS", cells), ("TREE_TERMS", terms), ("LEAF", leaf)):
            monkeypatch.setattr(fp_tree, name, value)
        got = [tuple(r) for r in fp_tree.rank_documents(left, right, block_terms=block).select(names).collect()]
        assert sorted(got, key=str) == want
    assert fp_tree.rank_documents(left.limit(0), right).count() == 0
    assert fp_tree.rank_documents(left, right.limit(0)).count() == 0
