"""Results recomputed in plain Python: lattices by all segmentations, posteriors by loops over documents,
and documents with repeated, null or string ids."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import bucket_refinement, chat_format, lattice, line_blocks, line_frequency, site_quality

SF = "/root/testdata/sf0.001"


def _segmentations(raw, pieces):
    """All ways to cut ``raw`` into pieces."""
    if not raw:
        yield []
    for k in range(1, len(raw) + 1):
        if raw[:k] in pieces:
            for rest in _segmentations(raw[k:], pieces):
                yield [raw[:k], *rest]


WORDS = ["a", "the", "token", "zebras", "don't", "naïve", "漢字", "\U0001f600", "x1y2", "ooooo"]


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.pieces(lattice.default_vocabulary())


def test_marginals_are_sums_over_segmentations(vocabulary):
    number = {p: i for i, p in enumerate(vocabulary.pieces)}
    texts = [b" " + w.encode() for w in WORDS]
    rnd = np.random.default_rng(5)
    for weight in (vocabulary.prior, np.log(rnd.dirichlet(np.ones(len(number))))):
        got = lattice.marginals(texts, vocabulary, weight)
        counts = np.zeros(len(number))
        for text, found in zip(texts, got):
            ways = [[number[p] for p in s] for s in _segmentations(text, number)]
            probability = [math.exp(sum(weight[p] for p in way)) for way in ways]
            assert len(ways) > 1 and math.isclose(math.exp(found), sum(probability), rel_tol=1e-9)
            for way, p in zip(ways, probability):
                for piece in way:
                    counts[piece] += p / sum(probability)
        assert np.allclose(lattice.expected(texts, vocabulary, weight), counts, atol=1e-9)


def test_document_scores_by_enumeration(spark, vocabulary):
    rows = [(i, " ".join(WORDS[(i * k) % len(WORDS)] for k in range(1, 2 + i % 5))) for i in range(40)] + [(40, None), (41, "Only\tHERE\n")]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    tokens = {d: [w.encode().lower().decode() for w in (t or "").split()] for d, t in rows}
    seen = Counter(w for d, _ in rows if not held[d] for w in tokens[d])
    ends = sum(not h for h in held.values())
    n, v = sum(seen.values()) + ends, len(seen) + 1
    number = {p: i for i, p in enumerate(vocabulary.pieces)}

    weight = vocabulary.prior
    for _ in range(lattice.ROUNDS):  # expected counts over the distinct training words
        counts = np.full(len(number), 0.01)
        for w in seen:
            ways = [[number[p] for p in s] for s in _segmentations(b" " + w.encode(), number)]
            probability = [math.exp(sum(weight[p] for p in way)) for way in ways]
            for way, p in zip(ways, probability):
                for piece in way:
                    counts[piece] += p / sum(probability)
        weight = np.log(counts / counts.sum())
    once, twice = (sum(c == k for c in seen.values()) for k in (1, 2))
    discount = min(0.95, max(0.1, once / (once + 2 * twice) if once else 0.5))

    def base(c):
        return math.log10((c + 0.1) / (n + 0.1 * (v + 1)))

    def model(w):
        ways = [[number[p] for p in s] for s in _segmentations(b" " + w.encode(), number)]
        own = sum(math.exp(sum(weight[p] for p in way)) for way in ways)
        return math.log10(max(seen[w] - discount, 0) / n + discount * len(seen) / n * own)

    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lattice.lattice_scores(df, frequent=3).collect()}
    for d, _ in rows:
        r = got[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d], len(tokens[d]) + 1, n)
        assert r.n_known == 1 + sum(w in seen for w in tokens[d])
        assert math.isclose(r.base_score, base(ends) + sum(base(seen[w]) for w in tokens[d]), rel_tol=1e-9)
        assert math.isclose(r.score, math.log10(ends / n) + sum(model(w) for w in tokens[d]), rel_tol=1e-9)
    assert len(got) == len(rows) and any(held.values())


def _posteriors(rows):
    """Host posterior, path posterior and score of every (host, path, good), by loops."""
    least = site_quality.LEAST

    def strength(groups):  # (documents, mean, prior mean)
        scale = sum(n * p * (1 - p) for n, _, p in groups)
        if not scale:
            return 1.0
        between = (sum(n * (m - p) ** 2 for n, m, p in groups) - sum(p * (1 - p) for _, _, p in groups)) / scale
        return min(1e4, max(1.0, 1 / between if between > 0 else 1e4))

    def cut(x):
        return max(least, min(1 - least, x))

    hosts, paths = defaultdict(list), defaultdict(list)
    for h, p, g in rows:
        hosts[h].append(g)
        paths[h, p].append(g)
    mean = sum(g for _, _, g in rows) / len(rows)
    s = strength([(len(x), sum(x) / len(x), mean) for x in hosts.values()])
    host = {h: (sum(x) + s * mean) / (len(x) + s) for h, x in hosts.items()}
    t = strength([(len(x), sum(x) / len(x), host[h]) for (h, _), x in paths.items()])
    out = []
    for h, p, g in rows:
        own = paths[h, p]
        path = cut((sum(own) - g + t * host[h]) / (len(own) - 1 + t))
        odds = g / (1 - g) * path / (1 - path) / (cut(mean) / (1 - cut(mean)))
        out.append((host[h], path, odds / (1 + odds)))
    return out


def test_site_posteriors_by_loops(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source"))).withColumn("lang", F.when(F.col("doc_id") % 11 > 0, F.col("lang")))
    got = site_quality.site_quality(docs.union(docs.limit(3)), labels).collect()
    assert len(got) == docs.count() + 3 and {r.host for r in got} >= {None} and {r.kept for r in got} == {True, False}
    for r, (host, path, score) in zip(got, _posteriors([(r.host, r.path, r.doc_score) for r in got])):
        assert math.isclose(r.host_posterior, host, rel_tol=1e-9) and math.isclose(r.path_posterior, path, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-9) and r.kept == (round(score, 9) >= 0.5)


def test_site_ties_are_kept(spark):
    """Without labels all evidence is a half, and so are all scores."""
    rows = [(i, "text", f"h{i % 3}", None) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.kept) for r in site_quality.site_quality(docs, labels).collect()} == {(0.5, True)}


def test_line_frequency_counts_documents_not_rows(spark):
    rows = [(1, "one line\nanother", "h")] * 12 + [(None, "no name", "h")] * 12 + [(i, f"shared\nown line of {chr(97 + i)} only", "h") for i in range(2, 13)]
    rows += [(None, f"nameless\n{chr(97 + i)} is its own and long", "h") for i in range(11)]
    found = line_frequency.line_frequency(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    lost = {(r.doc_id, r.n_removed_chars) for r in found}
    assert lost == {(1, 0), (None, 0), (None, len("nameless"))} | {(i, len("shared")) for i in range(2, 13)}


def _brute_spans(texts):
    """What is left of each text, in order, without the bytes of windows that start earlier."""
    seen, out = set(), []
    for raw in texts:
        cover = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                cover[p : p + 100] = b"\x01" * 100
            seen.add(raw[p : p + 100])
        out.append(bytes(x for x, c in zip(raw, cover) if not c))
    return out


def test_spans_of_documents_with_any_ids(spark):
    part = " ".join(f"part{i}" for i in range(40))
    rows = [("b", "first " + part), ("a", part + " second"), (None, "head " + part + " tail"), ("b10", part), ("b9", "x" * 99 + part[:150]), ("a", part + " second")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id string, text string, doc string")
    got = {(r.doc_id, r.n_bytes): bytes(r.kept) for r in bucket_refinement.remove_repeated_spans(df).collect()}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or ""))
    want = _brute_spans([t.encode() for _, t in order])
    assert got == {(d, len(t)): k for (d, t), k in zip(order, want)}
    assert sum(k == t.encode() for (_, t), k in zip(order, want)) == 1


def test_spans_of_several_texts_under_one_id(spark):
    part = " ".join(f"part{i}" for i in range(40))
    rows = [(1, "one " + part), (1, "two " + part), (None, part + " three"), (2, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    order = [(r.doc_id, r.text or "") for r in df.orderBy("doc_id", "h").collect()]
    want = sorted(_brute_spans([t.encode() for _, t in order]))
    assert sorted(bytes(r.kept) for r in bucket_refinement.remove_repeated_spans(df.drop("h")).collect()) == want


def _numbered(turns):
    return "".join(f"[{i}:{r}:{t}]" for i, (r, t) in enumerate(turns))


def _dated(turns):
    """Turns look alike until the text ``late`` has been said."""
    late = [t for _, t in turns].index("late") if ("user", "late") in turns else len(turns)
    return "".join(f"[{r}:{t}{'!' if i > late else ''}]" for i, (r, t) in enumerate(turns))


def test_broken_promises_of_templates(spark):
    _numbered.turn_local = _dated.turn_local = True
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(30)]
    state = chat_format.TurnSpans(_numbered)
    assert "".join(state.add(t) for t in turns) == _numbered(turns) and not state.rewrites
    turns[20] = ("user", "late")
    state = chat_format.TurnSpans(_dated)
    for t in turns[:21]:
        state.add(t)
    assert not state.rewrites
    state.add(turns[21])
    assert state.rewrites


def test_surges_and_dives_by_windows():
    """A line is kept if a window of three lines with it weighs enough; weightless ends go."""
    rnd = random.Random(4)
    for _ in range(2000):
        weights = [rnd.choice([0, 0, 5, 20, 39, 40, 90]) for _ in range(rnd.randrange(25))]
        high = {k for i in range(-2, len(weights)) if sum(weights[max(0, i) : i + 3]) >= 40 for k in range(max(0, i), min(i + 3, len(weights)))}
        want = {k for k in high if weights[k]}
        got = [(a, b) for a, b in line_blocks.stretches(weights)]
        assert {k for a, b in got for k in range(a, b) if weights[k]} == want
        assert all(weights[a] and weights[b - 1] and set(range(a, b)) <= high for a, b in got)


def test_names_inside_articles_are_read_whole():
    page = (
        '<article><h2 class="section-header">Head</h2><div class="related-work">Work</div><p class="notice-of-award">Award</p>'
        '<div class="social-share">share</div><div class="ad-slot">ad</div><div id="post-comments">said</div></article>'
        '<div class="site-footer wide">foot</div><div class="main-nav">nav</div>'
    )
    assert line_blocks.main_text(page) == "Head Work Award"


def test_long_page():
    text = "word and word. " * 200_000
    assert line_blocks.main_text(f"<nav>n</nav><p>{text}</p><ul>" + "<li><a href=x>link</a>" * 20_000) == text.strip()


def test_windows_find_articles_without_marks(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet").collect()]
    same = sum(line_blocks.main_text(p) == line_blocks.main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", p)) for p in pages)
    assert same >= 0.95 * len(pages)
