"""Cases that operators used to leave out."""
import random

import pandas as pd
from pyspark.sql import functions as F

from docflow.llm import chat_format, line_blocks, paragraphs, passages, probminhash, site_quality
from test_operators import _classes, _shingles

SF = "/root/testdata/sf0.001"


def test_lines_of_five_words_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    lines = {(r.doc_id, i): p for r in rows for i, p in enumerate((r.text or "").split("\n")) if len(p.split()) >= 5}
    found = _classes({k: _shingles(p) for k, p in lines.items()})
    repeated = {k for k, c in found.items() if k != c}
    want, block = {k for k in repeated if len(lines[k].split()) >= 20}, []
    for r in rows:  # blocks of repeated lines on end, blank ones aside, of 20 words and more
        for i, p in [*enumerate((r.text or "").split("\n")), (-1, "end")]:
            if (r.doc_id, i) in repeated:
                block.append((r.doc_id, i))
            elif p.split():
                want.update(block if sum(len(lines[k].split()) for k in block) >= 20 else [])
                block = []
    got = paragraphs.op3_paragraph_minhash(spark, SF).collect()
    assert {(r.doc_id, i) for r in got for i in (*r.removed_places, *r.removed_short)} == want
    assert {(r.doc_id, i) for r in got for i in r.removed_short} == {k for k in want if len(lines[k].split()) < 20}
    assert any(r.removed_short for r in got)


def test_wrapped_text(spark):
    text = "\n".join(" ".join(f"w{13 * k + i}" for i in range(13)) for k in range(6))
    df = spark.createDataFrame([(1, text), (2, "own words of the second\n" + text), (3, "a b c d\na b c d")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.removed_short) for r in paragraphs.remove_repeated(df).collect()}
    assert got == {1: (text, []), 2: ("own words of the second", list(range(1, 7))), 3: ("a b c d\na b c d", [])}


def test_short_lines_go_with_blocks_only(spark):
    alone, pair = "one line of seven words that recurs", ["these eleven words make one half of a block of lines", "\tand these ten words make up its other half here"]
    rows = [(1, "\n".join([alone, "x", *pair])), (2, "\n".join(["own", alone, "own", pair[0], " ", pair[1], "z"])), (2, "\n".join(["own", alone, "own", pair[0], " ", pair[1], "z"])), (3, pair[0]), (None, alone)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text, tuple(r.removed_short)) for r in paragraphs.remove_repeated(df).collect()}
    assert got == {(1, rows[0][1], ()), (2, f"own\n{alone}\nown\n \nz", (3, 5)), (3, pair[0], ()), (None, alone, ())}


def _brute_passages(texts):
    """Words removed from each text (id, words), by comparing all windows of 50 words in order."""
    first, gone = {}, {k: set() for k, _ in texts}
    for k, words in texts:
        for i in range(len(words) - 49):
            window = tuple(words[i : i + 50])
            d, p = first.setdefault(window, (k, i))
            if d != k or i >= p + 50:
                gone[k].update(range(i, i + 50))
    return gone


def test_passages_match_brute_force(spark):
    rnd = random.Random(3)
    pool = [f"v{i}" for i in range(400)]
    shared = [[rnd.choice(pool) for _ in range(n)] for n in (49, 50, 51, 86, 200)]
    texts = []
    for k in range(40):
        words = []
        for _ in range(rnd.randrange(1, 5)):
            words += [rnd.choice(pool) for _ in range(rnd.randrange(120))]
            part = rnd.choice(shared)
            a = rnd.choice([0, 0, rnd.randrange(len(part))])
            words += part[a:]
        texts.append((k, words))
    texts += [(40, ["X"] * 200), (41, ["x"] * 120), (42, []), (43, ["q"] * 49)]
    rows = [(k, "".join(w + rnd.choice(" \n") for w in words), k) for k, words in texts] + [(44, None, 0), (40, " ".join(["X"] * 200), 1)]
    df = spark.createDataFrame(rows, "row_id long, text string, other long").withColumn("row_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    got = {(r.row_id, r.other): r for r in passages.remove_passages(df).collect()}
    assert len(got) == len(rows)
    want = _brute_passages([(k, [w.lower() for w in words]) for k, words in texts])
    for k, words in texts:
        if k == 40:
            continue  # two rows with one id: which text is first is for the hash
        r = got[k, k]
        assert {i for a, b in r.removed_passages for i in range(a, b + 1)} == want[k], k
        assert r.text.split() == [w for i, w in enumerate(words) if i not in want[k]]
    assert any(want.values()) and got[44, 0].text is None
    assert sorted(len((got[40, o].text or "").split()) for o in (40, 1)) == [0, 50]


def test_passage_inside_other_lines(spark):
    def own(tag):
        return " ".join(f"{tag}{i}" for i in range(60))

    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, f"{own('a')} {passage} {own('b')}"), (2, f"{own('c')} {passage} {own('d')}")], "doc_id long, text string")
    got = {r.doc_id: r for r in paragraphs.remove_repeated(df).collect()}
    assert got[1].text.count("p59") == 1 and got[1].removed_passages == []
    assert got[2].text == f"{own('c')} {own('d')}" and got[2].removed_passages == [[60, 119]]


def test_copy_with_a_repeated_line_is_a_candidate():
    texts = []
    for k in range(20):
        words = [f"d{k}w{i}" for i in range(204)]
        texts += [" ".join(words), " ".join(words[:100] + words[80:100] * 49 + words[100:])]
    frame = pd.DataFrame({"doc_id": [str(i) for i in range(40)], "text_hash": range(40), "text": texts})
    bands = next(probminhash._signed(iter([frame])))["bands"]
    assert all(any(x == y for x, y in zip(bands[i], bands[i + 1])) for i in range(0, 40, 2))
    assert not any(x == y for x, y in zip(bands[0], bands[2]))


def _numbered(turns):  # the first turn must be a user's; shows the system turn and the number of each
    assert turns[0][0] == "user"
    return "".join(f"[{turns[0][1]}:{i}:{r}:{t}]" for i, (r, t) in enumerate(turns))


def _late_rewrite(turns):  # drops the thoughts of all turns but the last two
    return "".join(f"[{r}:{t if i >= len(turns) - 2 else t.split('#')[-1]}]" for i, (r, t) in enumerate(turns))


def test_templates_get_true_prefixes():
    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(21)]
    state = chat_format.TurnSpans(_numbered)
    assert "".join(state.add(t) for t in turns) == _numbered(turns) and not state.rewrites
    turns = [(r, f"think#{t}" if i == 6 else t) for i, (r, t) in enumerate(turns)]
    state, seen = chat_format.TurnSpans(_late_rewrite), []
    for t in turns:
        state.add(t)
        seen.append(state.rewrites)
    assert seen == [i >= 8 for i in range(21)]


def test_pages_without_marked_article():
    long = "A sentence of the text that is long enough to count."
    menu = '<ul class="menu"><li>m</li><li>n</li><li>o</li><li>p</li></ul>'
    page = f"<body><p>Hello you</p>{menu}<h1>Title</h1><p>{long * 20}</p><p>Bye.</p>{menu}<p>{long}</p>{menu}<div>Site map</div></body>"
    assert line_blocks.main_text(page) == f"Title {long * 20} Bye. {long}"
    assert line_blocks.main_text("<body><p>short</p></body>") == "short"
    assert line_blocks.stretches([30, 0, 0, 0, 50, 0, 0, 0, 12]) == [(4, 5)]


def test_attributes_are_parsed_by_name():
    long = "A sentence of the text that is long enough to count."
    for mark in ('title="hidden gems"', 'aria-hidden="false"', 'data-id="menu"', "data-x='class=ad'"):
        assert line_blocks.main_text(f"<div {mark}><p>{long}</p></div>") == long, mark
    for mark in ("hidden", 'HIDDEN=""', "class=ad", 'id="x" class="big ad"', "role = 'menu'"):
        assert line_blocks.main_text(f"<div {mark}><p>{long}</p></div>") == "", mark


def test_training_rows_are_joined_in_all_tasks(spark, monkeypatch):
    plans, write = [], site_quality.stored

    def keep(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(site_quality, "stored", keep)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    site_quality.train(docs, labels)
    plan = dict(plans)["training"]
    assert f"Repartition {site_quality.TRAINING_TASKS}, true" in plan and f"Repartition {site_quality.TRAINING_TASKS}, false" not in plan
