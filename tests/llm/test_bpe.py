import random
import tracemalloc
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docflow.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def same(library, texts):
    own = bpe.bpe(bpe.default_vocabulary())
    for t, ids in zip(texts, own.encode_batch(texts)):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, repr(t[:80])
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_special_and_odd_texts(library):
    same(library, ["", " ", "a", "aaaa" * 50, "it's we'll I'D 'sx", "x<|endoftext|>Y <|startoftext|>", "<|endoftext|",
                   "ΣΣ OΣ", "İI", "é ﬁ ẛ̣", "a b c\u0085d\x1ce",
                   "\U0001f600\U0001f468‍\U0001f469", "12 345.6", "\x00\x01", "กำ", "z" * 20000])


def test_every_assigned_character(library):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    same(library, ["a" + "b ".join(chars[i:i + 64]) + "c" for i in range(0, len(chars), 64)])


def test_random_texts(library):
    rnd = random.Random(1)
    pool = "abcdefghe ntionrs'éßñ1!| \n"
    same(library, ["".join(rnd.choice(pool) for _ in range(rnd.randrange(200))) for _ in range(500)])


def test_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = bpe.encode_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == want


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a", "x"), (1, None, "y"), (2, "", "z"), (2, "b b", None), (2, "b b", None)],
        "doc_id long, text string, ids string",
    )
    got = sorted((r.doc_id is None, r.doc_id or 0, len(r.ids), r.decoded) for r in bpe.encode_documents(docs).collect())
    assert got == [(False, 1, 0, ""), (False, 2, 0, ""), (False, 2, 8, "b</w> b</w>"), (False, 2, 8, "b</w> b</w>"),
                   (True, 0, 4, "a</w>")]
    assert bpe.encode_documents(docs.where(F.lit(False))).count() == 0


def test_a_frame_of_new_words_needs_little_memory(spark):
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(1250)) for _ in range(100)]
    model = bpe.bpe(bpe.default_vocabulary())
    model.known = {}
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    tracemalloc.start()
    try:
        n = sum(len(f) for f in bpe._encoder(bpe.default_vocabulary())(iter([frame])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    known = sum(len(w) + 150 for w in model.known)
    assert n == len(texts) and peak - known < 60e6
