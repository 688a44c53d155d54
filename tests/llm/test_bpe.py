"""Encoding against the public libraries, and on untidy texts."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lightloom.llm.bpe import Encoder, encode_corpus, merge, rank_file

E = Encoder(rank_file())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(rank_file().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


ODD = ["", " ", "\n\n", "a\r\nb", "<|endoftext|>", "it's they'll WE'VE 'tis", "é é", "観測した。次に", "👩‍🚀🔭", "x" * 5000, "ab" * 3000, " " * 2000,
       "1234567890" * 300, "\x00\x1c\x1d\x85\xa0　 x", "ß²½Ⅷ٣", "\U0001d7d9\U0001d400 a", "naïve—co-op…", "\t\tfoo()  {bar}\n", "日本語" * 700]


def test_odd_texts(library):
    assert [E.encode(x) for x in ODD] == library(ODD)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    from tokenizers import Tokenizer

    global T
    if "T" not in globals():
        T = Tokenizer.from_file(rank_file().replace(".tiktoken", ".json"))
        T.encode_special_tokens = True
    assert E.encode(text) == T.encode(text, add_special_tokens=False).ids
    assert "".join(E.cut(text)) == text


def brute(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if best[0] == 1 << 40:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_tree_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        piece = "".join(rng.choice("abcdeinrst ¤é") for _ in range(rng.randint(1, 90))).encode()
        assert merge(piece, E.ranks) == brute(piece, E.ranks)


def test_corpus(spark, library):
    rows = [(i, x, 7) for i, x in enumerate(ODD)] + [(98, None, 7), (None, "null id", 7), (3, "a\r\nb", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = [(r["doc_id"], r["ids"]) for r in encode_corpus(df).collect()]
    want = library([r[1] or "" for r in rows])
    assert sorted(got, key=str) == sorted(((r[0], w) for r, w in zip(rows, want)), key=str)
    counts = encode_corpus(df, lists=False)
    assert sorted(r["n_tokens"] for r in counts.collect()) == sorted(map(len, want))
    assert encode_corpus(df.limit(0)).count() == 0


def test_real_documents(spark, data, library):
    df = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(df).collect()}
    keys = list(texts)
    assert [got[k] for k in keys] == library([texts[k] for k in keys])
