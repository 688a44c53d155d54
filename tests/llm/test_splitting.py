import pytest

from lightloom.llm.bpe import encoder, rank_file
from lightloom.llm.splitting import oversized, split

PARAGRAPH = "The seeing was poor. We closed the dome at two, and opened again.\nThe flat field drifted; see the plot.\n\n"
TEXTS = {1: PARAGRAPH * 60, 2: "x" * 9000, 3: "観測した。次に、進む。" * 300, 4: "word " * 3000, 5: "short", 6: "", 7: None, 8: "👩‍🚀" * 900, 9: "\n" * 5000, 10: "ab" * 4000 + " " + "end. " * 500,
         11: "no,breaks;here:" * 400, 12: " " * 4000}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, v, 5) for k, v in TEXTS.items()] + [(5, "short", 5), (None, "y" * 9000, 5)], "doc_id long, text string, piece int")


def test_pieces(docs):
    get, by = encoder(rank_file()), {}
    for r in split(docs, 256, 16).collect():
        by.setdefault(r["doc_id"], []).append(r)
    long = {k for k, v in TEXTS.items() if v and len(get.encode(v)) > 256}
    assert set(by) == long | {None}
    for k in long:
        ids, rows = get.encode(TEXTS[k]), sorted(by[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(rows[0]["n_pieces"]))
        joined, before = [], []
        for r in rows:
            assert r["n_tokens"] == len(r["ids"]) <= 256 and r["n_overlap"] == (16 if r["piece"] else 0)
            assert r["ids"][: r["n_overlap"]] == before[len(before) - r["n_overlap"] :]
            assert r["start"] == len(joined)
            joined += r["ids"][r["n_overlap"] :]
            before = r["ids"]
        assert joined == ids
        assert b"".join(get.table[t] for t in joined).decode() == TEXTS[k]


def test_cuts_are_natural(docs):
    get = encoder(rank_file())
    own = {}
    for r in split(docs, 256, 16).collect():
        own.setdefault(r["doc_id"], []).append((r["piece"], b"".join(get.table[t] for t in r["ids"][r["n_overlap"] :])))
    text = lambda k: [b.decode() for _, b in sorted(own[k])]
    assert all(p.endswith("\n\n") for p in text(1))
    assert all(p.endswith("。") for p in text(3))
    assert all(p.strip() and not p.startswith("ord") for p in text(4))
    assert len(text(2)) > 3 and all(p for p in text(8))  # cut between characters


def test_found_and_options(docs, spark):
    get = encoder(rank_file())
    want = {k for k, v in TEXTS.items() if v and len(get.encode(v)) > 1024}
    got = [r["doc_id"] for r in oversized(docs).collect()]
    assert set(got) - {None} == want and len(got) == len(set(got))
    everything = split(docs, short=True).select("doc_id").distinct().count()
    assert everything == len([v for v in TEXTS.values() if v]) + 1
    assert split(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        split(docs, 100, 60)


@pytest.mark.parametrize("limit, overlap", [(8, 2), (8, 0), (32, 8), (40, 0), (64, 31)])
def test_small_limits(spark, limit, overlap):
    get = encoder(rank_file())
    texts = {1: "a" * 200, 2: PARAGRAPH * 3, 3: "👩‍🚀" * 60, 4: "観測した。" * 30, 5: "=" * 500, 6: " \n" * 90}
    by = {}
    for r in split(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), limit, overlap).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {k for k, v in texts.items() if len(get.encode(v)) > limit} >= {2, 3, 4, 6}
    for k, rows in by.items():
        rows.sort(key=lambda r: r["piece"])
        assert all(r["n_tokens"] <= limit for r in rows)
        assert [t for r in rows for t in r["ids"][r["n_overlap"] :]] == get.encode(texts[k])


def test_texts_are_not_damaged(docs):
    for r in split(docs, 256, 16).collect():
        assert r["text"] in (TEXTS.get(r["doc_id"]) or "y" * 9000) and "\ufffd" not in r["text"]
