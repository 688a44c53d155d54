import numpy as np
import pytest

from lightloom.llm import mixing
from lightloom.llm.mixing import flight, landing, mix, mix_report, plan_shares

DOCS = "doc_id long, text string, source string, n_tokens string, prob double"
TARGETS = "mix_name string, source string, target_share double, max_repeats int"


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    for size in (rng.lognormal(5, 1.5, 800), np.full(300, 7.0), np.array([1.0, 2.0]), np.zeros(0)):
        p = np.full(len(size), 0.3)
        q = flight(p, size, 1)
        assert np.isclose(q.sum(), p.sum()) and np.isclose((q * size).sum(), (p * size).sum())
        assert ((q > 0) & (q < 1)).sum() <= 2 and (q >= 0).all() and (q <= 1).all()


def test_flight_keeps_inclusion_probabilities():
    size = np.random.default_rng(1).lognormal(3, 1, 40)
    mean = np.mean([flight(np.full(40, 0.35), size, s) for s in range(1500)], axis=0)
    assert np.abs(mean - 0.35).max() < 0.06


def test_large_documents_are_decided_in_flight():
    rng = np.random.default_rng(2)
    size = np.sort(rng.lognormal(6, 1.5, 3000).round())[::-1]
    for seed in range(20):
        q = flight(np.full(3000, 0.4), size, seed)
        left = np.flatnonzero((q > 0) & (q < 1))
        assert len(left) <= 2 and (size[left] <= size[511]).all()
        done = landing(q, size, seed)
        assert set(np.unique(done)) <= {0.0, 1.0}
        assert abs((done * size).sum() - 0.4 * size.sum()) <= size[left].sum() and abs(done.sum() - 1200) <= 2


def test_whole_draw_keeps_inclusion_probabilities():
    size = np.sort(np.random.default_rng(4).lognormal(3, 1.5, 30))[::-1]
    prob = np.linspace(0.1, 0.9, 30)
    mean = np.mean([landing(flight(prob, size, s), size, s) for s in range(3000)], axis=0)
    assert np.abs(mean - prob).max() < 0.045


def test_landing_outcomes():
    size = np.array([10.0, 7.0, 3.0])
    mean = np.mean([landing(np.array([0.3, 0.6, 1.0]), size, s) for s in range(4000)], axis=0)
    assert np.abs(mean - [0.3, 0.6, 1.0]).max() < 0.03
    # Equal documents with probabilities of 1 in all: one of the two, never both or none.
    assert {landing(np.array([0.4, 0.6]), np.array([5.0, 5.0]), s).sum() for s in range(200)} == {1.0}
    assert landing(np.zeros(0), np.zeros(0), 1).size == 0


def test_few_documents_of_very_different_sizes_meet_the_tokens():
    size = np.sort(np.random.default_rng(5).lognormal(5, 1.2, 300).round())[::-1]
    goal = 0.06 * size.sum()
    size = size[size <= goal / 2]
    prob = np.full(len(size), goal / size.sum())
    draws = np.array([landing(flight(prob, size, s, leave=64), size, s) for s in range(400)])
    assert set(np.unique(draws)) <= {0.0, 1.0}
    off = np.abs(draws @ size / goal - 1)
    assert np.median(off) < 0.05 and off.mean() < 0.1
    assert abs(draws.mean() - prob[0]) < 0.01 and np.abs(draws.mean(axis=0) - prob).max() < 0.06


def docs(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "star " * int(rng.integers(1, 60)), "ab"[k % 2] if k % 10 else "small", "", 0.0) for k in range(600)]
    rows += rows[:20] + [(9000, None, "a", "", 0.0), (9001, "", "a", "", 0.0), (9002, "x", None, "", 0.0), (None, "x", "a", "", 0.0), (9003, "x", "other", "", 0.0)]
    return spark.createDataFrame(rows, DOCS)


def targets(spark):
    rows = [("m", "a", 0.5, 1), ("m", "b", 0.2, 1), ("m", "small", 0.2, 3), ("m", "none", 0.1, 2), ("n", "small", 1.0, 4), ("z", "none", 1.0, 4)]
    return spark.createDataFrame(rows + rows[:1], TARGETS)


@pytest.mark.parametrize("chunk", [20_000, 60])
def test_shares(spark, chunk, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    d, t = docs(spark), targets(spark)
    report = {(r["mix_name"], r["source"]): r for r in mix_report(d, t).collect()}
    assert len(report) == 6 and not report["m", "none"]["reachable"] and report["z", "none"]["actual_share"] == 0
    for s, share in (("a", 5 / 9), ("b", 2 / 9), ("small", 2 / 9)):
        assert abs(report["m", s]["actual_share"] - share) < 0.005
        assert report["m", s]["most_uses"] <= report["m", s]["max_repeats"]
    assert report["n", "small"]["uses"] == 4 * report["n", "small"]["n_docs"]
    drawn = [tuple(r) for r in mix(d, t).collect()]
    assert drawn and len({r[:3] for r in drawn}) == len(drawn) and not {r[2] for r in drawn} & {9000, 9001, 9002, 9003, None}
    assert sorted(drawn) == sorted(tuple(r) for r in mix(d, t).collect())


def test_size_and_empty(spark):
    d, t = docs(spark), targets(spark)
    got = {(r["mix_name"], r["source"]): r["tokens_used"] for r in mix_report(d, t, tokens=900).collect()}
    assert abs(sum(v for (m, _), v in got.items() if m == "m") - 900) < 60
    assert mix(d.limit(0), t).count() == 0 and mix(d, t.limit(0)).count() == 0 and mix_report(d.limit(0), t).count() == 6


def test_plan():
    rows = [{"mix_name": "m", "source": s, "target_share": w, "max_repeats": r} for s, w, r in (("a", 0.5, 1), ("b", 0.5, 2))]
    got = {t["source"]: t["uses"] for t in plan_shares({"a": (5, 1000), "b": (5, 100)}, rows)}
    assert got == {"a": 0.2, "b": 2.0}


def test_documents_larger_than_the_share(spark):
    """A source's giant is longer than all that a small mix takes of it: the others make up the share."""
    rows = [(k, "star " * 20, "a", "", 0.0) for k in range(400)] + [(999, "star " * 90_000, "a", "", 0.0)] + [(2000 + k, "star " * 20, "b", "", 0.0) for k in range(40)]
    t = spark.createDataFrame([("m", "a", 0.5, 1), ("m", "b", 0.5, 1)], TARGETS)
    report = {r["source"]: r for r in mix_report(spark.createDataFrame(rows, DOCS), t).collect()}
    assert abs(report["a"]["actual_share"] - 0.5) < 0.01 and report["a"]["docs_used"] == pytest.approx(40, abs=1)
