import datetime as dt

import pytest

from lightloom.operators.orphans import Parent, asks_of, orphans, review_orphans


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def test_review_orphans(spark):
    objects = spark.createDataFrame(
        [(1, day(0), None, "a"), (2, day(0), day(9), "a"), (3, day(50), None, "a"), (None, day(0), None, "a"), (4, day(0), None, "a"), (4, day(9), None, "b")],
        "obj_id long, loaded_at timestamp, removed_at timestamp, saved_at string",
    )
    nights = spark.createDataFrame([(10, day(0), None), (11, day(40), None)], "night_id int, loaded_at timestamp, removed_at timestamp")
    reviews = spark.createDataFrame(
        [(1, 1, 10, day(5)), (1, 1, 10, day(5)), (2, 2, None, day(35)), (3, 3, 11, day(5)), (4, None, None, day(5)), (5, 99, 98, day(5)), (5, 99, 98, day(5)), (6, 4, 10, None)],
        "review_id long, obj_id long, night_id int, saved_at timestamp",
    )
    got = sorted(tuple(r) for r in review_orphans(reviews, objects, nights).collect())
    assert got == [
        (2, "obj_id", "2020-02"), (3, "night_id", "2020-01"), (3, "obj_id", "2020-01"), (5, "night_id", "2020-01"), (5, "obj_id", "2020-01"),
    ]
    assert review_orphans(reviews.limit(0), objects, nights).count() == 0
    assert review_orphans(reviews, objects.limit(0), nights.limit(0)).count() == 9


def test_match_semantics(spark):
    parent = spark.createDataFrame([(1, 1, 0), (2, 2, 0), (None, 3, 0)], "x int, y int, k0 int")
    refs = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, None), (4, 9, None), (5, None, 2), (6, None, 9), (7, None, None), (2, 1, 2)], "id int, a int, b int")

    def run(match):
        return {(r["ref_id"], r["mask"], r["part"]) for r in orphans(refs, "id", ("a", "b"), (Parent(parent, ("x", "y")),), match).collect()}

    assert run("simple") == {(2, "xx", "a+b")}
    assert run("partial") == {(2, "xx", "a+b"), (4, "x-", "a"), (6, "-x", "b")}
    assert run("full") == {(2, "xx", "a+b"), (3, "x-", "a"), (4, "x-", "a"), (5, "-x", "b"), (6, "-x", "b")}
    with pytest.raises(ValueError):
        run("other")
    with pytest.raises(ValueError):
        orphans(refs, "id", ("a", "b"), (Parent(parent, ("x",)),))


def test_every_mask_meets_its_own_columns_in_one_join(spark):
    parent = spark.createDataFrame([(1, 1), (2, 2)], "x int, y int")
    refs = spark.createDataFrame([(1, 1, 2), (2, 1, None), (3, None, 9)], "id int, a int, b int")
    sides = (Parent(parent.select("x"), ("x",)), Parent(parent.select("y"), ("y",)))
    for match, parents in (("each", sides), ("partial", (Parent(parent, ("x", "y")),))):
        plan = orphans(refs, "id", ("a", "b"), parents, match)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftAnti") == 1
    assert [(a.mask, a.part) for a in asks_of(("a", "b"), "each")[0]] == [("xx", "a"), ("xx", "b"), ("x-", "a"), ("-x", "b")]
    assert [(a.mask, a.part) for a in asks_of(("a", "b"), "partial")[0]] == [("xx", "a+b"), ("x-", "a"), ("-x", "b")]
    assert {tuple(r)[:3] for r in orphans(refs, "id", ("a", "b"), sides).collect()} == {(3, "-x", "b")}
