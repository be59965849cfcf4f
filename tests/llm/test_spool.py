"""Intermediate tables go when they are read, and only then."""

from __future__ import annotations

import os

from hoptrail.llm import workers
from hoptrail.llm.components import components
from hoptrail.llm.spool import discard, passing, spool


def where(table):
    return table._spooled_at.removeprefix("file:")


def test_tables_made_inside_go_unless_kept(spark):
    outside = spool(spark.range(3))
    with passing() as outer:
        first = spool(spark.range(5))
        with passing() as inner:
            second, third = spool(spark.range(7)), spool(spark.range(9))
            inner.append(third)
        assert not os.path.exists(where(second)) and third.count() == 9
        outer.append(first)
    assert not os.path.exists(where(third))
    assert first.count() == 5 and outside.count() == 3
    discard(first, outside)
    assert not os.path.exists(where(first))


def test_tables_go_when_a_step_fails(spark):
    made = []
    try:
        with passing():
            made.append(spool(spark.range(2)))
            raise KeyError("x")
    except KeyError:
        pass
    assert not os.path.exists(where(made[0]))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 150)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components(df).collect()}
    expected = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {150: 150, 200: 150}
    assert found == expected
    assert components(df.limit(0)).count() == 0


def test_a_worker_holds_one_thing():
    made = []
    make = lambda x: lambda: made.append(x) or x
    assert [workers.held("a", make(1)), workers.held("a", make(2)), workers.held("b", make(3)), workers.held("a", make(4))] == [1, 1, 3, 4]
    workers.forget()
    assert workers.held("a", make(5)) == 5 and made == [1, 3, 4, 5]
