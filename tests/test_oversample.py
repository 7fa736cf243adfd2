"""Over-sampling: equal class sizes, synthetic rows between real neighbours, dense places and odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from shoplens.operators import oversample as o

COLS = ["x", "y"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, label STRING, x DOUBLE, y DOUBLE, extra STRING")


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    found = [(i, "big", draw.gauss(0, 1), draw.gauss(0, 1), "e") for i in range(2_000)]
    # Two clumps far apart, and a third of the class at one place.
    found += [(10_000 + i, "small", draw.gauss(50 * (i % 2), 1), draw.gauss(0, 9), None) for i in range(400)]
    found += [(20_000 + i, "small", 7.0, 7.0, None) for i in range(200)]
    return found


def test_class_sizes_come_out_equal(spark, rows):
    odd = [(None, "small", 1.0, 1.0, ""), (1, "small", None, 1.0, ""), (2, "small", float("nan"), 1.0, ""), (3, None, 1.0, 1.0, ""), (4, "other", 1.0, 1.0, "")]
    df = o.oversampled(frame(spark, rows + odd), "label", "id", COLS, ("big", "small"))
    counts = Counter((r.label, r.synthetic) for r in df.collect())
    assert counts == {("big", False): 2_000, ("small", False): 603, ("small", True): 1_397}


def test_synthetic_rows_lie_between_two_real_neighbours(spark, rows):
    df = frame(spark, rows)
    at = {r[0]: r for r in rows}
    made = o.smote(df, "label", "id", COLS, ("big", "small")).collect()
    assert sorted(map(str, made)) == sorted(map(str, o.smote(df.repartition(5), "label", "id", COLS, ("big", "small")).collect()))
    seeds, moved = Counter(), 0
    for r in made:
        a, b = at[r.seed_key], at[r.other_key]
        assert a[1] == b[1] == r.label == "small" and 0 <= r.part < 1
        for i, c in ((2, "x"), (3, "y")):
            assert r[c] == pytest.approx(a[i] + r.part * (b[i] - a[i]), abs=1e-9)
            assert min(a[i], b[i]) - 1e-9 <= r[c] <= max(a[i], b[i]) + 1e-9
        moved += r.seed_key != r.other_key
        seeds[r.seed_key] += 1
    assert set(seeds) == {k for k, r in at.items() if r[1] == "small"} and set(seeds.values()) == {2, 3}
    assert moved > 0.95 * len(made)


def test_neighbours_are_near(spark, rows):
    small = [r for r in rows if r[1] == "small"]
    near = {r.key: r.near for r in o.neighbours(frame(spark, small), "label", "id", COLS).collect()}
    spread = [math.sqrt(sum((r[i] - sum(q[i] for q in small) / len(small)) ** 2 for r in small) / len(small)) for i in (2, 3)]

    at = {r[0]: r for r in small}

    def apart(a, b):
        return sum(((a[i] - b[i]) / s) ** 2 for i, s in zip((2, 3), spread))

    n = found = 0
    for r in small:
        own = [m.distance for m in near.get(r[0], [])]
        assert own == sorted(own) and len({m.key for m in near.get(r[0], [])}) == len(own) and r[0] not in {m.key for m in near.get(r[0], [])}
        assert own == pytest.approx([apart(r, at[m.key]) for m in near.get(r[0], [])])
        n, found = n + len(own), found + sum(own)
    # Two rows of a class are 4 apart on average (squared, two columns in units of their spread).
    assert n > 0.95 * o.NEIGHBOURS * len(small) and found / n < 0.02 * 4


def test_groups_stay_small(spark, rows, monkeypatch):
    """A third of the class at one place makes many groups: no neighbour list came from more than a bounded one."""
    same = [(i, "small", 7.0, 7.0, None) for i in range(3_000)] + [(9_000 + i, "big", 1.0, 1.0, None) for i in range(3_500)]
    made = o.smote(frame(spark, same), "label", "id", COLS, ("big", "small")).collect()
    assert len(made) == 500 and {(r.x, r.y) for r in made} == {(7.0, 7.0)}


def test_little(spark):
    empty = frame(spark, [])
    assert o.smote(empty, "label", "id", COLS, ("big", "small")).collect() == []
    alone = frame(spark, [(1, "small", 1.0, 2.0, "")] + [(i, "big", 1.0, 1.0, "") for i in range(10, 14)])
    made = o.smote(alone, "label", "id", COLS, ("big", "small")).collect()
    assert [(r.seed_key, r.other_key, r.x, r.y) for r in made] == [(1, 1, 1.0, 2.0)] * 3
    equal = frame(spark, [(1, "small", 1.0, 2.0, ""), (2, "big", 1.0, 2.0, "")])
    assert o.smote(equal, "label", "id", COLS, ("big", "small")).collect() == []


def test_numbers_in_two_levels(spark):
    from pyspark.sql import functions as F

    df = spark.range(5_000).selectExpr("id", "id % 3 AS g")
    found = defaultdict(list)
    for r in o.numbered(df, o.hash_unit("id", seed=4), ["g"], "id").withColumn("p", o.hash_unit(F.col("id"), seed=4)).collect():
        found[r.g].append((r["rank"], r.p, r.id))
    for own in found.values():
        assert [x[0] for x in sorted(own, key=lambda x: x[1:])] == list(range(len(own)))
