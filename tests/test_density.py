"""Density segments and components against brute force; point-in-time features against a loop."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from shoplens.ml import density
from shoplens.operators.graph import connected
from shoplens.operators.history import point_in_time_features


def brute(rows, eps, min_points):
    """(key, values) -> {key: (segment, is_core)} by all pairs."""
    near = {k: [q for q, y in rows if sum((a / eps - b / eps) ** 2 for a, b in zip(x, y)) <= 1] for k, x in rows}
    core = {k for k in near if len(near[k]) >= min_points}
    label = {k: k for k in core}
    changed = True
    while changed:
        changed = False
        for k in core:
            low = min(label[q] for q in near[k] if q in core)
            changed |= low < label[k]
            label[k] = low
    return {k: (label[k] if k in core else min((label[q] for q in near[k] if q in core), default=None), k in core) for k in near}


def clumps(n, d, seed):
    draw = random.Random(seed)
    centres = [[draw.uniform(-4, 4) for _ in range(d)] for _ in range(6)]
    rows = [(i, [c + draw.gauss(0, 0.3 if i % 3 else 0.9) for c in centres[i % 6]]) for i in range(n)]
    # Equal points, a chain at exactly eps, and far ones.
    rows += [(10_000 + i, [5.0] * d) for i in range(40)] + [(20_000 + i, [0.25 * i, *[9.0] * (d - 1)]) for i in range(12)]
    return rows + [(30_000 + i, [100.0 + 7 * i] * d) for i in range(3)]


@pytest.mark.parametrize(("d", "min_points"), [(2, 4), (2, 12), (3, 5)])
def test_segments_are_those_of_all_pairs(spark, d, min_points):
    rows = clumps(500, d, seed=d)
    cols = "abc"[:d]
    df = spark.createDataFrame([(k, *x) for k, x in rows], f"id BIGINT, {', '.join(f'{c} DOUBLE' for c in cols)}")
    found = {r.id: (r.segment, r.is_core) for r in density.dbscan(df, "id", list(cols), 0.25, min_points).collect()}
    assert found == brute(rows, 0.25, min_points)
    assert len({s for s, _ in found.values()}) > 3 and any(s is None for s, _ in found.values())


def test_odd_rows_and_dense_places(spark):
    schema = "id BIGINT, a DOUBLE, b DOUBLE"
    odd = [(None, 0.0, 0.0), (1, None, 0.0), (2, float("nan"), 0.0)]
    dense = [(100 + i, 1.0, 1.0) for i in range(3_000)]
    found = density.dbscan(spark.createDataFrame(odd + dense + [(50, 1.2, 1.0), (7, 3.0, 3.0)], schema), "id", ["a", "b"], 0.25, 10)
    rows = {r.id: (r.segment, r.is_core) for r in found.collect()}
    # One of the dense place's neighbours has it within reach and is core, too: it names the segment.
    assert len(rows) == 3_002 and rows[7] == (None, False) and rows[50] == (50, True) and rows[2_000] == (50, True)
    assert density.dbscan(spark.createDataFrame([], schema), "id", ["a", "b"], 1.0, 3).collect() == []


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(1_000 + i, 1_001 + i) for i in range(60)] + [(2_000, 2_001 + i) for i in range(50)]
    nodes = sorted({x for e in edges for x in e} | {5_000})
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = connected(spark.createDataFrame([(n,) for n in nodes], "node BIGINT"), spark.createDataFrame(edges, "a BIGINT, b BIGINT"))
    assert {r.node: r.label for r in found.collect()} == label


def test_only_strictly_earlier_orders_are_known(spark):
    draw, start = random.Random(2), datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        at = start + timedelta(hours=draw.randrange(400) * 3) if i % 40 else None
        rows.append((i, draw.randrange(5) if i % 3 else 7, at, draw.choice(["Success", "Failed", "Pending"]), draw.choice([None, 1.5, 20.25])))
    rows.append((999, None, start, "Success", 1.0))
    df = spark.createDataFrame(rows, "booking_id INT, customer_id INT, created_at TIMESTAMP_NTZ, payment_status STRING, total_amount DOUBLE")
    found = {r.booking_id: r for r in point_in_time_features(df).collect()}
    usable = [r for r in rows if r[1] is not None and r[2] is not None]
    assert set(found) == {r[0] for r in usable}
    for key, customer, at, *_ in usable:
        prior = [r for r in usable if r[1] == customer and r[2] < at]
        r = found[key]
        assert r.prior_orders == len(prior)
        assert r.prior_spend == pytest.approx(sum(p[4] or 0 for p in prior if p[3] == "Success"))
        assert r.days_since_previous == ((at.date() - max(p[2] for p in prior).date()).days if prior else None)
        share = sum(p[3] == "Failed" for p in prior) / len(prior) if prior else None
        assert r.prior_failure_share == (pytest.approx(share) if prior else None)
