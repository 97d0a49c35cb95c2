"""Clustering by features and lists against brute force over all pairs."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import rows

from kindred.functions import lists
from kindred.operators import joins
from kindred.plans import mixed

SCHEMA = "id long, features array<double>, items array<long>, title string"


def gap(left, right, weight):
    one, other = set(left[1]), set(right[1])
    union = len(one | other)
    apart = 1 - len(one & other) / union if union else 0.0
    return (1 - weight) * np.mean((np.array(left[0]) - np.array(right[0])) ** 2) + weight * apart


def brute(points, k, seed, max_iters, weight):
    """Clusters, medoids and the history ``(clusters, delta, wsos)``; ``points`` are features and items by id."""
    order = sorted(points, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))
    medoids, history = dict(enumerate(order[:k])), []
    for _ in range(max_iters):
        placed = {i: min(medoids, key=lambda c: (gap(points[i], points[medoids[c]], weight), c)) for i in points}
        moved, error = {}, 0.0
        for c in sorted(set(placed.values())):
            members = [i for i in points if placed[i] == c]
            total = {i: sum(gap(points[i], points[j], weight) for j in members) for i in members}
            moved[c] = min(members, key=lambda i: (round(total[i] / len(members), 9), i))
            error += total[moved[c]]
        lost = len(moved) < len(medoids)
        delta = float("inf") if lost else sum(gap(points[medoids[c]], points[moved[c]], weight) for c in moved)
        history.append((len(moved), delta, error / len(points)))
        medoids = moved
        if delta <= 0:
            break
    return placed, medoids, history


def catalog(draw, n):
    """Points on a coarse grid (so that distances tie), with empty and null lists, repeats, and an item that most have."""
    table = []
    for i in range(n):
        items = None if i % 17 == 0 else [draw.randint(1, 12) + 100 * (i % 3) for _ in range(draw.randint(0, 8))]
        items = items if items is None or i % 5 == 0 else [*items, 7, None]
        table.append((i, [float(draw.randint(0, 3)), float(i % 3)], items, f"t{i}"))
    return table


@pytest.mark.parametrize("weight, iterations, model_bytes, candidates, hot_rows", [(0.5, 2, 64 << 20, 16, 100_000), (1.0, 1, 400, 1, 5)])
def test_runs_are_those_of_all_pairs(spark, monkeypatch, weight, iterations, model_bytes, candidates, hot_rows):
    monkeypatch.setattr(joins.join_counted, "__defaults__", (hot_rows,))
    table = catalog(random.Random(4), 90)
    found = mixed.cluster_with_lists(
        spark.createDataFrame(table, SCHEMA).repartition(3), 5, 3, iterations, weight=weight, model_bytes=model_bytes, candidates=candidates
    )
    points = {i: (x, {item for item in items or [] if item is not None}) for i, x, items, _ in table}
    placed, medoids, history = brute(points, 5, 3, iterations, weight)
    assert {r.id: r.cluster for r in found.assignments.collect()} == placed
    assert {r.cluster: r.id for r in found.centers.collect()} == medoids
    for row, want in zip(sorted(found.history.collect(), key=lambda r: r.iter), history, strict=True):
        assert (row.clusters, row.delta, row.wsos) == pytest.approx(want)
    for row in found.assignments.collect():
        assert row.title == f"t{row.id}" and row.distance == pytest.approx(gap(points[row.id], points[medoids[row.cluster]], weight))


def test_bounds_never_exceed_totals(spark):
    draw = random.Random(6)
    # One cluster of near copies, where bounds are loose, and one of unlike lists.
    table = [(i, [draw.random()], sorted(draw.sample(range(40), draw.choice([0, 3, 25, 30]))), i % 2) for i in range(80)]
    table = [(i, x, [1000 * i + item for item in items] if c else items, c) for i, x, items, c in table]
    assigned = spark.createDataFrame(table, "id long, features array<double>, items array<long>, cluster int")
    for weight in (0.0, 0.4, 1.0):
        for row in mixed.total_bounds(assigned, weight).collect():
            own = next(t for t in table if t[0] == row.id)
            total = sum(gap(own[1:3], t[1:3], weight) for t in table if t[3] == row.cluster)
            assert row.n == 40 and row.bound <= total
            # Unlike lists have next to nothing in common, so there the bound is the total.
            assert row.cluster == 0 or row.bound == pytest.approx(total, abs=1e-6)


def test_equal_points_have_the_lowest_id_as_medoid(spark):
    table = [(i, [1.0, 2.0], [3, 4], "t") for i in (9, 4, 6)] + [(20, [50.0, 1.0], [], "u")]
    found = mixed.cluster_with_lists(spark.createDataFrame(table, SCHEMA), 4, 1, 3)
    # Copies of a medoid lose their points to the one of the lowest number and go out.
    assert sorted(r.id for r in found.centers.collect()) == [4, 20]
    assert found.history.filter("iter = 1").first().delta == float("inf")
    assert rows(found.assignments, "distance") == [(0.0,)] * 4


def test_what_is_in_common(monkeypatch):
    draw = random.Random(2)
    some, others = ([sorted(draw.sample(range(30), draw.randint(0, 20))) for _ in range(n)] for n in (25, 7))
    flat = lambda listed: (np.array([x for part in listed for x in part], np.int64), np.cumsum([0, *map(len, listed)]))
    there = lists.targets(np.zeros((7, 1)), *flat(others))
    for meetings in (1 << 22, 5):
        monkeypatch.setattr(lists, "MEETINGS", meetings)
        assert lists.common(*flat(some), there).tolist() == [[len(set(a) & set(b)) for b in others] for a in some]
    column = pa.array([[9], [], [1, 2], [3]], pa.list_(pa.int64())).slice(1)
    items, offsets = lists.list_column(column)
    assert (items.tolist(), offsets.tolist()) == ([1, 2, 3], [0, 0, 2, 3])


@pytest.mark.parametrize("options", [{"weight": 1.5}, {"weight": -0.1}])
def test_unfit_settings(spark, options):
    with pytest.raises(ValueError):
        mixed.cluster_with_lists(spark.createDataFrame([(1, [1.0], [], "t")], SCHEMA), 1, 1, 1, **options)
    with pytest.raises(ValueError):
        mixed.cluster_with_lists(spark.createDataFrame([], SCHEMA), 1, 1, 1)


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_only_members_near_the_mean_are_bounded_where_lists_are_unlike(spark, monkeypatch, few):
    """Far members go out before lists are compared; with items that most lists have, all are bounded by counts."""
    monkeypatch.setattr(mixed, "FEW_MEETINGS", few)
    table = [(i, [float(i % 20)], [1000 * i, 1000 * i + 1], 0) for i in range(60)]
    for hot in (False, True):
        listed = [(i, x, [*items, 7] if hot else items, c) for i, x, items, c in table]
        assigned = spark.createDataFrame(listed, "id long, features array<double>, items array<long>, cluster int")
        most = mixed.most_lists(assigned)
        assert most == (60 if hot else 1)
        total = {i: sum(gap((x, items), (y, others), 0.5) for _, y, others, _ in listed) for i, x, items, _ in listed}
        bounds = {row.id: row.bound for row in mixed.medoid_bounds(assigned, 0.5, most).collect()}
        assert min(total, key=lambda i: (round(total[i] / 60, 9), i)) in bounds
        assert all(bound <= total[i] for i, bound in bounds.items())
        if not hot:
            # The totals of the others are beyond that of the member nearest to the mean; here the bound is the total.
            assert len(bounds) == 6 and all(bound == pytest.approx(total[i], rel=1e-10) for i, bound in bounds.items())
        elif few:
            assert all(bound == pytest.approx(total[i], rel=1e-10) for i, bound in bounds.items())


def test_runs_by_counts_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(mixed, "FEW_MEETINGS", 0)
    monkeypatch.setattr(joins.join_counted, "__defaults__", (5,))
    table = catalog(random.Random(4), 90)
    found = mixed.cluster_with_lists(spark.createDataFrame(table, SCHEMA).repartition(3), 5, 3, 1, candidates=2)
    points = {i: (x, {item for item in items or [] if item is not None}) for i, x, items, _ in table}
    placed, medoids, _ = brute(points, 5, 3, 1, 0.5)
    assert {r.id: r.cluster for r in found.assignments.collect()} == placed
    assert {r.cluster: r.id for r in found.centers.collect()} == medoids


def test_copies_of_the_best_member_take_no_further_pass(spark, monkeypatch):
    """Forty members with equal totals, of which a first pass compares two, and the lowest id."""
    passes, totals = [], mixed.exact_totals
    monkeypatch.setattr(mixed, "exact_totals", lambda *given: passes.append(1) or totals(*given))
    table = [(i, [0.5], [100 * i + j for j in range(i % 2, 5)], 0) for i in range(1, 81)]
    table += [(i, [i % 2 * 1.0], [100 * i], 0) for i in range(81, 121)]
    assigned = spark.createDataFrame(table, "id long, features array<double>, items array<long>, cluster int")
    best = mixed.mixed_medoids(assigned.repartition(3), 0.5, candidates=2).collect()
    assert [row.id for row in best] == [1] and len(passes) == 1


def test_ids_that_repeat_keep_their_bounds_below_totals(spark):
    table = [(i // 2, [i // 8 * 1.0], [i // 4, 50 + i // 2], 0) for i in range(24)]
    assigned = spark.createDataFrame(table, "id long, features array<double>, items array<long>, cluster int")
    bounds = mixed.medoid_bounds(assigned, 0.5, mixed.most_lists(assigned)).collect()
    total = {i: sum(gap((x, items), (y, others), 0.5) for _, y, others, _ in table) for i, x, items, _ in table}
    assert bounds and all(row.bound <= total[row.id] for row in bounds)
