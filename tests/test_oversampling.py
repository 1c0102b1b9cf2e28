from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.operators import oversampling
from patronage.operators.oversampling import nearest_neighbours, oversample
from patronage.operators.splitting import exact_split

SCHEMA = "id bigint, features array<double>, label int"


def brute(points, k):
    """Neighbour ids of every point by comparing all pairs."""
    out = {}
    for i, v in points:
        away = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in points if j != i)
        out[i] = [j for _, j in away[:k]]
    return out


def neighbours(df, k=5):
    return {r.id: [n.id for n in r.neighbours] for r in nearest_neighbours(df, k).collect()}


def frame(spark, points):
    rows = [(i, [float(x) for x in v], 1) for i, v in points]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(oversampling, "CELL", 60)
    rng = np.random.default_rng(2)
    crowd = rng.normal(0, 1, (900, 4)) * [1, 5, 0.1, 100]
    far = rng.normal(50, 0.01, (550, 4))  # a crowded corner, to be divided again
    grid = rng.integers(0, 3, (350, 4))  # many ties
    same = np.tile([7.0, 7, 7, 7], (200, 1))  # one point that many rows share
    points = list(enumerate(np.concatenate([crowd, far, grid, same]).tolist()))
    assert neighbours(frame(spark, points)) == brute(points, 5)


def test_no_task_sees_all_visitors_of_a_cell(spark, monkeypatch):
    most = 100
    monkeypatch.setattr(oversampling, "CELL", 60)
    monkeypatch.setattr(oversampling, "GROUP", most, raising=False)
    real = oversampling._searched

    def counted(k):
        run = real(k)

        def checked(key, visits, members):
            sizes = len(visits), len(members)
            found = run(key, visits, members)
            if max(sizes) > 2 * most or len(found) > (k + 1) * 2 * most:
                raise ValueError(f"{sizes} rows in one group")
            return found

        return checked

    monkeypatch.setattr(oversampling, "_searched", counted)
    rng = np.random.default_rng(5)
    crowd = rng.normal(0, 1, (1500, 4))  # all in the middle of everything: most cells are visited by most
    wide = rng.normal(0, 40, (100, 4))  # few points with large cells around the crowd
    same = np.repeat(rng.normal(0, 1, (30, 4)), 6, axis=0)  # up to six rows of a point count
    points = list(enumerate(np.concatenate([crowd, wide, same]).tolist()))
    assert neighbours(frame(spark, points)) == brute(points, 5)


def test_search_in_blocks_keeps_what_is_within_the_bound(monkeypatch):
    monkeypatch.setattr(oversampling, "PAIRS", 64)
    rng = np.random.default_rng(6)
    there = rng.integers(0, 4, (50, 3)).astype(float)  # many ties
    members = pd.DataFrame({"id": rng.permutation(50), "features": list(there)})
    own = rng.integers(0, 4, (30, 3)).astype(float)
    bound = np.where(np.arange(30) % 3 == 0, np.inf, 1.5)
    visits = pd.DataFrame({"point": np.arange(30) + 100, "features": list(own), "bound": bound})
    found = oversampling._searched(4)((), visits, members)
    assert {len(f) for f in found["features"]} == {3}
    for i in range(30):
        away = np.sqrt(((there - own[i]) ** 2).sum(axis=1))
        want = sorted((d, j) for d, j in zip(away, members["id"]) if d <= bound[i])[:5]
        rows = found[found["point"] == 100 + i]
        assert list(zip(rows["distance"], rows["id"])) == want
    far = visits.assign(bound=-1.0)
    assert len(oversampling._searched(4)((), far, members)) == 0
    assert oversampling._searched(4)((), far, members)["features"].dtype == object


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_points(spark, n):
    points = [(10 * i, [i * i, 1]) for i in range(n)]
    assert neighbours(frame(spark, points)) == brute(points, 5)


def test_classes_become_equal(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(i % 10 == 0, 1, 3).tolist(), int(i % 10 == 0)) for i in range(1003)]
    rows += [(5000, None, 1), (5001, [1.0, 2.0, 3.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = oversample(df.repartition(2)).collect()
    counts = {c: sum(r.label == c for r in once) for c in (0, 1)}
    assert counts == {0: 902, 1: 902}
    assert sum(r.synthetic for r in once) == 902 - 101
    again = oversample(df.repartition(7)).collect()
    assert sorted(map(str, once)) == sorted(map(str, again))
    assert sorted(map(str, once)) != sorted(map(str, oversample(df, seed=1).collect()))
    # Every new row lies on a line from its source to one of the source's neighbours.
    given = {r[0]: np.array(r[1]) for r in rows[:1003] if r[2] == 1}
    near = brute([(i, v) for i, v in given.items()], 5)
    times = {}
    for r in once:
        if r.synthetic:
            times[r.id] = times.get(r.id, 0) + 1
            new, source = np.array(r.features), given[r.id]
            on = [np.linalg.norm(np.cross(given[j] - source, new - source)) for j in near[r.id]]
            assert min(on) < 1e-9
    assert max(times.values()) - min(times.values()) <= 1 and len(times) == 101


def test_nothing_to_add(spark):
    even = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1)], SCHEMA)
    assert oversample(even).where("synthetic").count() == 0
    single = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [1.0], 1)], SCHEMA)
    assert oversample(single).count() == 3
    assert oversample(even.limit(0)).count() == 0


def test_split_is_exact_and_stable(spark):
    df = spark.range(1007).select(F.col("id").alias("CustomerID"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    found = exact_split(df.repartition(3), "CustomerID", 0.2, "label").collect()
    tested = {c: sum(r.is_test for r in found if r.label == c) for c in (0, 1)}
    assert len(found) == 1007 and tested == {0: round(863 * 0.2), 1: round(144 * 0.2)}
    again = exact_split(df.repartition(11), "CustomerID", 0.2, "label").collect()
    assert {r.CustomerID for r in found if r.is_test} == {r.CustomerID for r in again if r.is_test}
    whole = exact_split(df, "CustomerID", 0.2).where("is_test").count()
    assert whole == 201 and exact_split(df.limit(0), "CustomerID", 0.2, "label").count() == 0
