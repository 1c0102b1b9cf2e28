"""Oversampling of a minority class by interpolation between exact nearest neighbours.

Equal points are searched once. Distinct points are dealt to cells around pivots, which
are drawn by hash and drawn again where a cell is too large. A point finds an upper bound
on the distance of its k-th neighbour inside its own cell; it is then copied to those cells
only that may hold a nearer one, by the distance to the pivot and the radius of the cell.
The bounds leave a margin for rounding, and all distances that count are computed from
differences, so the result is that of comparing all pairs.

A cell that many points visit, or that holds many rows, is searched in parts: a task sees
about ``GROUP`` visitors and ``GROUP`` rows at a time, however large the table is, and gives
back only what lies within the visitor's bound.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.columns import hash_fraction_key
from patronage.operators.ranking import running_totals
from patronage.session import stage

CELL = 500  # distinct points wanted in a cell
MOST_PIVOTS = 8192
REFINEMENTS = 6
GROUP = 4000  # visitors, and rows of a cell, that are compared at a time
PAIRS = 1 << 19  # distances held at a time
_NEAR = "array<struct<distance:double,id:bigint,features:array<double>>>"


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of every row of ``a`` to every row of ``b``, from differences."""
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        total += (a[:, i, None] - b[None, :, i]) ** 2
    return np.sqrt(total)


def _blocks(rows: int, columns: int) -> range:
    """Starts of blocks of rows with ``PAIRS`` distances to ``columns`` points."""
    return range(0, rows, _height(columns))


def _height(columns: int) -> int:
    return max(1, PAIRS // max(1, columns))


def _dealt(sent):
    """(cell, distance to its pivot) of every point."""

    def run(frames):
        pivots = sent.value
        for frame in frames:
            found = []
            for low in _blocks(len(frame), len(pivots)):
                distance = _distances(_matrix(frame["features"].iloc[low : low + _height(len(pivots))]), pivots)
                cell = distance.argmin(axis=1)
                found.append((cell, distance[np.arange(len(cell)), cell]))
            cell, away = (np.concatenate([f[i] for f in found] or [np.zeros(0)]) for i in (0, 1))
            yield frame.assign(cell=cell.astype("int64"), away=away.astype("float64"))

    return run


def _pivoted(points: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Points with their cells, the pivots, and the radius of every cell."""
    spark = points.sparkSession
    n = points.count()
    wanted = min(MOST_PIVOTS, -(-n // CELL))
    # The first by a hash of the id: a bounded number of rows on the driver.
    order = hash_fraction_key("point")
    pivots = _matrix(points.orderBy(order, "point").limit(wanted).select("features").toPandas()["features"])
    for _ in range(REFINEMENTS):
        schema = "point bigint, features array<double>, cell bigint, away double"
        dealt = stage(points.mapInPandas(_dealt(spark.sparkContext.broadcast(pivots)), schema), "cells")
        sizes = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).toPandas()
        large = sizes[(sizes["n"] > 4 * CELL) & (sizes["radius"] > 0)]
        if not len(large) or len(pivots) >= MOST_PIVOTS:
            break
        more = dict(zip(large["cell"].tolist(), (-(-large["n"] // CELL)).tolist()))
        places = F.create_map(*[F.lit(v) for pair in more.items() for v in pair])
        first = Window.partitionBy("cell").orderBy(hash_fraction_key("point"), "point")
        added = (
            dealt.where(F.col("cell").isin(list(more)))
            .withColumn("_place", F.row_number().over(first))
            .where((F.col("_place") <= places[F.col("cell")]) & (F.col("_place") <= CELL))
            .limit(MOST_PIVOTS - len(pivots))
        )
        new = _matrix(added.select("features").toPandas()["features"])
        pivots = np.unique(np.concatenate([pivots, new]), axis=0)
    radius = np.full(len(pivots), -np.inf)  # a cell without points
    radius[sizes["cell"].to_numpy(dtype=np.int64)] = sizes["radius"].to_numpy()
    return dealt, pivots, radius


def _margin(points: np.ndarray) -> np.ndarray:
    return 1e-9 * (1 + np.abs(points).sum(axis=1))


def _bounds(k: int, sent):
    """Per point of a part of a cell: an upper bound on the distance of its k-th neighbour,
    and the cells to search, its own among them."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        pivots, radius = sent.value
        points, weight = _matrix(frame["features"]), frame["copies"].to_numpy()
        widest = max(len(points), len(pivots))
        bounds, cells = [], []
        for low in _blocks(len(points), widest):
            own = points[low : low + _height(widest)]
            distance = _distances(own, points)
            if len(points) > k + 1:  # every point counts once at least
                order = np.argpartition(distance, k, axis=1)[:, : k + 1]
            else:
                order = np.broadcast_to(np.arange(len(points)), distance.shape)
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(distance, order, axis=1), axis=1), axis=1)
            reached = np.cumsum(weight[order], axis=1) >= k + 1
            at = np.where(reached.any(axis=1), reached.argmax(axis=1), -1)
            rows = np.arange(len(own))
            bound = np.where(at >= 0, distance[rows, order[rows, at]], np.inf)
            away = _distances(own, pivots)
            if len(pivots) > k:  # pivots are points themselves
                bound = np.minimum(bound, np.partition(away, k, axis=1)[:, k])
            near = away - radius <= (bound + _margin(own))[:, None]
            bounds.append(bound)
            cells += [np.flatnonzero(row) for row in near]
        return pd.DataFrame(
            {"point": frame["point"], "features": frame["features"], "bound": np.concatenate(bounds), "cells": cells}
        )

    return run


def _searched(k: int):
    """The best ``k`` + 1 rows within its bound for every point that visits rows of a cell."""

    def run(key, visits: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        found = {"point": [], "distance": [], "id": [], "features": []}
        if len(members) and len(visits):
            there, ids = _matrix(members["features"]), members["id"].to_numpy()
            by_id = np.argsort(ids, kind="stable")
            there, ids = there[by_id], ids[by_id]
            height = _height(len(there))
            for low in _blocks(len(visits), len(there)):
                own = visits.iloc[low : low + height]
                distance = _distances(_matrix(own["features"]), there)
                row, at = np.nonzero(~(distance > own["bound"].to_numpy()[:, None]))
                away = distance[row, at]
                order = np.lexsort((at, away, row))
                row, at, away = row[order], at[order], away[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) <= k  # place within the visitor's rows
                row, at, away = row[best], at[best], away[best]
                found["point"].append(own["point"].to_numpy()[row])
                found["distance"].append(away)
                found["id"].append(ids[at])
                found["features"] += list(there[at])
        for name in ("point", "distance", "id"):
            found[name] = np.concatenate(found[name]) if found[name] else []
        found["features"] = pd.Series(found["features"], dtype=object)  # also where nothing is near
        return pd.DataFrame(found)

    return run


def _parts(rows: DataFrame, most: int, name: str) -> DataFrame:
    """(cell, ``name``): the number of parts of about ``most`` rows; a row per pivot at most."""
    return rows.groupBy("cell").agg(F.ceil(F.count("*") / most).cast("int").alias(name))


def _part(identity: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(identity), F.col(parts)).cast("int")


def nearest_neighbours(points: DataFrame, k: int) -> DataFrame:
    """(id, features, neighbours): for every row the ``k`` nearest others by Euclidean
    distance, ties by id, as structs (distance, id, features); fewer if there are fewer.

    ``points`` has ``id`` (unique bigint) and ``features`` (arrays of one length without
    nulls); rows without either are left out. Of equal points the ``k`` + 1 of least id
    are enough for everybody, so a point that a third of all rows share is no hot spot:
    the row limit is applied in every partition before the shuffle.
    """
    usable = points.where(F.col("id").isNotNull() & F.col("features").isNotNull()).select("id", "features")
    usable = stage(usable, "minority")
    first = Window.partitionBy("features").orderBy("id")
    few = usable.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= k + 1)
    few = stage(few, "representatives")
    distinct = few.where("_place = 1").select(F.col("id").alias("point"), "features")
    if distinct.isEmpty():
        return usable.withColumn("neighbours", F.array().cast(_NEAR))
    dealt, pivots, radius = _pivoted(distinct)
    sent = usable.sparkSession.sparkContext.broadcast((pivots, radius))
    placed = stage(dealt.join(few, "features").select("cell", "point", "features", "id"), "members")
    counted = placed.groupBy("cell", "point", "features").agg(F.count("*").alias("copies"))
    counted = counted.join(F.broadcast(_parts(dealt, 4 * CELL, "parts")), "cell")
    visits = counted.groupBy("cell", _part("point", "parts")).applyInPandas(
        _bounds(k, sent), "point bigint, features array<double>, bound double, cells array<bigint>"
    )
    visits = stage(visits, "visits")
    visitors = visits.select(F.explode("cells").alias("cell"))
    cut = F.broadcast(_parts(visitors, GROUP, "parts").join(_parts(placed, GROUP, "pieces"), "cell"))
    # Each part of a cell's visitors meets each piece of its rows.
    visits = (
        visits.select("point", "features", "bound", F.explode("cells").alias("cell"))
        .join(cut, "cell")
        .withColumn("part", _part("point", "parts"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("cell", "part", "piece", "point", "features", "bound")
    )
    members = (
        placed.join(cut, "cell")
        .withColumn("piece", _part("id", "pieces"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("cell", "part", "piece", "id", "features")
    )
    by = ["cell", "part", "piece"]
    schema = "point bigint, distance double, id bigint, features array<double>"
    found = visits.groupBy(*by).cogroup(members.groupBy(*by)).applyInPandas(_searched(k), schema)
    merged = found.groupBy("point").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("distance", "id", "features"))), 1, k + 1).alias("near")
    )
    merged = merged.join(distinct, "point").select("features", "near")
    others = F.filter("near", lambda n: n["id"] != F.col("id"))
    return usable.join(merged, "features").select("id", "features", F.slice(others, 1, k).alias("neighbours"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)) / float(1 << 53)


def oversample(
    rows: DataFrame, seed: int = 42, k: int = 5, identity: str = "id", features: str = "features", label: str = "label"
) -> DataFrame:
    """(id, features, label, synthetic): all rows, and as many new ones of the smaller of
    the two classes 0 and 1 as make both equal in number.

    A new row lies between a row of the minority and one of its ``k`` nearest neighbours,
    at a share drawn from a hash of the row, its number and ``seed``; every minority row
    is used as often as any other, but for a rest by a hash of the id. ``id`` of a new row
    is that of the row it comes from. With one minority row or none, or equal classes,
    nothing is added. Rows without label or features are left out.
    """
    known = rows.select(F.col(identity).cast("bigint").alias("id"), F.col(features).alias("features"), F.col(label).cast("int").alias("label"))
    known = stage(known.where("label in (0, 1) and features is not null and id is not null"), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    everything = known.withColumn("synthetic", F.lit(False))
    small = min((0, 1), key=lambda c: (counts.get(c, 0), c))
    have, missing = counts.get(small, 0), counts.get(1 - small, 0) - counts.get(small, 0)
    if have < 2 or not missing:
        return everything
    minority = nearest_neighbours(known.where(F.col("label") == small), k)
    keyed = stage(minority.withColumn("_order", hash_fraction_key("id")), "neighbours")
    ranked = running_totals(keyed.select("id", "_order"), "_order", tie="id", rank="_rank").select("id", "_rank")
    each, rest = divmod(missing, have)
    times = F.lit(each) + (F.col("_rank") <= rest).cast("int")
    # Two levels of numbers, so that no array is longer than about the root of their count.
    width = max(1, int((each + 1) ** 0.5))
    outer = F.sequence(F.lit(0), F.floor((times - 1) / width).cast("int"))
    inner = F.sequence(F.lit(0), F.least(F.lit(width - 1), times - 1 - F.col("_outer") * width).cast("int"))
    made = (
        keyed.join(ranked, "id")
        .where(times > 0)
        .withColumn("_outer", F.explode(outer))
        .withColumn("_inner", F.explode(inner))
        .withColumn("_number", F.col("_outer") * width + F.col("_inner"))
    )
    chosen = F.floor(_uniform("id", "_number", F.lit(seed), F.lit("neighbour")) * F.size("neighbours")).cast("int")
    share = _uniform("id", "_number", F.lit(seed), F.lit("share"))
    made = made.select(
        "id", "features", share.alias("_share"), F.get("neighbours", chosen)["features"].alias("_other")
    )
    between = F.zip_with("features", "_other", lambda a, b: a + F.col("_share") * (b - a))
    new = made.select("id", between.alias("features"), F.lit(small).alias("label"), F.lit(True).alias("synthetic"))
    return everything.unionByName(new)
