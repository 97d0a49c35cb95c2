"""Centers: drawing the first ones, moving them, and measuring the move and the error.

These are plain table operators, right for any number of clusters. The iteration in
``plans.clustering`` works out the same sums inside its passes while the centers are few enough
to broadcast.
"""

from __future__ import annotations

from functools import reduce
from math import sqrt
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.vectors import squared_distance
from kindred.operators.ordering import row_numbers
from kindred.schema import NAME_NOT_FOUND, NAME_SYNTHETIC
from kindred.session import materialize

# Places that the rows of one cluster or one vector are dealt to in a join.
SALTS = 16
_DRAW_RANGE = 16**32  # an MD5 digest has 32 hexadecimal places
# Centers of all seeds together up to which a draw is sorted by a window; beyond, no task holds a seed.
_WINDOW_ROWS = 100_000


def initial_centers(points: DataFrame, runs: list, total: int | None = None) -> DataFrame:
    """``k`` distinct points for each run, drawn by its seed: ``(run_id, cluster, id, center)``.

    The draw takes the points whose ``md5(seed|id)`` is least, numbered in that order, so it does
    not depend on how the points are partitioned. With fewer than ``k`` points all are taken.
    ``runs`` are rows with ``run_id``, ``k`` and ``seed``.
    """
    spark = points.sparkSession
    total = points.count() if total is None else total
    wanted: dict[int, int] = {}
    for run in runs:
        wanted[run["seed"]] = max(run["k"], wanted.get(run["seed"], 0))

    drawn = materialize(_draw(points, wanted, {seed: _limit(k, total) for seed, k in wanted.items()}), "draw")
    counts = {row["seed"]: row["count"] for row in drawn.groupBy("seed").count().collect()}
    short = {seed: k for seed, k in wanted.items() if counts.get(seed, 0) < min(k, total)}
    if short:
        # The digests below the limit were too few (a rare draw): take all points for those seeds.
        kept = drawn.filter(~F.col("seed").isin(list(short)))
        drawn = materialize(kept.unionByName(_draw(points, short, dict.fromkeys(short))), "draw")

    asked = spark.createDataFrame([(r["run_id"], r["k"], r["seed"]) for r in runs], "run_id int, k int, seed int")
    return (
        drawn.join(F.broadcast(asked), "seed")
        .filter(F.col("place") < F.col("k"))
        .select("run_id", F.col("place").alias("cluster"), "id", F.col("features").alias("center"))
    )


def _limit(k: int, total: int) -> str | None:
    """A digest that about ``k`` of ``total`` evenly spread ones are sure to fall below."""
    share = (k + 8 * sqrt(k) + 32) / max(total, 1)
    return None if share >= 1 else format(int(share * _DRAW_RANGE), "032x")


def _digest(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("id").cast("string")))


def _draw(points: DataFrame, wanted: dict[int, int], limits: dict[int, str | None]) -> DataFrame:
    """The first ``k`` points by digest for each seed, in one pass.

    Only digests below a seed's limit go on, so the shuffle and the sort hold about ``k``
    rows for a seed rather than all points.
    """

    def below(seed: int) -> Column:
        return F.lit(True) if limits[seed] is None else _digest(seed) <= F.lit(limits[seed])

    draws = F.array(
        *[F.struct(F.lit(seed).alias("seed"), F.lit(k).alias("k"), _digest(seed).alias("digest"), below(seed).alias("kept"))
          for seed, k in wanted.items()]
    )
    drawn = (
        points.filter(reduce(or_, [below(seed) for seed in wanted]))
        .select("id", "features", F.inline(draws))
        .filter("kept")
    )
    placed = _numbered(drawn) if sum(wanted.values()) > _WINDOW_ROWS else _sorted(drawn)
    return placed.filter(F.col("place") < F.col("k")).select("seed", "place", "id", "features")


def _sorted(drawn: DataFrame) -> DataFrame:
    """Places by seed, each seed's rows in one task: for draws of a bounded size."""
    order = Window.partitionBy("seed").orderBy("digest", "id")
    return drawn.withColumn("place", F.row_number().over(order) - 1)


def _numbered(drawn: DataFrame) -> DataFrame:
    """Places by seed from ranges of digests: a row's number less that of the first row of its seed."""
    numbered = row_numbers(drawn, ["seed", "digest", "id"], "_row")
    first = numbered.groupBy("seed").agg(F.min("_row").alias("_first"))
    # One row for each seed.
    return numbered.join(F.broadcast(first), "seed").withColumn("place", (F.col("_row") - F.col("_first")).cast("int"))


def cluster_means(assigned: DataFrame, dims: int) -> DataFrame:
    """Mean of each dimension over each cluster: ``(run_id, cluster, n, sse, center)``.

    ``sse`` is the sum of the ``distance`` column, the squared error about the deciding centers.
    """
    means = [F.avg(F.get("features", F.lit(i))).alias(f"m{i}") for i in range(dims)]
    return (
        assigned.groupBy("run_id", "cluster")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("sse"), *means)
        .select("run_id", "cluster", "n", "sse", F.array(*[f"m{i}" for i in range(dims)]).alias("center"))
    )


def cluster_medoids(assigned: DataFrame, means: DataFrame, before: DataFrame) -> DataFrame:
    """Member of each cluster with the least total squared distance to the others: ``(run_id, cluster, n, id, center)``.

    The total is ``n |x - mean|^2`` plus what does not depend on ``x``, so the member nearest to
    the mean is the one: one aggregate instead of all pairs. Distances count in units of the
    cluster's mean squared error to nine places, so ties up to rounding go to the lowest id; that error
    follows from ``means`` and the centers ``before``, which decided. A cluster's members are dealt to
    ``SALTS`` places, and the best of those is taken.
    """
    was = before.select("run_id", "cluster", F.col("center").alias("was"))
    about = F.greatest(F.col("sse") - F.col("n") * squared_distance(F.col("center"), F.col("was")), F.lit(0.0))
    spread = about / F.col("n")
    targets = means.join(was, ["run_id", "cluster"]).select(
        "run_id", "cluster", "n", F.col("center").alias("mean"), F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("unit")
    )
    keys = ["run_id", "cluster", "_salt"]
    gap = F.rint(squared_distance(F.col("features"), F.col("mean")) / F.col("unit") * 1e9)
    best = lambda places: F.min_by(F.struct("id", "features", "n", "gap"), F.struct("gap", "id")).alias(places)
    return (
        _salted(assigned, "id")
        .join(_for_each_salt(targets), keys)
        .withColumn("gap", gap)
        .groupBy(*keys)
        .agg(best("one"))
        .select("run_id", "cluster", "one.*")
        .groupBy("run_id", "cluster")
        .agg(best("best"))
        .select("run_id", "cluster", "best.n", "best.id", F.col("best.features").alias("center"))
    )


def _salted(rows: DataFrame, key: str) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))


def _for_each_salt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def lost_clusters(before: DataFrame, after: DataFrame) -> DataFrame:
    """Clusters of ``before`` that got no points and so are not in ``after``."""
    return before.join(after, ["run_id", "cluster"], "left_anti").select("run_id", "cluster")


def center_shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Total squared movement of the centers of each run; infinite where a cluster was lost."""
    moved = after.select("run_id", "cluster", F.col("center").alias("moved_to"))
    step = F.when(F.col("moved_to").isNull(), F.lit(float("inf"))).otherwise(
        squared_distance(F.col("center"), F.col("moved_to"))
    )
    return before.join(moved, ["run_id", "cluster"], "left").groupBy("run_id").agg(F.sum(step).alias("delta"))


def mean_error(assigned: DataFrame, centers: DataFrame) -> DataFrame:
    """Mean squared distance of points to the centers of their clusters, by run: ``(run_id, wsos)``.

    Pass the updated centers with the assignments that led to them.
    """
    targets = centers.select("run_id", "cluster", "center")
    distance = squared_distance(F.col("features"), F.col("center"))
    return assigned.join(targets, ["run_id", "cluster"]).groupBy("run_id").agg(F.avg(distance).alias("wsos"))


def error_after_move(before: DataFrame, means: DataFrame, after: DataFrame) -> DataFrame:
    """The same as :func:`mean_error`, from tables of one row per cluster instead of the points.

    The squared error about any place is that about the mean plus ``n`` times the squared
    distance between the two.
    """
    places = [before.select("run_id", "cluster", F.col("center").alias("was")),
              after.select("run_id", "cluster", F.col("center").alias("now"))]
    joined = means.join(places[0], ["run_id", "cluster"]).join(places[1], ["run_id", "cluster"])
    about_mean = F.greatest(F.col("sse") - F.col("n") * squared_distance(F.col("center"), F.col("was")), F.lit(0.0))
    error = about_mean + F.col("n") * squared_distance(F.col("center"), F.col("now"))
    return joined.groupBy("run_id").agg((F.sum(error) / F.sum("n")).alias("wsos"))


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    """Points in each cluster. A clustering's ``centers`` have the same as ``n``, without a pass."""
    return assignments.groupBy("run_id", "cluster").agg(F.count(F.lit(1)).alias("size"))


def name_centers(centers: DataFrame, points: DataFrame | None) -> DataFrame:
    """Title and artist of the song at each center: the one with the lowest id among equals.

    Centers that are no song's point are named not found; with ``points=None`` no names are
    looked up and all are called synthetic. Points are not shuffled while the centers are small
    enough for Spark to broadcast.
    """
    if points is None:
        return centers.withColumns({"title": F.lit(NAME_SYNTHETIC), "artist": F.lit(NAME_SYNTHETIC)})
    sought = centers.select(F.col("center").alias("features")).distinct()
    first = F.min_by(F.struct("title", "artist", "id"), F.col("id"))
    found = (
        _salted(points.select("id", "title", "artist", "features"), "id")
        .join(_for_each_salt(sought), ["features", "_salt"])
        .groupBy("features", "_salt")
        .agg(first.alias("one"))
        .select("features", "one.*")
        .groupBy("features")
        .agg(first.alias("song"))
    )
    named = centers.join(found, centers["center"] == found["features"], "left")
    return named.select(
        *[centers[name] for name in centers.columns],
        F.coalesce("song.title", F.lit(NAME_NOT_FOUND)).alias("title"),
        F.coalesce("song.artist", F.lit(NAME_NOT_FOUND)).alias("artist"),
    )
