"""K-medoids under a distance that mixes features with lists, such as the playlists that a song is on.

The distance is that of :mod:`kindred.functions.lists`. For features alone the member with the least total distance is
the one nearest to the mean; for sets there is no mean, so that shortcut is gone, and comparing all members with each
other is out of the question. Instead:

1. One pass assigns every point to the nearest medoid. Medoids come in blocks of a bounded size.
2. Lists are inverted by cluster: how many members have an item, by the size of their lists. From that follows for
   every member a bound below which its total cannot be: the feature part is exact (``n`` times the squared distance to
   the mean plus the error about it), and the similarity to a member with ``b`` items is at most the items in common
   over the longer of both lists, which adds up item by item.
   Lists are only inverted where they have to be. A member's similarity to all others is at most the number of lists
   that its most common item is in, so members too far from the mean go out first. Where the few that are left meet
   no more lists than there are items, they are joined with just these lists, and what they have in common is counted.
3. The members of least bound are compared with their whole cluster, in one pass for all clusters. Then only members
   whose bound is below the best total so far are left, mostly none; these follow in further passes. So the medoid is
   exact, and no pairs of a cluster are made. A bound equal to the best total can only win by its id, so copies of the
   best member need no pass.

Rules are those of :mod:`kindred.plans.clustering`: ties go to the lowest cluster and the lowest id (totals per member
that are equal to nine places tie), a cluster without points goes out and makes the move infinite, a run stops once the
total move is at most ``epsilon`` or after ``max_iters`` iterations, and the error is the mean distance to the updated
medoids. Null items are left out, repeated ones count once, and a null list is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.kernels import matrix
from kindred.functions.lists import list_column, nearer_list_task, targets, totals_task
from kindred.functions.vectors import squared_distance
from kindred.operators.assign import MODEL_BYTES
from kindred.operators.centers import SALTS, initial_centers
from kindred.operators.joins import join_counted
from kindred.operators.ordering import with_start
from kindred.plans.clustering import Clustering
from kindred.session import fresh_path, materialize, scratch, written

#: Members of each cluster that the first pass compares with all others; each later pass takes twice as many.
CANDIDATES = 16
#: Sizes of lists are told apart by powers of this.
SIZE_STEP = 1.25
#: Bounds are lower than worked out by this share, and by as much, so that rounding never makes one exceed a total.
ROUNDING = 1e-11
#: Meetings of items with lists that are counted one by one in any case; beyond, as many as there are items.
FEW_MEETINGS = 1_000_000

_HISTORY = "run_id int, iter int, clusters long, delta double, wsos double"
_RUNS = "run_id int, k int, seed int, max_iters int, epsilon double, iters int, delta double, wsos double"


def distinct_items(items: Column) -> Column:
    """A list as a sorted set of longs."""
    return F.array_sort(F.array_distinct(F.array_compact(F.coalesce(items, F.array())).cast("array<bigint>")))


def mixed_distance(left: tuple[Column, Column], right: tuple[Column, Column], weight: float) -> Column:
    """The distance of two pairs of features and items."""
    both = F.size(F.array_intersect(left[1], right[1]))
    union = F.size(left[1]) + F.size(right[1]) - both
    apart = F.when(union > 0, 1 - both / union).otherwise(F.lit(0.0))
    return (1 - weight) * (squared_distance(left[0], right[0]) / F.size(left[0])) + weight * apart


def _blocks(table: DataFrame, order: list[str], model_bytes: int) -> Iterator[pa.Table]:
    """A table of features and items in blocks of about ``model_bytes``, in order; only a block is on the driver."""
    size = (F.size("features") + F.size("items") + 2) * 8
    sized = table.withColumn("_bytes", size.cast("long"))
    total = sized.agg(F.sum("_bytes")).first()[0] or 0
    if total <= model_bytes:
        yield table.orderBy(*order).toArrow().combine_chunks()
        return
    placed = with_start(sized, order, "_start", "_bytes").withColumn("_block", F.floor(F.col("_start") / model_bytes))
    placed = materialize(placed.drop("_start", "_bytes"), "blocks")
    for row in placed.select("_block").distinct().orderBy("_block").toLocalIterator():
        yield placed.filter(F.col("_block") == row["_block"]).drop("_block").orderBy(*order).toArrow().combine_chunks()


def _targets(rows: pa.Table):
    features, items = rows["features"].combine_chunks(), rows["items"].combine_chunks()
    return targets(matrix(features), *list_column(items))


def nearest_mixed(points: DataFrame, medoids: DataFrame, weight: float, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """``points`` (with ``features`` and ``items``) with the nearest of ``medoids``: ``cluster`` and ``distance`` added.

    ``medoids`` are ``(cluster, features, items)``. Each block of them is a pass; the result is written.
    """
    spark = points.sparkSession
    kept = [name for name in points.columns if name not in ("features", "items")]
    passed = ", ".join(f"`{name}` {points.schema[name].dataType.simpleString()}" for name in kept)
    schema = ", ".join(filter(None, [passed, "features array<double>, items array<bigint>, cluster int, distance double"]))
    best = points.select(*kept, "features", "items", F.lit(-1).alias("cluster"), F.lit(float("inf")).alias("distance"))
    for rows in _blocks(medoids.select("cluster", "features", "items"), ["cluster"], model_bytes):
        block = spark.sparkContext.broadcast((rows["cluster"].to_numpy(), _targets(rows)))
        best = materialize(best.mapInArrow(nearer_list_task(block, len(kept), weight), schema), "nearest-mixed")
    return best


def _size_class(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log(size) / np.log(SIZE_STEP) + 1e-9)).otherwise(F.lit(-1)).cast("int")


def _least_size(size_class: Column) -> Column:
    return F.greatest(F.ceil(F.pow(F.lit(SIZE_STEP), size_class) - 1e-6), F.lit(0))


def most_lists(points: DataFrame) -> int:
    """In how many lists of ``points`` the most common item is."""
    counts = points.select(F.explode("items").alias("item")).groupBy("item").count()
    return counts.agg(F.max("count").alias("most")).first()["most"] or 0


def _for_each_salt(clusters: DataFrame) -> DataFrame:
    """One row per cluster as one for each salt, so that a large cluster is in several tasks of a join."""
    return clusters.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _about_means(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every member with its distance ``gap`` to the mean of its cluster, and the rows by cluster, with the ``error`` about it."""
    size = F.size("items")
    dims = len(assigned.first()["features"])
    mean = F.array(*[F.avg(F.get("features", F.lit(i))) for i in range(dims)])
    means = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), mean.alias("mean"), F.sum((size == 0).cast("long")).alias("empty"))
    means = materialize(_for_each_salt(means), "cluster-means")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    placed = assigned.withColumn("_salt", salt).join(means, ["cluster", "_salt"])
    gap = squared_distance(F.col("features"), F.col("mean")) / dims
    placed = placed.select("cluster", "id", "n", "empty", size.alias("size"), gap.alias("gap"), "_salt")
    placed = materialize(placed, "gaps")
    # A member without an id cannot be a medoid.
    least = F.min(F.when(F.col("id").isNotNull(), F.col("gap")))
    sums = placed.groupBy("cluster").agg(F.sum("gap").alias("error"), least.alias("least_gap"), F.sum("size").alias("items"))
    return placed, materialize(sums, "errors")


def _total(likeness: Column, weight: float) -> Column:
    return (1 - weight) * (F.col("n") * F.col("gap") + F.col("error")) + weight * (F.col("n") - likeness)


def _likeness(shared: Column) -> Column:
    """To all members: an empty list is like the other empty ones, any other like none of these."""
    return F.when(F.col("size") == 0, F.col("empty")).otherwise(F.least(shared, F.col("n") - F.col("empty")))


def _bounds(placed: DataFrame, sums: DataFrame, alike: DataFrame, weight: float) -> DataFrame:
    """``(cluster, id, n, bound)`` from what each member's list is like others, ``(cluster, id, alike)``."""
    total = _total(_likeness(F.coalesce("alike", F.lit(0.0))), weight)
    errors = _for_each_salt(sums.select("cluster", "error"))
    bounds = placed.join(errors, ["cluster", "_salt"]).join(alike, ["cluster", "id"], "left")
    return bounds.select("cluster", "id", "n", (total * (1 - ROUNDING) - ROUNDING).alias("bound"))


def _alike_by_counts(assigned: DataFrame) -> DataFrame:
    """What no member's list is like all others by more than: lists are inverted and counted, and every item meets its counts."""
    postings = assigned.select("cluster", "id", F.size("items").alias("size"), F.explode("items").alias("item"))
    counted = postings.groupBy("cluster", "item", _size_class(F.col("size")).alias("class")).agg(F.count(F.lit(1)).alias("members"))
    # Few classes of sizes for an item of a cluster: they grow as the logarithm of the longest list.
    inverted = counted.groupBy("cluster", "item").agg(
        F.collect_list(F.struct("class", "members")).alias("classes"), F.sum("members").alias("members")
    )
    inverted = materialize(inverted, "inverted-lists")
    longer = lambda c: F.greatest(F.col("size").cast("double"), _least_size(c["class"]).cast("double"))
    shared = F.aggregate("classes", F.lit(0.0), lambda total, c: total + c["members"] / longer(c))
    met = join_counted(postings, inverted, ["cluster", "item"], "members")
    return met.groupBy("cluster", "id").agg(F.sum(shared).alias("alike"))


def _alike_by_meetings(assigned: DataFrame, near: DataFrame) -> DataFrame:
    """How much the lists of ``near``, few members, are like all others: those with an item in common are met one by one."""
    # Rows are told apart by number, so that ids that repeat do no harm; of their likenesses the greatest is a bound for each.
    numbered = lambda rows: rows.withColumn("row", F.monotonically_increasing_id())
    posted = lambda rows: rows.select("cluster", "id", "row", F.size("items").alias("size"), F.explode("items").alias("item"))
    own = materialize(posted(numbered(assigned.join(near, ["cluster", "id"], "left_semi"))), "near-postings")
    others = posted(numbered(assigned)).select("cluster", "item", F.col("row").alias("other"), F.col("size").alias("other_size"))
    met = own.join(others, ["cluster", "item"]).groupBy("cluster", "id", "row", "other")
    met = met.agg(F.count(F.lit(1)).alias("both"), F.first("size").alias("size"), F.first("other_size").alias("other_size"))
    both = F.col("both")
    alike = met.groupBy("cluster", "id", "row").agg(F.sum(both / (F.col("size") + F.col("other_size") - both)).alias("alike"))
    return alike.groupBy("cluster", "id").agg(F.max("alike").alias("alike"))


def total_bounds(assigned: DataFrame, weight: float) -> DataFrame:
    """``(cluster, id, n, bound)``: for every member a bound of its total distance to the members of its cluster."""
    placed, sums = _about_means(assigned)
    return _bounds(placed, sums, _alike_by_counts(assigned), weight)


def medoid_bounds(assigned: DataFrame, weight: float, most: int) -> DataFrame:
    """The same for those members that could be medoids, with no item in more than ``most`` lists.

    A member's list is like others at most as often as an item of it is in a list over the size of it, which adds up
    to ``most``; and the total of the member nearest to the mean is at most that without any likeness.
    """
    placed, sums = _about_means(assigned)
    least = (1 - weight) * (F.col("n") * F.col("gap") + F.col("error")) + weight * (F.col("n") - _likeness(F.lit(float(most))))
    best = (1 - weight) * (F.col("n") * F.col("least_gap") + F.col("error")) + weight * F.col("n")
    # Totals equal to nine places tie; a little more, so that rounding takes no member out.
    near = placed.join(_for_each_salt(sums), ["cluster", "_salt"]).filter(least <= best * (1 + ROUNDING) + F.col("n") * 2e-9)
    near = materialize(near.select(placed.columns), "near")
    meetings = (near.agg(F.sum("size")).first()[0] or 0) * most
    if meetings > max(FEW_MEETINGS, sums.agg(F.sum("items")).first()[0] or 0):
        return _bounds(placed, sums, _alike_by_counts(assigned), weight)
    return _bounds(near, sums, _alike_by_meetings(assigned, near), weight)


def _least(rows: DataFrame, count: int) -> DataFrame:
    """The ``count`` rows of least ``level`` and id of each cluster, the best of each salt first."""
    for keys in (["cluster", "_salt"], ["cluster"]):
        order = Window.partitionBy(*keys).orderBy("level", "id")
        rows = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= count).drop("_rank")
    return rows.drop("_salt")


def exact_totals(assigned: DataFrame, candidates: DataFrame, weight: float, model_bytes: int) -> DataFrame:
    """``candidates`` (``cluster``, ``id``, ``features``, ``items``) with the ``total`` of each, in a pass for each block."""
    spark = assigned.sparkSession
    numbered = materialize(with_start(candidates, ["cluster", "id"], "candidate"), "candidates")
    found = None
    for rows in _blocks(numbered.select("cluster", "candidate", "features", "items"), ["cluster", "candidate"], model_bytes):
        clusters = rows["cluster"].to_numpy()
        model = {}
        for cluster in np.unique(clusters):
            own = rows.take(pa.array(np.flatnonzero(clusters == cluster)))
            model[int(cluster)] = (own["candidate"].to_numpy(), _targets(own))
        block = spark.sparkContext.broadcast(model)
        mine = assigned.filter(F.col("cluster").between(int(clusters.min()), int(clusters.max())))
        totals = mine.select("cluster", "features", "items").mapInArrow(totals_task(block, weight), "candidate bigint, total double")
        totals = materialize(totals.groupBy("candidate").agg(F.sum("total").alias("total")), "totals")
        found = totals if found is None else found.unionByName(totals)
    return numbered.join(found, "candidate").drop("candidate")


def _level(total: str) -> Column:
    """Totals per member to nine places: equal ones tie."""
    return F.rint(F.col(total) / F.col("n") * 1e9)


def mixed_medoids(assigned: DataFrame, weight: float, model_bytes: int = MODEL_BYTES, candidates: int = CANDIDATES,
                  most: int | None = None) -> DataFrame:
    """The member of each cluster with the least total distance to its members: ``(cluster, n, id, features, items, total)``.

    ``assigned`` is ``(id, features, items, cluster)``; no item is in more than ``most`` lists, which are counted if it
    is not given. The result is written.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    bounds = medoid_bounds(assigned, weight, most_lists(assigned) if most is None else most)
    pool = materialize(bounds.select("cluster", "id", "n", _level("bound").alias("level"), salt.alias("_salt")), "bounds")
    best, count = None, candidates
    while True:
        chosen = materialize(_least(pool, count), "chosen")
        if chosen.isEmpty():
            return best
        # Candidates are few beside the points; their lists are fetched by id.
        listed = assigned.join(chosen, ["cluster", "id"]).select("cluster", "id", "n", "features", "items")
        known = exact_totals(assigned, listed, weight, model_bytes)
        known = known if best is None else known.unionByName(best)
        first = F.min_by(F.struct("n", "id", "features", "items", "total"), F.struct(_level("total"), "id")).alias("best")
        best = materialize(known.groupBy("cluster").agg(first).select("cluster", "best.*"), "best")
        # What is left: members beyond those taken that would be before the best, were their totals as low as their bounds.
        last = chosen.groupBy("cluster").agg(F.max(F.struct("level", "id")).alias("last"))
        limit = best.select("cluster", F.struct(_level("total").alias("level"), "id").alias("limit"))
        state = _for_each_salt(limit.join(last, "cluster", "left"))
        place = F.struct("level", "id")
        open_ = (place < F.col("limit")) & (place > F.col("last"))
        pool = materialize(pool.join(state, ["cluster", "_salt"]).filter(open_).select(pool.columns), "open")
        count *= 2


def cluster_with_lists(points: DataFrame, k: int, seed: int, max_iters: int, epsilon: float = 0.0, weight: float = 0.5,
                       model_bytes: int = MODEL_BYTES, candidates: int = CANDIDATES) -> Clustering:
    """K-medoids of ``points`` (a unique ``id``, ``features``, ``items`` and columns to carry) under the mixed distance.

    ``weight`` is that of the lists, from 0 (features alone) to 1 (lists alone). ``centers`` are ``(run_id, cluster, n,
    id, center, items)``; only the results stay written.
    """
    if not 0 <= weight <= 1:
        raise ValueError("weight must be between 0 and 1")
    if k < 1 or max_iters < 1:
        raise ValueError("k and max_iters must be at least 1")
    spark = points.sparkSession
    paths = [fresh_path(spark, name) for name in ("centers", "assignments")]
    with scratch(spark):
        carried = [points[name] for name in points.columns if name not in ("features", "items")]
        features = points["features"].cast("array<double>").alias("features")
        working = materialize(points.select(*carried, features, distinct_items(points["items"]).alias("items")), "list-points")
        if working.isEmpty():
            raise ValueError("there are no points")
        setup = spark.createDataFrame([(0, k, seed)], "run_id int, k int, seed int").collect()
        drawn = initial_centers(working.select("id", "features"), setup).select("cluster", "id")
        medoids = materialize(working.select("id", "features", "items").join(drawn, "id"), "medoids")
        most = most_lists(working)
        log: list[tuple] = []
        done = False
        while not done:
            path = fresh_path(spark, "medoids")
            # What an iteration writes on the way goes with it; only its medoids stay for the next.
            with scratch(spark):
                assigned = nearest_mixed(working, medoids, weight, model_bytes)
                members = assigned.select("id", "features", "items", "cluster")
                moved = written(mixed_medoids(members, weight, model_bytes, candidates, most), path)
                log.append((0, len(log) + 1, moved.count(), _move(medoids, moved, weight), _error(moved)))
                medoids, done = moved, log[-1][3] <= epsilon or len(log) >= max_iters
                if done:
                    centers, assignments = _write_results(points, assigned, medoids, weight, paths)
    runs = spark.createDataFrame([(0, k, seed, max_iters, float(epsilon), len(log), log[-1][3], log[-1][4])], _RUNS)
    return Clustering(runs, centers, assignments, spark.createDataFrame(log, _HISTORY))


def _write_results(
    points: DataFrame, assigned: DataFrame, medoids: DataFrame, weight: float, paths: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The tables of centers and assignments, with the distance to the updated medoids."""
    centers = medoids.select(F.lit(0).alias("run_id"), "cluster", "n", "id", F.col("features").alias("center"), "items")
    place = medoids.select("cluster", F.col("features").alias("_center"), F.col("items").alias("_items"))
    place = _for_each_salt(place)
    gap = mixed_distance((F.col("features"), F.col("items")), (F.col("_center"), F.col("_items")), weight)
    salted = assigned.drop("distance").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    kept = [name for name in points.columns if name not in ("features", "items")]
    placed = salted.join(place, ["cluster", "_salt"]).select(*kept, F.lit(0).alias("run_id"), "cluster", gap.alias("distance"))
    return written(centers, paths[0]), written(placed, paths[1])


def _move(before: DataFrame, after: DataFrame, weight: float) -> float:
    """The total distance between medoids before and after; infinite if a cluster was lost."""
    now = after.select("cluster", F.col("features").alias("_now"), F.col("items").alias("_items"))
    step = mixed_distance((F.col("features"), F.col("items")), (F.col("_now"), F.col("_items")), weight)
    step = F.when(F.col("_now").isNull(), F.lit(float("inf"))).otherwise(step)
    return before.join(now, "cluster", "left").agg(F.sum(step).alias("delta")).first()["delta"]


def _error(medoids: DataFrame) -> float:
    return medoids.agg((F.sum("total") / F.sum("n")).alias("wsos")).first()["wsos"]
