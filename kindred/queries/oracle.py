"""The SQL that checks each query, for any engine with lists and ``md5``.

Clusterings are unrolled: one set of tables for each iteration, with medoids found by comparing
all pairs in a cluster.
"""

from __future__ import annotations

from kindred.queries.clustering import EMBEDDING_RUN, GRID, LINE_RUN, LIST_WEIGHT, MIXED_RUN, SONG_RUN, SWEEP
from kindred.queries.tables import LINE_FEATURES
from kindred.schema import FEATURES

TRACKS = "lineitem"
TRACK_ORDER = "l_linenumber, l_partkey, l_suppkey"

FEATURED = """
featured AS MATERIALIZED (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ', ' || p_type AS title, p_brand AS artist,
    q.duration, CAST(p_size AS DOUBLE) AS key, CASE WHEN p_size > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS modality,
    q.signature, q.acousticness, q.danceability, q.energy, q.instrumentalness, q.liveness, q.loudness,
    q.speechiness, q.valence, q.tempo
  FROM part JOIN (
    SELECT l_partkey, sum(l_quantity) AS duration, CAST(min(l_linenumber) AS DOUBLE) AS signature,
      max(l_discount) AS acousticness, min(l_discount) AS danceability, max(l_tax) AS energy,
      min(l_tax) AS instrumentalness, CAST(count(*) AS DOUBLE) AS liveness, max(l_extendedprice) AS loudness,
      max(l_quantity) AS speechiness, min(l_quantity) AS valence, min(l_extendedprice) AS tempo
    FROM lineitem GROUP BY l_partkey) q ON p_partkey = l_partkey
)"""


def _points(source: str, columns: list[str], keys: str) -> str:
    """Scaled points in long form, ``keys, dim, val``, from a table of one column per feature."""
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(columns))
    scaled = ", ".join(
        f"CASE WHEN coalesce(s{i}, 0) = 0 THEN 0.0 ELSE ({c} - m{i}) / s{i} END" for i, c in enumerate(columns)
    )
    return f"""
stats AS MATERIALIZED (SELECT {stats} FROM {source}),
pts AS MATERIALIZED (
  SELECT {keys}, unnest(range({len(columns)})) AS dim, unnest([{scaled}]) AS val FROM {source}, stats)"""


SONG_POINTS = FEATURED + "," + _points("featured", FEATURES, "id, title, artist")
LINE_POINTS = (
    """
raw_lines AS MATERIALIZED (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS id, l_quantity, l_extendedprice,
    l_discount, l_tax FROM lineitem),"""
    + _points("raw_lines", LINE_FEATURES, "id")
)
EMBEDDING_POINTS = """
raw_dims AS MATERIALIZED (
  SELECT vec_id AS id, label, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings),
stats AS MATERIALIZED (SELECT dim, avg(v) AS m, stddev_samp(v) AS s FROM raw_dims GROUP BY dim),
pts AS MATERIALIZED (
  SELECT id, label, dim, CASE WHEN coalesce(s, 0) = 0 THEN 0.0 ELSE (v - m) / s END AS val
  FROM raw_dims JOIN stats USING (dim))"""


def _setups(runs: list[tuple]) -> str:
    rows = ", ".join(f"({i}, {k}, {seed}, {iters}, {eps!r}::DOUBLE)" for i, (k, seed, iters, eps) in enumerate(runs))
    return f"setups(run_id, k, seed, max_iters, epsilon) AS (VALUES {rows})"


def _first(runs: list[tuple]) -> str:
    return f"""
{_setups(runs)},
draw AS MATERIALIZED (
  SELECT run_id, id, row_number() OVER (PARTITION BY run_id ORDER BY md5(concat_ws('|', seed, id)), id) - 1 AS cluster, k
  FROM setups, (SELECT DISTINCT id FROM pts)),
c0 AS MATERIALIZED (
  SELECT run_id, cluster, dim, val FROM draw JOIN pts USING (id) WHERE cluster < k)"""


def _assign(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
  SELECT run_id, id, cluster FROM (
    SELECT run_id, id, cluster, row_number() OVER (PARTITION BY run_id, id ORDER BY d, cluster) AS place FROM (
      SELECT c.run_id, p.id, c.cluster, sum((p.val - c.val) * (p.val - c.val)) AS d
      FROM pts p JOIN c{i - 1} c USING (dim) GROUP BY c.run_id, p.id, c.cluster))
  WHERE place = 1)"""


def _update(i: int, medoids: bool) -> str:
    if not medoids:
        return f"""
c{i} AS MATERIALIZED (
  SELECT run_id, cluster, dim, avg(val) AS val FROM a{i} JOIN pts USING (id) GROUP BY run_id, cluster, dim)"""
    return f"""
t{i} AS MATERIALIZED (
  SELECT run_id, cluster, x.id, sum(list_distance(x.v, y.v) * list_distance(x.v, y.v)) AS total
  FROM (SELECT * FROM a{i} JOIN vectors USING (id)) x JOIN (SELECT * FROM a{i} JOIN vectors USING (id)) y
  USING (run_id, cluster) GROUP BY run_id, cluster, x.id),
m{i} AS MATERIALIZED (
  SELECT run_id, cluster, id FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id, cluster ORDER BY round(total, 5), id) AS place FROM t{i})
  WHERE place = 1),
c{i} AS MATERIALIZED (SELECT run_id, cluster, dim, val FROM m{i} JOIN pts USING (id))"""


def _measures(i: int) -> str:
    return f"""
e{i} AS MATERIALIZED (
  SELECT run_id, id, sum((p.val - c.val) * (p.val - c.val)) AS d
  FROM a{i} JOIN pts p USING (id) JOIN c{i} c USING (run_id, cluster, dim) GROUP BY run_id, id),
h{i} AS MATERIALIZED (
  SELECT {i} AS iter, s.run_id, s.delta, w.wsos, n.clusters FROM (
    SELECT o.run_id,
      CASE WHEN count(u.val) < count(*) THEN 'infinity'::DOUBLE ELSE sum((o.val - u.val) * (o.val - u.val)) END AS delta
    FROM c{i - 1} o LEFT JOIN c{i} u USING (run_id, cluster, dim) GROUP BY o.run_id) s
  JOIN (SELECT run_id, avg(d) AS wsos FROM e{i} GROUP BY run_id) w USING (run_id)
  JOIN (SELECT run_id, count(DISTINCT cluster) AS clusters FROM c{i} GROUP BY run_id) n USING (run_id))"""


def _clustering(points: str, runs: list[tuple], medoids: bool = False) -> str:
    """All iterations of all runs, and for each run the one it stops at."""
    iterations = max(run[2] for run in runs)
    parts = [points, _first(runs)]
    if medoids:
        parts.append("\nvectors AS MATERIALIZED (SELECT id, list(val ORDER BY dim) AS v FROM pts GROUP BY id)")
    for i in range(1, iterations + 1):
        parts += [_assign(i), _update(i, medoids), _measures(i)]
    union = " UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(1, iterations + 1))
    parts.append(f"\nhistory AS MATERIALIZED ({union})")
    parts.append("""
stops AS MATERIALIZED (
  SELECT run_id, min(iter) AS iter FROM history JOIN setups USING (run_id)
  WHERE delta <= epsilon OR iter = max_iters GROUP BY run_id)""")

    def at_stop(name: str, prefix: str) -> str:
        chosen = " UNION ALL ".join(
            f"SELECT t.* FROM {prefix}{i} t JOIN stops USING (run_id) WHERE iter = {i}" for i in range(1, iterations + 1)
        )
        return f"\n{name} AS MATERIALIZED ({chosen})"

    parts += [at_stop("assigned", "a"), at_stop("centers", "c"), at_stop("errors", "e")]
    parts.append("""
runs AS MATERIALIZED (
  SELECT run_id, k, seed, h.iter AS iters, h.delta, h.wsos
  FROM stops JOIN history h USING (run_id, iter) JOIN setups USING (run_id))""")
    return "WITH " + ",".join(parts)


def _mixed_step(i: int) -> str:
    """Points to medoids, then every pair of members of a cluster."""
    mixed = f"""{1 - LIST_WEIGHT} * e / {len(FEATURES)} + {LIST_WEIGHT} *
      CASE WHEN x.size + y.size > 0 THEN 1 - coalesce(c, 0) / (x.size + y.size - coalesce(c, 0)) ELSE 0 END"""
    return f"""
g{i} AS MATERIALIZED (
  SELECT x.id, cluster, {mixed} AS d FROM (
    SELECT p.id, m.cluster, m.id AS mid, sum((p.val - q.val) * (p.val - q.val)) AS e
    FROM m{i - 1} m JOIN pts q ON q.id = m.id JOIN pts p USING (dim) GROUP BY ALL) gaps
  JOIN sizes x USING (id) JOIN sizes y ON y.id = mid
  LEFT JOIN (SELECT a.id, b.id AS mid, count(*) AS c FROM lists a JOIN lists b USING (item) JOIN m{i - 1} m ON m.id = b.id
    GROUP BY ALL) shared ON shared.id = x.id AND shared.mid = gaps.mid),
a{i} AS MATERIALIZED (
  SELECT id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, cluster) AS place FROM g{i}) WHERE place = 1),
p{i} AS MATERIALIZED (
  SELECT cluster, x.id, y.id AS other, {mixed} AS d FROM (
    SELECT cluster, x.id, y.id AS other, list_distance(x.v, y.v) * list_distance(x.v, y.v) AS e
    FROM (SELECT * FROM a{i} JOIN vectors USING (id)) x JOIN (SELECT * FROM a{i} JOIN vectors USING (id)) y USING (cluster)) pairs
  JOIN sizes x USING (id) JOIN sizes y ON y.id = other
  LEFT JOIN (SELECT a.id, b.id AS other, count(*) AS c FROM lists a JOIN lists b USING (item) GROUP BY ALL) shared
    ON shared.id = x.id AND shared.other = pairs.other),
t{i} AS MATERIALIZED (SELECT cluster, id, count(*) AS n, sum(d) AS total FROM p{i} GROUP BY cluster, id),
m{i} AS MATERIALIZED (
  SELECT cluster, id, n, total FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(total / n, 9), id) AS place FROM t{i}) WHERE place = 1),
s{i} AS MATERIALIZED (
  SELECT cluster, {mixed} AS d FROM (
    SELECT o.cluster, o.id, u.id AS other, sum((p.val - q.val) * (p.val - q.val)) AS e
    FROM m{i - 1} o JOIN m{i} u USING (cluster) JOIN pts p ON p.id = o.id JOIN pts q ON q.id = u.id AND p.dim = q.dim GROUP BY ALL) moves
  JOIN sizes x USING (id) JOIN sizes y ON y.id = other
  LEFT JOIN (SELECT a.id, b.id AS other, count(*) AS c FROM lists a JOIN lists b USING (item) GROUP BY ALL) shared
    ON shared.id = x.id AND shared.other = moves.other),
h{i} AS MATERIALIZED (
  SELECT {i} AS iter, count(*) AS clusters, sum(total) / sum(n) AS wsos,
    CASE WHEN count(*) < (SELECT count(*) FROM m{i - 1}) THEN 'infinity'::DOUBLE ELSE (SELECT sum(d) FROM s{i}) END AS delta FROM m{i})"""


def _mixed() -> str:
    """Two iterations; the first does not stop the run unless nothing moves."""
    k, seed, iterations, epsilon = MIXED_RUN
    steps = ",".join(_mixed_step(i) for i in range(1, iterations + 1))
    return f"""WITH {SONG_POINTS},{_first([MIXED_RUN])},
vectors AS MATERIALIZED (SELECT id, list(val ORDER BY dim) AS v FROM pts GROUP BY id),
lists AS MATERIALIZED (SELECT DISTINCT l_partkey::VARCHAR AS id, l_orderkey AS item FROM lineitem),
sizes AS MATERIALIZED (SELECT id, count(item) AS size FROM (SELECT DISTINCT id FROM pts) LEFT JOIN lists USING (id) GROUP BY id),
m0 AS MATERIALIZED (SELECT cluster, id FROM draw WHERE cluster < k),{steps}"""


EMBEDDING_CLUSTERS = _clustering(EMBEDDING_POINTS, [EMBEDDING_RUN])
LINE_CLUSTERS = _clustering(LINE_POINTS, [LINE_RUN])
SONG_CLUSTERS = _clustering(SONG_POINTS, [SONG_RUN])
SONG_MEDOIDS = _clustering(SONG_POINTS, [SONG_RUN], medoids=True)
SWEEP_CLUSTERS = _clustering(SONG_POINTS, [(k, 5, 3, 0.0) for k in SWEEP])
SONG_STEP = _clustering(SONG_POINTS, [(SONG_RUN[0], SONG_RUN[1], 1, 0.0)])
SONG_STEP_MEDOIDS = _clustering(SONG_POINTS, [(SONG_RUN[0], SONG_RUN[1], 1, 0.0)], medoids=True)

LISTS = """
SELECT {key} AS {name}, CAST(part AS INTEGER) AS part, string_agg({value}, ',' ORDER BY place) AS {listed}
FROM (SELECT *, place // {size} AS part FROM (
  SELECT *, row_number() OVER (PARTITION BY l_{group} ORDER BY {order}) - 1 AS place FROM lineitem))
GROUP BY l_{group}, part"""


def _adjacency(size: int) -> str:
    return LISTS.format(
        key="l_orderkey", name="pid", value="l_partkey::VARCHAR", listed="track_ids", size=size, group="orderkey",
        order=TRACK_ORDER,
    )


def _song_lists(size: int) -> str:
    return LISTS.format(
        key="l_partkey::VARCHAR", name="id", value="l_orderkey::VARCHAR", listed="playlists", size=size,
        group="partkey", order="l_orderkey",
    )


_TEXTS = "SELECT doc_id::VARCHAR AS id, lang AS title, source AS artist FROM documents"


def _with_playlists(how: str, size: int) -> str:
    return f"""
SELECT coalesce(s.id, l.id) AS id, s.title, s.artist, CAST(coalesce(l.part, 0) AS INTEGER) AS part,
  '[' || coalesce(l.pids, '') || ']' AS playlists
FROM ({_TEXTS}) s
{how} JOIN (
  SELECT id, part, string_agg(pid::VARCHAR, ';' ORDER BY place) AS pids FROM (
    SELECT id, pid, place, place // {size} AS part FROM (
      SELECT o_custkey::VARCHAR AS id, o_orderkey AS pid,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place
      FROM orders))
  GROUP BY id, part) l USING (id)"""


_SONGS = "SELECT p_partkey::VARCHAR AS id, p_name AS title, p_brand AS artist FROM part"
_SIZES = "SELECT p_size AS k, max(p_retailprice) AS wsos FROM part GROUP BY p_size"
_DEALT = """SELECT o_orderkey, o_totalprice,
  CAST((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) % 12 AS INTEGER) AS bucket FROM orders"""
_COUNTED_SONGS = """(SELECT id, title, artist, playlists FROM featured JOIN (
  SELECT l_partkey::VARCHAR AS id, count(*) AS playlists FROM lineitem GROUP BY l_partkey) USING (id))"""
_LOADS = f"""SELECT bucket, count(*) AS rows, sum(o_totalprice) AS load FROM ({_DEALT}) GROUP BY bucket"""
_ELBOW = SWEEP_CLUSTERS + """,
elbows AS (
  SELECT k, wsos,
    lag(wsos) OVER (ORDER BY k) - 2 * wsos + lead(wsos) OVER (ORDER BY k) AS second_diff,
    (first_value(wsos) OVER w + (last_value(wsos) OVER w - first_value(wsos) OVER w)
      * (k - first_value(k) OVER w) / (last_value(k) OVER w - first_value(k) OVER w)) - wsos AS chord_gap
  FROM runs WINDOW w AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _nearest() -> str:
    return "WITH " + ",".join([LINE_POINTS, _first([LINE_RUN]), _assign(1)]) + """
SELECT id, CAST(cluster AS INTEGER) AS cluster, round(sum((p.val - c.val) * (p.val - c.val)), 6) AS distance
FROM a1 JOIN pts p USING (id) JOIN c0 c USING (run_id, cluster, dim) GROUP BY id, cluster"""


def _placed(extra: str = "") -> str:
    return f"""
SELECT id, {extra} CAST(cluster AS INTEGER) AS cluster, round(d, 4) AS distance
FROM assigned JOIN errors USING (run_id, id)"""


_CENTERS = "\nSELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val FROM centers"
_HISTORY = """
SELECT iter, clusters, round(delta, 4) AS delta, round(wsos, 4) AS wsos FROM history
WHERE iter <= (SELECT iter FROM stops)"""
_RUNS = "\nSELECT run_id, k, seed, iters, round(wsos, 4) AS wsos FROM runs"

_RADIO = """
SELECT CAST(cluster AS INTEGER) AS cluster, id FROM assigned
WHERE cluster = (SELECT cluster FROM assigned WHERE id = 17) AND id <> 17"""
_MIXED_MEDOIDS = f"""
SELECT CAST(cluster AS INTEGER) AS cluster, id, n, CAST(size AS INTEGER) AS playlists FROM m{MIXED_RUN[2]} JOIN sizes USING (id)"""

_PLAYLISTS = f"""
SELECT l_orderkey AS pid, string_agg(l_partkey::VARCHAR, ',' ORDER BY {TRACK_ORDER}) AS track_ids
FROM lineitem GROUP BY l_orderkey"""
_TRACKS = f"""
SELECT l_orderkey AS pid,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {TRACK_ORDER}) - 1 AS INTEGER) AS pos,
  l_partkey::VARCHAR AS id, p_name AS title, p_brand AS artist
FROM lineitem JOIN part ON l_partkey = p_partkey"""

SQL = {
    "playlist_adjacency": _adjacency(1_000_000),
    "playlist_adjacency_parts": _adjacency(3),
    "adjacency_part_lines": _adjacency(3),
    "adjacency_pairs": "SELECT l_partkey::VARCHAR AS id, l_orderkey AS pid FROM lineitem",
    "nested_playlists": _PLAYLISTS,
    "nested_playlists_streamed": _PLAYLISTS,
    "nested_tracks": _TRACKS,
    "nested_tracks_streamed": _TRACKS,
    "nested_songs": f"SELECT * FROM ({_SONGS}) WHERE id IN (SELECT l_partkey::VARCHAR FROM lineitem)",
    "dedup_songs": """
SELECT id, title, artist FROM (
  SELECT l_partkey::VARCHAR AS id, l_returnflag || l_linestatus AS title, l_suppkey::VARCHAR AS artist,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS place FROM lineitem)
WHERE place = 1""",
    "enrich_success": f"""
SELECT id, title, artist, quality, toxic FROM ({_TEXTS}) JOIN (
  SELECT doc_id::VARCHAR AS id, min(quality) AS quality, min_by(toxic, quality) AS toxic FROM labels
  WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id) USING (id)""",
    "enrich_failure": f"""
SELECT id, title, artist FROM ({_TEXTS}) t LEFT JOIN (SELECT DISTINCT doc_id::VARCHAR AS id, true AS found FROM labels
  WHERE quality IS NOT NULL AND toxic IS NOT NULL) USING (id) WHERE found IS NULL""",
    "missing_songs": f"SELECT t.* FROM ({_TEXTS}) t ANTI JOIN (SELECT doc_id::VARCHAR AS id FROM labels) USING (id)",
    "song_playlists": _song_lists(1_000_000),
    "song_playlists_parts": _song_lists(30),
    "songs_with_playlists": _with_playlists("LEFT", 1_000_000),
    "songs_with_playlists_full": _with_playlists("FULL", 1_000_000),
    "songs_with_playlists_parts": _with_playlists("FULL", 4),
    "list_decode": """
SELECT doc_id::VARCHAR AS id, CAST(count(o_orderkey) AS INTEGER) AS n,
  CAST(coalesce(sum(o_orderkey + 1099511627776), 0) AS BIGINT) AS total
FROM documents LEFT JOIN orders ON doc_id = o_custkey GROUP BY doc_id""",
    "mixed_lines": f"""
SELECT 'P' AS kind, l_orderkey::VARCHAR AS key, string_agg(l_partkey::VARCHAR, ',' ORDER BY {TRACK_ORDER}) AS rest
FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'A', lpad('s' || p_partkey::VARCHAR, 22, '0'), p_name || ',' || p_brand FROM part""",
    "song_count": "SELECT count(DISTINCT l_partkey) AS songs FROM lineitem",
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "feature_text_lines": f"""
WITH {FEATURED}
SELECT id, concat_ws(',', replace(title, ',', ''), artist,
  {', '.join(f'CAST(floor({name}) AS INTEGER)' for name in FEATURES)}) AS line FROM featured""",
    "feature_lines": f"WITH {FEATURED} SELECT * REPLACE (replace(title, ',', '') AS title) FROM featured",
    "feature_lines_with_playlists": f"""
WITH {FEATURED}
SELECT id, replace(title, ',', '') AS title, duration, tempo, CAST(coalesce(part, 0) AS INTEGER) AS part,
  coalesce(pids, '') AS playlists
FROM featured LEFT JOIN (
  SELECT o_custkey::VARCHAR AS id, place // 4 AS part, string_agg(o_orderkey::VARCHAR, ',' ORDER BY place) AS pids FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders)
  GROUP BY o_custkey, place // 4) USING (id)""",
    "unique_song_lines": """
SELECT p_partkey::VARCHAR AS id, p_name || ' "' || p_brand || ' ' AS title,
  CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS artist FROM part""",
    "assignment_lines": """
SELECT p_size AS cluster, p_name || ' (live) [' || p_type || ', ' || p_partkey || ']' AS title,
  '[' || p_brand || ']' AS artist FROM part""",
    "error_lines": _SIZES,
    "run_lines": f"""
SELECT k, 123 AS seed, 20 AS max_iters, 0.5::DOUBLE AS epsilon, k + 1 AS iters, wsos FROM ({_SIZES})""",
    "setup_lines": """
SELECT CAST(row_number() OVER (ORDER BY p_size) - 1 AS INTEGER) AS run_id, p_size AS k, CAST(count(*) AS INTEGER) AS seed,
  20 AS max_iters, max(p_retailprice) AS epsilon FROM part GROUP BY p_size""",
    "integer_lists": """
SELECT c_custkey, 0 AS pos, CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT) AS number FROM customer
UNION ALL SELECT c_custkey, 1, CAST(c_nationkey AS BIGINT) FROM customer""",
    "row_numbers": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row FROM orders",
    "balanced_buckets": f"SELECT o_orderkey, bucket FROM ({_DEALT})",
    "bucket_loads": f"SELECT bucket, rows, round(load, 2) AS load FROM ({_LOADS})",
    "load_spread": f"SELECT round(max(load) - min(load), 2) AS spread FROM ({_LOADS})",
    "work_order": """
SELECT p_partkey AS run_id, p_size AS k, p_size + 3 AS max_iters, CAST(p_size * (p_size + 3) AS BIGINT) AS work
FROM part ORDER BY work, run_id""",
    "feature_means": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd FROM lineitem"
        for c in LINE_FEATURES
    ),
    "scaled_lines": f"WITH {LINE_POINTS} SELECT id, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val FROM pts",
    "assembled_lines": f"WITH {LINE_POINTS} SELECT id, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val FROM pts",
    "scaled_embeddings": f"""
WITH {EMBEDDING_POINTS} SELECT id, label, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val FROM pts""",
    "scaled_songs": f"""
WITH {SONG_POINTS} SELECT id, title, artist, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val FROM pts""",
    "vector_arithmetic": """
WITH raw AS (
  SELECT vec_id, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(sum((v - (v + v) * 3.0 / 2.0) * (v - (v + v) * 3.0 / 2.0)) OVER (PARTITION BY vec_id), 6) AS gap,
  CAST(dim AS INTEGER) AS dim, round((v + v) * 3.0 / 2.0, 6) + 0.0 AS val FROM raw""",
    "initial_centers": f"""
WITH {EMBEDDING_POINTS}, {_first([(10, 7, 1, 0.0)])}
SELECT CAST(cluster AS INTEGER) AS cluster, id FROM draw WHERE cluster < k""",
    "nearest_center": _nearest(),
    "nearest_center_blocks": _nearest(),
    "kmeans_centers": EMBEDDING_CLUSTERS + _CENTERS,
    "kmeans_embeddings_assign": EMBEDDING_CLUSTERS + """
SELECT id, label, CAST(cluster AS INTEGER) AS cluster, round(d, 4) AS distance
FROM assigned JOIN errors USING (run_id, id) JOIN (SELECT DISTINCT id, label FROM pts) USING (id)""",
    "kmeans_assign": LINE_CLUSTERS + _placed(),
    "kmeans_delta": LINE_CLUSTERS + _HISTORY,
    "kmedoids_centers": SONG_MEDOIDS + _CENTERS,
    "kmedoids_assign": SONG_MEDOIDS + _placed(),
    "kmedoids_delta": SONG_MEDOIDS + _HISTORY,
    "cluster_means": SONG_STEP + """
SELECT CAST(cluster AS INTEGER) AS cluster, n, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val
FROM c1 JOIN (SELECT cluster, count(*) AS n FROM a1 GROUP BY cluster) USING (cluster)""",
    "cluster_medoids": SONG_STEP_MEDOIDS + "\nSELECT CAST(cluster AS INTEGER) AS cluster, id FROM m1",
    "mean_error": SONG_STEP + "\nSELECT round(wsos, 4) AS wsos FROM h1",
    "error_after_move": SONG_STEP_MEDOIDS + "\nSELECT round(wsos, 4) AS wsos FROM h1",
    "center_shift": SONG_STEP + "\nSELECT round(delta, 4) AS delta FROM h1",
    "lost_clusters": SONG_STEP + f"""
SELECT DISTINCT CAST(cluster + {SONG_RUN[0]} AS INTEGER) AS cluster FROM c1""",
    "wsos_by_k": SWEEP_CLUSTERS + "\nSELECT k, round(wsos, 4) AS wsos FROM runs",
    "elbow_table": _ELBOW + """
SELECT k, round(wsos, 4) AS wsos, round(second_diff, 4) AS second_diff, round(chord_gap, 4) AS chord_gap FROM elbows""",
    "elbow_k": _ELBOW + "\nSELECT k FROM elbows ORDER BY chord_gap DESC, k LIMIT 1",
    "grid_runs": _clustering(SONG_POINTS, GRID) + _RUNS,
    "grid_medoid_runs": _clustering(SONG_POINTS, GRID, medoids=True) + _RUNS,
    "grid_assignments": _clustering(SONG_POINTS, GRID) + """
SELECT run_id, id, title, artist, CAST(cluster AS INTEGER) AS cluster FROM assigned JOIN featured USING (id)""",
    "cluster_sizes": LINE_CLUSTERS + """
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size FROM assigned GROUP BY cluster""",
    "cluster_sizes_of_assignments": LINE_CLUSTERS + """
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size FROM assigned GROUP BY cluster""",
    "kmeans_assign_tables": LINE_CLUSTERS + _placed(),
    "kmeans_delta_tables": LINE_CLUSTERS + _HISTORY,
    "kmedoids_assign_tables": SONG_MEDOIDS + _placed(),
    "written_assignments": _clustering(SONG_POINTS, GRID) + """
SELECT k, run_id, id, CAST(cluster AS INTEGER) AS cluster FROM assigned JOIN setups USING (run_id)""",
    "written_runs": _clustering(SONG_POINTS, GRID) + _RUNS,
    "written_centers": _clustering(SONG_POINTS, GRID) + """
SELECT run_id, CAST(cluster AS INTEGER) AS cluster, n, CAST(dim AS INTEGER) AS dim, round(val, 6) + 0.0 AS val
FROM centers JOIN (SELECT run_id, cluster, count(*) AS n FROM assigned GROUP BY run_id, cluster) USING (run_id, cluster)""",
    "sorted_assignments": EMBEDDING_CLUSTERS + """
SELECT CAST(cluster AS INTEGER) AS cluster, id FROM assigned ORDER BY cluster, id""",
    "mixed_medoids": _mixed() + _MIXED_MEDOIDS,
    "mixed_medoids_blocks": _mixed() + _MIXED_MEDOIDS,
    "mixed_assign": _mixed() + f"""
SELECT a.id, title, artist, CAST(a.cluster AS INTEGER) AS cluster, round(d, 4) AS distance
FROM a{MIXED_RUN[2]} a JOIN m{MIXED_RUN[2]} m USING (cluster) JOIN p{MIXED_RUN[2]} p ON p.id = m.id AND p.other = a.id
JOIN featured f ON f.id = a.id""",
    "mixed_history": _mixed() + " UNION ALL ".join(
        f"\nSELECT iter, clusters, round(delta, 4) AS delta, round(wsos, 4) AS wsos FROM h{i + 1}" for i in range(MIXED_RUN[2])
    ),
    "radio": EMBEDDING_CLUSTERS + _RADIO,
    "radio_from_files": EMBEDDING_CLUSTERS + _RADIO,
    "cluster_playlists": SONG_CLUSTERS + f"""
SELECT id, title, artist, playlists, CAST(cluster AS INTEGER) AS cluster FROM {_COUNTED_SONGS} JOIN assigned USING (id)""",
    "clusters_by_name": SONG_CLUSTERS + f"""
SELECT title, artist, id, playlists, CAST(cluster AS INTEGER) AS cluster, copies FROM {_COUNTED_SONGS} JOIN (
  SELECT title, artist, cluster, count(*) AS copies FROM assigned JOIN featured USING (id)
  GROUP BY title, artist, cluster) USING (title, artist)""",
}


def _center_names() -> str:
    """Every center is looked up among the points, medoids and means alike."""

    def looked_up(kind: str, clusters: str) -> str:
        return f"""
SELECT '{kind}' AS kind, CAST(cluster AS INTEGER) AS cluster, coalesce(title, '<Not Found>') AS title,
  coalesce(artist, '<Not Found>') AS artist
FROM ({clusters}
  SELECT cluster, title, artist FROM (
    SELECT c.cluster, min(p.id) AS id
    FROM (SELECT cluster, list(val ORDER BY dim) AS v FROM centers GROUP BY cluster) c
    LEFT JOIN (SELECT id, list(val ORDER BY dim) AS v FROM pts GROUP BY id) p ON p.v = c.v GROUP BY c.cluster)
  LEFT JOIN featured USING (id))"""

    off = f"""
SELECT 'off', CAST(cluster AS INTEGER), '<Synthetic>', '<Synthetic>'
FROM ({SONG_CLUSTERS} SELECT DISTINCT cluster FROM centers)"""
    return " UNION ALL ".join([looked_up("medoid", SONG_MEDOIDS), looked_up("mean", SONG_CLUSTERS), off])


SQL["center_names"] = _center_names()
