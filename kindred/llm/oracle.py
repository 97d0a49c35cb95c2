"""The SQL that checks those operators that SQL can express."""

from __future__ import annotations

from kindred.llm.decontaminate import WINDOW, WITHIN
from kindred.llm.sharding import SLOTS_PER_SHARD, prime_from

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"'[^\x20\x09-\x0D]+'"
LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(table: str, key: str, pattern: str, lower: bool) -> str:
    """Texts with their words, and a number for every row."""
    text = "coalesce(text, '')"
    text = f"translate({text}, '{UPPER}', '{LOWER}')" if lower else text
    return f"SELECT row_number() OVER () AS r, {key}, text AS t, regexp_extract_all({text}, {pattern}) AS w FROM {table}"


def sharding(shards: list[str]) -> str:
    """The table filled turn by turn, then every key looked up."""
    size = prime_from(SLOTS_PER_SHARD * len(shards))
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(shards))
    number = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)".format
    return f"""
WITH RECURSIVE shards(shard_no, shard) AS (VALUES {names}),
orders AS MATERIALIZED (
  SELECT shard_no, [(o + k * s) % {size} for k in range({size})] AS slots FROM (
    SELECT shard_no, {number("shard || '/offset'")} % {size} AS o,
      {number("shard || '/skip'")} % {size - 1} + 1 AS s FROM shards)),
fill(turn, owners) AS (
  SELECT 0, [-1 for x in range({size})]
  UNION ALL
  SELECT turn + 1, owners[:best] || [shard_no] || owners[best + 2:] FROM (
    SELECT turn, owners, shard_no, [x for x in slots if owners[x + 1] < 0][1] AS best
    FROM fill JOIN orders ON shard_no = turn % {len(shards)} WHERE turn < {size})),
slots AS (
  SELECT unnest(range({size})) AS slot, unnest(owners) AS shard_no FROM fill WHERE turn = {size})
SELECT doc_id, slot, shard FROM (
  SELECT doc_id, {number("coalesce(CAST(doc_id AS VARCHAR), '')")} % {size} AS slot FROM documents)
JOIN slots USING (slot) JOIN shards USING (shard_no)"""


QUALITY = f"""
WITH d AS MATERIALIZED ({_words("documents", "doc_id", SPACED, lower=False)}),
lines AS (
  SELECT r, [x for x in string_split(coalesce(t, ''), chr(10)) if regexp_matches(x, {SPACED})] AS l FROM d),
windows AS MATERIALIZED (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
often AS (SELECT r, a, b, c FROM windows GROUP BY r, a, b, c HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS p FROM windows JOIN often USING (r, a, b, c))
  GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(t, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(coalesce(t, ''), '[^!]', '', 'g')) AS n_shouts
  FROM d JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR word_chars > 40 * n_words
    OR 10 * word_chars < 15 * n_words OR 100 * n_dup_lines > 60 * n_lines OR n_shouts > n_words) AS kept
FROM m"""

DECONTAMINATION = f"""
WITH d AS MATERIALIZED ({_words("documents", "doc_id", LETTERS, lower=True)}),
items AS MATERIALIZED (SELECT *, least(len(w), {WINDOW}) AS n FROM ({_words("benchmark", "item_id", LETTERS, lower=True)}) WHERE len(w) > 0),
sought AS MATERIALIZED (
  SELECT DISTINCT item_id, n, w[i:i + n - 1] AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
grams AS (
  SELECT r, i, n, w[i:i + n - 1] AS g FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items))),
found AS MATERIALIZED (SELECT r, i, n, item_id FROM grams JOIN sought USING (n, g)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r),
counts AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
anchors AS MATERIALIZED (
  SELECT i, item_id, s, min_by(term, {{'n': coalesce(n, 0), 'place': list_position(w, term)}}) AS term FROM (
    SELECT r AS i, item_id, w, list_distinct(w) AS s, unnest(list_distinct(w)) AS term FROM items) LEFT JOIN counts USING (term)
  GROUP BY i, item_id, s HAVING min(coalesce(n, 0)) > 0),
places AS (
  SELECT r, w, p, term FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM anchors)),
near AS (
  SELECT r, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_near FROM places JOIN anchors USING (term)
  WHERE list_has_all(w[greatest(1, p - {WITHIN}):p + {WITHIN}], s) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)"""

WARC = """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN revisits THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisits THEN last END AS refers_to
FROM (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest, last,
    strlen(body) >= 1000 AND page_id IS DISTINCT FROM last AS revisits
  FROM (SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages))"""

MINHASH = f"""
WITH RECURSIVE d AS MATERIALIZED ({_words("documents", "doc_id", SPACED, lower=True)}),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
    SELECT doc_id, w, least(len(w), 3) AS n, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id <> y.doc_id
  GROUP BY a, b),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN least_of USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


# CRC-32 of a decimal number: its bytes in turn, each followed by eight steps of the polynomial.
_CRC32 = """list_reduce(
  [CAST(4294967295 AS BIGINT)] || flatten([[ord(x), -1, -1, -1, -1, -1, -1, -1, -1] for x in string_split(CAST({} AS VARCHAR), '')]),
  lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)"""

TRIE = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, k, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS p FROM (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
      len(regexp_extract_all(coalesce(text, ''), {SPACED})) AS w FROM conversations WHERE conv_id IS NOT NULL)),
c AS MATERIALIZED (SELECT conv_id, xor({_CRC32.format("conv_id")}, 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
s AS (
  SELECT c.conv_id, 0 AS own, p, k, w FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 WHERE p <= h
  UNION ALL SELECT conv_id, 1, p, k, w FROM c JOIN t USING (conv_id) WHERE p > h),
m AS MATERIALIZED (
  SELECT conv_id, 0 AS d, '' AS key, 0 AS w FROM c
  UNION ALL SELECT conv_id, row_number() OVER o, string_agg(k, '') OVER o, w FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY own, p)),
n AS MATERIALIZED (
  SELECT key, d, substr(key, 1, 32 * (d - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w FROM m GROUP BY key, d),
kids AS (SELECT up AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY up),
ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(key, d) AS key FROM m GROUP BY conv_id) GROUP BY key),
below AS (
  SELECT substr(key, 1, 32 * x) AS key, sum((n_convs - 1) * w) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT n.key, n_convs, w, n_children, unnest(range(d + 1)) AS x FROM n LEFT JOIN kids USING (key)) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, CASE WHEN n.d > 0 THEN u.conv_id END AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n LEFT JOIN n AS u ON n.up = u.key AND u.d = n.d - 1 LEFT JOIN kids ON kids.key = n.key
LEFT JOIN ends ON ends.key = n.key JOIN below ON below.key = n.key"""


RANKED = f"""
WITH d AS MATERIALIZED ({_words("documents", "doc_id", LETTERS, lower=True)}),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d WHERE len(w) > 0),
i AS MATERIALIZED (SELECT r AS i, item_id, unnest(list_distinct(w)) AS term FROM ({_words("benchmark", "item_id", LETTERS, lower=True)})),
tf AS MATERIALIZED (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, n, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM tf JOIN weight USING (term) JOIN i USING (term), total GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""
