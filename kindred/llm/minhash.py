"""Near-duplicates by b-bit MinHash, with exact links.

1. Every text has its set of word shingles, a digest of that set, and ``HASHES`` minima. Texts with equal sets
   are one class from here on, however many there are.
2. The minima, five at a time, give the bands; classes that agree in a band share a bucket. A pair at the
   threshold (0.85) misses all 25 bands once in two million times.
3. Only the low four bits of each minimum are kept, packed into eight longs. Inside a bucket the similarity of
   two classes is estimated from the bits that agree, corrected for chance agreement. Pairs far below the
   threshold (by more than six standard errors) go out. A bucket gives at most one edge per member: a spanning
   forest of what is left. A bucket larger than ``BUCKET_ROWS`` is compared block by block in several tasks.
4. The components of those edges are the neighbourhoods. Within each, exact intersections of full sets
   are counted from inverted lists, block by block if it is large, and again only a spanning forest of the true
   links comes out. Its components are the result.

So no pair list of a group is ever written, no partner is capped, and what is decided rests on full sets.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle; repeated rows each have a result row; null ids never are the id
of a component unless it has no other; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.components import components
from kindred.llm.key_filter import key_map, named, without
from kindred.llm.texts import NOT_SPACE, map_blocks, words_of
from kindred.session import fresh_path, materialize, scratch, written

BANDS = 25
BAND_ROWS = 5
HASHES = 128
BITS = 4
#: Of one bucket and of one neighbourhood, what a task compares at a time: classes, and shingles.
BUCKET_ROWS = 4_096
BLOCK_SHINGLES = 1_000_000

_draw = np.random.default_rng(20240229)
_MULTIPLY = _draw.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _draw.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_SIGNATURE = [f"s{i}" for i in range(HASHES * BITS // 64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text as 64-bit numbers."""
    words = words_of(texts, NOT_SPACE)
    coded = words.values.dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(word) for word in coded.dictionary.to_pylist()], dtype=np.uint64)
    numbers = table[coded.indices.to_numpy()] if len(table) else np.zeros(0, np.uint64)
    sets = []
    for begin, end in zip(words.first[:-1], words.first[1:]):
        own = numbers[begin:end]
        width = min(size, len(own))
        if not width:
            sets.append(own)
            continue
        # The width is part of the hash, so a short text never equals a shingle of a longer one.
        shingles = np.full(len(own) - width + 1, width, dtype=np.uint64)
        for i in range(width):
            shingles = mixed(shingles * _MIX[0] + own[i : len(own) - width + 1 + i])
        sets.append(np.unique(shingles))
    return sets


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each set (none empty) under each hash."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    found = np.empty((len(sets), HASHES), dtype=np.uint64)
    for j in range(HASHES):
        hashed = (values ^ _FLIP[j]) * _MULTIPLY[j]
        hashed ^= hashed >> np.uint64(32)
        found[:, j] = np.minimum.reduceat(hashed, starts)
    return found


def band_values(least: np.ndarray) -> np.ndarray:
    bands = np.zeros((len(least), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        for row in range(BAND_ROWS):
            bands[:, band] = mixed(bands[:, band] * _MIX[0] + least[:, band * BAND_ROWS + row] + np.uint64(band))
    return bands


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, sixteen of them in each 64-bit number."""
    low = least & np.uint64(2**BITS - 1)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    lanes = low.reshape(len(least), -1, len(shifts)) << shifts
    return np.bitwise_or.reduce(lanes, axis=2)


def estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures, corrected for minima that agree in their low bits by chance."""
    differ = one ^ others
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    differ &= np.uint64(0x1111111111111111)
    agree = 1 - np.bitwise_count(differ).sum(axis=-1) / HASHES
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def slack(threshold: float) -> float:
    """Six standard errors of an estimate at the threshold."""
    chance = 2.0**-BITS
    agree = threshold + (1 - threshold) * chance
    return 6 * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def _sign(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def signatures(docs: DataFrame, keep: list[str], text: str, size: int) -> DataFrame:
    """``keep``, the size of the set, its digest, its bands and its packed low bits (null if it is empty)."""
    fields = "n_shingles bigint, class binary, bands array<bigint>, " + ", ".join(f"{s} bigint" for s in _SIGNATURE)

    def work(block: pa.RecordBatch) -> list[pa.Array]:
        sets = shingle_sets(block.column("_text"), size)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        full = np.flatnonzero(sizes)
        least = minima([sets[i] for i in full]) if len(full) else np.zeros((0, HASHES), np.uint64)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), _sign(band_values(least).ravel()))
        place = np.full(len(sets), -1)
        place[full] = np.arange(len(full))
        taken = pa.array(place, mask=place < 0)
        low = packed(least)
        return [pa.array(sizes), pa.array(digests, pa.binary()), bands,
                *[_sign(low[:, i]).take(taken) for i in range(len(_SIGNATURE))]]

    return map_blocks(docs, keep, text, fields, work)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links, as (member, root)."""
    edges, open_ = [], np.ones(len(linked), dtype=bool)
    for root in range(len(linked)):
        if not open_[root]:
            continue
        open_[root] = False
        front = np.array([root])
        while len(front):
            reached = np.flatnonzero(linked[front].any(axis=0) & open_)
            open_[reached] = False
            edges += [(int(i), root) for i in reached]
            front = reached
    return edges


def _groups(batches, n_keys: int):
    """Whole groups of sorted batches, with where each begins and where the last ends; the first
    ``n_keys`` columns are equal in a group."""
    pending = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([pending, table]).combine_chunks() if pending is not None else table
        if not table.num_rows:
            continue
        changed = np.zeros(table.num_rows, dtype=bool)
        for i in range(n_keys):
            key = table.column(i).to_numpy()
            changed[1:] |= key[1:] != key[:-1]
        starts = np.concatenate([[0], np.flatnonzero(changed)])
        # The last group may go on in the next batch.
        pending = table.slice(starts[-1])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]).combine_chunks(), starts
    if pending is not None and pending.num_rows:
        yield pending.combine_chunks(), np.array([0, pending.num_rows])


def _blocked(rows: DataFrame, keys: list[str], blocks: str) -> DataFrame:
    """Rows once for every pair of blocks that theirs is in: ``i`` and ``j`` name the pair.

    ``blocks`` is how many blocks the group has; a group of one block is one pair.
    """
    own = F.pmod(F.xxhash64("class"), F.col(blocks)).cast("int")
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
        .withColumn("i", F.least("_own", "_other"))
        .withColumn("j", F.greatest("_own", "_other"))
        .drop("_own", "_other", blocks)
        .repartition(*keys, "i", "j")
        .sortWithinPartitions(*keys, "i", "j")
    )


def candidate_edges(classes: DataFrame, threshold: float, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``(a, b)`` whose components hold every pair of classes that may be linked."""
    floor = threshold - slack(threshold)
    members = classes.select("class", F.posexplode("bands").alias("band", "value"))
    sizes = members.groupBy("band", "value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sizes = sizes.select("band", "value", F.ceil(F.col("members") / bucket_rows).alias("blocks"))
    # Signatures join what is left of the members, which are many more before.
    shared = members.join(sizes, ["band", "value"]).join(classes.select("class", *_SIGNATURE), "class")
    ready = _blocked(shared, ["band", "value"], "blocks").select("band", "value", "i", "j", "class", *_SIGNATURE)

    def compare(batches):
        for table, starts in _groups(batches, 4):
            names = table.column("class").to_pylist()
            low = np.stack([table.column(s).to_numpy().view(np.uint64) for s in _SIGNATURE], axis=1)
            edges = []
            begins, ends = starts[:-1], starts[1:]
            sizes_ = ends - begins
            two = begins[sizes_ == 2]
            close = two[estimate(low[two], low[two + 1]) >= floor]
            edges += [(names[i], names[i + 1]) for i in close]
            for begin, end in zip(begins[sizes_ > 2], ends[sizes_ > 2]):
                own = low[begin:end]
                linked = np.concatenate([
                    estimate(own[at : at + 32, None, :], own[None, :, :]) >= floor for at in range(0, len(own), 32)
                ])
                edges += [(names[begin + a], names[begin + b]) for a, b in _forest(linked)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], names=["a", "b"]
            )

    return ready.mapInArrow(compare, "a binary, b binary")


def exact_links(neighbours: DataFrame, threshold: float, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """True links ``(a, b)`` that connect what is connected in each neighbourhood.

    ``neighbours`` has ``(root, class, shingles)``: a class, its neighbourhood and its set.
    """
    numerator = round(threshold * 100)
    count = F.octet_length("shingles") / 8
    most = F.greatest(F.sum(count) / block_shingles, F.count(F.lit(1)) / BUCKET_ROWS)
    sizes = neighbours.groupBy("root").agg(F.ceil(most).alias("blocks"))
    rows = _blocked(neighbours.join(sizes, "root"), ["root"], "blocks").select("root", "i", "j", "class", "shingles")

    def count_links(batches):
        for table, starts in _groups(batches, 3):
            names = table.column("class").to_pylist()
            edges = []
            for begin, end in zip(starts[:-1], starts[1:]):
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")[begin:end]]
                edges += [(names[begin + a], names[begin + b]) for a, b in _forest(_linked(sets, numerator))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], names=["a", "b"]
            )

    return rows.mapInArrow(count_links, "a binary, b binary")


def _linked(sets: list[np.ndarray], numerator: int) -> np.ndarray:
    """Which sets are linked: 100 * intersection >= numerator * union, counted from inverted lists."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    n = len(sets)
    linked = np.zeros((n, n), dtype=bool)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        linked[0, 1] = linked[1, 0] = 100 * common >= numerator * (sizes.sum() - common)
        return linked
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    heads = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    keys = values[heads]
    lengths = np.diff(np.append(heads, len(values)))
    for x in range(n):
        at = np.searchsorted(keys, sets[x])
        at = at[lengths[at] > 1]
        if not len(at):
            continue
        spans = lengths[at]
        steps = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        common = np.bincount(owners[np.repeat(heads[at], spans) + steps], minlength=n)
        linked[x] = 100 * common >= numerator * (sizes[x] + sizes - common)
        linked[x, x] = False
    return linked


def _sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``(root, class, shingles)`` of wanted classes ``(root, class, rep)``, from the text of row ``rep``.

    ``doc_id`` should tell apart rows of different texts, or all rows of one id meet all its classes. Texts that no class wants are left out in the scan.
    """
    wanted = materialize(wanted, "wanted-classes")
    near = named(docs, key_map(wanted, "rep"), docs[doc_id])
    texts = near.select(near[doc_id].alias("_id"), near[text].alias("_body"))
    joined = wanted.join(texts, F.col("rep").eqNullSafe(F.col("_id"))).select("root", "class", "_body")

    def work(block: pa.RecordBatch) -> list[pa.Array]:
        sets = shingle_sets(block.column("_text"), size)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return [pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(digests, pa.binary())]

    found = map_blocks(joined, ["root", "class"], "_body", "shingles binary, _digest binary", work)
    # An id may be that of several rows; those with another set are not meant, and copies count once.
    return found.filter("_digest = class").groupBy("root", "class").agg(F.first("shingles").alias("shingles"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(key, text)`` of every row: the id with a digest of the text, so rows of one id, or of none, are told apart.

    Keys without an id come last.
    """
    digest = F.unhex(F.md5(F.coalesce(docs[text], F.lit(""))))
    key = F.struct(docs[doc_id].isNull().alias("nameless"), docs[doc_id].alias("id"), digest.alias("digest"))
    return docs.select(key.alias("key"), docs[text].alias("text"))


def _row_components(docs: DataFrame, doc_id: str, text: str, size: int, threshold: float) -> DataFrame:
    """``(key, n_shingles, least)`` for every row: ``least`` is the least key reachable, null if its set is empty."""
    path = fresh_path(docs.sparkSession, "row-components")
    # Only the result stays written.
    with scratch(docs.sparkSession):
        keyed = _keyed(docs, doc_id, text)
        signed = materialize(signatures(keyed, ["key"], "text", size), "signatures")
        full = signed.filter("n_shingles > 0")
        same = F.first(F.struct("bands", *_SIGNATURE)).alias("same")
        classes = full.groupBy("class").agg(F.min("key").alias("rep"), same).select("class", "rep", "same.*")
        classes = materialize(classes, "classes")
        neighbourhoods = components(candidate_edges(classes, threshold), "neighbourhoods")
        wanted = neighbourhoods.select("root", F.col("node").alias("class")).join(classes.select("class", "rep"), "class")
        sets = materialize(_sets_of(keyed, wanted, "key", "text", size), "shingle-sets")
        roots = components(exact_links(sets, threshold), "links")
        own = classes.select("class", "rep").join(roots.withColumnRenamed("node", "class"), "class", "left")
        own = own.select("class", "rep", F.coalesce("root", "class").alias("root"))
        least = own.groupBy("root").agg(F.min("rep").alias("least"))
        of_class = own.join(least, "root").select("class", "least")
        found = signed.select("key", "n_shingles", "class").join(of_class, "class", "left")
        return written(found.select("key", "n_shingles", "least"), path)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_shingles, component_id, kept)``.

    Rows are linked where the similarity of their sets of ``size``-word shingles is at least ``threshold``;
    ``component_id`` is the smallest id reachable and ``kept`` whether it is the row's own.
    """
    found = _row_components(docs, doc_id, text, size, threshold)
    own = F.col("key.id")
    component = F.when(F.col("least").isNull(), own).otherwise(F.col("least.id"))
    return found.select(
        own.alias(doc_id), "n_shingles", component.alias("component_id"), component.eqNullSafe(own).alias("kept")
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: of every component one, of the smallest id (and of its texts the one of the
    least digest). Rows without an id take part like others and come after them.

    Texts without words are linked with nothing, so their rows stay; rows of one id that are copies of each other are
    one row.
    """
    found = _row_components(docs, doc_id, text, size, threshold)
    goes = (F.col("least") != F.col("key")).alias("goes")
    single = (F.col("least").isNull() & F.col("key.nameless")).alias("single")
    keys = found.select("key.id", "key.digest", F.coalesce(goes, F.lit(False)).alias("goes"), single).groupBy("id", "digest").agg(
        F.first("goes").alias("goes"), (F.count(F.lit(1)) > 1).alias("several"), F.first("single").alias("single")
    )
    # Those that go are fewer than those that stay; of those that stay only the repeated ones matter.
    marked = materialize(keys.filter("goes OR (several AND NOT single)").select("id", "digest", "goes"), "marked-rows")
    digest = F.unhex(F.md5(F.coalesce(docs[text], F.lit(""))))
    map_ = key_map(marked, "id", "digest")
    rest = without(docs, marked, [docs[doc_id], digest], ["id", "digest"], map_)
    repeated = marked.filter("NOT goes")
    if repeated.isEmpty():
        return rest
    near = named(docs, map_, docs[doc_id], digest)
    same = docs[doc_id].eqNullSafe(repeated["id"]) & (digest == repeated["digest"])
    return rest.unionByName(near.join(repeated, same, "left_semi").dropDuplicates([doc_id, text]))
