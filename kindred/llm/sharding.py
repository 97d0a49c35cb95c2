"""Placing rows on shards by a permutation-filled lookup table.

Shards take turns claiming slots of a prime-sized table, each in its own order of preference, until
every slot has an owner. Slots are shared evenly (to one), and when a shard comes or goes most slots
keep their owner. A row goes to the slot its key hashes to, one lookup in a table of ``slots`` rows.

Only built-in functions are used. The fill is one expression over one row, with work that grows as the
square of the number of slots; that depends on the number of shards alone, never on the data.

Defined cases: a null key has the digest of the empty text and so one fixed shard; equal keys share a
shard; no rows give no rows. No shards, repeated shard names and a table that is not prime or has
fewer slots than shards are errors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots per shard at least, so that an uneven share of slots stays below one hundredth.
SLOTS_PER_SHARD = 100
#: The lookup table is broadcast; this many rows of two numbers and a name bound its size.
MAX_SLOTS = 20_000


def prime_from(least: int) -> int:
    """The smallest prime that is no less."""
    at = max(least, 2)
    while any(at % d == 0 for d in range(2, int(at**0.5) + 1)):
        at += 1
    return at


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def digest_number(value: Column) -> Column:
    """The first 60 bits of the MD5 of a text as a number."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards: list[str], slots: int | None = None) -> DataFrame:
    """``(slot, shard_no, shard)`` for every slot; ``shard_no`` is the place in ``shards``."""
    size = slots or prime_from(SLOTS_PER_SHARD * len(shards))
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if size != prime_from(size) or size < len(shards) or size > MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    names = F.array(*[F.lit(name) for name in shards])
    # A shard's order of preference: offset, offset + skip, offset + 2 * skip and so on.
    offsets = F.transform(names, lambda name: digest_number(F.concat(name, F.lit("/offset"))) % size)
    skips = F.transform(names, lambda name: digest_number(F.concat(name, F.lit("/skip"))) % (size - 1) + 1)
    ready = spark.range(1).select(names.alias("names"), offsets.alias("offsets"), skips.alias("skips"))

    # The place of a slot in a shard's order is (slot - offset) / skip in the field of the prime.
    def claim(owners: Column, turn: Column) -> Column:
        who = F.pmod(turn, F.lit(len(shards)))
        return let(F.get("orders", who), lambda order: let(_claimed(owners, order, size), lambda best: F.transform(
            owners, lambda owner, slot: F.when(slot == best, order["shard_no"]).otherwise(owner)
        )))

    # By Fermat a number's inverse is its power to size - 2, here by squaring.
    order = F.transform(
        F.arrays_zip("offsets", "skips"),
        lambda order, i: F.struct(
            i.alias("shard_no"), order["offsets"].alias("offset"), order["skips"].alias("skip"),
            _power(order["skips"], size - 2, size).alias("inverse"),
        ),
    )
    ready = ready.select("names", order.alias("orders"))
    start = F.array_repeat(F.lit(-1), size)
    filled = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), start, claim)
    slots_of = ready.select("names", F.posexplode(filled).alias("slot", "shard_no"))
    return slots_of.select(F.col("slot").cast("long").alias("slot"), "shard_no", F.get("names", "shard_no").alias("shard"))


def _claimed(owners: Column, order: Column, size: int) -> Column:
    """The free slot that comes first in a shard's order."""
    places = F.transform(
        owners,
        lambda owner, slot: F.when(owner < 0, F.pmod((slot - order["offset"]) * order["inverse"], F.lit(size))),
    )
    return F.pmod(F.array_min(places) * order["skip"] + order["offset"], F.lit(size))


def _power(base: Column, exponent: int, size: int) -> Column:
    bits = F.array(*[F.lit(int(bit)) for bit in f"{exponent:b}"])
    step = lambda so_far, bit: F.when(bit == 1, so_far * so_far % size * base % size).otherwise(so_far * so_far % size)
    return F.aggregate(bits, F.lit(1).cast("long"), step)


def place(rows: DataFrame, key: str, shards: list[str], slots: int | None = None) -> DataFrame:
    """``rows`` with ``slot``, ``shard_no`` and ``shard`` added (columns of these names are replaced)."""
    size = slots or prime_from(SLOTS_PER_SHARD * len(shards))
    table = lookup_table(rows.sparkSession, shards, size)
    others = [rows[name] for name in rows.columns if name not in ("slot", "shard_no", "shard")]
    number = digest_number(F.coalesce(rows[key].cast("string"), F.lit(""))) % size
    # At most MAX_SLOTS rows.
    return rows.select(*others, number.alias("slot")).join(F.broadcast(table), "slot")
