"""Shard placement by a permutation-filled lookup table.

Every shard orders the slots of a table of prime size by its own permutation
``(offset + j * skip) mod size``, both numbers hashed from the shard's name. The shards
take turns; in its turn a shard claims the first slot of its order that is still free,
until the table is full. Claims of two shards differ by one at most (a shard of weight
``w`` takes ``w`` turns a round), and when a shard joins or leaves, few other slots
change owner. The table depends on the names only, has a fixed size, and is broadcast:
placing a key is one hash and one lookup, with no shuffle whatever the number of rows.

Defined results: a null key hashes as the empty string; equal keys share a slot; an
empty input gives an empty result; an empty shard list is an error.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default table size: a prime well over 100 slots for each of up to 600 shards.
TABLE_SIZE = 65537
#: Largest table that is broadcast (slots).
MAX_TABLE = 1 << 22


def _number(text: str) -> int:
    """The first 60 bits of the md5 digest, as :func:`slot_of` takes them."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    if n < 2:
        return False
    d = 2
    while d * d <= n:
        if n % d == 0:
            return False
        d += 1
    return True


def lookup_table(shards: dict[str, int] | list[str], size: int = TABLE_SIZE) -> list[str]:
    """Owner of every slot. ``shards`` are names, or names with whole weights of 1 or more."""
    weights = dict(shards) if isinstance(shards, dict) else dict.fromkeys(shards, 1)
    if not weights or min(weights.values()) < 1:
        raise ValueError("at least one shard, and weights of 1 or more")
    if not is_prime(size) or size > MAX_TABLE or sum(weights.values()) > size:
        raise ValueError(f"the size must be a prime up to {MAX_TABLE}, and hold all shards")
    names = sorted(weights)
    step = {s: 1 + _number(f"skip:{s}") % (size - 1) for s in names}
    at = {s: _number(f"offset:{s}") % size for s in names}
    owner: list[str | None] = [None] * size
    free = size
    while free:
        for s in names:
            for _ in range(min(weights[s], free)):
                while owner[at[s]] is not None:  # a prime size: the order visits every slot
                    at[s] = (at[s] + step[s]) % size
                owner[at[s]] = s
                free -= 1
    return owner


def slot_of(key: Column | str, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of the md5 of its text, modulo the table size."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(df: DataFrame, shards: dict[str, int] | list[str], key: str = "doc_id", size: int = TABLE_SIZE,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of every row (a column of ``df`` with one of
    these names is replaced). The table has ``size`` rows, ``MAX_TABLE`` at most, so the
    broadcast is bounded by a parameter and not by the data."""
    owner = lookup_table(shards, size)
    table = df.sparkSession.createDataFrame(list(enumerate(owner)), f"__llm_slot int, {shard_col} string")
    kept = [c for c in df.columns if c.lower() not in (slot_col.lower(), shard_col.lower())]   # Spark's names have no case
    slots = df.select(*kept, slot_of(df[key], size).alias("__llm_at"))
    return (slots.join(F.broadcast(table), F.col("__llm_at") == F.col("__llm_slot"), "left")
            .select(*kept, F.col("__llm_at").alias(slot_col), shard_col))


def moved(old: dict[str, int] | list[str], new: dict[str, int] | list[str], size: int = TABLE_SIZE) -> float:
    """Share of slots whose owner is in both sets and still changes."""
    a, b = lookup_table(old, size), lookup_table(new, size)
    both = set(old) & set(new)
    return sum(x != y and x in both and y in both for x, y in zip(a, b, strict=True)) / size
