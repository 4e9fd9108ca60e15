"""Operator 5, sharding by a permutation-filled lookup table, with DataFrame functions only.

Every shard prefers the slots of a prime-sized table in its own order (offset + i * skip, modulo the prime). Shards
take turns: each claims its next preferred slot that is still free, until the table is full, so shards differ by one
slot at most, and a shard more or less moves few slots. The table has ``slots`` entries whatever the data; it is
broadcast, and a row is placed by one hash and one lookup, without a shuffle.

A key may hold a third of all rows: ``salted`` keys are placed together with the row's salt, which spreads them.

Defined results: a null key is placed by the text (its MD5), so such rows spread; both null: by the empty key;
repeated rows go to the same shard; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{k:02d}" for k in range(16))


def _number(name: str, use: str) -> int:
    return int(hashlib.md5(f"{use}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard. ``slots`` must be a prime, well above the number of shards."""
    if not shards or slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("needs a shard at least, and a prime number of slots")
    offset = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    turn, table, free = [0] * len(shards), [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            at = (offset[k] + turn[k] * skip[k]) % slots
            while table[at] >= 0:
                turn[k] += 1
                at = (offset[k] + turn[k] * skip[k]) % slots
            table[at] = k
            turn[k] += 1
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))


def document_key(id_col: str = "doc_id", text: str = "text") -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.col(text))), F.lit(""))


def placed(df: DataFrame, key: Column, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS,
           salted: Column | None = None, salt: Column | None = None, shard_col: str = "shard",
           slot_col: str = "slot") -> DataFrame:
    """``df`` with the slot and shard of each row. ``key`` is a string; rows where ``salted`` is true are placed by
    key and ``salt``. Columns of ``df`` that are named as the two results are replaced."""
    if salted is not None:
        key = F.when(salted, F.concat_ws("/", key, salt.cast("string"))).otherwise(key)
    table = df.sparkSession.range(1).select(
        F.posexplode(F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")).alias("_slot", "_shard"))
    name = F.element_at(F.array(*map(F.lit, shards)), F.col("_shard").cast("int") + 1)
    table = table.select(F.col("_slot").cast("long").alias("_slot"), name.alias("_shard"))
    names = [c for c in df.columns if c not in (slot_col, shard_col)]
    spread = df.select(*names, slot_of(key, slots).alias(slot_col))
    return spread.join(F.broadcast(table), spread[slot_col] == table["_slot"]).select(
        *(spread[c] for c in spread.columns), table["_shard"].alias(shard_col))


def write_shards(df: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder per shard; a shard's rows are spread over several tasks and files when it is large."""
    df.hint("rebalance", shard_col).write.partitionBy(shard_col).parquet(path)
