"""Placing rows on shards by a permutation-filled lookup table (consistent hashing).

Each shard prefers the slots of a prime-sized table in an order of its own. Taking turns, each claims the first
slot of its order that is still free, until the table is full; so every shard holds about the
same number of slots, and a shard that comes or goes moves few others. A key's hash names its slot. The table has
a fixed size and is broadcast.

A key with more than a set share of all rows would fill a shard by itself: such a key is split into as
many ways as it has shares, and each way is placed like a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], size: int, weights: Sequence[int] | None = None) -> list[int]:
    """The shard of each slot. A shard of weight w claims w slots in its turn."""
    if not is_prime(size) or size < len(shards) or not shards:
        raise ValueError("the table's size must be a prime, and at least the number of shards")
    turns = list(weights or [1] * len(shards))
    if len(turns) != len(shards) or min(turns) < 0 or not any(turns):
        raise ValueError("there must be a weight for each shard, and one above zero")
    offsets = [_number(f"offset:{s}") % size for s in shards]
    skips = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, tried, free = [-1] * size, [0] * len(shards), size
    while True:
        for i, turn in enumerate(turns):
            for _ in range(turn):
                slot = (offsets[i] + tried[i] * skips[i]) % size
                while table[slot] >= 0:
                    tried[i] += 1
                    slot = (offsets[i] + tried[i] * skips[i]) % size
                table[slot] = i
                tried[i] += 1
                free -= 1
                if not free:
                    return table


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def place(rows: DataFrame, key: str, spread: str, shards: Sequence[str], size: int, share: int) -> DataFrame:
    """`rows` with `way`, `slot` and `shard`, those of such names left out.

    `key` is placed as text, a null like an empty one. A key that holds more than 1 / `share` of all rows is split into
    ways by the hash of `spread`; there are fewer than `share` such keys, so their list is broadcast.
    """
    table = lookup_table(shards, size)
    spark = rows.sparkSession
    slots = spark.createDataFrame([(s, shards[i]) for s, i in enumerate(table)], "_slot long, _shard string")
    base = rows.drop("way", "slot", "shard").withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("")))
    counts = written(base.groupBy("_key").agg(F.count("*").alias("n")), "keys")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = counts.where(F.col("n") * share > total).select(
        F.col("_key").alias("_hot"), F.expr(f"(n * {share} + {max(1, total)} - 1) div {max(1, total)}").cast("long").alias("_ways")
    )
    text = F.coalesce(F.col(spread).cast("string"), F.lit(""))
    found = base.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left")
    way = F.when(F.col("_ways").isNull(), F.lit(0)).otherwise(F.pmod(_hash(text), F.col("_ways"))).cast("long")
    found = found.withColumn("way", way)
    # An unsplit key and the first way of a split one have the same place.
    found = found.withColumn("slot", F.pmod(_hash(F.concat_ws(":", F.col("_key"), F.col("way").cast("string"))), F.lit(size)))
    placed = found.join(F.broadcast(slots), F.col("slot") == F.col("_slot")).withColumn("shard", F.col("_shard"))
    return placed.drop("_key", "_hot", "_ways", "_slot", "_shard")


def write_shards(placed: DataFrame, folder: str) -> None:
    """A folder of Parquet files for each shard; every task writes its own rows, nothing is moved."""
    placed.write.partitionBy("shard").parquet(folder)


def sql(table: str, key: str, spread: str, shards: Sequence[str], size: int, share: int) -> str:
    """`place` in SQL, for the columns of the query."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))
    number = lambda text: f"('0x' || substr(md5({text}), 1, 15))::BIGINT"
    return f"""
    WITH RECURSIVE shards AS (
        SELECT i, name, {number("'offset:' || name")} % {size} AS first, {number("'skip:' || name")} % {size - 1} + 1 AS skip
        FROM (VALUES {names}) v(i, name)
    ), orders AS (
        SELECT list(list_transform(range({size}), lambda j: (first + j * skip) % {size} + 1) ORDER BY i) AS prefers FROM shards
    ), turns AS (
        SELECT 0 AS turn, list_transform(range({size}), lambda j: -1) AS held
        UNION ALL
        SELECT turn + 1, list_concat(list_concat(held[:spot - 1], [turn % {len(shards)}]), held[spot + 1:])
        FROM (SELECT turn, held, list_filter(prefers[turn % {len(shards)} + 1], lambda s: held[s] = -1)[1] AS spot
              FROM turns, orders WHERE turn < {size})
    ), slots AS (
        SELECT unnest(range({size})) AS slot, unnest(held) AS i FROM turns WHERE turn = {size}
    ), docs AS (
        SELECT {spread}, coalesce({key}::VARCHAR, '') AS k, {key} FROM {table}
    ), hot AS (
        SELECT k, (count(*) * {share} + (SELECT count(*) FROM docs) - 1) // (SELECT count(*) FROM docs) AS ways
        FROM docs GROUP BY k HAVING count(*) * {share} > (SELECT count(*) FROM docs)
    ), ways AS (
        SELECT {spread}, {key}, k, coalesce({number(f"coalesce({spread}::VARCHAR, '')")} % ways, 0)::BIGINT AS way
        FROM docs LEFT JOIN hot USING (k)
    )
    SELECT {spread}, {key}, way, slot::BIGINT AS slot, name AS shard
    FROM (SELECT *, {number("k || ':' || way")} % {size} AS slot FROM ways) JOIN slots USING (slot) JOIN shards USING (i)
    """
