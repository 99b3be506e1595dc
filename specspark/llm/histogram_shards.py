"""Sharding by histogram sort (DataFrame functions only).

Documents are ordered by (hash of the text, hash of the row). The splitters of the shards are searched like radix digits: each
round counts, over all partitions, the exact bytes in 1024 bins inside the few bins that still hold an unmet splitter, until a bin
border is within `tolerance` of the ideal number of bytes. Only shards x 1024 counts ever reach the driver. Equal texts share
the first key, so they stay in one shard unless they alone are larger than the tolerance; then the second key cuts them. Rows
move once, after the splitters are known.

Nulls and ties: a null text has no bytes (crc32 0) and is equal to an empty one here; null ids and repeated rows are rows like
others (rows that are equal in every respect may swap slots). Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.llm.shared import cut, spread_rank

BITS = 10
ROWS_A_CHUNK = 512


def _bins(keyed: DataFrame, spots: list[tuple[int, int | None]], level: int) -> dict[tuple, list[tuple[int, int]]]:
    """Exact bytes in each bin of the next digit inside every spot. A spot is a prefix of the first key, or (hash, prefix of the
    second key) once the first is used up."""
    first, digit = level < 7, level % 7
    col, wide = ("_k1" if first else "_k2"), 64 - BITS * (digit + 1)
    # 7 digits: six of 10 bits and one of the 4 left
    here = F.shiftright(col, max(wide, 0))
    up = F.shiftright(col, wide + BITS) if digit else F.lit(0)
    spot = F.struct(F.when(F.lit(first), F.lit(0)).otherwise(F.col("_k1")).cast("long").alias("a"), up.cast("long").alias("b"))
    rows = keyed.select("size", spot.alias("spot"), here.cast("long").alias("bin"))
    if level:
        rows = rows.where(F.col("spot.a").isin([a for a, _ in spots]) & F.col("spot.b").isin([b for _, b in spots]))
    found: dict[tuple, list[tuple[int, int]]] = {}
    for r in rows.groupBy("spot", "bin").agg(F.sum("size").alias("size")).collect():
        found.setdefault((r.spot.a, r.spot.b), []).append((r.bin, r["size"]))
    return {k: sorted(v) for k, v in found.items()}


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """(first key, second key) from which each shard but the first begins."""
    low = -(1 << 63)
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    done: dict[int, tuple[int, int]] = {}
    unmet = {i: ((0, 0), 0) for i in range(1, shards)}  # splitter -> spot, bytes before the spot
    for level in range(14):
        if not unmet or not total:
            break
        first, digit = level < 7, level % 7
        wide = max(64 - BITS * (digit + 1), 0)
        bins = _bins(keyed, [s for s, _ in unmet.values()], level)
        still = {}
        for i, (spot, before) in unmet.items():
            ideal = total * i / shards
            for b, size in bins[spot]:
                edge = (b << wide, low) if first else (spot[0], b << wide)
                if abs(before - ideal) <= slack or before >= ideal:
                    done[i] = edge
                    break
                if before + size > ideal + slack:  # the border lies inside this bin
                    if level < 13:
                        still[i] = ((b, 0) if first and digit == 6 else (0 if first else spot[0], b)), before
                    else:  # one row: the nearer end of it
                        done[i] = edge if ideal - before <= before + size - ideal else (spot[0], min(b + 1, (1 << 63) - 1))
                    break
                before += size
            else:
                b = bins[spot][-1][0] + 1
                edge = (min(b << wide, (1 << 63) - 1), low) if first else (spot[0], min(b << wide, (1 << 63) - 1))
                done[i] = edge
        unmet = {i: x for i, x in still.items() if i not in done}
    return [done.get(i, (low, low)) for i in range(1, shards)]


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.005, carry: list[str] | None = None, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """row (struct of the columns `carry`, all by default), size, text_crc32, shard, slot: every row of docs in the shard and the
    gapless place it takes there, shards of near equal bytes (size: bytes of the text plus 8)."""
    carry = docs.columns if carry is None else carry
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = cut(docs.select(
        F.struct(*carry).alias("row"), (F.octet_length(whole) + F.lit(8)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("_k1"), F.xxhash64(key, whole).alias("_k2")))
    cuts = splitters(keyed, shards, tolerance)
    number: Column = F.lit(0)
    for a, b in cuts:
        number = number + ((F.col("_k1") > a) | ((F.col("_k1") == a) & (F.col("_k2") >= b))).cast("int")
    rows = keyed.count()
    placed = keyed.withColumn("shard", number)
    salts = max(1, -(-rows // (shards * ROWS_A_CHUNK)))
    return spread_rank(placed, ["shard"], ["_k2", "_k1"], "_k2", salts, out="slot").select(
        "row", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
