"""Exact top-k by integer inner product over a bit-sliced index.

Components become integers floor(1024 * x). Rows are dealt to blocks by a hash of the id; a block keeps, for every attribute, bitmaps of
the leading SLICES bits of its values (the index), and the values. For one query the attributes' slices are added with bitmap
arithmetic: a set bit j of |q| adds the attribute's slices, j places up, to the slices of the sum (a full adder is five bitmap
operations); a negative q adds the complement. The sum is a lower approximation of the score with a known error. The k best of it
are selected from the most significant slice downward, and the k-th value less the error gives a boundary; all rows above it are
resolved with exact inner products. Blocks meet parts of the queries, each (block, group of parts) in a task of its own; each cell gives
its k best, and the k best of those remain.

Vectors with a component of |x| >= 32768 (an integer beyond +-2^25, so that a sum might not fit a long) stand in blocks of their own,
without slices. For them, as queries and as candidates, floating products with a proven bound of their error give the rows that may be
among the k best, and those are resolved with integers of any length.

Nulls and ties: vectors that are null or hold null, NaN or infinite components take no part. Equal scores go to the smaller id.
Rows with the query's id are not candidates. Repeated rows are rows of their own; queries that are equal in id and vector are one query.
Missing components of shorter vectors are 0. Ranks follow the exact scores whatever their size; a score that does not fit a long is
null. Fewer candidates than k: all of them. Null ids are no queries, and candidates after all others. Empty tables give an
empty result. Other columns of the table, whatever their names, play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.llm.shared import cut

BLOCK, QUERIES, SLICES = 32768, 256, 7
PARTS = 8  # parts of queries that one task searches at most
LIMIT = 32768.0  # components from here on are large
NONE = (1 << 63) - 1  # stands for a null id
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def integers(vector: Column) -> Column:
    """floor(1024 * x) of every component, x as double, for vectors without large components."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("int"))


def usable(vector: Column) -> Column:
    """No null and only finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def slice_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmaps (attribute, bit from the least, words), the least value of each attribute, and the shift of the bits left out."""
    least = values.min(0)
    spread = (values - least).max(initial=0)
    shift = max(0, int(spread).bit_length() - SLICES)
    cut_ = (values - least) >> shift
    rows = -(-len(values) // 64) * 64
    bits = np.zeros((values.shape[1], SLICES, rows), np.uint8)
    for b in range(SLICES):
        bits[:, b, :len(values)] = ((cut_ >> b) & 1).T
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64), least, shift


def add_slices(total: list[np.ndarray], addend: list[np.ndarray], place: int) -> None:
    """total += addend << place, slice by slice, in place."""
    carry = None
    for i, a in enumerate(addend):
        at = place + i
        t = total[at]
        half = t ^ a
        both = t & a
        if carry is None:
            total[at], carry = half, both
        else:
            total[at], carry = half ^ carry, both | (half & carry)
    at = place + len(addend)
    while at < len(total) and carry.any():
        total[at], carry = total[at] ^ carry, total[at] & carry
        at += 1


def select_top(total: list[np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th largest value of the sum among the rows of the bitmap (at least k), from the most significant slice down."""
    sure, open_, value = np.zeros_like(among), among, 0
    for i in range(len(total) - 1, -1, -1):
        ones = open_ & total[i]
        if int(np.bitwise_count(sure | ones).sum()) >= k:
            open_, value = ones, value | 1 << i
        else:
            sure, open_ = sure | ones, open_ & ~total[i]
    return value


def at_least(total: list[np.ndarray], among: np.ndarray, bound: int) -> np.ndarray:
    """Bitmap of the rows whose sum is bound or more."""
    if bound <= 0:
        return among
    above, equal = np.zeros_like(among), among
    for i in range(len(total) - 1, -1, -1):
        if bound >> i & 1:
            equal = equal & total[i]
        else:
            above, equal = above | (equal & total[i]), equal & ~total[i]
    return above | equal


def top_of_block(q: np.ndarray, values: np.ndarray, ids: np.ndarray, slices: np.ndarray, shift: int, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the k best rows of a block for one query."""
    rows = int(np.bitwise_count(among).sum())
    if rows > k:
        weight = int(np.abs(q).sum())
        total = [np.zeros_like(among) for _ in range((weight * ((1 << SLICES) - 1)).bit_length())]
        for d in np.flatnonzero(q):
            own = slices[d] if q[d] > 0 else ~slices[d]
            size, place = abs(int(q[d])), 0
            while size >> place:
                if size >> place & 1:
                    add_slices(total, list(own), place)
                place += 1
        # what the bits left out may add to the sum: less than weight << shift, in units of 1 << shift
        boundary = select_top(total, among, k) - weight
        among = at_least(total, among, boundary)
    found = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little")[:len(values)])
    scores = values[found] @ q
    best = np.lexsort((ids[found], -scores))[:k]
    return ids[found][best], scores[best]


def large_integers(x: np.ndarray) -> list[int]:
    """floor(1024 * x), of any length; a double from 2^53 on is whole."""
    return [math.floor(c * 1024) if abs(c) < 2.0**53 else int(c) * 1024 for c in x.tolist()]


def top_of_large(q: np.ndarray, values: np.ndarray, ids: np.ndarray, among: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """Ids and exact scores of the k best of the rows `among` (numbers) for one query; both sides as doubles before the integers
    are taken."""
    def scaled(x: np.ndarray) -> tuple[np.ndarray, float]:
        """Multiples of the largest component's power of two, and how far floor(1024 x) may be from 1024 x in that unit."""
        _, e = math.frexp(float(np.abs(x).max(initial=0)))
        return np.ldexp(x, -e), math.ldexp(1.0, min(max(-e - 10, -1070), 1000))

    if len(among) > k:
        (v, one_v), (w, one_w) = scaled(values[among]), scaled(q)
        size = np.abs(v) @ np.abs(w)
        wrong = (len(q) + 4) * 2.0**-52 * size + one_v * np.abs(w).sum() + one_w * np.abs(v).sum(1) + len(q) * one_v * one_w + 1e-290
        near = v @ w
        least = np.partition(near - wrong, len(among) - k)[len(among) - k]
        among = among[near + wrong >= least]
    kinds, which = np.unique(values[among], axis=0, return_inverse=True)
    whole = large_integers(q)
    scores = [sum(a * b for a, b in zip(whole, large_integers(r))) for r in kinds]
    found = sorted((-scores[t], i) for t, i in zip(which.reshape(-1), ids[among].tolist()))[:k]
    return np.array([i for _, i in found], np.int64), [-s for s, _ in found]


def place(score: int) -> tuple[int, int | None, str]:
    """(band, score, tail), in whose order scores rise: band is 1 above all longs and -1 below, and tail orders those."""
    if -(1 << 63) <= score < 1 << 63:
        return 0, score, ""
    digits = str(abs(score))
    tail = f"{len(digits):05d}{digits}"
    return (1, None, tail) if score > 0 else (-1, None, tail.translate(str.maketrans("0123456789", "9876543210")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), key, score for every row of vectors where is_query holds."""
    given = F.col(vector)
    large = F.exists(given, lambda x: F.abs(x.cast("double")) >= LIMIT)
    plain = F.transform(given, lambda x: x.cast("double") + F.lit(0.0))
    rows = cut(vectors.where(usable(given)).select(
        F.coalesce(F.col(key).cast("long"), F.lit(NONE)).alias("id"), F.when(~large, integers(given)).alias("v"), F.when(large, plain).alias("x"),
        F.size(given).alias("d"), (F.col(key).isNotNull() & F.coalesce(is_query, F.lit(False))).alias("asks")))
    counts = rows.agg(F.count("v").alias("n"), F.count("x").alias("large"), F.count_if("asks").alias("q"), F.max("d").alias("d")).first()
    dims, sliced, rest = counts["d"] or 0, max(1, -(-counts["n"] // BLOCK)), -(-counts["large"] // BLOCK)
    blocks, tasks = sliced + rest, 2 * vectors.sparkSession.sparkContext.defaultParallelism
    wanted = -(-tasks // blocks)  # groups of parts that fill the cluster
    parts = max(1, -(-counts["q"] // QUERIES), min(counts["q"], wanted))
    groups = min(parts, max(wanted, -(-parts // PARTS)))

    def matrix(vs: pd.Series, kind: type) -> np.ndarray:
        out = np.zeros((len(vs), dims), kind)
        for i, v in enumerate(vs):
            out[i, :len(v)] = v
        return out

    def build(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("id")
        ids = b["id"].to_numpy(np.int64)
        block, bits, shift = b["block"].iloc[0], b"", 0
        if block < sliced:
            values = matrix(b["v"], np.int64)
            slices, _, shift = slice_block(values)
            values, bits = values.astype(np.int32), slices.tobytes()
        else:
            values = matrix(b["x"], np.float64)
        return pd.DataFrame({"block": [block], "n": [len(ids)], "ids": [ids.tobytes()], "vals": [values.tobytes()],
                             "slices": [bits], "shift": [shift], "nulls": [int((ids == NONE).sum())]})

    dealt = F.when(F.col("x").isNull(), F.pmod(F.xxhash64("id", "v"), F.lit(sliced))).otherwise(F.lit(sliced) + F.pmod(F.xxhash64("id", "x"), F.lit(max(rest, 1))))
    index = cut(rows.withColumn("block", dealt.cast("int")).select("block", "id", "v", "x").groupBy(
        "block").applyInPandas(build, "block int, n int, ids binary, vals binary, slices binary, shift int, nulls int"))
    asked = rows.where("asks").select("id", "v", "x").distinct()
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", "v", "x"), F.lit(parts)).cast("int")).groupBy("part").agg(
        F.collect_list(F.struct("id", "v", "x")).alias("queries"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = asked.select((F.col("part") % groups).alias("group"), "queries", every(blocks).alias("block")).repartition(blocks * groups, "block", "group")
    spread = index.select("*", every(groups).alias("group")).repartition(blocks * groups, "block", "group")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids, real, out = np.frombuffer(r.ids, np.int64), r.n - r.nulls, []
                if r.block < sliced:
                    values = np.frombuffer(r.vals, np.int32).reshape(r.n, dims).astype(np.int64)
                    slices = np.frombuffer(r.slices, np.uint64).reshape(dims, SLICES, -1)
                    doubles = None
                else:
                    doubles = np.frombuffer(r.vals, np.float64).reshape(r.n, dims)
                for q in r.queries:
                    own = slice(np.searchsorted(ids[:real], q["id"], "left"), np.searchsorted(ids[:real], q["id"], "right"))
                    large = q["x"] is not None
                    given = q["x"] if large else q["v"]
                    vec = np.zeros(dims, np.float64 if large else np.int64)
                    vec[:len(given)] = given
                    if large or r.block >= sliced:
                        if doubles is None:
                            doubles = values / 1024.0
                        among = np.delete(np.arange(r.n), np.arange(own.start, own.stop))
                        found, scores = top_of_large(vec if large else vec / 1024.0, doubles, ids, among, k)
                    else:
                        every = np.zeros(slices.shape[2] * 64 if dims else -(-r.n // 64) * 64, np.uint8)
                        every[:r.n] = 1
                        every[own] = 0
                        mask = np.packbits(every, bitorder="little").view(np.uint64)
                        found, scores = top_of_block(vec, values, ids, slices, r.shift, mask, k)
                        scores = scores.tolist()
                    placed = [place(s) for s in scores]
                    out.append(pd.DataFrame({
                        "query_id": q["id"], "qhash": xxhash.xxh3_64_intdigest(vec.tobytes()) >> 1, "vec_id": found, "band": [p[0] for p in placed],
                        "score": pd.array([p[1] for p in placed], "Int64"), "tail": pd.array([p[2] for p in placed], "string")}))
                if out:
                    yield pd.concat(out)

    found = spread.join(cells, ["block", "group"]).select("block", "queries", "n", "ids", "vals", "slices", "shift", "nulls").mapInPandas(
        search, "query_id long, qhash long, vec_id long, band int, score long, tail string")
    order = Window.partitionBy("query_id", "qhash").orderBy(F.desc("band"), F.desc("score"), F.desc("tail"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    missing = F.when(F.col("vec_id") == NONE, F.lit(None)).otherwise(F.col("vec_id"))
    return ranked.select("query_id", "rank", missing.cast("long").alias(key), "score")
