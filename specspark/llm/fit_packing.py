"""Best-fit packing of documents into sequences of several permitted lengths.

The lengths of all documents form a histogram with at most max(capacities) rows, whatever the number of documents; Spark counts
it. Best-fit decreasing then runs on the histogram with runs of equal bins instead of single bins: the longest length first, into
the open bins with the least room that still takes it, and when none is left new bins are opened. The size of new bins depends on the
length that opens them: lengths fall into classes at capacity / 1, 2, 3, 4, and the sizes of all classes are chosen jointly, for the
cost of the whole plan. The search starts from the best of: one size for all, and for each length the size that is least costly for it
alone; then a class at a time changes its size as long as the whole plan gets cheaper. A plan counts with every bin downsized to the
smallest permitted size that holds its contents. The plan that keeps every length in bins of its own is tried too, so the result is
never dearer than that. The plan is a list of steps (length, ranks, first bin, pieces a bin), and Spark deals every piece to its bin
by its rank among the pieces of equal length; ranks are dealt over chunks, so that no common length meets in one task.

The cost of a sequence of c tokens is c + c * c / QUADRATIC: attention grows with the square.
Documents longer than the largest size are cut into full sequences and a rest. Nothing is dropped or shortened.

Nulls and ties: documents without words (null, empty or blank texts) take no room and return one row with part 0, length 0 and
null bin. Null ids and repeated rows are documents like others. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specspark.llm.shared import cut, n_words, spread_rank

CAPACITIES = (512, 1024, 2048, 4096, 8192)
QUADRATIC = 16384.0
CHUNKS = 256
SWEEPS = 3  # over all classes of lengths; each class tries each size


def cost(capacity: float) -> float:
    return capacity + capacity * capacity / QUADRATIC


def _fit(histogram: list[tuple[int, int]], capacities: tuple[int, ...], opened: int | Callable[[int], int]) -> tuple[list, list]:
    """Best fit of (length, count), longest first; new bins open at `opened` (of the length, if it is a function), or at the least
    size that takes the length.
    Steps: (length, first rank, end rank, first bin, pieces a bin, offset of the first piece). Bins: (first, end, contents)."""
    room: list[int] = []  # the rooms for which there are open bins, rising
    open_bins: dict[int, list[tuple[int, int, int]]] = {}  # room -> runs of bins (first, end, size)
    steps, bins = [], 0

    def put(left: int, run: tuple[int, int, int]) -> None:
        if run[0] < run[1]:
            if left not in open_bins:
                open_bins[left] = []
                insort(room, left)
            open_bins[left].append(run)

    for length, count in histogram:
        rank = 0
        while rank < count:
            at = bisect_left(room, length)
            if at < len(room):
                left = room[at]
                first, end, size = open_bins[left].pop()
                if not open_bins[left]:
                    del open_bins[left], room[at]
            else:
                size = max(opened if isinstance(opened, int) else opened(length), capacities[bisect_left(capacities, length)])
                left = size
                first, end = bins, bins - (rank - count) // (left // length)
                bins = end
            each = left // length
            taken = min(count - rank, (end - first) * each)
            steps.append((length, rank, rank + taken, first, each, size - left))
            whole, rest = divmod(taken, each)
            put(left - each * length, (first, first + whole, size))
            put(left - rest * length, (first + whole, first + whole + (rest > 0), size))
            put(left, (first + whole + (rest > 0), end, size))
            rank += taken
    contents = [(first, end, size - left) for left, runs in open_bins.items() for first, end, size in runs]
    return steps, sorted(contents)


def _alone(length: int, capacities: tuple[int, ...]) -> int:
    """The size that costs least a token if only pieces of this length are packed."""
    return min((c for c in capacities if c >= length), key=lambda c: cost(c) / (c // length))


def _apart(histogram: list[tuple[int, int]], capacities: tuple[int, ...]) -> tuple[list, list]:
    """As _fit, every length in bins of its own."""
    steps, bins, contents = [], 0, []
    for length, count in histogram:
        own, runs = _fit([(length, count)], capacities, _alone(length, capacities))
        steps += [(n, rank, end, first + bins, each, offset) for n, rank, end, first, each, offset in own]
        contents += [(first + bins, end + bins, used) for first, end, used in runs]
        bins = max(end for _, end, _ in contents)
    return steps, contents


def plan(histogram: list[tuple[int, int]], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list, list]:
    """The steps and the runs of bins (first, end, downsized capacity) of the cheapest plan found."""
    capacities = tuple(sorted(capacities))
    histogram = sorted(histogram, reverse=True)
    bounds = sorted({c // k for c in capacities for k in (1, 2, 3, 4)})
    alone = {length: _alone(length, capacities) for length, _ in histogram}
    used = sorted({bisect_left(bounds, length) for length, _ in histogram}, reverse=True)

    def priced(steps: list, contents: list) -> tuple[float, list, list]:
        sized = [(first, end, capacities[bisect_left(capacities, held)]) for first, end, held in contents]
        return sum((end - first) * cost(size) for first, end, size in sized), steps, sized

    def tried(sizes: dict[int, int | None]) -> tuple[float, list, list]:
        """sizes: of each class, None for what is best for each length alone."""
        return priced(*_fit(histogram, capacities, lambda n: sizes[bisect_left(bounds, n)] or alone[n]))

    choices = [None, *capacities]
    best, sizes = min(((tried(s), s) for s in (dict.fromkeys(used, c) for c in choices)), key=lambda x: x[0][0])
    for _ in range(SWEEPS):
        before = best[0]
        for part in used:
            for size in choices:
                if size != sizes[part] and (found := tried(sizes | {part: size}))[0] < best[0]:
                    best, sizes = found, sizes | {part: size}
        if best[0] == before:
            break
    return min(best, priced(*_apart(histogram, capacities)), key=lambda x: x[0])[1:]


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, length: Column | None = None, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """key, part, start, length, bin_id, capacity, bin_offset: one row for each piece of each document. length: tokens of a
    document, by default the words of `text`; start: first token of the piece in its document."""
    top = max(capacities)
    sized = docs.select(F.col(key).alias("_id"), F.xxhash64(key, text).alias("_h"),
                        (n_words(F.col(text)) if length is None else length).alias("_n"))
    ends = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_n") / top) - 1, F.lit(0)).cast("int"))
    pieces = cut(sized.select("_id", "_h", "_n", F.explode(ends).alias("part")).select(
        "_id", "part", (F.col("part").cast("long") * top).alias("start"),
        F.least(F.lit(top), F.col("_n") - F.col("part").cast("long") * top).cast("int").alias("length"),
        F.xxhash64("_h", "part").alias("_h")))
    # at most max(capacities) rows
    histogram = [(r.length, r["count"]) for r in pieces.where("length > 0").groupBy("length").count().collect()]
    steps, bins = plan(histogram, capacities)
    step = np.array(steps, dtype=np.int64).reshape(-1, 6)
    step = step[np.lexsort((step[:, 1], step[:, 0]))]
    run = np.array(bins, dtype=np.int64).reshape(-1, 3)
    width = int(step[:, 2].max(initial=0)) + 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = step[:, 0] * width + step[:, 1]
        for b in batches:
            size, rank = b["length"].to_numpy().astype(np.int64), b["_rank"].to_numpy()
            s = step[np.searchsorted(keys, size * width + rank, "right") - 1]
            nth = rank - s[:, 1]
            bin_id = s[:, 3] + nth // s[:, 4]
            capacity = run[np.searchsorted(run[:, 0], bin_id, "right") - 1, 2]
            yield b.drop(columns="_rank").assign(bin_id=bin_id, capacity=capacity.astype(np.int32),
                                                 bin_offset=(s[:, 5] + nth % s[:, 4] * size).astype(np.int32))

    ranked = spread_rank(pieces.where("length > 0"), ["length"], ["_h", "_id"], "_h", CHUNKS, out="_rank").select(
        "_id", "part", "start", "length", F.col("_rank").cast("long"))
    kind = dict(docs.dtypes)[key]
    packed = ranked.mapInPandas(place, f"_id {kind}, part int, start long, length int, bin_id long, capacity int, bin_offset int")
    none = pieces.where("length = 0").select(
        "_id", "part", "start", "length", F.lit(None).cast("long").alias("bin_id"), F.lit(0).alias("capacity"),
        F.lit(None).cast("int").alias("bin_offset"))
    return packed.unionByName(none).withColumnRenamed("_id", key)
