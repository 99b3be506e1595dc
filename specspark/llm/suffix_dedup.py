"""Exact removal of repeated strings with suffix arrays built by induced sorting. LENGTH below stands for the parameter `length`.

Every string of LENGTH bytes holds an anchor that depends on the string alone: its rightmost least hash of GRAM bytes. Documents
name their anchors, with LENGTH - GRAM bytes of context on both sides as the anchor's segment; strings that are equal lie in
segments of equal anchors. Segments of equal content are one class before anything is sorted; a class seen twice is repeated
whole. A segment's strings fall into PARTS ranges by the place of the anchor in them, and all strings of a range hold its core; only
the ranges whose core another class has too are looked at further. They go to a shard by their anchor, and each shard

  1. classifies its suffixes, sorts the leftmost-smaller (LMS) substrings by induction, names them, and orders the shorter
     string of names by doubling their ranks (only as far as LENGTH),
  2. induces the order of all suffixes from the LMS suffixes in two passes over the buckets, linear in the shard,
  3. computes the permuted common prefixes: lengths where the preceding bytes differ, the others by counting down,
  4. marks the suffixes that agree with a neighbour of another origin over LENGTH bytes.

The passes run over whole buckets at a time in numpy, so their cost is a few array operations a byte. An anchor with a core
in more than CROWD classes (a passage in very many documents), or with classes of more than ANCHOR_BYTES, would not fit a shard. The exact way for those: their strings fall into finer ranges of
FINE places, equal ranges become one class again, and only ranges that are not whole, with a core in common, are counted string
by string, pre-aggregated and dealt by string. Marked runs return to all members of a class and are united per document.

Nulls and ties: null texts are empty. Null ids are documents of their own like others, and so are repeated rows, so a repeated
row of LENGTH bytes or more goes wholly. Shorter texts stay. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specspark.llm.shared import cut

LENGTH, GRAM = 400, 32
PARTS, FINE = 4, 23
CROWD = 8192
SHARD_BYTES, ANCHOR_BYTES, BATCH_BYTES = 1 << 20, 4 << 20, 1 << 18
_M = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of _M (modulo 2 ** 64), and those of its inverse."""
    out = []
    for base in (int(_M), pow(int(_M), -1, 1 << 64)):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _sums(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums of all beginnings of the text, and the factors that make the difference of two a hash of the bytes between."""
    up, down = _powers(max(2 * BATCH_BYTES, len(text) + 1))  # mostly the same ones
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _MIX * up[:len(text)], out=sums[1:])
    return sums, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(32))


def gram_hashes(text: np.ndarray, sums: np.ndarray | None = None, down: np.ndarray | None = None) -> np.ndarray:
    """Hash of the GRAM bytes from each position. sums, down: those of the text, if known."""
    if sums is None:
        sums, down = _sums(text)
    return _mixed((sums[GRAM:] - sums[:-GRAM]) * down[:max(0, len(text) - GRAM + 1)])


def anchors(h: np.ndarray, wide: int, inside: np.ndarray | None = None) -> np.ndarray:
    """Positions of the rightmost least hash of every window of `wide` hashes. inside: the windows that count (their starts), all
    by default; with it no hash may be 0."""
    if len(h) < wide:
        return np.empty(0, np.int64)
    # the least of a window, by doubling
    least, step = h, 1
    while step * 2 <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:len(h) - wide + 1], least[wide - step:])
    if inside is not None:
        least *= inside
    # a hash is the least of a window if no window that holds it has a smaller one: the greatest of their least hashes is its own
    held, step = np.zeros(len(least) + 2 * (wide - 1), h.dtype), 1
    held[wide - 1:wide - 1 + len(least)] = least
    while step * 2 <= wide:
        held = np.maximum(held[:-step], held[step:])
        step *= 2
    found = np.flatnonzero(h == np.maximum(held[:len(h)], held[wide - step:]))
    # equal hashes in one window: only its last place counts
    order = found[np.argsort(h[found], kind="stable")]
    own = h[order]
    tied = np.unique(own[1:][(own[1:] == own[:-1]) & (order[1:] - order[:-1] < wide)])
    if not len(tied):
        return found
    number = lambda x: np.minimum(np.searchsorted(tied, x), len(tied) - 1)
    heads = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))  # windows in a row with one least hash
    size = np.diff(np.append(heads, len(least)))
    size[tied[number(least[heads])] != least[heads]] = 0
    windows = np.repeat(heads - np.cumsum(size) + size, size) + np.arange(size.sum())
    held_by, places = number(least[windows]), order[tied[number(own)] == own]
    rising = number(h[places]) * (len(h) + 1) + places  # by hash, then place
    last = places[np.searchsorted(rising, held_by * (len(h) + 1) + windows + wide - 1, "right") - 1]
    return np.union1d(found[tied[number(h[found])] != h[found]], last)


def _edges(length: int) -> list[int]:
    """The ranges of an anchor's place in a string: edges[j] up to edges[j + 1] - 1."""
    return [(length - GRAM + 1) * j // PARTS for j in range(PARTS + 1)]


def _core(text: bytes, p: int, near: int, far: int, size: int, length: int) -> int | None:
    """Hash of what all strings share that hold the anchor p at places near .. far, None if none of them is in the text."""
    if max(near, p + length - size) > min(far, p):
        return None
    x = xxhash.xxh3_64_intdigest(text[p - near:p - far + length])
    return (x & 0xFFFFFFFF) - (1 << 31)


def segments(text: np.ndarray, first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of documents laid end to end in text, each from its `first` byte: number of the document, anchor, hash of the segment,
    anchor's position in the document, size of the segment, hashes of the cores of its ranges and which of them are."""
    sums, down = _sums(text)
    grams, reach, edges = gram_hashes(text, sums, down), length - GRAM, _edges(length)
    inside = np.ones(max(0, len(grams) - reach), bool)
    for end in first[1:].tolist():
        inside[max(0, end - length + 1):end] = False
    at = anchors((grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1), reach + 1, inside)
    doc = np.searchsorted(first, at, "right") - 1
    p, size = at - first[doc], np.diff(np.append(first, len(text)))[doc]
    lo, hi = np.maximum(at - p, at - reach), np.minimum(at - p + size, at + length)
    raw = memoryview(text)
    hashes = [xxhash.xxh3_64_intdigest(raw[a:b], seed) for a, b, seed in zip(lo.tolist(), hi.tolist(), (at - lo).tolist())]
    cores, held = np.zeros((len(at), PARTS), np.int32), np.zeros((len(at), PARTS), bool)
    for j in range(PARTS):
        near, far = edges[j], edges[j + 1] - 1  # as in _core
        held[:, j] = np.maximum(near, p + length - size) <= np.minimum(far, p)
        a = at[held[:, j]]
        cores[held[:, j], j] = _mixed((sums[a - far + length] - sums[a - near]) * down[a - near]).astype(np.uint32).view(np.int32)
    return doc, grams[at].view(np.int64), np.array(hashes, np.uint64).view(np.int64), p, hi - lo, cores, held


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---- the suffix array of a shard -------------------------------------------------------------------------------------------------

def _kinds(t: np.ndarray) -> np.ndarray:
    """True for smaller (S) suffixes: less than the next one. The last suffix counts as S."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])
    smaller = np.zeros(n, bool)
    following = np.zeros(n, np.int64)  # the first change at or after each position
    np.cumsum(t[1:] != t[:-1], out=following[1:])
    inside = following < len(change)
    at = change[following[inside]]
    smaller[inside] = t[at] < t[at + 1]
    smaller[~inside] = True
    return smaller


def _induce(t: np.ndarray, smaller: np.ndarray, size: int, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, induced from lms (the LMS suffixes in order): larger ones from the front, then smaller from the back."""
    n = len(t)
    chars = t[lms]
    cut_at = np.searchsorted(chars, np.arange(size + 1))
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]

    larger_t = np.where(smaller, 0, t)  # 0, or size below, for suffixes of the other kind and for separators
    smaller_t = np.where(smaller & (t > 0), t, size).astype(t.dtype)

    def deal(found: np.ndarray, c: np.ndarray, into: list[list[np.ndarray]]) -> None:
        if len(found):
            order = np.argsort(c, kind="stable")
            c, found = c[order], found[order]
            edges = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            for a, b in zip(edges, [*edges[1:], len(c)]):
                into[c[a]].append(found[a:b])

    # before position 0 stands the last one, a separator
    for c in range(size):
        waves = larger[c]
        own = np.concatenate(waves) if waves else np.empty(0, np.int64)
        parts, wave = [own], own
        while len(wave):
            p = wave - 1
            wave = p[larger_t[p] == c]
            parts.append(wave)
        larger[c] = [np.concatenate(parts)]
        p = np.concatenate((larger[c][0], lms[cut_at[c]:cut_at[c + 1]])) - 1
        before = larger_t[p]
        keep = before > c
        deal(p[keep], before[keep], larger)
    smaller_of: list[list[np.ndarray]] = [[] for _ in range(size)]  # in falling order
    out: list[np.ndarray] = []
    for c in range(size - 1, -1, -1):
        own = np.concatenate(smaller_of[c]) if smaller_of[c] else np.empty(0, np.int64)
        if c == 0:  # separators are S, and in order already
            own = lms[cut_at[0]:cut_at[1]][::-1]
        parts, wave = [own], own
        while len(wave) and c:
            p = wave - 1
            wave = p[smaller_t[p] == c]
            parts.append(wave)
        falling = np.concatenate(parts)
        out.append(larger[c][0])
        out.append(falling[::-1])
        p = np.concatenate((falling, larger[c][0][::-1])) - 1
        before = smaller_t[p]
        keep = before < c
        deal(p[keep], before[keep], smaller_of)
    pairs = [np.concatenate((out[i], out[i + 1])) for i in range(0, len(out), 2)]
    return np.concatenate(pairs[::-1]) if n else np.empty(0, np.int64)


def _name(t: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of sorted LMS substrings; equal ones share a rank. ends: where each substring ends (the next LMS position)."""
    a, b = order[:-1], order[1:]
    size = ends - order
    same = (size[:-1] == size[1:]) & (t[a] != 0)
    live, step = np.flatnonzero(same), 0
    while len(live):
        x, y = t[a[live] + step], t[b[live] + step]
        ok = (x == y) & (x != 0)
        same[live[~ok]] = False
        step += 1
        live = live[ok & (step <= size[:-1][live])]
    return np.concatenate(([0], np.cumsum(~same)))


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of t in order, over `depth` symbols at least. t ends with 0; a 0 is a separator, and separators differ from each
    other (the earlier is the smaller)."""
    n, size = len(t), int(t.max(initial=0)) + 1
    smaller = _kinds(t)
    smaller[t == 0] = True
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    is_lms[t == 0] = True
    lms = np.flatnonzero(is_lms)
    by_char = lms[np.argsort(t[lms], kind="stable")]
    rough = _induce(t, smaller, size, by_char)
    order = rough[is_lms[rough]]
    place = np.zeros(n, np.int64)
    place[lms] = np.arange(len(lms))
    nth = place[order]
    ends = np.append(lms[1:], n - 1)[nth]
    rank = np.empty(len(lms), np.int64)
    rank[nth] = _name(t, order, ends)
    # the string of names: ranks double their reach; a separator's rank is unique, so no reach crosses one. LMS positions are
    # two apart at least, but for separators
    step, by_rank = 1, nth
    while rank.max(initial=0) + 1 < len(rank) and step <= depth // 2:
        second = np.append(rank[step:], np.full(min(step, len(rank)), -1))[:len(rank)]
        key = rank * (len(rank) + 1) + second + 1
        by_rank = by_rank[np.argsort(key[by_rank], kind="stable")]  # in order already but for second
        rising = key[by_rank]
        rank = np.empty_like(rank)
        rank[by_rank] = np.concatenate(([0], np.cumsum(rising[1:] != rising[:-1])))
        step *= 2
    return _induce(t, smaller, size, lms[by_rank])


def permuted_prefixes(text: np.ndarray, left: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each position's suffix with the one before it in order, 0 for positions that order leaves out. left: bytes
    to the end of the own segment."""
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    at = np.sort(order)
    prior = before[at]
    has = prior >= 0
    counted = np.zeros(len(at), bool)
    if len(at):
        x, y = at[1:], prior[1:]
        counted[1:] = (at[:-1] == x - 1) & (y > 0) & (prior[:-1] == y - 1)
        near = np.flatnonzero(counted)
        x, y = at[near] - 1, prior[near] - 1
        counted[near] = (left[x] > 0) & (left[y] > 0) & (text[x] == text[y])
    out = np.zeros(len(at), np.int64)
    lone = np.flatnonzero(has & ~counted)
    limit = np.minimum(left[at[lone]], left[prior[lone]])
    words = np.ndarray(n + 1, "<u8", np.append(text, np.zeros(8, np.uint8)), strides=(1,))  # eight bytes from each position
    live, reach = np.arange(len(lone)), np.zeros(len(lone), np.int64)
    while len(live):
        x, y = at[lone[live]] + reach[live], prior[lone[live]] + reach[live]
        other = words[np.minimum(x, n)] ^ words[np.minimum(y, n)]
        gain = np.where(other == 0, 8, np.bitwise_count((other & (~other + np.uint64(1))) - np.uint64(1)) // 8).astype(np.int64)
        reach[live] += gain
        live = live[(gain == 8) & (reach[live] < limit[live])]
    out[lone] = np.minimum(reach, limit)
    # PLCP[i] = PLCP[i - 1] - 1 where the bytes before agree
    base = np.maximum.accumulate(np.where(counted, -1, np.arange(len(at)))) if len(at) else at
    fill = np.flatnonzero(counted & (base >= 0))
    out[fill] = np.maximum(out[base[fill]] - (fill - base[fill]), 0)
    out[~has] = 0
    common = np.zeros(n, np.int64)
    common[at] = np.minimum(out, np.minimum(left[at], np.where(has, left[prior], 0)))
    return common


def repeated_starts(pieces: list[bytes], origin: np.ndarray, many: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For every piece the starts of strings of `length` bytes that occur at another origin too. origin: global number of each
    piece's first byte; many: pieces that stand for several."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    t = text.astype(np.int16) + 1
    t[first + sizes] = 0
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    left = np.repeat(first + sizes, sizes + 1) - np.arange(len(text))
    order = suffix_array(t, length)
    order = order[(left >= length)[order]]  # shorter suffixes start no string
    if not len(order):
        return [order] * len(pieces)
    long_ = permuted_prefixes(text, left, order)[order] >= length
    group, owner = np.cumsum(~long_), piece[order]
    place = (origin - first)[owner] + order
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    spread = np.maximum.reduceat(place, edges) != np.minimum.reduceat(place, edges)
    several = np.maximum.reduceat(many[owner], edges)
    hit = np.sort(order[(spread | several)[group - group[0]]])
    return [hit[np.searchsorted(hit, f):np.searchsorted(hit, f + s)] - f for f, s in zip(first, sizes)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of the strings of `length` bytes from rising starts."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.concatenate(([0], gap + 1))].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist()))


# ---- the job -----------------------------------------------------------------------------------------------------------------------

RUNS = "array<struct<a:int,b:int>>"


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, laid end to end, and where each text starts (and the last one ends)."""
    column = column.cast(pa.large_binary())
    _, edges, values = column.buffers()
    edges = np.frombuffer(edges, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(values, np.uint8) if values else np.empty(0, np.uint8), edges


def _found_anchors(docs: DataFrame, length: int) -> DataFrame:
    """One row for each (document, anchor, segment): doc, anchor, segment, places, size of the segment, cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, (text, edge) = b.column(0).to_numpy(zero_copy_only=False), _text_bytes(b.column(1))
            at = 0
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(edge, edge[at] + BATCH_BYTES, "right")) - 1)
                doc, anchor, segment, place, size, cores, held = segments(
                    text[edge[at]:edge[to]], edge[at:to] - edge[at], length)
                if len(doc):
                    order = np.lexsort((place, segment, anchor, doc))
                    d, a, s = doc[order], anchor[order], segment[order]
                    heads = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (s[1:] != s[:-1]))))
                    one = order[heads]
                    places = pa.ListArray.from_arrays(pa.array(np.append(heads, len(order)), pa.int32()), pa.array(place[order], pa.int32()))
                    parts = pa.ListArray.from_arrays(pa.array(np.arange(len(one) + 1) * PARTS, pa.int32()),
                                                     pa.array(cores[one].ravel(), pa.int32(), mask=~held[one].ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at:to][doc[one]], pa.int64()), pa.array(anchor[one]), pa.array(segment[one]), places,
                         pa.array(size[one], pa.int32()), parts], ["doc", "anchor", "segment", "places", "size", "cores"])
                at = to

    return docs.select("doc", "text").mapInArrow(
        run, "doc long, anchor long, segment long, places array<int>, size int, cores array<int>")


def _shared_ranges(classes: DataFrame) -> DataFrame:
    """classes with part_lo, part_hi (the ranges whose core another class has too) and crowd; the others are left out."""
    kinds = cut(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor"))
    mixed = cut(classes.join(kinds, "anchor"))
    each = mixed.select("anchor", "segment", F.posexplode("cores").alias("part", "core")).where("core is not null")
    common = cut(each.groupBy("anchor", "part", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    active = each.join(common, ["anchor", "part", "core"]).groupBy("anchor", "segment").agg(
        F.min("part").alias("part_lo"), F.max("part").alias("part_hi"))
    # all classes of an anchor go the same way, as any two of them may share a string
    held = mixed.groupBy("anchor").agg(F.sum("size").alias("held"))
    crowds = common.groupBy("anchor").agg(F.max("n").alias("most")).join(held, "anchor").select(
        "anchor", ((F.col("most") > CROWD) | (F.col("held") > ANCHOR_BYTES)).alias("crowd"))
    return mixed.join(active, ["anchor", "segment"]).join(cut(crowds), "anchor")


def _class_bytes(classes: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """classes with the bytes of their ranges, rel (their first byte, from the anchor) and lo, its number: bytes of the corpus are
    numbered from the document's hash, and all that counts is whether two numbers are equal."""
    wanted = classes.groupBy(F.col("rep").alias("doc")).agg(
        F.collect_list(F.struct("anchor", "segment", "place", "many", "crowd", "part_lo", "part_hi")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(_edges(length))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                (text, edge), wanted = _text_bytes(b.column(0)), b.column(1)
                rows, raw = wanted.flatten(), memoryview(text)
                doc = np.repeat(np.arange(b.num_rows), wanted.value_lengths().to_numpy())
                place, part_lo, part_hi = (rows.field(n).to_numpy().astype(np.int64) for n in ("place", "part_lo", "part_hi"))
                lows = np.maximum(place - (edges[part_hi + 1] - 1), 0)
                size = edge[doc + 1] - edge[doc]
                ends = np.minimum(place - edges[part_lo] + length, size)
                cuts = zip((edge[doc] + lows).tolist(), (edge[doc] + ends).tolist())
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(n) for n in ("anchor", "segment", "many", "crowd")), pa.array(lows - place, pa.int32()),
                     pa.array(b.column(2).to_numpy()[doc] + lows), pa.array([bytes(raw[x:y]) for x, y in cuts], pa.binary())],
                    ["anchor", "segment", "many", "crowd", "rel", "lo", "bytes"])

    once = docs.groupBy("doc").agg(F.first("text").alias("text"))  # of repeated rows one
    return once.join(wanted, "doc").select("text", "wanted", "doc").mapInArrow(
        run, "anchor long, segment long, many boolean, crowd boolean, rel int, lo long, bytes binary")


def _sorted_runs(pieces: DataFrame, total: int, length: int) -> DataFrame:
    """anchor, segment, runs (from the anchor): repeated runs of the classes, from the suffix arrays of shards."""
    shards = max(1, -(-total // SHARD_BYTES))

    def build(b: pd.DataFrame) -> pd.DataFrame:
        starts = repeated_starts(b["bytes"].tolist(), b["lo"].to_numpy(), b["many"].to_numpy(), length)
        runs = [[{"a": x + r, "b": y + r} for x, y in _runs(s, length)] for s, r in zip(starts, b["rel"].tolist())]
        return pd.DataFrame({"anchor": b["anchor"], "segment": b["segment"], "runs": runs})[[bool(r) for r in runs]]

    return pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(
        build, f"anchor long, segment long, runs {RUNS}")


def _fine(raw: bytes, rel: int, length: int) -> Iterator[tuple[int, int, int, int, int | None]]:
    """The fine ranges of a piece: number, least and greatest place of the anchor in its strings, hash of all of it, hash of the core."""
    near, far = -(rel + len(raw) - length), -rel
    for q in range(max(near, 0) // FINE, far // FINE + 1):
        lo, hi = max(near, q * FINE), min(far, q * FINE + FINE - 1)
        if lo <= hi:
            part = xxhash.xxh3_64_intdigest(raw[-rel - hi:-rel - lo + length], seed=hi)
            yield q, lo, hi, _signed(part), _core(raw, -rel, q * FINE, q * FINE + FINE - 1, len(raw), length)


def _counted_runs(pieces: DataFrame, length: int) -> DataFrame:
    """The same for the classes of crowded cores: finer ranges, and single strings of those that are not whole."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(a, s, m, *f) for a, s, m, r, raw in zip(*(c.to_pylist() for c in b.columns)) for f in _fine(raw, r, length)]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["anchor", "segment", "many", "q", "near", "far", "part", "core"])

    fine = cut(pieces.select("anchor", "segment", "many", "rel", "bytes").mapInArrow(
        split, "anchor long, segment long, many boolean, q int, near int, far int, part long, core int"))
    parts = cut(fine.groupBy("anchor", "q", "part").agg(
        F.min("segment").alias("segment"), F.first("core").alias("core"), ((F.count(F.lit(1)) > 1) | F.max("many")).alias("several")))
    common = cut(parts.groupBy("anchor", "q", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    todo = parts.join(common, ["anchor", "q", "core"]).groupBy("anchor", "segment").agg(
        F.collect_list(F.struct("q", "part", "several")).alias("todo"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, lo, rel, raw, wanted in zip(*(c.to_pylist() for c in b.columns)):
                own = {q: (near, far) for q, near, far, _, _ in _fine(raw, rel, length)}
                rows = [(anchor, w["q"], w["part"], w["several"], o, xxhash.xxh3_128_digest(raw[-rel - o:-rel - o + length]))
                        for w in wanted for o in range(own[w["q"]][0], own[w["q"]][1] + 1)]
                c = list(zip(*rows))
                both = np.frombuffer(b"".join(c[5]), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.bool_()),
                     pa.array(c[4], pa.int32()), pa.array(np.int64(lo) - np.int64(rel) - np.array(c[4], np.int64)),
                     pa.array(both[:, 0]), pa.array(both[:, 1])], ["anchor", "q", "part", "several", "o", "origin", "x", "y"])

    each = cut(pieces.join(todo, ["anchor", "segment"]).select("anchor", "lo", "rel", "bytes", "todo").mapInArrow(
        strings, "anchor long, q int, part long, several boolean, o int, origin long, x long, y long"))
    again = cut(each.groupBy("x", "y").agg(F.min("origin").alias("lo"), F.max("origin").alias("hi"), F.max("several").alias("any")).where(
        "lo <> hi OR any").select("x", "y"))
    single = each.where("not several").join(again, ["x", "y"]).groupBy("anchor", "q", "part").agg(F.collect_list("o").alias("o"))
    known = cut(parts.select("anchor", "q", "part", "several").join(single, ["anchor", "q", "part"], "left").where("several OR o is not null"))
    run = lambda near, far: F.struct((-far).alias("a"), (F.lit(length) - near).alias("b"))
    runs = F.when(F.col("several"), F.array(run(F.col("near"), F.col("far")))).otherwise(F.transform("o", lambda o: run(o, o)))
    return fine.join(known, ["anchor", "q", "part"]).select("anchor", "segment", runs.alias("r")).groupBy("anchor", "segment").agg(
        F.flatten(F.collect_list("r")).alias("runs"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, spans (rising, of bytes): what repeats in each document that has any. docs: doc (equal for repeated rows only), text."""
    found = cut(_found_anchors(docs, length))
    first = F.min(F.struct("doc", F.col("places")[0].alias("place"), "size")).alias("first")
    classes = cut(found.groupBy("anchor", "segment").agg(F.sum(F.size("places")).alias("times"), first, F.first("cores").alias("cores")).select(
        "anchor", "segment", (F.col("times") > 1).alias("many"), F.col("first.doc").alias("rep"), F.col("first.place").alias("place"),
        F.col("first.size").alias("size"), "cores"))
    pieces = cut(_class_bytes(_shared_ranges(classes), docs, length))
    sizes = pieces.groupBy("crowd").agg(F.sum(F.length("bytes")).alias("n")).collect()
    runs = _sorted_runs(pieces.where("not crowd"), sum(r["n"] for r in sizes if not r["crowd"]), length)
    if any(r["crowd"] for r in sizes):
        runs = runs.unionByName(_counted_runs(pieces.where("crowd"), length))
    lead = -F.least("place", F.lit(length - GRAM))
    whole = classes.where("many").select("anchor", "segment", F.array(F.struct(lead.alias("a"), (lead + F.col("size")).alias("b"))).alias("runs"))
    some = runs.join(classes.select("anchor", "segment", "many"), ["anchor", "segment"]).where("not many").select("anchor", "segment", "runs")
    known = cut(whole.unionByName(some))
    at = lambda p: F.transform("runs", lambda r: F.struct((p + r["a"]).alias("a"), (p + r["b"]).alias("b")))
    spans = found.select("doc", "anchor", "segment", "places").join(known, ["anchor", "segment"]).select(
        "doc", F.flatten(F.transform("places", at)).alias("spans"))
    return spans.groupBy("doc").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def _kept(raw: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What stays of raw, and the number of maximal removed runs."""
    if not spans:
        return raw, 0
    out, at, runs, end = [], 0, 0, -1
    for s in spans:
        if s["a"] > end:
            out.append(raw[at:s["a"]])
            runs += 1
        end = max(end, s["b"])
        at = end
    return b"".join([*out, raw[at:]]), runs


def without_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, length: int = LENGTH) -> DataFrame:
    """row (struct of the columns `carry`, all by default), n_bytes, n_removed, n_spans, kept (binary), kept_text (kept without the
    parts of characters that a seam leaves): every row of docs without the bytes of strings of `length` bytes (2 * GRAM at least) that
    repeat anywhere. A row is known by a 64-bit hash of its columns `carry` and text."""
    carry = docs.columns if carry is None else carry
    whole = docs.select(F.xxhash64(*carry, text).alias("doc"), F.struct(*[c for c in carry if c != text]).alias("row"),
                        F.coalesce(text, F.lit("")).alias("text"))
    spans = repeated_spans(whole.select("doc", "text"), length)
    joined = whole.join(spans, "doc", "left").select("row", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, removed, runs, kept = [], [], [], []
            for raw, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = raw.encode("utf-8", "surrogatepass")
                rest, n = _kept(raw, own)
                size.append(len(raw))
                removed.append(len(raw) - len(rest))
                runs.append(n)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
                                              pa.array([rest.decode("utf-8", "ignore") for rest in kept], pa.string())],
                                             ["row", "n_bytes", "n_removed", "n_spans", "kept", "kept_text"])

    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {row}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string")


def shortened(docs: DataFrame, text: str = "text", count: str = "n_chars", length: int = LENGTH) -> DataFrame:
    """docs with what stays of each text, columns as they came; `count`, where there is such a column, follows. Parts of
    characters left at a seam go too. Null texts become empty."""
    rest = without_repeats(docs, text, length=length)
    values = {text: F.col("kept_text")}
    if count in docs.columns:
        values[count] = F.char_length(values[text]).cast(docs.schema[count].dataType)
    return rest.select(*[values.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
