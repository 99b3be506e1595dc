"""Near-duplicate groups by circulant MinHash.

A document is the set of its distinct word shingles (64-bit hashes of them). One bijection of the 32-bit universe scatters the
set; a second one, circularly shifted by k = 1 .. K, gives coordinate k of the signature: min over the set of
permuted(scattered - k). Two permutations in all, not K. BANDS bands of ROWS coordinates make buckets; a pair at similarity 0.8
misses all of them with probability (1 - 0.8^5)^32 = 3e-6.

Equal sets become one class before anything is paired. In a bucket the classes are not paired with each other: leaders are compared
with all members, and a bucket is done when all its members are connected. In each round the parts of a bucket, FANOUT times as many as before, name a
leader each; before the first round the buckets of the EARLY first bands alone go through this, so that copies of one text, which share
most of their buckets, are connected before they are compared in all of them; later only among the members outside the bucket's largest component, and only members of other
components are compared with it. So every pair of a bucket is either compared or already connected at the end, and a bucket of
copies ends after one round. A bucket
that still holds more than CROWD classes then is one of texts that share a passage without being alike; its classes are dealt
anew, without loss, by their rarest shingles: sets at similarity t have one in common among the n - ceil(t n) + 1 that are rarest
in each; shingles that only one of them has, and the place of the bucket among a text's shingles, bound what it can share. Of buckets that hold
the same classes one is kept. Each set has a parity sketch: SKETCH bits, a shingle flips one of them. Two sets differ in as many shingles at least as
their sketches in bits, so pairs whose sketches differ too much are no candidates; that loses no link. Compared pairs are confirmed on the full sets with 100 * intersection >= percent * union. Components spread the least
label along links, with pointer jumping, one written table a step.

Nulls and ties: texts that are null, empty or blank have an empty set and are linked with nothing, not even with each other. Rows with
equal ids are documents of their own; the component of a document is the least id reachable (null if all are null), and a null id
is not kept by `groups`. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.llm.shared import cut, few, maybe_broadcast

BANDS, ROWS = 32, 5
CROWD = 8
EARLY = 4  # bands that are compared before all others
FANOUT = 64
SKETCH = 512  # bits, a multiple of 64; sets of up to some thousand shingles are told apart
FEW = 200_000  # rows of a table of short rows that is broadcast
BLOCK = 1 << 15
VOCABULARY = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
#: The schema of signatures(), after the key; text_hash tells rows of equal ids apart.
SIGNED = "text_hash long, n_shingles long, node binary, bands array<long>"


class _Words(dict):
    """64-bit hashes of words; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, known: _Words, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of the whole sequence if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    span = min(n, width)
    total = np.full(n - span + 1, span, np.uint64)
    for j in range(span):
        total += h[j:n - span + 1 + j] * (_ODD[j % 8] + np.uint64(2 * (j // 8)))
    return np.unique(_mix(total))


def _permute(x: np.ndarray, spare: np.ndarray) -> None:
    """A bijection of 32-bit numbers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def circulant_signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of `size` coordinates for each (non-empty) set."""
    out = np.full((len(sets), size), np.iinfo(np.uint32).max, np.uint32)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= BLOCK):
            total += len(sets[end])
            end += 1
        joined = np.concatenate(sets[at:end])
        for lo in range(0, total, BLOCK):  # more than one turn only for a set larger than a block
            scattered = (_mix(joined[lo:lo + BLOCK] ^ _ODD[5]) >> np.uint64(32)).astype(np.uint32)
            starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[at:end - 1]]))).astype(np.intp) if end - at > 1 else np.zeros(1, np.intp)
            x, spare = np.empty_like(scattered), np.empty_like(scattered)
            for k in range(size):
                np.subtract(scattered, np.uint32(k + 1), out=x)
                _permute(x, spare)
                np.minimum(out[at:end, k], np.minimum.reduceat(x, starts), out=out[at:end, k])
        at = end
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band, the number of the band mixed in."""
    cells = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[6], (len(signatures), bands)).copy()
    for j in range(rows):
        keys = _mix(keys + cells[:, :, j] * _ODD[7])
    return keys.view(np.int64)


def signatures(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """key, text_hash, n_shingles, node (hash of the whole set, null for an empty one), bands."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets = [shingle_set(t, known, width) for t in part.column(1).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = band_keys(circulant_signatures([sets[i] for i in full], bands * rows), bands, rows)
                bands_of, node = [[]] * len(sets), [None] * len(sets)
                for i, k in zip(full, keys):
                    bands_of[i], node[i] = k, xxhash.xxh3_128_digest(sets[i].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()),
                     pa.array(bands_of, pa.list_(pa.int64()))], [key, "text_hash", "n_shingles", "node", "bands"])

    return docs.select(key, text, F.xxhash64(text)).mapInArrow(run, f"`{key}` {kind}, {SIGNED}")


def parity_sketch(found: np.ndarray) -> np.ndarray:
    """SKETCH bits as signed 64-bit words; each element of the set flips one of them."""
    return np.packbits(np.bincount((found & np.uint64(SKETCH - 1)).astype(np.intp), minlength=SKETCH).astype(np.uint8) & 1).view(np.int64)


def sketch_distance(a: str, b: str) -> Column:
    """In how many bits two sketches differ: no more than their sets differ in elements."""
    return reduce(add, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH // 64)]).cast("long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (u, v) whose full sets are alike enough. sets: node, s, one row a node."""
    both = F.size(F.array_intersect("su", "sv"))
    of_u, of_v = (sets.select(F.col("node").alias(end), F.col("s").alias(f"s{end}")) for end in "uv")
    if few(pairs, FEW):  # only the sets of the pairs are moved
        met = of_u.join(F.broadcast(pairs), "u").join(of_v.join(F.broadcast(pairs), "v"), ["u", "v"])
    else:
        met = pairs.join(of_u, "u").join(of_v, "v")
    return met.where(100 * both >= percent * (F.size("su") + F.size("sv") - both)).select("u", "v")


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the labels lu and lv of their ends; a node without one is its own."""
    a = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
    b = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
    return pairs.join(a, "u", "left").join(b, "v", "left").select(
        "u", "v", F.coalesce("lu", "u").alias("lu"), F.coalesce("lv", "v").alias("lv"))


def spread_labels(edges: DataFrame, labels: DataFrame | None) -> DataFrame:
    """node, label for every node of edges and labels: the least node reachable. labels: what earlier edges gave."""
    if labels is not None:  # edges between what is already one component need no walk
        edges = _between(edges, labels).select(F.col("lu").alias("u"), F.col("lv").alias("v")).where("u != v").distinct()
    both = cut(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    now = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")).select("node", F.least("node", "least").alias("label")))
    while True:
        near = both.join(now.select(F.col("node").alias("u"), "label"), "u").select(
            F.col("v").alias("node"), "label", F.lit(None).cast("binary").alias("was"))
        spread = cut(near.unionByName(now.withColumn("was", F.col("label"))).groupBy("node").agg(
            F.min("label").alias("label"), F.max("was").alias("was")))
        jump = spread.select(F.col("node").alias("label"), F.col("label").alias("far"))
        after = cut(spread.join(jump, "label").select("node", F.col("far").alias("label"), "was"))
        now = after.select("node", "label")
        if after.where("label != was").isEmpty():
            break
    if labels is None:
        return now
    moved = now.select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    fresh = now.join(labels.select("node"), "node", "left_anti")
    return cut(old.unionByName(fresh))


def class_sets(signed: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """node, s, sketch: the full set of each class in nodes, from the text of one of its documents."""
    reps = cut(signed.select("node", F.struct(F.col(key).alias("id"), "text_hash").alias("at")).join(nodes, "node").groupBy(
        "node").agg(F.min("at").alias("at")).select("node", "at.*"))
    whole = docs.select(F.col(key).alias("own"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    found = whole.join(maybe_broadcast(reps, FEW), whole["own"].eqNullSafe(reps["id"]) & (whole["hash"] == reps["text_hash"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for b in batches:
            sets = [shingle_set(t, known, width) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64()))], ["node", "s", "sketch"])

    return cut(found.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node binary, s array<long>, sketch array<long>"))


def distinct_buckets(members: DataFrame, order: list[str]) -> DataFrame:
    """members without buckets of one node, and of buckets that hold the same nodes only the first in `order`: the others would
    give the same pairs again. Sets of nodes are told apart by their size and 128 bits of hashes."""
    # most buckets hold one node: they are left out in one pass, before anything is joined
    members = cut(members.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where("m > 1").drop("m"))
    held = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("g"),
        F.min(F.struct(*order)).alias("place"))
    first = held.groupBy("m", "h", "g").agg(F.min_by("bucket", "place").alias("bucket")).select("bucket")
    return members.join(maybe_broadcast(cut(first), FEW), "bucket")


def rare_buckets(sets: DataFrame, percent: int) -> DataFrame:
    """node, n, own (shingles that it has alone), most, bucket: each node of sets under its rarest shingles, as many as a text that is
    alike must share one of. Shingles that no other node has make no bucket. most: its shingles that others have, from the bucket's
    on in the common order; two nodes share no more than the lesser of theirs in the first bucket that they have in common."""
    each = sets.select("node", F.size("s").cast("long").alias("n"), F.explode("s").alias("s"))
    common = cut(each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    owned = each.join(maybe_broadcast(common, FEW), "s").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("s"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("s"))
    held = F.size("s").cast("long")
    each = owned.select("node", "n", held.alias("held"), F.posexplode(F.slice(
        "s", F.lit(1), F.greatest(first, F.lit(0)).cast("int"))).alias("at", "x"))
    each = cut(each.select("node", "n", (F.col("n") - F.col("held")).alias("own"), (F.col("held") - F.col("at")).alias("most"),
                           F.col("x.s").alias("bucket"), F.col("x.df").alias("df")))
    return distinct_buckets(each, ["df", "bucket"]).drop("df")


def class_labels(classes: DataFrame, signed: DataFrame, docs: DataFrame, width: int, percent: int, key: str,
                 text: str) -> DataFrame | None:
    """node, label for every class that is linked with another; None if there is no link."""
    members = classes.select("node", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "bucket"))
    live = cut(distinct_buckets(members, ["band", "bucket"]).select(
        "node", "n", F.lit(0).cast("long").alias("own"), F.col("n").alias("most"), "band", "bucket"))
    sets = class_sets(signed, live.select("node").distinct(), docs, width, key, text)
    labels, row = None, ["node", "n", "own", "most", "bucket", "c", "minor", "sketch"]
    live = cut(live.join(sets.select("node", "sketch"), "node")).select("*", F.col("node").alias("c"), F.lit(True).alias("minor"))

    def component(members: DataFrame) -> DataFrame:
        if labels is None:
            return cut(members.withColumn("c", F.col("node")))
        return cut(members.drop("c").join(maybe_broadcast(labels, FEW), "node", "left").withColumn("c", F.coalesce("label", "node")))

    def mixed(members: DataFrame) -> DataFrame:
        """The buckets whose members are not all connected: their size and the component that most are of."""
        sides = members.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("bucket").agg(
            F.max(F.struct("m", "c")).alias("major"), F.sum("m").alias("size"))
        return sides.where("size > major.m").select("bucket", "size", F.col("major.c").alias("major"))

    def compared(members: DataFrame, part: list[Column]) -> tuple[DataFrame, DataFrame]:
        """The leaders of the buckets (of each part), and the links between them and members of other components."""
        # an original has few shingles that none of its copies has
        leaders = cut(members.where("minor").groupBy("bucket", *part).agg(
            F.min(F.struct("own", "node", "n", "most", "c", "sketch")).alias("x")).select(
            "bucket", F.col("x.node").alias("lead"), F.col("x.n").alias("lead_n"), F.col("x.most").alias("lead_most"),
            F.col("x.c").alias("lead_c"), F.col("x.sketch").alias("lead_sketch")))
        # no larger intersection is possible
        same = F.floor((F.col("n") + F.col("lead_n") - sketch_distance("sketch", "lead_sketch")) / 2)
        both = F.least("most", "lead_most", "n", "lead_n", same)
        met = members.join(leaders, "bucket").where(
            (F.col("c") != F.col("lead_c")) & (100 * both >= percent * (F.col("n") + F.col("lead_n") - both)))
        pairs = met.select(F.least("node", "lead").alias("u"), F.greatest("node", "lead").alias("v")).distinct()
        return leaders, cut(confirmed(cut(pairs), sets, percent))

    _, edges = compared(live.where(F.col("band") < EARLY), [])
    if not edges.isEmpty():
        labels = spread_labels(edges, labels)
        known = live.drop("c", "minor").join(maybe_broadcast(labels, FEW), "node", "left").withColumn("c", F.coalesce("label", "node"))
        live = cut(known.join(mixed(known), "bucket").withColumn("minor", F.col("c") != F.col("major")).select(*row))
    for turn in itertools.count():
        if live.isEmpty():
            return labels
        parts = FANOUT ** max(turn - 1, 0)
        leaders, edges = compared(live, [F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part")])
        if not edges.isEmpty():
            labels = spread_labels(edges, labels)
        rest = component(live.drop("minor", "band").join(leaders.select("bucket", F.col("lead").alias("node")), ["bucket", "node"], "left_anti"))
        open_ = cut(mixed(rest)) if turn == 0 else mixed(rest)
        minor = (F.col("c") != F.col("major")).alias("minor")
        if turn == 0:  # crowds are dealt anew
            crowded = rest.join(open_.where(F.col("size") > CROWD), "bucket").select("node").distinct()
            fresh = component(rare_buckets(cut(sets.select("node", "s").join(crowded, "node")), percent).join(
                sets.select("node", "sketch"), "node"))
            small = rest.join(open_.where(F.col("size") <= CROWD), "bucket").withColumn("minor", minor).select(*row)
            live = cut(small.unionByName(fresh.join(mixed(fresh), "bucket").withColumn("minor", minor).select(*row)))
        else:
            live = cut(rest.join(open_, "bucket").withColumn("minor", minor).select(*row))


def _linked(docs: DataFrame, width: int, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The signatures, and for each class (node) its root and the first row (id null last, text_hash) of its component."""
    signed = cut(signatures(docs, width, key, text))
    classes = cut(signed.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "text_hash")).alias("first"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")))
    labels = class_labels(classes, signed, docs, width, percent, key, text)
    rooted = classes.select("node", "first").withColumn("root", F.col("node"))
    if labels is not None:
        rooted = classes.select("node", "first").join(labels, "node", "left").select(
            "node", "first", F.coalesce("label", "node").alias("root"))
    rooted = cut(rooted)
    heads = cut(rooted.groupBy("root").agg(F.min("first").alias("head")))
    return signed, cut(rooted.select("node", "root").join(heads, "root"))


def groups(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (least id reachable over links, its own included), kept (it is that id): one row a document.
    Linked: sets of shingles of `width` words with 100 * intersection >= percent * union."""
    signed, found = _linked(docs, width, percent, key, text)
    least = F.when(F.col("node").isNull(), F.col(key)).otherwise(F.col("head.id"))
    return signed.select(key, "n_shingles", "node").join(found, "node", "left").select(
        key, "n_shingles", least.alias("component_id"), F.coalesce(F.col(key) == least, F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, that of the least id; columns as they came. Documents without words all stay."""
    signed, found = _linked(docs, width, percent, key, text)
    named = signed.select(F.col(key).alias("id"), "text_hash", "node")
    chosen = named.join(found, "node", "left").where(F.col("node").isNull() | (
        F.col("id").eqNullSafe(F.col("head.id")) & (F.col("text_hash") == F.col("head.text_hash"))))
    chosen = cut(chosen.groupBy("id", "text_hash").agg(F.first(F.col("node").isNotNull()).alias("words"), F.count(F.lit(1)).alias("rows")))
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("own"), F.xxhash64(text).alias("hash"))
    kept = packed.join(chosen, packed["own"].eqNullSafe(chosen["id"]) & (packed["hash"] == chosen["text_hash"]))
    once = kept.where("rows = 1 or not words").select("row.*")
    if chosen.where("rows > 1 and words").isEmpty():
        return once
    repeated = kept.where("rows > 1 and words").dropDuplicates(["own", "hash"])
    return once.unionByName(repeated.select("row.*"))
