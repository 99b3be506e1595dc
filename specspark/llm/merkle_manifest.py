"""Merkle manifest of a dataset: a tree of 16 children a node for every group, a tree over the groups, proofs and refolded roots.

A leaf is the hash of its fields; H is sha256 in lowercase hex over the inputs end to end, digests as hex text. Leaves of a group
ascend by `order`; while several nodes remain, each 16 consecutive ones become their hash. The groups' roots, by group, make the
tree above in the same way.

A parent keeps a copied hash state from before each of its child slots. Folding a changed child resumes the state of its slot with
the replacement and the siblings to the right only; what is left of it is never hashed again. States can't travel between
processes, so a task builds the states of a block of 16^3 consecutive nodes (three levels), folds every node of the block through
them, and keeps one state a level for the path above the block.

Leaves get their places by a range exchange and the counts of its partitions, so a group of any size spreads over tasks. Each tier
of blocks is one table of the shared folder, 4096 times smaller than the one below. Going down, a block receives its path to the
root as one header row, not one a node. A task holds one block.

Nulls and ties: a null field is `-`, any other its UTF-8 byte count, `:` and value. The null group is first, then groups by UTF-8
bytes; null orders come first; equal orders go by leaf, and repeated rows are leaves of their own. A lone leaf is its group's root
and a lone group root the root; the proof without siblings is the hash of nothing. Empty tables give an empty result. Extra columns
travel in the struct `row`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specspark.llm.shared import cut

FAN, LEVELS = 16, 3
SPAN = FAN**LEVELS


def digest(values: Sequence[Column]) -> Column:
    """H of the values, each `-` if null, else byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]).cast("binary"), 256)


class Parent:
    """A node with the hash states from before each of its children."""

    def __init__(self, children: list[bytes]):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def folded(self, slot: int, value: bytes) -> bytes:
        """The node's hash with another value in the slot."""
        state = self.states[slot].copy()
        state.update(value)
        state.update(b"".join(self.children[slot + 1:]))
        return state.hexdigest().encode()


def levels_of(nodes: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents of each of the levels above the nodes of a block."""
    out = []
    for _ in range(levels):
        out.append([Parent(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


class Above:
    """The way from a block to the root: the state after the left siblings and the right siblings of each level."""

    def __init__(self, path: list[dict]):
        self.path = path
        self.states = [hashlib.sha256(step["left"].encode()) for step in path]
        self.siblings = "".join(step["left"] + step["right"] for step in path).encode()

    def folded(self, value: bytes) -> bytes:
        for state, step in zip(self.states, self.path):
            state = state.copy()
            state.update(value)
            state.update(step["right"].encode())
            value = state.hexdigest().encode()
        return value


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """nodes with pos, the 0-based place in its group `g` by `order`, and depth, the levels of the group's tree."""
    parts = cut(nodes.repartitionByRange("g", *order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_n"))
    by_part, whole = Window.partitionBy("g").orderBy("_part"), Window.partitionBy("g")
    powers = F.array(*[F.lit(FAN**k) for k in range(15)])
    offsets = counts.withColumns({"_off": F.sum("_n").over(by_part) - F.col("_n"), "_all": F.sum("_n").over(whole)}).withColumn(
        "depth", F.size(F.filter(powers, lambda p: p < F.col("_all"))))
    place = F.row_number().over(Window.partitionBy("g", "_part").orderBy(*order)) - F.lit(1)
    return parts.withColumn("_place", place).join(offsets, ["g", "_part"]).withColumn("pos", F.col("_place") + F.col("_off")).drop(
        "_place", "_off", "_part", "_n", "_all")


def _blocks(nodes: DataFrame) -> DataFrame:
    """nodes dealt to tasks by block, in order."""
    block = nodes.withColumn("block", F.floor(F.col("pos") / SPAN))
    return block.repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each (g, block), one block at a time."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for key, run in groupby(rows, key=lambda r: (r["g"], r["block"])):
        yield key, list(run)


def climbed(nodes: DataFrame, tier: int) -> DataFrame:
    """The nodes one tier up: each block's node after up to three levels. nodes: g, pos, depth, digest."""
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("depth", pa.int32()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (g, block), rows in _runs(batches):
            levels = min(LEVELS, max(0, rows[0]["depth"] - LEVELS * tier))
            top = levels_of([r["digest"].encode() for r in rows], levels)
            one = top[-1][0].digest.decode() if top else rows[0]["digest"]
            out.append({"g": g, "pos": block, "depth": rows[0]["depth"], "digest": one})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _blocks(nodes.select("g", "pos", "depth", "digest")).mapInArrow(run, "g string, pos long, depth int, digest string")


STEPS = "array<struct<left:string,right:string>>"


def descended(nodes: DataFrame, headers: DataFrame, tier: int) -> DataFrame:
    """g, pos, path, subroot, root of every node: the path of siblings from the node up. headers: the same of the nodes a tier up,
    or of the group as a whole."""
    steps = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("path", steps), ("subroot", pa.string()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (g, _), (head, *rows) in _runs(batches):
            digests = [r["digest"] for r in rows]
            levels = levels_of([d.encode() for d in digests], min(LEVELS, max(0, rows[0]["depth"] - LEVELS * tier)))
            out = []
            for i, r in enumerate(rows):
                path, at = [], i
                for parents in levels:
                    parent, slot = parents[at // FAN], at % FAN
                    path.append({"left": b"".join(parent.children[:slot]).decode(), "right": b"".join(parent.children[slot + 1:]).decode()})
                    at //= FAN
                out.append({"g": g, "pos": r["pos"], "path": path + head["path"], "subroot": head["subroot"], "root": head["root"]})
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return _with_headers(nodes.select("g", "pos", "depth", "digest"), headers).mapInArrow(
        run, f"g string, pos long, path {STEPS}, subroot string, root string")


def _with_headers(nodes: DataFrame, headers: DataFrame) -> DataFrame:
    """nodes dealt by block, each block led by its header (the node of its number a tier up)."""
    led = headers.select("g", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "path", "subroot", "root")
    block = nodes.withColumn("block", F.floor(F.col("pos") / SPAN))
    return block.unionByName(led, allowMissingColumns=True).repartition("g", "block").sortWithinPartitions("g", "block", "pos")


@dataclass
class Manifest:
    """leaves: g, row, pos, depth, digest, other (the digest to fold in, null: its own); tiers: the tables of nodes above them, the
    last with one node a group; groups: the tiers of the tree over the groups' roots, the last with the root."""

    leaves: DataFrame
    tiers: list[DataFrame]
    groups: list[DataFrame]


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """The tiers above the leaves, as many as the deepest group needs."""
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    out: list[DataFrame] = []
    for tier in range(max(1, -(-deepest // LEVELS))):
        out.append(cut(climbed(out[-1] if out else leaves, tier)))
    return out


def build(docs: DataFrame, fields: Sequence[Column], group: Column, order: Column, other: Column | None = None,
          carry: Sequence[str] | None = None) -> Manifest:
    """The manifest of docs. `other`, where not null, is the digest that a row's proof is folded with."""
    key = F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))
    base = cut(docs.select(key.alias("g"), order.alias("_order"), digest(fields).alias("digest"),
                           (other if other is not None else F.lit(None).cast("string")).alias("other"),
                           F.struct(*[F.col(f"`{c}`") for c in (carry if carry is not None else docs.columns)]).alias("row"),
                           F.monotonically_increasing_id().alias("_tie")))
    leaves = cut(numbered(base, ["_order", "digest", "_tie"]).drop("_order", "_tie"))
    tiers = _tiers(leaves)
    roots = tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "digest")
    places = cut(numbered(roots, ["of"]))
    return Manifest(leaves, tiers, [places, *_tiers(places)])


def proofs(made: Manifest) -> DataFrame:
    """row, leaf, subroot, root, proof_sha256 (H of the siblings, level by level to the root), folded_root of every leaf."""
    top = made.groups[-1].select("g", "pos", F.array().cast(STEPS).alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for tier in range(len(made.groups) - 2, -1, -1):
        top = cut(descended(made.groups[tier], top, tier))
    # each group's path goes from its place in the upper tree
    named = made.groups[0].select("pos", F.col("of"), F.col("digest").alias("_subroot"))
    heads = top.join(named, "pos").select(F.col("of").alias("g"), F.lit(0).cast("long").alias("pos"), "path",
                                          F.col("_subroot").alias("subroot"), "root")
    for tier in range(len(made.tiers) - 1, 0, -1):
        heads = cut(descended(made.tiers[tier - 1], heads, tier))
    return _proved(made.leaves, heads)


def _proved(leaves: DataFrame, heads: DataFrame) -> DataFrame:
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []  # the block's header and nodes
        rows: list[pa.Array] = []  # their row structs

        def done() -> pa.RecordBatch:
            head, nodes = held[0], held[1:]
            levels = levels_of([r["digest"].encode() for r in nodes], min(LEVELS, nodes[0]["depth"]))
            above = Above(head["path"])
            out = []
            for i, r in enumerate(nodes):
                value = (r["other"] or r["digest"]).encode()
                proof, at = hashlib.sha256(), i
                for parents in levels:
                    parent, slot = parents[at // FAN], at % FAN
                    proof.update(b"".join(parent.children[:slot] + parent.children[slot + 1:]))
                    value = parent.folded(slot, value)
                    at //= FAN
                proof.update(above.siblings)
                out.append((r["digest"], head["subroot"], head["root"], proof.hexdigest(), above.folded(value).decode()))
            structs = pa.concat_arrays(rows)[1:]
            return pa.RecordBatch.from_arrays([structs, *[pa.array(c, pa.string()) for c in zip(*out)]], names=["row", *names])

        now = None
        for batch in batches:
            structs = batch.column("row")
            slim = batch.select([n for n in batch.schema.names if n != "row"]).to_pylist()
            start = 0
            for i, r in enumerate(slim):
                if (r["g"], r["block"]) != now:
                    if now is not None:
                        rows.append(structs[start:i])
                        yield done()
                    now, held, rows, start = (r["g"], r["block"]), [], [], i
                held.append(r)
            rows.append(structs[start:])
        if held:
            yield done()

    schema = T.StructType([leaves.schema["row"], *[T.StructField(n, T.StringType()) for n in names]])
    return _with_headers(leaves, heads).mapInArrow(run, schema)
