"""Repeated lines go: two Bloom filters name the suspects, only suspects are shuffled and counted exactly.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Each document counts once for a key. Two
filters of equal size and hashes are kept: the bits seen once, and the bits seen twice. A task notes the bits of its documents'
keys as sorted positions (never a whole filter), and filters merge bit by bit: once = a.once | b.once, twice = a.twice | b.twice
| (a.once & b.once). That needs no order, so blocks of the filters are merged by shuffle, over salts first. A key that two
documents hold has all of its bits in `twice`. Keys with all bits there are the suspects; they alone are shuffled, as whole keys
with counts summed in each task, and counted exactly. A saturated or colliding filter costs shuffle, never a wrong result.

Bounds: filters have BITS_PER_LINE bits a line, rounded up to a power of two, and MAX_BITS (128 MiB) at most, beyond which more and
more lines are suspects. `twice` is broadcast in blocks, so never more than that. The confirmed keys are broadcast up to
`broadcast_bytes`; beyond it they join the suspects of each distinct text, and the texts join the keys found in them.

Nulls and ties: a null text is one empty line, as the empty text is; null stays nothing else. Lines without a key of `min_chars`
code points always stay. Repeated rows are documents of their own. With keep="first" the first line of the document with the
least `order` stays (null after all others; rows equal in `order` all keep theirs). Empty tables give an empty result. Extra
columns travel in the struct `row`, so no name can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specspark.llm.shared import cut

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
BITS_PER_LINE, MIN_BITS, MAX_BITS = 16, 1 << 20, 1 << 30
BLOCK = 1 << 23  # bits: 1 MiB
PENDING, ENTRIES, HELD = 2_000_000, 200_000, 32 << 20
SALTS = 32
LAST = (1 << 63) - 1  # stands for a null order


def keys_of(text: bytes | None, min_chars: int = 1) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and the key of each, None where it has no key of min_chars code points."""
    lines = (text or b"").split(b"\n")
    keys = [line.strip(SPACE).lower() for line in lines]
    return lines, [k if k and (min_chars <= 1 or len(k.decode("utf-8", "replace")) >= min_chars) else None for k in keys]


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each hash, one row each."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask])


def _packed(pos: np.ndarray) -> bytes:
    """Sorted positions inside a block as compressed gaps."""
    return zlib.compress(np.diff(pos, prepend=0).astype("<u4").tobytes(), 1)


def _unpacked(payload: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(payload), "<u4"), dtype=np.int64)


def _sighted(pending: list[np.ndarray], part: int) -> list[dict]:
    """The noted bits by block: all of them once, those noted more than once twice."""
    pos, times = np.unique(np.concatenate(pending), return_counts=True)
    out = []
    for block in np.unique(pos // BLOCK):
        a, b = np.searchsorted(pos, [block * BLOCK, (block + 1) * BLOCK])
        inside = (pos[a:b] - block * BLOCK).astype(np.int64)
        out.append({"block": int(block), "salt": part, "once": _packed(inside), "twice": _packed(inside[times[a:b] > 1])})
    return out


FILTER = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
FILTER_SQL = "block int, salt int, once binary, twice binary"


def _rows(items: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(items, schema=schema)


def sightings(texts: DataFrame, text: str, bits: int, min_chars: int) -> DataFrame:
    """The two filters of every task, as blocks of positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held, part = [], 0, 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                hashes = {xxhash.xxh3_64_intdigest(k) for k in keys_of(t, min_chars)[1] if k is not None}
                if not hashes:
                    continue
                both = positions(np.fromiter(hashes, np.uint64, len(hashes)), bits)
                # a key whose two bits coincide is noted once
                pending += [both[0], both[1][both[1] != both[0]]]
                held += 2 * len(hashes)
                part = (part + len(t)) % SALTS
                if held >= PENDING:
                    yield _rows(_sighted(pending, part), FILTER)
                    pending, held = [], 0
        if pending:
            yield _rows(_sighted(pending, part), FILTER)

    return texts.select(F.col(text).cast("binary")).mapInArrow(run, FILTER_SQL)


def merged(filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each of the keys (block, or block and salt): the filters merged as they stream by, two bitmaps in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)

        def done() -> pa.RecordBatch:
            return _rows([{"block": now[0], "salt": now[1], "once": _packed(np.flatnonzero(once)),
                           "twice": _packed(np.flatnonzero(twice))}], FILTER)

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["block"], r["salt"] if "salt" in keys else 0)
                if key != now:
                    if now:
                        yield done()
                    now = key
                    once[:], twice[:] = False, False
                new = _unpacked(r["once"])
                twice[new[once[new]]] = True
                twice[_unpacked(r["twice"])] = True
                once[new] = True
        if now:
            yield done()

    return filters.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, FILTER_SQL)


def _bitmap(payloads: dict[int, bytes], bits: int) -> np.ndarray:
    out = np.zeros(max(bits // 8, 1), np.uint8)
    for block, payload in payloads.items():
        inside = np.zeros(min(BLOCK, bits), bool)
        inside[_unpacked(payload)] = True
        packed = np.packbits(inside, bitorder="little")
        out[block * BLOCK // 8: block * BLOCK // 8 + len(packed)] = packed
    return out


def suspected(keys: list[bytes], twice: np.ndarray, bits: int) -> list[bytes]:
    """The keys whose bits are all in the filter."""
    if not keys:
        return []
    both = positions(np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys)), bits)
    hit = ((twice[both >> np.uint64(3)] >> (both & np.uint64(7)).astype(np.uint8)) & 1).all(0)
    return [k for k, h in zip(keys, hit) if h]


COUNTS = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("first", pa.int64())])


def suspect_counts(docs: DataFrame, suspects: Callable[[bytes | None], list[bytes]]) -> DataFrame:
    """Suspected keys with the documents that hold them and the least order, summed in each task. docs: text, order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        held = 0

        def spilled() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(seen), pa.binary()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                    pa.array([v[1] for v in seen.values()], pa.int64())], schema=COUNTS)

        for batch in batches:
            for t, order in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k in suspects(t):
                    if k in seen:
                        entry = seen[k]
                        entry[0] += 1
                        entry[1] = min(entry[1], order)
                    else:
                        seen[k] = [1, order]
                        held += len(k)
                if len(seen) >= ENTRIES or held >= HELD:
                    yield spilled()
                    seen, held = {}, 0
        if seen:
            yield spilled()

    return docs.mapInArrow(run, "key binary, n long, first long")


FOUND = pa.schema([("digest", pa.binary()), ("key", pa.binary())])


def suspect_texts(docs: DataFrame, suspects: Callable[[bytes | None], list[bytes]]) -> DataFrame:
    """(digest of the text, suspected key) of every text that holds one; a task names a text once for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {d: t for t, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
            for d, t in rows.items():
                found = suspects(t)
                if found:
                    yield pa.record_batch([pa.array([d] * len(found), pa.binary()), pa.array(found, pa.binary())], schema=FOUND)

    return docs.mapInArrow(run, "digest binary, key binary")


def _left(text: bytes | None, order: int, repeats: dict[bytes, int], first: bool, min_chars: int) -> tuple[int, int, bytes]:
    """Lines of the text, lines dropped, and what is left."""
    lines, keys = keys_of(text, min_chars)
    kept, stays = [], set()
    for line, key in zip(lines, keys):
        if key in repeats:
            if not first or repeats[key] != order or key in stays:
                continue
            stays.add(key)
        kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _apply(rows: DataFrame, known: Callable[[], dict[bytes, int]] | None, first: bool, min_chars: int) -> DataFrame:
    """rows: row, text, order, and without `known` the array `repeats` of (key, first) of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (known() for _ in range(batch.num_rows)) if known else (
                {r["key"]: r["first"] for r in rs or ()} for rs in batch.column(3).to_pylist())
            out = [_left(t, o, r, first, min_chars) for t, o, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.binary())], names=["row", "n_lines", "n_dropped", "kept"])

    schema = T.StructType([rows.schema["row"]]).add("n_lines", "long").add("n_dropped", "long").add("kept", "binary")
    done = rows.mapInArrow(run, schema)
    return done.withColumn("kept", F.col("kept").cast("string"))


def drop_repeats(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None, min_docs: int = 10, min_chars: int = 1,
                 keep: str = "none", order: Column | None = None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Documents without the lines whose key at least min_docs documents hold: row (a struct of `carry`; of every column but the
    text unless named), n_lines, n_dropped, kept. keep="first" leaves the first line of each such key, by `order` (a long)."""
    if keep not in ("none", "first") or (keep == "first") != (order is not None):
        raise ValueError('keep is "none", or "first" with an order')
    spark = docs.sparkSession
    names = list(carry if carry is not None else [c for c in docs.columns if c != text]) or [text]
    place = F.coalesce(order.cast("long"), F.lit(LAST)) if order is not None else F.lit(0).cast("long")
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").cast("binary").alias("text"),
                       place.alias("order"))
    body = base.select("text", "order")

    n_lines = docs.agg(F.sum(1 + F.length(f"`{text}`") - F.length(F.replace(F.col(f"`{text}`"), F.lit("\n"), F.lit(""))))).first()[0] or 0
    bits = min(max(MIN_BITS, 1 << (BITS_PER_LINE * n_lines - 1).bit_length()), MAX_BITS)
    filters = merged(merged(sightings(base, "text", bits, min_chars), ["block", "salt"]), ["block"])
    twice = spark.sparkContext.broadcast({r.block: bytes(r.twice) for r in filters.select("block", "twice").collect()})
    cache: dict[str, np.ndarray] = {}

    def suspects(t: bytes | None) -> list[bytes]:
        if "bits" not in cache:
            cache["bits"] = _bitmap(twice.value, bits)
        return suspected([k for k in dict.fromkeys(keys_of(t, min_chars)[1]) if k is not None], cache["bits"], bits)

    counted = suspect_counts(body, suspects).groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    repeats = cut(counted.filter(F.col("n") >= min_docs).select("key", "first"))
    size = repeats.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        known = spark.sparkContext.broadcast({bytes(r.key): r.first_ for r in repeats.select("key", F.col("first").alias("first_")).collect()})
        return _apply(base, lambda: known.value, keep == "first", min_chars)

    # the keys found in each distinct text; a key of very many texts is dealt over salts
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("").cast("binary")), 256))
    found = suspect_texts(base.select("text", digest.alias("digest")), suspects)
    dealt = repeats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    of_text = cut(found.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).join(dealt, ["key", "salt"])
                  .groupBy("digest").agg(F.collect_set(F.struct("key", "first")).alias("repeats")))
    # copies of one text are dealt over salts too
    by_text = of_text.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = base.withColumns({"digest": digest, "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")})
    return _apply(salted.join(by_text, ["digest", "salt"], "left").select("row", "text", "order", "repeats"), None, keep == "first", min_chars)
