"""Document fingerprints by order MinHash (DataFrame functions only).

The words of a text (case kept) form k-mers of K words; a k-mer is numbered by its occurrence in the text, so repeats count. A
k-mer's hash says which of BINS bins it falls in; every bin keeps its `KEEP` least k-mers, puts them back into the order of the
text and hashes that tuple. So a component changes if its k-mers change or swap places, which plain MinHash doesn't see. The
fingerprint is the list of (bin, tuple hash), six hex digits each. Likeness: equal components, of the bins that either text has.

All of it is array work inside a row: the hashes of k-mers and their places are packed into longs (38 bits and 26 bits) and
sorted, occurrences are counted along the runs, and the packed numbers are sorted once more into bins.

Nulls and ties: a null text is empty. A text of fewer than K words is one k-mer; one without words has an empty fingerprint, and two
empty fingerprints are alike (1.0). Equal texts have equal fingerprints. Order of documents: falling id, null ids last, then by
hash of the text; a row repeated c times is next of itself c - 1 times. A single document is its own next. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.llm.shared import cut

K, KEEP, BINS = 3, 2, 64
PLACE = 26  # bits of a k-mer's place
ROWS_A_RANGE = 50_000


def _let(bound: dict[str, str], body: str) -> str:
    """body with names bound to expressions in turn, each evaluated once a row."""
    for name, expression in reversed(bound.items()):
        body = f"transform(array({expression}), {name} -> {body})[0]"
    return body


def components(text: str) -> Column:
    """The fingerprint of the text column as rising ints, bin * 65536 + tuple hash. text: name of a column that is not null."""
    grams = ", ".join(f"w[i + {j}]" for j in range(K))
    low = (1 << PLACE) - 1
    pick = f"CASE WHEN get(t, i + 1) IS NOT NULL AND shiftright(t[i + 1], 58) = shiftright(t[i], 58) THEN CASE WHEN (t[i] & {low}) < (t[i + 1] & {low}) " \
           f"THEN xxhash64(shiftright(t[i], {PLACE}), shiftright(t[i + 1], {PLACE})) ELSE xxhash64(shiftright(t[i + 1], {PLACE}), shiftright(t[i], {PLACE})) END " \
           f"ELSE xxhash64(shiftright(t[i], {PLACE})) END"
    return F.expr(_let({
        "w": f"transform(filter(split(`{text}`, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> ''), x -> xxhash64(x))",
        # k-mers by hash, then place
        "s": f"CASE WHEN size(w) = 0 THEN cast(array() AS array<bigint>) WHEN size(w) < {K} THEN array(xxhash64(w) & ~{low}L) ELSE "
             f"sort_array(transform(sequence(0, size(w) - {K}), i -> (xxhash64({grams}) & ~{low}L) | cast(i AS bigint))) END",
        # where the runs of equal k-mers begin
        "b": f"CASE WHEN size(s) = 0 THEN cast(array() AS array<int>) ELSE "
             f"filter(sequence(0, size(s) - 1), i -> i = 0 OR shiftright(s[i], {PLACE}) <> shiftright(s[i - 1], {PLACE})) END",
        "t": f"sort_array(flatten(transform(b, (f, j) -> transform(sequence(f, coalesce(get(b, j + 1), size(s)) - 1), "
             f"i -> (xxhash64(shiftright(s[i], {PLACE}), i - f) & ~{low}L) | (s[i] & {low}L)))))",
        "h": "CASE WHEN size(t) = 0 THEN cast(array() AS array<int>) ELSE "
             "filter(sequence(0, size(t) - 1), i -> i = 0 OR shiftright(t[i], 58) <> shiftright(t[i - 1], 58)) END",
    }, f"transform(h, i -> cast((shiftright(t[i], 58) + 32) * 65536 + ({pick} & 65535) AS int))"))


def fingerprint(made: Column) -> Column:
    return F.array_join(F.transform(made, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal components, of the bins that either has; 1 if neither has any."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def neighbours(keys: DataFrame) -> DataFrame:
    """k, h, n, times with next_k, next_h and, of the row this one is next of, last_k, last_h, last_n. One row a document; the
    order is found in ranges, and only the ends of the ranges meet in one task."""
    rows = keys.count()
    order = [F.desc("k"), F.desc("h")]
    ranges = cut(keys.repartitionByRange(max(2, -(-rows // ROWS_A_RANGE)), *order).withColumn("range", F.spark_partition_id()))
    ends = ranges.groupBy("range").agg(F.max(F.struct("k", "h", "n")).alias("first"), F.min(F.struct("k", "h", "n")).alias("last"))
    line, all_ = Window.partitionBy(F.lit(0)).orderBy("range"), Window.partitionBy(F.lit(0))
    ends = ends.withColumn("after", F.coalesce(F.lead("first").over(line), F.max("first").over(all_))).withColumn(
        "before", F.coalesce(F.lag("last").over(line), F.min("last").over(all_))).select("range", "after", "before")
    inside = Window.partitionBy("range").orderBy(*order)
    here = F.struct("k", "h", "n")
    linked = ranges.withColumn("after_", F.lead(here).over(inside)).withColumn("before_", F.lag(here).over(inside)).join(ends, "range")
    return cut(linked.select("k", "h", "n", "times", F.coalesce("after_", "after").alias("next"), F.coalesce("before_", "before").alias("last")).select(
        "k", "h", "n", "times", F.col("next.k").alias("next_k"), F.col("next.h").alias("next_h"), F.col("last.k").alias("last_k"),
        F.col("last.h").alias("last_h"), F.col("last.n").alias("last_n")))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text, edited (the last third of its code points replaced by as many first ones of the next document), k and h (its place
    in the order), next_k and next_h (those of the next one)."""
    none = -(1 << 63)
    # no other columns: then the texts move once, for their heads and for themselves
    whole = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(none)).alias("k"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "h", F.xxhash64("text"))
    named = F.when(F.col("k") != none, F.col("k")).cast(docs.schema[key].dataType).alias(key)
    keys = cut(whole.select("k", "h", F.char_length("text").cast("long").alias("n")).groupBy("k", "h", "n").agg(
        F.count(F.lit(1)).alias("times")))
    around = neighbours(keys)
    placed = whole.join(around.withColumnRenamed("n", "size"), ["k", "h"])
    heads = placed.select(F.col("last_k").alias("k"), F.col("last_h").alias("h"),
                          F.expr("substring(text, 1, cast(floor(last_n / 3) AS int))").alias("head"))
    repeated = not keys.where("times > 1").isEmpty()
    if repeated:  # one row of equal ones gives the head, and one of them is followed by another document
        heads = heads.dropDuplicates(["k", "h"])
        placed = placed.withColumn("nth", F.row_number().over(Window.partitionBy("k", "h").orderBy("size")))
    own = (F.col("nth") < F.col("times")) if repeated else F.lit(False)
    third = F.floor(F.col("size") / 3).cast("int")
    front = F.expr("substring(text, 1, cast(size - floor(size / 3) AS int))")
    joined = placed.join(heads, ["k", "h"])
    head = F.when(own, F.substring("text", F.lit(1), third)).otherwise(F.col("head"))
    return joined.select(named, "text", F.concat(front, head).alias("edited"), "k", "h", F.col("size").alias("n_chars"),
                         F.when(own, F.col("k")).otherwise(F.col("next_k")).alias("next_k"),
                         F.when(own, F.col("h")).otherwise(F.col("next_h")).alias("next_h"))


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row a document."""
    made = cut(edited(docs, key, text).select(key, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), components("text").alias("own"),
                                              components("edited").alias("changed"), "k", "h", "next_k", "next_h"))
    others = made.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("own").alias("other")).dropDuplicates(["next_k", "next_h"])
    return made.join(others, ["next_k", "next_h"]).select(
        key, "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("other")).alias("near_next"))
