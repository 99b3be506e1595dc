"""Divergence of each source's words from those of the other sources and of the whole language, through in-mapper stripes.

A task folds whole documents into stripes: (lang, term) -> number of documents, and occurrences by source. When it holds CELLS cells
or TERM_BYTES bytes of terms it spills them and starts anew. Stripes are shuffled by (lang, term) once and merged there; a term that
every document has arrives as one stripe a spill, not a row a document. Merged stripes of terms in `min_docs` documents or more are
written, and the divergences come from them: a pair of sources differs from what absent terms alone would give only where a stripe
has one of them, so a stripe yields the pairs of its own sources, and the rest comes from the number of terms with each count.

All arithmetic is exact: p = 1 + floor(10^9 * (count + 2) / (N + 2V)) in decimals of 38 digits, f = floor((p - q)^2 / (p + q)) in
longs (p is at most 10^9 + 1).

Nulls and ties: null text, lang and source are ''. Every (lang, source) of the documents is a group, even without terms. Equal
values rank by the UTF-8 bytes of the item. Repeated rows are documents of their own. A language without kept terms gives pairs of
value 0 (p is 1) and no terms. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specspark.llm.shared import cut

#: Runs of letters and of anything beyond ASCII, in UTF-8 with A-Z lower-cased.
TERM = re.compile(rb"[a-z\x80-\xff]+")
CELLS, TERM_BYTES = 500_000, 32 << 20
ONE = 1_000_000_000

STRIPE = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64()))])


def stripes(docs: DataFrame) -> DataFrame:
    """lang, term, docs, sources, counts: the stripes of every task, as often as it spilled. docs: lang, source, text."""

    def spilled(held: dict[str, dict[bytes, list]]) -> Iterator[pa.RecordBatch]:
        for lang, terms in held.items():
            names = list(terms)
            for i in range(0, len(names), 20_000):
                part = names[i:i + 20_000]
                rows = [terms[t] for t in part]
                yield pa.record_batch([
                    pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([list(r[1]) for r in rows], pa.list_(pa.string())),
                    pa.array([list(r[1].values()) for r in rows], pa.list_(pa.int64()))], schema=STRIPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, list]] = {}
        cells = size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms = held.setdefault(lang, {})
                for term, n in Counter(TERM.findall(text.lower())).items():
                    stripe = terms.get(term)
                    if stripe is None:
                        terms[term] = [1, {source: n}]
                        cells += 2
                        size += len(term)
                        continue
                    stripe[0] += 1
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        cells += 1
                if cells >= CELLS or size >= TERM_BYTES:
                    yield from spilled(held)
                    held, cells, size = {}, 0, 0
        yield from spilled(held)

    texts = docs.select("lang", "source", F.col("text").cast("binary"))
    found = texts.mapInArrow(run, "lang string, term binary, docs long, sources array<string>, counts array<long>")
    return found.withColumn("term", F.col("term").cast("string"))


def merge_stripes(found: DataFrame, min_docs: int) -> DataFrame:
    """lang, term, stripe (array of source, n): stripes merged by one exchange, those of terms in min_docs documents or more."""
    # a null source carries the number of documents
    cells = F.concat(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n")),
                     F.array(F.struct(F.lit(None).cast("string").alias("source"), F.col("docs").alias("n"))))
    flat = found.repartition("lang", "term").select("lang", "term", F.explode(cells).alias("c")).select("lang", "term", "c.*")
    summed = flat.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    whole = summed.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("docs"),
        F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n"))).alias("stripe"))
    return whole.filter(F.col("docs") >= min_docs).drop("docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), exact; 1 where nothing was kept."""
    wide = "decimal(38,0)"
    below = total.cast(wide) + F.lit(2).cast(wide) * terms.cast(wide)
    above = F.lit(ONE).cast(wide) * (n.cast("decimal(28,0)") + F.lit(2))
    whole = F.call_function("div", above, F.nullif(below, F.lit(0).cast(wide)))
    return F.coalesce(F.lit(1) + whole, F.lit(1)).cast("long")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of positive longs."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: for every group its divergence from each other source of the language (`pair`), and
    its `top` terms above the language's share (`term`)."""
    base = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = cut(merge_stripes(stripes(base), min_docs))

    cells = kept.select("lang", "term", F.explode("stripe").alias("c")).select("lang", "term", "c.*")
    per_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = cut(base.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(sizes, ["lang"], "left")
                 .na.fill(0, ["total", "terms"])
                 .withColumns({"absent": share(F.lit(0), F.col("total"), F.col("terms")),
                               "lang_total": F.sum("total").over(Window.partitionBy("lang"))}))

    # the share of every term in every source that has it, and in the language
    shares = cut(kept.withColumn("lang_n", F.aggregate("stripe", F.lit(0).cast("long"), lambda s, c: s + c["n"]))
                 .select("lang", "term", "lang_n", F.explode("stripe").alias("c")).select("lang", "term", "lang_n", "c.*")
                 .join(groups, ["lang", "source"])
                 .select("lang", "term", "source", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                         share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"), "absent"))

    by_value = [F.col("value").desc(), F.col("item")]
    above = (shares.filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")))
    ranked = above.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value)))
    return pairs(shares, groups).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value))).unionByName(ranked.filter(F.col("rank") <= top))


def pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, part, item, value for each two sources of a language, both ways.

    Over all kept terms, f(p, q) sums to: terms x f(absent, absent'), and for each term of the one source f(p, absent') less that,
    likewise for the other, and for each term of both f(p, q) less f(p, absent') less f(absent, q) plus f(absent, absent')."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("item_absent"))
    two = groups.select("lang", "source", "terms", "absent").join(other, "lang").filter(F.col("source") != F.col("item"))
    empty = gap(F.col("absent"), F.col("item_absent"))
    base = two.select("lang", "source", "item", (F.col("terms") * empty).alias("value"))

    alike = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    single = alike.join(two, ["lang", "source"]).groupBy("lang", "source", "item").agg(
        F.sum(F.col("times") * (gap(F.col("p"), F.col("item_absent")) - empty)).alias("value"))
    turned = single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    of_term = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "absent"))).alias("s"))
    inner = of_term.select("lang", F.explode("s").alias("a"), "s").select("lang", "a", F.explode(
        F.filter("s", lambda x: x["source"] > F.col("a.source"))).alias("b"))
    both = inner.groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item")).agg(F.sum(
        gap(F.col("a.p"), F.col("b.p")) - gap(F.col("a.p"), F.col("b.absent")) - gap(F.col("a.absent"), F.col("b.p"))
        + gap(F.col("a.absent"), F.col("b.absent"))).alias("value"))
    back = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    summed = base.unionByName(single).unionByName(turned).unionByName(both).unionByName(back).groupBy(
        "lang", "source", "item").agg(F.sum("value").alias("value"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
