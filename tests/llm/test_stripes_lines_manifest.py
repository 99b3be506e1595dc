"""Divergence stripes, line filters and the Merkle manifest against plain loops, and their defined results on odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from specspark.llm import line_filters, merkle_manifest, stripe_divergence

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, size int, row string, g string, pos int, block int, "
          "digest string, term string, `order` long, `dotted.name` int")
EXTRA = (9, "r", "g", 1, 2, "d", "t", 5, 6)


def _texts():
    rng = random.Random(11)
    words = [f"Wort{c}" for c in "abcdefghij"] + ["naïve", "ÄRGER", "Ärger", "漢字", "i18n", "x_y", "don't"]
    lines = ["Shared line", "  shared LINE\t", "Ärger über alles", "ärger über alles", "rare one", "", "   ", "\x0bboth\x0c", "a\r", "a"]
    out = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(25)]
    out += ["\n".join(rng.choices(lines, k=rng.randint(1, 9))) for _ in range(25)]
    return out + [None, None, "", "\n", "\n\n", "Shared line", "Shared line", "shared line\nshared line", "x " * 40_000, "no\x00thing", "l\n" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, t, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "B", "ü", None, ""]), None if i % 7 == 0 else i, *EXTRA)
            for i, t in enumerate(_texts())]
    rows += [rows[2], rows[2], (None, "Shared line", None, None, None, *EXTRA), (None, "other", "en", "a", 1, *EXTRA), (-5, "Shared line", "fr", "only", 1, *EXTRA)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).persist()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _audited(rows, min_docs, top):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        groups.add((lang, source))
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        counts[lang, source].update(words)
        held[lang].update(set(words))
    out = set()
    kept = {lang: [t for t, n in held[lang].items() if n >= min_docs] for lang, _ in groups}
    for lang, source in groups:
        terms = kept[lang]

        def p(count, terms=terms):
            total = sum(count[t] for t in terms)
            return {t: 1 + (10**9 * (count[t] + 2)) // (total + 2 * len(terms)) for t in terms}

        own, others = p(counts[lang, source]), [s for g, s in groups if g == lang]
        whole = p(sum((counts[lang, s] for s in others), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pair = [(sum(f(own[t], q[t]) for t in terms), s) for s in others if s != source for q in [p(counts[lang, s])]]
        above = [(f(own[t], whole[t]), t) for t in terms if counts[lang, source][t] and own[t] > whole[t]]
        for part, items, limit in (("pair", pair, None), ("term", above, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
            out |= {(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("cells", [stripe_divergence.CELLS, 7])
def test_divergences(docs, rows, cells, monkeypatch):
    monkeypatch.setattr(stripe_divergence, "CELLS", cells)
    for min_docs, top in ((3, 4), (10**6, 10)):
        found = stripe_divergence.audit(docs, min_docs, top).select("lang", "source", "part", "item", "value", "rank").collect()
        assert len(found) == len(set(found))
        assert {tuple(r) for r in found} == _audited(rows, min_docs, top)


def test_shares_of_huge_counts(spark):
    n, total = 9_000_000_000_000_000, 9_100_000_000_000_000
    one = spark.range(1).select(stripe_divergence.share(F.lit(n), F.lit(total), F.lit(7)).alias("p")).first().p
    assert one == 1 + 10**9 * (n + 2) // (total + 14)


def _left(rows, min_docs, min_chars, first):
    split = [(r.text or "").split("\n") for r in rows]
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    held, least = Counter(), {}
    for r, lines in zip(rows, split):
        for k in {key(s) for s in lines}:
            held[k] += 1
            least[k] = min(least.get(k, 1 << 63), (1 << 63) - 1 if r.doc_id is None else r.doc_id)
    out = []
    for r, lines in zip(rows, split):
        kept, seen = [], set()
        for s in lines:
            k = key(s)
            if len(k) >= min_chars and held[k] >= min_docs:
                if not first or least[k] != ((1 << 63) - 1 if r.doc_id is None else r.doc_id) or k in seen:
                    continue
                seen.add(k)
            kept.append(s)
        out.append((r.doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_lines(docs, rows, limit, small, monkeypatch):
    if small:  # filters that collide, tasks that spill after each document, several blocks
        for name, value in (("MIN_BITS", 64), ("MAX_BITS", 64), ("BLOCK", 16), ("PENDING", 2), ("ENTRIES", 1)):
            monkeypatch.setattr(line_filters, name, value)
    for min_docs, min_chars, keep in ((2, 1, "none"), (4, 6, "none"), (3, 1, "first")):
        order = F.col("doc_id") if keep == "first" else None
        found = line_filters.drop_repeats(docs, carry=["doc_id", "dotted.name"], min_docs=min_docs, min_chars=min_chars, keep=keep,
                                          order=order, broadcast_bytes=limit)
        got = Counter((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect())
        assert got == _left(rows, min_docs, min_chars, keep == "first")


def test_a_filter_names_every_repeat_and_few_others(spark):
    import numpy as np

    lines = [f"line number {i}" for i in range(4000)]
    texts = spark.createDataFrame([("\n".join(lines[i::8] + lines[: 10 * (i < 2)]),) for i in range(8)], "text string").repartition(5)
    bits = 1 << 16
    made = line_filters.merged(line_filters.merged(line_filters.sightings(texts, "text", bits, 1), ["block", "salt"]), ["block"])
    twice = line_filters._bitmap({r.block: bytes(r.twice) for r in made.collect()}, bits)
    named = line_filters.suspected([s.encode() for s in lines], twice, bits)
    assert {s.encode() for s in lines[:10]} <= set(named) and len(named) < 200 and isinstance(twice, np.ndarray)


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes):
    """The root, and the siblings of each node level by level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 16 * 16:a // 16 * 16 + 16]
            paths[i].append(("".join(run[:a % 16]), "".join(run[a % 16 + 1:])))
        nodes = [_h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [a // 16 for a in at]
    return nodes[0], paths


def _manifest(rows, names):
    def leaf(r, lower=False):
        text = lambda v: v if not lower or v is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in v)
        vs = [None if r[n] is None else text(str(r[n])) if n == "text" else str(r[n]) for n in names]
        return _h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in vs])

    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append((-(1 << 63) if r.doc_id is None else r.doc_id, leaf(r), leaf(r, True), r.doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([x[1] for x in sorted(groups[s])]) for s in order}
    root, above = _tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        for (_, own, other, doc), path in zip(sorted(groups[s]), trees[s][1]):
            value = other
            for left, right in path + up:
                value = _h(left, value, right)
            out.append((doc, own, trees[s][0], root, _h(*[a + b for a, b in path + up]), value))
    return Counter(out)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _built(df):
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = merkle_manifest.digest([*[F.col(c) for c in FIELDS[:-1]], F.translate("text", capitals, capitals.lower())])
    made = merkle_manifest.build(df, [F.col(c) for c in FIELDS], F.col("source"), F.col("doc_id"), lower)
    return Counter((r.row.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in merkle_manifest.proofs(made).collect())


def test_manifest(docs, rows):
    assert _built(docs) == _manifest(rows, FIELDS)


def test_manifest_of_several_tiers(spark):
    """One source beyond a block of 4096 by one leaf, others of 1, 16, 17 and 256 leaves, and more than 16 sources."""
    sizes = {"hot": 4097, None: 1, "": 16, "a": 17, "b": 256} | {f"s{i}": 1 for i in range(20)}
    rows = [(i, f"Text {i}", "en", s, i) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    assert _built(df) == _manifest(df.collect(), FIELDS)


def test_manifest_of_one_row(spark, docs):
    one = docs.filter("doc_id = 3")
    (found,) = _built(one)
    assert found[1] == found[2] == found[3] and found[4] == _h()


def test_empty_tables(nothing):
    assert stripe_divergence.audit(nothing).collect() == []
    assert line_filters.drop_repeats(nothing, carry=["doc_id"]).collect() == []
    assert line_filters.drop_repeats(nothing, broadcast_bytes=-1).collect() == []
    assert not _built(nothing)
