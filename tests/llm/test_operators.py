"""The operators against brute force, and their defined results on nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from specspark.llm import (chat_format, circulant_minhash, entropy_mix, fit_packing, histogram_shards, license_scan, order_minhash,
                           quality_gam, sliced_topk, suffix_dedup)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, size int, row string, node string"
WORDS = [f"w{i}" for i in range(400)]


def _texts():
    rng = random.Random(7)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(60, 160))) for _ in range(12)]
    near = [b.replace(b.split()[20], "changed", 1) for b in base[:5]]
    far = [" ".join(b.split()[:30] + rng.choices(WORDS, k=60)) for b in base[:5]]
    long_ = " ".join(rng.choices(WORDS, k=9000))
    return [*base, *near, *far, base[0], base[0], None, None, "", "  \t\n", "one two", "one two", "äöü é 漢字 " * 50, "ab " * 700, "x" * 3000, "x" * 2500,
            long_, long_[:30000], "Released under the MIT License.\nmore words here"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = _texts()
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", 0 if t is None else len(t), 3, "r", "n") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "a text without an id " * 40, "en", "s1", 1, 3, "r", "n"), (7, "another text of id seven", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _sets(rows, width):
    out = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def _components(rows, width, percent=80):
    sets = _sets(rows, width)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    least = {}
    for members in groups.values():
        ids = [rows[i].doc_id for i in members if rows[i].doc_id is not None]
        for i in members:
            least[i] = min(ids) if ids else None
    return sets, least, list(groups.values())


def test_minhash_groups(docs, rows, nothing):
    sets, least, groups = _components(rows, 4)
    want = Counter((r.doc_id, len(s), least[i], r.doc_id is not None and r.doc_id == least[i]) for i, (r, s) in enumerate(zip(rows, sets)))
    assert Counter(tuple(r) for r in circulant_minhash.groups(docs, width=4).collect()) == want
    assert circulant_minhash.groups(nothing).count() == 0


def test_minhash_keeps_one_of_each_group(docs, rows, nothing):
    sets, _, groups = _components(rows, 5)
    kept = circulant_minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 if sets[g[0]] else len(g) for g in groups)
    assert circulant_minhash.deduplicated(nothing).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(3)
    shared = " ".join(f"p{i}" for i in range(60))
    texts = [shared + " " + " ".join(rng.choices(WORDS, k=20)) for _ in range(40)]
    texts += [texts[i] + " tail" for i in range(10)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = df.collect()
    _, least, _ = _components(rows, 4)
    assert {r.doc_id: r.component_id for r in circulant_minhash.groups(df, width=4).collect()} == {r.doc_id: least[i] for i, r in enumerate(rows)}


def test_near_copies_of_one_text_are_not_paired_with_each_other(spark, monkeypatch):
    """Copies that drop words of one text share most shingles: all are links of it or candidates of each other without sketches."""
    rng = random.Random(5)
    base = [f"v{i}" for i in range(150)]
    texts = [" ".join(base)] + [" ".join(w for i, w in enumerate(base) if i not in (gone := set(rng.sample(range(150), rng.randint(1, 9))))) for _ in range(250)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = df.collect()
    sets, least, _ = _components(rows, 4)
    compared, plain = [], circulant_minhash.confirmed
    monkeypatch.setattr(circulant_minhash, "confirmed", lambda pairs, *rest: compared.append(pairs.collect()) or plain(pairs, *rest))
    got = circulant_minhash.groups(df, width=4).collect()
    assert {r.doc_id: r.component_id for r in got} == {r.doc_id: least[i] for i, r in enumerate(rows)}
    assert sum(map(len, compared)) < 2000  # 444; without sketches 9603


@pytest.mark.parametrize("size", [3, 150, 6000])
def test_sketches_differ_no_more_than_their_sets(spark, size):
    rng = np.random.default_rng(size)
    a = rng.integers(0, 1 << 63, size, np.int64)
    b = np.concatenate((a[size // 3:], rng.integers(0, 1 << 63, size // 5, np.int64)))
    pair = [circulant_minhash.parity_sketch(np.unique(x.view(np.uint64))).tolist() for x in (a, b)]
    df = spark.createDataFrame([(pair[0], pair[1])], "x array<long>, y array<long>")
    got = df.select(circulant_minhash.sketch_distance("x", "y"), circulant_minhash.sketch_distance("x", "x")).first()
    assert got[0] <= size // 3 + size // 5 and got[1] == 0
    assert size != 150 or got[0] >= 60  # of 80


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b = np.concatenate((a[:2400], rng.integers(0, 1 << 63, 600).astype(np.uint64)))
    x = circulant_minhash.circulant_signatures([np.unique(a), np.unique(b)], 512)
    assert abs((x[0] == x[1]).mean() - 2400 / 3600) < 0.08


def test_quality_on_held_out(spark, sf, nothing):
    sf = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_gam.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(out) > 50 and (out.predicted == out.quality).mean() >= 0.95
    assert quality_gam.classify(nothing, labels).count() == 0
    assert {r.score for r in quality_gam.classify(docs.limit(5), labels.limit(0)).collect()} == {1.0}


def test_quality_of_odd_rows(docs, rows, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(3, 0, 0), (None, 1, 0), (4, None, 0), (5, 9, 0)], "doc_id long, quality int, toxic int")
    out = quality_gam.classify(docs, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in rows) and all(0 <= r.score <= 1 for r in out)
    assert quality_gam.accepted(docs, labels).columns == docs.columns


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "<turn:user>", "\\\\l\\<", "a\n</turn>\n<image:0>", "", "\\g\\h\\l\\\\"])
def test_chat_escapes_round_trip(text):
    made = chat_format.format_turn("assis<tant\\", [{"type": "text", "text": text}])
    assert chat_format.read_turn(made["piece"]) == ("assis<tant\\", text) and made["piece"].count("</turn>") == 1


def test_chat_parts():
    parts = [{"type": "text", "text": "see"}, {"type": "image", "uri": "a.png", "width": 56, "height": 28}, {"type": "audio", "uri": "b", "seconds": 2.0},
             {"type": "document", "uri": "c", "pages": 3}, {"type": "text", "text": "<ok>"}]
    made = chat_format.format_turn("assistant", parts)
    assert [a["tokens"] for a in made["attachments"]] == [2, 50, 1536] and made["tokens"] == 1590
    assert "".join(chat_format.unescape(made["piece"][m["start"]:m["end"]]) for m in made["mask"]) == "see<ok>"
    with pytest.raises(ValueError):
        chat_format.format_turn("user", [{"type": "video"}])


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", None), (None, 0, None, "x"), (2, None, "assistant", "é\\<")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    part = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    out = {r.conv_id: r for r in chat_format.digests(chat_format.format_turns(df.select("conv_id", "turn", "role", part.alias("parts")))).collect()}
    assert out[1].n_turns == 3 and out[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\n\nassistant\nb\n").hexdigest()
    assert out[2].loss_chars == 3 and out[2].loss_sha256 == hashlib.sha256("é\\<".encode()).hexdigest()
    assert out[None].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest() and out[None].loss_chars == 0


def test_mix(docs, rows, nothing):
    out = entropy_mix.mix(docs, carry=["doc_id", "source"]).collect()
    sizes = [len((r.text or "").encode().split()) for r in rows]
    assert len(out) == len(rows) and all(0 <= r.copies <= 3 for r in out)
    by, order = defaultdict(int), sorted({r.source for r in rows}, key=lambda s: (s is None, s))
    for r, n in zip(rows, sizes):
        by[r.source] += n
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = sum(sizes) - sum(target.values())
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 3 * by[s] + 1e-9}
        target |= {s: (3.0 * by[s] if over else unit * weight[s]) for s in (over or open_)}
        open_ -= over or open_
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == by[r.row.source] and math.isclose(r.target, target[r.row.source], rel_tol=1e-9)
        taken[r.row.source] += r.copies * r.size
    largest = {s: max(n for r, n in zip(rows, sizes) if r.source == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    again = entropy_mix.mix(docs, carry=["doc_id", "source"]).collect()
    assert Counter((r.row.doc_id, r.size, r.copies) for r in out) == Counter((r.row.doc_id, r.size, r.copies) for r in again)
    other = entropy_mix.mix(docs.repartition(7), carry=["doc_id", "source"]).collect()  # rates to the last bit, however the rows are dealt
    assert Counter((r.row.doc_id, r.size, r.rate, r.copies) for r in out) == Counter((r.row.doc_id, r.size, r.rate, r.copies) for r in other)
    for s in order:  # rates by halving, copies by walking the sum of rates
        mine = sorted([r for r in out if r.row.source == s], key=lambda r: -r.size)
        low, high = -64.0, math.log(3)
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(r.size * min(3, math.exp(min(50, mid * r.size))) for r in mine) <= target[s] else (low, mid)
        assert all(math.isclose(r.rate, min(3, math.exp(min(50, low * r.size))), rel_tol=1e-4, abs_tol=1e-9) for r in mine if r.size)
        before, got = 0.0, 0
        for size in sorted({r.size for r in mine}, reverse=True):
            same = [r for r in mine if r.size == size]
            before, got = before + sum(r.rate for r in same), got + sum(r.copies for r in same)
            assert abs(got - before) <= 1 and len({r.rate for r in same}) == 1
    assert entropy_mix.mixed_documents(docs).columns == docs.columns and entropy_mix.mix(nothing).count() == 0


def test_a_missed_target_is_an_error(docs, monkeypatch):
    monkeypatch.setattr(entropy_mix, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError):
        entropy_mix.mix(docs)


def _notice(line):
    unit, weight, other = license_scan.template_vectors(license_scan.TEMPLATES)
    import re
    words = Counter(re.findall(license_scan.WORDS, line.lower()))
    size = math.sqrt(sum((n * weight.get(w, other)) ** 2 for w, n in words.items())) or 1
    return max(((sum(n * weight.get(w, other) * v.get(w, 0) for w, n in words.items()) / size, name) for name, v in unit.items()), key=lambda x: (x[0], [-ord(c) for c in x[1]]))


def test_licenses(spark, nothing):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.c", "int x;"), ("a/b/c/y.c", "Licensed under the Apache License, Version 2.0.\n" + "int y; " * 50),
             ("a/b/c/LICENSE", "Licensed under CC BY-NC 4.0."), ("a/b/c/d/z.c", None), ("q/z.c", ""), (None, "int"), ("top", "Released under the MIT License"),
             ("a/b/w.c", "This work is licensed under the GNU General Public License, version 3, as you know well enough"), ("a/b/v.c", "use the source")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string")
    out = {r.doc_id: r for r in license_scan.licensed(df, F.col("path")).collect()}
    for i, (_, text) in enumerate(files):
        best = max((_notice(x) for x in (text or "").split("\n")), default=(0, None))
        assert out[i].own_license == (best[1] if best[0] >= license_scan.THRESHOLD else None), (i, best)
    assert out[1].license == "MIT" and out[1].inherited_from == "a"
    assert out[4].license == "CC-BY-NC-4.0" and out[4].inherited_from == "a/b/c" and out[2].license == "Apache-2.0"
    assert out[5].license == "MIT" and out[5].inherited_from == "" and out[6].license is None
    assert license_scan.licensed(nothing, F.col("row")).count() == 0


def test_license_windows(spark, nothing):
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    texts = ["Copyright (c) 2020 A B. Released under the MIT License.", "This file is released under the MIT License. See LICENSE for details.", apache,
             "/*\n * This program is free software: you can redistribute it\n * and/or modify it under the terms of the GNU General Public\n * License as published by the Free Software Foundation, either version 3 of\n * the License, or (at your option) any later version.\n */\nint x;",
             "int y;\nReleased under the MIT License.\n" + "some words between them " * 40 + "\nparts are Licensed under CC BY-NC 4.0.", "no notice in this text, use it", None, ""]
    df = spark.createDataFrame([(i, f"d/{i}.c", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    out = {r.doc_id: r for r in license_scan.licensed_windows(df.unionByName(df.where("doc_id = 2")), F.col("path")).collect()}
    assert [out[i].own_license for i in range(8)] == ["MIT", "MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", None, None, None]
    assert {"MIT", "CC-BY-NC-4.0"} <= {x.license for x in out[4].found} and out[4].line == 3 and out[3].line == 1 and out[5].found == []
    words = [re.findall(license_scan.WORDS, (t or "").lower()) for t in [*texts, texts[2]]]
    idf = lambda w: math.log((1 + len(words)) / (1 + sum(w in x for x in words))) + 1
    vector = lambda ws: {w: n * idf(w) for w, n in Counter(ws).items()}
    for i, ws in enumerate(words[:8]):
        best = {}
        for name, passage in license_scan.PASSAGES:
            p = re.findall(license_scan.WORDS, passage.lower())
            a = vector(p)
            for s in range(len(ws)):
                b = vector(ws[s:s + len(p)])
                cos = sum(v * a.get(w, 0) for w, v in b.items()) / math.hypot(*a.values()) / math.hypot(*b.values())
                if ws[s] in a and cos >= license_scan.THRESHOLD:
                    best[name] = max(best.get(name, 0), cos)
        assert {x.license: x.similarity for x in out[i].found} == pytest.approx(best), i
    assert license_scan.licensed_windows(nothing, F.col("row")).count() == 0


def test_licence_files_by_name_and_share(spark):
    whole = {n: "\n".join(p for m, p in license_scan.PASSAGES if m == n) for n in ("MIT", "BSD-2-Clause", "BSD-3-Clause")}
    mit = whole["MIT"] + " as is, without warranty of any kind. " * 60
    files = [("a/LICENSE", mit), ("a/x/f.c", "int x;"), ("b/read.me", "a short text. Released under the MIT License. see more of it there"), ("b/g.c", "int x;"),
             ("c/terms", "Released under the MIT License."), ("c/d/h.c", None), ("e/Copying.txt", "notes, and\nReleased under the\nMIT License. " + "and more " * 90), ("e/i.c", ""),
             ("f/LICENSE", "no notice here"), ("f/j.c", "int x;"), ("g/mit.txt", whole["MIT"]), (None, "Released under the MIT License."), ("g/k.c", ""),
             ("h/two", whole["BSD-2-Clause"]), ("i/three", whole["BSD-3-Clause"])]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string")
    out = {r.doc_id: r for r in license_scan.licensed_windows(df, F.col("path")).collect()}
    assert len(mit.split()) > license_scan.FILE_WORDS
    assert [(out[i].license, out[i].inherited_from) for i in (1, 3, 5, 7, 9, 12)] == [("MIT", "a"), (None, None), ("MIT", "c"), ("MIT", "e"), (None, None), ("MIT", "g")]
    assert out[2].own_license == "MIT" and out[11].own_license == "MIT" and out[8].own_license is None
    assert out[13].own_license == "BSD-2-Clause" and out[14].own_license == "BSD-3-Clause"


def test_no_telling_word_means_no_license():
    unit, weight, other = license_scan.template_vectors(license_scan.TEMPLATES)
    tell = license_scan.telling(unit)
    for vector in unit.values():
        assert math.sqrt(sum(v * v for w, v in vector.items() if w not in tell)) < license_scan.THRESHOLD


def test_fingerprints(docs, rows, nothing):
    out = order_minhash.compare(docs).collect()
    line = sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    want = Counter()
    # rows of equal id and different text may stand in either order
    by_print = defaultdict(set)
    for r in out:
        want[(r.doc_id, r.n_chars)] += 1
        by_print[r.fingerprint].add(r.n_chars)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert want == Counter((r.doc_id, len(r.text or "")) for r in rows)
    single = [r for r in line if r.doc_id not in (None, 3, 7)]
    made = {r.doc_id: r for r in out}
    for r, nxt in zip(line, line[1:]):
        if r in single and nxt.doc_id not in (3, 7) and Counter(x.doc_id for x in rows)[r.doc_id] == 1:
            text, cut = r.text or "", len(r.text or "") // 3
            assert made[r.doc_id].edited_sha256 == hashlib.sha256((text[:len(text) - cut] + (nxt.text or "")[:cut]).encode()).hexdigest()
    ids = [r.doc_id for r in rows if r.text == rows[0].text]
    assert len({made[i].fingerprint for i in ids}) == 1
    assert order_minhash.compare(nothing).count() == 0


def test_order_minhash_components(spark):
    """The array expressions against plain loops over the same hashes."""
    texts = ["a b c d e f g h", "a a a a a", "x y", "", "b a c d e f h g a b c", "q"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.c for r in df.select("text", order_minhash.components("text").alias("c")).collect()}

    def spark_hash(cols):
        return spark.range(1).select(F.xxhash64(*cols)).first()[0]

    low = (1 << order_minhash.PLACE) - 1
    for t in texts:
        w = [spark_hash([F.lit(x)]) for x in t.split()]
        if len(w) < order_minhash.K:
            continue
        keys, seen = [], Counter()
        grams = sorted(((spark_hash([F.lit(x) for x in w[i:i + 3]]) & ~low) >> order_minhash.PLACE, i) for i in range(len(w) - 2))
        for g, i in grams:
            keys.append(((spark_hash([F.lit(g).cast("long"), F.lit(seen[g])]) & ~low) | i))
            seen[g] += 1
        bins = defaultdict(list)
        for k in sorted(keys):
            bins[k >> 58].append(k)
        want = []
        for b in sorted(bins):
            pair = sorted(bins[b][:2], key=lambda k: k & low)
            want.append((b + 32) * 65536 + (spark_hash([F.lit(k >> order_minhash.PLACE).cast("long") for k in pair]) & 65535))
        assert got[t] == want


def test_shards(docs, rows, nothing):
    out = histogram_shards.shard(docs, shards=4, carry=["doc_id"]).collect()
    assert Counter((r.row.doc_id, r.size) for r in out) == Counter((r.doc_id, len((r.text or "").encode()) + 8) for r in rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    assert all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    totals = [sum(x.size for x in by[i]) for i in range(4)]
    assert max(totals) - min(totals) <= 2 * max(r.size for r in out)
    assert histogram_shards.shard(nothing).count() == 0


def test_shards_split_one_large_group(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    sizes = histogram_shards.shard(df, shards=8).groupBy("shard").count().toPandas()
    assert len(sizes) == 8 and sizes["count"].max() - sizes["count"].min() <= 4


def test_packing(docs, rows, nothing):
    out = fit_packing.pack(docs, capacities=(64, 128, 512)).collect()
    assert sum(r.length for r in out) == sum(len((r.text or "").encode().split()) for r in rows)
    bins = defaultdict(list)
    for r in out:
        if r.length:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.part == 0
    for pieces in bins.values():
        used, capacity = sum(p.length for p in pieces), pieces[0].capacity
        assert capacity == min(c for c in (64, 128, 512) if c >= used)
        assert sorted((p.bin_offset, p.bin_offset + p.length) for p in pieces)[-1][1] == used
        assert len({p.bin_offset for p in pieces}) == len(pieces)
    assert fit_packing.pack(nothing).count() == 0


def test_equal_turns_stand_by_role_and_text(spark):
    texts = ["a!", "a", "aB", "a<", "a#", "a\\", "a\\h", "a#h", "a>", "a\\\\l", "a<l", "a\\<", ""]
    rows = [(1, 0, role, [{"type": "text", "text": t}]) for t in texts for role in ("user", "user2", "assistant", "<")]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>").repartition(3)
    (out,) = chat_format.digests(chat_format.format_turns(df)).collect()
    want = "".join(f"{role}\n{t}\n" for role, t in sorted((r[2], r[3][0]["text"]) for r in rows))
    assert out.turns_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_runs_of_bins_equal_single_bins():
    """Best fit on the histogram against best fit one piece at a time."""
    rng = random.Random(5)
    for _ in range(30):
        lengths = sorted((rng.choice([rng.randint(1, 100), 30, 50]) for _ in range(200)), reverse=True)
        free = []
        for n in lengths:
            fits = [f for f in free if f >= n]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - n)
            else:
                free.append(100 - n)
        steps, contents = fit_packing._fit(sorted(Counter(lengths).items(), reverse=True), (100,), 100)
        made = sorted(100 - used for a, b, used in contents for _ in range(a, b))
        assert len(made) == len(free) and sum(made) == sum(free)


def _price(plan):
    return sum((end - first) * fit_packing.cost(size) for first, end, size in plan[1])


def test_sizes_are_chosen_jointly(monkeypatch):
    """The planned bins hold every piece, and cost no more than one size for all or each length at its own best size."""
    rng = random.Random(9)
    cases = [({1365: 1000, 1024: 3000}, fit_packing.CAPACITIES), ({8192: 3}, fit_packing.CAPACITIES), ({}, fit_packing.CAPACITIES)]
    cases += [({rng.randint(1, 64): rng.randint(1, 400) for _ in range(rng.randint(1, 12))}, (8, 16, 32, 64)) for _ in range(15)]
    for histogram, sizes in cases:
        monkeypatch.setattr(fit_packing, "QUADRATIC", 16384.0 if max(sizes) == 8192 else rng.choice([16.0, 64.0, 1e9]))
        steps, bins = got = fit_packing.plan(list(histogram.items()), sizes)
        apart = 0.0
        for n, count in histogram.items():
            whole = {c: divmod(count, c // n) for c in sizes if c >= n}
            apart += min(full * fit_packing.cost(c) + (fit_packing.cost(min(d for d in sizes if d >= rest * n)) if rest else 0) for c, (full, rest) in whole.items()
                         if c == fit_packing._alone(n, sizes))
        assert _price(got) <= apart + 1e-6
        longest_first = sorted(histogram.items(), reverse=True)
        for c in sizes:
            _, contents = fit_packing._fit(longest_first, sizes, c)
            assert _price(got) <= sum((end - first) * fit_packing.cost(min(d for d in sizes if d >= used)) for first, end, used in contents) + 1e-6
        held = Counter()
        for n, rank, end, first, each, offset in steps:
            for i in range(end - rank):
                held[first + i // each] += n
        size_of = {b: size for first, end, size in bins for b in range(first, end)}
        assert set(held) == set(size_of) and all(held[b] <= size_of[b] for b in held)
        assert sum(held.values()) == sum(n * c for n, c in histogram.items())


def test_plans_against_all_packings(monkeypatch):
    """Up to seven pieces: never below the optimum of all partitions, and near it on the whole."""
    monkeypatch.setattr(fit_packing, "QUADRATIC", 16.0)
    sizes, rng, ratio = (4, 8, 16), random.Random(3), []
    for _ in range(40):
        pieces = [rng.randint(1, 16) for _ in range(rng.randint(1, 7))]
        total = [sum(p for i, p in enumerate(pieces) if m >> i & 1) for m in range(1 << len(pieces))]
        best = [0.0] + [math.inf] * (len(total) - 1)
        for m in range(1, len(total)):
            part = m
            while part:
                if total[part] <= 16:
                    best[m] = min(best[m], best[m ^ part] + fit_packing.cost(min(c for c in sizes if c >= total[part])))
                part = (part - 1) & m
        price = _price(fit_packing.plan(list(Counter(pieces).items()), sizes))
        assert price >= best[-1] - 1e-9
        ratio.append(price / best[-1])
    assert sum(ratio) / len(ratio) < 1.08 and max(ratio) < 1.5


def _brute_repeats(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(xxhash.xxh3_128_digest(r[i:i + length]) for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        marks = np.zeros(len(r) + 1, np.int64)
        for i in range(len(r) - length + 1):
            if seen[xxhash.xxh3_128_digest(r[i:i + length])] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        gone = np.cumsum(marks)[:len(r)] > 0
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("crowd,length,held", [(1024, 400, 4 << 20), (1, 400, 4 << 20), (1024, 240, 2000), (1, 97, 4 << 20)])
def test_repeats(docs, rows, nothing, monkeypatch, crowd, length, held):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", held)
    out = suffix_dedup.without_repeats(docs, carry=["doc_id"], length=length).collect()
    want = Counter((r.doc_id, *b) for r, b in zip(rows, _brute_repeats([r.text for r in rows], length)))
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == want
    if crowd > 1:
        rest = suffix_dedup.shortened(docs)
        assert rest.columns == docs.columns and rest.count() == len(rows) and rest.where("n_chars <> length(text)").count() == 0
        assert suffix_dedup.without_repeats(nothing).count() == 0


def test_seams_inside_characters(spark):
    """The repeated string starts with the second byte of characters whose first bytes differ."""
    passage = " ".join(f"p{i}" for i in range(200))[:420]
    df = spark.createDataFrame([(1, "one \u00e9" + passage + " end"), (2, "two \u0129" + passage + "."), (3, "\u00e9t\u00e9")],
                               "doc_id long, text string")
    assert {r.doc_id: r.text for r in suffix_dedup.shortened(df).collect()} == {1: "one  end", 2: "two .", 3: "\u00e9t\u00e9"}


def test_anchors_are_the_rightmost_least_hashes():
    rng = np.random.default_rng(4)
    for raw in (b"ab" * 300, b"x" * 700, bytes(rng.integers(97, 123, 900).astype(np.uint8)), bytes(rng.integers(97, 99, 900).astype(np.uint8))):
        h = suffix_dedup.gram_hashes(np.frombuffer(raw, np.uint8))
        for wide in (65, 100, len(h)):
            want = {max(j for j in range(i, i + wide) if h[j] == h[i:i + wide].min()) for i in range(len(h) - wide + 1)}
            assert suffix_dedup.anchors(h, wide).tolist() == sorted(want)


def test_segments_of_documents_laid_end_to_end(monkeypatch):
    """One pass over the bytes of many documents finds what each has alone; no window and no segment crosses into the next."""
    rng, passes, plain = np.random.default_rng(6), [], suffix_dedup.gram_hashes
    passage = bytes(rng.integers(97, 123, 700).astype(np.uint8))
    raws = [b"", passage, b"short", passage[:399], passage[:400], b"x" * 900, b"", b"ab" * 300 + passage, passage[150:] + b"ab" * 300, b"y" * 31, b""]
    raws += [bytes(rng.integers(97, 97 + k, rng.integers(0, 1500)).astype(np.uint8)) for k in (1, 2, 3, 26) * 10]
    for length in (400, 97):
        wide, edges, want, cores = length - 31, suffix_dedup._edges(length), {}, defaultdict(set)
        for i, raw in enumerate(raws):
            h = plain(np.frombuffer(raw, np.uint8)) if len(raw) >= length else np.empty(0, np.uint64)
            least = (h >> np.uint64(32)) | np.uint64(1)
            for j in range(len(h) - wide + 1):
                p = j + max(k for k in range(wide) if least[j + k] == least[j:j + wide].min())
                lo = max(0, p - wide + 1)
                want[i, p] = int(h[p].view(np.int64)), raw[lo:p + length], p - lo
        text = np.frombuffer(b"".join(raws), np.uint8)
        first = np.concatenate(([0], np.cumsum([len(r) for r in raws])))[:-1]
        monkeypatch.setattr(suffix_dedup, "gram_hashes", lambda *a: passes.append(1) or plain(*a))
        doc, anchor, segment, place, size, core, held = suffix_dedup.segments(text, first, length)
        monkeypatch.setattr(suffix_dedup, "gram_hashes", plain)
        assert sorted(zip(doc.tolist(), place.tolist())) == sorted(want)
        classes = defaultdict(set)
        for i, p, a, s, n, c, ok in zip(doc.tolist(), place.tolist(), anchor.tolist(), segment.tolist(), size.tolist(), core, held):
            assert (a, n) == (want[i, p][0], len(want[i, p][1]))
            classes[s].add(want[i, p][1:])
            for j in range(suffix_dedup.PARTS):
                inside = [o for o in range(edges[j], edges[j + 1]) if 0 <= p - o and p - o + length <= len(raws[i])]
                assert bool(inside) == bool(ok[j])
                if inside:
                    cores[a, j, int(c[j])].add(raws[i][p - edges[j]:p - edges[j + 1] + 1 + length])
        assert all(len(c) == 1 for c in classes.values()) and all(len(c) == 1 for c in cores.values())
        assert len(classes) == len({w[1:] for w in want.values()})
    assert len(passes) == 2


def test_common_prefixes_of_some_positions():
    """Only starts of whole strings are compared, each with the start before it."""
    rng = random.Random(3)
    for _ in range(40):
        text = np.frombuffer(bytes(rng.choices(b"ab", k=60)), np.uint8)
        left = np.concatenate((np.arange(25, 0, -1), np.arange(35, 0, -1)))
        raw = [text[i:i + left[i]].tobytes() for i in range(60)]
        order = np.array(sorted((i for i in range(60) if left[i] >= rng.choice((3, 8))), key=lambda i: (raw[i], i)), np.int64)
        got = suffix_dedup.permuted_prefixes(text, left, order)
        assert [int(got[b]) for b in order[1:]] == [len(os.path.commonprefix([raw[a], raw[b]])) for a, b in zip(order, order[1:])]
        assert got.sum() == got[order[1:]].sum()


def test_ranks_are_sorted_no_deeper_than_the_string(monkeypatch):
    """LMS names reach two bytes at least, so eight doublings order strings of 400 bytes; nothing is sorted after them."""
    rng, sorts, plain = np.random.default_rng(2), [], np.argsort
    passage = rng.integers(97, 101, 3000).astype(np.uint8)
    t = np.concatenate([np.append(passage, 0).astype(np.int16) for _ in range(3)])
    monkeypatch.setattr(np, "argsort", lambda x, **kind: sorts.append(x.dtype) or plain(x, **kind))
    order = suffix_dedup.suffix_array(t, 400)
    assert sum(d == np.int64 for d in sorts) <= 8
    raw = t.tobytes()
    keys = [raw[2 * i:2 * min(i + 400, i // 3001 * 3001 + 3000)] for i in order.tolist() if t[i]]
    assert all(int.from_bytes(a[1:2]) == 0 for a in keys[:1]) and [k[::2] for k in keys] == sorted(k[::2] for k in keys)


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(40):
        pieces = [bytes(rng.choices(rng.choice([b"ab", b"abc\0", b"a"]), k=rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        sizes = np.array([len(p) for p in pieces])
        first = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        t = text.astype(np.int16) + 1
        t[first + sizes] = 0
        plain = t.astype(np.int64).copy()
        plain[first + sizes] = np.arange(len(pieces))
        plain[t > 0] += len(pieces)
        order = suffix_dedup.suffix_array(t, 400)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: plain[i:].tolist())
        piece = np.repeat(np.arange(len(pieces)), sizes + 1)
        left = sizes[piece] - (np.arange(len(text)) - first[piece])
        got = suffix_dedup.permuted_prefixes(text, left, order)
        for a, b in zip(order, order[1:]):
            n = 0
            while n < min(left[a], left[b]) and text[a + n] == text[b + n]:
                n += 1
            assert got[b] == n


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(sliced_topk, "BLOCK", 64)
    monkeypatch.setattr(sliced_topk, "QUERIES", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 340)]
    rows += [(400, None), (500, [None] * 8), (600, [float("nan")] * 8), (700, [float("inf")] + [0.0] * 7), (None, [9.0] * 8), (5, [0.1] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sliced_topk.top_k(df, F.col("vec_id") % 100 == 0, k=10).collect()
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    want = {}
    for q, v in good:
        if q is not None and q % 100 == 0:
            all_ = sorted(((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in good if i != q))[:10]
            want[q] = [(None if n else i, -s) for s, n, i in all_]
    assert dict(got) == want
    assert sliced_topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("most", [8, 256])
def test_top_k_of_large_components(spark, monkeypatch, most):
    """Integers beyond +-2^25 and scores beyond a long, next to ordinary vectors; extra columns with the names of its own."""
    monkeypatch.setattr(sliced_topk, "BLOCK", 64)
    monkeypatch.setattr(sliced_topk, "QUERIES", most)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 10.0 ** (i % 7), 4)]) for i in range(260)] + [(i, [40000.0, 1.0, 0.0, -0.0]) for i in range(260, 300)]
    rows += [(300, [1.0, 1.0]), (301, [50000.0, 0.0]), (302, [32768.0, 1.0]), (303, [32767.9999, 1.0]), (304, [-32768.0]), (305, [1e300, -1e300, 0.1, 0.0]),
             (400, [1.7e308, 1.7e308, 1e-300, 5e-324]), (500, [-1.7e308, 3.5, 2.0**53, 2.0**52 + 0.5]), (600, [1e18, 1e18, 1e18, 1e18]), (None, [1e17, 0.0]), (700, [])]
    df = spark.createDataFrame([(i, v, "b", 1, 2, "q") for i, v in rows], "vec_id long, embedding array<double>, block string, id int, score int, queries string").repartition(5)
    whole = lambda x: math.floor(Fraction(x) * 1024)
    good = [(i, [whole(x) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    got = defaultdict(list)
    for r in sorted(sliced_topk.top_k(df, F.col("vec_id") % 50 == 0, k=10).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    want = {}
    for q, v in good:
        if q is not None and q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in good if i != q)[:10]
            want[q] = [(None if n else i, -s if -(1 << 63) <= -s < 1 << 63 else None) for s, n, i in best]
    assert dict(got) == want and any(s is None for found in want.values() for _, s in found)


def test_pipeline(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs.collect(), pipeline.cut(stage(spark, docs, sf))
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_duplicates":
            sets, _, groups = _components(before, 5)
            assert len(kept[name]) == sum(1 if sets[g[0]] else len(g) for g in groups)
        if name == "repeated_passages":
            want = {r.doc_id: b[3].decode("utf-8", "ignore") for r, b in zip(before, _brute_repeats([r.text for r in before], pipeline.PASSAGE_BYTES))}
            assert {r.doc_id: r.text for r in kept[name]} == want
        if name == "packing":
            assert sum(r.length for r in kept[name]) == sum(len(r.text.encode().split()) for r in before)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(labels.get(r.doc_id, 1) == 1 for r in kept["quality"])
    assert pipeline.ORACLE_SQL is None and pipeline.run(spark, sf).count() == len(kept["packing"])


def test_queries_with_sql(spark, sf):
    import __spark_entry__ as entry
    import compare

    con = compare.connect(sf)
    assert isinstance(con, duckdb.DuckDBPyConnection)
    for name in ("op1_circulant_minhash", "op3_chat_format", "op10_sliced_topk"):
        result = compare.check(name, spark, con, sf, entry.queries(), entry.oracle_sql())
        assert result["ok"], result["why"]
