"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text becomes a few shape features (Arrow batches, one pass). The model is a sum of lookup tables, one a feature and one
a chosen pair of features, learned by cyclic boosting: round after round each feature in turn gets a shallow tree (at most four
leaves over its bins) fitted to the gradient of the logistic loss, added at a small rate to its table. Then the pairs whose
tables would lower the remaining loss most get the same treatment over two-dimensional bins. A score is a few table look-ups and
additions, done for a batch at once.

The fit uses a bounded sample of labelled rows, SAMPLE of them about, chosen by a hash of the id; features, scores and the bins of
scoring cover every document. Only the text makes features: never labels, lang, source or id.

Nulls and ties: null and empty texts have all features 0 and get a score like others. Labels other than 0 and 1, and rows without an
id, are not learned from; an id labelled both ways counts as 0. Without any label to learn from every score is 1. Repeated rows
are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 40_000
THRESHOLD = 0.7
FEATURES = ["words", "bytes", "word_length", "longest", "upper", "digits", "wide", "exclaims", "symbols", "bars", "stops", "commas",
            "other_marks", "breaks", "distinct", "commonest", "echoes", "line_copies", "short_words"]

#: Classes of bytes: 0 white space, 1 upper, 2 lower, 3 digit, 4 beyond ASCII, then marks.
_CLASS = np.full(256, 11, np.uint8)
for _bytes, _kind in ((b" \t\r\x0b\x0c", 0), (b"\n", 12), (bytes(range(65, 91)), 1), (bytes(range(97, 123)), 2), (b"0123456789", 3),
                      (bytes(range(128, 256)), 4), (b"!?", 5), (b"*$%&#@^~", 6), (b"|", 7), (b".", 8), (b",", 9)):
    _CLASS[list(_bytes)] = _kind
_KINDS = 13


def text_features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES a text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=_KINDS)
        words = raw.split()
        n = len(words)
        if not n:
            continue
        lines = [x for x in raw.split(b"\n") if x]
        letters = kinds[1] + kinds[2] + kinds[4]
        seen = Counter(words)
        lengths = list(map(len, words))
        out[i] = (
            np.log1p(n), np.log1p(len(raw)), sum(lengths) / n, np.log1p(max(lengths)), kinds[1] / max(letters, 1), kinds[3] / len(raw),
            kinds[4] / len(raw), kinds[5] / n, kinds[6] / n, kinds[7] / n, kinds[8] / n, kinds[9] / n, kinds[11] / n, kinds[12] / n,
            len(seen) / n, max(seen.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            1 - len(set(lines)) / max(len(lines), 1), sum(x <= 3 for x in lengths) / n)
    return out


def featured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the features of every whole text."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = text_features(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(made[:, j]) for j in range(len(FEATURES)))], [key, *FEATURES])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


def _leaves(grad: np.ndarray, hess: np.ndarray, cuts: int = 3, ridge: float = 1.0) -> np.ndarray:
    """Values of a shallow tree over ordered bins: the best cut of all parts, up to three times."""
    n = len(grad)
    g, h = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(hess))
    part = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    edges = [0, n]
    for _ in range(cuts):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            at = np.arange(a + 1, b)
            if len(at):
                gain = part(a, at) + part(at, b) - part(a, b)
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(n)
    for a, b in zip(edges, edges[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _quarters(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """The best cut along one axis, then the best cut of each side along the other; its values and its gain."""
    best = (np.zeros_like(grad), 0.0)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        rows_g, rows_h = np.cumsum(g, 0), np.cumsum(h, 0)
        for k in range(len(g) - 1):
            value, gain = np.zeros_like(g), 0.0
            for part, sg, sh in ((slice(0, k + 1), rows_g[k], rows_h[k]), (slice(k + 1, None), rows_g[-1] - rows_g[k], rows_h[-1] - rows_h[k])):
                cg, ch = np.cumsum(sg), np.cumsum(sh)
                score = cg[:-1] ** 2 / (ch[:-1] + ridge) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + ridge)
                if not len(score):
                    continue
                j = int(np.argmax(score))
                gain += float(score[j])
                value[part, :j + 1] = cg[j] / (ch[j] + ridge)
                value[part, j + 1:] = (cg[-1] - cg[j]) / (ch[-1] - ch[j] + ridge)
            if gain > best[1]:
                best = (value.T if turned else value, gain)
    return best


@dataclass
class Additive:
    """Tables over bins; score() adds them up."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 8, rounds: int = 120, pairs: int = 6,
            pair_rounds: int = 40, rate: float = 0.15) -> Additive:
        if not len(y):
            self.base = np.inf
            return self
        prior = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(prior / (1 - prior)))
        steps = lambda v, n: np.unique(np.quantile(v, np.linspace(0, 1, n + 1)[1:-1]))
        self.edges = [steps(x[:, j], bins) for j in range(x.shape[1])]
        self.coarse = [steps(x[:, j], coarse) for j in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        fine = [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)]
        rough = [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.coarse)]
        total = np.full(len(y), self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-total))
            return y - p, p * (1 - p)

        for _ in range(rounds):
            for j, own in enumerate(fine):
                g, h = slopes()
                n = len(self.tables[j])
                step = rate * _leaves(np.bincount(own, g, n), np.bincount(own, h, n))
                self.tables[j] += step
                total += step[own]
        g, h = slopes()
        ranked = []
        for a in range(len(fine)):
            for b in range(a + 1, len(fine)):
                shape = (len(self.coarse[a]) + 1, len(self.coarse[b]) + 1)
                cell = rough[a] * shape[1] + rough[b]
                _, gain = _quarters(*(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
                ranked.append((-gain, a, b))
        chosen = [(a, b) for _, a, b in sorted(ranked)[:pairs]]
        self.pairs = [(a, b, np.zeros((len(self.coarse[a]) + 1, len(self.coarse[b]) + 1))) for a, b in chosen]
        for _ in range(pair_rounds):
            for a, b, grid in self.pairs:
                g, h = slopes()
                cell = rough[a] * grid.shape[1] + rough[b]
                value, _ = _quarters(*(np.bincount(cell, v, grid.size).reshape(grid.shape) for v in (g, h)))
                grid += rate * value
                total += rate * value.ravel()[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if np.isfinite(self.base):
            for j, (edge, values) in enumerate(zip(self.edges, self.tables)):
                total += values[np.searchsorted(edge, x[:, j], "left")]
            for a, b, grid in self.pairs:
                total += grid[np.searchsorted(self.coarse[a], x[:, a], "left"), np.searchsorted(self.coarse[b], x[:, b], "left")]
        return 1 / (1 + np.exp(-total))


def fold(key: str = "doc_id") -> Column:
    """Rows of remainder 2 are held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text") -> Additive:
    """Fits on about `sample` of the documents that labels marks and that are not held out."""
    marks = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & (fold(key) != 2)).groupBy(key).agg(
        F.min("quality").alias("_quality"))
    known = marks.count()
    if not known:
        return Additive().fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    share = int((1 << 30) * min(1.0, sample / known))
    marks = marks.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share)  # about `sample` rows, however many labels there are
    rows = featured(docs.select(key, text).join(F.broadcast(marks.select(key)), key), key, text).toPandas()
    rows = rows.merge(marks.toPandas(), on=key).sort_values([key, *FEATURES], ignore_index=True)
    return Additive().fit(rows[FEATURES].to_numpy(), rows["_quality"].to_numpy().astype(float))


def scored(docs: DataFrame, model: Additive, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score: one row a document."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(text_features(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], [key, "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """key, held_out, score, predicted (1 where score >= THRESHOLD): one row a document."""
    return scored(docs, learn(docs, labels, sample, key, text), key, text).select(
        key, F.coalesce(fold(key) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that the classifier does not reject, columns as they came."""
    model = learn(docs, labels, sample, key, text)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(text_features(b.column(at).to_pylist())) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
