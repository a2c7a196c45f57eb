"""Quality classifier: histogram gradient-boosted trees over document statistics, as flat arrays.

Statistics come from whole texts (``statistics``). Each is cut once into at most ``bins`` bins, so trees are grown and walked over bytes:
a tree of depth d is complete, its 2**d - 1 cuts and 2**d leaves lie in two rows of arrays, and node k's children are 2k + 1 and
2k + 2. A level of a tree is grown by one bincount over (node, feature, bin), and all rows and trees of a batch go down a level by
one gather. Trees are fitted to the logistic loss by Newton steps with row-wise subsamples.

The sample is bounded: at most ``sample`` labelled documents, those whose ids have the smallest hashes; only their statistics reach the
driver. Labels are rare among good texts, so scores are probabilities as the sample has them, and ``LEAST`` is the caller's.

Results of edge cases. Null and empty texts are scored like any text, by statistics of no word. Without labelled rows, or with labels of
one class only, every score is the share of good labels, smoothed by one of each. A label repeated for a document counts once, as good
if one of them is; of rows that repeat a doc_id with different texts the first text by order is learned from. Rows without an id are
scored, not learned from, and not held out. Equal texts have equal scores. An empty table gives an empty result. Texts of any length
are read whole. Columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality
from .arrays import map_batches, slices, utf8

#: What this module adds to the statistics of ``quality``.
MORE = ("beyond_ascii", "entropy", "longest_word", "top_word", "distinct_pairs", "bracket_share", "letter_share", "longest_line", "short_lines", "first_lines", "mean_sentence", "single_letters")
FEATURES = (*quality.FEATURES, *MORE)
#: A score from here on counts as good.
LEAST = 0.7

_LETTERS = np.r_[65:91, 97:123, 128:256]


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: a quarter, by a checksum of the id."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def statistics(text: str | None) -> list[float]:
    """The features of one whole text."""
    data = utf8(text)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, counts = len(words), np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, some = max(1, len(data)), max(1, n)
    share = counts[counts > 0] / size
    often: dict[bytes, int] = {}
    for w in words:
        often[w] = often.get(w, 0) + 1
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    more = [
        int(counts[128:].sum()) / size,
        float(-(share * np.log2(share)).sum()),
        math.log1p(max(map(len, words), default=0)),
        max(often.values(), default=0) / some,
        len(set(zip(words, words[1:]))) / some,
        int(counts[[40, 41, 91, 93, 123, 125]].sum()) / size,
        int(counts[_LETTERS].sum()) / size,
        math.log1p(int(lengths.max(initial=0))),
        float((lengths < 20).mean()) if len(lines) else 0.0,
        len({x[:10] for x in lines}) / max(1, len(lines)),
        n / (1 + int(counts[[33, 46, 63]].sum())),
        sum(len(w) == 1 for w in words) / some,
    ]
    return quality.statistics(text)[1] + more


@dataclass
class Forest:
    """``cuts`` of each feature; of each tree and inner node the feature and the last bin that goes left; of each leaf its value."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    base: float

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bins of the features, a byte each."""
        out = np.empty(x.shape, np.uint8)
        for j, c in enumerate(self.cuts):
            out[:, j] = np.searchsorted(c, x[:, j], "left")
        return out

    def raw(self, codes: np.ndarray) -> np.ndarray:
        """Log odds: all rows go down all trees at once."""
        n, (trees, inner) = len(codes), self.feature.shape
        first = np.arange(trees) * inner
        at = np.zeros((n, trees), np.int64)
        rows = np.arange(n)[:, None]
        feature, cut = self.feature.ravel(), self.bin.ravel()
        for _ in range((inner + 1).bit_length() - 1):
            node = first + at
            at = 2 * at + 1 + (codes[rows, feature[node]] > cut[node])
        return self.base + self.leaf.ravel()[np.arange(trees) * (inner + 1) + at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(self.codes(x))))


def _grow(codes: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, bins: int, ridge: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, last bin that goes left, leaf values, leaf of each row) of one tree, level by level."""
    n, k = codes.shape
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, 255, np.uint8)  # 255: all go left
    at = np.zeros(n, np.int64)
    place = codes + np.arange(k) * bins
    for level in range(depth):
        first, nodes = (1 << level) - 1, 1 << level
        slot = ((at - first)[:, None] * (k * bins) + place).ravel()
        sums = [np.bincount(slot, np.repeat(v, k), nodes * k * bins).reshape(nodes, k, bins).cumsum(axis=2) for v in (g, h)]
        left_g, left_h = sums
        all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
        gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
        gain[(left_h < least) | (all_h - left_h < least)] = 0
        best = gain.reshape(nodes, -1).argmax(axis=1)
        worth = gain.reshape(nodes, -1).max(axis=1) > 1e-6
        feature[first : first + nodes] = np.where(worth, best // bins, 0)
        cut[first : first + nodes] = np.where(worth, best % bins, 255)
        at = 2 * at + 1 + (codes[np.arange(n), feature[at]] > cut[at])
    at -= inner
    total = [np.bincount(at, v, inner + 1) for v in (g, h)]
    return feature, cut, -total[0] / (total[1] + ridge), at


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 3.0, least: float = 4.0, part: float = 0.7) -> Forest:
    """Newton boosting of the logistic loss; each tree sees a ``part`` of the rows."""
    k = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    base = math.log(share / (1 - share))
    inner = (1 << depth) - 1
    if not 0 < y.sum() < len(y):
        return Forest([np.zeros(0)] * k, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.uint8), np.zeros((0, inner + 1)), base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    forest = Forest(cuts, np.zeros((trees, inner), np.int64), np.zeros((trees, inner), np.uint8), np.zeros((trees, inner + 1)), base)
    codes, z, rng = forest.codes(x), np.full(len(y), base), np.random.default_rng(11)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        seen = rng.random(len(y)) < part
        forest.feature[t], forest.bin[t], leaf, _ = _grow(codes[seen], (p - y)[seen], (p * (1 - p))[seen], depth, bins, ridge, least)
        forest.leaf[t] = rate * np.clip(leaf, -4, 4)
        z += Forest(cuts, forest.feature[t : t + 1], forest.bin[t : t + 1], forest.leaf[t : t + 1], 0.0).raw(codes)
    return forest


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000, **options) -> Forest:
    """A forest from a bounded sample of labelled rows."""

    def stats(batches):
        for b in slices(batches):
            yield [b.column("doc_id"), b.column("quality"), [statistics(t) for t in b.column("text").to_pylist()]]

    rows = map_batches(quality.sample_of(docs, labels, sample), stats, "doc_id bigint, quality int, features array<double>").toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))[order]
    return fit(x, rows["quality"].to_numpy().astype(float)[order], **options)


def classify(docs: DataFrame, forest: Forest, least: float = LEAST) -> DataFrame:
    """Per row: doc_id, score, predicted (1 if the score is ``least`` or more)."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # at most 120 trees of 31 numbers

    def score(batches):
        for b in slices(batches):
            p = shared.value.score(np.array([statistics(t) for t in b.column("text").to_pylist()], float).reshape(-1, len(FEATURES)))
            yield [b.column("doc_id"), pa.array(p), pa.array((p >= least).astype(np.int32))]

    return map_batches(docs.select("doc_id", "text"), score, "doc_id bigint, score double, predicted int")
