"""Quality rules: gradient-boosted trees over document statistics, after two plain rules.

Statistics come from whole texts. The trees are fitted with the labels on a bounded sample of labelled
documents (``sample`` rows, those with the smallest hashes) and kept as flat node arrays, so a batch of
documents is scored by a few numpy gathers. Along chosen features the score may only fall: candidate
splits that would break the order are refused and the children's values are clamped at the middle.

Results of edge cases. Null or empty texts have no words and fail the base rule. Without any label of one of the two classes the
trees are empty and only the base rules decide. A label repeated for a document counts once, as good if one of them
is; of rows that repeat a doc_id with different texts the first text by order is learned from. Every row is judged, those that repeat
an id or have none too, and equal texts alike. An empty table gives an empty result. Texts of any length are read whole.
Columns besides those named are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import map_batches, slices, utf8

FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "words_a_line", "stop_share", "mark_share", "ends_share")
#: Along these the score may not rise.
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SPACE = np.array([32, 9, 10, 11, 12, 13])
_SYMBOL = np.frombuffer(b"#*$%&|<>", np.uint8)
#: The most frequent short words of four languages.
_STOP = frozenset(b"the of and to in is it that for with on as was der die das und in zu den von mit ist ein nicht sich de la le et les des en un que el y los se del las por con du une pour dans".split())
_MUL = np.uint64(0x9E3779B97F4A7C15)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features of one whole text."""
    data = utf8(text)
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(counts[:128].sum() + counts[192:].sum())
    word_chars = points - int(counts[_SPACE].sum())
    symbols = int(counts[_SYMBOL].sum())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n >= 4:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        g = (h[:-2] * _MUL + h[1:-1]) * _MUL + h[2:]
        order = np.argsort(g, kind="stable")
        same = g[order[1:]] == g[order[:-1]]
        if same.any():
            twice = np.zeros(n, bool)
            for at in (order[1:][same], order[:-1][same]):
                for k in range(3):
                    twice[at + k] = True
            repeat = int(twice.sum())
    chars, some = max(1, word_chars), max(1, n)
    distinct = len(set(words))
    features = [
        math.log1p(n),
        word_chars / some,
        symbols / chars,
        dup_lines / max(1, len(lines)),
        repeat / some,
        distinct / some,
        int(counts[65:91].sum()) / chars,
        int(counts[48:58].sum()) / chars,
        n / max(1, len(lines)),
        sum(w in _STOP for w in words) / some,
        int(counts[[33, 34, 39, 44, 46, 58, 59, 63]].sum()) / chars,
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / max(1, len(lines)),
    ]
    return [n, word_chars, symbols, dup_lines, repeat], features


@dataclass
class Trees:
    """Trees as arrays over nodes: a leaf points at itself. ``score`` is a probability."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
            z += self.value[at]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 5.0, falling: tuple = ()) -> Trees:
    """Newton boosting of the logistic loss on histograms; ``falling`` lists columns with a non-increasing effect."""
    rate_of = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = math.log(rate_of / (1 - rate_of))
    feature, cut, left, right, value, roots = [], [], [], [], [], []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = [np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]
        z = np.full(len(y), base)

        def leaf(v):
            feature.append(0), cut.append(np.inf), left.append(len(left)), right.append(len(right)), value.append(v)
            return len(value) - 1

        def grow(rows, g, h, low, high, deep):
            node = leaf(rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high)))
            best = (1e-6, None)
            if deep < depth:
                whole_g, whole_h = g[rows].sum(), h[rows].sum()
                for j, b in enumerate(binned):
                    if not len(cuts[j]):
                        continue
                    lg = np.cumsum(np.bincount(b[rows], g[rows], len(cuts[j]) + 1))[:-1]
                    lh = np.cumsum(np.bincount(b[rows], h[rows], len(cuts[j]) + 1))[:-1]
                    rg, rh = whole_g - lg, whole_h - lh
                    lv, rv = np.clip(-lg / (lh + ridge), low, high), np.clip(-rg / (rh + ridge), low, high)
                    gain = lg**2 / (lh + ridge) + rg**2 / (rh + ridge) - whole_g**2 / (whole_h + ridge)
                    gain[(lh < least) | (rh < least)] = 0
                    if j in falling:
                        gain[rv > lv] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k, lv[k], rv[k]))
            if best[1]:
                j, k, lv, rv = best[1]
                mid = (lv + rv) / 2
                side = binned[j][rows] <= k
                bounds = ((mid, high), (low, mid)) if j in falling else ((low, high), (low, high))
                feature[node], cut[node] = j, cuts[j][k]
                left[node] = grow(rows[side], g, h, *bounds[0], deep + 1)
                right[node] = grow(rows[~side], g, h, *bounds[1], deep + 1)
            return node

        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), -4.0, 4.0, 0))
            one = Trees(*map(np.array, (feature, cut, left, right, value)), np.array(roots[-1:]), 0.0, depth)
            s = one.score(x)
            z += np.log(s / (1 - s))
    return Trees(*(np.array(v, kind) for v, kind in ((feature, int), (cut, float), (left, int), (right, int), (value, float), (roots, int))), base, depth)


def sample_of(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Documents with a label of quality: the ``sample`` with the smallest hashes of their ids."""
    marked = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    few = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # at most ``sample`` rows of three numbers
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))  # combined before the shuffle


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, **options) -> Trees:
    """Trees from a bounded sample of labelled rows; only their statistics reach the driver."""

    def stats(batches):
        for b in slices(batches):
            yield [b.column("quality"), [statistics(t)[1] for t in b.column("text").to_pylist()], b.column("doc_id")]

    rows = map_batches(sample_of(docs, labels, sample).select("quality", "text", "doc_id"), stats, "quality int, features array<double>, doc_id bigint").toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))[order]
    y = rows["quality"].to_numpy().astype(float)[order]
    return fit(x, y, falling=tuple(FEATURES.index(f) for f in FALLING), **options)


def judge(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept and the score. The base rules are final."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        for b in slices(batches):
            both = [statistics(t) for t in b.column("text").to_pylist()]
            base = np.array([s for s, _ in both], np.int64).reshape(-1, 5)
            p = shared.value.score(np.array([f for _, f in both], float).reshape(-1, len(FEATURES)))
            failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
            yield [b.column("doc_id"), *(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)]

    return map_batches(docs.select("doc_id", "text"), score, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, score double")


def fingerprint(trees: Trees) -> str:
    """Names a fitted model in reports."""
    return hashlib.sha256(b"".join(a.tobytes() for a in (trees.feature, trees.cut, trees.value))).hexdigest()[:16]
