"""Language identification by a linear-chain conditional random field over the words of a text.

Every word has a label. Its emission scores are sums of weights of three kinds of features, each with a table of its own: its
affixes (the first and last one to four letters), its character n-grams (of two to four letters) and the word itself (the
lexicon). Neighbouring labels have transition weights. All are learned by
gradient ascent on the conditional likelihood, on sequences that join passages of documents in different
languages, so that switches inside a text are seen in training. A text is labelled by forward-backward: its
language is the label with the largest expected share of its letters, and the score is that share.

Forward and backward messages are computed for many blocks of words at once: the chain of each block is
reduced to one matrix, blocks are joined in order, and the messages inside follow from the block's ends. The
result is the exact marginals whatever the text's length.

Letters are the characters of Unicode category L; numbers such as superscripts, fractions and Roman numerals are none.

Results of edge cases. A text that is null, empty or has no letter is ``und`` with score 0. With no labelled row every text
is ``und``. An empty table gives an empty result. Repeated rows and rows whose doc_id is null are each judged. Of labels with
equal shares the first in the alphabet is taken. Texts of any length are read whole. Columns besides those named
are ignored, those to ``carry`` may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import map_batches, slices

#: Runs of letters of any script, and of letters and numbers that are no decimal digits, which ``re`` finds faster.
LETTERS, NEARLY = regex.compile(r"\p{L}+"), re.compile(r"[^\W\d_]+")
_STEP, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
#: Tables of weights by kind of feature: (first bucket, bits of the number of buckets).
KINDS = {"affix": (0, 14), "ngram": (1 << 14, 15), "lexicon": (3 << 14, 14)}
BUCKETS = 1 << 16
BLOCK = 32
#: Up to so many labels blocks are reduced to matrices.
MOST_LABELS = 32


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    words = NEARLY.findall(text.lower()) if text else []
    return words if not words or "".join(words).isalpha() else LETTERS.findall(text.lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of lower-cased words: (those of all words in a row, how many each word has)."""
    letters = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(begins, sizes)
    room = np.repeat(sizes, sizes) - place  # letters from here to the word's end, brackets counted
    word = np.repeat(np.arange(len(words)), sizes)

    def bucket(kind: str, hashes: np.ndarray) -> np.ndarray:
        first, bits = KINDS[kind]
        return (hashes * _STEP >> np.uint64(64 - bits)).astype(np.int64) + first

    whole = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    found, owner = [bucket("lexicon", whole)], [np.arange(len(words))]
    gram = letters * _STEP
    for k in (2, 3, 4, 5):  # with a bracket, affixes of one to four letters
        gram = (gram[:-1] ^ (gram[:-1] >> _SHIFT)) * _STEP + letters[k - 1 :]
        at, left = place[: len(gram)], room[: len(gram)]
        edge = (left >= k) & ((at == 0) != (left == k))
        kinds = [("affix", edge)] + [("ngram", (at > 0) & (left > k))] * (k < 5)
        for kind, here in kinds:
            found.append(bucket(kind, gram[here] + np.uint64(k)))
            owner.append(word[: len(gram)][here])
    flat, owner = np.concatenate(found), np.concatenate(owner)
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@dataclass
class Field:
    """A trained field: labels, weights (BUCKETS x labels), transitions (from x to)."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray


class Emissions(dict):
    """Row numbers of words in a growing table of emission scores; forgets all beyond ``most`` words."""

    def __init__(self, field: Field, most: int = 100_000):
        super().__init__()
        self.field, self.most = field, most
        self.reset()

    def reset(self):
        self.clear()
        self.new: list[str] = []
        self.parts = [np.zeros((0, len(self.field.labels)), np.float32)]

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def table(self) -> np.ndarray:
        """Scores of all words known, after those of new words have been computed."""
        for at in range(0, len(self.new), 4096):
            flat, sizes = features(self.new[at : at + 4096])
            sums = np.add.reduceat(self.field.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            self.parts.append(sums / np.sqrt(sizes)[:, None].astype(np.float32))
        if self.new:
            self.parts, self.new = [np.concatenate(self.parts)], []
        return self.parts[0]


def marginals(scores: np.ndarray, transitions: np.ndarray, starts: np.ndarray, messages: bool = False):
    """Label probabilities of each word. ``scores``: words x labels of all texts in a row; ``starts``: where texts begin.
    With ``messages`` also the forward messages."""
    n, k = scores.shape
    if not n:
        return (scores, scores) if messages else scores
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    t = np.exp(transitions - transitions.max())
    first = np.zeros(n, bool)
    first[starts] = True
    # Blocks of at most BLOCK words that do not cross texts; with many labels a matrix costs more than it saves, and a text is one block.
    sizes = np.diff(np.append(starts, n))
    block = BLOCK if k <= MOST_LABELS else int(sizes.max())
    counts = -(-sizes // block)
    text = np.repeat(np.arange(len(starts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[text] + inner * block
    length = np.minimum(block, sizes[text] - inner * block)
    blocks = len(begin)
    head = inner == 0

    def step_matrix(at):  # from the label before to the label of word ``at``
        m = t[None] * e[at][:, None, :]
        fresh = first[at]
        m[fresh] = (np.ones((k, k)) / k)[None] * e[at[fresh]][:, None, :]
        return m

    several = bool((counts > 1).any())
    whole = np.broadcast_to(np.eye(k), (blocks, k, k)).copy() if several else None
    for j in range(block if several else 0):
        on = length > j
        whole[on] = whole[on] @ step_matrix(begin[on] + j)
        if j % 8 == 7:
            whole /= whole.sum(axis=(1, 2), keepdims=True)
    into = np.empty((blocks, k))  # message before the block's first word
    out = np.empty((blocks, k))  # message after its last word
    order = np.argsort(inner, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(inner))[:-1])
    into[levels[0]] = 1 / k
    for a, b in zip(levels, levels[1:], strict=False):
        v = np.einsum("ij,ijk->ik", into[b - 1], whole[b - 1])
        into[b] = v / v.sum(axis=1, keepdims=True)
    last = np.append(head[1:], True)
    out[last] = 1 / k
    for b in reversed(levels):
        b = b[~last[b]]
        if len(b):
            v = np.einsum("ijk,ik->ij", whole[b + 1], out[b + 1])
            out[b] = v / v.sum(axis=1, keepdims=True)
    forward = np.empty((n, k))
    state = into.copy()
    for j in range(block):
        on = np.flatnonzero(length > j)
        at = begin[on] + j
        v = np.where(first[at][:, None], 1.0 / k, state[on] @ t) * e[at]
        v /= v.sum(axis=1, keepdims=True)
        forward[at] = v
        state[on] = v
    alpha = forward.copy() if messages else None
    back = out.copy()
    for j in range(block - 1, -1, -1):
        on = np.flatnonzero(length > j)
        at = begin[on] + j
        p = forward[at] * back[on]
        forward[at] = p / p.sum(axis=1, keepdims=True)
        v = (back[on] * e[at]) @ t.T
        back[on] = v / v.sum(axis=1, keepdims=True)
    return (forward, alpha) if messages else forward


def _gradient(scores, transitions, gold, starts):
    """Gradients of the log-likelihood for emissions and transitions."""
    k = scores.shape[1]
    p, alpha = marginals(scores, transitions, starts, messages=True)
    g = -p
    g[np.arange(len(gold)), gold] += 1
    inside = np.ones(len(gold), bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    # Pair marginals: from the message into a word, the share of each label before it.
    t = np.exp(transitions - transitions.max())
    pairs = t * (alpha[at - 1].T @ (p[at] / np.maximum(alpha[at - 1] @ t, 1e-300)))
    want = np.bincount(gold[at - 1] * k + gold[at], minlength=k * k).reshape(k, k)
    return g, want - pairs


def fit(rows: list[tuple[str, str]], passes: int = 3, rate: float = 0.3, passage: int = 60, seed: int = 7) -> Field:
    """A field from (text, label) rows. Passages of up to ``passage`` words are joined in threes at random."""
    labels = sorted({lang for _, lang in rows})
    k = len(labels)
    field = Field(labels, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)))
    passages = []
    for text, lang in rows:
        words = words_of(text)
        passages += [(words[i : i + passage], labels.index(lang)) for i in range(0, len(words), passage)]
    passages = [p for p in passages if p[0]]
    if k < 1 or not passages:
        return field
    rng = np.random.default_rng(seed)
    square_w, square_t = np.full((BUCKETS, k), 1e-2, np.float32), np.full((k, k), 1e-2)
    per = 24
    for _ in range(passes):
        order = rng.permutation(len(passages))
        for at in range(0, len(order), per):
            group = [passages[i] for i in order[at : at + per]]
            words = [w for ws, _ in group for w in ws]
            gold = np.repeat([y for _, y in group], [len(ws) for ws, _ in group])
            ends = np.cumsum([len(ws) for ws, _ in group])
            starts = np.append(0, ends[2:-1:3]) if len(ends) > 3 else np.zeros(1, int)
            flat, sizes = features(words)
            scale = 1 / np.sqrt(sizes)
            scores = np.add.reduceat(field.weights[flat], np.append(0, np.cumsum(sizes)[:-1]), axis=0) * scale[:, None]
            g, gt = _gradient(scores, field.transitions, gold, starts)
            spread = np.repeat(g * scale[:, None], sizes, axis=0)
            touched, where = np.unique(flat, return_inverse=True)
            total = np.zeros((len(touched), k))
            np.add.at(total, where, spread)
            total -= 1e-3 * field.weights[touched]
            square_w[touched] += total**2
            field.weights[touched] += (rate * total / np.sqrt(square_w[touched])).astype(np.float32)
            square_t += gt**2
            field.transitions += rate * gt / np.sqrt(square_t)
    return field


def training_rows(docs: DataFrame, sample: int = 300, passages: int = 5, letters: int = 400, total: int = 6000) -> list[tuple[str, str]]:
    """The sample that the field is fitted on, as (passage, label): of each language up to ``sample`` labelled documents, those
    with the smallest hashes of ids and texts. With more languages than ``total`` / ``sample`` each has fewer documents, but
    one at least. Of each document, without all that is no letter, up to ``passages`` passages of about ``letters``
    characters at hashed places of the whole text; a text that is no longer than that is taken whole."""
    known = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text", F.xxhash64("doc_id", "text").alias("at"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    each = max(1, min(sample, total // len(counts)))

    def smallest(rows):
        rows = rows.where(F.col("text").rlike(r"\p{L}"))
        # Spark keeps the first ``each`` of a language in every task before it deals them out.
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id", "text"))
        some = rows.withColumn("rank", rank).where(F.col("rank") <= each)
        some = some.select("lang", "rank", "at", F.trim(F.regexp_replace("text", r"\P{L}+", " ")).alias("text"))
        room = F.length("text") - letters
        places = F.array(*(F.substring("text", F.pmod(F.xxhash64("at", F.lit(k)), room).cast("int") + 1, F.lit(letters)) for k in range(passages)))
        return some.select("lang", "rank", F.when(F.length("text") <= passages * letters, F.array("text")).otherwise(places).alias("parts")).collect()

    # For each language a hash range that surely holds the sample spares sorting the rest; copies, which share a hash, and texts without a letter may leave too few in it.
    ends = {lang: min((1 << 63) - 1, int((1 << 64) * min(1.0, (2 * each + 30) / n)) - (1 << 63)) for lang, n in counts.items()}
    some = smallest(known.where(F.col("at") <= F.create_map(*(F.lit(x) for e in ends.items() for x in e))[F.col("lang")]))
    got = Counter(r.lang for r in some)
    short = [lang for lang, n in counts.items() if got[lang] < min(each, n)]
    if short:
        some = [r for r in some if r.lang not in set(short)] + smallest(known.where(F.col("lang").isin(short)))
    out = []
    for r in sorted(some, key=lambda r: (r.lang, r["rank"])):
        for part in r.parts:
            words = part.split(" ")
            # A passage from inside a text begins and ends within words.
            out.append((" ".join(words[1:-1] if len(r.parts) > 1 and len(words) > 4 else words), r.lang))
    return out


def train(docs: DataFrame, sample: int = 300, **options) -> Field:
    return fit(training_rows(docs, sample), **options)


def identify(docs: DataFrame, field: Field, carry: tuple[str, ...] = (), words_at_once: int = 60_000) -> DataFrame:
    """Per row: doc_id, lang_pred, score, shares (of letters, in the order of the labels) and the columns to ``carry``."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def predict(batches):
        model = shared.value
        k = len(model.labels)
        few = MOST_LABELS / max(k, MOST_LABELS)  # tables of words x labels stay as large as with few labels
        cache = Emissions(model, int(100_000 * few))
        for b in slices(batches, 256):
            texts = b.column("text").to_pylist()
            shares = np.zeros((len(texts), max(k, 1)))

            def flush(group, shares=shares):
                rows = np.concatenate([r for _, r, _ in group])
                letters = np.concatenate([n for _, _, n in group])
                starts = np.cumsum([0, *(len(r) for _, r, _ in group)])[:-1]
                p = marginals(cache.table()[rows], model.transitions, starts) * letters[:, None]
                shares[[i for i, _, _ in group]] = np.add.reduceat(p, starts, axis=0) / np.add.reduceat(letters, starts)[:, None]

            group, held = [], 0
            for i, text in enumerate(texts):
                words = words_of(text) if k else []
                if not words:
                    continue
                group.append((i, cache.rows(words), np.fromiter(map(len, words), np.float64, len(words))))
                held += len(words)
                if held >= words_at_once * few or len(cache) > cache.most:
                    flush(group)
                    group, held = [], 0
                    if len(cache) > cache.most:
                        cache.reset()
            if group:
                flush(group)
            best = shares.argmax(axis=1)
            score = shares.max(axis=1)
            pred = [model.labels[j] if s > 0 else "und" for j, s in zip(best.tolist(), score.tolist(), strict=True)]
            yield [b.column("doc_id"), pred, pa.array(np.clip(score, 0.0, 1.0)), pa.array(shares[:, :k].tolist(), pa.list_(pa.float64())), *(b.column(f"_{c}") for c in carry)]

    kinds = dict(docs.dtypes)
    carried = "".join(f", _{c} {kinds[c]}" for c in carry)
    found = map_batches(docs.select("doc_id", "text", *(F.col(c).alias(f"_{c}") for c in carry)), predict, "doc_id bigint, lang_pred string, score double, shares array<double>" + carried)
    return found.withColumnsRenamed({f"_{c}": c for c in carry})


def held_out():
    """Documents whose label is never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
