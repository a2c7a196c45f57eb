"""Periodic runs of words, by Lyndon roots.

A run is a maximal stretch of words with a smallest period q that it holds ``times`` times or more. By the theorem of runs each has a
Lyndon root: for the order of words or for its reverse, the longest Lyndon word that starts at some place of the run has q words. So:

1. Words are numbered. The first phase of Baier's suffix sorter groups the places of a text by their longest Lyndon prefix: groups are
   taken from the greatest to the least; each member is unlinked from the list of places that are left, and the place before it there
   has its own prefix lengthened by the member's. Places that gain equally often from a group split from theirs, to the place right
   above. What a group holds in the end starts with one and the same Lyndon word, whose length is the Lyndon array. No suffix is sorted.
2. This is done under both orders, the second being the first with numbers counted down.
3. Equal neighbouring roots (places of one group, a root's length apart) are one candidate, which is extended to both sides by the
   longest common extension of the text with itself shifted by q.

Before that, stretches without any run are set aside exactly: within a run every window of ``gram`` words occurs twice or more, so a
stretch is left at windows that occur once in it, until none does. Hashes of windows that collide only keep more words.

``damage`` makes the test cases: of documents chosen by a hash of their id, the tail repeats its first words.

Results of edge cases. Null, empty and blank texts have no words and no run, and an empty collapsed text. Rows without a doc_id, rows
that repeat one and equal texts are each judged by themselves; those without one are not damaged. Runs that tie for the greatest
exponent are told apart by start, then period. An empty table gives an empty result. Texts of any length are read whole; memory is a
few numbers for each word of the largest text. Columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import map_batches, mix, slices, space_words, windows

RUNS = "doc_id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"


def lyndon_groups(ranks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(group, length) of each place: places of a group start with the same longest Lyndon word, of that many numbers."""
    members: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, r in enumerate(ranks, 1):
        members[r].append(i)
    size, alive = [1] * len(members), [len(m) for m in members]
    lower, upper = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    group = [-1, *ranks]
    left, right = list(range(-1, len(ranks) + 1)), list(range(1, len(ranks) + 3))  # places count from 1; 0 and n + 1 are the ends
    g = len(members) - 1
    while g >= 0:
        own = members[g]
        if alive[g] != len(own):
            own = [i for i in own if group[i] == g]
        own.sort()
        gains: dict[int, int] = {}
        for i in own:
            p, q = left[i], right[i]
            right[p], left[q] = q, p
            gains[p] = gains.get(p, 0) + 1
        gains.pop(0, None)
        parts: dict[tuple[int, int], list[int]] = {}
        for p, k in gains.items():
            parts.setdefault((k, group[p]), []).append(p)
        for k, h in sorted(parts, reverse=True) if len(parts) > 1 else parts:  # those that gain most split first and end up highest
            part = parts[k, h]
            if alive[h] == len(part):
                size[h] += k * size[g]
                continue
            new, above = len(members), upper[h]
            alive[h] -= len(part)
            members.append(part), alive.append(len(part)), size.append(size[h] + k * size[g])
            lower.append(h), upper.append(above)
            upper[h] = lower[above] = new  # h lies below g, so something is above it
            for p in part:
                group[p] = new
        g = lower[g]
    found = np.array(group[1:], np.int64)
    return found, np.array(size, np.int64)[found] if len(found) else found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, looked at in blocks that grow."""
    at, step, n = 0, 16, min(len(a), len(b))
    while at < n:
        unequal = a[at : min(n, at + step)] != b[at : min(n, at + step)]
        k = int(unequal.argmax())
        if unequal[k]:
            return at + k
        at, step = at + step, step * 4
    return n


def runs_of(ids: np.ndarray, least: int = 6, times: int = 4) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` numbers or more that hold their period ``times`` times or more."""
    n, found = len(ids), set()
    for ranks in (ids, ids.max(initial=0) - ids):
        group, p = lyndon_groups(ranks.tolist())
        at = np.arange(n)
        # Of a run's roots all are whole but those at its ends, so times - 1 follow each other; the first of them is enough.
        ok = at + (times - 1) * p <= n
        for k in range(1, times - 1):
            ok[ok] = group[(at + k * p)[ok]] == group[ok]
        back = np.maximum(at - p, 0)
        ok &= ~((at >= p) & (group[back] == group))
        for i in at[ok].tolist():
            q = int(p[i])
            start = i - common(ids[:i][::-1], ids[: i + q][::-1])
            length = i + q + common(ids[i:], ids[i + q :]) - start
            if length >= max(least, times * q):
                found.add((start, length, q))
    return found


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which elements occur twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def stretches(hashes: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """(first, last + 1) of stretches that may hold runs. A run of smallest period q >= 2 has ``gram`` - 1 <= 2 q (times - 2) / 2, one of
    period 1 has a word more than a window, so in both every window is there again q words on or before."""
    gram = max(1, min(max(least, times) - 1, 2 * (times - 2) + 1))
    todo, out = [(0, len(hashes))], []
    while todo:
        lo, hi = todo.pop()
        if hi - lo < max(least, times):
            continue
        twice = _repeated(windows(hashes[lo:hi], gram))
        if twice.all():
            out.append((lo, hi))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], twice, [0]))))
        todo += [(lo + a, lo + b - 1 + gram) for a, b in edges.reshape(-1, 2).tolist()]
    return sorted(out)


def find_runs(words: list[bytes], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start, then period."""
    out = set()
    for lo, hi in stretches(mix(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)), least, times):
        numbers: dict[bytes, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words[lo:hi]], np.int64)
        out |= {(lo + start, length, q) for start, length, q in runs_of(ids, least, times)}
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def damage(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of which a tail repeats its first ones in a tenth of the documents, by the checksum of the id."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


def collapse(docs: DataFrame, least: int = 6, times: int = 4, damaged: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, the runs as starts, lengths and periods, and the text whose runs are cut to their first period."""

    def work(batches):
        for b in slices(batches, 128):
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = damage(space_words(text), doc_id) if damaged else space_words(text)
                runs = find_runs(words, least, times)
                n = len(words)
                if runs:
                    words = [words[i] for i in np.flatnonzero(~dropped(n, runs)).tolist()]
                rows.append((n, *(zip(*runs, strict=True) if runs else ((), (), ())), b" ".join(words)))
            n, starts, lengths, periods, texts = (list(c) for c in zip(*rows, strict=True))
            yield [b.column("doc_id"), n, starts, lengths, periods, pa.array(texts, pa.binary()).cast(pa.string())]

    return map_batches(docs.select("doc_id", "text"), work, RUNS)


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``collapse``: the number of runs, the one of the greatest exponent, and checksums of all runs and of the text."""
    run = F.arrays_zip("starts", "lengths", "periods")
    # lengths / periods compared as integers, so that equal exponents tie whatever the rounding
    higher = lambda x, y: (x["lengths"] * y["periods"] > y["lengths"] * x["periods"]) | y["periods"].isNull()
    none = F.struct(*(F.lit(None).cast("bigint").alias(c) for c in ("starts", "lengths", "periods")))
    best = F.aggregate(run, none, lambda top, x: F.when(higher(x, top), x).otherwise(top))
    lines = F.transform(run, lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("starts", "lengths", "periods"))), F.lit("\n")))
    one = found.select("doc_id", F.size("starts").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    start, length, period = (F.col(f"best.{c}") for c in ("starts", "lengths", "periods"))
    return one.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.expr("best.lengths * 1000 div best.periods").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
