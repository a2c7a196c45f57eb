"""Packing by cutting-stock column generation.

Documents become token ids with an end id. Whole sequences are cut off a document's front; what is left of it,
shorter than a sequence, is its remainder. The histogram of remainder lengths (at most ``size`` - 1 numbers) is
a cutting-stock problem: patterns are multisets of lengths that fit a sequence, a linear program chooses how
often to use each, and a knapsack dynamic program over the dual prices finds the next pattern worth adding.
Uses are rounded down, and only patterns that leave at most ``slack`` tokens free are used. What rounding leaves, about one use of each pattern (of which there are fewer than ``size``), is a small
residual problem of its own: the longest remainder that is left is filled up by a knapsack over the counts that are left, until
no fill comes within ``slack``. So patterns place nearly all remainders, of few documents too. Documents are then ranked within their
length by a salted count, and ranks are dealt to the pattern's places by arithmetic. The remainders that no pattern takes are laid end to
end and cut at sequence bounds; their last, partial sequence is cut into powers of two, which need no padding.

The driver sees only the histogram. Salts are dealt to rows by their place and kept in a table, so equal rows are spread.

Results of edge cases. Null texts count as empty ones and hold the end id alone. Repeated rows are packed as often as they
occur, and rows whose doc_id is null like others. An empty table gives an empty result. Which of documents of equal
length goes to which place is settled by salts and ids. Texts of any length are encoded whole. Columns besides
doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import map_batches, mix, slices
from .tables import written


#: Runs of white-space (all that Unicode counts as such), and the length from which on a run is not left to ``tiktoken``.
SPACE = re.compile(r"\s+")
LONG_RUN = 100_000


@lru_cache(maxsize=4)
def encoder(vocabulary: str, ranks: str | None = None) -> Callable[[str], np.ndarray]:
    """Ids of a text by the tokenizer file ``vocabulary`` (``tokenizers`` format, no special tokens added).

    Given a file of the same vocabulary as ``ranks``, ``tiktoken`` stands in with those, which give the same ids
    faster; texts that hold a special token's string, or a run of ``LONG_RUN`` white-space characters, over which
    ``tiktoken`` fails at about a million, go to the tokenizer itself.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    if ranks is None:
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    import public_tokenizers
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(ranks, "rb") if line.strip())}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or (len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in SPACE.finditer(text))):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def knapsack(values: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, dict[int, int]]:
    """The most valuable multiset of ``lengths`` within ``size``: (value, {index: copies})."""
    best, choice = np.zeros(size + 1), np.full(size + 1, -1)
    by = np.zeros(size + 1)
    index = np.full(size + 1, -1)
    by[lengths], index[lengths] = values, np.arange(len(lengths))
    for c in range(1, size + 1):
        total = by[1 : c + 1] + best[c - 1 :: -1][:c]
        k = int(total.argmax())
        if total[k] > best[c - 1] + 1e-12 and index[k + 1] >= 0:
            best[c], choice[c] = total[k], k + 1
        else:
            best[c], choice[c] = best[c - 1], 0
    picked: dict[int, int] = {}
    c = size
    while c > 0:
        if choice[c] <= 0:
            c -= 1
        else:
            picked[index[choice[c]]] = picked.get(index[choice[c]], 0) + 1
            c -= choice[c]
    return float(best[size]), picked


def column_generation(histogram: dict[int, int], size: int, rounds: int = 300, gap: float = 0.002) -> list[tuple[dict[int, int], float]]:
    """Patterns ({length: copies}) and how often each is used in the linear relaxation of the cutting-stock problem.

    A revised simplex with one row a length: prices by knapsack and keeps the inverse of the basis up to date. It
    ends within ``gap`` of the optimum, or after ``rounds``, as every round's basis is feasible.
    """
    lengths = np.array(sorted(k for k, n in histogram.items() if 0 < k < size and n > 0))
    if not len(lengths):
        return []
    m = len(lengths)
    demand = np.array([histogram[k] for k in lengths], float)
    copies = size // lengths
    columns = [{i: int(copies[i])} for i in range(m)]
    inverse = np.diag(1.0 / copies)
    x = demand / copies
    # Two lengths that fill a sequence exactly start together; the commoner one keeps a pattern of its own.
    row = {int(k): i for i, k in enumerate(lengths)}
    for k, i in row.items():
        j = row.get(size - k)
        if j is None or i >= j:
            continue
        rare, common = (i, j) if demand[i] < demand[j] else (j, i)
        columns[rare] = {i: 1, j: 1}
        inverse[rare, rare] = 1.0
        inverse[common, rare] = -1.0 / copies[common]
        x[rare], x[common] = demand[rare], (demand[common] - demand[rare]) / copies[common]
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        value, pattern = knapsack(np.maximum(prices, 0), lengths, size)
        if value <= 1 + gap:  # the optimum is at least the present sum of uses over ``value``
            break
        column = np.zeros(m)
        for i, n in pattern.items():
            column[i] = n
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * direction, 0)
        x[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        columns[out] = pattern
    return [({int(lengths[i]): n for i, n in columns[k].items()}, float(x[k])) for k in range(m) if x[k] > 0]


def best_fill(left: dict[int, int], size: int, slack: int = 0) -> dict[int, int]:
    """A multiset within the counts ``left``, with one of the longest length: of the first total within ``slack`` of ``size`` that is found
    as shorter and shorter lengths come in, which saves short ones for others, or else of the greatest total.

    Reachable totals are the bits of one number; a length is added in copies of 1, 2, 4 ... of its count."""
    longest = max(left)
    room, reached, steps = size - longest, 1, []
    enough = ((2 << room) - 1) >> max(0, room - slack) << max(0, room - slack)
    for length in sorted((k for k in left if k <= room), reverse=True):
        rest, copies = left[length] - (length == longest), 1
        while rest > 0 and length * copies <= room and not reached & enough:
            copies = min(copies, rest)
            steps.append((length, copies, reached))
            reached |= reached << length * copies
            rest, copies = rest - copies, copies * 2
    total = (reached & ((2 << room) - 1)).bit_length() - 1
    picked = {longest: 1}
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            picked[length] = picked.get(length, 0) + copies
            total -= length * copies
    return picked


class Plan:
    """Where the remainder of each (length, rank) goes."""

    def __init__(self, histogram: dict[int, int], size: int, slack: int = 4, rounds: int = 300):
        self.size = size
        left = {k: n for k, n in histogram.items() if 0 < k < size}
        places: dict[int, list] = {k: [] for k in left}
        self.sequences = 0

        def use(pattern: dict[int, int], most: float) -> bool:
            times = int(min(most, *(left[k] // n for k, n in pattern.items())))
            if size - sum(k * n for k, n in pattern.items()) > slack or times < 1:
                return False
            offset = 0
            for length, copies in sorted(pattern.items(), reverse=True):
                places[length].append((histogram[length] - left[length], copies, self.sequences, offset))
                left[length] -= copies * times
                offset += copies * length
            self.sequences += times
            return True

        solved = sorted(column_generation(left, size, rounds), key=lambda p: sorted(p[0].items()))
        for pattern, uses in solved:
            use(pattern, int(uses + 1e-6))
        rest = {k: n for k, n in left.items() if n}
        while rest:
            longest = max(rest)
            use(best_fill(rest, size, slack), np.inf)
            if left[longest] == rest[longest]:  # nothing fills it up
                del rest[longest]
            rest = {k: left[k] for k in rest if left[k]}
        # Interval tables by length: first rank, copies in a sequence, first sequence, first offset.
        self.places = {k: np.array(v, np.int64).reshape(-1, 4) for k, v in places.items()}
        self.placed = {k: histogram[k] - n for k, n in left.items()}
        self.base, total = {}, 0
        for k in sorted(left, reverse=True):
            self.base[k] = total
            total += k * left[k]
        self.full, tail = divmod(total, size)
        self.tail_bounds = []
        at = self.full * size
        for bit in range(size.bit_length() - 1, -1, -1):
            if tail >> bit & 1:
                self.tail_bounds.append((at, at + (1 << bit)))
                at += 1 << bit
        self.bounds = np.array([a for a, _ in self.tail_bounds], np.int64)
        self.rest = self.sequences + self.full + len(self.tail_bounds)

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start within the remainder, length, sequence, offset) of the pieces of one remainder."""
        if rank < self.placed[length]:
            table = self.places[length]
            first, copies, sequence, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1].tolist()
            turn, slot = divmod(rank - first, copies)
            return [(0, length, sequence + turn, offset + slot * length)]
        at = self.base[length] + (rank - self.placed[length]) * length
        out, done = [], 0
        while done < length:
            here = at + done
            if here < self.full * self.size:
                number, offset = divmod(here, self.size)
                room = self.size - offset
            else:
                k = int(np.searchsorted(self.bounds, here, "right")) - 1
                number, offset, room = self.full + k, here - self.tail_bounds[k][0], self.tail_bounds[k][1] - here
            take = min(room, length - done)
            out.append((done, take, self.sequences + number, offset))
            done += take
        return out


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, size: int = 1024, end_id: int = 0, slack: int = 4, rounds: int = 300, salt_rows: int = 4_000) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def encode(batches):
        ids_of = encoder(vocabulary, ranks)
        at = TaskContext.get().partitionId() << 36
        for b in slices(batches, 256):
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.append(ids_of(text) if text else np.zeros(0, np.uint32), np.uint32(end_id)).astype("<u4")
                cut = len(ids) // size * size
                rows.append((doc, len(ids), len(ids) - cut, [zlib.crc32(ids[k : k + size].tobytes()) for k in range(0, cut, size)], ids[cut:].tobytes()))
            deal = mix(np.arange(at, at + len(rows), dtype=np.int64).view(np.uint64)).view(np.int64)
            at += len(rows)
            yield [*(list(c) for c in zip(*rows, strict=True)), pa.array(deal)]

    tokens = written(map_batches(docs.select("doc_id", "text"), encode, "doc_id bigint, doc_tokens bigint, rest int, crcs array<bigint>, ids binary, deal bigint"), "tokens")

    # Ranks within a length: documents are salted, counted by (length, salt), and ranked inside a salt only.
    salts = max(1, -(-tokens.count() // salt_rows))
    salted = tokens.withColumn("salt", F.pmod("deal", F.lit(salts)).cast("int"))
    counts = salted.groupBy("rest", "salt").agg(F.count("*").alias("n"), F.max(F.size("crcs")).alias("most"))
    lengths = counts.groupBy("rest").agg(F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("rest").collect()
    histogram = {r.rest: r.n for r in lengths}
    most = max((r.most for r in lengths), default=0)
    plan = Plan(histogram, size, slack, rounds)
    before = np.cumsum([0, *histogram.values()]).tolist()
    shared = docs.sparkSession.sparkContext.broadcast((plan, dict(zip(histogram, before, strict=False))))

    offsets = counts.select("rest", "salt", (F.sum("n").over(Window.partitionBy("rest").orderBy("salt")) - F.col("n")).alias("lower"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("rest", "salt").orderBy("doc_id", "deal")) - 1)
    ranked = ranked.join(offsets, ["rest", "salt"]).select("doc_id", "doc_tokens", "rest", "crcs", "ids", (F.col("lower") + F.col("r")).alias("rank"))

    def place(batches):
        plan, before = shared.value
        for b in slices(batches, 2048):
            rows = []
            for doc, n, rest, crcs, ids, rank in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "rest", "crcs", "ids", "rank")), strict=True):
                number = plan.rest + (before[rest] + rank) * most
                rows += [(doc, k * size, size, crc, n, number + k, 0) for k, crc in enumerate(crcs)]
                if rest:
                    rows += [(doc, n - rest + start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, sequence, offset) for start, length, sequence, offset in plan.pieces(rest, rank)]
            yield [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]

    return map_batches(ranked, place, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
