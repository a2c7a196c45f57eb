"""Substring dedup by level-wise doubling.

A window of ``window`` words is removed where its word sequence also starts in a document with a smaller
doc_id. Lengths rise by doubling from ``SHORTEST`` words on, and only windows that repeat at one length are extended:

* At the first length all windows are judged: does the same one start in another document?
* At each further length a window is a candidate only if both windows of the length before that it begins and ends
  with repeat. The last length is reached by overlap (4, 8, 13 for 13 words: two windows of 8 that share three).
* A batch of documents in which no candidate survives sends nothing more, and its texts stay as they are.

Documents are dealt into batches. A batch sends each distinct hash once, packed by hash range; the range's reducer answers
with two bits for each hash: it repeats in another document, and it starts in a document of a smaller id than the
batch's smallest. So a passage that a third of all documents share costs one entry for each batch, a group of
copies is never gathered anywhere, and texts are shuffled once (the exchange of the batches is reused by every level).
Before the last length a hash is its range and 24 bits, of which the gaps to the one before are sent: two bytes instead
of eight. A few in a hundred meet another window's hash by chance and go on to the next length, where it shows. At the last length,
which decides, a window has two hashes of 64 bits, the second made of its words' hashes mixed anew: of W distinct candidate windows about
W*W/2**129 collide, fewer than one in a hundred corpora of 10**18 candidates each. Two words with one hash of 64 bits matter only where all
their neighbours are equal too.

Results of edge cases. Null, blank and short texts have no windows and lose nothing. A row whose doc_id is null is neither
judged nor a source. Rows that repeat an id do not remove each other's words, and may lie in different batches, as may equal rows from
different partitions. An empty table gives an empty result. A text is cut whole in one task, whatever its length. Columns besides
those named are ignored, those to ``carry`` may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, release, schema_of, utf8, windows, word_hashes

#: Characters of text in a batch, and of text for each range of hashes, on average.
BATCH_CHARS, RANGE_CHARS = 3_000_000, 2_000_000
#: Words of the shortest windows, and bits of a hash within its range before the last length.
SHORTEST, CODE_BITS = 4, 24
#: Added to the hash of a word before it is mixed anew.
SECOND = np.uint64(0xA0761D6478BD642F)

_SKIP = 65535
#: The range under which a batch keeps note of its own candidates is -1 - batch.
_SENT = "hash_range bigint, batch bigint, hashes binary, firsts binary, many binary"
_ANSWER = "batch bigint, hash_range bigint, repeats binary, earlier binary"


def lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths: doubling from ``shortest`` until ``window``."""
    out = [shortest]
    while out[-1] < window:
        out.append(2 * out[-1])
    return [*out[:-1], window]


def gaps(codes: np.ndarray) -> bytes:
    """Ascending distinct codes as two-byte gaps; longer ones are several skips and a rest."""
    step = np.diff(codes.astype(np.int64), prepend=-1)
    skips = step // _SKIP
    out = np.full(len(codes) + int(skips.sum()), _SKIP, np.uint16)
    out[np.arange(len(codes)) + np.cumsum(skips)] = step % _SKIP
    return out.tobytes()


def codes_of(packed: bytes) -> np.ndarray:
    step = np.frombuffer(packed, np.uint16)
    return (np.cumsum(step, dtype=np.int64)[step != _SKIP] - 1).astype(np.uint64)


def grouped(first: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys of one or two hashes: (an order by them, where in it another key begins, the number of each key)."""

    def changes(hashes):
        found = np.ones(len(hashes), bool)
        found[1:] = hashes[order[1:]] != hashes[order[:-1]]
        return found

    order = np.argsort(first, kind="stable")  # what batches send is in order already
    new = changes(first)
    if second is not None and (changes(second) > new).any():  # one first hash, two windows
        order = np.lexsort((second, first))
        new = changes(first) | changes(second)
    group = np.empty(len(first), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, new, group


class Batch:
    """Words of a batch of documents as one flat array of hashes."""

    def __init__(self, rows: pa.Table, plan: list[int], ranges: int):
        ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
        order = sorted((k for k in range(len(ids)) if ids[k] is not None), key=lambda k: (ids[k], texts[k] or ""))
        self.rows = [(ids[k], texts[k]) for k in order]
        apart = [k for k in range(len(ids)) if ids[k] is None]
        self.whole = [(None, texts[k]) for k in apart]
        self.order = [*order, *apart]
        self.plan, self.ranges = plan, np.uint64(ranges)

    def hash_words(self) -> None:
        parts = [word_hashes(utf8(text).split()) for _, text in self.rows]
        sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(sizes)
        self.word = np.concatenate([*parts, np.zeros(0, np.uint64)])
        self.doc = np.repeat(np.array([d for d, _ in self.rows], np.int64), sizes)
        self.end = np.repeat(self.ends, sizes)

    def starts(self, length: int) -> np.ndarray:
        """Flat positions where a window of ``length`` words of one document starts."""
        at = np.arange(len(self.word), dtype=np.int64)
        return at[at + length <= self.end]

    def keys(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys in the order of their ranges, the index into them of each window at ``at``). A key of the last length is a
        row of two hashes."""
        length = self.plan[level]
        key = windows(self.word, length)[at]
        if level < len(self.plan) - 1:
            return np.unique(self.range_of(key) << np.uint64(CODE_BITS) | key & np.uint64((1 << CODE_BITS) - 1), return_inverse=True)
        second = windows(mix(self.word + SECOND), length)[at]
        order, new, index = grouped(key, second)
        distinct = order[new]
        return np.stack([key[distinct], second[distinct]], axis=1), index

    def range_of(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * self.ranges) >> np.uint64(32)

    def cuts(self, level: int, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(range, first, end) of the slices of sorted keys."""
        found, at = np.unique(self.range_of(keys[:, 0]) if level == len(self.plan) - 1 else keys >> np.uint64(CODE_BITS), return_index=True)
        return list(zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(keys)], strict=True))

    def told(self, level: int, answers: dict) -> tuple[np.ndarray, ...]:
        """Of a level's candidates: (positions, numbers of their keys, whether each repeats, whether it starts in a document before the
        batch's first with it)."""
        at = np.flatnonzero(np.unpackbits(np.frombuffer(answers[-1][0], np.uint8), count=len(self.word)))
        keys, index = self.keys(level, at)
        out = (np.zeros(len(keys), bool), np.zeros(len(keys), bool))
        for r, a, b in self.cuts(level, keys):
            for bits, packed in zip(out, answers[r], strict=True):
                bits[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a) if packed else 0
        return at, index, out[0][index], out[1][index]


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    release()
    schema = schema_of(ddl)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else schema.empty_table()


def _sent(batch: Batch, number: int, level: int, at: np.ndarray) -> pa.Table:
    """What a batch tells the ranges about its windows at the positions ``at``, and its note of these."""
    if not len(at):
        return _table([], _SENT)
    keys, index = batch.keys(level, at)
    firsts, lasts = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(firsts, index, batch.doc[at])
    np.maximum.at(lasts, index, batch.doc[at])
    last = level == len(batch.plan) - 1
    rows = []
    for r, a, b in batch.cuts(level, keys):
        packed = keys[a:b].tobytes() if last else gaps(keys[a:b] & np.uint64((1 << CODE_BITS) - 1))
        rows.append((r, number, packed, firsts[a:b].tobytes() if last else b"", np.packbits(firsts[a:b] != lasts[a:b]).tobytes()))
    noted = np.zeros(len(batch.word), bool)
    noted[at] = True
    return _table([*rows, (-1 - number, number, np.packbits(noted).tobytes(), b"", b"")], _SENT)


def _answer(rows: pa.Table, last: bool) -> pa.Table:
    """Of one hash range: what each batch's hashes are told. A batch's note goes back as it is."""
    if rows.column("hash_range")[0].as_py() < 0:
        return _table([(b, -1, packed, b"") for b, packed in zip(rows.column("batch").to_pylist(), rows.column("hashes").to_pylist(), strict=True)], _ANSWER)
    hashes = [np.frombuffer(x, np.uint64).reshape(-1, 2) if last else codes_of(x) for x in rows.column("hashes").to_pylist()]
    sizes = [len(x) for x in hashes]
    flat = np.concatenate(hashes)
    order, new, group = grouped(*(np.ascontiguousarray(h) for h in (flat.T if last else [flat])))
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows.column("many").to_pylist(), sizes, strict=True)]).astype(bool)
    starts = np.flatnonzero(new)
    repeats = ((np.diff([*starts, len(order)]) > 1) | np.logical_or.reduceat(many[order], starts))[group]
    if last:
        firsts = np.concatenate([np.frombuffer(x, np.int64) for x in rows.column("firsts").to_pylist()])
        earlier = np.minimum.reduceat(firsts[order], starts)[group] < firsts
    at = np.cumsum([0, *sizes])
    pack = lambda bits, k: np.packbits(bits[at[k] : at[k + 1]]).tobytes()
    return _table([(b, r, pack(repeats, k), pack(earlier, k) if last else b"") for k, (b, r) in enumerate(zip(rows.column("batch").to_pylist(), rows.column("hash_range").to_pylist(), strict=True))], _ANSWER)


def _answers(rows: pa.Table) -> dict[int, tuple]:
    """{range: (repeats, earlier)} of one batch; empty if none of its candidates repeats."""
    out = {r: both for r, *both in zip(*(rows.column(c).to_pylist() for c in ("hash_range", "repeats", "earlier")), strict=True)}
    return out if any(both[0].strip(b"\0") for r, both in out.items() if r >= 0) else {}


def remove_repeats(docs: DataFrame, window: int = 13, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, the columns to ``carry`` and, if asked for, the text that is left.

    ``window``: words in the shortest repeat that goes. Kept words are joined by one space; a text that
    loses nothing stays as it was.
    """
    plan = lengths(window)
    last = len(plan) - 1
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    batches, ranges = max(1, -(-size // BATCH_CHARS)), max(1, -(-size // RANGE_CHARS))
    # The partition's number spreads rows that are equal in all.
    dealt = docs.select("doc_id", "text", *(F.col(c).alias(f"_{c}") for c in carry), F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(batches)).alias("batch"))

    def first(t: pa.Table) -> pa.Table:
        batch = Batch(t, plan, ranges)
        batch.hash_words()
        return _sent(batch, t.column("batch")[0].as_py(), 0, batch.starts(plan[0]))

    def extending(level: int):
        def extend(t: pa.Table, told: pa.Table) -> pa.Table:
            answers = _answers(told)
            if not answers or not t.num_rows:
                return _table([], _SENT)
            batch = Batch(t, plan, ranges)
            batch.hash_words()
            at, _, repeats, _ = batch.told(level - 1, answers)
            alive = np.zeros(len(batch.word) + 1, bool)
            alive[at[repeats]] = True
            begins = batch.starts(plan[level])
            return _sent(batch, t.column("batch")[0].as_py(), level, begins[alive[begins] & alive[begins + plan[level] - plan[level - 1]]])

        return extend

    def answering(level: int):
        return lambda t: _answer(t, level == last)

    answers = None
    for level in range(len(plan)):
        sent = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(extending(level), _SENT) if level else dealt.groupBy("batch").applyInArrow(first, _SENT)
        answers = sent.groupBy("hash_range").applyInArrow(answering(level), _ANSWER)

    kinds = dict(docs.dtypes)
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", text string" * keep_text + "".join(f", _{c} {kinds[c]}" for c in carry)

    def cut(t: pa.Table, told: pa.Table) -> pa.Table:
        schema = schema_of(ddl)
        if not t.num_rows:
            return schema.empty_table()
        batch, answers = Batch(t, plan, ranges), _answers(told)
        covered = None
        if answers:
            batch.hash_words()
            at, index, _, earlier = batch.told(last, answers)
            # A repeat inside the batch: the window also starts in a document of the batch with a smaller id.
            least = np.full(len(at), np.iinfo(np.int64).max)
            np.minimum.at(least, index, batch.doc[at])
            gone = at[earlier | (batch.doc[at] > least[index])]
            edge = np.zeros(len(batch.word) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + window, -1)
            covered = np.cumsum(edge)[:-1] > 0
        release()
        out, start = [], 0
        for doc, text in batch.rows:
            words = utf8(text).split()
            mask = np.zeros(0, bool) if covered is None else covered[start : start + len(words)]
            removed, start = int(mask.sum()), start + len(words)
            kept = b" ".join([w for w, x in zip(words, mask.tolist(), strict=True) if not x] if removed else words)
            out.append((doc, len(words), removed, hashlib.sha256(kept).hexdigest(), *([text if not removed else kept.decode("utf-8", "replace")] * keep_text)))
        for doc, text in batch.whole:
            words = utf8(text).split()
            out.append((doc, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), *([text] * keep_text)))
        rest = [t.column(f"_{c}").take(pa.array(batch.order)).combine_chunks() for c in carry]
        made = [pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=False)]
        return pa.Table.from_arrays([*made, *rest], schema=schema)

    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(cut, ddl)
    return found.withColumnsRenamed({f"_{c}": c for c in carry})
