"""Repair of conversations by a Viterbi search whose survivors are merged as soon as they agree.

A conversation is right if the initials of its roles match ``(s?(ua)+)?``. Edits: Keep (0), Rerole to user or assistant (1), Delete (2),
Insert an empty turn of user or assistant anywhere (5). Blank and repeated turns must be deleted; a truncated turn that is not costs
5 more. Of the cheapest edits those are taken whose initials, read in order, are the least.

The search reads the turns in order and knows four states: nothing yet, after a system turn, after a user's, after an assistant's. Of
each state one way survives. Survivors are leaves of a tree of backpointers that counts the references to its nodes: a node without
any is let go, and while the root has a single child the edits of that child are certain, are emitted and become the root.

Ways of equal cost are compared by all that is not yet emitted. No survivor's edits are the beginning of another's, as all have passed
the same turns and end with one, so an order of survivors decides between ways that go through different ones, and letters added since
between those through the same one: the order is renewed at every turn, and whole suffixes are compared without walking them.

A survivor is dropped when another could do all that it may still do for strictly less (``_MORE``). Without this the way that
deletes everything would survive, and with it the root. What stays is bounded by how long two ways are equally good, not by the
conversation. Texts take no part in the search: edits are joined to them afterwards.

Results of edge cases. Null roles and texts are one space, so such texts are blank, and such a role is no legal one. Rows without a
conv_id form one conversation of null id. Rows are taken by turn (nulls first), rows of equal turn by role, then text; repeated rows are
turns of their own, and duplicates. A conversation that has no rows left, and one whose turns are all deleted, is legal and empty. An
empty table gives an empty result. Texts of any length are read whole. Columns besides conv_id, turn, role and text are ignored,
whatever their names. A conversation's turns pass one task, as a stream; nothing of it is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import map_batches
from .tables import written

#: States after nothing, system, user and assistant; the state that each initial leads to from each.
_START, _S, _U, _A = range(4)
_NEXT = ({"s": _S, "u": _U}, {"u": _U}, {"a": _A}, {"u": _U})
#: Initial and state of the turn that may be made up in each state.
_MADE = (("u", _U), ("u", _U), ("a", _A), ("u", _U))
_ROLES = {"u": "user", "a": "assistant"}
#: (x, y, c): whatever follows x may follow y for c more. An insert leads from the user's state to the assistant's and back; a system
#: turn that only the start can keep is deleted instead; after a system turn the end is reached by two inserts.
_MORE = ((_START, _A, 2), (_START, _U, 7), (_S, _A, 0), (_S, _U, 5), (_S, _START, 0), (_U, _A, 5), (_U, _START, 5), (_U, _S, 5), (_A, _U, 5), (_A, _START, 0), (_A, _S, 10))

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
EDITS = "conv_id bigint, place bigint, seq int, edit string, role string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """Test cases: by a checksum of conversation and turn a row is dropped, emptied, robbed of its stops, repeated or made a user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text) with places from 0 in each conversation."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    kept = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    return kept.withColumn("place", (F.row_number().over(order) - 1).cast("bigint"))


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn, initial, fault): each turn's first fault. Only checksums of texts are compared; the first place of
    each text is found by an aggregate, so a text that a conversation often repeats is summed up before it is shuffled."""
    # What follows the last character that is not white space is white space, so the text ends as the pattern says.
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    key = F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    seen = turns.select("conv_id", "place", "turn", F.substring("role", 1, 1).alias("initial"), last.alias("last"), F.when(last != "", key).alias("key"))
    twice = seen.where("key is not null").groupBy("conv_id", "key").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("conv_id", "key", "first")
    joined = seen.alias("t").join(twice.alias("d"), F.col("t.conv_id").eqNullSafe(F.col("d.conv_id")) & (F.col("t.key") == F.col("d.key")), "left")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return joined.select("t.conv_id", "place", "turn", "initial", fault.alias("fault"))


class Tree:
    """Backpointers with counts of references. ``kids`` holds the children's numbers, xored: an only child's is its parent's ``kids``."""

    def __init__(self):
        #: Node 0 is none, node 1 the first root.
        self.parent, self.count, self.kids, self.what, self.free = [0, 0], [0, 1], [0, 0], [None, None], []
        self.root = 1

    def add(self, parent: int, what: tuple) -> int:
        if self.free:
            node = self.free.pop()
            self.parent[node], self.count[node], self.kids[node], self.what[node] = parent, 1, 0, what
        else:
            node = len(self.parent)
            self.parent.append(parent), self.count.append(1), self.kids.append(0), self.what.append(what)
        self.count[parent] += 1
        self.kids[parent] ^= node
        return node

    def let_go(self, node: int) -> None:
        """One reference less; nodes without any are freed up to an ancestor that has others."""
        self.count[node] -= 1
        while not self.count[node] and node != self.root:
            up = self.parent[node]
            self.free.append(node)
            self.what[node] = None
            self.count[up] -= 1
            self.kids[up] ^= node
            node = up

    def certain(self) -> Iterator[tuple]:
        """What all survivors share, from the root on; the last node of it becomes the root."""
        while self.count[self.root] == 1 and self.kids[self.root]:
            old, self.root = self.root, self.kids[self.root]
            self.free.append(old)
            yield self.what[self.root]


class Search:
    """The search over one conversation: ``turn`` for each row and ``end`` return the edits that are certain, in order, as
    (place, letters, state after)."""

    def __init__(self):
        self.tree = Tree()
        #: Of each state: (cost, place in the order of ways, node).
        self.ways: dict[int, tuple[int, int, int]] = {_START: (0, 0, 1)}

    def _with_inserts(self) -> dict[int, tuple[int, int, str, int]]:
        """The best ways to each state when turns may be made up first: (cost, order, letters, node)."""
        best = {state: (cost, order, "", node) for state, (cost, order, node) in self.ways.items()}
        for states in ((_START, _S, _A), (_U,)):
            for state in states:
                if state in best:
                    cost, order, letters, node = best[state]
                    made = _MADE[state][1]
                    way = (cost + 5, order, letters + "I", node)
                    if made not in best or way[:3] < best[made][:3]:
                        best[made] = way
        return best

    def turn(self, place: int, initial: str, fault: int) -> Iterator[tuple]:
        best: dict[int, tuple] = {}

        def offer(state: int, cost: int, order: int, letters: str, node: int) -> None:
            if state not in best or (cost, order, letters) < best[state][:3]:
                best[state] = (cost, order, letters, node)

        for state, (cost, order, letters, node) in self._with_inserts().items():
            offer(state, cost + 2, order, letters + "D", node)
            if fault not in (BLANK, DUPLICATE):
                more = 5 if fault == TRUNCATED else 0
                if initial in _NEXT[state]:
                    offer(_NEXT[state][initial], cost + more, order, letters + "K", node)
                offer(_MADE[state][1], cost + 1 + more, order, letters + "R", node)
        for x, y, more in _MORE:
            if x in best and y in best and best[y][0] + more < best[x][0]:
                del best[x]
        order = sorted(best, key=lambda s: best[s][1:3])
        before = [node for _, _, node in self.ways.values()]
        self.ways = {s: (best[s][0], k, self.tree.add(best[s][3], (place, best[s][2], s))) for k, s in enumerate(order)}
        for node in before:
            self.tree.let_go(node)
        return self.tree.certain()

    def end(self, place: int) -> tuple[int, list[tuple]]:
        """(cost, the edits that were still open)."""
        cost, _, letters, node, state = min((*way, state) for state, way in self._with_inserts().items() if state in (_START, _A))
        rest = [(place, letters, state)] if letters else []
        while node != self.tree.root:
            rest.append(self.tree.what[node])
            node = self.tree.parent[node]
        return cost, rest[::-1]


def _edits(state: int, place: int, letters: str, after: int) -> tuple[int, list[tuple]]:
    """The state after, and (place, seq, edit, new role) of each letter."""
    out = []
    for seq, letter in enumerate(letters):
        role = None
        if letter in "IR":
            initial, state = _MADE[state]
            role = _ROLES[initial]
        out.append((place, seq, letter, role))
    return after, out


def search(turns: DataFrame) -> DataFrame:
    """The edits (conv_id, place, seq, edit, role) of ``faults`` rows, in order, and a last row for each conversation with its counts,
    cost and audit. An inserted turn has the place of the one that it precedes."""
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        now, out = None, []
        for b in batches:
            for conv, place, turn, initial, fault in zip(*(b.column(c).to_pylist() for c in ("conv_id", "place", "turn", "initial", "fault")), strict=True):
                if now is not None and now.conv != conv:
                    out += now.close()
                    now = None
                if now is None:
                    now = _Conversation(conv)
                out += now.turn(place, turn, initial, fault)
            if len(out) >= 1000:
                yield [list(c) for c in zip(*out, strict=True)]
                out = []
        if now is not None:
            out += now.close()
        if out:
            yield [list(c) for c in zip(*out, strict=True)]

    return map_batches(rows.select("conv_id", "place", "turn", "initial", "fault"), work, EDITS)


class _Conversation:
    """One conversation as it streams by: its search and its counts."""

    def __init__(self, conv: int | None):
        self.conv, self.search, self.state, self.audit, self.place = conv, Search(), _START, [], -1
        self.counts, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = 0

    def _rows(self, certain) -> Iterator[tuple]:
        for place, letters, after in certain:
            self.state, edits = _edits(self.state, place, letters, after)
            self.audit.append(letters)
            for e in edits:
                yield (self.conv, *e, *[None] * 7)

    def turn(self, place: int, turn: int | None, initial: str, fault: int) -> list[tuple]:
        self.counts[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before, self.place = initial, place
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        return list(self._rows(self.search.turn(place, initial, fault)))

    def close(self) -> list[tuple]:
        cost, rest = self.search.end(self.place + 1)
        rows = list(self._rows(rest))
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [*rows, (self.conv, None, None, None, None, gaps, *self.counts[1:], self.illegal, cost, "".join(self.audit))]


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repaired turns, a report): conv_id, place, seq, edit, role, text of what stays, is reroled or made up, and per conversation gaps,
    blank, duplicate, truncated, illegal, cost, audit."""
    turns = written(placed(rows), "turns")
    edits = written(search(faults(turns)), "edits")
    wanted = edits.where("edit is not null and edit <> 'D'").select("conv_id", "place", "seq", "edit", F.col("role").alias("new_role"))
    at = F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("e.place") == F.col("t.place")) & (F.col("e.edit") != "I")
    both = wanted.alias("e").join(turns.alias("t"), at, "left")
    repaired = both.select("e.conv_id", "e.place", "seq", "edit", F.coalesce("new_role", "t.role").alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))
    return repaired, edits.where("edit is null").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def checksums(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of each conversation's ``role:text`` lines, as a stream along sorted partitions."""
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "place", "seq").select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        conv, digest = None, None
        for b in batches:
            done = []
            for c, line in zip(b.column("conv_id").to_pylist(), b.column("line").to_pylist(), strict=True):
                if digest is not None and c == conv:
                    digest.update(b"\n" + line.encode())
                    continue
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256(line.encode())
            yield [[d[k] for d in done] for k in range(2)]
        if digest is not None:
            yield [[conv], [digest.hexdigest()]]

    return map_batches(rows, work, "conv_id bigint, repaired_sha256 string")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation of ``conversations``: what ``rows``, its turns now, lack, the cheapest repair and the repaired text's checksum."""
    repaired, found = repair(rows)
    same: Column = F.col("c.conv_id").eqNullSafe(F.col("r.conv_id"))
    out = conversations.select("conv_id").distinct().alias("c").join(found.alias("r"), same, "left")
    counts = [F.coalesce(f"r.{c}", F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = out.select("c.conv_id", *counts, F.coalesce("r.audit", F.lit("")).alias("audit")).alias("o")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.join(checksums(repaired).alias("s"), F.col("o.conv_id").eqNullSafe(F.col("s.conv_id")), "left").select("o.*", F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
