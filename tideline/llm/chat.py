"""Chat formatting by columnar byte assembly.

Rows come sorted by conversation and turn. For a batch the lengths of all segments (header, content, footer)
are known as arrays, their cumulative sums are where each segment starts, and contents are copied from the
column's own buffer into one preallocated buffer by scatter indexes. That buffer is the formatted column.

The template of a turn is ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside a role or text, every ``<``, backslashes,
``|`` gets one more backslash, so a control string never occurs in a text and the escape can be undone. A line
break in a role becomes ``<|nl|>``. The loss mask covers the text of turns whose role is ``assistant``, as byte spans.

Results of edge cases. Null roles and texts are empty. Rows without a conv_id form one conversation of null id. Rows of equal turn
are ordered by role and text, and repeated rows are turns of their own. An empty table gives an empty result. Texts of any length are
kept whole. Columns besides conv_id, turn, role and text are ignored, whatever their names. A conversation that is longer than ``part_bytes`` is returned in several parts, in
order and within one partition, so that memory does not grow with it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import map_batches

START, END, BREAK = b"<|im_start|>", b"<|im_end|>\n", "<|nl|>"
FORMATTED = "conv_id bigint, part int, last boolean, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\\\1|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 offsets into them."""
    column = pc.cast(column, pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies segment i, data[offsets[i]:offsets[i + 1]], to out[to[i]:]."""
    sizes = np.diff(offsets)
    out[np.arange(sizes.sum()) + np.repeat(to - np.cumsum(sizes) + sizes, sizes)] = data[offsets[0] : offsets[-1]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start of each row's turn and the end, start of each text, end of each text)."""
    head = pc.binary_join_element_wise(START.decode(), pc.replace_substring(escape(roles), "\n", BREAK), "\n", "")
    parts = [_bytes_of(head), _bytes_of(escape(texts))]
    heads, bodies = (np.diff(o) for _, o in parts)
    turns = np.append(0, np.cumsum(heads + bodies + len(END)))
    begin = turns[:-1] + heads
    out = np.empty(int(turns[-1]), np.uint8)
    _scatter(out, turns[:-1], *parts[0])
    _scatter(out, begin, *parts[1])
    out[(begin + bodies)[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, turns, begin, begin + bodies


def format_chats(conversations: DataFrame, part_bytes: int = 4_000_000) -> DataFrame:
    """One row for each conversation (or part of a very long one) with its formatted text and loss spans in bytes."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, part = None, 0

        def finish(table: pa.Table, first_part: int, open_end: bool) -> list:
            ids = table.column("conv_id").combine_chunks()
            assistant = pc.equal(table.column("role"), "assistant").to_numpy(zero_copy_only=False)
            data, turns, begin, end = assemble(table.column("role").combine_chunks(), table.column("text").combine_chunks())
            keys = ids.to_numpy(zero_copy_only=False)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            keys = np.where(null, 0, keys).astype(np.int64)
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
            at = np.flatnonzero(new)
            offsets = np.append(turns[at], turns[-1])
            formatted = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)]).cast(pa.string())
            conv = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(keys))))
            counts = np.append(0, np.cumsum(np.bincount(conv[assistant], minlength=len(at))))
            shift = offsets[conv[assistant]]
            spans = [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(v[assistant] - shift)) for v in (begin, end)]
            parts = np.zeros(len(at), np.int32)
            parts[0] = first_part
            lasts = np.ones(len(at), bool)
            lasts[-1] = not open_end
            return [ids.take(pa.array(at)), pa.array(parts), pa.array(lasts), formatted, *spans]

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            ids = held.column("conv_id")
            tail = ids[-1]
            same = pc.is_null(ids) if not tail.is_valid else pc.fill_null(pc.equal(ids, tail), False)
            cut = pc.index(same, True).as_py()
            if cut:
                yield finish(held.slice(0, cut), part, False)
                held, part = held.slice(cut), 0
            if held.nbytes > part_bytes and held.num_rows > 1:
                yield finish(held.slice(0, held.num_rows - 1), part, True)
                held, part = held.slice(held.num_rows - 1), part + 1
        if held is not None and held.num_rows:
            yield finish(held, part, False)

    return map_batches(rows, build, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Works along the partitions that ``format_chats`` returns, where the parts of a conversation follow each other.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        state = None
        for b in batches:
            out = []
            for conv, last, text, starts, ends in zip(*(b.column(c).to_pylist() for c in ("conv_id", "last", "formatted", "loss_starts", "loss_ends")), strict=True):
                turns, turn_hash, chars, loss_hash, total = state or (0, hashlib.sha256(), 0, hashlib.sha256(), 0)
                for m in _TURN.finditer(text):
                    turns += 1
                    role = unescape(m[1].replace(BREAK, "\n"))
                    turn_hash.update(f"{role}\n{unescape(m[2])}\n".encode())
                data = text.encode()
                for a, z in zip(starts, ends, strict=True):
                    said = unescape(data[a:z].decode())
                    chars += len(said)
                    loss_hash.update(said.encode())
                state = (turns, turn_hash, chars, loss_hash, total + len(text))
                if last:
                    out.append((conv, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), state[4]))
                    state = None
            yield [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(6)]

    return map_batches(formatted, digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
