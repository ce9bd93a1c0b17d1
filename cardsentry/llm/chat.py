"""Chat formatting on token level (operator 9).

Every turn becomes ``START role "\\n" text END "\\n"``.  START and END are reserved
ids; role line and text are encoded apart, so no text can make a reserved id, and
no merge reaches over a border.  In the formatted string the reserved ids read
``<|im_start|>`` and ``<|im_end|>``; to keep that string unambiguous as well, each
run ``<``, backslashes, ``|`` in a role or text gets one more backslash, which
reading back takes away.

The output is a table of turns ``(conv_id, seq, start, ids, mask)``: seq counts
the turns of a conversation, start the tokens before it.  The loss mask is 1 on
the tokens of assistant texts; it is the running sum of +1 and -1 set at the
borders of those segments.  Conversations are read in order as a stream, never
held as a whole, so one of any length passes in bounded memory.

Defined cases: null text or role is empty; turns go by turn number (null first),
then role and text; repeated rows are turns of their own; conversations with a
null id are one conversation.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Encoder, Ranks
from .chunks import ChunkTable
from .shared import ship
from .words import slices

START_TEXT, END_TEXT = "<|im_start|>", "<|im_end|>"
START, END = 50257, 50258
LOSS_ROLE = "assistant"

_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line, so its line ends are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *keys)


def assemble(lengths: np.ndarray, ids: np.ndarray, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splice reserved ids around encoded segments.

    ``lengths`` holds the role-line, text and end-line sizes of each turn, ``ids``
    all of them in a row, ``scored`` the turns under the loss.  Returns the turns'
    tokens in a row, the mask, and the turns' offsets.
    """
    n = len(lengths)
    size = lengths.sum(axis=1) + 2
    first = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    text = first[:-1] + 1 + lengths[:, 0]
    end = text + lengths[:, 1]
    out = np.full(int(first[-1]), -1, dtype=np.int32)
    out[first[:-1]] = START
    out[end] = END
    out[out < 0] = ids
    step = np.zeros(len(out) + 1, dtype=np.int32)
    np.add.at(step, text[scored], 1)
    np.add.at(step, end[scored], -1)
    return out, np.cumsum(step[:-1]).astype(np.int8) if n else np.zeros(0, np.int8), first


TURNS = "conv_id long, seq long, start long, ids array<int>, mask array<tinyint>"


def format_chats(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Formatted turns of ``rows(conv_id, turn, role, text)``."""
    ship(rows.sparkSession)
    held = rows.sparkSession.sparkContext.broadcast(Ranks(ranks_path))

    def run(batches):
        table = ChunkTable(Encoder(held.value, pattern))
        conv, seq, start, begun = None, 0, 0, False
        for batch in slices(batches, "text"):
            roles = [r or "" for r in batch.column("role").to_pylist()]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            parts = [s for r, t in zip(roles, texts) for s in (escape_role(r) + "\n", escape(t), "\n")]
            numbers = table.look_up(parts)
            table.settle()
            ids, at = table.gather(numbers)
            tokens, mask, first = assemble(np.diff(at).reshape(-1, 3), ids, np.array([r == LOSS_ROLE for r in roles], dtype=bool))
            convs = batch.column("conv_id").to_pylist()
            seqs, starts = [], []
            for d, c in enumerate(convs):
                if not begun or c != conv:
                    conv, seq, start, begun = c, 0, 0, True
                seqs.append(seq)
                starts.append(start)
                seq, start = seq + 1, start + int(first[d + 1] - first[d])
            offsets = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs, pa.int64()), pa.array(seqs, pa.int64()), pa.array(starts, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(tokens)), pa.ListArray.from_arrays(offsets, pa.array(mask))],
                names=["conv_id", "seq", "start", "ids", "mask"],
            )
            table.forget()

    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    typed = rows.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])
    return _in_order(typed, "turn", "role", "text").mapInArrow(run, TURNS)


class Reader:
    """Turns ids back into strings."""

    def __init__(self, ranks: Ranks):
        self.token = {i: t for i, t in enumerate(ranks.token)}
        self.token[START], self.token[END] = START_TEXT.encode(), END_TEXT.encode()

    def text(self, ids) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode()

    def turn(self, ids: list[int]) -> tuple[str, str]:
        """Role and text of a turn's tokens."""
        if ids[0] != START:
            raise ValueError("a turn begins with the start id")
        line, _, text = self.text(ids[1 : ids.index(END)]).partition("\n")
        return unescape_role(line), unescape(text)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame, ranks_path: str) -> DataFrame:
    """One row per conversation, from the formatted turns alone: counts and digests of what they say."""
    ship(turns.sparkSession)
    held = turns.sparkSession.sparkContext.broadcast(Ranks(ranks_path))

    def run(batches):
        reader = Reader(held.value)
        conv, begun = None, False
        for batch in batches:
            done = []
            ids, masks = batch.column("ids").to_pylist(), batch.column("mask").to_pylist()
            for c, tokens, mask in zip(batch.column("conv_id").to_pylist(), ids, masks):
                if not begun or c != conv:
                    if begun:
                        done.append((conv, n, said.hexdigest(), chars, loss.hexdigest(), total))
                    conv, begun = c, True
                    n, chars, total, said, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, text = reader.turn(tokens)
                said.update(f"{role}\n{text}\n".encode())
                scored = unescape(reader.text([t for t, m in zip(tokens, mask) if m]))
                loss.update(scored.encode())
                n, chars, total = n + 1, chars + len(scored), total + len(reader.text(tokens))
            if done:
                yield _rows(done)
        if begun:
            yield _rows([(conv, n, said.hexdigest(), chars, loss.hexdigest(), total)])

    return _in_order(turns.select("conv_id", "seq", "ids", "mask"), "seq").mapInArrow(run, DIGEST)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [c.split()[0] for c in DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
