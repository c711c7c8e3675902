"""Chat formatting at the level of tokens.

Every segment of a conversation (a header, a text) is encoded by itself, and the
ids that mark a turn are spliced in between; they lie beyond the vocabulary, so
that no text can yield them. Control strings in texts are escaped besides,
reversibly, for readers of the formatted string. The loss mask is the prefix sum
of +1 where an assistant's text begins and -1 where it ends.

A turn reads ``<|im_start|>role LF text<|im_end|> LF``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, texts_of

START, STOP = "<|im_start|>", "<|im_end|>"
#: Turns of a conversation go to further rows once a row has so many ids.
CHUNK = 1 << 22
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_LINE = re.compile(r"\\(.)")


def escaped(text: str) -> str:
    """A backslash more in every ``<|``, ``<\\|``, ``<\\\\|``, ...: no ``<|`` is left, and ``unescaped`` gives the text again."""
    return _ESCAPE.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def one_line(role: str) -> str:
    """A role without line feeds, reversibly: ``\\n`` for each, and ``\\\\`` for a backslash."""
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def as_said(role: str) -> str:
    """The inverse of ``one_line``."""
    return _LINE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


class Codec:
    """Turns to ids and back; ``size`` is the vocabulary's, the ids from there on mark turns."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.start, self.stop = self.size, self.size + 1
        self.feed = self.ids(["\n"])[0]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def text(self, ids) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def turn(self, role: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, int, int]:
        """The ids of a turn, and where its text begins and ends among them."""
        head = [[self.start], role, self.feed]
        begin = sum(map(len, head))
        return np.concatenate([*head, text, [self.stop], self.feed]).astype(np.int32), begin, begin + len(text)

    def mask(self, size: int, begins: list[int], ends: list[int]) -> np.ndarray:
        edges = np.zeros(size + 1, dtype=np.int8)
        np.add.at(edges, begins, 1)
        np.add.at(edges, ends, -1)
        return np.cumsum(edges[:-1]).astype(bool)

    def turns(self, ids: np.ndarray, mask: np.ndarray) -> list[tuple[str, str, str]]:
        """``(role, text, text under the mask)`` of each turn, unescaped."""
        out = []
        at = np.nonzero(ids == self.start)[0]
        for a, b in zip(at, [*at[1:], len(ids)], strict=True):
            body = ids[a + 1 : b]
            stop = int(np.nonzero(body == self.stop)[0][0])
            inner, on = body[:stop], mask[a + 1 : b][:stop]
            role, _, text = self.text(inner.tolist()).partition("\n")
            loss = self.text(inner[on].tolist()) if on.any() else ""
            out.append((as_said(unescaped(role)), unescaped(text), unescaped(loss)))
        return out

    def rendered(self, ids: np.ndarray) -> str:
        """The formatted string."""
        marks = {self.start: START, self.stop: STOP}
        out, at = [], 0
        for k in np.nonzero(ids >= self.size)[0]:
            out += [self.text(ids[at:k].tolist()), marks[int(ids[k])]]
            at = k + 1
        return "".join([*out, self.text(ids[at:].tolist())])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


_FORMATTED = "conv_id long, chunk int, n_turns int, ids array<int>, loss array<boolean>"


def formatted(conversations: DataFrame, path: str) -> DataFrame:
    """``(conv_id, chunk, n_turns, ids, loss)`` of every conversation of ``conversations(conv_id, turn, role, text, ...)``.

    Turns go by ``turn``, equal ones by role and text, a null first. A null text
    or role is empty; a line feed in a role is escaped. Repeated rows are turns
    as often. Rows without conv_id are one conversation. Other columns are
    ignored, whatever their names. Long conversations take several rows, in
    order: chunk 0 and up; a long text is one turn. An empty table gives an
    empty result.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        c, known = codec(path), {}
        now, chunk, parts, begins, ends, held = None, 0, [], [], [], 0

        def row():
            ids = np.concatenate(parts)
            return pa.record_batch(
                [pa.array([now[0]], pa.int64()), pa.array([chunk], pa.int32()), pa.array([len(parts)], pa.int32()), pa.array([ids], pa.list_(pa.int32())), pa.array([c.mask(held, begins, ends)], pa.list_(pa.bool_()))],
                ["conv_id", "chunk", "n_turns", "ids", "loss"],
            )

        for batch in batches:
            for piece in slices(batch, "text"):
                keys, roles = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                new = list(set(roles) - known.keys())
                known.update(zip(new, c.ids([escaped(one_line(r)) for r in new]), strict=True))
                for key, role, text in zip(keys, roles, c.ids([escaped(t) for t in texts_of(piece.column(2))]), strict=True):
                    if now is not None and (now[0] != key or held >= CHUNK):
                        yield row()
                        chunk = chunk + 1 if now[0] == key else 0
                        parts, begins, ends, held = [], [], [], 0
                    now = (key,)
                    turn, begin, end = c.turn(known[role], text)
                    if role == "assistant":
                        begins.append(held + begin)
                        ends.append(held + end)
                    parts.append(turn)
                    held += len(turn)
        if parts:
            yield row()

    return rows.mapInArrow(run, _FORMATTED)


def digests(table: DataFrame, path: str) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, read back from the ids and masks of ``formatted``.

    A conversation's digest runs over its turns one after the other, so its
    chunks, in order, meet in one task, which holds one of them at a time.
    Conversations without an assistant's turn have no loss: zero, and the hash of
    an empty string. The one without conv_id has a row too. An empty table gives an empty result.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        c, now, state = codec(path), None, None
        out = []
        for batch in batches:
            for key, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if now is None or now[0] != key:
                    if now is not None:
                        out.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    now, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, loss = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False)
                for role, text, under in c.turns(ids, loss):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(under)
                    state[3].update(under.encode())
                state[4] += len(c.rendered(ids))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_DIGESTS)
                out = []
        if now is not None:
            out.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_DIGESTS)

    ordered = table.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select("conv_id", "ids", "loss")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
