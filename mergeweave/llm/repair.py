"""Repair of the structure of conversations by the cheapest edits.

Turns of a conversation go by ``turn``. A turn can be kept (K), be given another
role (R) or be deleted (D), and empty turns can be inserted (I), until the roles
read ``s?(ua)+`` or nothing is left. The state between turns is one of four:
nothing yet, after a system turn, after a user's, after an assistant's. A tensor
of costs (turn, conversation, state) is filled from the last turn to the first
for all conversations of about a length at once, in numpy; edits are then
traced from the first turn on, again for all conversations at once.

Rows are range-partitioned by conversation and place and cut into segments, so a
conversation of any length spreads over tasks. A segment that is a conversation
gets its result at once. Others first yield the cheapest way from each state to
each state; chained for each conversation, these 16 numbers a segment give the
costs at a segment's end and the state at its start, and each is then traced by itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import stored

RETYPE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: A segment is cut once it has so many different turns or so many bytes of text (a longer text makes a longer one).
ROWS, BYTES = 1 << 16, 8_000_000
#: So many cells (turns x conversations) are in work at once at most, unless one segment alone has more.
CELLS = 1 << 20
_SPACE = " \t\n\x0b\x0c\r"
_FAR = 1 << 60
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Codes of roles: 0 other, 1 s, 2 u, 3 a.
_NEXT = np.array([2, 2, 3, 2])
_KEEP = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
#: What is yet to be paid where a conversation ends in a state.
_END = np.array([0, 2 * INSERT, INSERT, 0])
_I, _D, _K, _R = (ord(c) for c in "IDKR")


def costs(code: np.ndarray, forced: np.ndarray, cut: np.ndarray, copies: np.ndarray, valid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(turns + 1, conversations, 4): what the rest costs from each state before each turn, inserts there included.

    The first five are (turns, conversations): role codes, turns that must go, truncated ones,
    how often a turn stands there (all but one must go), and whether there is one.
    """
    n_turns, n = code.shape
    out = np.empty((n_turns + 1, n, 4), dtype=np.int64)
    out[n_turns] = end
    rows = np.arange(n)[:, None]
    for t in range(n_turns - 1, -1, -1):
        after = out[t + 1]
        delete = DELETE * copies[t][:, None] + after
        stay = (DELETE * (copies[t] - 1) + CUT * cut[t])[:, None]
        to = _KEEP[:, code[t]].T
        keep = np.where((to >= 0) & ~forced[t][:, None], stay + after[rows, np.maximum(to, 0)], _FAR)
        retype = np.where(forced[t][:, None], _FAR, RETYPE + stay + after[:, _NEXT])
        best = np.minimum(np.minimum(delete, keep), retype)
        best = np.minimum(best, np.minimum(INSERT + best[:, _NEXT], 2 * INSERT + best[:, _NEXT[_NEXT]]))
        out[t] = np.where(valid[t][:, None], best, after)
    return out


def traced(cost: np.ndarray, code: np.ndarray, forced: np.ndarray, cut: np.ndarray, copies: np.ndarray, valid: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cheapest edits from a state on, of equal ones those whose letters come first: letters and states (conversations, turns + 1, 3), and the state at the end.

    Two inserts at most before a turn, or at the end if it is the ``last`` segment, then what becomes of the turn; 0 for none.
    """
    n_turns, n = code.shape
    letters, states = np.zeros((n, n_turns + 1, 3), dtype=np.uint8), np.zeros((n, n_turns + 1, 3), dtype=np.int8)
    every, q = np.arange(n), state.copy()
    for t in range(n_turns + 1):
        more = t < n_turns
        here = valid[t] if more else last
        for k in range(2):
            now = cost[t][every, q]
            insert = here & (INSERT + cost[t][every, _NEXT[q]] == now)
            if more:
                insert &= DELETE * copies[t] + cost[t + 1][every, q] != now
            q = np.where(insert, _NEXT[q], q)
            letters[:, t, k], states[:, t, k] = np.where(insert, _I, 0), q
        if more:
            now, to = cost[t][every, q], _KEEP[q, code[t]]
            delete = DELETE * copies[t] + cost[t + 1][every, q] == now
            stay = DELETE * (copies[t] - 1) + CUT * cut[t]
            keep = ~delete & (to >= 0) & ~forced[t] & (stay + cost[t + 1][every, np.maximum(to, 0)] == now)
            q = np.where(here & ~delete, np.where(keep, to, _NEXT[q]), q)
            letters[:, t, 2], states[:, t, 2] = np.where(here, np.where(delete, _D, np.where(keep, _K, _R)), 0), q
    return letters, states, q


def _turns(conversations: DataFrame) -> DataFrame:
    """Different turns of each conversation with ``copies``, ``blank``, ``cut`` (truncated) and ``again`` (role and text stood in an earlier turn)."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text")
    )
    # equal rows meet as one, within tasks first
    different = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    said = F.rtrim("text", F.lit(_SPACE))
    flagged = different.select(
        "*", (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("cut"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), F.struct(F.col("turn").isNotNull().alias("told"), "turn").alias("place")
    )
    keys = ["conv_id", "role", "h1", "h2"]
    several = flagged.groupBy(*keys).agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1").select(*[F.col(k).alias(f"of_{k}") for k in keys], "first")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    again = F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    return flagged.join(several, same, "left").select("conv_id", "turn", "role", "text", "copies", "blank", "cut", again.alias("again"))


_TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()), ("blank", pa.bool_()), ("cut", pa.bool_()), ("again", pa.bool_())])
_SEGMENTS = "conv_id long, part int, seq int, whole boolean, turns array<struct<turn: long, role: string, text: string, copies: long, blank: boolean, cut: boolean, again: boolean>>"


def segments(conversations: DataFrame, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """A stored table of segments ``(conv_id, part, seq, whole, turns)``: runs of different turns in order, (part, seq) is their order. whole: the segment is the conversation."""
    first = F.left("text", F.lit(32))  # what bounds are drawn from is short
    ordered = _turns(conversations).repartitionByRange("conv_id", "turn", "role", first).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        part, seq, held, opened, is_cut = TaskContext.get().partitionId(), 0, None, True, False

        def made(rows_, ends, whole):
            nonlocal seq
            n = len(ends)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            turns = pa.StructArray.from_arrays([rows_.column(f.name).combine_chunks().cast(f.type) for f in _TURN], fields=list(_TURN))
            ids = rows_.column("conv_id").combine_chunks().take(pa.array(offsets[:-1]))
            out = [ids, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(seq, seq + n, dtype=np.int32)), pa.array(whole, pa.bool_()), pa.ListArray.from_arrays(pa.array(offsets), turns)]
            seq += n
            return pa.RecordBatch.from_arrays(out, ["conv_id", "part", "seq", "whole", "turns"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids = t.column("conv_id")
            told, own = np.asarray(ids.is_valid()), np.asarray(ids.fill_null(0))
            new = np.flatnonzero((own[1:] != own[:-1]) | (told[1:] != told[:-1])) + 1
            total = np.cumsum(np.asarray(pc.binary_length(t.column("text"))).astype(np.int64))
            ends, whole = [], []
            for at, to in zip([0, *new], [*new, len(own)], strict=True):
                pieces, over = [], to == len(own)
                while to - at > rows or total[to - 1] - (total[at - 1] if at else 0) > size and to - at > 1:
                    more = int(np.searchsorted(total, (total[at - 1] if at else 0) + size, side="right"))
                    at = min(at + rows, max(at + 1, more))
                    pieces.append(at)
                # the last run of what was read may go on, the first and the last of a part in other parts
                pieces += [] if over else [to]
                whole += [len(pieces) == 1 and not over and not opened and not is_cut] * len(pieces)
                ends += pieces
                opened, is_cut = opened and over, over and (is_cut or bool(pieces))
            if ends:
                yield made(t.slice(0, ends[-1]), ends, whole)
            held = t.slice(ends[-1]) if ends else t
        if held is not None:
            yield made(held, [held.num_rows], [False])

    return stored(ordered.mapInArrow(run, _SEGMENTS), "segments")


class _Batch:
    """Segments of an Arrow batch as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        self.lists = batch.column(batch.schema.get_field_index("turns"))
        self.flat = self.lists.flatten()
        self.sizes = np.asarray(pc.list_value_length(self.lists)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.role = self.flat.field("role").cast(pa.string())
        initial = pc.utf8_slice_codeunits(self.role, 0, 1)
        self.code = np.zeros(len(self.role), dtype=np.int8)
        for k, c in enumerate("sua", 1):
            self.code[np.asarray(pc.equal(initial, c))] = k
        flag = lambda name: self.flat.field(name).to_numpy(zero_copy_only=False)
        self.copies, self.blank, self.cut, self.again = flag("copies"), flag("blank"), flag("cut"), flag("again")
        self.forced = self.blank | self.again

    def buckets(self):
        """Segments of about a length together: their indexes, and the time-major inputs of ``costs``."""
        order = np.argsort(self.sizes, kind="stable")[::-1]
        at = 0
        while at < len(order):
            longest = max(1, int(self.sizes[order[at]]))
            enough = max(1, CELLS // longest)
            # lengths within a bucket differ by a factor of two at most
            to = min(at + enough, int(np.searchsorted(-self.sizes[order], -(longest // 2), side="left")))
            own = order[at : max(to, at + 1)]
            at += len(own)
            t = np.arange(longest)[:, None]
            valid = t < self.sizes[own]
            index = np.where(valid, self.starts[own] + np.minimum(t, np.maximum(self.sizes[own] - 1, 0)), 0)
            yield own, index, [self.code[index], self.forced[index], self.cut[index], self.copies[index], valid]

    def counts(self) -> list[pa.Array]:
        """For each segment: blank, duplicate, truncated, illegal pairs, different turns, the first turn and the last, the first role's code and the last; nulls don't count as turns."""
        turn = self.flat.field("turn")
        told = np.asarray(turn.is_valid())
        turns = np.where(told, np.asarray(turn.fill_null(0)), 0)
        first = np.zeros(len(turns), dtype=bool)
        first[self.starts] = True
        pair = np.roll(self.code, 1) * 4 + self.code
        legal = (pair == 6) | (pair == 11) | (pair == 14)
        new = told & (first | ~np.roll(told, 1) | (np.roll(turns, 1) != turns))
        duplicate = np.where(self.again, self.copies, self.copies - 1)
        sums = [
            np.where(self.blank, self.copies, 0), np.where(self.blank, 0, duplicate), ~self.forced & self.cut, self.copies - 1 + (~first & ~legal), new,
        ]
        ends = self.starts + self.sizes - 1
        out = [pa.array(np.add.reduceat(x.astype(np.int64), self.starts)) for x in sums]
        # null turns come first: the least turn is the first one told, if the last one is told at all
        n_null = np.add.reduceat((~told).astype(np.int64), self.starts)
        least = np.minimum(self.starts + n_null, ends)
        out += [pa.array(turns[least], mask=~told[ends]), pa.array(turns[ends], mask=~told[ends]), pa.array(told[self.starts]), pa.array(self.code[self.starts].astype(np.int64)), pa.array(self.code[ends].astype(np.int64))]
        return out


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "n_turns", "first_turn", "last_turn", "starts_told", "first_code", "last_code"]
_COUNT_TYPES = ", ".join(f"{c} {'boolean' if c == 'starts_told' else 'long'}" for c in _COUNTS)
_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _crossings(batches):
    """For each segment the cheapest cost from each state to each, and its counts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        b = _Batch(batch)
        matrix = np.empty((len(b.sizes), 4, 4), dtype=np.int64)
        for own, _, given in b.buckets():
            n = len(own)
            wide = [np.tile(x, (1, 4)) for x in given]
            end = np.full((4 * n, 4), _FAR)
            end[np.arange(4 * n), np.repeat(np.arange(4), n)] = 0
            matrix[own] = costs(*wide, end)[0].reshape(4, n, 4).transpose(1, 2, 0)  # to, segment, from -> segment, from, to
        keys = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "part", "seq")]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * len(b.sizes) + 1, 16, dtype=np.int32)), pa.array(matrix.ravel()))
        yield pa.RecordBatch.from_arrays([*keys, lists, *b.counts()], ["conv_id", "part", "seq", "matrix", *_COUNTS])


def _in_order(group: pa.Table) -> pa.Table:
    return group.sort_by([("part", "ascending"), ("seq", "ascending")])


def _chained(group: pa.Table) -> pa.Table:
    """For the segments of a conversation, in order, the costs that are left at the end of each; and the whole conversation's cost and counts."""
    g = _in_order(group)
    n = g.num_rows
    matrix = np.array(g.column("matrix").combine_chunks().flatten()).reshape(n, 4, 4)
    ends = np.empty((n, 4), dtype=np.int64)
    left = _END
    for k in range(n - 1, -1, -1):
        ends[k] = left
        left = np.minimum((matrix[k] + left[None, :]).min(axis=1), _FAR)
    c = {name: g.column(name).to_pylist() for name in _COUNTS}
    same = sum(c["starts_told"][k] and c["last_turn"][k - 1] == c["first_turn"][k] for k in range(1, n))
    told = [k for k in range(n) if c["last_turn"][k] is not None]
    gaps = c["last_turn"][told[-1]] - c["first_turn"][told[0]] + 1 - (sum(c["n_turns"]) - same) if told else 0
    # each segment counted its first pair as legal
    illegal = sum(c["illegal"]) + sum((c["last_code"][k - 1], c["first_code"][k]) not in _LEGAL for k in range(1, n))
    totals = [gaps, sum(c["blank"]), sum(c["duplicate"]), sum(c["truncated"]), illegal, int(left[0])]
    fixed = [pa.array([x] * n, pa.int64()) for x in totals]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * n + 1, 4, dtype=np.int32)), pa.array(ends.ravel()))
    return pa.table([g.column("conv_id"), g.column("part"), g.column("seq"), lists, pa.array(np.arange(n) == n - 1), *fixed], ["conv_id", "part", "seq", "left", "last", *_TOTALS])


_TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TOTAL_TYPES = ", ".join(f"{c} long" for c in _TOTALS)


def _ends_of(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    left = np.array(batch.column(batch.schema.get_field_index("left")).flatten()).reshape(n, 4)
    return left, np.asarray(batch.column(batch.schema.get_field_index("last")).to_numpy(zero_copy_only=False))


def _exits(batches):
    """For each segment the state in which the cheapest edits leave it, for each state at its start."""
    for batch in batches:
        if not batch.num_rows:
            continue
        b = _Batch(batch)
        left, last = _ends_of(batch, len(b.sizes))
        exits = np.empty((len(b.sizes), 4), dtype=np.int64)
        for own, _, given in b.buckets():
            cost = costs(*given, left[own])
            for q in range(4):
                exits[own, q] = traced(cost, *given, np.full(len(own), q), last[own])[2]
        keys = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "part", "seq")]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(b.sizes) + 1, 4, dtype=np.int32)), pa.array(exits.ravel()))
        yield pa.RecordBatch.from_arrays([*keys, lists], ["conv_id", "part", "seq", "exits"])


def _entered(group: pa.Table) -> pa.Table:
    """For the segments of a conversation, in order, the state at the start of each."""
    g = _in_order(group)
    exits = np.array(g.column("exits").combine_chunks().flatten()).reshape(g.num_rows, 4)
    state, q = np.empty(g.num_rows, dtype=np.int64), 0
    for k in range(g.num_rows):
        state[k] = q
        q = exits[k, q]
    return pa.table([g.column("conv_id"), g.column("part"), g.column("seq"), pa.array(state)], ["conv_id", "part", "seq", "state"])


_EDITED = f"conv_id long, part int, seq int, whole boolean, {_TOTAL_TYPES}, audit string, repaired array<struct<role: string, text: string>>"
_PAIR = pa.struct([("role", pa.string()), ("text", pa.string())])


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _edited(batches):
    """The letters of each segment's edits and its turns after them; totals of segments that are conversations."""
    for batch in batches:
        if not batch.num_rows:
            continue
        b = _Batch(batch)
        n = len(b.sizes)
        whole = batch.column(batch.schema.get_field_index("whole"))
        column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        if "left" in column:
            (left, last), state = _ends_of(batch, n), column["state"].to_numpy()
            totals = [column[c] for c in _TOTALS]
        else:
            left, last, state = np.tile(_END, (n, 1)), np.ones(n, dtype=bool), np.zeros(n, dtype=np.int64)
            blank, duplicate, truncated, illegal, n_turns, first_turn, last_turn, *_ = b.counts()
            gaps = pc.fill_null(pc.add(pc.subtract(pc.subtract(last_turn, first_turn), n_turns), 1), 0)
            total = np.empty(n, dtype=np.int64)
        audits, sources, states, order = [], [], [], []
        for own, index, given in b.buckets():
            cost = costs(*given, left[own])
            if "left" not in column:
                total[own] = cost[0, :, 0]
            letters, after, _ = traced(cost, *given, state[own], last[own])
            # all but one of equal turns go, right after it
            extra = np.pad(np.where(given[4], given[3] - 1, 0).T, ((0, 0), (0, 1)))
            wide = np.concatenate([letters, np.full((*extra.shape, 1), _D, dtype=np.uint8)], axis=2)
            times = np.concatenate([letters > 0, extra[:, :, None]], axis=2)
            said = np.repeat(wide.ravel(), times.ravel())
            audits.append(pa.StringArray.from_buffers(len(own), _offsets(times.sum(axis=(1, 2))).buffers()[1], pa.py_buffer(said.tobytes())))
            stays = (letters > 0) & (letters != _D)
            source = np.broadcast_to(np.pad(index.T, ((0, 0), (0, 1)))[:, :, None], letters.shape)
            offsets = _offsets(stays.sum(axis=(1, 2)))
            sources.append(pa.ListArray.from_arrays(offsets, pa.array(np.where(letters == _I, -1, source)[stays].astype(np.int64))))
            states.append(pa.ListArray.from_arrays(offsets, pa.array(np.where(letters == _K, 0, after)[stays].astype(np.int64))))
            order.append(own)
        back = pa.array(np.argsort(np.concatenate(order), kind="stable"))
        audit, src, to = (pa.concat_arrays(x).take(back) for x in (audits, sources, states))
        offsets, src, to = _offsets(np.asarray(pc.list_value_length(src))), src.flatten(), to.flatten()
        given_role = pa.array(["", "", "user", "assistant"]).take(to)
        taken = pa.array(np.maximum(np.asarray(src), 0))
        role = pc.if_else(pc.equal(to, 0), b.role.take(taken), given_role)
        text = pc.if_else(pc.less(src, 0), "", b.flat.field("text").cast(pa.string()).take(taken))
        lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([role, text], fields=list(_PAIR)))
        if "left" not in column:
            totals = [gaps, blank, duplicate, truncated, illegal, pa.array(total)]
        yield pa.RecordBatch.from_arrays(
            [column["conv_id"], column["part"], column["seq"], whole, *totals, audit, lists], ["conv_id", "part", "seq", "whole", *_TOTALS, "audit", "repaired"]
        )


def edits(parts: DataFrame) -> DataFrame:
    """Of a table of segments: ``(conv_id, part, seq, whole, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired)``.

    audit and repaired (the turns after repair) are the segment's, the six
    numbers the whole conversation's. Only segments of conversations that go over
    several are chained; what meets in a group there is some numbers a segment.
    """
    at_once = parts.where("whole").mapInArrow(_edited, _EDITED)
    cut = parts.where("not whole")
    keys = ["part", "seq"]
    crossings = cut.mapInArrow(_crossings, f"conv_id long, part int, seq int, matrix array<long>, {_COUNT_TYPES}")
    chained = stored(crossings.groupBy("conv_id").applyInArrow(_chained, f"conv_id long, part int, seq int, left array<long>, last boolean, {_TOTAL_TYPES}"), "chained")
    exits = cut.join(chained.select(*keys, "left", "last"), keys).mapInArrow(_exits, "conv_id long, part int, seq int, exits array<long>")
    entered = exits.groupBy("conv_id").applyInArrow(_entered, "conv_id long, part int, seq int, state long")
    known = chained.drop("conv_id").join(entered.drop("conv_id"), keys)
    return at_once.unionByName(cut.join(known, keys).mapInArrow(_edited, _EDITED))


def repaired(conversations: DataFrame) -> DataFrame:
    """``(conv_id, part, seq, pos, role, text)``: the turns of every conversation after repair, in the order of part, seq and pos. Conversations of which nothing is left have none."""
    return edits(segments(conversations)).select("conv_id", "part", "seq", F.posexplode("repaired").alias("pos", "turn")).select("conv_id", "part", "seq", "pos", "turn.role", "turn.text")


def _streamed(batches):
    """One row for each conversation that goes over several segments, which come in order: its audit and the hash of its turns."""
    now, audit, digest, totals, begun = None, [], None, None, False

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), *[pa.array([x], pa.int64()) for x in totals], pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], ["conv_id", *_TOTALS, "audit", "repaired_sha256"])

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now[0] != r["conv_id"]:
                if now is not None:
                    yield row()
                now, audit, digest, totals, begun = (r["conv_id"],), [], hashlib.sha256(), [r[c] for c in _TOTALS], False
            audit.append(r["audit"])
            for turn in r["repaired"]:
                digest.update(f"{chr(10) if begun else ''}{turn['role']}:{turn['text']}".encode("utf-8", "surrogatepass"))
                begun = True
    if now is not None:
        yield row()


def report(conversations: DataFrame, ids: DataFrame | None = None, rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of each conversation of ``conversations(conv_id, turn, role, text, ...)``.

    ids: a table with conv_ids that are to be reported even if they have no rows
    (zeros, an empty audit, the hash of nothing). Turns go by ``turn``, null
    first, equal ones by role and text. A null role or text is one space; an
    empty role is none of the three. Rows that are equal are duplicates of the
    first. Rows without conv_id are one conversation. Other columns are ignored,
    whatever their names. A conversation of any length spreads over tasks until
    its hash and audit, which are made by one task from a segment at a time. An
    empty table gives an empty result. rows, size: where segments are cut; no result depends on it.
    """
    done = edits(segments(conversations, rows, size))
    names = ["conv_id", *_TOTALS, "audit", "repaired_sha256"]
    lines = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    whole = done.where("whole").select("conv_id", *_TOTALS, "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    ordered = done.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    rest = ordered.select("conv_id", *_TOTALS, "audit", "repaired").mapInArrow(_streamed, f"conv_id long, {_TOTAL_TYPES}, audit string, repaired_sha256 string")
    out = whole.unionByName(rest).select(*names)
    if ids is None:
        return out
    every = ids.select(F.col("conv_id").cast("long").alias("id")).distinct()
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _TOTALS]
    return every.join(out, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults at known places: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role ``user``. Nulls of a row are one space."""
    space = F.lit(" ")
    told = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    role: Column = F.when(F.col("fate") == 4, "user").otherwise(told("role"))
    text: Column = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    rows = conversations.withColumn("fate", fate) if "fate" not in conversations.columns else conversations.select("conv_id", "turn", "role", "text").withColumn("fate", fate)
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.where("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")
