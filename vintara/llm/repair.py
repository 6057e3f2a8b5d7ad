"""Conversation structure repair by Hirschberg's divide and conquer.

The roles of a conversation have to read ``(s?(ua)+)?``, so what has been put out so far is in one
of four states: nothing, the system row, a user row, an assistant row. Rows are kept, get another
role or go, and empty rows may be put in. Costs of the cheapest edits up to each state run forward
over the rows, costs from each state to the end run backward; where they meet in the middle, the
cheapest crossing is taken, of several the one whose edits so far are least in order, and both halves
are done the same way. No table of all rows and states is kept.

Of two ways to different states after the same rows neither list of edits begins with the other,
since inserts count to the row after them; so the order of the four lists, a number for each, is all
that has to be carried along to find the least list of all.

Rows are put in order by ranges of (conversation, turn), which splits a long conversation over tasks.
A task reads its rows as a stream and settles each conversation that lies within one block. The others
are cut into blocks of bounded size, each with its costs and orders from state to state; these compose,
so a conversation's blocks give the states in which it crosses from one to the next, and then each
block is settled by itself. What stays sequential is the SHA-256 of such a conversation, which is
read in order as a stream.

Odd rows: a null role or text is one blank. Rows of the same turn follow each other by role and text;
a null turn comes first; rows without an id are one conversation. A role that does not begin with s, u
or a (an empty one too) cannot be kept as it is. Gaps wrap around like long numbers. An empty table
gives no rows. Other columns are not read, so they may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

#: Edits and their costs; a cut-off row that stays costs more.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Rows and characters of a block.
ROWS, CHARS = 1 << 16, 1 << 22
#: Conversations of up to that many rows are remembered by their kinds of rows.
SHORT, KNOWN = 24, 100_000

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEVER = 1 << 40
#: Kinds of rows: the role they have (u, a, s, another), four more if cut off; one that has to go.
_INITIALS, GONE = "uas", 8
_LEGAL = {"su", "ua", "au"}
_FACTS = "blank long, duplicate long, truncated long, illegal long"
RESULT = f"conv_id long, gaps long, {_FACTS}, cost long, audit string, repaired_sha256 string"
_ENDS = "turns long, low long, high long, first_turn long, last_turn long, first_role string, last_role string"
_BLOCKS = (f"tag int, conv_id long, part int, block int, {_FACTS}, {_ENDS}, costs array<long>, orders array<int>, "
           "seq int, kind int, copies long, role string, text string, gaps long, cost long, audit string, repaired_sha256 string")


def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


class Paths:
    """Cheapest, least lists of edits over rows given as a kind each."""

    def __init__(self) -> None:
        self.steps = [self._steps(kind) for kind in range(GONE + 1)]
        self.ends = [0, 2 * INSERT, INSERT, 0]
        self.tails = ["", "II", "I", ""]
        self.forward: dict = {}
        self.backward: dict = {}
        self.known: dict[bytes, tuple[int, str]] = {}

    @staticmethod
    def _steps(kind: int) -> list[list[tuple[int, str] | None]]:
        """From each state to each other: the cheapest inserts and edit for one row."""
        out: list[list] = [[None] * 4 for _ in range(4)]
        role, extra = kind % 4, CUT_OFF if 4 <= kind < GONE else 0
        for start in range(4):
            state = start
            for inserts in range(3):
                ways = [(state, DELETE, "D")]
                if kind != GONE:
                    ways.append((_inserted(state), REROLE + extra, "R"))
                    if role < 2 and _inserted(state) == (USER, ASSISTANT)[role]:
                        ways.append((_inserted(state), KEEP + extra, "K"))
                    if role == 2 and state == NOTHING:
                        ways.append((SYSTEM, KEEP + extra, "K"))
                for to, cost, edit in ways:
                    way = cost + inserts * INSERT, "I" * inserts + edit
                    out[start][to] = min(way, out[start][to] or way)
                state = _inserted(state)
        return out

    # --- vectors over the four states: costs, less the least one, and orders ----------------

    @staticmethod
    def at(state: int) -> tuple:
        return tuple(0 if s == state else _NEVER for s in range(4)) + (0, 0, 0, 0)

    @staticmethod
    def joined(vector: tuple, ways: list[list[tuple | None]]) -> tuple[list[int], list[int], list[int]]:
        """Costs, orders and where from, after ways (cost, what orders those from one state)."""
        costs, froms, keys = [_NEVER] * 4, [-1] * 4, [None] * 4
        for to in range(4):
            found = [(vector[s] + ways[s][to][0], vector[4 + s], s) for s in range(4) if vector[s] < _NEVER and ways[s][to]]
            if found:
                costs[to], order, froms[to] = min(found)
                keys[to] = order, ways[froms[to]][to][1]
        ranked = sorted(k for k in keys if k is not None)
        return costs, [ranked.index(k) if k is not None else 0 for k in keys], froms

    def ahead(self, vector: tuple, kind: int) -> tuple[tuple, int]:
        """The vector after one more row, and what to add to its costs."""
        found = self.forward.get((vector, kind))
        if found is None:
            costs, orders, _ = self.joined(vector, self.steps[kind])
            least = min(costs)
            found = tuple(c if c == _NEVER else c - least for c in costs) + tuple(orders), least
            self.forward[vector, kind] = found
        return found

    def back(self, costs: tuple, kind: int) -> tuple:
        """Costs from each state before a row on, less the least one."""
        found = self.backward.get((costs, kind))
        if found is None:
            ways = self.steps[kind]
            raw = [min((ways[s][t][0] + costs[t] for t in range(4) if ways[s][t] and costs[t] < _NEVER), default=_NEVER)
                   for s in range(4)]
            least = min(raw)
            found = self.backward[costs, kind] = tuple(c if c == _NEVER else c - least for c in raw)
        return found

    def run(self, kinds: bytes, state: int) -> tuple[tuple, int]:
        vector, cost = self.at(state), 0
        for kind in kinds:
            vector, more = self.ahead(vector, kind)
            cost += more
        return vector, cost

    def between(self, kinds: bytes, start: int, end: int) -> str:
        """The cheapest, least list of edits from one state to another."""
        if len(kinds) == 1:
            return self.steps[kinds[0]][start][end][1]
        if not kinds:
            return ""
        middle = len(kinds) // 2
        vector, _ = self.run(kinds[:middle], start)
        costs = self.at(end)[:4]
        for kind in reversed(kinds[middle:]):
            costs = self.back(costs, kind)
        _, _, crossing = min((vector[s] + costs[s], vector[4 + s], s) for s in range(4))
        return self.between(kinds[:middle], start, crossing) + self.between(kinds[middle:], crossing, end)

    def last(self, vector: tuple) -> int:
        """The state in which the rows end best."""
        return min((vector[s] + self.ends[s], vector[4 + s], s) for s in range(4))[2]

    def whole(self, kinds: bytes) -> tuple[int, str]:
        """Cost and edits of a whole conversation."""
        found = self.known.get(kinds)
        if found is None:
            vector, cost = self.run(kinds, NOTHING)
            end = self.last(vector)
            found = cost + vector[end] + self.ends[end], self.between(kinds, NOTHING, end) + self.tails[end]
            if len(kinds) <= SHORT and len(self.known) < KNOWN:
                self.known[kinds] = found
        return found


def repaired(audit: str, rows: list[tuple[str, str]], state: int = NOTHING) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave, from a state on."""
    names = {USER: "user", ASSISTANT: "assistant"}
    at = iter(rows)
    for edit in audit:
        row = (None, "") if edit == "I" else next(at)
        if edit == "D":
            continue
        state = SYSTEM if edit == "K" and row[0][0] == "s" else _inserted(state)
        yield (row[0] if edit == "K" else names[state]), row[1]


class _Facts:
    """What is counted along a block, and what stands at its ends."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn: int | None, initial: str, copies: int, blank: bool, duplicate: bool, cut_off: bool) -> None:
        if self.last_role is None:
            self.first_role, self.first_turn = initial, turn
        else:
            self.illegal += self.last_role + initial not in _LEGAL
        self.illegal += copies - 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - 1 + duplicate
            self.truncated += cut_off and not duplicate
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last_role, self.last_turn = initial, turn

    def join(self, other: _Facts) -> None:
        """Take in what follows."""
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.first_role is None:
            return
        if self.last_role is None:
            self.first_role, self.first_turn = other.first_role, other.first_turn
        else:
            self.illegal += self.last_role + other.first_role not in _LEGAL
            self.turns -= other.first_turn is not None and other.first_turn == self.last_turn
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        self.last_role, self.last_turn = other.last_role, other.last_turn

    @property
    def gaps(self) -> int:
        wide = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (wide + 2**63) % 2**64 - 2**63


def _sha(pieces: Iterator[tuple[str, str]]) -> str:
    digest = hashlib.sha256()
    for i, (role, text) in enumerate(pieces):
        digest.update(f"{'' if i == 0 else chr(10)}{role}:{text}".encode())
    return digest.hexdigest()


class _Reader:
    """Rows of one task in order: conversations settled, or cut into blocks."""

    def __init__(self, part: int) -> None:
        self.part, self.paths, self.out, self.blocks = part, Paths(), [], 0
        self.conv: object = self  # no conversation yet
        self.open = True  # whether the conversation may have rows outside the block
        self._begin()

    def _begin(self) -> None:
        self.facts, self.kinds, self.rows, self.held = _Facts(), bytearray(), [], 0

    def row(self, conv: int | None, turn: int | None, role: str, text: str, copies: int, blank: bool, duplicate: bool,
            cut_off: bool) -> None:
        if conv != self.conv:
            if self.conv is not self:
                self._end()
                self.open = False  # the first one may have begun in the task before
            self.conv = conv
        if not copies:
            return
        initial = role[:1]
        kind = GONE if blank or duplicate else (_INITIALS.find(initial) % 4 if initial else 3) + 4 * cut_off
        self.facts.add(turn, initial, copies, blank, duplicate, cut_off)
        self.held += 0 if kind == GONE else len(text)
        self._take(kind, 1, *((None, None) if kind == GONE else (role, text)))
        while copies > 1:
            some = min(copies - 1, ROWS)
            self._take(GONE, some, None, None)
            copies -= some

    def _take(self, kind: int, copies: int, role: str | None, text: str | None) -> None:
        self.kinds += bytes([kind]) * copies
        self.rows.append((kind, copies, role, text))
        if len(self.kinds) >= ROWS or self.held >= CHARS:
            self._block()
            self.open = True

    def _end(self, last: bool = False) -> None:
        if self.open or last:
            self._block()
            return
        facts = self.facts
        cost, audit = self.paths.whole(bytes(self.kinds))
        rows = [(role, text) for _, copies, role, text in self.rows for _ in range(copies)]
        self.out.append(dict(vars(facts), tag=0, conv_id=self.conv, part=self.part, block=-1, gaps=facts.gaps, cost=cost,
                             audit=audit, repaired_sha256=_sha(repaired(audit, rows))))
        self._begin()

    def _block(self) -> None:
        at = {"conv_id": self.conv, "part": self.part, "block": self.blocks}
        costs, orders = [], []
        for state in range(4):
            vector, cost = self.paths.run(bytes(self.kinds), state)
            costs += [c if c == _NEVER else c + cost for c in vector[:4]]
            orders += vector[4:]
        self.out.append(dict(vars(self.facts), **at, tag=1, costs=costs, orders=orders))
        self.out += [dict(at, tag=2, seq=i, kind=kind, copies=copies, role=role, text=text)
                     for i, (kind, copies, role, text) in enumerate(self.rows)]
        self.blocks += 1
        self._begin()


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, reader = _schema(_BLOCKS), _Reader(TaskContext.get().partitionId())
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            reader.row(*row)
        if reader.out:
            yield pa.RecordBatch.from_pylist(reader.out, schema)
            reader.out = []
    if reader.conv is not reader:
        reader._end(last=True)
        yield pa.RecordBatch.from_pylist(reader.out, schema)


def _cross(blocks: pa.Table) -> pa.Table:
    """States in which a conversation enters and leaves its blocks, and a row about it as a whole."""
    paths, facts = Paths(), _Facts()
    blocks = sorted(blocks.to_pylist(), key=lambda b: (b["part"], b["block"]))
    vector, froms = paths.at(NOTHING), []
    for row in blocks:
        other = _Facts()
        for name in vars(other):
            setattr(other, name, row[name])
        facts.join(other)
        ways = [[(row["costs"][4 * s + t], row["orders"][4 * s + t]) if row["costs"][4 * s + t] < _NEVER else None
                 for t in range(4)] for s in range(4)]
        costs, orders, where = paths.joined(vector, ways)
        vector = tuple(costs) + tuple(orders)
        froms.append(where)
    end = paths.last(vector)
    states = [end]
    for where in reversed(froms):
        states.append(where[states[-1]])
    states.reverse()
    out = [{"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "start": start, "end": stop, "tail": ""}
           for row, start, stop in zip(blocks, states, states[1:])]
    out[-1]["tail"] = paths.tails[end]
    out.append(dict(vars(facts), conv_id=blocks[0]["conv_id"], part=-1, block=-1, gaps=facts.gaps, cost=vector[end] + paths.ends[end]))
    return pa.Table.from_pylist(out, _schema(_CROSSINGS))


_CROSSINGS = f"conv_id long, part int, block int, start int, end int, tail string, gaps long, {_FACTS}, cost long"
_SETTLED = "conv_id long, part int, block int, audit string, left string"


def _settle_block(rows: pa.Table) -> pa.Table:
    """Edits of one block, and the rows that they leave."""
    rows = sorted(rows.to_pylist(), key=lambda r: -1 if r["seq"] is None else r["seq"])
    own, rows = rows[0], rows[1:]  # before its rows, the block itself
    kinds = b"".join(bytes([r["kind"]]) * r["copies"] for r in rows)
    audit = Paths().between(kinds, own["start"], own["end"]) + own["tail"]
    texts = [(r["role"], r["text"]) for r in rows for _ in range(r["copies"])]
    left = [f"{role}:{text}" for role, text in repaired(audit, texts, own["start"])]
    return pa.Table.from_pylist([{"conv_id": own["conv_id"], "part": own["part"], "block": own["block"], "audit": audit,
                                  "left": "\n".join(left) if left else None}], _schema(_SETTLED))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and digest of each conversation from its blocks in order."""
    schema = _schema("conv_id long, audit string, repaired_sha256 string")
    now: list | None = None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, (now[0], "".join(now[1]), now[2].hexdigest())))], schema)

    for batch in batches:
        for conv, audit, left in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "left"))):
            if now is None or now[0] != conv:
                if now is not None:
                    yield row()
                now = [conv, [], hashlib.sha256(), False]
            now[1].append(audit)
            if left is not None:
                now[2].update(f"{chr(10) if now[3] else ''}{left}".encode())
                now[3] = True
    if now is not None:
        yield row()


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows with ``copies``, some damaged by the checksum of their conversation and turn: dropped
    (no copies), emptied, without full stops, repeated, or said by the user."""
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col(conv_id).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    fate, said = F.crc32(named) % 20, F.coalesce(F.col(text), blank)
    return turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(role), blank)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None) -> DataFrame:
    """A row per conversation: its faults, the cost and list of the cheapest edits, and the digest of
    what they leave.

    ``copies`` names a column that says how often a row is there; of a conversation all of whose rows
    are there no time, the id is.
    """
    blank = F.lit(" ")
    rows = common.tuned(turns).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"),
        (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("copies"))
    here = F.col("copies") > 0
    # rows alike are one; what is not there keeps only the id
    rows = rows.select("conv_id", *[F.when(here, F.col(c)).alias(c) for c in ("turn", "role", "text")], "copies")
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    trimmed = F.rtrim("text", F.lit(common.BLANKS))
    rows = rows.withColumns({
        "blank": here & (trimmed == ""), "cut_off": here & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?"),
        "same": F.struct("conv_id", "role", F.sha2("text", 256).alias("text")),
        "at": F.struct(F.col("turn").isNotNull().alias("known"), "turn")})
    several = rows.where(here & ~F.col("blank")).groupBy("same").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    found = lookup_join(rows, several.where("n > 1").select("same", "first"), ["same"], "left")
    found = found.withColumn("duplicate", F.coalesce(F.col("at") > F.col("first"), F.lit(False))).withColumn(
        "tie", F.xxhash64("text"))
    order = ["conv_id", "turn", "role", "tie"]
    placed = found.repartitionByRange(*order).sortWithinPartitions("conv_id", "turn", "role", "text")
    read = settle(placed.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                                "copies", "blank", "duplicate", "cut_off").mapInArrow(_read, _BLOCKS))
    done = read.where("tag = 0").select([c.split()[0] for c in RESULT.split(", ")])
    # what lies in several blocks
    crossings = settle(read.where("tag = 1").groupBy("conv_id").applyInArrow(_cross, _CROSSINGS))
    states = crossings.where("block >= 0").select("conv_id", "part", "block", "start", "end", "tail")
    pieces = read.where("tag > 0").select("conv_id", "part", "block", "seq", "kind", "copies", "role", "text")
    settled = lookup_join(pieces, states, ["conv_id", "part", "block"], "inner").groupBy("conv_id", "part", "block").applyInArrow(
        _settle_block, _SETTLED)
    hashed = settled.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(
        _hash, "conv_id long, audit string, repaired_sha256 string")
    about = crossings.where("block < 0").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return done.unionByName(lookup_join(hashed, about, ["conv_id"], "inner"))
