"""Repair of the structure of conversations by a shortest path through the lattice of edits.

A node of the lattice is a number of rows read and a state of the grammar ``(s?(ua)+)?`` of role
initials. Edits are its steps: keep a row, rewrite its role, delete it, or insert a row without text.
Bidirectional Dijkstra grows a tree of least costs from the start and one from the end, both with the
least audit (string of edit initials) of every node. Once the two heaps can no longer meet at the least
cost, all crossings of that cost are known, and the least concatenation of their audits is taken.

Conversations may be of any length. Rows are range-partitioned by conversation and turn, and every
task cuts its sorted rows into segments of bounded size. A conversation within one segment is solved
there. For others each segment is solved for every pair of states at its ends; the states at the
borders follow from these small tables, and the audits of segments then join to the least one of the
whole. Two audits over the same rows are never prefixes of one another, since a segment's audit ends
with the edit of its last row, so comparing segment by segment compares whole audits.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.words import SPACES, small_batches
from spanloom.operators.lineage import cut_lineage

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"

# States: nothing yet, after s, after u, after a. A kept row moves by its initial, a written one by
# the only role that fits.
STATES = range(4)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WRITTEN = (2, 2, 3, 2)
ACCEPTED = (0, 3)
# Inserts that bring a state to an accepted one at the end of a conversation.
CLOSING = ("", INSERT + INSERT, INSERT, "")

# Symbols of rows: the initial, in upper case when truncated; "x" for other initials.
BLANK, DUPLICATE = "b", "d"

SEGMENT_ROWS, SEGMENT_BYTES = 128, 1 << 18
BATCH_ROWS = 256
SOLVED_PATTERNS = 50_000

TURN_COLUMNS = ["conv_id", "turn", "role", "text", "dropped"]
SEGMENT_DDL = """conv_id long, part int, seq int, whole boolean, first_turn long, last_turn long,
  turns long, initials string, symbols string, digests array<binary>, roles array<string>, texts array<string>"""
EDITED_DDL = """conv_id long, part int, seq int, first_turn long, last_turn long, turns long,
  initials string, symbols string, cost long, audit string, roles array<string>, texts array<string>"""
TABLE_DDL = "conv_id long, part int, seq int, costs array<int>, ranks array<int>"
CHOICE_DDL = "part int, seq int, entry int, exit int, closing string"
SUMMARY_DDL = """conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long,
  cost long, audit string, repaired_sha256 string"""


class Lattice:
    """The edits of one list of symbols; ``closed`` tells whether rows may be inserted at the end."""

    def __init__(self, symbols: str, closed: bool):
        self.symbols, self.closed = symbols, closed

    def steps(self, i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        inside = i < len(self.symbols)
        if inside or self.closed:
            yield INSERT, INSERT_COST, (i, WRITTEN[state])
        if inside:
            yield DELETE, DELETE_COST, (i + 1, state)
            symbol = self.symbols[i]
            if symbol not in (BLANK, DUPLICATE):
                extra = TRUNCATED_COST if symbol.isupper() else 0
                yield REROLE, REROLE_COST + extra, (i + 1, WRITTEN[state])
                if (after := AFTER.get((state, symbol.lower()))) is not None:
                    yield KEEP, extra, (i + 1, after)

    def steps_back(self, i: int, state: int) -> Iterator[tuple[str, int, tuple[int, int]]]:
        if i < len(self.symbols) or self.closed:
            for before in STATES:
                if WRITTEN[before] == state:
                    yield INSERT, INSERT_COST, (i, before)
        if i:
            yield DELETE, DELETE_COST, (i - 1, state)
            symbol = self.symbols[i - 1]
            if symbol not in (BLANK, DUPLICATE):
                extra = TRUNCATED_COST if symbol.isupper() else 0
                for before in STATES:
                    if WRITTEN[before] == state:
                        yield REROLE, REROLE_COST + extra, (i - 1, before)
                    if AFTER.get((before, symbol.lower())) == state:
                        yield KEEP, extra, (i - 1, before)


class Search:
    """One direction: labels (cost, least audit) of nodes, settled by cost and then along the rows.

    Only keeping a row may cost nothing, so among nodes of one cost those nearer to the search's
    origin come first, and a settled node's audit is final.
    """

    def __init__(self, origins, steps, forward: bool):
        self.steps, self.forward = steps, forward
        self.label = {node: (0, "") for node in origins}
        self.settled: set[tuple[int, int]] = set()
        self.heap = [(0, self._place(node), node) for node in origins]
        heapq.heapify(self.heap)

    def _place(self, node: tuple[int, int]) -> int:
        return node[0] if self.forward else -node[0]

    def least(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self, other: Search) -> int | None:
        """Settle the nearest node; the least cost at which its neighbours meet the other search."""
        _, _, node = heapq.heappop(self.heap)
        self.settled.add(node)
        cost, audit = self.label[node]
        met = cost + other.label[node][0] if node in other.label else None
        for letter, added, neighbour in self.steps(*node):
            label = (cost + added, audit + letter if self.forward else letter + audit)
            if neighbour not in self.label or label < self.label[neighbour]:
                if neighbour not in self.label or label[0] < self.label[neighbour][0]:
                    heapq.heappush(self.heap, (label[0], self._place(neighbour), neighbour))
                self.label[neighbour] = label
                if neighbour in other.label:
                    here = label[0] + other.label[neighbour][0]
                    met = here if met is None else min(met, here)
        return met


@lru_cache(maxsize=SOLVED_PATTERNS)
def cheapest_edits(
    symbols: str, entry: int = 0, exits: tuple[int, ...] = ACCEPTED, closed: bool = True
) -> tuple[int, str] | None:
    """Least cost and least audit of all paths from ``entry`` to one of ``exits``, or None."""
    lattice = Lattice(symbols, closed)
    ahead = Search([(0, entry)], lattice.steps, True)
    back = Search([(len(symbols), state) for state in exits], lattice.steps_back, False)
    best: int | None = None
    while (near := ahead.least()) is not None and (far := back.least()) is not None:
        if best is not None and near + far > best:
            break
        met = ahead.settle(back) if near <= far else back.settle(ahead)
        if met is not None and (best is None or met < best):
            best = met
    crossings = [
        (cost + back.label[node][0], audit + back.label[node][1])
        for node, (cost, audit) in ahead.label.items()
        if node in back.label
    ]
    return min(crossings, default=None)


def apply_edits(audit: str, entry: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The rows that the edits leave; the state tells the role of rewritten and inserted rows."""
    state, i, rows = entry, 0, []
    for letter in audit:
        if letter == KEEP:
            rows.append((roles[i], texts[i]))
            state = AFTER[state, roles[i][0]]
        elif letter != DELETE:
            role = ASSISTANT if state == 2 else USER
            rows.append((role, texts[i] if letter == REROLE else ""))
            state = WRITTEN[state]
        i += letter != INSERT
    return rows


def _initial(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "x"


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


class _Segment:
    """Rows of one conversation as a task reads them."""

    def __init__(self, conv_id, part: int, seq: int):
        self.conv_id, self.part, self.seq = conv_id, part, seq
        self.first_turn = self.last_turn = None
        self.turns = self.bytes = 0
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.initials: list[str] = []
        self.symbols: list[str] = []
        self.digests: list[bytes | None] = []
        self.seen: set[bytes] = set()

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial, digest = _initial(role), None
        said = text.rstrip(SPACES)
        if not said:
            symbol = BLANK
        else:
            digest = _digest(role, text)
            if digest in self.seen:
                symbol = DUPLICATE
            else:
                symbol = initial if said[-1] in ".!?" else initial.upper()
            self.seen.add(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.initials.append(initial)
        self.symbols.append(symbol)
        self.digests.append(digest)
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def row(self, whole: bool) -> tuple:
        return (
            self.conv_id,
            self.part,
            self.seq,
            whole,
            self.first_turn,
            self.last_turn,
            self.turns,
            "".join(self.initials),
            "".join(self.symbols),
            None if whole else self.digests,
            self.roles,
            self.texts,
        )


_SEGMENT_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(),
    pa.string(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.string()),
]
_SEGMENT_NAMES = [c.split()[0] for c in SEGMENT_DDL.split(",")]


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in types)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
    )


def _cut(batches):
    """Sorted rows to segments. The first and the last conversation of a task may go on in others."""
    part, seq, first = TaskContext.get().partitionId(), 0, True
    open_segment: _Segment | None = None
    ready: list[tuple] = []
    size, cut_before = 0, False

    for batch in batches:
        for conv_id, turn, role, text, dropped in zip(*(batch[c].to_pylist() for c in TURN_COLUMNS)):
            if open_segment is None or conv_id != open_segment.conv_id:
                if open_segment is not None:
                    ready.append(open_segment.row(whole=not first and not cut_before))
                    first, cut_before, size = False, False, size + open_segment.bytes
                open_segment, seq = _Segment(conv_id, part, seq), seq + 1
            elif open_segment.full():
                ready.append(open_segment.row(whole=False))
                cut_before, size = True, size + open_segment.bytes
                open_segment, seq = _Segment(conv_id, part, seq), seq + 1
            if not dropped:
                open_segment.add(turn, role, text)
            if len(ready) >= BATCH_ROWS or size >= 4 * SEGMENT_BYTES:
                yield _batch(ready, _SEGMENT_TYPES, _SEGMENT_NAMES)
                ready, size = [], 0
    if open_segment is not None:
        ready.append(open_segment.row(whole=False))
    yield _batch(ready, _SEGMENT_TYPES, _SEGMENT_NAMES)


def turn_rows(conversations: DataFrame, dropped: Column | None = None) -> DataFrame:
    """``conversations`` as the repair reads them: null roles and texts become one space.

    Rows ``dropped`` only tell that their conversation exists.
    """
    gone = F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.when(gone, "").otherwise(F.coalesce(F.col("text").cast("string"), F.lit(" "))).alias("text"),
        gone.alias("dropped"),
    )


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """:func:`turn_rows` after seeded damage: of 20 rows one each is dropped, emptied, stripped of its
    ends of sentences, repeated, and given to the user."""
    rows = turn_rows(conversations)
    key = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    )
    act = F.col("act")
    text = F.when(act == 1, "").when(act == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.sequence(F.lit(1), F.when(act == 3, 2).otherwise(1))
    damaged = rows.withColumn("act", F.crc32(key.cast("binary")) % 20).select(
        "conv_id",
        "turn",
        F.when(act == 4, USER).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (act == 0).alias("gone"),
        F.explode(times).alias("copy"),
    )
    return turn_rows(damaged, F.col("gone"))


def cut_segments(turns: DataFrame) -> DataFrame:
    """Segments of conversations in the order of turns; equal turns go by role and text.

    Ranges are taken over the start of the text as well, so that a conversation without turns, or one
    with a single turn, may be spread over many tasks.
    """
    ranged = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    return cut_lineage(ordered.select(TURN_COLUMNS).mapInArrow(_cut, SEGMENT_DDL))


def _seen_before(segments: DataFrame) -> DataFrame:
    """Per segment the digests that an earlier segment of its conversation holds already."""
    place = F.struct("part", "seq")
    said = segments.select("conv_id", place.alias("place"), F.explode("digests").alias("digest"))
    said = said.filter(F.col("digest").isNotNull()).distinct()
    key = F.hash("conv_id", "digest")  # joins null conversations as well
    keyed = said.select(F.struct("conv_id", "digest").alias("what"), key.alias("hash"), "place")
    firsts = keyed.groupBy("hash", "what").agg(F.min("place").alias("first"))
    both = keyed.alias("a").join(
        firsts.alias("b"),
        (F.col("a.hash") == F.col("b.hash")) & F.col("a.what").eqNullSafe(F.col("b.what")),
    )
    return (
        both.filter(F.col("place") > F.col("first"))
        .groupBy("place")
        .agg(F.collect_set("a.what.digest").alias("before"))
        .select("place.part", "place.seq", "before")
    )


def _mark_duplicates(symbols: str, digests: list, before: list | None) -> str:
    known = set(before or ())
    return "".join(DUPLICATE if d in known else s for s, d in zip(symbols, digests))


def _tables(batches):
    """Costs of a segment for every pair of states, and the order of its audits by entry."""
    for batch in batches:
        rows = []
        for conv_id, part, seq, symbols in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "seq", "symbols"))):
            costs, ranks = [], []
            for entry in STATES:
                found = [cheapest_edits(symbols, entry, (state,), False) for state in STATES]
                audits = sorted(f[1] for f in found if f)
                costs += [f[0] if f else -1 for f in found]
                ranks += [audits.index(f[1]) if f else -1 for f in found]
            rows.append((conv_id, part, seq, costs, ranks))
        ints = pa.list_(pa.int32())
        yield _batch(rows, [pa.int64(), pa.int32(), pa.int32(), ints, ints], ["conv_id", "part", "seq", "costs", "ranks"])


def _choose(batches):
    """States at the borders of segments, which come last first by conversation.

    Per segment only the next state of each state is held, until the conversation's first segment.
    """
    places, choices = array("i"), bytearray()
    togo: list[int | None] = []
    conv: list = []

    def chosen():
        rows, state = [], 0
        for at in range(len(places) // 2 - 1, -1, -1):
            after = choices[4 * at + state]
            closing = CLOSING[after] if at == 0 else ""
            rows.append((places[2 * at], places[2 * at + 1], state, after, closing))
            state = after
            if len(rows) == 10_000 or at == 0:
                yield _batch(
                    rows,
                    [pa.int32()] * 4 + [pa.string()],
                    ["part", "seq", "entry", "exit", "closing"],
                )
                rows = []

    for batch in batches:
        names = ("conv_id", "part", "seq", "costs", "ranks")
        for conv_id, part, seq, costs, ranks in zip(*(batch[c].to_pylist() for c in names)):
            if conv != [conv_id]:
                yield from chosen()
                conv, places, choices = [conv_id], array("i"), bytearray()
                togo = [len(c) * INSERT_COST for c in CLOSING]
            places.extend((part, seq))
            now: list[int | None] = []
            for entry in STATES:
                ways = [
                    (costs[4 * entry + state] + togo[state], ranks[4 * entry + state], state)
                    for state in STATES
                    if costs[4 * entry + state] >= 0 and togo[state] is not None
                ]
                best = min(ways, default=None)
                now.append(best[0] if best else None)
                choices.append(best[2] if best else 0)
            togo = now
    yield from chosen()


_EDITED_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
    pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()),
]
_EDITED_NAMES = [c.split()[0] for c in EDITED_DDL.split(",")]
_PLACE = ["conv_id", "part", "seq", "first_turn", "last_turn", "turns", "initials"]


def _edit(batches):
    """Segments with their edits and the rows that these leave."""
    for batch in batches:
        held = {c: batch[c].to_pylist() for c in batch.schema.names}
        rows = []
        for i in range(batch.num_rows):
            symbols, entry = held["symbols"][i], held["entry"][i]
            if entry is None:
                entry, (cost, audit) = 0, cheapest_edits(symbols)
            else:
                cost, audit = cheapest_edits(symbols, entry, (held["exit"][i],), False)
                closing = held["closing"][i]
                cost, audit = cost + INSERT_COST * len(closing), audit + closing
            left = apply_edits(audit, entry, held["roles"][i], held["texts"][i])
            place = [held[c][i] for c in _PLACE]
            rows.append((*place, symbols, cost, audit, [r for r, _ in left], [t for _, t in left]))
        yield _batch(rows, _EDITED_TYPES, _EDITED_NAMES)


def _symbols_of(batches):
    """Open segments with the duplicates of earlier segments among their symbols."""
    for batch in batches:
        marked = [
            _mark_duplicates(*row)
            for row in zip(*(batch[c].to_pylist() for c in ("symbols", "digests", "before")))
        ]
        names = ["conv_id", "part", "seq"]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in names), pa.array(marked, pa.string())], names=[*names, "symbols"]
        )


class RepairedConversations:
    """Edited segments of conversations: ``whole`` ones, and those of conversations in several."""

    def __init__(self, whole: DataFrame, parts: DataFrame):
        self.whole, self.parts = whole, parts

    def turns(self) -> DataFrame:
        """The repaired rows as ``(conv_id, part, seq, place, role, text)``, in this order."""
        rows = self.whole.unionByName(self.parts)
        zipped = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")
        return rows.select("conv_id", "part", "seq", zipped).select(
            "conv_id", "part", "seq", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
        )

    def summaries(self) -> DataFrame:
        """One row per conversation: its faults, the cost and audit of the repair, and a digest.

        Segments of one conversation pass through one task in order, which holds counts and the audit.
        """
        dealt = self.parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
        found = self.whole.mapInArrow(_summarise, SUMMARY_DDL)
        return found.unionByName(dealt.mapInArrow(_summarise, SUMMARY_DDL))


def _summarise(batches):
    conv: list = []
    rows: list[tuple] = []

    def begin():
        return {"first": None, "last": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                "illegal": 0, "cost": 0, "audit": [], "initial": "", "digest": hashlib.sha256(), "rows": 0}

    def row(s) -> tuple:
        gaps = 0 if s["first"] is None else s["last"] - s["first"] + 1 - s["turns"]
        counts = (s[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost"))
        return (*conv, gaps, *counts, "".join(s["audit"]), s["digest"].hexdigest())

    state = begin()
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in SUMMARY_DDL.split(",")]
    for batch in batches:
        for (conv_id, _, _, first, last, turns, initials, symbols, cost, audit, roles, texts) in zip(
            *(batch[c].to_pylist() for c in _EDITED_NAMES)
        ):
            if conv != [conv_id]:
                if conv:
                    rows.append(row(state))
                conv, state = [conv_id], begin()
            if first is not None:
                state["turns"] += turns - (first == state["last"])
                state["first"] = first if state["first"] is None else state["first"]
                state["last"] = last
            chain = state["initial"] + initials
            state["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in zip(chain, chain[1:]))
            state["initial"] = chain[-1:]
            state["blank"] += symbols.count(BLANK)
            state["duplicate"] += symbols.count(DUPLICATE)
            state["truncated"] += sum(c.isupper() for c in symbols)
            state["cost"] += cost
            state["audit"].append(audit)
            for role, text in zip(roles, texts):
                state["digest"].update(f"{chr(10) if state['rows'] else ''}{role}:{text}".encode())
                state["rows"] += 1
        yield _batch(rows, types, names)
        rows = []
    if conv:
        yield _batch([row(state)], types, names)


def repair_turns(turns: DataFrame) -> RepairedConversations:
    """Repair the conversations of :func:`turn_rows`.

    The first fault of a row counts: blank (no word), duplicate (role and text seen earlier in the
    conversation), truncated (no end of sentence). Blank and duplicate rows must be deleted. Roles are
    told by their first letter; an empty role, or another letter, fits nowhere. Rows are read by turn,
    nulls first, then by role and text; repeated rows are duplicates. A null id is a conversation of
    its own. Texts of any length are read whole. Conversations without rows leave nothing; an empty
    table gives empty results.
    """
    spark = turns.sparkSession
    with small_batches(spark, BATCH_ROWS):
        segments = cut_segments(turns)
        pieces = segments.filter("not whole")
        narrow = pieces.select("conv_id", "part", "seq", "symbols", "digests")
        marked = narrow.join(cut_lineage(_seen_before(pieces)), ["part", "seq"], "left")
        symbols = cut_lineage(
            marked.mapInArrow(_symbols_of, "conv_id long, part int, seq int, symbols string")
        )
        tables = symbols.mapInArrow(_tables, TABLE_DDL).repartition("conv_id")
        backwards = tables.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
        choices = cut_lineage(backwards.mapInArrow(_choose, CHOICE_DDL))
        chosen = (
            pieces.drop("symbols")
            .join(symbols.drop("conv_id"), ["part", "seq"])
            .join(choices, ["part", "seq"])
        )
        none = {c: F.lit(None).cast(t) for c, t in (("entry", "int"), ("exit", "int"), ("closing", "string"))}
        alone = segments.filter("whole").withColumns(none)
        columns = [*_PLACE, "symbols", "roles", "texts", "entry", "exit", "closing"]
        return RepairedConversations(
            alone.select(columns).mapInArrow(_edit, EDITED_DDL),
            chosen.select(columns).mapInArrow(_edit, EDITED_DDL),
        )


def repair_conversations(conversations: DataFrame) -> RepairedConversations:
    """:func:`repair_turns` of a table ``conv_id, turn, role, text``; other columns may have any name."""
    return repair_turns(turn_rows(conversations))


def damaged_repairs(conversations: DataFrame) -> DataFrame:
    """Summaries of the repair of every conversation after :func:`damaged_turns`.

    Conversations of which no row is left have zeros, an empty audit and the digest of nothing.
    """
    with small_batches(conversations.sparkSession, BATCH_ROWS):
        return cut_lineage(repair_turns(damaged_turns(conversations)).summaries())
