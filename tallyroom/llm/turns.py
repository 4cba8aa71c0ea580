"""Repair of conversation structure by a Viterbi search that emits edits early.

A conversation should read system (or not), then user and assistant in turn, or
hold nothing. The cheapest keeps, changes of role, deletions and insertions that
get there are found state by state; of equally cheap ones the ASCII-least edits
win. The survivors of the states form a tree of backpointers with counted
references: what all of them share is emitted, dead branches are let go, and
only the unresolved ends stay in memory.

A conversation is searched in segments, of any range of its rows, for every
state it may be entered in; a second search of the same kind over one narrow row
per segment says which way each one is passed. So a conversation with a third of
all rows is the work of many tasks, and only its final text is read in one
stream, as its hash demands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyroom.llm.common import SPACES, ship, slices, stored

# What edits cost; a cut row that stays costs CUT more.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
# States by what came last. An end is allowed with nothing or after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
ENDS = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
LEGAL = {"su", "ua", "au"}
#: From any state, what another one goes on with costs at most this much more; a survivor worse by more cannot win.
BEHIND = 6
#: Rows of a segment, at most, and how often the tree looks for edits to emit.
SEGMENT, EMIT = 4096, 32
LONGEST = 2**63 - 1


class Node:
    __slots__ = ("parent", "edit", "refs")

    def __init__(self, parent: Node | None, edit) -> None:
        self.parent, self.edit, self.refs = parent, edit, 0
        if parent:
            parent.refs += 1


class Survivors:
    """The best way into each state: ``(cost, rank, node)``, ranks in the order of their edits.

    Ways are compared by the rank of what they follow and then by their last
    edit, which is the order of their complete unresolved edits: no way's edits
    begin like all of another's, as each ends with the edit of the same row.
    """

    def __init__(self, entry: int) -> None:
        self.root = Node(None, None)
        self.states: dict[int, tuple[int, int, Node]] = {entry: (0, 0, self.root)}
        self.root.refs = 1
        self.emitted: list = []
        self.steps = 0

    def step(self, ways: dict[int, tuple]) -> None:
        """``ways`` has for each state the best ``(cost, rank, edit, node)``; all of them one row further."""
        least = min(w[0] for w in ways.values())
        left = sorted((w[1], w[2], s, w[0], w[3]) for s, w in ways.items() if w[0] <= least + BEHIND)
        old = [node for _, _, node in self.states.values()]
        self.states = {}
        for rank, (_, edit, state, cost, parent) in enumerate(left):
            node = Node(parent, edit)
            node.refs = 1
            self.states[state] = (cost, rank, node)
        for node in old:
            # A way that no state follows is let go, up to where others branch off.
            node.refs -= 1
            while node.refs == 0 and node.parent:
                node = node.parent
                node.refs -= 1
        self.steps += 1
        if self.steps % EMIT == 0:
            self.emit()

    def emit(self) -> None:
        """Emit what all survivors share; the tree then begins at their last common ancestor."""
        path = self.path(next(iter(self.states.values()))[2])
        shared = self.root
        for node in path[:-1]:
            if shared.refs != 1:
                break
            self.emitted.append(node.edit)
            shared = node
        shared.parent = None
        self.root = shared

    def path(self, node: Node) -> list[Node]:
        """The nodes behind the root down to ``node``."""
        found = []
        while node is not self.root:
            found.append(node)
            node = node.parent
        return found[::-1]

    def edits(self, state: int) -> list:
        return [n.edit for n in self.path(self.states[state][2])]


def with_inserts(states: dict[int, tuple[int, int, Node]]) -> dict[int, tuple]:
    """The best way into each state, insertions after the last row included: ``(cost, rank, edits, node)``."""
    ways = {s: (c, r, "", n) for s, (c, r, n) in states.items()}
    for to, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER, START, SYSTEM))):
        for s in sources:
            if s in states:
                cost, rank, node = states[s]
                edits = "II" if to == ASSISTANT and s != USER else "I"
                way = (cost + INSERT * len(edits), rank, edits, node)
                if to not in ways or way[:3] < ways[to][:3]:
                    ways[to] = way
    return ways


def row_ways(states: dict, initial: str, faulty: bool, cut: bool, copies: int) -> dict[int, tuple]:
    """The best way into each state past one row and its ``copies - 1`` repeats, which must go."""
    ways: dict[int, tuple] = {}
    rest, price = "D" * (copies - 1), DELETE * (copies - 1)
    extra = CUT if cut else 0

    def offer(to: int, way: tuple, cost: int, edit: str) -> None:
        new = (way[0] + cost + price, way[1], way[2] + edit + rest, way[3])
        if to not in ways or new[:3] < ways[to][:3]:
            ways[to] = new

    for state, way in with_inserts(states).items():
        offer(state, way, DELETE, "D")
        if faulty:
            continue
        if initial == "s" and state == START:
            offer(SYSTEM, way, extra, "K")
        to = ASSISTANT if state == USER else USER
        if initial == ("a" if to == ASSISTANT else "u"):
            offer(to, way, extra, "K")
        else:
            offer(to, way, REROLE + extra, "R")
    return ways


def best_end(states: dict[int, tuple[int, int, Node]]) -> tuple[int, int, str]:
    """State, cost and last insertions of the best end of a conversation."""
    ends = [(c + INSERT * len(ENDS[s]), r, ENDS[s], s) for s, (c, r, _) in states.items()]
    cost, _, tail, state = min(ends)
    return state, cost, tail


def searched(rows: list[tuple[str, bool, bool, int]], entries: tuple[int, ...]) -> tuple[list, list, list]:
    """Costs, ranks and edits of the best ways through a segment, for 4 entries times 4 exits (null: none)."""
    costs, ranks, audits = [None] * 16, [None] * 16, [None] * 16
    for entry in entries:
        alive = Survivors(entry)
        for initial, faulty, cut, copies in rows:
            alive.step(row_ways(alive.states, initial, faulty, cut, copies))
        alive.emit()
        shared = "".join(alive.emitted)
        for state, (cost, rank, _) in alive.states.items():
            i = 4 * entry + state
            costs[i], ranks[i], audits[i] = cost, rank, shared + "".join(alive.edits(state))
    return costs, ranks, audits


def prepared(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, digest``; a null role or text is one space."""
    read = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    return rows.select(
        F.col(f"`{key}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        read.alias("text"),
        F.unhex(F.sha2(read, 256)).alias("digest"),
    )


ORDER = ["conv", "turn", "role", "digest"]
SEGMENTS = (
    "part long, turn long, role string, digest binary, costs array<long>, ranks array<long>, audits array<string>, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, turns long, nulls boolean"
)


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment: how it can be passed, its counts, and where its first row is.

    Works on narrow rows, equal ones counted once; texts are digests. Segments
    are numbered in order, so ``part`` sorts those of a conversation.
    """
    filled = rf"[^{SPACES}]"
    narrow = rows.select(
        *ORDER,
        (~F.col("text").rlike(filled)).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACES}]*\z")).alias("cut"),
    )
    narrow = narrow.groupBy(*ORDER, "blank", "cut").agg(F.count("*").alias("copies"))
    narrow = stored(narrow, "turns")
    # Where each text of a role is first said; nulls come first. Joined on unique keys, so no hot text meets in a task.
    earliest = narrow.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
    earliest = earliest.select(
        *[F.col(c).alias(f"e_{c}") for c in ("conv", "role", "digest")], F.col("at.turn").alias("e_turn")
    )
    same = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in ORDER]
    marked = narrow.join(earliest, same[0] & same[1] & same[2] & same[3], "left").select(
        *ORDER, "blank", "cut", "copies", F.col("e_role").isNull().alias("again"), F.substring("role", 1, 1).alias("initial")
    )
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        # Rows of one conversation lie together, so one that begins inside a partition is entered at its start.
        begins = False

        def closed() -> tuple:
            nonlocal number
            number += 1
            return (held[0][0], *segment(number, held, (START,) if begins else (START, SYSTEM, USER, ASSISTANT)))

        out = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (row[0] != held[0][0] or len(held) >= SEGMENT):
                    out.append(closed())
                    begins = row[0] != held[0][0]
                    held = []
                held.append(row)
            if out:
                yield as_batch(out, schema)
                out = []
        if held:
            yield as_batch([closed()], schema)

    kind = narrow.schema["conv"].dataType.simpleString()
    ddl = f"conv {kind}, {SEGMENTS}"
    schema = arrow_schema(ddl)
    ranged = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return stored(ranged.mapInArrow(run, ddl), "segments")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def segment(number: int, rows: list[tuple], entries: tuple[int, ...]) -> tuple:
    """The row of a segment, the conversation left out."""
    blank = duplicate = truncated = illegal = turns = 0
    nulls, low, high, before, last = False, None, None, None, None
    ways = []
    for _, turn, _, _, is_blank, cut, copies, again, initial in rows:
        blank += copies if is_blank else 0
        duplicate += 0 if is_blank else copies - 1 + again
        wrong = is_blank or again
        cut = cut and not wrong
        truncated += cut
        illegal += copies - 1 + (last is not None and last + initial not in LEGAL)
        last = initial
        if turn is None:
            nulls = True
        else:
            turns += before is None or turn != before
            low, high, before = turn if low is None else low, turn, turn
        ways.append((initial, wrong, cut, copies))
    first = rows[0]
    return (
        number, first[1], first[2], first[3], *searched(ways, entries),
        blank, duplicate, truncated, illegal, ways[0][0], last, low, high, turns, nulls,
    )


CHOICES = (
    "part long, pick int, tail string, cost long, gaps long, blank long, duplicate long, truncated long, illegal long"
)


def choices(parts: DataFrame) -> DataFrame:
    """Which of its ways each segment is passed by; a conversation's last one has the end's insertions and the totals."""
    kind = parts.schema["conv"].dataType.simpleString()
    schema = arrow_schema(f"conv {kind}, {CHOICES}")
    read = ["conv", "part", "costs", "ranks", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk: Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if talk is None or talk.name != row[0]:
                    out += talk.close() if talk else []
                    talk = Conversation(row[0])
                out += talk.add(row[1:])
            yield as_batch(out, schema)
        yield as_batch(talk.close() if talk else [], schema)

    ordered = parts.select(*read).repartition("conv").sortWithinPartitions("conv", "part")
    return ordered.mapInArrow(run, f"conv {kind}, {CHOICES}")


class Conversation:
    """The search over the segments of one conversation, and its totals."""

    def __init__(self, name) -> None:
        self.name = name
        self.alive = Survivors(START)
        self.sums = [0, 0, 0, 0]
        self.last = self.low = self.high = None
        self.turns = 0

    def add(self, row: tuple) -> list[tuple]:
        part, costs, ranks, *sums, first, last, low, high, turns = row
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        if self.last is not None:
            self.sums[3] += self.last + first not in LEGAL
        self.last = last
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high
        ways: dict[int, tuple] = {}
        for entry, (cost, rank, node) in self.alive.states.items():
            for state in range(4):
                i = 4 * entry + state
                if costs[i] is not None:
                    # The order of a segment's edits is that of their ranks, for one entry.
                    way = (cost + costs[i], rank, (ranks[i], part, i), node)
                    if state not in ways or way[:3] < ways[state][:3]:
                        ways[state] = way
        self.alive.step(ways)
        return self._emitted()

    def _emitted(self) -> list[tuple]:
        done = [(self.name, part, i, *[None] * 7) for _, part, i in self.alive.emitted]
        self.alive.emitted = []
        return done

    def close(self) -> list[tuple]:
        state, cost, tail = best_end(self.alive.states)
        done = self._emitted()
        # A survivor's own step is never emitted early, so the last segment is among these.
        done += [(self.name, part, i, *[None] * 7) for _, part, i in self.alive.edits(state)]
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        done[-1] = (*done[-1][:3], tail, cost, min(gaps, LONGEST), *self.sums)
        return done


class Repair:
    """The edits of all conversations, and what follows from them.

    ``rows`` needs a key, a turn, a role and a text. Rows of a conversation go
    by turn, nulls first, then by role and the hash of the text; repeated rows
    are duplicates of the first one. Null roles and texts are one space; a null
    key is a conversation of its own. Texts of any length are streamed, in
    batches of 16 MB. Gaps beyond a long are the largest long. Further columns are
    ignored. An empty table gives empty results.
    """

    def __init__(
        self, rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
    ) -> None:
        ship(rows.sparkSession)
        self.key = key
        self.rows = prepared(rows, key, turn, role, text)
        parts = segments(self.rows)
        picked = choices(parts)
        picked = picked.select(*[F.col(c).alias(f"p_{c}") for c in picked.columns])
        totals = ("cost", "gaps", "blank", "duplicate", "truncated", "illegal")
        way = F.expr("audits[p_pick]")
        self.pieces = stored(
            parts.join(picked, parts.conv.eqNullSafe(F.col("p_conv")) & (F.col("part") == F.col("p_part"))).select(
                *ORDER, F.concat(way, F.coalesce("p_tail", F.lit(""))).alias("audit"),
                *[F.col(f"p_{c}").alias(c) for c in totals],
            ),
            "edits",
        )

    def _streamed(self, others: DataFrame | None) -> DataFrame:
        """Edits and rows of each conversation in order, edits before the rows they are for."""
        edits = self.pieces.select(
            *ORDER, F.lit(1).alias("kind"), "audit", F.struct(*TOTALS).alias("totals"), F.lit(None).cast("string").alias("text")
        )
        texts = self.rows.select(
            *ORDER, F.lit(2).alias("kind"), F.lit(None).cast("string").alias("audit"),
            F.lit(None).cast(edits.schema["totals"].dataType).alias("totals"), "text",
        )
        both = edits.union(texts)
        if others is not None:
            nothing = [F.lit(None).cast(both.schema[c].dataType).alias(c) for c in both.columns]
            nothing[0], nothing[4] = F.col(f"`{self.key}`").alias("conv"), F.lit(0).alias("kind")
            both = both.union(others.select(f"`{self.key}`").distinct().select(*nothing))
        ordered = both.repartition("conv").sortWithinPartitions(*ORDER, "kind")
        return ordered.select("conv", "kind", "role", "text", "audit", *[F.col(f"totals.{c}").alias(c) for c in TOTALS])

    def conversations(self, everyone: DataFrame | None = None) -> DataFrame:
        """Per conversation: the key, ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

        ``everyone`` may name further conversations by the same key; they have no rows.
        """
        kind = self.rows.schema["conv"].dataType.simpleString()
        ddl = f"`{self.key}` {kind}, {', '.join(f'{c} long' for c in TOTALS)}, audit string, repaired_sha256 string"
        return self._streamed(everyone).mapInArrow(streamer(Report, arrow_schema(ddl)), ddl)

    def repaired(self) -> DataFrame:
        """The repaired rows: the key, ``position`` (from 0), ``role, text, edit``; inserted ones have an empty text."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        ddl = f"`{self.key}` {kind}, position long, role string, text string, edit string"
        return self._streamed(None).mapInArrow(streamer(Rows, arrow_schema(ddl)), ddl)


TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def streamer(collector: type, schema: pa.Schema):
    """Walks ordered edits and rows; ``collector`` makes the result rows of each conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            out: list[tuple] = []
            for part in slices(batch):
                for name, kind, role, text, audit, *totals in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if walk is None or walk.name != name:
                        out += walk.close() if walk else []
                        walk = collector(name)
                    if kind == 1:
                        walk.edits(audit, totals)
                    elif kind == 2:
                        walk.row(role, text)
                    out += walk.ready()
                yield as_batch(out, schema)
                out = []
        yield as_batch(walk.close() if walk else [], schema)

    return run


class Walk:
    """Applies edits to the rows of one conversation, one after the other."""

    def __init__(self, name) -> None:
        self.name, self.audit, self.place, self.state = name, "", 0, START

    def edits(self, audit: str, totals: list) -> None:
        self.audit, self.place = audit, 0

    def _insert(self) -> None:
        while self.audit[self.place : self.place + 1] == "I":
            self.place += 1
            self._put("I", None, "")

    def _put(self, edit: str, role: str | None, text: str) -> None:
        initial = role[:1] if edit == "K" else ""
        self.state = SYSTEM if initial == "s" else ASSISTANT if self.state == USER else USER
        self.say(edit, role if edit == "K" else ROLES[self.state], text)

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.place]
        self.place += 1
        if edit != "D":
            self._put(edit, role, text)
        # Insertions come before a row's edit, so what is left at the end of all edits is the conversation's end.
        if self.place + 2 >= len(self.audit) and set(self.audit[self.place :]) <= {"I"}:
            self._insert()

    def say(self, edit: str, role: str, text: str) -> None:
        raise NotImplementedError

    def ready(self) -> list[tuple]:
        return []

    def close(self) -> list[tuple]:
        return []


class Report(Walk):
    def __init__(self, name) -> None:
        super().__init__(name)
        self.hash, self.all, self.totals, self.said = hashlib.sha256(), [], [0] * len(TOTALS), False

    def edits(self, audit: str, totals: list) -> None:
        super().edits(audit, totals)
        self.all.append(audit)
        if totals[0] is not None:
            self.totals = totals

    def say(self, edit: str, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.said else ''}{role}:{text}".encode())
        self.said = True

    def close(self) -> list[tuple]:
        return [(self.name, *self.totals, "".join(self.all), self.hash.hexdigest())]


class Rows(Walk):
    def __init__(self, name) -> None:
        super().__init__(name)
        self.out, self.count = [], 0

    def say(self, edit: str, role: str, text: str) -> None:
        self.out.append((self.name, self.count, role, text, edit))
        self.count += 1

    def ready(self) -> list[tuple]:
        done, self.out = self.out, []
        return done

    def close(self) -> list[tuple]:
        return self.ready()


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with made-up faults, the same ones in every run: some dropped, emptied, without ends, repeated or given to the user.

    Nulls are one space. Only the four named columns come back.
    """
    names = {c: F.col(f"`{c}`") for c in (key, turn, role, text)}
    read = {c: F.coalesce(v.cast("string"), F.lit(" ")) for c, v in names.items()}
    kind = F.crc32(F.concat(read[key], F.lit(":"), read[turn])) % 20
    made = (
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(read[text], "[.!?]", "")).otherwise(read[text])
    )
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.filter(kind != 0).select(
        names[key].alias(key), names[turn].alias(turn),
        F.when(kind == 4, "user").otherwise(read[role]).alias(role), made.alias(text), F.explode(copies).alias("_copy"),
    ).select(*[F.col(f"`{c}`") for c in (key, turn, role, text)])


#: The damage and its repair in DuckDB: the checksum bit by bit, the search row by row over at most four survivors.
SQL = r"""
with recursive named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
    from conversations),
bits as (
    select *, list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(name) + 1),
        lambda i: [ord(substr(name, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))) as b from named),
summed as (
    select *, xor(4294967295::bigint, list_reduce(b, lambda c, v:
        xor(xor(c, v) >> 1, 3988292384::bigint * (xor(c, v) & 1)))) % 20 as kind from bits),
made as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(case when kind = 3 then [1, 2] else [1] end) as copy
    from summed where kind <> 0),
placed as (
    select conv_id, turn, role, text, row_number() over (
        partition by conv_id order by turn nulls first, role, sha256(text)) as pos from made),
faulty as (
    select *, substr(role, 1, 1) as initial, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
           row_number() over (partition by conv_id, role, text order by pos) > 1 as again,
           not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as cut,
           lag(substr(role, 1, 1)) over (partition by conv_id order by pos) as before from placed),
totals as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count_if(blank) as blank, count_if(again and not blank) as duplicate,
           count_if(cut and not again and not blank) as truncated,
           count_if(before is not null and before || initial not in ('su', 'ua', 'au')) as illegal, max(pos) as n
    from faulty group by conv_id),
mids(src, mid, chain, said) as (values
    ('', '', '', []::varchar[]), ('', 'u', 'I', ['user:']), ('', 'a', 'II', ['user:', 'assistant:']),
    ('s', 's', '', []), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
    ('u', 'u', '', []), ('u', 'a', 'I', ['assistant:']), ('a', 'a', '', []), ('a', 'u', 'I', ['user:'])),
moves(mid, next, goes) as (values
    ('', '', true), ('s', 's', true), ('u', 'u', true), ('a', 'a', true),
    ('', 's', false), ('', 'u', false), ('s', 'u', false), ('a', 'u', false), ('u', 'a', false)),
ways as (
    select conv_id, 0::bigint as i, '' as state, 0::bigint as cost, '' as audit, []::varchar[] as said from totals
    union all
    select conv_id, i, state, min(cost), min_by(audit, (cost, audit)), min_by(said, (cost, audit)) from (
        select w.conv_id, w.i + 1 as i, m.next as state,
               w.cost + 3 * length(d.chain) + case when m.goes then 4 else
                   case when f.initial = m.next then 0 else 3 end + case when f.cut then 3 else 0 end end as cost,
               w.audit || d.chain || case when m.goes then 'D' when f.initial = m.next then 'K' else 'R' end as audit,
               list_concat(list_concat(w.said, d.said), case when m.goes then [] else
                   [case when f.initial = m.next then f.role when m.next = 'u' then 'user' else 'assistant' end
                    || ':' || f.text] end) as said
        from ways w join faulty f on f.conv_id is not distinct from w.conv_id and f.pos = w.i + 1
        join mids d on d.src = w.state join moves m on m.mid = d.mid
        where m.goes or not (f.blank or f.again or (m.next = 's' and f.initial <> 's'))) tried
    group by conv_id, i, state),
ends(state, tail, said) as (values
    ('', '', []::varchar[]), ('a', '', []), ('u', 'I', ['assistant:']), ('s', 'II', ['user:', 'assistant:'])),
best as (
    select conv_id, min(cost) as cost, min_by(audit, (cost, audit)) as audit, min_by(said, (cost, audit)) as said from (
        select w.conv_id, w.cost + 3 * length(e.tail) as cost, w.audit || e.tail as audit,
               list_concat(w.said, e.said) as said
        from ways w join totals t on t.conv_id is not distinct from w.conv_id and t.n = w.i
        join ends e on e.state = w.state) ended
    group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
       sha256(coalesce(array_to_string(said, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join totals t on t.conv_id is not distinct from c.conv_id
left join best b on b.conv_id is not distinct from c.conv_id
"""
