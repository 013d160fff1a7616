"""Conversation repair by survivor-coalescence Viterbi decoding.

A conversation's rows, in turn order, are edited at the least cost so that the initials of
its roles read ``(s?(ua)+)?``: an optional system row, then user and assistant in turn.
Edits are Keep, Rerole, Delete and Insert; of equally cheap edit strings the ASCII-least one
is taken.

One pass over the rows, which needs no texts, keeps at most one survivor per state of that
pattern: its cost, its place in the order of the survivors' edit strings, and its leaf in a
backpointer tree. A node of the tree holds the edits since its parent and counts its
children; a node whose last child but one dies takes in the one that is left. So the root
holds exactly what all survivors share, and it is emitted at once: memory is bounded by the
edits on which the survivors still differ. Survivors that can no longer win or tie are dropped. All survivors have taken the same rows and end
with an edit of a row, so none of their strings is a prefix of another, and a tie is decided
by the whole unresolved strings: their order is carried along as ranks.

A second pass over the rows with their texts applies the edits while they stream by.

Scale: rows are dealt by conversation and sorted by Spark (with spilling); a task holds the
unresolved edits and the emitted edit string of one conversation, never its rows or texts.
Repeated rows are found beforehand by map-side combined counts of narrow keys, and marked in
the stream by rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import group_key, small_batches, stage

# The states of the role pattern, and the prices of the edits.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
_FAULTS = ("fine", "truncated", "gone")  # gone: blank or duplicate, must be deleted
_INSERTS = {START: ((USER, 1), (ASSISTANT, 2)), SYSTEM: ((USER, 1), (ASSISTANT, 2)),
            USER: ((ASSISTANT, 1),), ASSISTANT: ((USER, 1),)}
_END = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that complete the pattern
# What it costs at most to go on from the first state as one would from the second: inserting up
# to it, deleting a system row that it could not keep, or completing the pattern at the end.
_STAND_IN = {(ASSISTANT, SYSTEM): 0, (ASSISTANT, START): DELETE, (ASSISTANT, USER): INSERT,
             (USER, ASSISTANT): INSERT, (USER, SYSTEM): INSERT, (USER, START): INSERT + DELETE,
             (START, SYSTEM): 0, (START, ASSISTANT): 0, (START, USER): INSERT}
_GHOST, _MARK, _ROW = 0, 1, 2


def _next(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _moves(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """For each state after a row: (state before, price, edits) of every way to it.

    Going in a circle by inserts is never cheapest and is left out.
    """
    out = [[] for _ in range(4)]
    extra = TRUNCATED if fault == "truncated" else 0
    for before in range(4):
        for at, inserts in ((before, 0), *_INSERTS[before]):
            price, edits = INSERT * inserts, "I" * inserts
            out[at].append((before, price + DELETE, edits + "D"))
            if fault == "gone":
                continue
            kept = _next(at, initial)
            if kept is not None:
                out[kept].append((before, price + extra, edits + "K"))
            out[ASSISTANT if at == USER else USER].append((before, price + extra + REROLE, edits + "R"))
    return out


_MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in _FAULTS}


class _Node:
    """Edits since the parent; ``children`` is empty at a survivor's leaf."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent, edits: str):
        self.parent, self.edits, self.children = parent, bytearray(edits, "ascii"), []


class Survivors:
    """The cheapest, then ASCII-least edits to each state, as rows come in one by one."""

    def __init__(self):
        self.root = _Node(None, "")
        self.cost = [0, None, None, None]
        self.rank = [0, 0, 0, 0]
        self.leaf = [self.root, None, None, None]

    def _drop(self, dead: list[_Node]) -> None:
        """Takes dead leaves out of the tree."""
        thinned = []
        for node in dead:
            while not node.children and node.parent is not None:
                node, gone = node.parent, node
                node.children.remove(gone)
            thinned.append(node)
        for node in thinned:
            while len(node.children) == 1:  # the one that is left continues its parent
                child = node.children[0]
                node.edits += child.edits
                node.children, child.children = child.children, []
                for c in node.children:
                    c.parent = node
                self.leaf = [node if x is child else x for x in self.leaf]

    def take(self, initial: str, fault: str) -> bytes:
        """Edits of one row; returns those that all survivors now share."""
        won = []
        for state, ways in enumerate(_MOVES[initial, fault]):
            best = None
            for before, price, edits in ways:
                if self.cost[before] is not None:
                    way = (self.cost[before] + price, self.rank[before], edits, before)
                    if best is None or way < best:
                        best = way
            if best is not None:
                won.append((best, state))
        price = {state: best[0] for best, state in won}
        # a survivor that another one beats whatever comes, ties excluded, is dropped
        won = [(best, state) for best, state in won if not any(
            other in price and price[other] + d < best[0] for (other, s), d in _STAND_IN.items() if s == state)]
        heirs = [0, 0, 0, 0]
        for (_, _, _, before), _ in won:
            heirs[before] += 1
        old, cost, rank, leaf = self.leaf, [None] * 4, [0] * 4, [None] * 4
        for place, ((price, _, edits, before), state) in enumerate(sorted(won, key=lambda w: w[0][1:])):
            node = old[before]
            if heirs[before] == 1:
                node.edits += edits.encode()
            else:
                node.children.append(_Node(node, edits))
                node = node.children[-1]
            cost[state], rank[state], leaf[state] = price, place, node
        dead = [x for x, n in zip(old, heirs) if x is not None and not n]
        self.cost, self.rank, self.leaf = cost, rank, leaf
        self._drop(dead)
        out, self.root.edits = bytes(self.root.edits), bytearray()
        return out

    def unresolved(self) -> int:
        """Edits held in the tree."""
        todo, n = [self.root], 0
        while todo:
            node = todo.pop()
            n += len(node.edits)
            todo += node.children
        return n

    def finish(self) -> tuple[int, bytes]:
        """Cost, and the edits after those returned so far."""
        cost, _, edits, state = min(
            (self.cost[s] + INSERT * n, self.rank[s], "I" * n, s)
            for s, n in _END.items() if self.cost[s] is not None)
        parts, node = [edits.encode()], self.leaf[state]
        while node is not None:
            parts.append(bytes(node.edits))
            node = node.parent
        return cost, b"".join(reversed(parts))


def _groups(batches, columns: list[str]) -> Iterator[tuple]:
    """(first row of the conversation or not, row) over all batches; rows as tuples."""
    last = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            yield row[0] != last, row
            last = row[0]


_LABELS = ["c", "kind", "turn", "digest", "initial", "blank", "open"]
_FOUND = ("c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Conversation:
    """Counts and survivors of the conversation that streams by."""

    def __init__(self, name: str):
        self.name, self.survivors, self.audit = name, Survivors(), []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.initial = 0, None
        self.first = self.last = None
        self.turns = 0
        self.mark = self.key = None

    def add(self, kind: int, turn, digest: bytes, initial: str, blank: bool, open_: bool) -> None:
        if kind == _MARK:
            self.mark = (turn, digest)
        if kind != _ROW:
            return
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.first = turn if self.turns == 0 else self.first
            self.last, self.turns = turn, self.turns + 1
        repeated = self.mark == (turn, digest) or self.key == (turn, digest)
        self.key = (turn, digest)
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if open_ else None
        if fault:
            self.counts[fault] += 1
        kind_of = "gone" if fault in ("blank", "duplicate") else fault or "fine"
        self.audit.append(self.survivors.take(initial if initial in ("s", "u", "a") else "", kind_of))

    def row(self) -> tuple:
        cost, rest = self.survivors.finish()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.name, gaps, *self.counts.values(), self.illegal, cost,
                b"".join((*self.audit, rest)).decode("ascii"))


def _decode(batches):
    names = [f.split()[0] for f in _FOUND.split(", ")]
    types = [pa.string(), *[pa.int64()] * 6, pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    now, done, size = None, [], 0
    for first, row in _groups(batches, _LABELS):
        if first:
            if now is not None:
                done.append(now.row())
                size += len(done[-1][-1]) + 100
                if size > 1 << 20:
                    yield batch(done)
                    done, size = [], 0
            now = _Conversation(row[0])
        now.add(*row[1:])
    if now is not None:
        yield batch([*done, now.row()])


def _stream(parts: list[DataFrame]) -> DataFrame:
    """Conversations one after the other in each task: announced, then their rows in order."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.repartition("c").sortWithinPartitions("c", "turn", "digest", "kind")


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    who, body = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(" ")) for x in (role, text))
    return rows.select(
        group_key(F.col(f"`{conv}`")).alias("c"), F.lit(_ROW).alias("kind"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, body).cast("binary"))).alias("digest"),
        F.substring(who, 1, 1).alias("initial"), (~body.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~body.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"), who.alias("role"), body.alias("text"))


def _repeats(rows: DataFrame) -> DataFrame:
    """Marks: (c, turn, digest) of rows whose role and text an earlier turn of the conversation has."""
    at = F.struct("turn")  # compares NULL as the least
    keys = rows.select("c", "turn", "digest")
    first = (keys.groupBy("c", "digest").agg(F.min(at).alias("first"), F.max(at).alias("last"))
             .filter("first < last").select("c", "digest", "first"))
    return (keys.join(first, ["c", "digest"]).filter(at > F.col("first"))
            .select("c", "turn", "digest", F.lit(_MARK).alias("kind")).distinct())


def _ids(conversations: DataFrame, conv: str) -> DataFrame:
    return (conversations.select(F.col(f"`{conv}`").alias("conv_id")).distinct()
            .select("conv_id", group_key(F.col("conv_id")).alias("c")))


def repair_report(rows: DataFrame, conversations: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows`` and ``conversations``: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and the edit string ``audit``. Staged.

    * a NULL role or text is one space; NULL turns come first. Rows of equal turn are ordered by
      a digest of role and text; rows equal in all are duplicates of the first one.
    * a conversation without rows has zeros and no edits; a NULL conv_id is one like any other.
    * whole texts are looked at; an empty table gives an empty result. Other columns of ``rows``,
      whatever their names, are ignored.
    """
    ids = _ids(rows if conversations is None else conversations, conv)
    labels = _rows(rows, conv, turn, role, text).drop("role", "text")
    ghosts = ids.select("c", F.lit(_GHOST).alias("kind"))
    found = _stream([labels, _repeats(labels), ghosts]).select(*_LABELS).mapInArrow(_decode, _FOUND)
    return stage(ids.join(found, "c"))


_TEXTS = ["c", "kind", "turn", "role", "text", "audit"]


def _edited(batches) -> Iterator[tuple]:
    """(conversation, first row of it or not, edit, turn, role, text) of every edit, in order.

    A conversation's edit string comes with the row that announces it; a last, empty edit
    closes each conversation.
    """
    name = None

    def step(state: int) -> int:
        return ASSISTANT if state == USER else USER

    def inserted(state: int, at: int) -> Iterator[tuple]:
        while at < len(audit) and audit[at] == "I":
            state, at = step(state), at + 1
            yield state, at

    for first, (c, kind, turn, role, text, edits) in _groups(batches, _TEXTS):
        if first:
            if name is not None:
                for state, at in inserted(state, at):
                    yield name, "I", None, NAMES[state], ""
                yield name, "", None, None, None
            name, audit, at, state = c, edits, 0, START
        if kind != _ROW:
            continue
        for state, at in inserted(state, at):
            yield name, "I", None, NAMES[state], ""
        edit, at = audit[at], at + 1
        if edit == "D":
            yield name, "D", turn, None, None
        elif edit == "R":
            state = step(state)
            yield name, "R", turn, NAMES[state], text
        else:
            state = _next(state, role[:1])
            yield name, "K", turn, role, text
    if name is not None:
        for state, at in inserted(state, at):
            yield name, "I", None, NAMES[state], ""
        yield name, "", None, None, None


_EDITED = "c string, place long, edit string, turn long, role string, text string"


def _edited_rows(batches):
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [f.split()[0] for f in _EDITED.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    place, rows, size = 0, [], 0
    for name, edit, turn, role, text in _edited(batches):
        if not edit:
            place = 0
            continue
        rows.append((name, place, edit, turn, role, text))
        place, size = place + 1, size + len(text or "") + 50
        if size > 1 << 22:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def _text_digests(batches):
    names, sums = [], []
    h, some = hashlib.sha256(), False
    for name, edit, _, role, text in _edited(batches):
        if not edit:
            names.append(name)
            sums.append(h.hexdigest())
            h, some = hashlib.sha256(), False
        elif edit != "D":
            h.update((f"\n{role}:" if some else f"{role}:").encode())
            h.update(text.encode())
            some = True
        if len(names) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums)], names=["c", "sha"])
            names, sums = [], []
    if names:
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums)], names=["c", "sha"])


def _with_edits(rows: DataFrame, report: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    texts = _rows(rows, conv, turn, role, text)
    # a row that is deleted for being blank needs no text
    texts = texts.withColumn("text", F.when(F.col("blank"), F.lit("")).otherwise(F.col("text")))
    audits = report.select(group_key(F.col("conv_id")).alias("c"), F.lit(_GHOST).alias("kind"), "audit")
    return _stream([texts.select("c", "kind", "turn", "digest", "role", "text"), audits]).select(*_TEXTS)


def repaired_rows(rows: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """The edits of ``report`` (of the same ``rows``) applied: one row per edit with conv_id, its
    ``place``, ``edit`` (K, R, I or D), ``turn``, and the ``role`` and ``text`` that result (NULL if deleted)."""
    ids = report.select("conv_id", group_key(F.col("conv_id")).alias("c"))
    done = _with_edits(rows, report, conv, turn, role, text).mapInArrow(_edited_rows, _EDITED)
    return ids.join(done, "c").drop("c")


def repaired_digests(rows: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                     text: str = "text") -> DataFrame:
    """``report`` plus ``repaired_sha256``: of the repaired rows as ``role:text``, joined by newlines. Staged."""
    with small_batches(rows.sparkSession):
        sums = stage(_with_edits(rows, report, conv, turn, role, text).mapInArrow(_text_digests, "c string, sha string"))
    keyed = report.withColumn("c", group_key(F.col("conv_id")))
    return keyed.join(sums.withColumnRenamed("sha", "repaired_sha256"), "c").drop("c")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The test damage, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's. NULLs count as one space."""
    who, body, c, t = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(" ")) for x in (role, text, conv, turn))
    code = F.pmod(F.crc32(F.concat(c, F.lit(":"), t).cast("binary")), F.lit(20))
    out = rows.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), who.alias("role"),
                      body.alias("text"), code.alias("code")).filter("code <> 0")
    out = (out.withColumn("text", F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
                          .otherwise(F.col("text")))
           .withColumn("role", F.when(F.col("code") == 4, "user").otherwise(F.col("role")))
           .withColumn("copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))))
    return out.select("conv_id", "turn", "role", "text")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The damaged table repaired: one row per conversation of ``conversations``."""
    rows = damaged(conversations)
    return repaired_digests(rows, repair_report(rows, conversations))
