"""Conversation structure repair by generalised LR parsing.

The roles of a conversation should follow a grammar: perhaps a system turn,
then user and assistant in turn. The parser reads the turns in order and tries
every edit of each: keep, rerole, delete, and insertions before it. Its stacks
form one graph: equal stacks are one node, whichever edits led there. Equal
stack tops are merged by the least (cost, audit), so that only few tops are
alive at any turn, however long the conversation.

A conversation is streamed through one task, because the digest of its
repaired turns must see them in order: rows are sorted on disk and pass in
Arrow batches, and the task holds the live tops and their audits, never the
turns. So one very long conversation costs time in its task, not memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shipcast.llm.common import SPACE

#: Role initials: perhaps s, then u and a in turn; or no turn at all.
GRAMMAR = (("S", ()), ("S", ("T",)), ("S", ("s", "T")), ("T", ("P",)), ("T", ("T", "P")), ("P", ("u", "a")))
#: Roles that a turn may be given, by initial.
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: A top that costs more than this above the cheapest one cannot win: from any
#: top, two inserted turns, or one and a deletion, allow what any other allows.
SLACK = 2 * INSERT
END = "$"
#: Characters of an audit that are copied from turn to turn.
TAIL = 4096


def tables(grammar=GRAMMAR) -> tuple[list[dict], list[dict]]:
    """SLR actions (lists, as the parser is a generalised one) and gotos."""
    rules = [("", (grammar[0][0],)), *grammar]
    names = {left for left, _ in rules}
    empty, first, follow = set(), {n: set() for n in names}, {n: set() for n in names}
    follow[""].add(END)
    size = -1
    while size != (size := sum(map(len, (*first.values(), *follow.values(), empty)))):
        for left, right in rules:
            if all(x in empty for x in right):
                empty.add(left)
            for x in right:
                first[left] |= first.get(x, {x})
                if x not in empty:
                    break
            after = set(follow[left])
            for x in reversed(right):
                if x in names:
                    follow[x] |= after
                after = (after if x in empty else set()) | first.get(x, {x})

    def closed(items: set) -> frozenset:
        todo, items = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            for k, (left, _) in enumerate(rules):
                if dot < len(rules[rule][1]) and left == rules[rule][1][dot] and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    states, action, goto = [closed({(0, 0)})], [], []
    for state in states:
        action.append({})
        goto.append({})
        moved: dict[str, set] = {}
        for rule, dot in sorted(state):
            left, right = rules[rule]
            if dot < len(right):
                moved.setdefault(right[dot], set()).add((rule, dot + 1))
            else:
                for x in follow[left]:
                    action[-1].setdefault(x, []).append(("reduce", left, len(right)) if rule else ("accept",))
        for x, items in moved.items():
            new = closed(items)
            if new not in states:
                states.append(new)
            if x in names:
                goto[-1][x] = states.index(new)
            else:
                action[-1].setdefault(x, []).append(("shift", states.index(new)))
    return action, goto


class Stacks:
    """The graph-structured stack: a node is a state on top of a node below."""

    def __init__(self, grammar=GRAMMAR):
        self.action, self.goto = tables(grammar)
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.places = {(0, -1): 0}
        self.known: dict[tuple, tuple] = {}

    def _push(self, state: int, below: int) -> int:
        if (state, below) not in self.places:
            self.places[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.places[state, below]

    def after(self, node: int, token: str) -> tuple[int, ...]:
        """The nodes after all reductions and the shift of ``token``; for the
        end token, the node itself if the parse may end there."""
        if (node, token) not in self.known:
            out, todo, seen = [], [node], {node}
            while todo:
                top = todo.pop()
                for act in self.action[self.nodes[top][0]].get(token, ()):
                    if act[0] == "shift":
                        out.append(self._push(act[1], top))
                    elif act[0] == "accept":
                        out.append(node)
                    else:
                        low = top
                        for _ in range(act[2]):
                            low = self.nodes[low][1]
                        new = self._push(self.goto[self.nodes[low][0]][act[1]], low)
                        if new not in seen:
                            seen.add(new)
                            todo.append(new)
            self.known[node, token] = tuple(dict.fromkeys(out))
        return self.known[node, token]

    def with_inserts(self, node: int) -> dict[int, str]:
        """Nodes reached by inserting turns, with the initials inserted."""
        out, todo = {node: ""}, [node]
        while todo:
            now, todo = todo, []
            for top in now:
                for x in ROLES:
                    for new in self.after(top, x):
                        if new not in out and INSERT * (len(out[top]) + 1) <= SLACK:
                            out[new] = out[top] + x
                            todo.append(new)
        return out


def step(stacks: Stacks, tops: tuple, initial: str, fault: int) -> tuple:
    """What one turn makes of the live tops ((node, cost), in the order of
    their audits): (place of the parent, inserted initials, edit, new initial,
    node, cost) of the new tops, again in the order of their audits.

    Two audits of the same number of turns never begin with each other, so
    parents order their children and only children of one parent compare
    their own edits."""
    best: dict[int, tuple] = {}
    for k, (node, cost) in enumerate(tops):
        for mid, put in stacks.with_inserts(node).items():
            paid = cost + INSERT * len(put)
            edits = [("D", "", mid, paid + DELETE)]
            if fault not in (BLANK, DUPLICATE):
                paid += TRUNCATED if fault == CUT else 0
                edits += [("K", initial, new, paid + KEEP) for new in (stacks.after(mid, initial) if initial != END else ())]
                edits += [("R", x, new, paid + REROLE) for x in ROLES if x != initial for new in stacks.after(mid, x)]
            for edit, role, new, total in edits:
                mine = (total, k, "I" * len(put) + edit, put, role)
                if new not in best or mine[:3] < best[new][:3]:
                    best[new] = mine
    least = min(total for total, *_ in best.values())
    return tuple((k, put, audit[-1], role, new, total) for new, (total, k, audit, put, role) in sorted(best.items(), key=lambda x: x[1][1:3]) if total <= least + SLACK)


def finish(stacks: Stacks, tops: tuple) -> tuple:
    """(place of the top that wins, inserted initials, cost)."""
    ends = [(cost + INSERT * len(put), k, put) for k, (node, cost) in enumerate(tops) for end, put in stacks.with_inserts(node).items() if stacks.after(end, END)]
    cost, k, put = min(ends)
    return k, put, cost


NONE, BLANK, DUPLICATE, CUT = range(4)


@dataclass
class Top:
    """A live stack top: what its cheapest edits have written so far."""

    sha: object = field(default_factory=hashlib.sha256)
    wrote: bool = False
    chain: tuple | None = None
    tail: str = ""

    def child(self, last: bool) -> Top:
        return Top(self.sha if last else self.sha.copy(), self.wrote, self.chain, self.tail)

    def put(self, edit: str, line: str | None) -> None:
        if line is not None:
            self.sha.update(("\n" + line if self.wrote else line).encode("utf-8", "surrogatepass"))
            self.wrote = True
        if len(self.tail) >= TAIL:
            self.chain, self.tail = (self.chain, self.tail), ""
        self.tail += edit

    def audit(self) -> str:
        parts, chain = [self.tail], self.chain
        while chain:
            chain, part = chain
            parts.append(part)
        return "".join(reversed(parts))


class Conversation:
    """The parse of one conversation, turn by turn."""

    def __init__(self, stacks: Stacks, memo: dict):
        self.stacks, self.memo = stacks, memo
        self.state, self.tops, self.base = ((0, 0),), [Top()], 0
        self.faults, self.illegal, self.last_initial = [0, 0, 0, 0], 0, None
        self.turns, self.low, self.high = 0, None, None

    def read(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last_initial = initial
        if turn is not None and turn != self.high:  # turns come in order
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        key = (self.state, initial if initial in "sua" else "?", fault)
        if key not in self.memo:
            self.memo[key] = step(self.stacks, self.state, key[1], fault)
        made = self.memo[key]
        uses = {k: n for n, (k, *_) in enumerate(made)}
        tops = []
        for n, (k, put, edit, new, _, _) in enumerate(made):
            top = self.tops[k].child(uses[k] == n)
            for x in put:
                top.put("I", f"{ROLES[x]}:")
            top.put(edit, None if edit == "D" else f"{role if edit == 'K' else ROLES[new]}:{text}")
            tops.append(top)
        least = min(total for *_, total in made)
        self.base += least
        self.state, self.tops = tuple((node, total - least) for *_, node, total in made), tops

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
        k, put, cost = finish(self.stacks, self.state)
        top = self.tops[k]
        for x in put:
            top.put("I", f"{ROLES[x]}:")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, *self.faults[1:], self.illegal, self.base + cost, top.audit(), top.sha.hexdigest()


def _rows(conversations: DataFrame, present: Column) -> DataFrame:
    """The rows by conversation, in order, each with its first fault."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), F.when(present, text).alias("text"), present.alias("present")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "present", "role", F.sha1("text")).orderBy(F.col("turn").asc_nulls_first())) > 1
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (F.when(bare == "", BLANK).when(F.col("seen"), DUPLICATE).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT).otherwise(NONE))
    return (rows.withColumn("seen", seen).withColumn("fault", F.when(F.col("present"), fault).otherwise(NONE))
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen"))


def repaired(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """One row for each conv_id: gaps, blank, duplicate, truncated, illegal,
    cost, audit and repaired_sha256 of its cheapest repair.

    ``conversations`` has conv_id, turn, role and text; other columns are not
    read. Rows where ``present`` is false are not part of the conversation and
    only name it. Null roles and texts count as one space; a null conv_id is a
    conversation of its own. Turns are taken in order, nulls first; rows of one
    turn by role, then text, and of equal rows the first is no duplicate. A
    role that begins with other than s, u or a (the empty one too) fits no
    place and is given another role or deleted. An empty table gives no rows;
    long texts are hashed as they pass."""
    schema = T.StructType([conversations.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        stacks, memo, own, out = Stacks(), {}, None, []
        name = None
        for batch in batches:
            for conv, turn, role, text, there, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or conv != name:
                    if own is not None:
                        out.append((name, *own.result()))
                    own, name = Conversation(stacks, memo), conv
                if there:
                    own.read(turn, role, text, fault)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)
                out = []
        if own is not None:
            out.append((name, *own.result()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    rows = _rows(conversations, F.lit(True) if present is None else present)
    return rows.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(parse, schema)


def repaired_turns(conversations: DataFrame, repairs: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role,
    text and edit (K, R or I) of every turn left or inserted. ``repairs`` is
    what ``repaired`` says of the same rows."""
    turn = conversations.schema["turn"].dataType
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("place", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("role", "text", "edit"))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        audit, at, place, want, name = "", 0, 0, "u", None
        for batch in batches:
            out = []
            for conv, first, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "first", "role", "text"))):
                if first:
                    audit, at, place, want, name = text, 0, 0, "u", conv
                while at < len(audit):
                    edit = audit[at]
                    if first and edit != "I" or edit != "I" and role is None:
                        break
                    at += 1
                    if edit != "D":
                        new = role if edit == "K" else ROLES[want]
                        out.append((conv, place, new, "" if edit == "I" else text, edit))
                        place, want = place + 1, "a" if new[0] == "u" else "u"
                    if edit != "I":
                        role = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    rows = _rows(conversations, F.lit(True) if present is None else present).where("present").select("conv_id", "turn", "role", "text", "seen", F.lit(False).alias("first"))
    heads = repairs.select("conv_id", F.lit(None).cast(turn).alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), F.lit(False).alias("seen"), F.lit(True).alias("first"))
    both = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("first"), F.col("turn").asc_nulls_first(), "role", "text", "seen")
    return both.mapInArrow(apply, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage of the task, by crc32 of ``conv_id:turn``
    modulo 20: 0 drops the row (``present`` false), 1 empties its text, 2
    takes ``.!?`` out of it, 3 repeats the row, 4 makes it the user's."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                                (F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20).alias("_k"))
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("_k") != 0).alias("present"), copies.alias("_copy")).drop("_copy")
