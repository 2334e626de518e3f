"""Repair of conversation structure: cheapest edits to alternating turns by Hirschberg's divide and conquer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import store

# Fixed costs of the edits; a kept or changed turn that is cut off costs one more.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
WHITE_SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60

#: Role initials; any other role is of the fourth class.
INITIALS = "sua"
#: What is at fault with a turn, as the code has it: nothing, cut off, to be deleted.
FINE, TRUNCATED, BAD = 0, 1, 2

# States of the roles written so far: nothing, a system turn, ends with user, ends with assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or changed turn leads; there is one way on from each state.
_ON = (USER, USER, ASSISTANT, USER)
#: Inserts that end a conversation in each state: none or whole pairs of user and assistant turns.
_TAIL = (0, 2, 1, 0)
END_COSTS = tuple(INSERT * n for n in _TAIL)
LEGAL = {(0, 1), (1, 2), (2, 1)}
SALTS = 16


def code(initial: int, fault: int) -> int:
    """A turn as the edits see it, as a byte."""
    return initial * 3 + fault


def _steps(initial: int, fault: int) -> list[list[tuple[int, str]]]:
    """The cheapest way over one turn from each state to each state: cost and edits, the ASCII-least of equal ones."""
    ways = [[(NEVER, "")] * 4 for _ in range(4)]
    keeps = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
    for begin in range(4):
        state = begin
        for inserts in range(3):  # two lead everywhere
            options = [(state, DELETE, "D")]
            if fault != BAD:
                options.append((_ON[state], REROLE + CUT_OFF * fault, "R"))
                if (state, initial) in keeps:
                    options.append((keeps[state, initial], CUT_OFF * fault, "K"))
            for end, cost, letter in options:
                ways[begin][end] = min(ways[begin][end], (INSERT * inserts + cost, "I" * inserts + letter))
            state = _ON[state]
    return ways


STEPS = [_steps(initial, fault) for initial in range(4) for fault in range(3)]
#: For every code and state the states it leads to, with costs; and the same backwards.
_FORWARD = [[[(q, c) for q, (c, _) in enumerate(ways) if c < NEVER] for ways in step] for step in STEPS]


def forward(codes: bytes, lo: int, hi: int, costs: list[int]) -> list[int]:
    """Least costs of each state after the turns ``lo`` to ``hi``, from those before."""
    for k in range(lo, hi):
        step, after = _FORWARD[codes[k]], [NEVER] * 4
        for p in range(4):
            if costs[p] < NEVER:
                for q, c in step[p]:
                    if costs[p] + c < after[q]:
                        after[q] = costs[p] + c
        costs = after
    return costs


def backward(codes: bytes, lo: int, hi: int, costs: list[int]) -> list[int]:
    """Least costs from each state before the turns ``lo`` to ``hi``, given those after."""
    for k in range(hi - 1, lo - 1, -1):
        step = _FORWARD[codes[k]]
        costs = [min([costs[q] + c for q, c in step[p] if costs[q] < NEVER], default=NEVER) for p in range(4)]
    return costs


def crossing(codes: bytes, lo: int, hi: int, begin: int, after: list[int], edits: list[str]) -> int:
    """Appends the audit-least of the cheapest edits of turns ``lo`` to ``hi`` and returns the state they end in.

    ``after`` are the costs of what follows, by state. The forward costs of the
    first half and the backward costs of the second meet in the middle; the states
    of least sum there are the optimal crossings. The first half is then solved with
    the backward costs of these crossings alone: edits of a half end with the letter
    of its last turn, so none is the beginning of another, and the least edits of
    the first half belong to the least edits of all. Two cost vectors per level of
    the recursion are held, not one per turn.
    """
    if hi - lo == 1:
        ways = STEPS[codes[lo]][begin]
        _, letters, end = min((c + after[q], letters, q) for q, (c, letters) in enumerate(ways) if letters)
        edits.append(letters)
        return end
    mid = (lo + hi) // 2
    ahead = forward(codes, lo, mid, [0 if s == begin else NEVER for s in range(4)])
    behind = backward(codes, mid, hi, after)
    least = min(a + b for a, b in zip(ahead, behind, strict=True))
    met = [b if a + b == least else NEVER for a, b in zip(ahead, behind, strict=True)]
    return crossing(codes, mid, hi, crossing(codes, lo, mid, begin, met, edits), after, edits)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a whole conversation; ties go to the ASCII-least audit."""
    return _short(bytes(codes)) if len(codes) <= 16 else _solved(codes)


def _solved(codes: bytes) -> tuple[int, str]:
    if not codes:
        return 0, ""
    edits: list[str] = []
    end = crossing(codes, 0, len(codes), START, list(END_COSTS), edits)
    return min(a + b for a, b in zip(forward(codes, 0, len(codes), [0, NEVER, NEVER, NEVER]), END_COSTS, strict=True)), "".join(edits) + "I" * _TAIL[end]


_short = lru_cache(maxsize=1 << 16)(_solved)


class Repair:
    """Applies an audit to the turns of a conversation, one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> list[tuple[str, str]]:
        """The turns inserted here."""
        out = []
        while self.audit[self.at : self.at + 1] == "I":
            self.state = _ON[self.state]
            out.append(("user" if self.state == USER else "assistant", ""))
            self.at += 1
        return out

    def turn(self, role: str, text: str) -> list[tuple[str, str]]:
        """What stands for the next turn, inserted ones before it included."""
        out = self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = _ON[self.state]
            out.append(("user" if self.state == USER else "assistant", text))
        elif letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            out.append((role, text))
        return out


@dataclass
class Stretch:
    """Consecutive turns of one conversation: their codes, and the counts that need their order."""

    key: str
    codes: bytearray = field(default_factory=bytearray)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: int | None = None
    last: int | None = None
    least_turn: int | None = None
    most_turn: int | None = None
    turns: int = 0

    def add(self, turn: int | None, initial: int, copies: int, fault: str, new: bool) -> None:
        """``copies`` equal rows; ``new`` if no earlier row has their role and text."""
        if not copies:
            return
        whole = copies if fault == "blank" else int(new)
        bad = code(initial, BAD)
        if fault == "blank":
            self.blank += copies
            self.codes += bytes([bad]) * copies
        else:
            self.truncated += whole * (fault == "truncated")
            self.duplicate += copies - whole
            self.codes += bytes([code(initial, TRUNCATED if fault == "truncated" else FINE)]) * whole + bytes([bad]) * (copies - whole)
        self.illegal += copies - 1 + (self.last is not None and (self.last, initial) not in LEGAL)
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None and turn != self.most_turn:
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.most_turn = turn

    def gaps(self) -> int:
        return 0 if self.most_turn is None else min(self.most_turn - self.least_turn + 1 - self.turns, (1 << 63) - 1)

    def matrix(self) -> list[int]:
        """Least cost from each state to each state, row by row."""
        return [c for s in range(4) for c in forward(self.codes, 0, len(self.codes), [0 if s == p else NEVER for p in range(4)])]


_FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_OPEN = "codes binary, first int, last int, least_turn long, most_turn long, turns long, matrix array<long>"
_STRETCH = f"key string, part int, {_FACTS}, {_OPEN}"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    arrays = [pa.array(c, kinds[f.split()[1]]) for c, f in zip(zip(*rows, strict=True), schema.split(", "), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=_names(schema))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range of turns as conversations. The range's first and last one may go on elsewhere and come out open."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    now: Stretch | None = None
    is_first = True
    rows: list[tuple] = []

    def row(s: Stretch, whole: bool) -> tuple:
        facts = (s.gaps(), s.blank, s.duplicate, s.truncated, s.illegal)
        if whole:
            return s.key, part, *facts, *cheapest_edits(s.codes), *[None] * 7
        return s.key, part, *facts, None, None, bytes(s.codes), s.first, s.last, s.least_turn, s.most_turn, s.turns, s.matrix()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "turn", "initial", "copies", "fault", "new")]
        for key, *turn in zip(*columns, strict=True):
            if now is None or now.key != key:
                if now is not None:
                    rows.append(row(now, not is_first))
                    is_first = False
                now = Stretch(key)
            now.add(*turn)
        if rows:
            yield _batch(rows, _STRETCH)
            rows = []
    if now is not None:
        yield _batch([row(now, False)], _STRETCH)


def _costs_after(parts: pd.DataFrame) -> pd.DataFrame:
    """For every stretch of a conversation the least costs of all that follows it, by state."""
    parts = parts.sort_values("part")
    after, out = list(END_COSTS), []
    for matrix in reversed(parts["matrix"].tolist()):
        out.append([int(c) for c in after])
        after = [min(min(int(matrix[4 * p + q]) + after[q] for q in range(4)), NEVER) for p in range(4)]
    return pd.DataFrame({"key": parts["key"], "part": parts["part"], "after": out[::-1]})


def _solve_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A stretch's edits and last state for every state that it may begin in."""
    for batch in batches:
        rows = []
        for key, part, codes, after in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "codes", "after")), strict=True):
            for begin in range(4):
                edits: list[str] = []
                reached = not codes or min(a + b for a, b in zip(forward(codes, 0, len(codes), [0 if s == begin else NEVER for s in range(4)]), after, strict=True)) < NEVER
                end = crossing(codes, 0, len(codes), begin, after, edits) if codes and reached else begin
                rows.append((key, part, begin, end, "".join(edits)))
        yield _batch(rows, "key string, part int, begin int, end int, edits string")


def _joined(stretches: pd.DataFrame) -> pd.DataFrame:
    """The facts of a conversation out of those of its stretches, except for cost and audit."""
    one: dict = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "last": None, "least": None, "most": None}
    for s in stretches.sort_values("part").to_dict("records"):
        for name in ("blank", "duplicate", "truncated", "illegal"):
            one[name] += int(s[name])
        if pd.notna(s["first"]):
            one["illegal"] += int(one["last"] is not None and (one["last"], int(s["first"])) not in LEGAL)
            one["last"] = int(s["last"])
        if s["least_turn"] != "":
            least, most = int(s["least_turn"]), int(s["most_turn"])
            one["turns"] += int(s["turns"]) - (one["most"] == least)
            one["least"] = least if one["least"] is None else one["least"]
            one["most"] = most
    gaps = 0 if one["most"] is None else min(one["most"] - one["least"] + 1 - one["turns"], (1 << 63) - 1)
    return pd.DataFrame({"key": [stretches["key"].iloc[0]], "gaps": [gaps], **{k: [one[k]] for k in ("blank", "duplicate", "truncated", "illegal")}})


def _followed(parts: pd.DataFrame) -> pd.DataFrame:
    """The audit of a conversation: each stretch's edits from the state where the one before ends."""
    found = {(r.part, r.begin): (r.end, r.edits) for r in parts.itertuples()}
    state, edits = START, []
    for part in sorted(set(parts["part"])):
        state, own = found[part, state]
        edits.append(own)
    return pd.DataFrame({"key": [parts["key"].iloc[0]], "audit": ["".join(edits) + "I" * _TAIL[state]]})


def _digest(text: Column) -> Column:
    """Stands for a text in comparisons and in the order of ties."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def _conversation(rows: DataFrame) -> DataFrame:
    """The operator's columns without nulls but for ``turn``; ``copies`` says how often a row counts."""
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    space = F.lit(" ")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), copies.alias("copies"),
    ).withColumn("digest", _digest(F.col("text")))


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation what is at fault and the cheapest edits: ``key`` and the columns of ``repair`` up to ``audit``.

    Texts stay where they are: what is shuffled is a digest and two flags per row,
    equal rows added up before. A turn's earlier equal is found by the least turn of
    its role and text, which meets its rows under a salt. The turns are then dealt by
    ranges of (conversation, turn, role, digest), so a conversation of any length is
    spread over tasks. A task solves the conversations that lie wholly inside its
    range. Of its first and last one it gives a 4 x 4 matrix of least costs; along a
    conversation these matrices give the costs after every stretch, each stretch is
    solved for the four states it may begin in, and the chain of states picks.
    """
    text = F.col("text")
    written = F.rtrim(text, F.lit(WHITE_SPACE))
    fault = F.when(written == "", "blank").when(~F.right(written, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("fine")
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)).cast("int")
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    light = _conversation(rows).select("key", "turn", "role", "digest", fault.alias("fault"), initial.alias("initial"), "copies")
    rest = ["key", "turn", "role", "digest", "fault", "initial"]
    turns = store(light.groupBy(rest).agg(F.sum("copies").alias("copies")), "turns")

    keys = ["key", "role", "digest"]
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    several = (
        turns.where("copies > 0 AND fault <> 'blank'").groupBy(keys).agg(F.min(order).alias("earliest"), F.count(F.lit(1)).alias("times")).where("times > 1")
        .select(*keys, "earliest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = turns.withColumns({"salt": F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")})
    new = F.col("earliest").isNull() | (F.col("earliest.known") == F.col("turn").isNotNull()) & F.col("earliest.turn").eqNullSafe(F.col("turn"))
    marked = salted.join(several, [*keys, "salt"], "left").select("key", "turn", "role", "digest", "initial", "copies", "fault", new.alias("new"))
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    in_order = ["key", "turn", "role", "digest"]
    dealt = marked.repartitionByRange(n, *in_order).sortWithinPartitions(*in_order)
    found = store(dealt.select("key", "turn", "initial", "copies", "fault", "new").mapInArrow(_stretches, _STRETCH), "stretches")

    whole = found.where("codes IS NULL").select("key", *_names(_FACTS))
    parts = found.where("codes IS NOT NULL")  # at most two per task
    after = parts.select("key", "part", "matrix").groupBy("key").applyInPandas(_costs_after, "key string, part int, after array<long>")
    solved = parts.select("key", "part", "codes").join(after, ["key", "part"]).mapInArrow(
        _solve_stretches, "key string, part int, begin int, end int, edits string")
    followed = solved.groupBy("key").applyInPandas(_followed, "key string, audit string")
    # As text, turns keep all their digits in pandas.
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("least_turn", "most_turn")]
    facts = parts.select("key", "part", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns", *as_text)
    facts = facts.groupBy("key").applyInPandas(_joined, "key string, gaps long, blank long, duplicate long, truncated long, illegal long")
    costs = parts.select("key", "part", "matrix").groupBy("key").applyInPandas(_chain_cost, "key string, cost long")
    put_together = facts.join(costs, "key").join(followed, "key").select("key", *_names(_FACTS))
    return store(whole.unionByName(put_together), "audits")


def _chain_cost(parts: pd.DataFrame) -> pd.DataFrame:
    costs = [0, NEVER, NEVER, NEVER]
    for matrix in parts.sort_values("part")["matrix"].tolist():
        costs = [min(min(costs[p] + int(matrix[4 * p + q]) for p in range(4)), NEVER) for q in range(4)]
    return pd.DataFrame({"key": [parts["key"].iloc[0]], "cost": [min(c + e for c, e in zip(costs, END_COSTS, strict=True))]})


_REPAIRED = f"conv_id long, {_FACTS}, repaired_sha256 string"
_MOST_TEXT = 4 << 20


def _write_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its turns in order: the digest of the repaired conversation. No text is kept."""
    facts = _names(_FACTS)
    now: tuple | None = None
    done: list[tuple] = []

    def write(turns: list[tuple[str, str]]) -> None:
        nonlocal written
        for role, text in turns:
            digest.update((f"\n{role}:{text}" if written else f"{role}:{text}").encode())
            written = True

    def close() -> tuple:
        write(repair.inserted())
        return (int(now[0]) if now[0] else None, *now[1:], digest.hexdigest())

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "copies", "role", "text", *facts)]
        for key, copies, role, text, *own in zip(*columns, strict=True):
            if copies is None:  # the audit comes first
                if now is not None:
                    done.append(close())
                now, repair, digest, written = (key, *own), Repair(own[-1]), hashlib.sha256(), False
                continue
            for _ in range(copies):
                write(repair.turn(role, text))
        if done:
            yield _batch(done, _REPAIRED)
            done = []
    if now is not None:
        yield _batch([close()], _REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """What is wrong with each conversation and how it is repaired most cheaply; one row per ``conv_id``.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and may have ``copies``: how
    often a row counts (0: the conversation is listed, the row is not there). Rows
    are taken by ``turn`` (nulls first), ties by role and by the text's SHA-256. Null
    roles and texts are one space; rows with a null ``conv_id`` are one conversation;
    repeated rows are duplicates; other columns are ignored; an empty table gives no
    rows.

    Returns ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256`` (of ``role:text`` lines). Edits are found on
    codes of one byte a turn (``audits``). Only the digest, which is sequential,
    takes a conversation's turns in order through one task, which holds its audit
    and a batch of turns.
    """
    found = audits(rows)
    turns = _conversation(rows).select("key", F.lit(1).alias("kind"), "turn", "role", "digest", "copies", "text")
    heads = found.select("key", F.lit(0).alias("kind"), *_names(_FACTS))
    both = turns.unionByName(heads, allowMissingColumns=True)
    in_order = both.repartition("key").sortWithinPartitions("key", "kind", "turn", "role", "digest")
    return in_order.select("key", "copies", "role", "text", *_names(_FACTS)).mapInArrow(_write_repaired, _REPAIRED)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` after a damage fixed by crc32 of ``conv_id:turn`` (nulls: one space).

    Of 20 remainders 0 drops a row, 1 empties its text, 2 removes its ``.``, ``!``
    and ``?``, 3 repeats it, 4 sets its role to user.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
