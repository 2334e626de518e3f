"""Chat formatting: schema fingerprints select mappings to turns; a reversible template with a loss mask."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Turn = tuple[str, str]


def field_paths(record: Any, at: str = "") -> set[str]:
    """The paths of all leaves of a nested record; list items share ``[]``. An empty container is a leaf; null fields are absent."""
    if isinstance(record, dict) and (known := {k: v for k, v in record.items() if v is not None}):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in known.items()))
    if isinstance(record, (list, tuple)) and record:
        return set().union(*(field_paths(v, at + "[]") for v in record))
    return {at} if at and record is not None else set()


def schema_fingerprint(paths: Iterable[str]) -> str:
    """A hash of a set of field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``paths`` are the fields that a record of the layout has, ``optional`` those it
    may have. ``each`` names a list of messages with ``role`` and ``content`` inside;
    ``parts`` lists (role, fields), whose texts are joined by a blank line; without
    either the record is one message. ``roles`` renames the layout's roles.
    """

    paths: Sequence[str]
    each: str = ""
    role: str = "role"
    content: str = "content"
    parts: Sequence[tuple[str, Sequence[str]]] = ()
    roles: dict[str, str] = field(default_factory=dict)
    optional: Sequence[str] = ()

    def path_sets(self) -> list[frozenset[str]]:
        """All sets of paths that a record of the layout can have: with any of the optional ones, and with no messages."""
        sets = [frozenset((*self.paths, *some)) for n in range(len(self.optional) + 1) for some in itertools.combinations(self.optional, n)]
        return sets + ([frozenset((self.each,))] if self.each else [])

    def turns(self, record: dict) -> list[Turn]:
        if not self.each and not self.parts:
            return [(self.roles.get(r := _text(record.get(self.role)), r), _text(record.get(self.content)))]
        if self.each:
            items = record.get(self.each) or []
            return [(self.roles.get(r := _text(m.get(self.role)), r), _text(m.get(self.content))) for m in items]
        return [
            (role, "\n\n".join(t for t in (_text(record.get(f)) for f in fields) if t))
            for role, fields in self.parts if any(_text(record.get(f)) for f in fields) or role == "assistant"
        ]


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: The layouts known from the start; more may be given to ``canonical_turns``. The last is a table's row with one message.
MAPPINGS = (
    Mapping(("messages[].role", "messages[].content"), each="messages"),
    Mapping(("messages[].role", "messages[].text"), each="messages", content="text"),
    Mapping(("conversations[].from", "conversations[].value"), each="conversations", role="from", content="value", roles=_SPEAKERS),
    Mapping(("prompt", "completion"), parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Mapping(("prompt", "response"), parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Mapping(("question", "answer"), parts=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
    Mapping(("instruction", "output"), parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("input", "system")),
    Mapping((), content="text", optional=("role", "text")),
)
#: Fields that say nothing about the turns; they don't count as part of a layout.
IGNORED = frozenset(("id", "uid", "source", "dataset", "lang", "language", "split", "created", "timestamp", "conv_id", "turn"))
#: Sets of paths whose fingerprints a worker remembers.
REMEMBERED = 4096


class Layouts:
    """Mappings by the fingerprint of their paths.

    ``ignored`` fields at the top of a record (with all that is in them) are left out
    before the fingerprint is taken. Two mappings with one fingerprint are an error.
    """

    def __init__(self, mappings: Iterable[Mapping] = MAPPINGS, ignored: Iterable[str] = IGNORED) -> None:
        self.by_fingerprint: dict[str, Mapping] = {}
        self.ignored, self._marks = frozenset(ignored), {}
        for mapping in mappings:
            for paths in mapping.path_sets():
                other = self.by_fingerprint.setdefault(schema_fingerprint(paths), mapping)
                if other != mapping and paths != {mapping.each}:  # lists without messages are alike
                    raise ValueError(f"two mappings for the paths {sorted(paths)}")

    def fingerprint(self, record: Any) -> str:
        """The fingerprint of a record's layout."""
        if isinstance(record, dict):
            record = {k: v for k, v in record.items() if k not in self.ignored}
        paths = frozenset(field_paths(record))
        if (mark := self._marks.get(paths)) is None:
            if len(self._marks) >= REMEMBERED:
                self._marks.clear()
            mark = self._marks[paths] = schema_fingerprint(paths)
        return mark

    def select(self, record: Any) -> Mapping | None:
        """The mapping of a record's layout; None if there is none."""
        return self.by_fingerprint.get(self.fingerprint(record)) if isinstance(record, dict) else None


# Template. A turn is "### <Role>: <text></turn>\n". The marks below.
HEAD, END = "### ", "</turn>"
_TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in _TITLES.items()}
_ESCAPED = re.compile(r"\\|###|</turn>")
_TURN = re.compile(r'### (?:(System|User|Assistant)|=("(?:[^"\\]|\\.)*")): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n', re.DOTALL)
_BACK = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every backslash and control string; nothing else changes."""
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, tuple[int, int] | None]:
    """A turn by the template, and where its text stands if it is under the loss (assistant turns)."""
    title = _TITLES.get(role) or "=" + json.dumps(role)
    head, body = f"{HEAD}{title}: ", escape(text)
    return f"{head}{body}{END}\n", (len(head), len(head) + len(body)) if role == "assistant" else None


def format_turns(turns: Iterable[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask, as spans of code points."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        part, span = formatted_turn(role, text)
        if span:
            mask.append((at + span[0], at + span[1]))
        parts.append(part)
        at += len(part)
    return "".join(parts), mask


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a formatted conversation; raises on text that the template didn't make."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        role = _ROLES[found[1]] if found[1] else json.loads(found[2])
        turns.append((role, unescape(found[3])))
        at = found.end()
    return turns


def canonical_turns(records: DataFrame, record: str = "record", mappings: Iterable[Mapping] = MAPPINGS) -> DataFrame:
    """Heterogeneous JSON records as turns, formatted, with fingerprint and loss mask; one row per row.

    Adds ``schema`` (fingerprint of the record's field paths), ``turns`` (array of
    role, text), ``formatted``, ``loss_spans`` (array of start, end) and ``error``:
    null, or why there are no turns (unreadable JSON, unknown layout, null). Null and
    IGNORED fields don't count; a list without messages gives no turns and no error.
    Other columns stay, unless they clash with an added one, which then wins.
    Repeated rows repeat, an empty table gives no rows; a record passes through a
    task whole, however long.
    """
    layouts = Layouts(mappings)
    added = ["schema", "turns", "formatted", "loss_spans", "error"]
    kept = [f for f in records.schema.fields if f.name not in added]
    own = StructType.fromDDL(
        "schema string, turns array<struct<role:string,text:string>>, formatted string, loss_spans array<struct<start:long,end:long>>, error string")
    schema = StructType([*kept, *own.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows = []
            for raw in batch.column(record).to_pylist():
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    rows.append((None, None, None, None, "not JSON"))
                    continue
                mark, mapping = layouts.fingerprint(value), layouts.select(value)
                if mapping is None:
                    rows.append((mark, None, None, None, "no record" if value is None else "unknown layout"))
                    continue
                turns = mapping.turns(value)
                text, mask = format_turns(turns)
                rows.append((mark, [{"role": r, "text": t} for r, t in turns], text, [{"start": a, "end": b} for a, b in mask], None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(added)
            arrays = [batch.column(f.name) for f in kept] + [pa.array(c, arrow.field(n).type) for c, n in zip(columns, added, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return records.select([f.name for f in kept]).mapInArrow(run, schema)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(rows: DataFrame) -> DataFrame:
    """Formats conversations of one message a row and digests what is read back; one row per ``conv_id``.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``. Every row is a record, whose
    own fingerprint selects its mapping among all ``MAPPINGS``: rows without a role or
    a text are other layouts than those with both. Rows are taken by ``turn`` (null
    first), ties by the formatted turn; null roles and texts are empty; rows with
    a null ``conv_id`` are one conversation; repeated rows are repeated turns;
    other columns are ignored; an empty table gives no rows.

    Every message is formatted on its own task (the template has no state), and a
    conversation's formatted turns then pass in order through one task, which
    keeps digests and counts only, never the conversation.
    """
    picked = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts()
        for batch in batches:
            parts, starts, ends = [], [], []
            for record in batch.to_pylist():
                mapping = layouts.select(record)
                if mapping is None:
                    raise ValueError(f"no mapping for a row with {sorted(field_paths(record))}")
                for role, text in mapping.turns(record):
                    part, span = formatted_turn(role, text)
                    parts.append(part)
                    starts.append(span[0] if span else None)
                    ends.append(span[1] if span else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(parts, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "formatted", "loss_start", "loss_end"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        done: list[tuple] = []
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in _DIGEST.split(", ")]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]
            for conv, part, start, end in zip(*columns, strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[5] += len(part)
                for role, text in read_turns(part):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    loss = unescape(part[start:end])
                    state[3] += len(loss)
                    state[4].update(loss.encode())
            if done:
                yield out()
                done.clear()
        if state is not None:
            done.append(row(state))
            yield out()

    written = picked.mapInArrow(write, "conv_id long, turn long, formatted string, loss_start long, loss_end long")
    ordered = written.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(digest, _DIGEST)
