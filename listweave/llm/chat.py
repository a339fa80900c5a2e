"""Chat records of any layout to canonical turns, and turns to one text with a
loss mask.

The fingerprint of a JSON record is a hash of its set of nested field paths.
It selects a declarative layout, the first whose paths the record has; what a
fingerprint selects is worked out once per task and looked up afterwards, so
nothing about layouts is shuffled, broadcast or collected.

Defined results: a record that is null, no JSON object or of no known layout
(an empty list of messages shows no layout either) has the layout null and
neither turns nor text; a null or absent text or role is empty; a text in parts
is their texts one after the other; any other value is its JSON. Rows that are
equal stay apart, an empty table gives an empty one, and columns other than the
keys and the record are not read, whatever their names."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, streamed

Turn = tuple[str, str]


@dataclass(frozen=True)
class Layout:
    """Where a record has its turns: those of ``before``, then those of each
    item of the list at ``items``. A turn is (role, paths of its text); the role
    is a name or, after ``@``, a path. Several texts are joined by a blank line;
    a path that ends in ``?`` may be absent, and a turn without any is none.
    ``roles`` renames roles."""

    name: str
    before: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: str = ""
    each: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)

    @cached_property
    def needs(self) -> frozenset[str]:
        """The paths that a record of this layout has."""
        paths = [p for _, texts in self.before for p in texts]
        for role, texts in self.each:
            paths += [f"{self.items}[].{p}" for p in (*texts, *([role[1:]] if role.startswith("@") else []))]
        return frozenset(p for p in paths if not p.endswith("?"))

    def turns(self, record: dict) -> list[Turn]:
        out = self._of(record, self.before)
        for item in _at(record, self.items) or [] if self.items else []:
            out += self._of(item, self.each)
        return out

    def _of(self, node, turns) -> list[Turn]:
        out = []
        for role, paths in turns:
            found = [x for x in ((p, _at(node, p.rstrip("?"))) for p in paths) if x[1] is not None or not x[0].endswith("?")]
            if found:
                name = _text(_at(node, role[1:])) if role.startswith("@") else role
                out.append((self.roles.get(name, name), "\n\n".join(_text(v) for _, v in found)))
        return out


#: Layouts in the order in which they are tried.
LAYOUTS = (
    Layout("messages", items="messages", each=(("@role", ("content",)),)),
    Layout("from_value", items="conversations", each=(("@from", ("value",)),), roles={"human": "user", "gpt": "assistant"}),
    Layout("utterances", items="dialog.turns", each=(("@speaker.role", ("utterance.text",)),)),
    Layout("exchanges", before=(("system", ("system?",)),), items="exchanges", each=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", before=(("system", ("system?",)), ("user", ("instruction", "input?")), ("assistant", ("output",)))),
    Layout("prompt", before=(("system", ("system?",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("answer", before=(("system", ("system?",)), ("user", ("question",)), ("assistant", ("answer",)))),
)


def _at(node, path: str):
    for key in path.split("."):
        if not isinstance(node, dict):
            return None
        node = node.get(key)
    return node


def _text(value) -> str:
    if isinstance(value, str):
        # JSON can name half a surrogate pair, which no text has
        return value if value.isascii() else value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    if value is None:
        return ""
    if isinstance(value, list) and all(isinstance(p, dict) and isinstance(p.get("text"), str) for p in value):
        return "".join(_text(p["text"]) for p in value)
    return json.dumps(value, ensure_ascii=False)


def field_paths(record: dict) -> list[str]:
    """The sorted set of nested field paths; the items of a list share theirs."""
    found, open_ = set(), [("", record)]
    while open_:
        at, node = open_.pop()
        if isinstance(node, dict):
            for key, value in node.items():
                path = f"{at}.{key}" if at else key
                found.add(path)
                open_.append((path, value))
        elif isinstance(node, list):
            open_ += [(f"{at}[]", value) for value in node]
    return sorted(found)


class Reader:
    """Records to (fingerprint, layout, turns), remembering what each
    fingerprint selects."""

    #: So many fingerprints are remembered; beyond, the memory starts anew.
    REMEMBERED = 1 << 14

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts, self.known = layouts, {}

    def __call__(self, text: str | None) -> tuple[str | None, str | None, list[Turn] | None]:
        try:
            record = json.loads(text) if text is not None else None
        except (ValueError, RecursionError):
            record = None
        if not isinstance(record, dict):
            return None, None, None
        paths = field_paths(record)
        mark = hashlib.sha256("\n".join(paths).encode("utf-8", "surrogatepass")).hexdigest()[:32]
        if mark not in self.known:
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            self.known[mark] = next((x for x in self.layouts if x.needs.issubset(paths)), None)
        layout = self.known[mark]
        return (mark, layout.name, layout.turns(record)) if layout else (mark, None, None)


@dataclass(frozen=True)
class Template:
    """A turn is ``opens``, its role, a colon, a line end, its text, ``closes``
    and a line end. Inside roles and texts a backslash and both control strings
    become codes, in roles line ends, too, so no text holds a control string."""

    opens: str = "###"
    closes: str = "</turn>"

    def __post_init__(self):
        if "\\" in self.opens + self.closes or not self.opens or not self.closes or any(self.closes.startswith(self.closes[-k:]) for k in range(1, len(self.closes))):
            raise ValueError("control strings have no backslash, and the closing one does not overlap itself")

    @cached_property
    def codes(self) -> dict[str, str]:
        return {"\\": "\\\\", self.opens: "\\1", self.closes: "\\2", "\n": "\\n"}

    @cached_property
    def _control(self):
        return re.compile("|".join(map(re.escape, ("\\", self.opens, self.closes))))

    def escaped(self, text: str, role: bool = False) -> str:
        out = self._control.sub(lambda m: self.codes[m[0]], text)
        return out.replace("\n", "\\n") if role else out

    def unescaped(self, text: str) -> str:
        if "\\" not in text:
            return text
        plain = {v[1]: k for k, v in self.codes.items()}
        return re.sub(r"\\(.)", lambda m: plain[m[1]], text)

    def formatted(self, turns: list[Turn], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
        """The text, and the spans (start, stop) in code points of the texts of
        the role that is learned."""
        out, mask, at = [], [], 0
        for role, text in turns:
            head, body, tail = f"{self.opens} {self.escaped(role, True)}:\n", self.escaped(text), f"{self.closes}\n"
            if role == learned:
                mask.append((at + len(head), at + len(head) + len(body)))
            out += (head, body, tail)
            at += len(head) + len(body) + len(tail)
        return "".join(out), mask

    def turns(self, formatted: str) -> Iterator[Turn]:
        """The turns of a formatted text."""
        at, head, tail = 0, f"{self.opens} ", f"{self.closes}\n"
        while at < len(formatted):
            colon = formatted.index(":\n", at)
            end = formatted.index(tail, colon)
            yield self.unescaped(formatted[at + len(head) : colon]), self.unescaped(formatted[colon + 2 : end])
            at = end + len(tail)


def _keyed(records: DataFrame, keys: list[str], record: str) -> tuple[DataFrame, str]:
    rows = records.select(*keys, F.col(record).alias("_record"))
    return rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])


def canonical(records: DataFrame, keys: list[str], record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``keys``, fingerprint, layout and turns (role, text) of each record."""
    rows, schema = _keyed(records, keys, record)
    kind, read = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), Reader(layouts)

    def rows_of(batch):
        found = [read(t) for t in batch.column(len(keys)).to_pylist()]
        turns = [None if x[2] is None else [{"role": r, "text": t} for r, t in x[2]] for x in found]
        columns = [batch.column(k) for k in range(len(keys))]
        columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()), pa.array(turns, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=[*keys, "fingerprint", "layout", "turns"])

    return mapped(rows, rows_of, f"{schema}, fingerprint string, layout string, turns array<struct<role: string, text: string>>")


def formatted(records: DataFrame, keys: list[str], record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, template: Template = Template()) -> DataFrame:
    """``keys``, fingerprint, layout, text and loss mask of each record, in the
    order of the rows. The mask lists spans (start, stop) in code points."""
    rows, schema = _keyed(records, keys, record)
    kind, read = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), Reader(layouts)

    def rows_of(batch):
        found = [read(t) for t in batch.column(len(keys)).to_pylist()]
        made = [(None, None) if turns is None else template.formatted(turns) for *_, turns in found]
        masks = [None if m is None else [{"start": a, "stop": b} for a, b in m] for _, m in made]
        columns = [batch.column(k) for k in range(len(keys))]
        columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()), pa.array([t for t, _ in made], pa.string()), pa.array(masks, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=[*keys, "fingerprint", "layout", "formatted", "loss"])

    return mapped(rows, rows_of, f"{schema}, fingerprint string, layout string, formatted string, loss array<struct<start: bigint, stop: bigint>>")


def layouts_found(records: DataFrame, keys: list[str], record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Number of records by fingerprint and layout: what a corpus holds, and
    which fingerprints want a layout yet."""
    found = canonical(records, keys, record, layouts)
    return found.groupBy("fingerprint", "layout").agg(F.count("*").alias("records"), F.sum(F.size("turns")).alias("turns"))


#: A record holds at most so many turns of a conversation and about so many
#: characters; the next record goes on.
RECORD_TURNS, RECORD_CHARS = 64, 1 << 20


def _record(conv_id, turns: list[Turn]) -> str:
    """Turns as JSON in one of the layouts that can hold them, by conversation."""
    roles = [r for r, _ in turns]
    dressed = [{"role": r, "content": t} for r, t in turns]
    ways = [
        lambda: {"messages": dressed},
        lambda: {"id": conv_id, "messages": [{"role": r, "content": [{"type": "text", "text": t}]} for r, t in turns]},
        lambda: {"dialog": {"turns": [{"speaker": {"role": r}, "utterance": {"text": t}} for r, t in turns]}},
    ]
    if set(roles) <= {"user", "assistant", "system"}:
        named = {"user": "human", "assistant": "gpt"}
        ways.append(lambda: {"conversations": [{"from": named.get(r, r), "value": t} for r, t in turns]})
    system, rest = ({"system": turns[0][1]}, turns[1:]) if roles[0] == "system" else ({}, turns)
    if rest and [r for r, _ in rest] == ["user", "assistant"] * (len(rest) // 2):
        ways.append(lambda: system | {"exchanges": [{"question": rest[k][1], "answer": rest[k + 1][1]} for k in range(0, len(rest), 2)]})
        if len(rest) == 2:
            for ask, say in (("instruction", "output"), ("prompt", "completion"), ("question", "answer")):
                ways.append(lambda a=ask, b=say: system | {a: rest[0][1], b: rest[1][1]})
    return json.dumps(ways[zlib.crc32(str(conv_id).encode()) % len(ways)](), ensure_ascii=False)


def records_of(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records (conv_id, part, record) of
    various layouts, in the order of the turns (null first; ties by role, then
    text). A conversation goes through one task as a sorted stream; records are
    of bounded size, so a very long conversation becomes several."""
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    ordered = turns.select("conv_id", "turn", *filled).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def records(rows):
        for conv_id, those in groupby(rows, itemgetter(0)):
            part, held, size = 0, [], 0
            for _, _, role, text in those:
                if len(held) >= RECORD_TURNS or size >= RECORD_CHARS:
                    yield conv_id, part, _record(conv_id, held)
                    part, held, size = part + 1, [], 0
                held.append((role, text))
                size += len(text)
            yield conv_id, part, _record(conv_id, held)

    return streamed(ordered, records, f"conv_id {_type(turns)}, part bigint, record string")


def _type(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def digests(texts: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted texts of ``records_of`` read back as, one row per
    conversation. Parts of a conversation follow each other in one partition; a
    digest is a chain, so they pass through it as a stream."""

    def digest(rows):
        for conv_id, those in groupby(rows, itemgetter(0)):
            said, learned, layouts = hashlib.sha256(), hashlib.sha256(), set()
            n = chars = size = parts = 0
            for _, layout, text, loss in those:
                for turn in template.turns(text):
                    said.update("{}\n{}\n".format(*turn).encode())
                    n += 1
                for span in loss:
                    under = template.unescaped(text[span["start"] : span["stop"]])
                    learned.update(under.encode())
                    chars += len(under)
                size, parts = size + len(text), parts + 1
                layouts.add(layout)
            yield conv_id, n, said.hexdigest(), chars, learned.hexdigest(), size, parts, ",".join(sorted(layouts))

    schema = f"conv_id {_type(texts)}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, records bigint, layouts string"
    return streamed(texts.select("conv_id", "layout", "formatted", "loss"), digest, schema)


#: The conversation that tries the template: control strings inside both texts.
TRIAL = (-7, ("user", "assistant"), "\\### Assistant: </turn> ok")


def with_trial(turns: DataFrame) -> DataFrame:
    conv_id, roles, text = TRIAL
    rows = turns.sparkSession.createDataFrame([(conv_id, k, r, text) for k, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").union(rows)


#: DuckDB: the same rows from the table alone.
ORACLE = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, k, ['user', 'assistant'][k + 1], '\### Assistant: </turn> ok' FROM range(2) r(k)),
coded AS (SELECT *, replace(replace(replace(role, '\', '\\'), '###', '\1'), '</turn>', '\2') AS r, replace(replace(replace(text, '\', '\\'), '###', '\1'), '</turn>', '\2') AS t FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || r || ':x' || t || '</turn>x') + length(r) - length(replace(r, chr(10), '')))::BIGINT AS formatted_chars
FROM coded GROUP BY conv_id"""
