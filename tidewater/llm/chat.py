"""Chat formatting: layouts recognised by a fingerprint of their field paths, one reversible template.

A layout names the field paths of a record and says declaratively how they become
turns. A record's fingerprint is the hash of those known paths that it has (lists
as ``[]``); fields no layout knows of don't count. The fingerprint picks the layout:
once for a table with columns of its own, row by row for JSON records.

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside
roles and texts a backslash goes before every backslash, ``###`` and ``</turn>``
(and before a colon in roles), so the output can be read back exactly. Each turn
carries the span of its text if that is to be learned.

A conversation's digest runs over its turns one after the other; they pass through
a task sorted and are never held together, however long a conversation is.

Defined cases: a null text or role is empty; a null turn sorts first; equal turn
numbers are ordered by role and text; rows without a conversation id form one
conversation; a record that fits no layout has a null layout and no turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

HEAD, SEP, TURN_END = "### ", ": ", "</turn>\n"
LEARNED = "assistant"


@dataclass(frozen=True)
class Layout:
    """``items``: a list field with role and text fields; ``parts``: (role, fields joined by a blank line); neither: a row is a turn."""

    name: str
    items: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> tuple[str, ...]:
        if self.items:
            field, role, text = self.items
            return (f"{field}[].{role}", f"{field}[].{text}")
        if self.parts:
            return tuple(p for _, fields in self.parts for p in fields)
        return ("role", "text")


LAYOUTS = (
    Layout("turn rows"),
    Layout("messages", items=("messages", "role", "content")),
    Layout("shares", items=("conversations", "from", "value")),
    Layout("dialogue", items=("turns", "role", "text")),
    Layout("instruction", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Layout("prompt", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("question", parts=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
)
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KNOWN = tuple(sorted({p for layout in LAYOUTS for p in layout.paths()}))


def fingerprint(paths) -> str:
    """Hash of the known ones among a record's field paths."""
    there = set(paths)
    return hashlib.md5(",".join(p for p in KNOWN if p in there).encode()).hexdigest()


def layout_table() -> dict[str, Layout]:
    """The layout of each fingerprint: a layout's paths, with or without those that are optional."""
    found: dict[str, Layout] = {}
    for layout in LAYOUTS:
        for k in range(len(layout.optional) + 1):
            for missing in combinations(layout.optional, k):
                found.setdefault(fingerprint(p for p in layout.paths() if p not in missing), layout)
    return found


def schema_paths(schema: T.StructType, before: str = "") -> list[str]:
    """The field paths of a table."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, before + f.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def _role(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(known[c], c, F.lit(""))


def _turns(layout: Layout, record) -> Column:
    """The turns (role, text) of a record with this layout; ``record`` gives the column of a top-level field or None."""
    kind = "array<struct<role:string,text:string>>"
    if layout.items:
        field, role, text = layout.items
        return F.transform(record(field), lambda x: F.struct(_role(x[role].cast("string")).alias("role"), F.coalesce(x[text].cast("string"), F.lit("")).alias("text")))
    turns = []
    for role, fields in layout.parts:
        there = [record(f).cast("string") for f in fields if record(f) is not None]
        if there:
            some = F.coalesce(*there).isNotNull()
            turns.append(F.when(some, F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *there).alias("text"))))
    return F.array_compact(F.array(*turns)).cast(kind)


def turns_of_table(df: DataFrame, conversation: str) -> DataFrame:
    """(conv_id, turn, role, text) of a table whose columns have one of the layouts.

    ``turn rows`` need a column ``turn`` beside role and text.
    """
    layout = layout_table().get(fingerprint(schema_paths(df.schema)))
    if layout is None:
        raise ValueError(f"no layout has the fields {schema_paths(df.schema)}")
    if not layout.items and not layout.parts:
        return df.select(F.col(conversation).alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = _turns(layout, lambda f: F.col(f"`{f}`") if f in df.columns else None)
    return df.select(F.col(conversation).alias("conv_id"), F.posexplode(turns).alias("turn", "t")).select("conv_id", "turn", "t.role", "t.text")


def _record_schema() -> T.StructType:
    lists: dict[str, list[str]] = {}
    plain = []
    for p in KNOWN:
        if "[]." in p:
            field, inner = p.split("[].")
            lists.setdefault(field, []).append(inner)
        else:
            plain.append(p)
    fields = [T.StructField(p, T.StringType()) for p in plain]
    fields += [T.StructField(f, T.ArrayType(T.StructType([T.StructField(x, T.StringType()) for x in inner]))) for f, inner in lists.items()]
    return T.StructType(fields)


def _has(path: str) -> Column:
    """Whether the parsed record ``r`` has something at a known path."""
    field, _, inner = path.partition("[].")
    return F.exists(F.col("r")[field], lambda x: x[inner].isNotNull()) if inner else F.col("r")[path].isNotNull()


def turns_of_json(records: DataFrame, conversation: str, json: str) -> DataFrame:
    """(conv_id, layout, turn, role, text) of JSON records in any mixture of layouts; a row with a null layout for each that fits none."""
    parsed = records.select(F.col(conversation).alias("conv_id"), F.from_json(F.col(json), _record_schema()).alias("r"))
    there = [F.when(_has(p), F.lit(p)) for p in KNOWN]
    mark = F.md5(F.concat_ws(",", *there).cast("binary"))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    by_layout: dict[Layout, list[str]] = {}
    for known, layout in layout_table().items():
        by_layout.setdefault(layout, []).append(known)
    for layout, marks in by_layout.items():
        hit = F.col("mark").isin(marks)
        if layout.items or layout.parts:
            made = _turns(layout, lambda f: F.col("r")[f])
        else:
            made = F.array(F.struct(_role(F.col("r.role")).alias("role"), F.coalesce("r.text", F.lit("")).alias("text")))
        name, turns = F.when(hit, F.lit(layout.name)).otherwise(name), F.when(hit, made).otherwise(turns)
    rows = parsed.withColumn("mark", mark).select("conv_id", name.alias("layout"), F.posexplode_outer(turns).alias("turn", "t"))
    return rows.select("conv_id", "layout", "turn", "t.role", "t.text")


# ---------------------------------------------------------------------------
# the template
# ---------------------------------------------------------------------------
_CONTROL = r"(\\|###|</turn>)"


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` with piece, loss_start and loss_chars: a conversation's text is its pieces in order of turn, role and text.

    ``loss_start`` is the place in the piece of the text to learn, null where none is.
    """
    head = F.concat(F.lit(HEAD), F.regexp_replace("role", r"(\\|###|</turn>|:)", r"\\$1"), F.lit(SEP))
    body = F.regexp_replace("text", _CONTROL, r"\\$1")
    learned = F.col("role") == LEARNED
    return turns.withColumns(
        {
            "piece": F.concat(head, body, F.lit(TURN_END)),
            "loss_start": F.when(learned, F.char_length(head)),
            "loss_chars": F.when(learned, F.char_length(body)),
        }
    )


_TURN = re.compile(r"### ((?:\\\\|\\###|\\</turn>|\\:|[^\\:])*): ((?:\\\\|\\###|\\</turn>|(?!</turn>)[^\\])*+)</turn>\n", re.S)
_unescape_text = re.compile(r"\\(\\|###|</turn>)").sub
_unescape_role = re.compile(r"\\(\\|###|</turn>|:)").sub


class Reader:
    """Reads a formatted conversation back, piece by piece, keeping only digests and counts."""

    def __init__(self):
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, loss: tuple[int, int] | None) -> None:
        at = 0
        while at < len(piece):
            m = _TURN.match(piece, at)
            if m is None:
                raise ValueError("not a formatted turn")
            role, text = _unescape_role(r"\1", m[1]), _unescape_text(r"\1", m[2])
            self.all.update(f"{role}\n{text}\n".encode())
            self.turns, at = self.turns + 1, m.end()
        self.chars += len(piece)
        if loss:
            text = _unescape_text(r"\1", piece[loss[0] : loss[0] + loss[1]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces come sorted; one may run on over many batches."""
    fields = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _DIGEST.split(", ")])
    current, reader = None, None

    def row() -> list:
        return [current, reader.turns, reader.all.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars]

    for batch in batches:
        done = []
        ids, pieces, starts, sizes = (batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_chars"))
        for conv, piece, start, size in zip(ids, pieces, starts, sizes):
            if reader is None or conv != current:
                if reader is not None:
                    done.append(row())
                current, reader = conv, Reader()
            reader.add(piece, None if start is None else (start, size))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done) if done else [[]] * len(fields), fields)], schema=fields)
    if reader is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row(), fields)], schema=fields)


def read_back(pieces: DataFrame) -> DataFrame:
    """The digests of every conversation, from its formatted text and loss spans alone."""
    ship(pieces.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    dealt = pieces.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "piece", "loss_start", "loss_chars").mapInArrow(_read, _DIGEST)
