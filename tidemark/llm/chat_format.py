"""Chat formatting: records of many layouts to canonical turns to one marked text.

1. ``canonical_turns``: each record's filled nested field paths are hashed to a
   fingerprint, which selects one of the declared ``LAYOUTS``; the layout says
   which paths make up the turns, and in which roles.  Records whose fingerprint
   no layout has get no turns and their fingerprint is reported.
2. ``segments``: each turn becomes a mark, its escaped text and an end.  Control
   strings inside texts (and backslashes that already stand in one) get one more
   backslash, so the text can be read back exactly.  This is done turn by turn,
   before any turn moves.
3. ``formatted``: the turns of a conversation come together by its id, in order,
   as pieces with a loss flag: the text of assistants is under the mask, marks
   and all other texts are not.  The pieces side by side are the output.
4. ``read_back``: splits the output at its ends, takes role and text out of
   each turn, and the text under the mask out of the flagged pieces.

Only built-in expressions are used.  A conversation is one row of the result;
no other rows meet in a group, and partial lists are not split any further, as
its text has to be in one place.

Null texts are empty, null roles too.  Null ids form one conversation.  Turns
of the same number come in the order of their formatted pieces, so copies of a
row stand one after the other.  Roles may be any text.  Input columns other than the known
paths are left alone and cannot clash, as results are selected by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import column, packed

# The template.  Every turn is a mark, its text and an end.
BEGIN, END = "<s>", "</s>"
MARKS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "[SYS] "}
ROLE_MARK, ROLE_END = "[ROLE] ", "\n"
# What must not stand in a text: all of the above, with any number of backslashes
# after the bracket, which is where one more is put.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|SYS\]|ROLE\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|SYS\]|ROLE\])"
LOSS_ROLE = "assistant"

_STRING = T.StringType()


def _items(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


# The nested fields that layouts are made of; others do not count.
KNOWN = T.StructType(
    [
        *(
            T.StructField(n, _STRING)
            for n in (
                "system", "prompt", "completion", "response", "instruction", "input", "output",
                "question", "answer", "role", "text", "content",
            )
        ),
        T.StructField("messages", _items(role=_STRING, content=_STRING, text=_STRING)),
        T.StructField("conversations", _items(**{"from": _STRING, "value": _STRING})),
        T.StructField("dialogue", _items(user=_STRING, assistant=_STRING)),
    ]
)


@dataclass(frozen=True)
class Turn:
    """One turn: a fixed role, or the path of one, and the paths of its text, joined by empty lines."""

    texts: Sequence[str]
    role: str = ""
    role_path: str = ""


@dataclass(frozen=True)
class Layout:
    """How the records with exactly the paths ``required``, and any of ``optional``, become turns.

    Turns over paths such as ``messages[].content`` are made once per item.  A
    turn whose text paths are all missing is left out.  ``renamed`` maps the
    layout's names of roles to ours.
    """

    name: str
    required: Sequence[str]
    turns: Sequence[Turn]
    optional: Sequence[str] = ()
    renamed: Mapping[str, str] = field(default_factory=dict)

    def fingerprints(self) -> list[str]:
        sets = (
            {*self.required, *extra}
            for n in range(len(self.optional) + 1)
            for extra in combinations(self.optional, n)
        )
        return [fingerprint_of(s) for s in sets]


_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
_SYSTEM = Turn(["system"], "system")
LAYOUTS = (
    Layout("turn_row", ["role", "text"], [Turn(["text"], role_path="role")]),
    Layout("empty_turn_row", ["role"], [Turn(["text"], role_path="role")]),
    Layout("role_less_row", ["text"], [Turn(["text"], role_path="role")]),
    Layout("content_row", ["role", "content"], [Turn(["content"], role_path="role")]),
    Layout(
        "prompt_completion", ["prompt", "completion"],
        [_SYSTEM, Turn(["prompt"], "user"), Turn(["completion"], "assistant")], ["system"],
    ),
    Layout(
        "prompt_response", ["prompt", "response"],
        [_SYSTEM, Turn(["prompt"], "user"), Turn(["response"], "assistant")], ["system"],
    ),
    Layout(
        "question_answer", ["question", "answer"],
        [_SYSTEM, Turn(["question"], "user"), Turn(["answer"], "assistant")], ["system"],
    ),
    Layout(
        "instruction", ["instruction", "output"],
        [_SYSTEM, Turn(["instruction", "input"], "user"), Turn(["output"], "assistant")],
        ["input", "system"],
    ),
    Layout(
        "messages", ["messages[].role", "messages[].content"],
        [_SYSTEM, Turn(["messages[].content"], role_path="messages[].role")], ["system"], _SPEAKERS,
    ),
    Layout(
        "message_texts", ["messages[].role", "messages[].text"],
        [_SYSTEM, Turn(["messages[].text"], role_path="messages[].role")], ["system"], _SPEAKERS,
    ),
    Layout(
        "from_value", ["conversations[].from", "conversations[].value"],
        [_SYSTEM, Turn(["conversations[].value"], role_path="conversations[].from")],
        ["system"], _SPEAKERS,
    ),
    Layout(
        "pairs", ["dialogue[].user", "dialogue[].assistant"],
        [_SYSTEM, Turn(["dialogue[].user"], "user"), Turn(["dialogue[].assistant"], "assistant")],
        ["system"],
    ),
)


def known_paths(schema: T.StructType = KNOWN) -> list[str]:
    """All leaf paths, ``[]`` after a list, in code-point order."""
    paths = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            paths += [f"{f.name}[].{g}" for g in f.dataType.elementType.names]
        else:
            paths.append(f.name)
    return sorted(paths)


def fingerprint_of(paths) -> str:
    """The fingerprint of a set of paths."""
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


def from_json(text: Column) -> Column:
    """A JSON record as a struct of the known fields; null where it does not parse."""
    return F.from_json(text, KNOWN, {"mode": "PERMISSIVE"})


def fingerprint(record: Column, schema: T.StructType = KNOWN) -> Column:
    """The fingerprint of the known paths that are filled in a record (a struct of ``schema``).

    A path under a list is filled if any item has it.
    """
    present = []
    for path in known_paths(schema):
        outer, _, inner = path.partition("[].")
        value = record.getField(outer)
        filled = F.exists(value, lambda x: x.getField(inner).isNotNull()) if inner else value.isNotNull()  # noqa: B023
        present.append(F.when(filled, F.lit(path)))
    return F.sha2(F.concat_ws(",", *present), 256)


def _turns(layout: Layout, record: Column) -> Column:
    """The layout's turns of a record, as a list of (role, text)."""
    made = []
    for name in sorted({p.partition("[].")[0] for t in layout.turns for p in t.texts if "[]." in p}):
        per_item = [t for t in layout.turns if any(p.startswith(f"{name}[].") for p in t.texts)]
        made.append(F.flatten(F.transform(record.getField(name), _per_item(layout, per_item))))
    plain = [t for t in layout.turns if not any("[]." in p for p in t.texts)]
    single = [
        F.when(
            F.coalesce(*(record.getField(p) for p in t.texts)).isNotNull()
            if len(layout.turns) > 1
            else F.lit(True),
            _turn(layout, t, record.getField),
        )
        for t in plain
    ]
    head = [F.array_compact(F.array(*single))] if single else []
    return F.concat(*head, *made)


def _per_item(layout: Layout, turns: Sequence[Turn]):
    """The turns of one item of a list."""

    def of(item: Column) -> Column:
        return F.array(*(_turn(layout, t, lambda p: item.getField(p.partition("[].")[2])) for t in turns))

    return of


def _turn(layout: Layout, turn: Turn, get) -> Column:
    role = get(turn.role_path) if turn.role_path else F.lit(turn.role)
    if turn.role_path:
        lowered = F.lower(F.trim(role))
        for theirs, ours in layout.renamed.items():
            role = F.when(lowered == theirs, F.lit(ours)).otherwise(role)
    texts = [get(p) for p in turn.texts]
    text = texts[0] if len(texts) == 1 else F.concat_ws("\n\n", *texts)
    return F.struct(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )


def canonical_turns(
    records: DataFrame,
    record: Column,
    *,
    keep: Sequence[str],
    schema: T.StructType = KNOWN,
    layouts: Sequence[Layout] = LAYOUTS,
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``layout``, ``fingerprint`` and ``turns`` of each record.

    ``record`` is a struct of ``schema``, a part of ``KNOWN``.  Layouts with
    other paths than the schema has cannot match and are left out.
    """
    paths = set(known_paths(schema))
    rows = records.select(packed(records, keep), record.alias("record"))
    rows = rows.select("doc", "record", fingerprint(F.col("record"), schema).alias("fingerprint"))
    kind = "array<struct<role:string,text:string>>"
    name, turns = F.lit(None).cast("string"), F.array().cast(kind)
    for layout in layouts:
        possible = [p for t in layout.turns for p in (*t.texts, t.role_path) if p]
        have = _within(layout, paths)
        if have is None:
            continue
        chosen = F.col("fingerprint").isin(have.fingerprints())
        name = F.when(chosen, F.lit(layout.name)).otherwise(name)
        usable = all(p in paths for p in possible)
        made = _turns(have, F.col("record")) if usable else _turns(_cropped(have, paths), F.col("record"))
        turns = F.when(chosen, made.cast(kind)).otherwise(turns)
    return rows.select("doc", name.alias("layout"), "fingerprint", turns.alias("turns"))


def _within(layout: Layout, paths: set[str]) -> Layout | None:
    """The layout without the optional paths that a schema lacks; None if it lacks a required one."""
    if not set(layout.required) <= paths:
        return None
    optional = [p for p in layout.optional if p in paths]
    return Layout(layout.name, layout.required, layout.turns, optional, layout.renamed)


def _cropped(layout: Layout, paths: set[str]) -> Layout:
    """The layout's turns without paths that the schema lacks."""
    turns = []
    for t in layout.turns:
        texts = [p for p in t.texts if p in paths]
        if texts and (not t.role_path or t.role_path in paths):
            turns.append(Turn(texts, t.role, t.role_path))
        elif texts:
            turns.append(Turn(texts, ""))
    return Layout(layout.name, layout.required, turns, layout.optional, layout.renamed)


def escaped(text: Column) -> Column:
    """A text in which no control string stands any more."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    """The text that was escaped."""
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _role_name(role: Column) -> Column:
    """A role in one line."""
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(one_line)


def _role_read(name: Column) -> Column:
    # Split at the escaped backslashes first, so that the n after one stays an n.
    parts = F.split(unescaped(name), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def segments(role: Column, text: Column) -> Column:
    """A turn's mark, escaped text and end, each with its loss flag."""
    mark = F.concat(F.lit(ROLE_MARK), _role_name(role), F.lit(ROLE_END))
    for name, own in MARKS.items():
        mark = F.when(role == name, F.lit(own)).otherwise(mark)
    piece = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
    return F.array(
        piece(mark, F.lit(False)),
        piece(escaped(text), role == LOSS_ROLE),
        piece(F.lit(END), F.lit(False)),
    )


def formatted(turns: DataFrame, *, conversation: str = "conv_id", order: Sequence[str] = ("turn",)) -> DataFrame:
    """``conversation``, ``segments`` (text and loss flag) and ``output``, one row each.

    ``turns`` has the columns ``role`` and ``text`` beside those of the order.
    """
    rows = turns.select(
        column(conversation).alias("conversation"),
        F.struct(
            *(column(c).alias(f"o{i}") for i, c in enumerate(order)),
            segments(F.col("role"), F.col("text")).alias("segments"),
        ).alias("turn"),
    )
    grouped = rows.groupBy("conversation").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    opening = F.array(F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss")))
    pieces = F.concat(opening, F.flatten(F.col("turns.segments")))
    rows = grouped.select("conversation", pieces.alias("segments"))
    return rows.select(
        "conversation", "segments", F.array_join("segments.text", "").alias("output")
    )


def read_back(outputs: DataFrame) -> DataFrame:
    """``conversation``, ``output``, ``turns`` (role and text) and ``loss_text``, from output and mask."""
    body = F.substring(F.col("output"), F.lit(len(BEGIN) + 1), F.length("output"))
    parts = F.split(body, END, -1)
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), _turn_read)
    loss = F.filter("segments", lambda s: s.getField("loss"))
    return outputs.select(
        "conversation",
        "output",
        turns.alias("turns"),
        F.array_join(F.transform(loss, lambda s: unescaped(s.getField("text"))), "").alias("loss_text"),
    )


def _turn_read(part: Column) -> Column:
    end = F.instr(part, ROLE_END)
    rest = lambda begin: unescaped(F.substring(part, begin, F.length(part)))
    named = F.substring(part, F.lit(len(ROLE_MARK) + 1), end - len(ROLE_MARK) - 1)
    role, text = _role_read(named), rest(end + 1)
    for name, own in MARKS.items():
        fits = F.startswith(part, F.lit(own))
        role = F.when(fits, F.lit(name)).otherwise(role)
        text = F.when(fits, rest(F.lit(len(own) + 1))).otherwise(text)
    return F.struct(role.alias("role"), text.alias("text"))


def format_rows(rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations that come as rows of ``role`` and ``text``, formatted."""
    names = ["role", "text"]
    schema = T.StructType([T.StructField(n, _STRING) for n in names])
    # An empty role still is one; a row with neither has an empty turn.
    record = F.struct(
        column("role").cast("string").alias("role"),
        F.coalesce(column("text").cast("string"), F.lit("")).alias("text"),
    )
    made = canonical_turns(rows, record, keep=[conversation, turn], schema=schema)
    # A plain explode would have the turns made a second time, for a filter below it.
    each = made.select("doc", F.posexplode_outer("turns").alias("place", "t"))
    flat = each.where("place is not null").select(
        F.col("doc").getField(conversation).alias("conversation"),
        F.col("doc").getField(turn).alias("turn"),
        "place",
        "t.role",
        "t.text",
    )
    return formatted(flat, conversation="conversation", order=["turn", "place"])


def chat_report(rows: DataFrame, **options) -> DataFrame:
    """What is read back from each formatted conversation."""
    back = read_back(format_rows(rows, **options))
    told = F.transform(
        "turns", lambda t: F.concat(t.getField("role"), F.lit("\n"), t.getField("text"), F.lit("\n"))
    )
    return back.select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("output").cast("bigint").alias("formatted_chars"),
    )
