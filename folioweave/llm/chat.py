"""Chat formatting: schema fingerprints choose the mapping that turns a record layout into canonical turns.

A layout's fingerprint is a hash of its nested field paths, without types and independent of field order. Each known layout
declares how its fields become turns; tables get their mapping from their schema, JSON records each from their own paths.
Turns are then written with a template that marks them and escapes control strings inside texts so that it can be undone.

Everything is DataFrame expressions. A conversation is one output row, and so meets in one task like any other row. Defined
cases: a null text or role is empty; a null conversation id is a conversation of its own; turns are ordered by number (null
first), role and text, repeated rows included; a record's id may be any text, and a record without an id is a conversation
of its own; records with an unknown fingerprint go to the second result; an empty table
gives an empty result; columns that no mapping names are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

BEGIN, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<role: string, text: string>"


@dataclass(frozen=True)
class Layout:
    """A record layout: its field paths, and SQL for an array of (role, text) turns over JSON paths."""

    name: str
    paths: tuple[str, ...]
    turns: str


def _get(path: str, kind: str = "string") -> str:
    return f"try_variant_get(record, '$.{path}', '{kind}')"


def _pair(user: str, reply: str, system: str | None = None) -> str:
    parts = [("system", system)] * bool(system) + [("user", user), ("assistant", reply)]
    return "array(" + ", ".join(f"named_struct('role', '{r}', 'text', {x})" for r, x in parts) + ")"


def _messages(path: str, role: str, text: str) -> str:
    rows = _get(path, f"array<struct<{role}: string, {text}: string>>").replace("from:", "`from`:")
    said = f"lower(m.`{role}`)"
    named = f"CASE {said} WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.`{role}` END"
    return f"transform({rows}, m -> named_struct('role', {named}, 'text', m.`{text}`))"


LAYOUTS = (
    Layout("messages", ("id", "messages[]", "messages[].role", "messages[].content"),
           _messages("messages", "role", "content")),
    Layout("exchange", ("id", "conversations[]", "conversations[].from", "conversations[].value"),
           _messages("conversations", "from", "value")),
    Layout("prompt", ("id", "prompt", "response"), _pair(_get("prompt"), _get("response"))),
    Layout("completion", ("id", "prompt", "completion"), _pair(_get("prompt"), _get("completion"))),
    Layout("instruction", ("id", "instruction", "output"), _pair(_get("instruction"), _get("output"))),
    Layout("instruction with input", ("id", "instruction", "input", "output"),
           _pair(f"concat_ws('\\n\\n', {_get('instruction')}, nullif({_get('input')}, ''))", _get("output"))),
    Layout("question", ("id", "system_prompt", "question", "response"),
           _pair(_get("question"), _get("response"), _get("system_prompt"))),
)

#: Layout of a table with one turn a row: the columns that hold conversation, number, role and text.
ROW_LAYOUTS = {
    ("conv_id", "turn", "role", "text"): ("conv_id", "turn", "role", "text"),
    ("conversation_id", "index", "role", "content"): ("conversation_id", "index", "role", "content"),
}


def schema_paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; an array adds ``[]`` to its path."""
    if isinstance(kind, StructType):
        out = []
        for f in kind.fields:
            out += schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
        return out
    if isinstance(kind, ArrayType):
        inner = schema_paths(kind.elementType, f"{at}[]")
        return [f"{at}[]", *inner] if isinstance(kind.elementType, StructType) else inner
    return [at]


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    """Hash of a set of field paths."""
    from hashlib import sha256

    return sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def record_shape(record: Column) -> Column:
    """Shape of a variant: the names and nesting of its fields, without types (Spark lists fields in name order)."""
    shape = F.schema_of_variant(record)
    return F.regexp_replace(shape, r"(: |<)(?!OBJECT|ARRAY)[A-Z][A-Z_]*(\(\d+,\d+\))?(?=[,>])", "$1*")


def _shape(paths: tuple[str, ...]) -> str:
    """The shape that records with these paths have, two levels deep."""
    tops = sorted({p.split("[]")[0] for p in paths})
    parts = []
    for t in tops:
        inner = sorted(p.split("[].")[1] for p in paths if p.startswith(f"{t}[]."))
        parts.append(f"{t}: ARRAY<OBJECT<{', '.join(f'{i}: *' for i in inner)}>>" if inner else f"{t}: *")
    return f"OBJECT<{', '.join(parts)}>"


def row_turns(rows: DataFrame) -> DataFrame:
    """Canonical turns ``conv_id, turn, role, text`` of a table with one turn a row, by its schema's fingerprint.

    Further columns do not count: the layout is the one whose paths the schema has.
    """
    paths = schema_paths(rows.schema)
    known = {fingerprint(p): c for p, c in ROW_LAYOUTS.items()}
    for names in ROW_LAYOUTS:
        key = fingerprint([p for p in paths if p in names])
        if key in known:
            conv, turn, role, text = known[key]
            return rows.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                               F.col(role).alias("role"), F.col(text).alias("text"))
    raise ValueError(f"no layout has the paths {sorted(paths)}")


def record_turns(rows: DataFrame, json: str = "json", layouts: tuple[Layout, ...] = LAYOUTS) -> tuple[DataFrame, DataFrame]:
    """Canonical turns of JSON records, each by its own fingerprint; and the records no layout takes, with their shape.

    ``conv_id`` holds ids that are whole numbers. For all others it is null, and ``record_id`` tells the records apart: the id
    as text, or a new key for each record without one.
    """
    shaped = rows.select(F.col(json).alias("json"), F.try_parse_json(F.col(json)).alias("record")).withColumn(
        "print", F.xxhash64(record_shape(F.col("record")))).withColumn("shape", record_shape(F.col("record")))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for layout in layouts:
        turns = F.when(F.col("print") == F.xxhash64(F.lit(_shape(layout.paths))), F.expr(layout.turns)).otherwise(turns)
    mapped = shaped.withColumn("turns", turns)
    name = F.expr(_get("id"))
    number = name.try_cast("bigint")
    whole = F.when(number.cast("string") == name, number)
    good = mapped.where(F.col("turns").isNotNull()).select(
        whole.alias("conv_id"), F.when(whole.isNull(), F.coalesce(name, F.expr("uuid()"))).alias("record_id"), "turns")
    bad = mapped.where(F.col("turns").isNull()).select("json", "shape")
    return good.select("conv_id", "record_id", F.posexplode("turns").alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text", "record_id"), bad


def escape(text: Column) -> Column:
    """Text without control strings: ``\\`` doubles, and a ``|`` after ``<`` gets one before it."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unrole(role: Column) -> Column:
    """Undo ``_role``: cut at doubled backslashes first, so that the n of a line feed is told from a letter n."""
    parts = F.transform(F.split(role, r"\\\\", -1),
                        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(parts, "\\")


def format_turns(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments``, and ``record_id`` after ``conv_id`` if ``turns`` has it.

    ``segments`` cuts ``formatted`` into (text, loss) in order; the loss mask is the segments with ``loss``, the escaped
    texts of the ``learn`` roles.
    """
    one = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["conv_id"] + ["record_id"] * ("record_id" in turns.columns)
    rows = turns.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    parts = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(F.concat(F.lit(BEGIN), _role(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(t["text"]).alias("text"), t["role"].isin(*learn).alias("loss")),
        F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))))
    cut = rows.select(*keys, parts.alias("segments"))
    return cut.select(*keys, F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    ends = F.split(formatted, r"<\|im_end\|>\n", -1)
    blocks = F.slice(ends, F.lit(1), F.size(ends) - 1)
    return F.transform(blocks, lambda b: F.struct(
        _unrole(F.substring_index(F.replace(b, F.lit(BEGIN), F.lit("")), "\n", 1)).alias("role"),
        unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text")))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
