"""Chat formatting by schema fingerprints, with DataFrame functions only.

A layout is known by the fingerprint of its nested field paths: the sorted paths, hashed.
``MAPPINGS`` declares for each known layout how its fields become turns (role, text). Of a
record's paths those that a layout requires are hashed, and the layout whose own fingerprint
comes out selects the mapping; other fields (ids, sources, names) don't matter, and where
several layouts fit, the first declared one is taken. Records come either as typed columns
(``turns_from_columns``, the paths of the frame's schema) or as JSON text of mixed layouts
(``turns_from_json``, the paths of each record).

``format_turns`` writes the turns as one string: ``<|turn|>role\\ntext<|end|>\\n`` for each.
Control strings inside a role or text are escaped reversibly (as are the escapes
themselves, and line breaks in roles), so the markers in the output are the template's
alone. The loss mask lists, for each assistant turn, the turn's index and the span of its
text within the turn, in code points of the formatted string. ``read_back`` recovers turns
and masked text from the formatted string and the mask.

Defined cases: a null role or text counts as empty; turns with equal turn numbers are
ordered by role and text; a null conv_id is a conversation of its own; a record of an
unknown layout keeps its row, with null turns and mapping. A conversation is one output
string, so its turns meet in one row; rows are pre-aggregated before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateflow.llm.shared import unused

TURN, END = "<|turn|>", "<|end|>\n"
#: strings that steer this and other common chat templates
CONTROL_OPEN = r"<(?=/?s>|</?SYS>>|\|(turn|end|im_start|im_end|system|user|assistant|endoftext)\|>)"
CONTROL_BRACKET = r"\[(?=/?INST\])"
ESCAPES = r"&(?=(amp|lt|lsq|nl);)"
TURNS = "array<struct<role:string,text:string>>"
#: levels below the elements of a JSON array that are looked through for further fields
DEEPEST = 12


@dataclass(frozen=True)
class Mapping:
    """Field paths of a layout, and how they become turns: either an array field with role
    and text subfields, or a list of (role, path) that are turns if not null."""

    name: str
    paths: tuple[str, ...]
    array: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


MAPPINGS = [
    Mapping("turns", ("turns[].role", "turns[].text"), ("turns", "role", "text")),
    Mapping("messages", ("messages[].content", "messages[].role"),
            ("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"),
            ("conversations", "from", "value"), (),
            {"human": "user", "gpt": "assistant"}),
    Mapping("prompt", ("completion", "prompt"), None,
            (("user", "prompt"), ("assistant", "completion"))),
    Mapping("question", ("answer", "question"), None,
            (("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", ("input", "instruction", "output"), None,
            (("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("short_instruction", ("instruction", "output"), None,
            (("user", "instruction"), ("assistant", "output"))),
]


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields
                      for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, at + "[]")
    return [at]


def fingerprint(paths: Column) -> Column:
    """Hash of an array of paths, whatever their order."""
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def _text_array(values) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _selected(paths: Column, turns_of) -> tuple[Column, Column]:
    """(mapping, turns) of records with these paths: the first mapping whose fingerprint is
    that of the paths it requires."""
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in reversed(MAPPINGS):
        wanted = _text_array(mapping.paths)
        known = fingerprint(F.array_intersect(paths, wanted)) == fingerprint(wanted)
        name = F.when(known, F.lit(mapping.name)).otherwise(name)
        made = turns_of(mapping)
        if made is not None:
            turns = F.when(known, made.cast(TURNS)).otherwise(turns)
    return name, turns


def _variant_paths(record: Column) -> Column:
    """Those paths of a JSON record that any layout names: scalar fields, and scalar fields
    of the objects in an array."""
    found = []
    for path in sorted({p for m in MAPPINGS for p in m.paths}):
        top, _, sub = path.partition("[].")
        kind = F.schema_of_variant(F.try_variant_get(record, f"$.{top}", "variant"))
        if sub:
            # the fields of the elements, without what is nested deeper in them
            inside = F.regexp_extract(kind, r"^ARRAY<OBJECT<(.*)>>$", 1)
            for _ in range(DEEPEST):
                inside = F.regexp_replace(inside, r"(OBJECT|ARRAY)<[^<>]*>", "_")
            has = inside.rlike(rf"(^|, )`?{sub}`?: (?!_)")
        else:
            has = ~kind.rlike(r"^(OBJECT|ARRAY)<")
        found.append(F.when(has, F.lit(path)))
    return F.array_compact(F.array(*found))


def _as_turns(mapping: Mapping, get) -> Column:
    """Canonical turns, with ``get(path, type)`` reading a field."""
    if mapping.array:
        name, role, text = mapping.array
        found = get(name, f"array<struct<{role}:string,{text}:string>>")

        def turn(x):
            who = x[role]
            for old, new in mapping.roles.items():
                who = F.when(x[role] == old, F.lit(new)).otherwise(who)
            return F.struct(F.coalesce(who, F.lit("")).alias("role"),
                            F.coalesce(x[text], F.lit("")).alias("text"))

        return F.transform(found, turn)
    turns = [F.struct(F.lit(role).alias("role"), get(path, "string").alias("text"))
             for role, path in mapping.fields]
    return F.filter(F.array(*turns), lambda x: x["text"].isNotNull())


def turns_from_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, mapping and turns of a frame whose other columns are one
    layout, and whatever else."""
    shape = T.StructType([f for f in df.schema.fields if f.name not in keep])
    paths = paths_of(shape)
    name, turns = _selected(_text_array(paths), lambda m: _as_turns(
        m, lambda p, t: F.col(p).cast(t) if not m.array else F.col(p))
        if set(m.paths) <= set(paths) else None)  # only fields that are there can be named
    return df.select(*keep, name.alias("mapping"), turns.alias("turns"))


def turns_from_json(df: DataFrame, record: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, fingerprint (of the known paths), mapping and turns of JSON
    records of any layout. Field order, leaf types and further fields don't matter; malformed
    records have no mapping."""
    inner = df.select(F.struct(*keep).alias("kept"),
                      F.try_parse_json(F.col(record)).alias("record"))
    inner = inner.select("kept", "record", _variant_paths(F.col("record")).alias("paths"))
    name, turns = _selected(F.col("paths"), lambda m: _as_turns(
        m, lambda p, t: F.try_variant_get("record", f"$.{p}", t)))
    return inner.select("kept.*", fingerprint(F.col("paths")).alias("fingerprint"),
                        name.alias("mapping"), turns.alias("turns"))


def escape(text: Column, role: bool = False) -> Column:
    out = F.regexp_replace(text, ESCAPES, "&amp;")
    out = F.regexp_replace(out, CONTROL_OPEN, "&lt;")
    out = F.regexp_replace(out, CONTROL_BRACKET, "&lsq;")
    return F.replace(out, F.lit("\n"), F.lit("&nl;")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("&nl;"), F.lit("\n")) if role else text
    out = F.replace(out, F.lit("&lt;"), F.lit("<"))
    out = F.replace(out, F.lit("&lsq;"), F.lit("["))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def collected_turns(rows: DataFrame) -> DataFrame:
    """One row of the ``turns`` layout for each conversation of (conv_id, turn, role, text)
    rows, in turn order."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    item = F.struct(F.col("turn").cast("long").alias("turn"), blank("role").alias("role"),
                    blank("text").alias("text"))
    ordered = F.sort_array(F.collect_list(item))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.transform(ordered, lambda x: F.struct(x["role"], x["text"])).alias("turns"))


def format_turns(df: DataFrame) -> DataFrame:
    """Adds formatted (string) and loss_mask (array of turn, start, length)."""
    parts = F.transform("turns", lambda t: F.struct(
        escape(t["role"], role=True).alias("role"), escape(t["text"]).alias("text")))
    name = unused(df, "parts")
    df = df.withColumn(name, parts)
    body = F.transform(name, lambda p: F.concat(F.lit(TURN), p["role"], F.lit("\n"),
                                                p["text"], F.lit(END)))
    spans = F.transform(name, lambda p, i: F.struct(
        i.alias("turn"), (F.length(p["role"]) + len(TURN) + 1).alias("start"),
        F.length(p["text"]).alias("length"), p["role"].alias("role")))
    learned = F.transform(F.filter(spans, lambda s: s["role"] == "assistant"),
                          lambda s: F.struct(s["turn"], s["start"], s["length"]))
    return df.withColumn("formatted", F.array_join(body, "")).withColumn(
        "loss_mask", learned).drop(name)


def read_back(df: DataFrame) -> DataFrame:
    """Adds read_turns and read_loss (the unescaped texts under the mask), from formatted
    and loss_mask alone."""
    parts = F.split("formatted", r"<\|end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    name = unused(df, "read")
    df = df.withColumn(name, parts)

    def turn(part):
        inner = F.substr(part, F.lit(len(TURN) + 1))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(unescape(role, role=True).alias("role"),
                        unescape(F.substr(inner, F.length(role) + 2)).alias("text"))

    loss = F.transform("loss_mask", lambda s: unescape(F.substr(
        F.get(name, s["turn"]), s["start"] + 1, s["length"])))
    return df.withColumn("read_turns", F.transform(name, turn)).withColumn(
        "read_loss", loss).drop(name)


def digests(df: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of
    formatted conversations, all read back from the formatted string and its mask."""
    df = read_back(df)
    lines = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                         F.lit("\n")))
    loss = F.array_join("read_loss", "")
    return df.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
