"""Chat formatting: schema fingerprints select declarative mappings into canonical turns, in built-in expressions."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# Strings that chat templates give a meaning to. All start with < or [ and end with > or ].
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
START, END = "<|im_start|>", "<|im_end|>"

_REST = "|".join(c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROL)
_PLAIN = rf"([<\[])(\\*+)({_REST})"
_ESCAPED = rf"([<\[])\\(\\*+)({_REST})"

TURNS = "array<struct<role:string,text:string>>"


def escaped(text: Column) -> Column:
    """Control strings broken by a backslash after their first character; one more where there are some already."""
    return F.regexp_replace(text, F.lit(_PLAIN), F.lit(r"$1$2\\$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def _role_out(role: Column) -> Column:
    """On one line: a backslash becomes \\b, a line end \\n."""
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, sorted; array levels show as ``[]``."""
    if isinstance(kind, StructType):
        return sorted(p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, ArrayType):
        return paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(field_paths: list[str]) -> str:
    """Hash of sorted field paths."""
    return hashlib.sha256("\n".join(sorted(field_paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """How records of one layout become turns.

    ``fields``: (role, path) pairs, a turn for each path that is not empty, in order; or ``turns``: (path of the list,
    name of the role field, name of the text field). ``roles`` renames roles.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    turns: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        if self.turns:
            return sorted(f"{self.turns[0]}[].{name}" for name in self.turns[1:])
        return sorted(path for _, path in self.fields)

    def listed(self, items: Column) -> Column:
        """Turns of a list of them."""
        _, role, text = self.turns
        return F.transform(items, lambda t: F.struct(self._role(t[role]).alias("role"), _text(t[text]).alias("text")))

    def canonical(self, record: Column) -> Column:
        """Turns of a variant column."""
        if self.turns:
            at, role, text = self.turns
            kind = f"array<struct<`{role}`:string,`{text}`:string>>"
            return self.listed(F.coalesce(F.try_variant_get(record, f"$.{at}", kind), F.array().cast(kind)))
        turns = F.array(*(
            F.struct(F.lit(role).alias("role"), _text(F.try_variant_get(record, f"$.{path}", "string")).alias("text"))
            for role, path in self.fields
        ))
        return F.filter(turns, lambda t: t["text"] != "")

    def _role(self, role: Column) -> Column:
        out = role
        for old, new in self.roles:
            out = F.when(role == old, F.lit(new)).otherwise(out)
        return F.coalesce(out, F.lit(""))


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


SHARED_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping("prompt", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", (("user", "prompt"), ("assistant", "response"))),
    Mapping("question", (("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", (("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("short_instruction", (("user", "instruction"), ("assistant", "output"))),
    Mapping("messages", turns=("messages", "role", "content"), roles=SHARED_NAMES),
    Mapping("shared", turns=("conversations", "from", "value"), roles=SHARED_NAMES),
    Mapping("rows", turns=("turns", "role", "text")),
)
# A table with one row per turn; its conversations are gathered first.
ROW_PATHS = ["conv_id", "role", "text", "turn"]


# What the text of a record's shape is made of: a field's name, an opened or closed level, or the type of a leaf.
_SHAPE = r"(?:`(?:[^`]|``)*+`|[A-Za-z0-9_]++): |OBJECT<|ARRAY<|>|[A-Z][A-Z_ ]*(?:\([0-9, ]*\))?"


def record_paths(record: Column) -> Column:
    """Sorted field paths of each record, a variant, as ``paths`` gives them for a type, at any depth.

    Names that are no plain identifiers stand in backticks.
    """
    parts = F.regexp_extract_all(F.schema_of_variant(record), F.lit(_SHAPE), F.lit(0))
    none = F.array().cast("array<string>")

    def read(so_far: Column, part: Column) -> Column:
        at, levels = so_far["at"], so_far["levels"]
        above = F.coalesce(F.try_element_at(levels, F.lit(-1)), F.lit(""))
        name = F.substring(part, F.lit(1), F.length(part) - 2)
        is_name, opens = part.endswith(": "), part.isin("OBJECT<", "ARRAY<")
        here = (
            F.when(is_name, F.when(above == "", name).otherwise(F.concat(above, F.lit("."), name)))
            .when(part == "ARRAY<", F.concat(at, F.lit("[]")))
            .otherwise(at)
        )
        return F.struct(
            here.alias("at"),
            F.when(opens, F.concat(levels, F.array(here)))
            .when(part == ">", F.slice(levels, F.lit(1), F.size(levels) - 1))
            .otherwise(levels)
            .alias("levels"),
            F.when(is_name | opens | (part == ">"), so_far["found"]).otherwise(F.concat(so_far["found"], F.array(at))).alias("found"),
        )

    start = F.struct(F.lit("").alias("at"), none.alias("levels"), none.alias("found"))
    return F.array_sort(F.aggregate(parts, start, read, lambda x: x["found"]))


def canonical_records(df: DataFrame, record: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The rows with ``fingerprint``, ``layout`` and ``turns`` added; ``record`` is a JSON text or variant column.

    Each record's nested field paths are hashed; the mapping whose paths have that hash makes the turns. A record that
    is null, no JSON, or of an unknown layout keeps its fingerprint and gets a null layout and no turns.
    """
    is_variant = df.schema[record].dataType.typeName() == "variant"
    parsed = F.col(record) if is_variant else F.try_parse_json(F.col(record))
    marked = df.withColumn("__record", parsed).withColumn(
        "fingerprint", F.sha2(F.array_join(record_paths(F.col("__record")), "\n"), 256)
    )
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for m in mappings:
        fits = F.col("fingerprint") == fingerprint(m.paths())
        layout, turns = F.when(fits, F.lit(m.name)).otherwise(layout), F.when(fits, m.canonical(F.col("__record"))).otherwise(turns)
    return marked.withColumns({"layout": layout, "turns": turns}).drop("__record")


def canonical_rows(df: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` of a table with the columns conv_id, turn, role and text, one row per turn.

    Turns are in order of turn, then role and text; a null turn comes first, null role and text are empty, repeated
    rows are repeated turns, rows with a null conv_id are one conversation. A conversation becomes one value, as its
    formatted text must; that is the one thing gathered by key here. The gathered records have a list of turns, whose
    field paths are hashed to select the mapping, as those of any record. They stay typed, as a variant has a size limit.
    """
    rows = df.select("conv_id", F.struct("turn", _text(F.col("role")).alias("role"), _text(F.col("text")).alias("text")).alias("t"))
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    records = rows.groupBy("conv_id").agg(F.struct(ordered.alias("turns")).alias("record"))
    shape = fingerprint(paths(records.schema["record"].dataType))
    mapping = next(m for m in MAPPINGS if fingerprint(m.paths()) == shape)
    return records.select("conv_id", mapping.listed(F.col("record")[mapping.turns[0]]).alias("turns"))


def canonical(df: DataFrame, record: str | None = None, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turns of any supported table: of a record column, by each record's fingerprint, or of the table's own columns.

    Tables with one row per turn are told by their columns and may have further ones; their rows are gathered to records
    first. Other typed tables must have a mapping's field paths exactly.
    """
    if record:
        return canonical_records(df, record, mappings)
    if set(ROW_PATHS) <= set(df.columns):
        return canonical_rows(df)
    own = paths(df.schema)
    for m in mappings:
        if m.paths() == own:
            return df.withColumn("turns", m.canonical(F.to_variant_object(F.struct(*df.columns))))
    raise ValueError(f"no mapping for the field paths {own}")


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """``segments`` and ``formatted`` added: the template's text, and its cut into pieces with a loss flag.

    Each turn is a start mark, the role, a line end, the text, an end mark and a line end. Control strings in roles and
    texts are escaped, so marks are only what the template sets. The loss mask covers the texts of assistant turns:
    ``segments`` is an array of (text, loss) whose texts make up ``formatted``. No turns give an empty text.
    """
    segments = F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")),
    )))
    return df.withColumn("segments", segments).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(text: Column) -> Column:
    """Turns of a formatted text."""
    parts = F.slice(F.split(text, START.replace("|", r"\|"), -1), 2, 1 << 30)

    def turn(part: Column) -> Column:
        cut = F.locate("\n", part)
        body = F.substring(part, cut + 1, F.length(part) - cut - F.lit(len(END) + 1))
        return F.struct(_role_in(F.substring(part, F.lit(1), cut - 1)).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: str) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
