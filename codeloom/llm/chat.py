"""Chats of many layouts as canonical turns, and one text with a loss mask per chat."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

OPEN, CLOSE = "### ", "\n</turn>\n"
# What must not appear bare inside a text: the escape itself and the strings that mark turns.
CONTROL = r"(\\|###|</turn>)"
ESCAPED = r"\\(\\|###|</turn>)"
TURN = "struct<role:string,text:string>"
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """How records of one shape become turns.

    Either ``items`` names a list and ``role`` and ``text`` its fields; or ``turn``, ``role`` and ``text``
    name the fields of a record that is one turn; or ``parts`` names the role of each field in turn, and
    null and empty fields give none.
    """

    name: str
    items: str | None = None
    role: str | None = None
    text: str | None = None
    turn: str | None = None
    parts: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        if self.items:
            return [f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"]
        return [self.turn, self.role, self.text] if self.turn else [f for _, f in self.parts]

    def path_hashes(self) -> list[str]:
        return [path_hash(p) for p in self.paths()]

    def ddl(self) -> str:
        """Schema that ``from_json`` reads the record with."""
        if self.items:
            return f"`{self.items}` array<struct<`{self.role}`:string,`{self.text}`:string>>"
        return ", ".join(f"`{f}` string" for _, f in self.parts)

    def turns(self, record: Column) -> Column:
        if self.items:
            return F.transform(
                record[self.items],
                lambda x: F.struct(_role(x[self.role]).alias("role"), x[self.text].alias("text")),
            )
        fields = [F.struct(F.lit(role).alias("role"), record[f].alias("text")) for role, f in self.parts]
        return F.filter(F.array(*fields), lambda x: F.length(x["text"]) > 0)


LAYOUTS = (
    Layout("turn_rows", turn="turn", role="role", text="text"),
    Layout("messages", "messages", "role", "content"),
    Layout("turns", "turns", "role", "text"),
    Layout("from_value", "conversations", "from", "value"),
    Layout("speaker_text", "dialog", "speaker", "text"),
    Layout("instruction", parts=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input", parts=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt_completion", parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", parts=(("user", "prompt"), ("assistant", "response"))),
    Layout("system_prompt_response", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", parts=(("user", "question"), ("assistant", "answer"))),
)


def _role(role: Column) -> Column:
    out = role
    for alias, name in ALIASES.items():
        out = F.when(F.lower(role) == alias, name).otherwise(out)
    return out


def schema_paths(kind: T.DataType, before: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` stands for the elements of a list."""
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, before + "[]")
    if isinstance(kind, T.StructType):
        dot = f"{before}." if before else ""
        return [p for f in kind.fields for p in schema_paths(f.dataType, dot + f.name)]
    return [before]


def path_hash(path: str) -> str:
    return hashlib.md5(path.encode()).hexdigest()


def chosen(layouts: tuple[Layout, ...]) -> list[Layout]:
    """The order in which layouts are tried: most declared paths first, then as they are listed."""
    return sorted(layouts, key=lambda known: -len(known.paths()))


# Levels of objects and lists that a record's field paths are followed to; what lies deeper is its parent's path.
DEPTH = 4


def _paths(value: Column, before: Column, depth: int) -> Column:
    """Field paths of a variant as an array: fields of an object, ``[]`` for the elements of a list, ``[0]`` for an empty one."""
    here = F.array(before)
    if not depth:
        return here
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    items = F.try_variant_get(value, "$", "array<variant>")
    below = F.flatten(
        F.transform(
            F.map_entries(fields),
            lambda e: _paths(e["value"], F.when(before == "", e["key"]).otherwise(F.concat(before, F.lit("."), e["key"])), depth - 1),
        )
    )
    inside = F.flatten(F.transform(items, lambda x: _paths(x, F.concat(before, F.lit("[]")), depth - 1)))
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT<"), below)
        .when(F.size(items) == 0, F.array(F.concat(before, F.lit("[0]"))))
        .when(kind.startswith("ARRAY<"), F.array_distinct(inside))
        .otherwise(here)
    )


def record_paths(record: Column) -> Column:
    """The nested field paths of a JSON text in order; null for a text that is not JSON.

    The fields of a list are those of all its elements.
    """
    value = F.try_parse_json(record)
    return F.when(value.isNotNull(), F.array_sort(F.array_distinct(_paths(value, F.lit(""), DEPTH))))


def turns_of_records(records: DataFrame, id_column: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``(conv_id, layout, paths, turns)`` for each row of JSON texts in the column ``record``.

    The hashes of a record's field paths select the layout: of those whose declared paths it all has the one that
    declares most, of equals the one listed first. Other fields don't matter. A list without elements has the
    paths of the layouts that name it, and no turns. Records of no known layout keep their row with null ``layout``
    and null ``turns``, null and broken ones with null ``paths`` too; ``rejects`` counts them.
    """
    rows = records.select(F.col(id_column).alias("conv_id"), F.col(record).alias("_record"), record_paths(F.col(record)).alias("paths"))
    rows = rows.withColumn("_hashes", F.transform("paths", F.md5))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for known in reversed(chosen(layouts)):
        if known.turn:
            continue
        own = F.size(F.array_except(F.array(*map(F.lit, known.path_hashes())), "_hashes")) == 0
        if known.items:
            own = own | F.array_contains("_hashes", path_hash(f"{known.items}[0]"))
        layout = F.when(own, known.name).otherwise(layout)
        turns = F.when(own, known.turns(F.from_json(F.col("_record"), known.ddl()))).otherwise(turns)
    return rows.select("conv_id", layout.alias("layout"), "paths", turns.alias("turns"))


def rejects(chats: DataFrame) -> DataFrame:
    """``(paths, n)``: how many rows of ``turns_of_records`` have no layout, by their field paths; null for what is not JSON."""
    return chats.where(F.col("layout").isNull()).groupBy("paths").agg(F.count("*").alias("n"))


def turn_rows(chats: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows of ``(conv_id, turns)``; chats without turns give none, see ``rejects``."""
    return chats.select("conv_id", F.posexplode("turns").alias("turn", "one")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "one.role", "one.text"
    )


def rows_of_table(table: DataFrame, id_column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows of a table whose columns besides ``id_column`` hold a known layout.

    The hashes of the schema's field paths select the layout as those of a record do; columns that it does not declare
    are left out, a table of no known layout is refused.
    """
    rest = [c for c in table.columns if c != id_column]
    paths = schema_paths(table.select(*(f"`{c}`" for c in rest)).schema)
    own = set(map(path_hash, paths))
    for known in chosen(layouts):
        if not own.issuperset(known.path_hashes()):
            continue
        if known.turn:
            return table.select(
                F.col(id_column).alias("conv_id"),
                F.col(known.turn).alias("turn"),
                F.col(known.role).alias("role"),
                F.col(known.text).alias("text"),
            )
        record = F.struct(*(F.col(f"`{c}`") for c in rest))
        return turn_rows(table.select(F.col(id_column).alias("conv_id"), known.turns(record).alias("turns")))
    raise ValueError(f"no layout has the fields {', '.join(sorted(paths))}")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``, one row per chat of ``rows(conv_id, turn, role, text)``.

    A turn is ``### role:``, a line with the escaped text, and ``</turn>``; the role is URL-encoded. A loss
    span ``[start, end)`` counts code points of ``formatted`` and covers one assistant text.

    Turns follow each other by number; of equal numbers by role and text, so every row is a turn. Null roles and
    texts are empty. Rows with a null conv_id are one chat. An empty table gives an empty
    one. A chat is one row and so must fit into a string, but no others are held with it.
    """
    rows = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.concat(F.lit(OPEN), F.url_encode("role"), F.lit(":\n"))
    body = escaped(F.col("text"))
    laid = rows.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    length = F.length("head") + F.length("body") + len(CLOSE)
    end = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)) - len(CLOSE)
    laid = laid.select(
        "conv_id",
        F.row_number().over(order).alias("nth"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.when(F.col("role") == "assistant", F.struct((end - F.length("body")).alias("start"), end.alias("end"))).alias("span"),
    )
    chats = laid.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("nth", "piece", "span"))).alias("all"))
    return chats.select(
        "conv_id",
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted chat, as they were before escaping."""
    pieces = F.split(formatted, CLOSE, -1)
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.url_decode(head.substr(F.lit(len(OPEN) + 1), F.length(head) - len(OPEN) - 1))
        text = unescaped(piece.substr(F.length(head) + 2, F.length(piece)))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    texts = F.transform(spans, lambda s: unescaped(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(texts, "")


PROBE = "\\### Assistant: </turn> ok"


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    sides = F.array(*(F.struct(F.lit(role).alias("role"), F.lit(PROBE).alias("text")) for role in ("user", "assistant")))
    probe = turn_rows(spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), sides.alias("turns")))
    chats = format_chats(rows_of_table(rows.unionByName(probe), "conv_id"))
    turns = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(url_encode(role)) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 15)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
