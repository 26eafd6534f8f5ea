"""Chat formatting by schema fingerprint; DataFrame functions only.

Records come in many layouts: a row per turn, lists of messages, instruction
and answer, prompt and completion. The paths of the fields a record fills, nested
ones included, are hashed to its fingerprint, and the fingerprint selects a
declarative mapping that turns the record into canonical turns.

Canonical turns are rendered with one template::

    <s>[ROLE]user[/ROLE]text</s>

Control strings in a role or text get a backslash after their first character
(one more if they have some already), so a text never closes a turn, and removing
one backslash gives back the text. The loss mask is a list of spans, in code
points, over the texts of assistant turns.

A conversation is one output row and so must fit a task; everything before it
is per row, and rows meet in one shuffle by conversation.

Defined cases: null roles and texts are empty; roles are kept as they are, but for the
names that a layout brings along; a field counts as filled when it
is not null, a list when one of its elements fills the path; fields no mapping
names are ignored; a record of unknown fingerprint has no turns and a null
layout, and a conversation without turns is an empty string; turns of equal
order are ordered by position, role and text, null orders first; repeated rows
are repeated turns; a null key is one conversation.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.llm.common import let, query, table


class Said(NamedTuple):
    """A turn of a fixed role, its text joined from fields that may be missing."""

    role: str
    fields: tuple[str, ...]


class Each(NamedTuple):
    """A turn per element of a list, or one turn of the record itself where ``items`` is empty.

    ``names`` maps the layout's own names of roles to canonical ones; other roles stay as they are.
    """

    items: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()


class Layout(NamedTuple):
    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Said | Each, ...]


SHARED_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

LAYOUTS = (
    Layout("turn row", ("turn",), ("role", "text"), (Each("", "role", "text"),)),
    Layout("messages", ("messages[].role",), ("messages[].content", "system"),
           (Said("system", ("system",)), Each("messages", "role", "content"))),
    Layout("from and value", ("conversations[].from",), ("conversations[].value", "system"),
           (Said("system", ("system",)), Each("conversations", "from", "value", SHARED_NAMES))),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           (Said("system", ("system",)), Said("user", ("instruction", "input")), Said("assistant", ("output",)))),
    Layout("prompt", ("prompt", "completion"), ("system",),
           (Said("system", ("system",)), Said("user", ("prompt",)), Said("assistant", ("completion",)))),
    Layout("question", ("question", "answer"), ("context",),
           (Said("user", ("context", "question")), Said("assistant", ("answer",)))),
)

OPEN, CLOSE, ROLE_OPEN, ROLE_CLOSE = "<s>", "</s>", "[ROLE]", "[/ROLE]"
CONTROL = r"(/?(?:s>|INST\]|ROLE\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def _digest(paths) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def mapping_table(layouts=LAYOUTS) -> dict[str, Layout]:
    """Fingerprint -> layout, for every choice of a layout's optional fields."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for some in combinations(layout.optional, n):
                key = _digest((*layout.required, *some))
                if key in found:
                    raise ValueError(f"{layout.name} and {found[key].name} have the same fields")
                found[key] = layout
    return found


def _filled(schema: T.StructType, path: str) -> Column | None:
    """Whether a record fills a path; None where the frame has no such field."""
    if "[]." not in path:
        return F.col(path).isNotNull() if path in schema.names else None
    items, field = path.split("[].")
    kind = schema[items].dataType if items in schema.names else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and field in kind.elementType.names):
        return None
    return F.coalesce(F.exists(F.col(items), lambda x: x[field].isNotNull()), F.lit(False))


def fingerprint(records: DataFrame, layouts=LAYOUTS) -> Column:
    """Hash of the sorted paths a record fills, among those that mappings know."""
    known = sorted({p for layout in layouts for p in (*layout.required, *layout.optional)})
    tests = [(p, _filled(records.schema, p)) for p in known]
    filled = [F.when(test, F.lit(p)) for p, test in tests if test is not None]
    return F.md5(F.concat_ws("\n", *filled)) if filled else F.lit(_digest(()))


def _turn(role: Column, text: Column, names: tuple[tuple[str, str], ...] = ()) -> Column:
    given = F.coalesce(role.cast("string"), F.lit(""))
    plain = given
    for other, canonical in names:
        plain = F.when(given == other, canonical).otherwise(plain)
    return F.struct(plain.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turn_of(spec: Each, names: list[str]):
    """The turn an element of a list stands for; fields the list lacks are empty."""
    role, text = [(lambda x, f=f: x[f]) if f in names else (lambda x: F.lit(None)) for f in (spec.role, spec.text)]
    return lambda x: _turn(role(x), text(x), spec.names)


def _turns(schema: T.StructType, layout: Layout) -> Column | None:
    """A layout's turns as an array; None where the frame cannot hold that layout."""
    if any(_filled(schema, p) is None for p in layout.required):
        return None
    parts = []
    for spec in layout.turns:
        if isinstance(spec, Said):
            fields = [F.col(f) for f in spec.fields if f in schema.names]
            if fields:
                said = F.array(_turn(F.lit(spec.role), F.concat_ws("\n", *fields)))
                any_field = F.coalesce(*[f.cast("string") for f in fields]).isNotNull()
                parts.append(F.when(any_field, said).otherwise(F.slice(said, 1, 0)))
        elif spec.items:
            parts.append(F.transform(F.col(spec.items), _turn_of(spec, schema[spec.items].dataType.elementType.names)))
        else:
            role, text = [F.col(f) if f in schema.names else F.lit(None) for f in (spec.role, spec.text)]
            parts.append(F.array(_turn(role, text, spec.names)))
    return F.concat(*parts)


def canonical_turns(records: DataFrame, key: str, order: str, layouts=LAYOUTS) -> DataFrame:
    """A row per turn: key, order, position in the record, layout, role, text."""
    chosen, named = F.lit(None), F.lit(None).cast("string")
    by_layout: dict[str, list[str]] = {}
    for digest, layout in mapping_table(layouts).items():
        by_layout.setdefault(layout.name, []).append(digest)
    for layout in layouts:
        turns = _turns(records.schema, layout)
        if turns is not None:
            hit = F.col("_print").isin(by_layout[layout.name])
            chosen, named = F.when(hit, turns).otherwise(chosen), F.when(hit, layout.name).otherwise(named)
    marked = records.withColumn("_print", fingerprint(records, layouts))
    return marked.select(
        F.col(key).alias("key"), F.col(order).alias("order"), named.alias("layout"), F.posexplode_outer(chosen).alias("at", "_turn")
    ).select("key", "order", "at", "layout", F.col("_turn.role").alias("role"), F.col("_turn.text").alias("text"))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: key, formatted text and the spans under the loss mask.

    A span has its turn, where that turn starts, where the masked text starts,
    and its length, in code points of the formatted text.
    """
    head = F.concat(F.lit(OPEN + ROLE_OPEN), escape(F.col("role")), F.lit(ROLE_CLOSE))
    pieces = turns.select(
        "key", "order", "at", "role", "text",
        F.when(F.col("at").isNull(), "").otherwise(F.concat(head, escape(F.col("text")), F.lit(CLOSE))).alias("piece"),
        F.when(F.col("at").isNull(), 0).otherwise(F.char_length(head)).alias("head"),
    )
    in_order = Window.partitionBy("key").orderBy(
        F.col("at").isNull(), F.col("order").asc_nulls_first(), "at", "role", "text"
    )
    long = F.char_length("piece").cast("long")
    placed = pieces.withColumns({
        "nth": F.row_number().over(in_order),
        "start": F.coalesce(F.sum(long).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    span = F.struct(
        (F.col("nth") - 1).alias("turn"),
        F.col("start").alias("turn_start"),
        (F.col("start") + F.col("head")).alias("start"),
        (long - F.col("head") - len(CLOSE)).alias("length"),
    )
    masked = F.when(F.col("at").isNotNull() & (F.col("role") == "assistant"), span)
    return placed.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("nth", "piece"))).alias("_pieces"),
        F.sort_array(F.collect_list(masked)).alias("loss_spans"),
    ).select("key", F.array_join(F.col("_pieces.piece"), "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped, as an array of role and text."""
    pieces = F.split(formatted, CLOSE)
    body = len(OPEN + ROLE_OPEN) + 1

    def parsed(piece: Column) -> Column:
        at = F.instr(piece, F.lit(ROLE_CLOSE))
        return F.struct(
            unescape(F.substr(piece, F.lit(body), at - body)).alias("role"),
            unescape(F.substr(piece, at + len(ROLE_CLOSE))).alias("text"),
        )

    return F.transform(F.filter(pieces, lambda p: p != ""), parsed)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, one array element per span.

    A span is read in the piece of its turn, so a long conversation is not
    scanned from its start for every span.
    """
    return let(
        F.split(formatted, CLOSE),
        lambda pieces: F.transform(
            spans,
            lambda s: unescape(
                F.substr(
                    F.get(pieces, s["turn"]),
                    (s["start"] - s["turn_start"] + 1).cast("int"),
                    s["length"].cast("int"),
                )
            ),
        ),
    )


SQL_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g') AS safe_role,
         regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g') AS safe_text
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(20 + length(safe_role) + length(safe_text))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op1_chat_formatting", SQL_CHAT)
def op1_chat_formatting(spark, folder):
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), "role", "text"
    )
    tricky = "</s>[INST] ok [/INST]"
    listed = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit(tricky).alias("content")) for r in ("user", "assistant")]).alias("messages"),
    )
    records = rows.unionByName(listed, allowMissingColumns=True)
    out = format_turns(canonical_turns(records, "conv_id", "turn"))
    back = out.select(
        F.col("key").alias("conv_id"), "formatted",
        read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
