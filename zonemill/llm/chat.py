"""Chat formatting: heterogeneous conversation records to one tagged text with a loss mask.

Built-in functions only. A record is a VARIANT. Its fingerprint is a hash of its nested
field paths, types left out; a fingerprint selects a declarative ``Mapping`` that says
where roles and texts lie. A record whose fingerprint no mapping has gives no turns and a
NULL ``mapping``; it is kept.

Template of a turn: ``### <role>: <text></turn>`` and a line feed. Inside roles and texts
a backslash becomes ``\\b``, ``#`` becomes ``\\h`` and ``<`` becomes ``\\l`` (and ``:`` in a
role ``\\c``), so neither mark can occur in them and the escape can be undone exactly.

Defined cases: NULL text or role is the empty text; turns are ordered by turn, then role,
then text, and repeated turns all stay; NULL turn numbers come first; an empty table gives
an empty result; a NULL conversation id is a conversation of its own; columns other than
the named ones are ignored by :func:`conversations_to_records` and kept by the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
COLON_IN_ROLE = "\\c"
SCALARS = r": ?(VOID|STRING|BOOLEAN|BIGINT|INT|DOUBLE|FLOAT|DECIMAL\(\d+, ?\d+\)|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY)"
LOOSE = r"ARRAY<(VOID|STRING|BOOLEAN|BIGINT|INT|DOUBLE|FLOAT|DECIMAL\(\d+, ?\d+\)|DATE|TIMESTAMP_NTZ|TIMESTAMP|BINARY)>"
TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``messages`` is the path of an array whose items hold ``role`` and ``text`` fields.
    Without it, ``fields`` lists (role, path) pairs in turn order; a missing or NULL
    optional field makes no turn. ``roles`` renames roles (``human`` to ``user``).
    ``sample`` is a JSON record of the layout; its fingerprint is the layout's.
    """

    name: str
    sample: str
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


SHARED_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
MAPPINGS = (
    Mapping("messages", '{"messages":[{"role":"","content":""}]}', "$.messages"),
    Mapping("share", '{"conversations":[{"from":"","value":""}]}', "$.conversations", "from", "value", roles=SHARED_ROLES),
    Mapping(
        "instruction_input",
        '{"instruction":"","input":"","output":""}',
        fields=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
    ),
    Mapping(
        "instruction",
        '{"instruction":"","output":""}',
        fields=(("user", "$.instruction"), ("assistant", "$.output")),
    ),
    Mapping("prompt", '{"prompt":"","completion":""}', fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping(
        "question",
        '{"data":{"question":"","answer":""}}',
        fields=(("user", "$.data.question"), ("assistant", "$.data.answer")),
    ),
)


def field_paths(record: Column) -> Column:
    """The nested field names of a record in sorted order, without types."""
    bare = F.regexp_replace(F.schema_of_variant(record), SCALARS, "")
    return F.regexp_replace(bare, LOOSE, "ARRAY<>")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _turns(record: Column, mapping: Mapping) -> Column:
    if mapping.messages:
        kind = f"array<struct<`{mapping.role}` string, `{mapping.text}` string>>"
        items = F.try_variant_get(record, mapping.messages, kind)
        turns = F.transform(
            items,
            lambda item: F.struct(
                F.coalesce(item[mapping.role], F.lit("")).alias("role"),
                F.coalesce(item[mapping.text], F.lit("")).alias("text"),
            ),
        )
    else:
        values = [
            F.struct(F.lit(role).alias("role"), F.try_variant_get(record, path, "string").alias("text"))
            for role, path in mapping.fields
        ]
        turns = F.filter(F.array(*values), lambda turn: turn["text"].isNotNull())
    if mapping.roles:
        known = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair])
        turns = F.transform(
            turns, lambda t: F.struct(F.coalesce(known[t["role"]], t["role"]).alias("role"), t["text"].alias("text"))
        )
    return turns


def canonical_turns(df: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Add ``fingerprint``, ``mapping`` and ``turns`` (role, text) to records of any known layout."""
    seen, name, turns = F.col("fingerprint"), F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in reversed(mappings):
        known = fingerprint(F.parse_json(F.lit(mapping.sample)))
        name = F.when(seen == known, mapping.name).otherwise(name)
        turns = F.when(seen == known, _turns(F.col(record), mapping)).otherwise(turns)
    empty = F.array().cast(TURNS)
    return (
        df.withColumn("fingerprint", fingerprint(F.col(record)))
        .withColumn("mapping", name)
        .withColumn("turns", F.coalesce(turns, empty))
    )


def parse_records(df: DataFrame, text: str, record: str = "record") -> DataFrame:
    """JSON texts as records; malformed text is a NULL record."""
    return df.withColumn(record, F.try_parse_json(F.col(text)))


def conversations_to_records(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turn rows as one message record per conversation. A conversation is one text, so its turns meet in one row."""
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    ordered = F.array_sort(F.collect_list(said))
    messages = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return df.groupBy(conv_id).agg(F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit(COLON_IN_ROLE))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit(COLON_IN_ROLE), F.lit(":"))
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_chat(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` (start, length in code points, from 0) of the loss-bearing texts."""
    pieces = F.transform(
        F.col(turns),
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(COLON)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    lengths = F.transform(
        F.col("_pieces"),
        lambda p: F.struct(
            F.char_length(p["head"]).alias("head"), F.char_length(p["body"]).alias("body"), p["loss"].alias("loss")
        ),
    )
    spans = F.aggregate(
        F.col("_lengths"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start int, length int>>").alias("spans")),
        lambda done, p: F.struct(
            (done["at"] + p["head"] + p["body"] + len(CLOSE)).alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    done["spans"],
                    F.array(F.struct((done["at"] + p["head"]).alias("start"), p["body"].alias("length"))),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
        lambda done: done["spans"],
    )
    whole = F.array_join(F.transform(F.col("_pieces"), lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return (
        df.withColumn("_pieces", pieces)
        .withColumn("_lengths", lengths)
        .withColumn("formatted", whole)
        .withColumn("loss_spans", spans)
        .drop("_pieces", "_lengths")
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.slice(F.split(formatted, r"</turn>\n"), F.lit(1), F.size(F.split(formatted, r"</turn>\n")) - 1)
    return F.transform(
        parts,
        lambda part: F.struct(
            unescape(F.regexp_extract(part, r"(?s)^### (.*?): ", 1)).alias("role"),
            unescape(F.regexp_extract(part, r"(?s)^### .*?: (.*)$", 1)).alias("text"),
        ),
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
