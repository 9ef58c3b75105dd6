"""Any record layout to one conversation schema, and the length gate behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnmill.functions.chat import total_chars
from turnmill.schema import MAX_CHARS, MESSAGES, MIN_CHARS

# The accepted question and answer keys, in order of preference.
QUESTION_KEYS = ("question", "Context", "query", "input_text")
ANSWER_KEYS = ("answer", "Response", "response", "output_text")


def _turns(*turns: tuple[str, Column]) -> Column:
    return F.array(
        *[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns]
    )


class _JsonFields:
    """Keys of a JSON record: texts from one parse to a map, presence and kind from its variant."""

    def __init__(self, texts: str, variant: str):
        self.texts, self.variant = texts, variant

    def _field(self, key: str) -> Column:
        return F.try_variant_get(F.col(self.variant), f"$.{key}", "variant")

    def present(self, key: str) -> Column:
        """The key exists, even with a JSON null."""
        return self._field(key).isNotNull()

    def text(self, key: str) -> Column:
        """The value as text; JSON null is null, booleans are spelled True/False."""
        value = F.col(self.texts)[key]
        is_bool = F.schema_of_variant(self._field(key)) == "BOOLEAN"
        return F.when(is_bool, F.initcap(value)).otherwise(value)

    def truthy(self, key: str) -> Column:
        """Neither missing, null, false, zero nor empty."""
        value = F.col(self.texts)[key]
        kind = F.schema_of_variant(self._field(key))
        number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
        return F.coalesce(
            F.when(number, value.try_cast("double") != 0)
            .when(kind == "BOOLEAN", value == "true")
            .otherwise(~value.isin("", "[]", "{}")),
            F.lit(False),
        )

    def messages(self) -> Column:
        return F.try_variant_get(F.col(self.variant), "$.messages", MESSAGES)


class _ColumnFields:
    """Keys that are columns: which ones exist is known before the query runs."""

    def __init__(self, df: DataFrame):
        self.types = dict(df.dtypes)

    def present(self, key: str) -> Column:
        return F.lit(key in self.types)

    def text(self, key: str) -> Column:
        if key not in self.types:
            return F.lit(None).cast("string")
        return F.col(f"`{key}`").cast("string")

    def truthy(self, key: str) -> Column:
        return F.coalesce(self.text(key) != "", F.lit(False))

    def messages(self) -> Column:
        if self.types.get("messages", "").startswith("array<struct"):
            return F.col("messages").cast(MESSAGES)
        return F.lit(None).cast(MESSAGES)


def _first_present(fields, keys: tuple[str, ...]) -> tuple[Column, Column]:
    any_present, text = F.lit(False), F.lit(None).cast("string")
    for key in reversed(keys):
        text = F.when(fields.present(key), fields.text(key)).otherwise(text)
        any_present = any_present | fields.present(key)
    return any_present, text


def _conversation(fields) -> tuple[Column, Column]:
    """``(shape, messages)`` by the first matching layout, null shape if none fits.

    ``messages`` reads the shape from the column ``_shape``.
    """
    chat = fields.messages()
    well_formed = chat.isNotNull() & F.forall(
        F.coalesce(chat, F.array().cast(MESSAGES)),
        lambda m: m["role"].isNotNull() & m["content"].isNotNull(),
    )
    has_question, question = _first_present(fields, QUESTION_KEYS)
    has_answer, answer = _first_present(fields, ANSWER_KEYS)
    instruction = F.when(
        fields.truthy("input"),
        F.concat(fields.text("instruction"), F.lit("\n\n"), fields.text("input")),
    ).otherwise(fields.text("instruction"))
    layouts = [
        ("chat", well_formed, chat),
        (
            "prompt",
            fields.present("prompt") & fields.present("completion"),
            _turns(("user", fields.text("prompt")), ("assistant", fields.text("completion"))),
        ),
        (
            "instruction",
            fields.present("instruction") & fields.present("output"),
            _turns(("user", instruction), ("assistant", fields.text("output"))),
        ),
        (
            "qa",
            has_question & has_answer,
            _turns(("user", question), ("assistant", answer)),
        ),
        ("text", fields.present("text"), _turns(("user", fields.text("text")))),
    ]
    shape = F.lit(None).cast("string")
    for name, fits, _ in reversed(layouts):
        shape = F.when(fits, F.lit(name)).otherwise(shape)
    # Built from the decided layout, so the conditions are evaluated once per record.
    messages = F.lit(None).cast(MESSAGES)
    for name, _, turns in layouts:
        messages = F.when(F.col("_shape") == name, turns.cast(MESSAGES)).otherwise(messages)
    return shape, messages


def resolve_id(id_text: Column, doc_id_text: Column, ordinal: Column) -> Column:
    """``id``, else ``doc_id``, else the record's position; empty counts as missing."""
    return F.coalesce(
        F.nullif(id_text.cast("string"), F.lit("")),
        F.nullif(doc_id_text.cast("string"), F.lit("")),
        ordinal.cast("string"),
    )


def _finish(df: DataFrame, fields, keep: list[str]) -> DataFrame:
    shape, messages = _conversation(fields)
    out = df.withColumn("_shape", shape).select(
        *keep,
        resolve_id(fields.text("id"), fields.text("doc_id"), F.col("_ordinal")).alias("id"),
        "_shape",
        messages.alias("_messages"),
    )
    # A null value where the layout needs text leaves the record unrecognised.
    complete = F.coalesce(
        F.forall("_messages", lambda m: m["content"].isNotNull()), F.lit(False)
    )
    return out.select(
        *keep,
        "id",
        F.when(complete, F.col("_shape")).alias("shape"),
        F.when(complete, F.col("_messages")).alias("messages"),
    )


def normalize_json(df: DataFrame, raw: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Raw JSON records with ``_ordinal`` to ``id, shape, messages``.

    ``messages`` is null for a record that fits no layout.
    """
    # A map tells keys apart by case, as a struct of them would not.
    is_object = F.col("_record").isNotNull() & F.startswith(F.ltrim(raw), F.lit("{"))
    parsed = df.withColumn("_record", F.try_parse_json(raw)).withColumn(
        "_texts", F.when(is_object, F.from_json(raw, "map<string,string>"))
    )
    return _finish(parsed, _JsonFields("_texts", "_record"), keep or ["_ordinal"])


def normalize_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed records (CSV, Parquet, text lines): the layout follows from the columns."""
    return _finish(df, _ColumnFields(df), keep or ["_ordinal"])


def _route(n_chars: Column, min_chars: int, max_chars: int) -> Column:
    return (
        F.when(n_chars.isNull(), F.lit("schema"))
        .when(n_chars < min_chars, F.lit("short"))
        .when(n_chars > max_chars, F.lit("long"))
        .otherwise(F.lit("kept"))
    )


def length_gate(
    df: DataFrame, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS
) -> DataFrame:
    """Add ``n_chars`` and ``route``: kept, schema, short or long (bounds are kept)."""
    gated = df.withColumn("n_chars", total_chars(F.col("messages")))
    return gated.withColumn("route", _route(F.col("n_chars"), min_chars, max_chars))


def gate_turns(
    turns: DataFrame,
    conv: str = "conv_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """The length gate over a turn table: one row per conversation, without its turns.

    Sums are combined before the shuffle, so a conversation of any length costs a few rows.
    """
    totals = turns.groupBy(conv).agg(
        F.count("*").alias("n_turns"),
        F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0)).alias("n_chars"),
    )
    return totals.withColumn("route", _route(F.col("n_chars"), min_chars, max_chars))


def funnel_columns() -> list[Column]:
    """The aggregates of a funnel, for one row of counts or for metrics observed on a write."""
    total, dropped = F.count("*"), F.count_if(F.col("route") == "schema")
    return [
        total.alias("total"),
        F.count_if(F.col("route") == "kept").alias("kept"),
        dropped.alias("dropped_schema"),
        F.count_if(F.col("route") == "short").alias("dropped_short"),
        F.count_if(F.col("route") == "long").alias("dropped_long"),
        (dropped / F.greatest(total, F.lit(1)) > 0.2).alias("high_schema_drop"),
    ]


def funnel_counts(routed: DataFrame, strict: bool = False) -> DataFrame:
    """One row of counts per route, with the schema-drop alarm.

    ``strict`` makes the query fail when nothing was kept.
    """
    out = routed.agg(*funnel_columns())
    if strict:
        out = out.withColumn(
            "kept",
            F.when(F.col("kept") > 0, F.col("kept")).otherwise(
                F.raise_error(F.lit("the length gate kept no rows")).cast("long")
            ),
        )
    return out


def fold_turns(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A turn table to one conversation per row, turns in order, whatever their number.

    Where only conversations that pass the length gate are wanted, use ``fold_gated``:
    it never collects the others.
    """
    one = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    messages = F.transform(
        "_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    )
    totals = [F.count("*").alias("n_turns"), F.sum(F.length(text).cast("long")).alias("n_chars")]
    return (
        turns.groupBy(conv)
        .agg(*totals, F.array_sort(F.collect_list(one)).alias("_turns"))
        .select(F.col(conv).cast("string").alias("id"), conv, messages.alias("messages"), "n_turns", "n_chars")
    )


def fold_gated(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """Every conversation with its ``route``; only kept ones are folded and have messages.

    Turns without a conversation id form one conversation too, as in ``fold_turns``.
    """
    gate = gate_turns(turns, conv, text, min_chars, max_chars)
    kept = gate.filter("route = 'kept'").select(F.col(conv).alias("_kept"))
    short_enough = turns.join(kept, F.col(conv).eqNullSafe(F.col("_kept")), "left_semi")
    folded = fold_turns(short_enough, conv, turn, role, text).withColumn("route", F.lit("kept"))
    rest = gate.filter("route <> 'kept'").select(
        F.col(conv).cast("string").alias("id"), conv, F.lit(None).cast(MESSAGES).alias("messages"),
        "n_turns", "n_chars", "route",
    )
    return folded.unionByName(rest)


def first_by_role(
    turns: DataFrame,
    roles: dict[str, str],
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per conversation the content of the first turn of each role, as the column named for it.

    One combining aggregate: conversations are not folded.
    """
    said = F.struct(F.col(role).alias("role"), F.col(text).alias("content"))
    order = F.struct(F.col(turn), said)
    firsts = [
        F.min(F.when(F.col(role) == r, order)).getField("col2").getField("content").alias(name)
        for r, name in roles.items()
    ]
    return turns.groupBy(conv).agg(*firsts)
