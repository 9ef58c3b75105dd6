"""Views of a conversation: joined texts, rendered templates, first turns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from turnmill.functions.text import strip


def total_chars(messages: Column) -> Column:
    """Sum of content lengths in code points."""
    return F.aggregate(
        messages, F.lit(0).cast("long"), lambda n, m: n + F.length(m["content"]).cast("long")
    )


def row_text(messages: Column) -> Column:
    """All contents in one string, the text that gets embedded."""
    return F.array_join(F.transform(messages, lambda m: m["content"]), " \n ")


def review_text(messages: Column) -> Column:
    """The conversation as a reviewer reads it: ``[ROLE]`` above each content."""
    return F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit("["),
                F.upper(F.coalesce(m["role"], F.lit("user"))),
                F.lit("]\n"),
                F.coalesce(m["content"], F.lit("")),
            ),
        ),
        "\n\n",
    )


@dataclass(frozen=True)
class ChatTemplate:
    """How one model family frames its turns.

    ``{role}`` in ``turn_open`` is replaced by the role. ``roles`` renames roles,
    ``default_system`` is put first when a conversation has no system turn.
    """

    turn_open: str
    turn_close: str
    begin: str = ""
    strip_content: bool = False
    default_system: str | None = None
    roles: Mapping[str, str] = field(default_factory=dict)

    def header(self, role: Column) -> Column:
        for src, dst in self.roles.items():
            role = F.when(role == src, F.lit(dst)).otherwise(role)
        before, _, after = self.turn_open.partition("{role}")
        return F.concat(F.lit(before), role, F.lit(after))


# Two published chat formats.
CHATML = ChatTemplate(turn_open="<|im_start|>{role}\n", turn_close="<|im_end|>\n")
LLAMA3 = ChatTemplate(
    begin="<|begin_of_text|>",
    turn_open="<|start_header_id|>{role}<|end_header_id|>\n\n",
    turn_close="<|eot_id|>",
    strip_content=True,
)


def render_chat(
    messages: Column, template: ChatTemplate | Callable[..., Column] = CHATML, generation_prompt: bool = False
) -> Column:
    """Apply a chat template to every message of the conversation.

    ``template`` is a frame, or a template compiled by :func:`turnmill.functions.template.compile_template`
    (its variables bound with ``functools.partial``).
    """
    if not isinstance(template, ChatTemplate):
        return template(messages, generation_prompt)
    if template.default_system is not None:
        system = F.struct(
            F.lit("system").alias("role"), F.lit(template.default_system).alias("content")
        )
        has_system = F.exists(messages, lambda m: m["role"] == "system")
        messages = F.when(has_system, messages).otherwise(F.concat(F.array(system), messages))

    def turn(m: Column) -> Column:
        content = strip(m["content"]) if template.strip_content else m["content"]
        return F.concat(template.header(m["role"]), content, F.lit(template.turn_close))

    parts = [F.lit(template.begin), F.array_join(F.transform(messages, turn), "")]
    if generation_prompt:
        parts.append(template.header(F.lit("assistant")))
    return F.concat(*parts)


def render_prompt(messages: Column, template: ChatTemplate | Callable[..., Column] = CHATML) -> Column:
    """Template over the non-assistant turns, ending where the model should answer."""
    asked = F.filter(messages, lambda m: m["role"] != "assistant")
    return render_chat(asked, template, generation_prompt=True)


def first_content(messages: Column, role: str) -> Column:
    """Content of the first turn of a role, null when it never speaks."""
    turns = F.filter(messages, lambda m: m["role"] == role)
    return F.try_element_at(turns, F.lit(1))["content"]


def field_template(template: str, columns: Mapping[str, Column]) -> Column:
    """Replace each ``{name}`` by that column, or by nothing when it is missing.

    The template is cut once on the driver, so a substituted value that itself
    contains ``{name}`` is never expanded again.
    """
    pieces = re.split(r"\{(\w+)\}", template)
    out = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            out.append(F.lit(piece))
        elif piece in columns:
            out.append(F.coalesce(columns[piece].cast("string"), F.lit("")))
    return F.concat(*out)
