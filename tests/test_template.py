"""Chat templates compiled to columns, against renderings written out by hand."""

from functools import partial

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from turnmill.functions import chat
from turnmill.functions.template import TemplateError, compile_template

ROWS = [
    (1, [("system", " Be brief. "), ("user", " hi\n"), ("assistant", " yo "), ("user", "a'b")]),
    (2, [("user", "one"), ("assistant", "two")]),
    (3, []),
    (4, None),
    (5, [("user", None), (None, "x")]),
]
SCHEMA = "id int, m array<struct<role:string,content:string>>"

TAGGED = """{% for message in messages %}
{% if message['role'] == 'user' %}
{{ '<|user|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'system' %}
{{ '<|system|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'assistant' %}
{{ '<|assistant|>\\n'  + message['content'] + eos_token }}
{% endif %}
{% if loop.last and add_generation_prompt %}
{{ '<|assistant|>' }}
{% endif %}
{% endfor %}
"""
INSTRUCT = (
    "{%- if messages[0]['role'] == 'system' -%}{%- set rest = messages[1:] %}{% set system = messages[0].content %}"
    "{%- else -%}{% set rest = messages %}{% set system = false %}{%- endif -%}"
    "{{ bos_token }}{%- for m in rest -%}"
    "{%- if (m.role == 'user') != (loop.index0 % 2 == 0) -%}{{ raise_exception('roles must alternate') }}{%- endif -%}"
    "{%- if loop.first and system -%}{%- set content = '<<' ~ system | trim ~ '>> ' ~ m.content -%}"
    "{%- else -%}{%- set content = m.content -%}{%- endif -%}"
    "{{ '[INST] ' ~ content.strip() ~ ' [/INST]' if m.role == 'user' else ' ' + content | trim + eos_token }}"
    "{%- endfor -%}"
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def rendered(rows, template, *args, **variables):
    column = compile_template(template)(F.col("m"), *args, **variables)
    return {r["id"]: r["t"] for r in rows.select("id", column.alias("t")).collect()}


def test_roles_by_branches(rows):
    got = rendered(rows, TAGGED, True, eos_token="</s>")
    assert got[1] == (
        "<|system|>\n Be brief. </s>\n<|user|>\n hi\n</s>\n<|assistant|>\n yo </s>\n<|user|>\na'b</s>\n<|assistant|>\n"
    )
    assert got[2] == "<|user|>\none</s>\n<|assistant|>\ntwo</s>\n<|assistant|>\n"
    assert got[3] == "" and got[4] is None
    assert got[5] == "<|user|>\n</s>\n<|assistant|>\n"  # a turn without a role fits no branch


def test_system_joins_the_first_question(rows):
    got = rendered(rows.filter("id < 5"), INSTRUCT, bos_token="<s>", eos_token="</s>")
    assert got[1] == "<s>[INST] <<Be brief.>>  hi [/INST] yo</s>[INST] a'b [/INST]"
    assert got[2] == "<s>[INST] one [/INST] two</s>"
    assert got[3] == "<s>" and got[4] is None


def test_exception_fails_the_row_that_meets_it(spark):
    df = spark.createDataFrame([(1, [("user", "a"), ("user", "b")])], SCHEMA)
    with pytest.raises(PySparkException, match="roles must alternate"):
        rendered(df, INSTRUCT, bos_token="", eos_token="")


def test_equals_the_fixed_frames(rows):
    frame = "{% for message in messages %}{{'<|im_start|>' + message.role + '\\n' + message.content + '<|im_end|>' + '\\n'}}{% endfor %}"
    headers = (
        "{% set loop_messages = messages %}{% for message in loop_messages %}"
        "{% set content = '<|start_header_id|>' + message['role'] + '<|end_header_id|>\\n\\n'+ message['content'] | trim + '<|eot_id|>' %}"
        "{% if loop.index0 == 0 %}{% set content = bos_token + content %}{% endif %}{{ content }}{% endfor %}"
    )
    some = rows.filter("id < 3")
    want = some.select("id", chat.render_chat(F.col("m")), chat.render_chat(F.col("m"), chat.LLAMA3)).collect()
    assert rendered(some, frame) == {r[0]: r[1] for r in want}
    assert rendered(some, headers, bos_token="<|begin_of_text|>") == {r[0]: r[2] for r in want}


@pytest.mark.parametrize(
    ("template", "want"),
    [
        ("a\n  {% if true %}\n  b\n  {% endif %}\nc\n", "a\n  b\nc"),  # blocks take their lines with them
        ("a  {{- 'x' -}}  b {#- it's gone -#} c", "axbc"),
        ("{{ messages[-1]['content'] }}|{{ messages[:-1] | length }}|{{ messages[1:2][0].role }}|{{ messages[9].role }}", "a'b|3|user|"),
        ("{% for m in messages if m.role != 'user' %}{{ loop.index }}/{{ loop.length }}{{ m.role | upper }}{% endfor %}", "1/2SYSTEM2/2ASSISTANT"),
        ("{% set x = 'out' %}{% for m in messages %}{% set x = m.role %}{% endfor %}{{ x }}", "out"),
        ("{{ 'a' if tools is defined else 'b' }}{{ 'c' if tools else 'd' }}{{ 'e' if messages[0].role in ['system', 'tool'] }}", "bde"),
        ("{{ (messages[0].content.split('brief')[-1]).rstrip() + 'x'.upper() }}{{ 7 % 4 - 1 }}", ".X2"),
        ("{% if 'brief' in messages[0].content and not messages[0].content.startswith('B') %}{{ \"q'%}\" }}{% endif %}", "q'%}"),
        ("{% if messages[1].role is none or messages | length < 4 %}x{% else %}{{ -1 }}{% endif %}", "-1"),
    ],
)
def test_small_forms(rows, template, want):
    assert rendered(rows.filter("id = 1"), template)[1] == want


@pytest.mark.parametrize(
    "template",
    [
        "{% macro f() %}{% endmacro %}", "{% for m in messages %}", "{% if x %}", "{{ x", "{{ messages | tojson }}", "{{ a b }}",
        "{{ messages[0].content.replace('a', 'b') }}", "{{ bos_token }}", "{{ messages }}", "{% for x in [1] %}{% endfor %}",
        "{% if messages[0].role == 'a' %}{% set x = 1 %}{% else %}{% set x = 'b' %}{% endif %}", "{{ 1 + 'a' }}", "{% endif %}",
        "{{ $ }}", "{% set a.b = 1 %}", "{{ namespace(x=1) }}",
    ],
)
def test_what_is_unknown_is_an_error(spark, template):
    with pytest.raises(TemplateError):
        compile_template(template)(F.col("m"))


def test_stands_where_a_frame_does(rows):
    bound = partial(compile_template(TAGGED), eos_token="</s>")
    m = F.col("m")
    row = rows.filter("id = 2").select(chat.render_chat(m, bound), chat.render_prompt(m, bound)).first()
    assert tuple(row) == ("<|user|>\none</s>\n<|assistant|>\ntwo</s>\n", "<|user|>\none</s>\n<|assistant|>\n")


def test_very_long_content(spark):
    text = "x'{{ y }}{% z %} " * 200_000
    df = spark.createDataFrame([(1, [("user", text)])], SCHEMA)
    assert rendered(df, "{% for m in messages %}{{ m.content }}{% endfor %}")[1] == text
