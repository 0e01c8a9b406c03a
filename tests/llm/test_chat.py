import pytest
from hypothesis import given
from hypothesis import strategies as st

from clausemill.llm import chat, templates

TEXT = st.lists(st.sampled_from([*"ab\\<>|/[]\n", *chat.CONTROLS]), max_size=12).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|says|>"]), TEXT), max_size=5))
def test_round_trip(turns):
    write = templates.compile_template(chat.TEMPLATE, chat.escape)
    text, spans = write(messages=[{"role": r, "content": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert chat.masked(text, spans) == "".join(t for r, t in turns if r == "assistant")
    assert text.count(chat.TURN) == len(turns) and not any(c in text for c in ("</s>", "[INST]", "[/INST]", "<s>"))


def render(source, **names):
    return templates.compile_template(source)(**names)[0]


@pytest.mark.parametrize(
    "source,names,want",
    [
        ("{{ 'a' ~ (1 + 2) }}", {}, "a3"),
        ("{% for m in ms %}{{ loop.index }}{{ m.x }}{% if not loop.last %},{% endif %}{% endfor %}", {"ms": [{"x": "p"}, {"x": "q"}]}, "1p,2q"),
        ("{% if a == 1 %}one{% elif a == 2 %}two{% else %}many{% endif %}", {"a": 2}, "two"),
        ("{% set x = 'v' | upper %}{{ x }}{{ y | default('d') }}", {}, "Vd"),
        ("  {{- 'a' -}}  b", {}, "ab"),
        ("{# remark #}{{ ms[-1].x }}{{ ms | length }}", {"ms": [{"x": 1}, {"x": 2}]}, "22"),
        ("{{ 'b' in 'abc' and not false }}", {}, "True"),
        ("{{ '}}' ~ \"%}\" }}{% if x == '%}' %}y{% endif %}", {"x": "%}"}, "}}%}y"),
        ("it's {{ x }}, isn't it", {"x": 1}, "it's 1, isn't it"),
    ],
)
def test_language(source, names, want):
    assert render(source, **names) == want


@pytest.mark.parametrize("source", ["{{ f() }}", "{% import x %}", "{{ x.y.z( }}", "{% for a in b %}", "{{ 'a' | eval }}", "{% endfor %}", "{{ a b }}", "{{ @ }}", "{{ 1 % 0 }}", "{{ 1 + 'a' }}", "{{ a", "{% if x", "{{ 'a }}", "{{ " + "(" * 5000 + "1" + ")" * 5000 + " }}"])
def test_what_is_not_in_the_language(source):
    with pytest.raises(templates.TemplateError):
        templates.compile_template(source)


def test_sandbox():
    for x in ("{{ x.__class__ }}", "{{ x['__class__'] }}", "{% for a in x %}{% endfor %}", "{{ 'a' * 'b' }}", "{{ x % 0 }}", "{{ x + 1 }}", "{{ x < 2 }}", "{{ 1 in 2 }}"):
        with pytest.raises(templates.TemplateError):
            render(x, x="text")


def test_folding():
    tree = templates.fold_body(templates.parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% else %}c{% endif %}{{ y }}"), str)
    assert tree == [("text", "ab1c"), ("out", ("name", "y"))]


def test_edges(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "u"), (1, 1, "assistant", None), (None, 0, "user", "x"), (2, None, "user", ""), (2, 5, "assistant", "long " * 30000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_chats(df)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 3, None: 1, 2: 2} and got[2]["loss_chars"] == 150000
    assert chat.digest(chat.format_chats(df.limit(0))).count() == 0
