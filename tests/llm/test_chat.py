"""Template language, and conversations there and back."""

import hashlib

import pytest
from fixtures import fuzz_texts, here, table

from kpimill.llm import chat
from kpimill.llm.chat import chat_template, escape, escape_name, format_conversations, read_digests, read_turns, round_trip, unescape
from kpimill.llm.templates import Const, For, Output, Template, TemplateError

MESSAGES = [{"role": "user", "text": "Hi"}, {"role": "assistant", "text": "Yo"}]


@pytest.mark.parametrize(
    "source, want",
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ 'x' ~ 1 ~ none ~ true }}", "x1true"),
        ("{{ (1 + 2) * 3 - 4 % 3 }}", "8"),
        ("{{ 'it\\'s\\n' }}", "it's\n"),
        ("{% for m in messages %}{{ loop.index }}{{ m['text'] | upper }}{% if not loop.last %}, {% endif %}{% endfor %}", "1HI, 2YO"),
        ("{% if messages | length > 1 and 1 == 1 %}many{% elif true %}one{% else %}none{% endif %}", "many"),
        ("{% set n = 'a' if false else 'b' %}{{ n }}{{ n in 'abc' }}{{ 'z' not in 'abc' }}", "btruetrue"),
        ("x {%- if true -%} y {%- endif -%} z{# note #}", "xyz"),
        ("{{ messages[1].role | default('q') }}{{ messages[0].nothing | default('q') }}", "assistantq"),
        ("{{ bos }}", "<s>"),
    ],
)
def test_language(source, want):
    assert Template(source, names={"bos": "<s>"}).render(MESSAGES)[0] == want


def test_constants_are_folded():
    t = Template("a{{ 'b' ~ 1 }}{% if 1 > 2 %}never{{ x }}{% else %}c{% endif %}{% for m in messages %}{{ 2 * 2 }}{{ '!' | upper }}{% endfor %}")
    assert t.tree[0] == Output(Const("ab1c"))
    assert isinstance(t.tree[1], For) and t.tree[1].body == (Output(Const("4!")),)


@pytest.mark.parametrize(
    "source",
    ["{{ messages.__class__ }}{{ x.y }}", "{{ 'a'.upper }}", "{{ open }}", "{{ messages[0]['role']['x'] }}", "{{ 1 + 'a' }}", "{{ f(1) }}", "{% import os %}", "{% for m in messages %}", "{{ 1 1 }}", "{{ 'a' | eval }}", "{{ ; }}"],
)
def test_sandbox(source):
    with pytest.raises(TemplateError):
        Template(source).render(MESSAGES)


def test_generation_marks_and_turns():
    source = "<{% for m in messages %}{{ m.role }}:{% generation %}{{ m.text }}{% endgeneration %};{% if loop.last %}end{% endif %}{% endfor %}>"
    t = Template(source)
    text, spans = t.render(MESSAGES)
    assert text == "<user:Hi;assistant:Yo;end>" and [text[a:b] for a, b in spans] == ["Hi", "Yo"]
    assert "".join(p for i, m in enumerate(MESSAGES) for p, _ in t.render_turn(m, i, i == 1)) == text
    with pytest.raises(TemplateError):
        Template("{% for m in messages %}{{ messages | length }}{% endfor %}").render_turn(MESSAGES[0], 0, True)


def test_escaping_is_reversible():
    hard = ["\\", "\\l", "<", "[INST]", "</s>", "\\\\b[", " [/INST]", "\n", "\\n", "<</SYS>>"]
    for a in hard + fuzz_texts(500):
        for b in hard:
            t = a + b
            assert unescape(escape(t)) == t and unescape(escape_name(t)) == t
            assert not set("<[") & set(escape(t)) and "\n" not in escape_name(t)
            turns = [("user", t), ("assistant", t), (t if t not in ("user", "assistant") else "x", t)]
            assert list(read_turns(chat_template().render([{"role": r, "text": x} for r, x in turns])[0])) == turns


def brute(rows):
    order = lambda v: (v is not None, v)
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r, x))
    out = []
    for c, found in convs.items():
        turns = [(r or "", x or "") for t, r, x in sorted(found, key=lambda f: order(f[0]))]
        marked = "".join(x for r, x in turns if r == "assistant")
        formatted = chat_template().render([{"role": r, "text": x} for r, x in turns])[0]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), digest("".join(f"{r}\n{x}\n" for r, x in turns)), len(marked), digest(marked), len(formatted)))
    return sorted(map(repr, out))


SCHEMA = "conv_id long, turn long, role string, text string, whole boolean, part string"


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, None, "</s>"), (1, None, "tool\n", "x"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (2, 0, "assistant", "w " * 9000)]
    rows += [(3, 5, "user", "same"), (3, 5, "user", "same"), (4, 1, "assistant", chat.TEMPLATE)]
    df = spark.createDataFrame([(*r, None, "p") for r in rows], SCHEMA)
    got = round_trip(df)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows)
    assert round_trip(df.limit(0)).count() == 0


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_conversation_over_many_tasks(spark, small_tasks):
    rows = [(9, i, ["user", "assistant"][i % 2], f"turn {i} <s>") for i in range(3000)] + [(i, 0, "user", "x") for i in range(20, 400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    segments = format_conversations(df, segment_chars=5000)
    assert segments.filter("conv_id = 9").select("part").distinct().count() > 1
    assert sorted(repr(tuple(r)) for r in read_digests(segments).collect()) == brute(rows)
    numbered = "{% for m in messages %}{% if loop.first %}F{% endif %}{{ loop.index0 }},{% if loop.last %}L{% endif %}{% endfor %}"
    found = format_conversations(df, template=numbered).filter("conv_id = 9").orderBy("part", "segment").collect()
    assert "".join(r.formatted for r in found) == "F" + "".join(f"{i}," for i in range(3000)) + "L"


@here
def test_conversations(spark):
    df = table(spark, "conversations").select("conv_id", "turn", "role", "text")
    assert sorted(repr(tuple(r)) for r in round_trip(df).collect()) == brute([tuple(r) for r in df.collect()])
