import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ferryline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, source string, key int"


def render(source, **variables):
    return "".join(text for text, _ in chat.Template(source).render(**variables))


def test_expressions_loops_and_branches():
    source = (
        "{% for m in messages %}{% if m.role == 'a' and not m.off %}A{{ 1 + 2 }}"
        "{% elif m.role != 'b' %}{{ m.role | upper }}{% else %}-{% endif %}{% endfor %}"
    )
    rows = [{"role": r, "off": False} for r in ("a", "b", "c")]
    assert render(source, messages=rows) == "A3-C"
    assert render("{{ none }}{{ true }}{{ ('x' + 1) | lower }}{{ ' y ' | trim }}") == "truex1y"


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}"), chat.Escape())
    assert tree == (chat.Text("abcd"),)


@pytest.mark.parametrize(
    "source",
    ["{% if a %}", "{% endfor %}", "{{ a b }}", "{{ f(1) }}", "{{ a | exec }}", "{{ 'x }}", "{% import os %}", "{{ }}"],
)
def test_what_is_not_of_the_language_is_refused(source):
    with pytest.raises(chat.TemplateError):
        render(source, a=1, f=len)


def test_no_way_out_of_the_sandbox():
    for source in ("{{ a.__class__ }}", "{{ __builtins__ }}", "{{ a.keys }}"):
        with pytest.raises(chat.TemplateError):
            render(source, a={})


@given(st.text(alphabet="\\<>/turn #AsistaN:\nx", max_size=60))
def test_escape_is_reversible_and_free_of_marks(text):
    escape = chat.Escape()
    made = escape.apply(text)
    assert escape.undo(made) == text
    assert not any(c in made for c in chat.CONTROLS)


def want(rows):
    """Digests straight from the rows."""
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for key, group in groups.items():
        group.sort(key=order)
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in group)
        loss = "".join(r[3] or "" for r in group if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[key] = (len(group), sha(turns), len(loss), sha(loss))
    return out


ROWS = [
    (1, 0, "user", "hi </turn> <turn x>\n"),
    (1, 1, "assistant", "\\### Assistant: </turn> ok\\"),
    (1, 1, "assistant", "\\### Assistant: </turn> ok\\"),
    (1, None, "system", None),
    (2, 0, None, "no role"),
    (2, 1, "assistant", None),
    (2, 2, "assistant", "\U0001f600é" * 3000),
    (None, 0, "user>\n", "no id"),
    (3, 0, "assistant", ""),
]


@pytest.mark.parametrize("part_chars", [1 << 20, 50])
def test_digests_equal_brute_force(spark, part_chars):
    df = spark.createDataFrame([(*r, "s", 1) for r in ROWS], SCHEMA)
    parts = chat.formatted(df, part_chars=part_chars)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(parts).collect()}
    assert got == want(ROWS)
    if part_chars == 50:
        assert parts.where("part > 0").count() > 0


def test_spans_hold_generated_text_only(spark):
    df = spark.createDataFrame([(*r, "s", 1) for r in ROWS], SCHEMA)
    for row in chat.formatted(df).collect():
        texts = [chat.Escape.undo(row.text[s.start : s.stop]) for s in row.spans]
        own = sorted((r[3] or "") for r in ROWS if r[0] == row.conv_id and r[2] == "assistant")
        assert sorted(texts) == [t for t in own if t]


def test_empty(spark):
    assert chat.digests(chat.formatted(spark.createDataFrame([], SCHEMA))).count() == 0
