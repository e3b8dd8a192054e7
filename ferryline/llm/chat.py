"""Chat formatting by compiled templates.

A template is text with marks of a small, closed language:

    {{ expression }}                     a value; filters follow after |
    {% for name in messages %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}

Expressions are strings, whole numbers, true, false, none, names, ``name.field``, ``+``,
``==``, ``!=``, ``and``, ``or``, ``not``, brackets and filters (escape, trim, upper,
lower). There are no calls, no attributes of Python objects and no other names than the
variables given, so a template can reach nothing else.

A template is parsed into a tree, constant parts of it are folded, and the tree is turned
into nested Python closures. Rendering yields chunks of text, each marked as generated or
not, and takes the messages one by one, so a long conversation is never held as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The strings that mark turns in TURNS; texts must not contain them unescaped.
CONTROLS = ("<turn ", "</turn>", ">\n", "### Assistant:")

TURNS = (
    "{% for message in messages %}"
    "<turn {{ message.role | escape }}>\n"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "</turn>\n"
    "{% endfor %}"
)

Chunk = tuple[str, bool]
Scope = dict[str, object]


class TemplateError(ValueError):
    """A template that cannot be compiled or rendered."""


# The tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    expr: object


@dataclass(frozen=True)
class For:
    name: str
    source: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# Escaping


@dataclass(frozen=True)
class Escape:
    """Makes any text free of the control strings, and gives it back.

    A backslash is doubled; a control string gets a backslash after its first character.
    So an escaped text contains none of them, and dropping the first of each pair of a
    backslash and a character restores it.
    """

    controls: tuple[str, ...] = CONTROLS

    def __post_init__(self):
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise TemplateError("control strings need two characters and no backslash")

    @property
    def pattern(self) -> re.Pattern:
        return _escape_pattern(self.controls)

    def apply(self, text: str) -> str:
        return self.pattern.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)

    @staticmethod
    def undo(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


@cache
def _escape_pattern(controls: tuple[str, ...]) -> re.Pattern:
    found = [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls]
    return re.compile("|".join([r"\\", *found]))


# Parsing

_MARK = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<string>'[^']*'|\"[^\"]*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|[+.|()]))"
)
_WORDS = {"true": True, "false": False, "none": None}


class _Expression:
    """A recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string":
            value = self.tokens[self.at][1]
            if value in values:
                self.at += 1
                return value
        return None

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        left = self.sum()
        while op := self.take("==", "!="):
            left = Op(op, (left, self.sum()))
        return left

    def sum(self):
        left = self.filtered()
        while self.take("+"):
            left = Op("+", (left, self.filtered()))
        return left

    def filtered(self):
        tree = self.operand()
        while self.take("|"):
            name = self.next("name")
            if name not in _FILTERS:
                raise TemplateError(f"unknown filter {name}")
            tree = Op(f"|{name}", (tree,))
        return tree

    def operand(self):
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(value[1:-1])
        if kind == "number":
            return Const(int(value))
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in _WORDS:
            return Const(_WORDS[value])
        path = [value]
        while self.take("."):
            path.append(self.next("name"))
        return Name(tuple(path))

    def next(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]


def parse(source: str) -> tuple:
    """The tree of a template."""
    parts = [p for p in _MARK.split(source) if p]
    nodes, at, _ = _block(parts, 0, ())
    return nodes


def _block(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    """Nodes up to one of the marks in ``ends``; the place after it, and its content."""
    nodes = []
    while at < len(parts):
        part = parts[at]
        at += 1
        if part.startswith("{{"):
            nodes.append(Output(_Expression(part[2:-2]).whole()))
        elif not part.startswith("{%"):
            nodes.append(Text(part))
        else:
            mark = part[2:-2].strip()
            word, _, rest = mark.partition(" ")
            if word in ends:
                return tuple(nodes), at, mark
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"cannot read {mark!r}")
                body, at, _ = _block(parts, at, ("endfor",))
                nodes.append(For(m[1], _Expression(m[2]).whole(), body))
            elif word == "if":
                node, at = _branches(parts, at, rest)
                nodes.append(node)
            elif word == "generation":
                body, at, _ = _block(parts, at, ("endgeneration",))
                nodes.append(Generation(body))
            else:
                raise TemplateError(f"unexpected {mark!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return tuple(nodes), at, ""


def _branches(parts: list[str], at: int, test: str) -> tuple[If, int]:
    then, at, mark = _block(parts, at, ("elif", "else", "endif"))
    word, _, rest = mark.partition(" ")
    other: tuple = ()
    if word == "elif":
        node, at = _branches(parts, at, rest)
        other = (node,)
    elif word == "else":
        other, at, _ = _block(parts, at, ("endif",))
    return If(_Expression(test).whole(), then, other), at


# Folding


def _as_text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} is not text")


def _add(a: object, b: object) -> object:
    both_numbers = isinstance(a, int) and isinstance(b, int)
    return a + b if both_numbers else _as_text(a) + _as_text(b)


_FILTERS: dict[str, Callable[[str, Escape], str]] = {
    "escape": lambda s, escape: escape.apply(s),
    "trim": lambda s, _: s.strip(),
    "upper": lambda s, _: s.upper(),
    "lower": lambda s, _: s.lower(),
}
_PURE: dict[str, Callable] = {
    "+": _add,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def _function(name: str, escape: Escape) -> Callable:
    if name.startswith("|"):
        apply = _FILTERS[name[1:]]
        return lambda value: apply(_as_text(value), escape)
    return _PURE[name]


def fold(nodes: tuple, escape: Escape) -> tuple:
    """The tree with constant expressions computed, dead branches gone and texts joined."""
    out: list = []

    def push(node) -> None:
        if isinstance(node, Text):
            if not node.value:
                return
            if out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + node.value)
                return
        out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            expr = fold_expr(node.expr, escape)
            push(Text(_as_text(expr.value)) if isinstance(expr, Const) else Output(expr))
        elif isinstance(node, If):
            test = fold_expr(node.test, escape)
            then, other = fold(node.then, escape), fold(node.other, escape)
            if isinstance(test, Const):
                for kept in then if test.value else other:
                    push(kept)
            elif then or other:
                push(If(test, then, other))
        elif isinstance(node, For):
            push(For(node.name, fold_expr(node.source, escape), fold(node.body, escape)))
        elif isinstance(node, Generation):
            body = fold(node.body, escape)
            if body:
                push(Generation(body))
        else:
            push(node)
    return tuple(out)


def fold_expr(expr, escape: Escape):
    if not isinstance(expr, Op):
        return expr
    args = tuple(fold_expr(a, escape) for a in expr.args)
    if all(isinstance(a, Const) for a in args):
        return Const(_function(expr.name, escape)(*[a.value for a in args]))
    return Op(expr.name, args)


# Closures


@dataclass(frozen=True)
class Template:
    """A compiled template. ``render`` yields (text, generated) chunks in order."""

    source: str
    escape: Escape = field(default_factory=Escape)

    def render(self, **variables: object) -> Iterator[Chunk]:
        return _compiled(self.source, self.escape)(dict(variables), False)


@cache
def _compiled(source: str, escape: Escape) -> Callable[[Scope, bool], Iterator[Chunk]]:
    return _body(fold(parse(source), escape), escape)


def _body(nodes: tuple, escape: Escape) -> Callable[[Scope, bool], Iterator[Chunk]]:
    steps = [_step(node, escape) for node in nodes]

    def run(scope: Scope, generated: bool) -> Iterator[Chunk]:
        for step in steps:
            yield from step(scope, generated)

    return run


def _step(node, escape: Escape) -> Callable[[Scope, bool], Iterable[Chunk]]:
    if isinstance(node, Text):
        return lambda scope, generated: ((node.value, generated),)
    if isinstance(node, Output):
        value = _value(node.expr, escape)
        return lambda scope, generated: ((_as_text(value(scope)), generated),)
    if isinstance(node, Generation):
        body = _body(node.body, escape)
        return lambda scope, generated: body(scope, True)
    if isinstance(node, If):
        test = _value(node.test, escape)
        then, other = _body(node.then, escape), _body(node.other, escape)
        return lambda scope, generated: (then if test(scope) else other)(scope, generated)
    source, body = _value(node.source, escape), _body(node.body, escape)

    def loop(scope: Scope, generated: bool) -> Iterator[Chunk]:
        items = source(scope)
        if isinstance(items, (str, dict)) or not hasattr(items, "__iter__"):
            raise TemplateError(f"{node.name}: not a list")
        for item in items:
            yield from body({**scope, node.name: item}, generated)

    return loop


def _value(expr, escape: Escape) -> Callable[[Scope], object]:
    if isinstance(expr, Const):
        return lambda scope: expr.value
    if isinstance(expr, Name):
        first, *fields = expr.path

        def look_up(scope: Scope) -> object:
            if first not in scope:
                raise TemplateError(f"unknown name {first}")
            value = scope[first]
            for name in fields:
                if not isinstance(value, dict) or name not in value:
                    raise TemplateError(f"unknown field {'.'.join(expr.path)}")
                value = value[name]
            return value

        return look_up
    args = [_value(a, escape) for a in expr.args]
    if expr.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if expr.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    apply = _function(expr.name, escape)
    return lambda scope: apply(*[a(scope) for a in args])


# On Spark

FORMATTED = "conv_id long, part long, text string, spans array<struct<start:int,stop:int>>"
PART_CHARS = 1 << 20


def formatted(
    df: DataFrame,
    template: Template = Template(TURNS),
    part_chars: int = PART_CHARS,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Render each conversation, as parts in order with the spans of generated text.

    Rows of a conversation are put in order of turn, then role, then text; repeated rows
    stay. Null roles and texts are empty, null turns come first, and rows without an id
    are one conversation. Parts are cut between chunks once they hold ``part_chars``
    characters, so a task holds one part and one turn at a time; part 0 is the only one of
    most conversations. Parts lie in order within a task. Spans are in code points of the
    part. An empty table gives no rows; columns not named are not read.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(template, part_chars), FORMATTED)


def _groups(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of sorted batches, by their first column: (key, iterator over the other columns)."""
    rows = (row for b in batches for row in zip(*[b[n].to_pylist() for n in names]))
    ahead = next(rows, None)
    while ahead is not None:
        key = ahead[0]

        def members():
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                row, ahead = ahead, next(rows, None)
                yield row[1:]

        yield key, members()


def _format(template: Template, part_chars: int) -> Callable:
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("part", pa.int64()),
            ("text", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ]
    )

    def parts(key, rows) -> Iterator[dict]:
        messages = ({"role": role, "text": text} for role, text in rows)
        chunks, spans, size, part = [], [], 0, 0

        def made() -> dict:
            return {"conv_id": key, "part": part, "text": "".join(chunks), "spans": spans}

        for text, generated in template.render(messages=messages):
            if size >= part_chars:
                yield made()
                chunks, spans, size, part = [], [], 0, part + 1
            if generated and text:
                if spans and spans[-1]["stop"] == size:
                    spans[-1]["stop"] += len(text)
                else:
                    spans.append({"start": size, "stop": size + len(text)})
            chunks.append(text)
            size += len(text)
        yield made()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for key, rows in _groups(batches, "conv_id", "role", "text"):
            for row in parts(key, rows):
                out.append(row)
                held += len(row["text"])
                if held >= 4 * part_chars:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


# Reading back what TURNS has written

_TURN = re.compile(r"<turn (.*?)>\n(.*?)</turn>\n", re.S)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def read_turns(text: str) -> Iterator[tuple[str, str, int]]:
    """(role, text, place after it) of each whole turn that TURNS has written."""
    at = 0
    while m := _TURN.match(text, at):
        at = m.end()
        yield Escape.undo(m[1]), Escape.undo(m[2]), at


def digests(parts: DataFrame) -> DataFrame:
    """Digests of conversations, read back from the parts that ``formatted`` made with TURNS.

    Uses the order in which the parts lie in their task; do not shuffle them between.
    """
    return parts.mapInArrow(_digest, DIGESTS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    out = []
    for key, rows in _groups(batches, "conv_id", "text", "spans"):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        rest = ""
        for text, spans in rows:
            chars += len(text)
            for span in spans:
                own = Escape.undo(text[span["start"] : span["stop"]])
                loss.update(own.encode())
                loss_chars += len(own)
            rest += text
            done = 0
            for role, said, done in read_turns(rest):
                turns.update(f"{role}\n{said}\n".encode())
                n_turns += 1
            rest = rest[done:]
        if rest:
            raise ValueError(f"conversation {key} ends within a turn")
        out.append((key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) >= 10_000:
            yield _as_batch(out, schema)
            out = []
    if out:
        yield _as_batch(out, schema)


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
