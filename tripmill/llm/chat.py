"""Chat formatting by a template compiler.

A small sandboxed template language (text, {{ expressions }}, {% for %}, {% if %}, {% set %} and
{% generation %} blocks) is parsed into a syntax tree, constants are folded, and the tree becomes
nested Python closures that yield (piece, in_generation) pairs. Only names of the context, fields
of messages, literals, + ~ == != and or not, and the listed filters exist; nothing of Python can
be reached. Pieces come one by one, so a conversation of any length needs the memory of one turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import arrow_rows

START, STOP = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' ~ (message.role | escape_name) ~ '\\n' }}"
    "{% if message.role == 'assistant' %}"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)


def escape(text: str) -> str:
    """Breaks every control string inside a text, so that unescape gives the text back."""
    return _ESCAPE.sub(lambda m: "<\\" + m[0][1:], text)


# "<", any number of backslashes, "|": one more backslash is put behind "<", or taken away
_ESCAPE = re.compile(r"<\\*\|")
_UNESCAPE = re.compile(r"<\\(\\*\|)")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1", text)


def escape_name(name: str) -> str:
    """escape for a role, which must also stay on its line."""
    return escape(name.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_name(name: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_name": escape_name,
    "trim": lambda s: s.strip(),
    "upper": lambda s: s.upper(),
    "lower": lambda s: s.lower(),
}


class TemplateError(ValueError):
    """A template that does not parse, or that asks for what the sandbox does not have."""


# ---- parser: templates into trees of tuples

_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(
    r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[~+|().\[\]]))"
)
_KEYWORDS = {"and", "or", "not", "in", "true", "false", "none"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAGS.finditer(source):
        parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("value", m[1].strip()))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    if any(mark in text for kind, text in parts if kind == "text" for mark in ("{{", "{%")):
        raise TemplateError("a tag is not closed")
    body, rest, end = _block(parts, ())
    if end or rest:
        raise TemplateError(f"unexpected {end!r}")
    return body


def _block(parts: list, ends: tuple[str, ...]) -> tuple:
    """Nodes up to one of the end tags: (("block", nodes), remaining parts, the end tag)."""
    nodes = []
    while parts:
        (kind, text), parts = parts[0], parts[1:]
        if kind == "text":
            if text:
                nodes.append(("const", text))
        elif kind == "value":
            nodes.append(expression(text))
        else:
            word = text.split()[0] if text else ""
            if word in ends:
                return ("block", nodes), parts, text
            node, parts = _tag(word, text, parts)
            nodes.append(node)
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return ("block", nodes), parts, ""


def _tag(word: str, text: str, parts: list) -> tuple:
    if word == "for":
        m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(.+)", text, re.S)
        if not m:
            raise TemplateError(f"cannot read {text!r}")
        body, parts, _ = _block(parts, ("endfor",))
        return ("for", m[1], expression(m[2]), body), parts
    if word == "if":
        return _branches(text[2:], parts)
    if word == "generation":
        body, parts, _ = _block(parts, ("endgeneration",))
        return ("generation", body), parts
    if word == "set":
        m = re.fullmatch(r"set\s+([A-Za-z_]\w*)\s*=\s*(.+)", text, re.S)
        if not m:
            raise TemplateError(f"cannot read {text!r}")
        return ("set", m[1], expression(m[2])), parts
    raise TemplateError(f"unknown tag {word!r}")


def _branches(condition: str, parts: list) -> tuple:
    body, parts, end = _block(parts, ("elif", "else", "endif"))
    if end.startswith("elif"):
        other, parts = _branches(end[4:], parts)
    elif end.startswith("else"):
        other, parts, _ = _block(parts, ("endif",))
    else:
        other = ("block", [])
    return ("if", expression(condition), body, other), parts


class _Reader:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKENS.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            kind = ("string", "number", "name", "mark")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()

    def peek(self) -> tuple[str, str]:
        return self.tokens[0] if self.tokens else ("end", "")

    def take(self, *values: str) -> str:
        if self.tokens and self.tokens[0][0] != "string" and self.tokens[0][1] in values:
            return self.tokens.pop(0)[1]
        return ""

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected, not {self.peek()[1]!r}")


def expression(text: str) -> tuple:
    reader = _Reader(text)
    tree = _either(reader)
    if reader.tokens:
        raise TemplateError(f"unexpected {reader.peek()[1]!r}")
    return tree


def _either(r: _Reader) -> tuple:
    left = _both(r)
    while r.take("or"):
        left = ("or", left, _both(r))
    return left


def _both(r: _Reader) -> tuple:
    left = _negated(r)
    while r.take("and"):
        left = ("and", left, _negated(r))
    return left


def _negated(r: _Reader) -> tuple:
    return ("not", _negated(r)) if r.take("not") else _compared(r)


def _compared(r: _Reader) -> tuple:
    left = _joined(r)
    if op := r.take("==", "!=", "in"):
        return (op, left, _joined(r))
    return left


def _joined(r: _Reader) -> tuple:
    left = _filtered(r)
    while op := r.take("~", "+"):
        left = (op, left, _filtered(r))
    return left


def _filtered(r: _Reader) -> tuple:
    tree = _atom(r)
    while r.take("|"):
        _, name = r.tokens.pop(0) if r.tokens else ("end", "")
        if name not in FILTERS:
            raise TemplateError(f"unknown filter {name!r}")
        tree = ("filter", name, tree)
    return tree


def _atom(r: _Reader) -> tuple:
    kind, text = r.peek()
    if r.take("("):
        tree = _either(r)
        r.need(")")
    elif kind == "string":
        r.tokens.pop(0)
        tree = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
    elif kind == "number":
        r.tokens.pop(0)
        tree = ("const", int(text))
    elif word := r.take("true", "false", "none"):
        tree = ("const", {"true": True, "false": False, "none": None}[word])
    elif kind == "name" and text not in _KEYWORDS:
        r.tokens.pop(0)
        tree = ("name", text)
    else:
        raise TemplateError(f"unexpected {text!r}")
    while mark := r.take(".", "["):
        kind, field = r.tokens.pop(0) if r.tokens else ("end", "")
        if mark == "[":
            r.need("]")
            field = field[1:-1] if kind == "string" else ""
        if not re.fullmatch(r"[A-Za-z]\w*", field):
            raise TemplateError(f"no such field {field!r}")
        tree = ("field", tree, field)
    return tree


# ---- constant folding

_OPERATIONS: dict[str, Callable] = {
    "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def _text(value) -> str:
    return "" if value is None else str(value)


def fold(tree: tuple) -> tuple:
    """Evaluate what depends on constants alone, drop dead branches, join neighbouring texts."""
    kind, *rest = tree
    if kind in _OPERATIONS:
        left, right = fold(rest[0]), fold(rest[1])
        if left[0] == right[0] == "const":
            return ("const", _OPERATIONS[kind](left[1], right[1]))
        if kind == "~" and right[0] == "const" and left[0] == "~" and left[2][0] == "const":
            return ("~", left[1], ("const", _text(left[2][1]) + _text(right[1])))
        return (kind, left, right)
    if kind == "not":
        inner = fold(rest[0])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind == "filter":
        inner = fold(rest[1])
        if inner[0] == "const":
            return ("const", FILTERS[rest[0]](_text(inner[1])))
        return ("filter", rest[0], inner)
    if kind == "field":
        return ("field", fold(rest[0]), rest[1])
    if kind == "block":
        nodes: list[tuple] = []
        for node in map(fold, rest[0]):
            if node == ("block", []):
                continue
            if node[0] == "const" and nodes and nodes[-1][0] == "const":
                nodes[-1] = ("const", _text(nodes[-1][1]) + _text(node[1]))
            else:
                nodes.append(node)
        return nodes[0] if len(nodes) == 1 else ("block", nodes)
    if kind == "if":
        test, body, other = map(fold, rest)
        return (body if test[1] else other) if test[0] == "const" else ("if", test, body, other)
    if kind == "for":
        return ("for", rest[0], fold(rest[1]), fold(rest[2]))
    if kind == "generation":
        return ("generation", fold(rest[0]))
    if kind == "set":
        return ("set", rest[0], fold(rest[1]))
    return tree


# ---- closures

Pieces = Iterator[tuple[str, bool]]


def compile_template(source: str) -> Callable[[dict], Pieces]:
    """A function from a context to the (piece, in_generation) pairs of the rendered template."""
    run = _closure(fold(parse(source)))
    return lambda context: run(dict(context), False)


def _closure(tree: tuple) -> Callable[[dict, bool], Pieces]:
    kind, *rest = tree
    if kind == "block":
        parts = [_closure(node) for node in rest[0]]

        def block(context: dict, marked: bool) -> Pieces:
            for part in parts:
                yield from part(context, marked)

        return block
    if kind == "for":
        name, items, body = rest[0], _value(rest[1]), _closure(rest[2])

        def loop(context: dict, marked: bool) -> Pieces:
            for item in items(context):
                yield from body({**context, name: item}, marked)

        return loop
    if kind == "if":
        test, body, other = _value(rest[0]), _closure(rest[1]), _closure(rest[2])
        return lambda context, marked: (body if test(context) else other)(context, marked)
    if kind == "generation":
        inner = _closure(rest[0])
        return lambda context, marked: inner(context, True)
    if kind == "set":
        name, value = rest[0], _value(rest[1])

        def put(context: dict, marked: bool) -> Pieces:
            context[name] = value(context)
            return iter(())

        return put
    value = _value(tree)
    return lambda context, marked: iter(((_text(value(context)), marked),))


def _value(tree: tuple) -> Callable[[dict], object]:
    kind, *rest = tree
    if kind == "const":
        return lambda context: rest[0]
    if kind == "name":
        return lambda context: context.get(rest[0])
    if kind == "field":
        inner, name = _value(rest[0]), rest[1]

        def field(context: dict):
            found = inner(context)
            return found.get(name) if isinstance(found, dict) else None

        return field
    if kind == "not":
        inner = _value(rest[0])
        return lambda context: not inner(context)
    if kind == "filter":
        apply, inner = FILTERS[rest[0]], _value(rest[1])
        return lambda context: apply(_text(inner(context)))
    left, right, op = _value(rest[0]), _value(rest[1]), _OPERATIONS[kind]
    if kind == "and":
        return lambda context: left(context) and right(context)
    if kind == "or":
        return lambda context: left(context) or right(context)
    return lambda context: op(left(context), right(context))


# ---- reading back

class Turn(NamedTuple):
    role: str
    text: str
    under: str  # unescaped text under the loss mask
    formatted: str
    start: int | None  # of the mask in formatted


def read_back(pieces: Iterable[tuple[str, bool]]) -> Iterator[Turn]:
    """The turns of an output in the form that CHATML gives."""
    held: list[tuple[str, bool]] = []
    for piece, marked in pieces:
        held.append((piece, marked))
        if not marked and piece.endswith(STOP + "\n"):
            whole = "".join(p for p, _ in held)
            role, text = whole.removeprefix(START).removesuffix(STOP + "\n").split("\n", 1)
            if not whole.startswith(START) or "<|" in role or "<|" in text:
                raise ValueError("not a turn of this format")
            under = unescape("".join(p for p, m in held if m))
            start = len(whole) - len(STOP) - 1 - len(text) if any(m for _, m in held) else None
            yield Turn(unescape_name(role), unescape(text), under, whole, start)
            held = []
    if held:
        raise ValueError("the output ends inside a turn")


FORMATTED = "conv_id bigint, turn_no bigint, formatted string, loss_start bigint, loss_end bigint"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order; ties by role and text."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _rendered(template: str, batches) -> Iterator[tuple[int | None, Turn]]:
    """(conv_id, what read_back gives) per turn; one conversation follows the other."""
    render = compile_template(template)
    rows = (
        row
        for batch in batches
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
    )
    row = next(rows, None)
    while row is not None:
        conv_id = row[0]

        def messages():
            nonlocal row
            while row is not None and row[0] == conv_id:
                yield {"role": row[1], "text": row[2]}
                row = next(rows, None)

        for turn in read_back(render({"messages": messages()})):
            yield conv_id, turn


def digests(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """Per conversation, read back from its formatted output: turns, loss text and lengths.

    Turns go by turn number, nulls first; turns with the same number by role and text. A null
    role or text is empty; rows without conv_id form one conversation; repeated rows are turns
    like any other; other columns are not read. Turns stream through a task, so no conversation
    is held whole.
    """

    def digest(batches):
        open_id, open_ = None, None

        def close(conv_id):
            n, turns, chars, loss, length = open_
            return conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), length

        rows = []
        for conv_id, turn in _rendered(template, batches):
            if open_ is None or conv_id != open_id:
                if open_ is not None:
                    rows.append(close(open_id))
                open_id, open_ = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            open_[0] += 1
            open_[1].update(f"{turn.role}\n{turn.text}\n".encode())
            open_[2] += len(turn.under)
            open_[3].update(turn.under.encode())
            open_[4] += len(turn.formatted)
            if len(rows) >= 4096:
                yield arrow_rows(rows, DIGESTS)
                rows = []
        if open_ is not None:
            rows.append(close(open_id))
        yield arrow_rows(rows, DIGESTS)

    return _ordered(conversations).mapInArrow(digest, DIGESTS)


def render_turns(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """(conv_id, turn_no, formatted, loss_start, loss_end): the output turn by turn.

    loss_start and loss_end: code points of formatted under the loss mask, both null without.
    """

    def format_turns(batches):
        last, number, rows = None, 0, []
        for conv_id, turn in _rendered(template, batches):
            number = number + 1 if number and conv_id == last else 1
            last = conv_id
            end = turn.start if turn.start is None else turn.start + len(escape(turn.under))
            rows.append((conv_id, number, turn.formatted, turn.start, end))
            if len(rows) >= 1024:
                yield arrow_rows(rows, FORMATTED)
                rows = []
        yield arrow_rows(rows, FORMATTED)

    return _ordered(conversations).mapInArrow(format_turns, FORMATTED)
