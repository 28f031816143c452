"""Operator 6: chat formatting by a template compiler.

A small template language is parsed into a syntax tree, constants are folded, and the tree
becomes Python closures; nothing of a template is ever evaluated as Python. The language:

* text; ``{{ expression }}``;
* ``{% for message in messages %} ... {% endfor %}`` with `loop.first`, `loop.last`, `loop.index0`;
* ``{% if e %} ... {% elif e %} ... {% else %} ... {% endif %}``; ``{% set name = e %}``;
* ``{% generation %} ... {% endgeneration %}``: what is rendered inside is under the loss mask;
* expressions: strings, integers, true, false, none, names, ``message.role`` or
  ``message['role']``, ``+``, ``==``, ``!=``, ``in``, ``and``, ``or``, ``not``, parentheses, and
  the filters ``trim``, ``upper``, ``lower``, ``length``, ``escape``.

Names reach only `messages`, the loop, values set before, and the fields of a message; fields
starting with an underscore and calls do not exist.

A conversation is rendered as a stream of pieces (text, under the mask or not), one message
at a time, so a conversation of any number of turns needs the memory of one. Rows of a
conversation are sorted in Spark and streamed through the closures.

`escape` makes control strings inside texts harmless and can be undone: the escape mark and
every character that begins a control string are written as the mark and a code. `read_turns`
reads turns and mask back from formatted text.

Defined cases: a null text or role is empty; a null conv_id is one conversation; null turns
come first; rows of equal turn follow by role and text, repeated rows each count; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\\"
#: Characters that begin a control string, and their codes behind the mark.
CODES = {"\\": "\\", "<": "l", "[": "b", "|": "p"}
_ESCAPED = str.maketrans({c: MARK + k for c, k in CODES.items()})
_PLAIN = {k: c for c, k in CODES.items()}

START, BODY, END, MASKED, UNMASKED = "<|turn|>", "<|text|>", "<|end|>", "<|loss|>", "<|/loss|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|turn|>' + (message.role | escape) + '<|text|>' }}"
    "{% if message.role == 'assistant' %}"
    "{{ '<|loss|>' }}{% generation %}{{ message.text | escape }}{% endgeneration %}{{ '<|/loss|>' }}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|end|>' + '\\n' }}"
    "{% endfor %}"
)


def escape(text: str) -> str:
    return text.translate(_ESCAPED)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.S)


# ---------------------------------------------------------------- template -> tree


class TemplateError(ValueError):
    """The template is not of the language."""


_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z][A-Za-z0-9_]*)"""
                    r"""|(?P<op>==|!=|[-+().|\[\]=]))""")
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}
_STRING_CODES = {"n": "\n", "t": "\t", "r": "\r"}
FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: v.strip(), "upper": lambda v: v.upper(), "lower": lambda v: v.lower(),
    "length": lambda v: len(v), "escape": escape}
FIELDS = {"message": ("role", "text"), "loop": ("first", "last", "index0")}


class _Expression:
    """Recursive descent over the tokens of one expression -> nested tuples."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            at = m.end()
            kind = m.lastgroup
            value: Any = m[kind]
            if kind == "str":
                value = re.sub(r"\\(.)", lambda e: _STRING_CODES.get(e[1], e[1]), value[1:-1], flags=re.S)
            elif kind == "int":
                value = int(value)
            elif kind == "name" and value in _WORDS:
                kind = "op"
            self.tokens.append((kind, value))
        self.at = 0

    def take(self, *ops: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "op" and self.tokens[self.at][1] in ops:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, op: str) -> None:
        if not self.take(op):
            raise TemplateError(f"{op!r} expected")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is expected")

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.summed()
        while op := self.take("==", "!=", "in"):
            tree = (op, tree, self.summed())
        return tree

    def summed(self) -> tuple:
        tree = self.filtered()
        while self.take("+"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.single()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def single(self) -> tuple:
        if self.take("("):
            tree = self.either()
            self.need(")")
            return tree
        for word, value in (("true", True), ("false", False), ("none", None)):
            if self.take(word):
                return ("const", value)
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends early")
        kind, value = self.tokens[self.at]
        if kind in ("str", "int"):
            self.at += 1
            return ("const", value)
        name = self.name()
        if self.take("."):
            return self.field(name, self.name())
        if self.take("["):
            kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", None)
            if kind != "str":
                raise TemplateError("a field name is expected")
            self.at += 1
            self.need("]")
            return self.field(name, value)
        return ("name", name)

    @staticmethod
    def field(name: str, field: str) -> tuple:
        if field not in {f for fields in FIELDS.values() for f in fields}:
            raise TemplateError(f"no field {field!r}")
        return ("field", name, field)


def parse(template: str) -> list[tuple]:
    """The syntax tree: ('text', s), ('put', e), ('for', name, body), ('if', [(e, body)], else),
    ('set', name, e), ('generation', body)."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.S)
    at = 0

    def body(*ends: str) -> tuple[list[tuple], str, str]:
        nonlocal at
        out: list[tuple] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                out.append(("put", _Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return out, word, rest
                out.append(statement(word, rest.strip()))
            elif "{{" in part or "{%" in part:
                raise TemplateError("a tag is not closed")
            elif part:
                out.append(("text", part))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, "", ""

    def statement(word: str, rest: str) -> tuple:
        if word == "for":
            m = re.fullmatch(r"([A-Za-z][A-Za-z0-9_]*)\s+in\s+messages", rest)
            if not m:
                raise TemplateError("only `for name in messages` is known")
            return ("for", m[1], body("endfor")[0])
        if word == "if":
            cases = []
            test = _Expression(rest).whole()
            while True:
                inner, end, more = body("elif", "else", "endif")
                cases.append((test, inner))
                if end == "endif":
                    return ("if", cases, [])
                if end == "else":
                    return ("if", cases, body("endif")[0])
                test = _Expression(more).whole()
        if word == "set":
            name, eq, value = rest.partition("=")
            if not eq or not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", name.strip()):
                raise TemplateError("set needs a name and a value")
            return ("set", name.strip(), _Expression(value).whole())
        if word == "generation":
            return ("generation", body("endgeneration")[0])
        raise TemplateError(f"no statement {word!r}")

    return body()[0]


# ---------------------------------------------------------------- tree -> folded tree

_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": lambda a, b: a + b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b}


def fold(tree: tuple) -> tuple:
    """An expression with all constant parts computed."""
    kind = tree[0]
    if kind in ("const", "name", "field"):
        return tree
    if kind == "filter":
        inner = fold(tree[2])
        return ("const", FILTERS[tree[1]](inner[1])) if inner[0] == "const" else ("filter", tree[1], inner)
    args = [fold(a) for a in tree[1:]]
    if kind == "not":
        return ("const", not args[0][1]) if args[0][0] == "const" else ("not", args[0])
    left, right = args
    if kind in ("and", "or"):
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if left[0] == right[0] == "const":
        return ("const", _BINARY[kind](left[1], right[1]))
    if kind == "+" and left[0] == "+" and left[2][0] == right[0] == "const":
        return ("+", left[1], ("const", left[2][1] + right[1]))
    return (kind, left, right)


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold_body(nodes: list[tuple]) -> list[tuple]:
    """Statements with constants folded: constant output becomes text, neighbouring texts
    join, branches that are never taken go."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "put":
            e = fold(node[1])
            add(("text", _text(e[1])) if e[0] == "const" else ("put", e))
        elif kind == "for":
            add(("for", node[1], fold_body(node[2])))
        elif kind == "set":
            add(("set", node[1], fold(node[2])))
        elif kind == "generation":
            add(("generation", fold_body(node[1])))
        elif kind == "if":
            cases, other = [], fold_body(node[2])
            for test, inner in node[1]:
                test = fold(test)
                if test[0] != "const":
                    cases.append((test, fold_body(inner)))
                elif test[1]:
                    other = fold_body(inner)
                    break
            if cases:
                add(("if", cases, other))
            else:
                for n in other:
                    add(n)
        else:
            add(node)
    return out


# ---------------------------------------------------------------- folded tree -> closures

Piece = tuple[str, bool]


def _value(tree: tuple) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda env: value
    if kind == "name":
        name = tree[1]
        return lambda env: env.get(name)
    if kind == "field":
        name, field = tree[1:]

        def get(env: dict) -> Any:
            held = env.get(name)
            return held.get(field) if isinstance(held, dict) else None
        return get
    if kind == "filter":
        change, inner = FILTERS[tree[1]], _value(tree[2])
        return lambda env: change(_text(inner(env)))
    if kind == "not":
        inner = _value(tree[1])
        return lambda env: not inner(env)
    a, b = _value(tree[1]), _value(tree[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    both = _BINARY[kind]
    return lambda env: both(a(env), b(env))


def _body(nodes: list[tuple], masked: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_statement(n, masked) for n in nodes]

    def run(env: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)
    return run


def _statement(node: tuple, masked: bool) -> Callable[[dict], Iterable[Piece]]:
    kind = node[0]
    if kind == "text":
        piece = [(node[1], masked)]
        return lambda env: piece
    if kind == "put":
        value = _value(node[1])
        return lambda env: [(_text(value(env)), masked)]
    if kind == "set":
        name, value = node[1], _value(node[2])

        def assign(env: dict) -> Iterable[Piece]:
            env[name] = value(env)
            return ()
        return assign
    if kind == "generation":
        return _body(node[1], True)
    if kind == "if":
        cases = [(_value(t), _body(b, masked)) for t, b in node[1]]
        other = _body(node[2], masked)

        def choose(env: dict) -> Iterable[Piece]:
            for test, body in cases:
                if test(env):
                    return body(env)
            return other(env)
        return choose
    name, body = node[1], _body(node[2], masked)

    def loop(env: dict) -> Iterator[Piece]:
        rows = iter(env["messages"])
        message = next(rows, None)
        k = 0
        while message is not None:
            following = next(rows, None)
            inner = {**env, name: message, "loop": {"first": k == 0, "last": following is None, "index0": k}}
            yield from body(inner)
            message, k = following, k + 1
    return loop


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (dicts of role and text, read once) to pieces (text, under the
    loss mask)."""
    run = _body(fold_body(parse(template)), False)
    return lambda messages: run({"messages": messages})


# ---------------------------------------------------------------- reading back


def read_turns(chunks: Iterable[str]) -> Iterator[tuple[str, str, str]]:
    """(role, text, text under the mask) of each turn of text formatted by `TEMPLATE`, from
    chunks cut anywhere. Holds one turn."""
    held = ""
    for chunk in chunks:
        held += chunk
        while (end := held.find(END + "\n")) >= 0:
            turn, held = held[:end], held[end + len(END) + 1:]
            if not turn.startswith(START):
                raise ValueError("no turn here")
            role, _, body = turn[len(START):].partition(BODY)
            loss = ""
            if body.startswith(MASKED) and body.endswith(UNMASKED):
                body = loss = body[len(MASKED):-len(UNMASKED)]
            yield unescape(role), unescape(body), unescape(loss)
    if held:
        raise ValueError("the text ends inside a turn")


# ---------------------------------------------------------------- operator

ROWS_OUT = 512
PIECES = "conv_id long, piece long, text string, spans array<array<int>>"


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, *, conv_col="conv_id",
                         turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv_id, piece, text, spans): the formatted conversation as consecutive pieces of about
    one turn, in order inside a partition, and the code points [start, end) of each piece that
    are under the loss mask. Pieces of one conversation, joined in order, are its text."""
    rows = (conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                 F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                                 F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def stream() -> Iterator[tuple]:
            for rb in batches:
                for start in range(0, rb.num_rows, ROWS_OUT):
                    part = rb.slice(start, ROWS_OUT)
                    yield from zip(*(part.column(i).to_pylist() for i in (0, 2, 3)), strict=True)

        source = stream()
        ahead = next(source, None)
        out: list[tuple] = []
        read = 0  # rows handed to the renderer

        def messages(conv) -> Iterator[dict]:
            nonlocal ahead, read
            while ahead is not None and ahead[0] == conv:
                row, ahead = ahead, next(source, None)
                read += 1
                yield {"role": row[1], "text": row[2]}

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32()))),
                strict=True)], names=["conv_id", "piece", "text", "spans"])

        while ahead is not None:
            conv, piece, seen = ahead[0], 0, read
            text: list[str] = []
            spans: list[list[int]] = []
            length = 0
            for s, masked in render(messages(conv)):
                if read != seen and text:  # another message has been read: close the piece
                    out.append((conv, piece, "".join(text), spans))
                    piece, text, spans, length, seen = piece + 1, [], [], 0, read
                    if len(out) >= ROWS_OUT:
                        yield batch()
                        out = []
                if s and masked:
                    if spans and spans[-1][1] == length:
                        spans[-1][1] += len(s)
                    else:
                        spans.append([length, length + len(s)])
                text.append(s)
                length += len(s)
            out.append((conv, piece, "".join(text), spans))
            for _ in messages(conv):  # a template need not read all messages
                pass
        if out:
            yield batch()

    return rows.mapInArrow(run, PIECES)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, read from the output of `format_conversations` as it comes
    (its order inside a partition): the turns parsed from the text, the loss text cut out by the
    spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        from itertools import groupby

        def stream():
            for rb in batches:
                yield from zip(*(rb.column(i).to_pylist() for i in (0, 2, 3)), strict=True)

        rows = []
        for conv, own in groupby(stream(), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = chars = total = 0

            def texts(own=own, loss=loss):
                nonlocal chars, total
                for _, text, spans in own:
                    total += len(text)
                    for a, b in spans:
                        plain = unescape(text[a:b])
                        chars += len(plain)
                        loss.update(plain.encode("utf-8"))
                    yield text

            for role, text, _ in read_turns(texts()):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))
            if len(rows) >= ROWS_OUT:
                yield _digest_batch(rows)
                rows = []
        if rows:
            yield _digest_batch(rows)

    return pieces.mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                             "formatted_chars"])
