"""Metric formulas: a small tree of the arithmetic that a catalog may use.

A formula is arithmetic over names, numbers and calls of known functions:
``+ - * / %``, signs, brackets to any depth, and names that may be quoted
("..." or `...`). The tree says where each divisor begins and ends, so the
division guard is put around exactly one operand, and planning refuses what it
cannot read. Nodes are built with a stack of operators, so nesting has no
limit.

``guard_division`` does the same to a column of formulas of any number, as one
fold over a formula's tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tractlake.functions.columns import col_of

# Operators by how tightly they bind, and the functions that a formula may call.
BINDING = {"+": 1, "-": 1, "*": 2, "/": 2, "%": 2}
DIVISIONS = ("/", "%")
FUNCTIONS = ["abs", "ceil", "ceiling", "coalesce", "floor", "greatest", "least", "nullif", "round", "sqrt"]

_TOKEN = re.compile(r"""(?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?!\w))|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<quoted>`(?:[^`]|``)+`|"(?:[^"]|"")+")|(?P<sign>[-+*/%(),])|(?P<blank>\s+)""")


class FormulaError(ValueError):
    """The formula is not arithmetic over names, numbers and known functions."""


@dataclass
class Node:
    """``kind``: number, name, call, sign, binary or group; ``start`` and ``end`` in the formula."""
    kind: str
    text: str
    start: int
    end: int
    parts: list = field(default_factory=list)

    def walk(self):
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.parts))


def _tokens(formula: str):
    at = 0
    while at < len(formula):
        m = _TOKEN.match(formula, at)
        if m is None:
            raise FormulaError(f"cannot read {formula[at:at + 20]!r} at {at} in formula {formula!r}")
        at = m.end()
        if m.group() == "-" == formula[at:at + 1]:
            raise FormulaError(f"'--' begins a comment in formula {formula!r}")
        if m.lastgroup != "blank":
            yield m.lastgroup, m.group(), m.start(), m.end()


def unquoted(text: str) -> str:
    """A quoted name's own spelling."""
    return text[1:-1].replace(text[0] * 2, text[0]) if text[:1] in "`\"" else text


def parse(formula: str) -> Node:
    """The tree of a formula."""
    def fail(why):
        raise FormulaError(f"{why} in formula {formula!r}")
    operands, operators = [], []  # operators: (kind, text, start, operands before it)

    def build():
        kind, text, start, _ = operators.pop()
        if kind == "sign":
            operands[-1] = Node("sign", text, start, operands[-1].end, [operands[-1]])
        else:
            right, left = operands.pop(), operands.pop()
            operands.append(Node("binary", text, left.start, right.end, [left, right]))

    def unwind(binding):
        while operators and operators[-1][0] in ("sign", "binary") and (
                operators[-1][0] == "sign" or BINDING[operators[-1][1]] >= binding):
            build()
    tokens, wanted = list(_tokens(formula)), True  # is an operand due?
    for i, (kind, text, start, end) in enumerate(tokens):
        if kind != "sign":
            if not wanted:
                fail(f"no operator before {text!r}")
            if i + 1 < len(tokens) and tokens[i + 1][1] == "(":
                if kind != "name":
                    fail(f"{text!r} cannot be called")
                if text.lower() not in FUNCTIONS:
                    fail(f"unknown function {text!r}")
                operators.append(("call", text, start, len(operands)))
                continue
            operands.append(Node("number" if kind == "number" else "name", text, start, end))
            wanted = False
        elif text == "(":
            if not wanted:
                fail("no operator before '('")
            if not (operators and operators[-1][0] == "call" and tokens[i - 1][2] == operators[-1][2]):
                operators.append(("group", text, start, len(operands)))
        elif text in ("+", "-") and wanted:
            operators.append(("sign", text, start, len(operands)))
        elif wanted:
            fail(f"no operand before {text!r}")
        elif text in BINDING:
            unwind(BINDING[text])
            operators.append(("binary", text, start, len(operands)))
            wanted = True
        else:
            unwind(0)
            if not operators:
                fail(f"{text!r} without '('")
            opened, name, first, before = operators[-1]
            if text == ",":
                if opened != "call":
                    fail("',' outside a call")
                wanted = True
                continue
            operators.pop()
            inner = operands[before:]
            del operands[before:]
            operands.append(Node(opened, name, first, end, inner))
    if wanted:
        fail("no operand at the end")
    unwind(0)
    if operators:
        fail("'(' without ')'")
    return operands[0]


def divisors(tree: Node):
    """(division, divisor) for each division whose divisor is not guarded yet."""
    for node in tree.walk():
        if node.kind == "binary" and node.text in DIVISIONS:
            right = node.parts[1]
            if not (right.kind == "call" and right.text.lower() == "nullif"):
                yield node, right


def guard_text(formula: str) -> str:
    """The formula with every divisor inside ``NULLIF(…, 0)``; the rest as it is written."""
    edits = []
    for node, right in divisors(parse(formula)):
        slash = formula.index(node.text, node.parts[0].end)
        edits += [(slash + 1, right.start, " NULLIF("), (right.end, right.end, ", 0)")]
    out, at = [], 0
    for start, end, text in sorted(edits):
        out += [formula[at:start], text]
        at = end
    return "".join(out) + formula[at:]


def names_of(formula: str) -> list:
    """The names of a formula, as written."""
    return [n.text for n in parse(formula).walk() if n.kind == "name"]


def replace_names(formula: str, new) -> str:
    """The formula with each name's text replaced by ``new(name, text)``."""
    out, at = [], 0
    for node in sorted((n for n in parse(formula).walk() if n.kind == "name"), key=lambda n: n.start):
        out += [formula[at:node.start], new(unquoted(node.text), node.text)]
        at = node.end
    return "".join(out) + formula[at:]


# --- A column of formulas -------------------------------------------------------------------

_PIECES = r"""\s*(?:`[^`]*`|"[^"]*"|[\w.]+|[^\s\w])|\s+$"""


def guard_division(formula) -> Column:
    """Every divisor of a formula column inside ``NULLIF(…, 0)``.

    One fold over the formula's tokens, native and without a limit of depth:
    a division opens the guard, signs belong to the operand, and the guard
    closes behind a name or number, or behind the bracket that ends a group
    or call. Operands that are guarded stay. Under ANSI mode an unguarded
    division by zero fails the job, while the guarded one yields NULL.
    """
    pieces = F.regexp_extract_all(col_of(formula), F.lit(_PIECES), 0)
    core = lambda p: F.lower(F.btrim(F.coalesce(p, F.lit(""))))
    steps = F.transform(pieces, lambda p, i: F.struct(
        p.alias("raw"), F.btrim(p).alias("t"), core(F.get(pieces, i + 1)).alias("next"),
        core(F.get(pieces, i + 2)).alias("after")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("depth"),
                     F.array().cast("array<int>").alias("open"), F.lit(0).alias("due"))

    def state(out, depth, open_, due):
        return F.struct(out.alias("out"), depth.alias("depth"), open_.alias("open"), due.alias("due"))

    def step(s, x):
        out, depth, open_, due = s["out"], s["depth"], s["open"], s["due"]
        t = x["t"]
        raw = F.when(due == 1, t).otherwise(x["raw"])  # no blanks right behind the guard's bracket
        said = F.concat(out, raw)
        opened = F.when(due > 0, F.concat(open_, F.array(depth))).otherwise(open_)
        division = t.isin(*DIVISIONS) & ~((x["next"] == "nullif") & (x["after"] == "("))
        ends = (F.size(open_) > 0) & (F.try_element_at(open_, F.lit(-1)) == depth - 1)
        return (
            F.when(division & (due == 0), state(F.concat(out, x["raw"], F.lit(" NULLIF(")), depth, open_, F.lit(1)))
            .when(t == "(", state(said, depth + 1, opened, F.lit(0)))
            .when((t == ")") & ends, state(F.concat(said, F.lit(", 0)")), depth - 1,
                                           F.slice(open_, F.lit(1), F.size(open_) - 1), F.lit(0)))
            .when(t == ")", state(said, depth - 1, open_, F.lit(0)))
            .when((due > 0) & t.isin("+", "-"), state(said, depth, open_, F.lit(2)))
            .when((due > 0) & (x["next"] == "("), state(said, depth, opened, F.lit(0)))
            .when((due > 0) & (t != ""), state(F.concat(said, F.lit(", 0)")), depth, open_, F.lit(0)))
            .otherwise(state(said, depth, open_, due)))
    return F.aggregate(steps, start, step, lambda s: s["out"])
