"""CHECK clauses in a form that raises no error for a row, with a condition that tells the rows that would have.

A clause is read as nested brackets of tokens. Casts and conversions take their ``try_`` form, divisors that are zero
become NULL, and elements beyond the end are NULL; each such place adds a condition under which it has no value.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Conversions that fail on some values, and what to call instead.
TRIED = {"to_number": "try_to_number", "to_date": "try_to_date", "to_timestamp": "try_to_timestamp",
         "to_binary": "try_to_binary", "element_at": "try_element_at", "parse_json": "try_parse_json",
         "to_time": "try_to_time", "make_date": None, "parse_url": "try_parse_url", "make_timestamp": "try_make_timestamp"}
# Type names that convert when called as functions.
TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "boolean")

_TOKEN = re.compile(r"[rRxX]?'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|\.\d+|\w+|\s+|::|<=>|<>|[<>!=]=?|.", re.S)


@dataclass
class _Group:
    """A bracket and what is in it."""

    open: str
    items: list = field(default_factory=list)


_CLOSE = {"(": ")", "[": "]"}


def _nested(clause: str) -> list:
    stack = [_Group("")]
    for token in _TOKEN.findall(clause):
        if token in _CLOSE:
            stack.append(_Group(token))
        elif len(stack) > 1 and token == _CLOSE[stack[-1].open]:
            group = stack.pop()
            stack[-1].items.append(group)
        elif not token.isspace():
            stack[-1].items.append(token)
    while len(stack) > 1:  # an open bracket: the parser will say so
        group = stack.pop()
        stack[-1].items += [group.open, *group.items]
    return stack[0].items


def _split(items: list, word: str) -> list[list]:
    parts = [[]]
    for item in items:
        if isinstance(item, str) and item.lower() == word:
            parts.append([])
        else:
            parts[-1].append(item)
    return parts


class _Rewriting:
    def __init__(self) -> None:
        self.failures: list[str] = []

    def text(self, items: list) -> str:
        """Items as text; operands are taken whole: a name or literal with the brackets behind it."""
        out: list[str] = []
        at = 0
        while at < len(items):
            item = items[at]
            divisor = bool(out) and out[-1] in ("/", "%", "div")
            sign = ""
            while divisor and item in ("-", "+") and at + 1 < len(items):
                sign, at = sign + item + " ", at + 1
                item = items[at]
            operand, at = self.operand(items, at)
            if divisor:
                self.failures.append(f"({operand}) = 0")
                operand = f"{sign}nullif({operand}, 0)"
            out.append(operand)
        return " ".join(out)

    def operand(self, items: list, at: int) -> tuple[str, int]:
        item, at = items[at], at + 1
        if isinstance(item, _Group):
            out = item.open + self.text(item.items) + _CLOSE[item.open]
        else:
            out = item.lower() if item.lower() == "div" else item
            called = at < len(items) and isinstance(items[at], _Group) and items[at].open == "("
            if called and re.fullmatch(r"\w+", item) and item.lower() not in ("and", "or", "not", "in", "between", "like", "rlike", "when", "then", "else", "is", "div"):
                out, at = self.call(item, items[at].items), at + 1
        while at < len(items):
            follows = items[at]
            if follows == "." and at + 1 < len(items) and isinstance(items[at + 1], str):
                out, at = f"{out}.{items[at + 1]}", at + 2
            elif isinstance(follows, _Group) and follows.open == "[":
                inner = self.text(follows.items)
                self.failures.append(f"({out}) IS NOT NULL AND ({inner}) IS NOT NULL AND get({out}, {inner}) IS NULL")
                out, at = f"get({out}, {inner})", at + 1
            elif follows == "::" and at + 1 < len(items):
                kind, at = items[at + 1], at + 2
                if at < len(items) and isinstance(items[at], _Group) and items[at].open == "(":
                    kind, at = kind + "(" + "".join(items[at].items) + ")", at + 1
                out = self.converted(out, kind)
            else:
                break
        return out, at

    def converted(self, value: str, kind: str) -> str:
        self.failures.append(f"({value}) IS NOT NULL AND try_cast({value} AS {kind}) IS NULL")
        return f"try_cast({value} AS {kind})"

    def call(self, name: str, items: list) -> str:
        word = name.lower()
        if word == "cast":
            *value, kind = _split(items, "as")
            if value:
                return self.converted(self.text([x for part in value for x in part]), self.plain(kind))
        args = [self.text(part) for part in _split(items, ",")]
        if word in TYPES and len(args) == 1:
            return self.converted(args[0], word)
        if TRIED.get(word):
            call = f"{TRIED[word]}({', '.join(args)})"
            self.failures.append(" AND ".join(f"({a}) IS NOT NULL" for a in args) + f" AND {call} IS NULL")
            return call
        if word in ("mod", "pmod") and len(args) == 2:
            self.failures.append(f"({args[1]}) = 0")
            return f"{name}({args[0]}, nullif({args[1]}, 0))"
        return f"{name}({', '.join(args)})"

    def plain(self, items: list) -> str:
        return " ".join(x if isinstance(x, str) else x.open + self.plain(x.items) + _CLOSE[x.open] for x in items)


def tried_clause(clause: str) -> tuple[str, str]:
    """A Spark SQL condition that gives NULL where the clause would raise, and a condition for the rows where it does.

    A row counts as not evaluated when some place of the clause has no value and the whole is unknown: ``t = 'x' OR
    cast(t AS int) > 0`` is evaluated for ``x``. Sums and products that overflow still raise,
    and so does an index of zero.
    """
    work = _Rewriting()
    text = work.text(_nested(clause))
    failed = " OR ".join(f"coalesce({f}, false)" for f in dict.fromkeys(work.failures)) or "false"
    return text, f"({text}) IS NULL AND ({failed})"
