"""Token stream of source and configuration text: literals that belong to sensitive names by structure.

Comments, strings, brackets and statements are told apart, whatever white space, types or
line breaks lie between a name and its value. A literal belongs to a name when it is
assigned to it, also as one of several literals in brackets after it (concatenations, lists), under a
key that only says "value" inside it, as the next argument of a call that names it, as the text of an
element or the argument of a command flag of that name, or as the lines of a YAML block below it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_TOKEN = re.compile(
    r"""(?P<skip>/\*(?:[^*]|\*(?!/))*+\*/|(?<![:\w])//[^\n]*+|(?<![\w$&])\#[ !][^\n]*+)"""
    r"""|(?P<string>\"{3}(?:[^"\\]|\\[\s\S]|"(?!""))*+\"{3}|'{3}(?:[^'\\]|\\[\s\S]|'(?!''))*+'{3}"""
    r"""|"(?:[^"\\\n]|\\[\s\S])*+"|(?<!\w)'(?:[^'\\\n]|\\[\s\S])*+'|`[^`]*+`)"""
    r"""|(?P<flag>(?<!\S)--?[A-Za-z][\w\-]*+)"""
    r"""|(?P<name>[A-Za-z_$][\w$]*+(?:[.\-][\w$]++)*+)"""
    r"""|(?P<sign>===?|!==?|<=|>=|=>|->|:=|::|[=:,;()\[\]{}<>+\n])""")
_QUOTES = {'"', "'", "`"}
_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, {")", "]", "}"}
# Keys that only say that what they hold is the value of what holds them.
_GENERIC = {"value", "val", "values", "data", "default", "content", "plain", "raw", "text", "current", "literal"}
_KEY = re.compile(r"[ \t\n]*+(?::(?!:)|=(?!=))")
_WORD = re.compile(r"[\w.\-/]{1,256}")
_ELEMENT = re.compile(r"<([A-Za-z_][\w:.\-]*+)(?:[ \t\n][^<>]*+)?>([^<]++)</([A-Za-z_][\w:.\-]*+)[ \t\n]*+>")
_BLOCK = re.compile(r"""(?m)^([ \t]*+)(?:-[ ]++)?["']?([\w.\-]++)["']?[ \t]*+:[ \t]*+[|>][-+\d]*+[ \t]*+\n""")
_ARGUMENT = re.compile(r"[ \t]++(\"(?:[^\"\\\n]|\\[\s\S])*+\"|'(?:[^'\\\n]|\\[\s\S])*+'|[^\s\"'`|&;<>\-][^\s\"'`|&;<>]*+)")


def _inside(text: str, a: int, z: int) -> tuple[int, int]:
    """A string token without its quotes."""
    width = 3 if z - a >= 6 and text[a:a + 3] in ('"""', "'''") else 1
    return a + width, z - width


def _stream(text: str, sensitivity: Callable[[str], float]):
    """Yield (start, end, sensitivity) of string literals by the names that they belong to."""
    weights: dict[str, float] = {}

    def weight(name: str) -> float:
        if name not in weights:
            weights[name] = sensitivity(name)
        return weights[name]

    # of each open bracket: sign, weight that literals inside inherit, weight asked for by a call's last argument
    stack: list[list] = [["", 0.0, 0.0]]
    key, last, declared, target = "", "", 0.0, 0.0
    after_key = assigned = False
    for m in _TOKEN.finditer(text):
        kind, token = m.lastgroup, m[0]
        if kind == "skip" or kind == "flag":
            continue
        if kind == "name":
            if not (after_key and len(token) <= 2 and text[m.end():m.end() + 1] in _QUOTES):   # a string's prefix
                key, last, target, assigned = token, "name", 0.0, False
            continue
        if kind == "string":
            a, z = _inside(text, *m.span())
            if assigned and target:
                yield a, z, target
            elif not _KEY.match(text, m.end()):
                if last in ("(", "[", "{", ",", "string") and stack[-1][1]:
                    yield a, z, stack[-1][1]
                elif last == "," and stack[-1][2]:
                    yield a, z, stack[-1][2]
            names = stack[-1][0] == "call" and last in ("(", ",") and _WORD.fullmatch(text, a, z)
            stack[-1][2] = weight(text[a:z]) if names else 0.0
            key, last = text[a:z] if z - a <= 256 else "", "string"
            continue
        if token in ("=", ":", ":=", "=>"):
            own = weight(key) if key and last in ("name", "string", "]", "?") else 0.0
            if key.lower() in _GENERIC and stack[-1][1] and last in ("name", "string"):
                own = stack[-1][1]
            if token == "=" and not own and last in (">", "]", ")"):
                own = declared                       # a type lay between
            if token == ":":
                declared = own
            target, assigned, after_key = own, True, True
            last = token
            continue
        after_key = False
        if token in _OPEN:
            call = token == "(" and last == "name" and not assigned
            stack.append(["call" if call else token, target if assigned else 0.0 if call else stack[-1][1], 0.0])
            assigned, target = False, 0.0
        elif token in _CLOSE:
            if len(stack) > 1:
                stack.pop()
            assigned = False
        elif token == "\n":
            if last not in ("=", ":=", "=>", "+", ":"):
                assigned, target, declared = False, 0.0, 0.0
            continue
        elif token == ";":
            assigned, target, declared = False, 0.0, 0.0
        elif token != "+":
            assigned = False
        last = token


def structured_spans(text: str, sensitivity: Callable[[str], float], score: Callable[[str], float],
                     least: float = 0.5) -> list[tuple[int, int]]:
    """Spans whose name's sensitivity times the literal's score is ``least`` or more."""
    found = set()

    def take(a: int, z: int, weight: float) -> None:
        if weight and weight * score(text[a:z]) >= least:
            found.add((a, z))

    for a, z, weight in _stream(text, sensitivity):
        take(a, z, weight)
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            if m[1] == m[3] and (weight := sensitivity(m[1])):
                inner = m[2].strip()
                a = m.start(2) + len(m[2]) - len(m[2].lstrip())
                take(a, a + len(inner), weight)
    for m in _TOKEN.finditer(text) if "-" in text else ():
        if m.lastgroup == "flag" and (weight := sensitivity(m[0])) and (v := _ARGUMENT.match(text, m.end())):
            quoted = text[v.start(1)] in _QUOTES
            take(v.start(1) + quoted, v.end(1) - quoted, weight)
    for m in _BLOCK.finditer(text):
        if not (weight := sensitivity(m[2])):
            continue
        at = end = m.end()
        while at < len(text):                        # the lines that are further in
            stop = text.find("\n", at)
            stop = len(text) if stop < 0 else stop
            line = text[at:stop]
            if line.strip():
                if len(line) - len(line.lstrip(" \t")) <= len(m[1]):
                    break
                end = stop
            at = stop + 1
        block = text[m.end():end]
        a = m.end() + len(block) - len(block.lstrip())
        if any(weight * score(part) >= least for part in {block.strip(), *block.split("\n"), *block.split()}):
            found.add((a, end))
    return sorted(found)
