"""Secret scan by lexing assignments of source code and configuration files.

Base patterns find spans by form alone. Besides them, every ``=`` or ``:`` of a text
is read as a possible assignment: a name before it (identifier, dotted or quoted
key) and an expression of literals and names after it. Literals bound to a
name are constants; a later expression that uses the name gets them too. A
literal is reported, whole and at any length, when a name it reaches is a sensitive
one and the literal looks like a credential, a key block or a phrase of several words.
What lies further from its name (brackets, nested keys, call arguments, elements, flags, blocks of
lines) is found in a stream of tokens (``secret_lexer``).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from functools import cached_property

from pyspark.sql import DataFrame

from .common import lean, slices
from .secret_lexer import structured_spans

# The base patterns of the contract, in the order of their kinds.
KINDS = ("assign", "access", "hex", "lexed")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")     # = AKIA[A-Z0-9]+ of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")            # = [0-9a-f]+ of 24 characters or more
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Parts of names and how much they speak for a credential.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signingkey": 0.9,
    "encryptionkey": 0.9, "authkey": 0.9, "credential": 0.9, "credentials": 0.9, "pass": 0.7,
    "auth": 0.6, "bearer": 0.8, "authorization": 0.7, "webhook": 0.5, "dsn": 0.5,
}
# Parts that say the value is about a credential but is none.
HARMLESS = {"length", "len", "min", "max", "count", "policy", "file", "path", "url", "uri", "hint",
            "field", "name", "label", "type", "expiry", "expires", "ttl", "limit", "regex", "id"}
PLACEHOLDERS = {"changeme", "password", "passwd", "secret", "token", "example", "placeholder",
                "redacted", "undefined", "required", "default", "string", "optional", "localhost"}
# Words of messages about credentials; a phrase with one of them, or with a sensitive word, is none.
MESSAGE = {"please", "enter", "your", "invalid", "incorrect", "wrong", "must", "required", "missing", "forgot",
           "forgotten", "reset", "change", "confirm", "cannot", "failed", "expired", "error", "used", "should"}
# Without one of these no name is sensitive.
_HINT = re.compile("pass|pwd|secret|token|key|credential|auth|bearer|webhook|dsn")
_LONGEST_PLACEHOLDER = max(map(len, PLACEHOLDERS))
_KEY_BLOCK = re.compile("-----BEGIN ")
_URL = re.compile("://")
_SCHEME = re.compile(r"(?:Bearer|Basic|Token)[ ]+(?=\S+\Z)", re.IGNORECASE)
_PHRASE = re.compile(r"[^\s<>{}=;]++(?:[ \t]++[^\s<>{}=;]++)++\Z")

_OPERATOR = re.compile(r"[=:]")
_NAME_BEFORE = re.compile(r"""(?:"([^"\n]{1,128})"|'([^'\n]{1,128})'|([A-Za-z_$][\w$.\-]{0,127}))\]?[ \t]*:?$""")
_BARE = r"""(?:\$\{[^}\n]{0,128}\}|\+(?=\S)|[^\s"'`,;(){}\[\]<>+])"""
_ATOM = re.compile(
    r"""[ \t]*(?:[|>][-+]?\d?[ \t]*\n\s*)?(?:(-----BEGIN [A-Z0-9 ]+-----(?:[^-]|-(?!----))*+-----END [A-Z0-9 ]+-----)"""
    r"""|(?:[bBrRuUfFlL@$]{1,2}\#{0,3}(?=["'`]))?(?:\"{3}((?:[^"\\]|\\[\s\S]|"(?!""))*+)\"{3}|'{3}((?:[^'\\]|\\[\s\S]|'(?!''))*+)'{3}"""
    r"""|"([^"\\\n]*+(?:\\[\s\S][^"\\\n]*+)*+)"|'([^'\\\n]*+(?:\\[\s\S][^'\\\n]*+)*+)'|`([^`]*+)`)"""
    r"""|(""" + _BARE + "{1,600}))")
_BARE_KIND = _ATOM.groups
_MORE = re.compile(_BARE + "*+")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*(?:\n[ \t]*)?")
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z")
_INSIDE = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_][\w.]*)\}")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
# A type between a name and its "=": "name: type =" in many languages, "name type =" in Go, SQL and Visual Basic.
_TYPE_WORD = r"""(?:[&*?]|\[\]|'[a-z]\w*[ \t]+|(?:mut|dyn|readonly|const)[ \t]+)*""" \
    r"""(?:\[[^=\n"]{0,80}\]|[A-Za-z_]\w*(?:(?:\.|::)\w+)*(?:[<\[(][^=\n"]{0,80}[>\])])?)[?!*&]*(?:\[\])*"""
_TYPE = rf"(?>(?>{_TYPE_WORD})(?:[ \t]*\|[ \t]*(?>{_TYPE_WORD}))*)"
_PLAIN_TYPE = r"""(?:\*?(?:\[\])?(?:string|byte|rune|any)|interface\{\}|(?i:n?(?:var)?char|text)(?:[ \t]?\(\w+\))?)"""
_COLON_TYPE = re.compile(rf"([A-Za-z_$][\w$]*|\"[^\"\n]{{1,128}}\"|'[^'\n]{{1,128}}')[?!]?[ \t]*:[ \t]*({_TYPE})\Z")
_WORD_TYPE = re.compile(rf"([A-Za-z_]\w*)[ \t]+(?:{_PLAIN_TYPE}|[Aa]s[ \t]+[A-Za-z_][\w.]*)\Z"
                        rf"|\bvar[ \t]+([A-Za-z_]\w*)[ \t]+{_TYPE_WORD}\Z")
_CONDITION = re.compile(r"(?:\b(?:if|elif|else|while|not|and|or|in|is|case|when|for|with|return|lambda)|\?|==|&&|\|\|)[ \t]*!?\Z")
_TYPE_AFTER = re.compile(rf"""[ \t]*{_TYPE}(?:[ \t]+=[ \t]+(?=[^\s=])|[ \t]*=[ \t]*(?=[brfu@$]{{0,2}}["'`]))""")
_TYPE_NAMES = {"str", "string", "bytes", "byte", "char", "final", "any", "text", "varchar", "nvarchar", "object", "u8"}


def _typed_name(before: str) -> str | None:
    """The name that ``before``, the text up to a "=", declares with a type."""
    if ":" in before and (m := _COLON_TYPE.search(before)):
        return None if _CONDITION.search(before[max(0, m.start() - 12):m.start()]) else m[1].strip("\"'")
    m = _WORD_TYPE.search(before)
    return m and (m[1] or m[2])


def sensitivity(name: str) -> float:
    """0 to 1: how surely ``name`` names a credential; single parts and pairs of parts count."""
    parts = [p.lower() for p in _PART.findall(name)]
    if parts and parts[-1] in HARMLESS:
        return 0.0
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *pairs]), default=0.0)


class Literals:
    """Scores of literals of one text, each taken from all of its characters.

    Literals that end alike (of a long bare run with many names) share their counts of characters.
    """

    def __init__(self, text: str):
        self.text, self.at, self.counts = text, (0, 0), Counter()

    def _counted(self, a: int, z: int) -> Counter:
        """Characters of text[a:z] with their numbers."""
        begin, end = self.at
        if z == end and abs(a - begin) < z - a:
            self.counts.update(self.text[a:begin])
            self.counts.subtract(self.text[begin:a])
            self.counts = +self.counts
        else:
            self.counts = Counter(self.text[a:z])
        self.at = a, z
        return self.counts

    @cached_property
    def _blocks(self) -> list[int]:
        return [m.start() for m in _KEY_BLOCK.finditer(self.text)]

    @cached_property
    def _schemes(self) -> list[int]:
        return [m.start() for m in _URL.finditer(self.text)]

    def _holds(self, places: list[int], a: int, z: int) -> bool:
        at = bisect_left(places, a)
        return at < len(places) and places[at] < z

    def score(self, a: int, z: int) -> float:
        """0 to 1: how much text[a:z] looks like a credential (length, kinds of characters, entropy)."""
        text = self.text
        if self._holds(self._blocks, a, z - len("-----BEGIN ") + 1):
            return 1.0
        a = m.end() if (m := _SCHEME.match(text, a, z)) else a
        length = z - a
        if length < 6 or length <= _LONGEST_PLACEHOLDER and text[a:z].lower() in PLACEHOLDERS:
            return 0.0
        counts = self._counted(a, z)
        if len(counts) < 4:
            return 0.0
        if text[a] in "<$%{" or "@" not in counts and self._holds(self._schemes, a, z - 2):
            return 0.0
        if any(c.isspace() for c in counts):
            words = {w.strip(".,:!?").lower() for w in text[a:z].split()}
            return 0.6 if length >= 8 and _PHRASE.match(text, a, z) and not words & (MESSAGE | SENSITIVE.keys()) else 0.0
        kinds = sum(any(f(c) for c in counts) for f in (str.islower, str.isupper, str.isdigit)) \
            + any(not c.isalnum() for c in counts)
        bits = -math.fsum(n / length * math.log2(n / length) for n in counts.values())
        return min(1.0, 0.15 * kinds + 0.1 * min(bits, 4.0) + 0.02 * min(length, 15))


def literal_score(value: str) -> float:
    """The score of a literal by itself."""
    return Literals(value).score(0, len(value))


def lexed_spans(text: str, least: float = 0.5) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name with sensitivity * literal score >= ``least``.

    Every piece of an expression keeps its literal and refers to the names it uses and
    to the piece after it; a name reaches all of them, each visited again only for a
    more sensitive name. Expressions that end alike share their last pieces.
    """
    expressions: list[list] = []       # of each piece: spans, and numbers of others
    starts: dict[int, int] = {}        # place of a piece -> its number
    constants: dict[str, int] = {}
    scores: dict[tuple[int, int], float] = {}
    literals = Literals(text)
    visited: dict[int, float] = {}
    found = set()
    run = (0, 0, 0)                    # rest of a long bare literal, and the number of its names

    def used(at, end):
        return (constants[n] for r in _INSIDE.finditer(text, at, end) if (n := r[1] or r[2] or r[3]) in constants)

    for m in _OPERATOR.finditer(text):
        at = m.start()
        after = text[at + 1:at + 3]
        if after[:1] in ("=", "~") or after == "//" or text[at - 1:at] in ("=", "!", "<", ">", "~") and at:
            continue
        before = text[max(0, at - 280):at].rstrip(" \t")
        name = _NAME_BEFORE.search(before, max(0, len(before) - 140))
        targets = [name[1] or name[2] or name[3]] if name else []
        if m[0] == "=" and before[-1:] != ":" and (typed := _typed_name(before.rpartition("\n")[2])):
            targets = [typed, *(t for t in targets if t.lower() not in _TYPE_NAMES)]
        if not targets:
            continue
        place = at + 1 + (after[:1] in (">",))
        if m[0] == ":" and _TYPE_AFTER.match(text, place):
            continue                   # a type; the "=" after it assigns
        number, pieces, some = len(expressions), [], False
        while a := _ATOM.match(text, place):
            kind = a.lastindex
            if kind is None:
                break
            if place in starts:
                pieces.append(starts[place])
                some = True
                break
            pieces.append(len(expressions))       # the piece after the last one
            pieces = []
            starts[place] = len(expressions)
            expressions.append(pieces)
            begin, end = a.span(kind)
            place = a.end()
            if kind < _BARE_KIND:
                pieces += [(begin, end), *used(begin, end)]
            elif end - begin < 600 and _IDENTIFIER.match(text, begin, end) and text[begin:end] in constants:
                pieces.append(constants[text[begin:end]])
            else:
                more = end - begin >= 600
                if more and not run[0] <= end <= run[1]:
                    run = (end, _MORE.match(text, end).end(), len(expressions))
                    expressions.append([*used(end - 130, run[1])])
                if more:
                    place = run[1]
                    pieces.append(run[2])
                if text[place:place + 1] != "(":
                    pieces += [(begin, place), *used(begin, end)]
            some = some or bool(pieces)
            if not (j := _JOIN.match(text, place)):
                break
            place = j.end()
        if not some:
            continue
        if number == len(expressions):            # nothing but pieces met before
            number = pieces[0]
        constants.update(dict.fromkeys(targets, number))
        weight = max(map(sensitivity, targets))
        todo = [number] if weight else []
        while todo:
            e = todo.pop()
            if visited.get(e, 0.0) >= weight:
                continue
            visited[e] = weight
            for piece in expressions[e]:
                if isinstance(piece, int):
                    todo.append(piece)
                    continue
                if piece not in scores:
                    scores[piece] = literals.score(*piece)
                if weight * scores[piece] >= least:
                    found.add(piece)
    return sorted(found)


def scan(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """All spans of a text by start, then kind: (start, kind number, end, secret start, secret end).

    Offsets are code points, ends exclusive. For ``assign`` the secret is the value, else the span.
    """
    if not text:
        return []
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    lexed = set(lexed_spans(text)) if "=" in text or ":" in text else set()
    if _HINT.search(low):
        lexed |= set(structured_spans(text, sensitivity, literal_score))
    return sorted(out + [(a, 3, z, a, z) for a, z in lexed if a < z])


def redact(text: str | None, spans, mark: str = "[SECRET]") -> str | None:
    """The text with every secret replaced by ``mark``; overlapping secrets become one."""
    if not spans:
        return text
    out, done = [], 0
    merged: list[list[int]] = []
    for a, z in sorted((s[3], s[4]) for s in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z])
    for a, z in merged:
        out += [text[done:a], mark]
        done = z
    return "".join([*out, text[done:]])


def _joined(spans) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def _scanned(batches):
    import pyarrow as pa

    for batch in batches:
        for part in slices(batch, 8 << 20):
            found = [scan(t) for t in part.column("text").to_pylist()]
            counts = [[sum(s[1] == k for s in f) for f in found] for k in range(len(KINDS))]
            base = [hashlib.sha256(_joined([s for s in f if s[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(base, pa.string()), pa.array(map(_joined, found), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_lexed", "base_sha256", "spans"])


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Secrets of every whole text of ``documents`` (doc_id, text), one row per row.

    Returns doc_id, n_assign, n_access, n_hex, n_lexed (numbers of spans by kind), base_sha256 (of the
    spans of the first three kinds), spans (all: kind:start:end by start, then
    kind, comma-joined). Null and empty texts have no span, and the checksum of
    the empty text. Repeated rows give repeated rows. Other columns are ignored.
    """
    return documents.select("doc_id", "text").mapInArrow(
        lean(_scanned), "doc_id long, n_assign long, n_access long, n_hex long, n_lexed long, "
                  "base_sha256 string, spans string")


def redact_secrets(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret in ``text`` replaced; ``n_chars`` is recounted where that happens."""
    counted = "n_chars" in documents.columns

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 8 << 20):
                texts = part.column("text").to_pylist()
                clean = [redact(t, scan(t)) for t in texts]
                columns = {f.name: part.column(i) for i, f in enumerate(part.schema)}
                columns["text"] = pa.array(clean, part.schema.field("text").type)
                if counted:
                    own = part.column("n_chars").to_pylist()
                    columns["n_chars"] = pa.array(
                        [len(c) if c != t else n for t, c, n in zip(texts, clean, own)],
                        part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return documents.mapInArrow(lean(run), documents.schema)
