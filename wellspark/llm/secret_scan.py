"""Secret scans: an assignment-aware lexer over source and configuration syntax.

Three base patterns (named assignment, access key, hexadecimal run) are matched over the whole
text. Beside them everything from a line with ``=`` or ``:`` to the end of the statement is lexed
into names, literals and operators and read as assignments: ``name = "literal"``,
``"key": "literal"``, ``key: bare value``, ``f(key="literal")``, ``cfg["key"] = ...``. A statement
goes on in the next line after an operator or a backslash, before a line that begins with an
operator, within brackets opened by the value, and within a string in triple quotes or backticks;
a blank line ends it. A key alone on its line takes the indented block, or the one value, below it.

Literals joined with ``+``, or standing side by side, are one value, and a name that was given a
literal earlier in the text stands for it, so the constant itself is reported when it reaches a
sensitive name. A value counts as a secret when the sensitivity of its target name times the
strength of the value is at least ``LIMIT``. The word ``key`` alone says nothing.

Defined results: a null or empty text has no findings; bytes that are not UTF-8 read as U+FFFD;
positions are code points, the end exclusive. Rows are scanned one by one, so null ids and
repeated rows do no harm, and an empty table gives no rows. A column named like the result is
replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.llm.rows import with_result

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")
LIMIT = 0.5

#: Words of a name, and what a literal with such a target weighs.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 1.0,
    "secret": 1.0,
    "secrets": 1.0,
    "token": 1.0,
    "apikey": 1.0,
    "credential": 1.0,
    "credentials": 1.0,
    "api key": 1.0,
    "access key": 1.0,
    "private key": 1.0,
    "signing key": 1.0,
    "encryption key": 1.0,
    "master key": 1.0,
    "client key": 0.8,
    "auth": 0.7,
    "bearer": 0.7,
    "pass": 0.7,
    "cookie": 0.6,
    "session": 0.6,
    "salt": 0.6,
}
#: Values that stand for a secret without being one.
PLACEHOLDER = re.compile(
    r"(?i)^(?:changeme|change_me|example|placeholder|password|secret|token|none|null|true|false|"
    r"undefined|todo|your[_-].*|my[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|\$[A-Za-z_]\w*|(.)\1*)$"
)
#: Bits of a value (length times the entropy of its characters) that count as full strength.
STRONG_BITS = 36.0
LEAST_LENGTH = 8

LEX = re.compile(
    r"""(?P<open>\"{3}|'{3}|`)
    |(?P<string>"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*')
    |(?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_$][\w$]*)*)
    |(?P<number>\d[\w.]*)
    |(?P<other>==|!=|<=|>=|=~)
    |(?P<assign>:=|=>|\+=|=|:)
    |(?P<join>\+|\.\.)
    |(?P<mark>[^\s\w])""",
    re.VERBOSE,
)
#: A configuration line: a key at its start, then everything up to the end is the value.
CONFIG = re.compile(
    r"^[\t\x20]*(?:(?:export|set|ENV|-|\#|//)[\t\x20]+)*(?P<name>[A-Za-z_][\w.-]*)[\t\x20]*[:=][\t\x20]*"
    r"(?P<value>[^\s\"'`#;,(){}\[\]][^\s\"'`;,(){}\[\]]*)[\t\x20]*(?:[#;].*)?$"
)
#: A key with nothing but, perhaps, the sign of a block after it; and a single value in a line.
KEY_ALONE = re.compile(
    r"^(?P<indent>[\t\x20]*)(?:-\x20)?[\"']?(?P<name>[A-Za-z_][\w.-]*)[\"']?[\t\x20]*:[\t\x20]*"
    r"(?P<block>[|>][+-]?\d*)?[\t\x20]*$"
)
VALUE_ALONE = re.compile(r"^[\t\x20]+(?P<value>[^\s\"'`#;,(){}\[\]-][^\s\"'`;,(){}\[\]]*)[\t\x20]*$")
NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

FINDING = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
FOUND = T.StructType([T.StructField("findings", T.ArrayType(FINDING))])


def base_spans(text: str) -> list[tuple]:
    """The spans of the three base patterns, leftmost and not overlapping within a kind."""
    out = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= ASSIGN_LEAST:
                out.append(("assign", m.start(), m.end(), None, 1.0))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                out.append(("access", m.start(), m.end(), None, 1.0))
    # A run of 16 or more is a maximal run: it starts where the run starts.
    out += [("hex", m.start(), m.end(), None, 1.0) for m in HEX.finditer(text)]
    return out


def sensitivity(name: str) -> float:
    """The weight of the most telling word or pair of words of a name."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in [*words, *pairs]), default=0.0)


def strength(value: str) -> float:
    """0 for short values, placeholders and prose, 1 for values that are hard to guess."""
    value = value.strip()
    if len(value) < LEAST_LENGTH or PLACEHOLDER.match(value) or re.search(r"\s", value):
        return 0.0
    counts = Counter(value).values()
    bits = -sum(c * math.log2(c / len(value)) for c in counts)
    return min(1.0, bits / STRONG_BITS)


class Reader:
    """Reads the assignments of one text in order and remembers what names stand for."""

    def __init__(self) -> None:
        self.values: dict[str, list[tuple[int, int, str]]] = {}
        self.findings: dict[tuple[int, int], tuple] = {}

    def assign(self, name: str, parts: list[tuple[int, int, str]], more: bool = False) -> None:
        """``parts`` are literals (start, end, text); ``more`` adds to what the name has."""
        whole = [*self.values.get(name, []), *parts] if more else parts
        self.values[name] = whole
        weight = sensitivity(name)
        score = weight * strength("".join(p[2] for p in whole)) if weight else 0.0
        if score >= LIMIT:
            for start, end, _ in whole:
                if end > start and score > self.findings.get((start, end), (0,) * 5)[4]:
                    self.findings[start, end] = ("literal", start, end, name, score)

    def lines(self, text: str, first: int) -> int:
        """Reads the statement whose line begins at ``first``; returns where the next line does."""
        last = _line_end(text, first)
        line = text[first:last]
        key = KEY_ALONE.match(line)
        if key:
            after = self.below(text, last + 1, key)
            quoted = text[last + 1 : _line_end(text, last + 1)].lstrip()[:1] in ("\"", "'", "`", "(")
            if after or key["block"] or not quoted:
                return after or last + 1
        config = CONFIG.match(line)
        if config and config["value"] != "\\":
            value = config["value"]
            start, end = config.span("value")
            self.assign(config["name"], self.values.get(value) or [(first + start, first + end, value)])
            return last + 1
        tokens, end = statement(text, first)
        self.read(tokens)
        return end + 1

    def below(self, text: str, first: int, key: re.Match) -> int:
        """Reads what stands below a key, indented; 0 if that is no block and no single value."""
        indent, parts, at = len(key["indent"]), [], first
        while at < len(text):
            last = _line_end(text, at)
            line = text[at:last]
            bare = line.strip()
            inside = len(line) - len(line.lstrip()) > indent
            if bare and not inside or not bare and not key["block"]:
                break
            if not key["block"]:
                value = VALUE_ALONE.match(line)
                if not value or value["value"].endswith(":"):
                    return 0
                start, end = value.span("value")
                self.assign(key["name"], [(at + start, at + end, value["value"])])
                return last + 1
            if bare:
                start = at + line.index(bare)
                parts.append((start, start + len(bare), bare))
            at = last + 1
        if not parts:
            return 0
        self.assign(key["name"], parts)
        return at

    def read(self, tokens: list[tuple]) -> None:
        """Reads all assignments among the tokens of a statement."""
        i = 0
        while i < len(tokens):
            kind, said = tokens[i][:2]
            if kind not in ("name", "string"):
                i += 1
                continue
            j = i + 1
            while j < len(tokens) and tokens[j][1] == "]":
                j += 1
            # An annotation between the name and its value: name: type = value
            if (
                j + 2 < len(tokens) and tokens[j][1] == ":"
                and tokens[j + 1][0] == "name" and tokens[j + 2][1] == "="
            ):
                j += 2
            if j >= len(tokens) or tokens[j][0] != "assign":
                i += 1
                continue
            parts, after = self.value(tokens, j + 1)
            if parts:
                self.assign(said, parts, more=tokens[j][1] == "+=")
                i = after
            else:
                self.values.pop(said, None)
                i = j + 1

    def value(self, tokens: list[tuple], i: int) -> tuple[list, int]:
        """Literals and known names, joined or side by side; nothing where anything else takes part."""
        parts: list[tuple[int, int, str]] = []
        opened = 0
        while i < len(tokens) and tokens[i][1] == "(":
            opened, i = opened + 1, i + 1
        while i < len(tokens):
            kind, said, start, end, _ = tokens[i]
            following = tokens[i + 1] if i + 1 < len(tokens) else ("", "", -1, -1, -1)
            if kind == "name" and len(said) <= 2 and following[0] == "string" and following[4] == end:
                i += 1  # a string prefix
                continue
            if kind == "string":
                parts.append((start, end, said))
            elif kind == "name" and said in self.values and following[1] not in ("(", "["):
                parts += self.values[said]
            else:
                return [], i
            i += 1
            while i < len(tokens) and opened and tokens[i][1] == ")":
                opened, i = opened - 1, i + 1
            if i < len(tokens) and tokens[i][0] == "join":
                i += 1
            elif not (kind == "string" and i < len(tokens) and tokens[i][0] == "string") or (
                i + 1 < len(tokens) and tokens[i + 1][0] == "assign"
            ):
                break
        return parts, i


def _line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def statement(text: str, first: int) -> tuple[list[tuple], int]:
    """The tokens (kind, said, start, end, outer start) of the statement that begins at ``first``,
    and the end of its last line. A string's start and end are those of what it says."""
    tokens: list[tuple] = []
    at, stop = first, _line_end(text, first)
    depth, assigned = 0, False
    closed: dict[str, int] = {}
    while True:
        while at < stop and (m := LEX.search(text, at, stop)):
            kind, said = m.lastgroup, m.group()
            at = m.end()
            if kind == "open":
                # Where a sign does not close any more is looked for once.
                end = -1 if closed.get(said) == -1 else text.find(said, at)
                closed[said] = end
                if end < 0 or "\n\n" in text[at:end]:
                    tokens.append(("mark", said, m.start(), at, m.start()))
                    continue
                tokens.append(("string", text[at:end], at, end, m.start()))
                at = end + len(said)
                stop = max(stop, _line_end(text, at))
            elif kind == "string":
                tokens.append((kind, said[1:-1], m.start() + 1, at - 1, m.start()))
            elif kind == "mark" and said == "\\" and at == stop:
                break
            else:
                assigned |= kind == "assign"
                if assigned and kind == "mark":
                    depth += (said in "([{") - (said in ")]}")
                tokens.append((kind, said, m.start(), at, m.start()))
        following = text[stop + 1 : _line_end(text, stop + 1)].strip() if stop < len(text) else ""
        goes_on = (
            depth > 0
            or bool(tokens) and tokens[-1][0] in ("assign", "join")
            or text[stop - 1 : stop] == "\\"
            or following[:1] == "+" and following[:2] != "+="
            or following[:2] == ".."
        )
        if not following or not goes_on:
            return tokens, stop
        at, stop = stop + 1, _line_end(text, stop + 1)


def literal_spans(text: str) -> list[tuple]:
    """Literals that reach a sensitive name."""
    reader = Reader()
    start = 0
    while start < len(text):
        equals, colon = text.find("=", start), text.find(":", start)
        mark = min((x for x in (equals, colon) if x >= 0), default=-1)
        if mark < 0:
            break
        start = reader.lines(text, text.rfind("\n", start, mark) + 1 or start)
    return list(reader.findings.values())


def findings(text: str) -> list[tuple]:
    """All spans by start, then kind as listed, then end."""
    found = base_spans(text)
    if "=" in text or ":" in text:
        found += literal_spans(text)
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def scanned(
    docs: DataFrame, *, text: str = "text", into: str = "secrets", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into``, whose ``findings`` are the
    spans with kind, name of the target and score."""
    names = [f.name for f in FINDING.fields]
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()),
             ("score", pa.float64())]
        )
    )

    def compute(texts: pa.Array) -> list[pa.Array]:
        said = (t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist())
        return [pa.array([[dict(zip(names, f)) for f in findings(t)] for t in said], kind)]

    return with_result(docs, into, FOUND, compute, text=text, keep=keep)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
