"""Secret scan by assignment-aware lexing.

Three plain patterns come first (assignments to telling names, access keys, long hexadecimal
runs). Beyond them, source and configuration syntax is lexed into pairs of a name and the literals
assigned to it: ``name = "x" + "y"``, ``name: x``, ``"name": "x"``, ``name := x``, ``name => x``,
``a = name = "x"``, ``name = y || "x"``, ``name = get("key", "x")``, ``<name>x</name>`` and
``set_name("x")``, on one line, after a line break that is escaped, or in brackets.
A literal that is first kept under another name, or under a key, is followed to the name it ends up
under. The names score by the sensitive words they hold, the literals by length, variety and by not
being a placeholder; a literal of enough score is a ``literal`` span. Several words weigh only as a
quoted pass phrase. Where an expression has quoted parts, names that nothing is known of are no text.

Texts without any telling byte sequence are passed over by fast searches that cover the whole
text; the others are lexed whole. A name keeps references to the names it is made of, so this takes
time that follows their length, and each assignment to a sensitive name the time of all the literals
it is made of.

Nulls and empties: a null or empty text has no spans. Places are code points, ends exclusive.
Rows that repeat are scanned alike, other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.frames import as_bytes, columns, map_batches

Span = tuple[int, int, int]
KINDS = ("assign", "access", "hex", "literal")

# The plain patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# Words of sensitive names with their weights.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8,
}
PLACEHOLDER = re.compile(
    r"(?i)(.)\1*|.*(example|changeme|change_me|placeholder|your[_-]|dummy|redacted|xxxx|\*\*\*|"
    r"<.*>|\$\{|\{\{|%\().*|true|false|none|null|undefined",
    re.DOTALL,
)
THRESHOLD = 0.5
# Calls with a default inside each other that are followed.
MOST_CALLS = 8
_HEX_BYTES = bytes(0x31 if b in b"0123456789abcdef" else 0x30 for b in range(256))
# What may part the words of a name, and the sensitive words that hold no other one.
_APART = bytes(b for b in range(256) if b in b"0123456789_.-" or b > 127)
_NAMES = tuple(w.encode() for w in SENSITIVE if not any(v in w for v in SENSITIVE if v != w))

PAIR = re.compile(
    r"(?<![\w.\-])(?P<name>[A-Za-z_][\w.\-]*+)(?:\[?[\"']\]?)?[ \t]*+(?::=|=>|=(?![=~])|:(?![:/]))[ \t]*+"
)
# What may stand between the sign and the value: an escaped line break, or a bracket with blanks.
OPENED = re.compile(r"(?:\\\r?\n[ \t]*+)?(?:(?P<bracket>\()\s*+)?")
OPERAND = re.compile(
    r"[rbuf]{0,2}(?:\"(?P<double>(?:[^\"\\\n]|\\.)*+)\"|'(?P<single>(?:[^'\\\n]|\\.)*+)'"
    r"|`(?P<tick>[^`\n]*+)`)|(?P<bare>(?:[^\s\"'`,;{}()\[\]#+|]|\|(?!\|))++)",
    re.ASCII,
)
JOIN = re.compile(
    r"[ \t]*+(?:\+|\.\.|\\\n)?[ \t]*+(?=[\"'`])|[ \t]*+\+[ \t]*+"
    r"|[ \t]*+(?:\|\||\?\?|(?<=[ \t])or(?=[ \t]))[ \t]*+"
)
# In a bracket, strings and signs may stand on further lines.
JOIN_LINES = re.compile(r"\s*+(?:\+|\.\.)?\s*+(?=[\"'`])")
# After a bare name: a key in brackets, or a call with a key and a default.
KEY = re.compile(r"\[[\"'](?P<key>[\w.\-]++)[\"']\]")
DEFAULT = re.compile(r"\(\s*+(?:\"[^\"\n]*+\"|'[^'\n]*+')\s*+,\s*+")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][\w.\-]*+)(?:\s[^<>]*+)?>(?P<value>[^<>\n]++)</(?P=name)\s*+>")
SETTER = re.compile(
    r"(?:(?<![\w.])|(?<=\.))(?P<name>(?:set|with|put|use)_?[A-Za-z]\w*+)\(\s*+"
    r"(?:\"(?P<double>(?:[^\"\\\n]|\\.)*+)\"|'(?P<single>(?:[^'\\\n]|\\.)*+)')\s*+\)"
)
# Words of names whose value may be several words.
PHRASES = ("pass", "pwd")
LEAST_PHRASE, MOST_PHRASE = 3, 10


def plain_spans(text: str) -> Iterator[Span]:
    """(start, kind, end) of the three plain patterns, leftmost and apart within each."""
    for found in ASSIGN.finditer(text):
        if len(found[2]) >= LEAST_VALUE:
            yield found.start(), 0, found.end()
    for found in ACCESS.finditer(text):
        if len(found[0]) >= LEAST_ACCESS:
            yield found.start(), 1, found.end()
    for found in HEX.finditer(text):
        yield found.start(), 2, found.end()


def name_weight(name: str) -> float:
    """The weight of the most sensitive word, or two words in a row, of a name."""
    parts = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name.rsplit(".", 1)[-1])
    words = [p.lower() for p in parts]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in [*words, *pairs]), default=0.0)


def literal_weight(value: str, name: str = "") -> float:
    """From 0 for a placeholder or a short or uniform text to 1 for a long and varied one."""
    if len(value) < LEAST_VALUE or PLACEHOLDER.fullmatch(value) or re.search(r"[^\S ]", value):
        return 0.0
    if " " in value and not _is_phrase(value, name):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, bits / 3.5) * (1.0 if kinds > 1 else 0.5)


def _is_phrase(value: str, name: str) -> bool:
    """Some plain words under the name of a pass word or phrase, none of them about secrets."""
    words = value.lower().split(" ")
    return (
        any(word in name.lower() for word in PHRASES)
        and LEAST_PHRASE <= len(words) <= MOST_PHRASE
        and all(re.fullmatch(r"[a-z0-9]+", word) for word in words)
        and not any(known in word for word in words for known in (*SENSITIVE, "enter", "please"))
    )


class Kept:
    """What a name was assigned: literals (value, start, end) and what other names had been."""

    __slots__ = ("pieces", "weight")

    def __init__(self, pieces: list):
        self.pieces, self.weight = pieces, None

    def literals(self) -> list:
        """All literals, each once, in order."""
        found, seen, open_ = {}, {id(self)}, [iter(self.pieces)]
        while open_:
            for piece in open_[-1]:
                if not isinstance(piece, Kept):
                    found[piece] = None
                elif id(piece) not in seen:
                    seen.add(id(piece))
                    open_.append(iter(piece.pieces))
                    break
            else:
                open_.pop()
        return list(found)


def _operands(text: str, at: int, known: dict) -> tuple[list, int]:
    """Literals (value, start, end) and kept names of an expression from ``at``, and its end."""
    pieces: list = []
    opened = OPENED.match(text, at)
    join = JOIN_LINES if opened["bracket"] else JOIN
    inner, quoted, calls = opened.end(), False, 0
    if not OPERAND.match(text, inner):
        inner = at
    at = inner
    while operand := OPERAND.match(text, at):
        kind, value = operand.lastgroup, operand[operand.lastgroup]
        at = operand.end()
        if kind != "bare":
            quoted = True
            pieces.append((value, operand.start(kind), at - 1))
        elif default := DEFAULT.match(text, at):
            at = default.end()
            calls += 1
            if calls < MOST_CALLS:
                continue
        else:
            if key := KEY.match(text, at):
                value, at = key["key"], key.end()
            pieces.append(known[value] if value in known else (value, operand.start(), operand.end(), 0))
        joined = join.match(text, at) or JOIN.match(text, at)
        if not joined:
            break
        at = joined.end()
    # A bare piece has a fourth part.
    if quoted:
        pieces = [p for p in pieces if isinstance(p, Kept) or len(p) == 3]
    return [p if isinstance(p, Kept) else p[:3] for p in pieces], at


def literal_spans(text: str) -> Iterator[Span]:
    """Spans of literals assigned, directly or by way of other names, to sensitive names."""
    known: dict[str, Kept] = {}
    at, found = 0, set()
    while pair := PAIR.search(text, at):
        names, at = [pair["name"]], pair.end()
        while pair := PAIR.match(text, at):  # a = b = value
            names.append(pair["name"])
            at = pair.end()
        pieces, end = _operands(text, at, known)
        at = max(at, end)
        alone = len(pieces) == 1 and isinstance(pieces[0], Kept)
        kept = pieces[0] if alone else Kept(pieces)
        name = max(names, key=name_weight)
        known.update(dict.fromkeys(names, kept))
        weight = name_weight(name)
        if weight < THRESHOLD or kept.weight is not None and weight <= kept.weight:
            continue
        # The name's weight is kept: under no heavier name is there anything new to find.
        kept.weight, literals = weight, kept.literals()
        if weight * literal_weight("".join(v for v, _, _ in literals), name) >= THRESHOLD:
            found.update((start, 3, end) for _, start, end in literals if start < end)
    for form in (ELEMENT, SETTER):
        for given in form.finditer(text):
            name, kind = given["name"], given.lastgroup
            if name_weight(name) * literal_weight(given[kind], name) >= THRESHOLD:
                found.add((given.start(kind), 3, given.end(kind)))
    yield from found


def spans_of(body: bytes) -> list[Span]:
    """(start, kind, end) of all spans of a text in UTF-8, in order."""
    # The words of a name count together too, so its letters are searched without what parts them.
    letters = body.translate(None, _APART).lower()
    named = any(name in letters for name in _NAMES)
    assigns = named and any(sign in body for sign in (b"=", b":", b"</", b"("))
    if not (assigns or b"AKIA" in body or b"1" * LEAST_HEX in body.translate(_HEX_BYTES)):
        return []
    text = body.decode("utf-8", "replace")
    return sorted({*plain_spans(text), *(literal_spans(text) if assigns else ())})


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(body: bytes, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    text, parts, at, end = body.decode("utf-8", "replace"), [], 0, 0
    for start, _, stop in spans:
        if start >= end:
            parts += [text[at:start] if at <= start else "", mark]
        end = at = max(end, stop)
    return "".join(parts) + text[at:]


FOUND = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, " \
        "base_sha256 string, spans string"  # fmt: skip


def scan(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the plain spans and all spans, per row of ``docs``."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch["doc_id"], batch["body"]):
                spans = spans_of(body)
                counts = Counter(kind for _, kind, _ in spans)
                base = shown([s for s in spans if s[1] < 3])
                digest = hashlib.sha256(base.encode()).hexdigest()
                rows.append((doc_id, *(counts[k] for k in range(4)), digest, shown(spans)))
            names = ("doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans")
            yield dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    return map_batches(docs.select("doc_id", as_bytes().alias("body")), run, FOUND)


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked, and ``n_chars``, if there, to fit."""

    @F.pandas_udf("string")
    def run(bodies: pd.Series) -> pd.Series:
        """The masked text, null where nothing is to be masked."""
        found = [spans_of(b) for b in bodies]
        return pd.Series([masked(b, s) if s else None for b, s in zip(bodies, found)], dtype=object)

    both = docs.select(F.struct(*columns(docs)).alias("doc"), run(as_bytes()).alias("masked"))
    new = {"text": F.col("masked"), "n_chars": F.length("masked").cast("bigint")}
    return both.select(
        *[
            (F.coalesce(new[name], F.col("doc")[name]) if name in new else F.col("doc")[name]).alias(name)
            for name in docs.columns
        ]
    )
