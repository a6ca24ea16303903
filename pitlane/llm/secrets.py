"""Secret scan: lex assignments, propagate constants, score literals by their target's name.

`scan_secrets` returns one row per input row; `mask_secrets` keeps the rows and replaces
what was found.  Three base kinds come from fixed
patterns (`assign`, `access`, `hex`).  The lexer adds the kind `literal`: every
``name = value`` or ``name: value`` pair is split into a target name and an
expression of literals and names, joined by ``+`` or side by side, in brackets or not;
quoted texts may have prefixes or triple quotes, values may be indented blocks, arguments
of a call, or texts and attributes of elements; in ``a:b:value`` both names count.  Names
seen earlier in the same text are replaced by the literals they stand for; literals that
reach a sensitive name and look like a key are reported where they were written.  Every
part of a text is read a bounded number of times, so time grows with its length.

Defined cases: a null or empty text has no spans; a null id is carried through;
repeated rows give repeated results; other columns are ignored.  Positions are
code points, the end exclusive.  Neither names, the blanks behind them nor the
literals of a constant are limited in number.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from pitlane.llm.common import id_and_text, map_arrow, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"
KINDS = ("assign", "access", "hex", "literal")

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is found whole

OPERATOR = re.compile(r":=|=>|==+|::+|:(?!/)|=")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")
NAME = LETTERS | frozenset("0123456789.-")
# A type between a name's colon and its `=`, as in TypeScript, Python, Kotlin, Swift and Rust.
_NESTED = r"""(?:<(?:[^<>\n=]|<[^<>\n=]*+>)*+>|\[(?:[^\[\]\n=]|\[[^\[\]\n=]*+\])*+\])"""
_TYPE = rf"""[A-Za-z_][\w.]*+(?:::[A-Za-z_]\w*+)*+{_NESTED}*+[?!*]?+"""
ANNOTATION = re.compile(
    rf"""[ \t]*+[&*]?+(?:'[a-z_]++[ \t]++)?+(?:(?:const|mut|dyn)[ \t]++)?+{_TYPE}(?:[ \t]*+\|[ \t]*+{_TYPE})*+[ \t]*+=(?![=>])"""
)
TYPE_TEXT = re.compile(r"[&*]?[A-Za-z_.:]*[?!]?=?")
# Names that are types wherever they stand before `=`; Go writes them behind the name.
TYPES = frozenset("string String str Text text bytes byte char any Any".split())
# A value: a quoted text (prefixed, or over lines in triple quotes), or a bare one.  A bare value ends at
# the next operator, but for the `=` that pads its end and the colon of an address.
_BARE = r"""[^\s"'`,;(){}\[\]<>+&=:]"""
TERM = re.compile(
    rf"""[ \t]*+(?:[rRbBuUfF]{{1,2}}(?=["']))?(?:(?P<triple>\"{{3}}|'{{3}})(?P<long>.*?)(?P=triple)"""
    rf"""|(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote)"""
    rf"""|(?P<bare>(?:{_BARE}|:(?=/))++(?:={{1,2}}(?!{_BARE}|[=:]))?))""",
    re.DOTALL,
)
OPEN, CLOSE, PLUS, NEXT_QUOTED = (re.compile(p) for p in (r"[ \t]*+\(", r"\s*+\)", r"[ \t]*+\+", r"""[ \t]*+[rRbBuUfF]{0,2}["']"""))
BLANKS = re.compile(r"\s*+")
# Quoted arguments directly inside a call, up to its end, an inner call, an operator or the end of the line.
ARGUMENT = re.compile(r"""(?P<stop>[()\n=+]|\Z)|(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote)|.""", re.DOTALL)
BLOCK = re.compile(r"[ \t]*+[|>][+-]?[0-9]?[ \t]*+(?:#[^\n]*+)?\n")
BLOCK_LINE = re.compile(r"(?P<indent>[ ]*+)(?P<text>[^\n]*+)(?:\n|\Z)")
ELEMENT = re.compile(r"<(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?P<rest>(?:\s[^<>]*+)?)>(?P<text>[^<>]++)</")
ATTRIBUTE = re.compile(r"""(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)\s*+=\s*+(?P<quote>["'])(?P<text>[^"'<>]*+)(?P=quote)""")
TAG = re.compile(r"<[A-Za-z_][A-Za-z0-9_.-]*+\s(?P<rest>[^<>]++)>")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z")

# How much a word of the target's name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "apikey": 1.0,
    "token": 0.9, "credential": 0.8, "credentials": 0.8, "auth": 0.6, "private": 0.5, "access": 0.4,
    "api": 0.4, "key": 0.4, "signing": 0.5, "bearer": 0.7, "webhook": 0.4,
}
HARMLESS = ("example", "changeme", "placeholder", "your", "xxxx", "null", "none", "true", "false", "todo")
SCORE = 1.5
MASK = "[secret]"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """How sensitive a target's name is; the last words of a dotted path count."""
    words = [w.lower() for w in WORD.findall(name.rsplit(".", 1)[-1])]
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in words))


def is_harmless(value: str) -> bool:
    """Whether no text with this in it is a key."""
    return " " in value or any(w in value.lower() for w in HARMLESS)


def literal_score(value: str) -> float:
    """How much a value looks like a generated key: length, variety and kinds of characters."""
    return 0.0 if is_harmless(value) else counted_score(Counter(value), len(value))


def counted_score(counts: Counter, size: int) -> float:
    """`literal_score` of a text with these characters, in any order."""
    if size < 6:
        return 0.0
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    kinds = {"a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "" for c in counts}
    if len(kinds) < 2:
        return 0.0
    return min(1.0, entropy / 3.0) * min(1.0, size / 10)


def name_before(text: str, end: int) -> tuple[str, int]:
    """The name that ends before `end`, but for blanks and up to two closing marks, and where it begins."""
    while end and text[end - 1] in " \t":
        end -= 1
    for _ in range(2):
        if end and text[end - 1] in "\"']":
            end -= 1
    start = end
    while start and text[start - 1] in NAME:
        start -= 1
    while start < end and text[start] not in LETTERS:
        start += 1
    return text[start:end], start


def pairs(text: str):
    """(names, terms) of each assignment; a term is (is_literal, value, start, end).

    There are two names if what stands before `=` may be the type of the name before it.
    """
    annotated: dict[int, str] = {}
    carried, value_start = "", -1
    for op in OPERATOR.finditer(text):
        if op[0].startswith(("==", "::")):
            continue
        name, start = name_before(text, op.start())
        names = [name] if name else []
        typed = op[0] == ":" and name and ANNOTATION.match(text, op.end())
        if typed:
            annotated[typed.end() - 1] = name
        elif op[0] == "=":
            owner = annotated.get(op.start()) or (name in TYPES and text[start - 1 : start] in (" ", "\t") and name_before(text, start)[0])
            if owner:
                names = [owner] if not name or name in TYPES else [owner, name]
        if not names:
            continue
        # In a run like a:b:value each name stands for what follows it.
        chained = op[0] == ":" and start == value_start and op.start() == start + len(name)
        if chained and name_score(carried) > max(map(name_score, names)):
            names = [*names, carried]
        carried = max(names, key=name_score)
        if block_value(text, op):
            terms, alternatives = block_terms(text, op, start), []
        else:
            terms, alternatives = expression(text, op.end())
        value_start = terms[0][2] if terms else -1
        # A word before a colon is the next name of the run.
        if len(terms) == 1 and text[terms[0][3] : terms[0][3] + 1] == ":" and not any(c.isdigit() for c in terms[0][1]):
            continue
        # A type in letters only is no value.
        if terms and not (typed and all(TYPE_TEXT.fullmatch(t[1]) for t in terms)):
            yield names, terms
        for term in alternatives:
            yield names, [term]


def expression(text: str, at: int) -> tuple[list, list]:
    """(terms joined by `+`, adjacency or brackets; quoted arguments of calls)."""
    terms, alternatives, depth = [], [], 0
    while True:
        while m := OPEN.match(text, at):
            depth, at = depth + 1, m.end()
        if depth:
            at = BLANKS.match(text, at).end()
        m = TERM.match(text, at)
        if not m:
            break
        at = m.end()
        bare = m["bare"]
        if bare is not None:
            if text[at : at + 1] == "(" and IDENTIFIER.match(bare):
                found, at = arguments(text, at + 1)
                alternatives += found
            else:
                terms.append((not IDENTIFIER.match(bare), bare, *m.span("bare")))
        else:
            group = "long" if m["triple"] else "text"
            terms.append((True, m[group], *m.span(group)))
        while depth and (m := CLOSE.match(text, at)):
            depth, at = depth - 1, m.end()
        here = BLANKS.match(text, at).end() if depth else at
        more = PLUS.match(text, here)
        if more:
            at = more.end()
        elif bare is None and NEXT_QUOTED.match(text, here):
            at = here
        else:
            break
    return terms, alternatives


def arguments(text: str, at: int) -> tuple[list, int]:
    """Quoted arguments that hold a digit; a name of a variable or a file does not say what is in it."""
    found = []
    while True:
        m = ARGUMENT.match(text, at)
        if m["stop"] is not None:
            return found, m.end() if m["stop"] == ")" else m.start()
        if m["quote"] and any(c.isdigit() for c in m["text"]):
            found.append((True, m["text"], *m.span("text")))
        at = m.end()


def block_value(text: str, op: re.Match) -> bool:
    return op[0] == ":" and BLOCK.match(text, op.end()) is not None


def block_terms(text: str, op: re.Match, start: int) -> list:
    """The lines of a block that is indented below its key."""
    line = text.rfind("\n", 0, start) + 1
    indent = len(text[line:start]) - len(text[line:start].lstrip(" -"))
    at, terms = BLOCK.match(text, op.end()).end(), []
    while at < len(text):
        m = BLOCK_LINE.match(text, at)
        value = m["text"].rstrip()
        if value and len(m["indent"]) <= indent:
            break
        if value:
            terms.append((True, value, m.start("text"), m.start("text") + len(value)))
        at = m.end()
    return terms


def element_pairs(text: str):
    """(names, terms) of elements with a text, and of tags with a key or name and a value."""
    for m in ELEMENT.finditer(text):
        value = m["text"].strip()
        at = m.start("text") + m["text"].index(value)
        keys = [a["text"] for a in ATTRIBUTE.finditer(m["rest"]) if a["name"].lower() in ("key", "name", "id")]
        yield [m["name"], *keys], [(True, value, at, at + len(value))]
    for m in TAG.finditer(text):
        found = {a["name"].lower(): a for a in ATTRIBUTE.finditer(text, m.start("rest"), m.end("rest"))}
        key, value = found.get("key") or found.get("name"), found.get("value")
        if key and value:
            yield [key["text"]], [(True, value["text"], *value.span("text"))]


class Constant:
    """What a name stands for: literals, and earlier constants by reference.

    Its characters are counted from the counts of its parts, so a long chain of constants
    is neither joined nor opened again for each of its links.
    """

    __slots__ = ("counts", "harmless", "reported", "size", "terms")

    def __init__(self, terms: list):
        self.terms, self.reported = terms, False
        # One such part makes the whole harmless.
        self.harmless = any(t.harmless if isinstance(t, Constant) else is_harmless(t[0]) for t in terms)
        self.counts, self.size = Counter(), 0
        for t in terms:
            self.counts.update(t.counts if isinstance(t, Constant) else t[0])
            self.size += t.size if isinstance(t, Constant) else len(t[0])
        if self.size > 2**60:  # a text that is doubled again and again: only the shares matter
            self.counts = Counter({c: n >> 30 for c, n in self.counts.items() if n >> 30})
            self.size = sum(self.counts.values())

    def report(self) -> list[tuple[int, int]]:
        """Where its literals are written, but for constants that were reported before."""
        out, stack = [], [self]
        while stack:
            constant = stack.pop()
            if constant.reported:
                continue
            constant.reported = True
            for t in constant.terms:
                if isinstance(t, Constant):
                    stack.append(t)
                elif t[2] > t[1]:
                    out.append((t[1], t[2]))
        return out


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals that reach a sensitive name, each once."""
    has_pairs = ":" in text or "=" in text
    if not has_pairs and "</" not in text:
        return []
    known: dict[str, Constant] = {}
    found = set()
    for names, terms in chain(pairs(text) if has_pairs else (), element_pairs(text) if "<" in text else ()):
        parts = [known[v] if not literal and v in known else (v, s, e) for literal, v, s, e in terms]
        # A name for another name is no constant of its own.
        constant = parts[0] if len(parts) == 1 and isinstance(parts[0], Constant) else Constant(parts)
        known.update(dict.fromkeys(names, constant))
        target = max(map(name_score, names))
        if target and not constant.harmless and not constant.reported and target + counted_score(constant.counts, constant.size) >= SCORE:
            found.update(("literal", *span) for span in constant.report())
    return sorted(found)


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered)


def scan_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for text in texts_of(batch.column("text")):
        base, more = base_spans(text), literal_spans(text)
        n = Counter(k for k, _, _ in base)
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        rows.append((n["assign"], n["access"], n["hex"], digest, joined(base + more), len(more)))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, the base digest, and all spans."""
    return map_arrow(id_and_text(df, id_col, text_col), scan_batch, SCHEMA)


def masked(text: str, mark: str = MASK) -> str:
    """`text` with each found secret replaced; overlapping spans become one mark.

    Of an assignment only the value goes, the name stays.
    """
    spans = [(s, e) for kind, s, e in base_spans(text) + literal_spans(text) if kind != "assign"]
    if ":" in text or "=" in text:
        spans += [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    parts, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            parts += [text[at:s], mark]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def mask_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of `df`, with the secrets in the text replaced; a null text stays null."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([None if t is None else masked(t) for t in batch.column(text_col).to_pylist()], pa.string())
        columns = [texts if n == text_col else batch.column(n) for n in batch.schema.names]
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(df, run, df.schema, text_col)
