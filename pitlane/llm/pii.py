"""Personal data: fixed patterns and a character tagger that learns from their spans.

Base spans come from four fixed patterns.  The tagger (bidirectional LSTM with CRF
transitions, see `tagger`) is trained on windows labelled with them and on windows of the
corpus into which labelled spans of three more kinds were put, which no pattern gives:
bank accounts (`iban`), national identity numbers (`idnum`) and phone numbers without a
country (`local`).  It adds the kinds `seen_email`, `seen_ip`, `seen_card`, `seen_phone`,
`seen_iban`, `seen_idnum` and `seen_local`: spans that it reads as such where no base span
lies.  A span that would begin or end inside a run of letters and digits is not added.

Windows.  All these kinds hold a digit or `@`, so windows lie around those characters,
`MARGIN` to either side, in every text.  Longer stretches are covered by windows of
`LENGTH` characters that overlap by `OVERLAP`; each character takes its label from the
window in which it lies farthest from an edge.

The fit uses a bounded sample: the `PER_KIND` distinct windows with spans and half as
many without, that have the smallest hashes; `PER_MADE` of the latter get invented spans.  Scanning covers every text.

Defined cases: null and empty texts have no spans; a null id is carried through; without
windows to learn from nothing is added; repeated rows give repeated results; other
columns are ignored.  Positions are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import Shared, id_and_text, map_arrow, stored, texts_of
from pitlane.llm.tagger import Tagger, classes_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
# Kinds that only the tagger finds.
LEARNED = ("iban", "idnum", "local")
READ = KINDS + LEARNED
LENGTH, OVERLAP, MARGIN = 96, 32, 24
PER_KIND, PER_MADE, PASSES, BATCH = 500, 900, 14, 40
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_seen long"

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match can't begin inside a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def emails(text: str) -> list[Span]:
    """Matches of EMAIL, found from each `@` so that long words cost one pass."""
    found: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            found.append(("email", *m.span()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, kind by kind."""
    if not TRIGGER.search(text):
        return []
    found = emails(text) if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return found


def windows_of(text: str) -> np.ndarray:
    """(start, end) of the windows around digits and `@`."""
    marks = np.array([m.start() for m in TRIGGER.finditer(text)], dtype=np.int64)
    if not len(marks):
        return np.zeros((0, 2), np.int64)
    cuts = np.flatnonzero(np.diff(marks) > 2 * MARGIN)
    begins = np.maximum(marks[np.concatenate(([0], cuts + 1))] - MARGIN, 0)
    ends = np.minimum(marks[np.append(cuts, len(marks) - 1)] + MARGIN + 1, len(text))
    out = []
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        while b - a > LENGTH:
            out.append((a, a + LENGTH))
            a += LENGTH - OVERLAP
        out.append((a, b))
    return np.array(out, dtype=np.int64)


def padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = max(map(len, parts))
    x, mask = np.zeros((len(parts), size), np.int64), np.zeros((len(parts), size))
    for i, p in enumerate(parts):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def label_row(spans: list[Span], start: int, end: int) -> np.ndarray:
    """0 outside, 1 + 2k at the first character of kind k, 2 + 2k inside; cut at the window's edges."""
    row = np.zeros(end - start, dtype=np.int64)
    for kind, s, e in spans:
        k = READ.index(kind)
        a, b = max(s, start), min(e, end)
        if a < b and not row[a - start : b - start].any():
            row[a - start : b - start] = 2 + 2 * k
            if s >= start:
                row[s - start] = 1 + 2 * k
    return row


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def seen_spans(texts: list[str], model: Tagger, batch: int = 256) -> list[list[Span]]:
    """The tagger's spans of each text, from reconciled windows."""
    jobs, parts = [], []
    for i, text in enumerate(texts):
        if TRIGGER.search(text):
            kinds = classes_of(codes_of(text))
            for a, b in windows_of(text).tolist():
                jobs.append((i, a, b))
                parts.append(kinds[a:b])
    votes: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    order = sorted(range(len(parts)), key=lambda j: len(parts[j]))
    for chunk in (order[k : k + batch] for k in range(0, len(order), batch)):
        labels = model.decode(*padded([parts[j] for j in chunk]))
        for row, j in zip(labels, chunk, strict=True):
            i, a, b = jobs[j]
            last = b - a - 1
            for p in range(b - a):
                # Only the ends of a window can be in another one too.
                if row[p] or p < OVERLAP or last - p < OVERLAP:
                    inner = min(p if a else LENGTH, last - p if b < len(texts[i]) else LENGTH)
                    votes[i][a + p] = max(votes[i].get(a + p, (-1, 0)), (inner, int(row[p])))
    return [joined_spans(v) for v in votes]


def joined_spans(votes: dict[int, tuple[int, int]]) -> list[Span]:
    spans: list[list] = []
    for p in sorted(votes):
        label = votes[p][1]
        if not label:
            continue
        kind = READ[(label - 1) // 2]
        if label % 2 == 0 and spans and spans[-1][0] == kind and spans[-1][2] == p:
            spans[-1][2] = p + 1
        else:
            spans.append([kind, p, p + 1])
    return [tuple(s) for s in spans]


def added(text: str, base: list[Span], seen: list[Span]) -> list[Span]:
    """What the tagger adds: trimmed, at least six characters, whole runs, clear of base spans."""
    out = []
    for kind, s, e in seen:
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        cut = (0 < s < e and text[s - 1].isalnum() and text[s].isalnum()) or (s < e < len(text) and text[e - 1].isalnum() and text[e].isalnum())
        if e - s >= 6 and not cut and TRIGGER.search(text, s, e) and not any(a < e and s < b for _, a, b in base):
            out.append((f"seen_{kind}", s, e))
    return sorted(out, key=lambda x: (READ.index(x[0][5:]), x[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def invented(kind: str, rng: np.random.Generator) -> str:
    """A made-up value of a learned kind; of kind "none" something that looks like one and is not."""

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def letters(n: int) -> str:
        return "".join(chr(65 + int(c)) for c in rng.integers(0, 26, n))

    if kind == "iban":
        body = digits(int(rng.integers(11, 25)))
        groups = [body[i : i + 4] for i in range(0, len(body), 4)]
        return f"{letters(2)}{digits(2)}" + (" " + " ".join(groups) if rng.integers(2) else body)
    if kind == "idnum":
        return f"{digits(3)}-{digits(2)}-{digits(4)}"
    if kind == "local":
        a, b, c = digits(3), digits(3), digits(4)
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}"][rng.integers(4)]
    return [
        f"{digits(2)}/{digits(2)}/{digits(4)}", f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}:{digits(2)}",
        f"{digits(4)}-{digits(4)}", f"{digits(1)},{digits(3)}.{digits(2)}", f"v{digits(1)}.{digits(2)}.{digits(1)}", f"#{digits(6)}",
        f"{letters(3)}-{digits(4)}", digits(int(rng.integers(3, 13))), f"{letters(4)}{digits(12)}",
    ][rng.integers(10)]


def planted(carriers: list[str], count: int, seed: int = 0) -> list[tuple[str, bytes]]:
    """Windows with an invented value of each kind in turn, every fourth a mere look-alike, and their labels."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(count if carriers else 0):
        carrier = carriers[int(rng.integers(len(carriers)))][: LENGTH - 40]
        kind = (*LEARNED, "none")[i % 4]
        value = invented(kind, rng)
        gaps = [0, *(p + 1 for p, c in enumerate(carrier) if c == " "), len(carrier)]
        at = gaps[int(rng.integers(len(gaps)))]
        before = carrier[:at] + (" " if at and carrier[at - 1] != " " else "")
        after = ["", ".", ",", ")", ";"][int(rng.integers(5))] + " " + carrier[at:]
        text = before + value + after
        spans = [(k, s, e) for k, s, e in base_spans(text) if e <= len(before) or s >= len(before) + len(value)]
        if kind != "none":
            spans.append((kind, len(before), len(before) + len(value)))
        row = label_row(spans, 0, len(text))
        out.append((text, row.astype(np.uint8).tobytes()))
    return out


def train(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> Tagger | None:
    """Fit on a bounded sample of windows labelled with the base spans; None without any."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, marks, hit = [], [], []
        for text in texts_of(batch.column("text")):
            spans = base_spans(text)
            for a, b in windows_of(text).tolist():
                row = label_row(spans, a, b)
                made.append(text[a:b])
                marks.append(row.astype(np.uint8).tobytes())
                hit.append(bool(row.any()))
        arrays = [pa.array(made, pa.string()), pa.array(marks, pa.binary()), pa.array(hit, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, ["part", "marks", "hit"])

    rows = docs.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]"))
    windows = stored(map_arrow(rows, run, "part string, marks binary, hit boolean").dropDuplicates(["part"]), "windows")
    order = [F.xxhash64("part"), "part"]
    parts = [windows.where("hit").orderBy(*order).limit(per_kind), windows.where("NOT hit").orderBy(*order).limit(per_kind // 2)]
    found = sorted((r.part, bytes(r.marks)) for r in parts[0].unionByName(parts[1]).collect())
    if not any(any(m) for _, m in found):
        return None
    found += planted([p for p, m in found if not any(m)], PER_MADE)
    x, mask = padded([classes_of(codes_of(p)) for p, _ in found])
    y, _ = padded([np.frombuffer(m, np.uint8).astype(np.int64) for _, m in found])
    return Tagger(labels=1 + 2 * len(READ)).start().fit(x, y, mask, PASSES, BATCH)


def scan(df: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, the base digest and all spans."""
    shared = Shared(df, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column("text"))
        base = [base_spans(t) for t in texts]
        seen = seen_spans(texts, shared.value) if shared.value is not None else [[] for _ in texts]
        rows = []
        for text, own, more in zip(texts, base, seen, strict=True):
            extra = added(text, own, more)
            n = Counter(k for k, _, _ in own)
            digest = hashlib.sha256(joined(own).encode()).hexdigest()
            rows.append((*(n[k] for k in KINDS), digest, joined(own + extra), len(extra)))
        names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_seen"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return map_arrow(id_and_text(df, id_col, text_col), run, SCHEMA)
