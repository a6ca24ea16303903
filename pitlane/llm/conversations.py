"""Repair of conversations by survivor-coalescence Viterbi.

A conversation is well formed if its roles' initials are ``(s?(ua)+)?``.  Edits: Keep (0),
Rerole to user or assistant (3), Delete (4, forced for blank and duplicate rows), Insert an
empty row of either role (3); a truncated row that stays costs 3 more.  Of the cheapest
edits the ASCII-least string of their initials is taken.

*Viterbi.*  After every row each of four states (nothing yet, after system, after user,
after assistant) has one survivor.  A backpointer tree holds the edits of all survivors;
nodes without survivors below are freed by their reference counts, and where only one branch
is left its edits are final and leave the tree.  Of two equally cheap paths the lesser edit
string wins: both end in a row, so neither begins the other, and the order of the survivors'
whole unresolved strings is kept from row to row as a rank (a later letter can't change it).

*Long conversations.*  Rows are numbered by Spark and grouped into pieces of bounded size.  A
piece's result is a table: for each state before and after it, cost and rank.  A second
Viterbi walks over the pieces of a conversation, which are short rows, and again passes on
what is settled; then each piece is decoded between its two known states.  Only audit and
digest of a conversation, one string each, are put together in one task, piece by piece.

Order: by turn (nulls first), then role, then text.  Faults: blank (no character but white
space), duplicate (role and text seen earlier), truncated (last such character is not one of
``.!?``); a row's first fault counts.

Defined cases: null role or text is one space; a null conversation id is one conversation; null
turns count in no gap; roles with other initials must be reroled or deleted; a conversation
whose rows are all deleted has the digest of the empty text; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import few, stored
from pitlane.operators.series import Series

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of the rows of a piece (a longer row is a piece of its own), and what a row counts beside its text.
PIECE_BYTES = 200_000
ROW_BYTES = 64
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP_STEPS = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
# Inserts at the end: the final states are NONE and ASSISTANT.
CLOSING = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
MUST_DELETE = "d"


def _moves(initial: str, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(state before, after, cost, edits) of one row with the inserts before it; the best of each pair of states."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        # More inserts would come back to a state at a higher cost.
        at, cost, letters = before, 0, ""
        for _ in range(3):
            ends = [(at, DELETE, "D")]
            if initial != MUST_DELETE:
                extra = TRUNCATED if truncated else 0
                ends.append((NEXT[at], REROLE + extra, "R"))
                if (at, initial) in KEEP_STEPS:
                    ends.append((KEEP_STEPS[at, initial], extra, "K"))
            for after, more, letter in ends:
                made = (cost + more, letters + letter)
                found[before, after] = min(made, found.get((before, after), made))
            at, cost, letters = NEXT[at], cost + INSERT, letters + "I"
    return [(before, after, *made) for (before, after), made in found.items()]


MOVES = {(i, t): _moves(i, t) for i in ("s", "u", "a", "", MUST_DELETE) for t in (False, True)}


class Node:
    """A run of edits; `refs` counts the branches and survivors that need it."""

    __slots__ = ("label", "parent", "children", "refs")

    def __init__(self, label, parent: Node | None):
        self.label, self.parent, self.children, self.refs = label, parent, [], 0
        if parent is not None:
            parent.children.append(self)
            parent.refs += 1


class Survivors:
    """The best path into every state, as a tree of labels that is cut where paths part.

    A survivor is (cost, rank, node); ranks order the paths' whole strings.
    """

    def __init__(self, entries: Iterable[int]):
        self.root = Node(None, None)
        self.live: dict[int, tuple[int, int, Node]] = {}
        for rank, state in enumerate(entries):
            self.live[state] = (0, rank, self.root)
            self.root.refs += 1

    def advance(self, candidates: Iterable[tuple[int, int, int, object, object]]) -> None:
        """Candidates are (state before, after, cost, order, label); `order` compares those from one state."""
        best: dict[int, tuple] = {}
        for before, after, cost, order, label in candidates:
            if before not in self.live:
                continue
            total, rank, node = self.live[before]
            key = (total + cost, rank, order)
            if after not in best or key < best[after][0]:
                best[after] = (key, node, label)
        if ASSISTANT in best:
            # From ASSISTANT all later rows cost at most 4 more than from NONE (a system row
            # that must go), and no more than from SYSTEM: such paths can't win or tie.
            least = best[ASSISTANT][0][0]
            for state, margin in ((NONE, DELETE), (SYSTEM, 0)):
                if state in best and best[state][0][0] > least + margin:
                    del best[state]
        ranks = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][0][1:]))}
        old = [node for _, _, node in self.live.values()]
        self.live = {}
        for state, (key, node, label) in best.items():
            made = Node(label, node)
            made.refs += 1
            self.live[state] = (key[0], ranks[state], made)
        for node in old:
            self._release(node)

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            parent, node.parent = node.parent, None
            parent.children.remove(node)
            parent.refs -= 1
            node = parent

    def settled(self) -> Iterator:
        """Labels that all survivors share; they leave the tree."""
        while self.root.refs == 1 and self.root.children:
            self.root = self.root.children[0]
            self.root.parent = None
            yield self.root.label

    def finish(self, state: int) -> Iterator:
        """The remaining labels of the path into `state`; the others are dropped."""
        for other in [s for s in self.live if s != state]:
            self._release(self.live.pop(other)[2])
        yield from self.settled()

    def best_end(self) -> int:
        return min(self.live, key=lambda s: (self.live[s][0] + INSERT * len(CLOSING[s]), self.live[s][1]))


class Faults:
    """The faults of the rows of one piece, in order."""

    def __init__(self, rows: list[dict], duplicates: set[int] | None):
        self.blank = self.duplicate = self.truncated = 0
        self.kinds: list[tuple[str, bool]] = []
        seen: set[tuple[str, str]] = set()
        for r in rows:
            text = r["text"].rstrip(BLANKS)
            if duplicates is None:
                again = (r["role"], r["text"]) in seen
                seen.add((r["role"], r["text"]))
            else:
                again = r["n"] in duplicates
            cut = bool(text) and not again and text[-1] not in ".!?"
            self.blank += not text
            self.duplicate += bool(text) and again
            self.truncated += cut
            initial = r["role"][:1]
            self.kinds.append((MUST_DELETE if again or not text else initial if initial in "sua" else "", cut))


def steps(kind: tuple[str, bool]) -> Iterator[tuple[int, int, int, str, str]]:
    for before, after, cost, letters in MOVES[kind]:
        yield before, after, cost, letters, letters


def transfer(kinds: list[tuple[str, bool]], entry: int) -> list[tuple[int, int, int]]:
    """(state after, cost, rank) of the piece for one state before it."""
    paths = Survivors([entry])
    for kind in kinds:
        paths.advance(steps(kind))
        deque(paths.settled(), maxlen=0)
    return [(state, cost, rank) for state, (cost, rank, _) in paths.live.items()]


def decode(kinds: list[tuple[str, bool]], entry: int, exit_: int | None) -> Iterator[str]:
    """Edits of each row, as they settle, of the best path from `entry` to `exit_` (None: to a good end, closed)."""
    paths = Survivors([entry])
    for kind in kinds:
        paths.advance(steps(kind))
        yield from paths.settled()
    end = paths.best_end() if exit_ is None else exit_
    yield from paths.finish(end)
    if exit_ is None:
        yield CLOSING[end]


def apply(rows: list[dict], edits: Iterable[str], entry: int) -> tuple[str, list[tuple[str, str]], int]:
    """(audit, repaired (role, text), cost of the edits but for truncated rows) for settled edits."""
    audit, repaired, at, cost, waiting = [], [], entry, 0, iter(rows)
    for letters in edits:
        audit.append(letters)
        for letter in letters:
            if letter == "I":
                at, cost = NEXT[at], cost + INSERT
                repaired.append((ROLE[at], ""))
                continue
            row = next(waiting)
            if letter == "D":
                cost += DELETE
            elif letter == "R":
                at, cost = NEXT[at], cost + REROLE
                repaired.append((ROLE[at], row["text"]))
            else:
                at = KEEP_STEPS[at, row["role"][:1]]
                repaired.append((row["role"], row["text"]))
    return "".join(audit), repaired, cost


def legal(first: str, second: str) -> bool:
    return first[:1] + second[:1] in ("su", "ua", "au")


def shape(rows: list[dict]) -> dict:
    """What the piece says about turns and neighbours; pieces are put together by `Totals`."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return {
        "low": turns[0] if turns else None,
        "high": turns[-1] if turns else None,
        "turns": len(set(turns)),
        "illegal": sum(not legal(a["role"], b["role"]) for a, b in zip(rows, rows[1:])),
        "first": rows[0]["role"][:1],
        "last": rows[-1]["role"][:1],
    }


class Totals:
    """Counts of a conversation over its pieces in order."""

    def __init__(self):
        self.low = self.high = self.last = None
        self.turns = self.illegal = self.blank = self.duplicate = self.truncated = 0

    def add(self, piece: dict) -> None:
        if self.last is not None:
            self.illegal += not legal(self.last, piece["first"])
        self.last = piece["last"]
        for name in ("illegal", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + piece[name])
        if piece["low"] is not None:
            # Rows are in the order of turns, so only the turn at the border can be in both.
            self.turns += piece["turns"] - (self.high == piece["low"])
            self.low = piece["low"] if self.low is None else self.low
            self.high = piece["high"]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
EDITED = "conv_id long, piece long, audit string, repaired array<struct<role string, text string>>"
SUMMARY = (
    "conv_id long, piece long, low long, high long, turns long, illegal long, first string, last string, "
    "blank long, duplicate long, truncated long, transfer array<array<long>>"
)
TOTALS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
DECISION = "conv_id long, piece long, entry int, exit int"


def _types(schema: str) -> pa.Schema:
    plain = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    row = pa.struct([("role", pa.string()), ("text", pa.string())])
    special = {"transfer": pa.list_(pa.list_(pa.int64())), "repaired": pa.list_(row)}
    names = [part.split()[:2] for part in schema.replace("struct<role string, text string>", "row").split(", ")]
    return pa.schema([(n, special.get(n) or plain[t]) for n, t in names])


def per_piece(function, schema: str):
    """A function for mapInArrow from one of (dict) -> list of result tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = _types(schema)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                made = [t for row in batch.slice(i, 64).to_pylist() for t in function(row)]
                columns = list(zip(*made)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return run


def by_conversation(function, schema: str):
    """For rows sorted by conversation and piece: `function` reads a conversation's rows one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = _types(schema)
        rows = (row for batch in batches for row in _rows(batch))
        held = []
        for _, own in groupby(rows, key=lambda r: r["conv_id"]):
            for made in function(own):
                held.append(made)
                if len(held) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), types)], schema=types)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), types)], schema=types)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(0, batch.num_rows, 16):
        yield from batch.slice(i, 16).to_pylist()


def in_pieces(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, piece, rows): the rows of each conversation in order, cut by size."""
    rows = df.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    size = F.octet_length("text") + F.octet_length("role") + ROW_BYTES
    numbered = Series(rows, ["conv_id"], ["turn", "role", "text"])
    numbered.running({"n": ("count", F.lit(1)), "_upto": ("sum", size.cast("long"))})
    piece = F.floor(F.col("_upto") / PIECE_BYTES)
    row = F.struct("n", "turn", "role", "text")
    cut = numbered.rows().select("conv_id", piece.alias("piece"), row.alias("row"))
    return cut.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list("row")).alias("rows"))


def solve_whole(row: dict) -> list[tuple]:
    """Everything about a conversation of one piece: the columns of REPORT, then those of EDITED."""
    rows = row["rows"]
    found = Faults(rows, None)
    audit, repaired, cost = apply(rows, decode(found.kinds, NONE, None), NONE)
    consuming = audit.replace("I", "")
    cost += TRUNCATED * sum(cut and letter != "D" for (_, cut), letter in zip(found.kinds, consuming))
    total = Totals()
    total.add({**shape(rows), "blank": found.blank, "duplicate": found.duplicate, "truncated": found.truncated})
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    counts = (total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost)
    return [(row["conv_id"], *counts, audit, hashlib.sha256(text.encode()).hexdigest())], [
        (row["conv_id"], row["piece"], audit, [{"role": r, "text": t} for r, t in repaired])
    ]


def summarise(row: dict) -> list[tuple]:
    found = Faults(row["rows"], set(row["duplicates"] or ()))
    entries = (NONE,) if row["is_first"] else range(4)
    table = [[e, x, cost, rank] for e in entries for x, cost, rank in transfer(found.kinds, e)]
    s = shape(row["rows"])
    return [(row["conv_id"], row["piece"], *s.values(), found.blank, found.duplicate, found.truncated, table)]


def walk(pieces: Iterator[dict], decisions: bool) -> Iterator[tuple]:
    """The states between the pieces of one conversation, or its totals."""
    paths, total, conv = Survivors([NONE]), Totals(), None
    for p in pieces:
        conv = p["conv_id"]
        total.add(p)
        paths.advance((e, x, cost, rank, (p["piece"], e, x)) for e, x, cost, rank in p["transfer"])
        for label in paths.settled():
            if decisions:
                yield (conv, *label)
    end = paths.best_end()
    cost = paths.live[end][0] + INSERT * len(CLOSING[end])
    for label in paths.finish(end):
        if decisions:
            yield (conv, *label)
    if not decisions:
        yield conv, total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost


def decode_piece(row: dict) -> list[tuple]:
    found = Faults(row["rows"], set(row["duplicates"] or ()))
    edits = list(decode(found.kinds, row["entry"], row["exit"]))
    if row["is_last"]:
        edits.append(CLOSING[row["exit"]])
    audit, repaired, _ = apply(row["rows"], edits, row["entry"])
    return [(row["conv_id"], row["piece"], audit, [{"role": r, "text": t} for r, t in repaired])]


def put_together(pieces: Iterator[dict]) -> Iterator[tuple]:
    """Audit and digest of one conversation from its edited pieces."""
    audit, made, started, conv = [], hashlib.sha256(), False, None
    for p in pieces:
        conv = p["conv_id"]
        audit.append(p["audit"])
        for r in p["repaired"]:
            made.update((("\n" if started else "") + f"{r['role']}:{r['text']}").encode())
            started = True
    yield conv, "".join(audit), made.hexdigest()


def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    match = F.lit(True)
    for n in names:
        match = match & a[n].eqNullSafe(b[n])
    return match


def mark_duplicates(pieces: DataFrame) -> DataFrame:
    """Adds `duplicates`: the numbers of the rows whose role and text were seen earlier in the conversation.

    A key that very many rows share is summed before the shuffle and answered by the least
    number; only rows that are not the least are listed, and a piece has a bounded number.
    """
    each = pieces.select("conv_id", "piece", F.explode("rows").alias("row"))
    key = F.sha2(F.concat_ws("\x01", F.octet_length("row.role").cast("string"), "row.role", "row.text"), 256)
    keyed = stored(each.select("conv_id", "piece", F.col("row.n").alias("n"), key.alias("key")), "row_keys")
    firsts = keyed.groupBy("conv_id", "key").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("times")).where("times > 1")
    firsts = stored(firsts.select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), "least", "times"), "firsts")
    match = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key"))
    hinted = few(firsts)
    if hinted is firsts:
        # Of many keys those of many rows are few: at most a thousand have a thousandth of all rows.
        much = firsts.agg(F.sum("times")).first()[0] / 1000
        large, small = F.broadcast(firsts.where(F.col("times") > much)), firsts.where(F.col("times") <= much)
        rest = keyed.join(large, match, "left_anti").join(small, match)
        hit = keyed.join(large, match).unionByName(rest)
    else:
        hit = keyed.join(hinted, match)
    again = hit.where("n > least").groupBy("conv_id", "piece").agg(F.collect_list("n").alias("duplicates"))
    lists = again.select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), "duplicates")
    at = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    return pieces.join(lists, at, "left").drop("_conv", "_piece")


def sorted_by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "piece")


def edited_pieces(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edited pieces, totals) of conversations of several pieces."""
    marked = stored(mark_duplicates(pieces), "marked")
    summaries = stored(marked.mapInArrow(per_piece(summarise, SUMMARY), SUMMARY), "summaries")
    ordered = sorted_by_conversation(summaries)
    totals = stored(ordered.mapInArrow(by_conversation(lambda p: walk(p, False), TOTALS), TOTALS), "totals")
    decided = ordered.mapInArrow(by_conversation(lambda p: walk(p, True), DECISION), DECISION)
    names = {"conv_id": "_conv", "piece": "_piece"}
    decided = stored(decided, "decided").withColumnsRenamed(names)
    at = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    known = marked.join(few(decided), at).drop(*names.values())
    return stored(known.mapInArrow(per_piece(decode_piece, EDITED), EDITED), "edited"), totals


def split_by_length(pieces: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(conversations of one piece, the others with marks of the first and the last piece, or None)."""
    ends = pieces.groupBy("conv_id").agg(F.min("piece").alias("_low"), F.max("piece").alias("_high"))
    long = stored(ends.where("_low < _high").withColumnRenamed("conv_id", "_conv"), "long")
    if not long.limit(1).count():
        return pieces, None
    match = F.col("conv_id").eqNullSafe(F.col("_conv"))
    hinted = few(long)
    marked = pieces.join(hinted, match).withColumns({"is_first": F.col("piece") == F.col("_low"), "is_last": F.col("piece") == F.col("_high")})
    return pieces.join(hinted, match, "left_anti"), marked.drop("_conv", "_low", "_high")


def report(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: gaps, faults, illegal neighbours, cost, audit and digest of the repair."""
    pieces = stored(in_pieces(df, id_col, turn_col, role_col, text_col), "pieces")
    short, long = split_by_length(pieces)
    found = stored(short.mapInArrow(per_piece(lambda row: solve_whole(row)[0], REPORT), REPORT), "reports")
    if long is None:
        return found
    edited, totals = edited_pieces(long)
    schema = "conv_id long, audit string, repaired_sha256 string"
    digests = sorted_by_conversation(edited).mapInArrow(by_conversation(put_together, schema), schema)
    digests = digests.withColumnRenamed("conv_id", "_conv")
    whole = totals.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return stored(found.unionByName(whole), "all_reports")


def repair(
    df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The repaired conversations: (conv_id, piece, at, role, text), in the order of piece and at."""
    pieces = stored(in_pieces(df, id_col, turn_col, role_col, text_col), "pieces")
    short, long = split_by_length(pieces)
    edited = short.mapInArrow(per_piece(lambda row: solve_whole(row)[1], EDITED), EDITED)
    if long is not None:
        edited = edited.unionByName(edited_pieces(long)[0])
    rows = edited.select("conv_id", "piece", F.posexplode("repaired").alias("at", "row"))
    return rows.select("conv_id", "piece", "at", "row.role", "row.text")


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults drawn by a checksum of conversation and turn.

    Of twenty values 0 drops the row, 1 empties its text, 2 takes away ``.!?``, 3 repeats
    the row, 4 makes its role user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = df.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("_draw"),
    ).where("_draw <> 0")
    draw = F.col("_draw")
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(draw == 4, "user").otherwise(F.col("role"))
    often = F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_copy", often).select("conv_id", "turn", role.alias("role"), text.alias("text"))


def report_of_damaged(df: DataFrame) -> DataFrame:
    """`report` after `damage`, with a row for every conversation of `df`, also those with no rows left."""
    ids = df.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = report(damage(df)).withColumnRenamed("conv_id", "_conv")
    made = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = hashlib.sha256(b"").hexdigest()
    return made.withColumns({**zeros, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(empty))})
