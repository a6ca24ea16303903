"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition.

A text is cut into words by the tokenizer's pattern.  Words not met before in this
process become token-position rows ``(word, position, token)``.  A recursive query
joins neighbouring rows with the merge table, contracts each word's leftmost pair of
least rank, and ends when no word has a pair left.  Decoding joins ids with their
bytes and concatenates them in an ordered aggregation.

The merge table holds every split of every token into two tokens, so a pair's rank
is the rank of the joined bytes, as in the tiktoken library.

Words above `LONG` bytes would need one round for each contraction.  There a round
contracts all occurrences of the word's least rank at once where that is proven
equal: no token made with the new token may have a lower rank (`safe`); otherwise
only the leftmost.

Defined cases: null and empty texts have no tokens; a null id is carried through;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import tempfile

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from pitlane.llm.common import LARGE, id_and_text, map_arrow, per_process, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Bits of a row's key that hold the position in its word.
BITS = 28
LONG = 512
# Words kept in a process are at most twice this many.
CACHE_WORDS = 180_000
# Rows of one recursive query.
ROWS = 150_000

ENCODE = f"""
WITH RECURSIVE state(k, tok, nxt, rank, round) AS (
  SELECT s.k, s.tok, s.nxt, m.merged, 0
  FROM start s LEFT JOIN merges m ON m.pair = s.tok::BIGINT * 65536 + s.nxt
  UNION ALL (
    WITH best AS (
      SELECT k >> {BITS} AS word, min((rank::BIGINT << {BITS}) | (k & {2**BITS - 1})) AS least
      FROM state WHERE rank IS NOT NULL GROUP BY 1
    ), pick AS (
      SELECT b.word, (b.least >> {BITS})::INT AS merged, b.least & {2**BITS - 1} AS spot, s.nxt AS after
      FROM best b JOIN state s ON s.k = (b.word << {BITS}) + (b.least & {2**BITS - 1}) + 1
    ), moved AS (
      SELECT s.k, s.k & {2**BITS - 1} AS pos, spot, round + 1 AS round, rank,
        CASE WHEN pos = spot THEN merged ELSE tok END AS tok,
        CASE WHEN pos = spot THEN after WHEN pos = spot - 1 THEN merged ELSE nxt END AS nxt
      FROM state s JOIN pick ON s.k >> {BITS} = word WHERE s.k & {2**BITS - 1} <> spot + 1
    )
    SELECT v.k - (v.pos > v.spot)::INT, v.tok, v.nxt,
      CASE WHEN v.pos IN (v.spot - 1, v.spot) THEN m.merged ELSE v.rank END, v.round
    FROM moved v LEFT JOIN merges m
      ON m.pair = CASE WHEN v.pos IN (v.spot - 1, v.spot) THEN v.tok::BIGINT * 65536 + v.nxt END
  )
), final AS (SELECT k >> {BITS} AS word, max(round) AS round FROM state GROUP BY 1)
SELECT s.k, s.tok FROM state s JOIN final f ON s.k >> {BITS} = f.word AND s.round = f.round ORDER BY s.k
"""

# One round over long words: (word, pos, tok) to the same with pairs contracted.
LONG_ROUND = """
CREATE OR REPLACE TABLE long_next AS
WITH pairs AS (
  SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt FROM long_state
), ranked AS (
  SELECT p.*, m.merged, m.safe, min(m.merged) OVER (PARTITION BY p.word) AS least
  FROM pairs p LEFT JOIN merges m ON m.pair = p.tok::BIGINT * 65536 + p.nxt
), hits AS (
  SELECT *, coalesce(merged = least, false) AS hit,
    min(CASE WHEN merged = least THEN pos END) OVER (PARTITION BY word) AS spot
  FROM ranked
), runs AS (
  SELECT *, pos - sum(hit::INT) OVER (PARTITION BY word ORDER BY pos) AS run FROM hits
), chosen AS (
  -- in a run of overlapping pairs every other one, from the left
  SELECT *, hit AND (pos = spot OR safe)
    AND (row_number() OVER (PARTITION BY word, hit, run ORDER BY pos)) % 2 = 1 AS joins
  FROM runs
), kept AS (
  SELECT *, coalesce(lag(joins) OVER (PARTITION BY word ORDER BY pos), false) AS gone FROM chosen
)
SELECT word, row_number() OVER (PARTITION BY word ORDER BY pos) - 1 AS pos,
  CASE WHEN joins THEN merged ELSE tok END AS tok, least IS NOT NULL AS active
FROM kept WHERE NOT gone
"""

DECODE = """
SELECT ids.word, string_agg(v.hex, '' ORDER BY ids.k) AS hex
FROM ids JOIN vocabulary v ON v.id = ids.tok GROUP BY 1
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def split_tokens(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (left id, right id, merged id) with left + right = merged."""
    rows = [
        (left, right, rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
    ]
    return tuple(np.array(rows, dtype=np.int64).reshape(-1, 3).T)


class Coder:
    """Encodes words with DuckDB; remembers the words it has met."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.split = regex.compile(pattern).findall
        ranks = load_ranks(path)
        left, right, merged = split_tokens(ranks)
        # A merge is safe if no token made with its result has a lower rank.
        lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, left, merged)
        np.minimum.at(lowest, right, merged)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(
            config={"threads": 1, "memory_limit": "150MB", "temp_directory": tempfile.mkdtemp(prefix="bpe-")}
        )
        tables = {
            "merges": pa.table(
                {
                    "pair": left * 65536 + right,
                    "merged": merged.astype(np.int32),
                    "safe": lowest[merged] > merged,
                }
            ),
            "vocabulary": pa.table({"id": list(ranks.values()), "hex": [t.hex() for t in ranks]}),
        }
        for name, table in tables.items():
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        # Ids of each word, as little-endian 32-bit integers.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Decoded bytes, kept only where they differ from the word's own.
        self.changed: dict[str, bytes] = {}

    def look_up(self, words: set[str]) -> dict[str, bytes]:
        """The ids of each word."""
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {}
        missing = []
        for word in words:
            if word not in self.new:
                if word in self.old:
                    self.new[word] = self.old[word]
                else:
                    missing.append(word)
        self.encode([w for w in missing if len(w.encode()) <= LONG], self.run_short)
        self.encode([w for w in missing if len(w.encode()) > LONG], self.run_long)
        return self.new

    def encode(self, words: list[str], run) -> None:
        start, total = 0, 0
        raw = [w.encode() for w in words]
        for end, word in enumerate(raw):
            if total and total + len(word) > ROWS:
                self.remember(words[start:end], run(raw[start:end]))
                start, total = end, 0
            total += len(word)
        if words[start:]:
            self.remember(words[start:], run(raw[start:]))

    def remember(self, words: list[str], ids: pa.Table) -> None:
        self.db.register("ids", ids)
        decoded = dict(self.db.sql(DECODE).fetchall())
        self.db.unregister("ids")
        tokens = ids["tok"].to_numpy().astype("<u4")
        ends = np.searchsorted(ids["word"].to_numpy(), np.arange(len(words) + 1))
        for i, word in enumerate(words):
            self.new[word] = tokens[ends[i] : ends[i + 1]].tobytes()
            back = bytes.fromhex(decoded[i])
            if back != word.encode():
                self.changed[word] = back

    def rows(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in raw])
        word = np.repeat(np.arange(len(raw)), lengths)
        pos = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return word, pos, self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]

    def run_short(self, raw: list[bytes]) -> pa.Table:
        word, pos, tok = self.rows(raw)
        last = np.append(word[1:] != word[:-1], True)
        nxt = pa.array(np.append(tok[1:], np.int32(0)), mask=last)
        self.db.register("start", pa.table({"k": (word << BITS) | pos, "tok": tok, "nxt": nxt}))
        out = self.db.sql(ENCODE).to_arrow_table()
        self.db.unregister("start")
        keys = out["k"].to_numpy()
        return pa.table({"word": keys >> BITS, "k": keys, "tok": out["tok"]})

    def run_long(self, raw: list[bytes]) -> pa.Table:
        word, pos, tok = self.rows(raw)
        self.db.register("given", pa.table({"word": word, "pos": pos, "tok": tok}))
        self.db.execute("CREATE OR REPLACE TABLE long_state AS SELECT * FROM given")
        self.db.unregister("given")
        self.db.execute("CREATE OR REPLACE TABLE long_done AS SELECT * FROM long_state LIMIT 0")
        while self.db.sql("SELECT count(*) FROM long_state").fetchall()[0][0]:
            self.db.execute(LONG_ROUND)
            self.db.execute("INSERT INTO long_done SELECT word, pos, tok FROM long_next WHERE NOT active")
            self.db.execute(
                "CREATE OR REPLACE TABLE long_state AS SELECT word, pos, tok FROM long_next WHERE active"
            )
        return self.db.sql("SELECT word, pos AS k, tok::INT AS tok FROM long_done ORDER BY word, pos").to_arrow_table()


def coder_name(path: str, pattern: str) -> str:
    return f"{LARGE}bpe_{hashlib.md5(f'{path} {pattern}'.encode()).hexdigest()}"


def coder(path: str, pattern: str) -> Coder:
    return per_process(coder_name(path, pattern), lambda: Coder(path, pattern))


def encode_texts(own: Coder, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
    """(number of ids, ids as little-endian 32-bit integers, decoded bytes) of each text."""
    split = [own.split(t) for t in texts]
    known = own.look_up(set().union(*split))
    out = []
    for words in split:
        ids = b"".join([known[w] for w in words])
        decoded = b"".join([own.changed.get(w) or w.encode() for w in words]) if own.changed else "".join(words).encode()
        out.append((len(ids) // 4, ids, decoded))
    return out


def digest_batch(batch: pa.RecordBatch, path: str, pattern: str) -> pa.RecordBatch:
    done = encode_texts(coder(path, pattern), texts_of(batch.column("text")))
    arrays = [
        batch.column("doc_id"),
        pa.array([n for n, _, _ in done], pa.int64()),
        pa.array([hashlib.sha256(ids).hexdigest() for _, ids, _ in done], pa.string()),
        pa.array([hashlib.sha256(raw).hexdigest() for _, _, raw in done], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def ids_batch(batch: pa.RecordBatch, path: str, pattern: str) -> pa.RecordBatch:
    done = encode_texts(coder(path, pattern), texts_of(batch.column("text")))
    ids = [np.frombuffer(raw, "<u4").astype(np.int32) for _, raw, _ in done]
    arrays = [
        batch.column("doc_id"),
        pa.array(ids, pa.list_(pa.int32())),
        pa.array([raw.decode("utf-8", "replace") for _, _, raw in done], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the token ids and the text decoded from them."""
    rows = id_and_text(df, id_col, text_col)
    return map_arrow(rows, lambda b: ids_batch(b, path, pattern), "doc_id long, ids array<int>, decoded string", keep=coder_name(path, pattern))


def encode_digests(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`encode`, with digests of ids and decoded bytes in place of the lists."""
    rows = id_and_text(df, id_col, text_col)
    return map_arrow(rows, lambda b: digest_batch(b, path, pattern), SCHEMA, keep=coder_name(path, pattern))
