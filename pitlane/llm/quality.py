"""Document quality by hierarchical empirical Bayes over sites.

1. A document classifier (logistic regression on a dozen measures of the text) gives
   each document evidence: the log odds of being good, beyond the labels' base rate.
2. Documents are grouped by host and, within it, by path.  Each level's rate of good
   documents is the mean of the documents' probabilities, shrunk towards the level above
   by a prior strength that the moments of that level give: sites with few documents
   stay near their host, hosts with few near the global rate.
3. A document's posterior log odds are its own evidence plus the log odds of its path,
   with its own share in the path taken out.

Group statistics are sums, aggregated before the shuffle; groups without an entry (null
host or path) are groups of their own.  The fit reads a bounded sample: the `per_class`
labelled rows of either label with the smallest hash of their id.

Defined cases: null and empty texts are scored as texts without words; without labels
of both kinds the evidence is zero and every posterior is 0.5 (kept); a null id is carried
through; repeated rows give repeated results and each counts in its site; other columns
are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import Shared, few, map_arrow, stored
from pitlane.llm.words import BASE, Words, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_CLASS = 3000
RIDGE, STEPS = 1e-2, 25
CUT = 0.5
SCHEMA = "doc_id long, host string, path string, evidence double, probability double"


def measures(column: pa.Array) -> np.ndarray:
    """A dozen measures of each text, all bounded or logarithmic; computed over whole texts."""
    words = Words(column)
    n = len(column)
    size = np.diff(words.offsets).astype(float)
    count = words.counts.astype(float)
    owner = words.text

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[words.bytes])))
        return (total[words.offsets[1:]] - total[words.offsets[:-1]]) / np.maximum(size, 1)

    def of(ranges: list[tuple[int, int]]) -> np.ndarray:
        table = np.zeros(256)
        for a, b in ranges:
            table[a:b] = 1
        return table

    lengths = (words.end - words.start).astype(float)
    # Distinct words, and words that repeat their neighbour.
    _, first = np.unique(mix(words.hash + owner.astype(np.uint64) * BASE), return_index=True)
    distinct = np.bincount(owner[first], minlength=n)
    again = np.zeros(len(owner))
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    odd_end = of([(33, 34), (35, 39), (42, 43), (124, 125)])[words.bytes[words.end - 1]] if len(owner) else np.zeros(0)
    per_word = np.maximum(count, 1)
    total = lambda x: np.bincount(owner, weights=x, minlength=n)
    return np.stack(
        (
            np.log1p(count), np.log1p(size), np.minimum(total(lengths) / per_word, 30) / 10, distinct / per_word,
            distinct / np.maximum(np.sqrt(count), 1) / 10, total(again) / per_word, total(odd_end) / per_word,
            share(of([(65, 91)])), share(of([(48, 58)])), share(of([(33, 48), (58, 65), (91, 97), (123, 127)])),
            share(of([(10, 11)])), share(of([(46, 47)])), share(of([(124, 125)])),
        ),
        axis=1,
    )


@dataclass
class Classifier:
    """Standardised logistic regression; `base` is the log odds of the fitted sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float
    prior: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log odds beyond the sample's own."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        full = np.concatenate((z, z**2, np.ones((len(x), 1))), axis=1)
        return np.clip(full @ self.weights - self.base, -20, 20)


def fit(x: np.ndarray, y: np.ndarray, prior: float) -> Classifier:
    """Newton steps with a ridge; measures and their squares."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    full = np.concatenate((z, z**2, np.ones((len(x), 1))), axis=1)
    w = np.zeros(full.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        hess = (full * (p * (1 - p))[:, None]).T @ full / len(x) + RIDGE * np.eye(len(w))
        w -= np.linalg.solve(hess, full.T @ (p - y) / len(x) + RIDGE * w)
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    return Classifier(mean, scale, w, float(np.log(rate / (1 - rate))), prior)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = PER_CLASS) -> Classifier | None:
    """Fit on the bounded sample; `docs` has doc_id and text.  None without labels of both kinds."""
    usable = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    rates = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    if len(rates) < 2:
        return None
    parts = [usable.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    # At most 2 * per_class rows, so the broadcast is bounded.
    chosen = docs.join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select("doc_id", "label", "text")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.array(list(measures(batch.column("text"))), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), rows], ["doc_id", "label", "x"])

    found = sorted(map(tuple, map_arrow(chosen, extract, "doc_id long, label int, x array<double>").collect()))
    if len({r[1] for r in found}) < 2:
        return None
    share = rates[1] / (rates[0] + rates[1])
    return fit(np.array([r[2] for r in found]), np.array([r[1] for r in found], dtype=float), float(np.log(share / (1 - share))))


def log_odds(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.ln(safe / (1 - safe))


def strength(groups: DataFrame, n: str, total: str, prior: Column) -> float:
    """The prior strength of a level by the method of moments.

    With rates r of n documents around the prior m, the excess of (r - m)^2 over the
    sampling variance m(1 - m) / n says how much sites differ: 1 / (1 + k) of m(1 - m).
    """
    m = F.least(F.greatest(prior, F.lit(1e-4)), F.lit(1 - 1e-4))
    spread = m * (1 - m)
    rate = F.col(total) / F.col(n)
    row = groups.where(F.col(n) >= 2).agg(
        F.sum(F.col(n) * (rate - m) ** 2 - spread).alias("excess"), F.sum((F.col(n) - 1) * spread).alias("room")
    ).first()
    if not row or not row.room:
        return 1e6
    share = min(max(row.excess / row.room, 1e-6), 0.999)
    return (1 - share) / share


def site_rates(scored: DataFrame) -> DataFrame:
    """(host, path, n, total, rate, pull, strength): each path's documents and its shrunk rate."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("probability").alias("total"))
    paths = stored(paths, "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total")), "hosts")
    top = hosts.agg(F.sum("host_total").alias("t"), F.sum("host_n").alias("n")).first()
    rate = (top.t / top.n) if top.n else 0.5
    k_host = strength(hosts, "host_n", "host_total", F.lit(rate))
    shrunk = hosts.select(F.col("host").alias("own_host"), ((F.col("host_total") + k_host * rate) / (F.col("host_n") + k_host)).alias("pull"))
    # Sites are few against documents; the larger side is not moved when they are few at all.
    joined = stored(paths.join(few(stored(shrunk, "shrunk")), F.col("host").eqNullSafe(F.col("own_host"))).drop("own_host"), "sites")
    k_path = strength(joined, "n", "total", F.col("pull"))
    return joined.withColumn("strength", F.lit(float(k_path)))


def classify(
    df: DataFrame, model: Classifier | None, host: str | Column = "source", path: str | Column = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, evidence, site_prior, posterior and kept."""
    shared = Shared(df, model)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        as_column(host).cast("string").alias("host"), as_column(path).cast("string").alias("path"),
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        evidence = m.evidence(measures(batch.column("text"))) if m else np.zeros(batch.num_rows)
        p = 1 / (1 + np.exp(-(evidence + (m.prior if m else 0.0))))
        arrays = [batch.column("doc_id"), batch.column("host"), batch.column("path"), pa.array(evidence), pa.array(p)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "host", "path", "evidence", "probability"])

    scored = stored(map_arrow(rows, run, SCHEMA), "evidence")
    sites = site_rates(scored).withColumnsRenamed({"host": "site_host", "path": "site_path"})
    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path"))
    joined = scored.join(few(sites), same)
    # The document itself does not vouch for its own site.
    rate = (F.col("total") - F.col("probability") + F.col("strength") * F.col("pull")) / (F.col("n") - 1 + F.col("strength"))
    posterior = 1 / (1 + F.exp(-(F.col("evidence") + F.col("site_log_odds"))))
    return (
        joined.withColumn("site_log_odds", log_odds(rate)).withColumn("posterior", posterior)
        .select("doc_id", "evidence", rate.alias("site_prior"), "posterior", (F.col("posterior") >= CUT).alias("kept"))
    )
