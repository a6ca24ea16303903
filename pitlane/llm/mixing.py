"""Mixing sources to target weights, with DataFrame functions only.

1. Words are counted per document and summed per source; sources are few next to
   documents, and one that holds most of them is summed before the shuffle.
2. Sources share all words by weight.  None gets more than `cap` times its own words:
   sorted by words per weight, the sources that reach the cap are a prefix, so running
   sums show where it ends and at which level the others stand.
3. A source's rate is target / words.  Each document is taken floor(rate) times, and once
   more if its coin is below the rest.  The coin is a hash of seed, id, source and text,
   and of a running number among rows that are equal in these, so reruns agree and equal
   rows have coins of their own.

Defined cases: a null or blank text has no words; it is taken like others and adds none.
A null source is a source of its own and comes last; null ids are ids like others.
Without any words all targets are 0.  No rows give no rows.  Columns of the input that
are named like a result are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import few, stored
from pitlane.operators.series import Series

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 12
WORD = r"[^\x20\x09-\x0D]+"
# A source with more than this share of all rows is joined without a shuffle; there are at most 1 / SHARE.
SHARE = 0.001
KEY, SOURCE, SIZE = "_mix_key", "_mix_source", "_mix_size"
RESULTS = ("size", "source_size", "target", "copies", "taken")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """`docs` with its source, its number of words and a hash of id, source and text, under own names."""

    def marked(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))

    text, source = F.col(text_col), F.col(source_col).cast("string")
    words = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), marked(F.col(id_col)), F.md5(F.coalesce(text, F.lit(""))), marked(source)))
    return docs.withColumns({SOURCE: source, SIZE: words, KEY: key})


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds `target` to (`_mix_source`, source_size): shares by weight, at most `cap` times the size.

    `weights` go round the sources in code point order, null last.  `sources` should be stored.
    """
    ordered = sources.withColumn("_null", F.col(SOURCE).isNull())
    ranked = Series(ordered, [], ["_null", SOURCE]).position("_rank").rows()
    turn = (F.col("_rank") - 1) % len(weights) + 1
    weighed = ranked.withColumn("_weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn.cast("int")).cast("long"))
    weighed = stored(weighed.withColumn("_fill", F.col("source_size") / F.col("_weight")), "weighed")
    total = weighed.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    if not total.size:
        return weighed.select(SOURCE, "source_size", F.lit(0.0).alias("target"), "rows")
    full = (cap * F.col("source_size")).cast("double")
    sums = {"_sizes": ("sum", F.col("source_size")), "_weights": ("sum", F.col("_weight"))}
    summed = Series(weighed, [], ["_fill", "_rank"]).running(sums).rows()

    def wide(column: Column) -> Column:
        return column.cast("decimal(19,0)")

    # What is left when all sources before this one are at the cap, and the weight it goes to.
    left = F.lit(total.size) - cap * (F.col("_sizes") - F.col("source_size"))
    weight = F.lit(total.weight) - F.col("_weights") + F.col("_weight")
    below = wide(cap * F.col("source_size")) * wide(weight) > wide(left) * wide(F.col("_weight"))
    level = summed.where(below).select("_fill", "_rank", left.alias("left"), weight.alias("weight")).orderBy("_fill", "_rank").first()
    # With a cap of 1 all sources are at it.
    share = F.col("_weight") * F.lit(level["left"]) / F.lit(level["weight"]) if level else full
    return weighed.select(SOURCE, "source_size", F.least(share, full).alias("target"), "rows")


def attach(df: DataFrame, sources: DataFrame) -> DataFrame:
    """`df` with its source's columns.  Few sources are broadcast whole; of many, those that
    hold a large share of the rows, and only rows of the others are shuffled."""
    own = sources.withColumnRenamed(SOURCE, "_of")
    match = F.col(SOURCE).eqNullSafe(F.col("_of"))
    hinted = few(own)
    if hinted is not own:
        return df.join(hinted, match).drop("_of")
    rows = sources.agg(F.sum("rows")).first()[0]
    large = own.where(F.col("rows") > F.lit(SHARE * rows))
    rest = own.where(F.col("rows") <= F.lit(SHARE * rows))
    found = df.join(F.broadcast(large), match, "left")
    names = [c for c in own.columns if c != "_of"]
    light = found.where(F.col("rows").isNull()).drop(*own.columns).join(rest, match)
    return found.where(F.col("rows").isNotNull()).drop("_of").unionByName(light.drop("_of").select(*df.columns, *names))


def numbered(counted: DataFrame) -> DataFrame:
    """Adds `_turn`: 1 for rows that are alone with their key, else a running number."""
    repeated = stored(counted.groupBy(KEY).count().where("count > 1").select(KEY), "repeated")
    if not repeated.limit(1).count():
        return counted.withColumn("_turn", F.lit(1).cast("long"))
    marked = counted.join(few(repeated.withColumn("_again", F.lit(True))), KEY, "left")
    alone = marked.where("_again IS NULL").drop("_again").withColumn("_turn", F.lit(1).cast("long"))
    again = marked.where("_again").drop("_again").withColumn("_row", F.monotonically_increasing_id())
    turns = Series(again, [KEY], ["_row"]).position("_turn").rows()
    return alone.unionByName(turns.drop("_row"))


def mix_counted(counted: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """`mix` for the rows of `count_words`, of which it reads all but the text three times."""
    sums = counted.groupBy(SOURCE).agg(F.sum(SIZE).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    found = targets(stored(sums, "sources"), weights, cap).withColumnsRenamed({"source_size": "_words", "target": "_target"})
    plain = counted.drop(*[c for c in counted.columns if c.lower() in RESULTS])
    kept = [c for c in plain.columns if c not in (SOURCE, SIZE, KEY)]
    inputs = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_none"))
    packed = plain.select(SOURCE, SIZE, KEY, inputs.alias("_doc"))
    rows = attach(numbered(packed), stored(found, "targets"))
    # 52 bits of a hash, from 0 to below 1.
    digits = F.substring(F.md5(F.concat_ws("|", KEY, F.col("_turn").cast("string"))), 1, 13)
    coin = F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))
    rate = F.when(F.col("_words") > 0, F.col("_target") / F.col("_words")).otherwise(F.lit(0.0))
    copies = F.floor("_rate") + F.when(F.col("_coin") < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
    made = rows.withColumns({"_rate": rate, "_coin": coin}).withColumn("_copies", copies)
    return made.select(
        *[F.col(f"_doc.`{c}`").alias(c) for c in kept],
        F.col(SIZE).alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_copies").cast("int").alias("copies"),
        (F.col("_copies") * F.col(SIZE)).alias("taken"),
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """`docs` with size, source_size, target, copies (how often the mix takes the row) and taken words."""
    return mix_counted(count_words(docs, id_col, text_col, source_col, seed), weights, cap)


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as its `copies` say, without the columns of `mix`."""
    taken = mixed.where(F.col("copies") > 0)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy", *RESULTS)
