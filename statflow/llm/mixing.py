"""Operator 6: temperature mixing of sources.

Shares p are the sources' parts of all tokens (words). Weights are p ** t, normalised:
t = 1 keeps the corpus as it is, t = 0 makes all sources equal. t is bisected to the
smallest value in [0, 1] at which the weights' entropy is at most the target and no
source is read more than ``max_repeats`` times. Both are monotone in t and hold at
t = 1. Each step of the bisection is one aggregate over the table of sources (``LEVELS``
halvings at a time); the table itself stays distributed.

The weights are realised as budgeted block permutations. A source's stream reads its
documents in a hash permutation, then in another one, and so on (epochs) until its
budget, weight x token budget, is spent: a document is taken if its first token lies
within the budget. The stream is cut in ``blocks`` equal parts; block b of the result
takes part b of every stream, in hash order, so every block has the target weights.

The budget is the corpus's tokens (``budget="corpus"``: rich sources are cut, poor ones
repeated) or the smallest one at which every source is read whole once
(``budget="cover"``: nothing is dropped).

Everything is DataFrame functions. Running token sums come from ranges of the
permutation hash (about ``RANGE_ROWS`` rows each, so a source with a third of all rows
is many ranges): sums by range, a window over these sums, and a window in each range.

Defined cases: a null source is a source of its own; null text has no tokens;
documents without tokens are taken with epoch 0 of their source and never repeated;
equal rows are separate documents; sources without tokens have weight 0; an empty
table gives an empty result; other columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import hash52, names, null_safe_text, stage

LEVELS, PASSES = 3, 10  # 30 halvings
RANGE_ROWS = 2_000
DIGITS = 6  # the exponent is rounded up to so many decimals


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.regexp_count(null_safe_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _sources(docs: DataFrame) -> DataFrame:
    by = docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    return stage(by, "mix-sources")


def _log_shares(sources: DataFrame, total: int) -> DataFrame:
    return sources.where("tokens > 0").select(
        F.log(F.col("tokens") / F.lit(float(total))).alias("l"))


def bisect_exponent(sources: DataFrame, target_entropy: float | None, max_repeats: float,
                    cover: bool) -> float:
    """The smallest t in [0, 1] that meets both limits, to ``DIGITS`` decimals.
    ``sources``: ``tokens`` by source. ``target_entropy`` in nats, None: no limit."""
    total = sources.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    if total == 0:
        return 1.0
    shares = _log_shares(sources, total)
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        grid = [low + (high - low) * k / (1 << LEVELS) for k in range(1 << LEVELS)]
        sums = []
        for k, t in enumerate(grid):
            x = F.exp(F.col("l") * F.lit(t))
            sums += [F.sum(x).alias(f"z{k}"), F.sum(x * F.col("l")).alias(f"s{k}")]
        row = shares.agg(F.min("l").alias("least"), F.max("l").alias("most"), *sums).first()
        best = high
        for k, t in reversed(list(enumerate(grid))):
            if not _meets(row, k, t, target_entropy, max_repeats, cover):
                low = t
                break
            best = t
        high = best
        if low >= high:
            break
    step = 10 ** DIGITS
    return min(1.0, -(-round(high * step * 1000) // 1000) / step)


def _meets(row, k: int, t: float, target: float | None, repeats: float, cover: bool) -> bool:
    from math import exp, log
    z, s = row[f"z{k}"], row[f"s{k}"]
    entropy = log(z) - t * s / z
    most = exp((1 - t) * (row["most"] - row["least"])) if cover else \
        exp((t - 1) * row["least"]) / z
    return (target is None or entropy <= target + 1e-12) and most <= repeats * (1 + 1e-12)


def entropy_between(sources: DataFrame, part: float) -> float | None:
    """The entropy ``part`` of the way from the corpus's own to that of equal shares."""
    from math import log
    row = sources.where("tokens > 0").agg(
        F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("tokens") * F.log("tokens")).alias("s")).first()
    if not row["k"]:
        return None
    own = log(row["t"]) - row["s"] / row["t"]
    return own + part * (log(row["k"]) - own)


def mix(docs: DataFrame, target_part: float | None = 0.5, max_repeats: float = 4.0,
        budget: str = "corpus", blocks: int = 64, seed: int = 1) -> DataFrame:
    """Rows of ``docs`` (``doc_id, source, tokens`` and any others) as often as they are
    read, plus ``epoch, start, block, weight, exponent``. ``start``: tokens of the
    source's stream before the document."""
    names(docs, ["doc_id", "source", "tokens"])
    cover = budget == "cover"
    if budget not in ("cover", "corpus"):
        raise ValueError("budget is 'corpus' or 'cover'")
    sources = _sources(docs)
    target = None if target_part is None else entropy_between(sources, target_part)
    t = bisect_exponent(sources, target, max_repeats, cover)
    shares = sources.crossJoin(F.broadcast(sources.agg(F.sum("tokens").alias("all")))).withColumn(
        "raw", F.when(F.col("tokens") > 0,
                      F.exp(F.log(F.col("tokens") / F.col("all").cast("double")) * F.lit(t)))
        .otherwise(0.0))
    scale = shares.agg(F.sum("raw").alias("z"),
                       F.max(F.when(F.col("raw") > 0, F.col("tokens") / F.col("raw"))).alias("m"))
    weight = F.col("raw") / F.col("z")
    # Rounded first: the last bits of a float sum must not decide.
    exact = (F.col("raw") * F.col("m")) if cover else weight * F.col("all")
    wanted = F.floor(F.round(exact, 6)).cast("long")
    plan = stage(shares.crossJoin(F.broadcast(scale)).select(
        F.col("source").alias("__source"), F.col("tokens").alias("__all"),
        F.coalesce(wanted, F.lit(0)).alias("__budget"), weight.alias("weight"),
        (1 + F.floor(F.col("rows") / F.lit(RANGE_ROWS))).alias("__ranges")), "mix-plan")

    key = ["__source", "epoch", "__range"]
    rows = docs.join(plan, docs["source"].eqNullSafe(plan["__source"]))
    last = F.when((F.col("tokens") > 0) & (F.col("__all") > 0),
                  F.floor((F.col("__budget") - 1) / F.col("__all"))).otherwise(F.lit(0))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(
        last, F.lit(0)).cast("int"))))
    rows = rows.withColumn("__h", hash52(F.lit(seed), F.col("epoch"), F.col("doc_id"),
                                         F.col("tokens"), F.col("source")))
    rows = rows.withColumn("__range", F.floor(F.col("__h") / F.lit(float(1 << 52))
                                              * F.col("__ranges")))
    sizes = rows.groupBy(*key).agg(F.sum("tokens").alias("__t"))
    before = (Window.partitionBy("__source", "epoch").orderBy("__range")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(sizes.select(*key, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o")),
                    "mix-offsets").select(F.col("__source").alias("__s"),
                                          F.col("epoch").alias("__e"),
                                          F.col("__range").alias("__r"), "__o")
    inside = (Window.partitionBy(*key).orderBy("__h", "doc_id", "tokens")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rows.withColumn("__end", F.sum("tokens").over(inside))
    same = (F.col("__source").eqNullSafe(F.col("__s")) & (F.col("epoch") == F.col("__e"))
            & (F.col("__range") == F.col("__r")))
    start = (F.col("epoch") * F.col("__all") + F.col("__o") + F.col("__end") - F.col("tokens"))
    placed = (summed.join(offsets, same).withColumn("start", start.cast("long"))
              .where((F.col("start") < F.col("__budget")) | (F.col("__budget") <= 0)
                     | (F.col("tokens") == 0)))
    block = F.when(F.col("__budget") > 0, F.least(F.floor(
        F.col("start") * F.lit(blocks) / F.col("__budget")), F.lit(blocks - 1))).otherwise(F.lit(0))
    return placed.select(*docs.columns, "epoch", "start", block.cast("int").alias("block"),
                         F.round("weight", 9).alias("weight"), F.lit(t).alias("exponent"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture of a documents table, as digests: one row for each time a document
    is read."""
    names(docs, ["doc_id", "text", "source"])
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("tokens"))
    return mix(rows, **options)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs``, each row as often as it is read."""
    names(docs, ["doc_id", "text", "source"])
    held = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("tokens"), held)
    return mix(rows, **options).select("__row.*")
