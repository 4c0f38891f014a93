"""Temperature mixing of sources, in DataFrame operations only.

A source's weight is its token share raised to an exponent between 0 (all sources alike) and 1 (as
they come), normalised. The exponent is bisected until the most repeated source is read at most
``max_epochs`` times, or until the weights reach a target entropy. The weights times the token
budget are then realised: a source's documents lie in hashed blocks of about ``block_tokens``;
every epoch takes the blocks in an order of its own, whole epochs take all, and the last one takes
blocks until the budget is used, and of the block that does not fit, documents in hashed order.

Without a budget the largest source is read once, so every document is taken at least once.
Tokens are words between blanks, one at least per document, so null and empty texts are taken too.
A null source is the source ''. Repeated rows are documents of their own; rows without an id
share one place in the order. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.llm.common import BLANKS, written

#: Halvings of the exponent's range, and how many a pass over the sources settles.
HALVINGS, AT_ONCE = 30, 5
#: Weights are kept to this many parts of one.
PARTS = 1e9


@dataclass(frozen=True)
class Mixture:
    """What the exponent has to meet, the budget in tokens (None: the largest source once) and the block size."""

    max_epochs: float | None = 4.0
    entropy: float | None = None
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: str = "mix"


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, print``, read once from the texts; ``print`` tells apart texts under one id."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{BLANKS}]+"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                       F.greatest(words, F.lit(1)).cast("bigint").alias("n_tokens"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))


def sources(rows: DataFrame) -> DataFrame:
    """``source, tokens, documents, share``; a row per source."""
    per = written(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")))
    total = per.agg(F.sum("tokens").alias("n")).first().n
    return per.withColumn("share", F.col("tokens") / F.lit(total))


def _fits(mixture: Mixture, exponent: float, mass: float, spread: float, low: float, high: float, total: float) -> bool:
    """Whether the exponent is large enough. mass: sum of powers of the shares; spread: the same, weighted by their logarithms."""
    if mixture.entropy is not None:
        return log(mass) - exponent * spread / mass <= mixture.entropy
    epochs = exp((1 - exponent) * (log(high) - log(low))) if mixture.budget is None else mixture.budget / total * exp((exponent - 1) * log(low)) / mass
    return epochs <= mixture.max_epochs * (1 + 1e-12)


def exponent(per: DataFrame, mixture: Mixture) -> float:
    """The least exponent, in steps of 2 ** -HALVINGS, that fits; 1 if none does. Each pass narrows the range 32 times."""
    bounds = per.agg(F.min("share").alias("low"), F.max("share").alias("high"), F.sum("tokens").alias("total")).first()
    if bounds.low is None or (mixture.entropy is None and mixture.max_epochs is None):
        return 1.0
    low, high = -1, 1 << HALVINGS  # low does not fit, high is the answer so far
    for _ in range(HALVINGS // AT_ONCE + 1):
        tried = sorted({low + (high - low) * i // (1 << AT_ONCE) for i in range(1, 1 << AT_ONCE)} - {low, high})
        if not tried:
            break
        sums = []
        for i, k in enumerate(tried):
            power = F.pow("share", F.lit(k / (1 << HALVINGS)))
            sums += [F.sum(power).alias(f"m{i}"), F.sum(power * F.log("share")).alias(f"s{i}")]
        row = per.agg(*sums).first()
        for i, k in enumerate(tried):
            if _fits(mixture, k / (1 << HALVINGS), row[f"m{i}"], row[f"s{i}"], bounds.low, bounds.high, bounds.total):
                high = k
                break
            low = k
    return high / (1 << HALVINGS)


def weights(per: DataFrame, mixture: Mixture) -> DataFrame:
    """``source, tokens, weight, budget``: normalised weights and each source's tokens to read."""
    power = per.withColumn("power", F.pow("share", F.lit(exponent(per, mixture))))
    mass = power.agg(F.sum("power").alias("m")).first().m
    weighed = power.withColumn("weight", F.floor(F.col("power") / F.lit(mass) * PARTS + 0.5) / PARTS)
    if mixture.budget is None:
        top = weighed.agg(F.max(F.struct("tokens", "source", "weight")).alias("t")).first().t
        whole = ceil(top.tokens / top.weight) if top else 0
        budget = F.greatest("tokens", F.floor(F.lit(float(whole)) * F.col("weight")))
    else:
        most = F.lit(float(mixture.budget)) if mixture.max_epochs is None else F.least(
            F.lit(float(mixture.budget)), F.col("tokens") * mixture.max_epochs / F.col("weight"))
        budget = F.floor(most * F.col("weight"))
    return weighed.select("source", "tokens", "weight", budget.alias("budget"))


def _order(mixture: Mixture, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(mixture.seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def copies(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """``doc_id, source, n_tokens, print, weight, block, copies``: how often each document is read (0: not at all)."""
    rows = written(counted(docs))
    per = written(weights(sources(rows), mixture))
    whole = F.floor(F.col("budget") / F.col("tokens"))
    per = per.withColumn("epochs", whole).withColumn("rest", F.col("budget") - whole * F.col("tokens")).withColumn(
        "blocks", F.ceil(F.col("tokens") / mixture.block_tokens)).drop("tokens", "budget")
    place = F.conv(F.substring(_order(mixture, F.col("doc_id")), 1, 8), 16, 10).cast("bigint")
    placed = rows.join(per, "source").withColumn("block", F.pmod(place, F.col("blocks")))
    # Running totals over blocks, in the order of the last, partial epoch; a block is about block_tokens.
    sizes = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("size"), F.first("rest").alias("rest"), F.first("epochs").alias("epochs"))
    before = Window.partitionBy("source").orderBy(_order(mixture, F.col("source"), F.col("epochs"), F.col("block")), "block").rowsBetween(
        Window.unboundedPreceding, -1)
    room = sizes.withColumn("room", F.col("rest") - F.coalesce(F.sum("size").over(before), F.lit(0))).select("source", "block", "size", "room")
    laid = placed.join(room, ["source", "block"])
    inside = Window.partitionBy("source", "block").orderBy(_order(mixture, F.col("epochs"), F.col("doc_id")), "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    split = (F.col("room") > 0) & (F.col("room") < F.col("size"))
    plain = laid.filter(~split).withColumn("more", F.col("room") >= F.col("size"))
    partly = laid.filter(split).withColumn("more", F.sum("n_tokens").over(inside) <= F.col("room"))  # one block per source
    return plain.union(partly).select("doc_id", "source", "n_tokens", "print", "weight", "block", (F.col("epochs") + F.col("more").cast("bigint")).alias("copies"))


def schedule(taken: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """``doc_id, source, n_tokens, weight, epoch, block, block_rank, doc_rank``: a row per reading of a document.

    In an epoch a source's blocks come by ``block_rank``, a block's documents by ``doc_rank``.
    """
    read = taken.filter("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))).drop("copies")
    blocks = read.select("source", "epoch", "block").distinct().withColumn("block_rank", F.row_number().over(
        Window.partitionBy("source", "epoch").orderBy(_order(mixture, F.col("source"), F.col("epoch"), F.col("block")), "block")).cast("bigint"))
    inside = Window.partitionBy("source", "epoch", "block").orderBy(_order(mixture, F.col("epoch"), F.col("doc_id")), "doc_id", "n_tokens")
    return read.join(blocks, ["source", "epoch", "block"]).withColumn("doc_rank", F.row_number().over(inside).cast("bigint")).select(
        "doc_id", "source", "n_tokens", "weight", "epoch", "block", "block_rank", "doc_rank")


def mixed(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The rows of ``docs`` that are read, with ``mix_weight`` and ``mix_copies`` of their own source and text.

    Rows meet their numbers by id, source and text, so an id in two sources and rows without an id get what is theirs; rows
    alike in all three get the same number of copies.
    """
    taken = copies(docs, mixture).groupBy("doc_id", "source", "print").agg(F.max("weight").alias("mix_weight"), F.max("copies").alias("mix_copies"))
    ids = taken.filter("mix_copies > 0").select(
        F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("print").alias("__mix_print"), "mix_weight", "mix_copies")
    own = docs.drop("mix_weight", "mix_copies")
    met = (F.col("doc_id").cast("bigint").eqNullSafe(F.col("__mix_id")) & (F.coalesce(own["source"].cast("string"), F.lit("")) == F.col("__mix_source"))
           & (F.xxhash64(F.coalesce(own["text"], F.lit(""))) == F.col("__mix_print")))
    return own.join(ids, met).drop("__mix_id", "__mix_source", "__mix_print")
