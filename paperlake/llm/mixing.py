"""Mixing sources to target weights by Poisson replication.

A source's rate is how often its documents must occur on average for the source to
reach its share of the mixture. Each document draws its number of copies from a
Poisson distribution with that mean, by inverting the distribution at a number
hashed from the document's id and a seed, so the draw is the same in every run and
needs no state. Copies then go to a hashed place in one global order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.blocks import classes_of
from paperlake.session import materialize

SEED = 17
TEMPERATURE = 0.5


def _hashed(*parts: Column | str | int) -> Column:
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def _identity() -> Column:
    """What a row's draw depends on: its id, or its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))


def _uniform(identity: Column, seed: int) -> Column:
    """A number in [0, 1) with 52 bits."""
    return F.conv(F.substring(_hashed(identity, seed), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def tempered_weights(sizes: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """``source, weight`` with weight ``n_docs ** temperature``: 1 keeps shares, 0 makes them equal."""
    return sizes.select("source", F.pow(F.col("n_docs").cast("double"), F.lit(temperature)).alias("weight"))


def source_rates(
    documents: DataFrame, weights: Mapping[str, float] | None = None, total: int | None = None
) -> DataFrame:
    """``source, n_docs, weight, rate``, one row per source; null is a source of its own.

    ``weights`` are relative; a source without one gets none of the mixture. Without
    ``weights`` they are tempered sizes. ``total`` documents are aimed at, by default
    as many as there are.
    """
    sizes = materialize(documents.groupBy("source").agg(F.count("*").alias("n_docs")), "sources")
    if weights is None:
        given = tempered_weights(sizes)
    else:
        rows = [(s, float(w)) for s, w in weights.items()]
        given = documents.sparkSession.createDataFrame(rows, "source string, weight double")
    rows = sizes.alias("s").join(given.alias("w"), F.expr("s.source <=> w.source"), "left")
    rows = rows.select("s.source", "n_docs", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = rows.agg(F.sum("weight").alias("weight"), F.sum("n_docs").alias("n_docs"))
    all_weight = sums.select("weight").scalar()
    aim = F.lit(total) if total is not None else sums.select("n_docs").scalar()
    rate = F.when(all_weight > 0, F.col("weight") / all_weight * aim / F.col("n_docs")).otherwise(0.0)
    return rows.withColumn("rate", rate)


def _poisson_steps(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... up to where nothing that 52 bits can draw is left.

    Probabilities are kept as logarithms, so a large rate does not underflow.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def add(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), zero, add)["steps"]).otherwise(F.array(F.lit(2.0)))


def mix_sources(
    documents: DataFrame, weights: Mapping[str, float] | None = None, total: int | None = None, seed: int = SEED
) -> DataFrame:
    """The columns of ``documents`` (doc_id, source, text and others), ``copy`` and ``shuffle_key``.

    Columns of these two names are replaced.

    A document occurs as often as it draws, ``copy`` counting from 1; rates below one
    leave some documents out, which is the sampling asked for. Rows lie in a global
    random order: partition by hash of ``shuffle_key``, sorted by it within. Rows with
    one doc_id draw alike; a row without doc_id draws by its text; a null source is a
    source. The rates, one row per source, are written first, so that Spark ships
    them if their size allows and otherwise joins by source, splitting a source that
    is much larger than others.
    """
    rates = source_rates(documents, weights, total)
    steps = materialize(rates.select(F.col("source").alias("_source"), _poisson_steps(F.col("rate")).alias("_steps")), "rates")
    given = [c for c in documents.columns if c not in ("copy", "shuffle_key")]
    rows = documents.select(
        F.struct(*given).alias("_row"), F.col("source").alias("_key"), _identity().alias("_identity")
    ).withColumn("_u", _uniform(F.col("_identity"), seed))
    copies = F.size(F.filter("_steps", lambda s: s <= F.col("_u")))
    drawn = rows.join(steps, F.expr("_key <=> _source")).withColumn("_copies", copies).filter("_copies > 0")
    drawn = drawn.select("_row", "_identity", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    key = F.substring(_hashed(F.col("_identity"), F.col("copy"), seed), 1, 16)
    drawn = drawn.select("_row.*", "copy", key.alias("shuffle_key"))
    return drawn.repartition(classes_of(documents.sparkSession), "shuffle_key").sortWithinPartitions("shuffle_key")
