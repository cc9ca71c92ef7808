"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each source gets a mean repetition rate that brings its share of the bytes to its
weight. A document is repeated as often as a Poisson distribution with that mean
says at a uniform number hashed from seed and id (inversion), and the copies are
shuffled over the whole collection by a hash of their own.

Defined results. A null source is a source of its own; sources without a weight
take the default weight, those with weight zero vanish. Null ids draw by their
text; rows that repeat id and text draw the same count. A source without bytes
counts one byte for each row. An empty table gives no rows. Columns of the input
named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeed.llm.common import free_name, octets, without, written

ADDED = ("copy", "n_copies", "rate", "order_key")
# A higher rate is drawn as a sum of independent Poisson numbers of equal rates up to
# this, which is Poisson again: tables of steps stay short at any rate.
POISSON_RATE = 512
# More sources than this are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 10_000


def hash_uniform(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) out of 52 bits of the MD5 of seed and columns."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *columns)), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_steps(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... until nothing is left; the array's length is about the rate.

    Added up from the terms' logarithms: exp(-rate) alone would vanish beyond a rate of 700.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["steps"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float], default_weight: float, source_column: str, text_column: str) -> DataFrame:
    """_source, rate, _draws, _steps: one row for each source; a count is the sum of _draws numbers drawn from _steps."""
    sizes = docs.groupBy(F.col(source_column).alias("_source")).agg(F.sum(octets(text_column) + 1).alias("bytes"))
    weight = F.lit(float(default_weight))
    for name, value in weights.items():
        weight = F.when(F.col("_source") == name, F.lit(float(value))).otherwise(weight)
    sizes = written(sizes.withColumn("weight", weight), "sources")
    whole = sizes.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    total = whole.first()
    rate = F.col("weight") / F.lit(total["all_weight"] or 1.0) * F.lit(float(total["all_bytes"] or 0)) / F.col("bytes")
    rates = sizes.select("_source", rate.alias("rate")).withColumn("_draws", F.greatest(F.ceil(F.col("rate") / POISSON_RATE), F.lit(1)).cast("int"))
    rates = rates.withColumn("_steps", poisson_steps(F.col("rate") / F.col("_draws")))
    rates = written(rates, "rates")
    return F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates


def mixed_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    default_weight: float = 1.0,
    seed: int = 29,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    partitions: int | None = None,
) -> DataFrame:
    """The repeated rows in their new order, with ``copy``, ``n_copies``, ``rate`` and ``order_key``.

    The order is that of partitions and, within them, of order_key.
    """
    docs = without(docs, *ADDED)
    rates = source_rates(docs, weights or {}, default_weight, source_column, text_column)
    name = F.coalesce(F.col(id_column).cast("string"), F.col(text_column), F.lit(""))
    of, draws, steps = (free_name(docs, n) for n in ("_source", "_draws", "_steps"))
    drawn = docs.join(rates.withColumnsRenamed({"_source": of, "_draws": draws, "_steps": steps}), F.col(source_column).eqNullSafe(F.col(of)))
    drawn = drawn.withColumn(u := free_name(drawn, "_u"), hash_uniform(seed, name))

    def further(total: Column, draw: Column) -> Column:
        uniform = hash_uniform(seed, F.concat(F.lit("#"), draw.cast("string")), name)
        return total + F.size(F.filter(steps, lambda p: p <= uniform))

    more = F.aggregate(F.sequence(F.lit(1), F.col(draws) - 1), F.lit(0), further)
    count = F.size(F.filter(steps, lambda p: p <= F.col(u))) + F.when(F.col(draws) > 1, more).otherwise(0)
    drawn = drawn.withColumn("n_copies", count).where("n_copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n_copies") - 1).cast("int"))))
    copies = copies.withColumn("order_key", F.xxhash64(F.lit(seed), name, F.col("copy")))
    parts = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(parts, "order_key").sortWithinPartitions("order_key").select(*docs.columns, *ADDED)
