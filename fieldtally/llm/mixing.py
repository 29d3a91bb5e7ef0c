"""Mixing of sources to target weights by Poisson replication.

A source's mean repetition is its share of the wanted rows over the rows it has. Each document's
count is the Poisson quantile of a number that a hash of its id and a seed gives, so it is the same
wherever and however often it is computed. Documents are repeated by their count and put in the
order of a second hash, which spreads copies over the whole output. That hash is uniform, so it says by itself which
partition of the order a row goes to: texts are read and shuffled once, without a look for the ranges first.

Defined cases: null sources and empty ones are one source; weights of absent
sources are left out of the shares and absent weights count as zero; a null doc_id hashes as the
empty text; rows of one doc_id have the same count; an empty table gives no rows; a text column may
be null or of any length; other columns go through unless named ``copy`` or ``shuffle_key``, which
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import others, quoted, written

NULL_SOURCE = ""


def hashed(*parts: Column | str) -> Column:
    """52 bits of the MD5 of the parts, as a long."""
    text = F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def quantiles(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), … of a Poisson variable, up to where no number below 1 lies beyond."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        F.array(F.exp(-rate)).alias("sums"), F.exp(-rate).alias("sum"), (-rate).alias("log")
    )

    def grow(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(rate) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(
            F.concat(state["sums"], F.array(total)).alias("sums"), total.alias("sum"), log.alias("log")
        )

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, grow, lambda s: s["sums"]))


def rates(docs: DataFrame, weights: dict[str, float] | None, power: float, epochs: float) -> DataFrame:
    """``source_key, rate, sums``: mean repetitions of each source and their Poisson quantiles."""
    source_key = F.coalesce("source", F.lit(NULL_SOURCE)).alias("source_key")
    counts = written(docs.groupBy(source_key).agg(F.count(F.lit(1)).alias("rows")), "sources")
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(power)))
    else:
        rows = [(k, float(v)) for k, v in weights.items() if v > 0]
        given = docs.sparkSession.createDataFrame(rows, "source_key string, weight double")
        weighted = counts.join(given, "source_key", "left").fillna(0.0, ["weight"])
    all_sources = weighted.agg(F.sum("rows").alias("all_rows"), F.sum("weight").alias("all_weight"))
    rate = (
        F.lit(epochs) * F.col("all_rows") * F.col("weight") / F.col("all_weight") / F.col("rows")
    )
    one_row = F.broadcast(all_sources)  # totals: a single row
    return (
        weighted.join(one_row, F.lit(True))
        .filter(F.col("weight") > 0)
        .withColumn("rate", rate)
        .select("source_key", "rate", quantiles(F.col("rate")).alias("sums"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = 0.5,
    epochs: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """Documents repeated to the target weights, with ``copy`` (from 0) and ``shuffle_key``, in its order.

    ``weights`` gives shares by source; without them a source weighs its number of rows to ``power``.
    ``epochs`` is the wanted number of rows over those there are. The table of rates has a row per
    source; it is written first, so that Spark sees its size and sends it to the executors only if it
    is small.
    """
    names = others(docs, "copy", "shuffle_key")
    table = written(rates(docs, weights, power, epochs), "rates")
    # The row travels as one value, so none of its columns can meet a name used here.
    rows = docs.select(
        F.struct(*quoted(names)).alias("row"),
        F.coalesce("source", F.lit(NULL_SOURCE)).alias("source_key"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("ident"),
    )
    uniform = hashed(seed, F.col("ident")) / F.lit(float(1 << 52))
    repeated = (
        rows.join(table, "source_key")
        .withColumn("u", uniform)
        .withColumn("copies", F.size(F.filter("sums", lambda c: c <= F.col("u"))))
        .filter(F.col("copies") > 0)
        .select("row", "ident", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        .withColumn("shuffle_key", hashed(seed, "order", F.col("ident"), F.col("copy")))
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.shiftright("shuffle_key", 22) * F.lit(parts) / F.lit(1 << 30)).cast("int")
    repeated = repeated.repartitionById(parts, place).sortWithinPartitions("shuffle_key", "ident", "copy")
    return repeated.select("row.*", "copy", "shuffle_key")
