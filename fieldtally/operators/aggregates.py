"""Counts over core columns ``(topic, kingdom, scientificName)``.

Everything is grouped by ``topic``, so one run covers all sources, and every aggregate is combined
on the map side first: what is shuffled is one row per group and task, however large or uneven
the groups are. Without input rows no function returns a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldtally.functions import is_kingdom, source_label


def kingdom_counts(core: DataFrame) -> DataFrame:
    """Records per kingdom as spelled; a missing kingdom is a group of its own."""
    return core.groupBy("topic", "kingdom").agg(F.count("*").alias("count"))


def category_counts(core: DataFrame) -> DataFrame:
    """One row per source: animals, plants, fungi, approximate species, all records."""
    counts = core.groupBy("topic").agg(
        F.count_if(is_kingdom(F.col("kingdom"), "animalia")).alias("animal_records"),
        F.count_if(is_kingdom(F.col("kingdom"), "plantae")).alias("plant_records"),
        F.count_if(is_kingdom(F.col("kingdom"), "fungi")).alias("fungi_records"),
        F.approx_count_distinct("scientificName").alias("unique_species"),
        F.count("*").alias("total_records"),
    )
    return _label(counts)


def source_totals(core: DataFrame) -> DataFrame:
    """One row per source: approximate species and all records."""
    totals = core.groupBy("topic").agg(
        F.approx_count_distinct("scientificName").alias("distinct_count"),
        F.count("*").alias("total_records"),
    )
    return _label(totals)


def kingdom_exact(core: DataFrame) -> DataFrame:
    """Records and exact distinct names per kingdom, missing names not counted (batch).

    Grouped by name first, so that the names of one kingdom are spread over all partitions instead
    of sitting in one set.
    """
    names = core.groupBy("topic", "kingdom", "scientificName").agg(F.count("*").alias("count"))
    return names.groupBy("topic", "kingdom").agg(
        F.sum("count").alias("count"),
        F.count("scientificName").alias("distinct_names"),
    )


def kingdom_exact_running(core: DataFrame) -> DataFrame:
    """The same numbers of a stream, as a running state.

    Deduplication ahead of the count keeps the names seen so far, spread by hash, and lets each pass
    once; the count keeps one row per kingdom. So a trigger looks up the names of its own records
    and emits a row per kingdom, however many names there are. The records are read along two ways,
    one of which counts all of them, the other the names that are new.
    """
    named = core.where(F.col("scientificName").isNotNull())
    new = named.dropDuplicates(["topic", "kingdom", "scientificName"])
    steps = _steps(core, 1, 0).unionByName(_steps(new, 0, 1))
    return steps.groupBy("topic", "kingdom").agg(
        F.sum("records").alias("count"), F.sum("names").alias("distinct_names")
    )


def _steps(core: DataFrame, records: int, names: int) -> DataFrame:
    return core.select("topic", "kingdom", F.lit(records).alias("records"), F.lit(names).alias("names"))


# Registers of a species sketch, as a power of two: 4 KB a sketch, a relative error of 1.6 %.
SKETCH_SIZE = 12


def kingdom_sketches(core: DataFrame) -> DataFrame:
    """Records per kingdom, with a sketch of the kingdom's names.

    Sketches can be merged, so the totals of a source come from its kingdoms' rows, and both always
    agree. There is one sketch for each kingdom spelling; no record is counted along more than one way.
    """
    # A sketch passes over empty texts, which are names like any other here.
    name = F.concat(F.lit("="), "scientificName")
    return core.groupBy("topic", "kingdom").agg(
        F.count("*").alias("count"),
        F.hll_sketch_agg(name, F.lit(SKETCH_SIZE)).alias("names"),
    )


def species_estimate() -> Column:
    """Distinct names of all merged sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg("names"))


def _label(per_topic: DataFrame) -> DataFrame:
    values = [name for name in per_topic.columns if name != "topic"]
    return per_topic.select(source_label(F.col("topic")).alias("source"), *values)
