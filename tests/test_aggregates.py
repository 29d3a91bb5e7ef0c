from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldtally.operators import aggregates

CORE = "topic string, kingdom string, scientificName string"


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [
            ("gbif", "Animalia", "a"),
            ("gbif", "animalia", "a"),
            ("gbif", None, "b"),
            ("gbif", None, None),
            ("obis", "FUNGI", "a"),
            ("obis", "Plantae", None),
        ],
        CORE,
    )


def test_kingdoms_as_spelled(small):
    assert rows(aggregates.kingdom_counts(small)) == rows_sorted(
        [
            ("gbif", "Animalia", 1),
            ("gbif", "animalia", 1),
            ("gbif", None, 2),
            ("obis", "FUNGI", 1),
            ("obis", "Plantae", 1),
        ]
    )


def test_categories_without_case(small):
    report = aggregates.category_counts(small)
    assert report.columns == [
        "source",
        "animal_records",
        "plant_records",
        "fungi_records",
        "unique_species",
        "total_records",
    ]
    assert rows(report) == [("GBIF", 2, 0, 0, 2, 4), ("OBIS", 0, 1, 1, 1, 2)]


def test_totals_and_exact_names(small):
    assert rows(aggregates.source_totals(small)) == [("GBIF", 2, 4), ("OBIS", 1, 2)]
    assert rows(aggregates.kingdom_exact(small)) == rows_sorted(
        [
            ("gbif", "Animalia", 1, 1),
            ("gbif", "animalia", 1, 1),
            ("gbif", None, 2, 1),
            ("obis", "FUNGI", 1, 1),
            ("obis", "Plantae", 1, 0),
        ]
    )


def test_no_rows_give_no_rows(spark):
    nothing = spark.createDataFrame([], CORE)
    for count in (
        aggregates.kingdom_counts,
        aggregates.category_counts,
        aggregates.source_totals,
        aggregates.kingdom_exact,
        aggregates.kingdom_sketches,
        aggregates.kingdom_exact_running,
    ):
        assert count(nothing).collect() == []


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one kingdom with one name, another kingdom with all names."""
    n = F.col("id")
    return spark.range(30_000).select(
        F.when((n % 3 == 0) | (n % 2 == 0), "gbif").otherwise("obis").alias("topic"),
        F.when(n % 3 == 0, "Hot").when(n % 7 > 0, "Wide").alias("kingdom"),
        F.when(n % 3 == 0, "one")
        .when(n % 5 > 0, F.concat(F.lit("s"), n % 2000))
        .alias("scientificName"),
    )


def test_exact_counts_of_skewed_rows(skewed):
    counts, names = Counter(), {}
    for topic, kingdom, name in skewed.collect():
        counts[topic, kingdom] += 1
        names.setdefault((topic, kingdom), set()).update({name} - {None})
    expected = [(*key, counts[key], len(names[key])) for key in counts]
    assert rows(aggregates.kingdom_exact(skewed)) == rows_sorted(expected)


def test_the_running_form_gives_the_same_numbers(skewed):
    assert rows(aggregates.kingdom_exact_running(skewed)) == rows(aggregates.kingdom_exact(skewed))


def exact_names(skewed):
    names = skewed.groupBy("topic").agg(F.count_distinct("scientificName").alias("n"))
    return {row["topic"]: row["n"] for row in names.collect()}


def test_sketches_hold_the_counts_and_merge_to_the_totals(skewed):
    sketches = aggregates.kingdom_sketches(skewed)
    kingdoms = sketches.select("topic", "kingdom", "count")
    assert rows(kingdoms) == rows(aggregates.kingdom_counts(skewed))
    merged = sketches.groupBy("topic").agg(aggregates.species_estimate().alias("species"))
    exact = exact_names(skewed)
    for topic, species in merged.collect():
        assert abs(species - exact[topic]) <= 3 * 0.017 * exact[topic]


def test_an_empty_name_is_a_name_for_sketches(spark):
    core = spark.createDataFrame([("gbif", "A", ""), ("gbif", "A", "x"), ("gbif", None, None)], CORE)
    merged = aggregates.kingdom_sketches(core).groupBy("topic").agg(aggregates.species_estimate())
    assert rows(merged) == [("gbif", 2)]


def test_sketches_of_two_halves_merge_like_one(skewed):
    parts = [skewed.where(F.hash("scientificName", "kingdom") % 2 == half) for half in (0, 1, -1)]
    halves = [aggregates.kingdom_sketches(part) for part in parts]
    both = halves[0].union(halves[1]).union(halves[2])
    merged = both.groupBy("topic").agg(aggregates.species_estimate().alias("species"))
    exact = exact_names(skewed)
    assert {row["topic"] for row in merged.collect()} == set(exact)
    for topic, species in merged.collect():
        assert abs(species - exact[topic]) <= 3 * 0.017 * exact[topic]


def test_estimates_stay_within_their_bound(skewed):
    exact = {
        row["source"]: row["n"]
        for row in skewed.groupBy(F.upper("topic").alias("source"))
        .agg(F.count_distinct("scientificName").alias("n"))
        .collect()
    }
    for row in aggregates.category_counts(skewed).collect():
        assert abs(row["unique_species"] - exact[row["source"]]) <= 3 * 0.05 * exact[row["source"]]


def rows_sorted(expected):
    return sorted(expected, key=str)
