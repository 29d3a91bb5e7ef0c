"""Random records from pages to merged counts, against plain Python."""

import json
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fieldtally.operators import aggregates, registry, results
from fieldtally.operators.records import core_records
from fieldtally.plans import jobs
from fieldtally.sources.messages import decode_value
from workload.mirror import TOPICS

KINGDOMS = st.sampled_from(["Animalia", "animalia", "PLANTAE", "Fungi", "é\"\\\n", "", None])
NAMES = st.one_of(st.none(), st.text(alphabet="abc é\"\\/\t ", max_size=4))
RECORDS = st.lists(st.tuples(KINGDOMS, NAMES, st.booleans()), max_size=25)


def record(source, kingdom, name, full):
    prefix = "dwc:" if source == "idigbio" else ""
    fields = {f"{prefix}kingdom": kingdom, f"{prefix}scientificName": name, "other": [{"x": None}]}
    return fields if full else {key: value for key, value in fields.items() if value is not None}


def page(source, records):
    if source == "idigbio":
        return {"itemCount": len(records), "items": [{"data": r} for r in records]}
    return {"count": len(records), "results": records}


@settings(max_examples=6, deadline=None)
@given(st.fixed_dictionaries({source: st.lists(RECORDS, max_size=3) for source in TOPICS}))
def test_pages_to_merged_counts(spark, landed):
    messages = None
    for source, pages in landed.items():
        texts = [json.dumps(page(source, [record(source, *r) for r in rs])) for rs in pages]
        df = spark.createDataFrame([(text,) for text in texts], "page string")
        sent = jobs.page_messages(df, source)
        messages = sent if messages is None else messages.unionByName(sent)

    seen = [(source, k, n) for source, pages in landed.items() for rs in pages for k, n, _ in rs]
    core = core_records(decode_value(messages))
    assert Counter(tuple(row) for row in core.collect()) == Counter(seen)

    exact = {tuple(row)[:2]: tuple(row)[2:] for row in aggregates.kingdom_exact(core).collect()}
    groups = {}
    for source, kingdom, name in seen:
        groups.setdefault((source, kingdom), []).append(name)
    assert exact == {key: (len(ns), len(set(ns) - {None})) for key, ns in groups.items()}

    report = {row["source"]: row for row in aggregates.category_counts(core).collect()}
    assert set(report) == {source.upper() for source, _, _ in seen}
    for source, row in report.items():
        kingdoms = [(k or "").lower() for s, k, _ in seen if s.upper() == source]
        counted = (row["animal_records"], row["plant_records"], row["fungi_records"])
        assert counted == tuple(kingdoms.count(k) for k in ("animalia", "plantae", "fungi"))
        assert row["total_records"] == len(kingdoms)

    documents = results.build_documents(aggregates.kingdom_sketches(core))
    log = results.result_messages(documents).withColumn("offset", F.lit(0))
    topics = [source + results.RESULT_SUFFIX for source in TOPICS]
    known = registry.known_sources(spark)
    for source in TOPICS:
        known = registry.mark_started(known, source)
    log = results.readable(log, topics)
    by_kingdom = {row[0]: row[1] for row in results.count_by(log, "kingdom", known).collect()}
    assert by_kingdom == Counter("Title Unavailable" if k is None else k for _, k, _ in seen)
    by_source = {row[0]: row[1] for row in results.count_by(log, "source", known).collect()}
    assert by_source == Counter(f"http://{source.upper()}.org" for source, _, _ in seen)
    species = results.count_by(log, "species", known).first()["species"]
    names = {source: {n for s, _, n in seen if s == source} - {None} for source in TOPICS}
    assert species == sum(len(own) for own in names.values())
