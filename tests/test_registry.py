import pytest

from fieldtally.operators import registry


def test_known_sources_start_idle(spark):
    rows = registry.known_sources(spark).collect()
    assert {row["name"]: row["url"] for row in rows} == {
        "gbif": "https://gbif.org",
        "obis": "https://obis.org",
        "idigbio": "https://idigbio.org",
    }
    assert registry.list_sources(registry.known_sources(spark)).collect() == []


def test_started_sources_are_listed(spark):
    known = registry.mark_started(registry.known_sources(spark), "obis")
    assert [row["source"] for row in registry.list_sources(known).collect()] == ["http://obis.org"]
    twice = {row["name"]: row for row in registry.mark_started(known, "obis").collect()}
    assert (twice["obis"]["job_count"], twice["obis"]["producer_online"]) == (2, True)
    assert (twice["gbif"]["job_count"], twice["gbif"]["producer_online"]) == (0, False)


def test_find_source(spark):
    known = registry.known_sources(spark)
    assert registry.find_source(known, "https://idigbio.org/portal") == "idigbio"
    for url in ("https://www.gbif.org", "gbif.org", "https://GBIF.org"):
        with pytest.raises(ValueError, match="no registered source"):
            registry.find_source(known, url)
    with pytest.raises(ValueError, match="URL is needed"):
        registry.find_source(known, "")
