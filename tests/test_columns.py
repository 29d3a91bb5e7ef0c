from urllib.parse import urlsplit

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fieldtally.functions import is_kingdom, kingdom_label, source_name, source_url

URLS = [
    "https://gbif.org",
    "https://www.gbif.org/x",
    "gbif.org",
    "http://obis.org:8080/a",
    "http://localhost:9092",
    "https://user:pw@gbif.org/",
    "HTTPS://GBIF.org",
    "//gbif.org/x",
    "1http://gbif.org",
    "https://gbif.org/a b?q=é#z",
    "https://gbif.org?x=//y.z",
    "https:/gbif.org",
    "https://",
    "",
    "  https://gbif.org",
    "https://gb\tif.org",
    "a.b//c.d",
]


def names(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "n int, url string")
    rows = df.select("n", source_name(F.col("url")).alias("name")).orderBy("n").collect()
    return [row["name"] for row in rows]


def expected(url):
    return urlsplit(url).netloc.split(".")[0]


def test_source_names(spark):
    assert names(spark, URLS) == [expected(url) for url in URLS]
    assert names(spark, URLS[:4]) == ["gbif", "www", "", "obis"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ahtps:/.?#@-+1 é", max_size=20), min_size=40, max_size=60))
def test_any_text_gives_the_same_name_as_a_url_parser(spark, urls):
    assert names(spark, urls) == [expected(url) for url in urls]


def test_source_url_and_labels(spark):
    df = spark.createDataFrame([("gbif", "ANIMALIA"), ("obis", None)], "name string, kingdom string")
    rows = df.select(
        source_url(F.col("name")),
        kingdom_label(F.col("kingdom")),
        is_kingdom(F.col("kingdom"), "animalia"),
    ).collect()
    assert [tuple(row) for row in rows] == [
        ("http://gbif.org", "ANIMALIA", True),
        ("http://obis.org", "Title Unavailable", None),
    ]
