import pytest
from pyspark.errors import PySparkException

from fieldtally.operators.records import core_records, parse_json, parse_records, union_sources


def values(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def first(spark, source, text):
    return parse_records(values(spark, text), source).first().asDict(recursive=True)


def core(spark, topic, *texts):
    messages = spark.createDataFrame([(topic, text) for text in texts], "topic string, value string")
    return [tuple(row) for row in core_records(messages).collect()]


@pytest.mark.parametrize(
    "text",
    ["not json", '{"kingdom":"A"', '{"kingdom":"A", "x":bad}', "[]", '[{"kingdom":"A"}]', "null", "", None],
)
def test_unreadable_messages_stay_as_empty_rows(spark, text):
    assert core(spark, "gbif", text) == [("gbif", None, None)]
    assert set(first(spark, "gbif", text).values()) == {None}


@pytest.mark.parametrize("key", ["10.5", '"7"', "10.0", "4000000000"])
def test_a_field_of_the_wrong_type_is_missing_alone(spark, key):
    row = first(spark, "gbif", f'{{"key":{key},"kingdom":"Plantae"}}')
    assert (row["key"], row["kingdom"]) == (None, "Plantae")


@pytest.mark.parametrize(
    "field, value",
    [("decimalLatitude", '"1.5"'), ("extensions", "5"), ("issues", '{"a":1}')],
)
def test_other_wrong_types(spark, field, value):
    row = first(spark, "gbif", f'{{"{field}":{value},"kingdom":"Fungi"}}')
    assert (row[field], row["kingdom"]) == (None, "Fungi")


@pytest.mark.parametrize(
    "value, text", [("5", "5"), ("true", "true"), ('{"a":[1]}', '{"a":[1]}'), ('"é\\u00e9"', "éé")]
)
def test_values_of_string_fields(spark, value, text):
    assert core(spark, "obis", f'{{"kingdom":{value}}}') == [("obis", text, None)]


def test_nested_values_keep_their_json_text(spark):
    row = first(spark, "gbif", '{"extensions":{"x":[{"p":1}]},"media":[{"t":"i"}]}')
    assert row["extensions"] == {"x": '[{"p":1}]'}
    assert row["media"] == ['{"t":"i"}']


def test_all_gbif_shapes(spark):
    row = first(
        spark,
        "gbif",
        '{"gadm":{"level0":{"gid":"FRA","name":"France"}},"identifiers":[{"identifier":"a"}],'
        '"http://unknown.org/language":"fr","isSequenced":false,"elevation":1.5,"order":"Rosales"}',
    )
    assert row["gadm"] == {"level0": {"gid": "FRA", "name": "France"}}
    assert row["identifiers"] == [{"identifier": "a"}]
    assert row["http://unknown.org/language"] == "fr"
    assert (row["isSequenced"], row["elevation"], row["order"]) == (False, 1.5, "Rosales")


def test_names_are_case_sensitive_and_the_last_one_wins(spark):
    texts = ['{"Kingdom":"A"}', '{"kingdom":"A","kingdom":"B"}', '{"kingdom":"A"} junk']
    assert core(spark, "gbif", *texts) == [
        ("gbif", None, None),
        ("gbif", "B", None),
        ("gbif", "A", None),
    ]


def test_each_topic_has_its_own_field_names(spark):
    text = '{"kingdom":"k","scientificName":"s","dwc:kingdom":"dk","dwc:scientificName":"ds"}'
    assert core(spark, "idigbio", text) == [("idigbio", "dk", "ds")]
    assert core(spark, "gbif", text) == [("gbif", "k", "s")]
    assert core(spark, "obis", text) == [("obis", "k", "s")]


def test_a_topic_without_schema_fails_the_query(spark):
    with pytest.raises(PySparkException, match="no record schema for topic ebird"):
        core(spark, "ebird", "{}")
    with pytest.raises(ValueError):
        core_records(spark.createDataFrame([], "topic string, value string"), ["ebird"])


def test_few_fields_give_the_same_as_all(spark):
    texts = ['{"key":1.5,"kingdom":"A","year":2000}', '{"kingdom":"A","year":20', '{"year":"x"}', "[]"]
    fields = ["kingdom", "year"]
    narrow = parse_records(values(spark, *texts), "gbif", fields).collect()
    assert narrow == parse_records(values(spark, *texts), "gbif").select(*fields).collect()


def test_parse_json_of_another_column(spark):
    df = spark.createDataFrame([('{"k": 3}',)], "props string")
    assert parse_json(df, "k int", "props").first()["k"] == 3


def test_union_keeps_duplicates_and_renames(spark):
    frames = {
        "gbif": parse_records(values(spark, '{"kingdom":"A"}', '{"kingdom":"A"}'), "gbif"),
        "idigbio": parse_records(values(spark, '{"dwc:kingdom":"A"}'), "idigbio"),
    }
    rows = sorted(tuple(row) for row in union_sources(frames).collect())
    assert rows == [("gbif", "A", None), ("gbif", "A", None), ("idigbio", "A", None)]
    with pytest.raises(ValueError):
        union_sources({})
