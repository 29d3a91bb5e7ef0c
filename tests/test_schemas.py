import pytest
from pyspark.sql.types import StructType

from fieldtally.schemas import SOURCES, core_schema_for, schema_for


def types_of(source):
    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema_for(source))}


def count_types(source):
    counts = {}
    for kind in types_of(source).values():
        counts[kind] = counts.get(kind, 0) + 1
    return counts


def test_gbif_types(spark):
    assert count_types("gbif") == {
        "int": 16,
        "double": 4,
        "boolean": 2,
        "array<string>": 6,
        "array<struct<identifier:string>>": 1,
        "map<string,string>": 1,
        "map<string,struct<gid:string,name:string>>": 1,
        "string": 48,
    }
    assert types_of("gbif")["http://unknown.org/language"] == "string"


def test_idigbio_types(spark):
    assert count_types("idigbio") == {"string": 66}


def test_obis_types(spark):
    assert count_types("obis") == {
        "int": 13,
        "double": 4,
        "boolean": 2,
        "array<string>": 2,
        "string": 38,
    }


def test_every_field_may_be_missing(spark):
    for source in SOURCES:
        assert all(field.nullable for field in StructType.fromDDL(schema_for(source)))


def test_some_fields(spark):
    assert schema_for("gbif", ["key", "order"]).simpleString() == "struct<key:int,order:string>"
    assert core_schema_for("idigbio").names == ["dwc:kingdom", "dwc:scientificName"]


def test_unknown_names_fail_at_once(spark):
    with pytest.raises(ValueError, match="unknown source 'ebird'"):
        schema_for("ebird")
    with pytest.raises(ValueError, match="no field Kingdom"):
        schema_for("gbif", ["Kingdom"])
