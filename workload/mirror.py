"""The driver's tables as occurrence messages, landed pages and result logs.

Every row of a table becomes a message or a page; only the spelling of the values is chosen here.
All of it is derived by Spark, row by row, and works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fieldtally.operators.results import build_documents, result_messages
from fieldtally.schemas import CORE_FIELDS, schema_for
from fieldtally.sources.messages import file_stream

# Fixed values, the same as in ``oracle.OBSERVATIONS``.
TOPICS = ("gbif", "idigbio", "obis")
KINGDOM_OF_EVENT = {
    "view": "Animalia",
    "click": "animalia",
    "purchase": "PLANTAE",
    "signup": "Fungi",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A micro-batch takes at most this many bytes of a table, so that a failure repeats no more.
BATCH_BYTES = 10**12


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A plain path would have to be a folder; as a pattern it may be a single file as well.
    path = f"{sf_dir}/{name}.parque[t]"
    options = {"maxBytesPerTrigger": str(BATCH_BYTES)}
    return file_stream(spark, path, table(spark, sf_dir, name).schema, options=options)


def observations(events: DataFrame) -> DataFrame:
    """Events with the core columns they stand for; ``error`` events have no kingdom."""
    topic = F.lit(TOPICS[-1])
    for rest, name in enumerate(TOPICS[:-1]):
        topic = F.when(F.col("user_id") % len(TOPICS) == rest, name).otherwise(topic)
    kingdom = F.lit(None).cast("string")
    for event_type, name in KINGDOM_OF_EVENT.items():
        kingdom = F.when(F.col("event_type") == event_type, name).otherwise(kingdom)
    name = F.concat(F.lit("sp"), F.col("user_id"))
    return events.withColumns(
        {
            "topic": topic,
            "kingdom": kingdom,
            "scientificName": F.when(F.col("event_id") % 10 != 0, name),
        }
    )


def messages(events: DataFrame) -> DataFrame:
    """Each event as a message ``(topic, value)`` in its source's own field names."""
    seen = observations(events)
    value = _core_json("gbif")
    for topic in TOPICS[1:]:
        value = F.when(F.col("topic") == topic, _core_json(topic)).otherwise(value)
    return seen.select("topic", value.cast("binary").alias("value"), "event_id", "ts")


def damaged_messages(events: DataFrame) -> DataFrame:
    """``messages`` of which most are damaged in one of several ways; none is left out."""
    text = F.col("value").cast("string")
    damage = F.col("event_id") % 7
    value = (
        F.when(damage == 0, F.expr("substring(cast(value as string), 1, length(value) - 2)"))
        .when(damage == 1, F.lit("not json"))
        .when(damage == 2, F.lit("[]"))
        .when(damage == 3, F.lit(""))
        .when(damage == 4, F.lit(None).cast("string"))
        .when(damage == 5, F.concat(text, F.lit(" and more")))
        .otherwise(text)
    )
    return messages(events).withColumn("value", value.cast("binary"))


def full_messages(events: DataFrame, source: str) -> DataFrame:
    """Every event as a record of one source, with a field of each type it has.

    Some event types carry a value that does not fit its field: too large for an int, a fraction
    for an int, text for an int.
    """
    seen = observations(events)
    record = {"gbif": _gbif_record, "idigbio": _idigbio_record, "obis": _obis_record}[source]()
    value = F.to_json(F.struct(*record), {"ignoreNullFields": "false"})
    return seen.select(value.alias("value"))


def _gbif_record() -> list[Column]:
    place = F.struct(F.col("topic").alias("gid"), F.col("event_type").alias("name"))
    purchase, signup = F.col("event_type") == "purchase", F.col("event_type") == "signup"
    return [
        F.col("event_id").alias("key"),
        (F.col("user_id") + F.when(purchase, 4_000_000_000).otherwise(0)).alias("taxonKey"),
        F.when(signup, F.col("user_id") + 0.5).alias("crawlId"),
        F.create_map(F.lit("props"), F.from_json("props", "k int")).alias("extensions"),
        F.col("value").alias("decimalLatitude"),
        F.create_map(F.lit("level0"), place).alias("gadm"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.array("event_type", "topic").alias("issues"),
        (F.col("event_type") == "view").alias("isSequenced"),
        F.array(F.struct(F.col("event_type").alias("identifier"))).alias("identifiers"),
        F.col("event_type").alias("http://unknown.org/language"),
        "kingdom",
        "scientificName",
    ]


def _idigbio_record() -> list[Column]:
    return [
        F.col("event_id").alias("id"),
        (F.col("event_type") == "view").alias("dwc:group"),
        F.col("user_id").alias("dwc:individualCount"),
        F.from_json("props", "k int").alias("dwc:higherClassification"),
        F.col("kingdom").alias("dwc:kingdom"),
        F.col("scientificName").alias("dwc:scientificName"),
        F.lit("not a field of this source").alias("kingdom"),
    ]


def _obis_record() -> list[Column]:
    return [
        F.col("event_id").cast("string").alias("id"),
        F.col("value").alias("sst"),
        F.col("user_id").alias("aphiaID"),
        F.when(F.col("event_type") == "view", F.lit("7")).alias("depth"),
        (F.col("event_type") == "error").alias("dropped"),
        F.array("event_type").alias("node_id"),
        F.col("kingdom").alias("Kingdom"),
        F.col("kingdom"),
        F.col("scientificName"),
    ]


def filled_messages(events: DataFrame, source: str) -> DataFrame:
    """Every event as a record of one source with a value in every field of its schema.

    The same values as in ``oracle.filled_fields``: made from the event's number and the field's place.
    """
    record = StructType.fromDDL(schema_for(source))
    values = [
        filled_value(field.dataType.simpleString(), place).alias(field.name)
        for place, field in enumerate(record.fields)
    ]
    return events.select(F.to_json(F.struct(*values)).alias("value"))


def filled_value(kind: str, place: int) -> Column:
    number = F.col("event_id") + place

    def text(letter: str) -> Column:
        return F.concat(F.lit(f"{letter}{place}-"), F.col("event_id"))

    return {
        "string": lambda: text("s"),
        "int": lambda: (number % 1_000_000).cast("int"),
        "double": lambda: number / F.lit(4.0),
        "boolean": lambda: number % 2 == 0,
        "array<string>": lambda: F.array(text("a"), text("b")),
        "array<struct<identifier:string>>": lambda: F.array(F.struct(text("i").alias("identifier"))),
        "map<string,string>": lambda: F.create_map(F.lit("key"), text("m")),
        "map<string,struct<gid:string,name:string>>": lambda: F.create_map(
            F.lit("level0"), F.struct(text("g").alias("gid"), text("n").alias("name"))
        ),
    }[kind]()


def field_sum(kind: str, field: Column) -> Column:
    """A field's value as a number to be added up."""
    text = {
        "string": lambda: field,
        "array<string>": lambda: F.array_join(field, ","),
        "array<struct<identifier:string>>": lambda: F.array_join(field["identifier"], ","),
        "map<string,string>": lambda: field["key"],
        "map<string,struct<gid:string,name:string>>": lambda: F.concat_ws(
            ",", field["level0"]["gid"], field["level0"]["name"]
        ),
    }
    if kind in text:
        return F.conv(F.substring(F.md5(text[kind]().cast("binary")), 1, 8), 16, 10).cast("bigint")
    return (field * 4 if kind == "double" else field).cast("int" if kind == "boolean" else "bigint").cast("bigint")


def _core_json(source: str) -> Column:
    fields = [F.col(column).alias(field) for column, field in CORE_FIELDS[source].items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


# The field of each source's records that carries the line's number in the page fixtures.
LINE_ID = {"gbif": "occurrenceID", "idigbio": "id", "obis": "id"}


def document_pages(documents: DataFrame, source: str) -> DataFrame:
    """Each document as an API page whose records are the lines of its whole text."""

    def record(line: Column, position: Column) -> Column:
        line_id = F.concat_ws("-", F.col("doc_id"), position)
        fields = CORE_FIELDS[source]
        return F.struct(
            line_id.alias(LINE_ID[source]),
            F.col("lang").alias(fields["kingdom"]),
            line.alias(fields["scientificName"]),
        )

    records = F.transform(F.split("text", "\n"), record)
    size = F.array_size(records)
    if source == "gbif":
        envelope = F.struct(
            F.lit(0).alias("offset"),
            F.lit(1000).alias("limit"),
            (F.col("n_chars") < 1000).alias("endOfRecords"),
            size.alias("count"),
            records.alias("results"),
        )
    elif source == "idigbio":
        items = F.transform(records, lambda record: F.struct(record.alias("data")))
        envelope = F.struct(size.alias("itemCount"), items.alias("items"))
    else:
        envelope = F.struct(size.alias("total"), records.alias("results"))
    return documents.select("doc_id", F.to_json(envelope).alias("page"))


# Records of a page that is made of events.
PAGE_RECORDS = 50


def event_pages(events: DataFrame, source: str) -> DataFrame:
    """One source's events as API pages of neighbouring ones."""
    fields = [F.col(column).alias(field) for column, field in CORE_FIELDS[source].items()]
    seen = observations(events).where(F.col("topic") == source)
    number = F.floor(F.col("event_id") / PAGE_RECORDS).alias("number")
    paged = seen.groupBy(number).agg(F.collect_list(F.struct(*fields)).alias("records"))
    records = F.col("records")
    if source == "idigbio":
        records = F.transform(records, lambda record: F.struct(record.alias("data")))
    envelope = F.struct(records.alias("items" if source == "idigbio" else "results"))
    return paged.select("number", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("page"))


def damaged_pages(documents: DataFrame, source: str) -> DataFrame:
    """``document_pages`` of which most are damaged in one of several ways, by ``doc_id``."""
    records = "items" if source == "idigbio" else "results"
    page, damage = F.col("page"), F.col("doc_id") % 12
    text = (
        F.when(damage == 0, F.expr("substring(page, 1, length(page) - 1)"))
        .when(damage == 1, F.concat(page, page))
        .when(damage == 2, F.lit("{}"))
        .when(damage == 3, F.lit(None).cast("string"))
        .when(damage == 4, F.lit(" "))
        .when(damage == 5, F.lit(f'{{"{records}":null}}'))
        .when(damage == 6, F.lit('{"error":"rate limit"}'))
        .when(damage == 7, F.lit(f'{{"{records}":"none"}}'))
        .when(damage == 8, F.concat(page, F.lit("]")))
        .when(damage == 9, F.concat(F.lit("["), page, F.lit("]")))
        .otherwise(page)
    )
    return document_pages(documents, source).withColumn("page", text)


def daily_results(events: DataFrame) -> DataFrame:
    """Result log ``(topic, offset, value)``: one document per source and day, offset by day.

    Names are counted exactly here, so that merged results can be compared.
    """
    seen = observations(events).select(
        "topic", "kingdom", "scientificName", day_number("ts").alias("offset")
    )
    day = ["topic", "offset"]
    names = seen.dropDuplicates([*day, "scientificName"]).groupBy(*day)
    species = names.agg(F.count("scientificName").alias("species"))
    counts = seen.groupBy(*day, "kingdom").agg(F.count("*").alias("count")).join(species, day)
    return result_messages(build_documents(counts, keys=day, species=F.max("species")))


# Day of the month from which each topic's documents are damaged, and how; the days as in ``oracle.READABLE_DAYS``.
BROKEN_DAYS = {
    "gbif": (24, "concat(value, ' and more')"),
    "idigbio": (27, "translate(value, '\"', '\\'')"),
    "obis": (20, "substring(value, 1, length(value) - 1)"),
}


def broken_results(events: DataFrame) -> DataFrame:
    """``daily_results`` of which each source has damaged ones: cut, followed by text, or in the wrong quotes."""
    day = F.dayofmonth(F.date_from_unix_date(F.col("offset").cast("int")))
    value = F.col("value")
    for source, (broken, damage) in BROKEN_DAYS.items():
        own = (F.col("topic") == f"{source}_query") & (day == broken)
        value = F.when(own, F.expr(damage)).otherwise(value)
    return daily_results(events).withColumn("value", value)


def event_registry(events: DataFrame, idle: str | None = None) -> DataFrame:
    """Registry of the topics in the events, one job per signup; ``idle`` has no job."""
    job = (F.col("event_type") == "signup") & (F.col("topic") != F.lit(idle or ""))
    jobs = F.count_if(job).cast("int").alias("job_count")
    counted = observations(events).groupBy("topic").agg(jobs)
    return counted.select(
        F.col("topic").alias("name"),
        F.concat(F.lit("https://"), F.col("topic"), F.lit(".org")).alias("url"),
        "job_count",
        (F.col("job_count") > 0).alias("producer_online"),
    )


def day_number(ts: str) -> Column:
    return F.unix_date(F.col(ts).cast("date")).cast("bigint")
