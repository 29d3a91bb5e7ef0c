"""Record schemas of the known sources, as DDL text for ``from_json`` and readers.

Fields are looked up by exact name, so their spelling, case and type decide the result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import StructType

# Field names and types of each source's records, in the sources' order.
GBIF_RECORD = """
    key int,
    datasetKey string,
    publishingOrgKey string,
    installationKey string,
    hostingOrganizationKey string,
    publishingCountry string,
    protocol string,
    lastCrawled string,
    lastParsed string,
    crawlId int,
    extensions map<string, string>,
    basisOfRecord string,
    occurrenceStatus string,
    taxonKey int,
    kingdomKey int,
    phylumKey int,
    classKey int,
    orderKey int,
    familyKey int,
    genusKey int,
    speciesKey int,
    acceptedTaxonKey int,
    scientificName string,
    acceptedScientificName string,
    kingdom string,
    phylum string,
    `order` string,
    family string,
    genus string,
    species string,
    genericName string,
    specificEpithet string,
    taxonRank string,
    taxonomicStatus string,
    iucnRedListCategory string,
    decimalLatitude double,
    decimalLongitude double,
    elevation double,
    elevationAccuracy double,
    continent string,
    gadm map<string, struct<gid: string, name: string>>,
    year int,
    month int,
    day int,
    eventDate string,
    startDayOfYear int,
    endDayOfYear int,
    issues array<string>,
    lastInterpreted string,
    license string,
    isSequenced boolean,
    identifiers array<struct<identifier: string>>,
    media array<string>,
    facts array<string>,
    relations array<string>,
    isInCluster boolean,
    datasetID string,
    recordedBy string,
    identifiedBy string,
    geodeticDatum string,
    class string,
    countryCode string,
    recordedByIDs array<string>,
    identifiedByIDs array<string>,
    gbifRegion string,
    country string,
    publishedByGbifRegion string,
    identifier string,
    eventID string,
    `http://unknown.org/language` string,
    footprintWKT string,
    originalNameUsage string,
    municipality string,
    county string,
    identificationVerificationStatus string,
    nameAccordingTo string,
    gbifID string,
    occurrenceID string,
    taxonID string
"""

IDIGBIO_RECORD = """
    `dwc:startDayOfYear` string,
    `dc:language` string,
    `dwc:specificEpithet` string,
    `dwc:countryCode` string,
    `dwc:latestPeriodOrHighestSystem` string,
    `dc:type` string,
    `dwc:recordedBy` string,
    `dwc:informationWithheld` string,
    `dwc:georeferencedDate` string,
    `dwc:order` string,
    `dwc:earliestEonOrLowestEonothem` string,
    `dwc:individualCount` string,
    `dwc:latestEonOrHighestEonothem` string,
    `dwc:group` string,
    `dwc:dataGeneralizations` string,
    `dwc:earliestEpochOrLowestSeries` string,
    `dwc:latestAgeOrHighestStage` string,
    id string,
    `dwc:stateProvince` string,
    `dcterms:bibliographicCitation` string,
    `dwc:eventDate` string,
    `dwc:bed` string,
    `dwc:institutionCode` string,
    `dwc:country` string,
    `dwc:earliestPeriodOrLowestSystem` string,
    `dwc:collectionCode` string,
    `dwc:occurrenceStatus` string,
    `dwc:kingdom` string,
    `dwc:decimalLatitude` string,
    `dwc:georeferenceVerificationStatus` string,
    `dwc:basisOfRecord` string,
    `dwc:genus` string,
    `dwc:continent` string,
    `dwc:family` string,
    `dwc:latestEpochOrHighestSeries` string,
    `dwc:georeferenceSources` string,
    `dwc:higherClassification` string,
    `dwc:previousIdentifications` string,
    `dcterms:license` string,
    `dwc:phylum` string,
    `dwc:county` string,
    `dwc:locality` string,
    `dwc:geodeticDatum` string,
    `dwc:taxonRank` string,
    `dwc:formation` string,
    `dwc:class` string,
    `dwc:catalogNumber` string,
    `dwc:nomenclaturalCode` string,
    `dwc:higherGeography` string,
    `dwc:month` string,
    `dwc:member` string,
    `dwc:coordinateUncertaintyInMeters` string,
    `dwc:scientificNameAuthorship` string,
    `dwc:endDayOfYear` string,
    `dwc:earliestAgeOrLowestStage` string,
    `dwc:verbatimLocality` string,
    `dwc:verbatimEventDate` string,
    `dwc:decimalLongitude` string,
    `dwc:latestEraOrHighestErathem` string,
    `dwc:earliestEraOrLowestErathem` string,
    `dwc:occurrenceID` string,
    `dwc:georeferenceProtocol` string,
    `dcterms:modified` string,
    `dwc:scientificName` string,
    `dwc:day` string,
    `dwc:year` string
"""

OBIS_RECORD = """
    basisOfRecord string,
    bibliographicCitation string,
    catalogNumber string,
    class string,
    collectionCode string,
    coordinateUncertaintyInMeters string,
    country string,
    decimalLatitude double,
    decimalLongitude double,
    eventDate string,
    eventID string,
    family string,
    footprintWKT string,
    identificationReferences string,
    identificationRemarks string,
    institutionCode string,
    kingdom string,
    locality string,
    materialSampleID string,
    maximumDepthInMeters int,
    minimumDepthInMeters int,
    modified string,
    occurrenceID string,
    occurrenceStatus string,
    `order` string,
    organismQuantity string,
    organismQuantityType string,
    phylum string,
    recordedBy string,
    sampleSizeUnit string,
    sampleSizeValue string,
    samplingProtocol string,
    scientificName string,
    scientificNameID string,
    taxonRank string,
    id string,
    dataset_id string,
    node_id array<string>,
    depth int,
    date_start string,
    date_mid string,
    date_end string,
    date_year int,
    dropped boolean,
    absence boolean,
    superdomain string,
    superdomainid int,
    kingdomid int,
    phylumid int,
    classid int,
    orderid int,
    familyid int,
    aphiaID int,
    originalScientificName string,
    flags array<string>,
    bathymetry int,
    shoredistance int,
    sst double,
    sss double
"""

# The result document of one source.
RESULT_DOCUMENT = """
    kingdom array<struct<kingdom: string, count: bigint>>,
    species bigint,
    source_count bigint,
    source_name string
"""

# Where each source keeps the two core columns.
CORE_FIELDS = {
    "gbif": {"kingdom": "kingdom", "scientificName": "scientificName"},
    "idigbio": {"kingdom": "dwc:kingdom", "scientificName": "dwc:scientificName"},
    "obis": {"kingdom": "kingdom", "scientificName": "scientificName"},
}

MESSAGE = """
    key string,
    value binary,
    topic string,
    partition int,
    offset bigint,
    timestamp timestamp
"""

_RECORDS = {"gbif": GBIF_RECORD, "idigbio": IDIGBIO_RECORD, "obis": OBIS_RECORD}
SOURCES = tuple(_RECORDS)


def schema_for(source: str, fields: Iterable[str] | None = None) -> str | StructType:
    """Schema of a source's records, or of some of their fields.

    The JSON parser skips what the schema does not name, so naming few fields is much cheaper and
    changes none of them. An unknown source or field fails when the query is built.
    """
    check_source(source)
    if fields is None:
        return _RECORDS[source]
    record = StructType.fromDDL(_RECORDS[source])
    unknown = set(fields := list(fields)).difference(record.names)
    if unknown:
        raise ValueError(f"records of {source} have no field {', '.join(sorted(unknown))}")
    return StructType([record[name] for name in fields])


def core_schema_for(source: str) -> StructType:
    check_source(source)
    return schema_for(source, CORE_FIELDS[source].values())


def check_source(source: str) -> None:
    if source not in _RECORDS:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
