"""SQL over the driver's tables, read straight from their columns without any JSON."""

from fieldtally.schemas import schema_for

# Fixed values, the same as in ``mirror.observations``.
OBSERVATIONS = """
    SELECT CASE user_id % 3 WHEN 0 THEN 'gbif' WHEN 1 THEN 'idigbio' ELSE 'obis' END AS topic,
           CASE event_type WHEN 'view' THEN 'Animalia' WHEN 'click' THEN 'animalia'
                WHEN 'purchase' THEN 'PLANTAE' WHEN 'signup' THEN 'Fungi' END AS kingdom,
           CASE WHEN event_id % 10 <> 0 THEN 'sp' || user_id END AS scientific_name,
           date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_number,
           event_id, ts, user_id, event_type, value, props
    FROM events
"""

KINGDOM_COUNTS = f"""
    SELECT topic, kingdom, count(*) AS count
    FROM ({OBSERVATIONS}) GROUP BY topic, kingdom
"""

KINGDOM_EXACT = f"""
    SELECT topic, kingdom, count(*) AS count, count(DISTINCT scientific_name) AS distinct_names
    FROM ({OBSERVATIONS}) GROUP BY topic, kingdom
"""

CATEGORY_COLUMNS = """
    upper(topic) AS source,
    count(*) FILTER (WHERE lower(kingdom) = 'animalia') AS animal_records,
    count(*) FILTER (WHERE lower(kingdom) = 'plantae') AS plant_records,
    count(*) FILTER (WHERE lower(kingdom) = 'fungi') AS fungi_records,
    count(*) AS total_records
"""

CATEGORY_REPORT = f"SELECT {CATEGORY_COLUMNS}, true AS species_within_bound FROM ({OBSERVATIONS}) GROUP BY topic"

# The days of each topic before its first damaged document.
READABLE_DAYS = f"""
    SELECT * FROM ({OBSERVATIONS}) o
    WHERE day_number < coalesce(
        (SELECT min(day_number) FROM ({OBSERVATIONS}) b WHERE b.topic = o.topic
         AND day(b.ts) = CASE o.topic WHEN 'gbif' THEN 24 WHEN 'idigbio' THEN 27 ELSE 20 END), 1000000)
"""

LAST_DAY = f"""
    SELECT * FROM ({OBSERVATIONS}) o
    WHERE day_number = (SELECT max(day_number) FROM ({OBSERVATIONS}) l WHERE l.topic = o.topic)
"""

DOCUMENT_LINES = """
    SELECT doc_id, lang, n_chars, string_split(text, chr(10)) AS lines FROM documents
"""

PAGE_RECORDS = f"""
    SELECT doc_id || '-' || (n - 1) AS line_id, kingdom, scientific_name
    FROM (SELECT doc_id, lang AS kingdom, unnest(lines) AS scientific_name,
                 generate_subscripts(lines, 1) AS n
          FROM ({DOCUMENT_LINES}))
"""

COUNT_BY_SOURCE = """
    SELECT 'http://' || upper(topic) || '.org' AS source, count(*) AS count
"""

SOURCE_NAME = (
    "split_part(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '.', 1)"
)

def filled_fields(source: str) -> str:
    """One row per field of a source: the same values as in ``mirror.filled_value``, added up."""

    def text(letter: str, place: int) -> str:
        return f"('{letter}{place}-' || event_id)"

    def digest(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"

    rows = []
    for place, line in enumerate(schema_for(source).strip().splitlines()):
        name, kind = line.strip().rstrip(",").split(" ", 1)
        number = f"(event_id + {place})"
        value = {
            "string": lambda: digest(text("s", place)),
            "int": lambda: f"{number} % 1000000",
            "double": lambda: number,
            "boolean": lambda: f"CAST({number} % 2 = 0 AS BIGINT)",
            "array<string>": lambda: digest(f"{text('a', place)} || ',' || {text('b', place)}"),
            "array<struct<identifier:string>>": lambda: digest(text("i", place)),
            "map<string,string>": lambda: digest(text("m", place)),
            "map<string,struct<gid:string,name:string>>": lambda: digest(
                f"{text('g', place)} || ',' || {text('n', place)}"
            ),
        }[kind.replace(" ", "")]()
        name = name.strip("`")
        rows.append(
            f"SELECT '{name}' AS field, count(*) AS filled, CAST(sum({value}) AS BIGINT) AS total FROM events"
        )
    return " UNION ALL ".join(rows)


ORACLE_SQL = {
    "all_fields_gbif": filled_fields("gbif"),
    "all_fields_idigbio": filled_fields("idigbio"),
    "all_fields_obis": filled_fields("obis"),
    "count_by_kingdom_followed": f"""
        SELECT coalesce(kingdom, 'Title Unavailable') AS kingdom, count(*) AS count
        FROM ({LAST_DAY}) GROUP BY 1
    """,
    "count_by_kingdom_in_parts": """
        SELECT coalesce(c_name, 'Title Unavailable') AS kingdom, count(*) AS count FROM customer GROUP BY 1
    """,
    "parse_core": f"""
        SELECT topic, kingdom, scientific_name AS "scientificName" FROM ({OBSERVATIONS})
    """,
    "parse_malformed": f"""
        SELECT topic, CASE WHEN event_id % 7 >= 5 THEN kingdom END AS kingdom, count(*) AS count
        FROM ({OBSERVATIONS}) GROUP BY 1, 2
    """,
    "parse_props": """
        SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS count
        FROM events GROUP BY 1
    """,
    "parse_full_gbif": f"""
        SELECT TRY_CAST(event_id AS INTEGER) AS key,
               TRY_CAST(CASE WHEN event_type <> 'purchase' THEN user_id END AS INTEGER)
                   AS taxon_key,
               CAST(NULL AS INTEGER) AS crawl_id,
               replace(props, ' ', '') AS props,
               value AS latitude,
               event_type AS place,
               CAST(year(ts) AS INTEGER) AS year,
               CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day,
               topic AS second_issue,
               event_type = 'view' AS is_sequenced,
               event_type AS first_identifier,
               event_type AS language,
               kingdom, scientific_name
        FROM ({OBSERVATIONS})
    """,
    "parse_full_idigbio": f"""
        SELECT CAST(event_id AS VARCHAR) AS id,
               CAST(event_type = 'view' AS VARCHAR) AS is_view,
               CAST(user_id AS VARCHAR) AS individual_count,
               replace(props, ' ', '') AS classification,
               kingdom, scientific_name
        FROM ({OBSERVATIONS})
    """,
    "parse_full_obis": f"""
        SELECT CAST(event_id AS VARCHAR) AS id,
               value AS sst,
               TRY_CAST(user_id AS INTEGER) AS aphia_id,
               CAST(NULL AS INTEGER) AS depth,
               event_type = 'error' AS dropped,
               event_type AS first_node,
               kingdom, scientific_name
        FROM ({OBSERVATIONS})
    """,
    "union_sources": KINGDOM_COUNTS,
    "unnest_results_pages": PAGE_RECORDS,
    "unnest_items_pages": PAGE_RECORDS,
    "unnest_cursor_pages": PAGE_RECORDS,
    "page_status_results": f"""
        SELECT doc_id, CAST(len(lines) AS INTEGER) AS record_count, n_chars < 1000 AS last_page,
               CAST(NULL AS VARCHAR) AS next_cursor
        FROM ({DOCUMENT_LINES})
    """,
    "page_status_items": f"""
        SELECT doc_id, CAST(len(lines) AS INTEGER) AS record_count, len(lines) <= 8 AS last_page,
               CAST(NULL AS VARCHAR) AS next_cursor
        FROM ({DOCUMENT_LINES})
    """,
    "page_status_cursor": f"""
        SELECT doc_id, CAST(len(lines) AS INTEGER) AS record_count, len(lines) = 0 AS last_page,
               doc_id || '-' || (len(lines) - 1) AS next_cursor
        FROM ({DOCUMENT_LINES})
    """,
    "rejected_pages": f"""
        SELECT source, doc_id, doc_id % 12 < 10 AS rejected,
               CASE WHEN doc_id % 12 >= 10 THEN CAST(len(lines) AS INTEGER) END AS record_count
        FROM ({DOCUMENT_LINES})
        CROSS JOIN (VALUES ('gbif'), ('idigbio'), ('obis')) AS sources(source)
    """,
    "encode_messages": f"""
        SELECT 'gbif' AS topic,
               '{{"event_id":' || event_id
                   || ',"kingdom":' || coalesce('"' || kingdom || '"', 'null')
                   || ',"scientificName":' || coalesce('"' || scientific_name || '"', 'null')
                   || '}}' AS value,
               36 AS key_length
        FROM ({OBSERVATIONS})
    """,
    "text_round_trip": """
        SELECT doc_id, lang, md5(text) AS digest, CAST(length(text) AS INTEGER) AS chars
        FROM documents
    """,
    "kingdom_counts": KINGDOM_COUNTS,
    "kingdom_exact": KINGDOM_EXACT,
    "category_report": CATEGORY_REPORT,
    "species_bound": f"""
        SELECT upper(topic) AS source, count(*) AS total_records, true AS within_bound
        FROM ({OBSERVATIONS}) GROUP BY topic
    """,
    "lineitem_kingdom_counts": """
        SELECT l_returnflag AS topic, l_linestatus AS kingdom, count(*) AS count
        FROM lineitem GROUP BY 1, 2
    """,
    "lineitem_kingdom_exact": """
        SELECT l_returnflag AS topic, l_linestatus AS kingdom, count(*) AS count,
               count(DISTINCT l_partkey) AS distinct_names
        FROM lineitem GROUP BY 1, 2
    """,
    "part_kingdom_exact": """
        SELECT p_brand AS topic, p_type AS kingdom, count(*) AS count,
               count(DISTINCT p_name) AS distinct_names
        FROM part GROUP BY 1, 2
    """,
    "document_counts": """
        SELECT source AS topic, lang AS kingdom, count(*) AS count FROM documents GROUP BY 1, 2
    """,
    "read_results": f"""
        SELECT topic || '_query' AS topic, day_number AS "offset",
               CAST(count(DISTINCT coalesce(kingdom, '-')) AS INTEGER) AS kingdoms,
               count(DISTINCT scientific_name) AS species,
               count(*) AS source_count,
               upper(topic) AS source_name
        FROM ({READABLE_DAYS}) r GROUP BY r.topic, day_number
    """,
    "latest_results": f"""
        SELECT topic || '_query' AS topic, day_number AS "offset", kingdom, count(*) AS count
        FROM ({READABLE_DAYS}) r
        WHERE day_number = (SELECT max(day_number) FROM ({READABLE_DAYS}) l WHERE l.topic = r.topic)
        GROUP BY r.topic, day_number, kingdom
    """,
    "count_by_kingdom": f"""
        SELECT coalesce(kingdom, 'Title Unavailable') AS kingdom, count(*) AS count
        FROM ({LAST_DAY}) GROUP BY 1
    """,
    "count_by_species": f"""
        SELECT count(DISTINCT topic || ' ' || scientific_name) AS species FROM ({LAST_DAY})
    """,
    "count_by_source": f"{COUNT_BY_SOURCE} FROM ({LAST_DAY}) GROUP BY topic",
    "count_by_source_active": f"""
        {COUNT_BY_SOURCE} FROM ({LAST_DAY}) WHERE topic <> 'idigbio' GROUP BY topic
    """,
    "source_names": f"SELECT page_id, {SOURCE_NAME} AS name FROM pages",
    "list_sources": f"""
        SELECT 'http://' || {SOURCE_NAME} || '.org' AS source
        FROM pages GROUP BY {SOURCE_NAME} HAVING bool_or(contains(url, 'utm_source=feed'))
    """,
    "stream_kingdom_counts": KINGDOM_COUNTS,
    "stream_category_report": CATEGORY_REPORT,
    "stream_triggered": CATEGORY_REPORT,
    "stream_kingdom_exact": KINGDOM_EXACT,
    "stream_snapshots": f"""
        SELECT {CATEGORY_COLUMNS}, CAST(number AS BIGINT) AS epoch_id,
               true AS species_within_bound
        FROM ({OBSERVATIONS}) CROSS JOIN range(4) AS weeks(number)
        WHERE least(3, floor((day(ts) - 1) / 7)) <= number
        GROUP BY topic, number
    """,
    "concurrent_queries": f"""
        SELECT upper(topic) AS source, count(*) AS kingdom_total, count(*) AS report_total
        FROM ({OBSERVATIONS}) GROUP BY topic
    """,
    "live_counts": f"""
        SELECT topic || '_query' AS topic, upper(topic) AS source_name,
               CAST(sum(count) OVER (PARTITION BY topic) AS BIGINT) AS source_count, kingdom, count,
               true AS species_within_bound
        FROM ({KINGDOM_COUNTS})
    """,
    "stream_produce": f"""
        SELECT 'obis' AS topic, kingdom, count(*) AS count,
               count(DISTINCT scientific_name) AS distinct_names
        FROM ({PAGE_RECORDS}) GROUP BY kingdom
    """,
    "add_source": f"{COUNT_BY_SOURCE} FROM ({OBSERVATIONS}) GROUP BY topic",
    "replayed_messages": f"""
        SELECT 'gbif' AS topic, kingdom, count(*) AS count,
               count(DISTINCT scientific_name) AS distinct_names
        FROM ({PAGE_RECORDS}) GROUP BY kingdom
    """,
}
