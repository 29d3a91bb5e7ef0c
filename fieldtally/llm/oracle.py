"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP1 = """
WITH RECURSIVE counts AS (
    SELECT coalesce(source, '') AS source_key, count(*) AS n FROM documents GROUP BY 1
), weights AS (
    SELECT source_key, n, pow(n::DOUBLE, 0.5) AS weight FROM counts
), rates AS (
    SELECT source_key, (SELECT sum(n) FROM weights)::DOUBLE * weight / (SELECT sum(weight) FROM weights) / n AS rate
    FROM weights
), quantiles AS (
    SELECT source_key, rate, 0 AS k, -rate AS log_p, exp(-rate) AS cdf FROM rates
    UNION ALL
    SELECT source_key, rate, k + 1, log_p + ln(rate) - ln((k + 1)::DOUBLE),
           cdf + exp(log_p + ln(rate) - ln((k + 1)::DOUBLE))
    FROM quantiles WHERE k < ceil(rate + 12 * sqrt(rate) + 40)
), drawn AS (
    SELECT *, ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents
), counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS copies
    FROM drawn d JOIN quantiles q ON coalesce(d.source, '') = q.source_key AND q.cdf <= d.u
    GROUP BY ALL
), repeated AS (
    SELECT * EXCLUDE (copies), unnest(range(copies))::INTEGER AS copy FROM counted
)
SELECT *, ('0x' || substr(md5('mix|order|' || coalesce(doc_id::VARCHAR, '') || '|' || copy), 1, 13))::BIGINT AS shuffle_key
FROM repeated
"""

OP3 = """
WITH RECURSIVE vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, label, embedding::DOUBLE[] AS x,
           label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
           AND len(list_filter(embedding, lambda v: v <> 0)) > 0 AS usable
    FROM embeddings
), links AS MATERIALIZED (
    SELECT a.row AS u, b.row AS v
    FROM vectors a JOIN vectors b ON a.label = b.label AND a.row <> b.row AND a.usable AND b.usable
    WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach AS (
    SELECT row AS node, row AS other FROM vectors
    UNION
    SELECT r.node, l.v FROM reach r JOIN links l ON r.other = l.u
), components AS (
    SELECT node, min(vec_id) AS component_id FROM reach JOIN vectors ON other = row GROUP BY node
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.u = e.row) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM vectors e JOIN components c ON c.node = e.row
"""

OP7 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda v: floor(64 * v::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP8 = r"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, coalesce(k.doc_id <> r.last_doc, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP11 = f"""
WITH split AS (
    SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
    SELECT doc_id, start, array_to_string(w[start + 1 : start + 20], ' ') AS content
    FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS start FROM split WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, start FROM (
        SELECT doc_id, start, row_number() OVER (PARTITION BY content ORDER BY doc_id, start) AS place FROM windows
    ) WHERE place > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM later
), placed AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM split
), kept AS (
    SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT s.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    fields = [_field(f) for f in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


# Children are told from their parents by place: nodes 3 i to 3 i + 2 of a level are under node i of the next.
OP12 = f"""
WITH RECURSIVE crcs AS (
    WITH RECURSIVE bits AS (
        SELECT doc_id, encode(doc_id::VARCHAR) AS data, 4294967295::UBIGINT AS crc, 0 AS byte, 8 AS bit FROM documents
        UNION ALL
        SELECT doc_id, data,
               CASE WHEN bit = 8 THEN xor(crc, ('0x' || substr(hex(data), 2 * byte + 1, 2))::UBIGINT)
                    WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::UBIGINT) ELSE crc >> 1 END,
               CASE WHEN bit = 7 THEN byte + 1 ELSE byte END, CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
        FROM bits WHERE byte < octet_length(data)
    )
    SELECT doc_id, xor(crc, 4294967295::UBIGINT) AS crc FROM bits WHERE byte = octet_length(data)
), leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
           {_leaf("lost")} AS found
    FROM (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS lost
          FROM documents JOIN crcs USING (doc_id))
), start AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place,
           count(*) OVER (PARTITION BY tree) AS size
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, place, size, leaf AS node FROM start
    UNION ALL
    SELECT tree, level + 1, place // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY tree, level, place // 3, size
), subroots AS (
    SELECT tree, level, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size
    FROM nodes WHERE size = 1
), tops AS (
    SELECT 0 AS level, place, size, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY place))
    FROM tops WHERE size > 1 GROUP BY level, place // 3, size
), levels AS (
    SELECT n.tree, n.level, n.place, n.node FROM nodes n WHERE size > 1
    UNION ALL
    SELECT s.tree, s.level + t.level, t.place, t.node FROM subroots s CROSS JOIN tops t WHERE t.size > 1
), own AS (
    SELECT st.doc_id, st.leaf, st.found, st.tree, s.subroot, s.level AS height, s.place AS source_place,
           st.place, unnest(range(s.level + (SELECT max(level) FROM tops))) AS level
    FROM start st JOIN subroots s ON st.tree = s.tree
), ways AS (
    SELECT doc_id, tree, level,
           CASE WHEN level < height THEN place // pow(3, level)::BIGINT
                ELSE source_place // pow(3, level - height)::BIGINT END AS at
    FROM own
), siblings AS (
    SELECT w.doc_id, w.level,
           coalesce(string_agg(l.node, '' ORDER BY l.place) FILTER (WHERE l.place < w.at), '') AS before,
           coalesce(string_agg(l.node, '' ORDER BY l.place) FILTER (WHERE l.place > w.at), '') AS behind
    FROM ways w JOIN levels l ON w.tree = l.tree AND w.level = l.level AND w.at // 3 = l.place // 3
    GROUP BY w.doc_id, w.level
), folds AS (
    SELECT doc_id, 0 AS level, found AS node FROM leaves
    UNION ALL
    SELECT f.doc_id, f.level + 1, sha256(s.before || f.node || s.behind)
    FROM folds f JOIN siblings s ON f.doc_id = s.doc_id AND f.level = s.level
), folded AS (
    SELECT doc_id, max_by(node, level) AS folded_root FROM folds GROUP BY doc_id
), proofs AS (
    SELECT doc_id, sha256(string_agg(before || behind, '' ORDER BY level)) AS proof_sha256 FROM siblings GROUP BY doc_id
)
SELECT st.doc_id, st.leaf, s.subroot, (SELECT node FROM tops WHERE size = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = (SELECT node FROM tops WHERE size = 1) AS verified
FROM start st JOIN subroots s ON st.tree = s.tree JOIN folded f ON st.doc_id = f.doc_id
LEFT JOIN proofs p ON st.doc_id = p.doc_id
"""

ORACLE_SQL = {
    "op1_mixing": OP1, "op3_embedding_dedup": OP3, "op7_topk": OP7, "op8_line_dedup": OP8,
    "op11_substring_dedup": OP11, "op12_merkle": OP12,
}
