"""The registered queries as plain SQL for DuckDB, written independently of the operators.

Fragments below are lists of common table expressions; a query strings together
those it needs.  Where an operator has a short cut, the SQL takes the long way:
cosines are averaged over explicit pairs, spanning trees come from minimax paths,
and clusters from the definition of a leaf.
"""

from __future__ import annotations

from searchloom import constants as C
from searchloom.config import ClusterConfig
from searchloom.operators.language import BUCKETS
from searchloom.plans.registry import SAMPLE_CLUSTERS

SPACE = (
    r"[\t\n\x{000B}\f\r\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
DIM = 256

DOC_LOG = """log AS (
  SELECT doc_id AS query_id, text AS query, lang AS topic, source AS user_id FROM documents)"""
DOC_LOG_MULTI = """log AS (
  SELECT doc_id AS query_id, text AS query, lang || ',' || source AS topic, source AS user_id
  FROM documents)"""
CONV_LOG = """log AS (
  SELECT conv_id * 1000 + turn AS query_id, text AS query,
         CASE WHEN conv_id % 5 = 0 THEN NULL WHEN conv_id % 5 = 1 THEN ''
              ELSE 't' || (conv_id % 3) END AS topic,
         CAST(conv_id AS VARCHAR) AS user_id
  FROM conversations WHERE role = 'user')"""


def clean(text: str) -> str:
    return f"lower(trim(regexp_replace({text}, '{SPACE}+', ' ', 'g')))"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def blank(text: str) -> str:
    return f"regexp_full_match({text}, '{SPACE}*')"


def topic_list(topic: str) -> str:
    return (
        f"CASE WHEN {topic} IS NULL OR {topic} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE list_transform(string_split({topic}, ','), lambda t: {strip('t')}) END"
    )


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def reasons(min_length: int = 30, topics: bool = True, languages: bool = False) -> str:
    steps = []
    if min_length > 0:
        steps.append(f"WHEN query IS NULL OR length(query) < {min_length} THEN 'length'")
    steps.append(f"WHEN {blank('query')} THEN 'blank'")
    steps.append("WHEN query IS NULL OR NOT regexp_matches(query, '[A-Za-z0-9]') THEN 'no_alnum'")
    if languages:
        steps.append("WHEN query_id NOT IN (SELECT id FROM best WHERE lang = 'en') THEN 'language'")
    if topics:
        steps.append("WHEN topic IS NULL OR topic = '' THEN 'topics'")
    return f"""reasons AS (
  SELECT *, {clean('query')} AS q, CASE {' '.join(steps)} END AS drop_reason FROM log)"""


KEPT = f"""kept AS (
  SELECT query_id, q AS query, user_id AS usr, {topic_list('topic')} AS topics
  FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY query_id) AS n
        FROM reasons WHERE drop_reason IS NULL)
  WHERE n = 1)"""
KEPT_ROWS = """SELECT query_id, query, usr AS "user", array_to_string(topics, '|') AS topics
FROM kept"""

AUDIT = """SELECT count(*) AS original,
  count(*) FILTER (drop_reason = 'length') AS removed_length,
  count(*) FILTER (drop_reason = 'blank') AS removed_blank,
  count(*) FILTER (drop_reason = 'no_alnum') AS removed_no_alnum,
  count(*) FILTER (drop_reason = 'language') AS removed_language,
  count(*) FILTER (drop_reason = 'topics') AS removed_topics,
  count(*) FILTER (drop_reason IS NULL)
    - count(DISTINCT CASE WHEN drop_reason IS NULL THEN q END) AS removed_duplicates,
  count(DISTINCT CASE WHEN drop_reason IS NULL THEN q END) AS final,
  round(count(DISTINCT CASE WHEN drop_reason IS NULL THEN q END) / count(*), 6) AS retention
FROM reasons"""

# Naive Bayes over character trigrams, trained on and applied to all documents.
LANGUAGES = f"""codes AS (
  SELECT doc_id AS id, lang AS known, unnest(codes) AS c, generate_subscripts(codes, 1) AS p
  FROM (SELECT doc_id, lang,
               list_transform(string_split({clean('text')}, ''), lambda x: unicode(x)) AS codes
        FROM documents)),
grams AS (
  SELECT id, known, (c * 961 + c1 * 31 + c2) % {BUCKETS} AS bucket
  FROM (SELECT *, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2 FROM codes
        WINDOW w AS (PARTITION BY id ORDER BY p))
  WHERE c2 IS NOT NULL),
totals AS (SELECT known AS lang, bucket, count(*) AS n FROM grams GROUP BY ALL),
langs AS (SELECT lang, count(*) / (SELECT count(*) FROM documents) AS share
          FROM documents GROUP BY lang),
model AS (
  SELECT l.lang, b.bucket,
         ln((coalesce(t.n, 0) + 1) / (sum(coalesce(t.n, 0)) OVER (PARTITION BY l.lang) + {BUCKETS}))
           AS loglik
  FROM langs l CROSS JOIN (SELECT unnest(range({BUCKETS})) AS bucket) b
  LEFT JOIN totals t ON t.lang = l.lang AND t.bucket = b.bucket),
scores AS (
  SELECT g.id, m.lang, sum(g.n * m.loglik) + any_value(ln(l.share)) AS score
  FROM (SELECT id, bucket, count(*) AS n FROM grams GROUP BY ALL) g
  JOIN model m USING (bucket) JOIN langs l ON l.lang = m.lang GROUP BY g.id, m.lang),
best AS (
  SELECT d.doc_id AS id, coalesce(s.lang, 'unknown') AS lang
  FROM documents d LEFT JOIN (
    SELECT id, lang FROM scores QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) = 1
  ) s ON s.id = d.doc_id)"""

# Hashed TF-IDF of the kept queries, long and dense.
TFIDF = f"""words AS (
  SELECT query_id, unnest(regexp_extract_all(query, '[\\p{{L}}\\p{{N}}]+')) AS word FROM kept),
tf AS (
  SELECT query_id, CAST(('0x' || substr(md5(word), 1, 7)) AS BIGINT) % {DIM} AS bucket,
         count(*) AS n
  FROM words GROUP BY ALL),
idf AS (
  SELECT bucket, ln(((SELECT count(*) FROM kept) + 1) / (count(*) + 1)) AS idf
  FROM tf GROUP BY bucket),
raw_weights AS (SELECT query_id, bucket, n * idf AS w FROM tf JOIN idf USING (bucket)),
lengths AS (
  SELECT query_id, sqrt(sum(w * w ORDER BY bucket)) AS len FROM raw_weights GROUP BY query_id),
weights AS (
  SELECT query_id, bucket, CASE WHEN len > 0 THEN w / len ELSE 0 END AS weight
  FROM raw_weights JOIN lengths USING (query_id))"""
DENSE = f"""vectors AS (
  SELECT k.query_id, list(coalesce(w.weight, 0.0) ORDER BY b.bucket) AS vec
  FROM kept k CROSS JOIN (SELECT unnest(range({DIM})) AS bucket) b
  LEFT JOIN weights w ON w.query_id = k.query_id AND w.bucket = b.bucket
  GROUP BY k.query_id)"""

VEC_POINTS = """points AS (
  SELECT 't' || label AS topic, vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vec
  FROM embeddings)"""


def moved_points(coordinate: str) -> str:
    """The points with every coordinate ``x`` replaced."""
    return f"""points AS (
  SELECT 't' || label AS topic, vec_id AS query_id,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: {coordinate}) AS vec
  FROM embeddings)"""


def density(config: ClusterConfig = ClusterConfig(), doublings: int = 7) -> str:
    """Labels of ``points``; ``doublings`` must cover the longest path in a topic's tree."""
    # Points get small numbers, unique over all topics, to keep the paths compact.
    steps = ["""places_of AS MATERIALIZED (
  SELECT topic, query_id, CAST(row_number() OVER (ORDER BY topic, query_id) AS INTEGER) AS i
  FROM points),
hops AS (
  SELECT p.i AS x, q.i AS y, CAST(r AS INTEGER) AS r
  FROM edges e JOIN places_of p ON p.topic = e.topic AND p.query_id = e.a
  JOIN places_of q ON q.topic = e.topic AND q.query_id = e.b),
path0 AS MATERIALIZED (
  SELECT x, y, r FROM hops UNION ALL SELECT y, x, r FROM hops
  UNION ALL SELECT i, i, 0 FROM places_of)"""]
    for k in range(doublings):
        steps.append(
            f"""path{k + 1} AS MATERIALIZED (
  SELECT p.x, q.y, min(greatest(p.r, q.r)) AS r
  FROM path{k} p JOIN path{k} q ON p.y = q.x GROUP BY p.x, q.y)"""
        )
    steps.append(
        f"""paths AS MATERIALIZED (
  SELECT p.topic, p.query_id AS x, q.query_id AS y, r
  FROM path{doublings} JOIN places_of p ON p.i = x JOIN places_of q ON q.i = y)"""
    )
    path = "paths"
    return f"""gaps AS MATERIALIZED (
  SELECT topic, p.query_id AS a, q.query_id AS b,
         list_distance(p.vec, q.vec) AS d
  FROM points p JOIN points q USING (topic) WHERE p.query_id < q.query_id),
near AS (
  SELECT topic, x, d, row_number() OVER (PARTITION BY topic, x ORDER BY d) AS n,
         count(*) OVER (PARTITION BY topic, x) AS others
  FROM (SELECT topic, a AS x, d FROM gaps UNION ALL SELECT topic, b, d FROM gaps)),
core AS (SELECT topic, x, d AS c FROM near WHERE n = least({config.min_samples}, others)),
edges AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY w, d, a, b) AS r
  FROM (SELECT g.topic, a, b, d, greatest(ca.c, cb.c, d) AS w
        FROM gaps g JOIN core ca ON ca.topic = g.topic AND ca.x = g.a
        JOIN core cb ON cb.topic = g.topic AND cb.x = g.b)),
{', '.join(steps)},
tree AS (
  SELECT e.* FROM edges e JOIN {path} p
  ON p.topic = e.topic AND p.x = e.a AND p.y = e.b AND p.r = e.r),
reach AS (
  SELECT topic, x, r FROM (
    SELECT topic, x, r, row_number() OVER (PARTITION BY topic, x ORDER BY r) AS n
    FROM {path} WHERE x <> y) WHERE n = {config.min_cluster_size - 1}),
all_splits AS (
  SELECT t.*, t.w >= {config.cluster_selection_epsilon} AS wide
  FROM tree t JOIN reach ra ON ra.topic = t.topic AND ra.x = t.a AND ra.r < t.r
  JOIN reach rb ON rb.topic = t.topic AND rb.x = t.b AND rb.r < t.r),
splits AS (
  SELECT * FROM (SELECT *, bool_or(wide) OVER (PARTITION BY topic) AS any_wide,
                        max(r) OVER (PARTITION BY topic) AS last FROM all_splits)
  WHERE CASE WHEN any_wide THEN wide ELSE r = last END),
sides AS (SELECT topic, r, a AS seed FROM splits UNION ALL SELECT topic, r, b FROM splits),
side_members AS (
  SELECT s.topic, s.r, s.seed, p.y AS member FROM sides s
  JOIN {path} p ON p.topic = s.topic AND p.x = s.seed AND p.r < s.r),
leaf_sides AS (
  SELECT topic, seed, r, min(member) AS first FROM side_members m
  GROUP BY ALL HAVING NOT bool_or(EXISTS (
    SELECT 1 FROM splits f WHERE f.topic = m.topic AND f.r < m.r AND f.a = m.member))),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY first) - 1 AS label FROM leaf_sides),
labels AS MATERIALIZED (
  SELECT p.topic, p.query_id, CAST(coalesce(n.label, -1) AS INTEGER) AS label
  FROM points p LEFT JOIN (
    SELECT m.topic, m.member, n.label FROM side_members m JOIN numbered n
    ON n.topic = m.topic AND n.seed = m.seed AND n.r = m.r) n
  ON n.topic = p.topic AND n.member = p.query_id)"""


# Topic rows of the kept queries.
MENTIONS = """mentions AS MATERIALIZED (
  SELECT query_id, usr, unnest(topics) AS topic, generate_subscripts(topics, 1) - 1 AS pos
  FROM kept),
topics AS (
  SELECT topic, count(*) AS topic_rows, min(query_id) AS first_id,
         arg_min(pos, query_id * 1000 + pos) AS first_pos
  FROM mentions GROUP BY topic)"""


def members(config: ClusterConfig) -> str:
    """Mentions with vector, topic facts and label; needs vectors and labels."""
    return f"""members AS MATERIALIZED (
  SELECT m.*, t.topic_rows, t.first_id, t.first_pos, v.vec,
         CASE WHEN t.topic_rows < {config.min_cluster_size} THEN -1
              ELSE coalesce(l.label, -1) END AS label
  FROM mentions m JOIN topics t USING (topic) JOIN vectors v USING (query_id)
  LEFT JOIN labels l ON l.topic = m.topic AND l.query_id = m.query_id)"""


def measured(config: ClusterConfig) -> str:
    """Capped clusters and what is measured on them; needs members."""
    cap = config.max_cluster_size
    return f"""parts AS (
  SELECT topic, label, query_id, pos, unnest(vec) AS v, generate_subscripts(vec, 1) AS i
  FROM members WHERE label >= 0),
centroids AS (SELECT topic, label, i, avg(v) AS c, count(*) AS n FROM parts GROUP BY ALL),
away AS (
  SELECT topic, label, query_id, pos, any_value(n) AS n, sqrt(sum((v - c) ** 2)) AS d
  FROM parts JOIN centroids USING (topic, label, i) GROUP BY topic, label, query_id, pos),
capped AS MATERIALIZED (
  SELECT * FROM (
    SELECT topic, label, query_id, pos,
           row_number() OVER (PARTITION BY topic, label
             ORDER BY CASE WHEN n > {cap} THEN round(d, 12) ELSE 0 END, query_id, pos) AS rank
    FROM away) WHERE rank <= {cap}),
capped_full AS MATERIALIZED (
  SELECT c.*, m.usr, m.vec, sqrt(list_dot_product(m.vec, m.vec)) AS len
  FROM capped c JOIN members m USING (topic, query_id, pos)),
sizes AS (
  SELECT topic, label, count(*) AS n_queries,
         count(DISTINCT usr) + CAST(bool_or(usr IS NULL) AS BIGINT) AS unique_users
  FROM capped_full GROUP BY topic, label),
cosines AS (
  SELECT p.topic, p.label,
         sum(CASE WHEN p.len * q.len > 0 THEN list_dot_product(p.vec, q.vec) / (p.len * q.len)
                  ELSE 0 END) AS total
  FROM capped_full p JOIN capped_full q
    ON p.topic = q.topic AND p.label = q.label AND p.rank <> q.rank
  GROUP BY ALL),
measured AS (
  SELECT s.*, total / (n_queries * (n_queries - 1)) AS cohesion
  FROM sizes s JOIN cosines USING (topic, label))"""


def judged(config: ClusterConfig) -> str:
    """Central queries, verdicts and reasons; needs measured."""
    return f"""capped_parts AS (
  SELECT topic, label, query_id, rank, unnest(vec) AS v, generate_subscripts(vec, 1) AS i
  FROM capped_full),
middles AS (SELECT topic, label, i, avg(v) AS c FROM capped_parts GROUP BY ALL),
central AS MATERIALIZED (
  SELECT topic, label, query_id, rank, round(sqrt(sum((v - c) ** 2)), 12) AS away
  FROM capped_parts JOIN middles USING (topic, label, i) GROUP BY ALL),
judged AS MATERIALIZED (
  SELECT m.*, topic || '_' || label AS cluster_label, k.query AS most_central_query,
         CASE WHEN cohesion >= {config.min_seo_similarity} THEN 'true' ELSE 'false' END
           AS seo_candidate,
         concat_ws('; ',
           CASE WHEN n_queries < {config.min_cluster_size}
                THEN printf('{C.REASON_SIZE}', n_queries, '{config.min_cluster_size}') END,
           CASE WHEN cohesion < {config.min_cluster_similarity}
                THEN printf('{C.REASON_COHESION}', cohesion, '{config.min_cluster_similarity}') END,
           CASE WHEN unique_users < {config.min_unique_users}
                THEN printf('{C.REASON_USERS}', unique_users, '{config.min_unique_users}') END
         ) AS why
  FROM measured m
  JOIN (SELECT topic, label, query_id FROM central
        QUALIFY row_number() OVER (PARTITION BY topic, label ORDER BY away, rank) = 1) c
    USING (topic, label)
  JOIN kept k USING (query_id))"""


ASSIGNED = """places AS (
  SELECT m.query_id, m.pos, m.first_id, m.first_pos, 0 AS noise, m.label, c.rank,
         CASE WHEN j.why = '' THEN j.cluster_label ELSE m.topic || '_-1' END AS cluster
  FROM members m JOIN capped c USING (topic, query_id, pos)
  JOIN judged j ON j.topic = m.topic AND j.label = m.label
  UNION ALL
  SELECT query_id, pos, first_id, first_pos, 1, label, 0, topic || '_-1'
  FROM members WHERE label = -1),
assigned AS MATERIALIZED (
  SELECT query_id, query, usr, topics, cluster, rank FROM places JOIN kept USING (query_id)
  QUALIFY row_number() OVER (PARTITION BY query, topics
    ORDER BY first_id, first_pos, noise, label, rank, query_id, pos) = 1),
chosen AS MATERIALIZED (
  SELECT a.query_id, a.query, a.cluster, a.rank, c.away,
         count(*) OVER (PARTITION BY cluster) AS cluster_size
  FROM assigned a LEFT JOIN central c
    ON c.query_id = a.query_id AND c.topic || '_' || c.label = a.cluster
  WHERE NOT suffix(a.cluster, '_-1')
  QUALIFY count(*) OVER (PARTITION BY cluster) >= 2)"""

METADATA = """SELECT topic, cluster_label, n_queries, round(cohesion, 4) AS avg_similarity,
  unique_users, most_central_query, seo_candidate"""

# Vectors under given topics and labels, as a stand-in for found ones.
SAMPLE = (
    """kept AS (
  SELECT vec_id AS query_id, 'q' || vec_id AS query, CAST(vec_id % 7 AS VARCHAR) AS usr,
         CASE WHEN vec_id % 125 = 0
              THEN ['w' || (vec_id % 250), 't' || label, 'u' || (vec_id % 3)]
              ELSE ['t' || label, 'u' || (vec_id % 3)] END AS topics
  FROM embeddings),
vectors AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)""",
    MENTIONS,
    """labels AS (
  SELECT topic, query_id,
         query_id % (CASE WHEN prefix(topic, 't') THEN 8 ELSE 11 END) - 1 AS label
  FROM mentions)""",
    members(SAMPLE_CLUSTERS),
    measured(SAMPLE_CLUSTERS),
)
SAMPLE_JUDGED = (*SAMPLE, judged(SAMPLE_CLUSTERS))
SAMPLE_ASSIGNED = (*SAMPLE_JUDGED, ASSIGNED)


def generated(per_cluster: int) -> str:
    return f"""generated AS (
  SELECT cluster, query AS seo_query, CAST(n AS INTEGER) AS query_number, cluster_size
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY away, rank, query_id) AS n
        FROM chosen) WHERE n <= {per_cluster})"""


GENERATED_ROWS = "SELECT cluster, seo_query, query_number, cluster_size FROM generated"


def whole_run(
    log: str, languages: bool, config: ClusterConfig, doublings: int, topics: bool = True
) -> tuple[str, ...]:
    """All stages from the log to one cluster per query."""
    return (
        log,
        *([LANGUAGES] if languages else []),
        reasons(topics=topics, languages=languages),
        KEPT.replace("kept AS (", "kept AS MATERIALIZED (", 1),
        TFIDF,
        DENSE.replace("vectors AS (", "vectors AS MATERIALIZED (", 1),
        MENTIONS,
        f"""points AS (
  SELECT DISTINCT m.topic, m.query_id, v.vec FROM mentions m JOIN topics t USING (topic)
  JOIN vectors v USING (query_id) WHERE t.topic_rows >= {config.min_cluster_size})""",
        density(config, doublings),
        members(config),
        measured(config),
        judged(config),
        ASSIGNED,
    )


STATISTICS = """SELECT (SELECT count(*) FROM kept) AS total_queries,
  (SELECT count(*) FROM judged WHERE why = '') AS valid_clusters,
  (SELECT count(*) FROM judged WHERE why = '' AND seo_candidate = 'true') AS seo_candidates,
  (SELECT count(*) FROM generated) AS total_seo_queries"""

CLUSTERED_ROWS = """SELECT query, usr AS "user", array_to_string(topics, '|') AS topics, cluster
FROM assigned"""


def report_sql(steps: tuple[str, ...] = SAMPLE_JUDGED) -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def fixed(section: int, lines: list[str]) -> str:
        rows = ", ".join(f"({n}, {text(line)})" for n, line in enumerate(lines))
        return (
            f"SELECT {section} AS section, '' AS cluster_label, n AS line_number, line "
            f"FROM (VALUES {rows}) v(n, line)"
        )

    def blocks(section: int, where: str, title: str, lines: tuple[str, ...], names: list[str]) -> str:
        body = ", ".join(
            f"printf({text(line)}, CAST({name} AS VARCHAR))" for line, name in zip(lines, names)
        )
        lines_sql = f"['', printf({text(title)}, cluster_label), {body}]"
        return (
            f"SELECT {section}, cluster_label, generate_subscripts({lines_sql}, 1) - 1, "
            f"unnest({lines_sql}) FROM valid WHERE {where}"
        )

    def total(section: int, where: str, line: str) -> str:
        return (
            f"SELECT {section}, '', n, CASE n WHEN 0 THEN '' ELSE printf({text(line)}, "
            f"(SELECT CAST(count(*) AS VARCHAR) FROM valid WHERE {where})) END "
            "FROM (VALUES (0), (1)) v(n)"
        )

    names = ["topic", "n_queries", "avg_similarity", "unique_users", "most_central_query"]
    head = [C.REPORT_RULE, C.REPORT_TITLE, C.REPORT_RULE, "", C.REPORT_CANDIDATES_TITLE]
    parts = [
        fixed(0, head),
        blocks(1, "seo_candidate = 'true'", C.REPORT_CANDIDATE, C.REPORT_CANDIDATE_LINES, names),
        total(2, "seo_candidate = 'true'", C.REPORT_CANDIDATES_TOTAL),
        fixed(3, ["", C.REPORT_RULE, C.REPORT_CLUSTERS_TITLE, C.REPORT_RULE]),
        blocks(4, "true", C.REPORT_CLUSTER, C.REPORT_CLUSTER_LINES, names[1:]),
        total(5, "true", C.REPORT_CLUSTERS_TOTAL),
    ]
    valid = f"valid AS ({METADATA} FROM judged WHERE why = '')"
    union = "\nUNION ALL ".join(parts)
    return with_(*steps, valid) + (
        "SELECT CAST(section AS INTEGER) AS section, cluster_label, "
        f"CAST(line_number AS INTEGER) AS line_number, line FROM ({union})"
    )


TREE_WEIGHTS = """SELECT topic, round(w, 5) AS weight, count(*) AS n_edges
FROM tree GROUP BY ALL"""
CORE_DISTANCES = """SELECT topic, x AS query_id, round(c, 5) AS core FROM core"""
LABELS = "SELECT topic, query_id, label FROM labels"
EPSILON_CLUSTERS = ClusterConfig(min_cluster_size=2, cluster_selection_epsilon=1.2)
VECTORS = with_(VEC_POINTS, density())

ORACLES: dict[str, str] = {
    "table_scan_whole": with_(DOC_LOG) + "SELECT * FROM log",
    "table_scan": with_(DOC_LOG) + "SELECT * FROM log ORDER BY query_id LIMIT 100",
    "csv_round_trip": with_(DOC_LOG) + "SELECT * FROM log",
    "json_round_trip": with_(CONV_LOG) + "SELECT * FROM log",
    "table_round_trip": with_(CONV_LOG) + "SELECT * FROM log",
    "filter_documents": with_(DOC_LOG_MULTI, reasons(), KEPT) + KEPT_ROWS,
    "filter_conversations": with_(CONV_LOG, reasons(), KEPT) + KEPT_ROWS,
    "filter_without_topics": with_(CONV_LOG, reasons(0, topics=False), KEPT)
    + "SELECT query_id, query, 'unknown' AS \"user\", '' AS topics FROM kept",
    "filter_by_language": with_(DOC_LOG, LANGUAGES, reasons(languages=True), KEPT) + KEPT_ROWS,
    "drop_reasons_with_language": with_(DOC_LOG, LANGUAGES, reasons(languages=True))
    + "SELECT query_id, drop_reason FROM reasons",
    "audit_with_language": with_(DOC_LOG, LANGUAGES, reasons(languages=True)) + AUDIT,
    "drop_reasons": with_(CONV_LOG, reasons()) + "SELECT query_id, drop_reason FROM reasons",
    "audit_documents": with_(DOC_LOG, reasons()) + AUDIT,
    "audit_conversations": with_(CONV_LOG, reasons()) + AUDIT,
    "clean_text": f"SELECT doc_id, {clean('text')} AS query_clean FROM documents",
    "parse_topic_lists": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_topics,
  CAST(len(list_filter(t, lambda x: x <> '')) AS INTEGER) AS n_filled,
  array_to_string(t, '|') AS topics,
  coalesce(array_to_string(list_filter(t, lambda x: x <> ''), '|'), '') AS filled
FROM (SELECT doc_id, {topic_list('text')} AS t FROM documents)""",
    "detect_languages": with_(LANGUAGES)
    + "SELECT id AS doc_id, lang AS language, lang = 'en' AS is_english FROM best",
    "language_counts": with_(LANGUAGES)
    + "SELECT lang AS language, count(*) AS n_queries FROM best GROUP BY lang",
    "trigram_totals": with_(LANGUAGES)
    + "SELECT lang, CAST(bucket AS INTEGER) AS bucket, n FROM totals",
    "profile_languages": with_(DOC_LOG, reasons(), KEPT, LANGUAGES)
    + """SELECT (SELECT count(*) FROM kept) AS total_queries, lang AS language, count(*) AS n_queries
FROM kept JOIN best ON best.id = kept.query_id GROUP BY lang""",
    "profile_queries": with_(DOC_LOG, reasons(), KEPT)
    + """SELECT count(*) AS total_queries, count(DISTINCT query) AS unique_queries,
  count(DISTINCT usr) AS unique_users, round(avg(length(query)), 6) AS avg_query_length,
  min(length(query)) AS min_query_length, max(length(query)) AS max_query_length,
  count(*) FILTER (len(topics) > 0) AS queries_with_topics FROM kept""",
    "tfidf_weights": with_(DOC_LOG, reasons(), KEPT, TFIDF)
    + """SELECT query_id, CAST(bucket AS INTEGER) AS bucket, round(weight, 6) AS weight
FROM weights WHERE weight <> 0""",
    "embed_with_plugin": with_(CONV_LOG)
    + """SELECT query_id, user_id, CAST(length(query) AS DOUBLE) AS length,
  CAST(length(query) - length(replace(query, ' ', '')) AS DOUBLE) AS blanks,
  CAST(length(query) - length(replace(query, ',', '')) AS DOUBLE) AS commas FROM log""",
    "vector_statistics": """SELECT count(*) AS count, max(len(embedding)) AS dimension,
  round(avg(n), 6) AS mean_norm, round(stddev_pop(n), 6) AS std_norm,
  round(min(n), 6) AS min_norm, round(max(n), 6) AS max_norm
FROM (SELECT embedding, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]),
                                              CAST(embedding AS DOUBLE[]))) AS n FROM embeddings)""",
    "topic_rows": with_(DOC_LOG_MULTI, reasons(), KEPT, MENTIONS)
    + """SELECT topic, query_id, CAST(pos AS INTEGER) AS pos, topic_rows,
  first_id AS topic_first_id, CAST(first_pos AS INTEGER) AS topic_first_pos,
  topic_rows >= 30 AS clusterable FROM mentions JOIN topics USING (topic)""",
    "core_distance": VECTORS + CORE_DISTANCES,
    "core_distance_in_blocks": VECTORS + CORE_DISTANCES,
    "tree_weights": VECTORS + TREE_WEIGHTS,
    "tree_weights_in_blocks": VECTORS + TREE_WEIGHTS,
    "density_labels": VECTORS + LABELS,
    "density_labels_with_epsilon": with_(VEC_POINTS, density(EPSILON_CLUSTERS)) + LABELS,
    "density_labels_in_blocks": VECTORS + LABELS,
    "density_labels_shifted": with_(moved_points("x + 1000.0"), density()) + LABELS,
    "density_labels_with_outlier": with_(
        moved_points("x * CASE WHEN vec_id % 97 = 0 THEN 1e7 ELSE 1.0 END"), density()
    )
    + LABELS,
    "capped_members": with_(*SAMPLE)
    + """SELECT topic, CAST(label AS INTEGER) AS label, query_id, CAST(pos AS INTEGER) AS pos,
  CAST(rank AS INTEGER) AS rank FROM capped""",
    "capped_out": with_(*SAMPLE)
    + """SELECT topic, CAST(label AS INTEGER) AS label, query_id, CAST(pos AS INTEGER) AS pos
FROM away ANTI JOIN capped USING (topic, label, query_id, pos)""",
    "failed_topics": """SELECT 't' || label AS topic, 'missing or non-finite vectors' AS error
FROM embeddings GROUP BY label HAVING bool_or(vec_id % 250 = 7)""",
    "cluster_measures": with_(*SAMPLE)
    + """SELECT topic, CAST(label AS INTEGER) AS label, n_queries, round(cohesion, 6) AS cohesion,
  unique_users FROM measured""",
    "valid_clusters": with_(*SAMPLE_JUDGED) + METADATA + " FROM judged WHERE why = ''",
    "rejected_clusters": with_(*SAMPLE_JUDGED)
    + METADATA
    + ", why AS rejection_reasons FROM judged WHERE why <> ''",
    "first_topic": with_(*SAMPLE_ASSIGNED) + CLUSTERED_ROWS,
    "central_queries": with_(*SAMPLE_ASSIGNED, generated(2)) + GENERATED_ROWS,
    "prompt_inputs": with_(*SAMPLE_ASSIGNED)
    + f"""SELECT cluster, any_value(cluster_size) AS cluster_size,
  split_part(cluster, '_', 1) AS topic,
  string_agg(query, '|' ORDER BY n) AS examples
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY rank, query_id) AS n FROM chosen)
WHERE n <= {C.PROMPT_EXAMPLES} GROUP BY cluster""",
    "generate_with_plugin": with_(*SAMPLE_ASSIGNED)
    + f"""SELECT cluster, query AS seo_query, CAST(n AS INTEGER) AS query_number, cluster_size
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY rank, query_id) AS n FROM chosen)
WHERE n <= 3 AND NOT prefix(cluster, 'u')
UNION ALL
SELECT cluster, printf('{C.FALLBACK_WITH_TOPIC}', split_part(cluster, '_', 1)),
       CAST(unnest([1, 2, 3]) AS INTEGER), any_value(cluster_size)
FROM chosen WHERE prefix(cluster, 'u') GROUP BY cluster""",
    "parsed_answers": f"""SELECT doc_id, CAST(n AS INTEGER) AS query_number, line
FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS n
      FROM (SELECT doc_id, {strip('l')} AS line, p
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
                         generate_subscripts(string_split(text, chr(10)), 1) AS p FROM documents))
      WHERE line <> '') WHERE n <= 3""",
    "fallbacks": f"""SELECT cluster, CAST(unnest([0, 1]) AS INTEGER) AS pos, seo_query FROM (
  SELECT DISTINCT cluster, CASE WHEN split_part(cluster, '_', 1) <> ''
    THEN printf('{C.FALLBACK_WITH_TOPIC}', split_part(cluster, '_', 1))
    ELSE '{C.FALLBACK_WITHOUT_TOPIC}' END AS seo_query
  FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN '_' ELSE '' END || lang || '_' || source || '_0'
          AS cluster FROM documents))""",
    "seo_statistics": with_(*SAMPLE_ASSIGNED, generated(2))
    + """SELECT count(*) AS total_queries, count(DISTINCT cluster) AS unique_clusters,
  round(avg(cluster_size), 6) AS avg_cluster_size,
  round(count(*) / count(DISTINCT cluster), 6) AS queries_per_cluster,
  round(avg(length(seo_query)), 6) AS avg_query_length FROM generated""",
    "report_lines": report_sql(),
    "sample_statistics": with_(*SAMPLE_ASSIGNED, generated(2)) + STATISTICS,
    "flagship": with_(*whole_run(DOC_LOG, False, ClusterConfig(), 9)) + CLUSTERED_ROWS,
    "flagship_generated": with_(
        *whole_run(DOC_LOG_MULTI, True, ClusterConfig(), 9), generated(2)
    )
    + GENERATED_ROWS,
    "flagship_statistics": with_(
        *whole_run(
            CONV_LOG,
            False,
            ClusterConfig(
                min_cluster_size=2,
                min_cluster_similarity=0.1,
                min_seo_similarity=0.3,
                min_unique_users=1,
            ),
            7,
        ),
        generated(1),
    )
    + STATISTICS,
}

ONE_TOPIC = """log AS (
  SELECT doc_id AS query_id, text AS query, 'all' AS topic, source AS user_id FROM documents)"""
ORACLES["flagship_one_topic"] = with_(*whole_run(ONE_TOPIC, False, ClusterConfig(), 9)) + CLUSTERED_ROWS
ORACLES["density_labels_of_halves"] = (
    with_(
        """points AS (
  SELECT 't' AS topic, vec_id AS query_id,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: x + 10.0 * (label % 2)) AS vec
  FROM embeddings)""",
        density(ClusterConfig(min_cluster_size=100), 8),
    )
    + LABELS
)
ORACLES["contained_failures"] = (
    VECTORS
    + """SELECT topic, query_id, label, NULL AS error FROM labels WHERE topic NOT IN ('t3', 't8')
UNION ALL SELECT DISTINCT topic, NULL, NULL, 'ArithmeticError: planted' FROM labels
WHERE topic IN ('t3', 't8')"""
)
ORACLES["json_document"] = ORACLES["json_round_trip"]
ORACLES["csv_lines"] = r"""SELECT doc_id, regexp_replace(text, '([.,]) ', '\1\\' || chr(10), 'g') AS text, lang,
  (SELECT count(*) FROM documents) AS n_lines FROM documents"""
ORACLES["detect_with_saved_model"] = ORACLES["detect_languages"]
NOTEBOOK = whole_run(
    CONV_LOG,
    False,
    ClusterConfig(min_cluster_size=2, min_cluster_similarity=0.1, min_seo_similarity=0.3, min_unique_users=1),
    7,
)
_REPORT = report_sql(())
ORACLES["notebook_contents"] = (
    with_(*NOTEBOOK, generated(1), _REPORT.removeprefix("WITH ").split("\nSELECT CAST(section", 1)[0])
    + f"""SELECT 'filtered_queries' AS output, CAST(query_id AS VARCHAR) AS c0, query AS c1, usr AS c2,
  array_to_string(topics, '|') AS c3, CAST(NULL AS VARCHAR) AS c4 FROM kept
UNION ALL
SELECT 'clustered_queries', query, usr, array_to_string(topics, '|'), cluster, NULL FROM assigned
UNION ALL
SELECT 'cluster_metadata', cluster_label, CAST(n_queries AS VARCHAR), printf('%.4f', avg_similarity),
  CAST(unique_users AS VARCHAR), concat_ws('/', topic, most_central_query, seo_candidate) FROM valid
UNION ALL
SELECT 'seo_queries', cluster, seo_query, CAST(query_number AS VARCHAR), CAST(cluster_size AS VARCHAR), NULL
FROM generated
UNION ALL
SELECT 'cluster_report', line, NULL, NULL, NULL, NULL
FROM (SELECT CAST(section{_REPORT.split("SELECT CAST(section", 1)[1]})"""
)
ORACLES["notebook_outputs"] = ORACLES["flagship_statistics"]
