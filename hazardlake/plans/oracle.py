"""The same queries as plain SQL over the given tables, written independently of the
DataFrame code; DuckDB runs them."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _iso(column: str, name: str | None = None) -> str:
    return f"strftime({column}, {ISO}) AS {name or column.split('.')[-1]}"


HZ = """
hz AS (
  SELECT concat(CASE WHEN event_id % 2 = 0 THEN 'us' ELSE 'urn' END, user_id) AS event_id,
    CASE WHEN event_id % 2 = 0 THEN 'usgs' ELSE 'nws' END AS source,
    CASE WHEN event_id % 97 = 0 THEN 'test message' ELSE event_type END AS hazard_type,
    CASE WHEN event_id % 11 <> 0 THEN concat(event_type, ' ', event_id) END AS title,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 2 = 0 THEN value / 12.5::DOUBLE
         ELSE (1 + event_id % 4)::DOUBLE END AS severity,
    CASE WHEN event_id % 3 <> 0 THEN ((event_id * 7919) % 18000 - 9000)::DOUBLE / 100 END AS lat,
    CASE WHEN event_id % 3 <> 0 THEN ((event_id * 104729) % 36000 - 18000)::DOUBLE / 100 END AS lon,
    concat('place ', user_id % 20) AS place,
    date_trunc('minute', ts) AS occurred_at, date_trunc('second', ts) AS updated_at,
    date_trunc('second', ts) + to_seconds(event_id % 3600) AS ingested_at,
    concat('https://example.org/', event_id) AS url,
    concat('Report ', event_id, ' of ', user_id) AS description,
    concat('z', event_id * 31 % 60) AS zone1, concat('z', event_id * 17 % 60) AS zone2,
    event_id AS seq
  FROM events)"""
Z = """
z AS (
  SELECT DISTINCT concat('z', i) AS zone_url, (20 + i % 30)::DOUBLE AS zlat, (i - 120)::DOUBLE AS zlon
  FROM (SELECT event_id * 7 % 60 AS i FROM events) WHERE i < 30)"""
SILVER = f"""{HZ},
silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST) AS rn
    FROM hz WHERE event_id IS NOT NULL AND hazard_type <> 'test message')
  WHERE rn = 1)"""
LEVEL = """
  CASE WHEN source = 'usgs' THEN
    CASE WHEN severity >= 7 THEN 'extreme' WHEN severity >= 6 THEN 'severe'
         WHEN severity >= 4.5 THEN 'moderate' WHEN severity >= 2.5 THEN 'minor' ELSE 'unknown' END
  ELSE
    CASE WHEN severity >= 4 THEN 'extreme' WHEN severity >= 3 THEN 'severe'
         WHEN severity >= 2 THEN 'moderate' WHEN severity >= 1 THEN 'minor' ELSE 'unknown' END
  END AS severity_level"""


def _filled(rows: str) -> str:
    """Positions from the first of the two zones that is in the lookup."""
    return f"""
  SELECT s.* EXCLUDE (lat, lon), {LEVEL},
    CASE WHEN s.lat IS NOT NULL THEN 'point'
         WHEN coalesce(a.zlat, b.zlat) IS NOT NULL THEN 'zone_centroid' END AS geo_source,
    coalesce(s.lat, a.zlat, b.zlat) AS lat, coalesce(s.lon, a.zlon, b.zlon) AS lon
  FROM {rows} s LEFT JOIN z a ON a.zone_url = s.zone1 LEFT JOIN z b ON b.zone_url = s.zone2"""


ENRICHED = f"{SILVER}, {Z}, enriched AS ({_filled('silver')})"
HAZARDS = f"""{ENRICHED},
hazards AS (SELECT * FROM enriched WHERE lat IS NOT NULL AND lon IS NOT NULL)"""
SUMMARY = f"""{SILVER},
summary AS (
  SELECT source, hazard_type, severity_level, count(*) AS event_count,
    {_iso('max(occurred_at)', 'latest_event_at')}
  FROM (SELECT *, {LEVEL} FROM silver) GROUP BY ALL)"""
VERSIONS = """
versions AS (
  SELECT user_id AS id, event_id // 50 AS poll, event_id % 50 AS position,
    event_id * 7919 % 1000 AS updated FROM events)"""
KINDS = f"""{VERSIONS},
kinds AS (
  SELECT * EXCLUDE (m), CASE WHEN m IS NULL THEN 'new' WHEN updated > m THEN 'revised'
    ELSE 'unchanged' END AS kind
  FROM (SELECT *, max(updated) OVER (PARTITION BY id ORDER BY poll, position
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM versions))"""
KEYED = """
keyed AS (
  SELECT concat('k', user_id) AS k,
    CASE WHEN event_id % 17 <> 0 THEN event_id * 7919 % 50 END AS v, event_id AS seq FROM events)"""


def _batch(name: str, condition: str) -> str:
    return f"""
{name} AS (
  SELECT k, v, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC NULLS LAST, seq DESC) AS rn
    FROM keyed WHERE {condition}) WHERE rn = 1)"""


def _merge(name: str, old: str, new: str) -> str:
    newer = "t.k IS NULL OR coalesce(s.v >= t.v, false)"
    pick = ", ".join(f"CASE WHEN {newer} THEN s.{c} ELSE t.{c} END AS {c}" for c in ("k", "v", "seq"))
    return f"{name} AS (SELECT {pick} FROM {old} t FULL JOIN {new} s ON s.k = t.k)"


HALF = "(SELECT count(*) // 2 FROM events)"
QUARTER = "(SELECT (count(*) + 3) // 4 FROM events)"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""(2 * 6371.0 * asin(sqrt(least(1.0,
      pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
      + cos(radians({lat1})) * cos(radians({lat2}))
      * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))))"""


POINTS = """
points AS (
  SELECT s_suppkey AS qid, ((s_suppkey * 7919) % 18000 - 9000)::DOUBLE / 100 AS qlat,
    ((s_suppkey * 104729) % 36000 - 18000)::DOUBLE / 100 AS qlon,
    (100 * (1 + s_suppkey % 40))::DOUBLE AS radius_km, 1 + s_suppkey % 60 AS lim
  FROM supplier)"""


def _pairs(radius: str) -> str:
    return f"""WITH {HZ}, {POINTS}
SELECT qid, seq, round(d, 3) AS distance_km
FROM (SELECT qid, seq, radius_km, {_km('qlat', 'qlon', 'lat', 'lon')} AS d
      FROM points, hz WHERE lat IS NOT NULL)
WHERE d <= {radius}"""


NEAR = f"""WITH {HAZARDS},
near AS (SELECT *, {_km('39.5', '-98.35', 'lat', 'lon')} AS d FROM hazards)
SELECT event_id, source, hazard_type, round(severity, 6) AS severity, severity_level, lat, lon,
  geo_source, place, {_iso('occurred_at')}, title, url, round(d, 1) AS distance_km
FROM near WHERE d <= 2000 ORDER BY d, event_id LIMIT 50"""

VECTORS = """
vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings)"""

def _retrieved(questions: str) -> str:
    """The five closest in meaning among the hazards within each question's radius."""
    return f"""{HAZARDS}, {POINTS}, {VECTORS},
found AS MATERIALIZED (
  SELECT h.* EXCLUDE (description), h.seq % (SELECT count(*) FROM embeddings) AS vec_id,
    h.seq % (SELECT count(*) FROM documents) AS doc_id FROM hazards h),
{questions},
close AS MATERIALIZED (
  SELECT qid, k, qvec_id, vec_id, event_id, d
  FROM (SELECT *, {_km('qlat', 'qlon', 'lat', 'lon')} AS d FROM questions, found) WHERE d <= radius_km),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, event_id) AS n
  FROM (SELECT c.*, list_cosine_similarity(q.vec, v.vec) AS sim FROM close c
        JOIN vectors q ON q.vec_id = c.qvec_id JOIN vectors v ON v.vec_id = c.vec_id)),
retrieved AS MATERIALIZED (
  SELECT r.qid, r.n::INTEGER AS n, f.event_id, f.source, hazard_type, severity_level, place,
    round(r.d, 1) AS distance_km, round(r.sim, 3) AS similarity, title, url, t.text AS description, lat, lon
  FROM ranked r JOIN found f ON f.event_id = r.event_id JOIN documents t ON t.doc_id = f.doc_id
  WHERE r.n <= 5)"""


def _prompts(questions: str) -> str:
    return f"""{_retrieved(questions)},
prompts AS (
  SELECT q.qid, concat('Question: ', q.question, chr(10), chr(10),
    'Active hazards near this location:', chr(10),
    string_agg(concat('[', n, '] ', hazard_type, ' (severity: ', severity_level, ') — ', place, ', ',
      distance_km, ' km away', chr(10), left(description, 400)), chr(10) || chr(10) ORDER BY n),
    chr(10), chr(10), 'Answer:') AS prompt
  FROM retrieved r JOIN questions q ON q.qid = r.qid GROUP BY q.qid, q.question)"""


QUESTIONS = """questions AS MATERIALIZED (
  SELECT p.*, p.qid % (SELECT count(*) FROM embeddings) AS qvec_id, 1 + qid % 7 AS k,
    concat('What is near place ', qid, '?') AS question FROM points p)"""
REQUESTS = """
requests AS (
  SELECT event_id AS qid, (event_id % 250 - 125)::DOUBLE AS lat, (event_id % 410 - 205)::DOUBLE AS lon,
    CASE WHEN event_id % 3 <> 0 THEN event_id * 7 % 30000 - 100 ELSE 300 END::DOUBLE AS radius_km,
    left(event_type, event_id % 6) AS question, event_id % (SELECT count(*) FROM embeddings) AS qvec_id
  FROM events),
checked AS MATERIALIZED (
  SELECT *, CASE WHEN abs(lat) > 90 THEN 'lat' WHEN abs(lon) > 180 THEN 'lon'
    WHEN radius_km NOT BETWEEN 1 AND 20000 THEN 'radius_km'
    WHEN length(question) < 3 THEN 'question' END AS reason FROM requests),
questions AS MATERIALIZED (
  SELECT qid, lat AS qlat, lon AS qlon, radius_km, question, qvec_id, 5 AS k FROM checked WHERE reason IS NULL)"""
RETRIEVED, PROMPTS = _retrieved(QUESTIONS), _prompts(QUESTIONS)
# The texts of prompts and answers.
NOTHING = """concat('I don''t see any active hazards within ', radius_km,
  ' km of your location in the current data. This isn''t a guarantee of safety — ',
  'always follow official local authorities and emergency services.')"""

AS_OF = "'2026-01-02T03:04:05Z' AS ingested_at"
QUAKE_DEPTH = """CASE WHEN event_id % 5 = 0 THEN '10.0' WHEN event_id % 5 = 1 THEN 'None'
  ELSE (event_id % 700)::VARCHAR END"""
QUAKES = f"""
quakes AS (
  SELECT event_id // 1000 AS poll, (event_id % 1000)::INTEGER AS position, concat('us', user_id) AS event_id,
    'usgs' AS source, CASE WHEN event_id % 7 IN (0, 1) THEN 'earthquake' ELSE 'quarry blast' END AS hazard_type,
    CASE WHEN event_id % 11 <> 0 THEN concat('M at ', user_id) END AS title,
    CASE WHEN event_id % 13 <> 0 THEN event_id % 8 + 0.5::DOUBLE END AS severity,
    -(event_id % 90 + 0.25::DOUBLE) AS lat, event_id % 180 + 0.5::DOUBLE AS lon,
    concat('place ', user_id % 20) AS place, epoch_us(ts) // 1000 AS t0, epoch_us(ts) // 1000 + event_id % 5000 AS t1,
    concat('https://example.org/', event_id) AS url,
    concat(CASE WHEN event_id % 11 <> 0 THEN concat('M at ', user_id) ELSE 'None' END, '. Depth ',
      {QUAKE_DEPTH}, ' km.') AS description
  FROM events)"""
ALERTS = """
alerts AS (
  SELECT event_id // 1000 AS poll, (event_id % 1000)::INTEGER AS position, concat('urn', event_id) AS event_id,
    'nws' AS source, CASE WHEN event_id % 7 IN (0, 1) THEN 'alert' ELSE 'flood watch' END AS hazard_type,
    CASE WHEN event_id % 4 <> 0 THEN concat('Headline ', event_id) WHEN event_id % 7 = 0 THEN NULL
         WHEN event_id % 7 = 1 THEN '' ELSE 'Flood Watch' END AS title,
    CASE WHEN event_id % 5 < 4 THEN (4 - event_id % 5)::DOUBLE END AS severity,
    CASE WHEN event_id % 3 <> 0 THEN round((3 * (event_id % 45) + 1) / 3.0::DOUBLE, 4) END AS lat,
    CASE WHEN event_id % 3 <> 0 THEN round((3 * (event_id % 90) + 2) / 3.0::DOUBLE, 4) END AS lon,
    concat('area ', user_id % 20) AS place, date_trunc('second', ts) + INTERVAL 6 HOURS AS at,
    CASE WHEN event_id % 8 = 0 THEN 'http://w.example'
         ELSE concat('https://example.org/a/', event_id) END AS url,
    trim(concat(CASE WHEN event_id % 6 <> 0 THEN concat('  Rain over ', user_id, ' ') END,
      CASE WHEN event_id % 2 = 0 THEN concat(chr(10), chr(10), 'Instructions: Move up. ') END),
      chr(10) || ' ') AS description,
    CASE WHEN event_id % 10 <> 0 THEN concat('z', event_id % 60) ELSE '' END AS zones
  FROM events)"""



# Two halves of the versions, each reduced to its newest row per id, the second upserted into the first.
MERGED = f"""{HZ},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id, seq < {HALF}
    ORDER BY updated_at DESC NULLS LAST, ingested_at DESC NULLS LAST) AS rn
  FROM hz WHERE hazard_type <> 'test message'),
b0 AS (SELECT * FROM ranked WHERE rn = 1 AND seq < {HALF}),
b1 AS (SELECT * FROM ranked WHERE rn = 1 AND seq >= {HALF}),
merged AS (
  SELECT CASE WHEN new THEN s.event_id ELSE t.event_id END AS event_id,
    CASE WHEN new THEN s.updated_at ELSE t.updated_at END AS updated_at,
    CASE WHEN new THEN s.url ELSE t.url END AS url
  FROM (SELECT t, s, t.event_id IS NULL OR coalesce(s.updated_at >= t.updated_at, false) AS new
        FROM b0 t FULL JOIN b1 s ON s.event_id = t.event_id))"""
EVENT_TEXT = "trim(concat(source, '. ', text), chr(9) || chr(10) || chr(13) || ' ')"
_MASK = "4294967295::UBIGINT"


def _mixed(k: str) -> str:
    """One block of MurmurHash3: multiplied, rotated by 15 bits, multiplied."""
    first = f"(({k} * 3432918353::UBIGINT) & {_MASK})"
    return f"(((({first} << 15) | ({first} >> 17)) & {_MASK}) * 461845907::UBIGINT & {_MASK})"


def _byte(i: str) -> str:
    return f"coalesce(ascii(nullif(substr(w, ({i})::INTEGER, 1), '')), 0)::UBIGINT"


# Words of a document, each hashed to one of 384 places (MurmurHash3 with seed 42 over its bytes), and their counts.
TERMS = f"""texts AS (SELECT doc_id AS event_id, {EVENT_TEXT} AS text, length({EVENT_TEXT}) AS chars FROM documents),
tokens AS (SELECT event_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS w FROM texts),
words AS (SELECT DISTINCT w FROM tokens),
blocks AS (
  SELECT w, list_transform(range(0, length(w) // 4), lambda i: {' + '.join(
      f"{_byte(f'4 * i + {j + 1}')} * {256 ** j}::UBIGINT" for j in range(4))}) AS whole,
    {' + '.join(f"{_byte(f'4 * (length(w) // 4) + {j + 1}')} * {256 ** j}::UBIGINT" for j in range(3))} AS tail FROM words),
mixed AS (
  SELECT w, xor(xor(list_reduce(list_transform(whole, lambda k: {_mixed('k')}), lambda h, k:
    ((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {_MASK}) * 5::UBIGINT + 3864292196::UBIGINT) & {_MASK}, 42::UBIGINT),
    {_mixed('tail')}), length(w)::UBIGINT) AS h0 FROM blocks),
step1 AS (SELECT w, (xor(h0, h0 >> 16) * 2246822507::UBIGINT) & {_MASK} AS h1 FROM mixed),
step2 AS (SELECT w, (xor(h1, h1 >> 13) * 3266489909::UBIGINT) & {_MASK} AS h2 FROM step1),
hashed AS (SELECT w, xor(h2, h2 >> 16)::BIGINT AS h FROM step2),
places AS (SELECT w, (h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END + 384::BIGINT * 6000000) % 384 AS place FROM hashed),
term_counts AS (
  SELECT event_id, place, count(*)::DOUBLE AS n FROM tokens JOIN places ON places.w = tokens.w GROUP BY event_id, place),
frequencies AS (SELECT place, count(*)::DOUBLE AS df FROM term_counts GROUP BY place)"""


def _records(topic: str) -> str:
    """All fields of a record's body; NULL ones are not in it."""
    return f"""WITH {HZ}
SELECT event_id AS key, {topic} AS topic,
  12 + (title IS NOT NULL)::INT + (severity IS NOT NULL)::INT - 2 * (lat IS NULL)::INT AS k,
  event_id, source, hazard_type, title, round(severity, 6) AS severity, lat, lon, place, {_iso('occurred_at')},
  {_iso('updated_at')}, {_iso('ingested_at')}, url, description, concat(zone1, ',', zone2) AS zones FROM hz"""


ORACLE = {
    "bronze_decode": f"""
SELECT concat('k', user_id) AS event_key,
  concat('{{"event_id":"k', user_id, '","seq":', event_id, '}}') AS raw_json,
  CASE WHEN event_id % 2 = 0 THEN 'earthquakes' ELSE 'weather-alerts' END AS topic,
  (user_id % 8)::INTEGER AS "partition", event_id AS "offset", {_iso('ts', 'kafka_timestamp')},
  '1970-01-01T00:00:00Z' AS bronze_ingested_at
FROM events""",
    "topic_counts": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'earthquakes' ELSE 'weather-alerts' END AS topic,
  count(*) AS n FROM events GROUP BY 1""",
    "bronze_sample": f"""
SELECT CASE WHEN event_id % 2 = 0 THEN 'earthquakes' ELSE 'weather-alerts' END AS topic,
  concat('k', user_id) AS event_key, {_iso('ts', 'kafka_timestamp')}
FROM events ORDER BY event_id LIMIT 5""",
    "parse_events": f"""WITH {HZ}
SELECT event_id, source, hazard_type, title, round(severity, 6) AS severity, lat, lon, place,
  {_iso('occurred_at')}, {_iso('updated_at')}, {_iso('ingested_at')}, url, description,
  concat(zone1, ',', zone2) AS zones FROM hz""",
    "parse_timestamps": f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, {ISO}) END AS "at" FROM events""",
    "quality_gate": f"""WITH {HZ}
SELECT event_id, hazard_type, url FROM hz WHERE hazard_type <> 'test message'""",
    "latest_per_key": f"""WITH {SILVER}
SELECT event_id, {_iso('updated_at')}, seq FROM silver""",
    "merge_two_batches": f"""WITH {KEYED}, {_batch('b0', f'seq < {HALF}')},
{_batch('b1', f'seq >= {HALF}')}, {_merge('m', 'b0', 'b1')} SELECT k, v, seq FROM m""",
    "fold_batches": f"""WITH {KEYED}, {', '.join(
        _batch(f'b{i}', f'seq // {QUARTER} = {i}') for i in range(4))},
{_merge('m1', 'b0', 'b1')}, {_merge('m2', 'm1', 'b2')}, {_merge('m3', 'm2', 'b3')}
SELECT k, v, seq FROM m3""",
    "type_counts": f"""WITH {SILVER}
SELECT source, hazard_type, count(*) AS event_count FROM silver GROUP BY ALL
ORDER BY event_count DESC, source, hazard_type LIMIT 12""",
    "silver_sample": f"""WITH {SILVER}
SELECT source, event_id, round(severity, 6) AS severity, lat, lon, {_iso('occurred_at')}, title
FROM silver ORDER BY event_id LIMIT 5""",
    "severity_levels": f"WITH {HZ} SELECT seq, {LEVEL} FROM hz",
    "zone_fill": f"WITH {ENRICHED} SELECT event_id, geo_source, lat, lon FROM enriched",
    "zone_fill_versions": f"""WITH {HZ}, {Z},
part AS (SELECT * REPLACE (CASE WHEN seq % 5 <> 0 THEN lon END AS lon) FROM hz),
filled AS ({_filled('part')})
SELECT seq, geo_source, lat, lon FROM filled""",
    "zone_fill_joined": f"""WITH {HZ}, {Z}, filled AS ({_filled('hz')})
SELECT seq, geo_source, lat, lon FROM filled""",
    "zone_fill_by_lists": f"""WITH {HZ}, {Z}, filled AS ({_filled('hz')})
SELECT seq, geo_source, lat, lon FROM filled""",
    "gold_hazards": f"""WITH {HAZARDS}
SELECT event_id, source, hazard_type, round(severity, 6) AS severity, severity_level, lat, lon,
  geo_source, place, {_iso('occurred_at')}, {_iso('updated_at')}, title, url, description
FROM hazards""",
    "gold_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "geo_source_counts": f"""WITH {ENRICHED}
SELECT geo_source, count(*) AS n FROM enriched GROUP BY 1""",
    "coverage": f"""WITH {ENRICHED}
SELECT count(*) AS total, count(*) FILTER (lat IS NOT NULL AND lon IS NOT NULL) AS map_ready
FROM enriched""",
    "row_total": f"WITH {SILVER} SELECT count(*) AS total FROM silver",
    "top_hazards": f"""WITH {HAZARDS}
SELECT source, hazard_type, severity_level, geo_source, lat, lon, place, event_id FROM hazards
ORDER BY severity DESC NULLS LAST, occurred_at DESC NULLS LAST, event_id LIMIT 8""",
    "top_groups": f"""WITH {SUMMARY} SELECT * FROM summary
ORDER BY event_count DESC, source, hazard_type, severity_level LIMIT 12""",
    "gold_table_roundtrip": f"WITH {HAZARDS} SELECT event_id, geo_source, lat, lon FROM hazards",
    "vertex_centroids": """
SELECT event_id, round(CASE event_id % 4 WHEN 0 THEN (3 * y + 1) / 3.0::DOUBLE
    WHEN 1 THEN (y + 2) / 3.0::DOUBLE WHEN 2 THEN y + 0.5::DOUBLE END, 4) AS lat,
  round(CASE event_id % 4 WHEN 0 THEN (3 * x + 2) / 3.0::DOUBLE
    WHEN 1 THEN (x + 4) / 3.0::DOUBLE WHEN 2 THEN x + 0.25::DOUBLE END, 4) AS lon
FROM (SELECT event_id, event_id % 90 AS x, event_id % 45 AS y FROM events)""",
    "unresolved_zones": f"""WITH {SILVER}
SELECT DISTINCT unnest([zone1, zone2]) AS zone_url FROM silver WHERE lat IS NULL""",
    "missing_zones": f"""WITH {HZ}, {Z},
wanted AS (SELECT DISTINCT unnest([zone1, zone2]) AS zone_url FROM hz WHERE lat IS NULL)
SELECT zone_url FROM wanted ANTI JOIN z USING (zone_url)""",
    "zone_coverage": f"""WITH {HZ}, {Z},
wanted AS (SELECT DISTINCT unnest([zone1, zone2]) AS zone_url FROM hz WHERE lat IS NULL),
todo AS (SELECT zone_url, substr(zone_url, 2)::INT < 50 AND
    substr(zone_url, 2)::INT IN (SELECT event_id * 31 % 60 FROM events) AS ok
  FROM wanted ANTI JOIN z USING (zone_url))
SELECT (SELECT count(*) FROM wanted) AS wanted, (SELECT count(*) FROM z) AS cached,
  count(*) AS to_fetch, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed FROM todo""",
    "refresh_zone_lookup": f"""WITH {Z},
f AS (SELECT DISTINCT event_id * 31 % 60 AS i FROM events)
SELECT zone_url, zlat AS lat, zlon AS lon FROM z
UNION ALL
SELECT concat('z', i), round((3 * i + 1) / 3.0::DOUBLE, 4), round((3 * i + 2) / 3.0::DOUBLE, 4)
FROM f WHERE i < 50 AND concat('z', i) NOT IN (SELECT zone_url FROM z)""",
    "zone_lookup_file": f"WITH {Z} SELECT zone_url, zlat AS lat, zlon AS lon FROM z",
    "normalize_quakes": f"""WITH {QUAKES}
SELECT poll, position, event_id, source, hazard_type, title, severity, lat, lon, place,
  {_iso("make_timestamp(t0 * 1000)", 'occurred_at')}, {_iso("make_timestamp(t1 * 1000)", 'updated_at')},
  {AS_OF}, url, description, NULL::VARCHAR AS zones FROM quakes""",
    "normalize_alerts": f"""WITH {ALERTS}
SELECT poll, position, event_id, source, hazard_type, title, severity, lat, lon, place,
  {_iso('"at"', 'occurred_at')}, {_iso('"at"', 'updated_at')}, {AS_OF}, url, description, zones
FROM alerts""",
    "rejected_features": """
SELECT event_id // 1000 AS poll, 'coordinates' AS reason, count(*) AS n
FROM events WHERE event_id % 5 = 1 GROUP BY 1""",
    "damaged_documents": """
SELECT event_id // 1000 AS poll, CASE WHEN event_id // 1000 % 3 = 0 THEN 'document' ELSE 'kept' END AS outcome,
  CASE WHEN event_id // 1000 % 3 = 0 THEN 1 ELSE count(*) END AS n
FROM events GROUP BY 1, 2""",
    "read_feed": f"""WITH {QUAKES}
SELECT position, event_id AS id, t1 AS updated, severity AS mag FROM quakes""",
    "bus_records": _records("'earthquakes'"),
    "bus_roundtrip": _records("CASE WHEN source = 'usgs' THEN 'earthquakes' ELSE 'weather-alerts' END"),
    "change_log": f"WITH {KINDS} SELECT * FROM kinds",
    "change_log_chunked": f"WITH {KINDS} SELECT * FROM kinds",
    "change_log_one_poll": f"""WITH {KINDS}
SELECT id, format('f{{:012d}}', poll) AS file, position, updated, kind FROM kinds""",
    "poll_report": f"""WITH {KINDS}
SELECT poll, count(*) AS total, count(*) FILTER (kind = 'new') AS new,
  count(*) FILTER (kind = 'revised') AS revised, count(*) FILTER (kind = 'unchanged') AS unchanged
FROM kinds GROUP BY poll""",
    "first_seen": f"""WITH {VERSIONS}
SELECT id, poll, position, updated FROM (SELECT *, row_number() OVER (
  PARTITION BY id ORDER BY poll, position) AS rn FROM versions) WHERE rn = 1""",
    "new_only": f"""WITH
rows AS (SELECT concat(user_id, '-', floor(value)::BIGINT) AS event_id, event_id AS seq FROM events)
SELECT event_id, seq FROM rows WHERE seq >= {HALF}
  AND event_id NOT IN (SELECT event_id FROM rows WHERE seq < {HALF})""",
    "hazards_near": NEAR,
    "nearest_from_json": NEAR,
    "radius_join": _pairs("500"),
    "radius_join_own_radius": _pairs("radius_km"),
    "radius_join_sliced": _pairs("radius_km"),
    "near_beyond_the_line": f"""WITH {HAZARDS},
near AS (SELECT event_id, {_km('10.0', '-170.0', 'lat', 'lon')} AS d FROM hazards)
SELECT event_id, round(d, 1) AS distance_km FROM near WHERE d <= 3000 ORDER BY d, event_id LIMIT 50""",
    "near_report": f"""WITH {HAZARDS}, {POINTS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, event_id) AS n
  FROM (SELECT *, {_km('qlat', 'qlon', 'lat', 'lon')} AS d FROM points, hazards)
  WHERE d <= radius_km)
SELECT p.qid, p.qlat AS lat, p.qlon AS lon, p.radius_km, count(r.event_id)::INTEGER AS count,
  coalesce(string_agg(concat(r.event_id, ':', round(d, 1)), '|' ORDER BY n)
    FILTER (r.event_id IS NOT NULL), '') AS hazards
FROM points p LEFT JOIN ranked r ON r.qid = p.qid AND r.n <= p.lim GROUP BY ALL""",
    "nearest_versions": f"""WITH {HZ}, {POINTS},
ranked AS (
  SELECT qid, seq, d, row_number() OVER (PARTITION BY qid ORDER BY d, seq) AS n
  FROM (SELECT qid, seq, {_km('qlat', 'qlon', 'lat', 'lon')} AS d FROM points, hz WHERE lat IS NOT NULL)
  WHERE d <= 300)
SELECT qid, n::INTEGER AS n, seq, round(d, 1) AS distance_km FROM ranked WHERE n <= 8""",
    "near_requests": f"""WITH {HAZARDS},
requests AS (
  SELECT event_id AS qid, (event_id % 250 - 125)::DOUBLE AS qlat, (event_id % 410 - 205)::DOUBLE AS qlon,
    (event_id * 7 % 30000 - 100)::DOUBLE AS radius_km, event_id % 700 AS lim,
    CASE WHEN abs(event_id % 250 - 125) > 90 THEN 'lat' WHEN abs(event_id % 410 - 205) > 180 THEN 'lon'
      WHEN event_id * 7 % 30000 - 100 NOT BETWEEN 1 AND 20000 THEN 'radius_km'
      WHEN event_id % 700 NOT BETWEEN 1 AND 500 THEN 'limit'
      WHEN length(left(event_type, event_id % 6)) < 3 THEN 'question' END AS reason FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, event_id) AS n
  FROM (SELECT qid, lim, radius_km, event_id, {_km('qlat', 'qlon', 'lat', 'lon')} AS d
        FROM requests, hazards WHERE reason IS NULL)
  WHERE d <= radius_km)
SELECT q.qid, CASE WHEN reason IS NULL THEN count(r.event_id)::INTEGER END AS count,
  CASE WHEN reason IS NULL THEN md5(coalesce(string_agg(concat(r.event_id, ':', round(d, 1)), '|' ORDER BY n)
    FILTER (r.event_id IS NOT NULL), '')) END AS hazards, reason
FROM requests q LEFT JOIN ranked r ON r.qid = q.qid AND r.n <= q.lim GROUP BY q.qid, reason""",
    "requests_checked": """
SELECT event_id AS qid, CASE WHEN abs(event_id % 250 - 125) > 90 THEN 'lat'
  WHEN abs(event_id % 410 - 205) > 180 THEN 'lon'
  WHEN event_id * 7 % 30000 - 100 NOT BETWEEN 1 AND 20000 THEN 'radius_km'
  WHEN event_id % 700 NOT BETWEEN 1 AND 500 THEN 'limit'
  WHEN length(left(event_type, event_id % 6)) < 3 THEN 'question' END AS reason FROM events""",
    "output_cleaned": f"""WITH {HZ}
SELECT seq, CASE WHEN seq % 5 <> 0 THEN lat END AS lat, {_iso('updated_at')} FROM hz""",
    "cosine_topk": f"""WITH {VECTORS},
asked AS (SELECT label, arg_min(vec, vec_id) AS qvec FROM vectors GROUP BY label),
ranked AS (
  SELECT label, vec_id, sim, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS n
  FROM (SELECT v.label, vec_id, list_cosine_similarity(qvec, vec) AS sim
        FROM vectors v JOIN asked a ON a.label = v.label))
SELECT label, n::INTEGER AS n, vec_id, round(sim, 3) AS similarity FROM ranked WHERE n <= 5""",
    "nearest_vectors": f"""WITH {VECTORS},
unit AS (SELECT vec_id, unnest(list_transform(vec, lambda x: x / sqrt(list_dot_product(vec, vec)))) AS x,
    generate_subscripts(vec, 1) AS i FROM vectors),
mean AS (SELECT list(x ORDER BY i) AS q FROM (SELECT i, avg(x) AS x FROM unit GROUP BY i))
SELECT vec_id, round(sim, 3) AS similarity
FROM (SELECT vec_id, list_cosine_similarity(vec, (SELECT q FROM mean)) AS sim FROM vectors)
ORDER BY sim DESC, vec_id LIMIT 10""",
    "geo_semantic_topk": f"""WITH {RETRIEVED}
SELECT * REPLACE (md5(description) AS description) FROM retrieved""",
    "geo_semantic_topk_bounded": f"""WITH {RETRIEVED}
SELECT * REPLACE (md5(description) AS description) FROM retrieved""",
    "geo_semantic_topk_own_k": f"""WITH {RETRIEVED}
SELECT qid, n::INTEGER AS n, event_id, round(sim, 3) AS similarity FROM ranked WHERE n <= k""",
    "embed_events": f"""WITH {TERMS},
vectors AS (
  SELECT d.event_id, d.chars, t.place, t.n * ln((s.docs + 1.0::DOUBLE) / (f.df + 1.0::DOUBLE)) AS w
  FROM texts d JOIN term_counts t ON t.event_id = d.event_id JOIN frequencies f ON f.place = t.place,
    (SELECT count(*)::DOUBLE AS docs FROM texts) s),
weighted AS (
  SELECT event_id, place, round(w / sqrt(sum(w * w) OVER (PARTITION BY event_id)) * 1e6::DOUBLE)::BIGINT AS x
  FROM vectors WHERE w <> 0)
SELECT d.event_id, d.chars::INTEGER AS text_chars, 384 AS dimensions, count(x)::INTEGER AS terms,
  md5(coalesce(string_agg(concat(place, ':', x), ',' ORDER BY place), '')) AS weights
FROM texts d LEFT JOIN weighted w ON w.event_id = d.event_id AND x <> 0 GROUP BY d.event_id, d.chars""",
    "embed_plugged_in": f"""WITH texts AS (SELECT doc_id AS event_id, {EVENT_TEXT} AS text FROM documents),
counts AS (
  SELECT event_id, list_transform(range(97, 123), lambda c: length(text) - length(replace(text, chr(c::INTEGER), '')))::DOUBLE[] AS v
  FROM texts),
sized AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM counts)
SELECT event_id, array_to_string(list_transform(v, lambda x:
  CASE WHEN norm > 0 THEN round(x / norm * 1e6::DOUBLE) ELSE 0 END::BIGINT), ',') AS weights FROM sized""",
    "citations": f"""WITH {RETRIEVED}
SELECT qid, n, event_id, source, hazard_type, place, distance_km, url FROM retrieved""",
    "prompt_text": f"WITH {PROMPTS} SELECT qid, prompt FROM prompts",
    "guardrail_answers": f"""WITH {RETRIEVED}
SELECT qid, {NOTHING} AS answer, false AS used_llm FROM questions q
WHERE NOT EXISTS (SELECT 1 FROM close c WHERE c.qid = q.qid)""",
    "grounded_requests": f"""WITH {PROMPTS},
cited AS (SELECT qid, string_agg(concat(n, ':', event_id), '|' ORDER BY n) AS citations
          FROM retrieved GROUP BY qid)
SELECT q.qid, md5(prompt) AS prompt, CASE WHEN prompt IS NULL THEN {NOTHING} END AS answer,
  prompt IS NOT NULL AS needs_model, coalesce(citations, '') AS citations
FROM questions q LEFT JOIN prompts p ON p.qid = q.qid LEFT JOIN cited c ON c.qid = q.qid""",
    "ask_requests": f"""WITH {_prompts(REQUESTS)},
cited AS (SELECT qid, string_agg(concat(n, ':', event_id), '|' ORDER BY n) AS citations
          FROM retrieved GROUP BY qid)
SELECT q.qid, q.question, q.lat, q.lon, q.radius_km, reason, prompt IS NOT NULL AS used_llm,
  coalesce(citations, '') AS citations,
  CASE WHEN reason IS NULL THEN md5(coalesce(prompt, {NOTHING})) END AS answer
FROM checked q LEFT JOIN prompts p ON p.qid = q.qid LEFT JOIN cited c ON c.qid = q.qid""",
    "ask_without_model": f"""WITH {REQUESTS.lstrip()}
SELECT qid, question, lat, lon, radius_km, reason, false AS used_llm, '' AS citations,
  CASE WHEN reason IS NULL THEN md5('The AI assistant runs only in the full local stack (it needs a local LLM). '
    || 'This hosted demo serves the live hazard map and the /hazards feed.') END AS answer
FROM checked""",
    "indexed_vectors": f"""WITH {HAZARDS} SELECT count(*) AS vectors FROM silver
WHERE seq % (SELECT count(*) FROM embeddings) IN (SELECT vec_id FROM embeddings)""",
    "stream_silver": f"""WITH {MERGED}
SELECT event_id, {_iso('updated_at')}, url FROM merged""",
    "rollup_two_drops": f"""WITH {MERGED},
kept AS (SELECT h.* FROM hz h JOIN merged m ON m.url = h.url), {Z}, filled AS ({_filled('kept')})
SELECT source, hazard_type, severity_level, count(*) AS event_count, {_iso('max(occurred_at)', 'latest_event_at')},
  count(*) FILTER (lat IS NOT NULL AND lon IS NOT NULL) AS map_ready FROM filled GROUP BY ALL""",
    "stream_changes": f"WITH {KINDS} SELECT * FROM kinds WHERE kind <> 'unchanged'",
    "stream_versions": f"WITH {KINDS} SELECT * FROM kinds WHERE kind <> 'unchanged'",
    "stream_first_seen": f"""WITH {VERSIONS}
SELECT id, poll, position, updated FROM (SELECT *, row_number() OVER (
  PARTITION BY id ORDER BY poll, position) AS rn FROM versions) WHERE rn = 1""",
    "feeds_to_summary": f"""WITH {QUAKES}, {ALERTS},
newest AS (
  SELECT source, hazard_type, severity, make_timestamp(t0 * 1000) AS occurred_at
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY t1 DESC) AS rn FROM quakes)
  WHERE rn = 1
  UNION ALL SELECT source, hazard_type, severity, "at" FROM alerts)
SELECT source, hazard_type, severity_level, count(*) AS event_count,
  {_iso('max(occurred_at)', 'latest_event_at')}
FROM (SELECT *, {LEVEL} FROM newest) GROUP BY ALL""",
}
