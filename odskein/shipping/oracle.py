"""The registered queries as SQL over the trade tables, written apart from the operators."""

from __future__ import annotations

SHIPMENTS = """
shipments AS (
  SELECT l_orderkey, l_partkey, l_returnflag, l_shipdate, o_orderdate, o_orderstatus,
         s_nationkey AS from_nation, c_nationkey AS to_nation
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN customer ON c_custkey = o_custkey
)"""

NATIONS = """
nations AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
)"""


def civil(wef: str | None, til: str | None, blank: str = "") -> str:
    period = f"o_orderdate >= TIMESTAMP '{wef}' AND o_orderdate < TIMESTAMP '{til}'" if wef else "true"
    return f"""{SHIPMENTS}, {NATIONS},
civil AS (
  SELECT s.*, strftime(o_orderdate, '%Y') AS year,
         a.n_name AS adep, a.r_name AS dep_region, b.n_name AS ades, b.r_name AS des_region
  FROM shipments s
  JOIN part ON p_partkey = l_partkey
  JOIN nations a ON a.n_nationkey = from_nation
  JOIN nations b ON b.n_nationkey = to_nation
  WHERE {period}
    AND l_returnflag NOT IN ('R', '{blank}') AND substr(p_type, 1, 1) <> 'E'
)"""


ALL_TIME = ("1995-01-01", "2002-01-01")
TWO_YEARS = ("1996-01-01", "1998-01-01")
OPEN = (None, None)
CIVIL = civil(*ALL_TIME)
EVERY = civil(*OPEN)

RAW = f"""{EVERY},
raw AS (
  SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
         adep AS dep_iso_country_code, ades AS des_iso_country_code
  FROM civil GROUP BY year, adep, ades
)"""

GAPPY = f"""{RAW},
gappy AS (
  SELECT year, nb_of_flight,
         nullif(dep_iso_country_code, 'NATION_5') AS dep_iso_country_code,
         nullif(des_iso_country_code, 'NATION_6') AS des_iso_country_code
  FROM raw
)"""

RECODED = f"""{GAPPY},
recoded AS (
  SELECT year, nb_of_flight,
         CASE dep_iso_country_code WHEN 'NATION_3' THEN 'NATION_4' WHEN 'NATION_17'
              THEN 'NATION_18' ELSE dep_iso_country_code END AS dep_iso_country_code,
         CASE des_iso_country_code WHEN 'NATION_3' THEN 'NATION_4' WHEN 'NATION_17'
              THEN 'NATION_18' ELSE des_iso_country_code END AS des_iso_country_code
  FROM gappy
)"""

CLASSIFIED = f"""{RAW},
scheme AS (
  SELECT n_name AS code, 'Land ' || n_nationkey AS name, r_name AS region,
         r_name || CASE WHEN n_nationkey < 13 THEN ' north' ELSE ' south' END AS part
  FROM nations WHERE n_name <> 'NATION_12'
),
classified AS (
  SELECT year, nb_of_flight AS flights,
         dep_iso_country_code AS origin_iso, o.name AS origin_name,
         o.region AS origin_region_name,
         des_iso_country_code AS destination_iso, d.name AS destination_name,
         d.region AS destination_region_name
  FROM raw
  LEFT JOIN scheme o ON o.code = dep_iso_country_code
  LEFT JOIN scheme d ON d.code = des_iso_country_code
)"""

GAPPY_CLASSIFIED = f"""{CLASSIFIED},
lost AS (
  SELECT * REPLACE (nullif(origin_iso, 'NATION_9') AS origin_iso) FROM classified
)"""


def widened(end: str) -> str:
    column = f"{end}_region_name"
    return f"CASE WHEN {column} IN ('ASIA', 'MIDDLE EAST') THEN 'EAST' ELSE {column} END"


INTRA = "origin_region_name = 'EUROPE' AND destination_region_name = 'EUROPE'"
EXTRA = (
    "(origin_region_name <> 'EUROPE' AND destination_region_name = 'EUROPE')"
    " OR (origin_region_name = 'EUROPE' AND destination_region_name <> 'EUROPE')"
)
OVER = "origin_region_name <> 'EUROPE' AND destination_region_name <> 'EUROPE'"

WIDE_EXTRA = f"""{CLASSIFIED},
wide AS (
  SELECT * REPLACE ({widened('origin')} AS origin_region_name,
                    {widened('destination')} AS destination_region_name)
  FROM classified WHERE {EXTRA}
)"""

YEARS = range(1995, 2002)
PAIR = """origin_iso, origin_name, origin_region_name,
  destination_iso, destination_name, destination_region_name"""


def matrix(source: str, threshold: int) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(flights) FILTER (year = '{y}' AND flights > {threshold}), 0)"
        f" AS BIGINT) AS countryflow_{y}"
        for y in YEARS
    )
    return f"SELECT {PAIR}, {cells} FROM {source} WHERE flights > {threshold} GROUP BY ALL"


CLEANED = f"""{RECODED},
scheme AS (
  SELECT n_name AS code, 'Land ' || n_nationkey AS name, r_name AS region,
         r_name || CASE WHEN n_nationkey < 13 THEN ' north' ELSE ' south' END AS part
  FROM nations WHERE n_name <> 'NATION_12'
),
cleaned AS (
  SELECT year, CAST(sum(nb_of_flight) AS BIGINT) AS flights,
         dep_iso_country_code AS origin_iso, des_iso_country_code AS destination_iso
  FROM recoded
  WHERE dep_iso_country_code IS NOT NULL AND des_iso_country_code IS NOT NULL
  GROUP BY year, dep_iso_country_code, des_iso_country_code
)"""

INTRA_PARTS = f"""{CLASSIFIED},
intra AS (
  SELECT c.* REPLACE (o.part AS origin_region_name, d.part AS destination_region_name)
  FROM classified c JOIN scheme o ON o.code = origin_iso JOIN scheme d ON d.code = destination_iso
  WHERE {INTRA}
)"""

GRID = """
grid AS (
  SELECT n_name AS icao, CAST(n_nationkey * 10 - 120 AS DOUBLE) AS lon,
         CAST(n_nationkey * 3 - 35 AS DOUBLE) AS lat
  FROM nation WHERE n_name <> 'NATION_24'
    AND n_nationkey IN (SELECT c_nationkey FROM customer)
)"""

FLOW_NAME = """CASE WHEN origin_region_name < destination_region_name
       THEN origin_region_name || '-' || destination_region_name
       WHEN origin_region_name >= destination_region_name
       THEN destination_region_name || '-' || origin_region_name END"""

VERSIONS = f"""{NATIONS},
numbered AS (
  SELECT *, 'C' || lpad(CAST(n_nationkey // 2 AS VARCHAR), 2, '0') AS country FROM nations
),
versions AS (
  SELECT nullif(n_name, 'NATION_24') AS code, n_name || ' ' || c_mktsegment AS ap_name,
         CASE WHEN substr(n_name, 2) IN ('WI', 'WR') THEN 'INDONESIA'
              WHEN n_name = 'XSPR' THEN 'CUBA'
              ELSE r_name || '-D''ARC (' || country || ')' END AS country_name,
         country, n_nationkey * 3.0 - 35 AS lat, n_nationkey * 10.0 - 120 AS lon,
         DATE '2000-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS valid_to
  FROM customer JOIN numbered ON n_nationkey = c_nationkey
),
latest AS (
  SELECT DISTINCT code, ap_name, country_name, country,
         CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon
  FROM (SELECT *, max(valid_to) OVER (PARTITION BY code) AS newest FROM versions
        WHERE code IS NOT NULL)
  WHERE valid_to = newest
)"""


def daily(wef: str | None, til: str | None, nameless: str = "") -> str:
    period = (
        f"o_orderdate >= TIMESTAMP '{wef}' - INTERVAL 1 DAY AND o_orderdate < TIMESTAMP '{til}'"
        f" AND l_shipdate >= TIMESTAMP '{wef}' AND l_shipdate < TIMESTAMP '{til}'"
        if wef
        else "true"
    )
    return f"""{SHIPMENTS}, {VERSIONS},
counted AS (
  SELECT CAST(l_shipdate AS DATE) AS entry_day, nullif(a.n_name, '{nameless}') AS adep,
         nullif(b.n_name, '{nameless}') AS ades, CAST(count(l_orderkey) AS BIGINT) AS flight
  FROM shipments
  JOIN nations a ON a.n_nationkey = from_nation
  JOIN nations b ON b.n_nationkey = to_nation
  WHERE {period}
    AND o_orderstatus IN ('F', 'O')
  GROUP BY 1, 2, 3
),
daily AS (
  SELECT entry_day, adep, ades,
         coalesce(adep, '') || '>' || coalesce(ades, '') AS adep_ades_pair_code,
         CASE WHEN adep IS NULL OR ades IS NULL THEN '<->'
              WHEN adep < ades THEN adep || '<->' || ades
              ELSE ades || '<->' || adep END AS airport_pair_code,
         flight, p.ap_name AS adep_name, q.ap_name AS ades_name,
         p.country_name AS adep_country_iso_name, p.country AS adep_country_iso_code,
         q.country_name AS ades_country_iso_name, q.country AS ades_country_iso_code,
         p.lat AS adep_latitude, p.lon AS adep_longitude,
         q.lat AS ades_latitude, q.lon AS ades_longitude
  FROM counted
  LEFT JOIN latest p ON p.code = adep
  LEFT JOIN latest q ON q.code = ades
)"""


REPAIRED = f"""{daily(*OPEN)},
repaired AS (
  SELECT * REPLACE (
    CASE adep WHEN 'NATION_7' THEN 'C09' ELSE adep_country_iso_code END AS adep_country_iso_code,
    CASE ades WHEN 'NATION_7' THEN 'C09' ELSE ades_country_iso_code END AS ades_country_iso_code)
  FROM daily
)"""


def title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({column}), "
        "'[a-z'']+|[^a-z'']+'), lambda w: upper(w[1]) || w[2:]), '')"
    )


PAIRS = f"""{REPAIRED},
pairs AS (
  SELECT entry_day, coalesce(adep_country_iso_code, 'NA') || '>' ||
         coalesce(ades_country_iso_code, 'NA') AS airport_country_pair,
         CAST(sum(flight) AS BIGINT) AS count,
         {title('min(adep_country_iso_name)')} AS source,
         {title('min(ades_country_iso_name)')} AS target,
         adep_country_iso_code AS source_iso2c, ades_country_iso_code AS target_iso2c
  FROM repaired GROUP BY entry_day, adep_country_iso_code, ades_country_iso_code
)"""

PLACES = f"""{PAIRS},
codes AS (
  SELECT source_iso2c AS code FROM pairs WHERE source_iso2c IS NOT NULL
  UNION SELECT target_iso2c FROM pairs WHERE target_iso2c IS NOT NULL
),
centroids AS (
  SELECT 'Land ' || country AS name, country AS code, min(lon) AS lon, min(lat) AS lat
  FROM versions WHERE code IS NOT NULL AND country <> 'C03' GROUP BY country
  UNION ALL VALUES ('Far place', 'C03', 44.5, -12.5), ('Unused place', '##', 0.0, 0.0)
),
moved(code, name, lat, lon) AS (
  VALUES ('C05', 'Moved place', 1.25, 2.5), ('C06', NULL, -3.5, 4.0)
),
places AS (
  SELECT CAST(row_number() OVER (ORDER BY codes.code) AS BIGINT) AS id,
         coalesce(m.name, c.name) AS name, codes.code AS iso_a2,
         CAST(coalesce(m.lat, c.lat) AS DOUBLE) AS lat,
         CAST(coalesce(m.lon, c.lon) AS DOUBLE) AS lon
  FROM codes LEFT JOIN centroids c ON c.code = codes.code
  LEFT JOIN moved m ON m.code = codes.code
)"""

YEARLY = f"""{EVERY},
yearly AS (
  SELECT year, CAST(count(l_orderkey) AS BIGINT) AS n, adep,
         dep_region AS dep_iso_country_code, ades, des_region AS des_iso_country_code
  FROM civil GROUP BY ALL
)"""

GRAPH = f"""{RAW},
edges AS (
  SELECT dep_iso_country_code || 'dep' AS a, des_iso_country_code || 'des' AS b,
         nb_of_flight AS value
  FROM raw WHERE year = '1998' AND nb_of_flight > 7
),
nodes AS (
  SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS BIGINT) AS id, name
  FROM (SELECT a AS name FROM edges UNION SELECT b FROM edges)
)"""

POINTS = """
points AS (
  SELECT c_custkey, c_name AS icao, lower(c_name) AS name, substr(c_mktsegment, 1, 3) AS iata_code,
         c_mktsegment AS iata_name,
         CAST(nullif((c_custkey * 7) % 361 - 180, 0) AS DOUBLE) AS longitude,
         CAST((c_custkey * 13) % 181 - 90 AS DOUBLE) AS latitude,
         CAST(c_nationkey AS VARCHAR) AS iso_code,
         'nation ' || c_nationkey AS iso_ct_name
  FROM customer
)"""

FOR_EVER = "TIMESTAMP '9999-12-31'"

SWEPT = """
steps AS (SELECT code, moment, sum(step) AS step FROM ends GROUP BY code, moment HAVING sum(step) <> 0),
swept AS (
  SELECT code, moment, lead(moment) OVER (PARTITION BY code ORDER BY moment) AS following,
         CAST(sum(step) OVER (PARTITION BY code ORDER BY moment) AS BIGINT) AS n_versions
  FROM steps
)"""

GAPPY_INTRA = f"""{GAPPY},
scheme AS (
  SELECT n_name AS code, 'Land ' || n_nationkey AS name, r_name AS region,
         r_name || CASE WHEN n_nationkey < 13 THEN ' north' ELSE ' south' END AS part
  FROM nations WHERE n_name <> 'NATION_12'
),
intra AS (
  SELECT year, nb_of_flight AS flights, dep_iso_country_code AS origin_iso, o.name AS origin_name,
         o.part AS origin_region_name, des_iso_country_code AS destination_iso,
         d.name AS destination_name, d.part AS destination_region_name
  FROM gappy JOIN scheme o ON o.code = dep_iso_country_code JOIN scheme d ON d.code = des_iso_country_code
  WHERE o.region = 'EUROPE' AND d.region = 'EUROPE'
)"""

TWO_YEAR_CIVIL = civil(*TWO_YEARS)

ORACLE = {
    "country_flows": f"""
WITH {CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
       dep_region AS dep_iso_country_code, des_region AS des_iso_country_code
FROM civil GROUP BY year, dep_region, des_region""",
    "country_flows_split_key": f"""
WITH {CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
       dep_region AS dep_iso_country_code, des_region AS des_iso_country_code
FROM civil GROUP BY year, dep_region, des_region, adep""",
    "country_flows_known_only": f"""
WITH {CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
       dep_region AS dep_iso_country_code, des_region AS des_iso_country_code
FROM civil WHERE adep <> 'NATION_11' AND ades <> 'NATION_11'
GROUP BY year, dep_region, des_region""",
    "airport_flows_instant": f"""
WITH {CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight, adep,
       dep_region AS dep_iso_country_code, ades, des_region AS des_iso_country_code
FROM civil GROUP BY year, o_orderdate, adep, dep_region, ades, des_region""",
    "airport_flows_year": f"""
WITH {TWO_YEAR_CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight, adep,
       CASE adep WHEN 'NATION_11' THEN '##' ELSE dep_region END AS dep_iso_country_code, ades,
       CASE ades WHEN 'NATION_11' THEN '##' ELSE des_region END AS des_iso_country_code
FROM civil GROUP BY ALL""",
    "airports_valid": f"""
WITH {POINTS},
spans AS (
  SELECT o_custkey, min(o_orderdate) AS valid_from, max(o_orderdate) AS valid_to
  FROM orders GROUP BY o_custkey
)
SELECT icao, name, iata_code, iata_name, longitude, latitude, iso_code, iso_ct_name,
       valid_from, valid_to
FROM points JOIN spans ON o_custkey = c_custkey
WHERE valid_from <= TIMESTAMP '1996-01-01' AND valid_to > TIMESTAMP '1998-01-01'""",
    "daily_airport_flows": f"WITH {daily(*ALL_TIME)} SELECT * FROM daily",
    "daily_airport_flows_period": f"""
WITH {daily(*TWO_YEARS, nameless='NATION_7')} SELECT * FROM daily""",
    "latest_version": """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus
FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest FROM orders)
WHERE o_orderdate = newest""",
    "current_airports": f"""
WITH {VERSIONS}
SELECT code AS cfmu_ap_code, substr(code, 1, 2) AS icao_ctry_code, ap_name AS cfmu_ap_name,
       country_name AS iso_ct_name, country AS iso_ct_code, lat AS latitude, lon AS longitude
FROM latest""",
    "recode_country": f"WITH {RECODED} SELECT * FROM recoded",
    "recode_country_merged": f"""
WITH {RECODED}
SELECT year, CAST(sum(nb_of_flight) AS BIGINT) AS nb_of_flight,
       dep_iso_country_code, des_iso_country_code
FROM recoded GROUP BY ALL""",
    "duplicate_keys": f"""
WITH {RECODED}
SELECT year, dep_iso_country_code, des_iso_country_code, CAST(count(*) AS BIGINT) AS n_rows
FROM recoded GROUP BY year, dep_iso_country_code, des_iso_country_code HAVING count(*) > 1""",
    "fix_region": f"""
WITH {GAPPY_CLASSIFIED}
SELECT * REPLACE (
  CASE WHEN origin_iso IS NULL THEN NULL WHEN origin_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH'
       WHEN origin_iso = 'NATION_8' THEN 'EAST' ELSE origin_region_name END
    AS origin_region_name,
  CASE WHEN destination_iso IS NULL THEN NULL
       WHEN destination_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH'
       WHEN destination_iso = 'NATION_8' THEN 'EAST' ELSE destination_region_name END
    AS destination_region_name)
FROM lost""",
    "fix_home_region": f"""
WITH {GAPPY_CLASSIFIED}
SELECT * REPLACE (
  CASE WHEN origin_iso IS NULL THEN NULL WHEN origin_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH'
       WHEN origin_iso = 'NATION_8' THEN 'EAST' ELSE origin_region_name END
    AS origin_region_name,
  CASE WHEN destination_iso IS NULL THEN NULL
       WHEN destination_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH'
       WHEN destination_iso = 'NATION_8' THEN 'EAST' ELSE destination_region_name END
    AS destination_region_name,
  CASE WHEN origin_iso IS NULL THEN NULL WHEN origin_iso = 'NATION_7' THEN 'Antilles'
       ELSE origin_name END AS origin_name,
  CASE WHEN destination_iso IS NULL THEN NULL WHEN destination_iso = 'NATION_7' THEN 'Antilles'
       ELSE destination_name END AS destination_name)
FROM lost""",
    "collapse_regions": f"""
WITH {CLASSIFIED}
SELECT * REPLACE ({widened('origin')} AS origin_region_name,
                  {widened('destination')} AS destination_region_name)
FROM classified""",
    "with_region": f"WITH {CLASSIFIED} SELECT * FROM classified",
    "intra_flows": f"WITH {CLASSIFIED} SELECT * FROM classified WHERE {INTRA}",
    "extra_flows": f"WITH {CLASSIFIED} SELECT * FROM classified WHERE {EXTRA}",
    "overflights": f"WITH {CLASSIFIED} SELECT * FROM classified WHERE {OVER}",
    "flow_class_totals": f"""
WITH {CLASSIFIED}
SELECT CASE WHEN {INTRA} THEN 'intra' WHEN {EXTRA} THEN 'extra' WHEN {OVER} THEN 'over'
            ELSE 'undecided' END AS flow_class,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(flights) AS BIGINT) AS flights
FROM classified GROUP BY 1""",
    "year_matrix": f"WITH {WIDE_EXTRA} {matrix('wide', 7)}",
    "intra_year_matrix": f"""
WITH {CLASSIFIED},
intra AS (
  SELECT c.* REPLACE (o.part AS origin_region_name, d.part AS destination_region_name)
  FROM classified c JOIN scheme o ON o.code = origin_iso JOIN scheme d ON d.code = destination_iso
  WHERE {INTRA}
)
{matrix('intra', 0)}""",
    "pair_totals_by_year": f"""
WITH {WIDE_EXTRA}
SELECT {FLOW_NAME} AS flow_name, """
    + ", ".join(
        f"CAST(coalesce(sum(flights) FILTER (year = '{y}'), 0) AS BIGINT) AS \"{y}\""
        for y in YEARS
    )
    + " FROM wide GROUP BY 1",
    "region_pair_stats": f"""
WITH {WIDE_EXTRA}
SELECT year, {FLOW_NAME} AS flow_name, CAST(sum(flights) AS BIGINT) AS movements
FROM wide GROUP BY 1, 2""",
    "visible_countries": f"""
WITH {WIDE_EXTRA}
SELECT iso, name, 0 AS show FROM (
  SELECT destination_iso AS iso, destination_name AS name FROM wide
  UNION SELECT origin_iso, origin_name FROM wide)""",
    "visible_regions": f"""
WITH {WIDE_EXTRA}
SELECT destination_region_name AS name FROM wide UNION SELECT origin_region_name FROM wide""",
    "visible_years": f"WITH {WIDE_EXTRA} SELECT DISTINCT year FROM wide",
    "top_contributors": f"""
WITH {WIDE_EXTRA}
SELECT flow, CAST(sum(flights) AS BIGINT) AS total FROM (
  SELECT CASE WHEN origin_region_name <> 'EUROPE' THEN origin_name
              WHEN origin_region_name = 'EUROPE' THEN destination_name END AS flow,
         CASE WHEN year = '1998' THEN flights ELSE 0 END AS flights
  FROM wide)
GROUP BY flow ORDER BY total DESC, flow LIMIT 30""",
    "missing_code_audit": f"""
WITH {GAPPY}
SELECT dep_iso_country_code, des_iso_country_code,
       CAST(sum(nb_of_flight) AS BIGINT) AS filtered_out
FROM gappy WHERE dep_iso_country_code IS NULL OR des_iso_country_code IS NULL GROUP BY 1, 2""",
    "missing_code_totals": f"""
WITH {GAPPY}
SELECT CAST(coalesce(sum(nb_of_flight) FILTER (dep_iso_country_code IS NULL), 0) AS BIGINT)
         AS filtered_out_dep,
       CAST(coalesce(sum(nb_of_flight) FILTER (des_iso_country_code IS NULL), 0) AS BIGINT)
         AS filtered_out_des
FROM gappy""",
    "drop_missing_codes": f"""
WITH {GAPPY}
SELECT * FROM gappy
WHERE dep_iso_country_code IS NOT NULL AND des_iso_country_code IS NOT NULL""",
    "od_nodes": f"WITH {GRAPH} SELECT * FROM nodes",
    "od_links": f"""
WITH {GRAPH}
SELECT s.id AS source, t.id AS target, value
FROM edges JOIN nodes s ON s.name = a JOIN nodes t ON t.name = b""",
    "repair_country": f"""
WITH {REPAIRED}
SELECT entry_day, adep, ades, flight, adep_country_iso_code, ades_country_iso_code
FROM repaired""",
    "country_pairs": f"WITH {PAIRS} SELECT * FROM pairs",
    "locations": f"WITH {PLACES} SELECT * FROM places",
    "flow_timeline": f"""
WITH {PLACES}
SELECT s.id AS origin, t.id AS dest, count, strftime(entry_day, '%Y-%m-%d') AS time
FROM pairs JOIN places s ON s.iso_a2 = source_iso2c JOIN places t ON t.iso_a2 = target_iso2c
WHERE count >= 2""",
    "day_list": f"""
WITH {REPAIRED}
SELECT string_agg(DISTINCT strftime(entry_day, '%Y-%m-%d'), ','
                  ORDER BY strftime(entry_day, '%Y-%m-%d') DESC) AS value
FROM repaired""",
    "departure_share": f"""
WITH {YEARLY}
SELECT *, CAST(sum(n) OVER (PARTITION BY adep) AS BIGINT) AS total
FROM yearly WHERE adep <> ades""",
    "airport_points": f"""
WITH {POINTS}
SELECT icao AS icao_ap_code, name AS icao_ap_name, iata_code AS iata_ap_code,
       iata_name AS iata_ap_name, longitude, latitude, iso_code AS iso_ct_code, iso_ct_name
FROM points
WHERE longitude BETWEEN -25 AND 45 AND latitude BETWEEN 29 AND 75""",
    "region_countries": f"""
WITH {NATIONS}
SELECT DISTINCT n_name AS name, r_name AS region
FROM nations JOIN customer ON c_nationkey = n_nationkey
WHERE r_name = 'EUROPE' AND n_name <> 'NATION_13'""",
    "pair_points": f"""
WITH {YEARLY},
grid AS (
  SELECT n_name AS icao, CAST(n_nationkey * 10 - 120 AS DOUBLE) AS lon,
         CAST(n_nationkey * 3 - 35 AS DOUBLE) AS lat
  FROM nation WHERE n_name <> 'NATION_24'
    AND n_nationkey IN (SELECT c_nationkey FROM customer)
)
SELECT year, adep, ades, n AS nb_of_flight, p.lon AS adep_longitude, p.lat AS adep_latitude,
       q.lon AS ades_longitude, q.lat AS ades_latitude
FROM yearly JOIN grid p ON p.icao = adep JOIN grid q ON q.icao = ades""",
    "od_matrix": f"""
WITH {RAW}
SELECT dep_iso_country_code AS origin_iso, """
    + ", ".join(
        "CAST(coalesce(sum(nb_of_flight) FILTER "
        f"(des_iso_country_code = 'NATION_{n}'), 0) AS BIGINT) AS \"NATION_{n}\""
        for n in range(25)
    )
    + ", CAST(coalesce(sum(nb_of_flight) FILTER (des_iso_country_code IS NULL), 0) AS BIGINT) AS missing"
    + " FROM raw GROUP BY 1",
    "od_matrix_gappy": f"""
WITH {GAPPY}
SELECT dep_iso_country_code AS origin_iso, """
    + ", ".join(
        "CAST(coalesce(sum(nb_of_flight) FILTER "
        f"(des_iso_country_code = 'NATION_{n}'), 0) AS BIGINT) AS \"NATION_{n}\""
        for n in range(25)
    )
    + ", CAST(coalesce(sum(nb_of_flight) FILTER (des_iso_country_code IS NULL), 0) AS BIGINT) AS missing"
    + " FROM gappy GROUP BY 1",
    "chart_matrix": f"""
WITH {CLEANED},
charted AS (
  SELECT * REPLACE ({widened('origin')} AS origin_region_name,
                    {widened('destination')} AS destination_region_name)
  FROM (SELECT * REPLACE (
    CASE WHEN origin_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH' WHEN origin_iso = 'NATION_8' THEN 'EAST'
         ELSE origin_region_name END AS origin_region_name,
    CASE WHEN destination_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH' WHEN destination_iso = 'NATION_8' THEN 'EAST'
         ELSE destination_region_name END AS destination_region_name,
    CASE WHEN origin_iso = 'NATION_7' THEN 'Antilles' ELSE origin_name END AS origin_name,
    CASE WHEN destination_iso = 'NATION_7' THEN 'Antilles' ELSE destination_name END AS destination_name)
    FROM (SELECT cleaned.*, o.name AS origin_name, o.region AS origin_region_name,
                 d.name AS destination_name, d.region AS destination_region_name
          FROM cleaned LEFT JOIN scheme o ON o.code = origin_iso LEFT JOIN scheme d ON d.code = destination_iso))
  WHERE {EXTRA}
)
{matrix('charted', 12)}""",
    "un_regions": f"""
WITH {CLEANED}
SELECT year, flights, origin_iso, o.name AS origin_name,
       CASE WHEN origin_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH' WHEN origin_iso = 'NATION_8' THEN 'EAST'
            ELSE o.part END AS origin_region_name,
       destination_iso, d.name AS destination_name,
       CASE WHEN destination_iso IN ('NATION_7', 'NATION_9') THEN 'SOUTH' WHEN destination_iso = 'NATION_8' THEN 'EAST'
            ELSE d.part END AS destination_region_name
FROM cleaned LEFT JOIN scheme o ON o.code = origin_iso LEFT JOIN scheme d ON d.code = destination_iso""",
    "intra_countries": f"""
WITH {INTRA_PARTS}
SELECT iso, name, 1 AS show FROM (
  SELECT destination_iso AS iso, destination_name AS name FROM intra
  UNION SELECT origin_iso, origin_name FROM intra)""",
    "intra_regions": f"""
WITH {INTRA_PARTS}
SELECT destination_region_name AS name FROM intra UNION SELECT origin_region_name FROM intra""",
    "intra_contributors": f"""
WITH {INTRA_PARTS}
SELECT origin_name AS flow, CAST(sum(CASE WHEN year = '1998' THEN flights ELSE 0 END) AS BIGINT) AS total
FROM intra GROUP BY origin_name ORDER BY total DESC, flow LIMIT 2""",
    "yearly_map_lines": f"""
WITH {YEARLY}, {GRID}
SELECT yearly.*, CAST(sum(n) OVER (PARTITION BY adep) AS BIGINT) AS total,
       p.lon AS adep_longitude, p.lat AS adep_latitude, q.lon AS ades_longitude, q.lat AS ades_latitude
FROM yearly LEFT JOIN grid p ON p.icao = adep LEFT JOIN grid q ON q.icao = ades
WHERE adep <> ades QUALIFY p.icao IS NOT NULL AND q.icao IS NOT NULL""",
    "airports_valid_codes": f"""
WITH {POINTS},
spans AS (
  SELECT o_custkey, min(o_orderdate) AS valid_from, max(o_orderdate) AS valid_to
  FROM orders GROUP BY o_custkey
)
SELECT icao, name, iata_code, iata_name, longitude, latitude, iso_code, iso_ct_name,
       valid_from, valid_to
FROM points JOIN spans ON o_custkey = c_custkey
WHERE valid_from <= TIMESTAMP '1996-01-01' AND valid_to > TIMESTAMP '1998-01-01'
  AND icao IN ('Customer#000000000', 'Customer#000000004', 'nowhere')""",
    "country_flows_blank": f"""
WITH {civil(*OPEN, blank='A')}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
       dep_region AS dep_iso_country_code, des_region AS des_iso_country_code
FROM civil WHERE dep_region <> 'ASIA' AND des_region <> 'ASIA' GROUP BY year, dep_region, des_region""",
    "csv_round_trip": """
SELECT c_custkey AS code, '  "' || c_name || '", of "' || c_mktsegment || '" ' AS label,
       nullif(c_mktsegment, 'BUILDING') AS segment
FROM customer""",
    "bound_sql": """
SELECT o_orderstatus AS flt_state, CAST(count(o_orderkey) AS BIGINT) AS flights
FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01'
GROUP BY 1""",
    "version_faults": f"""
WITH ends AS (
  SELECT o_custkey AS code, o_orderdate AS moment, 1 AS step FROM orders
  UNION ALL
  SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 30 DAY ELSE {FOR_EVER} END, -1
  FROM orders
), {SWEPT}
SELECT code, moment AS since, nullif(following, {FOR_EVER}) AS until, n_versions
FROM swept WHERE following IS NOT NULL AND n_versions <> 1""",
    "versions_in_force": f"""
WITH {POINTS},
spans AS (
  SELECT o_custkey, min(o_orderdate) AS valid_from, max(o_orderdate) AS valid_to FROM orders GROUP BY o_custkey
),
ends AS (
  SELECT iso_code AS code, unnest([valid_from, valid_to]) AS moment, unnest([1, -1]) AS step
  FROM points JOIN spans ON o_custkey = c_custkey WHERE valid_from < valid_to
), {SWEPT}
SELECT code AS iso_ct_code, moment AS since, following AS until, n_versions
FROM swept WHERE following IS NOT NULL""",
    "clipped_map_lines": f"""
WITH {YEARLY}, {GRID},
drawn AS (
  SELECT yearly.*, CAST(sum(n) OVER (PARTITION BY adep) AS BIGINT) AS total,
         p.lon AS x, p.lat AS y, q.lon - p.lon AS dx, q.lat - p.lat AS dy, q.lon AS x1, q.lat AS y1
  FROM yearly LEFT JOIN grid p ON p.icao = adep LEFT JOIN grid q ON q.icao = ades
  WHERE adep <> ades QUALIFY p.icao IS NOT NULL AND q.icao IS NOT NULL
),
cut AS (
  SELECT *,
         greatest(0.0::DOUBLE, CASE WHEN dx > 0 THEN (x - -45.0::DOUBLE) / -dx WHEN dx < 0 THEN (62.5::DOUBLE - x) / dx END,
                  CASE WHEN dy > 0 THEN (y - -12.5::DOUBLE) / -dy WHEN dy < 0 THEN (14.0::DOUBLE - y) / dy END) AS t0,
         least(1.0::DOUBLE, CASE WHEN dx < 0 THEN (x - -45.0::DOUBLE) / -dx WHEN dx > 0 THEN (62.5::DOUBLE - x) / dx END,
               CASE WHEN dy < 0 THEN (y - -12.5::DOUBLE) / -dy WHEN dy > 0 THEN (14.0::DOUBLE - y) / dy END) AS t1
  FROM drawn
  WHERE NOT (dx = 0 AND x NOT BETWEEN -45 AND 62.5) AND NOT (dy = 0 AND y NOT BETWEEN -12.5 AND 14)
)
SELECT * EXCLUDE (x, y, dx, dy, x1, y1, t0, t1),
       CASE WHEN t0 = 0 THEN x ELSE x + t0 * dx END AS adep_longitude,
       CASE WHEN t0 = 0 THEN y ELSE y + t0 * dy END AS adep_latitude,
       CASE WHEN t1 = 1 THEN x1 ELSE x + t1 * dx END AS ades_longitude,
       CASE WHEN t1 = 1 THEN y1 ELSE y + t1 * dy END AS ades_latitude
FROM cut WHERE t0 <= t1""",
    "od_tile_totals": f"""
WITH {GAPPY}
SELECT code, CAST(sum(leaving) AS BIGINT) AS leaving, CAST(sum(arriving) AS BIGINT) AS arriving
FROM (SELECT dep_iso_country_code AS code, nb_of_flight AS leaving, 0 AS arriving FROM gappy
      UNION ALL SELECT des_iso_country_code, 0, nb_of_flight FROM gappy)
GROUP BY code""",
    "od_tile_cells": f"""
WITH {GAPPY}
SELECT dep_iso_country_code AS origin_iso, des_iso_country_code AS destination_iso,
       CAST(sum(nb_of_flight) AS BIGINT) AS flights
FROM gappy GROUP BY ALL""",
    "followed_event_days": """
SELECT CAST(ts AS DATE) AS entry_day, event_type, count(DISTINCT event_id) AS n_events
FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
    "closed_event_days": """
SELECT CAST(ts AS DATE) AS entry_day, event_type, count(DISTINCT event_id) AS n_events
FROM events WHERE CAST(ts AS DATE) <= (SELECT CAST(max(ts) AS DATE) - 2 FROM events) GROUP BY ALL""",
    "incremental_daily_flows": f"WITH {daily(*OPEN)} SELECT * FROM daily",
    "checked_rows": """
WITH lines AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_custkey % 5 = 0 THEN 'code holds no whole number of 64 bits'
              WHEN c_custkey % 7 = 0 THEN 'balance holds no decimal(12,2)' END AS reason
  FROM customer
)
SELECT coalesce(reason, c_mktsegment) AS segment, count(*) AS n,
       CAST(CASE WHEN reason IS NULL THEN sum(c_custkey * CASE WHEN c_custkey % 5 = 1 THEN 100 ELSE 1 END) END AS BIGINT) AS codes
FROM lines GROUP BY c_mktsegment, reason HAVING reason IS NULL
UNION ALL
SELECT reason, count(*), NULL FROM lines WHERE reason IS NOT NULL GROUP BY reason""",
    "published_chart": f"""
WITH {GAPPY_INTRA}
{matrix('intra', 0)}""",
    "published_map": f"""
WITH {PLACES}
SELECT s.id AS origin, t.id AS dest, count, strftime(entry_day, '%Y-%m-%d') AS time
FROM pairs JOIN places s ON s.iso_a2 = source_iso2c JOIN places t ON t.iso_a2 = target_iso2c
WHERE count >= 2""",
    "bucketed_country_flows": f"""
WITH {CIVIL}
SELECT year, CAST(count(l_orderkey) AS BIGINT) AS nb_of_flight,
       dep_region AS dep_iso_country_code, des_region AS des_iso_country_code
FROM civil GROUP BY year, dep_region, des_region""",
}
