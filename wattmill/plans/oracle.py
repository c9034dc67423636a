"""SQL counterparts of the registered queries, written against the raw tables for another engine.

The texts share one block of named subqueries that restates the model in SQL; nothing here is
produced from the Spark plans.
"""

from __future__ import annotations

# Brand number, fuel technology, group and renewable flag, stated once more independently.
MODEL = """
tech(brand, fueltech_id, fueltech_group, is_renewable) AS (VALUES
  (1, 'coal_black', 'coal', FALSE), (2, 'coal_brown', 'coal', FALSE),
  (3, 'gas_ccgt', 'gas', FALSE), (4, 'gas_ocgt', 'gas', FALSE), (5, 'gas_recip', 'gas', FALSE),
  (6, 'gas_steam', 'gas', FALSE), (7, 'gas_wcmg', 'gas', FALSE),
  (8, 'solar_rooftop', 'solar', TRUE), (9, 'solar_thermal', 'solar', TRUE), (10, 'solar_utility', 'solar', TRUE),
  (11, 'wind', 'wind', TRUE), (12, 'wind_offshore', 'wind', TRUE),
  (13, 'bioenergy_biogas', 'bioenergy', TRUE), (14, 'bioenergy_biomass', 'bioenergy', TRUE),
  (15, 'hydro', 'hydro', TRUE), (16, 'distillate', 'distillate', FALSE), (17, 'pumps', 'pumps', FALSE),
  (18, 'battery_charging', 'battery_charging', FALSE), (19, 'battery_discharging', 'battery_discharging', FALSE),
  (20, 'nuclear', NULL, NULL), (21, 'imports', NULL, NULL), (22, 'exports', NULL, NULL),
  (23, 'interconnector', NULL, NULL), (24, 'aggregator_vpp', NULL, NULL), (25, 'aggregator_dr', NULL, NULL)),
region_codes(r_name, code, long_name, short_name) AS (VALUES
  ('AFRICA', 'NSW1', 'New South Wales', 'NSW'), ('AMERICA', 'QLD1', 'Queensland', 'QLD'),
  ('ASIA', 'SA1', 'South Australia', 'SA'), ('EUROPE', 'TAS1', 'Tasmania', 'TAS'),
  ('MIDDLE EAST', 'VIC1', 'Victoria', 'VIC')),
registry AS (
  SELECT 'U' || p_partkey AS unit_code, 'F' || s_suppkey AS facility_code, s_name AS facility_name,
         CASE WHEN s_acctbal < 0 THEN 'WEM' ELSE 'NEM' END AS network_id, rc.code AS network_region,
         CAST(-20 - n_nationkey AS DOUBLE) AS lat, CAST(115 + n_nationkey AS DOUBLE) AS lng,
         t.fueltech_id, t.fueltech_group, t.is_renewable,
         CASE WHEN s_suppkey % 10 = 7 OR p_type = 'SMALL' THEN 'retired'
              WHEN p_type = 'PROMO' THEN 'committed' ELSE 'operating' END AS status_id,
         CASE WHEN t.fueltech_id IN ('battery_charging', 'pumps') THEN 'LOAD' ELSE 'GENERATOR' END AS dispatch_type,
         CAST(p_size AS DOUBLE) AS capacity_registered_mw, p_size * CAST(1.1 AS DOUBLE) AS capacity_maximum_mw,
         p_retailprice / 1000 AS emissions_factor_co2
  FROM part
  JOIN supplier ON s_suppkey = p_partkey % (SELECT max(s_suppkey) + 1 FROM supplier)
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN region_codes rc ON rc.r_name = region.r_name
  JOIN tech t ON t.brand = CAST(substr(p_brand, 7) AS INTEGER)),
units AS (SELECT * FROM registry WHERE network_id = 'NEM'),
lines AS (
  SELECT 'U' || l_partkey AS unit_code, CAST(l_shipdate AS DATE) AS d, l_orderkey * 10 + l_linenumber AS seq,
         CASE WHEN l_tax = 0 THEN NULL WHEN CAST(substr(p_brand, 7) AS INTEGER) = 18 THEN -l_quantity
              ELSE l_quantity END AS energy,
         l_quantity * l_discount AS emissions, l_extendedprice AS market_value
  FROM lineitem JOIN part ON p_partkey = l_partkey),
wide AS (
  SELECT d AS nem_date, network_region, fueltech_id, fueltech_group, is_renewable, sum(energy) AS generated_mwh,
         sum(emissions) AS emissions_tco2e, sum(market_value) AS market_value_aud
  FROM lines JOIN units USING (unit_code) GROUP BY ALL),
mix AS (
  SELECT nem_date, network_region, fueltech_group, sum(generated_mwh) AS generated_mwh FROM wide GROUP BY ALL),
share AS (
  SELECT *, CASE WHEN total_mwh <> 0 THEN renewable_mwh / total_mwh END AS renewable_share
  FROM (SELECT nem_date, network_region,
               coalesce(sum(generated_mwh) FILTER (WHERE is_renewable), 0) AS renewable_mwh,
               sum(generated_mwh) AS total_mwh
        FROM wide GROUP BY ALL)),
intensity AS (
  SELECT *, CASE WHEN generated_mwh <> 0 THEN emissions_tco2e / generated_mwh END AS emissions_intensity_tco2e_per_mwh
  FROM (SELECT nem_date, network_region, sum(emissions_tco2e) AS emissions_tco2e, sum(generated_mwh) AS generated_mwh
        FROM wide GROUP BY ALL)),
daily_points AS (
  SELECT unit_code, d, metric, CASE metric WHEN 'energy' THEN 'MWh' WHEN 'emissions' THEN 't' ELSE 'AUD' END AS uom,
         seq, CASE metric WHEN 'energy' THEN energy WHEN 'emissions' THEN emissions ELSE market_value END AS value
  FROM lines CROSS JOIN (VALUES ('energy'), ('emissions'), ('market_value')) AS m(metric)),
daily_latest AS (
  SELECT * FROM daily_points
  QUALIFY row_number() OVER (PARTITION BY unit_code, d, metric ORDER BY seq DESC, value DESC NULLS LAST) = 1),
event_points AS (
  SELECT 'U' || user_id AS unit_code, date_trunc('day', ts) AS at_day, event_id,
         CASE event_type WHEN 'view' THEN 'energy' WHEN 'click' THEN 'power' WHEN 'purchase' THEN 'market_value'
                         WHEN 'signup' THEN 'emissions' END AS metric,
         CASE event_type WHEN 'view' THEN 'MWh' WHEN 'click' THEN 'MW' WHEN 'purchase' THEN 'AUD'
                         WHEN 'signup' THEN 't' END AS uom, value
  FROM events),
event_latest AS (
  SELECT * FROM event_points WHERE metric IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY unit_code, at_day, metric ORDER BY event_id DESC, value DESC NULLS LAST) = 1),
daily_stored AS (
  SELECT unit_code, CAST(d AS TIMESTAMP) - INTERVAL 10 HOUR AS interval_ts_utc, metric, '1d' AS interval, value, uom,
         TIMESTAMP '1970-01-01' + seq * INTERVAL 1 SECOND AS ingested_at FROM daily_latest),
event_stored AS (
  SELECT unit_code, CAST(at_day AS TIMESTAMP) AS interval_ts_utc, metric, '5m' AS interval, value, uom,
         TIMESTAMP '1970-01-01' + event_id * INTERVAL 1 SECOND AS ingested_at FROM event_latest),
fac_daily AS (
  SELECT facility_code, facility_name, network_region, d AS nem_date,
         sum(value) FILTER (WHERE metric = 'energy') AS energy_mwh,
         sum(value) FILTER (WHERE metric = 'emissions') AS emissions_tco2e,
         sum(value) FILTER (WHERE metric = 'market_value') AS market_value_aud
  FROM daily_latest LEFT JOIN units USING (unit_code) GROUP BY ALL),
capacity AS (
  SELECT facility_code, sum(capacity_registered_mw) AS capacity_registered_mw,
         sum(capacity_registered_mw) FILTER (WHERE status_id = 'operating') AS capacity_registered_mw_operating
  FROM units GROUP BY ALL),
cf AS (
  SELECT f.facility_code, facility_name, network_region, nem_date, energy_mwh, capacity_registered_mw,
         capacity_registered_mw_operating,
         CASE WHEN capacity_registered_mw_operating <> 0
              THEN energy_mwh / (capacity_registered_mw_operating * 24) END AS capacity_factor,
         CASE WHEN capacity_registered_mw <> 0 THEN energy_mwh / (capacity_registered_mw * 24) END
           AS capacity_factor_all_units
  FROM fac_daily f LEFT JOIN capacity c ON c.facility_code = f.facility_code),
primary_groups AS (
  SELECT facility_code, fueltech_group FROM (
    SELECT facility_code, fueltech_group, sum(capacity_registered_mw) AS mw
    FROM units WHERE fueltech_group IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY facility_code ORDER BY mw DESC NULLS LAST, fueltech_group) = 1),
dimfac AS (
  SELECT u.*, p.fueltech_group AS primary_fueltech_group,
         p.fueltech_group IN ('solar', 'wind', 'hydro', 'bioenergy') AS is_renewable
  FROM (SELECT facility_code, facility_name, network_region,
               coalesce(array_to_string(list_sort(list(DISTINCT fueltech_group)
                          FILTER (WHERE fueltech_group IS NOT NULL)), ','), '') AS fueltech_groups,
               count(DISTINCT unit_code) AS unit_count, sum(capacity_registered_mw) AS capacity_registered_mw,
               sum(capacity_registered_mw) FILTER (WHERE status_id = 'operating') AS capacity_registered_mw_operating,
               min(lat) AS lat, min(lng) AS lng
        FROM units GROUP BY ALL) u
  LEFT JOIN primary_groups p USING (facility_code)),
demand AS (
  SELECT CAST(o_orderdate AS DATE) AS nem_date, rc.code AS network_region, sum(o_totalprice) AS price
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey JOIN region_codes rc ON rc.r_name = region.r_name GROUP BY ALL),
demand_long AS (
  SELECT nem_date, network_region, 'energy' AS metric, price / 1000 AS value, 'GWh' AS uom FROM demand
  UNION ALL SELECT nem_date, network_region, 'market_value', price, 'AUD' FROM demand),
series_long AS (
  SELECT nem_date, network_region, fueltech_id, fueltech_group, is_renewable, 'energy' AS metric,
         generated_mwh / 1000 AS generated, 'GWh' AS uom FROM wide
  UNION ALL SELECT nem_date, network_region, fueltech_id, fueltech_group, is_renewable, 'emissions',
         emissions_tco2e, 't' FROM wide
  UNION ALL SELECT nem_date, network_region, fueltech_id, fueltech_group, is_renewable, 'market_value',
         market_value_aud, 'AUD' FROM wide),
series_span AS (
  SELECT network_region, fueltech_id, fueltech_group, is_renewable, metric, uom,
         unnest(generate_series(min(nem_date), max(nem_date), INTERVAL 1 DAY))::DATE AS nem_date
  FROM series_long GROUP BY network_region, fueltech_id, fueltech_group, is_renewable, metric, uom, year(nem_date)),
series_gapped AS (
  SELECT s.nem_date, s.network_region, s.fueltech_id, s.fueltech_group, s.is_renewable, s.metric, l.generated, s.uom
  FROM series_span s LEFT JOIN series_long l USING (nem_date, network_region, fueltech_id, metric)),
demand_span AS (
  SELECT network_region, metric, uom,
         unnest(generate_series(min(nem_date), max(nem_date), INTERVAL 1 DAY))::DATE AS nem_date
  FROM demand_long GROUP BY network_region, metric, uom, year(nem_date)),
demand_gapped AS (
  SELECT s.nem_date, s.network_region, s.metric, l.value, s.uom
  FROM demand_span s LEFT JOIN demand_long l USING (nem_date, network_region, metric)),
assessed AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'NEEDS_REVIEW' WHEN quality = 1 THEN 'GOOD' ELSE 'BAD' END AS baseline,
         CASE WHEN quality = 1 THEN 'GOOD' ELSE 'BAD' END AS curated FROM labels),
pairs AS (
  SELECT conv_id, turn, question, answer FROM (
    SELECT conv_id, turn, role, text AS question,
           CASE WHEN lead(role) OVER by_turn = 'assistant' THEN lead(text) OVER by_turn END AS answer
    FROM conversations WINDOW by_turn AS (PARTITION BY conv_id ORDER BY turn, role, text)) WHERE role = 'user'),
usage AS (
  SELECT CAST(conv_id AS VARCHAR) AS conversation_id, conv_id || '-' || turn AS message_id, question,
         CASE WHEN length(answer) % 2 = 0 THEN answer END AS sql,
         coalesce(length(answer) % 4 = 0, FALSE) AS trusted, length(answer) AS latency_ms,
         CASE WHEN answer IS NULL THEN 'FAILED' ELSE 'COMPLETED' END AS status FROM pairs),
today AS (SELECT max(CAST(l_shipdate AS DATE)) AS d FROM lineitem)
"""

LAST_YEAR = "year(nem_date) = (SELECT year(d) - 1 FROM today)"


def since(days: int) -> str:
    return f"nem_date >= (SELECT d - {days} FROM today)"


def r(*columns: str) -> str:
    """Rounded columns: "expression AS name" or a plain column. See ``tidy_doubles`` for the nudge."""
    out = []
    for column in columns:
        expression, _, name = column.partition(" AS ")
        out.append(f"round({expression} + 3e-10, 6) + 0.0 AS {name or expression}")
    return ", ".join(out)


FACILITY = "facility_code, facility_name, network_region"
CF_COLUMNS = r(
    "energy_mwh",
    "capacity_registered_mw",
    "capacity_registered_mw_operating",
    "capacity_factor",
    "capacity_factor_all_units",
)
DIMFAC = (
    f"SELECT {FACILITY}, primary_fueltech_group, fueltech_groups, is_renewable, unit_count, "
    f"{r('capacity_registered_mw', 'capacity_registered_mw_operating', 'lat', 'lng')} FROM dimfac"
)
DIM_UNIT = (
    "SELECT unit_code, facility_code, facility_name, network_id, network_region, fueltech_id, fueltech_group, "
    "is_renewable, status_id, dispatch_type, "
    f"{r('lat', 'lng', 'capacity_registered_mw', 'capacity_maximum_mw', 'emissions_factor_co2')} FROM units"
)
POINT = f"unit_code, interval_ts_utc, metric, interval, {r('value')}, uom, ingested_at"
SERIES = "nem_date, network_region, fueltech_id, fueltech_group, is_renewable, metric, uom"
SHARE = f"nem_date, network_region, {r('renewable_mwh', 'total_mwh', 'renewable_share')}"
MIX_LAST_YEAR = (
    "SELECT fueltech_group, {total} FROM mix WHERE network_region = '{region}' AND " + LAST_YEAR + " GROUP BY 1"
)
MEASURES = r(
    "sum(generated_mwh) AS total_generated_mwh",
    "CASE WHEN sum(generated_mwh) <> 0 THEN coalesce(sum(generated_mwh) FILTER (WHERE is_renewable), 0) "
    "/ sum(generated_mwh) END AS renewable_share",
    "CASE WHEN sum(generated_mwh) <> 0 THEN sum(emissions_tco2e) / sum(generated_mwh) END "
    "AS emissions_intensity_tco2e_per_mwh",
)
WINDOW_SHARE = (
    f"SELECT {r('avg(renewable_share) AS avg_renewable_share')} FROM share WHERE network_region = 'SA1' "
    "AND nem_date BETWEEN (SELECT min(nem_date) FROM fac_daily) AND (SELECT max(nem_date) FROM fac_daily)"
)
SHARE_LAST_YEAR = (
    f"SELECT network_region, {r('avg(renewable_share) AS avg_renewable_share')} FROM share WHERE {LAST_YEAR} GROUP BY 1"
)
MEAN_CF = r("avg(capacity_factor) AS avg_capacity_factor")
TOTAL = r("sum(generated_mwh) AS total_mwh")
KEYED = """
SELECT 'dim_facility' AS tbl, count(*) AS n, count(*) FILTER (WHERE facility_code IS NULL) AS null_key_rows FROM dimfac
UNION ALL SELECT 'facility_capacity_factor', count(*), count(*) FILTER (WHERE facility_code IS NULL OR nem_date IS NULL) FROM cf
"""

TEXTS = {
    "dim_unit": DIM_UNIT,
    "generation_daily_by_fueltech": f"SELECT {SERIES}, {r('generated')} FROM series_long",
    "demand_daily": f"SELECT nem_date, network_region, metric, {r('value')}, uom FROM demand_long",
    "generation_daily_wide": (
        "SELECT nem_date, network_region, fueltech_id, fueltech_group, is_renewable, "
        f"{r('generated_mwh', 'emissions_tco2e', 'market_value_aud')} FROM wide"
    ),
    "generation_mix_daily": f"SELECT nem_date, network_region, fueltech_group, {r('generated_mwh')} FROM mix",
    "renewable_share_daily": f"SELECT {SHARE} FROM share",
    "emissions_intensity_daily": (
        "SELECT nem_date, network_region, "
        f"{r('emissions_tco2e', 'generated_mwh', 'emissions_intensity_tco2e_per_mwh')} FROM intensity"
    ),
    "facility_daily": (
        f"SELECT {FACILITY}, nem_date, {r('energy_mwh', 'emissions_tco2e', 'market_value_aud')} FROM fac_daily"
    ),
    "facility_capacity_factor": f"SELECT {FACILITY}, nem_date, {CF_COLUMNS} FROM cf",
    "dim_facility": DIMFAC,
    "demand_vs_generation": (
        "SELECT nem_date, network_region, "
        + r("price AS demand_mwh", "g AS generated_mwh", "CASE WHEN price <> 0 THEN g / price END AS generation_to_demand")
        + " FROM demand FULL JOIN (SELECT nem_date, network_region, sum(generated_mwh) AS g FROM mix GROUP BY ALL) "
        "USING (nem_date, network_region)"
    ),
    "registry_roundtrip": DIM_UNIT,
    "registry_ingest_stream": DIM_UNIT,
    "registry_codes": "SELECT DISTINCT facility_code FROM units",
    "stats_roundtrip": f"SELECT {SERIES}, {r('generated')} FROM series_gapped",
    "demand_daily_roundtrip": f"SELECT nem_date, network_region, metric, {r('value')}, uom FROM demand_gapped",
    "unit_metrics_roundtrip": f"SELECT {POINT} FROM daily_stored",
    "stats_ingest_stream": (
        "SELECT nem_date, network_region, fueltech_group, "
        + r("sum(CASE WHEN metric = 'energy' THEN generated * 1000 END) AS generated_mwh")
        + " FROM series_gapped GROUP BY 1, 2, 3"
    ),
    "unit_files_ingest_stream": (
        f"SELECT unit_code, interval_ts_utc, metric, interval, {r('value')}, uom, "
        "TIMESTAMP '1970-01-01' + fetches * INTERVAL 1 DAY AS ingested_at FROM daily_stored "
        "JOIN (SELECT unit_code AS u, CAST(d AS TIMESTAMP) - INTERVAL 10 HOUR AS t, CAST(count(*) // 3 AS INTEGER) AS fetches "
        "FROM daily_points GROUP BY ALL) ON u = unit_code AND t = interval_ts_utc"
    ),
    "series_restart": f"SELECT {SERIES}, {r('generated')} FROM series_gapped",
    "quarantined_files": (
        "SELECT '/landing/stats/doc=' || doc_id || '.json' AS source_file, "
        "TIMESTAMP '1970-01-01' + CAST(doc_id AS INTEGER) * INTERVAL 1 SECOND AS ingested_at, "
        "CASE WHEN doc_id % 10 = 0 OR trim(text) = '' THEN 'empty file' ELSE 'no readable data array' END AS reason FROM documents"
    ),
    "stored_mix": f"SELECT nem_date, network_region, fueltech_group, {r('generated_mwh')} FROM mix",
    "scd1_batch": f"SELECT {POINT} FROM (SELECT * FROM daily_stored UNION ALL SELECT * FROM event_stored)",
    "scd1_stream": f"SELECT {POINT} FROM event_stored",
    "stats_stream": f"SELECT {SERIES}, {r('generated')} FROM series_gapped",
    "unit_metrics_stream": f"SELECT {POINT} FROM daily_stored",
    "latest_price_by_part": (
        f"SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, {r('l_extendedprice')} FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_partkey "
        "ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1"
    ),
    "rules_kept": (
        "SELECT unit_code, at_day::TIMESTAMP AS interval_ts_utc, '5m' AS interval, "
        f"TIMESTAMP '1970-01-01' + event_id * INTERVAL 1 SECOND AS ingested_at, metric, {r('value')}, uom "
        "FROM event_points WHERE metric IS NOT NULL"
    ),
    "rules_rejected": (
        "SELECT unit_code, at_day::TIMESTAMP AS interval_ts_utc, '5m' AS interval, "
        f"TIMESTAMP '1970-01-01' + event_id * INTERVAL 1 SECOND AS ingested_at, metric, {r('value')}, uom, "
        "'valid_metric' AS broken_rules FROM event_points WHERE metric IS NULL"
    ),
    "rules_rejected_counts": """
WITH p AS (SELECT unit_code, metric, value FROM daily_points UNION ALL SELECT unit_code, metric, value FROM event_points)
SELECT 'valid_unit_code' AS rule, 'drop' AS action, count(*) AS passed, CAST(0 AS BIGINT) AS failed FROM p
UNION ALL SELECT 'valid_ts', 'drop', count(*), 0 FROM p
UNION ALL SELECT 'valid_metric', 'drop', count(metric), count(*) FILTER (WHERE metric IS NULL) FROM p
UNION ALL SELECT 'known_energy_unit', 'drop', count(*), 0 FROM p
UNION ALL SELECT 'non_negative_value', 'warn', count(*) FILTER (WHERE value IS NULL OR value >= 0), count(*) FILTER (WHERE value < 0) FROM p
""",
    "series_rule_counts": """
SELECT 'valid_key' AS rule, 'drop' AS action, 2 * (SELECT count(*) FROM series_gapped) AS passed,
       2 * (SELECT count(*) FROM demand_gapped) AS failed
UNION ALL SELECT 'known_energy_unit', 'drop',
       2 * ((SELECT count(*) FROM series_gapped) + (SELECT count(*) FROM demand_gapped)), CAST(0 AS BIGINT)
""",
    "pk_violations": (
        "SELECT facility_code, nem_date, count(*) AS n FROM cf GROUP BY 1, 2 "
        "HAVING count(*) > 1 OR facility_code IS NULL OR nem_date IS NULL"
    ),
    "key_counts": KEYED,
    "reconcile_counts": (
        f"SELECT tbl, n AS source_rows, null_key_rows, n - null_key_rows AS copy_rows, TRUE AS ok FROM ({KEYED})"
    ),
    "snapshot_publish": f"SELECT {FACILITY}, nem_date, {CF_COLUMNS} FROM cf WHERE facility_code IS NOT NULL",
    "snapshot_lookup": """
SELECT facility_code, unit_count,
       CASE WHEN fueltech_groups = '' THEN '[]' ELSE '["' || replace(fueltech_groups, ',', '","') || '"]' END
         AS fueltech_groups FROM dimfac WHERE list_contains(string_split(fueltech_groups, ','), 'wind')
""",
    "csv_export": """
SELECT facility_code, facility_name, unit_count,
       CASE WHEN fueltech_groups = '' THEN '[]' ELSE '["' || replace(fueltech_groups, ',', '","') || '"]' END
         AS fueltech_groups FROM dimfac
""",
    "last_rows_each": (
        f"SELECT facility_code, nem_date, {r('energy_mwh', 'capacity_factor')} FROM cf WHERE facility_code IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY facility_code ORDER BY nem_date DESC) <= 7"
    ),
    "coverage_report": " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS n, min(nem_date) AS first_day, max(nem_date) AS last_day FROM {rel}"
        for mart, rel in {
            "generation_mix_daily": "mix",
            "renewable_share_daily": "share",
            "emissions_intensity_daily": "intensity",
            "facility_daily": "fac_daily",
            "facility_capacity_factor": "cf",
        }.items()
    ),
    "status_distribution": "SELECT status_id, count(*) AS n FROM units GROUP BY 1",
    "unattributed_days": f"SELECT count(*) AS days, {r('sum(energy_mwh) AS energy_mwh')} FROM fac_daily WHERE facility_code IS NULL",
    "landing_gaps": """
SELECT code AS region, CAST(y AS INTEGER) AS year FROM region_codes,
  generate_series((SELECT min(year(o_orderdate)) - 2 FROM orders), (SELECT max(year(l_shipdate)) + 2 FROM lineitem)) AS g(y)
WHERE (code, y) NOT IN (SELECT (network_region, year(nem_date)) FROM series_long
                        UNION SELECT (network_region, year(nem_date)) FROM demand_long)
""",
    "chunk_gaps": """
WITH g AS (SELECT unnest(['1d', '5m']) AS interval, n
           FROM generate_series(0, (SELECT (count(DISTINCT facility_code) + 29) // 30 - 1 FROM units)) AS s(n)),
landed AS (SELECT DISTINCT l_partkey % (SELECT max(s_suppkey) + 1 FROM supplier) // 30 AS n FROM lineitem)
SELECT interval, CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS chunk FROM g
WHERE interval = '5m' OR n NOT IN (SELECT n FROM landed)
""",
    "metric_layer": f"SELECT network_region, CAST(year(nem_date) AS INTEGER) AS yr, {MEASURES} FROM wide GROUP BY 1, 2",
    "metric_layer_total": f"SELECT fueltech_group, {MEASURES} FROM wide GROUP BY 1",
    "facility_metric_layer": (
        "SELECT network_region, "
        + r(
            "sum(energy_mwh) AS total_energy_mwh",
            "sum(energy_mwh) FILTER (WHERE capacity_factor IS NOT NULL) "
            "/ sum(capacity_registered_mw_operating * 24) FILTER (WHERE capacity_factor IS NOT NULL) "
            "AS weighted_capacity_factor",
        )
        + " FROM cf GROUP BY 1"
    ),
    "capacity_factor_between": (
        f"SELECT facility_code, facility_name, nem_date, {r('energy_mwh', 'capacity_factor', 'capacity_factor_all_units')} "
        "FROM cf WHERE facility_code = 'F5' AND nem_date BETWEEN DATE '1997-03-01' AND DATE '1997-12-31'"
    ),
    "region_mix": (
        f"SELECT fueltech_group, {TOTAL} FROM mix WHERE network_region = 'TAS1' "
        "AND nem_date BETWEEN DATE '1996-07-01' AND DATE '1999-06-30' GROUP BY 1"
    ),
    "renewable_share_strict": f"""
SELECT {SHARE} FROM (
  SELECT *, CASE WHEN total_mwh <> 0 THEN renewable_mwh / total_mwh END AS renewable_share FROM (
    SELECT nem_date, network_region, sum(generated_mwh) AS total_mwh,
           CASE WHEN count(*) FILTER (WHERE is_renewable) > 0 THEN sum(generated_mwh) FILTER (WHERE is_renewable) ELSE 0 END
             AS renewable_mwh FROM wide GROUP BY 1, 2))
""",
    "record_days": f"""
SELECT nem_date, {r('t AS total_mwh')} FROM (
  SELECT nem_date, t, rank() OVER (ORDER BY t DESC NULLS LAST) AS rk
  FROM (SELECT nem_date, sum(generated_mwh) AS t FROM mix GROUP BY 1)) WHERE rk <= 3
""",
    "canonicalise_region": """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN code WHEN 1 THEN long_name WHEN 2 THEN short_name
                       WHEN 3 THEN '  ' || upper(long_name) ELSE 'Territory' END AS region_text,
       CASE WHEN c_custkey % 5 < 4 THEN code END AS network_region
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
JOIN region_codes USING (r_name)
""",
    "unmatched_regions": (
        "SELECT 'Territory' AS region_text, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey "
        "JOIN region ON r_regionkey = n_regionkey JOIN region_codes USING (r_name) WHERE c_custkey % 5 = 4"
    ),
    "result_compare": """
WITH e AS (SELECT fueltech_group FROM mix)
SELECT 'reshaped' AS answer, 'GOOD' AS verdict, count(*) AS expected_rows, count(*) AS actual_rows,
       CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows, count(*) > 5000 AS over_cap FROM e
UNION ALL SELECT 'mapped_only', 'BAD', count(*), count(fueltech_group), count(*) - count(fueltech_group), 0,
       count(*) > 5000 FROM e
""",
    "score_run": " UNION ALL ".join(
        f"SELECT '{run}' AS eval_run_id, count(*) AS num_questions, count(*) FILTER (WHERE {run} = 'GOOD') AS num_correct, "
        f"count(*) FILTER (WHERE {run} = 'NEEDS_REVIEW') AS num_needs_review, count(*) FILTER (WHERE {run} = 'BAD') AS num_wrong FROM assessed"
        for run in ("baseline", "curated")
    ),
    "score_delta": """
SELECT baseline AS before, curated AS after, count(*) AS n,
       CASE WHEN baseline = curated THEN 'same' WHEN curated = 'GOOD' THEN 'up'
            WHEN baseline = 'NEEDS_REVIEW' THEN 'down' ELSE 'up' END AS direction
FROM assessed GROUP BY 1, 2
""",
    "turn_pairs": "SELECT conv_id, turn, question, answer FROM pairs",
    "conversation_usage": "SELECT conversation_id, message_id, question, sql, trusted, latency_ms, status FROM usage",
    "usage_summary": (
        "SELECT status, trusted, count(*) AS questions, count(sql) AS with_sql, "
        f"{r('avg(latency_ms) AS avg_latency_ms')} FROM usage GROUP BY 1, 2"
    ),
    "stale_conversations": """
WITH c AS (SELECT user_id AS conversation_id, min(ts) AS created, max(ts) AS last_updated FROM events GROUP BY 1)
SELECT conversation_id, created, last_updated,
       last_updated < (SELECT max(ts) - INTERVAL 24 HOUR FROM events) AS stale FROM c
""",
    "scd1_stateful": f"SELECT {POINT} FROM event_stored",
    "evolved_points": (
        "SELECT unit_code, interval_ts_utc, metric, interval, "
        + r("CASE WHEN second(ingested_at) % 2 = 0 THEN floor(value) ELSE value END AS value")
        + ", CASE WHEN second(ingested_at) % 2 = 1 THEN uom END AS uom, ingested_at FROM event_stored"
    ),
    "replayed_points": f"""
WITH large AS (SELECT * FROM event_points WHERE metric IS NOT NULL AND value >= 10
  QUALIFY row_number() OVER (PARTITION BY unit_code, at_day, metric ORDER BY event_id DESC, value DESC) = 1)
SELECT unit_code, CAST(at_day AS TIMESTAMP) AS interval_ts_utc, metric, '5m' AS interval, {r('value')}, uom,
       TIMESTAMP '1970-01-01' + event_id * INTERVAL 1 SECOND AS ingested_at FROM large
""",
    "expired_points": f"SELECT {POINT} FROM event_stored",
    "stream_rule_totals": """
SELECT 'valid_unit_code' AS rule, count(*) AS passed, CAST(0 AS BIGINT) AS failed FROM event_points
UNION ALL SELECT 'valid_ts', count(*), 0 FROM event_points
UNION ALL SELECT 'valid_metric', count(metric), count(*) - count(metric) FROM event_points
UNION ALL SELECT 'known_energy_unit', count(*), 0 FROM event_points
UNION ALL SELECT 'non_negative_value', count(*) FILTER (WHERE value IS NULL OR value >= 0), count(*) FILTER (WHERE value < 0) FROM event_points
""",
    "unknown_fields": """
SELECT 'facilities' AS family, path, declared, found, n AS files, n AS times FROM (
  SELECT 'data[].owner' AS path, NULL AS declared, 'object' AS found, count(*) AS n FROM registry WHERE network_id = 'WEM'
  UNION ALL SELECT 'data[].units[].storage_mwh', NULL, 'number', count(*) FROM registry WHERE capacity_registered_mw > 40
  UNION ALL SELECT 'data[].units[].capacity_registered', 'number', 'text', count(*) FROM registry WHERE capacity_registered_mw % 7 = 0)
WHERE n > 0
""",
    "units_listed_twice": (
        "SELECT unit_code, f || substr(facility_code, 2) AS facility_code, " + r("capacity_registered_mw")
        + " FROM units, (VALUES ('F'), ('G')) AS v(f) WHERE CAST(substr(unit_code, 2) AS BIGINT) % 5 = 0"
    ),
    "spans_covering_days": f"""
WITH spans AS (SELECT rc.code, CAST(o_orderdate AS DATE) AS opened, o_totalprice,
    CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 200 = 0 THEN 1000 ELSE o_orderkey % 10 END AS INTEGER) AS closed
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey JOIN region_codes rc ON rc.r_name = region.r_name)
SELECT network_region, nem_date, count(*) AS open_orders, {r('sum(o_totalprice) AS open_price')}
FROM share JOIN spans ON code = network_region AND nem_date BETWEEN opened AND closed GROUP BY 1, 2
""",
    "implausible_days": f"""
WITH months AS (SELECT DISTINCT network_region, date_trunc('month', nem_date) AS month FROM share),
earlier AS (SELECT m.network_region, m.month, list_sort(list(s.total_mwh)) AS x FROM months m
  JOIN share s ON s.network_region = m.network_region AND s.nem_date < m.month WHERE s.total_mwh IS NOT NULL GROUP BY 1, 2),
quartiles AS (SELECT network_region, month, len(x) AS n, x[CAST(ceil(len(x) * 0.25) AS INTEGER)] AS q25, x[CAST(ceil(len(x) * 0.75) AS INTEGER)] AS q75
  FROM earlier WHERE len(x) >= 60),
bands AS (SELECT network_region, month, n AS n_earlier, q25 - 3 * (q75 - q25) AS low, q75 + 3 * (q75 - q25) AS high FROM quartiles)
SELECT s.network_region, s.nem_date, {r('total_mwh', 'low', 'high')}, n_earlier
FROM share s JOIN bands b ON b.network_region = s.network_region AND b.month = date_trunc('month', s.nem_date)
WHERE NOT total_mwh BETWEEN low AND high
""",
    "metric_layer_from_parts": f"SELECT network_region, CAST(year(nem_date) AS INTEGER) AS yr, {MEASURES} FROM wide GROUP BY 1, 2",
    "metric_layer_total_from_parts": f"SELECT fueltech_group, {MEASURES} FROM wide GROUP BY 1",
    "capacity_factor_sql": (
        f"SELECT facility_code, facility_name, nem_date, {r('energy_mwh', 'capacity_factor', 'capacity_factor_all_units')} "
        "FROM cf WHERE facility_code = 'F5' AND nem_date BETWEEN DATE '1997-03-01' AND DATE '1997-12-31'"
    ),
    "region_mix_sql": (
        f"SELECT fueltech_group, {TOTAL} FROM mix WHERE network_region = 'TAS1' "
        "AND nem_date BETWEEN DATE '1996-07-01' AND DATE '1999-06-30' GROUP BY 1"
    ),
    "region_measures_sql": (
        f"SELECT network_region, {MEASURES} FROM wide WHERE nem_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY 1"
    ),
    "result_compare_numbers": """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber = 7) AS d, count(*) > 5000 AS over_cap FROM lineitem)
SELECT answer, CASE WHEN same OR d = 0 THEN 'GOOD' ELSE 'BAD' END AS verdict, n AS expected_rows, n AS actual_rows,
       CASE WHEN same THEN 0 ELSE d END AS missing_rows, CASE WHEN same THEN 0 ELSE d END AS extra_rows, over_cap
FROM n, (VALUES ('edge', TRUE), ('cent', FALSE), ('big', FALSE), ('decimal', FALSE)) AS v(answer, same)
""",
    "run_results": " UNION ALL ".join(
        f"SELECT '{run}' AS eval_run_id, doc_id // 1000 + 1 AS created_timestamp, '{run}-' || doc_id AS result_id, "
        f"CAST(doc_id AS VARCHAR) AS benchmark_question_id, 'DONE' AS status, {run} AS assessment, {run} = 'NEEDS_REVIEW' AS manual_assessment FROM assessed"
        for run in ("baseline", "curated")
    ),
    "message_details": """
WITH a AS (SELECT *, length(answer) AS size, length(answer) % 2 = 0 AS is_query FROM pairs)
SELECT 'space-' || conv_id % 3 AS space_id, CAST(conv_id AS VARCHAR) AS conversation_id, conv_id || '-' || turn AS message_id,
       CASE WHEN is_query THEN 'answers ' || substr(question, 1, 20) END AS description,
       CASE WHEN size % 8 = 0 THEN 'Asset ' || conv_id WHEN size % 4 = 0 THEN 'asset-' || conv_id END AS trusted_asset,
       CAST(NULL AS VARCHAR) AS statement_id, CASE WHEN is_query THEN size END AS row_count, CASE WHEN is_query THEN size > 300 END AS is_truncated,
       CASE WHEN NOT is_query THEN answer END AS text, CASE WHEN NOT is_query THEN 1 ELSE 0 END AS suggestions,
       CASE WHEN answer IS NULL THEN 'TIMEOUT' END AS error_type, CASE WHEN answer IS NULL THEN 'no answer' END AS error FROM a
""",
    "column_profile": " UNION ALL ".join(
        f"SELECT 'facility_daily' AS table_name, {i} AS position, '{c}' AS column_name, '{t}' AS data_type, '{st}' AS serving_type, "
        f"count(*) AS n_rows, count(*) - count({c}) AS n_null FROM fac_daily"
        for i, (c, t, st) in enumerate(
            [
                ("facility_code", "string", "text"),
                ("facility_name", "string", "text"),
                ("network_region", "string", "text"),
                ("nem_date", "date", "date"),
                *((c, "double", "double precision") for c in ("energy_mwh", "emissions_tco2e", "market_value_aud")),
            ]
        )
    ),
    "catalog_table": DIMFAC,
    "q01": MIX_LAST_YEAR.format(total=TOTAL, region="NSW1"),
    "q02": (
        f"SELECT network_region, {r('sum(generated_mwh) AS wind_mwh')} FROM mix "
        f"WHERE fueltech_group = 'wind' AND {LAST_YEAR} GROUP BY 1"
    ),
    "q03": (
        f"SELECT yr, {r('c AS coal_mwh', 't AS total_mwh', 'CASE WHEN t <> 0 THEN c / t END AS coal_share')} FROM ("
        "SELECT CAST(year(nem_date) AS INTEGER) AS yr, "
        "sum(CASE WHEN fueltech_group = 'coal' THEN generated_mwh ELSE 0 END) AS c, sum(generated_mwh) AS t "
        "FROM mix WHERE network_region = 'VIC1' AND year(nem_date) IN (1996, 2000) GROUP BY 1)"
    ),
    "q04": MIX_LAST_YEAR.format(total=TOTAL, region="SA1"),
    "q05": SHARE_LAST_YEAR,
    "q06": (
        f"SELECT nem_date, {r('renewable_share')} FROM share WHERE network_region = 'TAS1' AND {since(1825)} "
        "AND renewable_share IS NOT NULL ORDER BY share.renewable_share DESC, nem_date LIMIT 1"
    ),
    "q07": (
        f"SELECT CAST(year(nem_date) AS INTEGER) AS yr, {r('avg(renewable_share) AS avg_renewable_share')} FROM share "
        "WHERE network_region = 'SA1' AND year(nem_date) BETWEEN 1996 AND 2000 GROUP BY 1"
    ),
    "q08": (
        f"SELECT network_region, {r('avg(emissions_intensity_tco2e_per_mwh) AS avg_intensity')} FROM intensity "
        f"WHERE {LAST_YEAR} GROUP BY 1"
    ),
    "q09": (
        "SELECT CAST(year(nem_date) AS INTEGER) AS yr, "
        f"{r('avg(emissions_intensity_tco2e_per_mwh) AS avg_intensity')} FROM intensity "
        "WHERE network_region = 'QLD1' AND year(nem_date) BETWEEN 1997 AND 2001 GROUP BY 1"
    ),
    "q10": (
        f"SELECT {FACILITY}, {r('t AS total_mwh')} FROM (SELECT {FACILITY}, sum(energy_mwh) AS t FROM fac_daily "
        f"WHERE {since(30)} GROUP BY ALL) ORDER BY t DESC NULLS LAST, facility_code NULLS LAST LIMIT 10"
    ),
    "q11": (
        f"SELECT {FACILITY}, {r('t AS total_market_value_aud')} FROM (SELECT {FACILITY}, sum(market_value_aud) AS t "
        f"FROM fac_daily WHERE {since(90)} GROUP BY ALL) ORDER BY t DESC NULLS LAST, facility_code NULLS LAST LIMIT 10"
    ),
    "q12": (
        f"SELECT facility_code, facility_name, {r('sum(energy_mwh) AS total_mwh')} FROM fac_daily "
        f"WHERE network_region = 'NSW1' AND {since(30)} GROUP BY 1, 2"
    ),
    "q13": (
        f"SELECT {FACILITY}, {r('a AS avg_capacity_factor')} FROM (SELECT {FACILITY}, avg(capacity_factor) AS a FROM cf "
        f"WHERE {since(30)} AND capacity_factor IS NOT NULL GROUP BY ALL) ORDER BY a DESC, facility_code LIMIT 10"
    ),
    "q14": (
        f"SELECT network_region, {MEAN_CF} FROM cf WHERE {since(90)} AND capacity_factor IS NOT NULL GROUP BY 1"
    ),
    "q15": (
        f"SELECT {FACILITY}, {r('a AS avg_capacity_factor')}, days FROM (SELECT {FACILITY}, avg(capacity_factor) AS a, "
        f"count(*) AS days FROM cf WHERE {since(30)} AND capacity_factor IS NOT NULL GROUP BY ALL HAVING count(*) >= 5) "
        "ORDER BY a, facility_code LIMIT 5"
    ),
    "q16": WINDOW_SHARE,
    "q17": (
        f"SELECT {r('sum(market_value_aud) AS total_market_value_aud')} FROM fac_daily "
        f"WHERE network_region = 'SA1' AND {since(30)}"
    ),
    "q18": "SELECT DISTINCT network_region FROM mix",
    "q19": (
        f"SELECT nem_date, {r('t AS total_mwh')} FROM (SELECT nem_date, sum(generated_mwh) AS t FROM mix "
        "WHERE network_region = 'QLD1' GROUP BY 1) ORDER BY t DESC NULLS LAST, nem_date LIMIT 1"
    ),
    "q20": (
        f"SELECT nem_date, fueltech_group, {r('generated_mwh')} FROM mix "
        f"WHERE network_region = 'NSW1' AND {since(90)} AND generated_mwh < 0"
    ),
    "e01": (
        f"SELECT d.facility_code, d.facility_name, {MEAN_CF} FROM cf JOIN dimfac d ON d.facility_code = cf.facility_code "
        f"WHERE primary_fueltech_group = 'wind' AND cf.network_region = 'SA1' AND {since(30)} "
        "AND capacity_factor IS NOT NULL GROUP BY 1, 2"
    ),
    "e02": (
        f"SELECT CAST(year(nem_date) AS INTEGER) AS yr, {r('sum(generated_mwh) AS coal_mwh')} FROM mix "
        "WHERE network_region = 'VIC1' AND fueltech_group = 'coal' GROUP BY 1"
    ),
    "e03": SHARE_LAST_YEAR,
    "e04": (
        f"SELECT facility_code, facility_name, network_region, {r('a AS avg_capacity_factor')} FROM ("
        "SELECT d.facility_code, d.facility_name, d.network_region, avg(capacity_factor) AS a "
        "FROM cf JOIN dimfac d ON d.facility_code = cf.facility_code WHERE primary_fueltech_group = 'solar' "
        "AND capacity_factor IS NOT NULL GROUP BY 1, 2, 3) ORDER BY a DESC, facility_code LIMIT 10"
    ),
    "e05": WINDOW_SHARE,
    "e06": (
        "SELECT facility_code, facility_name, primary_fueltech_group, fueltech_groups, unit_count FROM dimfac "
        "WHERE facility_name = 'Supplier#000000003'"
    ),
    "e07": MIX_LAST_YEAR.format(total=TOTAL, region="NSW1"),
    "e08": (
        "SELECT CAST(year(nem_date) AS INTEGER) AS yr, "
        f"{r('avg(emissions_intensity_tco2e_per_mwh) AS avg_intensity')} FROM intensity "
        f"WHERE network_region = 'QLD1' AND {since(1825)} GROUP BY 1"
    ),
    "e09": (
        f"SELECT {r('sum(market_value_aud) AS total_market_value_aud')} FROM fac_daily "
        f"WHERE network_region = 'VIC1' AND {since(30)}"
    ),
    "e10": (
        f"SELECT facility_code, facility_name, nem_date, {r('energy_mwh')} FROM fac_daily WHERE energy_mwh < 0 "
        f"AND {since(30)} ORDER BY nem_date DESC, facility_code NULLS LAST LIMIT 20"
    ),
    "l0": (
        f"SELECT {FACILITY}, primary_fueltech_group, {r('capacity_registered_mw')} FROM dimfac "
        "ORDER BY dimfac.capacity_registered_mw DESC NULLS LAST, facility_code LIMIT 3"
    ),
    "l1": f"{DIMFAC} WHERE facility_code = 'F3'",
    "l2": (
        f"SELECT nem_date, {r('energy_mwh', 'capacity_factor')} FROM cf WHERE facility_code = 'F3' "
        "ORDER BY nem_date DESC LIMIT 7"
    ),
    "l3": (
        "SELECT facility_code, facility_name, fueltech_groups FROM dimfac "
        "WHERE list_contains(string_split(fueltech_groups, ','), 'battery_discharging') "
        "ORDER BY facility_name, facility_code LIMIT 20"
    ),
    "l4": (
        "SELECT CAST(year(nem_date) AS INTEGER) AS yr, "
        f"{r('CASE WHEN sum(total_mwh) <> 0 THEN sum(renewable_mwh) / sum(total_mwh) END AS renewable_share')} "
        "FROM share WHERE network_region = 'SA1' AND year(nem_date) IN (1996, 2000) GROUP BY 1"
    ),
    "record_day_by_rank": (
        f"SELECT nem_date, network_region, {r('total_mwh')} FROM (SELECT *, rank() OVER (ORDER BY total_mwh DESC) AS rnk "
        "FROM share WHERE network_region LIKE 'QLD%' AND total_mwh IS NOT NULL) AS ranked WHERE rnk = 1"
    ),
    "best_day_in_sixty_months": (
        f"SELECT nem_date, network_region, {r('renewable_share')} FROM (SELECT *, "
        "rank() OVER (ORDER BY renewable_share DESC) AS rnk FROM share WHERE network_region ILIKE '%tas%' "
        "AND nem_date >= (SELECT d - INTERVAL 60 MONTH FROM today) AND renewable_share IS NOT NULL) AS ranked WHERE rnk = 1"
    ),
    "intensity_by_truncated_year": (
        "SELECT CAST(date_trunc('year', nem_date) AS DATE) AS calendar_year, "
        f"{r('avg(emissions_intensity_tco2e_per_mwh) AS avg_intensity')} FROM intensity "
        "WHERE lower(network_region) LIKE '%qld%' AND year(nem_date) BETWEEN 1997 AND 2001 GROUP BY 1"
    ),
    "wind_leader": (
        f"SELECT network_region, {r('w AS wind_mwh')} FROM (SELECT network_region, sum(generated_mwh) AS w, "
        "rank() OVER (ORDER BY sum(generated_mwh) DESC) AS rnk FROM mix "
        f"WHERE fueltech_group ILIKE '%wind%' AND {LAST_YEAR} GROUP BY 1) WHERE rnk = 1"
    ),
    "region_count_and_set": (
        "SELECT count(DISTINCT network_region) AS region_count, "
        "array_to_string(list_sort(list(DISTINCT network_region)), ',') AS region_codes FROM mix"
    ),
    "coal_share_percent": (
        f"SELECT yr, {r('c AS coal_mwh', 't AS total_mwh', 'CASE WHEN t <> 0 THEN 100 * (c / t) END AS coal_share_percent')} "
        "FROM (SELECT CAST(year(nem_date) AS INTEGER) AS yr, "
        "sum(CASE WHEN fueltech_group ILIKE '%coal%' THEN generated_mwh ELSE 0 END) AS c, sum(generated_mwh) AS t "
        "FROM mix WHERE network_region ILIKE '%VIC%' GROUP BY 1)"
    ),
    "lowest_factors_of_the_last_month": (
        f"SELECT facility_code, facility_name, days_with_data, {r('a AS avg_capacity_factor')} FROM ("
        "SELECT facility_code, facility_name, count(capacity_factor) AS days_with_data, avg(capacity_factor) AS a FROM cf "
        "WHERE nem_date BETWEEN (SELECT max(nem_date) - 29 FROM cf) AND (SELECT max(nem_date) FROM cf) GROUP BY 1, 2) "
        "WHERE days_with_data >= 5 AND facility_code IS NOT NULL ORDER BY a, facility_code LIMIT 5"
    ),
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, text in TEXTS.items():
        text = text.strip()
        if text.startswith("WITH "):
            out[name] = f"WITH {MODEL.strip()},\n{text[5:]}"
        else:
            out[name] = f"WITH {MODEL.strip()}\n{text}"
    return out
