"""The registered queries once more, as SQL for another engine.

Written from the definitions, not from the Spark code: the trips are derived in
SQL again, and rules and marts are plain SQL over them.
"""

from __future__ import annotations

from fleetlake.checks.queries import MONTH, RULE_QUERIES, YEAR
from fleetlake.sources.sample_trips import FOCUS_RANGE, LIMITS

_AMOUNT = {
    "yellow": "floor(l_extendedprice) / CAST(100 AS DOUBLE)",
    "green": "floor(o_totalprice / CAST(10 AS DOUBLE)) / CAST(100 AS DOUBLE)",
}
_SOURCE = {
    "yellow": (
        "lineitem", "l_orderkey * 7 + l_linenumber", "l_shipdate", "l_suppkey % 2 + 1",
    ),
    "green": ("orders", "o_orderkey + 1", "o_orderdate", "o_custkey % 2 + 1"),
}


def _derived(fleet: str) -> str:
    """CTE of one fleet's trips, typed, before any rule."""
    table, number, base, vendor = _SOURCE[fleet]
    return f"""
{fleet}_keyed AS (
  SELECT CAST({number} AS BIGINT) AS id, CAST({base} AS TIMESTAMP) AS base,
         CAST({vendor} AS BIGINT) AS vendor_id, {_AMOUNT[fleet]} AS x
  FROM {table}),
{fleet}_begun AS (
  SELECT *, base + to_seconds(60 * ((id * 13) % 1440)) AS begun,
         CASE WHEN id % 500 = 0 THEN base + to_seconds(2678400) ELSE base END AS filed
  FROM {fleet}_keyed),
{fleet} AS (
  SELECT '{fleet}' AS trip_type, vendor_id,
    CASE WHEN id % 997 <> 0 THEN begun END AS pickup_datetime,
    CASE WHEN id % 991 <> 0 THEN begun + to_seconds(
      CASE WHEN id % 211 = 0 THEN 90000 WHEN id % 199 = 0 THEN 0
           WHEN id % 193 = 0 THEN -300 WHEN id % 197 = 0 THEN 30
           ELSE 60 * (1 + (id * 37) % 180) END) END AS dropoff_datetime,
    CASE WHEN id % 13 = 0 THEN NULL WHEN id % 9 = 8 THEN CAST(-1 AS DOUBLE)
         ELSE CAST(id % 9 AS DOUBLE) END AS passenger_count,
    CASE WHEN id % 307 = 0 THEN NULL WHEN id % 101 = 0 THEN -x
         WHEN id % 103 = 0 THEN CAST(0 AS DOUBLE) ELSE x END AS total_amount,
    strftime(filed, '%Y') AS ref_year, strftime(filed, '%m') AS ref_month
  FROM {fleet}_begun)"""


# name -> condition of a good row
_CONDITIONS = {
    "pickup_datetime_nulo": "pickup_datetime IS NOT NULL",
    "dropoff_datetime_nulo": "dropoff_datetime IS NOT NULL",
    "duracao_nao_positiva": "trip_duration_minutes > 0",
    "duracao_acima_de_24h": f"trip_duration_minutes <= {LIMITS.max_minutes}",
    "fora_da_janela_de_analise": (
        f"pickup_datetime >= TIMESTAMP '{LIMITS.window_start}'"
        f" AND pickup_datetime < TIMESTAMP '{LIMITS.window_end}'"
    ),
    "total_amount_nulo": "total_amount IS NOT NULL",
    "total_amount_negativo": "total_amount >= 0",
    "passenger_count_ausente": "passenger_count IS NOT NULL AND passenger_count > 0",
}
_MEASURED_ONLY = {"passenger_count_ausente"}
_DESCRIPTIONS = {
    "pickup_datetime_nulo": "The trip has no start.",
    "dropoff_datetime_nulo": "The trip has no end.",
    "duracao_nao_positiva": "The trip ends at or before its start.",
    "duracao_acima_de_24h": "The trip lasts more than 1440 minutes.",
    "fora_da_janela_de_analise": "The start is outside [1996-01-01, 2001-01-01).",
    "total_amount_nulo": "The trip has no amount.",
    "total_amount_negativo": "The amount is negative; kept apart as a possible refund.",
    "passenger_count_ausente": (
        "No positive passenger count; measured only, the trip stays."
    ),
}

_CANONICAL = (
    "trip_type, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, "
    "total_amount, ref_year, ref_month, trip_duration_minutes, pickup_year, "
    "pickup_month, pickup_hour, pickup_date"
)
_FACT_TYPES = {
    "trip_type": "string",
    "vendor_id": "bigint",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "total_amount": "double",
    "ref_year": "string",
    "ref_month": "string",
    "trip_duration_minutes": "double",
    "pickup_year": "string",
    "pickup_month": "string",
    "pickup_hour": "int",
    "pickup_date": "date",
    "_source_file": "string",
}
_WITH_FILE = f"{_CANONICAL}, _source_file"


def _reasons() -> str:
    """Failed blocking rules as comma-separated text; empty when none failed."""
    cases = ", ".join(
        f"CASE WHEN NOT ({condition}) THEN '{name}' END"
        for name, condition in _CONDITIONS.items()
        if name not in _MEASURED_ONLY
    )
    return f"concat_ws(',', {cases})"


_TRIPS = f"""WITH {_derived("yellow")}, {_derived("green")},
both_fleets AS (
  SELECT *, 'lineitem.parquet' AS _source_file FROM yellow
  UNION ALL SELECT *, 'orders.parquet' FROM green),
trips AS (
  SELECT *,
    (CAST(floor(epoch(dropoff_datetime)) AS BIGINT)
      - CAST(floor(epoch(pickup_datetime)) AS BIGINT)) / CAST(60 AS DOUBLE)
      AS trip_duration_minutes,
    strftime(pickup_datetime, '%Y') AS pickup_year,
    strftime(pickup_datetime, '%m') AS pickup_month,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(pickup_datetime AS DATE) AS pickup_date
  FROM both_fleets),
flagged AS (SELECT *, {_reasons()} AS reasons FROM trips),
fact AS (SELECT * FROM flagged WHERE reasons = ''),
rejects AS (SELECT * FROM flagged WHERE reasons <> ''),
monthly AS (
  SELECT trip_type, pickup_year, pickup_month, COUNT(*) AS trip_count,
    SUM(total_amount) AS total_revenue, AVG(total_amount) AS avg_total_amount_per_trip,
    quantile_disc(total_amount, 0.5) AS median_total_amount,
    SUM(passenger_count) AS total_passengers,
    pickup_year || '-' || pickup_month AS reference_month
  FROM fact GROUP BY trip_type, pickup_year, pickup_month),
hourly AS (
  SELECT trip_type, pickup_year, pickup_month, pickup_hour, COUNT(*) AS trip_count,
    SUM(CASE WHEN passenger_count > 0 THEN passenger_count END) AS total_passengers,
    COUNT(CASE WHEN passenger_count > 0 THEN 1 END) AS trips_with_passenger_count,
    AVG(CASE WHEN passenger_count > 0 THEN passenger_count END) AS avg_passenger_count,
    COUNT(DISTINCT pickup_date) AS distinct_days
  FROM fact GROUP BY trip_type, pickup_year, pickup_month, pickup_hour),
focus AS (
  SELECT * FROM hourly WHERE pickup_year = '{YEAR}' AND pickup_month = '{MONTH}')
"""

_FACT = f"SELECT {_WITH_FILE} FROM fact"
_REJECTS = f"SELECT {_WITH_FILE}, reasons AS _rejection_reasons"
_MONTHLY = """SELECT trip_type, pickup_year, pickup_month, trip_count,
  ROUND(total_revenue, 2) AS total_revenue,
  ROUND(avg_total_amount_per_trip, 4) AS avg_total_amount_per_trip,
  median_total_amount, total_passengers, reference_month FROM monthly"""
_HOURLY = """SELECT trip_type, pickup_year, pickup_month, pickup_hour, trip_count,
  total_passengers, trips_with_passenger_count,
  ROUND(avg_passenger_count, 4) AS avg_passenger_count, distinct_days FROM hourly"""
_BY_REASON = """SELECT motivo, COUNT(*) AS linhas
  FROM (SELECT unnest(string_split(reasons, ',')) AS motivo FROM rejects) GROUP BY motivo"""
_FILE_MONTHS = "SELECT DISTINCT trip_type, ref_year, ref_month FROM both_fleets"


def _share(top: str, whole: str) -> str:
    return f"ROUND({top} * CAST(100 AS DOUBLE) / {whole}, 4)"


def _report() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS rule_name, '{_DESCRIPTIONS[name]}' AS description,
  {str(name not in _MEASURED_ONLY).upper()} AS blocking, COUNT(*) AS rows_evaluated,
  COUNT(CASE WHEN NOT ({condition}) THEN 1 END) AS rows_failed,
  {_share(f"COUNT(CASE WHEN NOT ({condition}) THEN 1 END)", "COUNT(*)")} AS failure_pct
FROM trips"""
        for name, condition in _CONDITIONS.items()
    )
    return rows


def _rule(name: str) -> str:
    return f"""SELECT trip_type, ref_year, ref_month, COUNT(*) AS rows_evaluated,
  COUNT(CASE WHEN NOT ({_CONDITIONS[name]}) THEN 1 END) AS rows_failed
FROM trips GROUP BY trip_type, ref_year, ref_month"""


def _landed(fleet: str) -> str:
    """One fleet's rows as they read from the drifting files, every column text."""
    late = "ref_year >= '1998'"
    return f"""SELECT
  CASE WHEN {late} THEN CAST(CAST(vendor_id AS DOUBLE) AS VARCHAR)
       ELSE CAST(vendor_id AS VARCHAR) END AS vendor_id,
  CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
  CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime,
  CAST(passenger_count AS VARCHAR) AS passenger_count,
  CAST(vendor_id % 2 AS VARCHAR) AS ratecode_id,
  CASE WHEN {late} THEN CAST(vendor_id * CAST(1.25 AS DOUBLE) AS VARCHAR)
       ELSE CAST(vendor_id AS VARCHAR) END AS airport_fee,
  CASE WHEN {late} THEN CAST(vendor_id + 10 AS VARCHAR) END AS pulocation_id,
  CAST(total_amount AS VARCHAR) AS total_amount, ref_year, ref_month,
  ref_year AS file_year, ref_month AS file_month, TRUE AS stamped
FROM {fleet}"""


def _landed_alone(fleet: str, meter: str) -> str:
    return f"""SELECT * RENAME (pickup_datetime AS {meter}_pickup_datetime,
  dropoff_datetime AS {meter}_dropoff_datetime) FROM ({_landed(fleet)})"""


def _ladder(value: str, null: str, steps: list[tuple[str, str]], rest: str) -> str:
    cases = " ".join(f"WHEN {value} {test} THEN '{label}'" for test, label in steps)
    return f"CASE WHEN {value} IS NULL THEN '{null}' {cases} ELSE '{rest}' END"


_DURATION = _ladder(
    "trip_duration_minutes",
    "0 · nula",
    [
        ("< 0", "1 · negativa"),
        ("= 0", "2 · zerada"),
        ("< 1", "3 · menos de 1 min"),
        ("< 5", "4 · 1 a 5 min"),
        ("< 15", "5 · 5 a 15 min"),
        ("< 30", "6 · 15 a 30 min"),
        ("< 60", "7 · 30 a 60 min"),
        ("< 120", "8 · 1 a 2 h"),
        ("< 1440", "9 · 2 a 24 h"),
    ],
    "A · mais de 24 h",
)
_PASSENGERS = _ladder(
    "passenger_count",
    "0 · nulo",
    [
        ("< 0", "1 · negativo"),
        ("= 0", "2 · zero"),
        ("<= 4", "3 · 1 a 4"),
        ("<= 6", "4 · 5 a 6"),
    ],
    "5 · acima de 6",
)
_AMOUNTS = _ladder(
    "total_amount",
    "0 · nulo",
    [
        ("< 0", "1 · negativo"),
        ("= 0", "2 · zero"),
        ("< 10", "3 · até 10"),
        ("< 25", "4 · 10 a 25"),
        ("< 50", "5 · 25 a 50"),
        ("< 100", "6 · 50 a 100"),
        ("< 1000", "7 · 100 a 1.000"),
    ],
    "8 · acima de 1.000",
)


def _histogram(label: str, source: str, extra: str = "") -> str:
    return f"""SELECT {label} AS faixa, COUNT(*) AS corridas,
  {_share("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS pct{extra}
FROM {source} GROUP BY 1"""


_SCENARIOS = """scenarios AS (
  SELECT 'aprovadas (fato)' AS cenario, total_amount FROM fact WHERE trip_type = 'yellow'
  UNION ALL
  SELECT 'aprovadas + negativos', total_amount FROM fact WHERE trip_type = 'yellow'
  UNION ALL
  SELECT 'aprovadas + negativos', total_amount FROM rejects
  WHERE trip_type = 'yellow' AND reasons = 'total_amount_negativo')"""
_HOUR = "lpad(CAST(pickup_hour AS VARCHAR), 2, '0') AS hora"


def _slice() -> str:
    clause = "'(ref_year = ''' || ref_year || ''' AND ref_month = ''' || ref_month || ''')'"
    return f"""SELECT string_agg({clause}, ' OR ' ORDER BY ref_year, ref_month) AS predicate
FROM (SELECT DISTINCT ref_year, ref_month FROM yellow)"""


def _replaced() -> str:
    month = f"ref_year = '{YEAR}' AND ref_month = '{MONTH}'"
    return f"""SELECT ref_year, ref_month, COUNT(*) AS linhas,
  COUNT(CASE WHEN {month} THEN 1 END) AS revisadas,
  ROUND(SUM(total_amount), 2) AS receita
FROM yellow WHERE NOT ({month}) OR vendor_id = 1 GROUP BY ref_year, ref_month"""


_PROFILE = """SELECT COUNT(*) AS total_corridas,
  COUNT(*) - COUNT(vendor_id) AS vendorid_nulos,
  COUNT(DISTINCT vendor_id) AS vendorid_distintos,
  COUNT(*) - COUNT(passenger_count) AS passenger_count_nulos,
  MIN(passenger_count) AS passenger_count_min, MAX(passenger_count) AS passenger_count_max,
  COUNT(*) - COUNT(total_amount) AS total_amount_nulos,
  ROUND(MIN(total_amount), 2) AS total_amount_min,
  ROUND(MAX(total_amount), 2) AS total_amount_max,
  ROUND(AVG(total_amount), 2) AS total_amount_medio,
  MIN(pickup_datetime) AS pickup_mais_antigo, MAX(pickup_datetime) AS pickup_mais_recente
FROM yellow"""


_BODIES: dict[str, str] = {
    "landing_inventory": (
        f"SELECT *, TRUE AS has_files, TRUE AS has_bytes FROM ({_FILE_MONTHS})"
    ),
    "landing_coverage": f"""SELECT f.trip_type, strftime(m, '%Y') AS ref_year,
  strftime(m, '%m') AS ref_month
FROM (SELECT unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-02-01',
                                    INTERVAL 1 MONTH)) AS m) AS months
JOIN (SELECT DISTINCT trip_type FROM both_fleets) AS f ON TRUE
WHERE NOT EXISTS (SELECT 1 FROM both_fleets b WHERE b.trip_type = f.trip_type
  AND b.ref_year = strftime(m, '%Y') AND b.ref_month = strftime(m, '%m'))""",
    "file_name_routing": """SELECT
  trip_type || '_tripdata_' || ref_year || '-' || ref_month
    || CASE WHEN vendor_id = 1 THEN '.parquet' ELSE '.parquet.part' END AS name,
  CASE WHEN vendor_id = 1 THEN trip_type END AS trip_type,
  CASE WHEN vendor_id = 1 THEN ref_year END AS ref_year,
  CASE WHEN vendor_id = 1 THEN ref_month END AS ref_month, COUNT(*) AS linhas
FROM both_fleets GROUP BY ALL""",
    "ref_month_from_path": """SELECT ref_year AS path_year, ref_month AS path_month,
  COUNT(*) AS linhas FROM both_fleets GROUP BY ALL""",
    "raw_read": _landed_alone("green", "lpep"),
    "raw_union_drift": _landed_alone("yellow", "tpep"),
    "layer_raw": (
        f"SELECT *, 'yellow' AS trip_type FROM ({_landed('yellow')}) "
        f"UNION ALL SELECT *, 'green' FROM ({_landed('green')})"
    ),
    "layer_trusted": """SELECT vendor_id AS "VendorID", passenger_count, total_amount,
  pickup_datetime, dropoff_datetime, ref_year, ref_month, trip_type FROM both_fleets""",
    "layer_fact": f"SELECT {_CANONICAL} FROM fact",
    "layer_quarantine": f"""SELECT {_CANONICAL},
  reasons AS _rejection_reasons FROM rejects""",
    "layer_report": _report(),
    "layer_monthly": _MONTHLY,
    "layer_hourly": _HOURLY,
    "report_stamped": f"""SELECT rule_name, rows_evaluated, CAST(1 AS BIGINT) AS stamped
FROM ({_report()})""",
    "fact_statistics": "SELECT TRUE AS exists, COUNT(*) AS linhas FROM fact",
    "fact_columns": " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, '{kind}' AS data_type, COUNT({name}) AS preenchidos FROM fact"
        for name, kind in _FACT_TYPES.items()
    ),
    "clustered_fact_interleaved": f"SELECT {_CANONICAL} FROM fact",
    "streamed_fact": f"SELECT {_CANONICAL} FROM fact",
    "partition_statistics": f"""SELECT pickup_year, pickup_month, COUNT(*) AS linhas FROM fact
WHERE pickup_year = '{YEAR}' AND pickup_month = '{MONTH}' GROUP BY ALL""",
    "layer_report_after_month": _report(),
    "layer_monthly_after_month": _MONTHLY,
    "ticket_quantiles_by_year": """SELECT trip_type, pickup_year,
  quantile_disc(total_amount, 0.25) AS p25, quantile_disc(total_amount, 0.5) AS mediana,
  quantile_disc(total_amount, 0.75) AS p75 FROM fact GROUP BY trip_type, pickup_year""",
    "eda_histograms": " UNION ALL ".join(
        f"""SELECT trip_type, '{name}' AS histogram, {label} AS faixa, COUNT(*) AS corridas,
  {_share("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY trip_type)")} AS pct,
  ROUND(SUM(total_amount), 2) AS soma FROM trips GROUP BY trip_type, faixa"""
        for name, label in (("duration", _DURATION), ("passengers", _PASSENGERS), ("amount", _AMOUNTS))
    ),
    "eda_profile_states": _PROFILE,
    "partition_slice": _slice(),
    "partition_replace": _replaced(),
    "table_overwrite": _BY_REASON,
    "clustered_fact": f"SELECT {_CANONICAL} FROM fact",
    "normalize_names": """SELECT vendor_id, passenger_count, total_amount,
  pickup_datetime AS tpep_pickup_datetime, vendor_id % 2 AS ratecode_id,
  vendor_id + 10 AS pulocation_id, vendor_id * CAST(1.25 AS DOUBLE) AS airport_fee,
  ref_month FROM yellow""",
    "apply_schema": """SELECT vendor_id AS "VendorID",
  CASE WHEN passenger_count <> 7 THEN passenger_count END AS passenger_count,
  total_amount, pickup_datetime AS tpep_pickup_datetime,
  dropoff_datetime AS tpep_dropoff_datetime, 'lineitem.parquet' AS _source_file,
  pickup_datetime AS _ingested_at, ref_year, ref_month FROM yellow""",
    "trip_duration": """SELECT trip_type, trip_duration_minutes, COUNT(*) AS linhas
FROM trips GROUP BY ALL""",
    "canonical_trips": f"SELECT {_WITH_FILE} FROM trips",
    "trusted_sample": """SELECT vendor_id AS "VendorID", passenger_count, total_amount,
  pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime
FROM yellow ORDER BY vendor_id NULLS FIRST, passenger_count NULLS FIRST,
  total_amount NULLS FIRST, pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST
LIMIT 10""",
    "fact_month_sample": f"""SELECT trip_type, pickup_datetime, passenger_count,
  total_amount FROM fact WHERE pickup_year = '{YEAR}' AND pickup_month = '{MONTH}'
ORDER BY trip_type, pickup_datetime, passenger_count NULLS FIRST, total_amount
LIMIT 100""",
    **{key: _rule(name) for key, name in RULE_QUERIES.items()},
    "rejection_reasons": f"{_REJECTS} FROM flagged",
    "valid_trips": _FACT,
    "rejected_trips": f"{_REJECTS} FROM rejects",
    "dq_report": _report(),
    "dq_report_sorted": _report(),
    "rejections_by_reason": _BY_REASON,
    "agg_monthly": _MONTHLY,
    "agg_hourly": _HOURLY,
    "raw_partition_counts": """SELECT trip_type, ref_year, ref_month, COUNT(*) AS linhas
FROM both_fleets GROUP BY ALL""",
    "lineage_counts": """SELECT trip_type, ref_year, ref_month, ref_year AS path_year,
  ref_month AS path_month, TRUE AS has_file, COUNT(*) AS linhas FROM both_fleets GROUP BY ALL""",
    "eda_volume_by_ref_month": """SELECT trip_type, ref_year, ref_month,
  COUNT(*) AS corridas FROM both_fleets GROUP BY ALL""",
    "eda_profile": _PROFILE,
    "eda_event_month": """SELECT strftime(pickup_datetime, '%Y-%m') AS mes_do_pickup,
  COUNT(*) AS corridas FROM yellow GROUP BY 1""",
    "eda_month_mismatch": """SELECT ref_year || '-' || ref_month AS mes_do_arquivo,
  strftime(pickup_datetime, '%Y-%m') AS mes_do_pickup, COUNT(*) AS corridas
FROM yellow GROUP BY 1, 2
HAVING ref_year || '-' || ref_month <> strftime(pickup_datetime, '%Y-%m')
ORDER BY corridas DESC, mes_do_arquivo, mes_do_pickup LIMIT 30""",
    "eda_duration_hist": _histogram(_DURATION, "trips"),
    "eda_passenger_hist": _histogram(_PASSENGERS, "trips"),
    "eda_amount_hist": _histogram(
        _AMOUNTS, "yellow", ", ROUND(SUM(total_amount), 2) AS soma"
    ),
    "eda_quantiles": "SELECT "
    + ", ".join(
        f"ROUND(quantile_disc(total_amount, {share}), 2) AS {name}"
        for name, share in {
            "p01": 0.01, "p25": 0.25, "mediana": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99,
        }.items()
    )
    + ", ROUND(AVG(total_amount), 2) AS media FROM yellow WHERE total_amount IS NOT NULL",
    "eda_quarantine_share": f"""SELECT (SELECT COUNT(*) FROM fact) AS aprovadas,
  (SELECT COUNT(*) FROM rejects) AS em_quarentena,
  {_share("(SELECT COUNT(*) FROM rejects)", "(SELECT COUNT(*) FROM flagged)")}
    AS pct_quarentena""",
    "q1a_avg_ticket": """SELECT reference_month AS mes, trip_count AS corridas,
  ROUND(avg_total_amount_per_trip, 2) AS ticket_medio,
  ROUND(median_total_amount, 2) AS mediana, ROUND(total_revenue, 2) AS receita_total
FROM monthly WHERE trip_type = 'yellow'""",
    "q1a_from_fact": """SELECT strftime(pickup_datetime, '%Y-%m') AS mes,
  COUNT(*) AS corridas, ROUND(AVG(total_amount), 2) AS ticket_medio
FROM fact WHERE trip_type = 'yellow' GROUP BY 1""",
    "q1b_avg_monthly_revenue": """SELECT COUNT(*) AS meses_considerados,
  ROUND(SUM(total_revenue), 2) AS receita_do_periodo,
  ROUND(AVG(total_revenue), 2) AS receita_media_mensal,
  ROUND(AVG(trip_count), 0) AS corridas_media_mensal
FROM monthly WHERE trip_type = 'yellow'""",
    "q1_weighted_vs_simple": """SELECT
  ROUND(SUM(total_revenue) / SUM(trip_count), 2) AS ticket_ponderado,
  ROUND(AVG(avg_total_amount_per_trip), 2) AS ticket_simples
FROM monthly WHERE trip_type = 'yellow'""",
    "q2a_hourly_occupancy": f"""SELECT {_HOUR},
  CAST(SUM(trips_with_passenger_count) AS BIGINT) AS corridas,
  ROUND(SUM(total_passengers) / NULLIF(SUM(trips_with_passenger_count), 0), 4)
    AS media_passageiros_por_corrida
FROM focus GROUP BY pickup_hour""",
    "q2a_from_fact": f"""SELECT {_HOUR}, COUNT(*) AS corridas,
  ROUND(AVG(passenger_count), 4) AS media_passageiros_por_corrida
FROM fact WHERE pickup_datetime >= TIMESTAMP '{FOCUS_RANGE[0]}'
  AND pickup_datetime < TIMESTAMP '{FOCUS_RANGE[1]}' AND passenger_count > 0
GROUP BY pickup_hour""",
    "q2b_typical_day": f"""SELECT {_HOUR}, SUM(total_passengers) AS passageiros_no_mes,
  MAX(distinct_days) AS dias_com_dado,
  ROUND(SUM(total_passengers) / MAX(distinct_days), 1) AS passageiros_por_hora_dia_tipico
FROM focus GROUP BY pickup_hour""",
    "q2c_by_fleet": f"""SELECT {_HOUR},
  ROUND(MAX(CASE WHEN trip_type = 'yellow' THEN avg_passenger_count END), 4) AS yellow,
  ROUND(MAX(CASE WHEN trip_type = 'green' THEN avg_passenger_count END), 4) AS green
FROM focus GROUP BY pickup_hour""",
    "q2d_hourly_volume_occupancy": """SELECT pickup_hour,
  SUM(total_passengers) / NULLIF(SUM(trips_with_passenger_count), 0) AS ocupacao_media,
  CAST(SUM(trips_with_passenger_count) AS BIGINT) AS corridas
FROM focus GROUP BY pickup_hour""",
}

_WITH_SCENARIOS: dict[str, str] = {
    "q1c_sensitivity": """SELECT cenario, COUNT(*) AS corridas,
  ROUND(AVG(total_amount), 4) AS ticket_medio, ROUND(SUM(total_amount), 2) AS receita
FROM scenarios GROUP BY cenario""",
    "q1_sensitivity_change": """SELECT
  ROUND((b.ticket - a.ticket) * 100 / a.ticket, 2) AS variacao_ticket_pct,
  ROUND((b.receita - a.receita) * 100 / a.receita, 2) AS variacao_receita_pct
FROM (SELECT AVG(total_amount) AS ticket, SUM(total_amount) AS receita FROM scenarios
      WHERE cenario = 'aprovadas (fato)') AS a
JOIN (SELECT AVG(total_amount) AS ticket, SUM(total_amount) AS receita FROM scenarios
      WHERE cenario = 'aprovadas + negativos') AS b ON TRUE""",
}

_CAST_LINEITEM = "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM lineitem"


def oracle_sql() -> dict[str, str]:
    statements = {name: f"{_TRIPS}{body}" for name, body in _BODIES.items()}
    for name, body in _WITH_SCENARIOS.items():
        statements[name] = f"{_TRIPS}, {_SCENARIOS}\n{body}"
    statements["cast_all_string"] = _CAST_LINEITEM
    return statements
