"""SQL (DuckDB dialect) counterpart of each registered query, over the same tables.

Each statement is put together from the named parts below; a part is included when its name
occurs in the statement or in a part it needs.
"""

from __future__ import annotations

import re

from wardflow.operators.answer import REFUSAL
from wardflow.plans.fixtures import MESSAGES_SQL, VITALS_SQL

PARTS: dict[str, str] = {}
ORACLE_SQL: dict[str, str] = {}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql.strip()


def _needs(sql: str) -> list[str]:
    return [n for n in PARTS if re.search(rf"\b{n}\b", sql)]


def _in_order(sql: str) -> list[str]:
    out: list[str] = []
    for name in _needs(sql):
        for inner in [*_in_order(PARTS[name]), name]:
            if inner not in out:
                out.append(inner)
    return out


def oracle(name: str, sql: str) -> None:
    head = ",\n".join(f"{n} AS MATERIALIZED (\n{PARTS[n]}\n)" for n in _in_order(sql))
    ORACLE_SQL[name] = f"WITH {head}\n{sql.strip()}" if head else sql.strip()


# Readings and their scores

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
READING = """reading_id, patient_id, recorded_at, heart_rate, resp_rate, systolic_bp, spo2,
temperature_c, consciousness, on_supplemental_o2, source_device"""

part("x_bronze", VITALS_SQL.replace("{events}", "events"))
part(
    "x_latest",
    """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY reading_id
        ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn
      FROM x_bronze) WHERE rn = 1
    """,
)
part(
    "x_silver",
    """
    SELECT reading_id, patient_id, recorded_at, date_trunc('hour', recorded_at) AS recorded_hour,
           heart_rate, resp_rate, systolic_bp, spo2, temperature_c, consciousness,
           on_supplemental_o2, source_device, ingested_at
    FROM x_latest
    """,
)


def scored(source: str) -> str:
    return f"""
    SELECT *, score_resp_rate + score_spo2 + score_oxygen + score_systolic_bp + score_pulse
              + score_consciousness + score_temperature AS news2_total,
           greatest(score_resp_rate, score_spo2, score_oxygen, score_systolic_bp, score_pulse,
                    score_consciousness, score_temperature) AS max_parameter_score
    FROM (SELECT *,
      CASE WHEN resp_rate <= 8 THEN 3 WHEN resp_rate <= 11 THEN 1 WHEN resp_rate <= 20 THEN 0
           WHEN resp_rate <= 24 THEN 2 ELSE 3 END AS score_resp_rate,
      CASE WHEN spo2 >= 96 THEN 0 WHEN spo2 >= 94 THEN 1 WHEN spo2 >= 92 THEN 2 ELSE 3 END
        AS score_spo2,
      CASE WHEN on_supplemental_o2 THEN 2 ELSE 0 END AS score_oxygen,
      CASE WHEN systolic_bp <= 90 THEN 3 WHEN systolic_bp <= 100 THEN 2
           WHEN systolic_bp <= 110 THEN 1 WHEN systolic_bp <= 219 THEN 0 ELSE 3 END
        AS score_systolic_bp,
      CASE WHEN heart_rate <= 40 THEN 3 WHEN heart_rate <= 50 THEN 1 WHEN heart_rate <= 90 THEN 0
           WHEN heart_rate <= 110 THEN 1 WHEN heart_rate <= 130 THEN 2 ELSE 3 END AS score_pulse,
      CASE WHEN consciousness = 'A' THEN 0 ELSE 3 END AS score_consciousness,
      CASE WHEN temperature_c <= 35 THEN 3 WHEN temperature_c <= 36 THEN 1
           WHEN temperature_c <= 38 THEN 0 WHEN temperature_c <= 39 THEN 1 ELSE 2 END
        AS score_temperature
    FROM {source})"""


def band(total: str, highest: str) -> str:
    return f"""CASE WHEN {total} >= 7 THEN 'high' WHEN {total} >= 5 THEN 'medium'
               WHEN {highest} = 3 THEN 'low-medium' ELSE 'low' END"""


part("x_scored", scored("x_silver"))
part(
    "x_gold",
    f"""
    SELECT patient_id, recorded_hour AS window_start, CAST(count(*) AS INT) AS readings_in_window,
           round_even(avg(news2_total), 3) AS mean_news2, max(news2_total) AS max_news2,
           max(max_parameter_score) AS max_single_parameter_score,
           {band("max(news2_total)", "max(max_parameter_score)")} AS worst_risk_band,
           round_even(avg(CAST(on_supplemental_o2 AS INT)), 3) AS pct_readings_on_oxygen,
           round_even(avg(heart_rate), 2) AS mean_heart_rate, min(spo2) AS min_spo2,
           max(resp_rate) AS max_resp_rate, min(systolic_bp) AS min_systolic_bp,
           round_even(max(temperature_c), 2) AS max_temperature_c,
           min(recorded_at) AS first_reading_at, max(recorded_at) AS last_reading_at
    FROM x_scored GROUP BY patient_id, recorded_hour
    """,
)

oracle(
    "win1_latest_reading",
    f"SELECT {READING}, ingested_at, kafka_partition, kafka_offset FROM x_latest",
)
oracle("prj1_silver_rows", "SELECT * FROM x_silver")
oracle(
    "prj3_age_minutes",
    f"""
    SELECT kafka_offset, round((epoch_us({AS_OF}) - epoch_us(recorded_at)) / 60000000.0, 4)
           AS age_minutes FROM x_bronze
    """,
)
oracle("agg2_watermark", "SELECT max(ingested_at) AS watermark FROM x_silver")
oracle(
    "flt1_newer_than_watermark",
    """
    SELECT reading_id, ingested_at, kafka_offset FROM x_bronze
    WHERE ingested_at > (SELECT max(ingested_at) FROM x_bronze WHERE ingested_at < (
      SELECT make_timestamp((epoch_us(min(ingested_at))
        + (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) // 2)) FROM x_bronze))
    """,
)
oracle("mrg1_silver_upsert", "SELECT * FROM x_silver")
part(
    "x_halves",
    """
    SELECT reading_id, ingested_at < (SELECT make_timestamp((epoch_us(min(ingested_at))
        + (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) // 2)) FROM x_bronze) AS early
    FROM x_bronze
    """,
)
oracle(
    "agg9_merge_metrics",
    """
    SELECT count(*) AS source_rows,
           count(*) FILTER (reading_id IN (SELECT reading_id FROM x_halves WHERE early))
             AS num_target_rows_updated,
           count(*) FILTER (reading_id NOT IN (SELECT reading_id FROM x_halves WHERE early))
             AS num_target_rows_inserted
    FROM (SELECT DISTINCT reading_id FROM x_halves WHERE NOT early)
    """,
)
oracle(
    "mrg1_orders_upsert",
    """
    SELECT * EXCLUDE (fixed) REPLACE (
      CASE WHEN fixed THEN 'corrected' ELSE o_orderpriority END AS o_orderpriority,
      CASE WHEN fixed THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM (SELECT *, o_orderdate < DATE '1996-01-01' AND o_orderkey % 7 = 0 AS fixed FROM orders)
    """,
)
oracle(
    "prj2_run_stamp", f"SELECT reading_id, {AS_OF} AS updated_at FROM x_latest"
)
oracle("stm5_out_of_order", "SELECT * FROM x_silver")
oracle(
    "set1_append_all",
    "SELECT reading_id, count(*) AS versions FROM x_bronze GROUP BY reading_id",
)
PROFILE = """
SELECT count(*) AS row_count, count(DISTINCT patient_id) AS distinct_patients,
       min(heart_rate) AS min_heart_rate, max(heart_rate) AS max_heart_rate,
       min(spo2) AS min_spo2, max(spo2) AS max_spo2 FROM x_bronze
"""
oracle("agg5_table_profile", PROFILE)
oracle("src5_table_read", PROFILE)
oracle(
    "snk4_first_build_metrics",
    """
    SELECT count(*) AS source_rows, CAST(0 AS BIGINT) AS num_target_rows_updated,
           count(*) AS num_target_rows_inserted FROM x_silver
    """,
)
oracle(
    "news8_scored_readings",
    f"""
    SELECT reading_id, score_resp_rate, score_spo2, score_oxygen, score_systolic_bp, score_pulse,
           score_consciousness, score_temperature, news2_total, max_parameter_score,
           {band("news2_total", "max_parameter_score")} AS risk_band
    FROM x_scored
    """,
)
for _name in ("agg1_gold_patient_hour", "mrg2_gold_upsert", "stm3_hourly_windows",
              "stm4_incremental_gold", "stm4_replayed_refresh"):
    oracle(_name, "SELECT * FROM x_gold")
oracle(
    "agg6_band_histogram",
    "SELECT worst_risk_band, count(*) AS windows FROM x_gold GROUP BY worst_risk_band",
)
oracle(
    "agg6_reduction",
    """
    SELECT CAST(sum(readings_in_window) AS BIGINT) AS silver_rows, count(*) AS gold_rows,
           round_even(sum(readings_in_window) / count(*), 1) AS reduction_ratio FROM x_gold
    """,
)
oracle(
    "win5_trend",
    """
    SELECT *, round_even(mean_news2 - previous_mean_news2, 3) AS change FROM (
      SELECT patient_id, window_start, mean_news2, max_news2, lag(mean_news2) OVER (
               PARTITION BY patient_id ORDER BY window_start) AS previous_mean_news2
      FROM x_gold)
    """,
)
part("x_high", "SELECT * FROM x_gold WHERE worst_risk_band = 'high'")
part(
    "x_worst",
    """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
      ORDER BY max_news2 DESC, mean_news2 DESC, window_start) AS rn FROM x_gold) WHERE rn = 1
    """,
)
oracle("top5_worst_window_per_patient", "SELECT * FROM x_worst")
oracle(
    "top6_worst_windows",
    """
    SELECT * FROM x_gold
    ORDER BY max_news2 DESC, mean_news2 DESC, patient_id, window_start LIMIT 8
    """,
)
oracle("flt2_windows_of_a_patient", "SELECT * FROM x_gold WHERE patient_id = 'P100012'")
QUESTION = """
concat('NEWS2 ', max_news2, ' (', worst_risk_band, ' risk), respiratory rate ', max_resp_rate,
       ', SpO2 ', min_spo2, '%', CASE WHEN pct_readings_on_oxygen > 0 THEN ' on oxygen' ELSE '' END,
       ', systolic BP ', min_systolic_bp, ', heart rate ',
       CAST(round_even(mean_heart_rate, 0) AS INT),
       ', temperature ', printf('%.1f', round_even(max_temperature_c, 1)),
       '. Recommended escalation and immediate management?')
"""
oracle(
    "str8_window_questions", f"SELECT patient_id, window_start, {QUESTION} AS query FROM x_gold"
)

# Messages and the contract

part("x_messages", MESSAGES_SQL.replace("{events}", "events"))
FIELDS = [f.strip() for f in READING.replace("\n", " ").split(",")]
part(
    "x_fields",
    "SELECT *, json_type(j) AS t_all, "
    + ", ".join(f"json_type(j, '$.{f}') AS t_{f}, json_extract_string(j, '$.{f}') AS s_{f}" for f in FIELDS)
    + " FROM (SELECT *, CASE WHEN json_valid(msg) THEN CAST(msg AS JSON) END AS j FROM x_messages)",
)


def _number(f: str, pattern: str) -> str:
    return f"""CASE WHEN t_{f} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN TRY_CAST(s_{f} AS DOUBLE)
      WHEN t_{f} = 'VARCHAR' AND regexp_full_match(trim(s_{f}), '{pattern}')
        THEN TRY_CAST(replace(trim(s_{f}), '_', '') AS DOUBLE)
      WHEN t_{f} = 'BOOLEAN' THEN CAST(s_{f} = 'true' AS INT) END"""


RANGES = {
    "heart_rate": (20, 250), "resp_rate": (4, 60), "systolic_bp": (50, 260), "spo2": (50, 100),
    "temperature_c": (30, 45),
}


def _values() -> str:
    out = []
    for f in FIELDS:
        if f == "temperature_c":
            value = _number(f, "[+-]?[0-9]+(\\.[0-9]*)?")
        elif f in RANGES:
            value = _number(f, "[+-]?[0-9]+(_[0-9]+)*(\\.0+)?")
        elif f == "recorded_at":
            value = f"CASE WHEN t_{f} = 'VARCHAR' THEN TRY_CAST(s_{f} AS TIMESTAMP) END"
        elif f == "on_supplemental_o2":
            value = f"""CASE WHEN t_{f} = 'BOOLEAN' THEN s_{f} = 'true'
              WHEN t_{f} = 'VARCHAR' AND lower(s_{f}) IN ('1', 'on', 't', 'true', 'y', 'yes') THEN true
              WHEN t_{f} = 'VARCHAR' AND lower(s_{f}) IN ('0', 'off', 'f', 'false', 'n', 'no')
              THEN false END"""
        elif f == "consciousness":
            value = f"CASE WHEN t_{f} = 'VARCHAR' AND s_{f} IN ('A', 'V', 'P', 'U') THEN s_{f} END"
        else:
            value = f"CASE WHEN t_{f} = 'VARCHAR' THEN trim(s_{f}) END"
        out.append(f"{value} AS v_{f}")
    return ", ".join(out)


part("x_values", f"SELECT *, {_values()} FROM x_fields")


def _reason(f: str) -> str:
    missing = f"WHEN t_{f} IS NULL THEN 'Field required'"
    if f in RANGES:
        low, high = RANGES[f]
        kind = "number" if f == "temperature_c" else "integer"
        word = "a number" if f == "temperature_c" else "an integer"
        whole = (
            ""
            if f == "temperature_c"
            else f"WHEN t_{f} = 'DOUBLE' AND v_{f} <> floor(v_{f}) "
            f"THEN 'Input should be a valid integer, got a number with a fractional part'"
        )
        rules = f"""{whole}
          WHEN v_{f} IS NULL AND t_{f} = 'VARCHAR'
            THEN 'Input should be a valid {kind}, unable to parse string as {word}'
          WHEN v_{f} IS NULL THEN 'Input should be a valid {kind}'
          WHEN v_{f} < {low} THEN 'Input should be greater than or equal to {low}'
          WHEN v_{f} > {high} THEN 'Input should be less than or equal to {high}'"""
    elif f == "recorded_at":
        rules = f"""WHEN v_{f} IS NULL THEN 'Input should be a valid datetime'
          WHEN v_{f} > {AS_OF} + INTERVAL 5 MINUTE
            THEN concat('Value error, recorded_at ', s_{f}, ' is in the future')"""
    elif f == "consciousness":
        rules = f"WHEN v_{f} IS NULL THEN 'Input should be ''A'', ''V'', ''P'' or ''U'''"
    elif f == "on_supplemental_o2":
        rules = f"""WHEN v_{f} IS NULL AND t_{f} IN ('VARCHAR', 'UBIGINT', 'BIGINT')
            THEN 'Input should be a valid boolean, unable to interpret input'
          WHEN v_{f} IS NULL THEN 'Input should be a valid boolean'"""
    elif f == "patient_id":
        rules = f"""WHEN v_{f} IS NULL THEN 'Input should be a valid string'
          WHEN NOT regexp_full_match(v_{f}, 'P[0-9]{{6}}')
            THEN 'String should match pattern ''^P\\d{{6}}$'''"""
    else:
        rules = f"""WHEN v_{f} IS NULL THEN 'Input should be a valid string'
          WHEN length(v_{f}) < 1 THEN 'String should have at least 1 character'"""
        if f == "source_device":
            rules += f" WHEN length(v_{f}) > 100 THEN 'String should have at most 100 characters'"
    return f"'{f}: ' || CASE {missing} {rules} END"


part(
    "x_judged",
    "SELECT *, CASE WHEN j IS NULL THEN ['record: invalid JSON'] "
    "WHEN t_all = 'ARRAY' THEN ['record: expected a JSON object, got list'] ELSE list_concat("
    f"list_filter([{', '.join(_reason(f) for f in FIELDS)}], lambda x: x IS NOT NULL), "
    "list_transform(list_filter(json_keys(j), lambda k: NOT list_contains("
    f"[{', '.join(repr(f) for f in FIELDS)}], k)), "
    "lambda k: k || ': Extra inputs are not permitted')) END AS errors FROM x_values",
)
part("x_rejected", "SELECT * FROM x_judged WHERE len(errors) > 0")
part("x_reasons", "SELECT part_no, off_no, unnest(errors) AS reason FROM x_rejected")

oracle("con1_rejection_reasons", "SELECT off_no, array_to_string(errors, '; ') AS errors FROM x_rejected")
for _name, _where in {
    "con2_not_an_object": "starts_with(reason, 'record: ')",
    "con4_unknown_fields": "ends_with(reason, 'Extra inputs are not permitted')",
    "con5_out_of_range": "contains(reason, 'than or equal to')",
    "con6_patient_pattern": "contains(reason, 'String should match')",
    "con7_consciousness_levels": "ends_with(reason, 'Input should be ''A'', ''V'', ''P'' or ''U''')",
    "con8_blank_strings": "contains(reason, 'should have at least')",
    "con9_in_the_future": "contains(reason, 'in the future')",
    "con10_refused_types": "contains(reason, 'should be a valid')",
}.items():
    oracle(_name, f"SELECT * FROM x_reasons WHERE {_where}")
oracle(
    "con3_missing_fields",
    """
    SELECT split_part(reason, ':', 1) AS field, count(*) AS messages FROM x_reasons
    WHERE ends_with(reason, 'Field required') GROUP BY 1
    """,
)
BRONZE = (
    "SELECT "
    + ", ".join(
        f"CAST(v_{f} AS INT) AS {f}" if f in RANGES and f != "temperature_c" else f"v_{f} AS {f}"
        for f in FIELDS
    )
    + ", stamp AS ingested_at, part_no AS kafka_partition, off_no AS kafka_offset "
    "FROM x_judged WHERE len(errors) = 0"
)
oracle("con12_bronze_rows", BRONZE)
oracle("stm2_stream_ingest", BRONZE)
oracle("stm1_many_batches", BRONZE)
_READ = f"SELECT DISTINCT reading_id FROM ({BRONZE})"
_HOURS = f"SELECT DISTINCT patient_id, date_trunc('hour', recorded_at) FROM ({BRONZE})"
_COUNTS = [
    ("ingest", "consumed", "SELECT * FROM x_judged"),
    ("ingest", "valid", "SELECT * FROM x_judged WHERE len(errors) = 0"),
    ("ingest", "rejected", "SELECT * FROM x_judged WHERE len(errors) > 0"),
    ("build_silver", "source_rows", _READ),
    ("build_silver", "num_target_rows_updated", "SELECT 1 WHERE false"),
    ("build_silver", "num_target_rows_inserted", _READ),
    ("build_gold", "gold_rows", _HOURS),
    ("build_gold", "silver_rows", _READ),
    ("build_gold", "num_target_rows_updated", "SELECT 1 WHERE false"),
    ("build_gold", "num_target_rows_inserted", _HOURS),
]


def _stages(run: str, gate: str) -> str:
    """Rows of a run: the gate has no counts."""
    return (
        f"""SELECT '{run}' AS parent_run_id, 'quality_gate' AS job, '{gate}' AS status,
               CAST(2 AS BIGINT) AS events, NULL AS counted, NULL AS n"""
        + "".join(
            f""" UNION ALL
            SELECT '{run}', '{job}', 'COMPLETE', 2, '{name}', (SELECT count(*) FROM ({rows}))"""
            for job, name, rows in _COUNTS
        )
    )


# readings of the first of January are too old for the usual gate
oracle("pip2_staged_run", _stages("staged-run", "FAIL"))
oracle(
    "pip2_halted_run",
    f"""SELECT *, false AS went_on FROM ({_stages("halted-run", "FAIL")})
        WHERE job IN ('ingest', 'build_silver', 'quality_gate')""",
)
_TOLD = [
    ("ingest", "consumed", "input", "kafka://broker:9092", "vitals.raw"),
    ("ingest", "consumed", "output", "file", "/bronze/vitals"),
    ("ingest", "consumed", "output", "kafka://broker:9092", "vitals.deadletter"),
    ("build_silver", "source_rows", "input", "file", "/bronze/vitals"),
    ("build_silver", "source_rows", "output", "file", "/silver/vitals"),
]
_COUNTED = {(job, name): rows for job, name, rows in _COUNTS}
oracle(
    "pip4_run_datasets",
    " UNION ALL ".join(
        f"""SELECT 'scheduled-run' AS parent_run_id, '{job}' AS job, '{side}' AS side,
              'wardflow/bedside_readings' AS owner, '{namespace}' AS namespace, '{dataset}' AS dataset,
              (SELECT count(*) FROM ({_COUNTED[job, name]})) AS counted"""
        for job, name, side, namespace, dataset in _TOLD
    ),
)
oracle(
    "jsn1_deadletter_json",
    """
    SELECT off_no, array_to_string(errors, '; ') AS errors,
           CASE WHEN json_valid(msg) THEN 'json' ELSE 'text' END AS raw_kind FROM x_rejected
    """,
)
oracle(
    "rte1_routes",
    """
    SELECT CASE WHEN len(errors) = 0 THEN 'bronze' ELSE 'deadletter' END AS route, part_no,
           count(*) AS messages FROM x_judged GROUP BY ALL
    """,
)
oracle(
    "agg3_ingest_stats",
    """
    SELECT count(*) AS consumed, count(*) FILTER (len(errors) = 0) AS valid,
           count(*) FILTER (len(errors) > 0) AS rejected FROM x_judged
    """,
)
oracle(
    "agg4_rejection_profile",
    """
    SELECT split_part(reason, ':', 1) AS field, count(*) AS reasons,
           count(*) FILTER (reason = first) AS first_reasons
    FROM (SELECT unnest(errors) AS reason, errors[1] AS first FROM x_rejected) GROUP BY 1
    """,
)
oracle(
    "agg4_first_reasons",
    """
    SELECT split_part(errors[1], ':', 1) AS field, count(*) AS rejected,
           arg_min(errors[1], part_no * 1000000000 + off_no) AS sample_reason,
           arg_min(part_no, part_no * 1000000000 + off_no) AS sample_partition,
           arg_min(off_no, part_no * 1000000000 + off_no) AS sample_offset
    FROM x_rejected GROUP BY 1
    """,
)
oracle(
    "snk1_published_records",
    """
    SELECT CASE WHEN t_patient_id = 'VARCHAR' THEN s_patient_id END AS key, count(*) AS records,
           min(msg) AS first_value FROM x_fields GROUP BY 1
    """,
)
# the log holds the first 400 of every thousand messages, then the others
_LOGGED = "off_no % 1000 >= 400, off_no"
oracle(
    "snk1_line_log",
    f"""
    SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY {_LOGGED}) AS INT) AS seq, value,
           CAST(count(*) OVER () AS BIGINT) AS sent
    FROM (SELECT CASE WHEN t_patient_id = 'VARCHAR' THEN s_patient_id END AS key, msg AS value, off_no
          FROM x_fields)
    """,
)
oracle(
    "stm6_line_stream",
    f"""
    SELECT * EXCLUDE (ingested_at, kafka_offset) REPLACE (CAST(0 AS INT) AS kafka_partition),
           CAST(row_number() OVER (PARTITION BY patient_id ORDER BY kafka_offset % 1000 >= 400,
             kafka_offset) AS INT) AS seq
    FROM ({BRONZE})
    """,
)
oracle(
    "snk2_deadletter_rows",
    """
    SELECT msg AS raw, array_to_string(errors, '; ') AS errors,
           '2024-02-01T00:00:00+00:00' AS rejected_at, 'vitals.raw' AS topic, part_no, off_no
    FROM x_rejected
    """,
)
# Unicode White_Space, which the engine's own \s does not cover
WS = (
    "[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


oracle(
    "src2_nonblank_lines",
    f"""
    SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS characters,
           min(line_no) AS first_line
    FROM (SELECT doc_id, {strip("l[i + 1]")} AS line, CAST(i AS INT) AS line_no
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
               LATERAL (SELECT unnest(range(len(l))) AS i))
    WHERE line <> '' GROUP BY doc_id
    """,
)
oracle(
    "src3_json_decode",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)

# Quality gate

part("x_dups", "SELECT reading_id, count(*) AS n FROM x_bronze GROUP BY 1 HAVING count(*) > 1")


def _suite_sql(rows: str, source: str, lines: list[tuple[str, str | None, str, str]]) -> str:
    """``lines``: (kind, column, success, unexpected) over one aggregate of the source."""
    measures = f"x_measures_{source}"
    part(measures, f"SELECT {rows} FROM {source}")
    selects = [
        f"""SELECT {i} AS position, '{kind}' AS expectation,
            {f"'{column}'" if column else "CAST(NULL AS VARCHAR)"} AS "column",
            {success} AS success, CAST({unexpected} AS BIGINT) AS unexpected_count FROM {measures}"""
        for i, (kind, column, success, unexpected) in enumerate(lines, start=1)
    ]
    return " UNION ALL ".join(selects)


def _suite(name: str, *of) -> None:
    oracle(name, _suite_sql(*of))


def _silver_lines(extra: list, dups: str) -> tuple[str, list]:
    ranges = ", ".join(
        f"count(*) FILTER (NOT ({c} BETWEEN {a} AND {b})) AS n_{c}" for c, (a, b) in RANGES.items()
    )
    rows = f"""count(*) AS n, count(*) FILTER (reading_id IS NULL) AS n_reading_id,
      count(*) FILTER (patient_id IS NULL) AS n_patient_id, ({dups}) AS n_dup,
      count(*) FILTER (NOT regexp_full_match(patient_id, 'P[0-9]{{6}}')) AS n_pattern,
      count(*) FILTER (recorded_at IS NULL) AS n_recorded_at,
      count(*) FILTER (on_supplemental_o2 IS NULL) AS n_on_supplemental_o2, {ranges},
      count(*) FILTER (consciousness NOT IN ('A', 'V', 'P', 'U')) AS n_level,
      max((epoch_us({AS_OF}) - epoch_us(recorded_at)) / 60000000.0) AS oldest,
      min((epoch_us({AS_OF}) - epoch_us(recorded_at)) / 60000000.0) AS newest"""

    def values(kind, column, measure):
        return (f"expect_column_values_to_{kind}", column, f"{measure} = 0", measure)

    lines = [
        ("expect_table_row_count_to_be_between", None, "n >= 1", "0"),
        values("not_be_null", "reading_id", "n_reading_id"),
        values("be_unique", "reading_id", "n_dup"),
        values("not_be_null", "patient_id", "n_patient_id"),
        values("match_regex", "patient_id", "n_pattern"),
        values("not_be_null", "recorded_at", "n_recorded_at"),
        values("not_be_null", "on_supplemental_o2", "n_on_supplemental_o2"),
        *[values("be_between", c, f"n_{c}") for c in RANGES],
        values("be_in_set", "consciousness", "n_level"),
        *extra,
    ]
    return rows, lines


_rows, _lines = _silver_lines(
    [("expect_column_max_to_be_between", "age_minutes", "oldest BETWEEN 0 AND 57600", "0")], "0"
)
_suite("exp_suite_on_silver", _rows, "x_silver", _lines)
# the same after each of three loads of two days; a later load brings the version that arrives later
part(
    "x_moved",
    """
    SELECT * EXCLUDE (recorded_at, heart_rate), kafka_offset % 6 // 2 AS load,
           recorded_at + (kafka_offset % 6) * INTERVAL '1' DAY AS recorded_at,
           CASE WHEN kafka_offset % 97 = 0 THEN 999 ELSE heart_rate END AS heart_rate
    FROM x_bronze
    """,
)
for _load in range(3):
    part(
        f"x_load_{_load}",
        f"""
        SELECT * FROM x_moved WHERE load <= {_load} QUALIFY row_number() OVER (
          PARTITION BY reading_id
          ORDER BY ingested_at DESC, load DESC, kafka_partition DESC, kafka_offset DESC) = 1
        """,
    )
oracle(
    "exp_stored_states",
    " UNION ALL ".join(
        f"SELECT *, CAST({k} AS INT) AS load FROM ({_suite_sql(_rows, f'x_load_{k}', _lines)})"
        for k in range(3)
    ),
)
_rows, _lines = _silver_lines(
    [
        ("expect_column_min_to_be_between", "age_minutes", "newest BETWEEN 0 AND 60", "0"),
        ("expect_column_min_to_be_between", "age_minutes", "newest >= 0", "0"),
    ],
    "SELECT coalesce(sum(n), 0) FROM x_dups",
)
_suite("exp_suite_on_bronze", _rows, "x_bronze", _lines)
part("x_labelled", "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
_suite(
    "exp_suite_on_labels",
    """count(*) AS n, count(*) FILTER (quality IS NULL) AS a,
        (SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM x_labelled
          GROUP BY text HAVING count(*) > 1)) AS b,
        count(*) FILTER (lang NOT IN ('en', 'fr')) AS c, count(*) FILTER (toxic <> 0) AS d,
        count(*) FILTER (NOT regexp_matches(source, '^src[0-4]$')) AS e, max(n_chars) AS f""",
    "x_labelled",
    [
        ("expect_table_row_count_to_be_between", None, "n >= 1", "0"),
        ("expect_column_values_to_not_be_null", "quality", "a = 0", "a"),
        ("expect_column_values_to_be_unique", "text", "b = 0", "b"),
        ("expect_column_values_to_be_in_set", "lang", "c = 0", "c"),
        ("expect_column_values_to_be_between", "toxic", "d = 0", "d"),
        ("expect_column_values_to_match_regex", "source", "e = 0", "e"),
        ("expect_column_max_to_be_between", "n_chars", "f BETWEEN 0 AND 10000", "0"),
    ],
)

oracle(
    "exp8_failure_samples",
    """
    SELECT position, rank, md5(value) AS digest FROM (
      SELECT position, CAST(row_number() OVER (PARTITION BY position ORDER BY value) AS INT) AS rank, value
      FROM (SELECT 1 AS position, text AS value FROM documents GROUP BY text HAVING count(*) > 1
            UNION ALL SELECT 2, lang FROM documents WHERE lang NOT IN ('en', 'fr')
            UNION ALL SELECT 3, CAST(toxic AS VARCHAR) FROM x_labelled WHERE toxic <> 0))
    WHERE rank <= 20
    """,
)
_GATES = " UNION ALL ".join(f"SELECT {k} AS gate, * FROM ({ORACLE_SQL['exp_suite_on_bronze']})" for k in (1, 2))
# the second gate bounds the age of the oldest reading, which is beyond it as well
oracle(
    "snk5_gate_results",
    f"""
    SELECT {AS_OF} AS evaluated_at, bool_and(success) AS success,
           CAST(count(*) AS INT) AS evaluated_expectations,
           CAST(count(*) FILTER (success) AS INT) AS successful_expectations,
           CAST(count(*) FILTER (NOT success) AS INT) AS unsuccessful_expectations,
           100.0::DOUBLE * count(*) FILTER (success) / count(*) AS success_percent
    FROM ({_GATES}) GROUP BY gate
    """,
)
oracle(
    "exp9_gate_failures",
    f"""
    SELECT CASE WHEN gate = 2 AND position = 14 THEN 'expect_column_max_to_be_between'
                ELSE expectation END AS expectation, "column", unexpected_count
    FROM ({_GATES}) WHERE NOT success
    """,
)

# Text

def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


def sentences(text: str) -> str:
    marked = f"regexp_replace({text}, '([.!?]){WS}+([-*A-Z0-9])', '\\1' || chr(1) || '\\2', 'g')"
    return f"string_split({marked}, chr(1))"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def clean(text: str) -> str:
    unbold = f"regexp_replace(regexp_replace({text}, '^{WS}*[-*]{WS}+', ''), '\\*\\*(.+?)\\*\\*', '\\1', 'g')"
    return strip(f"regexp_replace({unbold}, '{WS}+', ' ', 'g')")


oracle(
    "str1_tokens",
    f"""
    SELECT doc_id, CAST(len({tokens("text")}) AS INT) AS n_tokens,
           md5(array_to_string({tokens("text")}, ' ')) AS digest FROM documents
    """,
)
part(
    "x_markdown",
    "SELECT CAST(page_id AS VARCHAR) AS doc_id, "
    + "regexp_replace(" * 12
    + "html"
    + "".join(
        f", '<h{i}[^>]*>', chr(10) || '{'#' * i} ', 'g'), '</h{i}>', chr(10), 'g')" for i in range(1, 7)
    )
    + " AS body FROM pages",
)
part(
    "x_split",
    """
    SELECT doc_id, regexp_extract_all(body, '(?m)^(#{1,6})\\s+(.*)$', 2) AS heads,
           regexp_split_to_array(body, '(?m)^(#{1,6})\\s+(.*)$') AS pieces, body FROM x_markdown
    """,
)
oracle(
    "str3_sections",
    f"""
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS position,
           heading, md5(txt) AS digest
    FROM (SELECT doc_id, i, {strip("heads[i]")} AS heading, {strip("pieces[i + 1]")} AS txt
          FROM x_split, LATERAL (SELECT unnest(range(1, len(heads) + 1)) AS i)
          UNION ALL
          SELECT doc_id, 1, '', {strip("body")} FROM x_split WHERE len(heads) = 0)
    WHERE txt <> '' OR heading = ''
    """,
)
oracle(
    "str5_sentences",
    f"""
    SELECT doc_id, CAST(len({sentences("text")}) AS INT) AS sentences,
           md5(array_to_string({sentences("text")}, '|')) AS digest FROM documents
    """,
)
oracle(
    "str6_clean_sentences",
    f"""
    SELECT md5(sentence) AS digest, count(*) AS copies
    FROM (SELECT {clean("raw")} AS sentence
          FROM (SELECT unnest({sentences("text")}) AS raw FROM documents))
    WHERE len({words("sentence")}) >= 4 GROUP BY sentence
    """,
)

oracle(
    "str2_front_matter",
    f"""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'Text ' || doc_id AS title, source, lang AS topic,
           md5({strip("text")}) AS digest FROM documents
    """,
)

# Chunks

part(
    "x_chunks",
    f"""
    SELECT doc_id || '::' || i AS chunk_id, doc_id, CAST(i AS INT) AS ordinal, title, source,
           array_to_string(list_slice(w, i * 100 + 1, i * 100 + 130), ' ') AS txt
    FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'Document ' || doc_id AS title, source,
                 {words("text")} AS w FROM documents),
         LATERAL (SELECT unnest(range(CAST(1 + greatest(ceil((len(w) - 130) / 100), 0) AS BIGINT))) AS i)
    """,
)
oracle(
    "ret1_chunks", "SELECT chunk_id, doc_id, ordinal, '' AS heading, md5(txt) AS digest FROM x_chunks"
)
oracle(
    "pip1_full_run",
    _stages("full-run", "COMPLETE")
    + " UNION ALL SELECT 'full-run', 'rag_index', 'COMPLETE', 2, 'points', (SELECT count(*) FROM x_chunks)",
)
oracle(
    "agg7_index_size", "SELECT count(*) AS points, count(DISTINCT doc_id) AS documents FROM x_chunks"
)
part("x_tokens", f"SELECT *, {tokens('txt')} AS toks FROM x_chunks")
part("x_corpus", "SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM x_tokens")
part(
    "x_postings",
    """
    SELECT chunk_id, term, count(*) AS tf
    FROM (SELECT chunk_id, unnest(toks) AS term FROM x_tokens) GROUP BY ALL
    """,
)
part(
    "x_df",
    """
    SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw
    FROM (SELECT term, count(*) AS df FROM x_postings GROUP BY term), x_corpus
    """,
)
part(
    "x_terms",
    """
    SELECT term, df, CASE WHEN raw < 0 THEN (SELECT avg(raw) * 0.25 FROM x_df) ELSE raw END AS idf
    FROM x_df
    """,
)
oracle("agg8_corpus_statistics", "SELECT n, round(avgdl, 6) AS avgdl FROM x_corpus")
oracle("agg8_term_statistics", "SELECT term, df, round(idf, 6) AS idf FROM x_terms")
oracle(
    "joi4_postings",
    """
    SELECT term, count(*) AS chunks, CAST(sum(tf) AS BIGINT) AS occurrences FROM x_postings
    GROUP BY term
    """,
)
oracle(
    "ret3_approximate_recall",
    "SELECT count(*) AS questions, true AS reached FROM embeddings WHERE vec_id % 50 = 0",
)
oracle(
    "joi4_stored_postings",
    """
    SELECT term, count(*) AS chunks, CAST(sum(tf) AS BIGINT) AS occurrences FROM x_postings
    GROUP BY term
    """,
)
oracle(
    "ret0_index_build",
    """
    SELECT points, documents, terms, postings, round(avgdl, 6) AS avgdl
    FROM (SELECT count(*) AS points, count(DISTINCT doc_id) AS documents FROM x_chunks),
         (SELECT count(*) AS terms, CAST(sum(df) AS BIGINT) AS postings FROM x_df), x_corpus
    """,
)
oracle(
    "snk6_index_upsert", "SELECT count(*) AS points, count(DISTINCT doc_id) AS documents FROM x_chunks"
)
UUID = """regexp_replace(substr(h, 1, 12) || '5' || substr(h, 14, 3)
  || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1, 1) || substr(h, 18, 15),
  '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5')"""
oracle(
    "str10_point_ids",
    f"""
    SELECT chunk_id, {UUID} AS point_id FROM (
      SELECT chunk_id, sha1(unhex('6f9619ff8b86d011b42d00cf4fc964ff') || encode(chunk_id)) AS h
      FROM x_chunks)
    """,
)

oracle(
    "mrg3_index_prune",
    f"""
    SELECT {UUID} AS point_id, chunk_id, doc_id FROM (
      SELECT chunk_id, doc_id,
             sha1(unhex('6f9619ff8b86d011b42d00cf4fc964ff') || encode(chunk_id)) AS h
      FROM x_chunks WHERE ordinal = 0)
    """,
)

# Retrieval over one question table (x_questions or x_window_questions)

part("x_questions", "SELECT item_id AS query_id, text AS query FROM benchmark")
part("x_window_questions", f"SELECT DISTINCT md5({QUESTION}) AS query_id, {QUESTION} AS query FROM x_high")


def _buckets(rows: str, key: str) -> str:
    return f"""SELECT {key}, bucket, count(*) AS c FROM (
      SELECT {key}, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 384 AS bucket
      FROM (SELECT {key}, unnest({tokens("txt")}) AS term FROM ({rows}))) GROUP BY ALL"""


part("x_cvec", _buckets("SELECT chunk_id, txt FROM x_chunks", "chunk_id"))
part("x_cnorm", "SELECT chunk_id, sqrt(sum(c * c)) AS norm FROM x_cvec GROUP BY chunk_id")


def _retrieval(q: str, table: str, floor: float) -> None:
    """Parts ``{q}_...`` for the questions in ``table``."""
    part(
        f"{q}_terms",
        f"""
        SELECT query_id, term, count(*) AS qtf
        FROM (SELECT query_id, unnest({tokens("query")}) AS term FROM {table}) GROUP BY ALL
        """,
    )
    part(
        f"{q}_bm25",
        f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, ordinal)
                 AS rank
          FROM (SELECT query_id, chunk_id, doc_id, ordinal, round(sum(qtf * idf * tf * 2.5
                  / (tf + 1.5 * (0.25 + 0.75 * len(toks) / avgdl))), 8) AS score
                FROM {q}_terms JOIN x_terms USING (term) JOIN x_postings USING (term)
                  JOIN x_tokens USING (chunk_id), x_corpus
                GROUP BY ALL) WHERE score > 0) WHERE rank <= 20
        """,
    )
    part(f"{q}_vec", _buckets(f"SELECT query_id, query AS txt FROM {table}", "query_id"))
    part(f"{q}_norm", f"SELECT query_id, sqrt(sum(c * c)) AS qnorm FROM {q}_vec GROUP BY query_id")
    part(
        f"{q}_dot",
        f"""
        SELECT query_id, chunk_id, sum(a.c * b.c) AS dot FROM {q}_vec a JOIN x_cvec b USING (bucket)
        GROUP BY ALL
        """,
    )
    part(
        f"{q}_dense",
        f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, ordinal)
                 AS rank
          FROM (SELECT query_id, chunk_id, doc_id, ordinal,
                       round(coalesce(dot / (qnorm * norm), 0), 8) AS score
                FROM {table} CROSS JOIN x_chunks
                  LEFT JOIN {q}_dot USING (query_id, chunk_id)
                  LEFT JOIN {q}_norm USING (query_id) LEFT JOIN x_cnorm USING (chunk_id)))
        WHERE rank <= 20
        """,
    )
    part(
        f"{q}_hits",
        f"""
        SELECT *, row_number() OVER (PARTITION BY query_id
          ORDER BY rrf_score DESC, dense_rank NULLS LAST, bm25_rank NULLS LAST) AS fused_rank
        FROM (SELECT query_id, chunk_id, sum(1.0::DOUBLE / (60 + rank)) AS rrf_score,
                     CAST(max(rank) FILTER (ranker = 'dense') AS INT) AS dense_rank,
                     CAST(max(rank) FILTER (ranker = 'bm25') AS INT) AS bm25_rank
              FROM (SELECT 'dense' AS ranker, query_id, chunk_id, rank FROM {q}_dense UNION ALL
                    SELECT 'bm25', query_id, chunk_id, rank FROM {q}_bm25) GROUP BY ALL)
        """,
    )
    part(
        f"{q}_weights",
        f"""
        SELECT query_id, term, ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) AS weight
        FROM {q}_terms LEFT JOIN x_terms USING (term), x_corpus
        """,
    )
    part(
        f"{q}_pairs",
        f"""
        SELECT query_id, chunk_id, fused_rank,
               coalesce(sum(weight) FILTER (list_contains(toks, term)) / sum(weight), 0) AS share
        FROM (SELECT * FROM {q}_hits WHERE fused_rank <= 12) JOIN x_tokens USING (chunk_id)
          LEFT JOIN {q}_weights USING (query_id)
        GROUP BY ALL
        """,
    )
    part(
        f"{q}_reranked",
        f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fused_rank) AS marker
          FROM (SELECT query_id, chunk_id, fused_rank,
                       round(ln((share + 0.01) / (1 - share + 0.01)), 8) AS score FROM {q}_pairs))
        WHERE marker <= 5
        """,
    )
    part(
        f"{q}_kept",
        f"""
        SELECT r.*, title, source, txt FROM {q}_reranked r JOIN x_chunks USING (chunk_id)
        WHERE query_id IN (SELECT query_id FROM {q}_reranked WHERE score >= {floor})
        """,
    )
    part(
        f"{q}_sentences",
        f"""
        SELECT * FROM (
          SELECT query_id, marker, i AS position, {clean("s[i]")} AS txt,
                 concat_ws(':', query_id, marker, i) AS sid
          FROM (SELECT query_id, marker, {sentences("txt")} AS s FROM {q}_kept
                WHERE marker <= 2 OR score > 0), LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i))
        WHERE len({words("txt")}) >= 4
        """,
    )
    part(f"{q}_svec", _buckets(f"SELECT sid, txt FROM {q}_sentences", "sid"))
    part(f"{q}_snorm", f"SELECT sid, sqrt(sum(c * c)) AS norm FROM {q}_svec GROUP BY sid")
    part(
        f"{q}_sdot",
        f"""
        SELECT sid, sum(a.c * b.c) AS dot
        FROM {q}_svec a JOIN (SELECT sid, query_id FROM {q}_sentences) USING (sid)
          JOIN {q}_vec b USING (query_id, bucket) GROUP BY sid
        """,
    )
    part(
        f"{q}_picked",
        f"""
        SELECT query_id, marker, txt, pick FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY near DESC, marker, position) AS pick
          FROM (SELECT *, row_number() OVER (PARTITION BY query_id, txt
                       ORDER BY near DESC, marker, position) AS copy
                FROM (SELECT s.*, round(coalesce(dot / (qnorm * norm), 0), 8) AS near
                      FROM {q}_sentences s LEFT JOIN {q}_sdot USING (sid)
                        LEFT JOIN {q}_snorm USING (sid) LEFT JOIN {q}_norm USING (query_id)))
          WHERE copy = 1) WHERE pick <= 4
        """,
    )
    part(
        f"{q}_answers",
        f"""
        SELECT t.query_id, t.query, k.n IS NULL AS refused,
               CASE WHEN k.n IS NULL THEN '{REFUSAL}' ELSE coalesce(a.answer, '') END AS answer,
               CAST(coalesce(k.n, 0) AS INT) AS citations
        FROM {table} t
          LEFT JOIN (SELECT query_id, count(*) AS n FROM {q}_kept GROUP BY 1) k USING (query_id)
          LEFT JOIN (SELECT query_id, string_agg(txt || ' [' || marker || ']', ' '
                            ORDER BY marker, pick) AS answer FROM {q}_picked GROUP BY 1) a
            USING (query_id)
        """,
    )


_retrieval("q", "x_questions", -2.0)
_retrieval("w", "x_window_questions", -4.0)

CUT = "round(score, 6)"
oracle(
    "ret4_bm25_topk", f"SELECT query_id, chunk_id, {CUT} AS score, CAST(rank AS INT) AS rank FROM q_bm25"
)
oracle(
    "ret6_hybrid_search",
    """
    SELECT query_id, chunk_id, round(rrf_score, 8) AS rrf_score, dense_rank, bm25_rank,
           CAST(fused_rank AS INT) AS fused_rank FROM q_hits
    """,
)
oracle(
    "ret7_rerank",
    f"""
    SELECT query_id, CAST(marker AS INT) AS marker, chunk_id, {CUT} AS score FROM q_reranked
    """,
)
oracle(
    "ret8_answers",
    """
    SELECT query_id, refused, answer, citations, citations AS contexts,
           CAST(retrieved AS INT) AS retrieved
    FROM q_answers JOIN (SELECT query_id, count(*) FILTER (fused_rank <= 12) AS retrieved
                         FROM q_hits GROUP BY 1) USING (query_id)
    """,
)
oracle(
    "ret8_citations",
    """
    SELECT query_id, CAST(marker AS INT) AS marker, chunk_id, title, source,
           round(score, 3) AS rerank_score FROM q_kept
    """,
)
oracle(
    "ret9_explained_windows",
    f"""
    SELECT g.patient_id, g.window_start, a.query, a.refused, a.answer
    FROM (SELECT *, {QUESTION} AS query FROM x_high) g JOIN w_answers a USING (query)
    """,
)
oracle(
    "ret5_rrf",
    """
    SELECT query_id, chunk_id, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS rrf_score FROM (
      SELECT o_custkey AS query_id, o_orderkey AS chunk_id, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders
      UNION ALL
      SELECT o_custkey, o_orderkey, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) FROM orders)
    GROUP BY ALL
    """,
)

# Vectors

part(
    "x_vectors",
    """
    SELECT lpad(CAST(vec_id AS VARCHAR), 12, '0') AS chunk_id, label,
           CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings
    """,
)
part(
    "x_means",
    """
    SELECT label, list(mean ORDER BY i) AS mean FROM (
      SELECT label, i, avg(embedding[i]) AS mean
      FROM x_vectors, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i) GROUP BY ALL)
    GROUP BY label
    """,
)
oracle(
    "mth1_cosine_to_label_mean",
    """
    SELECT chunk_id, round(list_cosine_similarity(embedding, mean), 6) AS cosine
    FROM x_vectors JOIN x_means USING (label)
    """,
)
oracle(
    "ret3_dense_topk",
    f"""
    SELECT query_id, chunk_id, {CUT} AS score, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank
      FROM (SELECT m.label AS query_id, chunk_id,
                   round(list_cosine_similarity(embedding, mean), 8) AS score
            FROM x_vectors CROSS JOIN x_means m)) WHERE rank <= 20
    """,
)

# Lineage

_SUMMARY = """
    SELECT 'user-' || user_id AS parent_run_id, 'run-' || event_id AS run_id, event_type AS job,
           CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS status,
           ts AS started_at, make_timestamp(epoch_us(ts) + CAST(floor(value * 1000) AS BIGINT)) AS ended_at,
           CAST(2 AS BIGINT) AS events, CASE WHEN event_type = 'error' THEN 'event error' END AS error,
           CAST(floor(value * 1000) AS BIGINT) / 1000000 AS seconds
    FROM events
    """
oracle("agg10_run_summary", _SUMMARY)
oracle("src6_stage_events", _SUMMARY)
oracle(
    "agg10_events_per_run",
    """
    SELECT 'user-' || user_id AS parent_run_id, 2 * count(*) AS events,
           count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1
    """,
)
