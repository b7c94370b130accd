"""DuckDB SQL with the results the registered queries must give."""

from fumarole.settings import SENSORS, SUMMARY_FEATURES

W30 = "(partition by sensor_id order by ts_t rows between 29 preceding and current row)"
ORDERED = "(partition by sensor_id order by ts_t)"


def r6(expr: str, name: str | None = None) -> str:
    return f"round(cast({expr} as double), 6) + 0.0 as {name or expr}"


def r6_all(columns) -> str:
    return ", ".join(r6(c) for c in columns)


def base(grain: str | None) -> str:
    ts = "ts" if grain is None else f"cast(date_trunc('{grain}', ts) as timestamp)"
    return f"""
        select printf('S%02d', cast(user_id % 16 + 1 as int)) as sensor_id, {ts} as ts_t,
               case when event_id % 23 = 0 or floor(event_id / 60) % 25 = 0 then null
                    else cast(cast(value as float) as double) end as x,
               event_id as seq
        from events"""


def deduped(grain: str = "minute") -> str:
    return f"""
        select * from ({base(grain)})
        qualify row_number() over (partition by sensor_id, ts_t order by seq desc) = 1"""


RUNS = f"""
    select *, cast(x is null as int) as missing,
           sum(starts) over {ORDERED} as run
    from (select *, case when (x is null) = (lag(x is null) over {ORDERED}) then 0 else 1 end as starts
          from d)"""

FILLED = f"""
    select sensor_id, ts_t, seq, is_imputed,
           case when is_imputed = 1 then before else x end as x
    from (select *, cast(missing = 1 and gap <= 3 as int) as is_imputed
          from (select *, sum(missing) over (partition by sensor_id, run) as gap,
                       last_value(x ignore nulls) over {ORDERED} as before
                from runs))"""

CLEAN = f"""
    select *, cast(coalesce(abs((x - avg5) / nullif(std5, 0)) > 3.5, false) as int) as outlier_flag
    from (select *, case when count(x) over {W30} >= 5 then avg(x) over {W30} end as avg5,
                 case when count(x) over {W30} >= 5 then stddev_samp(x) over {W30} end as std5
          from f)"""

NORMALIZED = """
    select t.*, case when lo is not null and hi <> lo then (x - lo) / (hi - lo) else 0.0 end as norm
    from c t join (select sensor_id, min(x) as lo, max(x) as hi from c group by sensor_id) using (sensor_id)"""

FEATURES = f"""
    select *, sum(cast(x > rolling_avg + coalesce(moving_std, 0) and coalesce(moving_std, 0) > 0 as int))
                  over {W30} as peaks
    from (select *, avg(x) over {W30} as rolling_avg,
                 case when count(x) over {W30} >= 2 then stddev_samp(x) over {W30} end as moving_std,
                 min(x) over {W30} as rolling_min, max(x) over {W30} as rolling_max,
                 lag(x, 1) over {ORDERED} as lag_1, lag(x, 5) over {ORDERED} as lag_5,
                 x - lag(x, 1) over {ORDERED} as rate_of_change
          from f)"""

SCORED = """
    select *, coalesce((x - rolling_avg) / nullif(moving_std, 0), 0) as z_score,
           1 / (1 + abs(coalesce(moving_std, 0))) as stability_score,
           cast(coalesce(peaks, 0) as int) as peak_frequency,
           cast(hour(ts_t) as int) as hour_of_day, cast(isodow(ts_t) >= 6 as int) as is_weekend,
           strftime(ts_t, '%Y-%m-%d') as reading_date
    from w"""

FLAGGED = "select *, cast(abs(z_score) > 3.5 as int) as anomaly_flag from s"

CORR = """covar_pop(case when {y} is not null then {x} end, case when {x} is not null then {y} end) / nullif(
    stddev_pop(case when {y} is not null then {x} end) * stddev_pop(case when {x} is not null then {y} end), 0)"""

INSTANTS = f"""
    select ts_t, count(v) as n, coalesce({CORR.format(x="v", y="mean")}, 0) as sensor_correlation,
           avg(v) * 100 as gas_concentration_est
    from (select ts_t, sensor_id, v, mean
          from v join (select sensor_id, avg(v) as mean from v group by sensor_id) using (sensor_id))
    group by ts_t"""


def chain(final: str, *ctes: str) -> str:
    return "with " + ", ".join(f"{ALIAS[c]} as ({c})" for c in ctes) + " " + final


D, H, RAW = deduped(), deduped("hour"), base(None)
HOUR_SCALED = NORMALIZED
V_HOUR = "select ts_t, sensor_id, norm as v from m"
V_FULL = "select ts_t, sensor_id, norm as v from m"
ALIAS = {
    D: "d", H: "c", RAW: "f", RUNS: "runs", FILLED: "f", CLEAN: "c", NORMALIZED: "m", FEATURES: "w",
    SCORED: "s", FLAGGED: "g", INSTANTS: "i", V_HOUR: "v",
}
FILL = (D, RUNS, FILLED)
WINDOWED = (*FILL, FEATURES, SCORED, FLAGGED)
CLEANED = (*FILL, CLEAN, NORMALIZED)
HOURLY = (H, NORMALIZED, V_HOUR, INSTANTS)
KEY = "sensor_id, ts_t as timestamp"

WINDOW_COLUMNS = [
    "rolling_avg", "moving_std", "rolling_min", "rolling_max", "lag_1", "lag_5", "rate_of_change",
    "z_score", "stability_score",
]

# Features of the cleaned table: the window features run on the same filled rows.
JOINED = """
    select g.*, m.norm as reading_normalized, m.outlier_flag, i.gas_concentration_est,
           coalesce(i.sensor_correlation, 0) as sensor_correlation
    from g join m using (sensor_id, ts_t) join i on i.ts_t = g.ts_t"""
ALIAS[JOINED] = "j"
FULL = (*FILL, CLEAN, NORMALIZED, V_FULL, INSTANTS, FEATURES, SCORED, FLAGGED, JOINED)

VECTORS = """
    select vec_id, timestamp '2025-01-01 00:00:00' + to_minutes(vec_id) as ts_t,
           unnest(range(0, 16)) as k, embedding
    from embeddings"""

FEED_RANK = """case event_type when 'signup' then 0 when 'click' then 1 when 'error' then 2
    when 'purchase' then 3 else 4 end"""

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
MODEL_COLUMNS = [
    "reading_value", "rolling_avg", "moving_std", "z_score", "rate_of_change",
    "sensor_correlation", "stability_score", "lag_1", "lag_5", "peak_frequency",
]


def _quality(select: str) -> str:
    rules = [
        ("sensor_id_non_null", "sensor_id", "sensor_id is null"),
        ("timestamp_non_null", "ts_t", "ts_t is null"),
        ("reading_range", "x", "x not between -5000 and 70000"),
        ("reading_value_non_null", "x", "x is null"),
        ("normalized_range", "reading_normalized", "reading_normalized not between 0 and 1"),
        ("anomaly_binary", "anomaly_flag", "anomaly_flag not in (0, 1)"),
    ]
    parts = " union all ".join(
        f"""select '{name}' as name, count(*) filter (where {bad}) = 0 as success,
            count(*) as element_count, count(*) filter (where {bad}) as unexpected_count,
            count(*) filter (where {col} is null) as missing_count from j"""
        for name, col, bad in rules
    )
    return chain(select.format(rules=parts), *FULL)


def _describe() -> str:
    parts = " union all ".join(
        f"""select '{c}' as feature, count({c}) as count, {r6(f"avg({c})", "mean")},
            {r6(f"stddev_samp({c})", "std")}, {r6(f"min({c})", "min")},
            {r6(f"quantile_cont(cast({c} as double), 0.25)", "q25")},
            {r6(f"quantile_cont(cast({c} as double), 0.5)", "q50")},
            {r6(f"quantile_cont(cast({c} as double), 0.75)", "q75")}, {r6(f"max({c})", "max")}
            from j"""
        for c in SUMMARY_FEATURES
    )
    return chain(parts, *FULL)


TOTALS = """select count(*) as row_count, count(distinct sensor_id) as sensor_count,
    avg(cast(x is null as int)) as missing, count(*) - count(distinct (sensor_id, ts_t)) as dups from {t}"""

ORACLE: dict[str, str] = {
    "scan_parquet": "select event_id, ts, user_id, event_type, value, props from events",
    "json_extract": """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
        '{"k":' || json_extract_string(props, '$.k') || '}' as again from events""",
    "union_of_feeds": f"""select event_id, printf('S%02d', cast(user_id % 16 + 1 as int)) as sensor_id,
        event_type as source, cast({FEED_RANK} as int) as priority from events""",
    "union_sources_last_feed_wins": f"""
        select {KEY}, {r6("x", "reading_value")}, event_type as source, cast(p as int) as priority, seq
        from (select b.*, e.event_type, {FEED_RANK} as p
              from ({base("minute")}) b join events e on e.event_id = b.seq)
        qualify row_number() over (partition by sensor_id, ts_t order by p desc, seq desc) = 1""",
    "parse_indexed_value": f"""select event_id, {r6('''case event_id % 5 when 2 then null
        when 4 then value * 10 else value end''', "number")} from events""",
    "usable_columns": """select printf('f%02d', k) as column_name,
        count(embedding[k]) filter (where not isnan(embedding[k])) as n_usable
        from (select unnest(range(1, 65)) as k, embedding from embeddings) group by k""",
    "channel_select": "select vec_id, " + ", ".join(
        r6(f"embedding[{4 * k + 1}]", s) for k, s in enumerate(SENSORS)) + " from embeddings",
    "assign_timestamps": """select vec_id, timestamp '2025-01-01 00:00:00'
        + to_minutes(row_number() over (order by vec_id) - 1) as timestamp from embeddings""",
    "wide_to_long_readings": f"""select printf('S%02d', cast(k + 1 as int)) as sensor_id, ts_t as timestamp,
        {r6("embedding[4 * k + 1]", "reading_value")}, 'mixed' as gas_type, 'sensor_signal' as unit,
        'batch' as source, 'batch_1' as load_batch_id from ({VECTORS})""",
    "positional_join_columns": f"""select row_number() over (order by vec_id) - 1 as row_index, vec_id, label,
        {r6("embedding[1]", "first")} from embeddings""",
    "parse_timestamp": f"""select event_id, case event_id % 4 when 3 then null
        when 2 then epoch_us(ts) - 19800000000 else epoch_us(ts) end as instant_us from events""",
    "partitioned_write_roundtrip": f"""select strftime(ts_t, '%Y-%m-%d') as reading_date, count(*) as n_rows,
        count(distinct sensor_id) as n_sensors, {r6("sum(x)", "total")} from ({D}) group by 1""",
    "drop_null_keys": """select * from (select
        case when event_type <> 'error' then printf('S%02d', cast(user_id % 16 + 1 as int)) end as sensor_id,
        case when event_type <> 'signup' then ts end as timestamp, event_id as seq from events)
        where sensor_id is not null and timestamp is not null""",
    "dedup_keep_last": f"select {KEY}, {r6('x', 'reading_value')}, seq from ({D})",
    "gap_fill_short": chain(f"select {KEY}, {r6('x', 'reading_value')}, is_imputed from f", *FILL),
    "missing_runs": chain(f"""select {KEY}, missing as is_missing, cast(run as bigint) as run_id,
        cast(sum(missing) over (partition by sensor_id, run) as bigint) as gap_size from runs""", D, RUNS),
    "minmax_normalize": chain(f"select {KEY}, {r6('norm', 'reading_normalized')} from m", *CLEANED),
    "rolling_min5": chain(
        f"select {KEY}, {r6('avg5', 'rolling_avg')}, {r6('std5', 'moving_std')} from c", *FILL, CLEAN),
    "outlier_flag": chain(f"select {KEY}, outlier_flag from c", *FILL, CLEAN),
    "cleaned_table": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6('avg5', 'rolling_avg')},
        {r6('std5', 'moving_std')}, {r6('norm', 'reading_normalized')}, is_imputed, outlier_flag,
        strftime(ts_t, '%Y-%m-%d') as reading_date from m""", *CLEANED),
    "rolling_stats": chain(f"""select {KEY},
        {r6_all(["rolling_avg", "moving_std", "rolling_min", "rolling_max"])} from w""", *FILL, FEATURES),
    "lags_roc": chain(
        f"select {KEY}, {r6_all(['lag_1', 'lag_5', 'rate_of_change'])} from w", *FILL, FEATURES),
    "z_score": chain(f"select {KEY}, {r6('z_score')} from s", *FILL, FEATURES, SCORED),
    "peak_frequency": chain(f"select {KEY}, peak_frequency from s", *FILL, FEATURES, SCORED),
    "stability_score": chain(f"select {KEY}, {r6('stability_score')} from s", *FILL, FEATURES, SCORED),
    "anomaly_flag": chain(f"select {KEY}, anomaly_flag from g", *WINDOWED),
    "time_features": f"""select {KEY}, cast(hour(ts_t) as int) as hour_of_day,
        cast(isodow(ts_t) >= 6 as int) as is_weekend, strftime(ts_t, '%Y-%m-%d') as reading_date from ({D})""",
    "sliding_window_aggregates": chain(f"""select {KEY}, {r6('rolling_avg', 'spark_rolling_avg')},
        {r6('moving_std', 'spark_moving_std')}, {r6('rolling_max', 'spark_max')},
        {r6('rolling_min', 'spark_min')}, {r6('rate_of_change', 'spark_rate_of_change')} from w""",
        *FILL, FEATURES),
    "rule_anomalies": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6_all(WINDOW_COLUMNS)}, is_imputed,
        hour_of_day, is_weekend, peak_frequency, anomaly_flag from g""", *WINDOWED),
    "feature_table": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6('reading_normalized')},
        {r6_all(WINDOW_COLUMNS)}, {r6('sensor_correlation')}, {r6('gas_concentration_est')}, is_imputed,
        outlier_flag, hour_of_day, is_weekend, peak_frequency, anomaly_flag, reading_date from j""", *FULL),
    "sensor_correlation": chain(
        f"select ts_t as timestamp, {r6('sensor_correlation')} from i where n > 0", *HOURLY),
    "gas_estimate": chain(f"select ts_t as timestamp, {r6('gas_concentration_est')} from i", *HOURLY),
    "correlation_matrix": f"""with p as (select ts_t, sensor_id, avg(x) as x from ({base('hour')}) group by all),
        s as (select distinct sensor_id from p)
        select s.sensor_id as sensor_a, o.sensor_id as sensor_b,
               {r6(CORR.format(x="a.x", y="b.x"), "correlation")}
        from s cross join s o join p a on a.sensor_id = s.sensor_id
             left join p b on b.sensor_id = o.sensor_id and b.ts_t = a.ts_t
        group by s.sensor_id, o.sensor_id""",
    "instant_similarity": chain(f"""select a as timestamp, {r6('avg(r)', 'instant_similarity')} from (
        select a.ts_t as a, b.ts_t as b, {CORR.format(x="a.v", y="b.v")} as r
        from v a join v b on a.sensor_id = b.sensor_id where a.v is not null and b.v is not null group by a.ts_t, b.ts_t)
        group by a""", H, NORMALIZED, V_HOUR),
    "pivot_mean": f"""select ts_t as timestamp, {", ".join(
        r6(f"avg(x) filter (where sensor_id = '{s}')", s) for s in SENSORS)}
        from ({base('hour')}) group by ts_t having count(x) > 0""",
    "model_matrix": chain(f"""select {KEY}, {", ".join(
        r6(f"coalesce({'x' if c == 'reading_value' else c}, 0)", c) for c in MODEL_COLUMNS)} from j""", *FULL),
    "contamination_threshold": chain(f"""select {KEY}, {r6('abs(z_score)', 'score')},
        cast(abs(z_score) > (select quantile_cont(abs(z_score), 0.97) from s) as int) as ml_anomaly
        from s""", *FILL, FEATURES, SCORED),
    "alerts": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6('z_score')}, 'SENSOR_ANOMALY' as alert
        from g where anomaly_flag = 1""", *WINDOWED),
    "recent_alerts_top100": f"""select printf('S%02d', cast(user_id % 16 + 1 as int)) as sensor_id,
        ts as timestamp, {r6('value')} from events where event_type = 'error'
        order by ts desc, sensor_id limit 100""",
    "quality_rules": _quality("{rules}"),
    "quality_consistency": f"""select row_count, sensor_count, dups as duplicate_sensor_timestamp_rows,
        dups = 0 and sensor_count = 16 as consistency_ok, {r6('missing', 'missing_rate')}
        from ({TOTALS.format(t=f"({base('minute')})")})""",
    "quality_report": _quality(f"""select (dups = 0 and sensor_count = 16 and n_failed = 0) as success, row_count,
        sensor_count, {r6('missing', 'missing_rate')}, dups as duplicate_sensor_timestamp_rows,
        dups = 0 and sensor_count = 16 as consistency_ok, n_failed
        from ({TOTALS.format(t='j')}) cross join
             (select count(*) filter (where not success) as n_failed from ({{rules}}))"""),
    "kpi_summary": chain(f"""select count(*) as readings, count(distinct sensor_id) as sensors,
        cast(sum(anomaly_flag) as bigint) as anomalies, {r6('avg(anomaly_flag)', 'anomaly_rate')},
        {r6('avg(cast(x is null as int))', 'missing_rate')} from g""", *WINDOWED),
    "duplicate_keys": f"""select cast(sum(n - 1) as bigint) as duplicate_rows
        from (select count(*) as n from ({base('minute')}) group by sensor_id, ts_t)""",
    "feature_describe": _describe(),
    "distinct_sensors": f"select distinct sensor_id from ({base('minute')})",
    "sensor_tail": chain(f"""select ts_t as timestamp, {r6('x', 'reading_value')}, {r6('rolling_avg')}, anomaly_flag
        from g where sensor_id = 'S01' order by ts_t desc limit 1000""", *WINDOWED),
    "sort_readings": f"select {KEY}, {r6('x', 'reading_value')}, seq from ({base('minute')}) order by 1, 2",
    "stream_rolling_features": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6_all(WINDOW_COLUMNS)},
        peak_frequency, anomaly_flag from g""", RAW, FEATURES, SCORED, FLAGGED),
    "stream_alert_feed": chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6('z_score')},
        'SENSOR_ANOMALY' as alert from g where anomaly_flag = 1""", RAW, FEATURES, SCORED, FLAGGED),
    "stream_dedup_keys": f"select distinct {KEY} from ({base('minute')})",
    "stream_ingest_messages": f"""select printf('S%02d', cast(k + 1 as int)) as sensor_id,
        epoch_us(ts_t) as instant_us, {r6("embedding[4 * k + 1]", "reading_value")},
        'http_stream' as source, 'stream' as load_batch_id from ({VECTORS})""",
}

# Deliveries and batches change nothing: the same rows as in one piece.
ORACLE["contamination_threshold_by_day"] = ORACLE["contamination_threshold"]
ORACLE["stream_upsert_readings"] = ORACLE["dedup_keep_last"]
ORACLE["stream_alerts_by_batches"] = ORACLE["alerts"]
ORACLE["stream_rolling_by_batches"] = chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6_all(WINDOW_COLUMNS)},
    is_imputed, peak_frequency, anomaly_flag from g""", *WINDOWED)
ORACLE["stream_scored_readings"] = chain(f"""select m.sensor_id, m.ts_t as timestamp, {r6('m.norm', 'reading_normalized')},
    {r6('i.sensor_correlation', 'sensor_correlation')}, {r6('i.gas_concentration_est', 'gas_concentration_est')}
    from m join i using (ts_t)""", *HOURLY)
ORACLE["recent_rule_alerts_top100"] = chain(f"""select {KEY}, {r6('x', 'reading_value')}, {r6('z_score')},
    'SENSOR_ANOMALY' as alert from g where anomaly_flag = 1 order by ts_t desc, sensor_id limit 100""", RAW, FEATURES, SCORED, FLAGGED)
