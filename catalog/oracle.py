"""SQL counterparts of the registered queries."""

from __future__ import annotations

from catalog.inputs import (
    CANDIDATES_SQL,
    DIRTY_SQL,
    FAULT_SQL,
    FRAMES,
    LINEITEM_SQL,
    RAW_SQL,
    RECORDING_SQL,
    RUNS_SQL,
    TIED_SQL,
)
from tracklane import schemas as S


def _round(expr: str, places: int) -> str:
    """Half away from zero on a double cut to eight decimals."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,8)), {places}) as double)"


def _mean(expr: str, places: int = 6) -> str:
    return f"cast(round(cast({expr} as decimal(20,8)), {places}) as double)"


def staged(frames: str, columns: str = "* exclude (vehicle_type, lat, lon, speed_ms, lon_acc_ms2, lat_acc_ms2)") -> str:
    return f"""select {columns}, trim(lower(vehicle_type)) as vehicle_type,
  {_round('lat', 6)} as lat, {_round('lon', 6)} as lon, {_round('speed_ms', 4)} as speed_ms,
  {_round('lon_acc_ms2', 4)} as lon_acc_ms2, {_round('lat_acc_ms2', 4)} as lat_acc_ms2
from ({frames}) where track_id is not null and vehicle_type is not null and lat is not null
  and lon is not null and speed_ms is not null and timestamp_s is not null"""


def summary(frames: str, rounded: bool = True) -> str:
    mean = _mean if rounded else (lambda e: e)
    return f"""select source_file, track_id, min(vehicle_type) as vehicle_type, count(*) as frame_count,
  min(timestamp_s) as start_time_s, max(timestamp_s) as end_time_s,
  max(timestamp_s) - min(timestamp_s) as duration_s, min(traveled_d_m) as traveled_d_m,
  min(avg_speed_ms) as avg_speed_ms, max(speed_ms) as max_speed_ms, min(speed_ms) as min_speed_ms,
  {mean('avg(lon_acc_ms2)')} as avg_lon_acc_ms2, {mean('avg(lat_acc_ms2)')} as avg_lat_acc_ms2,
  max(abs(lon_acc_ms2)) as max_lon_acc_ms2, max(abs(lat_acc_ms2)) as max_lat_acc_ms2,
  first(lat order by timestamp_s, lat, lon) as start_lat, first(lon order by timestamp_s, lat, lon) as start_lon,
  first(lat order by timestamp_s desc, lat desc, lon desc) as end_lat,
  first(lon order by timestamp_s desc, lat desc, lon desc) as end_lon
from ({staged(frames)}) group by source_file, track_id"""


SUMMARY = summary(RAW_SQL)
FACT = summary(RAW_SQL, rounded=False)


def checks_sql(source: str, checks: list[tuple[str, str, str, str, str]], skip: str = "") -> str:
    """One row per (check, aggregate, pass condition on x, expected, status if it does not pass)."""
    parts = [
        f"""select '{name}' as "check", case when {cond} then 'passed' else '{bad}' end as status, x as observed,
  '{expected}' as expected, case when not ({cond}) and '{bad}' = 'failed' then 'expected {expected}' end as detail
from (select cast({agg} as double) as x from src)"""
        for name, agg, cond, expected, bad in checks
    ]
    return f"with src as ({source}) " + " union all ".join(parts)


def none_sql(name: str, violation: str, bad: str = "failed") -> tuple[str, str, str, str, str]:
    return (name, f"count(*) filter (where {violation})", "x = 0", "0", bad)


def above_zero_sql(name: str, agg: str) -> tuple[str, str, str, str, str]:
    return (name, agg, "x > 0", "> 0", "failed")


def equals_sql(name: str, agg: str, n: int) -> tuple[str, str, str, str, str]:
    return (name, agg, f"x = {n}", str(n), "failed")


def not_null_sql(columns: list[str]) -> list[tuple[str, str, str, str, str]]:
    return [none_sql(f"not_null_{c}", f"{c} is null") for c in columns]


def unique_sql(name: str, columns: list[str]) -> tuple[str, str, str, str, str]:
    known = " and ".join(f"{c} is not null" for c in columns)
    key = "(" + ", ".join(columns) + ")" if len(columns) > 1 else columns[0]
    return (name, f"count(*) filter (where {known}) - count(distinct {key}) filter (where {known})", "x = 0", "0", "failed")


def accepted_sql(column: str, values: list[str]) -> tuple[str, str, str, str, str]:
    listed = ", ".join(f"'{v}'" for v in values)
    return none_sql(f"accepted_{column}", f"{column} is not null and {column} not in ({listed})")


_OUT_LAT = f"lat < {S.LAT_MIN}::double or lat > {S.LAT_MAX}::double"
_OUT_LON = f"lon < {S.LON_MIN}::double or lon > {S.LON_MAX}::double"
_BLANK = "({0} is null or {0} = '')"
_SPEED = "min_speed_ms < 0 or max_speed_ms < 0"
_KEY = ["source_file", "track_id"]
_SILVER_SQL = f"""select * exclude (id, file_hash, ingested_at),
  case when id % 307 = 0 then '' else 'bronze/recordings.zip' end as bronze_key, ingested_at from ({DIRTY_SQL})"""

_SUMMARY_RULES = [
    none_sql("frame_count_positive", "frame_count < 1"),
    none_sql("duration_non_negative", "duration_s < 0"),
    none_sql("distance_non_negative", "traveled_d_m < 0"),
]
_DIM = f"""select vehicle_type, count(*) as trajectory_count,
  avg(traveled_d_m) as average_traveled_distance_m, avg(avg_speed_ms) as average_speed_ms,
  avg(duration_s) as average_duration_s from ({FACT}) group by vehicle_type"""

_SHIFTED = f"""select * replace (
  case when track_id % 11 = 0 then frame_count + 1 else frame_count end as frame_count,
  case when track_id % 7 = 0 then duration_s + 0.01 else duration_s + 0.0000005 end as duration_s,
  case when track_id % 17 = 0 then 'tram' else vehicle_type end as vehicle_type,
  case when track_id % 19 = 0 then null else max_speed_ms end as max_speed_ms)
from ({FACT}) where track_id % 23 <> 0
union all by name
select * replace ('extra_' || source_file as source_file) from ({FACT}) where track_id % 29 = 0"""

_REFERENCE = f"with l as ({FACT}), r as ({_SHIFTED})"
_PARITY = f"""{_REFERENCE},
pairs as (select l.source_file, l.track_id, l.frame_count lf, r.frame_count rf, l.duration_s ld, r.duration_s rd,
  l.vehicle_type lv, r.vehicle_type rv, l.max_speed_ms ls, r.max_speed_ms rs
  from l join r on l.source_file = r.source_file and l.track_id = r.track_id),
diffs as (
select source_file, track_id, 'mismatch' as kind, 'frame_count' as field from pairs where lf <> rf
union all select source_file, track_id, 'mismatch', 'duration_s' from pairs where abs(ld - rd) > 1e-6
union all select source_file, track_id, 'mismatch', 'vehicle_type' from pairs where lv <> rv
union all select source_file, track_id, 'mismatch', 'max_speed_ms' from pairs where rs is null
union all select source_file, track_id, 'missing_in_right', null from l anti join r using (source_file, track_id)
union all select source_file, track_id, 'missing_in_left', null from r anti join l using (source_file, track_id))"""

_REPLACED = f"""select * replace ({_mean('avg_lon_acc_ms2')} as avg_lon_acc_ms2, {_mean('avg_lat_acc_ms2')} as avg_lat_acc_ms2)
from ({{0}})"""


def _published(snapshot: bool) -> str:
    """All sources published, then click and view again with every track moved by one million."""
    again = f"""select * replace (track_id + 1000000 as track_id) from ({FACT}) where source_file in ('click.csv', 'view.csv')"""
    kept = f"select * from ({FACT}) where source_file not in ('click.csv', 'view.csv')"
    return _REPLACED.format(again if snapshot else f"{kept} union all by name {again}")


_PATH = r"regexp_replace(regexp_extract(url, '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)', 3), ';[^/]*$', '')"
_HOST = r"regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)"

# Records of a file that arrives, and the damaged ones among them.
ARRIVING = 64
_THIRD = f"track % {ARRIVING} between 10 and 14"

FRAME_COLUMNS = ", ".join(S.names(S.FRAME))
_STEPS = f"""select source_file, track_id, timestamp_s,
  timestamp_s - lag(timestamp_s) over (partition by source_file, track_id order by timestamp_s, lat, lon) as step_s"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "stage_frames": staged(DIRTY_SQL).replace("* exclude (", "* exclude (id, ", 1).replace(
            "select *", "select id as raw_id, *", 1
        ),
        "trajectory_summary": SUMMARY,
        "trajectory_summary_dirty": summary(DIRTY_SQL),
        "trajectory_summary_tied": summary(TIED_SQL),
        "trajectory_summary_lineitem": summary(LINEITEM_SQL),
        "trajectory_summary_kmh": summary(
            f"select * replace (avg_speed_ms / 3.6::double as avg_speed_ms, speed_ms / 3.6::double as speed_ms) from ({RAW_SQL})"
        ),
        "summary_from_serving": SUMMARY,
        "trajectory_fact": SUMMARY,
        "vehicle_type_dim": f"""select vehicle_type, trajectory_count, {_mean('average_traveled_distance_m')} as average_traveled_distance_m,
  {_mean('average_speed_ms')} as average_speed_ms, {_mean('average_duration_s', 3)} as average_duration_s from ({_DIM})""",
        "traffic_kpis": f"""select count(*) as total_trajectories, {_mean('avg(avg_speed_ms)', 2)} as avg_speed_ms,
  {_mean('avg(traveled_d_m)', 2)} as avg_distance_m, {_mean('avg(duration_s)', 2)} as avg_duration_s from ({FACT})""",
        "trajectories_by_vehicle_type": f"""select vehicle_type, count(*) as trajectory_count from ({FACT})
  group by vehicle_type order by trajectory_count desc, vehicle_type""",
        "avg_speed_by_vehicle_type": f"""select vehicle_type, {_mean('avg(avg_speed_ms)', 2)} as avg_speed_ms from ({FACT})
  group by vehicle_type order by avg_speed_ms desc, vehicle_type""",
        "frame_steps": f"{_STEPS} from ({staged(RAW_SQL)})",
        "metrics": f"""select count(*) as row_count, count(distinct source_file) as source_count,
  count(*) as distinct_grain, cast(sum(frame_count) as bigint) as sum_frame_count from ({FACT})""",
        "duplicate_keys": f"""select source_file, track_id, count(*) as row_count from ({RAW_SQL})
  group by source_file, track_id having count(*) > 1""",
        "frame_checks": checks_sql(
            _SILVER_SQL,
            [
                above_zero_sql("row_count_positive", "count(*)"),
                ("expected_row_count", "count(*)", "x = (select count(*) from events)", "' || (select count(*) from events) || '", "failed"),
                *not_null_sql(S.names(S.SILVER)),
                none_sql("latitude_in_bounds", _OUT_LAT),
                none_sql("longitude_in_bounds", _OUT_LON),
                none_sql("speed_non_negative", "speed_ms < 0"),
                none_sql("source_file_populated", _BLANK.format("source_file")),
                none_sql("bronze_key_populated", _BLANK.format("bronze_key")),
                above_zero_sql("source_files_present", "count(distinct source_file)"),
                *[
                    none_sql(f"nan_{c}", f"isnan({c})", "warning")
                    for c in ["lat", "lon", "speed_ms", "lon_acc_ms2", "lat_acc_ms2", "timestamp_s"]
                ],
            ],
        ),
        "summary_checks": checks_sql(
            f"select * replace (case when track_id % 9 = 0 then -duration_s else duration_s end as duration_s) from ({FACT})",
            [
                above_zero_sql("row_count_positive", "count(*)"),
                *not_null_sql(S.names(S.SUMMARY)),
                unique_sql("grain_unique", _KEY),
                _SUMMARY_RULES[0],
                none_sql("time_order", "start_time_s > end_time_s"),
                *_SUMMARY_RULES[1:],
                none_sql("speed_non_negative", _SPEED),
                none_sql("source_file_populated", _BLANK.format("source_file")),
            ],
        ),
        "serving_checks": checks_sql(
            f"{FACT} union all by name select * replace (start_time_s + 1e9 as start_time_s) from ({FACT}) where track_id % 31 = 0",
            [
                above_zero_sql("row_count_positive", "count(*)"),
                unique_sql("grain_unique", _KEY),
                ("frame_count_positive", "coalesce(min(frame_count), 0)", "x > 0", "> 0", "failed"),
                none_sql("duration_non_negative", "duration_s < 0"),
                none_sql("distance_non_negative", "traveled_d_m < 0"),
                none_sql("speed_non_negative", _SPEED),
                none_sql("time_order", "start_time_s > end_time_s"),
                none_sql("grain_not_null", "source_file is null or track_id is null"),
                equals_sql("expected_row_count", "count(*)", 1),
                equals_sql("expected_frame_sum", "coalesce(sum(frame_count), 0)", 1),
            ],
        ),
        "raw_column_checks": checks_sql(
            f"select * replace (trim(vehicle_type) as vehicle_type) from ({DIRTY_SQL})",
            [
                *not_null_sql(S.names(S.RAW)),
                unique_sql("unique_id", ["id"]),
                accepted_sql("vehicle_type", S.RAW_VEHICLE_TYPES),
                none_sql("coordinates_valid", f"{_OUT_LAT} or {_OUT_LON}"),
                none_sql("speed_non_negative", "speed_ms < 0"),
            ],
        ),
        "staging_column_checks": checks_sql(
            f"select *, id as raw_id from ({staged(DIRTY_SQL)})",
            [
                *not_null_sql(["raw_id", "source_file", *S.names(S.FRAME)[1:]]),
                unique_sql("unique_raw_id", ["raw_id"]),
                accepted_sql("vehicle_type", S.VEHICLE_TYPES),
            ],
        ),
        "summary_column_checks": checks_sql(FACT, [*not_null_sql(S.names(S.SUMMARY)), unique_sql("grain_unique", _KEY)]),
        "fact_column_checks": checks_sql(
            summary(DIRTY_SQL, rounded=False),
            [
                *not_null_sql(S.names(S.SUMMARY)),
                accepted_sql("vehicle_type", S.VEHICLE_TYPES),
                unique_sql("grain_unique", _KEY),
                *_SUMMARY_RULES,
            ],
        ),
        "vehicle_type_dim_column_checks": checks_sql(
            _DIM, [*not_null_sql(S.names(S.VEHICLE_TYPE_DIM)), unique_sql("unique_vehicle_type", ["vehicle_type"])]
        ),
        "serving_column_checks": checks_sql(FACT, not_null_sql(["source_file", "track_id", "vehicle_type", "frame_count"])),
        "run_column_checks": checks_sql(
            RUNS_SQL,
            [
                *not_null_sql(["run_id", "status", "started_at"]),
                unique_sql("unique_run_id", ["run_id"]),
                accepted_sql("status", S.RUN_STATUSES),
            ],
        ),
        "frames_conserved": f"""with f as (select * from ({DIRTY_SQL})), u as (select count(*) n from ({staged(DIRTY_SQL)})),
  s as (select sum(frame_count) n from ({summary(DIRTY_SQL)}))
  select 'frames_conserved' as "check", case when u.n = s.n then 'passed' else 'failed' end as status,
  cast(s.n as double) as observed, cast(u.n as varchar) as expected,
  ((select count(*) from f) - u.n) || ' frames without a required value' as detail from u, s""",
        "reject_gate": f"""with t as (select distinct track, {FAULT_SQL} as reason from ({RECORDING_SQL}))
  select 'reject_fraction' as "check",
  case when count(reason) / count(*)::double <= 0.01 then 'passed' else 'failed' end as status,
  count(reason) / count(*)::double as observed, '<= 0.01' as expected,
  count(reason) || ' of ' || count(*) as detail from t""",
        "check_published": f"""with s as ({FACT}), b as (select * replace (frame_count + 1 as frame_count) from s where source_file = 'view.csv'),
  t as (select (select count(*) from s where source_file = 'view.csv') r0, (select count(*) from b) r1,
    (select sum(frame_count) from s where source_file = 'view.csv') f0, (select sum(frame_count) from b) f1)
  select 'serving_rows_positive' as "check", case when r0 > 0 then 'passed' else 'failed' end as status,
    cast(r0 as double) as observed, '> 0' as expected, cast(null as varchar) as detail from t
  union all select 'serving_rows_eq_summary', case when r0 = r1 then 'passed' else 'failed' end, r0, cast(r1 as varchar), null from t
  union all select 'serving_frames_eq_summary', case when f0 = f1 then 'passed' else 'failed' end, f0, cast(cast(f1 as bigint) as varchar), null from t
  union all select 'grain_unique', 'passed', r0, cast(r0 as varchar), null from t""",
        "fact_rows_eq_serving": f"""with f as ({FACT}), n as (select count(*) as whole, count(*) filter (where source_file <> 'view.csv') as short from f)
  select 'fact_rows_eq_serving_whole' as "check", 'passed' as status, cast(whole as double) as observed, cast(whole as varchar) as expected,
    cast(null as varchar) as detail from n
  union all select 'fact_rows_eq_serving_short', case when whole = short then 'passed' else 'failed' end, whole, cast(short as varchar), null from n""",
        "damaged_layers": f"""with n as (select cast(count(*) as double) as n from ({FACT})), cases(c, names, names_by, names_detail, types, types_by, types_detail, lat, lat_by, lat_detail) as (values
    ('whole', 'passed', 0, null, 'passed', 0, null, 'passed', 0, null),
    ('column_missing', 'failed', 1, 'missing: [''end_lat''], extra: []', 'passed', 0, null, 'skipped', null, 'column missing'),
    ('column_too_many', 'failed', 1, 'missing: [], extra: [''extra'']', 'passed', 0, null, 'passed', 0, null),
    ('other_type', 'passed', 0, null, 'failed', 1, 'frame_count: expected bigint, got double', 'passed', 0, null))
  select c as "case", 'readable' as "check", 'passed' as status, cast(null as double) as observed, cast(null as varchar) as detail from cases
  union all select c, 'schema_names', names, names_by, names_detail from cases
  union all select c, 'schema_types', types, types_by, types_detail from cases
  union all select c, 'not_null_end_lat', lat, lat_by, lat_detail from cases
  union all select c, 'row_count_positive', 'passed', n, null from cases, n
  union all select 'unreadable', 'readable', 'failed', null, null
  union all select 'unreadable', 'not_null_end_lat', 'skipped', null, null union all select 'unreadable', 'row_count_positive', 'skipped', null, null""",
        "assembled_records": f"""select source_file, track, count(*) as line_count, count(distinct event_id) as frame_count from (
    select event_id, source_file, track, unnest(range(1 + cast(event_id % 7 <> 0 as integer) + cast(event_id % 11 = 5 as integer))) as part
    from ({RECORDING_SQL})) group by source_file, track""",
        "parse_frames": f"select {FRAME_COLUMNS} from ({RECORDING_SQL})",
        "repair_frames": f"select {FRAME_COLUMNS} from ({RECORDING_SQL})",
        "read_recordings": f"select {FRAME_COLUMNS} from ({RECORDING_SQL})".replace("source_file, ", "", 1),
        "read_recording_lines": f"select {FRAME_COLUMNS} from ({RECORDING_SQL})".replace("source_file, ", "", 1),
        "read_archive": f"select track_id, count(*) as frame_count, max(timestamp_s) as end_time_s from ({RECORDING_SQL}) group by track_id",
        "archive_lines": f"""select cast(sum(1 + cast(event_id % 7 <> 0 as integer) + cast(event_id % 11 = 5 as integer)) as bigint)
  as line_count from ({RECORDING_SQL})""",
        "parse_rejects": f"""select * from (select source_file, cast(track as varchar) as track_id, {FAULT_SQL} as reason_code,
  row_number() over (partition by source_file order by track) as record_no
  from (select distinct source_file, track from ({RECORDING_SQL}))) where reason_code is not null""",
        "parse_totals": f"""with t as (select track, count(*) n, any_value({FAULT_SQL}) as reason from ({RECORDING_SQL}) group by track)
  select count(*) filter (where reason is null) as record_count, count(*) filter (where reason is null) as track_count,
  cast(coalesce(sum(n) filter (where reason is null), 0) as bigint) as frame_count, count(reason) as rejected_count from t""",
        "limited_records": f"""select source_file, track, record_no from (select source_file, track,
  row_number() over (partition by source_file order by track) as record_no
  from (select distinct source_file, track from ({RECORDING_SQL}))) where record_no <= 10""",
        "repair_tokens": f"""select event_id, lat, lon,
  case when speed_ms <= 200 then speed_ms end as speed_ms, timestamp_s from ({RECORDING_SQL})""",
        "boundary_candidates": f"""with c as (select event_id, split_part(cast(lat as varchar), '.', 1) as l, split_part(cast(lat as varchar), '.', 2) as r,
    printf('%.2f', lon_acc_ms2) as acc from ({RECORDING_SQL})),
  t as (select event_id, 'latitudes' as kind, l, r from c union all select event_id, 'accelerations', acc[1:2], acc[3:] from c),
  listed as (select event_id, kind, [l || r] || case when contains(l || r, '.') then [] else [l || '.' || r] end
    || list_transform(range(10), lambda d: l || d || r)
    || list_transform(range(10), lambda d: case when l[1] = '-' then '-' || d || l[2:] else d || l end || r) as options from t),
  kept as (select event_id, kind, list_aggregate(list_filter(options, lambda x, i: list_position(options, x) = i), 'string_agg', ' ') as options from listed)
  select event_id, max(options) filter (where kind = 'latitudes') as latitudes, max(options) filter (where kind = 'accelerations') as accelerations
  from kept group by event_id""",
        "parity_differences": f"{_PARITY} select * from diffs",
        "parity_totals": f"""{_PARITY} select (select count(*) from l) as left_rows, (select count(*) from r) as right_rows,
  (select count(*) from pairs) as compared_keys,
  count(*) filter (where kind = 'missing_in_right') as missing_in_right,
  count(*) filter (where kind = 'missing_in_left') as missing_in_left,
  count(*) filter (where kind = 'mismatch') as field_mismatches, false as passed from diffs""",
        "parity_verdicts": " union all ".join(
            f"""select '{case}' as "case", (select count(*) from ({FACT})) as left_rows, (select count(*) from ({right})) as right_rows,
  count(*) filter (where r.track_id is not null) as compared_keys, count(*) filter (where r.track_id is null) as missing_in_right,
  cast(0 as bigint) as missing_in_left, count(*) filter (where abs(l.duration_s - r.duration_s) > 1e-6) as field_mismatches,
  count(*) filter (where r.track_id is null or abs(l.duration_s - r.duration_s) > 1e-6) = 0 as passed
  from ({FACT}) l left join ({right}) r on l.source_file = r.source_file and l.track_id = r.track_id"""
            for case, right in {
                "same": f"select * replace (duration_s + 0.0000005 as duration_s) from ({FACT})",
                "shifted": f"select * replace (duration_s + case when track_id % 7 = 0 then 0.01 else 0 end as duration_s) from ({FACT})",
                "short": f"select * from ({FACT}) where track_id % 23 <> 0",
            }.items()
        ),
        "parity_options": f"""{_PARITY} select source_file, track_id, case when field = 'vehicle_type' then 'unclassified' else kind end as kind, field
  from diffs where field is null or field <> 'duration_s'""",
        "parity_duplicates": f"""select source_file, track_id, 'right' as side, case when track_id % 6 = 0 then 3 else 2 end as row_count, 3 as refused
  from ({FACT}) where track_id % 3 = 0""",
        "archive_members": """select (doc_id // 64) || '.zip' as archive,
  case doc_id % 9 when 1 then '__MACOSX/' when 2 then 'deep/.' when 3 then 'deep/' else '' end || doc_id
    || case doc_id % 9 when 4 then '.txt' when 5 then '.CSV' else '.csv' end as member,
  strlen(coalesce(text, '')) as size, strlen(coalesce(text, '')) as compressed_size, doc_id % 9 not in (1, 2, 4) as eligible from documents""",
        "hashed_files": """select 'bundle' || (doc_id // 64) || '.csv' as source_file, strlen(string_agg(coalesce(text, ''), chr(10) order by doc_id)) + 1 as size,
  sha256(string_agg(coalesce(text, ''), chr(10) order by doc_id) || chr(10)) as file_hash from documents where (doc_id // 64) % 5 <> 4 group by doc_id // 64""",
        "storage_footprint": f"""select count(distinct source_file) as file_count, count(*) as row_count, true as bytes_as_listed, true as projected_in_proportion
  from ({FACT})""",
        "declared_table": SUMMARY,
        "new_files_log": f"""with t as (select distinct track, track // {ARRIVING} as folder, 'rec' || (track % 5) || '_' || (track // {ARRIVING}) || '.csv' as source_file,
    ({_THIRD}) as bad, track % {ARRIVING} < 32 as early, (select count(*) from ({RECORDING_SQL}) f where f.track = r.track) as frames from ({RECORDING_SQL}) r),
  loads as (select 1 as run, source_file, sum(case when bad then 0 else frames end) as rows_loaded, count(*) filter (where bad) as rows_rejected from t where folder % 2 = 0 group by source_file
    union all select 2, source_file, sum(case when bad then 0 else frames end), count(*) filter (where bad) from t
      where folder % 2 = 1 or folder % 6 = 0 and early and source_file in (select source_file from t where not early) group by source_file),
  present as (select 2 as run, source_file from t where folder % 2 = 0 union select 3, source_file from t)
  select run, source_file, 'success' as status, cast(rows_loaded as bigint) as rows_loaded, rows_rejected from loads
  union all select run, source_file, 'skipped', 0, 0 from present p where not exists (select 1 from loads l where l.run = p.run and l.source_file = p.source_file)""",
        "new_files_raw": f"""select {FRAME_COLUMNS.replace('source_file', "'rec' || (track % 5) || '_' || (track // " + str(ARRIVING) + ") || '.csv' as source_file", 1)}, true as of_last_content
  from ({RECORDING_SQL}) where not ({_THIRD}) and ((track // {ARRIVING}) % 6 <> 0 or track % {ARRIVING} < 32)""",
        "parity_first_differences": f"{_PARITY} select * from diffs where kind = 'mismatch' order by source_file, track_id, field limit 20",
        "missing_keys": f"{_REFERENCE} select source_file, track_id from l anti join r using (source_file, track_id)",
        "shared_keys": f"{_REFERENCE} select source_file, track_id from l intersect select source_file, track_id from r",
        "publish_replace_sources": _published(False),
        "publish_replace_snapshot": _published(True),
        "replace_sources": _published(False),
        "publish_rejected": SUMMARY,
        "stream_publish": SUMMARY,
        "publish_seen_whole": f"""with f as ({FACT}), moved as (select source_file, track_id + 1000000 as track_id, frame_count from f where source_file in ('click.csv', 'view.csv')),
  kept as (select source_file, track_id, frame_count from f where source_file not in ('click.csv', 'view.csv', 'purchase.csv')),
  phases as (select 'before' as phase, source_file, track_id, frame_count from f union all select 'written', source_file, track_id, frame_count from f
    union all select 'switched', * from moved union all select 'switched', * from kept)
  select phase, source_file, count(*) as tracks, cast(sum(frame_count) as bigint) as frames, min(track_id) as first_track from phases group by phase, source_file""",
        "stream_recordings_late": f"""with f as ({RECORDING_SQL}),
  files as (select source_file, count(distinct track // {ARRIVING}) as file_count from f group by source_file)
  select s.*, file_count, 1 as failed_runs from ({summary(f"select * from ({RECORDING_SQL}) where not ({_THIRD})")}) s join files using (source_file)""",
        "stream_rejects": f"""select source_file, 'part' || (track // {ARRIVING}) || '/' || source_file as file, record_no, cast(track as varchar) as track_id,
  'bad_header_number' as reason_code from (select source_file, track,
    row_number() over (partition by source_file, track // {ARRIVING} order by track) as record_no
    from (select distinct source_file, track from ({RECORDING_SQL}))) where {_THIRD}""",
        "load_header_only_source": f"""select * from ({summary(f"select * replace (replace(source_file, '.csv', '/') || (track // {ARRIVING}) || '.csv' as source_file) from ({RECORDING_SQL})")})
  where track_id % 5 > 2 or track_id % 5 = 2 and (track_id % 2 = 0
    or not exists (select 1 from ({RECORDING_SQL}) r where r.track % 5 = 2 and r.track % 2 = 0 and r.track // {ARRIVING} = track_id // {ARRIVING}))""",
        "nested_recordings": f"""select {FRAME_COLUMNS.replace('source_file', "'part' || (track // " + str(ARRIVING) + ") || '/' || source_file as source_file", 1)}, reader
  from ({RECORDING_SQL}), (values ('ranges'), ('lines')) t(reader) where not ({_THIRD})""",
        "archive_members_of_one_name": f"""select {FRAME_COLUMNS.replace('source_file', "(track // " + str(ARRIVING) + ") || '.zip/m' || (track % 5) || '/rec.csv' as source_file", 1)}, reader
  from ({RECORDING_SQL}), (values ('ranges'), ('lines')) t(reader) where not ({_THIRD})""",
        "published_sources": f"select distinct source_file from ({FACT}) order by source_file",
        "load_recordings_end_to_end": f"select * exclude (source_file) from ({summary(RECORDING_SQL)})",
        "load_gate_holds": f"""select * exclude (source_file), 'failed success' as statuses
  from ({summary(f"select * from ({RECORDING_SQL}) where track % 2 = 0")})""",
        "load_emptied_source": f"""select * exclude (source_file), (select count(distinct track) from ({RECORDING_SQL})
  where track % 2 = 0) as served_before from ({summary(f"select * from ({RECORDING_SQL}) where track <> 0")})""",
        "provenance": f"""select {FRAME_COLUMNS}, 'bronze/recordings.zip' as bronze_key,
  epoch_us(timestamp '2024-01-02') as ingested_at from ({RECORDING_SQL})""",
        "exported_summary": SUMMARY,
        "repair_accelerations": f"""select event_id, plain, case when abs(plain) <= {S.REPAIRED_ACCELERATION_MAX} then plain end as repaired
  from (select event_id, cast(printf('%.2f', lon_acc_ms2) as double) as plain from ({RECORDING_SQL}))""",
        "stage_runs": f"""select run_id, dag_id, task_id, source_file, status, coalesce(rows_loaded, 0) as rows_loaded,
  coalesce(rows_rejected, 0) as rows_rejected, error_message, started_at, finished_at, duration_s,
  status = 'success' as is_success, status = 'failed' as is_failed, status = 'skipped' as is_skipped from ({RUNS_SQL})""",
        "failed_without_rerun": f"""with runs as ({RUNS_SQL}) select distinct source_file from runs where status = 'failed'
  and started_at >= timestamp '2000-01-01' - interval '4000 hours'
  and source_file not in (select source_file from runs where status = 'success')""",
        "pending_files": f"""select * from ({CANDIDATES_SQL}) anti join (select source_file, file_hash from ({RUNS_SQL})
  where status = 'success') using (source_file, file_hash)""",
        "loaded_files": f"""select * from ({CANDIDATES_SQL}) semi join (select source_file, file_hash from ({RUNS_SQL})
  where status = 'success') using (source_file, file_hash)""",
        "object_names": f"select page_id, nullif(regexp_extract(rtrim({_PATH}, '/'), '[^/]*$'), '') as object_name from pages",
        "safe_urls": f"""select page_id, lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://' || lower({_HOST}) || {_PATH} as safe_url from pages""",
    }
    assert FRAMES == 20
    return sql
