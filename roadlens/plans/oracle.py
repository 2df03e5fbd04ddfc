"""DuckDB SQL computing the same rows as each registered query.

Written independently of the Spark plans (plain window functions, ordered
aggregates and self-contained CTEs over the driver's views), so the
comparison checks the Spark operators rather than repeating them.
"""

from __future__ import annotations

from roadlens.plans import params as P

# Passes from events (same adapter as roadlens.sources.events), legal plates only.
_PASSES = """
passes AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         lpad(CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 9 AS VARCHAR), 4, '0') AS monitor_id,
         lpad(CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR), 5, '0') AS camera_id,
         'U' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS car,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS speed,
         event_type AS road_id,
         lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS area_id,
         event_id
  FROM events
),
flow AS (SELECT * FROM passes WHERE car IS NOT NULL AND trim(car) <> '')"""

_ORDER = "action_time, monitor_id, camera_id, event_id"
_ORDER_DESC = "action_time DESC, monitor_id DESC, camera_id DESC, event_id DESC"
_DETAIL = "date, monitor_id, camera_id, car, action_time, speed, road_id"
_FLOW_COLS = "date, monitor_id, camera_id, car, action_time, speed, road_id, area_id"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((_PASSES,) + ctes) + "\n"


# The same with blank plates, null monitors and bad times mixed in.
_DIRTY = _PASSES.split("flow AS")[0].replace("passes AS", "clean AS") + """
passes AS (
  SELECT date, CASE WHEN event_id % 13 = 0 THEN NULL ELSE monitor_id END AS monitor_id, camera_id,
         CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 11 = 1 THEN NULL ELSE car END AS car,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 17 = 1 THEN 'garbage'
              WHEN event_id % 17 = 2 THEN left(action_time, 10) ELSE action_time END AS action_time,
         speed, road_id, area_id, event_id FROM clean
),
legal AS (SELECT * FROM passes WHERE car IS NOT NULL AND trim(car) <> '')"""
_GOOD_TIME = "regexp_full_match(action_time, '[0-9-]{10} [0-9:]{8}')"


def _with_dirty(*ctes: str) -> str:
    return "WITH " + ",\n".join((_DIRTY,) + ctes) + "\n"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


_HH = "split_part(split_part(action_time, ' ', 2), ':', 1)"
_MM = "CAST(split_part(split_part(action_time, ' ', 2), ':', 2) AS INTEGER)"
_DAY = "split_part(action_time, ' ', 1)"
_DATE_HOUR = f"({_DAY} || '_' || {_HH})"
_RANGE = (f"({_DAY} || ' ' || {_HH} || ':' || lpad(CAST({_MM} - {_MM} % 5 AS VARCHAR), 2, '0') || '~' || {_DAY} || ' ' || "
          f"CASE WHEN {_MM} - {_MM} % 5 = 55 THEN lpad(CAST(CAST({_HH} AS INTEGER) + 1 AS VARCHAR), 2, '0') || ':00' "
          f"ELSE {_HH} || ':' || lpad(CAST({_MM} - {_MM} % 5 + 5 AS VARCHAR), 2, '0') END)")


def _path_counts_cte(path: list[str]) -> str:
    k = len(path)
    leads = ", ".join(f"lead(monitor_id, {j}) OVER w AS m{j}" for j in range(1, k))
    sums = []
    for i in range(1, k + 1):
        cond = " AND ".join(["monitor_id = " + _lit(path[0])] + [f"m{j} = {_lit(path[j])}" for j in range(1, i)])
        sums.append(f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT) AS c{i}")
    steps = []
    for i in range(1, k + 1):
        prev = f"c{i - 1}" if i > 1 else "CAST(NULL AS BIGINT)"
        steps.append(f"SELECT {i} AS step, {_lit(','.join(path[:i]))} AS path, c{i} AS cnt, {prev} AS prev_cnt FROM totals")
    return (f"seqs AS (SELECT monitor_id{', ' + leads if leads else ''} FROM flow "
            f"WINDOW w AS (PARTITION BY car ORDER BY {_ORDER})),\n"
            f"totals AS (SELECT {', '.join(sums)} FROM seqs),\n"
            f"steps AS ({' UNION ALL '.join(steps)})")


def _many_paths(paths: dict[str, list[str]]) -> str:
    longest = max(map(len, paths.values()))
    leads = ", ".join(f"lead(monitor_id, {j}) OVER w AS m{j}" for j in range(longest))
    texts = ", ".join(_lit(",".join(path)) for path in paths.values())
    runs = " UNION ALL ".join(
        f"SELECT {' || chr(44) || '.join(f'm{j}' for j in range(i))} AS path FROM seqs" for i in range(1, longest + 1))
    return (f"paths AS (SELECT unnest([{', '.join(map(_lit, paths))}]) AS path_id, "
            f"unnest([{texts}]) AS whole),\n"
            "prefixes AS (SELECT path_id, CAST(step AS INTEGER) AS step, "
            "array_to_string(string_split(whole, ',')[:step], ',') AS path "
            "FROM (SELECT *, unnest(generate_series(1, len(string_split(whole, ',')))) AS step FROM paths)),\n"
            f"seqs AS (SELECT {leads} FROM flow WINDOW w AS (PARTITION BY car ORDER BY {_ORDER})),\n"
            f"runs AS (SELECT path, count(*) AS n FROM ({runs}) GROUP BY path),\n"
            "counts AS (SELECT path_id, step, path, coalesce(n, 0) AS cnt FROM prefixes LEFT JOIN runs USING (path)),\n"
            "steps AS (SELECT *, lag(cnt) OVER (PARTITION BY path_id ORDER BY step) AS prev_cnt FROM counts)")


def _with_range(*ctes: str) -> str:
    """``flow`` are the legal passes of the stored tasks' dates."""
    legal = _PASSES.replace("flow AS", "legal AS")
    span = f"flow AS (SELECT * FROM legal WHERE date BETWEEN {_lit(P.RANGE_START)} AND {_lit(P.RANGE_END)})"
    return "WITH " + ",\n".join((legal, span) + ctes) + "\n"


def _hour_cars_cte() -> str:
    return (f"hour_cars AS (SELECT DISTINCT {_DAY} AS date, {_DATE_HOUR} AS date_hour, car FROM flow),\n"
            "counts AS (SELECT date, date_hour, count(*) AS cars FROM hour_cars GROUP BY date, date_hour)")


def _quota_cte(extract_num: int) -> str:
    return (_hour_cars_cte() + ",\n"
            "ndays AS (SELECT count(DISTINCT date) AS n FROM counts),\n"
            "quota AS (SELECT date, date_hour, cars, CAST(least(cars, floor(CAST(cars AS DOUBLE) / "
            "CAST(sum(cars) OVER (PARTITION BY date) AS DOUBLE) * "
            f"CAST({extract_num} // n AS DOUBLE))) AS BIGINT) AS quota FROM counts, ndays)")


def _sample_cte(extract_num: int, seed: int) -> str:
    return (_quota_cte(extract_num) + ",\n"
            "ranked AS (SELECT h.date, h.date_hour, h.car, row_number() OVER (PARTITION BY h.date_hour "
            f"ORDER BY md5(h.car || '|' || h.date_hour || '|' || {_lit(str(seed))}), h.car) AS rn FROM hour_cars h),\n"
            "sampled AS (SELECT r.date, r.date_hour, r.car FROM ranked r JOIN quota q "
            "ON r.date = q.date AND r.date_hour = q.date_hour WHERE r.rn <= q.quota)")


def _track_select(source: str) -> str:
    return (f"SELECT (array_agg(date ORDER BY {_ORDER_DESC}))[1] AS date, car, "
            f"string_agg(monitor_id, ',' ORDER BY {_ORDER}) AS car_track FROM {source} GROUP BY car")


def _state_ctes(day: str) -> str:
    return ("reg AS (SELECT DISTINCT monitor_id, camera_id FROM flow WHERE monitor_id IS NOT NULL AND camera_id IS NOT NULL),\n"
            f"seen AS (SELECT DISTINCT monitor_id, camera_id FROM flow WHERE date BETWEEN {_lit(day)} AND {_lit(day)}),\n"
            "st AS (SELECT r.monitor_id, r.camera_id, s.camera_id IS NOT NULL AS ok FROM reg r "
            "LEFT JOIN seen s ON r.monitor_id = s.monitor_id AND r.camera_id = s.camera_id),\n"
            "per AS (SELECT monitor_id, count(*) FILTER (WHERE ok) AS normal_camera_count, "
            "count(*) FILTER (WHERE NOT ok) AS abnormal_camera_count, "
            "string_agg(CASE WHEN NOT ok THEN camera_id END, ',' ORDER BY camera_id) AS abnormal_camera_ids "
            "FROM st GROUP BY monitor_id)")


def _top_monitors(n: int, source: str = "flow") -> str:
    return (f"SELECT monitor_id, count(*) AS car_count FROM {source} GROUP BY monitor_id "
            f"ORDER BY car_count DESC, monitor_id LIMIT {n}")


def _bands(source: str = "flow") -> str:
    s = "TRY_CAST(speed AS INTEGER)"
    return (f"SELECT monitor_id, count(*) FILTER (WHERE {s} >= 120) AS high_count, "
            f"count(*) FILTER (WHERE {s} >= 90 AND {s} < 120) AS medium_count, "
            f"count(*) FILTER (WHERE {s} >= 60 AND {s} < 90) AS normal_count, "
            f"count(*) FILTER (WHERE {s} < 60) AS low_count FROM {source} GROUP BY monitor_id")


def _speed_rank(n: int) -> str:
    return (f"SELECT * FROM ({_bands()}) ORDER BY high_count DESC, medium_count DESC, normal_count DESC, "
            f"low_count DESC, monitor_id LIMIT {n}")


ORACLE_SQL: dict[str, str] = {
    "flow_by_date": _with() + f"SELECT {_FLOW_COLS} FROM flow WHERE date BETWEEN {_lit(P.RANGE_START)} AND {_lit(P.RANGE_END)}",
    "load_tsv": _with() + f"SELECT {_FLOW_COLS} FROM passes",
    "camera_registry": _with() + "SELECT DISTINCT monitor_id, camera_id FROM flow "
                                 "WHERE monitor_id IS NOT NULL AND camera_id IS NOT NULL",
    "time_labels": _with() + (f"SELECT event_id, {_DATE_HOUR} AS date_hour, {_RANGE} AS range_time, "
                              "strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y%m%d%H%M') AS minute_key, "
                              "CAST(floor(epoch(ts)) AS BIGINT) AS pass_seconds "
                              "FROM flow JOIN events USING (event_id)"),
    "path_step_counts": _with(_path_counts_cte(P.PATH)) + "SELECT step, path, cnt, prev_cnt FROM steps",
    "path_conversion": _with(_path_counts_cte(P.PATH)) + (
        "SELECT step, path, cnt, prev_cnt, CAST((200 * cnt + prev_cnt) // (2 * prev_cnt) AS DOUBLE) / 100 AS rate "
        "FROM steps WHERE step >= 2 AND cnt > 0"),
    "car_track": _with() + _track_select("flow"),
    "car_track_blocks": _with(
        f"seq AS (SELECT car, date, monitor_id, row_number() OVER (PARTITION BY car ORDER BY {_ORDER}) AS seq FROM flow)",
    ) + (f"SELECT car, (seq - 1) // {P.TRACK_BLOCK} AS block, min(seq) AS first_seq, max(seq) AS last_seq, "
         "arg_max(date, seq) AS last_date, string_agg(monitor_id, ',' ORDER BY seq) AS track_part "
         f"FROM seq GROUP BY car, (seq - 1) // {P.TRACK_BLOCK}"),
    "hourly_car_count": _with(_hour_cars_cte()) + "SELECT date, date_hour, cars FROM counts",
    "hourly_quota": _with(_quota_cte(P.EXTRACT_NUM)) + "SELECT date, date_hour, cars, quota FROM quota",
    "sample_cars": _with(_sample_cte(P.EXTRACT_NUM, P.SEED)) + "SELECT date, date_hour, car FROM sampled",
    "sample_detail": _with(_sample_cte(P.EXTRACT_NUM, P.SEED)) + (
        f"SELECT {_DETAIL} FROM flow WHERE car IN (SELECT car FROM sampled)"),
    "sample_track": _with(_sample_cte(P.EXTRACT_NUM, P.SEED),
                          "picked AS (SELECT * FROM flow WHERE car IN (SELECT car FROM sampled))") + _track_select("picked"),
    "monitor_flow": _with() + "SELECT monitor_id, count(*) AS car_count FROM flow GROUP BY monitor_id",
    "topn_monitor": _with() + _top_monitors(P.TOP_N),
    "topn_monitor_area": _with(
        "areas AS (SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS area_id, r_name AS area_name FROM region)",
        f"in_area AS (SELECT * FROM flow WHERE area_id IN (SELECT area_id FROM areas WHERE area_name = {_lit(P.AREA_NAME)}))",
    ) + _top_monitors(P.TOP_N, "in_area"),
    "topn_monitor_detail": _with(f"top AS ({_top_monitors(P.TOP_N)})") + (
        f"SELECT {_DETAIL} FROM flow WHERE monitor_id IN (SELECT monitor_id FROM top)"),
    "speed_bands": _with() + _bands(),
    "speed_rank_monitor": _with() + _speed_rank(P.TOP_N),
    "speed_top10_detail": _with(f"top AS ({_speed_rank(P.TOP_N)})",
                                "ranked AS (SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY "
                                "TRY_CAST(speed AS INTEGER) DESC NULLS LAST, action_time, car, camera_id, road_id, date, event_id) AS rn "
                                "FROM flow WHERE monitor_id IN (SELECT monitor_id FROM top))") + (
        f"SELECT {_DETAIL} FROM ranked WHERE rn <= {P.TOP_DETAIL_PER_MONITOR}"),
    "area_road_topn": _with(
        "areas AS (SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS area_id, r_name AS area_name FROM region)",
        "counts AS (SELECT area_id, road_id, count(*) AS car_count FROM flow GROUP BY area_id, road_id)",
        "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY area_id ORDER BY car_count DESC, road_id) AS INTEGER) AS rank FROM counts)",
    ) + (f"SELECT r.area_id, a.area_name, r.road_id, r.car_count, r.rank FROM ranked r "
         f"LEFT JOIN areas a ON r.area_id = a.area_id WHERE r.rank <= {P.AREA_TOP_N}"),
    "monitor_state": _with(_state_ctes(P.STATE_DATE)) + (
        "SELECT count(*) FILTER (WHERE abnormal_camera_count = 0) AS normal_monitor_count, "
        "CAST(coalesce(sum(normal_camera_count), 0) AS BIGINT) AS normal_camera_count, "
        "count(*) FILTER (WHERE abnormal_camera_count > 0) AS abnormal_monitor_count, "
        "CAST(coalesce(sum(abnormal_camera_count), 0) AS BIGINT) AS abnormal_camera_count, "
        "coalesce(string_agg(CASE WHEN abnormal_camera_count > 0 THEN monitor_id || ':' || abnormal_camera_ids END, "
        "'~' ORDER BY monitor_id), '') AS abnormal_monitor_camera_infos FROM per"),
    "monitor_camera_state": _with(_state_ctes(P.STATE_DATE)) + (
        "SELECT monitor_id, normal_camera_count, abnormal_camera_count, abnormal_camera_ids FROM per"),
    "follow_car": _with(
        f"cells_in AS (SELECT monitor_id, {_RANGE} AS range_time, car FROM flow)",
        f"targets AS (SELECT DISTINCT monitor_id, range_time FROM cells_in WHERE car IN {_in(P.TARGET_CARS)})",
        "together AS (SELECT DISTINCT c.monitor_id, c.range_time, c.car FROM cells_in c "
        "WHERE EXISTS (SELECT 1 FROM targets t WHERE t.monitor_id = c.monitor_id AND t.range_time = c.range_time))",
    ) + ("SELECT monitor_id, range_time, string_agg(car, ',' ORDER BY car) AS cars, count(*) AS car_count "
         "FROM together GROUP BY monitor_id, range_time"),
    "stream_monitor_speed": _with(
        "parsed AS (SELECT strptime(action_time, '%Y-%m-%d %H:%M:%S') AS ts, monitor_id, speed FROM passes)",
        "timed AS (SELECT ts, monitor_id, TRY_CAST(speed AS INTEGER) AS s, "
        "date_trunc('hour', ts) + INTERVAL 5 MINUTE * (minute(ts) // 5) AS ws FROM parsed)",
        "closed AS (SELECT * FROM timed WHERE ws + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM timed) - INTERVAL 10 MINUTE)",
    ) + ("SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, "
         "strftime(ws + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, monitor_id, "
         "count(*) AS passes, CAST(sum(s) AS BIGINT) AS speed_sum, "
         "CAST(sum(s) AS DOUBLE) / CAST(count(s) AS DOUBLE) AS avg_speed FROM closed GROUP BY ws, monitor_id"),
    "dirty_sample_cars": _with_dirty(f"flow AS (SELECT * FROM legal WHERE {_GOOD_TIME})",
                                     _sample_cte(P.EXTRACT_NUM, P.SEED)) + "SELECT date, date_hour, car FROM sampled",
    "dirty_topn_detail": _with_dirty(
        "known AS (SELECT * FROM legal WHERE monitor_id IS NOT NULL)",
        f"top AS ({_top_monitors(P.TOP_N, 'known')})") + (
        f"SELECT {_DETAIL} FROM known WHERE monitor_id IN (SELECT monitor_id FROM top)"),
    "time_arithmetic": _with_dirty(
        f"shifted AS (SELECT event_id, CASE WHEN {_GOOD_TIME} THEN (CAST(camera_id AS INTEGER) - 50) * 60 ELSE 0 END AS s "
        "FROM legal)") + (
        "SELECT event_id, s < 0 AS is_after, s > 0 AS is_before, CAST(-s AS BIGINT) AS gap FROM shifted"),
    "text_functions": _with("ks AS (SELECT *, CAST(camera_id AS INTEGER) AS k FROM passes)") + (
        "SELECT event_id, road_id || ',' AS trimmed, (k % 3 = 0 OR k % 3 = 1) AS empty, "
        "lpad(CAST(k % 20 AS VARCHAR), 2, '0') AS padded, CAST(k AS VARCHAR) AS first_k, CAST(NULL AS VARCHAR) AS no_field, "
        "'type=' || road_id || '|bad|k=new|k=' || (k + 1) AS changed, CAST(k + 1 AS VARCHAR) AS last_k FROM ks"),
    "task_parameters": (
        "SELECT c_custkey AS task_id, '2024-01-05' AS start_date, CAST(NULL AS VARCHAR) AS end_date, "
        "CAST(c_custkey % 9 AS INTEGER) AS top_num, c_name AS area_name, CAST(NULL AS INTEGER) AS extract_num, "
        "'A+' || c_name AS cars, 2 AS n_cars FROM customer"),
    "many_path_counts": _with(_many_paths(P.MANY_PATHS)) + "SELECT path_id, step, path, cnt, prev_cnt FROM steps",
    "many_path_conversion": _with(_many_paths(P.MANY_PATHS)) + (
        "SELECT path_id, step, path, cnt, prev_cnt, CAST((200 * cnt + prev_cnt) // (2 * prev_cnt) AS DOUBLE) / 100 AS rate "
        "FROM steps WHERE step >= 2 AND cnt > 0"),
    "catalog_path_counts": _with(_path_counts_cte(P.PATH)) + "SELECT step, path, cnt, prev_cnt FROM steps",
    "catalog_car_track": _with() + _track_select("flow"),
    "live_topn_monitor": _with(
        "counts AS (SELECT date, monitor_id, count(*) AS car_count FROM passes GROUP BY date, monitor_id)",
        "ranked AS (SELECT date, CAST(row_number() OVER (PARTITION BY date ORDER BY car_count DESC, monitor_id) AS INTEGER) AS rank, "
        "monitor_id, car_count FROM counts)") + f"SELECT date, rank, monitor_id, car_count FROM ranked WHERE rank <= {P.TOP_N}",
    "live_path_counts": _with(
        "mark AS (SELECT strftime(max(strptime(action_time, '%Y-%m-%d %H:%M:%S')) - INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS t "
        "FROM passes)",
        _many_paths(P.MANY_PATHS).replace("FROM flow WINDOW", "FROM flow WHERE action_time < (SELECT t FROM mark) WINDOW")) + (
        "SELECT path_id, step, cnt FROM steps WHERE cnt > 0"),
    "companions": _with(
        "moments AS (SELECT DISTINCT car, monitor_id, epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS t FROM flow)",
        f"targets AS (SELECT * FROM moments WHERE car IN {_in(P.TARGET_CARS)})",
        "met AS (SELECT x.car AS target, y.car, x.monitor_id, x.t, min(abs(x.t - y.t)) AS gap FROM targets x JOIN moments y "
        "ON x.monitor_id = y.monitor_id AND x.car <> y.car "
        f"AND y.t BETWEEN x.t - {P.COMPANION_SECONDS} AND x.t + {P.COMPANION_SECONDS} GROUP BY x.car, y.car, x.monitor_id, x.t)",
    ) + ("SELECT target, car, count(*) AS meetings, CAST(min(gap) AS BIGINT) AS closest_seconds FROM met GROUP BY target, car"),
    "find_cars": _with() + (f"SELECT {_FLOW_COLS} FROM flow WHERE car IN {_in(P.LOOKUP_CARS)} "
                            f"AND date BETWEEN {_lit(P.RANGE_START)} AND {_lit(P.RANGE_END)}"),
    "sketch_cars": _with("ranges AS (SELECT unnest([" + ", ".join(_lit(a) for a, _ in P.SKETCH_RANGES) + "]) AS start_date, unnest(["
                         + ", ".join(_lit(b) for _, b in P.SKETCH_RANGES) + "]) AS end_date)") + (
        "SELECT start_date, end_date, count(DISTINCT car) AS cars, TRUE AS within_bound FROM ranges JOIN flow "
        "ON date BETWEEN start_date AND end_date GROUP BY start_date, end_date"),
    "flow_groupings": _with(f"hours AS (SELECT *, {_DATE_HOUR} AS date_hour, TRY_CAST(speed AS INTEGER) AS s FROM flow)") + (
        "SELECT area_id, road_id, monitor_id, date_hour, CAST(GROUPING(area_id, road_id, monitor_id, date_hour) AS INTEGER) AS grouping, "
        "count(*) AS passes, count(*) FILTER (WHERE s >= 120) AS high_count, count(*) FILTER (WHERE s >= 90 AND s < 120) AS medium_count, "
        "count(*) FILTER (WHERE s >= 60 AND s < 90) AS normal_count, count(*) FILTER (WHERE s < 60) AS low_count, max(s) AS max_speed "
        "FROM hours GROUP BY GROUPING SETS ((monitor_id), (area_id, road_id), (date_hour), (monitor_id, date_hour), (area_id), ())"),
    # the fraction in units of 2 ** -60 is a whole number
    "binary_rounding": (
        "WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sign, "
        "l_extendedprice / l_quantity AS price, l_tax FROM lineitem), "
        "v AS (SELECT *, sign * price * 1.0::DOUBLE AS a, sign * price * 0.5::DOUBLE AS b, sign * price * (1.0::DOUBLE + l_tax) AS c FROM x) "
        "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
            f"sign * CAST(CAST(floor(abs({v})) AS HUGEINT) * 100 + (CAST((abs({v}) - floor(abs({v}))) * 1152921504606846976::DOUBLE AS HUGEINT) "
            f"* 200 + 1152921504606846976) // 2305843009213693952 AS DOUBLE) / 100 AS {name}"
            for v, name in (("a", "unit"), ("b", "half_cents"), ("c", "tax"))) + " FROM v"),
    "task_monitor_state": _with_range(
        "reg AS (SELECT DISTINCT monitor_id, camera_id FROM passes WHERE monitor_id IS NOT NULL AND camera_id IS NOT NULL)",
        "seen AS (SELECT DISTINCT monitor_id, camera_id FROM flow)",
        "per AS (SELECT reg.monitor_id, count(*) FILTER (WHERE seen.camera_id IS NOT NULL) AS good, "
        "count(*) FILTER (WHERE seen.camera_id IS NULL) AS bad, "
        "string_agg(CASE WHEN seen.camera_id IS NULL THEN reg.camera_id END, ',' ORDER BY reg.camera_id) AS ids "
        "FROM reg LEFT JOIN seen ON reg.monitor_id = seen.monitor_id AND reg.camera_id = seen.camera_id "
        "GROUP BY reg.monitor_id)") + (
        "SELECT count(*) FILTER (WHERE bad = 0) AS noraml_monitor_count, CAST(coalesce(sum(good), 0) AS BIGINT) AS normal_camera_count, "
        "count(*) FILTER (WHERE bad > 0) AS abnormal_monitor_count, CAST(coalesce(sum(bad), 0) AS BIGINT) AS abnormal_camera_count, "
        "coalesce(string_agg(CASE WHEN bad > 0 THEN monitor_id || ':' || ids END, '~' ORDER BY monitor_id), '') "
        "AS abnormal_monitor_camera_infos, '1' AS \"taskId\" FROM per"),
    "task_topn_monitor_car_count": _with_range() + (
        "SELECT monitor_id, car_count AS \"carCount\", '1' AS task_id FROM (" + _top_monitors(P.TOP_N) + ")"),
    "task_topn_monitor_detail_info": _with_range(f"top AS ({_top_monitors(P.TOP_N)})") + (
        f"SELECT {_DETAIL}, '1' AS task_id FROM flow WHERE monitor_id IN (SELECT monitor_id FROM top)"),
    "task_top10_speed_detail": _with_range(
        f"top AS ({_speed_rank(P.TOP_N)})",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY TRY_CAST(speed AS INTEGER) DESC NULLS LAST, "
        "action_time, car, camera_id, road_id, date, event_id) AS rn FROM flow WHERE monitor_id IN (SELECT monitor_id FROM top))") + (
        f"SELECT {_DETAIL}, '1' AS task_id FROM ranked WHERE rn <= {P.TOP_DETAIL_PER_MONITOR}"),
    "task_random_extract_car": _with_range(_sample_cte(P.EXTRACT_NUM, P.SEED)) + (
        "SELECT car AS car_info, date AS date_d, date_hour, '2' AS task_id FROM sampled"),
    "task_random_extract_car_detail_info": _with_range(_sample_cte(P.EXTRACT_NUM, P.SEED)) + (
        f"SELECT {_DETAIL}, '2' AS task_id FROM flow WHERE car IN (SELECT car FROM sampled)"),
    "task_car_track": _with_range(
        _sample_cte(P.EXTRACT_NUM, P.SEED), "picked AS (SELECT * FROM flow WHERE car IN (SELECT car FROM sampled))",
        f"tracks AS ({_track_select('picked')})") + "SELECT date, car, car_track, '2' AS task_id FROM tracks",
    "task_monitor_range_time_car": _with_range(
        f"cells_in AS (SELECT monitor_id, {_RANGE} AS range_time, car FROM flow)",
        f"targets AS (SELECT DISTINCT monitor_id, range_time FROM cells_in WHERE car IN {_in(P.TARGET_CARS)})",
        "together AS (SELECT DISTINCT c.monitor_id, c.range_time, c.car FROM cells_in c "
        "WHERE EXISTS (SELECT 1 FROM targets t WHERE t.monitor_id = c.monitor_id AND t.range_time = c.range_time))",
    ) + ("SELECT monitor_id, range_time, string_agg(car, ',' ORDER BY car) AS cars, '3' AS task_id "
         "FROM together GROUP BY monitor_id, range_time"),
    "write_result": _with() + ("SELECT monitor_id, car_count, '1' AS task_id FROM ("
                               + _top_monitors(P.TOP_N) + ")"),
}
