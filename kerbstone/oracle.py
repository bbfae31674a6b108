"""The registered queries as plain SQL over the star-schema tables.

Each text stands alone: it starts from the tables and spells out every step,
so that it checks the DataFrame code rather than sharing it.
"""

from __future__ import annotations

from kerbstone import constants as C
from kerbstone.sources.tables import DISTRICT_CODES_SQL, RAW_COLLISIONS_SQL

RECORD = C.RECORD_COLUMNS


def _case(expr: str, values: dict, default: str) -> str:
    def lit(x):
        return f"'{x}'" if isinstance(x, str) else str(x)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in values.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _isin(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_RISK = _case("severity", C.RISK_WEIGHTS, "NULL")
_LABEL = _case("severity", C.SEVERITY_INDEX, "NULL")
_BUCKET = "CASE " + " ".join(
    f"WHEN hour > {first - 1} AND hour <= {last} THEN '{name}'"
    for name, first, last in C.HOUR_BUCKETS
) + " ELSE 'Unknown' END"

STEPS = {
    "raw_collisions": RAW_COLLISIONS_SQL,
    "district_rows": DISTRICT_CODES_SQL,
    "codes": f"""
SELECT trim(code) AS code, max(trim(label)) AS label FROM district_rows
WHERE field_name = '{C.DISTRICT_FIELD}' GROUP BY 1""",
    "decoded": f"""
SELECT collision_index AS accident_id,
       CAST(try_strptime(date, '%d/%m/%Y') AS DATE) AS date,
       CAST(hour(try_strptime(time, '%H:%M')) AS INTEGER) AS hour,
       trim(local_authority_ons_district) AS district_code,
       try_cast(latitude AS DOUBLE) AS latitude,
       try_cast(longitude AS DOUBLE) AS longitude,
       {_case("try_cast(road_type AS DOUBLE)", C.ROAD_TYPE_CODES, "'Unknown'")} AS road_type,
       {_case("try_cast(junction_detail AS DOUBLE)", C.JUNCTION_CODES, "'Unknown'")} AS junction_type,
       {_case("try_cast(weather_conditions AS DOUBLE)", C.WEATHER_CODES, "'Unknown'")} AS weather,
       {_case("try_cast(light_conditions AS DOUBLE)", C.LIGHT_CODES, "'Unknown'")} AS light_condition,
       {_case("try_cast(road_surface_conditions AS DOUBLE)", C.SURFACE_CODES, "'Unknown'")} AS road_surface,
       CASE WHEN try_cast(speed_limit AS DOUBLE) IN (-1, 99) THEN NULL
            ELSE try_cast(speed_limit AS DOUBLE) END AS speed_limit,
       try_cast(number_of_vehicles AS DOUBLE) AS num_vehicles_involved,
       {_case("try_cast(collision_severity AS DOUBLE)", C.SEVERITY_CODES, "NULL")} AS severity
FROM raw_collisions""",
    "prepared": """
SELECT accident_id, date, hour, coalesce(c.label, 'Unknown') AS city, latitude, longitude,
       road_type, junction_type, weather, light_condition, road_surface, speed_limit,
       num_vehicles_involved, severity
FROM decoded d LEFT JOIN codes c ON d.district_code = c.code
WHERE severity IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
    "deduped": f"""
SELECT {", ".join(RECORD)} FROM (
  SELECT *, row_number() OVER (PARTITION BY accident_id ORDER BY
    {", ".join(f"{c} ASC NULLS LAST" for c in RECORD[1:])}) AS rn
  FROM prepared) WHERE rn = 1""",
    "middle": """
SELECT median(hour) AS m_hour, median(speed_limit) AS m_speed,
       median(num_vehicles_involved) AS m_vehicles FROM deduped""",
    "cleaned": """
SELECT accident_id, date, CAST(trunc(coalesce(hour, m_hour)) AS INTEGER) AS hour,
       coalesce(city, 'Unknown') AS city, latitude, longitude,
       coalesce(road_type, 'Unknown') AS road_type,
       coalesce(junction_type, 'Unknown') AS junction_type,
       coalesce(weather, 'Unknown') AS weather,
       coalesce(light_condition, 'Unknown') AS light_condition,
       coalesce(road_surface, 'Unknown') AS road_surface,
       CAST(round_even(coalesce(speed_limit, m_speed), 0) AS INTEGER) AS speed_limit,
       CAST(trunc(coalesce(num_vehicles_involved, m_vehicles)) AS INTEGER) AS num_vehicles_involved,
       severity
FROM deduped, middle""",
    "featured": f"""
SELECT *, dayname(date) AS day_of_week,
       CAST(isodow(date) IN (6, 7) AS INTEGER) AS is_weekend,
       CAST(hour IN ({_isin(C.RUSH_HOURS)}) AS INTEGER) AS is_rush_hour,
       CAST(light_condition LIKE 'Darkness%' AS INTEGER) AS is_night,
       {_BUCKET} AS hour_bucket,
       CAST({_case("weather", C.WEATHER_WEIGHTS, "0")} + {_case("light_condition", C.LIGHT_WEIGHTS, "0")}
            + {_case("road_surface", C.SURFACE_WEIGHTS, "0")} AS INTEGER) AS weather_severity_index
FROM cleaned""",
    "risk": f"""
SELECT *, CASE WHEN risk_score >= 0 AND risk_score < 25 THEN 'Low'
               WHEN risk_score >= 25 AND risk_score < 50 THEN 'Medium'
               WHEN risk_score >= 50 AND risk_score < 75 THEN 'High'
               ELSE 'Critical' END AS risk_level
FROM (
  SELECT *, round_even(greatest(0.0, least(100.0, smoothed_avg_weight / 6 * 100)) * 100, 0) / 100 AS risk_score
  FROM (
    SELECT {", ".join(C.SEGMENT_KEYS)}, count(*) AS n_accidents,
           CAST(sum({_RISK}) AS BIGINT) AS weighted_sum,
           count(*) FILTER (WHERE severity = 'Fatal') AS fatal_count,
           count(*) FILTER (WHERE severity = 'Serious') AS serious_count,
           (CAST(sum({_RISK}) AS DOUBLE) + 8 * (SELECT avg({_RISK}) FROM featured)) / (count(*) + 8)
             AS smoothed_avg_weight
    FROM featured GROUP BY {", ".join(C.SEGMENT_KEYS)}))""",
    "standin": f"""
SELECT accident_id, label, a / t AS p0, b / t AS p1, c / t AS p2,
       CASE WHEN c / t >= 0.15 THEN 2 WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS prediction,
       CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS argmax
FROM (SELECT *, a + b + c AS t FROM (
  SELECT accident_id, {_LABEL} AS label,
    CAST(1 + (speed_limit * 3 + hour * 5 + weather_severity_index * 7) % 50 AS DOUBLE) AS a,
    CAST(1 + (num_vehicles_involved * 11 + hour * 3 + is_rush_hour * 17) % 30 AS DOUBLE) AS b,
    CAST(1 + (is_night * 9 + speed_limit + weather_severity_index * 5 + is_weekend * 4) % 20 AS DOUBLE) AS c
  FROM featured))""",
    "matrix": """
SELECT actual, predicted, count(s.label) AS n
FROM (SELECT CAST(i AS INTEGER) AS actual FROM range(3) r(i)) x
CROSS JOIN (SELECT CAST(i AS INTEGER) AS predicted FROM range(3) r(i)) y
LEFT JOIN standin s ON s.label = actual AND s.prediction = predicted GROUP BY 1, 2""",
    "report": """
SELECT class, ['Minor', 'Serious', 'Fatal'][class + 1] AS severity,
       CASE WHEN called = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / called END AS "precision",
       CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS recall,
       CASE WHEN called + support = 0 THEN 0.0 ELSE CAST(2 * hits AS DOUBLE) / (called + support) END AS f1,
       support, hits
FROM (
  SELECT k.class, CAST(sum(n) FILTER (WHERE actual = k.class) AS BIGINT) AS support,
         CAST(sum(n) FILTER (WHERE predicted = k.class) AS BIGINT) AS called,
         CAST(sum(n) FILTER (WHERE actual = k.class AND predicted = k.class) AS BIGINT) AS hits
  FROM matrix, (SELECT CAST(i AS INTEGER) AS class FROM range(3) r(i)) k GROUP BY 1)""",
    "ranked": """
SELECT f.*, row_number() OVER (PARTITION BY severity
         ORDER BY md5(coalesce(accident_id, '') || ':42'), accident_id) AS class_rank,
       count(*) OVER (PARTITION BY severity) AS class_size
FROM featured f""",
    "scale": "SELECT " + ", ".join(
        f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}"
        for c in C.NUMERIC_FEATURES
    ) + " FROM featured",
}

# Neighbour pairs by brute force inside blocks of 0.014 by 0.03 degrees, each
# with the eight blocks around it: both sides exceed 1.5 km south of 63 degrees.
# Components are taken over blocks of 1 km, within which all points are near.
_NEAR = """2 * 6371.0088 * asin(least(1.0, sqrt(sin((q.phi - p.phi) / 2) ** 2
    + cos(p.phi) * cos(q.phi) * sin((q.lam - p.lam) / 2) ** 2))) <= 1.5"""
STEPS |= {
    "points": """
SELECT CAST(row_number() OVER (ORDER BY accident_id) AS INTEGER) AS rid, accident_id, severity, city,
       latitude, longitude, radians(latitude) AS phi, radians(longitude) AS lam,
       CAST(floor(latitude / 0.014) AS INTEGER) AS gy, CAST(floor(longitude / 0.03) AS INTEGER) AS gx,
       CAST(floor(latitude / 0.0089) AS BIGINT) * 1000000 + CAST(floor(longitude / 0.0139) AS BIGINT) AS block
FROM cleaned""",
    "around": """
SELECT p.*, p.gy + dy.d AS ny, p.gx + dx.d AS nx FROM points p
CROSS JOIN (VALUES (-1), (0), (1)) dy(d) CROSS JOIN (VALUES (-1), (0), (1)) dx(d)""",
    "cores": f"""
SELECT p.rid FROM around p JOIN points q ON p.ny = q.gy AND p.nx = q.gx AND {_NEAR}
GROUP BY p.rid HAVING count(*) >= 8""",
    "core_points": "SELECT * FROM points WHERE rid IN (SELECT rid FROM cores)",
    "core_around": "SELECT * FROM around WHERE rid IN (SELECT rid FROM cores)",
    "links": f"""
SELECT DISTINCT p.block AS a, q.block AS b FROM core_around p
JOIN core_points q ON p.ny = q.gy AND p.nx = q.gx AND {_NEAR}""",
    "reach": """
SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a""",
    "numbered": """
SELECT r.a AS block, CAST(dense_rank() OVER (ORDER BY min(f.first)) - 1 AS INTEGER) AS cluster
FROM reach r JOIN (SELECT block, min(rid) AS first FROM core_points GROUP BY 1) f ON r.b = f.block
GROUP BY r.a""",
    "border": f"""
SELECT p.rid, min(n.cluster) AS cluster
FROM (SELECT * FROM around WHERE rid NOT IN (SELECT rid FROM cores)) p
JOIN core_points q ON p.ny = q.gy AND p.nx = q.gx AND {_NEAR}
JOIN numbered n ON n.block = q.block GROUP BY 1""",
    "clustered": """
SELECT p.*, coalesce(n.cluster, b.cluster, -1) AS cluster FROM points p
LEFT JOIN core_points c ON c.rid = p.rid LEFT JOIN numbered n ON n.block = c.block
LEFT JOIN border b ON b.rid = p.rid""",
    "zones": """
SELECT accident_id, latitude, longitude, first(cluster ORDER BY d, cluster) AS cluster FROM (
  SELECT c.accident_id, c.latitude, c.longitude, k.cluster,
         (latitude - centre_lat) * (latitude - centre_lat) + (longitude - centre_lon) * (longitude - centre_lon) AS d
  FROM cleaned c CROSS JOIN (
    SELECT city AS cluster, round(avg(latitude), 6) AS centre_lat, round(avg(longitude), 6) AS centre_lon
    FROM cleaned GROUP BY 1) k)
GROUP BY 1, 2, 3""",
    "hotspots": f"""
SELECT *, CAST(row_number() OVER (ORDER BY severity_weighted_score DESC, cluster) AS INTEGER) AS rank FROM (
  SELECT cluster, CAST(sum(n) AS BIGINT) AS n_accidents, CAST(sum(fatal) AS BIGINT) AS fatal_count,
         CAST(sum(serious) AS BIGINT) AS serious_count, sum(lat) / sum(n) AS centroid_lat,
         sum(lon) / sum(n) AS centroid_lon, first(city ORDER BY n DESC, city) AS dominant_district,
         CAST(sum(weight) AS BIGINT) AS severity_weighted_score
  FROM (SELECT cluster, city, count(*) AS n, count(*) FILTER (WHERE severity = 'Fatal') AS fatal,
               count(*) FILTER (WHERE severity = 'Serious') AS serious, sum(latitude) AS lat,
               sum(longitude) AS lon, sum({_RISK}) AS weight
        FROM clustered WHERE cluster >= 0 GROUP BY 1, 2)
  GROUP BY cluster ORDER BY severity_weighted_score DESC, cluster LIMIT 25)""",
}

# what each step reads
_NEEDS = {
    "points": ["cleaned"],
    "around": ["points"],
    "cores": ["around"],
    "core_points": ["cores"],
    "core_around": ["cores"],
    "links": ["core_around", "core_points"],
    "reach": ["links"],
    "numbered": ["reach"],
    "border": ["numbered"],
    "clustered": ["border"],
    "hotspots": ["clustered"],
    "zones": ["cleaned"],
    "codes": ["district_rows"],
    "decoded": ["raw_collisions"],
    "prepared": ["decoded", "codes"],
    "deduped": ["prepared"],
    "middle": ["deduped"],
    "cleaned": ["deduped", "middle"],
    "featured": ["cleaned"],
    "risk": ["featured"],
    "standin": ["featured"],
    "matrix": ["standin"],
    "report": ["matrix"],
    "ranked": ["featured"],
    "scale": ["featured"],
}


def _steps_for(names: list[str]) -> list[str]:
    found: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in found:
            found.append(name)

    for name in names:
        visit(name)
    return found


def _sql(needs: str, select: str, more: dict[str, str] | None = None, recursive: bool = False) -> str:
    steps = [(n, STEPS[n]) for n in _steps_for(needs.split())] + list((more or {}).items())
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in steps)
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"


def _dated(columns: list[str]) -> str:
    return ", ".join("CAST(date AS VARCHAR) AS date" if c == "date" else c for c in columns)


FEATURED = RECORD + [
    "day_of_week", "is_weekend", "is_rush_hour", "is_night", "hour_bucket",
    "weather_severity_index",
]


def oracle_sql() -> dict[str, str]:
    sql = {}

    # --- decode and checks ---
    sql["q_decode"] = _sql(
        "decoded",
        "SELECT accident_id, severity, road_type, junction_type, weather, light_condition, road_surface FROM decoded",
    )
    sql["q_district_codes"] = _sql("codes", "SELECT code, label FROM codes")
    sql["q_prepare"] = _sql("prepared", f"SELECT {_dated(RECORD)} FROM prepared")
    sql["q_check_labels"] = _sql(
        "raw_collisions",
        """SELECT collision_severity AS severity, count(*) AS n FROM raw_collisions
WHERE collision_severity IS NOT NULL AND collision_severity NOT IN ('Minor', 'Serious', 'Fatal') GROUP BY 1""",
    )
    sql["q_check_coords"] = _sql(
        "decoded",
        """SELECT count(*) FILTER (WHERE NOT coalesce(latitude BETWEEN -90 AND 90
 AND longitude BETWEEN -180 AND 180, false)) AS n_bad, count(*) AS n_rows FROM decoded""",
    )
    sql["q_missing_classes"] = _sql(
        "featured",
        """SELECT city, s.severity FROM (SELECT DISTINCT city FROM featured WHERE weather_severity_index >= 6) c
CROSS JOIN (VALUES ('Minor'), ('Serious'), ('Fatal')) s(severity)
WHERE NOT EXISTS (SELECT 1 FROM featured f WHERE f.city = c.city AND f.severity = s.severity
                  AND f.weather_severity_index >= 6)""",
    )
    sql["q_missing_by_date"] = _sql(
        "featured",
        """SELECT date, s.severity
FROM (SELECT date, list(DISTINCT severity) AS have FROM featured
      WHERE weather_severity_index >= 6 AND date IS NOT NULL GROUP BY date) d,
     (VALUES ('Minor'), ('Serious'), ('Fatal')) s(severity)
WHERE NOT list_contains(d.have, s.severity)""",
    )
    sql["q_missing_overall"] = _sql(
        "featured",
        """SELECT s.severity FROM (VALUES ('Minor'), ('Serious'), ('Fatal')) s(severity)
WHERE s.severity NOT IN (SELECT severity FROM featured WHERE severity <> 'Fatal')""",
    )
    sql["q_districts"] = _sql(
        "cleaned",
        """SELECT DISTINCT trim(city) AS district FROM cleaned
WHERE trim(city) <> '' AND lower(trim(city)) NOT IN ('unknown', 'nan', 'none')""",
    )

    # --- clean and features ---
    sql["q_dedup"] = _sql("deduped", f"SELECT {_dated(RECORD)} FROM deduped")
    sql["q_clean"] = _sql("cleaned", f"SELECT {_dated(RECORD)} FROM cleaned")
    sql["q_features"] = _sql("featured", f"SELECT {_dated(FEATURED)} FROM featured")
    sql["q_model_table"] = _sql(
        "featured",
        f"SELECT accident_id, {', '.join(C.FEATURES)}, severity, {_LABEL} AS label FROM featured",
    )
    sql["q_stage_counts"] = _sql(
        "decoded",
        """SELECT 'raw' AS stage, count(*) AS n FROM decoded
UNION ALL SELECT 'present', count(*) FROM decoded
  WHERE severity IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
UNION ALL SELECT 'usable', count(*) FROM decoded
  WHERE severity IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
UNION ALL SELECT 'deduplicated', count(DISTINCT accident_id) FROM decoded
  WHERE severity IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
    )

    # --- profiles ---
    missing = "\n".join(
        f"UNION ALL SELECT 'missing_pct', '{c}', round_even((count(*) FILTER (WHERE {c} IS NULL)) / CAST(count(*) AS DOUBLE) * 100 * 100, 0) / 100, NULL FROM prepared"
        for c in RECORD
    )
    sql["q_profile"] = _sql(
        "prepared",
        f"""SELECT 'table' AS section, 'n_rows' AS name, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM prepared
UNION ALL SELECT 'table', 'n_duplicate_rows', (SELECT count(*) FROM prepared) - count(*), NULL FROM (SELECT DISTINCT * FROM prepared)
{missing}
UNION ALL SELECT 'severity_share', severity, round_even(count(*) / CAST((SELECT count(severity) FROM prepared) AS DOUBLE) * 10000, 0) / 10000, NULL
  FROM prepared WHERE severity IS NOT NULL GROUP BY severity
UNION ALL SELECT 'date_range', 'first', NULL, CAST(min(date) AS VARCHAR) FROM prepared
UNION ALL SELECT 'date_range', 'last', NULL, CAST(max(date) AS VARCHAR) FROM prepared""",
    )
    sql["q_severity_share"] = _sql(
        "decoded",
        """SELECT severity, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM decoded) AS DOUBLE), 6) AS share
FROM decoded GROUP BY severity""",
    )
    sql["q_null_counts"] = _sql(
        "decoded",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM decoded"
            for c in ["district_code" if c == "city" else c for c in RECORD]
        ),
    )
    sql["q_unknown_counts"] = _sql(
        "prepared",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} = 'Unknown') AS n_unknown FROM prepared"
            for c in ["city", "road_type", "junction_type", "weather", "light_condition", "road_surface"]
        ),
    )
    sql["q_extent"] = _sql(
        "prepared",
        """SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon,
 max(longitude) AS max_lon, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date FROM prepared""",
    )
    sql["q_hourly"] = _sql("featured", "SELECT hour, count(*) AS n FROM featured GROUP BY hour")
    light = ", ".join(
        f"""round(avg(CASE WHEN severity = 'Fatal' THEN 1 ELSE 0 END) FILTER (WHERE light_condition = '{v}'), 6) AS "{v}\""""
        for v in C.LIGHT_CONDITIONS
    )
    sql["q_fatal_rate_pivot"] = _sql("featured", f"SELECT weather, {light} FROM featured GROUP BY weather")
    speed = ", ".join(
        f"""round(count(*) FILTER (WHERE severity = '{s}') / CAST(count(severity) AS DOUBLE), 6) AS "{s}\""""
        for s in C.SEVERITIES
    )
    sql["q_speed_crosstab"] = _sql("featured", f"SELECT speed_limit, {speed} FROM featured GROUP BY speed_limit")

    # --- risk ---
    risk_columns = """road_type, junction_type, weather, hour_bucket, is_weekend, n_accidents, weighted_sum,
 fatal_count, serious_count, round(smoothed_avg_weight, 6) AS smoothed_avg_weight, risk_score, risk_level"""
    sql["q_risk_lookup"] = _sql("risk", f"SELECT {risk_columns} FROM risk")
    sql["q_risk_top"] = _sql(
        "risk",
        f"""SELECT {risk_columns} FROM risk
ORDER BY risk_score DESC, road_type, junction_type, weather, hour_bucket, is_weekend LIMIT 15""",
    )

    sql["q_risk_rule"] = _sql(
        "risk",
        f"""SELECT {", ".join(C.SEGMENT_KEYS)}, round_even(score * 100, 0) / 100 AS risk_score,
 CASE WHEN score < 25 THEN 'Low' WHEN score < 50 THEN 'Medium' WHEN score < 75 THEN 'High' ELSE 'Critical' END AS risk_level
FROM (SELECT *, greatest(0.0, least(100.0,
  CAST((length(road_type) * 37 + length(junction_type) * 23 + length(weather) * 11
    + length(hour_bucket) * 5 + is_weekend * 70) % 500 - 60 AS DOUBLE) / 3)) AS score FROM risk)""",
    )

    # --- sampling ---
    sql["q_sample"] = _sql(
        "featured",
        """SELECT accident_id, latitude, longitude, city FROM featured
ORDER BY md5(coalesce(accident_id, '') || ':42'), accident_id NULLS LAST LIMIT 4000""",
    )
    sql["q_split"] = _sql(
        "ranked",
        """SELECT accident_id, severity, class_rank, class_size,
 CAST(class_rank <= floor(class_size * CAST(0.2 AS DOUBLE) + 0.5) AS INTEGER) AS is_test FROM ranked""",
    )
    sql["q_folds"] = _sql(
        "ranked", "SELECT accident_id, severity, CAST((class_rank - 1) % 5 AS INTEGER) AS fold FROM ranked"
    )

    # --- metrics ---
    sql["q_threshold"] = _sql(
        "standin",
        """SELECT accident_id, round(p0, 6) AS p_minor, round(p1, 6) AS p_serious, round(p2, 6) AS p_fatal,
 ['Minor', 'Serious', 'Fatal'][argmax + 1] AS argmax_prediction,
 ['Minor', 'Serious', 'Fatal'][prediction + 1] AS recall_oriented_prediction FROM standin""",
    )
    sql["q_severity_rule"] = sql["q_threshold"]
    sql["q_rank_rules"] = _sql(
        "standin",
        """SELECT model, round(fatal_recall, 6) AS fatal_recall, round(macro_f1, 6) AS macro_f1,
 row_number() OVER (ORDER BY fatal_recall DESC, macro_f1 DESC, model) AS place
FROM (
  SELECT model, max(CASE WHEN class = 2 THEN coalesce(hits / nullif(support, 0), 0) END) AS fatal_recall,
         avg(coalesce(2 * hits / nullif(called + support, 0), 0)) AS macro_f1
  FROM (
    SELECT model, class, CAST(count(*) FILTER (WHERE label = class AND p = class) AS DOUBLE) AS hits,
           count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE p = class) AS called
    FROM (SELECT 'always_minor' AS model, label, 0 AS p FROM standin
          UNION ALL SELECT 'always_fatal', label, 2 FROM standin
          UNION ALL SELECT 'most_likely', label, argmax FROM standin
          UNION ALL SELECT 'recall_oriented', label, prediction FROM standin), (VALUES (0), (1), (2)) k(class)
    GROUP BY model, class)
  GROUP BY model)""",
    )
    sql["q_confusion"] = _sql("matrix", "SELECT actual, predicted, n FROM matrix")
    sql["q_class_report"] = _sql(
        "report",
        """SELECT class, severity, round("precision", 6) AS "precision", round(recall, 6) AS recall,
 round(f1, 6) AS f1, support FROM report""",
    )
    sql["q_macro_metrics"] = _sql(
        "report",
        """SELECT round(CAST(sum(hits) AS DOUBLE) / sum(support), 6) AS accuracy,
 round(avg("precision"), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
 round(max(recall) FILTER (WHERE class = 2), 6) AS fatal_recall,
 round(max("precision") FILTER (WHERE class = 2), 6) AS fatal_precision,
 round(max(f1) FILTER (WHERE class = 2), 6) AS fatal_f1 FROM report""",
    )
    sql["q_auc_ovr"] = _sql(
        "standin",
        """SELECT round(avg(area), 6) AS roc_auc_ovr FROM (
  SELECT class, (sum(r) FILTER (WHERE pos) - count(*) FILTER (WHERE pos) * (count(*) FILTER (WHERE pos) + 1) / 2.0)
    / (CAST(count(*) FILTER (WHERE pos) AS DOUBLE) * count(*) FILTER (WHERE NOT pos)) AS area
  FROM (SELECT class, pos, rank() OVER (PARTITION BY class ORDER BY p)
          + (count(*) OVER (PARTITION BY class, p) - 1) / 2.0 AS r
        FROM (SELECT 0 AS class, label = 0 AS pos, p0 AS p FROM standin
              UNION ALL SELECT 1, label = 1, p1 FROM standin
              UNION ALL SELECT 2, label = 2, p2 FROM standin))
  GROUP BY class)""",
    )

    # --- places ---
    sql["q_core_points"] = _sql(
        "cores",
        "SELECT accident_id, CAST(rid IN (SELECT rid FROM cores) AS INTEGER) AS is_core FROM points",
    )
    sql["q_dbscan"] = _sql("clustered", "SELECT accident_id, cluster FROM clustered", recursive=True)
    sql["q_cluster_counts"] = _sql(
        "clustered",
        """SELECT count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS n_clusters,
 count(*) FILTER (WHERE cluster = -1) AS n_noise, count(*) FILTER (WHERE cluster >= 0) AS n_members,
 count(*) FILTER (WHERE cluster = -2) AS n_not_clustered FROM clustered""",
        recursive=True,
    )
    sql["q_hotspots"] = _sql(
        "hotspots",
        """SELECT cluster, n_accidents, fatal_count, serious_count, round(centroid_lat, 6) AS centroid_lat,
 round(centroid_lon, 6) AS centroid_lon, dominant_district, severity_weighted_score, rank FROM hotspots""",
        recursive=True,
    )
    sql["q_hotspot_layer"] = _sql(
        "hotspots",
        """SELECT rank, round(centroid_lat, 6) AS centroid_lat, round(centroid_lon, 6) AS centroid_lon,
 round(6 + least(severity_weighted_score / 200.0, 14.0), 6) AS radius,
 CASE WHEN rank <= 5 THEN 'darkred' ELSE 'orange' END AS color,
 'Rank #' || rank || '<br>District: ' || dominant_district || '<br>Accidents: ' || n_accidents
   || '<br>Fatal: ' || fatal_count || '<br>Serious: ' || serious_count
   || '<br>Weighted score: ' || severity_weighted_score AS popup,
 round((SELECT avg(centroid_lat) FROM hotspots WHERE rank <= 15), 6) AS map_lat,
 round((SELECT avg(centroid_lon) FROM hotspots WHERE rank <= 15), 6) AS map_lon
FROM hotspots WHERE rank <= 15""",
        recursive=True,
    )
    sql["q_nearest_centroid"] = _sql("zones", "SELECT accident_id, cluster FROM zones")
    sql["q_silhouette"] = _sql(
        "zones",
        """SELECT round(avg(CASE WHEN n_own = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM (
  SELECT id, max(n) FILTER (WHERE same) AS n_own,
         max(CASE WHEN n > 1 THEN total / (n - 1) ELSE 0.0 END) FILTER (WHERE same) AS a,
         min(total / n) FILTER (WHERE NOT same) AS b
  FROM (
    SELECT p.accident_id AS id, p.cluster = q.cluster AS same, q.cluster, count(*) AS n,
           sum(sqrt((p.latitude - q.latitude) ** 2 + (p.longitude - q.longitude) ** 2)) AS total
    FROM picked p CROSS JOIN picked q GROUP BY 1, 2, 3)
  GROUP BY id)""",
        more={
            "picked": """SELECT * FROM zones
ORDER BY md5(coalesce(accident_id, '') || ':42'), accident_id NULLS LAST LIMIT 5000"""
        },
    )
    sql["q_silhouette_all"] = _sql(
        "zones",
        """SELECT round(avg(CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM (
  SELECT max(t.n) FILTER (WHERE t.cluster = p.cluster) AS own_n,
         max(far * t.n / nullif(t.n - 1, 0)) FILTER (WHERE t.cluster = p.cluster) AS a,
         min(far) FILTER (WHERE t.cluster <> p.cluster) AS b
  FROM (
    SELECT z.row, z.cluster, u.cluster AS other,
           u.spread + (z.latitude - u.lat) ** 2 + (z.longitude - u.lon) ** 2 AS far
    FROM (SELECT *, row_number() OVER () AS row FROM zones) z CROSS JOIN totals u) p
  JOIN totals t ON t.cluster = p.other
  GROUP BY p.row)""",
        more={
            "totals": """SELECT cluster, count(*) AS n, avg(latitude) AS lat, avg(longitude) AS lon,
 var_pop(latitude) + var_pop(longitude) AS spread FROM zones GROUP BY cluster"""
        },
    )
    sql["q_kde_grid"] = _sql(
        "cleaned",
        """SELECT gi, gj, round(lat0 + gi * (lat1 - lat0) / 59, 6) AS lat, round(lon0 + gj * (lon1 - lon0) / 59, 6) AS lon,
 round(sum(exp(-(((latitude - (lat0 + gi * (lat1 - lat0) / 59)) * 110.574) ** 2
   + ((longitude - (lon0 + gj * (lon1 - lon0) / 59)) * cos(radians(mean)) * 111.320) ** 2) / 8.0)) / (n * 8 * pi()), 10) AS density
FROM cleaned CROSS JOIN e
CROSS JOIN (SELECT CAST(i AS INTEGER) AS gi FROM range(60) r(i)) x
CROSS JOIN (SELECT CAST(i AS INTEGER) AS gj FROM range(60) r(i)) y
GROUP BY gi, gj, lat0, lat1, lon0, lon1, n""",
        more={
            "e": """SELECT count(*) AS n, avg(latitude) AS mean, min(latitude) AS lat0, max(latitude) AS lat1,
 min(longitude) AS lon0, max(longitude) AS lon1 FROM cleaned"""
        },
    )

    # --- encoding and balancing ---
    z = {c: f"round(({c} - mu_{c}) / sd_{c}, 6)" for c in C.NUMERIC_FEATURES}
    sql["q_scaled"] = _sql(
        "featured scale",
        "SELECT accident_id, " + ", ".join(f"{e} AS num__{c}" for c, e in z.items())
        + " FROM featured, scale",
    )
    sql["q_encode"] = _sql(
        "featured scale",
        "\nUNION ALL ".join(
            [
                f"SELECT accident_id, 'cat__{c}_' || {c} AS feature, CAST(1 AS DOUBLE) AS value FROM featured"
                for c in C.CATEGORICAL_FEATURES
            ]
            + [
                f"SELECT accident_id, 'num__{c}', {e} FROM featured, scale"
                for c, e in z.items()
            ]
        ),
    )
    sql["q_knn_class"] = """
SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbour, round(d, 6) AS distance FROM (
  SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.e, b.e) AS d,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS rank
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) a
  JOIN (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) b
    ON a.label = b.label AND a.vec_id <> b.vec_id)
WHERE rank <= 5"""
    sql["q_smote_counts"] = _sql(
        "ranked",
        f"""SELECT label, n_real, (SELECT max(n_real) FROM sizes) - n_real AS n_synthetic,
 (SELECT max(n_real) FROM sizes) AS n_total FROM sizes""",
        more={
            "sizes": f"""SELECT {_LABEL} AS label, count(*) AS n_real FROM ranked
WHERE class_rank > floor(class_size * CAST(0.2 AS DOUBLE) + 0.5) GROUP BY 1"""
        },
    )

    # --- explanations ---
    terms = {
        "weather": _case("weather", C.WEATHER_WEIGHTS, "0"),
        "light_condition": _case("light_condition", C.LIGHT_WEIGHTS, "0"),
        "road_surface": _case("road_surface", C.SURFACE_WEIGHTS, "0"),
    } | {c: f"{c} * CAST(0.1 AS DOUBLE)" for c in C.NUMERIC_FEATURES}
    sql["q_linear_attrib"] = _sql(
        "featured",
        "\nUNION ALL ".join(
            f"SELECT accident_id, '{c}' AS feature, round({t} - (SELECT avg({t}) FROM featured), 6) AS phi FROM featured"
            for c, t in terms.items()
        ),
    )
    # the tree of q_tree_rule on every mix of a record's and a background row's four numbers
    four = ["speed_limit", "hour", "num_vehicles_involved", "is_night"]
    mixed = ", ".join(f"CASE WHEN s & {1 << i} > 0 THEN p.{c} ELSE b.{c} END AS {c}" for i, c in enumerate(four))
    same = " AND ".join(f"x.{c} = y.{c}" for c in four)
    sql["q_tree_rule"] = _sql(
        "featured",
        f"""SELECT f.accident_id, feature, round(phi, 6) AS phi
FROM featured f JOIN phis x ON {same.replace('y.', 'f.')}""",
        {
            "profiles": f"SELECT DISTINCT {', '.join(four)} FROM featured",
            "held": f"""SELECT {', '.join(four)} FROM featured
ORDER BY md5(coalesce(accident_id, '') || ':42'), accident_id NULLS LAST LIMIT 200""",
            "others": f"SELECT {', '.join(four)}, count(*) AS n FROM held GROUP BY ALL",
            "mixes": f"""SELECT {', '.join(f'p.{c} AS p_{c}' for c in four)}, s, n, {mixed}
FROM profiles p, others b, range(16) r(s)""",
            "means": f"""SELECT {', '.join(f'p_{c} AS {c}' for c in four)}, s, sum(n * CASE
    WHEN speed_limit <= 40 THEN CASE WHEN hour <= 12 THEN CAST(0.1 AS DOUBLE) ELSE 0.35 END
    WHEN num_vehicles_involved > 1 THEN 0.9 WHEN is_night <= 0 THEN 0.45
    WHEN hour <= 5 THEN 0.8 ELSE 0.6 END) / sum(n) AS f
FROM mixes GROUP BY ALL""",
            "phis": "\nUNION ALL ".join(f"""SELECT {', '.join(f'x.{c}' for c in four)}, '{four[i]}' AS feature,
  sum((y.f - x.f) / CASE WHEN bit_count(x.s) IN (0, 3) THEN 4 ELSE 12 END) AS phi
FROM means x JOIN means y ON {same} AND y.s = x.s + {1 << i} AND x.s & {1 << i} = 0
GROUP BY {', '.join(f'x.{c}' for c in four)}""" for i in range(4)),
        },
    )
    # gradients and curvatures of the first round, as the multiples of 2^-24 they are rounded to
    numbers = {
        "speed_limit": [20, 30, 40, 50, 60], "num_vehicles_involved": [1, 2, 3], "hour": list(range(23)),
        "is_weekend": [0], "is_rush_hour": [0], "is_night": [0], "weather_severity_index": list(range(6)),
    }
    unit = "CAST(16777216 AS DOUBLE)"
    sql["q_boost_split"] = _sql(
        "featured",
        f"""SELECT severity, feature, threshold, round(gain, 6) AS gain, n_left, n_right FROM (
  SELECT *, row_number() OVER (PARTITION BY severity ORDER BY gain DESC, slot, threshold) AS place FROM (
    SELECT *, lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1) AS gain
    FROM sides WHERE lh >= 1 AND h - lh >= 1 AND n_left >= 1 AND n_right >= 1))
WHERE place = 1""",
        {
            "classes": " UNION ALL ".join(f"SELECT '{c}' AS severity, {i} AS c" for i, c in enumerate(C.SEVERITIES)),
            "edges": "\nUNION ALL ".join(
                f"SELECT {j} AS slot, '{f}' AS feature, CAST(unnest({es}) AS DOUBLE) AS threshold"
                for j, (f, es) in enumerate(numbers.items())),
            "longer": "\nUNION ALL ".join(
                f"SELECT {j} AS slot, CAST({f} AS DOUBLE) AS x, {_LABEL} AS label FROM featured"
                for j, f in enumerate(numbers)),
            "counts": "SELECT slot, x, label, count(*) AS n FROM longer GROUP BY ALL",
            "steps": f"""SELECT severity, slot, x, n,
  n * round((CAST(label = c AS INTEGER) - CAST(1 AS DOUBLE) / 3) * {unit}) / {unit} AS g,
  n * round(2 * (CAST(1 AS DOUBLE) / 3) * (CAST(2 AS DOUBLE) / 3) * {unit}) / {unit} AS h
FROM counts, classes""",
            "sides": """SELECT severity, e.slot, feature, threshold, sum(g) AS g, sum(h) AS h,
  sum(CASE WHEN x <= threshold THEN g ELSE 0 END) AS lg, sum(CASE WHEN x <= threshold THEN h ELSE 0 END) AS lh,
  CAST(sum(CASE WHEN x <= threshold THEN n ELSE 0 END) AS BIGINT) AS n_left,
  CAST(sum(CASE WHEN x > threshold THEN n ELSE 0 END) AS BIGINT) AS n_right
FROM steps s JOIN edges e ON s.slot = e.slot GROUP BY ALL""",
        },
    )
    phi = "SELECT * FROM (\n" + "\nUNION ALL ".join(
        f"SELECT accident_id, '{c}' AS feature, round({t} - (SELECT avg({t}) FROM featured), 6) AS phi FROM featured"
        for c, t in terms.items()
    ) + ")"
    sql["q_linear_importance"] = _sql(
        "featured",
        """SELECT feature, round(avg(abs(phi)), 6) AS importance FROM phi GROUP BY feature
ORDER BY avg(abs(phi)) DESC, feature LIMIT 5""",
        more={"phi": phi},
    )
    sql["q_linear_strongest"] = _sql(
        "featured",
        """SELECT accident_id, feature, phi, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY accident_id ORDER BY abs(phi) DESC, feature) AS rank FROM phi)
WHERE rank <= 8""",
        more={"phi": phi},
    )
    return sql
