"""DuckDB statements the registered queries are checked against."""

from __future__ import annotations

# The statements state their own values, apart from the engine's, so that a wrong one shows.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.143 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 (KHTML, like Gecko) Version/7.0.5 Safari/537.77.4",
    "Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
    "Mozilla/5.0 (iPad; CPU OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.125 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 4.4.2; Nexus 5) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.131 Mobile Safari/537.36",
)
DIMENSIONS = {
    "method": "method", "auth": "auth", "page": "page", "status": "status", "gender": "gender",
    "level": "level", "browser": "userAgent_browser_family", "os": "userAgent_os_family",
}
OVERVIEW = {
    "method": "method", "user_agent": "userAgent", "os": "userAgent_os_family", "page": "page",
    "status": "status", "auth": "auth", "browser": "userAgent_browser_family", "gender": "gender",
}
VARIABLES = ("method", "status", "level", "auth", "page")
FEATURE_PAGES = (
    "Add Friend", "Add to Playlist", "Error", "Help", "Home", "NextSong", "Submit Upgrade", "Thumbs Up", "Upgrade",
)
RAW = (
    "artist, sessionId, userId, location, status, userAgent, lastName, method, registration, song, level, "
    "itemInSession, ts, firstName, length, auth, gender, page"
)
LAKE = (
    "artist, sessionId, userId, location, status, userAgent, userAgent_browser_family, userAgent_browser_version, "
    "userAgent_os_family, userAgent_os_version, userAgent_is_mobile, userAgent_is_pc, userAgent_is_tablet, lastName, "
    "method, registration, registration_timestamp, song, level, itemInSession, ts, timestamp, firstName, length, "
    "auth, gender, page"
)
FACETS = (
    "userAgent_browser_family, userAgent_browser_version, userAgent_os_family, userAgent_os_version, "
    "userAgent_is_mobile, userAgent_is_pc, userAgent_is_tablet"
)

AGENT_CASES = "\n".join(f"    WHEN {i} THEN '{a}'" for i, a in enumerate(USER_AGENTS))

LOGS = f"""
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         (epoch_us(ts) // 1000) AS ms
  FROM events),
s AS (
  SELECT e.*, CAST(floor(ms / 259200000) AS INT) AS sid,
    CASE event_type
      WHEN 'click' THEN 'NextSong'
      WHEN 'error' THEN 'Error'
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'Upgrade' ELSE 'Submit Upgrade' END
      WHEN 'view' THEN CASE k % 4 WHEN 0 THEN 'Home' WHEN 1 THEN 'Help' WHEN 2 THEN 'Thumbs Up' ELSE 'Add Friend' END
      ELSE CASE WHEN user_id % 5 = 0 AND k % 10 = 0 THEN 'Submit Downgrade'
                WHEN user_id % 7 = 0 AND k % 10 = 1 THEN 'Cancellation Confirmation'
                WHEN k % 10 = 2 THEN 'Downgrade'
                WHEN k % 10 = 3 THEN 'Cancel'
                ELSE 'Add to Playlist' END END AS page
  FROM e),
l AS (
  SELECT
    event_id,
    CASE WHEN page = 'NextSong' THEN concat('artist_', CAST(k % 20 AS VARCHAR(10))) END AS artist,
    sid AS sessionId,
    CASE WHEN k = 99 THEN NULL WHEN k = 98 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS userId,
    concat('city_', CAST(user_id % 10 AS VARCHAR(10))) AS location,
    CASE WHEN page = 'Error' THEN 404 WHEN k % 8 = 0 THEN 307 ELSE 200 END AS status,
    CASE WHEN k = 97 THEN NULL ELSE CASE user_id % 8
{AGENT_CASES}
    END END AS userAgent,
    concat('Last_', CAST(user_id % 50 AS VARCHAR(10))) AS lastName,
    CASE WHEN event_type IN ('view', 'error') THEN 'GET' ELSE 'PUT' END AS method,
    CASE WHEN k = 99 THEN NULL ELSE CAST(1514764800000 + user_id * 86400000 AS DOUBLE) END AS registration,
    CASE WHEN page = 'NextSong' THEN concat('song_', CAST(k AS VARCHAR(10))) END AS song,
    CASE WHEN value < 110 THEN 'free' ELSE 'paid' END AS level,
    CAST(row_number() OVER (PARTITION BY user_id, sid ORDER BY ms, event_id) - 1 AS INT) AS itemInSession,
    CAST(ms AS DOUBLE) AS ts,
    ms,
    concat('First_', CAST(user_id % 30 AS VARCHAR(10))) AS firstName,
    CASE WHEN page = 'NextSong' THEN CAST(value AS FLOAT) END AS length,
    CASE WHEN k >= 98 THEN 'Logged Out' WHEN k % 25 = 0 THEN 'Guest' ELSE 'Logged In' END AS auth,
    CASE WHEN k = 99 THEN NULL WHEN user_id % 5 < 3 THEN 'M' ELSE 'F' END AS gender,
    page
  FROM s),
f AS (
  SELECT l.*,
    CASE WHEN userAgent IS NULL OR userAgent = '' THEN NULL
         WHEN userAgent LIKE '%MSIE%' OR userAgent LIKE '%Trident%' THEN 'IE'
         WHEN userAgent LIKE '%Firefox/%' THEN 'Firefox'
         WHEN userAgent LIKE '%CriOS/%' THEN 'Chrome Mobile iOS'
         WHEN userAgent LIKE '%Chrome/%' AND userAgent LIKE '%Mobile%' THEN 'Chrome Mobile'
         WHEN userAgent LIKE '%Chrome/%' THEN 'Chrome'
         WHEN userAgent LIKE '%Mobile/%' AND userAgent LIKE '%Safari/%' THEN 'Mobile Safari'
         WHEN userAgent LIKE '%Safari/%' THEN 'Safari'
         ELSE 'Other' END AS userAgent_browser_family,
    CASE WHEN userAgent IS NULL OR userAgent = '' THEN NULL
         WHEN userAgent LIKE '%iPhone%' OR userAgent LIKE '%iPad%' THEN 'iOS'
         WHEN userAgent LIKE '%Android%' THEN 'Android'
         WHEN userAgent LIKE '%Windows%' THEN 'Windows'
         WHEN userAgent LIKE '%Mac OS X%' THEN 'Mac OS X'
         WHEN userAgent LIKE '%Linux%' THEN 'Linux'
         ELSE 'Other' END AS userAgent_os_family
  FROM l),
logs AS (
  SELECT f.*,
    make_timestamp(ms * 1000) AS timestamp,
    make_timestamp(CAST(registration AS BIGINT) * 1000) AS registration_timestamp,
    CAST(make_timestamp(ms * 1000) AS DATE) AS date,
    CASE WHEN userAgent_browser_family IS NULL THEN NULL
         WHEN userAgent_browser_family = 'IE' THEN regexp_extract(userAgent, '(MSIE |rv:)([0-9.]+)', 2)
         WHEN userAgent_browser_family = 'Firefox' THEN regexp_extract(userAgent, 'Firefox/([0-9.]+)', 1)
         WHEN userAgent_browser_family = 'Chrome Mobile iOS' THEN regexp_extract(userAgent, 'CriOS/([0-9.]+)', 1)
         WHEN userAgent_browser_family LIKE 'Chrome%' THEN regexp_extract(userAgent, 'Chrome/([0-9.]+)', 1)
         WHEN userAgent_browser_family LIKE '%Safari' THEN regexp_extract(userAgent, 'Version/([0-9.]+)', 1)
         ELSE '' END AS userAgent_browser_version,
    CASE WHEN userAgent_os_family IS NULL THEN NULL
         WHEN userAgent_os_family = 'iOS' THEN replace(regexp_extract(userAgent, 'OS ([0-9_]+) like', 1), '_', '.')
         WHEN userAgent_os_family = 'Mac OS X' THEN replace(regexp_extract(userAgent, 'Mac OS X ([0-9_]+)', 1), '_', '.')
         WHEN userAgent_os_family = 'Android' THEN regexp_extract(userAgent, 'Android ([0-9.]+)', 1)
         WHEN userAgent_os_family = 'Windows' THEN regexp_extract(userAgent, 'Windows NT ([0-9.]+)', 1)
         ELSE '' END AS userAgent_os_version,
    CASE WHEN userAgent_os_family IS NULL THEN NULL
         ELSE userAgent LIKE '%iPhone%' OR (userAgent LIKE '%Android%' AND userAgent LIKE '%Mobile%') END AS userAgent_is_mobile,
    userAgent_os_family IN ('Windows', 'Mac OS X', 'Linux') AS userAgent_is_pc,
    CASE WHEN userAgent_os_family IS NULL THEN NULL
         ELSE userAgent LIKE '%iPad%' OR (userAgent LIKE '%Android%' AND userAgent NOT LIKE '%Mobile%') END AS userAgent_is_tablet
  FROM f),
u AS (SELECT * FROM logs WHERE userId IS NOT NULL)
"""

# The panels' log has NULLs in the five columns that panels select by.
PANEL_LOGS = f"""{LOGS}, panel AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 41 <> 0 THEN method END AS method,
    CASE WHEN event_id % 43 <> 0 THEN status END AS status,
    CASE WHEN event_id % 47 <> 0 THEN level END AS level,
    CASE WHEN event_id % 53 <> 0 THEN auth END AS auth,
    CASE WHEN event_id % 59 <> 0 THEN page END AS page)
  FROM logs)
"""

SELECTIONS = (
    "method IS NOT NULL AND status IS NOT NULL AND level IS NOT NULL "
    "AND auth IS NOT NULL AND page IS NOT NULL"
)
PANEL = (
    "timestamp BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-25 18:00:00' "
    f"AND {SELECTIONS}"
)
CUT_PANEL = (
    "timestamp BETWEEN TIMESTAMP '2024-01-05 06:01:40' AND TIMESTAMP '2024-01-25 18:03:20' "
    f"AND {SELECTIONS}"
)
INTERVAL_MS = {
    "5m": 300_000, "10m": 600_000, "30m": 1_800_000, "1h": 3_600_000, "6h": 21_600_000, "12h": 43_200_000,
    "1d": 86_400_000, "7d": 604_800_000, "14d": 1_209_600_000, "30d": 2_592_000_000,
}
CHOSEN = {
    "method": "method IN ('GET')",
    "status": "status IN (200, 307)",
    "level": "level IN ('paid')",
    "auth": "auth IN ('Guest', 'Logged Out')",
    "page": "page IN ('Home', 'Help', 'NextSong', 'Submit Upgrade')",
}


def _bucket(interval: str) -> str:
    width = INTERVAL_MS[interval]
    return f"make_timestamp(CAST(floor(ms / {width}) AS BIGINT) * {width} * 1000)"


def _metric(dim: str) -> str:
    return f"CAST({DIMENSIONS[dim]} AS VARCHAR)"


def _counts(dim: str, where: str = PANEL, tail: str = "") -> str:
    return f"""{PANEL_LOGS}, c AS (
      SELECT {_metric(dim)} AS metric, count(*) AS value FROM panel WHERE {where} GROUP BY 1)
    SELECT metric, value,
           CAST(value AS DOUBLE) * 100 / CAST(sum(value) OVER () AS BIGINT) AS percent
    FROM c {tail}"""


def _series(dim: str, interval: str, where: str = PANEL) -> str:
    return f"""{PANEL_LOGS}
    SELECT {_bucket(interval)} AS time, {_metric(dim)} AS metric, count(*) AS value
    FROM panel WHERE {where} GROUP BY 1, 2 ORDER BY 1"""


def _panels(where: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{dim}' AS panel, {_metric(dim)} AS metric, count(*) AS value "
        f"FROM panel WHERE {where} GROUP BY 2"
        for dim in DIMENSIONS
    )
    return f"""{PANEL_LOGS}, c AS ({parts})
    SELECT panel, metric, value,
           CAST(value AS DOUBLE) * 100 / CAST(sum(value) OVER (PARTITION BY panel) AS BIGINT) AS percent
    FROM c"""


def _time_panels() -> str:
    parts = " UNION ALL ".join(
        f"SELECT {_bucket('1d')} AS time, '{dim}' AS panel, {_metric(dim)} AS metric, "
        f"count(*) AS value FROM panel WHERE {PANEL} GROUP BY 1, 3"
        for dim in DIMENSIONS
    )
    return f"{PANEL_LOGS} {parts}"


def _resolutions() -> str:
    parts = " UNION ALL ".join(
        f"SELECT ms, '{dim}' AS panel, {_metric(dim)} AS metric FROM panel WHERE {PANEL}" for dim in DIMENSIONS
    )
    widths = ", ".join(f"('{name}', {width})" for name, width in INTERVAL_MS.items())
    return f"""{PANEL_LOGS}, p AS ({parts})
    SELECT interval, make_timestamp(CAST(floor(ms / width) AS BIGINT) * width * 1000) AS time, panel, metric, count(*) AS value
    FROM p, (VALUES {widths}) w(interval, width) GROUP BY ALL"""


def _flag(column: str, condition: str) -> str:
    return f"max(CAST({condition} AS INT)) AS {column}"


BROWSER = ", ".join(
    _flag(f"uses_{name}", f"userAgent_browser_family LIKE '%{pattern}%'")
    for name, pattern in [("chrome", "Chrome"), ("safari", "Safari"), ("firefox", "Firefox"), ("ie", "IE")]
)
OS = ", ".join(
    _flag(f"uses_{name}", f"userAgent_os_family LIKE '%{pattern}%'")
    for name, pattern in [
        ("windows", "Windows"), ("mac", "Mac"), ("ios", "iOS"), ("android", "Android"), ("linux", "Linux"),
    ]
)


def _device(name: str) -> str:
    flag = f"userAgent_is_{name}"
    return f"{_flag(f'uses_{name}', flag)}, {_flag(f'uses_non_{name}', f'NOT {flag}')}"


LABEL = "max(CASE WHEN page IN ('Submit Downgrade', 'Cancellation Confirmation') THEN 1 ELSE 0 END) AS churn"
VIEWS = ", ".join(f"count(*) FILTER (WHERE page = '{page}') AS \"{page}\"" for page in FEATURE_PAGES)

SONGS = """SELECT userId, avg(n) AS avg_songs_per_session FROM (
  SELECT userId, sessionId, count(*) AS n FROM u WHERE page = 'NextSong' GROUP BY 1, 2) GROUP BY 1"""
DURATION = """SELECT userId, avg(d) / 1000 / 60 / 60 / 24 AS avg_session_duration_days FROM (
  SELECT userId, sessionId, max(ts) - min(ts) AS d FROM u GROUP BY 1, 2) GROUP BY 1"""
ARTISTS = """SELECT userId, avg(n) AS avg_num_artists_per_session FROM (
  SELECT userId, sessionId, count(DISTINCT artist) AS n FROM u WHERE artist IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""

FLAG_NAMES = [
    "uses_chrome", "uses_safari", "uses_firefox", "uses_ie",
    "uses_windows", "uses_mac", "uses_ios", "uses_android", "uses_linux",
    "uses_mobile", "uses_non_mobile", "uses_pc", "uses_non_pc", "uses_tablet", "uses_non_tablet",
]

NULL_VIEWS = f"""{VIEWS}, count(*) FILTER (WHERE page IS NULL) AS "null\""""

# The log with NULL pages.
NULL_PAGES = LOGS.replace(
    "u AS (SELECT * FROM logs WHERE",
    "u AS (SELECT * REPLACE (CASE WHEN event_id % 59 <> 0 THEN page END AS page) FROM logs WHERE",
)


def _features(logs: str, views: str, pages: tuple[str, ...]) -> str:
    return f"""{logs},
flat AS (SELECT userId, {LABEL}, {views}, {BROWSER}, {OS}, {_device('mobile')}, {_device('pc')}, {_device('tablet')}
         FROM u GROUP BY userId),
songs AS ({SONGS}), spans AS ({DURATION}), artists AS ({ARTISTS})
SELECT flat.userId, churn, {', '.join(f'"{page}"' for page in pages)},
  coalesce(avg_songs_per_session, 0) AS avg_songs_per_session,
  coalesce(avg_session_duration_days, 0) AS avg_session_duration_days,
  coalesce(avg_num_artists_per_session, 0) AS avg_num_artists_per_session,
  {', '.join(f'coalesce({name}, 0) AS {name}' for name in FLAG_NAMES)}
FROM flat LEFT JOIN songs USING (userId) LEFT JOIN spans USING (userId) LEFT JOIN artists USING (userId)"""


FEATURES = _features(LOGS, VIEWS, FEATURE_PAGES)
FEATURES_DISCOVERED = _features(NULL_PAGES, NULL_VIEWS, (*FEATURE_PAGES, "null"))

BROKEN = " OR ".join(f"event_id % {n} = 0" for n in (101, 103, 107, 109, 113))
QUARANTINE = f"""{LOGS}
SELECT CASE WHEN event_id % 101 = 0 THEN 'malformed' WHEN event_id % 103 = 0 THEN 'empty'
            WHEN event_id % 107 = 0 THEN 'missing ts' WHEN event_id % 109 = 0 THEN 'malformed'
            ELSE 'unusable ts' END AS reason, count(*) AS lines
FROM logs WHERE {BROKEN} GROUP BY 1"""

IN_TRAIN = "CAST('0x' || substr(md5(userId), 1, 7) AS BIGINT) % 10000 < 8000"
TEST_USERS = f"{LOGS}, t AS (SELECT userId, {LABEL} FROM u WHERE NOT ({IN_TRAIN}) GROUP BY 1)"
# A label that one feature decides: a classifier that has learned anything finds every one of them.
PLANTED = f"""{LOGS}, t AS (
  SELECT * FROM (
    SELECT concat(userId, '-', CAST(sessionId AS VARCHAR(20))) AS userId,
           coalesce(max(CAST(userAgent_os_family = 'iOS' AS INT)), 0) AS churn
    FROM u GROUP BY 1)
  WHERE NOT ({IN_TRAIN}))"""

METRICS = """
WITH c AS (
  SELECT count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn,
         count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
         count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn,
         count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp
  FROM labels),
d AS (SELECT *, CAST(tn AS DOUBLE) AS a, CAST(fp AS DOUBLE) AS b,
             CAST(fn AS DOUBLE) AS c, CAST(tp AS DOUBLE) AS d FROM c),
r AS (
  SELECT *, coalesce(a / nullif(a + c, 0), 0) AS p0, coalesce(a / nullif(a + b, 0), 0) AS r0,
            coalesce(d / nullif(d + b, 0), 0) AS p1, coalesce(d / nullif(c + d, 0), 0) AS r1
  FROM d),
g AS (
  SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
            coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM r)
SELECT f0 * ((a + b) / (a + b + c + d)) + f1 * ((c + d) / (a + b + c + d)) AS weighted_f1,
       f1 AS f1_churn, (a + d) / (a + b + c + d) AS accuracy, tn, fp, fn, tp
FROM g"""

CONFUSION = """
WITH t(churn) AS (VALUES (0), (1))
SELECT t.churn, count(*) FILTER (WHERE toxic = 0) AS predicted_0,
       count(*) FILTER (WHERE toxic = 1) AS predicted_1
FROM t LEFT JOIN labels ON labels.quality = t.churn GROUP BY t.churn"""

SUMMARY = f"""{LOGS}, c AS (SELECT userId, {LABEL} FROM u GROUP BY 1)
SELECT (SELECT count(*) FROM logs) AS messages, (SELECT count(*) FROM u) AS messages_with_user,
       (SELECT count(*) FROM c) AS users,
       (SELECT count(*) FROM c WHERE churn > 0) AS churned_users,
       (SELECT count(*) FROM c WHERE churn = 0) AS loyal_users"""

STREAM_SERIES = f"""{LOGS}
SELECT {_bucket('1d')} AS time, level AS metric, count(*) AS value
FROM logs WHERE {SELECTIONS} GROUP BY 1, 2"""


# All rows but every 50th arrive in order of time; those come last, late where the day ended a day
# before the latest time of the others.
STREAM_SERIES_LATE = f"""{LOGS}
SELECT {_bucket('1d')} AS time, level AS metric, count(*) AS value,
       count(*) FILTER (WHERE event_id % 50 = 0 AND floor(ms / 86400000) * 86400000 + 86400000
                        <= (SELECT max(ms) FROM logs WHERE {SELECTIONS} AND event_id % 50 <> 0) - 86400000) AS late
FROM logs WHERE {SELECTIONS} GROUP BY 1, 2"""


def oracle_statements() -> dict[str, str]:
    sql = {
        f"distinct_{name}": f"{LOGS} SELECT DISTINCT {column} FROM logs"
        for name, column in OVERVIEW.items()
    }
    sql |= {
        f"var_{name}": f"{LOGS} SELECT DISTINCT {name} FROM logs ORDER BY 1 NULLS LAST"
        for name in VARIABLES
    }
    sql |= {f"counts_{dim}": _counts(dim) for dim in DIMENSIONS}
    sql |= {f"counts_page_by_{name}": _counts("page", f"{PANEL} AND {chosen}") for name, chosen in CHOSEN.items()}
    sql["top_pages"] = _counts("page", tail="ORDER BY value DESC, metric LIMIT 5")
    sql |= {f"series_auth_{width}": _series("auth", width) for width in ("10m", "30m", "1h", "6h", "12h", "14d")}
    sql |= {f"series_{dim}": _series(dim, "1d") for dim in DIMENSIONS}
    sql |= {
        "series_page_7d": _series("page", "7d"),
        "series_level_30d": _series("level", "30d"),
        "series_method_5m": _series("method", "5m"),
        "value_distribution": _panels(PANEL),
        "value_distribution_top": f"""SELECT panel, metric, value, percent FROM (
            SELECT *, row_number() OVER (PARTITION BY panel ORDER BY value DESC, metric) AS place
            FROM ({_panels(PANEL)}))
            WHERE NOT (panel = 'page' AND place > 4 OR panel = 'level' AND place > 1)""",
        "time_distribution": _time_panels(),
        "drill_404": _panels(f"status = 404 AND {PANEL}"),
        "free_vs_paid": _series("level", "1d"),
        "down_vs_upgrades": _series(
            "page", "1d", f"{PANEL} AND level IN ('paid') AND page IN ('Submit Downgrade', 'Submit Upgrade')"
        ),
        "weekday": f"""{PANEL_LOGS} SELECT CAST(dayofweek(timestamp) + 1 AS INT) AS weekday,
            count(*) AS value FROM panel WHERE {PANEL} GROUP BY 1""",
        "sql_view": f"""{LOGS} SELECT level, gender, count(*) AS value FROM logs
            WHERE status = 404 GROUP BY level, gender""",
        "dataset_summary": SUMMARY,
        "churn_labels": f"{LOGS} SELECT userId, {LABEL} FROM u GROUP BY 1",
        "page_views": f"{LOGS} SELECT userId, {VIEWS} FROM u GROUP BY 1",
        "avg_songs_per_session": f"{LOGS} {SONGS}",
        "avg_session_duration": f"{LOGS} {DURATION}",
        "avg_artists_per_session": f"{LOGS} {ARTISTS}",
        "browser_usage": f"{LOGS} SELECT userId, {BROWSER} FROM u GROUP BY 1",
        "os_usage": f"{LOGS} SELECT userId, {OS} FROM u GROUP BY 1",
        **{
            f"{device}_usage": f"{LOGS} SELECT userId, {_device(device)} FROM u GROUP BY 1"
            for device in ("mobile", "pc", "tablet")
        },
        "page_views_discovered": f"{NULL_PAGES} SELECT userId, {NULL_VIEWS} FROM u GROUP BY 1",
        "churn_features_discovered": FEATURES_DISCOVERED,
        "churn_features": FEATURES,
        "churn_features_by_day": FEATURES,
        "churn_features_joined": FEATURES,
        "cube_resolutions": _resolutions(),
        "cube_distribution": _panels(CUT_PANEL),
        "cube_series_cut": _series("page", "5m", f"{CUT_PANEL} AND level IN ('paid')"),
        "audience_by_level": f"""{LOGS}, days AS (
            SELECT level, userId FROM u WHERE date >= DATE '2024-01-01' AND date < DATE '2024-01-30')
            SELECT level, count(*) AS rows, count(DISTINCT userId) AS users, true AS within_bound FROM days GROUP BY 1
            UNION ALL SELECT 'all', count(*), count(DISTINCT userId), true FROM days""",
        "user_agent_facets": f"{LOGS} SELECT event_id, userAgent, {FACETS} FROM logs",
        "log_timestamps": f"{LOGS} SELECT event_id, timestamp, registration_timestamp, date FROM logs",
        "lake_roundtrip": f"""{LOGS} SELECT {LAKE}, date FROM logs
            WHERE date >= DATE '2024-01-01' AND date < DATE '2024-01-30'""",
        "json_roundtrip": f"{LOGS} SELECT {RAW} FROM logs",
        "hash_split": f"""{LOGS} SELECT userId,
            CAST(CAST('0x' || substr(md5(userId), 1, 7) AS BIGINT) % 10000 < 8000 AS INT) AS train
            FROM (SELECT DISTINCT userId FROM u)""",
        "ingest_batch": f"{LOGS} SELECT {LAKE}, date FROM logs WHERE NOT ({BROKEN})",
        "ingest_quarantine": QUARANTINE,
        "ingest_replaces_days": f"""{LOGS} SELECT * REPLACE (
            CASE WHEN date < DATE '2024-01-10' THEN 'paid' ELSE level END AS level)
            FROM (SELECT {LAKE}, date FROM logs)""",
        "compare_totals": f"""{TEST_USERS}
            SELECT classifier, count(*) AS test_rows, CAST(sum(churn) AS BIGINT) AS churned
            FROM t, (VALUES ('dt'), ('lr')) c(classifier) GROUP BY 1""",
        "compare_planted": f"""{PLANTED}
            SELECT classifier, CAST(1 AS DOUBLE) AS weighted_f1, CAST(1 AS DOUBLE) AS f1_churn, CAST(1 AS DOUBLE) AS accuracy,
                   count(*) FILTER (WHERE churn = 0) AS tn, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn,
                   count(*) FILTER (WHERE churn = 1) AS tp
            FROM t, (VALUES ('dt'), ('rf'), ('lr'), ('svc')) c(classifier) GROUP BY 1""",
        "score_planted": f"{PLANTED} SELECT userId, churn AS prediction FROM t",
        "score_coverage": f"{TEST_USERS} SELECT count(*) AS users, count(*) AS scored FROM t",
        "metrics": METRICS,
        "confusion": CONFUSION,
        "stream_ingest": f"{LOGS} SELECT {LAKE}, date FROM logs",
        "stream_quarantine": f"""{QUARANTINE}
            UNION ALL SELECT 'good', count(*) FROM logs WHERE NOT ({BROKEN})""",
        "stream_series": STREAM_SERIES,
        "stream_series_late": STREAM_SERIES_LATE,
    }
    return sql
