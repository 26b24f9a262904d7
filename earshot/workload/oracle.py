"""The registered queries as SQL over the benchmark tables.

Ratios are compared and rounded in whole numbers here: ``half_up`` gives the text of
``round(a / b, digits)`` with ties away from zero, for numbers that are not negative.
"""

from __future__ import annotations


def half_up(a: str, b: str, digits: int) -> str:
    scale = 10**digits
    return f"(((2 * {scale} * ({a}) + ({b})) // (2 * ({b}))) / {float(scale)})"


LOCAL = "AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'"
SHOWN = "'%Y-%m-%d %H:%M:%S'"

EVENTS = """
ev AS (
  SELECT *, CAST(k * 7 + user_id * 13 AS VARCHAR) AS n FROM (
    SELECT event_id, user_id, event_type, value,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
           date_trunc('second', ts) + to_days(CAST(user_id % 3 * 30 AS INTEGER)) AS second
    FROM events)),
ev_uri AS (
  SELECT *, CASE WHEN k = 99 THEN CASE WHEN event_id % 2 = 0 THEN '' END
                 WHEN k = 98 THEN 'https://open.spotify.com/track/' || n || '?si=1'
                 WHEN k = 97 THEN 'spotify:episode:' || n
                 WHEN k = 96 THEN 'spotify:track:u' || n
                 ELSE 'spotify:track:' || n END AS uri
  FROM ev),
history AS (
  SELECT event_id, second, strftime(second, '%Y-%m-%dT%H:%M:%SZ') AS ts,
         CASE WHEN value < 5 THEN 0 WHEN event_id % 50 = 7 THEN NULL
              ELSE CAST(round(value * 1000) AS BIGINT) END AS ms_played,
         uri AS spotify_track_uri,
         CASE WHEN event_id % 3 <> 0 THEN 'clickrow'
              WHEN event_id % 2 = 0 THEN 'unknown' END AS reason_start,
         CASE WHEN event_type = 'click' THEN 'fwdbtn'
              WHEN event_type = 'purchase' THEN 'trackdone'
              WHEN event_type = 'error' THEN 'backbtn'
              WHEN event_type = 'signup' THEN CASE event_id % 6
                   WHEN 0 THEN 'endplay' WHEN 1 THEN 'logout' WHEN 2 THEN 'unexpected-exit'
                   WHEN 3 THEN 'unexpected-exit-while-paused' WHEN 4 THEN 'remote'
                   ELSE 'trackerror' END
              WHEN event_id % 2 = 0 THEN 'unknown' END AS reason_end,
         user_id % 2 = 0 AS shuffle, event_id % 5 = 0 AS offline,
         CASE k % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'web' END AS platform
  FROM ev_uri),
raw_recent AS (
  SELECT event_id, user_id, CASE WHEN k = 95 THEN '' ELSE 'Track ' || n END AS track_name,
         (second + to_seconds(event_id % 4 * 40)) AT TIME ZONE 'UTC'
           AT TIME ZONE 'America/New_York' AS played_at,
         uri AS spotify_track_uri
  FROM ev_uri)"""

TRACKS = """
payload AS (
  SELECT *, 'spotify:track:' || p_partkey AS source_uri, p_name AS track_name,
         CASE WHEN p_partkey % 25 = 1 THEN 0
              WHEN p_partkey % 10 = 0 THEN NULL ELSE p_size * 4000 + 20000 END AS duration_ms,
         p_partkey % 13 AS n_artists,
         CASE WHEN p_partkey % 13 > 0 THEN p_brand || '-1' END AS artist_1_name
  FROM part)"""

PLAYS = f"""
hist_event AS (
  SELECT *, second {LOCAL} AS played_at FROM history
  WHERE spotify_track_uri <> ''
    AND NOT (ms_played = 0 AND (reason_end IS NULL OR reason_end = 'unknown')
                           AND (reason_start IS NULL OR reason_start = 'unknown'))),
hist_plays AS (
  SELECT h.spotify_track_uri, played_at, ms_played,
         CASE WHEN d > 0 AND ms_played IS NOT NULL
              THEN (20000 * least(ms_played, d) + d) // (2 * d) END AS units,
         CASE WHEN reason_end = 'trackdone' THEN 'full_listen'
              WHEN reason_end = 'fwdbtn' THEN 'skip'
              WHEN reason_end = 'backbtn' AND d > 0 AND ms_played * 5 < d THEN 'skip'
              WHEN reason_end = 'backbtn' AND d > 0 AND ms_played * 5 >= d THEN 'full_listen'
              WHEN reason_end IN ('endplay', 'logout', 'unexpected-exit',
                                  'unexpected-exit-while-paused', 'remote', 'trackerror')
                   THEN 'natural_end'
              WHEN d > 0 AND ms_played * 5 >= d * 4 THEN 'full_listen'
              WHEN d > 0 AND ms_played * 100 < d * 15 THEN 'skip'
              ELSE 'partial' END AS play_quality,
         'extended_history' AS source
  FROM hist_event h LEFT JOIN (SELECT source_uri, duration_ms AS d FROM payload)
    ON spotify_track_uri = source_uri),
recent AS (
  SELECT DISTINCT track_name, played_at, spotify_track_uri FROM raw_recent
  WHERE spotify_track_uri <> ''),
recent_user AS (
  SELECT DISTINCT user_id, track_name, played_at, spotify_track_uri FROM raw_recent
  WHERE spotify_track_uri <> ''),
gaps AS (
  SELECT NULL AS user_id, *, date_sub('second', played_at, lead(played_at) OVER (
           ORDER BY played_at, spotify_track_uri, track_name)) AS gap FROM recent),
gaps_user AS (
  SELECT *, date_sub('second', played_at, lead(played_at) OVER (PARTITION BY user_id
           ORDER BY played_at, spotify_track_uri, track_name)) AS gap FROM recent_user)"""


def _recent_plays(name: str, gaps: str) -> str:
    return f"""
{name} AS (
  SELECT user_id, spotify_track_uri, played_at,
         CASE play_quality WHEN 'full_listen' THEN least(gap * 1000, d)
              WHEN 'skip' THEN gap * 1000 WHEN 'partial' THEN gap * 1000 END AS ms_played,
         CASE WHEN gap IS NOT NULL AND d <> 0
              THEN (20000 * least(gap * 1000, d) + d) // (2 * d) END AS units,
         play_quality, 'recently_played' AS source
  FROM (SELECT g.*, d, CASE WHEN gap IS NULL THEN NULL
                            WHEN gap > 300 THEN 'natural_end'
                            WHEN d IS NULL OR d = 0 THEN NULL
                            WHEN gap * 5000 >= d * 4 THEN 'full_listen'
                            WHEN gap * 100000 < d * 15 THEN 'skip'
                            ELSE 'partial' END AS play_quality
        FROM {gaps} g LEFT JOIN (SELECT source_uri, duration_ms AS d FROM payload)
          ON spotify_track_uri = source_uri))"""


UNIFIED = f"""
{_recent_plays("recent_plays", "gaps")},
kept AS (
  SELECT * FROM recent_plays r WHERE NOT EXISTS (
    SELECT 1 FROM hist_event h WHERE h.spotify_track_uri = r.spotify_track_uri
       AND abs(date_sub('second', h.played_at, r.played_at)) <= 60)),
plays AS (
  SELECT * FROM hist_plays UNION ALL
  SELECT spotify_track_uri, played_at, ms_played, units, play_quality, source FROM kept)"""

MONTHS = """
months AS (
  SELECT spotify_track_uri, strftime(played_at, '%Y-%m') AS month, count(*) AS monthly_plays
  FROM plays GROUP BY ALL),
peaks AS (
  SELECT spotify_track_uri, month, monthly_plays FROM (
    SELECT *, row_number() OVER (PARTITION BY spotify_track_uri
                                 ORDER BY monthly_plays DESC, month DESC) AS rn FROM months)
  WHERE rn = 1)"""

STATS = f"""
counts AS (
  SELECT spotify_track_uri, count(*) AS play_count,
         count(DISTINCT CAST(played_at AS DATE)) AS unique_days_played,
         count(*) FILTER (play_quality = 'full_listen') AS full_listen_count,
         count(*) FILTER (play_quality = 'natural_end') AS natural_end_count,
         count(*) FILTER (play_quality = 'partial') AS partial_count,
         count(*) FILTER (play_quality = 'skip') AS skip_count,
         count(*) FILTER (play_quality IS NULL) AS unclassified_count,
         CAST(sum(units) AS BIGINT) AS unit_sum, count(units) AS unit_n,
         CAST(sum(ms_played) AS BIGINT) AS total_ms_played,
         min(played_at) AS first_at, max(played_at) AS last_at
  FROM plays GROUP BY spotify_track_uri),
rated AS (
  SELECT *, full_listen_count + skip_count + partial_count AS decisive FROM counts),
stats AS (
  SELECT r.spotify_track_uri, track_name, artist_1_name AS artist_name, play_count,
         unique_days_played, full_listen_count, natural_end_count, partial_count, skip_count,
         unclassified_count,
         CASE WHEN unit_n > 0 THEN ((2 * unit_sum + unit_n) // (2 * unit_n)) / 10000.0 END
           AS avg_play_percentage,
         total_ms_played, {half_up("total_ms_played", "60000", 2)} AS total_minutes_played,
         CASE WHEN decisive > 0 THEN {half_up("skip_count", "decisive", 4)} END AS skip_rate,
         CASE WHEN decisive > 0 THEN {half_up("full_listen_count", "decisive", 4)} END
           AS completion_rate,
         strftime(first_at, {SHOWN}) AS first_played_at,
         strftime(last_at, {SHOWN}) AS last_played_at,
         date_diff('day', CAST(last_at AS DATE), DATE '2024-06-01') AS days_since_last,
         month AS peak_listen_month, monthly_plays AS peak_month_play_count
  FROM rated r LEFT JOIN payload ON r.spotify_track_uri = source_uri
               LEFT JOIN peaks p ON r.spotify_track_uri = p.spotify_track_uri)"""

TAGS = """
words AS (
  SELECT DISTINCT axis_id, word FROM (
    SELECT 1 AS axis_id, split_part(p_name, ' ', 1) AS word FROM part UNION ALL
    SELECT 3, split_part(p_name, ' ', 2) FROM part UNION ALL
    SELECT 5, lower(p_type) FROM part)),
tags AS (
  SELECT row_number() OVER (ORDER BY word) AS tag_id, word AS tag, axis_id FROM (
    SELECT word, min(axis_id) AS axis_id FROM (
      SELECT axis_id, word FROM words WHERE word <> 'economy' UNION
      SELECT axis_id, 'unused' || axis_id FROM words) GROUP BY word)),
axes(axis_id, axis) AS (
  VALUES (1, 'Energy'), (2, 'Mood'), (3, 'Genre'), (4, 'Context'), (5, 'Production'),
         (6, 'Language'), (7, 'Period'), (8, 'General')),
playlists AS (
  SELECT axis_id || ':' || word AS playlist_id,
         CASE WHEN word = 'promo' THEN '##promo' WHEN word = 'medium' THEN 'medium'
              WHEN axis_id = 5 THEN '#' || upper(word) ELSE '#' || word END AS name
  FROM words),
tracks AS (
  SELECT playlist_id, 'spotify:track:' || p_partkey AS spotify_track_uri FROM (
    SELECT p_partkey, '1:' || split_part(p_name, ' ', 1) AS playlist_id FROM part UNION ALL
    SELECT p_partkey, '3:' || split_part(p_name, ' ', 2) FROM part UNION ALL
    SELECT p_partkey, '5:' || lower(p_type) FROM part)
  WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0),
named AS (
  SELECT playlist_id, name, lower(substr(name, 2)) AS tag FROM playlists WHERE name LIKE '#%'),
mapping AS (
  SELECT DISTINCT tag_id, spotify_track_uri
  FROM named JOIN tags USING (tag) JOIN tracks USING (playlist_id)),
tagged AS (
  SELECT 'spotify:track:' || p_partkey AS spotify_track_uri FROM part)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


FOR_PLAYS = _with(EVENTS, TRACKS, PLAYS, UNIFIED)
FOR_STATS = _with(EVENTS, TRACKS, PLAYS, UNIFIED, MONTHS, STATS)
FOR_TAGS = _with(TAGS)


def _play_columns(extra: str = "") -> str:
    return f"""{extra} spotify_track_uri, strftime(played_at, {SHOWN}) AS played_at,
       CAST(ms_played AS BIGINT) AS ms_played, units / 10000.0 AS play_percentage, play_quality,
       play_quality = 'skip' AS skipped, source"""


def _having(tag: str) -> str:
    return f"""EXISTS (SELECT 1 FROM mapping m JOIN tags t ON t.tag_id = m.tag_id
      WHERE t.tag = '{tag}' AND m.spotify_track_uri = tagged.spotify_track_uri)"""


def _tag_query(condition: str) -> str:
    return f"{FOR_TAGS} SELECT spotify_track_uri FROM tagged WHERE {condition}"


def _violations(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(({sql}) AS BIGINT) AS violations FROM {source}"
        for name, sql in rules.items()
    )


def _rules(not_null: list[str], lengths: dict[str, int]) -> dict[str, str]:
    rules = {f"{c} not null": f"count(*) FILTER ({c} IS NULL)" for c in not_null}
    for column, width in lengths.items():
        rules[f"{column} length <= {width}"] = f"count(*) FILTER (length({column}) > {width})"
    return rules


def _sessions(log: str, keys: str, gap: int) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""{_with(EVENTS)}, lagged AS (
  SELECT *, lag(played_at) OVER ({part} ORDER BY played_at) AS prev FROM {log}),
numbered AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR date_sub('second', prev, played_at) > {gap}
                     THEN 1 ELSE 0 END)
            OVER ({part} ORDER BY played_at ROWS UNBOUNDED PRECEDING) AS nr FROM lagged)
SELECT {lead} strftime(min(played_at), {SHOWN}) AS session_start,
       strftime(max(played_at), {SHOWN}) AS session_end, count(*) AS play_count
FROM numbered GROUP BY {lead} nr"""


GAP_LOG = "SELECT DISTINCT {0} track_name, played_at, spotify_track_uri FROM raw_recent"


def _gaps(extra: str, part: str) -> str:
    log = GAP_LOG.format(extra)
    return f"""{_with(EVENTS)} SELECT {extra} track_name, strftime(played_at, {SHOWN}) AS played_at,
       spotify_track_uri, date_sub('second', played_at, lead(played_at) OVER ({part}
         ORDER BY played_at, spotify_track_uri NULLS FIRST, track_name)) AS gap_seconds
FROM ({log})"""


URIS = """uris AS (
  SELECT spotify_track_uri AS uri FROM history WHERE spotify_track_uri IS NOT NULL UNION
  SELECT spotify_track_uri FROM raw_recent WHERE spotify_track_uri IS NOT NULL),
found AS (
  SELECT uri, nullif(regexp_extract(uri,
    '(?:spotify:track:|https?://open\\.spotify\\.com/track/)([A-Za-z0-9_-]+)', 1), '') AS track_id
  FROM uris)"""

WIDE = ", ".join(
    f"CASE WHEN n_artists >= {i} THEN p_brand || '-{i}' END AS artist_{i}_name, "
    f"CASE WHEN n_artists >= {i} THEN 'artist:{i}' END AS artist_{i}_uri"
    for i in range(1, 13)
)

TRACK_ROWS = f"""{_with(TRACKS)}
SELECT source_uri, track_name, CAST(duration_ms AS BIGINT) AS duration_ms,
       p_partkey % 3 <> 0 AS is_playable, CAST(p_size AS BIGINT) AS popularity,
       CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS album_name,
       CASE WHEN p_partkey % 4 <> 0 THEN '2020' END AS release_date,
       CASE WHEN p_partkey % 4 <> 0 THEN 'year' END AS release_date_precision,
       CASE WHEN p_partkey % 4 <> 0 THEN 'album:' || p_type END AS album_uri
FROM payload WHERE duration_ms IS NOT NULL"""

DEVICE = "ts, ms_played, spotify_track_uri, reason_start, reason_end"
UNTIDY = f"""{_with(EVENTS)}, untidy AS (
  SELECT ' ' || chr(9) || ts || chr(10) || ' ' AS ts, ms_played,
         '  ' || spotify_track_uri AS spotify_track_uri, reason_end || chr(160) AS reason_end
  FROM history),
twice AS (SELECT * FROM untidy UNION ALL SELECT * FROM untidy)"""

STORED_RECENT = f"""{_with(EVENTS)} SELECT DISTINCT track_name,
       strftime(played_at, {SHOWN}) AS played_at,
       coalesce(spotify_track_uri, '') AS spotify_track_uri FROM raw_recent"""

MONTHLY = f"""{FOR_PLAYS}, monthly AS (
  SELECT strftime(played_at, '%Y-%m') AS month, spotify_track_uri, count(*) AS play_count,
         count(*) FILTER (play_quality = 'skip') AS skip_count,
         count(*) FILTER (play_quality IN ('full_listen', 'skip', 'partial')) AS decisive
  FROM plays GROUP BY 1, 2),
rates AS (
  SELECT month, spotify_track_uri, play_count, skip_count,
         CASE WHEN decisive > 0 THEN {half_up("skip_count", "decisive", 4)} END AS skip_rate
  FROM monthly)"""

STREAM_OVERLAP = f"""{FOR_PLAYS}, log AS (
  SELECT DISTINCT track_name, played_at, spotify_track_uri FROM raw_recent)
SELECT track_name, strftime(played_at, {SHOWN}) AS played_at, spotify_track_uri FROM log r
WHERE NOT EXISTS (
    SELECT 1 FROM hist_event h WHERE h.spotify_track_uri = r.spotify_track_uri
       AND abs(date_sub('second', h.played_at, r.played_at)) <= 60)"""
CLASSIFIED_RECENT = f"{FOR_PLAYS} SELECT {_play_columns()} FROM recent_plays"
CLASSIFIED_PER_USER = f"""{_with(EVENTS, TRACKS, PLAYS)},
{_recent_plays("user_plays", "gaps_user")} SELECT {_play_columns("user_id,")} FROM user_plays"""
MAPPING = f"{FOR_TAGS} SELECT tag_id, spotify_track_uri FROM mapping"
TRACK_STATS = f"{FOR_STATS} SELECT * FROM stats"

ORACLE: dict[str, str] = {
    "classify_history": f"{FOR_PLAYS} SELECT {_play_columns()} FROM hist_plays",
    "low_confidence_dropped": f"""{_with(EVENTS)}
SELECT event_id, ts, ms_played, spotify_track_uri, reason_start, reason_end FROM history
WHERE spotify_track_uri <> ''
  AND coalesce(ms_played, 0) = 0 AND coalesce(reason_end, 'unknown') = 'unknown'
  AND coalesce(reason_start, 'unknown') = 'unknown'""",
    "gap_to_next_play": _gaps("", ""),
    "gap_to_next_per_user": _gaps("user_id,", "PARTITION BY user_id"),
    "classify_recent": CLASSIFIED_RECENT,
    "classify_recent_per_user": CLASSIFIED_PER_USER,
    "dedup_recent": f"{FOR_PLAYS} SELECT {_play_columns()} FROM kept",
    "plays": f"{FOR_PLAYS} SELECT {_play_columns()} FROM plays",
    "plays_summary": f"""{FOR_PLAYS} SELECT source, play_quality, count(*) AS n FROM plays
GROUP BY ALL ORDER BY source, play_quality NULLS FIRST""",
    "play_ids": f"{FOR_PLAYS} SELECT count(*) AS n, count(*) AS n_ids FROM plays",
    "plays_constraints": f"{FOR_PLAYS} "
    + _violations(
        "plays",
        {
            **_rules(
                ["spotify_track_uri", "played_at", "source"],
                {"spotify_track_uri": 100, "play_quality": 20, "source": 20},
            ),
            "play_id not null": "count(*) - count(*)",
            "unique (play_id)": "count(*) - count(*)",
        },
    ),
    "recent_distinct": f"""{_with(EVENTS)} SELECT DISTINCT track_name,
       strftime(played_at, {SHOWN}) AS played_at, spotify_track_uri FROM raw_recent""",
    "listening_sessions": _sessions("raw_recent", "", 300),
    "listening_sessions_per_user": _sessions("raw_recent", "user_id", 21600),
    "monthly_plays": f"""{FOR_PLAYS} SELECT spotify_track_uri,
       strftime(played_at, '%Y-%m') AS month, count(*) AS monthly_plays
FROM plays GROUP BY 1, 2""",
    "peak_months": f"{FOR_STATS} SELECT * FROM peaks",
    "peak_months_rownum": f"{FOR_STATS} SELECT * FROM peaks",
    "track_stats": TRACK_STATS,
    "track_stats_constraints": f"{FOR_STATS} "
    + _violations(
        "stats",
        {
            **_rules(
                [
                    "play_count",
                    "unique_days_played",
                    "full_listen_count",
                    "natural_end_count",
                    "partial_count",
                    "skip_count",
                    "unclassified_count",
                ],
                {"spotify_track_uri": 100, "track_name": 500, "artist_name": 500},
            ),
            "unique (spotify_track_uri)": "count(*) - count(DISTINCT spotify_track_uri)",
        },
    ),
    "stats_summary": f"""{FOR_STATS}, units AS (
  SELECT play_count, CAST(round(skip_rate * 10000) AS BIGINT) AS s,
         CAST(round(completion_rate * 10000) AS BIGINT) AS c FROM stats)
SELECT count(*) AS unique_tracks, CAST(sum(play_count) AS BIGINT) AS total_plays,
       {half_up("sum(play_count)", "count(*)", 2)} AS avg_plays_per_track,
       max(play_count) AS max_plays_for_one_track,
       ((2 * sum(s) + count(s)) // (2 * count(s))) / 10000.0 AS avg_skip_rate,
       ((2 * sum(c) + count(c)) // (2 * count(c))) / 10000.0 AS avg_completion_rate
FROM units""",
    "top_played": f"""{FOR_STATS}
SELECT spotify_track_uri, coalesce(track_name, '') AS track_name,
       coalesce(artist_name, '') AS artist_name, play_count, full_listen_count, skip_count,
       ((CAST(round(completion_rate * 10000) AS BIGINT) + 5) // 10) / 1000.0 AS completion_rate
FROM stats ORDER BY play_count DESC, spotify_track_uri LIMIT 10""",
    "most_skipped": f"""{FOR_STATS}, shown AS (
  SELECT * EXCLUDE (skip_rate),
         ((CAST(round(skip_rate * 10000) AS BIGINT) + 5) // 10) / 1000.0 AS skip_rate
  FROM stats WHERE play_count >= 5)
SELECT spotify_track_uri, coalesce(track_name, '') AS track_name,
       coalesce(artist_name, '') AS artist_name, play_count, skip_count, skip_rate
FROM shown ORDER BY skip_rate DESC NULLS LAST, skip_count DESC, spotify_track_uri LIMIT 10""",
    "by_hour_dow": f"""{FOR_PLAYS}, slots AS (
  SELECT isodow(played_at) - 1 AS weekday, hour(played_at) AS hour, count(*) AS play_count,
         count(*) FILTER (play_quality = 'skip') AS skip_count,
         count(*) FILTER (play_quality IN ('full_listen', 'skip', 'partial')) AS decisive
  FROM plays GROUP BY 1, 2)
SELECT weekday, hour, play_count, skip_count,
       CASE WHEN decisive > 0 THEN {half_up("skip_count", "decisive", 4)} END AS skip_rate
FROM slots""",
    "monthly_most_played": f"""{MONTHLY} SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY play_count DESC, spotify_track_uri)
    AS rank FROM rates) WHERE rank <= 10""",
    "monthly_most_skipped": f"""{MONTHLY} SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY month
    ORDER BY skip_rate DESC, skip_count DESC, spotify_track_uri) AS rank
  FROM rates WHERE skip_count > 0) WHERE rank <= 10""",
    "breakdown_by_reason": f"""{_with(EVENTS)} SELECT reason_start, reason_end, count(*) AS n,
       CAST(sum(ms_played) AS BIGINT) AS total_ms_played FROM history GROUP BY 1, 2""",
    "breakdown_by_device": f"""{_with(EVENTS)} SELECT platform, shuffle, offline, count(*) AS n,
       CAST(sum(ms_played) AS BIGINT) AS total_ms_played FROM history GROUP BY 1, 2, 3""",
    "daily_anomalies": f"""{FOR_PLAYS}, daily AS (
  SELECT CAST(played_at AS DATE) AS day, count(*) AS play_count FROM plays GROUP BY 1),
rolled AS (
  SELECT *, count(*) OVER w AS k, CAST(sum(play_count) OVER w AS BIGINT) AS s,
         CAST(sum(play_count * play_count) OVER w AS BIGINT) AS q
  FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
scored AS (
  SELECT day, play_count, CASE WHEN k > 1 AND k * q > s * s
    THEN round((play_count - s / k) / sqrt((k * q - s * s) / (k * (k - 1))), 6) END AS z_score
  FROM rolled)
SELECT CAST(day AS VARCHAR) AS day, play_count, z_score, abs(z_score) >= 2 AS unusual
FROM scored""",
    "uris_union": f"{_with(EVENTS, URIS)} SELECT uri FROM uris",
    "new_uris": f"""{_with(EVENTS, TRACKS, URIS)} SELECT uri FROM uris
WHERE uri NOT IN (SELECT source_uri FROM payload)""",
    "uris_to_enrich": f"""{_with(EVENTS, TRACKS, URIS)} SELECT uri, track_id FROM found
WHERE uri NOT IN (SELECT source_uri FROM payload) AND track_id IS NOT NULL""",
    "uris_to_enrich_capped": f"""{_with(EVENTS, TRACKS, URIS)} SELECT uri, track_id FROM found
WHERE uri NOT IN (SELECT source_uri FROM payload) AND track_id IS NOT NULL""",
    "track_id_extract": f"""{_with(EVENTS, URIS)} SELECT uri, track_id FROM found
WHERE track_id IS NOT NULL""",
    "track_id_rejects": f"{_with(EVENTS, URIS)} SELECT uri FROM found WHERE track_id IS NULL",
    "build_track_data": TRACK_ROWS,
    "track_data_rejects": f"""{_with(TRACKS)} SELECT source_uri AS uri, p_name AS name
FROM payload WHERE duration_ms IS NULL""",
    "artists_widen": f"{_with(TRACKS)} SELECT source_uri, {WIDE} FROM payload",
    "artists_needed": f"""{_with(TRACKS)} SELECT max(n_artists) AS widest,
       max(n_artists) AS columns FROM payload""",
    "unique_tracks": f"""{_with(TRACKS)} SELECT source_uri, track_name,
       CAST(duration_ms AS BIGINT) AS duration_ms FROM payload""",
    "sync_tags": MAPPING,
    "tags_per_playlist": f"""{FOR_TAGS} SELECT n.playlist_id, n.name, tag_id,
       count(spotify_track_uri) AS track_count
FROM named n JOIN tags USING (tag) LEFT JOIN tracks USING (playlist_id) GROUP BY 1, 2, 3""",
    "unmatched_playlists": f"""{FOR_TAGS} SELECT playlist_id, name FROM named
WHERE tag NOT IN (SELECT tag FROM tags)""",
    "unmatched_tags": f"""{FOR_TAGS} SELECT tag FROM tags
WHERE tag NOT IN (SELECT tag FROM named) ORDER BY tag""",
    "tag_query_not": _tag_query(f"NOT {_having('red')} AND NOT {_having('ring')}"),
    "tag_query_and": _tag_query(f"{_having('blue')} AND {_having('widget')}"),
    "tag_query_or": _tag_query(f"{_having('blue')} OR {_having('standard')}"),
    "tag_query_repeated": _tag_query(_having("blue")),
    "tag_query_mixed": _tag_query(
        f"({_having('small')} OR {_having('large')}) AND {_having('gear')}"
        f" AND NOT {_having('standard')}"
    ),
    "generated_playlist": f"""{FOR_TAGS} SELECT 7 AS playlist_id,
       'temperature' AS playlist_name, spotify_track_uri FROM tagged
WHERE ({_having("hot")} OR {_having("cold")}) AND NOT {_having("anvil")}""",
    "tags_per_axis": f"""{FOR_TAGS} SELECT spotify_track_uri, axis, count(*) AS tag_count
FROM mapping JOIN tags USING (tag_id) JOIN axes USING (axis_id) GROUP BY 1, 2""",
    "axis_conflicts": f"""{FOR_TAGS} SELECT spotify_track_uri, axis, count(*) AS tag_count
FROM mapping JOIN tags USING (tag_id) JOIN axes USING (axis_id) GROUP BY 1, 2
HAVING count(*) > 1""",
    "clean_rows": f"""{_with(EVENTS)} SELECT DISTINCT ts, ms_played, spotify_track_uri,
       reason_end FROM history""",
    "normalize_columns": f"{UNTIDY} SELECT *, CAST(NULL AS VARCHAR) AS never_set FROM twice",
    "drop_empty_columns": f"{UNTIDY} SELECT * FROM twice",
    "ingest_history_files": f"""{_with(EVENTS)} SELECT DISTINCT {DEVICE}, shuffle, offline,
       platform FROM history""",
    "scan_history_files": f"{_with(EVENTS)} SELECT {DEVICE}, platform FROM history",
    "ingest_recent_pages": STORED_RECENT,
    "recent_calls": """WITH pages AS (
  SELECT event_id // 40 AS page FROM events UNION
  SELECT event_id // 40 - 1 FROM events WHERE event_id % 40 < 10)
SELECT page AS before_ts, CASE WHEN page % 2 = 0 THEN page + 1 ELSE 0 END AS after_ts
FROM pages""",
    "stored_calls": """WITH pages AS (
  SELECT event_id // 40 AS page FROM events UNION
  SELECT event_id // 40 - 1 FROM events WHERE event_id % 40 < 10)
SELECT page AS before_ts, CASE WHEN page % 2 = 0 THEN page + 1 ELSE 0 END AS after_ts
FROM pages""",
    "stored_rejects": f"""{_with(TRACKS)} SELECT source_uri AS uri, p_name AS name
FROM payload WHERE duration_ms IS NULL""",
    "ingest_history_ragged": f"""{_with(EVENTS)} SELECT DISTINCT {DEVICE}, platform,
       CASE WHEN event_id % 2 = 0 THEN 'x' || CAST(event_id % 3 AS VARCHAR) END AS extra_col
FROM history""",
    "ingest_track_payloads": TRACK_ROWS,
    "sync_tags_pages": MAPPING,
    "pipeline_track_stats": TRACK_STATS,
    "stream_recent": STORED_RECENT,
    "stream_recent_exact": STORED_RECENT,
    "stream_classify": CLASSIFIED_RECENT,
    "stream_overlap": STREAM_OVERLAP,
    "stream_overlap_bounded": STREAM_OVERLAP,
    "stream_sessions": _sessions("raw_recent", "user_id", 21600),
    "stream_classify_shuffled": CLASSIFIED_RECENT,
    "stream_classify_shuffled_per_user": CLASSIFIED_PER_USER,
    "stream_recent_two_tiers": STORED_RECENT,
    "stream_sessions_closed": f"""SELECT s.* FROM ({_sessions("raw_recent", "user_id", 21600)}) s
WHERE CAST(session_end AS TIMESTAMP) + to_hours(6) <= (
  SELECT max(CAST(session_end AS TIMESTAMP)) - to_hours(1) FROM ({_sessions("raw_recent", "user_id", 21600)}))""",
    "stream_overlap_streams": STREAM_OVERLAP,
    "stream_overlap_by_day": STREAM_OVERLAP,
}


def _count(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql}))"


_FOUND = f"{_with(EVENTS)}, {URIS} SELECT uri FROM found WHERE track_id IS NOT NULL"
_CLEANED = f"""{FOR_PLAYS}, cleaned AS (
  SELECT DISTINCT ts, ms_played, spotify_track_uri, reason_start, reason_end, shuffle, offline, platform
  FROM hist_event) SELECT * FROM cleaned"""
_COUNTS = {
    ("ingest_history", "read"): "(SELECT count(*) FROM events)",
    ("ingest_history", "written"): _count(ORACLE["ingest_history_files"]),
    ("ingest_recent", "pages"): _count(ORACLE["recent_calls"]),
    ("ingest_recent", "plays"): "(SELECT count(*) + count(*) FILTER (event_id % 40 < 10) FROM events)",
    ("ingest_recent", "added"): _count(STORED_RECENT),
    ("uris_to_enrich", "uris"): _count(_FOUND),
    ("ingest_tracks", "usable"): _count(ORACLE["ingest_track_payloads"]),
    ("ingest_tracks", "added"): _count(ORACLE["ingest_track_payloads"]),
    ("ingest_tracks", "rejected"): _count(ORACLE["stored_rejects"]),
    ("uris_left", "uris"): _count(ORACLE["uris_to_enrich"]),
    ("rebuild_plays", "extended_history"): _count(_CLEANED),
    ("rebuild_plays", "recently_played"): _count(f"{FOR_PLAYS} SELECT * FROM kept"),
    ("rebuild_track_stats", "tracks"): _count(TRACK_STATS),
    ("rebuild_tag_mapping", "mapped"): _count(MAPPING),
    ("rebuild_tag_mapping", "playlists"): _count(ORACLE["tags_per_playlist"]),
    ("rebuild_tag_mapping", "unmatched_playlists"): _count(ORACLE["unmatched_playlists"]),
    ("rebuild_tag_mapping", "unmatched_tags"): _count(ORACLE["unmatched_tags"]),
}
ORACLE["run_ledger"] = " UNION ALL ".join(
    f"SELECT '{step}' AS step, 'night' AS run, '{name}' AS name, {sql} AS rows" for (step, name), sql in _COUNTS.items()
)
ORACLE["stream_calls"] = f"""SELECT before_ts, after_ts, NULL AS name, NULL AS rows FROM ({ORACLE["recent_calls"]})
UNION ALL SELECT NULL, NULL, 'pages', {_count(ORACLE["recent_calls"])}
UNION ALL SELECT NULL, NULL, 'added', {_count(STORED_RECENT)}"""
ORACLE["rebuild_after_one_day"] = TRACK_STATS
ORACLE["plays_after_one_day"] = ORACLE["plays"]
ORACLE["plays_looked_up"] = f"""SELECT * FROM ({ORACLE["plays"]}) WHERE spotify_track_uri = 'spotify:track:100'
UNION ALL SELECT * FROM ({ORACLE["plays"]}) WHERE played_at BETWEEN '2024-02-10 08:00:00' AND '2024-02-10 08:59:59'"""
# A track has far fewer days than a sketch has cells: the estimates are exact then.
ORACLE["quarter_from_sketches"] = f"""SELECT spotify_track_uri, count(*) AS plays,
       count(DISTINCT substr(played_at, 1, 10)) AS days_played
FROM ({ORACLE["plays"]}) WHERE substr(played_at, 1, 7) BETWEEN '2024-01' AND '2024-03' GROUP BY 1"""
ORACLE["monthly_top_from_states"] = f"SELECT month, rank, spotify_track_uri, play_count FROM ({ORACLE['monthly_most_played']})"
ORACLE["top_from_states"] = f"""SELECT row_number() OVER (ORDER BY play_count DESC, spotify_track_uri) AS rank,
       spotify_track_uri, play_count FROM ({ORACLE["top_played"]})"""
ORACLE["stored_playlist_tables"] = f"""SELECT 1 AS playlist_id, playlist_name, spotify_track_uri
FROM ({ORACLE["generated_playlist"]})
UNION ALL SELECT 2, 'blue widgets', spotify_track_uri FROM ({ORACLE["tag_query_and"]})"""
ORACLE["ingest_history_replaced"] = ORACLE["ingest_history_files"].replace("SELECT DISTINCT ts", "SELECT ts")
ORACLE["refused_loads"] = f"""SELECT load, outcome, {_count(ORACLE["ingest_history_files"])} AS n_rows FROM (VALUES
  ('no folder', 'NotADirectoryError'), ('a file', 'NotADirectoryError'), ('table there', 'AnalysisException')) AS v(load, outcome)"""
ORACLE["artist_column_count"] = f"""{_with(TRACKS)} SELECT CAST(max(n_artists) AS BIGINT) AS needed,
       CAST(max(n_artists) AS BIGINT) AS columns FROM payload"""
ORACLE["calls_made_now"] = f"SELECT count(*) AS n, count(*) AS n_now FROM ({ORACLE['recent_calls']})"
