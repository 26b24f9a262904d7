"""Table schemas (as DDL strings) and the fixed values every job shares."""

from __future__ import annotations

from dataclasses import dataclass

# Identifiers and labels that must equal the data's own.
TRACK_URI_PREFIX = "spotify:track:"
TRACK_ID_PATTERN = r"(?:spotify:track:|https?://open\.spotify\.com/track/)([A-Za-z0-9_-]+)"
HOME_TIMEZONE = "America/New_York"
SOURCE_HISTORY = "extended_history"
SOURCE_RECENT = "recently_played"
FULL_LISTEN, NATURAL_END, PARTIAL, SKIP = "full_listen", "natural_end", "partial", "skip"
STOP_REASONS = (
    "endplay",
    "logout",
    "unexpected-exit",
    "unexpected-exit-while-paused",
    "remote",
    "trackerror",
)
MIN_PLAYS_FOR_SKIP_REPORT = 5
REPORT_ROWS = 10
AXES = ("Energy", "Mood", "Genre", "Context", "Production", "Language", "Period", "General")


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the play classification."""

    full_listen: float = 0.8
    skip: float = 0.15
    back_button: float = 0.2
    session_gap_seconds: int = 300
    overlap_seconds: int = 60


# Columns that an export file declares, with their types. Files may carry more.
HISTORY = """
    ts string, username string, platform string, ms_played bigint, conn_country string,
    ip_addr string, ip_addr_decrypted string, user_agent_decrypted string,
    master_metadata_track_name string, master_metadata_album_artist_name string,
    master_metadata_album_album_name string, spotify_track_uri string,
    episode_name string, episode_show_name string, spotify_episode_uri string,
    audiobook_title string, audiobook_uri string,
    audiobook_chapter_uri string, audiobook_chapter_title string,
    reason_start string, reason_end string, shuffle boolean, skipped boolean,
    offline boolean, offline_timestamp bigint, incognito_mode boolean
"""

RECENT_PAGE = """
    cursors struct<before:string,after:string>,
    items array<struct<played_at:string,track:struct<name:string,uri:string>>>
"""
RECENT = "track_name string, played_at timestamp_ntz, spotify_track_uri string"
RECENT_CALLS = "before_ts bigint, after_ts bigint, call_made timestamp_ntz, page string, landed timestamp"

TRACK_PAYLOAD = """
    uri string, name string, duration_ms bigint, is_playable boolean, popularity int,
    album struct<name:string,release_date:string,release_date_precision:string,uri:string>,
    artists array<struct<name:string,uri:string>>, requested_uri string
"""
TRACK_DATA = """
    source_uri string, track_name string, duration_ms bigint, is_playable boolean,
    popularity int, album_name string, release_date string, release_date_precision string,
    album_uri string, artists array<struct<name:string,uri:string>>
"""

PLAYLIST_PAGE = "items array<struct<id:string,name:string>>"
PLAYLIST_ITEM_PAGE = """
    playlist_id string,
    items array<struct<item:struct<uri:string,type:string>,track:struct<uri:string,type:string>>>,
    next string
"""
AXIS_TABLE = "axis_id int, axis string, description string"
TAG_TABLE = "tag_id int, tag string, description string, axis_id int"
TAG_MAPPING = "tag_id int, spotify_track_uri string"
PLAYLISTS = (
    "playlist_id bigint, playlist_name string, spotify_playlist_uri string, tag_id int"
)
PLAYLIST_MAPPING = "playlist_id bigint, spotify_track_uri string"

PLAYS = """
    play_id bigint, spotify_track_uri string, played_at timestamp_ntz, ms_played bigint,
    play_percentage decimal(5,4), play_quality string, skipped boolean, source string
"""
TRACK_STATS = """
    spotify_track_uri string, track_name string, artist_name string, play_count bigint,
    unique_days_played bigint, full_listen_count bigint, natural_end_count bigint,
    partial_count bigint, skip_count bigint, unclassified_count bigint,
    avg_play_percentage decimal(5,4), total_ms_played bigint,
    total_minutes_played decimal(12,2), skip_rate decimal(5,4), completion_rate decimal(5,4),
    first_played_at timestamp_ntz, last_played_at timestamp_ntz, days_since_last int,
    peak_listen_month string, peak_month_play_count bigint
"""
PLAY_COLUMNS = [
    "spotify_track_uri",
    "played_at",
    "ms_played",
    "play_percentage",
    "play_quality",
    "skipped",
    "source",
]
