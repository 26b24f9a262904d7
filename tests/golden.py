"""Hand-checked plays: every branch and boundary of the classification."""

from datetime import datetime
from decimal import Decimal

A, B, L, N, Z = (f"spotify:track:{x}" for x in "ABLNZ")
URIS = {"A": A, "B": B, "L": L, "N": N, "Z": Z, "": "", None: None}

TRACKS = [
    (A, "Song A", 200000, [("Art A", "a:A")]),
    (B, "Song B", 100000, [("Art B", "a:B")]),
    (Z, "Song Z", 0, [("Art Z", "a:Z")]),
    (L, "Long", 400000, [("Art L", "a:L")]),
]
TRACK_SCHEMA = (
    "source_uri string, track_name string, duration_ms bigint, "
    "artists array<struct<name:string,uri:string>>"
)

# ts, ms_played, track, reason_start, reason_end, then the expected play or None:
# local time, percentage, quality
HISTORY = [
    ("2024-03-10T06:59:00Z", 5000, "A", "clickrow", "trackdone", ("2024-03-10 01:59:00", "0.0250", "full_listen")),
    ("2024-03-10T07:01:00Z", 199000, "A", "clickrow", "fwdbtn", ("2024-03-10 03:01:00", "0.9950", "skip")),
    ("2024-01-02T03:00:00Z", 39999, "A", "x", "backbtn", ("2024-01-01 22:00:00", "0.2000", "skip")),
    ("2024-01-02T04:00:00Z", 40000, "A", "x", "backbtn", ("2024-01-01 23:00:00", "0.2000", "full_listen")),
    ("2024-01-02T05:00:00Z", 40000, "N", "x", "backbtn", ("2024-01-02 00:00:00", None, "partial")),
    ("2024-01-03T00:00:00Z", 10, "A", "x", "remote", ("2024-01-02 19:00:00", "0.0001", "natural_end")),
    ("2024-01-03T01:00:00Z", 10, "A", "x", "trackerror", ("2024-01-02 20:00:00", "0.0001", "natural_end")),
    ("2024-01-04T00:00:00Z", 80000, "B", None, None, ("2024-01-03 19:00:00", "0.8000", "full_listen")),
    ("2024-01-04T01:00:00Z", 14999, "B", "x", "unknown", ("2024-01-03 20:00:00", "0.1500", "skip")),
    ("2024-01-04T02:00:00Z", 15000, "B", "x", "unknown", ("2024-01-03 21:00:00", "0.1500", "partial")),
    ("2024-01-04T03:00:00Z", 0, "B", None, "unknown", None),
    ("2024-01-04T04:00:00Z", 0, "B", "clickrow", None, ("2024-01-03 23:00:00", "0.0000", "skip")),
    ("2024-01-04T05:00:00Z", None, "B", None, None, None),
    ("2024-01-04T06:00:00Z", None, "B", "x", "trackdone", ("2024-01-04 01:00:00", None, "full_listen")),
    ("2024-01-04T07:00:00Z", 500000, "Z", "x", None, ("2024-01-04 02:00:00", None, "partial")),
    ("2024-01-04T08:00:00Z", 5, "", "x", "trackdone", None),
    ("2024-01-04T09:00:00Z", 5, None, "x", "trackdone", None),
    ("2024-11-03T05:30:00Z", 120000, "B", "x", "endplay", ("2024-11-03 01:30:00", "1.0000", "natural_end")),
    ("2024-11-03T06:30:00Z", 33333, "B", "x", "logout", ("2024-11-03 01:30:00", "0.3333", "natural_end")),
    ("2024-06-01T14:01:54Z", 14000, "B", "x", "fwdbtn", ("2024-06-01 10:01:54", "0.1400", "skip")),
    ("2024-06-01T14:04:10Z", 14000, "B", "x", "fwdbtn", ("2024-06-01 10:04:10", "0.1400", "skip")),
]

# track, local time on 2024-06-01, gap, then ms, percentage, quality, and whether it survives
# the overlap check
RECENT = [
    ("A", "10:00:00", 160, 160000, "0.8000", "full_listen", True),
    ("B", "10:02:40", 14, 14000, "0.1400", "skip", False),
    ("B", "10:02:54", 15, 15000, "0.1500", "partial", False),
    ("B", "10:03:09", 80, 80000, "0.8000", "full_listen", True),
    ("L", "10:04:29", 360, None, "0.9000", "natural_end", True),
    ("N", "10:10:29", 31, None, None, None, True),
    ("Z", "10:11:00", 60, None, None, None, True),
    ("A", "10:12:00", 300, 200000, "1.0000", "full_listen", True),
    ("A", "10:17:00", 301, None, "1.0000", "natural_end", True),
    ("A", "10:22:01", 119, 119000, "0.5950", "partial", True),
    ("B", "10:24:00", None, None, None, None, True),
]


def at(text):
    return datetime.fromisoformat(text)


def dec(text):
    return None if text is None else Decimal(text)


def tracks(spark):
    return spark.createDataFrame(TRACKS, TRACK_SCHEMA)


def history(spark):
    data = [(ts, ms, URIS[t], start, end) for ts, ms, t, start, end, _ in HISTORY]
    return spark.createDataFrame(
        data,
        "ts string, ms_played bigint, spotify_track_uri string, reason_start string, "
        "reason_end string",
    )


def recent(spark):
    data = [(f"name {t}", at(f"2024-06-01 {time}"), URIS[t]) for t, time, *_ in RECENT]
    return spark.createDataFrame(
        data, "track_name string, played_at timestamp_ntz, spotify_track_uri string"
    )


def expected_history():
    return [
        (URIS[t], at(e[0]), ms, dec(e[1]), e[2], e[2] == "skip", "extended_history")
        for _, ms, t, _, _, e in HISTORY
        if e
    ]


def expected_recent(only_kept):
    return [
        (URIS[t], at(f"2024-06-01 {time}"), ms, dec(pct), q, None if q is None else q == "skip",
         "recently_played")
        for t, time, _, ms, pct, q, kept in RECENT
        if kept or not only_kept
    ]
