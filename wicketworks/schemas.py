"""Explicit schemas of the raw tables (no inference pass).

Columns that may hold the '-' sentinel are strings.
"""

from __future__ import annotations

# Column order of the delivery files.
DELIVERIES = (
    "match_id BIGINT, season STRING, start_date STRING, venue STRING, innings INT, ball DOUBLE, "
    "batting_team STRING, bowling_team STRING, striker STRING, non_striker STRING, bowler STRING, "
    "runs_off_bat INT, extras INT, wides INT, noballs STRING, byes INT, legbyes INT, penalty STRING, "
    "wicket_type STRING, player_dismissed STRING, other_wicket_type STRING, other_player_dismissed STRING"
)

# The five positions of a match info line.
INFO_LINE = "type STRING, attribute STRING, value STRING, player STRING, code STRING"

MATCHES = "match_id BIGINT, team1 STRING, team2 STRING, gender STRING, season STRING, winner STRING"

# Columns each raw statistics table must have.
BATTING_REQUIRED = ["Player", "Season", "Mat", "Inns", "Runs", "SR", "Ave"]
BOWLING_REQUIRED = ["Player", "Season", "Mat", "Inns", "Overs", "Runs", "Wkts", "Econ"]
FIELDING_REQUIRED = ["Player", "Mat", "Inns", "Dis", "Ct", "St", "D/I", "Season"]
TEAM_REQUIRED = ["Team", "Season", "Mat", "Won", "Lost", "Tied", "NR", "Ave", "RPO"]
DELIVERIES_REQUIRED = [
    "match_id", "innings", "ball", "batting_team", "bowling_team", "striker", "bowler",
    "runs_off_bat", "extras",
]
