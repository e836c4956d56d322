"""Raw landing: match files out of archives, statistics tables out of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketworks.session import materialize
from wicketworks.sources.archives import unpack_archives
from wicketworks.sources.html_tables import before_first_empty_page, extract_tables, scraped_rows, table_columns
from wicketworks.sources.tables import not_landed

# Order in which the statistics of a player page are taken.
PLAYER_TYPES = ["batting", "bowling", "fielding"]
# Columns of each statistics table that later steps read.
PAGE_COLUMNS = {
    "batting": ["Player", "Season", "Mat", "Inns", "Runs", "SR", "Ave"],
    "bowling": ["Player", "Season", "Mat", "Inns", "Overs", "Mdns", "Runs", "Wkts", "Econ"],
    "fielding": ["Player", "Season", "Mat", "Inns", "Dis", "Ct", "St", "D/I"],
    "team": ["Team", "Season", "Mat", "Won", "Lost", "Tied", "NR", "Ave", "RPO", "LS"],
}


def new_match_files(archives: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """(file_name, text) of the CSV members that have not been landed yet."""
    members = unpack_archives(archives).select("file_name", "text")
    return members if landed is None else not_landed(members, landed)


def player_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """Batting, bowling and fielding tables from (page, stat_type, html)."""
    rows = scraped_rows(_extracted(pages), PLAYER_TYPES)
    return {kind: _typed(rows, kind) for kind in PLAYER_TYPES}


def team_table(pages: DataFrame) -> DataFrame:
    """The team table from (page, stat_type, html), up to the first page without data."""
    return _typed(before_first_empty_page(_extracted(pages)), "team")


def _extracted(pages: DataFrame) -> DataFrame:
    """Rows of all pages, written once: the stopping rules read them again, the pages are not parsed twice."""
    return materialize(extract_tables(pages), "page-rows")


def _typed(rows: DataFrame, kind: str, columns: Sequence[str] | None = None) -> DataFrame:
    wanted = table_columns(rows.where(F.col("stat_type") == kind), columns or PAGE_COLUMNS[kind])
    return wanted.drop("page", "stat_type", "row_no")
