"""Incremental extraction by per-state bookmark, and the load-mode rule.

A bookmark is one row per state: ``(state, last_date)``, the last date
already extracted. A run for ``until`` selects, in one job over all states,
the rows of the month of ``until`` after each state's bookmark (from the
first day of the month when a state has no bookmark or a null one) up to
``until``; the next bookmarks are the per-state maxima of what was read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaxmart.functions.temporal import load_mode, load_mode_for  # noqa: F401  (re-exported)

if TYPE_CHECKING:
    from vaxmart.sources.versions import VersionedTable

BOOKMARK_STATE = "state"
BOOKMARK_DATE = "last_date"
BOOKMARK_SCHEMA = T.StructType(
    [
        T.StructField(BOOKMARK_STATE, T.StringType(), True),
        T.StructField(BOOKMARK_DATE, T.DateType(), True),
        T.StructField("run_until", T.StringType(), True),
    ]
)


def _date(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date")


def incremental_extract(
    source: DataFrame,
    until: dt.date | str,
    bookmarks: DataFrame | None = None,
    state_col: str = "state",
    date_col: str = "date",
    states: Sequence[str] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows of the month of ``until`` that are newer than their state's bookmark.

    ``inclusive=True`` re-reads the bookmark day itself. The bookmark table
    has one row per state, so its join adds no rows; AQE broadcasts it when
    its measured size allows.
    """
    until_d = F.lit(until).cast("date")
    day = _date(date_col)
    rows = source.where((day >= F.trunc(until_d, "month")) & (day <= until_d))
    if states is not None:
        rows = rows.where(F.col(state_col).isin(list(states)))
    if bookmarks is None:
        return rows
    bm = bookmarks.select(F.col(BOOKMARK_STATE).alias("_bm_state"), F.col(BOOKMARK_DATE).cast("date").alias("_bm"))
    joined = rows.join(bm, rows[state_col] == bm["_bm_state"], "left")
    newer = (day >= F.col("_bm")) if inclusive else (day > F.col("_bm"))
    return joined.where(F.col("_bm").isNull() | newer).select(*source.columns)


def next_bookmarks(
    extracted: DataFrame,
    previous: DataFrame | None = None,
    state_col: str = "state",
    date_col: str = "date",
) -> DataFrame:
    """One row per state: the latest extracted date, else the previous bookmark."""
    new = extracted.groupBy(F.col(state_col).alias(BOOKMARK_STATE)).agg(
        F.max(_date(date_col)).alias("_new")
    )
    if previous is None:
        return new.select(BOOKMARK_STATE, F.col("_new").alias(BOOKMARK_DATE))
    prev = previous.select(BOOKMARK_STATE, F.col(BOOKMARK_DATE).cast("date").alias("_old"))
    return new.join(prev, BOOKMARK_STATE, "full").select(
        BOOKMARK_STATE, F.greatest("_new", "_old").alias(BOOKMARK_DATE)
    )


def parse_bookmark(text: str | None) -> tuple[str, dt.date | None] | None:
    """``"SC|2021-07-18"`` -> ("SC", date); ``None`` -> None (start of month)."""
    if not text:
        return None
    state, _, day = text.partition("|")
    return state, (dt.date.fromisoformat(day) if day else None)


def format_bookmark(state: str, day: dt.date | None) -> str:
    return f"{state}|{day.isoformat() if day else ''}"


# --- the daily extract job: source -> landing files -> bookmarks ---------------

BOOKMARK_RUN = "run_until"


def latest_bookmarks(spark, bookmark_path: str, until: dt.date | str, before: bool = False) -> DataFrame:
    """Bookmarks of the latest run on or before ``until`` (no rows if none).

    With ``before``, of the latest run before it: a run repeated for the same
    day then extracts the same days again and replaces its own output.

    The bookmark table is partitioned by run date; the latest run is picked
    with a scalar subquery, so nothing is collected to the driver.
    """
    from vaxmart.sources.tables import ensure_table

    table = ensure_table(spark, bookmark_path, BOOKMARK_SCHEMA, partition_by=[BOOKMARK_RUN])
    earlier = table.where(F.col(BOOKMARK_RUN) < F.lit(str(until)) if before else F.col(BOOKMARK_RUN) <= F.lit(str(until)))
    latest = earlier.select(F.max(BOOKMARK_RUN)).scalar()
    return earlier.where(F.col(BOOKMARK_RUN) == latest).select(BOOKMARK_STATE, BOOKMARK_DATE)


def _land_version(landing: VersionedTable, rows: DataFrame, until: dt.date, mode: str, states: Sequence[str] | None) -> None:
    month_col, state_col = landing.partition_by
    month = {month_col: f"{until:%Y-%m}-01"}
    with landing.transaction(label=f"run_until={until}") as tx:
        if mode == "append":
            tx.append(rows, folder=month)
        else:
            tx.replace(rows, [month] if states is None else [{**month, state_col: s} for s in states], folder=month)


def extract_to_landing(
    spark,
    source: DataFrame,
    landing_base: str,
    bookmark_path: str,
    until: dt.date,
    states: Sequence[str] | None = None,
    state_col: str = "estabelecimento_uf",
    date_col: str = "vacina_dataAplicacao",
    inclusive: bool = False,
    landing: VersionedTable | None = None,
) -> str:
    """One daily extraction run for all states; returns the load mode used.

    On the last day of a month the whole month is extracted again and the
    month's landing files of every state are replaced (bookmarks ignored);
    otherwise the rows after each state's bookmark are appended. Files go
    under the month of ``until``, in a folder of the run, so a run that is
    repeated replaces what it landed before. The new bookmarks are written
    only after the landing write has committed.

    With ``landing``, a versioned table of landing files, the run is one
    commit of it instead (``landing_base`` is not used): a replace that fails
    leaves the old files to the readers, and a run whose commit was made is
    not landed again when it is repeated.
    """
    from vaxmart.sources.tables import land_run

    mode = load_mode_for(until)
    previous = None if mode == "replace" else latest_bookmarks(spark, bookmark_path, until, before=True)
    # The run's rows (a day, or a month on replace) feed two writes; persist
    # them so the source is read once (a lost executor recomputes its part).
    rows = incremental_extract(source, until, previous, state_col, date_col, states, inclusive).persist()
    try:
        if landing is None:
            land_run(rows, landing_base, until, mode, states)
        else:
            _land_version(landing, rows, until, mode, states)
        nxt = next_bookmarks(rows, previous, state_col, date_col).withColumn(BOOKMARK_RUN, F.lit(str(until)))
        (
            nxt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BOOKMARK_RUN)
            .parquet(bookmark_path)
        )
    finally:
        rows.unpersist()
    return mode
