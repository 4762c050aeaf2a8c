"""Trade listings: filters, keyset pages and a fully paged listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.ranking import global_position

ORDER = ("ts", "trade_id")


def filtered_trades(
    trades: DataFrame, ticker: str | None = None, min_ts: int | None = None, max_ts: int | None = None
) -> DataFrame:
    """Predicates are built only from the arguments given, and reach the scan."""
    if ticker is not None:
        trades = trades.where(F.col("ticker") == ticker)
    if min_ts is not None:
        trades = trades.where(F.col("ts") >= min_ts)
    if max_ts is not None:
        trades = trades.where(F.col("ts") <= max_ts)
    return trades


def trades_page(
    trades: DataFrame,
    limit: int | None = None,
    cursor: tuple[int, int] | None = None,
    ticker: str | None = None,
    min_ts: int | None = None,
    max_ts: int | None = None,
) -> DataFrame:
    """One page in (ts, trade_id) order after ``cursor``, the last pair of the page before.

    Planned as a top-n: every task keeps ``limit`` rows, nothing is fully sorted.
    """
    rows = filtered_trades(trades, ticker, min_ts, max_ts)
    if cursor is not None:
        ts, trade_id = cursor
        # The first test alone is a plain bound, so it prunes files by their statistics.
        rows = rows.where((F.col("ts") >= ts) & ((F.col("ts") > ts) | (F.col("trade_id") > trade_id)))
    rows = rows.orderBy(*ORDER)
    return rows if limit is None else rows.limit(limit)


def page_cursor(page: DataFrame) -> tuple[int, int] | None:
    """Cursor of the page after this one: the largest (ts, trade_id), or None for an empty page."""
    last = page.agg(F.max(F.struct(*ORDER)).alias("c")).first()["c"]
    return None if last is None else (last["ts"], last["trade_id"])


def paged_listing(trades: DataFrame, limit: int, **filters) -> DataFrame:
    """Every matching trade with its page number (from 0) and place in the page, in one distributed pass."""
    placed = global_position(filtered_trades(trades, **filters), ORDER, "_pos")
    return placed.select(
        *trades.columns,
        F.floor(F.col("_pos") / limit).alias("page"),
        (F.col("_pos") % limit).cast("int").alias("place"),
    )
