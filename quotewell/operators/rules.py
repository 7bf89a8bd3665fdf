"""Daily quality rules.

Rules return (trade_date, rule, n): how many rows (or ids, or securities) break
the rule on that day; with ``detail`` also per security, offenders only. All row
rules of a feed share one scan; nothing loops over days.

Inputs are feeds as ``sources.readers.normalize`` leaves them: one spelling of
the column names for every format, plus trade_date, ts and clock.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions import arrays
from quotewell.functions.numbers import blank_or_nan
from quotewell.functions.times import CONTINUOUS_SESSIONS, in_sessions
from quotewell.operators import bitmaps
from quotewell.operators.ordered import COPIES, with_previous
from quotewell.operators.relational import missing_from

DAY, SECURITY = "trade_date", "securityid"
# Highest accepted price, and the "no price" mark of an order.
MAX_PRICE = 99999999
NO_PRICE = -1.0
DEPTH = 10

SNAP_PRICES = ["preclosepx", "lastpx", "openpx", "highpx", "lowpx"]
COUNTERS = ["numtrades", "totalvolumetrade", "totalvaluetrade"]


def levels(stem: str, depth: int = DEPTH) -> list[str]:
    return [f"{stem}{i}" for i in range(1, depth + 1)]


# What the rules read of snapshots and books, where one file holds both.
SNAP_READ = [
    DAY, SECURITY, "ts", "clock", *SNAP_PRICES, *COUNTERS,
    *[c for stem in ("bidpx", "bidsize", "offerpx", "offersize") for c in levels(stem)],
]


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


# --- row conditions --------------------------------------------------------

def outside(names: Sequence[str], lo=0, hi=MAX_PRICE) -> Column:
    return arrays.any_of([(F.col(n) < lo) | (F.col(n) > hi) for n in names])


def negative(names: Sequence[str]) -> Column:
    return arrays.any_of([F.col(n) < 0 for n in names])


def bad_snapshot_price(hi=MAX_PRICE) -> Column:
    last = F.col("lastpx")
    return outside(SNAP_PRICES, 0, hi) | (F.col("highpx") < last) | (F.col("lowpx") > last)


def bad_order(hi=MAX_PRICE) -> Column:
    price, qty = F.col("price"), F.col("orderqty")
    return ((price < 0) | (price > hi) | (qty < 0)) & (price != NO_PRICE)


def bad_trade(executed: Column | None = None) -> Column:
    bad = (F.col("price") <= 0) | (F.col("tradeqty") <= 0)
    return bad if executed is None else executed & bad


def outside_limits() -> Column:
    last = F.col("lastpx")
    return (last != 0) & ((last > F.col("uplimitpx")) | (last < F.col("downlimitpx")))


def outside_high_low() -> Column:
    last, high, low = F.col("lastpx"), F.col("highpx"), F.col("lowpx")
    return (last > high) | (last < low) | (high < low)


def level_without_quantity(depth: int = DEPTH) -> Column:
    return arrays.price_without_quantity(
        _cols(levels("bidpx", depth) + levels("offerpx", depth)),
        _cols(levels("bidsize", depth) + levels("offersize", depth)),
    )


def level_without_price(depth: int = DEPTH) -> Column:
    return arrays.quantity_without_price(
        _cols(levels("bidpx", depth) + levels("offerpx", depth)),
        _cols(levels("bidsize", depth) + levels("offersize", depth)),
    )


def book_out_of_order(depth: int = DEPTH) -> Column:
    return arrays.book_out_of_order(
        _cols(reversed(levels("bidpx", depth))), _cols(levels("offerpx", depth))
    )


def executed(fmt: str) -> Column | None:
    """Which trade rows count as executed: a code in the new and old formats,
    every row in the SH format."""
    if fmt == "sh":
        return None
    return F.trim(F.col("exectype")) == ("F" if fmt == "new" else "0")


def row_rules(feed: str, fmt: str = "new") -> dict[str, Column]:
    """The row conditions of a feed, by rule name."""
    trading = in_sessions(F.col("clock"), CONTINUOUS_SESSIONS)
    if feed == "snap":
        price = bad_snapshot_price()
        if fmt != "new":
            price = price | negative(COUNTERS)
        if fmt == "old":
            price = trading & price
        rules = {"snap_price_range": price, "snap_negative_totals": negative(COUNTERS),
                 "snap_outside_high_low": outside_high_low()}
        if fmt == "new":
            rules["snap_outside_limits"] = outside_limits()
        return rules
    if feed == "snap_level":
        empty, order = level_without_quantity(), book_out_of_order()
        return {
            "level_price_without_qty": trading & empty if fmt == "new" else empty,
            "level_qty_without_price": level_without_price(),
            "level_order": order if fmt == "sh" else trading & order,
        }
    if feed == "order":
        return {"order_range": bad_order()}
    if feed == "trade":
        return {"trade_range": bad_trade(executed(fmt))}
    if feed == "index":
        totals = ["totalvaluetrade", "totalvolumetrade"] if fmt == "new" else ["numtrades", "totalvolumetrade"]
        return {"index_price_range": outside(SNAP_PRICES), "index_negative_totals": negative(totals)}
    raise ValueError(f"unknown feed {feed!r}")


# --- counting --------------------------------------------------------------

def _group(detail: bool) -> list[str]:
    return [DAY, SECURITY] if detail else [DAY]


def _finish(counts: DataFrame, detail: bool) -> DataFrame:
    out = counts.select(*_group(detail), "rule", F.col("n").cast("bigint").alias("n"))
    return out.where("n > 0") if detail else out


def count_rows(df: DataFrame, rules: Mapping[str, Column], detail: bool = False) -> DataFrame:
    """All row rules in one scan and one partial/final aggregation."""
    counted = df.groupBy(*_group(detail)).agg(*[
        F.count_if(bad).alias(name) for name, bad in rules.items()
    ])
    tall = counted.unpivot(_group(detail), list(rules), "rule", "n")
    return _finish(tall, detail)


def _scored_sets(
    df: DataFrame,
    order: Sequence[str],
    sets: Mapping[str, Mapping],
    keys: Sequence[str] = (DAY, SECURITY),
    keep: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Every distinct row with one column per entry of ``sets``: how many of its
    copies break that entry's ordering against the previous row of their key.
    All entries share one ordered pass. An entry may hold

    falls       column must not be below the previous value (a mapping gives
                the drop that is still tolerated)
    not_rising  column must be above the previous value
    rises       column must not be above the previous value
    nonzero     a zero in falls/rises columns is "no value", not a break
    mode        'any' or 'all' of the listed conditions
    """
    slack = {n: dict(c) if isinstance(c := s.get("falls", ()), Mapping) else dict.fromkeys(c, 0) for n, s in sets.items()}
    watched = list(dict.fromkeys(
        c for n, s in sets.items() for c in (*slack[n], *s.get("not_rising", ()), *s.get("rises", ()))
    ))
    columns = list(dict.fromkeys([*keys, *order, *watched, *keep]))
    ties = [c for c in columns if c not in keys and c not in order]
    # copies fold on the way: a repeated row then costs one row whatever its number
    prev = with_previous(df.select(*columns), list(keys), [*order, *ties], watched, "_prev_", ranges, fold=True)

    def against(c: str) -> Column:
        return F.col(f"_prev_{c}")

    def score(name: str) -> Column:
        own = sets[name]
        not_rising, rises = own.get("not_rising", ()), own.get("rises", ())
        nonzero, any_of = own.get("nonzero", False), own.get("mode", "any") == "any"
        tests = []
        for c, allowed in slack[name].items():
            hit = F.col(c) < against(c) if not allowed else (F.col(c) - against(c)) < -allowed
            tests.append(hit & (F.col(c) != 0) if nonzero else hit)
        tests += [F.col(c) <= against(c) for c in not_rising]
        for c in rises:
            hit = F.col(c) > against(c)
            tests.append(hit & (F.col(c) != 0) if nonzero else hit)
        first = F.coalesce(reduce((lambda a, b: a | b) if any_of else (lambda a, b: a & b), tests), F.lit(False))
        again = F.lit(0)
        # among identical rows only "must be above" can break
        if not_rising if any_of else not (slack[name] or rises):
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_rising])
            again = F.when(known, F.col(COPIES) - 1).otherwise(0)
        return F.when(first, 1).otherwise(0) + again

    return prev.withColumns({name: score(name) for name in sets}).drop(COPIES, *[f"_prev_{c}" for c in watched])


def _scored(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (DAY, SECURITY), keep: Sequence[str] = (),
            ranges: int | None = None, **conditions) -> DataFrame:
    """``_scored_sets`` for one set of conditions, in the column ``n``."""
    return _scored_sets(df, order, {"n": conditions}, keys, keep, ranges)


def breaks(df: DataFrame, order: Sequence[str], **conditions) -> DataFrame:
    """The distinct rows that break an ordering (conditions as in ``_scored``)."""
    return _scored(df, order, **conditions).where("n > 0")


def count_breaks(df: DataFrame, rule: str, order: Sequence[str], sessions=None,
                 detail: bool = False, **conditions) -> DataFrame:
    """Ordering breaks counted per day. ``sessions`` filters the offending rows,
    not the rows they are compared with. Days without a break report 0."""
    return count_break_sets(df, order, {rule: conditions | {"sessions": sessions}}, detail)


def count_break_sets(df: DataFrame, order: Sequence[str], sets: Mapping[str, Mapping], detail: bool = False) -> DataFrame:
    """Several ordering rules of one order in one pass: rule name -> conditions,
    with its ``sessions`` if it has any."""
    timed = {rule: s.get("sessions") for rule, s in sets.items()}
    rows = _scored_sets(df, order, sets, keep=["clock"] if any(timed.values()) else [])
    sums = [
        F.sum(F.when(in_sessions(F.col("clock"), timed[rule]), F.col(rule)).otherwise(0) if timed[rule] else F.col(rule)).alias(rule)
        for rule in sets
    ]
    counted = rows.groupBy(*_group(detail)).agg(*sums)
    return _finish(counted.unpivot(_group(detail), list(sets), "rule", "n"), detail)


def volume_summary(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct securities per day and feed."""
    parts = [
        df.groupBy(DAY).agg(
            F.countDistinct(SECURITY).alias("n_securities"), F.count("*").alias("n_rows")
        ).withColumn("feed", F.lit(name))
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, parts).select(DAY, "feed", "n_securities", "n_rows")


def sum_vs_total(trades: DataFrame, snaps: DataFrame, fmt: str = "new", mode: str = "any",
                 tolerance: float = 0.0, rule: str = "trade_sum_vs_total",
                 detail: bool = False) -> DataFrame:
    """Securities whose executed trades do not add up to the day's totals.
    Both sides are summed per security before they meet."""
    done = executed(fmt)
    t = trades if done is None else trades.where(done)
    # decimals add up the same in any order, so equal totals compare equal
    money = F.col("price").cast("decimal(20,6)") * F.col("tradeqty").cast("decimal(18,0)")
    sums = t.groupBy(DAY, SECURITY).agg(
        F.sum(F.col("tradeqty").cast("decimal(18,0)")).alias("qty"), F.sum(money).alias("money")
    )
    totals = snaps.groupBy(DAY, SECURITY).agg(
        F.max("totalvolumetrade").alias("tot_qty"), F.max("totalvaluetrade").alias("tot_money")
    )

    def off(a: str, b: str) -> Column:
        return F.abs(F.col(a).cast("decimal(38,6)") - F.col(b).cast("decimal(38,6)")) > F.lit(tolerance)

    qty, money = off("qty", "tot_qty"), off("money", "tot_money")
    bad = (qty | money) if mode == "any" else (qty & money)
    met = sums.join(totals, [DAY, SECURITY])
    return count_rows(met, {rule: bad}, detail)


def missing_reference(trades: DataFrame, orders: DataFrame, bid: str = "bidapplseqnum",
                      offer: str = "offerapplseqnum", seq: str = "applseqnum",
                      rule: str = "trade_without_order", detail: bool = False) -> DataFrame:
    """Distinct order numbers named by trades but absent from the day's orders;
    0 is "no order". With ``detail`` distinct within each security that names them."""
    named = named_numbers(trades, bid, offer, seq, _group(detail)).distinct()
    known = orders.select(DAY, F.col(seq).cast("bigint").alias(seq))
    lost = missing_from(named, known, [DAY, seq]).select(*_group(detail), F.lit(1).alias("n"))
    if detail:
        return _finish(lost.groupBy(*_group(True)).agg(F.sum("n").alias("n")).withColumn("rule", F.lit(rule)), True)
    # a zero per day keeps days without a break in the report
    days = trades.select(DAY, F.lit(0).alias("n"))
    counted = days.unionByName(lost).groupBy(DAY).agg(F.sum("n").alias("n"))
    return _finish(counted.withColumn("rule", F.lit(rule)), False)


def named_numbers(trades: DataFrame, bid: str = "bidapplseqnum", offer: str = "offerapplseqnum", seq: str = "applseqnum",
                  keep: Sequence[str] = (DAY,)) -> DataFrame:
    """(keep..., seq): the order numbers trades name, one row a side; 0 is "no order"."""
    return trades.select(*keep, F.explode(F.array(F.col(bid).cast("bigint"), F.col(offer).cast("bigint"))).alias(seq)).where(F.col(seq) != 0)


def missing_reference_bitmap(trades: DataFrame, orders: DataFrame | None = None, bid: str = "bidapplseqnum",
                             offer: str = "offerapplseqnum", seq: str = "applseqnum", channel: str | None = None,
                             known: DataFrame | None = None, rule: str = "trade_without_order") -> DataFrame:
    """``missing_reference`` with sets of numbers as bitmaps, per day and, if
    named, channel: orders and trades shuffle bitmaps, not rows. ``known`` takes
    bitmaps of the orders that were stored when the orders were loaded
    (``bitmaps.number_bitmaps``), so the orders need not be read again."""
    by = [DAY, *([channel] if channel else [])]
    named = bitmaps.number_bitmaps(named_numbers(trades, bid, offer, seq, by), seq, by)
    known = bitmaps.number_bitmaps(orders, seq, by) if known is None else known
    lost = bitmaps.count_outside(named, known, by).select(DAY, "n")
    days = trades.select(DAY, F.lit(0).cast("bigint").alias("n")).distinct()
    counted = days.unionByName(lost).groupBy(DAY).agg(F.sum("n").alias("n"))
    return _finish(counted.withColumn("rule", F.lit(rule)), False)


def blank(column: str, absent: bool = True) -> Column:
    """A blank or NaN cell, or (unless ``absent`` is False) a missing one."""
    bad = blank_or_nan(F.col(column))
    return bad if absent else F.col(column).isNotNull() & bad


def blank_cells(df: DataFrame, columns: Sequence[str], detail: bool = False, absent: bool = True) -> DataFrame:
    """Blank cells per tracked column; the rule is 'blank:' + column."""
    return count_rows(df, {f"blank:{c}": blank(c, absent) for c in columns}, detail)


def on_closed_days(df: DataFrame, holidays: DataFrame, start: int = 80000000, end: int = 170000000,
                   rule: str = "non_trading_day", detail: bool = False) -> DataFrame:
    """Rows dated on a day of the holiday list, between 08:00 and 17:00."""
    closed = df.join(holidays.select(DAY).distinct(), DAY, "left_semi")
    hit = (F.col("clock") > start) & (F.col("clock") <= end)
    return count_rows(closed, {rule: hit}, detail)


# --- the whole report ------------------------------------------------------

def feed_report(feed: str, df: DataFrame, fmt: str = "new", mode: str = "any",
                detail: bool = False) -> DataFrame:
    """Every rule that needs only this feed."""
    out = [count_rows(df, row_rules(feed, fmt), detail)]
    if feed == "snap":
        fall = {"falls": COUNTERS, "mode": mode}
        back = {"falls": ["highpx"], "rises": ["lowpx"], "nonzero": True}
        if fmt == "new":
            out.append(count_break_sets(df, ["ts"], {
                "snap_counters_fall": fall | {"not_rising": ["ts"]}, "snap_high_low_moves_back": back,
            }, detail))
        else:
            sessions = CONTINUOUS_SESSIONS if fmt == "old" else None
            out.append(count_breaks(df, "snap_counters_fall", ["ts", "numtrades"], sessions, detail, **fall))
            out.append(count_breaks(df, "snap_high_low_moves_back", ["ts"], detail=detail, **back))
    elif feed == "order" and fmt == "new":
        out.append(count_breaks(df, "order_sequence", ["applseqnum"], falls=["ts"],
                                not_rising=["applseqnum"], detail=detail))
    elif feed == "order":
        out.append(count_breaks(df, "order_sequence", ["applseqnum"],
                                falls={"applseqnum": 0, "clock": 1000}, detail=detail))
    elif feed == "trade" and fmt != "sh":
        out.append(count_breaks(df, "trade_sequence", ["applseqnum"], falls=["ts"],
                                not_rising=["applseqnum"], detail=detail))
    elif feed == "index":
        falls = ["ts", "totalvaluetrade", "totalvolumetrade"] if fmt == "new" else ["ts", "totalvolumetrade"]
        order = ["ts"] if fmt == "new" else ["ts", "totalvolumetrade"]
        out.append(count_breaks(df, "index_totals_fall", order, falls=falls, detail=detail))
    return reduce(DataFrame.unionByName, out)


def volume_rules(feed: str, df: DataFrame, detail: bool = False) -> DataFrame:
    """Rows and distinct securities of a feed as entries of the report; with
    ``detail`` the rows of each security."""
    if detail:
        return _finish(df.groupBy(*_group(True)).agg(F.count("*").alias("n")).withColumn("rule", F.lit(f"rows:{feed}")), True)
    counted = df.groupBy(DAY).agg(F.count("*").alias(f"rows:{feed}"), F.countDistinct(SECURITY).alias(f"securities:{feed}"))
    return _finish(counted.unpivot([DAY], [f"rows:{feed}", f"securities:{feed}"], "rule", "n"), False)


def report(feeds: Mapping[str, DataFrame], fmt: str = "new", mode: str = "any", detail: bool = False,
           volumes: bool = False, tracked: Mapping[str, Sequence[str]] | None = None,
           holidays: DataFrame | None = None) -> DataFrame:
    """Every rule the feeds at hand allow, over whatever days they hold:
    (trade_date, rule, n), with ``detail`` per security and offenders only.

    ``volumes`` adds rows and securities per feed, ``tracked`` (feed -> columns)
    the blank cells of columns that must not be blank, ``holidays`` the rows of
    closed days, each named by its feed."""
    parts = [feed_report(name, df, fmt, mode, detail) for name, df in feeds.items()]
    if "trade" in feeds and "snap" in feeds:
        parts.append(sum_vs_total(feeds["trade"], feeds["snap"], fmt, mode, detail=detail))
    if "trade" in feeds and "order" in feeds:
        parts.append(missing_reference(feeds["trade"], feeds["order"], detail=detail))
    if volumes:
        parts += [volume_rules(name, df, detail) for name, df in feeds.items()]
    for name, columns in (tracked or {}).items():
        parts.append(count_rows(feeds[name], {f"blank:{name}:{c}": blank(c) for c in columns}, detail))
    if holidays is not None:
        parts += [on_closed_days(df, holidays, rule=f"non_trading_day:{name}", detail=detail) for name, df in feeds.items()]
    return reduce(DataFrame.unionByName, parts)
