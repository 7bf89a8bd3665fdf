"""Cash-flow and max-cost-return marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions.numbers import ratio, zero_if_null
from quotewell.functions.times import as_date, month_begin, previous_month_end, year_begin
from quotewell.operators.peaks import floored, merge_states, peak_states
from quotewell.operators.relational import max_running_floor0
from quotewell.plans.marts.assets import Tables, active_customers, assets_month, at_two_dates
from quotewell.sources.sinks import replace_range

# Fixed value: largest accepted absolute return.
MAX_RATE = 10
IN_OUT = {"fin_in_amt": "fin_in_amt", "fin_out_amt": "fin_out_amt"}


def _between(df: DataFrame, lo: Column, day) -> DataFrame:
    return df.where(F.col("data_dt").between(lo, as_date(day)))


def _flows(df: DataFrame, inflow: Column, outflow: Column) -> DataFrame:
    return df.select(
        "pty_id", "data_dt", inflow.alias("fin_in_amt"), outflow.alias("fin_out_amt"),
        (inflow - outflow).alias("net_in"),
    )


def margin_flows(t: Tables, lo: Column, day) -> DataFrame:
    moved = _between(t["vw_ms_cust_fc_tran_idx_d"], lo, day)
    cash = _between(t["vw_ms_cust_fc_fin_idx_d"], lo, day)
    return _flows(moved, F.col("assure_in_amt"), F.col("assure_out_amt")).unionByName(
        _flows(cash, F.col("cash_in"), F.col("cash_out"))
    )


def _in_out(flows: DataFrame, day, cost: str) -> DataFrame:
    out = max_running_floor0(
        flows, "pty_id", "data_dt", "net_in", cost,
        IN_OUT,
    )
    return out.withColumn("data_dt", as_date(day))


def margin_io_month(t: Tables, day) -> DataFrame:
    """Month-to-date margin in/out flows and max cost."""
    return _in_out(margin_flows(t, month_begin(day), day), day, "max_cost_fc")


def margin_io_year(t: Tables, day) -> DataFrame:
    """The same from the first of January."""
    return _in_out(margin_flows(t, year_begin(day), day), day, "max_cost_fc")


def store_cost_states(flows: DataFrame, path: str, first, last) -> None:
    """One state per customer and month of the flows from ``first`` to ``last``
    into the table at ``path``, partitioned by month. Months begin with their
    first day: both bounds are read as whole months, so a late flow is mended by
    storing its month again, whatever was stored after it."""
    lo, hi = (F.trunc(as_date(d), "month") for d in (first, last))
    inside = flows.where(F.col("data_dt").between(lo, F.last_day(as_date(last))))
    states = peak_states(inside.withColumn("month", F.trunc("data_dt", "month")), ["pty_id"], "month", "data_dt", "net_in", IN_OUT)
    replace_range(states, path, lo, hi, "month")


def cost_between(spark: SparkSession, path: str, first, last) -> DataFrame:
    """In and out flows and max cost from the stored states of these months; no
    other partition is read."""
    lo, hi = (F.trunc(as_date(d), "month") for d in (first, last))
    states = spark.read.parquet(path).where(F.col("month").between(lo, hi))
    merged = merge_states(states, ["pty_id"], "month", list(IN_OUT))
    return merged.select("pty_id", *IN_OUT, floored().alias("max_cost_fc"), F.last_day(as_date(last)).alias("data_dt"))


def margin_io_year_incremental(t: Tables, day, path: str) -> DataFrame:
    """The year's in and out flows and max cost, reading the flows of the
    current month alone: its states are stored anew, those of the months before
    are taken as they were stored. Flows after ``day`` do not count."""
    flows = margin_flows(t, month_begin(day), day)
    store_cost_states(flows, path, month_begin(day), as_date(day))
    return cost_between(flows.sparkSession, path, year_begin(day), as_date(day)).withColumn("data_dt", as_date(day))


def all_flows(t: Tables, lo: Column, day) -> DataFrame:
    """Ordinary account flows and margin cash flows."""
    own = _between(t["ms_cust_fin_d"], lo, day)
    inflow = F.col("cash_in") + F.col("tran_in") + F.col("assign_in") + F.col("lmt_in_amt")
    outflow = F.col("cash_out") + F.col("tran_out") + F.col("assign_out")
    cash = _between(t["vw_ms_cust_fc_fin_idx_d"], lo, day)
    return _flows(own, inflow, outflow).unionByName(_flows(cash, F.col("cash_in"), F.col("cash_out")))


def profit(bgn: Column, end: Column, inflow: Column, outflow: Column) -> Column:
    return end - bgn - inflow + outflow


def max_cost_rate(gain: Column, bgn: Column, cost: Column, digits: int | None = None) -> Column:
    return ratio(gain, bgn + cost, digits)


def margin_customers(t: Tables, day) -> DataFrame:
    flagged = t["ms_cust_info_ext_c"].where(F.col("fc_flag") == "Y").select("pty_id")
    return active_customers(t, day).join(flagged, "pty_id")


def _margin_base(t: Tables, day, begin: Column) -> DataFrame:
    """Begin and end margin assets and the month's flows per margin customer."""
    pur = at_two_dates(t["ms_cust_fc_aset_d"], "pur_aset", begin, day, "pur_aset_bgn", "pur_aset_end")
    io = t.get("ms_cust_fc_io_m")
    io = margin_io_month(t, day) if io is None else io.where(F.col("data_dt") == as_date(day))
    joined = margin_customers(t, day).join(pur, "pty_id", "left").join(io.drop("data_dt"), "pty_id", "left")
    return joined.select("pty_id", *[
        zero_if_null(F.col(c)).alias(c)
        for c in ("pur_aset_bgn", "pur_aset_end", "fin_in_amt", "fin_out_amt", "max_cost_fc")
    ])


def _margin_gain() -> Column:
    return profit(F.col("pur_aset_bgn"), F.col("pur_aset_end"), F.col("fin_in_amt"), F.col("fin_out_amt"))


def margin_profit_month(t: Tables, day) -> DataFrame:
    """Month profit and max-cost return of margin customers; absurd rates drop out."""
    rate = max_cost_rate(_margin_gain(), F.col("pur_aset_bgn"), F.col("max_cost_fc"), 4)
    return (
        _margin_base(t, day, previous_month_end(day))
        .select(as_date(day).alias("data_dt"), "pty_id", _margin_gain().alias("aset_pft"),
                rate.alias("max_cost_rate"))
        .where(F.abs("max_cost_rate") <= MAX_RATE)
    )


def margin_report_month(t: Tables, day, begin: str = "previous_month_end") -> DataFrame:
    """Margin report row. ``begin`` picks the day the opening assets are read
    at: 'previous_month_end' or 'month_begin'."""
    first = month_begin(day) if begin == "month_begin" else previous_month_end(day)
    gains = t.get("ms_cust_fc_aset_m")
    gains = margin_profit_month(t, day) if gains is None else gains.where(F.col("data_dt") == as_date(day))
    return (
        _margin_base(t, day, first).drop("max_cost_fc")
        .join(gains.drop("data_dt"), "pty_id", "left")
        .withColumns({c: zero_if_null(F.col(c)) for c in ("aset_pft", "max_cost_rate")})
        .withColumn("data_dt", as_date(day))
    )


def with_profit(assets: DataFrame, io: DataFrame, inflow: str, outflow: str, cost: str) -> DataFrame:
    """Adds bgn, end, in, out, aset_pft and max_cost_rate to month assets."""
    joined = assets.join(io, "pty_id", "left").withColumns({
        "_bgn": F.col("tot_aset_bgn") + F.col("pur_aset_bgn"),
        "_end": F.col("tot_aset_end") + F.col("pur_aset_end"),
        "_in": zero_if_null(F.col(inflow)), "_out": zero_if_null(F.col(outflow)),
        "_cost": zero_if_null(F.col(cost)),
    })
    gain = profit(F.col("_bgn"), F.col("_end"), F.col("_in"), F.col("_out"))
    return joined.withColumns({
        "aset_pft": gain, "max_cost_rate": max_cost_rate(gain, F.col("_bgn"), F.col("_cost")),
    })


def profit_to_date(t: Tables, day) -> DataFrame:
    """Month-to-date profit and max-cost return over both account kinds."""
    io = _in_out(all_flows(t, month_begin(day), day), day, "max_cost_aset_m").drop("data_dt")
    rows = with_profit(assets_month(t, day), io, "fin_in_amt", "fin_out_amt", "max_cost_aset_m")
    return rows.select("data_dt", "pty_id", "aset_pft", "max_cost_rate")
