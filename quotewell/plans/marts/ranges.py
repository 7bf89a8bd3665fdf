"""Marts over many months in one plan.

A run date is a column here (``run``: the last day of a month), not a constant:
every dated row belongs to the run of its month, and a month-end position to two
runs, as the end of one and the beginning of the next. What a run adds up is
kept as a ledger of events, each with the days, trades and signed money it
stands for, so a result is one sum, whatever the number of months. Validity
periods meet runs by month (``operators.intervals``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.numbers import zero_if_null
from quotewell.functions.times import as_date, month_begin, previous_month_end
from quotewell.operators.intervals import join_valid
from quotewell.operators.relational import close_or_nav, missing_from, union_padded, with_rate
from quotewell.plans.marts import products as p
from quotewell.plans.marts.assets import Tables

RUN = "run"
EVENT = ["seen", "days", "buys", "sells", "money"]


def run_of(day: Column | str = "data_dt") -> Column:
    return F.last_day(day)


def _between(df: DataFrame, first, last) -> DataFrame:
    """Rows of the months of the runs, with their run."""
    return df.where(F.col("data_dt").between(month_begin(first), as_date(last))).withColumn(RUN, run_of())


def _listed(t: Tables, df: DataFrame, first, last) -> DataFrame:
    days = t["ana_dim_date"].select(F.col("d_date").alias("data_dt"))
    return _between(df, first, last).join(days, "data_dt", "left_semi")


def _on_runs(df: DataFrame, first, last) -> DataFrame:
    return _between(df, first, last).where(F.col("data_dt") == F.col(RUN))


def _both_ends(df: DataFrame, first, last) -> DataFrame:
    """Month-end rows with ``side`` 1 as the end of their own run and -1 as the beginning of the next."""
    ends = df.where((F.col("data_dt") == run_of()) & F.col("data_dt").between(previous_month_end(first), as_date(last)))
    both = F.array(
        F.struct(F.lit(1).alias("side"), F.col("data_dt").alias(RUN)),
        F.struct(F.lit(-1).alias("side"), run_of(F.date_add("data_dt", 1)).alias(RUN)),
    )
    return ends.withColumn("_end", F.explode(both)).select("*", "_end.*").drop("_end").where(F.col(RUN).between(as_date(first), as_date(last)))


def _held_days() -> Column:
    return F.datediff("data_dt", F.greatest(F.col("hold_dt"), F.trunc(RUN, "month"))) + 1


def _closed_days() -> Column:
    return F.least(F.datediff("data_dt", F.trunc(RUN, "month")) + 1, F.col("hold_days"))


def _minus(amount: Column, *costs: Column) -> Column:
    """Money in less money out, an absent one being nothing."""
    out = zero_if_null(amount)
    for c in costs:
        out = out - zero_if_null(c)
    return out


def _seen(df: DataFrame, key: Sequence[str], days: Column) -> DataFrame:
    return df.select(*key, F.lit(True).alias("seen"), days.alias("days"))


ORDINARY_KEY = [RUN, "pty_id", "prdt_id", "sys_source_cd"]


def _stock() -> Column:
    return F.col("stk_id").alias("prdt_id")


def _own() -> Column:
    return F.lit("01").alias("sys_source_cd")


def _ordinary_seen(t: Tables, first, last) -> list[DataFrame]:
    """Products held, closed or traded in a run, with the days they were held."""
    ours = F.col("sys_source_cd").isin(*p.ACCOUNTS)
    held = _on_runs(t["ms_cust_ccy_prdt_anahold_d"].where(ours), first, last)
    closed = _between(t["ms_cust_ccy_prdt_anaunhold_d"].where(ours), first, last)
    traded = _between(t["sta_stk_jnls"], first, last)
    return [
        _seen(held, ORDINARY_KEY, _held_days()), _seen(closed, ORDINARY_KEY, _closed_days()),
        _seen(traded, [RUN, "pty_id", _stock(), _own()], F.lit(0)),
    ]


def _ordinary_money(t: Tables, first, last) -> list[DataFrame]:
    rates, rate = t["view_conv_rmb"], F.col("exchange_rate")
    ends = _both_ends(t["ms_cust_ccy_prdt_anahold_d"].where(F.col("sys_source_cd").isin(*p.ACCOUNTS)), first, last)
    positions = with_rate(ends, rates).select(*ORDINARY_KEY, (F.col("side") * F.col("mkt_val") * rate).alias("money"))
    core = _on_runs(t["mf_cust_tran_core_m"], first, last).where(F.col("sys_source_cd").isin("01", "04") & ~F.col("prdt_id").like("HG%"))
    core = core.select(
        *ORDINARY_KEY, F.col("buy_cnt").alias("buys"), F.col("sell_cnt").alias("sells"),
        _minus(F.col("sell_amt"), F.col("buy_amt"), F.col("buy_rake") + zero_if_null(F.col("buy_fare")), F.col("sell_rake") + zero_if_null(F.col("sell_fare"))).alias("money"),
    )
    journal = _between(t["sta_stk_jnls"], first, last)
    sale, tax = F.col("busi_cd") == p.SELL_ENTRY, F.col("busi_cd") == p.DIVIDEND_TAX
    amount = F.col("barg_amt") * rate
    entries = with_rate(journal.where(F.col("busi_cd").isin(*p.ENTRY_CODES_MONTH)), rates).select(
        RUN, "pty_id", _stock(), _own(), F.when(sale | tax, 0).otherwise(1).alias("buys"), F.when(sale, 1).otherwise(0).alias("sells"),
        F.when(sale, amount).otherwise(-amount).alias("money"),
    )
    numbers = [prefix + n for n in p.REPO_NUMBERS for prefix in ("", "HG")]
    repo = journal.where(F.col("busi_cd").isin(*p.REPO_CODES) & F.col("stk_id").isin(*numbers)).select(
        RUN, "pty_id", F.when(F.col("stk_id").like("%204%"), p.REPO_PRODUCTS[0]).otherwise(p.REPO_PRODUCTS[1]).alias("prdt_id"), _own(), F.col("clear_balance").alias("money"),
    )
    moves = with_rate(_between(t["mf_cust_sys_fin_d"], first, last), rates, inner=True).select(
        *ORDINARY_KEY, (_minus(F.col("tran_out") * rate, (F.col("tran_in") + F.col("allot_share_amt")) * rate) + zero_if_null(F.col("bonus_amt") * rate)).alias("money"),
    )
    # collateral that leaves the margin account comes into the ordinary one
    came, went = p.VALUED_CODES["assure_out"], p.VALUED_CODES["assure_in"]
    market = t["mf_prdt_mkt_d"].select("data_dt", F.col("prdt_id").alias("stk_id"), "end_price", "nav")
    moved = with_rate(_between(t["sta_fc_jnls"].where(F.col("busi_cd").isin(came, went)), first, last), rates, inner=True).join(market, ["data_dt", "stk_id"], "left")
    worth, into = F.col("barg_cnt") * close_or_nav(F.col("end_price"), F.col("nav")) * rate, F.col("busi_cd") == came
    moved = moved.select(
        RUN, "pty_id", _stock(), _own(), F.when(into, 1).otherwise(0).alias("buys"), F.when(into, 0).otherwise(1).alias("sells"), F.when(into, -worth).otherwise(worth).alias("money"),
    )
    return [positions, core, entries, repo, moves, moved]


def _ledger(parts: Sequence[DataFrame], key: Sequence[str], money: Sequence[str] = ("money",)) -> DataFrame:
    """The sums of each key that has something to be seen."""
    whole = union_padded([x if "seen" in x.columns else x.withColumn("seen", F.lit(False)) for x in parts], ["days", "buys", "sells", *money])
    sums = whole.groupBy(*key).agg(
        F.bool_or("seen").alias("seen"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("days", "buys", "sells", *money)]
    )
    return sums.where("seen").drop("seen")


def _valid(t: Tables, df: DataFrame, wanted: Column, first, last, how: str = "inner") -> DataFrame:
    """Rows of products that were valid at their run, and of a wanted class."""
    return join_valid(df, RUN, t["mf_prdt_attr_h"].where(wanted).select("prdt_id", "up_prdt_type_id", "bgn_dt", "end_dt"), ["prdt_id"], first, last, how=how)


def _is_listed() -> Column:
    return F.col("up_prdt_type_id").isin(p.BONDS, p.SHARES, p.OTHERS) & (F.col("prdt_type_id") != p.SHARE_FUND)


def _result(rows: DataFrame, flag: Column, money: Column) -> DataFrame:
    return rows.select(
        F.col(RUN).alias("data_dt"), "pty_id", "prdt_id", flag.alias("flag"), F.col("days").cast("bigint").alias("hold_days"),
        F.col("buys").alias("buy_cnt"), F.col("sells").alias("sell_cnt"), money.alias("tran_pft"),
    )


def ordinary_product_range(t: Tables, first, last) -> DataFrame:
    sums = _ledger([*_ordinary_seen(t, first, last), *_ordinary_money(t, first, last)], ORDINARY_KEY)
    flag = F.coalesce(*[F.when(F.col("sys_source_cd") == s, f) for s, f in p.ACCOUNTS.items()], F.lit("001"))
    return _result(_valid(t, sums, _is_listed(), first, last), flag, F.col("money"))


def pledged_bond_range(t: Tables, first, last) -> DataFrame:
    """Bonds traded in a run without a position, unless the ordinary account shows them."""
    key = [RUN, "pty_id", "prdt_id"]
    traded = _on_runs(t["mf_cust_tran_core_m"], first, last).where(F.col("sys_source_cd") == "01")
    rows = _valid(t, traded, F.col("up_prdt_type_id") == p.BONDS, first, last).groupBy(*key).agg(
        F.sum("buy_cnt").alias("buys"), F.sum("sell_cnt").alias("sells"),
        F.sum(F.col("sell_amt") - F.col("buy_amt") - F.col("buy_rake") - F.col("sell_rake")).alias("money"),
    )
    seen = [x.select(*key) for x in _ordinary_seen(t, first, last)]
    shown = _valid(t, seen[0].unionByName(seen[1]).unionByName(seen[2]).distinct(), _is_listed(), first, last, "left_semi")
    return _result(missing_from(rows, shown, key).withColumn("days", F.lit(p.PLEDGE_DAYS)), F.lit("001"), F.col("money"))


MARGIN_KEY = [RUN, "pty_id", "prdt_id"]


def margin_product_range(t: Tables, first, last) -> DataFrame:
    holdings, market = t["ms_cust_prdt_fc_hold_d"], t["mf_prdt_mkt_d"].select("data_dt", "prdt_id", "end_price")
    active = (F.col("hold_cnt") != 0) | (F.col("deb_mnt") != 0)
    held = _seen(_on_runs(holdings.where(active), first, last), MARGIN_KEY, _held_days())
    closed = _seen(_listed(t, t["ms_cust_prdt_fc_unhold_d"], first, last), MARGIN_KEY, _closed_days())
    interest = _listed(t, holdings.where(active), first, last).select(*MARGIN_KEY, (-F.col("deb_int_d")).alias("flow"))
    prices = market.groupBy("data_dt", "prdt_id").agg(F.max("end_price").alias("end_price"))
    ends = _both_ends(holdings, first, last).join(prices, ["data_dt", "prdt_id"], "left")
    own = F.col("hold_cnt") - F.col("stc_deb_mnt")
    positions = ends.select(*MARGIN_KEY, (F.col("side") * F.col("mkt_val")).alias("by_value"), (F.col("side") * own * F.col("end_price")).alias("by_price"))
    return _margin_result(t, [held, closed, interest, positions, _margin_trades(t, first, last)], first, last)


def _margin_trades(t: Tables, first, last) -> DataFrame:
    lines = _listed(t, t["sta_fc_jnls"].where(F.col("busi_cd").isin(*p.MONTH_TRADE_CODES) & F.col("tran_dir_cd").isin(p.BUY, p.SELL)), first, last)
    prices = t["mf_prdt_mkt_d"].select("data_dt", F.col("prdt_id").alias("stk_id"), "end_price")
    lines = with_rate(lines, t["view_conv_rmb"], default=None).join(prices, ["data_dt", "stk_id"], "left")
    code, rate, count = F.col("busi_cd"), F.col("exchange_rate"), F.col("barg_cnt")
    buying = F.col("tran_dir_cd") == p.BUY
    at_limit, at_close, traded = F.col("ent_pri") * count, count * F.col("end_price") * rate, F.col("barg_amt") * rate
    collateral = code.isin(p.VALUED_CODES["assure_in"], p.VALUED_CODES["assure_out"])
    amount = (
        F.when(collateral, at_close).when(buying & code.isin(p.ALLOT, p.NEW_STOCK), at_limit)
        .when(buying & (code == p.BONUS), at_close).otherwise(traded)
    )
    fees = F.col("rake")
    for fee in ("fare1", "fare2", "fare3", "farex"):
        fees = fees + zero_if_null(F.col(fee))
    one = F.lit(1)
    return lines.select(
        RUN, "pty_id", _stock(),
        F.when(buying & ~code.isin(p.ALLOT, p.DIVIDEND_TAX), one).otherwise(0).alias("buys"),
        F.when(~buying & ~code.isin(p.ALLOT, p.DIVIDEND_ENTRY), one).otherwise(0).alias("sells"),
        _minus(F.when(buying, -amount).otherwise(amount), fees * rate).alias("flow"),
    )


def _margin_result(t: Tables, parts: Sequence[DataFrame], first, last) -> DataFrame:
    sums = _ledger(parts, MARGIN_KEY, ("flow", "by_value", "by_price"))
    rows = _valid(t, sums, _is_listed(), first, last)
    worth = F.when(F.col("up_prdt_type_id") == p.BONDS, F.col("by_value")).otherwise(F.col("by_price"))
    return _result(rows, F.lit(p.MARGIN_ACCOUNT), worth + F.col("flow"))


def product_profit_range(t: Tables, first, last) -> DataFrame:
    """``products.product_profit_month`` for the run at every month end from
    ``first`` to ``last`` (both month ends), in one plan."""
    parts = [ordinary_product_range(t, first, last), pledged_bond_range(t, first, last), margin_product_range(t, first, last)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
