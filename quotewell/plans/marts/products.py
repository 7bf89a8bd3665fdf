"""Product marts: profit per product, wealth-product counts, trade counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.numbers import zero_if_null
from quotewell.functions.times import as_date, asof_valid, month_begin, previous_month_end
from quotewell.operators.relational import (
    close_or_nav, conditional_sums, missing_from, union_padded, with_rate,
)
from quotewell.plans.marts.assets import Tables

# Business codes of the margin journal, by what they mean.
TRADE_CODES = {
    "stk_buy": "406004002", "stk_sell": "406004001",
    "finance_buy": "406004211", "finance_sell": "406004212",
    "shortsell_buy": "406004213", "shortsell_sell": "406004214",
    "payoff_buy": "406004215", "payoff_sell": "406004216",
}
VALUED_CODES = {"assure_in": "406004201", "assure_out": "406004202", "direct_pay": "406004206"}
ALLOT, BONUS, NEW_STOCK = "406004014", "406004015", "406004016"
# Journal codes of the ordinary account.
DIVIDEND_TAX, SELL_ENTRY, DIVIDEND_ENTRY = "406002434", "406004021", "406004018"
ENTRY_CODES_MONTH = ("406004034", "406004021", "406004022", "406004121", "406002434")
ENTRY_CODES_DAY = ("406004034", "406004021", "406004022")
REPO_CODES = ("406004103", "406004104", "406004105", "406004106")
# Repo product numbers (with and without prefix) and the two
# products they are booked under.
REPO_NUMBERS = (
    "204001", "204002", "204003", "204004", "204007", "204014", "204028", "204091", "204182",
    "131800", "131801", "131802", "131803", "131805", "131806", "131809", "131810", "131811",
)
REPO_PRODUCTS = ("ZQ888880", "ZQ131990")
# Margin journal codes that count as trades.
DAY_TRADE_CODES = (
    "406004001", "406004002", "406004014", "406004201", "406004202", "406004211", "406004212",
    "406004213", "406004214", "406004215", "406004216", "406004034", "406004021", "406004022",
)
MONTH_TRADE_CODES = (*DAY_TRADE_CODES, DIVIDEND_ENTRY, DIVIDEND_TAX, "406004121")
BUY, SELL = "603010", "603020"
# Product classes.
BONDS, SHARES, OTHERS, SHARE_FUND = "PA030000", "PA040000", "PA080000", "PA040500"
WEALTH, CASH_FUND = "PA070100", "TA940018"
ACCOUNTS = {"01": "001", "04": "004", "07": "007"}
MARGIN_ACCOUNT, PLEDGE_DAYS = "105", 99


def valid_products(t: Tables, day) -> DataFrame:
    return asof_valid(t["mf_prdt_attr_h"], day).select("prdt_id", "prdt_type_id", "up_prdt_type_id")


def days_between(df: DataFrame, lo: Column, day) -> DataFrame:
    return df.where(F.col("data_dt").between(lo, as_date(day)))


def on_day(df: DataFrame, day) -> DataFrame:
    return df.where(F.col("data_dt") == as_date(day))


def listed_days(t: Tables, df: DataFrame, lo: Column, day) -> DataFrame:
    """Rows of the period whose day is in the date dimension."""
    wanted = t["ana_dim_date"].where(F.col("d_date").between(lo, as_date(day))).select(
        F.col("d_date").alias("data_dt")
    )
    return days_between(df, lo, day).join(wanted, "data_dt", "left_semi")


def margin_trade_summary(t: Tables, lo: Column, day) -> DataFrame:
    """Margin journal per (customer, product): amount, quantity and count for
    every kind of business. One aggregation; unused columns are pruned."""
    codes = [*TRADE_CODES.values(), *VALUED_CODES.values(), ALLOT, BONUS, NEW_STOCK]
    rows = days_between(t["sta_fc_jnls"], lo, day).where(F.col("busi_cd").isin(*codes))
    rows = with_rate(rows, t["view_conv_rmb"], inner=True)
    market = t["mf_prdt_mkt_d"].select("data_dt", F.col("prdt_id").alias("stk_id"), "end_price", "nav")
    rows = rows.join(market, ["data_dt", "stk_id"], "left")
    rate, count = F.col("exchange_rate"), F.col("barg_cnt")
    worth = count * close_or_nav(F.col("end_price"), F.col("nav")) * rate
    sums: dict[str, tuple[str, Column | int]] = {}
    for name, code in TRADE_CODES.items():
        sums[f"{name}_amt"] = (code, F.col("barg_amt") * rate)
        sums[f"{name}_mnt"] = (code, count)
        sums[f"{name}_cnt"] = (code, 1)
        sums[f"{name}_rake"] = (code, F.col("rake") * rate)
        sums[f"{name}_pur_rake"] = (code, F.col("pur_rake") * rate)
    for name, code in VALUED_CODES.items():
        sums[f"{name}_amt"] = (code, worth)
        sums[f"{name}_mnt"] = (code, count)
        sums[f"{name}_cnt"] = (code, 1)
    for name, code, amount in (
        ("allot_stk", ALLOT, count * F.col("ent_pri")), ("bonus_stk", BONUS, worth),
        ("new_stk", NEW_STOCK, count * F.col("ent_pri")),
    ):
        sums[f"{name}_mnt"] = (code, count)
        sums[f"{name}_amt"] = (code, amount)
    return rows.groupBy("pty_id", F.col("stk_id").alias("prdt_id")).agg(
        *conditional_sums(F.col("busi_cd"), sums)
    )


def entries(t: Tables, lo: Column, day, codes, rated: bool = True) -> DataFrame:
    """Ordinary-account journal entries as buys, or sells for one code."""
    rows = days_between(t["sta_stk_jnls"], lo, day).where(F.col("busi_cd").isin(*codes))
    rows = with_rate(rows, t["view_conv_rmb"])
    sell = F.col("busi_cd") == SELL_ENTRY
    amount = F.col("barg_amt") * F.col("exchange_rate")
    return rows.select(
        "pty_id", F.lit("01").alias("sys_source_cd"), F.col("stk_id").alias("prdt_id"),
        F.when(sell, F.lit(0)).otherwise(amount).alias("buy_amt"),
        F.when(sell, amount).otherwise(F.lit(0)).alias("sell_amt"),
        F.when(sell | (F.col("busi_cd") == DIVIDEND_TAX), 0).otherwise(1).alias("buy_cnt"),
        F.when(sell, 1).otherwise(0).alias("sell_cnt"),
    )


ORDINARY_MEASURES = ["buy_amt", "sell_amt", "buy_rake", "sell_rake", "buy_cnt", "sell_cnt", "tran_pft"]


def ordinary_month_trades(t: Tables, day) -> DataFrame:
    """Month trades of the ordinary account per (customer, system, product), all
    amounts in home currency."""
    lo = month_begin(day)
    core = on_day(t["mf_cust_tran_core_m"], day).where(
        F.col("sys_source_cd").isin("01", "04") & ~F.col("prdt_id").like("HG%")
    ).select(
        "pty_id", "sys_source_cd", "prdt_id", "buy_amt", "sell_amt",
        (F.col("buy_rake") + zero_if_null(F.col("buy_fare"))).alias("buy_rake"),
        (F.col("sell_rake") + zero_if_null(F.col("sell_fare"))).alias("sell_rake"),
        "buy_cnt", "sell_cnt",
    )
    fin = with_rate(days_between(t["mf_cust_sys_fin_d"], lo, day), t["view_conv_rmb"], inner=True)
    rate = F.col("exchange_rate")
    corporate = fin.select(
        "pty_id", "sys_source_cd", "prdt_id",
        ((F.col("tran_in") + F.col("allot_share_amt")) * rate).alias("buy_amt"),
        (F.col("tran_out") * rate).alias("sell_amt"), (F.col("bonus_amt") * rate).alias("tran_pft"),
    )
    # collateral moved out of the margin account comes into the ordinary one
    moved = margin_trade_summary(t, lo, day).select(
        "pty_id", F.lit("01").alias("sys_source_cd"), "prdt_id",
        F.col("assure_out_amt").alias("buy_amt"), F.col("assure_in_amt").alias("sell_amt"),
        F.col("assure_out_cnt").alias("buy_cnt"), F.col("assure_in_cnt").alias("sell_cnt"),
    )
    numbers = [p + n for n in REPO_NUMBERS for p in ("", "HG")]
    repo = days_between(t["sta_stk_jnls"], lo, day).where(
        F.col("busi_cd").isin(*REPO_CODES) & F.col("stk_id").isin(*numbers)
    ).select(
        "pty_id", F.lit("01").alias("sys_source_cd"),
        F.when(F.col("stk_id").like("%204%"), REPO_PRODUCTS[0]).otherwise(REPO_PRODUCTS[1]).alias("prdt_id"),
        F.col("clear_balance").alias("sell_amt"),
    )
    parts = [core, entries(t, lo, day, ENTRY_CODES_MONTH), corporate, moved, repo]
    return union_padded(parts, ORDINARY_MEASURES).groupBy("pty_id", "sys_source_cd", "prdt_id").agg(
        *[F.sum(m).alias(m) for m in ORDINARY_MEASURES]
    )


def held_days(day) -> Column:
    """Days a product still held was held this month."""
    return F.datediff("data_dt", F.greatest(F.col("hold_dt"), month_begin(day))) + 1


def closed_days(day) -> Column:
    """Days a product closed this month was held in it."""
    return F.least(F.datediff("data_dt", month_begin(day)) + 1, F.col("hold_days"))


def _ordinary_holdings(t: Tables, at, value: str) -> DataFrame:
    rows = on_day(t["ms_cust_ccy_prdt_anahold_d"], at).where(F.col("sys_source_cd").isin(*ACCOUNTS))
    rows = with_rate(rows, t["view_conv_rmb"])
    return rows.withColumn(value, F.col("mkt_val") * F.col("exchange_rate"))


def listed_products(t: Tables, day) -> DataFrame:
    return valid_products(t, day).where(
        F.col("up_prdt_type_id").isin(BONDS, SHARES, OTHERS) & (F.col("prdt_type_id") != SHARE_FUND)
    )


def _ordinary_touched(t: Tables, day, held: DataFrame) -> DataFrame:
    """Rows of products held, closed or traded this month; days where there are any."""
    lo, key = month_begin(day), ["pty_id", "prdt_id", "sys_source_cd"]
    closed = days_between(t["ms_cust_ccy_prdt_anaunhold_d"], lo, day).where(
        F.col("sys_source_cd").isin(*ACCOUNTS)
    ).select(*key, closed_days(day).alias("days"))
    traded = days_between(t["sta_stk_jnls"], lo, day).select(
        "pty_id", F.col("stk_id").alias("prdt_id"), F.lit("01").alias("sys_source_cd")
    )
    return union_padded([held, closed, traded], ["days", "value"])


def ordinary_products(t: Tables, day) -> DataFrame:
    """The (customer, product) keys of ``ordinary_product_profit``, without working out any profit."""
    held = on_day(t["ms_cust_ccy_prdt_anahold_d"], day).where(F.col("sys_source_cd").isin(*ACCOUNTS))
    keys = _ordinary_touched(t, day, held.select("pty_id", "prdt_id", "sys_source_cd")).select("pty_id", "prdt_id").distinct()
    return keys.join(listed_products(t, day).select("prdt_id"), "prdt_id", "left_semi")


def ordinary_product_profit(t: Tables, day) -> DataFrame:
    key = ["pty_id", "prdt_id", "sys_source_cd"]
    held = _ordinary_holdings(t, day, "value").select(*key, held_days(day).alias("days"), "value")
    touched = _ordinary_touched(t, day, held).groupBy(*key).agg(
        F.sum("days").alias("days"), F.sum("value").alias("value")
    )
    opening = _ordinary_holdings(t, previous_month_end(day), "opening").groupBy(*key).agg(
        F.sum("opening").alias("opening")
    )
    rows = (
        touched.join(listed_products(t, day), "prdt_id")
        .join(opening, key, "left").join(ordinary_month_trades(t, day), key, "left")
    )
    z = {c: zero_if_null(F.col(c)) for c in (*ORDINARY_MEASURES, "opening")}
    gain = (
        F.col("value") - z["opening"] + z["sell_amt"] - z["buy_amt"] + z["tran_pft"]
        - z["buy_rake"] - z["sell_rake"]
    )
    flag = F.coalesce(*[F.when(F.col("sys_source_cd") == s, f) for s, f in ACCOUNTS.items()], F.lit("001"))
    return rows.select(
        "pty_id", "prdt_id", flag.alias("flag"), F.col("days").cast("bigint").alias("hold_days"),
        z["buy_cnt"].alias("buy_cnt"), z["sell_cnt"].alias("sell_cnt"), gain.alias("tran_pft"),
    )


def pledged_bond_profit(t: Tables, day, present: DataFrame) -> DataFrame:
    """Bonds traded this month without a position (pledged in and out), unless
    already present."""
    bonds = valid_products(t, day).where(F.col("up_prdt_type_id") == BONDS).select("prdt_id")
    rows = on_day(t["mf_cust_tran_core_m"], day).where(F.col("sys_source_cd") == "01").join(bonds, "prdt_id")
    sums = rows.groupBy("pty_id", "prdt_id").agg(
        F.sum("buy_cnt").alias("buy_cnt"), F.sum("sell_cnt").alias("sell_cnt"),
        F.sum(F.col("sell_amt") - F.col("buy_amt") - F.col("buy_rake") - F.col("sell_rake")).alias("tran_pft"),
    )
    return missing_from(sums, present, ["pty_id", "prdt_id"]).select(
        "pty_id", "prdt_id", F.lit("001").alias("flag"),
        F.lit(PLEDGE_DAYS).cast("bigint").alias("hold_days"), "buy_cnt", "sell_cnt", "tran_pft",
    )


def margin_month_trades(t: Tables, day) -> DataFrame:
    """Buys, sells and fees of the margin journal per (customer, product)."""
    rows = listed_days(t, t["sta_fc_jnls"], month_begin(day), day).where(
        F.col("busi_cd").isin(*MONTH_TRADE_CODES)
    )
    prices = t["mf_prdt_mkt_d"].select("data_dt", F.col("prdt_id").alias("stk_id"), "end_price")
    rows = with_rate(rows, t["view_conv_rmb"], default=None).join(prices, ["data_dt", "stk_id"], "left")
    code, rate, count = F.col("busi_cd"), F.col("exchange_rate"), F.col("barg_cnt")
    worth, amount = count * F.col("end_price") * rate, F.col("barg_amt") * rate
    fees = F.col("rake")
    for fee in ("fare1", "fare2", "fare3", "farex"):
        fees = fees + zero_if_null(F.col(fee))
    collateral = code.isin(VALUED_CODES["assure_in"], VALUED_CODES["assure_out"])
    buy_amt = (
        F.when(code.isin(ALLOT, NEW_STOCK), F.col("ent_pri") * count)
        .when(collateral | (code == BONUS), worth).otherwise(amount)
    )
    sell_amt = F.when(collateral, worth).otherwise(amount)
    one = F.lit(1)
    direction = F.col("tran_dir_cd")
    sums = {
        "buy_cnt": (BUY, F.when(code.isin(ALLOT, DIVIDEND_TAX), 0).otherwise(one)),
        "buy_amt": (BUY, buy_amt), "buy_rake": (BUY, fees * rate),
        "sell_cnt": (SELL, F.when(code.isin(ALLOT, DIVIDEND_ENTRY), 0).otherwise(one)),
        "sell_amt": (SELL, sell_amt), "sell_rake": (SELL, fees * rate),
    }
    return rows.groupBy("pty_id", F.col("stk_id").alias("prdt_id")).agg(
        *conditional_sums(direction, sums)
    )


def margin_product_profit(t: Tables, day) -> DataFrame:
    lo, before, key = month_begin(day), previous_month_end(day), ["pty_id", "prdt_id"]
    holdings = t["ms_cust_prdt_fc_hold_d"]
    active = (F.col("hold_cnt") != 0) | (F.col("deb_mnt") != 0)
    held = on_day(holdings, day).where(active).select(*key, held_days(day).alias("days"))
    closed = listed_days(t, t["ms_cust_prdt_fc_unhold_d"], lo, day).select(*key, closed_days(day).alias("days"))
    touched = held.unionByName(closed).groupBy(*key).agg(F.sum("days").alias("days"))

    d, b = as_date(day), before
    own = F.col("hold_cnt") - F.col("stc_deb_mnt")

    def at(when: Column, v: Column, name: str) -> Column:
        return F.sum(F.when(F.col("data_dt") == when, v).otherwise(F.lit(0))).alias(name)

    positions = holdings.where(F.col("data_dt").isin(b, d)).groupBy(*key).agg(
        at(b, own, "cnt_bgn"), at(d, own, "cnt_end"),
        at(b, F.col("mkt_val"), "val_bgn"), at(d, F.col("mkt_val"), "val_end"),
    )
    market = t["mf_prdt_mkt_d"]
    prices = market.where(F.col("data_dt").isin(b, d)).groupBy("prdt_id").agg(
        F.max(F.when(F.col("data_dt") == b, F.col("end_price"))).alias("px_bgn"),
        F.max(F.when(F.col("data_dt") == d, F.col("end_price"))).alias("px_end"),
    )
    interest = listed_days(t, holdings, lo, day).where(active).groupBy(*key).agg(
        F.sum("deb_int_d").alias("tran_fare")
    )
    rows = (
        touched.join(listed_products(t, day), "prdt_id").join(positions, key, "left")
        .join(prices, "prdt_id", "left").join(margin_month_trades(t, day), key, "left")
        .join(interest, key, "left")
    )
    z = {c: zero_if_null(F.col(c)) for c in rows.columns if c not in (*key, "prdt_type_id", "up_prdt_type_id")}
    flows = z["sell_amt"] - z["buy_amt"] - z["buy_rake"] - z["sell_rake"] - z["tran_fare"]
    by_value = z["val_end"] - z["val_bgn"] + flows
    by_price = z["cnt_end"] * z["px_end"] - z["cnt_bgn"] * z["px_bgn"] + flows
    return rows.select(
        *key, F.lit(MARGIN_ACCOUNT).alias("flag"), F.col("days").cast("bigint").alias("hold_days"),
        z["buy_cnt"].alias("buy_cnt"), z["sell_cnt"].alias("sell_cnt"),
        F.when(F.col("up_prdt_type_id") == BONDS, by_value).otherwise(by_price).alias("tran_pft"),
    )


def product_profit_month(t: Tables, day) -> DataFrame:
    """Holding days, trade counts and profit per (customer, product, account)."""
    ordinary = ordinary_product_profit(t, day)
    bonds = pledged_bond_profit(t, day, ordinary_products(t, day))
    margin = margin_product_profit(t, day)
    return ordinary.unionByName(bonds).unionByName(margin).withColumn("data_dt", as_date(day))


def wealth_products_month(t: Tables, day) -> DataFrame:
    """Wealth products held and traded per customer."""
    lo = month_begin(day)
    active = (F.col("hold_cnt") != 0) | (F.col("deb_mnt") != 0)
    wealth = valid_products(t, day).where(
        (F.col("prdt_type_id") == WEALTH) & (F.col("prdt_id") != CASH_FUND)
    ).select("prdt_id")
    key = ["pty_id", "prdt_id"]
    held = (
        on_day(t["ms_cust_prdt_hold_d"], day).select(*key)
        .unionByName(listed_days(t, t["ms_cust_prdt_unhold_d"], lo, day).select(*key))
        .unionByName(on_day(t["ms_cust_prdt_fc_hold_d"], day).where(active).select(*key))
        .unionByName(listed_days(t, t["ms_cust_prdt_fc_unhold_d"], lo, day).select(*key))
    )
    counts = held.join(wealth, "prdt_id").groupBy("pty_id").agg(
        F.countDistinct("prdt_id").alias("prdt_cnt")
    )
    trades = on_day(t["mf_cust_tran_core_m"], day).where(F.col("sys_source_cd").isin("02", "03")).join(
        wealth, "prdt_id"
    ).groupBy("pty_id").agg(F.sum("buy_cnt").alias("buy_cnt"), F.sum("sell_cnt").alias("sell_cnt"))
    return counts.join(trades, "pty_id", "full").select(
        as_date(day).alias("data_dt"), "pty_id", "prdt_cnt", "buy_cnt", "sell_cnt"
    )


def share_trades_day(t: Tables, day) -> DataFrame:
    """Share buy and sell counts per customer on one day, all accounts."""
    d = as_date(day)
    core = on_day(t["mf_cust_tran_core_d"], day).where(F.col("sys_source_cd") != "05").select(
        "pty_id", "prdt_id", "buy_cnt", "sell_cnt"
    )
    entered = on_day(t["sta_stk_jnls"], day).where(F.col("busi_cd").isin(*ENTRY_CODES_DAY)).select(
        "pty_id", F.col("stk_id").alias("prdt_id"),
        F.when(F.col("busi_cd") == SELL_ENTRY, 0).otherwise(1).alias("buy_cnt"),
        F.when(F.col("busi_cd") == SELL_ENTRY, 1).otherwise(0).alias("sell_cnt"),
    )
    moved = margin_trade_summary(t, d, day).select(
        "pty_id", "prdt_id", F.col("assure_out_cnt").alias("buy_cnt"), F.col("assure_in_cnt").alias("sell_cnt")
    )
    traded = F.when(F.col("busi_cd") == ALLOT, 0).otherwise(1)
    margin = on_day(t["sta_fc_jnls"], day).where(F.col("busi_cd").isin(*DAY_TRADE_CODES)).select(
        "pty_id", F.col("stk_id").alias("prdt_id"),
        F.when(F.col("tran_dir_cd") == BUY, traded).otherwise(0).alias("buy_cnt"),
        F.when(F.col("tran_dir_cd") == SELL, traded).otherwise(0).alias("sell_cnt"),
    )
    # per (customer, product) first: fewer rows meet the product dimension
    both = union_padded([core, entered, moved, margin], ["buy_cnt", "sell_cnt"]).groupBy(
        "pty_id", "prdt_id"
    ).agg(F.sum("buy_cnt").alias("buy_cnt"), F.sum("sell_cnt").alias("sell_cnt"))
    shares = valid_products(t, day).where(F.col("up_prdt_type_id") == SHARES).select("prdt_id")
    return both.join(shares, "prdt_id").groupBy("pty_id").agg(
        F.sum("buy_cnt").alias("buy_cnt"), F.sum("sell_cnt").alias("sell_cnt")
    ).withColumn("data_dt", d)
