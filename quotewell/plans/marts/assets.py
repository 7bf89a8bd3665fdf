"""Asset marts: month-end assets, assets per currency, margin assets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.numbers import floor_zero, ratio, zero_if_null
from quotewell.functions.times import as_date, asof_business_day, asof_valid, previous_month_end
from quotewell.operators.relational import union_padded

Tables = Mapping[str, DataFrame]

# Product and currency codes.
FOREIGN_SHARES, HOME_CCY, FOREIGN_RATE_CCY, SHARES = "PA040300", "401156", "401344", "PA040000"
SH_MARKETS, SZ_MARKETS = ("602010", "602040", "602050"), ("602020", "602030", "602060")
# Holding system -> asset column.
HOLDING_SYSTEMS = {
    "01": "stk_mkt_val", "04": "etf_mkt_val", "07": "lmt_mkt_val", "06": "dir_mkt_val",
    "05": "fc_mkt_val", "02": "fund_mkt_val", "03": "fina_mkt_val",
}
MARGIN_SYSTEM = "05"


def active_customers(t: Tables, day) -> DataFrame:
    return asof_valid(t["mf_cust_attr_h"], day).select("pty_id")


def at_two_dates(df: DataFrame, value: str, first, last, bgn: str, end: str) -> DataFrame:
    """One value at two dates per customer, in one scan of the two days."""
    a, b = as_date(first), as_date(last)
    two = df.where(F.col("data_dt").isin(a, b))

    def at(d: Column) -> Column:
        return F.sum(F.when(F.col("data_dt") == d, F.col(value)))

    return two.groupBy("pty_id").agg(at(a).alias(bgn), at(b).alias(end))


def assets_month(t: Tables, day) -> DataFrame:
    """Ordinary and margin assets at the run day and at the previous month end."""
    before = previous_month_end(day)
    tot = at_two_dates(t["ms_cust_aset_d"], "tot_aset", before, day, "tot_aset_bgn", "tot_aset_end")
    pur = at_two_dates(t["ms_cust_fc_aset_d"], "pur_aset", before, day, "pur_aset_bgn", "pur_aset_end")
    joined = active_customers(t, day).join(tot, "pty_id", "left").join(pur, "pty_id", "left")
    measures = ["tot_aset_end", "tot_aset_bgn", "pur_aset_end", "pur_aset_bgn"]
    return joined.select(
        as_date(day).alias("data_dt"), "pty_id", *[zero_if_null(F.col(c)).alias(c) for c in measures]
    )


def assets_by_currency(t: Tables, day) -> DataFrame:
    """Cash and holdings per (customer, currency), split by system and market."""
    d = as_date(day)
    cash = asof_valid(t["mf_cust_cash_h"], day).where(
        (F.col("bal") != 0) | (F.col("avl_amt") != 0) | (F.col("frz_amt") != 0) | (F.col("draw_amt") != 0)
    ).select("pty_id", "ccy", F.col("bal").alias("tot_aset"), "bal", "avl_amt", "frz_amt", "draw_amt")

    products = asof_valid(t["mf_prdt_attr_h"], day).select(
        "prdt_id", "prdt_type_id", "up_prdt_type_id", "market_id"
    )
    held = t["mf_cust_hold_d"].where(
        (F.col("data_dt") == d) & ((F.col("mkt_val") != 0) | (F.col("mkt_pft") != 0))
    )
    rate = t["view_conv_rmb"].where(
        (F.col("ccy") == FOREIGN_RATE_CCY) & (F.col("data_dt") == d)
    ).agg(F.max("exchange_rate").alias("exchange_rate"))  # one row: a single currency and day
    rows = held.join(products, "prdt_id").crossJoin(F.broadcast(rate))
    foreign = F.col("prdt_type_id") == FOREIGN_SHARES
    value = F.col("mkt_val") * F.when(foreign, F.coalesce("exchange_rate", F.lit(1))).otherwise(F.lit(1))
    share = F.col("up_prdt_type_id") == SHARES

    def when(condition: Column, v: Column) -> Column:
        return F.when(condition, v).otherwise(F.lit(0))

    holdings = rows.select(
        "pty_id",
        F.when(foreign, F.lit(HOME_CCY)).otherwise(F.col("ccy")).alias("ccy"),
        value.alias("tot_aset"), value.alias("tot_mkt_val"), "mkt_pft",
        *[when(F.col("sys_source_cd") == s, value).alias(c) for s, c in HOLDING_SYSTEMS.items()],
        when(F.col("market_id").isin(*SH_MARKETS) & share, F.col("mkt_val")).alias("sh_mkt_val"),
        when(F.col("market_id").isin(*SZ_MARKETS) & share, F.col("mkt_val")).alias("sz_mkt_val"),
    )
    measures = [
        "tot_aset", "tot_mkt_val", "bal", "avl_amt", "frz_amt", "draw_amt", "mkt_pft",
        *HOLDING_SYSTEMS.values(), "fund_in_transit", "sh_mkt_val", "sz_mkt_val",
    ]
    both = union_padded([cash, holdings], measures)
    sums = {m: F.sum(m) for m in measures}
    sums["fund_in_transit"] = floor_zero(sums["fund_in_transit"])
    return both.groupBy("pty_id", "ccy").agg(*[c.alias(m) for m, c in sums.items()]).withColumn(
        "data_dt", d
    )


# --- margin assets ---------------------------------------------------------

# Balances carried from the debt history, and the output order.
MARGIN_BALANCES = [
    "ass_bal", "bal", "cls_mkt_val", "cls_mkt_val_asur", "fina_deb", "stc_deb", "cls_fare_deb",
    "cls_oth_deb", "cls_fina_int", "cls_shtcel_int", "cls_fare_int", "cls_oth_int",
]
MARGIN_CASH = ["avl_amt", "frz_amt", "draw_amt"]


def open_flag(calendar: DataFrame, day) -> str:
    """'Y' when the run day is a business day or its flag is empty. One row."""
    row = calendar.where(F.col("data_dt") == as_date(day)).select(
        F.coalesce("tran_dt_flag", F.lit("Y"))
    ).first()
    return row[0] if row else "Y"


def recall_days(calendar: DataFrame, day) -> DataFrame:
    """(data_dt, recall_dt): the days since the last business day up to the run
    day, each with the business day its balances come from."""
    d = as_date(day)
    upto = calendar.where(F.col("data_dt") <= d)
    last = upto.where((F.col("data_dt") < d) & (F.coalesce("tran_dt_flag", F.lit("Y")) == "Y")).agg(
        F.max("data_dt").alias("_last")
    )
    return (
        asof_business_day(upto).crossJoin(F.broadcast(last))
        .where(F.col("data_dt") > F.col("_last")).select("data_dt", "recall_dt")
    )


def margin_assets(t: Tables, day) -> DataFrame:
    """On a business day: margin balances for every day since the last business
    day, balances from the as-of business day, interest from the day itself. On
    other days: the last business day's result under the run day."""
    calendar = t["meta_sor_tran_dt_def"]
    if open_flag(calendar, day) != "Y":
        d = as_date(day)
        last = calendar.where((F.col("data_dt") < d) & (F.col("tran_dt_flag") == "Y")).agg(
            F.max("data_dt").alias("data_dt")
        )
        prior = t["ms_cust_ccy_fc_aset_d"]
        return prior.join(F.broadcast(last), "data_dt", "left_semi").withColumn("data_dt", d)

    days = recall_days(calendar, day)
    on_recall = days.withColumnsRenamed({"data_dt": "_day", "recall_dt": "data_dt"})

    def recalled(name: str) -> DataFrame:
        # the day list is a handful of rows; it also prunes the day partitions
        return t[name].join(on_recall, "data_dt").drop("data_dt").withColumnRenamed("_day", "data_dt")

    owed = F.col("ass_bal") - F.col("pur_aset")
    balances = recalled("his_fc_aset_deb").where((F.col("ass_bal") != 0) | (owed != 0)).select(
        "data_dt", "pty_id", "ccy", *MARGIN_BALANCES, F.col("deb_amt").alias("aset_deb_amt"),
        owed.alias("tot_deb_amt"), "pur_aset", "pur_aset_bef", F.lit(1).alias("_balance"),
    )
    interest = (
        t["mf_cust_fc_hold_d"].where(F.col("sys_source_cd") == MARGIN_SYSTEM)
        .join(days.select("data_dt"), "data_dt")
        .select("data_dt", "pty_id", "ccy", F.col("fina_deb_int_d").alias("finance_inte_bal"),
                F.col("stc_deb_int_d").alias("shortsell_inte_bal"))
    )
    cash = recalled("his_aset_acct_fc").where(
        (F.col("avl_amt") != 0) | (F.col("frz_amt") != 0) | (F.col("draw_amt") != 0)
    ).select("data_dt", "pty_id", "ccy", *MARGIN_CASH)
    measures = [
        *MARGIN_BALANCES, "aset_deb_amt", "tot_deb_amt", "pur_aset", "pur_aset_bef",
        "finance_inte_bal", "shortsell_inte_bal", *MARGIN_CASH,
    ]
    stacked = union_padded([balances, interest, cash], [*measures, "_balance"])
    sums = stacked.groupBy("data_dt", "pty_id", "ccy").agg(
        *[F.sum(m).alias(m) for m in measures], F.max("_balance").alias("_balance")
    )
    rate = ratio(F.col("ass_bal"), F.col("tot_deb_amt"), 4, empty=-1)
    return sums.withColumn("close_rate", F.when(F.col("_balance") == 1, rate).otherwise(F.lit(0.0))).drop(
        "_balance"
    )
