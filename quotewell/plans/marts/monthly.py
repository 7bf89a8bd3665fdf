"""The monthly customer report: profit, return and rank, index and portfolio
yields, product-class profits, descriptive codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.numbers import ratio, zero_if_null
from quotewell.functions.times import as_date, month_begin, previous_month_end
from quotewell.operators.ordered import with_rank
from quotewell.operators.relational import carry_forward, keep_latest, union_padded, with_rate
from quotewell.plans.marts import products as p
from quotewell.plans.marts.assets import Tables
from quotewell.plans.marts.flows import with_profit

# The index followed, the portfolio reported, product classes.
INDEX, PORTFOLIO = "000001", 1
FUND_PARENT, WEALTH_PARENTS = "PA050000", ("PA090000", "PA100000")
BOOK_SYSTEMS = ("01", "02", "03", "04", "08")
OFF_EXCHANGE, MARGIN = "02", "05"
FUND_BUY, FUND_SELL = "406000143", "406000142"
INDUSTRY = "809050"
ENTRY_CODES = ("406004021", "406004022")


def index_return(t: Tables, day) -> DataFrame:
    """One row: index change from the previous month end to the run day, gaps
    filled with the last known close."""
    d, before = as_date(day), previous_month_end(day)
    days = t["meta_sor_tran_dt_def"].where(
        F.col("data_dt").between(F.date_sub(month_begin(day), 10), d)
    ).select("data_dt").distinct()
    closes = t["sta_gti_mkt_pnt"].where(F.col("mkt_type_cd") == INDEX).select("data_dt", "end_price")
    series = days.join(closes, "data_dt", "left").withColumn("mkt_type_cd", F.lit(INDEX))
    filled = carry_forward(series, ["mkt_type_cd"], "data_dt", "end_price", "level")

    def at(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("data_dt") == when, F.col("level"))), F.lit(0))

    return filled.agg(at(before).alias("_b"), at(d).alias("_e")).select(
        ratio(F.col("_e") - F.col("_b"), F.col("_b"), 4).alias("hs_300_rate")
    )


def portfolio_yield(t: Tables, day) -> DataFrame:
    """At most one row: the portfolio's last size this month against its last
    size before the month, or against its first size."""
    lo = month_begin(day)
    rows = t["sta_port_simulationinfo"].where(F.col("portid") == PORTFOLIO)

    def last(df: DataFrame, *columns: str) -> DataFrame:
        return df.groupBy("portid").agg(*[F.max_by(c, "pubdate").alias(f"{c}") for c in columns])

    now = last(rows.where((F.col("pubdate") >= lo) & (F.col("pubdate") < F.add_months(lo, 1))),
               "capitaltotal", "fundsizefirst")
    prior = last(rows.where(F.col("pubdate") < lo), "capitaltotal").withColumnRenamed("capitaltotal", "prior")
    base = F.coalesce("prior", "fundsizefirst").cast("double")
    change = F.col("capitaltotal").cast("double") - base
    return now.join(prior, "portid", "full").select((change / F.nullif(base, F.lit(0.0))).alias("jn_yield"))


def _classed(rows: DataFrame, classes: DataFrame, gain: Column) -> DataFrame:
    """Gain per customer and product class: wealth, fund off and on exchange."""
    met = rows.join(classes, "prdt_id").where(F.col("prdt_id") != p.CASH_FUND)
    wealth = (F.col("prdt_type_id") == p.WEALTH) | F.col("up_prdt_type_id").isin(*WEALTH_PARENTS)
    fund = (F.col("up_prdt_type_id") == FUND_PARENT) | (F.col("prdt_type_id") == p.SHARE_FUND)
    off = F.col("sys_source_cd") == OFF_EXCHANGE

    def total(condition: Column, name: str) -> Column:
        # the reporting tables keep four decimals
        return F.sum(F.when(condition, gain).otherwise(F.lit(0))).cast("decimal(20,4)").alias(name)

    return met.groupBy("pty_id").agg(
        total(wealth, "fina_tran_pft"), total(fund & off, "fund_tran_pft"), total(fund & ~off, "in_tran_pft")
    )


def product_classes(t: Tables, day) -> DataFrame:
    """Latest version per product valid at any time this month, reported classes only."""
    before = previous_month_end(day)
    rows = t["mf_prdt_attr_h"].where(
        (F.col("bgn_dt") <= as_date(day)) & (F.col("end_dt") > before)
        & (F.col("prdt_type_id").isin(p.SHARE_FUND, p.WEALTH)
           | F.col("up_prdt_type_id").isin(FUND_PARENT, *WEALTH_PARENTS))
    )
    return keep_latest(rows, ["prdt_id"], [F.desc("end_dt"), F.desc("bgn_dt")]).select(
        "prdt_id", "prdt_type_id", "up_prdt_type_id"
    )


def book_profit(t: Tables, day) -> DataFrame:
    """End value minus opening value."""
    lo, before, key = month_begin(day), previous_month_end(day), ["pty_id", "sys_source_cd", "prdt_id"]

    def holdings(at) -> DataFrame:
        rows = p.on_day(t["ms_cust_ccy_prdt_anahold_d"], at).where(F.col("sys_source_cd").isin(*BOOK_SYSTEMS))
        rows = with_rate(rows, t["view_conv_rmb"])
        return rows.select(*key, (F.col("mkt_val") * F.col("exchange_rate")).alias("value"))

    margin = F.lit(MARGIN).alias("sys_source_cd")
    own = t["ms_cust_prdt_fc_hold_d"]
    active = (F.col("hold_cnt") != 0) | (F.col("deb_mnt") != 0)
    touched = union_padded([
        holdings(day),
        p.listed_days(t, t["ms_cust_ccy_prdt_anaunhold_d"], lo, day).where(
            F.col("sys_source_cd").isin(*BOOK_SYSTEMS)).select(*key),
        p.on_day(own, day).where(active).select("pty_id", margin, "prdt_id", F.col("mkt_val").alias("value")),
        p.listed_days(t, t["ms_cust_prdt_fc_unhold_d"], lo, day).select("pty_id", margin, "prdt_id"),
    ], ["value"]).groupBy(*key).agg(F.sum("value").alias("value"))
    opening = holdings(before).unionByName(
        p.on_day(own, before).select("pty_id", margin, "prdt_id", F.col("mkt_val").alias("value"))
    ).groupBy(*key).agg(F.sum("value").alias("opening"))
    gain = F.col("value") - zero_if_null(F.col("opening"))
    return _classed(touched.join(opening, key, "left"), product_classes(t, day), gain)


def trade_profit(t: Tables, day) -> DataFrame:
    """Sells minus buys minus fees."""
    lo, key = month_begin(day), ["pty_id", "sys_source_cd", "prdt_id"]
    core = p.on_day(t["mf_cust_tran_core_m"], day).select(
        *key, "buy_amt", "sell_amt",
        (F.col("buy_rake") + zero_if_null(F.col("buy_fare"))).alias("buy_rake"),
        (F.col("sell_rake") + zero_if_null(F.col("sell_fare"))).alias("sell_rake"),
    )
    entered = p.entries(t, lo, day, ENTRY_CODES).select(*key, "buy_amt", "sell_amt")
    fin = with_rate(p.days_between(t["mf_cust_sys_fin_d"], lo, day), t["view_conv_rmb"], inner=True)
    rate = F.col("exchange_rate")
    corporate = fin.select(
        *key, ((F.col("tran_in") + F.col("allot_share_amt")) * rate).alias("buy_amt"),
        (F.col("bonus_amt") * rate + F.col("tran_out") * rate).alias("sell_amt"),
    )
    measures = ["buy_amt", "sell_amt", "buy_rake", "sell_rake"]
    rows = union_padded([core, entered, corporate], measures)
    # a missing amount counts as nothing, not as an unknown total
    z = {m: zero_if_null(F.col(m)) for m in measures}
    gain = z["sell_amt"] - z["buy_amt"] - z["buy_rake"] - z["sell_rake"]
    return _classed(rows, product_classes(t, day), gain)


def class_profit(t: Tables, day) -> DataFrame:
    both = book_profit(t, day).unionByName(trade_profit(t, day))
    return both.groupBy("pty_id").agg(
        *[F.sum(c).alias(c) for c in ("fina_tran_pft", "fund_tran_pft", "in_tran_pft")]
    )


def share_profit(t: Tables, day) -> DataFrame:
    """Share, restricted-share and bond profit from the product profit mart."""
    done = t.get("ms_cust_zl_prdt_pft_m")
    done = p.product_profit_month(t, day) if done is None else p.on_day(done, day)
    account, parent = F.substring("flag", 2, 2), F.col("up_prdt_type_id")
    normal = account.isin("01", "04", "05")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("tran_pft")).otherwise(F.lit(0))).alias(name)

    return done.join(p.valid_products(t, day), "prdt_id").groupBy("pty_id").agg(
        total((parent == p.SHARES) & normal, "gp_tran_pft"),
        total((parent == p.SHARES) & (account == "07"), "lmt_tran_pft"),
        total(parent.isin(p.BONDS, p.OTHERS) & normal, "zq_tran_pft"),
    )


def cash_fund_yield(t: Tables, day) -> DataFrame:
    rows = p.days_between(t["sta_fund_jnls"], month_begin(day), day).where(
        (F.col("fund_id") == p.CASH_FUND) & F.col("busi_cd").isin(FUND_BUY, FUND_SELL)
    )
    rows = with_rate(rows, t["view_conv_rmb"])
    signed = F.when(F.col("busi_cd") == FUND_SELL, -F.col("barg_cnt")).otherwise(F.col("barg_cnt"))
    return rows.groupBy("pty_id").agg(F.sum(signed * F.col("exchange_rate")).alias("pur_ttf_profit"))


def described(rows: DataFrame, code: str, codes: DataFrame, out: str) -> DataFrame:
    names = codes.select(F.col("code").alias(code), F.col("describe").alias(out))
    return rows.join(names, code, "left").select("pty_id", out)


def rank_share(df: DataFrame, value: str, out: str, ranges: int | None = None) -> DataFrame:
    """1 - rank / rows, best value first."""
    ranked = with_rank(df, value, "_rk", "_rows", ranges)
    return ranked.withColumn(out, F.lit(1.0) - F.col("_rk").cast("double") / F.col("_rows")).drop("_rk", "_rows")


def report_month(t: Tables, day) -> DataFrame:
    """One row per customer of the month's asset mart."""
    d, before = as_date(day), previous_month_end(day)
    assets = p.on_day(t["ms_cust_aset_m"], day)
    io = p.on_day(t["ms_cust_char_io_aset_m"], day).select(
        "pty_id", "in_aset_m", "out_aset_m", "max_cost_aset_m"
    )
    rows = with_profit(assets, io, "in_aset_m", "out_aset_m", "max_cost_aset_m")
    rows = rank_share(rows, "max_cost_rate", "max_cost_rate_num")

    tastes = described(
        p.on_day(t["ms_cust_char_rank_m"], day).where((F.col("char_id") == INDUSTRY) & (F.col("rank") == 1)),
        "char_value", t["sta_code"], "hold_idst_char",
    )
    risks = described(
        t["ms_cust_char_obj_h"].where((F.col("bgn_dt") <= d) & (F.col("end_dt") > d)),
        "risk_habit_cd2", t["sta_code"], "risk_habit_char",
    )
    last_month = p.on_day(t["ms_cust_zl_cost_m"], before).select("pty_id", F.col("aset_pft").alias("_prior"))
    # the yields are single rows by construction (one index, one portfolio)
    yields = index_return(t, day).join(portfolio_yield(t, day), F.lit(True), "left")
    rows = (
        rows.crossJoin(F.broadcast(yields))
        .join(tastes, "pty_id", "left").join(risks, "pty_id", "left")
        .join(p.on_day(t["ms_cust_char_aset_m"], day).select("pty_id", "avg_aset_scale_m"), "pty_id", "left")
        .join(p.on_day(t["ms_cust_char_tran_m"], day).select("pty_id", "stk_tran_cnt_m"), "pty_id", "left")
        .join(last_month, "pty_id", "left")
        .join(cash_fund_yield(t, day), "pty_id", "left")
        .join(share_profit(t, day), "pty_id", "left")
        .join(class_profit(t, day), "pty_id", "left")
    )
    z = {c: zero_if_null(F.col(c)) for c in (
        "_prior", "stk_tran_cnt_m", "avg_aset_scale_m", "jn_yield", "pur_ttf_profit", "fina_tran_pft",
        "fund_tran_pft", "in_tran_pft", "gp_tran_pft",
    )}
    return rows.select(
        d.alias("data_dt"), "pty_id",
        F.col("_bgn").alias("pur_aset_bgn"), F.col("_end").alias("pur_aset_end"),
        F.col("_in").alias("fin_in_amt"), F.col("_out").alias("fin_out_amt"),
        "aset_pft", "max_cost_rate", "max_cost_rate_num",
        z["stk_tran_cnt_m"].alias("stk_tran_cnt_m"), z["avg_aset_scale_m"].alias("avg_aset_scale_m"),
        "risk_habit_char", "hold_idst_char",
        ratio(F.col("aset_pft") - z["_prior"], z["_prior"], 4).alias("aset_pft_rate"),
        zero_if_null(F.col("hs_300_rate")).alias("hs_300_rate"), z["jn_yield"].alias("jn_yield"),
        z["pur_ttf_profit"].alias("pur_ttf_profit"), z["fina_tran_pft"].alias("pur_fina_profit"),
        (z["gp_tran_pft"] + z["in_tran_pft"]).alias("gp_tran_pft"),
        z["fund_tran_pft"].alias("fund_tran_pft"),
        # reported as zero since these products moved into the share column
        F.lit(0).alias("lmt_tran_pft"), F.lit(0).alias("zq_tran_pft"),
    )
