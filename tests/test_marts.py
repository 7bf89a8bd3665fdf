from datetime import date
from decimal import Decimal as Dec

import pytest

from quotewell.plans.marts import assets, flows, monthly, products as p

D, B = date(2024, 3, 31), date(2024, 2, 29)
OPEN_END = date(2999, 12, 31)


@pytest.fixture
def table(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def customers(table):
    return table([("a", date(2020, 1, 1), OPEN_END), ("b", date(2020, 1, 1), OPEN_END), ("gone", date(2020, 1, 1), D)],
                 "pty_id string, bgn_dt date, end_dt date")


def as_map(df, *columns):
    return {r[0]: tuple(float(x) if x is not None else None for x in r[1:]) for r in df.select("pty_id", *columns).collect()}


def test_assets_and_validity(table, customers):
    t = {
        "mf_cust_attr_h": customers,
        "ms_cust_aset_d": table([(D, "a", 10), (B, "a", 4), (D, "gone", 1), (date(2024, 3, 30), "b", 9)], "data_dt date, pty_id string, tot_aset int"),
        "ms_cust_fc_aset_d": table([(B, "b", 3)], "data_dt date, pty_id string, pur_aset int"),
    }
    got = as_map(assets.assets_month(t, "20240331"), "tot_aset_bgn", "tot_aset_end", "pur_aset_bgn", "pur_aset_end")
    assert got == {"a": (4, 10, 0, 0), "b": (0, 0, 3, 0)}


def test_currency_assets_move_foreign_shares(table):
    money = "decimal(12,2)"
    t = {
        "mf_cust_cash_h": table([("a", "1", Dec(5), Dec(5), Dec(0), Dec(0), date(2020, 1, 1), OPEN_END)],
                                f"pty_id string, ccy string, bal {money}, avl_amt {money}, frz_amt {money}, draw_amt {money}, bgn_dt date, end_dt date"),
        "mf_cust_hold_d": table([(D, "a", "1", "x", "01", Dec(10), Dec(1)), (D, "a", "1", "y", "05", Dec(7), Dec(0)), (D, "a", "1", "y", "05", Dec(0), Dec(0))],
                                f"data_dt date, pty_id string, ccy string, prdt_id string, sys_source_cd string, mkt_val {money}, mkt_pft {money}"),
        "mf_prdt_attr_h": table([("x", "PA040300", "PA040000", "602020", date(2020, 1, 1), OPEN_END), ("y", "P", "Q", "602010", date(2020, 1, 1), OPEN_END),
                                 ("y", "old", "Q", "602010", date(2010, 1, 1), date(2020, 1, 1))],
                                "prdt_id string, prdt_type_id string, up_prdt_type_id string, market_id string, bgn_dt date, end_dt date"),
        "view_conv_rmb": table([(D, "401344", Dec("0.9"))], "data_dt date, ccy string, exchange_rate decimal(8,4)"),
    }
    rows = {r.ccy: r for r in assets.assets_by_currency(t, D).collect()}
    assert (rows["1"].tot_aset, rows["1"].fc_mkt_val, rows["1"].bal, rows["1"].sh_mkt_val) == (12, 7, 5, 0)
    assert (rows["401156"].tot_aset, rows["401156"].stk_mkt_val, rows["401156"].sz_mkt_val) == (9, 9, 10)
    t["view_conv_rmb"] = t["view_conv_rmb"].limit(0)  # no rate: 1
    assert {r.ccy: float(r.tot_aset) for r in assets.assets_by_currency(t, D).collect()} == {"1": 12.0, "401156": 10.0}


def calendar(table):
    flags = {28: "Y", 29: None, 30: "N", 31: "N"}
    return table([(date(2024, 3, d), f) for d, f in flags.items()] + [(date(2024, 4, 1), "Y")], "data_dt date, tran_dt_flag string")


def margin_tables(table):
    n = "decimal(12,2)"
    names = [c for c in assets.MARGIN_BALANCES if c != "ass_bal"]
    balance = lambda d, who, own, net: (d, who, "1", Dec(own), *[Dec(1)] * len(names), Dec(2), Dec(net), Dec(0))
    return {
        "meta_sor_tran_dt_def": calendar(table),
        "his_fc_aset_deb": table([balance(date(2024, 4, 1), "a", 10, 6), balance(date(2024, 3, 28), "a", 8, 8)],
                                 f"data_dt date, pty_id string, ccy string, ass_bal {n}, " + ", ".join(f"{c} {n}" for c in names)
                                 + f", deb_amt {n}, pur_aset {n}, pur_aset_bef {n}"),
        "mf_cust_fc_hold_d": table([(date(2024, 3, 30), "a", "1", "05", Dec(3), Dec(4)), (date(2024, 3, 30), "a", "1", "01", Dec(3), Dec(4))],
                                   f"data_dt date, pty_id string, ccy string, sys_source_cd string, fina_deb_int_d {n}, stc_deb_int_d {n}"),
        "his_aset_acct_fc": table([(date(2024, 4, 1), "b", "1", Dec(1), Dec(0), Dec(0)), (date(2024, 4, 1), "c", "1", Dec(0), Dec(0), Dec(0))],
                                  f"data_dt date, pty_id string, ccy string, avl_amt {n}, frz_amt {n}, draw_amt {n}"),
        "ms_cust_ccy_fc_aset_d": table([(date(2024, 3, 28), "a", 1.5), (date(2024, 3, 27), "a", 2.5)], "data_dt date, pty_id string, close_rate double"),
    }


def test_margin_assets_business_day(table):
    # the 29th has no flag and counts as the last business day; it has no own recall day
    got = {(str(r.data_dt), r.pty_id): r for r in assets.margin_assets(margin_tables(table), "20240401").collect()}
    assert sorted(got) == [("2024-03-30", "a"), ("2024-03-31", "a"), ("2024-04-01", "a"), ("2024-04-01", "b")]
    today = got["2024-04-01", "a"]
    assert (float(today.tot_deb_amt), today.close_rate) == (4.0, 2.5)
    weekend = got["2024-03-30", "a"]
    assert (float(weekend.ass_bal), weekend.close_rate, float(weekend.finance_inte_bal)) == (8.0, -1.0, 3.0)
    assert got["2024-04-01", "b"].close_rate == 0.0


def test_margin_assets_closed_day(table):
    got = assets.margin_assets(margin_tables(table), "20240331").collect()
    assert [(r.data_dt, r.close_rate) for r in got] == [(D, 1.5)]


def flow_tables(table, customers):
    return {
        "mf_cust_attr_h": customers,
        "ms_cust_info_ext_c": table([("a", "Y"), ("b", "Y"), ("gone", "Y")], "pty_id string, fc_flag string"),
        "vw_ms_cust_fc_tran_idx_d": table([(date(2024, 3, 1), "a", 100, 0), (date(2024, 3, 5), "a", 0, 30), (date(2024, 2, 5), "a", 7, 0)],
                                          "data_dt date, pty_id string, assure_in_amt int, assure_out_amt int"),
        "vw_ms_cust_fc_fin_idx_d": table([(date(2024, 3, 5), "a", 50, 0), (date(2024, 3, 2), "b", 0, 9)], "data_dt date, pty_id string, cash_in int, cash_out int"),
        "ms_cust_fc_aset_d": table([(B, "a", 200), (D, "a", 500)], "data_dt date, pty_id string, pur_aset int"),
    }


def test_flows_and_returns(table, customers):
    t = flow_tables(table, customers)
    assert as_map(flows.margin_io_month(t, D), "fin_in_amt", "fin_out_amt", "max_cost_fc") == {"a": (150, 30, 120), "b": (0, 9, 0)}
    assert as_map(flows.margin_io_year(t, D), "fin_in_amt", "max_cost_fc")["a"] == (157, 127)
    # (500 - 200 - 150 + 30) / (200 + 120); b divides by nothing
    assert as_map(flows.margin_profit_month(t, D), "aset_pft", "max_cost_rate") == {"a": (180, 0.5625), "b": (9, 0)}
    report = as_map(flows.margin_report_month(t, D), "pur_aset_bgn", "pur_aset_end", "aset_pft")
    assert report == {"a": (200, 500, 180), "b": (0, 0, 9)}
    assert as_map(flows.margin_report_month(t, D, begin="month_begin"), "pur_aset_bgn")["a"] == (0,)


def test_absurd_rates_drop_out(table, customers):
    t = flow_tables(table, customers)
    t["ms_cust_fc_aset_d"] = table([(B, "a", 1), (D, "a", 5000)], "data_dt date, pty_id string, pur_aset int")
    assert "a" not in as_map(flows.margin_profit_month(t, D), "aset_pft")


def test_holding_days(table):
    held = table([(D, date(2024, 2, 10)), (D, date(2024, 3, 30))], "data_dt date, hold_dt date")
    assert [r[0] for r in held.select(p.held_days(D)).collect()] == [31, 2]
    closed = table([(date(2024, 3, 10), 90), (date(2024, 3, 10), 4)], "data_dt date, hold_days int")
    assert [r[0] for r in closed.select(p.closed_days(D)).collect()] == [10, 4]


def test_margin_codes_listed_separately():
    # two codes that are easily run together
    assert {"406004216", "406004034"} <= set(p.MONTH_TRADE_CODES)


def test_index_gap_is_carried(table):
    t = {
        "meta_sor_tran_dt_def": table([(date(2024, 2, 28), "Y"), (B, "Y"), (date(2024, 3, 30), "Y"), (D, "Y")], "data_dt date, tran_dt_flag string"),
        "sta_gti_mkt_pnt": table([(date(2024, 2, 28), "000001", 100.0), (B, "000001", None), (date(2024, 3, 30), "000001", 110.0), (D, "9", 1.0)],
                                 "data_dt date, mkt_type_cd string, end_price double"),
    }
    assert monthly.index_return(t, D).first()[0] == 0.1


@pytest.mark.parametrize("rows,want", [
    ([(1, date(2024, 3, 20), 130, 100), (1, date(2024, 3, 2), 1, 100), (1, B, 120, 100), (2, D, 9, 9)], 130 / 120 - 1),
    ([(1, date(2024, 3, 20), 130, 100)], 0.3), ([(1, B, 120, 100)], None),
])
def test_portfolio_yield(table, rows, want):
    t = {"sta_port_simulationinfo": table(rows, "portid int, pubdate date, capitaltotal int, fundsizefirst int")}
    got = monthly.portfolio_yield(t, D).first()[0]
    assert got is None if want is None else got == pytest.approx(want)


def test_rank_share(table):
    df = table([("a", 5.0), ("b", 5.0), ("c", 1.0), ("d", 9.0)], "pty_id string, v double")
    assert as_map(monthly.rank_share(df, "v", "s", 2), "s") == {"d": (0.75,), "a": (0.5,), "b": (0.5,), "c": (0.0,)}
