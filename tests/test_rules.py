from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotewell.operators import clean, rules
from quotewell.sources.readers import normalize
from quotewell.sources.schemas import FEEDS

DAY = "20180330"


def build(spark, feed, records, fmt="new"):
    """Raw rows from dicts (missing columns null), normalized."""
    schema = FEEDS[fmt][feed]
    raw = spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in records], schema)
    return normalize(raw, feed, fmt)


def counts(df):
    return {r.rule: r.n for r in df.collect()}


def snap(i=0, **over):
    base = dict(securityid="000001", origtime=f"{DAY}1000{i:02d}000", preclosepx=10.0, lastpx=10.0, openpx=10.0,
                highpx=11.0, lowpx=9.0, numtrades=10 + i, totalvolumetrade=100 + i, totalvaluetrade=1000.0 + i,
                uplimitpx=12.0, downlimitpx=8.0)
    return {**base, **over}


def test_snapshot_row_rules(spark):
    df = build(spark, "snap", [
        snap(0), snap(1, preclosepx=-1.0), snap(2, openpx=100000000.0), snap(3, highpx=9.5),
        snap(4, lowpx=10.5), snap(5, numtrades=-1), snap(6, lastpx=12.5, highpx=13.0), snap(7, lastpx=0.0, lowpx=0.0),
    ])
    got = counts(rules.count_rows(df, rules.row_rules("snap")))
    assert got == {"snap_price_range": 4, "snap_negative_totals": 1, "snap_outside_high_low": 2, "snap_outside_limits": 1}


def test_detail_lists_offenders_only(spark):
    df = build(spark, "snap", [snap(0), snap(1, securityid="000002", preclosepx=-1.0)])
    got = rules.count_rows(df, rules.row_rules("snap"), detail=True).collect()
    assert [(r.securityid, r.rule, r.n) for r in got] == [("000002", "snap_price_range", 1)]


@pytest.mark.parametrize("mode,want", [("any", 4), ("all", 0)])
def test_counters_any_and_all(spark, mode, want):
    df = build(spark, "snap", [
        snap(0), snap(1, numtrades=5), snap(2, numtrades=20),
        snap(2, numtrades=4, totalvolumetrade=90, totalvaluetrade=900.0),  # same time, everything falls
        snap(3, numtrades=30, totalvaluetrade=800.0, totalvolumetrade=200),
    ])
    got = rules.count_breaks(df, "r", ["ts"], falls=rules.COUNTERS, not_rising=["ts"], mode=mode)
    # two rows share 10:00:02; ties sort by the counters, so the lower one comes first
    assert counts(got)["r"] == want


def test_all_mode_needs_every_condition(spark):
    day = date(2018, 3, 30)
    df = spark.createDataFrame(
        [(day, "s", 1, 5, 5), (day, "s", 2, 4, 4), (day, "s", 3, 3, 9)], "trade_date date, securityid string, q int, a int, b int"
    )
    assert counts(rules.count_breaks(df, "r", ["q"], falls=["a", "b"], mode="all")) == {"r": 1}
    assert counts(rules.count_breaks(df, "r", ["q"], falls=["a", "b"])) == {"r": 2}


def test_copies_count_as_not_rising(spark):
    day = date(2018, 3, 30)
    rows = [(day, "s", 1, 1)] * 5 + [(day, "s", 2, 2)]
    df = spark.createDataFrame(rows, "trade_date date, securityid string, q int, t int")
    assert counts(rules.count_breaks(df, "r", ["q"], falls=["t"], not_rising=["q"])) == {"r": 4}
    assert counts(rules.count_breaks(df, "r", ["q"], falls=["t", "q"])) == {"r": 0}


def test_time_fall_tolerance(spark):
    def order(recno, clock):
        return dict(securityid="1", tradedate=DAY, orderentrytime=clock, recno=recno, price=1.0, orderqty=1,
                    functioncode="B", orderkind="0")

    df = build(spark, "order", [order(1, 93010000), order(2, 93009001), order(3, 93008000), order(4, 93010000)], "old")
    got = rules.count_breaks(df, "r", ["applseqnum"], falls={"applseqnum": 0, "clock": 1000})
    assert counts(got) == {"r": 1}  # 999 is tolerated, 1001 is not
    assert [r.applseqnum for r in clean.clean_orders(df).orderBy("applseqnum").collect()] == [1, 2, 4]


def test_high_low_ignore_zero(spark):
    df = build(spark, "snap", [snap(0), snap(1, highpx=0.0, lowpx=0.0), snap(2, highpx=10.5, lowpx=9.0),
                               snap(3, highpx=10.4, lowpx=9.1)])
    got = rules.count_breaks(df, "r", ["ts"], falls=["highpx"], rises=["lowpx"], nonzero=True)
    assert counts(got) == {"r": 2}  # 9.0 after 0.0 rises, then both move back


def level(i=0, **over):
    base = dict(securityid="000001", origtime=f"{DAY}1000{i:02d}000")
    for k in range(1, 11):
        base |= {f"bidpx{k}": 20.0 - k, f"bidsize{k}": 5, f"offerpx{k}": 20.0 + k, f"offersize{k}": 5}
    return {**base, **over}


def test_book_rules(spark):
    df = build(spark, "snap_level", [
        level(0), level(1, bidsize3=0), level(2, offerpx10=0.0), level(3, bidpx5=0.0, bidsize5=0),
        level(4, bidpx2=18.0, bidpx3=18.0), level(5, bidpx1=22.0), level(6, offerpx4=0.0, offersize4=0),
        level(7, origtime=f"{DAY}120000000", bidsize1=0),
    ])
    got = counts(rules.count_rows(df, rules.row_rules("snap_level")))
    assert got == {"level_price_without_qty": 1, "level_qty_without_price": 1, "level_order": 4}
    assert clean.clean_book(df).count() == 6


def trade(seq, **over):
    base = dict(securityid="000001", origtime=f"{DAY}100000000", applseqnum=seq, bidapplseqnum=1, offerapplseqnum=2,
                exectype="F", price=10.0, tradeqty=5)
    return {**base, **over}


def test_trade_order_and_reference_rules(spark):
    trades = build(spark, "trade", [
        trade(1), trade(2, price=0.0), trade(3, exectype="4", price=0.0), trade(4, bidapplseqnum=0, offerapplseqnum=9),
        trade(5, origtime=f"{DAY}095900000"), trade(5, origtime=f"{DAY}100100000"),
    ])
    orders = build(spark, "order", [
        dict(securityid="000001", origtime=f"{DAY}093000000", applseqnum=n, price=p, orderqty=q)
        for n, p, q in ((1, 10.0, 1), (2, -1.0, 1), (3, -2.0, 1), (4, 5.0, -1), (5, -1.0, -1))
    ])
    assert counts(rules.count_rows(trades, rules.row_rules("trade"))) == {"trade_range": 1}
    assert counts(rules.count_rows(orders, rules.row_rules("order"))) == {"order_range": 2}
    assert counts(rules.missing_reference(trades, orders)) == {"trade_without_order": 1}
    seq = rules.count_breaks(trades, "r", ["applseqnum"], falls=["ts"], not_rising=["applseqnum"])
    assert counts(seq) == {"r": 2}


@pytest.mark.parametrize("mode,want", [("any", 2), ("all", 1)])
def test_sum_vs_total(spark, mode, want):
    trades = build(spark, "trade", [trade(i, securityid=s) for s in ("a", "b", "c") for i in (1, 2)])
    snaps = build(spark, "snap", [
        snap(0, securityid="a", totalvolumetrade=10, totalvaluetrade=100.0),
        snap(0, securityid="b", totalvolumetrade=10, totalvaluetrade=101.0),
        snap(0, securityid="c", totalvolumetrade=11, totalvaluetrade=101.0),
    ])
    assert counts(rules.sum_vs_total(trades, snaps, mode=mode)) == {"trade_sum_vs_total": want}


def test_blank_cells_and_closed_days(spark):
    df = spark.createDataFrame(
        [(date(2018, 3, 31), "x", "1", 90000000), (date(2018, 3, 31), " ", "NaN", 180000000),
         (date(2018, 4, 2), None, "2", 90000000)],
        "trade_date date, a string, b string, clock bigint",
    )
    got = {(r.trade_date.day, r.rule): r.n for r in rules.blank_cells(df, ["a", "b"]).collect()}
    assert got == {(31, "blank:a"): 1, (31, "blank:b"): 1, (2, "blank:a"): 1, (2, "blank:b"): 0}
    closed = spark.createDataFrame([(date(2018, 3, 31),)], "trade_date date")
    assert counts(rules.on_closed_days(df, closed)) == {"non_trading_day": 1}


def test_report_runs_every_feed(spark):
    feeds = {
        "snap": build(spark, "snap", [snap(0), snap(1)]), "snap_level": build(spark, "snap_level", [level(0)]),
        "order": build(spark, "order", [dict(securityid="1", origtime=f"{DAY}100000000", applseqnum=1, price=1.0, orderqty=1)]),
        "trade": build(spark, "trade", [trade(1)]),
        "index": build(spark, "index", [dict(securityid="1", origtime=f"{DAY}100000000", lowpx="-1", lastpx=1.0,
                                             preclosepx=1.0, openpx=1.0, highpx=1.0, totalvolumetrade=1, totalvaluetrade=1.0)]),
    }
    got = counts(rules.report(feeds))
    assert got["index_price_range"] == 1 and got["trade_without_order"] == 1 and len(got) == 18


def old_snap(clock, numtrades, volume, last=10.0):
    return dict(securityid="1", tradedate=DAY, datatimestamp=clock, preclosepx=10.0, openpx=10.0, highpx=11.0, lowpx=9.0,
                lastpx=last, numtrades=numtrades, totalvolumetrade=volume, totalvaluetrade=1.0)


def test_cleaning_snapshots_is_idempotent(spark):
    df = build(spark, "snap", [
        old_snap(93000000, 1, 10), old_snap(93003000, 5, 9), old_snap(93006000, 6, 20, last=99.0), old_snap(93009000, 7, 30),
        old_snap(92000000, 0, 5), old_snap(92003000, 0, 1),  # falls before continuous trading: kept
    ], "old")
    once = clean.clean_snapshots(df)
    assert sorted(r.datatimestamp for r in once.collect()) == [92000000, 92003000, 93000000, 93009000]
    assert clean.clean_snapshots(once).count() == once.count()
    double = df.unionByName(df.withColumn("totalvolumetrade", F.col("totalvolumetrade") + 1))
    best = clean.latest_snapshots(double)
    assert best.count() == 6 and best.agg(F.sum("totalvolumetrade")).first()[0] == 10 + 9 + 20 + 30 + 5 + 1 + 6


@pytest.mark.parametrize("ranges", [2, 300])
def test_cleaning_one_hot_security(spark, ranges):
    start = datetime(2018, 3, 30, 9, 30)
    rows = []
    for i in range(400):
        at = start + timedelta(seconds=i)
        rows.append(dict(securityid="1", tradedate=DAY, tradetime=int(at.strftime("%H%M%S")) * 1000, recno=i if i % 50 else i // 2,
                         buyorderrecno="1", sellorderrecno="2", functioncode="0", orderkind="0", price=1.0, tradeqty=1))
    df = build(spark, "trade", rows + rows[:7], "old")
    plain = clean.clean_trades(df)
    cut = clean.clean_trades(df, ranges=ranges)
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()
    assert 0 < plain.count() < df.count()
