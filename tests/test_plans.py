from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quotewell.plans import daily, examine, publish, recon
from quotewell.sources import readers, sinks
from test_rules import DAY, build, level, snap, trade

PRODUCTS = [("000001", "2", "-", "Ping"), ("000002", "3", "01", "-")]


@pytest.fixture
def products(spark):
    return spark.createDataFrame(PRODUCTS, "prdtid string, sectype string, secsubtype string, symbol string")


def test_publish_trade_row(spark, products):
    df = build(spark, "trade", [trade(7, price=10.0005, tradeqty=1), trade(8, securityid="999999")])
    row = publish.publish_trades(df, products).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.MDDate, r.MDTime, r.FullSecurityID, r.SecurityIDSource) == (DAY, "100000000", "000001.SZ", "102")
    assert (r.SecuritySubType, r.Symbol, r.TradeType, r.TradeBSFlag, r.MDRecordType) == (None, "Ping", "0", "0", "2")
    assert float(r.TradeMoney) == 10.0 and r.ReceiveDateTime == f"{DAY}100000000"
    ms = int((datetime(2018, 3, 30, 10) - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert r.row_key[6:] == f"000001.SZ{2**63 - 1 - ms}{2**63 - 1 - 7}"
    flags = {f: publish.publish_trades(df, products, flag=f).first().TradeBSFlag for f in ("none", "derived")}
    assert flags == {"none": None, "derived": "2"}


def test_publish_snapshot_with_book(spark, products):
    snaps = build(spark, "snap", [
        snap(0, tradingphasecode="T0 ", totalofferqty="12.9", totalbidqty="5", prenav=1.5, realtimenav="NULL"),
        snap(0, securityid="000002", tradingphasecode="??", totalofferqty="1", totalbidqty="5", prenav=1.5, realtimenav="1.25"),
        snap(1, tradingphasecode="T0", totalofferqty="1", totalbidqty="1"),
    ])
    books = build(spark, "snap_level", [level(0, orderqty_b1="100|200", orderqty_s1=" "), level(0, securityid="000002")])
    out = {r.SecurityID: r for r in publish.publish_snapshots(snaps, products, books).collect()}
    stock, fund = out["000001"], out["000002"]
    assert (stock.TradingPhaseCode, stock.TotalOfferQty, stock.IOPV, stock.PreIOPV) == ("3", 12, None, None)
    assert stock.Buy1OrderDetail == [100.0, 200.0] and stock.Sell1OrderDetail is None and stock.Buy2Price == 18.0
    assert (fund.TradingPhaseCode, fund.phase_rejected, fund.IOPV, fund.PreIOPV) == (None, True, "1.25", 1.5)
    assert publish.publish_snapshots(snaps, products, books, sectype="3").count() == 1


def test_publish_orders_and_index(spark, products):
    orders = build(spark, "order", [dict(
        securityid="000001", origtime=f"{DAY}093000000", applseqnum=1, ordertype="U", side="G", price=1.0, orderqty=2,
        expirationtype=3, contactor="NULL", contactinfo=None, confirmid="c")])
    r = publish.publish_orders(orders, products).first()
    assert (r.OrderType, r.OrderBSFlag, r.ExpirationType, r.Contactor, r.ContactInfo, r.ConfirmID) == ("3", "1", "3", None, None, "c")
    assert publish.publish_orders(orders, products, side_mode="lending").first().OrderBSFlag == "3"
    index = build(spark, "index", [dict(securityid="000001", origtime=f"{DAY}120000000", tradingphasecode="T0", lowpx="1.5")])
    r = publish.publish_index(index, products).first()
    assert (r.TradingPhaseCode, r.LowPx, r.MDRecordType) == ("4", 1.5, "1")
    assert publish.publish_index(index, products, window=("090000000", "100000000")).isEmpty()


def test_sh_trades_are_numbered(spark, products):
    rows = [dict(securityid="000001", tradetime=f"20140102{t}", price="1", tradeqty="1", tradeamount="1",
                 bidapplseqnum=b, offerapplseqnum="5") for t, b in (("0930000100", "9"), ("0930000000", "1"), ("0930000000", "1"))]
    out = publish.publish_trades(build(spark, "trade", rows, "sh"), products, "sh").orderBy("TradeIndex").collect()
    assert [(r.TradeIndex, r.TradeBSFlag, r.MDTime) for r in out] == [(1, "2", "093000000"), (2, "2", "093000000"), (3, "1", "093000001")]
    assert out[0].FullSecurityID == "000001.SH" and len({r.row_key for r in out}) == 3


def sides(spark):
    files = build(spark, "trade", [
        trade(1), trade(1), trade(2), trade(2), trade(3), trade(4, origtime=f"{DAY}120000000"),
    ])
    store = build(spark, "trade", [trade(3), trade(9), trade(1, securityid="000002")])
    return files, store


def test_reconcile_identities(spark):
    files, store = sides(spark)
    got = recon.summary(recon.key_counts(files, store, recon.KEYS["trade"])).first()
    assert (got.n_file, got.n_store, got.n_common, got.n_file_only, got.n_store_only, got.status) == (6, 2, 1, 5, 1, "OK")
    wide = recon.summary(recon.key_counts(files, store, recon.KEYS["trade"], scope="all")).first()
    assert (wide.n_store, wide.n_store_only) == (3, 2)
    sessions = recon.summary(recon.key_counts(files, store, recon.KEYS["trade"], ((90000000, 113000000),))).first()
    assert sessions.n_file == 5
    empty = recon.summary(recon.key_counts(files.limit(0), store, recon.KEYS["trade"])).first()
    assert (empty.n_file, empty.n_store, empty.status) == (0, 0, "CHECK")


def test_one_sided_keeps_copies(spark):
    files, store = sides(spark)
    counts = recon.key_counts(files, store, recon.KEYS["trade"])
    assert sorted(r.applseqnum for r in recon.one_sided(counts).collect()) == [1, 1, 2, 2, 4]
    assert sorted(r.applseqnum for r in recon.one_sided(counts, copies=False).collect()) == [1, 2, 4]
    assert [r.applseqnum for r in recon.one_sided(counts, "store").collect()] == [9]


def test_stored_days_outside_the_files_do_not_count(spark, products, tmp_path):
    files, store = sides(spark)
    other = build(spark, "trade", [trade(1, origtime=f"20180{m}30100000000") for m in (1, 3, 5)])
    history = store.unionByName(other.where("trade_date <> date'2018-03-30'"))
    got = recon.reconcile({"trade": files}, {"trade": history}).collect()
    assert [(str(r.trade_date), r.n_store) for r in got] == [("2018-03-30", 2)]
    path = str(tmp_path / "store")
    sinks.upsert(publish.publish_trades(history, products), path, ["trade_date", "row_key"])
    counts = recon.key_counts(files, spark.read.parquet(path).withColumnsRenamed({"SecurityID": "securityid", "TradeIndex": "applseqnum"}), ["trade_date", *recon.KEYS["trade"]])
    scan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in scan and "2018-03-30" in scan.split("PartitionFilters: ")[-1][:200] or "17620" in scan
    before = spark.read.parquet(path).where("trade_date <> date'2018-03-30'").count()
    daily.run_day({"trade": files}, {"trade": path}, products, str(tmp_path / "out"), insert=True)
    assert spark.read.parquet(path).where("trade_date <> date'2018-03-30'").count() == before
    assert daily.run_day({"trade": files}, {"trade": path}, products, str(tmp_path / "none"), days=[date(2018, 1, 30)]) == []


def test_backfill_from_saved_difference(spark, products, tmp_path):
    files, _ = sides(spark)
    (tmp_path / "saved.txt").write_text(f"[000001.SZ,{DAY}100000000,2]\n")
    saved = readers.read_diff(spark, str(tmp_path / "saved.txt"), "trade")
    with pytest.raises(ValueError):
        recon.backfill("trade", files, saved.drop("ts"), products)
    out = recon.backfill_saved({"trade": saved, "order": None}, {"trade": files}, products)
    assert list(out) == ["trade"] and [r.TradeIndex for r in out["trade"].collect()] == [2, 2]


def test_daily_chain_fills_the_store(spark, products, tmp_path):
    files, _ = sides(spark)
    path, out = str(tmp_path / "store"), str(tmp_path / "out")
    sinks.upsert(publish.publish_trades(files.where("applseqnum = 3"), products), path, ["trade_date", "row_key"])
    feeds = {"trade": files, "order": files.limit(0)}
    assert daily.run_day(feeds, {"trade": path}, products, out, insert=True) == ["trade"]
    assert spark.read.parquet(path).count() == 3  # 12:00 lies outside the sessions
    assert daily.run_day(feeds, {"trade": path}, products, out, insert=True) == ["trade"]
    stats = sorted((r.n_file_only, r.n_common) for r in spark.read.parquet(f"{out}/stats").collect())
    assert stats == [(0, 3)]  # the second run's, in place of the first's
    assert spark.read.parquet(f"{out}/trade/file_only").isEmpty()


def test_flag_revision(spark, products, tmp_path):
    files = build(spark, "trade", [trade(1, bidapplseqnum=9), trade(2), trade(3, bidapplseqnum=2), trade(4, price=0.0)])
    path = str(tmp_path / "store")
    sinks.upsert(publish.publish_trades(files, products), path, ["trade_date", "row_key"])
    sinks.upsert_columns(recon.revised_flags(files), path, ["row_key"], ["TradeBSFlag"])
    got = {r.TradeIndex: r.TradeBSFlag for r in spark.read.parquet(path).collect()}
    assert got == {1: "1", 2: "2", 3: "0", 4: "0"}


def test_reconcile_report_by_feed(spark):
    files, store = sides(spark)
    got = recon.reconcile({"trade": files}, {"trade": store}).collect()
    assert [(r.feed, r.trade_date, r.n_common) for r in got] == [("trade", date(2018, 3, 30), 1)]


def test_bond_and_fund_chain(spark, products, tmp_path):
    codes = dict(tradingphasecode="T0", totalofferqty="1", totalbidqty="1")
    snaps = build(spark, "snap", [snap(0, securityid="000002", **codes), snap(1, securityid="000002", **codes), snap(0, **codes)])
    books = build(spark, "snap_level", [level(i, securityid="000002") for i in (0, 1)])
    path, out = str(tmp_path / "fund"), str(tmp_path / "out")
    first = publish.publish_snapshots(snaps.where("origtime like '%100000000'"), products, books, sectype="3")
    sinks.upsert(first, path, ["trade_date", "row_key"])
    ran = daily.run_day({"fund": snaps}, {"fund": path}, products, out, books, insert=True, chain=daily.BOND_FUND_CHAIN)
    stats = spark.read.parquet(f"{out}/stats").first()
    assert ran == ["fund"] and (stats.n_file, stats.n_common, stats.n_file_only) == (2, 1, 1)
    assert spark.read.parquet(path).count() == 2


def test_examine_store(spark, products):
    codes = dict(tradingphasecode="T0", totalofferqty="1", totalbidqty="1", peratio1=1.0, peratio2=1.0, pxchange1=0.0,
                 pxchange2=0.0, weightedavgbidpx=1.0, weightedavgofferpx=1.0)
    snaps = build(spark, "snap", [snap(0, **codes), snap(1, **codes, ), snap(2, **{**codes, "weightedavgbidpx": float("nan")})])
    snaps = snaps.withColumn("totalvolumetrade", F.when(F.col("ts") > "2018-03-30 10:00:01", 7).otherwise(F.col("totalvolumetrade")))
    books = build(spark, "snap_level", [
        level(i, bidpx10=0.0, numorders_b1=1, noorders_b1=1, numorders_s1=1, noorders_s1=1) for i in range(3)])
    store = publish.publish_snapshots(snaps, products, books)
    found = {r.rule: r.n for r in examine.examine(store).where("n > 0").collect()}
    assert found == {"blank:WeightedAvgBidPx": 1, "level_qty_without_price": 3, "totalvolumetrade_falls": 1}
