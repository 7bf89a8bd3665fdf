"""Publishing a feed: product join, vendor codes, row key, one wide row per key.

Output names follow the serving table. The full-id column is called
``FullSecurityID`` unless ``id_column`` says otherwise. A null is an absent cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions import codes
from quotewell.functions.arrays import nonzero_list, pipe_list
from quotewell.functions.keys import row_key
from quotewell.functions.numbers import drop_dash, drop_null_word, trade_money, whole_part
from quotewell.functions.times import date8, in_window
from quotewell.operators.copies import with_row_number
from quotewell.sources.schemas import DEPTH, QUEUE

DAY, SECURITY = "trade_date", "securityid"
FUND = codes.SECURITY_TYPES["fund"]

# Feed column -> serving-table column.
SNAP_COLUMNS = {
    "preclosepx": "PreClosePx", "numtrades": "NumTrades", "totalvolumetrade": "TotalVolumeTrade",
    "totalvaluetrade": "TotalValueTrade", "lastpx": "LastPx", "openpx": "OpenPx", "highpx": "HighPx",
    "lowpx": "LowPx", "weightedavgbidpx": "WeightedAvgBidPx", "weightedavgofferpx": "WeightedAvgOfferPx",
}
SNAP_NEW_COLUMNS = {
    "pxchange1": "DiffPx1", "pxchange2": "DiffPx2", "uplimitpx": "MaxPx", "downlimitpx": "MinPx",
    "peratio1": "SLYOne", "peratio2": "SLYTwo", "mdstreamid": "MDStreamID",
}
SNAP_OLD_COLUMNS = {"peratio1": "SLYOne", "peratio2": "SLYTwo"}
SNAP_SH_COLUMNS = {
    "withdrawbuynumber": "WithdrawBuyNumber", "withdrawbuyamount": "WithdrawBuyAmount",
    "withdrawbuymoney": "WithdrawBuyMoney", "withdrawsellnumber": "WithdrawSellNumber",
    "withdrawsellamount": "WithdrawSellAmount", "withdrawsellmoney": "WithdrawSellMoney",
    "totalbidnumber": "TotalBidNumber", "totaloffernumber": "TotalOfferNumber",
    "bidtrademaxduration": "BidTradeMaxDuration", "offertrademaxduration": "OfferTradeMaxDuration",
    "numbidorders": "NumBidOrders", "numofferorders": "NumOfferOrders",
}
INDEX_COLUMNS = {
    "preclosepx": "PreClosePx", "totalvolumetrade": "TotalVolumeTrade", "totalvaluetrade": "TotalValueTrade",
    "lastpx": "LastPx", "openpx": "OpenPx", "highpx": "HighPx", "lowpx": "LowPx",
}


def _renamed(df: DataFrame, names: dict[str, str]) -> list[Column]:
    return [F.col(c).alias(n) for c, n in names.items() if c in df.columns]


def with_products(df: DataFrame, products: DataFrame, sectype: str | None = None) -> DataFrame:
    """Inner join to the product dimension, unhinted: broadcast only when its
    measured size allows, otherwise a shuffled join that AQE can split."""
    if sectype is not None:
        products = products.where(F.col("sectype") == sectype)
    return df.join(products.withColumnRenamed("prdtid", SECURITY), SECURITY)


def _common(df: DataFrame, record: str, exchange: str, zone: str, id_column: str,
            seq: Column | None = None) -> list[Column]:
    ex = codes.EXCHANGES[exchange]
    full = F.concat(F.col(SECURITY), F.lit(ex["suffix"]))
    return [
        F.col(DAY),
        F.col("ts"),
        row_key(full, F.col("ts"), seq, zone).alias("row_key"),
        date8(F.col(DAY)).alias("MDDate"),
        F.lpad(F.col("clock").cast("string"), 9, "0").alias("MDTime"),
        F.col(SECURITY).alias("SecurityID"),
        full.alias(id_column),
        F.lit(ex["source"]).alias("SecurityIDSource"),
        F.col("sectype").alias("SecurityType"),
        drop_dash(F.col("secsubtype")).alias("SecuritySubType"),
        drop_dash(F.col("symbol")).alias("Symbol"),
        F.lit("1").alias("MDLevel"),
        F.lit(ex["channel"]).alias("MDChannel"),
        F.lit(codes.RECORD_TYPES[record]).alias("MDRecordType"),
    ]


def _received(df: DataFrame) -> list[Column]:
    raw = next((c for c in ("origtime", "tradetime") if c in df.columns), None)
    return [F.col(raw).cast("string").alias("ReceiveDateTime")] if raw else []


def _book(df: DataFrame, fmt: str) -> list[Column]:
    out = []
    for i in range(1, DEPTH + 1):
        out += [
            F.col(f"bidpx{i}").alias(f"Buy{i}Price"), F.col(f"bidsize{i}").alias(f"Buy{i}OrderQty"),
            F.col(f"offerpx{i}").alias(f"Sell{i}Price"), F.col(f"offersize{i}").alias(f"Sell{i}OrderQty"),
        ]
        if fmt == "sh":
            out += [F.col(f"bid{i}numorders").alias(f"Buy{i}NumOrders"),
                    F.col(f"offer{i}numorders").alias(f"Sell{i}NumOrders")]
    if fmt == "sh":
        buy = nonzero_list([F.col(f"bid1orders{i}") for i in range(1, QUEUE + 1)])
        sell = nonzero_list([F.col(f"offer1orders{i}") for i in range(1, QUEUE + 1)])
        out += [
            F.size(buy).alias("Buy1NoOrders"), buy.alias("Buy1OrderDetail"),
            F.size(sell).alias("Sell1NoOrders"), sell.alias("Sell1OrderDetail"),
        ]
    else:
        out += [
            F.col("numorders_b1").alias("Buy1NumOrders"), F.col("noorders_b1").alias("Buy1NoOrders"),
            pipe_list(F.col("orderqty_b1")).alias("Buy1OrderDetail"),
            F.col("numorders_s1").alias("Sell1NumOrders"), F.col("noorders_s1").alias("Sell1NoOrders"),
            pipe_list(F.col("orderqty_s1")).alias("Sell1OrderDetail"),
        ]
    return out


def join_book(snaps: DataFrame, books: DataFrame) -> DataFrame:
    """Snapshot and book rows of the same security and time."""
    key = [DAY, SECURITY, "ts"]
    extra = [c for c in books.columns if c not in snaps.columns or c in key]
    return snaps.join(books.select(*extra), key)


def publish_snapshots(snaps: DataFrame, products: DataFrame, books: DataFrame | None = None,
                      fmt: str = "new", sectype: str | None = None, zone: str = "UTC",
                      id_column: str = "FullSecurityID") -> DataFrame:
    """Snapshot joined with its book. SH rows carry their book themselves."""
    df = snaps if books is None else join_book(snaps, books)
    df = with_products(df, products, sectype)
    extra: list[Column] = []
    if fmt == "new":
        fund = F.col("sectype") == FUND
        phase = codes.phase_sz(F.col("tradingphasecode"), F.col("clock"))
        extra += _renamed(df, SNAP_NEW_COLUMNS) + [
            phase.alias("TradingPhaseCode"),
            codes.is_unmapped(F.col("tradingphasecode"), phase).alias("phase_rejected"),
            whole_part(F.col("totalbidqty")).alias("TotalBidQty"),
            whole_part(F.col("totalofferqty")).alias("TotalOfferQty"),
            F.when(fund, drop_null_word(F.col("realtimenav"))).alias("IOPV"),
            F.when(fund, F.col("prenav")).alias("PreIOPV"),
        ]
    elif fmt == "sh":
        phase = codes.phase_sh(F.col("instrumentstatus"))
        extra += _renamed(df, SNAP_SH_COLUMNS) + [
            phase.alias("TradingPhaseCode"),
            codes.is_unmapped(F.col("instrumentstatus"), phase).alias("phase_rejected"),
            F.col("totalbidqty").cast("bigint").alias("TotalBidQty"),
            F.col("totalofferqty").cast("bigint").alias("TotalOfferQty"),
            F.when(F.col("sectype") == FUND, F.col("iopv")).alias("IOPV"),
        ]
    else:
        extra += _renamed(df, SNAP_OLD_COLUMNS) + [
            F.col("totalbidqty").alias("TotalBidQty"), F.col("totalofferqty").alias("TotalOfferQty"),
        ]
    exchange = "SH" if fmt == "sh" else "SZ"
    return df.select(
        *_common(df, "snap", exchange, zone, id_column), *_received(df),
        *_renamed(df, SNAP_COLUMNS), *extra, *_book(df, fmt),
    )


def publish_index(df: DataFrame, products: DataFrame, fmt: str = "new",
                  window: tuple[str, str] | None = None, zone: str = "UTC",
                  id_column: str = "FullSecurityID") -> DataFrame:
    df = with_products(_windowed(df, window), products)
    extra: list[Column] = []
    if fmt == "new":
        phase = codes.phase_sz(F.col("tradingphasecode"), F.col("clock"), index=True)
        extra = [
            F.col("mdstreamid").alias("MDStreamID"), phase.alias("TradingPhaseCode"),
            codes.is_unmapped(F.col("tradingphasecode"), phase).alias("phase_rejected"),
        ]
    return df.select(
        *_common(df, "index", "SZ", zone, id_column), *_received(df),
        *_renamed(df, INDEX_COLUMNS), *extra,
    )


def _windowed(df: DataFrame, window: tuple[str, str] | None) -> DataFrame:
    return df if window is None else df.where(in_window(F.col("clock"), *window))


def publish_orders(df: DataFrame, products: DataFrame, fmt: str = "new", side_mode: str = "store",
                   window: tuple[str, str] | None = None, zone: str = "UTC",
                   id_column: str = "FullSecurityID") -> DataFrame:
    df = with_products(_windowed(df, window), products)
    seq = F.col("applseqnum")
    extra: list[Column] = []
    if fmt == "new":
        kind = codes.order_type_new(F.col("ordertype"))
        side = codes.side_new(F.col("side"), side_mode)
        extra = [F.col("mdstreamid").alias("MDStreamID")] + [
            drop_null_word(F.col(c).cast("string")).alias(n) for c, n in {
                "expirationtype": "ExpirationType", "expirationdays": "ExpirationDays",
                "contactor": "Contactor", "contactinfo": "ContactInfo", "confirmid": "ConfirmID",
            }.items()
        ]
    else:
        kind, side = codes.order_type_old(F.col("ordertype")), codes.side_old(F.col("side"))
    return df.select(
        *_common(df, "order", "SZ", zone, id_column, seq), *_received(df),
        seq.alias("OrderIndex"), kind.alias("OrderType"), F.col("price").alias("OrderPrice"),
        F.col("orderqty").alias("OrderQty"), side.alias("OrderBSFlag"), *extra,
    )


def number_sh_trades(df: DataFrame) -> DataFrame:
    """SH trades have no number of their own: they are numbered per security
    and day in time order."""
    return with_row_number(df, [DAY, SECURITY], ["ts"], "applseqnum")


def publish_trades(df: DataFrame, products: DataFrame, fmt: str = "new",
                   window: tuple[str, str] | None = None, flag: str = "pending",
                   zone: str = "UTC", id_column: str = "FullSecurityID") -> DataFrame:
    """``flag``: 'pending' publishes 0 for the later flag revision, 'none'
    leaves the cell absent, 'derived' compares the order numbers."""
    if fmt == "sh":
        df, flag = number_sh_trades(df), "derived"
    df = with_products(_windowed(df, window), products)
    seq, bid, offer = F.col("applseqnum"), F.col("bidapplseqnum"), F.col("offerapplseqnum")
    if fmt == "sh":
        kind, money = F.lit("0"), F.col("tradeamount")
    else:
        money = trade_money(F.col("price"), F.col("tradeqty"))
        kind = (codes.trade_type_new(F.col("exectype")) if fmt == "new"
                else codes.trade_type_old(F.col("exectype"), F.col("orderkind")))
    flags = {"pending": F.lit("0"), "none": F.lit(None).cast("string"), "derived": codes.bs_flag(bid, offer)}
    return df.select(
        *_common(df, "trade", "SH" if fmt == "sh" else "SZ", zone, id_column, seq), *_received(df),
        *([F.col("mdstreamid").alias("MDStreamID")] if fmt == "new" else []),
        seq.alias("TradeIndex"), bid.alias("TradeBuyNo"), offer.alias("TradeSellNo"),
        flags[flag].alias("TradeBSFlag"), kind.alias("TradeType"), F.col("price").alias("TradePrice"),
        F.col("tradeqty").alias("TradeQty"), money.alias("TradeMoney"),
    )
