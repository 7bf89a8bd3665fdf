"""Declared schemas of the feeds; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

DEPTH = 10
QUEUE = 50


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


def _numbered(stem: str, t: T.DataType, n: int = DEPTH, tail: str = "") -> dict[str, T.DataType]:
    return {f"{stem}{i}{tail}": t for i in range(1, n + 1)}


_PRICES = dict(preclosepx=D, openpx=D, highpx=D, lowpx=D, lastpx=D)
_TOTALS = dict(numtrades=L, totalvolumetrade=L, totalvaluetrade=D)
_BOOK = {
    **_numbered("bidpx", D), **_numbered("bidsize", L),
    **_numbered("offerpx", D), **_numbered("offersize", L),
    "numorders_b1": L, "noorders_b1": L, "orderqty_b1": S,
    "numorders_s1": L, "noorders_s1": L, "orderqty_s1": S,
}

SNAP = struct(
    securityid=S, mdstreamid=S, tradedate=S, origtime=S, **_PRICES, pxchange1=D, pxchange2=D,
    **_TOTALS, uplimitpx=D, downlimitpx=D, totalofferqty=S, totalbidqty=S, weightedavgbidpx=D,
    weightedavgofferpx=D, peratio1=D, peratio2=D, tradingphasecode=S, warrantpremiumrate=D,
    prenav=D, realtimenav=S,
)
SNAP_LEVEL = struct(securityid=S, origtime=S, **_BOOK)
ORDER = struct(
    securityid=S, origtime=S, mdstreamid=S, applseqnum=L, ordertype=S, side=S, price=D, orderqty=L,
    expirationtype=I, expirationdays=I, contactor=S, contactinfo=S, confirmid=S,
)
TRADE = struct(
    securityid=S, origtime=S, mdstreamid=S, applseqnum=L, bidapplseqnum=L, offerapplseqnum=L,
    exectype=S, price=D, tradeqty=L,
)
INDEX = struct(
    securityid=S, securityidsource=S, origtime=S, mdstreamid=S, tradingphasecode=S, preclosepx=D,
    lastpx=D, openpx=D, highpx=D, lowpx=S, totalvolumetrade=L, totalvaluetrade=D,
)
SNAP_OLD = struct(
    securityid=S, tradedate=S, datatimestamp=L, **_PRICES, **_TOTALS, totalofferqty=L, totalbidqty=L,
    weightedavgbidpx=D, weightedavgofferpx=D, peratio1=D, peratio2=D,
)
SNAP_LEVEL_OLD = struct(securityid=S, tradedate=S, datatimestamp=L, sendtime=L, **_BOOK)
ORDER_OLD = struct(
    securityid=S, tradedate=S, orderentrytime=L, recno=L, price=D, orderqty=L, functioncode=S, orderkind=S,
)
TRADE_OLD = struct(
    securityid=S, tradedate=S, tradetime=L, recno=L, buyorderrecno=S, sellorderrecno=S,
    functioncode=S, orderkind=S, price=D, tradeqty=L,
)
INDEX_OLD = struct(
    securityid=S, tradedate=S, datatimestamp=L, closeindex=D, openindex=D, highindex=D, lowindex=D,
    lastindex=D, turnover=D, totalvolumetraded=L, numtrades=L,
)
SNAP_SH = struct(**{n: S for n in [
    "securityid", "datetime", "preclosepx", "openpx", "highpx", "lowpx", "lastpx",
    "numtrades", "totalvolumetrade", "totalvaluetrade", "totalbidqty", "totalofferqty",
    "weightedavgbidpx", "weightedavgofferpx", "totalbidnumber", "totaloffernumber",
    "bidtrademaxduration", "offertrademaxduration", "numbidorders", "numofferorders",
    "withdrawbuynumber", "withdrawbuyamount", "withdrawbuymoney",
    "withdrawsellnumber", "withdrawsellamount", "withdrawsellmoney",
    "instrumentstatus", "iopv",
    *_numbered("bidpx", S), *_numbered("bid", S, tail="orderqty"), *_numbered("bid", S, tail="numorders"),
    *_numbered("offer", S, tail="price"), *_numbered("offer", S, tail="orderqty"),
    *_numbered("offer", S, tail="numorders"),
    *_numbered("bid1orders", S, QUEUE), *_numbered("offer1orders", S, QUEUE),
]})
TRADE_SH = struct(
    securityid=S, tradetime=S, price=S, tradeqty=S, tradeamount=S, bidapplseqnum=S, offerapplseqnum=S,
)
PRODUCTS = struct(prdtid=S, sectype=S, secsubtype=S, symbol=S)

FEEDS = {
    "new": {"snap": SNAP, "snap_level": SNAP_LEVEL, "order": ORDER, "trade": TRADE, "index": INDEX},
    "old": {"snap": SNAP_OLD, "snap_level": SNAP_LEVEL_OLD, "order": ORDER_OLD, "trade": TRADE_OLD,
            "index": INDEX_OLD},
    "sh": {"snap": SNAP_SH, "snap_level": SNAP_SH, "trade": TRADE_SH},
}
