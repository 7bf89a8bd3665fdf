"""Vendor code maps. An unknown code gives null; ``is_unmapped`` flags it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vendor code -> published code.
PHASE_SZ = {
    "S0": "0", "O0": "1", "T0": "3", "B0": "4", "C0": "5", "E0": "6", "A0": "7", "H0": "8", "V0": "9",
    "S1": "8", "O1": "8", "T1": "8", "B1": "8", "C1": "8", "E1": "8", "A1": "8", "H1": "8", "V1": "8",
    "S": "0", "O": "1", "T": "3", "C": "5", "E": "6", "A": "7", "H": "8", "V": "9",
}
PHASE_SH = {
    "START": "0", "OCALL": "1", "ICALL": "1", "BETW": "2", "OOBB": "2", "OPOBB": "2", "SUSP": "2",
    "TRADE": "3", "BREAK": "4", "CLOSE": "6", "ENDTR": "7", "SUSPE": "8", "HALT": "8", "VOLA": "9",
}
ORDER_TYPE_OLD = {"0": "2", "X": "3", "Y": "4", "2": "5", "V": "6", "W": "7"}
SIDE_OLD = {"B": "1", "C": "5", "S": "2"}
SIDE_STORE = {"1": "1", "G": "1", "2": "2", "F": "2"}
SIDE_LENDING = {"G": "3", "F": "4"}
TRADE_TYPE_NEW = {"4": "1", "F": "0"}
SECURITY_TYPES = {
    "index": "1", "stock": "2", "fund": "3", "bond": "4",
    "repo": "5", "warrant": "6", "option": "7", "future": "8",
}
# Per exchange, the source and channel codes and the id suffix.
EXCHANGES = {
    "SZ": {"source": "102", "channel": "4", "suffix": ".SZ"},
    "SH": {"source": "101", "channel": "3", "suffix": ".SH"},
}
RECORD_TYPES = {"snap": "1", "index": "1", "trade": "2", "order": "4"}


def map_code(code: Column, table: dict[str, str]) -> Column:
    """Trimmed code looked up in a constant map."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.trim(code))


def is_unmapped(code: Column, mapped: Column) -> Column:
    return code.isNotNull() & mapped.isNull()


def phase_sz(code: Column, clock: Column, index: bool = False) -> Column:
    """Trading phase with the clock overriding the code: the minutes 09:25 to
    09:30 are call-auction end (2), 11:30 to 13:00 the midday break (4)."""
    table = {k: v for k, v in PHASE_SZ.items() if not (index and k == "B0")}
    minute = F.floor(clock / F.lit(100000))
    return (
        F.when(minute.between(1130, 1300), F.lit("4"))
        .when(minute.between(925, 930), F.lit("2"))
        .otherwise(map_code(code, table))
    )


def phase_sh(code: Column) -> Column:
    return map_code(code, PHASE_SH)


def order_type_new(code: Column) -> Column:
    return F.when(code == "U", F.lit("3")).otherwise(code)


def order_type_old(code: Column) -> Column:
    return map_code(code, ORDER_TYPE_OLD)


def side_new(code: Column, mode: str = "store") -> Column:
    """``store``: borrow counts as buy, lend as sell. ``lending``: they keep
    codes of their own and other codes pass through."""
    if mode == "store":
        return map_code(code, SIDE_STORE)
    return F.coalesce(map_code(code, SIDE_LENDING), code)


def side_old(code: Column) -> Column:
    return map_code(code, SIDE_OLD)


def trade_type_new(code: Column) -> Column:
    return map_code(code, TRADE_TYPE_NEW)


def trade_type_old(function_code: Column, order_kind: Column) -> Column:
    pair = F.concat_ws("/", F.trim(function_code), F.trim(order_kind))
    return map_code(pair, {"0/0": "0", "C/0": "1", "C/2": "2"})


def bs_flag(bid_seq: Column, offer_seq: Column) -> Column:
    """Who came last: bid 1, offer 2; absent when they are the same."""
    return F.when(bid_seq > offer_seq, F.lit("1")).when(bid_seq < offer_seq, F.lit("2"))
