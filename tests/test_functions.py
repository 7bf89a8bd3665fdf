import random
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotewell.functions import arrays, codes, keys, numbers, times


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first()[0]


def test_time_texts(spark):
    c = F.col("c")
    assert one(spark, "20180330093243215", times.parse_ts17(c)) == datetime(2018, 3, 30, 9, 32, 43, 215000)
    assert one(spark, "20140102133321", times.parse_ts14(c)) == datetime(2014, 1, 2, 13, 33, 21)
    assert one(spark, "2014010209250430", times.parse_ts16(c)) == datetime(2014, 1, 2, 9, 25, 4, 30000)
    assert one(spark, "2014010209250430", times.parse_ts16(c, False)) == datetime(2014, 1, 2, 9, 25, 4, 300000)
    for clock, want in ((93000000, datetime(2018, 3, 30, 9, 30)), (113000001, datetime(2018, 3, 30, 11, 30, 0, 1000))):
        assert one(spark, clock, times.parse_day_clock(F.lit("20180330"), c), "bigint") == want
    for bad in ("", "2018", "20189930093243215", "HEAD:v1"):
        assert one(spark, bad, times.parse_ts17(c)) is None
        assert one(spark, bad, times.text_day(c)) is None


def test_wall_clock_ignores_session_zone(spark):
    # 02:30 does not exist that day in the session's zone
    ts = datetime(2018, 3, 11, 2, 30, 0, 7000)
    c = F.col("c")
    assert one(spark, ts, times.epoch_ms(c), "timestamp_ntz") == 1520735400007
    assert one(spark, ts, times.clock_number(c), "timestamp_ntz") == 23000007
    assert one(spark, ts, times.from_epoch_ms(times.epoch_ms(c)), "timestamp_ntz") == ts
    eight_hours = 8 * 3600 * 1000
    assert one(spark, ts, times.epoch_ms(c, "Asia/Shanghai"), "timestamp_ntz") == 1520735400007 - eight_hours


def test_sessions_are_inclusive(spark):
    inside = [90000000, 113000000, 130000000, 150000000]
    outside = [85959999, 113000001, 125959999, 150000001]
    df = spark.createDataFrame([(c,) for c in inside + outside], "c bigint")
    got = {r[0] for r in df.where(times.in_sessions(F.col("c"))).collect()}
    assert got == set(inside)


def test_month_bounds(spark):
    row = spark.range(1).select(
        times.month_begin("20240315"), times.previous_month_end("2024-03-15"), times.year_begin("20240315"),
        times.date8(times.as_date("20240315")),
    ).first()
    assert [str(x) for x in row] == ["2024-03-01", "2024-02-29", "2024-01-01", "20240315"]


def test_row_key_and_back(spark):
    ts = datetime(2018, 3, 30, 9, 32, 43, 215000)
    df = spark.createDataFrame([("000977.SZ", ts, 648070), ("00700.HK", ts, 1)], "id string, ts timestamp_ntz, seq bigint")
    out = df.select(
        "id", keys.row_key(F.col("id"), F.col("ts"), F.col("seq")).alias("k"),
        keys.row_key(F.col("id"), F.col("ts")).alias("short"),
    ).withColumn("back", keys.key_time(F.col("k"), F.col("id"))).collect()
    for r in out:
        assert r.back == ts
        assert r.k.startswith(r.short) and r.k[6:6 + len(r.id)] == r.id
        assert int(r.short[6 + len(r.id):]) == 2**63 - 1 - 1522402363215


def test_phase_codes(spark):
    cases = [("T0", 100000000, "3"), (" T0 ", 100000000, "3"), ("B0", 100000000, "4"), ("ZZ", 100000000, None),
             ("ZZ", 92500000, "2"), ("T0", 93059999, "2"), ("T0", 93100000, "3"), ("T0", 113000000, "4"),
             ("T0", 130059999, "4"), ("V1", 140000000, "8")]
    df = spark.createDataFrame([(c, t) for c, t, _ in cases], "c string, t bigint")
    got = [r[0] for r in df.select(codes.phase_sz(F.col("c"), F.col("t"))).collect()]
    assert got == [w for _, _, w in cases]
    assert one(spark, "B0", codes.phase_sz(F.col("c"), F.lit(100000000), index=True)) is None
    assert one(spark, "SUSPE ", codes.phase_sh(F.col("c"))) == "8"


def test_trade_and_side_codes(spark):
    c = F.col("c")
    assert one(spark, "G", codes.side_new(c)) == "1" and one(spark, "F", codes.side_new(c)) == "2"
    assert one(spark, "G", codes.side_new(c, "lending")) == "3" and one(spark, "1", codes.side_new(c, "lending")) == "1"
    assert one(spark, "C", codes.side_old(c)) == "5" and one(spark, "X", codes.order_type_old(c)) == "3"
    assert one(spark, "U", codes.order_type_new(c)) == "3" and one(spark, "2", codes.order_type_new(c)) == "2"
    assert one(spark, "C ", codes.trade_type_old(c, F.lit("2"))) == "2"
    assert one(spark, "C", codes.trade_type_old(c, F.lit("9"))) is None
    assert one(spark, 5, codes.bs_flag(c, F.lit(4)), "int") == "1"
    assert one(spark, 4, codes.bs_flag(c, F.lit(4)), "int") is None


def test_lists_and_cells(spark):
    c = F.col("c")
    assert one(spark, " 100|20.5|3 ", arrays.pipe_list(c)) == [100.0, 20.5, 3.0]
    assert one(spark, "  ", arrays.pipe_list(c)) is None
    assert one(spark, "0", arrays.nonzero_list([c, F.lit("7"), F.lit(""), F.lit("x")])) == [7.0]
    assert one(spark, "1200.50", numbers.whole_part(c)) == 1200 and one(spark, "88", numbers.whole_part(c)) == 88
    assert one(spark, "-", numbers.drop_dash(c)) is None and one(spark, "NULL", numbers.drop_null_word(c)) is None
    for text, blank in (("NaN", True), (" ", True), (None, True), ("0", False)):
        assert one(spark, text, numbers.blank_or_nan(c)) is blank
    assert one(spark, float("nan"), numbers.blank_or_nan(c), "double") is True


def test_half_even_money(spark):
    prices = [2.0005, 1.1255, 2.0015]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    got = [float(r[0]) for r in df.select(numbers.trade_money(F.col("p"), F.lit(1))).collect()]
    assert got == [2.0, 1.126, 2.002]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "n int, d int")
    assert [r[0] for r in df.select(numbers.ratio(F.col("n"), F.col("d"), 4, empty=-1)).collect()] == [0.3333, -1.0]


def bad_book(a):
    """The book test as a plain loop: bids worst to best, then offers."""
    for i in range(9):
        if a[i] == 0:
            if i > 0 and a[i - 1] > 0:
                return True
        elif a[i + 1] <= a[i]:
            return True
    if a[9] and a[10] and a[9] > a[10]:
        return True
    for i in range(10, 19):
        if a[i] == 0:
            if a[i + 1] > 0:
                return True
        elif a[i + 1] and a[i + 1] <= a[i]:
            return True
    return False


def random_book(rng):
    bids = sorted(rng.sample(range(1, 60), 10))
    offers = sorted(rng.sample(range(55, 120), 10))
    bids[:rng.randint(0, 10)] = [0] * rng.randint(0, 3)
    bids = ([0] * 10 + bids)[-10:]
    cut = rng.randint(3, 10)
    offers = offers[:cut] + [0] * (10 - cut)
    if rng.random() < 0.4:
        (bids if rng.random() < 0.5 else offers)[rng.randrange(10)] = rng.choice([0, 5, 57, 90])
    return [float(x) for x in bids + offers]


def test_book_order_against_loop(spark):
    rng = random.Random(7)
    books = [random_book(rng) for _ in range(3000)]
    df = spark.createDataFrame([(b,) for b in books], "a array<double>")
    cells = [F.col("a")[i] for i in range(20)]
    got = [r[0] for r in df.select(arrays.book_out_of_order(cells[:10], cells[10:])).collect()]
    want = [bad_book(b) for b in books]
    assert got == want and 200 < sum(want) < 2800


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=20))
def test_key_time_property(spark, millis):
    df = spark.createDataFrame([(m,) for m in millis], "ms bigint")
    ts = times.from_epoch_ms(F.col("ms"))
    key = keys.row_key(F.lit("600000.SH"), ts, F.col("ms"))
    back = times.epoch_ms(keys.key_time(key, F.lit("600000.SH")))
    assert df.where(back != F.col("ms")).count() == 0
