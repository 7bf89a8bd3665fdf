"""Only blocks that the store alone has are looked up among the securities of the files."""

from datetime import datetime, timedelta

from quotewell.plans import recon

KEYS = ["trade_date", "securityid", "ts", "applseqnum"]


def test_only_store_blocks_are_looked_up(spark, monkeypatch):
    start = datetime(2018, 3, 1, 9, 30)
    rows = [(start.date(), s, start + timedelta(minutes=i), i) for s in ("000001", "000002", None) for i in range(30)]
    own, late, strange = rows, [(start.date(), "000001", datetime(2018, 3, 1, 14, 0), 99)], [(start.date(), "999999", start, 1)]
    kind = "trade_date date, securityid string, ts timestamp_ntz, applseqnum long"
    files, store = spark.createDataFrame(own, kind), spark.createDataFrame([*own, *late, *strange], kind)
    looked_up = []

    def present_in(df, other, on, real=recon.present_in):
        looked_up.append(df.count())
        return real(df, other, on)

    monkeypatch.setattr(recon, "present_in", present_in)
    diff = recon.digest_diff(files, store, KEYS)
    assert looked_up == [2]
    one = diff.blocks.where("n_file = 0").collect()
    assert [(r["securityid"], r["n_store"], r["same"]) for r in one] == [("000001", 1, False)]
    # a stored row without a security is in no scope, so the block of the files stands alone
    assert all(r["n_store"] == 0 and not r["same"] for r in diff.blocks.where("securityid is null").collect())
