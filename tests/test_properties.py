"""Randomised properties against brute force on small inputs (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.operators import history
from martflow.operators.dedupe import latest_per_key

BASE = dt.datetime(2000, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

# (key, minutes offset) pairs; offsets span hours, days and years so every bucket level is hit
versions = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(
    [0, 1, 59, 60, 61, 1439, 1440, 1441, 2880, 44640, 525600, 525601, 1051200])), min_size=1, max_size=25)


def _ts(m):
    return BASE + dt.timedelta(minutes=m)


@SETTINGS
@given(versions)
def test_next_in_key_matches_brute_force(spark, pairs):
    pairs = sorted(set(pairs))
    df = spark.createDataFrame([(k, _ts(m)) for k, m in pairs], "k long, ts timestamp_ntz")
    got = {(r.k, r.ts): r.n for r in history.next_in_key(df, ["k"], "ts", "n",
                                                         ("hour", "day", "month", "year")).collect()}
    want = {}
    for k in {k for k, _ in pairs}:
        ts = sorted(_ts(m) for kk, m in pairs if kk == k)
        for a, b in zip(ts, ts[1:] + [None]):
            want[(k, a)] = b
    assert got == want


@SETTINGS
@given(versions, st.integers(1, 3))
def test_scd2_batches_equal_rebuild(spark, pairs, n_batches):
    """Batches in time order, each possibly holding several versions of a key and
    re-delivering older ones, equal the rebuild over their union."""
    rows = [(k, f"v{m}", _ts(m), _ts(m)) for k, m in pairs]
    schema = "k long, v string, created_at timestamp_ntz, ingestion_ts timestamp_ntz"
    allv = spark.createDataFrame(rows, schema)
    cuts = sorted({r[2] for r in rows})
    bounds = [cuts[(i * len(cuts)) // n_batches] for i in range(1, n_batches)] + [None]
    h = None
    for hi in bounds:
        # batch i holds every version before its cut: older ones are re-delivered
        b = allv if hi is None else allv.where(F.col("created_at") < F.lit(hi))
        h = history.apply_scd2(h, b, ["k"]).checkpoint()
    want = history.rebuild_scd2(allv, ["k"])

    def norm(d):
        return sorted(str(tuple(r)) for r in d.select("k", "v", "valid_from", "valid_to").collect())
    assert norm(h) == norm(want)
    open_per_key = h.where("valid_to IS NULL").groupBy("k").count().where("count != 1").count()
    assert open_per_key == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 2), st.text("ab", max_size=2)),
                min_size=1, max_size=20))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(k, _ts(c), _ts(l), v) for k, c, l, v in rows],
                               "k long, created_at timestamp_ntz, ingestion_ts timestamp_ntz, v string")
    got = {r.k: (r.created_at, r.ingestion_ts, r.v) for r in latest_per_key(df, ["k"], tiebreak=["v"]).collect()}
    want = {}
    for k, c, l, v in rows:
        cand = (_ts(c), _ts(l), v)
        cur = want.get(k)
        # newest version, then newest load, then smallest remaining column
        if cur is None or (cand[0], cand[1]) > (cur[0], cur[1]) or \
                ((cand[0], cand[1]) == (cur[0], cur[1]) and cand[2] < cur[2]):
            want[k] = cand
    assert got == want
