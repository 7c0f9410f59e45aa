"""Hand-made edge frames for cleaning, indicators, anomalies, signals,
rankings and lookups (FIXTURES section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.operators import anomalies, clean, indicators, lookup, profile, rankings, signals

D0 = dt.date(2024, 1, 1)
SCHEMA = ("exchange string, symbol string, date date, open double, high double, low double, "
          "close double, volume bigint")


def bars(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def series(spark, closes, symbol="A", exchange="X", volume=100, start=D0):
    rows = [(exchange, symbol, start + dt.timedelta(days=i), c, c + 1, c - 1, c, volume)
            for i, c in enumerate(closes)]
    return bars(spark, rows)


def test_process_bars_rules(spark):
    df = bars(spark, [
        ("X", "A", D0, 10.0, 12.0, 9.0, 11.0, 2_000_000),
        ("X", "B", D0, 0.0, 1.0, 0.0, 1.0, 500_000),        # zero open -> NULL return
        ("X", "C", D0, 1.0, 1.0, 1.0, None, 10),            # null close -> dropped
        ("X", "D", D0, 1.0, 1.0, 1.0, 1.0, 0),              # zero volume -> dropped
        ("X", "E", D0, 1.0, 1.0, 1.0, 1.0, None),           # null volume -> dropped
        ("X", "F", None, 1.0, 1.0, 1.0, 1.0, 5),            # null date -> dropped
    ])
    out = {r.symbol: r for r in clean.process_bars(df, loaded_at="2024-02-01 00:00:00").collect()}
    assert set(out) == {"A", "B"}
    a = out["A"]
    assert a.daily_return == pytest.approx(10.0)
    assert a.price_range == pytest.approx(3.0)
    assert a.avg_price == pytest.approx((12 + 9 + 11) / 3)
    assert a.volume_category == "HIGH" and out["B"].volume_category == "MEDIUM"
    assert out["B"].daily_return is None
    assert (a.year, a.month, a.day) == (2024, 1, 1)


def test_min_volume_keeps_zero_volume_when_asked(spark):
    df = bars(spark, [("X", "I", D0, 1.0, 1.0, 1.0, 1.0, 0)])
    assert clean.process_bars(df, min_volume=-1).count() == 1


def test_dedupe_policies_and_idempotence(spark):
    t1, t2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([
        ("X", "A", D0, 1.0, 1.0, 1.0, 1.0, 5, t1),
        ("X", "A", D0, 1.0, 1.0, 1.0, 2.0, 5, t2),          # same key, revised close
        ("X", "A", D0, 1.0, 1.0, 1.0, 2.0, 5, t2),          # exact copy
        ("Y", "A", D0, 3.0, 3.0, 3.0, 3.0, 5, t1),          # cross-listed: distinct key
    ], SCHEMA + ", download_timestamp timestamp")
    first = clean.dedupe_bars(df, policy="first")
    last = clean.dedupe_bars(df, policy="last")
    assert first.count() == 2 and last.count() == 2
    assert first.filter("exchange = 'X'").first().close == 1.0
    assert last.filter("exchange = 'X'").first().close == 2.0
    assert clean.dedupe_bars(first, policy="first").exceptAll(first).count() == 0
    assert clean.dedupe_bars(df, policy="none").count() == 4
    with pytest.raises(ValueError):
        clean.dedupe_bars(df, policy="random")


def test_missing_days_and_spine(spark):
    df = bars(spark, [("X", "A", D0, 1.0, 1.0, 1.0, 1.0, 1),
                      ("X", "A", D0 + dt.timedelta(days=3), 1.0, 1.0, 1.0, 1.0, 1)])
    gaps = sorted(r.date.day for r in clean.missing_days(df).collect())
    assert gaps == [2, 3]
    bounded = sorted(r.date.day for r in clean.missing_days(
        df, start=D0, end=D0 + dt.timedelta(days=5)).collect())
    assert bounded == [2, 3, 5, 6]
    assert clean.calendar_spine(df, D0, D0 + dt.timedelta(days=4)).count() == 5


def test_indicator_edges(spark):
    flat = indicators.add_indicators(series(spark, [5.0] * 25)).orderBy("date").collect()
    assert flat[0].std_20 is None                       # one value: NULL, not NaN
    assert flat[-1].std_20 == 0.0                       # flat series: exact 0
    assert flat[-1].rs == 100.0                         # avg_loss = 0
    assert flat[0].gain == 0.0 and flat[0].loss == 0.0  # first row change NULL -> 0
    rising = indicators.add_indicators(series(spark, [float(i) for i in range(1, 31)]))
    last = rising.orderBy(F.col("date").desc()).first()
    assert last.rsi == pytest.approx(100 - 100 / 101)   # all gains: 99.0099...
    assert last.ma_5 == pytest.approx(28.0)
    assert last.ma_50 == pytest.approx(15.5)            # partial frame of 30 rows


def test_indicator_invariants(spark):
    import math
    closes = [10 + 3 * math.sin(i / 3) + (i % 7) * 0.1 for i in range(80)]
    rows = indicators.add_indicators(series(spark, closes)).collect()
    for r in rows:
        if r.std_20 is not None:
            assert r.bb_lower <= r.ma_20 + 1e-9 <= r.bb_upper + 2e-9
        if r.rsi is not None:
            assert 0.0 <= r.rsi <= 100.0


def test_anomalies_single_bar_and_score(spark):
    one = anomalies.add_anomalies(series(spark, [10.0])).first()
    assert one.volume_std is None and one.is_volume_anomaly is None
    assert one.anomaly_score == 0 and one.has_anomaly is False
    df = bars(spark, [("X", "A", D0, 10.0, 10.0, 10.0, 10.0, 100),
                      ("X", "A", D0 + dt.timedelta(days=1), 20.0, 20.0, 20.0, 20.0, 100)])
    r = anomalies.add_anomalies(df).orderBy("date").collect()[1]
    assert r.is_price_anomaly and r.is_gap_anomaly and r.anomaly_score == 2 and r.has_anomaly


def test_signals_crossover(spark):
    closes = [10.0] * 20 + [20.0] * 5
    sig = signals.add_signals(indicators.add_indicators(series(spark, closes)))
    buys = [r.date for r in sig.filter("ma_crossover = 'BUY'").collect()]
    assert buys == [D0 + dt.timedelta(days=20)]
    counts = {r.combined_signal: r.n_rows for r in signals.signal_counts(sig).collect()}
    assert sum(counts.values()) == 25


def test_period_gainers_cross_listed(spark):
    df = bars(spark, [("X", "A", D0, 1.0, 1.0, 1.0, 10.0, 1),
                      ("X", "A", D0 + dt.timedelta(days=2), 1.0, 1.0, 1.0, 11.0, 1),
                      ("Y", "A", D0, 1.0, 1.0, 1.0, 10.0, 1),
                      ("Y", "A", D0 + dt.timedelta(days=2), 1.0, 1.0, 1.0, 5.0, 1)])
    out = rankings.period_gainers(df, D0 + dt.timedelta(days=2), days=7, n=10).collect()
    assert [(r.exchange, round(r.change_pct, 6)) for r in out] == [("X", 10.0), ("Y", -50.0)]


def test_high_volume_unknown_name(spark):
    df = bars(spark, [("X", "A", D0, 1.0, 1.0, 1.0, 1.0, 7)])
    meta = spark.createDataFrame([], "symbol string, exchange string, company_name string")
    r = rankings.high_volume(df, meta, D0, days=1, n=5).first()
    assert r.company_name == "Unknown" and r.avg_volume_int == 7


def test_detail_unknown_symbol_and_history(spark):
    meta = spark.createDataFrame([("A", "X", "Acme", "Tech", "Tools")],
                                 "symbol string, exchange string, company_name string, "
                                 "sector string, industry string")
    b = series(spark, [1.0, 2.0, 3.0])
    d = lookup.detail(meta, b, "A").first()
    assert d.price == 3.0 and d.change == 0.0
    assert lookup.detail(meta, b, "ZZZ").count() == 0
    h = lookup.history(b, symbol="A", n=2).collect()
    assert [r.close for r in h] == [3.0, 2.0]
    rc = lookup.recent_changes(b, n=2).orderBy("date").collect()
    assert [r.change for r in rc] == [1.0, 1.0]


def test_search_is_null_safe(spark):
    meta = spark.createDataFrame([("A", "X", None, None, None), ("B", "X", "Machines", None, None)],
                                 "symbol string, exchange string, company_name string, "
                                 "sector string, industry string")
    assert [r.symbol for r in lookup.search(meta, "MACH").collect()] == ["B"]


def test_period_stats_date_order(spark):
    b = series(spark, [10.0, 12.0, 8.0, 9.0])
    s = profile.period_stats(b, D0 + dt.timedelta(days=3), span="1w").first()
    assert s.first_price == 10.0 and s.latest_price == 9.0
    assert s.price_change_pct == pytest.approx(-10.0)
    assert s.trading_days == 4


@pytest.mark.parametrize("scale", [1.0, 1e-8, 2e12])
def test_indicators_at_full_precision(spark, scale):
    """Means and Bollinger deviation against exact fractions of the doubles,
    for prices of any magnitude; flat frames deviate by exactly 0."""
    from fractions import Fraction
    closes = [(1234.5678 + i * 7919 % 1000 / 999.7) * scale for i in range(30)] + [7.1 * scale] * 25
    rows = indicators.add_indicators(series(spark, closes)).orderBy("date").collect()
    for i, r in enumerate(rows):
        for n in (5, 10, 20, 50):
            win = [Fraction(c) for c in closes[max(0, i - n + 1):i + 1]]
            assert r[f"ma_{n}"] == pytest.approx(float(sum(win) / len(win)), rel=5e-16)
        win = [Fraction(c) for c in closes[max(0, i - 19):i + 1]]
        m = sum(win) / len(win)
        if len(win) > 1:
            assert r.std_20 == pytest.approx(float(sum((c - m) ** 2 for c in win) / (len(win) - 1)) ** 0.5, rel=1e-11)
    assert rows[-1].std_20 == 0 and rows[-1].bb_position is None


def test_smallest_prices_keep_their_means(spark):
    rows = indicators.add_moving_averages(series(spark, [0.00001, 0.00003, 0.00005])).orderBy("date").collect()
    assert [r.ma_5 for r in rows] == pytest.approx([1e-5, 2e-5, 3e-5], rel=1e-15)


def test_signals_same_with_folded_previous_means(spark):
    import math
    closes = [20 + 5 * math.sin(i / 4) + (i % 5) * 0.37 for i in range(90)]
    b = series(spark, closes).unionByName(series(spark, closes[::-1], symbol="B"))
    plain = signals.add_signals(indicators.add_indicators(b))
    folded = signals.add_signals(indicators.add_indicators(b, prev=(5, 20)))
    assert plain.columns == folded.columns
    assert plain.exceptAll(folded).count() == 0 and folded.exceptAll(plain).count() == 0
    assert plain.filter("ma_crossover <> 'HOLD'").count() > 0


def test_anomaly_score_invariants(spark):
    """SURVEY 5 invariants: score in 0..3; has_anomaly <=> score >= 2."""
    from marketlens.sources import tables as T
    from conftest import SMALL
    an = anomalies.add_anomalies(T.brand_bars(spark, SMALL))
    bad = an.filter(~F.col("anomaly_score").between(0, 3)
                    | (F.col("has_anomaly") != (F.col("anomaly_score") >= 2)))
    assert bad.count() == 0 and an.count() > 0


def test_latest_day_rankings_without_gainers(spark):
    import datetime as dt
    from marketlens.operators import rankings
    rows = [("E", f"S{i}", dt.date(2024, 1, 1), 9.0, 1.0, 5 + i) for i in range(30)]
    rows += [("E", f"S{i}", dt.date(2024, 1, 2), -1.0, 1.0, i) for i in range(3)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, date date, daily_return double, close double, volume long")
    assert rankings.day_gainers(df, n=10).count() == 0
    assert [r.symbol for r in rankings.day_volume(df, n=10).collect()] == ["S2", "S1", "S0"]
    assert rankings.day_volume(df.limit(0)).count() == 0
