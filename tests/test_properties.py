"""Property checks against brute force on random series (hypothesis):
trailing means vs exact fractions, missing days vs a calendar spine,
dedupe idempotence, islands vs whole-history runs."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import exact as X
from marketlens.operators import clean

D0 = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

prices = st.one_of(st.none(), st.floats(1e-11, 1e15), st.floats(1e-11, 1e-3), st.just(0.0),
                   st.floats(1, 1e5).map(lambda x: round(x, 2)))


def exact_mean(values):
    """Correctly rounded mean and the count of the values that are there."""
    there = [Fraction(v) for v in values if v is not None]
    return sum(there) / len(there) if there else None


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), prices), min_size=1, max_size=60),
       st.lists(st.integers(min_value=1, max_value=30), min_size=1, max_size=3))
def test_trailing_means_equal_exact_fractions(spark, rows, ns):
    """Also after values of any other magnitude in the same series."""
    data = [("X", s, D0 + dt.timedelta(days=i), p) for i, (s, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, close double")
    got = X.with_trailing_means(df, {"c": F.col("close")}, ns, prev={"c": ns}).orderBy("date").collect()
    for s in ("A", "B"):
        mine = [r for r in got if r.symbol == s]
        closes = [r.close for r in mine]
        for i, r in enumerate(mine):
            for n in ns:
                for col, end in ((f"_tm_c_{n}", i + 1), (f"_tmp_c_{n}", i)):
                    want = exact_mean(closes[max(0, end - n):end])
                    if want is None:
                        assert r[col] is None
                    else:
                        assert abs(Fraction(r[col]) - want) <= want * Fraction(1, 2**51)


@SETTINGS
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=50), st.integers(1, 12))
def test_group_means_do_not_depend_on_partitions(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    one = df.coalesce(1).agg(X.mean("x")).first()[0]
    assert df.repartition(parts).agg(X.mean("x")).first()[0] == one
    scale = sum(abs(Fraction(v)) for v in values) / len(values)
    assert abs(Fraction(one) - exact_mean(values)) <= max(scale * Fraction(1, 2**50), Fraction(1, 2**89))


def test_values_out_of_range_make_the_frame_nan(spark):
    nan, inf = float("nan"), float("inf")
    closes = [1.0, nan, 2.0, 3.0, inf, 1e300, 4.0, None, 5.0]
    df = spark.createDataFrame([("X", "A", D0 + dt.timedelta(days=i), c) for i, c in enumerate(closes)],
                               "exchange string, symbol string, date date, close double")
    got = [r["_tm_c_2"] for r in X.with_trailing_means(df, {"c": F.col("close")}, [2]).orderBy("date").collect()]
    want = [1.0, nan, nan, 2.5, nan, nan, nan, 4.0, 5.0]
    assert [x if x == x else "nan" for x in got] == [x if x == x else "nan" for x in want]
    assert spark.createDataFrame([(None,)], "x double").agg(X.mean("x")).first()[0] is None


@SETTINGS
@given(st.sets(st.integers(min_value=0, max_value=40), min_size=1, max_size=25))
def test_missing_days_equal_spine_difference(spark, days):
    data = [("X", "A", D0 + dt.timedelta(days=d), 1.0) for d in sorted(days)]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, close double")
    lo, hi = D0 - dt.timedelta(days=2), D0 + dt.timedelta(days=42)
    got = {r.date for r in clean.missing_days(df, start=lo, end=hi).collect()}
    spine = {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)}
    assert got == spine - {r[2] for r in data}
    inside = {r.date for r in clean.missing_days(df).collect()}
    first, last = min(r[2] for r in data), max(r[2] for r in data)
    assert inside == {d for d in spine - {r[2] for r in data} if first < d < last}


@SETTINGS
@given(st.sets(st.integers(min_value=0, max_value=40), min_size=1, max_size=25),
       st.integers(0, 40), st.integers(0, 12))
def test_missing_days_stay_inside_any_window(spark, days, first, length):
    data = [("X", "A", D0 + dt.timedelta(days=d)) for d in sorted(days)]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date")
    lo, hi = D0 + dt.timedelta(days=first), D0 + dt.timedelta(days=first + length)
    window = {lo + dt.timedelta(days=i) for i in range(length + 1)}
    assert {r.date for r in clean.missing_days(df, lo, hi).collect()} == window - {r[2] for r in data}
    listing = spark.createDataFrame([("X", "A"), ("X", "B")], "exchange string, symbol string")
    listed = clean.missing_days(df, lo, hi, listing=listing).collect()
    assert {r.date for r in listed if r.symbol == "B"} == window


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 9)),
                min_size=1, max_size=40))
def test_dedupe_first_is_earliest_and_idempotent(spark, rows):
    data = [("X", "A", D0 + dt.timedelta(days=d), float(c), 1,
             dt.datetime(2024, 2, 1) + dt.timedelta(hours=h)) for d, h, c in rows]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, close double, "
                               "volume bigint, download_timestamp timestamp")
    once = clean.dedupe_bars(df, policy="first")
    got = {r.date: (r.download_timestamp, r.close) for r in once.collect()}
    want = {}
    for _, _, d, c, _, t in data:
        if d not in want or (t, c) < want[d]:
            want[d] = (t, c)
    assert got == want
    assert clean.dedupe_bars(once, policy="first").exceptAll(once).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 60)), min_size=1, max_size=80),
       st.integers(min_value=1, max_value=12))
def test_normalise_quotes_keeps_newest_n(spark, rows, n):
    from marketlens.sources import ingest
    uniq = sorted(set(rows))
    data = [(s, "X", (D0 + dt.timedelta(days=d)).isoformat(), str(d)) for s, d in uniq]
    df = spark.createDataFrame(data, "symbol string, exchange string, Date string, Close string")
    got = {(r.symbol, r.date) for r in ingest.normalise_quotes(df, keep_last=n).collect()}
    want = set()
    for s in {s for s, _ in uniq}:
        days = sorted((d for t, d in uniq if t == s), reverse=True)[:n]
        want |= {(s, D0 + dt.timedelta(days=d)) for d in days}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.sampled_from(["X", "Y"]),
                          st.integers(0, 20), st.integers(1, 50)), min_size=1, max_size=60),
       st.integers(1, 5))
def test_period_gainers_vs_brute_force(spark, rows, n):
    from marketlens.operators import rankings
    seen, data = set(), []
    for s, e, d, c in rows:                      # one bar per (exchange, symbol, date)
        if (e, s, d) not in seen:
            seen.add((e, s, d))
            data.append((e, s, D0 + dt.timedelta(days=d), float(c), float(c), float(c), float(c), d))
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, open double, "
                               "high double, low double, close double, volume bigint")
    as_of, days = D0 + dt.timedelta(days=15), 7
    got = [(r.exchange, r.symbol, r.start_price, r.end_price, r.volume)
           for r in rankings.period_gainers(df, as_of, days=days, n=n).collect()]
    lo = as_of - dt.timedelta(days=days)
    series = {}
    for e, s, d, _, _, _, c, v in data:
        if lo <= d <= as_of:
            series.setdefault((e, s), []).append((d, c, v))
    want = []
    for (e, s), xs in series.items():
        xs.sort()
        first, last = xs[0][1], xs[-1][1]
        want.append(((last - first) / first * 100, e, s, first, last, xs[-1][2]))
    want.sort(key=lambda t: (-t[0], t[1], t[2]))
    assert got == [(e, s, f, l_, v) for _, e, s, f, l_, v in want[:n]]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 30), st.integers(1, 99)),
                min_size=1, max_size=50),
       st.integers(1, 6))
def test_recent_changes_vs_brute_force(spark, rows, n):
    from marketlens.operators import lookup
    seen, data = set(), []
    for s, d, c in rows:
        if (s, d) not in seen:
            seen.add((s, d))
            data.append(("X", s, D0 + dt.timedelta(days=d), float(c), float(c), 1))
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, open double, "
                               "close double, volume bigint")
    got = {(r.symbol, r.date): (r.rank_desc, r.change) for r in lookup.recent_changes(df, n).collect()}
    want = {}
    for s in {x[1] for x in data}:
        xs = sorted((x[2], x[4]) for x in data if x[1] == s)
        for i, (d, c) in enumerate(xs):
            rank = len(xs) - i
            if rank <= n:
                want[(s, d)] = (rank, c - xs[i - 1][1] if i else 0.0)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(1, 200), st.integers(0, 1000)),
                min_size=1, max_size=40))
def test_anomalies_vs_brute_force(spark, rows):
    import math
    from marketlens.operators import anomalies
    data = [("X", "A", D0 + dt.timedelta(days=i), float(o), float(c), v) for i, (o, c, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, open double, "
                               "close double, volume bigint")
    got = {r.date: (r.is_volume_anomaly, r.is_price_anomaly, r.is_gap_anomaly, r.anomaly_score)
           for r in anomalies.add_anomalies(df).collect()}
    vols = [v for *_, v in data]
    n = len(vols)
    mean = sum(vols) / n
    sd = math.sqrt(float(n * sum(v * v for v in vols) - sum(vols) ** 2) / float(n * (n - 1))) if n > 1 else None
    for i, (_, _, d, o, c, v) in enumerate(data):
        z = (v - mean) / sd if sd else None
        prev = data[i - 1][4] if i else None
        pct = (c - prev) / prev * 100 if prev else None
        gap = (o - prev) / prev * 100 if prev else None
        flags = (None if z is None else abs(z) > 3, None if pct is None else abs(pct) > 10,
                 None if gap is None else abs(gap) > 5)
        want = (*flags, sum(1 for f in flags if f))
        assert got[d] == want, (d, got[d], want)


@SETTINGS
@given(st.lists(st.integers(1, 60), min_size=1, max_size=45))
def test_ma_crossover_vs_brute_force(spark, closes):
    from decimal import Decimal
    from marketlens.operators import indicators, signals
    data = [("X", "A", D0 + dt.timedelta(days=i), float(c), float(c), float(c), float(c), 1)
            for i, c in enumerate(closes)]
    df = spark.createDataFrame(data, "exchange string, symbol string, date date, open double, "
                               "high double, low double, close double, volume bigint")
    sig = signals.add_signals(indicators.add_indicators(df, prev=(5, 20)))
    got = [r.ma_crossover for r in sig.orderBy("date").collect()]

    def ma(i, n):
        w = closes[max(0, i - n + 1):i + 1]
        return float(Decimal(sum(w))) / len(w)

    want = []
    for i in range(len(closes)):
        f, s = ma(i, 5), ma(i, 20)
        if i and f > s and ma(i - 1, 5) <= ma(i - 1, 20):
            want.append("BUY")
        elif i and f < s and ma(i - 1, 5) >= ma(i - 1, 20):
            want.append("SELL")
        else:
            want.append("HOLD")
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 40), st.integers(1, 500),
                          st.integers(1, 90)), min_size=1, max_size=50))
def test_symbol_profile_vs_brute_force(spark, rows):
    import math
    from decimal import Decimal
    from marketlens.operators import profile
    seen, data = set(), []
    for s, d, c, v in rows:
        if (s, d) not in seen:
            seen.add((s, d))
            close = float(Decimal(c) / 4)                   # quarter steps: exact in both
            data.append((s, "X", D0 + dt.timedelta(days=d), close, v, 0.0))
    df = spark.createDataFrame(data, "symbol string, exchange string, date date, close double, "
                               "volume bigint, daily_return double")
    got = {r.symbol: r for r in profile.symbol_profile(df).collect()}
    for s in {x[0] for x in data}:
        xs = [x for x in data if x[0] == s]
        cs = [Decimal(repr(x[3])) for x in xs]
        n = len(cs)
        mean = float(sum(cs)) / n
        sd = (math.sqrt(float(n * sum(c * c for c in cs) - sum(cs) ** 2) / float(n * (n - 1)))
              if n > 1 else None)
        r = got[s]
        assert r.record_count == n and r.avg_price == mean and r.price_volatility == sd
        assert (r.max_volume, r.min_volume) == (max(x[4] for x in xs), min(x[4] for x in xs))
        assert r.data_span_days == (max(x[2] for x in xs) - min(x[2] for x in xs)).days
        assert r.price_range_ratio == (sd / mean * 100 if sd is not None else None)
