"""Series, sequences and spectra over events (series = user)."""

from pyspark.sql import functions as F

from loomframe.catalog.registry import query, rounded, table
from loomframe.operators import series as W
from loomframe.operators import spectral as P

S = "PARTITION BY user_id ORDER BY ts, event_id"
ORDER = ["ts", "event_id"]


def _ev(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query("w1_rolling_zscore", f"""SELECT event_id, user_id, round((value - avg(value) OVER w) / (stddev_pop(value) OVER w + 1e-7), 4) + 0.0 AS zscore
FROM events WINDOW w AS ({S} ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)""")
def w1(spark, sf):
    return rounded(W.rolling_zscore(_ev(spark, sf), "user_id", ORDER, "value").drop("ts", "value"), ["zscore"], 4)


@query("w2_lag_features", f"""SELECT event_id, user_id, coalesce(lag(value, 1) OVER w, 0) AS lag_1, coalesce(lag(value, 3) OVER w, 0) AS lag_3,
 coalesce(lag(value, 7) OVER w, 0) AS lag_7 FROM events WINDOW w AS ({S})""")
def w2(spark, sf):
    return W.lag_features(_ev(spark, sf), "user_id", ORDER, "value", [3, 1, 7]).drop("ts", "value")


def _decompose_sql(period, op, back):
    half = period // 2
    total = f"sum(value) OVER (w ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    if period % 2 == 0:
        total = f"({total} - (lag(value, {half}) OVER w + lead(value, {half}) OVER w) / 2)"
    resid = "value - trend - seasonal" if op == "-" else "value / (trend * seasonal)"
    return f"""WITH s AS (SELECT event_id, user_id, value, row_number() OVER ({S}) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events),
t AS (SELECT *, CASE WHEN pos >= {half} AND pos < n - {half} THEN {total} / {period} END AS trend FROM s WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
p AS (SELECT user_id, pos % {period} AS phase, avg(value {op} trend) AS fig FROM t GROUP BY ALL),
c AS (SELECT user_id, phase, fig {op} avg(fig) OVER (PARTITION BY user_id) AS seasonal FROM p),
o AS (SELECT event_id, t.user_id, value, CASE WHEN n >= {2 * period} THEN trend END AS trend, CASE WHEN n >= {2 * period} THEN seasonal END AS seasonal
      FROM t JOIN c ON t.user_id = c.user_id AND t.pos % {period} = c.phase)
SELECT event_id, user_id, round(trend, 7) + 0.0 AS trend, round(seasonal, 7) + 0.0 AS seasonal, round({resid}, 7) + 0.0 AS residual FROM o"""


def _decompose(period, model):
    def run(spark, sf):
        out = W.seasonal_decompose(_ev(spark, sf), "user_id", ORDER, "value", period, model)
        return rounded(out.drop("ts", "value"), ["trend", "seasonal", "residual"], 7)
    return run


query("w3_seasonal_additive_even", _decompose_sql(6, "-", "+"))(_decompose(6, "additive"))
query("w3_seasonal_additive_odd", _decompose_sql(7, "-", "+"))(_decompose(7, "additive"))
query("w4_seasonal_multiplicative", _decompose_sql(4, "/", "*"))(_decompose(4, "multiplicative"))

POS = f"SELECT user_id, row_number() OVER ({S}) - 1 AS pos, value, count(*) OVER (PARTITION BY user_id) AS n FROM events"


@query("w5_pad_sequences_post", f"""WITH s AS ({POS}), u AS (SELECT DISTINCT user_id FROM events), m AS (SELECT max(n) AS m FROM s),
g AS (SELECT user_id, unnest(range(m)) AS pos FROM u, m)
SELECT g.user_id, g.pos, coalesce(value, 0) AS value FROM g LEFT JOIN s USING (user_id, pos)""")
def w5(spark, sf):
    return W.pad_sequences(_ev(spark, sf), "user_id", ORDER, "value")


@query("w5_pad_sequences_pre", f"""WITH s AS ({POS}), u AS (SELECT DISTINCT user_id, n FROM s),
g AS (SELECT user_id, n, unnest(range(60)) AS pos FROM u)
SELECT g.user_id, g.pos, coalesce(value, -1) AS value FROM g LEFT JOIN s ON s.user_id = g.user_id AND s.pos = g.pos - (60 - least(g.n, 60))""")
def w5b(spark, sf):
    return W.pad_sequences(_ev(spark, sf), "user_id", ORDER, "value", 60, "pre", -1.0)


def _u(kind, start=1, extra="|| '|' || pos"):
    return f"('0x' || substr(md5('42|{kind}|' || user_id {extra}), {start}, 8))::BIGINT"


@query("w6_augment_noise", f"""WITH s AS ({POS})
SELECT user_id, pos, round(value + 0.1 * sqrt(-2 * ln(({_u('noise')} + 1) / 4294967296.0::DOUBLE))
  * cos(2 * pi() * ({_u('noise', 9)} / 4294967296.0::DOUBLE)), 6) + 0.0 AS augmented FROM s""")
def w6(spark, sf):
    return rounded(W.augment_noise(_ev(spark, sf), "user_id", ORDER, "value").select("user_id", "pos", "augmented"), ["augmented"])


@query("w7_augment_time_warp", f"""WITH s AS ({POS})
SELECT user_id, pos, round(value * (0.8 + 0.4 * ({_u('warp')} / 4294967296.0::DOUBLE)), 6) + 0.0 AS augmented FROM s""")
def w7(spark, sf):
    return rounded(W.augment_warp(_ev(spark, sf), "user_id", ORDER, "value").select("user_id", "pos", "augmented"), ["augmented"])


@query("w8_augment_crop", f"""WITH s AS ({POS}), c AS (SELECT *, floor(n * 0.9::DOUBLE)::BIGINT AS crop FROM s),
k AS (SELECT *, {_u('crop', 1, '')} % greatest(1, n - crop) AS start FROM c)
SELECT user_id, pos - start AS pos, value FROM k WHERE pos >= start AND pos < start + crop""")
def w8(spark, sf):
    return W.augment_crop(_ev(spark, sf), "user_id", ORDER, "value")


SPEC = f"""WITH s AS ({POS}), f AS (SELECT user_id, unnest(range((n - 16) // 8 + 1)) AS frame FROM (SELECT DISTINCT user_id, n FROM s WHERE n >= 16)),
x AS (SELECT f.user_id, frame, pos - frame * 8 AS i, value FROM f JOIN s ON s.user_id = f.user_id AND pos >= frame * 8 AND pos < frame * 8 + 16),
k AS (SELECT user_id, frame, k::INT AS k, sqrt(sum(value * cos(2 * pi() * ((k * i) % 16) / 16)) ** 2 + sum(value * sin(2 * pi() * ((k * i) % 16) / 16)) ** 2) AS magnitude
      FROM x, range(9) t(k) GROUP BY ALL)"""


@query("w9_spectrogram", f"{SPEC} SELECT user_id, frame, k, round(magnitude, 5) + 0.0 AS magnitude FROM k")
def w9(spark, sf):
    return rounded(P.spectrogram(_ev(spark, sf), "user_id", ORDER, "value", 16, 8), ["magnitude"], 5)


TOP = f"""WITH s AS ({POS}),
k AS (SELECT user_id, n, k, round(sqrt(sum(value * cos(2 * pi() * ((k * pos) % n) / n)) ** 2 + sum(value * sin(2 * pi() * ((k * pos) % n) / n)) ** 2), 9) AS m
      FROM (SELECT *, unnest(range(n // 2 + 1)) AS k FROM s) GROUP BY ALL),
t AS (SELECT user_id, k / n AS f, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, k) AS rk FROM k)"""


@query("w10_fourier_features", f"""{TOP}
SELECT event_id, e.user_id, {', '.join(f'round(cos(2 * pi() * t{i}.f * value), 5) + 0.0 AS cos_{i}, round(sin(2 * pi() * t{i}.f * value), 5) + 0.0 AS sin_{i}' for i in range(3))}
FROM events e {' '.join(f'LEFT JOIN t t{i} ON t{i}.user_id = e.user_id AND t{i}.rk = {i + 1}' for i in range(3))}""")
def w10(spark, sf):
    out = P.fourier_features(_ev(spark, sf), "user_id", ORDER, "value", 3).drop("ts", "value")
    return rounded(out, [c for c in out.columns if c[:3] in ("cos", "sin")], 5)


@query("w12_zero_crossing_rate", f"""WITH m AS (SELECT user_id, ts, event_id, value - avg(value) OVER (PARTITION BY user_id) AS v FROM events),
c AS (SELECT user_id, coalesce(((v < 0) <> (lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 0))::INT, 0) AS c FROM m)
SELECT user_id, round(avg(c), 6) AS zero_crossing_rate FROM c GROUP BY user_id""")
def w12(spark, sf):
    ev = _ev(spark, sf)
    means = ev.groupBy("user_id").agg(F.avg("value").alias("m"))
    centered = ev.join(means, "user_id").withColumn("value", F.col("value") - F.col("m")).drop("m")
    return rounded(W.zero_crossing_rate(centered, "user_id", ORDER, "value"), ["zero_crossing_rate"])


@query("w13_spectral_centroid", f"""{SPEC}, c AS (SELECT user_id, frame, coalesce(sum(k / 16 * magnitude) / sum(magnitude), 0) AS c FROM k GROUP BY ALL)
SELECT user_id, round(avg(c), 5) AS spectral_centroid FROM c GROUP BY user_id""")
def w13(spark, sf):
    return rounded(P.spectral_centroid(_ev(spark, sf), "user_id", ORDER, "value", 16, 8), ["spectral_centroid"], 5)
