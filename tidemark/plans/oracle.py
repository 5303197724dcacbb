"""DuckDB SQL that recomputes the registered queries from the same Parquet
tables (views ``events``, ``orders``, ...). Used as the correctness oracle.

The SQL is written the straightforward way (whole-series windows, a
recursive CTE for the exponential mean) so that it checks the Spark plans'
block layouts and scans rather than repeating them.
"""

from __future__ import annotations

# Half-up rounding of integer cents: (2*s + n) // (2*n), s >= 0.
def _cents_avg(frame: str) -> str:
    s = f"sum(CAST(round(close * 100) AS BIGINT)) OVER ({frame})"
    n = f"count(close) OVER ({frame})"
    return f"((2 * {s} + {n}) // (2 * {n})) / 100.0"


def _rows(n: int) -> str:
    return f"PARTITION BY series ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def ticks_cte(key: str = "event_type") -> str:
    series = "'all'" if key is None else f"CAST({key} AS VARCHAR)"
    return f"""
ticks AS (
  SELECT {series} AS series, ts, event_id AS tick_id, value AS price
  FROM events
)"""


TICKS = ticks_cte()

CANDLES = TICKS + """,
candles AS (
  SELECT series, date_trunc('hour', ts) AS open_time,
         first(price ORDER BY ts, tick_id) AS open,
         max(price) AS high,
         min(price) AS low,
         last(price ORDER BY ts, tick_id) AS close,
         sum(CAST(round(price * 100) AS BIGINT)) / 100.0 AS volume
  FROM ticks GROUP BY 1, 2
)"""

_VALID = """close IS NOT NULL AND NOT isnan(close) AND close > 0
    AND volume IS NOT NULL AND NOT isnan(volume) AND volume >= 0"""

# Cleaned candles with their position in the series.
CLEAN = CANDLES + f""",
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY series, open_time
                                 ORDER BY open, high, low, close, volume) AS rn
    FROM candles) WHERE rn = 1
),
clean AS (SELECT *, CAST(NULL AS BIGINT) AS tick_id FROM dedup WHERE {_VALID}),
posd AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time) - 1 AS pos FROM clean
)"""


def tick_clean(key: str | None = "event_type") -> str:
    """Ticks read as candles (open = high = low = close = volume = price),
    cleaned and positioned by (ts, tick_id)."""
    return ticks_cte(key) + f""",
clean AS (
  SELECT series, ts AS open_time, tick_id, price AS open, price AS high, price AS low,
         price AS close, price AS volume
  FROM ticks WHERE {_VALID.replace('close', 'price').replace('volume', 'price')}
),
posd AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time, tick_id) - 1 AS pos
  FROM clean
)"""


def order_clean() -> str:
    """``orders`` as one long series ordered by (o_orderdate, o_orderkey)."""
    return f"""
clean AS (
  SELECT 'all' AS series, o_orderdate AS open_time, o_orderkey AS tick_id,
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low,
         o_totalprice AS close, o_totalprice AS volume
  FROM orders WHERE {_VALID.replace('close', 'o_totalprice').replace('volume', 'o_totalprice')}
),
posd AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time, tick_id) - 1 AS pos
  FROM clean
)"""


def _var_cents(n: int) -> str:
    fr = _rows(n)
    c = "CAST(round(close * 100) AS BIGINT)"
    k = f"count(close) OVER ({fr})"
    s1 = f"sum({c}) OVER ({fr})"
    s2 = f"sum({c} * {c}) OVER ({fr})"
    return (f"CASE WHEN {k} > 1 THEN round(sqrt(({k} * {s2} - {s1} * {s1}) / "
            f"({k} * ({k} - 1))) / 100.0, 2) END")


def windowed_cte(clean: str) -> str:
    return clean + f""",
win AS (
  SELECT series, pos, open_time, tick_id, open, high, low, close, volume,
         CAST(hour(open_time) AS INTEGER) AS hour,
         CAST(dayofweek(open_time) + 1 AS INTEGER) AS day_of_week,
         CAST(month(open_time) AS INTEGER) AS month,
         round(high - low, 2) AS price_range,
         round(ln(close / lag(close, 1) OVER (PARTITION BY series ORDER BY pos)), 6) AS returns,
         {_cents_avg(_rows(7))} AS ma_7,
         {_cents_avg(_rows(24))} AS ma_24,
         {_cents_avg(_rows(168))} AS ma_168,
         {_var_cents(24)} AS volatility_24,
         lag(close, 1) OVER (PARTITION BY series ORDER BY pos) AS lag_1,
         lag(close, 3) OVER (PARTITION BY series ORDER BY pos) AS lag_3,
         lag(close, 6) OVER (PARTITION BY series ORDER BY pos) AS lag_6,
         lag(close, 24) OVER (PARTITION BY series ORDER BY pos) AS lag_24,
         close - lag(close, 1) OVER (PARTITION BY series ORDER BY pos) AS delta
  FROM posd
)"""


WINDOWED = windowed_cte(CLEAN)


def rsi_cte(src: str, start: int, name: str = "rsi", period: int = 14) -> str:
    """Recursive RSI over rows of ``src`` (series, pos, delta) with pos >= start.
    The row at ``start`` has no delta; the next row seeds the means."""
    a = f"(1.0 / {period})"
    d = f"(1.0 - 1.0 / {period})"
    return f""",
{name}_in AS (SELECT series, pos, delta FROM {src} WHERE pos > {start}),
{name}_rec AS (
  SELECT series, pos, greatest(delta, 0) AS g, greatest(-delta, 0) AS l
  FROM {name}_in WHERE pos = {start + 1}
  UNION ALL
  SELECT b.series, b.pos,
         r.g * {d} + greatest(b.delta, 0) * {a},
         r.l * {d} + greatest(-b.delta, 0) * {a}
  FROM {name}_rec r JOIN {name}_in b ON b.series = r.series AND b.pos = r.pos + 1
),
{name} AS (
  SELECT series, pos,
         round(100 - 100 / (1 + g / CASE WHEN l = 0 THEN 1e-10 ELSE l END), 2) AS rsi_14
  FROM {name}_rec
)"""


FEATURE_SELECT = """series, open_time, open, high, low, close, volume, hour, day_of_week, month,
price_range, returns, ma_7, ma_24, ma_168, volatility_24, lag_1, lag_3, lag_6, lag_24"""

def features_cte(clean: str = CLEAN) -> str:
    """CTE ``features``: the trimmed feature table with RSI seeded after the
    trim, plus ``tick_id`` and ``fpos`` (position in the feature table)."""
    cols = ", ".join("w." + c.strip() for c in FEATURE_SELECT.split(","))
    return windowed_cte(clean) + rsi_cte("win", 24) + f""",
features AS (
  SELECT {cols}, r.rsi_14, w.tick_id, w.pos - 24 AS fpos
  FROM win w LEFT JOIN rsi r ON r.series = w.series AND r.pos = w.pos
  WHERE w.pos >= 24 AND w.lag_24 IS NOT NULL AND w.returns IS NOT NULL
    AND w.volatility_24 IS NOT NULL
)"""


FEATURES = features_cte()


def with_(ctes: str, body: str) -> str:
    """``WITH RECURSIVE <ctes> <body>`` (RECURSIVE is harmless when unused)."""
    return f"WITH RECURSIVE {ctes.strip().lstrip(',')}\n{body}"
