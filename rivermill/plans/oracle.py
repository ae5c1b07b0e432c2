"""Shared SQL for DuckDB: the table roles of `plans.tables` as named CTEs."""

from __future__ import annotations

import re

# name -> (names it needs, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (
        (),
        """SELECT event_type AS site, event_type || '-' || (user_id % 3) AS station,
                  (user_id % 3 + 1)::INTEGER AS point, ts, value AS flow, event_id, props FROM events""",
    ),
    "hourly": (
        ("readings",),
        "SELECT site, date_trunc('hour', ts) AS ts, avg(flow) AS flow FROM readings GROUP BY 1, 2",
    ),
    "dense": (
        ("hourly",),
        """SELECT a.site, a.ts, h.flow
           FROM (SELECT site, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM hourly GROUP BY site) a
           LEFT JOIN hourly h ON h.site = a.site AND h.ts = a.ts""",
    ),
    "nation_orders": (
        (),
        """SELECT r_name AS site, n_name AS station, o_orderdate AS ts, o_totalprice / 1000 AS flow
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
    ),
    "daily": (
        ("nation_orders",),
        """SELECT a.site, a.ts, d.flow
           FROM (SELECT site, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM nation_orders GROUP BY site) a
           LEFT JOIN (SELECT site, ts, avg(flow) AS flow FROM nation_orders GROUP BY 1, 2) d ON d.site = a.site AND d.ts = a.ts""",
    ),
    "upstream": (
        ("nation_orders",),
        """SELECT a.site, a.station, a.ts, d.upstream
           FROM (SELECT site, station, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts
                 FROM nation_orders GROUP BY 1, 2) a
           LEFT JOIN (SELECT site, station, ts, avg(flow) AS upstream FROM nation_orders GROUP BY 1, 2, 3) d
             ON d.site = a.site AND d.station = a.station AND d.ts = a.ts""",
    ),
    "transit": (
        (),
        " UNION ALL ".join(
            f"SELECT r_name AS site, n_name AS station, '{season}' AS season, {hours} AS hours FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20"
            for season, hours in (("winter", "3.0::DOUBLE"), ("spring", "9.0::DOUBLE"), ("summer", "12.0::DOUBLE + n_nationkey % 5"))
        ),
    ),
    "weather_raw": (
        ("readings",),
        """SELECT site, point, date_trunc('hour', ts) AS ts, avg(flow) / 7 - 4 AS temp_c,
                  CASE WHEN avg(flow) > 45 THEN (avg(flow) - 45) / 10 ELSE 0.0 END AS precip_mm,
                  43.0::DOUBLE + point * point * 0.2::DOUBLE AS lat, 0.5::DOUBLE + point * 0.4::DOUBLE AS lon,
                  200.0::DOUBLE + point * 300.0::DOUBLE AS alt
           FROM readings GROUP BY 1, 2, 3""",
    ),
    "weather_norm": (
        ("weather_raw",),
        """SELECT site, point, ts, lat, lon, alt, temp_c + 273.15 AS temp_k,
                  sum(coalesce(precip_mm, 0)) OVER (PARTITION BY site, point ORDER BY ts) AS precip_cum_mm
           FROM weather_raw""",
    ),
    "weather": (
        ("weather_norm",),
        """SELECT a.site, a.point, a.ts, w.lat, w.lon, w.alt, w.temp_k, w.precip_cum_mm
           FROM (SELECT site, point, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
                 FROM weather_norm GROUP BY 1, 2) a
           LEFT JOIN weather_norm w ON w.site = a.site AND w.point = a.point AND w.ts = a.ts""",
    ),
    "basins": (
        (),
        """SELECT DISTINCT event_type AS site, 700.0::DOUBLE + length(event_type) * 120.0::DOUBLE AS alt_basin,
                  100.0::DOUBLE + length(event_type) * 10.0::DOUBLE AS surface_km2,
                  2.0::DOUBLE + length(event_type) * 0.1::DOUBLE AS k_base,
                  1.0::DOUBLE AS exposition, 0.9::DOUBLE AS kc_unit, 43.0::DOUBLE AS out_lat, 1.0::DOUBLE AS out_lon FROM events""",
    ),
    "point_dim": (
        ("weather", "basins"),
        """SELECT p.*, b.* EXCLUDE (site), 2 * 6371.0::DOUBLE * asin(sqrt(pow(sin(radians(p.plat - out_lat) / 2), 2)
                  + cos(radians(out_lat)) * cos(radians(p.plat)) * pow(sin(radians(p.plon - out_lon) / 2), 2))) AS distance_km, m.mean_temp_k
           FROM (SELECT site, point, arg_min(lat, ts) AS plat, arg_min(lon, ts) AS plon FROM weather WHERE lat IS NOT NULL GROUP BY 1, 2) p
           JOIN basins b ON b.site = p.site
           JOIN (SELECT site, point, arg_max(m, y) AS mean_temp_k FROM (SELECT site, point, year(ts) AS y, avg(temp_k) AS m FROM weather GROUP BY 1, 2, 3)
                 GROUP BY 1, 2) m ON m.site = p.site AND m.point = p.point""",
    ),
    "wb": (
        ("point_dim",),
        """SELECT w.site, w.point, w.ts, d.* EXCLUDE (site, point), w.temp_k, greatest(1, floor(distance_km / 3)::BIGINT) AS transfer_h,
                  CASE WHEN distance_km <= 50 THEN [1, 3, 6, 12, 24, 36, 48, 72] WHEN distance_km <= 100 THEN [6, 12, 24, 36, 48, 72]
                       WHEN distance_km <= 1000 THEN [12, 24, 36, 48, 72, 168] ELSE [24, 36, 48, 72, 168] END AS windows,
                  row_number() OVER p AS rn,
                  w.precip_cum_mm - lag(w.precip_cum_mm) OVER p AS step,
                  w.temp_k - 273.15 - (d.alt_basin - w.alt) * 0.0065 AS temp,
                  0.409 * sin(2 * pi() * dayofyear(w.ts) / 365 - 1.39) AS decl, radians(w.lat) AS phi
           FROM weather w JOIN point_dim d ON d.site = w.site AND d.point = w.point WINDOW p AS (PARTITION BY w.site, w.point ORDER BY w.ts)""",
    ),
    "wr": (
        ("wb",),
        """SELECT *, CASE WHEN temp > 0 THEN precip ELSE 0.0 END AS rain, CASE WHEN temp <= 0 THEN precip ELSE 0.0 END AS snow,
                  kc_unit * (0.0118 * (mean_temp_k - 273.15) + 0.21) * (24 * 60 / pi() * 0.082 * (1 + 0.033 * cos(2 * pi() * dayofyear(ts) / 365))
                    * (sunset * sin(phi) * sin(decl) + cos(phi) * cos(decl) * sin(sunset)) / 24 / 2.45) AS et0
           FROM (SELECT *, CASE WHEN step < 0 THEN 0.0 ELSE step END AS precip, acos(-tan(phi) * tan(decl)) AS sunset FROM wb)""",
    ),
    "melt_in": (
        ("wr",),
        """SELECT *, CASE WHEN factor / 24 * temp < 0 THEN 0.0 ELSE factor / 24 * temp END
                     + CASE WHEN ground_rain * temp < 0 THEN 0.0 ELSE ground_rain * temp END / 80 AS melt_potential
           FROM (SELECT *, CASE WHEN rain >= 1.0 THEN rain * 0.9 ELSE 0.0 END AS ground_rain,
                        (k_base + cos(2 * pi() * (dayofyear(ts) - 172) / 365)) * exposition AS factor FROM wr)""",
    ),
    "snow_walk": (
        ("melt_in",),
        """SELECT DISTINCT site, point, 0::BIGINT AS rn, 0.0::DOUBLE AS snow_stock, NULL::DOUBLE AS melt FROM melt_in
           UNION ALL
           SELECT m.site, m.point, m.rn,
                  CASE WHEN m.melt_potential IS NULL OR m.snow IS NULL THEN 0.0::DOUBLE
                       ELSE greatest(0.0, (s.snow_stock + m.snow - least(m.melt_potential, s.snow_stock + m.snow)) * 0.998) END,
                  CASE WHEN m.melt_potential IS NULL THEN NULL WHEN m.snow IS NULL THEN m.melt_potential
                       ELSE least(m.melt_potential, s.snow_stock + m.snow) END
           FROM snow_walk s JOIN melt_in m ON m.site = s.site AND m.point = s.point AND m.rn = s.rn + 1""",
    ),
    "runoff": (
        ("snow_walk",),
        """SELECT m.*, w.snow_stock, w.melt, CASE WHEN ground_rain + w.melt - et0 > 0.1 THEN ground_rain + w.melt - et0 ELSE 0.0 END AS inflow_raw,
                  alt_basin > 1300 AS high
           FROM melt_in m JOIN snow_walk w ON w.site = m.site AND w.point = m.point AND w.rn = m.rn""",
    ),
    "net": (
        ("runoff",),
        """SELECT *, CASE WHEN high THEN inflow_raw * frost ELSE inflow_raw END AS net_inflow, CASE WHEN high THEN frost END AS frost_factor
           FROM (SELECT *, pow(CASE WHEN (temp_24h + 3) / 2 < 0.05 THEN 0.05 WHEN (temp_24h + 3) / 2 > 1 THEN 1.0 ELSE (temp_24h + 3) / 2 END, 3) AS frost
                 FROM (SELECT *, avg(temp) OVER (PARTITION BY site, point ORDER BY rn ROWS 23 PRECEDING) AS temp_24h,
                              avg(temp) OVER (PARTITION BY site, point ORDER BY rn ROWS 47 PRECEDING) AS temp_48h FROM runoff))""",
    ),
    "arrived": (
        ("net",),
        """SELECT a.*, b.net_inflow AS inflow_shifted, b.net_inflow * a.surface_km2 / 3.6 AS discharge
           FROM net a LEFT JOIN net b ON b.site = a.site AND b.point = a.point AND b.rn = a.rn - a.transfer_h""",
    ),
    "numbered_daily": (("daily",), "SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts) AS rn FROM daily"),
    "flow_lag": (
        ("numbered_daily",),
        """SELECT *, lag(flow, 7) OVER w AS lag_7, lag(flow, 8) OVER w AS lag_8, lag(flow, 12) OVER w AS lag_12, lag(flow, 14) OVER w AS lag_14,
                  lag(flow, 16) OVER w AS lag_16, lag(flow, 24) OVER w AS lag_24, lag(flow, 32) OVER w AS lag_32,
                  CASE WHEN count(flow) OVER y >= 30 THEN quantile_cont(flow, 0.95) OVER y END AS q95_year, max(flow) OVER m AS top
           FROM numbered_daily WINDOW w AS (PARTITION BY site ORDER BY ts), y AS (PARTITION BY site ORDER BY ts ROWS 364 PRECEDING),
                  m AS (PARTITION BY site ORDER BY ts ROWS 29 PRECEDING)""",
    ),
    "flow_feat": (
        ("flow_lag",),
        """SELECT *, CASE WHEN top > q95_year THEN q95_year ELSE top END AS max_seen_30d FROM flow_lag""",
    ),
    "registry": (
        (),
        """SELECT 'P' || p_partkey AS site, p_partkey AS site_order,
                  upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || ' ' || p_partkey AS plant,
                  CASE WHEN p_size % 5 = 0 THEN 'MANUAL' ELSE 'DEFAULT' END AS strategy,
                  CASE WHEN p_partkey % 11 <> 0 THEN 1.0::DOUBLE + p_size / 100.0::DOUBLE END AS flow_factor,
                  CASE WHEN p_partkey % 13 <> 0 THEN 'ST' || (p_partkey % 50) END AS ref_station,
                  CASE WHEN p_partkey % 7 <> 0 THEN
                    CASE WHEN (p_partkey * 3) % 50 = (p_partkey * 7) % 50 THEN ['ST' || ((p_partkey * 3) % 50)]
                         ELSE ['ST' || ((p_partkey * 3) % 50), 'ST' || ((p_partkey * 7) % 50)] END END AS upstream_stations,
                  CASE WHEN p_partkey % 3 <> 0 THEN p_size / 20.0::DOUBLE END AS reserve_flow,
                  CASE WHEN p_partkey % 3 = 0 THEN p_size / 10.0::DOUBLE END AS reserve_summer,
                  CASE WHEN p_partkey % 3 = 0 THEN p_size / 25.0::DOUBLE END AS reserve_winter,
                  p_partkey % 4 AS n_groups, p_partkey, p_size, p_retailprice
           FROM part""",
    ),
    # One row per turbine group, in listed order.
    "groups": (
        ("registry",),
        """SELECT site, i, CASE WHEN (p_partkey + i) % 17 <> 0 THEN 'G' || i END AS name,
                  (p_partkey * 7 + i * 3) % 5 AS priority,
                  CASE WHEN (p_partkey + i) % 19 <> 0 THEN p_size::DOUBLE / (i + 2) END AS arm_flow,
                  p_size::DOUBLE / i + 1 AS max_flow, 60.0::DOUBLE + i AS e0, 0.5::DOUBLE AS e1, -0.01::DOUBLE AS e2,
                  (p_partkey + i) % 23 <> 0 AS has_head, p_retailprice / 100 AS h0a, p_retailprice / 120 AS h0b
           FROM registry, LATERAL (SELECT unnest([1, 2, 3]) AS i) WHERE i <= n_groups""",
    ),
    "inflow": (
        (),
        """SELECT 'P' || l_partkey AS site, l_shipdate AS ts, l_quantity AS flow, l_orderkey, l_linenumber FROM lineitem""",
    ),
    "forecasts": (
        ("dense",),
        """SELECT site, ts, flow AS y, lead, lag(flow, lead) OVER w AS persistence, lag(day_mean, lead) OVER w AS day_mean
           FROM (SELECT *, avg(flow) OVER (PARTITION BY site ORDER BY ts ROWS 23 PRECEDING) AS day_mean FROM dense) d,
                LATERAL (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS lead)
           WINDOW w AS (PARTITION BY site, lead ORDER BY ts)""",
    ),
    "scored": (
        ("forecasts",),
        """SELECT site, ts, 'persistence' AS model, lead, y, persistence AS p FROM forecasts
           UNION ALL SELECT site, ts, 'day_mean', lead, y, day_mean FROM forecasts""",
    ),
    # Complete pairs only; the aggregates below then see the same rows on both sides.
    "pairs": (("scored",), "SELECT * FROM scored WHERE y IS NOT NULL AND p IS NOT NULL"),
    "limits": (
        ("dense",),
        "SELECT site, quantile_cont(flow, 0.33) AS q33, quantile_cont(flow, 0.9) AS q90 FROM dense GROUP BY site",
    ),
    "regimes": (
        ("pairs", "limits"),
        """SELECT p.*, CASE WHEN y <= q33 THEN 'low' WHEN y <= q90 THEN 'normal' ELSE 'flood' END AS regime
           FROM pairs p JOIN limits l ON l.site = p.site""",
    ),
    "all_regimes": (
        ("scored", "limits"),
        """SELECT p.*, CASE WHEN y <= q33 THEN 'low' WHEN y <= q90 THEN 'normal' ELSE 'flood' END AS regime
           FROM scored p JOIN limits l ON l.site = p.site WHERE y IS NOT NULL""",
    ),
}

# Read more than once, or from a recursive part.
STORED = {"readings", "dense", "daily", "weather", "melt_in", "runoff", "net", "arrived", "flow_lag", "upstream", "transit"}


def ewm_sql(source: str, keys: str, span: float, value: str, name: str) -> str:
    """Weighted mean over all earlier rows, straight from the definition; `source` has a row number `rn`."""
    q = f"(1 - 2 / ({span} + 1.0::DOUBLE))"
    same_key = " AND ".join(f"b.{k} = a.{k}" for k in keys.split(", "))
    listed = ", ".join(f"a.{k}" for k in keys.split(", "))
    return f"""SELECT {listed}, a.rn, sum(b.{value} * pow({q}, a.rn - b.rn)) / sum(pow({q}, a.rn - b.rn)) AS {name}, count(*) AS n
      FROM {source} a JOIN {source} b ON {same_key} AND b.rn <= a.rn AND b.{value} IS NOT NULL GROUP BY {listed}, a.rn"""


SEASON = """CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) IN (3, 4, 5) THEN 'spring'
 WHEN month(ts) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """`body` behind the named CTEs, the ones those need, and query-local `extra` CTEs in listed order."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in CTES[name][0]:
                add(need)
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS {'MATERIALIZED ' if n in STORED else ''}({CTES[n][1]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    named = [(n, CTES[n][1]) for n in order] + list((extra or {}).items())
    recursive = "RECURSIVE " if any(re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql) for n, sql in named) else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + body if parts else body


def rounded(digits: int = 6, **exprs: str) -> str:
    """`round(expr) AS name` list; adding zero turns -0.0 into 0.0."""
    return ", ".join(f"round(({e})::DOUBLE, {digits}) + 0.0 AS {n}" for n, e in exprs.items())


def same(digits: int, *names: str) -> str:
    return rounded(digits, **{n: n for n in names})


def kge_sql(y: str = "y", p: str = "p") -> dict[str, str]:
    """KGE parts as DuckDB aggregates over complete pairs."""
    r = f"corr({y}, {p})"
    a = f"(stddev_pop({p}) / (stddev_pop({y}) + 1e-6))"
    b = f"(avg({p}) / (avg({y}) + 1e-6))"
    return {
        "kge": f"(1 - sqrt(pow({r} - 1, 2) + pow({a} - 1, 2) + pow({b} - 1, 2)))",
        "r": r,
        "alpha": a,
        "beta": b,
    }
