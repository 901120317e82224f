"""Registered time-series queries with SQL oracles (decomposition)."""

from __future__ import annotations

from citypulse.plans import ecology as E
from citypulse.plans import mobility as M
from citypulse.plans.catalog import register
from citypulse.plans.oracle_views import with_views
from citypulse.timeseries.decompose import classical_decompose


def _decomp_sql(src: str, key: str, ds: str, y: str, p: int) -> str:
    h = p // 2
    trend = (f"(s - 0.5 * lg - 0.5 * ld) / {p}" if p % 2 == 0 else f"s / {p}")
    return f"""
WITH s0 AS (SELECT {key}, {ds} AS ds, {y} AS y FROM {src}),
s AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY {key}) AS n,
             sum(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS s,
             lag(y, {h}) OVER w AS lg, lead(y, {h}) OVER w AS ld
      FROM s0 WINDOW w AS (PARTITION BY {key} ORDER BY ds)),
t AS (SELECT *, CASE WHEN pos >= {h} AND pos < n - {h} THEN {trend} END AS trend FROM s),
d AS (SELECT *, y - trend AS detr, pos % {p} AS ph FROM t),
pa AS (SELECT {key}, ph, avg(detr) AS a FROM d GROUP BY ALL),
pc AS (SELECT {key}, ph, a - avg(a) OVER (PARTITION BY {key}) AS seasonal FROM pa)
SELECT d.{key}, d.ds, d.y, d.trend, pc.seasonal, d.detr - pc.seasonal AS resid
FROM d JOIN pc ON d.{key} = pc.{key} AND d.ph = pc.ph"""


@register("eco_aqi_decomposition", "W9 Y11 G3",
          "zone_sk:i ds:d y:f trend:f seasonal:f resid:f",
          with_views("""
WITH m AS (SELECT zone_sk, make_date(annee, mois, 1) AS annee_mois_dt, avg(aqi_index) AS aqi_index
           FROM eco_clean GROUP BY ALL)""" + _decomp_sql("m", "zone_sk", "annee_mois_dt",
                                                          "aqi_index", 12).replace("WITH", ",", 1),
                     "eco_clean"))
def eco_aqi_decomposition(w):
    """Classical additive decomposition (period 12) of each zone's monthly
    AQI series: centred moving-average trend, seasonal means, residual."""
    m = E.zone_month_targets(E.clean_territorial(w)).selectExpr(
        "zone_sk", "annee_mois_dt AS ds", "aqi_index AS y")
    return classical_decompose(m, ["zone_sk"], "ds", "y", 12)


@register("mob_congestion_decomposition", "W9 Y11",
          "zone_sk:i ds:d y:f trend:f seasonal:f resid:f",
          with_views(_decomp_sql("mob_daily", "zone_sk", "ds", "y", 7), "mob_daily"))
def mob_congestion_decomposition(w):
    """Weekly (period 7) additive decomposition of each zone's daily
    congestion series."""
    d = M.daily_congestion(M.engineer_features(M.clean_mobility(w)))
    return classical_decompose(d, ["zone_sk"], "ds", "y", 7)
