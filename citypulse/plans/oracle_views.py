"""DuckDB text of the derived warehouse views, for the SQL oracle.

These are written independently of the Spark code in ``sources.warehouse``
and the plans, so the oracle check compares two implementations.
``with_views(body, *names)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


view("territorial_fact", [], """
SELECT l_orderkey * 8 + l_linenumber AS fact_impact_sk, l_partkey, l_suppkey, l_shipdate,
       l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS time_sk,
       CAST(c_nationkey + 1 AS INTEGER) AS zone_sk,
       CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 WHEN 'R' THEN 5 END AS mode_sk,
       CASE WHEN l_linenumber = 6 THEN 0.0::DOUBLE ELSE l_quantity END AS energie_kwh,
       CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE ELSE l_extendedprice / 100 END AS co2_kg,
       20.0::DOUBLE + l_discount * 400 AS aqi_index,
       5.0::DOUBLE + l_tax * 200 AS pm25,
       CAST(10 + l_partkey % 40 AS DOUBLE) AS no2,
       CASE WHEN l_partkey % 10 = 0 THEN 1 + l_suppkey % 2 ELSE 0 END AS nb_accidents,
       CASE WHEN l_partkey % 70 = 0 THEN 1 ELSE 0 END AS nb_graves,
       CASE WHEN l_partkey % 500 = 0 THEN 1 ELSE 0 END AS nb_mortels,
       CASE WHEN l_partkey % 30 = 0 THEN 1 ELSE 0 END AS usagers_vulnerables,
       20 + l_suppkey % 13 AS volume_crimes,
       0.5::DOUBLE + l_tax * 10 AS taux_criminalite
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")

view("time_dim", ["territorial_fact"], """
SELECT DISTINCT time_sk, time_sk // 100 AS annee, time_sk % 100 AS mois FROM territorial_fact""")

view("zone_dim", [], """
SELECT n_nationkey + 1 AS zone_sk,
       CASE WHEN n_nationkey >= 20 THEN 'UNKNOWN' ELSE '  ' || n_name END AS zone_nom,
       'Z' || CAST(n_nationkey AS VARCHAR) AS zone_code, r_name AS ville
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

view("territorial_dedup", ["territorial_fact", "time_dim"], """
SELECT f.*, t.annee, t.mois FROM territorial_fact f LEFT JOIN time_dim t USING (time_sk)
QUALIFY row_number() OVER (PARTITION BY f.time_sk, f.zone_sk, f.mode_sk
    ORDER BY fact_impact_sk, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
             l_quantity, l_discount, l_tax, l_linestatus) = 1""")

view("eco_clean", ["territorial_dedup", "zone_dim"], """
SELECT fact_impact_sk, time_sk, zone_sk, mode_sk, energie_kwh, co2_kg, aqi_index, pm25, no2,
       nb_accidents, nb_graves, nb_mortels, usagers_vulnerables, volume_crimes,
       taux_criminalite, annee, mois, zone_nom, zone_code, ville
FROM territorial_dedup d LEFT JOIN zone_dim z USING (zone_sk)
WHERE zone_sk BETWEEN 1 AND 10 AND zone_nom IS NOT NULL
  AND upper(trim(zone_nom)) <> 'UNKNOWN' AND co2_kg > 0""")

view("eco_ci", ["eco_clean"], """
SELECT *, CASE WHEN nullif(energie_kwh, 0) > 0 THEN nullif(co2_kg, 0) / nullif(energie_kwh, 0) END
          AS carbon_intensity,
       nullif(co2_kg, 0) AS co2_nz, nullif(energie_kwh, 0) AS energie_nz
FROM eco_clean""")

view("eco_features", ["eco_clean"], """
WITH base AS (
  SELECT *, make_date(annee, mois, 1) AS annee_mois_dt FROM eco_clean
  WHERE annee IS NOT NULL AND mois IS NOT NULL
    AND nullif(co2_kg, 0) IS NOT NULL AND nullif(aqi_index, 0) IS NOT NULL
    AND nullif(energie_kwh, 0) IS NOT NULL),
zc AS (SELECT zone_sk, CAST(dense_rank() OVER (ORDER BY zone_sk) - 1 AS INTEGER) AS zone_encoded
       FROM (SELECT DISTINCT zone_sk FROM base)),
mc AS (SELECT mode_sk, CAST(dense_rank() OVER (ORDER BY mode_sk) - 1 AS INTEGER) AS mode_encoded
       FROM (SELECT DISTINCT mode_sk FROM base)),
mm AS (SELECT mode_sk, avg(co2_kg) AS mode_co2_mean FROM base GROUP BY mode_sk),
lagged AS (
  SELECT b.*, zc.zone_encoded, mc.mode_encoded, mm.mode_co2_mean,
    sin(2 * pi() * mois / 12.0) AS mois_sin, cos(2 * pi() * mois / 12.0) AS mois_cos,
    ln(1 + co2_kg) AS co2_log, ln(1 + energie_kwh) AS energie_log,
    lag(co2_kg, 1) OVER w AS co2_lag1, lag(energie_kwh, 1) OVER w AS energie_lag1,
    lag(aqi_index, 1) OVER w AS aqi_lag1, lag(pm25, 1) OVER w AS pm25_lag1,
    lag(co2_kg, 3) OVER w AS co2_lag3, lag(energie_kwh, 3) OVER w AS energie_lag3,
    lag(aqi_index, 3) OVER w AS aqi_lag3, lag(pm25, 3) OVER w AS pm25_lag3,
    avg(co2_kg) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS co2_roll3,
    avg(energie_kwh) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS energie_roll3,
    avg(pm25) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pm25_roll3
  FROM base b JOIN zc USING (zone_sk) JOIN mc USING (mode_sk) JOIN mm USING (mode_sk)
  WINDOW w AS (PARTITION BY zone_sk, mode_sk ORDER BY annee_mois_dt, time_sk, fact_impact_sk))
SELECT *, CASE WHEN energie_kwh > 0 THEN co2_kg / energie_kwh END AS carbon_intensity
FROM lagged
WHERE co2_lag1 IS NOT NULL AND energie_lag1 IS NOT NULL AND aqi_lag1 IS NOT NULL
  AND pm25_lag1 IS NOT NULL""")

view("mobility_fact", [], """
SELECT event_id AS fact_mob_sk,
       CAST(strftime(date_trunc('hour', ts), '%Y%m%d%H') AS BIGINT) AS time_sk,
       CAST(user_id % 10 + 1 AS INTEGER) AS zone_sk, user_id AS line_sk,
       CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                       WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS mode_sk,
       CAST(user_id % 180 + 1 AS INTEGER) AS stop_sk,
       CASE WHEN event_type = 'error' AND k < 10 THEN 1 ELSE 0 END AS annule,
       value AS charge_estimee, CAST(k AS DOUBLE) AS vitesse_kmh,
       CAST(k % 45 + 5 AS DOUBLE) AS temps_trajet_min, k / 10.0::DOUBLE AS congestion_index,
       CASE WHEN k % 33 = 0 THEN NULL ELSE CAST(k % 5 + 1 AS DOUBLE) END AS stress_1_5,
       CAST(event_id % 5 + 1 AS DOUBLE) AS satisfaction_1_5
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")

view("mobility_time_dim", [], """
SELECT DISTINCT CAST(strftime(h, '%Y%m%d%H') AS BIGINT) AS time_sk,
       CAST(year(h) AS INTEGER) AS annee, CAST(month(h) AS INTEGER) AS mois,
       CAST(day(h) AS INTEGER) AS jour, strftime(h, '%H:%M:%S') AS heure,
       dayname(h) AS jour_semaine,
       CASE WHEN hour(h) < 6 THEN 'nuit' WHEN hour(h) < 12 THEN 'matin'
            WHEN hour(h) < 18 THEN 'apres-midi' ELSE 'soir' END AS periode,
       CASE WHEN isodow(h) - 1 >= 5 THEN '1' ELSE '0' END AS weekend
FROM (SELECT date_trunc('hour', ts) AS h FROM events)""")

view("mob_clean", ["mobility_fact", "mobility_time_dim"], """
SELECT f.fact_mob_sk, f.time_sk, f.zone_sk, f.line_sk, f.mode_sk, f.stop_sk, f.annule,
       f.charge_estimee, nullif(f.vitesse_kmh, 0) AS vitesse_kmh, f.temps_trajet_min,
       f.congestion_index, f.stress_1_5, f.satisfaction_1_5,
       t.annee, t.mois, t.heure, t.jour_semaine, t.periode, t.weekend
FROM mobility_fact f LEFT JOIN mobility_time_dim t USING (time_sk)""")

view("scored", [], """
SELECT event_id AS id,
       CASE WHEN event_type = 'error' AND k < 10 THEN 1 ELSE 0 END AS y_true,
       k / 100.0::DOUBLE AS score
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of ``names`` (and their dependencies).
    A body that starts with its own ``WITH`` is merged into the same list."""
    ctes = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _order(names)]
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


view("mob_features", ["mob_clean"], r"""
WITH z AS (SELECT zone_sk, median(vitesse_kmh) AS mv, median(temps_trajet_min) AS mt,
                  median(stress_1_5) AS ms FROM mob_clean GROUP BY zone_sk),
f1 AS (SELECT c.*, coalesce(c.vitesse_kmh, z.mv) AS v1, coalesce(c.temps_trajet_min, z.mt) AS t1,
              coalesce(c.stress_1_5, z.ms) AS s1
       FROM mob_clean c LEFT JOIN z USING (zone_sk)),
g AS (SELECT median(v1) AS gv, median(t1) AS gt, median(s1) AS gs FROM f1),
h AS (SELECT f1.* EXCLUDE (vitesse_kmh, temps_trajet_min, stress_1_5, v1, t1, s1),
             coalesce(v1, gv) AS vitesse_kmh, coalesce(t1, gt) AS temps_trajet_min,
             coalesce(s1, gs) AS stress_1_5,
             coalesce(TRY_CAST(nullif(regexp_extract(split_part(trim(CAST(heure AS VARCHAR)), ':', 1),
                      '(\d+)', 1), '') AS INTEGER), 0) AS hour,
             coalesce(TRY_CAST(CAST(weekend AS VARCHAR) AS INTEGER), 0) AS is_weekend
      FROM f1, g),
zc AS (SELECT zone_sk, CAST(dense_rank() OVER (ORDER BY zone_sk) - 1 AS INTEGER) AS zone_encoded
       FROM (SELECT DISTINCT zone_sk FROM h)),
lc AS (SELECT line_sk, CAST(dense_rank() OVER (ORDER BY line_sk) - 1 AS INTEGER) AS line_encoded
       FROM (SELECT DISTINCT line_sk FROM h)),
mc AS (SELECT mode_sk, CAST(dense_rank() OVER (ORDER BY mode_sk) - 1 AS INTEGER) AS mode_encoded
       FROM (SELECT DISTINCT mode_sk FROM h))
SELECT h.*, CASE WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS rush_hour,
       zone_encoded, line_encoded, mode_encoded, CAST(annule AS INTEGER) AS retard_flag
FROM h JOIN zc USING (zone_sk) JOIN lc USING (line_sk) JOIN mc USING (mode_sk)""")

view("mob_daily", ["mob_features"], """
SELECT zone_sk, CAST(make_date(annee, mois, 1) + CAST(pos % 28 AS INTEGER) AS DATE) AS ds,
       avg(congestion_index) AS y
FROM (SELECT *, row_number() OVER (PARTITION BY annee, mois, zone_sk ORDER BY hour, fact_mob_sk) - 1
             AS pos FROM mob_features)
WHERE congestion_index IS NOT NULL
GROUP BY zone_sk, ds""")


_TORDER = ("fact_impact_sk, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, "
           "l_discount, l_tax, l_linestatus")

view("safe_clean", ["territorial_fact", "time_dim", "zone_dim"], f"""
SELECT d.fact_impact_sk, d.time_sk, d.zone_sk, d.mode_sk,
       CAST(coalesce(nb_accidents, 0) AS INTEGER) AS nb_accidents,
       CAST(coalesce(nb_graves, 0) AS INTEGER) AS nb_graves,
       CAST(coalesce(nb_mortels, 0) AS INTEGER) AS nb_mortels,
       CAST(coalesce(usagers_vulnerables, 0) AS INTEGER) AS usagers_vulnerables,
       CAST(coalesce(volume_crimes, 0) AS INTEGER) AS volume_crimes,
       coalesce(taux_criminalite, 0) AS taux_criminalite,
       t.annee, t.mois, z.zone_nom, z.zone_code, z.ville,
       d.l_partkey, d.l_suppkey, d.l_shipdate, d.l_extendedprice, d.l_quantity, d.l_discount,
       d.l_tax, d.l_linestatus
FROM (SELECT * FROM territorial_fact QUALIFY row_number() OVER (
        PARTITION BY time_sk, zone_sk, mode_sk ORDER BY {_TORDER}) = 1) d
LEFT JOIN time_dim t USING (time_sk) LEFT JOIN zone_dim z USING (zone_sk)
WHERE d.zone_sk <= 10""")

_SEV = """
WITH st AS (SELECT sum(CASE WHEN nb_mortels > 0 THEN 1 ELSE 0 END) AS n_fatal,
                   avg(taux_criminalite) AS mu, stddev_samp(taux_criminalite) AS sd FROM {src}),
zc AS (SELECT zone_sk, CAST(dense_rank() OVER (ORDER BY zone_sk) - 1 AS INTEGER) AS zone_encoded
       FROM (SELECT DISTINCT zone_sk FROM {src})),
mc AS (SELECT mode_sk, CAST(dense_rank() OVER (ORDER BY mode_sk) - 1 AS INTEGER) AS mode_encoded
       FROM (SELECT DISTINCT mode_sk FROM {src})),
x AS (SELECT s.*, CASE WHEN st.n_fatal < 40
                   THEN CASE WHEN nb_graves > 0 OR nb_mortels > 0 THEN 1 ELSE 0 END
                   ELSE CASE WHEN nb_mortels > 0 THEN 2 WHEN nb_graves > 0 THEN 1 ELSE 0 END END
                 AS severity_class,
             round_even((nb_graves + nb_mortels) / CAST(nb_accidents + 1 AS DOUBLE), 4) AS gravite_index,
             CASE WHEN nb_accidents > 0 THEN 1 ELSE 0 END AS has_accident,
             round_even(coalesce((taux_criminalite - st.mu) / nullif(st.sd, 0), 0), 4) AS crime_rate_scaled
      FROM {src} s, st)
SELECT x.*, CASE severity_class WHEN 0 THEN 'Aucun incident' WHEN 1 THEN 'Accident grave'
                 WHEN 2 THEN 'Accident mortel' END AS severity_label, zone_encoded, mode_encoded
FROM x JOIN zc USING (zone_sk) JOIN mc USING (mode_sk)"""

view("safe_features", ["safe_clean"], _SEV.format(src="safe_clean"))

view("safe_raw", ["territorial_fact", "time_dim"], """
SELECT f.*, t.annee, t.mois FROM territorial_fact f LEFT JOIN time_dim t USING (time_sk)
WHERE zone_sk <= 10""")

view("safe_raw_features", ["safe_raw"], _SEV.format(src="safe_raw"))

view("eco_scored", ["eco_features"], """
SELECT *, energie_kwh * 15 AS co2_pred FROM eco_features""")
