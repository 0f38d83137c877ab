"""Queries of the long and wide tables: ordered deduplication, blocks, pivots, lookups, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, columns, combine, dedup, enrich, stats
from ..operators.blocks import EXAM_BINS, EXAM_LOW, EXAM_TOP, MIDDLE_BINS, MIDDLE_LOW, MIDDLE_TOP, Bins, Outcomes, Shares, Single, Total, Years
from ..sources.csv import normalize_long
from .registry import OBS_SQL, observations, query, table
from .wide import RELEASE_BLOCKS, Sides, build_wide

YEAR_BLOCKS = [Years("view", "10_", label="view"), Years("click", "11_", label="click"), Years("error", "12_", label="error")]


def _years_sql(labels: dict[str, str], star: str = "*", slope: str = "regr_slope") -> str:
    out = []
    for ep, name in labels.items():
        here = f"endpoint_key = '{ep}'"
        for k in range(1, 6):
            out.append(f"arg_min(v, ord) FILTER ({here} AND y = {k}) AS \"{name}_y{k}\"")
        out.append(f"avg(v) FILTER ({here}) AS \"{star}{name}_mean_y\"")
        out.append(f"avg(v) FILTER ({here} AND y IN (1, 2)) AS \"{star}{name}_mean_y1y2\"")
        if slope:
            out.append(f"{slope}(v, y) FILTER ({here}) AS \"{star}{name}_slope_y\"")
    return ", ".join(out)


_NAMES = {"view": "10_view", "click": "11_click", "error": "12_error"}


@query(f"WITH {OBS_SQL} SELECT entity_id, min(entity_name) AS entity_name, {_years_sql(_NAMES)} FROM obs GROUP BY entity_id")
def wide_years(spark, sf_dir):
    return build_wide(observations(spark, sf_dir), YEAR_BLOCKS, slopes="none")


_FIRSTS_SQL = f"""firsts AS (SELECT entity_id, endpoint_key, y, arg_min(v, ord) AS v FROM obs GROUP BY ALL),
    slopes AS (SELECT entity_id, {", ".join(f"regr_slope(v, y) FILTER (endpoint_key = '{e}') AS {e}" for e in _NAMES)} FROM firsts GROUP BY entity_id)"""


@query(f"""WITH {OBS_SQL}, {_FIRSTS_SQL}, w AS (SELECT entity_id, min(entity_name) AS entity_name, {_years_sql(_NAMES, slope="")} FROM obs GROUP BY entity_id)
SELECT w.*, view AS "*10_view_slope_y", click AS "*11_click_slope_y", error AS "*12_error_slope_y" FROM w JOIN slopes USING (entity_id)""")
def wide_years_forced_slope(spark, sf_dir):
    return build_wide(observations(spark, sf_dir), YEAR_BLOCKS, slopes="year")


def _registry(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS entity_id", "c_mktsegment AS segment", "concat('NATION_', c_nationkey) AS comune", "concat('P', c_nationkey % 3) AS provincia", "cast(c_custkey % 90000 AS string) AS cap")
    return rows


def _places(spark, sf_dir):
    """Nations but each seventh; every third only without its province."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = nation.where("n_nationkey % 7 != 0").join(region, nation["n_regionkey"] == region["r_regionkey"])
    return enrich.municipality_lookup(rows.withColumn("sig", F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("p"), F.col("n_nationkey") % 3)).otherwise(F.lit(""))), "n_name", "sig", "r_name", "n_name", [F.col("n_nationkey")])


def _classes(spark, sf_dir):
    return enrich.class_lookup(table(spark, sf_dir, "nation").where("n_nationkey % 5 != 0").withColumn("c", F.concat(F.lit("class "), F.col("n_regionkey"))), "n_name", "c", [F.col("n_nationkey")])


@query(f"""WITH {OBS_SQL}, {_FIRSTS_SQL},
w AS (SELECT entity_id, min(entity_name) AS entity_name, {_years_sql(_NAMES, slope="")}, sum(v) FILTER (endpoint_key = 'purchase' AND scope) AS "13_purchase_sum",
    arg_min(v, ord) FILTER (endpoint_key = 'signup' AND scope) AS "14_signup" FROM obs GROUP BY entity_id),
f AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, round(c_acctbal, 2) AS "05_saldo", c_mktsegment AS segment_sicstu FROM customer WHERE c_custkey % 2 = 0),
r AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_mktsegment AS segment, 'NATION_' || c_nationkey AS comune, 'P' || c_nationkey % 3 AS provincia, CAST(c_custkey % 90000 AS VARCHAR) AS cap, c_nationkey AS k FROM customer)
SELECT w.*, view AS "*10_view_slope_y", click AS "*11_click_slope_y", error AS "*12_error_slope_y", segment, comune, provincia, cap, "05_saldo", segment_sicstu,
    CASE WHEN r.k % 5 <> 0 THEN 'class ' || n.n_regionkey ELSE '{enrich.DEFAULT_CLASS}' END AS class,
    CASE WHEN r.k % 7 <> 0 THEN g.r_name ELSE '' END AS region, CASE WHEN r.k % 7 <> 0 THEN n.n_name ELSE '' END AS macroarea
FROM w JOIN slopes USING (entity_id) LEFT JOIN r USING (entity_id) LEFT JOIN f USING (entity_id) LEFT JOIN nation n ON n.n_nationkey = r.k LEFT JOIN region g ON g.r_regionkey = n.n_regionkey""")
def wide_full(spark, sf_dir):
    figures = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").selectExpr("cast(c_custkey AS string) AS entity_id", "round(c_acctbal, 2) AS `05_saldo`", "c_mktsegment AS segment")
    more = [Total("purchase", "13_", name="purchase_sum"), Single("signup", "14_", name="signup")]
    sides = Sides(registry=_registry(spark, sf_dir), figures=figures, classes=_classes(spark, sf_dir), places=_places(spark, sf_dir))
    return build_wide(observations(spark, sf_dir), YEAR_BLOCKS + more, sides)


@query("""
SELECT 'RM' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS entity_id, '' AS entity_name, event_type AS endpoint_key, 'y' || (1 + (day(ts) - 1) // 7) AS category, '' AS level,
    CASE WHEN event_id % 5 <> 0 THEN value END AS value_num, CASE WHEN event_id % 5 = 0 THEN 'n.d.' ELSE '' END AS value_text, event_id AS src_ord FROM events WHERE event_id % 11 <> 0
""", name="normalize_long")
def normalize_long_table(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr(
        "if(event_id % 11 = 0, '  ', concat(' rm', lpad(user_id, 8, '0'))) AS CODICE_SCUOLA",
        "event_type AS ENDPOINT",
        "concat('y', 1 + (day(ts) - 1) div 7, ' ') AS Category",
        "CASE event_id % 5 WHEN 0 THEN ' n.d.' WHEN 1 THEN replace(cast(value AS string), '.', ',') ELSE cast(value AS string) END AS value",
        "event_id",
    )
    return normalize_long(raw, F.col("event_id"))


_ORDERS_FIRST = "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {}) AS n FROM orders) WHERE n = 1"


@query(_ORDERS_FIRST.format("o_orderdate, o_orderkey"))
def keep_first(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(_ORDERS_FIRST.format("o_orderstatus = 'F' DESC, o_orderkey"))
def prefer_populated(spark, sf_dir):
    return dedup.keep_preferred(table(spark, sf_dir, "orders"), ["o_custkey"], [(F.col("o_orderstatus") == "F").desc()], [F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(_ORDERS_FIRST.format("nullif(o_orderpriority, '1-URGENT') NULLS LAST, o_orderkey"))
def prefer_smallest(spark, sf_dir):
    smallest = F.nullif("o_orderpriority", F.lit("1-URGENT")).asc_nulls_last()
    return dedup.keep_preferred(table(spark, sf_dir, "orders"), ["o_custkey"], [smallest], [F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""
SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 = 2) AS priority, coalesce(arg_min(o_orderstatus, o_orderkey) FILTER (o_orderstatus <> 'F'), 'nan') AS status FROM orders GROUP BY o_custkey
""")
def first_nonempty(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_custkey", "CASE o_orderkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'NaN' ELSE o_orderpriority END AS priority", "if(o_orderstatus = 'F', 'nan', o_orderstatus) AS status", "o_orderkey AS src_ord")
    a = dedup.first_nonempty(rows.drop("status"), ["o_custkey"], F.col("src_ord"))
    b = dedup.first_nonempty(rows.drop("priority"), ["o_custkey"], F.col("src_ord"), fallback=True)
    return a.join(b, "o_custkey")


@query(f"WITH {OBS_SQL} SELECT entity_id, avg(v) FILTER (endpoint_key = 'view') AS mean_y, avg(v) FILTER (endpoint_key = 'view' AND y IN (1, 2)) AS mean_y1y2 FROM obs GROUP BY entity_id")
def conditional_mean(spark, sf_dir):
    return blocks.aggregate_blocks(observations(spark, sf_dir), [Years("view", label="v")]).select("entity_id", F.col("v_mean_y").alias("mean_y"), F.col("v_mean_y1y2").alias("mean_y1y2"))


_ORDER_OBS = ("cast(o_custkey AS string) AS entity_id", "'' AS entity_name", "'orders' AS endpoint_key", "o_orderpriority AS category", "if(o_orderstatus = 'F', 'scuola', '') AS level", "o_totalprice AS value_num", "o_orderkey AS src_ord")


@query("SELECT CAST(o_custkey AS VARCHAR) AS entity_id, round(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'F'), 2)::DOUBLE AS total FROM orders GROUP BY o_custkey")
def scope_sum(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").selectExpr(*_ORDER_OBS)
    return blocks.aggregate_blocks(obs, [Total("orders", name="total")]).withColumn("total", F.round("total", 2))


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, arg_min(o_totalprice, o_orderkey) FILTER (o_orderkey % 2 = 0 AND o_orderstatus = 'F') AS even, arg_min(o_totalprice, o_orderkey) FILTER (o_orderkey % 2 = 1) AS odd FROM orders GROUP BY o_custkey
""")
def scope_fallback_single(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").selectExpr(*_ORDER_OBS).withColumn("endpoint_key", F.when(F.col("src_ord") % 2 == 0, "even").otherwise("odd")).withColumn("level", F.when(F.col("src_ord") % 2 == 0, F.col("level")).otherwise(""))
    return blocks.aggregate_blocks(obs, [Single("even", name="even"), Single("odd", name="odd")])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 1 OR o_orderstatus = 'F'")
def scope_fallback_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("parity", F.col("o_orderkey") % 2)
    return blocks.with_scope_fallback(rows, (F.col("parity") == 0) & (F.col("o_orderstatus") == "F"), ["parity"]).select("o_orderkey")


@query("""
SELECT CAST(l_suppkey AS VARCHAR) AS entity_id, """ + ", ".join(f"arg_min(l_quantity, l_orderkey * 100 + l_linenumber) FILTER (l_returnflag || ' ' || l_linestatus = '{c}') AS entrate_{c.lower().replace(' ', '_')}_pct" for c in ("A F", "A O", "N F", "N O", "R F", "R O")) + " FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_returnflag, l_linestatus, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def share_pivot_open(spark, sf_dir):
    # of lines with the same number the one of the least quantity counts
    at = dedup.fixed_width_order(F.expr("l_orderkey * 100 + l_linenumber"), F.col("l_quantity"))
    obs = table(spark, sf_dir, "lineitem").withColumn("src_ord", at).selectExpr("cast(l_suppkey AS string) AS entity_id", "'lines' AS endpoint_key", "concat(l_returnflag, ' ', l_linestatus) AS category", "l_quantity AS value_num", "src_ord")
    return blocks.share_pivot(obs, "lines")


_LONG_NAME = "Contributi delle famiglie e di altri privati "
_LONG_SLUGS = [f"contributi_delle_famiglie_e_di_altri_privati_{k}_ann" for k in range(1, 6)]
_AREA_SQL = f"""o AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, 'user ' || user_id AS entity_name, CASE WHEN event_id % 2 = 0 THEN 'SUD' ELSE 'CENTRO' END AS area, event_type AS ep, value AS v, event_id AS ord,
    event_id % 6 = 0 AND event_type <> 'error' AS scope, CASE WHEN event_id % 13 = 0 THEN 'cat_empty' ELSE substr('contributi_delle_famiglie_e_di_altri_privati_' || (1 + (day(ts) - 1) // 7) || '_anno', 1, 50) END AS cat FROM events),
k AS (SELECT *, v IS NOT NULL AND (scope OR NOT bool_or(scope AND v IS NOT NULL) OVER (PARTITION BY area, ep)) AS kept FROM o)"""


@query(f"""WITH {_AREA_SQL} SELECT entity_id, area, min(entity_name) AS entity_name, """ + ", ".join(f"arg_min(v, ord) FILTER (kept AND ep = '{ep}' AND cat = '{c}') AS \"{p}_{c}_pct\"" for ep, p in (("view", "20_entrate"), ("error", "23_spese")) for c in (*_LONG_SLUGS, "cat_empty")) + """,
    avg(v) FILTER (ep = 'click') AS "*10_click_mean_y", avg(v) FILTER (FALSE) AS "*10_click_mean_y1y2", avg(v) FILTER (FALSE) AS "*10_click_slope_y" FROM (SELECT * REPLACE (CASE WHEN ep = 'click' AND cat = 'cat_empty' THEN NULL ELSE v END AS v) FROM k) GROUP BY entity_id, area""")
def open_pivot_areas(spark, sf_dir):
    """Open pivots as blocks, by area: entities in two areas, one with rows in scope and one without, names that are cut at 50 characters."""
    obs = observations(spark, sf_dir).withColumns(
        {
            "area": F.when(F.col("src_ord") % 2 == 0, "SUD").otherwise("CENTRO"),
            "level": F.when((F.col("src_ord") % 6 == 0) & (F.col("endpoint_key") != "error"), " Scuola").otherwise("altro"),
            "category": F.when(F.col("src_ord") % 13 == 0, " ").when(F.col("endpoint_key") == "click", F.lit("a.s. 1999/2000")).otherwise(F.concat(F.lit(_LONG_NAME), F.substring("category", 2, 1), F.lit(" anno"))),
        }
    )
    opened = [Years("click", "10_", label="click", years=()), Shares("view", "20_"), Shares("error", "23_", name="spese_{}_pct")]
    return build_wide(obs, opened, by=("area",), slopes="none")


#: DuckDB gives the slope of a single point as NaN, here it is null.
_SLOPE_SQL = "nullif(regr_slope(v, y) FILTER ({0}), 'nan'::DOUBLE)"

_OPEN_YEARS_SQL = """o AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, 'user ' || user_id AS entity_name, value AS v, event_id AS ord, 1 + (day(ts) - 1) // 7 AS w, event_type AS ep FROM events),
y AS (SELECT *, CASE WHEN ep <> 'view' OR ord % 11 = 0 THEN NULL WHEN ord % 7 = 0 THEN 2020 + ord % 2 WHEN w = 5 THEN 6 ELSE w END AS y FROM o)"""


@query(f"""WITH {_OPEN_YEARS_SQL} SELECT entity_id, min(entity_name) AS entity_name, {", ".join(f'arg_min(v, ord) FILTER (y = {k}) AS "10_view_y{k}"' for k in (1, 2, 3, 4, 6, 2020, 2021))},
    avg(v) FILTER (y IS NOT NULL) AS "*10_view_mean_y", avg(v) FILTER (y IN (1, 2)) AS "*10_view_mean_y1y2", {_SLOPE_SQL.format("y BETWEEN 1 AND 5")} AS "*10_view_slope_y"
FROM y GROUP BY entity_id""")
def wide_years_open(spark, sf_dir):
    """Years as the data have them: a sixth year and calendar years get columns, labels that name no year count nowhere."""
    label = (
        F.when(F.col("src_ord") % 11 == 0, "totale")
        .when(F.col("src_ord") % 7 == 0, F.concat(F.lit("a.s. "), 2020 + F.col("src_ord") % 2, F.lit("/"), 21 + F.col("src_ord") % 2))
        .when(F.col("category") == "y5", "Anno 6")
        .otherwise(F.concat(F.lit("classe "), F.substring("category", 2, 1)))
    )
    return build_wide(observations(spark, sf_dir).withColumns({"category": label}), YEAR_BLOCKS[:1], slopes="none")


_OUTCOMES, _EXAM, _MIDDLE, _SOURCES = ["Ammessi", "Non ammessi", "Sospesi", "Altro"], ["60", "61-70", "71-80", "81-90", "91-99", "100", "100 e lode"], ["6", "7", "8", "9", "10", "10 e lode"], ["Stato", "Famiglie", "Unione Europea"]
_RELEASE_ENDPOINTS = [b.endpoint for b in RELEASE_BLOCKS]


def _release_sql() -> str:
    pick = lambda names: f"{[n for n in names]}[1 + ord // 12 % {len(names)}]"
    cats = {5: _SOURCES, 6: _OUTCOMES, 7: _OUTCOMES, 10: _EXAM, 11: _MIDDLE}
    cat = " ".join(f"WHEN {k} THEN {pick(c)}" for k, c in cats.items())
    ep = lambda k: f"e = {k}"
    first = lambda k, cond="": f"arg_min(v, ord) FILTER (kept AND {ep(k)}{cond})"
    out = []
    for k, name in ((0, "10_abbandoni"), (1, "11_ripetenti"), (2, "12_trasferimenti")):
        out += [f'arg_min(v, ord) FILTER ({ep(k)} AND y = {y}) AS "{name}_y{y}"' for y in range(1, 6)]
        out += [f'avg(v) FILTER ({ep(k)}) AS "*{name}_mean_y"', f'avg(v) FILTER ({ep(k)} AND y IN (1, 2)) AS "*{name}_mean_y1y2"', f'{_SLOPE_SQL.format(ep(k))} AS "*{name}_slope_y"']
    out += [f'sum(v) FILTER ({ep(k)} AND scope) AS "{n}"' for k, n in ((3, "13_assenze_docenti_sum"), (4, "14_assenze_ata_sum"))]
    out += [f"""{first(5, f" AND cat = '{c}'")} AS "20_entrate_{c.lower().replace(' ', '_')}_pct\"""" for c in _SOURCES]
    for k, name in ((6, "21_esiti_giugno"), (7, "22_esiti_settembre")):
        out += [f"""{first(k, f" AND cat = '{c}'")} AS "{name}_{c.lower().replace(' ', '_')}_pct\"""" for c in _OUTCOMES[:3]]
        out.append(f"""100 - {first(k, " AND cat = 'Ammessi'")} AS "*{name}_tasso_non_ammessi_pct\"""")
    out += [f'{first(k)} AS "{n}"' for k, n in ((8, "30_docenti_pensionati_pct"), (9, "30_docenti_trasferiti_pct"))]
    for k, name, labels, mids, low, top in ((10, "40_esame_voto", _EXAM, EXAM_BINS, EXAM_LOW, EXAM_TOP), (11, "50_medie_voto", _MIDDLE, MIDDLE_BINS, MIDDLE_LOW, MIDDLE_TOP)):
        mid = " ".join(f"WHEN '{c}' THEN {m}" for c, m in zip(labels, mids.values(), strict=True))
        share = lambda bins: f"coalesce(sum(v) FILTER (kept AND {ep(k)} AND cat IN ({', '.join(repr(c) for c, slug in zip(labels, mids, strict=True) if slug in bins)})), 0) / nullif(sum(v) FILTER (kept AND {ep(k)}), 0) * 100"  # noqa: B023, E731
        out += [f'{share(top)} AS "*{name}_share_top_pct"', f'{share(low)} AS "*{name}_share_low_pct"', f'sum(v * CASE cat {mid} END) FILTER (kept AND {ep(k)}) / nullif(sum(v) FILTER (kept AND {ep(k)}), 0) AS "*{name}_share_mean"']
    return f"""WITH o AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, 'user ' || user_id AS entity_name, value AS v, event_id AS ord, event_id % 12 AS e, 1 + (day(ts) - 1) // 7 AS y, event_id % 5 = 0 AND event_id % 12 <> 9 AS scope FROM events),
k AS (SELECT *, CASE e {cat} END AS cat, v IS NOT NULL AND (scope OR e = 9) AS kept FROM o) -- of the endpoints the one numbered 9 alone has no row in scope
SELECT entity_id, min(entity_name) AS entity_name, {", ".join(out)} FROM k GROUP BY entity_id"""


@query(_release_sql())
def release_blocks(spark, sf_dir):
    """All blocks of a release at once, over events dealt to their endpoints."""
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), (1 + F.floor(F.col("src_ord") / 12) % len(names)).cast("int"))
    e = F.col("src_ord") % 12
    cat = F.when(e == 5, pick(_SOURCES)).when(e.isin(6, 7), pick(_OUTCOMES)).when(e == 10, pick(_EXAM)).when(e == 11, pick(_MIDDLE)).otherwise(F.col("category"))
    level = F.when((F.col("src_ord") % 5 == 0) & (e != 9), "scuola").otherwise("")
    obs = observations(spark, sf_dir).withColumns({"endpoint_key": F.element_at(F.array(*map(F.lit, _RELEASE_ENDPOINTS)), (e + 1).cast("int")), "category": cat, "level": level})
    return build_wide(obs, RELEASE_BLOCKS, slopes="none")


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'F') AS esiti_f, arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'O') AS esiti_o,
    arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'P') AS esiti_p, 100 - arg_min(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'F') AS esiti_tasso_non_ammessi_pct FROM orders GROUP BY o_custkey
""")
def outcome_pivot(spark, sf_dir):
    obs = table(spark, sf_dir, "orders").selectExpr(*_ORDER_OBS).withColumn("level", F.lit("")).join(table(spark, sf_dir, "orders").selectExpr("o_orderkey AS src_ord", "o_orderstatus"), "src_ord").withColumn("category", F.col("o_orderstatus"))
    return blocks.aggregate_blocks(obs, [Outcomes("orders", label="esiti", outcomes=("f", "o", "p"), suffix="")])


@query("""
WITH b AS (SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p, count(*) AS n FROM orders GROUP BY ALL)
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, coalesce(sum(n) FILTER (p >= 4), 0) * 100.0 / sum(n) AS voti_share_top_pct, coalesce(sum(n) FILTER (p = 1), 0) * 100.0 / sum(n) AS voti_share_low_pct,
    sum(n * p) / CAST(sum(n) AS DOUBLE) AS voti_share_mean FROM b GROUP BY o_custkey
""")
def bin_features(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).cast("double").alias("value_num"))
    obs = counts.selectExpr("cast(o_custkey AS string) AS entity_id", "'voti' AS endpoint_key", "o_orderpriority AS category", "'' AS level", "value_num", "o_orderpriority AS src_ord")
    mids = {"1_urgent": 1.0, "2_high": 2.0, "3_medium": 3.0, "4_not_specified": 4.0, "5_low": 5.0}
    return blocks.aggregate_blocks(obs, [Bins("voti", label="voti", mids=mids, low=("1_urgent",), top=("4_not_specified", "5_low"))])


@query(f"""WITH {OBS_SQL}, w AS (SELECT entity_id, {_years_sql({"view": "v"}, slope="")} FROM obs GROUP BY entity_id)
SELECT entity_id, list_avg([v_y1, v_y2, v_y3, v_y4, v_y5]) AS mean FROM w""")
def row_mean(spark, sf_dir):
    wide = blocks.aggregate_blocks(observations(spark, sf_dir), [Years("view", label="v")])
    return wide.select("entity_id", blocks.row_mean([F.col(f"v_y{k}") for k in range(1, 6)]).alias("mean"))


@query(f"SELECT c_custkey, 'NATION_' || c_nationkey AS place_key, CASE WHEN c_nationkey % 5 <> 0 THEN 'class ' || n_regionkey ELSE '{enrich.DEFAULT_CLASS}' END AS class FROM customer JOIN nation ON c_nationkey = n_nationkey")
def lookup_default(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('NATION_', c_nationkey) AS place_key")
    return enrich.lookup_with_default(rows, _classes(spark, sf_dir), "place_key", "class", enrich.DEFAULT_CLASS)


def _suppliers(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "concat('Nation_', s_nationkey) AS comune", "concat('P', s_suppkey % 3) AS provincia")


@query("""
SELECT s_suppkey, 'NATION ' || s_nationkey AS place_key, CASE WHEN s_nationkey % 7 <> 0 THEN r_name ELSE '' END AS region, CASE WHEN s_nationkey % 7 <> 0 THEN n_name ELSE '' END AS macroarea
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def lookup_two_stage(spark, sf_dir):
    from ..functions.text import place_key

    rows = enrich.lookup_two_stage(_suppliers(spark, sf_dir), _places(spark, sf_dir), place_key(F.col("comune")), F.upper("provincia"), ["region", "macroarea"], [F.col("src_ord")])
    return rows.select("s_suppkey", "place_key", "region", "macroarea")


@query("SELECT DISTINCT 'Nation_' || s_nationkey AS comune, 'P' || s_suppkey % 3 AS provincia FROM supplier WHERE s_nationkey % 7 = 0")
def lookup_unmatched(spark, sf_dir):
    from ..functions.text import place_key

    rows = _suppliers(spark, sf_dir).withColumn("place_key", place_key(F.col("comune")))
    return enrich.unmatched(rows, _places(spark, sf_dir), "place_key", ["comune", "provincia"])


@query("""
SELECT s_suppkey, coalesce(c, 'none') AS class FROM supplier LEFT JOIN (SELECT n_regionkey AS k, min(CASE WHEN n_nationkey % 4 > 0 THEN 'c' || n_nationkey % 4 END) AS c FROM nation GROUP BY 1) ON k = s_nationkey % 5
""")
def lookup_min_class(spark, sf_dir):
    lookup = table(spark, sf_dir, "nation").selectExpr("concat('Sant’Angelo-', n_regionkey) AS place", "if(n_nationkey % 4 > 0, concat('c', n_nationkey % 4), NULL) AS c", "n_nationkey")
    small = enrich.class_lookup_smallest(lookup, "place", "c", [F.col("n_nationkey")])
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "concat('SANT ANGELO ', s_nationkey % 5) AS place_key")
    return enrich.lookup_with_default(rows, small, "place_key", "class", "none").select("s_suppkey", "class")


@query(f"""WITH {OBS_SQL}, a AS (SELECT entity_id, sum(v)::DECIMAL(18,2)::DOUBLE AS x, count(*) AS only_left FROM obs WHERE endpoint_key = 'view' AND y < 3 GROUP BY 1), b AS (SELECT entity_id, count(*)::DOUBLE AS x, max(ord) AS only_right FROM obs WHERE endpoint_key = 'click' GROUP BY 1)
SELECT entity_id, round(coalesce(a.x, b.x), 2) AS x, only_left, only_right FROM a FULL JOIN b USING (entity_id)""")
def combine_first(spark, sf_dir):
    obs = observations(spark, sf_dir)
    a = obs.where("endpoint_key = 'view' AND category < 'y3'").groupBy("entity_id").agg(F.round(F.sum("value_num"), 2).alias("x"), F.count(F.lit(1)).alias("only_left"))
    b = obs.where("endpoint_key = 'click'").groupBy("entity_id").agg(F.count(F.lit(1)).cast("double").alias("x"), F.max("src_ord").alias("only_right"))
    return combine.combine_first(a, b, ["entity_id"])


@query("SELECT DISTINCT nation, segment, origin FROM (SELECT c_nationkey AS nation, c_mktsegment AS segment, 'c' AS origin FROM customer UNION ALL SELECT s_nationkey, NULL, 's' FROM supplier)")
def union_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation", "c_mktsegment AS segment", "'c' AS origin")
    b = table(spark, sf_dir, "supplier").selectExpr("'s' AS origin", "s_nationkey AS nation")
    return combine.union_all([a, b]).distinct()


@query("SELECT o_orderkey, o_custkey, source FROM (SELECT *, o_orderkey % 3 AS source, min(o_orderkey % 3) OVER (PARTITION BY o_custkey) AS best FROM orders) WHERE source = best")
def source_fallback(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderkey % 3 AS source")
    return combine.first_source(rows, ["o_custkey"], F.col("source"))


@query("SELECT DISTINCT c_custkey AS user_id, event_type FROM customer, (SELECT DISTINCT event_type FROM events) WHERE c_custkey < (SELECT count(*) FROM customer)")
def work_list(spark, sf_dir):
    return combine.work_list(table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id"), table(spark, sf_dir, "events").select("event_type").distinct())


@query("SELECT c_custkey AS user_id, event_type FROM customer, (SELECT DISTINCT event_type FROM events) EXCEPT SELECT user_id, event_type FROM events WHERE value > 10")
def backlog(spark, sf_dir):
    landed = table(spark, sf_dir, "events").where("value > 10")
    return combine.backlog(work_list(spark, sf_dir), landed, ["user_id", "event_type"])


_LOG_SQL = """log AS (SELECT *, CAST([200, 200, 404, 429, 503, NULL][1 + event_id % 6] AS INTEGER) AS status, event_id % 6 < 2 AS ok, event_id % 6 = 1 AS from_cache FROM events)"""


def fetch_log(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr("*", "try_element_at(array(200, 200, 404, 429, 503), cast(1 + event_id % 6 AS int)) AS status", "event_id % 6 < 2 AS ok", "event_id % 6 = 1 AS from_cache", "cast(user_id AS string) AS entity_id")
    return log


@query(f"WITH {_LOG_SQL} SELECT user_id, event_type FROM log GROUP BY ALL HAVING arg_max(event_id % 6, event_id) IN (3, 4, 5)")
def frontier(spark, sf_dir):
    return combine.retry_list(fetch_log(spark, sf_dir), ["user_id", "event_type"], F.col("event_id"))


@query("SELECT event_id FROM events WHERE event_id % 4 IN (1, 2)")
def valid_cache(spark, sf_dir):
    landed = table(spark, sf_dir, "events").selectExpr("event_id", "if(event_id % 4 = 0, '', if(event_id % 4 = 3, concat('{', props), props)) AS body", "event_id % 4 != 2 AS is_json").withColumn("raw_len", F.length("body"))
    return combine.valid_cache(landed).select("event_id")


@query(f"""WITH {_LOG_SQL} SELECT count(*) AS requests, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok AND status IS NOT NULL) AS http_error, count(*) FILTER (NOT ok AND status IS NULL) AS exception,
    count(*) FILTER (status = 429) AS rate_limited, count(*) FILTER (from_cache) AS from_cache, count(DISTINCT user_id) AS entities FROM log""")
def run_stats(spark, sf_dir):
    return stats.run_stats(fetch_log(spark, sf_dir))


@query("SELECT CASE event_id % 6 WHEN 0 THEN 'main' WHEN 1 THEN 'main' WHEN 2 THEN 'fallback' ELSE 'fail' END AS outcome, count(*) AS n FROM events GROUP BY 1")
def outcome_stats(spark, sf_dir):
    return stats.outcome_stats(fetch_log(spark, sf_dir), F.when(F.col("ok"), "main").when(F.col("status") == 404, "fallback").otherwise("fail"))


@query("SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    return dedup.duplicates(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


@query("""
WITH c AS (SELECT epoch(ts)::BIGINT // 86400 * 86400 AS slot, count(*) AS n FROM (SELECT date_trunc('second', ts) AS ts FROM events) GROUP BY 1), d AS (SELECT slot, n, sum(n) OVER (ORDER BY slot)::BIGINT AS done FROM c)
SELECT slot, done, n / 86400.0::DOUBLE AS rate, done * 100.0::DOUBLE / 20000 AS percent, (20000 - done) / (n / 86400.0::DOUBLE) AS eta_s FROM d
""")
def progress_rate(spark, sf_dir):
    return combine.progress(table(spark, sf_dir, "events"), "ts", 20000, 86400)


@query("SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders")
def row_index(spark, sf_dir):
    return dedup.row_index(table(spark, sf_dir, "orders"), [F.col("o_orderdate"), F.col("o_orderkey")])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def ordered_head(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy("o_orderdate", "o_orderkey").limit(25).select("o_orderkey", "o_orderdate")


@query("SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS place FROM orders")
def ordered_sort(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    return rows.withColumn("place", F.substring("o_orderpriority", 1, 1).cast("int")).orderBy("place", "o_orderstatus")


@query("SELECT c_custkey, c_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' AND n_name <> 'NATION_3'")
def territory_filter(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    return joined.where((F.col("r_name") == "EUROPE") & (F.col("n_name") != "NATION_3")).select("c_custkey", "c_name", "r_name")


@query("SELECT r_name AS area, count(*) AS rows, count(DISTINCT s_nationkey) AS keys FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def area_packages(spark, sf_dir):
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    return joined.groupBy(F.col("r_name").alias("area")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("s_nationkey").alias("keys"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')")
def membership_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")).select("o_orderkey", "o_orderpriority")


@query(f"""WITH {OBS_SQL}, a AS (SELECT entity_id, count(*) AS n_view FROM obs WHERE endpoint_key = 'view' AND v > 40 GROUP BY 1), b AS (SELECT entity_id, max(ord) AS last_click FROM obs WHERE endpoint_key = 'click' AND y = 1 GROUP BY 1)
SELECT entity_id, n_view, last_click FROM a FULL JOIN b USING (entity_id)""")
def outer_block_join(spark, sf_dir):
    obs = observations(spark, sf_dir)
    a = obs.where("endpoint_key = 'view' AND value_num > 40").groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_view"))
    b = obs.where("endpoint_key = 'click' AND category = 'y1'").groupBy("entity_id").agg(F.max("src_ord").alias("last_click"))
    return a.join(b, "entity_id", "full_outer")


@query("SELECT c_custkey AS \"10_key\", upper(c_name) AS name, c_acctbal AS \"*2_v_mean_y\", c_mktsegment AS \"2_segment_ana\" FROM customer")
def resolve_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS `10_key`", "c_name AS NomE", "c_acctbal AS `2_v_mean_y`", "c_mktsegment AS `2_segment`")
    name = columns.pick_column(rows, ["NAME", "nome"], required=True)
    right = columns.rename_collisions(rows, ["2_segment"], ["10_key"], "_ana").withColumn("name", F.upper(F.col(name))).drop(name)
    return columns.order_columns(columns.star_computed(right), ["10_key"])


@query("SELECT c_custkey, c_mktsegment AS provincia, c_name AS region, c_nationkey AS cap, round(c_acctbal, 2) AS last FROM customer")
def collision_rename(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_mktsegment AS provincia", "c_nationkey AS cap", "round(c_acctbal, 2) AS last", "'x' AS ESITO", "c_name AS region")
    return columns.place_after(columns.drop_named(rows, "esito"), ["provincia", "cap"], ["region"])


@query("SELECT doc_id, CASE WHEN quality = 1 THEN '1' WHEN toxic = 1 THEN '0' ELSE '' END AS good, CASE WHEN quality = 1 THEN '0' WHEN toxic = 1 THEN '1' ELSE '' END AS bad FROM labels")
def one_hot_flag(spark, sf_dir):
    flags = stats.first_flag([F.col("quality") == 1, F.col("toxic") == 1], ["good", "bad"])
    return table(spark, sf_dir, "labels").select("doc_id", flags.alias("f")).select("doc_id", "f.*")
