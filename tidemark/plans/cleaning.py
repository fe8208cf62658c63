"""The queries of the clean-up from duplicated records to survivors, each with the SQL that states its result."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import presence, text
from ..operators import audit, clusters, consolidate, lookup, merged, nearest, polygons, profile, survivors
from ..sources import ranges, typed
from ..sources.tables import align, keep_first, shared_path, table, with_row_numbers, year_columns
from .catalogue import CLUSTER_AT, NAMES_SQL, YEARS, labels_sql, named_parts, norm_sql, orders, query, year_flags

# ---- from duplicated rows to one table

#: Parts under keys of one row or several, with some names missing.
KEYED_SQL = f"(SELECT p_size * 10 + p_partkey % 7 AS k, p_partkey, CASE WHEN p_partkey % 59 = 0 THEN NULL WHEN p_partkey % 53 = 0 THEN 'None Given' ELSE p_name END AS name, p_retailprice AS x, p_size FROM {NAMES_SQL})"
GIVEN_SQL = f"(SELECT * REPLACE (coalesce(name, 'None Given') AS name) FROM {KEYED_SQL})"
DOUBLE_SQL = f"(SELECT * FROM {GIVEN_SQL} WHERE k IN (SELECT k FROM {KEYED_SQL} GROUP BY 1 HAVING count(*) > 1))"
_FLAGS = ", ".join(f"count(*) FILTER (p_partkey % 3 = {i}) AS s{i}" for i in range(3))
_NEAR = "CASE WHEN count(*) = 1 THEN true ELSE max(x) - min(x) < 700 END"
STEP_ONE_SQL = f"""WITH l AS ({labels_sql(DOUBLE_SQL, 'k', 'name', CLUSTER_AT)}), j AS (SELECT d.*, l.cluster FROM {DOUBLE_SQL} d JOIN l ON l.k = d.k AND l.name = d.name),
 c AS (SELECT k, cluster, count(*) AS n_rows, {_FLAGS}, round(avg(x), 4) AS mean_x, {_NEAR} AS near FROM j GROUP BY 1, 2),
 again AS (SELECT j.k, name AS cluster, count(*) AS n_rows, {_FLAGS}, round(avg(x), 4) AS mean_x, 'Expanded' AS status FROM j JOIN c ON c.k = j.k AND c.cluster = j.cluster WHERE NOT near GROUP BY 1, 2),
 every AS (SELECT k, cluster, n_rows, s0, s1, s2, mean_x, CASE WHEN near THEN 'TRUE' END AS status FROM c WHERE near UNION ALL SELECT * FROM again
 UNION ALL SELECT k, name, 1, (p_partkey % 3 = 0)::INT, (p_partkey % 3 = 1)::INT, (p_partkey % 3 = 2)::INT, round(x, 4), NULL FROM {GIVEN_SQL} WHERE k NOT IN (SELECT k FROM {DOUBLE_SQL}))
 SELECT * FROM every WHERE k NOT IN (SELECT k FROM every WHERE cluster = 'None Given')"""


def keyed(spark, sf) -> DataFrame:
    p = F.col("p_partkey")
    name = F.when(p % 59 != 0, F.when(p % 53 == 0, "None Given").otherwise(F.col("p_name")))
    return named_parts(spark, sf).select((F.col("p_size") * 10 + p % 7).alias("k"), "p_partkey", name.alias("name"), F.col("p_retailprice").alias("x"))


def thirds() -> dict[str, Column]:
    return {f"s{i}": F.when(F.col("p_partkey") % 3 == i, 1) for i in range(3)}


def step_one(spark, sf) -> DataFrame:
    done = consolidate.consolidated(keyed(spark, sf), "k", "name", "x", thirds(), CLUSTER_AT, 700.0)
    return consolidate.without_missing(done.withColumn("mean_x", F.round("mean_x", 4)), "k", "cluster")


@query(STEP_ONE_SQL)
def step_one_consolidation(spark, sf):
    return step_one(spark, sf)


@query(f"""SELECT (SELECT count(*) FROM {KEYED_SQL}) AS rows_before, (SELECT count(DISTINCT k) FROM {KEYED_SQL}) AS keys_before, count(*) AS rows_after, count(DISTINCT k) AS keys_after, 0::BIGINT AS new_keys, 0::BIGINT AS missing_left,
 round(100 * (1 - count(*)::DOUBLE / (SELECT count(*) FROM {KEYED_SQL})), 2) AS reduction FROM ({STEP_ONE_SQL})""")
def step_one_reductions(spark, sf):
    return consolidate.reductions(keyed(spark, sf), step_one(spark, sf), "k", "cluster")


#: Parts as raw records: several to a key, places of five kinds, some without an address or coordinates.
_RAW = f"""(SELECT k, p_partkey, name, coalesce(name, 'None Given') || ', CITY ' || k % 3 || ', S' || k % 2 || ', 0' || 1000 + k % 7 AS compiled, coalesce(name, 'None Given') AS line, CASE WHEN p_partkey % 43 <> 0 THEN x / 1000 END AS lon, (p_partkey % 4) * 0.2 AS lat,
 lpad((p_partkey % 3)::VARCHAR, 2, '0') AS rest, CASE WHEN p_partkey % 5 > 1 THEN 1990 + p_partkey % 4 END AS year, {', '.join(f'(p_partkey % 3 = {i})::INT AS s{i}' for i in range(3))} FROM {KEYED_SQL})"""
_TWICE = f"(SELECT * FROM {_RAW} WHERE k IN (SELECT k FROM {_RAW} GROUP BY 1 HAVING count(*) > 1))"
_TESTED = "CASE WHEN count(lon) = count(*) THEN max(lon) - min(lon) < 0.7 AND max(lat) - min(lat) < 0.7 WHEN max(lat) - min(lat) >= 0.7 THEN false END"
_MERGE = "count(*) AS n_rows, CASE WHEN count(lon) = count(*) THEN avg(lon) END AS longitude, avg(lat) AS latitude, sum(s0) AS s0, sum(s1) AS s1, sum(s2) AS s2, arg_min(line, compiled) AS address_line_1"
MERGED_SQL = f"""WITH raw AS MATERIALIZED (SELECT * FROM {_RAW}), l AS MATERIALIZED ({labels_sql(_TWICE, 'k', 'compiled', CLUSTER_AT)}), d AS (SELECT raw.*, l.cluster FROM raw JOIN l ON l.k = raw.k AND l.compiled = raw.compiled),
 c AS (SELECT k, cluster, {_TESTED} AS test, {_MERGE} FROM d GROUP BY 1, 2), n AS (SELECT k, count(*) = count(DISTINCT cluster) AS same FROM l WHERE k IN (SELECT k FROM c WHERE NOT test) GROUP BY 1),
 t AS (SELECT c.*, n.same FROM c LEFT JOIN n ON n.k = c.k), gone AS (SELECT k, cluster FROM t WHERE NOT test AND NOT same),
 every AS (SELECT k, cluster AS compiled_address, test AS lonlat_test, same AS same_num_clusters, CASE WHEN NOT test THEN 'Overridden' WHEN test THEN 'TRUE' END AS status, * EXCLUDE (k, cluster, test, same) FROM t WHERE (k, cluster) NOT IN (SELECT (k, cluster) FROM gone)
 UNION ALL SELECT d.k, d.compiled, CASE WHEN count(*) > 1 THEN {_TESTED} END, false, 'Expanded', {_MERGE} FROM d JOIN gone ON gone.k = d.k AND gone.cluster = d.cluster GROUP BY 1, 2
 UNION ALL SELECT k, compiled, NULL, NULL, NULL, 1, lon, lat, s0, s1, s2, line FROM raw WHERE k NOT IN (SELECT k FROM d)),
 seed AS (SELECT k, coalesce(string_agg(DISTINCT year::VARCHAR, ', ' ORDER BY year::VARCHAR), 'None listed') AS year_established FROM raw GROUP BY 1), codes AS (SELECT k, string_agg(rest, ', ' ORDER BY nth) AS extra_code FROM (SELECT k, rest, min(p_partkey) AS nth FROM raw GROUP BY 1, 2) GROUP BY 1)
 SELECT k, address_line_1, 'CITY ' || k % 3 AS city, 'S' || k % 2 AS state, '0' || 1000 + k % 7 AS zipcode, compiled_address, lonlat_test, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, year_established, '813110' AS code, extra_code, s0, s1, s2, n_rows, same_num_clusters, status
 FROM every JOIN seed USING (k) JOIN codes USING (k) WHERE k NOT IN (SELECT k FROM raw WHERE line = 'None Given')"""


def merged_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    p, k = F.col("p_partkey"), F.col("k")
    named = lambda text, number: F.concat(F.lit(text), number.cast("string"))
    raw = keyed(spark, sf).select(k, p, "name", named("CITY ", k % 3).alias("city"), named("S", k % 2).alias("state"), named("0", 1000 + k % 7).alias("zip"), F.when(p % 43 != 0, F.col("x") / 1000).alias("lon"), ((p % 4) * 0.2).alias("lat"),
                                  F.concat(F.lit("813110"), F.lpad((p % 3).cast("string"), 2, "0")).alias("code"), F.when(p % 5 > 1, 1990 + p % 4).alias("year"))
    at = merged.Columns(key="k", line="name", city="city", state="state", zip="zip", longitude="lon", latitude="lat", code="code", established="year", order="p_partkey", prefix="813110")
    return merged.merged(raw, at, thirds(), CLUSTER_AT, 0.7)


@query(MERGED_SQL)
def merged_table(spark, sf):
    return merged_parts(spark, sf)[0].withColumns({"latitude": F.round("latitude", 9), "longitude": F.round("longitude", 9)})


@query(f"""WITH m AS MATERIALIZED ({MERGED_SQL}), raw AS MATERIALIZED (SELECT * FROM {_RAW}), bare AS (SELECT DISTINCT k FROM raw WHERE line = 'None Given'), twice AS (SELECT k FROM raw GROUP BY 1 HAVING count(*) > 1)
 SELECT (SELECT count(*) FROM twice JOIN bare USING (k)) + (SELECT count(DISTINCT k) FROM m WHERE k IN (SELECT k FROM twice)) = (SELECT count(*) FROM twice) AS a, (SELECT count(*) FROM m WHERE (status IS NULL AND n_rows = 1 AND lonlat_test IS NULL AND k NOT IN (SELECT k FROM twice)) AND k IN (SELECT k FROM twice)) = 0 AS b,
 (SELECT count(*) FROM (SELECT k FROM raw EXCEPT SELECT k FROM m EXCEPT SELECT k FROM bare)) = 0 AS c, (SELECT count(*) FROM (SELECT k FROM m EXCEPT (SELECT k FROM raw EXCEPT SELECT k FROM bare))) = 0 AS d, (SELECT count(*) FROM ((SELECT k FROM raw EXCEPT SELECT k FROM m) EXCEPT SELECT k FROM bare)) = 0 AS e,
 (SELECT count(*) FROM raw) AS rows_before, (SELECT count(*) FROM m) AS rows_after, (SELECT count(DISTINCT k) FROM raw) AS keys_before, round(100 * (1 - (SELECT count(*) FROM m)::DOUBLE / (SELECT count(*) FROM raw)), 2) AS reduction""")
def merged_invariants(spark, sf):
    return merged_parts(spark, sf)[1]


_YEARS = ", ".join(f"CASE WHEN year(o_orderdate) = {y} AND o_orderkey % 11 <> 0 THEN 1 END AS y{y}" for y in YEARS)
_FIRST = "CASE " + " ".join(f"WHEN y{y} = 1 THEN 'y{y}'" for y in YEARS) + " END"
_ZERO = ", ".join(f"coalesce(y{y}, 0) AS y{y}" for y in YEARS)
_PAD = r"CASE WHEN length(z) = 1 THEN '00000' ELSE regexp_replace(regexp_replace(z, '\b(\d{4})\b', '0\1', 'g'), '\b(\d{3})\b', '0\10', 'g') END"


def yearly(spark, sf) -> DataFrame:
    return orders(spark, sf).select("o_custkey", "o_orderkey", F.col("o_orderkey").cast("string").alias("zip"), *[F.when(F.col("o_orderkey") % 11 != 0, f).alias(k) for k, f in year_flags().items()])


@query(f"SELECT o_custkey, o_orderkey, {_PAD} AS zip, {_ZERO}, row_number() OVER (PARTITION BY o_custkey ORDER BY {_FIRST} NULLS LAST, o_orderkey) AS nth FROM (SELECT o_custkey, o_orderkey, o_orderkey::VARCHAR AS z, {_YEARS} FROM orders)")
def first_year_order(spark, sf):
    return consolidate.finished(yearly(spark, sf), "o_custkey", "zip", [f"y{y}" for y in YEARS], ["o_orderkey"]).withColumns({"nth": F.col("nth").cast("long")} | {f"y{y}": F.col(f"y{y}").cast("int") for y in YEARS})


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS rowname FROM orders QUALIFY rowname BETWEEN 100 AND 4100")
def row_range(spark, sf):
    return with_row_numbers(table(spark, sf, "orders"), ["o_custkey", "o_orderdate", "o_orderkey"]).filter("rowname between 100 and 4100").select("o_orderkey", "rowname")


@query("SELECT o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_custkey", "o_totalprice")


# ---- survivors

#: Places (city, state_id, zip): five to a state and ZIP.
PLACES_SQL = "(SELECT upper(n_name) AS city, 'S' || n_nationkey % 5 AS state_id, lpad((n_nationkey % 5)::VARCHAR, 5, '0') AS zip FROM nation)"
_COMPETE = """(SELECT o_custkey AS k, o_orderkey AS r, year(o_orderdate) AS y, CASE WHEN o_custkey % 37 <> 5 OR o_orderkey % 4 <> 1 THEN round(o_totalprice / 50000, 1) END AS gx, (o_orderkey % 7) * 0.4 AS gy,
 CASE WHEN o_orderstatus = 'P' OR o_orderkey % 6 = 0 THEN 'No address match found' ELSE 'ok' END AS answer, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE substr(o_orderpriority, 3) END || repeat('x', (o_orderkey % 9)::INT) AS line,
 CASE WHEN o_orderkey % 5 = 0 THEN 'apt' END AS extra, CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'NATION_' || o_orderkey % 25 WHEN o_orderkey % 4 = 0 THEN 'NATIN_' || o_orderkey % 30 ELSE 'ELSEWHERE' END AS city, 'S' || o_custkey % 5 AS state, lpad((o_custkey % 5)::VARCHAR, 5, '0') AS zip,
 CASE WHEN o_orderkey % 8 = 3 THEN 'PO BOX ' ELSE '' END || o_orderkey AS address FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001)"""
_WINS = "ORDER BY known DESC, CASE WHEN NOT known THEN far END NULLS LAST, r"
SURVIVOR_SQL = f"""WITH RECURSIVE a AS (SELECT *, count(*) OVER (PARTITION BY k, y) > 1 AS dup FROM {_COMPETE}), d AS (SELECT * FROM a WHERE dup), bad AS (SELECT k, min(r) AS c FROM d WHERE k IN (SELECT k FROM d WHERE gx IS NULL) GROUP BY 1),
 e AS (SELECT m.k, m.r AS a, o.r AS b FROM d m JOIN d o ON m.k = o.k AND m.r <> o.r AND sqrt((m.gx - o.gx) * (m.gx - o.gx) + (m.gy - o.gy) * (m.gy - o.gy)) <= 0.75 WHERE m.k NOT IN (SELECT k FROM bad)),
 c(k, r, c) AS (SELECT DISTINCT k, a, a FROM e UNION SELECT c.k, e.b, c.c FROM c JOIN e ON e.k = c.k AND e.a = c.r), lab AS (SELECT k, r, min(c) AS c FROM c GROUP BY 1, 2),
 asked AS (SELECT DISTINCT city, state, zip FROM d), near AS (SELECT asked.*, p.city AS place, round(1 - jaro_similarity({norm_sql('asked.city')}, {norm_sql('p.city')}), 9) AS far FROM asked JOIN {PLACES_SQL} p ON p.state_id = asked.state AND p.zip = asked.zip),
 places AS (SELECT city, state, zip, min(far) AS far, arg_min(place, (far, place)) AS place FROM near WHERE far < {CLUSTER_AT} GROUP BY 1, 2, 3),
 g AS (SELECT d.*, coalesce(bad.c, lab.c) AS cluster, bad.k IS NULL AND lab.c IS NULL AS is_noise, bad.k IS NOT NULL AS problem, d.city IS NOT NULL AND d.city IN (SELECT city FROM {PLACES_SQL}) AS known, places.place, places.far
 FROM d LEFT JOIN bad ON bad.k = d.k LEFT JOIN lab ON lab.k = d.k AND lab.r = d.r LEFT JOIN places ON places.city = d.city AND places.state = d.state AND places.zip = d.zip),
 s1 AS (SELECT *, bool_and(answer = 'No address match found') OVER w AS review FROM g WINDOW w AS (PARTITION BY k, cluster)),
 s2 AS (SELECT * FROM s1 WHERE review OR answer = 'ok'), s3 AS (SELECT *, bool_or(extra IS NOT NULL) OVER (PARTITION BY k, cluster) AS has_extra FROM s2),
 s4 AS (SELECT *, length(line) AS len, regexp_matches(line, '[0-9]') AS digit FROM s3 WHERE extra IS NOT NULL OR NOT has_extra),
 s5 AS (SELECT *, len = max(len) OVER (PARTITION BY k, cluster) AS top, CASE WHEN len - lag(len) OVER (PARTITION BY k, cluster ORDER BY len, r) <= 2 THEN 0 ELSE 1 END AS new FROM s4),
 s6 AS (SELECT *, sum(new) OVER (PARTITION BY k, cluster ORDER BY len, r ROWS UNBOUNDED PRECEDING) AS run FROM s5),
 s7 AS (SELECT *, bool_or(top AND digit) OVER w AS best, max(CASE WHEN top THEN run END) OVER w AS top_run FROM s6 WINDOW w AS (PARTITION BY k, cluster)),
 s8 AS (SELECT *, bool_or(digit AND run = top_run) OVER (PARTITION BY k, cluster) AS near FROM s7), s9 AS (SELECT * FROM s8 WHERE CASE WHEN best THEN top AND digit WHEN near THEN digit ELSE top END),
 s10 AS (SELECT *, row_number() OVER (PARTITION BY k, cluster {_WINS}) AS nth, count(*) OVER (PARTITION BY k, cluster) AS n FROM s9),
 won AS (SELECT *, n > 1 AND NOT known AND place IS NOT NULL AS by_city FROM s10 WHERE nth = 1),
 offer AS (SELECT k, r, gx, gy FROM won WHERE NOT review AND NOT contains(address, 'PO BOX') UNION ALL SELECT k, r, gx, gy FROM a WHERE NOT dup AND answer = 'ok' AND NOT contains(address, 'PO BOX')),
 lent AS (SELECT w.k, w.r, arg_min(o.r, (sqrt((w.gx - o.gx) * (w.gx - o.gx) + (w.gy - o.gy) * (w.gy - o.gy)), o.r)) AS lender FROM won w JOIN offer o ON o.k = w.k AND w.review AND sqrt((w.gx - o.gx) * (w.gx - o.gx) + (w.gy - o.gy) * (w.gy - o.gy)) <= 0.75 GROUP BY 1, 2),
 j AS (SELECT a.k, a.r, a.y, g.cluster, g.is_noise, CASE WHEN a.dup AND (won.r IS NULL OR lent.r IS NOT NULL) THEN 'Drop' ELSE 'Keep' END AS decision, coalesce(won.by_city, false) AS by_city, CASE WHEN won.by_city THEN won.place ELSE a.city END AS city, coalesce(s1.review, false) AS needs_review, coalesce(g.problem, false) AS problem_geo, lender
 FROM a LEFT JOIN g ON g.k = a.k AND g.r = a.r LEFT JOIN s1 ON s1.k = a.k AND s1.r = a.r LEFT JOIN won ON won.k = a.k AND won.r = a.r LEFT JOIN lent ON lent.k = a.k AND lent.r = a.r)"""


def judged(spark, sf) -> DataFrame:
    k, c, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    named = lambda text, number: F.concat(F.lit(text), number)
    rows = orders(spark, sf).filter(F.col("y").between(YEARS[0], YEARS[-1]))
    rows = rows.select(
        c.alias("k"), k.alias("r"), "y", *[F.coalesce(f, F.lit(0)).alias(n) for n, f in year_flags().items()],
        F.when((c % 37 != 5) | (k % 4 != 1), F.round(price / 50000, 1)).alias("gx"), ((k % 7) * F.lit(Decimal("0.4"))).cast("decimal(3, 1)").alias("gy"),
        F.when((F.col("o_orderstatus") == "P") | (k % 6 == 0), survivors.NO_MATCH).otherwise("ok").alias("answer"),
        F.concat(F.when(k % 2 == 0, F.col("o_orderpriority")).otherwise(F.substring("o_orderpriority", 3, 99)), F.repeat(F.lit("x"), (k % 9).cast("int"))).alias("line"),
        F.when(k % 5 == 0, "apt").alias("extra"),
        F.when(k % 17 == 0, None).when(k % 3 == 0, named("NATION_", k % 25)).when(k % 4 == 0, named("NATIN_", k % 30)).otherwise("ELSEWHERE").alias("city"),
        named("S", c % 5).alias("state"), F.lpad((c % 5).cast("string"), 5, "0").alias("zip"), F.concat(F.when(k % 8 == 3, "PO BOX ").otherwise(""), k).alias("address"))
    n = F.col("n_nationkey") % 5
    gazetteer = table(spark, sf, "nation").select(F.upper("n_name").alias("city"), named("S", n).alias("state_id"), F.lpad(n.cast("string"), 5, "0").alias("zip"))
    flags = {n: F.col(n) for n in year_flags()}
    how = {"line": F.col("line"), "extra": F.col("extra"), "city": "city", "state": "state", "zip_": "zip", "gazetteer": gazetteer, "threshold": CLUSTER_AT}
    return survivors.select_survivors(rows, "k", "r", flags, F.col("gx"), F.col("gy"), 0.75, F.col("answer"), F.col("address"), **how)


@query(f"{SURVIVOR_SQL} SELECT k, r, cluster, is_noise, decision, by_city, city, needs_review, problem_geo, lender FROM j")
def survivor_ladder(spark, sf):
    return judged(spark, sf).select("k", "r", "cluster", "is_noise", "decision", "by_city", "city", "needs_review", "problem_geo", "lender")


_PACKED = ", ".join(f"CASE WHEN decision = 'Keep' THEN least(greatest((y = {y})::INT, CASE WHEN is_noise IS NOT NULL THEN count(*) FILTER (y = {y}) OVER (PARTITION BY k, cluster, is_noise) ELSE 0 END, coalesce(l{y}, 0)), 1) ELSE (y = {y})::INT END AS y{y}" for y in YEARS)
_LENT = ", ".join(f"max(n{y}) AS l{y}" for y in YEARS)
_SUMS = ", ".join(f"count(*) FILTER (y = {y}) OVER (PARTITION BY k, cluster, is_noise) AS n{y}" for y in YEARS)
_PACKED_SQL = f"(SELECT k, r, cluster, is_noise, decision, problem_geo, lender, {_PACKED} FROM j LEFT JOIN (SELECT k AS lk, lender AS lr, {_LENT} FROM (SELECT k, lender, is_noise, {_SUMS} FROM j) WHERE lender IS NOT NULL GROUP BY 1, 2) ON lk = k AND lr = r)"


def packed(spark, sf) -> DataFrame:
    names = list(year_flags())
    return survivors.compressed(judged(spark, sf), "k", "r", dict(zip(names, names, strict=True)))


@query(f"{SURVIVOR_SQL} SELECT k, r, decision, {', '.join(f'y{y}' for y in YEARS)} FROM {_PACKED_SQL} WHERE decision = 'Keep'")
def compressed_survivors(spark, sf):
    return packed(spark, sf).filter("decision = 'Keep'").select("k", "r", "decision", *[F.col(n).cast("long").alias(n) for n in year_flags()])


_CHECKS = ", ".join(f"coalesce(sum(y{y}) FILTER (decision = 'Drop'), 0) AS d{y}, coalesce(sum(y{y}) FILTER (decision = 'Keep'), 0) AS k{y}" for y in YEARS)
_PLAIN = ", ".join(f"p.y{y}" for y in YEARS)


@query(f"""{SURVIVOR_SQL}, packed AS MATERIALIZED (SELECT * FROM {_PACKED_SQL}), summed AS (SELECT k, cluster, is_noise, decision, problem_geo, {', '.join(f'y{y}' for y in YEARS)} FROM packed WHERE is_noise IS NOT NULL
 UNION ALL SELECT q.k, q.cluster, q.is_noise, 'Keep', q.problem_geo, {_PLAIN} FROM packed q JOIN packed p ON p.k = q.k AND p.r = q.lender AND p.decision = 'Keep')
 SELECT k, cluster, is_noise, {' AND '.join(f'd{y} <= 1' for y in YEARS)} AS dropped_all_1, {' AND '.join(f'k{y} <= 1' for y in YEARS)} AS kept_all_1, {' AND '.join(f'd{y} + k{y} <> 1' for y in YEARS)} AS consistent, geo_na, one_kept
 FROM (SELECT k, cluster, is_noise, {_CHECKS}, bool_or(problem_geo) AS geo_na, count(*) FILTER (decision = 'Keep') = 1 AS one_kept FROM summed GROUP BY 1, 2, 3)""")
def survivor_quality(spark, sf):
    return survivors.survivor_checks(packed(spark, sf), "k", "r", list(year_flags()))


#: Offers and asking rows by customers modulo three: three large groups with many rows at one place.
_POINTS = "(SELECT o_orderkey AS r, o_custkey % 3 AS g, CASE WHEN o_orderkey % 3 = 1 THEN 2.5 ELSE round(o_totalprice / 1000, 0) END AS x, CASE WHEN o_orderkey % 3 = 1 THEN 2.5 ELSE (o_custkey % 500)::DOUBLE END AS y, o_orderkey % 5 = 0 AS asks FROM orders)"


@query(f"""SELECT a.g, a.r, arg_min(o.r, (sqrt((a.x - o.x) * (a.x - o.x) + (a.y - o.y) * (a.y - o.y)), o.r)) AS offer, round(min(sqrt((a.x - o.x) * (a.x - o.x) + (a.y - o.y) * (a.y - o.y))), 6) AS distance
 FROM (SELECT * FROM {_POINTS} WHERE asks) a JOIN (SELECT g, x, y, min(r) AS r FROM {_POINTS} WHERE NOT asks GROUP BY 1, 2, 3) o ON o.g = a.g GROUP BY 1, 2""")
def nearest_physical(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(k.alias("r"), (c % 3).alias("g"), F.when(k % 3 == 1, 2.5).otherwise(F.round(F.col("o_totalprice") / 1000, 0)).alias("x"), F.when(k % 3 == 1, 2.5).otherwise((c % 500).cast("double")).alias("y"))
    found = nearest.nearest_offers(rows.filter("r % 5 = 0"), rows.filter("r % 5 <> 0"), "g", "r", F.col("x"), F.col("y"))
    return found.withColumn("distance", F.round("distance", 6))


# ---- addresses and lookups

ADDRESS_SQL = """(SELECT c_custkey AS r, CASE WHEN c_custkey % 7 = 0 THEN 'Suite ' || c_custkey WHEN c_custkey % 5 = 1 THEN lower(c_name) ELSE c_name END AS line_1, CASE WHEN c_custkey % 7 = 0 THEN c_name END AS line_2,
 CASE WHEN c_custkey % 3 = 0 THEN 'WRONG' ELSE 'CITY ' || (c_custkey % 50) END AS city, 'S' || (c_custkey % 5) AS state, CASE WHEN c_custkey % 4 = 0 THEN rpad(ltrim((c_custkey % 500)::VARCHAR, '0'), 5, '0') ELSE lpad((c_custkey % 500)::VARCHAR, 5, '0') END || CASE WHEN c_custkey % 9 = 0 THEN '-1234' ELSE '' END AS zip,
 c_name, lpad((c_custkey % 500)::VARCHAR, 5, '0') AS true_zip FROM customer)"""


def addresses(spark, sf) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    code = (k % 500).cast("string")
    return table(spark, sf, "customer").select(
        k.alias("r"), F.when(k % 7 == 0, F.concat(F.lit("Suite "), k)).when(k % 5 == 1, F.lower(name)).otherwise(name).alias("line_1"), F.when(k % 7 == 0, name).alias("line_2"),
        F.when(k % 3 == 0, "WRONG").otherwise(F.concat(F.lit("CITY "), k % 50)).alias("city"), F.concat(F.lit("S"), k % 5).alias("state"),
        F.concat(F.when(k % 4 == 0, F.rpad(F.ltrim(code, F.lit("0")), 5, "0")).otherwise(F.lpad(code, 5, "0")), F.when(k % 9 == 0, "-1234").otherwise("")).alias("zip"), name.alias("c_name"), F.lpad(code, 5, "0").alias("true_zip"))


_CANDIDATES = """CASE WHEN trim(z, '0') = '' THEN [z] ELSE list_concat([z], list_filter(list_transform(range((length(z) - length(trim(z, '0')))::INT, -1, -1), lambda i: repeat('0', i) || trim(z, '0') || repeat('0', (length(z) - length(trim(z, '0')))::INT - i)), lambda x: x <> z)) END"""


@query(f"""WITH a AS (SELECT *, regexp_extract(zip, '^[0-9]+') AS z FROM {ADDRESS_SQL}), ref AS (SELECT {norm_sql('c_name')} AS l, {norm_sql("'CITY ' || (r % 50)")} AS c, state AS s, true_zip AS z, 'found ' || r AS answer FROM {ADDRESS_SQL} WHERE r % 11 <> 0),
 codes AS (SELECT DISTINCT true_zip AS code, 'CITY ' || (r % 50) AS city, state AS s FROM {ADDRESS_SQL}), tried AS (SELECT r, unnest({_CANDIDATES}) AS code, generate_subscripts({_CANDIDATES}, 1) AS place, line_1, state FROM a),
 asked AS (SELECT r, 1 AS attempt, 0::BIGINT AS place, line_1 AS l, city AS c, state AS s, z FROM a UNION ALL SELECT r, 2, place, line_1, codes.city, s, tried.code FROM tried JOIN codes ON codes.code = tried.code AND codes.s = tried.state UNION ALL SELECT r, 3, 0, line_2, city, state, z FROM a WHERE line_2 <> ''),
 hits AS (SELECT r, attempt, place, answer FROM asked JOIN ref ON {norm_sql('asked.l')} = ref.l AND {norm_sql('asked.c')} = ref.c AND asked.s = ref.s AND asked.z = ref.z)
 SELECT a.r, min(attempt)::INT AS attempt, coalesce(arg_min(answer, attempt * 1000 + place), 'No address match found') AS answer FROM a LEFT JOIN hits ON hits.r = a.r GROUP BY 1""")
def address_validation(spark, sf):
    rows = addresses(spark, sf)
    known = rows.filter("r % 11 <> 0").select(F.col("c_name").alias("line_1"), F.concat(F.lit("CITY "), F.col("r") % 50).alias("city"), "state", F.col("true_zip").alias("zip"), F.concat(F.lit("found "), "r").alias("answer"))
    codes = rows.select(F.col("true_zip").alias("zip"), F.concat(F.lit("CITY "), F.col("r") % 50).alias("city"), F.col("state").alias("state_id")).distinct()
    return lookup.validated(rows, "r", codes, lookup.address_validator(known, "answer"), survivors.NO_MATCH)


@query(f"""SELECT r, full_text, line_1, line_2, city, state, zip, zip4, zip4 <> '' AND regexp_matches(zip4, '^[0-9]{{4}}$') AS is_zip4 FROM (SELECT r, full_text, upper(regexp_extract(full_text, p, 1)) AS line_1, nullif(upper(regexp_replace(regexp_extract(full_text, p, 2), ',\\s*$', '')), '') AS line_2, nullif(regexp_extract(full_text, p, 3), '') AS city,
 nullif(regexp_extract(full_text, p, 4), '') AS state, nullif(regexp_extract(full_text, p, 5), '') AS zip, regexp_extract(regexp_extract(full_text, p, 5), '-([0-9]+)', 1) AS zip4
 FROM (SELECT r, '^(.*?),\\s*(.*?,\\s*)?(.*),\\s*([A-Z]{{2}})\\s*(\\d{{5}}(?:-\\d{{4}})?)$' AS p, line_1 || CASE WHEN line_2 IS NULL THEN '' ELSE ', ' || line_2 END || ', ' || city || ', MA ' || true_zip || CASE WHEN r % 9 = 0 THEN '-1234' ELSE '' END AS full_text FROM {ADDRESS_SQL}))""")
def address_text(spark, sf):
    rows = addresses(spark, sf).withColumn("ext", F.when(F.col("r") % 9 == 0, "1234").otherwise(""))
    full = rows.select("r", text.compiled_address(F.col("line_1"), F.col("line_2"), F.col("city"), F.lit("MA"), F.col("true_zip"), F.col("ext")).alias("full_text"))
    p = full.withColumn("p", text.parse_address(F.col("full_text")))
    four = text.zip4(F.col("p.zip"))
    return p.select("r", "full_text", F.upper("p.line_1").alias("line_1"), F.nullif(F.upper("p.line_2"), F.lit("")).alias("line_2"), "p.city", "p.state", "p.zip", four.alias("zip4"), text.is_zip4(four).alias("is_zip4"))


@query(f"""SELECT r, CASE WHEN n = 4 THEN p[1] || '|' || p[2] || '|' || p[3] || '|' || p[4] END AS parts, CASE WHEN n = 4 THEN p[1] || ', ' || p[2] || '|' || p[3] || '|S1|' || z WHEN n = 3 THEN p[1] || '|' || p[2] || '|S1|' || z END AS coded FROM (SELECT r, string_split(t, ', ') AS p, len(string_split(t, ', ')) AS n, z FROM
 (SELECT r, true_zip AS z, CASE WHEN r % 4 = 3 THEN line_1 ELSE line_1 || CASE WHEN line_2 IS NULL THEN '' ELSE ', ' || line_2 END || ', ' || city || ', S1 ' || true_zip END AS t FROM {ADDRESS_SQL}))""")
def address_split(spark, sf):
    rows = addresses(spark, sf)
    whole = F.concat(F.concat_ws(", ", "line_1", "line_2", "city"), F.lit(", S1 "), F.col("true_zip"))
    rows = rows.select("r", F.when(F.col("r") % 4 == 3, F.col("line_1")).otherwise(whole).alias("t"))
    piped = lambda c, *names: F.when(c.isNotNull(), F.concat_ws("|", *[c[k] for k in names]))
    return rows.select("r", piped(text.address_parts(F.col("t")), "line", "city", "state", "zip").alias("parts"), piped(text.geocoder_parts(F.col("t")), "street", "city", "state", "zip").alias("coded"))


@query("""SELECT s_suppkey, regexp_replace('813110' || lpad((s_suppkey % 43)::VARCHAR, 2, '0'), '^813110', '') AS code, try_cast(CASE WHEN s_suppkey % 3 = 0 THEN 'x' ELSE s_suppkey::VARCHAR END AS INT) AS number, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE array_to_string(range(0, s_suppkey % 5), '; ') END AS joined,
 CASE WHEN st IN ('MA', 'TX') THEN 'State' WHEN st IN ('PR', 'DC') THEN 'Territory' ELSE 'Other' END AS kind, (s_suppkey % 4)::INT AS n_members, regexp_matches(b, 'PO BOX') AS boxed FROM (SELECT s_suppkey, ['MA', 'TX', 'PR', 'DC', 'XX'][1 + s_suppkey % 5] AS st, ['PO BOX 1', 'po box 2', 'POBOX 3'][1 + s_suppkey % 3] AS b FROM supplier)""")
def code_fields(spark, sf):
    k = F.col("s_suppkey")
    pick = lambda *x: F.get(F.array(*map(F.lit, x)), (k % len(x)).cast("int"))
    numbers = F.slice(F.array(*[F.lit(str(i)) for i in range(5)]), 1, (k % 5).cast("int"))
    listed = F.array_join(F.slice(F.array(*[F.lit(f" m{i} ") for i in range(4)]), 1, (k % 4).cast("int")), ",")
    return table(spark, sf, "supplier").select(
        "s_suppkey", text.strip_prefix(F.concat(F.lit("813110"), F.lpad((k % 43).cast("string"), 2, "0")), "813110").alias("code"), F.when(k % 3 == 0, "x").otherwise(k.cast("string")).try_cast("int").alias("number"), text.joined_list(numbers).alias("joined"),
        text.region_kind(pick("MA", "TX", "PR", "DC", "XX")).alias("kind"), F.size(text.members(listed)).alias("n_members"), pick("PO BOX 1", "po box 2", "POBOX 3").rlike(text.MAILBOX_IN_CAPITALS).alias("boxed"))


# ---- how rows are tied to clusters, cities, assumptions

def _tied(spark, sf, how: str) -> DataFrame:
    rows = named_parts(spark, sf).select(F.col("p_brand").alias("k"), F.col("p_partkey").alias("r"), F.col("p_name").alias("raw"))
    labels = clusters.clusters(rows.filter("r % 3 = 0"), "k", "raw", CLUSTER_AT)
    return clusters.associated(rows.withColumn("line", F.col("raw")), "k", "raw", "line", labels, "raw", how).select("k", "r", "cluster")


_SOME = f"(SELECT p_brand AS k, p_name AS raw FROM {NAMES_SQL} WHERE p_partkey % 3 = 0)"
_TIE = f"SELECT DISTINCT p_brand AS k, p_partkey AS r, cluster FROM {NAMES_SQL} JOIN ({labels_sql(_SOME, 'k', 'raw', CLUSTER_AT)}) l ON l.k = p_brand AND"


@query(f"{_TIE} l.raw = p_name")
def tied_exactly(spark, sf):
    return _tied(spark, sf, "exact")


@query(f"{_TIE} regexp_matches(p_name, split_part(l.raw, ',', 1))")
def tied_by_pattern(spark, sf):
    return _tied(spark, sf, "regex")


@query(f"{_TIE} (lower(l.raw) = lower(p_name) OR starts_with(lower(p_name), lower(l.raw) || ','))")
def tied_by_prefix(spark, sf):
    return _tied(spark, sf, "prefix")


_CITIES = f"(SELECT c_nationkey AS k, c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'NATION_' || c_nationkey WHEN 1 THEN 'NATION ' || c_nationkey WHEN 2 THEN c_mktsegment ELSE lower(c_mktsegment) END AS city, CASE WHEN c_custkey % 97 = 0 THEN 'P O Box 7' ELSE c_name END AS address FROM customer)"
_UNIQUE = f"SELECT k, string_agg(city, ', ' ORDER BY city) AS names, count(*) AS n, count(DISTINCT cluster) AS n_similar FROM ({labels_sql(_CITIES, 'k', 'city', CLUSTER_AT)}) GROUP BY 1"


@query(f"""SELECT e.k, info AS preferred, n_entries, boxed, names AS similar, names AS "unique", n_similar AS n_similar_clusters, 0::INT AS unique_less_similar, CASE WHEN ok THEN 1 END AS n_suggested, CASE WHEN ok THEN (n - 1)::INT END AS unique_less_preferred, CASE WHEN ok THEN contains(names, info) END AS preferred_in_unique
 FROM (SELECT k, count(*) AS n_entries, bool_or(address = 'P O Box 7') AS boxed FROM {_CITIES} GROUP BY 1) e JOIN ({_UNIQUE}) u ON u.k = e.k JOIN (SELECT n_nationkey AS k, n_nationkey % 5 <> 0 AS ok, CASE WHEN n_nationkey % 5 <> 0 THEN n_name ELSE 'No Matches Found' END AS info FROM nation) p ON p.k = e.k""")
def city_variation(spark, sf):
    c = F.col("c_custkey")
    city = F.when(c % 4 == 0, F.concat(F.lit("NATION_"), "c_nationkey")).when(c % 4 == 1, F.concat(F.lit("NATION "), "c_nationkey")).when(c % 4 == 2, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment"))
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), city.alias("city"), F.when(c % 97 == 0, "P O Box 7").otherwise(F.col("c_name")).alias("address"))
    nations = table(spark, sf, "nation")
    codes = nations.filter("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("k"), F.lit(0).alias("place"), F.col("n_nationkey").alias("code"))
    names = lookup.names_of(codes, "k", "code", "place", nations.select(F.col("n_nationkey").alias("code"), "n_name"), "n_name", nations.select(F.col("n_nationkey").alias("k")))
    return audit.city_variation(rows, "k", "city", "address", clusters.clusters(rows, "k", "city", CLUSTER_AT), names)


_PROFILE = """(SELECT o_custkey, CASE WHEN near AND zip AND rest THEN 1 WHEN near AND zip THEN 2 WHEN near AND rest THEN 3 WHEN near THEN 4 WHEN zip AND rest THEN 5 WHEN NOT zip AND NOT rest THEN 6 ELSE 7 END AS assumption, boxed FROM (SELECT o_custkey, max(o_totalprice) - min(o_totalprice) < 250000 AS near,
 count(DISTINCT o_orderstatus) = 1 AS zip, count(DISTINCT year(o_orderdate)) = 1 AS rest, bool_or(o_orderkey % 13 = 0) AS boxed FROM orders GROUP BY 1 HAVING count(*) > 1))"""


@query(f"SELECT assumption::INT AS assumption, n, round(100 * n::DOUBLE / sum(n) OVER (), 2) AS of_profile, round(100 * n::DOUBLE / (SELECT count(DISTINCT o_custkey) FROM orders), 2) AS of_all, round(100 * b::DOUBLE / n, 2) AS boxed FROM (SELECT assumption, count(*) AS n, count(*) FILTER (boxed) AS b FROM {_PROFILE} GROUP BY 1)")
def assumption_classes(spark, sf):
    rows = orders(spark, sf)
    flags = profile.duplicate_profile(rows, "o_custkey", {}, {"zip": F.col("o_orderstatus"), "rest": F.col("y")}, {"near": (F.col("o_totalprice"), 250000.0)})
    boxed = rows.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderkey") % 13 == 0).alias("boxed"))
    told = flags.join(boxed, "o_custkey").withColumn("assumption", audit.assumption(F.col("near"), F.col("zip"), F.col("rest")))
    return audit.assumption_shares(told, "assumption", "boxed", boxed.count())


# ---- presence and shapes

@query(f"""SELECT o_custkey, started, ahead, reopened FROM (SELECT o_custkey, regexp_replace(regexp_replace(regexp_replace(bits, '1000(0)', '1111\\1', 'g'), '100(0)', '111\\1', 'g'), '10(0)', '11\\1', 'g') AS started, right(substr(bits, 1, 4), 1) = '1' OR contains(substr(bits, 1, 4), '1') AND contains(substr(bits, 5), '1') AS ahead,
 len(regexp_extract_all(bits, '10000+11'))::INT AS reopened FROM (SELECT o_custkey, {' || '.join(f"CASE WHEN count(*) FILTER (year(o_orderdate) = {y}) > 1 THEN '1' ELSE '0' END" for y in YEARS)} AS bits FROM orders GROUP BY 1))""")
def presence_starts(spark, sf):
    sums = orders(spark, sf).groupBy("o_custkey").agg(*[F.count(f).alias(k) for k, f in year_flags().items()])
    bits = sums.select("o_custkey", presence.bits([(F.col(f"y{k}") > 1).cast("int") for k in YEARS]).alias("bits"))
    return bits.select("o_custkey", presence.fill_start(F.col("bits")).alias("started"), presence.looks_ahead(F.substring("bits", 1, 4), F.substring("bits", 5, 99)).alias("ahead"), presence.reopenings(F.col("bits")).alias("reopened"))


@query("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names, count(*) AS n FROM nation GROUP BY 1")
def flattened_groups(spark, sf):
    lists = table(spark, sf, "nation").groupBy("n_regionkey", (F.col("n_nationkey") % 3).alias("part")).agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("inner"))
    flat = lists.groupBy("n_regionkey").agg(F.array_sort(F.flatten(F.collect_list("inner"))).alias("all"))
    return flat.select("n_regionkey", F.array_join(F.transform("all", lambda x: x["n_name"]), ", ").alias("names"), F.size("all").cast("long").alias("n"))


@query("SELECT c_custkey, c_mktsegment, n, names FROM customer JOIN (SELECT c_nationkey AS k, count(*) AS n, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS names FROM customer GROUP BY 1) ON k = c_nationkey")
def group_facts_on_rows(spark, sf):
    rows = table(spark, sf, "customer")
    facts = rows.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ", ").alias("names"))
    return rows.join(facts, "c_nationkey").select("c_custkey", "c_mktsegment", "n", "names")


#: Order keys as row numbers from 1, some of which are missing, in ranges of 1,500.
_NUMBERED = "(SELECT o_orderkey + 1 AS row, o_custkey FROM orders WHERE o_orderkey % 4001 <> 17)"
_RANGED = f"SELECT (row - 1) // 1500 * 1500 + 1 AS first, (row - 1) // 1500 * 1500 + 1500 AS last, count(*) AS n_rows FROM {_NUMBERED} GROUP BY 1, 2"


def ranged_orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").filter("o_orderkey % 4001 <> 17").select((F.col("o_orderkey") + 1).alias("row"), "o_custkey")


@query(f"SELECT *, 'finished' AS state FROM ({_RANGED})")
def range_ledger(spark, sf):
    rows, path = ranged_orders(spark, sf), shared_path(spark, "ranges")
    ranges.write_ranges(rows.filter("row <= 6000"), path, "row", 1500)  # a first run that ended early
    ranges.write_ranges(rows, path, "row", 1500)
    ranges.write_ranges(rows, path, "row", 1500, only=[1], again=True)
    return ranges.range_ledger(spark, path).select("first", "last", "n_rows", "state")


@query(f"""SELECT first, last, n_expected, n_rows, CASE WHEN n_rows IS NULL THEN 'missing' WHEN n_rows < n_expected THEN 'short' ELSE 'complete' END AS verdict
 FROM (SELECT range AS first, range + 1499 AS last, least(1500, (SELECT max(o_orderkey) + 2 FROM orders) - range) AS n_expected FROM range(1, (SELECT max(o_orderkey) + 2 FROM orders), 1500)) LEFT JOIN (SELECT * FROM ({_RANGED}) WHERE first <> 3001) USING (first, last)""")
def expected_ranges(spark, sf):
    rows, path = ranged_orders(spark, sf), shared_path(spark, "ranges")
    ranges.write_ranges(rows.filter("row <= 3000"), path, "row", 1500)
    ranges.write_ranges(rows.filter("row > 4500"), path, "row", 1500)
    total = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] + 1
    return ranges.range_report(ranges.expected_ranges(spark, total, 1500), ranges.range_ledger(spark, path))


#: Orders as text: a code with leading zeros, a whole number, a price and a date, some of which are no such thing.
_TEXTS = """(SELECT o_orderkey AS r, lpad((o_custkey % 1000)::VARCHAR, 5, '0') AS zip, CASE WHEN o_orderkey % 211 = 3 THEN 'none' WHEN o_orderkey % 50 = 1 THEN 'NA' ELSE o_custkey::VARCHAR END AS cust, CASE WHEN o_orderkey % 307 = 5 THEN '12,50' WHEN o_orderkey % 10 = 0 THEN (o_orderkey * 3)::VARCHAR ELSE (o_orderkey % 900)::VARCHAR || '.5' END AS price,
 CASE WHEN o_orderkey % 401 = 7 THEN '2001-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)"""
_BAD = "r % 211 = 3, r % 307 = 5, r % 401 = 7".split(", ")


def typed_orders(spark, sf) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.alias("r"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 5, "0").alias("zip"), F.when(k % 211 == 3, "none").when(k % 50 == 1, "NA").otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 307 == 5, "12,50").when(k % 10 == 0, (k * 3).cast("string")).otherwise(F.concat((k % 900).cast("string"), F.lit(".5"))).alias("price"), F.when(k % 401 == 7, "2001-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return typed.typed(rows, typed.inferred(rows, ["zip", "cust", "price", "day"], 0.02), "r")


@query(f"SELECT r, zip, try_cast(cust AS BIGINT) AS cust, price::DOUBLE AS price, day::DATE AS day FROM {_TEXTS} WHERE NOT ({' OR '.join(_BAD)})")
def typed_rows(spark, sf):
    return typed_orders(spark, sf)[0]


@query(" UNION ALL ".join(f"SELECT r AS row, '{c}' AS column, {c} AS value, 'text in a column of type {t}' AS reason FROM {_TEXTS} WHERE {w}" for c, t, w in zip(("cust", "price", "day"), ("long", "double", "date"), _BAD, strict=True)))
def rejected_cells(spark, sf):
    return typed_orders(spark, sf)[1]


_WIDE = ", ".join(f"count(*) FILTER (year(o_orderdate) = {y + 5}) AS \"{y + 5}\"" for y in range(1995, 1997))


@query(f"SELECT o_custkey, {_WIDE}, NULL::VARCHAR AS note FROM orders GROUP BY 1")
def aligned_columns(spark, sf):
    rows = orders(spark, sf).groupBy("o_custkey").agg(*[F.count(F.when(F.col("y") == y, 1)).alias(str(y)) for y in (2000, 2001)], F.max("o_totalprice").alias("other"))
    wanted = spark.createDataFrame([], "o_custkey long, `2000` long, `2001` long, note string")
    years = year_columns(rows)
    return align(rows.select("o_custkey", *years, "other"), wanted)


TRACTS = tuple((year, state, 10 * i + j + year, i * 0.25, j * 0.5) for year in (2000, 2010) for i, state in enumerate("AABB") for j in range(2))


@query(f"""WITH p AS (SELECT vec_id, (embedding[1]::double + 1) / 2 AS x, (embedding[2]::double + 1) / 2 AS y FROM embeddings), t(year, state, tract, x0, y0) AS (VALUES {', '.join(f"({a}, '{b}', {c}, {d}::double, {e}::double)" for a, b, c, d, e in TRACTS)})
 SELECT vec_id, year, state AS "State", tract AS "Tract" FROM p JOIN t ON x >= x0 AND x < x0 + 0.25 AND y >= y0 AND y < y0 + 0.5""")
def census_tracts(spark, sf):
    e = F.col("embedding")
    points = table(spark, sf, "embeddings").select("vec_id", ((e[0].cast("double") + 1) / 2).alias("x"), ((e[1].cast("double") + 1) / 2).alias("y"))
    square = lambda x, y, w, h: ((x, y, x + w, y), (x + w, y, x + w, y + h), (x + w, y + h, x, y + h), (x, y + h, x, y))
    states = spark.createDataFrame([(year, s, *edge) for year in (2000, 2010) for s, x in (("A", 0.0), ("B", 0.5)) for edge in square(x, 0.0, 0.5, 1.0)], "year int, polygon string, x1 double, y1 double, x2 double, y2 double")
    tracts = spark.createDataFrame([(year, s, t, *edge) for year, s, t, x, y in TRACTS for edge in square(x, y, 0.25, 0.5)], "year int, state string, polygon int, x1 double, y1 double, x2 double, y2 double")
    return polygons.census_tracts(points, "x", "y", states, tracts, (2000, 2010)).select("vec_id", "year", "State", "Tract")
