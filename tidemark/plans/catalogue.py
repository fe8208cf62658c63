"""The registered queries of the core library, each with the SQL that states its result on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, presence, text
from ..operators import clusters, lookup, places, polygons, profile, survivors
from ..sources.tables import keep_first, replace_rows, same_keys, table, union_filled

YEARS = list(range(1995, 2002))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CLUSTER_AT = 0.15

#: A constant table of polygons: a square and a triangle, by their edges.
POLYGONS = ((1, 0.0, 0.0, 0.5, 0.0), (1, 0.5, 0.0, 0.5, 0.5), (1, 0.5, 0.5, 0.0, 0.5), (1, 0.0, 0.5, 0.0, 0.0), (2, -1.0, -1.0, 0.0, -1.0), (2, 0.0, -1.0, -0.5, 0.0), (2, -0.5, 0.0, -1.0, -1.0))


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))


def year_flags(at: Column | None = None) -> dict[str, Column]:
    y = F.col("y") if at is None else at
    return {f"y{k}": F.when(y == k, 1) for k in YEARS}


YEAR_SUMS = ", ".join(f"count(*) FILTER (year(o_orderdate) = {k}) AS y{k}" for k in YEARS)
BITS_SQL = f"SELECT o_custkey, {' || '.join(f'''CASE WHEN y{k} > 0 THEN '1' ELSE '0' END''' for k in YEARS)} AS bits FROM (SELECT o_custkey, {YEAR_SUMS} FROM orders GROUP BY 1)"
CYCLE = lambda x: f"regexp_replace(regexp_replace(regexp_replace({x}, '101', '111', 'g'), '1001', '1111', 'g'), '10001', '11111', 'g')"


def bit_rows(spark: SparkSession, sf: str) -> DataFrame:
    sums = orders(spark, sf).groupBy("o_custkey").agg(*[F.count(f).alias(k) for k, f in year_flags().items()])
    return sums.select("o_custkey", presence.bits([(F.col(f"y{k}") > 0).cast("int") for k in YEARS]).alias("bits"))


PROFILE_SQL = f"""SELECT o_custkey, count(*) AS n_rows, {' AND '.join(f'count(*) FILTER (year(o_orderdate) = {k}) <= 1' for k in YEARS)} AS exclusive,
 count(DISTINCT o_orderstatus) = 1 AS status_same, count(DISTINCT o_orderpriority) = 1 AS priority_same, max(o_totalprice) - min(o_totalprice) < 200000 AS price_near
 FROM orders GROUP BY 1 HAVING count(*) > 1"""


@query(PROFILE_SQL)
def dup_profile(spark, sf):
    same = {"status_same": F.col("o_orderstatus"), "priority_same": F.col("o_orderpriority")}
    return profile.duplicate_profile(orders(spark, sf), "o_custkey", year_flags(), same, {"price_near": (F.col("o_totalprice"), 200000.0)})


@query(f"SELECT exclusive, status_same, priority_same, price_near, count(*) AS n, round(count(*) * 10000 / sum(count(*)) OVER ()) / 100 AS pct FROM ({PROFILE_SQL}) GROUP BY ALL")
def dup_class_counts(spark, sf):
    by = ["exclusive", "status_same", "priority_same", "price_near"]
    counts = dup_profile(spark, sf).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.crossJoin(F.broadcast(total)).select(*by, "n", (F.round(F.col("n") * 10000 / F.col("t")) / 100).alias("pct"))  # one row


@query("""SELECT o_custkey, count(DISTINCT year(o_orderdate)) = 1 AS year_same, count(DISTINCT nullif(o_orderstatus, 'P')) + max((nullif(o_orderstatus, 'P') IS NULL)::int) = 1 AS status_same,
 count(DISTINCT o_orderpriority) = 1 AS priority_same FROM orders GROUP BY 1 HAVING count(*) > 1""")
def field_uniqueness(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    same = {"year_same": F.col("y"), "status_same": status, "priority_same": F.col("o_orderpriority")}
    return profile.duplicate_profile(orders(spark, sf), "o_custkey", {}, same, {}).drop("n_rows", "exclusive")


@query("""WITH f AS (SELECT DISTINCT l_returnflag FROM lineitem), s AS (SELECT DISTINCT l_linestatus FROM lineitem), d AS (SELECT DISTINCT l_linenumber FROM lineitem),
 c AS (SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
 SELECT f.l_returnflag, s.l_linestatus, d.l_linenumber, coalesce(n, 0) AS n, round(coalesce(n, 0) * 10000 / sum(coalesce(n, 0)) OVER ()) / 100 AS pct
 FROM f, s, d LEFT JOIN c ON c.l_returnflag = f.l_returnflag AND c.l_linestatus = s.l_linestatus AND c.l_linenumber = d.l_linenumber""")
def contingency_3way_pct(spark, sf):
    return profile.contingency(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("SELECT flag, l_linestatus, count(*) AS n, round(count(*) * 10000 / sum(count(*)) OVER ()) / 100 AS pct FROM (SELECT nullif(l_returnflag, 'R') AS flag, l_linestatus FROM lineitem) GROUP BY 1, 2")
def contingency_with_null(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"), "l_linestatus")
    return profile.contingency(rows, ["flag", "l_linestatus"], with_null=True)


@query("""SELECT l_returnflag, min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3,
 round(avg(l_quantity), 6) AS mean, max(l_quantity) AS max FROM lineitem GROUP BY 1""")
def quantile_summary(spark, sf):
    return profile.quantile_summary(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_quantity")).withColumn("mean", F.round("mean", 6))


@query("SELECT label, count(*) AS n, round(max(embedding[1]::double) - min(embedding[1]::double), 6) AS spread, max(embedding[1]::double) - min(embedding[1]::double) < 0.5 AS near FROM embeddings GROUP BY 1")
def geo_range_flag(spark, sf):
    x = F.col("embedding")[0].cast("double")
    return table(spark, sf, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(x) - F.min(x), 6).alias("spread"), (F.max(x) - F.min(x) < 0.5).alias("near"))


@query("SELECT label, CASE WHEN count(x) = count(*) THEN round(max(x), 6) END AS top, CASE WHEN count(x) = count(*) THEN round(avg(x), 6) END AS mean FROM (SELECT label, CASE WHEN vec_id % 97 <> 0 THEN embedding[1]::double END AS x FROM embeddings) GROUP BY 1")
def strict_aggregates(spark, sf):
    x = F.when(F.col("vec_id") % 97 != 0, F.col("embedding")[0].cast("double"))
    return table(spark, sf, "embeddings").groupBy("label").agg(F.round(nulls.strict_max(x), 6).alias("top"), F.round(nulls.strict_mean(x), 6).alias("mean"))


@query("SELECT p_name, p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part) WHERE k = 1")
def first_seen_dedup(spark, sf):
    return keep_first(table(spark, sf, "part").select("p_name", "p_partkey", "p_brand"), ["p_name"], ["p_partkey"])


INFO_SQL = """SELECT p_partkey, max(k > 1) OVER (PARTITION BY p_brand, p_name) AS has_duplicates, CASE WHEN count(*) OVER (PARTITION BY p_brand, p_name) > 1 THEN k = 1 END AS is_unique, p_brand
 FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name, p_type ORDER BY p_partkey) AS k FROM part)"""


def part_info(spark, sf):
    return profile.unique_info(table(spark, sf, "part"), ["p_brand", "p_name"], ["p_type"], ["p_partkey"])


@query(f"SELECT p_partkey, has_duplicates, is_unique FROM ({INFO_SQL})")
def dup_flag(spark, sf):
    return part_info(spark, sf).select("p_partkey", "has_duplicates", "is_unique")


@query(f"""SELECT p_brand, n_true, n_false, CASE WHEN n_true = 1 AND n_false = 2 THEN 'more_false' WHEN n_true = 2 AND n_false <= 1 OR n_true = 3 AND n_false <= 2 THEN 'more_true' ELSE 'other' END AS kind
 FROM (SELECT p_brand, count(*) FILTER (is_unique) AS n_true, count(*) FILTER (NOT is_unique) AS n_false FROM ({INFO_SQL}) GROUP BY 1)""")
def duplicate_nature(spark, sf):
    n = part_info(spark, sf).groupBy("p_brand").agg(F.count_if("is_unique").alias("n_true"), F.count_if(~F.col("is_unique")).alias("n_false"))
    t, f = F.col("n_true"), F.col("n_false")
    kind = F.when((t == 1) & (f == 2), "more_false").when(((t == 2) & (f <= 1)) | ((t == 3) & (f <= 2)), "more_true").otherwise("other")
    return n.withColumn("kind", kind)


@query(f"SELECT o_custkey, bits, CASE WHEN strpos(bits, '1') > 0 THEN 'y' || (1994 + strpos(bits, '1')) END AS first_year FROM ({BITS_SQL})")
def year_bits(spark, sf):
    rows = bit_rows(spark, sf)
    flags = {f"y{k}": F.substring("bits", i + 1, 1).cast("int") for i, k in enumerate(YEARS)}
    return rows.withColumn("first_year", presence.first_one(flags))


@query(f"""SELECT o_custkey, filled, ended, round(CASE WHEN length(replace(ended, '0', '')) = 0 THEN 0.0 ELSE length(replace(ended, '0', '')) / length(ended) * (length(replace(bits, '0', '')) / length(ended)) END, 6) AS persistence,
 len(regexp_extract_all(filled, '10000+$|10000+11'))::BIGINT AS closures FROM (SELECT *, {CYCLE(CYCLE('bits'))} AS filled,
 CASE WHEN regexp_matches(x, '10{{1,3}}$') THEN regexp_replace(regexp_replace(regexp_replace(x, '1000$', '1111'), '100$', '111'), '10$', '11') ELSE x END AS ended FROM (SELECT *, {CYCLE(CYCLE('bits'))} AS x FROM ({BITS_SQL})))""")
def bit_metrics(spark, sf):
    rows = bit_rows(spark, sf).withColumns({"filled": presence.fill_gaps(F.col("bits")), "ended": presence.fill_end(F.col("bits"))})
    return rows.select("o_custkey", "filled", "ended", F.round(presence.persistence(F.col("ended"), F.col("bits")), 6).alias("persistence"), presence.closures(F.col("filled")).cast("long").alias("closures"))


@query("SELECT DISTINCT a.y AS start, b.y AS \"end\" FROM (SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders) a, (SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders) b WHERE b.y - a.y = 3")
def gap_pairs(spark, sf):
    return survivors.gap_pairs(orders(spark, sf).select(F.col("y").alias("year")).distinct(), 3)


SPAN = ", ".join(f"greatest(least(e, {hi}) - greatest(s, {lo}) + 1, 0) AS o{i}" for i, (_, lo, hi) in enumerate(presence.REFERENCES))


@query(f"""SELECT o_custkey, s AS first_year, e AS last_year, CASE WHEN e BETWEEN 2000 AND 2009 THEN '2000 Census' WHEN e BETWEEN 2010 AND 2019 THEN '2010 Census' WHEN e BETWEEN 2020 AND 2029 THEN '2020 Census' END AS ending,
 CASE WHEN greatest(o0, o1, o2) = 0 THEN NULL WHEN o0 = greatest(o0, o1, o2) THEN '2000 Census' WHEN o1 = greatest(o0, o1, o2) THEN '2010 Census' ELSE '2020 Census' END AS spanning
 FROM (SELECT *, {SPAN} FROM (SELECT o_custkey, (min(year(o_orderdate)) + 8)::INT AS s, (max(year(o_orderdate)) + 12)::INT AS e FROM orders GROUP BY 1))""")
def decide_reference(spark, sf):
    rows = orders(spark, sf).groupBy("o_custkey").agg((F.min("y") + 8).alias("first_year"), (F.max("y") + 12).alias("last_year"))
    s, e = F.col("first_year"), F.col("last_year")
    return rows.withColumns({"ending": presence.reference(s, e, False), "spanning": presence.reference(s, e, True)})


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_in(spark, sf):
    keys = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(keys, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT k, c_name FROM (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS k, c_name FROM customer) WHERE k IS NULL OR k NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_notin_null_keep(spark, sf):
    rows = table(spark, sf, "customer").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("k"), "c_name")
    keys = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return rows.join(keys, "k", "left_anti").select("k", "c_name")


@query("SELECT o_orderkey, status, status IS NOT DISTINCT FROM 'F' AS is_f, coalesce(status IN ('F', 'O'), false) AS in_set FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders) WHERE NOT coalesce(status IN ('O'), false)")
def null_safe_filters(spark, sf):
    s = F.col("status")
    rows = table(spark, sf, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return rows.filter(nulls.not_in(s, ["O"])).select("o_orderkey", "status", s.eqNullSafe("F").alias("is_f"), nulls.is_in(s, ["F", "O"]).alias("in_set"))


@query("SELECT p_partkey, coalesce(o.v, p.p_type) AS kind FROM part p LEFT JOIN (SELECT p_brand AS b, p_name AS n, min(p_type) AS v FROM part WHERE p_size < 10 GROUP BY 1, 2) o ON o.b = p.p_brand AND o.n = p.p_name")
def override_left_join(spark, sf):
    part = table(spark, sf, "part")
    over = part.filter("p_size < 10").groupBy("p_brand", "p_name").agg(F.min("p_type").alias("v"))
    return part.join(over, ["p_brand", "p_name"], "left").select("p_partkey", F.coalesce("v", "p_type").alias("kind"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) UNION ALL SELECT o_orderkey, o_custkey, 'NEW' FROM orders WHERE o_totalprice > 400000")
def replace_by_key(spark, sf):
    old = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = old.filter("o_totalprice > 400000").withColumn("o_orderstatus", F.lit("NEW"))
    return replace_rows(old, new, ["o_custkey"]).drop("o_totalprice")


@query("SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_nationkey, NULL FROM supplier")
def union_fill_missing(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return union_filled(a, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")))


@query("""SELECT count(*) FILTER (b IS NULL) AS only_first, count(*) FILTER (a IS NULL) AS only_second, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS in_both,
 count(*) FILTER (b IS NULL) = 0 AND count(*) FILTER (a IS NULL) = 0 AS equal_sets, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) = 0 AS disjoint_sets
 FROM (SELECT DISTINCT c_custkey AS a FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders) ON a = b""")
def key_set_checks(spark, sf):
    return same_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("SELECT zip, city, state_id FROM (SELECT *, row_number() OVER (PARTITION BY zip ORDER BY city, state_id) AS k FROM (SELECT p_name AS city, p_brand AS state_id, unnest([lpad((p_partkey % 500)::VARCHAR, 5, '0'), lpad((p_size)::VARCHAR, 5, '0')]) AS zip FROM part)) WHERE k = 1")
def explode_lookup_first(spark, sf):
    zips = F.concat_ws(" ", F.lpad((F.col("p_partkey") % 500).cast("string"), 5, "0"), F.lpad(F.col("p_size").cast("string"), 5, "0"))
    cities = table(spark, sf, "part").select(F.col("p_name").alias("city"), F.col("p_brand").alias("state_id"), zips.alias("zips"))
    return lookup.zip_city_lookup(cities).select("zip", "city", "state_id")


@query("""WITH c AS (SELECT c_custkey, unnest([0, 1]) AS place, unnest([c_nationkey % 40, c_custkey % 40]) AS code FROM customer), f AS (SELECT c_custkey, upper(n_name) AS n, min(place) AS pos FROM c JOIN nation ON n_nationkey = code GROUP BY 1, 2)
 SELECT c_custkey, coalesce((SELECT string_agg(n, ', ' ORDER BY pos) FROM f WHERE f.c_custkey = k.c_custkey), 'No Matches Found: ' || string_agg(code::VARCHAR, ', ' ORDER BY place)) AS info FROM c k GROUP BY 1""")
def lookup_message(spark, sf):
    codes = table(spark, sf, "customer").select("c_custkey", F.posexplode(F.array(F.col("c_nationkey") % 40, F.col("c_custkey") % 40)).alias("place", "n_nationkey"))
    return lookup.names_of(codes, "c_custkey", "n_nationkey", "place", table(spark, sf, "nation"), "n_name")


@query("SELECT p_partkey, CASE WHEN length(z) = 1 THEN '00000' ELSE z END AS zip FROM (SELECT p_partkey, regexp_replace(regexp_replace(p_partkey::VARCHAR, '\\b(\\d{4})\\b', '0\\1', 'g'), '\\b(\\d{3})\\b', '0\\10', 'g') AS z FROM part)")
def zip_pad(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.pad_zip(F.col("p_partkey").cast("string")).alias("zip"))


@query("""SELECT p_partkey, CASE WHEN core = '' THEN z ELSE array_to_string(list_concat([z], list_filter(list_transform(range(n, -1, -1), lambda k: repeat('0', k) || core || repeat('0', n - k)), lambda x: x <> z)), '|') END AS candidates
 FROM (SELECT *, length(z) - length(core) AS n FROM (SELECT p_partkey, lpad(p_partkey::VARCHAR, 5, '0') AS z, trim(lpad(p_partkey::VARCHAR, 5, '0'), '0') AS core FROM part))""")
def zip_candidates(spark, sf):
    z = F.lpad(F.col("p_partkey").cast("string"), 5, "0")
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.zip_candidates(z), "|").alias("candidates"))


@query("SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '[\\t\\n\\x0B\\f\\r ]*,[\\t\\n\\x0B\\f\\r ]*', ', ', 'g'), '[^a-z0-9, ]', '', 'g'), ' +', ' ', 'g'), '^ +| +$', '', 'g'))) AS digest FROM documents")
def preprocess_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.normalise_address(F.col("text"))).alias("digest"))


@query("""SELECT n_nationkey, name, CASE WHEN city THEN 'City' WHEN (length(name) <= 4 AND NOT contains(name, ' ') OR regexp_matches(name, '^[A-Z](\\.[A-Z])+\\.?$')) AND name NOT IN ('ST','AVE','BLVD','RD','DR','LN','CT') THEN 'Acronym' ELSE 'Unknown' END AS kind
 FROM (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'ST' WHEN 1 THEN 'U.S.A.' WHEN 2 THEN n_name ELSE 'NYC' END AS name, n_nationkey % 4 = 2 AS city FROM nation)""")
def acronym_or_city(spark, sf):
    k = F.col("n_nationkey") % 4
    rows = table(spark, sf, "nation").select("n_nationkey", F.when(k == 0, "ST").when(k == 1, "U.S.A.").when(k == 2, F.col("n_name")).otherwise("NYC").alias("name"))
    cities = table(spark, sf, "nation").select(F.lower("n_name").alias("c")).distinct().withColumn("hit", F.lit(True))
    joined = rows.join(cities, F.lower("name") == F.col("c"), "left")
    return joined.select("n_nationkey", "name", text.acronym_or_city(F.col("name"), F.coalesce("hit", F.lit(False))).alias("kind"))


#: Parts whose names differ in case, blanks and signs as well.
NAMES_SQL = "(SELECT * REPLACE (CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '  ') WHEN 2 THEN p_name || '.' ELSE p_name END AS p_name) FROM part)"


def named_parts(spark, sf):
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    return table(spark, sf, "part").withColumn("p_name", F.when(k == 0, F.upper(name)).when(k == 1, F.replace(name, F.lit(" "), F.lit("  "))).when(k == 2, F.concat(name, F.lit("."))).otherwise(name))


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '\\s*,\\s*', ', ', 'g'), '[^a-z0-9, ]', '', 'g'), ' +', ' ', 'g'))"


def pairs_sql(rows: str, key: str, value: str, at: float) -> str:
    """(key, a, b) of distinct normalised values below the distance."""
    v = f"(SELECT DISTINCT {key} AS b, {norm_sql(value)} AS v FROM {rows} WHERE {value} IS NOT NULL)"
    return f"SELECT a.b AS {key}, a.v AS a, b.v AS b FROM {v} a JOIN {v} b ON a.b = b.b AND a.v < b.v WHERE 1 - jaro_similarity(a.v, b.v) < {at}"


def labels_sql(rows: str, key: str, value: str, at: float) -> str:
    """(key, value, cluster): raw values whose normalised ones are connected, by the least raw one."""
    given = f"(SELECT DISTINCT {key} AS gk, {value} AS gv, {norm_sql(value)} AS gn FROM {rows} WHERE {value} IS NOT NULL)"
    return f"""SELECT gk AS {key}, gv AS {value}, min(gv) OVER (PARTITION BY gk, root) AS cluster FROM {given}
 JOIN (SELECT rk, rn, min(rc) AS root FROM (WITH RECURSIVE p AS ({pairs_sql(rows, key, value, at)}), e AS (SELECT {key} AS ek, a, b FROM p UNION SELECT {key}, b, a FROM p),
 r(rk, rn, rc) AS (SELECT DISTINCT gk, gn, gn FROM {given} UNION SELECT rk, e.b, rc FROM r JOIN e ON ek = rk AND e.a = rn) SELECT * FROM r) GROUP BY 1, 2) ON rk = gk AND rn = gn"""


PAIRS_SQL = pairs_sql(NAMES_SQL, "p_brand", "p_name", CLUSTER_AT)
LABELS_SQL = labels_sql(NAMES_SQL, "p_brand", "p_name", CLUSTER_AT)


@query(f"SELECT p_brand, a, b, round(1 - jaro_similarity(a, b), 6) AS distance FROM ({PAIRS_SQL})")
def jaro_pairs(spark, sf):
    return clusters.similar_pairs(named_parts(spark, sf), "p_brand", F.col("p_name"), CLUSTER_AT).withColumn("distance", F.round("distance", 6))


def labels(spark, sf):
    return clusters.clusters(named_parts(spark, sf), "p_brand", "p_name", CLUSTER_AT)


@query(LABELS_SQL)
def similar_clusters(spark, sf):
    return labels(spark, sf)


@query(f"SELECT p_brand, count(*) AS n_exact, count(DISTINCT cluster) AS n_similar, count(*) = count(DISTINCT cluster) AS same_length FROM ({LABELS_SQL}) GROUP BY 1")
def exact_vs_similar(spark, sf):
    return clusters.exact_versus_similar(labels(spark, sf), "p_brand")


FLAG_SQL = ", ".join(f"count(*) FILTER (p_size % 5 = {k}) AS s{k}" for k in range(5))
COLLAPSE_SQL = f"SELECT p_brand, cluster, count(*) AS n_rows, count(DISTINCT p_name) AS n_members, {FLAG_SQL}, round(avg(p_retailprice), 4) AS mean_x, CASE WHEN count(*) = 1 THEN true ELSE max(p_retailprice) - min(p_retailprice) < 120 END AS near_test FROM {NAMES_SQL} JOIN ({LABELS_SQL}) USING (p_brand, p_name) GROUP BY 1, 2"


def size_flags() -> dict[str, Column]:
    return {f"s{k}": F.when(F.col("p_size") % 5 == k, 1) for k in range(5)}


def collapsed(spark, sf):
    part = named_parts(spark, sf)
    found = labels(spark, sf)
    return part, found, clusters.collapse(part, "p_brand", "p_name", found, "p_retailprice", size_flags(), 120.0)


@query(COLLAPSE_SQL)
def collapse_clusters(spark, sf):
    return collapsed(spark, sf)[2].withColumn("mean_x", F.round("mean_x", 4))


@query(f"SELECT p_brand, bool_and(s0 IN (0, 1)) AND sum(s0) <= 1 AND sum(s1) <= 1 AND sum(s2) <= 1 AND sum(s3) <= 1 AND sum(s4) <= 1 AS exclusive FROM ({COLLAPSE_SQL}) GROUP BY 1")
def introduced_dups(spark, sf):
    return profile.counts_are_0_or_1(collapsed(spark, sf)[2], "p_brand", {k: F.col(k) for k in size_flags()})


@query(f"""WITH c AS ({COLLAPSE_SQL}), l AS ({LABELS_SQL}) SELECT p_brand, cluster, n_rows, CASE WHEN near_test THEN 'TRUE' ELSE 'FALSE' END AS status FROM c WHERE near_test
 UNION ALL SELECT p_brand, p_name, count(*), 'Expanded' FROM {NAMES_SQL} WHERE (p_brand, p_name) IN (SELECT (l.p_brand, l.p_name) FROM l JOIN c ON c.p_brand = l.p_brand AND c.cluster = l.cluster WHERE NOT c.near_test) GROUP BY 1, 2""")
def expand_failed_clusters(spark, sf):
    part, found, one = collapsed(spark, sf)
    return clusters.expand_failed(part, "p_brand", "p_name", found, one, "p_retailprice", size_flags(), 120.0).select("p_brand", "cluster", "n_rows", "status")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS x, l_returnflag = 'R' AS boxed FROM lineitem), d AS (SELECT m.l_orderkey, m.id, abs(m.x - o.x) AS d, o.x <= m.x - 20000 OR o.x >= m.x + 20000 AS far FROM (SELECT *, l_linenumber::BIGINT * 1000000000 + l_partkey AS id FROM r WHERE boxed) m
 LEFT JOIN r o ON o.l_orderkey = m.l_orderkey AND NOT o.boxed) SELECT l_orderkey, id, count(d) AS n_total, count(d) FILTER (far) AS n_failed, bool_or(NOT far) AS near_any, round_even(min(d) FILTER (far), 3) AS failed_min, round_even(avg(d) FILTER (far), 3) AS failed_mean, round_even(max(d) FILTER (far), 3) AS failed_max FROM d GROUP BY 1, 2""")
def mailbox_proximity(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("id", F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey"))
    return profile.proximity_audit(rows, "l_orderkey", F.col("l_returnflag") == "R", "id", F.col("l_extendedprice"), 20000.0)


@query("""WITH RECURSIVE q AS (SELECT label, vec_id, CASE WHEN vec_id % 251 <> 7 THEN round(embedding[1]::double, 2) END AS x, round(embedding[2]::double, 2) AS y FROM embeddings), bad AS (SELECT label, min(vec_id) AS least FROM q WHERE label IN (SELECT label FROM q WHERE x IS NULL OR y IS NULL) GROUP BY 1), p AS (SELECT * FROM q WHERE label NOT IN (SELECT label FROM bad)),
 e AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.035),
 r(label, vec_id, c) AS (SELECT DISTINCT label, a, a FROM e UNION SELECT r.label, e.b, r.c FROM r JOIN e ON e.label = r.label AND e.a = r.vec_id) SELECT q.label, q.vec_id, coalesce(bad.least, m.cluster) AS cluster, bad.label IS NULL AND m.cluster IS NULL AS is_noise, bad.label IS NOT NULL AS problem_geo FROM q LEFT JOIN bad USING (label) LEFT JOIN (SELECT label, vec_id, min(c) AS cluster FROM r GROUP BY 1, 2) m ON m.vec_id = q.vec_id AND m.label = q.label""")
def dbscan_2d(spark, sf):
    e = F.col("embedding")
    x = F.when(F.col("vec_id") % 251 != 7, F.round(e[0].cast("double"), 2))
    return places.density_clusters(table(spark, sf, "embeddings"), "label", "vec_id", x, F.round(e[1].cast("double"), 2), 0.035)


@query("""SELECT p_brand, p_partkey, x, CASE WHEN count(*) OVER (PARTITION BY p_brand, run) > 1 THEN run ELSE 0 END AS cluster FROM (SELECT p_brand, p_partkey, x, (sum(CASE WHEN x - lag <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY p_brand ORDER BY x, p_partkey ROWS UNBOUNDED PRECEDING))::BIGINT AS run
 FROM (SELECT p_brand, p_partkey, p_retailprice AS x, lag(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS lag FROM part))""")
def length_gap_cluster(spark, sf):
    return places.gap_clusters(table(spark, sf, "part"), "p_brand", F.col("p_retailprice"), "p_partkey", 2.0)


@query(f"SELECT o_orderkey, y, n > 1 AS introduced FROM (SELECT o_orderkey, year(o_orderdate)::INT AS y, count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS n FROM orders) WHERE y BETWEEN {YEARS[0]} AND {YEARS[-1]}")
def introduced_rows(spark, sf):
    return survivors.introduced(orders(spark, sf), "o_custkey", year_flags()).filter(F.col("y").between(YEARS[0], YEARS[-1])).select("o_orderkey", "y", "introduced")


@query("""SELECT c_custkey, min(attempt) AS attempt, coalesce(arg_min(n_name, attempt), 'No address match found') AS answer FROM customer LEFT JOIN (SELECT c_custkey AS k, unnest([1, 2, 3]) AS attempt, unnest([c_custkey % 70, c_custkey % 50, c_nationkey + 20]) AS code FROM customer) ON k = c_custkey AND code IN (SELECT n_nationkey FROM nation)
 LEFT JOIN nation ON n_nationkey = code GROUP BY 1""")
def validation_waterfall(spark, sf):
    tries = [F.col("c_custkey") % 70, F.col("c_custkey") % 50, F.col("c_nationkey") + 20]
    return lookup.waterfall(table(spark, sf, "customer"), "c_custkey", tries, lookup.table_validator(table(spark, sf, "nation"), "n_nationkey", "n_name"), "No address match found")


@query("SELECT (o_orderkey // 4200) * 4200 AS lo, count(*) FILTER (v) AS n_true, count(*) FILTER (NOT v) AS n_false, count(*) FILTER (v IS NULL) AS n_null, min(o_orderkey) >= (o_orderkey // 4200) * 4200 AND max(o_orderkey) < (o_orderkey // 4200) * 4200 + 4200 AS in_range FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS v FROM orders) GROUP BY o_orderkey // 4200")
def chunk_audit(spark, sf):
    v = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    rows = table(spark, sf, "orders").select("o_orderkey", v.alias("v"), (F.floor(F.col("o_orderkey") / 4200) * 4200).alias("lo"))
    key = F.col("o_orderkey")
    return rows.groupBy("lo").agg(F.count_if("v").alias("n_true"), F.count_if(~F.col("v")).alias("n_false"), F.count_if(F.col("v").isNull()).alias("n_null"), (F.min(key - F.col("lo")) >= 0).alias("low"), (F.max(key - F.col("lo")) < 4200).alias("high")).select("lo", "n_true", "n_false", "n_null", (F.col("low") & F.col("high")).alias("in_range"))


EDGES_SQL = "(VALUES " + ", ".join(f"({p}, {a}::double, {b}::double, {c}::double, {d}::double)" for p, a, b, c, d in POLYGONS) + ") g(polygon, x1, y1, x2, y2)"


@query(f"""WITH p AS (SELECT vec_id, embedding[1]::double * 4 AS x, embedding[2]::double * 4 AS y FROM embeddings), h AS (SELECT vec_id, polygon FROM p, {EDGES_SQL} WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)
 SELECT p.vec_id, h.polygon FROM p LEFT JOIN h USING (vec_id)""")
def point_in_polygon(spark, sf):
    e = F.col("embedding")
    points = table(spark, sf, "embeddings").select("vec_id", (e[0].cast("double") * 4).alias("x"), (e[1].cast("double") * 4).alias("y"))
    edges = spark.createDataFrame(list(POLYGONS), "polygon int, x1 double, y1 double, x2 double, y2 double")
    return polygons.in_polygons(points, "x", "y", edges).select("vec_id", "polygon")


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INT), 0) AS k, coalesce(json_extract_string(props, '$.name'), 'none') AS name FROM events")
def json_default(spark, sf):
    p = F.from_json("props", "k int, name string")
    return table(spark, sf, "events").select("event_id", F.coalesce(p["k"], F.lit(0)).alias("k"), F.coalesce(p["name"], F.lit("none")).alias("name"))


@query("SELECT o_custkey, string_agg(s, ', ' ORDER BY pos) AS first_seen, string_agg(s, ', ' ORDER BY s) AS sorted FROM (SELECT o_custkey, o_orderpriority AS s, min(o_orderkey) AS pos FROM orders GROUP BY 1, 2) GROUP BY 1")
def string_aggregates(spark, sf):
    firsts = table(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("s")).agg(F.min("o_orderkey").alias("at"))
    seen = F.transform(F.array_sort(F.collect_list(F.struct("at", "s"))), lambda x: x["s"])
    return firsts.groupBy("o_custkey").agg(F.array_join(seen, ", ").alias("first_seen"), F.array_join(F.array_sort(F.collect_list("s")), ", ").alias("sorted"))


@query("SELECT s_suppkey, CASE WHEN n IS NULL THEN NULL ELSE s_name || ', ' || n || ', ' || s_suppkey END AS strict, s_name || ', ' || coalesce(n, 'NA') AS pasted, coalesce(n, 'None Given') AS given FROM (SELECT *, CASE WHEN s_nationkey % 5 <> 0 THEN 'N' || s_nationkey END AS n FROM supplier)")
def compile_address(spark, sf):
    n = F.when(F.col("s_nationkey") % 5 != 0, F.concat(F.lit("N"), F.col("s_nationkey")))
    return table(spark, sf, "supplier").select("s_suppkey", nulls.join_strict(F.col("s_name"), n, F.col("s_suppkey")).alias("strict"), nulls.paste(F.col("s_name"), n).alias("pasted"), text.or_none_given(n).alias("given"))


@query("""SELECT page_id, url, regexp_matches(url, '(?i)PILLS|SPAM') AS flagged, regexp_matches(upper(url), 'EXAMPLE') AS in_capitals, contains(url, lang) AS has_lang, split_part(url, '/', 3) AS part
 FROM (SELECT page_id, url, '/' || ['en', 'de', 'fr', 'es'][1 + page_id % 4] || '/' AS lang FROM pages)""")
def regex_filters(spark, sf):
    lang = F.concat(F.lit("/"), F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es"))), (1 + F.col("page_id") % 4).cast("int")), F.lit("/"))
    return table(spark, sf, "pages").select("page_id", "url", F.col("url").rlike("(?i)PILLS|SPAM").alias("flagged"), F.upper("url").rlike("EXAMPLE").alias("in_capitals"), F.contains(F.col("url"), lang).alias("has_lang"), F.split_part("url", F.lit("/"), F.lit(3)).alias("part"))


@query("""SELECT p_brand, p_partkey, least(s.n, 1) AS capped, s.n > 1 AS over FROM part JOIN (SELECT p_brand AS b, p_size % 7 AS k, count(*) FILTER (p_type = 'ECONOMY') AS n FROM part GROUP BY 1, 2) s ON s.b = p_brand AND s.k = p_size % 7""")
def capped_sums(spark, sf):
    part = table(spark, sf, "part").withColumn("k", F.col("p_size") % 7)
    sums = part.groupBy("p_brand", "k").agg(F.count_if(F.col("p_type") == "ECONOMY").alias("n"))
    return part.join(sums, ["p_brand", "k"]).select("p_brand", "p_partkey", F.least("n", F.lit(1).cast("long")).alias("capped"), (F.col("n") > 1).alias("over"))
