"""Queries over the driver's tables that run the engine's operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postalith.functions import geometry as g
from postalith.functions import text
from postalith.operators import contracts, evidence, gates, records
from postalith.operators import spatial as sp
from postalith.operators.publish import line_count
from postalith.plans.schema import BOUNDARY, FALLBACK
from postalith.sources.osm import tag_map
from postalith.sources.post_codes import changes, prefer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PLACES = """
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, c_mktsegment AS city, 'DE' AS country, r_name AS state, n_name AS county,
         CASE WHEN max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 'postal_boundary' ELSE 'address_fallback' END AS source,
         CAST(count(*) AS INTEGER) AS evidence_count
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY n_nationkey, c_mktsegment, r_name, n_name"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as codes, market segments as cities, orders as evidence."""
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    # orders meet their customers once; the small dimensions join the sums
    counts = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "c_mktsegment")
    counts = counts.agg(F.count("*").cast("int").alias("evidence_count"), F.bool_or(F.col("o_orderstatus") == "F").alias("f"))
    told = counts.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return told.select(
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("code"), F.col("c_mktsegment").alias("city"), F.lit("DE").alias("country"), F.col("r_name").alias("state"),
        F.col("n_name").alias("county"), F.lit("W. Europe Standard Time").alias("time_zone"), F.when(F.col("f"), BOUNDARY).otherwise(FALLBACK).alias("source"), "evidence_count",
    )


@query(f"""
WITH p AS ({_PLACES})
SELECT code, city, state, county, source, evidence_count,
       CAST(row_number() OVER (PARTITION BY country, code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) AS INTEGER) AS location_rank,
       CAST(row_number() OVER (PARTITION BY country, lower(state), lower(county), lower(city) ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, code) AS INTEGER) AS postal_code_rank,
       row_number() OVER (PARTITION BY country, code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) = 1 AS is_primary_location
FROM p""")
def rank_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("code", "city", "state", "county", "source", "evidence_count", "location_rank", "postal_code_rank", "is_primary_location")
    return records.dedupe(places(spark, sf_dir)).select(*columns)


@query("SELECT o_custkey, CAST(max(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END) AS INTEGER) AS priority, max(o_orderkey) AS max_orderkey FROM orders GROUP BY o_custkey")
def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    best = {"priority": F.when(status == "F", 2).when(status == "O", 1).otherwise(0), "max_orderkey": F.col("o_orderkey")}
    return records.merge_duplicates(t(spark, sf_dir, "orders"), ["o_custkey"], best)


@query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def fallback_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = t(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return evidence.without(t(spark, sf_dir, "part"), sold, "p_partkey").select("p_partkey", "p_name")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) >= 14")
def evidence_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.at_least(t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")), 14)


@query("SELECT event_type, count(*) AS n, min_by(user_id, event_id) AS first_user FROM events GROUP BY event_type")
def first_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.first_by(t(spark, sf_dir, "events"), ["event_type"], F.col("event_id"), {"first_user": F.col("user_id")})


@query("""
SELECT p_partkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49 AND l_returnflag = 'R') THEN 'evidence'
  WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount >= 0.09 AND l_tax = 0) THEN 'other' ELSE 'spatial' END AS tier
FROM part""")
def prefer_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.bool_or((F.col("l_quantity") >= 49) & (F.col("l_returnflag") == "R")).alias("own"), F.bool_or((F.col("l_discount") >= 0.09) & (F.col("l_tax") == 0)).alias("other")
    )
    told = t(spark, sf_dir, "part").join(found, F.col("p_partkey") == F.col("l_partkey"), "left")
    seen = F.when(F.col("own"), F.array(F.lit("spatial"))).when(F.col("other"), F.array(F.lit("elsewhere"))).otherwise(F.array().cast("array<string>"))
    chosen = evidence.choose(F.array(F.lit("spatial")), seen)
    tier = F.when(F.size(F.array_intersect(chosen, seen)) == 0, "spatial").when(chosen[0] == "spatial", "evidence").otherwise("other")
    return told.select("p_partkey", tier.alias("tier"))


def _square(x, y, side):
    """A closed ring around a square, counter-clockwise."""
    corner = lambda dx, dy: F.struct((x + dx * side).cast("double").alias("x"), (y + dy * side).cast("double").alias("y"))
    return F.array(F.struct(F.lit(True).alias("outer"), F.array(*[corner(dx, dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]).alias("pts")))


def _nation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return t(spark, sf_dir, "nation").select(key.alias("seq"), F.col("n_name").alias("name"), _square(key % 5, F.floor(key / 5), F.lit(1)).alias("rings"))


@query("""
SELECT c_custkey, coalesce(min(n_name), '') AS nation
FROM (SELECT c_custkey, (c_custkey * 7919 % 6000) / 1000.0 AS x, (c_custkey * 104729 % 6000) / 1000.0 AS y FROM customer) c
LEFT JOIN nation ON x BETWEEN n_nationkey % 5 AND n_nationkey % 5 + 1 AND y BETWEEN n_nationkey // 5 AND n_nationkey // 5 + 1
GROUP BY c_custkey""")
def point_in_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    points = t(spark, sf_dir, "customer").select(key, ((key * 7919 % 6000) / 1000).alias("px"), ((key * 104729 % 6000) / 1000).alias("py"))
    cells = _nation_cells(spark, sf_dir).withColumn("seq", F.col("name"))
    return sp.first_name(points, "c_custkey", cells).withColumnRenamed("name", "nation")


@query("""
WITH b AS (SELECT p_partkey, (37 * p_partkey % 400) / 100.0 AS x, (91 * p_partkey % 400) / 100.0 AS y, 0.25 + p_size / 100.0 AS side FROM part),
o AS (SELECT p_partkey, n_nationkey,
  greatest(0, least(x + side, n_nationkey % 5 + 1) - greatest(x, n_nationkey % 5)) * greatest(0, least(y + side, n_nationkey // 5 + 1) - greatest(y, n_nationkey // 5)) / (side * side) AS ratio
  FROM b CROSS JOIN nation)
SELECT p_partkey, n_nationkey, CAST(floor(ratio * 1000 + 1e-6) AS BIGINT) AS permille FROM o WHERE ratio >= 0.05 - 1e-9""")
def overlap_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    boxes = t(spark, sf_dir, "part").select(key.alias("akey"), _square((key * 37 % 400) / 100, (key * 91 % 400) / 100, 0.25 + F.col("p_size") / 100).alias("rings"))
    cells = _nation_cells(spark, sf_dir).select(F.col("seq").alias("bkey"), "rings")
    found = sp.overlapping(boxes, cells, 0.05 - 1e-9)
    return found.select(F.col("akey").alias("p_partkey"), F.col("bkey").alias("n_nationkey"), F.floor(F.col("ratio") * 1000 + 1e-6).cast("long").alias("permille"))


@query("""
SELECT r_name, n_name, c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""")
def rollup_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = t(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    told = counts.join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return evidence.rollup(told, ["r_name", "n_name", "c_mktsegment"])


@query("""
WITH big AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_totalprice > 490000 GROUP BY o_custkey),
rest AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY o_custkey)
SELECT o_custkey, k AS max_orderkey, 'fresh' AS origin FROM big
UNION ALL SELECT o_custkey, k, 'persisted' FROM rest WHERE o_custkey NOT IN (SELECT o_custkey FROM big)""")
def union_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t(spark, sf_dir, "orders")
    best = lambda df, origin: df.groupBy("o_custkey").agg(F.max("o_orderkey").alias("max_orderkey")).withColumn("origin", F.lit(origin))
    return prefer(best(orders.where("o_totalprice > 490000"), "fresh"), best(orders, "persisted"), "o_custkey")


@query("""
WITH a AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey),
b AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders GROUP BY o_custkey)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
  CASE WHEN a.o_custkey IS NULL THEN 'new' WHEN b.o_custkey IS NULL THEN 'gone' WHEN a.n = b.n AND a.k = b.k THEN 'unchanged' ELSE 'fresh' END AS status
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey""")
def fingerprint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t(spark, sf_dir, "orders")

    def prints(df: DataFrame) -> DataFrame:
        none = [F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified", "md5")]
        return df.groupBy(F.col("o_custkey").alias("metadata_key")).agg(F.count("*").alias("content_length"), F.max("o_orderkey").alias("url")).select("*", *none)

    return changes(prints(orders.where("o_orderdate < timestamp'1998-01-01'")), prints(orders)).withColumnRenamed("metadata_key", "o_custkey")


@query("""
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1)
SELECT year, n, round((n - lag(n) OVER (ORDER BY year)) / CAST(lag(n) OVER (ORDER BY year) AS DOUBLE), 6) AS change FROM y""")
def change_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = t(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    before = years.select((F.col("year") + 1).alias("year"), F.col("n").alias("old"))
    return years.join(before, "year", "left").select("year", "n", F.round(text.change_ratio("n", "old"), 6).alias("change"))


@query("""
WITH m AS (SELECT n_regionkey, count(*) AS old, count(*) FILTER (n_regionkey = 1 OR c_custkey % 10 <> 0) AS new FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey)
SELECT n_regionkey, CASE WHEN (old - new) / CAST(old AS DOUBLE) > 0.1 + 1e-12 THEN 'error' WHEN (old - new) / CAST(old AS DOUBLE) >= 0.05 THEN 'warn' ELSE 'ok' END AS verdict FROM m""")
def gate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    found = told.groupBy("n_regionkey").agg(F.count("*").alias("old"), F.count_if((F.col("n_regionkey") == 1) | (F.col("c_custkey") % 10 != 0)).alias("new"))
    errors, warnings = gates.delta_checks(F.col("new"), F.col("old"), 0.1, 0.2, "customers")
    found = found.withColumn("errors", gates.messages(*errors)).withColumn("warnings", gates.messages(*warnings))
    return found.select("n_regionkey", F.when(F.size("errors") > 0, "error").when(F.size("warnings") > 0, "warn").otherwise("ok").alias("verdict"))


@query("SELECT l_orderkey, count(*) AS n, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS ok FROM lineitem GROUP BY l_orderkey")
def rank_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.contiguous(t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity < 5 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t(spark, sf_dir, "lineitem")
    return evidence.without(lines.where("l_quantity < 5").select("l_partkey").distinct(), lines.where("l_quantity > 45"), "l_partkey")


@query("""
SELECT n_nationkey, unnest(['csv', 'json', 'xml']) AS kind FROM nation
EXCEPT SELECT s_nationkey, ['csv', 'json', 'xml'][s_suppkey % 3 + 1] FROM supplier WHERE s_acctbal > 5000""")
def missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("csv", "json", "xml")])
    expected = t(spark, sf_dir, "nation").select("n_nationkey", F.explode(kinds).alias("kind"))
    expected = expected.select(F.struct("n_nationkey", "kind").alias("pair"))
    there = t(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    there = there.select(F.struct(F.col("s_nationkey").alias("n_nationkey"), F.element_at(kinds, (F.col("s_suppkey") % 3 + 1).cast("int")).alias("kind")).alias("pair"))
    return evidence.without(expected, there, "pair").select("pair.*")


@query("SELECT event_id, TIMESTAMP '2024-01-31' - ts <= INTERVAL 21 DAYS AS usable FROM events")
def age_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", text.within_days("ts", F.expr("timestamp'2024-01-31'"), 21).alias("usable"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1")
def top1_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct(-F.col("value"), "event_id")
    return evidence.first_by(t(spark, sf_dir, "events"), ["user_id"], order, {"event_id": F.col("event_id"), "event_type": F.col("event_type")}).drop("n")


@query("""
SELECT n_name, r_name, CAST(row_number() OVER (ORDER BY CASE r_name WHEN 'EUROPE' THEN 1 WHEN 'ASIA' THEN 2 ELSE 3 END, n_name) AS INTEGER) AS position
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalith.operators.erp import position

    told = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    order = Window.orderBy(position("r_name", ["EUROPE", "ASIA"]), text.fold("n_name"), "n_name")  # a table of nations is a short list
    return told.select("n_name", "r_name", F.row_number().over(order).alias("position"))


@query("SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) AS clean FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").select("doc_id", text.normalize_text("text").alias("clean"))


@query(r"""
WITH p AS (SELECT p_partkey, list_filter(list_transform(string_split_regex(p_name || ', ' || p_type, '\s*(?:,|;|\s+und\s+)\s*|\s+'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM part)
SELECT p_partkey, CAST(i AS INTEGER) AS position, parts[i] AS label FROM p, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)""")
def parse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = text.split_labels(F.concat_ws(", ", "p_name", "p_type"), text.CITY_SEPARATOR + r"|\s+")
    return t(spark, sf_dir, "part").select("p_partkey", F.posexplode(parts).alias("position", "label")).withColumn("position", F.col("position") + 1)


@query(r"""
WITH x AS (SELECT p_partkey, p_name || ' an der ' || p_type AS label FROM part),
c AS (SELECT p_partkey, label, regexp_replace(regexp_extract(label, '^(.{1,24})[ \-/–—]', 1), '^[ \-/–—]+|[ \-/–—]+$', '', 'g') AS cut FROM x)
SELECT p_partkey, CASE WHEN length(label) <= 24 THEN label ELSE regexp_replace(cut, '(?:(?:^|\s+)(?:bei|b\.|an|der|mit|von|zu))+$', '', 'i') END AS label FROM c""")
def fit_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat("p_name", F.lit(" an der "), "p_type")
    return t(spark, sf_dir, "part").select("p_partkey", text.fit(label, 24).alias("label"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def tag_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,string>")
    tags = tag_map(F.transform(F.map_entries(props), lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v"))))
    return t(spark, sf_dir, "events").select("event_id", F.try_element_at(tags, F.lit("k")).cast("int").alias("k"))


@query("SELECT page_id, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS bytes, CAST(greatest(length(html) - length(replace(html, chr(10), '')) - 1, 0) AS INTEGER) AS lines FROM pages")
def artifact_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = t(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return raw.select("page_id", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"), line_count().alias("lines"))


@query("SELECT CASE n_regionkey % 3 WHEN 0 THEN 'fresh' WHEN 1 THEN 'unchanged' ELSE 'failed' END AS name, count(*) AS n FROM nation GROUP BY 1 UNION ALL SELECT 'records', sum(n_nationkey)::BIGINT FROM nation")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from postalith.operators.refresh import summary

    region = F.col("n_regionkey") % 3
    status = F.when(region == 0, "fresh").when(region == 1, "unchanged").otherwise("failed")
    told = t(spark, sf_dir, "nation").select(status.alias("status"), F.col("n_nationkey").alias("records")).collect()  # a run has a few dozen sources
    report = {"sources": [{"status": r["status"]} for r in told], "countries": [{"records": r["records"]} for r in told]}
    return spark.createDataFrame(list(summary(report).items()), "name string, n long")


@query("""
WITH e AS (SELECT n_nationkey % 5 + dx AS x, n_nationkey // 5 + dy AS y FROM nation, (VALUES (0, 0), (1, 0), (1, 1), (0, 1)) AS d(dx, dy))
SELECT n_nationkey, CAST(1 AS DOUBLE) AS area, n_nationkey % 5 + 0.5::DOUBLE AS px, n_nationkey // 5 + 0.5::DOUBLE AS py FROM nation""")
def shape_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = g.with_inner_point(_nation_cells(spark, sf_dir))
    return shapes.select(F.col("seq").alias("n_nationkey"), g.area(F.col("rings")).alias("area"), F.col("p.x").alias("px"), F.col("p.y").alias("py"))


import postalith.plans.engine  # noqa: E402, F401  (registers more)
