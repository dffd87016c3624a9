"""More queries over the driver's tables: they turn rows into map objects, records, files and baselines and run the engine on them."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalith.functions import geometry as g
from postalith.functions import text
from postalith.operators import contracts, erp, evidence, extract, gates, publish, records
from postalith.operators import spatial as sp
from postalith.plans.config import COUNTRIES, STATES, TIME_ZONE
from postalith.plans.queries import _PLACES, _square, places, query, t
from postalith.plans.schema import FIELDS
from postalith.sources import post_codes as pc
from postalith.store import shared_dir

DE = COUNTRIES["DE"]
SOURCE = next(s for s in DE.sources if s.name == "brandenburg")
_STATES = ", ".join(f"('{code}', '{name}', {i})" for i, (code, name) in enumerate(STATES["DE"].items()))


def _tags(**values: Column) -> Column:
    """A map of the values that are not null; __ stands for a colon."""
    pairs = F.array(*[F.struct(F.lit(k.replace("__", ":")), v.cast("string").alias("v")) for k, v in values.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = t(spark, sf_dir, "customer").join(F.broadcast(t(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return told.withColumn("k", F.col("c_custkey"))


def _code(base: int = 0) -> Column:
    return F.lpad((F.col("k") % 90000 + base).cast("string"), 5, "0")


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer as a boundary of some sort or an address, by its key's last digit."""
    k, at = F.col("k"), F.col("k") % 10
    admin = at.isin(0, 1, 2)
    code = F.when(k % 40 == 23, "12").otherwise(_code())
    two = F.concat(_code(), F.lit(" "), "n_name", F.when(k % 2 == 0, " und ").otherwise(", "), "c_mktsegment")
    tags = _tags(
        boundary=F.when(admin, "administrative").when(at == 3, "postal_code"), admin_level=F.when(at == 0, "2").when(at == 1, "4").when(at == 2, "6"),
        ISO3166__dash1=F.when(at == 0, F.when(k % 20 == 0, "DE").otherwise("AT")),
        ISO3166__dash2=F.when(k % 30 == 1, "DE-BY").when(k % 30 == 11, " de-xx").when(k % 30 == 21, "AT-1").when(at == 5, "de-by "),
        country=F.when(k % 20 == 12, "FR"), postal_code=F.when(at == 3, code), postal_code_level=F.when(k % 20 == 13, "9"),
        note=F.when((at == 3) & (k % 3 == 0), F.concat(two, F.lit(" (old)"))).when((at == 3) & (k % 3 == 1), F.col("n_name")),
        name=F.when((at == 3) & (k % 3 == 1), two).otherwise(F.concat(F.lit(" "), "n_name", F.lit("  "))),
        addr__postcode=F.when(at.isin(4, 5, 6), F.when(k % 50 == 6, "ABC").otherwise(_code())),
        addr__city=F.when(at.isin(4, 5, 6) & (k % 50 != 4), F.concat(F.lit("  "), "n_name", F.lit(" \t"), "c_mktsegment")), addr__country=F.when(k % 20 == 15, "CH"),
    )
    tags = F.transform_keys(tags, lambda name, _: F.replace(name, F.lit(":dash"), F.lit("-")))
    return _customers(spark, sf_dir).select("k", F.when(k % 7 != 3, "area").otherwise("node").alias("kind"), tags.alias("tags"))


_OBJECTS = "o AS (SELECT c_custkey AS k, n_name, c_mktsegment AS seg, c_custkey % 7 <> 3 AS area, lpad(CAST(c_custkey % 90000 AS VARCHAR), 5, '0') AS code FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"""
WITH {_OBJECTS}
SELECT k AS c_custkey, CASE WHEN area AND k % 20 = 0 THEN 'country' WHEN area AND k % 30 = 1 THEN 'state' WHEN area AND k % 30 = 11 THEN 'unknown_state' WHEN area AND k % 20 = 2 THEN 'county'
         WHEN area AND k % 20 = 3 THEN 'postal' WHEN k % 10 IN (4, 5, 6) THEN 'address' ELSE '' END AS kinds,
       CASE k % 30 WHEN 1 THEN 'DE-BY' WHEN 11 THEN 'DE-XX' ELSE '' END AS state_code, CASE WHEN k % 10 = 3 AND k % 3 = 1 THEN code || ' ' || n_name || CASE WHEN k % 2 = 0 THEN ' und ' ELSE ', ' END || seg ELSE n_name END AS name FROM o""")
def classify_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects by kind."""
    return extract.classify(_objects(spark, sf_dir), DE).select(F.col("k").alias("c_custkey"), F.array_join("kinds", ",").alias("kinds"), "state_code", "name")


@query(f"""
WITH {_OBJECTS}, p AS (SELECT k, CASE WHEN k % 40 = 23 THEN '' ELSE code END AS code, CASE WHEN k % 40 = 23 OR k % 3 = 2 THEN '' ELSE n_name || '|' || seg END AS cities FROM o WHERE area AND k % 20 = 3)
SELECT k AS c_custkey, code, cities, code <> '' AND cities <> '' AS ok FROM p""")
def postal_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postal areas with the cities that their labels name."""
    found = extract.postal_candidates(extract.classify(_objects(spark, sf_dir), DE), DE)
    return found.select(F.col("k").alias("c_custkey"), "code", F.array_join("cities", "|").alias("cities"), "ok")


@query(f"""
WITH {_OBJECTS}, a AS (SELECT k, CASE WHEN k % 50 = 6 THEN '' ELSE code END AS code, CASE WHEN k % 50 = 4 THEN '' ELSE n_name || ' ' || seg END AS city, CASE WHEN k % 10 = 5 THEN 'DE-BY' ELSE '' END AS state_code FROM o WHERE k % 10 IN (4, 5, 6))
SELECT k AS c_custkey, code, city, state_code, code <> '' AND city <> '' AND k % 20 <> 15 AS ok FROM a""")
def address_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address objects with code, city and state tag."""
    found = extract.address_candidates(extract.classify(_objects(spark, sf_dir), DE), DE)
    return found.select(F.col("k").alias("c_custkey"), "code", "city", "state_code", "ok")


@query("""
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 3 THEN false WHEN 4 THEN false ELSE c_custkey % 4 = 1 END AS agrees FROM customer""")
def tag_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a state tag is empty, the source's own, or that of a state that touches."""
    k = F.col("c_custkey")
    code = F.element_at(F.array(*[F.lit(x) for x in ("", "DE-BB", "DE-BE", "DE-BY", "XX", "DE-BE")]), (k % 6 + 1).cast("int"))
    rows = t(spark, sf_dir, "customer").select(k, code.alias("state_code"))
    touching = rows.where(k % 4 == 1).select(k, F.explode(F.array(F.lit("DE-BE"), F.lit("DE-BY"), F.lit("DE-BE"))).alias("state_code"))
    return extract.tag_agrees(rows, "c_custkey", touching, DE, SOURCE).select("c_custkey", "agrees")


@query("""
WITH o AS (SELECT o_orderkey AS seq, o_custkey % 200 AS code, o_orderpriority AS city, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey / 8.0 END AS px FROM orders),
f AS (SELECT *, first_value(s) OVER (PARTITION BY code, city ORDER BY seq) AS first FROM o)
SELECT code, city, first AS state_code, count(*) AS n, CAST(min_by(px, seq) FILTER (px IS NOT NULL) AS DOUBLE) AS px FROM f WHERE s = first GROUP BY code, city, first""")
def address_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of a code and city that agree with the first one's state tag, and the first point."""
    key = F.col("o_orderkey")
    rows = t(spark, sf_dir, "orders").select(
        key.alias("seq"), (F.col("o_custkey") % 200).alias("code"), F.col("o_orderpriority").alias("city"), F.col("o_orderstatus").alias("state_code"),
        F.when(key % 3 == 0, key / 8).alias("px"), F.when(key % 3 == 0, F.lit(1.0)).alias("py"),
    )
    return evidence.addresses(rows)[0].select("code", "city", "state_code", "n", "px")


@query("""
WITH e AS (SELECT n_nationkey AS code, c_mktsegment AS city, r_name AS state, 's' || c_custkey % 3 AS county, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
b AS (SELECT n_nationkey AS code, unnest(['BUILDING', 'MACHINERY', 'NOWHERE']) AS city, CASE n_nationkey % 5 WHEN 0 THEN [] ELSE [r_name, 'X'] END AS states, CASE n_nationkey % 4 WHEN 0 THEN [] WHEN 1 THEN ['s9'] ELSE ['s0', 's9'] END AS counties
      FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT code, city, list(DISTINCT state) AS es FROM e GROUP BY ALL),
x AS (SELECT b.*, unnest(CASE WHEN len(states) = 0 THEN [''] WHEN len(list_intersect(states, es)) > 0 THEN list_intersect(states, es) WHEN len(list_filter(es, lambda z: z <> '')) > 0 THEN es ELSE states END) AS state FROM b LEFT JOIN s USING (code, city)),
c AS (SELECT code, city, state, list(DISTINCT county) AS ec FROM e GROUP BY ALL),
y AS (SELECT x.*, unnest(CASE WHEN len(counties) = 0 THEN [''] WHEN len(list_intersect(counties, ec)) > 0 THEN list_intersect(counties, ec) WHEN len(list_filter(ec, lambda z: z <> '')) > 0 THEN ec ELSE counties END) AS county FROM x LEFT JOIN c USING (code, city, state))
SELECT code, city, state, county, CAST(coalesce((SELECT sum(n) FROM e WHERE e.code = y.code AND e.city = y.city AND (y.state = '' AND y.county = '' OR e.state = y.state AND (y.county = '' OR e.county = y.county))), 0) AS BIGINT) AS n FROM y""")
def expand_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries as a row for each city, state and county, chosen by evidence."""
    k = F.col("n_nationkey")
    nations = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    areas = nations.select(
        k.alias("code"), names("BUILDING", "MACHINERY", "NOWHERE").alias("cities"), F.when(k % 5 == 0, names()).otherwise(F.array("r_name", F.lit("X"))).alias("states"),
        F.when(k % 4 == 0, names()).when(k % 4 == 1, names("s9")).otherwise(names("s0", "s9")).alias("counties"),
    )
    seen = t(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == k)
    seen = seen.groupBy(k.alias("code"), F.col("c_mktsegment").alias("city"), F.col("r_name").alias("state"), F.concat(F.lit("s"), F.col("c_custkey") % 3).alias("county")).agg(F.count("*").alias("n"))
    return evidence.expand(areas, seen).select("code", "city", "state", "county", "n")


def _box(x: float, y: float, wide: float, high: float) -> Column:
    points = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((x, y), (x + wide, y), (x + wide, y + high), (x, y + high), (x, y))])
    return F.array(F.struct(F.lit(True).alias("outer"), points.alias("pts")))


def _world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country of 25 postal areas in two states and five counties, and the customers as addresses in it."""
    nations = t(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey"))
    k = F.col("k")
    none = F.lit(None).cast("double")
    one = spark.range(1)
    area = lambda seq, rings, **tags: one.select(F.lit(seq).alias("seq"), F.lit("area").alias("kind"), _tags(**{n: F.lit(v) for n, v in tags.items()}).alias("tags"), rings.alias("rings"), none.alias("px"), none.alias("py"))
    admin = {"boundary": "administrative"}
    found = area(1, _box(0, 0, 5, 5), admin_level="2", **{"ISO3166-1": "DE"}, **admin)
    found = found.union(area(2, _box(0, 0, 2, 5), admin_level="4", **{"ISO3166-2": "DE-BB"}, **admin)).union(area(3, _box(2, 0, 2, 5), admin_level="4", **{"ISO3166-2": "DE-BE"}, **admin))
    for i in range(5):
        found = found.union(area(10 + i, _box(0, i, 5, 1), admin_level="6", name=f"County {i}", **admin))
    code = (k + 10000).cast("string")
    cells = nations.select(
        (k + 100).alias("seq"), F.lit("area").alias("kind"), _tags(boundary=F.lit("postal_code"), postal_code=code, note=F.concat(code, F.lit(" "), "n_name")).alias("tags"),
        _square(k % 5, F.floor(k / 5), F.lit(1)).alias("rings"), (k % 5 + 0.5).alias("px"), (F.floor(k / 5) + 0.5).alias("py"),
    )
    c, n = F.col("k"), F.col("n_nationkey")
    points = _customers(spark, sf_dir).select(
        (c + 1000).alias("seq"), F.lit("node").alias("kind"),
        _tags(addr__postcode=F.when(c % 5 == 0, n + 20000).otherwise(n + 10000), addr__city=F.col("n_name"), addr__country=F.when(c % 50 == 7, "CH")).alias("tags"),
        F.array().cast(g.RINGS).alias("rings"), (n % 5 + 0.25 + c % 2 * 0.5).alias("px"), (F.floor(n / 5) + 0.25 + c % 3 * 0.2).alias("py"),
    )
    order = ["seq", "kind", "tags", "rings", "px", "py"]
    same = lambda df: df.select(F.col("seq").cast("long"), "kind", "tags", F.col("rings").cast(g.RINGS), F.col("px").cast("double"), F.col("py").cast("double")).select(*order)
    return same(found).union(same(cells)).union(same(points))


@query("""
WITH cell AS (SELECT n_nationkey AS k, n_name AS city, CASE WHEN n_nationkey % 5 IN (2, 3) THEN 'Berlin' ELSE 'Brandenburg' END AS state, 'County ' || n_nationkey // 5 AS county FROM nation),
a AS (SELECT c_nationkey AS k, c_custkey % 5 = 0 AS other, count(*) AS n FROM customer WHERE c_custkey % 50 <> 7 GROUP BY ALL),
r AS (SELECT CAST(10000 + cell.k AS VARCHAR) AS code, city, state, county, 'postal_boundary' AS source, CAST(coalesce(n, 0) AS INTEGER) AS evidence_count FROM cell LEFT JOIN a ON a.k = cell.k AND NOT other
      UNION ALL SELECT CAST(20000 + cell.k AS VARCHAR), city, state, county, 'address_fallback', CAST(n AS INTEGER) FROM cell JOIN a ON a.k = cell.k AND other AND n >= 3)
SELECT *, CAST(1 AS INTEGER) AS location_rank, true AS is_primary_location,
  CAST(row_number() OVER (PARTITION BY state, county, city ORDER BY evidence_count DESC, source DESC, code) AS INTEGER) AS postal_code_rank FROM r""")
def extract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole extraction: classification, spatial and address evidence, inference, fallback and ranks."""
    found = extract.extract(_world(spark, sf_dir), DE, SOURCE).records
    return found.select("code", "city", "state", "county", "source", "evidence_count", "location_rank", "is_primary_location", "postal_code_rank")


@query("""
WITH a AS (SELECT c_nationkey AS k, c_custkey % 5 = 0 AS other, count(*) AS n FROM customer WHERE c_custkey % 50 <> 7 GROUP BY ALL)
SELECT 'addresses' AS counter, CAST(sum(n) AS BIGINT) AS n FROM a UNION ALL SELECT 'dropped', count(*) FROM customer WHERE c_custkey % 50 = 7 UNION ALL SELECT 'boundaries', count(*) FROM nation
UNION ALL SELECT 'inferred', (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 4) + (SELECT count(*) FROM a WHERE k % 5 = 4 AND other AND n >= 3) UNION ALL SELECT 'DE-BB', 1 UNION ALL SELECT 'DE-BE', 1""")
def extract_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the extraction counts, and the state codes it saw."""
    found = extract.extract(_world(spark, sf_dir), DE, SOURCE)
    rows = [("boundaries", found.postal_boundary_count), ("addresses", found.address_candidate_count), ("dropped", found.dropped_candidate_count), ("inferred", found.inferred_state_records)]
    return spark.createDataFrame(rows + [(s, 1) for s in found.observed_state_codes], "counter string, n long")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 AND c_custkey % 3 <> 0 THEN 'Brandenburg' WHEN c_custkey % 7 = 0 THEN '' ELSE n_name END AS state, c_custkey % 7 = 0 AND c_custkey % 3 <> 0 AS inferred
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def impute_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty states that may be inferred become the source's own."""
    k = F.col("c_custkey")
    told = _customers(spark, sf_dir).select(k, F.when(k % 7 == 0, "").otherwise(F.col("n_name")).alias("state"), (k % 3 != 0).alias("may_infer"))
    return extract.filled(told, extract.inference_state(DE, SOURCE, {"DE-BE"})).select("c_custkey", "state", "inferred")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as text, with one fault or another by the key."""
    k = F.col("k")
    country = F.when(k % 41 == 0, "xx").when(k % 4 == 1, "at").when(k % 4 == 2, "DE").otherwise("de")
    code = F.when(k % 17 == 0, "12a").when(k % 4 == 1, F.lpad((k % 9000).cast("string"), 4, "1")).otherwise(_code())
    return _customers(spark, sf_dir).select(
        "k", code.alias("code"), F.when(k % 19 == 0, "  ").otherwise(F.concat(F.lit(" "), "n_name", F.lit("  "), "c_mktsegment")).alias("city"), country.alias("country"), F.col("n_name").alias("state"), F.lit("").alias("county"),
        F.when(k % 23 == 0, "UTC").otherwise(TIME_ZONE).alias("time_zone"), F.when(k % 31 == 0, "maybe").otherwise("TRUE").alias("is_primary_location"), F.when(k % 37 == 0, "-1").otherwise("1").alias("location_rank"),
        F.when(k % 43 == 0, "x").otherwise("2").alias("postal_code_rank"), F.when(k % 29 == 0, "osm").otherwise("postal_boundary").alias("source"), F.lit("7").alias("evidence_count"),
    )


_FAULTS = """concat_ws('; ', CASE WHEN c_custkey % 41 = 0 THEN 'unknown country' END, CASE WHEN c_custkey % 41 <> 0 AND c_custkey % 17 = 0 THEN 'invalid code' END, CASE WHEN c_custkey % 19 = 0 THEN 'empty city' END,
  CASE WHEN c_custkey % 23 = 0 THEN 'unexpected time zone' END, CASE WHEN c_custkey % 29 = 0 THEN 'unknown source' END, CASE WHEN c_custkey % 31 = 0 THEN 'is_primary_location is not a boolean' END,
  CASE WHEN c_custkey % 37 = 0 THEN 'location_rank is not a count' END, CASE WHEN c_custkey % 43 = 0 THEN 'postal_code_rank is not a count' END)"""


@query(f"""
SELECT c_custkey, CASE WHEN c_custkey % 19 = 0 THEN '' ELSE n_name || ' ' || c_mktsegment END AS city, CASE WHEN c_custkey % 41 = 0 THEN 'xx' WHEN c_custkey % 4 = 1 THEN 'AT' ELSE 'DE' END AS country,
  CASE WHEN c_custkey % 37 = 0 THEN -1 ELSE 1 END::INTEGER AS location_rank, {_FAULTS} AS errors
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records, with what is wrong with them."""
    raw = _raw(spark, sf_dir).withColumn("county", F.col("k").cast("string"))
    found = records.normalize(raw, strict=False)
    return found.select(F.col("county").cast("long").alias("c_custkey"), "city", "country", F.coalesce("location_rank", F.lit(-1)).alias("location_rank"), F.array_join("errors", "; ").alias("errors"))


@query(f"SELECT 'raw.csv:' || c_custkey || ': ' || unnest(string_split(f, '; ')) AS message FROM (SELECT c_custkey, {_FAULTS.replace(chr(10), ' ')} AS f FROM customer) WHERE f <> '' AND c_custkey % 41 <> 0")
def row_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for every fault of every row."""
    raw = _raw(spark, sf_dir).where("country <> 'xx'").withColumn("country", F.upper("country"))
    return contracts.row_errors(raw, "raw.csv", "k")


def _stated(spark: SparkSession, sf_dir: str, states: int) -> DataFrame:
    """Customers as records of the first so many states, and some without one or of no known one."""
    k = F.col("k")
    names = F.array(*[F.lit(x) for x in STATES["DE"].values()])
    state = F.when(k % 97 == 0, "").when(k % 89 == 0, "Atlantis").otherwise(F.element_at(names, (k % states + 1).cast("int")))
    return _customers(spark, sf_dir).select(_code().alias("code"), F.when(k % 101 == 0, "AT").otherwise("DE").alias("country"), state.alias("state"))


def _stated_sql(states: int) -> str:
    return f"""v(state_code, name, i) AS (VALUES {_STATES}), r AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN '' WHEN c_custkey % 89 = 0 THEN 'Atlantis' ELSE name END AS state, c_custkey % 101 = 0 AS other, c_custkey % 90000 AS code
  FROM customer JOIN v ON i = c_custkey % {states})"""


@query(f"""
WITH {_stated_sql(16)}
SELECT v.state_code, (SELECT count(*) FROM r WHERE state = v.name) AS n, (SELECT count(*) FROM r) AS records, (SELECT count(DISTINCT code) FROM r) AS codes, (SELECT count(*) FROM r WHERE state = '') AS empty_states,
  (SELECT count(*) FROM r WHERE other) AS wrong_country, CASE WHEN (SELECT count(*) FROM r WHERE state = 'Atlantis') > 0 THEN 'Atlantis' ELSE '' END AS unknown_states FROM v""")
def record_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a record set: a row for each state of the country."""
    found = gates.metrics(_stated(spark, sf_dir, 16), DE)
    return found.select(F.explode("state_counts").alias("state_code", "n"), "records", "codes", "empty_states", "wrong_country", F.array_join("unknown_states", ",").alias("unknown_states"))


def _gate_sql(states: int, kept: str, checks: str, limits: tuple[float, float, float]) -> str:
    """Messages of a gate over the records of the kept customers, all of them being the baseline."""
    loss, code_loss, _ = limits
    delta = lambda what, most: f"""CASE WHEN 1 - {what} / CAST(old_{what} AS DOUBLE) > {most} THEN '{what} loss of ' || printf('%.1f%%', 100 - 100 * {what} / CAST(old_{what} AS DOUBLE)) || ' exceeds {most:.0%}' END"""
    warn = lambda what, most: f"""CASE WHEN 1 - {what} / CAST(old_{what} AS DOUBLE) <= {most} AND 1 - {what} / CAST(old_{what} AS DOUBLE) >= {most / 2} THEN '{what} loss of ' || printf('%.1f%%', 100 - 100 * {what} / CAST(old_{what} AS DOUBLE)) || ' is at least half of {most:.0%}' END"""
    return f"""
WITH {_stated_sql(states)}, n AS (SELECT *, row_number() OVER () AS dummy FROM r),
m AS (SELECT count(*) FILTER ({kept}) AS records, count(DISTINCT code) FILTER ({kept}) AS codes, count(*) FILTER (state = '' AND {kept}) AS empty, count(*) FILTER (state = 'Atlantis' AND {kept}) AS odd, count(*) FILTER (other AND {kept}) AS wrong,
  count(*) AS old_records, count(DISTINCT code) AS old_codes FROM r)
SELECT concat_ws(' | ', CASE WHEN empty > 0 THEN empty || ' records have no state' END, CASE WHEN odd > 0 THEN 'unknown states: Atlantis' END, CASE WHEN wrong > 0 THEN wrong || ' records are of another country' END,
  {checks}, {delta('records', loss)}, {delta('codes', code_loss)}) AS errors, concat_ws(' | ', {{warnings}}{warn('records', loss)}, {warn('codes', code_loss)}) AS warnings, records, false AS valid FROM m"""


@query(_gate_sql(3, "code % 9 <> 0", "'unexpected states: DE-BW, DE-BY', 'missing required states: ' || 'DE-BB', 'no record of the primary state DE-BB'".replace("'missing required states: ' || 'DE-BB', ", ""), (0.15, 0.12, 0.25)).replace("{warnings}", ""))
def source_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's candidate against its states and its baseline."""
    rows = _stated(spark, sf_dir, 3)
    judged = gates.source_gate(gates.metrics(rows.where("cast(code as int) % 9 <> 0"), DE), DE, SOURCE, gates.metrics(rows, DE))
    return judged.select(F.array_join("errors", " | ").alias("errors"), F.array_join("warnings", " | ").alias("warnings"), "records", "valid")


_MISSING = ", ".join(code for i, code in enumerate(STATES["DE"]) if i >= 12 or i % 4 == 0)


@query(_gate_sql(12, "code % 4 <> 0", f"'missing states: {_MISSING}', CASE WHEN records < 8000 THEN 'records of ' || records || ' is below 8000' END, CASE WHEN codes < 7800 THEN 'codes of ' || codes || ' is below 7800' END", (0.10, 0.05, 0.20))
       .replace("{warnings}", "CASE WHEN records >= 8000 AND records <= 8400 THEN 'records of ' || records || ' is within 5% of the floor 8000' END, CASE WHEN codes >= 7800 AND codes <= 8190 THEN 'codes of ' || codes || ' is within 5% of the floor 7800' END, "))
def country_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country's records against its states, floors and baseline."""
    rows = _stated(spark, sf_dir, 12)
    judged = gates.country_gate(gates.metrics(rows.where("cast(code as int) % 4 <> 0"), DE), DE, gates.metrics(rows, DE))
    return judged.select(F.array_join("errors", " | ").alias("errors"), F.array_join("warnings", " | ").alias("warnings"), "records", "valid")


@query(f"""
WITH p AS ({_PLACES}), r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) AS rank FROM p),
c AS (SELECT code, CAST(code AS INTEGER) AS k, max(rank) AS n FROM r GROUP BY code)
SELECT 'DE ' || code || ': one primary location of rank 1 is expected' AS message FROM c WHERE k % 7 = 5 OR k % 7 = 3
UNION ALL SELECT 'DE ' || code || ': location ranks are not 1 to n' FROM c WHERE k % 7 = 3
UNION ALL SELECT concat_ws(' ', country, lower(state), lower(county), lower(city)) || ': postal code ranks are not 1 to n' FROM p WHERE CAST(code AS INTEGER) % 11 = 4""")
def rank_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes without one primary location, and codes and places whose ranks have gaps."""
    k = F.col("code").cast("int")
    found = records.dedupe(places(spark, sf_dir))
    found = found.withColumn("location_rank", F.col("location_rank") + F.when(k % 7 == 3, 1).otherwise(0)).withColumn("postal_code_rank", F.col("postal_code_rank") + F.when(k % 11 == 4, 1).otherwise(0))
    return contracts.rank_errors(found.withColumn("is_primary_location", (F.col("location_rank") == 1) & (k % 7 != 5)))


@query("""
WITH s AS (SELECT s_suppkey AS k FROM supplier)
SELECT 's' || k AS metadata_key, unnest(list_filter([CASE WHEN k % 10 = 0 THEN 'missing' END, CASE WHEN k % 10 = 1 THEN 'not configured' END, CASE WHEN k % 10 = 2 THEN 'unexpected url' END, CASE WHEN k % 10 = 3 THEN 'content length is not positive' END,
  CASE WHEN k % 10 = 4 THEN 'invalid md5' END, CASE WHEN k % 10 = 5 THEN 'accepted after verified' END, CASE WHEN k % 10 = 6 THEN 'invalid verified_at' END, CASE WHEN k % 10 = 7 THEN 'more codes than records' END,
  CASE WHEN k % 10 = 8 THEN 'unexpected state codes' END], lambda x: x IS NOT NULL)) AS message FROM s""")
def metadata_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source metadata against what is configured."""
    k = F.col("s_suppkey")
    at = k % 10
    base = t(spark, sf_dir, "supplier").select(k, F.concat(F.lit("s"), k).alias("metadata_key"))
    expected = base.where(at != 1).select("metadata_key", F.concat(F.lit("u"), k).alias("url"), F.array(F.lit("DE-BB"), F.lit("DE-BE")).alias("state_codes"))
    table = base.where(at != 0).select(
        "metadata_key", F.concat(F.when(at == 2, "v").otherwise("u"), k).alias("url"), F.when(at == 3, 0).otherwise(5).cast("long").alias("content_length"),
        F.when(at == 4, "xyz").otherwise(F.md5(k.cast("string"))).alias("md5"), F.when(at == 5, "2024-03-01T00:00:00Z").otherwise("2024-02-01T00:00:00Z").alias("accepted_at"),
        F.when(at == 6, "2024-02-02").otherwise("2024-02-02T00:00:00Z").alias("verified_at"), F.lit(10).alias("record_count"), F.when(at == 7, 11).otherwise(9).alias("unique_post_code_count"),
        F.when(at == 8, F.array(F.lit("DE-BB"))).otherwise(F.array(F.lit("DE-BE"), F.lit("DE-BB"))).alias("state_codes"),
    )
    return contracts.metadata_errors(table, expected)


@query("""
SELECT 'p' || page_id AS path, CASE page_id % 10 WHEN 0 THEN 'size differs' WHEN 1 THEN 'digest differs' WHEN 2 THEN 'file is missing' ELSE 'file is not in the manifest' END AS message FROM pages WHERE page_id % 10 < 4""")
def artifact_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest against its files, both ways."""
    at = F.col("page_id") % 10
    base = t(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), "page_id").alias("path"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("content"))
    manifest = base.where(at != 3).select("path", (F.length("content") + F.when(at == 0, 1).otherwise(0)).cast("long").alias("bytes"), F.when(at == 1, "x").otherwise(F.sha2("content", 256)).alias("sha256"))
    return contracts.artifact_errors(manifest, base.where(at != 2).select("path", "content"))


@query("""
WITH p AS (SELECT page_id AS k, CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.json' WHEN 2 THEN '.xml' ELSE '.txt' END AS ext, CASE page_id % 4 WHEN 0 THEN 'a' || chr(10) || repeat('é,b' || chr(10), CAST(page_id % 5 AS INTEGER)) WHEN 1 THEN
  '{"records": [' || array_to_string(list_transform(range(page_id % 6), lambda x: '{}'), ', ') || ']}' WHEN 2 THEN repeat('<record>', CAST(page_id % 7 AS INTEGER)) ELSE 'x' END AS body FROM pages)
SELECT k || ext AS path, CAST(strlen(body) AS BIGINT) AS bytes, sha256(body) AS sha256, CAST(length(body) - length(replace(body, chr(10), '')) AS BIGINT) AS lines,
  CAST(CASE k % 4 WHEN 0 THEN k % 5 WHEN 1 THEN k % 6 WHEN 2 THEN k % 7 ELSE 0 END AS BIGINT) AS records FROM p""")
def describe_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, digests, lines and records of files."""
    k = F.col("page_id")
    kind = F.when(k % 4 == 0, ".csv").when(k % 4 == 1, ".json").when(k % 4 == 2, ".xml").otherwise(".txt")
    empty = F.array_join(F.array_repeat(F.lit("{}"), (k % 6).cast("int")), ", ")
    body = (
        F.when(k % 4 == 0, F.concat(F.lit("a\n"), F.repeat(F.lit("é,b\n"), (k % 5).cast("int")))).when(k % 4 == 1, F.concat(F.lit('{"records": ['), empty, F.lit("]}")))
        .when(k % 4 == 2, F.repeat(F.lit("<record>"), (k % 7).cast("int"))).otherwise("x")
    )
    return publish.describe(t(spark, sf_dir, "pages").select(F.concat(k, kind).alias("path"), F.encode(body, "UTF-8").alias("content")))


@query("""
SELECT p_partkey, replace(lower(p_name || ' STRASSE Straße'), 'ß', 'ss') AS folded, CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS told, p_size % 2 = 0 AS parsed, CASE WHEN p_size % 3 = 0 THEN -1 ELSE CAST(p_size AS INTEGER) END AS size,
  md5(p_name) AS checksum, 'x' || p_size AS shown, CASE WHEN p_size % 5 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 10:00:00' + to_days(CAST(p_size AS INTEGER)) END AS at, '2024-01-01T00:00:00Z' AS stamp FROM part""")
def scalar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, numbers, times and checksums as the engine reads and writes them."""
    size = F.col("p_size")
    even = text.format_bool(size % 2 == 0)
    at = F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), size.cast("int")), "yyyy-MM-dd"), F.when(size % 5 == 0, "T10:00:00").otherwise("T12:00:00+02:00"))
    return t(spark, sf_dir, "part").select(
        "p_partkey", text.fold(F.concat("p_name", F.lit(" STRASSE Straße"))).alias("folded"), even.alias("told"), text.parse_bool(F.concat(F.lit(" "), F.upper(even), F.lit(" "))).alias("parsed"),
        F.coalesce(text.parse_count(F.concat(F.when(size % 3 == 0, "-").otherwise(""), size)), F.lit(-1)).alias("size"), text.md5_of(F.concat(F.upper(F.md5("p_name")), F.lit("  part.pbf"))).alias("checksum"),
        text.strip_fillers(F.concat(F.lit("x"), size, F.lit(" an  der"))).alias("shown"), text.parse_iso(at).cast("timestamp_ntz").alias("at"), text.iso(F.lit("2024-01-01").cast("timestamp")).alias("stamp"),
    )


@query(f"""
WITH p AS ({_PLACES}), r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) AS rank FROM p)
SELECT code AS "Code", city AS "Ort", upper(city) AS "Suchbegriff (Ort)", 'DE' AS "Länder-/Regionscode", state AS "Bundesregion", '{TIME_ZONE}' AS "Zeitzone" FROM r WHERE rank = 1""")
def erp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary locations as rows of the workbook."""
    return erp.rows(records.dedupe(places(spark, sf_dir)), ["DE", "AT", "CH"])


@query("SELECT c_mktsegment AS \"Code\", CAST(c_nationkey AS VARCHAR) AS \"Ort\", count(*) AS n FROM customer GROUP BY ALL HAVING count(*) > 1")
def erp_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the workbook that come more than once."""
    return erp.check_keys(t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("Code"), F.col("c_nationkey").cast("string").alias("Ort")))


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as square frames of side 2 around a square hole of side 1."""
    k = F.col("n_nationkey")
    ring = lambda x, y, side, outer: F.struct(F.lit(outer).alias("outer"), _square(x, y, F.lit(side))[0]["pts"].alias("pts"))
    x, y = k % 5 * 2, F.floor(k / 5) * 2
    return t(spark, sf_dir, "nation").select(k.alias("seq"), "n_name", F.array(ring(x, y, 2, True), ring(x + 0.5, y + 0.5, 1, False)).alias("rings"))


_AT = "(SELECT c_custkey, (c_custkey * 7919 % 1100) / 100.0 AS x, (c_custkey * 104729 % 1100) / 100.0 AS y FROM customer)"
_IN = "x BETWEEN n_nationkey % 5 * 2 AND n_nationkey % 5 * 2 + 2 AND y BETWEEN n_nationkey // 5 * 2 AND n_nationkey // 5 * 2 + 2"
_HOLE = "x > n_nationkey % 5 * 2 + 0.5 AND x < n_nationkey % 5 * 2 + 1.5 AND y > n_nationkey // 5 * 2 + 0.5 AND y < n_nationkey // 5 * 2 + 1.5"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, sf_dir, "customer").select(k, (k * 7919 % 1100 / 100).alias("px"), (k * 104729 % 1100 / 100).alias("py"))


@query(f"SELECT c_custkey, n_nationkey FROM {_AT} JOIN nation ON {_IN} AND NOT ({_HOLE})")
def cover_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and the shapes that cover them: borders count, holes do not."""
    shapes = _framed(spark, sf_dir).select(F.col("seq").alias("n_nationkey"), "rings")
    return sp.covering(_points(spark, sf_dir), shapes).select("c_custkey", "n_nationkey")


@query(f"SELECT DISTINCT c_custkey FROM {_AT} JOIN nation ON {_IN} AND NOT ({_HOLE})")
def covered_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that any shape covers."""
    return sp.any_covers(_points(spark, sf_dir), "c_custkey", _framed(spark, sf_dir))


@query("""
WITH b AS (SELECT p_partkey, (37 * p_partkey % 1000) / 100.0 AS x, (91 * p_partkey % 1000) / 100.0 AS y, 0.25 + p_size % 4 / 8.0 AS side FROM part)
SELECT p_partkey, n_nationkey FROM b JOIN nation ON x <= n_nationkey % 5 * 2 + 2 AND x + side >= n_nationkey % 5 * 2 AND y <= n_nationkey // 5 * 2 + 2 AND y + side >= n_nationkey // 5 * 2
WHERE NOT (x > n_nationkey % 5 * 2 + 0.5 AND x + side < n_nationkey % 5 * 2 + 1.5 AND y > n_nationkey // 5 * 2 + 0.5 AND y + side < n_nationkey // 5 * 2 + 1.5)""")
def shapes_that_meet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of shapes that share a point."""
    k = F.col("p_partkey")
    boxes = t(spark, sf_dir, "part").select(k.alias("akey"), _square(k * 37 % 1000 / 100, k * 91 % 1000 / 100, 0.25 + F.col("p_size") % 4 / 8).alias("rings"))
    found = sp.intersecting(boxes, _framed(spark, sf_dir).select(F.col("seq").alias("bkey"), "rings"))
    return found.select(F.col("akey").alias("p_partkey"), F.col("bkey").alias("n_nationkey"))


@query("SELECT n_nationkey, 3::DOUBLE AS area, true AS inside FROM nation")
def framed_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of shapes with holes, and whether their inner point is covered."""
    shapes = g.with_inner_point(_framed(spark, sf_dir))
    inside = g.covers(g.edge_array(F.col("rings")), F.col("p.x"), F.col("p.y"))
    return shapes.select(F.col("seq").alias("n_nationkey"), g.area(F.col("rings")).alias("area"), inside.alias("inside"))


def _folder(spark: SparkSession) -> Path:
    """A folder for files that the driver writes; sinks of one file need one that it sees as files."""
    root = shared_dir(spark)
    if not root.startswith("file:") and not root.startswith("/"):
        raise ValueError(f"{root} is no folder of files")
    return Path("/" + root.removeprefix("file:").lstrip("/")) / f"sink-{uuid.uuid4().hex}"


_RANKED = f"""
WITH p AS ({_PLACES})
SELECT code, city, country, state, county, '{TIME_ZONE}' AS time_zone,
       row_number() OVER (PARTITION BY country, code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) = 1 AS is_primary_location,
       CAST(row_number() OVER (PARTITION BY country, code ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, lower(city), lower(state), lower(county)) AS INTEGER) AS location_rank,
       CAST(row_number() OVER (PARTITION BY country, lower(state), lower(county), lower(city) ORDER BY evidence_count DESC, CASE source WHEN 'postal_boundary' THEN 1 ELSE 0 END DESC, code) AS INTEGER) AS postal_code_rank,
       source, evidence_count FROM p"""


@query(_RANKED)
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as CSV, twice each, and read back: merged and ranked again."""
    path = _folder(spark) / "post_code.csv"
    found = places(spark, sf_dir)
    publish.write_csv(found.unionByName(found), path)
    return pc.read_records(spark, str(path))


@query(_RANKED)
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON and read back."""
    path = _folder(spark) / "post_code.json"
    publish.write_json(records.dedupe(places(spark, sf_dir)), path, "places")
    told = spark.read.option("multiLine", True).json(str(path)).select(F.explode("records").alias("r")).select("r.*")
    return told.select(*FIELDS).withColumns({c: F.col(c).cast("int") for c in ("location_rank", "postal_code_rank", "evidence_count")})


@query(_RANKED)
def xml_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as XML and read back."""
    path = _folder(spark) / "post_code.xml"
    publish.write_xml(records.dedupe(places(spark, sf_dir)), path)
    told = spark.read.format("xml").option("rowTag", "record").schema(", ".join(f"{c} string" for c in FIELDS)).load(str(path))
    return records.normalize(told.select(*FIELDS))


@query(_RANKED)
def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources from files, and one of them replaced by fresh records."""
    folder, found = _folder(spark), places(spark, sf_dir)
    odd = F.col("code").cast("int") % 2 == 1
    publish.write_csv(found.where(~odd), folder / "a.csv")
    publish.write_csv(found.where(odd).withColumn("evidence_count", F.lit(0)), folder / "b.csv")
    return pc.combined(spark, {"a": str(folder / "a.csv"), "b": str(folder / "b.csv")}, {"a": records.dedupe(found.where("false")), "b": records.dedupe(found.where(odd))})


@query("SELECT n_name AS metadata_key, 'https://x/' || n_nationkey AS url, CAST(n_nationkey + 1 AS BIGINT) AS content_length, CASE WHEN n_nationkey % 2 = 0 THEN 'e' || n_nationkey END AS etag, CAST(n_regionkey AS INTEGER) AS record_count FROM nation")
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source metadata as a document, and read back from it."""
    k = F.col("n_nationkey")
    rows = t(spark, sf_dir, "nation").select(
        F.col("n_name").alias("metadata_key"), F.concat(F.lit("https://x/"), k).alias("url"), (k + 1).cast("long").alias("content_length"), F.when(k % 2 == 0, F.concat(F.lit("e"), k)).alias("etag"),
        F.col("n_regionkey").cast("int").alias("record_count"),
    )
    path = _folder(spark) / "metadata.json"
    publish.write_json_atomically({"generated_at": "2024-01-01T00:00:00Z", "regions": {r["metadata_key"]: pc.encode(r) for r in rows.collect()}}, path)  # 25 nations
    return pc.load_metadata(spark, str(path))[1].select("metadata_key", "url", "content_length", "etag", "record_count")


@query("SELECT country, CAST(sum(n) AS BIGINT) AS records FROM (SELECT lower(substr(r_name, 1, 2)) AS country, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) GROUP BY country")
def viewer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by country from a manifest."""
    told = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("records"))
    slug = F.lower(F.substring("r_name", 1, 2))
    files = told.select(F.explode(F.array(*[F.concat(slug, F.lit("/"), "r_name", F.lit(x)) for x in (".csv", ".json")])).alias("path"), "records")
    return publish.viewer_totals(files)
