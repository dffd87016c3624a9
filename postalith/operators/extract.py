"""Extraction of records from map objects: classification, enrichment, expansion, fallback and counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.functions import text
from postalith.operators import evidence as ev
from postalith.operators import records as rec
from postalith.operators import spatial as sp
from postalith.plans.config import MIN_ADDRESS_EVIDENCE, Country, Source
from postalith.plans.schema import BOUNDARY, FALLBACK, IDENTITY
from postalith.store import held


class ExtractionError(RuntimeError):
    """The input has no boundary, or gives no valid record."""


@dataclass
class Extraction:
    """Records, and a one-row table of counters: boundaries, addresses, dropped, inferred; and the state codes seen."""

    records: DataFrame
    postal_boundary_count: int
    address_candidate_count: int
    dropped_candidate_count: int
    inferred_state_records: int
    observed_state_codes: tuple[str, ...]


def _tag(name: str) -> Column:
    return F.col("tags")[name]


def _some(*names: str) -> Column:
    """The first of these tags that is not empty."""
    return F.coalesce(*[F.nullif(_tag(n), F.lit("")) for n in names])


def _state_tag() -> Column:
    return F.upper(text.normalize_text(_tag("ISO3166-2")))


def is_administrative(levels: tuple[str, ...]) -> Column:
    return F.coalesce((_tag("boundary") == "administrative") & _tag("admin_level").isin(*levels), F.lit(False)) if levels else F.lit(False)


def is_country(c: Country) -> Column:
    return is_administrative(("2",)) & F.coalesce(_some("ISO3166-1:alpha2", "ISO3166-1") == c.code, F.lit(False))


def state_code(c: Country) -> Column:
    """Code of a state's boundary, '' for other objects. Its name is looked up, never read."""
    code = _state_tag()
    return F.when(is_administrative(c.state_levels) & F.startswith(code, F.lit(f"{c.code}-")), code).otherwise("")


def is_postal() -> Column:
    level = F.coalesce(_tag("postal_code_level"), F.lit("8"))
    return F.coalesce((_tag("boundary") == "postal_code") & (level == "8"), F.lit(False)) & _some("postal_code", "postcode").isNotNull()


def is_foreign(c: Country) -> Column:
    """Whether any tag names another country, or a state outside it."""
    keys = ("addr:country", "is_in:country_code", "ISO3166-1:alpha2", "ISO3166-1", "country")
    named = F.array(*[F.upper(text.normalize_text(_tag(k))) for k in keys])
    code = _state_tag()
    return F.exists(named, lambda x: (x != "") & (x != c.code)) | ((code != "") & ~F.startswith(code, F.lit(f"{c.code}-")))


def classify(objects: DataFrame, c: Country) -> DataFrame:
    """Objects with kinds: country, state, unknown_state, county, fallback_county, postal, address.

    An area that is a country or a county is nothing else after that; a state may still be the others.
    """
    known = F.coalesce(state_code(c).isin(*c.states), F.lit(False))
    area, name = F.col("kind") == "area", text.normalize_text(_tag("name"))
    country = area & is_country(c)
    state = area & ~country & (state_code(c) != "")
    county = area & ~country & is_administrative(c.county_levels) & (name != "") & ~is_foreign(c)
    spare = area & ~country & ~county & is_administrative(c.fallback_county_levels) & (name != "") & ~is_foreign(c)
    free = ~country & ~county & ~spare
    kinds = {
        "country": country, "state": state & known & ~is_foreign(c), "unknown_state": state & ~(known & ~is_foreign(c)), "county": county,
        "fallback_county": spare, "postal": area & free & is_postal(), "address": free & F.map_contains_key("tags", "addr:postcode"),
    }
    kinds = F.array_compact(F.array(*[F.when(test, F.lit(k)) for k, test in kinds.items()]))
    return objects.withColumn("kinds", kinds).withColumn("state_code", state_code(c)).withColumn("name", name)


def postal_candidates(objects: DataFrame, c: Country) -> DataFrame:
    """Postal areas with code, cities, state_code and ok: whether it stays."""
    code = text.normalize_post_code(_some("postal_code", "postcode"), c.pattern)
    rows = objects.where(F.array_contains("kinds", "postal")).withColumn("code", code)
    rows = rows.withColumn("cities", text.boundary_cities("code", _tag("note"), _tag("name"))).withColumn("state_code", _state_tag())
    return rows.withColumn("ok", ~is_foreign(c) & (F.col("code") != "") & (F.size("cities") > 0))


def address_candidates(objects: DataFrame, c: Country) -> DataFrame:
    """Address objects with code, city (of addr:city alone), state_code and ok."""
    rows = objects.where(F.array_contains("kinds", "address")).withColumn("code", text.normalize_post_code(_tag("addr:postcode"), c.pattern))
    rows = rows.withColumn("city", text.normalize_text(_tag("addr:city"))).withColumn("state_code", _state_tag())
    return rows.withColumn("ok", ~is_foreign(c) & (F.col("code") != "") & (F.col("city") != ""))


def inference_state(c: Country, source: Source | None, accepted: set[str]) -> str:
    """Name of the state that fills gaps: a German source's own, if all other states it must hold were accepted."""
    if c.code != "DE" or source is None or source.primary is None:
        return ""
    if source.primary not in c.states:
        raise ExtractionError(f"{source.name} declares unknown primary state {source.primary}")
    return c.states[source.primary] if set(source.required) - {source.primary} <= accepted else ""


def tag_agrees(rows: DataFrame, key: str, touching: DataFrame, c: Country, source: Source | None) -> DataFrame:
    """Rows with agrees: whether the state tag is empty, the source's own, or that of a state that (key, state_code) has touch it."""
    touching = touching.select(key, "state_code").distinct().withColumn("_touch", F.lit(True))
    told = rows.join(touching, [key, "state_code"], "left")
    code = F.col("state_code")
    rule = F.when(code == "", True).when(~code.isin(*c.states), False)
    if source is not None:
        rule = rule.when(~code.isin(*source.required), False)
        if source.primary is not None:
            rule = rule.when(code == source.primary, True)
    return told.withColumn("agrees", rule.otherwise(F.coalesce("_touch", F.lit(False)))).drop("_touch")


def filled(told: DataFrame, inferred: str) -> DataFrame:
    """Rows with inferred: whether the empty state of a row that may_infer was filled with this name; '' fills none."""
    fill = F.lit(inferred != "") & (F.col("state") == "") & F.col("may_infer")
    told = told.withColumn("inferred", F.coalesce(fill, F.lit(False)))
    return told.withColumn("state", F.when(F.col("inferred"), F.lit(inferred)).otherwise(F.coalesce("state", F.lit(""))))


def extract(objects: DataFrame, c: Country, source: Source | None = None, min_evidence: int = MIN_ADDRESS_EVIDENCE) -> Extraction:
    """Records of a country from map objects (seq, kind, tags, rings, px, py)."""
    if source is not None and source.country != c.code:
        raise ValueError(f"source {source.name} belongs to {source.country}, not {c.code}")
    objects = held(classify(objects, c))
    shapes = lambda kind: objects.where(F.array_contains("kinds", kind)).where(F.size("rings") > 0)
    names = F.create_map(*[F.lit(x) for item in c.states.items() for x in item])

    parts = objects.where(F.arrays_overlap("kinds", F.array(*[F.lit(k) for k in ("country", "state", "unknown_state", "county", "fallback_county")]))).where(F.size("rings") > 0)
    if not parts.limit(1).count():
        raise ExtractionError(f"{c.name} administrative boundary was not found")
    country = parts.select("rings")
    # every state and county is a part of the country's outline itself, so all of them overlap it
    states = shapes("state").select("seq", "state_code", names[F.col("state_code")].alias("name"), "rings")
    counties = shapes("county").select("seq", "name", "rings")
    if not counties.limit(1).count():
        counties = shapes("fallback_county").select("seq", "name", "rings")
    unknown = shapes("unknown_state").select("rings")
    state_codes = states.select("state_code").distinct().limit(len(c.states) + 1).collect()  # a few dozen configured codes
    inferred = inference_state(c, source, {r["state_code"] for r in state_codes})

    def place(points: DataFrame, key: str) -> DataFrame:
        """state, county and may_infer for points (key, px, py)."""
        excluded = sp.any_covers(points, key, unknown).withColumn("_excluded", F.lit(True))
        told = points.join(sp.first_name(points, key, states).withColumnRenamed("name", "state"), key)
        told = told.join(sp.first_name(points, key, counties).withColumnRenamed("name", "county"), key)
        return told.join(excluded, key, "left").withColumn("may_infer", F.col("_excluded").isNull()).drop("_excluded")

    # addresses
    asked = address_candidates(objects, c)
    aggregates, dropped = ev.addresses(asked.where("ok").select("seq", "code", "city", "state_code", "px", "py"))
    aggregates = held(aggregates.withColumn("akey", F.struct("code", "city")))
    pointed = aggregates.where(F.col("px").isNotNull()).select("akey", "px", "py")
    touching = sp.covering(pointed, states.select(F.col("state_code"), "rings")).select("akey", "state_code")
    agreed = held(tag_agrees(aggregates, "akey", touching, c, source))
    inside = sp.any_covers(pointed, "akey", country).withColumn("_inside", F.lit(True))
    kept = held(agreed.where("agrees").join(inside, "akey", "left").withColumn("inside", F.coalesce("_inside", F.col("px").isNull())))
    located = place(kept.where("inside and px is not null").select("akey", "px", "py"), "akey").select("akey", "state", "county", "may_infer")
    told = filled(kept.where("inside").join(located, "akey", "left"), inferred).withColumn("county", F.coalesce("county", F.lit("")))
    evidence = held(told.groupBy("code", "city", "state", "county").agg(F.sum("n").alias("n"), F.bool_or("inferred").alias("inferred")))

    # postal areas
    candidates = postal_candidates(objects, c)
    areas = held(candidates.where("ok").select(F.col("seq").alias("akey"), "code", "cities", "state_code", "rings", "px", "py"))
    within = sp.any_covers(areas.where(F.col("px").isNotNull()), "akey", country)
    over = sp.overlapping(areas.select("akey", "rings"), states.select(F.struct("state_code", "name").alias("bkey"), "rings"))
    over = held(over.select("akey", F.col("bkey.state_code").alias("state_code"), F.col("bkey.name").alias("state")))
    judged = tag_agrees(areas, "akey", over.select("akey", "state_code"), c, source).join(within.withColumn("_within", F.lit(True)), "akey", "left")
    accepted = held(judged.where(F.col("_within") & F.col("agrees")).drop("_within", "agrees"))
    none = F.array().cast("array<string>")
    spatial = over.groupBy("akey").agg(F.array_sort(F.collect_set("state")).alias("states"))
    near = sp.overlapping(areas.select("akey", "rings"), counties.select(F.col("name").alias("bkey"), "rings")).groupBy("akey").agg(F.array_sort(F.collect_set("bkey")).alias("counties"))
    excluded = sp.any_covers(accepted, "akey", unknown).withColumn("_excluded", F.lit(True))
    rows = accepted.join(spatial, "akey", "left").join(near, "akey", "left").join(excluded, "akey", "left")
    rows = rows.withColumn("states", F.coalesce("states", none)).withColumn("counties", F.coalesce("counties", none))
    rows = rows.withColumn("filled", F.lit(inferred != "") & (F.size("states") == 0) & F.col("_excluded").isNull())
    rows = rows.withColumn("states", F.when(F.col("filled"), F.array(F.lit(inferred))).otherwise(F.col("states")))
    wide = ev.expand(held(rows).select("code", "cities", "states", "counties", "filled"), evidence.select("code", "city", "state", "county", "n"))
    tagged = evidence.where("inferred").select("code", "city", "state", "county").withColumn("_tagged", F.lit(True))
    wide = wide.join(tagged, ["code", "city", "state", "county"], "left")
    from_areas = wide.select("code", "city", "state", "county", F.lit(BOUNDARY).alias("source"), F.col("n").alias("evidence_count"),
                             ((F.col("filled") & (F.col("state") == inferred)) | F.col("_tagged").isNotNull()).alias("inferred"))
    fallback = ev.without(ev.at_least(evidence, min_evidence), accepted, "code")
    from_addresses = fallback.select("code", "city", "state", "county", F.lit(FALLBACK).alias("source"), F.col("n").alias("evidence_count"), "inferred")
    every = from_areas.unionByName(from_addresses).withColumn("country", F.lit(c.code)).withColumn("time_zone", F.lit(c.time_zone))
    every = held(every.withColumn("evidence_count", F.col("evidence_count").cast("int")))
    found = rec.dedupe(every.drop("inferred"))
    if not every.limit(1).count():
        raise ExtractionError("extraction produced zero valid records")

    # counters: an object each, but one for an aggregate outside the country
    count = lambda df: df.agg(F.count("*")).first()[0]
    lost = count(asked.where("not ok")) + count(dropped) + count(candidates.where("not ok"))
    lost += agreed.where("not agrees").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lost += count(kept.where("not inside")) + count(areas) - count(accepted)
    seen = objects.where(F.arrays_overlap("kinds", F.array(F.lit("state"), F.lit("unknown_state")))).agg(F.array_sort(F.collect_set("state_code"))).first()[0]  # codes of one country's states
    return Extraction(
        found, count(areas), aggregates.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], lost,
        every.where("inferred").select(*IDENTITY).distinct().count(), tuple(seen),
    )
