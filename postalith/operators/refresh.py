"""Refresh of all sources: inventory, incremental skip, gates, last-known-good fallback, country rebuild, promotion.

Decisions are made on the driver from one-row tables; record sets stay DataFrames until they are promoted.
"""

from __future__ import annotations

import re
import shutil
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession

from postalith.operators import gates
from postalith.operators.extract import Extraction, ExtractionError
from postalith.operators.publish import check_roots, public_folder, replace_together, source_path, write_csv, write_json_atomically, write_public
from postalith.plans.config import COUNTRIES, FALLBACK_DAYS, Country, Source, countries_of, sources
from postalith.plans.config import progress as label
from postalith.sources import post_codes as pc
from postalith.sources.remote import IntegrityError


class RefreshError(RuntimeError):
    """The run as a whole failed; report holds what is known of it."""

    def __init__(self, message: str, report: dict | None = None):
        super().__init__(message)
        self.report = report


class QualityError(RuntimeError):
    """A candidate does not pass its gate."""


def stamp(now: datetime) -> str:
    return now.astimezone(UTC).replace(microsecond=0).strftime("%Y-%m-%dT%H:%M:%SZ")


def parse_stamp(value: str, now: datetime) -> datetime:
    """A time with an offset that is not in the future."""
    found = datetime.fromisoformat(value)
    if found.tzinfo is None:
        raise ValueError(f"time without offset: {value}")
    if found > now:
        raise ValueError(f"time in the future: {value}")
    return found


def provenance(now: datetime, accepted_at: str = "", verified_at: str = "", generated_at: str = "") -> str:
    """The latest verification of a source, every given time being valid and in order."""
    if now.tzinfo is None:
        raise ValueError("now must have an offset")
    found = {k: parse_stamp(v, now) for k, v in (("accepted", accepted_at), ("verified", verified_at), ("generated", generated_at)) if v}
    if "accepted" in found and "verified" in found and found["accepted"] > found["verified"]:
        raise ValueError("accepted after verified")
    return verified_at or accepted_at or generated_at


def usable(at: str, now: datetime, days: int = FALLBACK_DAYS) -> bool:
    """Whether last-known-good data of this time may still stand in."""
    return now - parse_stamp(at, now) <= timedelta(days=days)


def generated_at(chosen: list[Source], statuses: list[str], previous: str, now: datetime) -> str:
    """Advances only for a complete run without fallback; else the previous time, which must be there and valid."""
    if {s.metadata_key for s in chosen} == {s.metadata_key for s in sources()} and set(statuses) <= {"fresh", "unchanged"}:
        return stamp(now)
    if not previous:
        raise ValueError("a partial or fallback run needs the time of a previous full run")
    return provenance(now, generated_at=previous)


def error_class(error: BaseException) -> str:
    for kind, name in ((IntegrityError, "integrity"), (ExtractionError, "extraction"), (OSError, "network"), (RefreshError, "refresh")):
        if isinstance(error, kind):
            return name
    return "quality"


@dataclass
class Baseline:
    """Persisted data of a source that agrees with its metadata: of use for deltas, and if its times are sound for more."""

    records: DataFrame
    metrics: DataFrame
    row: dict
    fresh_enough: bool
    provenance_valid: bool = True


@dataclass
class Accepted:
    """What was decided for a source."""

    source: Source
    status: str
    records: DataFrame | None
    metadata: dict | None
    metrics: dict
    promote: bool = False
    warnings: list[str] = field(default_factory=list)
    error: str | None = None
    error_class: str | None = None
    duration_seconds: float = 0.0
    observed_state_codes: tuple[str, ...] = ()
    inferred_state_records: int = 0

    def report(self) -> dict:
        skip = {"source", "records", "metadata", "promote"}
        own = {k: v for k, v in asdict(self, dict_factory=dict).items() if k not in skip} if self.records is None else {
            k: v for k, v in vars(self).items() if k not in skip
        }
        return {"country": self.source.country.lower(), "name": self.source.name} | own


def _metrics(row) -> dict:
    return {"records": row["records"], "codes": row["codes"], "states": dict(row["state_counts"])}


def _sound(read: Callable[[], DataFrame], judge: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, dict] | None:
    """Records, their metrics, and the row of a gate that they pass; None if they can't be read or do not pass."""
    try:
        records = read().cache()
        found = judge(records)
        row = found.first().asDict()
    except (OSError, ValueError, SparkRuntimeException, AnalysisException, Py4JJavaError):
        return None  # whatever is wrong with persisted data, it is no baseline
    return (records, found, row) if row["valid"] else None


def load_baseline(spark: SparkSession, source: Source, row: dict | None, path: Path, now: datetime, previous_at: str = "") -> Baseline | None:
    """A source's persisted file if it passes the source's gate and agrees with its metadata in url, checksum form, counts and states.

    Counts and states that the metadata leaves out agree with any. Times that are wrong leave it a baseline for
    deltas alone; previous_at, the time of the whole document, stands in for times that are not there.
    """
    c = COUNTRIES[source.country]
    if row is None or row["url"] != source.url or not path.is_file() or row["content_length"] <= 0 or not re.fullmatch("[0-9a-f]{32}", row.get("md5") or ""):
        return None
    sound = _sound(lambda: pc.read_records(spark, str(path)), lambda records: gates.source_gate(gates.metrics(records, c), c, source))
    if sound is None:
        return None
    records, found, have = sound
    states = sorted(k for k, n in have["state_counts"].items() if n)
    if row.get("record_count") not in (None, have["records"]) or row.get("unique_post_code_count") not in (None, have["codes"]) or sorted(row.get("state_codes") or states) != states:
        return None
    try:
        at, valid = provenance(now, row.get("accepted_at") or "", row.get("verified_at") or "", previous_at), True
    except ValueError:
        at, valid = "", False
    return Baseline(records, found, row, bool(at) and usable(at, now), valid)


def country_baseline(spark: SparkSession, c: Country, public_root: Path) -> DataFrame | None:
    """Metrics of a country's public records, if they can be read and pass its gate."""
    path = public_folder(public_root, c) / "post_code.csv"
    if not path.is_file():
        return None
    sound = _sound(lambda: pc.read_records(spark, str(path)), lambda records: gates.country_gate(gates.metrics(records, c), c))
    return sound[1] if sound else None


def refresh(
    spark: SparkSession, *, chosen: list[Source], now: datetime, metadata_path: Path, source_root: Path, public_root: Path, report_path: Path,
    inventory: Callable[[Source], dict], extract: Callable[[Source, dict], Extraction], progress: Callable[[str], None] = lambda _: None,
) -> dict:
    """Refresh the chosen sources and the countries they belong to; returns the report, which is written in any case.

    inventory gives a source's fingerprint, extract its records; both do what remote work there is. A source whose
    fingerprint is unchanged keeps its data; one that fails keeps data of at most FALLBACK_DAYS; a country that fails
    its gate falls back as a whole once. Files, public sets and metadata appear together or not at all.
    """
    if now.tzinfo is None:
        raise ValueError("now must have an offset")
    if not chosen:
        raise RefreshError("no source is chosen")
    check_roots(source_root, public_root)
    began = time.monotonic()
    try:
        previous_at, table = pc.load_metadata(spark, str(metadata_path))
    except pc.MetadataDocumentError as error:
        raise RefreshError(str(error)) from error
    previous = {r["metadata_key"]: r.asDict() for r in table.collect()}  # one row per configured source
    path = lambda s: source_path(source_root, COUNTRIES[s.country], s.name)
    baselines = {s.metadata_key: load_baseline(spark, s, previous.get(s.metadata_key), path(s), now, previous_at) for s in chosen}
    accepted: dict[str, Accepted] = {}
    results: list[dict] = []

    def report(status: str, error: str | None = None, kind: str | None = None) -> dict:
        found = {
            "status": status, "generated_at": stamp(now), "duration_seconds": round(time.monotonic() - began, 3), "sources": [a.report() for a in accepted.values()],
            "countries": results, "warnings": [w for a in accepted.values() for w in a.warnings],
        }
        found |= {"error": error, "error_class": kind} if error else {}
        write_json_atomically(found, report_path)
        return found

    def fail(message: str, kind: str = "refresh") -> None:
        raise RefreshError(message, report("failed", message, kind))

    def fall_back(s: Source, error: BaseException, reuse: bool = True) -> Accepted:
        base = baselines[s.metadata_key]
        said = {"error": str(error), "error_class": error_class(error)}
        if reuse and base is not None and base.fresh_enough:
            warning = f"source {s.metadata_key} reused last-known-good data: {error}"
            return Accepted(s, "reused_last_good", base.records, base.row, _metrics(base.metrics.first()), warnings=[warning], **said)
        return Accepted(s, "failed", None, None, _metrics(base.metrics.first()) if base else {}, **said)

    # every source is looked at before any is read
    seen: dict[str, dict] = {}
    for i, s in enumerate(chosen, 1):
        progress(f"{label(i, len(chosen), s)}: inventory")
        try:
            seen[s.metadata_key] = inventory(s)
        except (OSError, IntegrityError) as error:
            accepted[s.metadata_key] = fall_back(s, error)
    lost = [a for a in accepted.values() if a.status == "failed"]
    if lost:
        for s in chosen:
            accepted.setdefault(s.metadata_key, fall_back(s, RefreshError("not processed: another source failed inventory"), reuse=False))
        fail("inventory failed without usable data: " + "; ".join(f"{a.source.metadata_key}: {a.error}" for a in lost), "network")

    keys = ("url", "content_length", "etag", "last_modified", "md5")
    for s in chosen:
        if s.metadata_key in accepted:
            continue
        now_seen, old, base = seen[s.metadata_key], previous.get(s.metadata_key), baselines[s.metadata_key]
        c = COUNTRIES[s.country]
        start = time.monotonic()
        if base and base.provenance_valid and old and all((old.get(k) or None) == (now_seen.get(k) or None) for k in keys):
            row = old | {"verified_at": stamp(now), "accepted_at": old.get("accepted_at") or old.get("verified_at") or previous_at}
            accepted[s.metadata_key] = Accepted(s, "unchanged", base.records, row, _metrics(base.metrics.first()))
            continue
        try:
            found = extract(s, now_seen)
            judged = gates.source_gate(gates.metrics(found.records, c), c, s, base.metrics if base else None).first()
            errors = [*gates.observed_errors(found.observed_state_codes, c, s), *judged["errors"]]
            if errors:
                raise QualityError("; ".join(errors))
        except (OSError, IntegrityError, ExtractionError, QualityError) as error:
            accepted[s.metadata_key] = fall_back(s, error)
            if accepted[s.metadata_key].status == "failed":
                fail(f"{s.metadata_key} failed without usable last-known-good data: {error}", error_class(error))
            continue
        states = sorted(k for k, n in judged["state_counts"].items() if n)
        row = now_seen | {"accepted_at": stamp(now), "verified_at": stamp(now), "record_count": judged["records"], "unique_post_code_count": judged["codes"], "state_codes": states}
        accepted[s.metadata_key] = Accepted(
            s, "fresh", found.records, row, _metrics(judged), True, list(judged["warnings"]), duration_seconds=round(time.monotonic() - start, 3),
            observed_state_codes=found.observed_state_codes, inferred_state_records=found.inferred_state_records,
        )

    def rebuild(c: Country) -> DataFrame:
        whole = {s.metadata_key for s in c.sources} <= {s.metadata_key for s in chosen}
        used = c.sources if whole else [s for s in chosen if s.country == c.code]
        fresh = {s.metadata_key: accepted[s.metadata_key].records for s in used if s.metadata_key in accepted}
        missing = [s.name for s in used if s.metadata_key not in fresh and not path(s).exists()]
        if missing:
            fail(f"{c.slug} lacks {', '.join(missing)}")
        return pc.combined(spark, {s.metadata_key: str(path(s)) for s in used}, {k: v for k, v in fresh.items() if v is not None})

    outputs: dict[str, DataFrame] = {}
    for c in countries_of(chosen):
        whole = {s.metadata_key for s in c.sources} <= {s.metadata_key for s in chosen}
        old = country_baseline(spark, c, public_root) if whole else None
        warnings: list[str] = []
        records = rebuild(c)
        judged = gates.country_gate(gates.metrics(records, c), c, old).first()
        if not judged["records"]:
            fail(f"{c.slug} sources gave no public record")
        if whole and judged["errors"]:
            message = "; ".join(judged["errors"])
            renewed = [a for a in accepted.values() if a.source.country == c.code and a.status == "fresh"]
            for a in renewed:
                accepted[a.source.metadata_key] = fall_back(a.source, QualityError(message))
            if not renewed or any(accepted[a.source.metadata_key].status != "reused_last_good" for a in renewed):
                fail(message, "quality")
            records = rebuild(c)
            judged = gates.country_gate(gates.metrics(records, c), c, old).first()
            if judged["errors"]:
                fail("; ".join(judged["errors"]), "quality")
            warnings = [f"country {c.slug} rejected: {message}"]
        outputs[c.slug] = records
        results.append({"country": c.slug, "records": judged["records"], "codes": judged["codes"], "complete": whole, "warnings": [*judged["warnings"], *warnings]})

    try:
        at = generated_at(chosen, [a.status for a in accepted.values()], previous_at, now)
    except ValueError as error:
        fail(str(error))
    found = report("success")
    # staged beside the metadata, where the outputs are meant to lie: no other disk, and nothing is left on one machine alone
    folder = metadata_path.parent / f".staged-{uuid.uuid4().hex}"
    folder.mkdir(parents=True)
    try:
        staged: dict[Path, Path] = {}
        for a in accepted.values():
            if a.promote:
                file = Path(folder) / f"{a.source.country}-{a.source.name}.csv"
                write_csv(a.records, file)
                staged[file] = path(a.source)
        for slug, records in outputs.items():
            c = next(c for c in COUNTRIES.values() if c.slug == slug)
            write_public(records, Path(folder) / slug, f"{c.name} post codes")
            for kind in ("csv", "json", "xml"):
                staged[Path(folder) / slug / f"post_code.{kind}"] = public_folder(public_root, c) / f"post_code.{kind}"
        regions = {k: {n: v for n, v in row.items() if n != "metadata_key" and v not in (None, "", [])} for k, row in previous.items()}
        for k, a in accepted.items():
            if a.status != "reused_last_good":
                regions[k] = {n: v for n, v in a.metadata.items() if n != "metadata_key" and v not in (None, "", [])}
        document = Path(folder) / "metadata.json"
        write_json_atomically({"generated_at": at, "source": "OpenStreetMap extracts", "regions": dict(sorted(regions.items()))}, document)
        staged[document] = metadata_path
        try:
            replace_together(staged)
        except OSError as error:
            fail(f"promotion failed: {error}", "storage")
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return found


def summary(report: dict) -> dict[str, int]:
    """How many sources have each status, and how many records are public."""
    counts: dict[str, int] = {}
    for s in report["sources"]:
        counts[s["status"]] = counts.get(s["status"], 0) + 1
    return counts | {"records": sum(c["records"] for c in report["countries"])}
