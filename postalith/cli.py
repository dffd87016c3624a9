"""Command line: extract, refresh, package and export. Exit code 1 with a message where a command fails."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from postalith.operators import erp, publish
from postalith.operators.extract import Extraction, ExtractionError, extract
from postalith.operators.refresh import RefreshError, refresh, stamp, summary
from postalith.plans.config import COUNTRIES, Source, country, selection, sources
from postalith.sources import osm, pbf, remote
from postalith.sources.post_codes import MetadataDocumentError, read_countries


def read_map(spark: SparkSession, path: str) -> DataFrame:
    return pbf.read_pbf(spark, path) if path.endswith(".pbf") else osm.read_xml(spark, path)


def _source(name: str | None) -> Source | None:
    if name is None:
        return None
    found = [s for s in sources() if s.name == name]
    if not found:
        raise ValueError(f"unknown source {name!r}")
    return found[0]


def run_extract(spark: SparkSession, args: argparse.Namespace) -> str:
    source = _source(args.source)
    found = extract(read_map(spark, str(args.input)), country(args.country), source, args.min_evidence)
    n = publish.write_csv(found.records, args.output)
    return f"{n} records, {found.postal_boundary_count} areas, {found.address_candidate_count} addresses, {found.dropped_candidate_count} dropped, {found.inferred_state_records} inferred"


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> str:
    slugs = selection(args.countries, [c.slug for c in COUNTRIES.values()], "countries")
    among = sources(slugs)
    names = selection(args.sources, [s.name for s in among], "sources")

    def fetch(s: Source, seen: dict) -> Extraction:
        path = remote.download(seen, args.downloads / s.country.lower() / s.file_name)
        return extract(read_map(spark, str(path)), COUNTRIES[s.country], s)

    report = refresh(
        spark, chosen=[s for s in among if s.name in names], now=datetime.now(UTC), metadata_path=args.metadata, source_root=args.source_root, public_root=args.public_root,
        report_path=args.report, inventory=remote.fingerprint, extract=fetch, progress=lambda m: print(m, file=sys.stderr),
    )
    return ", ".join(f"{k} {v}" for k, v in summary(report).items())


def run_package(spark: SparkSession, args: argparse.Namespace) -> str:
    manifest = publish.package(args.data_root, args.site, args.output, args.base, stamp(datetime.now(UTC)), args.metadata)
    return f"{len(manifest['files'])} files"


def run_export(spark: SparkSession, args: argparse.Namespace) -> str:
    slugs = selection(args.countries, [c.slug for c in COUNTRIES.values()], "countries")
    chosen = [country(s) for s in slugs]
    records = read_countries(spark, str(args.data_root), chosen)
    rows = erp.rows(records, [c.code for c in chosen])
    n = erp.write_workbook(rows, args.template, args.output)
    args.guardrails.parent.mkdir(parents=True, exist_ok=True)
    args.guardrails.write_text(erp.guardrails(records, rows, args.output.name), "utf-8")
    return f"{n} rows"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="postalith", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name: str, run, *paths: str, optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        one.set_defaults(run=run)
        for path in (*paths, *optional):
            one.add_argument(f"--{path}", type=Path, required=path not in optional)
        return one

    one = command("extract", run_extract, "input", "output")
    one.add_argument("--country", default="de")
    one.add_argument("--source")
    one.add_argument("--min-evidence", type=int, default=3)
    one = command("refresh", run_refresh, "metadata", "source-root", "public-root", "report", "downloads")
    one.add_argument("--countries")
    one.add_argument("--sources")
    one = command("package", run_package, "data-root", "output", optional=("site", "metadata"))
    one.add_argument("--base", default="/api/v1")
    one = command("export", run_export, "data-root", "template", "output", "guardrails")
    one.add_argument("--countries")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("postalith").getOrCreate()
    try:
        print(args.run(spark, args))
    except (ExtractionError, RefreshError, MetadataDocumentError, OSError, ValueError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
