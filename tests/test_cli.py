import pytest
from test_extract import area, basis
from test_publish import template

from postalith import POST_CODE_RECORD, cli, dedupe_records
from postalith.operators import publish
from postalith.plans.config import COUNTRIES
from postalith.sources.post_codes import read_records


def test_extract_package_and_export(spark, tmp_path, capsys):
    d = basis()
    area(d, 1, 1, 2, 2, "28195", "28195 Bremen")
    d.write(tmp_path / "map.osm")
    assert cli.main(["extract", "--input", str(tmp_path / "map.osm"), "--output", str(tmp_path / "de.csv")]) == 0
    assert capsys.readouterr().out.startswith("1 records, 1 areas")
    records = read_records(spark, str(tmp_path / "de.csv"))
    assert dedupe_records(records).schema.names == POST_CODE_RECORD.names
    for c in COUNTRIES.values():
        publish.write_public(records, publish.public_folder(tmp_path / "pub", c), c.name)
    assert cli.main(["package", "--data-root", str(tmp_path / "pub"), "--output", str(tmp_path / "site")]) == 0
    template(tmp_path / "t.xlsx")
    more = ["--template", str(tmp_path / "t.xlsx"), "--output", str(tmp_path / "o.xlsx"), "--guardrails", str(tmp_path / "g.md")]
    assert cli.main(["export", "--data-root", str(tmp_path / "pub"), "--countries", "de", *more]) == 0
    assert capsys.readouterr().out.splitlines() == ["9 files", "1 rows"]
    assert cli.main(["export", "--data-root", str(tmp_path / "none"), *more]) == 1
    assert cli.main(["extract", "--input", "x", "--output", "y", "--source", "nowhere"]) == 1
    with pytest.raises(SystemExit):
        cli.main([])
