import io
import json
import urllib.error
from datetime import UTC, datetime, timedelta

import pytest
from test_gates import volume

from postalith.operators import refresh as rf
from postalith.operators.extract import Extraction, ExtractionError
from postalith.operators.records import dedupe
from postalith.plans.config import sources
from postalith.sources import remote

NOW = datetime(2024, 6, 1, tzinfo=UTC)
BREMEN = next(s for s in sources() if s.name == "bremen")
HAMBURG = next(s for s in sources() if s.name == "hamburg")


class World:
    """Sources whose fingerprints, sizes and failures a test sets."""

    def __init__(self, spark, root):
        self.spark, self.root, self.size, self.md5, self.broken, self.offline = spark, root, {}, {}, {}, set()
        (root / "meta").mkdir()
        (root / "meta/m.json").write_text(json.dumps({"generated_at": "2024-01-01T00:00:00Z", "regions": {}}))

    def inventory(self, s):
        if s.name in self.offline:
            raise OSError("offline")
        return {"metadata_key": s.metadata_key, "url": s.url, "content_length": 9, "etag": None, "last_modified": None, "md5": self.md5.get(s.name, "a" * 32)}

    def extract(self, s, seen):
        if s.name in self.broken:
            raise ExtractionError("broken")
        state = {"bremen": "Bremen", "hamburg": "Hamburg"}[s.name]
        return Extraction(dedupe(volume(self.spark, self.size.get(s.name, 40), 20, [state])), 1, 1, 0, 0, s.required)

    def run(self, now=NOW, chosen=(BREMEN, HAMBURG)):
        return rf.refresh(
            self.spark, chosen=list(chosen), now=now, metadata_path=self.root / "meta/m.json", source_root=self.root / "src", public_root=self.root / "pub",
            report_path=self.root / "report.json", inventory=self.inventory, extract=self.extract,
        )


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def statuses(report):
    return [s["status"] for s in report["sources"]]


def test_fresh_then_unchanged_then_fallback(world):
    first = world.run()
    assert statuses(first) == ["fresh", "fresh"] and first["countries"][0]["records"] == 80
    assert len((world.root / "pub/de/post_code.csv").read_text().splitlines()) == 81
    assert statuses(world.run(NOW + timedelta(days=1))) == ["unchanged", "unchanged"]
    world.md5["bremen"], world.size["bremen"], world.broken = "b" * 32, 50, {"hamburg"}
    world.md5["hamburg"] = "c" * 32
    third = world.run(NOW + timedelta(days=2))
    assert statuses(third) == ["fresh", "reused_last_good"] and third["countries"][0]["records"] == 90
    assert rf.summary(third) == {"fresh": 1, "reused_last_good": 1, "records": 90}
    kept = json.loads((world.root / "meta/m.json").read_text())["regions"]
    assert kept["hamburg"]["md5"] == "a" * 32 and kept["bremen"]["record_count"] == 50


def test_a_shrunken_or_stale_source_fails(world):
    world.run()
    world.md5["bremen"], world.size["bremen"] = "b" * 32, 20
    assert statuses(world.run(NOW + timedelta(days=20))) == ["reused_last_good", "unchanged"]
    before = (world.root / "pub/de/post_code.csv").read_text()
    with pytest.raises(rf.RefreshError) as caught:
        world.run(NOW + timedelta(days=22), chosen=[BREMEN])
    assert caught.value.report["status"] == "failed" and json.loads((world.root / "report.json").read_text())["status"] == "failed"
    assert (world.root / "pub/de/post_code.csv").read_text() == before


def test_what_makes_a_baseline(spark, world):
    world.run()
    path = world.root / "src/de/post_code/bremen.csv"
    row = json.loads((world.root / "meta/m.json").read_text())["regions"]["bremen"]
    load = lambda change, at="": rf.load_baseline(spark, BREMEN, row | change, path, NOW, at)
    sound = load({})
    assert sound.fresh_enough and sound.provenance_valid and sound.metrics.first()["records"] == 40
    assert load({"record_count": None, "unique_post_code_count": None, "state_codes": []}).fresh_enough
    for wrong in ({"url": "x"}, {"content_length": 0}, {"md5": "A" * 32}, {"md5": "a" * 31}, {"record_count": 41}, {"unique_post_code_count": 1}, {"state_codes": ["DE-HH"]}):
        assert load(wrong) is None
    # times that are not sound leave a baseline for deltas alone; the document's own time stands in for missing ones
    for change, at, fresh, valid in (({"accepted_at": "2025-01-01T00:00:00Z"}, "", False, False), ({"accepted_at": "", "verified_at": ""}, "", False, True),
                                     ({"accepted_at": "", "verified_at": ""}, "2024-05-30T00:00:00Z", True, True), ({"accepted_at": "", "verified_at": ""}, "bad", False, False)):
        found = load(change, at)
        assert (found.fresh_enough, found.provenance_valid) == (fresh, valid)
    text = path.read_text()
    for broken in (text.replace("Bremen", "Hamburg"), text.replace("true", "perhaps", 1), "a,b\n1,2\n"):
        path.write_text(broken)
        assert load({}) is None


def test_a_public_file_that_is_not_sound_is_no_baseline(spark, world):
    from postalith.plans.config import COUNTRIES

    folder = world.root / "pub/de"
    folder.mkdir(parents=True)
    assert rf.country_baseline(spark, COUNTRIES["DE"], world.root / "pub") is None
    for content in ("a,b\n1,2\n", ""):
        (folder / "post_code.csv").write_text(content)
        assert rf.country_baseline(spark, COUNTRIES["DE"], world.root / "pub") is None
    assert statuses(world.run()) == ["fresh", "fresh"]
    assert rf.country_baseline(spark, COUNTRIES["DE"], world.root / "pub") is None  # 80 records are below the floor


def test_progress_and_empty_sources(spark, world):
    said = []
    rf.refresh(spark, chosen=[BREMEN], now=NOW, metadata_path=world.root / "meta/m.json", source_root=world.root / "src", public_root=world.root / "pub", report_path=world.root / "r.json",
               inventory=world.inventory, extract=world.extract, progress=said.append)
    assert said == ["[1/1] de/bremen: inventory"]
    assert not [p for p in (world.root / "meta").iterdir() if p.name.startswith(".staged")]


def test_inventory_comes_before_any_extraction(world):
    world.offline = {"hamburg"}
    with pytest.raises(rf.RefreshError, match="inventory"):
        world.run()
    assert not (world.root / "pub").exists()


def test_times():
    assert rf.usable("2024-05-11T00:00:00Z", NOW) and not rf.usable("2024-05-10T23:59:59Z", NOW)
    assert rf.provenance(NOW, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "") == "2024-01-02T00:00:00Z"
    for bad in ({"accepted_at": "2024-01-02T00:00:00Z", "verified_at": "2024-01-01T00:00:00Z"}, {"accepted_at": "2025-01-02T00:00:00Z"}, {"accepted_at": "2024-01-02T00:00:00"}):
        with pytest.raises(ValueError):
            rf.provenance(NOW, **bad)
    assert rf.generated_at(sources(), ["fresh"], "", NOW) == "2024-06-01T00:00:00Z"
    assert rf.generated_at([BREMEN], ["fresh"], "2024-01-01T00:00:00Z", NOW) == "2024-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        rf.generated_at([BREMEN], ["fresh"], "", NOW)


class Reply(io.BytesIO):
    def __init__(self, data=b"", headers=None):
        super().__init__(data)
        self.headers = headers or {}


def test_remote_reads_are_retried_and_checked(tmp_path):
    import hashlib

    data, waits, calls = b"x" * 3000, [], []
    md5 = hashlib.md5(data).hexdigest()

    def open_(request):
        calls.append(request)
        if len(calls) == 1:
            raise urllib.error.HTTPError("u", 503, "busy", {"Retry-After": "600"}, None)
        url = request if isinstance(request, str) else request.full_url
        return Reply(f"{md5}  f".encode()) if url.endswith(".md5") else Reply(data, {"Content-Length": "3000", "ETag": "e"})

    seen = remote.fingerprint(BREMEN, open_, waits.append)
    assert (seen["content_length"], seen["md5"], waits) == (3000, md5, [60.0])
    path = remote.download(seen, tmp_path / "f.pbf", open_, waits.append)
    assert path.read_bytes() == data and remote.matches(path, 3000, md5)
    with pytest.raises(remote.IntegrityError):
        remote.download(seen | {"md5": "0" * 32}, tmp_path / "g.pbf", open_, waits.append)
    assert not list(tmp_path.glob("g*"))
    with pytest.raises(urllib.error.HTTPError):
        remote.retry(lambda: (_ for _ in ()).throw(urllib.error.HTTPError("u", 404, "no", {}, None)))
