import pytest

from postalith.operators import extract as ex
from postalith.plans.config import COUNTRIES, sources
from postalith.sources import osm


class Doc:
    """A small map document."""

    def __init__(self):
        self.parts, self.next = [], 1

    def node(self, lat, lon, **tags):
        self.parts.append((f'<node id="{self.next}" lat="{lat}" lon="{lon}"', tags, ""))
        self.next += 1
        return self.next - 1

    def box(self, lon1, lat1, lon2, lat2, **tags):
        refs = [self.node(lat, lon) for lon, lat in ((lon1, lat1), (lon2, lat1), (lon2, lat2), (lon1, lat2))]
        self.parts.append((f'<way id="{self.next}"', tags, "".join(f'<nd ref="{r}"/>' for r in [*refs, refs[0]])))
        self.next += 1

    def write(self, path):
        def one(head, tags, inner):
            inner += "".join(f'<tag k="{k.replace("__", ":")}" v="{v}"/>' for k, v in tags.items())
            return f"{head}>{inner}</{head[1:].split()[0]}>"

        path.write_text('<osm version="0.6">\n' + "\n".join(one(*p) for p in self.parts) + "\n</osm>")
        return str(path)


def admin(level, name, **tags):
    return {"boundary": "administrative", "admin_level": level, "name": name} | tags


def basis(state="DE-HB"):
    d = Doc()
    d.box(0, 0, 10, 10, **admin("2", "Germany", **{"ISO3166-1": "DE"}))
    if state:
        d.box(0, 0, 10, 10, **admin("4", "not trusted", **{"ISO3166-2": state}))
    d.box(0, 0, 5, 10, **admin("6", "County A"))
    d.box(5, 0, 10, 10, **admin("6", "County B"))
    return d


def area(d, lon1, lat1, lon2, lat2, code, label, **tags):
    d.box(lon1, lat1, lon2, lat2, boundary="postal_code", postal_code=code, note=label, **tags)


def run(spark, d, tmp_path, source=None):
    found = ex.extract(osm.read_xml(spark, d.write(tmp_path / "map.osm")), COUNTRIES["DE"], source)
    return found, [(r["code"], r["city"], r["state"], r["county"], r["source"], r["evidence_count"], r["location_rank"]) for r in found.records.orderBy("code", "location_rank").collect()]


def test_boundary_names_the_city_and_state_is_looked_up(spark, tmp_path):
    d = basis()
    area(d, 1, 1, 2, 2, "28195", "28195 Bremen (Central)")
    d.node(1.5, 1.5, addr__postcode="28195", addr__city="Wrong City")
    found, rows = run(spark, d, tmp_path)
    assert rows == [("28195", "Bremen", "Bremen", "County A", "postal_boundary", 0, 1)]
    assert (found.postal_boundary_count, found.address_candidate_count, found.observed_state_codes) == (1, 1, ("DE-HB",))


def test_addresses_stand_in_from_three_on(spark, tmp_path):
    d = basis()
    for i in range(3):
        d.node(1, 1 + i / 10, addr__postcode="33333", addr__city="Gütersloh")
    d.node(1, 1, addr__postcode="33333")
    for i in range(2):
        d.node(2, 2, addr__postcode="44444", addr__city="Few")
    found, rows = run(spark, d, tmp_path)
    assert rows == [("33333", "Gütersloh", "Bremen", "County A", "address_fallback", 3, 1)]
    assert found.dropped_candidate_count == 1


def test_area_over_two_counties_gives_two_rows(spark, tmp_path):
    d = basis()
    area(d, 4, 1, 6, 2, "28200", "28200 Town")
    assert [(r[3], r[6]) for r in run(spark, d, tmp_path)[1]] == [("County A", 1), ("County B", 2)]


def test_evidence_ranks_cities(spark, tmp_path):
    d = basis()
    area(d, 1, 1, 2, 2, "71540", "71540 Murrhardt, Fichtenberg")
    for i in range(3):
        d.node(1.2, 1.2, addr__postcode="71540", addr__city="Murrhardt")
    d.node(1.3, 1.3, addr__postcode="71540", addr__city="Fichtenberg")
    assert [(r[1], r[5], r[6]) for r in run(spark, d, tmp_path)[1]] == [("Murrhardt", 3, 1), ("Fichtenberg", 1, 2)]


def test_foreign_and_outside_objects_are_dropped(spark, tmp_path):
    d = basis()
    area(d, 9.8, 1, 11, 2, "11111", "11111 Border")
    area(d, 1, 1, 2, 2, "22222", "22222 Abroad", country="FR")
    d.node(1, 1, addr__postcode="33333", addr__city="X", addr__country="FR")
    with pytest.raises(ex.ExtractionError, match="zero valid"):
        run(spark, d, tmp_path)
    area(d, 3, 3, 4, 4, "28195", "28195 Bremen")
    found, rows = run(spark, d, tmp_path)
    assert [r[0] for r in rows] == ["28195"] and found.dropped_candidate_count == 3


def test_state_is_inferred_only_with_its_neighbours(spark, tmp_path):
    source = next(s for s in sources() if s.name == "brandenburg")
    d = Doc()
    d.box(0, 0, 10, 2, **admin("4", "?", **{"ISO3166-2": "DE-BE"}))
    d.box(0, 2, 10, 10, **admin("6", "County"))
    area(d, 1, 4, 2, 5, "14467", "14467 Potsdam")
    found, rows = run(spark, d, tmp_path, source)
    assert rows == [("14467", "Potsdam", "Brandenburg", "County", "postal_boundary", 0, 1)] and found.inferred_state_records == 1
    d = Doc()
    d.box(0, 2, 10, 10, **admin("6", "County"))
    area(d, 1, 4, 2, 5, "14467", "14467 Potsdam")
    found, rows = run(spark, d, tmp_path, source)
    assert rows[0][2] == "" and found.inferred_state_records == 0


def test_no_boundary_raises(spark, tmp_path):
    d = Doc()
    d.node(1, 1, addr__postcode="33333", addr__city="X")
    with pytest.raises(ex.ExtractionError, match="boundary"):
        run(spark, d, tmp_path)


def test_rings_are_stitched_or_refused():
    assert osm.stitch([("outer", [1, 2, 3]), ("outer", [1, 4, 3])]) in ([(True, [1, 4, 3, 2, 1])], [(True, [3, 2, 1, 4, 3])])
    assert osm.stitch([("outer", [1, 2, 3, 1]), ("inner", [7, 8, 9, 7])]) == [(True, [1, 2, 3, 1]), (False, [7, 8, 9, 7])]
    assert osm.stitch([("outer", [1, 2, 3])]) == []
