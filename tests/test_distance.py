import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import plan_of
from veloclima.functions import ellipsoid_metres, geodesic
from veloclima.functions.geodesic import EQUATOR_RADIUS_M, FLATTENING
from veloclima.operators import add_cost, add_distance


def metres(*points):
    a = np.array(points, dtype=float).T
    with np.errstate(all="ignore"):
        return ellipsoid_metres(*a)


def dms(degrees, minutes, seconds):
    return math.copysign(abs(degrees) + minutes / 60 + seconds / 3600, degrees)


def arc_of_meridian(lat1, lat2, n=20_000):
    """Simpson's rule over the meridian's radius of curvature; no geodesic formula."""
    e2 = FLATTENING * (2 - FLATTENING)
    phi = np.radians(np.linspace(lat1, lat2, 2 * n + 1))
    radius = EQUATOR_RADIUS_M * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5
    h = (phi[-1] - phi[0]) / (2 * n)
    return abs(
        h / 3 * (radius[0] + radius[-1] + 4 * radius[1::2].sum() + 2 * radius[2:-1:2].sum())
    )


def test_published_line():
    flinders = (dms(-37, 57, 3.72030), dms(144, 25, 29.52440))
    buninyong = (dms(-37, 39, 10.15610), dms(143, 55, 35.38390))
    assert metres((*flinders, *buninyong))[0] == pytest.approx(54972.271, abs=5e-4)


def test_known_points_in_spark(make_trips):
    cases = [
        ((0.0, 0.0, 0.0, 1.0), 111319.49),
        ((41.6, -87.6, 42.1, -87.6), 55535.19),
        ((41.88, -87.63, 0.0, 0.0), 9814592.21),
        ((41.88, -87.63, 41.88, -87.63), 0.0),
        ((90.0, 0.0, 90.0, 120.0), 0.0),
        ((0.0, 179.5, 0.0, -179.5), 111319.49),  # over the date line, the short way
        ((41.88, -87.63, -41.5, 92.0), 19955893.9),  # nearly antipodal
        ((0.0, 0.0, 0.0, 180.0), 20003931.46),  # over a pole
        ((0.0, 0.0, 0.5, 179.7), 19944127.42),
        ((91.0, 0.0, 41.0, 0.0), None),
        ((41.0, 0.0, float("nan"), 0.0), None),
        ((None, 0.0, 41.0, 0.0), None),
    ]
    names = ("start_lat", "start_lng", "end_lat", "end_lng")
    trips = make_trips(*[dict(zip(names, point, strict=True)) for point, _ in cases])
    got = {int(r.ride_id): r.distance for r in add_distance(trips).collect()}
    assert [got[n] for n in range(len(cases))] == [want for _, want in cases]


def test_same_place_costs_the_base_fee(make_trips):
    trips = make_trips({"end_lat": 41.88, "end_lng": -87.63})
    row = add_cost(add_distance(trips)).first()
    assert (row.distance, row.cost) == (0.0, 1.0)


@pytest.mark.parametrize("span", [(41.6, 41.60001), (41.6, 42.1), (-35.0, 60.0), (0.0, 89.9)])
def test_meridian_against_numeric_integral(span):
    got = metres((span[0], 12.0, span[1], 12.0))[0]
    assert got == pytest.approx(arc_of_meridian(*span), abs=2e-6 + 1e-11 * got)


def test_equator_against_circle():
    want = EQUATOR_RADIUS_M * math.radians(30)
    assert metres((0, 5, 0, 35))[0] == pytest.approx(want, abs=1e-5)


latitudes, longitudes = st.floats(-80, 80), st.floats(-179, 179)


@settings(max_examples=200, deadline=None)
@given(latitudes, longitudes, st.floats(-5, 5), st.floats(-5, 5))
def test_symmetry_and_rotation(lat, lng, north, east):
    there, back, moved = metres(
        (lat, lng, lat + north, lng + east),
        (lat + north, lng + east, lat, lng),
        (lat, lng + 360, lat + north, lng + east - 360),
    )
    assert there == pytest.approx(back, abs=1e-6)
    assert there == pytest.approx(moved, abs=1e-6)


def globe(seed, n):
    rng = np.random.default_rng(seed)
    lat1, lat2 = np.degrees(np.arcsin(rng.uniform(-1, 1, (2, n))))
    lng1, lng2 = rng.uniform(-180, 180, (2, n))
    near = np.arange(n) % 4 == 0  # every fourth pair nearly antipodal
    lat2 = np.where(near, np.clip(-lat1 + rng.normal(0, 0.3, n), -90, 90), lat2)
    lng2 = np.where(near, lng1 + 180 + rng.normal(0, 0.3, n), lng2)
    return np.column_stack([lat1, lng1, lat2, lng2])


def test_no_valid_pair_is_without_an_answer():
    got = metres(*globe(1, 40_000))
    assert np.isfinite(got).all()
    assert got.max() <= 20_003_931.46  # half a meridian


def test_the_two_methods_agree():
    points = globe(2, 4_000)[np.arange(4_000) % 4 != 0]
    sin1, cos1 = geodesic._reduced(points[:, 0])
    sin2, cos2 = geodesic._reduced(points[:, 2])
    turn = points[:, 3] - points[:, 1]
    apart = np.radians(turn - 360 * np.rint(turn / 360))
    first, settled, _ = geodesic._vincenty(sin1, cos1, sin2, cos2, apart)
    second = geodesic._searched(sin1, cos1, sin2, cos2, apart)
    assert settled.mean() > 0.99
    assert np.abs(first - second)[settled].max() < 1e-3


def test_long_lines_are_shortest():
    """No detour over a third point is shorter: catches a wrong branch near the antipode."""
    points = globe(3, 400)
    whole = metres(*points)
    rng = np.random.default_rng(4)
    for _ in range(20):
        via = np.column_stack([rng.uniform(-89, 89, 400), rng.uniform(-180, 180, 400)])
        detour = metres(*np.hstack([points[:, :2], via])) + metres(*np.hstack([via, points[:, 2:]]))
        assert (detour >= whole - 1e-3).all()


def test_a_row_does_not_depend_on_its_batch():
    points = globe(5, 600)
    together = metres(*points)
    alone = np.array([metres(p)[0] for p in points])
    assert (together == alone).all()


def test_only_coordinates_go_to_python(make_trips):
    plan = plan_of(add_distance(make_trips({})))
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan
