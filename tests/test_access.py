import pytest
from helpers import as_set

from omnibus.operators.access import OPEN_ROLES, Slicer, Viewer, visible
from omnibus.plans.report import SORTS, VISUALS, report_query


@pytest.fixture
def model(rows):
    return {
        "dim_route": rows([("r1", "One"), ("r2", "Two"), ("r3", None)], "route_id string, route_long_name string"),
        "dim_trip": rows([("t1", "r1"), ("t2", "r2"), ("t3", "r3"), ("t4", None)], "trip_id string, route_id string"),
        "dim_stop": rows([("a", "Stop A")], "stop_id string, stop_name string"),
        "fact_schedule": rows([("t1", "a"), ("t2", "a"), ("t3", "b"), ("t4", "a"), ("x", "a")],
                              "trip_id string, stop_id string"),
        "vehicle_activity": rows(
            [("r1", "One", 7, 10, 3), ("r1", "One", 8, 5, 0), (None, None, 7, 2, 1), ("zzz", None, 7, 1, 0)],
            "route_id string, route_name string, activity_hour int, position_pings long, stopped_pings long"),
        "hourly_distribution": rows([(7, "Morning Peak", 4)], "hour_of_day int, time_slot string, total_departures long"),
        "top_routes": rows([(f"r{i}", f"n{i}", 10 - i // 3) for i in range(30)],
                           "route_id string, route_name string, scheduled_trips long"),
        "user_route_access": rows([("dm@x", "r1"), ("dm@x", "r1"), ("other@x", "r2")],
                                  "user_email string, route_id string"),
    }


MANAGER = Viewer("Depot Manager", "dm@x")


def test_manager_sees_mapped_routes_only(model):
    assert as_set(visible(model, "dim_route", viewer=MANAGER), "route_id") == {("r1",)}
    assert as_set(visible(model, "fact_schedule", viewer=MANAGER), "trip_id") == {("t1",)}
    # Mapped twice, but rows are not doubled.
    assert visible(model, "vehicle_activity", viewer=MANAGER).count() == 2
    assert visible(model, "user_route_access", viewer=MANAGER).count() == 2


@pytest.mark.parametrize("email", ["nobody@x", "DM@x", None])
def test_unmapped_user_or_other_case_sees_nothing(model, email):
    viewer = Viewer("Depot Manager", email)
    assert visible(model, "dim_trip", viewer=viewer).count() == 0
    assert visible(model, "user_route_access", viewer=viewer).count() == 0


def test_unrelated_table_is_not_narrowed(model):
    assert visible(model, "hourly_distribution", viewer=MANAGER).count() == 1


@pytest.mark.parametrize("role", OPEN_ROLES)
def test_open_roles_see_everything(model, role):
    assert visible(model, "vehicle_activity", viewer=Viewer(role)).count() == 4


def test_unknown_role_is_refused():
    with pytest.raises(ValueError):
        Viewer("Visitor")


def test_slicers_combine_and_never_travel_up(model):
    stop = Slicer("dim_stop", "stop_name", "in", ("Stop A",))
    named = Slicer("dim_route", "route_long_name", "not_null")
    assert as_set(visible(model, "fact_schedule", [stop, named]), "trip_id") == {("t1",), ("t2",)}
    assert visible(model, "dim_route", [stop]).count() == 3


def test_between_on_own_column(model):
    hours = Slicer("vehicle_activity", "activity_hour", "between", (8, 9))
    assert as_set(report_query(model, "v25", [hours])) == {(5,)}


def test_top_n_keeps_ties(model):
    # The 20th largest value is shared, so 21 route names stay.
    assert report_query(model, "v15").count() == 21


def test_measure_and_pick_list(model):
    assert as_set(report_query(model, "v22")) == {(3, 7), (0, 6), (1, 1)}
    assert as_set(report_query(model, "v17")) == {("One",), ("Two",)}


def test_shown_order(model):
    shown = report_query(model, "v24", in_order=True).collect()
    assert [tuple(r) for r in shown] == [(7, 13), (8, 5)]
    for visual_id, column in SORTS.items():
        visual = VISUALS[visual_id]
        made = {"{}_{}".format(*m) for m in visual.measures} | set(visual.by) | {"not_stopped_pings"}
        assert column.lstrip("-") in made


def test_every_visual_has_a_specification():
    assert list(VISUALS) == [f"v{i:02d}" for i in range(1, 51)]
