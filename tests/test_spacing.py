import datetime as dt
import random

import pytest

from omnibus.operators.spacing import keep_spaced

START = dt.datetime(2026, 1, 1)
HOUR = 3600


def greedy(data, window=HOUR):
    last, kept = {}, set()
    for i, key, at in sorted(data, key=lambda r: (r[2], r[0])):
        if key not in last or (at - last[key]).total_seconds() > window:
            last[key] = at
            kept.add(i)
    return kept


def run(rows, data, limit, window=HOUR):
    df = rows(data, "id long, k string, at timestamp")
    return {r["id"] for r in keep_spaced(df, ["k"], "at", "id", window, limit).collect()}


def minutes(*offsets):
    return [(i, "k", START + dt.timedelta(minutes=m)) for i, m in enumerate(offsets)]


@pytest.mark.parametrize("limit", [4096, 0])
def test_window_edge_is_inside_and_drops_do_not_extend(rows, limit):
    data = minutes(0, 30, 60, 61, 100, 121, 122)
    assert run(rows, data, limit) == {0, 3, 6}


@pytest.mark.parametrize("limit", [4096, 0])
def test_one_microsecond_over(rows, limit):
    data = minutes(0, 60) + [(9, "k", START + dt.timedelta(minutes=60, microseconds=1))]
    assert run(rows, data, limit) == {0, 9}


@pytest.mark.parametrize("limit", [4096, 0])
def test_equal_instants_keep_the_lowest_id(rows, limit):
    data = [(5, "k", START), (2, "k", START), (3, "j", START)]
    assert run(rows, data, limit) == {2, 3}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", [4096, 7, 0])
def test_equals_a_plain_walk(rows, seed, limit):
    """Long dense runs, pauses around the window, copies, and a hot key."""
    rng = random.Random(seed)
    data, clock = [], dict.fromkeys("habc", START)
    steps = [0, 1, 59, 600, 1799, 3599, 3600, 3601, 9000] if seed % 2 else [0, 5, 20, 90, 300]
    for i in range(500):
        key = rng.choice("hhhhhabc")
        clock[key] += dt.timedelta(seconds=rng.choice(steps), microseconds=rng.choice([0, 1, 500_000]))
        data.append((i, key, clock[key]))
    assert run(rows, data, limit) == greedy(data)


def test_other_windows(rows):
    rng = random.Random(9)
    data = [(i, rng.choice("ab"), START + dt.timedelta(seconds=rng.randrange(3000))) for i in range(300)]
    for window in (1, 7, 61):
        assert run(rows, data, 5, window) == greedy(data, window)


@pytest.mark.parametrize("limit", [4096, 0])
def test_more_kept_points_than_a_block_holds(rows, limit):
    # No pause restarts the run, and every second point is kept.
    data = minutes(*[31 * i for i in range(1500)])
    assert run(rows, data, limit) == greedy(data) and len(greedy(data)) == 750
