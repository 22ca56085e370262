"""Errors inside errors."""

import random

from lodestone.operators.failures import classified, root_numbers

DDL = "error_id long, orig_id long, cause_id long, number long, is_timeout boolean, text string"


def found(frame, *rows):
    return {r.error_id: (r.errno, r.error_class, r.retryable) for r in classified(frame(DDL, *[(*r, "x") for r in rows])).collect()}


def test_the_first_number_on_the_chain_counts(frame):
    got = found(
        frame,
        (1, None, 2, None, False),
        (2, None, 3, 1045, False),
        (3, None, None, 2006, False),
        # What the driver's error holds goes before what it was raised from.
        (4, 3, 2, None, False),
        (5, None, 99, None, None),
        (6, None, 3, None, True),
        # One that only wraps a timeout is judged by its chain.
        (7, None, 6, None, False),
        (8, None, 8, None, False),
        (9, None, None, 0, False),
        (None, None, 3, 1203, False),
        (None, None, 3, None, True),
    )
    assert got.pop(None) in {(1203, "connection_limit", True), (None, "timeout", True)}
    assert got == {
        1: (1045, "definitive", False), 2: (1045, "definitive", False), 3: (2006, "server_restart", True), 4: (2006, "server_restart", True),
        5: (None, "definitive", False), 6: (2006, "timeout", True), 7: (2006, "server_restart", True), 8: (None, "definitive", False),
        9: (0, "definitive", False),
    }


def test_chains_of_any_shape(frame):
    rng = random.Random(2)
    rows = {i: (rng.choice([None, rng.randint(0, 420)]), rng.randint(0, 420), rng.choice([None] * 12 + [1040, 1053, 7])) for i in range(400)}
    # One chain of 300 errors, and most others wrapping its head; a circle of 50.
    rows |= {i: (None, i + 1 if i < 799 else None, 1226 if i == 799 else None) for i in range(500, 800)}
    rows |= {i: (None, 500, None) for i in range(1_000, 1_600)}
    rows |= {i: (None, 2_000 + (i + 1) % 50, None) for i in range(2_000, 2_050)}
    expected = {}
    for i in rows:
        at, seen = i, set()
        while at in rows and at not in seen and rows[at][2] is None:
            seen.add(at)
            orig, cause, _ = rows[at]
            at = cause if orig is None else orig
        expected[i] = rows[at][2] if at in rows else None
    df = frame("error_id long, orig_id long, cause_id long, number long", *[(i, *r) for i, r in rows.items()])
    assert {r.error_id: r.number for r in root_numbers(df).collect()} == expected
    assert expected[500] == expected[1_599] == 1226 and expected[2_000] is None


def test_no_errors_and_repeated_ones(frame):
    assert found(frame) == {}
    df = frame(DDL, (1, None, 2, None, False, "x"), (1, None, 2, None, False, "x"), (2, None, None, 2013, False, "x"))
    rows = classified(df)
    assert rows.count() == 3 and {r.error_class for r in rows.collect()} == {"server_restart"}
