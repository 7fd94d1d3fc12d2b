import datetime as dt
import random

from lexharbor.operators.snapshots import snapshot_changes

SCHEMA = "snapshot_no int, corpus_id string, external_id string, hash_sha256 string, loaded_at timestamp, updated_at timestamp, change string"
T = dt.datetime(2025, 1, 1)
A, B = "ab" * 32, "cd" * 32


def run(spark, rows):
    df = spark.createDataFrame([(*r[:5], T, "clash") for r in rows], SCHEMA)
    got = [tuple(r) for r in snapshot_changes(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def at(days):
    return T + dt.timedelta(days=days)


def test_added_removed_changed_and_back_again(spark):
    rows = [(n, "c", "stays", A, at(n)) for n in (1, 2, 3, 4)]
    rows += [(1, "c", "gap", A, at(1)), (4, "c", "gap", A, at(4)), (2, "c", "new", A, at(2)), (3, "c", "new", B, at(3)), (4, "c", "new", B, at(4))]
    assert run(spark, rows) == {(2, "c", "gap", "removed"), (4, "c", "gap", "added"), (2, "c", "new", "added"), (3, "c", "new", "changed")}


def test_last_loaded_row_holds_and_spelling_is_no_change(spark):
    rows = [(1, "c", "x", A, at(1)), (2, "c", "x", "sha256:" + A.upper(), at(9)), (2, "c", "x", B, at(2)), (2, "c", "x", B, at(2))]
    rows += [(3, "c", "x", "0x" + " ".join([A[:32], A[32:]]), at(3))]
    assert run(spark, rows) == set()
    rows[1] = (2, "c", "x", A, at(1))
    assert run(spark, rows) == {(2, "c", "x", "changed"), (3, "c", "x", "changed")}


def test_nulls_ties_gaps_in_numbers_and_empty(spark):
    rows = [(1, "c", "x", None, at(1)), (5, "c", "x", None, at(5)), (9, "c", "x", A, None), (9, "c", "x", A, None), (None, "c", "y", A, at(1))]
    rows += [(n, None, None, A, at(n)) for n in (1, 9)]
    assert run(spark, rows) == {(9, "c", "x", "changed"), (5, None, None, "removed"), (9, None, None, "added")}
    assert run(spark, [(1, "c", "x", A, at(1))]) == set()
    assert run(spark, []) == set()


def test_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 5), rnd.choice("ab"), str(rnd.randint(0, 12)), rnd.choice([None, A, B, A.upper()]), at(rnd.randint(0, 400) + i / 1e3)) for i in range(120)]
    held = {}
    for r in sorted(rows, key=lambda r: r[4]):
        held[r[:3]] = r[3] and r[3].lower()
    want = set()
    for n in range(2, 6):
        for c, x in {k[1:] for k in held}:
            old, new = held.get((n - 1, c, x), 0), held.get((n, c, x), 0)
            if old != new:
                want.add((n, c, x, "added" if old == 0 else "removed" if new == 0 else "changed"))
    assert run(spark, rows) == want
