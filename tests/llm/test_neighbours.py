import datetime as dt

import numpy as np
import pytest

from lexharbor.llm import neighbours
from lexharbor.llm.neighbours import Setting, fit, pairs, similar, unit

T = dt.datetime(2025, 1, 1)
SCHEMA = "chunk_id string, embedding_dim int, v array<float>, created_at timestamp, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, d, v, T + dt.timedelta(days=n), "clash") for i, d, v, n in rows], SCHEMA)


def topics(n, dim, seed, k=9):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(k, dim))
    return (middle[rng.integers(0, k, n) ** 2 % k] + 0.5 * rng.normal(size=(n, dim))) * rng.uniform(0.01, 50, (n, 1))


def brute(vectors, k):
    ids = sorted(vectors)
    x = unit(np.array([vectors[i] for i in ids], np.float32))
    cos = np.round((x.astype(np.float64) @ x.T.astype(np.float64)), 6)
    return {i: [ids[j] for j in np.lexsort((np.arange(len(ids)), -cos[a])) if j != a][:k] for a, i in enumerate(ids)}


def got(df, **kw):
    out = {}
    for r in sorted(similar(df, **kw).collect(), key=lambda r: (r.item, r.rank)):
        out.setdefault(r.item, []).append(r.neighbour)
    return out


@pytest.mark.parametrize("s", [Setting(), Setting(list_size=40, ask_ratio=1.6, lists=40, beam=40), Setting(list_size=40, ask_ratio=9, lists=40, beam=64, block=7, ask_block=11)])
def test_recall_against_brute_force(spark, s):
    v = {f"c{i:04d}": [float(np.float32(x)) for x in row] for i, row in enumerate(topics(900, 8, 1))}
    df = frame(spark, [(i, 8, x, 0) for i, x in v.items()])
    mine, want = got(df, dim=8, s=s), brute(v, 5)
    assert set(mine) == set(want) and all(len(n) == 5 and i not in n for i, n in mine.items())
    recall = np.mean([len(set(mine[i]) & set(want[i])) / 5 for i in want])
    assert recall > (0.999 if s.block == 7 else 0.97)


def test_copies_of_a_third_and_small_classes(spark):
    v = {f"c{i:04d}": [float(np.float32(x)) for x in row] for i, row in enumerate(topics(300, 8, 2))}
    for i in range(100):
        v[f"a{i:03d}"] = [0.0, 2.0] + [0.0] * 6
    for i in range(3):
        v[f"d{i}"] = [0.0] * 4 + [4.0 * 2**i] + [0.0] * 3
    df = frame(spark, [(i, 8, x, 0) for i, x in v.items()])
    mine = got(df, dim=8, s=Setting(list_size=60, ask_ratio=9, lists=40))
    want = brute(v, 5)
    assert mine["a050"] == ["a000", "a001", "a002", "a003", "a004"] and mine["a002"] == ["a000", "a001", "a003", "a004", "a005"]
    assert mine["d1"][:2] == ["d0", "d2"] and len(mine["d1"]) == 5
    assert np.mean([set(mine[i]) == set(want[i]) for i in want]) > 0.99


def test_unusable_repeated_and_few(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 2, [1.0, 0.0], 0), ("a", 2, [1.0, 0.0], 0), ("b", 2, [1.0, 0.1], 0), ("b", 2, [0.0, 1.0], 5), ("c", 2, [0.1, 1.0], 0), ("c", 3, [1.0, 0.0, 0.0], 9)]
    rows += [("z", 2, [0.0, -0.0], 0), ("n", 2, [nan, 1.0], 0), ("i", 2, [inf, 1.0], 0), ("s", 2, [1.0], 0), ("e", 2, [], 0), ("u", 2, None, 0), ("x", 2, [None, 1.0], 0), (None, 2, [1.0, 1.0], 0), ("w", None, [1.0, 1.0], 0), ("q", 3, [1.0, 1.0], 0)]
    df = frame(spark, rows)
    assert got(df, dim=2) == {"a": ["c", "b"], "b": ["c", "a"], "c": ["b", "a"]}
    found = pairs(similar(df, k=1, dim=2))
    assert found.columns == ["chunk_id_a", "chunk_id_b"] and {tuple(r) for r in found.collect()} == {("a", "c"), ("b", "c")}
    assert similar(df.limit(0), dim=2).count() == 0
    assert similar(df.where("chunk_id = 'a'"), dim=2).count() == 0
    assert got(frame(spark, [("p", 2, [1e30, 1e30], 0), ("q", 2, [1e-30, 1e-30], 0)]), dim=2) == {"p": ["q"], "q": ["p"]}


def test_the_graph_finds_the_nearest_centroids():
    x = unit(topics(6000, 16, 3, 40))
    lists = fit(x, len(x), Setting(list_size=24))
    assert len(lists.centroids) > 200
    ids, _ = lists.search(x[:1000], 48)
    assert (ids[:, 0] == (x[:1000] @ lists.centroids.T).argmax(axis=1)).mean() > 0.97
    sizes = np.bincount((x @ lists.centroids.T).argmax(axis=1))
    assert sizes.max() < 5 * 24


def test_exact_asks_all_lists(spark):
    v = {f"c{i:04d}": [float(np.float32(x)) for x in row] for i, row in enumerate(topics(700, 8, 5))}
    df = frame(spark, [(i, 8, x, 0) for i, x in v.items()])
    s = Setting(list_size=20, lists=1, ask_ratio=1.0, replicas=1, beam=4, block=9, ask_block=13)
    mine, rough, want = got(df, dim=8, s=s, exact=True), got(df, dim=8, s=s), brute(v, 5)
    assert mine == want and rough != want


def test_searches_with_and_without_a_table_of_the_seen_agree(monkeypatch):
    x = unit(topics(4000, 16, 6, 40))
    lists = fit(x, len(x), Setting(list_size=16))
    with_table = lists.search(x[:500], 24)
    monkeypatch.setattr(neighbours, "SEEN", 10)
    without = lists.search(x[:500], 24)
    assert len(lists.centroids) > 200 and np.array_equal(with_table[0], without[0])
    assert all(len(set(row)) == len(row) for row in without[0].tolist())


def test_many_large_classes_are_joined_by_salts(spark, monkeypatch):
    rows = [(f"a{c:02d}{i:02d}", 2, [float(c), 1.0], 0) for c in range(12) for i in range(9)]
    sent = got(frame(spark, rows), dim=2)
    monkeypatch.setattr(neighbours, "MOST_SENT", 3)
    assert got(frame(spark, rows), dim=2) == sent and len(sent) == 108 and all(len(n) == 5 for n in sent.values())
