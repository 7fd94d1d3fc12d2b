import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.llm.fusion import first, fuse

SCHEMA = "query_id long, chunk_id string, rrf_score double, dense_rank int, fts_rank int, position string"


def brute(rows):
    best = {}
    for q, c, a, b, f in rows:
        old = best.get((q, c), (None, None, None))
        pick = lambda g, x, y: x if y is None else y if x is None else g(x, y)
        a = None if a != a else a
        best[q, c] = (pick(max, old[0], a), pick(min, old[1], b), pick(min, old[2], f))
    out = {}
    for q in {k[0] for k in best}:
        hits = {c: v for (p, c), v in best.items() if p == q}
        ranks = {c: [] for c in hits}
        for i in range(3):
            cost = {c: float("inf") if v[i] is None else -v[i] if i == 0 else v[i] for c, v in hits.items()}
            for c in hits:
                ranks[c].append(1 + sum(x < cost[c] for x in cost.values()))
        fused = {c: round(sum(1 / (60 + r) for r in rs), 12) for c, rs in ranks.items()}
        for c in hits:
            out[q, c] = (*ranks[c], 1 + sum(x > fused[c] for x in fused.values()))
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    ranking = fuse(df, **kw).cache()
    return {(r.query_id, r.chunk_id): (r.rank_rrf_score, r.rank_dense_rank, r.rank_fts_rank, r.position) for r in ranking.collect()}, {tuple(r) for r in first(ranking).collect()}


HITS = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["a", "b", "c", "d", "e", None]), st.sampled_from([None, 0.5, 0.7, 900.0, float("nan"), -1.0]), st.sampled_from([None, 1, 2, 300]), st.sampled_from([None, 1, 7]))


@settings(max_examples=4, deadline=None)
@given(st.lists(HITS, max_size=25))
def test_ranks_nulls_ties_and_repeats(spark, rows):
    ranking, top = got(spark, rows)
    want = brute(rows)
    assert ranking == want
    least = {}
    for (q, c), v in want.items():
        if v[3] == 1:
            least.setdefault(q, []).append(c)
    assert top == {(q, min(cs, key=lambda c: (c is not None, c or ""))) for q, cs in least.items()}


@pytest.mark.parametrize("spread", ["continuous", "ties", "nulls"])
def test_hot_request_in_bins_gives_the_same(spark, spread):
    rnd = random.Random(5)
    value = {"continuous": rnd.random, "ties": lambda: rnd.choice([1.0, 1.0, 1.0, 2.0, 3.5]), "nulls": lambda: rnd.choice([None, None, rnd.random()])}[spread]
    rows = [(1, f"c{i}", value(), rnd.choice([None, rnd.randint(1, 500)]), rnd.randint(1, 90)) for i in range(600)] + [(2, "x", 1.0, 1, 1), (None, "x", 1.0, None, 1)]
    assert got(spark, rows, hot=100)[0] == brute(rows)
