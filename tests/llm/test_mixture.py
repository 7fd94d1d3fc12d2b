import random

from lexharbor.llm.mixture import REACHABLE, mix, rates, shares


def tables(spark):
    docs = [(i, "words of a text here " * (1 + i % 3), " Big" if i % 2 else "big", "x") for i in range(600)]
    docs += [(1000 + i, "small text ", "small", "x") for i in range(30)] + [(2000, None, "small", "x"), (2001, "", "big", "x"), (2002, "words", None, "x"), (2003, "words " * 9, "elsewhere", "x")]
    docs += [(3000 + i, "middle of it all " * 4, "MID", "x") for i in range(150)]
    targets = [("big", 0.5, 1), ("Small ", 0.2, 3), ("mid", 0.2, 4), ("none", 0.1, 2), (None, 0.3, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, source string, copy string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_caps_shares_and_reports(spark):
    docs, targets = tables(spark)
    rows = mix(docs, targets).collect()
    uses = {}
    for r in rows:
        uses.setdefault((r.source, r.doc_id), []).append(r.copy)
    cap = {"big": 1, "small": 3, "mid": 4}
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= cap[s] for (s, _), c in uses.items())
    told = {r.source: r for r in shares(docs, targets).collect()}
    assert set(told) == {"big", "small", "mid", "none"}
    total = sum(r.n_tokens for r in rows)
    for s, r in told.items():
        tokens = sum(x.n_tokens for x in rows if x.source == s)
        assert r.mixed_tokens == tokens and abs(r.actual_share - tokens / total) < 1e-12
        assert r.most_uses == max((len(c) for (t, _), c in uses.items() if t == s), default=0)
    assert told["small"].rate == 3.0  # used up: it falls short
    assert all(len(c) == 3 for (s, _), c in uses.items() if s == "small")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(docs.repartition(7), targets).collect()))
    assert sorted(map(tuple, rows)) != sorted(map(tuple, mix(docs, targets, seed=1).collect()))


def test_reachable_total_meets_the_shares(spark):
    docs, targets = tables(spark)
    told = {r.source: r for r in shares(docs, targets, REACHABLE).collect()}
    assert told["small"].rate == 3.0
    for s, want in (("big", 0.5 / 0.9), ("small", 0.2 / 0.9), ("mid", 0.2 / 0.9)):
        assert abs(told[s].actual_share - want) < 0.1


def test_nulls_in_any_column(spark):
    docs = spark.createDataFrame([(None, "some words", "a", "x"), (None, "some words", "a", "x"), (3, None, "A ", "x"), (4, "more words", None, "x")], "doc_id long, text string, source string, copy string")
    targets = spark.createDataFrame([("a", None, 2), ("b", 0.5, None), ("a ", 0.5, None), (None, None, None), ("c", -1.0, -1)], "source string, target_share double, max_repeats int")
    told = {r.source: r for r in shares(docs, targets).collect()}
    assert set(told) == {"a", "b", "c"} and told["a"].max_repeats == 1 and told["a"].documents == 3 and told["c"].rate == 0
    assert {(r.doc_id, r.source) for r in mix(docs, targets).collect()} <= {(None, "a"), (3, "a")}


def test_empty_tables(spark):
    docs, targets = tables(spark)
    assert mix(docs.limit(0), targets).count() == 0
    assert mix(docs, targets.limit(0)).count() == 0
    assert all(r.actual_share == 0 for r in shares(docs.limit(0), targets).collect())


def brute_fill(sources, total):
    """Water filling: the level is found by bisection."""
    taken = lambda t: {s: min(share * t / n, cap) if share and n and cap else 0.0 for s, (share, cap, n) in sources.items()}
    reached = lambda t: sum(r * sources[s][2] for s, r in taken(t).items())
    low, high = 0.0, 1e12
    for _ in range(200):
        low, high = ((low + high) / 2, high) if reached((low + high) / 2) < total else (low, (low + high) / 2)
    return taken(high)


def test_filled_rates_against_bisection(spark):
    rnd = random.Random(3)
    for _ in range(6):
        sources = {f"s{i}": (rnd.choice([0.0, 0.1, 0.2, 0.4]), rnd.randint(0, 3), rnd.choice([0, 5, 50, 700])) for i in range(6)}
        sizes = spark.createDataFrame([(i, s, n) for i, (s, (_, _, n)) in enumerate(sources.items()) if n] + [(99, None, 3)], "doc_id long, source string, n_tokens long")
        targets = spark.createDataFrame([(s, share, cap) for s, (share, cap, _) in sources.items()], "source string, target_share double, max_repeats int")
        for total in (None, 40.0, 1e6):
            got = {r.source: r.rate for r in rates(sizes, targets, total, fill=True).collect()}
            want = brute_fill(sources, total or sum(n for _, _, n in sources.values()) + 3)
            assert all(abs(got[s] - want[s]) < 1e-6 for s in want), (sources, total, got, want)


def test_filled_mixture_reaches_the_total(spark):
    docs, targets = tables(spark)
    plain, filled = ({r.source: r for r in shares(docs, targets, fill=f).collect()} for f in (False, True))
    assert filled["small"].rate == 3.0 and filled["big"].rate >= plain["big"].rate and filled["mid"].rate > plain["mid"].rate
