"""Window and flank features against the closed form, gene by gene."""

import random

import pytest

from virelay.operators import context

SCHEMA = "contig string, n long, len long, v double"
PLACE = {"contig": ("contig",), "number": "n", "length": "len"}


def brute(genes, window, pct, flank, least):
    out = {}
    for c in {g[0] for g in genes}:
        own = sorted(g for g in genes if g[0] == c)
        s, at = [], 0
        for g in own:
            s.append(at)
            at += g[2]
        e = [a + g[2] for a, g in zip(s, own)]
        for i, g in enumerate(own):
            near = [j for j in range(len(own)) if j == i or (j < i and s[i] - s[j] <= window) or (j > i and s[j] - e[i] < window)]
            known = [own[j] for j in near if own[j][3] is not None]
            share = 100 * sum(x[2] for x in known) / sum(own[j][2] for j in near)
            mean = sum(x[3] for x in known) / len(known) if known and share >= pct else None
            up = any(own[j][3] is not None and own[j][3] >= least and s[i] - s[j] <= flank for j in range(i))
            down = any(own[j][3] is not None and own[j][3] >= least and s[j] - e[i] <= flank for j in range(i + 1, len(own)))
            out[c, g[1]] = (mean, up, down)
    return out


@pytest.mark.parametrize("window,pct,flank", [(1, 0, 0), (7, 50, 3), (13, 60, 13), (1000, 20, 1000)])
def test_equals_closed_form(spark, window, pct, flank):
    r = random.Random(window)
    genes = [(f"c{c}", n, r.randint(1, 9), None if r.random() < 0.4 else float(r.randint(0, 10))) for c in range(40) for n in range(1, r.randint(2, 15))]
    df = spark.createDataFrame(genes, SCHEMA)
    df = context.score_flanks(context.window_means(df, ["v"], window, pct, **PLACE), ["v"], flank, 8, **PLACE)
    want = brute(genes, window, pct, flank, 8)
    for r in df.collect():
        mean, up, down = want[r.contig, r.n]
        assert (r.v_flank_up, r.v_flank_down) == (up, down)
        assert r.window_avg_v == (pytest.approx(mean) if mean is not None else None)


def test_distances_at_the_bounds(spark):
    """Left genes must lie wholly inside; right ones start inside (mean) or at the bound (flank)."""
    df = spark.createDataFrame([("c", 1, 10, 9.0), ("c", 2, 10, None), ("c", 3, 100, 9.0)], SCHEMA)
    flags = {w: {r.n: (r.v_flank_up, r.v_flank_down) for r in context.score_flanks(df, ["v"], w, 9.0, **PLACE).collect()} for w in (0, 9, 10)}
    assert flags[10][2] == (True, True) and flags[9][2] == (False, True) and flags[0][2] == (False, True)
    mean = {w: {r.n: r.window_avg_v for r in context.window_means(df, ["v"], w, 0.0, **PLACE).collect()} for w in (1, 10)}
    assert mean[1][2] == 9.0 and mean[10][1] == 9.0


def test_single_gene_and_no_scores(spark):
    df = spark.createDataFrame([("a", 1, 5, None), ("b", 1, 5, 2.0)], SCHEMA)
    got = {r.contig: r for r in context.score_flanks(context.window_means(df, ["v"], 10, 1.0, **PLACE), ["v"], 10, 1.0, **PLACE).collect()}
    assert got["a"].window_avg_v is None and got["b"].window_avg_v == 2.0
    assert not got["b"].v_flank_up and not got["b"].v_flank_down


def test_lengths_below_one_raise(spark):
    df = spark.createDataFrame([("a", 1, 0, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="gene lengths"):
        context.window_means(df, ["v"], 10, 1.0, **PLACE).collect()


def test_set_membership_never_multiplies_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y")], "k string, id string")
    ids = spark.createDataFrame([("x",), ("x",), (None,)], "id string")
    assert {r.k: r.m for r in context.in_set(df, ids, "id", "m").collect()} == {"a": True, "b": False, "c": False}
