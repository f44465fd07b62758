"""Both vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratastar.llm import exact_search, multi_index, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute_force(rows, k, turn=lambda x: x, drop_zero=False, every=20):
    """Per query id a list for each of its vectors."""
    seen = set()
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or (drop_zero and not any(v)):
            continue
        seen.add((i, tuple(float(np.float32(x)) for x in v)))
    out = {}
    for q, a in seen:
        if q % every == 0:
            score = [(sum(turn(x) * turn(y) for x, y in zip(a, b, strict=False)), i) for i, b in seen if (i, b) != (q, a)]
            out.setdefault(q, []).append([(i, s) for s, i in sorted(score, key=lambda x: (-x[0], x[1]))[:k]])
    return {q: sorted(lists) for q, lists in out.items() if any(lists)}


def by_query(df):
    """The lists of every query id; the lists of one id come in any order."""
    ranks = {}
    for r in df.collect():
        ranks.setdefault(r.query_id, {}).setdefault(r.rank, []).append((r.vec_id, r.score))
    out = {}
    for q, by_rank in ranks.items():
        assert sorted(by_rank) == list(range(1, len(by_rank) + 1))
        out[q] = [sorted(by_rank[n]) for n in sorted(by_rank)]
    return out


def ranked(lists):
    """What `by_query` makes of lists: per query and rank, what its lists hold there."""
    return {q: [sorted(one[n] for one in many if n < len(one)) for n in range(max(map(len, many)))] for q, many in lists.items()}


def odd_rows(rng):
    hot = rng.normal(size=8).tolist()
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(1000 + i, hot) for i in range(150)]
    rows += [(2000, None), (2020, []), (2040, [1.0] * 7 + [float("nan")]), (2060, [float("inf")] + [0.0] * 7), (2080, [None] + [1.0] * 7)]
    rows += [(2100, [0.0] * 8), (2120, [1.0, 2.0]), (None, hot), (7, hot), (7, hot), (20, rows[20][1])]
    # Several vectors under one id, a query's among them.
    rows += [(40, rng.normal(size=8).tolist()), (40, (3 * rng.normal(size=8)).tolist()), (41, (5 * rng.normal(size=8)).tolist()), (41, rows[41][1])]
    return rows


def integers(x):
    return int(np.floor(64 * x))


@pytest.mark.parametrize("sizes", [(4096, 1024), (64, 5)])
def test_exact_search_against_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(exact_search, "BLOCK", sizes[0])
    monkeypatch.setattr(exact_search, "QUERIES", sizes[1])
    rows = odd_rows(np.random.default_rng(4))
    df = frame(spark, rows).withColumn("score", F.lit("clash")).withColumn("vector", F.lit(1)).repartition(5)
    assert by_query(exact_search.exact_top_k(df)) == ranked(brute_force(rows, 20, integers))


def test_exact_search_of_large_and_sparse_components(spark):
    rng = np.random.default_rng(5)
    for scale in (1e6, 1e9, 1e30):
        rows = [(i, [float(x) if rng.random() < 0.3 else 0.0 for x in rng.normal(size=6) * scale]) for i in range(60)]
        held = {q: [sorted(((i, max(1 - 2**63, min(2**63 - 1, s))) for i, s in found), key=lambda x: (-x[1], x[0]))[:20] for found in lists] for q, lists in brute_force(rows, 60, integers).items()}
        assert by_query(exact_search.exact_top_k(frame(spark, rows))) == ranked(held)


def test_few_vectors_and_empty_tables(spark):
    for search in (exact_search.exact_top_k, multi_index.nearest):
        assert search(frame(spark, [(20, [1.0, 2.0])])).collect() == []
        assert search(frame(spark, [(20, None)])).collect() == []
        assert search(frame(spark, [])).collect() == []
        assert by_query(search(frame(spark, [(20, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 5.0])])))[20][0][0][0] == 2
    # An empty vector is one of zeros: it takes part where zeros do.
    assert by_query(exact_search.exact_top_k(frame(spark, [(20, []), (3, [2.0]), (2, [-1.0])]))) == {20: [[(2, 0)], [(3, 0)]]}
    assert multi_index.nearest(frame(spark, [(20, []), (3, [2.0]), (2, [-1.0])])).collect() == []


@pytest.mark.parametrize("block", [4096, 40])
def test_multi_index_recall_and_scores(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "QUERIES", block)
    rows = odd_rows(np.random.default_rng(6))
    got = by_query(multi_index.nearest(frame(spark, rows).withColumn("rank", F.lit("clash")).repartition(3)))
    expected = brute_force(rows, 20, drop_zero=True)
    assert got.keys() == expected.keys() and all(len(got[q]) == 20 for q in got)
    met = sum(len({i for pairs in got[q] for i, _ in pairs} & {i for one in lists for i, _ in one}) for q, lists in expected.items())
    assert met >= 0.9 * sum(len({i for one in lists for i, _ in one}) for lists in expected.values())
    all_scores = brute_force(rows, 10**6, drop_zero=True)
    for q, found in got.items():
        true = {(i, round(s, 9)) for one in all_scores[q] for i, s in one}
        assert all((i, round(s, 9)) in true for pairs in found for i, s in pairs)
        if len(expected[q]) == 1:
            single = [pairs[0] for pairs in found]
            assert single == sorted(single, key=lambda x: (-x[1], x[0]))


def test_recall_on_clustered_vectors(spark):
    """Vectors around few centres: the walk passes far fewer of them than on vectors without structure."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.2 * rng.normal(size=16)).tolist()) for i in range(4000)]
    got, expected = by_query(multi_index.nearest(frame(spark, rows))), brute_force(rows, 20)
    met = sum(len({i for (i, _), in got[q]} & {i for i, _ in lists[0]}) for q, lists in expected.items())
    assert met >= 0.9 * 20 * len(expected)


def test_walk_goes_by_falling_sums():
    rng = np.random.default_rng(7)
    q = multi_index.Quantiser(5, (rng.normal(size=(6, 3)), rng.normal(size=(6, 2))))
    counts = rng.integers(0, 4, 36)
    query = rng.normal(size=5)
    sums = {i * 6 + j: query[:3] @ q.halves[0][i] + query[3:] @ q.halves[1][j] for i in range(6) for j in range(6)}
    walked = list(q.walk(query, counts))
    assert [c for c, _ in walked] == [c for c in sorted(sums, key=sums.get, reverse=True) if counts[c]]
    assert all(counts[c] == n for c, n in walked)


def test_blocks_hold_every_centroid():
    counts = np.array([[3, 0], [9000, 4]])
    first, number = multi_index.blocks_of(counts.ravel(), 2)
    assert first.tolist() == [0, 1] and number.tolist() == [1, 3]


def test_best_breaks_ties_by_id():
    row, col = vectors.best(np.array([[1.0, 2.0, 2.0, -np.inf, 2.0]]), np.array([5, 9, 7, 1, 8]), 2, -np.inf)
    assert (row.tolist(), col.tolist()) == ([0, 0], [2, 4])
