import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_graph import graph
from vinework.operators import reach


def ends(edges, hops, starts):
    """Ends of all walks, by enumeration."""
    walks = [(t, (e,), s) for e, s, t in edges if s in starts]
    for _ in range(hops - 1):
        walks = [(t, (*used, e), s0) for node, used, s0 in walks for e, s, t in edges if s == node and e not in used]
    return {(s, t) for t, _, s in walks}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("used", "left"), [(1, 2), (2, 2), (3, 1), (2, 3)])
def test_representatives_avoid_whatever_any_set_avoids(seed, used, left):
    rng = random.Random(seed)
    sets = np.array([rng.sample(range(8), used) for _ in range(60)])
    kept = sets[reach.representatives(sets, left)]
    assert len(kept) <= reach.largest_family(used, left)
    for n in range(left + 1):
        for later in itertools.combinations(range(8), n):
            avoids = lambda family: any(not set(later) & set(row.tolist()) for row in family)  # noqa: E731, B023
            assert avoids(kept) == avoids(sets)


@pytest.mark.parametrize("hops", [1, 2, 3, 5])
def test_ends_equal_enumeration(spark, hops):
    rng = random.Random(hops)
    edges = [(i, rng.randrange(9), rng.randrange(9)) for i in range(22)] + [(50, 3, 3), (51, 3, 3)]
    g = graph(spark, edges)
    starts = g.nodes("N").filter("id < 3")
    expected = ends(edges, hops, {0, 1, 2})
    assert {r.end_id for r in reach.distinct_ends(g, "E", hops, starts).collect()} == {t for _, t in expected}
    found = reach.distinct_ends(g, "E", hops, starts, per_start=True).collect()
    assert {(r.start_id, r.end_id) for r in found} == expected
    everywhere = ends(edges, hops, set(range(9)))
    assert {r.end_id for r in reach.distinct_ends(g, "E", hops).collect()} == {t for _, t in everywhere}


def test_families_of_a_hub_are_bounded(spark, monkeypatch):
    """A hub with many walks in and out keeps a few; small batches show that families go on over batches."""
    n = 400
    edges = [(i, i, 1000) for i in range(n)] + [(n + i, 1000, 2000 + i % 7) for i in range(n)] + [(2 * n + i, 2000 + i, 1000) for i in range(7)]
    g, sizes = graph(spark, edges), []
    plain = reach.cut_lineage

    def measured(df, name):
        out = plain(df, name)
        sizes.append(out.groupBy("end_id").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(reach, "cut_lineage", measured)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = {r.end_id for r in reach.distinct_ends(g, "E", 5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes and all(size <= reach.largest_family(used, 5 - used) for used, size in enumerate(sizes, 1))
    # Five edges: from a leaf over the hub, an end, the hub, an end, the hub; or from the hub or an end.
    assert found == {1000, *range(2000, 2007)}
