"""Near-duplicate vectors and connected components against plain versions."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from campaignlake.llm import nn_descent
from campaignlake.llm.components import components

from . import brute


def plain(rows, threshold):
    units = {}
    for at, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array([np.float32(y) for y in v], dtype=np.float64)
            units[at] = (label, x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    links = []
    for a in units:
        for b in units:
            if a < b and units[a][0] == units[b][0] and units[a][1] @ units[b][1] >= threshold:
                links.append((a, b))
    degree = {at: 0 for at in range(len(rows))}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    group = brute.union(links, range(len(rows)))
    smallest = {}
    for at, (i, _, _) in enumerate(rows):
        if at in units:
            smallest[group[at]] = min(i, smallest.get(group[at], i))
    return sorted(
        (i, degree[at], smallest[group[at]] if at in units else i) for at, (i, _, _) in enumerate(rows) if i is not None)


def vectors(seed=1, copies=150):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(24).tolist(), int(i % 3)) for i in range(400)]
    base = rng.standard_normal(24)
    for i in range(copies):  # one large group
        rows.append((1000 + i, (base + 0.07 * rng.standard_normal(24)).tolist(), 1))
    for i in range(40):  # pairs at all distances
        source = np.array(rows[i * 5][1])
        rows.append((2000 + i, (source + (0.01 + 0.02 * i) * rng.standard_normal(24)).tolist(), rows[i * 5][2]))
    rows += [(3000, rows[3][1], 0), (3001, rows[3][1], 0), (3001, rows[3][1], 0), (3002, rows[3][1], 2), (3003, [2 * x for x in rows[3][1]], 0)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, [0.0] * 24, 1), (4003, [None] + [1.0] * 23, 1), (4004, [float("nan")] * 24, 1)]
    rows += [(4005, [float("inf")] + [1.0] * 23, 1), (4006, rows[0][1], None), (None, rows[0][1], 0), (4007, [1e30] * 24, 1), (4008, [1e-30] * 24, 1)]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {"unit": F.lit("x"), "content": F.lit(1), "id": F.lit(2)})


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TILE", 40)
    rows = vectors()
    found = nn_descent.near_vectors(table(spark, rows)).collect()
    assert len(found) == len(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id is not None) == plain(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert nn_descent.near_vectors(table(spark, rows).where("false")).collect() == []


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(500 + i, 501 + i) for i in range(60)]
    links += [(900, 901 + i) for i in range(50)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = {v for link in real for v in link}
    assert {r.vertex: r.component for r in found} == brute.union(real, nodes)
    assert len(found) == len(nodes)
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


def tight_clusters(sizes, seed, label=1):
    """Clusters of cosine about 0.99 inside and 0.94 across; ids follow the clusters."""
    rng = np.random.default_rng(seed)
    base, rows = rng.standard_normal(64), []
    base /= np.linalg.norm(base)
    for size in sizes:
        away = rng.standard_normal(64)
        away -= away @ base * base
        centre = base + 0.226 * away / np.linalg.norm(away)
        for _ in range(size):
            noise = rng.standard_normal(64)
            rows.append((len(rows), (centre + 0.1 * noise / np.linalg.norm(noise)).tolist(), label))
    return rows


def test_full_lists_hide_no_link_to_another_cluster(spark):
    rows = tight_clusters([20, 20], 3)
    expected = plain(rows, 0.93)
    assert len({c for _, _, c in expected}) == 1 and min(n for _, n, _ in expected) > 19
    found = nn_descent.near_vectors(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == expected


def test_projections_alone_join_clusters_with_full_lists(spark, monkeypatch):
    # The audit's own links are left out, so the rounds have to find those between the clusters.
    audit = nn_descent.audit
    monkeypatch.setattr(nn_descent, "audit", lambda *a: audit(*a).where("bridge IS NULL"))
    rows = tight_clusters([150, 150], 5)
    found = nn_descent.near_vectors(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain(rows, 0.93)


def test_hot_group_hides_no_missed_pair(spark, monkeypatch):
    # Leaves so small that most pairs are missed by the projections, beside one group with nearly all links.
    monkeypatch.setattr(nn_descent, "LEAF", 4)
    rows = tight_clusters([250], 7)
    for i in range(40):
        a, b = tight_clusters([1, 1], 100 + i)
        rows += [(1000 + i, a[1], 1), (2000 + i, b[1], 1)]
    found = nn_descent.near_vectors(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain(rows, 0.93)


def test_recalls_count_vectors_alike(spark):
    audited = spark.createDataFrame(
        [(1, 9000, 9000, None), *[(i, 1, 1, None) for i in range(2, 11)], (20, 0, 0, None)],
        "id long, there long, others long, bridge long")
    counted = spark.createDataFrame([(1, 9000), (2, 1)], "id long, links long")
    mean, few = nn_descent.recalls(audited, counted)
    assert abs(mean - 0.2) < 1e-9 and abs(few - 1 / 9) < 1e-9
    assert nn_descent.recalls(audited.where("id = 20"), counted) == (None, None)


def test_saturated_lists_are_doubled(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "WIDEST", 30)
    lists = [(1, 100 + i, 0.95) for i in range(8)] + [(2, 100 + i, 0.95 - 0.01 * i) for i in range(8)]
    lists += [(3, 100 + i, 0.99) for i in range(7)] + [(4, 100 + i, 0.99) for i in range(16)] + [(5, 100, 0.5)]
    lists = spark.createDataFrame(lists, "src long, dst long, cosine double")
    widths = spark.createDataFrame([(4, 16), (5, 16), (6, 16)], "id long, width int")
    found = {r.id: r.width for r in nn_descent.enlarged(lists, widths, 0.93).collect()}
    # Full of links; the widest; wide lists stay so.
    assert found == {1: 16, 4: 30, 5: 16, 6: 16}
    edges = spark.createDataFrame([(s, 200 + i, 0.5 + i / 100, False) for s in (1, 2) for i in range(40)], nn_descent.EDGES)
    kept = nn_descent.best_lists(edges.union(edges), nn_descent.enlarged(lists, widths, 0.93)).groupBy("src").count().collect()
    assert {r.src: r["count"] for r in kept} == {1: 16, 2: 8}


def planted_pairs(n, pairs, seed):
    """`n` unrelated vectors of 32 components, and for the first of them a partner at cosine 0.932 to 0.97."""
    rng = np.random.default_rng(seed)
    unit = rng.standard_normal((n, 32))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    rows = [(i, unit[i].tolist(), int(i % 2)) for i in range(n)]
    for i in range(pairs):
        away = rng.standard_normal(32)
        away -= away @ unit[i] * unit[i]
        cosine = 0.932 + 0.038 * rng.random()
        partner = cosine * unit[i] + math.sqrt(1 - cosine**2) * away / np.linalg.norm(away)
        rows.append((n + i, partner.tolist(), int(i % 2)))
    return rows


def test_planted_pairs_by_a_sampled_audit(spark, monkeypatch):
    # The audit sees every 20th vector only and its own links are left out: the graph has to find the pairs.
    audit = nn_descent.audit
    seen = []

    def watched(vectors, sample, threshold):
        seen.append(sample.count())
        return audit(vectors, sample, threshold).where("bridge IS NULL")

    monkeypatch.setattr(nn_descent, "audit", watched)
    rows = planted_pairs(2400, 400, 11)
    found = nn_descent.near_vectors(table(spark, rows)).collect()
    expected = plain(rows, 0.93)
    assert max(seen) == len(rows) // 20
    links = sum(n for _, n, _ in expected)
    assert links >= 800
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    right = sum(min(got[i][0], n) for i, n, _ in expected)
    assert right >= 0.99 * links and all(got[i][0] <= n for i, n, _ in expected)


def test_no_links_at_all(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(40).tolist(), 0) for i in range(300)]
    assert {r.n_links for r in nn_descent.near_vectors(table(spark, rows)).collect()} == {0}
