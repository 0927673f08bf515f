"""Nearest neighbours and near-duplicate embeddings against brute force."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from feescope.llm import ann_search as A
from feescope.llm import hnsw_dedup as H
from feescope.llm.common import table
from feescope.llm.registry import op7_nearest_neighbours, op8_embedding_dedup

from llm_fixtures import SF01

SCHEMA = "vec_id long, embedding array<float>, label int, score double"
BAD = [(900, None, 1, 0.0), (901, [], 1, 0.0), (902, [0.0] * 4, 1, 0.0), (903, [1.0, None, 0.0, 0.0], 1, 0.0),
       (904, [float("nan"), 1.0, 0.0, 0.0], 1, 0.0), (905, [float("inf"), 1.0, 0.0, 0.0], 1, 0.0)]


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute_nearest(rows, queries, k):
    good = [(i, np.array(v, float)) for i, v in rows if usable(v) and i is not None]
    out = []
    for q in queries:
        for x in {tuple(v) for i, v in good if i == q}:
            x = np.array(x)
            near = sorted((float(np.sqrt(np.cumsum((x - v) ** 2)[-1])), i) for i, v in good if i != q and len(v) == len(x))[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def test_nearest_of_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF01, "embeddings").collect()]
    got = sorted(map(tuple, op7_nearest_neighbours(spark, SF01).collect()))
    want = brute_nearest(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == pytest.approx(w[3], rel=1e-14) for g, w in zip(got, want))


@pytest.mark.parametrize("block", [3, 64])
def test_nearest_edges(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.integers(-2, 3, 4)], 1, 0.0) for i in range(60)]  # many ties, some zero
    big = [float(np.float32(c)) for c in (1e-30, 1e30, 0.0, 1.0)]
    rows += [(100, [1.0, 2.0], 1, 0.0), (101, [1.0, 2.5], 1, 0.0), (102, big, 1, 0.0), *BAD, (5, rows[5][1], 1, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = df.where("vec_id in (0, 5, 10, 15, 100, 102, 902, 904)")
    got = sorted(map(tuple, A.nearest_neighbours(queries, df, 7, block).collect()))
    want = brute_nearest([r[:2] for r in rows], [0, 5, 10, 15, 100, 102, 902, 904], 7)
    assert got == want and [g[2] for g in got if g[0] == 100] == [101]
    assert A.nearest_neighbours(queries.limit(0), df).count() == 0
    assert A.nearest_neighbours(queries, df.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1e139, 1e155, 1e200, 1e300, 5e307])
def test_huge_components_overflow_nothing(scale):
    """Finite vectors whose squares overflow; some near 1 beside them."""
    import math
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (60, 8)) * scale
    x[40:] = rng.uniform(-1, 1, (20, 8))
    ids = np.arange(60)
    s = A.TileSearch(ids[:50], x[:50], 5)
    for lo in range(0, 60, 20):
        s.add(ids[lo:lo + 20], x[lo:lo + 20])
    for q in range(50):
        want = sorted((math.dist(x[q] / scale, x[i] / scale), i) for i in range(60) if i != q)[:5]
        got = sorted((-d, -i) for d, i in s.heaps[q])
        assert [d / scale for d, _ in got] == pytest.approx([d for d, _ in want], abs=1e-12)
        if q < 40:
            assert [i for _, i in got if i < 40] == [i for _, i in want if i < 40]


def random_vectors(seed, n=300, dim=5):
    """Clusters, exact copies and lengths over many powers of ten."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, dim))[rng.integers(0, 12, n)] + rng.choice([0, 1e-9, 1e-3, 0.3], (n, 1)) * rng.normal(size=(n, dim))
    return (x * 10.0 ** rng.choice([0, 0, 0, -30, -4, 5, 30], (n, 1))).astype(np.float32)


@pytest.mark.parametrize("group_bytes,part_bytes", [(1 << 30, 1 << 30), (700, 1 << 30), (1 << 30, 900), (700, 900)])
def test_nearest_over_groups_and_parts(spark, group_bytes, part_bytes):
    """However queries and candidates are dealt."""
    x = random_vectors(1)
    rows = [(i, [float(c) for c in v], 1, 0.0) for i, v in enumerate(x)]
    rows += [(400 + i, [1.0 + i, 2.0], 1, 0.0) for i in range(15)]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = df.where("vec_id % 10 = 0")
    got = A.nearest_neighbours(queries, df, 6, 32, group_bytes, part_bytes)
    want = brute_nearest([r[:2] for r in rows], range(0, 420, 10), 6)
    assert sorted(map(tuple, got.collect())) == want


def test_no_vector_is_in_a_broadcast(spark):
    """A join that Spark takes for small held the copies of all query blocks, one for each candidate block."""
    df = spark.createDataFrame([(i, [float(c) for c in v], 1, 0.0) for i, v in enumerate(random_vectors(1))], SCHEMA)
    got = A.nearest_neighbours(df.where("vec_id % 10 = 0"), df, 6)
    assert got.count() == 180 and "Broadcast" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("n", [300, 1 << 20, 1 << 24, 1 << 30])
def test_cells_keep_to_a_worker_and_queries_travel_little(n):
    """A hundredth of the vectors are queries; their copies stay within a few times the table up to its thousandfold."""
    groups, parts = A.grid(n // 100, n // 100 * 64, n, n * 64, 10, 4, 12)
    assert n // 100 * (64 * 5 + 160) <= groups * A.GROUP_BYTES and n * 64 * 4 <= parts * A.PART_BYTES
    assert parts <= max(12, -(-n * 256 // A.PART_BYTES)) and groups <= max(1, n // 100 * 480 // A.GROUP_BYTES + 1)
    assert groups * parts >= min(12, -(-n // A.BLOCK_ROWS))


@pytest.mark.parametrize("seed,tile", [(2, 7), (3, 64), (4, 300), (5, 1)])
def test_tiles_lose_no_neighbour(seed, tile):
    x = random_vectors(seed, dim=1 + 9 * (seed % 3))
    ids = np.random.default_rng(seed).permutation(len(x))
    ids[:4] = ids[4:8]  # repeated ids
    s = A.TileSearch(ids[:90], x[:90], 5)
    for at in range(0, len(x), tile):
        s.add(ids[at:at + tile], x[at:at + tile], rows=32)
    for q in range(90):
        d = A.exact_distances(x[q].astype(float)[None, :], x.astype(float))
        want = sorted((a, b) for a, b in zip(d.tolist(), ids.tolist()) if b != ids[q])[:5]
        assert sorted((-a, -b) for a, b in s.heaps[q]) == want


def test_many_candidates_after_the_first_tile():
    """Bounds set by the first candidates hold for thousands more."""
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(6000, 24)) + 3).astype(np.float32)
    x[5000:5050] = x[:50] + 1e-4
    ids = rng.permutation(6000)
    s = A.TileSearch(ids[:50], x[:50], 4)
    for at in range(0, 6000, 2000):
        s.add(ids[at:at + 2000], x[at:at + 2000])
    for q in range(50):
        d = A.exact_distances(x[q].astype(float)[None, :], x.astype(float))
        want = sorted((a, b) for a, b in zip(d.tolist(), ids.tolist()) if b != ids[q])[:4]
        assert sorted((-a, -b) for a, b in s.heaps[q]) == want and want[0][1] == ids[5000 + q]


def test_copies_of_a_common_vector_are_compared_seldom(monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 8)).astype(np.float32)
    x[::3] = x[0]
    ids = rng.permutation(4000)
    ids[3:60:3] = ids[0]  # one id many times
    ids[63:90:3] = ids[60]
    compared, exact = [], A.exact_distances
    monkeypatch.setattr(A, "exact_distances", lambda a, b: compared.append(len(a)) or exact(a, b))
    s = A.TileSearch(ids[:120], x[:120], 5)
    for at in range(0, 4000, 1000):
        s.add(ids[at:at + 1000], x[at:at + 1000])
    for q in range(120):
        d = exact(x[q].astype(float)[None, :], x.astype(float))
        want = sorted((a, b) for a, b in zip(d.tolist(), ids.tolist()) if b != ids[q])[:5]
        assert sorted((-a, -b) for a, b in s.heaps[q]) == want
    assert sum(compared) < 120 * 300 and len(A.few_copies(ids, x, 5)[0]) == 4000 - len(x[::3]) + 10


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 33)) * 10.0 ** rng.integers(-6, 6, (200, 1))
    q, s, n, e = A.quantised(x)
    back = q * s[:, None]
    assert np.all(np.linalg.norm(x - back, axis=1) <= e) and np.allclose(np.linalg.norm(back, axis=1), n)


def brute_links(rows, threshold):
    good = [(i, lab, np.array(v, float) / np.linalg.norm(np.array(v, float))) for i, v, lab in rows if usable(v) and lab is not None]
    links, root = {}, {k: k for k in range(len(good))}

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    count = [0] * len(good)
    for a in range(len(good)):
        for b in range(a):
            if good[a][1] == good[b][1] and len(good[a][2]) == len(good[b][2]) and float(good[a][2] @ good[b][2]) >= threshold:
                count[a] += 1
                count[b] += 1
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, g in enumerate(good):
        least[top(k)] = min(least.get(top(k), g[0]), g[0])
    for k, g in enumerate(good):
        links.setdefault(g[0], []).append((count[k], least[top(k)]))
    for i, v, lab in rows:
        if not (usable(v) and lab is not None):
            links.setdefault(i, []).append((0, i))
    return {i: sorted(v) for i, v in links.items()}


def ours(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, []).append((r.n_links, r.component_id))
        assert r.kept == (r.vec_id == r.component_id)
    return {i: sorted(v) for i, v in out.items()}


def test_links_of_the_given_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF01, "embeddings").collect()]
    assert ours(op8_embedding_dedup(spark, SF01)) == brute_links(rows, 0.93)


@pytest.mark.parametrize("shard_rows", [40, 5000])
def test_links_over_shards_and_hot_groups(spark, shard_rows):
    rng = np.random.default_rng(4)
    rows, hot = [], rng.normal(size=8)
    for i in range(600):
        if i % 3 == 0:
            v = hot + 0.05 * rng.normal(size=8)      # a third are near copies of one vector
        elif i % 7 == 0:
            v = hot                                   # and many are equal
        else:
            v = rng.normal(size=8)
        rows.append((i, [float(np.float32(c)) for c in v], int(i % 2), 0.0))
    rows += [(700, [1.0, 0.0], 1, 0.0), (701, [2.0, 0.0], 1, 0.0), (702, [1.0, 0.0], None, 0.0), *BAD]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ours(H.near_duplicates(df, 0.93, shard_rows=shard_rows))
    want = brute_links([r[:3] for r in rows], 0.93)
    assert got.keys() == want.keys()
    found, true = sum(c for v in got.values() for c, _ in v), sum(c for v in want.values() for c, _ in v)
    assert 0.99 * true <= found <= true
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert H.near_duplicates(df.limit(0)).count() == 0


def test_graph_recall_on_clusters():
    rng = np.random.default_rng(5)
    x = H.unit_rows(np.concatenate([rng.normal(size=(1, 24)) + 0.15 * rng.normal(size=(int(n), 24)) for n in rng.integers(1, 40, 120)]))
    graph = H.Graph(x)
    links = H.find_links(graph, x, x, 0.95)
    truth = x @ x.T >= 0.95
    assert sum(map(len, links)) >= 0.99 * truth.sum()
    assert all(truth[i, ids].all() for i, ids in enumerate(links))
    ids, _ = graph.search(x[:200].astype(np.float32), 48)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:20].tolist()) & set(b.tolist())) / 10 for a, b in zip(ids, best)]) >= 0.9


class Blind(H.Graph):
    """A graph whose searches find nothing."""

    def search(self, q, beam):
        return np.full((len(q), beam), -1, np.int32), np.full((len(q), beam), -np.inf, np.float32)


def test_rare_links_are_compared_exactly():
    rng = np.random.default_rng(6)
    x, q = H.unit_rows(rng.normal(size=(700, 16))), H.unit_rows(rng.normal(size=(900, 16)))
    q[[201, 600]] = H.unit_rows(x[[5, 6]] + 0.01 * rng.normal(size=(2, 16)))  # two links in 900 queries
    truth = x @ q.T >= 0.93
    for graph, own in ((Blind(x), None), (H.Graph(x), None)):
        links = H.find_links(graph, x, q, 0.93)
        assert all(np.nonzero(truth[:, i])[0].tolist() == ids.tolist() for i, ids in enumerate(links))
        left, right = H.cell_links(graph, x, Blind(q), q, 0.93)
        assert sorted(zip(left.tolist(), right.tolist())) == sorted(zip(*map(np.ndarray.tolist, np.nonzero(truth))))


def test_planted_links_audit_the_graph():
    rng = np.random.default_rng(8)
    x = H.unit_rows(rng.normal(size=(900, 32)))
    c = np.einsum("nd,nd->n", H.planted_queries(x, np.arange(900), 0.93), x)
    assert c.min() >= 0.93 and c.max() <= 0.94
    report = []
    H.find_links(Blind(x), x, x, 0.93, report=report)
    assert [r[1] for r in report[:3]] == [0, 0, 0] and report[-1][1:] == (1.0, 1.0) and report[-1][0] >= 512
    assert H.find_links(Blind(x), x, x[:0], 0.93) == []


class Counting(H.Graph):
    searches = 0

    def search(self, q, beam):
        Counting.searches += len(q)
        return super().search(q, beam)


@pytest.mark.parametrize("dim", [24, 64])
def test_sparse_links_over_shards_are_found_by_the_graph(dim):
    """Two links in a hundred vectors, over two shards: the graph is asked for all of them and recall is measured."""
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(1500, dim))
    x[::50] = x[1::50] + 0.2 * rng.normal(size=(30, dim))
    x[25::50] = x[700:730] + 0.25 * rng.normal(size=(30, dim))
    x = H.unit_rows(rng.permutation(x))
    left, right = x[:800], x[800:]
    graphs = Counting(left), Counting(right)
    Counting.searches, report = 0, []
    H.find_links(graphs[1], right, left, 0.93, report=report)
    assert Counting.searches >= 800 and report[-1][1] >= 0.99 and report[-1][0] < 512
    r, c = H.cell_links(graphs[0], left, graphs[1], right, 0.93)
    truth = set(zip(*map(np.ndarray.tolist, np.nonzero(left @ right.T >= 0.93))))
    found = set(zip(r.tolist(), c.tolist()))
    assert len(truth) >= 10 and found <= truth and len(found) >= 0.9 * len(truth)


def test_own_hits_are_no_links_of_the_audit():
    rng = np.random.default_rng(7)
    x = H.unit_rows(rng.normal(size=(1200, 16)))
    x[1100:] = H.unit_rows(x[:100] + 0.01 * rng.normal(size=(100, 16)))
    truth = x @ x.T >= 0.93
    found = H.find_links(Blind(x), x, x, 0.93, own=np.arange(len(x)))
    assert all(np.nonzero(truth[i])[0].tolist() == ids.tolist() for i, ids in enumerate(found))


def test_a_link_of_either_search_counts_for_both_ends(monkeypatch):
    monkeypatch.setattr(H, "find_links", lambda graph, unit, q, *a, **k: [
        np.array([1] if i == 0 else [], np.int64) for i in range(len(q))])
    x = H.unit_rows(np.eye(3))
    left, right = H.cell_links(None, x, None, x, 0.9)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 1), (1, 0)]
    left, right = H.cell_links(None, x, None, x, 0.9, same=True)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("density", [0.0, 0.004, 0.05, 1.0])
def test_counts_and_components_of_a_cell(same, density):
    rng = np.random.default_rng(int(1000 * density))
    a, b = (70, 70) if same else (70, 45)
    linked = rng.random((a, b)) < density
    if same:
        linked |= linked.T
        np.fill_diagonal(linked, False)
    ids = rng.permutation(1000)[:a + b] - 500
    nodes, nodes2 = ids[:a], ids[:a] if same else ids[a:]
    copies, copies2 = rng.integers(1, 9, a), rng.integers(1, 9, b)
    left, right = H.link_counts(linked, copies, copies2, rows=32)
    assert left.tolist() == [int(copies2[r].sum()) for r in linked] and right.tolist() == [int(copies[c].sum()) for c in linked.T]
    near = {int(n): {int(n)} for n in ids[:a + b]}  # plain closure
    for i, j in zip(*np.nonzero(linked)):
        whole = near[int(nodes[i])] | near[int(nodes2[j])]
        for n in whole:
            near[n] = whole
    u, v = H.forest(linked, nodes, nodes2, same, rows=16)
    assert dict(zip(u.tolist(), v.tolist())) == {n: min(w) for n, w in near.items() if len(w) > 1} and len(u) == len(set(u.tolist()))


def test_a_dense_shard_stays_small():
    rng = np.random.default_rng(3)
    x = H.unit_rows(rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(2500, 16)))  # all are near copies
    tracemalloc.start()
    graph = H.Graph(x)
    linked = H.cell_matrix(graph, x, graph, x, 0.93, same=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert linked.sum() == 2500 * 2499 and peak < 60e6  # the pairs as two int64 columns take 100 MB


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (None, [1.0, 0.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"n_links": F.lit(7), "shard": F.lit("x"), "node": F.lit(3)})
    got = sorted(map(tuple, H.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (None, 2, 1, True)], key=str)
