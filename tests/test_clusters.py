import numpy as np
import pytest

from millrace.operators import components, density, isolation, neighbors


def plane(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                                 "id bigint, " + ", ".join(f"c{j} double" for j in range(len(points[0]))))


def brute_dbscan(points, eps, min_points):
    points = np.asarray(points, float)
    near = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= min_points
    root = np.full(len(points), -1)
    for i in np.flatnonzero(core):
        if root[i] < 0:
            waiting = [i]
            while waiting:
                at = waiting.pop()
                if root[at] < 0:
                    root[at] = i
                    waiting += list(np.flatnonzero(near[at] & core & (root < 0)))
    return core, root, near


CASES = {
    "scattered": np.random.default_rng(1).normal(size=(300, 2)),
    "hot point": np.vstack([np.tile([[0.2, 0.2]], (150, 1)), np.random.default_rng(2).uniform(-2, 2, (250, 2))]),
    "crowded neighbours": np.vstack([np.random.default_rng(3).uniform(0, 0.1, (120, 2)),
                                     np.random.default_rng(4).uniform(0, 0.1, (120, 2)) + [0.44, 0],
                                     np.random.default_rng(5).uniform(0, 0.1, (120, 2)) + [5, 5]]),
    "space": np.random.default_rng(6).normal(size=(200, 3)),
}


@pytest.mark.parametrize("name", ["hot point", "scattered", "crowded neighbours", "space"])
def test_dbscan_equals_brute_force(spark, name):
    points, eps = CASES[name], 0.4
    columns = [f"c{j}" for j in range(points.shape[1])]
    core, root, near = brute_dbscan(points, eps, 5)
    got = {r["id"]: r for r in density.dbscan(plane(spark, points), "id", columns, eps, 5).collect()}
    assert len(got) == len(points)
    assert [got[i]["is_core"] for i in range(len(points))] == list(core)
    paired = {(got[i]["cluster"], root[i]) for i in np.flatnonzero(core)}
    assert len({a for a, _ in paired}) == len(paired) == len({b for _, b in paired})
    for i in np.flatnonzero(~core):
        reachable = {got[j]["cluster"] for j in np.flatnonzero(near[i] & core)}
        assert got[i]["cluster"] == (min(reachable) if reachable else -1)


def test_boxes_are_halved_when_crowded_cells_are_undecided(spark, monkeypatch):
    monkeypatch.setattr(density, "FEW_POSITIONS", 1)
    monkeypatch.setattr(density, "CELL_ROWS", 20)
    points = CASES["crowded neighbours"]
    core, root, _ = brute_dbscan(points, 0.4, 5)
    got = {r["id"]: r["cluster"] for r in density.dbscan(plane(spark, points), "id", ["c0", "c1"], 0.4, 5).collect()}
    assert len(set(got.values())) == len(set(root))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + j) for j in range(1, 200)]
    nodes = spark.createDataFrame([(i,) for i in list(range(61)) + list(range(100, 300)) + [999]], "node bigint")
    got = {r["node"]: r["component"] for r in components.connected_components(
        nodes, spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert {got[i] for i in range(100, 300)} == {100} and got[999] == 999


@pytest.mark.parametrize("block_rows,chunk_rows,pivots", [(50_000, 50_000, 32), (20, 30, 4)])
def test_neighbours_equal_brute_force(spark, block_rows, chunk_rows, pivots):
    random = np.random.default_rng(9)
    train = np.vstack([random.normal(size=(200, 4)), np.tile([[0.5, 0, 0, 0]], (100, 1))])
    ask = np.vstack([random.normal(size=(70, 4)), [[0.5, 0, 0, 0]]])
    frame = lambda x: spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "id bigint, features array<double>")
    got = neighbors.knn_topk(frame(train), frame(ask), 5, pivots=pivots, block_rows=block_rows, chunk_rows=chunk_rows).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["neighbor_id"])
    for i, q in enumerate(ask):
        d = np.sqrt(((train - q) ** 2).sum(1))
        assert found[i] == list(np.lexsort((np.arange(len(d)), d))[:5])


def test_neighbours_of_a_tiny_training_set(spark):
    frame = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, features array<double>")
    got = neighbors.knn_topk(frame, frame, 5).collect()
    assert len(got) == 4
    assert neighbors.knn_topk(frame.limit(0), frame, 5).count() == 0


def test_neighbours_when_a_task_gets_many_batches(spark):
    """The rows of a pivot come in several batches, whose sizes, reaches and smallest radii are put together."""
    random = np.random.default_rng(10)
    train, ask = random.normal(size=(300, 3)), random.normal(size=(40, 3))
    frame = lambda x: spark.createDataFrame(
        [(i, [float(c) for c in p]) for i, p in enumerate(x)], "id bigint, features array<double>").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16")
    try:
        got = neighbors.knn_topk(frame(train), frame(ask), 5, pivots=4, block_rows=40, chunk_rows=30).collect()
    finally:
        spark.conf.set(setting, before)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["neighbor_id"])
    for i, q in enumerate(ask):
        assert found[i] == list(np.argsort(((train - q) ** 2).sum(1), kind="stable")[:5])


def test_isolation_forest_finds_planted_outliers(spark):
    random = np.random.default_rng(11)
    points = np.vstack([random.normal(size=(500, 2)), [[9, 9], [-9, 8], [8, -9], [-10, -9]]])
    df = plane(spark, points)
    scored = isolation.anomaly_scores(df, "id", ["c0", "c1"], trees=60, rows=128)
    ranked = sorted(scored.collect(), key=lambda r: -r["anomaly_score"])
    assert {r["id"] for r in ranked[:4]} == {500, 501, 502, 503}
    flagged = isolation.flag_anomalies(scored, 0.06).filter("is_anomaly").count()
    assert abs(flagged - 0.06 * 504) <= 2
    again = isolation.anomaly_scores(df.repartition(7), "id", ["c0", "c1"], trees=60, rows=128)
    assert {r["id"]: r["anomaly_score"] for r in again.collect()} == pytest.approx(
        {r["id"]: r["anomaly_score"] for r in ranked})


def test_tree_samples_have_the_exact_size(spark):
    df = plane(spark, np.random.default_rng(0).normal(size=(3000, 2)))
    sizes = isolation.tree_samples(df, "id", ["c0", "c1"], trees=20, rows=64).groupBy("tree").count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {64}


def test_blocks_go_only_where_queries_ask(spark):
    """Two far groups of rows and queries beside one of them: no row of the other group is moved."""
    random = np.random.default_rng(8)
    far = np.vstack([random.normal(size=(300, 2)), random.normal(size=(300, 2)) + 1000])
    rows = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(far)], "id bigint, v array<double>")
    asked = spark.createDataFrame([(i, list(map(float, p))) for i, p in enumerate(far[:40])], "query_id bigint, v array<double>")
    tree = neighbors.PivotTree.of(rows, 20)
    blocks, routed = neighbors._met(rows, asked, tree, 5, 50, 10)
    ids = [r["id"] for r in blocks.select("id", "chunk").distinct().collect()]
    assert 0 < len(set(ids)) and max(ids) < 300
    needed = {tuple(r) for r in routed.select("cell", "part", "chunk").distinct().collect()}
    cells = {c for c, _, _ in needed}
    assert {r["cell"] for r in blocks.select("cell").distinct().collect()} <= cells
    cell, radius = tree.place(far)
    assert np.allclose(radius, np.sqrt(((far - tree.pivots[cell]) ** 2).sum(1)))


def test_many_copies_of_a_row(spark):
    rows = [(i, [1.0, 1.0] if i % 3 else [float(i), 0.0]) for i in range(400)]
    frame = spark.createDataFrame(rows, "id bigint, features array<double>")
    got = {}
    for r in neighbors.knn_topk(frame, frame.filter("id < 30"), 4, block_rows=60, chunk_rows=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    points = np.array([v for _, v in rows])
    for q, found in got.items():
        distance = np.sqrt(((points - points[q]) ** 2).sum(1))
        assert [i for _, i in sorted(found)] == sorted(range(400), key=lambda i: (distance[i], i))[:4]


def test_boxes_rule_out_all_but_a_few_cells():
    """A query in four dimensions meets a few cells of hundreds, and its neighbours lie in these."""
    random = np.random.default_rng(11)
    points, asked = random.normal(size=(40_000, 4)), random.normal(size=(100, 4))
    tree = neighbors.BoxTree(points[:4096], 8)
    cell = tree.place(points)
    met = np.unique(cell)
    tree.fill(met, np.bincount(cell)[met], np.array([points[cell == c].min(axis=0) for c in met]),
              np.array([points[cell == c].max(axis=0) for c in met]))
    home, top = tree.home(asked, 5)
    distance = np.sqrt(((asked[:, None] - points[None]) ** 2).sum(-1))
    kth = np.sort(distance, axis=1)[:, 4]
    assert (top >= kth).all() and (tree.n[tree.first + home] > 0).all()
    query, reached = tree.reached(asked, kth)
    assert len(query) < 12 * len(asked)
    nearest = np.argsort(distance, axis=1)[:, :5]
    pairs = set(zip(query, reached))
    assert all((i, cell[j]) in pairs for i in range(100) for j in nearest[i])


def test_few_dimensions_equal_brute_force(spark, monkeypatch):
    """Cells without rows, a crowded point, one far away, a missing coordinate, fewer rows in a cell than asked for."""
    monkeypatch.setattr(neighbors, "ROWS_A_BOX", 8)
    random = np.random.default_rng(12)
    train = np.vstack([random.normal(size=(200, 3)), np.tile([[0.5, 0, 0]], (90, 1)), [[900.0, 0, 0], [np.nan, 0, 0]]])
    ask = np.vstack([random.normal(size=(60, 3)), [[0.5, 0, 0], [-700.0, 5, 5]]])
    frame = lambda x: spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "id bigint, features array<double>")
    for k, block_rows, chunk_rows in ((5, 50_000, 50_000), (30, 25, 7)):
        found = {}
        for r in neighbors.knn_topk(frame(train), frame(ask), k, block_rows=block_rows, chunk_rows=chunk_rows).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["neighbor_id"], r["distance"]))
        for i, q in enumerate(ask):
            d = np.sqrt(((train[:-1] - q) ** 2).sum(1))
            order = np.lexsort((np.arange(len(d)), d))[:k]
            assert [n for n, _ in found[i]] == list(order)
            assert np.allclose([x for _, x in found[i]], d[order])
