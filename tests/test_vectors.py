"""Centroids, neighbours, silhouette, reduction and clustering against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketmill.operators import centroids as N
from ticketmill.operators import density, embedding, intents, neighbors, profile, reduction, silhouette
from ticketmill.operators.agreement import agreement as label_agreement
from ticketmill.operators.agreement import contingency
from ticketmill.plans import jobs
from ticketmill.session import fresh_path
from ticketmill.sources import tables as S


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in p], int(labels[i]) if labels is not None else 0) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>, cluster_id long")


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 6))
    x[100:] = x[0]  # a third of all rows are copies of one point
    return x, rng.integers(-1, 4, 150)


def test_neighbours_are_exact_with_many_cells_and_tiles(spark, cloud):
    x, _ = cloud
    got = neighbors.top_k_similar(frame(spark, x), "id", "v", 4, normalize=False, pivots=7, tile_rows=11).collect()
    d = distances(x)
    np.fill_diagonal(d, np.inf)
    want = {(i, r + 1): (int(j), d[i, j]) for i in range(len(x)) for r, j in enumerate(np.argsort(d[i], kind="stable")[:4])}
    assert {(r.id, r.rank): r.neighbor_id for r in got} == {k: v[0] for k, v in want.items()}
    assert max(abs(r.distance - want[r.id, r.rank][1]) for r in got) < 1e-9


def shuffled_rows(df):
    """Rows that the plan of ``df`` wrote to shuffles."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                n += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_neighbour_search_sends_rows_to_groups_not_to_every_cell(spark):
    x = np.random.default_rng(5).normal(size=(1600, 24))  # no bound can part cells of this cloud
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "rid long, v array<double>")
    found = neighbors._knn_distinct(df, 5, None, 4096)
    # 40 cells: 64,000 rows if each cell were sent all; its groups are at most twice GROUPS.
    assert shuffled_rows(found) < 2 * 16 * len(x)
    d = distances(x)
    want = {i: sorted(np.argsort(d[i], kind="stable")[:5].tolist()) for i in range(len(x))}
    got = {}
    for r in found.collect():
        got.setdefault(r.rid, []).append(r.nid)
    assert {i: sorted(v) for i, v in got.items()} == want


def test_neighbours_of_few_rows(spark):
    x = np.array([[1.0, 0], [0, 1], [1, 0]])
    got = neighbors.top_k_similar(frame(spark, x), "id", "v", 5).orderBy("id", "rank").collect()
    assert [(r.id, r.neighbor_id) for r in got] == [(0, 2), (0, 1), (1, 0), (1, 2), (2, 0), (2, 1)]


def brute_silhouette(x, y):
    d, out = distances(x), []
    for i in range(len(x)):
        own = (y == y[i]).sum()
        if own == 1:
            out.append(0.0)
            continue
        a = d[i][y == y[i]].sum() / (own - 1)
        b = min(d[i][y == c].mean() for c in set(y) if c != y[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.array(out)


def test_silhouette_with_copies_and_tiles(spark, cloud):
    x, y = cloud
    got = {r.id: r.silhouette for r in silhouette.silhouette_points(frame(spark, x, y), "id", "v", tile_rows=13).collect()}
    kept = np.flatnonzero(y >= 0)
    want = brute_silhouette(x[kept], y[kept])
    assert set(got) == set(kept) and max(abs(got[i] - w) for i, w in zip(kept, want)) < 1e-9


def test_silhouette_edge_cases(spark):
    x = np.arange(6.0).reshape(3, 2)
    none = silhouette.cluster_metrics(frame(spark, x, [-1, -1, 0]), "id", "v").first()
    assert (none.silhouette_score, none.noise_ratio) == (0.0, 1.0)
    one = silhouette.cluster_metrics(frame(spark, x, [0, 0, -1]), "id", "v").first()
    assert one.silhouette_score is None and one.noise_ratio == 0.3333
    single = silhouette.silhouette_points(frame(spark, x, [0, 0, 1]), "id", "v").filter("id = 2").first()
    assert single.silhouette == 0.0


def test_squared_silhouette_routes_agree(spark, cloud):
    x, y = cloud
    kept = y >= 0
    d, labels = distances(x[kept]) ** 2, y[kept]
    want = []
    for i, c in enumerate(labels):
        a = d[i][labels == c].sum() / ((labels == c).sum() - 1)
        b = min(d[i][labels == o].mean() for o in set(labels) if o != c)
        want.append((b - a) / max(a, b))
    for kw in ({}, {"limit_bytes": 1, "tile_rows": 2}):
        got = silhouette.squared_silhouette(frame(spark, x, y), "v", **kw).first()[0]
        assert abs(got - np.mean(want)) < 1e-9


def test_distance_routes_agree(spark, cloud):
    x, y = cloud
    df = frame(spark, x, y)
    shipped = {r.id: r.distance_to_centroid for r in N.distance_to_centroid(df, "id", "v").collect()}
    shuffled = {r.id: r.distance_to_centroid for r in N.distance_to_centroid(df, "id", "v", limit_bytes=1).collect()}
    centre = {c: x[y == c].mean(0) for c in set(y) if c >= 0}
    for i, p in enumerate(x):
        own = np.linalg.norm(p - centre[y[i]]) if y[i] >= 0 else min(np.linalg.norm(p - c) for c in centre.values())
        assert abs(shipped[i] - own) < 1e-9 and abs(shuffled[i] - own) < 1e-9


def test_distance_is_zero_without_clusters(spark, cloud):
    x, _ = cloud
    df = frame(spark, x, np.full(len(x), -1))
    assert {r.distance_to_centroid for r in N.distance_to_centroid(df, "id", "v").collect()} == {0.0}
    assert N.nearest_centroid(df, N.centroids(df, "v"), "id", "v").count() == 0


def test_nearest_tiled_equals_shipped(spark, cloud):
    x, y = cloud
    df = frame(spark, x, y)
    cents = N.centroids(df, "v")
    a = sorted(N.nearest_centroid(df, cents, "id", "v").collect())
    b = sorted(N.nearest_centroid(df, cents, "id", "v", limit_bytes=1, tile_rows=2).collect())
    assert [(r.id, r.cluster_id) for r in a] == [(r.id, r.cluster_id) for r in b]


def test_exact_and_iterated_axes_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 30)) * (0.8 ** np.arange(30))
    df = frame(spark, x)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True))
    want = np.abs(u @ vectors[:, ::-1][:, :3])
    for width in (256, 8):
        monkeypatch.setattr(reduction, "EXACT_WIDTH", width)
        got = np.array([r.reduced for r in reduction.reduce(df, "v", 3).orderBy("id").collect()])
        assert np.abs(np.abs(got) - want).max() < 1e-3


def blobs():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 8)) * 6
    x = np.concatenate([c + rng.normal(size=(80, 8)) for c in centres] + [rng.uniform(-20, 20, size=(40, 8))])
    return x, np.repeat([0, 1, 2, 3, -1], [80] * 4 + [40])


def agreement(truth, got):
    """Adjusted Rand index."""
    def pairs(n):
        return n * (n - 1) / 2

    table = np.zeros((truth.max() + 2, got.max() + 2))
    np.add.at(table, (truth + 1, got + 1), 1)
    both, a, b = pairs(table).sum(), pairs(table.sum(1)).sum(), pairs(table.sum(0)).sum()
    expected = a * b / pairs(len(truth))
    return (both - expected) / ((a + b) / 2 - expected)


def plain_density(x, least, samples):
    """The same hierarchy from all distances, by plain loops: labels by excess of mass."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, samples]
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))
    i, j = np.triu_indices(n, 1)
    order = np.lexsort((j, i, reach[i, j]))
    floor = reach[i, j][reach[i, j] > 0].min() * 1e-3
    group = {k: ([k], None) for k in range(n)}  # members and the candidate they are, once big enough
    at, kids, born, left = list(range(n)), [], {}, []
    for e in order:
        a, b = at[i[e]], at[j[e]]
        if a == b:
            continue
        level = 1 / max(reach[i[e], j[e]], floor)
        (ma, ca), (mb, cb) = group[a], group[b]
        if ca is not None and cb is not None:
            kids.append((ca, cb))
            left.append([])
            c = len(kids) - 1
            for k, m in ((ca, ma), (cb, mb)):
                born[k] = level
                left[c] += [(level, p) for p in m]
        elif ca is None and cb is None and len(ma) + len(mb) >= least:
            kids.append(())
            left.append([(level, p) for p in ma + mb])
            c = len(kids) - 1
        else:
            c = ca if ca is not None else cb
            if c is not None:
                left[c] += [(level, p) for p in (mb if ca is not None else ma)]
        group[a] = (ma + mb, c)
        for p in mb:
            at[p] = a
    best, chosen = {}, {}
    for c in range(len(kids)):
        own = sum(v - born.get(c, 0) for v, _ in left[c])
        rest = sum(best[k] for k in kids[c])
        chosen[c] = c in born and not (kids[c] and rest > own)
        best[c] = own if chosen[c] else rest
    labels, todo, picked = np.full(n, -1), [c for c in range(len(kids)) if c not in born], []
    while todo:
        c = todo.pop()
        if chosen[c]:
            picked.append((-len(left[c]), min(p for _, p in left[c]), c))
        else:
            todo += kids[c]
    for number, (_, _, c) in enumerate(sorted(picked)):
        labels[[p for _, p in left[c]]] = number
    return labels


def test_density_finds_blobs_and_noise(spark):
    x, truth = blobs()
    got = density.density_cluster(frame(spark, x), "id", "v").orderBy("id").collect()
    labels = np.array([r.cluster_id for r in got])
    assert len(got) == len(x) and agreement(truth, labels) >= 0.99
    # Over a graph of all pairs the labels are those of the plain hierarchy, however the work is cut.
    y = np.concatenate([x[::3], x[:4], np.random.default_rng(3).normal(size=(40, 8)) * 0.3])
    graph = neighbors.neighbor_graph(frame(spark, y), "id", "v", len(y))
    for least, samples, chunk in ((12, 4, 50_000), (8, 3, 500)):
        h = density.hierarchy(graph, samples, chunk)
        got = [r.cluster_id for r in density.labels_of(h, least, chunk).orderBy("id").collect()]
        assert got == plain_density(y, least, samples).tolist()


def test_density_joins_far_groups_that_the_graph_leaves_apart(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([c + rng.normal(size=(60, 4)) for c in (0.0, 40.0, 43.0, 300.0)])
    got = np.array([r.cluster_id for r in density.density_cluster(frame(spark, x), "id", "v", 25, k=6).orderBy("id").collect()])
    assert agreement(plain_density(x, 25, 5), got) >= 0.97


def test_the_tree_is_that_of_all_distances(spark):
    """Groups of more than a hundred points that lie in each other's way; no graph edge joins them."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(260, 2)) * s + c for c, s in (((0, 0), 1), ((30, 0), 4), ((0, 60), 9), ((70, 70), 1), ((72, 74), 0.2))]
                       + [np.c_[np.linspace(3, 65, 150), np.linspace(-9, 50, 150)], rng.uniform(-90, 160, (30, 2))])
    d = distances(x)
    core = np.sort(d, axis=1)[:, 5]
    w = np.maximum(d, np.maximum(core[:, None], core[None]))
    inside, near, want = np.zeros(len(x), bool), np.full(len(x), np.inf), []
    inside[0], near = True, w[0].copy()
    for _ in range(len(x) - 1):
        at = int(np.where(inside, np.inf, near).argmin())
        want.append(near[at])
        inside[at] = True
        near = np.minimum(near, w[at])
    got = density.hierarchy(neighbors.neighbor_graph(frame(spark, x), "id", "v", 6), 5).merges.collect()
    assert len(got) == len(want) and np.allclose(sorted(r.w for r in got), sorted(want))


def test_runs_agree(spark):
    x, _ = blobs()
    runs, pairs, fates = density.stability_runs(frame(spark, x), "id", "v", [(20, 5), (20, 5), (120, 5)])
    runs, pairs = runs.orderBy("run").collect(), {(r["first"], r["second"]): r for r in pairs.collect()}
    assert [r["total_tickets"] for r in runs] == [len(x)] * 3 and runs[0]["n_clusters"] == 4 and runs[2]["n_clusters"] == 0
    assert pairs[0, 1]["adjusted_rand"] == 1 and pairs[0, 2]["adjusted_rand"] < 0.1 and pairs[0, 1]["points"] == len(x)
    kept = {(r["first"], r["second"], r["cluster_id"]): r["kept"] for r in fates.collect()}
    assert all(kept[0, 1, c] == 1 and kept[0, 2, c] == 0 for c in range(4))


def test_agreement(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 5, 300), rng.integers(0, 4, 300)
    b[:200] = a[:200] % 4
    rows = [(int(x), int(y)) for x, y in zip(a, b)] + [(None, 1)]
    table = contingency(spark.createDataFrame(rows, "a long, b long"), "a", "b")
    got = label_agreement(table, "a", "b").first()
    assert got["points"] == 300 and abs(got["adjusted_rand"] - agreement(a, b)) < 1e-9
    assert tuple(label_agreement(table.limit(0), "a", "b").first()) == (0, None)


def test_density_on_copies_noise_and_nothing(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.zeros((60, 3)), np.ones((40, 3)) * 9, rng.uniform(-50, 50, (30, 3))])
    got = [r.cluster_id for r in density.density_cluster(frame(spark, x), "id", "v").orderBy("id").collect()]
    assert len(set(got[:60])) == 1 and len(set(got[60:100])) == 1 and got[0] != got[60] and min(got[0], got[60]) >= 0
    far = rng.uniform(-50, 50, (30, 3))
    assert {r.cluster_id for r in density.density_cluster(frame(spark, far), "id", "v").collect()} == {-1}
    assert density.density_cluster(frame(spark, x).limit(0), "id", "v").count() == 0
    assert [r.cluster_id for r in density.density_cluster(frame(spark, x[:1]), "id", "v").collect()] == [-1]


def test_min_cluster_size_default():
    assert [density.default_min_cluster_size(n) for n in (0, 500, 1000, 50_000)] == [20, 20, 30, 1500]


def test_repetition_is_the_mean_pairwise_cosine(spark, cloud):
    x, y = cloud
    got = {r.cluster_id: r.repetition_score for r in intents.repetition(frame(spark, x, y), "v").collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for c, score in got.items():
        g = u[y == c] @ u[y == c].T
        n = len(g)
        assert abs(score - (g.sum() - n) / (n * (n - 1))) < 1e-9


def test_exact_quantiles_with_a_dominant_value(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([np.full(400, 7.0), rng.normal(size=801) * 5])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(v, -v)], "a double, b double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = {(r.column_name, r.prob): r.value for r in profile.exact_quantiles(df, ["a", "b"], probs).collect()}
    for p in probs:
        assert abs(got["a", p] - np.quantile(v, p)) < 1e-9 and abs(got["b", p] - np.quantile(-v, p)) < 1e-9


def test_embedding_is_deterministic_unit_length_and_covers_blanks(spark):
    df = spark.createDataFrame([(1, "hola mundo"), (2, "  "), (3, None), (4, "hola mundo")], "id long, t string")
    model = embedding.fit_embedder(df, "t", 64)
    got = {r.id: r.embedding_vector for r in embedding.embed(df, "t", model).collect()}
    assert got[1] == got[4] and got[2] == got[3] and abs(np.linalg.norm(got[2]) - 1) < 1e-9


def test_model_hook_counts_failed_batches(spark):
    def encode(texts):
        if "malo" in texts:
            raise ValueError("down")
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, "malo")], "id long, t string").repartition(1)
    got = {r.id: r.embedding_vector for r in embedding.embed_with(df, "id", "t", encode, batch_size=1).collect()}
    assert got == {1: [2.0, 1.0], 2: [7.0, 1.0], 3: None}


def test_jobs_from_vectors_to_intents(spark):
    x, truth = blobs()
    words = {0: "pedido perdido", 1: "clave olvidada", 2: "factura doble", 3: "cambio talla", -1: "otro asunto"}
    made = {n: S.table(spark, fresh_path(spark, "j"), n, 1000).ensure() for n in ("features.clusters", "features.intents")}
    vectors = frame(spark, x).select(F.col("id").alias("ticket_id"), F.col("v").alias("embedding_vector"))
    clean = spark.createDataFrame([(i, words[int(t)], words[int(t)]) for i, t in enumerate(truth)],
                                  "ticket_id long, text_customer_only string, text_full string")
    stats = jobs.run_clustering(vectors, made["features.clusters"], exact_silhouette=True)
    assert stats["n_clusters"] == 4 and stats["total_tickets"] == len(x) and stats["silhouette_score"] > 0.3
    clusters = made["features.clusters"].read()
    assert jobs.run_labeling(clusters, clean, made["features.intents"]) == {"total_clusters": 4, "labeled": 4, "errors": 0}
    names = {r.name for r in made["features.intents"].read().collect()}
    assert any("pedido" in n for n in names) and {r.status for r in made["features.intents"].read().collect()} == {"pending"}
    assert jobs.run_labeling(clusters, clean, made["features.intents"], limit_clusters=2)["total_clusters"] == 2
    replies = spark.createDataFrame([(0, '{"name": "Uno"}'), (1, "[1]"), (2, "no json")], "cluster_id long, reply string")
    done = jobs.run_labeling(clusters, clean, made["features.intents"], replies=replies)
    assert done == {"total_clusters": 4, "labeled": 2, "errors": 1}
    assert jobs.run_clustering(vectors.limit(0), made["features.clusters"]) == {"error": "No embeddings found"}


@pytest.mark.parametrize("tile", [4096, 40])
def test_hashed_neighbours_recall(spark, monkeypatch, tile):
    from ticketmill.operators import neighbors

    monkeypatch.setattr(neighbors, "TILE_ROWS", tile)
    x = np.random.default_rng(3).normal(size=(300, 12)) + np.repeat(np.eye(12)[:6] * 6, 50, axis=0)
    df = frame(spark, np.vstack([x, x[:5]]))  # and five copies
    found, exact = (
        {(r.id, r.neighbor_id) for r in neighbors.top_k_similar(df, "id", "v", 5, method=m).collect()} for m in ("lsh", "exact")
    )
    assert len(found) <= len(exact) and len(found & exact) / len(exact) > 0.95
    with pytest.raises(ValueError):
        neighbors.top_k_similar(df, "id", "v", method="other")


def test_hashed_search_sends_a_vector_once_to_a_region(spark):
    x = np.random.default_rng(6).normal(size=(2000, 16))
    x[1400:] = x[0] + np.random.default_rng(7).normal(size=(600, 16)) * 1e-3  # one crowded bucket
    df = frame(spark, x).select(F.col("id").alias("rid"), "v")
    whole, cut = (neighbors._knn_hashed(df, 4, region_rows=r) for r in (None, 100))
    # 12 tables, each vector once; 48 rows a vector were it sent to each bucket that holds or answers it. Then one list a row and table.
    assert shuffled_rows(whole) <= 24 * len(x) + 100
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in cut.collect()}
    codes = set()
    for r in whole.collect():
        assert abs(r.distance - np.linalg.norm(x[r.rid] - x[r.nid])) < 1e-9 and (r.rid, r.nid) not in codes
        codes.add((r.rid, r.nid))


def test_axes_of_a_flat_spectrum(spark, monkeypatch):
    from ticketmill.operators import reduction

    monkeypatch.setattr(reduction, "EXACT_WIDTH", 8)
    x = np.random.default_rng(4).normal(size=(400, 40)) * np.linspace(1, 1.2, 40)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = reduction.principal_axes(frame(spark, x).select("v"), 40, 6)
    covariance = np.cov(x.T, bias=True)
    best = np.sort(np.linalg.eigvalsh(covariance))[::-1][:6].sum()
    assert np.trace(axes.T @ covariance @ axes) > 0.98 * best


def test_axes_take_one_pass_over_the_rows(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(300, 40)) * np.linspace(3, 1, 40)
    df = frame(spark, x).select("v").repartition(5)
    monkeypatch.setattr(reduction, "EXACT_WIDTH", 8)
    monkeypatch.setattr(reduction, "WHOLE_WIDTH", 0)
    want = reduction.principal_axes(df, 40, 5)
    monkeypatch.setattr(reduction, "WHOLE_WIDTH", 40)
    monkeypatch.setattr(reduction, "_times_covariance", None)  # each call is a pass of its own
    assert np.abs(reduction.principal_axes(df, 40, 5) - want).max() < 1e-9


def test_null_vectors_are_left_out(spark):
    from ticketmill.operators import density, reduction

    df = frame(spark, blobs()[0]).drop("cluster_id").union(spark.createDataFrame([(-7, None)], "id long, v array<double>"))
    assert reduction.reduce(df, "v", 2).count() == df.count() - 1
    assert density.density_cluster(df, "id", "v").filter("id = -7").count() == 0
