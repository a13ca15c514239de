import numpy as np

from lexweave.llm import embeddings
from tests.llm.helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int, slice string, cell int"


def clustered(seed, clusters, size, dim=64, noise=0.011):
    draw = np.random.default_rng(seed)
    made = []
    for _ in range(clusters):
        base = draw.standard_normal(dim)
        base /= np.linalg.norm(base)
        made += [(base + noise * draw.standard_normal(dim)).astype(np.float32) * draw.uniform(0.1, 9) for _ in range(size)]
    return made


def brute(table):
    usable = {i: np.array(e, float) for i, e, label, *_ in table if label is not None and e is not None and all(v is not None and np.isfinite(v) for v in e) and any(e)}
    labels = {i: label for i, _, label, *_ in table}
    near = lambda a, b: a in usable and b in usable and labels[a] == labels[b] and usable[a].shape == usable[b].shape and usable[a] @ usable[b] >= 0.98 * np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])
    ids = [r[0] for r in table]
    return {i: sum(near(i, j) for j in ids if j != i) for i in ids}, components(ids, near)


def run(spark, table):
    made = embeddings.near_vectors(spark.createDataFrame(table, SCHEMA))
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in made.collect()}


def test_odd_vectors_and_copies(spark):
    vectors = clustered(1, 3, 4)
    table = [(i + 10, v.tolist(), i % 2, "x", 1) for i, v in enumerate(vectors)]
    same = vectors[0].tolist()
    table += [(i, same, 0, "x", 1) for i in (3, 50, 51)] + [(60, same, None, None, None), (61, None, 0, None, None), (62, [0.0] * 64, 0, None, None)]
    table += [(63, [float("nan")] + same[1:], 0, None, None), (64, [float("inf")] + same[1:], 0, None, None), (65, [None] + same[1:], 0, None, None), (66, [1.0, 2.0], 0, "a", 1), (67, [2.0, 4.0], 0, "a", 1), (68, [], 0, "a", 1)]
    links, least = brute(table)
    assert run(spark, table) == {i: (links[i], least[i], least[i] == i) for i in links}
    assert run(spark, []) == {}


def test_recall_against_brute_force(spark):
    table = [(i, v.tolist(), i % 3, "x", 1) for i, v in enumerate(clustered(7, 60, 9, noise=0.017))]
    links, _ = brute(table)
    found = run(spark, table)
    total = sum(links.values())
    assert total > 200
    assert all(found[i][0] <= links[i] for i in links)
    assert sum(found[i][0] for i in links) >= 0.98 * total


def test_large_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LARGE_CELL", 5)
    table = [(i, v.tolist(), 0, "x", 1) for i, v in enumerate(clustered(3, 2, 20))]
    links, least = brute(table)
    assert run(spark, table) == {i: (links[i], least[i], least[i] == i) for i in links}


def test_null_and_repeated_ids(spark):
    same = clustered(2, 1, 1)[0].tolist()
    made = embeddings.near_vectors(spark.createDataFrame([(None, same, 1, "", 0), (5, same, 1, "", 0), (5, same, 1, "", 0)], SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in made) == [(0, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True)]
