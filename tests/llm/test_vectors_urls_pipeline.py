"""Operators on vectors and URLs, connected components, and the pipeline."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from appmetrics.functions.scratch import stage
from appmetrics.llm import hash_forest, projection_links, url_trust
from appmetrics.llm.components import components
from appmetrics.llm.queries import QUERIES, RULES
from tests.llm import brute

VECTORS = "vec_id long, embedding array<float>, label int, id string, vector string, block int"


def vectors(spark, listed):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1) for i, v in listed], VECTORS)


def odd_vectors(seed=0, n=60, d=8):
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, d)).astype(np.float32)
    base[10:16] = base[9] + random.normal(size=(6, d)) * 0.02
    base[20] = base[21]
    listed = [(i, v.tolist()) for i, v in enumerate(base)]
    listed += [(100, None), (101, [0.0] * d), (102, [float("nan")] * d), (103, [float("inf")] + [1.0] * (d - 1)), (104, [None] + [1.0] * (d - 1)), (105, [])]
    listed += [(None, base[0].tolist()), (3, base[3].tolist()), (106, [1.0, 2.0]), (107, [1.0, 2.0])]
    return listed


def usable(listed):
    return {i: np.array(v, float) for i, v in listed if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}


def test_op1_recall(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, points = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    got = QUERIES["op1_hash_forest_search"](spark, sf).toPandas()
    hits = []
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]]
        mine = got[got["query_id"] == ids[q]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and mine["score"].is_monotonic_increasing
        where = {v: i for i, v in enumerate(ids)}
        assert np.allclose(mine["score"], [distance[where[v]] for v in mine["vec_id"]], rtol=1e-13)
        hits.append(len(set(best) & set(mine["vec_id"])) / 10)
    assert np.mean(hits) >= 0.9


def test_search_of_odd_vectors(spark):
    listed = odd_vectors()
    table = vectors(spark, listed)
    good = usable(listed)
    # A share of all the trees' entries: every vector is met.
    got = hash_forest.search(table, table, k=7, share=hash_forest.TREES).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, v in good.items():
        want = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good.items() if i != q and len(w) == len(v))[:7]
        mine = sorted(by_query.pop(q, []))
        assert [i for _, i, _ in mine] == [i for _, i in want]
        assert np.allclose([s for _, _, s in mine], [d for d, _ in want])
    assert not by_query
    assert hash_forest.search(table.limit(0), table).count() == 0 and hash_forest.search(table, table.limit(0)).count() == 0


def test_forest_takes_the_longest_prefix_that_gives_enough():
    random = np.random.default_rng(5)
    rows = random.normal(size=(500, 16))
    planes = random.normal(size=(4 * 32, 16))
    forest = hash_forest.Forest(np.arange(500), rows, planes, np.zeros(len(planes)), 4)
    low, high = forest.intervals(rows[:20], 40)
    codes = forest.strings(rows)
    for q in range(20):
        for cut in range(33):
            met = (codes >> np.uint64(cut) == (codes[:, q : q + 1] >> np.uint64(cut))).sum(axis=1)
            if met.sum() >= 40:
                break
        assert ((high - low)[:, q] == met).all()


def test_search_does_not_depend_on_partitions(spark):
    random = np.random.default_rng(7)
    table = vectors(spark, [(i, v) for i, v in enumerate(random.normal(size=(300, 8)).tolist())])
    found = [
        sorted(map(tuple, hash_forest.search(t, t.filter("vec_id % 20 = 0"), k=5, share=0.2, block_rows=64).collect()))
        for t in (table.coalesce(1), table.repartition(9))
    ]
    assert len(found[0]) == 75 and found[0] == found[1]


def test_memory_of_a_large_block():
    random = np.random.default_rng(8)
    rows = random.normal(size=(65_536, 64))
    planes = random.normal(size=(hash_forest.TREES * hash_forest.BITS, 64))
    tracemalloc.start()
    hash_forest.Forest(np.arange(len(rows)), rows, planes, np.zeros(len(planes)), hash_forest.TREES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20


def test_small_tables_are_searched_in_full(spark):
    random = np.random.default_rng(6)
    # As many candidates as are asked for, with the defaults: all are found, those of a query's own block too.
    table = vectors(spark, [(i, v) for i, v in enumerate(random.normal(size=(11, 8)).tolist())])
    found = {}
    for r in hash_forest.search(table, table, k=10).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert found == {q: set(range(11)) - {q} for q in range(11)}
    # One block of up to 80 rows, in which the query itself has an entry in each tree.
    for n in (2, 11, 62, 80):
        rows = random.normal(size=(n, 16))
        planes = random.normal(size=(hash_forest.TREES * hash_forest.BITS, 16))
        forest = hash_forest.Forest(np.arange(n), rows, planes, np.zeros(len(planes)), hash_forest.TREES)
        for q in range(n):
            mine = [v for _, v, _ in forest.nearest(np.array([q]), rows[[q]], 10, hash_forest.SHARE)]
            assert len(set(mine)) == min(10, n - 1) and q not in mine


@pytest.mark.parametrize("threshold", [0.9, 0.5])
def test_vector_links_of_odd_vectors(spark, threshold):
    listed = odd_vectors(1)
    good = usable(listed)
    ids = sorted({i for i, _ in listed if i is not None})
    linked = [
        (a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= threshold
    ]
    least = brute.least_reachable(ids, linked)
    got = {r.id: (r.n_links, r.component, r.kept) for r in projection_links.vector_links(vectors(spark, listed), threshold, block_rows=16).collect()}
    assert got.pop(None) == (0, None, False)
    assert got == {i: (sum(i in p for p in linked), least[i], least[i] == i) for i in ids}
    assert projection_links.vector_links(vectors(spark, []), threshold).count() == 0


def test_op9_matches_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, points = table["vec_id"].tolist(), np.stack(table["embedding"]).astype(float)
    unit = points / np.sqrt((points**2).sum(axis=1))[:, None]
    near = np.triu(unit @ unit.T >= 0.9, 1)
    least = brute.least_reachable(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    count = (near | near.T).sum(axis=1).tolist()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op9_embedding_near_dedup"](spark, sf).collect()}
    assert got == {i: (n, least[i], least[i] == i) for i, n in zip(ids, count)}


def test_vector_links_copy_no_vectors_for_pairs_of_blocks(spark, monkeypatch):
    """What is compared is paired where it is read: no shuffle of vectors for each pair of blocks."""
    plans = {}

    def seen(df, name, write=projection_links.stage):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(projection_links, "stage", seen)
    points = np.random.default_rng(4).normal(size=(600, 16))
    points[300:] = points[:300]
    got = projection_links.vector_links(vectors(spark, list(enumerate(points.tolist()))), block_rows=32).collect()
    assert sorted((r.id, r.component) for r in got) == [(i, i % 300) for i in range(600)]
    assert "hashpartitioning" not in plans["links"] and "rangepartitioning" not in plans["links"]


def test_collisions_are_counted_in_bits():
    random = np.random.default_rng(5)
    for used, rows, misses in ((1, 3, 0), (4, 70, 4), (64, 130, 15), (64, 64, 16), (7, 200, 3)):
        a, b = random.integers(0, 256, (rows, used), np.uint8), random.integers(0, 256, (50, used), np.uint8)
        a[:50:2] = b[: len(a[:50:2])]
        apart = np.abs(a[None].astype(int) - b[:, None])
        missed = (np.minimum(apart, 256 - apart) > projection_links.WINDOW_STEPS + 1).sum(axis=2)
        bits = projection_links.often(projection_links.missed_by(a), b, misses)
        assert (np.unpackbits(bits.view(np.uint8), axis=1, count=rows, bitorder="little") == (missed <= misses)).all()


@pytest.mark.parametrize("dimension", [4, 16, 64, 300])
def test_no_pair_at_the_threshold_is_missed(dimension):
    random = np.random.default_rng(dimension)
    used, width, need = projection_links.calibration(dimension, 0.9)
    planes = projection_links.directions(dimension, used, 3)
    a = random.normal(size=(400, dimension))
    a /= np.sqrt((a**2).sum(axis=1))[:, None]
    side = random.normal(size=(400, dimension))
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.sqrt((side**2).sum(axis=1))[:, None]
    b = 0.9000001 * a + np.sqrt(1 - 0.9000001**2) * side
    found = projection_links.linked(a, b, planes, width, need, 0.9)
    assert found.diagonal().all()
    assert (found == (a @ b.T >= 0.9)).all()


def test_components(spark):
    random = np.random.default_rng(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1001 + i) for i in range(300)]
    loose = [tuple(p) for p in random.integers(2000, 2400, (300, 2)).tolist()]
    pairs = chain + star + loose + chain[:5] + [(7, 7)]
    nodes = sorted({n for a, b in pairs if a != b for n in (a, b)})
    want = brute.least_reachable(nodes, [p for p in pairs if p[0] != p[1]])
    edges = spark.createDataFrame([*pairs, (None, 3), (3, None)], "x long, y long")
    got = {r.node: r.root for r in components(edges, "x", "y").collect()}
    assert all(got.get(n, n) == want[n] for n in nodes)
    assert components(edges.limit(0), "x", "y").count() == 0


def test_op7_host_path_and_rule(spark):
    urls = {
        1: ("http://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        3: ("https://a.example.com/de/", "a.example.com", "/de/", "com/", "allow"),
        4: ("x://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
        5: ("x://b.net?es/1", "b.net", "", None, None),
        6: ("no address", "", "", None, "allow"),
        7: (None, "", "", None, "allow"),
        8: ("x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        9: ("x://other.org/en/", "other.org", "/en/", None, "allow"),
        10: ("http://É.com#x://y", "É.com", "", None, None),
        11: ("", "", "", None, "allow"),
        12: ("http://fan.org/?u=http://c.net/", "fan.org", "/", None, None),
    }
    html = {12: "<a href='http://b.net/fr/1'>x</a> <a href=http://B.net/>y</a>", 9: None}
    pages = spark.createDataFrame([(i, u[0], html.get(i, "<p>")) for i, u in urls.items()], "page_id long, url string, html string")
    pages = pages.unionAll(pages.filter("page_id = 2")).withColumns({c: F.lit("mine") for c in ("host", "path", "id", "rule", "rules")})
    got = url_trust.judge(pages, RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        _, host, path, rule, verdict = urls[r.id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and verdict in (None, r.verdict)
    found = {r.id: r.verdict for r in got}
    assert found[5] == "block"  # its host is a blocked seed
    assert found[12] == "block"  # links to one
    assert url_trust.judge(pages.limit(0), RULES).count() == 0
    assert url_trust.judge(pages, ()).filter("verdict = 'allow' AND rule IS NULL").count() == len(got)


def test_op7_reaches_every_host_and_ends_at_the_full_ranks(spark):
    # Each host links to the one before; the first is blocked. Only distrust reaches the others.
    pages = [(0, "http://b.net/es/1", None), (1, "http://h1.org/", "<a href='http://b.net/'>")]
    pages += [(i, f"http://h{i}.org/", f"<a href='http://h{i - 1}.org/'>") for i in range(2, 25)]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.verdict for r in url_trust.judge(pages, RULES).collect()} == {"block"}

    random = np.random.default_rng(8)
    n = 40
    weights = (random.random((n, n)) < 0.05) * random.integers(1, 9, (n, n))
    np.fill_diagonal(weights, 0)
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", float(weights[a, b])) for a, b in zip(*np.nonzero(weights))], "src string, dst string, weight double")
    jumps = {"trust": np.eye(n)[[3, 4]].sum(axis=0) / 2, "distrust": np.eye(n)[5]}
    seeds = spark.createDataFrame([("h3", 2.0, 0.0), ("h4", 2.0, 0.0), ("h5", 0.0, 1.0)], "host string, allowed double, blocked double")
    got = {r.host: r for r in url_trust.propagate(edges, seeds).collect()}
    for layer, graph in (("trust", weights), ("distrust", weights.T)):
        share = graph / np.maximum(graph.sum(axis=1, keepdims=True), 1)
        want = np.linalg.solve(np.eye(n) - url_trust.DAMPING * share.T, (1 - url_trust.DAMPING) * jumps[layer])
        assert np.allclose([got[f"h{i}"][layer] if f"h{i}" in got else 0.0 for i in range(n)], want, rtol=1e-5, atol=1e-15)


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, small), name)
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            prints = {r.doc_id: brute.simhash(r.text) for r in before.collect()}
            least = brute.least_reachable(list(prints), [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
            assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i in least if least[i] == i)
        if name == "repeated_passages":
            texts = {r.doc_id: r.text for r in before.collect()}
            want = {i: texts[i] if not gone else left for i, _, gone, left in brute.without_repeats(list(texts.items()))}
            assert {r.doc_id: r.text for r in docs.collect()} == want
    quality = spark.read.parquet(f"{small}/labels.parquet")
    good = quality.filter("quality = 1")
    assert kept["quality"].join(good, "doc_id", "left_semi").count() >= 0.97 * good.count()
    assert docs.count() == kept["mixture"].count() and docs.filter("n_tokens < 2").count() == 0


def test_pipeline_of_odd_rows(spark, odd, empty, tmp_path):
    for i, docs in enumerate((odd, empty)):
        folder = str(tmp_path / str(i))
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(5, 1), (9, 1), (11, 0), (14, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids", "bytes_in_spans"]
        assert (out.count() == 0) == (docs is empty)
    assert corpus_pipeline.near_duplicates(spark, odd, "").filter("text = 'no id'").count() == 1
