"""Exact search, the Merkle manifest and vector codes against plain twins, on odd rows and at many sizes."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from appmetrics.llm import merkle, pivot_search, vector_codes
from appmetrics.llm.queries import QUERIES
from tests.llm.conftest import DOCS, rows
from tests.llm.test_vectors_urls_pipeline import odd_vectors, vectors


def whole(listed, scale, by_id=True):
    """Usable vectors as lists of whole numbers, by id or as (id, vector)."""
    good = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in listed if v and None not in v and np.isfinite(v).all()]
    if not by_id:
        return good
    least = {}
    for i, v in good:
        if i is not None:
            least[i] = min(v, least.get(i, v))
    return least


# Exact search


def expected(stored, asked, k):
    out = {}
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in stored.items() if i != q and len(w) == len(v))
        out.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scores[:k])})
    return out


@pytest.mark.parametrize("k,pivots,block_bytes", [(5, 32, 8 << 20), (3, 4, 2000), (100, 8, 4000), (1, 1, 8 << 20)])
def test_search_of_odd_vectors(spark, k, pivots, block_bytes):
    listed = odd_vectors() + [(200 + i, [1.0] * 8) for i in range(12)]
    table, good = vectors(spark, listed), whole(listed, 256)
    got = pivot_search.search(table, table, k=k, pivots=pivots, block_bytes=block_bytes).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == expected(good, good, k)
    assert len(got) == len(expected(good, good, k))


def test_search_of_empty_tables(spark):
    table = vectors(spark, odd_vectors())
    assert pivot_search.search(table.limit(0), table).count() == 0 and pivot_search.search(table, table.limit(0)).count() == 0


def test_search_of_large_components(spark):
    random = np.random.default_rng(2)
    listed = [(i, v.tolist()) for i, v in enumerate(random.normal(size=(40, 8)).astype(np.float32) * np.float32(1e5))]
    table, good = vectors(spark, listed), whole(listed, 256)
    assert max(sum(x * x for x in v) for v in good.values()) > 2**48
    got = pivot_search.search(table, table, k=4, pivots=6).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == expected(good, good, 4)
    scaled = pivot_search.search(table, table, k=4, scale=256 << 2, pivots=6).collect()  # beyond what doubles can say
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in scaled} == expected(*[whole(listed, 256 << 2)] * 2, 4)


def test_bounds_eliminate_what_is_far():
    """Vectors in bunches: few candidates are measured, and the result is still exact."""
    random = np.random.default_rng(4)
    centers = random.integers(-4000, 4000, (20, 16))
    points = np.repeat(centers, 100, axis=0) + random.integers(-30, 30, (2000, 16))
    ids = np.arange(len(points))
    places = pivot_search.far_apart(points, 32)
    table = np.ascontiguousarray(pivot_search.distances(points, points[places]).T)
    lengths, measured = pivot_search.squares(points), 0
    for q in range(0, 2000, 97):
        at, scores, n = pivot_search.best_of_block(q, points[q], table[:, q], ids, points, lengths, table, ids[places], points[places], 5)
        want = sorted((-int(points[q] @ p), i) for i, p in enumerate(points) if i != q)[:5]
        assert [(-s, i) for i, s in zip(at, scores)] == want
        measured += n
    assert measured < 0.5 * 21 * 2000


# The Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    i, text, lang, source, n = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(level, arity):
    """The root, and for each leaf the neighbours (left, right) on its way up."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for path, a in zip(paths, at):
            first = a // arity * arity
            run = level[first : first + arity]
            path.append(("".join(run[: a - first]), "".join(run[a - first + 1 :])))
        at = [a // arity for a in at]
        level = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
    return level[0], paths


def manifest_of(table, arity=8):
    """Counts of (id, leaf, subroot, root, path)."""
    groups = {}
    for row in table:
        groups.setdefault((row[2] is not None, (row[2] or "").encode()), []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    made = [(sorted(g, key=lambda x: x[:3]), tree([x[2] for x in sorted(g, key=lambda x: x[:3])], arity)) for _, g in sorted(groups.items())]
    root, top = tree([subroot for _, (subroot, _) in made], arity)
    return Counter(
        (row[0], digest, subroot, root, tuple(path + above))
        for (members, (subroot, paths)), above in zip(made, top)
        for (_, _, digest, row), path in zip(members, paths)
    )


def proofs(found):
    return Counter((r.id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in found.proofs().collect())


@pytest.mark.parametrize("arity,every,sizes", [(8, 3, [513, 64, 9, 1]), (8, 1, [70, 8, 1]), (2, 2, [33, 4, 1, 3]), (3, 3, [1])])
def test_manifests_of_many_sizes(spark, arity, every, sizes):
    table = [(100 * g + i * 7, f"Text {i}", f"l{g}" if g else None, "s", i) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(table, DOCS).repartition(5)
    found = merkle.manifest(docs, arity=arity, every=every)
    assert proofs(found) == manifest_of(table, arity)
    assert found.root() == next(iter(manifest_of(table, arity)))[3]
    assert len(found.levels) - 1 == max(0, -(-_height(max(sizes), arity) // every))  # only every few levels are written


def _height(n, arity):
    return 0 if n == 1 else 1 + _height(-(-n // arity), arity)


def test_manifest_of_odd_rows(spark, odd, empty):
    """Nulls, empty and very long texts, rows that share an id, repeated rows; extra columns with other uses."""
    docs = odd.withColumns({c: F.lit(c) for c in ("place", "nodes", "digest", "members", "block", "claimed", "label", "root")})
    assert proofs(merkle.manifest(docs)) == manifest_of(rows())
    assert merkle.manifest(empty).proofs().count() == 0 and merkle.manifest(empty).root() is None


def test_a_changed_row_does_not_fold_to_the_root(spark):
    table = [(i, f"Text {i}" if i % 4 else f"text {i}", None, "s", None) for i in range(30)]
    found = merkle.manifest(spark.createDataFrame(table, DOCS), claims={"text": "lower(text)"}, claimed_where="doc_id % 3 = 0")
    folded = {r.id: r.folded == r.root for r in found.proofs().selectExpr("id", "root", f"{merkle.FOLDED} AS folded").collect()}
    assert folded == {i: i % 3 != 0 or i % 4 == 0 for i in range(30)}


# Vector codes


def codes_of(usable, parts=4, entries=256, rounds=4):
    """Codes, errors and codebooks in Python integers; ``usable`` is (id, vector) in order."""
    width = len(usable[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in usable]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        after = []
        for p in range(parts):
            near = {}
            for c in cut:
                near.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            after.append([[sum(x) // len(near[e]) for x in zip(*near[e])] if e in near else b for e, b in enumerate(books[p])])
        books = after
    made = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [("".join(f"{e:02x}" for _, e in m), sum(d for d, _ in m)) for m in made], digest


@pytest.mark.parametrize("entries,scale,by", [(256, 1024, 1.0), (7, 1024, 1.0), (5, 1 << 20, 100.0)])
def test_codes_of_odd_vectors(spark, entries, scale, by):
    listed = [(i, v and [x and float(np.float32(x * by)) for x in v]) for i, v in odd_vectors() if v is None or len(v) != 2]
    labels = {i: [None, 1, 2, 1][(i or 0) % 4] for i, _ in listed}
    table = spark.createDataFrame([(i, v, labels[i], "x", "y", 1) for i, v in listed], "vec_id long, embedding array<float>, label int, id string, vector string, code int")
    good = sorted(whole(listed, scale, by_id=False), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    want, digest = codes_of(good, entries=entries)
    sums = Counter()
    for (i, _), (_, error) in zip(good, want):
        sums[labels[i]] += error
    coded, books = vector_codes.compress(table.repartition(3), scale=scale, entries=entries)
    assert Counter(tuple(r) for r in coded.collect()) == Counter((i, labels[i], c, e, sums[labels[i]]) for (i, _), (c, e) in zip(good, want))
    assert books.digest() == digest


def test_codes_of_an_empty_table(spark):
    coded, books = vector_codes.compress(vectors(spark, odd_vectors()).limit(0))
    assert coded.count() == 0 and books is None and coded.columns == ["id", "label", "code", "error", "label_error"]


@pytest.mark.parametrize("width,most", [(1, 1 << 29), (16, 1 << 27), (768, 1 << 24), (16, 5)])
def test_products_are_exact(width, most):
    random = np.random.default_rng(width)
    x, y = random.integers(-most, most, (30, width)), random.integers(-most, most, (20, width))
    x[0], y[0] = -most, most
    assert (vector_codes.exact_products(x, y) == x @ y.T).all()
    bits = vector_codes.limb_bits(width)
    assert width * 4 ** (bits - 1) < 2**53 and all(abs(l).max() <= 2 ** (bits - 1) for l in vector_codes.limbs(x, bits))
    assert sum(l.astype(object) * 2 ** (bits * i) for i, l in enumerate(vector_codes.limbs(x, bits))).tolist() == x.tolist()


def test_queries_return_their_columns(spark, small):
    assert QUERIES["op11_pivot_search"](spark, small).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert [t for _, t in QUERIES["op13_vector_codes"](spark, small).dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
