"""Vector codes against a plain version."""

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidewater.llm import vector_codes as V

SMALL = "/root/testdata/sf0.001"


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))


def plain(rows):
    """rows: (vec_id, vector, label) -> ([(vec_id, code, error, label_error)], sha)."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4) * 4
    step = width // 4
    ints = [[math.floor(Fraction(x) * 1024) for x in [*v, *[0.0] * (width - len(v))]] for _, v, _ in kept]
    cut = [[x[p * step:(p + 1) * step] for p in range(4)] for x in ints]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:256]
    books = [[cut[k][p] for k in order] for p in range(4)]
    for _ in range(4):
        for p in range(4):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else b for e, b in enumerate(books[p])]
    out, per_label = [], defaultdict(int)
    for (i, _, lab), c in zip(kept, cut):
        hits = [nearest(c[p], books[p]) for p in range(4)]
        out.append((i, "".join(f"{h[1]:02x}" for h in hits), sum(h[0] for h in hits), lab))
        per_label[lab] += out[-1][2]
    cap = (1 << 63) - 1
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((str(i), c, min(e, cap), min(per_label[lab], cap)) for i, c, e, lab in out)), sha


def coded(df):
    rows = V.compress_vectors(df).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in rows), {r.codebooks_sha256 for r in rows}


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("scale", [0.1, 3.0, 1e6, 1e300])
def test_search_equals_plain(scale):
    rng = np.random.default_rng(int(math.log10(scale) + 9))
    for n, width in ((1, 3), (7, 1), (64, 2), (65, 5), (256, 16)):
        entries = V.to_integers(np.round(rng.normal(0, scale, (n, width)), 2))
        entries[n // 2] = entries[0]  # a tie
        vectors = V.to_integers(np.concatenate([np.round(rng.normal(0, scale * s, (40, width)), 2) for s in (0.01, 1, 30)]))
        best, distance = V.SliceIndex(entries).nearest(vectors)
        want = [nearest([int(x) for x in v], [[int(x) for x in e] for e in entries]) for v in vectors]
        assert [(int(d), int(b)) for b, d in zip(best, distance)] == want


def test_box_holds_exactly_what_is_near():
    rng = np.random.default_rng(1)
    entries, vectors = rng.integers(-9, 9, (70, 3)), rng.integers(-9, 9, (50, 3))
    index, radius = V.SliceIndex(entries), rng.integers(0, 8, 50)
    for mask, v, r in zip(index.box(vectors, radius), vectors, radius):
        got = [k for k in range(70) if int(mask[k // 64]) >> (k % 64) & 1]
        assert got == [k for k, e in enumerate(entries) if np.abs(e - v).max() <= r]


def test_floors_are_exact():
    values = [0.0, -0.0, 1e-300, -1e-300, -0.5 / 1024, 1 / 3, -1 / 3, 1e15 + 0.5, -1e15 - 0.5, 3.4e38, -1e308, 5e-324, 131071.99]
    for some in (values, values[:7]):
        assert [int(x) for x in V.to_integers(np.array(some))] == [math.floor(Fraction(x) * 1024) for x in some]


def test_roots():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, (1 << 62) - 1, 94906267 ** 2, 94906267 ** 2 - 1])
    assert V._roots(squares).tolist() == [math.isqrt(int(s)) for s in squares]


def test_small_tables_equal_plain(spark):
    rng = random.Random(8)
    vector = lambda n=8: [round(rng.gauss(0, 0.2), 3) for _ in range(n)]
    rows = [(k, vector(), rng.choice([0, 1, None])) for k in rng.sample(range(1000), 400)]
    rows += [rows[0], (rows[1][0], vector(), 7), (None, vector(), None), (5000, None, 1), (5001, [0.1, None, *vector(6)], 1),
             (5002, [float("nan"), *vector(7)], 0), (5003, [float("-inf"), *vector(7)], 0), (5004, vector(5), 0), (5005, [], 1), (5006, [0.0] * 8, 1)]
    for some in (rows, rows[:3], rows[-7:], [(1, [0.5], None)], [(1, [], 3)]):
        df = spark.createDataFrame(some, SCHEMA).selectExpr("*", "'x' AS code", "1 AS error", "2 AS of_label", "3 AS vector").repartition(3)
        got, sha = coded(df)
        want, want_sha = plain(some)
        assert got == want and sha <= {want_sha} and bool(sha) == bool(want)


def test_extreme_components(spark):
    rows = [(1, [1e300, -1e300, 5e-324, 0.0], 1), (2, [1e300, 1e300, 1.0, -1.0], 1), (3, [3e9, -3e9, 2.5, -1e-200], None), (4, [0.25] * 4, None)]
    assert coded(spark.createDataFrame(rows, SCHEMA))[0] == plain(rows)[0]
    many = rows[2:] + [(10 + k, [float(k * 1e7), 1.0, -float(k), 0.5], k % 3) for k in range(300)]
    got, sha = coded(spark.createDataFrame(many, SCHEMA).repartition(4))
    assert (got, sha) == (plain(many)[0], {plain(many)[1]})


def test_query_equals_plain(spark):
    from tidewater.llm.registry import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op12_vector_codes"](spark, SMALL).collect()
    want, sha = plain(rows)
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got) == want and {r.codebooks_sha256 for r in got} == {sha}


def test_empty_and_decode(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.compress_vectors(empty).count() == 0
    assert V.compress_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    rows = [(k, [k / 8, 1.0, -k / 4, 2.0], 1) for k in range(20)]  # fewer rows than entries: no loss
    kept = V.kept_vectors(spark.createDataFrame(rows, SCHEMA))
    books = V.fit_codebooks(kept, V.padded_width(kept))
    back = V.decode_codes(V.encode_vectors(kept, books, 4), books).collect()
    assert {r.vec_id: r.approximate for r in back} == {k: v for k, v, _ in rows}
