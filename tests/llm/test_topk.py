from matchwright.llm import topk as T

NAN, INF = float("nan"), float("inf")
ROWS = [(i, [((i * 37 + d * 11) % 23 - 11) / 16 for d in range(4)]) for i in range(60)]
ROWS += [(100, None), (120, [1.0, None, 0.0, 0.0]), (140, [NAN, 0.0, 0.0, 0.0]), (160, [INF, 0.0, 0.0, 0.0])]
ROWS += [(180, [1.0, 1.0]), (181, [0.5, 0.25]), (182, []), (200, []), (7, ROWS[7][1]), (None, [1.0, 1.0, 1.0, 1.0])]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, k):
    import math

    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: v for i, v in ok if i % 20 == 0}.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)}
    return sorted(out)


def test_against_all_pairs(spark):
    vectors = T.quantised(table(spark, ROWS).repartition(3))
    asked = vectors.where("vec_id % 20 = 0")
    for sizes in ({}, {"query_tile": 2, "shard": 7, "lanes": 5, "fan": 2}):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(vectors, asked, 5, **sizes).collect())
        assert got == brute(ROWS, 5)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e13 / 64, 3.0]), (1, [1e3, 5.0]), (2, [1e3, 7.0])]
    vectors = T.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r.vec_id, r.score) for r in T.top_k(vectors, vectors.where("vec_id = 0"), 5).orderBy("rank").collect()]
    assert got == [(2, 10**13 * 64000 + 192 * 448), (1, 10**13 * 64000 + 192 * 320)]


def test_empty(spark):
    vectors = T.quantised(table(spark, []))
    assert T.top_k(vectors, vectors, 5).count() == 0
