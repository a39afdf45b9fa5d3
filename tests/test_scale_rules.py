"""Results do not depend on caps, id ranges or input sizes."""

import datetime as dt

from pyspark.sql import functions as F

from recfold.functions.portable import exact_avg, portable_hash
from recfold.operators import graph as G
from recfold.operators import models as M
from recfold.operators import prep as P
from recfold.operators import splits as S


def test_core_of_a_long_path_is_empty(spark):
    # a path loses its two end edges in every pass
    rows = [(i // 2, (i + 1) // 2, 3, dt.date(2020, 1, 1)) for i in range(120)]
    df = spark.createDataFrame(rows, "user_id bigint, movie_id bigint, rating int, date date").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert P.k_core(df, 2, 2).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_every_positive_gets_a_negative_while_one_exists(spark):
    seen = [i for i in range(1000) if i % 100]
    pos = spark.createDataFrame([(1, i) for i in seen] + [(2, 0)] + [(3, i) for i in range(1000)], "user_id bigint, movie_id bigint")
    out = G.sample_negatives(pos, 1000).collect()
    one = [r["neg"] for r in out if r["user_id"] == 1]
    assert len(one) == 990 and set(one) <= set(range(0, 1000, 100)) and len(set(one)) == 10
    assert all(r["neg"] not in (0, None) for r in out if r["user_id"] == 2)
    assert all(r["neg"] is None for r in out if r["user_id"] == 3)
    same = G.sample_negatives(pos, 1000, reject="same").collect()
    assert all(r["neg"] is not None and r["neg"] != r["movie_id"] and 0 <= r["neg"] < 1000 for r in same)


def test_half_star_ratings_keep_their_fraction(spark):
    df = spark.createDataFrame([(1, 10, 3.5), (2, 10, 4.5), (1, 20, 0.5), (2, 20, 1.5)], "user_id bigint, movie_id bigint, rating double")
    items = {r["movie_id"]: r["i_term"] for r in M.fit_bias(df, 0.0, 0.0).items.collect()}
    assert items == {10: 1.5, 20: -1.5}


def test_global_split_without_dates_is_the_per_user_one(spark):
    df = spark.createDataFrame([(u, i, 3) for u in range(2) for i in range(10)], "user_id bigint, movie_id bigint, rating int")
    dated = df.withColumn("date", F.lit(None).cast("date"))
    key = ["user_id", "movie_id", "split"]
    got = sorted(map(tuple, S.split_temporal_global(dated).select(key).collect()))
    assert got == sorted(map(tuple, S.split_random_per_user(df, 0.1, 0.1, 42).select(key).collect()))


def test_large_and_negative_ids(spark):
    ids = [0, 5, 2 ** 62, 2 ** 62 + 1, -(2 ** 62), 10 ** 13]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    assert df.select(portable_hash("id", F.col("id"), 1).alias("h")).where("h between 0 and 2147483646").count() == len(ids)
    got = {r["orig_id"]: r["idx"] for r in P.dense_ids(df, "id").collect()}
    assert got == {v: k for k, v in enumerate(sorted(ids))}


def test_sparse_ids_are_numbered_in_order(spark):
    df = spark.range(3000).select((F.col("id") * 123_456_789_012_345 % 9_000_000_000_000_000_007).alias("id"))
    rows = P.dense_ids(df, "id").orderBy("orig_id").collect()
    assert [r["idx"] for r in rows] == list(range(3000))


def test_mean_of_many_rows(spark):
    assert spark.range(10_000_000).select(F.lit(1.0).alias("x")).agg(exact_avg("x").alias("m")).first()["m"] == 1.0


def test_propagation_over_more_dimensions_than_a_block(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    a, e = np.zeros((5, 5)), rng.standard_normal((5, 37))
    edges = [(0, 3), (0, 4), (1, 3), (2, 4), (1, 4)]
    rows = [(s, d, 0.5) for s, d in edges] + [(d, s, 0.5) for s, d in edges]
    for s, d, w in rows:
        a[s, d] += w
    w = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    emb = spark.createDataFrame([(n, d, float(e[n, d])) for n in range(5) for d in range(37)], "node bigint, dim int, val double")
    out = np.zeros((5, 37))
    got = G.propagate(w, emb, 2).collect()
    for r in got:
        out[r["node"], r["dim"]] = r["val"]
    assert len(got) == 5 * 37 and np.allclose(out, (e + a @ e + a @ a @ e) / 3)
    arrays = spark.createDataFrame([(n, e[n].tolist()) for n in range(5)], "node bigint, emb array<float>").select(
        "node", F.col("emb").cast("array<double>").alias("emb"))
    held = {(r["node"], r["dim"]): r["val"] for r in G.propagate(w, arrays, 2).collect()}
    assert len(held) == 5 * 37 and all(np.isclose(v, out[k], atol=1e-6) for k, v in held.items())


def test_propagation_of_odd_arrays(spark):
    """Null and empty arrays hold no layer-0 row, null entries and short arrays count as 0."""
    w = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0)], "src bigint, dst bigint, weight double")
    emb = spark.createDataFrame([(0, [1.0, None, 3.0]), (1, [5.0]), (2, None), (3, [])], "node bigint, emb array<double>")
    for materialize in (True, False):
        got = {(r["node"], r["dim"]): r["val"] for r in G.propagate(w, emb, 1, materialize=materialize).collect()}
        assert got == {(0, 0): 3.0, (0, 1): 0.0, (0, 2): 1.5, (1, 0): 3.0, (1, 1): 0.0, (1, 2): 1.5,
                       (2, 0): 0.5, (2, 1): 0.0, (2, 2): 1.5, (3, 0): 0.5, (3, 1): 0.0, (3, 2): 1.5}
    none = spark.createDataFrame([], "node bigint, emb array<double>")
    assert G.propagate(w, none, 2).count() == 0


def test_propagation_over_many_cells(spark, monkeypatch):
    """Edges are met by blocks of vectors: no edge becomes a row with a vector, and cells add up to the product."""
    import numpy as np

    monkeypatch.setattr(G, "CELL_EDGES", 7)
    monkeypatch.setattr(G, "CELL_BYTES", 500)
    rng = np.random.default_rng(3)
    a, e = np.zeros((12, 12)), rng.standard_normal((12, 20))
    rows = [(int(s), int(d), float(x)) for s, d, x in zip(rng.integers(0, 12, 60), rng.integers(0, 12, 60), rng.random(60))]
    for s, d, x in rows:
        a[s, d] += x
    w = spark.createDataFrame([*rows, (3, None, 1.0)], "src bigint, dst bigint, weight double")
    emb = spark.createDataFrame([(n, e[n].tolist()) for n in range(12)], "node bigint, emb array<double>")
    got = G.block_arrays(*G.propagate_blocks(w, emb, 2)).collect()
    want = (e + a @ e + a @ a @ e) / 3
    assert len(got) == 12 and all(np.allclose(r["emb"], want[r["node"]]) for r in got)


def test_inner_products_of_pairs(spark, monkeypatch):
    """Repeated pairs come back as often, pairs with an unknown node not at all."""
    import numpy as np

    monkeypatch.setattr(G, "PAIR_BYTES", 64)
    e = np.random.default_rng(4).standard_normal((9, 5))
    vecs = spark.createDataFrame([(n, e[n].tolist()) for n in range(9)], "node bigint, emb array<double>")
    pairs = [(i % 4, 4 + i % 5, i) for i in range(30)] + [(0, 4, 0), (0, 77, 1), (None, 4, 2)]
    got = G.pair_dots(spark.createDataFrame(pairs, "u bigint, i bigint, at int"), vecs, "u", "i").collect()
    assert sorted((r["u"], r["i"], r["at"]) for r in got) == sorted(p for p in pairs if p[0] is not None and p[1] != 77)
    assert all(np.isclose(r["dot"], e[r["u"]] @ e[r["i"]]) for r in got)


def test_sums_of_neighbours(spark, monkeypatch):
    """Implicit terms come from the grid: items without a vector add nothing, repeated rows count each."""
    import numpy as np

    from recfold.operators import factor_models as FM

    monkeypatch.setattr(G, "CELL_EDGES", 3)
    e = np.random.default_rng(5).standard_normal((4, 18))
    vecs = spark.createDataFrame([(n, e[n].tolist()) for n in range(4)] + [(9, None)], "movie_id bigint, emb array<double>")
    train = spark.createDataFrame([(1, 0), (1, 0), (1, 3), (2, 9), (3, 1), (3, 77), (None, 2)], "user_id bigint, movie_id bigint")
    got = {(r["user_id"], r["dim"]): r["z"] for r in FM.implicit_term(train, vecs).collect()}
    want = {1: (2 * e[0] + e[3]) / 3 ** 0.5, 3: e[1] / 2 ** 0.5}
    assert set(got) == {(u, d) for u in want for d in range(18)}
    assert all(np.isclose(z, want[u][d]) for (u, d), z in got.items())


def test_propagation_in_several_jobs(spark, monkeypatch):
    """A layer beyond a job's bytes is computed by runs of blocks and of groups of sources; their tables go when a run ends."""
    import os

    import numpy as np

    from recfold import session

    monkeypatch.setattr(G, "CELL_EDGES", 9)
    monkeypatch.setattr(G, "SUM_BYTES", 900)
    rng = np.random.default_rng(7)
    a, e = np.zeros((14, 14)), rng.standard_normal((14, 40))
    rows = [(int(s), int(d), float(x)) for s, d, x in zip(rng.integers(0, 14, 50), rng.integers(0, 14, 50), rng.random(50))]
    for s, d, x in rows:
        a[s, d] += x
    w = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    emb = spark.createDataFrame([(n, e[n].tolist()) for n in range(14)], "node bigint, emb array<double>")
    layer, made = G._layer, []
    monkeypatch.setattr(G, "_layer", lambda w, cur, rows, cols, blocks, some=None: made.append((blocks, some)) or layer(w, cur, rows, cols, blocks, some))
    folder = f"{session.ensure_checkpoint_dir(spark).removeprefix('file:').replace('//', '/')}/tables"
    for most, jobs in ((1, 3 * 6), (2_000, 3), (1 << 40, 1)):
        monkeypatch.setattr(G, "JOB_BYTES", most)
        made.clear()
        before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
        got = G.block_arrays(*G.propagate_blocks(w, emb, 2)).collect()
        assert len(made) >= 2 * jobs and all(len(b) < 3 for b, _ in made) == (most < 1 << 40)
        want = (e + a @ e + a @ a @ e) / 3
        assert len(got) == 14 and all(np.allclose(r["emb"], want[r["node"]]) for r in got)
        left = [x for x in set(os.listdir(folder)) - before if x.startswith("layer-")]
        assert len(left) == (1 if most < 1 << 40 else 3)


def test_cells_are_bounded_by_their_sums():
    """Many sources in a cell make more groups of sources, also with few edges; a cell's rows come in small batches."""
    import numpy as np
    import pyarrow as pa

    rows, cols = G._grid(1_000, 8_000_000, 4, 1, 8_000_000)
    assert 8_000_000 / rows * 8 * (G.BLOCK + 1) <= G.SUM_BYTES and cols == 1
    n = 150_000
    edges = pa.table({"src": np.arange(n), "node": np.zeros(n, int), "weight": np.ones(n)})
    vecs = pa.table({"node": [0], "blk": pa.array([2], pa.int32()), **{c: [float(k)] for k, c in enumerate(G._COLS)}})
    out = G._cell_sums(edges, vecs)
    assert out.num_rows == n and max(b.num_rows for b in out.to_batches()) <= 65_536 and set(out["v7"].to_pylist()) == {7.0}


def test_inner_products_in_several_jobs(spark, monkeypatch):
    import numpy as np

    from recfold import session

    monkeypatch.setattr(G, "PAIR_BYTES", 64)
    monkeypatch.setattr(G, "JOB_BYTES", 1)
    write, labels = session.materialize, []
    monkeypatch.setattr(session, "materialize", lambda df, label="table": labels.append(label) or write(df, label))
    e = np.random.default_rng(4).standard_normal((9, 5))
    vecs = spark.createDataFrame([(n, e[n].tolist()) for n in range(9)], "node bigint, emb array<double>")
    pairs = [(i % 4, 4 + i % 5, i) for i in range(30)] + [(0, 4, 0), (0, 77, 1), (None, 4, 2)]
    got = G.pair_dots(spark.createDataFrame(pairs, "u bigint, i bigint, at int"), vecs, "u", "i").collect()
    assert labels.count("dots") > 2 and labels.count("named") == 2
    assert sorted((r["u"], r["i"], r["at"]) for r in got) == sorted(p for p in pairs if p[0] is not None and p[1] != 77)
    assert all(np.isclose(r["dot"], e[r["u"]] @ e[r["i"]]) for r in got)
