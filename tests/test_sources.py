"""File fixtures (FIXTURES C): block files split into many 4 KB pieces,
titles with commas / quotes / accents / missing years, CSV fallback, splits,
id maps, and the sinks that write them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from recfold.sinks import writers as K
from recfold.sources import blocks as SB
from recfold.sources import files as SF


def _write_blocks(d):
    # file 1: a row before any header, a blank line, a two-field row, an empty block
    lines1 = ["7,3,2005-01-01", "1:"]
    lines1 += [f"{u},{1 + u % 5},2005-09-{1 + u % 28:02d}" for u in range(1, 400)]
    lines1 += ["", "2:", "55,4", "3:", "4:"]
    lines1 += [f"{u},{1 + u % 5},2004-01-{1 + u % 28:02d}" for u in range(1000, 1500)]
    # file 2: continues without a header first (carry across files in lenient mode)
    lines2 = [f"{u},2,2003-03-03" for u in range(1, 50)] + ["5:"] + \
             [f"{u},5,2002-02-02" for u in range(2000, 2300)]
    with open(os.path.join(d, "combined_data_1.txt"), "w") as f:
        f.write("\n".join(lines1) + "\n")
    with open(os.path.join(d, "combined_data_2.txt"), "w") as f:
        f.write("\n".join(lines2) + "\n")
    return lines1, lines2


def _python_parse(lines, lenient, start=None):
    cur = start if lenient else -1
    out = []
    for ln in lines:
        ln = ln.strip()
        if not ln:
            continue
        if ln.endswith(":"):
            cur = int(ln[:-1])
            continue
        p = ln.split(",")
        if lenient:
            if len(p) < 2:
                continue
            out.append((int(p[0]), cur, float(p[1]), p[2] if len(p) > 2 else None))
        else:
            if len(p) != 3:
                continue
            out.append((int(p[0]), cur, int(p[1]), p[2]))
    return out, cur


@pytest.mark.parametrize("lenient", [False, True])
def test_block_reader_small_splits(spark, tmp_dir, lenient):
    l1, l2 = _write_blocks(tmp_dir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = SB.read_blocks(spark, os.path.join(tmp_dir, "combined_data_*.txt"), lenient=lenient)
        got = sorted((r.user_id, -999 if r.movie_id is None else r.movie_id, r.rating,
                      "" if r.date is None else str(r.date)) for r in df.collect())
        n_splits = spark.read.text(os.path.join(tmp_dir, "combined_data_*.txt")).rdd.getNumPartitions()
        assert n_splits > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    a, cur = _python_parse(l1, lenient)
    b, _ = _python_parse(l2, lenient, start=cur if lenient else None)
    want = sorted((u, -999 if m is None else m, r, "" if d is None else d) for u, m, r, d in a + b)
    assert got == want


def test_ratings_dir_falls_back_to_csv(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "ratings.csv"), "w") as f:
        f.write("user_id,movie_id,rating,date\n1,10,4,2005-01-01\n2,10,3.5,2005-01-02\n")
    df = SF.read_ratings_dir(spark, tmp_dir)
    assert sorted((r.user_id, r.rating) for r in df.collect()) == [(1, 4.0), (2, 3.5)]


def test_ratings_csv_requires_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ratings.csv")
    with open(p, "w") as f:
        f.write("user_id,rating\n1,4\n")
    with pytest.raises(ValueError):
        SF.read_ratings_csv(spark, p)


def test_no_input_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        SF.read_ratings_dir(spark, tmp_dir)


def test_titles_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "movie_titles.csv")
    content = ("1,2003,Dinosaur Planet\n"
               "2,2004,Isle of Man TT 2004 Review, Part 2\n"
               '3,1997,"Quoted" Title\n'
               "4,NULL,Unknown Year\n"
               "5,,Empty Year\n"
               "6,1999\n"
               "7,2001,Amélie\n")
    with open(p, "wb") as f:
        f.write(content.encode("ISO-8859-1"))
    got = {r.movie_id: (r.year, r.title) for r in SF.read_titles(spark, p).collect()}
    assert got == {1: (2003, "Dinosaur Planet"), 2: (2004, "Isle of Man TT 2004 Review, Part 2"),
                   3: (1997, '"Quoted" Title'), 4: (None, "Unknown Year"), 5: (None, "Empty Year"),
                   7: (2001, "Amélie")}


def test_splits_maps_roundtrip(spark, tmp_dir, ratings_a1):
    from recfold.operators.prep import dense_ids
    from recfold.operators.splits import split_temporal_per_user
    sp = split_temporal_per_user(ratings_a1)
    um, mm = dense_ids(ratings_a1, "user_id"), dense_ids(ratings_a1, "movie_id")
    K.write_splits(sp, tmp_dir, um, mm)
    test = SF.read_split(spark, f"{tmp_dir}/splits", "test")
    assert test.count() == sp.where("split = 'test'").count()
    K.write_id_maps_json(um, mm, f"{tmp_dir}/ids")
    users, movies = SF.read_id_maps(spark, f"{tmp_dir}/ids")
    assert sorted((r.orig_id, r.idx) for r in users.collect()) == [(1, 0), (2, 1), (3, 2)]
    assert movies.count() == 5
    # the reference's single-document file
    with open(f"{tmp_dir}/id_mappings.json", "w") as f:
        json.dump({"user2idx": {"1": 0, "2": 1, "3": 2}, "movie2idx": {"10": 0, "20": 1},
                   "n_users": 3, "n_movies": 2}, f, indent=2)
    du, dm = SF.read_id_maps_document(spark, f"{tmp_dir}/id_mappings.json")
    assert sorted((r.orig_id, r.idx) for r in du.collect()) == [(1, 0), (2, 1), (3, 2)]
    assert sorted((r.orig_id, r.idx) for r in dm.collect()) == [(10, 0), (20, 1)]
    stats = K.write_splits_csv(sp, f"{tmp_dir}/csv", um, mm).first()
    assert stats["n_train"] + stats["n_val"] + stats["n_test"] == 10
    back = SF.read_split(spark, f"{tmp_dir}/csv", "train")
    assert back.count() == stats["n_train"]


def test_recs_csv_format(spark, tmp_dir):
    recs = spark.createDataFrame([(2, 1, 5, 3.4548625), (1, 1, 7, 4.0), (1, 2, 8, 3.5)],
                                 "user_id long, rank int, movie_id long, score double")
    K.write_recs(recs, f"{tmp_dir}/recs")
    rows = spark.read.option("header", True).csv(f"{tmp_dir}/recs").collect()
    assert [(r.user_id, r.rank, r.score) for r in rows] == [("1", "1", "4.000000"), ("1", "2", "3.500000"),
                                                             ("2", "1", f"{3.4548625:.6f}")]


def test_model_save_load(spark, tmp_dir, ratings_a1):
    from recfold.operators.models import fit_bias
    m = fit_bias(ratings_a1)
    K.save_model(m, f"{tmp_dir}/m")
    m2 = K.load_model(spark, f"{tmp_dir}/m")
    pairs = ratings_a1.select("user_id", "movie_id")
    a = {(r.user_id, r.movie_id): r.predicted_rating for r in m.score(pairs).collect()}
    b = {(r.user_id, r.movie_id): r.predicted_rating for r in m2.score(pairs).collect()}
    assert a == b
