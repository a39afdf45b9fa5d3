"""Driver contract: the flagship runs on the smoke tables, every oracle belongs
to a registered query, and every operator of the survey has a query."""

import re

from __spark_entry__ import entry, oracle_sql, queries

#: Operators by family; P4 is a plan-time check without a result.
FAMILIES = {"s": 8, "k": 8, "p": 6, "f": 6, "w": 6, "a": 14, "g": 9, "m": 12, "e": 11, "t": 3, "v": 14, "n": 12}
NO_QUERY = {"p4"}


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "rank", "movie_id", "score", "title", "year"]
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per_user.values())


def test_oracles_have_queries():
    assert set(oracle_sql()) <= set(queries())


def test_every_operator_has_a_query():
    named = set()
    for q in queries():
        ids = re.match(r"((?:[a-z][0-9]+_)+)", q)
        parts = [] if ids is None else ids[1].strip("_").split("_")
        named.update(parts)
        for a, b in zip(parts, parts[1:]):  # v3_v7_... stands for the range
            if a[0] == b[0]:
                named.update(f"{a[0]}{i}" for i in range(int(a[1:]), int(b[1:]) + 1))
    want = {f"{f}{i}" for f, n in FAMILIES.items() for i in range(1, n + 1)} - NO_QUERY
    # S3 is S1 over many files, V10 a column of the per-user ranking metrics
    assert want - named == {"s3", "v10"}
