import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recfold.session import local_session
    s = local_session("*", 8, app="recfold-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def ratings_a1(spark):
    """FIXTURES A1: three users, ten ratings."""
    import datetime as dt
    rows = [(1, 10, 5, "2002-01-01"), (1, 20, 4, "2002-02-01"), (1, 30, 3, "2002-03-01"),
            (2, 10, 2, "2003-01-01"), (2, 40, 4, "2003-06-01"),
            (3, 10, 5, "2001-01-01"), (3, 20, 5, "2001-06-01"), (3, 30, 4, "2002-01-01"),
            (3, 40, 3, "2003-01-01"), (3, 50, 5, "2004-01-01")]
    data = [(u, m, r, dt.date.fromisoformat(d)) for u, m, r, d in rows]
    return spark.createDataFrame(data, "user_id bigint, movie_id bigint, rating int, date date")
