import os

import pytest

from tests.conftest import spark  # noqa: F401

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def frame(spark, rows, schema="doc_id long, text string"):  # noqa: F811
    return spark.createDataFrame(rows, schema)


def least_reachable(n, linked):
    """Smallest index reachable by ``linked(i, j)``, for every index."""
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
