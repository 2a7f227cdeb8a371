import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablescope.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", 4, "4g")


@pytest.fixture(scope="session")
def mixed(spark):
    rows = [
        (20, 1000.0, "Norte", "si", "2020-01-01"), (35, 2000.0, "Sur", "no", "2020-02-01"), (40, None, "Norte", "si", "2020-03-01"),
        (25, 1500.0, "Sur", "no", "2020-04-01"), (60, 5000.0, "Centro", "si", "2020-05-01"), (33, 1800.0, "Norte", "no", "2020-06-01"),
    ]
    return spark.createDataFrame(rows, "edad bigint, ingreso double, region string, activo string, fecha string")


@pytest.fixture(scope="session")
def groups(spark):
    """Three round groups of 30 points each."""
    rng = np.random.default_rng(0)
    rows = []
    for g, (cx, cy) in enumerate([(0, 0), (20, 20), (40, 0)]):
        for x, y in rng.normal(0, 1, (30, 2)) + [cx, cy]:
            rows.append((len(rows), float(x), float(y), "abc"[g]))
    return spark.createDataFrame(rows, "id bigint, x double, y double, grupo string")


@pytest.fixture(scope="session")
def outlier(spark):
    rows = [(i, i + 1, i) for i in range(30)] + [(30, 10000, 30)]
    return spark.createDataFrame(rows, "id bigint, valor bigint, otro bigint")


def frame(spark, schema, *columns):
    return spark.createDataFrame(list(zip(*columns)), schema)
