"""The pivot index against brute force: links found are right, and nearly all are found."""

import numpy as np
import pytest
from pyspark.sql import types as T

from tarmac.llm import pivot_index as pi

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
])


def table(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 0, "n") for i, v in rows], SCHEMA)


def brute(rows):
    units = {i: pi.unit_vector(None if v is None else np.array(v, np.float32).astype(object)) for i, v in rows}
    ids = sorted(units)
    links = {i: {j for j in ids if j != i and units[i] is not None and units[j] is not None and units[i] @ units[j] >= 0.95} for i in ids}
    component = {}
    for i in ids:
        if i not in component:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in component:
                    component[x] = i
                    todo += links[x]
    return {i: (len(links[i]), component[i], component[i] == i) for i in ids}


def planted(size=24):
    draw = np.random.default_rng(2)
    rows, i = [], 0
    for group, noise in ((40, 0.02), (25, 0.04), (70, 0.0), (30, 0.05), (8, 0.06)):
        center = draw.normal(size=size)
        for _ in range(group):
            rows.append((i, center + noise * draw.normal(size=size)))
            i += 1
    rows += [(i + k, draw.normal(size=size)) for k in range(300)]
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_links_of_planted_groups(spark, block):
    rows = planted()
    want = brute(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pi.near_vectors(spark, table(spark, rows), block=block).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in got)  # nothing below the threshold
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert np.mean([got[i][1:] == want[i][1:] for i in got]) > 0.98


def test_rows_that_link_with_nothing(spark):
    v, nan = [1.0, 2.0, 3.0], float("nan")
    rows = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]), (5, []), (6, [float("inf"), 1.0, 1.0]),
            (7, v), (8, v), (9, [2.0, 4.0, 6.0]), (10, [-1.0, -2.0, -3.0]), (11, [1.0, 2.0])]
    got = {r["vec_id"]: tuple(r)[1:] for r in pi.near_vectors(spark, table(spark, rows)).collect()}
    for i in (1, 2, 3, 4, 5, 6, 10, 11):
        assert got[i] == (0, i, True)
    assert got[7] == (2, 7, True) and got[8] == (2, 7, False) and got[9] == (2, 7, False)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    v = [1.0, 0.5, 0.25]
    got = pi.near_vectors(spark, table(spark, [(4, v), (4, v), (None, v), (None, None)])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(4, 2, 4, True), (4, 2, 4, True), (None, 2, None, True), (None, 0, None, True)]))
    assert pi.near_vectors(spark, table(spark, [])).count() == 0
    assert pi.near_vectors(spark, table(spark, [(3, None)])).collect()[0]["component_id"] == 3


def test_huge_components_do_not_overflow(spark):
    rows = [(1, [3e38, 3e38]), (2, [1.0, 1.0]), (3, [1e-44, 1e-44])]
    assert {r["n_links"] for r in pi.near_vectors(spark, table(spark, rows)).collect()} == {2}
