import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, limit=0.9):
    """Sorted (id, n_links, component) by all pairs."""
    def good(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if good(v) else None for _, v in rows]
    n, links = len(rows), [[] for _ in rows]
    by_length = {}
    for i, u in enumerate(unit):
        if u is not None:
            by_length.setdefault(len(u), []).append(i)
    for at in by_length.values():
        x = np.stack([unit[i] for i in at])
        for a, b in zip(*np.nonzero(x @ x.T >= limit)):
            if a != b:
                links[at[a]].append(at[b])
    big = float("inf")
    comp = [big if rows[i][0] is None else rows[i][0] for i in range(n)]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([comp[i], *(comp[j] for j in links[i])])
            if low < comp[i]:
                comp[i], changed = low, True
    return sorted((str(rows[i][0]), len(links[i]), str(None if comp[i] == big else comp[i])) for i in range(n))


def collect(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"] if r["vec_id"] is not None else r["component_id"] is None) for r in rows)
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows)


def groups(seed=3, d=24):
    """Random vectors, tight and loose groups, chains, copies, scaled copies and odd ones."""
    rnd = np.random.default_rng(seed)
    rows = [(1000 + i, rnd.normal(size=d).tolist()) for i in range(150)]
    for size, noise in ((60, 0.03), (40, 0.25), (25, 0.4)):
        centre = rnd.normal(size=d)
        centre /= np.linalg.norm(centre)
        rows += [(len(rows) * 3, (centre + noise * rnd.normal(size=d) / d ** 0.5).tolist()) for _ in range(size)]
    at = rnd.normal(size=d)
    for i in range(12):  # a chain: neighbours are alike, its ends are not
        at = at / np.linalg.norm(at) + 0.35 * rnd.normal(size=d) / d ** 0.5
        rows.append((9000 - i, at.tolist()))
    same = rnd.normal(size=d).tolist()
    rows += [(7000 + i, same) for i in range(30)] + [(6500, [2 * x for x in same]), (7000, same)]
    rows += [(1, None), (2, []), (3, [0.0] * d), (4, [None] + [1.0] * (d - 1)), (5, [float("nan")] + [1.0] * (d - 1)), (6, [float("inf")] + [1.0] * (d - 1)),
             (7, [1.0, 0.0]), (8, [1.0, 0.1]), (9, [1e-38] * d), (10, [3e38] * d), (None, same), (None, [-x for x in same]), (11, [-0.0, 1.0]), (12, [0.0, 1.0])]
    return rows


def df_of(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block", [op.BLOCK, 16], ids=["whole", "blocks"])
def test_brute_force(spark, llm_scratch, block):
    rows = groups()
    got = collect(op.near_vectors(df_of(spark, rows), llm_scratch(), block=block))
    assert got == brute(rows)


def test_cells_do_not_matter_when_all_are_probed(spark, llm_scratch):
    rows = groups(5)
    one = collect(op.near_vectors(df_of(spark, rows), llm_scratch(), max_cells=1))
    assert one == brute(rows)


def test_links_at_the_limit(spark, llm_scratch):
    rows = [(1, [1.0, 0.0]), (2, [0.9, (1 - 0.81) ** 0.5]), (3, [0.0, 1.0]), (4, [0.8999, 0.5])]
    assert collect(op.near_vectors(df_of(spark, rows), llm_scratch())) == brute(rows)


def test_clashing_columns_other_types_and_empty_table(spark, llm_scratch):
    rows = [(i, v) for i, v in groups(7) if v is None or len(v) != 24 or i is None or i > 5000]
    df = df_of(spark, rows).withColumns({c: F.lit(1) for c in ("id", "vec", "k1", "k2", "cls", "copies", "cells", "core", "node", "dim", "links")})
    assert collect(op.near_vectors(df, llm_scratch())) == brute(rows)
    assert collect(op.near_vectors(df.limit(0), llm_scratch())) == []
    assert collect(op.near_vectors(df.withColumn("embedding", F.col("embedding").cast("array<double>")), llm_scratch())) == brute(rows)
    ints = spark.createDataFrame([(1, [1, 0]), (2, [2, 0]), (3, [0, 5])], "vec_id long, embedding array<int>")
    assert collect(op.near_vectors(ints, llm_scratch())) == [("1", 1, "1"), ("2", 1, "1"), ("3", 0, "3")]


def test_recall_at_the_limit(spark, llm_scratch):
    """Random vectors, each with a partner at a cosine just over the limit: the worst case for cells."""
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rnd.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.905 * x + (1 - 0.905 ** 2) ** 0.5 * y
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    found = op.near_vectors(df_of(spark, rows), llm_scratch()).agg(F.sum("n_links")).first()[0] / 2
    assert found >= 0.98 * 3000
