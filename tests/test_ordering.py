import random

import pytest

from docweave.operators import curation
from docweave.operators.ordering import positions


@pytest.mark.parametrize("by", [(), ("g",)])
def test_positions_equal_sorting(spark, by):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string, x int").repartition(7)
    got = {r.id: r.place for r in positions(df, "place", ["x", "id"], by).collect()}
    want = {}
    groups = {None: rows} if not by else {}
    if by:
        for r in rows:
            groups.setdefault(("", r[1]), []).append(r)
    for held in groups.values():
        want |= {r[0]: n for n, r in enumerate(sorted(held, key=lambda r: (r[2], r[0])), 1)}
    assert got == want


def test_evenly_and_batches_over_all_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "v").repartition(5)
    assert sorted(r.v for r in curation.evenly(df, "v", 7).collect()) == [(i * 1000) // 7 for i in range(7)]
    assert curation.evenly(spark.range(3), "id", 7).count() == 3
    got = {r.v: r.batch for r in curation.batches(df, 64, "v").collect()}
    assert got == {v: v // 64 for v in range(1000)}


def test_positions_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(2, "b", 1), (1, "a", 1), (3, "c", 2)], "range long, Row string, `by_0` int")
    got = {(r.range, r.Row, r.by_0): r.n for r in positions(df, "n", ["range"], ["by_0"]).collect()}
    assert got == {(1, "a", 1): 1, (2, "b", 1): 2, (3, "c", 2): 1}
