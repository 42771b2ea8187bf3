import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions import vectors as vec


def encoding(p, dim):
    return [
        (math.cos if i % 2 else math.sin)(p / 10000 ** (2 * (i // 2) / dim)) for i in range(dim)
    ]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_position_zero(spark):
    assert one(spark, vec.position_code(0, 4)) == [0.0, 1.0, 0.0, 1.0]


@pytest.mark.parametrize("dim", [1, 3, 50, 64])
def test_encoding_of_column_and_literal_agree(spark, dim):
    rows = spark.range(9).select("id", vec.positional_encoding(F.col("id"), dim).alias("v"))
    for row in rows.collect():
        assert row.v == one(spark, vec.position_code(row.id, dim))
        assert row.v == pytest.approx(encoding(row.id, dim), abs=1e-6)


def test_literal_encoding_is_a_constant_in_the_plan(spark):
    df = spark.range(1).select(vec.position_code(3, 8).alias("v"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sin" not in plan.lower() and "pow" not in plan.lower()


def test_vector_add_needs_equal_length(spark):
    def floats(*v):
        return F.array(*[F.lit(x) for x in v]).cast("array<float>")

    assert one(spark, vec.vector_add(floats(1.0, 2.0), floats(0.5, 0.25), 2)) == [1.5, 2.25]
    assert one(spark, vec.vector_add(floats(1.0, 2.0), floats(1.0, 1.0, 1.0), 3)) == [0, 0, 0]


def test_transpose_and_tile(spark):
    matrix = F.expr("array(array(1f, 2f), array(3f, 4f), array(5f, 6f))")
    assert one(spark, vec.to_time_series(matrix, 2)) == [[1, 3, 5], [2, 4, 6]]
    assert one(spark, vec.to_time_series(F.expr("array(array(1f, 2f))"), 2)) == [[1], [2]]
    assert one(spark, vec.tile_target(F.expr("array(1f, 2f)"), 3)) == [[1, 2]] * 3


def test_pack_vector_and_prefix(spark):
    df = spark.createDataFrame([(1, 0.5, None)], "id int, embedding1 double, embedding2 double")
    names = vec.vector_columns(df)
    assert names == ["embedding1", "embedding2"]
    assert df.select(vec.pack_vector(*names).alias("v")).first().v == [0.5, 0.0]


def test_l2_norm(spark):
    assert one(spark, vec.l2_norm(F.expr("array(3f, 4f)"))) == 5.0
    values = np.random.default_rng(1).normal(size=40)
    column = F.array(*[F.lit(float(x)) for x in values])
    assert one(spark, vec.l2_norm(column)) == pytest.approx(np.linalg.norm(values))
