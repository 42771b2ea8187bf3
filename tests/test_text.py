import pytest
from pyspark.sql import functions as F

from seqloom.functions import text

CASES = [
    ("[1, 2, 3]", [1, 2, 3]),
    (" [1,2] ", [1, 2]),
    ("1 2", [1, 2]),
    ("1,,2", [1, 2]),
    ("\t[+4 -5\n6]\x00", [4, -5, 6]),
    ("[2147483647]", [2147483647]),
    ("[]", []),
    ("", []),
    (None, []),
    ("[8, x, 9]", []),
    ("[[1,2]]", []),
    ("[1, 5.0]", []),
    ("[99999999999]", []),
    ("[1", [1]),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_id_list(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame(
            [(n, t) for n, (t, _) in enumerate(CASES)], "n int, tokens string"
        )
        found = rows.select("n", text.parse_id_list(F.col("tokens")).alias("ids")).orderBy("n")
        assert [r.ids for r in found.collect()] == [ids for _, ids in CASES]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_bad_lists_are_told_from_empty_ones(spark):
    rows = spark.createDataFrame(
        [("[]",), ("",), (None,), ("[1]",), ("[8, x]",), ("[[1]]",)], "tokens string"
    )
    found = rows.select(text.is_bad_id_list(F.col("tokens")).alias("bad")).collect()
    assert [r.bad for r in found] == [False, False, False, False, True, True]


def test_words_keep_order_and_case(spark):
    row = spark.range(1).select(text.words(F.lit("  Ab c\n\nd ")).alias("w")).first()
    assert row.w == ["Ab", "c", "d"]
