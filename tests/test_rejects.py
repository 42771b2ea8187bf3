from pyspark.sql import functions as F

from seqloom.operators.examples import keep_complete
from seqloom.sources import embeddings, rejects, tokens


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def places(split):
    return sorted((r.path.split("/")[-1], r.row, r.raw, r.reason) for r in split.rejected.collect())


def test_embedding_rows(spark, tmp_path):
    folder = tmp_path / "e"
    folder.mkdir()
    put(folder / "a.csv", "tokenId,embedding1,embedding2\n1,0.5,1\nx2,0.5,1\n,1,1\n3,bad,2\n1,7,8\n")
    put(folder / "b.csv", "tokenId,embedding1,embedding2\n3,9,9\n99999999999,1,1\n4,1,1\n")
    found = rejects.scan_embeddings_csv(spark, str(folder), 2)
    assert places(found) == [
        ("a.csv", 0, "1", "replaced"),
        ("a.csv", 1, "x2,0.5,1", "unreadable id"),
        ("a.csv", 2, None, "no id"),
        ("a.csv", 3, "3", "replaced"),
        ("b.csv", 1, "99999999999,1,1", "unreadable id"),
    ]
    kept = sorted((r.token_id, r.vec) for r in found.kept.collect())
    assert kept == [(1, [7.0, 8.0]), (3, [9.0, 9.0]), (4, [1.0, 1.0])]
    assert kept == sorted((r.token_id, r.vec) for r in embeddings.scan_embeddings_csv(spark, str(folder), 2).collect())


def test_a_file_scanned_in_pieces_counts_rows_by_piece(spark, tmp_path):
    lines = [f"{k if k % 10 else 'x'},{k}.0" for k in range(400)]
    path = put(tmp_path / "e.csv", "tokenId,embedding1\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = rejects.scan_embeddings_csv(spark, path, 1)
        rejected, kept = found.rejected.collect(), found.kept.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert kept == 360 and len({r.start for r in rejected}) > 3
    # the pieces in order, and the rows in them, give the rows of the file
    assert [r.raw for r in sorted(rejected, key=lambda r: (r.start, r.row))] == [f"x,{k}.0" for k in range(0, 400, 10)]


def test_token_lists(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'tokens\n"[1, 2]"\n"[1, x]"\n"[ ]"\n"[3]"\n"[[4]]"\n')
    found = rejects.scan_token_lists(spark, path)
    assert places(found) == [("t.csv", 1, "[1, x]", "unreadable list"), ("t.csv", 4, "[[4]]", "unreadable list")]
    kept = sorted((r.idx, r.token_id) for r in found.kept.collect())
    assert kept == [(0, 1), (1, 2), (2, 3)]
    assert kept == sorted((r.idx, r.token_id) for r in tokens.scan_token_lists(spark, path).collect())


def test_nothing_is_rejected_from_clean_or_empty_files(spark, tmp_path):
    clean = rejects.scan_embeddings_csv(spark, put(tmp_path / "c.csv", "tokenId,embedding1\n1,1\n2,2\n"), 1)
    assert clean.rejected.count() == 0 and clean.kept.count() == 2
    empty = rejects.scan_embeddings_csv(spark, put(tmp_path / "e.csv", "tokenId,embedding1\n"), 1)
    assert empty.rejected.count() == 0 and empty.kept.count() == 0
    lists = rejects.scan_token_lists(spark, put(tmp_path / "t.csv", "tokens\n"))
    assert lists.rejected.count() == 0 and lists.kept.count() == 0


def test_examples_and_their_reasons(spark):
    rows = [
        (1, [[1.0], [2.0]], [1.0]),
        (2, [[1.0]], [1.0]),
        (3, None, [1.0]),
        (4, [[1.0], [2.0]], None),
        (5, [[1.0], [2.0]], [1.0, 2.0]),
        (6, [[1.0], [2.0, 3.0]], [1.0]),
    ]
    df = spark.createDataFrame(rows, "example_id bigint, x array<array<float>>, y array<float>")
    kept, rejected = rejects.split_examples(df, 2, 1)
    assert [r.example_id for r in kept.collect()] == [1]
    assert {r.example_id: r.reason for r in rejected.collect()} == {
        2: "input of another height",
        3: "no input",
        4: "no target",
        5: "target of another length",
        6: "input row of another length",
    }
    why = df.filter(rejects.why_incomplete(2, 1).isNull())
    assert why.exceptAll(keep_complete(df, 2, 1)).isEmpty() and why.select(F.count("*")).first()[0] == 1
