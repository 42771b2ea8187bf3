import pytest
from pyspark.sql import functions as F

from seqloom.config import Settings
from seqloom.plans.prepare import prepare_examples
from seqloom.sources import examples as stored
from seqloom.sources import published
from seqloom.sources.published import drop_versions, publish, read_published, versions, write_small_file


def numbers(spark, count):
    return spark.range(count).repartition(3)


def test_last_version_is_read_and_older_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish(numbers(spark, 5), path, counts={"even": F.count_if(F.col("id") % 2 == 0)})
    second = publish(numbers(spark, 9), path)
    assert (first.number, first.rows, first.details) == (1, 5, {"even": 3})
    assert (second.number, second.rows, second.details) == (2, 9, {})
    assert read_published(spark, path).count() == 9
    assert read_published(spark, path, "id bigint", version=1).count() == 5
    assert [v.number for v in versions(spark, path)] == [1, 2]
    with pytest.raises(ValueError, match="no version 7"):
        read_published(spark, path, version=7)


def test_a_failed_write_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    broken = numbers(spark, 50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        publish(broken, path)
    # nothing is there yet, and what was half written is not read
    with pytest.raises(ValueError, match="no published version"):
        read_published(spark, path)
    publish(numbers(spark, 4), path)
    with pytest.raises(Exception, match="stopped"):
        publish(broken, path)
    assert sorted(r.id for r in read_published(spark, path).collect()) == [0, 1, 2, 3]
    assert len(list((tmp_path / "t/versions").iterdir())) == 3
    assert drop_versions(spark, path, keep=1) == 2
    assert read_published(spark, path).count() == 4


def test_a_check_that_raises_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(numbers(spark, 4), path)

    def refuse(rows):
        assert rows == 6
        raise ValueError("six are too many")

    with pytest.raises(ValueError, match="six"):
        publish(numbers(spark, 6), path, check=refuse)
    assert read_published(spark, path).count() == 4


def test_a_reader_of_an_old_version_is_not_disturbed(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(numbers(spark, 4), path)
    before = read_published(spark, path)
    publish(before.select((F.col("id") + 100).alias("id")), path)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2, 3]
    assert min(r.id for r in read_published(spark, path).collect()) == 100


def test_two_writers_get_two_numbers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(numbers(spark, 1), path)
    known = published._manifests
    stale = [known(spark, path)]

    def late(session, where):
        # the first look misses what another writer has published meanwhile
        return stale.pop() if stale else known(session, where)

    publish(numbers(spark, 2), path)
    monkeypatch.setattr(published, "_manifests", late)
    assert publish(numbers(spark, 3), path).number == 3
    assert [v.rows for v in versions(spark, path)] == [1, 2, 3]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for count in (1, 2, 3, 4):
        publish(numbers(spark, count), path)
    assert drop_versions(spark, path, keep=2) == 2
    assert [v.rows for v in versions(spark, path)] == [3, 4]
    assert read_published(spark, path).count() == 4
    with pytest.raises(ValueError, match="at least one"):
        drop_versions(spark, path, keep=0)


def test_small_files_appear_once(spark, tmp_path):
    target = str(tmp_path / "dir/note.json")
    assert write_small_file(spark, target, "ä one")
    assert not write_small_file(spark, target, "two")
    assert (tmp_path / "dir/note.json").read_text() == "ä one"
    assert [p.name for p in (tmp_path / "dir").iterdir() if not p.name.endswith(".crc")] == ["note.json"]


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    path = str(tmp_path / "plain")
    numbers(spark, 7).write.parquet(path)
    assert read_published(spark, path).count() == 7


def test_examples_are_published_by_split(spark, stream, vectors, tmp_path):
    path = str(tmp_path / "e")
    table = vectors({t: [float(t), 1.0] for t in range(5)})
    settings = Settings(embedding_dim=2, window_size=3)
    counts = prepare_examples(stream([k % 7 for k in range(200)]), table, settings, path)
    rows = stored.scan_examples(spark, path)
    sides = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert counts["splits"] == sides and sum(sides.values()) == counts["examples"]["kept"] == 197
    assert counts["tokens"] == {"n_rows": 200, "null_ids": 0}
    plan = rows.filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    # an empty stream raises and leaves the examples as they are
    with pytest.raises(ValueError, match="no tokens"):
        prepare_examples(stream([]), table, settings, path)
    assert stored.scan_examples(spark, path).count() == 197
    # one shorter than a window is no error
    assert prepare_examples(stream([1, 2]), table, settings, path)["examples"] == {"kept": 0, "dropped": 0}
    assert stored.scan_examples(spark, path).count() == 0


def test_preparing_reads_the_stream_once(spark, vectors, tmp_path):
    path = str(tmp_path / "tokens")
    spark.range(300).select(F.col("id").alias("idx"), (F.col("id") % 5).cast("int").alias("token_id")).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(token):
        read.add(1)
        return token

    tokens = spark.read.parquet(path).withColumn("token_id", seen("token_id"))
    table = vectors({t: [float(t), 1.0] for t in range(5)})
    counts = prepare_examples(tokens, table, Settings(embedding_dim=2, window_size=3), str(tmp_path / "e"))
    assert counts["tokens"]["n_rows"] == read.value == 300
