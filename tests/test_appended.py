import pytest

from seqloom.sources import published
from seqloom.sources.appended import append_token_lists, read_appended
from seqloom.sources.tokens import scan_token_lists


def put(folder, name, *lists):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("tokens\n" + "".join(f'"{line}"\n' for line in lists))


def rows(df):
    return sorted((r.idx, r.token_id) for r in df.collect())


def test_parts_equal_one_pass(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", "[1, 2]", "[3]")
    put(source, "b.csv", "[4]")
    assert append_token_lists(spark, str(source), path).details["next"] == 4
    put(source, "c.csv", "[5, 6]", "[x]", "[]")
    put(source, "d.csv", "[7]")
    put(source, "_hidden.csv", "[99]")
    part = append_token_lists(spark, str(source), path)
    assert (part.rows, part.details["next"]) == (3, 7)
    assert rows(read_appended(spark, path)) == rows(scan_token_lists(spark, str(source))) == [(k, k + 1) for k in range(7)]
    assert append_token_lists(spark, str(source), path) is None


def test_numbered_files_are_not_read_again(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", "[1, 2]")
    append_token_lists(spark, str(source), path)
    # as long as before, so only a read could tell
    put(source, "a.csv", "[8, 9]")
    (source / ".a.csv.crc").unlink(missing_ok=True)
    put(source, "b.csv", "[3]")
    append_token_lists(spark, str(source), path)
    assert rows(read_appended(spark, path)) == [(0, 1), (1, 2), (2, 3)]


def test_a_changed_file_raises(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", "[1, 2]")
    append_token_lists(spark, str(source), path)
    put(source, "a.csv", "[1, 2, 3]")
    with pytest.raises(ValueError, match="changed"):
        append_token_lists(spark, str(source), path)


def test_of_two_jobs_one_gives_way(spark, tmp_path, monkeypatch):
    source, path = tmp_path / "in", str(tmp_path / "out")
    put(source, "a.csv", "[1, 2]")
    append_token_lists(spark, str(source), path)
    put(source, "b.csv", "[3]")
    known = published._manifests
    stale = [known(spark, path)]
    append_token_lists(spark, str(source), path)
    monkeypatch.setattr("seqloom.sources.appended.versions", lambda *_: stale[0])
    with pytest.raises(RuntimeError, match="meanwhile"):
        append_token_lists(spark, str(source), path)
    monkeypatch.undo()
    assert rows(read_appended(spark, path)) == [(0, 1), (1, 2), (2, 3)]


def test_nothing_yet(spark, tmp_path):
    assert read_appended(spark, str(tmp_path / "out")).count() == 0
