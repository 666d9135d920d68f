from __future__ import annotations

import json

import pytest

from quayside.sources import commits, folders, landing
from tools import values


def numbers(spark, first, last, parts=3):
    return spark.range(first, last, 1, parts)


def found(spark, folder):
    return sorted(row.id for row in commits.read(spark, str(folder)).collect())


class Stopped(Exception):
    pass


def stop_at(monkeypatch, number):
    """Stop at the given change to the file system, and at all after it: the driver is gone."""
    made = [0]

    def counted(change):
        def run(*args):
            made[0] += 1
            if made[0] >= number:
                raise Stopped(made[0])
            return change(*args)

        return run

    for name in ("move", "remove", "put"):
        monkeypatch.setattr(folders, name, counted(getattr(folders, name)))
    return made


@pytest.mark.parametrize("plain", [False, True])
def test_a_write_stopped_anywhere_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, plain):
    """Also over files that came without a manifest."""
    old, new = list(range(10)), list(range(100, 130))
    for number in range(1, 40):
        folder = tmp_path / f"stop{number}" / "f"
        if plain:
            numbers(spark, 0, 10).write.parquet(str(folder))
        else:
            landing.write_pull(numbers(spark, 0, 10), str(folder), rebalance=False)
        assert found(spark, folder) == old
        with monkeypatch.context() as patch:
            made = stop_at(patch, number)
            try:
                landing.write_pull(numbers(spark, 100, 130), str(folder), rebalance=False)
                ended = True
            except Stopped:
                ended = False
        assert found(spark, folder) in (old, new)
        again = landing.write_pull(numbers(spark, 100, 130), str(folder), rebalance=False)
        assert found(spark, folder) == new and again.rows == 30
        # At rest the folder holds the commit alone, for readers that take every file.
        assert values(spark.read.parquet(str(folder)), "id") == [(n,) for n in new]
        assert [p.name for p in folder.parent.iterdir()] == ["f"]
        if ended:
            assert made[0] < number
            return
    raise AssertionError("never ended")


def test_what_a_commit_says(spark, tmp_path):
    folder = str(tmp_path / "f")
    one = landing.write_pull(numbers(spark, 0, 7), folder, rebalance=False)
    assert (one.number, one.rows, len(one.names)) == (1, 7, 3) and one.bytes > 0
    assert landing.write_pull(numbers(spark, 0, 0), folder) is None
    assert commits.last(spark, folder) == one
    two = commits.write(spark, folder, lambda at: (commits.counted(numbers(spark, 0, 0), at), spark.range(0).schema))
    assert (two.number, two.rows) == (2, 0) and found(spark, folder) == []
    assert json.loads(two.schema)["fields"][0]["name"] == "id"
    assert commits.last(spark, str(tmp_path / "none")) is None


def test_names_with_odd_characters(spark, tmp_path):
    folder = str(tmp_path / "a b+c[1]" / "{x}")
    for last in (3, 5):
        landing.write_pull(numbers(spark, 0, last), folder)
        assert found(spark, folder) == list(range(last))


def test_attempts_of_another_folder_stay(spark, tmp_path):
    """A folder whose name begins with that of another is not the other."""
    other = tmp_path / ("_attempt-f-x-" + "0" * 32)
    other.mkdir()
    landing.write_pull(numbers(spark, 0, 3), str(tmp_path / "f"))
    assert other.exists()
