from concurrent.futures import ThreadPoolExecutor

import pytest

from lakeloom.sources import versions as V
from lakeloom.sources.readers import MissingInput


def values(df):
    return sorted(r.id for r in df.collect())


def test_an_open_reader_stays_on_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(MissingInput):
        V.read_version(spark, path)
    V.write_version(spark.range(3), path, keep=2)
    reader = V.read_version(spark, path)
    V.write_version(spark.range(5), path, keep=2)
    assert values(reader) == [0, 1, 2] and values(V.read_version(spark, path)) == [0, 1, 2, 3, 4]
    V.write_version(spark.range(1), path, keep=2)
    assert [v.number for v in V.versions(spark, path)] == [2, 3] and V.orphans(spark, path) == []
    assert len(list((tmp_path / "t").glob("version-*"))) == 2


def test_a_crash_before_the_rename_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    V.write_version(spark.range(3), path)
    # Killed after the data, and after the claim of a number.
    spark.range(9).write.parquet(V.new_folder(path))
    assert V._claim(spark, path) == 2
    assert values(V.read_version(spark, path)) == [0, 1, 2] and len(V.orphans(spark, path)) == 1
    assert V.write_version(spark.range(2), path).number == 3
    assert values(V.read_version(spark, path)) == [0, 1]
    with pytest.raises(MissingInput):
        V.publish(spark, path, f"{path}/version-none")


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda n: V.write_version(spark.range(n), path, {"rows": n}, keep=10), range(1, 7)))
    assert sorted(v.number for v in made) == sorted({v.number for v in made}) and len(V.versions(spark, path)) == 6
    last = max(made, key=lambda v: v.number)
    assert V.current(spark, path) == last and V.read_version(spark, path).count() == last.note["rows"]
    with pytest.raises(ValueError):
        V.retire(spark, path, 0)


def test_a_number_lost_while_it_is_claimed_is_left_to_its_writer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert V._claim(spark, path) == 1
    numbers, files_of, early = V._numbers, V._files, [[], []]

    class Late:
        """A file system on which another writer's file appears after the look."""

        def __init__(self, files):
            self.files = files

        def createNewFile(self, file):
            self.files.create(file, False).close()
            return True

    monkeypatch.setattr(V, "_numbers", lambda *at: early.pop() if early else numbers(*at))
    with monkeypatch.context() as m:
        m.setattr(V, "_files", lambda *at: (Late(files_of(*at)[0]), files_of(*at)[1]) if at[1].endswith("1") else files_of(*at))
        assert V._claim(spark, path) == 2
