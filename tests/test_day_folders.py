"""Day folders as a data source."""

from __future__ import annotations

from datetime import date

import pytest

from tracelode.sources.day_folders import day_folders


@pytest.fixture
def root(tmp_path):
    for day, names in {"20240101": ["a.txt", "b.tif"], "20240102": ["c.txt"], "20240103": [], "notes": ["d.txt"], "20241399": ["e.txt"]}.items():
        (tmp_path / day / "inner").mkdir(parents=True)
        (tmp_path / day / "inner" / "x.txt").write_text("deep")
        for name in names:
            (tmp_path / day / name).write_text("four")
    return tmp_path


@pytest.mark.parametrize("address", ["{}", "file://{}", "{}/"])
def test_files_of_all_days(spark, root, address):
    got = day_folders(spark, address.format(root)).collect()
    assert sorted((r.folder_date, r.name, r.length) for r in got) == [(date(2024, 1, 1), "a.txt", 4), (date(2024, 1, 1), "b.tif", 4), (date(2024, 1, 2), "c.txt", 4)]
    assert {r.path.removeprefix("file://").removeprefix(str(root)) for r in got} == {"/20240101/a.txt", "/20240101/b.tif", "/20240102/c.txt"}
    assert all(r.modified.year > 2000 for r in got)


def test_days_and_patterns(spark, root):
    got = day_folders(spark, str(root), [date(2024, 1, 1), date(2024, 1, 1), date(2023, 5, 5)], "*.txt")
    assert got.rdd.getNumPartitions() == 2
    assert [r.name for r in got.collect()] == ["a.txt"]
    assert day_folders(spark, str(root), []).count() == 0
    assert day_folders(spark, str(root / "nowhere")).count() == 0
