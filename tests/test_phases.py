"""Committed tables: killed runs, restarts, stale and foreign tables."""

from dataclasses import replace

import pytest

from stayline.config import Settings
from stayline.sources.phases import Phases, StaleTable

CFG = Settings()


class Killed(Exception):
    pass


def rows(spark, n):
    return spark.range(n)


@pytest.fixture
def phases(spark, tmp_path):
    out = Phases(spark, str(tmp_path), CFG)
    with out.phase("one"):
        out.keep(rows(spark, 3), "a")
        out.keep(rows(spark, 4), "b")
    with out.phase("two"):
        out.keep(out.load("a").union(out.load("b")), "c")
    return out


def test_tables_and_inputs_of_a_finished_phase(phases):
    found = phases.manifests()
    assert phases.load("c").count() == 7 and set(found) == {"one", "two"}
    assert set(found["one"]["tables"]) == {"a", "b"} and set(found["two"]["inputs"]) == {"a", "b"}
    assert found["two"]["inputs"]["a"] == found["one"]["tables"]["a"]


def test_run_killed_between_write_and_manifest(spark, phases, tmp_path):
    with pytest.raises(Killed), phases.phase("one"):
        phases.keep(rows(spark, 30), "a")
        phases.keep(rows(spark, 40), "b")
        raise Killed
    again = Phases(spark, str(tmp_path), CFG)  # a new process
    assert [again.load(name).count() for name in "abc"] == [3, 4, 7]
    assert len(again.unused()) == 2
    with again.phase("one"):
        again.keep(rows(spark, 30), "a")
        again.keep(rows(spark, 40), "b")
    with pytest.raises(StaleTable, match="replaced"):
        again.load("c")
    with again.phase("two"):
        again.keep(again.load("a").union(again.load("b")), "c")
    assert again.load("c").count() == 70


def test_commit_that_dies_leaves_no_manifest(spark, phases, monkeypatch):
    monkeypatch.setattr(phases, "_commit", lambda manifest: (_ for _ in ()).throw(Killed))
    with pytest.raises(Killed), phases.phase("two"):
        phases.keep(rows(spark, 1), "c")
    assert phases.load("c").count() == 7


def test_unfinished_unknown_and_foreign_tables(spark, phases, tmp_path):
    with pytest.raises(StaleTable, match="no finished phase"):
        phases.load("d")
    with pytest.raises(StaleTable, match="no phase is open"):
        phases.keep(rows(spark, 1), "d")
    other = Phases(spark, str(tmp_path), replace(CFG, seed=1))
    with pytest.raises(StaleTable, match="other settings"):
        other.load("c")


def test_inside_a_phase_its_own_tables_are_read(spark, phases):
    with phases.phase("three"):
        phases.keep(rows(spark, 9), "a")
        assert phases.load("a").count() == 9
        phases.keep(phases.load("a"), "d")
    assert phases.load("d").count() == 9 and phases.manifests()["three"]["inputs"] == {}
