"""Versions of an output folder become current at once."""

import os

import pytest
from pyspark.sql import functions as F

from tallyloom.plans.reconcile import Reconciliation
from tallyloom.sinks import outputs as out
from tallyloom.sinks.versions import Versions

NAMES = ["errors_ab", "debt_separation", "conflicts", "errors_sb", "three_way_perfect", "three_way_discrepancies"]


@pytest.fixture
def small(mini):
    return Reconciliation(*mini)


def content(spark, folder):
    outputs = Versions(spark, folder).outputs()
    return {n: sorted(map(tuple, spark.read.option("header", True).csv(p).collect()), key=repr) for n, p in outputs.items()}


@pytest.mark.parametrize("stop", [0, 1, 3, 6, "mark"])
def test_a_failure_between_any_two_lists_leaves_the_old_version(spark, small, tmp_path, monkeypatch, stop):
    folder = str(tmp_path / "out")
    out.write_lists(small, folder, versioned=True)
    before = content(spark, folder)
    assert sorted(before) == sorted(NAMES) and any(before.values())
    written, write = [], out.write_csv

    def failing(df, path, *args):
        if len(written) == stop:
            raise OSError("lost")
        written.append(path)
        write(df.limit(0), path, *args)

    monkeypatch.setattr(out, "write_csv", failing)
    if stop == "mark":
        monkeypatch.setattr(Versions, "path_of", lambda self, path, path_of=Versions.path_of: path_of(self, path if "draft" not in path else "/proc/none/x"))
    if stop == 6:
        out.stage_lists(small, Versions(spark, folder).begin())  # all written, never published
    else:
        with pytest.raises(Exception):
            out.write_lists(small, folder, versioned=True)
    monkeypatch.undo()
    assert content(spark, folder) == before


def test_the_next_version_replaces_the_whole(spark, tmp_path):
    folder = str(tmp_path / "out")
    assert Versions(spark, folder).names() == []
    with pytest.raises(FileNotFoundError):
        Versions(spark, folder).outputs()
    for k in range(4):
        version = Versions(spark, folder).begin()
        for name in ("one", f"only_{k}"):
            spark.range(k + 1).write.parquet(version.path(name))
        if k != 2:
            assert version.publish() == {n: f"{version.stage}/{n}" for n in ("one", f"only_{k}")}
    versions = Versions(spark, folder)
    assert sorted(versions.outputs()) == ["one", "only_3"] and versions.read("one", "parquet").count() == 4
    # The last two published stay; an unpublished one may belong to a run at work.
    assert [int(n.split("-")[0]) for n in versions.names()] == [2, 4]
    assert sorted(versions.outputs(versions.names()[0])) == ["one", "only_1"]
    assert len(os.listdir(f"{folder}/_versions")) == 3
    versions.drop_unpublished()
    assert sorted(os.listdir(f"{folder}/_versions")) == versions.names()


def test_a_version_with_a_missing_output_is_not_published(spark, tmp_path):
    version = Versions(spark, str(tmp_path)).begin()
    version.path("promised")
    with pytest.raises(OSError, match="promised"):
        version.publish()
    assert Versions(spark, str(tmp_path)).names() == []


def test_two_runs_at_once(spark, tmp_path):
    a, b = Versions(spark, str(tmp_path)).begin(), Versions(spark, str(tmp_path)).begin()
    for version, rows in ((a, 1), (b, 2)):
        spark.range(rows).select(F.col("id")).write.parquet(version.path("one"))
    b.publish(), a.publish()
    assert Versions(spark, str(tmp_path)).read("one", "parquet").count() == (1 if a.name > b.name else 2)
