"""Where intermediate tables go, and when they are written again."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from grovemart import session
from grovemart.operators import cards
from grovemart.plans import workspace


class Conf(dict):
    def get(self, key, *default):
        return super().get(key, *default)


class FakeSession:
    def __init__(self, **conf):
        self.conf = Conf({key.replace("_", "."): value for key, value in conf.items()})


def test_the_folder_named_by_the_cluster(spark):
    assert session.run_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    fake = FakeSession(spark_checkpoint_dir="s3a://shared/dir/", spark_master="spark://m:7077")
    assert session.shared_dir(fake) == "s3a://shared/dir"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession(spark_master="yarn", spark_app_id="a1"))


def test_a_local_session_has_one_folder():
    fake = FakeSession(spark_master="local[2]", spark_app_id="a2")
    assert session.shared_dir(fake) == session.shared_dir(fake)


def test_runs_never_share_a_path(spark):
    assert session.run_dir(spark, "x") != session.run_dir(spark, "x")


@pytest.fixture
def sources(tmp_path):
    folder = tmp_path / "sf"
    folder.mkdir()
    for name in workspace.SOURCES:
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", folder / f"{name}.parquet")
    return str(folder)


def _total(spark, sources):
    return cards.area_total(workspace.Workspace(spark, sources).fact()).first()[0]


def test_tables_are_shared_until_the_sources_change(spark, sources):
    first = _total(spark, sources)
    made = dict(workspace._made)
    assert _total(spark, sources) == first
    assert workspace._made == made
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    doubled = items.withColumn("l_quantity", F.col("l_quantity") * 2)
    doubled.coalesce(1).write.parquet(f"{sources}/doubled")
    (part,) = Path(f"{sources}/doubled").glob("part-*.parquet")
    shutil.copyfile(part, f"{sources}/lineitem.parquet")
    assert _total(spark, sources) != first


def test_tables_that_are_gone_are_written_again(spark, sources, monkeypatch):
    first = _total(spark, sources)
    lost = {key: f"{path}-gone" for key, path in workspace._made.items() if key[1] == sources}
    monkeypatch.setattr(workspace, "_made", {**workspace._made, **lost})
    assert _total(spark, sources) == first
