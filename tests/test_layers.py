"""Stored layers: never stale, rebuilt on demand, kept when a build fails."""

import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.plans.catalog import QUERIES, Layers
from cohortlens.plans.layers import REBUILD_CONF, LayerStore

from .conftest import SMALL


@pytest.fixture
def tables(tmp_path):
    folder = tmp_path / "tables"
    shutil.copytree(SMALL, folder)
    for f in folder.iterdir():
        f.chmod(0o644)
    folder.chmod(0o755)
    return str(folder)


def test_changed_input_gives_the_new_result(spark, tables):
    before = {r.record_type_name__c: r.lines for r in QUERIES["d24_base_profile"](spark, tables).collect()}
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    more = orders.unionByName(orders.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)).toArrow()
    import pyarrow.parquet as pq

    pq.write_table(more, f"{tables}/orders.parquet")
    after = {r.record_type_name__c: r.lines for r in QUERIES["d24_base_profile"](spark, tables).collect()}
    assert sum(after.values()) > 1.3 * sum(before.values())


def test_rebuild_and_reuse(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    root = tempfile.mkdtemp(prefix="cohortlens-layer-test-")
    spark.range(1).write.parquet(f"{root}/t.parquet")
    assert LayerStore(spark, root, ("t",)).get("x", build).count() == 1
    assert LayerStore(spark, root, ("t",)).get("x", build).count() == 1 and len(built) == 1
    assert LayerStore(spark, root, ("t",), rebuild=True).get("x", build).count() == 2
    assert LayerStore(spark, root, ("t",)).get("x", build).count() == 2 and len(built) == 2
    spark.conf.set(REBUILD_CONF, "true")
    try:
        assert LayerStore(spark, root, ("t",)).get("x", build).count() == 3
        assert Layers(spark, SMALL).store.rebuild
    finally:
        spark.conf.unset(REBUILD_CONF)

    def broken():
        return spark.range(1).select(F.raise_error(F.lit("no")).alias("id"))

    with pytest.raises(Exception, match="no"):
        LayerStore(spark, root, ("t",), rebuild=True).get("x", broken)
    assert LayerStore(spark, root, ("t",)).get("x", build).count() == 3 and len(built) == 3


def test_a_cluster_must_name_the_shared_folder():
    from cohortlens.session import checkpoint_dir

    class Context:
        master, applicationId = "yarn", "app-1"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_a_rebuilt_layer_rebuilds_what_is_made_of_it_only(spark, tables):
    names = ["obligations", "fee_ledger", "deal_fact", "activity", "dim_scaffold", "account_month"]

    def versions(**more):
        layers = Layers(spark, tables, **more)
        out = {}
        for n in names:
            layers.get(n, **({"n": 12} if n == "account_month" else {}))
            out[n] = layers.store.version("account_month_n12" if n == "account_month" else n)
        return out

    first = versions()
    assert versions() == first
    second = versions(rebuild={"fee_ledger"})
    assert {n for n in names if first[n] != second[n]} == {"fee_ledger", "deal_fact", "activity", "dim_scaffold", "account_month"}
    third = versions(rebuild={"dim_scaffold"})
    assert {n for n in names if second[n] != third[n]} == {"dim_scaffold"}
    assert versions() == third


def test_replaced_versions_are_removed(spark):
    from cohortlens.sources import hadoop

    root = tempfile.mkdtemp(prefix="cohortlens-layer-test-")
    spark.range(1).write.parquet(f"{root}/t.parquet")
    used = []
    for _ in range(5):
        store = LayerStore(spark, root, ("t",), rebuild=True)
        store.get("x", lambda: spark.range(20_000))
        used.append(hadoop.size(spark, f"{store.root}/x"))
    kept = hadoop.children(spark, f"{store.root}/x")
    assert len(kept) == 2 and store.version("x") in kept
    assert used[4] < 1.2 * used[1]
    assert LayerStore(spark, root, ("t",)).get("x", lambda: None).count() == 20_000


def test_changed_code_changes_the_key(monkeypatch, spark, tmp_path):
    from cohortlens.plans import layers

    before = layers.code_state()
    package = tmp_path / "cohortlens"
    shutil.copytree(layers.resources.files("cohortlens"), package, ignore=shutil.ignore_patterns("__pycache__", "llm"))
    monkeypatch.setattr(layers.resources, "files", lambda _: package)
    layers.code_state.cache_clear()
    assert layers.code_state() == before
    (package / "operators" / "cube.py").write_text("changed")
    layers.code_state.cache_clear()
    assert layers.code_state() != before
    layers.code_state.cache_clear()


def test_the_ledger_is_not_written_for_the_deals_alone(spark, tables):
    """The deals take seven of its 72 columns; where it is stored, it is read."""
    from cohortlens.sources import hadoop

    layers = Layers(spark, tables)
    deals = layers.base.count()
    built = layers.store.version("deal_fact")
    assert "fee_ledger" not in hadoop.children(spark, layers.store.root)
    again = Layers(spark, tables)
    again.get("fee_ledger")
    assert again.base.count() == deals and again.store.version("deal_fact") == built
    anew = Layers(spark, tables, rebuild={"fee_ledger"})
    assert anew.ledger.inputFiles() and all("/fee_ledger/" in f for f in anew.ledger.inputFiles())
    assert "/fee_ledger/" not in str(layers._fee_ledger().inputFiles())


def test_a_stored_table_lets_go_of_its_shuffles(spark, tmp_path):
    """The setting holds while a table is written, and is as it was after that."""
    from cohortlens.sources import scratch

    seen = []

    class Frame:
        sparkSession = spark
        write = property(lambda self: self)

        def option(self, *_):
            return self

        def parquet(self, path):
            seen.append(spark.conf.get(scratch.CLEANUP_CONF))
            if path == "broken":
                raise OSError

    before = spark.conf.get(scratch.CLEANUP_CONF, None)
    scratch.write(Frame(), "x")
    with pytest.raises(OSError):
        scratch.write(Frame(), "broken")
    assert seen == ["true", "true"] and spark.conf.get(scratch.CLEANUP_CONF, None) == before
    scratch.write(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7
