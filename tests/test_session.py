import pytest

from fleetlens.session import RUNTIME_CONF, work_dir


def test_work_folders_are_fresh_and_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    root = shared or spark.conf.get("spark.sql.warehouse.dir")
    assert first.startswith(root)


@pytest.mark.parametrize("key", sorted(RUNTIME_CONF))
def test_settings_are_applied(spark, key):
    assert spark.conf.get(key) == RUNTIME_CONF[key]
