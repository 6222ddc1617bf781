import os

import pytest

from weirflow.operators.stamps import resolve_process_date, stamp_date
from weirflow.session import scratch_path, shared_dir, staged, staging


def test_configured_shared_folder_is_used(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert shared_dir(spark) == before.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_session_pins_utc_and_leaves_the_overwrite_mode_alone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_shared_folder_is_required():
    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Unset)


def test_staging_is_removed_afterwards(spark, tmp_path):
    with pytest.raises(ValueError), staging(spark, str(tmp_path)) as folder:
        assert staged(spark.range(3), f"{folder}/x").count() == 3
        assert os.path.isdir(folder)
        raise ValueError
    assert not os.path.exists(folder)


def test_there_is_one_clock(spark):
    for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago", "UTC"):  # two of them a day apart
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            stamped = stamp_date(spark.range(1)).first()["processing_date"]
            assert resolve_process_date() == stamped
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
