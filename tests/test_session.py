"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from layerwell.errors import ConfigError
from layerwell.session import require_utc, scratch_path, scratch_root, table_scratch_path


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_configured_folder_is_used():
    cluster = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_root(cluster) == "hdfs:///shared"
    first, second = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert first != second and first.startswith("hdfs:///shared/layerwell/x-")
    place = table_scratch_path(cluster, "s3a://lake/t", "incoming")
    assert place.startswith("hdfs:///shared/layerwell/s3a___lake_t-")
    assert place == table_scratch_path(cluster, "s3a://lake/t", "incoming")
    assert place != table_scratch_path(cluster, "s3a://lake_t", "incoming")


def test_only_local_sessions_fall_back_to_their_own_folder():
    local = session("local[4]")
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(ConfigError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://host:7077"))


def test_time_zone():
    require_utc(session("local", **{"spark.sql.session.timeZone": "UTC"}))
    with pytest.raises(ConfigError):
        require_utc(session("local", **{"spark.sql.session.timeZone": "Europe/Paris"}))
