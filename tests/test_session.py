"""The checkpoint folder comes from the session when it is set."""

from tidepool.session import DEFAULT_CONF, ensure_checkpoint_dir


def test_checkpoint_dir_reuses_the_sessions_folder(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current  # set by spark-defaults or by the test fixture
    assert ensure_checkpoint_dir(spark) == current
    assert ensure_checkpoint_dir(spark) == current  # idempotent


def test_defaults_turn_on_adaptive_execution():
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
