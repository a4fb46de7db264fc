from __future__ import annotations

import pytest

from wardline.session import prepare_session, shared_dir
from wardline.sources.messages import DEFAULT_MAX_RECORDS, file_stream, kafka_options, kafka_stream
from wardline.sources import files
from wardline.sources.tables import state_of


def test_topic_options():
    assert kafka_options("host:9092", "traffic") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "traffic",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": str(DEFAULT_MAX_RECORDS),
    }
    assert kafka_options("h", "t", "earliest", 10, 64)["minPartitions"] == "64"
    with pytest.raises(ValueError):
        kafka_options("h", "t", starting="middle")
    with pytest.raises(ValueError):
        kafka_options("h", "t", max_records=0)


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "host:9092", "traffic")


def test_file_stream_bounds(spark, tmp_path):
    assert file_stream(spark, str(tmp_path), max_bytes="1m").isStreaming
    with pytest.raises(ValueError):
        file_stream(spark, str(tmp_path), max_files=1, max_bytes="1m")


def test_small_files_are_created_once(spark, tmp_path):
    place = f"{tmp_path}/a/b"
    assert files.read(spark, place) is None and files.matching(spark, f"{tmp_path}/a/*") == []
    assert files.create(spark, place, "first") and not files.create(spark, place, "second")
    assert files.read(spark, place) == "first" and len(files.matching(spark, f"{tmp_path}/a/*")) == 1
    files.delete(spark, place)
    assert files.read(spark, place) is None


def test_state_notices_a_rewrite(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    before = state_of(spark, str(tmp_path), "t")
    spark.range(50).write.mode("overwrite").parquet(path)
    assert state_of(spark, str(tmp_path), "t") != before


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_foreign_sessions_are_brought_to_utc(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert prepare_session(other).conf.get("spark.sql.session.timeZone") == "UTC"


def test_settings_fixed_at_start_are_left_alone(spark, monkeypatch):
    from wardline import session

    monkeypatch.setitem(session.RECOMMENDED_CONF, "spark.sql.warehouse.dir", "/elsewhere")
    before = spark.conf.get("spark.sql.warehouse.dir")
    assert prepare_session(spark).conf.get("spark.sql.warehouse.dir") == before
