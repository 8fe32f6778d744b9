"""Settings and the session profile."""

from intervalcast.session import build_session
from intervalcast.settings import Settings, SparkSettings, load_settings


def test_defaults():
    settings = load_settings({})
    assert settings.bus.weather_topic == "weather-stream"
    assert settings.model.sample_fraction == 1.0 and settings.model.seed == 2025
    assert settings.paths.weather == "data/weather.csv"
    assert settings.stream.watermark == "10 minutes"
    assert settings.as_dict()["model"]["cv_folds"] == 3


def test_environment_wins():
    settings = load_settings(
        {"MODEL_SAMPLE_FRACTION": "0.05", "KAFKA_WEATHER_TOPIC": "other", "MODEL_CV_FOLDS": "5", "DATA_ROOT": "/d"}
    )
    assert settings.model.sample_fraction == 0.05 and settings.model.cv_folds == 5
    assert settings.bus.weather_topic == "other" and settings.paths.meters == "/d/meters.csv"


def test_session_profile_keeps_what_was_launched(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        session = build_session(Settings(spark=SparkSettings(shuffle_partitions=77)))
        # Given at launch, so the profile leaves it alone.
        assert session.conf.get("spark.sql.shuffle.partitions") == before
        assert session.conf.get("spark.sql.adaptive.enabled") == "true"
        assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
