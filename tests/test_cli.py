import pytest

from eventlake.cli import main
from eventlake.functions.parsing import to_json_records
from eventlake.operators import realtime
from eventlake.sources.fixtures import read_bronze
from eventlake.streaming.sinks import read_realtime, read_summary
from tests.conftest import SMALL


def test_jobs_end_to_end(spark, tmp_path, capsys):
    lake, topic = str(tmp_path / "lake"), str(tmp_path / "topic")
    bronze = read_bronze(spark, SMALL)
    to_json_records(bronze).select("value").coalesce(1).write.text(topic)
    source = ["--lake", lake, "--source", "text", "--path", topic, "--once", "--state-partitions", "2"]

    assert main(["silver", "--lake", lake]) == 1
    assert main(["land", *source]) == 0
    assert main(["batch", "--lake", lake]) == 0
    assert main(["silver", "--lake", lake]) == 0
    assert "rows_read" in capsys.readouterr().out
    days = [str(r[0]) for r in spark.read.parquet(f"{lake}/silver/user_events").select("event_date").distinct().limit(1).collect()]
    assert main(["gold", "--lake", lake, "--dates", *days]) == 0
    assert main(["check", "--lake", lake]) == 0
    assert "missing or empty" not in capsys.readouterr().out

    assert main(["fast", *source]) == 0
    assert main(["detect", *source]) == 0
    cube = read_realtime(spark, f"{lake}/realtime/minute_cube", realtime.MINUTE_CUBE_KEYS)
    assert cube.agg({"event_count": "sum"}).first()[0] == bronze.count()
    assert not spark.read.parquet(f"{lake}/realtime/anomalies").isEmpty()

    assert main(["watch", *source]) == 0
    assert not spark.read.parquet(f"{lake}/realtime/watch/timeline").isEmpty()
    assert not read_summary(spark, f"{lake}/realtime/anomaly_summary").isEmpty()
    capsys.readouterr()
    assert main(["health", "--lake", lake]) == 0
    assert main(["compact", "--lake", lake]) == 0
    assert "minute_cube, anomaly_summary, progress" in capsys.readouterr().out
    before = spark.read.parquet(f"{lake}/silver/user_events").count()
    assert main(["update", "--lake", lake, "--dates", *days]) == 0
    assert "1 days written" in capsys.readouterr().out and spark.read.parquet(f"{lake}/silver/user_events").count() == before

    assert main(["query", "--lake", lake, "--name", "latest_dau"]) == 0
    assert "dau_count" in capsys.readouterr().out
    assert main(["query", "--lake", lake, "--name", "events_last_hour", "--as-of", "2024-01-10T00:00:00"]) == 0
    assert main(["query", "--lake", lake, "--name", "no_such_query"]) == 1


def test_kafka_needs_servers(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["land", "--lake", str(tmp_path)])
