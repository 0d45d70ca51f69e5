"""The sink that holds each message once."""

import os

import pytest

from farelight.schemas import KPI_SCHEMA
from farelight.streaming import outbox, status
from tests.frames import rows


def kpi_rows(spark, *weeks, borough="Queens"):
    made = [(w, f"{borough} {i}", 10 + i, 5.5, 7, 50.0, 4, 2.5, 10.0) for w in weeks for i in range(3)]
    return spark.createDataFrame(made, KPI_SCHEMA)


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "kpis"), str(tmp_path / "offsets"), str(tmp_path / "outbox")


def send(spark, place, **options):
    table, offsets, box = place
    query = status.stream_status_events(spark, table, offsets, "outbox", path=box, max_files=1, **options)
    query.awaitTermination()


def sent(spark, place):
    return rows(outbox.read_messages(spark, place[2]).select("key", "value"))


def expected(spark, place):
    return rows(status.status_events(spark.read.schema(KPI_SCHEMA).parquet(place[0])))


def put(frame, place):
    frame.coalesce(1).write.mode("append").parquet(place[0])


def parts(place):
    return len(os.listdir(os.path.join(place[2], outbox.PARTS)))


def test_each_event_is_there_once(spark, place):
    for week in ("2025-10-06", "2025-10-13"):
        put(kpi_rows(spark, week), place)
    send(spark, place)
    assert sent(spark, place) == expected(spark, place) and len(sent(spark, place)) == 6
    put(kpi_rows(spark, "2025-10-20"), place)
    send(spark, place)  # a restart sends what is new
    send(spark, place)
    assert sent(spark, place) == expected(spark, place)
    batches = outbox.Folder(place[2]).manifests()
    assert [(b["batch"], b["messages"]) for b in batches] == [(0, 3), (1, 3), (2, 3)]


def test_a_batch_that_fails_between_write_and_commit(spark, place, monkeypatch):
    """The files are written, the commit is not: nothing is to be read, and the next try is whole."""
    put(kpi_rows(spark, "2025-10-06"), place)
    outbox.register(spark)

    class Lost(outbox.Outbox):
        def streamWriter(self, schema, overwrite):
            class Writer(outbox.OutboxStreamWriter):
                def commit(self, messages, batchId):
                    raise RuntimeError("lost before the commit")

                def abort(self, messages, batchId):
                    pass  # the driver is gone, nobody tidies up

            return Writer(self._folder(), self._stream())

    with monkeypatch.context() as patched:
        patched.setattr(outbox, "Outbox", Lost)
        with pytest.raises(Exception, match="lost before the commit"):
            send(spark, place)
    assert parts(place) > 0 and sent(spark, place) == []
    send(spark, place)
    assert sent(spark, place) == expected(spark, place) and len(sent(spark, place)) == 3


def test_a_batch_that_fails_after_its_commit(spark, place, monkeypatch):
    """The manifest is there but the checkpoint is not: the repeated batch adds nothing."""
    put(kpi_rows(spark, "2025-10-06"), place)

    class Late(outbox.Outbox):
        def streamWriter(self, schema, overwrite):
            class Writer(outbox.OutboxStreamWriter):
                def commit(self, messages, batchId):
                    super().commit(messages, batchId)
                    raise RuntimeError("lost after the commit")

                def abort(self, messages, batchId):
                    pass

            return Writer(self._folder(), self._stream())

    with monkeypatch.context() as patched:
        patched.setattr(outbox, "Outbox", Late)
        with pytest.raises(Exception, match="lost after the commit"):
            send(spark, place)
    before = parts(place)
    send(spark, place)
    assert sent(spark, place) == expected(spark, place)
    assert parts(place) == before  # the files of the second try are gone again


def test_streams_do_not_mix_their_numbers(spark, place, tmp_path):
    put(kpi_rows(spark, "2025-10-06"), place)
    send(spark, place)
    other = (str(tmp_path / "more"), str(tmp_path / "more-offsets"), place[2])
    put(kpi_rows(spark, "2025-10-06", borough="Bronx"), other)
    send(spark, other, stream="more")
    assert sorted(sent(spark, place)) == sorted(expected(spark, place) + expected(spark, other))
    assert {r.stream for r in outbox.read_messages(spark, place[2]).collect()} == {"messages", "more"}


def test_batch_write(spark, place):
    frame = kpi_rows(spark, "2025-10-06").repartition(3)
    for _ in range(2):
        status.send_status_events(frame, "outbox", path=place[2], batch="monday")
    assert sent(spark, place) == rows(status.status_events(frame))
    status.send_status_events(frame, "outbox", path=place[2])
    assert len(sent(spark, place)) == 6
    status.send_status_events(frame.filter("false"), "outbox", path=place[2])
    assert len(sent(spark, place)) == 6


def test_an_outbox_by_uri_and_an_empty_one(spark, tmp_path):
    assert outbox.read_messages(spark, str(tmp_path / "nothing")).count() == 0
    uri = (tmp_path / "by uri").as_uri().replace("%20", "-")
    status.send_status_events(kpi_rows(spark, "2025-10-06"), "outbox", path=uri)
    assert outbox.read_messages(spark, uri).count() == 3


def test_what_an_outbox_does_not_take(spark, place):
    outbox.register(spark)
    frame = kpi_rows(spark, "2025-10-06")
    with pytest.raises(Exception, match="key and value"):
        frame.write.format("outbox").mode("append").save(place[2])
    with pytest.raises(Exception, match="only appended"):
        status.status_events(frame).write.format("outbox").mode("overwrite").save(place[2])
    with pytest.raises(Exception, match="needs a path"):
        status.send_status_events(frame, "outbox")
