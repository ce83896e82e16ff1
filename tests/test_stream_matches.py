"""Matches of two streams give the rows of the batch form, in whatever order files come."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from tracelode.operators import matching
from tracelode.streaming import jobs, matches

FILES = "prefix string, folder_date date, file_id long, path string, file_ts timestamp_ntz"
START, END = datetime(2026, 5, 1), datetime(2026, 6, 1)


def files(kind: str, n: int, seed: int) -> list:
    """Files of a busy prefix, a quiet one and none; ties, repeats, edges of slices, ids beyond 2**53."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        prefix = draw.choice(["busy", "busy", "busy", "quiet", None])
        at = START + timedelta(seconds=draw.choice([0, 3300, 3599, 3600, 3900, draw.randrange(9000), 60 * draw.randrange(150)]))
        file_id = 2**60 + i if draw.random() > 0.1 else None
        path = f"/{kind}/{draw.randrange(n // 2)}" if draw.random() > 0.1 else None
        rows.append((prefix, date(2026, 5, draw.choice([1, 1, 1, 2])), file_id, path, at))
    return rows + rows[:5] + [("busy", date(2026, 5, 1), 7, "/no/time", None), ("alone", None, 8, f"/{kind}/alone", START)]


def streamed(spark, tmp_path, match, sides, order, **options):
    """`match` over two streams, whose files come in pieces of one micro-batch each and are then closed."""
    streams, schema = [], spark.createDataFrame([], FILES).schema
    for i, rows in enumerate(sides):
        rows, source = list(rows), str(tmp_path / f"in{i}")
        random.Random(i).shuffle(rows)
        if order == "rising":
            rows.sort(key=lambda r: r[4] or START)
        for piece in (rows[:40], rows[40:90], rows[90:]):
            spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(source)
        matches.closing_files(spark, schema, END).write.mode("append").parquet(source)
        streams.append(jobs.read_logs(spark, source, schema))
    jobs.run_once(match(*streams, **options), str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("order", ["mixed", "rising"])
def test_streams_of_images_and_texts(spark, tmp_path, order):
    images, texts = files("i", 150, 1), files("t", 150, 2)
    delay = "1 day" if order == "mixed" else "10 minutes"
    frames = spark.createDataFrame(images, FILES), spark.createDataFrame(texts, FILES)
    got = streamed(spark, tmp_path / "a", matches.match_image_to_text, (images, texts), order, delay=delay, every=True)
    want = matching.match_image_to_text(*frames, every=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    got = streamed(spark, tmp_path / "b", matches.match_text_to_image, (texts, images), order, delay=delay, seconds=300)
    want = matching.match_text_to_image(*reversed(frames))
    assert 0 < want.count() < len(texts)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_slices_come_out_once_passed(spark, tmp_path):
    """Without closing files, all that the slower stream's watermark has passed is out, and nothing later."""
    rows = [("p", date(2026, 5, 1), i, f"/{i}", START + timedelta(minutes=i)) for i in range(240)]
    schema = spark.createDataFrame([], FILES).schema
    for i, upto in enumerate((240, 200)):
        for piece in (rows[:100], rows[100:upto]):
            spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    texts, images = (jobs.read_logs(spark, str(tmp_path / f"in{i}"), schema) for i in (0, 1))
    jobs.run_once(matches.match_text_to_image(texts, images, delay="10 minutes"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(r.text_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == list(range(180))


def test_late_files_are_told(spark, tmp_path):
    schema = spark.createDataFrame([], FILES).schema
    sources = [str(tmp_path / f"in{i}") for i in (0, 1)]

    def run(at):
        for source in sources:
            spark.createDataFrame([("p", date(2026, 5, 1), 1, "/1", at)], schema).coalesce(1).write.mode("append").parquet(source)
        matched = matches.match_text_to_image(*[jobs.read_logs(spark, source, schema) for source in sources], delay="10 minutes")
        jobs.run_once(matched, str(tmp_path / "out"), str(tmp_path / "state"))

    run(END)
    with pytest.raises(jobs.LateRows):
        run(START)


def test_empty_streams(spark, tmp_path):
    got = streamed(spark, tmp_path, matches.match_image_to_text, ([], []), "mixed", every=True)
    assert got.count() == 0
