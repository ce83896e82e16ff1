"""File names, matching, text lines, ledgers and stores."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracelode.operators import filenames, ledger, matching, textlines
from tracelode.sources import files, sinks


def named(spark, rows):
    """(file_id, path) -> files with kind and folder_date."""
    df = spark.createDataFrame(rows, "file_id long, path string")
    df = df.withColumn("kind", F.when(F.col("path").contains("RUIP"), "image").otherwise("text"))
    df = df.withColumn("folder_date", F.to_date(F.element_at(F.split("path", "/"), 3), "yyyyMMdd"))
    return filenames.accepted(df)


def random_files(n, seed, prefixes=2, seconds=4000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        at = datetime(2024, 1, 1, 23, 0) + timedelta(seconds=rnd.randrange(seconds))
        side, end = rnd.choice([("RUIP", "tif"), ("RUBI", "txt")])
        out.append((i, f"/{side}/{at:%Y%m%d}/p{rnd.randrange(prefixes)}_{at:%Y%m%d_%H%M%S}.{end}"))
    return out


def plain(rows):
    for i, path in rows:
        name = path.split("/")[-1].split(".")[0]
        prefix, day, time = name.rsplit("_", 2)
        yield ("image" if "RUIP" in path else "text", prefix, datetime.strptime(day + time, "%Y%m%d%H%M%S"), path, i)


@pytest.mark.parametrize(("seed", "sliced"), [(1, False), (2, True), (3, None)])
def test_exclusive_match_equals_the_greedy_loop(spark, seed, sliced):
    rows = random_files(500, seed)
    both = list(plain(rows))
    free = {}
    for kind, prefix, ts, path, i in both:
        if kind == "image":
            free.setdefault(prefix, []).append((ts, path, i))
    want = {}
    for kind, prefix, ts, path, i in sorted(both, key=lambda x: (x[2], x[3], x[4])):
        if kind == "text":
            fit = [x for x in free.get(prefix, []) if timedelta(0) <= ts - x[0] <= timedelta(minutes=5)]
            best = min(fit, key=lambda x: (ts - x[0], x[1], x[2]), default=None)
            if best:
                free[prefix].remove(best)
            want[i] = best and best[2]
    df = named(spark, rows)
    got = matching.match_exclusive(df.where("kind = 'text'"), df.where("kind = 'image'"), sliced=sliced).collect()
    assert {r.text_id: r.image_id for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("forward", [True, False])
def test_nearest_match_equals_nested_loops(spark, forward):
    rows = random_files(600, 7, seconds=9000)
    both = list(plain(rows))
    df = named(spark, rows)
    texts, images = df.where("kind = 'text'"), df.where("kind = 'image'")
    want = {}
    ask, offer = ("image", "text") if forward else ("text", "image")
    for kind, prefix, ts, path, i in both:
        if kind != ask:
            continue
        near = [
            (abs(x[2] - ts), x[3], x[4]) for x in both if x[0] == offer and x[1] == prefix
            and timedelta(0) <= (x[2] - ts if forward else ts - x[2]) <= timedelta(minutes=5)
            and (not forward or x[3].split("/")[2] == path.split("/")[2])
        ]
        if near:
            want[i] = min(near)[2]
    if forward:
        got = {r.image_id: r.text_id for r in matching.match_image_to_text(images, texts).collect()}
    else:
        got = {r.text_id: r.image_id for r in matching.match_text_to_image(texts, images).collect()}
    assert got == want


def test_five_minutes_are_inclusive(spark):
    df = named(spark, [(1, "/RUIP/20240101/p_20240101_024000.tif"), (2, "/RUBI/20240101/p_20240101_024500.txt")])
    (row,) = matching.match_image_to_text(df.where("kind = 'image'"), df.where("kind = 'text'")).collect()
    assert row.diff_seconds == 300


def test_no_pairing_plan(spark):
    df = named(spark, random_files(20, 1))
    for plan in (
        matching.match_image_to_text(df.where("kind = 'image'"), df.where("kind = 'text'")),
        matching.match_exclusive(df.where("kind = 'text'"), df.where("kind = 'image'")),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text
        assert "Cartesian" not in text


def test_names_and_paths(spark):
    rows = [
        ("/RUIP/20240101/a_b_20240102_030405.tif", ("a_b", datetime(2024, 1, 2, 3, 4, 5)), "rbi/ruip/20240101/a_b_20240102_030405.png"),
        ("/x/RuIp/y/p_20241301_030405.tif", (None, None), "rbi/ruip/y/p_20241301_030405.png"),
        ("/x/other/bad", (None, None), None),
        ("ruip/a.b.tif", (None, None), "rbi/ruip/a.b.png"),
    ]
    df = spark.createDataFrame([(p,) for p, *_ in rows], "path string")
    got = filenames.parse_names(df).select("path", "prefix", "file_ts", filenames.output_path(F.col("path")).alias("o")).collect()
    assert {r.path: ((r.prefix, r.file_ts), r.o) for r in got} == {p: (a, b) for p, a, b in rows}
    rel = df.select(filenames.relative_path(F.col("path"), "/RUIP/")).collect()
    assert rel[0][0] == "20240101/a_b_20240102_030405.tif"
    assert rel[1][0] == "x/RuIp/y/p_20241301_030405.tif"


def test_text_lines(spark):
    body = "key1 = value=1\r\n\n a, b ,c\x0braw line　\n=\n"
    df = spark.createDataFrame([("f", body), ("g", None), ("h", "")], "source_file string, text string")
    records = textlines.parse_lines(df)
    got = [(r.line_number, r.record_type, r.key, r.value, r.columns, r.text) for r in records.orderBy("line_number").collect()]
    assert got == [
        (1, "key_value", "key1", "value=1", None, None),
        (3, "csv_like", None, None, ["a", "b", "c"], None),
        (4, "raw", None, None, None, "raw line"),
        (5, "key_value", "", "", None, None),
    ]
    payload = [json.loads(r.payload_json) for r in textlines.with_payload(records).orderBy("line_number").collect()]
    assert payload[1] == {"type": "csv_like", "line_number": 3, "columns": ["a", "b", "c"]}
    assert {r.source_file: r.n_records for r in textlines.file_stats(df, records).collect()} == {"f": 4, "g": 0, "h": 0}


def test_bodies_of_other_encodings(spark):
    rows = [("u", "값=1".encode()), ("k", "값=1".encode("cp949")), ("x", b"\xff\xfe\xff a"), ("n", None)]
    df = spark.createDataFrame([(a, bytearray(b) if b is not None else None) for a, b in rows], "source_file string, content binary")
    got = {r.source_file: r.text for r in files.decode_bodies(df).collect()}
    assert got["u"] == got["k"] == "값=1"
    assert got["x"].endswith(" a")
    assert "�" in got["x"]
    assert got["n"] is None


def test_folders(spark, tmp_path):
    (tmp_path / "20240101" / "deep").mkdir(parents=True)
    (tmp_path / "20240101" / "a.txt").write_text("x")
    (tmp_path / "20240101" / "deep" / "b.txt").write_text("x")
    days = list(files.two_days("2024-01-02"))
    assert days == [date(2024, 1, 1), date(2024, 1, 2)]
    assert [r.path.split("/")[-1] for r in files.list_day_folders(spark, f"file://{tmp_path}", days).collect()] == ["a.txt"]
    assert files.list_day_folders(spark, f"file://{tmp_path}/none", days).count() == 0
    for bad in ("2024-1-2", "20240102", "2024-13-01"):
        with pytest.raises(ValueError, match=r"\d"):
            files.two_days(bad)


def test_ledger_operations(spark):
    now = F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")
    kinds = (
        "source_file string, prefix string, image_ts timestamp_ntz, matched_text_file string, matched_text_ts timestamp_ntz, "
        "matched_diff_seconds long, output_remote_file string, created_at timestamp_ntz, updated_at timestamp_ntz"
    )
    then = datetime(2024, 1, 1)
    book = spark.createDataFrame([("a", "p", then, "t", then, 1, "o", then, None), ("b", "p", then, None, None, None, None, then, None)], kinds)
    new = spark.createDataFrame([("a", "q", then, None, None, None, None), ("c", "p", then, "t", then, 3, "o")], kinds.split(", created_at")[0])
    rows = {r.source_file: r for r in ledger.upsert(book, new, now).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].prefix, rows["a"].matched_text_file, rows["a"].created_at, rows["a"].updated_at) == ("q", None, then, datetime(2024, 2, 1))
    assert (rows["c"].created_at, rows["c"].updated_at, rows["b"].updated_at) == (datetime(2024, 2, 1), None, None)
    twice = ledger.upsert(ledger.upsert(book, new, now), new, now)
    assert twice.count() == 3
    absent = ledger.insert_if_absent(book, new, now)
    assert {r.source_file: r.prefix for r in absent.collect()} == {"a": "p", "b": "p", "c": "p"}
    assert ledger.remove(book, new.select("source_file")).count() == 1
    done = ledger.finalize(book, new, now)
    assert {r.source_file: r.output_remote_file for r in done.collect()} == {"a": "o", "b": None}


def test_stores(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 'a"b\nc'), (2, datetime(2024, 1, 2), ""), (3, datetime(2024, 1, 2), None)], "er_index int, code_occur_time timestamp_ntz, contents string"
    )
    path = str(tmp_path / "t")
    sinks.append_by_day(rows, path)
    sinks.overwrite_days(rows.where("er_index = 2").withColumn("created_at", F.current_timestamp()), path)
    assert sorted(r.er_index for r in spark.read.parquet(path).collect()) == [1, 2]
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back = sinks.read_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert sinks.distinct_rows(rows.union(rows)).count() == 3
    with pytest.raises(ValueError, match="no table"):
        sinks.append_to_table(rows, "not_there")
