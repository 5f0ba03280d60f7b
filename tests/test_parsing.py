from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from samples import FIRST, HEADER, SECOND, frame, record, two_frames

from tracklane.functions import repair
from tracklane.functions.lines import CUT, is_record_start, join_physical_lines, unquoted_fields
from tracklane.operators import records as record_operators
from tracklane.operators.frames import frames_of, parse_counts, parse_records, rejects_of, with_provenance
from tracklane.operators.records import assemble_records, limit_records, number_records
from tracklane.sources import records as record_source
from tracklane.sources.files import read_lines
from tracklane.sources.records import read_records

# name → (physical lines after the header, expected (track, lat, lon, time) per frame)
GOOD = [(0.0, 37.951204, 23.702816), (0.04, 37.951204, 23.702816)]


def _expected(*tracks):
    return [(k, lat, lon, t) for k in tracks for t, lat, lon in GOOD]


FILES = {
    "two": ([two_frames(1), two_frames(2)], _expected(1, 2)),
    "time_cut": ([f"1; Car; 61.25; 7.35; {FIRST}; {SECOND[:-5]}", f"{SECOND[-5:]};"], _expected(1)),
    "lon_cut": (["1; Car; 61.25; 7.35; 37.951204; 23.7028", f"16; 4.9; 0.0; 0.0; 0.000000; {SECOND};"], _expected(1)),
    "before_separator": (["1; Car; 61.25; 7.35; 37.951204; 23.82334", f"; 6.2051; 0; 0; 0.0; {SECOND};"],
                         [(1, 37.951204, 23.82334, 0.0), (1, 37.951204, 23.702816, 0.04)]),
    "after_separator": (["1; Car; 61.25; 7.35;", f" {FIRST}; {SECOND};"], _expected(1)),
    "lost_separator": (["1; Car; 61.25; 7.35; 37.951204", f" 23.702816; 4.9; 0; 0; 0.0; {SECOND};"], _expected(1)),
    "extra_field": ([two_frames(1) + " 7;", two_frames(2)], _expected(2)),
    "empty_field": ([record(1, frame(lon="")), two_frames(2)], _expected(2)),
    "lat_lost_digit": ([record(1, frame(lat="37.962318", time="391.16"), frame(lat=" 3", time="x"))[:-len("; 23.74; 5.0; 0.0; 0.0; x;")],
                        ".962316; 23.74; 5.0; 0.0; 0.0; 391.20;"],
                       [(1, 37.962318, 23.74, 391.16), (1, 37.962316, 23.74, 391.2)]),
    "lon_lost_digit": (["1; Car; 1; 2; 37.98; 23.718238; 1; 0; 0; 0.0; 37.98; 2", ".718240; 1; 0; 0; 0.04;"],
                       [(1, 37.98, 23.718238, 0.0), (1, 37.98, 23.71824, 0.04)]),
    "time_lost_point": (["1; Car; 1; 2; 37.98; 23.74; 1; 0; 0; 823.76; 37.98; 23.74; 1; 0; 0; 823", "800000; 37.98; 23.74; 1; 0; 0; 823.84;"],
                        [(1, 37.98, 23.74, 823.76), (1, 37.98, 23.74, 823.8), (1, 37.98, 23.74, 823.84)]),
    "time_lost_digit": (["1; Car; 1; 2; 37.98; 23.74; 1; 0; 0; 46.76; 37.98; 23.74; 1; 0; 0; 6", ".800000; 37.98; 23.74; 1; 0; 0; 46.84;"],
                        [(1, 37.98, 23.74, 46.76), (1, 37.98, 23.74, 46.8), (1, 37.98, 23.74, 46.84)]),
    "hopeless_lat": (["1; Car; 1; 2; 9", ".123456; 23.74; 1; 0; 0; 0.0;", two_frames(2)], _expected(2)),
    "hopeless_time": (["1; Car; 1; 2; 37.98; 23.74; 1; 0; 0; 0.0; 37.98; 23.74; 1; 0; 0; 9", ".999999; 37.98; 23.74; 1; 0; 0; 0.08;", two_frames(2)],
                      _expected(2)),
    "stray_lines": (["00; 1.0; 2.0", "nothing", two_frames(3)], _expected(3)),
}


def _lines(spark, part_lines: int):
    rows = []
    for name, (body, _) in FILES.items():
        for pos, line in enumerate([HEADER, *body]):
            rows.append((f"{name}.csv", pos // part_lines, pos, line))
    return spark.createDataFrame(rows, "source_file string, block bigint, pos bigint, line string")


@pytest.mark.parametrize("part_lines", [1, 2, 100])
def test_files_give_the_expected_frames(spark, part_lines):
    parsed = parse_records(assemble_records(_lines(spark, part_lines)))
    got = {}
    for r in frames_of(parsed).collect():
        got.setdefault(r.source_file.removesuffix(".csv"), []).append((r.track_id, r.lat, r.lon, r.timestamp_s))
    for name, (_, expected) in FILES.items():
        assert sorted(got.get(name, []), key=lambda f: (f[0], f[3])) == expected, name


def test_rejects_name_the_reason(spark):
    rejects = rejects_of(parse_records(assemble_records(_lines(spark, 100))))
    found = {(r.source_file.removesuffix(".csv"), r.reason_code) for r in rejects.collect()}
    assert found == {
        ("extra_field", "bad_frame_width"),
        ("empty_field", "empty_field"),
        ("hopeless_lat", "unrepairable_field"),
        ("hopeless_time", "unrepairable_field"),
        ("stray_lines", "preamble"),
    }


VERDICTS = {
    "5; Car; 1; 2; 37.98": "too_few_fields",
    f"x5; Car; 1; 2; {FIRST};": "bad_track_id",
    f"5{CUT}1; Car; 1; 2; {FIRST};": "damaged_track_id",
    f"99999999999; Car; 1; 2; {FIRST};": "bad_track_id",
    f"5; Car; 1; z; {FIRST};": "bad_header_number",
    f"5; Car; 1; 2; {FIRST}; ; ;": "bad_frame_width",
    f"5; Car; 1; 2; {FIRST};;": "bad_frame_width",
    record(5, frame(speed="1.0d")): "bad_number",
    record(5, frame(speed="1_0")): "bad_number",
    record(5, frame(speed="1 0")): "bad_number",
    record(5, frame(time="0.04"), frame(time="0.04")): "non_positive_step",
    record(5, frame(time="0.0"), frame(time="0.04"), frame(time="0.09")): "uneven_step",
    record(5, frame(lat="36.0")): "outside_area",
    record(5, frame(lat="nan")): "outside_area",
    record(5, frame(speed="-0.1")): "bad_speed",
    record(5, frame(speed="nan")): "bad_speed",
    record(5, frame(speed="inf")): "bad_speed",
    record(5, frame(time="nan"), frame(time="0.04")): None,
    record(5, frame(speed=".5"), frame(speed="+5.", time="4e-2")): None,
    record(5, frame(speed="007.5")): None,
    record(5, frame(lat="37.9", lon="23.9")): None,
    record(5, "37.98; 23.7; 1; nan; inf; 0"): None,
    f"5; Medium Vehicle ;\t1; 2; {FIRST}": None,
    f"5; Bus　;1;2;{FIRST};  ": None,
    f"5; C{CUT}ar; 1; 2; {FIRST};": None,
    f'5;"Heavy;""Vehicle""" ;1;2; {FIRST};': None,
    f'5;"Taxi";1;2; 37.95{CUT}1204; 23.702816; 4.9; 0; 0; 0;': None,
}


def test_verdicts(spark):
    rows = [("a.csv", 0, i + 1, text) for i, text in enumerate(VERDICTS)] + [("a.csv", 0, 99, None)]
    parsed = parse_records(spark.createDataFrame(rows, "source_file string, block bigint, seq bigint, text string"))
    got = {r.seq: r for r in parsed.collect()}
    assert {i: got[i + 1].reason_code for i in range(len(VERDICTS))} == dict(enumerate(VERDICTS.values()))
    assert got[99].reason_code == "no_text"
    types = [r.vehicle_type for r in got.values() if r.reason_code is None]
    assert types == ["Car"] * 5 + ["Medium Vehicle", "Bus", "Car", 'Heavy;"Vehicle"', "Taxi"]
    counts = parse_counts(parsed).first()
    assert (counts.record_count, counts.track_count, counts.rejected_count) == (len(types), 1, len(VERDICTS) + 1 - len(types))


def test_speed_unit(spark):
    rows = [("a.csv", 0, 1, record(1, frame(speed="36.0")))]
    records = spark.createDataFrame(rows, "source_file string, block bigint, seq bigint, text string")
    got = frames_of(parse_records(records, "kmh")).first()
    assert (got.speed_ms, got.avg_speed_ms, got.lon_acc_ms2) == (pytest.approx(10.0), pytest.approx(7.35 / 3.6), 0.0)
    with pytest.raises(ValueError):
        parse_records(records, "mph")


def test_provenance(spark):
    import datetime

    rows = [("a.csv", 0, 1, two_frames(1))]
    records = spark.createDataFrame(rows, "source_file string, block bigint, seq bigint, text string")
    stamp = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    got = with_provenance(frames_of(parse_records(records)), "bronze/x.zip", stamp).collect()
    assert {r.bronze_key for r in got} == {"bronze/x.zip"} and len({r.ingested_at for r in got}) == 1


def test_record_starts(spark):
    lines = {
        "1; Car; 61.25": True, "123; Motorcycle; 1": True, "  7 ;Bus": True, HEADER: False, "00; 37.9": False,
        "; 32.8": False, " 37.9; 23.7": False, ".718240; 1": False,
    }
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = {r.line: r.s for r in df.select("line", is_record_start(F.col("line")).alias("s")).collect()}
    assert got == lines


def test_line_joins(spark):
    joins = {
        "1; Car; 7.35;\n 37.951204;": "1; Car; 7.35; 37.951204;",
        "23.82334\n; 6.2051;": "23.82334; 6.2051;",
        "31.410000\n 37.951377;": "31.410000; 37.951377;",
        "22.600\n00; 1": f"22.600{CUT}00; 1",
        "3\n.962316; 1": f"3{CUT}.962316; 1",
        "-\n.5032; 1": f"-{CUT}.5032; 1",
        "1\n  2": f"1{CUT}  2",
        "1\n \n2": f"1{CUT} {CUT}2",
        "a;\n;\nb": "a;;b",
        "a\n;\nb": "a;b",
    }
    df = spark.createDataFrame([(t,) for t in joins], "t string")
    got = {r.t: r.j for r in df.select("t", join_physical_lines(F.col("t")).alias("j")).collect()}
    assert got == joins


def test_quoted_fields_follow_the_csv_rules(spark):
    import csv

    texts = ['1;"a;b";2', '1;"a""b"c;2', ' "x";3', '"open;1', 'a"b;c', '"";1;""', '1;"a"b"c;2', ";;", '"a";']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.f for r in df.select("t", unquoted_fields(F.col("t")).alias("f")).collect()}
    assert got == {t: next(csv.reader([t], delimiter=";")) for t in texts}


def test_candidates(spark):
    tokens = [f"22.600{CUT}00", f"823{CUT}800000", f"3{CUT}.962316", f"23{CUT}736653", f"-{CUT}.5{CUT}0"]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = {r.t: r.c for r in df.select("t", repair.boundary_candidates(F.col("t")).alias("c")).collect()}
    assert got[tokens[0]][0] == "22.60000" and "823.800000" in got[tokens[1]]
    assert {"73.962316", "37.962316"} <= set(got[tokens[2]])
    assert [len(got[t]) for t in tokens[2:4]] == [20, 22]
    assert got[tokens[4]][0] == "-.50" and "-3.50" in got[tokens[4]]


def test_repairs(spark):
    def one(column):
        return spark.range(1).select(column.alias("v")).first().v

    lit = F.lit
    assert one(repair.repair_latitude(lit(f"3{CUT}.962316"), lit(37.962318))) == 37.962316
    assert one(repair.repair_latitude(lit(f"9{CUT}.123456"), lit(37.98))) is None
    assert one(repair.repair_latitude(lit(f"3{CUT}.962316"), lit(None).cast("double"))) == 37.962316
    assert one(repair.repair_longitude(lit(f"2{CUT}.718240"), lit(23.718238))) == 23.71824
    assert one(repair.repair_longitude(lit(f"23{CUT}736653"), lit(23.736651))) == 23.736653
    assert one(repair.repair_time(lit(f"823{CUT}800000"), lit(823.8))) == 823.8
    assert one(repair.repair_time(lit(f"6{CUT}.800000"), lit(46.8))) == 46.8
    assert one(repair.repair_time(lit(f"0.04{CUT}0000"), lit(0.04))) == 0.04
    assert one(repair.repair_time(lit(f"9{CUT}.999999"), lit(0.04))) is None
    assert one(repair.repair_time(lit(f"7{CUT}5"), lit(None).cast("double"))) == 75.0
    assert one(repair.repair_speed(lit(f"20{CUT}5.5"))) is None
    assert one(repair.repair_speed(lit(f"2{CUT}5"))) == 25.0
    assert one(repair.repair_acceleration(lit(f"-{CUT}.5032"))) == -0.5032


def test_clean_cut_is_read_as_the_nearest_candidate():
    near = [frame(lat=f"37.9{CUT}4444", time="0.00"), frame(lat="37.944440", time="0.04")]
    far = [frame(lat=f"37.9{CUT}4444", time="0.00"), frame(lat="37.944445", time="0.04")]
    first = [repair.repair_record(record(1, *frames)).split(";")[4].strip() for frames in (near, far)]
    assert first == ["37.94444", "37.944444"]


def test_chained_repairs_see_each_other():
    frames = [frame(lat=f"37.97000{i}", time=f"{i * 0.04:.2f}") for i in range(5)]
    frames[1] = frame(lat=f"3{CUT}.970001", time=f"0{CUT}04")
    frames[2] = frame(lat=f"37{CUT}970002", time=f"0.{CUT}08")
    fixed = repair.repair_record(record(7, *frames))
    assert CUT not in fixed
    fields = [f.strip() for f in fixed.split(";")][4:-1]
    assert [float(v) for v in fields[0::6]] == [37.97, 37.970001, 37.970002, 37.970003, 37.970004]
    assert [float(v) for v in fields[5::6]] == [0.0, 0.04, 0.08, 0.12, 0.16]


def test_record_numbers_and_limits(spark):
    lines = [("a.csv", p // 3, p, t) for p, t in enumerate([HEADER, "stray", two_frames(1), two_frames(2), two_frames(3)])]
    records = assemble_records(spark.createDataFrame(lines, "source_file string, block bigint, pos bigint, line string"))
    numbers = {r.text[:1] if r.text else "-": r.record_no for r in number_records(records).collect()}
    assert numbers == {"-": 1, "1": 2, "2": 3, "3": 4}
    assert limit_records(records, 3).count() == 3 and limit_records(records, 0).count() == 4


def test_a_record_over_many_parts_comes_whole_and_one_beyond_a_string_is_an_error(spark, monkeypatch):
    lines = [("a.csv", p, p, t) for p, t in enumerate([HEADER, two_frames(1), "1" * 50, "2" * 50, two_frames(2)])]
    df = spark.createDataFrame(lines, "source_file string, block bigint, pos bigint, line string")
    whole = assemble_records(df).filter("block = 1").first().text
    assert whole == "\n".join([two_frames(1), "1" * 50, "2" * 50])
    monkeypatch.setattr(record_operators, "LARGEST_TEXT", 60)
    with pytest.raises(Exception, match="a.csv: the record that begins in part 1 is longer than 60"):
        assemble_records(df).collect()


def test_the_reader_cuts_no_record_and_names_the_one_it_cannot_hold(tmp_path, monkeypatch):
    frames = ";".join(FIRST for _ in range(500))
    path = tmp_path / "a.csv"
    path.write_text(f"{HEADER}\n1; Car; 2; 3; {FIRST};\n2; Car; 2; 3;\n{frames};\n", encoding="utf-8")
    reader = record_source.RecordReader({"path": str(path), "rangeBytes": "64"})
    texts = [text for part in reader.partitions() for _, text in reader._records(part)]
    assert texts == [f"1; Car; 2; 3; {FIRST};", f"2; Car; 2; 3;\n{frames};"]
    begin = path.read_bytes().index(b"2; Car")
    monkeypatch.setattr(record_source, "LARGEST_TEXT", len(texts[1]) - 1)
    with pytest.raises(ValueError, match=f"a.csv: the record that begins at byte {begin} is longer"):
        [record for part in reader.partitions() for record in reader._records(part)]


def test_preamble_that_fills_whole_parts(spark):
    lines = [("a.csv", p // 2, p, t) for p, t in enumerate([HEADER, *["stray"] * 9, two_frames(1)])]
    lines += [("b.csv", p // 2, p, t) for p, t in enumerate([HEADER, *["stray"] * 5])]
    df = spark.createDataFrame(lines, "source_file string, block bigint, pos bigint, line string")
    got = parse_records(assemble_records(df)).select("source_file", "reason_code").collect()
    assert sorted(map(str, map(tuple, got))) == [
        "('a.csv', 'preamble')", "('a.csv', None)", "('b.csv', 'preamble')"
    ]


def test_reject_numbers_do_not_depend_on_the_cut(spark, tmp_path):
    rows = [two_frames(n) if n % 7 else f"{n}; Car; 1" for n in range(1, 200)]
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("\n".join([HEADER, "stray", *rows]))
    want = {(name, n + 1) for name in ("a.csv", "b.csv") for n in range(7, 200, 7)} | {("a.csv", 1), ("b.csv", 1)}
    for size in (1 << 20, 5000, 300):
        found = rejects_of(parse_records(read_records(spark, str(tmp_path), rangeBytes=size))).collect()
        assert {(r.source_file, r.record_no) for r in found} == want and len(found) == len(want)
    lines = assemble_records(read_lines(spark, str(tmp_path)))
    assert {(r.source_file, r.record_no) for r in rejects_of(parse_records(lines)).collect()} == want


def test_tokens_are_repaired_as_in_records(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0123456789.-") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    cut = [t[:at] + CUT + t[at:] for t in texts for at in [rng.randrange(len(t) + 1)]] + ["37.9", CUT, f"1{CUT}2{CUT}3", f"-{CUT}"]
    near = [rng.choice([None, 37.95, 23.7, 100.0]) for _ in cut]
    df = spark.createDataFrame(list(zip(range(len(cut)), cut, near)), "k int, t string, c double")
    t, c = F.col("t"), F.col("c")
    found = df.select("k", repair.boundary_candidates(t), repair.repair_latitude(t, c), repair.repair_longitude(t, c), repair.repair_speed(t), repair.repair_acceleration(t), repair.repair_time(t, c))
    assert "Python" not in df.select(repair.boundary_candidates(t))._jdf.queryExecution().executedPlan().toString()
    for k, listed, *values in found.collect():
        assert listed == repair.candidates(cut[k])
        want = [repair.rebuild(cut[k], field, near[k] if field in (0, 1, 5) else None) for field in (0, 1, 2, 3, 5)]
        assert values == want, (cut[k], near[k])
