"""Breaking the lines of a recording anywhere harmless must not change its frames."""

from __future__ import annotations

import random

from samples import HEADER, frame, record

from tracklane.operators.frames import frames_of, parse_records
from tracklane.operators.records import assemble_records
from tracklane.sources.files import read_lines
from tracklane.sources.records import read_records


def _recording(rng: random.Random, tracks: int) -> tuple[str, str]:
    """The same records on one line each, and broken at random around separators and inside times."""
    whole, broken = [HEADER], [HEADER]
    for track in range(1, tracks + 1):
        base = rng.randint(0, 90_000)
        frames = [
            frame(f"{37.9 + (base + i) / 1e6:.6f}", f"{23.7 + (base + i) / 1e6:.6f}", f"{rng.random() * 30:.4f}", f"{i * 0.04:.6f}")
            for i in range(rng.randint(1, 40))
        ]
        text = record(track, *frames)
        whole.append(text)
        start = text.index("; ", text.index("Car")) + 2
        spots = [i for i in range(start, len(text) - 1) if text[i] == ";" or text[i - 1] == ";"]
        for i in sorted(rng.sample(spots, min(len(spots), rng.randint(0, 4))), reverse=True):
            text = text[:i] + "\n" + text[i:]
        broken.extend(text.split("\n"))
    return "\r\n".join(whole) + "\r\n", "\r\n".join(broken)


def _frames(records):
    return sorted(map(tuple, frames_of(parse_records(records)).drop("source_file").collect()))


def test_broken_and_whole_recordings_agree(spark, tmp_path):
    rng = random.Random(7)
    for folder in ("whole", "broken"):
        (tmp_path / folder).mkdir()
    for name in ("a.csv", "b.csv", "c.csv"):
        whole, broken = _recording(rng, 60)
        (tmp_path / "whole" / name).write_bytes(b"\xef\xbb\xbf" + whole.encode())
        (tmp_path / "broken" / name).write_bytes(b"\xef\xbb\xbf" + broken.encode())
    expected = _frames(read_records(spark, str(tmp_path / "whole")))
    assert len({f[0] for f in expected}) == 60
    for size in (3000, 1 << 20):
        assert _frames(read_records(spark, str(tmp_path / "broken"), rangeBytes=size)) == expected
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        lines = read_lines(spark, str(tmp_path / "broken"))
        assert lines.rdd.getNumPartitions() > 3
        assert _frames(assemble_records(lines)) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_readers_agree_on_random_garbage(spark, tmp_path):
    rng = random.Random(11)
    alphabet = ["1; Car", ";", " ", "\n", "\r\n", "\r", "3.5", "x", '"', "42; Bus; 1; 2", "\t"]
    for name in ("g.csv", "h.csv"):
        (tmp_path / name).write_bytes("".join(rng.choice(alphabet) for _ in range(3000)).encode())

    def texts(records):
        return sorted((r.source_file, r.text or "") for r in records.collect())

    expected = texts(read_records(spark, str(tmp_path)))
    assert len(expected) > 100
    assert texts(read_records(spark, str(tmp_path), rangeBytes=333)) == expected
    assert texts(assemble_records(read_lines(spark, str(tmp_path)))) == expected
