"""Gzip files read from restart points, against the whole file inflated at once."""

import gzip
import random
import zlib

import numpy as np
import pytest

from quipu.sources import splits


def body(lines, seed=1):
    rng = random.Random(seed)
    words = ["organismo", "pago", "ñandú", "2024-01-31", "servicio de salud", "", "x" * 200]
    return "".join(f"{k};{rng.choice(words)};{rng.random()};{rng.choice(words)}\n" + ("\n  \n" if k % 97 == 0 else "") for k in range(lines))


@pytest.mark.parametrize("bit", range(8))
def test_empty_blocks_fill_any_number_of_bits(bit):
    whole, low = splits.lead(bit)
    assert low < 1 << bit or bit == 0
    packer = zlib.compressobj(9, zlib.DEFLATED, -15)
    data = packer.compress(b"hello hello hello") + packer.flush()
    number = int.from_bytes(data, "little") << bit
    shifted = (number | low).to_bytes(len(data) + 1, "little")
    assert zlib.decompressobj(-15).decompress(whole + shifted) == b"hello hello hello"


def stretches(path, spacing):
    with splits._open(path) as stream:
        return list(splits._Pass(stream, spacing).points())


@pytest.mark.parametrize("level,members", [(6, 1), (1, 1), (9, 3), (0, 1)])
def test_stretches_are_the_file(tmp_path, level, members):
    text = body(60_000)
    data = text.encode()
    cut = len(data) // members
    path = tmp_path / "f.gz"
    path.write_bytes(b"".join(gzip.compress(data[k * cut : (k + 1) * cut if k + 1 < members else None], level) for k in range(members)))
    *points, end = stretches(f"file://{path}", 100_000)
    assert end[:3] == (-1, -1, len(data)) and end[3] == sum(bool(x.strip()) for x in text.split("\n"))
    assert len(points) >= (5 if level else 1)
    want = [(k + 1, line) for k, line in enumerate(x for x in text.split("\n") if x.strip())]
    got = []
    for k, (byte, bit, at, rows, window) in enumerate(points):
        if bit >= 0:
            assert data[max(0, at - len(window)) : at] == window
        until = points[k + 1][2] if k + 1 < len(points) else None
        got += splits.lines_of(splits._stretch(f"file://{path}", byte, bit, window), at, until, bit < 0 or window[-1:] == b"\n", rows)
    assert got == want


def test_a_damaged_or_cut_file_fails(tmp_path):
    data = bytearray(gzip.compress(body(20_000).encode()))
    for name, broken in (("cut", data[:-200]), ("flipped", data[:-6] + bytes([data[-6] ^ 1]) + data[-5:])):
        (tmp_path / name).write_bytes(broken)
        with pytest.raises((ValueError, zlib.error)):
            stretches(f"file://{tmp_path}/{name}", 50_000)


def test_few_positions_look_like_blocks():
    noise = np.random.default_rng(3).integers(0, 256, 1 << 16, dtype=np.uint8).tobytes()
    assert len(splits.possible_blocks(noise)) < 2000 and len(splits.possible_blocks(b"")) == 0


def test_files_as_a_table(spark, tmp_path):
    rows = [f'{k};"a;{k} ""x""";{"" if k % 3 else "ñ"}' for k in range(30_000)]
    random.Random(2).shuffle(rows)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.gz").write_bytes(gzip.compress(("﻿id;Glosa;Región\r\n" + "\r\n".join(rows[:20_000])).encode()))
    (tmp_path / "d" / "b.gz").write_bytes(gzip.compress(("id;Glosa;Región\n" + "\n".join(rows[20_000:]) + "\n\n").encode()))
    df = splits.read_gzip(spark, f"file://{tmp_path}/d", spacing=30_000)
    assert df.columns == ["id", "Glosa", "Región", "source_row_number"]
    assert df.rdd.getNumPartitions() >= 4
    got = {int(r["id"]): (r["Glosa"], r["Región"], r["source_row_number"]) for r in df.collect()}
    want = {}
    for part in (rows[:20_000], rows[20_000:]):
        for n, line in enumerate(part):
            k = int(line.split(";")[0])
            want[k] = (f'a;{k} "x"', None if k % 3 else "ñ", n + 1)
    assert got == want
    numbers = [r[0] for r in splits.read_gzip(spark, f"file://{tmp_path}/d", spacing=30_000, across=True).select("source_row_number").collect()]
    assert sorted(numbers) == list(range(1, 30_001))
