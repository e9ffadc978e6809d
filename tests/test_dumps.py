"""The dump source against a plain read: frames cut anywhere, ranges of any size, files cut short."""

import bz2
import gzip
import random

import pytest
import zstandard
from tickmill.sources import dumps


def text(r, n, hard=False):
    games = []
    for i in range(n):
        junk = "".join(r.choice("abc {}[]\n.") for _ in range(r.choice([0, 3, 40, 3000] if i % 50 == 0 else [0, 3, 40])))
        games.append(f'[Event "{i}"]\n[Site "é{i}"]\n\n{junk}{"".join(chr(r.randrange(33, 1000)) for _ in range(90)) if hard else ""}')
    return "\n\n".join(games) + "\n"


def expected(data):
    parts = data.decode("utf-8", "replace").split("\n\n[Event ")
    return sorted(x for x in [parts[0], *("[Event " + p for p in parts[1:])] if x.strip())


def frames(r, data, most):
    """Frames cut at any byte, with and without checksum and size, and some to be skipped."""
    out, i = b"", 0
    while i < len(data):
        n = r.randrange(1, most)
        c = zstandard.ZstdCompressor(level=r.choice([1, 9]), write_checksum=r.random() < 0.5, write_content_size=r.random() < 0.5)
        out += c.compress(data[i : i + n])
        if r.random() < 0.2:
            out += b"\x53\x2a\x4d\x18" + (5).to_bytes(4, "little") + b"\x28\xb5\x2f\xfd."
        i += n
    return out


@pytest.mark.parametrize("most,split", [(40, 64), (3000, 500), (100_000, 20_000), (10**9, 10_000)])
def test_frames_cut_anywhere(spark, tmp_path, most, split):
    r = random.Random(most)
    data = text(r, 60 if most < 100 else 1500).encode()
    (tmp_path / "a.zst").write_bytes(frames(r, data, most))
    (tmp_path / "plain.txt").write_bytes(data)
    for name in ("a.zst", "plain.txt"):
        df = dumps.read_records(spark, str(tmp_path / name), split_bytes=split)
        assert sorted(x.value for x in df.collect()) == expected(data)
        assert df.rdd.getNumPartitions() == -(-(tmp_path / name).stat().st_size // split)


def test_pieces_in_any_cut():
    """Records of all ranges together are the file's, each once, however text falls into pieces and ranges."""
    r = random.Random(2)
    for _ in range(400):
        data = "".join(r.choice(["\n\n[E ", "\n", "[E ", "x", "\n\n", ""]) for _ in range(r.randrange(40))).encode()
        cuts = sorted({0, len(data), *(r.randrange(len(data) + 1) for _ in range(r.randrange(6)))})
        got = []
        for a, b in zip(cuts, cuts[1:]):
            own = [(data[i : min(i + 3, b)], True) for i in range(a, b, 3)]
            got += [x for x, _ in dumps.cut_records(iter(own + [(data[i : i + 2], False) for i in range(b, len(data), 2)]), b"\n\n[E ", a == 0)]
        assert [x for x in got if x.strip()] == [x for x in data.split(b"\n\n[E ") if x.strip()], (data, cuts)


def test_magic_numbers_in_the_data(spark, tmp_path):
    """Text that doesn't compress holds whatever it holds, also a frame's first bytes."""
    r = random.Random(4)
    looks = [dumps.MAGIC, b"\x53\x2a\x4d\x18\xff\xff\xff\x7f", b"\x50\x2a\x4d\x18\x05\x00\x00\x00", dumps.MAGIC + b"\x20\x05"]
    body = b"".join(b"\n\n[Event " + r.choice(looks) + bytes(r.randrange(256) for _ in range(300)).replace(b"\n", b"") for _ in range(400))
    (tmp_path / "raw.zst").write_bytes(b"".join(zstandard.ZstdCompressor().compress(body[i : i + 5000]) for i in range(0, len(body), 5000)))
    got = dumps.read_records(spark, str(tmp_path / "raw.zst"), split_bytes=3000)
    assert sorted(x.value for x in got.collect()) == expected(body)


@pytest.mark.parametrize("most", [2000, 10**9])
def test_cut_short(spark, tmp_path, most):
    r = random.Random(6)
    data = text(r, 2500, hard=True).encode()
    packed = frames(r, data, most)
    packed = packed[: len(packed) * 2 // 3]
    (tmp_path / "cut.zst").write_bytes(packed)
    got = [x.value for x in dumps.read_records(spark, str(tmp_path / "cut.zst"), split_bytes=4000).collect()]
    want = set(expected(data))
    broken = [x for x in got if x not in want]
    assert len(got) > 1000 and len(broken) <= 1 and len(set(got)) == len(got)


def test_other_files(spark, tmp_path):
    r = random.Random(7)
    data = text(r, 300).encode()
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.gz").write_bytes(gzip.compress(data[:5000]) + gzip.compress(data[5000:]))
    (folder / "b.bz2").write_bytes(bz2.compress(data))
    (folder / "empty.zst").write_bytes(b"")
    (folder / "_hidden").write_bytes(data)
    got = dumps.read_records(spark, str(folder)).collect()
    assert sorted(x.value for x in got) == sorted(expected(data) * 2) and len({x.file for x in got}) == 2
    lines = b"".join(b'{"fen":"%d"}\n' % i for i in range(3000))
    (tmp_path / "lines.zst").write_bytes(frames(r, lines, 700))
    got = dumps.read_records(spark, str(tmp_path / "lines.zst"), "\n", 900)
    assert sorted(x.value for x in got.collect()) == sorted(lines.decode().split())
    with pytest.raises(Exception, match="nowhere"):
        dumps.read_records(spark, str(tmp_path / "nowhere.zst")).count()
