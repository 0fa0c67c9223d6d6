import base64
import hashlib
from collections import Counter
from pathlib import Path

import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from levygrid.llm import warc

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>same</p>"),
    (4, "http://a/4 x\r\ny", None), (5, "http://a/5", ""), (None, "http://a/6", "<p>other é</p>"),
    (7, "http://a/7", "<p>other é</p>"), (8, "http://a/8", "big " * 50_000), (9, "", "P*M\x18\0\0\0\0 and \r\n\r\n WARC/1.1"),
    (10, "u", "twice"), (10, "u", "twice"), (None, None, "lone"), (None, None, "lone"),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 3, False) for r in rows], "page_id long, url string, html string, digest string, row int, revisit boolean")


def expected(rows):
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", -1), -1 if i is None else i)
    out, seen = Counter(), set()
    for i, _, html in rows:
        data = (html or "").encode()
        first = (-1 if i is None else i) == top[html or ""] and (html or "") not in seen
        if first:
            seen.add(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        refers = None if first or top[html or ""] == -1 else top[html or ""]
        out[i, len(data), digest, "response" if first else "revisit", refers] += 1
    return out


@pytest.mark.parametrize("rows", [PAGES, [], PAGES[:1]])
def test_round_trip(spark, rows):
    assert Counter(tuple(r) for r in warc.archived(frame(spark, rows)).collect()) == expected(rows)


def test_small_payloads_are_all_archived(spark):
    got = warc.archived(frame(spark), min_bytes=12).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 12} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in got) == 1


def test_archives(spark, tmp_path):
    """The format, read without this library's reader."""
    path = str(tmp_path / "archive")
    warc.write_archives(frame(spark).coalesce(2), path)
    payloads = Counter()
    files = [p for p in Path(path).glob("part-*") if p.stat().st_size]
    for file in files:
        data = file.read_bytes()
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size :], read_across_frames=True)
        records = reader.read()
        while records:
            head, _, rest = records.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            assert rest[length : length + 4] == b"\r\n\r\n"
            if fields[b"WARC-Type"] == b"response":
                payloads[rest[:length].partition(b"\r\n\r\n")[2].decode()] += 1
            records = rest[length + 4 :]
    assert payloads == Counter({html or "" for _, _, html in PAGES})


def test_dictionary_of_large_pages(spark, tmp_path, monkeypatch):
    """Records above the sample's block size train the dictionary too, and archives shrink with it."""
    def page(i):
        body = " ".join(f"n{(i * 7919 + k * 31) % 100_003}" for k in range(9_000))
        return f"<html><head><title>{i}</title></head><nav>Home About Contact</nav><p>{body}</p><footer>all rights kept</footer></html>"

    rows = [(i, f"http://a/{i}", page(i)) for i in range(60)]
    assert min(len(r[2]) for r in rows) > warc.SAMPLE_BYTES
    sizes = []
    for train in (warc.train_dictionary, lambda samples: b""):
        monkeypatch.setattr(warc, "train_dictionary", train)
        path = tmp_path / f"a{len(sizes)}"
        warc.write_archives(frame(spark, rows).coalesce(1), str(path))
        (file,) = path.glob("part-*")
        data = file.read_bytes()
        held = int.from_bytes(data[4:8], "little")
        sizes.append((held, len(data) - held))
        assert Counter(tuple(r) for r in warc.read_archives(spark, str(path)).collect()) == expected(rows)
    assert sizes[0][0] > 1000 and sizes[1][0] == 0 and sizes[0][1] < sizes[1][1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=400) | st.binary(max_size=3).map(lambda b: b * 90_000), max_size=6), st.booleans(), st.booleans())
def test_frames_end_where_they_end(parts, checksum, sized):
    packer = zstandard.ZstdCompressor(write_checksum=checksum, write_content_size=sized)
    frames = [packer.compress(p) for p in parts]
    data, at = b"".join(f + warc._EMPTY_FRAME.encode() for f in frames), 0
    for f in frames:
        at = warc.frame_end(data, at)
        assert data[:at].endswith(f)
        at = warc.frame_end(data, at)
    assert at == len(data)


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"payload", None, False, "d")
    assert warc._parsed(raw)[3] == "response"
    with pytest.raises(ValueError):
        warc._parsed(raw.replace(b"payload", b"payloae"))
