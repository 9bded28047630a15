import random

import pytest

from playline.llm.queries import op7_warc
from playline.llm.warc import (
    digest,
    member,
    page_records,
    read_archives,
    read_warc,
    record,
    salvage,
    write_warc,
)


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, b"x") for i, u, h in rows], "page_id long, url string, html string, payload binary"
    )


def brute(rows, least=0):
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == payload and k is not None]
        first = min(same, default=None)
        refers = None if first == key or len(payload) < least else first
        kind = "response" if refers is None else "revisit"
        out.append((key, len(payload), digest(payload), kind, refers))
    return sorted(out, key=str)


ROWS = [
    (4, "http://a", "été"), (2, None, "été"), (9, "http://b\r\nX: y", None), (8, "u", ""),
    (3, "u", "short"), (5, "u", "short"), (5, "u", "short"), (None, "u", "short"), (None, "u", "own"),
    (7, "u", "WARC/1.1\r\n\r\n" * 2000), (6, "u", "\x00" * 300_000),
]


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, tmp_path, least):
    write_warc(pages(spark, ROWS), str(tmp_path / "a"), revisit_from=least, archive_bytes=500)
    found = read_warc(read_archives(spark, str(tmp_path / "a")))
    assert sorted(map(tuple, page_records(found).collect()), key=str) == brute(ROWS, least)
    full = {r.record_id: r.payload for r in found.where("record_type = 'response'").collect()}
    assert bytes(full["<urn:page:6>"]) == b"\x00" * 300_000


def test_empty_tables(spark, tmp_path):
    write_warc(pages(spark, []), str(tmp_path / "a"))
    assert read_warc(read_archives(spark, str(tmp_path / "a"))).collect() == []
    nothing = spark.createDataFrame([("a", None), ("b", b"")], "path string, content binary")
    assert read_warc(nothing).collect() == []


def parts(count, packed):
    raw = [record(i, f"http://x/{i}", f"page {i} ".encode() * 50, None) for i in range(count)]
    return [member(r) for r in raw] if packed else raw


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_loses_only_the_damaged_records(packed):
    pick = random.Random(2)
    whole = parts(30, packed)
    for hurt in (0, 7, 29):
        for at in (0, 5, len(whole[hurt]) // 2, len(whole[hurt]) - 6):
            own = bytearray(whole[hurt])
            own[at] ^= pick.randrange(1, 255)
            content = b"".join([*whole[:hurt], bytes(own), *whole[hurt + 1 :]])
            found = list(salvage(content))
            kept = {one["record_id"] for _, _, one, _ in found if one}
            assert kept >= {f"<urn:page:{i}>" for i in range(30) if i != hurt}
            gaps = [(a, n) for a, n, one, why in found if why]
            if len(kept) == 29:
                assert gaps == [(sum(map(len, whole[:hurt])), len(own))]
            # Records and gaps cover the archive without overlap.
            ends = 0
            for a, n, _, _ in found:
                assert a == ends
                ends = a + n
            assert ends == len(content)


def test_cut_off_and_foreign_bytes():
    whole = parts(3, True)
    found = list(salvage(b"junk" + whole[0] + b"\x1f\x8b\x08none" + whole[1] + whole[2][:-9]))
    assert [(one or {}).get("record_id") for _, _, one, _ in found] == [
        None, "<urn:page:0>", None, "<urn:page:1>", None,
    ]
    assert found[-1][3] == "member is cut off"
    assert [w for _, _, _, w in salvage(b"only junk")] == ["no version line"]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, op7_warc(spark, sf_dir).collect()), key=str) == brute(rows)
