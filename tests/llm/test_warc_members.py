import pytest

from playline.llm.warc import member, record, salvage


def ids(content):
    return [(one or {}).get("record_id") for _, _, one, _ in salvage(content)]


def whole(count):
    return [record(i, f"http://x/{i}", bytes(range(256)) * (i + 1), None) for i in range(count)]


def named(*keys):
    return [None if k is None else f"<urn:page:{k}>" for k in keys]


@pytest.mark.parametrize("hurt", [0, 3, 5])
def test_one_damaged_record_of_a_member_loses_only_itself(hurt):
    parts = whole(6)
    parts[hurt] = parts[hurt].replace(b"sha1:", b"sha1:X", 2)
    content = member(b"".join(parts)) + member(record(9, "u", b"next", None))
    assert ids(content) == named(*[None if i == hurt else i for i in range(6)], 9)
    assert {why for _, _, one, why in salvage(content) if one is None} == {"block digest differs"}


def test_records_before_a_break_of_the_member_stay():
    import random

    pick = random.Random(5)
    parts = [record(i, f"http://x/{i}", pick.randbytes(40_000), None) for i in range(8)]
    packed = member(b"".join(parts))
    after = member(record(9, "u", b"next", None))
    found = list(salvage(packed[: len(packed) // 2]))
    assert [(one or {}).get("record_id") for _, _, one, _ in found] == named(0, 1, 2, None)
    assert found[-1][3] == "member is cut off"
    got = ids(packed[: len(packed) // 2] + after)
    assert got[:3] == named(0, 1, 2) and got[-1:] == named(9)
    zeroed = bytearray(packed)
    zeroed[len(packed) // 2 : len(packed) // 2 + 40] = b"\xff" * 40
    got = ids(bytes(zeroed) + after)
    assert got[:3] == named(0, 1, 2) and got[-1:] == named(9)
