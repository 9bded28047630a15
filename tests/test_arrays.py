import json
import random

import pytest
from pyspark.errors import PySparkException

from playline.sources.arrays import array_objects
from playline.sources.raw import read_engagement, read_events, read_media, read_visitors

PARTS = ['"', "\\", "{", "}", "[", "]", ",", ":", "é", "😀", "\n", "a", " ", "}, {", '\\"', "]}"]


def record(pick):
    text = lambda: "".join(pick.choice(PARTS) for _ in range(pick.randrange(12)))
    own = {"id": pick.randrange(10**6), "text": text(), text(): [text(), {"x": {text(): [1, []]}}]}
    return own | ({"long": text() * 300} if pick.random() < 0.02 else {})


def objects(spark, path):
    return sorted(
        (json.loads(r.object) for r in array_objects(spark, path).collect()), key=json.dumps
    )


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("joined", [False, True])
def test_objects_over_blocks_of_any_size(spark, settings, tmp_path, indent, joined):
    pick = random.Random(7)
    files = []
    for name in range(3):
        rows = [record(pick) for _ in range(pick.choice([1, 40, 150]))]
        files += rows
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    if joined:
        settings(playline__lookup__broadcastBytes=0)
    for size in (300, 4000):
        settings(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=0)
        assert objects(spark, str(tmp_path)) == sorted(files, key=json.dumps)


def test_one_file_is_many_tasks(spark, settings, tmp_path):
    rows = [{"media_id": f"m{i}", "engagement": {"plays": i}} for i in range(2000)]
    path = tmp_path / "engagement.json"
    path.write_text(json.dumps(rows, indent=2))
    settings(spark__sql__files__maxPartitionBytes=10_000, spark__sql__files__openCostInBytes=0)
    plain, split = read_engagement(spark, str(path)), read_engagement(spark, str(path), "blocks")
    assert plain.schema == split.schema
    text = "to_json(struct(*)) AS row"
    assert sorted(plain.selectExpr(text).collect()) == sorted(split.selectExpr(text).collect())
    assert plain.rdd.getNumPartitions() == 1 and array_objects(spark, str(path)).rdd.getNumPartitions() > 5


def test_rows_equal_the_other_reader(spark, settings, raw):
    media = [{"id": i, "name": f'}}{{"{i}', "duration": "x" if i == 3 else i} for i in range(50)]
    events = [{"event_key": str(i), "received_at": "2024-01-01T00:00:00Z"} for i in range(50)]
    events.append({"event_key": "bad", "received_at": "oops", "percent_viewed": "0.5"})
    settings(spark__sql__files__maxPartitionBytes=500, spark__sql__files__openCostInBytes=0)
    for read, rows in ((read_media, media), (read_events, events)):
        path = raw.write(f"{read.__name__}.json", rows)
        plain, split = read(spark, path), read(spark, path, "blocks")
        assert plain.schema == split.schema
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect()))
    path = raw.write("visitors.json", [{"a": {"b": "]"}}, {"c": None}])
    shown = lambda df: sorted(r.v for r in df.selectExpr("to_json(visitor) AS v").collect())
    assert shown(read_visitors(spark, path)) == shown(read_visitors(spark, path, "blocks"))


@pytest.mark.parametrize("text, rows", [
    ("", []), (" \n", []), ("[]", []), ("[\n]\n", []), ('{"a": 1}', [{"a": 1}]),
    ('{"a": "}"}\n', [{"a": "}"}]), ('\n[ {"a": {}} ,{"b": "\\\\"} ]', [{"a": {}}, {"b": "\\"}]),
])
def test_small_files(spark, tmp_path, text, rows):
    (tmp_path / "a.json").write_text(text)
    assert objects(spark, str(tmp_path)) == rows


@pytest.mark.parametrize("text", [
    '[{"a": 1}', '[{"a": 1}, {"b"', '[{"a": "x]', '[{"a": 1}, 2]', '[{"a": 1}, ["x"]]',
    '["x", {"a": 1}]', '[{"a": 1}] x', "plain", '[[{"a": 1}]]', '[{"a": 1}, null]',
])
def test_a_broken_file_raises(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(PySparkException):
        array_objects(spark, str(tmp_path)).collect()
