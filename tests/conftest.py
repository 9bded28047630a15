import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from playline.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "playline-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


class Raw:
    """Raw files of one test, laid out as the pipeline expects them."""

    def __init__(self, root):
        self.root = root

    def write(self, key, content):
        path = self.root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
        return str(path)

    def media(self, stamp, records, point=True):
        key = f"raw_data/media/media_metadata_{stamp}.json"
        path = self.write(key, records)
        if point:
            self.write(
                "raw_data/media/s3_keys/latest_media_file.json", {"latest_s3_key": key}
            )
        return path

    def events(self, stamp, records, point=True):
        key = f"raw_data/events/player_events_{stamp}.json" if records is not None else None
        path = self.write(key, records) if key else None
        if point:
            self.write(
                "raw_data/events/s3_keys/latest_event_file.json", {"latest_s3_key": key}
            )
        return path


@pytest.fixture
def raw(tmp_path):
    return Raw(tmp_path / "raw")


def media(number, **changes):
    return {
        "id": number,
        "name": f"Film {number}",
        "thumbnail": {"url": f"https://cdn.example.com/{number}.jpg", "width": 200},
        "duration": 100.0 + number,
        "created": "2024-01-01T00:00:00+00:00",
        "updated": "2024-01-02T00:00:00+00:00",
        "hashed_id": f"h{number}",
        "section": "ignored",
        **changes,
    }


def event(key, media_id="h1", **changes):
    return {
        "visitor_key": "v1",
        "event_key": key,
        "received_at": "2024-01-30T10:00:00.000Z",
        "percent_viewed": 50,
        "ip": "10.0.0.1",
        "country": "KE",
        "media_id": media_id,
        "media_url": "https://media.example.com/1",
        **changes,
    }


def plan(df) -> str:
    """The physical plan as EXPLAIN prints it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
