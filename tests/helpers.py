"""Small builders of envelope lines and records."""

import json


def tweet(id, **fields):
    data = {
        "id": id,
        "created_at": "2026-01-01T00:00:00Z",
        "author_id": "10",
        "lang": "en",
        "text": "hi",
        "public_metrics": {
            "like_count": 1,
            "retweet_count": 2,
            "reply_count": 3,
            "quote_count": 4,
            "bookmark_count": 5,
            "impression_count": 6,
        },
    }
    data.update(fields)
    return line("tweet", data)


def include(kind="users", /, **data):
    return line(f"include:{kind}", data or {"dummy": "x"})


def page(n=1):
    return line("page", {"page": n, "meta": {"result_count": 0}})


def line(kind, data):
    return json.dumps({"kind": kind, "data": data}, separators=(",", ":"), ensure_ascii=False)


def records(spark, lines, log="a", block=0):
    """Envelope records from lines, all in one block."""
    rows = []
    for i, text in enumerate(lines):
        obj = json.loads(text)
        data = obj.get("data")
        rows.append(
            (log, block, i, obj["kind"], None if data is None else json.dumps(data, separators=(",", ":")))
        )
    return spark.createDataFrame(rows, "log STRING, block BIGINT, seq BIGINT, kind STRING, data STRING")
