"""Landed pages with damaged lines: every entry is either read or put aside."""

import json
import os

from cadenza.session import scratch_path
from cadenza.sources import readers


def page(playlist, number, items):
    return json.dumps({"playlist_id": playlist, "page_no": number, "items": items})


def track(id, popularity=5):
    return {"track": {"id": id, "name": "n", "popularity": popularity, "artists": [{"id": "a", "name": "b"}], "album": None}}


def test_every_entry_is_read_or_put_aside(spark):
    path = scratch_path(spark, "landed")
    os.makedirs(path)
    good = page("p", 1, [track("1"), {"track": None}, track(""), track(None), None, track("2")])
    lines = [good, page("p", 2, [track("3", "many"), track("4")]), good[:40], "no json", "", page("q", 3, None), page("q", 4, [])]
    with open(f"{path}/a.json", "w") as f:
        f.write("\n".join(lines[:3]))
    with open(f"{path}/b.json", "w") as f:
        f.write("\n".join(lines[3:]))
    rows, aside = readers.read_checked_pages(spark, path)
    assert sorted((r["playlist_id"], r["page_no"], r["pos"], r["track"]["id"]) for r in rows.collect()) == [
        ("p", 1, 0, "1"), ("p", 1, 5, "2")]
    found = sorted((r["reason"], r["file"], -1 if r["pos"] is None else r["pos"]) for r in aside.collect())
    assert found == [("damaged page", "a.json", -1), ("damaged page", "a.json", -1), ("damaged page", "b.json", -1),
                     ("no id", "a.json", 2), ("no id", "a.json", 3), ("no items", "b.json", -1),
                     ("no track", "a.json", 1), ("no track", "a.json", 4)]
    kept = {r["record"] for r in aside.filter("reason = 'damaged page'").collect()}
    assert kept == {lines[1], lines[2], lines[3]}
    assert rows.columns == readers.read_playlist_pages(spark, path).columns
