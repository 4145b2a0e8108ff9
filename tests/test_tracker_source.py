import datetime as dt
import fcntl
import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablesync.plans.jobs import sync_documents
from tablesync.plans.sinks import TableFamily
from tablesync.sources import tracker
from tablesync.sources.documents import RestSearchFetcher
from tablesync.streaming.incremental import start_sync, tracker_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = dt.datetime(2024, 3, 1)


class MovingTracker:
    """A tracker in a file; while ``moves`` lasts, every search updates a document first."""

    def __init__(self, options):
        self.path = options["state"]
        self.calls = []

    def change(self, act):
        with open(self.path, "r+") as fh:
            fcntl.flock(fh, fcntl.LOCK_EX)
            state = json.load(fh)
            out = act(state)
            fh.seek(0)
            fh.truncate()
            json.dump(state, fh)
            return out

    @staticmethod
    def stamp(ms):
        return (START + dt.timedelta(milliseconds=ms)).strftime("%Y-%m-%dT%H:%M:%S.%f")[:23] + "+1100"

    @staticmethod
    def move(state):
        if state["moves"]:
            state["moves"] -= 1
            rng = random.Random(state["moves"])
            state["clock"] += 700
            key = rng.choice(sorted(state["docs"]))
            state["docs"][key] = [state["clock"], state["docs"][key][1] + 1]

    def _in(self, state, since, before):
        found = sorted((ms, key, version) for key, (ms, version) in state["docs"].items())
        minute = lambda ms: tracker.minute_of(self.stamp(ms))
        return [(ms, k, v) for ms, k, v in found if minute(ms) >= since and (before is None or minute(ms) < before)]

    def now(self):
        return tracker.minute_of(self.stamp(self.change(lambda s: s["clock"])))

    def first(self, query):
        return self.change(lambda s: tracker.minute_of(self.stamp(min(ms for ms, _ in s["docs"].values())))) if self._any() else None

    def _any(self):
        return self.change(lambda s: bool(s["docs"]))

    def count(self, query, since, before):
        return self.change(lambda s: len(self._in(s, since, before)))

    def search(self, query, since, before, start_at, limit):
        def act(state):
            self.move(state)
            return self._in(state, since, before)[start_at : start_at + limit]

        self.calls.append((since, before, start_at, limit))
        return [
            {"key": k, "id": k, "fields": {"issuetype": {"name": "Bug"}, "updated": self.stamp(ms), "version": v}, "changelog": {}}
            for ms, k, v in self.change(act)
        ]


def make(root, n, moves=0, step_ms=9_000):
    path = os.path.join(root, f"tracker-{n}-{moves}-{step_ms}.json")
    docs = {f"K-{i}": [i * step_ms, 0] for i in range(n)}
    with open(path, "w") as fh:
        json.dump({"clock": n * step_ms + 200_000, "moves": moves, "docs": docs}, fh)
    return path


def state_of(path):
    with open(path) as fh:
        return json.load(fh)


@pytest.mark.parametrize("page_size", [1, 3, 7, 100])
@pytest.mark.parametrize("step_ms", [0, 900, 61_000])  # all in one minute; many a minute; one a minute
def test_an_open_slice_loses_and_doubles_nothing_while_documents_move(tmp_root, page_size, step_ms):
    path = make(tmp_root, 60, moves=45, step_ms=step_ms)
    found = list(tracker.read_slice(MovingTracker({"state": path}), "", "2024/03/01 00:00", None, page_size))
    assert len(found) == len({(k, u) for k, u, _ in found})  # no version twice
    latest = {}
    for key, updated, _ in found:
        assert updated >= latest.get(key, "")
        latest[key] = updated
    assert latest == {k: MovingTracker.stamp(ms) for k, (ms, _) in state_of(path)["docs"].items()}


def test_slices_hold_about_as_many_documents_and_cover_the_time(tmp_root):
    fetcher = MovingTracker({"state": make(tmp_root, 500)})
    before = fetcher.now()
    slices = tracker.plan_slices(fetcher, "", fetcher.first(""), before, 40)
    counts = [fetcher.count("", s.since, s.before) for s in slices]
    assert sum(counts) == 500 and max(counts) <= 40 and min(counts) >= 5
    assert all(a.before <= b.since for a, b in zip(slices, slices[1:]))
    assert tracker.plan_slices(fetcher, "", before, before, 40) == []


def test_fetch_for_sync_while_documents_change_slices(spark, tmp_root):
    path = make(tmp_root, 300, moves=80)
    fetch = tracker.fetch_for_sync(spark, MovingTracker, state=path, docs_per_partition="30", page_size="10")
    family = TableFamily(spark, os.path.join(tmp_root, "family"))
    names = {"updated": "Mise_a_jour"}
    sync_documents(spark, fetch, family, field_map=names)
    rows = {r.jira: r.version for r in family.read("Bug").select("jira", "version").collect()}
    assert family.read("Bug").count() == 300
    assert rows == {k: v for k, (_, v) in state_of(path)["docs"].items()}  # every document, at its last version
    # the next read starts at the mark
    fetcher = MovingTracker({"state": path})
    fetcher.change(lambda s: s.update(moves=3))
    result = sync_documents(spark, fetch, family, field_map=names).collect()
    assert result[0].mode == "incremental" and result[0].fetched < 40
    rows = {r.jira: r.version for r in family.read("Bug").select("jira", "version").collect()}
    assert rows == {k: v for k, (_, v) in state_of(path)["docs"].items()}


def test_bounds_reach_the_search(spark, tmp_root):
    path = make(tmp_root, 200)
    tracker.register(spark, MovingTracker)
    options = {"state": path, "docs_per_partition": "20"}
    whole = tracker.updated_between(spark, **options)
    at = lambda minute, second: dt.datetime(2024, 3, 1, 0, minute, second, tzinfo=dt.timezone(dt.timedelta(hours=11)))
    late = tracker.updated_between(spark, after=at(20, 30), **options)
    middle = tracker.updated_between(spark, after=at(10, 0), before=at(12, 30), **options)
    assert late.rdd.getNumPartitions() < whole.rdd.getNumPartitions() / 2
    for df, want in ((late, range(137, 200)), (middle, range(67, 84)), (whole, range(200))):
        assert sorted(int(r.key[2:]) for r in df.select("key").collect()) == list(want)
    assert middle.where(F.col("updated") > F.lit(at(12, 0))).count() == 3 and middle.count() == 17


def test_an_empty_tracker(spark, tmp_root):
    tracker.register(spark, MovingTracker)
    assert spark.read.format("updated_documents").options(state=make(tmp_root, 0)).load().count() == 0


def test_stream_of_updates_with_a_restart(spark, tmp_root):
    path = make(tmp_root, 120)
    family = TableFamily(spark, os.path.join(tmp_root, "stream-family"))
    checkpoint = os.path.join(tmp_root, "stream-checkpoint")
    fetcher = MovingTracker({"state": path})
    middle = "2024/03/01 00:09"
    for until in (middle, None, None, None):
        options = {"state": path, "docs_per_partition": "25", **({"until": until} if until else {})}
        query = start_sync(spark, tracker_stream(spark, MovingTracker, **options), family, checkpoint=checkpoint)
        query.awaitTermination(300)
        assert query.exception() is None
        found = {r.jira: r.version for r in family.read("Bug").select("jira", "version").collect()}
        state = state_of(path)["docs"]
        if until:
            assert set(found) == {k for k, (ms, _) in state.items() if tracker.minute_of(MovingTracker.stamp(ms)) < until}
        else:
            assert found == {k: v for k, (_, v) in state.items()}
        if until is None:  # updates between the batches, then the minute ends
            fetcher.change(lambda s: [s.update(moves=5), *(MovingTracker.move(s) for _ in range(5)), s.update(clock=s["clock"] + 60_000)])


def test_rest_statements():
    asked = []

    class Rest(RestSearchFetcher):
        def _get(self, path, params=None):
            asked.append((path, params))
            return {"total": 3, "issues": [{"fields": {"updated": "2024-03-05T10:00:01.000+1100"}}], "serverTime": "2024-03-05T10:07:01.000+1100"}

    rest = Rest({"url": "http://x", "project": "P"})
    assert rest.now() == "2024/03/05 10:07" and rest.first("") == "2024/03/05 10:00"
    assert rest.count("", "2024/03/05 10:00", "2024/03/06 00:00") == 3
    assert asked[-1][1] == {"jql": 'project=P AND updated >= "2024/03/05 10:00" AND updated < "2024/03/06 00:00"', "maxResults": 0}
    rest.search("a = 1 OR b = 2", "2024/03/05 10:00", None, 7, 100)
    assert asked[-1][1]["jql"] == '(a = 1 OR b = 2) AND updated >= "2024/03/05 10:00" ORDER BY updated ASC, key ASC'
    rest.page("", 200, 100, "2024/03/05 10:00")
    assert asked[-1][1]["jql"] == 'project=P AND updated > "2024/03/05 10:00" ORDER BY key ASC'
