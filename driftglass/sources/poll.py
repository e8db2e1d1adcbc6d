"""Polling a snapshot service: decisions as pure functions, and a streaming Python data source."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: Fixed values of the polling rule, seconds.
PERIOD, FIRST_OFFSET, LEAST_OFFSET, MOST_OFFSET = 10.0, 3.0, 0.5, 12.0
EARLIER, LATER, RETRY, LEAST_WAIT, MOST_WAIT = 0.1, 1.0, 1.5, 1.0, 15.0


def decide(snapshot: int | None, watermark: int | None) -> str:
    """send, repeat or older, against the newest snapshot sent; without either there is nothing to hold it against."""
    if snapshot is None or watermark is None or snapshot > watermark:
        return "send"
    return "repeat" if snapshot == watermark else "older"


@dataclass(frozen=True)
class PollState:
    offset: float = FIRST_OFFSET
    last_sent: float | None = None
    retried: bool = False


def next_poll(outcome: str, snapshot: float | None, state: PollState, now: float) -> tuple[float, PollState]:
    """Seconds to wait and the new state.

    A sent snapshot moves the poll a little earlier in the service's period; one that was not new yet moves it later and
    is asked for once more soon. Anything else waits for the next period.
    """
    if outcome == "sent" and snapshot is not None:
        state = PollState(max(LEAST_OFFSET, state.offset - EARLIER), snapshot, False)
        at = snapshot + PERIOD + state.offset
    elif outcome in ("repeat", "older") and state.last_sent is not None and not state.retried:
        state = replace(state, offset=min(MOST_OFFSET, state.offset + LATER), retried=True)
        at = now + RETRY
    else:
        state = replace(state, retried=False)
        if state.last_sent is None:
            at = now + PERIOD
        else:
            first = state.last_sent + PERIOD + state.offset
            behind = now + LEAST_WAIT - first
            at = first + PERIOD * max(0, -int(-behind // PERIOD))
    return min(MOST_WAIT, max(LEAST_WAIT, at - now)), state


def classify(error: BaseException) -> dict:
    """Kind and HTTP status of a failed poll; a refused status is an http error, an unreadable body a parse error."""
    if isinstance(error, urllib.error.HTTPError):
        return {"kind": "http", "status": error.code}
    if isinstance(error, ValueError):
        return {"kind": "parse", "status": None}
    if isinstance(error, (urllib.error.URLError, ConnectionError, TimeoutError)):
        return {"kind": "network", "status": None}
    return {"kind": "kafka" if type(error).__name__.startswith("Kafka") else "other", "status": None}


def poll(fetch, send, watermark: int | None) -> tuple[str, int | None, dict | None]:
    """One poll: (outcome, watermark, error). The watermark moves only after ``send`` returned without an error."""
    try:
        body = fetch()
        snapshot = body.get("time")
        what = decide(snapshot, watermark)
        if what != "send":
            return what, watermark, None
        send(snapshot, body.get("states") or [])
        return "sent", snapshot, None
    except Exception as e:
        return "error", watermark, classify(e)


def http_fetch(url: str, box: tuple[float, float, float, float] = (33.0, 126.0, 38.5, 130.0), timeout: float = 10.0):
    """A fetch function for a service that takes a bounding box (lat, lon, lat, lon)."""
    query = "lamin={}&lomin={}&lamax={}&lomax={}".format(*box)

    def fetch() -> dict:
        with urllib.request.urlopen(f"{url}?{query}", timeout=timeout) as r:
            return json.loads(r.read())

    return fetch


def file_sender(folder: str):
    """A send function that records snapshots, one JSON file each, named by their time so that names sort like times.

    A file is whole or not there; a snapshot sent again replaces itself. ``SnapshotSource`` replays the folder.
    """
    os.makedirs(folder, exist_ok=True)

    def send(snapshot: int, vectors: list) -> None:
        side = os.path.join(folder, f".{snapshot}.tmp")
        with open(side, "w", encoding="utf-8") as f:
            json.dump({"time": snapshot, "states": vectors}, f)
        os.replace(side, os.path.join(folder, f"{snapshot:012d}.json"))

    return send


class SnapshotReader(SimpleDataSourceStreamReader):
    """Replays recorded snapshots (one JSON file each, in name order) as a stream of state vectors."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.most = int(options.get("maxFilesPerTrigger", 10))

    def _names(self) -> list[str]:
        return sorted(n for n in os.listdir(self.folder) if n.endswith(".json"))

    def initialOffset(self) -> dict:
        return {"files": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"files": min(len(self._names()), start["files"] + self.most)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        rows = []
        for name in self._names()[start["files"] : end["files"]]:
            with open(os.path.join(self.folder, name), encoding="utf-8") as f:
                body = json.load(f)
            rows += [([None if v is None else v if isinstance(v, str) else json.dumps(v) for v in vector], body.get("time")) for vector in body.get("states") or []]
        return iter(rows)  # Spark copies the iterator

    def commit(self, end: dict) -> None:
        return None


class SnapshotSource(DataSource):
    """spark.readStream.format("snapshots"): (vector array<string>, snapshot long)."""

    @classmethod
    def name(cls) -> str:
        return "snapshots"

    def schema(self) -> str:
        return "vector array<string>, snapshot long"

    def simpleStreamReader(self, schema) -> SnapshotReader:
        return SnapshotReader(self.options)
