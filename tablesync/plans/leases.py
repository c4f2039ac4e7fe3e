"""Leases on tables, so that of runs started together one writes.

A lease is a numbered file that only one run can create, as publishing fails where a name is taken. It
ends when its holder releases it or its time is over; the next one has the next number. A holder asks
just before it publishes a write whether its number is still the newest: one that was slow, and whose
lease another run took over, cannot publish.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from datetime import datetime, timedelta

from tablesync.errors import ConcurrentWriteError
from tablesync.targets.storage import Storage

_LEASES = "_leases"


@dataclass(frozen=True)
class Lease:
    storage: Storage
    folder: str
    token: int
    name: str

    def check(self) -> None:
        if newest(self.storage, self.folder) != self.token:
            raise ConcurrentWriteError(f"{self.name}: another run took over this one's lease")

    def release(self) -> None:
        self.storage.publish_text(f"{self.folder}/{self.token:08d}.done", "")


def folder_of(pipeline: str, table: str) -> str:
    return f"{_LEASES}/{hashlib.sha256(json.dumps([pipeline, table]).encode()).hexdigest()[:32]}"


def newest(storage: Storage, folder: str) -> int:
    return max((int(n[:8]) for n in storage.names(folder) if n.endswith(".json")), default=0)


def take(storage: Storage, pipeline: str, table: str, now: datetime, time: timedelta) -> Lease | None:
    """The lease, or None while another run holds it."""
    folder = folder_of(pipeline, table)
    last = newest(storage, folder)
    if last and not storage.exists(f"{folder}/{last:08d}.done"):
        try:
            until = datetime.fromisoformat(json.loads(storage.read_text(f"{folder}/{last:08d}.json"))["until"])
        except FileNotFoundError:  # a later run has tidied up: it holds the lease
            return None
        if until > now:
            return None
    if not storage.publish_text(f"{folder}/{last + 1:08d}.json", json.dumps({"until": (now + time).isoformat()})):
        return None
    for ended in range(last - 1, max(last - 3, 0), -1):
        storage.delete(f"{folder}/{ended:08d}.json")
        storage.delete(f"{folder}/{ended:08d}.done")
    return Lease(storage, folder, last + 1, f"{pipeline}/{table}")
