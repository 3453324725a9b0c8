"""What a table of window partials consists of: one small file for each version.

A version lists the live segments with the range of their window starts, the closings, the
counters, and up to which batch each query was applied. It replaces folder listings: a
closing opens the segments whose range it needs and nothing else. A change takes effect
when its version is written, whole or not at all; what a run that broke off left behind
is in no version, and its repetition writes over it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from stationflow.sources import files

#: Versions kept behind the current one, for readers that are a little late.
KEPT_VERSIONS = 10
#: Segments of a tier that are merged into one of the next.
FAN = 16


@dataclass(frozen=True)
class Segment:
    """A folder of partials: its tier, and the range of its open windows (none: no such rows)."""

    name: str
    tier: int = 0
    first_us: int | None = None
    last_us: int | None = None
    missed: bool = False

    def holds(self, after_us: int | None, upto_us: int) -> bool:
        """Whether it may hold windows that start in ``(after, upto]``."""
        return self.first_us is not None and self.first_us <= upto_us and (after_us is None or self.last_us > after_us)


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    #: Window size plus grace, and whether duplicates are dropped: fixed for a table.
    span_us: int | None = None
    first_only: bool = False
    #: The last batch of each streaming query that was added.
    applied: dict[str, int] = field(default_factory=dict)
    segments: tuple[Segment, ...] = ()
    #: The last closing that was sent, its moment, and one that was begun: (number, moment).
    closings: int = 0
    upto_us: int | None = None
    closing: tuple[int, int] | None = None
    counts: dict[str, int] = field(default_factory=dict)
    #: Folders that no version from here on needs.
    garbage: tuple[str, ...] = ()
    merges: int = 0

    @property
    def closed_start_us(self) -> int | None:
        """Windows that start here or earlier are closed."""
        return None if self.upto_us is None or self.span_us is None else self.upto_us - self.span_us

    def counted(self, **more: int) -> dict[str, int]:
        return {name: self.counts.get(name, 0) + more.get(name, 0) for name in self.counts.keys() | more.keys()}


def read(spark: SparkSession, root: str) -> Manifest:
    """The newest version; an empty one before the first is written."""
    found = [name for name in files.names(spark, f"{root}/manifest") if name.endswith(".json") and not name.startswith(".")]
    if not found:
        return Manifest()
    raw = json.loads(files.read_text(spark, f"{root}/manifest/{found[-1]}"))
    raw["segments"] = tuple(Segment(**s) for s in raw["segments"])
    raw["closing"] = tuple(raw["closing"]) if raw["closing"] else None
    raw["garbage"] = tuple(raw["garbage"])
    return Manifest(**raw)


def commit(spark: SparkSession, root: str, before: Manifest, **changes) -> Manifest:
    """Write the version after ``before``. Another writer's version of that number raises."""
    after = replace(before, version=before.version + 1, **changes)
    files.write_new(spark, f"{root}/manifest/{after.version:020d}.json", json.dumps(asdict(after)))
    old = after.version - KEPT_VERSIONS
    if old > 0:
        files.delete(spark, f"{root}/manifest/{old:020d}.json")
    return after


def to_merge(segments: Iterable[Segment], fan: int = FAN) -> list[Segment]:
    """Segments of the lowest tier that has ``fan`` of them or more; none if no tier has."""
    tiers: dict[int, list[Segment]] = {}
    for segment in segments:
        tiers.setdefault(segment.tier, []).append(segment)
    return next((tiers[tier] for tier in sorted(tiers) if len(tiers[tier]) >= fan), [])
