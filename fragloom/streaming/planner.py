"""What to work on next: rows of due work in one order, and a ledger that takes batches only where they fit.

Minutes are whole numbers, counted from the epoch. Three lanes share the ledger:
live goes forward from the seam, backfill goes down from it to the floor, and
repair looks again for minutes that were missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime

#: Minutes that count as fresh, repairs in a row before backfill gets its turn, and every which one goes to an older gap.
FRESH, BURST, OLDER_EVERY = 15, 20, 4
#: Seconds until an absent minute, and a lane that failed, are tried again: first, and at most.
REPAIR_WAIT, FAILURE_WAIT = (30, 300), (15, 900)


def minute_of(stamp: str) -> int:
    """Number of the minute that 14 digits name."""
    if len(stamp) != 14 or not stamp.isdigit() or stamp[12:] != "00":
        raise ValueError(f"{stamp} is no whole minute")
    return int(datetime.strptime(stamp, "%Y%m%d%H%M%S").replace(tzinfo=UTC).timestamp()) // 60


def stamp_of(minute: int) -> str:
    return datetime.fromtimestamp(minute * 60, UTC).strftime("%Y%m%d%H%M%S")


def repair_delay(attempts: int) -> float:
    """Seconds until an absent minute is looked for again: 30, doubled with each attempt after the first, up to 5 minutes."""
    first, most = REPAIR_WAIT
    return min(most, first << min(attempts - 1, 4))


def failure_delay(attempts: int) -> float:
    """Seconds until a failed lane is tried again: 15, doubled with each attempt, up to 15 minutes."""
    first, most = FAILURE_WAIT
    return min(most, first << min(attempts, 6))


@dataclass(frozen=True)
class Config:
    lag_minutes: int = 1
    window_minutes: int = 15
    batch_minutes: int = 360
    retry_hours: int = 24
    poll_seconds: int = 30

    def __post_init__(self) -> None:
        if not (0 <= self.lag_minutes <= 60 and 1 <= self.window_minutes <= self.batch_minutes <= 1440 and 1 <= self.retry_hours <= 720 and self.poll_seconds >= 1):
            raise ValueError("a setting is out of range")


@dataclass(frozen=True)
class Ledger:
    """Where the lanes stand (seam: first live minute; live: next one; below: next backfill end), what is missing, totals, and each lane's last receipt."""

    floor: int
    seam: int
    live: int
    below: int
    missing: tuple[int, ...] = ()
    observations: int = 0
    quarantined: int = 0
    bytes: int = 0
    receipts: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def begin(floor: int, now: float, config: Config = Config()) -> Ledger:
        """The seam, fixed once: a fresh window ends at the newest minute that is due; all below is backfill."""
        seam = max(floor, newest(now, config) - FRESH + 1)
        return Ledger(floor, seam, seam, seam - 1)

    def as_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def of(values: dict) -> Ledger:
        return Ledger(**{**values, "missing": tuple(values["missing"])})


def newest(now: float, config: Config) -> int:
    """The last minute that should be there."""
    return int(now // 60) - config.lag_minutes


def oldest(now: float, config: Config) -> float:
    """Missing minutes before this one are given up."""
    return now / 60 - config.retry_hours * 60


@dataclass(frozen=True)
class Work:
    """A span of minutes for a lane; due: when it may be taken up."""

    lane: str
    first: int
    last: int
    due: float = 0.0


@dataclass(frozen=True)
class Batch:
    """Finished work: its span, what was missing in it, totals, and a digest that identifies it."""

    lane: str
    first: int
    last: int
    receipt: str
    missing: tuple[int, ...] = ()
    observations: int = 0
    quarantined: int = 0
    bytes: int = 0


def open_work(ledger: Ledger, checks: dict[int, float], now: float, config: Config = Config()) -> Iterator[Work]:
    """All work that is open: the next span of live and of backfill, and every missing minute that is not given up. checks: when a minute may be looked for again."""
    last = newest(now, config)
    if ledger.live <= last:
        yield Work("live", ledger.live, min(last, ledger.live + config.window_minutes - 1))
    if ledger.below >= ledger.floor:
        yield Work("backfill", max(ledger.floor, ledger.below - config.window_minutes + 1), ledger.below)
    for m in ledger.missing:
        if m >= oldest(now, config):
            yield Work("repair", m, m, checks.get(m, 0.0))


def next_work(ledger: Ledger, checks: dict[int, float], now: float, config: Config = Config(), *, streak: int = 0, resting: dict[str, float] | None = None, begun: dict[str, Work] | None = None) -> Work | None:
    """The first of the open work in this order, or None.

    Live comes first. Repairs come before backfill until their turn is over: a
    turn is BURST repairs in a row while fresh minutes are due, else one. Among
    repairs fresh ones come first, on every fourth of a row older ones, and then
    the longest due. Work that was begun stands for its lane's. resting: until
    when a lane that failed is left alone. streak: repairs in a row so far.
    """
    begun, resting = begun or {}, resting or {}
    rows = [*begun.values(), *(w for w in open_work(ledger, checks, now, config) if w.lane not in begun)]
    rows = [w for w in rows if w.due <= now]
    fresh = {w for w in rows if w.lane == "repair" and w.first >= int(now // 60) - FRESH}
    turn = BURST if fresh else 1
    older_first = streak % OLDER_EVERY == OLDER_EVERY - 1
    place = {"live": 0, "backfill": 2, "repair": 3 if streak >= turn else 1}
    rows = [w for w in rows if resting.get(w.lane, 0.0) <= now]
    return min(rows, key=lambda w: (place[w.lane], (w in fresh) == older_first, w.due, w.first), default=None)


class Conflict(RuntimeError):
    """A batch that does not follow from the ledger."""


_Test = Callable[[Ledger, Batch], bool]
#: What must hold of a batch, by lane, and what is said if it does not.
GUARDS: dict[str, list[tuple[str, _Test]]] = {
    "live": [("live stands elsewhere", lambda at, b: b.first == at.live)],
    "backfill": [
        ("backfill stands elsewhere", lambda at, b: b.last == at.below),
        ("the batch reaches below the floor", lambda at, b: b.first >= at.floor),
        ("the batch reaches across the seam", lambda at, b: b.last < at.seam),
    ],
    "repair": [
        ("a repair is one minute", lambda at, b: b.first == b.last),
        ("the minute is not missing", lambda at, b: b.first in at.missing),
        ("the minute is still missing", lambda at, b: not b.missing),
    ],
}
#: What a batch moves, by lane.
MOVES: dict[str, Callable[[Ledger, Batch], dict]] = {
    "live": lambda at, b: {"live": b.last + 1},
    "backfill": lambda at, b: {"below": b.first - 1},
    "repair": lambda at, b: {},
}


def enter(ledger: Ledger, batch: Batch, now: float, config: Config = Config(), kept: tuple[int, ...] = ()) -> Ledger:
    """The ledger after a batch, or the same if its lane's last batch was this very one (its answer was lost).

    A lane's batch moves that lane only. What is missing in it stays to be
    repaired for retry_hours; minutes in kept, whose repair has begun, longer.
    """
    if batch.lane not in GUARDS:
        raise Conflict(f"no such lane: {batch.lane}")
    if ledger.receipts.get(batch.lane) == batch.receipt:
        return ledger
    broken = [said for said, holds in [("the span is empty", lambda at, b: b.first <= b.last), *GUARDS[batch.lane]] if not holds(ledger, batch)]
    if broken:
        raise Conflict("; ".join(broken))
    repaired = {batch.first} if batch.lane == "repair" else set()
    missing = (set(ledger.missing) - repaired) | set(batch.missing)
    stays = lambda m: m >= oldest(now, config) or (m in kept and m in ledger.missing)
    totals = {name: getattr(ledger, name) + getattr(batch, name) for name in ("observations", "quarantined", "bytes")}
    return replace(ledger, **MOVES[batch.lane](ledger, batch), **totals, missing=tuple(sorted(filter(stays, missing))), receipts=ledger.receipts | {batch.lane: batch.receipt})


def single_cursor(at: int, missing: list[int], checks: dict[int, float], now: float, last_lane: str | None, config: Config = Config(), first: bool = False) -> Work | None:
    """The schedule of a job with one cursor: forward spans, of one minute near the newest, where they take turns with repairs."""
    last = newest(now, config)
    near = not first and at > last - 11
    repairs = [Work("repair", m, m, checks.get(m, 0.0)) for m in missing if checks.get(m, 0.0) <= now]
    if repairs and (at > last or (near and last_lane != "repair")):
        return min(repairs, key=lambda w: (w.due, w.first))
    span = 1 if near or first else config.batch_minutes
    return Work("forward", at, min(last, at + span - 1)) if at <= last else None


def fits(used: int, incoming: int, maximum_gb: float) -> bool:
    """Does a batch fit the storage, counting it twice?"""
    return used >= 0 and used + 2 * incoming < maximum_gb * 1e9


def seal(size: int, limit: int, free: int, reserve: int, end: int, last: int) -> bool:
    """Is a shard closed at this window's end: by size, by scarce space, or at the end of the range?"""
    return size >= limit or free < reserve or end >= last
