"""Fetching minute files over HTTP into the raw store, with retries, cool-down and verification."""

from __future__ import annotations

import email.utils
import gzip
import hashlib
import json
import os
import shutil
import threading
import time
import urllib.error
import urllib.request
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from pathlib import Path

from fragloom.settings import CollectSettings, Settings

#: Longest cool-down that is waited for, in seconds.
LONGEST_WAIT = 300
RESERVE = 64 << 20


class Refused(RuntimeError):
    """A status that no retry helps, or a cool-down that is too long."""


@dataclass(frozen=True)
class Raw:
    """A stored source file."""

    source: str
    path: str
    bytes: int
    sha256: str


def retry_after(value: str | None, now: float | None = None) -> float | None:
    """Seconds of a Retry-After header: a number or an HTTP date; None if it is neither."""
    if not value:
        return None
    if value.strip().isdigit():
        return float(value)
    try:
        return max(0.0, email.utils.parsedate_to_datetime(value).timestamp() - (time.time() if now is None else now))
    except (TypeError, ValueError):
        return None


class CoolDown:
    """A pause that all workers share: the latest end that any of them was told."""

    def __init__(self) -> None:
        self._until, self._lock = 0.0, threading.Lock()

    def extend(self, seconds: float) -> None:
        if seconds > LONGEST_WAIT:
            raise Refused(f"asked to wait {seconds:.0f} s; retry the collection later")
        with self._lock:
            self._until = max(self._until, time.monotonic() + seconds)

    def wait(self) -> None:
        while (left := self._until - time.monotonic()) > 0:
            time.sleep(left)


def sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def raw_name(minute: str) -> str:
    return f"{minute[:4]}/{minute[4:6]}/{minute[6:8]}/{minute}.ngrams.json.gz"


def whole_gzip(path: Path, limit: int) -> bool:
    """Does every member of the file decode, within the limit of expanded bytes?"""
    total = 0
    try:
        with gzip.open(path) as f:
            while block := f.read(1 << 20):
                total += len(block)
                if total > limit:
                    return False
    except (OSError, EOFError):
        return False
    return True


class Fetcher:
    """Fetches minutes into a root folder; what is there and verified is not fetched again."""

    def __init__(self, root: str, base_url: str, settings: CollectSettings = CollectSettings(), run: Settings = Settings(), sleep=time.sleep) -> None:
        self.root, self.base, self.settings, self.run, self.sleep = Path(root), base_url.rstrip("/"), settings, run, sleep
        self.cool_down = CoolDown()

    def _known(self, url: str, path: Path) -> Raw | None:
        """The stored file, if its record holds; else it is set aside under its digest."""
        side = path.with_name(path.name + ".raw.json")
        if not path.exists():
            return None
        found = Raw(url, str(path.relative_to(self.root)), path.stat().st_size, sha256(path))
        try:
            if json.loads(side.read_text()) == asdict(found):
                return found
        except (OSError, ValueError):
            pass
        path.rename(path.with_name(f"{path.name}.unverified-{found.sha256}"))
        return None

    def fetch(self, minute: str) -> Raw | None:
        """The minute's stored file; None if the source has none."""
        url, path = f"{self.base}/{minute}.ngrams.json.gz", self.root / raw_name(minute)
        if known := self._known(url, path):
            return known
        path.parent.mkdir(parents=True, exist_ok=True)
        if shutil.disk_usage(path.parent).free < (self.settings.min_free_gib << 30) + RESERVE:
            raise Refused("too little free space")
        error = ""
        for attempt in range(self.settings.attempts):
            self.cool_down.wait()
            try:
                with urllib.request.urlopen(url, timeout=45) as reply:
                    return self._store(url, path, reply)
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return None
                if e.code not in (408, 429) and e.code < 500:
                    raise Refused(f"{url}: status {e.code}") from e
                if e.code in (429, 503):
                    told = retry_after(e.headers.get("Retry-After"))
                    self.cool_down.extend(2.0**attempt if told is None else told)
                error = f"status {e.code}"
            except (OSError, ValueError) as e:
                error = str(e)
            if attempt + 1 < self.settings.attempts:
                self.sleep(0.25 * 2**attempt)
        raise RuntimeError(f"{url}: failed after {self.settings.attempts} attempts: {error}")

    def _store(self, url: str, path: Path, reply) -> Raw:
        part, limit, size = path.with_name(path.name + ".part"), self.settings.max_download_mib << 20, 0
        with part.open("wb") as f:
            while block := reply.read(1 << 16):
                size += len(block)
                if size > limit:
                    raise Refused(f"{url} is larger than {limit} bytes")
                f.write(block)
            f.flush()
            os.fsync(f.fileno())
        if not whole_gzip(part, self.run.max_expanded_mib << 20):
            raise ValueError(f"{url} is no whole gzip file")
        part.replace(path)
        raw = Raw(url, str(path.relative_to(self.root)), size, sha256(path))
        path.with_name(path.name + ".raw.json").write_text(json.dumps(asdict(raw)))
        return raw

    def collect(self, minutes: list[str]) -> list[dict]:
        """minute, status (available, missing, failed), raw, error of each; a failure stops no other minute."""

        def one(minute: str) -> dict:
            try:
                raw = self.fetch(minute)
                return {"minute": minute, "status": "available" if raw else "missing", "raw": raw and asdict(raw), "error": None}
            except (RuntimeError, OSError) as e:
                return {"minute": minute, "status": "failed", "raw": None, "error": str(e)}

        with ThreadPoolExecutor(self.settings.downloads) as pool:
            return list(pool.map(one, minutes))


def import_file(root: str, file: str, settings: CollectSettings = CollectSettings()) -> Raw:
    """A copy of a local file in the raw store, under its digest; repeated imports give the same path."""
    source = Path(file)
    if source.stat().st_size > settings.max_download_mib << 20:
        raise Refused(f"{file} is too large")
    digest = sha256(source)
    target = Path(root) / "imported" / (digest + "".join(source.suffixes[-2:]))
    target.parent.mkdir(parents=True, exist_ok=True)
    if shutil.disk_usage(target.parent).free < source.stat().st_size + RESERVE:
        raise Refused("too little free space")
    if not target.exists() or sha256(target) != digest:
        part = target.with_name(target.name + ".part")
        shutil.copyfile(source, part)
        part.replace(target)
    raw = Raw(str(source), str(target.relative_to(root)), target.stat().st_size, digest)
    target.with_name(target.name + ".raw.json").write_text(json.dumps(asdict(raw)))
    return raw
