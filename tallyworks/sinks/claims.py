"""Small files in a shared folder: records written as a whole, and claims that only one job holds at a time."""

from __future__ import annotations

import contextlib
import json
import logging
import os
import threading
import time
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession

logger = logging.getLogger(__name__)

#: Seconds after which a claim that is no longer renewed may be taken over, and for which a job waits for one.
EXPIRY, WAIT = 600.0, 3600.0


class ClaimedError(RuntimeError):
    """Another job holds the claim, or has taken it over."""


class Folder:
    """A folder of small files, through the file system Spark uses."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.home = self.jvm.org.apache.hadoop.fs.Path(self.path)
        self.system = self.home.getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.system.getUri().getScheme() == "file"

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self) -> list[str]:
        if not self.system.exists(self.home):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.home) if s.isFile())

    def read(self, name: str) -> Any:
        """Content of a record; None if it is gone or not complete."""
        try:
            stream = self.system.open(self._at(name))
        except Exception as error:  # the JVM's FileNotFoundException
            if "FileNotFound" in str(error):
                return None
            raise
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def write(self, name: str, value: Any) -> None:
        """Write a record under another name and rename it, so that nobody reads half of it."""
        draft = self._at(f".{uuid.uuid4().hex}")
        self._put(draft, value)
        self.system.delete(self._at(name), False)
        if not self.system.rename(draft, self._at(name)):
            raise OSError(f"{self.path}/{name} could not be written")

    def create(self, name: str, value: Any) -> bool:
        """Create a file nobody else has created; False if somebody has. The file system decides, atomically."""
        self.system.mkdirs(self.home)
        if self.local:  # Hadoop's local file system looks first and creates then
            try:
                os.close(os.open(self._at(name).toUri().getPath(), os.O_CREAT | os.O_EXCL))
            except FileExistsError:
                return False
            self._put(self._at(name), value)
            return True
        try:
            self._put(self._at(name), value, overwrite=False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "AlreadyBeingCreated" in str(error):
                return False
            raise
        return True

    def _put(self, target, value: Any, overwrite: bool = True) -> None:
        stream = self.system.create(target, overwrite)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), False)


class Claim:
    """A held claim: number ``n`` of its folder."""

    def __init__(self, folder: Folder, n: int) -> None:
        self.folder, self.n = folder, n

    def require(self) -> None:
        """Raise if another job has taken the claim over; call before a step that must not be done twice."""
        if _latest(self.folder) != self.n:
            raise ClaimedError(f"claim {self.n} in {self.folder.path} was taken over")

    def renew(self) -> None:
        self.folder.write(f"alive-{self.n}", time.time())


def _numbers(folder: Folder, kind: str) -> list[int]:
    return [int(x.removeprefix(kind)) for x in folder.names() if x.startswith(kind)]


def _latest(folder: Folder) -> int:
    return max(_numbers(folder, "claim-"), default=0)


def _free(folder: Folder, n: int, expiry: float) -> bool:
    """Whether claim ``n`` was given back, or not renewed for too long."""
    if n == 0 or n in _numbers(folder, "done-"):
        return True
    seen = [x for x in (folder.read(f"claim-{n}"), folder.read(f"alive-{n}")) if x is not None]
    return bool(seen) and max(seen) + expiry < time.time()


@contextlib.contextmanager
def claim(spark: SparkSession, path: str, wait: float = WAIT, expiry: float = EXPIRY, pause: float = 0.2) -> Iterator[Claim]:
    """Hold the one claim of a folder; another job that asks for it waits, or raises ``ClaimedError`` after ``wait`` seconds.

    Claims are numbered, and a number is created by one job only. A claim is free once it was given back, or was not
    renewed for ``expiry`` seconds, for its job is then taken to be lost; while a job runs, a thread renews its claim.
    A job that was only slow finds out by ``require``. The clocks of the jobs must agree to well under the expiry.
    """
    folder, until = Folder(spark, path), time.time() + wait
    while True:
        n = _latest(folder)
        if _free(folder, n, expiry) and folder.create(f"claim-{n + 1}", time.time()):
            break
        if time.time() > until:
            raise ClaimedError(f"claim {n} in {path} is held by another job")
        time.sleep(pause)
    held, over = Claim(folder, n + 1), threading.Event()

    def renew() -> None:
        while not over.wait(expiry / 4):
            held.renew()

    threading.Thread(target=renew, daemon=True).start()
    try:
        yield held
    finally:
        over.set()
        folder.create(f"done-{n + 1}", time.time())
        for kind in ("claim-", "alive-", "done-"):
            for old in _numbers(folder, kind):
                if old < n + 1:
                    folder.delete(f"{kind}{old}")
