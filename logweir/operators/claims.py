"""Claims: of all runs that want a piece of work, one gets it.

A claim is a file of the claimant's own in the work's folder, written first; then the folder is listed. Whoever sees
another live claim withdraws and tries again after a random while, or gives up. Of two claimants the one that lists
second sees the other's file, so both can't go on, on any store whose listings show what was written before: no atomic
create-if-absent is needed. A claim's name tells when it ends, so that the claim of a stopped run holds nobody up for
longer; clocks may differ by less than the time for which claims hold.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from logweir.sources import files

HOLD_SECONDS = 6 * 3600
ATTEMPTS = 6


@dataclass(frozen=True)
class Claim:
    spark: SparkSession
    path: str

    def release(self) -> None:
        files.remove(self.spark, self.path)


def _ends(path: str) -> int:
    """When a claim ends, in milliseconds since 1970."""
    return int(path.rsplit("/", 1)[1].split("-", 1)[0])


def live(spark: SparkSession, folder: str, now: float) -> list[str]:
    """The claims on a piece of work that hold at ``now``; ended ones are removed."""
    found = files.glob(spark, f"{folder}/[0-9]*-*")
    for path in found:
        if _ends(path) <= now * 1000:
            files.remove(spark, path)
    return [path for path in found if _ends(path) > now * 1000]


def take(spark: SparkSession, folder: str, hold_seconds: float = HOLD_SECONDS, attempts: int = ATTEMPTS,
         clock: Callable[[], float] = time.time) -> Claim | None:
    """A claim on the work that ``folder`` stands for, or None where another one holds."""
    for attempt in range(attempts):
        if attempt == 0 and live(spark, folder, clock()):
            return None
        name = f"{int((clock() + hold_seconds) * 1000):015d}-{uuid.uuid4().hex}"
        files.touch(spark, f"{folder}/{name}")
        others = [path for path in live(spark, folder, clock()) if not path.endswith(name)]
        if not others:
            return Claim(spark, f"{folder}/{name}")
        files.remove(spark, f"{folder}/{name}")
        time.sleep(random.uniform(0.02, 0.1) * 2**attempt)
    return None
