"""Work on many items at once, each with its own Spark job tag, scheduler pool and deadline.

Each item runs in a thread of its own, under a tag that all its jobs carry.
An item that is not done by its deadline has its jobs cancelled by that tag
and gives ``late(item)`` in place of a result. Work that hangs outside
Spark cannot be stopped from outside: its thread is left behind (a daemon)
after ``grace`` seconds, its jobs are cancelled for as long as the run lasts and
whatever it returns is dropped, so the other items end.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, wait
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.utils import is_remote
from pyspark.util import InheritableThread

TICK = 0.5  # seconds between looks at the deadlines, once one is near


def by_size(column: str = "bytes", large: int = 1 << 40, names: tuple[str, str] = ("small", "large")) -> Callable[[dict], str]:
    """The pool of an item by a size that its row states; rows without one are small."""
    return lambda row: names[int((row.get(column) or 0) >= large)]


@dataclass(eq=False)
class _Running:
    item: dict
    tag: str
    started: float
    result: Future = field(default_factory=Future)
    cancelled: bool = False


def _tag(spark: SparkSession, tag: str) -> None:
    """Put ``tag`` on the jobs that this thread starts."""
    spark.addTag(tag) if is_remote() else spark.sparkContext.addJobTag(tag)


def _cancel(spark: SparkSession, tag: str) -> None:
    """Cancel the running jobs that carry ``tag``."""
    spark.interruptTag(tag) if is_remote() else spark.sparkContext.cancelJobsWithTag(tag)


def _start(spark: SparkSession, item, work: Callable, pool: str | None) -> _Running:
    r = _Running(item, f"concord-{uuid.uuid4().hex}", time.monotonic())

    def run():
        try:
            _tag(spark, r.tag)
            if pool is not None and not is_remote():
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            r.result.set_result(work(item))
        except BaseException as e:  # noqa: BLE001 - handed to whoever asks for the result
            r.result.set_exception(e)

    thread = InheritableThread(target=run, session=spark)
    thread.daemon = True
    thread.start()
    return r


def supervise(
    spark: SparkSession,
    items: Iterable,
    work: Callable,
    late: Callable,
    *,
    width: int = 4,
    deadline: float | None = None,
    grace: float = 30.0,
    pool_of: Callable | None = None,
) -> Iterator:
    """Results of ``work(item)`` as they end, ``late(item)`` for items past ``deadline`` seconds; ``width`` at a time.

    ``work`` should not raise: an exception of it ends the run. Items are
    taken one by one, as threads become free. ``pool_of(item)`` names the
    scheduler pool (of a FAIR scheduler) that the item's jobs run in.
    """
    waiting, running, left_behind = iter(items), [], []
    more = True
    try:
        while more or running:
            while more and len(running) < max(1, width):
                try:
                    item = next(waiting)
                except StopIteration:
                    more = False
                    break
                running.append(_start(spark, item, work, pool_of(item) if pool_of else None))
            if not running:
                break
            wait([r.result for r in running], None if deadline is None else TICK, FIRST_COMPLETED)
            for tag in left_behind:
                _cancel(spark, tag)
            now, still = time.monotonic(), []
            for r in running:
                if r.result.done():
                    yield late(r.item) if r.cancelled else r.result.result()
                    continue
                if deadline is not None and now - r.started > deadline:
                    r.cancelled = True
                    _cancel(spark, r.tag)
                    if now - r.started > deadline + grace:
                        left_behind.append(r.tag)
                        yield late(r.item)
                        continue
                still.append(r)
            running = still
    finally:
        for r in running:  # the caller has stopped: nothing goes on behind it
            if not r.result.done():
                _cancel(spark, r.tag)
