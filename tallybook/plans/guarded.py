"""Several pieces of work at a time, whose Spark jobs can be ended.

The jobs of each piece carry a tag of their own. While a piece is to be ended its tag is cancelled
again and again, as work that is between two jobs would only start the next one.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

POLL_SECONDS = 0.2


class Ended(Exception):
    """The work was ended from outside: over its time limit, or because other work failed."""


class _Piece:
    def __init__(self, name: str):
        self.name = name
        self.tag = f"tallybook-{uuid.uuid4().hex}"
        self.started: float | None = None
        self.done = False
        self.reason: str | None = None
        self.error: Exception | None = None


def run_guarded[Result](
    spark: SparkSession,
    work: Iterable[tuple[str, Callable[[], Result]]],
    workers: int,
    time_limit: float | None = None,
    fail_fast: bool = False,
) -> list[Result | Exception]:
    """The results of all pieces in their order, or what each failed with, at most ``workers`` at a time.

    ``time_limit`` is the seconds that a piece may take from its own start; one that takes longer is
    ended and gives ``Ended``. With ``fail_fast`` the first failure ends all that run, lets none start any
    more, and is raised when they have stopped, with a note on each of the others that failed.
    """
    context = spark.sparkContext
    items = [(_Piece(name), task) for name, task in work]
    first: list[_Piece] = []
    lock, over = threading.Lock(), threading.Event()

    def run(item: tuple[_Piece, Callable[[], Result]]) -> Result | Exception:
        piece, task = item
        with lock:
            if fail_fast and first:
                piece.error = Ended(f"not started, as {first[0].name} failed")
                return piece.error
            piece.started = time.monotonic()
        context.addJobTag(piece.tag)
        try:
            return task()
        except Exception as error:
            with lock:
                piece.error = Ended(piece.reason) if piece.reason else error
                if not piece.reason or not first:
                    first.append(piece)
            return piece.error
        finally:
            piece.done = True
            context.removeJobTag(piece.tag)

    def end_what_must() -> None:
        while not over.wait(POLL_SECONDS):
            now = time.monotonic()
            for piece, _ in items:
                if piece.started is None or piece.done:
                    continue
                with lock:
                    if time_limit is not None and now - piece.started > time_limit:
                        piece.reason = piece.reason or f"over the time limit of {time_limit:g} seconds"
                    elif fail_fast and first:
                        piece.reason = piece.reason or f"ended, as {first[0].name} failed"
                if piece.reason:
                    context.cancelJobsWithTag(piece.tag)

    watcher = threading.Thread(target=end_what_must, daemon=True)
    if time_limit is not None or fail_fast:
        watcher.start()
    try:
        with ThreadPoolExecutor(max_workers=workers) as pool:
            results = list(pool.map(run, items))
    finally:
        over.set()
    if fail_fast and first:
        error = first[0].error
        for piece, _ in items:
            if piece.error is not None and piece is not first[0]:
                error.add_note(f"{piece.name}: {type(piece.error).__name__}: {piece.error}")
        raise error
    return results
