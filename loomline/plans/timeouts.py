"""Time limits and progress of actions; both live on the driver."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

T = TypeVar("T")


class TimeLimitExceeded(TimeoutError):
    pass


def within(spark: SparkSession, seconds: float, action: Callable[[], T]) -> T:
    """The action's result, or TimeLimitExceeded; the jobs it started are cancelled then."""
    context, tag, late = spark.sparkContext, f"limit-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        return action()
    except Exception as e:
        if late.is_set():
            raise TimeLimitExceeded(f"took more than {seconds} s") from e
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


class Progress(StreamingQueryListener):
    """Rows and batches a stream has done so far."""

    def __init__(self) -> None:
        self.rows, self.batches, self.running = 0, 0, False

    def onQueryStarted(self, event) -> None:  # type: ignore[no-untyped-def]  # noqa: N802
        self.running = True

    def onQueryProgress(self, event) -> None:  # type: ignore[no-untyped-def]  # noqa: N802
        self.rows += event.progress.numInputRows
        self.batches += 1

    def onQueryIdle(self, event) -> None:  # type: ignore[no-untyped-def]  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # type: ignore[no-untyped-def]  # noqa: N802
        self.running = False
