"""Wall-clock phase timing of a job (T11). Transformations are lazy and cost
almost nothing; the time shows up in the phase that runs an action."""

from __future__ import annotations

import io
import time
from contextlib import contextmanager, redirect_stdout


class Phases:
    def __init__(self) -> None:
        self.timings: dict[str, float] = {}
        self._t0 = time.perf_counter()

    @contextmanager
    def phase(self, name: str):
        t = time.perf_counter()
        try:
            yield
        finally:
            self.timings[name] = round(time.perf_counter() - t, 4)

    def total(self) -> float:
        return round(time.perf_counter() - self._t0, 4)


def run_action(df) -> None:
    """Execute a whole plan without collecting it (the ``noop`` sink)."""
    df.write.format("noop").mode("overwrite").save()


def explain_text(df, mode: str = "formatted") -> str:
    """The plan as text (C6): what ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
