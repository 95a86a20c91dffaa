"""Calls to an outside service from Spark tasks.

A task answers its Arrow batches in an event loop: many requests are in flight at
once, up to a bound, a failing row is tried again after growing pauses, and a rate
budget for the whole job is dealt evenly to the tasks that can run at once.  Rows
keep their order; a row that keeps failing is recorded with its error, so a later
attempt needs the rows that are not ``ok`` only.
"""

from __future__ import annotations

import asyncio
from collections.abc import Awaitable, Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Service:
    """``call(text, target)`` is a coroutine function that workers can import or unpickle."""

    name: str
    call: Callable[[str, str], Awaitable[str]]
    in_flight: int = 16
    tries: int = 3
    pause: float = 0.1
    timeout: float = 60.0
    #: Calls a second of the whole job, retries included; None: no bound.
    rate: float | None = None


class _Pace:
    """Lets a task begin at most ``rate`` calls a second."""

    def __init__(self, rate: float | None):
        self.gap, self.due = (1 / rate if rate else 0.0), 0.0

    async def turn(self) -> None:
        if self.gap:
            now = asyncio.get_running_loop().time()
            at, self.due = max(now, self.due), max(now, self.due) + self.gap
            await asyncio.sleep(at - now)


async def _answer(service: Service, slots: asyncio.Semaphore, pace: _Pace, text: str, target: str) -> tuple[str | None, str, str | None, int]:
    error = None
    for k in range(service.tries):
        if k:
            await asyncio.sleep(service.pause * 2 ** (k - 1))  # outside the slot: a pause holds up nobody
        async with slots:
            await pace.turn()
            try:
                return await asyncio.wait_for(service.call(text, target), service.timeout), "ok", None, k + 1
            except Exception as ex:  # noqa: BLE001 - the failure is recorded with its row
                error = f"{type(ex).__name__}: {ex}"
    return None, "error", error, service.tries


async def _answers(service: Service, pace: _Pace, texts: list[str], targets: list[str]) -> list[tuple]:
    slots = asyncio.Semaphore(service.in_flight)
    return await asyncio.gather(*[_answer(service, slots, pace, x, t) for x, t in zip(texts, targets, strict=True)])


def call_service(df: DataFrame, key: str, text_col: str, service: Service, target: str = "ary_Arab", target_col: str | None = None) -> DataFrame:
    """(key, [target], model, hyp, status, error, n_calls) of every row, null texts as empty ones.

    ``rate`` is divided by the tasks that can run at once, or by the partitions if
    there are fewer.  An event loop lives as long as its batch.
    """
    cols = [key] + ([target_col] if target_col else [])
    rows = df.select(*cols, F.col(text_col).alias("__text"))
    at_once = max(1, df.sparkSession.sparkContext.defaultParallelism)
    if service.rate:
        at_once = max(1, min(at_once, rows.rdd.getNumPartitions()))
    share = service.rate / at_once if service.rate else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = _Pace(share)
        for batch in batches:
            targets = batch[target_col].tolist() if target_col else [target] * len(batch)
            texts = ["" if x is None else x for x in batch["__text"]]
            found = asyncio.run(_answers(service, pace, texts, targets)) if texts else []
            hyp, status, error, calls = zip(*found, strict=True) if found else ((), (), (), ())
            yield batch[cols].assign(model=service.name, hyp=list(hyp), status=list(status), error=list(error), n_calls=list(calls))

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in cols]
    return rows.mapInPandas(run, ", ".join([*kinds, "model string", "hyp string", "status string", "error string", "n_calls int"]))
