"""Operators with a state of their own per key: a gate for each host, and reports' answers until all are there.

They run in a session with RocksDB as its state store, which state_session() gives; state survives restarts from the
checkpoint. Times are event times in milliseconds, so a replay gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application for streams with state; partitions are those of the state."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        if (value := spark.conf.get(key, None)) is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    if partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


class HostGate(StatefulProcessor):
    """One request in flight per host, each started no sooner than gap after the one before it has ended.

    Requests that can't start yet wait in a map by their turn, of which only the head is touched; a timer for when the
    host is free again lets them go.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # head and tail of the queue; when the host is free; whether a timer is set.
        self.mark = handle.getValueState("mark", "head long, tail long, free_at long, timer boolean")
        self.waiting = handle.getMapState("waiting", "turn long", "request long, arrival long, lasts long")

    def _serve(self, host: str, mark: list, watermark: int, rows: list) -> Iterator[Row]:
        """Rows of this batch go to the tail; the head starts if the host is idle when it comes, or by the watermark."""
        head, tail, free_at, _ = mark
        for row in rows:
            self.waiting.updateValue((tail,), row)
            tail += 1
        while head < tail:
            request, arrival, lasts = self.waiting.getValue((head,))
            if free_at > max(arrival, watermark):
                break
            start = max(arrival, free_at)
            yield Row(host=host, request=request, start=start, end=start + lasts)
            self.waiting.removeKey((head,))
            head, free_at = head + 1, start + lasts + self.gap
        self.mark.update((head, tail, free_at, head < tail))
        if head < tail:
            self.handle.registerTimer(free_at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = sorted((r.arrival, r.request, r.lasts) for r in rows)
        mark = list(self.mark.get()) if self.mark.exists() else [0, 0, 0, False]
        if mark[3]:
            self.handle.deleteTimer(mark[2])
        yield from self._serve(key[0], mark, timerValues.getCurrentWatermarkInMs(), [(request, arrival, lasts) for arrival, request, lasts in came])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._serve(key[0], list(self.mark.get()), timerValues.getCurrentWatermarkInMs(), [])

    def close(self) -> None:
        pass


def host_starts(requests: DataFrame, gap: float, delay: str = "1 minute") -> DataFrame:
    """host, request, start, end (milliseconds) of a stream of requests(host, request long, at timestamp, lasts double).

    Requests of a host take their turns as they arrive, by at and request within a micro-batch. One that has to wait
    is given out once the watermark has reached its start. Rows without host or at are left out, as is what comes more
    than delay behind the latest row of an earlier micro-batch.
    """
    rows = requests.where("host is not null and at is not null").withWatermark("at", delay)
    rows = rows.select("host", "request", F.unix_millis("at").alias("arrival"), F.round(F.col("lasts") * 1000).cast("long").alias("lasts"), "at")
    return rows.groupBy("host").transformWithState(HostGate(round(gap * 1000)), "host string, request long, start long, end long", "append", "EventTime")


GATHERED = ["stem", "chunk_no", "raw", "error"]


class Gather(StatefulProcessor):
    """Reports' answers, each report's held until as many chunks have answered as it has, and given out together, once.

    A chunk's first answer counts. A report that is not whole when its time is up fails, and what it has is dropped; until
    then answers that come after it was given out are known as late and left out.

    A key is a lot of reports, whose rows come as frames and whose state is read and written as one value: a call of the
    state for each report, or an object for each row, takes longer than what is done with its answers.
    """

    def __init__(self, timeout: int):
        self.timeout = timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the reports of a lot; its timer, set to when the first of them is up.
        self.held = handle.getValueState("held", "reports array<struct<stem:string,of:int,done:boolean,until:long,answers:array<struct<no:int,raw:string,error:string>>>>, timer long")

    def _load(self) -> tuple[dict, int | None]:
        """stem: [of, done, until, {no: (raw, error)}]"""
        reports, timer = self.held.get() or ([], None)
        return {stem: [of, done, until, {no: (raw, error) for no, raw, error in answers}] for stem, of, done, until, answers in reports}, timer

    def _keep(self, reports: dict, timer: int | None) -> None:
        first = min((r[2] for r in reports.values()), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if reports:
            self.held.update(([(stem, of, done, until, [(no, *a) for no, a in answers.items()]) for stem, (of, done, until, answers) in reports.items()], first))
        else:
            self.held.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reports, timer = self._load()
        came: dict[str, list] = {}
        for b in rows:
            for stem, *answer in zip(*(b[c].tolist() for c in ("stem", "chunk_no", "chunks", "raw", "error", "answered_at")), strict=True):
                came.setdefault(stem, []).append(answer)
        whole = []
        for stem, answers in came.items():
            answers.sort(key=lambda a: a[0])
            if stem not in reports:
                reports[stem] = [answers[0][1], False, max(min(a[4] for a in answers), timerValues.getCurrentWatermarkInMs()) + self.timeout, {}]
            of, done, until, have = reports[stem]
            if done:
                continue
            for no, _, raw, error, _ in answers:
                have.setdefault(no, (raw, error))
            if len(have) >= of:
                whole += [(stem, no, raw, error) for no, (raw, error) in have.items()]
                reports[stem] = [of, True, until, {}]
        self._keep(reports, timer)
        if whole:
            yield pd.DataFrame(whole, columns=GATHERED)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reports, timer = self._load()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        up = {stem: r for stem, r in reports.items() if r[2] <= now}
        # The timer that fired is gone.
        self._keep({stem: r for stem, r in reports.items() if stem not in up}, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)
        failed = [(stem, None, None, f"timed out: {len(answers)} of {of} chunks answered") for stem, (of, done, _, answers) in up.items() if not done]
        if failed:
            yield pd.DataFrame(failed, columns=GATHERED)

    def close(self) -> None:
        pass


def gathered(answers: DataFrame, timeout: float, delay: str = "1 minute", lots: int = 4096) -> DataFrame:
    """stem, chunk_no, raw, error of a stream of answers(stem, chunk_no, chunks, raw, error, answered_at timestamp).

    All answers of a report come in the micro-batch in which its last one does; a report whose answers are not there
    within so many seconds of event time is one row with an error. Reports are dealt into lots by a hash; a task holds one
    at a time, so lots should grow with the reports. A checkpoint goes on with as many lots as it began with.
    """
    rows = answers.where("stem is not null and answered_at is not null").withWatermark("answered_at", delay)
    lot = F.pmod(F.xxhash64("stem"), F.lit(lots)).cast("int").alias("lot")
    rows = rows.select(lot, "stem", "chunk_no", "chunks", "raw", "error", F.unix_millis("answered_at").alias("answered_at"), F.col("answered_at").alias("__at"))
    return rows.groupBy("lot").transformWithStateInPandas(Gather(round(timeout * 1000)), "stem string, chunk_no int, raw string, error string", "append", "EventTime")
