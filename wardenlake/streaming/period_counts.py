"""Counts per period that micro-batches add to, in a number of files that grows with the logarithm of the batches.

A batch writes its counts to a folder of its own, a run. A manifest lists the runs that count, each with the batches it
holds; the next manifest is put in place only if no other writer has done so. As soon as enough runs of one level stand
together, the same commit replaces them by their sum, a run of the next level. A batch that a run already holds is a replay
and adds nothing. A crash leaves at most a folder that no manifest names, or files that the next commit clears away.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardenlake.sources.commit_log import put_if_absent

MANIFESTS, RUNS = "_manifests", "runs"
FAN_IN = 10
PERIOD = ("window_start", "window_end")
SUMS = ("total_transactions", "total_flagged_frauds")
SCHEMA = "window_start timestamp, window_end timestamp, total_transactions long, total_flagged_frauds long"


@dataclass(frozen=True)
class Run:
    first: int  # the batches it holds
    last: int
    level: int
    folder: str


def to_merge(runs: list[Run], fan_in: int) -> list[Run]:
    """The runs at the end of the list to put together: `fan_in` of one level, or none."""
    tail = runs[-fan_in:]
    return tail if len(tail) == fan_in and len({r.level for r in tail}) == 1 else []


class PeriodCounts:
    def __init__(self, spark: SparkSession, path: str, fan_in: int = FAN_IN):
        self.spark, self.path, self.fan_in = spark, path.rstrip("/"), fan_in

    def _place(self, *parts: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _numbers(self) -> list[int]:
        fs, place = self._place(MANIFESTS)
        if not fs.exists(place):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> list[Run]:
        fs, place = self._place(MANIFESTS, f"{number:020d}.json")
        stream = fs.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Run(**r) for r in json.loads(text)]

    def runs(self) -> tuple[int, list[Run]]:
        """The number of the current manifest, 0 if there is none, and its runs by batch."""
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, [])

    def _write(self, counts: DataFrame) -> str:
        folder = f"r-{uuid.uuid4().hex}"
        counts.select(*PERIOD, *SUMS).write.parquet(f"{self.path}/{RUNS}/{folder}")
        return folder

    def _read(self, runs: list[Run]) -> DataFrame:
        rows = self.spark.read.parquet(*[f"{self.path}/{RUNS}/{r.folder}" for r in runs])
        return rows.groupBy(*PERIOD).agg(*[F.sum(c).alias(c) for c in SUMS])

    def add(self, counts: DataFrame, batch_id: int) -> bool:
        """Add the counts of a batch. False if they are there already."""
        written = None
        while True:
            number, runs = self.runs()
            if any(r.first <= batch_id <= r.last for r in runs):
                return False
            written = written or Run(batch_id, batch_id, 0, self._write(counts))
            runs = sorted([*runs, written], key=lambda r: r.first)
            while merged := to_merge(runs, self.fan_in):
                whole = Run(merged[0].first, merged[-1].last, merged[0].level + 1, self._write(self._read(merged)))
                runs = [*runs[: -len(merged)], whole]
            text = json.dumps([asdict(r) for r in runs])
            if put_if_absent(self.spark, f"{self.path}/{MANIFESTS}", f"{number + 1:020d}.json", text):
                self._clear(number + 1, runs)
                return True

    def _clear(self, number: int, runs: list[Run]) -> None:
        """Drop what only manifests before the previous one name: whoever reads by the previous one goes on."""
        numbers = [n for n in self._numbers() if n < number]
        kept = {r.folder for r in runs} | {r.folder for n in numbers[-1:] for r in self._manifest(n)}
        for old in numbers[:-1]:
            for run in self._manifest(old):
                if run.folder not in kept:
                    fs, place = self._place(RUNS, run.folder)
                    fs.delete(place, True)
            fs, place = self._place(MANIFESTS, f"{old:020d}.json")
            fs.delete(place, False)

    def read(self) -> DataFrame:
        """The sums per period of all batches, each counted once."""
        _, runs = self.runs()
        return self._read(runs) if runs else self.spark.createDataFrame([], SCHEMA)
