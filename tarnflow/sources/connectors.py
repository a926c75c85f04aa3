"""Connectors to archives: one interface, a client over recorded answers, and request plans as tables.

No network is used here. A live client only has to implement ``SourceClient``; batching, retries, routing and
parsing are the same for both.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tarnflow.functions.text import with_retries

BATCHES = {"summary": 500, "search": 200}


class SourceClient(Protocol):
    """What the engine asks of an archive."""

    def fetch(self, kind: str, ids: list[str]) -> str:
        """The answer's text to a request of a kind for some ids."""


class RecordedClient:
    """Answers from a folder: ``kind.json`` maps an id to its part of the answer. Missing ids add nothing."""

    def __init__(self, folder: str):
        self.folder = folder

    def fetch(self, kind: str, ids: list[str]) -> str:
        known = json.loads(Path(self.folder, f"{kind}.json").read_text())
        return "\n".join(known[i] for i in ids if i in known)


class FailingClient:
    """Fails so many times before each answer, for tests of retries."""

    def __init__(self, inner: SourceClient, failures: int):
        self.inner, self.failures, self.calls = inner, failures, 0

    def fetch(self, kind: str, ids: list[str]) -> str:
        self.calls += 1
        if self.calls <= self.failures:
            raise ConnectionError("no answer")
        return self.inner.fetch(kind, ids)


def batched(ids: DataFrame, size: int, key: str = "id", order: str = "ord") -> DataFrame:
    """Requests of up to ``size`` ids: ``batch``, ``ids`` and the joined ``query``. Ids are spread by range, so that
    numbering has no single task."""
    from tarnflow.operators.metadata import numbered

    rows = numbered(ids, order).withColumn("batch", F.floor((F.col("pos") - 1) / size))
    grouped = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("pos", key))).alias("x"))  # ``size`` ids at most
    listed = F.transform("x", lambda r: r[key])
    return grouped.select("batch", listed.alias("ids"), F.array_join(listed, " OR ").alias("query"))


def fetched(requests: DataFrame, client: SourceClient, kind: str, attempts: int = 5, pause: float = 0.0) -> DataFrame:
    """``batch`` and ``value``, the answers' text; failures are tried again with growing pauses, then the task fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = [with_retries(lambda i=i: client.fetch(kind, i), attempts, first=pause) for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("batch"), pa.array(texts, pa.string())], ["batch", "value"])

    return requests.select("batch", "ids").mapInArrow(run, "batch long, value string")


def download_plan(runs: DataFrame) -> DataFrame:
    """The archive that each run is fetched from; a failed run is tried again at its own archive."""
    rule = F.when(F.col("run").startswith("CRR"), "cncb").when(F.col("run").rlike("^[SED]RR"), "ena").otherwise("unknown")
    return runs.withColumn("archive", rule)


def accession_folders(runs: DataFrame) -> DataFrame:
    """Numbered run with its submission: the pairs that a checksum list is asked for."""
    return runs.withColumn("rank", F.row_number().over(Window.partitionBy("submission").orderBy("run")))
