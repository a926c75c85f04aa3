"""Request plans for the archives: searches, links, summaries and fetches as tables, over any client.

A request is a row, an answer a column beside it. What fails for good leaves the reason in ``error``, so that one project
never stops the others. No network is used here; a live client only has to implement ``ArchiveClient``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tarnflow.functions.text import with_retries

#: Ids of one fetch, and of one link.
FETCH, LINK = 500, 200


class ArchiveClient(Protocol):
    def search(self, db: str, term: str) -> list[str]:
        """Ids of the records that a term finds, best first."""

    def link(self, source: str, target: str, ids: list[str]) -> list[str]:
        """Ids in ``target`` that belong to the ids in ``source``."""

    def summary(self, db: str, uid: str) -> str:
        """The accession that an id belongs to."""

    def fetch(self, db: str, form: str, ids: list[str]) -> str:
        """The text of the records in a form."""


class RecordedArchive:
    """Answers from the JSON files ``search``, ``link``, ``summary`` and ``fetch`` of a folder. A recorded ``!text`` is a failure."""

    def __init__(self, folder: str):
        self.folder = folder
        self.held: dict[str, dict] = {}

    def _known(self, kind: str, key: str):
        if kind not in self.held:
            path = Path(self.folder, f"{kind}.json")
            self.held[kind] = json.loads(path.read_text()) if path.exists() else {}
        found = self.held[kind].get(key)
        if isinstance(found, str) and found.startswith("!"):
            raise ConnectionError(found[1:])
        return found

    def search(self, db: str, term: str) -> list[str]:
        return self._known("search", f"{db} {term}") or []

    def link(self, source: str, target: str, ids: list[str]) -> list[str]:
        return list(dict.fromkeys(x for i in ids for x in self._known("link", f"{source} {target} {i}") or []))

    def summary(self, db: str, uid: str) -> str:
        return self._known("summary", f"{db} {uid}") or ""

    def fetch(self, db: str, form: str, ids: list[str]) -> str:
        return "\n".join(x for i in ids if (x := self._known("fetch", f"{db} {form} {i}")) is not None)


def answered(requests: DataFrame, ask: Callable, arguments: list[str], name: str, kind: T.DataType, attempts: int = 3, pause: float = 0.0) -> DataFrame:
    """``requests`` with the answer ``name`` and ``error``; ``ask`` gets the values of the ``arguments`` of one row.

    A failed call is tried again with growing pauses. Requests of one partition follow each other, so the number of
    partitions bounds how many run at once.
    """
    schema = T.StructType([*requests.schema, T.StructField(name, kind), T.StructField("error", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, errors = [], []
            for row in zip(*(batch.column(a).to_pylist() for a in arguments), strict=True):
                try:
                    made.append(with_retries(lambda row=row: ask(*row), attempts, first=pause))
                    errors.append(None)
                except (OSError, ValueError, TimeoutError) as e:
                    made.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            columns = [*batch.columns, pa.array(made, arrow.field(name).type), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return requests.mapInArrow(run, schema)


def searched(requests: DataFrame, client: ArchiveClient, db: str, term: str = "term") -> DataFrame:
    """``requests`` with the ``uids`` that their term finds."""
    return answered(requests, lambda t: client.search(db, t), [term], "uids", T.ArrayType(T.StringType()))


def in_batches(found: DataFrame, group: str, size: int, uids: str = "uids") -> DataFrame:
    """``group``, ``batch`` and up to ``size`` ``ids`` of each group's list, in its order."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(uids) - 1) / size).cast("int")), lambda b: F.struct(b.alias("batch"), F.slice(uids, b * size + 1, F.lit(size)).alias("ids")))
    return found.where(F.size(uids) > 0).select(group, F.explode(parts).alias("p")).select(group, "p.batch", "p.ids")


def linked(found: DataFrame, client: ArchiveClient, source: str, target: str, group: str) -> DataFrame:
    """``group``, the ``uids`` that a group's ids lead to, each once, and ``error``."""
    asked = answered(in_batches(found, group, LINK), lambda ids: client.link(source, target, ids), ["ids"], "got", T.ArrayType(T.StringType()))
    rows = asked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("batch", "got"))).alias("all"), F.max("error").alias("error"))
    return rows.select(group, F.array_distinct(F.flatten(F.transform("all", lambda x: F.coalesce(x["got"], F.array().cast("array<string>"))))).alias("uids"), "error")


def fetched_texts(found: DataFrame, client: ArchiveClient, db: str, form: str, group: str) -> DataFrame:
    """``group``, ``batch``, the answers' ``body`` and ``error``."""
    return answered(in_batches(found, group, FETCH), lambda ids: client.fetch(db, form, ids), ["ids"], "body", T.StringType()).drop("ids")


def verified_uids(accessions: DataFrame, client: ArchiveClient, db: str = "biosample", accession: str = "id", candidates: int = 5) -> DataFrame:
    """The record of each accession: ``uid``, null if none of the records that are found has that accession.

    A search by field comes first. Its best record counts only if its own accession is the one that was asked for, since
    archives cross-refer; then the records of a plain search are looked at in their order.
    """

    def ask(wanted: str) -> str | None:
        best = client.search(db, f"{wanted}[Accession]")[:1]
        if best and client.summary(db, best[0]) == wanted:
            return best[0]
        return next((u for u in client.search(db, wanted)[:candidates] if client.summary(db, u) == wanted), None)

    return answered(accessions.select(accession), ask, [accession], "uid", T.StringType())


