"""Downloads of sequence files: routes, retries, integrity, names of mates, and runs that are whole.

The bytes come from a client; files go to any file system that Arrow opens by its address. A file gets its final name
only when it is whole, so a lost task or executor leaves nothing that a later run would take for a result.
"""

from __future__ import annotations

import gzip
import hashlib
import posixpath
import re
import zlib
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tarnflow.functions.text import with_retries
from tarnflow.sources import connectors, texts

#: Tries, the first pause and the longest one, in seconds (fixed values).
ATTEMPTS, PAUSE, LONGEST_PAUSE = 5, 5.0, 60.0


class FileClient(Protocol):
    def download(self, url: str) -> bytes:
        """The content behind an address."""


class Damaged(OSError):
    """A file that came, but isn't whole."""


def mate_name(name: str) -> str:
    """The file's name with its mate as _1 or _2, and .fastq.gz at its end."""
    stem = re.sub(r"(?:\.(?:fastq|fq))?(?:\.gz)?$", "", name)
    return re.sub(r"_[RrFf]?([12])(?:_\d+)?$", r"_\1", stem) + ".fastq.gz"


def whole(data: bytes, md5: str | None) -> bytes:
    """The content, if it has the checksum and inflates to its end with whole records."""
    if md5 and hashlib.md5(data).hexdigest() != md5.lower():
        raise Damaged("another checksum than the listed one")
    try:
        lines = gzip.decompress(data).count(b"\n")
    except (EOFError, zlib.error, gzip.BadGzipFile) as e:
        raise Damaged(str(e)) from e
    if not lines or lines % 4:
        raise Damaged(f"{lines} lines")
    return data


def download_files(runs: DataFrame, reports: DataFrame, lists: DataFrame) -> DataFrame:
    """``run``, ``archive``, ``url`` and ``md5`` of the files of each run, by the archive that its accession names.

    ``reports`` are the first archive's links (``run``, ``url``, ``md5``), of which an unpaired file beside both mates is
    left out; ``lists`` those of the second one. A failed run is only ever tried at its own archive.
    """
    routed = connectors.download_plan(runs.select("run").distinct())
    links = texts.chosen_files(reports.select("run", "url", "md5")).select("run", "url", "md5")
    files = links.withColumn("archive", F.lit("ena")).unionByName(lists.select("run", "url", "md5").withColumn("archive", F.lit("cncb")))
    return routed.join(files, ["run", "archive"], "left")


def downloaded(files: DataFrame, client: FileClient, folder: str, attempts: int = ATTEMPTS, pause: float = PAUSE) -> DataFrame:
    """``files`` with the ``file`` that was written below ``folder``, its ``bytes``, and ``error``, null where all is well.

    A file that is there already is not asked for again. Requests of a partition follow each other.
    """
    schema = "run string, archive string, url string, md5 string, file string, bytes long, error string"

    def save(target: fs.FileSystem, base: str, url: str, md5: str | None) -> tuple[str, int]:
        name = mate_name(posixpath.basename(url))
        path = f"{base}/{name}"
        held = target.get_file_info(path)
        if held.type == fs.FileType.File:
            return name, held.size
        data = with_retries(lambda: whole(client.download(url), md5), attempts, first=pause, most=LONGEST_PAUSE)
        with target.open_output_stream(f"{path}.part") as out:
            out.write(data)
        target.move(f"{path}.part", path)
        return name, len(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        target.create_dir(base)
        for batch in batches:
            made = []
            for url, md5 in zip(batch.column("url").to_pylist(), batch.column("md5").to_pylist(), strict=True):
                try:
                    made.append((*save(target, base, url, md5), None) if url else (None, None, "no file is listed"))
                except OSError as e:
                    made.append((None, None, f"{type(e).__name__}: {e}"))
            names, sizes, errors = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], [*batch.schema.names, "file", "bytes", "error"])

    return files.select("run", "archive", "url", "md5").mapInArrow(run, schema)


def run_states(done: DataFrame) -> DataFrame:
    """Each run with ``complete`` (all of its files came) and its number of ``files``; files of other runs are orphans."""
    return done.groupBy("run").agg((F.count("error") == 0).alias("complete"), F.count("file").alias("files"))


def without_orphans(done: DataFrame, folder: str) -> int:
    """Delete the files of runs that aren't complete; their number."""
    lost = done.join(run_states(done).where("not complete").select("run"), "run", "left_semi").where("file is not null").select("file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if target.get_file_info(f"{base}/{name}").type == fs.FileType.File:
                    target.delete_file(f"{base}/{name}")
            yield batch

    return lost.mapInArrow(run, "file string").count()
