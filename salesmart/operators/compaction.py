"""Fewer and larger files for tables that grow by one folder for each batch.

A batch owns the folder ``batch_id=N`` and leaves as many files as it had tasks. Compaction packs
consecutive small batches by their size into segments of few files, which hold the batch as a column.
A file is sorted by one task, so its rows are bounded as well as its bytes.
A small file, the state, names the segments and the batches that they replace, and is put in place last:
readers find every row once, before and after, and a compaction that fails leaves the table as it
was. Folders that are replaced are deleted by the next compaction, for readers still on them.

A segment is written again only together with at least as many bytes of newer rows, so a row
is copied some log2(all / batch) times, however long the table grows. Large batches stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart import files
from salesmart.operators.sinks import SEGMENTS, STATE, read_batches, read_state, read_segments
from salesmart.staging import COMPACT

SEGMENT_BYTES = 64 << 30
FILE_BYTES = 256 << 20
#: A task sorts the rows of its file in memory, where a row takes a kilobyte or less; rows that pack
#: well would be many times the bytes of their file, so this bounds a file too.
FILE_ROWS = 1_500_000


@dataclass(frozen=True)
class Piece:
    """A batch's folder or a segment: its name, the batches in it, its bytes and files."""

    name: str
    first: int
    last: int
    bytes: int
    files: int


def small(piece: Piece, file_bytes: int) -> bool:
    """Whether files of this size would be fewer than half of what the piece has."""
    return piece.files > 2 * max(1, -(-piece.bytes // file_bytes)) or piece.bytes < file_bytes


def pack(
    segments: Sequence[Piece], batches: Sequence[Piece], segment_bytes: int, file_bytes: int
) -> list[list[Piece]]:
    """Runs of consecutive pieces, each to become one segment.

    Batches are put into a run until it is full or a large batch follows. The segment before a run
    joins it if it is no larger than the run.
    """
    runs: list[list[Piece]] = []
    previous: Piece | None = None
    for batch in batches:
        if small(batch, file_bytes):
            fits = runs and previous is runs[-1][-1] and size(runs[-1]) + batch.bytes <= segment_bytes
            if fits:
                runs[-1].append(batch)
            else:
                runs.append([batch])
        previous = batch
    older = list(segments)
    for run in runs:
        while neighbour := next((s for s in older if s.last == run[0].first - 1), None):
            if neighbour.bytes > size(run) or neighbour.bytes + size(run) > segment_bytes:
                break
            run.insert(0, neighbour)
            older.remove(neighbour)
    return [run for run in runs if len(run) > 1 or run[0].files > 1]


def size(run: Sequence[Piece]) -> int:
    return sum(piece.bytes for piece in run)


def compact(
    spark: SparkSession,
    path: str,
    order_by: Sequence[str],
    through: int,
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
    file_rows: int = FILE_ROWS,
) -> int:
    """Pack the small batches up to number ``through``; returns how many segments were written.

    ``through`` lies before the last batch, which may be delivered again. The rows of a segment are in
    the order of ``order_by``. No job may load into the table at the same time; readers may.
    """
    state = read_state(spark, path)
    for name in (*state["stale"], *[n for n in files.children(spark, f"{path}/{SEGMENTS}")
                                    if n not in {s["name"] for s in state["segments"]}]):
        files.delete(spark, f"{path}/{name}" if "=" in name else f"{path}/{SEGMENTS}/{name}")
    batches = []
    for name in files.children(spark, path):
        number = int(name.split("=")[1]) if name.startswith("batch_id=") else None
        if number is not None and number <= through:
            batches.append(Piece(name, number, number, *files.size(spark, f"{path}/{name}")))
    batches.sort(key=lambda piece: piece.first)
    segments = [Piece(**s) for s in state["segments"]]
    written, gone = [], set()
    for run in pack(segments, batches, segment_bytes, file_bytes):
        rows = rows_of(spark, path, run)
        # Counting reads only the footers of the files.
        count = max(1, -(-size(run) // file_bytes), -(-rows.count() // file_rows))
        name = f"segment-{uuid.uuid4().hex}"
        rows.repartitionByRange(count, *order_by).sortWithinPartitions(*order_by) \
            .write.parquet(f"{path}/{SEGMENTS}/{name}", compression=COMPACT)
        written.append(Piece(name, run[0].first, run[-1].last, *files.size(spark, f"{path}/{SEGMENTS}/{name}")))
        gone.update(piece.name for piece in run)
    if written or state["stale"]:
        kept = sorted([*[s for s in segments if s.name not in gone], *written], key=lambda piece: piece.first)
        replaced = [b.first for b in batches if b.name in gone]
        files.write_text(spark, f"{path}/{STATE}", json.dumps(
            {"segments": [asdict(s) for s in kept], "replaced": replaced, "stale": sorted(gone)}
        ))
    return len(written)


def rows_of(spark: SparkSession, path: str, run: Sequence[Piece]) -> DataFrame:
    names = [piece.name for piece in run if "=" not in piece.name]
    numbers = [piece.first for piece in run if "=" in piece.name]
    parts = [read_batches(spark, path).where(F.col("batch_id").isin(numbers))]
    if names:
        parts.append(read_segments(spark, path, names, parts[0].schema))
    return reduce(DataFrame.unionByName, parts)
