"""Work between builds that changes no row."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.config import COUNTRIES, LINEAGE_COLUMNS, Country
from salesmart.operators.compaction import FILE_BYTES, SEGMENT_BYTES, compact
from salesmart.plans.build import load_paths
from salesmart.plans.changes import BATCHES
from salesmart.plans.curate import sales_table
from salesmart.sources.warehouse import Warehouse
from salesmart.staging import side_by_side
from salesmart.streaming.incremental import BATCH, LOAD_KEY, LoadPaths


def compact_loads(
    warehouse: Warehouse, to: LoadPaths, through: int,
    segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES,
) -> None:
    """Pack the rows, the rejects and the last keys of one source's batches up to ``through``."""
    lineage = list(LINEAGE_COLUMNS)
    for path, order in ((to.rows, [LOAD_KEY]), (to.rejects, lineage), (to.keys, [BATCH])):
        compact(warehouse.spark, path, order, through, segment_bytes, file_bytes)


def compact_sources(
    warehouse: Warehouse, segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES
) -> None:
    """Pack what builds have dealt with, but for each source's last batch, which may come again."""
    noted = warehouse.find("common", BATCHES)
    done = {} if noted is None else {r["source"]: r[BATCH] for r in noted.collect()}

    def upkeep(country: Country) -> None:
        keys = warehouse.find("keys", sales_table(country))
        if keys is not None and country.code in done:
            last = keys.agg(F.max(BATCH)).first()[0]
            through = min(done[country.code], last - 1)
            compact_loads(warehouse, load_paths(warehouse, country), through, segment_bytes, file_bytes)

    side_by_side(*[lambda c=c: upkeep(c) for c in COUNTRIES])
