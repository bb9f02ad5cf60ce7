"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``slots`` equal arcs. Every shard owns ``points`` of them, its virtual
nodes. A row starts at the arc of its id's hash and goes to the shard of the first virtual node
clockwise that has room. The rows of one arc share all their preferences, so the walk is done on
row counts per arc, a table bounded by ``slots``, and each arc's ranks are cut into runs, one per
shard. Rows then meet the runs by arc and rank; no row is placed one by one and no arc's rows
meet in one task.

Room: shards hold ``rows // shards`` rows, the first ``rows % shards`` of them one more, so the
counts differ by at most one (law ``rows``). Most rows stay on the shard that the ring alone
gives; only overflow walks on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import documents, literal_table, ranked
from salesmart.staging import stage

RING_SLOTS_LOG2 = 12
POINTS = 64


def ring(shards: int, points: int = POINTS, slots_log2: int = RING_SLOTS_LOG2) -> dict[int, int]:
    """Slot -> shard of the virtual nodes. A taken slot sends a point on to the next free one."""
    slots = 1 << slots_log2
    if shards * points > slots:
        raise ValueError("more virtual nodes than slots")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for point in range(points):
            digest = hashlib.md5(f"shard {shard} point {point}".encode()).digest()
            slot = int.from_bytes(digest[:8], "big") >> (64 - slots_log2)
            while slot in taken:
                slot = (slot + 1) % slots
            taken[slot] = shard
    return taken


def preferences(nodes: dict[int, int], slots: int) -> list[list[int]]:
    """For each slot, the distinct shards met clockwise from it."""
    result: list[list[int]] = [[] for _ in range(slots)]
    order: list[int] = []
    for step in range(2 * slots - 1, -1, -1):
        slot = step % slots
        if slot in nodes:
            order = [nodes[slot], *[s for s in order if s != nodes[slot]]]
        if step < slots:
            result[slot] = order
    return result


def place(
    counts: dict[int, int], shards: int, points: int = POINTS, slots_log2: int = RING_SLOTS_LOG2
) -> list[dict[str, int]]:
    """Runs of ranks per arc: slot, first and last rank, shard, place of the first row there.

    Every arc first asks its nearest shard, in ring order; what finds no room asks the next
    distinct shard clockwise, again in ring order, until all rows are placed.
    """
    total = sum(counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    filled = [0] * shards
    done = dict.fromkeys(counts, 0)
    liked = preferences(ring(shards, points, slots_log2), 1 << slots_log2)
    runs = []
    for turn in range(shards):
        for slot in sorted(counts):
            shard = liked[slot][turn]
            take = min(counts[slot] - done[slot], room[shard] - filled[shard])
            if take > 0:
                runs.append({"ring_slot": slot, "first": done[slot], "last": done[slot] + take - 1,
                             "shard": shard, "place": filled[shard]})
                done[slot] += take
                filled[shard] += take
    return runs


def shard_rows(
    docs: DataFrame, shards: int = 16, carry: Sequence[str] = (), points: int = POINTS
) -> DataFrame:
    """Every row of ``docs`` with its shard and its gapless place there.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, the ``carry`` columns,
    shard, slot. Rows with a NULL or repeated id are rows like others (they start at the same
    arc). A NULL text counts as empty. An empty table gives no rows. Other columns are left out,
    so their names cannot clash; ``carry`` must not name the result's own columns.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            *carry,
            F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - RING_SLOTS_LOG2).cast("int").alias("ring_slot"),
            F.spark_partition_id().alias("part"),
        ),
        "ring",
    )
    counts = {r["ring_slot"]: r["count"] for r in rows.groupBy("ring_slot").count().collect()}
    runs = literal_table(
        docs.sparkSession,
        json.dumps(place(counts, shards, points)),
        "ring_slot int, first bigint, last bigint, shard int, place bigint",
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    # At most slots + slots * shards runs, whatever the data: small enough for every executor.
    return (
        ranked(rows, "ring_slot", *order)
        .join(F.broadcast(runs), "ring_slot")
        .filter(F.col("rank").between(F.col("first"), F.col("last")))
        .select("doc_id", "size", "text_crc32", *carry, "shard",
                (F.col("place") + F.col("rank") - F.col("first")).alias("slot"))
    )


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose row counts differ by at most one."""
    return shard_rows(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
