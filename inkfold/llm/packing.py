"""Items packed into containers of fixed capacity.

Shortest-pack-first over the histogram of lengths: lengths are placed longest first, each into the packs with most
room that still take it. Packs with equal content are one pattern with a count, so the work depends on the number of
lengths, not of items. Items then find their container through their rank among the items of their length.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.tokens import TOKENIZERS, token_counts
from inkfold.session import durable

#: Parts in which the items of one length are numbered at least, and items for which there is one more.
SHARDS, SHARD_ITEMS = 64, 1_000_000


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(containers, [(length, items per container), ...])`` that place every item of the histogram.

    Lengths must be from 1 to ``capacity``. New packs take as many items of the length as they hold, as if the items
    came one by one: the pack just opened is the shortest. Packs of equal room are used last in, first out.
    """
    room: dict[int, list] = defaultdict(list)  # free room: packs as [containers, linked content]
    largest: list[int] = []  # heap of the free rooms, negated
    full = []

    def keep(containers: int, free: int, content: tuple) -> None:
        if not free:
            full.append((containers, content))
            return
        if not room[free]:
            heapq.heappush(largest, -free)
        room[free].append([containers, content])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while largest and not room[-largest[0]]:
                heapq.heappop(largest)
            free = -largest[0] if largest else 0
            if free >= length:
                pack = room[free][-1]
                used = min(pack[0], left)
                pack[0] -= used
                if not pack[0]:
                    room[free].pop()
                left -= used
                keep(used, free - length, ((length, 1), pack[1]))
            else:
                each = min(capacity // length, left)
                used = left // each
                left -= used * each
                keep(used, capacity - each * length, ((length, each), None))
    patterns = full + [(containers, content) for packs in room.values() for containers, content in packs]
    out = []
    for containers, content in patterns:
        held: dict[int, int] = defaultdict(int)
        while content:
            (length, each), content = content
            held[length] += each
        out.append((containers, sorted(held.items(), reverse=True)))
    return out


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
    """Per run of equal-length items in one pattern: length, rank of its first item, first container, items per container."""
    runs, used, container = [], defaultdict(int), 0
    for containers, content in patterns:
        for length, each in content:
            runs.append((length, used[length], container, each))
            used[length] += containers * each
        container += containers
    return tuple(np.array(sorted(runs), dtype=np.int64).reshape(-1, 4).T)


def _place(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, sizes, ranks = (batch.column(k).to_numpy() for k in (0, 4, 5))
            place = np.zeros(len(kinds), np.int64)
            for kind in np.unique(kinds):
                length, first, container, each = slots.value[int(kind)]
                known = np.unique(length)
                own = np.flatnonzero((kinds == kind) & (sizes > 0))
                # one sorted axis: the length's place among the lengths, then the rank, which stays below 2**40
                axis = (np.searchsorted(known, length) << 40) + first
                at = np.searchsorted(axis, (np.searchsorted(known, sizes[own]) << 40) + ranks[own], side="right") - 1
                place[own] = container[at] + (ranks[own] - first[at]) // each[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(place), *(batch.column(k) for k in (1, 2, 3, 4))],
                names=["capacity_id", "container_id", "key", "part_no", "token_start", "n_tokens"],
            )

    return run


def pack(lengths: DataFrame, key: str, size: str, capacities: dict[int, int]) -> DataFrame:
    """``capacity_id, container_id, key, part_no, token_start, n_tokens``: every item in one container of each capacity.

    Only an item longer than the capacity is divided: into full containers and a rest that is packed like an item.
    Items of size 0 take no room and are all put into container 0. Null sizes count as 0. Containers are numbered from
    0 per capacity. The histograms have at most the sum of the capacities' rows, whatever the number of items. Equal
    keys are different items: they are told apart by their row. An empty table gives no rows.
    """
    spark = lengths.sparkSession
    sized = lengths.select(F.col(key).alias("key"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n"))
    wanted = F.explode(F.array(*(F.struct(F.lit(i).cast("int").alias("capacity_id"), F.lit(c).cast("bigint").alias("cap")) for i, c in capacities.items())))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / F.col("cap"))).cast("int")
    pieces = sized.withColumn("c", wanted).select("key", "n", "c.*").select(
        "capacity_id",
        "cap",
        "key",
        "n",
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part_no"),
    )
    start = F.col("part_no") * F.col("cap")
    pieces = pieces.select("capacity_id", "key", "part_no", start.alias("token_start"), F.least("cap", F.col("n") - start).alias("n_tokens"))
    shards = max(SHARDS, -(-lengths.count() // SHARD_ITEMS))  # all items may be of one length
    shard = F.pmod(F.xxhash64("key", "part_no"), F.lit(shards)).cast("int")
    # a length's items are numbered within shards; shards start where the ones before end
    pieces = durable(pieces.withColumn("shard", shard))
    counts = pieces.groupBy("capacity_id", "n_tokens", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("capacity_id", "n_tokens").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("from_rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram: dict[int, dict[int, int]] = {i: {} for i in capacities}
    for r in counts.where(F.col("n_tokens") > 0).groupBy("capacity_id", "n_tokens").agg(F.sum("n").alias("n")).collect():  # at most the sum of the capacities
        histogram[r["capacity_id"]][r["n_tokens"]] = r["n"]
    slots = {i: _slots(shortest_pack_first(h, capacities[i])) for i, h in histogram.items()}
    within = Window.partitionBy("capacity_id", "n_tokens", "shard").orderBy("key", "part_no")
    ranked = pieces.withColumn("in_shard", F.row_number().over(within) - 1).join(starts.drop("n"), ["capacity_id", "n_tokens", "shard"])
    ranked = ranked.select("capacity_id", "key", "part_no", "token_start", "n_tokens", (F.col("from_rank") + F.col("in_shard")).cast("bigint").alias("rank"))
    placed = ranked.mapInArrow(
        _place(spark.sparkContext.broadcast(slots)),
        "capacity_id int, container_id bigint, key bigint, part_no int, token_start bigint, n_tokens bigint",
    )
    return placed.withColumnRenamed("key", key)


def pack_documents(documents: DataFrame, capacities: DataFrame, *, folder: str = TOKENIZERS) -> DataFrame:
    """``documents`` in containers of each row of ``capacities``, sized in tokens of the tokenizer that it names.

    ``capacities`` is a short table of settings and is read by the driver; a null tokenizer means byte_bpe_50k.
    """
    settings = [
        (
            r["capacity_id"],
            r["capacity_tokens"],
            r["tokenizer"] or "byte_bpe_50k",
        ) for r in capacities.select("capacity_id", "capacity_tokens", "tokenizer").collect()
    ]
    out = None
    for name in dict.fromkeys(t for _, _, t in settings):
        sizes = durable(token_counts(documents, "doc_id", "text", tokenizer=name, folder=folder))
        placed = pack(sizes, "doc_id", "n_tokens", {i: c for i, c, t in settings if t == name})
        out = placed if out is None else out.unionByName(placed)
    return out


def container_fill(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, unused tokens, and the least number of containers that any packing needs."""
    used = packed.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("used"))
    total = used.groupBy("capacity_id").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("used").alias("n_tokens"))
    cap = F.col("capacity_tokens").cast("bigint")
    joined = total.join(F.broadcast(capacities.select("capacity_id", "capacity_tokens")), "capacity_id")  # settings: a few rows
    return joined.select(
        "capacity_id",
        cap.alias("capacity_tokens"),
        "n_containers",
        "n_tokens",
        (F.col("n_containers") * cap - F.col("n_tokens")).alias("unused"),
        F.ceil(F.col("n_tokens") / cap).alias("least_containers"),
    )


def violations(packed: DataFrame, lengths: DataFrame, capacities: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per capacity, what must be 0: ``n_over`` containers over the capacity, ``n_uneven`` items of which not every token is in
    exactly one part, ``n_divided`` items divided that the capacity holds. ``lengths`` has ``key`` (unique) and ``n_tokens``.
    """
    caps = capacities.select("capacity_id", F.col("capacity_tokens").cast("bigint").alias("cap"))
    over = packed.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("used")).join(F.broadcast(caps), "capacity_id")  # settings: a few rows
    over = over.groupBy("capacity_id").agg(F.count_if(F.col("used") > F.col("cap")).alias("n_over"))
    parts = packed.groupBy("capacity_id", key).agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("n_tokens").alias("placed"),
        F.max(F.col("token_start") + F.col("n_tokens")).alias("upto"),
        F.count_distinct("part_no").alias("distinct"),
    )
    each = F.explode(F.array(*(F.struct(F.lit(r["capacity_id"]).alias("capacity_id"), F.lit(r["cap"]).alias("cap")) for r in caps.collect())))  # settings
    held = lengths.select(key, "n_tokens", each.alias("c")).select(key, "n_tokens", "c.*").join(parts, ["capacity_id", key], "left")
    even = (F.col("placed") == F.col("n_tokens")) & (F.col("upto") == F.col("n_tokens")) & (F.col("distinct") == F.col("parts"))
    checked = held.groupBy("capacity_id").agg(
        F.count_if(~F.coalesce(even, F.lit(False))).alias("n_uneven"),
        F.count_if((F.col("parts") > 1) & (F.col("n_tokens") <= F.col("cap"))).alias("n_divided"),
    )
    return caps.join(over, "capacity_id", "left").join(checked, "capacity_id", "left").select(
        "capacity_id",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_over", "n_uneven", "n_divided")),
    )
