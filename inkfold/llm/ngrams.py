"""How often every n-gram of terms occurs, and in how many records.

Suffix-sorted counting: every position of a record gives one suffix, cut to ``sigma`` terms. Suffixes are routed by
their first term, sorted in reverse lexicographic order, and a stack turns the counts of suffixes into the counts of
all their prefixes in one pass. A record set is carried as one number per prefix length: how many records have, at
such a suffix, the prefix for the first time. These numbers add up, so suffixes are combined before the shuffle and a
term that fills a third of all records costs a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.terms import normal_terms

_COUNTED = "grp string, suffix array<string>, n bigint, firsts array<bigint>"
_COUNTED_ARROW = pa.schema([("grp", pa.string()), ("suffix", pa.list_(pa.string())), ("n", pa.int64()), ("firsts", pa.list_(pa.int64()))])
#: Entries a combining or emitting task holds before it passes them on.
FLUSH = 100_000
#: Terms of the longest n-grams that are counted.
SIGMA = 3


def _emit(sigma: int):
    """Records to combined suffixes; long records cost time in proportion to their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush():
            keys, values = list(held), list(held.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([list(k[1:]) for k in keys], pa.list_(pa.string())),
                    pa.array([v[0] for v in values], pa.int64()),
                    pa.array([v[1:] for v in values], pa.list_(pa.int64())),
                ],
                schema=_COUNTED_ARROW,
            )
            held.clear()

        for batch in batches:
            for grp, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not seq:
                    continue
                seen: set = set()
                for i in range(len(seq)):
                    suffix = tuple(seq[i : i + sigma])
                    value = held.setdefault((grp, *suffix), [0] * (len(suffix) + 1))
                    value[0] += 1
                    for size in range(1, len(suffix) + 1):
                        if suffix[:size] not in seen:
                            seen.add(suffix[:size])
                            value[size] += 1
                if len(held) >= FLUSH:
                    yield from flush()
        yield from flush()

    return run


def _stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes in reverse lexicographic order to prefixes with their counts and numbers of records."""
    grp: str | None = None
    path: list[str] = []  # the prefix on the stack
    counts: list[list[int]] = []  # for each of its lengths: occurrences, records
    out: list[tuple] = []

    def pop(to: int) -> None:
        while len(path) > to:
            n, records = counts.pop()
            out.append((grp, path[:], n, records))
            path.pop()
            if counts:
                counts[-1][0] += n

    def passed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64()))],
            names=["grp", "ngram", "n_occurrences", "n_records"],
        )
        out.clear()
        return batch

    for batch in batches:
        for g, suffix, n, firsts in zip(*(batch.column(k).to_pylist() for k in range(4))):
            shared = 0
            if g == grp:
                while shared < min(len(path), len(suffix)) and path[shared] == suffix[shared]:
                    shared += 1
            pop(shared)
            grp = g
            for term in suffix[shared:]:
                path.append(term)
                counts.append([0, 0])
            counts[-1][0] += n  # shorter prefixes get it when this one is popped
            for size, first in enumerate(firsts):
                counts[size][1] += first
        if len(out) >= FLUSH:
            yield passed()
    pop(0)
    yield passed()


def ngram_counts(records: DataFrame, grp: Column, seq: Column, sigma: int, *, fan: int = 16) -> DataFrame:
    """``grp, ngram array<string>, n_occurrences, n_records`` of all n-grams of up to ``sigma`` terms.

    ``grp`` keeps collections apart. Terms are compared as given; the array must hold no nulls. A null or empty array
    is a record without n-grams. Suffixes of one first term go to up to ``fan`` tasks by their second term, so a hot
    first term is split; the counts of single terms are then added up. Empty tables give no rows.
    """
    counted = records.select(grp.alias("grp"), seq.alias("seq")).mapInArrow(_emit(sigma), _COUNTED)
    route = [F.col("grp"), F.element_at("suffix", 1)] + ([F.pmod(F.xxhash64(F.try_element_at("suffix", F.lit(2))), F.lit(fan))] if sigma > 1 else [])
    routed = counted.repartition(*route).sortWithinPartitions(F.desc("grp"), F.desc("suffix"))
    parts = routed.mapInArrow(_stack, "grp string, ngram array<string>, n_occurrences bigint, n_records bigint")
    return parts.groupBy("grp", "ngram").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_records").alias("n_records"))


def term_usefulness(fields: dict[str, tuple[DataFrame, str]], *, rare_below: int = 3, common_above: float = 0.2, sigma: int = SIGMA) -> DataFrame:
    """Every n-gram of normal terms of some list columns with its counts and a mark.

    ``fields`` names for each ``field_name`` a table and its list column. Columns: ``field_name, terms`` (an array),
    ``n_terms, n_occurrences, n_records, mark``: ``rare`` if fewer than ``rare_below`` records have it,
    ``common`` if more than the share ``common_above`` of all records have it, else null. Rows with a null or empty
    list count as records.
    """
    sources = [df.select(F.lit(name).alias("grp"), normal_terms(F.col(column)).alias("seq")) for name, (df, column) in fields.items()]
    records = sources[0]
    for more in sources[1:]:
        records = records.unionByName(more)
    counts = ngram_counts(records, F.col("grp"), F.col("seq"), sigma)
    limit = F.create_map(*(x for name, (df, _) in fields.items() for x in (F.lit(name), F.lit(df.count() * common_above))))
    mark = F.when(F.col("n_records") < rare_below, "rare").when(F.col("n_records") > limit[F.col("grp")], "common")
    return counts.select(
        F.col("grp").alias("field_name"),
        F.col("ngram").alias("terms"),
        F.size("ngram").alias("n_terms"),
        "n_occurrences",
        "n_records",
        mark.alias("mark"),
    )
