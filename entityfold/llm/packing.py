"""Best-fit packing of token pieces into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the whole corpus is, for packing, a count per
length. The plan is made on those counts: pieces above a third of the capacity are paired
greedily, each with the largest partner that fits (at most two can share a sequence); smaller
pieces then go, longest first, to the tightest gap that takes them. What the driver holds is
bounded by the capacity, not by the corpus. Spark ranks the pieces within each length and each
finds its sequence and offset from its rank.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.bpe import Encoder
from entityfold.llm.common import map_batches, materialise

RANKED_TOGETHER = 4096


def token_pieces(
    df: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode each text, append ``end_id`` and cut what is longer than ``capacity``.

    A null text is empty: it is the end id alone. Of a cut document all pieces are full but the
    first, which takes what is left over. Returns the key, ``piece`` (from 0), ``start``,
    ``length`` and ``ids`` (little-endian unsigned 32-bit).
    """
    taken = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def make():
        encoder, end = Encoder(path), np.array([end_id], "<u4").tobytes()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(value) + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                rows += [(k, i, a, b - a, ids[4 * a : 4 * b]) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [key, "piece", "start", "length", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return run

    kind = df.schema[key].dataType.simpleString()
    return map_batches(taken, make, f"`{key}` {kind}, piece int, start long, length long, ids binary")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Bins for so many pieces of each length: (how many alike bins, ((length, times), ...))."""
    bins: dict[int, list] = defaultdict(list)  # gap -> [how many, contents]
    left = {n: c for n, c in counts.items() if c and 3 * n > capacity}
    active = sorted(left)
    while active:
        n = active[-1]
        room = min(n - 1, capacity - n)
        i = bisect.bisect_right(active, room) - 1
        if 2 * n <= capacity and left[n] >= 2:
            bins[capacity - 2 * n].append((left[n] // 2, ((n, 2),)))
            left[n] %= 2
        elif i >= 0:
            partner = active[i]
            m = min(left[n], left[partner])
            bins[capacity - n - partner].append((m, ((n, 1), (partner, 1))))
            left[n] -= m
            left[partner] -= m
            if not left[partner]:
                del active[i]
        else:
            bins[capacity - n].append((left[n], ((n, 1),)))
            left[n] = 0
        if not left[n]:
            active.pop()
    gaps = sorted(bins)

    def add(gap: int, how_many: int, contents: tuple) -> None:
        if how_many:
            if not bins[gap]:
                bisect.insort(gaps, gap)
            bins[gap].append((how_many, contents))

    for n in sorted((n for n, c in counts.items() if c and 3 * n <= capacity), reverse=True):
        c = counts[n]
        while c:
            i = bisect.bisect_left(gaps, n)
            if i == len(gaps):
                add(capacity, -(-c // (capacity // n)), ())
                continue
            gap = gaps[i]
            how_many, contents = bins[gap].pop()
            if not bins[gap]:
                del gaps[i]
            times = gap // n
            full = min(how_many, c // times)
            add(gap - times * n, full, (*contents, (n, times)))
            c -= full * times
            rest = how_many - full
            if rest and c:  # fewer than ``times`` are left: one more bin takes them
                add(gap - c * n, 1, (*contents, (n, c)))
                rest, c = rest - 1, 0
            add(gap, rest, contents)
    return [(m, contents) for gap in bins for m, contents in bins[gap]]


def slot_table(plan: list[tuple[int, tuple[tuple[int, int], ...]]]) -> pd.DataFrame:
    """Per slot of a kind of bin: its length, first rank, first sequence and offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for how_many, contents in plan:
        offset = 0
        for n, times in contents:
            for _ in range(times):
                rows.append((n, used[n], sequence, offset))
                used[n] += how_many
                offset += n
        sequence += how_many
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"]).sort_values(["length", "first"])


def pack(pieces: DataFrame, capacity: int, order: tuple[str, ...], length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces whose lengths are 1 to ``capacity``.

    ``order`` names columns that tell the pieces apart; rows alike in all of them may stand for
    one another. ``pieces`` is read twice and should be a written table. No piece is dropped; an
    empty table gives an empty one; another length is an error.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    slots = slot_table(plan_bins(counts, capacity))
    parts = max(1, -(-sum(counts.values()) // RANKED_TOGETHER))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(parts)))
    before = (
        salted.groupBy(length, "_salt").count()
        .withColumn("_before", F.sum("count").over(Window.partitionBy(length).orderBy("_salt")) - F.col("count"))
        .drop("count")
    )
    within = F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*order)).cast("long")
    ranked = salted.withColumn("_n", within).join(before, [length, "_salt"])
    ranked = ranked.select(*pieces.columns, (F.col("_before") + F.col("_n") - 1).alias("_rank"))
    shift = np.int64(1) << np.int64(44)
    keys = slots["length"].to_numpy("int64") * shift + slots["first"].to_numpy("int64")
    first, sequence, offset = (slots[c].to_numpy("int64") for c in ("first", "sequence", "offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column(b.num_columns - 1).to_numpy()
            at = np.searchsorted(keys, b.column(names.index(length)).to_numpy() * shift + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"],
            )

    names = pieces.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with checksum and place; see ``token_pieces`` and ``pack``."""
    pieces = token_pieces(df, path, capacity, end_id, key, text)
    narrow = pieces.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(materialise(narrow, "pieces"), capacity, (key, "piece", "start", "ids_crc32"))
