"""Mixing sources to target weights.

Words are summed per source. Each source is due its weight's share of all words, but no more than
``most`` times its own; what is above is shared again among the others. The rate of a source is its
target over its size: a document is taken floor(rate) times and once more if a uniform number
drawn from the hash of its key is below the fraction that is left. Of a few seeds each source
takes the one whose draw comes closest to its target. DataFrame expressions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityfold.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
SEEDS = 16
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: str | Column) -> Column:
    """Words of a text; zero for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of the key (null: empty) and the seed; four seeds share a hash."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed // 4}"))
    digits = F.substring(F.md5(text.cast("binary")), 1 + 8 * (seed % 4), 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2.0**32)


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add for each name the sum over the rows before this one; sorted by ranges, not in one task."""
    placed = materialise(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "placed")
    totals = placed.groupBy("_part").agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items()))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = totals.select("_part", *(F.coalesce(F.sum(f"_{n}").over(ahead), F.lit(0)).alias(f"_{n}") for n in sums))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    added = {n: F.col(f"_{n}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()}
    return placed.join(totals, "_part").select(*df.columns, *(c.alias(n) for n, c in added.items()))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source`` and ``size`` of documents.

    Sources in order of code points, null last, weigh ``weights`` over and over. A source is capped
    if even its share of what the sources of smaller size per weight leave is above its cap.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = running(sources, [F.col("source").asc_nulls_last()], {"n": F.lit(1)})
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.col("n") % len(weights) + 1).cast("int"))
    weighed = numbered.select("source", "source_size", cycle.cast("long").alias("w"), (most * F.col("source_size")).alias("cap"))
    by_room = [F.col("cap").cast("double") / F.col("w"), F.col("source").asc_nulls_last()]
    filled = materialise(running(weighed, by_room, {"w0": F.col("w"), "cap0": F.col("cap")}), "sources")
    every = filled.agg(F.sum("w"), F.sum("source_size")).first()
    w, total = (float(x or 0) for x in every)
    rest = F.lit(total) - F.col("cap0")
    full = F.col("cap") * (F.lit(w) - F.col("w0")) < F.col("w") * rest
    filled = filled.withColumn("full", full)
    w1, cap1 = (float(x or 0) for x in filled.where("full").agg(F.sum("w"), F.sum("cap")).first())
    share = F.col("w") * F.lit(total - cap1) / F.lit(max(w - w1, 1.0))
    target = F.least(F.col("cap").cast("double"), F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share))
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seeds: int = SEEDS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every document with ``size``, ``source_size``, ``target`` of its source,
    ``copies`` and ``taken`` (copies times size).

    A null or blank text has size zero. Documents without a source are a source of their own, the
    last one. A null key draws like an empty one; rows alike in the key draw alike, each for its own
    row. A source without words has target zero and gives no copies. A kept column of the name of
    an added one makes way for it. An empty table gives an empty one. Reruns agree.
    """
    keep = tuple(c for c in keep if c not in ADDED)
    row = F.struct(*(docs[c] for c in keep)) if keep else F.lit(None)
    names = {"_row": row, "_key": docs[key], "_from": docs[source], "size": word_count(docs[text])}
    sized = materialise(docs.select(*(c.alias(n) for n, c in names.items())), "sizes")
    targets = materialise(source_targets(sized.select(F.col("_from").alias("source"), "size"), weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = targets.select(
        F.col("source").alias("_source"), "source_size", "target", F.floor(rate).alias("_whole"), (rate - F.floor(rate)).alias("_part")
    )
    drawn = sized.select("_key", "_from", "size").join(rates, F.col("_from").eqNullSafe(F.col("_source")))
    hits = [F.sum(F.when(draw(F.col("_key"), s) < F.col("_part"), F.col("size")).otherwise(0)).alias(f"d{s}") for s in range(seeds)]
    drawn = drawn.groupBy("_source", "source_size", "target", "_whole", "_part").agg(*hits)
    away = [F.abs(F.col("_whole") * F.col("source_size") + F.col(f"d{s}") - F.col("target")) for s in range(seeds)]
    closest = F.array_min(F.array(*(F.struct(a.alias("away"), F.lit(s).alias("seed")) for s, a in enumerate(away))))
    rates = materialise(drawn.select("_source", "source_size", "target", "_whole", "_part", closest["seed"].alias("_seed")), "rates")

    found = sized.join(rates, F.col("_from").eqNullSafe(F.col("_source")))
    lucky = reduce(lambda rest, s: F.when(F.col("_seed") == s, draw(F.col("_key"), s)).otherwise(rest), range(seeds), F.lit(1.0))
    copies = F.col("_whole") + (lucky < F.col("_part")).cast("long")
    return found.select(
        *(F.col("_row")[c].alias(c) for c in keep),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each row of ``mix`` as often as it has copies, numbered by ``copy`` from 1."""
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int"))).otherwise(F.array().cast("array<int>"))
    return mixed.withColumn("copy", F.explode(times))


def mix_sql(weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS) -> str:
    drawn = [f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{s // 4}'), {1 + 8 * (s % 4)}, 8))::BIGINT / 4294967296.0::DOUBLE" for s in range(seeds)]
    sums = ", ".join(f"sum(CASE WHEN {u} < part THEN size ELSE 0 END) AS d{s}" for s, u in enumerate(drawn))
    away = ", ".join(f"abs(whole * source_size + d{s} - target)" for s in range(seeds))
    pick = " ".join(f"WHEN {s} THEN {u}" for s, u in enumerate(drawn))
    return f"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
        n AS (SELECT *, [{", ".join(map(str, weights))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS w,
                     {most} * source_size AS cap FROM s),
        b AS (SELECT *, coalesce(sum(w) OVER o, 0)::DOUBLE AS w0, coalesce(sum(cap) OVER o, 0)::DOUBLE AS cap0 FROM n
              WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT *, cap * ((SELECT sum(w) FROM n)::DOUBLE - w0) < w * ((SELECT sum(source_size) FROM n)::DOUBLE - cap0) AS is_full FROM b),
        t AS (SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE least(cap::DOUBLE,
                     w * ((SELECT sum(source_size) FROM n)::DOUBLE - (SELECT coalesce(sum(cap), 0) FROM f WHERE is_full)::DOUBLE)
                     / greatest((SELECT sum(w) FROM n)::DOUBLE - (SELECT coalesce(sum(w), 0) FROM f WHERE is_full)::DOUBLE, 1.0::DOUBLE)) END AS target FROM f),
        r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t),
        q AS (SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS part FROM r),
        j AS (SELECT d.doc_id, d.size, q.* FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
        h AS (SELECT source, source_size, target, whole, {sums} FROM j GROUP BY ALL),
        c AS (SELECT source, list_position([{away}], least({away})) - 1 AS seed FROM h)
        SELECT j.doc_id, j.size, j.source_size, j.target,
               (whole + (CASE c.seed {pick} END < part)::BIGINT)::BIGINT AS copies, (copies * j.size)::BIGINT AS taken
        FROM j JOIN c ON j.source IS NOT DISTINCT FROM c.source"""
