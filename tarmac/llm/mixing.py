"""Operator 1: mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import WORD, ship, table, work_folder, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 17
#: Slices of a (source, length) group; only one slice of a group is ever ranked.
SLICES = 4096
#: Words that the greedy fill leaves to the dynamic programme.
EXACT_WORDS = 20_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: weights by rank of the source, no target above `most` times its source.

    Raising a water level until the targets add up to the budget is the same as sharing the
    excess again by weight until nobody is above. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1,
        ),
    )
    before = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("cap", F.col("source_size") * float(most))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * float(share))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    )
    # The first source that is not filled up sets the level for itself and all later ones.
    open_level = F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "source", "level"))).over(everything)
    return levels.withColumn("open", open_level).select(
        "source", "source_size",
        F.least("cap", F.coalesce(F.col("weight") * F.col("open.level"), F.col("cap"))).alias("target"),
    )


def fit_budget(sizes: list[int], counts: list[int], budget: int, exact_words: int = EXACT_WORDS) -> list[int]:
    """How many documents of each length to take so that their words come as near to the budget as they can.

    In proportion first, then longest first until `exact_words` are left, and a bounded
    subset-sum dynamic programme for the rest: bit b of `reach` says that b words can be had,
    up to twice what is left, as nothing beyond is nearer than taking none. Its cost is bounded
    by `exact_words` and the longest document, not by the corpus.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget >= total:
        return list(counts)
    if budget <= 0:
        return [0] * len(sizes)
    taken = [c * budget // total for c in counts]
    left = budget - sum(s * t for s, t in zip(sizes, taken))
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    for i in order:
        if left > exact_words:
            more = min(counts[i] - taken[i], (left - exact_words) // sizes[i])
            taken[i] += more
            left -= more * sizes[i]
    reach, everything, steps = 1, (1 << (2 * left + 1)) - 1, []
    for i in order:
        spare, part = min(counts[i] - taken[i], 2 * left // sizes[i]), 1
        while spare > 0 and not reach >> left & 1:
            part = min(part, spare)
            steps.append((reach, i, part))
            reach |= reach << part * sizes[i] & everything
            spare, part = spare - part, part * 2
    best = (reach & (1 << left + 1) - 1).bit_length() - 1
    over = reach >> left + 1
    if over and (over & -over).bit_length() < left - best:
        best = left + (over & -over).bit_length()
    for earlier, i, part in reversed(steps):
        if not earlier >> best & 1:
            taken[i] += part
            best -= part * sizes[i]
    return taken


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's table of lengths: whole rounds through all its documents, then a fitted part of one round."""
    pdf = pdf.sort_values("size")
    sizes, counts = pdf["size"].tolist(), pdf["docs"].tolist()
    total, target = sum(s * c for s, c in zip(sizes, counts)), float(pdf["target"].iloc[0])
    rounds = int(target // total) if total else 0
    extra = fit_budget(sizes, counts, round(target) - rounds * total) if total else [0] * len(sizes)
    return pdf[["source", "size", "docs"]].assign(rounds=rounds, extra=extra)


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken, and columns to carry along.

    Counts documents by exact length, fits each source's budget on that table of lengths and
    then picks seeded documents of each length. A length's documents are dealt into slices by
    hash; slices under the cut are taken whole and one slice is ranked, so no length of no
    source is ranked in one task.

    Null text has size 0. A null source is a source of its own, the last. Null or repeated
    doc_ids are rows like others (rows equal in doc_id and size may swap places). Documents
    without words are taken with the whole rounds of their source, never as extra. An empty
    table gives an empty result. Columns other than doc_id, text and source are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = work_folder(spark, "mixing")
    sizes = written(
        docs.select(
            "doc_id", "source", *carry,
            F.coalesce(F.expr(f"cast(regexp_count(text, r'{WORD}') AS bigint)"), F.lit(0).cast("long")).alias("size"),
            F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(SLICES)).cast("int").alias("slice"),
        ),
        folder, "sizes",
    )
    targets = written(source_targets(sizes, weights, share, most), folder, "targets")
    lengths = sizes.groupBy("source", "size").agg(F.count("*").alias("docs")).alias("l")
    plan = written(
        lengths.join(targets.alias("t"), F.col("l.source").eqNullSafe(F.col("t.source")))
        .select("l.source", "size", "docs", "target")
        .groupBy("source")
        .applyInPandas(_fit_source, "source string, size long, docs long, rounds int, extra long"),
        folder, "plan",
    )
    slices = sizes.groupBy("source", "size", "slice").agg(F.count("*").alias("docs"))
    upto = Window.partitionBy("source", "size").orderBy("slice")
    cuts = (
        slices.withColumn("upto", F.sum("docs").over(upto)).alias("s")
        .join(plan.filter("extra > 0").alias("p"),
              F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.size") == F.col("p.size")))
        .filter("upto >= extra AND upto - s.docs < extra")
        .select("p.source", "p.size", F.col("slice").alias("cut"), (F.col("extra") - F.col("upto") + F.col("s.docs")).alias("ranks"))
        .alias("c")
    )
    p = plan.alias("p")
    decided = written(
        p.join(cuts, F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.size") == F.col("c.size")), "left")
        .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        .select("p.source", "p.size", "rounds", "source_size", "target",
                F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("ranks", F.lit(0).cast("long")).alias("ranks")),
        folder, "decided",
    ).alias("d")
    same = F.col("z.source").eqNullSafe(F.col("d.source")) & (F.col("z.size") == F.col("d.size"))
    columns = ["doc_id", F.col("z.source"), F.col("z.size"), "source_size", "target", *carry]
    whole = sizes.alias("z").join(decided, same & (F.col("slice") != F.col("cut"))).select(
        *columns, (F.col("rounds") + (F.col("slice") < F.col("cut")).cast("int")).alias("copies"))
    rank = F.row_number().over(
        Window.partitionBy("z.source", "z.size", "slice").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id"))
    ranked = (
        sizes.alias("z").join(decided, same & (F.col("slice") == F.col("cut")))
        .withColumn("rank", rank)
        .select(*columns, (F.col("rounds") + (F.col("rank") <= F.col("ranks")).cast("int")).alias("copies"))
    )
    return whole.unionByName(ranked).withColumn("taken", F.col("copies") * F.col("size"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")
