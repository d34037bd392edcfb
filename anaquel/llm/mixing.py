"""Mixing sources to target weights by an exact splitting of block quotas among shards.

Texts are cut into blocks of words. Each source's target says how many whole passes and how many
blocks of a last, partial pass it gives; the blocks follow a hash permutation of the source. The
resulting quotas are split among the shards as a tree of multivariate-hypergeometric draws would
split them: every slot carries a random key, a node sends the lower half of its slots by key to the
left, so a shard is a run of ranks of the whole permutation, and its quota vector is the count of
its slots by source. Each shard then draws its own run of every source's permuted blocks, and what
the mix takes of a document is the sum of what the shards draw of it.

DataFrame functions only. Ranks are taken in two levels (counts per key range, then rows within a
range), so no source and no shard has to fit one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.llm.common import WORD, stored, text_key

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 64
SHARDS = 16
RANGE_ROWS = 5_000  # rows of a key range on average
GROUP_RANGES = 4096  # ranges whose offsets are summed together
_KEY_BITS = 60


@dataclass
class Mix:
    """``draws``: one row per block drawn: doc_id, text_hash, copy, source, block, pass, words, shard, order.

    ``documents``: one row per input row: doc_id, text_hash, copy, source, size, source_size, target,
    taken, shards (how many draw from it). ``quotas``: blocks by source and shard. ``copy`` tells equal rows apart.
    """

    documents: DataFrame
    draws: DataFrame
    quotas: DataFrame


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: all words shared by weight, none above three times its size.

    The weights go round the sources in code-point order, null last. A source is full if the level
    (words per unit of weight) that is left for it and all with a higher ratio of limit to weight
    reaches its limit. One row per source; that list alone passes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("_n") % len(WEIGHTS) + 1).cast("int")
    )
    base = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("_n", F.row_number().over(order) - 1)
        .withColumn("_w", weight.cast("decimal(38,0)"))
        .withColumn("_cap", (F.col("source_size") * MAX_PASSES).cast("decimal(38,0)"))
    )
    by_ratio = Window.orderBy(F.col("_cap").cast("double") / F.col("_w").cast("double"), "_n")
    everything = Window.partitionBy(F.lit(1))
    number = "decimal(38,0)"
    left = (F.col("_total") - F.col("_caps")).cast(number)
    filled = (
        base.withColumn("_total", F.sum("source_size").over(everything).cast(number))
        .withColumn("_weights", F.sum("_w").over(everything).cast(number))
        .withColumn("_caps", (F.sum("_cap").over(by_ratio) - F.col("_cap")).cast(number))
        .withColumn(
            "_rest", (F.col("_weights") - F.sum("_w").over(by_ratio) + F.col("_w")).cast(number)
        )
        .withColumn("_full", F.col("_cap") * F.col("_rest") <= left * F.col("_w"))
        .withColumn(
            "_free",
            F.col("_total") - F.coalesce(
                F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0)
            ),
        )
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything))
    )
    return filled.select(
        "source", "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double"))
        .otherwise(
            (F.col("_free").cast("double") * F.col("_w").cast("double"))
            / F.col("_open").cast("double")
        ).alias("target"),
    )


def _key(*parts: Column) -> Column:
    """60 random bits from the parts, equal in every run."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _KEY_BITS // 4), 16, 10).cast("long")


def _ranked(
    rows: DataFrame, group: list[str], key: str, ties: list[str], width: int, words: bool
) -> DataFrame:
    """Adds ``_rank`` (from 0) in the order of key and ties within a group, ``_before`` the words
    of the rows before. A key range holds about ``RANGE_ROWS`` rows. Offsets of ranges are summed in two
    levels, so that what one task sums is short whatever the number of ranges."""
    rows = rows.withColumn("_range", (F.col(key) / F.lit(width)).cast("long"))
    at = [*group, "_range"]
    aggregates = [F.count("*").alias("_rows")]
    aggregates += [F.sum("words").alias("_words")] if words else []
    part = (F.col("_range") / GROUP_RANGES).cast("long")
    sums = rows.groupBy(*at).agg(*aggregates).withColumn("_part", part)
    totals = [F.sum("_rows").alias("_rows"), *([F.sum("_words").alias("_words")] if words else [])]
    measures = ["_rows", *(["_words"] if words else [])]
    upper = Window.partitionBy(*group).orderBy("_part")
    lower = Window.partitionBy(*group, "_part").orderBy("_range")
    parts = sums.groupBy(*group, "_part").agg(*totals).select(
        *[F.col(c).alias(f"_u{c}") for c in (*group, "_part")],
        *[(F.sum(m).over(upper) - F.col(m)).alias(f"_u{m}") for m in measures],
    )
    within = sums.select(
        *at, "_part", *[(F.sum(m).over(lower) - F.col(m)).alias(m) for m in measures]
    )
    aligned = [F.col(c).eqNullSafe(F.col(f"_u{c}")) for c in (*group, "_part")]
    named = {"_rows": "_offset", "_words": "_passed"}
    offsets = within.join(parts, on=aligned).select(
        *[F.col(c).alias(f"_o{c}") for c in at],
        *[(F.col(m) + F.col(f"_u{m}")).alias(named[m]) for m in measures],
    )
    inside = Window.partitionBy(*at).orderBy(key, *ties)
    rows = rows.withColumn("_in", F.row_number().over(inside) - 1)
    if words:
        running = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("_sofar", running - F.col("words"))
    same = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in at]
    joined = rows.join(offsets, on=same).withColumn("_rank", F.col("_offset") + F.col("_in"))
    if words:
        joined = joined.withColumn("_before", F.col("_passed") + F.col("_sofar"))
    return joined.drop(
        "_range", "_in", "_offset", "_passed", "_sofar", *[f"_o{c}" for c in at]
    )


def _width(rows: int) -> int:
    """Key values per range."""
    return max(1, (1 << _KEY_BITS) // max(1, -(-rows // RANGE_ROWS)))


def mix(
    docs: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = 0
) -> Mix:
    """Mix documents by source. Equal input and seed give equal draws.

    A null text has size 0 and gives no block; a null source is a source of its own. Equal rows
    are told apart by ``copy``. An empty table gives empty frames.
    """
    sizes = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), text_key("text").alias("text_hash"),
        F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 16).alias("_digest"),
    )
    row = ["doc_id", "source", "size", "text_hash", "_digest"]
    sizes = sizes.groupBy(*row).agg(F.count("*").alias("_copies"))
    sizes = sizes.select(*row, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("copy"))
    sizes = stored(sizes, "sizes")
    goals = stored(
        targets(sizes).withColumn(
            "_passes",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0).cast("int"),
        ),
        "targets",
    )
    goal = goals.withColumnRenamed("source", "_source")
    of_source = F.col("source").eqNullSafe(F.col("_source"))

    n_blocks = F.ceil(F.col("size") / F.lit(block_words))
    rows = sizes.agg(F.coalesce(F.sum(n_blocks), F.lit(0)).cast("long")).first()[0]
    blocks = (
        sizes.where("size > 0")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("block"))
        .withColumn(
            "words", F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words).cast("long")
        )
        # The text is part of the key: rows without doc_id, or with one in common, are dealt apart as well.
        .withColumn("_key", _key(F.col("doc_id"), F.col("_digest"), F.col("copy"), F.col("block"), F.lit(seed)))
        .drop("size", "_digest")
    )
    permuted = _ranked(
        blocks, ["source"], "_key", ["doc_id", "copy", "block", "text_hash"], _width(rows), words=True
    )
    # A last, partial pass takes the blocks whose middle lies below the words still to give.
    rest = F.col("target") - F.col("_passes") * F.col("source_size")
    passes = F.col("_passes") + (
        (F.col("_before") + F.col("words") / 2 <= rest) & (F.col("_passes") < MAX_PASSES)
    ).cast("int")
    slots = stored(
        permuted.join(goal, of_source)
        .withColumn("_n", passes).where("_n > 0")
        .select(
            "doc_id", "text_hash", "copy", "source", "block", "words", "_rank", "_key",
            F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("pass"),
        )
        .withColumn(
            "_urn",
            _key(F.col("_key"), F.col("pass"), F.lit(f"urn{seed}")),
        ),
        "slots",
    )

    total = slots.count()
    urn = _ranked(
        slots.select("source", "_urn", "doc_id", "copy", "block", "pass", "text_hash"),
        [], "_urn", ["doc_id", "copy", "block", "pass", "text_hash"], _width(total), words=False,
    )
    shard = F.floor(F.col("_rank") * F.lit(shards) / F.lit(max(total, 1))).cast("int")
    quotas = stored(
        urn.groupBy("source", shard.alias("shard")).agg(F.count("*").alias("blocks")), "quotas"
    )
    # Per source, the slot number at which each shard's run ends.
    ends = (
        quotas.withColumn(
            "_end", F.sum("blocks").over(Window.partitionBy("source").orderBy("shard"))
        )
        .groupBy(F.col("source").alias("_source"))
        .agg(F.sort_array(F.collect_list(F.struct("_end", "shard"))).alias("_ends"))
    )
    counts = blocks.groupBy(F.col("source").alias("_of")).agg(F.count("*").alias("_blocks"))
    slot = (F.col("pass") - 1) * F.col("_blocks") + F.col("_rank")
    run = F.element_at(F.filter("_ends", lambda e: e["_end"] > F.col("_slot")), 1)
    draws = (
        slots.join(counts, F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_slot", slot)
        .join(ends, of_source)
        .select(
            "doc_id", "text_hash", "copy", "source", "block", "pass", "words",
            run["shard"].alias("shard"), F.col("_urn").alias("order"),
        )
        .where("shard IS NOT NULL")  # no shard draws beyond the quotas
    )
    taken = draws.groupBy("doc_id", "text_hash", "copy", "source").agg(
        F.sum("words").alias("taken"), F.size(F.collect_set("shard")).alias("shards")
    )
    taken = taken.select(*[F.col(c).alias(f"_t{c}") for c in taken.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_t{c}")) for c in ("doc_id", "text_hash", "copy", "source")]
    mixed = (
        sizes.join(goal, of_source)
        .join(taken, on=same, how="left")
        .select(
            "doc_id", "text_hash", "copy", "source", "size", "source_size", "target",
            F.coalesce("_ttaken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("_tshards", F.lit(0)).cast("long").alias("shards"),
        )
    )
    return Mix(mixed, draws, quotas)


def write_shards(mixed: Mix, path: str) -> None:
    """The draws as one folder per shard, each shuffled within itself by its slots' random keys."""
    (
        mixed.draws.repartition("shard", F.pmod(F.col("order"), F.lit(64)))
        .sortWithinPartitions("shard", "order")
        .write.partitionBy("shard").parquet(path)
    )


def mixed_rows(docs: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, with all their columns and ``size, source_size, target, taken``.

    A document of which the mix takes nothing is left out. Columns of ``docs`` that have one of the
    four names give way.
    """
    added = ["size", "source_size", "target", "taken"]
    mixed = stored(mix(docs, shards, block_words).documents.drop("shards"), "mix").where("taken > 0")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]).alias("row"),
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), text_key("text").alias("_t"),
    )
    if mixed.where("copy > 1").head(1):  # equal rows: one of them meets all copies
        rows = rows.groupBy("_d", "_s", "_t").agg(F.any_value("row").alias("row"))
    same = (
        F.col("_d").eqNullSafe(F.col("doc_id")) & F.col("_s").eqNullSafe(F.col("source"))
        & (F.col("_t") == F.col("text_hash"))
    )
    return rows.join(mixed, same).select("row.*", *added)
