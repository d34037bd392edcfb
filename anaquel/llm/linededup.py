"""Line dedup: lines that many documents share are dropped from all but one of them.

The lines are exploded, normalised and hashed (128 bits); distinct documents are counted per hash;
lines over the threshold are dropped; what is left is put together again by position. Only hashes,
ids and positions are shuffled for the count; each text moves once, to meet its dropped positions.

A line that a third of all documents hold is one row per map task in the count. The list of shared
lines is then stored and measured: up to ``LIST_BYTES`` it is broadcast and no line moves; a longer one is joined by
shuffle, where adaptive execution can split the partition of such a line, as both sides come straight from their shuffle.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.joins import fits
from anaquel.llm.common import SPACE, stored, text_key

MIN_CHARS = 40
MIN_DOCS = 5
LIST_BYTES = 16 << 20  # shared lines that are broadcast, measured


def line_key(line: Column) -> Column:
    """The line without white space at its ends, with ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), ascii_uppercase, ascii_lowercase)


def _dropped(base: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, _row, _dropped``: positions of the lines that go, of ``doc_id, text, _row``."""
    key = F.col("_key")
    lines = (
        base.where(F.col("doc_id").isNotNull())
        .select("doc_id", "_row", F.posexplode(F.split("text", "\n", -1)).alias("_pos", "_line"))
        .select("doc_id", "_row", "_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.char_length(key) >= min_chars)
        .select(
            "doc_id", "_row", "_pos",
            F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("second"), key).alias("_h2"),
        )
    )
    lines = stored(lines, "lines")
    shared = (
        lines.select("_h1", "_h2", "doc_id").distinct()
        .groupBy("_h1", "_h2").agg(F.count("*").alias("_docs"), F.max("doc_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", "_keeper")
    )
    shared = stored(shared, "shared_lines")
    side = F.broadcast(shared) if fits(shared, LIST_BYTES) else shared.hint("merge")
    return (
        lines.join(side, ["_h1", "_h2"])
        .where(F.col("doc_id") != F.col("_keeper"))
        .select("doc_id", "_row", "_pos").distinct()
        .groupBy("doc_id", "_row").agg(F.collect_set("_pos").alias("_dropped"))
    )


def _kept(text: Column) -> Column:
    """The text without the lines at the positions in ``_dropped``.

    The runs of lines between dropped ones are sliced out, so the work is that of the lines, however
    many of them go. The array of one struct is there to split the text once, not once per run.
    """
    lines = F.split(text, "\n", -1)
    cuts = F.concat(F.array(F.lit(-1)), F.array_sort("_dropped"), F.array(F.size(lines)))
    parts = F.transform(
        F.array(F.struct(lines.alias("lines"), cuts.alias("cuts"))),
        lambda t: F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(t["cuts"]) - 1),
            lambda i: F.slice(
                t["lines"], F.get(t["cuts"], i - 1) + 2, F.get(t["cuts"], i) - F.get(t["cuts"], i - 1) - 1
            ),
        )),
    )
    return F.when(F.col("_dropped").isNull(), text).otherwise(F.array_join(F.get(parts, F.lit(0)), "\n"))


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines except those in the largest ``doc_id`` holding them. A null or empty text is one
    empty line. A row without ``doc_id`` counts for no key and keeps all its lines. Rows with the same
    ``doc_id`` count as one document; each is cut by its own lines. Other columns are not read.
    """
    base = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key("text").alias("_row")
    )
    dropped = _dropped(base, min_chars, min_docs)
    return base.join(dropped, ["doc_id", "_row"], "left").select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        _kept(F.col("text")).alias("kept"),
    )


def without_repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``, and ``n_chars``, if there, counted anew.

    Every row stays; a text that loses nothing, null included, is as it was. Other columns pass,
    whatever their names.
    """
    base = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key("text").alias("_row")
    )
    dropped = _dropped(base, min_chars, min_docs).withColumnsRenamed({"doc_id": "_doc"})
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("_d"), text_key("text").alias("_t")
    )
    cut = rows.join(
        dropped, (F.col("_d") == F.col("_doc")) & (F.col("_t") == F.col("_row")), "left"
    )
    kept = _kept(F.coalesce(F.col("row.text"), F.lit("")))
    new = {"text": kept, "n_chars": F.char_length(kept)}
    return cut.select(*[
        F.when(F.col("_dropped").isNotNull(), new[f.name].cast(f.dataType))
        .otherwise(F.col(f"row.`{f.name}`")).alias(f.name)
        if f.name in new else F.col(f"row.`{f.name}`")
        for f in docs.schema
    ])
