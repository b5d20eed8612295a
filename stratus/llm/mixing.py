"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words by weighted water filling. A source first
gives complete epochs of itself; what is left of its target is filled from its documents
in the order of exponential keys ``-ln(u) / weight``, ``u`` a hash of the document: the
Efraimidis-Spirakis order, in which heavier documents come early. Prefix sums over that
order stop at the budget, and the document that crosses it gives only its first words.

Within a source the order is cut into key ranges: the prefix sums of the range totals give
the one range in which the budget ends, and only that range is ordered, equal rows as one.
So a source is settled by its cut, one row: every document compares its own place in the
order with it, and no text is sorted or dealt by source.

Defined results: null texts have size 0 and take 0 words; a null source is one source,
the last; null ids and repeated rows take part as rows of their own (equal keys fall back
on id, then size; rows equal in all three at the cut share the words left in equal whole parts,
less than one word a row unused); an empty table gives an empty result; a null, missing or non-positive
weight counts as the smallest weight. Columns of the input named like a result column are replaced by it;
names that begin with ``_x4_`` are reserved.

``mix_sources`` gives the decision for every document, without texts; ``mix_documents`` gives the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import saved, whole_text

#: No source gives more than so many times its size.
MAX_EPOCHS = 3
#: Ranges of the key order of a source; a range holds about 1 / RANGES of its rows.
RANGES = 256


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    words = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def uniform(id_col: Column, seed: int = 0) -> Column:
    """A number in (0, 1) fixed by the id: 52 bits of its MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def source_key(source: Column) -> Column:
    """A key without nulls in the code point order of the sources, null last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("z"))


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``weight``: 1, 2, 3, repeating in the order of the source keys. One row per source."""
    place = F.row_number().over(Window.orderBy("_x4_source")) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(c) for c in cycle]), place % len(cycle) + 1))


def fill_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target``: all words shared by weight, stopped at ``max_epochs`` sizes, excess reshared.

    The result of resharing is the level ``x`` with ``sum(min(cap, x * weight)) = total``;
    sources reach their caps in the order of ``cap / weight``. With the first k at their
    caps the others' level is ``(total - their caps) / other weights``; it falls from the
    first k that fits on, so the largest fitting level is the answer.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), "_x4_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    cap, own = F.col("cap").cast("double"), F.col("level") * F.col("weight")
    return (sources.withColumn("cap", F.col("source_size") * max_epochs)
            .withColumn("level", level.cast("double"))
            .withColumn("level", F.max(F.when(own <= cap, F.col("level"))).over(everything))
            .withColumn("target", F.round(F.least(cap, own), 6))
            .drop("cap", "level"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS,
                seed: int = 0) -> DataFrame:
    """The decision: the columns of ``docs`` but the text, and ``size, source_size, target, taken``.

    ``weights``: the documents' quality weights, ``id_col, weight`` with one row per id
    (default: all equal). They meet the documents' sizes, not their texts.
    """
    rest = [c for c in docs.columns if c not in (text_col, "size", "source_size", "target", "taken")]
    weights = _weights(weights, id_col)
    sized = saved(_sized(docs, rest, weights, id_col, text_col, source_col, seed), "sizes")
    return _taken(sized, _cuts(sized, cycle, max_epochs)).select(*rest, "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS,
                  seed: int = 0) -> DataFrame:
    """The mix: the columns of ``docs`` and of the decision, and ``repeats, first_words``.

    A document gives its text ``repeats`` times and then ``first_words``, the text up to where its source's
    budget ends. The text is null where ``repeats`` is 0, ``first_words`` where nothing is cut; both are
    null in a document that the mix does not take.
    """
    added = ("size", "source_size", "target", "taken", "repeats", "first_words")
    rest = [c for c in docs.columns if c not in (text_col, *added)]
    weights = _weights(weights, id_col)
    cuts = _cuts(saved(_sized(docs, [], weights, id_col, text_col, source_col, seed), "sizes"), cycle, max_epochs)
    # the text travels under a name of its own, so that the decision's own columns can replace any other
    texts = docs.withColumn("_x4_text", whole_text(text_col))
    out = _taken(_sized(texts, [*rest, "_x4_text"], weights, id_col, text_col, source_col, seed), cuts)
    size, taken = F.greatest(F.col("size"), F.lit(1)), F.col("taken")
    left = taken - F.col("repeats") * size
    return (out.withColumn("repeats", F.floor(taken / size).cast("long"))
            .withColumn("first_words", F.when(left > 0, first_words(F.col("_x4_text"), left)))
            .withColumn("_x4_text", F.when(F.col("repeats") > 0, F.col("_x4_text")))
            .select(*(F.col("_x4_text").alias(text_col) if c == text_col else F.col(c)
                      for c in docs.columns if c == text_col or c in rest), *added))


def _weights(weights: DataFrame | None, id_col: str) -> DataFrame | None:
    """The weights, written: the documents meet them twice, and every time the same ones."""
    if weights is None:
        return None
    return saved(weights.select(F.col(id_col).alias("_x4_weight_id"), F.col("weight").cast("double").alias("_x4_weight")), "weights")


def _sized(docs: DataFrame, rest: list[str], weights: DataFrame | None, id_col: str, text_col: str, source_col: str,
           seed: int) -> DataFrame:
    """The columns ``rest`` of ``docs`` with size, source and place in the source's order."""
    text = whole_text(text_col)
    sized = docs.select(*rest, word_count(text).alias("size"), source_key(F.col(source_col)).alias("_x4_source"),
                        F.col(id_col).alias("_x4_id"),
                        uniform(F.coalesce(F.col(id_col).cast("string"), F.md5(text)), seed).alias("_x4_u"))
    weight = F.lit(1.0)
    if weights is not None:
        # one weight per id: the weights grow with the documents, so they are not broadcast at any size
        sized = sized.join(weights.hint("merge"), F.col("_x4_id") == F.col("_x4_weight_id"), "left")
        weight = F.greatest(F.coalesce(F.col("_x4_weight"), F.lit(0.0)), F.lit(1e-6))
    # key / (1 + key) spreads exponential keys of common weights almost evenly over the ranges
    return (sized.withColumn("_x4_key", -F.log("_x4_u") / weight)
            .withColumn("_x4_range", F.floor(F.col("_x4_key") / (F.col("_x4_key") + 1) * RANGES).cast("int"))
            .select(*rest, "size", "_x4_source", "_x4_id", "_x4_key", "_x4_range"))


def _cuts(sized: DataFrame, cycle: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: its size, target and whole epochs, and the rows at which the rest of its budget ends.

    ``_x4_cut`` is the place of those rows in the order (null: the rest takes every row once), and
    ``_x4_share`` what each of them takes.
    """
    totals = saved(sized.groupBy("_x4_source", "_x4_range").agg(F.sum("size").alias("_x4_sum")), "ranges")
    sources = totals.groupBy("_x4_source").agg(F.sum("_x4_sum").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.round(F.col("target") - F.col("_x4_epochs") * F.col("source_size")).cast("long")
    targets = saved(fill_targets(cyclic_weights(sources, cycle), max_epochs).drop("weight")
                    .withColumn("_x4_epochs", epochs.cast("long")).withColumn("_x4_budget", budget), "targets")

    def before(column: str, order: list[str]) -> Column:
        rows = Window.partitionBy("_x4_source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(rows), F.lit(0))

    def ends(column: str) -> Column:
        return (F.col("_x4_left") >= 0) & (F.col("_x4_left") < F.col(column))

    last = (totals.withColumn("_x4_start", before("_x4_sum", ["_x4_range"])).join(targets, "_x4_source")
            .withColumn("_x4_left", F.col("_x4_budget") - F.col("_x4_start")).where(ends("_x4_sum"))
            .select("_x4_source", "_x4_range", F.col("_x4_left").alias("_x4_in_range")))
    place = ["_x4_key", "_x4_id", "size"]
    alike = (sized.join(saved(last, "last-ranges"), ["_x4_source", "_x4_range"])
             .groupBy("_x4_source", "_x4_in_range", *place).agg(F.count("*").alias("_x4_n"))
             .withColumn("_x4_words", F.col("_x4_n") * F.col("size"))
             .withColumn("_x4_left", F.col("_x4_in_range") - before("_x4_words", place)).where(ends("_x4_words"))
             .select("_x4_source", F.struct(*place).alias("_x4_cut"),
                     F.floor(F.col("_x4_left") / F.col("_x4_n")).cast("long").alias("_x4_share")))
    return saved(targets.drop("_x4_budget").join(alike, "_x4_source", "left"), "cuts")


def _taken(sized: DataFrame, cuts: DataFrame) -> DataFrame:
    """``sized`` with ``source_size, target, taken``. Written cuts are broadcast where their size allows it."""
    place = F.struct("_x4_key", "_x4_id", "size")
    part = (F.when(F.col("_x4_cut").isNull() | (place < F.col("_x4_cut")), F.col("size"))
            .when(place == F.col("_x4_cut"), F.col("_x4_share")).otherwise(F.lit(0)))
    return (sized.join(cuts, "_x4_source")
            .withColumn("taken", (F.col("_x4_epochs") * F.col("size") + part).cast("long")))
