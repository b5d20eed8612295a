"""Spans of regular expressions as native columns: arrays of ``start, end, hit`` in code points.

``split`` and ``regexp_extract_all`` see the same leftmost, non-overlapping matches, so the
pieces between the matches and the matches' lengths give the places. Prefix sums run in
chunks, which keeps a text with very many matches near linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK = 256


def _running(lengths: Column) -> Column:
    """The sums before each element of an array of ints."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")),
                         lambda c: F.slice(lengths, c * _CHUNK + 1, _CHUNK))
    none = F.array().cast("array<int>")

    def before(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("sum"), none.alias("out"))
        return F.aggregate(values, start, lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")), lambda acc: acc["out"])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda acc, x: acc + x)

    firsts = before(F.transform(chunks, total), F.lit(0))
    return F.when(F.size(lengths) == 0, none).otherwise(
        F.flatten(F.zip_with(chunks, firsts, lambda chunk, first: before(chunk, first))))


_SPANS = "array<struct<start:int,end:int,hit:string>>"


def with_spans(df: DataFrame, text: str, kinds: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds a column of spans for every kind: all matches of its pattern, which are never empty.

    With each pattern comes a cheap test that any text with a match passes. The columns are
    built in steps, so that no pattern runs twice over a text.
    """
    kept, none = df.columns, F.array().cast("array<string>")
    df = df.withColumns({f"_hits_{k}": F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
                         for k, (pattern, maybe) in kinds.items()})
    df = df.withColumns({f"_gaps_{k}": F.when(F.size(f"_hits_{k}") > 0, F.transform(
        F.split(text, pattern, -1), lambda p: F.length(p))) for k, (pattern, _) in kinds.items()})
    df = df.withColumns({f"_both_{k}": F.zip_with(F.slice(f"_gaps_{k}", 1, F.size(f"_hits_{k}")), F.transform(
        f"_hits_{k}", lambda h: F.length(h)), lambda g, n: g + n) for k in kinds})
    df = df.withColumns({f"_before_{k}": F.when(F.size(f"_hits_{k}") > 0, _running(F.col(f"_both_{k}"))) for k in kinds})

    def spans(k: str) -> Column:
        rows = F.arrays_zip(F.col(f"_hits_{k}").alias("hit"), F.col(f"_both_{k}").alias("both"),
                            F.col(f"_before_{k}").alias("before"))
        return F.when(F.size(f"_hits_{k}") > 0, F.transform(rows, lambda x: F.struct(
            (x["before"] + x["both"] - F.length(x["hit"])).alias("start"), (x["before"] + x["both"]).alias("end"),
            x["hit"].alias("hit")))).otherwise(F.array().cast(_SPANS))

    return df.select(*kept, *(spans(k).alias(k) for k in kinds))


def described(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, then end; comma-joined."""
    def ranked(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                     s["end"].alias("end"), F.lit(kind).alias("kind")))

    parts = [ranked(rank, kind, spans) for rank, (kind, spans) in enumerate(kinds.items())]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))
