"""Secret scan with a battery of randomness tests.

Base spans are matches of three fixed patterns. The method adds *random* spans: runs of
token characters with a letter, with or without digits, that look drawn at random from the
alphabet of their encoding. For every run the encoding is inferred (hex, base 32, base 64) and
three tests give p-values under randomness: chi-squared uniformity over the alphabet, runs above
and below its middle, and serial correlation. Fisher's method combines them; text, however
odd, scores low.

A fixed text model turns that score into a p-value under text: the normal tail fitted to strings
of common words of the same length, encoding and case (``scripts/fit_text_model.py``). It is the
same in every table, so no table is too small or has too few long words for it. False
discoveries are controlled by length: in every length band Benjamini and Hochberg's rule at
``alpha`` runs over the distinct tokens of the whole table, so a token copied into many rows counts once.

All native columns, no Python on the executors. Defined results: a null or empty text has no
spans; null and repeated ids keep their rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import saved, whole_text
from stratus.llm.spans import described, overlaps, with_spans

_KEY = r"(?i:password|passwd|secret|token|api_?key)"
_ASSIGN = _KEY + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: A run of token characters; what precedes it is none, so that it starts at its first one.
_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"

_ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: Bins of the p-value under text in the counts, a hundred for every power of ten.
BINS = 1000
#: Median and spread of the normal score of text at 0, 8, 16, ... 96 characters, the worst way of writing.
_TEXT = {
    "hex": ((-1.59, 1.29), (-2.87, 1.38), (-4.5, 1.23), (-5.79, 1.16), (-6.84, 1.15), (-7.73, 1.19), (-8.4, 1.03), (-8.92, 1.0), (-9.34, 1.0), (-9.69, 1.0), (-10.03, 1.0), (-10.31, 1.0), (-10.5, 1.0)),
    "base32": ((0.48, 1.0), (-0.18, 1.0), (-0.75, 1.01), (-1.47, 1.05), (-2.22, 1.06), (-2.87, 1.05), (-3.54, 1.0), (-4.15, 1.0), (-4.67, 1.0), (-5.18, 1.0), (-5.68, 1.0), (-6.09, 1.0), (-6.32, 1.0)),
    "one_case": ((0.9, 1.0), (-0.49, 1.0), (-1.81, 1.0), (-3.09, 1.0), (-4.34, 1.0), (-5.51, 1.0), (-6.04, 1.0), (-6.06, 1.0), (-6.07, 1.0), (-6.08, 1.0), (-6.08, 1.0), (-6.09, 1.0), (-6.09, 1.0)),
    "mixed_case": ((0.93, 1.0), (0.07, 1.0), (-0.51, 1.0), (-1.44, 1.08), (-2.45, 1.17), (-3.4, 1.15), (-4.28, 1.14), (-5.09, 1.1), (-5.79, 1.05), (-6.1, 1.0), (-6.24, 1.0), (-6.32, 1.0), (-6.37, 1.0)),
}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _upper_normal(z: Column) -> Column:
    """P(Z > z), by the rational approximation of the error function (error under 2e-7)."""
    factors = (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)

    def tail(x: Column) -> Column:
        return _let(1 / (1 + 0.3275911 * x), lambda t: F.aggregate(
            F.array(*map(F.lit, factors)), F.lit(0.0), lambda acc, c: acc * t + c) * t * F.exp(-x * x))

    return _let(z, lambda z: _let(tail(F.abs(z) / math.sqrt(2)) / 2, lambda p: F.when(z >= 0, p).otherwise(1 - p)))


def _chi2_score(x: Column, df: int) -> Column:
    """The normal score of chi-squared by the cube-root approximation."""
    spread = 2 / (9 * df)
    return (F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / math.sqrt(spread)


def _canonical(token: Column) -> Column:
    """Upper-case hex as lower-case, URL-safe base 64 as the plain one, without padding."""
    plain = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    return F.when(plain.rlike("^[0-9A-F]+$"), F.lower(plain)).otherwise(plain)


def _encoding(token: Column) -> Column:
    return (F.when(token.rlike("^[0-9a-f]+$"), "hex").when(token.rlike("^[A-Z2-7]+$"), "base32").otherwise("base64"))


def _battery(places: Column, alphabet: int) -> Column:
    """The normal score of Fisher's combination of the three tests, over a token's two or more places
    in an alphabet of even size: standard normal for random tokens, low for text."""
    n = F.size(places)
    squares = F.aggregate(F.sequence(F.lit(0), F.lit(alphabet - 1)), F.lit(0.0), lambda acc, c: acc + F.pow(
        F.size(F.filter(places, lambda p: p == c)).cast("double"), F.lit(2.0)))
    uniform = _upper_normal(_chi2_score(squares * alphabet / n - n, alphabet - 1))

    middle, variance = (alphabet - 1) / 2, (alphabet ** 2 - 1) / 12
    former, latter = F.slice(places, 1, n - 1), F.slice(places, 2, n - 1)

    def over_pairs(value) -> Column:
        return F.aggregate(F.zip_with(former, latter, value), F.lit(0.0), lambda acc, x: acc + x)

    turns = over_pairs(lambda p, q: F.when((p > middle) != (q > middle), 1.0).otherwise(0.0))
    runs = 2 * _upper_normal(F.abs(turns - (n - 1) / 2) / (F.sqrt(n - 1) / 2))
    product = over_pairs(lambda p, q: (p - middle) * (q - middle))
    serial = 2 * _upper_normal(F.abs(product / variance / F.sqrt(n - 1)))

    least = F.lit(1e-12)
    logs = F.log(F.greatest(uniform, least)) + F.log(F.greatest(runs, least)) + F.log(F.greatest(serial, least))
    return -_chi2_score(-2 * logs, 6)


def _score(token: Column) -> Column:
    """The battery's normal score by the token's inferred encoding, null with less than two places."""
    def battery(name: str, text: Column) -> Column:
        alphabet = _ALPHABETS[name]
        chars = F.filter(F.split(text, ""), lambda ch: ch != "")
        places = F.transform(chars, lambda ch: F.instr(F.lit(alphabet), ch) - 1)
        return _let(F.filter(places, lambda p: p >= 0), lambda known: F.when(
            F.size(known) >= 2, _battery(known, len(alphabet))))

    return _let(_canonical(token), lambda text: F.when(_encoding(text) == "hex", battery("hex", text))
                .when(_encoding(text) == "base32", battery("base32", text)).otherwise(battery("base64", text)))


def randomness(token: Column) -> Column:
    """The combined p-value of the tests under randomness, by the token's inferred encoding."""
    return F.coalesce(_upper_normal(-_score(token)), F.lit(0.0))


def textness(token: Column) -> Column:
    """The p-value of the combined tests under the fixed text model of the token's length, encoding and case."""
    def at(text: Column, moment: int, step: Column) -> Column:
        table = {k: F.array(*(F.lit(float(m[moment])) for m in rows)) for k, rows in _TEXT.items()}
        one_case = ~(text.rlike("[a-z]") & text.rlike("[A-Z]"))
        rows = (F.when(_encoding(text) == "hex", table["hex"]).when(_encoding(text) == "base32", table["base32"])
                .when(one_case, table["one_case"]).otherwise(table["mixed_case"]))
        return F.element_at(rows, step + 1)

    last = len(_TEXT["hex"]) - 1

    def fitted(text: Column, moment: int) -> Column:
        place = F.least(F.length(text) / 8, F.lit(float(last)))
        step = F.least(F.floor(place).cast("int"), F.lit(last - 1))
        return at(text, moment, step) + (place - step) * (at(text, moment, step + 1) - at(text, moment, step))

    return F.coalesce(_let(_canonical(token), lambda text: _upper_normal((_score(token) - fitted(text, 0)) / fitted(text, 1))), F.lit(1.0))


def _band(size: Column) -> Column:
    return F.least(F.floor(size / 8).cast("int"), F.lit(12))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-100 * F.log10(F.greatest(p, F.lit(1e-300)))).cast("int"), F.lit(BINS - 1))


def thresholds(tokens: DataFrame, alpha: float) -> dict[int, int]:
    """The smallest reported bin of each length band, by Benjamini and Hochberg; bands without any are left out.

    ``tokens``: ``band, bin``, one row for each distinct token. How many of a band are text is told from
    those with a p-value over a half (Storey's estimate); nothing over ``alpha`` is ever reported.
    """
    # at most 13 bands of BINS rows
    rows = tokens.groupBy("band", "bin").count().collect()
    out = {}
    for band in sorted({r["band"] for r in rows}):
        own = [(r["bin"], r["count"]) for r in rows if r["band"] == band]
        words = min(sum(n for _, n in own), 2 * (1 + sum(n for b, n in own if b <= 30)))
        for low in range(BINS):
            share, passed = 10 ** (-low / 100), sum(n for b, n in own if b >= low)
            if passed and share <= alpha and share * words <= alpha * passed:
                out[band] = low
                break
    return out


def find_secrets(docs: DataFrame, alpha: float = 0.05, min_length: int = 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Id, the spans ``assign, access, hex, random`` (arrays of start, end, hit), counts and digests."""
    lowered = F.lower("_text")
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    found = with_spans(texts, "_text", {
        "assign": (_ASSIGN, lowered.rlike("password|passwd|secret|token|api_?key")),
        "access": (r"AKIA[A-Z0-9]{12,}+", F.contains("_text", F.lit("AKIA"))),
        "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}+", F.lit(True)),
        "run": (_RUN % min_length, F.lit(True))}).drop("_text")
    long_enough = F.filter("assign", lambda s: F.length(F.regexp_extract(s["hit"], "^" + _ASSIGN + "$", 1)) >= 8)
    found = found.withColumn("assign", long_enough)

    tested = F.transform(F.filter("run", lambda s: s["hit"].rlike("[A-Za-z]")), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), _bin(textness(s["hit"])).alias("bin")))
    found = saved(found.withColumn("run", tested), "secret-spans")

    # copies of a token count once; a token is named by its digest
    tokens = found.select(F.explode("run").alias("t")).select(
        F.md5("t.hit").alias("name"), _band(F.length("t.hit")).alias("band"), "t.bin").distinct()
    least = thresholds(tokens, alpha)
    bands = F.create_map(*(F.lit(x) for pair in least.items() for x in pair)) if least else None

    def random(s: Column) -> Column:
        if bands is None:
            return F.lit(False)
        base = F.concat("assign", "access", "hex")
        return F.coalesce(s["bin"] >= F.element_at(bands, _band(F.length(s["hit"]))), F.lit(False)) & ~overlaps(s, base)

    found = found.withColumn("random", F.transform(F.filter("run", random), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"))))
    base = {k: F.col(k) for k in ("assign", "access", "hex")}
    return found.select(
        F.col("_id").alias(id_col), *base, "random",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in (*base, "random")),
        F.sha2(described(base), 256).alias("base_sha256"),
        described(base | {"random": F.col("random")}).alias("spans"))
