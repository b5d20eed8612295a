"""The secret scan against Python's regular expressions, and its randomness tests."""

import base64
import hashlib
import random
import re

from llm.helpers import frame
from pyspark.sql import functions as F
from stratus.llm import secrets

PATTERNS = {
    "assign": (re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                          r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
               lambda m: len(m[2]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32)}


def base_spans(text):
    rows = [(m.start(), rank, m.end(), kind) for rank, (kind, (p, ok)) in enumerate(PATTERNS.items())
            for m in p.finditer(text or "") if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(rows)]


def rough(rng):
    parts = ["token", "TOKEN", "Secret", "api_key", "APIKEY", "passwd", "password", "=", ":", " ", "  ", '"', "'",
             "=", "é", "\U0001F600", "\n", "AKIA", "AKIA" + "Z9" * 7, "0af" * 11, "f" * 31, "abc.def", "x-/+_=", "12345678",
             "AKIAAKIAAKIAAKIA", "hexdeadbeef" * 4, ".", "word word"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))


def test_base_spans_equal_python(spark):
    rng = random.Random(3)
    texts = [None, "", "token=\"" + "a" * 50_000 + "\"", "f" * 70_000, "token = " * 3000, "AKIA" * 9] + [rough(rng) for _ in range(150)]
    rows = {r.doc_id: r for r in secrets.find_secrets(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(
            sum(w.startswith(k) for w in want) for k in PATTERNS)
        assert set(want) <= set(filter(None, rows[i].spans.split(",")))
    assert sum(r.n_assign > 0 for r in rows.values()) > 20 and any(r.n_hex > 1 for r in rows.values())


def test_random_strings_are_told_from_words(spark):
    rng = random.Random(8)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    words = ["".join(rng.choice(syllables) for _ in range(14)) for _ in range(400)]
    keys = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(40)]
    names = [f"{w[:20]}{k}" for k, w in enumerate(words[:40])]
    texts = [f"{a} {b}" for a, b in zip(words[40:], words[80:])] + [f"see {k} there" for k in keys] + [f"see {n} there" for n in names]
    rows = secrets.find_secrets(frame(spark, texts)).orderBy("doc_id").collect()
    assert sum(r.n_random for r in rows[-80:-40]) >= 36
    assert sum(r.n_random for r in rows[:-80]) + sum(r.n_random for r in rows[-40:]) <= 2


def test_a_key_is_found_in_a_table_without_long_words(spark):
    keys = ["q7Rk2VxT9mZbL4wPc8YdHs3NfJ6uGaE1oXi5tKvB", "11acdfb36bb72224148e6160f674", "QxvRzKpWmTbNcLdGhJfYsVkZqXwPnMtRbHgDjLcF"]
    for key in keys:
        rows = secrets.find_secrets(frame(spark, [None, f"see {key} there", "some short words"])).orderBy("doc_id").collect()
        assert [r.n_random for r in rows] == [0, 1, 0], key
        assert rows[1].spans == f"random:4:{4 + len(key)}"


def test_a_run_of_letters_in_a_third_of_the_rows_hides_no_keys(spark):
    rng = random.Random(1)
    keys = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(40)]
    texts = [f"see {k} there" for k in keys] + ["see QxvRzKpWmTbNcLdGhJfY there"] * 60 + ["nothing here"] * 80
    rows = secrets.find_secrets(frame(spark, texts)).orderBy("doc_id").collect()
    assert sum(r.n_random for r in rows[:40]) >= 36
    assert sum(r.n_random for r in rows[100:]) == 0


def test_copies_of_a_word_count_once(spark):
    key, word = "q7Rk2VxT9mZbL4wPc8YdHs3NfJ6uGaE1oXi5tKvB", "understandingofthewordsthatwerewrittendown"
    for copies in (1, 3000):
        rows = secrets.find_secrets(frame(spark, [f"see {key}"] + [f"see {word}"] * copies)).orderBy("doc_id").collect()
        assert rows[0].n_random == 1 and sum(r.n_random for r in rows[1:]) == 0


def test_text_seldom_passes_for_random(spark):
    rng = random.Random(6)
    syllables = ["lich", "keit", "er", "tion", "on", "ment", "qu", "el", "schen", "th", "is", "ver", "an", "ble"]
    ways = [lambda w: w, str.upper, lambda w: w.title(), lambda w: w + "-", lambda w: w + str(rng.randint(1, 99))]
    texts = []
    for way in ways:
        for size in (20, 24, 33, 50, 120):
            texts += [("".join(way("".join(rng.choice(syllables) for _ in range(3))) for _ in range(30))[:size], size) for _ in range(60)]
    p = [r[0] for r in spark.createDataFrame(texts, "t string, size int").select(secrets.textness(F.col("t"))).collect()]
    assert sum(x <= 0.05 for x in p) / len(p) <= 0.05 and min(p) > 1e-5


def test_p_values_are_even_for_random_tokens(spark):
    rng = random.Random(2)
    tokens = [("".join(rng.choice("0123456789abcdef") for _ in range(40)),) for _ in range(600)]
    p = [r[0] for r in spark.createDataFrame(tokens, "t string").select(secrets.randomness(F.col("t"))).collect()]
    assert 0.4 < sum(p) / len(p) < 0.6 and 0.02 < sum(x < 0.1 for x in p) / len(p) < 0.2


def test_empty_table(spark):
    assert secrets.find_secrets(frame(spark, [])).count() == 0
