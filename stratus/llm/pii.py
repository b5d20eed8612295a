"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans are valid matches of four fixed patterns (email, ip, card, phone); they always stay.
Candidates are all pattern matches, valid or not, and three kinds more: social security
numbers, bank accounts and names. On each candidate five labelers vote +1, -1 or abstain:

* check: the strict form (digit counts, check sums, number ranges);
* gazetteer: known mail domains, calling codes, issuers, countries, given names;
* cue: a word that announces the kind shortly before;
* clutter: signs of code or numbering around;
* shape: customary grouping for, degenerate digits against.

Expectation-maximisation estimates, without labels, how often each labeler votes which way
on true and false candidates, and each kind's share of true ones. The posteriors then train
a logistic span classifier on votes, kind and length. Candidates it accepts that touch no
base span are added: social security numbers, accounts and names under
their own kind, invalid matches of the base patterns as *suspect*.

Both fits run on counts of vote patterns, which cover all candidates of the table: one
aggregate whose result, at most 7 kinds x 3^5 votes x 4 lengths, the driver holds and fits. A
Spark job for each round of the fits would leave its plan and compiled code in the driver. All
native columns, no Python on the executors. Defined results: a null or empty
text has no spans; null and repeated ids keep their rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import saved, whole_text
from stratus.llm.spans import described, overlaps, with_spans

BASE = ("email", "ip", "card", "phone")
ADDED = ("ssn", "iban", "name")
LABELERS = ("check", "gazetteer", "cue", "clutter", "shape")

#: The contract's patterns. Possessive where a shorter match can't help, and tried only where a match may begin.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![\p{L}])\p{Lu}\p{Ll}++\.?+\x20\p{Lu}\p{Ll}++",
}

# What the gazetteer and cue labelers know.
_MAIL_DOMAINS = ("gmail", "yahoo", "hotmail", "outlook", "aol", "icloud", "gmx", "web", "mail", "proton", "example")
_CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                  "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81",
                  "82", "84", "86", "90", "91", "92", "351", "352", "353", "358", "380", "420", "971", "972")
_IBAN_COUNTRIES = ("AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE",
                   "IS", "IT", "LI", "LT", "LU", "LV", "MC", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK")
_GIVEN_NAMES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame", "Anna",
                "Carlos", "Charles", "David", "Elizabeth", "Emma", "Hans", "James", "Jan", "Jean", "Jennifer", "John",
                "José", "Juan", "Karl", "Laura", "Linda", "Luis", "Maria", "Marie", "María", "Mary", "Michael", "Paul",
                "Peter", "Pierre", "Robert", "Sarah", "Sophie", "Susan", "Thomas", "William")
_CUES = {"email": "mail|contact|write to", "ip": r"\bip\b|host|server|address|login", "card": "card|visa|master|amex|karte|tarjeta|carte",
         "phone": "phone|tel|call|fax|mobile|cell", "ssn": "ssn|social security", "iban": "iban|account|konto|cuenta|compte",
         "name": "name|dear|signed|sincerely|mr|mrs|dr"}


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        n = d.cast("int") * (i % 2 + 1)
        return n - F.when(n > 9, 9).otherwise(0)

    places = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    return F.aggregate(F.transform(places, value), F.lit(0), lambda acc, n: acc + n) % 10 == 0


def _remainder_97(account: Column) -> Column:
    """The check of a bank account number: its rearranged digits modulo 97."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    places = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(places, F.lit(0), lambda acc, c: F.when(
        c.rlike("[0-9]"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97)


def _valid(kind: str, hit: Column) -> Column:
    size = F.length(_digits(hit))
    return {
        "email": F.lit(True),
        "ip": hit.rlike(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$"),
        "card": size.between(12, 19) & _luhn(_digits(hit)),
        "phone": size.between(9, 15),
        "ssn": ~hit.rlike("^(000|666|9)|-00-|-0000$"),
        "iban": _remainder_97(hit) == 1,
        "name": F.lit(True),
    }[kind]


def _votes(kind: str, hit: Column, before: Column, after: Column) -> Column:
    """The labelers' votes on a candidate, in the order of ``LABELERS``."""
    def vote(yes: Column | None = None, no: Column | None = None) -> Column:
        out = F.lit(0)
        if no is not None:
            out = F.when(no, -1).otherwise(out)
        return F.when(yes, 1).otherwise(out) if yes is not None else out

    known = {
        "email": hit.rlike(r"(?i)@(" + "|".join(_MAIL_DOMAINS) + r")|\.(com|org|net|edu|de|fr|es)$"),
        "ip": None,
        "card": hit.rlike("^(4|5[1-5]|2[2-7]|3[47]|6011|65)"),
        "phone": hit.rlike(r"^\+(" + "|".join(_CALLING_CODES) + r")[^0-9]?"),
        "ssn": None,
        "iban": hit.rlike("^(" + "|".join(_IBAN_COUNTRIES) + ")"),
        "name": hit.rlike("^(" + "|".join(_GIVEN_NAMES) + r")\.? "),
    }[kind]
    unknown = {"ip": hit.rlike(r"^(0|10|127|192\.168|255)\."), "email": None, "phone": None, "ssn": None}.get(
        kind, ~known if known is not None else None)
    grouped = {"card": r"^[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]+$", "phone": r"^\+[0-9]{1,3}[ .(-]",
               "iban": " ", "email": r"\.[A-Za-z]{2,}$"}.get(kind)
    check = vote(_valid(kind, hit), ~_valid(kind, hit)) if kind not in ("email", "name") else vote(
        hit.rlike(r"^[A-Za-z0-9].*\.[A-Za-z]{2,}$"), hit.rlike(r"\.\.")) if kind == "email" else F.lit(0)
    return F.array(
        check, vote(known, unknown), vote(F.lower(before).rlike(_CUES[kind])),
        vote(no=before.rlike(r"[=#/\\_{}<>%$]$|(?i)\b(version|section|figure|isbn|order|no\.?)\s*$") | after.rlike(r"^[=#/\\_{}<>%$]")),
        vote(hit.rlike(grouped) if grouped else None, hit.rlike(r"([0-9])\1{6}")))


def _candidates(kind: str, text: Column) -> Column:
    def one(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - 29, F.lit(1)), F.least(F.lit(30), s["start"]))
        after = F.substring(text, s["end"] + 1, F.lit(1))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), F.lit(kind).alias("kind"),
                        _valid(kind, s["hit"]).alias("valid"), _votes(kind, s["hit"], before, after).alias("votes"))

    return F.transform(F.col(kind), one)


def _length_bin(hit: Column) -> Column:
    return F.least(F.floor(F.length(hit) / 8).cast("int"), F.lit(3))


#: A row of the pattern table: kind, votes, length and the number of such candidates.
Pattern = tuple[str, tuple[int, ...], int, int]


def _columns(patterns: list[Pattern]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kinds by number, votes (a column for each labeler), lengths and counts."""
    kinds = np.array([(BASE + ADDED).index(p[0]) for p in patterns], int)
    votes = np.array([p[1] for p in patterns], int).reshape(len(patterns), len(LABELERS))
    return kinds, votes, np.array([p[2] for p in patterns], int), np.array([p[3] for p in patterns], float)


def reliabilities(patterns: list[Pattern], rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """EM over the counts: each kind's share of true candidates, and for every labeler and vote (-1, 0, 1)
    P(vote | true) and P(vote | false), of shape (2, labelers, 3)."""
    kinds, votes, _, n = _columns(patterns)
    cast = votes[:, :, None] == np.array([-1, 0, 1])
    truth = _logistic(1.5 * votes.sum(1))  # to begin with, the majority's voice
    for _ in range(rounds):
        prior = (np.bincount(kinds, n * truth, len(BASE + ADDED)) + 1) / (np.bincount(kinds, n, len(BASE + ADDED)) + 2)
        table = np.stack([np.tensordot(n * side, cast, 1) + 1 for side in (truth, 1 - truth)])
        table /= table.sum(2, keepdims=True)
        truth = posterior(patterns, prior, table)
    return prior, table


def posterior(patterns: list[Pattern], prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    kinds, votes, _, _ = _columns(patterns)
    says = np.log(table[0] / table[1])
    return _logistic(np.log(prior / (1 - prior))[kinds] + says[np.arange(len(LABELERS)), votes + 1].sum(1))


def _logistic(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


def _features(patterns: list[Pattern]) -> np.ndarray:
    """Indicator features of pattern rows: a constant, votes, kinds, lengths."""
    kinds, votes, lengths, _ = _columns(patterns)
    flags = [np.ones(len(patterns), bool)] + [votes[:, j] == v for j in range(len(LABELERS)) for v in (-1, 1)]
    flags += [kinds == k for k in range(len(BASE + ADDED))] + [lengths == b for b in range(4)]
    return np.stack(flags, 1).astype(float)


def span_classifier(patterns: list[Pattern], truth: np.ndarray, rounds: int = 25, step: float = 1.0) -> np.ndarray:
    """Logistic regression of the posteriors ``truth`` on the features, by gradient descent over counts."""
    flags, n = _features(patterns), _columns(patterns)[3]
    weights = np.zeros(flags.shape[1])
    for _ in range(rounds if n.sum() else 0):
        weights = weights * 0.999 + step * (n * (truth - _logistic(flags @ weights))) @ flags / n.sum()
    return weights


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, spans of the four base kinds and ``added`` (arrays), counts and digests."""
    text = F.col("_text")
    maybe = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"),
             "card": text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
             "phone": F.contains(text, F.lit("+")), "ssn": text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
             "iban": text.rlike("[A-Z]{2}[0-9]{2}"), "name": F.lit(True)}
    found = with_spans(docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")), "_text",
                       {k: (p, maybe[k]) for k, p in _PATTERNS.items()})
    found = saved(found.select("_id", *(_candidates(k, text).alias(k) for k in _PATTERNS)), "pii-candidates")

    seen = found.select(F.explode(F.concat(*_PATTERNS)).alias("c")).select(
        "c.kind", "c.votes", _length_bin(F.col("c.hit")).alias("length"))
    # the counts of vote patterns: bounded, whatever the table
    counted = seen.groupBy("kind", "votes", "length").agg(F.count("*").alias("n")).collect()
    patterns = sorted((r.kind, tuple(r.votes), r.length, r.n) for r in counted)
    weights = span_classifier(patterns, posterior(patterns, *reliabilities(patterns)))
    accepted = [p[:3] for p, score in zip(patterns, _logistic(_features(patterns) @ weights)) if score >= 0.5]
    return _result(found, accepted, id_col)


def _result(found: DataFrame, accepted: list[tuple], id_col: str) -> DataFrame:
    names = [f"{k}:{','.join(map(str, votes))}:{length}" for k, votes, length in accepted]
    good = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    base = {k: F.filter(k, lambda c: c["valid"]) for k in BASE}
    found = found.select("_id", *(v.alias(k) for k, v in base.items()),
                         F.concat(*(F.filter(k, lambda c: ~c["valid"]) for k in BASE), *ADDED).alias("more"))

    def is_added(c: Column) -> Column:
        name = F.concat_ws(":", c["kind"], F.concat_ws(",", c["votes"].cast("array<string>")), _length_bin(c["hit"]).cast("string"))
        return F.array_contains(good, name) & ~overlaps(c, F.concat(*BASE))

    found = found.withColumn("added", F.filter("more", is_added)).drop("more")
    extra = {k: _of_kind(k) for k in ADDED} | {"suspect": F.filter("added", lambda c: c["kind"].isin(*BASE))}
    spans = {k: F.col(k) for k in BASE}
    return found.select(F.col("_id").alias(id_col), *BASE, "added",
                        *(F.size(k).cast("long").alias(f"n_{k}") for k in (*BASE, "added")),
                        F.sha2(described(spans), 256).alias("base_sha256"), described(spans | extra).alias("spans"))


def _of_kind(kind: str) -> Column:
    return F.filter("added", lambda c: c["kind"] == kind)
