"""Personal data: base spans against Python's regular expressions, votes and fits on planted cases."""

import hashlib
import math
import random
import re

from llm.helpers import frame
from stratus.llm import pii


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)}


def base_spans(text):
    rows = [(m.start(), rank, m.end(), kind) for rank, (kind, (p, ok)) in enumerate(PATTERNS.items())
            for m in re.finditer(p, text or "") if ok(m)]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(rows)]


def rough(rng):
    parts = ["a.b", "@", "x@y.z", "joe_%+-", ".com", "-", ".", "..", "1", "25", "256", "001", "10.0.0.", "4539578763621486",
             "4539 5787 6362 1486", "+1", "+", " (", ") ", "555-7713", "12", "34", " ", "é", "\U0001F600", "\n", "9" * 13, "_", "0"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))


def test_base_spans_equal_python(spark):
    rng = random.Random(6)
    texts = [None, "", "1" * 40_000, "1 " * 20_000, "1." * 20_000, "a" * 40_000 + "@", "a.b@c." * 5000, "+1" * 9000,
             "a@" + "b." * 9000 + "c", "a@b.c_d@e.f x@y.z@q.w", "+1 (017) 555-7713"] + [rough(rng) for _ in range(250)]
    rows = {r.doc_id: r for r in pii.find_personal_data(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert tuple(rows[i][f"n_{k}"] for k in PATTERNS) == tuple(sum(w.startswith(k) for w in want) for k in PATTERNS)
        assert set(want) <= set(filter(None, rows[i].spans.split(",")))
    assert all(sum(r[f"n_{k}"] > 0 for r in rows.values()) > 10 for k in PATTERNS)


def test_labelers_and_fits_find_planted_numbers(spark):
    rng = random.Random(1)
    texts = [f"mail to u{k}@mail{k % 9}.example.com or call +49 (030) 555-{1000 + k}" for k in range(120)]
    texts += [f"Her social security number: {rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} is kept" for _ in range(40)]
    texts += [f"pay to account DE89 3704 0044 0532 0130 00 today {k}" for k in range(30)]
    texts += [f"part no. 000-00-0000 of build {k}" for k in range(40)]
    texts += [f"Ende Anfang {k} und weiter" for k in range(60)]
    rows = pii.find_personal_data(frame(spark, texts)).orderBy("doc_id").collect()
    assert all("ssn:" in r.spans for r in rows[120:160])
    assert all("iban:" in r.spans for r in rows[160:190])
    assert not any(r.n_added for r in rows[190:])


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_fits_start_no_jobs_of_their_own(spark):
    texts = [f"call +49 (030) 555-{1000 + k} or write to u{k}@mail.com" for k in range(20)]
    spark.sparkContext.setJobGroup("pii-fits", "fits")
    rows = pii.find_personal_data(frame(spark, texts)).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("pii-fits")
    spark.sparkContext.setJobGroup("", "")
    assert len(rows) == 20 and 0 < len(jobs) <= 6


def test_fits_equal_plain_loops():
    rng = random.Random(4)
    kinds = pii.BASE + pii.ADDED
    patterns = sorted({(rng.choice(kinds), tuple(rng.choice((-1, 0, 1)) for _ in pii.LABELERS), rng.randrange(4)): 0 for _ in range(80)})
    patterns = [(*p, rng.randint(1, 500)) for p in patterns]
    truth = [1 / (1 + math.exp(-1.5 * sum(v))) for _, v, _, _ in patterns]
    for _ in range(3):
        prior = {k: (sum(p[3] * t for p, t in zip(patterns, truth) if p[0] == k) + 1) / (sum(p[3] for p in patterns if p[0] == k) + 2) for k in kinds}
        heard = [{(j, v): 1 + sum(p[3] * w for p, w in zip(patterns, side) if p[1][j] == v) for j in range(5) for v in (-1, 0, 1)}
                 for side in (truth, [1 - t for t in truth])]
        share = [{(j, v): c / sum(h[j, u] for u in (-1, 0, 1)) for (j, v), c in h.items()} for h in heard]
        odds = [math.log(prior[k] / (1 - prior[k])) + sum(math.log(share[0][j, v] / share[1][j, v]) for j, v in enumerate(votes)) for k, votes, _, _ in patterns]
        truth = [1 / (1 + math.exp(-o)) for o in odds]
    got = pii.posterior(patterns, *pii.reliabilities(patterns, rounds=3))
    assert max(abs(a - b) for a, b in zip(got, truth)) < 1e-9
    assert not len(pii.posterior([], *pii.reliabilities([]))) and not pii.span_classifier([], got[:0]).any()
