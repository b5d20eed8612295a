"""Toxicity: a learned lexicon, fuzzy matching by automata, and context windows.

1. Lexicon. Words that labelled toxic documents hold far more often than others; near copies
   count once, and a word must beat what chance makes of as many words.
2. Automaton. The lexicon's trie is intersected with Levenshtein automata: a state is a set of
   (trie node, edits), and its moves are worked out once and kept, so that reading a word
   costs a table look-up per letter and most words end in the dead state after a few.
   Terms of five letters or more may be off by one edit, of nine by two. Digits and signs that
   stand for letters and stretched letters are undone first. Near misses that are ordinary
   words of documents labelled clean do not count, and a term with ``CROWDED`` such
   neighbours is matched exactly only.
3. Context. A window about every match tells abuse (second person, intensifiers) from
   quotation (quotation marks, reporting words).
4. Score. Logistic regression of the labels on the match counts, drawn to sensible weights
   where the labels say nothing.

The lexicon and the weights are fitted on at most ``TRAIN_ROWS`` labelled documents; every
document is scored by its whole text. Null and blank texts score as documents without any
match. Null and repeated ids keep their rows; without any toxic label nothing is toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import discard, saved, whole_text
from stratus.llm.labels import held_out, training_sample

#: Labelled documents that the fit may use.
TRAIN_ROWS = 20_000
#: So many ordinary words within its edits make a term's near misses meaningless.
CROWDED = 3
#: Words each side of a match that make its context.
WINDOW = 8
#: Distinct words whose matches a task keeps.
CACHE = 500_000

_WORD = re.compile(r"[^\W_]+(?:[@$!*][^\W_]+)*|[\"“”«»„]")
_STRETCHED = re.compile(r"(.)\1{2,}")
# Signs that stand for letters, and what the context labels look for.
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})
_MARKS = frozenset("\"“”«»„")
_REPORTING = frozenset("said says say wrote writes called calling quoted quote quotes word words term phrase reported "
                       "reports alleged insult insults slur described".split())
_DIRECT = frozenset("you your yours u ur yourself are such fucking total absolute complete du dein eres vous tu".split())


class FuzzyLexicon:
    """A trie met with Levenshtein automata, made deterministic as words come."""

    def __init__(self, terms: list[str], crowded: frozenset[str] = frozenset()):
        self.allowed = {t: 0 if t in crowded else edits_allowed(t) for t in terms}
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.reach = [0]  # edits allowed by the longest term below a node
        for term in terms:
            allowed, node = self.allowed[term], 0
            self.reach[0] = max(self.reach[0], allowed)
            for ch in term:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.reach.append(0)
                node = nxt
                self.reach[node] = max(self.reach[node], allowed)
            self.term[node] = term
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.known: dict[frozenset, int] = {}
        self.start = self._state({0: 0})

    def _state(self, edits: dict[int, int]) -> int:
        """The number of a set of nodes with their least edits, closed under skipped letters."""
        queue = list(edits)
        while queue:
            node = queue.pop()
            e = edits[node] + 1
            for child in self.children[node].values():
                if e <= self.reach[child] and e < edits.get(child, 9):
                    edits[child] = e
                    queue.append(child)
        key = frozenset(edits.items())
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(edits)
            self.moves.append({})
        return self.known[key]

    def _move(self, state: int, ch: str) -> int:
        nxt: dict[int, int] = {}
        for node, e in self.sets[state].items():
            if e + 1 <= self.reach[node]:
                nxt[node] = min(nxt.get(node, 9), e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                cost = e + (letter != ch)
                if cost <= self.reach[child]:
                    nxt[child] = min(nxt.get(child, 9), cost)
        self.moves[state][ch] = out = self._state(nxt) if nxt else -1
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits, and the edits; of equals the first by spelling."""
        state = self.start
        for ch in word:
            nxt = self.moves[state].get(ch)
            state = self._move(state, ch) if nxt is None else nxt
            if state < 0:
                return None
        found = [(e, self.term[n]) for n, e in self.sets[state].items()
                 if self.term[n] is not None and e <= self.allowed[self.term[n]]]
        if not found:
            return None
        e, term = min(found)
        return term, e


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def plain(word: str) -> str:
    """A word with signs for letters and stretched letters undone."""
    if not word.isalpha():
        word = word.translate(_SIGNS)
    return _STRETCHED.sub(r"\1", word)


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def matcher(lexicon: FuzzyLexicon, benign: frozenset[str]) -> Callable[[str], tuple | None]:
    seen: dict[str, tuple | None] = {}

    def match(token: str) -> tuple | None:
        if token in seen:
            return seen[token]
        if len(seen) >= CACHE:
            seen.clear()
        found = lexicon.match(token)
        if found is None and (other := plain(token)) != token:
            found = lexicon.match(other)
            found = found and (found[0], max(1, found[1]))
        if found and found[1] and token in benign:
            found = None
        seen[token] = found
        return found

    return match


#: Features: any abuse, exact matches, near misses, quoted matches, matches addressed to someone, different terms.
FEATURES = 6
#: Where the weights stay without evidence: a constant, then the features.
PRIOR = np.array([-2.5, 3.0, 0.8, 2.0, -1.0, 0.8, 0.5])


def features(text: str, match: Callable[[str], tuple | None]) -> list[float]:
    words = tokens(text)
    exact = near = quoted = direct = 0
    terms = set()
    marks = None
    for i, w in enumerate(words):
        found = match(w)
        if found is None:
            continue
        if marks is None:
            marks = np.cumsum([x in _MARKS for x in words])
        around = words[max(0, i - WINDOW):i + WINDOW + 1]
        inside = marks[i] % 2 == 1 and bool(_MARKS.intersection(words[i + 1:i + 1 + 4 * WINDOW]))
        if inside or _REPORTING.intersection(words[max(0, i - WINDOW):i]):
            quoted += 1
            continue
        terms.add(found[0])
        exact += found[1] == 0
        near += found[1] > 0
        direct += any(x in _DIRECT and x != found[0] for x in around)
    return [float(exact + near > 0), *map(math.log1p, (exact, near, quoted, direct)), math.log1p(len(terms))]


def word_counts(sample: DataFrame, text_col: str) -> DataFrame:
    """``word, toxic, n``: in how many labelled documents a word occurs, near copies as one."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ws = tokens(batch.column(0)[i].as_py())
                grams = zip(*(ws[k:] for k in range(5))) if len(ws) >= 5 else [tuple(ws)]
                family = min((xxhash.xxh3_64_intdigest(" ".join(g)) for g in grams), default=0) >> 1
                own = sorted(set(ws) - _MARKS)
                yield pa.record_batch([pa.array(own, pa.string()), pa.array([batch.column(1)[i].as_py()] * len(own), pa.int32()),
                                       pa.array([family] * len(own), pa.int64())], names=["word", "toxic", "family"])

    rows = sample.select(whole_text(text_col), F.col("toxic").cast("int")).mapInArrow(
        step, "word string, toxic int, family long")
    return rows.distinct().groupBy("word", "toxic").agg(F.count("*").alias("n"))


def learn_lexicon(counts: DataFrame) -> tuple[list[str], frozenset[str], frozenset[str]]:
    """The terms, the crowded ones of them, and the ordinary words near terms."""
    words = counts.groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                       F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    words = saved(words, "words")
    often = words.where("bad + good >= 3")
    totals = often.agg(F.count("*").alias("words"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not totals.words or not totals.bad:
        discard(words)
        return [], frozenset(), frozenset()
    base = totals.bad / (totals.bad + totals.good)
    n = F.col("bad") + F.col("good")
    p = (F.col("bad") + 0.25) / (n + 0.5)
    surprise = n * (p * F.log(p / base) + (1 - p) * F.log((1 - p) / (1 - base)))  # bound on the log of the tail
    terms = [r.word for r in often.where((p >= 0.7) & (p > base) & F.col("word").rlike(r"^\p{L}{3,}$")
                                         & (surprise >= math.log(2 * totals.words)))
             .orderBy(surprise.desc(), "word").collect()]  # words of the bounded sample
    lexicon = FuzzyLexicon(terms)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(w, m[0]) for w in batch.column(0).to_pylist() if (m := lexicon.match(w)) and m[1]]
            yield pa.record_batch([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], names=["word", "term"])

    # words of the bounded sample that are within two edits of the lexicon
    near = words.where("good > bad").select("word").mapInArrow(step, "word string, term string").collect()
    discard(words)
    neighbours = Counter(r.term for r in near)
    return terms, frozenset(t for t in terms if neighbours[t] >= CROWDED), frozenset(r.word for r in near)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, with a normal prior about ``PRIOR``."""
    x, w = np.column_stack([np.ones(len(x)), x]), PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (y - p) - (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    return w


class ToxicityModel:
    """A fitted scorer; its parts are plain, so that it travels to the workers."""

    def __init__(self, terms: list[str], crowded: frozenset[str], benign: frozenset[str], weights: np.ndarray):
        self.terms, self.crowded, self.benign, self.weights = terms, crowded, benign, weights

    def scorer(self) -> Callable[[str | None], float]:
        match = matcher(FuzzyLexicon(self.terms, self.crowded), self.benign)
        first, rest = self.weights[0], self.weights[1:].tolist()

        def score(text: str | None) -> float:
            value = first + sum(w * f for w, f in zip(rest, features(text or "", match)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))

        return score


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    sample = training_sample(docs, labels, "toxic", modulus, remainder, rows, id_col, text_col)
    terms, crowded, benign = learn_lexicon(word_counts(sample, text_col))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher(FuzzyLexicon(terms, crowded), benign)
        for batch in batches:
            x = [features(t or "", match) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    # as many short rows as the sample's bound says
    got = (sample.select(whole_text(text_col), F.col("toxic").cast("int")).mapInArrow(step, "x array<double>, toxic int")
           .groupBy("x").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).collect())
    discard(sample)
    if not terms or not got:
        return ToxicityModel([], frozenset(), frozenset(), PRIOR)
    x = np.repeat(np.array([r.x for r in got]), [r.n for r in got], axis=0)
    y = np.concatenate([np.r_[np.ones(r.bad), np.zeros(r.n - r.bad)] for r in got])
    return ToxicityModel(terms, crowded, benign, fit(x, y))


def score_documents(docs: DataFrame, model: ToxicityModel, modulus: int = 5, remainder: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``held_out, score, predicted`` of every row."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = [score(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                   pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                  names=[id_col, "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long"), held_out(id_col, modulus, remainder), whole_text(text_col)).mapInArrow(
        step, f"{id_col} long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, in one pass without a shuffle."""
    at = docs.columns.index(text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(step, docs.schema)
