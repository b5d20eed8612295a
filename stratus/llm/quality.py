"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them, whatever its length. Each
passage is described by counts of its characters and words and encoded by a learned layer;
gated attention weighs the encoded passages, and the label of the document is predicted
from their weighted sum. Encoder, attention and classifier are trained together on document
labels alone, by gradient descent on at most ``TRAIN_ROWS`` labelled documents, each with all its
passages, and on fewer documents if their passages would pass ``TRAIN_PASSAGES``; the rest of the
table is only scored.

Attention is a softmax over a document's passages, so very long texts stream through it in
blocks: only running sums are kept. Null and blank texts are bags of one empty passage. Null and
repeated ids keep their rows; without labels every score is the prior 0.5.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import discard, saved, text_or_blank, whole_text
from stratus.llm.labels import held_out, training_sample

#: Labelled documents that the fit may use.
TRAIN_ROWS = 4_000
#: Words of a passage.
PASSAGE = 64
#: Passages of the fit: no further document is taken, in the order of a hash of the ids, once those taken hold
#: so many. Bounds what the driver gets, 88 bytes a passage. Scoring takes all passages of every document.
TRAIN_PASSAGES = 250_000
#: Passages worked on at once.
BLOCK = 256
#: Passages, about, whose gradient is worked out at once.
FIT_BLOCK = 16_384
WIDTH, GATE = 16, 8

# Frequent function words of the corpus's languages.
_COMMON = frozenset(w.encode() for w in (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und den das von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "de la que el en y los del se las por un para con no una su al lo como más pero sus le et les des est pour dans "
    "qui sur pas plus par avec ce sont au").split())
_CLASS = np.zeros(256, np.int64)  # 0 other
for _low, _high, _kind in ((0x61, 0x7A, 1), (0x41, 0x5A, 2), (0x30, 0x39, 3), (0x80, 0xFF, 4)):
    _CLASS[_low:_high + 1] = _kind
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 6
_CLASS[ord("!")] = 7
_CLASS[[ord(c) for c in "#$%&*@~^+=|\\/<>{}[]_`"]] = 8
KINDS = 9
INPUTS = KINDS + 13


def passage_inputs(words: list[bytes]) -> list[float]:
    """The description of one passage: all shares or bounded numbers."""
    n = max(1, len(words))
    text = b" ".join(words)
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=KINDS) / max(1, len(text))
    counts = Counter(words)
    lowered = [w.lower().strip(b".,;:!?'\"()") for w in words]
    lengths = np.array([len(w) for w in words] or [0])
    pairs = Counter(zip(words, words[1:]))
    return [*kinds,
            len(counts) / n, max(counts.values(), default=0) / n, max(pairs.values(), default=0) / n,
            sum(w in _COMMON for w in lowered) / n,
            sum(w.isupper() and len(w) > 1 for w in words) / n,
            sum(w[:1].isupper() and not w.isupper() for w in words) / n,
            sum(w[-1:] in (b".", b"?", b"!") for w in words) / n,
            sum(not any(c.isalnum() for c in w.decode("utf-8", "replace")) for w in words) / n,
            sum(w[-1:] in b"#$%&*@" for w in words) / n,
            float(lengths.mean()) / 10, min(3.0, float(lengths.std()) / 10), min(5.0, float(lengths.max()) / 20),
            math.log1p(len(words)) / 5]


def passages(text: bytes) -> Iterator[np.ndarray]:
    """The inputs of all passages of a text, in blocks."""
    words = text.split()
    spans = range(0, max(1, len(words)), PASSAGE)
    for at in range(0, len(spans), BLOCK):
        yield np.array([passage_inputs(words[i:i + PASSAGE]) for i in spans[at:at + BLOCK]])


class QualityModel:
    """Encoder, gated attention and classifier; ``parts`` are plain arrays."""

    NAMES = ("W", "b", "V", "U", "w", "c", "d")

    def __init__(self, parts: dict[str, np.ndarray], mean: np.ndarray, spread: np.ndarray):
        self.parts, self.mean, self.spread = parts, mean, spread

    @staticmethod
    def fresh(mean: np.ndarray, spread: np.ndarray, seed: int = 7) -> "QualityModel":
        rng = np.random.default_rng(seed)
        shapes = {"W": (INPUTS, WIDTH), "b": (WIDTH,), "V": (WIDTH, GATE), "U": (WIDTH, GATE), "w": (GATE,), "c": (WIDTH,)}
        parts = {k: rng.normal(0, 1 / math.sqrt(s[0]), s) if k != "b" else np.zeros(s) for k, s in shapes.items()}
        return QualityModel(parts | {"d": np.zeros(1)}, mean, spread)

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.parts
        z = np.tanh((x - self.mean) / self.spread @ p["W"] + p["b"])
        s, g = np.tanh(z @ p["V"]), 1 / (1 + np.exp(-(z @ p["U"])))
        return z, s, g, (s * g) @ p["w"]

    def score(self, text: bytes) -> float:
        """Streams over the passages with a running softmax."""
        top, weight, bag = -np.inf, 0.0, np.zeros(WIDTH)
        for x in passages(text):
            z, _, _, e = self.encoded(x)
            new = max(top, float(e.max()))
            a = np.exp(e - new)
            shrink = math.exp(top - new) if top > -np.inf else 0.0
            weight, bag, top = weight * shrink + a.sum(), bag * shrink + a @ z, new
        value = float(bag / weight @ self.parts["c"] + self.parts["d"][0])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def slopes(model: QualityModel, x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the bags' summed log loss; ``owner`` is sorted and numbers the bags from 0."""
    p = model.parts
    starts = np.searchsorted(owner, np.arange(len(y)))
    scaled = (x - model.mean) / model.spread
    z, s, g, e = model.encoded(x)
    a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    a /= np.add.reduceat(a, starts)[owner]
    bag = np.add.reduceat(a[:, None] * z, starts)
    miss = 1 / (1 + np.exp(-(bag @ p["c"] + p["d"]))) - y
    d_bag = miss[:, None] * p["c"]
    along = (z * d_bag[owner]).sum(axis=1)
    d_e = a * (along - np.add.reduceat(a * along, starts)[owner])
    d_s, d_g = d_e[:, None] * p["w"] * g * (1 - s * s), d_e[:, None] * p["w"] * s * g * (1 - g)
    d_z = a[:, None] * d_bag[owner] + d_s @ p["V"].T + d_g @ p["U"].T
    d_in = d_z * (1 - z * z)
    return {"W": scaled.T @ d_in, "b": d_in.sum(axis=0), "V": z.T @ d_s, "U": z.T @ d_g, "w": (s * g).T @ d_e,
            "c": bag.T @ miss, "d": np.array([miss.sum()])}


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 0.02,
        decay: float = 1e-3) -> QualityModel:
    """Adam on the mean log loss over bags; ``owner`` is sorted and numbers the bags from 0. Gradients are summed over blocks of bags."""
    model = QualityModel.fresh(x.mean(axis=0, dtype=float), x.std(axis=0, dtype=float) + 1e-3)
    p = model.parts
    p["d"][0] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    starts = np.searchsorted(owner, np.arange(len(y) + 1))
    firsts = np.flatnonzero(np.diff(starts[:-1] // FIT_BLOCK, prepend=-1))  # the bags that open a block
    blocks = [(a, b, starts[a], starts[b]) for a, b in zip(firsts, [*firsts[1:], len(y)])]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for t in range(1, rounds + 1):
        parts = [slopes(model, x[lo:hi], owner[lo:hi] - a, y[a:b]) for a, b, lo, hi in blocks]
        for k in p:
            slope = sum(part[k] for part in parts) / len(y) + decay * p[k] * (k not in ("b", "d"))
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope * slope
            p[k] = p[k] - rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> QualityModel | None:
    """The model, or None without labels."""
    sample = training_sample(docs, labels, "quality", modulus, remainder, rows, id_col, text_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = np.concatenate(list(passages(text_or_blank(batch.column(0)[k].as_py())))).astype(np.float32)
                yield pa.record_batch([pa.array([x.ravel()], pa.list_(pa.float32())), pa.array([len(x)], pa.int64()),
                                       *(batch.column(c).slice(k, 1) for c in (1, 2))], names=["x", "n", "quality", "place"])

    bags = saved(sample.select(whole_text(text_col), F.col("quality").cast("int"), F.xxhash64(id_col))
                 .mapInArrow(step, "x array<float>, n long, quality int, place long"), "bags")
    taken, last = 0, None
    for r in bags.select("place", "n").orderBy("place").collect():  # about TRAIN_ROWS pairs of numbers
        if taken >= TRAIN_PASSAGES:
            break
        taken, last = taken + r.n, r.place
    got = bags.where(F.col("place") <= F.lit(last)).toArrow().sort_by("place") if taken else None
    discard(sample, bags)
    if got is None:
        return None
    x = np.concatenate([c.values.to_numpy() for c in got["x"].chunks]).reshape(-1, INPUTS)
    n = got["n"].to_numpy()
    return fit(x, np.repeat(np.arange(len(n)), n), got["quality"].to_numpy().astype(float))


def score_documents(docs: DataFrame, model: QualityModel | None, threshold: float = 0.7, modulus: int = 4,
                    remainder: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``held_out, score, predicted`` of every row."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) if model is not None else 0.5 for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                   pa.array([int(s >= threshold) for s in scores], pa.int32())],
                                  names=[id_col, "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long"), held_out(id_col, modulus, remainder),
                       whole_text(text_col).cast("binary")).mapInArrow(
        step, f"{id_col} long, held_out boolean, score double, predicted int")
