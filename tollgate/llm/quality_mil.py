"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages; its label belongs to the whole bag.  Every
passage of the whole text is encoded (surface statistics and hashed words,
then a learned layer h = tanh(x W + b)); gated attention
a = softmax(w . (tanh(h V) * sigmoid(h U))) weighs the passages, and the
weighted representation sum(a h) gives the score through a logistic unit.

Passages have ``PASSAGE_WORDS`` words whatever the length of a text: a bag
takes some 850 bytes for 128 words, little more than the words themselves, and
every passage meets the attention as it is.  The network is fitted on at most
``SAMPLE_ROWS`` labelled documents (as many of either class; the bias is then
moved to the classes' true proportion) and, of each, on at most
``FIT_PASSAGES`` of its passages, evenly spaced; scoring is a projection over
all passages.

Defined cases: a NULL, empty or blank text is one passage without words and
gets the score of that; documents with contradictory label rows are not
learned from; NULL doc_ids count as held out; with labels of one class only
(or none) the score is that class's share (or 0.5) everywhere; repeated rows
are scored alike; a score of exactly 0.5 predicts 1; a text of any length has all
its passages scored; other columns pass through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm import textvec as tv
from tollgate.llm.common import learn_fold, pack, python_tasks, read_table
from tollgate.llm.sampling import labelled_sample

PASSAGE_WORDS = 128
HASHED = 64
SAMPLE_ROWS, FIT_PASSAGES = 4000, 64
HIDDEN, GATE, EPOCHS, RATE, DECAY = 24, 16, 150, 0.02, 1e-4
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b"\"'()[]{}-_/\\@+=~^`", b"\n", b" "]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _k
N_CLASSES = len(_CLASSES) + 1
FEATURES = N_CLASSES + 7 + HASHED


def encode_passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, first passage of each text and the total)."""
    n = len(column)
    data, offsets = tv.text_bytes(column)
    starts, ends, first = tv.word_spans(data, offsets, tv.NON_SPACE)
    words = tv.word_hashes(data, starts, ends)
    count = np.diff(first)
    bags = np.maximum(1, -(-count // PASSAGE_WORDS))
    at = np.concatenate(([0], np.cumsum(bags)))
    doc = np.repeat(np.arange(n), bags)
    begin = np.minimum(first[doc] + (np.arange(at[-1]) - at[doc]) * PASSAGE_WORDS, first[doc + 1])
    end = np.minimum(begin + PASSAGE_WORDS, first[doc + 1])
    out = np.zeros((at[-1], FEATURES), np.float32)
    if not len(words):
        return out, at
    word_doc = np.repeat(np.arange(n), count)
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (word_doc[1:] != word_doc[:-1])
    # Words inside three-word windows that the text has more than once.
    windows = tv.window_hashes(words, 3)
    inside = word_doc[2:] == word_doc[:-2]
    keyed = tv.mix(windows + word_doc[: len(windows)].astype(np.uint64) * tv.POSITION[9])[inside]
    order = np.argsort(keyed)
    ordered = keyed[order]
    same = np.zeros(len(ordered) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    places = np.flatnonzero(inside)[order[same[1:] | same[:-1]]]
    again = np.zeros(len(words), bool)
    for k in range(3):
        again[places + k] = True
    passage = np.repeat(np.arange(at[-1]), end - begin)
    some = end > begin
    n_words = np.maximum(end - begin, 1)
    byte_begin, byte_end = starts[np.minimum(begin, len(starts) - 1)], ends[np.maximum(end - 1, 0)]
    byte_end = np.where(some, byte_end, byte_begin)
    length = np.maximum(byte_end - byte_begin, 1)
    classes = _CLASS_OF[data]
    for k in range(N_CLASSES):
        total = np.concatenate(([0], np.cumsum(classes == k)))
        out[:, k] = (total[byte_end] - total[byte_begin]) / length

    def share(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, at[-1]) / n_words
    j = N_CLASSES
    out[:, j] = share(again)
    out[:, j + 1] = share(~new)
    out[:, j + 2] = share(np.minimum(ends - starts, 40)) / 10
    pair = tv.mix(words + passage.astype(np.uint64) * tv.POSITION[11])
    distinct = np.unique(pair, return_index=True)[1]
    out[:, j + 3] = np.bincount(passage[distinct], minlength=at[-1]) / n_words
    out[:, j + 4] = np.log1p(end - begin) / 5
    out[:, j + 5] = np.log1p(count)[doc] / 10
    out[:, j + 6] = ~some
    cell = passage * HASHED + (words >> np.uint64(58)).astype(np.int64)
    out[:, j + 7:] = np.sqrt(np.bincount(cell, minlength=at[-1] * HASHED).reshape(-1, HASHED) / n_words[:, None])
    out[~some, :j + 4] = 0
    return out, at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Weights of the encoder, the gated attention and the output unit."""

    def __init__(self, features: int, rng: np.random.Generator):
        def start(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"W": start(features, HIDDEN), "b": np.zeros(HIDDEN), "V": start(HIDDEN, GATE), "U": start(HIDDEN, GATE),
                  "w": start(GATE), "c": start(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale, self.shift = np.zeros(features), np.ones(features), 0.0

    def forward(self, x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: standardised passages; ``at``: first passage of each bag."""
        p, bag = self.p, np.repeat(np.arange(len(at) - 1), np.diff(at))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, at[:-1])[bag])
        a /= np.add.reduceat(a, at[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, at[:-1])
        return {"x": x, "at": at, "bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ p["c"] + p["d"]}

    def gradients(self, f: dict[str, np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, at, bag, h, t, s, a = self.p, f["at"], f["bag"], f["h"], f["t"], f["s"], f["a"]
        dl = (_sigmoid(f["logit"]) - y) / len(y)
        dz = (dl[:, None] * p["c"])[bag]
        da = (h * dz).sum(1)
        de = a * (da - np.add.reduceat(a * da, at[:-1])[bag])
        dt, ds = (de[:, None] * p["w"] * s) * (1 - t * t), (de[:, None] * p["w"] * t) * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": f["z"].T @ dl, "d": dl.sum(keepdims=True)}

    def fit(self, x: np.ndarray, at: np.ndarray, y: np.ndarray) -> None:
        """Adam over all bags."""
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        x = (x - self.mean) / self.scale
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, EPOCHS + 1):
            for k, g in self.gradients(self.forward(x, at), y).items():
                g = g + DECAY * self.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.p[k] = self.p[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward((x - self.mean) / self.scale, at)["logit"] + self.shift)


class Constant:
    """For want of two classes."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.full(len(at) - 1, self.share)


def fitting_passages(a: int, b: int) -> np.ndarray:
    """All of the passages a..b, or ``FIT_PASSAGES`` of them, evenly spaced."""
    return np.arange(a, b) if b - a <= FIT_PASSAGES else a + np.arange(FIT_PASSAGES) * (b - a) // FIT_PASSAGES


def _bags():
    @arrow_udf("binary")
    def bags(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x, at = encode_passages(column)
            yield pa.array([x[fitting_passages(a, b)].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
    return bags


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network | Constant:
    """Learn from documents outside the held-out fold that ``labels`` marks."""
    python_tasks(docs.sparkSession)
    marks = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("quality")).where(F.col("quality").isin(0, 1))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    marks = marks.where(learn_fold(F.col("doc_id")) != 1)
    classes, sample = labelled_sample(marks, "quality", sample_rows)
    if len(classes) < 2:
        return Constant(float(classes[0]) if classes else 0.5)
    totals = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    # At most sample_rows ids: a proven bound for the broadcast.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = chosen.select("quality", "u", "doc_id", _bags()("text").alias("bag")).collect()
    if len({r["quality"] for r in rows}) < 2:
        return Constant(float(rows[0]["quality"]) if rows else 0.5)
    rows.sort(key=lambda r: (r["u"], r["doc_id"], r["bag"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows]
    y = np.array([r["quality"] for r in rows], float)
    model = Network(FEATURES, np.random.default_rng(11))
    model.fit(np.concatenate(bags).astype(np.float64), np.concatenate(([0], np.cumsum([len(b) for b in bags]))), y)
    model.shift = float(np.log(totals[1] / totals[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return model


def _scorer(model_ref):
    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_ref.value
        for column in batches:
            x, at = encode_passages(column)
            yield pa.array(model.score(x, at) if len(at) > 1 else np.zeros(0))
    return score


def scored(docs: DataFrame, model: Network | Constant) -> DataFrame:
    """``docs`` packed as ``row`` with ``score``: higher, likelier of quality 1."""
    python_tasks(docs.sparkSession)
    return pack(docs).withColumn("score", _scorer(docs.sparkSession.sparkContext.broadcast(model))(F.col("row.text")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    doc_id = F.col("row.doc_id")
    return out.select(doc_id.alias("doc_id"), (learn_fold(doc_id) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
