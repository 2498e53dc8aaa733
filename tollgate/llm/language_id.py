"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, fitted by FTRL-proximal with elastic net, then calibrated
with one temperature.

Features are the 1- to 3-grams of the lower-cased letters of the whole text,
every run of other characters being one blank, hashed to ``BUCKETS``; a value
is (1 + log count) * idf, scaled to unit length.  The model is learned from at
most ``SAMPLE_ROWS`` rows (as many for each language), a quarter of them kept
back for the temperature.  Prediction is a projection over all documents.

Defined cases: ``und`` with score 0 for a NULL or empty text, one without a
letter, or when there is nothing to learn from; rows with a NULL doc_id count
as held out; repeated rows are judged alike; of languages with
equal scores the first by code point wins; every language of the learnable rows
is learned; a very long text is counted whole, in one task; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm.common import learn_fold, pack, python_tasks, read_table
from tollgate.llm.sampling import labelled_sample
from tollgate.llm.textvec import give_back, start_over

BUCKETS = 1 << 15
SAMPLE_ROWS = 3000
BLOCK_TEXTS, BLOCK_CHARS = 32, 1 << 17
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.1, 3
UNDETERMINED = "und"
_GRAM = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngram_counts(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: (buckets, counts, first entry of each text, has a
    letter).  A block has at most ``BLOCK_TEXTS`` texts and, but for a longer
    last one, ``BLOCK_CHARS`` characters, so that its arrays stay small."""
    block: list[str] = []
    chars = 0
    for text in texts:
        block.append((text or "").lower())
        chars += len(block[-1])
        if len(block) == BLOCK_TEXTS or chars >= BLOCK_CHARS:
            yield _counted(block)
            block, chars = [], 0
    if block:
        yield _counted(block)


def _counted(block: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every text stands between two blanks of its own; a gram that would reach
    into the next text is none, so a text counts alike in any block."""
    code = np.frombuffer("".join(f"\n{t}\n" for t in block).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(code, 0x10FFFF)]
    lengths = np.fromiter(map(len, block), np.int64, len(block)) + 2
    begin = np.cumsum(lengths) - lengths
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[begin] = True
    symbol = np.where(letter, code, np.uint32(32))[keep]
    doc = np.repeat(np.arange(len(block)), lengths)[keep]
    a = symbol * _GRAM[0]
    b = symbol * _GRAM[1]
    c = symbol * _GRAM[2]
    two = a[:-1] + (b[1:] ^ (b[1:] >> np.uint32(13)))
    three = two[:-1] + (c[2:] ^ (c[2:] >> np.uint32(11))) * np.uint32(5)
    size = len(block) * BUCKETS
    total = np.zeros(size, np.int64)
    for h, first, last in ((a, doc, doc), (two, doc[:-1], doc[1:]), (three, doc[:-2], doc[2:])):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
        inside = first == last
        total += np.bincount((first * BUCKETS + (h >> np.uint32(17)))[inside], minlength=size)
    at = np.flatnonzero(total)
    has = np.add.reduceat(letter.astype(np.int64), begin) > 0
    return at % BUCKETS, total[at], np.searchsorted(at, np.arange(len(block) + 1) * BUCKETS), has


class Model:
    """Weights (BUCKETS, languages), idf, temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, idf: np.ndarray, temperature: float):
        self.languages, self.weights, self.bias, self.idf, self.temperature = languages, weights, bias, idf, temperature

    def predict(self, column: pa.Array) -> pa.Array:
        names, scores = [], []
        for bucket, count, first, has in ngram_counts(column.to_pylist()):
            n = len(has)
            if not self.languages:
                names += [UNDETERMINED] * n
                scores += [0.0] * n
                continue
            value = (1 + np.log(count)) * self.idf[bucket]
            pad = np.concatenate((value * value, [0.0]))
            norm = np.sqrt(np.maximum(np.add.reduceat(pad, first[:-1]), 1e-12))
            rows = np.concatenate((self.weights[bucket] * value[:, None], np.zeros((1, len(self.languages)))))
            logit = (np.add.reduceat(rows, first[:-1], axis=0) / norm[:, None] + self.bias) / self.temperature
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            names += [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has)]
            scores += np.where(has, p[np.arange(n), best], 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``EPOCHS`` passes, one example at a time; the
    last row of the state is the bias, which is not penalised."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            bucket, value = rows[k]
            i = np.append(bucket.astype(np.int64), BUCKETS)
            x = np.append(value, 1.0)
            w = weights(z[i], n[i])
            w[-1] = -z[BUCKETS] / ((BETA + np.sqrt(n[BUCKETS])) / ALPHA)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = x[:, None] * p
            squared = n[i] + g * g
            z[i] += g - (np.sqrt(squared) - np.sqrt(n[i])) / ALPHA * w
            n[i] = squared
    return weights(z[:-1], n[:-1]), -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)


def fit_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss, by golden section on its logarithm."""
    def loss(log_t: float) -> float:
        s = logit / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())
    a, b, g = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _features():
    @arrow_udf("struct<buckets: binary, counts: binary>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start_over()
        for column in batches:
            buckets, counts = [], []
            for bucket, count, first, _ in ngram_counts(column.to_pylist()):
                b, c = bucket.astype(np.uint16), np.minimum(count, 2**32 - 1).astype(np.uint32)
                for k in range(len(first) - 1):
                    buckets.append(b[first[k]: first[k + 1]].tobytes())
                    counts.append(c[first[k]: first[k + 1]].tobytes())
            yield pa.StructArray.from_arrays([pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], ["buckets", "counts"])
        give_back()
    return features


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a task, and how many of them hold each bucket (bucket -1: all)."""
    start_over()
    found, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts += batch.num_rows
        for bucket, _, _, _ in ngram_counts(batch.column(0).to_pylist()):
            found += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(found[at], texts), pa.int64())], ["bucket", "n"])
    give_back()


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows of the column ``text``, and for each bucket the number
    that hold it: counted over all rows, at most one row a bucket comes back."""
    python_tasks(texts.sparkSession)
    rows = texts.select("text").mapInArrow(_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = {r["bucket"]: r["n"] for r in rows}
    total = counts.pop(-1, 0)
    df = np.zeros(BUCKETS)
    df[list(counts)] = list(counts.values())
    return total, df


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang): rows outside the held-out fold
    with a language and a text.  Document frequencies come from all of them,
    weights and temperature from a sample, whose arrays the driver gives back."""
    model = _fitted(docs, sample_rows)
    give_back()
    return model


def _fitted(docs: DataFrame, sample_rows: int) -> Model:
    python_tasks(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").where((learn_fold(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages, sample = labelled_sample(usable, "lang", sample_rows)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), np.ones(BUCKETS), 1.0)
    got = sample.select("lang", "u", "doc_id", _features()("text").alias("f")).select("lang", "u", "doc_id", "f.*").collect()
    got.sort(key=lambda r: (r["u"], r["doc_id"], r["lang"]))
    total, df = document_frequencies(usable)
    idf = np.log((1 + total) / (1 + df)) + 1
    rows = []
    for r in got:
        bucket = np.frombuffer(r["buckets"], np.uint16)  # the row's own bytes
        v = (1 + np.log(np.frombuffer(r["counts"], np.uint32))) * idf[bucket]
        rows.append((bucket, v / max(1e-6, float(np.sqrt(v @ v)))))
    y = np.array([languages.index(r["lang"]) for r in got])
    back = np.arange(len(rows)) % 4 == 3
    keep = [k for k in range(len(rows)) if not back[k]]
    weights, bias = fit_ftrl([rows[k] for k in keep], y[keep], len(languages))
    held = np.flatnonzero(back)
    temperature = fit_temperature(np.array([v @ weights[b] + bias for b, v in (rows[k] for k in held)]), y[held]) if len(held) and len(languages) > 1 else 1.0
    return Model(languages, weights.astype(np.float32), bias, idf, temperature)


def _predictor(model_ref):
    @arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start_over()
        model = model_ref.value
        for column in batches:
            yield model.predict(column)
        give_back()
    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` packed as ``row`` with lang_pred and score beside it."""
    python_tasks(docs.sparkSession)
    predict = _predictor(docs.sparkSession.sparkContext.broadcast(model))
    return pack(docs).withColumn("p", predict(F.col("row.text"))).select("row", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is determined, with whatever score."""
    return identify(docs, fit(docs)).where(F.col("lang_pred") != UNDETERMINED).select("row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select(F.col("row.doc_id").alias("doc_id"), (learn_fold(F.col("row.doc_id")) == 1).alias("held_out"), "lang_pred", "score")
