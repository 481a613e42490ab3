"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained online by follow-the-regularised-leader (FTRL-proximal) with an elastic-net penalty, then
calibrated by one temperature.  Document frequencies cover all training rows; the
classifier is fitted on a bounded sample, ``PER_LANGUAGE`` rows of each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
PER_LANGUAGE = 500
EPOCHS = 3
OVER = 4
BLOCK = 1 << 20
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed character n-grams of the whole lower-cased text, every run of other characters
    being one space; None if it has no letter."""
    if not text:
        return None
    total, any_ = np.zeros(BUCKETS, np.int64), False
    text = text.lower()
    tail = np.array([32], np.uint32)                         # what n-grams of the next block begin with
    for at in range(0, len(text), BLOCK):
        c = np.frombuffer(text[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        any_ |= bool(letter.any())
        c = np.where(letter, c, np.uint32(32))
        if at + BLOCK >= len(text):
            c = np.append(c, np.uint32(32))
        c = c[(c != 32) | (np.concatenate([tail[-1:], c[:-1]]) != 32)]
        whole = np.concatenate([tail, c]).astype(np.uint64)
        for n in ORDERS:
            part = whole[max(0, len(tail) - n + 1):]
            h = np.full(max(0, len(part) - n + 1), n * 0x9E3779B1, np.uint64)
            for i in range(n):
                h = (h ^ part[i:i + len(h)]) * np.uint64(0x100000001B3) + np.uint64(0x51ED27)
            h ^= h >> np.uint64(17)
            total += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        tail = whole[-(max(ORDERS) - 1):].astype(np.uint32)
    return total if any_ else None


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray          # BUCKETS
    weights: np.ndarray      # BUCKETS x labels
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(counts)
        x = (1.0 + np.log(counts[at])) * self.idf[at]
        return at, x / np.sqrt((x * x).sum())

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        at, x = self.vector(counts)
        return softmax((x @ self.weights[at] + self.bias) / self.temperature)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max())
    return e / e.sum()


def fit(samples: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray, epochs: int = EPOCHS, alpha: float = 1.0,
        beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 7) -> Model | None:
    """FTRL-proximal over (feature, count, label) samples; every fifth one only calibrates.  None without samples."""
    labels = sorted({y for _, _, y in samples})
    if not labels:
        return None
    k = len(labels)
    model = Model(labels, idf, np.zeros((BUCKETS, k)), np.zeros(k))
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    data = []
    for feature, count, y in samples:
        x = (1.0 + np.log(count)) * idf[feature]
        data.append((np.append(feature, BUCKETS), np.append(x / np.sqrt((x * x).sum()), 1.0), labels.index(y)))
    order = np.random.default_rng(seed).permutation(len(data))
    hold, learn = (order[::5], np.delete(order, slice(None, None, 5))) if len(data) >= 50 else (order, order)

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(epochs):
        for i in learn.tolist():
            at, x, y = data[i]
            w = weights(at)
            g = softmax(x @ w)
            g[y] -= 1.0
            g = x[:, None] * g
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(slice(None))
    model.weights, model.bias = w[:BUCKETS].astype(np.float32), w[BUCKETS]
    scores = [(x @ w[at], y) for at, x, y in (data[i] for i in hold.tolist())]

    def loss(t: float) -> float:
        return -sum(np.log(softmax(s / t)[y] + 1e-300) for s, y in scores)

    model.temperature = float(min(np.geomspace(0.5, 5.0, 40), key=loss))
    return model


def train(rows: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on columns (id, text, lang); rows without language or letter teach nothing.

    Document frequencies are counted over all rows.  The fit takes at most ``per_language`` rows (1,000 at most) of each
    language, those with the least hash of their id."""
    rows = rows.where("lang is not null and text is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column("text"):
                c = ngram_counts(t.as_py())
                if c is not None:
                    df += c > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["f", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "f long, n long").groupBy("f").agg(F.sum("n")).collect()  # BUCKETS + 1 rows
    df = np.zeros(BUCKETS + 1)
    for f, n in counted:
        df[f] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1.0

    # Equal rows of an id count once.  Per language a threshold on the hash lets through about OVER times as many as wanted,
    # so that what the exact limit sorts does not grow with the rows or the tasks.
    few = min(per_language, 1000)
    keyed = rows.withColumn("o", F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit(7)), 11)).withColumn("h", F.xxhash64("text", "id"))
    size = keyed.groupBy("lang").agg(F.approx_count_distinct(F.struct("o", "h")).alias("n")).select(F.col("lang").alias("of"), "n")
    share = F.least(F.lit(1.0), F.lit(float(OVER * few)) / F.col("n"))
    near = F.col("o") * F.lit(2.0 ** -53) <= share           # 53 bits as a fraction
    # A row for each language, of which the model has a column each: else all rows would be shuffled to their language.
    narrow = keyed.select("id", "lang", "o", "h").join(F.broadcast(size), F.col("lang") == F.col("of")).where(near).select("id", "lang", "o", "h").distinct()
    order = Window.partitionBy("lang").orderBy("o", "id", "h")
    first = (narrow.withColumn("r", F.row_number().over(order)).where(F.col("r") <= few)
             .select(F.col("id").alias("chosen"), F.col("lang").alias("chosen_lang"), F.col("h").alias("chosen_h")))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [ngram_counts(t.as_py()) for t in b.column("text")]
            ok = pa.array([c is not None for c in found])
            found = [c for c in found if c is not None]
            at = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang").filter(ok), b.column("o").filter(ok), pa.array([x.astype("<i4").tobytes() for x in at], pa.binary()),
                 pa.array([c[x].astype("<i4").tobytes() for c, x in zip(found, at)], pa.binary())], names=["lang", "o", "f", "n"])

    # At most per_language rows of each language.
    same = (F.col("id") == F.col("chosen")) & (F.col("lang") == F.col("chosen_lang")) & (F.col("h") == F.col("chosen_h"))
    chosen = (keyed.join(F.broadcast(first), same).select("lang", F.col("h").alias("o"), "text").distinct()
              .mapInArrow(sample, "lang string, o long, f binary, n binary"))
    samples = [(np.frombuffer(r.f, "<i4"), np.frombuffer(r.n, "<i4"), r.lang) for r in sorted(chosen.collect(), key=lambda r: (r.lang, r.o))]
    return fit(samples, idf)


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; rows without an id are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """All columns of ``docs`` with ``held_out`` boolean, ``lang_pred`` string and ``score`` double (calibrated probability),
    which replace columns of these names.

    Learns from text and language of the rows that are not held out; predictions see the text only.  A text
    that is NULL or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn from.
    Repeated rows are predicted each; an empty table gives an empty result."""
    return _predicted(docs, _model(docs, id_col, text_col, lang_col, per_language), id_col, text_col)


def _model(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> Model | None:
    learn = docs.where(~held_out(id_col))
    return train(learn.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), per_language)


def _predicted(docs: DataFrame, model: Model | None, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in parts:
            found = []
            for t in s:
                c = ngram_counts(t) if m is not None else None
                if c is None:
                    found.append((UNDETERMINED, 0.0))
                else:
                    p = m.probabilities(c)
                    found.append((m.labels[int(p.argmax())], float(p.max())))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    made = "predicted"
    while made in docs.columns:
        made += "_"
    return (docs.withColumn(made, predict(F.col(text_col))).withColumns(
        {"held_out": held_out(id_col), "lang_pred": F.col(f"{made}.lang_pred"), "score": F.col(f"{made}.score")}).drop(made))


def keep_identified(docs: DataFrame, over_chance: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language can be told: with a letter, and a calibrated probability of at least
    ``over_chance`` times that of a guess among the learned languages.  Without anything to learn from no row is rejected.  Any column names may occur."""
    rows = docs.select(F.struct(F.col("*")).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = _model(rows, "id", "text", "lang", per_language)
    if model is None:
        return docs
    told = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min(1.0, over_chance / len(model.labels)))
    return _predicted(rows, model, "id", "text").where(told).select("row.*")
