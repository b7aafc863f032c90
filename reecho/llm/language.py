"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training documents. The weights are trained with
follow-the-regularised-leader (McMahan et al. 2013) under an elastic-net penalty, on a bounded sample for
each language, and probabilities are calibrated with a temperature fitted on held-out sample rows. The limits of what counts as
in a learned language come from all held-out documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reecho.llm.common import mixed, ship

UNKNOWN = "und"
# A rank among held-out excerpts is exact to the reciprocal of this share.
RANKS = 100_000
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class LanguageParams:
    """``sample``: about so many documents a language are used to fit weights. ``dims``: hashed n-gram features.

    ``excerpt`` and ``error``: the limits of ``LanguageModel.accepts`` let about that share of held-out excerpts of so many
    characters go, half of it by each.
    """

    sample: int = 800
    dims: int = 1 << 15
    orders: tuple[int, ...] = (1, 2, 3)
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-4
    epochs: int = 3
    excerpt: int = 40
    error: float = 0.01
    seed: int = 11


def grams(text: str, params: LanguageParams) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and counts of a whole text's character n-grams, in lower case, digits alike."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes >= 48) & (codes <= 57)] = 48
    codes[codes < 33] = 32
    found = []
    for order in params.orders:
        if len(codes) >= order:
            total = np.full(len(codes) - order + 1, order, np.uint64)
            for i in range(order):
                total = total * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - order + 1 + i]
            found.append((mixed(total) % np.uint64(params.dims)).astype(np.int64))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(codes) > params.dims // 8:
        counts = np.bincount(np.concatenate(found), minlength=params.dims)
        at = np.flatnonzero(counts)
        return at, counts[at]
    return np.unique(np.concatenate(found), return_counts=True)


def excerpt(text: str, params: LanguageParams) -> str:
    """About ``params.excerpt`` characters from the middle, from the start of a word on; empty if there is no letter in them."""
    text = text.strip()
    start = max(0, (len(text) - params.excerpt) // 2)
    if start:
        start = text.find(" ", start, start + params.excerpt // 2) + 1 or start
    cut = text[start : start + params.excerpt]
    return cut if _LETTER.search(cut) else ""


@dataclass
class LanguageModel:
    params: LanguageParams
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    most_strange: float = float("inf")

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        value = np.log1p(counts) * self.idf[at]
        return value / max(float(np.sqrt(value @ value)), 1e-12)

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(at, counts) @ self.weights[at] + self.bias

    def strangeness(self, at: np.ndarray, counts: np.ndarray) -> float:
        """Mean rarity of a text's n-grams among the training documents."""
        return float(self.idf[at] @ counts / max(counts.sum(), 1))

    def judged(self, at: np.ndarray, counts: np.ndarray) -> tuple[int, float]:
        """The best language and its probability."""
        scores = self.logits(at, counts) / self.temperature
        chances = np.exp(scores - scores.max())
        best = int(chances.argmax())
        return best, float(chances[best] / chances.sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        best, score = self.judged(*grams(text, self.params))
        return self.languages[best], score

    def accepts(self, text: str | None) -> bool:
        """Whether the text is in a learned language: its best probability and its n-grams are as in held-out texts."""
        if text is None or not self.languages or not _LETTER.search(text):
            return False
        found = grams(text, self.params)
        return self.judged(*found)[1] >= self.least_score and self.strangeness(*found) <= self.most_strange

    def calibrate(self, excerpts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Sets the limits from the sample's excerpts; ``calibrated`` sets them from all held-out texts."""
        if excerpts:
            half = self.params.error / 2
            self.least_score = float(np.quantile([self.judged(*x)[1] for x in excerpts], half, method="lower"))
            self.most_strange = float(np.quantile([self.strangeness(*x) for x in excerpts], 1 - half, method="higher"))


def document_frequencies(texts: DataFrame, params: LanguageParams) -> tuple[np.ndarray, int]:
    """In how many of all the texts each feature occurs, and how many texts there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(params.dims + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total[grams(text, params)[0]] += 1
                total[params.dims] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": at, "times": total[at]})

    parts = texts.select("text").mapInPandas(run, "feature bigint, times bigint")
    result = np.zeros(params.dims + 1, np.int64)
    for row in parts.groupBy("feature").agg(F.sum("times").alias("times")).collect():
        result[row["feature"]] = row["times"]
    return result[:-1], int(result[-1])


def _sample(training: DataFrame, params: LanguageParams) -> pd.DataFrame:
    """About ``params.sample`` rows of each language: the features of the text and of a short excerpt, not the texts."""
    sizes = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chance = sizes.select("lang", (F.lit(float(params.sample)) / F.col("n")).alias("chance")).collect()
    if not chance:
        return pd.DataFrame({"lang": [], "at": [], "counts": [], "short_at": [], "short_counts": []})
    share = F.lit(0.0)
    for row in chance:
        share = F.when(F.col("lang") == row["lang"], F.lit(row["chance"])).otherwise(share)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            columns = {"lang": batch["lang"]}
            for prefix, texts in (("", batch["text"]), ("short_", [excerpt(text, params) for text in batch["text"]])):
                found = [grams(text, params) for text in texts]
                for i, name in enumerate(("at", "counts")):
                    columns[prefix + name] = [f[i].astype(np.int32) for f in found]
            yield pd.DataFrame(columns)

    chosen = training.where(F.rand(params.seed) < share).select("lang", "text")
    schema = "lang string, at array<int>, counts array<int>, short_at array<int>, short_counts array<int>"
    return chosen.mapInPandas(run, schema).toPandas()


def train(training: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """Model from ``training(text, lang)``. Rows with a null text or lang are left out."""
    ship(training.sparkSession)
    usable = training.select("text", "lang").where("text is not null and lang is not null")
    frequencies, total = document_frequencies(usable, params)
    sample = _sample(usable, params)
    languages = sorted(set(sample["lang"]))
    k = len(languages)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    model = LanguageModel(params, languages, idf, np.zeros((params.dims, k)), np.zeros(k))
    if not k:
        return model
    rng = np.random.default_rng(params.seed)
    order = rng.permutation(len(sample))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    rows = [(np.array(a, np.int64), np.array(c, np.int64)) for a, c in zip(sample["at"], sample["counts"], strict=True)]
    labels = np.array([languages.index(x) for x in sample["lang"]])
    model.weights, model.bias = _follow_leader(model, rows, labels, used, rng)
    logits = np.array([model.logits(*rows[i]) for i in held]).reshape(len(held), k)
    model.temperature = _temperature(logits, labels[held])
    model.weights = model.weights.astype(np.float32)
    shorts = [(np.array(sample["short_at"][i], np.int64), np.array(sample["short_counts"][i], np.int64)) for i in [*held, *used]]
    # too few rows to hold any out: limits from those that the weights were fitted on, rather than none
    model.calibrate([x for x in shorts[: len(held)] if len(x[0])] or [x for x in shorts if len(x[0])])
    return model


def calibrated(model: LanguageModel, held: DataFrame) -> LanguageModel:
    """The model with limits from the excerpts of all of ``held(text, lang)`` that are in a learned language.

    Without such an excerpt the limits stay those of the sample. Ranks are exact to a hundred-thousandth of the rows.
    """
    if not model.languages:
        return model
    ship(held.sparkSession)
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            cut = [excerpt(text, own.params) for text in batch["text"]]
            found = [grams(text, own.params) for text in cut if text]
            yield pd.DataFrame({"score": [own.judged(*x)[1] for x in found], "strange": [own.strangeness(*x) for x in found]}, dtype=float)

    usable = held.where(F.col("text").isNotNull() & F.col("lang").isin(model.languages)).select("text")
    half = model.params.error / 2
    limits = usable.mapInPandas(run, "score double, strange double").agg(
        F.percentile_approx("score", half, RANKS).alias("least"), F.percentile_approx("strange", 1 - half, RANKS).alias("most")
    ).first()
    shared.destroy()
    return model if limits.least is None else replace(model, least_score=limits.least, most_strange=limits.most)


def _follow_leader(model: LanguageModel, rows: list, labels: np.ndarray, used: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    params, k = model.params, len(model.languages)
    # the last row is the bias
    z, n = np.zeros((params.dims + 1, k)), np.zeros((params.dims + 1, k))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * params.l1 - z[at]
        return np.where(np.abs(z[at]) > params.l1, shrunk / ((params.beta + np.sqrt(n[at])) / params.alpha + params.l2), 0.0)

    for _ in range(params.epochs):
        for i in rng.permutation(used):
            at = np.append(rows[i][0], params.dims)
            x = np.append(model.vector(*rows[i]), 1.0)
            w = weights(at)
            scores = x @ w
            chances = np.exp(scores - scores.max())
            chances /= chances.sum()
            chances[labels[i]] -= 1
            grad = x[:, None] * chances
            new = n[at] + grad**2
            z[at] += grad - (np.sqrt(new) - np.sqrt(n[at])) / params.alpha * w
            n[at] = new
    final = weights(slice(None))
    return final[:-1], final[-1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The scale of log-odds with the least loss on held-out rows."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0] - scaled[np.arange(len(labels)), labels]).mean())

    return float(min(np.geomspace(0.05, 10, 60), key=loss))


def predicted(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Struct column ``(lang, score)`` for a text column."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame(found, columns=["lang", "score"])

    return judge(F.col(text))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row per input row.

    ``und`` with score 0 for null texts, texts without a letter, and a model that has learned no language. Other
    columns are not looked at.
    """
    return docs.select("doc_id", predicted(model, docs).alias("found")).select(
        "doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``min_score``."""
    found = predicted(model, docs)
    return docs.where((found["lang"] != UNKNOWN) & (found["score"] >= min_score))


def keep_accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts are in a language that the model has learned."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.accepts(t if isinstance(t, str) else None) for t in texts], dtype=bool)

    return docs.where(judge(F.col("text")))
