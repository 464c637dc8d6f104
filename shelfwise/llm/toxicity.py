"""Toxicity by a counterfactually regularised linear classifier.

A text's features are its distinct words (letters only, lower case) and the
words' beginnings of three to seven letters. Those whose share of label 1 is less likely by chance than one in the number of all
words enter a logistic regression with a small ridge, fitted by coordinate
descent. In every training text that names a group (``IDENTITY_TERMS``), the
sentences that do so are repeated with the term swapped for others and with the
term left out, and the squared change of the text's score is part of the loss: a
neutral mention of one group should score like that of another, and like none.
What such a change touches enters the regression too, with all labelled texts
that have it.

Fitting takes at most ``TRAIN_ROWS`` distinct labelled ids, chosen by a hash of the id, each
with one text; scoring covers every whole text, however long, and each of repeated rows. A null or empty text gets the score of a text
without features. Labels other than 0 and 1 and null labels or ids are not
learned from; of several labels for an id each counts, of several texts the one of
the smallest hash. Columns other than the id and the text are not read. Without any label to
learn from, every score is next to 0 and nothing is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import crc_remainder
from shelfwise.llm.learning import labelled_texts
from shelfwise.session import cut_lineage

TRAIN_ROWS = 8_000
LEAST_DOCS = 3              # training texts that a word must be in
SWAP_WEIGHT = 4.0           # weight of a swapped sentence's squared score change
RIDGE = 2e-4                # a training text
#: Terms that name a group, by kind; a term is swapped for the next ones of its kind.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("woman", "man", "girl", "boy"), ("women", "men", "girls", "boys"), ("female", "male"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "transgender", "trans"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "mexican", "chinese", "indian"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly"), ("blind", "deaf", "disabled", "autistic"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("musulmán", "cristiano", "judío"),
    ("frau", "mann"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("musulman", "chrétien", "juif"),
)
BEGINNINGS = range(3, 8)
SWAPS = 2                   # counterfactuals made of one text and term
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(words: set[str]) -> set[str]:
    """The words, and their beginnings marked with a star."""
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


#: All that a counterfactual can lose or gain.
IDENTITY_FEATURES = features({t for kind in IDENTITY_TERMS for t in kind})


def without_terms(text: str | None) -> list[set[str]]:
    """The text's words without one of the terms that it has, for each of them."""
    own = words_of(text)
    return [own - {term} for kind in IDENTITY_TERMS for term in kind if term in own]


def swapped_words(text: str | None) -> list[set[str]]:
    """The word sets of the text's counterfactuals that name another group."""
    kinds = {t: kind for kind in IDENTITY_TERMS for t in kind}
    own = words_of(text)
    out = []
    for term in sorted(own & kinds.keys()):
        kind = kinds[term]
        at = kind.index(term)
        for other in [kind[(at + i) % len(kind)] for i in range(1, min(SWAPS, len(kind) - 1) + 1)]:
            swap = lambda s: re.sub(rf"(?<![^\W\d_]){re.escape(term)}(?![^\W\d_])", other, s.lower())
            out.append(set().union(*(words_of(swap(s)) for s in SENTENCE.split(text))))
    return out


class Model:
    """Weights by word, and the score of a text without any."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[w] for w in sorted(features(words_of(text)) & self.weights.keys()))
        return 1 / (1 + float(np.exp(-max(-500.0, min(500.0, z)))))


def fit(texts: list[set[str]], labels: list[int], swaps: list[tuple[set[str], set[str]]], swap_weight: float = SWAP_WEIGHT) -> Model:
    """``texts``: the features of each training text that may enter; ``swaps``:
    the features that a counterfactual loses and gains."""
    n = len(texts)
    if not n:
        return Model({}, -500.0)
    rate = (sum(labels) + 0.5) / (n + 1)
    bias = float(np.log(rate / (1 - rate)))
    if not 0 < sum(labels) < n:
        return Model({}, bias)
    names = sorted(set().union(*texts, *(a | b for a, b in swaps)))
    at = [np.array([i for i, own in enumerate(texts) if f in own], np.int64) for f in names]
    # for each feature, the swaps whose score change it is part of
    change = [np.array([k for k, (a, b) in enumerate(swaps) if f in a or f in b], np.int64) for f in names]
    sign = [np.array([1.0 if f in swaps[k][0] else -1.0 for k in ks]) for f, ks in zip(names, change)]
    y, moved = np.array(labels, float), np.zeros(len(swaps))
    w, z = np.zeros(len(names)), np.full(n, bias)
    ridge = max(RIDGE * n, 0.05)

    def chance(own: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(own, -30, 30)))

    for _ in range(100):
        largest = 0.0
        for j in range(len(names)):
            p = chance(z[at[j]])
            g = (p - y[at[j]]).sum() + ridge * w[j] + swap_weight * (moved[change[j]] * sign[j]).sum()
            h = (p * (1 - p)).sum() + ridge + swap_weight * len(change[j])
            step = float(np.clip(-g / h, -1, 1))
            w[j] += step
            z[at[j]] += step
            moved[change[j]] += step * sign[j]
            largest = max(largest, abs(step))
        p = chance(z)
        step = float(np.clip((y - p).sum() / ((p * (1 - p)).sum() + 1e-6), -1, 1))
        bias += step
        z += step
        if max(largest, abs(step)) < 1e-4:
            break
    return Model({name: float(x) for name, x in zip(names, w) if x}, bias)


def unlikely(hits: int, n: int, rate: float, level: float) -> bool:
    """Whether so many or so few of ``n`` texts labelled 1 have a chance below ``level`` at this rate of labels."""
    more = hits >= n * rate
    if n < LEAST_DOCS or (rate ** n > level if more else (1 - rate) ** n > level):
        return False
    if more and hits < 1.2 * n * rate:
        return False
    log = lambda k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * np.log(rate) + (n - k) * np.log(1 - rate)
    return sum(float(np.exp(log(k))) for k in (range(hits, n + 1) if more else range(hits + 1))) < level


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS, swap_weight: float = SWAP_WEIGHT) -> Model:
    """Fits on labelled rows whose id has a crc32 that 5 does not divide.

    Features are counted and screened as a Spark job; the driver gets only the
    few that stand out or belong to an identity term, and which of them each
    training text has.
    """
    sample = cut_lineage(labelled_texts(docs, labels, train_rows, id_col, text_col, label_col, crc_remainder("id", 5) > 0), "toxicity-sample")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    rate = (ones + 0.5) / (n + 1)

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "own": [sorted(features(words_of(t))) for t in batch["text"]]})

    counts = cut_lineage(sample.select("label", "text").mapInPandas(every, "label int, own array<string>")
                         .select("label", F.explode("own").alias("feature"))
                         .groupBy("feature").agg(F.count("*").alias("n"), F.sum("label").alias("hits")), "toxicity-counts")
    level = 1 / max(1, counts.count())
    apart = F.abs(F.col("hits") - F.col("n") * rate) > 2.5 * F.sqrt(F.col("n") * (rate * (1 - rate)))
    names = {r.feature for r in counts.where((F.col("n") >= LEAST_DOCS) & apart).toLocalIterator() if unlikely(r.hits, r.n, rate, level)}

    wanted = names | IDENTITY_FEATURES

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [features(words_of(t)) for t in batch["text"]]
            diffs = [[(sorted(a - b), sorted(b - a)) for b in map(features, swapped_words(t) + without_terms(t))] for t, a in zip(batch["text"], own)]
            yield pd.DataFrame({"id": batch["id"].astype(str), "label": batch["label"], "own": [sorted(a & wanted) for a in own],
                                "lost": [[x for x, _ in d] for d in diffs], "gained": [[x for _, x in d] for d in diffs]})

    rows = sample.mapInPandas(kept, "id string, label int, own array<string>, lost array<array<string>>, gained array<array<string>>").collect()
    rows.sort(key=lambda r: (r.id, r.label, r.own))
    enter = names.union(*(x for r in rows for x in r.lost + r.gained))
    return fit([enter.intersection(r.own) for r in rows], [r.label for r in rows],
               [(set(a), set(b)) for r in rows for a, b in zip(r.lost, r.gained)], swap_weight)


def score_column(text: str, model: Model):
    """The score of a text column, 0 to 1."""

    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(model.score, na_action=None).astype(float)

    return run(F.col(text))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), score_column("text", model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
