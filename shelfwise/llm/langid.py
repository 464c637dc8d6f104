"""Language identification by hierarchical discrimination.

Features are hashed runs of one to three characters of the text in lower case,
with everything but letters turned into one space. A first set of linear
support vector machines tells language families apart, one for each family against
the rest (of two families, one machine); then, within the family, one-versus-one
machines separate the related languages. So machines grow with the number of
languages, not with its square, as a language that ``FAMILIES`` does not name is a
family of its own. Each machine's score is an average of character-run weights, so a text is scored in one pass
over its characters whatever its length.

Fitting takes about ``ROWS_A_LANGUAGE`` rows of each language, chosen by a
hash of id and text; rows of equal id and text are one document given
repeatedly and count once. A machine of a family sees at most about ``REST_ROWS`` rows of
the rest, dealt evenly over them. Ids may be of any type. Every whole text gets a prediction. A text that is null
or has no letter is ``und`` with score 0; so is any text if nothing was
learned. A single learned language is always predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import crc_remainder
from shelfwise.llm.learning import hashed_below

ROWS_A_LANGUAGE = 1500
REST_ROWS = 6000
SLOTS = 1 << 15
CHARACTERS_AT_ONCE = 1_000_000
#: Language families by ISO code; a language that isn't here is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ca": "romance", "ro": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "fi": "uralic", "et": "uralic",
    "hu": "uralic", "ar": "semitic", "he": "semitic", "hi": "indic", "bn": "indic", "ur": "indic",
}


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def character_runs(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Slots of all runs of one to three characters; empty if there's no letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    good = letters[code]
    if not good.any():
        return np.zeros(0, np.int64)
    code = np.where(good, code, np.uint32(32))
    keep = good.copy()
    keep[1:] |= good[:-1]                      # the first of other characters after a letter
    c = np.concatenate([[32], code[keep], [32]]).astype(np.uint32)
    a, b, d = c * np.uint32(0x9E3779B1), c * np.uint32(0x85EBCA77), c * np.uint32(0xC2B2AE3D)
    two = a[:-1] + (b[1:] ^ (b[1:] >> np.uint32(15)))
    three = two[:-1] * np.uint32(5) + (d[2:] ^ (d[2:] >> np.uint32(13)))
    runs = np.concatenate([a[1:-1] ^ np.uint32(0x5BD1E995), two, three])
    return ((runs ^ (runs >> np.uint32(16))) * np.uint32(0x45D9F3B) >> np.uint32(17)).astype(np.int64)


def train_machine(rows: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, cost: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Dual coordinate descent for a linear SVM; the last weight is the bias."""
    w, alpha = np.zeros(SLOTS + 1), np.zeros(len(rows))
    square = np.array([float(v @ v) + 1 for _, v in rows])
    share = {s: len(side) / (2 * max(1, (side == s).sum())) for s in (-1, 1)}
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            slope = side[i] * (w[at] @ v + w[-1]) - 1
            now = min(max(alpha[i] - slope / square[i], 0), cost * share[int(side[i])])
            if now != alpha[i]:
                w[at] += (now - alpha[i]) * side[i] * v
                w[-1] += (now - alpha[i]) * side[i]
                alpha[i] = now
    return w


class Model:
    """Machines by pair of classes, (family, None) for a family against the rest: families first, then languages of one family."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, str]]):
        self.langs = sorted({r[2] for r in rows})
        family = {x: FAMILIES.get(x, x) for x in self.langs}
        self.families = {f: [x for x in self.langs if family[x] == f] for f in sorted(set(family.values()))}
        mean = np.full(SLOTS, 1e-7)
        for at, n, _ in rows:
            mean[at] += n / n.sum() / len(rows)
        scale = 1 / np.sqrt(mean)              # rare runs weigh as much as frequent ones
        data = [(at, (n / n.sum() * scale[at])) for at, n, _ in rows]
        size = np.sqrt(np.mean([float(v @ v) for _, v in data])) if data else 1.0
        data = [(at, v / size) for at, v in data]
        self.pairs: list[tuple[str, str | None]] = []
        weights = []
        groups = [(list(self.families), [family[r[2]] for r in rows])]
        groups += [(own, [r[2] for r in rows]) for own in self.families.values()]
        for level, (names, label) in enumerate(groups):
            label = np.array(label)
            for a, b in ((f, None) for f in names) if level == 0 and len(names) > 2 else combinations(sorted(names), 2):
                other = np.flatnonzero(label != a if b is None else label == b)
                if b is None:
                    other = other[::-(-len(other) // REST_ROWS)]
                own = np.sort(np.concatenate([np.flatnonzero(label == a), other]))
                w = train_machine([data[i] for i in own], np.where(label[own] == a, 1, -1))
                w[:-1] *= scale / size
                self.pairs.append((a, b))
                weights.append(w)
        self.weights = np.array(weights).reshape(-1, SLOTS + 1).T.copy()

    def choose(self, names: list[str], margin: dict[tuple[str, str | None], float]) -> tuple[str, float]:
        """The class with most votes, then the largest sum of margins, or with the largest margin against the rest; its share of belief."""
        names = sorted(names)
        if len(names) == 1:
            return names[0], 1.0
        if (names[0], None) in margin:
            best = max(names, key=lambda x: margin[x, None])
            return best, 1 / (1 + float(np.exp(-4 * max(-50.0, min(50.0, margin[best, None])))))
        votes, total = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for a, b in combinations(names, 2):
            m = margin[a, b]
            votes[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
        best = max(names, key=lambda x: (votes[x], total[x]))
        sure = total[best] / (len(names) - 1)
        return best, 1 / (1 + float(np.exp(-4 * max(-50.0, min(50.0, sure)))))

    def predict(self, texts: list[str | None], letters: np.ndarray) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        runs: list[np.ndarray] = []
        for k, text in enumerate(texts, 1):
            runs.append(character_runs(text, letters))
            if sum(map(len, runs[-64:])) > CHARACTERS_AT_ONCE or len(runs) == 64 or k == len(texts):
                out += self.judge(runs)
                runs = []
        return out

    def judge(self, runs: list[np.ndarray]) -> list[tuple[str, float]]:
        size = np.array([len(r) for r in runs])
        full = np.flatnonzero(size)
        margins = np.zeros((len(runs), len(self.pairs)))
        if len(full) and self.pairs:
            begin = (np.cumsum(size) - size)[full]
            slots = np.concatenate(runs)
            for p in range(len(self.pairs)):
                margins[full, p] = np.add.reduceat(self.weights[:, p][slots], begin) / size[full] + self.weights[-1, p]
        out = []
        for n, row in zip(size, margins):
            if not n or not self.langs:
                out.append(("und", 0.0))
                continue
            margin = dict(zip(self.pairs, row.tolist()))
            family, sure = self.choose(list(self.families), margin)
            lang, more = self.choose(self.families[family], {p: m for p, m in margin.items() if p[1] is not None})
            out.append((lang, sure * more))
        return out


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_a_language: int = ROWS_A_LANGUAGE) -> Model:
    """Fits on rows with a language whose id's crc32 leaves 0, 1 or 3 modulo 4."""
    known = (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
             .where((crc_remainder("id", 4) != 2) & F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    counts = {r.lang: min(r.n, r.differ) for r in known.groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("id", "text")).alias("differ")).collect()}
    if not counts:
        return Model([])
    shares = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows_a_language / max(1, n))))])
    chosen = known.where(hashed_below(shares[F.col("lang")], "id", "text")).distinct()

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for batch in batches:
            runs = [character_runs(t, letters) for t in batch["text"]]
            found = [np.unique(r, return_counts=True) for r in runs]
            yield pd.DataFrame({"id": batch["id"], "lang": batch["lang"], "at": [a.astype(np.int32) for a, _ in found],
                                "n": [n.astype(np.int32) for _, n in found]})

    rows = (chosen.select("id", "lang", "text").mapInPandas(features, "id string, lang string, at array<int>, n array<int>").collect())
    rows = [(r.id, r.lang, np.array(r.at, np.int64), np.array(r.n, float)) for r in rows if r.at]
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    return Model([(at, n, lang) for _, lang, at, n in rows])


def predict_column(text: str, model: Model):
    """struct(lang_pred, score) of a text column."""

    @pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for batch in batches:
            yield pd.DataFrame(model.predict(batch.tolist(), letters), columns=["lang_pred", "score"])

    return run(F.col(text))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), predict_column("text", model).alias("p"))
            .select("doc_id", "held_out", "p.*"))
