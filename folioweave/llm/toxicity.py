"""Toxicity: a linear classifier whose score must not change when identity terms are swapped.

Features are the presence of words and of word beginnings (4 to 8 letters). Which ones count is chosen by chi-square over a
bounded sample of labelled texts, counted in Spark. Training minimises log loss, a ridge term, and the squared difference
between each sampled text's score and its score with identity terms exchanged for others of their group, so that a neutral
mention of a group does not carry a score. The whole corpus is scored in one pass over whole texts, without a shuffle.

Defined cases: a null or empty text has the score of a text without features; labels that are null, or of ids that no
document has, teach nothing; with several labels for one id the largest holds, and of several texts for one id the one with
the smallest hash is learned from; without both classes the score is the share
of toxic rows (0 without any); repeated rows are scored alike; other columns of the input pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from folioweave.llm.common import settle, ship, text_key

WORD = re.compile(r"[^\W\d_]+")

#: Lengths of the word beginnings that count, so that inflected and compound words share what they are made of.
STEMS = (4, 5, 6, 7, 8)
NEUTRAL = "people"
#: Terms of one line may stand for each other.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "african", "latino", "arab", "indian", "mexican", "chinese", "american"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("blind", "deaf", "disabled"), ("old", "young", "elderly"),
)


def marks(word: str) -> list[str]:
    """Features of a word: itself, and its beginnings, marked by a star."""
    return [word, *[f"{word[:n]}*" for n in STEMS if len(word) > n]]


def features(text: str | None, wanted: dict[str, int] | None = None) -> set:
    """Features of a whole text; only the wanted ones, as numbers, if given."""
    found: set = set()
    for w in set(WORD.findall((text or "").lower())):
        for m in marks(w):
            if wanted is None:
                found.add(m)
            elif m in wanted:
                found.add(wanted[m])
    return found


def swaps(text: str | None, groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS) -> Iterator[str]:
    """Texts in which each identity term gives way to another of its group, for every step through the groups, and to a
    word that names no group."""
    low = (text or "").lower()
    place = {t: (g, i) for g in groups for i, t in enumerate(g)}
    if not any(w in place for w in WORD.findall(low)):
        return
    for step in range(1, max(map(len, groups))):
        def turn(m: re.Match, step: int = step) -> str:
            g, i = place.get(m.group(), ((m.group(),), 0))
            return g[(i + step) % len(g)]
        yield WORD.sub(turn, low)
    yield WORD.sub(lambda m: NEUTRAL if m.group() in place else m.group(), low)


@dataclass
class Model:
    wanted: dict[str, int]
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weight[i] for i in features(text, self.wanted))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def train(x: np.ndarray, y: np.ndarray, gaps: np.ndarray, *, ridge: float = 1.0, fair: float = 10.0,
          steps: int = 12) -> tuple[np.ndarray, float]:
    """Newton steps on log loss + ridge * |w|^2 / 2 + fair * sum (w . gap)^2 / 2 over the swapped texts' feature gaps."""
    n, k = x.shape
    y = np.asarray(y, float)
    w, b = np.zeros(k), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    held = ridge * np.eye(k) + (fair * gaps.T @ gaps if len(gaps) else 0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = np.append(x.T @ (p - y) + held @ w, (p - y).sum())
        s = np.maximum(p * (1 - p), 1e-6)
        xs = x * s[:, None].astype(x.dtype)
        h = np.empty((k + 1, k + 1))
        h[:k, :k], h[:k, k], h[k, :k], h[k, k] = xs.T @ x + held, xs.sum(0), xs.sum(0), s.sum() + 1e-6
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w, b = w - step[:k], b - step[k]
        if np.abs(step).max() < 1e-6:
            break
    return w, float(b)


def held_out(id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", *,
        max_rows: int = 16_000, min_docs: int = 5, n_features: int = 768) -> Model:
    """Learn from about ``max_rows`` labelled rows at most, chosen by a hash of the id, none of them held out.

    The driver receives ``n_features`` counted features and, per sampled row, the numbers of the features it has.
    """
    ship()
    known = (labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
             .groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("y")))
    parts = 1 << 20
    total = known.count()
    share = min(parts, int(parts * max_rows / max(total, 1)))
    few = known.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < share)
    rows = (docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(few), "id").groupBy("id", "y")
            .agg(F.min(F.struct(text_key(F.col("text")).alias("key"), "text")).alias("first")).select("first.text", "y"))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, bad = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch["text"], batch["y"], strict=True):
                f = features(t)
                n.update(f)
                n[""] += 1
                if y:
                    bad.update(f)
                    bad[""] += 1
        yield pd.DataFrame([(m, c, bad[m]) for m, c in n.items()], columns=["mark", "n", "bad"])

    counts = rows.mapInPandas(tally, "mark string, n long, bad long").groupBy("mark").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    counts = settle(counts, "toxic-features")
    base = counts.where("mark = ''").first()
    if base is None or not 0 < base["bad"] < base["n"]:
        share_bad = 0.0 if base is None else base["bad"] / base["n"]
        return Model({}, np.zeros(0), float(np.clip(np.log(max(share_bad, 1e-9) / max(1 - share_bad, 1e-9)), -20, 20)))
    all_, toxic = base["n"], base["bad"]
    want = F.col("n") * (toxic / all_)
    chi = F.pow(F.col("bad") - want, 2) / (want * (1 - toxic / all_)) * all_ / (all_ - F.col("n") + 1)
    chosen = (counts.where((F.col("mark") != "") & (F.col("n") >= min(min_docs, max(2, all_ // 50))))
              .orderBy(chi.desc(), "mark").limit(n_features).collect())
    wanted = {r["mark"]: i for i, r in enumerate(chosen)}

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, y in zip(batch["text"], batch["y"], strict=True):
                out.append((int(y), sorted(features(t, wanted)), False))
                out += [(int(y), sorted(features(s, wanted)), True) for s in swaps(t)]
            yield pd.DataFrame(out, columns=["y", "has", "swapped"])

    got = rows.mapInPandas(sparse, "y int, has array<int>, swapped boolean").collect()
    plain = [r for r in got if not r["swapped"]]
    x = np.zeros((len(plain), len(wanted)), np.float32)
    gaps = np.zeros((len(got) - len(plain), len(wanted)), np.float32)
    at = -1
    for i, r in enumerate(got):
        if r["swapped"]:
            gaps[i - at - 1] -= x[at]
            gaps[i - at - 1, r["has"]] += 1
        else:
            at += 1
            x[at, r["has"]] = 1
    w, b = train(x, np.array([r["y"] for r in plain], np.float32), gaps)
    return Model(wanted, w, b)


def score(text: Column, model: Model) -> Column:
    """Probability of a toxic text, 0 to 1."""

    ship()

    @F.pandas_udf(DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return run(text)
