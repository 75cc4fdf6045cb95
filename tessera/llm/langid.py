"""Language identification by nearest centroid over TF-IDF vectors of character n-grams.

Each text becomes a normalised vector of hashed character bigrams and trigrams (letters only, runs
of anything else are one space), term frequency damped by a logarithm and weighted by inverse
document frequency. Every language has several centroids, clustered from its own documents, and a
text takes the language whose nearest centroid has the largest cosine. A text that is farther from
its centroid than nearly all learned texts of that centroid is marked ``rejected``.

Defined results: null text or no letter gives language ``und``, score 0, not rejected; ties go to
the language that sorts first; repeated rows are predicted alike; only ``doc_id``, ``text`` and (for
learning) ``lang`` are read. Without learnable rows every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, fit_sample, persist, prepare

UNKNOWN = "und"
#: Buckets for bigrams and trigrams together.
DIMENSIONS = 1 << 13
#: Code points handled at a time: bounds memory on very long texts.
BLOCK = 1 << 18
#: Bound of the labelled rows the centroids are fitted on, shared out evenly over the languages.
MAX_FIT_ROWS = 8_000
CLUSTERS = 4
ROUNDS = 8
#: Of the learned texts of a centroid, the share that lies farther away than its rejection distance.
REJECTED_SHARE = 0.005


_LETTERS: list[np.ndarray] = []


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0][codes]


def counts_of(text: str | None) -> np.ndarray | None:
    """n-gram counts of a whole text; None if it has no letter."""
    if not text:
        return None
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    any_letter = False
    for at in range(0, len(text), BLOCK):
        # Two code points of overlap: the n-grams over the border belong to the later block.
        codes = np.frombuffer(text[max(0, at - 2):at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = _letters(codes)
        if not letters.any():
            continue
        any_letter = True
        keep = letters | np.concatenate(([True], letters[:-1]))
        codes = np.where(letters, codes, 32)[keep].astype(np.uint32)
        codes = np.concatenate((np.array([32], dtype=np.uint32), codes, np.array([32], dtype=np.uint32)))
        two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] * np.uint32(0xC2B2AE35) + codes[2:] * np.uint32(0x27D4EB2F)
        for grams in (two, three):
            total += np.bincount((grams ^ (grams >> np.uint32(15))) % np.uint32(DIMENSIONS), minlength=DIMENSIONS)
    return total if any_letter else None


@dataclass
class Centroids:
    languages: list[str]          # of each centroid
    vectors: np.ndarray           # centroid x dimension, each of length 1
    idf: np.ndarray
    least: np.ndarray             # cosine under which a text is rejected

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        size = np.sqrt(v @ v)
        return v / size if size else v


def vectors_of(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts).astype(np.float32) * idf.astype(np.float32)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; after the text nearest the mean, start texts are drawn by their distance from those drawn."""
    draw = np.random.default_rng(8)
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        far = np.maximum(1.0 - near, 0.0).astype(np.float64) ** 2
        if far.sum() <= 0:
            break
        chosen.append(int(draw.choice(len(vectors), p=far / far.sum())))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) for c in range(len(centres))])
        filled = np.bincount(own, minlength=len(centres)) > 0
        centres = np.where(filled[:, None], sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12), centres)
    return centres


def learn_centroids(docs: DataFrame, max_rows: int = MAX_FIT_ROWS, clusters: int = CLUSTERS) -> Centroids | None:
    """Fit idf and centroids on texts with a language whose crc32(doc_id) mod 5 is not 0.

    At most about ``max_rows`` rows, spread over the languages and chosen by a hash, take part. One
    task per language clusters them.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 5) != 0))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = max(1, max_rows // len(sizes))
    keep = F.lit(False)
    for lang, n in sizes.items():
        keep = keep | fit_sample(rows, F.col("lang") == lang, share, n, 8)

    @F.pandas_udf("array<int>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [counts_of(t) for t in texts]
            yield pd.Series([None if c is None else np.stack((np.flatnonzero(c), c[np.flatnonzero(c)])).ravel().astype(np.int32)
                             for c in found])

    train = persist(rows.filter(keep).select("doc_id", "lang", count(F.col("text")).alias("grams")).filter("grams IS NOT NULL"), "op8-train")

    def dense(series) -> np.ndarray:
        out = np.zeros((len(series), DIMENSIONS), dtype=np.float32)
        for k, g in enumerate(series):
            g = np.asarray(g)
            out[k, g[:len(g) // 2]] = g[len(g) // 2:]
        return out

    def frequency(batches):
        n, seen = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            n += len(batch)
            for g in batch["grams"]:
                seen[np.asarray(g)[:len(g) // 2]] += 1
        yield pd.DataFrame({"slot": np.arange(DIMENSIONS + 1), "n": np.append(seen, n)})

    stats = train.select("grams").mapInPandas(frequency, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(DIMENSIONS + 1)
    seen[stats["slot"].to_numpy()] = stats["n"].to_numpy()
    if not seen[-1]:
        return None
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1.0

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        vectors = vectors_of(dense(group.sort_values("doc_id", kind="stable")["grams"]), idf)
        centres = cluster(vectors, clusters)
        cosine = vectors @ centres.T
        own = cosine.argmax(axis=1)
        best = cosine.max(axis=1)
        least = [float(np.quantile(best[own == c], REJECTED_SHARE)) if (own == c).any() else 0.0 for c in range(len(centres))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "least": least, "vector": [c.tolist() for c in centres]})

    fitted = (train.groupBy("lang").applyInPandas(fit, "lang string, least double, vector array<float>")
                   .toPandas().sort_values(["lang", "least"], kind="stable"))
    return Centroids(fitted["lang"].tolist(), np.array(fitted["vector"].tolist(), dtype=np.float32), idf,
                     fitted["least"].to_numpy())


def predict(text: str | None, model: Centroids | None) -> tuple[str, float, bool]:
    """(language, cosine to its nearest centroid, rejected)."""
    counts = counts_of(text)
    if counts is None or model is None:
        return UNKNOWN, 0.0, False
    cosine = model.vectors @ model.vector(counts).astype(np.float32)
    best = int(np.argmax(cosine))
    score = float(min(1.0, max(0.0, cosine[best])))
    return model.languages[best], score, bool(cosine[best] < model.least[best])


def language_column(text: Column, model: Centroids | None) -> Column:
    """struct(lang_pred, score, rejected)."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = [predict(t, model) for t in texts]
            yield pd.DataFrame({"lang_pred": [o[0] for o in out], "score": [o[1] for o in out],
                                "rejected": pd.Series([o[2] for o in out], dtype="bool")})
    return run(text)


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of ``docs``."""
    prepare(docs.sparkSession)
    return (docs.select("doc_id", "text")
                .select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
                        language_column(F.col("text"), model).alias("p"))
                .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected"))
