"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm import pieces
from drayage.llm.common import add_from_texts, claim, ship, text_slices

DIMENSIONS = 1024
#: A document's direction enters its language's prototype in steps of this size, so sums do not depend on their order.
STEPS = 2**20
#: Distinct trigrams turned into vectors at a time.
BLOCK = 4096


def letter_vectors(letters: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A fixed random vector of -1 and 1 for each code point; 0 is the edge of a word."""
    x = letters.astype(np.uint64)[:, None] * np.uint64(0x1_0000_0001) + np.arange(1, dimensions // 64 + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def bound(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Trigram vectors: the first letter's vector permuted twice, the second's once, bound by products."""
    parts = [grams >> 42, (grams >> 21) & 0x1FFFFF, grams & 0x1FFFFF]
    letters, at = np.unique(np.concatenate(parts), return_inverse=True)
    base = letter_vectors(letters, dimensions)
    a, b, c = at.reshape(3, -1)
    return np.roll(base, 2, axis=1)[a] * np.roll(base, 1, axis=1)[b] * base[c]


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of trigram vectors over its words, and its number of letters. Case does not count."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    cps = pieces.code_points("\n".join(lowered) + "\n").astype(np.int64)
    letter = pieces.classes()[cps] == pieces.LETTER
    at = np.flatnonzero(letter)
    owner = np.searchsorted(np.cumsum(sizes), at, side="right")
    n = np.bincount(owner, minlength=len(texts))
    symbol = np.append(np.where(letter, cps, 0), 0)  # symbol[-1] is the edge before the first letter
    code, grams = pd.factorize(symbol[at - 1] << 42 | symbol[at] << 21 | symbol[at + 1])
    kind = np.float32 if len(at) < 2**24 else np.float64
    out = np.zeros((len(texts), dimensions), kind)
    for k in range(0, len(grams), BLOCK):
        block = grams[k : k + BLOCK]
        own = slice(None) if len(grams) <= BLOCK else (code >= k) & (code < k + BLOCK)
        counts = np.bincount(owner[own] * len(block) + (code[own] - k), minlength=len(texts) * len(block)).reshape(len(texts), len(block))
        out += counts.astype(kind) @ bound(block, dimensions).astype(kind)
    return out.astype(np.float64), n


def prototypes(rows: DataFrame, most: int = 1000, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """(languages in order, their prototypes) from rows(text, lang). Each partition sends one vector for each language.

    What reaches the driver is languages times dimensions; more than `most` languages raise.
    """

    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        sums: dict[str, np.ndarray] = {}
        for part, texts in text_slices(batches, "text", 500_000, 256):
            vectors, n = bundles(texts, dimensions)
            length = np.sqrt((vectors**2).sum(axis=1))
            steps = np.rint(vectors / np.where(length > 0, length, 1)[:, None] * STEPS).astype(np.int64)
            own = np.array(part.column("lang").to_pylist(), object)
            for lang in set(own[n > 0]):
                sums[lang] = sums.get(lang, 0) + steps[(own == lang) & (n > 0)].sum(axis=0)
            if len(sums) > most:
                raise ValueError(f"more than {most} languages")
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "vector"])

    parts = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(run, "lang string, vector array<long>")
    found = parts.select("lang", F.posexplode("vector").alias("k", "v")).groupBy("lang", "k").agg(F.sum("v").alias("v"))
    found = found.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("vector"))
    got = sorted((r["lang"], r["vector"]) for r in found.limit(most + 1).collect())
    if len(got) > most:
        raise ValueError(f"more than {most} languages")
    return [x for x, _ in got], np.array([v for _, v in got], np.float64).reshape(len(got), dimensions)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, languages: list[str], vectors: np.ndarray, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the language whose prototype has the greatest cosine with a document (ties: the first by name), and that cosine.

    Every letter of the whole text counts. A text that is null or has no letter is `und` with score 0, as is all where
    nothing was learned. Scores below 0 are 0.
    """
    length = np.sqrt((vectors**2).sum(axis=1))
    unit = vectors / np.where(length > 0, length, 1)[:, None]
    names = np.array([*languages, "und"], object)

    def run(texts: list[str]) -> list:
        v, n = bundles(texts, unit.shape[1])
        best, top = np.full(len(texts), -1), np.zeros(len(texts))
        if len(languages):
            cosine = (v @ unit.T) / np.maximum(np.sqrt((v**2).sum(axis=1)), 1e-300)[:, None]
            best, top = np.where(n > 0, cosine.argmax(axis=1), -1), np.where(n > 0, np.clip(cosine.max(axis=1), 0, 1), 0.0)
        return [pa.array(names[best].tolist(), pa.string()), pa.array(top, pa.float64())]

    return add_from_texts(docs, text_col, run, f"{pred} string, {score} double", docs.columns, chars=500_000, rows=256)


def identify_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document; learned from the text and language of those not held out.

    Documents without a language teach nothing. Null ids, repeated rows, empty tables and extra columns are fine.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    languages, vectors = prototypes(rows.where("NOT held_out").select("text", "lang"))
    return identify(rows.drop("lang"), languages, vectors).drop("text")


def keep_identified(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, columns unchanged, that have a language: those that are null or have no letter go.

    Where nothing was learned every text with a letter stays, as it does where a language is itself named `und`.
    """
    languages, vectors = prototypes(docs.where(~held_out()).select(F.col(text_col).alias("text"), "lang"))
    if not languages:
        languages, vectors = [""], np.ones((1, DIMENSIONS))
    out = identify(docs, [f"lang:{x}" for x in languages], vectors, text_col, "__lang_pred", "__lang_score")
    return out.where("__lang_pred != 'und'").drop("__lang_pred", "__lang_score")
