"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from its code point, so all workers agree). A letter n-gram is bound
into one vector by permuting (rotating) each letter's vector by its place and multiplying them; a text is the bundle (sum)
of its n-grams' vectors, and so is a language over its training texts. A text gets the language whose prototype has the
largest cosine with its vector. Prototypes are sums of integers, so they do not depend on how the rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.text import chunks

DIMENSIONS, GRAM, SEED = 1024, 3, 20240101  # the counting below is written for n-grams of 3
UNKNOWN = "und"
#: The prototypes go through the driver: languages times DIMENSIONS numbers. More languages than this are an error.
MOST_LANGUAGES = 4096
#: Cells of the dense (texts x n-grams) count matrix handled at once.
CELLS = 1 << 22
#: Grams whose vectors a task holds at once.
SLICE = 1 << 14


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """(n, DIMENSIONS) float32 of n-grams given as (n, GRAM) code points; 0 is the gap between words."""
    out = np.ones((len(grams), DIMENSIONS), np.float32)
    for place in range(GRAM):
        codes, at = np.unique(grams[:, place], return_inverse=True)
        table = np.stack([np.roll(letter_vector(int(c)), GRAM - 1 - place) for c in codes]) if len(codes) else np.empty((0, DIMENSIONS), np.int8)
        out *= table[at]
    return out


def gram_counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, grams (n, GRAM), counts (texts, n)) over runs of the texts. Lower case; every run of other characters
    than letters is one gap, and so are a text's two ends; a text without letters has no n-gram."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    row = np.r_[0, np.repeat(np.arange(len(texts)), lengths)]  # a text's gap goes before the next
    keep = letter | np.r_[True, letter[:-1]]
    codes, row = np.where(letter, codes, 0)[keep], row[keep]
    alphabet, small = np.unique(codes, return_inverse=True)
    n, base = len(codes) - GRAM + 1, len(alphabet)
    if n <= 0:
        yield 0, np.empty((0, GRAM), np.int64), np.zeros((len(texts), 0), np.float32)
        return
    key = np.zeros(n, np.int64)
    for place in range(GRAM):
        key = key * base + small[place:place + n]
    # neighbouring letters are of one text; around a gap the two letters must be
    middle = small[1:n + 1] > 0
    owner = np.where(middle, row[1:n + 1], row[:n])
    fits = middle | (row[:n] == row[2:n + 2])
    key, owner = key[fits], owner[fits]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    start = 0
    while start < len(texts):
        stop = min(len(texts), start + CELLS // 8192)
        part = key[ends[start]:ends[stop]]
        if base ** GRAM <= CELLS * 4:
            seen = np.zeros(base ** GRAM, bool)
            seen[part] = True
            grams = np.flatnonzero(seen)
            place = np.zeros(base ** GRAM, np.int32)
            place[grams] = np.arange(len(grams))
            at = place[part]
        else:
            grams, at = np.unique(part, return_inverse=True)
        split = np.stack([alphabet[grams // base ** (GRAM - 1 - p) % base] for p in range(GRAM)], 1).astype(np.int64)
        step = max(1, CELLS // max(1, len(grams)))
        for a in range(start, stop, step):
            b = min(stop, a + step)
            i, j = ends[a] - ends[start], ends[b] - ends[start]
            flat = (owner[ends[a]:ends[b]] - a) * len(grams) + at[i:j]
            counts = np.bincount(flat, minlength=(b - a) * len(grams)).reshape(b - a, len(grams))
            yield a, split, counts
        start = stop


def bundles(counts: np.ndarray, grams: np.ndarray, kind) -> np.ndarray:
    """Counts times the grams' vectors, which exist for SLICE grams at a time only."""
    out = np.zeros((len(counts), DIMENSIONS), kind)
    for a in range(0, len(grams), SLICE):
        out += counts[:, a:a + SLICE].astype(kind) @ gram_vectors(grams[a:a + SLICE]).astype(kind)
    return out


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, prototypes as unit vectors): bundles of all rows with a text and a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch, "t"):
                langs, texts = part.column(1).to_pylist(), part.column(0).to_pylist()
                names = sorted(set(langs))
                which = np.array([names.index(x) for x in langs])
                for start, grams, counts in gram_counts(texts):
                    if not counts.shape[1]:
                        continue
                    own = which[start:start + len(counts)]
                    some = np.unique(own)
                    # every partial sum is an integer below 2^53, so doubles are exact
                    more = bundles(np.stack([counts[own == k].sum(0) for k in some]), grams, np.float64).astype(np.int64)
                    for k, v in zip(some.tolist(), more):
                        total[names[k]] = total.get(names[k], 0) + v
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    parts = rows.mapInArrow(run, "lang string, v array<bigint>")
    sums = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    whole = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    found = whole.select("lang", F.transform("v", lambda e: e["x"]).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = sorted((r["lang"], r["v"]) for r in found if any(r["v"]))
    vectors = np.array([v for _, v in found], np.float64).reshape(len(found), DIMENSIONS)
    return [name for name, _ in found], vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row: the language of the largest cosine (the first by name among equals) and that
    cosine, from 0 to 1. Text that is null or has no letter, and any text when no language was learned: ``und``, 0.
    Repeated rows and null ids stay; other columns are not read; an empty table gives an empty one."""
    names, prototypes = model[0], model[1].astype(np.float32).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                texts = [t or "" for t in part.column(1).to_pylist()]
                best, score = np.full(len(texts), -1), np.zeros(len(texts))
                for start, grams, counts in gram_counts(texts) if names else ():
                    vectors = bundles(counts, grams, np.float32)
                    norms = np.linalg.norm(vectors, axis=1)
                    cosines = vectors @ prototypes / np.maximum(norms, 1e-30)[:, None]
                    rows = slice(start, start + len(counts))
                    some = counts.sum(1) > 0
                    best[rows] = np.where(some, cosines.argmax(1), -1)
                    score[rows] = np.where(some, np.clip(cosines.max(1), 0, 1), 0)
                said = [names[k] if k >= 0 else UNKNOWN for k in best.tolist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(said, pa.string()), pa.array(score)],
                                                 names=[id_col, "lang_pred", "score"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id's text is divisible by ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0
