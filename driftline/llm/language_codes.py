"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over hashed letter n-grams tells the languages whose
codeword has the bit from the others; a text's bits are then decoded to the codeword of least loss. A wrong bit here and
there does not change the nearest codeword, and a text that lies between two is flagged.

The classifiers are linear: a gram's weight on a bit is the logarithm of its mean share in the languages with the bit over
that in the others. The counts come from all training texts. A second pass over about FIT_TEXTS of them tells where
each bit's two sides lie and how far they scatter, which gives the threshold, the scale and the weight of the bit's loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import batch_values, ship

#: Buckets of hashed grams, and the letters of a gram.
BUCKETS = 1 << 16
ORDERS = (2, 3)
#: Most languages that are learnt, by number of training texts; with BUCKETS it bounds the model.
MAX_LANGUAGES = 256
#: About how many training texts the thresholds are fitted on; the gram counts come from all.
FIT_TEXTS = 20_000
#: Up to this many languages every two-way split of them is a bit; beyond, bits are drawn, so many per doubling.
ALL_SPLITS = 5
BITS_PER_DOUBLING = 10
#: A text is ambiguous if the share of its language is below this.
SURE = 0.75
#: Scaled margin of the nearest language of a bit's side; a text half of one and half of the other language is at 0.
SURE_MARGIN = 4.0
#: Letters of a text that are turned to grams at once.
CHUNK = 1 << 20
UNDETERMINED = "und"
_GRAM = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters_of(text: str | None) -> np.ndarray:
    """Lower-cased code points of a text, all else than letters as single spaces, with a space at both ends; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.uint32)
    codes = np.concatenate([[np.uint32(32)], np.where(is_letter, codes, np.uint32(32)), [np.uint32(32)]])
    blank = codes == 32
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all grams, a chunk of the letters at a time."""
    for start in range(0, len(codes), CHUNK):
        for order in ORDERS:
            part = codes[start : start + CHUNK + order - 1]
            if len(part) < order:
                continue
            h = np.full(len(part) - order + 1, np.uint32(order))
            for k in range(order):
                h = (h ^ part[k : k + len(h)]) * _GRAM[k]
                h ^= h >> np.uint32(15)
            yield h & np.uint32(BUCKETS - 1)


def codewords(n: int) -> np.ndarray:
    """A row of bits (1 or -1) per language; rows differ in many bits."""
    if n <= ALL_SPLITS:
        # Language 0 always has the bit; the others' subsets, but the full one, are all splits.
        subsets = np.arange(max(0, 2 ** (n - 1) - 1))
        return np.array([[1 if k == 0 or s >> (k - 1) & 1 else -1 for s in subsets] for k in range(n)], np.int8).reshape(n, len(subsets))
    bits = int(np.ceil(BITS_PER_DOUBLING * np.log2(n)))
    best, apart = None, -1
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).permuted(np.tile(np.arange(n) % 2, (bits, 1)), axis=1).T > 0, 1, -1)
        product = code @ code.T
        least = (bits - product[~np.eye(n, dtype=bool)].max()) // 2
        if least > apart:
            best, apart = code.astype(np.int8), least
    return best


class BitModel:
    """Codewords, gram weights and, per bit, threshold, scale and loss weight."""

    def __init__(self, languages: list[str], shares: np.ndarray):
        """``shares``: row of gram shares per language."""
        self.languages = languages
        self.code = codewords(len(languages))
        bits = self.code.shape[1]
        self.weights = np.zeros((BUCKETS, bits), np.float32)
        for b in range(bits):
            side = self.code[:, b] > 0
            self.weights[:, b] = np.log(shares[side].mean(axis=0)) - np.log(shares[~side].mean(axis=0))
        self.middle, self.scale, self.trust = np.zeros(bits), np.ones(bits), np.ones(bits)

    def margins(self, text: str | None) -> np.ndarray | None:
        """Mean gram weight on each bit; None without letters."""
        codes = letters_of(text)
        if not len(codes):
            return None
        total, n = np.zeros(self.code.shape[1]), 0
        for part in grams(codes):
            total += self.weights[part].sum(axis=0, dtype=np.float64)
            n += len(part)
        return total / n

    def fit(self, n: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """From texts, sums and sums of squares of margins per language: languages count alike, whatever their texts."""
        known = n > 0
        mean = np.divide(first, n[:, None], out=np.zeros_like(first), where=known[:, None])
        spread = np.divide(second, n[:, None], out=np.zeros_like(second), where=known[:, None]) - mean**2
        for b in range(self.code.shape[1]):
            up, down = known & (self.code[:, b] > 0), known & (self.code[:, b] < 0)
            if not up.any() or not down.any():
                continue
            # The sides are as far apart as their nearest languages, not as their means.
            high, low = mean[up, b].min(), mean[down, b].max()
            variance = max(float(spread[known, b].mean()), 1e-6)
            gap = max(high - low, 1e-3)
            self.middle[b], self.scale[b] = (high + low) / 2, 2 * SURE_MARGIN / gap
            self.trust[b] = min(gap / np.sqrt(variance), 10.0)
        if len(self.trust):
            self.trust *= len(self.trust) / self.trust.sum()

    def decode(self, margins: np.ndarray) -> tuple[int, float]:
        """Language of least loss and its share among all: a softmax of the losses."""
        z = np.clip((margins - self.middle) * self.scale, -2 * SURE_MARGIN, 2 * SURE_MARGIN)
        loss = np.log1p(np.exp(-self.code * z)) @ self.trust
        share = np.exp(loss.min() - loss)
        best = int(np.argmin(loss))
        return best, float(share[best] / share.sum())


def _gram_counts(languages: list[str]):
    place = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for text, lang in zip(batch_values(batch, "text"), batch_values(batch, "lang"), strict=True):
                if (k := place.get(lang)) is not None:
                    for part in grams(letters_of(text)):
                        total[k] += np.bincount(part, minlength=BUCKETS)
        k, bucket = np.nonzero(total)
        yield pa.record_batch({"k": pa.array(k), "bucket": pa.array(bucket), "n": pa.array(total[k, bucket])})

    return run


def _margin_sums(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        place = {lang: k for k, lang in enumerate(own.languages)}
        n, bits = len(own.languages), own.code.shape[1]
        sums = np.zeros((n, 1 + 2 * bits))
        for batch in batches:
            for text, lang in zip(batch_values(batch, "text"), batch_values(batch, "lang"), strict=True):
                m = own.margins(text) if lang in place else None
                if m is not None:
                    sums[place[lang]] += np.concatenate([[1.0], m, m * m])
        k, at = np.nonzero(sums)
        yield pa.record_batch({"k": pa.array(k), "at": pa.array(at), "s": pa.array(sums[k, at])})

    return run


def train(rows: DataFrame, fit_texts: int = FIT_TEXTS) -> BitModel | None:
    """The model of ``rows`` (text, lang, both not null); None if there is no language.

    The driver gets one row per language, per language and bucket, and per language and bit, whatever the number of texts.
    """
    spark = rows.sparkSession
    ship(spark)
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    languages = sorted(r.lang for r in counts)
    sums = rows.mapInArrow(_gram_counts(languages), "k long, bucket long, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(languages), BUCKETS))
    table[sums["k"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    model = BitModel(languages, (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    shared = spark.sparkContext.broadcast(model)
    one_in = max(1, sum(r["count"] for r in counts) // fit_texts)
    some = rows.where(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0)
    found = some.mapInArrow(_margin_sums(shared), "k long, at long, s double").groupBy("k", "at").agg(F.sum("s").alias("s")).toArrow()
    bits = model.code.shape[1]
    margins = np.zeros((len(languages), 1 + 2 * bits))
    margins[found["k"].to_numpy(), found["at"].to_numpy()] = found["s"].to_numpy()
    model.fit(margins[:, 0], margins[:, 1 : 1 + bits], margins[:, 1 + bits :])
    return model


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            languages, scores, flags = [], [], []
            for text in batch_values(batch, "text"):
                margins = own.margins(text) if own else None
                best, share = own.decode(margins) if margins is not None else (None, 0.0)
                languages.append(UNDETERMINED if best is None else own.languages[best])
                scores.append(share)
                flags.append(share < SURE)
            columns = [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous"])

    return run


def predict(docs: DataFrame, model: BitModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``docs`` (doc_id, text, ...) by its whole text.

    ``score`` is the language's share among all. A null text, one without a letter, and any text if nothing was learnt is
    ``und`` with score 0, and ambiguous. With one language learnt every other text is of that language. Of equal losses the
    first language by name wins. Repeated rows each return, null ids stay, other columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_predicted(shared), "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row of ``docs`` (doc_id, text, lang, ...).

    Learns from the text and lang of rows that are not held out and have both; ``predict`` says the rest.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = train(known.select("text", "lang"))
    out = predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
