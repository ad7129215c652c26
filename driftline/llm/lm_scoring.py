"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale; a count of level q is stored by inserting the pair
of key and level for every level up to q. A lookup probes level by level until one is missing, so an error can only raise
a count, and each further level is ever less likely to be wrong.

Every pair that the training texts hold twice or more is stored, whatever the size of the corpus, so the filter grows with
it. It is cut by key into slices of fixed size, each built in a task of its own, and broadcast in parts of at most
``part_bytes``; documents are read once a part, and what a part says of its pairs adds up. Of the words only those are
broadcast that occur in a share of 1 / ``max_entries`` of the N tokens or more, of which there are at most ``max_entries``.

All other words meet their counts in a join, where by definition no key is hot in the training texts: exactly for the plain
add-one score, and for the pairs they are in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import WordHash, batch_values, mixed, ship, text_rows, word_hashes, written

#: The end of a text counts as a token; no word contains a blank, so this one is no word's.
END = b" "
#: Most words that are broadcast with their counts (8 + 8 bytes each); a word is among them by its share of all tokens.
MAX_ENTRIES = 1_000_000
#: Ratio of neighbouring count levels, probes of one level, and bits per stored level.
LEVEL_RATIO = 2.0**0.5
PROBES = 4
BITS_PER_LEVEL = 12
#: Fewest occurrences of a stored pair, at every size of the corpus: one that occurs once is no evidence.
MIN_PAIR = 2
#: Bits of a slice of the pair filter (a power of two), and most bytes of slices that are broadcast at once.
SLICE_BITS = 1 << 25
PART_BYTES = 128 << 20
#: Share of the word model beside the pair model, for words that follow another.
DISCOUNT = 0.85
_U = np.uint64


def quantised(count: np.ndarray) -> np.ndarray:
    """Level of a count of at least 1: 1 + floor(log of the count to LEVEL_RATIO)."""
    return 1 + np.floor(np.log(count) / np.log(LEVEL_RATIO) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """Typical count of a level (the geometric middle); 0 for level 0."""
    return np.where(level > 0, LEVEL_RATIO ** (level - 0.5), 0.0)


class LogFrequencyBloom:
    """Bloom filter of (key, level) pairs; keys are 64-bit hashes. Its size follows from the counts unless ``bits`` is given."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, base_level: int = 1, bits: int | None = None):
        self.base = base_level
        levels = np.maximum(quantised(np.maximum(counts, 1)) - base_level + 1, 1)
        self.bits = bits or 1 << max(10, int(levels.sum() * BITS_PER_LEVEL - 1).bit_length())
        self.cells = np.zeros(self.bits >> 3, np.uint8)
        self.top = int(levels.max()) if len(levels) else 0
        for level in range(1, self.top + 1):
            self._set(keys[levels >= level], level)

    def _start(self, keys: np.ndarray):
        return _U(0)

    def _places(self, keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
        h = mixed(keys + _U(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        step = (h >> _U(32)) | _U(1)
        start = self._start(keys)
        for k in range(PROBES):
            yield start + ((h + step * _U(k)) & _U(self.bits - 1))

    def _set(self, keys: np.ndarray, level: int) -> None:
        for at in self._places(keys, level):
            np.bitwise_or.at(self.cells, (at >> _U(3)).astype(np.int64), (1 << (at & _U(7))).astype(np.uint8))

    def _has(self, keys: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._places(keys, level):
            out &= ((self.cells[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1).astype(bool)
        return out

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Quantised level of each key; 0 where the key is not stored."""
        out = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for level in range(1, self.top + 1):
            alive = alive[self._has(keys[alive], level)]
            if not len(alive):
                break
            out[alive] = level + self.base - 1
        return out


class FilterPart(LogFrequencyBloom):
    """Neighbouring slices of a filter of ``n_slices`` equal slices, from number ``first`` on; a key is in one slice."""

    def __init__(self, first: int, n_slices: int, slices: list[bytes], top: int, base_level: int):
        self.first, self.n_slices, self.held = first, n_slices, len(slices)
        self.base, self.top = base_level, top
        self.bits = len(slices[0]) * 8 if slices else 8
        self.cells = np.frombuffer(b"".join(slices), np.uint8)

    def _slice(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(32)) % _U(self.n_slices)

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return (self._slice(keys) - _U(self.first)) * _U(self.bits)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key belongs to one of these slices."""
        own = self._slice(keys)
        return (own >= _U(self.first)) & (own < _U(self.first + self.held))


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []
    words.append(END)
    return words


def pair_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(mixed(history + _U(0x632BE59BD9B4E019)) + word)


def _word_counts(flush: int = 300_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch_values(batch, "text"):
                held.update(tokens(text))
                if len(held) >= flush:
                    yield _counts(held)
                    held = Counter()
        if held:
            yield _counts(held)

    return run


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(list(held), pa.binary()), "c": pa.array(list(held.values()), pa.int64())})


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring tokens, counted within a bounded number of tokens at a time."""
    memo = WordHash()
    held, size = [], 0
    for batch in batches:
        for text in batch_values(batch, "text"):
            h = word_hashes(memo, tokens(text))
            held.append(pair_keys(h[:-1], h[1:]))
            size += len(h)
            if size >= 4_000_000:
                yield _pairs(held)
                held, size = [], 0
    if size:
        yield _pairs(held)


def _pairs(held: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate(held), return_counts=True)
    return pa.record_batch({"pair": keys.astype(np.int64), "c": counts.astype(np.int64)})


def _slices(base_level: int, bits: int):
    """The cells of one slice of the pair filter."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy().astype(_U)
        bloom = LogFrequencyBloom(keys, table.column("c").to_numpy().astype(np.float64), base_level, bits)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "cells": pa.array([bloom.cells.tobytes()], pa.binary())})

    return run


def _filter_parts(pairs: DataFrame, slice_bits: int, part_bytes: int) -> Iterator[FilterPart]:
    """The filter of the pairs (pair, c), a bounded part at a time; at least one part, which may be empty."""
    base_level = int(quantised(np.array([MIN_PAIR]))[0])
    levels = F.floor(F.log("c") / float(np.log(LEVEL_RATIO)) + 1e-9) + 2 - base_level
    total, most = pairs.agg(F.coalesce(F.sum(levels), F.lit(0)), F.coalesce(F.max("c"), F.lit(MIN_PAIR))).first()
    top = int(quantised(np.array([most]))[0]) - base_level + 1
    n_slices = max(1, -(-int(total) * BITS_PER_LEVEL // slice_bits))
    sliced = pairs.withColumn("slice", F.shiftrightunsigned("pair", 32) % n_slices)
    built = written(sliced.groupBy("slice").applyInArrow(_slices(base_level, slice_bits), "slice long, cells binary"), "slices")
    step = max(1, part_bytes * 8 // slice_bits)
    empty = bytes(slice_bits >> 3)
    for first in range(0, n_slices, step):
        numbers = range(first, min(first + step, n_slices))
        cells = {r["slice"]: bytes(r["cells"]) for r in built.where(F.col("slice").between(numbers[0], numbers[-1])).toLocalIterator()}
        yield FilterPart(first, n_slices, [cells.get(k, empty) for k in numbers], top, base_level)


#: Tokens that are scored at once.
BLOCK_TOKENS = 400_000


def _lists(values: pa.Array, doc_of: np.ndarray, n: int) -> pa.ListArray:
    """The values of ascending documents 0 to n - 1 as a list per document."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc_of, np.arange(n + 1)), pa.int32()), values)


def _score(frequent, word_filter, part, total: int, distinct: int, first_part: bool):
    """Scores of many documents at once under one part of the pair filter, the words' own share with the first part.

    What needs the count of a word that is not broadcast leaves for the join: ``rare`` words, ``times``; known pairs of such
    a word as (open_word, open_x, open_hist), or (half_u, half_x, half_hist) where only the history is such a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = frequent.value
        pairs = part.value
        memo = WordHash()
        # The last place, which -1 means, stands for every word that is not stored.
        base = np.append(np.log10((counts + 1) / (total + distinct + 1)), 0.0)
        # The model's own word counts come out of the filter; a stored word always has at least its lowest level.
        quant = np.append(level_count(word_filter.value.level(hashes)), 1.0)
        smooth = (quant + 1) / (total + distinct + 1)
        smooth[-1] = 1.0

        def places(h: np.ndarray) -> np.ndarray:
            own, back = np.unique(h, return_inverse=True)
            if not len(hashes):
                return np.full(len(h), -1)
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            return np.where(hashes[at] == own, at, -1)[back]

        def block(texts: list[list[bytes]]) -> dict:
            n = len(texts)
            lengths = np.array([len(w) for w in texts])
            ends = np.cumsum(lengths)
            starts = ends - lengths
            words = [w for own in texts for w in own]
            h = word_hashes(memo, words)
            at = places(h)
            seen = at >= 0
            model = np.zeros(n)
            rare_words, rare_times = [[] for _ in texts], [[] for _ in texts]
            if first_part:
                model = np.add.reduceat(np.log10(smooth[at]), starts) + (lengths - 1) * np.log10(DISCOUNT)
                missed = np.flatnonzero(~seen)
                doc_of = np.searchsorted(ends, missed, "right")
                cuts = np.flatnonzero(np.diff(doc_of, prepend=-1))
                for lo, hi in zip(cuts, [*cuts[1:], len(missed)][: len(cuts)], strict=True):
                    own = Counter(words[k] for k in missed[lo:hi].tolist())
                    rare_words[doc_of[lo]], rare_times[doc_of[lo]] = list(own), list(own.values())
            # A stored pair counts by its share of the history's count, on top of the discounted word model.
            follows = np.ones(len(at), bool)
            follows[starts] = False
            follows = np.flatnonzero(follows)
            keys = pair_keys(h[follows - 1], h[follows])
            mine = pairs.holds(keys)
            own, back = np.unique(keys[mine], return_inverse=True)
            level = pairs.level(own)[back]
            place = follows[mine][level > 0]
            x = level_count(level[level > 0])
            doc_of = np.searchsorted(ends, place, "right")
            known, history = seen[place], seen[place - 1]
            x = np.where(history, np.minimum(x / quant[at[place - 1]], 1.0), x)
            both = known & history
            gain = np.log10(1 + (1 / DISCOUNT - 1) * x[both] / smooth[at[place[both]]])
            model = model + np.bincount(doc_of[both], gain, n)
            open_, half = np.flatnonzero(~known), np.flatnonzero(known & ~history)
            text_of = lambda k: None if seen[k] else words[k]
            open_words = pa.array([words[k] for k in place[open_].tolist()], pa.binary())
            open_hist = pa.array([text_of(k) for k in (place[open_] - 1).tolist()], pa.binary())
            half_hist = pa.array([words[k] for k in (place[half] - 1).tolist()], pa.binary())
            return {
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_near": pa.array(np.add.reduceat(seen.astype(np.int64), starts), pa.int64()),
                "base_part": pa.array(np.add.reduceat(base[at], starts), pa.float64()),
                "model_part": pa.array(model, pa.float64()),
                "rare": pa.array(rare_words, pa.list_(pa.binary())),
                "times": pa.array(rare_times, pa.list_(pa.int64())),
                "open_word": _lists(open_words, doc_of[open_], n),
                "open_x": _lists(pa.array(x[open_]), doc_of[open_], n),
                "open_hist": _lists(open_hist, doc_of[open_], n),
                "half_u": _lists(pa.array(smooth[at[place[half]]]), doc_of[half], n),
                "half_x": _lists(pa.array(x[half]), doc_of[half], n),
                "half_hist": _lists(half_hist, doc_of[half], n),
            }

        for batch in batches:
            first, held, size, all_texts = 0, [], 0, batch_values(batch, "text")
            for k, text in enumerate(all_texts):
                held.append(tokens(text))
                size += len(held[-1])
                if size >= BLOCK_TOKENS or k == len(all_texts) - 1:
                    columns = {c: batch.column(c).slice(first, len(held)) for c in ("row", "doc_id")}
                    yield pa.record_batch(columns | block(held))
                    first, held, size = k + 1, [], 0

    return run


def _zipped(scored: DataFrame, **columns: str) -> DataFrame:
    """A row per element of parallel lists: ``row`` and the lists under their new names."""
    lists = [F.col(old).alias(new) for new, old in columns.items()]
    return scored.select("row", F.inline(F.arrays_zip(*lists))).toDF("row", *columns)


def lm_scores(docs: DataFrame, training: DataFrame, max_entries: int = MAX_ENTRIES, slice_bits: int = SLICE_BITS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text, ...).

    ``training`` (text, ...) is what the counts come from. ``base_score`` is the exact add-one word score; ``score`` is the
    log10 probability under the pair model: every word after the first has DISCOUNT times its word probability, plus the rest
    times its pair's share of the history's count if the pair is stored. Counts of pairs, and of broadcast words, are the
    filter's; all others are exact. A null or empty text has one token, its end. With no training rows every word is
    unknown. Repeated rows each return, null ids stay, other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    learn = text_rows(training)
    counts = learn.mapInArrow(_word_counts(), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = written(counts, "words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = max(1, -(-total // max_entries))  # at most max_entries words occur that often

    top = counts.where(F.col("c") >= least).toArrow()
    found = np.array([xxhash.xxh3_64_intdigest(w) for w in top.column("word").to_pylist()], _U)
    order = np.argsort(found)
    hashes, times = found[order], top.column("c").to_numpy()[order].astype(np.float64)
    frequent = spark.sparkContext.broadcast((hashes, times))
    word_filter = spark.sparkContext.broadcast(LogFrequencyBloom(hashes, times, int(quantised(np.array([least]))[0])))

    pairs = learn.mapInArrow(_pair_counts, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))
    pairs = written(pairs.where(F.col("c") >= MIN_PAIR), "pairs")

    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"row long, doc_id {id_type}, n_tokens long, n_near long, base_part double, model_part double, rare array<binary>, times array<long>"
    schema += ", open_word array<binary>, open_x array<double>, open_hist array<binary>, half_u array<double>, half_x array<double>, half_hist array<binary>"
    rows = text_rows(docs, F.monotonically_increasing_id().alias("row"), "doc_id")
    scored = None
    for k, part in enumerate(_filter_parts(pairs, slice_bits, part_bytes)):
        if k == 0 and part.held < part.n_slices:
            rows = written(rows, "texts")  # read once a part, with the same row numbers
        shared = spark.sparkContext.broadcast(part)
        more = written(rows.mapInArrow(_score(frequent, word_filter, shared, total, distinct, k == 0), schema), "scores")
        shared.unpersist()
        first, scored = (more, more) if k == 0 else (first, scored.union(more))

    # Words that are not broadcast meet their counts, then histories do.
    known = counts.where(F.col("c") < least)
    zero, none = F.lit(0), F.lit(None).cast("binary")
    rare = _zipped(first, word="rare", k="times").select("row", "word", "k", F.lit(0.0).alias("x"), none.alias("hist"))
    opened = _zipped(scored, word="open_word", x="open_x", hist="open_hist").select("row", "word", F.lit(0).cast("long").alias("k"), "x", "hist")
    met = rare.union(opened).join(known, "word", "left")
    u = (F.coalesce("c", zero) + 1) / F.lit(float(total + distinct + 1))
    met = met.select("row", "k", "x", "hist", u.alias("u"), (F.col("c") > 0).alias("found"))
    half = _zipped(scored, u="half_u", x="half_x", hist="half_hist").select("row", F.lit(0).cast("long").alias("k"), "x", "hist", "u", F.lit(False).alias("found"))
    joined = met.where("hist is not null").union(half).join(known.toDF("hist", "h"), "hist", "left")
    columns = ["row", "k", "u", "found"]
    met = met.where("hist is null").select(*columns, "x").union(joined.select(*columns, F.least(F.col("x") / F.coalesce("h", F.lit(1)), F.lit(1.0)).alias("x")))
    gain = F.log10(F.lit(1.0) + F.lit(1 / DISCOUNT - 1) * F.col("x") / F.col("u"))
    rare = met.groupBy("row").agg(
        F.sum(F.col("k") * F.log10("u")).alias("logs"), F.sum(F.when(F.col("found"), F.col("k"))).alias("k_known"), F.sum(gain).alias("gain")
    )
    out = first.select("row", "doc_id", "n_tokens", "n_near", "base_part", "model_part")
    if first is not scored:
        out = out.drop("model_part").join(scored.groupBy("row").agg(F.sum("model_part").alias("model_part")), "row")
    return out.join(rare, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("n_near") + F.coalesce("k_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("logs", zero)).alias("base_score"),
        (F.col("model_part") + F.coalesce("logs", zero) + F.coalesce("gain", zero)).alias("score"),
    )
