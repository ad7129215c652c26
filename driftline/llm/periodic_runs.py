"""Periodic runs of words by an online sparse diagonal scheme.

A run is a stretch of words with smallest period q and at least max(12, 2 q) words that cannot be extended either way. On
diagonal q (pairs of words q apart) it is a series of at least max(q, 12 - q), so at least six, equal pairs. The scheme reads
the words once, from left to right. For each word its earlier occurrences with enough equal context open diagonals; each
live diagonal's match length grows by one while the words agree; a diagonal that ends is emitted at once if it is long enough.

Sparseness comes from the context. Level k is responsible for periods in [l, 2 l), l = 6 * 2**k (level 0 for 1 to 11), and a
diagonal of that level opens only where the last l words equal those at the earlier place: less cannot become a run. What
remains could still be many places in a text such as one word repeated. There the last l words have themselves a short
period r (at most l / 2), which the diagonal r, already live, tells. Two places inside one such stretch differ by a
multiple of r: that diagonal ends where the stretch ends and has no smallest period of its own. Two places in different
stretches begin to agree at the start of one of them. So in periodic context only the first place of a stretch opens
diagonals, as the later or as the earlier of the two places, and a repeated word costs a constant per place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import WordHash, batch_values, mixed, ship, text_rows, word_hashes

#: Fewest words of a run; half of it is the context that opens a diagonal of the lowest level.
MIN_WORDS = 12
BASE = MIN_WORDS // 2
#: Diagonals that are kept one by one; more are moved to arrays.
CROWD = 32
#: Bytes of text in a batch that is sent back.
BATCH_BYTES = 8_000_000
_U = np.uint64

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Level:
    """Contexts of ``span`` words: a key for each last word, and the nearest earlier place with the same context."""

    def __init__(self, span: int, keys: np.ndarray):
        self.span, self.keys = span, keys
        self.before = np.full(len(keys), -1, np.int64)
        order = np.argsort(keys[span - 1 :], kind="stable") + span - 1
        same = keys[order[1:]] == keys[order[:-1]]
        self.repeats = bool(same.any())
        self.before[order[1:][same]] = order[:-1][same]
        # Places whose context recurs within reach, before or after; any other opens no diagonal here.
        later, earlier = order[1:][same], order[:-1][same]
        within = later - earlier < 2 * span
        self.near = np.zeros(len(keys), bool)
        self.near[later[within]] = True
        self.near[earlier[within]] = True


def _levels(words: np.ndarray) -> list[_Level]:
    """Levels that have a repeated context at all; a level without one ends the list, longer contexts do not repeat then."""
    out: list[_Level] = []
    keys = words
    for step in (1, 1, 3):  # contexts of 2, 3 and 6 words
        longer = np.zeros(len(words), _U)
        longer[step:] = mixed(keys[:-step] * _U(0x9E3779B97F4A7C15) + (words if step == 1 else keys)[step:] + _U(step))
        keys = longer
    span = BASE
    while span < len(words):
        level = _Level(span, keys)
        if not level.repeats:
            break
        out.append(level)
        longer = np.zeros(len(words), _U)
        longer[span:] = mixed(keys[:-span] * _U(0x9E3779B97F4A7C15) + keys[span:] + _U(span))
        keys, span = longer, 2 * span
    return out


class _Diagonals:
    """Live diagonals by lag, each with the first place of its equal pairs; a crowd of them is kept in arrays."""

    def __init__(self, words: np.ndarray):
        self.array, self.words = words, words.tolist()
        self.few: dict[int, int] = {}
        self.lags = self.starts = np.empty(0, np.int64)
        self.crowd: set[int] = set()
        self.least = len(words)  # not above the smallest lag of the crowd

    def __bool__(self) -> bool:
        return bool(self.few) or len(self.lags) > 0

    def open(self, lags: list[int], start: int) -> None:
        self.few.update({lag: start for lag in lags if lag not in self.few and lag not in self.crowd})
        if len(self.few) > CROWD:
            self.lags = np.concatenate([self.lags, np.fromiter(self.few, np.int64, len(self.few))])
            self.starts = np.concatenate([self.starts, np.fromiter(self.few.values(), np.int64, len(self.few))])
            self.crowd.update(self.few)
            self.least = min(self.least, *self.few)
            self.few = {}

    def advance(self, i: int) -> list[tuple[int, int]]:
        """Take word i in; the (lag, start) of the diagonals that it ends."""
        word = self.words[i]
        ended = [(lag, start) for lag, start in self.few.items() if self.words[i - lag] != word]
        for lag, _ in ended:
            del self.few[lag]
        if len(self.lags):
            equal = self.array[i - self.lags] == self.array[i]
            if not equal.all():
                gone = self.lags[~equal].tolist()
                self.crowd.difference_update(gone)
                ended += zip(gone, self.starts[~equal].tolist())
                self.lags, self.starts = self.lags[equal], self.starts[equal]
                self.least = int(self.lags.min(initial=len(self.words)))
        return ended

    def short_period(self, i: int, span: int) -> tuple[int, int]:
        """Smallest period, at most half of ``span``, of the last ``span`` words, and its first pair; or zeros."""
        least = min(((lag, x) for lag, x in self.few.items() if 2 * lag <= span and i - x + 1 >= span - lag), default=(0, 0))
        if len(self.lags) and 2 * self.least <= span:
            fit = (2 * self.lags <= span) & (i - self.starts + 1 >= span - self.lags)
            if fit.any():
                k = int(np.argmin(np.where(fit, self.lags, span)))
                least = min(least if least[0] else (span, 0), (int(self.lags[k]), int(self.starts[k])))
        return least

    def rest(self) -> list[tuple[int, int]]:
        return [*self.few.items(), *zip(self.lags.tolist(), self.starts.tolist())]


def _long_enough(ended: list[tuple[int, int]], end: int) -> Iterator[tuple[int, int, int]]:
    """Runs that end before word ``end``; of diagonals over the same stretch the smallest lag names the run."""
    seen = set()
    for lag, start in sorted(ended):
        m = end - start
        if m >= lag and m + lag >= MIN_WORDS and start - lag not in seen:
            seen.add(start - lag)
            yield start - lag, m + lag, lag


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word keys (64 bits), by start, then period."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    levels = _levels(words)
    if not any(level.near.any() for level in levels):
        return []
    places = np.flatnonzero(np.logical_or.reduce([level.near for level in levels])).tolist()
    reach = [(level.span, level.near.tolist(), level.before.tolist(), level.keys.tolist(), defaultdict(list)) for level in levels]
    live, runs = _Diagonals(words), []
    at, i = 0, places[0]  # next of ``places``, and the word to take in
    while i < n:
        if live and (ended := live.advance(i)):
            runs += _long_enough(ended, i)
        if at < len(places) and places[at] == i:
            at += 1
            for span, near, before, keys, firsts in reach:
                if not near[i]:
                    continue
                # Level 0 has at most eleven lags a place and needs no rule for periodic context.
                short, start = live.short_period(i, span) if span > BASE else (0, 0)
                first = start - short + span - 1  # first place of this periodic stretch
                if short and i > first:
                    found = [j for j in firsts.get(keys[i], ()) if i - 2 * span < j < first]
                else:
                    found, j = [], before[i]
                    while j >= 0 and j > i - 2 * span:
                        found.append(j)
                        j = before[j]
                    if short:
                        firsts[keys[i]].append(i)
                if found:
                    live.open([i - j for j in found if i - j >= span or span == BASE], i - span + 1)
        if live:
            i += 1
        elif at < len(places):
            i = places[at]
        else:
            break
    runs += _long_enough(live.rest(), n)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by single spaces, without those of a run after its first period."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    drop = np.cumsum(cover)
    return b" ".join(w for w, d in zip(words, drop.tolist()) if not d)


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHash()
    for batch in batches:
        ids, counts, found, texts, held, start = batch.column(0), [], [], [], 0, 0
        values = batch.column(1)
        for row in range(batch.num_rows):
            words = (values[row].as_py() or b"").split()
            runs = find_runs(word_hashes(memo, words))
            counts.append(len(words))
            found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
            texts.append(collapsed(words, runs))
            held += len(texts[-1])
            if held > BATCH_BYTES or row == batch.num_rows - 1:
                yield pa.record_batch(
                    {
                        "doc_id": ids.slice(start, len(texts)),
                        "n_words": pa.array(counts, pa.int64()),
                        "runs": pa.array(found, pa.list_(_RUN)),
                        "collapsed": pa.array(texts, pa.binary()).cast(pa.string()),
                    }
                )
                counts, found, texts, held, start = [], [], [], 0, row + 1


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text, ...).

    ``runs`` are all periodic runs of the text's words (what the six ASCII white-space characters part), by start, then
    period. ``collapsed`` is the text without the words of a run after its first period, joined by single spaces. A null or
    empty text has no words, no runs and an empty collapsed text. Rows with a null id and repeated rows each return; other
    columns are ignored. Words are compared by 64-bit hashes. A text is read whole in one task, whose memory is some 40
    bytes a word and level; the number of levels is the logarithm of the longest repeated passage.
    """
    ship(docs.sparkSession)
    rows = text_rows(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(_detect, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, told by the crc32 of the id, have their tail replaced by repeats of a part.

    Rows with a null id keep their text. Of the n words of a chosen row, word i >= a becomes word a + (i - a) % p.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(trimmed, "[\\x20\\x09-\\x0D]+")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (3 + g % 8)).cast("long")

        def chosen(x: Column, i: Column) -> Column:
            return F.when(i < a, x).otherwise(F.get(w, (a + (i.cast("long") - a) % p).cast("int")))

        return F.array_join(F.transform(w, chosen), " ")

    # A lambda variable holds the words once; a column expression would be split again for every word.
    text = F.transform(F.array(words), repeated)[0]
    chosen = (h % 10 == 0) & (F.length(trimmed) > 0)
    return docs.select("doc_id", F.when(chosen, text).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs``: number of runs, the longest run, digests of all runs and of the collapsed text."""
    found = periodic_runs(docs)
    first = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("q"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-first.s).alias("start"),
        first.n.alias("length"),
        (-first.q).alias("period"),
        F.floor(1000 * first.n / -first.q).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
