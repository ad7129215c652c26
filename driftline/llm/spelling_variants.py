"""Spelling variants by a trie over letter-group counts.

One edit changes the counts of a word's letters by little: an insertion adds one to the count of one group of letters (a
surplus of one), a deletion takes one away (a deficit of one), a replacement does both or neither. Words are arranged in a
trie by the counts of successive groups. A depth-first search for a word may leave its own path, but has one surplus and
one deficit to spend; the words at the leaves it reaches are compared letter by letter.

The trie is too large for one task, so its upper levels are dealt out. They count a few coarse groups, and each combination
of counts is a part of its own with the trie over fine groups below it. A word is stored in the part of its own counts and
asks in every part that one surplus and one deficit can reach; of two parts the lower one asks the higher, so every pair
is met once. The more words there are, the more coarse groups are counted, and a part over PART_WORDS words is dealt over
several blocks, so what a task holds is bounded.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import batch_values, mixed, ship, written

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is so many times as frequent as the word it stands for.
FORM_RATIO = 10
#: Entries of a task's count memo before it is sent on.
MEMO_WORDS = 100_000
#: Words stored in one block of a part, and words below a trie node that are compared directly.
PART_WORDS = 20_000
LEAF_WORDS = 8
#: Letters of a word, from either end, that are compared in bulk; pairs with a longer word are compared one by one.
COMPARED = 24
#: Pairs of counts that are compared at once at a leaf.
LEAF_PAIRS = 200_000
#: Fixed value: letters by falling frequency in English, German, French and Spanish texts; others follow by code point.
LETTERS = "enaristuodlchmgpbvfkqzwyxj"
FINE_GROUPS = 16
_RUN = re.compile(rb"[a-z\xc0-\xff]+")


def letter_groups(n: int) -> list[int]:
    """Group of each of the 256 code points: letters are dealt over ``n`` groups back and forth in order of frequency."""
    order = [ord(c) for c in LETTERS] + [c for c in range(256) if chr(c) not in LETTERS]
    out = [0] * 256
    for rank, code in enumerate(order):
        turn, place = divmod(rank, n)
        out[code] = place if turn % 2 == 0 else n - 1 - place
    return out


def letter_counts(words: list[bytes], n: int) -> np.ndarray:
    """One row per word (a byte a letter): how many of its letters fall into each of ``n`` groups."""
    groups = np.array(letter_groups(n), np.int64)[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(rows * n + groups, minlength=len(words) * n).reshape(len(words), n)


def asked_steps(n: int) -> list[tuple[int, int]]:
    """(group of the surplus, group of the deficit) that lead from a part to itself and to all higher ones in reach.

    -1 spends nothing. A part is higher if the first count that differs is; the lower parts ask by themselves.
    """
    return [(-1, -1)] + [(up, -1) for up in range(n)] + [(up, down) for up in range(n) for down in range(up + 1, n)]


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


class _Letters:
    """Words as rows of letters, from the front and from the back, for comparing many pairs at once."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.array([len(w) for w in words], np.int64)
        self.front, self.back = (self._rows(words, turn) for turn in (1, -1))

    @staticmethod
    def _rows(words: list[bytes], turn: int) -> np.ndarray:
        flat = b"".join(w[::turn][:COMPARED].ljust(COMPARED, b"\0") for w in words)
        return np.frombuffer(flat, np.uint8).reshape(len(words), COMPARED)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading columns in which two rows agree."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _one_edit_pairs(a: _Letters, i: np.ndarray, b: _Letters, j: np.ndarray) -> np.ndarray:
    """``one_edit`` of the words i of a and j of b: what both begin and end with leaves one letter out."""
    longest = np.maximum(a.length[i], b.length[j])
    same = _common(a.front[i], b.front[j]) + _common(a.back[i], b.back[j])
    differ = (a.length[i] != b.length[j]) | (a.front[i] != b.front[j]).any(axis=1)
    out = (np.abs(a.length[i] - b.length[j]) <= 1) & differ & (same >= longest - 1)
    for k in np.flatnonzero(longest > COMPARED).tolist():
        out[k] = one_edit(a.words[i[k]], b.words[j[k]])
    return out


def one_edit_apart(stored: list[bytes], asking: list[bytes], same_part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stored, asking) places of words one edit apart, by depth-first search of the trie of the stored words.

    All asking words go down together: each node is reached with the words whose budgets allow it and with what they have
    left. Where ``same_part`` is set, the asking word must be the smaller one.
    """
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    if stored and asking:
        small = lambda x: np.minimum(x, 30_000).astype(np.int16)
        own, asked = small(letter_counts(stored, FINE_GROUPS)), small(letter_counts(asking, FINE_GROUPS))
        order = np.lexsort(own.T[::-1])
        own = own[order]
        left, right = _Letters(stored), _Letters(asking)
        # A node: range of stored words, its depth, and the asking words with their surplus and deficit left.
        full = np.ones(len(asking), np.int16)
        stack = [(0, len(stored), 0, np.arange(len(asking)), full, full)]
        while stack:
            low, high, depth, rows, surplus, deficit = stack.pop()
            if high - low > LEAF_WORDS and depth < FINE_GROUPS:
                cuts = low + 1 + np.flatnonzero(np.diff(own[low:high, depth]))
                for start, end in zip([low, *cuts.tolist()], [*cuts.tolist(), high]):
                    change = own[start, depth] - asked[rows, depth]
                    go = (change <= surplus) & (-change <= deficit)
                    if go.any():
                        rest = np.maximum(change[go], 0), np.maximum(-change[go], 0)
                        stack.append((start, end, depth + 1, rows[go], surplus[go] - rest[0], deficit[go] - rest[1]))
                continue
            step = max(1, LEAF_PAIRS // (high - low))
            for k in range(0, len(rows), step):
                part = slice(k, k + step)
                change = own[None, low:high, depth:] - asked[rows[part], depth:][:, None]
                fit = (np.maximum(change, 0).sum(axis=2) <= surplus[part, None]) & (np.maximum(-change, 0).sum(axis=2) <= deficit[part, None])
                i, j = np.nonzero(fit)
                at, row = order[low + j], rows[part][i]
                near = _one_edit_pairs(left, at, right, row)
                found.append((at[near], row[near]))
    at, row = (np.concatenate(x) for x in zip(*found))
    keep = [not same_part[r] or asking[r] < stored[a] for a, r in zip(at.tolist(), row.tolist())]
    return at[keep], row[keep]


def without_a_letter(doc_id: int | None) -> Callable[[bytes], bytes]:
    """How the words of a document are changed: where 31 divides the crc32 of id and word, a letter is left out.

    A document without an id keeps its words.
    """
    if doc_id is None:
        return lambda word: word
    start = zlib.crc32(f"{doc_id}:".encode())

    def change(word: bytes) -> bytes:
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % 31:
            return word
        k = h % len(word)
        return word[:k] + word[k + 1 :]

    return change


def _counted(changed: bool, least: int):
    def rows(total: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.record_batch({"word": words, "n": pa.array(list(total.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch_values(batch, "doc_id"), batch_values(batch, "text"), strict=True):
                # One byte a code point; what lies beyond U+00FF becomes a question mark, which parts words as well.
                own = Counter(_RUN.findall((text or "").encode("latin-1", "replace").lower()))
                change = without_a_letter(doc_id) if changed else None
                for word, n in own.items():
                    if len(word) < least:
                        continue
                    if change:
                        word = change(word)
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) > MEMO_WORDS:
                    yield rows(total)
                    total.clear()
        if total:
            yield rows(total)

    return run


def word_counts(docs: DataFrame, change_words: bool = False, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` letters that occur at least ``min_count`` times in all texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. With ``change_words`` each document's words
    are first changed by ``without_a_letter``.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(_counted(change_words, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def coarse_groups(words: int) -> int:
    """How many coarse groups deal ``words`` words out: three, and one more for each factor of eight over a million."""
    n = 3
    while words > 1_000_000 and n < 12:
        words //= 8
        n += 1
    return n


def _dealt(n: int):
    steps = asked_steps(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = letter_counts([w.encode("latin-1") for w in batch_values(batch, "word")], n)
            parts, takes, homes = [], [], []
            for up, down in steps:
                other = counts.copy()
                if up >= 0:
                    other[:, up] += 1
                if down >= 0:
                    other[:, down] -= 1
                real = np.flatnonzero((other >= 0).all(axis=1))
                key = np.zeros(len(real), np.uint64)
                for g in range(n):
                    key = mixed(key + other[real, g].astype(np.uint64) + np.uint64(g + 1))
                parts.append(key.astype(np.int64))
                takes.append(real)
                homes.append(np.full(len(real), up < 0))
            rows = pa.array(np.concatenate(takes))
            columns = [pa.array(np.concatenate(parts)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(homes))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "word", "n", "home"])

    return run


def _compared(table: pa.Table) -> pa.Table:
    """Near pairs between the stored and the asking words of one block."""
    kinds = table.column("stored")
    stored, asking = table.filter(kinds), table.filter(pc.invert(kinds))
    words = lambda t: [w.encode("latin-1") for w in t.column("word").to_pylist()]
    # Two words that are stored in the same part ask each other; the smaller one's question counts.
    at, row = one_edit_apart(words(stored), words(asking), asking.column("home").to_numpy())
    columns = [side.column(name).take(pa.array(k)) for side, k in ((asking, row), (stored, at)) for name in ("word", "n")]
    return pa.table(columns, names=["a", "n_a", "b", "n_b"])


def near_words(words: DataFrame, coarse: int | None = None, part_words: int = PART_WORDS) -> DataFrame:
    """(a, n_a, b, n_b), once for each pair of distinct words of ``words`` (word, n) that are one edit apart.

    Code points of words lie below 256. A part's stored words are dealt over blocks and its asking words over chunks, so that
    a task holds at most some ``part_words`` of the former and ten times as many of the latter, whatever the words are.
    """
    n = coarse_groups(words.count()) if coarse is None else coarse
    rows = written(words.select("word", "n").mapInArrow(_dealt(n), "part long, word string, n long, home boolean"), "dealt")
    sizes = rows.groupBy("part").agg(
        F.ceil(F.count_if("home") / part_words).cast("int").alias("blocks"), F.ceil(F.count("*") / (10 * part_words)).cast("int").alias("chunks")
    )
    met = rows.join(sizes.where("blocks > 0"), "part")
    mixed = F.xxhash64("word")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c, h: F.pmod(h, F.col(c)).cast("int")
    second = F.xxhash64(mixed)
    asks = met.select("part", all_of("blocks").alias("block"), own("chunks", second).alias("chunk"), "word", "n", "home", F.lit(False).alias("stored"))
    stores = met.where("home").select("part", own("blocks", mixed).alias("block"), all_of("chunks").alias("chunk"), "word", "n", "home", F.lit(True).alias("stored"))
    return asks.union(stores).groupBy("part", "block", "chunk").applyInArrow(_compared, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): where following forms ends.

    A form is at least FORM_RATIO times as frequent as its word, so chains have no rings and at most 18 links; each round
    doubles the links that are followed.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = written(step, "roots")
        if not step.where("moved").head(1):
            return step.select("word", "root")
        at = step.select("word", "root")


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n): distinct words with their counts.

    The form is the word one edit away that is most frequent (of equal ones the smallest) if it is at least FORM_RATIO times
    as frequent; ``root`` is the end of the chain of forms, the word itself if it has none. An empty table gives no rows;
    a null word is no word.
    """
    ship(words.sparkSession)
    words = written(words.where("word is not null").select("word", "n"), "words")
    pairs = written(near_words(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("w")).alias("other"))
    both = both.union(pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("m"), F.col("a").alias("w")).alias("other")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    fits = -F.col("best.m") >= FORM_RATIO * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best.w")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")
    )
    formed = written(formed, "forms")
    ends = roots(formed.where("form is not null"))
    out = formed.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_texts(docs: DataFrame, change_words: bool = False) -> DataFrame:
    """``spelling_variants`` of the words of all texts of ``docs`` (doc_id, text, ...).

    A null or empty text has no words; repeated rows count each; other columns are ignored.
    """
    return spelling_variants(word_counts(docs, change_words))
