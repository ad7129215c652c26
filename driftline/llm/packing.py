"""Packing token sequences with a bounded number of open windows.

Each partition keeps a fixed number of open windows. A document's whole windows leave at once; its rest goes to the open
window with the least room that still holds it. When none holds it, the fullest window is emitted: it is topped up from the
front of the rest, so that it leaves without padding. At the end of the partition its windows are poured together, and the
one that is not full leaves with its ids; such leftovers of many partitions are poured together in groups. A final rest is
cut at powers of two, where sequences need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship, written

LENGTH = 1024
OPEN_WINDOWS = 32
#: Partitions whose leftovers (under LENGTH ids each) are merged in one task.
MERGE_GROUP = 4096
#: The id after each document.
END_ID = 0
_PIECE = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Texts in which the fast encoder is known to give the very ids of the defining one: no special token's string and only
#: characters below U+0250 or general punctuation, on whose classes both agree.
_PLAIN_LIMIT = r"[^\u0000-ɏ‐-›]"


class TokenIds:
    """Ids of ``tokenizers`` for one vocabulary file; where given, ``ranks`` of the same vocabulary serve plain texts faster."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        import base64
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        special = [re.escape(t.content) for t in self.slow.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([_PLAIN_LIMIT, *special]))

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or self.odd.search(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.append(np.array(ids, "<u4"), np.uint32(END_ID)).astype("<u4")


def public_tokens() -> TokenIds:
    """The byte-level vocabulary of 50,257 ids that the installed package of public tokenizers names."""
    import public_tokenizers

    return TokenIds(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


class Packer:
    """Open windows of one partition. A piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, length: int, windows: int, first_id: int):
        self.length, self.windows = length, windows
        self.next_id = first_id
        self.open: list[tuple[int, int]] = []  # (room, window), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.made = 0

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, at = len(ids), 0
        while total - at >= self.length:
            yield from self._emit([(doc, at, ids[at : at + self.length], total)])
            at += self.length
        while at < total:
            rest = ids[at:]
            best = bisect_left(self.open, (len(rest), -1))
            if best < len(self.open):
                room, window = self.open.pop(best)
                self.pieces[window].append((doc, at, rest, total))
                if room > len(rest):
                    insort(self.open, (room - len(rest), window))
                else:
                    yield from self._emit(self.pieces.pop(window))
                return
            if len(self.open) < self.windows:
                self.made += 1
                self.pieces[self.made] = [(doc, at, rest, total)]
                insort(self.open, (self.length - len(rest), self.made))
                return
            room, window = self.open.pop(0)  # the fullest
            self.pieces[window].append((doc, at, rest[:room], total))
            yield from self._emit(self.pieces.pop(window))
            at += room

    def pour(self) -> tuple[list[tuple], list[tuple]]:
        """Rows of the windows that full ones can be made of, and the pieces of the last one that is not full."""
        rows, held, size = [], [], 0
        for room, window in self.open:
            for doc, start, ids, total in self.pieces[window]:
                while len(ids):
                    take = min(self.length - size, len(ids))
                    held.append((doc, start, ids[:take], total))
                    start, ids, size = start + take, ids[take:], size + take
                    if size == self.length:
                        rows.extend(self._emit(held))
                        held, size = [], 0
        self.open, self.pieces = [], {}
        return rows, held

    def close(self, held: list[tuple]) -> Iterator[tuple]:
        """The last pieces, in sequences cut at powers of two."""
        left = sum(len(p[2]) for p in held)
        queue = list(held)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            now = []
            while size:
                doc, start, ids, total = queue.pop(0)
                now.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    queue.insert(0, (doc, start + size, ids[size:], total))
                size -= min(size, len(ids))
            yield from self._emit(now)


_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _batch(rows: list[tuple], left: list[tuple], group: int, id_type: pa.DataType) -> pa.RecordBatch:
    """Finished pieces (ids null), then leftover pieces with their ids (no sequence yet)."""
    values = list(zip(*rows, strict=True)) if rows else [()] * 7
    none = [None] * len(left)
    columns = {"doc_id": pa.array([*values[0], *[p[0] for p in left]], id_type)}
    extra = [[p[1] for p in left], [len(p[2]) for p in left], none, [p[3] for p in left], none, none]
    for name, value, more in zip(_FIELDS[1:], values[1:], extra, strict=True):
        columns[name] = pa.array([*value, *more], pa.int64())
    columns["ids"] = pa.array([None] * len(rows) + [p[2].tobytes() for p in left], pa.binary())
    columns["part"] = pa.array([group] * (len(rows) + len(left)), pa.int64())
    return pa.record_batch(columns)


def _pack(encoder: Callable, length: int, windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids_of, packer, id_type = encoder(), Packer(length, windows, part << 32), None
        for batch in batches:
            id_type, rows = batch.column(0).type, []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.extend(packer.add(doc, ids_of(text or "")))
            yield _batch(rows, [], part, id_type)
        if id_type is not None:
            rows, held = packer.pour()
            yield _batch(rows, held, part, id_type)

    return run


def _merge(length: int):
    def run(key, groups):
        table = pa.Table.from_batches(groups) if not isinstance(groups, pa.Table) else groups
        table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
        packer = Packer(length, 1, (1 << 62) + (key[0].as_py() << 32))
        pieces = [
            (doc, start, np.frombuffer(ids, "<u4"), total)
            for doc, start, ids, total in zip(*[table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")], strict=True)
        ]
        packer.pieces, packer.open = {k: [p] for k, p in enumerate(pieces)}, [(length, k) for k in range(len(pieces))]
        rows, held = packer.pour()
        rows.extend(packer.close(held))
        values = list(zip(*rows, strict=True)) if rows else [()] * 7
        columns = {"doc_id": pa.array(values[0], table.column("doc_id").type)}
        columns |= {n: pa.array(v, pa.int64()) for n, v in zip(_FIELDS[1:], values[1:], strict=True)}
        return pa.table(columns)

    return run


def pack(docs: DataFrame, encoder: Callable = public_tokens, length: int = LENGTH, windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every row of ``docs`` (doc_id, text, ...).

    Sequences hold at most ``length`` ids (a power of two); all hold exactly that many but for a final rest of each merge
    group, cut at powers of two. ``encoder`` makes, once a task, the function from text to ids with the end id. A null text
    is an empty one: its end id only. Repeated rows and null ids are packed like others; other columns are ignored.
    """
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    schema = _PIECE.format(id=id_type) + ", ids binary, part long"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    packed = written(rows.mapInArrow(_pack(encoder, length, windows), schema), "packed")
    done = packed.where("ids is null").select(*_FIELDS)
    rest = packed.where("ids is not null")
    # Within a partition the pieces keep an order of their own, so that a repeated task gives the same sequences.
    order = F.row_number().over(_by_part())
    rest = rest.withColumn("seq", order.cast("long"))
    merged = rest.select((F.col("part") / MERGE_GROUP).cast("long").alias("g"), "part", "seq", "doc_id", "start", "ids", "doc_tokens")
    merged = merged.groupBy("g").applyInArrow(_merge(length), _PIECE.format(id=id_type))
    return done.union(merged)


def _by_part():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("doc_id", "start", "ids")


def sequences(docs: DataFrame, pieces: DataFrame, encoder: Callable = public_tokens) -> DataFrame:
    """(sequence_id, ids) with the real ids of every sequence, from the documents and their pieces; ids must be unique."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder()
        for batch in batches:
            ids, parts = [], []
            for text, start, size in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                ids = ids_of(text or "")
                parts.append(ids[start : start + size].astype(np.int64))
            yield pa.record_batch({"sequence_id": batch.column(3), "offset": batch.column(4), "ids": pa.array(parts, pa.list_(pa.int64()))})

    ship(docs.sparkSession)
    rows = pieces.join(docs.select("doc_id", "text"), "doc_id").select("text", "start", "length", "sequence_id", "offset")
    cutted = rows.mapInArrow(cut, "sequence_id long, offset long, ids array<long>")
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return cutted.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda x: x.ids)).alias("ids"))

