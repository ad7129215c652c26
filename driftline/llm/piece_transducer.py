"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file is compiled into three machines: the normaliser (spaces to the space mark, a mark in front), the pieces, and
the byte fallback for characters without a piece. Composed with an input they give a lattice of pieces over positions. For
a merge-based (BPE) vocabulary, a bigram machine over pieces follows: two neighbours cost nothing if merging their joined
text gives just those two, and infinity otherwise, which leaves the one path that merging would give. For a unigram
vocabulary, an arc costs the negative of the piece's score. The encoding is the path of least weight in the tropical
semiring (least sum): of pieces with scores found position by position, of merges, where weights are nothing or infinity,
depth first and longest arcs first.

No piece holds a space mark after another character, so no path is ever merged across a word's start: inputs are encoded
word by word, and words that recur are encoded once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship

MARK = "▁"
#: Words, and pairs of pieces, whose results a worker keeps (some 200 bytes each) before it starts afresh.
MEMO_WORDS, MEMO_PAIRS = 1_000_000, 500_000
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
INFINITE = float("inf")


class _Memo(dict):
    """Bounded memo of a function."""

    def __init__(self, make: Callable, entries: int):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Transducer:
    """The compiled model."""

    def __init__(self, model: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as file:
            proto.ParseFromString(file.read())
        norm, kinds = proto.normalizer_spec, proto.SentencePiece
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.merging = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.byte_ids = [-1] * 256
        self.surface: list[bytes] = []
        self.unknown = 0
        for i, piece in enumerate(proto.pieces):
            self.scores.append(piece.score)
            self.surface.append(piece.piece.replace(MARK, " ").encode())
            if piece.type == kinds.NORMAL or piece.type == kinds.USER_DEFINED:
                self.ids[piece.piece] = i
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[1:-1], 16)
                self.byte_ids[value], self.surface[i] = i, bytes([value])
            else:
                self.surface[i] = b""
                if piece.type == kinds.UNKNOWN:
                    self.unknown, self.surface[i] = i, " ⁇ ".encode()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces that cross a word's start are not supported")
        # The pieces' automaton as one table: every beginning of a piece, with the piece's id or -1 where it is none.
        self.states = {p[:n]: -1 for p in self.ids for n in range(1, len(p))} | self.ids
        self.packed = [int(i).to_bytes(4, "little") for i in range(len(self.scores))]
        self.unknown_score = min(self.scores, default=0.0) - 10.0
        self.word_ids = _Memo(self._encode_word, MEMO_WORDS)
        self._fits = _Memo(self._stable, MEMO_PAIRS)

    def merged(self, text: str, cut: int = 0) -> list[str]:
        """The merges themselves on a short text: best score first, leftmost among equals.

        With ``cut`` they end as soon as one goes across that place.
        """
        parts = list(text)
        ids, scores = self.ids, self.scores
        ranks = [scores[k] if (k := ids.get(x + y)) is not None else -INFINITE for x, y in pairwise(parts)]
        while ranks and (best := max(ranks)) > -INFINITE:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if cut:
                start = sum(map(len, parts[:at]))
                if start < cut < start + len(parts[at]):
                    break
            for i in (at - 1, at):
                if 0 <= i < len(ranks):
                    ranks[i] = scores[k] if (k := ids.get(parts[i] + parts[i + 1])) is not None else -INFINITE
        return parts

    def _stable(self, pair: tuple[str, str]) -> bool:
        """Whether merging the joined text leaves just these two neighbours (or the one piece at a word's start)."""
        return self.merged(pair[0] + pair[1], len(pair[0])) == [p for p in pair if p]

    def _merge_path(self, word: str) -> list[str]:
        """The one path of finite weight, longest arcs first; a position that led nowhere is not entered again."""
        n, at = len(word), 0
        state, fits = self.states.get, self._fits
        path: list[str] = []
        open_arcs: list[list[str]] = []
        seen = {0}
        arcs: list[str] | None = None
        while at < n:
            if arcs is None:
                arcs = []
                for end in range(at + 1, n + 1):
                    piece = word[at:end]
                    known = state(piece)
                    if known is None and end > at + 1:
                        break  # no piece begins so
                    if known is None or known >= 0 or end == at + 1:
                        arcs.append(piece)
                    if known is None:
                        break
            before = path[-1] if path else ""
            while arcs:
                piece = arcs.pop()
                end = at + len(piece)
                if end not in seen and fits[before, piece]:
                    seen.add(end)
                    path.append(piece)
                    open_arcs.append(arcs)
                    at, arcs = end, None
                    break
            else:
                if not path:
                    return self.merged(word)
                at -= len(path.pop())
                arcs = open_arcs.pop()
        return path

    def shortest_path(self, word: str) -> list[str]:
        """Least-weight path over one word's lattice, as pieces; characters without a piece stay single."""
        if self.merging:  # the bigram machine: nothing or infinity, so the first finite path is the least
            return self._merge_path(word)
        n = len(word)
        state, scores = self.states.get, self.scores
        weight = [0.0] + [INFINITE] * n
        last: list[str] = [""] * (n + 1)
        for start in range(n):
            here = weight[start]
            if here == INFINITE:
                continue
            for end in range(start + 1, n + 1):
                piece = word[start:end]
                known = state(piece)
                if known is None and end > start + 1:
                    break  # no piece begins so
                if known is None or known >= 0 or end == start + 1:
                    total = here - (self.unknown_score if known is None or known < 0 else scores[known])
                    if total < weight[end]:
                        weight[end], last[end] = total, piece
                if known is None:
                    break
        path, at = [], n
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _encode_word(self, word: str) -> bytes:
        out: list[bytes] = []
        for piece in self.shortest_path(word):
            known = self.ids.get(piece)
            if known is not None:
                out.append(self.packed[known])
            elif self.byte_ids[0] >= 0:
                out.extend(self.packed[self.byte_ids[b]] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                out.append(self.packed[self.unknown])
        return b"".join(out)

    def normalised(self, text: str) -> str:
        return self.prefix + text.replace(" ", MARK) if text else ""

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null and empty texts have none."""
        if not text:
            return np.empty(0, "<i4")
        return np.frombuffer(b"".join(map(self.word_ids.__getitem__, _WORDS.findall(self.normalised(text)))), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, without the space in front that the normaliser adds; broken byte runs become U+FFFD."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_COMPILED: dict[str, Transducer] = {}


def compiled(model: str) -> Transducer:
    """The model's machines, once per worker process."""
    if model not in _COMPILED:
        _COMPILED[model] = Transducer(model)
    return _COMPILED[model]


def public_model() -> str:
    """File of the public 32,000-piece vocabulary, wherever its package is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    ship(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")), dict(docs.dtypes)["doc_id"]


def encode(docs: DataFrame, model: Callable[[], str] = public_model) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text, ...), by the whole text.

    Null and empty texts have no ids. Repeated rows each return, null ids stay, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model())
        for batch in batches:
            ids = [machine.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    rows, kind = _texts(docs)
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: Callable[[], str] = public_model) -> DataFrame:
    """(doc_id, text) of every row of ``encoded`` (doc_id, ids, ...); null ids give a null text, none an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model())
        for batch in batches:
            texts = [None if x is None else machine.decode(np.array(x, "<i4")) for x in batch.column(1).to_pylist()]
            yield pa.record_batch({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    ship(encoded.sparkSession)
    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, model: Callable[[], str] = public_model) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_crc32, exact) of every row: encodes and decodes each whole text in one pass.

    ids_crc32 is over the ids as little-endian 32-bit numbers; ``exact`` says that decoding gives the text back, but for
    space marks of its own, which are read as spaces. A null text counts as an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(model())
        is_byte = np.zeros(len(machine.surface), bool)
        is_byte[[b for b in machine.byte_ids if b >= 0]] = True
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                ids = machine.encode(text)
                exact = machine.decode(ids) == text.replace(MARK, " ")
                rows.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.tobytes()), exact))
            n, m, crc, exact = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = {"doc_id": batch.column(0)} | {k: pa.array(v, pa.int64()) for k, v in zip(("n_pieces", "n_byte_pieces", "ids_crc32"), (n, m, crc), strict=True)}
            yield pa.record_batch(columns | {"exact": pa.array(exact, pa.bool_())})

    rows, kind = _texts(docs)
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, n_byte_pieces long, ids_crc32 long, exact boolean")
