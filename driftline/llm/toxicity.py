"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

Voters are mined from labelled training texts: lexicon voters fire on a word, pattern voters on a word beginning. Each votes
``toxic`` or abstains; for each family a further voter says ``clean`` when the family found nothing. The label model gives
every voter its vote rates in either class and learns them by expectation maximisation, without looking at the labels
again; voters that still correlate within a class share their evidence. A logistic model over the voters is then trained
on the posterior labels, and scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import MEMO_ENTRIES, batch_values, ship, text_rows

#: Most labelled rows that voters, label model and classifier are fitted on (taken by hash of the id).
MAX_TRAINING_ROWS = 20_000
#: Most voters of each family, fewest labelled texts that a voter must occur in, least share of toxic ones among them.
MAX_VOTERS = 200
MIN_TEXTS = 5
MIN_PURITY = 0.8
PREFIXES = (4, 5, 6, 7)
MARKS = ".,;:!?\"'()[]{}<>*#$%&|…«»“”‘’-"


def features_of(word: bytes) -> list[str]:
    """Lexicon feature and pattern features of one word: w:word, p:beginning."""
    text = word.decode("utf-8", "replace").strip(MARKS).lower()
    if len(text) < 3 or len(text) > 40:
        return []
    return [f"w:{text}", *[f"p:{text[:n]}" for n in PREFIXES if len(text) >= n]]


class _Votes(dict):
    """Memo from word to the voters that fire on it."""

    def __init__(self, voters: dict[str, int]):
        super().__init__()
        self.voters = voters

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = tuple(v for f in features_of(word) if (v := self.voters.get(f)) is not None)
        return value


def fired(memo: _Votes, text: bytes | None) -> list[int]:
    """Voters that fire anywhere in the whole text."""
    out: set[int] = set()
    if text:
        for votes in filter(None, map(memo.__getitem__, set(text.split()))):
            out.update(votes)
    return sorted(out)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic) of each text, each feature once."""
    for batch in batches:
        names, marks = [], []
        for text, toxic in zip(batch_values(batch, "text"), batch_values(batch, "toxic"), strict=True):
            own = {f for word in set((text or b"").split()) for f in features_of(word)}
            names.extend(own)
            marks.extend([toxic] * len(own))
        yield pa.record_batch({"feature": pa.array(names, pa.string()), "toxic": pa.array(marks, pa.int32())})


def mine_voters(texts: DataFrame) -> list[str]:
    """Features that labelled toxic texts have and others hardly do; at most MAX_VOTERS of each family."""
    counts = texts.mapInArrow(_mentions, "feature string, toxic int").groupBy("feature").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    good = counts.where((F.col("n") >= MIN_TEXTS) & (F.col("bad") >= MIN_PURITY * F.col("n")))
    out: list[str] = []
    for family in ("w:", "p:"):
        rows = good.where(F.col("feature").startswith(family)).orderBy(F.desc("bad"), "feature").limit(MAX_VOTERS).collect()
        out += [r.feature for r in rows]
    return out


class LabelModel:
    """Generative model of votes: y, then each voter's vote given y. Votes are 1 (toxic), -1 (clean), 0 (abstains)."""

    def __init__(self, votes: np.ndarray, times: np.ndarray, prior: float, rounds: int = 25):
        """``times``: how many texts have each row of votes."""
        n, m = votes.shape
        values = np.array([1, -1, 0])
        self.onehot = [(votes == v).astype(np.float64) for v in values]
        # Start: a voter is right more often than not; a text that any voter calls toxic probably is.
        post = np.where((votes == 1).any(axis=1), 0.9, 0.05) if m else np.full(n, prior)
        self.weight = np.ones(m)
        for step in range(rounds):
            self.prior = float(np.clip(np.average(post, weights=times), 1e-3, 1 - 1e-3)) if n else prior
            self.rates = []
            for side in (times * post, times * (1 - post)):
                total = side.sum() + 1.5
                self.rates.append(np.stack([(side @ o + 0.5) / total for o in self.onehot]) if m else np.zeros((3, 0)))
            if step == rounds // 2:
                self.weight = self._shared(votes, times, post)
            new = self.posterior(votes)
            if np.abs(new - post).max(initial=0.0) < 1e-6 and step > rounds // 2:
                break
            post = new

    @staticmethod
    def _shared(votes: np.ndarray, times: np.ndarray, post: np.ndarray) -> np.ndarray:
        """Weights that divide a voter's evidence by how many voters say the same within a class."""
        load = np.ones(votes.shape[1])
        for side in (times * post, times * (1 - post)):
            total = side.sum()
            if total < 2:
                continue
            mean = side @ votes / total
            centred = (votes - mean) * np.sqrt(side)[:, None]
            cov = centred.T @ centred / total
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            corr = np.abs(cov / np.outer(scale, scale))
            np.fill_diagonal(corr, 0.0)
            load = np.maximum(load, 1 + np.where(corr > 0.3, corr, 0).sum(axis=1))
        return 1 / load

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for k, value in enumerate((1, -1, 0)):
            logs += (votes == value) @ (self.weight * (np.log(self.rates[0][k]) - np.log(self.rates[1][k])))
        return 1 / (1 + np.exp(-np.clip(logs, -35, 35)))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, rounds: int = 400, rate: float = 0.5, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ (w + 0.9 * vw) + b + 0.9 * vb, -35, 35)))
        d = times * (p - y) / times.sum()
        vw = 0.9 * vw - rate * 4 * (x.T @ d + ridge * w)
        vb = 0.9 * vb - rate * 4 * d.sum()
        w, b = w + vw, b + vb
    return w, b


class ToxicityModel:
    """Voters with the classifier's weights."""

    def __init__(self, voters: list[str], weights: np.ndarray, bias: float):
        self.voters = {f: i for i, f in enumerate(voters)}
        self.weights, self.bias = weights, bias

    def design(self, hits: list[list[int]]) -> np.ndarray:
        """Voter columns, and for each family whether it fired at all and how many of its voters did (log)."""
        m = len(self.voters)
        x = np.zeros((len(hits), m + 4))
        words = np.array([f.startswith("w:") for f in self.voters], bool)
        for i, own in enumerate(hits):
            x[i, own] = 1
        for k, family in enumerate((words, ~words)):
            n = x[:, :m][:, family].sum(axis=1) if m else np.zeros(len(hits))
            x[:, m + 2 * k], x[:, m + 2 * k + 1] = n > 0, np.log1p(n)
        return x

    def scores(self, hits: list[list[int]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(hits) @ self.weights + self.bias, -35, 35)))


def _hits(voters: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Votes(voters)
        for batch in batches:
            hits = [fired(memo, t) for t in batch_values(batch, "text")]
            yield pa.record_batch({"hits": pa.array(hits, pa.list_(pa.int64())), "toxic": batch.column(batch.schema.get_field_index("toxic"))})

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows; several labels of one id count as toxic if any is, null labels as none."""
    ship(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = text_rows(docs, "doc_id").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    voters = mine_voters(texts)
    model = ToxicityModel(voters, np.zeros(len(voters) + 4), -3.0)
    # Ids can repeat with other texts, so the rows are bounded again by the sample's own order.
    rows = texts.mapInArrow(_hits(model.voters), "hits array<long>, toxic int").groupBy("hits", "toxic").count().collect()
    if not rows or not voters:
        return model
    hits, repeat = [list(r.hits) for r in rows], np.array([r["count"] for r in rows])
    x = model.design(hits)
    m = len(voters)
    clean = np.stack([np.where(x[:, m] > 0, 0, -1), np.where(x[:, m + 2] > 0, 0, -1)], axis=1)
    votes = np.concatenate([x[:, :m], clean], axis=1)
    prior = sum(r.toxic * r["count"] for r in rows) / repeat.sum()
    label_model = LabelModel(votes, repeat, float(np.clip(prior, 0.001, 0.999)))
    model.weights, model.bias = _logistic(x, label_model.posterior(votes), repeat)
    return model


def _apply(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        memo = _Votes(own.voters)
        for batch in batches:
            scores = own.scores([fired(memo, t) for t in batch_values(batch, "text")])
            at = batch.schema.get_field_index("text")
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=[*names, "score"])

    return run


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the score of every row of ``docs`` (doc_id, text, ...) by its whole text.

    Null and empty texts get the score of a text in which no voter fires. Repeated rows each return, null ids stay.
    """
    ship(docs.sparkSession)
    own = docs.sparkSession.sparkContext.broadcast(model)
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col("text").cast("binary").alias("text"))
    schema = ", ".join([f"k{i} {dict(docs.dtypes)[c]}" for i, c in enumerate(keep)] + ["score double"])
    return rows.mapInArrow(_apply(own), schema).toDF(*keep, "score")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; held-out labels are never learnt from."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
