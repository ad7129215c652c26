"""Personal data by fixed forms and a semi-Markov conditional random field.

Fixed forms give the base spans: email, ip, card and phone. The field adds spans that the forms miss. A text is looked at
where it holds a digit, an @ sign, or "at" before a spelt-out host; the tokens around are a region. A segmentation of a region covers it with segments of
a bounded number of tokens, each of one kind or of none, and its score is the sum of the weights of whole-span features:
digit count, grouping, separators, checksum, the characters on either side. Dynamic programming sums over all segmentations to train
the weights and finds each segment's probability to choose boundaries and kinds together. Training data are base spans of
a bounded sample, and the same spans rewritten into other usual forms, between spans of no kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import ship

KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is trained on (by hash of the text), most regions of them, and passes over them.
SAMPLE_DOCS = 500
TRAIN_REGIONS = 2_000
EPOCHS = 8
#: Most tokens of a segment (the bound of the dynamic program), and below it the least probability of an added span.
MAX_TOKENS = 24
#: Fewest and most digits of a segment, an @ sign or an "at" before a host counting as nine; dotted quads may have fewer.
MIN_HELD, MAX_HELD = 9, 28
MIN_PROBABILITY = 0.7

# The base forms. Possessive runs give the same leftmost longest matches without trying others again.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NON_DIGIT = re.compile(r"[^0-9]+")
# A dot of a host or an address, as it stands or spelt out, and a host of two labels or more.
_BARE_DOT = r"(?:\.|\s?[\[({]\s?(?:[dD][oO][tT]|\.)\s?[\])}]\s?|\s[dD][oO][tT]\s)"
_SPELT_HOST = rf"[A-Za-z0-9-]++(?:{_BARE_DOT}[A-Za-z0-9-]++)++"
_HOST = re.compile(_SPELT_HOST)
_MORE = re.compile(rf"{_BARE_DOT}[A-Za-z0-9]")
# "at" behind a blank or bracket and before a host. It starts with a set of characters, which the search can look for fast.
_SPELT_AT = rf"[aA](?<=[\s(\[{{][aA])[tT]\s?[)\]}}]?\s?{_SPELT_HOST}"
_TRIGGER = re.compile(rf"[0-9@aA](?:(?<=[0-9@])|(?<=[\s(\[{{][aA])[tT]\s?[)\]}}]?\s?{_SPELT_HOST})")
_SPELT = re.compile(_SPELT_AT)
_AT = re.compile(r"@|\s?[\[({]\s?[aA][tT]\s?[\])}]\s?|\s[aA][tT]\s")
_PLAIN_END = re.compile(r"(?<![A-Za-z])(?:[a-z]{2,}|[A-Z]{2,})$")
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*")
_QUAD = re.compile(rf"[0-9]{{1,3}}(?:{_BARE_DOT}[0-9]{{1,3}}){{3}}")
# Words that stand before "at" and a host in plain prose.
_PROSE = frozenset(
    "a about available be contact data directly download find found free here hosted is it learn live located look looked looking"
    " me more now online only or out page posted published read register reside see shop site start stay stored them today"
    " update us view visit was were work you".split()
)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\S\n]+|.", re.DOTALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base forms, by kind, then start; kinds are found independently of each other."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(map(_byte, m.groups())):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NON_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


class Region:
    """Tokens of a stretch of text, with what segments need to know about it."""

    __slots__ = ("text", "start", "tokens")

    def __init__(self, text: str, start: int, end: int):
        self.start, self.text = start, text[start:end]
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(self.text)]


def regions(text: str, reach: int = 24) -> Iterator[Region]:
    """Stretches around triggers, to whole blank-separated words; no further than ``reach`` past the last one."""
    pos, n = 0, len(text)
    while m := _TRIGGER.search(text, pos):
        start, last = m.start(), m.end() - 1
        if text[start] in "aA":  # the name before a spelt-out at sign
            while start > pos and text[start - 1] in " ([{":
                start -= 1
            while start > pos and m.start() - start < 64 and text[start - 1] in _LOCAL:
                start -= 1
        while start > pos and m.start() - start < reach and not text[start - 1].isspace():
            start -= 1
        if start > pos and text[start - 1] in " (":  # an opening bracket or a word in front may belong to it
            lead = text.rfind(" ", max(pos, start - 12), start - 1)
            start = lead + 1 if lead >= 0 else start
        end = last
        while end < n and end - last <= reach:
            c = text[end]
            if c == "\n":
                break
            if c in "0123456789@":
                last = end
            elif c in "aA" and (spelt := _SPELT.match(text, end)):
                end = last = spelt.end() - 1
            elif c == " " and end - last > 8 and not text[last + 1 : end].isspace():
                break
            end += 1
        while end < n and end - last <= reach + 24 and not text[end].isspace():
            end += 1
        yield Region(text, start, end)
        pos = max(end, m.start() + 1)


def span_features(region: Region, i: int, j: int) -> list[str]:
    """Features of the whole segment of tokens i to j."""
    a, b = region.tokens[i][0], region.tokens[j - 1][1]
    s = region.text[a:b]
    digits = _NON_DIGIT.sub("", s)
    groups = re.findall("[0-9]+", s)
    letters = re.findall(r"[^\W\d_]+", s)
    marks = "".join(sorted(set(re.sub(r"[\w]", "", s))))
    n = len(digits)
    out = ["bias", f"first:{_shape(s[0])}", f"last:{_shape(s[-1])}"]
    at, quad = _AT.search(s), len(groups) == 4 and _QUAD.fullmatch(s) is not None
    if not at and not quad:  # how many digits and letters an address or a host holds says nothing
        out += [f"marks:{marks[:6]}", f"letters:{min(len(letters), 6)}", f"digits:{n if n < 20 else 20}"]
        out.append("groups:" + "-".join(str(len(g)) for g in groups[:6]))
    if not letters:
        if 13 <= n <= 19:
            out.append(f"card:{luhn(digits)}:{len(groups) in (1, 4) or marks == ''}")
        if 9 <= n <= 15:
            lead = "+" if s[0] == "+" else "00" if s.startswith("00") else "n"
            out.append(f"phone:{lead}:{s.count('(') == s.count(')')}:{len(groups)}")
            out.append("tail:" + lead + ":" + "-".join(str(len(g)) for g in groups[-3:]))
    if len(groups) == 4:
        out.append(f"quad:{quad}:{all(map(_byte, groups))}:{_MORE.match(region.text, b) is not None}")
    if at:
        name, host = s[: at.start()], s[at.end() :]
        form = "@" if at.group() == "@" else "word" if at.group().strip().isalpha() else "mark"
        whole = _NAME.fullmatch(name) is not None and (a == 0 or region.text[a - 1] not in _LOCAL)
        ends = _HOST.fullmatch(host) is not None and _MORE.match(region.text, b) is None and _PLAIN_END.search(host) is not None
        out.append(f"mail:{form}:{whole}:{ends}:{form == 'word' and name.lower() in _PROSE}")
    after = region.text[b : b + 1]
    front = region.text[a - 1 : a] if a else " "
    out.append(f"edge:{_shape(front)}:{_shape(after)}")
    return out


def _shape(c: str) -> str:
    if not c:
        return "end"
    return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


#: Kind index of "none"; such segments have one token and few features.
NONE = len(KINDS)


def lattice(region: Region) -> list[tuple[int, int, list[str]]]:
    """Candidate segments (i, j, features): single tokens for none, and for the kinds spans that hold enough digits, an at sign
    in any form, or a dotted quad."""
    n, text, tokens = len(region.tokens), region.text, region.tokens
    spelt = {m.start() for m in _SPELT.finditer(text)}
    out = []
    for i in range(n):
        a = tokens[i][0]
        if text[a].isspace():
            continue
        held = 0
        for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
            b0, b = tokens[j - 1]
            if text[b0].isdigit():
                held += b - b0
            elif text[b0] == "@" or b0 in spelt:
                held += 9
            if held > MAX_HELD:  # longer than any kind: numeric tables cost no more than their tokens
                break
            if text[b - 1].isspace():
                continue
            if held >= MIN_HELD or held >= 4 and text[a].isdigit() and text[b0].isdigit() and _QUAD.fullmatch(text, a, b):
                out.append((i, j, span_features(region, i, j)))
    return out


class SpanField:
    """Weights of the field. ``weights[feature]`` holds one number per kind."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        self.weights = weights or {}

    def _scores(self, segments: list) -> np.ndarray:
        zero = np.zeros(NONE)
        get = self.weights.get
        return np.array([sum((get(f, zero) for f in fs), start=np.zeros(NONE)) for _, _, fs in segments]).reshape(-1, NONE)

    def marginals(self, n: int, segments: list, scores: np.ndarray) -> np.ndarray:
        """Probability of each segment with each kind, by sums over all segmentations (forward and backward)."""
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        starts: list[list[int]] = [[] for _ in range(n + 1)]
        mass = np.logaddexp.reduce(scores, axis=1) if len(segments) else np.zeros(0)
        for k, (i, j, _) in enumerate(segments):
            ends[j].append(k)
            starts[i].append(k)
        forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            total = forward[j - 1]
            for k in ends[j]:
                total = _logadd(total, forward[segments[k][0]] + mass[k])
            forward[j] = total
        for i in range(n - 1, -1, -1):
            total = backward[i + 1]
            for k in starts[i]:
                total = _logadd(total, backward[segments[k][1]] + mass[k])
            backward[i] = total
        at = np.array([forward[i] + backward[j] for i, j, _ in segments]) - forward[n]
        return np.exp(np.minimum(scores + at[:, None], 0.0)) if len(segments) else np.zeros((0, NONE))

    def train(self, examples: list[tuple[Region, dict[tuple[int, int], int]]], epochs: int = EPOCHS, rate: float = 0.3) -> None:
        """Gradient ascent on the log-likelihood; an example has the gold kind of its gold segments (i, j)."""
        prepared = []
        for region, gold in examples:
            segments = lattice(region)
            want = np.zeros((len(segments), NONE))
            for k, (i, j, _) in enumerate(segments):
                if (i, j) in gold:
                    want[k, gold[i, j]] = 1
            if segments:
                prepared.append((len(region.tokens), segments, want))
        for epoch in range(epochs):
            step = rate / (1 + 0.3 * epoch)
            for n, segments, want in prepared:
                change = step * (want - self.marginals(n, segments, self._scores(segments)))
                for k in np.flatnonzero(np.abs(change).max(axis=1) > 1e-4):
                    for f in segments[k][2]:
                        if f in self.weights:
                            self.weights[f] = self.weights[f] * 0.9995 + change[k]
                        else:
                            self.weights[f] = change[k].copy()

    def spans(self, region: Region) -> list[tuple[int, int, int, float]]:
        """(kind, start, end, probability) of the likeliest non-overlapping segments, in text offsets."""
        segments = lattice(region)
        if not segments:
            return []
        p = self.marginals(len(region.tokens), segments, self._scores(segments))
        out = []
        for k in np.flatnonzero(p.max(axis=1) >= MIN_PROBABILITY):
            i, j, _ = segments[k]
            out.append((int(p[k].argmax()), region.start + region.tokens[i][0], region.start + region.tokens[j - 1][1], float(p[k].max())))
        return out  # segments of probability over one half never overlap


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + log1p(exp(b - a)) if a - b < 40 else a


def _rewritten(kind: int, s: str) -> list[str]:
    """The span in the other usual forms of its kind."""
    digits = _NON_DIGIT.sub("", s)
    if kind == 0:
        name, _, host = s.partition("@")
        spelt, plain = host.replace(".", " dot "), re.sub("[^A-Za-z]", "", name) or name
        forms = (f"{name} at {host}", f"{plain} at {host}", f"{name} (at) {spelt}", f"{name}[at]{host}", f"{plain} at {spelt}", f"{name} [at] {host.replace('.', '[dot]')}", f"{name}(at){host}")
        return [*forms, f"{name}@{host.replace('.', '[.]')}"]
    if kind == 1:
        return [s.replace(".", "[.]"), s.replace(".", " dot "), s.replace(".", "(dot)")]
    if kind == 2:
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(parts), "/".join(parts), "  ".join(parts), "_".join(parts)]
    tail, land = digits[-10:], digits[:-10]
    if len(tail) < 10:
        return [s.replace(" ", ".")]
    a, b, c = tail[:3], tail[3:6], tail[6:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{land} {a} {b} {c}", f"{a}.{b}.{c}", f"0044 {a} {b} {c}", f"+{land or 1}/{a}/{b}/{c}", f"00{land}-{a}-{b}-{c}"]


def _noise(turn: int) -> str:
    """What is nobody's: dates, versions, amounts, social and book numbers, failed card checks, hexadecimal keys, places on the web."""
    h = hashlib.sha256(str(turn).encode()).hexdigest()
    d = _NON_DIGIT.sub("", h).ljust(40, "7")
    wrong = next(d[:15] + c for c in "0123456789" if not luhn(d[:15] + c))
    day = f"20{d[:2]}-0{int(d[2]) % 9 + 1}-1{d[3]}"
    verb = sorted(_PROSE)[int(h[:6], 16) % len(_PROSE)]
    forms = (
        day, f"{d[0]}.{d[1]}.{d[2]}", f"{d[:3]},{d[3:6]}.{d[6:8]}", wrong, h[:18], h[:40], f"{d[:4]}", f"{d[0]}{d[1]}:{d[2]}{d[3]}",
        f"AKIA{h[:16].upper()}", f"1{d[:3]}.4{d[3:6]}.{d[6:10]}.9{d[:3]}", d[:11], d[:24], f"{d[:3]}-{d[3:5]}", f"0{d[:2]}-{d[2:4]}-{d[4:8]}",
        f"{d[:3]}-{d[3:5]}-{d[5:9]}", f"{day} 1{d[4]}:2{d[5]}:3{d[6]}", f"1{d[4]}/0{d[5]}/20{d[6:8]} 1{d[8]}:4{d[9]}", f"978-{d[0]}-{d[1:3]}-{d[3:9]}-{d[9]}",
        f"{d[:10]}", f"{d[:5]}-{d[5:10]}", f"{d[0]},{d[1:4]},{d[4:7]},{d[7:10]}", f"4{d[0]}.{d[1:7]}, 2.{d[7:13]}", f"0.{d[:10]}",
        f"{verb} at www.{h[:5]}.org", f"{verb} at {h[5:9]}.example.com", f"{verb} at site.net", f"3{d[:2]}[.]4{d[2:4]}[.]{d[4]}[.]{d[5]}", f"{day} {day}",
    )
    return forms[turn % len(forms)]


def _edges(front: str, rear: str, turn: int) -> tuple[str, str]:
    """A span's neighbourhood as it stands, at a text's ends, and before or between punctuation."""
    return ((front, rear), ("", ""), (front, f", {rear.lstrip()}"), (front, f". {rear.lstrip()}"), (f"{front.rstrip()} (", f") {rear.lstrip()}"), ("", rear), (front, ""))[turn % 7]


def examples_from(texts: list[str], limit: int = TRAIN_REGIONS) -> list[tuple[Region, dict[tuple[int, int], int]]]:
    """Regions with gold spans: base spans as they stand, rewritten ones, and noise, each in varied neighbourhoods of its own."""
    out, turn, seen = [], 0, [0] * len(KINDS)
    for text in texts:
        for kind, start, end in base_spans(text):
            if len(out) >= limit:
                return out
            front, rear = text[max(0, start - 25) : start].rsplit("\n", 1)[-1], text[end : end + 25].split("\n", 1)[0]
            if _TRIGGER.search(front) or _TRIGGER.search(rear):
                continue
            own = text[start:end]
            forms = _rewritten(kind, own)
            made_forms = [(own, kind), *((forms[(2 * seen[kind] + k) % len(forms)], kind) for k in range(2)), (_noise(turn), None), (_noise(turn + 1), None)]
            turn += 2
            seen[kind] += 1
            for s, k in made_forms:
                before, after = _edges(front, rear, len(out))
                made = before + s + after
                for region in regions(made):
                    gold = {}
                    a, b = len(before) - region.start, len(before) + len(s) - region.start
                    edges = {t[0]: n for n, t in enumerate(region.tokens)}, {t[1]: n + 1 for n, t in enumerate(region.tokens)}
                    if k is not None and a in edges[0] and b in edges[1]:
                        gold[edges[0][a], edges[1][b]] = k
                    out.append((region, gold))
    return out


def all_spans(text: str, field: SpanField) -> tuple[list, list]:
    """(base spans, all spans): the field's spans are added where they overlap no base span."""
    base = base_spans(text)
    if not _TRIGGER.search(text):
        return base, base
    taken = sorted((s, e) for _, s, e in base)
    lows, extra = [s for s, _ in taken], []
    for region in regions(text):
        for kind, start, end, _ in field.spans(region):
            at = bisect_right(lows, start)
            clear = (at == 0 or max(e for _, e in taken[max(0, at - 4) : at]) <= start) and (at == len(taken) or taken[at][0] >= end)
            if clear:
                extra.append((kind, start, end))
    return base, sorted({*base, *extra})


def joined_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def train_field(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> SpanField:
    """Fit on base spans of at most ``sample_docs`` texts that hold a digit, picked by hash of the text."""
    hit = docs.where(F.col("text").rlike("[0-9]{4}|@")).select("text")
    texts = [r.text for r in hit.orderBy(F.xxhash64("text"), "text").limit(sample_docs).toLocalIterator()]
    field = SpanField()
    field.train(examples_from(texts))
    return field


def _find(field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = field.value
        for batch in batches:
            counts, shas, spans = [[], [], [], []], [], []
            for text in batch.column(1).to_pylist():
                base, whole = all_spans(text or "", model)
                kinds = [k for k, _, _ in base]
                for k in range(4):
                    counts[k].append(kinds.count(k))
                shas.append(hashlib.sha256(joined_text(base).encode()).hexdigest())
                spans.append(joined_text(whole))
            columns = {"doc_id": batch.column(0)} | {f"n_{n}": pa.array(c, pa.int64()) for n, c in zip(KINDS, counts, strict=True)}
            yield pa.record_batch(columns | {"base_sha256": pa.array(shas), "spans": pa.array(spans)})

    return run


def find_pii(docs: DataFrame, field: SpanField | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs`` (doc_id, text, ...).

    Counts and hash are of the base spans, ``spans`` lists all as kind:start:end by kind, then start, in code points. A
    null text is an empty one: no spans. Repeated rows each return, null ids stay, other columns are ignored.
    """
    ship(docs.sparkSession)
    field = field or train_field(docs)
    model = docs.sparkSession.sparkContext.broadcast(field)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_find(model), schema)


def masked(text: str, field: SpanField) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the earlier, then longer one."""
    out, at = [], 0
    for kind, start, end in sorted(all_spans(text, field)[1], key=lambda x: (x[1], -x[2])):
        if start < at:
            continue
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, field: SpanField | None = None) -> DataFrame:
    """``docs`` with its own columns, personal data in ``text`` masked; null texts stay null."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(field or train_field(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            texts = [None if t is None else masked(t, own) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
