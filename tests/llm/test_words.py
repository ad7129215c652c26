"""Periodic runs, spelling variants and language identification against plain versions."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from driftline.llm import language_codes, periodic_runs, spelling_variants
from driftline.llm.common import mixed

DOC = "doc_id long, text string, runs string, n string, word string, lang string"


def keys(symbols):
    return mixed(np.array(symbols, np.uint64) + np.uint64(7))


def plain_runs(words):
    """Every run, period by period over the whole text; the smallest period names a stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - first + q >= max(12, 2 * q):
                found.setdefault((first - q, i - first + q), q)
            i += i == first
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng):
    n, letters = rng.choice([12, 30, 80, 200]), rng.choice([1, 2, 3])
    kind, out = rng.random(), []
    while len(out) < n:
        if kind < 0.3:
            out.append(rng.randrange(letters))
        elif kind < 0.6:
            out += [rng.randrange(letters) for _ in range(rng.randint(1, 20))] * rng.randint(1, 5)
        else:
            out = out + ([rng.randrange(letters)] if rng.random() < 0.5 else []) + (out or [0])
    return out[:n]


def test_runs_equal_all_periods():
    rng = random.Random(1)
    for _ in range(800):
        words = repetitive(rng)
        assert periodic_runs.find_runs(keys(words)) == plain_runs(words), words


@pytest.mark.parametrize(
    "words, count",
    [([0] * 30_000, 1), ([0, 1] * 15_000, 1), (list(range(15)) * 2_000, 1), (([0] * 300 + [1]) * 20, 21), ([0] * 2_000 + [1] + [0] * 2_000, 2)],
)
def test_repeated_words_stay_cheap(words, count):
    runs = periodic_runs.find_runs(keys(words))
    assert len(runs) == count and runs[0][0] == 0


def digests(doc_id, text):
    """The contract, word for word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    row = (longest[0], longest[1], longest[2], 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *row, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(text))


def test_run_query(spark, frame):
    rng = random.Random(2)
    space = lambda: rng.choice([" ", "\n", " \t", "\x0b", "\r\n"])
    texts = ["".join(f"w{x}é{space()}" for x in repetitive(rng)) for _ in range(60)]
    texts += ["", None, "  \n ", "one", " lead and trail ", "nbsp word " * 15, " ".join(f"u{i}" for i in range(300)), "long " * 30_000]
    rows = [(i, t, "r", "n", "w", None) for i, t in enumerate(texts)] + [(None, texts[0], "", "", "", ""), (3, texts[3], "", "", "", ""), (3, texts[3], "", "", "", "")]
    docs = frame(rows, DOC)
    got = periodic_runs.run_digests(periodic_runs.planted(docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    small = [r for r in rows if len(r[1] or "") < 20_000]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in small)
    want = collections.Counter(digests(r[0], r[1]) for r in small)
    found = collections.Counter(tuple(r) for r in got.collect())
    whole = found - want
    assert want - found == collections.Counter() and [tuple(r)[1:6] for r in whole] == [(1, 0, 30_000, 1, 30_000_000)]
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def plain_variants(rows, change):
    counts = collections.Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            if change and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{word}".encode())
                if h % 31 == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    around = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(around[w]), words[form[w]] if form[w] else None))
    return out


def spelled(rng, letters, length):
    return "".join(rng.choice(letters) for _ in range(length))


def test_variants_equal_all_pairs(spark, frame):
    rng = random.Random(3)
    base = [spelled(rng, "abcdé", rng.randint(6, 9)) for _ in range(60)] + ["common" + "x" * 30, "grundwort"]
    rows = []
    for i in range(300):
        words = rng.choices(base, k=8) + ["Grundwort"] * 3
        if rng.random() < 0.3:
            w = rng.choice(base)
            k = rng.randrange(len(w))
            words += [rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcdeé") + w[k:], w[:k] + "ÿ" + w[k + 1 :]])] * rng.randint(1, 3)
        rows.append((i, rng.choice([" ", "-", "1", "Ω", "日"]).join(words)))
    rows += [(None, "grundwort grundwor grundwor"), (None, None), (7, ""), (7, ""), (8, "GRUNDWORT É× ÷ àààààààà ààààààà àààààààà"), (9, "grundwo grundwo"), (10, "z" * 50_000 + " " + "z" * 49_999), (11, "z" * 50_000 + " " + "z" * 49_999)]
    rows += [(None, "treasure " * 200 + "treasurre " * 20 + "treasurrre " * 2 + "treasurer " * 200)]
    docs = frame([(i, t, "", "", "w", None) for i, t in rows], DOC)
    for change in (True, False):
        got = spelling_variants.variants_of_texts(docs, change)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        want = plain_variants(rows, change)
        assert {tuple(r) for r in got.collect()} == want
        assert any(root not in (word, form) for word, form, root, *_ in want)
    empty = spelling_variants.variants_of_texts(docs.limit(0), True)
    assert empty.count() == 0


@pytest.mark.parametrize("coarse, part_words", [(1, 5), (3, 7), (6, 1000)])
def test_near_words_dealt_over_blocks(spark, frame, coarse, part_words):
    rng = random.Random(coarse)
    words = sorted({spelled(rng, "ab", rng.randint(5, 8)) for _ in range(300)})
    got = spelling_variants.near_words(frame([(w, 1) for w in words], "word string, n long"), coarse, part_words).collect()
    pairs = [tuple(sorted((r.a, r.b))) for r in got]
    want = {(a, b) for a in words for b in words if a < b and spelling_variants.one_edit(a.encode(), b.encode())}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_long_chains_end(frame):
    rows = [(f"w{k}", f"w{k + 1}") for k in range(18)]
    assert {(r.word, r.root) for r in spelling_variants.roots(frame(rows, "word string, form string")).collect()} == {(f"w{k}", "w18") for k in range(18)}


SYLLABLES = {"aa": ["ka", "lo", "mi", "to"], "bb": ["sch", "ung", "ter", "ich"], "cc": ["eau", "ou", "ai", "ré"], "dd": ["ión", "ña", "ros", "do"], "ee": ["wyn", "llo", "gwe", "dd"], "ff": ["ый", "ова", "ста", "не"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("languages", [1, 2, 4, 6])
def test_languages_of_held_out_texts(spark, frame, languages):
    rng = random.Random(languages)
    tongues = list(SYLLABLES)[:languages]
    rows = [(i, prose(rng, tongues[i % languages], rng.choice([3, 20, 60])), "", "", "", tongues[i % languages]) for i in range(240)]
    odd = [(900, None, "", "", "", "aa"), (901, "", "", "", "", "aa"), (902, "12 -- 34 ÷", "", "", "", "aa"), (903, prose(rng, "aa", 20_000), "", "", "", None), (None, prose(rng, "aa", 30), "", "", "", "aa")]
    odd += [rows[5], rows[5]]
    got = language_codes.language_ids(frame(rows + odd, DOC)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    held = [r for r in rows if by_id[r[0]].held_out]
    assert {r[0] for r in held} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1}
    right = sum(by_id[r[0]].lang_pred == r[5] for r in held)
    assert right >= 0.97 * len(held)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0.0 and by_id[i].ambiguous for i in (900, 901, 902))
    assert by_id[903].lang_pred == "aa" and by_id[None].lang_pred == "aa" and not by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got)


def test_language_labels_of_held_out_rows_are_not_read(frame):
    rng = random.Random(9)
    rows = [(i, prose(rng, ("aa", "bb")[i % 2], 40), "", "", "", ("aa", "bb")[i % 2]) for i in range(90)]
    other = [(*r[:5], "zz") if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r for r in rows]
    values = [sorted(map(tuple, language_codes.language_ids(frame(x, DOC)).collect())) for x in (rows, other)]
    assert values[0] == values[1]


def test_mixed_texts_are_flagged(spark, frame):
    rng = random.Random(4)
    rows = [(i, prose(rng, ("aa", "bb", "cc")[i % 3], 60), ("aa", "bb", "cc")[i % 3]) for i in range(90)]
    model = language_codes.train(frame(rows, "doc_id long, text string, lang string").select("text", "lang"))
    halves = [(k, prose(rng, "aa", 50) + " " + prose(rng, "bb", 41 + k)) for k in range(20)]
    flags = [r.ambiguous for r in language_codes.predict(frame(halves, "doc_id long, text string"), model).collect()]
    assert any(flags)
    assert language_codes.train(frame([], "text string, lang string")) is None
    assert {r.lang_pred for r in language_codes.predict(frame(halves, "doc_id long, text string"), None).collect()} == {"und"}


def test_codewords_are_apart():
    for n in (2, 3, 5, 6, 12, 40):
        code = language_codes.codewords(n).astype(int)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= (1 if n == 2 else 2 if n < 5 else 5)
        assert all(len(set(code[:, b])) == 2 for b in range(code.shape[1]))
