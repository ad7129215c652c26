"""Operators on single texts against plain versions of the same rules."""

from __future__ import annotations

import collections
import itertools
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from driftline.llm import line_dedup, lm_scoring, packing, piece_transducer, pii_spans, quality_rules, toxicity, url_rules

ODD = [None, "", " ", "\n\n", "é漢字 ß\t", "a" * 20_000, "x y " * 5_000, "<|endoftext|> hi"]


# Personal data -----------------------------------------------------------------------------------------------------


def plain_spans(text):
    out = []
    forms = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and pii_spans.luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
    ]
    for k, (_, form, fits) in enumerate(forms):
        for m in re.finditer(form, text):
            if fits(m.group(), re.sub("[^0-9]", "", m.group())):
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_follow_the_forms():
    rng = random.Random(2)
    bits = ["@", ".", "a", "b-", "9", "12", "255", "300", " ", "-", "+", "(", ")", "4111111111111111", "4242 4242 4242 4242", "x@y.zz", "+1 (555) 123-4567", "1.2.3.4", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii_spans.base_spans(text) == plain_spans(text), text


def test_luhn():
    assert pii_spans.luhn("4111111111111111") and not pii_spans.luhn("4111111111111112")


def pii_docs():
    rng = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna"]
    docs = []
    for i in range(150):
        w = [rng.choice(words) for _ in range(30)]
        w.insert(9, rng.choice([f"joe{i}@mail{i % 7}.example.com", f"10.{i}.7.9", "4111 1111 1111 1111", f"+1 (415) 555-{1000 + i}"]))
        docs.append((i, " ".join(w)))
    return docs


@pytest.fixture(scope="module")
def field():
    field = pii_spans.SpanField()
    field.train(pii_spans.examples_from([t for _, t in pii_docs()]))
    return field


HIDDEN = {
    "email": [
        "joe at mail.example.com", "joe (at) mail dot example dot com", "joe[at]mail.example.com", "joe at mail dot example dot com",
        "joe [at] mail[dot]example[dot]com", "joe(at)mail.example.com", "joe@mail[.]example[.]com", "first.last_77 (at) mail.example.com",
    ],
    "ip": ["10[.]0[.]3[.]4", "10 dot 0 dot 3 dot 4", "10(dot)0(dot)3(dot)4", "192[.]168[.]30[.]14"],
    "card": ["4111.1111.1111.1111", "4111/1111/1111/1111", "4111  1111  1111  1111", "4111_1111_1111_1111"],
    "phone": ["(415) 555-1234", "415-555-1234", "0044 415 555 1234", "415.555.1234", "001 415 555 1234"],
}


@pytest.mark.parametrize("kind", HIDDEN)
def test_field_finds_every_rewritten_form(field, kind):
    for form in HIDDEN[kind]:
        for front, rear in (("lorem sit ", " dolor amet"), ("", ""), ("tempor\n", ", magna"), ("x " * 3000, ".")):
            got = pii_spans.all_spans(front + form + rear, field)
            assert got[0] == [] and got[1] == [(pii_spans.KINDS.index(kind), len(front), len(front) + len(form))], (front[:9], form, rear)


def test_field_leaves_clean_texts(field):
    clean = (
        "on 2024-01-05 at noon", "version 4.0.1 of it", "in 1999, 30 of 45", "key a3f9b2c4d5e6f7a8b9", "no digits here", "number 078-05-1120 is",
        "look at example.com for more", "read more at www.site.org today", "at home. The dog", "at home.The dog", "seen 2024-01-05 10:22:33 by", "isbn 978-3-16-148410-0",
        "order 12345-67890", "born 05/01/2024 10:30", "48.858844, 2.294351", "300[.]400[.]5[.]6", "at " * 2000, "at " + "a" * 20_000,
    )
    for text in clean:
        assert pii_spans.all_spans(text, field)[1] == [], text
    assert pii_spans.masked("mail a@b.cc, +1 (415) 555-1234.", field) == "mail <EMAIL>, <PHONE>."


def plain_marginals(n, segments, scores):
    """By listing every way to cover n tokens with single tokens of no kind and segments of a kind."""
    mass, total = np.zeros(scores.shape), 0.0

    def walk(at, used, weight):
        nonlocal total
        if at == n:
            total += weight
            for k, kind in used:
                mass[k, kind] += weight
            return
        walk(at + 1, used, weight)
        for k, (i, j, _) in enumerate(segments):
            if i == at:
                for kind in range(scores.shape[1]):
                    walk(j, [*used, (k, kind)], weight * math.exp(scores[k, kind]))

    walk(0, [], 1.0)
    return mass / total


@pytest.mark.parametrize("text", ["+1 (415) 555-1234", "10[.]0[.]3[.]4", "a at b.example.cc", "4111.1111.1111.1111 1"])
def test_marginals_equal_all_segmentations(field, text):
    region = next(pii_spans.regions(text))
    segments = pii_spans.lattice(region)
    scores = field._scores(segments)
    assert segments
    assert np.allclose(field.marginals(len(region.tokens), segments, scores), plain_marginals(len(region.tokens), segments, scores))


def test_field_probabilities_sum_to_one_or_less(field):
    region = next(pii_spans.regions("call +1 (415) 555-1234 or 4111 1111 1111 1111 now"))
    segments = pii_spans.lattice(region)
    p = field.marginals(len(region.tokens), segments, field._scores(segments))
    for at in range(len(region.tokens)):
        assert sum(p[k].sum() for k, (i, j, _) in enumerate(segments) if i <= at < j) <= 1 + 1e-9


def test_find_pii_rows(frame):
    docs = [*pii_docs(), *[(1000 + i, t) for i, t in enumerate(ODD)], (None, "x@y.zz"), (5, "x@y.zz"), (5, "x@y.zz")]
    got = pii_spans.find_pii(frame([(i, t, "s") for i, t in docs], "doc_id long, text string, spans string")).collect()
    want = collections.Counter()
    for i, text in docs:
        base = plain_spans(text or "") if len(text or "") < 10_000 else []
        names = ",".join(f"{pii_spans.KINDS[k]}:{s}:{e}" for k, s, e in base)
        want[(i, *[sum(k == n for k, _, _ in base) for n in range(4)], hashlib.sha256(names.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    masked = pii_spans.mask_pii(frame([(1, None, "k"), (2, "x@y.zz", "k")], "doc_id long, text string, kind string", 1)).collect()
    assert [tuple(r) for r in masked] == [(1, None, "k"), (2, "<EMAIL>", "k")]
    assert pii_spans.find_pii(frame([], "doc_id long, text string", 1)).count() == 0


# Quality rules -----------------------------------------------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^ \t-\r]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_quality_base(frame):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab c#d e\n") for _ in range(rng.randint(0, 120))) for _ in range(200)] + ODD + ["a b c d e f a b c d e", "a a a a a a"]
    docs = [(i, t, ["en", None, "xx"][i % 3], "s") for i, t in enumerate(texts)]
    got = quality_rules.quality_rules(frame(docs, "doc_id long, text string, lang string, n_words string")).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in got} == {i: plain_quality(t) for i, t, _, _ in docs}
    assert all(not r.kept for r in got if r.base_failed)
    assert quality_rules.quality_rules(frame([], "doc_id long, text string, lang string", 1)).count() == 0


def test_quality_divergence(frame):
    rng = random.Random(5)
    base = ["the", "of", "and", "to", "in", "is", "that", "for"] + ["".join(rng.choice("etaoinshr") for _ in range(6)) for _ in range(400)]
    docs = [(i, " ".join(rng.choice(base[:8]) if rng.random() < 0.4 else rng.choice(base) for _ in range(200)), "en") for i in range(60)]
    docs.append((100, " ".join("".join(rng.choice("0123456789#") for _ in range(8)) for _ in range(80)), "en"))
    docs.append((101, " ".join(rng.choice(["the", "zz", "yy"]) + rng.choice("qwxkj") * rng.randint(0, 3) for _ in range(300)), "en"))
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(docs, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(60)) and not got[100].kept
    classes = lambda t: [len(re.findall(p, t)) for p in ("[a-z]", "[ \t-\r]", "[A-Z]", r"[.,;:!?'\"()\[\]{}/@=+_~^`\\-]", "[0-9]", "[#*$%&|<>]")]
    rows = [classes(t) + [len(t) - sum(classes(t))] for _, t, _ in docs]
    total = np.sum(rows, axis=0) / np.sum(rows)
    for (i, _, _), row in zip(docs, rows, strict=True):
        p, m = np.array(row) / sum(row), (np.array(row) / sum(row) + total) / 2
        part = lambda x: np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum()  # noqa: E731, B023
        assert math.isclose(got[i].class_distance, math.sqrt((part(p) + part(total)) / 2), rel_tol=1e-9, abs_tol=1e-9)


def test_quality_long_texts_without_common_words(frame):
    rng = random.Random(8)
    rare = ["".join(rng.choice("etaoinshr") for _ in range(6)) for _ in range(400)]
    common = quality_rules.COMMON_WORDS
    clean = lambda lang, n: " ".join(rng.choice(common[lang]).title() + "," if rng.random() < 0.3 else rng.choice(rare) for _ in range(n))
    docs = [(i, clean("en" if i % 2 else "de", 60 + 10 * i), "en" if i % 2 else "de") for i in range(60)]
    docs += [(100, clean("en", 300), None), (101, clean("de", 300), None)]
    docs += [(k, " ".join(rng.choice(rare) for _ in range(300)), lang) for k, lang in ((200, "en"), (201, "DE"), (202, None))]
    docs.append((203, clean("de", 300), "en"))
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(docs, "doc_id long, text string, lang string")).collect()}
    assert {i for i in got if got[i].kept} == {i for i in got if i < 200}


# Toxicity ----------------------------------------------------------------------------------------------------------


def toxic_docs(n=900):
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(300)]
    bad = ["wretch", "dolt", "knave"] + ["scu" + rng.choice("abc") + rng.choice("xyz") for _ in range(30)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(40)]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(40)] = rng.choice(bad) + rng.choice(["", ",", "."])
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(frame):
    docs, labels = toxic_docs()
    docs += [(10_000 + k, t) for k, t in enumerate(ODD)] + [(None, "dolt"), (3, docs[3][1])]
    got = toxicity.toxicity(
        frame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, score double"),
        frame([*labels, (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int"),
    ).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    known = [r for r in held if r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in known) >= 0.95 * len(known)
    assert all(r.predicted == 0 for r in got if r.doc_id and r.doc_id >= 10_000)


def test_toxicity_without_labels(frame):
    got = toxicity.toxicity(frame([(1, "a")], "doc_id long, text string", 1), frame([], "doc_id long, quality int, toxic int", 1)).collect()
    assert got[0].predicted == 0


def test_held_out_labels_are_never_learnt_from(frame):
    docs, labels = toxic_docs(300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    table = frame(docs, "doc_id long, text string")
    a, b = (toxicity.toxicity(table, frame(x, "doc_id long, quality int, toxic int")).collect() for x in (labels, turned))
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}


def test_label_model_finds_good_voters_and_shares_copies():
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.3
    good = np.where(rng.random((3000, 4)) < 0.8, np.where(y, 1, 0)[:, None], 0)
    poor = (rng.random((3000, 1)) < 0.05).astype(int)
    votes = np.concatenate([good, good[:, :1], poor], axis=1)
    model = toxicity.LabelModel(votes, np.ones(3000), 0.3)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert model.weight[0] < 0.7 and model.rates[0][0][1] > 3 * model.rates[1][0][1]


# URLs --------------------------------------------------------------------------------------------------------------


def plain_url(url):
    head, mark, rest = (url or "").partition("://")
    rest = rest if mark else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_rules.STATED if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_urls(frame):
    urls = [None, "", "no scheme", "http://", "://x.org/", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12?a#b", "http://xexample.org/en/1", "http://org/x", "http://org", "ftp://a.com/fr/?q", "http://a.com:80/de/", "http://b.com/de/#x", "http://a.com/fr", "http://É.com/de/é", "a://b://c.org/d"]
    farm = range(1000, 1300)
    urls += [f"http://w{i % 3}.farm.example.net/en/{i}" for i in farm] + [f"http://n{i % 4}.good.example.net/en/{i}" for i in range(2000, 2300)]
    urls += [f"http://w1.farm.example.net/fr/{i}" for i in range(5000, 5010)]  # unlabelled
    labels = [(i, 0, 0) for i in farm] + [(i, 1, 0) for i in range(2000, 2300)] + [(None, 0, 1), (2001, None, None), (2002, 1, 0)]
    label_rows = frame(labels, "doc_id long, quality int, toxic int", 2)
    pages = frame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None), (1, urls[1], "x")], "page_id long, url string, host string")
    got = url_rules.judge_urls(pages, label_rows).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, rule, verdict = plain_url(urls[r.page_id]) if r.page_id is not None else ("", "", None, None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if ".farm." in host else "allow")), r
    assert {r.mined_rule for r in got if ".farm." in r.host} == {"label:farm"}
    # Without labels nothing is mined: stated verdicts stay with their hosts and paths.
    for none in (None, label_rows.limit(0)):
        bare = url_rules.judge_urls(pages, none).collect()
        assert len(bare) == len(got) and {r.verdict for r in bare if r.rule is None} == {"allow"} and {r.mined_rule for r in bare} == {None}
    assert url_rules.judge_urls(frame([], "page_id long, url string", 1), label_rows).count() == 0


def all_rules(rows, least, confidence):
    """Every sure rule that no shorter one covers, by counting all sets of tokens."""
    whole, marked = collections.Counter(), collections.Counter()
    for tokens, label in rows:
        for size in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), size):
                whole[part] += 1
                marked[part, label] += 1
    sure = {k: n / whole[k[0]] for k, n in marked.items() if n >= least and n / whole[k[0]] >= confidence}
    return {k for k, c in sure.items() if not any(set(o) < set(k[0]) and v == k[1] and oc >= c for (o, v), oc in sure.items())}


@pytest.mark.parametrize("confidence", [0.9, 0.7])
def test_every_sure_rule_is_mined_whatever_its_length(frame, confidence):
    rng = random.Random(8)
    rows = []
    for _ in range(900):
        tokens = {t for t in "abcde" if rng.random() < 0.7}
        rows.append((sorted(tokens | {"f"}), "block" if set("abcde") <= tokens else "allow"))
    rules = url_rules.mine_rules(frame(rows, "tokens array<string>, label string"), min_support=url_rules.MIN_ROWS / 900, min_confidence=confidence).collect()
    assert {(tuple(r.tokens), r.verdict) for r in rules} == all_rules(rows, url_rules.MIN_ROWS, confidence)
    assert ["a", "b", "c", "d", "e"] in [r.tokens for r in rules if r.verdict == "block"] or confidence < 0.9


def test_tokens_of_the_same_rows_are_one(frame):
    """Twenty names that always occur together would be a million frequent sets."""
    names = [f"n{i:02}" for i in range(20)]
    rows = [(sorted([*names, "x"]), "block")] * 40 + [(["x", "y"], "allow")] * 60
    rules = url_rules.mine_rules(frame(rows, "tokens array<string>, label string")).collect()
    assert {(tuple(r.tokens), r.verdict) for r in rules} == {(("n00",), "block"), (("y",), "allow")}


def test_mined_rules_against_counting(frame):
    rng = random.Random(6)
    rows = []
    for _ in range(600):
        tokens = sorted({rng.choice("abcdef") for _ in range(3)})
        bad = "a" in tokens and "b" in tokens
        rows.append((tokens, "block" if bad else "allow"))
    rules = url_rules.mine_rules(frame(rows, "tokens array<string>, label string"), min_support=0.02).collect()
    for r in rules:
        inside = [label for tokens, label in rows if set(r.tokens) <= set(tokens)]
        assert r.support == inside.count(r.verdict) >= url_rules.MIN_ROWS and math.isclose(r.confidence, r.support / len(inside)) and r.confidence >= 0.9
    assert ["a", "b"] in [r.tokens for r in rules if r.verdict == "block"]
    sets = frame([(["a", "b", "c"],), (["c"],), (["z"],)], "tokens array<string>")
    got = {tuple(r.tokens): r.mined_verdict for r in url_rules.match_rules(sets, frame([(r.tokens, r.verdict, r.confidence, r.support, r.rule_id, r.rarest) for r in rules], "tokens array<string>, verdict string, confidence double, support long, rule_id string, rarest string")).collect()}
    assert got[("a", "b", "c")] == "block" and got[("c",)] == "allow" and ("z",) not in got


# Packing -----------------------------------------------------------------------------------------------------------


def _fake():
    def tokens():  # a local function travels to the workers by value
        return lambda text: np.append(np.frombuffer(text.encode(), np.uint8).astype("<u4") + 1, 0).astype("<u4")

    return tokens


fake_tokens = _fake()


@pytest.mark.parametrize("length", [16, 64])
def test_packing_keeps_every_id_once(frame, length):
    rng = random.Random(length)
    docs = [(i, "ab" * rng.randint(0, 60)) for i in range(300)] + [(1000 + k, t if k != 5 else "q" * 900) for k, t in enumerate(ODD)]
    pieces = packing.pack(frame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int", 5), fake_tokens, length, 4).collect()
    ids_of, ids = fake_tokens(), {}
    for i, text in docs:
        ids[i] = ids_of(text or "")
    cover, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id][p.start : p.start + p.length]
        assert p.length == len(own) > 0 and zlib.crc32(own.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        cover[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for i in ids:
        at = 0
        for start, size in sorted(cover[i]):
            assert start == at
            at += size
        assert at == len(ids[i])
    rest = []
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length and at & (at - 1) == 0
        rest += [at] if at < length else []
    assert sum(rest) < length  # one merge group leaves less than one window


def test_packing_edges(frame):
    docs = [(None, "abc"), (None, "abc"), (3, None)]
    got = packing.pack(frame(docs, "doc_id long, text string"), fake_tokens, 16, 4).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in got if r.start == 0) == [(-1, 4), (-1, 4), (3, 1)]
    assert packing.pack(frame([], "doc_id long, text string", 1), fake_tokens).count() == 0


def test_sequences_hold_the_real_ids(frame):
    docs = frame([(i, "xyz" * i) for i in range(40)], "doc_id long, text string")
    rows = packing.sequences(docs, packing.pack(docs, fake_tokens, 32, 3), fake_tokens).collect()
    want = collections.Counter(np.concatenate([fake_tokens()("xyz" * i) for i in range(40)]).tolist())
    assert collections.Counter(x for r in rows for x in r.ids) == want


def test_fast_ids_are_the_defining_ids():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.public_tokens()
    rng = random.Random(9)
    texts = [t or "" for t in ODD if len(t or "") < 9000] + ["".join(rng.choice("ab 's're\n\t 12é漢—<|endoftext|>\u00a0\u2028") for _ in range(60)) for _ in range(500)]
    for text in texts:
        assert fast(text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, 0]


# Language model ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("max_entries", [10**6, 12])
def test_lm_base_scores(frame, max_entries):
    rng = random.Random(7)
    words = ["w" + str(int(rng.paretovariate(0.6)) % 500) for _ in range(4000)]
    docs = [(i, " ".join(words[rng.randrange(3900) :][: rng.randint(0, 40)])) for i in range(120)]
    docs += [(500 + k, t) for k, t in enumerate(ODD)] + [(None, "w1 w2"), (7, docs[7][1]), (8, docs[8][1])]
    train = [d for d in docs if d[0] is None or d[0] % 3]
    schema = "doc_id long, text string, row long"
    got = lm_scoring.lm_scores(frame([(*d, 1) for d in docs], schema), frame([(*d, 1) for d in train], schema), max_entries).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b" "]
    c = collections.Counter(w for _, t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in docs:
        w = tokens(t)
        want[i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


@pytest.mark.parametrize(("max_entries", "slice_bits", "part_bytes"), [(1_000_000, 1 << 25, 1 << 27), (40, 1 << 25, 1 << 27), (40, 1 << 10, 256)])
def test_lm_model_is_a_plain_pair_model(frame, max_entries, slice_bits, part_bytes):
    """Counts of one or two are exact in their level up to the geometric middle, so the plain model uses the levels' counts."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[min(int(rng.expovariate(0.12)), 59)] for _ in range(rng.randint(0, 25)))) for i in range(150)]
    docs += [(200, None), (201, "zz w1 w2 zz w1"), (201, "zz w1 w2 zz w1"), (None, "w3")]
    train = [d for d in docs if d[0] is None or d[0] % 4]
    got = lm_scoring.lm_scores(frame(docs, "doc_id long, text string"), frame(train, "doc_id long, text string"), max_entries, slice_bits, part_bytes).collect()
    tokens = lambda t: [*(t or "").encode().split(), b" "]
    c, pairs = collections.Counter(), collections.Counter()
    for _, t in train:
        c.update(tokens(t))
        pairs.update(itertools.pairwise(tokens(t)))
    n, v = sum(c.values()), len(c)
    least = max(1, -(-n // max_entries))
    level = lambda k: float(lm_scoring.level_count(lm_scoring.quantised(np.array([k])))[0])
    count = lambda w: level(c[w]) if c[w] >= least else c[w]
    d = lm_scoring.DISCOUNT

    def score(text):
        own = tokens(text)
        out = math.log10((count(own[0]) + 1) / (n + v + 1))
        for h, w in itertools.pairwise(own):
            share = min(level(pairs[h, w]) / count(h), 1.0) if pairs[h, w] >= lm_scoring.MIN_PAIR else 0.0
            out += math.log10(d * (count(w) + 1) / (n + v + 1) + (1 - d) * share)
        return out

    plain = sorted((str(i), score(t)) for i, t in docs)
    found = sorted((str(r.doc_id), r.score) for r in got)
    off = [(p, f) for p, f in zip(plain, found, strict=True) if p[0] != f[0] or abs(p[1] - f[1]) > 1e-6]
    assert len(off) <= len(plain) // 10  # a false level of the filter raises a score here and there
    assert all(f[1] > p[1] for p, f in off)


def test_lm_keeps_every_repeated_pair_at_every_size(frame):
    for times in (1, 40):
        texts = [(i, f"a{i % 50} b{i % 50} " * 2 * times) for i in range(50)]
        scores = lm_scoring.lm_scores(frame(texts, "doc_id long, text string"), frame(texts, "doc_id long, text string"), max_entries=20).collect()
        for r in scores:  # every pair occurs twice or more, so each of its words gains
            assert r.score > r.base_score + r.n_tokens * 0.3


def test_lm_without_training(frame):
    got = lm_scoring.lm_scores(frame([(1, "a b")], "doc_id long, text string", 1), frame([], "doc_id long, text string", 1)).collect()
    assert (got[0].n_tokens, got[0].n_known, got[0].train_tokens, got[0].base_score) == (3, 0, 0, 0.0)


def test_bloom_levels_never_fall_short():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    counts = np.floor(rng.pareto(0.7, 5000) * 10 + 1)
    bloom = lm_scoring.LogFrequencyBloom(keys, counts)
    level = bloom.level(keys)
    assert (level >= lm_scoring.quantised(counts)).all() and (level == lm_scoring.quantised(counts)).mean() > 0.98
    assert (bloom.level(rng.integers(0, 2**63, 20000).astype(np.uint64)) == 0).mean() > 0.98


# Lines -------------------------------------------------------------------------------------------------------------


def test_lines(frame):
    rng = random.Random(4)
    docs = []
    for i in range(300):
        host = ["a", "a", "b", None][i % 4]
        lines = [f"own {i} {k}" for k in range(3)]
        if i % 3 == 0:
            lines.insert(1, " menu ")
        if rng.random() < 0.05:
            lines.append("rare")
        docs.append((i, "\n".join([*lines, "", lines[0]]), host))
    docs += [(900, None, "a"), (901, "", "a"), (902, "menu", "a"), (903, "menu", "tiny"), (902, "menu", "a")]
    table = frame([(*d, "gone", 3) for d in docs], "doc_id long, text string, source string, lines string, n_lines int")
    got = line_dedup.drop_boilerplate(table, host="source", max_ratio=0.2, min_pages=20).collect()
    core = lambda t: {x.strip() for x in (t or "").split("\n") if x.strip()}
    pages, totals = collections.Counter(), collections.Counter(h for _, _, h in docs)
    for _, t, h in docs:
        pages.update((h, x) for x in core(t))
    want = collections.Counter()
    for i, t, h in docs:
        full = [x for x in (t or "").split("\n") if x.strip()]
        drop = {x for x in core(t) if totals[h] >= 20 and pages[h, x] > 0.2 * totals[h]}
        clean = None if t is None else "\n".join(x for x in t.split("\n") if x.strip() not in drop or not x.strip())
        want[i, clean, h, "gone", len(full), sum(x.strip() in drop for x in full)] += 1
    assert collections.Counter((r.doc_id, r.text, r.source, r.lines, r.n_lines, r.n_dropped) for r in got) == want
    spared = line_dedup.drop_boilerplate(table, host="source", max_ratio=0.2, min_pages=20, spare_copies=True)
    assert [r.text for r in spared.where("doc_id = 902").collect()] == ["menu", "menu"]
    assert line_dedup.drop_boilerplate(frame([], "text string, source string", 1), host="source").count() == 0


# Pieces ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    pytest.importorskip("public_tokenizers")
    return piece_transducer.public_model()


def test_pieces_equal_the_merges_of_the_vocabulary(model):
    import sentencepiece

    other, own = sentencepiece.SentencePieceProcessor(model_file=model), piece_transducer.Transducer(model)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aaabbcdetheri onst  \n\t▁éß①漢1230.,-<>\x00") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for text in [*texts, " " * 50, "a" + " " * 33 + "b", "e" * 2000]:
        assert own.encode(text).tolist() == other.encode(text)
        assert own.decode(own.encode(text)) == text.replace("▁", " ")


def test_unigram_path_is_the_cheapest(model):
    own = piece_transducer.Transducer(model)
    own.merging, own.ids = False, {"a": 0, "b": 1, "ab": 2, "abc": 3, "c": 4}
    own.scores, own.states, own.unknown_score = [-1.0, -1.0, -1.5, -9.0, -2.0], dict(own.ids), -20.0
    assert own.shortest_path("abc") == ["ab", "c"] and own.shortest_path("axb") == ["a", "x", "b"]


def test_piece_rows(frame, model):
    docs = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "a b", 1), (2, "a b", 1), (2, "a b", 1)]
    table = frame(docs, "doc_id long, text string, ids int")
    rows = piece_transducer.round_trip(table).collect()
    assert len(rows) == len(docs) and all(r.exact for r in rows)
    encoded = piece_transducer.encode(table)
    texts = collections.Counter((r.doc_id, r.text) for r in piece_transducer.decode(encoded).collect())
    assert texts == collections.Counter((i, t or "") for i, t, _ in docs)
    assert piece_transducer.decode(frame([(1, None)], "doc_id long, ids array<int>", 1)).first().text is None
    assert piece_transducer.encode(frame([], "doc_id long, text string", 1)).count() == 0


def test_only_whole_copies_are_spared(frame):
    lines = ["menu of the site", "we use cookies", "all rights reserved", "contact us"]
    rows = [(i, f"{lines[i % 4]}\nown words of page {i}") for i in range(40)]
    mixed = [(100, f"{lines[0]}\n {lines[1]}\n{lines[2]}"), (101, f"{lines[2]}\n\n{lines[3]}"), (102, "license text\nsecond line")]
    copies = [(200 + i, "license text\n second line ") for i in range(9)]
    docs = frame([(i, t, "h") for i, t in rows + mixed + copies], "doc_id long, text string, source string")
    by_id = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, host="source", spare_copies=True).collect()}
    assert by_id[100].text.strip() == "" and by_id[101].text.strip() == "" and by_id[5].text == "own words of page 5"
    assert all(by_id[i].n_dropped == 0 and "license text" in by_id[i].text for i in (102, *range(200, 209)))
    plain = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, host="source").collect()}
    assert plain[200].text.strip() == "" and plain[100].n_dropped == 3


def test_merge_path_tries_few_pairs(model):
    """The path that merging gives, found without judging every arc of the lattice."""
    own, rng = piece_transducer.Transducer(model), random.Random(5)
    words = ["▁" + "".join(rng.choice("aeinrstthé한\U0001f600x") for _ in range(rng.randint(1, 14))) for _ in range(1500)] + ["▁" * 40, "x" * 300, "▁the", "é"]
    assert all(own.shortest_path(w) == own.merged(w) for w in words)
    arcs = sum(own.states.get(w[i:k], -1) >= 0 for w in words for i in range(len(w)) for k in range(i + 1, min(len(w), i + 16) + 1))
    tried = piece_transducer.Transducer(model)
    pairs = [0]
    tried._fits = type("Counted", (dict,), {"__missing__": lambda self, key: pairs.__setitem__(0, pairs[0] + 1) or own._fits[key]})()
    assert all(tried.shortest_path(w) for w in words) and pairs[0] < arcs / 2
