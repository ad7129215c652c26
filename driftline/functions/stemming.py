"""English stems by suffix rules, as SQL expressions.

The rules are those of the published "English" (Porter 2) algorithm. Each step is one expression over the columns ``w`` (the
word so far), ``r1`` and ``r2`` (where its two regions begin) and, for one step, ``cut``. The expressions use only LIKE,
left, substr, length, replace and regexp_extract, so they run in any engine that has those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words with a stem of their own, and words left as they are.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
}
INVARIANT = "sky news howe atlas cosmos bias andes".split()
INVARIANT_WITHOUT_S = "inning outing canning herring earring proceed exceed succeed".split()
# Beginnings after which the first region starts.
LONG_BEGINNINGS = "gener commun arsen".split()
# Suffixes of the steps and what replaces them.
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
    "ative": "",
}
STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
DOUBLES = "bb dd ff gg mm nn pp rr tt".split()
LI_LETTERS = "cdeghkmnrt"

_VOWELS = "aeiouy"
_SHORT_SYLLABLE = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"


def _found(text: str, pattern: str) -> str:
    return f"regexp_extract({text}, '{pattern}', 0) <> ''"


def _ends(suffix: str) -> str:
    return f"w LIKE '%{suffix}'"


def _without(suffix: str, new: str = "") -> str:
    cut = f"left(w, CAST(length(w) - {len(suffix)} AS INT))"
    return f"concat({cut}, '{new}')" if new else cut


def _inside(suffix: str, region: str) -> str:
    return f"length(w) - {len(suffix)} >= {region}"


def _longest(rules: dict[str, str]) -> str:
    """CASE over suffixes, the longest first; each maps to the expression used when it is the one found."""
    branches = " ".join(f"WHEN {_ends(s)} THEN {rules[s]}" for s in sorted(rules, key=lambda s: (-len(s), s)))
    return f"CASE {branches} ELSE w END"


def _if(condition: str, then: str, otherwise: str = "w") -> str:
    return f"CASE WHEN {condition} THEN {then} ELSE {otherwise} END"


def _stem_part(suffix: str) -> str:
    return f"left(w, CAST(length(w) - {len(suffix)} AS INT))"


def _marked() -> str:
    """Y for a consonant y: at the start of the word and after a vowel."""
    text = "CASE WHEN token LIKE 'y%' THEN concat('Y', substr(token, 2)) ELSE token END"
    for vowel in _VOWELS:
        text = f"replace({text}, '{vowel}y', '{vowel}Y')"
    return text


def _region(start: str, text: str) -> str:
    """Where a region begins: behind the first consonant that follows a vowel; the word's end if there is none."""
    head = f"regexp_extract({text}, '^[^aeiouy]*[aeiouy]+[^aeiouy]', 0)"
    return f"CASE WHEN {head} <> '' THEN {start} + length({head}) ELSE length(w) END"


def _first_region() -> str:
    branches = " ".join(f"WHEN w LIKE '{b}%' THEN {len(b)}" for b in LONG_BEGINNINGS)
    return f"CASE {branches} ELSE {_region('0', 'w')} END"


def _step_1a() -> str:
    ie = {s: _if("length(w) > 4", _without(s, "i"), _without(s, "ie")) for s in ("ied", "ies")}
    plural = _if(_found(_stem_part("s"), "[aeiouy].+$"), _without("s"))
    return _longest({"sses": _without("sses", "ss"), **ie, "us": "w", "ss": "w", "s": plural})


def _cut_1b() -> str:
    """The suffix of step 1b that goes because a vowel precedes it; empty if none does."""
    both = {s: _if(_found(_stem_part(s), "[aeiouy]"), f"'{s}'", "''") for s in ("ed", "edly", "ing", "ingly")}
    both |= {s: "''" for s in ("eed", "eedly")}
    branches = " ".join(f"WHEN {_ends(s)} THEN {both[s]}" for s in sorted(both, key=lambda s: (-len(s), s)))
    return f"CASE {branches} ELSE '' END"


def _step_1b() -> str:
    kept = _longest({s: _if(_inside(s, "r1"), _without(s, "ee")) for s in ("eed", "eedly")})
    return f"CASE WHEN cut <> '' THEN left(w, CAST(length(w) - length(cut) AS INT)) ELSE {kept} END"


def _mended_1b() -> str:
    end_e = " OR ".join(_ends(s) for s in ("at", "bl", "iz"))
    double = " OR ".join(_ends(s) for s in DOUBLES)
    short = f"length(w) <= r1 AND {_found('w', _SHORT_SYLLABLE)}"
    mended = f"CASE WHEN {end_e} THEN concat(w, 'e') WHEN {double} THEN {_without('x')} WHEN {short} THEN concat(w, 'e') ELSE w END"
    return _if("cut <> ''", mended)


def _step_1c() -> str:
    return _if(_found("w", "^.+[^aeiouy][yY]$"), _without("y", "i"))


def _step_2() -> str:
    rules = {s: _if(_inside(s, "r1"), _without(s, new)) for s, new in STEP_2.items()}
    rules["ogi"] = _if(f"{_inside('ogi', 'r1')} AND w LIKE '%logi'", _without("i"))
    rules["li"] = _if(f"{_inside('li', 'r1')} AND {_found('w', f'[{LI_LETTERS}]li$')}", _without("li"))
    return _longest(rules)


def _step_3() -> str:
    rules = {s: _if(_inside(s, "r1"), _without(s, new)) for s, new in STEP_3.items()}
    rules["ative"] = _if(f"{_inside('ative', 'r1')} AND {_inside('ative', 'r2')}", _without("ative"))
    return _longest(rules)


def _step_4() -> str:
    rules = {s: _if(_inside(s, "r2"), _without(s)) for s in STEP_4}
    rules["ion"] = _if(f"{_inside('ion', 'r2')} AND {_found('w', '[st]ion$')}", _without("ion"))
    return _longest(rules)


def _step_5() -> str:
    before = _stem_part("e")
    off_e = f"{_inside('e', 'r2')} OR ({_inside('e', 'r1')} AND NOT ({_found(before, _SHORT_SYLLABLE)}))"
    return _longest({"e": _if(off_e, _without("e")), "l": _if(f"{_inside('l', 'r2')} AND w LIKE '%ll'", _without("l"))})


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _outcome() -> str:
    special = " ".join(f"WHEN token = '{w}' THEN '{stem}'" for w, stem in IRREGULAR.items())
    fixed = f"WHEN length(token) <= 2 OR token IN ({_quoted(INVARIANT)}) THEN token"
    return f"CASE {special} {fixed} WHEN whole IN ({_quoted(INVARIANT_WITHOUT_S)}) THEN whole ELSE lower(w) END"


#: Columns that each step sets, in order.
STEPS: tuple[dict[str, str], ...] = (
    {"w": _marked()},
    {"r1": _first_region()},
    {"r2": _region("r1", "substr(w, CAST(r1 + 1 AS INT))")},
    {"w": _step_1a()},
    {"whole": "w", "cut": _cut_1b()},
    {"w": _step_1b()},
    {"w": _mended_1b()},
    {"w": _step_1c()},
    {"w": _step_2()},
    {"w": _step_3()},
    {"w": _step_4()},
    {"w": _step_5()},
    {"stem": _outcome()},
)
_INNER = ("w", "r1", "r2", "whole", "cut")


def with_stems(words: DataFrame, token: str = "token", stem: str = "stem") -> DataFrame:
    """``words`` with the stem of each lower-case word; meant for a vocabulary, one row per word. A null has a null stem."""
    rows = words.select(F.struct("*").alias("row"), F.col(token).alias("token"))
    for step in STEPS:
        rows = rows.withColumns({name: F.expr(text) for name, text in step.items()})
    return rows.select("row.*", F.col("stem").alias(stem))


def stem_sql(source: str) -> str:
    """A query that adds ``stem`` to the rows of ``source``, a query or table with a column ``token``."""
    text = f"SELECT * FROM {source}"
    known: set[str] = set()
    for step in STEPS:
        kept = f" EXCLUDE ({', '.join(sorted(known & set(step)))})" if known & set(step) else ""
        columns = ", ".join(f"{expression} AS {name}" for name, expression in step.items())
        text = f"SELECT *{kept}, {columns} FROM ({text})"
        known |= set(step)
    return f"SELECT * EXCLUDE ({', '.join(_INNER)}) FROM ({text})"
