"""Stems and the stemmed index."""

from __future__ import annotations

import pytest
from plans import plan_text

from driftline.functions.stemming import with_stems
from driftline.operators.search import StemmedIndex

# Words and stems of the published sample vocabulary, and words for each step.
STEMS = """
consign consign consigned consign consigning consign consignment consign consist consist consisted consist
consistency consist consistent consist consistently consist consisting consist consists consist
consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol
consolidate consolid consolidated consolid consolidating consolid consoling consol consols consol
knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead
kneading knead knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt
knew knew knick knick knif knif knife knife knight knight knightly knight knights knight knit knit knits knit
knitted knit knitting knit knives knive knob knob knobs knob knock knock knocked knock knocker knocker
knockers knocker knocking knock knocks knock knot knot knots knot
license licens licenses licens licensed licens licensing licens caresses caress ties tie cries cri gas gas this this
gaps gap kiwis kiwi hopping hop hoped hope hoping hope luxuriated luxuri sized size agreed agre feed feed
by by say say cry cri happily happili relational relat generalization general generously generous communism communism
arsenal arsenal skies sky dying die news news inning inning innings inning proceed proceed exceeding exceed
national nation vocation vocat adoption adopt hopefulness hope goodness good electricity electr
formalize formal callousness callous decisiveness decis possibly possibl yes yes youth youth enjoy enjoy rate rate roll roll
a a is is sky sky early earli
""".split()


def test_stems(spark):
    words, stems = STEMS[::2], STEMS[1::2]
    rows = spark.createDataFrame([(w, s) for w, s in zip(words, stems, strict=True)] + [(None, None)], "token string, want string")
    got = with_stems(rows).collect()
    assert [(r.token, r.stem) for r in got if r.stem != r.want] == [] and len(got) == len(words) + 1


TEXTS = [
    (1, "The licenses of this work"),
    (2, "A license; works licensed again, and works of licensing."),
    (3, "worked the licensee"),
    (4, None),
    (5, ""),
    (6, "over under license work work is licensed"),
    (7, "license " * 3_000),
]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    out = StemmedIndex(spark, str(tmp_path_factory.mktemp("index")), "doc_id")
    out.write(spark.createDataFrame(TEXTS, "doc_id long, text string"), "text")
    return out


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_any_form_finds_any_form(index):
    assert ids(index.find(["licensing"])) == ids(index.find(["license", "the"])) == [1, 2, 6, 7]
    assert ids(index.find(["WORKING", "licensed"])) == [1, 2, 6]
    assert ids(index.find(["absent", "license"])) == ids(index.find(["the"])) == ids(index.find([])) == []


def test_phrases_meet_at_their_places(index):
    hits = lambda phrase: {r.doc_id: r.hits for r in index.find_phrase(phrase).collect()}
    assert hits("works licensed") == {2: 1}
    assert hits("work of licenses") == {2: 1, 6: 1}
    assert hits("license license license") == {7: 2_998}
    # Stop words hold a place, whatever word stands there.
    assert hits("licenses of this work") == {1: 1, 2: 1}
    assert hits("the of") == hits("") == hits("work absent") == {}


def test_lookup_is_a_filter_on_the_stored_stem(index):
    assert "PushedFilters: [In(stem, [licens,work])]" in plan_text(index.find(["licenses", "works"])).replace("IsNotNull(stem), ", "")
    assert {r.token: r.occurrences for r in index.vocabulary().where("stem = 'licens'").collect()} == {"license": 3_002, "licenses": 1, "licensed": 2, "licensing": 1}


def test_an_empty_table(spark, tmp_path):
    empty = StemmedIndex(spark, str(tmp_path / "i"), "doc_id")
    empty.write(spark.createDataFrame([], "doc_id long, text string"), "text")
    assert empty.find(["license"]).count() == 0 and empty.find_phrase("a license").count() == 0
