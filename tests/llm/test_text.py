"""Operators 2, 9 and 10, and hashes of words."""

import hashlib
import random
import re
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymill.llm import html_text, jaccard, language, personal_data
from tallymill.llm import text as word_text
from tests.conftest import MEDIUM

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    tests = (
        lambda m: True,
        lambda m: all(int(part) <= 255 for part in m.split(".")),
        lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15,
    )
    return [
        (kind, *match.span())
        for kind, (pattern, good) in enumerate(zip(PATTERNS, tests, strict=True))
        for match in re.finditer(pattern, text)
        if good(match[0])
    ]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1.@+- 5(9)0\né", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert personal_data.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 150_000, "(at)" * 80_000):
        list(personal_data.candidates(text, personal_data.base_spans(text)))


def spans_of(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, base int, pattern int")
    return {
        row.doc_id: ([tuple(s) for s in row.base], [tuple(s) for s in row.added])
        for row in personal_data.found_spans(frame).collect()
    }


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(key, f"filler {key} please write to user{key}@mail.example.org for news", 0, 0) for key in range(12)]
    rows += [(20, "so write to someone(at)mail7 for news", 0, 0), (21, "they bought 7000x of it", 0, 0), (22, None, 0, 0), (23, "", 0, 0)]
    found = spans_of(spark, rows)
    assert found[0][0] == [(0, 25, 47)]
    text = rows[12][1]
    assert found[20] == ([], [(0, text.index("someone"), text.index(" for"))])
    assert found[21] == found[22] == found[23] == ([], [])


def test_discovered_identifiers_open_further_contexts(spark):
    """Two hops: addresses in disguise stand where seeds stand, and then in a context without any seed."""
    rows = [(key, f"filler {key} please write to user{key}@mail.example.org for news", 0, 0) for key in range(12)]
    rows += [(20 + key, f"go write to hidden{key}(at)mail{key} for all", 0, 0) for key in range(9)]
    rows += [(30 + key, f"the parcel went care of hidden{key}(at)mail{key} yesterday evening", 0, 0) for key in range(9)]
    rows += [(40, "the parcel went care of late[at]mail99 yesterday evening", 0, 0), (41, "some late[at]mail98 elsewhere", 0, 0)]
    found = spans_of(spark, rows)
    text = rows[-2][1]
    assert found[40] == ([], [(0, text.index("late"), text.index(" yesterday"))])
    assert all(len(found[key][1]) == 1 for at in range(9) for key in (20 + at, 30 + at))
    assert found[41] == ([], [])


def test_discovered_spans_are_whole_and_have_the_form_of_their_kind(spark):
    rows = [(key, f"filler {key} ring me on +49 30 5550{key:03} after nine", 0, 0) for key in range(20)]
    rows += [(30, "now ring me on (030) 555 77 99 after nine", 0, 0), (31, "now ring me on 7 after nine", 0, 0)]
    rows += [(32, "now ring me on joe@home after nine", 0, 0), (33, "now ring me on 4111 1111 1111 1111 22 after nine", 0, 0)]
    found = spans_of(spark, rows)
    assert found[0][0] == [(3, 20, 34)]
    text = rows[20][1]
    assert found[30] == ([], [(3, text.index("(030"), text.index(" after"))])
    assert found[31] == found[32] == found[33] == ([], [])


def test_ordinary_numbers_make_a_context_doubtful(spark):
    rows = [(key, f"filler {key} it is on +49 30 5550{key:03} again", 0, 0) for key in range(6)]
    rows += [(20 + key, f"filler {key} it is on page{key} again", 0, 0) for key in range(6)] + [(40, "so it is on 030 555 77 99 again", 0, 0)]
    assert spans_of(spark, rows)[40] == ([], [])


def test_contexts_of_long_words_are_whole():
    one, other = "x" * 500 + "a", "x" * 500 + "b"
    spans = [personal_data.contexts(f"{word} word 123@5 {word}", 507, 512) for word in (one, other)]
    assert len(spans[0]) == 2 and not set(spans[0]) & set(spans[1])
    assert personal_data.contexts("a@b", 0, 3) == [] and len(personal_data.contexts("to a@b now", 3, 6)) == 1


def test_query_of_personal_data_adds_nothing_false_on_the_given_texts(spark):
    """The given texts hold personal data in random contexts; every span is a base span, told by plain patterns."""
    from tallymill.llm import registry

    texts = dict(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect())
    for row in registry.QUERIES["op2_personal_data"](spark, MEDIUM).collect():
        spans = plain_spans(texts[row.doc_id] or "")
        shown = ",".join(f"{personal_data.KINDS[kind]}:{start}:{end}" for kind, start, end in spans)
        counts = tuple(sum(kind == at for kind, *_ in spans) for at in range(4))
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == counts
        assert row.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert row.spans == shown and row.n_added == 0


def test_spans_of_repeated_rows_and_nothing(spark):
    assert spans_of(spark, []) == {}
    frame = spark.createDataFrame([(1, "a@b.c 10.0.0.1"), (1, "a@b.c 10.0.0.1"), (None, "a@b.c")], "doc_id long, text string")
    found = personal_data.found_spans(frame).collect()
    assert sorted((repr(row.doc_id), len(row.base)) for row in found) == [("1", 2), ("1", 2), ("None", 1)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="page">
<header><a href="/">Site</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><!-- <p>not this</p> -->
<div class="cookie-notice"><p>We use cookies on this site, please read all of our long policy text.</p></div>
{body}
<aside><p>Other things that you could read today if you had the time.</p></aside>
<form><label>Mail</label><input><button>Send</button></form><footer>&copy; Site</footer></body></html>"""
STORY = """<h1>The &quot;title&quot;</h1><p>First   paragraph,<br>with <b>some <i>inline</b> marks.<p>Next &lt;one&gt;.
<div class="ad"><p>Buy this now.</p></div><ul><li>A point</li><li>Another</li></ul><p>Last.</p>"""
EXPECTED = 'The "title" First paragraph, with some inline marks. Next <one>. A point Another Last.'


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{STORY}<section class='comments'><p>Nice one, I agree with all of it!</p></section></article>",
        f"<main>{STORY}<div id='comments'><p>Nice one, I agree with all of it!</p></div></main>",
        f"<div role='main'>{STORY}</div>",
    ],
)
def test_main_text_of_named_content(body):
    assert html_text.main_text(PAGE.format(body=body)) == EXPECTED


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-comments", "content-with-header", "post-share-enabled"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_main_text_inside_wrappers_with_marked_words(name, tag):
    story = "".join(f"<p>{'A long sentence about the matter at hand. ' * 4}</p>" for _ in range(6))
    html = f"<body><div class='site-footer'>About</div><div class='{name}'><{tag}>{story}</{tag}></div><div class='comments-area'><article>I agree</article></div></body>"
    assert html_text.main_text(html) == " ".join(["A long sentence about the matter at hand."] * 24)


def test_main_text_by_ratios_alone():
    story = "".join(f"<p>{'A long sentence about the matter at hand. ' * 4}</p>" for _ in range(6))
    links = "".join(f"<div><a href='/{n}'>Go {n}</a></div>" for n in range(12))
    text = html_text.main_text(f"<html><body>{links}<div>{story}</div>{links}</body></html>")
    assert text == " ".join(["A long sentence about the matter at hand."] * 24)


@pytest.fixture(scope="module")
def given_pages(spark):
    return [row.html for row in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]


UNMARKED = {"<article>": "<div>", "</article>": "</div>", "<nav>": "<div>", "</nav>": "</div>", "<footer>": "<div>", "</footer>": "</div>", '<div class="ad">': "<div>"}


def renamed(html, names):
    for name in names:
        html = html.replace(name, UNMARKED[name])
    return html


def test_main_text_does_not_hang_on_the_article_element(given_pages):
    found = [html_text.main_text(html) for html in given_pages]
    plain = [html_text.main_text(renamed(html, ["<article>", "</article>"])) for html in given_pages]
    assert all(found) and sum(x != y for x, y in zip(found, plain)) <= 0.02 * len(found)


def test_main_text_of_pages_without_marks(given_pages):
    """Menus, adverts and footers as plain blocks: nine in ten pages keep their text."""
    expected = [html_text.main_text(html) for html in given_pages]
    bare = [renamed(html, UNMARKED) for html in given_pages]
    assert sum(html_text.main_text(html) == text for html, text in zip(bare, expected)) >= 0.88 * len(bare)


def test_main_text_of_flat_pages_is_decided_by_ratios(given_pages, monkeypatch):
    """With neither marks nor links nor an element around the article, ratios alone tell a menu from paragraphs."""
    flat = [re.sub("</?article>|<a href=[^>]*>|</a>", "", renamed(html, list(UNMARKED)[2:])) for html in given_pages]
    menus = [" ".join(re.findall("<li>([^<]*)</li>", html)) for html in flat]
    holding = lambda: sum(menu in html_text.main_text(html) for menu, html in zip(menus, flat)) / len(flat)
    assert holding() <= 0.1
    monkeypatch.setattr(html_text, "smoothed_ratios", lambda lines: np.zeros(len(lines)))
    assert holding() >= 0.9


@pytest.mark.parametrize("tag", ["article", "div", "section"])
def test_main_text_keeps_headings_and_short_items(tag):
    sentence = "A long sentence about the matter at hand. " * 7
    parts = [f"<h2>Part {at}</h2><p>{sentence}</p><ul><li>One</li><li>Two</li></ul>" for at in range(10)]
    parts.insert(5, f"<p>{'Very long. ' * 2000}</p>")
    links = "".join(f"<div><a href='/{n}'>Go {n}</a></div>" for n in range(12))
    text = html_text.main_text(f"<body>{links}<{tag}><h1>Title</h1>{''.join(parts)}<p>End.</p></{tag}>{links}</body>")
    blocks = [part for at in range(10) for part in (f"Part {at}", sentence.strip(), "One", "Two")]
    blocks[20:20] = [("Very long. " * 2000).strip()]
    assert text == " ".join(["Title", *blocks, "End."])


@pytest.mark.parametrize(
    "html",
    ["<b>x</i>" * 8000, "<div class='a-menu'>" * 8000 + "x", "<b>" * 8000 + "<p>x" * 8000, "<li><a>" * 8000, "<table><tr><td>" * 5000 + "y"],
)
def test_main_text_takes_linear_time(html):
    started = time.perf_counter()
    html_text.main_text(html)
    assert time.perf_counter() - started < 2


@pytest.mark.parametrize("html", [None, "", "<p>", "<<<>>>", "<script>alert(1)</script>", "<nav>x</nav>", "&#xD800;<p"])
def test_main_text_of_odd_pages(html):
    assert isinstance(html_text.main_text(html), str)


def test_main_text_of_long_pages_is_whole():
    words = " ".join(f"word{at}" for at in range(50_000))
    assert html_text.main_text(f"<body><nav>x</nav><article><p>{words}</article></body>") == words


def test_pages_keep_their_columns(spark):
    rows = [(1, "u", "<article><p>Text</article>", "old"), (1, "u", None, None), (None, None, "", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extracted(frame)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((repr(r.page_id), r.text, r.n_chars) for r in found.collect()) == [("1", "", 0), ("1", "Text", 4), ("None", "", 0)]
    assert html_text.main_texts(frame.limit(0)).count() == 0


def test_language_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    held_out = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"
    model = language.fit(documents.where(f"NOT {held_out}"))
    found = language.predicted(documents.where(held_out), model).collect()
    assert sum(row.lang_pred == row.lang for row in found) >= 0.97 * len(found)
    assert all(0 <= row.score <= 1 for row in found)


def test_language_backs_off_to_parts_of_unseen_words(spark):
    rows = [(at, f"{a}{b}{c}", label) for at, (label, a, b, c) in enumerate([("x", "kra", "ktu", "kos"), ("y", "lem", "ime", "lo")] * 20)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    predictor = language.Predictor(model)
    assert predictor("KRAKTUKOS")[0] == predictor("krakt")[0] == "x"
    assert predictor("lemim")[0] == predictor("imelo limelo")[0] == "y"
    assert predictor("k" * 200_000)[0] == "x"
    assert predictor("123 ²") == predictor(None) == predictor("") == ("und", 0.0)


def test_language_columns_and_nothing(spark):
    rows = [(1, "abc", None, "old"), (1, "abc", None, "old"), (None, None, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    found = language.predicted(frame, language.fit(frame))
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [row.lang_pred for row in found.collect()] == ["und"] * 3
    assert language.predicted(frame.limit(0), language.fit(frame.limit(0))).count() == 0


def test_language_sample_is_bounded(spark):
    draw = random.Random(1)
    rows = [(at, f"w{draw.randrange(9)}", "x") for at in range(4000)]
    counted = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=100)
    assert counted.labels == ["x"]


def test_language_model_is_bounded_by_the_characters_of_its_sample(spark):
    """150,000 different words: the model keeps all words of its sample, and the sample's size is the bound."""
    rows = [(key, " ".join(f"{chr(97 + key % 26)}{chr(97 + key // 26 % 26)}{chr(97 + key // 676)}{chr(97 + at % 26)}{chr(97 + at // 26)}" for at in range(100)), "xy"[key % 2]) for key in range(1500)]
    rows += [(5000, "long " * 400_000, "x"), (5001, "words " * 300_000, "z"), (5001, "words " * 300_000, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(frame, chars=60_000)
    # Texts of 599 characters: of each label as many as reach the bound, the last one not cut.
    sizes = [sum(1 for word, at in model.tables[0].items() if model.rows[at][label] > model.rows[at][1 - label]) for label in (0, 1)]
    assert model.labels == ["x", "y", "z"] and all(100 * 100 <= size <= 102 * 100 for size in sizes)
    # A label of nothing but a text above the bound has that text, and other labels leave it out.
    assert "words" in model.tables[0] and "long" not in model.tables[0]
    again = language.fit(frame.repartition(9), chars=60_000)
    assert again.tables == model.tables and (again.rows == model.rows).all()


def test_words_are_hashed_side_by_side_as_they_are_split(monkeypatch):
    draw = random.Random(4)
    pieces = [b" ", b"  ", b"\t", b"\x0b\x0c\r\n", b"\x1c", b"\x00", b"a", b"B", b"\xc3\x89", b"\xff", b"\xc2\xa0", b"x" * 7, b"y" * 300]
    texts = [b"".join(draw.choices(pieces, k=draw.randrange(40))) for _ in range(300)]
    edges = [b"z" * length for length in (*range(1, 34), 255, 256, 257, 1000)]
    texts += [None, b"", b" \t", b"\x00", b"\x00\x00", *edges, b" ".join(edges), None]
    for portion in (1, 50, 1 << 21):
        monkeypatch.setattr(word_text, "_BYTES_AT_ONCE", portion)
        found = list(word_text.word_hashes(pa.array([b"left out", *texts, b"left out"], pa.binary())[1:-1]))
        known = {}
        for own, hashes in zip(texts, found, strict=True):
            words = own.lower().split() if own else []
            assert len(words) == len(hashes)
            for word, value in zip(words, hashes.tolist()):
                assert known.setdefault(word, value) == value
        assert len(set(known.values())) == len(known) > 100


def test_words_of_a_large_vocabulary_are_not_hashed_one_by_one(monkeypatch):
    """A table of known words, or a call for each, took most of the time of the Jaccard join."""
    asked = []
    monkeypatch.setattr(word_text.xxhash, "xxh3_64_intdigest", lambda word: asked.append(word) or 1)
    texts = pa.array([" ".join(f"word{number}" for number in range(start, start + 500)).encode() for start in range(0, 5000, 500)], pa.binary())
    for function in (jaccard._described, jaccard._windowed(SimpleNamespace(value=np.empty(0, np.uint64)), 75)):
        columns = [pa.array(range(10), pa.int64()), pa.array(range(10), pa.int64()), texts]
        assert sum(map(len, function([pa.record_batch(columns, ["doc_id", "copy", "text"])])))
    assert not asked
