"""Personal data, language identification, HTML."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from prefshare.llm import html_text, langid, pii
from prefshare.llm.catalog import importable

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@hypothesis_settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.+-( )59\n,é0", max_size=60))
@example("a@b.c+d@e.f@g.h")
@example("4111 1111 1111 1111 and 1.2.3.4.5 or 256.1.1.1 +1 (687) 555-2224")
def test_patterns_are_leftmost_matches(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1-" * 100_000):
        pii.base_spans(text)


PERSONAL = "Call +1 (687) 555-2224 or mail dh.46@mail3.example.com from 93.93.204.98, card 4191085147143418."


@pytest.fixture(scope="module")
def field():
    texts = [PERSONAL.replace("46", str(n)) + f" On day {n} we met {n % 7} times." for n in range(10, 60)]
    return pii.Field.fit(texts)


def test_repeated_tokens_get_one_label(field):
    text = PERSONAL + " Later from 93.93.204.98 again, the other card 4191085147143419."
    (base, spans), clean = field.spans([text, "In 1999 we had 12 dogs and 3 cats."])
    assert base == plain_spans(text) and set(base) <= set(spans)
    assert ("card", "4191085147143419") in [(pii.KINDS[k], text[s:e]) for s, k, e in spans]
    assert clean == ([], [])
    assert "93.93" not in pii.redacted(text, spans) and "[CARD]" in pii.redacted(text, spans)


def test_propagation_is_exact_on_a_chain(field):
    """On a tree the beliefs are the marginals; a star of skip edges is one."""
    x = pii._matrix([[0, 1], [0, 5], [0, 20]])
    edges = np.array([(0, 1, 0), (0, 2, 2)])
    labels = range(pii.NONE + 1)
    unary, total = x @ field.unary, np.zeros((3, pii.NONE + 1))
    for a in labels:
        for b in labels:
            for c in labels:
                score = unary[0, a] + unary[1, b] + unary[2, c]
                w = math.exp(score + field.pair[0, a, b] + field.pair[2, a, c])
                total[0, a] += w
                total[1, b] += w
                total[2, c] += w
    expected = total / total.sum(axis=1, keepdims=True)
    assert np.allclose(field.marginals(x, edges), expected, atol=0.02)


def test_personal_data_of_a_table(spark, field):
    importable(spark)
    rows = [(1, PERSONAL, "x"), (1, PERSONAL, "x"), (2, None, "y"), (None, "", "z"), (3, "é 1.2.3.4", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.find_personal_data(docs, field).collect()
    assert len(got) == 5
    for r in got:
        text = {1: PERSONAL, 3: "é 1.2.3.4"}.get(r.doc_id, "")
        base = plain_spans(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
    clean = {(r.doc_id, r.text, r.spans) for r in pii.redact(docs, field).collect()}
    assert (2, None, "y") in clean and (3, "é [IP]", "w") in clean and len(clean) == 4
    flat = pii.fit_field(docs.limit(0))
    assert not flat.unary.any() and flat.spans([PERSONAL])[0][0] == plain_spans(PERSONAL)
    assert pii.find_personal_data(docs.limit(0), flat).count() == 0


ENGLISH = "the house and the garden that was sold with all of the things in there"
GERMAN = "das haus und der garten der mit allen dingen darin verkauft worden ist"
@pytest.fixture(scope="module")
def fitted_field(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return pii.fit_field(docs)


@pytest.mark.parametrize("repeats", [1, 5, 20, 40])
@pytest.mark.parametrize(
    "entity, like, kind",
    [
        ("+1 (687) 555-2224", "6875552224", 3),
        ("dh.46@mail3.example.com", "dh.46@mail3", 0),
        ("+49 30 1234567 89", "301234567", 3),
    ],
)
def test_repeats_of_known_data_are_added(fitted_field, entity, like, kind, repeats):
    """With the field as the query fits it, however often the token stands there."""
    text = f"please call {entity} today. " + f"then some words {like} and more words " * repeats
    ((base, every),) = fitted_field.spans([text])
    assert [k for _, k, _ in base] == [kind]
    added = [s for s in every if s not in base]
    assert [(k, text[a:b]) for a, k, b in added] == [(kind, like)] * repeats


def test_numbers_like_nothing_known_are_left_alone(fitted_field):
    texts = [
        "in 2024 the 12 teams of 6875552224 and 6875552224 played 3 games",
        "order 12345678 came 3 times, order 12345678 went",
        "please call +1 (687) 555-2224 today or 3015550000 or 9876543 in 2024",
        "no digits at all", "",
    ]
    for text, (base, every) in zip(texts, fitted_field.spans(texts), strict=True):
        assert base == every, text


def test_marginals_of_a_small_loopy_field():
    """Close to those of all labellings on a loop of six nodes, equal on a tree, and
    settled where the potentials are strong."""
    rng = np.random.default_rng(5)
    count = pii.NONE + 1
    pair = rng.normal(size=(3, count, count)) * 0.4
    field = pii.Field(np.zeros((len(pii.FEATURES), count)), (pair + pair.transpose(0, 2, 1)) / 2)
    x = np.zeros((6, len(pii.FEATURES)))
    x[:, :6] = np.eye(6)
    field.unary[:6] = rng.normal(size=(6, count))
    tree = [(0, 1, 0), (1, 2, 1), (2, 3, 0), (1, 4, 2), (4, 5, 0)]
    for edges, known, close in (
        (tree, None, 1e-3),
        (tree, [4, 0, 4, 4, 4, 2], 1e-3),
        ([*tree, (3, 5, 2), (0, 4, 2)], None, 0.05),
        ([*tree, (3, 5, 2), (0, 4, 2)], [1, 4, 4, 4, 4, 4], 0.05),
    ):
        want = np.zeros((6, count))
        for labels in np.ndindex(*[count] * 6):
            if known and any(k != pii.NONE and k != y for k, y in zip(known, labels, strict=True)):
                continue
            score = sum(field.unary[i, y] for i, y in enumerate(labels) if not known or known[i] == pii.NONE)
            score += sum(field.pair[t][labels[i], labels[j]] for i, j, t in edges)
            want[range(6), labels] += math.exp(score)
        want /= want.sum(axis=1, keepdims=True)
        given = None if known is None else np.array(known)
        got = field.marginals(x, np.array(edges), given)
        assert np.abs(got - want).max() < close
    field.pair *= -20
    assert np.isfinite(field.marginals(x, np.array([*tree, (3, 5, 2), (0, 4, 2), (0, 3, 1)]))).all()


def test_very_long_documents_are_labelled(fitted_field):
    text = "+1 (687) 555-2224 " + "a 12 6875552224 b " * 20_000
    ((base, every),) = fitted_field.spans([text])
    assert len(base) == 1 and len(every) == 20_001


VOCABULARY = langid.vocabulary_pieces(langid.default_vocabulary())


@pytest.fixture(scope="module")
def model():
    counts = [(k, w, 5) for k, t in (("en", ENGLISH), ("de", GERMAN)) for w in t.split()]
    return langid.Model.fit(counts, VOCABULARY)


def all_segmentations(model, run, k):
    number = {p: i for i, p in enumerate(model.pieces)}

    def likelihood(rest):
        if not rest:
            return 1.0
        total = 0.0
        for n in range(1, len(rest) + 1):
            piece = rest[:n]
            if piece in number:
                total += model.chances[number[piece], k] * likelihood(rest[n:])
            elif n == 1:
                total += langid.UNKNOWN * likelihood(rest[n:])
        return total

    return math.log(likelihood(langid.START + run))


def test_forward_sums_all_segmentations(model):
    scorer = langid.Scorer(model)
    for word in ("the", "haus", "garden", "xyz", "мир", "thehaus"):
        got = scorer._new([word])[0]
        assert got[-2] == len(word)
        assert got[-1] == sum(c in model.alphabet for c in word)
        assert np.allclose(got[:-2], [all_segmentations(model, word, k) for k in range(2)])


def test_probabilities_sum_to_one(model):
    assert model.languages == ("de", "en")
    assert np.allclose(model.chances.sum(axis=0), 1)


def test_long_and_repeated_words(model):
    scorer = langid.Scorer(model)
    texts = pa.array(["the " * 2000, "haus" * 600, "12 34", "", "und"], pa.large_string())
    first = scorer.score(texts)
    assert np.isfinite(first).all() and np.allclose(first, scorer.score(texts))
    names, chance = langid.decide(model, first)
    assert names == ["en", "de", "und", "und", "de"] and ((chance >= 0) & (chance <= 1)).all()


def test_expected_counts_are_those_of_all_segmentations():
    """Also of runs so long that the sums are rescaled."""
    pieces = ["▁", "a", "b", "ab", "ba", "aab", "abababababababababab"]
    trie = langid.Trie(pieces, "▁ab")
    assert trie.longest == 20
    rng = np.random.default_rng(4)
    chances = rng.random((len(pieces) + 1, 2)) * 0.1
    chances[-1] = langid.UNKNOWN

    def segmentations(rest):
        if not rest:
            yield []
        for i, piece in enumerate(pieces):
            if rest.startswith(piece):
                yield from ([i, *more] for more in segmentations(rest[len(piece) :]))
        if rest and rest[0] not in "▁ab":
            yield from ([len(pieces), *more] for more in segmentations(rest[1:]))

    for run in ("▁abab", "▁aabxba", "▁abababababababababab"):
        want = np.zeros_like(chances)
        every = list(segmentations(run))
        weight = np.array([chances[x].prod(axis=0) for x in every])
        for x, w in zip(every, weight / weight.sum(axis=0), strict=True):
            np.add.at(want, x, w)
        got = np.zeros_like(chances)
        ((_, codes),) = trie.codes([run])
        langid._expect(trie, chances, codes, np.ones((1, 2)), got)
        assert np.allclose(got, want)
    got = np.zeros_like(chances)
    ((_, codes),) = trie.codes(["▁" + "abx" * 700])
    langid._expect(trie, chances, codes, np.ones((1, 2)), got)
    length = np.array([1, 1, 1, 2, 2, 3, 20, 1])
    assert np.allclose(length @ got, 2101) and np.allclose(got[-1], 700)


def test_letters_of_large_alphabets_are_told_apart():
    """Two languages that share 2,000 letters of a large script, half for each."""
    vocabulary = [chr(0x4E00 + i) for i in range(2_000)]
    rng = random.Random(6)
    halves = vocabulary[::2], vocabulary[1::2]

    def words(half, n):
        return ["".join(rng.choices(half, k=rng.randint(2, 6))) for _ in range(n)]

    counts = [(name, w, 1) for name, half in zip("xy", halves, strict=True) for w in words(half, 4_000)]
    fitted = langid.Model.fit(counts, vocabulary)
    assert len(fitted.alphabet) == 2_001
    scorer = langid.Scorer(fitted)
    for name, half in zip("xy", halves, strict=True):
        names, _ = langid.decide(fitted, scorer.score(pa.array(words(half, 300), pa.large_string())))
        assert names == [name] * 300


def test_long_runs_are_learned():
    runs = {"xx": "ab" * 100, "yy": "ba" * 50 + "bb" * 50}
    fitted = langid.Model.fit([(k, r, 1) for k, r in runs.items()], ["a", "b", "ab", "ba", "bb"])
    scorer = langid.Scorer(fitted)
    names, chance = langid.decide(fitted, scorer.score(pa.array(list(runs.values()), pa.large_string())))
    assert names == ["xx", "yy"] and (chance > 0.99).all()


def test_texts_in_unknown_letters_have_no_language(model):
    scorer = langid.Scorer(model)
    texts = ["the garden", "мир и труд", "the garden мир и труд да", "日本語日本語 the", "12", ""]
    kept = langid.identified(model, scorer.score(pa.array(texts, pa.large_string())))
    assert kept.tolist() == [True, False, False, False, False, False]


def test_languages_of_a_table(spark):
    importable(spark)
    rows = [(i, (ENGLISH, GERMAN)[i % 2], ("en", "de")[i % 2], "x") for i in range(80)]
    rows += [(100, None, "en", "x"), (101, "123 ...", "de", "x"), (102, "", None, "x"), (None, GERMAN, None, "x"), (1, GERMAN, "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    fitted = langid.fit_model(docs, langid.default_vocabulary())
    got = langid.identify(docs, fitted).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred == ("en", "de")[r.doc_id % 2] and r.score > 0.9
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    kept = langid.keep_identified(docs, fitted)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    nothing = langid.fit_model(docs.limit(0), langid.default_vocabulary())
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.keep_identified(docs, nothing).count() == len(rows) - 3


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><header>Site</header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Next</a></ul></nav>
<div class="ad">Buy these wonderful things today, they are cheap and plenty, and so on and on.</div>
<div class="cookie-notice">We use cookies on this page and on all the other pages of it.</div>
<article><h1>A &amp; B</h1><p><b>First  paragraph with
several words &eacute; in it.<br><p>Short.<p>Second<br>line, also with several words in it.</p>
<aside>Aside words.</aside><form>Name: <input></form><table><tr><td>cell</td></tr></table></article>
<div id="comments"><p>A reader said this, at great length, so that it looks like text, too.</p></div>
<footer>&copy; 2024</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "A & B\nFirst paragraph with several words é in it.\nShort.\n"
        "Second line, also with several words in it.\ncell"
    )


def test_pages_without_marks_need_the_ratios():
    links = "".join(f"<a href='/{i}'>go {i}</a> | " for i in range(30))
    page = f"<body><div>{links}</div><div><p>{'word ' * 60}</p><p>{'more ' * 50}</p></div><div>{links}</div></body>"
    assert html_text.main_text(page) == "\n".join([("word " * 60).strip(), ("more " * 50).strip()])


def test_odd_pages():
    for page, text in (
        ("", ""), ("plain", "plain"), ("<p>a<script>x", "a"), ("<p></p>", ""), ("<script>x</script>", ""),
        ("<article><p>a &am b&nbsp;&#x41;</article>", "a &am b A"), ("</p></div>a<p>b", "a\nb"),
    ):
        assert html_text.main_text(page) == text
    html_text.main_text("<div>" * 3000 + "x" + "<p>" * 3000)


def test_smoothing_and_threshold():
    assert html_text.smoothed([3.0] * 9) == pytest.approx([3.0] * 9)
    assert 1 < html_text.threshold([1, 1, 1, 9, 9]) < 9
    assert html_text.threshold([4.0]) == 4.0


def test_pages_of_a_table(spark):
    importable(spark)
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == [
        (0, "v", 0), (1, "u", len(html_text.main_text(PAGE))), (1, "u", len(html_text.main_text(PAGE))), (2, "", 0),
    ]
    assert all(len(r.text) == r.n_chars for r in got)
    assert html_text.extract_text(pages.limit(0)).count() == 0


LONG = "<p>" + "Some words of the article. " * 12 + "</p>"


@pytest.mark.parametrize("head", ["<head><title>x</title><body>", "<html><head><title>x</title>", "<head><noscript><img src=x>off</noscript><title>x</title><body>", "<head><title>x</title></head><body>"])
def test_head_ends_without_its_tag(head):
    text = html_text.main_text(head + LONG + LONG)
    assert text == "\n".join([re.sub("<.*?>", "", LONG).strip()] * 2)


@pytest.mark.parametrize("wrapper", ["div class='content no-sidebar'", "div id='page' class='has-banner'", "section class='share related'", "app-root class='has-banner'"])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main>{}</main>"])
def test_hinted_wrappers_keep_the_article(wrapper, inner):
    inside = inner.format(LONG + "<div class='share'><p>" + "Share this now. " * 9 + "</p></div>" + LONG)
    page = f"<body><{wrapper}><div class='related'><a>Other</a></div>{inside}</{wrapper.split()[0]}><div><a>About</a> <a>Us</a></div>"
    assert html_text.main_text(page) == "\n".join([re.sub("<.*?>", "", LONG).strip()] * 2)


def test_hinted_articles_beside_the_article_need_the_ratio():
    page = f"<article>{LONG}{LONG}</article><div class='comments'><article><p>I like it</p></article></div>"
    assert html_text.main_text(page) == "\n".join([re.sub("<.*?>", "", LONG).strip()] * 2)
    words = "<p>One <span class='share'>Share</span> two</p>"
    assert html_text.main_text(words) == "One two"


STORY = [f"Paragraph {i} of the story tells at some length what happened in the town that day." for i in range(6)]
REMARK = "I think that this is a very long remark about all that was said above, and I go on and on about it."


def story(more=""):
    return "<article><h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in STORY) + more + "</article>"


REMARKS = "".join(f"<article class='comment'><p>{REMARK} {i}</p></article>" for i in range(4))
BARE = REMARKS.replace(" class='comment'", "")
CARDS = "".join(f"<article><h3><a href='/{i}'>Card {i}</a></h3><p>A short teaser text {i}.</p></article>" for i in range(4))


@pytest.mark.parametrize(
    "body",
    [
        story(REMARKS),
        story(f"<section>{REMARKS}</section>"),
        story(BARE),
        story(f"<section class='comments'>{BARE}</section>"),
        story(f"<div id='comments'>{''.join(f'<div><p>{REMARK}</p></div>' for _ in range(20))}</div>"),
        f"<main>{story()}<div class='comments'>{''.join(f'<div><p>{REMARK}</p></div>' for _ in range(20))}</div></main>",
        f"<main><h1>Title</h1>{''.join(f'<p>{p}</p>' for p in STORY)}"
        f"<div class='comment-list'>{''.join(f'<div><p>{REMARK}</p></div>' for _ in range(20))}</div></main>",
        f"<main>{story()}<section class='related'><h2>Related</h2>{CARDS}</section></main>",
        f"<main>{story()}<div><h2>More</h2>{CARDS}</div></main>",
        f"{story()}<div><h2>More</h2>{CARDS}</div>",
        f"<div class='page comments-open'>{story()}</div>",
        f"<article class='post has-comments'>{story()[9:]}",
        f"<main><div class='content no-sidebar'>{story()}</div></main>",
        f"<article class='outer'>{story()}</article>",
        f"<main><h1>Title</h1><article>{''.join(f'<p>{p}</p>' for p in STORY)}</article>{CARDS}</main>",
    ],
)
def test_comments_and_cards_are_left_out(body):
    page = f"<html><body><nav><a href='/'>Home</a></nav>{body}<footer>End</footer></body></html>"
    assert html_text.main_text(page) == "\n".join(["Title", *STORY])


def test_names_that_hold_everything_are_not_believed():
    page = f"<body><div class='comment-body'>{''.join(f'<p>{p}</p>' for p in STORY)}</div></body>"
    assert html_text.main_text(page) == "\n".join(STORY)


def test_precision_and_recall_on_labelled_pages():
    """Pages put together from parts whose place is known: most of the content is kept, and
    hardly anything else."""
    rng = random.Random(21)
    said = kept = right = 0
    for k in range(60):
        want = [f"Title {k}", *[f"{p} ({k}-{i})" for i, p in enumerate(rng.choices(STORY, k=rng.randint(3, 9)))]]
        inner = f"<h1>{want[0]}</h1>" + "".join(f"<p>{p}</p>" for p in want[1:])
        tag = rng.choice(["article", "article class='post'", "main", "div class='entry'", "div id='content'"])
        inside = tag.startswith("article") and rng.random() < 0.5
        noise = rng.choice(["", f"<section class='comments'>{REMARKS}</section>", f"<div class='comments'><p>{REMARK}</p></div>"])
        inner = f"<{tag}>{inner}{noise if inside else ''}</{tag.split()[0]}>"
        menu = "<ul>" + "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(12)) + "</ul>"
        side = rng.choice(["", f"<div class='related'>{CARDS}</div>", "<aside><p>Subscribe now</p></aside>"])
        wrap = rng.choice(["{}", "<div class='wrap'>{}</div>", "<div class='page no-sidebar'>{}</div>"])
        body = wrap.format(f"<div>{menu}</div>{inner}{'' if inside else noise}{side}")
        got = html_text.main_text(f"<html><head><title>T</title></head><body>{body}</body></html>").split("\n")
        said += len(got)
        kept += len(want)
        right += len(set(got) & set(want))
    assert right / said > 0.97 and right / kept > 0.97
