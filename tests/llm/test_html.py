"""Main text of pages in layouts that training has not seen, and the field against enumeration."""

import itertools
import math
import random

import pytest

from gridloom.llm import html_text

SCHEMA = "page_id long, url string, html string, text string"
WORDS = "ran sol mek tir ova lun pes dar kol vin".split()


def sentence(dice):
    return " ".join(dice.choices(WORDS, k=dice.randrange(5, 25))).capitalize() + "."


def page(dice, number):
    body = [f"Title {number} &amp; more"] + [sentence(dice) for _ in range(dice.randrange(3, 9))] + ["Short."]
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:5])
    return (f"<!DOCTYPE html><html><head><title>Title</title><script>var a = '</p>';</script></head><body><nav><ul>{links}</ul>"
            f'</nav><div class="ad">{sentence(dice)}</div><article><h1>{body[0]}</h1>' + "".join(f"<p>{b}</p>" for b in body[1:])
            + f"</article><footer>&copy; x</footer></body></html>"), " ".join(body).replace("&amp;", "&")


@pytest.fixture(scope="module")
def pages():
    dice = random.Random(6)
    return [page(dice, i) for i in range(120)]


ODD = [
    (None, ""), ("", ""), ("<<<>>>", None), ("<p", None), ("<!-- only a comment", ""), ("<script>x</script>", ""),
    ("<article><p>Fo<b>o</b> bar&nbsp;\n &eacute;&#233;<br>baz <!-- c --> &lt;b&gt;<p>Next one is here.</article>",
     "Foo bar éé baz <b> Next one is here."),
]


@pytest.fixture(scope="module")
def found(spark, pages):
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(pages)] + [(1000 + i, None, h, "x") for i, (h, _) in enumerate(ODD)]
    df = spark.createDataFrame(rows + [rows[0]], SCHEMA).repartition(3)
    field = html_text.learn(df)
    return field, html_text.extract(df, field).collect()


def test_pages(found, pages):
    got = [r for r in found[1] if r.page_id < 1000]
    assert len(got) == len(pages) + 1
    assert all(r.text == pages[r.page_id][1] and r.n_chars == len(r.text) and r.url == f"u{r.page_id}" for r in got)


def test_odd_pages(found):
    got = {r.page_id - 1000: r.text for r in found[1]}
    for i, (_, want) in enumerate(ODD):
        assert want is None or got[i] == want


def test_other_layouts(found):
    dice = random.Random(8)
    a, b, c = (sentence(dice) for _ in range(3))
    pages = {
        f'<div class="header"><a href="/">Home</a></div><div id="cookie-consent">{c}</div><div class="post-body"><h1>T</h1><p>{a}'
        f'<p>{b}</div><div class="sidebar"><ul><li><a href="/">{c}</a></ul></div><div class="footer">&copy;</div>': f"T {a} {b}",
        f"<body><header><nav><a href=/>Home</a></nav></header><main><h1>T</h1><p>{a}</p><p>{b}</p></main><section class=comments>"
        f"<p>{c}</p></section><footer>{c}</footer>": f"T {a} {b}",
        f"<body><p>{a}</p><p>{b}</p></body>": f"{a} {b}",
    }
    for html, want in pages.items():
        assert html_text.main_text(html, found[0]) == want


CUSTOM = ["<svg-icon></svg-icon>", "<video-player src=x></video-player>", "<select-box>", "<svg-icon/>", '<svg class="a>b" width="1"/>', "<svg/>",
          "<math />", "<svg viewBox='0 0 1 1' /><b></b>", '<svg a="/"><text>no</text><svg/></svg>', "<video controls>no</video\n>", "<SVG/>"]


@pytest.mark.parametrize("inner", CUSTOM)
def test_elements_that_hide_nothing_after_them(found, inner):
    assert [b.text for b in html_text.blocks_of(f"<article><p>one</p>{inner}<p>two three</p></article>")] == ["one", "two three"]
    dice = random.Random(12)
    a, b, c = (sentence(dice) for _ in range(3))
    page = f"<body><article><h1>T</h1><p>{a}</p>{inner}<p>{b}</p><svg><text>no</text></svg><p>{c}</p></article></body>"
    assert html_text.main_text(page, found[0]) == f"T {a} {b} {c}"


def test_viterbi_and_gradient():
    field = html_text.Field()
    field.stay, field.change = 0.7, -0.4
    for scores in ([0.3, -0.2, 0.5, -0.9], [0.1], [-0.1, 0.1, 0.1]):
        def worth(states):
            pairs = sum(field.stay if x == y else field.change for x, y in zip(states, states[1:]))
            return sum(s if x else -s for s, x in zip(scores, states)) + pairs
        assert tuple(field.decode(scores)) == max(itertools.product([True, False], repeat=len(scores)), key=worth)
    rows, labels = [["a"], ["a", "b"], ["b"]], [True, True, False]
    for _ in range(300):
        field.step(rows, labels, 0.1)
    assert field.decode(field.scores(rows)) == labels and math.isfinite(field.stay)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert html_text.learn(df) is None
    assert html_text.extract(df, None).count() == 0


LAYOUTS = [
    "<main><article>{}</article></main>", "<article>{}</article>", "<article\nclass=x>{}</article>", "<main\t>{}</main>",
    "<article><p>Teaser one two.</p></article><article>{}</article>", "<main><div><article>{}</article></div><aside><p>More to read.</p></aside></main>",
    "<article>{}<section><article><p>A reader's comment, long enough to look like text.</p></article></section></article>",
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_labels_of_layouts(layout):
    """The outermost main, else the largest article; articles inside articles are comments."""
    text = "<h1>H</h1>" + "".join(f"<p>Sentence number {i} of the body.</p>" for i in range(5))
    page = "<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav>" + layout.format(text) + "<footer>foot</footer></body></html>"
    blocks, labels = html_text.labelled(page)
    main = [b.text for b, x in zip(blocks, labels) if x]
    assert main == ["H"] + [f"Sentence number {i} of the body." for i in range(5)]
    assert html_text.main_text(page, None).startswith("H Sentence number 0")
    assert "Home" not in html_text.main_text(page, None) and "foot" not in html_text.main_text(page, None)
    field = html_text.train([page] * 5)
    assert field is not None and html_text.main_text(page, field).split()[:3] == ["H", "Sentence", "number"]


def test_without_model_or_main_element():
    page = "<title>T</title><div><a href=/>One</a> <a href=/>Two</a></div><div><p>Some <a href=/>linked</a> words of text.</p></div><form>Send</form>"
    assert html_text.labelled(page) is None and html_text.train([page]) is None
    assert html_text.main_text(page, None) == "Some linked words of text."


@pytest.mark.parametrize("inner, shown", [
    ("<video src=x>", "a b"), ("<audio controls src=x><p>c</p>", "a c b"), ("<object><object>no</object>no</object>", "a b"),
    ("<object><p>no</p></object>", "a b"), ("<object><object>no</object>", "a b"), ("<canvas>no</canvas><video>no</video>", "a b"),
    ("<video-player>yes</video-player>", "a yes b"), ("</video>", "a b"), ("<VIDEO>no</Video >", "a b"),
])
def test_media(inner, shown):
    blocks = html_text.blocks_of(f"<article><p>a</p>{inner}<p>b</p></article>")
    assert " ".join(b.text for b in blocks) == shown


def test_gradient_by_enumeration():
    """One step moves every weight by the gradient of the log-likelihood, summed over all labellings of the page."""
    import itertools
    import math

    rows, labels, rate = [["a", "x"], ["b"], ["a"], ["c", "x"]], [True, True, False, True], 0.25
    field = html_text.Field()
    field.weights.update({"a": 0.7, "b": -0.4, "c": 0.2, "x": 0.5})
    field.stay, field.change = 0.6, -0.3

    def score(states):
        own = sum((1 if s else -1) * sum(field.weights[f] for f in row) for s, row in zip(states, rows))
        return own + sum(field.stay if s == t else field.change for s, t in zip(states, states[1:]))

    chances = {s: math.exp(score(s)) for s in itertools.product((True, False), repeat=len(rows))}
    total = sum(chances.values())
    mean = lambda of: sum(p / total * of(s) for s, p in chances.items())
    count = lambda f: lambda s: sum((1 if x else -1) * row.count(f) for x, row in zip(s, rows))
    stays = lambda s: sum(x == y for x, y in zip(s, s[1:]))
    wanted = {f: w + rate * (count(f)(labels) - mean(count(f))) for f, w in field.weights.items()}
    # Neighbour weights take a smaller step, by the number of blocks.
    stay = field.stay + rate / len(rows) * (stays(labels) - mean(stays))
    change = field.change + rate / len(rows) * (len(rows) - 1 - stays(labels) - mean(lambda s: len(rows) - 1 - stays(s)))
    field.step(rows, labels, rate)
    assert {f: pytest.approx(w, abs=1e-4) for f, w in wanted.items()} == dict(field.weights)
    assert (field.stay, field.change) == (pytest.approx(stay), pytest.approx(change))
