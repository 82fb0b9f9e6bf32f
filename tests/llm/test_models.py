"""Toxicity, quality and main text."""

import random

import numpy as np
import pytest

from tradelake.llm import quality, toxicity
from tradelake.llm.main_text import extract, main_text

CLEAN = "river stone meadow window garden letter winter bridge candle market harbor village teacher orange silver pocket".split()
INSULTS = ["idiot", "moron", "pathetic", "worthless"]


def sentence(rng, insult=None):
    words = [rng.choice(CLEAN) + rng.choice(["", "s", "ed"]) for _ in range(8)]
    if insult:
        words[rng.randrange(8)] = insult
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        body = [sentence(rng) for _ in range(3)] + ([sentence(rng, rng.choice(INSULTS))] if bad else [])
        rng.shuffle(body)
        docs.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    docs += [(600, None), (None, "x"), (601, "")]
    labels += [(600, 0), (None, 1), (602, None), (601, 0), (601, 0)]
    return toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_tolerates_gaps_and_insertions(spark, toxic_model):
    rng = random.Random(9)
    bad = [sentence(rng, w) for w in ("idiot", "IDIOT!", "i-d-i-o-t", "i.d.i.o.t", "idi0t", "pat_het_ic", "worthlesss", "m o r o n", "pathettic")]
    good = [sentence(rng) for _ in range(60)] + ["river", "Harbor, silver."]
    df = spark.createDataFrame([(t, 7, "r") for t in [*bad, *good, None, ""]], "text string, score int, row string")
    got = toxicity.score(df, toxic_model)
    assert got.columns == ["text", "row", "score"]
    by = {r.text: r.score for r in got.collect()}
    assert all(0 <= s <= 1 for s in by.values())
    assert min(by[t] for t in bad) >= 0.3, {t: by[t] for t in bad}
    assert max(by[t] for t in good) < 0.3 and by[None] < 0.3 and by[""] < 0.3


def test_toxicity_joins_pieces_across_spaces_and_signs(spark, toxic_model):
    rng = random.Random(19)
    bad = [sentence(rng, w) for w in ("i - d - i - o - t", "* i * d * i * o * t *", "i. d. i. o. t", "id iot", "mor on")]
    good = [sentence(rng) for _ in range(30)]
    by = dict(zip(bad + good, toxic_model.scores(bad + good)))
    assert min(by[t] for t in bad) >= 0.3, {t: by[t] for t in bad}
    assert max(by[t] for t in good) < 0.3


def test_folded_weights_equal_the_kernel_expansion():
    words = ["idiot", "moron", "window", "stones"]
    base = toxicity.dense(words)
    gram = toxicity._kernel(["idxiot", "garden"], base)
    beta = np.array([1.0, -0.5, 0.25, 2.0])
    assert np.allclose(gram @ beta, toxicity.folded(["idxiot", "garden"], beta @ base, 0.0), atol=1e-5)


def test_kernel_by_brute_force():
    import itertools

    def by_hand(a, b):
        def vector(w):
            out = {}
            for t in itertools.combinations(range(len(w)), 3):
                if t[2] - t[0] < toxicity.SPAN:
                    out.setdefault("".join(w[k] for k in t), []).append(toxicity.DECAY ** (t[2] - t[0] + 1))
            norm = sum(x * x for v in out.values() for x in v) ** 0.5
            return {k: sum(v) / norm for k, v in out.items()}

        x, y = vector(a), vector(b)
        return sum(v * y.get(k, 0) for k, v in x.items())

    for a, b in (("idiot", "idixot"), ("banana", "bandana"), ("abc", "xyz"), ("worthless", "worth")):
        assert np.isclose(float(toxicity._kernel([a], toxicity.dense([b]))[0, 0]), by_hand(a, b), atol=1e-5)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_quality(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(2, 30)))
        bad = i % 3 == 0
        if bad:
            text = [text.upper().replace(".", "!!"), " ".join(w + "###" for w in text.split()), "spam " * 60][i // 3 % 3]
        rows.append((i, text, 1.0))
        labels.append((i, int(not bad)))
    rows += [(400, None, 1.0), (401, "", 1.0), (None, "x", 1.0), (0, rows[0][1], 1.0), (402, "w" * 200_000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x double")
    stats = quality.statistics(df)
    train_on = spark.createDataFrame([x for x in labels if x[0] % 2] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.train(stats, train_on)
    got = quality.score(stats, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    want = dict(labels)
    held_out = [(r.score >= 0.5) == bool(want[r.doc_id]) for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 2 == 0]
    assert np.mean(held_out) > 0.95
    flat = quality.train(stats, train_on.limit(0))
    assert {r.score for r in quality.score(stats, flat).collect()} == {0.5}
    assert quality.score(quality.statistics(df.limit(0)), model).count() == 0


def test_discriminant_against_numpy():
    rng = np.random.default_rng(0)
    d = len(quality.NAMES)
    means, roots = rng.normal(size=(2, d)), rng.normal(size=(2, d, d)) + 3 * np.eye(d)
    covs = [r @ r.T for r in roots]
    model = quality.Model(
        np.zeros(d), np.ones(d), list(means), [np.linalg.inv(np.linalg.cholesky(c)) for c in covs], [np.linalg.slogdet(c)[1] for c in covs], 0.0, 1.0
    )
    x = rng.normal(size=(5, d))
    log = [[-0.5 * ((v - m) @ np.linalg.solve(c, v - m) + np.linalg.slogdet(c)[1]) for v in x] for m, c in zip(means, covs)]
    assert np.allclose(model.odds(x), np.array(log[1]) - np.array(log[0]))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><a href=x>Home</a></nav><div id="cookie-notice">We use cookies. OK?</div><main><article class="post"><h1>Title here</h1>
<p>First &amp; para, with <a href="a>b">link</a>.<p>Second&nbsp;one,<br> here.<ul><li>a<li>b</ul><aside>Related: foo.</aside>
<form><label>Mail</label><input></form><div class="ad">Buy now, cheap.</div><section class="comments"><p>Great post, thanks.</p></section>
<script>var a="<p>no</p>";</script><!-- <p>no</p> --></article></main><div class="sidebar"><p>Popular, posts. are here.</p></div><footer>(c)</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title here\nFirst & para, with link.\nSecond one, here.\na\nb"
    plain = "<div><div><p>Hello, this is a long paragraph. It has text, and signs; more.</p><p>Short.</p></div><div><a href=1>one</a> <a href=2>two</a></div>"
    assert main_text(plain).split("\n")[1:] == ["Short."]
    assert (main_text(None), main_text(""), main_text("<nav>x</nav>")) == ("", "", "")
    assert main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert main_text("</p></div><p>x, y.</b>") == "x, y."
    assert main_text("<div>" * 3000 + "deep, text.") == "deep, text."
    long = " ".join(["word, and more."] * 20_000)
    assert main_text(f"<article><p>{long}</p></article>") == long


def test_only_the_attribute_itself_hides():
    shown = '<body class="overflow-hidden"><div aria-hidden="false" data-title="hidden gems"><p>Shown text, with signs.</p></div>'
    assert main_text(shown) == "Shown text, with signs."
    for attribute in ("hidden", "HIDDEN", 'id="x" hidden', "hidden='until-found'", 'style="display: none"'):
        assert main_text(f"<article><p>Shown text, with signs.</p><p {attribute}>Not this, no.</p></article>") == "Shown text, with signs.", attribute


def test_linked_blocks_of_an_article_stay():
    links = "".join(f'<li><a href="{i}">Reference number {i}, a paper.</a></li>' for i in range(3))
    page = f'<nav><a href=1>Home</a></nav><article><h1><a href=2>Title</a></h1><p>{"Long text, with signs. " * 20}</p><h2><a href=3>Part</a></h2><p>More, here.</p><ol>{links}</ol></article>'
    lines = main_text(page).split("\n")
    assert lines[0] == "Title" and "Part" in lines and "Home" not in lines
    assert lines[-3:] == [f"Reference number {i}, a paper." for i in range(3)]


def test_marked_wrappers_of_the_article_stay():
    text = "Long text, with signs. " * 10
    line = text.strip()
    for name in ("content has-sidebar", "layout-no-sidebar", "post with-comments", "page-has-banner", "withSidebar", "social-sciences", "response-time"):
        assert main_text(f'<div class="{name}"><p>{text}</p></div><div><p>{text}</p></div>') == f"{line}\n{line}", name
    rest = '<div class="ad">Buy this, now.</div><ol class="comments"><li><article class="comment">So true, yes.</article></li></ol>'
    for inner in ("article", "main"):
        assert main_text(f'<div class="sidebar-layout"><{inner}><p>{text}</p>{rest}</{inner}></div>{rest}') == line, inner
    assert main_text(f'<div class="widget"><div><p>{text}</p></div></div><div class="ad">Buy this, now.</div>') == line
    assert main_text(f'<article><p>{text}</p></article><div class="related"><article>{text * 9}</article></div>') == line
    assert main_text(f'<p>{text}</p><div class="comments"><p>{text * 9}</p></div>') == line
    assert main_text('<div class="widget">' * 20_000 + text) == line


def test_extract(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t", "r"), (None, None, None, "t", "r"), (1, "u", PAGE, "t", "r")], "page_id long, url string, html string, text string, row string")
    got = extract(df)
    assert got.columns == ["page_id", "url", "html", "row", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, len(main_text(PAGE)), len(main_text(PAGE))]
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "name, kept",
    [(c, True) for c in "share-price header-image search-tips menu-of-the-day related-work reply-letter comment-on-policy form-group banner-year toolbar-guide".split()]
    + [(c, False) for c in "related-articles share-buttons comments comment-body user-comment ad ad-slot newsletter-signup social-links related2 newsletterBox".split()],
)
def test_marks_within_an_article_are_whole_classes(name, kept):
    text = "A full paragraph of the article, with a comma and quite a few words; it says something. And a second sentence."
    page = f"<body><article><h1>T</h1><p>{text} One.</p><div class='{name}'><p>{text} Two.</p></div></article></body>"
    assert main_text(page).endswith("Two." if kept else "One.")


def test_marks_beside_other_words_count_where_most_text_is_links():
    text = "A full paragraph of the article, with a comma and quite a few words; it says something."
    links = "".join(f"<li><a href='/{k}'>Another page of the site, number {k}.</a></li>" for k in range(5))
    page = f"<body><article><h1>T</h1><p>{text}</p><div class='related-this-week'><ul>{links}</ul></div></article></body>"
    assert main_text(page) == f"T\n{text}"
