import html.parser
import itertools
import random
import re
import time

import numpy as np
import pytest

from hybridflow.llm import dom, html_text, template_pages


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit(spark)


def test_pages_it_has_not_seen(model):
    right = total = 0
    for seed in range(7_000_000, 7_000_200):
        page = template_pages.page(seed)
        nodes, pieces = dom.parse(page)
        wanted = dom.chosen_text(pieces, [n.truth for n in nodes])
        total += 1
        right += html_text.main_texts([page], model) == [wanted]
    assert right / total > 0.9


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (
            "<html><body><nav><a href=/>Home</a><a href=/x>News</a></nav><div class=ad>Buy this now.</div><article><h1>A title of it</h1>"
            "<p><b>Fish &amp; chips</b>, said\n  they, are good food for all people.<br>And so it was,<p>then &#233;t&eacute; came and the sun shone on it.</p>"
            "</article><footer>&copy; Some one</footer></body></html>",
            "A title of it Fish & chips, said they, are good food for all people. And so it was, then été came and the sun shone on it.",
        ),
        (
            "<body><div id=header><h1>My site</h1><ul class=menu><li><a href=1>one</a><li><a href=2>two</a></ul></div><main><div class='post-content'>"
            "<p>This is the first paragraph of the story, with words.</p><form class=newsletter><p>Sign up here.</p><input></form>"
            "<p>And this is the second one, with a <a href=x>link</a> in it.</p></div></main><div class=comments><p>I don't like it at all, they wrote.</p></div></body>",
            "This is the first paragraph of the story, with words. And this is the second one, with a link in it.",
        ),
    ],
)
def test_written_pages(model, page, text):
    assert html_text.main_texts([page], model) == [text]


STORY = "<p>This is the first paragraph of the story, with words.</p>{}<p>And this is the second one, with more of it.</p>"
WHOLE = "This is the first paragraph of the story, with words. And this is the second one, with more of it."


@pytest.mark.parametrize(
    "odd",
    [
        "<script>for(i=0;i<n;i++){f(i)}</script>",
        "<script><!-- f(); </script>",
        "<style><!-- p > a {} </style>",
        "<SCRIPT>if(a<b)document.write('</p>')</SCRIPT >",
        "<textarea>a <b and </textarea>",
        "<iframe src=x>",
        "<math></math><object data=x>",
        "<svg viewBox='0 0 1 1'><path class='nav' d='M0 0'/></svg>",
        "<noscript><img src=x></noscript>",
    ],
)
@pytest.mark.parametrize("before", [True, False])
def test_no_text_is_lost_after(model, odd, before):
    body = f"{odd}<article>{STORY.format('')}</article>" if before else f"<article>{STORY.format(odd)}</article>"
    page = f"<html><head><title>A <b title</title></head><body><nav><a href=/>Home</a><a href=/x>News</a></nav>{body}<script>g()</script><footer>&copy; Some one</footer></body></html>"
    assert html_text.main_texts([page], model) == [WHOLE]


def test_formulas_and_objects_stay_in_their_paragraph(model):
    page = (
        "<body><nav><a href=/>Home</a></nav><article><p>The sum <math><mi>a</mi><mo>+</mo><mn>1</mn></math> is larger than any of its parts.</p>"
        "<object data=x><p>What is shown here can also be read, word for word.</p></object><p>So it ends, as all things do.</p></article></body>"
    )
    want = "The sum a+1 is larger than any of its parts. What is shown here can also be read, word for word. So it ends, as all things do."
    assert html_text.main_texts([page], model) == [want]


@pytest.mark.parametrize("page", ["<title>" * 100_000, "<script><</script>" * 50_000, "<textarea><iframe>" * 50_000])
def test_raw_elements_take_linear_time(page):
    started = time.perf_counter()
    dom.parse(page)
    assert time.perf_counter() - started < 20


def plain_text(page):
    """All text of a page, by a parser of its own kind: what no extractor may alter or reorder."""
    class Reader(html.parser.HTMLParser):
        def __init__(self):
            super().__init__()
            self.parts, self.raw = [], 0

        def handle_starttag(self, tag, attrs):
            self.raw += tag in ("script", "style", "title")

        def handle_endtag(self, tag):
            self.raw -= tag in ("script", "style", "title")

        def handle_data(self, data):
            if not self.raw:
                self.parts.append(data)

    reader = Reader()
    reader.feed(page)
    return "".join("".join(reader.parts).split())


def test_nodes_hold_all_text_of_given_pages(spark, folder):
    """The tree against the standard library's parser: every character once, in page order."""
    pages = [r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect() if r["html"]]
    assert pages
    for page in pages:
        nodes, pieces = dom.parse(page)
        assert "".join(dom.chosen_text(pieces, [True] * len(nodes)).split()) == plain_text(page)


def test_given_pages_give_their_article(spark, folder, model):
    """The whole result against the text inside the article element, read without the tree."""
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(rows, model).collect()}
    right = wanted = 0
    for r in rows.collect():
        bodies = re.findall(r"<article[^>]*>(.*?)</article>", r["html"] or "", re.S)
        if len(bodies) == 1:
            wanted += 1
            right += "".join(got[r["page_id"]].split()) == plain_text(bodies[0])
    assert wanted and right / wanted > 0.95


def old_end(page, at):
    """End of a tag by a pattern that looks at everything again each time."""
    m = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>").match(page, at)
    return m.end() - 1 if m else page.find(">", at)


def test_tags_end_outside_quotes_or_at_the_first_end():
    rng = random.Random(9)
    for _ in range(3000):
        page = "".join(rng.choice(["<a ", '"', "'", ">", "x", "=", " ", "</b"]) for _ in range(rng.randint(2, 40))) + ">"
        ends = dom._Ends(page)
        places = [k for k in range(len(page)) if rng.random() < 0.5]
        assert [ends.after(k) for k in places] == [old_end(page, k) for k in places]


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000, "<foo>" * 200_000, "<div>" * 90_000 + "</b>" * 100_000 + "</p>" * 50_000, '<a "x>"' * 150_000, "<a'\">" * 150_000,
        "<ul><li><div>" + "<foo>" * 90_000 + "</li>" * 100_000, "<p><foo><foo>" * 80_000, "<div>" * 90_000 + "<body>" * 90_000,
        "<" * 1_000_000, "<a" * 500_000, '<i class="' * 100_000, "<table><tr><td>" * 60_000 + "</tr>" * 60_000,
    ],
)
def test_pages_of_a_megabyte_take_linear_time(model, page):
    started = time.perf_counter()
    assert isinstance(html_text.main_texts([page], model)[0], str)
    assert time.perf_counter() - started < 40


def test_spark_trees_and_arrays_agree(spark, model):
    from pyspark.ml.classification import GBTClassifier

    rows = html_text.training_nodes(spark, 60, seed=3).cache()
    spark_model = GBTClassifier(maxIter=4, maxDepth=4, seed=1).fit(rows)
    own = html_text.NodeModel(html_text._trees(spark_model))
    found = spark_model.transform(rows).select("features", "probability").collect()
    chance = own.chance(np.array([r["features"].toArray() for r in found]))
    assert np.allclose(chance, [r["probability"][1] for r in found], atol=1e-6)


def test_decoding_is_the_best_consistent_labelling():
    rng = random.Random(5)
    for _ in range(60):
        nodes = [dom.Node("html", None, "", 0)]
        for i in range(1, rng.randint(2, 8)):
            nodes.append(dom.Node("div", rng.choice(nodes), "", i))
        p = np.array([rng.uniform(0.05, 0.95) for _ in nodes])

        def gain(keep, p=p):
            return sum(np.log(x if k else 1 - x) for k, x in zip(keep, p, strict=True))

        fine = [
            keep
            for keep in itertools.product([False, True], repeat=len(nodes))
            if all(not k or n.parent is None or keep[n.parent.order] for k, n in zip(keep, nodes, strict=True))
        ]
        got = html_text.decode(nodes, p)
        assert tuple(got) in fine and abs(gain(got) - max(map(gain, fine))) < 1e-9


@pytest.mark.parametrize(
    "page", [None, "", "   ", "<", "<p", "</p></div>", "<script>", "<!--", "<a href='x", "<div " * 50, "<b>" * 3000, "<div>" * 3000 + "x", "&#xffffff; &bogus;"]
)
def test_broken_pages_do_not_crash(model, page):
    assert isinstance(html_text.main_texts([page], model)[0], str)


def test_odd_rows_and_empty_table(spark, model):
    kind = "page_id long, url string, html string, text string"
    rows = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<nav>" + "<a>x</a>" * 50_000 + "</nav>", None)], kind)
    assert [r["text"] for r in html_text.extract(rows, model).collect()] == ["", "", ""]
    assert html_text.extract(spark.createDataFrame([], kind), model).count() == 0
