import random
import time

from benthos.llm import html


def text(page, votes=None):
    return html.text_of(page, votes or {})


def test_boilerplate_goes_and_the_article_stays():
    page = """<!DOCTYPE html><html><head><title>t</title><script>if (a < b) { x = "</p>" }</script><style>p{}</style></head><body class="home">
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, accept them all now please.</p></div>
    <div id="main"><article class="post-12"><h1>Title &amp; more</h1><p>First&nbsp;paragraph,
      with <b>bold</b> text.<br>Same block.</p><div class="ad">Buy now</div><ul><li>one<li>two</ul><form><p>Subscribe here</p></form><p>Last<p>Unclosed</article>
    <aside><p>Related reading about other things entirely.</p></aside><section class="comments"><p>Reader: I disagree with every single word of this article, at length.</p></section></div>
    <footer>&copy; site</footer></body></html>"""
    assert text(page) == "Title & more\nFirst paragraph, with bold text. Same block.\none\ntwo\nLast\nUnclosed"


def test_classes_that_speak_of_something_else():
    body = "<p>The text of the page, which is long enough to be the text.</p>"
    assert text(f"<div class='layout with-sidebar'>{body}</div><div class='left-sidebar'><p>no</p></div>") == "The text of the page, which is long enough to be the text."
    assert text(f"<article><div class='post-header'><h2>Head</h2><span>by someone</span></div>{body}<div id='comments'><p>no</p></div></article>").startswith("Head\nThe text")
    assert text(f"<main><header><h1>Head</h1><p>by someone</p></header>{body}</main>").startswith("Head\nThe text")


def test_odd_pages():
    assert text(None) == text("") == text("<a href='x") == text("<script>x") == ""
    assert text("plain < text &amp; 5 > 3") == "plain < text & 5 > 3"
    assert text("<div><p>a<div>b</p>c</div></div>") == "a\nb\nc"
    assert text("<p title='a > b'>x</p><!-- <p>no</p> --><p>y") == "x\ny"
    assert text("<p>" + "<b>" * 5000 + "deep") == "deep"
    assert text("<p>" + "long words " * 50_000 + "</p>") == ("long words " * 50_000).strip()
    assert text("</p></div><td>x</td>") == "x"


def test_hosts_vote_for_their_path(spark):
    good = "<div class='story-%d'><p>%s</p></div>"
    # On one page the wrong box is longer; the host's other pages outvote it.
    pages = [(i, "http://Host.example/x?i=1", "<body>" + good % (i, "the article text " * 8) + "<div class='box'><p>short</p></div></body>", "x") for i in range(6)]
    pages.append((9, "http://host.example:80/y", "<body>" + good % (9, "the short article") + "<div class='box'><p>" + "a long box of something else " * 9 + "</p></div></body>", "x"))
    pages += [(20, None, "<p>alone</p>", "x"), (21, "not a url", None, "x"), (22, "http://[bad", "<p>odd host</p>", "x"), (20, None, "<p>alone</p>", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {}
    for r in html.extract(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert got[9] == ["the short article"]
    assert got[0] == [("the article text " * 8).strip()]
    assert got[20] == ["alone", "alone"] and got[21] == [""] and got[22] == ["odd host"]
    first = [r for r in html.host_paths(df).collect() if r["host"] == "host.example" and r["rank"] == 1]
    assert first[0]["path"].endswith("div.story-#")


def test_empty(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_all_paths_of_a_host_vote(spark):
    # 30 body variants on one host: the short article of each is outvoted on its page alone.
    long, short = "the article text " * 8, "the short article"
    other = "<div class='box'><p>" + "a long box of something else " * 9 + "</p></div>"
    page = lambda i, t, more: f"<body class='kind-{chr(97 + i)}{chr(97 + i)}'><div class='story'><p>{t}</p></div>{more}</body>"
    rows = [(100 * i + k, "http://one.example/x", page(i, long, "<div class='box'><p>short</p></div>")) for i in range(26) for k in range(4)]
    rows += [(100 * i + 50, "http://one.example/y", page(i, short, other)) for i in range(26)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[100 * i + 50] for i in range(26)] == [short] * 26


def test_formulas_and_labels_are_text():
    page = "<article><p>So <math><mi>x</mi><annotation>x</annotation></math> and <svg><title>t</title><text>drawn</text></svg> hold for a <label>name</label>.</p><form><label>no</label></form></article>"
    assert text(page) == "So x and drawn hold for a name."


def test_deep_pages_take_time_in_proportion():
    def seconds(page):
        began = time.perf_counter()
        html.text_of(page, {})
        html.containers(html.parse(page))
        return time.perf_counter() - began

    for piece in ("<div class='a{0}'>text ", "<article><header>h", "<table><tr><td>x", "<ul><li><b>", "<p>x<table><td><font>", "<section><p>a<div>"):
        short, long = ("".join(piece.format(i) for i in range(n)) for n in (4000, 32_000))
        a = min(seconds(short) for _ in range(2))
        assert seconds(long) < 8 * 3 * a + 0.5
    assert seconds("<div>t" * 50_000) < 5 and seconds("<ul><li><div>" + "<span>" * 20_000 + "<li>x</li>" * 20_000) < 5


def plain(pages):
    """Scoring by climbing from each block, voting and re-extraction, restated with dictionaries."""
    boxes, shares = {}, {}
    for k, (url, page) in enumerate(pages):
        root, score, order = html.parse(page), {}, []
        for text, node, share in html.blocks(root):
            worth, x = len(text) * (1 - share), node
            if node.up is None:
                continue
            while x is not None:
                if x.tag in html.CONTAINER or x.up is None:
                    score[x] = score.get(x, 0) + worth
                    worth *= 0.6
                x = x.up
        stack = [root]
        while stack:
            x = stack.pop()
            order.append(x)
            stack += [p for p in reversed(x.parts) if not isinstance(p, str)]

        def steps(x):
            out = []
            while x.up is not None:
                out.append(x.name)
                x = x.up
            return tuple(out)

        weight = lambda x: 1.6 if x.tag in ("article", "main") else 1.2 if x.good else 0.6 if x.tag in ("body", "") else 1.0
        best = sorted((x for x in order if score.get(x, 0) > 0), key=lambda x: -round(score[x] * weight(x), 9))
        boxes[k] = root, [(x, steps(x), score[x] * weight(x)) for x in best]
        seen = set()
        for x, path, s in boxes[k][1]:
            if path not in seen:
                seen.add(path)
                shares.setdefault((html.host_of(url), path), []).append(s / boxes[k][1][0][2])
    out = []
    for k, (url, _) in enumerate(pages):
        root, ranked = boxes[k]
        if not ranked:
            top = root
        else:
            vote = lambda p: round(sum(v := shares[html.host_of(url), p]) / (len(v) + 1), 6)  # noqa: B023, E731
            top = max(ranked, key=lambda r: vote(r[1]))[0]
        out.append("\n".join(t for t, _, _ in html.blocks(top)))
    return out


def test_consensus_against_a_restatement(spark):
    rng = random.Random(2)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "mu"]) for _ in range(n))
    pages = []
    for i in range(120):
        host = rng.choice("abc")
        boxes = [f"<div class='{c}-{i % 4}'><p>{words(rng.randint(1, 40))}<div><p>{words(rng.randint(1, 9))}</div></div>" for c in rng.sample(["story", "box", "list", "extra"], 3)]
        pages.append((f"http://{host}.example/{i}", f"<body class='t{host}'><section>{boxes[0]}</section>{boxes[1]}<main>{boxes[2]}</main>"))
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    assert [got[i] for i in range(len(pages))] == plain(pages)
