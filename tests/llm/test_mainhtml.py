import html
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from partlens.llm import mainhtml
from tests.conftest import DATA

SCHEMA = "page_id long, url string, html string, text string, _host string"


def plain(raw):
    """The generated pages' article, by patterns alone."""
    found = re.search(r"<article>(.*?)(?:</article>|$)", raw, re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1])
    lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in mainhtml.main_text(pages).collect()} == want


@pytest.mark.parametrize(
    "raw, text",
    [
        ("", ""),
        ("just text &amp; &lt;b&gt;", "just text & <b>"),
        ("<nav>x<article><header><h1>T</h1></header>a <b>b</b><br>c<p>q<p>r", "T\na b c\nq\nr"),
        ("<article>a<aside>z</aside>b<div class='Comments-list'>k</div>c<footer>f</footer></article>after", "a\nb\nc"),
        ("<article>a <span class=ad>no</span>b<script>if(a<b){'</p>'}</script>c</article>", "a b\nc"),
        ("<div id=cookieNotice>x</div><main><p>a&nbsp;\n b</p><form>f<p>g</form></main><div>z</div>", "a b"),
        ("<header>h</header><div>one<!-- two --><p>three</div><ul><li>4<li>5</ul><footer>f", "one\nthree\n4\n5"),
        ("<article><article class=comment>c</article><p>a</article><p>b", "a"),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
        ("<article>2 < 3 and <3> x</article", "2 < 3 and <3> x</article"),
        ("<article>a<div class='skip-ahead'>b</div><section id=comments-on-law>c</section><p class=skip-link>d</p><div id=menu_top>e</div>f</article>", "a\nb\nc\nf"),
        ("<article><p hidden>a<p aria-hidden=true>b<p role=navigation>c<p style='display: none'>d<p>e", "e"),
    ],
)
def test_pieces(raw, text):
    assert mainhtml.article(mainhtml.parse(raw), {}) == text


def site(pages, host, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(pages):
        body = "".join(f"<p>{rng.random()} text {rng.random()}</p>" for _ in range(rng.randrange(2, 6)))
        rows.append((f"http://{host}/{i}", f"<body><div class=x1><p>Always here</p><ul><li>Home<li>About</ul></div><div class=x2>{body}</div><div class=x3>Terms of use</div></body>"))
    return rows


def test_branches_alike_on_all_pages_of_a_site_go(frame):
    """No element says what it is: only the site's tree tells. One page of a kind keeps all."""
    rows = [(i, u, h, "x", "y") for i, (u, h) in enumerate([*site(30, "A.example:80", 1), *site(1, "b.example", 2)])]
    got = {r.page_id: r.text for r in mainhtml.main_text(frame(rows, SCHEMA)).collect()}
    for i in range(30):
        assert "Always" not in got[i] and "Home" not in got[i] and "Terms" not in got[i]
        assert got[i].count("text") == rows[i][2].count("text")
    assert got[30].startswith("Always here\nHome\nAbout\n") and got[30].endswith("Terms of use")


def lines_of(node):
    """A node's own texts and its blocks in page order."""
    out, held = [], []
    for part in [*node.parts, None]:
        if isinstance(part, str):
            held.append(part)
            continue
        line = " ".join("".join(held).split())
        held = []
        out += [line] if line else []
        out += [part] if part is not None else []
    return out


def style_tree(pages):
    """The site's tree in one dictionary: pages of a node, and how often each style and text of it is there."""
    tree = defaultdict(lambda: [0, Counter(), Counter()])
    for root in pages:
        styles, texts, waiting = defaultdict(set), defaultdict(set), [((), root)]
        while waiting:
            way, node = waiting.pop()
            below = [(way + (b.label,), b) for b in node.blocks()]
            styles[way] |= {tuple(k for k, _ in itertools.groupby(b.label for _, b in below))} if below else set()
            texts[way] |= {x for x in lines_of(node) if isinstance(x, str)}
            waiting += below
        for way in styles.keys() | texts.keys():
            tree[way][0] += 1
            tree[way][1].update(styles[way])
            tree[way][2].update(texts[way])
    return tree


def plain_text(root, tree):
    def worth(way, node):
        pages, styles, texts = tree[way]
        told = pages >= mainhtml.LEAST_PAGES
        inner, most = [], []
        for part in lines_of(node):
            if isinstance(part, str):
                inner.append(1 - math.log(texts[part]) / math.log(pages) if told else 1.0)
                most.append(inner[-1])
            elif not part.noise:
                own, far = worth(way + (part.label,), part)
                inner.append(own)
                most.append(far)
        if not inner:
            return 0.0, 0.0
        mean, below, own = sum(inner) / len(inner), sum(not b.noise for b in node.blocks()), 1.0
        if told and node.blocks():
            total = sum(styles.values())
            own = min(1.0, max(0.0, sum(n / total * -math.log(n / total, pages) for n in styles.values())))
        elif not node.blocks():
            own = mean
        found = (1 - 0.9**below) * own + 0.9**below * mean
        return found, max([found, *most])

    def ways(way, node, tag):
        if node.noise:
            return []
        if node.tag == tag:
            return [(way, node)]
        return [f for b in node.blocks() for f in ways(way + (b.label,), b, tag)]

    tops, low = [((), root)], 0.25
    for tag in ("main", "article"):
        found = ways((), root, tag)
        if found:
            tops, low = found, 0.05 if tag == "article" else 0.25
    if low == 0.05 and all(worth(*t)[1] <= low for t in tops):
        low = -1
    out = []

    def walk(way, node, top):
        if not node.noise and (top or worth(way, node)[1] > low):
            for part in lines_of(node):
                out.append(part) if isinstance(part, str) else walk(way + (part.label,), part, False)

    for way, node in tops:
        walk(way, node, True)
    return "\n".join(out)


def mixed_site(seed, pages):
    """Pages with an article, with a main part or with neither, some blocks on all, many or few of them."""
    rng = random.Random(seed)
    words = lambda n: " ".join(f"w{rng.randrange(999)}" for _ in range(n))
    out = []
    for i in range(pages):
        body = "".join(f"<p>{words(5)}</p>" for _ in range(rng.randrange(1, 5)))
        more = rng.choice(["", "<div class=more><p>Read more of this</p><ul><li>one<li>two</ul></div>"]) if i % 9 else ""
        inside = f"<h1>{words(2)}</h1>{body}<p class=sub>Join our readers today</p><div class=skip-ahead>{words(3)}</div>{more}"
        frame = ("<article>%s</article>", "<main>%s</main>", "<div class=text>%s</div>")[i % 3 if seed % 2 else 0]
        out.append(f"<body><div class=x1>Always here<ul><li>Home<li>{words(1)}</ul></div><nav>n</nav>{frame % inside}<div class=x3>Terms of use</div></body>")
    return out


@pytest.mark.parametrize("seed, pages", [(1, 60), (2, 40), (3, 3), (4, 5)])
def test_against_a_plain_style_tree(frame, seed, pages):
    raws = mixed_site(seed, pages)
    raws += [raws[-1], ""]
    rows = [(i, f"https://a.example/{i}", raw, "x", "y") for i, raw in enumerate(raws)] + [(1000, "https://b.example/", raws[0], "x", "y")]
    got = {r.page_id: r.text for r in mainhtml.main_text(frame(rows, SCHEMA)).collect()}
    roots = [mainhtml.parse(raw) for raw in raws]
    tree = style_tree(roots)
    assert {i: got[i] for i in range(len(raws))} == {i: plain_text(root, tree) for i, root in enumerate(roots)}
    assert got[1000] == plain_text(roots[0], style_tree(roots[:1]))
    if pages > 30:
        # What stands in every article goes by the tree alone, and texts of one page stay.
        assert all("Join our readers" not in got[i] for i in range(0, pages, 3)) and "Join our readers" in got[1000]
        assert all(re.search(r"skip-ahead>([^<]*)", raws[i])[1] in got[i] for i in range(pages))


def test_copies_of_a_page_stay_whole(frame):
    raw = "<body><nav>n</nav><article><h1>t</h1><p>a b</p><p>c</p></article></body>"
    rows = [(i, f"https://a.example/{i}", raw, "x", "y") for i in range(20)]
    assert {r.text for r in mainhtml.main_text(frame(rows, SCHEMA)).collect()} == {"t\na b\nc"}


def test_packed_trees_are_the_same_tree():
    for raw in ["", "<p>a<p>b", "<div>" * 5000 + "x", *mixed_site(1, 4)]:
        root = mainhtml.parse(raw, 7)
        tops, low = mainhtml.region(root)
        again = mainhtml.unpacked(mainhtml.packed(tops, low))
        assert mainhtml.candidates(again[0]) == mainhtml.candidates(tops) <= mainhtml.signs(root)
        assert again[1] == low and mainhtml.region_text(*again, {}) == mainhtml.article(root, {})


def test_importance_is_entropy():
    root = mainhtml.parse("<div><p>a</p><p>b</p></div>")
    div = root.blocks()[0]
    p = div.blocks()[0]
    known = {(p.path, mainhtml._text("a")): 0.5, (div.path, mainhtml._style(div)): 0.25}
    weight = mainhtml.DECAY**2
    assert math.isclose(mainhtml.importance(div, known, {}), (1 - weight) * 0.25 + weight * 0.75)


def test_awkward_rows(frame):
    rows = [(1, "http://h/1", None, "t", "h"), (1, "http://h/1", None, "t", "h"), (None, None, "<p>x", None, None), (2, "", "", "t", "h"), (3, "http://h/3", "<article>" + "w " * 200000, "t", "h")]
    got = sorted([(str(r.page_id), r.url, r.text) for r in mainhtml.main_text(frame(rows, SCHEMA)).collect()], key=str)
    assert [g[2] for g in got] == ["", "", "", " ".join(["w"] * 200000), "x"]
    assert mainhtml.main_text(frame([], SCHEMA)).collect() == []
