"""HTML, top-k, decontamination, PII and WARC against plain versions."""

import hashlib
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from staylake.llm import decontaminate, html_extract, pii, topk, warc
from tests.llm.helpers import HAVE_TABLES, LONG, SF, documents, rows

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")


def _sql(sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return sorted(con.execute(sql).fetchall(), key=repr)


# -------------------------------------------------------------------- HTML

def _text(page):
    return "\n".join(t for _, _, t in html_extract.content_blocks(page)[1])


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<", "<"), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"),
    ("<div class=ad>x</div><p>hello &amp; w&nbsp;o <!-- c --> k", "hello & w o k"),
    ("<article><header><h1>T</h1></header><p>x<script>'</p>'</script>y</p>"
     "<section class='comments'><p>c</p></section></article><p>out</p>", "T\nxy"),
    ("<nav>m</nav><header>h</header><main><p>a<br>b</p></main><footer>f</footer>", "a b"),
    ("<ul><li>a<li>b</ul>", "a\nb"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<article><p>foo <span class='ad'>buy</span> bar</p><aside>no</aside>tail</article>",
     "foo bar\ntail"),
    ("<body><form>f</form><div id='cookie-notice'>n</div><p>t &lt;b&gt;</p>", "t <b>"),
    ("<style>p{}</style><script>never ends", ""), ("<!-- never ends <p>x</p>", ""),
    ("<div>" * 3000 + "deep", "deep"),
    ("<article class='post ad-free'><p>kept</p></article>", "kept"),
    ("<p>" + "word " * 40_000 + "</p>", ("word " * 40_000).strip()),
])
def test_content_of_a_page(page, text):
    assert _text(page) == text


@pytest.mark.parametrize("page,text", [
    # a form around the page is a container, one to fill in is not content
    ("<form id='aspnetForm'><div class=menu>m</div><h1>T</h1><p>long prose here</p><input></form>",
     "T\nlong prose here"),
    ("<form><article><h1>A</h1><p>b</p></article></form>", "A\nb"),
    ("<p>intro text</p><form><label>name</label><input><button>go</button></form>", "intro text"),
    ("<form><label>User name</label><label>Password</label><p>Log in</p></form>", ""),
    # drawings end where they close, or where the page goes on
    ("<article><svg class='icon'/><h1>Title</h1><p>x</p></article>", "Title\nx"),
    ("<article><svg class='icon'><h1>Title</h1><p>x</p></article>", "Title\nx"),
    ("<article><svg><path d='>'/><h1>T</h1><p>x <svg><text>no</text></svg> y</p></article>", "T\nx y"),
    ("<p>a <svg><svg><text>q</text></svg><title>z</title></svg> b</p>", "a b"),
    ("<p>a <svg><foreignObject><p>in</p></foreignObject></svg> b</p>", "a b"),
    # formulas belong to their sentence, their source forms do not
    ("<p>energy is <math><mi>E</mi><mo>=</mo><semantics><mi>m</mi><annotation>TeX</annotation>"
     "</semantics></math> as said</p>", "energy is E=m as said"),
    # classes inside code name tokens
    ("<p><code>x = 1 <span class='token comment'># keep</span></code> y "
     "<span class='comment'>drop</span></p>", "x = 1 # keep y"),
    ("<pre>x <span class='comment'># keep</span></pre>", "x # keep"),
    # comments inside main parts
    ("<main><p>art</p><div id='comments'><ol><li>Reader 1</li></ol></div></main>", "art"),
    ("<article><p>art</p><ol class='commentlist'><li>Reader 1</li></ol></article>", "art"),
    ("<article><h2 id='comments'>On comments</h2><p>x</p></article>", "On comments\nx"),
    ("<header><p>menu</p><main><p>body</p></main></header>", "body"),
])
def test_parts_that_look_like_others(page, text):
    assert _text(page) == text


@pytest.mark.parametrize("n", [1, 3, 6])
def test_articles_survive_their_surroundings(spark, n):
    def body(k):
        return f"Story {k} tells of {' '.join(f'thing{k}x{j}' for j in range(30))}."

    wraps = {
        "form": lambda k: f"<body><form id=f><div class=menu>Home</div><h1>Head {k}</h1>"
                          f"<p>{body(k)}</p><input></form></body>",
        "formed": lambda k: f"<form><article><h1>Head {k}</h1><p>{body(k)}</p></article></form>",
        "icon": lambda k: f"<article><svg class=icon/><h1>Head {k}</h1><p>{body(k)}</p></article>",
        "notes": lambda k: f"<main><h1>Head {k}</h1><p>{body(k)}</p><div id=comments>"
                           f"<ol class=commentlist><li>Reader {k} says no {k}</li></ol></div></main>",
        "search": lambda k: f"<form><label>Find</label><input></form><article><h1>Head {k}</h1>"
                            f"<p>{body(k)}</p></article>",
    }
    pages = [(f"{name}{k}", f"https://{name}.example.com/{k}", wrap(k))
             for name, wrap in wraps.items() for k in range(n)]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id string, url string, html string"))
    want = {f"{name}{k}": f"Head {k}\n{body(k)}" for name in wraps for k in range(n)}
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def test_simple_tree_matching_names_the_right_sibling():
    whole = html_extract.Shape(html_extract.content_blocks(
        "<body><div>ad</div><div><p>1</p><p>2</p></div><h2>t</h2></body>")[0])
    part = html_extract.Shape(html_extract.content_blocks(
        "<body><div><p>9</p></div><h2>t</h2></body>")[0])
    named = {part.paths[a]: b for a, b in html_extract.align(part, whole).items()}
    assert named["/body/div"] == whole.children[1][1]
    assert len(named) == len(part.labels)


def _plain_matching(a, b):
    """Size of the largest simple tree matching, by its definition."""
    def size(i, j):
        if a.labels[i] != b.labels[j]:
            return 0
        left, right = a.children[i], b.children[j]
        grid = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for x, c in enumerate(left, 1):
            for y, d in enumerate(right, 1):
                grid[x][y] = max(grid[x - 1][y], grid[x][y - 1], grid[x - 1][y - 1] + size(c, d))
        return grid[-1][-1] + 1
    return size(0, 0)


def test_tree_matching_is_a_largest_one():
    draw = random.Random(6)

    def tree(depth):
        return f"{draw.choice('abc')}({','.join(tree(depth - 1) for _ in range(draw.randint(0, 4) if depth else 0))})"

    for _ in range(300):
        a, b = (html_extract.Shape(f"({tree(3)},{tree(2)},{tree(3)})") for _ in "ab")
        named = html_extract.align(a, b)
        up = {c: n for n, below in enumerate(a.children) for c in below}
        over = {c: n for n, below in enumerate(b.children) for c in below}
        assert len(named) == _plain_matching(a, b)
        assert len(set(named.values())) == len(named)
        assert all(a.labels[i] == b.labels[j] for i, j in named.items())
        assert all(named[up[i]] == over[j] for i, j in named.items() if i)
        order = [j for _, j in sorted(named.items())]
        assert order == sorted(order)  # preorder of a is preorder of b


def test_tree_matching_of_large_shapes():
    """The same names below and above 3000 nodes."""
    for n in (20, 4000):
        rest = "".join(f"<p class=c{k}>x</p>" for k in range(n))
        whole, part = (html_extract.Shape(html_extract.content_blocks(
            f"<div>{menu}<div><h1>t</h1></div><div><p>c</p></div>{rest}</div>")[0])
            for menu in ("<div>menu</div>", ""))
        named = html_extract.align(part, whole)
        assert len(named) == len(part.labels) == len(whole.labels) - 1
        (top,) = whole.children[0]
        assert named[part.children[part.children[0][0]][0]] == whole.children[top][1]


def test_marks_in_classes_keep_the_node_numbers(spark):
    """Classes with the characters that shapes are written with."""
    for name in ("a)b", "((", "x,y", "w-1/2", "50%", "grid-cols-[minmax(0,1fr)]"):
        shape, found = html_extract.content_blocks(
            f"<div class='{name}'>menu</div><div class='b'><p>text</p></div>")
        read = html_extract.Shape(shape)
        assert [read.labels[n].split(".")[0] for n, _, _ in found] == ["div", "p"]
        assert len(read.labels) == len(set(read.paths)) == 4
    pages = [(n, f"http://h/{n}", "<div class='grid-cols-[minmax(0,1fr)]'>Home</div><div class='a)b'>"
              f"<h1>title {n}</h1><p>body of {n}</p></div><div>bottom</div>") for n in range(6)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.extract(frame).collect()} == {
        n: f"title {n}\nbody of {n}" for n in range(6)}


def test_constant_slots_are_template(spark):
    pages = [(n, f"http://h/{n}", f"<div>Home</div><div><h1>title {n}</h1><p>body {n}</p></div>"
              "<div>bottom line</div>", "x") for n in range(6)]
    pages += [(6, "http://h/x", "<div><h1>other</h1><p>body z</p></div><div>bottom line</div>", "x"),
              (7, None, None, "x"), (7, None, None, "x"), (None, "u", "<p>only &eacute;</p>", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {(r["page_id"], r["url"]): r["text"] for r in html_extract.extract(frame).collect()}
    assert got[3, "http://h/3"] == "title 3\nbody 3"
    assert got[6, "http://h/x"] == "other\nbody z"
    assert got[7, None] == "" and got[None, "u"] == "only é"
    assert html_extract.extract(frame).count() == len(pages)
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_copies_of_one_article_keep_their_text(spark):
    page = "<nav>m</nav><article><h1>t</h1><p>b</p></article>"
    frame = spark.createDataFrame([(n, "http://h/a", page) for n in range(9)],
                                  "page_id long, url string, html string")
    assert {(r["text"], r["n_chars"]) for r in html_extract.extract(frame).collect()} == {("t\nb", 3)}


def _extracted(spark, pages):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {(r["page_id"], r["url"]): r["text"] for r in html_extract.extract(frame).collect()}


def test_copies_are_no_evidence_of_template(spark):
    """Repeated rows, copies under other ids and near copies, without article."""
    page = "<div><h1>t</h1><p>b</p></div>"
    pages = [(1, "http://rows/a", page)] * 3 + [(n, f"http://copies/{n}", page) for n in range(4)]
    pages += [(0, "http://single/", "<div><p>x</p><p>x</p><p>x</p><h2>y</h2></div>")]
    long = "<p>first of the paragraphs</p><p>second of the paragraphs</p><p>third of them</p>"
    pages += [(n, f"http://near/{n}", f"<div><h1>t</h1>{long}<p>edit {n}</p></div>") for n in range(9)]
    pages += [(n, f"http://large/{n}", f"<div><h1>title {n}</h1><p>{n} body</p></div><div>menu</div>")
              for n in range(9)]
    pages += [(n, f"http://large/{n}", "<table><tr><td>only here</td></tr></table><div>menu</div>")
              for n in range(100, 105)]
    got = _extracted(spark, pages)
    assert got[1, "http://rows/a"] == got[2, "http://copies/2"] == "t\nb"
    assert got[0, "http://single/"] == "x\nx\nx\ny"
    assert got[4, "http://near/4"].startswith("t\nfirst") and got[4, "http://near/4"].endswith("edit 4")
    assert got[5, "http://large/5"] == "title 5\n5 body"
    assert got[101, "http://large/101"] == "only here"


def test_slots_decide_on_pages_with_article(spark):
    """Constant text in an article goes, a varying body beside one stays."""
    pages = [(n, f"http://in/{n}", f"<div>Menu</div><article><h1>One title</h1><p>the body of {n}</p>"
              "<div>Read more</div></article><div>bottom</div>") for n in range(6)]
    pages += [(n, f"http://beside/{n}", f"<article><p>A long teaser of {n}, always longer</p></article>"
               f"<div>body {n}</div><section>bottom</section>") for n in range(6)]
    pages += [(n, f"http://near/{n}", "<article><h1>t</h1><h2>half</h2><p>one paragraph</p><p>two "
               f"paragraphs</p><p>edit {n}</p></article>") for n in range(6)]
    pages += [(0, "http://alone/", "<article><p>teaser</p></article><div>the long body</div>"),
              (0, "http://few/", "<article><p>the long body</p></article><div>bottom</div>")]
    got = _extracted(spark, pages)
    assert got[2, "http://in/2"] == "One title\nthe body of 2"
    assert got[2, "http://beside/2"] == "A long teaser of 2, always longer\nbody 2"
    assert got[2, "http://near/2"] == "t\nhalf\none paragraph\ntwo paragraphs\nedit 2"
    assert got[0, "http://alone/"] == "teaser\nthe long body"
    assert got[0, "http://few/"] == "the long body"


@pytest.mark.parametrize("page,text", [
    ("<div class='elementor-widget-container'><p>body</p></div>", "body"),
    ("<div class='content-sidebar-wrap'><article><p>body</p></article></div>", "body"),
    ("<article><p>a</p><section id='discussion'><h2 id=related>D</h2><p>b</p></section></article>",
     "a\nD\nb"),
    ("<div class=widget><article><p>body</p></article></div>", "body"),
    ("<p>See <a href=a>first of the linked</a></p><ul><li><a href=b>reference</a></ul>",
     "See first of the linked\nreference"),
    ("<div class='site-footer'>x</div><div class='x related-posts'>y</div><p>z</p>", "z"),
])
def test_marking_words_are_whole_names(page, text):
    assert _text(page) == text


def test_large_varying_parts_overrule_a_word(spark):
    pages = [(n, f"http://wide/{n}", f"<div class=widget><h1>Title {n}</h1><p>the long body of {n}</p>"
              f"</div><p>by {n}</p><div class=menu>Home</div>") for n in range(6)]
    pages += [(n, f"http://thin/{n}", f"<div class=widget>see {n}</div><p>the long body of {n}</p>")
              for n in range(6)]
    got = _extracted(spark, pages)
    assert got[2, "http://wide/2"] == "Title 2\nthe long body of 2\nby 2"
    assert got[2, "http://thin/2"] == "the long body of 2"


# ------------------------------------------------------------------- top-k

def _plain_topk(vectors, k, asked):
    whole = {}
    for i, v in vectors:
        if i is not None and v and all(x is not None and abs(x) < float("inf") for x in v):
            whole.setdefault(i, []).append([int((64 * x) // 1) for x in v])
    out = []
    for q in asked(whole):
        scored = set()
        for mine in whole[q]:
            for i, others in whole.items():
                scored |= {(-sum(a * b for a, b in zip(mine, o)), i) for o in others
                           if i != q and len(o) == len(mine)}
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 5, 700])
def test_topk_matches_brute_force(spark, n):
    draw = random.Random(n)
    vectors = [(i, [draw.uniform(-1, 1) for _ in range(6)]) for i in range(n)]
    vectors = [(i, vectors[0][1] if i % 3 == 0 else v) for i, v in vectors]  # ties
    vectors += [(9000, None), (9020, [None] * 6), (9040, [float("nan")] * 6), (None, [0.5] * 6),
                (9060, [float("inf")] * 6), (9080, []), (9100, [0.25] * 3), (9101, [0.5] * 3)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors],
                                  "vec_id long, embedding array<float>, norm string")
    ready = topk.integer_vectors(frame, "vec_id", "embedding")
    got = rows(topk.top_k(ready, ready.where("vid % 20 = 0"), 20))
    single = [(i, None if v is None else [None if x is None else
               __import__("numpy").float32(x).item() for x in v]) for i, v in vectors]
    assert got == _plain_topk(single, 20, lambda ids: [i for i in ids if i % 20 == 0])


def test_topk_of_huge_components(spark):
    vectors = [(0, [5e7, 1.0]), (1, [4.9e7, 2.0]), (2, [-5e7, 3.0]), (3, [1e300, 1.0]),
               (4, [0.5, -0.5]), (20, [1e9, 1e9]), (21, [-1e300, -1e300]), (40, [-1e18, 5.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    ready = topk.integer_vectors(frame, "vec_id", "embedding")
    ends = -(1 << 63), (1 << 63) - 1

    def cut(n):
        return min(max(n, ends[0]), ends[1])

    whole = {i: [cut(int(64 * x // 1)) if abs(x) < 1e17 else ends[x > 0] for x in v]
             for i, v in vectors}
    want = []
    for q in (0, 20, 40):
        scored = sorted((-cut(sum(a * b for a, b in zip(whole[q], v))), i)
                        for i, v in whole.items() if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:20])]
    assert rows(topk.top_k(ready, ready.where("vid % 20 = 0"), 20)) == sorted(want, key=repr)


def test_only_blocks_that_are_asked_for_are_copied(spark):
    blocks = spark.createDataFrame([(a, p, 10 * a + p) for a in range(6) for p in range(3)],
                                   "annulus int, piece int, vid long")
    asked = spark.createDataFrame([(1, 0, 0), (1, 0, 7), (1, 0, 7), (4, 2, 3)],
                                  "annulus int, piece int, part int")
    assert rows(topk._asked_blocks(blocks, asked)) == [(1, 0, 10, 0), (1, 0, 10, 7), (4, 2, 42, 3)]


def test_topk_with_many_parts(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    draw = random.Random(1)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(600)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    ready = topk.integer_vectors(frame, "vec_id", "embedding")
    assert rows(topk.top_k(ready, ready.where("vid % 20 = 0"), 20)) == _plain_topk(
        vectors, 20, lambda ids: [i for i in ids if i % 20 == 0])


@needs_tables
def test_topk_matches_sql(spark):
    ready = topk.integer_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", "embedding")
    assert rows(topk.top_k(ready, ready.where("vid % 20 = 0"), 20)) == _sql(
        topk.ORACLE_SQL, "embeddings")


# --------------------------------------------------------- decontamination

def _shingles(text, n=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _plain_contained(docs, items):
    out, have = set(), {}
    for j, text in items:
        if j is not None:
            have.setdefault(j, set()).update(_shingles(text))
    by_doc = {}
    for i, text in docs:
        if i is not None:
            by_doc.setdefault(i, set()).update(_shingles(text))
    for i, held in by_doc.items():
        for j, want in have.items():
            if want and len(want & held) / len(want) >= 0.8:
                out.add((i, j, len(want), len(want & held), len(want & held) / len(want)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [500_000, 7])
def test_decontamination_matches_brute_force(spark, block_rows):
    draw = random.Random(4)
    vocabulary = [f"w{n}" for n in range(300)]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    items = [(j, some(draw.randint(6, 60))) for j in range(30)]
    docs = []
    for i in range(120):
        words = some(draw.randint(0, 400))
        _, inside = items[i % 30]
        cut = int(len(inside) * draw.choice([0, 0.5, 0.75, 0.85, 0.95, 1]))
        docs.append((i, " ".join(words + [w.upper() + "," for w in inside[:cut]] + some(20))))
    docs += [(300, None), (301, ""), (None, "a b"), (302, "two words"), (302, "two words"),
             (303, LONG + " " + " ".join(items[0][1]))]
    items = [(j, " ".join(w)) for j, w in items] + [(90, ""), (91, None), (None, "x"),
                                                   (92, "Two, words!"), (92, "Two, words!")]
    frame = spark.createDataFrame([(j, t, 1) for j, t in items], "item_id long, text string, h int")
    got = rows(decontaminate.contaminated(documents(spark, docs), frame, block_rows=block_rows))
    assert got == _plain_contained(docs, items) and len(got) > 40
    assert rows(decontaminate.contaminated(documents(spark, docs[:3]), frame.limit(0))) == []
    assert rows(decontaminate.contaminated(documents(spark, []), frame)) == []
    kept = decontaminate.remove_contaminated(documents(spark, docs), frame)
    assert kept.count() == sum(i not in {g[0] for g in got} for i, _ in docs)


@needs_tables
def test_decontamination_matches_sql(spark):
    got = rows(decontaminate.contaminated(spark.read.parquet(f"{SF}/documents.parquet"),
                                          spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert got == _sql(decontaminate.ORACLE_SQL, "documents", "benchmark")


def test_decontamination_judges_rows_without_an_id(spark):
    passage, other = ("one two three four five six seven", "seven six five four three two one")
    docs = [(None, f"so {passage} it"), (None, "something else, not an item at all"), (1, passage),
            (None, f"{other} x"), (2, f"y {other}"), (None, None)]
    items = spark.createDataFrame([(5, passage), (None, other)], "item_id long, text string")
    kept = decontaminate.remove_contaminated(documents(spark, docs), items).collect()
    assert sorted((r["text"] or "") for r in kept) == ["", "something else, not an item at all"]


# --------------------------------------------------------------------- PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    values = [int(c) if n % 2 == 0 else sum(divmod(2 * int(c), 10))
              for n, c in enumerate(reversed(digits))]
    return sum(values) % 10 == 0


def _base(text):
    found = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                found.append((m.start(), n, m.end(), kind))
    return sorted(found)


def test_pii_base_spans_match_plain_patterns(spark):
    draw = random.Random(4)
    parts = ["a@b.c", "a", "_", "@", "x-y", ".", "1.2.3.4", "256.1.1.1", "001.2.3.04", " ", "é", "😀",
             "4111 1111 1111 1111", "+1 (555) 010-2345", "+", "-", "(", "12", "0", "\n", "%",
             "a.b@c", "m@n.o_p@q.r", "é@b.cd", "9" * 16]
    texts = [(n, "".join(draw.choice(parts) for _ in range(draw.randint(0, 14))))
             for n in range(800)]
    texts += [(9000, ""), (9001, None), (9002, "1" * 50_000), (9003, "a" * 50_000),
              (9004, "1 " * 10_000), (9005, "a.b@" * 5000), (9006, "+" + "1-" * 9000),
              (9007, "a@b.c"), (9007, "a@b.c"), (None, "a@b.c")]
    got = rows(pii.contract_columns(pii.find(documents(spark, texts))))
    want = []
    for i, text in texts:
        spans = _base(text)
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        want.append((i, *[sum(x[3] == k for x in spans) for k in BASE],
                     hashlib.sha256(listed.encode()).hexdigest(), listed))
    assert got == sorted(want, key=repr)
    assert pii.find(documents(spark, [])).count() == 0


def test_pii_bootstrap_finds_unseen_identifiers(spark):
    texts = [(n, f"hello my mail: user{n}@mail.com bye") for n in range(40)]
    texts += [(100 + n, f"so my mail: bob{n}@localhost ok") for n in range(3)]
    texts += [(200, "order no 12345678 x"), (201, "then bob1@localhost wrote"), (202, "x@nowhere y")]
    got = {r["doc_id"]: r["spans"] for r in pii.contract_columns(
        pii.find(documents(spark, texts))).collect()}
    assert got[100] == "email:12:26" and got[201] == "email:5:19"
    assert got[200] == "" and got[202] == "" and got[0] == "email:15:29"


def test_pii_candidates_beside_other_words_with_digits(spark):
    texts = [(n, f"hello my mail: user{n}@mail.com bye") for n in range(40)]
    texts += [(50 + n, f"so phone +1 555 010 20{n} ok") for n in range(10, 50)]
    texts += [(100, "so my mail: bob@localhost 555-0100 then"),
              (101, "phone 555 010 9999 a1 x"), (102, "my mail: amy@localhost,+15550102010 bye"),
              (103, "so a@b.com phone 555-0177 ok")]
    got = {r["doc_id"]: r["spans"] for r in pii.contract_columns(
        pii.find(documents(spark, texts))).collect()}
    assert got[100] == "email:12:25"
    assert got[101] == "phone:6:18"
    assert got[102] == "email:9:22,phone:23:35"
    assert got[103] == "email:3:10,phone:17:25"


def test_pii_goes_on_until_a_round_finds_none(spark):
    """Every step's words are known only by the identifiers of the step before."""
    texts = [(n, f"w0 s{n}@mail.com") for n in range(40)]
    for step in range(7):
        texts += [(1000 * step + n, f"{'abcdefgh'[step]}w x{step}n{n}@host") for n in range(100, 112)]
        if step:
            texts += [(1000 * step + n, f"{'abcdefgh'[step]}w x{step - 1}n{n}@host")
                      for n in range(100, 112)]
        else:
            texts += [(500 + n, f"aw s{n}@mail.com") for n in range(40)]
    texts += [(9999, f"{'abcdefgh'[6]}w last@host")]
    held = pii.find(documents(spark, texts), min_confidence=0.4, min_score=0.35)
    got = {r["doc_id"]: r["spans"] for r in pii.contract_columns(held).collect()}
    assert got[9999] == "email:3:12"


def _plain_bootstrap(texts, support=10, confidence=0.9, least=0.9):
    """Spans of base matches and of single words found by a plain bootstrap."""
    shapes = {"email": r"[^\s@]{1,64}@[^\s@]{1,255}", "phone": r"[+(]?[0-9][0-9()/.-]{0,40}"}
    base, loose = {}, {}
    for i, text in texts:
        base[i] = [(s, e, k, text[s:e]) for s, _, e, k in _base(text)]
        masked = text
        for s, e, _, _ in base[i]:
            masked = masked[:s] + "\n" * (e - s) + masked[e:]
        loose[i] = [(m.start(), m.end(), m.group()) for m in re.finditer(r"\S*[0-9@]\S*", masked)]
    def fits(kind, value):
        digits = len(re.sub("[^0-9]", "", value))
        return bool(re.fullmatch(shapes[kind], value)) and (kind != "phone" or 7 <= digits <= 15)

    by_pattern, by_value = {}, {}
    for i, text in texts:
        for s, e, *_, value in [*base[i], *loose[i]]:
            if (s, e, value) in loose[i] and not any(fits(k, value) for k in shapes):
                continue
            for side, words in (("before", text[:s].split()[-1:]), ("after", text[e:].split()[:1])):
                for word in words:
                    mark = (side, re.sub("[0-9]", "0", word.lower()))
                    by_pattern.setdefault(mark, set()).add(value)
                    if (s, e, value) in loose[i]:
                        by_value.setdefault(value, set()).add(mark)
    known = {(v, k) for spans in base.values() for _, _, k, v in spans}
    while True:
        rate = {}
        for mark, values in by_pattern.items():
            for kind in shapes:
                n = sum((v, kind) in known for v in values)
                if n >= support and n / len(values) >= confidence:
                    rate[mark, kind] = n / len(values)
        fresh = set()
        for value, marks in by_value.items():
            for kind in shapes:
                miss = 1.0
                for mark in marks:
                    miss *= 1 - rate.get((mark, kind), 0)
                if fits(kind, value) and 1 - miss >= least and (value, kind) not in known:
                    fresh.add((value, kind))
        if not fresh:
            return {i: {(k, s, e) for s, e, k, _ in base[i]}
                    | {(k, s, e) for s, e, v in loose[i] for k in shapes if (v, k) in known}
                    for i, _ in texts}
        known |= fresh


def test_pii_recall_of_planted_identifiers(spark):
    """Unseen identifiers in learnt contexts are found, equal ones elsewhere are not."""
    draw = random.Random(8)
    prose = ["the", "house", "by", "lake", "quiet", "rooms", "and", "garden", "seen", "again"]
    before = {"email": ["mail:", "write-to", "inbox"], "phone": ["phone", "call", "tel."]}
    texts, planted, decoys = [], {}, {}
    for n in range(1500):
        words = [draw.choice(prose) for _ in range(draw.randint(8, 30))]
        kind = draw.choice(["email", "phone"])
        usual = {"email": f"user{n}@mail.com", "phone": f"+1555{n:07d}"}[kind]
        unseen = {"email": f"user{n}@intranet", "phone": f"555-{n:05d}"}[kind]
        lead, value, hold = draw.choices(
            [(draw.choice(before[kind]), usual, None), (draw.choice(before[kind]), unseen, planted),
             ("ref", f"774-{n:05d}", decoys)], [90, 6, 8])[0]
        words[4:4] = [lead, value]
        text = " ".join(words)
        texts.append((n, text))
        if hold is not None:
            at = text.index(value)
            hold[n] = (kind, at, at + len(value))
    got = {r["doc_id"]: {(k, int(s), int(e)) for k, s, e in (
        x.split(":") for x in r["spans"].split(",") if x)} for r in pii.contract_columns(
        pii.find(documents(spark, texts))).collect()}
    assert len(planted) > 60 and len(decoys) > 60
    assert sum(span in got[n] for n, span in planted.items()) >= 0.9 * len(planted)
    assert not any(got[n] for n in decoys)
    assert got == _plain_bootstrap(texts)


def test_pii_text_of_many_matches(spark):
    """Offsets hold in a long text, and the work per match does not grow with it."""
    text = " ".join(f"é😀 u{n}@h.co +1 555 {n:07d} x{n}" for n in range(10_000))
    begun = time.monotonic()
    row = pii.contract_columns(pii.find(documents(spark, [(1, text)]))).first()
    assert time.monotonic() - begun < 60
    listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in _base(text))
    assert row["n_email"] == row["n_phone"] == 10_000
    assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


# -------------------------------------------------------------------- WARC

def _pages(spark, extra=()):
    pages = [(n, f"http://h/{n}", f"<p>page {n} é</p>", "x") for n in range(0, 2600)]
    return spark.createDataFrame([*pages, *extra],
                                 "page_id long, url string, html string, file string")


def test_files_of_large_and_negative_page_ids(spark):
    ids = [9007199254741999, 9007199254741000, 2**63 - 1, -2**63, -1, -1000, -1001, 0, 999, 1000]
    got = warc.warc_records(_pages(spark).limit(0).union(spark.createDataFrame(
        [(n, "u", "h", "x") for n in ids], "page_id long, url string, html string, file string")))
    assert {r["page_id"]: (r["file"], r["slot"]) for r in got.collect()} == {
        n: divmod(n, 1000) for n in ids}


def test_audit_locates_damage(spark):
    extra = [(3000, None, None, "x"), (None, "u", "lost", "x"), (5, "http://h/5", "again", "x")]
    original = _pages(spark, extra)
    assert warc.audit(warc.warc_records(original), warc.warc_records(original)).count() == 0
    replica = _pages(spark, extra).where("page_id <> 2599").withColumn(
        "html", F.when(F.col("page_id").isin(5, 1700), F.reverse("html")).otherwise(F.col("html")))
    replica = replica.unionByName(spark.createDataFrame(
        [(9000, "u", "new", "x")], "page_id long, url string, html string, file string"))
    found = {r["page_id"]: r["status"] for r in warc.audit(
        warc.warc_records(original), warc.warc_records(replica)).collect()}
    assert found == {5: "changed", 1700: "changed", 2599: "missing", 9000: "extra"}


def test_audit_reports_moved_records(spark):
    original = _pages(spark).where("page_id < 40")
    found = {r["page_id"]: r["status"] for r in warc.audit(
        warc.warc_records(original), warc.warc_records(original.where("page_id <> 20"))).collect()}
    assert found == {20: "missing", **{n: "moved" for n in range(21, 40)}}
    empty = original.limit(0)
    assert warc.audit(warc.warc_records(empty), warc.warc_records(empty)).count() == 0


@needs_tables
def test_audit_matches_sql(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = rows(warc.audit(warc.warc_records(pages), warc.warc_records(warc.damaged_copy(pages))))
    assert got == _sql(warc.ORACLE_SQL, "pages")
