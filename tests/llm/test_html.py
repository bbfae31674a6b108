from helpers import table

from kerbstone.llm import html

FRAME = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
    "<header>Site</header><nav><ul><li><a href='/a'>Menu</a></ul></nav><div class=\"cookie-notice\">We use cookies</div>"
    "<article><header><h1>Head &amp; line</h1></header><p><b>One\n\t two&nbsp;three<br>four<p>Fi<i>ve</i></p>"
    "<form><input name=q>Find</form><div id=comments><p>First!</p></div><p>{}</p></article>"
    "<aside>Side</aside><footer>&copy; me</footer></body></html>"
)


def texts(spark, pages):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r["main_text"] for r in html.extract(frame).orderBy("page_id").collect()]


def test_articles(spark):
    pages = [(f"https://a.org/{i}", FRAME.format(f"last {i}")) for i in range(6)]
    pages += [(None, FRAME.format("x > y & z")), ("no url", None), ("https://b.org", "")]
    got = texts(spark, pages)
    assert got[0] == "Head & line\nOne two three four\nFive\nlast 0"
    assert got[6].endswith("\nx > y & z") and got[7:] == ["", ""]


def test_the_template_decides_without_an_article(spark):
    page = (
        "<body><div><a href=/>Home</a> <a href=/n>News {0}</a></div><div><p>Always the same welcome</p>"
        "<p>Own story number {0}, told at length.</p></div><div><span>Imprint</span></div></body>"
    )
    got = texts(spark, [(f"https://c.org/{i}", page.format(i)) for i in range(8)])
    assert got == [f"Own story number {i}, told at length." for i in range(8)]
    # one page alone has no template and is one slot: only furniture goes
    alone = texts(spark, [("https://d.org", page.format(1))])
    assert alone == ["Home News 1\nAlways the same welcome\nOwn story number 1, told at length.\nImprint"]


def test_repeated_articles_are_not_template(spark):
    page = "<article><p>A story that everyone copies.</p></article>"
    assert texts(spark, [("https://e.org/x", page)] * 9) == ["A story that everyone copies."] * 9


def test_broken_markup(spark):
    pages = ["plain", "<p>a<p>b", "a < b", "<article><p>x", "<!-- <p>no</p>", "<p title=\"a>b\">c</p>", "<script>x",
             "<article><p>" + "word " * 100_000 + "</p>", "<p>a</b></i></p><p>b</div>"]
    got = texts(spark, [("u", p) for p in pages])
    assert got[:7] == ["plain", "a\nb", "a < b", "x", "", "c", ""]
    assert len(got[7]) == 499_999 and got[8] == "a\nb"


def test_given_table(spark):
    pages = table(spark, "pages")
    rows = html.extract(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        inside = r["html"].partition("<article>")[2].partition("</article>")[0]
        for tag in ("<h1>", "</h1>", "<p>", "</p>", "<b>", "</b>", "<br>"):
            inside = inside.replace(tag, "\n" if tag[-2] in "1p" else " " if "r" in tag else "")
        import html as entities
        lines = (" ".join(entities.unescape(x).split()) for x in inside.split("\n"))
        assert r["main_text"] == "\n".join(x for x in lines if x)
    assert html.extract(pages.limit(0)).count() == 0


def test_names_and_forms_around_the_article_do_not_drop_it():
    article = "<h1>Head</h1><p>The text of the page.</p><div class='ad'>buy</div>"
    for page in (
        f"<body class='single no-sidebar has-comments'><article>{article}</article></body>",
        f"<body class='nav'><article class='post related'>{article}</article></body>",
        f"<form id='aspnetForm'><div class='legal'><article>{article}</article></div></form>",
        f"<div class='share-price'><main class='widget'>{article}</main></div>",
        f"<form><p>x</p></form><article class='comment'>no</article><article>{article}</article>",
        f"<article>{article}<form>mail <input></form></article><div class='main-menu'>Home</div>",
        f"<form><div>{article}</div></form>",
    ):
        assert html.main_text(page, set()) == "Head\nThe text of the page.", page


def test_formulas_and_fallbacks_stay():
    page = ("<article>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds"
            "<object data='a'><p>a map</p></object><noscript><p>a chart</p></noscript></article>")
    assert html.main_text(page, set()) == "so x=1 holds\na map\na chart"


def test_names_by_words_on_blocks_only():
    page = (
        "<article><p>One <span class=share>shared</span> line <em class='ad-word'>stays</em>.</p>"
        "<ol class='comment-list'><li class='comment-body'>First!</li></ol><div class='cookie-notice'>We use cookies</div>"
        "<div class='ad-slot'>buy</div><div id='site_footer2'>imprint</div><div class='no-sidebar'>Wide text.</div>"
        "<div class='share-price'>Shares rose.</div><section class='story_ads2'>more ads</section>"
        "<div class='bad slots'>Kept.</div><p class='notice'>Note.</p></article>")
    assert html.main_text(page, set()) == "One shared line stays.\nWide text.\nShares rose.\nKept."


def test_deep_and_long_pages_take_time_in_proportion():
    import time
    import tracemalloc

    begun = time.process_time()
    pages = ["<span>" * 200_000 + "deep", "<div class=ad>" * 60_000 + "deep", "<b></i>" * 100_000 + "x",
             "<article>" + "<span><p>" * 50_000 + "y", "<select>" + "<option>" * 50_000]
    for page in pages:
        html.main_text(page, {1})
        html.page_tokens(page)
    assert time.process_time() - begun < 40
    tracemalloc.start()
    html.main_text("<span>" * 16_000, set())
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_template_equals_brute_force_over_whole_vectors(spark):
    """Classes from whole occurrence vectors, gathered here, are the ones that the sums stand for."""
    import random

    rng = random.Random(2)
    pages = []
    for i in range(40):
        parts = ["<div><p>welcome</p></div>", f"<div><p>story {i}</p></div>", "<ul><li>a</li><li>b</li></ul>",
                 "<p><i>now and then</i></p>" if rng.random() < 0.6 else "", "<h2>rare</h2>" if i % 7 == 0 else ""]
        pages.append(("https://h.org/%d" % i, "<body>" + "".join(parts) + "</body>"))
    frame = spark.createDataFrame([("h.org", p) for _, p in pages], "host string, html string")
    got = {r["host"]: set(r["template"]) for r in html.templates(frame, "html").collect()}
    vectors = {}
    for at, (_, page) in enumerate(pages):
        for token, n in html.page_tokens(page).items():
            vectors.setdefault(token, {})[at] = n
    classes = {}
    for token, vector in vectors.items():
        classes.setdefault(tuple(sorted(vector.items())), set()).add(token)
    want = set()
    for vector, tokens in classes.items():
        if len(vector) >= html.SHARE * len(pages) and len({pages[at][1] for at, _ in vector}) >= html.MIN_PAGES:
            want |= tokens
    assert got == {"h.org": want} and len(want) > 5


def test_clashing_columns_and_ties(spark):
    page = "<article>one</article><article>two</article>"
    frame = spark.createDataFrame([(1, "u", page, "x", "y", "z")], "page_id long, url string, html string, host string, main_text string, template string")
    row = html.extract(frame).first()
    assert (row["main_text"], row["host"], row["template"]) == ("one\ntwo", "x", "z")


STORY = (
    "<body><article><h1>Story {0}</h1><p>Told of {0}.</p><h2><a href='#i'>What <i>it</i> is</a></h2><p>Own text {0}.</p>"
    "<p>Always so said.</p><div><a href='/'>Home</a> | <a href='/n'>News</a></div>"
    "<ul><li><a href='/{0}'>See {0}</a><li><a href='/x'>Index</a></ul></article></body>"
)


def test_the_template_finds_menus_in_articles(spark):
    kept = "Story {0}\nTold of {0}.\nWhat it is\nOwn text {0}.\nAlways so said."
    got = texts(spark, [(f"https://i.org/{i}", STORY.format(i)) for i in range(8)])
    # links alone that repeat are a menu; a text, a heading or a list with a link of its own is content
    assert got == [kept.format(i) + f"\nSee {i}\nIndex" for i in range(8)]
    # copies of an article in differing frames are one article: its links are no menu
    copies = [(f"https://j.org/{i}", STORY.format("x").replace("<body>", f"<body><nav>{i}</nav>")) for i in range(8)]
    assert texts(spark, copies) == [kept.format("x") + "\nHome | News\nSee x\nIndex"] * 8
    # one page has no template, and an article of nothing but links keeps them
    assert texts(spark, [("https://k.org", STORY.format(1))]) == [kept.format(1) + "\nHome | News\nSee 1\nIndex"]
    index = "<nav>{0}</nav><article><div><a>One</a> <a>Two</a></div></article>"
    assert texts(spark, [(f"https://l.org/{i}", index.format(i)) for i in range(8)]) == ["One Two"] * 8


def test_menus_are_all_there_is_left_of_some_articles():
    menu = "<article><div><a>One</a> <a>Two</a></div></article>"
    every = set(html.page_tokens(menu))
    assert html.main_text(menu, every) == "One Two"
    assert html.main_text(f"{menu}<article><p>Own.</p></article>", every) == "Own."


def test_the_template_decides_around_the_article(spark):
    page = ("<main><div>Our site</div><h1>Title {0}</h1><article><p>Own {0}.</p><p>Our site</p></article>"
            "<div><p>Join our club</p></div></main>")
    got = texts(spark, [(f"https://m.org/{i}", page.format(i)) for i in range(6)])
    assert got == [f"Title {i}\nOwn {i}.\nOur site" for i in range(6)]
    alone = texts(spark, [("https://n.org", page.format(1))])
    assert alone == ["Our site\nTitle 1\nOwn 1.\nOur site\nJoin our club"]
    # without an article element the main one is the article: its texts stay
    plain = "<main><p>Always so said.</p><p>Own {0}.</p></main>"
    got = texts(spark, [(f"https://o.org/{i}", plain.format(i)) for i in range(6)])
    assert got == [f"Always so said.\nOwn {i}." for i in range(6)]


def test_slots_of_the_template_are_counted(spark):
    pages = [(0, "https://p.org/lone", STORY.format(0))] + [(i, "https://q.org/", STORY.format(i)) for i in range(1, 7)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["main_slots"] for r in html.extract(frame).collect()}
    # without a template the page is one slot; with it each element of the frame that holds text
    assert got.pop(0) == 1 and set(got.values()) == {8}


def test_tokens_without_a_place_in_their_class_are_no_template(spark):
    import itertools

    rows = ["<p><b>Alpha</b></p>", "<p><i>Beta</i></p>", "<p><u>Gamma</u></p>"]
    orders = list(itertools.permutations(rows))
    page = "<body><div><h2>Our site</h2></div>{}<h1>Story {}</h1><div><span>Imprint</span></div></body>"
    told = [f"Story {i}" for i in range(12)]
    # always in one order they are the template's, as are the frame's texts
    same = texts(spark, [(f"https://r.org/{i}", page.format("".join(rows), i)) for i in range(12)])
    assert same == told
    # in any order they are on every page, but have no place: each is first, second or last on a third of the pages
    mixed = texts(spark, [(f"https://s.org/{i}", page.format("".join(orders[i % 6]), i)) for i in range(12)])
    words = {r: r.split(">")[2].split("<")[0] for r in rows}
    assert mixed == ["\n".join([*(words[r] for r in orders[i % 6]), t]) for i, t in enumerate(told)]
    # a class with its own pages nests between the frame's tokens: now before, now after them it is none
    note = "<p><em>A note</em></p>"
    parts = ["<div><h2>Our site</h2></div>", "<h1>Story {}</h1>", "<div><span>Imprint</span></div>", "<div><s>End</s></div>"]

    def noted(i, at):
        return "".join([*parts[:at], note if i % 4 else "", *parts[at:]]).format(i)

    fixed = texts(spark, [(f"https://t.org/{i}", noted(i, 1)) for i in range(16)])
    assert fixed == [f"Story {i}" for i in range(16)]
    moved = texts(spark, [(f"https://u.org/{i}", noted(i, (0, 1, 3, 4)[i // 4])) for i in range(16)])
    assert sum("A note" in t for t in moved) == 12 and all(f"Story {i}" in t for i, t in enumerate(moved))


def test_places_by_hand():
    classes = [[1, 2, 3], [7, 8], [9]]
    at = lambda before, rank: (before << 32) + rank
    assert html.places([1, 7, 4, 2, 8, 3, 9], classes) == {
        1: at(0, 0), 2: at(0, 1), 3: at(0, 2), 7: at(1, 0), 8: at(1, 1), 9: at(3, 0)}
    assert html.places([], classes) == {} and html.places([5], [[1]]) == {}


def test_tokens_are_in_page_order():
    tokens = [*html.page_tokens("<div>one<p>two</p>three<p>two</p></div>four")]
    path = lambda *tags: __import__("functools").reduce(lambda a, t: html.number(t, a), tags, 0)
    div, p = path("div"), path("div", "p")
    assert tokens == [div, html.number("one", div), p, html.number("two", p), html.number("three", div), html.number("four", 0)]
