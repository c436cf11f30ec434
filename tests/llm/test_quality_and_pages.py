import collections
import random
import re

import numpy as np
import pytest

from tidewater.llm.page_diff import FURNITURE, _repeated, common_lines, extract_text, page_lines
from tidewater.llm.quality_trees import COUNTS, FEATURES, fit, quality_rules, statistics, train
from tidewater.llm.storage import shared_folder

SCHEMA = "doc_id long, text string, kept string, y int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, marked, seen, dup = collections.Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            marked.update(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)]


def test_statistics_equal_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aé中# |\n\t \x1c") for _ in range(rng.randint(0, 120))) for _ in range(2000)]
    texts += [None, "", " ", "a b c d e a b c d e", "x " * 300, "ab" * 1_500_000 + " c"]
    counts, _ = statistics(texts)
    assert counts.tolist() == [brute(t) for t in texts]


def test_trees_keep_the_constraint_and_fit():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3))
    y = (np.sin(2 * x[:, 0]) - x[:, 1] + rng.normal(size=3000) * 0.3 > 0).astype(float)
    model = fit(x[:2000], y[:2000], [0, -1, 0])
    assert ((model.odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.85
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 1] = np.tile(np.linspace(-3, 3, 40), 50)
    assert (np.diff(model.odds(grid).reshape(50, 40), axis=1) <= 1e-9).all()
    assert fit(x[:0], y[:0], [0, 0, 0]).odds(x[:3]).tolist() == [5.0] * 3
    assert (fit(x[:9], np.ones(9), [0, 0, 0]).odds(x[:3]) > 0).all()


def test_verdicts_on_held_out_labels(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeghinorst") for _ in range(rng.randint(2, 9)))
    rows, labels = [], []
    for i in range(600):
        good = i % 4 > 0
        words = [word() + ("" if good else rng.choice(["$$$", "***", " |"])) for _ in range(rng.randint(20, 120))]
        rows.append((i, " ".join(words), "x", 1))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame([*rows, (None, None, None, None), (700, "", "x", 1), (700, "", "x", 1), (701, "a b", "x", 1)], SCHEMA)
    labelled = spark.createDataFrame([*labels[:300], (None, 1, 0), (1, None, 0), (2, 7, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    judged = quality_rules(docs, train(docs, labelled, sample_rows=200))
    assert judged.columns == [*docs.columns, "quality"]
    got = {r.doc_id: r.quality for r in judged.collect()}
    assert all(got[i].kept == (i % 4 > 0) for i in range(300, 600))
    for key, text in ((None, None), (700, ""), (701, "a b")):
        assert got[key].base_failed and not got[key].kept and [got[key][c] for c in COUNTS] == brute(text)
    assert quality_rules(docs.limit(0), train(docs, labelled.limit(0))).isEmpty()
    with pytest.raises(ValueError):
        quality_rules(docs, train(docs, labelled), result_col="kept")
    assert len(FEATURES) == 8


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_lines_are_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(3)
    for _ in range(1500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = common_lines(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) == lcs(a, b)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li>Home<li>About</ul></nav><div class="ad">Buy &amp; win</div><div>Welcome to the site</div>{body}
<div>All rights reserved</div><footer>&copy; us</footer></body></html>"""


def test_main_text(spark):
    article = "<article><h1>Title &lt;{0}&gt;</h1><p>First <b>bo</b>ld\n\n words<br>line<p>Second {0}.<form>Name</form><section id=comments><p>Nice!</p></section></article>"
    pages = [(i, f"http://h.org/a/{i}", PAGE.format(body=article.format(i))) for i in range(5)]
    plain = "<div>Own text {0}</div><p>More of {0}</p>"  # no article: furniture is what neighbours share
    pages += [(10 + i, f"http://g.org/b/{i}", PAGE.format(body=plain.format(i))) for i in range(3)]
    pages += [(20, "http://alone.org/", PAGE.format(body="<article>Only</article>")), (21, None, None), (22, "http://h.org/a/9", ""), (23, "x", "<p>a&nbsp;b &eacute; <!-- no --> &amp"),
              (24, "http://twins.org/1", "<main><p>Same</p></main>"), (25, "http://twins.org/2", "<main><p>Same</p></main>"), (0, *pages[0][1:])]
    frame = spark.createDataFrame([(*p, "x", "k") for p in pages], "page_id long, url string, html string, lines string, key string").repartition(3)
    out = extract_text(frame, shared_folder(spark, "test"))
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.page_id].append(r.text)
    want = {i: [f"Title <{i}> First bold words line Second {i}."] for i in range(5)} | {10 + i: [f"Own text {i} More of {i}"] for i in range(3)}
    want[0] *= 2
    assert {k: v for k, v in got.items() if k < 20} == want
    assert got[20] == ["Only"] and got[21] == got[22] == [""] and got[23] == ["a b é &"]
    assert got[24] == got[25] == ["Same"]
    assert extract_text(frame.limit(0), shared_folder(spark, "test")).isEmpty()


def test_odd_markup():
    for html in ("<", "<a", "<!", "<!--", "<![if x]>y", "</", "</p", "&#xFFFFFFFF;", "<script>x", "<p " + "a=" * 5000, "<b>" * 5000 + "x", "\0<p>\0"):
        assert isinstance(page_lines(html), list)


def lines(html):
    return [line for line, _ in page_lines(html)]


def test_pages_without_end_tags_of_the_head():
    for html in ("<html><head><title>T</title><meta charset=utf-8><body><p>Text</html>", "<head><title>T</title><p>Text", "<title>T</title><p>Text</p>",
                 "<html><head><title>T<body><p>Text", "<head><title>T<meta charset=utf-8><link rel=x></head><p>Text", "<head><style>p{}</style><div>Text</div>",
                 "<head><script>var a='<body>'</script><body>Text", "<head><title>T</title>\n Text", "<head><noscript><link rel=x><body><p>Text",
                 "<head><title>T</title></head><body><head><p>Text</p>", "<head><title>A <b>bold</b> title</title></head><p>Text"):
        assert lines(html) == ["Text"], html


def test_text_goes_on_after_odd_declarations():
    for odd in ("<![ x]>", "<![foo[y]]>", "<![endif]-->", "<![if x]>", "<![CDATA[y]]>", "<![>", "<!foo [ z>", "<![temp>", "<!>", "<!DOCTYPE [x>", "<![if y>"):
        got = lines(f"<p>Before</p>{odd}<p>After ]></p><p>]]></p>")
        assert got[0] == "Before" and got[-2:] == ["After ]>", "]]>"], odd
    rng = random.Random(8)
    pieces = ["<!", "<![", "[", "]", ">", "<", "</", "<p>", "</p", "--", "<!--", "&#", "&", ";", "x", " ", "if", "cdata", "'", '"', "=", "<?", "/", "<title>", "<script>", "<head>", "<body>", "\n"]
    for _ in range(3000):
        page_lines("".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))))


def main_lines(html):
    return [line for line, kind in page_lines(html) if kind & 3 != FURNITURE]


def test_a_class_name_does_not_hide_an_article():
    for html in ('<div class="layout has-sidebar"><article><p>Text</p></article></div>', '<article class="post comments-open"><p>Text</p></article>',
                 '<div id="page" class="site no-sidebar"><main>Text</main></div>', '<div class="widget"><div id=content class="post share"><article>Text</article></div></div>',
                 "<form id=aspnet><main><p>Text</p></main></form>", '<article class="related" id="comment" role="form"><p>Text</p></article>',
                 '<div class="no-ad">Text</div>', '<div class="sidebar"><p>Text</p><div class="ad">Buy</div><article hidden>No</article></div><article>Text</article>'):
        assert main_lines(html) == ["Text"], html
    assert main_lines('<div class="big AD">Buy</div><section id=comments>Nice</section><div role=search>Find</div><form>Name</form><header>Site</header><p>Text</p>') == ["Text"]
    assert main_lines('<article><p>Text <span class="ad">Buy</span><div class="share buttons">Tell</div><p>More</p></article>') == ["Text", "More"]


def texts(spark, pages):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in extract_text(frame, shared_folder(spark, "test")).collect()}


def test_copies_do_not_empty_each_other(spark):
    page = "<nav>N{1}</nav><div>Site</div><p>Own text {0}</p><div>Rights</div>"
    pages = [(f"http://two.org/a?ref={i}", page.format("a", i)) for i in range(2)]
    pages += [(f"http://many.org/m/{i}", page.format("m", 0)) for i in range(9)]
    pages += [(f"http://many.org/{'lz'[i]}", page.format(i, 0)) for i in range(2)]
    got = texts(spark, pages)
    assert [got[i] for i in range(2)] == ["Site Own text a Rights"] * 2  # nothing to tell furniture by
    assert [got[i] for i in range(2, 11)] == ["Own text m"] * 9 and [got[11], got[12]] == ["Own text 0", "Own text 1"]


def test_differencing_decides_inside_and_outside_articles(spark):
    inside = "<article><header><p>The Daily</header><p>Own {0} text<ul><li><a href=x>Most read</a></ul><p>More of {0}<p>Subscribe now</article>"
    teasers = "<div>Site</div><article>Teaser one</article><article>Teaser two</article><div id=text><p>Main text {0} goes on here<p>and ends {0}</div>"
    story = "<div>Shown {0}</div><article><p>One paragraph of some length<p>{1}<p>and another one, no shorter</article>"
    pages = [(f"http://inside.org/{i}", inside.format(i)) for i in range(5)]
    pages += [(f"http://teasers.org/{i}", teasers.format(i)) for i in range(5)]
    pages += [(f"http://pair.org/{i}", inside.format(i)) for i in range(2)]
    pages += [(f"http://versions.org/{i}", story.format(i, "old" if i else "new")) for i in range(3)]
    pages += [("http://alone.org/", teasers.format(0)), ("http://one.org/", f"<div>Short</div><article>Teaser</article><p>{'Main text ' * 8}</p>")]
    got = texts(spark, pages)
    assert [got[i] for i in range(5)] == [f"Own {i} text More of {i}" for i in range(5)]
    assert [got[5 + i] for i in range(5)] == [f"Main text {i} goes on here and ends {i}" for i in range(5)]
    assert [got[10], got[11]] == ["Own 0 text More of 0", "Own 1 text More of 1"]
    assert [got[12 + i] for i in range(3)] == [f"Shown {i} One paragraph of some length {'old' if i else 'new'} and another one, no shorter" for i in range(3)]
    assert got[15] == "Site Teaser one Teaser two Main text 0 goes on here and ends 0" and got[16] == "Teaser " + ("Main text " * 8).strip()


def test_closed_svg_and_forms_around_pages(spark):
    for html in ("<main><svg/><p>Text</p></main>", "<div><svg viewBox='0 0 1 1'/><math/>Text</div>", "<p><svg><path d=x /><g><circle/></g></svg>Text</p>",
                 "<form id=aspnetForm><div>Text</div></form>", "<form><nav>N</nav><p>Text</p></form><footer>F</footer>"):
        assert main_lines(html) == ["Text"], html
    assert main_lines("<form class=newsletter>Sign up</form>") == [] and main_lines("<form>Name</form><p>Text</p>") == ["Text"]
    server = "<form id=aspnetForm><div>Menu</div><p>Own {0} text</p><div>Imprint</div></form>"
    pages = [(f"http://server.org/{i}", server.format(i)) for i in range(5)]
    pages += [("http://alone.org/", "<div>Welcome</div><h1>Storm hits</h1><article><p>Story</p></article><p>End.</p><div>Rights</div>")]
    got = texts(spark, pages)
    assert [got[i] for i in range(5)] == [f"Own {i} text" for i in range(5)] and got[5] == "Storm hits Story End."


def test_compound_names_are_furniture_beside_text():
    for html in ('<p>Text</p><div class="comment-list"><p>Nice!</p></div><div class="site-footer">Us</div>', '<div id=main_nav>Home</div><p>Text</p><ul class="post-comments"><li>A<li>B</ul>',
                 '<div class="ad-page"><p>Text</p></div>', '<div class="ad-free"><p>Text</p></div>', '<div class="comment-page"><div class="sidebar-left">S</div><article>Text</article></div>'):
        assert [x for x in main_lines(html) if x != "S"] == ["Text"], html


def test_near_copies_without_article_keep_their_paragraphs(spark):
    page = "<div>Menu</div>" + "".join(f"<p>Paragraph {i} of a long report, the same in all editions</p>" for i in range(9)) + "<p>Edition {0}</p><div>Imprint</div>"
    short = "<div>Menu</div><p>Subscribe</p><p>Own text {0} which is much longer than what the pages have in common</p>"
    pages = [(f"http://editions.org/{i}", page.format(i)) for i in range(5)] + [(f"http://short.org/{i}", short.format(i)) for i in range(3)]
    got = texts(spark, pages)
    report = " ".join(f"Paragraph {i} of a long report, the same in all editions" for i in range(9))
    assert [got[i] for i in range(5)] == [f"{report} Edition {i}" for i in range(5)]
    assert [got[5 + i] for i in range(3)] == [f"Own text {i} which is much longer than what the pages have in common" for i in range(3)]


def test_lines_are_counted_by_what_removes_them(spark):
    page = "<nav>Home</nav><div>Site</div><p>Own text {0}</p><div class=comments>Nice {0}</div><footer>Us</footer>"
    pages = [(i, f"http://h.org/{i}", page.format(i)) for i in range(4)] + [(4, "http://h.org/0?x", page.format(0).replace("Home", "Start")), (5, "http://one.org/", page.format(5)), (6, None, None)]
    out = extract_text(spark.createDataFrame(pages, "page_id long, url string, html string"), shared_folder(spark, "test")).collect()
    got = {r.page_id: (r.text, r.n_lines, r.n_shared, r.n_marked) for r in out}
    assert all(got[i] == (f"Own text {i}", 5, 3, 1) for i in range(1, 4)) and got[6] == ("", 0, 0, 0)
    assert got[5] == ("Site Own text 5", 5, 0, 3)
    # Copies with other furniture: only what their one representative shares is shared.
    assert got[0][0] == got[4][0] == "Own text 0" and {got[0][2:], got[4][2:]} <= {(3, 1), (2, 2)}


def test_rules_of_a_run_equal_brute_force():
    rng = random.Random(9)

    def weight(page, keep):
        return sum(size for line, size, kind in page if keep(line, kind))

    def brute_run(run):
        out = []
        for i, page in enumerate(run):
            held = [{line for line, _, _ in other} for other in run]

            def alike(a, b, which):
                both = weight(run[a], lambda line, kind: line in held[b] and which(kind))
                return both > 0 and both >= 3 * weight(run[a], lambda line, kind: line not in held[b] and kind & 3 != FURNITURE)

            gone, told = set(), set()
            for j in {i - 1, i + 1} & set(range(len(run))):
                same = alike(i, j, lambda k: k == 16) or alike(j, i, lambda k: k == 16)
                gone |= {line for line, _, kind in page if line in held[j] and (kind == 0 or kind == 16 and not same)}
                told |= {line for line, _, kind in page if line in held[j] and kind == FURNITURE}
            rest = [j for j in range(len(run)) if j != i and not alike(i, j, lambda k: k & 3 == 1) and not alike(j, i, lambda k: k & 3 == 1)]
            inside = [(line, kind) for line, _, kind in page if kind & 3 == 1]
            common = {line for line, _ in inside if rest and len(rest) >= min(2, len(run) - 1) and all(line in held[j] for j in rest)}
            stretches = []  # the lines of each article
            for line, kind in inside:
                if kind & 8 or not stretches:
                    stretches.append((bool(kind & 8), []))
                stretches[-1][1].append(line)
                if kind & 4 and line in common:
                    gone.add(line)
            for begun, lines in stretches:
                for side in ([lines] if begun else []) + [lines[::-1]]:
                    for line in side:
                        if line not in common:
                            break
                        gone.add(line)
            own = [line for line, _, kind in page if kind & 3 != FURNITURE]
            out.append((sorted(own.index(x) for x in gone), sorted(told)))
        return out

    for _ in range(4000):
        # Lines stand in one order and once in a page, so a longest common subsequence is what two pages share.
        kinds = {line: rng.choice((0, 0, 16, 16, 1, 1, 1, 1 | 4, 1 | 8, FURNITURE)) for line in range(14)}
        run = [[(line, rng.choice((line % 5 + 1,)), kinds[line]) for line in range(14) if rng.random() < rng.choice((0.4, 0.7, 0.95))] for _ in range(rng.randint(2, 7))]
        run = [page or [(0, 1, kinds[0])] for page in run]
        given = [([line for line, _, _ in page], [size for _, size, _ in page], bytes(kind for _, _, kind in page)) for page in run]
        assert _repeated(given) == brute_run(run)
