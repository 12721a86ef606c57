import random
import re
from html import unescape
from itertools import combinations

import pytest

from gridloom.llm import page_text as P
from gridloom.llm._shared import Scratch, numbered
from gridloom.llm.html_lines import lines

SF = "/root/testdata/sf0.001"


def texts(html):
    return [x.text for x in lines(html)]


def test_blocks_and_white_space():
    assert texts("<p>a\n b&nbsp;c<br>d</p><div>e<b>f</b> <i>g</i><p>h<p>i</div>j") == ["a b c d", "ef g", "h", "i", "j"]
    assert texts("<ul><li>one<li>two<ul><li>in</ul>after</ul><table><tr><td>x<td>y<tr><th>z</table>") == ["one", "two", "in", "after", "x y", "z"]
    assert texts("&lt;p&gt; &amp; &#233;&#x1F600; &copy 5 < 6 <3 a<b") == ["<p> & é😀 © 5 < 6 <3 a"]
    assert texts("<h1>A<h2>B</h2><p>x<h3>C</h3>") == ["A", "B", "x", "C"]


def test_what_has_no_text():
    html = '<!DOCTYPE html><head><title>t</title></head><script>if (a < b) "</p>"</SCRIPT ><style>x</style><!-- <p>no</p> --><?php ?><![CDATA[x]]><textarea><p>t</textarea><p>yes</p>'
    assert [x.text for x in lines(html) if not x.furniture] == ["yes"]
    assert texts("<p>a</p><!-- never ends <p>b</p>") == ["a"] and texts("<p>a</p><script>b") == ["a"]
    assert texts('<p>a</p><a href="x') == ["a"] and texts("<p title='>'>a</p>") == ["a"] and texts('<p title="x>a</p>b') == ["a", "b"]
    assert texts("") == [] and texts("plain") == ["plain"]


PAGE = """<html><body class="has-sidebar comments-open"><header><h1>Site</h1></header><nav><ul><li><a href=1>Home</a></ul></nav>
<div id="cookie-banner">We use cookies.</div><div class="ad">Buy this.</div>
<article class="post"><header><h1>Head</h1></header><p>First &amp; last.</p><div class="share-buttons"><a>Share it with all</a></div><p class="advert">Sponsored words.</p>
<form><label>Mail</label><input></form><h2>More</h2><p>Second<br>part.</p><aside>Aside text.</aside><section class="comments"><article class="comment"><p>Nice post!</p></article></section></article>
<div class="sidebar"><p>Side text that is long enough.</p></div><div role="contentinfo">Imprint</div><p hidden>unseen</p><footer>&copy; us</footer>"""


def test_furniture_goes():
    assert P.main_lines(lines(PAGE), set()) == ["Head", "First & last.", "More", "Second part."]


def test_an_article_in_an_unclosed_advert_stays():
    assert P.main_lines(lines("<body><div class='ad'>Buy.<article><p>The text goes on.</p></article>"), set()) == ["The text goes on."]
    assert P.main_lines(lines("<div class='comments'><article id=c1><p>I like it.</p></article></div><p>Text.</p>"), set()) == ["Text."]


def test_a_page_without_an_article_loses_menus():
    assert P.main_lines(lines("<div><a>One</a> <a>Two</a></div><div>Text with <a>a link</a> in it.</div>"), set()) == ["Text with a link in it."]


def brute_length(a, b):
    best = 0
    for n in range(min(len(a), len(b)), 0, -1):
        subs = {tuple(a[i] for i in c) for c in combinations(range(len(a)), n)}
        if any(tuple(b[i] for i in c) in subs for c in combinations(range(len(b)), n)):
            return n
    return best


@pytest.mark.parametrize("table", [1 << 26, 4, 1])
def test_common_subsequence(monkeypatch, table):
    monkeypatch.setattr(P, "_TABLE", table)
    r = random.Random(table)
    for _ in range(150):
        a, b = ([r.randint(0, 3) for _ in range(r.randint(0, 8))] for _ in range(2))
        found = P.common(a, b)
        assert found == sorted(set(found)) and len(found) == brute_length(a, b)
        it = iter(b)
        assert all(a[i] in it for i in found)


def test_long_sequences_are_aligned_in_parts(monkeypatch):
    r = random.Random(3)
    a = [r.randint(0, 40) for _ in range(700)]
    b = [x for x in a if r.random() < 0.8] + [r.randint(0, 40) for _ in range(100)]
    whole = len(P.common(a, b))
    monkeypatch.setattr(P, "_TABLE", 1000)
    assert len(P.common(a, b)) == whole


def site(k, body, frame="Frame line one that all pages have|Our imprint is here"):
    top, bottom = frame.split("|")
    return f"<div>{top}</div><div>{body}</div><div>{bottom}</div>"


COLUMNS = "page_id long, url string, html string"


def run(spark, rows):
    return {r["page_id"]: (r["text"], r["n_chars"], r["n_shared"]) for r in P.main_text(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()}


def test_shared_lines_go(spark):
    rows = [(i, f"http://Host.example/a/{i}", site(i, f"Own sentence number {i}.")) for i in range(40)]
    rows += [(100 + i, f"http://other.example/a/{i}", site(i, f"Other text {i}.", "Another frame|The end")) for i in range(3)]
    rows += [(200, "http://alone.example/", site(0, "Alone.")), (201, None, site(0, "No host.")), (202, "no url", None)]
    got = run(spark, rows)
    for i in range(40):
        assert got[i] == (f"Own sentence number {i}.", len(f"Own sentence number {i}."), 2)
    assert got[101][0] == "Other text 1."
    assert got[200][0] == "Frame line one that all pages have\nAlone.\nOur imprint is here"
    assert got[201][0].startswith("Frame") and got[202] == ("", 0, 0)


def test_copies_are_no_pairs(spark):
    long = "A text of some length that is the page itself and stays, whatever happens to it."
    rows = [(1, "http://h.example/x?a=1", site(0, long)), (2, "http://h.example/x?a=2", site(0, long)), (3, "http://h.example/x?a=1", site(0, long)), (4, "http://h.example/y", site(0, "Quite another text on a page that lies next to it."))]
    got = run(spark, rows)
    assert {got[i][0] for i in (1, 2, 3)} == {long}


def test_sentences_of_an_article_stay_and_labels_go(spark):
    page = "<article><h1>Intro</h1><p>A sentence that both have.</p><div>Read more</div><p>Own {0} words, many of them here.</p><p>Still {0} more own words than before.</p></article>"
    got = run(spark, [(i, f"http://h.example/{i}", page.format(f"number{i}")) for i in range(4)])
    assert got[2][0] == "Intro\nA sentence that both have.\nOwn number2 words, many of them here.\nStill number2 more own words than before."


def test_pairs_over_blocks_equal_one_block(spark, monkeypatch):
    r = random.Random(1)
    rows = [(i, f"http://h{r.randint(0, 2)}.example/{r.choice('abc')}/{i}", site(i, " ".join(r.choices("abcdef", k=9)), f"Top {r.randint(0, 2)} of all|End {r.randint(0, 3)}")) for i in range(120)]
    whole = run(spark, rows)
    monkeypatch.setattr(P, "BLOCK", 7)
    assert run(spark, rows) == whole


def test_row_numbers(spark):
    scratch = Scratch(spark, "numbers")
    rows = spark.range(0, 1000).selectExpr("id % 7 as g", "1000 - id as x")
    got = [(r["g"], r["x"]) for r in numbered(rows, ["g", "x"], "no", scratch).orderBy("no").collect()]
    assert got == sorted(got) and len(got) == 1000
    assert [r["no"] for r in numbered(rows, ["g", "x"], "no", scratch).orderBy("no").collect()] == list(range(1000))
    scratch.clear()


def test_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in P.op11_page_text(spark, SF).collect()}
    for page, html in pages.items():
        article = re.sub(r"</?b>", "", html[html.index("<article>") + 9 : html.index("</article>")])
        parts = [" ".join(unescape(x.replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[page] == "\n".join(x for x in parts if x)


def test_empty_table_clashing_names_and_a_very_long_page(spark):
    assert P.main_text(spark.createDataFrame([], COLUMNS)).count() == 0
    body = "".join(f"<p>Sentence number {i} of a long page.</p>" for i in range(30_000))
    wide = spark.createDataFrame([(1, "http://h.example/1", body, "m", 3), (2, "http://h.example/2", body.replace("long", "short"), "m", 3), (2, "http://h.example/2", None, "m", 3)], COLUMNS + ", mark string, no int")
    got = P.main_text(wide).collect()
    assert sorted(r["n_chars"] for r in got)[0] == 0 and max(r["text"].count("\n") for r in got) == 29_999 and len(got) == 3
