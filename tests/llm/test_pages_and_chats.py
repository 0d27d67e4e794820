"""The operators over pages and conversations, and their defined cases."""

from __future__ import annotations

import html
import re

import pytest

from forgemeter.llm import chat_snapshots, html_wrappers, merkle_fixity, queries

PAGES = "page_id long, url string, html string, host string, salt string"


def test_main_texts_of_all_pages(spark, sf_dir):
    got = {r.page_id: r for r in html_wrappers.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for page in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"(?s)<article>(.*?)</article>", page.html)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("no markup &amp; all", "no markup & all"),
        ("<header>Site</header><main><h1>T&eacute;</h1><p>One <b>t</b>wo<p>three<form>Mail</form></main><aside>More</aside>", "Té One two three"),
        ("<body class='has-sidebar'><div id=menu><a href=/>Home</a></div><div class='post-content'><h2>Head</h2>Text<br>next<ul><li>a<li>b</ul>"
         "<div class=\"comments\"><p>First!</p></div></div><div class='cookie-notice'>We use cookies</div></body>", "Head Text next a b"),
        ("<div><p>Long enough text of the page itself.</p><p>And more.</p></div><div><a href=x>link</a> <a href=y>link</a></div>", "Long enough text of the page itself. And more."),
        ("<article><header><h1>Title</h1></header><script>if (a<b) x()</script><p hidden>no</p><p>yes</p><!-- <p>not</p> --></article><footer>f</footer>", "Title yes"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_single_pages(page, want):
    assert html_wrappers.extract(page, None) == want


def test_wrapper_has_optional_and_repeated_parts_and_slots():
    a = html_wrappers.wrapper_of(html_wrappers.parse("<div class=x><h1>One</h1><p>a</p><p>b</p></div>"))
    b = html_wrappers.wrapper_of(html_wrappers.parse("<div class=x><h1>Two</h1><ul><li>i</li></ul><p>c</p></div>"))
    assert html_wrappers.expression(html_wrappers.merged(a, b)) == "<div.x><h1>#text</h1>(<ul><li>i</li></ul>)?(<p>#text</p>)+</div.x>"
    assert html_wrappers.merged(a, b)["kids"].keys() == html_wrappers.merged(b, a)["kids"].keys()


def test_host_wrapper_serves_pages_of_its_template(spark):
    rows = [(n, "http://h.example/x", f"<div class=shell><div class=lead><p>Story {n} goes on for a while here.</p></div><div class=tag>Always here</div></div>", "q", "q") for n in range(8)]
    got = html_wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.text for r in got} == {f"Story {n} goes on for a while here." for n in range(8)}


def extracted(pages):
    """The pages of one host through their common wrapper."""
    whole = None
    for page in pages:
        own = html_wrappers.wrapper_of(html_wrappers.parse(page))
        whole = html_wrappers.merged(whole, own) if whole else own
    return [html_wrappers.extract(page, html_wrappers.rules_of(whole)) for page in pages]


def test_text_of_copies_and_of_one_page_is_not_constant():
    def story(n):
        return f"Story {n} goes on for a while here, and longer than what is said above it."

    shell = "<article><div class=lead>{}</div><p>{}</p></article>"
    copies = [shell.format("Said before.", story("A"))] * 20
    others = [f"<article><p>{story(n)}</p></article>" for n in range(40)]
    assert extracted(copies + others) == [f"Said before. {story('A')}"] * 20 + [story(n) for n in range(40)]
    assert extracted(copies + others[:1])[0] == f"Said before. {story('A')}"
    repeated = "<article>" + "<div class=sep>Next part</div>" * 5 + f"<p>{story(0) * 3}</p></article>"
    assert extracted([repeated] + others)[0].startswith("Next part Next part Next part Next part Next part Story")
    same = "same " * 120
    ends = [shell.format(f"{same} end {n}", story(n) * 9) for n in range(8)]
    assert all(f"end {n} Story" in text for n, text in enumerate(extracted(ends)))
    always = [shell.format("Always here", story(n)) for n in range(8)]
    assert extracted(always) == [story(n) for n in range(8)]


def test_no_text_is_lost_beside_the_heavy_child():
    long, text = "A long paragraph that holds most of the text of this page. " * 4, "Some more text of its own."
    pages = [
        f"<div class=content><p>{text}</p><div class=text>{long}</div><p>{text}</p></div>",
        f"<main><h1>{text}</h1><article><p>{long}</p></article><p>{text}</p></main>",
        f"<body><div><p>{text}</p><div><div>{long * 4}</div></div></div></body>",
        f"<body><h1>{text}</h1><div id=teaser><article>{text}</article></div><div>{long}</div></body>",
    ]
    for page in pages:
        want = " ".join(re.sub(r"<[^>]*>", " ", page).split())
        assert extracted([page]) == [want]
        # One very long page with all text in one place does not decide for the others of its host.
        deep = page.replace(text, "").replace(long, long * 200)
        assert extracted([deep, page])[1] == want
    linked = "<article><p>Text of the article.</p><ul><li><a href=x>Linked</a></ul></article><div><a href=y>Menu</a></div>"
    assert extracted([linked]) == ["Text of the article. Linked"]


def test_text_after_and_in_deep_elements():
    page = "<div><main><article>{}<p>Inside of it, long enough to be nearly all of the text.</p>{}<p>After the deep part.</p></article></main></div><div><p>Other</p></div>"
    for depth in (140, 148, 150, 200, 3000):
        deep = "<div>" * depth + "a<div>deep</div>b<nav>menu<div>more</div></nav><form>form</form> end" + "</div>" * depth
        for at in range(2):
            parts = ("", deep) if at else (deep, "")
            want = "Inside of it, long enough to be nearly all of the text. a deep b end After the deep part." if at else "a deep b end Inside of it, long enough to be nearly all of the text. After the deep part."
            text = " ".join(html_wrappers.extract(page.format(*parts), None).split())
            assert text == want, depth


def test_pages_odd_cases(spark):
    rows = [(None, None, None, "a", "b"), (1, "", "", "a", "b"), (1, "", "", "a", "b"), (2, "ftp:x", "<p>t", "a", "b")]
    pages = spark.createDataFrame(rows, PAGES)
    assert sorted(r.text for r in html_wrappers.main_texts(pages).collect()) == ["", "", "", "t"]
    assert html_wrappers.main_texts(pages.limit(0)).count() == 0


def test_fixity_finds_every_fault(spark):
    primary = spark.createDataFrame([(n, f"u{n}", "text" * n, "a", "b") for n in range(3000)] + [(None, None, None, "a", "b")] * 3 + [(7, "u7", "again", "a", "b")], PAGES)
    replica = primary.filter("page_id IS NULL OR page_id NOT IN (0, 999, 2500)").replace({"text" * 1500: "text" * 1499 + "tesT"}, subset=["html"])
    replica = replica.unionAll(spark.createDataFrame([(9000, "u", "h", "a", "b"), (7, "u7", "again", "a", "b")], PAGES))
    got = {r.place: (r.kind, r.primary_records, r.replica_records) for r in merkle_fixity.audit(primary, replica).collect()}
    assert got == {0: ("missing", 1, 0), 999: ("missing", 1, 0), 2500: ("missing", 1, 0), 1500: ("changed", 1, 1), 9000: ("extra", 0, 1), 7: ("changed", 2, 3)}
    assert merkle_fixity.audit(primary, primary).count() == 0
    assert merkle_fixity.audit(primary.limit(0), primary.limit(0)).count() == 0
    assert merkle_fixity.audit(primary.filter("page_id < 20"), primary.limit(0)).count() == 20


CHATS = "conv_id long, turn long, role string, text string, prefix string, block string"


def chats(spark, rows):
    return spark.createDataFrame([(*row, "p", "b") for row in rows], CHATS)


def test_snapshots_collapse(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    rows = [(conv, t, *turns[t]) for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in range(n)]
    rows += [(5, 0, "user", "a"), (5, 1, "assistant", "other"), (6, 0, "assistant", "a")]
    got = {r.conv_id: (r.n_turns, r.n_logged, r.rendered) for r in chat_snapshots.formatted(chats(spark, rows)).collect()}
    assert got.keys() == {2, 5, 6} and got[2][:2] == (4, 2)
    assert got[2][2] == "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def test_snapshots_odd_cases(spark):
    rows = [(None, 0, "user", "x"), (None, 0, "user", "x"), (None, 1, None, None), (1, None, "user", ""), (1, 0, None, ""), (1, 0, None, ""), (2, 0, "", "")]
    got = sorted((r.conv_id or 0, r.n_turns, r.n_logged) for r in chat_snapshots.formatted(chats(spark, rows)).collect())
    assert got == [(0, 1, 1), (0, 1, 1), (1, 2, 1), (2, 1, 1)]
    assert chat_snapshots.formatted(chats(spark, rows).limit(0)).count() == 0


def test_long_conversation_comes_in_parts(spark):
    rows = [(1, n, "user", f"t{n}") for n in range(2500)] + [(2, n, "user", f"t{n}") for n in range(2400)]
    got = {r.part: r for r in chat_snapshots.formatted(chats(spark, rows)).collect()}
    assert sorted(got) == [0, 1, 2] and {(r.conv_id, r.n_turns) for r in got.values()} == {(1, 2500)}
    assert "".join(got[k].rendered for k in range(3)) == "".join(f"<|user|>\nt{n}\n<|end|>\n" for n in range(2500))


def test_chats_run_no_python(spark, sf_dir):
    plan = queries.QUERIES["op3_chat_snapshots"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Wrappers that tell the article by structure alone


def told_by_structure(n):
    """A page whose classes say nothing: menu, notice, article, rotating advert, comments and teasers in ``div.x``n."""
    comments = "".join(f"<div class=x7>Reader {n * 7 + k}<p>I have something to say about part {n} of it, {k} times over.</p></div>" for k in range(n % 4))
    teasers = "".join(f"<div class=x9><h3>Other story {n + k}</h3><p>Read what happened then, {n + k}.</p></div>" for k in range(3))
    story = "".join(f"<p>Paragraph {k} of story {n}, which goes on for quite a while as stories do, with {n * k} things in it.</p>" for k in range(5 + n % 3))
    quote = f"<div class=x4><p>A quote in story {n}.</p></div>" if n % 2 else ""
    return (
        "<body><div class=x1><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></div><div class=x2>We use small files to remember you.</div>"
        f"<div class=x3><h1>Story {n}</h1>{story}{quote}</div><div class=x5>Buy brand {n % 3} now, it is good.</div><div class=x6>{comments}</div><div class=x8>{teasers}</div></body>",
        " ".join(re.sub(r"<[^>]*>", " ", f"Story {n} {story}{quote}").split()),
    )


def test_classes_without_meaning_are_told_by_structure(spark):
    made = [told_by_structure(n) for n in range(24)]
    rows = [(n, "http://plain.example/x", page, "q", "q") for n, (page, _) in enumerate(made)]
    got = {r.page_id: r.text for r in html_wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {n: want for n, (_, want) in enumerate(made)}
    for page, want in made[1:4]:
        assert html_wrappers.extract(page, {}) != want  # without the host's rules all text stays
        assert "small files" in html_wrappers.extract(page, {}) and "Home" in html_wrappers.extract(page, {})


def test_names_do_not_take_text_from_an_article():
    page = (
        '<article><p>A reader may care.</p><div class="search-results-explained"><p>The search for truth goes on.</p></div>'
        '<p class="social-history">Social history text.</p><noscript>One</noscript> <object>Two</object> <map>Three</map> <canvas>Four</canvas>'
        '<div class="comment-list"><p>First!</p></div><div class="ad-box">Buy</div></article>'
    )
    assert html_wrappers.extract(page, None) == "A reader may care. The search for truth goes on. Social history text. One Two Three Four"
    whole = "<article><div class=post><div class='comments'><p>" + "The article itself is in an element with an odd name. " * 5 + "</p></div><p>End.</p></div></article>"
    assert html_wrappers.extract(whole, None).endswith("odd name. End.")


@pytest.mark.parametrize("unit", ["<a ", '<a "', '<a ="', "<!", "<!--", '<a =">', "<script>", "</", '<p class="', "<", "<div><p>", "</p>"])
def test_broken_pages_are_read_in_time_in_proportion(unit):
    import time

    start = time.perf_counter()
    html_wrappers.extract("<article><p>Text " + unit * (300_000 // len(unit)), None)
    assert time.perf_counter() - start < 4


def test_tags_end_at_the_same_places_as_in_a_plain_reading():
    page = "a<b title='x>y'>c</b><!-- <p> -->d<![CDATA[e<f]]><p class=\"q\">g<x'>h<br/>i < j <3 <unfinished"
    assert html_wrappers.extract(page, {}) == "acde<f gh i < j <3 <unfinished"


def test_wrappers_do_not_grow_with_unique_ids():
    whole = None
    for n in range(200):
        own = html_wrappers.wrapper_of(html_wrappers.parse(f"<body><div id=post-{n:x}zz{n}><p id=a{n}b>Story {n} goes on.</p></div><div class=t id=u{n}q>Tag</div></body>"))
        whole = html_wrappers.merged(whole, own) if whole else own
    import json

    assert len(json.dumps(whole)) < 4000


def test_rules_beyond_the_broadcast_size_meet_pages_in_a_dealt_join(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    before = {r.page_id: r.text for r in html_wrappers.main_texts(pages).collect()}
    monkeypatch.setattr(html_wrappers, "RULES_CHARS", 10)
    assert {r.page_id: r.text for r in html_wrappers.main_texts(pages).collect()} == before


def test_sparse_turn_numbers_make_one_part(spark):
    rows = [(1, 1, "user", "a"), (1, 5000, "user", "b"), (2, None, "user", "c"), (2, 7, "user", "d"), (3, 10**12, "user", "e")]
    got = sorted((r.conv_id, r.part, r.n_parts, r.n_turns, r.rendered.count("<|end|>")) for r in chat_snapshots.formatted(chats(spark, rows)).collect())
    assert got == [(1, 0, 1, 2, 2), (2, 0, 1, 2, 2), (3, 0, 1, 1, 1)]
