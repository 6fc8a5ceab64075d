import html
import random
import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
from helpers import SF

from pyspark.sql import functions as F

from tillroll.llm import page_text
from tillroll.llm.page_text import joined, main_text, page_blocks

SCHEMA = "page_id long, url string, html string, text string, host string"


class Articles(HTMLParser):
    """Text of the article element, block by block, the plain way."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.parts = 0, [], []

    def cut(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag not in ("b", "a", "i"):
            self.cut()

    def handle_endtag(self, tag):
        if tag not in ("b", "a", "i"):
            self.cut()
        if tag == "article":
            self.inside -= 1

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_the_pages_table_equals_a_plain_parser(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    whole = [p for p in pages if p["html"].rstrip().endswith("</html>")]
    assert len(whole) > len(pages) / 2
    got = {r.page_id: r for r in main_text(spark, spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    assert len(got) == len(pages)
    for p in whole:
        parser = Articles()
        parser.feed(p["html"])
        parser.close()
        row = got[p["page_id"]]
        assert row.text == "\n".join(parser.blocks) and row.n_chars == len(row.text)
        assert row.url == p["url"]


def test_furniture_is_left_out_and_references_are_decoded():
    page = """<!doctype html><html class="nav-open"><head><title>T</title><script>"</p>"</script></head>
    <body class="menu"><header><p>Site</p></header><div id='cookie-notice'>We use</div><nav><ul><li>Home
    </ul></nav><article><header><h1>Head&amp;line</h1></header><p>One&nbsp; two<br>three <b>fo</b>ur</p>
    <div class="advert"><div>Buy</div> now</div><!-- <p>no</p> --><p>caf&eacute; &#233; &lt;b&gt; <a
    title="a > b">x</a><form>f<input></form><aside>side</aside><section class="commentList"><p>first!
    </p></section></article><div class="sidebar">s</div><footer>&copy;</footer></body></html>"""
    assert joined(page_blocks(page)) == "Head&line\nOne two three four\ncafé é <b> x"
    assert joined(page_blocks("<nav><ul><li>a<article><p>text")) == "text"
    assert joined(page_blocks("<main><p>a</p></main><p>b")) == "a"
    assert joined(page_blocks("<div role=main>a</div>")) == "a"
    assert joined(page_blocks("plain &am")) == "plain &am"
    assert [joined(page_blocks(p)) for p in (None, "", "<p", "<", "<p></p>")] == ["", "", "", "<", ""]


def unmarked(rng, i, shared):
    own = [f"page {i} says {rng.random()} in block {j}" for j in range(rng.randrange(1, 5))]
    head, foot = shared
    return own, "".join(f"<div>{html.escape(t)}</div>" for t in [*head, *own, *foot])


def test_repeated_runs_of_a_host_are_boilerplate_where_no_article_is_marked(spark):
    rng = random.Random(1)
    hosts = {h: ([f"{h} home", "News", f"all about {h} & more"], [f"made by {h} people"]) for h in "abc"}
    rows, want = [], {}
    for i in range(60):
        host = "aab"[i % 3]
        own, page = unmarked(rng, i, hosts[host])
        rows.append((i, f"https://{host}.example/{i}", page, "", ""))
        want[i] = "\n".join(own)
    # A host's only page has nothing to compare with; a mirrored page is no second page.
    own, page = unmarked(rng, 99, hosts["c"])
    rows += [(99, "https://c.example/", page, "", ""), (98, "https://c.example/2", page, "", "")]
    want[99] = want[98] = "\n".join([*hosts["c"][0], *own, *hosts["c"][1]])
    # A marked article keeps what others have too.
    rows.append((97, "https://a.example/97", "<article><p>a home</p></article><div>News</div>", "", ""))
    want[97] = "a home"
    rows += [(96, None, None, None, None), (96, None, None, None, None)]
    got = main_text(spark, spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(rows) and found.pop(96) == ""
    # "News" alone has too few words; it goes because the run around it repeats.
    assert found == want


def test_repeats_equal_brute_force_however_the_sorted_array_is_cut(spark):
    rng = random.Random(4)
    streams = [[rng.choice("uv") if rng.random() < 0.9 else f"w{rng.random()}" for _ in range(rng.randrange(1, 30))] for _ in range(60)]
    cut = [[s[k : k + 4] for k in range(0, len(s), 4)] for s in streams]
    rows = [(i, "h", "".join(f"<p>{' '.join(t)}</p>" for t in s), i // 2, 30) for i, s in enumerate(cut)]
    df = spark.createDataFrame(rows, "page long, host string, html string, version long, n_versions long")
    tokens = [page_text.tokens(page_blocks(r[2]))[0] for r in rows]
    grams = {}
    for i, stream in enumerate(tokens):
        for at in range(len(stream) - page_text.RUN + 1):
            grams.setdefault(tuple(stream[at : at + page_text.RUN]), []).append((i, at))
    want = []
    for places in grams.values():
        n = len({i // 2 for i, _ in places})
        want += [(i, at, n, 30) for i, at in places if n > 1]
    for partitions, held_back in ((4, 100_000), (40, 100_000), (3, 2)):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = sorted(tuple(r) for r in page_text.repeated_runs(df, held_back).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert got == sorted(want)


def texts_of(spark, pages):
    rows = [(i, url, page, "", "") for i, (url, page) in enumerate(pages)]
    found = {r.page_id: r.text for r in main_text(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    return [found[i].split("\n") for i in range(len(pages))]


def prose(name, n):
    return [" ".join(f"{name}-{i}-{k}" for k in range(9)) for i in range(n)]


def page_of(*blocks):
    return "".join(f"<div>{t}</div>" for t in blocks)


FRAME = ["Example Daily News of the day", "About us and our many friends"]


def test_versions_of_a_page_are_no_evidence_against_its_story(spark):
    story, related = prose("story", 6), "Related lines that only one version has"
    pages = [("https://a.example/a", page_of(*story, related)), ("https://a.example/a?print=1", page_of(*story))]
    assert texts_of(spark, pages) == [[*story, related], story]
    # Among other pages of the host the frame is known, and the story still stays in both.
    others = [(f"https://a.example/{i}", page_of(FRAME[0], *prose(f"page{i}", 3), FRAME[1])) for i in range(8)]
    pages = [(u, page_of(FRAME[0]) + p + page_of(FRAME[1])) for u, p in pages] + others
    got = texts_of(spark, pages)
    assert got[:2] == [[*story, related], story]
    assert got[2:] == [prose(f"page{i}", 3) for i in range(8)]


def test_a_paged_story_loses_only_its_frame(spark):
    story = prose("long story", 12)
    pages = [(f"https://a.example/s?page={i}", page_of(FRAME[0], *story[3 * i : 3 * i + 3], FRAME[1])) for i in range(4)]
    assert texts_of(spark, pages) == [story[3 * i : 3 * i + 3] for i in range(4)]


def test_a_syndicated_paragraph_stays(spark):
    shared = "The agency reports that the same paragraph was printed by two papers on one day"
    pages = []
    for i in range(9):
        own = prose(f"page{i}", 4)
        pages.append((f"https://a.example/{i}", page_of(FRAME[0], *own[:2], *([shared] if i < 2 else []), *own[2:], FRAME[1])))
    got = texts_of(spark, pages)
    assert all((shared in t) == (i < 2) for i, t in enumerate(got))
    assert all(t[0] == prose(f"page{i}", 1)[0] and FRAME[1] not in t for i, t in enumerate(got))


def test_a_boilerplate_sentence_within_a_block_goes_without_the_block(spark):
    tail = "Read this and much more every morning in our paper and on all your devices"
    pages = [(f"https://a.example/{i}", page_of(f"{prose(f'p{i}', 1)[0]} {tail}", *prose(f"q{i}", 2))) for i in range(6)]
    assert texts_of(spark, pages) == [[prose(f"p{i}", 1)[0], *prose(f"q{i}", 2)] for i in range(6)]


def test_no_page_loses_everything(spark):
    pages = [(f"https://a.example/{i}", page_of(*FRAME, *prose(f"p{i}", 3 * (i > 0)))) for i in range(5)]
    assert texts_of(spark, pages) == [FRAME, *[prose(f"p{i}", 3) for i in range(1, 5)]]


def test_a_host_decides_marked_pages_where_elements_are_named_like_furniture(spark):
    def page(i):
        own = "".join(f"<p>{t}</p>" for t in prose(f"story{i}", 3))
        share = '<div class="share">Share this with all of your friends</div>'
        note = f'<div class="notice">This notice {i} is part of story {i} alone</div>'
        return f"<article><h1>Title {i}</h1>{own}{note}{share}</article>"

    got = texts_of(spark, [(f"https://a.example/{i}", page(i)) for i in range(5)])
    assert got == [[f"Title {i}", *prose(f"story{i}", 3), f"This notice {i} is part of story {i} alone"] for i in range(5)]


def test_no_rows(spark):
    assert main_text(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    assert not re.search(page_text.CONTAINER, "<articles>")


def test_names_remove_blocks_only_where_the_host_repeats_them(spark):
    page = """<article class="post category-social comments-open"><h2 id="related-work">Work {0}</h2>
    <p id="notice-period" data-id="menu">Notice {0}</p><section id="search">Search {0}</section>
    <div class="hidden-gem" style="overflow:hidden">Gem {0}</div><div class="share">Share this</div></article>"""
    rows = [(i, f"https://a.example/{i}", page.format(i), "", "") for i in range(3)]
    rows += [(9, "https://b.example/", page.format(9), "", "")]
    rows += [(8, "https://c.example/", '<div class="with-sidebar"><p>whole page</p></div>', "", "")]
    got = {r.page_id: r.text for r in main_text(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: f"Work {i}\nNotice {i}\nSearch {i}\nGem {i}" for i in (0, 1, 2, 9)}
    # A host's only page has nothing that supports the name.
    assert got == {**want, 9: want[9] + "\nShare this", 8: "whole page"}


def test_the_container_with_the_text_is_chosen():
    def text(page):
        return joined(page_blocks(page))

    story = "<p>the story itself</p>"
    assert text(f"<main>{story}</main><aside><article><p>teaser</p></article></aside>") == "the story itself"
    comments = '<section class="comments"><article>one comment</article></section>'
    assert text(f"<article>{story}</article>{comments}") == "the story itself"
    assert text(f"<article>{story}{comments}</article>") == "the story itself"
    assert text(f"<main>intro<article>{story}</article></main>") == "intro\nthe story itself"
    assert text("<article>one</article><article>two</article>") == "one\ntwo"
    assert text(f"<form><article>{story}</article></form>") == "the story itself"
    assert text(f"<div>{story}</div><aside><article>teaser</article></aside>") == "the story itself"
    assert text(f"<nav><ul><li>a<article>{story}") == "the story itself"
    assert text(f"<aside><nav>x</aside></nav><p>{story}") == "the story itself"
    page_blocks("<nav>" * 50_000 + "<article>" * 50_000 + "a" + "</article>" * 50_000)


def marked(i):
    own = "".join(f"<p>{t}</p>" for t in prose(f"story{i}", 3))
    return f"<nav>{FRAME[0]}</nav><article>{own}</article><footer>{FRAME[1]}</footer>"


def test_the_suffixes_of_pages_that_their_tags_decide_are_sorted_too(spark, monkeypatch):
    # Once a host all of whose pages mark an article did not get to the suffix array.
    sorted_runs = []

    def repeated_runs(*args, runs=page_text.repeated_runs, **kwargs):
        found = runs(*args, **kwargs)
        sorted_runs.append(found.groupBy("n").agg(F.count_distinct("page").alias("pages")).collect())
        return found

    monkeypatch.setattr(page_text, "repeated_runs", repeated_runs)
    assert texts_of(spark, [(f"https://a.example/{i}", marked(i)) for i in range(6)]) == [prose(f"story{i}", 3) for i in range(6)]
    assert [[tuple(r) for r in found] for found in sorted_runs] == [[(6, 6)]]


def test_no_boilerplate_is_lost_by_counts_in_parts(spark):
    rng = random.Random(5)
    rows, sizes = [], {"a": 40, "b": 7, "c": 2}
    for host, n in sizes.items():
        for i in range(n):
            blocks = [t for k, t in enumerate(prose(host, 12)) if rng.random() < k / 12]
            rows.append((len(rows), host, page_of(*blocks, *prose(f"{host}{i}", 4)), len(rows), n, n))
    schema = "page long, host string, html string, version long, n_versions long, n_pages long"
    df = spark.createDataFrame(rows, schema).repartition(3, "page")
    wanted = sorted(tuple(r) for r in page_text.repeated_runs(df).filter(page_text.is_boilerplate()).collect())
    for part in (1, 300, 1 << 21):
        likely = spark.sparkContext.broadcast(page_text.likely_runs(df, part))
        found = page_text.repeated_runs(df, likely=likely).filter(page_text.is_boilerplate())
        assert sorted(tuple(r) for r in found.collect()) == wanted
    assert wanted and page_text.suffixes(df, likely).count() < page_text.suffixes(df).count()
