"""Main text, shards and archives."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelstats.llm import common, html_text, shards, warc

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar">
<script>var t="</p>";</script><header><a href="/">Home</a></header><nav><ul><li><a>x</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy <b>now</b></div>
<article><h1>Head &amp; line</h1><p>One <b>bold</b>ness&nbsp;here,<br>next <a href="u">link</a>.
<p title="a > b">Two &lt;p&gt; caf&eacute;<!-- no --></p><form><input value="q">Search</form>
<ul><li>first<li>second</ul><section class="comments"><p>I disagree with all this text.</p></section>
</article><aside>More</aside><footer>&copy; me</footer></body>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (PAGE, "Head & line One boldness here, next link. Two <p> café first second"),
        (None, ""),
        ("", ""),
        ("<html><body><script>x</script></body></html>", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<b>b</b>c<br>d<p>e", "abc d e"),
        ("<article><p>cut &am", "cut &am"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 10 + "</article>", "deep"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_main_text_without_named_article():
    words = "a fairly long sentence of the main text that goes on for a while. "
    page = (
        '<body><div><a href="/">Home</a> <a href="n">News</a> <a href="o">Other</a></div>'
        f"<div id=c><h1>Title</h1><div><p>{words * 3}</p><p>Short.</p></div><div><p>{words * 2}</p></div></div>"
        '<div><a href="i">Imprint</a> <a href="p">Privacy</a></div></body>'
    )
    assert html_text.main_text(page) == " ".join(f"Title {words * 3} Short. {words * 2}".split())


def test_words_that_mark_do_not_take_the_page():
    text = "A sentence of the text that fills most of the page. " * 5
    page = f'<body><div class="social">x y</div><div class="no-ad layout"><p>{text}</p><p>{text}</p></div></body>'
    assert html_text.main_text(page) == " ".join((text * 2).split())
    noisy = f'<body><div><p>{text}</p></div><div class="comments"><p>{text * 4}</p></div></body>'
    assert html_text.main_text(noisy) == " ".join(text.split())


@pytest.mark.parametrize("name", ["entry ad-free", "share-body", "social notice"])
def test_words_that_mark_do_not_take_a_named_article(name):
    text = "A sentence of the article that fills most of it. " * 5
    page = f'<body><div class="{name}">x y</div><article><h1>T</h1><div class="{name}"><p>{text}</p><p>{text}</p></div><div class="{name}">Buy</div></article></body>'
    found = html_text.main_text(page)
    assert " ".join((text * 2).split()) in found and "Buy" not in found and "x y" not in found
    parts = f'<main><article><div class="{name}"><p>{text}</p></div></article></main>' * 2
    assert " ".join(text.split()) in html_text.main_text(parts)


def test_all_parts_of_a_text_in_several_articles():
    text = "A sentence of a part, long enough to be one. "
    page = (
        f"<body><p>Before</p><article><h1>One</h1><div><p>{text * 5}</p></div><p>End.</p></article><div><article><h2>Two</h2><p>{text}</p>"
        f"<article>Inner {text}</article></article></div><article><a href=x>A teaser of another page</a></article></body>"
    )
    assert html_text.main_text(page) == " ".join(f"One {text * 5} End. Two {text} Inner {text}".split())


TEXT = "A sentence of the article that is long enough to fill a paragraph of it with many words. " * 3
REMARK = "I have read all of this and do not agree with it. "


@pytest.mark.parametrize(
    "beside",
    [
        f'<article class="comment"><p>{REMARK * 3}</p></article>' * 2,
        f'<section class="discussion"><h3>Talk</h3><article><p>{REMARK * 6}</p></article></section>',
        f'<div id="reader-feedback"><article><p>{REMARK}</p></article><article><p>{REMARK * 9}</p></article></div>',
        '<article><h3><a href="n">Another page</a></h3><p>What it says.</p><span>Now</span></article>' * 3,
        '<article><a href="n">A long title of another page</a></article>',
    ],
)
@pytest.mark.parametrize("first", [False, True])
def test_remarks_and_teasers_beside_the_article_are_no_text(beside, first):
    article = f"<article><h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p></article>"
    parts = [beside, article] if first else [article, beside]
    page = f'<body><nav><a href="/">Home</a></nav><div>{"".join(parts)}</div><footer>x</footer></body>'
    assert html_text.main_text(page) == " ".join(f"Title {TEXT} {TEXT}".split())


def test_an_article_named_after_its_comments_or_discussion_stays():
    page = f'<body><section class="discussion"><article class="post has-comments"><p>{TEXT}</p><section id="discussion"><p>{TEXT}</p></section></article></section></body>'
    assert html_text.main_text(page) == " ".join((TEXT * 2).split())


def plain_densities(page):
    """Densities node by node, from the lists of descendants."""
    n = len(page.name)
    below = [[j for j in range(n) if j == i or i in lineage(page, j)] for i in range(n)]

    def figures(i):
        chars = links = 0
        for node, _, text in page.pieces:
            if node in below[i] and not page.dropped[node]:
                chars += len(text.strip())
                if any(page.name[j] == "a" for j in [node, *lineage(page, node)]):
                    links += len(text.strip())
        inner = [j for j in below[i] if j != i and not page.dropped[j]]
        return chars, len(inner), links, sum(page.name[j] == "a" for j in inner)

    chars, _, links, _ = figures(0)
    share, out = (links / chars if chars else 0.0), []
    for i in range(n):
        c, t, lc, lt = figures(i)
        if page.dropped[i] or not c:
            out.append(0.0)
            continue
        rest = max(1, c - lc)
        base = np.log(c / rest * lc + share * c + np.e)
        out.append(c / max(1, t) * np.log(c / max(1, lc) * max(1, t) / max(1, lt)) / base)
    sums = [sum(out[j] for j in range(1, n) if page.parent[j] == i) for i in range(n)]
    return out, sums


def lineage(page, i):
    out = []
    while page.parent[i] >= 0:
        i = page.parent[i]
        out.append(i)
    return out


def test_densities_equal_a_plain_computation(spark):
    pages = [PAGE] + [r["html"] for r in common.table(spark, "/root/testdata/sf0.001", "pages").limit(12).collect()]
    for html in pages:
        page = html_text.parse(html)
        html_text.settle_dropped(page)
        density, total, _ = html_text.densities(page)
        want, sums = plain_densities(page)
        assert np.allclose(density, want) and np.allclose(total, sums)
        # What the composite sums choose below the body, by trying every subtree.
        n, end = len(page.name), html_text.subtree_ends(page)
        keep = [False] * n
        html_text.search(page, 0, density, total, end, keep)
        lead = max(range(n), key=lambda i: (sums[i], -i))
        threshold = min(want[i] for i in [lead, *lineage(page, lead)] if want[i])
        plain, waiting = [False] * n, [0]
        while waiting:
            i = waiting.pop()
            if page.dropped[i] or plain[i] or not want[i] or want[i] < threshold - 1e-12:
                continue
            best = max(range(i, end[i]), key=lambda j: (round(sums[j], 9), -j))
            for j in range(best, end[best]):
                plain[j] = not page.dropped[j]
            waiting += [j for j in range(n) if page.parent[j] == i]
        assert keep == plain


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_form_around_the_page_keeps_the_text(tag):
    text = "A sentence of the text in a page that is one form. " * 5
    page = (
        '<body><form method="post" id="form1"><input name="state"><nav><a href="/">Home</a></nav>'
        f'<{tag}><p>{text}</p><p>{text}</p><form action="/find">Search here <button>Go</button></form></{tag}></form></body>'
    )
    assert html_text.main_text(page) == " ".join((text * 2).split())


def test_extract_frame(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = Counter(tuple(r) for r in html_text.op1(pages).select("page_id", "text", "n_chars").collect())
    text = html_text.main_text(PAGE)
    assert got == Counter({(1, text, len(text)): 2, (2, "", 0): 1, (None, "x", 1): 1})
    assert html_text.op1(pages.limit(0)).collect() == []


@pytest.mark.parametrize("case", ["awkward", "clashing", "none"])
def test_shards(request, case):
    docs = request.getfixturevalue(case)
    got = shards.op2(docs, 4).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert not got or max(sizes.values()) - min(sizes.get(s, 0) for s in range(4)) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sizes[shard]))


def test_shards_are_uniform_and_repeat(spark):
    rows = spark.range(4000).select(F.col("id"), (F.col("id") * 2).alias("extra"))
    once = shards.shuffle_shards(rows, ["id"], 5, rows_per_block=300)
    a = sorted(map(tuple, once.collect()))
    b = sorted(map(tuple, shards.shuffle_shards(rows.repartition(7), ["id"], 5, rows_per_block=300).collect()))
    assert a == b and once.columns == ["id", "extra", "shard", "slot"]
    place = np.array([[r[2], r[3]] for r in a])
    # No drift of ids along shards or slots.
    assert abs(np.corrcoef(np.arange(4000), place[:, 0])[0, 1]) < 0.06
    assert abs(np.corrcoef(np.arange(4000), place[:, 1])[0, 1]) < 0.06


@pytest.mark.parametrize(("total", "marked", "taken"), [(50, 20, 15), (1000, 10, 600), (7, 7, 3), (9, 0, 4), (400, 350, 390)])
def test_hypergeometric_draw(spark, total, marked, taken):
    n = 4000
    rows = spark.range(n).select(
        shards.draw(
            F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(taken).cast("long"), (F.col("id") + 0.5) / n
        ).alias("k")
    )
    got = np.array([r[0] for r in rows.collect()])
    assert got.min() >= max(0, taken + marked - total) and got.max() <= min(marked, taken)
    # The quantiles of the distribution, taken evenly, have its mean and variance.
    mean = taken * marked / total
    variance = mean * (1 - marked / total) * (total - taken) / (total - 1)
    assert abs(got.mean() - mean) < 0.01 and abs(got.var() - variance) < 0.02 * variance + 0.01


def pages_of(spark):
    long, other = "x" * 100, "y" * 3000 + "é"
    rows = [
        (5, "u5", long), (3, "u3", long), (9, "u9\r\nX: y", long), (1, "s", "short"), (2, "s", "short"),
        (7, None, other), (8, "o", other), (8, "o", other), (4, "n", None), (6, "e", ""), (None, "k", long),
        (None, "l", "z" * 200), (None, "m", "z" * 200),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archive_query(spark):
    pages = pages_of(spark)
    got = Counter(tuple(r) for r in warc.op4(pages.withColumn("digest", F.lit("clash"))).collect())
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = Counter()
    for page, body in rows:
        same = [p for p, b in rows if b == body and p is not None]
        revisit = len(body) >= 100 and bool(same) and page != min(same)
        digest = hashlib.sha256(body).hexdigest()
        want[(page, len(body), digest, "revisit" if revisit else "response", min(same) if revisit else None)] += 1
    assert got == want
    assert warc.op4(pages.limit(0)).collect() == []


def test_archive_stores_once_and_gives_back(spark, tmp_path):
    pages = pages_of(spark)
    folder = warc.write_archive(pages, str(tmp_path / "a"))
    assert spark.read.parquet(f"{folder}/payloads").count() == pages.select(F.coalesce("html", F.lit(""))).distinct().count()
    archive = warc.read_archive(spark, folder)
    back = Counter((r["key"], r["payload"].decode()) for r in archive.select("key", F.col("payload")).collect())
    assert back == Counter((r["page_id"], r["html"] or "") for r in pages.collect())
    record = warc.records(archive).where("key = 3").first()["record"]
    head, body = record.split("\r\n\r\n", 1)
    assert head.startswith("WARC/1.1\r\nWARC-Type: response") and f"Content-Length: {len(body) - 4}" in head
    assert body == "x" * 100 + "\r\n\r\n"
    warc.export(archive, str(tmp_path / "files"))
    written = "".join(p.read_bytes().decode() for p in (tmp_path / "files").glob("part-*"))
    assert sorted(written.split("WARC/1.1\r\n")[1:]) == sorted(
        r["record"].removeprefix("WARC/1.1\r\n") for r in warc.records(archive).collect()
    )


def test_archive_query_rebuilds_records(spark):
    """The payload itself goes through the join, and its digest is that of what comes out."""
    plan = warc.op4(pages_of(spark))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    assert "sha2(payload" in "".join(lines[:join]) and "octet_length(payload" in "".join(lines[:join])
    assert "payload" in "".join(line for line in lines[join:] if "Relation" in line)


def test_archive_notices_damage(spark, tmp_path):
    folder = warc.write_archive(pages_of(spark), str(tmp_path / "a"))
    bad = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8"))
    bad.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()
