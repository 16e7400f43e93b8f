"""Labelled pages the extraction model is trained from.

Layouts are put together from labelled parts: ``data-main`` says whether an element is main
content. Every layout wraps a content part in a container and sets boilerplate parts around
(and some inside) it; all combinations are enumerated by Spark, with texts of varied length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = "the committee met again in the spring, and after some hours of talk, the members agreed on a plan. nobody had expected that result. it was sent to the printer the same evening, with two small changes."
SHORT = "a short note on the matter, as promised."
# Containers of the main content.
CONTAINERS = [
    '<article data-main="1">{}</article>', '<main data-main="1">{}</main>', '<div class="content" data-main="1">{}</div>', '<div id="content" data-main="1">{}</div>', '<section class="post" data-main="1">{}</section>',
    '<div class="post-content entry-content" data-main="1">{}</div>', '<div class="article-body" data-main="1">{}</div>', '<main><article data-main="1">{}</article></main>', '<div class="wrapper"><div class="story" data-main="1">{}</div></div>',
    '{}', '<div class="zzunseen" data-main="1">{}</div>', '<div id="zzunseen"><div class="zzunseen" data-main="1">{}</div></div>', '<section class="zzunseen" data-main="1">{}</section>', '<div class="zzunseen" id="zzunseen" data-main="1">{}</div>', '<div class="zzunseen"><div class="zzunseen" data-main="1">{}</div></div>', '<td class="zzunseen" data-main="1">{}</td>', '<div class="zzunseen" data-main="1"><div class="zzunseen">{}</div></div>', '<div><div data-main="1">{}</div></div>', '{}',
    '<div id="article" data-main="1">{}</div>', '<div class="post" data-main="1">{}</div>', '<section data-main="1">{}</section>', '<div data-main="1">{}</div>', '<div id="main"><div class="text" data-main="1">{}</div></div>', '<div class="page"><article class="entry" data-main="1"><div class="body">{}</div></article></div>', '<div role="main" data-main="1">{}</div>', '<table><tr><td class="content" data-main="1">{}</td></tr></table>',
]
# Main content.
BODIES = [
    "<h1>{t}</h1><p>{l}</p><p>{s}</p>", "<h1>{t}</h1><p><b>{l}</b><br><p>{l}</p>", "<h2>{t}</h2><p>{l}</p><h3>{t}</h3><p>{l}</p><ul><li>{s}</li><li>{l}</li></ul>", "<header><h1>{t}</h1></header><p>{s}</p><blockquote><p>{l}</p></blockquote>",
    "<h1>{t}</h1><section><p>{l}</p></section><section><h2>{t}</h2><p>{l}</p></section>", "<h1>{t}</h1><p>{l} <a href='/x'>{t}</a></p><figure><figcaption>{s}</figcaption></figure><p>{l}</p>", "<h1>{t}</h1><pre>{s}</pre><p>{s}</p><table><tr><td>{s}</td><td>{t}</td></tr></table>",
    "<h1>{t}</h1>{l}<br><br>{l} {l}", "{l} {s}\n\n{l}", "<h1>{t}</h1><div>{l}</div><div class='zzunseen'>{l} {l}</div>", "<h1>{t}</h1><p class='zzunseen'>{l}</p><p class='zzunseen'>{s}</p><p>{l} {l}</p>", "<h2 class='zzunseen'>{t}</h2><div class='zzunseen'><p>{l}</p><p>{l}</p></div>",
    "<h1>{t}</h1><p>{s}", "<p>{l}</p><div>{l}</div><ol><li>{s}</li><li>{s}</li></ol>", "<h1>{t}</h1><dl><dt>{t}</dt><dd>{l}</dd></dl><p>{l}</p>", "<h1>{t}</h1><p>{t}</p>",
]
# Boilerplate, outside or inside the content container.
OUTER = [
    '<nav data-main="0"><ul><li><a href="/a">home</a></li><li><a href="/b">about us</a></li><li><a href="/c">news</a></li></ul></nav>',
    '<header data-main="0"><div class="logo">the daily</div><p>{s}</p></header>', '<header class="site-header" data-main="0"><h1><a href="/">the daily</a></h1><nav><a href="/a">one</a> <a href="/b">two</a></nav></header>',
    '<div class="menu" data-main="0"><a href="/a">one</a> <a href="/b">two</a></div>', '<ul class="nav navbar" data-main="0"><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul>', '<div id="header" data-main="0"><h1>the daily</h1></div>',
    '<footer data-main="0">&copy; the daily &middot; {s}</footer>', '<footer data-main="0"><p>{s}</p><ul><li><a href="/t">terms</a></li><li><a href="/p">privacy</a></li></ul></footer>', '<div class="footer" data-main="0"><p>{l}</p></div>', '<div id="footer" data-main="0">all rights reserved. {s}</div>',
    '<aside data-main="0"><h3>{t}</h3><p>{l}</p></aside>', '<aside class="sidebar" data-main="0"><h2>most read</h2><ul><li><a href="/a">{t}</a></li><li><a href="/b">{t}</a></li></ul></aside>', '<div class="sidebar" data-main="0"><h3>{t}</h3><p>{s}</p><div>{l}</div></div>', '<div id="sidebar" data-main="0"><section><p>{l}</p></section></div>',
    '<div class="cookie-notice" data-main="0"><p>we use cookies. {s}</p></div>', '<div id="cookie-banner" data-main="0">{s} <a href="/c">accept</a></div>', '<div class="notice" data-main="0">{l}</div>', '<div class="banner" data-main="0"><p>{s}</p></div>', '<div class="consent gdpr" data-main="0"><p>{l}</p></div>', '<div class="popup modal" data-main="0"><p>{s}</p></div>', '<div class="alert" data-main="0">{s}</div>', '<section class="notice" data-main="0"><p>{l}</p></section>', '<p class="notice" data-main="0">{l}</p>', '<p class="disclaimer" data-main="0">{l}</p>',
    '<form data-main="0"><p>{s}</p><label>email</label><input name="e"></form>', '<form class="search" data-main="0"><input name="q"><label>search</label></form>', '<div class="newsletter subscribe" data-main="0"><p>{s}</p><form><label>mail</label></form></div>',
    '<div class="topbar" data-main="0"><a href="/l">log in</a></div>', '<div class="site footer" data-main="0"><p>{s}</p></div>', '<div class="comments area" data-main="0"><p>{l}</p></div>', '<section class="user comments" data-main="0"><p>{s}</p></section>', '<div class="widget" data-main="0"><p>{s}</p></div>', '<div class="recommended" data-main="0"><h3>{t}</h3><p>{s}</p></div>',
    '<div class="comments" data-main="0"><h3>comments</h3><div class="comment"><p>{s}</p></div><div class="comment"><p>{l}</p></div></div>', '<section id="comments" data-main="0"><h2>{t}</h2><ul><li><p>{l}</p></li><li><p>{s}</p></li></ul></section>', '<section class="comments" data-main="0"><article class="comment"><p>{l}</p></article><article><p>{s}</p></article></section>', '<ol class="comment-list" data-main="0"><li class="comment">{l}</li><li class="comment"><p>{s}</p></li></ol>', '<div class="reply" data-main="0"><p>{l}</p></div>', '<div class="discussion responses" data-main="0"><p>{l}</p></div>',
    '<div id="disqus_thread" data-main="0"><p>{l}</p></div>', '<div id="respond" class="commentlist" data-main="0"><p>{s}</p></div>', '<div class="zzunseen" data-main="0"><a href="/a">one</a> <a href="/b">two</a> <a href="/c">three</a></div>', '<ul class="zzunseen" data-main="0"><li><a href="/a">{t}</a></li><li><a href="/b">{t}</a></li></ul>',
]
INNER = [
    "", '<div class="ad" data-main="0">{s}</div>', '<div class="ads" data-main="0"><p>{l}</p></div>', '<div class="advert" data-main="0">{s}</div>', '<div class="advertisement" data-main="0"><p>{s}</p></div>', '<aside class="ad" data-main="0">{s}</aside>', '<section class="promo" data-main="0"><p>{l}</p></section>', '<div class="sponsored" data-main="0"><p>{l}</p></div>', '<p class="ad" data-main="0">{s}</p>', '<p class="sponsored promo" data-main="0">{l}</p>',
    '<div class="share social" data-main="0"><a href="/f">share</a> <a href="/t">post</a></div>', '<div class="related" data-main="0"><h3>more</h3><ul><li><a href="/a">{t}</a></li><li><a href="/b">{t}</a></li></ul></div>', '<nav class="breadcrumb" data-main="0"><a href="/">home</a> <a href="/a">news</a></nav>', '<div class="pagination" data-main="0"><a href="/2">2</a> <a href="/3">3</a></div>',
    '<div class="tags" data-main="0"><a href="/a">{t}</a> <a href="/b">{t}</a></div>', '<aside data-main="0"><p>{s}</p></aside>', '<form data-main="0"><label>{t}</label><p>{s}</p></form>', '<div class="hidden" hidden data-main="0"><p>{l}</p></div>', '<div class="author byline meta" data-main="0">by a. writer, {t}</div>', '<footer data-main="0"><p>{s}</p></footer>',
]
PAGE = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{{t}}</title><script>var a="<p>";</script></head><body>{top}{left}{main}{low}</body></html>'
BARE = "{top}{left}{main}{low}"  # without html and body
TITLES = ["a quiet year", "what the council said about the bridge and why it matters"]


def labelled_pages(spark: SparkSession, text_col: str = "html") -> DataFrame:
    """Pages of every container, body and inner part, with outer parts taken in turn."""
    pick = lambda xs, i: F.get(F.array(*[F.lit(x) for x in xs]), i.cast("int"))
    row = F.col("id")
    rest = F.floor(row / len(CONTAINERS))
    grid = spark.range(0, len(CONTAINERS) * len(BODIES) * len(INNER), 1, 4).select(
        "id", pick(CONTAINERS, row % len(CONTAINERS)).alias("c"), pick(BODIES, rest % len(BODIES)).alias("b"), pick(INNER, F.floor(rest / len(BODIES))).alias("n"),
        *[pick(OUTER, (row * (7 + 4 * k) + k * 11) % len(OUTER)).alias(f"o{k + 1}") for k in range(3)],
    )
    put = lambda frame, key, col: F.replace(frame, F.lit(key), col)
    before = F.when(F.col("id") % 2 == 0, F.concat("n", "b")).otherwise(F.concat("b", "n"))
    page = F.when(F.col("id") % 11 == 0, F.lit(BARE)).otherwise(F.lit(PAGE))
    for key, col in (("{top}", F.col("o1")), ("{left}", F.col("o2")), ("{low}", F.col("o3")), ("{main}", F.expr("replace(c, '{}', '{body}')")), ("{body}", before)):
        page = put(page, key, col)
    page = put(page, "{{t}}", F.lit(TITLES[0]))
    title = F.when(F.col("id") % 3 == 0, F.lit(TITLES[1])).otherwise(F.lit(TITLES[0]))
    long = F.when(F.col("id") % 5 == 0, F.lit(f"{LONG} {LONG} {LONG}")).otherwise(F.lit(LONG))
    for key, col in (("{t}", title), ("{s}", F.lit(SHORT)), ("{l}", long)):
        page = put(page, key, col)
    return grid.select(page.alias(text_col))
