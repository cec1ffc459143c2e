"""Field and cleanup rules of the known sites, as literal rows.

Everything in this file is a fixed value: element names, attribute values,
phrases and constants the portals use. A field without a rule takes the
default chain; the tables hold only what differs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.operators.extract import CHECKS, FIELDS, SITE_RULES, register_rule_kind
from kliping.rules.notation import at, ban, const, drop, every, ld, link, meta, need, node, rule, url

# --- fixed values: defaults ----------------------------------------------------
DEFAULT_FIELDS = {
    "post_id": [],
    "author": [],
    "pubdate": [meta("article:published_time")],
    "category": [link("category")],
    "subcategory": [link("subcategory")],
    "comments": [],
    "images": [meta("og:image")],
    "title": [meta("og:title")],
    "tags": [],
    "caption": [],
}
NEED_JSONLD = need("jsonld", at("script", "application/ld+json", "type"))
NO_MEDIA = ban("subcategory", "foto", "video")
MEDIA_SEGMENTS = ban("segment", "video", "foto", "uncategorized", "promo")

# --- fixed values: cleanup rules several sites share ---------------------------
SCRIPTED_DIV = drop("div", child="script")
SCRIPT = drop("script")
NOSCRIPT = drop("noscript")
FIGURE = drop("figure")
READ_ALSO = drop("p", phrase="baca juga", child="a", mode="self")
READ_LINK = drop("a", child="strong", phrase="baca")
READ_PARAGRAPH = drop("p", child="strong", phrase="baca")
READ_LIST = drop("ul", child="em", phrase="baca")
WIDGETS = [SCRIPTED_DIV, SCRIPT, NOSCRIPT]

# --- fixed values: sites of one sector carry it as their category -----------------
SECTORS = {
    "Otomotif": [
        "carmudi", "carreview", "cintamobil", "gridoto", "mobil123", "oto", "otodriver", "otomart", "otorider",
        "otosia", "rajamobil",
    ],
    "Properti": ["housingestate", "rumah", "rumah123", "rumahhokie"],
    "properti": ["propertiterkini", "rumahku"],
}

# --- fixed values: sites ---------------------------------------------------------
SITES = {
    "antara": {
        "fields": {
            "post_id": [node(at("input", "news_id", "name"), take="value")],
            "title": [ld("$.headline")],
            "pubdate": [ld("$.datePublished")],
            "author": [ld("$.author.name")],
            "category": [ld("$.keywords[0][0]", pattern="^([^:]*)")],
            "subcategory": [ld("$.keywords[0][0]", pattern="^[^:]*:([^:]*)")],
            "tags": [node(at("ul", "tags-widget clearfix"), every("a"))],
            "images": [meta("twitter:image", "name")],
        },
        "required": [NEED_JSONLD, need("article", at("article", "post-wrapper clearfix"))],
        "banned": [ban("segment", "video", "foto", "infografis")],
        "body": [node(at("article", "post-wrapper clearfix"), at("div", "post-content clearfix"))],
        "drops": [
            drop("p", "text-muted small"), drop("strong", phrase="foto"), drop("strong", phrase="video"),
            drop("b", phrase="baca juga"),
        ],
    },
    "carmudi": {
        "fields": {
            "post_id": [node(at("a", "vw-post-shares-social vw-post-shares-social-facebook"), take="data-post-id")],
            "title": [node(at("article", "vw-main-post"), at("h1", "entry-title"))],
            "pubdate": [node(at("article", "vw-main-post"), at("time", "datePublished", "itemprop"), take="datetime")],
            "author": [node(at("article", "vw-main-post"), at("a", "author-name"))],
            "subcategory": [
                node(at("div", "vw-breadcrumb vw-breadcrumb-envirra"), at("span", "v:Breadcrumb", "typeof", 2))
            ],
            "tags": [node(at("article", "vw-main-post"), at("div", "vw-tag-links"), every("a"))],
            "comments": [node(at("a", "vw-post-meta-icon vw-post-comment-count"))],
        },
        "required": [need("breadcrumb", at("div", "vw-breadcrumb vw-breadcrumb-envirra"))],
        "body": [node(at("article", "vw-main-post"), at("div", "vw-post-content clearfix"))],
        "drops": [SCRIPTED_DIV, FIGURE, SCRIPT, READ_ALSO],
    },
    "carreview": {
        "fields": {
            "title": [node(at("div", "left-content"), at("h1", "entry-title"))],
            "pubdate": [node(at("div", "left-content"), at("li", "publish-date"))],
            "author": [node(at("div", "left-content"), at("span", "author", "itemprop"))],
            "tags": [node(at("div", "left-content"), at("div", "post-meta"), every("a"), remove="#")],
        },
        "body": [node(at("div", "left-content"), at("div", "entry-content"))],
        "drops": [*WIDGETS, drop("p", "lead"), READ_LINK],
    },
    "cintamobil": {
        "fields": {
            "post_id": [node(at("input", "ArticleId", "id"), take="value")],
            "pubdate": [
                node(
                    at("div", "list-review w--100 pull-left"), at("h1", "title fsize-20 fweight-bold mg-bottom-5"),
                    at("*", axis="next"), at("span"),
                )
            ],
            "author": [
                node(at("div", "list-review w--100 pull-left"), at("span", "blue-clr text-right full-width display-ib"))
            ],
            "tags": [
                node(at("div", "list-review w--100 pull-left"), at("div", "w--100 pull-left text-left mg-top-20"), every("a"))
            ],
        },
        "body": [node(at("div", "list-review w--100 pull-left"), at("div", "w--100 pull-left set-relative detail-font"))],
        "drops": [SCRIPT, NOSCRIPT, READ_LINK],
    },
    "detik": {
        "fields": {
            "post_id": [meta("articleid", "name")],
            "title": [node(at("article"), at("meta", "og:title", "property"), take="content"), meta("og:title")],
            "pubdate": [meta("publishdate", "name"), node(at("span", "date"))],
            "author": [meta("author", "name")],
            "subcategory": [node(at("div", "breadcrumb"), at("a", pick=2))],
            "tags": [node(at("article"), at("div", "detail_tag"), every("a"))],
            "images": [node(at("article"), at("div", "pic_artikel"), at("img"), take="src")],
            "comments": [node(at("a", "komentar"), at("span"))],
        },
        "required": [need("breadcrumb", at("div", "breadcrumb"))],
        "banned": [ban("subcategory", "foto", "detiktv", "video", "photos", "videos")],
        "body": [
            node(at("article"), at("div", "detail_text"), only="news"),
            node(at("article"), at("div", "detikdetailtext", "id"), only="!news"),
            node(at("div", "read__content full mt20"), only="!news"),
            node(at("div", "detikdetailtext", "id"), only="!news"),
        ],
        "drops": [
            drop("table", "linksisip"), drop("div", "sisip_embed_sosmed"),
            drop("div", "clearfix mb20", mode="after"), SCRIPT, READ_ALSO,
        ],
        "cut": "Tonton juga",
    },
    "gridoto": {
        "fields": {
            "post_id": [meta("content_id", "name")],
            "title": [ld("$.headline", "last")],
            "pubdate": [meta("content_date", "name")],
            "author": [meta("content_author", "name")],
            "tags": [meta("content_tag", "name")],
        },
        "required": [NEED_JSONLD],
        "body": [node(at("div", "read__article clearfix"), at("div", "read__right"))],
        "drops": [*WIDGETS, READ_PARAGRAPH],
    },
    "housingestate": {
        "fields": {
            "post_id": [node(at("div", "ajax-load-more", "id"), take="data-post-id")],
            "author": [node(at("div", "post-content", "id"), at("span", "author"))],
            "subcategory": [meta("article:section")],
            "tags": [meta("article:tag")],
        },
        "body": [node(at("div", "post-content", "id"), at("div", "content-txt"))],
        "drops": [*WIDGETS, READ_PARAGRAPH],
    },
    "idntimes": {
        "fields": {
            "title": [ld("$.headline", "before_last")],
            "pubdate": [node(at("time", "date"), take="datetime")],
            "author": [ld("$.author.name", "before_last")],
            "category": [ld("$.itemListElement[0].item.name", "last")],
            "subcategory": [ld("$.itemListElement[1].item.name", "last")],
            "tags": [node(at("section", "content-post clearfix"), at("div", "content-post-topic"), every("a"))],
            "images": [ld("$.image.url", "before_last")],
        },
        "required": [need("jsonld", at("script", "application/ld+json", "type", 2))],
        "body": [node(at("section", "content-post clearfix"), at("article", "article-content", "id"))],
        "drops": [SCRIPTED_DIV, drop("strong", phrase="baca juga")],
    },
    "kompas": {
        "fields": {
            "post_id": [meta("cXenseParse:articleid", "name")],
            "title": [node(at("h1", "read__title"))],
            "pubdate": [meta("content_PublishedDate", "name")],
            "author": [node(at("div", "read__author"))],
            "subcategory": [node(at("ul", "breadcrumb__wrap"), at("li", pick=3))],
            "tags": [meta("content_tag", "name")],
        },
        "body": [node(at("div", "read__content"))],
        "drops": [SCRIPT, drop("p", child="strong", phrase="baca juga:")],
    },
    "liputan6": {
        "source": "Liputan6",
        "fields": {
            "post_id": [node(at("article", "hentry main read-page--core-article"), take="data-article-id")],
            "pubdate": [node(at("p", "read-page--header--author__datetime-wrapper"), at("time"), take="datetime")],
            "author": [
                node(at("a", "read-page--header--author__link url fn"), at("span", "read-page--header--author__name fn"))
            ],
            "category": [node(at("ul", "read-page--breadcrumb"), at("a", pick=-2))],
            "subcategory": [node(at("ul", "read-page--breadcrumb"), at("a", pick=-1))],
            "tags": [node(every("span", "tags--snippet__name"))],
            "images": [node(at("picture", "read-page--photo-gallery--item__picture"), at("img"), take="src")],
            "comments": [
                node(
                    at("li", "read-page--social-share__list-item js-social-share-comment"), at("a"),
                    at("span", "read-page--social-share__comment-total"),
                )
            ],
        },
        "required": [need("breadcrumb", at("ul", "read-page--breadcrumb"))],
        "banned": [ban("title", "foto:", "video:")],
        "body": [node(at("div", "article-content-body__item-content"))],
        "drops": [
            drop("div", "baca-juga"), drop("p", phrase="saksikan video di bawah"),
            drop("p", phrase="saksikan video pilihan di bawah"),
            drop("p", phrase="saksikan cuplikan pertandingan dari liga inggris"),
        ],
    },
    "metrotv": {
        "source": "metrotvnews",
        "fields": {
            "post_id": [node(at("meta", "og:image", "property"), take="content", pattern=r"^[^/]*//[^/]*(?:/[^/]*){5}/([^/]*)")],
            "pubdate": [meta("og:updated_time")],
            "author": [node(at("div", "reg"), take="string", pattern="(?s)^(.*?)(?: \\x{a0}\\x{a0} \\x{2022}|$)")],
            "category": [node(at("div", "breadcrumbs"), at("a", pick=-2))],
            "subcategory": [node(at("div", "breadcrumbs"), at("a", pick=-1))],
            "tags": [node(at("div", "line"), every("a", "tag"))],
            "images": [node(at("img", "pic"), take="src")],
        },
        "required": [need("breadcrumb", at("div", "breadcrumbs"))],
        "banned": [NO_MEDIA],
        "body": [node(at("div", "tru"))],
        "drops": [drop("div", "related"), drop("iframe", "embedv"), SCRIPT, drop("table")],
    },
    "mobil123": {
        "fields": {
            "post_id": [meta("ga:cns:details:news_id", "name")],
            "title": [node(at("h1", "article__title push-quarter--bottom"))],
            "pubdate": [node(at("div", "article__meta"), at("span", "datePublished", "itemprop"))],
            "author": [meta("ga:cns:details:author", "name")],
            "subcategory": [node(at("div", "article__content--header"), at("a"))],
            "tags": [meta("keywords", "name")],
            "images": [node(at("div", "image", "itemprop"), at("img"), take="data-src")],
        },
        "required": [need("breadcrumb", at("div", "article__content--header"))],
        "banned": [NO_MEDIA],
        "body": [node(at("div", "article__story-more"))],
        "drops": [
            drop("p", phrase="baca juga"), drop("div"), drop("small"),
            drop("p", phrase="temukan mobil idaman dimobil123"),
            drop("p", phrase="mari bergabung bersama kami difacebookdantwitter"),
        ],
    },
    "okezone": {
        "fields": {
            "post_id": [ld("$.mainEntityOfPage['@id']", "dated")],
            "title": [ld("$.headline", "dated")],
            "pubdate": [ld("$.datePublished", "dated")],
            "author": [ld("$.author.name", "dated")],
            "category": [node(at("div", "breadcrumb"), at("a", pick=-2))],
            "subcategory": [node(at("div", "breadcrumb"), at("a", pick=-1))],
            "tags": [node(at("div", "container-bodyhome-left"), at("div", "detail-tag"), every("a"))],
            "comments": [node(at("span", "commentWidget-total"), at("b"))],
        },
        "required": [NEED_JSONLD, need("breadcrumb", at("div", "breadcrumb"))],
        "banned": [NO_MEDIA],
        "body": [node(at("div", "container-bodyhome-left"), at("div", "contentx", "id"))],
        "drops": [
            drop("table", "linksisip"), SCRIPTED_DIV, drop("div", "clearfix mb20", mode="after"), SCRIPT, NOSCRIPT,
            READ_LINK,
        ],
    },
    "oto": {
        "fields": {
            "post_id": [url("([^-]{1,5})$")],
            "title": [node(at("article", "newslistouter container-base"), at("h1"))],
            "pubdate": [ld("$.datePublished", "last")],
            "author": [node(at("div", "publish-cont"), at("a"))],
            "subcategory": [node(at("ul", "breadcrumb"), at("li", pick=-2))],
            "tags": [ld("$.keywords", "last")],
            "images": [node(at("div", "content"), at("img"), take="src")],
        },
        "required": [need("breadcrumb", at("ul", "breadcrumb"))],
        "banned": [ban("title", "foto:", "video:")],
        "body": [node(at("div", "content"))],
        "drops": [drop("img"), drop("div"), drop("p", phrase="sumber:"), READ_ALSO],
    },
    "otodriver": {
        "fields": {
            "pubdate": [node(at("div", "left-content"), at("meta", "datePublished", "itemprop"), take="content")],
            "author": [meta("article:author")],
            "tags": [node(at("div", "left-content"), at("div", "post-meta"), every("a"), remove="#")],
            "images": [meta("twitter:image")],
        },
        "required": [need("article", at("div", "left-content"))],
        "body": [node(at("div", "left-content"), at("div", "entry-content detail-content"))],
        "drops": [*WIDGETS, READ_LINK],
    },
    "otomart": {
        "source": "otomart.com",
        "escaped_twice": True,
        "fields": {
            "title": [node(at("h1", "entry-title"))],
            "author": [node(at("span", "vcard author"), at("span", "fn"))],
            "subcategory": [node(at("a", "category tag", "rel"))],
            "tags": [node(every("meta", "article:tag", "property"), take="content")],
            "images": [meta("og:image:secure_url")],
            "comments": [node(at("span", "postcommentscount"))],
        },
        "required": [need("category_tag", at("a", "category tag", "rel"))],
        "banned": [NO_MEDIA],
        "body": [node(at("div", "entry-content"))],
        "drops": [FIGURE, drop("h4")],
    },
    "otosia": {
        "fields": {
            "title": [node(at("h1", "OtoDetailT"))],
            "pubdate": [node(at("span", "newsdetail-schedule"))],
            "author": [
                node(at("span", "newsdetail-schedule", pick=2), pattern=r"^(?:Editor ?: ?)?(.*?)(?: \| .*)?$"),
                node(at("span", "reporter"), pattern=r"^(?:Editor ?: ?)?(.*?)(?: \| .*)?$"),
            ],
            "subcategory": [node(at("div", "v5-navigation", "id"), at("a", pick=-1))],
            "tags": [node(at("div", "detags"), every("a"))],
            "images": [node(at("div", "mobart-detail", "id"), at("img", "lazy_loaded"), take="data-src")],
        },
        "required": [need("breadcrumb", at("div", "v5-navigation", "id"))],
        "banned": [NO_MEDIA],
        "body": [node(at("div", "OtoDetailNews"))],
        "drops": [drop("div", "relatedContentBox"), drop("table"), SCRIPT],
    },
    "propertiterkini": {
        "fields": {
            "title": [node(at("h1", "name post-title entry-title"), at("span"), take="string")],
            "author": [node(at("span", "post-meta-author"))],
            "subcategory": [node(at("div", "crumbs", "id"), at("a", pick=-1), take="string")],
            "tags": [node(at("p", "post-tag"), every("a"))],
            "images": [node(at("div", "single-post-thumb"), at("img"), take="src")],
        },
        "required": [need("breadcrumb", at("div", "crumbs", "id"))],
        "body": [node(at("div", "entry"))],
        "drops": [
            drop("div", "share-post", phrase="share"), drop("td"), drop("section", "related_posts", "id"), drop("ul"),
            drop("p", phrase="baca juga:"), drop("p", phrase="propertiterkini.com"),
            drop("div", "sharedaddy sd-sharing-enabled"), drop("h3", "sd-title"), drop("span", "button"),
            drop("div", "likes-widget-placeholder post-likes-widget-placeholder"),
        ],
    },
    "rajamobil": {
        "fields": {
            "post_id": [node(at("input", "comment_post_ID", "id"), take="value")],
            "title": [node(at("h1", "entry-title"))],
            "author": [node(at("div", "td-post-author-name"), at("a"))],
            "tags": [node(at("div", "td-pb-span8 td-main-content"), every("meta", "article:tag", "property"), take="content")],
        },
        "banned": [MEDIA_SEGMENTS],
        "body": [node(at("div", "td-pb-span8 td-main-content"), at("div", "td-post-content"))],
        "drops": [drop("div"), SCRIPT, NOSCRIPT, FIGURE, READ_LIST],
        "soft_drops": [drop("div", "post-views"), drop("div", "essb_links")],
    },
    "rumah": {
        "fields": {
            "post_id": [node(at("input", "itemId", "name"), take="value")],
            "pubdate": [
                node(at("div", "contents news-detail"), at("span", "datePublished", "itemprop"), take="content")
            ],
            "author": [node(at("div", "contents news-detail"), at("p", "news-quick-info"), at("span"))],
            "subcategory": [node(at("ol", "breadcrumb"), at("li", pick=2))],
        },
        "required": [need("title", at("meta", "og:title", "property"))],
        "body": [node(at("div", "contents news-detail"), at("div", "news-article-body"))],
        "drops": [drop("div"), SCRIPT, drop("iframe"), NOSCRIPT, FIGURE, drop("p", mode="byline")],
    },
    "rumah123": {
        "fields": {
            "post_id": [url("([^-]*)$")],
            "pubdate": [node(at("div", "post-wrapper"), at("meta", "datePublished", "itemprop"), take="content")],
            "author": [node(at("div", "post-wrapper"), at("div", "post-author"))],
            "subcategory": [node(at("ol", "breadcrumb"), at("li", pick=-2))],
        },
        "required": [need("article", at("div", "post-wrapper"))],
        "banned": [ban("subcategory", "photo", "video")],
        "body": [node(at("div", "post-wrapper"), at("div", "post-text"))],
        "drops": [drop("div"), SCRIPT, NOSCRIPT, FIGURE, drop("p", child="p", phrase="baca", also=["strong", "a"])],
    },
    "rumahhokie": {
        "fields": {
            "post_id": [node(at("link", "shortlink", "rel"), take="href", pattern=r"\?p=(\d+)")],
            "title": [node(at("h1", "entry-title"))],
            "author": [node(at("div", "td-post-author-name"), at("a"))],
            "tags": [node(at("div", "td-ss-main-content"), every("meta", "article:tag", "property"), take="content")],
        },
        "banned": [MEDIA_SEGMENTS],
        "body": [node(at("div", "td-ss-main-content"), at("div", "td-post-content"))],
        "drops": [*WIDGETS, FIGURE, READ_LIST],
    },
    "rumahku": {
        "fields": {
            "post_id": [url(r"([^-]*?)[/.]*$")],
            "title": [node(at("h4", "margin-bottom-2"), take="string")],
            "pubdate": [node(at("span", "date small-text", pick=-2), take="string")],
            "author": [
                node(at("div", "title-article margin-bottom-4"), at("label", "normal t-purple"), take="string")
            ],
            "subcategory": [node(at("div", "container"), at("ul"), at("li", pick=-2), take="string")],
        },
        "required": [need("breadcrumb", at("div", "container"), at("ul"))],
        "body": [node(at("div", "text-article"), at("div", "text"))],
        "drops": [
            drop("p", tail=7, when="untuk keperluan info bisa kunjungi website"),
            drop("span", "font-size:20px;", "style", when="baca juga"),
        ],
    },
    "seva": {
        "escaped_twice": True,
        "fields": {
            "post_id": [node(at("link", "shortlink", "rel"), take="href", pattern=r"\?p=(\d+)")],
            "title": [node(at("div", "news-content border-list"), at("div", "title"), at("h1"))],
            "author": [node(at("div", "col-md-8"), at("div", "col-md-10"), at("div", "details"))],
            "tags": [node(every("meta", "article:tag", "property"), take="content")],
        },
        "body": [node(at("div", "news-content border-list"), at("div", "content"))],
        "drops": [],
    },
    "sindonews": {
        "source": "Sindonews",
        "fields": {
            "post_id": [url("^[^/]*//[^/]*/[^/]*/([^/]*)")],
            "title": [node(at("div", "article"), at("h1"))],
            "pubdate": [node(at("time"))],
            "author": [node(at("p", "author"), at("a"))],
            "category": [node(at("ul", "breadcrumb"), at("a", pick=-2))],
            "subcategory": [node(at("ul", "breadcrumb"), at("a", pick=-1))],
            "tags": [node(at("div", "tag-list"), every("a"))],
            "images": [node(at("div", "article"), at("img"), take="src")],
        },
        "required": [need("breadcrumb", at("ul", "breadcrumb"))],
        "body": [node(at("div", "content", "id"))],
        "drops": [drop("strong", phrase="baca juga"), SCRIPT, drop("img")],
    },
    "tempo": {
        "fields": {
            "post_id": [meta("dable:item_id")],
            "title": [ld("$.headline")],
            "pubdate": [ld("$.datePublished")],
            "author": [ld("$.editor.name")],
            "category": [ld("$.itemListElement[*].item.name", "second", pattern=r'"([^"]*)","[^"]*"\]$')],
            "subcategory": [ld("$.itemListElement[*].item.name", "second", pattern=r'"([^"]*)"\]$')],
            "tags": [
                node(at("article", "http://schema.org/NewsArticle", "itemtype"), at("div", "tags clearfix"), every("a"))
            ],
            "images": [ld("$.image.url")],
        },
        "required": [NEED_JSONLD, need("article", at("article", "http://schema.org/NewsArticle", "itemtype"))],
        "body": [node(at("article", "http://schema.org/NewsArticle", "itemtype"), at("div", "isi", "id"))],
        "drops": [SCRIPTED_DIV, drop("p", phrase="baca:")],
        "escaped_json": True,
    },
    "tirto": {
        "source": "tirto.id",
        "fields": {
            "title": [node(at("h1", "news-detail-title text-center animated zoomInUp my-3"))],
            "pubdate": [
                node(at("span", "detail-date mt-1 text-left"), pattern="(?:^|- )([^-]*)$"),
                node(at("span", "detail-date mt-1")),
            ],
            "author": [node(at("span", "detail-date mt-1 text-left"), pattern=r"^(?:Oleh: )?(.*?)\s*(?:- .*)?$")],
            "category": [node(at("ol", "breadcrumbs"), at("a", pick=-1))],
            "subcategory": [],
            "tags": [meta("keywords", "name")],
            "images": [meta("thumbnail", "name")],
            "caption": [node(at("div", "col-12 photograph-caption-holder mt-2"))],
        },
        "required": [need("breadcrumb", at("ol", "breadcrumbs"))],
        "banned": [
            ban("category", "foto", "video", "infografik tunggal"), ban("caption", "infografik"),
            ban("tags", "infografik tunggal", "video"),
        ],
        "body": [node(at("article", "col-12 content-detail-holder my-4"), at("div", "content-text-editor", pick=2))],
        "drops": [drop("div")],
    },
    "tribun": {
        "source": "tribunnews",
        "fields": {
            "post_id": [meta("android:app_id")],
            "title": [ld("$.headline")],
            "pubdate": [ld("$.datePublished")],
            "author": [ld("$.author.name")],
            "category": [meta("cXenseParse:category", "name"), const("Berita")],
            "subcategory": [meta("cXenseParse:category", "name", 2)],
            "tags": [node(at("div", "article_con", "id"), at("div", "mb10 f16 ln24 mb10 mt5"), every("a"), remove="#")],
            "images": [ld("$.image.url")],
        },
        "required": [NEED_JSONLD],
        "body": [node(at("div", "article_con", "id"), at("div", "side-article txt-article"))],
        "drops": [*WIDGETS, drop("p", "baca", child="strong", phrase="baca")],
    },
    "viva": {
        "fields": {
            "post_id": [ld("$.mainEntityOfPage['@id']", "dated")],
            "title": [node(at("section", "viva-content", "id"), at("div", "leading-title"), at("h1"))],
            "pubdate": [ld("$.datePublished", "dated")],
            "author": [ld("$.author[0].name", "dated")],
            "category": [node(at("div", "leading-breadcrumb"), at("a"))],
            "subcategory": [node(at("div", "leading-breadcrumb"), at("a", pick=2))],
            "tags": [meta("news_keywords", "name")],
            "comments": [node(at("section", "viva-content", "id"), at("comment-count"))],
        },
        "required": [NEED_JSONLD, need("breadcrumb", at("div", "leading-breadcrumb"))],
        "banned": [NO_MEDIA],
        "body": [node(at("section", "viva-content", "id"), at("div", "article-detail article-detail-v2"))],
        "drops": [drop("div"), SCRIPT],
    },
}
# The same markup, but the listing link carries a section number for a name.
SECTION_CODES = {"1": "Tips Modifikasi", "12": "Berita"}
OTHER_SECTION = "Komunitas"
SITES["otorider"] = SITES["otodriver"] | {
    "fields": SITES["otodriver"]["fields"] | {"subcategory": [rule("section")]}
}
# -----------------------------------------------------------------------------------


def section_name(page: Column, _: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SECTION_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, page["link_subcategory"]), F.lit(OTHER_SECTION))


register_rule_kind("section", section_name)


def rule_row(site: str, rules: dict) -> dict:
    sector = {"category": [const(name)] for name, sites in SECTORS.items() if site in sites}
    fields = DEFAULT_FIELDS | sector | rules.get("fields", {})
    return {
        "site": site,
        "source": rules.get("source", site),
        "fields": [fields[f] for f in FIELDS + CHECKS],
        "required": rules.get("required", []),
        "banned": rules.get("banned", []),
        "body": rules["body"],
        "drops": rules.get("drops", []),
        "soft_drops": rules.get("soft_drops"),
        "cut": rules.get("cut"),
        "escaped_twice": rules.get("escaped_twice", False),
        "escaped_json": rules.get("escaped_json", False),
    }


def site_rules(spark: SparkSession, more: dict[str, dict] | None = None) -> DataFrame:
    """One literal row per site; ``more`` adds sites or replaces known ones."""
    rows = [rule_row(site, rules) for site, rules in (SITES | (more or {})).items()]
    return spark.createDataFrame(rows, SITE_RULES)
