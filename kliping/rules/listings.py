"""Listing rules of the known sites, as literal rows.

Everything in the table is a fixed value: addresses, element names, attribute
values and page sizes the portals use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kliping.functions import urls
from kliping.operators.links import LISTING_RULES
from kliping.rules.notation import at, every, having

ANY_LINK = [having("a", "href")]
PAGER = at("ul", "pagination")

# --- fixed values: listings -----------------------------------------------------
# next: (kind, steps, value taken); see plan.last_page for the kinds.
LISTINGS = {
    "antara": {
        "template": "https://www.antaranews.com/search/%20/{dd}-{MM}-{yyyy}/{dd}-{MM}-{yyyy}/{page}",
        "items": [[at("div", "post-content clearfix"), every("article")]],
        "badge": [at("p", "slug")],
        "next": ("number", [at("ul", "pagination pagination-sm"), at("a", pick=-1)], "text"),
    },
    "carmudi": {
        "template": "https://www.carmudi.co.id/journal/page/{page}",
        "items": [
            [
                at("div", "vw-loop vw-loop--medium vw-loop--medium-6 vw-loop--col-2"),
                every("a", "vw-post-box__read-more vw-button vw-button--small vw-button--accent"),
            ]
        ],
        "link": [],
        "stops": True,
        "next": ("number", [at("div", "vw-page-navigation-pagination"), at("a", pick=-2)], "text"),
    },
    "carreview": {
        "template": "http://carreview.id/{cat}?page={page}",
        "items": [[every("div", "post")]],
        "stops": True,
        "next": ("number", [PAGER, at("li", pick=-2)], "text"),
    },
    "cintamobil": {
        "template": "https://cintamobil.com/{cat}/{cat}/p{page}",
        "prefix": "https://cintamobil.com",
        "items": [[every("li", "item-carreview")]],
        "stops": True,
        "next": ("tail", [at("ul", "paging pull-right"), at("li", pick=-1), at("a")], "href"),
    },
    "detik": {
        "template": "https://{cat}.detik.com/indeks/{page}?date={MM}/{dd}/{yyyy}",
        "section": "news",
        "section_template": "https://news.detik.com/indeks/all/{page}?date={MM}/{dd}/{yyyy}",
        "items": [
            [at("div", "lf_content"), every("article")], [at("div", "content right"), every("article")],
            [at("div", "rm_content"), every("article")],
        ],
        "badge": [at("span", "sub_judul")],
        "next": ("number", [at("div", "paging paging2"), at("a", pick=-2)], "text"),
    },
    "gridoto": {
        "template": "https://www.gridoto.com/index?day={d}&month={M}&year={yyyy}&section=all&page={page}",
        "items": [[every("div", "news-list__item l-index clearfix")]],
        "link": [at("a", "news-list__link")],
        "label": [at("a", "cateskew")],
        "next": ("number", [at("ul", "pagination_number"), at("li", pick=-1)], "text"),
    },
    "housingestate": {
        "template": (
            "http://housingestate.id/wp-admin/admin-ajax.php?action=alm_query_posts&order=DESC&orderby=date"
            "&month={M}&year={yyyy}&day={d}"
        ),
        "form": "envelope",
        "items": [[every("div", "item-box")]],
        "next": ("one", [], None),
    },
    "idntimes": {
        "template": "https://www.idntimes.com/ajax/index?category={cat}&type=all&page={page}&date={yyyy}-{MM}-{dd}",
        "items": [[every("div", "box-latest box-list")]],
        "next": ("more", [at("div", "box-latest box-list")], "class"),
    },
    "kompas": {
        "template": "https://indeks.kompas.com/{cat}/{yyyy}-{MM}-{dd}/{page}",
        "items": [[every("div", "article__list clearfix")]],
        "next": (
            "number", [at("div", "paging__wrap clearfix"), at("div", "paging__item", pick=-1), at("a")],
            "data-ci-pagination-page",
        ),
    },
    "liputan6": {
        "template": "https://www.liputan6.com/{cat}/indeks/{yyyy}/{MM}/{dd}?page={page}",
        "items": [[at("div", "articles--list articles--list_rows"), every("figure")]],
        "next": (
            "number",
            [at("div", "simple-pagination__container"), at("ul"), at("li", "simple-pagination__page-number", pick=-1)],
            "data-page",
        ),
    },
    "metrotv": {
        "template": "http://{cat}.metrotvnews.com/index/{yyyy}/{MM}/{dd}/{offset}",
        "page_size": 30,
        "items": [[at("div", "style_06"), every("li")]],
        "link": [at("h2"), having("a", "href")],
        "next": ("number", [at("div", "grid"), at("div", "bu fr", pick=-1), at("a")], "data-ci-pagination-page"),
    },
    "mobil123": {
        "template": "https://www.mobil123.com/berita/terbaru?page_number={page}",
        "items": [[every("article", "article article--listing media push--bottom")]],
        "stops": True,
        "next": ("number", [PAGER, at("a", pick=-1)], "data-page"),
    },
    "okezone": {
        "template": "https://index.okezone.com/bydate/index/{yyyy}/{MM}/{dd}/{offset}/",
        "page_size": 15,
        "items": [[at("div", "news-content"), every("li")]],
        "next": ("offset", [at("div", "pagination-indexs"), at("a", pick=-1)], "href"),
    },
    "oto": {
        "template": "https://www.oto.com/{cat}?page={page}",
        "page_size": 12,
        "items": [[every("li", "card")]],
        "stops": True,
        "next": ("count", [at("div", "news-count"), at("span")], "text"),
    },
    "otodriver": {
        "template": "http://otodriver.com/{cat}?page={page}&per-page=18",
        "page_size": 18,
        "items": [[every("div", "col-lg-4 col-xs-12 col-md-6")]],
        "stops": True,
        "next": ("number", [PAGER, at("li", pick=-2)], "text"),
    },
    "otomart": {
        "template": "https://www.otomart.id/berita/page/{page}",
        "items": [[at("div", "wrap contentclass"), every("article")]],
        "stops": True,
        "next": ("tail", [at("div", "wp-pagenavi"), at("a", pick=-1)], "href"),
    },
    "otorider": {
        "template": "http://otorider.com/post/jscategoryfeed?page={page}&c={cat}&per-page=10",
        "page_size": 10,
        "items": [[every("div", "col-lg-12")]],
        "stops": True,
        "next": ("more", [at("div", "col-lg-12")], "class"),
    },
    "otosia": {
        "template": "https://www.otosia.com/{cat}/index{page}.html",
        "first_template": "https://www.otosia.com/{cat}/index.html",
        "prefix": "https://www.otosia.com",
        "items": [[every("li", "artbox-text")]],
        "next": ("number", [at("div", "mphold-g"), at("a", pick=-2)], "text"),
    },
    "propertiterkini": {
        "template": "https://www.propertiterkini.com/category/{cat}/page/{page}/",
        "items": [[at("div", "post-listing archive-box"), every("h2")]],
        "next": ("last_word", [at("div", "pagination"), at("span", "pages")], "text"),
    },
    "rajamobil": {
        "template": "https://{cat}.rajamobil.com/page/{page}",
        "items": [[every("div", "td-block-span4")]],
        "stops": True,
        "next": ("number", [at("div", "page-nav td-pb-padding-side"), at("a", "last")], "text"),
    },
    "rumah": {
        "template": "https://www.rumah.com/berita-properti/category/{cat}?page={page}",
        "prefix": "https://www.rumah.com",
        "items": [[every("div", "box news-article-lists")]],
        "stops": True,
        "next": ("number", [PAGER, at("li", pick=-1)], "text"),
    },
    "rumah123": {
        "template": "https://artikel.rumah123.com/search?page={page}",
        "items": [[at("div", "news-list-container", "id"), every("li", "list-group-item")]],
        "stops": True,
        "next": ("number", [PAGER, at("li", pick=-2)], "text"),
    },
    "rumahhokie": {
        "template": "http://www.rumahhokie.com/beritaproperti/page/{page}/?s",
        "items": [[every("div", "td_module_16 td_module_wrap td-animation-stack")]],
        "link": [at("h3", "entry-title td-module-title"), having("a", "href")],
        "label": [at("a", "td-post-category")],
        "needs_label": True,
        "stops": True,
        "next": ("number", [at("div", "page-nav td-pb-padding-side"), at("a", "last")], "text"),
    },
    "rumahku": {
        "template": "http://www.rumahku.com/artikel/berita/page:{page}/",
        "prefix": "http://www.rumahku.com",
        "items": [[at("div", "advice-category-list", "id"), every("div", "text content-right-news big")]],
        "stops": True,
        "next": ("more", [at("div", "pagination"), at("li", "next")], "class"),
    },
    "seva": {
        "template": "https://www.seva.id/{cat}/blog/category/{sub}/page/{page}",
        "items": [[every("div", "article-box")]],
        "stops": True,
        "next": ("number", [PAGER, at("li", pick=-2), at("a")], "text"),
    },
    "sindonews": {
        "template": "https://index.sindonews.com/index/{cat}/{offset}?t={yyyy}-{MM}-{dd}",
        "page_size": 10,
        "items": [[at("div", "indeks-news"), every("div", "indeks-title")]],
        "next": ("number", [at("div", "pagination"), at("a", pick=-1)], "text"),
    },
    "tempo": {
        "template": "https://www.tempo.co/indeks/{yyyy}/{MM}/{dd}",
        "items": [[at("section", "article", "id"), at("section", "list list-type-1"), every("li")]],
        "link": [at("a", "col")],
        "next": ("one", [], None),
    },
    "tirto": {
        "template": "https://tirto.id/indeks/{page}?date={yyyy}-{MM}-{dd}",
        "prefix": "https://tirto.id",
        "form": "state",
        "items": [],
        "next": (
            "number", [at("ul", "custom-pagination p-0 text-center mb-5 col-10 offset-1"), at("a", pick=-2)], "text",
        ),
    },
    "tribun": {
        "template": "http://www.tribunnews.com/index-news?date={yyyy}-{MM}-{dd}&page={page}",
        "items": [[every("li", "ptb15")]],
        "link": [at("h3"), having("a", "href")],
        "stops": True,
        "next": ("tail", [at("div", "paging"), at("a", pick=-1)], "href"),
    },
    "viva": {
        "template": "https://www.viva.co.id/indeks/all/all/{yyyy}-{MM}-{dd}?type=art",
        "items": [[at("ul", "load_terbaru_content", "id"), every("li")]],
        "link": [at("a", "title-content")],
        "date": [at("div", "date")],
        "next": ("one", [], None),
    },
}
# Sites whose article addresses are read in one piece.
WHOLE_PAGE_SUFFIX = {"gridoto": "?page=all", "tribun": "?page=all"}
# Registered domains, for pages that arrive without a site name.
DOMAINS = {
    "antaranews.com": "antara", "carmudi.co.id": "carmudi", "carreview.id": "carreview",
    "cintamobil.com": "cintamobil", "detik.com": "detik", "gridoto.com": "gridoto",
    "housingestate.id": "housingestate", "idntimes.com": "idntimes", "kompas.com": "kompas",
    "liputan6.com": "liputan6", "metrotvnews.com": "metrotv", "mobil123.com": "mobil123",
    "okezone.com": "okezone", "oto.com": "oto", "otodriver.com": "otodriver", "otomart.id": "otomart",
    "otorider.com": "otorider", "otosia.com": "otosia", "propertiterkini.com": "propertiterkini",
    "rajamobil.com": "rajamobil", "rumah.com": "rumah", "rumah123.com": "rumah123",
    "rumahhokie.com": "rumahhokie", "rumahku.com": "rumahku", "seva.id": "seva",
    "sindonews.com": "sindonews", "tempo.co": "tempo", "tirto.id": "tirto",
    "tribunnews.com": "tribun", "viva.co.id": "viva",
}
# -----------------------------------------------------------------------------------


def listing_row(site: str, rules: dict) -> dict:
    kind, steps, take = rules["next"]
    return {
        "site": site,
        "template": rules["template"],
        "first_template": rules.get("first_template"),
        "section": rules.get("section"),
        "section_template": rules.get("section_template"),
        "page_size": rules.get("page_size", 1),
        "prefix": rules.get("prefix"),
        "form": rules.get("form", "html"),
        "items": rules["items"],
        "link": rules.get("link", ANY_LINK),
        "badge": rules.get("badge"),
        "label": rules.get("label"),
        "needs_label": rules.get("needs_label", False),
        "date": rules.get("date"),
        "stops_at_seen": rules.get("stops", False),
        "next_kind": kind,
        "next_steps": steps,
        "next_take": take,
    }


def listing_rules(spark: SparkSession, more: dict[str, dict] | None = None) -> DataFrame:
    rows = [listing_row(site, rules) for site, rules in (LISTINGS | (more or {})).items()]
    return spark.createDataFrame(rows, LISTING_RULES)


def whole_page_url(site: Column, url: Column) -> Column:
    """The address an article is read from; ``urls.canonical`` undoes it."""
    suffix = F.lit("")
    for name, value in WHOLE_PAGE_SUFFIX.items():
        suffix = F.when(site == name, F.lit(value)).otherwise(suffix)
    return F.concat(url, suffix)


def assign_site(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``site`` by the registered domain; NULL for unknown ones."""
    names = F.create_map(*[F.lit(x) for pair in DOMAINS.items() for x in pair])
    labels = F.split(urls.host(F.col(url)), r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")
    return pages.withColumn("site", F.coalesce(F.try_element_at(names, three), F.try_element_at(names, two)))
