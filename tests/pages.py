"""Hand-written pages, one or more per rule kind. All text is invented."""


def ld(text):
    return f'<script type="application/ld+json">{text}</script>'


PAGES = {
    "detik_full": (
        "detik", "https://news.detik.com/berita/d-1/judul", "news", None,
        """<head><meta content=" 2018/07/29 06:33:50 " name="publishdate"><meta name="articleid" content="4138819">
        <meta name="author" content="Penulis A"></head><div class="breadcrumb"><a>Beranda</a><a> Berita </a></div>
        <article><meta property="og:title" content="Judul &amp; isi"><div class="detail_tag"><a>satu</a> <a> dua </a></div>
        <div class="pic_artikel"><img src="http://gambar/1.jpg"></div>
        <div class="detail_text"><b>Kota</b> - Isi&nbsp;satu<br>dua <table class="linksisip"><tr><td>sisip</table>
        <p>Baca juga: <a href="x">tautan</a></p><p>Baca juga biasa</p><div class="sisip_embed_sosmed">video</div>
        <script>var a = "</p>";</script>Tonton juga yang lain</div></article>
        <a class="komentar"><span>12 Komentar</span></a>""",
    ),
    "detik_after_marker": (
        "detik", "https://inet.detik.com/d-2", "inet", None,
        """<div class="breadcrumb"><a>H</a><a>Gadget</a></div><article><span class="date">Senin, 30 Jul 2018 06:33 WIB</span>
        <div id="detikdetailtext"><p>awal</p><div class="clearfix mb20">tanda<b>hilang</b></div>sisa<p>hilang juga</p></div></article>""",
    ),
    "detik_no_crumb": ("detik", "https://x.detik.com/3", "news", None, "<article><div class='detail_text'>isi</div></article>"),
    "detik_video": ("detik", "https://x.detik.com/4", "news", None,
        "<div class='breadcrumb'><a>H</a><a>DetikTV</a></div><article><div class='detail_text'>isi</div></article>"),
    "detik_no_body": ("detik", "https://x.detik.com/5", "news", None, "<div class='breadcrumb'><a>H</a><a>B</a></div><article></article>"),
    "antara": (
        "antara", "https://www.antaranews.com/berita/7", "", None,
        ld('{"datePublished": "2018-07-27T15:18:00+07:00", "headline": "Judul\n ﬁlm", "author": {"name": "Ani"}, "keywords": [["Dunia:Asia"]]}')
        + """<input name="news_id" value="731"><ul class="tags-widget clearfix"><li><a>a</a><li><a>b</a></ul>
        <meta name="twitter:image" content="i.jpg"><article class="post-wrapper clearfix"><div class="post-content clearfix">
        Isi <strong>Foto: x</strong><b>Baca juga: y</b> akhir<p class="text-muted small">hak cipta</p></div></article>""",
    ),
    "antara_segment": ("antara", "https://www.antaranews.com/video/8", "", None,
        ld('{"keywords": [["a:b"]]}') + '<article class="post-wrapper clearfix"><div class="post-content clearfix">x</div></article>'),
    "antara_no_jsonld": ("antara", "https://www.antaranews.com/berita/9", "", None,
        '<article class="post-wrapper clearfix"><div class="post-content clearfix">x</div></article>'),
    "okezone_first_when_undated": (
        "okezone", "https://news.okezone.com/read/1", "", None,
        ld('{"datePublished": "2018-08-01 10:00:00", "headline": "Pertama", "author": {"name": "Budi"}, "mainEntityOfPage": {"@id": "bukan angka"}}')
        + ld('{"datePublished": "", "headline": "Kedua"}')
        + """<div class="breadcrumb"><a>Home</a><a>News</a><a>Daerah</a></div><div class="container-bodyhome-left">
        <div class="detail-tag"><a>t1</a></div><div id="contentx" class="read"><div>ada<script>1</script></div><div>tetap</div>
        <a><strong>BACA JUGA: x</strong></a><a>biasa</a></div></div><span class="commentWidget-total">x <b> 7 </b></span>""",
    ),
    "viva_nested": (
        "viva", "https://www.viva.co.id/berita/2", "", None,
        ld('{"headline": "abaikan"}')
        + ld('{"datePublished": "2018-08-02T01:02:03+07:00", "author": [{"name": "Citra"}], "mainEntityOfPage": {"@id": "1063"}}')
        + """<div class="leading-breadcrumb"><ul><li><a>Berita</a><li><a>Politik</a></ul></div><section id="viva-content">
        <div class="leading-title"><h1> Judul V </h1></div><comment-count> 3 </comment-count>
        <div class="article-detail article-detail-v2">isi<div>buang<div>dalam</div></div>akhir</div></section>""",
    ),
    "idntimes": (
        "idntimes", "https://www.idntimes.com/a/b", "tech", None,
        ld('{"x": 1}') + ld('{"headline": "Judul I", "author": {"name": "Dewi"}, "image": {"url": "i.png"}}')
        + ld('{"itemListElement": [{"item": {"name": "Tech"}}, {"item": {"name": "Gadget"}}]}')
        + """<section class="content-post clearfix"><time class="date" datetime="2018-08-03"></time>
        <article id="article-content">isi <strong>Baca Juga: x</strong></article></section>""",
    ),
    "tempo_broken_json": (
        "tempo", "https://nasional.tempo.co/read/1", "", None,
        ld('{"headline": "Judul T", "articleBody" : "kata "rusak" di sini", "datePublished": "2018-08-04T05:06:07+07:00", "editor": {"name": "Eka"}, "image": {"url": "t.jpg"}}')
        + ld('{"itemListElement": [{"item": {"name": "Home"}}, {"item": {"name": "Nasional"}}, {"item": {"name": "Hukum"}}]}')
        + """<meta content="110" property="dable:item_id"><article itemtype="http://schema.org/NewsArticle"><div id="isi"><p>satu</p>
        <p>Baca: lain</p><p>dua</p></div></article>""",
    ),
    "cintamobil_sibling": (
        "cintamobil", "https://cintamobil.com/a/b", "", "tipsmobil",
        """<meta property="og:title" content="Judul C"><input id="ArticleId" value="77"><div class="list-review w--100 pull-left">
        <h1 class="title fsize-20 fweight-bold mg-bottom-5">J</h1><p><span>05/08/2018</span></p>
        <div class="w--100 pull-left set-relative detail-font">isi<noscript>n</noscript></div></div>""",
    ),
    "carreview_month": (
        "carreview", "http://carreview.id/x", "", "berita",
        """<div class="left-content"><li class="publish-date">Jakarta, 06-Ags-2018 07:08</li><h1 class="entry-title">J</h1>
        <div class="post-meta"><a>#a</a><a>#b</a></div><div class="entry-content"><p class="lead">kepala</p>isi</div></div>""",
    ),
    "rajamobil_soft": (
        "rajamobil", "https://otomotif.rajamobil.com/x", "", "berita",
        """<meta property="article:published_time" content="2018-08-07T00:00:00+00:00"><div class="td-pb-span8 td-main-content">
        <meta property="article:tag" content="x"><meta property="article:tag" content="y">
        <div class="td-post-content"><div class="post-views">9</div><div>semua di dalam div</div></div></div>""",
    ),
    "rumahku_tail": (
        "rumahku", "http://www.rumahku.com/artikel/read/judul-410.html/", "", None,
        """<div class="container"><ul><li>a<li>Berita<li>x</ul></div><h4 class="margin-bottom-2">Judul R</h4>
        <span class="date small-text">x</span><span class="date small-text">08 Agu 2018, 09:10 WIB</span><span class="date small-text">y</span>
        <div class="text-article"><div class="text">"""
        + "".join(f"<p>p{k}</p>" for k in range(9))
        + "<p>Untuk keperluan info bisa kunjungi website</p></div></div>",
    ),
    "rumah_byline": (
        "rumah", "https://www.rumah.com/berita/1", "", None,
        """<meta property="og:title" content="Judul M"><input name="itemId" value="12"><ol class="breadcrumb"><li>a<li>Tips</ol>
        <div class="contents news-detail"><p class="news-quick-info"><span>Fajar</span></p>
        <span itemprop="datePublished" content="2018-08-09T11:12:13+08:00"></span>
        <div class="news-article-body"><p>isi</p><p><strong>Fajar</strong></p><p><strong>tebal</strong></p><p><em><strong><a>k</a></strong></em></p></div></div>""",
    ),
    "metrotv_epoch": (
        "metrotv", "http://news.metrotvnews.com/read/1", "", None,
        """<div class="breadcrumbs"><a>Home</a><a>News</a><a>Peristiwa</a></div>
        <meta property="og:image" content="http://img.metrotvnews.com/a/b/c/d/e/915/x.jpg"><meta property="og:updated_time" content="1533780000">
        <meta property="og:title" content="Judul N"><div class="reg">Gita \xa0\xa0 • \xa0\xa0 09 Agustus 2018</div>
        <div class="line"><a class="tag">a</a><a>b</a></div><img class="pic" src="p.jpg"><div class="tru">isi<div class="related">r</div><table><tr><td>t</table></div>""",
    ),
    "tirto_second_div": (
        "tirto", "https://tirto.id/x", "", None,
        """<ol class="breadcrumbs"><a>Home</a><a>Politik</a></ol><meta name="keywords" content="a, b"><span class="detail-date mt-1 text-left">Oleh: Hadi - 10 Agustus 2018</span>
        <article class="col-12 content-detail-holder my-4"><div class="content-text-editor">satu</div><div class="content-text-editor">dua<div>x</div></div></article>""",
    ),
    "tirto_caption": (
        "tirto", "https://tirto.id/y", "", None,
        """<ol class="breadcrumbs"><a>Politik</a></ol><meta name="keywords" content="a"><div class="col-12 photograph-caption-holder mt-2">Infografik x</div>
        <article class="col-12 content-detail-holder my-4"><div class="content-text-editor">1</div><div class="content-text-editor">2</div></article>""",
    ),
    "sindonews_weekday": (
        "sindonews", "https://nasional.sindonews.com/read/1327/12/judul", "", None,
        """<ul class="breadcrumb"><a>Home</a><a>Nasional</a><a>Politik</a></ul><time>Jum'at, 10 Agustus 2018 - 12:13 WIB</time>
        <div class="article"><h1>Judul S</h1><img src="s.jpg"><div id="content">isi <strong>Baca juga: x</strong><img src="y"></div></div>""",
    ),
    "rumah123_nested": (
        "rumah123", "https://artikel.rumah123.com/judul-berita-55", "", None,
        """<ol class="breadcrumb"><li>a<li>Tips<li>x</ol><div class="post-wrapper"><meta itemprop="datePublished" content="2018-08-11 14:15:16.0">
        <div class="post-text"><figure>f</figure><p>isi</p></div></div>""",
    ),
    "idntimes_one_block": ("idntimes", "https://www.idntimes.com/c", "tech", None, ld('{"headline": "x"}') + "<section class='content-post clearfix'></section>"),
    "otodriver_no_article": ("otodriver", "http://otodriver.com/x", "", "tips", "<p>isi</p>"),
    "rumah_no_title": ("rumah", "https://www.rumah.com/berita/2", "", None, "<div class='contents news-detail'><div class='news-article-body'>x</div></div>"),
    "detik_one_crumb": ("detik", "https://x.detik.com/6", "news", None,
        "<div class='breadcrumb'><a>Beranda</a></div><article><div class='detail_text'>isi</div></article>"),
    "gridoto": (
        "gridoto", "https://www.gridoto.com/read/1?page=all", "Otomotif", "Motor",
        ld('{"headline": "bukan"}') + ld('{"headline": "Judul G"}')
        + """<meta name="content_date" content="2018-08-12 13:14:15"><meta name="content_id" content="221"><meta name="content_author" content="Ina">
        <meta name="content_tag" content="x,y"><meta property="og:image" content="g.jpg"><div class="read__article clearfix"><div class="read__right">
        <p>isi</p><p><strong>Baca: lain</strong> dan ekor</p><p><strong>tebal</strong></p><noscript>n</noscript></div></div>""",
    ),
    "housingestate": (
        "housingestate", "http://housingestate.id/read/1", "", None,
        """<meta property="article:section" content="Berita"><meta property="article:published_time" content="2018-08-13T01:02:03+00:00">
        <meta property="og:title" content="Judul H"><meta property="article:tag" content="griya"><div id="ajax-load-more" data-post-id="31"></div>
        <div id="post-content"><span class="author">Joko</span><div class="content-txt"><div><script>s</script>x</div>isi</div></div>""",
    ),
    "kompas": (
        "kompas", "https://nasional.kompas.com/read/1", "news", None,
        """<meta name="cXenseParse:articleid" content="501"><meta name="content_PublishedDate" content="2018-08-14 05:06:07"><meta name="content_tag" content="p,q">
        <ul class="breadcrumb__wrap"><li>Home<li>News<li>Nasional</ul><h1 class="read__title">Judul K</h1><div class="read__author">Kiki</div>
        <div class="read__content"><p>isi</p><p><strong>Baca juga: lain</strong></p><p><strong>Baca</strong> buku</p></div>""",
    ),
    "liputan6": (
        "liputan6", "https://www.liputan6.com/news/read/9", "", None,
        """<meta property="og:title" content="Judul L"><article class="hentry main read-page--core-article" data-article-id="3605"></article>
        <ul class="read-page--breadcrumb"><a>Home</a><a>News</a><a>Politik</a></ul>
        <p class="read-page--header--author__datetime-wrapper"><time datetime="2018-08-15 08:09:10">x</time></p>
        <a class="read-page--header--author__link url fn"><span class="read-page--header--author__name fn">Lia</span></a>
        <li class="read-page--social-share__list-item js-social-share-comment"><a><span class="read-page--social-share__comment-total"> 6 </span></a></li>
        <span class="tags--snippet__name">a</span><span class="tags--snippet__name">b</span><picture class="read-page--photo-gallery--item__picture"><img src="l.jpg"></picture>
        <div class="article-content-body__item-content"><p>isi</p><div class="baca-juga">x</div><p>Saksikan video pilihan di bawah ini</p></div>""",
    ),
    "liputan6_photo": ("liputan6", "https://www.liputan6.com/foto/1", "", None,
        "<meta property='og:title' content='FOTO: x'><ul class='read-page--breadcrumb'><a>a</a><a>b</a></ul><div class='article-content-body__item-content'>x</div>"),
    "mobil123": (
        "mobil123", "https://www.mobil123.com/berita/1", "", None,
        """<div class="article__content--header"><a>Tips</a><a>x</a></div><meta name="ga:cns:details:news_id" content="88"><meta name="ga:cns:details:author" content="Mia">
        <meta name="keywords" content="k1, k2"><h1 class="article__title push-quarter--bottom">Judul B</h1>
        <div class="article__meta"><span itemprop="datePublished">16 Agustus 2018 11:12</span></div><div itemprop="image"><img data-src="m.jpg"></div>
        <div class="article__story-more"><p>isi</p><small>kecil</small><p>Temukan mobil idaman di <a>Mobil123</a></p>
        <p>Mari bergabung bersama kami di <a>Facebook</a> dan <a>Twitter</a></p></div>""",
    ),
    "oto": (
        "oto", "https://www.oto.com/berita-motor/judul-berita-2197400012", "", "berita",
        ld('{"datePublished": "2018-08-17T13:14:15+07:00", "keywords": "o1,o2"}')
        + """<article class="newslistouter container-base"><h1>Judul O</h1></article><ul class="breadcrumb"><li>Home<li>Motor<li>x</ul>
        <div class="publish-cont"><a>Nana</a></div><div class="content"><img src="o.jpg"><p>isi</p><div>x</div><p>Sumber: y</p></div>""",
    ),
    "otosia": (
        "otosia", "https://www.otosia.com/berita/1.html", "", None,
        """<div id="v5-navigation"><a>Home</a><a>Berita</a></div><span class="newsdetail-schedule">Jumat, 17 Agustus 2018 14:15</span>
        <span class="newsdetail-schedule">Editor : Oki | x</span><h1 class="OtoDetailT">Judul Q</h1><div class="detags"><a>q</a></div>
        <div id="mobart-detail"><img class="lazy_loaded" data-src="q.jpg"></div><div class="OtoDetailNews">isi satu<table><tr><td>x</table></div>""",
    ),
    "propertiterkini": (
        "propertiterkini", "https://www.propertiterkini.com/x/", "", None,
        """<h1 class="name post-title entry-title"><span>Judul P</span></h1><div id="crumbs"><a>Home</a><a>Berita</a></div>
        <meta property="article:published_time" content="2018-08-18T16:17:18+07:00"><span class="post-meta-author">Putri</span><p class="post-tag"><a>p1</a><a>p2</a></p>
        <div class="single-post-thumb"><img src="p.jpg"></div><div class="entry"><p>isi</p><ul><li>x</ul><p>Baca juga: y</p>
        <div class="sharedaddy sd-sharing-enabled">s</div><section id="related_posts">r</section><p>PropertiTerkini.com z</p></div>""",
    ),
    "rumahhokie": (
        "rumahhokie", "http://www.rumahhokie.com/beritaproperti/x", "", "Tips",
        """<link rel="shortlink" href="http://www.rumahhokie.com/beritaproperti/?p=2750"><meta property="article:published_time" content="2018-08-19T01:01:01+00:00">
        <h1 class="entry-title">Judul Z</h1><div class="td-post-author-name">By <a>Rara</a></div><div class="td-ss-main-content"><div class="td-post-content"><p>isi</p>
        <ul><li><em>Baca: x</em></ul><ul><li><em>daftar</em></ul></div></div>""",
    ),
    "seva": (
        "seva", "https://www.seva.id/otomotif/blog/x", "otomotif", "tips",
        """<link rel="shortlink" href="https://www.seva.id/otomotif/?p=910"><meta property="article:published_time" content="2018-08-20T02:02:02+00:00">
        <div class="news-content border-list"><div class="title"><h1>Judul W</h1></div><div class="content">isi &amp;amp; lain</div></div>
        <div class="col-md-8"><div class="col-md-10"><div class="details">Sari</div></div></div>""",
    ),
    "tribun": (
        "tribun", "http://www.tribunnews.com/nasional/x?page=all", "", None,
        ld('{"datePublished": "2018-08-21T03:03:03+07:00", "headline": "Judul U", "author": {"name": "Tari"}, "image": {"url": "u.jpg"}}')
        + """<meta name="cXenseParse:category" content="Nasional"><meta name="cXenseParse:category" content="Politik"><meta property="android:app_id" content="664">
        <div id="article_con"><div class="mb10 f16 ln24 mb10 mt5"><a>#t1</a><a>#t2</a></div><div class="side-article txt-article"><p>isi</p>
        <p class="baca"><strong>Baca: x</strong></p><p class="baca">tetap</p></div></div>""",
    ),
    "tribun_no_category": ("tribun", "http://www.tribunnews.com/y", "", None,
        ld('{"headline": "x"}') + "<div id='article_con'><div class='side-article txt-article'>isi</div></div>"),
    "rumah123_nested_paragraph": (
        "rumah123", "https://artikel.rumah123.com/lagi-56", "", None,
        """<ol class="breadcrumb"><li>a<li>Photo<li>x</ol><div class="post-wrapper"><div class="post-text"><p>isi</p></div></div>""",
    ),
}
