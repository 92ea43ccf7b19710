"""Labelled pages: small pages of common layouts, their main text marked.

``{+`` and ``+}`` surround what belongs to the main text. The pages are fixed
values from which ``html_extract.fit`` takes its weights; any other labelled
pages can be given to it.
"""

from __future__ import annotations

_PROSE = ("The river rose in the night and by noon it had covered the lower road, so the market moved uphill. "
          "Nobody was hurt, said the mayor, but two barns and a stretch of fence are gone.")
_MORE = "Work on the road begins on Monday. Until then the bus takes <a href=\"/b\">the old bridge</a>, as it did before."
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li><li><a href="/contact">Contact</a></li></ul>'
_TALK = "I saw this too, great pictures, thanks for posting them here."
_HEAD = "<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>River news and more</title><style>p{margin:0}</style><script>var x=1;</script></head>"


def _page(body: str) -> str:
    return f"{_HEAD}<body>{body}</body></html>"


def _article(inside: str = "") -> str:
    return f"<article>{{+<h1>River rises</h1><p>{_PROSE}</p>+}}{inside}{{+<p>{_MORE}</p><p>Yes.</p>+}}</article>"


# Parts that are not main text, as they are found inside and beside an article.
_NOT_TEXT = [
    f"<nav>{_MENU}</nav>", f'<div class="menu">{_MENU}</div>', f'<div id="navbar">{_MENU}</div>', f'<div role="navigation">{_MENU}</div>',
    '<div class="breadcrumbs"><a href="/">Home</a> / <a href="/n">News</a> / River</div>', '<ol class="breadcrumb"><li>Home</li><li>News</li></ol>',
    "<aside><h3>More from here</h3><p>The weather this week stays cold and wet.</p></aside>",
    '<div class="sidebar"><h3>Popular</h3><p>The weather this week stays cold and wet.</p></div>', '<div id="side"><p>Most read this week in town.</p></div>',
    '<div class="widget"><p>Follow the weather with our small window.</p></div>', '<div role="complementary"><p>Most read this week in town.</p></div>',
    '<div class="ad">Buy new boots today, cheap and dry.</div>', '<div class="ads"><p>Buy new boots today.</p></div>',
    '<div class="advert"><p>Buy new boots today, cheap and dry.</p></div>', '<div class="advertisement"><p>Boots for less than you think.</p></div>',
    '<section class="sponsored"><p>Boots for less than you think.</p></section>', '<p class="sponsor">This page is paid for by a maker of boots.</p>',
    '<div class="promo"><p>Two boots for the price of one.</p></div>', '<div class="promotion banner"><p>Two boots for the price of one.</p></div>',
    '<div class="banner">Two boots for the price of one.</div>',
    '<div class="cookie-notice"><p>We use cookies to make this page better.</p><button>Accept</button></div>',
    '<div id="cookie-consent"><p>We use cookies to make this page better.</p></div>', '<div class="gdpr">Please accept our privacy terms.</div>',
    '<div class="privacy">Please accept our privacy terms.</div>', '<p class="disclaimer">All statements are without warranty.</p>',
    '<div class="notice">This page was moved, please change your bookmarks.</div>', '<div role="alert"><p>You are using an old browser.</p></div>',
    '<div class="alert">You are using an old browser.</div>', '<div class="warning message">You are using an old browser.</div>',
    '<div class="popup"><p>Sign up before you go.</p></div>', '<div class="modal overlay"><p>Sign up before you go.</p></div>', "<dialog><p>Sign up before you go.</p></dialog>",
    '<form action="/s"><label>Search this site</label><input name="q"><button>Go</button></form>', '<div class="search"><p>Search this site</p></div>',
    '<form class="newsletter"><p>Get our news by mail every week.</p><input type="text"><button>Subscribe</button></form>',
    '<div class="newsletter"><p>Get our news by mail every week.</p></div>', '<div class="subscribe"><p>Get our news by mail every week.</p></div>',
    '<div class="signup"><p>Become a member today.</p></div>', '<div class="login">Log in to read on.</div>', '<div class="paywall"><p>Read on for one coin a week.</p></div>',
    "<select><option>English</option><option>French</option></select>", "<textarea>Write here what you think</textarea>", "<button>Share this page</button>",
    f'<section class="comments"><h2>Comments</h2><article class="comment"><p>{_TALK}</p></article><div class="reply"><p>{_TALK}</p></div></section>',
    f'<div id="comments"><ol class="comment-list"><li class="comment"><p>{_TALK}</p></li></ol></div>', f'<div class="comment"><p>{_TALK}</p></div>',
    f'<div class="discussion"><p>{_TALK}</p></div>', f'<div id="disqus-thread"><p>{_TALK}</p></div>', f'<div class="replies"><p>{_TALK}</p></div>',
    f'<ul class="responses"><li>{_TALK}</li></ul>', f'<div id="respond"><p>{_TALK}</p></div>', f'<div class="feedback"><p>{_TALK}</p></div>',
    f'<section class="reviews"><p>{_TALK}</p></section>', f'<div class="guestbook"><p>{_TALK}</p></div>', f'<div class="reader-letter"><p>{_TALK}</p></div>',
    '<div class="related"><h3>Related</h3><a href="/a">A bridge is closed</a><a href="/b">The lake is full</a></div>',
    '<div class="related-posts"><article><h3>A bridge is closed</h3><p>No one may pass until May.</p></article></div>',
    '<div class="recommended"><p>You may also like what happened last year.</p></div>', '<div class="recommendation"><p>You may also like what happened last year.</p></div>',
    '<div class="teaser"><p>A bridge is closed until May.</p></div>', '<div class="trending"><p>A bridge is closed until May.</p></div>',
    '<div class="share">Share on a network or by mail</div>', '<div class="social"><a href="#">Like</a><a href="#">Send</a></div>', '<div class="toolbar">Print Mail Save</div>',
    '<ul class="tags"><li><a href="#">river</a></li><li><a href="#">road</a></li></ul>', '<div class="pagination"><a href="?2">Next page</a></div>', '<div class="pager">Page 1 of 2</div>',
    "<footer><p>Copyright by the town paper. All rights reserved.</p></footer>", '<div class="footer">&copy; The town paper. All rights reserved.</div>',
    '<div role="contentinfo"><p>The town paper, river street 1.</p></div>', '<div id="bottom"><p>The town paper, river street 1.</p></div>', '<div class="copyright">&copy; The town paper</div>',
    '<div class="legal">All statements are without warranty.</div>', '<div class="imprint">The town paper, river street 1.</div>',
    '<a class="skip-link" href="#c">Skip to the text</a>', "<noscript>Please turn scripts on.</noscript>", "<template><p>Hidden text of a window</p></template>",
    '<iframe src="x">Your browser shows no frames.</iframe>', "<svg><text>Logo of the paper</text></svg>", "<object><p>No player was found.</p></object>",
    '<div hidden><p>Hidden text of a window</p></div>', '<div class="hidden"><p>Hidden text of a window</p></div>', '<div aria-hidden="true">Hidden text of a window</div>',
    '<p style="display:none">Hidden text of a window</p>', '<div class="poll"><p>Do you like the rain?</p></div>', "<menu><li>Open</li><li>Close</li></menu>",
]

# Names that page authors give to parts that are not main text, and texts that stand in them.
_NAMES = """nav main-nav site-nav top-nav topnav sitenav navigation main-menu side-menu sidemenu menubar submenu dropdown drawer hamburger
sidebar left-sidebar right-sidebar sidebar-content sidebar-text side-column rail left-rail aside widget-content widget-area
ad-box ad-container ad-content ad-slot ad-text adbox adsbygoogle adsense advert-body adverts article-ad sponsored-content sponsor-text promo-content
cookie cookie-bar cookie-banner cookie-text cookies eu-cookie consent-banner gdpr-notice privacy-notice site-notice notice-text notification announcement alert-box
newsletter-box newsletter-signup subscribe-box subscription sign-up login-box login-form register contact-form search-box search-form searchbar
comment-content comment-body comment-text comment-entry comments-area post-comments article-comments user-comments commentlist reader-comments comment-form
replies reply-body user-review related-content related-articles related-story related-links more-stories read-more see-also you-may-like recommended-content most-popular popular-posts
share-bar share-buttons social-links social-share follow-us article-footer post-footer page-footer site-footer footer-content footer-text main-footer colophon
page-header main-header header-content top-bar masthead-text article-tags tag-list tag-cloud category-list author-bio about-author byline-links post-meta breadcrumb-trail
next-post previous-post page-numbers popup-content modal-body modal-content overlay-text lightbox tooltip tooltip-text print-only screen-reader-text sr-only visually-hidden invisible
disclaimer-text legal-notice terms-of-use copyright-text chat-widget feedback-form survey quiz-box donate donation-box countdown ticker marquee carousel slider slideshow""".split()
_SAID = ["The weather this week stays cold and wet.", "Two boots for the price of one.", "We use cookies to make this page better.", "Get our news by mail every week.", _TALK,
         "A bridge is closed until May.", "Share on a network or by mail", "The town paper, river street 1."]
_NOT_TEXT += [f'<div class="{name}"><p>{_SAID[i % len(_SAID)]}</p></div>' if i % 3 else f'<div id="{name}">{_SAID[i % len(_SAID)]}</div>' for i, name in enumerate(_NAMES)]
_NOT_TEXT += ["<nav>Home News About us</nav>", '<div class="menu">Home News About us</div>', '<div class="navbar"><span>Home</span> <span>News</span></div>', "<nav><p>On this page</p></nav>",
              '<div class="pagination">Page 1 of 2</div>', '<p class="tags">river, road</p>', '<div class="social">Follow the town paper</div>', "<fieldset><legend>Choose</legend>Yes or no</fieldset>"]

# Parts whose names say nothing: only their place and the tags around them can.
_PLAIN = ["<div>Call us from nine to five</div>", "<div>We use cookies to make this page better.</div>", "<p>The town paper, river street 1.</p>", "<div><p>All rights reserved.</p></div>"]

# What stands before and behind a page's text.
_TOPS = [
    f"<header><h2>The town paper</h2><p>News since last year</p>{_MENU}</header>", f'<div class="header"><p>The town paper</p>{_MENU}</div>',
    f'<div id="masthead"><p>The town paper</p>{_MENU}</div>', '<div class="logo">The town paper</div>', f'<div role="banner"><p>The town paper</p>{_MENU}</div>',
    '<div class="topbar">Call us from nine to five</div>', '<div class="site-header"><p>The town paper</p></div>', f'<div class="top-navigation">{_MENU}</div>',
    f"<div>{_MENU}</div>", '<div><a href="/">Home</a> | <a href="/n">News</a> | <a href="/c">Contact</a></div>',
]

# Names of parts that hold a whole page or its text.
_WRAPPERS = """page site wrap wrapper outer inner container layout grid row col column main-column primary single view panel box block center
middle left right section item node region root app document doc paper text txt copy prose article-body article-content story-text post-content entry
news-article blog-post page-content site-content content-area main-content reader-view user-content site-main""".split()

# Main texts in other elements.
_TEXTS = [
    f"<main>{{+<h1>River rises</h1><p>{_PROSE}</p><p>{_MORE}</p>+}}</main>", f'<div class="content">{{+<h1>River rises</h1><p>{_PROSE}</p>+}}</div>',
    f'<div id="content">{{+<h2>River rises</h2><p>{_PROSE}</p><ul><li>two barns</li><li>a fence</li></ul>+}}</div>', f'<div class="post">{{+<p>{_PROSE}</p><p>No.</p>+}}</div>',
    f'<div class="post-body">{{+<p>{_PROSE}</p><blockquote>{_MORE}</blockquote>+}}</div>', f'<div class="entry-content">{{+<p>{_PROSE}</p>+}}</div>',
    f'<div class="article-text">{{+<p>{_PROSE}</p><p>{_MORE}</p>+}}</div>', f'<div class="story">{{+{_PROSE}<br>{_MORE}+}}</div>', f'<div id="main">{{+<p>{_PROSE}</p>+}}</div>',
    f'<section class="body">{{+<h1>River rises</h1><p>{_PROSE}</p><table><tr><td>Monday</td><td>3 m</td></tr></table>+}}</section>', f'<div role="main">{{+<p>{_PROSE}</p>+}}</div>',
    f"<div>{{+<h1>River rises</h1><p>{_PROSE}</p><p>{_MORE}</p>+}}</div>", f"{{+<h1>River rises</h1><p>{_PROSE}</p><p>{_MORE}</p>+}}", f"<div>{{+{_PROSE}<br><br>{_MORE}+}}</div>",
    f'<article class="post">{{+<header><h1>River rises</h1></header><p>{_PROSE} <a href="/x">See more</a>.</p>+}}<footer><p>Written by hand</p></footer></article>',
    f'<article>{{+<div class="article-header"><h1>River rises</h1></div><p>{_PROSE}</p><figure><figcaption>The lower road</figcaption></figure><pre>3 m</pre>+}}</article>',
    f'<article id="a1">{{+<section><h2>River rises</h2><p>{_PROSE}</p></section><section><h3>What next</h3><p>{_MORE}</p></section>+}}</article>',
    f"<article>{{+<h1>River rises</h1><p><b>{_PROSE}<br><p>{_MORE}</p>+}}</article>",
    f'<article>{{+<h1><a href="/r">River rises</a></h1><p>{_PROSE}</p><p><a href="/b">All about the old bridge</a></p>+}}</article>',
    f'<div class="wrapper"><section><article>{{+<div><h2>River rises</h2><ol><li>two barns</li><li>a fence</li></ol><p><i>{_MORE}</i></p></div>+}}</article></section></div>',
    f'<main class="page"><div class="row"><div class="col">{{+<h3>River rises</h3><ul><li>{_MORE}</li><li>Yes.</li></ul><dl><dt>Road</dt><dd>closed</dd></dl>+}}</div></div></main>',
    f'<div class="container"><div class="inner"><section>{{+<h1>River rises</h1><p>{_PROSE}</p><h4>What next</h4><p>{_MORE}</p><address>River street 1</address>+}}</section></div></div>',
    *(f'<div id="{a}"><div class="{b}">{{+<h1>River rises</h1><p>{_PROSE}</p><p>{_MORE}</p>+}}</div></div>' for a, b in zip(_WRAPPERS, _WRAPPERS[::-1])),
    f"<section><h1>{{+River rises</h1><p>{_PROSE}</p><ul><li>two barns</li><li>a fence</li></ul>+}}</section>",
]


def labelled_pages() -> list[str]:
    """Each part inside an article, behind one, and beside each of the other layouts; each top before them."""
    pages = [_page(_TOPS[i % len(_TOPS)] + _article(part)) for i, part in enumerate(_NOT_TEXT)]
    pages += [_page(_TOPS[i % len(_TOPS)] + _TEXTS[i % len(_TEXTS)] + part) for i, part in enumerate(_NOT_TEXT)]
    pages += [_page(top + text + _NOT_TEXT[(i * 7 + k) % len(_NOT_TEXT)]) for i, top in enumerate(_TOPS) for k, text in enumerate(_TEXTS)]
    pages += [_page(before + _MENU + text + f"<hr>{_MENU}" + after) for before in _PLAIN for after in _PLAIN for text in _TEXTS
              if "=" not in text and "<article>" not in text and "<main>" not in text]
    return pages
