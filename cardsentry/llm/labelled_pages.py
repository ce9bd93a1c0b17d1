"""Labelled page layouts for the extraction model.

Each layout is a page in which ``data-content`` marks, by hand, where the main
text begins (1) and where something else stands inside or beside it (0).  A mark
holds for all that stands below until the next one.
"""

_LONG = "The committee met on Tuesday to go over the plans for the new bridge. Members asked for a second study of the river bed, which is due in spring."
_MID = "Work on the northern bank starts in May, once the ground is dry."
_SHORT = "A short note."
_MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'
_TEXT = f"<h1>Plans for the bridge</h1><p>{_LONG}</p><p>{_MID}</p><p>{_SHORT}</p><h2>What comes next</h2><p>{_LONG} {_MID}</p>"
_LIST = f"<ul><li>{_MID}</li><li>Second point</li></ul><blockquote>{_MID}</blockquote><table><tr><td>Length</td><td>120 m</td></tr></table>"

# what stands around or inside a text
_NAV = f"<nav data-content=0>{_MENU}</nav>"
_NAV_DIV = f'<div class="menu" data-content=0>{_MENU}</div>'
_HEADER = f'<header data-content=0><div class="logo">The Daily</div>{_MENU}</header>'
_TITLE = f"<header data-content=0><h1>The Daily</h1><p>{_MID}</p></header>"
_TITLE_ONLY = "<header data-content=0><h1>The Daily</h1></header>"
_ADDRESS = "<footer data-content=0><address>The Daily, 1 Mill Lane</address></footer>"
_ALERT = f'<div class="alert" data-content=0><p>{_LONG}</p></div>'
_HEADER_DIV = f'<div id="header" data-content=0><p>The Daily, a paper for the valley</p>{_MENU}</div>'
_FOOTER = "<footer data-content=0><p>&copy; 2020 The Daily. All rights reserved.</p><p>Printed in the valley since 1890.</p></footer>"
_FOOTER_DIV = f'<div class="footer" data-content=0>&copy; 2020 The Daily {_MENU}</div>'
_ASIDE = f"<aside data-content=0><h3>Related</h3>{_MENU}<p>{_MID}</p></aside>"
_SIDE = f'<div class="sidebar" data-content=0><h3>Most read</h3>{_MENU}<p>{_LONG}</p></div>'
_AD = f'<div class="ad" data-content=0>{_MID}</div>'
_AD_P = f'<div class="advert sponsored" data-content=0><p>{_LONG}</p></div>'
_COOKIE = f'<div class="cookie-notice" data-content=0><p>We use cookies. {_MID}</p><button>Accept</button></div>'
_NOTICE = f'<div id="notice" role="alert" data-content=0>{_LONG}</div>'
_FORM = '<form data-content=0><label>Your mail</label><input name=m><p>Sign up for our letter and get it each week.</p></form>'
_SIGNUP = f'<div class="newsletter" data-content=0><p>{_MID}</p></div>'
_COMMENTS = f'<div class="comments" data-content=0><h3>Comments</h3><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_MID}</p></div></div>'
_COMMENTS_SECTION = f'<section id="comments" data-content=0><h2>2 comments</h2><ol><li><p>Anna: {_LONG}</p></li><li><p>{_SHORT}</p></li></ol></section>'
_SHARE = '<div class="share" data-content=0><a href="/f">Share</a> <a href="/t">Tweet</a></div>'
_CRUMBS = '<div class="breadcrumb" data-content=0><a href="/">Home</a> &gt; <a href="/n">News</a></div>'

_MAINS = (
    f"<article data-content=1>{_TEXT}</article>",
    f"<article data-content=1>{_TEXT}{_LIST}</article>",
    f"<article data-content=1><header><h1>Plans</h1></header>{_TEXT}{_SHARE}</article>",
    f"<article data-content=1>{_TEXT}{_AD}<p>{_LONG}</p>{_COMMENTS}</article>",
    f"<main data-content=1>{_TEXT}</main>",
    f"<main data-content=1><article>{_TEXT}{_FORM}</article></main>",
    f"<main><article data-content=1>{_TEXT}</article>{_COMMENTS_SECTION}</main>",
    f'<div class="content" data-content=1>{_TEXT}{_LIST}</div>',
    f'<div id="main" data-content=1><div class="post">{_TEXT}</div>{_COMMENTS}</div>',
    f'<div class="entry-content" data-content=1><p>{_LONG}<p>{_MID}<p>{_SHORT}</div>',
    f'<section class="story" data-content=1>{_TEXT}{_SIGNUP}</section>',
    f"<div><div data-content=1>{_TEXT}</div></div>",
    f"<article data-content=1><h1>Plans</h1><p>{_SHORT}</p></article>",
    f"<article data-content=1><h1>{_SHORT}</h1><p><b>{_MID}<br></article>",
)
_FRAMES = (
    (_NAV, _FOOTER), (_HEADER + _NAV, _ASIDE + _FOOTER), (_HEADER_DIV + _NAV_DIV, _SIDE + _FOOTER_DIV), (_COOKIE + _NAV, _FOOTER), (_NAV + _AD, _FOOTER),
    (_NOTICE + _HEADER, _FORM + _FOOTER), (_NAV_DIV + _CRUMBS, _COMMENTS_SECTION + _FOOTER), (_HEADER, _COMMENTS + _SIDE + _FOOTER_DIV), (_NAV + _AD_P, _SIGNUP + _FOOTER), ("", ""),
    (_TITLE + _NAV, _FOOTER), (_TITLE_ONLY, _ADDRESS), (_TITLE_ONLY + _ALERT, _COMMENTS), (_TITLE + _NAV_DIV, _ASIDE + _ADDRESS),
)

LAYOUTS = [f"<html><head><title>Plans</title></head><body>{above}{main}{below}</body></html>" for above, below in _FRAMES for main in _MAINS]
# pages that are nothing but text
LAYOUTS += [f"<body data-content=1>{text}</body>" for text in (_LONG, _SHORT, "Just a line of words", f"{_MID} {_LONG} {_MID}", f"<p>{_LONG}</p><p>{_SHORT}</p>", f"{_SHORT}<br>{_LONG}")]
