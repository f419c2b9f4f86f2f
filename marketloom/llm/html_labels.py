"""Labelled pages the content model is trained on, put together from parts: data-y marks content (1) or not (0), inherited."""

_P = "The river rose in the night, and by morning the lower fields were under water, as the older farmers had said."
_Q = "She had kept the letters for years, tied with a ribbon, and read them again whenever the house was quiet enough."
_S = "It was late."

CONTENT = [
    f"<p>{_P}</p>", f"<h2>Letters</h2><p>{_Q}</p>", f"<p>{_S}</p>", f"<p>{_Q} <a href=/x>more</a> {_S}</p>",
    "<ul><li>first point of the list</li><li>second point</li></ul>", f"<blockquote><p>{_S}</p></blockquote>", "<pre>x = 1</pre>",
    f"<div><p>{_P}</p><p>{_S}</p></div>", "<table><tr><th>Year</th><td>1904</td></tr><tr><td>Rain</td><td>high</td></tr></table>",
    f"{_Q}<br>{_S}", f"<section><h3>Part two</h3><p>{_P}</p></section>", f"<dl><dt>Word</dt><dd>{_S}</dd></dl>",
    "<figure><img><figcaption>A ribbon</figcaption></figure>", f"<div>{_P}</div>", f"<p><a href=/z>{_S}</a></p>", f"<ol><li><p>{_Q}</p></li><li>Second.</li></ol>",
]
OTHER = [
    "<nav data-y=0><ul><li><a href=/>Home</a></li><li><a href=/a>News</a></li></ul></nav>", "<nav data-y=0><a href=/2>Page 1</a></nav>",
    f"<aside data-y=0><h3>Related</h3><ul><li><a href=/1>One thing</a></li><li><a href=/2>{_P}</a></li></ul></aside>", f"<aside data-y=0><p>{_Q} {_P}</p></aside>",
    f"<aside data-y=0>{_Q}</aside>", f"<aside data-y=0>{_S} {_P}</aside>", "<footer data-y=0>Posted by Ann in Letters</footer>", f"<footer data-y=0><p>{_Q}</p><p>&copy; 2020 Example</p></footer>",
    '<div class="alert alert-info" data-y=0>This page is an archive.</div>', f'<div class="notice" data-y=0><p>{_P}</p></div>', f'<div class="ad" data-y=0>{_Q}</div>',
    '<div class="ad-banner" data-y=0><p>Sponsored: new shoes</p></div>', f'<div class="sponsored" data-y=0><p>{_P}</p></div>',
    f'<div class="comments-area" data-y=0><h3>Comments</h3><ol><li><p>{_P}</p></li><li>First!</li></ol></div>',
    f'<section id="comments" class="comments" data-y=0><div class="comment"><p>{_Q}</p></div></section>', '<div class="share-buttons" data-y=0><a href=/s>Share</a></div>',
    '<div class="cookie-notice" data-y=0><p>We use cookies, and by reading on you accept them.</p><button>Accept</button></div>',
    "<form data-y=0><label>Your vote</label><button>Vote</button></form>", f'<div class="newsletter" data-y=0><p>{_Q}</p><form><input></form></div>',
    '<ul class="breadcrumb" data-y=0><li><a href=/>Home</a></li><li>Letters</li></ul>', f'<div class="related-posts" data-y=0><h4>You may also like</h4><a href=/r>{_P}</a></div>',
    '<div id="sidebar" class="sidebar" data-y=0><p>Follow us</p></div>', f'<div class="promo" data-y=0>{_P}</div>', '<div class="widget" data-y=0><ul><li><a href=/m>May</a></li></ul></div>',
    f'<section class="reviews" data-y=0><h2>Reader reviews</h2><p>{_P}</p></section>', '<div class="footer" data-y=0>Imprint | Privacy</div>',
    '<div role="alert" data-y=0>The site is down tonight.</div>', f'<div id="disqus_thread" data-y=0><div><p>{_P}</p></div></div>',
    '<div data-y=0><a href=/>Home</a> | <a href=/c>Contact</a> | <a href=/d>About</a></div>', '<div class="pagination" data-y=0><a href=/2>Next</a></div>',
]
for _n in (3, 6, 10):
    _links = "".join(f"<li><a href=/{k}>{w}</a></li>" for k, w in enumerate("News Sport Weather Local Letters Fields Valley Farms Work Help".split()[:_n]))
    OTHER += [f"<nav data-y=0><ul>{_links}</ul></nav>", f"<header data-y=0><a href=/>Example</a><nav><ul>{_links}</ul></nav></header>", f"<footer data-y=0><ul>{_links}</ul><p>{_S}</p></footer>"]
    CONTENT += ["<ul>" + "".join(f"<li>{w} in the {k} field</li>" for k, w in enumerate("Hay Oats Barley Rye Wheat Flax Beans Peas Clover Hops".split()[:_n])) + "</ul>"]
HEADS = [
    "<h1>Water in the fields</h1>", "<header><h1>On floods</h1></header>", f"<header><h1>Letters</h1><p>{_S}</p></header>", "<h2>A title</h2>", "",
    f'<header data-y=0><h1>The Daily Example</h1><p>News for everyone</p></header>',
]
AROUND = [
    ("<article data-y=1>", "</article>"), ("<main data-y=1><article>", "</article></main>"), ('<div id="content" data-y=1>', "</div>"),
    ('<div class="wrapper"><div class="post-body" data-y=1>', "</div></div>"), ('<div role="main" class="entry-content" data-y=1>', "</div>"),
    ('<main><article class="story" data-y=1>', "</article></main>"), ("<div data-y=1>", "</div>"), ("", ""), ('<section class="page-text" data-y=1>', "</section>"),
]


def _page(i: int) -> tuple[int, str]:
    """(label of the page itself, page). Parts are taken in turn, each list at its own pace."""
    start, end = AROUND[i % len(AROUND)]
    own = not start  # the body itself holds the content
    inside = [CONTENT[(5 * i + 3 * k) % len(CONTENT)] for k in range(1 + i % 6)]
    for k in range(i % 4):  # others stand inside the content
        inside.insert((i + 2 * k) % (len(inside) + 1), OTHER[(3 * i + 7 * k) % len(OTHER)])
    body = start + HEADS[i % (len(HEADS) - 1)] + "".join(inside) + end
    before = [OTHER[(i + 11 * k) % len(OTHER)] for k in range(i % 3)] + ([HEADS[-1]] if i % 5 == 0 else [])
    after = [OTHER[(4 * i + 5 * k + 2) % len(OTHER)] for k in range(1 + i % 3)]
    whole = "".join(before) + body + "".join(after)
    return int(own), f"<body data-y={int(own)}>{whole}</body>" if i % 4 else whole


PAGES = [_page(i) for i in range(162)] + [
    *((1, f"{a}<body data-y=1>{_P}<br>{_Q}{b}</body>") for a in ("", "<html><head><title>x</title></head>") for b in ("", f"<br>{_S}", OTHER[-3], OTHER[4])),
    (0, f"<body>{OTHER[0]}{OTHER[15]}<footer>Imprint</footer></body>"), (1, _P), (1, f"{_P}<br>{_S}"), (1, f"<p>{_S}</p>"), (1, f"<h1>To</h1>{_S}"),
]
