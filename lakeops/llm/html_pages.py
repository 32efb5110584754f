"""Labelled pages that the main-text model is trained on.

Written for this purpose. An element with the attribute ``main`` is main content together with what it
holds, down to an element with the attribute ``rest``; all others are not. The model never sees these
two attributes. ``made_pages`` puts more of them together by rule.
"""

import random

_TEXT = (
    "The river rose for three days before the town council met, and by then most of the cellars along the quay were full.",
    "Nobody had expected the old pumps to last. They were built in 1952, and the spare parts ran out long ago.",
    "Short one.",
    "In the end, volunteers carried sandbags through the night while the fire brigade kept the main road open, as it had done years before.",
    "Water",
    "Engineers say that the new gates will hold, provided that the money arrives; the first of them is due next spring, and others follow.",
)
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li><li><a href="/about">About us</a></li></ul>'


def _p(*which: int) -> str:
    return "".join(f"<p>{_TEXT[i]}</p>" for i in which)


PAGES = [
    f'<html><body><nav>{_MENU}</nav><div class="ad">Buy now. Low prices, every day of the week.</div><article main><h1>High water</h1>{_p(0, 1, 2, 3, 4)}</article><footer>&copy; The Gazette. All rights reserved.</footer></body></html>',
    f'<html><body><nav>{_MENU}</nav><div class="ad">The best shoes you will ever wear, says everybody who has tried them.</div><article main><h1>Gates</h1><p><b>{_TEXT[3]}<br><p>{_TEXT[5]}</p><p>So.</p></article><footer>The Gazette &middot; {_TEXT[5]}</footer></body></html>',
    f'<html><body><header><div class="logo">The Gazette</div><nav class="menu">{_MENU}</nav></header><main><article main><h1>On pumps</h1>{_p(1, 2)}<h2>What next</h2>{_p(5, 4)}<blockquote><p>{_TEXT[0]}</p></blockquote><div class="share" rest><a href="#">Share</a> <a href="#">Print</a></div></article><aside class="sidebar"><h3>Most read</h3>{_MENU}<p>{_TEXT[2]}</p></aside></main><footer><p>Contact: news desk, open all day.</p>{_MENU}</footer></body></html>',
    f'<html><body><div id="header"><h1>The Gazette</h1></div><div id="nav">{_MENU}</div><div id="content" main><h2>High water again</h2>{_p(0, 3, 2)}<ul><li>{_TEXT[1]}</li><li>Two pumps</li></ul><table><tr><td>Level</td><td>4.2</td></tr></table></div><div id="sidebar"><h3>Weather</h3><p>{_TEXT[1]}</p></div><div id="comments"><h3>Comments</h3><div class="comment"><p>{_TEXT[3]}</p></div><div class="comment"><p>Well said, I think so too.</p></div></div><div id="footer"><p>Imprint and privacy</p></div></body></html>',
    f'<html><body><div class="cookie-notice"><p>We use cookies to make this site better for you. By going on you agree.</p><button>Accept</button></div><header><a href="/">Gazette</a></header><section class="post" main><header><h1>Night of sandbags</h1></header><div class="entry">{_p(3, 5, 0)}</div><figure><figcaption>The quay at dawn.</figcaption></figure></section><section class="comments" id="comments"><h2>3 comments</h2><ol><li class="comment"><p>{_TEXT[0]}</p></li><li class="comment"><p>{_TEXT[2]}</p></li></ol><form><label>Your name</label><input><textarea></textarea><button>Send</button></form></section><footer>2021 Gazette</footer></body></html>',
    f'<html><body><div class="banner advert"><p>{_TEXT[5]}</p></div><div class="wrapper"><div class="article-body" main><h1>Money for the gates</h1>{_p(5, 1)}<div class="ad" rest><p>Holidays by the sea from 99 a week, book today.</p></div>{_p(3, 4, 2)}<pre>level = 4.2</pre></div><div class="related"><h3>Related</h3>{_MENU}</div></div><form class="newsletter"><p>Get our newsletter every morning, free of charge.</p><input><button>Subscribe</button></form></body></html>',
    f'<html><body><div role="navigation">{_MENU}</div><div role="main" main><h1>Town meeting</h1>{_p(0)}<p>{_TEXT[1]} See <a href="/x">the report</a> for more.</p><ol><li>{_TEXT[3]}</li></ol></div><div role="complementary"><p>{_TEXT[3]}</p></div><div role="contentinfo"><p>Published by the Gazette</p></div><div class="popup notice"><p>{_TEXT[1]}</p></div></body></html>',
    f'<html><body><nav class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></nav><article class="post" main><h1>A</h1><p>{_TEXT[4]}</p></article><aside><p>{_TEXT[0]}</p>{_MENU}</aside><div class="promo"><p>{_TEXT[1]}</p></div><footer class="site-footer"><ul><li><a href="/t">Terms</a></li></ul></footer></body></html>',
    f'<html><body><article main><header><h1>Gates to be built</h1><p>{_TEXT[2]}</p></header><section>{_p(0, 1)}</section><section><h2>Costs</h2>{_p(5)}</section><aside rest><p>{_TEXT[3]}</p></aside><footer rest><p>Filed under: water</p></footer></article><div class="comments-area"><p>{_TEXT[5]}</p></div></body></html>',
    f"<html><body><p main>{_TEXT[0]}</p><p main>{_TEXT[1]}</p><p main>{_TEXT[2]}</p><p main>{_TEXT[3]}</p></body></html>",
    f'<html><body><div class="menu">{_MENU}</div><div class="text" main><p>{_TEXT[0]}</p><p>{_TEXT[4]}</p></div><div class="footer">{_TEXT[2]}</div><div class="disqus"><p>{_TEXT[1]}</p></div></body></html>',
    f"<html><body main>{_TEXT[0]}<br><br>{_TEXT[1]}</body></html>",
    f"<body main>{_TEXT[3]}</body>",
    f"<html><body><h1 main>High water</h1><p main>{_TEXT[4]}</p><p main>{_TEXT[0]}</p><ul main><li>Two pumps</li></ul></body></html>",
    f"<div main><p>{_TEXT[2]}</p><p>{_TEXT[1]}</p></div>",
]

#: Words of classes, ids and roles by what an element holds, in some languages. (Fixed values.)
WORDS = {
    "menu": "nav menu navigation navbar breadcrumb breadcrumbs links topnav tabs pager pagination",
    "header": "header masthead top logo brand kopfzeile kopf entete cabecera",
    "footer": "footer bottom copyright imprint impressum colophon fusszeile fuss pied legal",
    "side": "sidebar aside side widget related recommended rail secondary seitenleiste popular trending",
    "notice": "cookie cookies consent notice alert gdpr popup modal hinweis overlay privacy toast",
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion banner werbung anzeige publicite",
    "comments": "comments comment responses response replies reply discussion disqus kommentare reactions thread",
    "form": "form newsletter signup subscribe search login register anmeldung",
    "share": "share social sharing tools actions toolbar",
    "main": "article content main post entry story body text inhalt beitrag contenu articulo prose markdown",
}


def made_pages(n: int, seed: int, unseen: bool = False) -> list[str]:
    """``n`` labelled pages put together by rule from a seed: layouts, short and long articles with linked paragraphs, lists
    of links, tables, forms and adverts in them, and what stands around articles. With ``unseen`` the words of
    classes are made up, so that tags and texts alone tell."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("b d f g k l m n r s t v".split()) + rng.choice("aeiou") for _ in range(rng.randrange(1, 4)))

    def sentence(low: int = 5, high: int = 22) -> str:
        words = [word() for _ in range(rng.randrange(low, high))]
        if len(words) > 8 and rng.random() < 0.7:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + rng.choice("...!?")

    def text(least: int = 1, most: int = 5) -> str:
        return " ".join(sentence() for _ in range(rng.randrange(least, most)))

    def link(low: int = 1, high: int = 4) -> str:
        return f'<a href="/{word()}">{" ".join(word() for _ in range(rng.randrange(low, high))).capitalize()}</a>'

    def links(low: int = 3, high: int = 9) -> str:
        items = [link() for _ in range(rng.randrange(low, high))]
        style = rng.randrange(3)
        return f"<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>" if style else " ".join(items)

    def named(kind: str) -> str:
        if unseen:
            return f'class="{word()}{word()}"'
        chosen = rng.sample(WORDS[kind].split(), rng.choice((1, 1, 2)))
        return f'{rng.choice(("class", "class", "id"))}="{rng.choice(("-", " ")).join(chosen)}"'

    def around(tag: str, kind: str, inner: str, mark: str = "") -> str:
        """An element of a telling tag, or a plain one with telling words."""
        plain = tag in ("div", "section") or rng.random() < 0.5
        if plain and not (unseen and tag not in ("div", "section")):
            tag = rng.choice(("div", "div", "section")) if tag != "form" else tag
            return f"<{tag} {named(kind)}{mark}>{inner}</{tag}>"
        return f"<{tag}{mark}>{inner}</{tag}>"

    def form() -> str:
        fields = "".join(f"<label>{word().capitalize()}</label><input>" for _ in range(rng.randrange(1, 3)))
        return f"<form>{rng.choice(('', f'<p>{sentence(3, 9)}</p>'))}{fields}<button>{word().capitalize()}</button></form>"

    def article() -> str:
        parts = [f"<h1>{' '.join(word() for _ in range(rng.randrange(2, 7))).capitalize()}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice((1, 2, 2, 3, 3, 4, 5, 7, 10))):
            parts.append(f"<p>{text()}</p>")
        extra = [
            f"<p>{link(3, 7)}</p>", f"<p><a href='/x'>{sentence(4, 9)}</a></p>", f"<ul>{''.join(f'<li>{link(2, 6)}</li>' for _ in range(rng.randrange(2, 10)))}</ul>",
            f"<ul>{''.join(f'<li>{sentence(3, 9)}</li>' for _ in range(rng.randrange(2, 6)))}</ul>", f"<h2>{word().capitalize()} {word()}</h2>",
            f"<table>{''.join(f'<tr><td>{word()}</td><td>{rng.randrange(99)}</td></tr>' for _ in range(rng.randrange(1, 5)))}</table>",
            f"<blockquote><p>{text(1, 3)}</p></blockquote>", f"<figure><figcaption>{sentence(3, 8)}</figcaption></figure>", f"<pre>{word()} = {word()}</pre>",
            f"<p>{word().capitalize()}.</p>", f"<p>{text(1, 3)} {link()} {sentence()}</p>",
        ]
        apart = [
            around("div", "ad", f"<p>{sentence()}</p>", " rest"), around("div", "share", f"{link()} {link()}", " rest"),
            around("form", "form", form(), " rest"), around("aside", "side", f"<h3>{word()}</h3>{links()}", " rest"),
        ]
        for piece in rng.sample(extra, rng.choice((0, 1, 1, 2, 3))) + rng.sample(apart, rng.choice((0, 0, 1, 1, 2))):
            parts.insert(rng.randrange(len(parts) + 1), piece)
        inner = "".join(parts)
        return rng.choice((inner, inner, f"<div>{inner}</div>"))

    pages = []
    for _ in range(n):
        whole = rng.choice(("article", "article", "main", "div", "section"))
        if whole in ("article", "main") and (unseen or rng.random() < 0.7):
            body = f"<{whole} main>{article()}</{whole}>"
        else:
            body = f"<{whole} {named('main')} main>{article()}</{whole}>"
        if rng.random() < 0.3:
            body = f"<div{rng.choice(('', ' class=wrapper', ' class=container'))}>{body}</div>"
        before = [around("nav", "menu", links()), around("header", "header", rng.choice((link(), f"<h2>{word()}</h2>{links()}")))]
        before += [around("div", "notice", f"<p>{text(1, 3)}</p>{rng.choice(('', f'<button>{word()}</button>'))}"), around("div", "ad", f"<p>{text(1, 3)}</p>")]
        after = [around("aside", "side", f"<h3>{word()}</h3>{links()}"), around("div", "ad", rng.choice((link(3, 8), f"<p>{sentence()}</p>")))]
        after += [around("section", "comments", "".join(f'<div {named("comments")}><p>{text(1, 3)}</p></div>' for _ in range(rng.randrange(1, 5))))]
        after += [around("div", "form", form())]
        first = rng.sample(before, rng.randrange(1, 4))
        last = rng.sample(after, rng.randrange(0, 4)) + [around("footer", "footer", f"{sentence(2, 7)} {link()}")]
        if unseen:  # without telling words, adverts, notices and comments look like articles: only what tags or links tell
            first = [around("nav", "menu", links()), around("header", "header", link())]
            last = [around("aside", "side", f"<h3>{word()}</h3>{links()}"), around("footer", "footer", f"{sentence(2, 7)} {link()}"), form()]
        if rng.random() < 0.15:  # an article and nothing else
            first, last = [], []
        pages.append(f"<html><head><title>{word()}</title></head><body>{''.join(first)}{body}{''.join(last)}</body></html>")
    return pages
