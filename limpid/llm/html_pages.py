"""Pages with labelled elements, from which the content model of `html` learns. data-y="1" marks content, "0" the rest.

A label holds for all that lies below until another one stands. The pages are fixed training data, bounded and small.
"""

_TEXT = (
    "The council met on Tuesday to discuss the plan, and after a long debate the members agreed on a first draft of it.",
    "Heavy rain fell in the night. By morning the river had risen by two metres, but no houses were damaged.",
    "She opened the letter slowly.",
    "Der neue Bahnhof wird im Herbst eröffnet, teilte die Stadt am Montag mit; bis dahin fahren Busse.",
    "Les résultats, publiés hier, montrent une hausse de trois pour cent par rapport à l'année dernière.",
    "En la plaza había mucha gente esperando, aunque hacía frío y empezaba a llover.",
    "Results are shown in the table below.",
    "x.",
)
_MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Contact")) + "</ul>"
#: Menus are of any length, and their words of any kind.
_LONG_MENU = "<ul>" + "".join(
    f'<li><a href="/{i}">{w}</a></li>' for i, w in enumerate(("the", "Town.", "of", "Culture,", "Arts", "Sport.", "Weather; sea", "Help?", "Jobs.", "Cars", "a.b.", "Go!"))
) + "</ul>"
_LINKS = "<ul>" + "".join(f'<li><a href="/a/{i}">{t}</a></li>' for i, t in enumerate(("Rain in the north", "A new school", "Train late again"))) + "</ul>"


def _paragraphs(a: int, n: int) -> str:
    return "".join(f"<p>{_TEXT[(a + i) % len(_TEXT)]}</p>" for i in range(n))


_READ = "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(("The report in full", "Minutes of the meeting", "Map of the valley")))
_MAIN = (
    # Links are content as well where they stand in an article: alone in a paragraph, in lists, in tables.
    '<article data-y=1><h1>{title}</h1>{body}<p><a href="/r">Read the whole report of the council</a></p><ul>'
    + _READ
    + '</ul>{inside}</article>',
    '<div class="post body" data-y=1><h2><a href="/p">{title}</a></h2>{body}<h3>Sources</h3><ol>' + _READ + "</ol>{inside}</div>",
    '<article data-y=1><h1>{title}</h1><p><a href="/x">{title}</a></p>{body}<table><tr><td><a href="/t">Town</a></td><td>12</td></tr></table><p>x = 2</p>{inside}</article>',
    "<article data-y=1><h1>{title}</h1>{body}{inside}</article>",
    "<main><div class=content data-y=1><h1>{title}</h1><p><b>{title}<br>{body}{inside}</div></main>",
    '<div id="content" class="post entry" data-y=1><h2>{title}</h2>{body}<ul><li>{title}</li><li>One more point, with a reason.</li></ul>{inside}</div>',
    "<main data-y=1><article><h1>{title}</h1><blockquote><p>{title}</p></blockquote>{body}{inside}<table><tr><th>Year</th><td>2001</td></tr></table></article></main>",
    '<div class="story article-body" data-y=1><section><h2>{title}</h2>{body}<pre>a = 1\nb = 2</pre>{inside}</section></div>',
    '<article data-y=1><header><h1>{title}</h1></header><section>{body}<figure><figcaption>{title}</figcaption></figure><h3>{title}</h3><ol><li>First, look.</li></ol></section>{inside}</article>',
    "<article data-y=1><h1>{title}</h1><div>{body}</div><div><p>{title}</p></div><dl><dt>Word</dt><dd>Its meaning.</dd></dl>{inside}</article>",
)
_BEFORE = (
    f"<nav data-y=0>{_MENU}</nav>",
    f"<nav data-y=0>{_LONG_MENU}</nav>",
    f'<header data-y=0>{_LONG_MENU}</header>',
    f'<div class="nav links" data-y=0>{_LONG_MENU}</div>',
    f'<header data-y=0><a href="/">Daily Post</a><div class="menu">{_MENU}</div><p>News since 1901</p></header>',
    '<div class="ad" data-y=0>Buy two shirts and get one free today.</div>',
    '<div class="cookie-notice" data-y=0><p>We use cookies, as most sites do, to count our readers.</p><button>Accept</button></div>',
    f'<div id="sidebar" class="sidebar" data-y=0><h3>Most read</h3>{_LINKS}</div>',
    '<form data-y=0><label>Search</label><input name="q"><button>Go</button></form>',
    '<div class="banner notice alert" data-y=0><p>The office is closed on Friday.</p></div>',
    f'<div class="breadcrumb navigation" data-y=0>{_MENU}</div>',
    '<div class="topbar masthead" data-y=0><p>Daily Post, news since 1901.</p></div>',
)
_AFTER = (
    "<footer data-y=0>&copy; 2020 Daily Post. All about the town, every day.</footer>",
    f'<aside data-y=0><h2>Related</h2>{_LINKS}<p>More about this, and what came of it, in our next issue.</p></aside>',
    '<section class="comments" id="comments" data-y=0><h2>Comments</h2><div class="comment"><p>I was there, and it was not like that at all.</p></div><div class="comment"><p>Thanks!</p></div></section>',
    f'<div class="related-posts recommended" data-y=0><h3>Read on</h3>{_LINKS}</div>',
    '<div class="newsletter subscribe signup" data-y=0><p>Get our letter every Monday morning.</p><form><input><button>Sign up</button></form></div>',
    f"<footer data-y=0>{_LONG_MENU}<p>All about the town.</p></footer>",
    f'<aside data-y=0>{_LONG_MENU}</aside>',
    f'<div class="tags" data-y=0>{_LONG_MENU}</div>',
    '<div class="footer legal" data-y=0><p>Terms of use. Privacy. Imprint.</p></div>',
    '<div class="advert sponsored promo" data-y=0><p>Fly to the sun this winter, from ninety nine a seat.</p></div>',
    '<div class="share social" data-y=0><a href="#">Share</a> <a href="#">Mail</a></div>',
    '<ol class="commentlist replies" data-y=0><li class="reply"><p>Well said, I could not agree more with this.</p></li></ol>',
)
_INSIDE = (
    "",
    '<div class="ad" data-y=0>Buy two shirts and get one free today.</div>',
    "",
    '<aside data-y=0><p>Also read: the story of the bridge.</p></aside>',
    "",
    '<div class="comments" data-y=0><p>I was there, and it was not like that at all.</p></div>',
    '<form data-y=0><label>Mail</label><input><button>Send</button></form>',
    '<form data-y=0><p>Tell us what you think, we answer every mail.</p><textarea></textarea></form>',
    '<nav class="toc" data-y=0><ul><li><a href="#a">Part one</a></li></ul></nav>',
    '<footer data-y=0><p>Filed under <a href="/t">Town</a></p></footer>',
    '<div class="notice" data-y=0><p>This page was moved.</p></div>',
    '<div class="sidebar" data-y=0><p>Most read: the flood, the bridge, the fair.</p></div>',
)


def labelled_pages() -> list[str]:
    """Every main part with changing parts around and inside it."""
    out = []
    inside = [""] + [part for parts in zip(_INSIDE, _AFTER, _BEFORE, strict=True) for part in parts]
    for k in range(120):
        title, body = _TEXT[k % len(_TEXT)], _paragraphs(k, 1 + k % 5)
        main = _MAIN[k % len(_MAIN)].format(title=title, body=body, inside=inside[k % len(inside)] + f"<p>{_TEXT[k // 3 % len(_TEXT)]}</p>" * (k % 2))
        before = "".join(_BEFORE[(k + i * 2) % len(_BEFORE)] for i in range(1 + k % 4))
        after = "".join(_AFTER[(k * 2 + i) % len(_AFTER)] for i in range(1 + k % 3))
        wrap = ("{}", '<div id="page" class="wrapper">{}</div>', '<div class="container">{}</div>')[k % 3]
        out.append(f"<html><head><title>{title}</title></head><body data-y=0>" + wrap.format(before + f"<div data-y=0>{main}</div>" * (k % 2) + main * (1 - k % 2) + after) + "</body></html>")
    return out
