"""Pages written and labelled by hand, from which the content model learns layouts that a corpus may not mark.

``data-y="1"`` marks the boxes whose text is content, ``data-y="0"`` boxes inside them that aren't.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.html_content import Page, labels_of, parse

LONG = (
    "The ferry left the harbour shortly before dawn, and by noon the islands had sunk below the horizon. "
    "Nobody on deck spoke much; the wind took every word, and the engine took the rest. When the coast came into sight "
    "at last, the passengers gathered at the rail and counted the lights."
)
MIDDLE = "Later that year the line was closed, and the timetable was taken down from the wall of the waiting room."
SHORT = "It rained for three days."
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/about'>About us</a></li></ul>"
LINKS = "<ul><li><a href='/1'>Ten bridges to see this summer</a></li><li><a href='/2'>Why the tram came back</a></li></ul>"
NAV = f"<nav>{MENU}</nav>"
FOOT = "<footer><p>&copy; 2024 Harbour News. All rights reserved.</p></footer>"

#: The labelled pages.
PAGES = [
    f"<html><head><title>T</title></head><body>{NAV}<article data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{SHORT}</p></article>{FOOT}</body></html>",
    f"<html><body><header><h1>Harbour News</h1>{NAV}</header><main data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{MIDDLE}</p><h2>After the war</h2><p>{LONG}</p></main><aside><h3>Related</h3>{LINKS}</aside>{FOOT}</body></html>",
    f"<html><body><div id='header'><div class='logo'>Harbour News</div></div><div class='menu'>{MENU}</div><div id='content' data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{SHORT}</p><p>{MIDDLE}</p></div><div class='sidebar'><h3>Popular</h3>{LINKS}</div><div id='footer'>Imprint. Contact the editors by mail.</div></body></html>",
    f"<html><body>{NAV}<div class='cookie-notice'><p>We use cookies to make this site better. By going on you agree to our terms.</p></div><div class='post' data-y='1'><h2>The last ferry</h2><div class='entry-content'><p>{LONG}</p><blockquote><p>{SHORT}</p></blockquote><p>{MIDDLE}</p></div></div><section class='comments'><h3>2 comments</h3><div class='comment'><p>I was on that boat, and it was colder than you say. Thanks for writing this.</p></div><div class='comment'><p>Great read!</p></div></section>{FOOT}</body></html>",
    f"<html><body><article data-y='1'><h1>The last ferry</h1><p>{LONG}</p><div class='ad' data-y='0'>Cheap cruises from 99. Book now.</div><p>{MIDDLE}</p><ul><li>{SHORT}</li><li>The lamps were lit.</li></ul><div class='share' data-y='0'><a href='#'>Share</a> <a href='#'>Post</a></div></article><div class='comments'><p>{MIDDLE}</p><p>What a story. I will go there myself next spring.</p></div></body></html>",
    f"<html><body><p data-y='1'>{LONG}</p><p data-y='1'>{MIDDLE}</p><p data-y='1'>{SHORT}</p></body></html>",
    f"<html><body><h1 data-y='1'>The last ferry</h1><p data-y='1'>{LONG}</p><p data-y='1'>{MIDDLE}</p><form><p>Sign up for our letter and never miss a story.</p><label>Mail</label></form></body></html>",
    f"<html><body><div class='ad'>Sponsored. New boots for the season, half the price.</div><section class='article-body' data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{SHORT}</p><table><tr><td>Crossing</td><td>Two hours</td></tr></table><pre>07:10 12:40 18:05</pre></section><aside><p>{MIDDLE}</p></aside><footer><p>{MIDDLE}</p></footer></body></html>",
    f"<html><body><div class='banner'>Our site is moving. Read more.</div><article data-y='1'><h1>The last ferry</h1><p>{SHORT}</p></article><div class='ad'>{MIDDLE}</div><footer>&copy; Harbour News &middot; {MIDDLE}</footer></body></html>",
    f"<html><body><nav>{MENU}</nav><div class='ad'>{SHORT}</div><main><article data-y='1'><h1>The last ferry</h1><p>{LONG}</p><form data-y='0'><p>Search the archive for more.</p></form><p>{MIDDLE}</p><nav data-y='0'><a href='/p'>Earlier</a> <a href='/n'>Later</a></nav></article><section id='comments'><article class='comment'><p>{MIDDLE}</p></article><article class='comment'><p>Thank you for this, it brought it all back.</p></article></section></main></body></html>",
    f"<html><body><div class='wrapper'><div class='nav'>{MENU}</div><div class='main-text' data-y='1'>{LONG}<br>{MIDDLE}<br>{SHORT}</div><div class='footer'>All rights reserved.</div></div></body></html>",
    f"<html><body><div class='wrapper'><div role='navigation'>{MENU}</div><div role='main' data-y='1'><h3>The last ferry</h3><p>{LONG}</p><figure><figcaption>The pier in winter.</figcaption></figure><p>{MIDDLE}</p></div><div role='complementary'>{LINKS}<p>{SHORT}</p></div><div role='contentinfo'>{SHORT}</div></div></body></html>",
    f"<html><body><div class='popup' style='display:none'><p>Take our survey and win a cruise for two.</p></div><article data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{LONG}</p><p>{SHORT}</p><aside data-y='0'><p>{MIDDLE}</p></aside><p>{MIDDLE}</p></article>{FOOT}</body></html>",
]

PAGES += [
    f"<html><body data-y='1'>{LONG}<p data-y='1'>{MIDDLE}</p>{SHORT}</body></html>",
    f"<html><body data-y='1'><h1 data-y='1'>The last ferry</h1>{LONG}<br>{MIDDLE}<br>{SHORT}<br>{LONG}</body></html>",
    f"<html><body data-y='1'><div class='menu' data-y='0'>{MENU}</div>{LONG}<br><br>{LONG}<br>{MIDDLE}<div class='footer' data-y='0'>All rights reserved.</div></body></html>",
    f"<html><body data-y='1'>{LONG}</body></html>",
    f"<html><body data-y='1'>{SHORT}</body></html>",
    f"<body><table><tr><td colspan=2>Harbour News</td></tr><tr><td>{MENU}</td><td data-y='1'><h2>The last ferry</h2><p>{LONG}</p><p>{MIDDLE}</p><p>{SHORT}</p></td></tr><tr><td colspan=2>&copy; Harbour News</td></tr></table></body>",
    f"<body><table width='100%'><tr><td>{MENU}</td></tr><tr><td data-y='1'>{LONG}<br>{MIDDLE}<br>{LONG}</td></tr><tr><td>Imprint. Mail to the editors.</td></tr></table></body>",
    f"<body><table><tr><td valign='top'><a href='/'>Home</a><br><a href='/n'>News</a><br><a href='/a'>About us</a></td><td data-y='1'><b>The last ferry</b><br>{LONG}<p>{MIDDLE}<p>{LONG}</td><td><a href='/1'>Ten bridges to see</a><br><a href='/2'>Why the tram came back</a></td></tr></table></body>",
    f"<body><center><a href='/'>Home</a> | <a href='/n'>News</a></center><div data-y='1'><div><font size=4>The last ferry</font></div><div>{LONG}</div><div>{MIDDLE}</div><div>{SHORT}</div></div><center>&copy; 2004 Harbour News</center></body>",
    f"<body><div><div>{MENU}</div><div data-y='1'><h1>The last ferry</h1><div><p>{LONG}</p><p>{SHORT}</p></div><div><p>{MIDDLE}</p></div></div><div><a href='/i'>Imprint</a> <a href='/c'>Contact</a></div></div></body>",
    f"<body><div><a href='/'>Home</a> <a href='/n'>News</a></div><h1 data-y='1'>The last ferry</h1><p data-y='1'>{SHORT}</p><p data-y='1'>{LONG}</p><ul data-y='1'><li>{MIDDLE}</li><li>The lamps were lit.</li></ul><p data-y='1'>{MIDDLE}</p><div>&copy; Harbour News</div></body>",
    f"<body><pre data-y='1'>{LONG} {MIDDLE} {SHORT}</pre></body>",
    f"<body><div class='menu'>{MENU}</div><dl data-y='1'><dt>Ferry</dt><dd>{LONG}</dd><dt>Tram</dt><dd>{MIDDLE}</dd></dl><div class='comments'><p>{SHORT}</p></div></body>",
]


LINKED = f"<p><a href='/rain'>{SHORT}</a></p>"
COOKIES = "A new law on cookies was passed."
PRIVACY = "The judges found that privacy had been breached, and that copyright had not."
TALK = "I was on that boat, and it was colder than you say. Thanks for writing this."
ANSWER = "So was I, and I remember the fog."

#: Pages with comments of readers, link paragraphs, and articles about what sites say of themselves.
PAGES += [
    f"<body>{NAV}<main data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{SHORT}</p><section id='comments' data-y='0'><h2>3 comments</h2><p>{TALK}</p><p>{ANSWER}</p><p>{MIDDLE}</p></section></main>{FOOT}</body>",
    f"<body>{NAV}<div class='post' data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{MIDDLE}</p></div><div class='comments'><div class='comment'><b>Ann</b><p>{TALK}</p></div><div class='comment'><b>Bo</b><p>{ANSWER}</p><div class='comment reply'><b>Ann</b><p>{SHORT}</p></div></div></div>{FOOT}</body>",
    f"<body><div class='menu'>{MENU}</div><div class='text' data-y='1'>{LONG}<br>{MIDDLE}</div><div id='comments'><h3>Discussion</h3><ol><li><cite>Ann</cite><p>{TALK}</p><ul><li><p>{ANSWER}</p></li></ul></li><li><p>{LONG}</p></li></ol></div></body>",
    f"<body><h1 data-y='1'>The last ferry</h1><p data-y='1'>{LONG}</p><p data-y='1'>{MIDDLE}</p><div class='comment-list'><p>{LONG}</p><p>{TALK}</p></div></body>",
    f"<body>{NAV}<main><div class='entry' data-y='1'><h1>The last ferry</h1><p>{LONG}</p><p>{LONG}</p></div><div id='respond'><h3>Leave a reply</h3><p>Your address will not be shown.</p></div><div id='disqus_thread'><p>{TALK}</p></div></main>{FOOT}</body>",
    f"<body><article data-y='1'><h1>The last ferry</h1><p>{LONG}</p>{LINKED}<p>{MIDDLE}</p><section class='comments' data-y='0'><h3>2 comments</h3><p>{TALK}</p><p>{LONG}</p></section></article>{FOOT}</body>",
    f"<body>{NAV}<article data-y='1'><h1>The last ferry</h1><p>{LONG}</p>{LINKED}<p><a href='/t'>{MIDDLE}</a></p></article>{FOOT}</body>",
    f"<body><div>{MENU}</div><div data-y='1'><h1>The last ferry</h1><p>{LONG}</p>{LINKED}<p>{MIDDLE}</p></div><div>{LINKS}</div></body>",
    f"<body><h1 data-y='1'>Cookies in court</h1><p data-y='1'>{COOKIES}</p><p data-y='1'>{LONG}</p><p data-y='1'>{PRIVACY}</p><div>&copy; Harbour News</div></body>",
    f"<body>{NAV}<div data-y='1'><h1>Cookies in court</h1><p>{COOKIES}</p><p>{PRIVACY}</p><p>{MIDDLE}</p></div><div class='cookie'><p>This site uses cookies.</p></div>{FOOT}</body>",
    f"<body>{NAV}<article data-y='1'><h1>What readers think</h1><p>Two hundred comments came in after the story on the ferry.</p><p>{LONG}</p><p>{COOKIES}</p></article>{FOOT}</body>",
    f"<body>{NAV}<div class='story' data-y='1'><h1>A reply to the critics</h1><p>{LONG}</p><h2>Comments from the harbour</h2><p>{MIDDLE}</p></div>{FOOT}</body>",
]


def labelled_pages() -> list[tuple[Page, np.ndarray]]:
    out = []
    for source in PAGES:
        page = parse(source)
        out.append((page, labels_of(page, ["data-y='1'" in a for a in page.attributes], ["data-y='0'" in a for a in page.attributes])))
    return out
