"""Pages without an article element, written and labelled by hand, which no model has learned from: (html, text)."""

A = "In the spring the council voted to reopen the old canal. The locks had been dry for forty years, and most of the gates had rotted where they stood."
B = "Engineers walked the whole length of it with notebooks and came back with a list of repairs that filled eleven pages."
C = "By autumn the first barge had passed through. A crowd stood on the bridge and cheered."
D = "Nobody can say yet what it will cost."
LINKS = "<a href='/a'>Start</a> <a href='/b'>Region</a> <a href='/c'>Sport</a> <a href='/d'>Weather</a>"
LIST = "<ul><li><a href='/a'>Start</a></li><li><a href='/b'>Region</a></li><li><a href='/c'>Sport</a></li></ul>"

PAGES = [
    (f"<html><body>{A}</body></html>", A),
    (f"<html><body>{A}<br>{B}<br><br>{C}</body></html>", f"{A}\n{B}\n{C}"),
    (f"<html><body><p>{A}</p><p>{B}</p><p>{C}</p></body></html>", f"{A}\n{B}\n{C}"),
    (f"<html><body>{LIST}<p>{A}</p><p>{D}</p><p>{B}</p><hr><a href='/i'>Imprint</a></body></html>", f"{A}\n{D}\n{B}"),
    (f"<html><body><table><tr><td>{LIST}</td><td><h1>The canal</h1><p>{A}</p><p>{B}</p></td></tr></table></body></html>", f"The canal\n{A}\n{B}"),
    (f"<html><body><table><tr><td>{LINKS}</td></tr><tr><td>{A}<br><br>{B}<br>{C}</td></tr><tr><td>&copy; 2003 The Canal Post</td></tr></table></body></html>", f"{A}\n{B}\n{C}"),
    (f"<html><body><div>{LINKS}</div><div><h2>The canal</h2><p>{A}</p><p>{B}</p><p>{D}</p></div><div>&copy; The Canal Post. All rights reserved.</div></body></html>", f"The canal\n{A}\n{B}\n{D}"),
    (f"<html><body><div id='nav'>{LIST}</div><div id='body'><div>{A}</div><div>{B}</div><div>{C}</div></div><div id='foot'>Contact us.</div></body></html>", f"{A}\n{B}\n{C}"),
    (f"<html><body><div class='topbar'>{LINKS}</div><main><p>{A}</p><blockquote>{D}</blockquote><p>{B}</p></main><div class='related'><h3>Read on</h3>{LIST}</div></body></html>", f"{A}\n{D}\n{B}"),
    (f"<html><body><header>{LINKS}</header><div class='text'><h1>The canal</h1><p>{A}</p><div class='advert'>Boats for rent from nine a day.</div><p>{C}</p></div><section id='comments'><p>{B}</p></section></body></html>", f"The canal\n{A}\n{C}"),
    (f"<html><body><center>{LINKS}</center><h1>The canal</h1>{A}<p>{B}<p>{C}</body></html>", f"The canal\n{A}\n{B}\n{C}"),
    (f"<html><body><div class='cookie'>We use cookies. <button>Fine</button></div><div class='wrap'><div class='side'>{LIST}</div><div class='story'><p>{A}</p><p>The gate weighs <math><mn>3</mn><mo>+</mo><mn>4</mn></math> tons.</p><object><p>{B}</p></object></div></div></body></html>", f"{A}\nThe gate weighs 3+4 tons.\n{B}"),
]

#: Pages with comments of readers, link paragraphs and words of sites in the text: (html, text), which come out exactly.
READERS = [
    (f"<main><h1>The canal</h1><p>{A}</p><p>{B}</p><section id='comments'><h2>3 comments</h2><p>{C}</p></section></main>", f"The canal\n{A}\n{B}"),
    (f"<body><div class='post'><h1>The canal</h1><p>{A}</p><p>{B}</p></div><div class='comments'><div class='comment'><b>Ann</b><p>{C}</p></div><div class='comment'><b>Bo</b><p>{D}</p></div></div></body>", f"The canal\n{A}\n{B}"),
    (f"<div class='text'><p>{A}</p><p>{C}</p></div><div id='comments'><p>{B}</p></div>", f"{A}\n{C}"),
    (f"<article><h1>The canal</h1><p>{A}</p><p><a href='/d'>{D}</a></p><p>{B}</p></article>", f"The canal\n{A}\n{D}\n{B}"),
    (f"<body><h1>Law</h1><p>{A}</p><p>A new law on cookies was passed.</p><p>{B}</p></body>", f"Law\n{A}\nA new law on cookies was passed.\n{B}"),
    (f"<body><nav>{LINKS}</nav><div id='story'><p>{A}</p><p>{B}</p></div><ul class='commentlist comments'><li class='comment'><p>{C}</p><ul class='children'><li><p>{D}</p></li></ul></li></ul></body>", f"{A}\n{B}"),
    (f"<body><main><article><h1>The canal</h1><p>{A}</p></article><section class='discussion'><h2>Replies (2)</h2><article class='reply'><p>{B}</p></article><article class='reply'><p>{C}</p></article></section></main></body>", f"The canal\n{A}"),
    (f"<body><p>{A}</p><p>{B}</p><div class='comments'>{C}<hr>{D}</div></body>", f"{A}\n{B}"),
    (f"<body><header>{LINKS}</header><article><h1>The canal</h1><p>{A}</p><p>{C}</p><div class='comments'><h3>Comments</h3><div class='comment'><p>{B}</p></div></div></article></body>", f"The canal\n{A}\n{C}"),
]
