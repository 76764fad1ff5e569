"""Pages in layouts that the operator's own generator doesn't make, with their main texts written out by hand."""

P1 = "The river rose by two metres overnight, and the lower town was cut off until the morning. Volunteers brought water and blankets to the school."
P2 = "By noon the worst was over. Engineers inspected both bridges, found no damage, and opened them for traffic again."
P3 = "The mayor thanked everyone who had helped. She said that the town would build a higher wall before the next winter."

PAGES = [
    # a blog in the usual form of a content management system, with widgets, related posts and reader comments
    (
        f"""<!DOCTYPE html><html><head><title>Flood - My Blog</title><meta name="x" content="y"></head><body class="single">
<div id="page"><header id="masthead" class="site-header"><div class="site-branding"><p class="site-title"><a href="/">My Blog</a></p></div>
<nav id="site-navigation" class="main-navigation"><ul class="menu"><li><a href="/">Home</a></li><li><a href="/about">About</a></li></ul></nav></header>
<div id="content" class="site-content"><div id="primary"><main id="main"><article id="post-1" class="post"><header class="entry-header"><h1 class="entry-title">Flood in the lower town</h1></header>
<div class="entry-content"><p>{P1}</p>
<p>{P2}</p><h2>Aftermath</h2><p>{P3}</p></div></article>
<div id="comments" class="comments-area"><h2>2 thoughts</h2><ol class="comment-list"><li class="comment"><p>Glad that you are all safe over there.</p></li><li class="comment"><p>We sent a parcel last week, did it arrive?</p></li></ol>
<form class="comment-form"><label>Name</label><input name="n"><textarea>Write here</textarea><button>Send</button></form></div></main></div>
<aside id="secondary" class="widget-area"><section class="widget"><h2>Recent Posts</h2><ul><li><a href="/1">Spring market</a></li><li><a href="/2">New bakery</a></li></ul></section></aside></div>
<footer id="colophon" class="site-footer"><div class="site-info">Proudly powered by ExamplePress</div></footer></div></body></html>""",
        f"Flood in the lower town\n\n{P1}\n\n{P2}\n\nAftermath\n\n{P3}",
    ),
    # nested div elements without any of HTML5's
    (
        f"""<html><head><title>News</title></head><body><div class="wrapper"><div class="top-banner">Advertisement: cheap boats here.</div>
<div class="header"><div class="logo">The Daily Example</div><div class="navbar"><a href="/a">World</a> | <a href="/b">Sport</a> | <a href="/c">Money</a></div></div>
<div class="content"><div class="story"><h1>Flood in the lower town</h1><div class="story-body"><p>{P1}</p><p>{P2}</p>
<blockquote>We were lucky this time, said a baker whose shop stayed dry by a hand's width.</blockquote><p>{P3}</p></div></div></div>
<div class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Ten ways to cook rice</a></li><li><a href="/y">Cup final tonight</a></li></ul></div>
<div class="footer">Copyright The Daily Example. All rights reserved.</div></div></body></html>""",
        f"Flood in the lower town\n\n{P1}\n\n{P2}\n\nWe were lucky this time, said a baker whose shop stayed dry by a hand's width.\n\n{P3}",
    ),
    # a notice about cookies, a newsletter box and an advertisement within the article; lists and a table of content
    (
        f"""<!doctype html><html lang=en><body><div class="cookie-notice"><p>We use cookies to improve your visit. Read our policy.</p><button>Accept</button></div>
<nav class=breadcrumb><a href=/>Home</a> &gt; <a href=/guides>Guides</a></nav><main><article><h1>How to prepare</h1><p>{P1}
<div class="ad"><p>Buy sandbags online. Free delivery today.</p></div><p>Keep these things at hand:</p><ul><li>Water for three days and a torch</li><li>A radio with batteries &amp; a charger</li></ul>
<table><tr><th>Level</th><th>What to do</th></tr><tr><td>Two metres</td><td>Leave the cellar</td></tr></table><p>{P3}</article></main>
<aside class="newsletter"><h3>Newsletter</h3><p>Subscribe and never miss a story.</p><form><input><button>Subscribe</button></form></aside>
<footer><p>&copy; 2024 Example</p></footer></body></html>""",
        f"How to prepare\n\n{P1}\n\nKeep these things at hand:\n\nWater for three days and a torch\n\nA radio with batteries & a charger\n\nLevel\n\nWhat to do\n\nTwo metres\n\nLeave the cellar\n\n{P3}",
    ),
    # a plain old page: headings and paragraphs, a list of links before and after
    (
        f"""<HTML><BODY BGCOLOR=white><H1>Flood of 1998</H1><UL><LI><A HREF=a.html>Index</A><LI><A HREF=b.html>Next</A></UL><P>{P1}<P>{P2}<HR><P>{P3}<UL><LI><A HREF=a.html>Back to the index</A></UL></BODY></HTML>""",
        f"Flood of 1998\n\n{P1}\n\n{P2}\n\n{P3}",
    ),
    # short paragraphs, inline markup, entities, a figure with a caption
    (
        f"""<html><body><header><h2>Example Weekly</h2><nav><a href=1>One</a><a href=2>Two</a></nav></header><section class="article-text"><h1>Caf&eacute; &#8220;Au Bord&#8221; reopens</h1><p>It is <em>open</em> again.</p><p>{P1}</p><figure><img src=x alt=y><figcaption>The caf&eacute; in May</figcaption></figure><p>Coffee is <b>free</b> today.</p><p>{P2}</p></section>
<section id="comments"><p>First! Great news for the whole street.</p><p>See you there on Sunday, friends.</p></section><footer>Imprint</footer></body></html>""",
        f"Café “Au Bord” reopens\n\nIt is open again.\n\n{P1}\n\nThe café in May\n\nCoffee is free today.\n\n{P2}",
    ),
]
