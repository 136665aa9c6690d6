"""Small pages labelled by hand: ``data-y`` says whether an element's text is main text, for all below it."""

PAGES = (
    """<html><head><title>T</title></head><body data-y=0><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>
<div class=ad>Buy new shoes today. Only here.</div><article data-y=1><h1>A long walk along the river</h1>
<p>The river rises in the hills, and the path follows it for two days. Walkers meet few people there.</p>
<p>Bring water, bread and a map.</p><p>Short.</p></article><footer>&copy; 2020 Walks. All rights reserved.</footer></body></html>""",
    """<body data-y=0><header><a href=/>Site name</a><p>The best site there is.</p></header><div id=content data-y=1>
<h2>How bread is made</h2><p>Flour, water and salt are mixed, and the dough rests for an hour or longer.</p>
<ul><li>Knead the dough well.</li><li>Let it rise.</li></ul><p>Then it is baked until the crust is brown.</p></div>
<div id=sidebar><h3>Related</h3><ul><li><a href=1>Ten cakes</a><li><a href=2>Soups</a></ul></div>
<div id=footer><p>Contact us at any time. Imprint.</p></div></body>""",
    """<body data-y=0><div class="cookie-notice"><p>We use cookies to give you the best experience. Accept all cookies?</p>
<button>Accept</button></div><main data-y=1><h1>Rain expected</h1><p>Rain will fall in the north on Monday, said the office.</p>
<blockquote>It will be wet, and the wind will be strong.</blockquote><p>More is known tomorrow.</p>
<aside data-y=0><p>Read our newsletter, every week in your mail.</p></aside></main>
<section class=comments><h3>Comments</h3><div class=comment><p>I do not believe this forecast, it was wrong before.</p></div>
<div class=comment><p>Great article, thank you very much for writing it.</p></div></section></body>""",
    """<body data-y=0><div class=wrapper><div class=menu><a href=a>One</a> <a href=b>Two</a></div><div class="post-body" data-y=1>
<p>The engine was built by two brothers who had never seen one. It ran for a minute, then stopped.</p>
<h3>Second try</h3><p>They changed the valve, and it ran for an hour.</p><table><tr><td>Try</td><td>Minutes</td></tr>
<tr><td>Second</td><td>60</td></tr></table></div><div class="share social"><a href=x>Share</a> <a href=y>Send</a></div>
<form><p>Search this site for more.</p><input name=q></form></div></body>""",
    """<html data-y=1><p>A page without any frame. It has a few sentences, and nothing else is on it.</p>
<p>The second paragraph ends the page, as there is no more to say.</p></html>""",
    """<body data-y=0><div data-y=1><h1>Plain boxes</h1><p>Some pages are made of boxes without names, and text stands in them, in whole sentences.</p>
<p>A reader knows the text by its length. So can a program.</p></div><div><a href=1>Link one</a><a href=2>Link two</a>
<a href=3>Link three</a></div><div>Copyright by the owner</div></body>""",
    """<body data-y=0><nav class=breadcrumb><a href=1>A</a> / <a href=2>B</a></nav><article class=entry data-y=1><header data-y=1><h1>Stars
of winter</h1></header><p>In winter the sky is dark early, and the brightest stars stand high at night.</p><pre>name  size
Rigel 0.1</pre><p>Look south.</p><footer data-y=0><p>Filed under sky. Tagged winter.</p></footer></article>
<div class=widget><p>Popular posts of this month, chosen by our readers.</p></div></body>""",
    """<body data-y=0><div class=sponsored><p>This offer ends soon, so order your phone now. Prices from ten.</p></div>
<section data-y=1><p>The council met on Tuesday. It spoke about the bridge for three hours.</p><div><p>No vote was taken.</p>
<p>The mayor left early.</p></div></section><div class=login><form><label>Name</label><p>Log in to read more of our stories.</p></form></div></body>""",
    """<body data-y=0><header class=masthead><h1>The Daily Page</h1><p>News since 1900, from all over the land.</p></header>
<div class=article data-y=1><h2>Ships return</h2><p>Four ships came back to the harbour this morning, after a storm had held them.</p>
<div class=ad data-y=0>Fly to the sun, cheap and fast.</div><p>All are safe.</p></div><div class=related><p>Also read: the storm, in pictures and words.</p></div>
<footer><ul><li><a href=1>About</a><li><a href=2>Help</a></ul><p>Published by the page company, in the old town.</p></footer></body>""",
)
