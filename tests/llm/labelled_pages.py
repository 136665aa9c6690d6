"""Pages that the model has never seen: ``data-y`` says whether an element's text is main text, for all below it."""

HELD_OUT = {
    "article with a sentence that is a link": """<html><head><title>x</title></head><body data-y=0><nav><a href=/>Home</a></nav><article data-y=1>
<h1>On tides</h1><p>Tides turn twice a day.</p><p><a href=/moon>The moon pulls the sea, and the sea follows it slowly.</a></p>
<ul><li><a href=/a>Spring tide</a></li><li><a href=/b>Neap tide</a></li></ul></article><footer>&copy; Tides</footer></body></html>""",
    "header and comments inside the article": """<body data-y=0><article data-y=1><header class="page-header"><h1>Clay pots</h1></header>
<p>Clay is dug from the river bank and dried for a week before it is worked.</p><div class="comments-area" data-y=0><p>I tried this
at home, and it worked well for me.</p></div></article></body>""",
    "a single paragraph": "<html><body><p data-y=1>Only this paragraph stands on the page.</p></body></html>",
    "nav, two paragraphs, footer": """<body data-y=0><nav><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></nav>
<p data-y=1>The first paragraph tells of a road that leads to the coast.</p><p data-y=1>The second one tells where it ends.</p>
<footer>Made by hand in a small town.</footer></body>""",
    "post": """<body data-y=0><div class=header><a href=/>My diary</a></div><div class=post data-y=1><h2>Monday</h2><p>It rained, so we stayed
inside and read.</p><p>In the evening it cleared up.</p></div><div class=footer>Powered by a machine.</div></body>""",
    "main": """<body data-y=0><header><h1>Museum</h1></header><main data-y=1><h2>Opening hours</h2><p>The museum is open from ten to six.</p>
<p>On Mondays it is closed.</p></main><footer><p>Address: 1 Long Street.</p></footer></body>""",
    "text without elements": "<html><body data-y=1>Plain words on a plain page, with no element around them.</body></html>",
    "paragraphs in nameless boxes": """<body data-y=0><div><div><a href=1>Start</a> <a href=2>Archive</a> <a href=3>About</a></div><div data-y=1>
<h1>The lighthouse keeper</h1><p>He kept the light for forty years and never missed a night.</p><p>When he left, a lamp on a timer took
his place.</p><p>Nobody has climbed the tower since.</p></div><div><a href=9>Imprint</a> <a href=8>Privacy</a></div></div></body>""",
    "cookie notice, advert, share links": """<body data-y=0><div id=gdpr-consent><p>We and our partners store data on your device. You can
change that at any time.</p><button>Agree</button></div><div class="top-banner"><p>Half price on all chairs this week only!</p></div>
<article class=news data-y=1><h1>Bridge closed</h1><p>The old bridge is closed for repairs until the spring.</p><div class=share-buttons data-y=0>
<a href=x>Tell a friend</a></div><p>Buses take the long way round.</p></article></body>""",
    "sidebar before the text": """<body data-y=0><aside><h4>Popular</h4><ul><li><a href=1>Ten ways to boil an egg</a></li><li><a href=2>Best pans</a></li></ul>
</aside><section id=main-content data-y=1><h1>Onion soup</h1><p>Slice the onions thinly and let them brown slowly in butter.</p><ol><li>Add the
stock.</li><li>Simmer for an hour.</li></ol></section></body>""",
    "comments longer than the text": """<body data-y=0><article data-y=1><h1>Poll</h1><p>Which bread do you like best?</p></article><section class=comments>
<h2>12 comments</h2><div class=comment><p>Rye, always rye. My mother baked it every Friday, and the whole street could smell it.</p></div>
<div class=comment><p>White bread with butter is hard to beat, although I know that it is not the healthy choice at all.</p></div>
<div class=comment><p>I bake my own, from a starter that is older than my children, and nothing in the shops comes near it.</p></div></section></body>""",
    "forum answers in article elements": """<body data-y=0><main data-y=1><h1>How do I sharpen a plane?</h1><p>My plane tears the grain. What should I do about it?</p></main>
<div id=comments><article class=comment-body><p>Use a fine stone and go slowly.</p></article><article class=comment-body><p>Have it done by someone.</p></article></div></body>""",
    "layout by tables": """<body data-y=0><table><tr><td class=menu><a href=1>News</a><br><a href=2>Sport</a></td><td data-y=1><h2>Village fair</h2>
<p>The fair was opened by the mayor on Saturday, in bright sunshine.</p><p>Some four hundred people came.</p></td></tr></table><p class=copyright>&copy; Village</p></body>""",
    "list as the text": """<body data-y=0><nav><a href=1>Recipes</a></nav><article data-y=1><h1>Packing list</h1><ul><li>Two warm jumpers</li><li>A torch</li>
<li>Rope, ten metres</li><li>Matches</li></ul></article><footer><ul><li><a href=1>Contact</a></li></ul></footer></body>""",
    "wrapper whose name speaks of a sidebar": """<body class="right-sidebar nav-fixed" data-y=0><div class="page-wrap has-sidebar"><div class=content data-y=1><h1>Moving house</h1>
<p>Boxes should be no heavier than one person can lift.</p><p>Label each of them on two sides.</p></div><div class=sidebar-right><p>Subscribe to our letter.</p></div></div></body>""",
    "byline, figure, quote": """<body data-y=0><header class=site-head><a href=/>The Courier</a></header><article data-y=1><header><h1>Owls return to the park</h1><p>By a
staff writer</p></header><figure><img src=o><figcaption>An owl in the park on Sunday.</figcaption></figure><p>Three pairs of owls nest in the park
this year.</p><blockquote>We had given up hope.</blockquote><h2>Why now?</h2><p>The old trees were left standing.</p></article><nav class=pagination><a href=2>Next</a></nav></body>""",
    "search form and login": """<body data-y=0><form class=search><label>Search the site</label><input name=q><button>Go</button></form><div class=login-box><p>Please log in
to see your own pages and settings.</p></div><div class=text data-y=1><p>A sundial shows the hours as long as the sun shines.</p><p>At night it is of no use.</p></div></body>""",
    "related stories inside the article": """<body data-y=0><article data-y=1><h1>Snow</h1><p>Snow fell overnight and closed the pass.</p><div class=related data-y=0><h4>Read also</h4><ul>
<li><a href=1>Last winter's snow</a></li></ul></div><p>It is to open again by noon.</p><aside data-y=0><p>Our app brings you news first.</p></aside></article></body>""",
    "long text with many links": """<body data-y=0><nav><ul><li><a href=1>A-Z</a></li></ul></nav><div id=article-body data-y=1><h1>Canals</h1><p>A <a href=c>canal</a> is a
<a href=w>waterway</a> made by people. <a href=l>Locks</a> lift boats from one <a href=r>reach</a> to the next, and <a href=t>towpaths</a> run beside it.</p><p><a href=x>Canals of the
north</a> were dug for coal.</p></div><div class=footer-links><a href=1>Help</a><a href=2>Terms</a></div></body>""",
    "sections without a wrapper": """<body data-y=0><nav><a href=1>Guide</a> <a href=2>Reference</a></nav><section data-y=1><h1>Install</h1><p>Download the file and unpack it.</p><pre>tar xf file.tar</pre></section>
<section data-y=1><h2>Run</h2><p>Start the program from the folder.</p></section><footer>Version 3</footer></body>""",
    "everything at once": """<body data-y=0><div class=cookie-bar>This site uses cookies.</div><header id=masthead><h1>Garden Weekly</h1><p>Since 1911.</p></header><nav class=navbar><ul><li><a href=1>Beds</a></li>
<li><a href=2>Trees</a></li></ul></nav><div class=container><div class="ads"><p>Spades, now two for one.</p></div><main><article data-y=1><h2>Pruning roses</h2><p>Cut above a bud that
faces outwards, and cut on a dry day.</p><div class=advertisement data-y=0><p>Gloves that last.</p></div><p>Burn what you cut.</p><form class=newsletter data-y=0><p>Get the weekly letter.</p><input></form>
</article></main><aside class=sidebar><p>Ask our expert every Tuesday.</p></aside><section id=comments><p>My roses died, what now?</p></section></div><footer class=site-footer><p>Garden Weekly Ltd.</p></footer></body>""",
}
