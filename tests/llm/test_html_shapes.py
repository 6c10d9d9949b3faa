"""Main text of pages of other shapes than the invented training pages; written by hand, filled with English words."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import html_text

WORDS = (
    "the of and a river council said that its new plan would cost more than last year but residents of many towns along valley"
    " want better bridges safer roads schools open until late when rain came engineers measured water every hour while farmers moved"
    " cattle to higher ground because nobody could tell how long it might take before repairs begin"
).split()
#: "@+n" is a block of main text of about n words, "@-n" a block that is none.
SHAPES = [
    # Plain boxes with a name of no meaning.
    '<body><div class="hdr logo"><a href="/">@-2</a></div><ul class="tabs"><li><a href="#">@-1</a><li><a href="#">@-2</a></ul><div class="prose">'
    "<div><h1>@+6</h1><p>@+40</p><p>@+55</p><ul><li>@+8</li><li>@+5</li></ul><p>@+30</p></div></div><footer>@-12</footer></body>",
    # A short article with a list of definitions.
    "<body><nav><a href=a>@-3</a></nav><article><p>@+24</p><noscript>enable it</noscript><dl><dt>@+2</dt><dd>@+14</dd><dt>@+1</dt><dd>@+9</dd></dl>"
    "</article><footer><p>@-9</p></footer></body>",
    # Columns of a table.
    '<body><table width="100%"><tr><td class="leftmenu nav"><a href=1>@-2</a></td><td><h1>@+5</h1><p>@+60</p><p>@+35</p><h3>@+3</h3><p>@+20</p></td></tr>'
    '</table><div class="copyright">@-8</div></body>',
    # Comment boxes that never end.
    "<body><header><h2>@-3</h2></header><main><h1>@+7</h1><p>@+45</p><p>@+38</p></main><section class='comments'><h3>@-2</h3>"
    + '<div class="comment">' * 70 + "<p>@-22</p><p>@-31</p></body>",
    # A sidebar whose boxes never end, but the sidebar does.
    "<body><aside class='sidebar'><h4>@-2</h4>" + "<div>" * 80 + "<p>@-12</p></aside><article><h1>@+5</h1><p>@+42</p><blockquote>@+18</blockquote><p>@+37</p></article></body>",
    # A page of an application: boxes in boxes.
    '<body><div id="root"><div><div class="navbar"><a>@-1</a></div><div><section class="longread"><h2>@+6</h2><p>@+50</p><div><p>@+33</p><p>@+25</p></div>'
    '<aside class="promo"><p>@-10</p></aside><p>@+44</p></section></div><form action=x><label>@-3</label><input><button>@-1</button></form></div></div></body>',
    # A consent dialogue; comments marked up as articles.
    '<body><div role="dialog" class="gdpr-consent"><p>@-22</p><button>@-1</button></div><div class="post-body"><h1>@+8</h1><p>@+30</p><figure><img src=x>'
    '<figcaption>@+9</figcaption></figure><p>@+48</p></div><section id="discussion"><h3>@-1</h3><article class="comment"><p>@-26</p></article>'
    '<article class="comment"><p>@-15</p></article></section></body>',
    # No names at all.
    "<body><header>@-3</header><nav><ul><li><a href=a>@-1</a></li><li><a href=b>@-1</a></li></ul></nav><div><h1>@+4</h1><p>@+36</p><p>@+52</p><p>@+28</p></div>"
    "<footer><ul><li><a href=c>@-1</a></li></ul></footer></body>",
    # A recipe: many short blocks.
    '<body><div class="topbar"><a href=x>@-2</a></div><main id="recipe"><h1>@+3</h1><ul><li>@+3</li><li>@+2</li><li>@+4</li></ul><ol><li>@+12</li><li>@+16</li></ol>'
    '</main><div class="related-links"><h3>@-2</h3><ul><li><a href=y>@-4</a></li><li><a href=z>@-5</a></li></ul></div><footer>@-7</footer></body>',
    # Paragraphs as boxes; adverts between them.
    '<body><div class="site"><div class="masthead">@-2</div><div class="body-copy"><h1>@+6</h1><div>@+41</div><div class="adbox">@-6</div><div>@+39</div><div>@+27</div></div>'
    '<div class="newsletter"><p>@-14</p><form><button>@-1</button></form></div></div></body>',
]
FILLS = 24


def filled(shape: str, rng: random.Random) -> tuple[str, list[int]]:
    labels: list[int] = []

    def words(m: re.Match) -> str:
        labels.append(int(m[1] == "+"))
        count = max(1, round(int(m[2]) * rng.uniform(0.7, 1.4)))
        found = [rng.choice(WORDS) + ("," if rng.random() < 0.06 else "") for _ in range(count)]
        return " ".join(found).capitalize() + ("." if count > 5 else "")

    return re.sub(r"@([+-])(\d+)", words, shape), labels


@pytest.fixture(scope="module")
def scores():
    rng, model = random.Random(7), html_text.trained()
    scores = []
    for shape in SHAPES:
        hits = wrong = missed = 0
        for _ in range(FILLS):
            page, labels = filled(shape, rng)
            blocks = html_text.blocks_of(page)
            assert len(blocks) == len(labels)
            main = model.probabilities([html_text.features(blocks)])[0] >= 0.5
            truth = np.array(labels) == 1
            hits, wrong, missed = hits + (main & truth).sum(), wrong + (main & ~truth).sum(), missed + (~main & truth).sum()
        scores.append((int(hits), int(wrong), int(missed)))
    return scores


def f1(hits: int, wrong: int, missed: int) -> float:
    return 2 * hits / max(1, 2 * hits + wrong + missed)


def test_blocks_of_other_shapes(scores):
    assert len(SHAPES) * FILLS >= 200
    assert f1(*np.sum(scores, axis=0)) >= 0.9, scores
    assert min(f1(*s) for s in scores) >= 0.75, scores


def test_closing_tags_reach_any_depth_and_all_names_count():
    deep = html_text.blocks_of("<aside>" + "<div>" * 3000 + "x</aside><p>y</p>")
    flat = html_text.blocks_of("<aside><div>x</div></aside><p>y</p>")
    assert np.array_equal(deep[1].path, flat[1].path)
    names = " ".join(f"n{i}" for i in range(40))
    one, other = (html_text.blocks_of(f'<div class="{names} {last}">x</div>')[0].path for last in ("first", "second"))
    assert not np.array_equal(one, other)
