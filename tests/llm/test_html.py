"""Page texts: what must not be lost."""

import math
import random

import pytest

from waterline.llm.html import main_text, threshold

LONG = "Text of the article that goes on for a good while, as paragraphs of articles do, until its end comes."


def paragraphs(name, count):
    return "".join(f"<p>{name}{i} {LONG}</p>" for i in range(count))


def page(body):
    return f"<html><body><nav><a href='/'>Home</a></nav>{body}<footer>End</footer></body></html>"


def test_names_of_article_parts_hide_nothing():
    parts = (
        '<h2 id="related-work">Related work</h2>', '<h2 class="alert">Methods</h2>', f'<section id="share-of-voice"><p>voice {LONG}</p></section>',
        f'<p>one <span class="alert">warning</span> {LONG}</p>',
    )
    head = '<div class="entry-header"><h1>The title</h1></div>'
    for frame in ("<article>{}</article>", "<main>{}</main>", "<div>{}</div>"):
        got = main_text(page(frame.format(head + paragraphs("a", 3) + parts[0] + paragraphs("b", 2) + parts[1] + parts[3] + parts[2])))
        assert [x for x in ("The title", "Related work", "Methods", "warning") if x not in got] == []
        assert "voice" in got or frame.startswith("<div>")
        assert "Home" not in got and "End" not in got


def test_boilerplate_blocks_of_an_article_stay_out():
    links = "".join(f'<li><a href="/{i}">Another story {i}</a></li>' for i in range(5))
    got = main_text(page(f'<article>{paragraphs("a", 3)}<div class="ad">Buy</div><div class="related"><h3>More</h3><ul>{links}</ul></div>{paragraphs("b", 2)}</article>'))
    assert "b1" in got and "Buy" not in got and "Another" not in got and "More" not in got


def test_all_articles_of_a_page_are_kept():
    for first, second in ((5, 5), (6, 4), (4, 6)):
        got = main_text(page(f"<main><article>{paragraphs('a', first)}<p>Short.</p></article><article>{paragraphs('b', second)}</article></main>"))
        assert got.split("\n") == [f"a{i} {LONG}" for i in range(first)] + ["Short."] + [f"b{i} {LONG}" for i in range(second)]


def test_leads_outside_the_content_element_are_kept():
    lead = f"<h1>The title</h1><p>lead {LONG}</p>"
    for frame in ("<main>{}<article>{}</article></main>", "<div><div>{}</div><div>{}</div></div>"):
        got = main_text(page(frame.format(lead, paragraphs("a", 20)))).split("\n")
        assert got == ["The title", f"lead {LONG}", *(f"a{i} {LONG}" for i in range(20))]


def test_unreadable_declarations_do_not_end_the_page():
    for mark in ("<![foo[x]]>", "<![ endif]>", "<![>", "<![if unclosed>", "<!-- [x] --><![endif]-->"):
        got = main_text(page(f"<article>{paragraphs('a', 3)}{mark}{paragraphs('b', 3)}</article>")).split("\n")
        assert [x for x in got if x[0] in "ab" and x.endswith(LONG)] == [f"{c}{i} {LONG}" for c in "ab" for i in range(3)]
        assert "End" not in got


FIRST = "The first paragraph of the article is long enough to look like text, with commas, and it goes on."
SECOND = "Its second paragraph says more about the same thing, at some length, so that the article is dense."
BODY = f"<p>{FIRST}</p><p>{SECOND}</p>"
ARTICLE = f"<article><h1>Title</h1>{BODY}</article>"
COMMENT = "I disagree with all of this at great length, and I write as many words as the article has, really."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # the end tag of the head is optional
        (f"<html><head><title>x</title><body>{ARTICLE}", f"Title\n{FIRST}\n{SECOND}"),
        (f"<html><head><title>x</title><meta charset=utf-8>{ARTICLE}", f"Title\n{FIRST}\n{SECOND}"),
        (f"<head><script>var a = '<p>';</script><noscript><img src=x></noscript><style>p {{}}</style><p>{FIRST}", FIRST),
        # elements of other languages end with a slash, those of HTML do not
        (f"<article><p>{FIRST}</p><svg/><p>{SECOND}</p></article>", f"{FIRST}\n{SECOND}"),
        (f"<article><p>{FIRST}</p><svg viewBox='0 0 1 1'><title>t</title><path d='M'/><g><text>no</text></g></svg><p>{SECOND}</p></article>", f"{FIRST}\n{SECOND}"),
        # comments by their heading
        (f"<main>{ARTICLE}<section><h3>Comments</h3><p>{COMMENT}</p></section></main>", f"Title\n{FIRST}\n{SECOND}"),
        (f"<article><h1>Title</h1>{BODY}<h2>3 Comments</h2><p>{COMMENT}</p><h2>Notes</h2><p>{SECOND}</p></article>", f"Title\n{FIRST}\n{SECOND}\nNotes\n{SECOND}"),
        (f"<article><h1>Title</h1>{BODY}<div><h3>Leave a reply</h3><p>{COMMENT}</p></div></article>", f"Title\n{FIRST}\n{SECOND}"),
        # an article may have a heading with the word
        (f"<article><h2>Comments on the treaty</h2>{BODY}</article>", f"Comments on the treaty\n{FIRST}\n{SECOND}"),
        # comments by where they stand
        (f"{ARTICLE}<ol><li><article><p>{COMMENT}</p></article><li><article><p>{COMMENT}</p></article></ol>", f"Title\n{FIRST}\n{SECOND}"),
        (f"<article><h1>Title</h1>{BODY}<div><article><p>{COMMENT}</p></article></div></article>", f"Title\n{FIRST}\n{SECOND}"),
        # a list of articles alone is the text
        (f"<ul><li><article><p>{FIRST}</p></article><li><article><p>{SECOND}</p></article></ul>", f"{FIRST}\n{SECOND}"),
        # names in camel case
        (f"<div class='siteHeader'><p>A tagline that is rather long, so that it looks like text, too.</p></div>{ARTICLE}<div id=leftSidebar><p>{COMMENT}</p></div>", f"Title\n{FIRST}\n{SECOND}"),
        # the lead of an article's header
        (f"<article><header><h1>Title</h1><p>{FIRST}</p><time>today</time></header><p>{SECOND}</p></article>", f"Title\n{FIRST}\n{SECOND}"),
        # a line break is white space within its block
        (f"<article><p>{FIRST}<br>{SECOND}<br/>End.</p></article>", f"{FIRST} {SECOND} End."),
    ],
)
def test_pages_as_they_are_written(page, want):
    assert main_text(page) == want


def test_threshold_parts_the_means():
    for values in ([1.0], [0.0, 10.0], [3.0] * 5, [float(i * i % 97) for i in range(3000)], [2.0**i for i in range(300)]):
        cut = threshold(values)
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        if low and high:
            assert math.isclose(cut, (sum(low) / len(low) + sum(high) / len(high)) / 2)


def test_generated_pages_without_optional_tags():
    """Pages written out in full and with end tags left out that HTML does not ask for have one text."""
    draw = random.Random(6)
    for _ in range(60):
        paragraphs = [" ".join(f"{draw.choice('abcdefgh')}{draw.randrange(99)}word," for _ in range(draw.randrange(12, 40))) for _ in range(draw.randrange(2, 6))]
        items = [f"item {i} of a list with some words, as lists in articles have" for i in range(draw.randrange(0, 4))]
        whole = "<!DOCTYPE html><html><head><title>T</title><meta name=a></head><body><nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>"
        whole += "<article><h1>Heading</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + (f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>" if items else "")
        whole += "</article><aside><p>Something else, which is of no use to anybody here</p></aside><footer><p>The end</p></footer></body></html>"
        short = whole
        for tag in ("</head>", "</p>", "</li>", "</body>", "</html>", "<html>", "<head>", "<body>"):
            short = "".join(part if n == 0 or draw.random() < 0.5 else tag + part for n, part in enumerate(short.split(tag))) if tag not in ("<body>", "<html>", "<head>") or draw.random() < 0.5 else short
        want = "\n".join(["Heading", *paragraphs, *items])
        assert main_text(whole) == want
        assert main_text(short) == want
