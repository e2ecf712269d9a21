"""Composite text density against a recursive computation on another parser's tree."""

import math
import random
import re
from html.parser import HTMLParser

import pytest

from tessera.llm.html_density import HEADINGS, INLINE, main_text

ARTICLE = "<p>" + "Words of the article that go on for a while. " * 6 + "</p>"
WANT = " ".join(("Words of the article that go on for a while. " * 6).split())


class Tree(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": "", "items": [], "up": None}
        self.at = self.root
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "items": [], "up": self.at}
        self.at["items"].append(node)
        self.at = node

    def handle_endtag(self, tag):
        self.at = self.at["up"]

    def handle_data(self, data):
        self.at["items"].append(data)


def kids(n):
    return [i for i in n["items"] if not isinstance(i, str)]


def measure(n, link, body):
    """Characters, tags, link characters and link tags below (and in) a node."""
    link = link or n["tag"] == "a"
    own = sum(len(" ".join(i.split())) for i in n["items"] if isinstance(i, str))
    n["c"], n["lc"], n["t"], n["lt"] = own, own * link, 0, 0
    for k in kids(n):
        measure(k, link, body)
        n["c"] += k["c"]
        n["lc"] += k["lc"]
        n["t"] += k["t"] + 1
        n["lt"] += k["lt"] + (k["tag"] == "a")


def density(n, ratio):
    if not n["c"]:
        return 0.0
    c, lc, t, lt = n["c"], max(n["lc"], 1), max(n["t"], 1), max(n["lt"], 1)
    base = math.log(c / max(c - n["lc"], 1) * lc + ratio * c + math.e)
    return c / t * math.log(c / lc * t / lt, base)


def brute(page):
    root = Tree(page).root
    body = kids(kids(root)[0])[0]
    measure(body, False, None)
    ratio = body["lc"] / max(body["c"], 1)
    order = []

    def walk(n):
        n["no"] = len(order)
        order.append(n)
        n["d"] = density(n, ratio)
        for k in kids(n):
            walk(k)
        n["sum"] = sum(k["d"] for k in kids(n))
    walk(body)
    block = [n for n in order if n is body or n["tag"] not in INLINE]

    def under(n):
        return [m for m in block if m is n or n in above(m)]

    def above(n):
        out = []
        while n is not body:
            n = n["up"]
            out.append(n)
        return out

    def best(n):
        return max(under(n), key=lambda m: (round(m["sum"], 9), -m["no"]))

    core = best(body)
    threshold = min(n["d"] for n in [core, *above(core)])
    picked, reached = [], []
    for n in block:
        if n["c"] and n["d"] >= threshold - 1e-12 and (n is body or n["up"] in reached):
            reached.append(n)
            picked.append(best(n))
    for n in reversed(order):
        if n["tag"] in HEADINGS and n["c"] and n["up"] in reached:
            later = [k for k in kids(n["up"]) if k["no"] > n["no"] and k["c"]]
            if later and any(p is later[0] or later[0] in above(p) for p in picked if p is not body):
                picked.append(n)

    def show(n, on):
        on = on or n in picked
        inner = "".join(i if isinstance(i, str) and on else "" if isinstance(i, str) else show(i, on) for i in n["items"])
        return inner if n["tag"] in INLINE else " " + inner + " "
    return " ".join(show(body, False).split())


def random_page(rnd):
    def words(n):
        return " ".join(rnd.choice(["stone", "river", "a", "of", "lantern", "wide"]) for _ in range(n))

    def part(depth):
        kind = rnd.random()
        if depth > 3 or kind < 0.45:
            inner = words(rnd.randint(1, 40))
            if rnd.random() < 0.4:
                inner += f" <b>{words(2)}</b> " + words(rnd.randint(0, 9))
            return f"<p>{inner}</p>"
        if kind < 0.6:
            return "<ul>" + "".join(f"<li><a>{words(rnd.randint(1, 4))}</a></li>" for _ in range(rnd.randint(1, 6))) + "</ul>"
        if kind < 0.68:
            return f"<h2>{words(3)}</h2>"
        return "<div>" + "".join(part(depth + 1) for _ in range(rnd.randint(1, 5))) + "</div>"

    return "<html><body>" + "".join(part(0) for _ in range(rnd.randint(1, 6))) + "</body></html>"


@pytest.mark.parametrize("seed", range(60))
def test_density_brute_force(seed):
    page = random_page(random.Random(seed))
    assert main_text(page) == brute(page)


def test_closed_drawings_and_formulas():
    for icon in ('<svg class="i" viewBox="0 0 9 9"/>', "<svg><path d='M0'/></svg>", '<math/>', "<svg>"):
        assert main_text(f"<html><body><div>{icon}{ARTICLE}</div></body></html>") == WANT


def test_marks_around_the_whole_page():
    side = "<div class='sidebar'><p>more to read elsewhere</p></div><footer>foot</footer>"
    for first, last in (("<form action='/x'>", "</form>"), ("<div id='notice'>", "</div>"),
                        ("<div class='overlay'><div class='popup'>", "</div></div>")):
        for inner in (ARTICLE, f"<article>{ARTICLE}</article>"):
            assert main_text(f"<html><body>{first}{side}<div>{inner}</div>{last}</body></html>") == WANT


def test_marked_parts_beside_the_article_go():
    long = "<p>" + "Readers say this and that about it. " * 60 + "</p>"
    for part in (f"<div class='comments'>{long}</div>", f"<div id='respond'><article>{long}</article></div>",
                 f"<form><p>{'Your name and your mail address. ' * 30}</p></form>"):
        for inner in (ARTICLE, f"<article>{ARTICLE}</article>"):
            assert main_text(f"<html><body><div>{inner}</div>{part}</body></html>") == WANT


def test_headings_with_a_word_of_a_mark_stay():
    page = f"<html><body><div><h2 class='share-prices'>Share prices</h2>{ARTICLE}{ARTICLE}</div></body></html>"
    assert main_text(page) == f"Share prices {WANT} {WANT}"


def test_article_elements_are_not_needed():
    page = f"<html><body><div><a>menu</a><a>menu</a></div><article><h1>Title</h1>{ARTICLE}</article></body></html>"
    want = f"Title {WANT}"
    assert main_text(page) == main_text(re.sub("article>", "div>", page)) == main_text(page, semantic=True) == want
