"""Language, quality, pages, chat, surrogates, pieces and the mix."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import lang_gru as L
from tessera.llm import pii_surrogate as P
from tessera.llm import sp_nbest as N
from tessera.llm.chat_rotation import chat_rotation
from tessera.llm.common import Scratch, documents
from tessera.llm.cube_mix import cube_mix, fly, ordered
from tessera.llm.html_density import html_density, main_text
from tessera.llm.quality_cascade import RULES, order_rules, quality_cascade
from tessera.llm.queries import QUERIES


# ------------------------------------------------------------------- language

def test_gradient_is_right():
    rng = np.random.Generator(np.random.PCG64(1))
    m = {k: v.astype(np.float64) for k, v in L.new_model(3, 4, rng).items()}
    x = rng.integers(0, 256, (12, 5))
    live = (np.arange(12)[:, None] < rng.integers(4, 13, 5)).astype(np.float64)
    y = rng.integers(0, 3, 5)
    _, grad = L.loss_and_gradient(m, x, live, y)
    for k in grad:
        at = (x[2, 1], 1) if k[0] == "W" else tuple(0 for _ in m[k].shape)
        e = 1e-3
        m[k][at] += e
        up = L.loss_and_gradient(m, x, live, y)[0]
        m[k][at] -= 2 * e
        down = L.loss_and_gradient(m, x, live, y)[0]
        m[k][at] += e
        assert abs(grad[k][at] - (up - down) / 2 / e) < 1e-3


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_lang_gru"](spark, sf).join(documents(spark, sf).select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.95
    assert got.score.between(0, 1).all() and len(got) == 1000


def test_language_odd_rows(spark, odd, no_docs, clash):
    model, langs = L.train_on(documents(spark, "/root/testdata/sf0.001"), spec=L.SampleSpec(docs=60, epochs=1))
    got = L.identify(odd, model, langs).collect()
    assert len(got) == odd.count()
    for r in got:
        none = r.text is None or not re.search(r"[^\W\d_]", r.text)
        assert (r.lang_pred == "und") == none and 0 <= r.score <= 1
    assert L.identify(no_docs, model, langs).collect() == []
    assert L.train_on(no_docs) == (None, [])
    assert {r.lang_pred for r in L.identify(odd, None, []).collect()} == {"und"}
    assert set(L.identify(clash, model, langs).columns) == set(clash.columns)


# -------------------------------------------------------------------- quality

def test_language_without_labels_and_with_many(spark, monkeypatch):
    from corpus_pipeline import language
    rows = [(i, f"text of row {i}", None, "a", 1) for i in range(6)] + [(9, "123", "en", "a", 1), (10, None, "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in language(spark, df, "").collect()) == list(range(6))
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    many = spark.createDataFrame([(i, "some text", "de" if i < 5 else "en" if i < 9 else f"x{i}") for i in range(15)],
                                 "key long, text string, lang string")
    spans, labels, langs = L.sample_spans(many, L.SampleSpec())
    assert langs == ["de", "en"] and spans and set(labels) == {0, 1}


def test_cascade_order_does_not_change_the_verdict(spark, sf, odd, no_docs):
    docs = documents(spark, sf).select("doc_id", "text")
    ranked = order_rules(docs)
    assert {r.name for r, _, _ in ranked} == {r.name for r in RULES}
    got = [{r.doc_id for r in quality_cascade(docs, rules=rules).where("kept").collect()}
           for rules in (RULES, RULES[::-1])]
    assert got[0] == got[1] and got[0]
    rows = quality_cascade(odd).collect()
    assert len(rows) == odd.count() and all(r.base_failed and not r.kept for r in rows if not (r.text or "").strip())
    assert quality_cascade(no_docs).collect() == []


def test_cascade_keeps_good_and_rejects_bad(spark, sf):
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op2_quality_cascade"](spark, sf).join(lab, "doc_id").toPandas()
    assert not got[got.quality == 0].kept.any()
    assert got[(got.quality == 1) & ~got.base_failed].kept.all()


# ---------------------------------------------------------------------- pages

def test_pages_give_the_article(spark, sf):
    import html
    pages = spark.read.parquet(f"{sf}/pages.parquet").toPandas().set_index("page_id").html
    for r in QUERIES["op4_html_density"](spark, sf).collect():
        h = pages[r.page_id]
        a = h[h.index("<article>") + 9: h.find("</article>") if "</article>" in h else len(h)]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", a))).split())
        assert r.text == want and r.n_chars == len(want)


def test_page_parts_that_go():
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><div id="wrap">
    <ul class="menu"><li><a href=1>Home</a><li><a href=2>About</a></ul><div class="cookie-notice">We use cookies</div>
    <div class="content"><h2>Title here</h2><p>First para with <a href="x">link</a> and text &eacute; that is long, yes.
    <p>Second para un<b>clo</b>sed<br>line two of it.<form><input name=q><label>Name</label></form>
    <div class=ad>Buy</div><script>var a = "</p>";</script></div>
    <div class="sidebar"><p>side</p></div><section id="comments"><p>Great! says bob</p></section></div>
    <footer>foot</footer></body></html>"""
    assert main_text(page) == ("Title here First para with link and text é that is long, yes. "
                               "Second para unclosed line two of it.")
    assert main_text(None) == main_text("") == main_text("<script>x") == ""
    assert main_text("plain < 3 &amp; <b>bold</b>") == "plain < 3 & bold"
    assert main_text("<body><nav><a>x</a><article><p>Hi \"there'</p></article>") == "Hi \"there'"


def test_cut_parts_end_as_in_a_browser():
    one = "<p>One paragraph of the text, long enough.</p><p>Two, that is long enough as well.</p>"
    want = "One paragraph of the text, long enough. Two, that is long enough as well."
    assert main_text(f"<html><head><title>t</title><meta name=a><body>{one}</body></html>") == want
    assert main_text(f"<head><title>t</title>{one}") == want
    assert main_text(f'<body><p class="ad">Buy{one}</body>') == want
    assert main_text(f'<body><section><div class="ad">Buy <b>now</b></section>{one}</body>') == want
    assert main_text(f'<body><span><div class="ad">Buy</span> now</div>{one}</body>') == want
    assert main_text("<body><ul><li class=ad>Buy<li>One item of text<li>Two items of text</ul></body>") == (
        "One item of text Two items of text")
    assert main_text(f"<body><form><select><option>A<option>B</select><p>go</form>{one}</body>") == want


def test_marks_in_part_of_a_name_keep_the_core():
    one = "<p>One paragraph of the text, long enough.</p><p>Two, that is long enough as well.</p>"
    want = "One paragraph of the text, long enough. Two, that is long enough as well."
    for name in ("content has-sidebar", "no-sidebar", "with-comments", "page-header-on"):
        for text in (one, f"<article>{one}</article>"):
            page = f'<body><div class="{name}">{text}<div class="related-links"><p>See this</p></div></div></body>'
            assert main_text(page) == want
    assert main_text(f'<article><h1>Title</h1><div class="with-comments">{one}</div></article>') == "Title " + want
    comments = '<div class="comment-list">' + "<div><p>I do agree with all of this.</p></div>" * 30 + "</div>"
    assert main_text(f'<body><div class="no-sidebar"><article>{one}</article></div>{comments}</body>') == want
    assert main_text(f"<body><article>{one}</article>{comments}</body>") == want
    assert main_text(f'<body><div class="sidebar">{one}</div><p>short</p></body>') == "short"


def test_pages_without_article_give_all_dense_blocks():
    lead = "<h1>The title</h1><p>An introduction of more than one clause, to be read before all of the rest.</p>"
    ten = "".join(f"<p>Paragraph {i} of the text, with its words.</p>" for i in range(10))
    links = "<div>" + "<a href=1>Link</a> " * 5 + "</div>"

    def strip(h):
        return " ".join(re.sub(r"<[^>]*>", " ", h).split())

    assert main_text(f"<body><div>{lead}</div><div>{ten}</div>{links}</body>") == strip(lead + ten)
    # sparse blocks go, also out of a wrapper; a heading stays with its block
    assert main_text(f"<body><div>{lead}</div><div><p>x</p><p>y</p></div><div>{ten}</div>{links}</body>") == (
        strip(lead + ten))
    assert main_text(f"<body><div><div>{ten}</div>{links}</div></body>") == strip(ten)
    assert main_text(f"<body><div><h1>Title</h1><div>{ten}</div></div>{links}</body>") == "Title " + strip(ten)
    assert main_text(f"<body>{ten}</body>") == strip(ten)


def test_pages_odd_rows(spark):
    long = "<article>" + "<p>para graph</p>" * 20000 + "</article>"
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", long, "x"), (2, "u", long, "x")],
                               "page_id long, url string, html string, text string")
    got = [(r.page_id, r.n_chars) for r in html_density(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0), (None, 0), (2, 20000 * 11 - 1), (2, 20000 * 11 - 1)], key=repr)
    assert html_density(df.limit(0)).collect() == []


# ----------------------------------------------------------------------- chat

def test_rotation(spark):
    rows = [(1, 0, "system", "Be <|im_end|> kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "é"),
            (1, 3, None, "é"), (None, None, "x y", "t"), (2, 0, "system", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective): r for r in chat_rotation(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "x y")}
    r = got[1, "ann"]
    assert r.text == ("<|im_start|>system\nBe <\\|im_end|> kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                      "<|im_start|>user name=bob\n<|im_end|>\n" + "<|im_start|>user name=unknown\né<|im_end|>\n" * 2)
    assert [r.text[m.start:m.end] for m in r.mask] == ["hi<|im_end|>"]
    r = got[1, "unknown"]
    assert [r.text[m.start:m.end] for m in r.mask] == ["é<|im_end|>"] * 2
    assert chat_rotation(df.limit(0)).collect() == []


def test_rotation_in_parts(spark):
    rows = [(7, i, "ab"[i % 2], f"t{i}") for i in range(25)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.perspective: r for r in chat_rotation(df).collect()}
    parts = sorted(chat_rotation(df, part=4).collect(), key=lambda r: (r.perspective, r.part))
    for who, r in whole.items():
        own = [p for p in parts if p.perspective == who]
        assert "".join(p.text for p in own) == r.text
        assert [(m.start + p.start, m.end + p.start) for p in own for m in p.mask] == [(m.start, m.end) for m in r.mask]


# ----------------------------------------------------------------- surrogates

def test_surrogates_keep_type_and_format():
    text = ("Mr John Smith met Mrs. Anna Smith; г-жа Анна Иванова, MR JOHN SMITH. +1 (017) 555-7713 "
            "NT.26@MAIL6.EXAMPLE.COM nt.26@mail6.example.com DE89 3704 0044 0532 0130 00 4111-1111-1111-1111 10.0.0.1")
    table = {(k, e): P.draw(b"k", k, e, 0) for _, _, k, e in P.mentions(text)}
    new, found = P.rewrite(text, table)
    kinds = [f["type"] for f in found]
    assert kinds == ["given_M", "surname", "given_F", "surname", "given_F", "surname", "given_M", "surname", "phone",
                     "mail", "mail", "iban", "card", "ip"]
    part = [new[f["start"]:f["end"]] for f in found]
    assert part[1] == part[3] and part[7] == part[1].upper() and part[2].endswith("a") and part[4].endswith("а")
    assert P.script(part[5]) == "cyrillic" and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", part[8])
    assert part[9] == part[10].upper() and re.fullmatch(r"\d{4}-\d{4}-\d{4}-\d{4}", part[12])
    card = part[12].replace("-", "")
    assert P.luhn(card[:-1]) == int(card[-1])
    iban = part[11].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    for k, e in table:
        assert e not in new.casefold()


def test_surrogates_are_one_to_one(spark, odd, no_docs, monkeypatch):
    # a small space of candidates: most draws collide and are drawn again
    monkeypatch.setattr(P, "draw", lambda key, kind, e, trial: f"10.0.0.{(hash((e, trial)) if False else sum(map(ord, e)) * 7 + trial * 13) % 250}")
    rows = [(i, f"host 192.168.{i % 30}.{i // 30} and 192.168.{i % 30}.{i // 30}, 10.0.0.5") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.pii_surrogate(df, b"k").collect()}
    ips = {i: re.findall(r"[\d.]+\d", t) for i, t in got.items()}
    assert all(a == b for a, b, _ in ips.values()) and len({a for a, _, _ in ips.values()}) == 60
    assert len({c for _, _, c in ips.values()}) == 1
    used = {x for v in ips.values() for x in v}
    assert "10.0.0.5" not in used and not any(u.startswith("192.168") for u in used)
    monkeypatch.undo()
    out = P.pii_surrogate(odd, b"k").collect()
    assert len(out) == odd.count() and all(r.n_entities == 0 for r in out)
    assert P.pii_surrogate(no_docs, b"k").collect() == []


def brute_map(entities, key):
    """The rounds of draws in plain Python."""
    import xxhash

    def space(kind):
        return "name" if kind == "surname" or kind.startswith("given_") else kind

    def rank(pair):
        h = xxhash.xxh64(pair[1].encode(), seed=42).intdigest()
        return (h - (1 << 64) if h >> 63 else h, pair)

    taken = {(space(k), e) for k, e in entities}
    left, out, trial = set(entities), {}, 0
    while left:
        drawn = {}
        for pair in sorted(left, key=rank):
            drawn.setdefault((space(pair[0]), P.draw(key, *pair, trial)), pair)
        won = {pair: s for s, pair in drawn.items() if s not in taken}
        taken |= set(won.values())
        out.update({pair: s[1] for pair, s in won.items()})
        left -= set(won)
        trial += 1
    return out


def test_surrogates_brute_force(spark):
    """Whole texts, names of few syllables (many collide), numbers of which most are in use."""
    names = ["Li", "Bo", "An", "Jo", "Ed", "Al"]
    texts = [f"Mr {a}{b} {b}{a.lower()} met Frau {b}{b.lower()} and Dr {a}{a.lower()}, {i % 10}{i % 7}{i % 3}-{i:04d}; {b}{a.lower()} left"
             for i, (a, b) in enumerate((a, b) for a in names for b in names)]
    texts += ["г-н Иван Петров", "Herr 田中 太郎 und Frau أحمد", "nothing here", None, "a@b.org and A@B.ORG"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = brute_map({(k, e) for t in texts if t for _, _, k, e in P.mentions(t)}, b"key")
    got = {r.doc_id: r for r in P.pii_surrogate(df, b"key").collect()}
    for i, t in enumerate(texts):
        new, found = (t, []) if t is None else P.rewrite(t, table)
        assert (got[i].text, [e.asDict() for e in got[i].entities]) == (new, found)
    assert re.search("[\u4e00-\u9fff]{2} [\u4e00-\u9fff]{2} und Frau [\u0600-\u06ff]{4}$", got[37].text)
    assert "田中" not in got[37].text and len(set(table.values())) == len(table)


def test_full_formats_are_widened(spark):
    rows = [("phone", f"{i:02d}") for i in range(5, 100)] + [("ssn", "123456789"), ("surname", "a"), ("given_M", "a")]
    df = spark.createDataFrame(rows, "type string, entity string")
    got = {(r.type, r.entity): r.surrogate for r in P.surrogate_map(df, b"k", P.Scratch(spark, "wide")).collect()}
    assert got == brute_map(set(rows), b"k") and len(got) == len(set(got.values())) == len(rows)
    assert not {e for _, e in rows} & set(got.values())
    assert P.render("phone", "1-2", "345") == "3-45"


def test_surrogates_leave_nothing_behind(spark, sf):
    old = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    new = {r.doc_id: r for r in QUERIES["op1_pii_surrogate"](spark, sf).collect()}
    seen = {t[a:e].casefold() for t in old.values() for a, e, _, _ in P.mentions(t)}
    assert seen
    for d, r in new.items():
        n = len(list(P.mentions(old[d])))
        assert r.n_entities == n and (n or r.text == old[d])
        assert not any(s in r.text.casefold() for s in seen)


PLANTED = [
    ("Mr John Smith arrived. Smith left; later John Smith's SMITH & Sons", ["John", "Smith", "SMITH"]),
    ("Dr Anna Weber and Prof. Karl Huber; Herr Prof. Dr. Otto Maier. Then Maier, Anna, Huber",
     ["Anna", "Weber", "Karl", "Huber", "Otto", "Maier"]),
    ("Frau 王小明", ["王小明"]), ("Frau 王小明 in 12 rooms", ["王小明"]), ("señor Doña Éva and Éva", ["Éva"]),
    ("call +49 30 12345678 now", ["30 12345678"]), ("call +33 1 23 45 67 89 now", ["23 45", "67 89"]),
    ("call 555-1234 now", ["555-1234"]), ("call (030) 1234567 or 030 12345678", ["1234567", "12345678"]),
    ("call 01 23 45 67 89", ["23 45 67 89"]), ("call ٥٥٥-١٢٣٤ now", ["٥٥٥-١٢٣٤"]),
    ("host 2001:0db8:85a3::8a2e:0370:7334, fe80::1.", ["8a2e", "fe80"]), ("host ::ffff:10.0.0.1", ["10.0.0.1"]),
    ("host dead:beef:dead:beef:dead:beef:dead:beef", ["beef"]), ("at 1:2:3:4::5:6:7:8", ["5:6:7:8"]),
    ("API_KEY = abcdefghijklmnop", ["abcdefghijklmnop"]),
]


def test_planted_entities_go(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PLANTED)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.pii_surrogate(df, b"k").collect()}
    for i, (text, private) in enumerate(PLANTED):
        assert not [x for x in private if x in got[i].text], (text, got[i].text)
    new = got[0].text
    first, last = re.fullmatch(r"Mr (\w+) (\w+) arrived\..*", new).groups()
    assert new == f"Mr {first} {last} arrived. {last} left; later {first} {last}'s {last.upper()} & Sons"
    assert got[2].text.split()[1] == got[3].text.split()[1]
    part = [new[e.start:e.end] for e in got[0].entities]
    assert part == [first, last, last, first, last, last.upper()]


def test_what_is_no_entity_stays():
    text = "On 2024-01-15 at 12:30:45, 01/2024, std::vector, a::b, 00:1a:2b:3c:4d:5e, 1.234-5678; smith and Smith"
    assert list(P.mentions(text)) == []
    assert list(P.mentions("the token is authentication, I saw J. in 2001-2002")) == []
    assert [text[a:e] for text in ["in 2001-2002 555-0000"] for a, e, _, _ in P.mentions(text)] == ["555-0000"]


def test_parts_of_names_keep_their_form():
    text = "Mr J. von Braun met Frau D’Alice O'Brien; J. von Braun, J. Braun, O’Brien. J."
    table = {(k, e): P.draw(b"k", k, e, 0) for _, _, k, e in P.mentions(text)}
    new, found = P.rewrite(text, table)
    name = r"[A-Z][a-z]+"
    got = re.fullmatch(rf"Mr ({name})\. von ({name}) met Frau ([A-Z]’{name}a) ([A-Z]'{name}); \1\. von \2, \1\. \2, (\S+)\. J\.", new)
    assert got and got.group(5) == got.group(4).replace("'", "’") and len(got.group(1)) == 2
    assert [f["type"] for f in found][:4] == ["initial", "surname", "given_F", "surname"]


# --------------------------------------------------------------------- pieces

@pytest.fixture(scope="module")
def vocabulary():
    return N.Pieces(N.MODEL)


def brute_paths(v, text):
    w, out = N.SPACE + text.replace(" ", N.SPACE), []

    def walk(i, ids, score):
        if i == len(w):
            out.append((score, ids))
            return
        for j in range(i + 1, len(w) + 1):
            e = v.table.get(w[i:j])
            if e:
                walk(j, ids + [e[0]], score + e[1])
            elif j == i + 1:
                walk(j, ids + [v.byte_id[b] for b in w[i].encode()], score + v.fallback)

    walk(0, [], 0.0)
    return sorted(out, key=lambda x: -x[0])


def test_n_best_brute_force(vocabulary):
    v, rnd = vocabulary, random.Random(3)
    parts = ["the", "a", " ", "  ", "in", "\n", "é", "日", "🙂", ",", ".", "er", "x"]
    for n_best in (1, 2, 4, 7):
        for _ in range(60):
            s = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6)))
            want = brute_paths(v, s)
            n, score, ids, others, same = N.encode_texts(v, [s], n_best)[0]
            assert [score, *[o["score"] for o in others]] == [x[0] for x in want[:n_best]] and same
            paths = [ids, *[N.splice(ids, o["edits"]) for o in others]]
            known = {np.array(x[1], "<i4").tobytes(): x[0] for x in want}
            assert len(set(paths)) == len(paths) and known[ids] == score
            assert all(known[p] == o["score"] for p, o in zip(paths[1:], others))
            assert all(v.decode(np.frombuffer(p, "<i4")).decode() == s for p in paths)


def test_chunks_side_by_side_equal_one_by_one():
    rnd = random.Random(4)
    parts = ["the", "er", "in", "a", "x", "é", "日", "ing", "▁", "▁▁", "Q", "1"]
    chunks = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(400)})
    one, side = N.Pieces(N.MODEL), N.Pieces(N.MODEL)
    for c in chunks:
        one.learn(c)
    side.learn_all(chunks)
    for c in chunks:
        a, b = one.known[c], side.known[c]
        assert [x[a] for x in (one.score, one.loss, one.n, one.best)] == [x[b] for x in (side.score, side.loss, side.n, side.best)]


def test_pieces_round_trip(spark, odd, no_docs, clash):
    out = N.sp_decode(N.sp_encode(odd)).collect()
    assert len(out) == odd.count()
    assert all(r.decoded == (r.text or "") and r.round_trip and r.n_pieces * 4 == len(r.ids) for r in out)
    assert N.sp_encode(no_docs).collect() == []
    assert set(clash.columns) <= set(N.sp_encode(clash).columns)


# ------------------------------------------------------------------------ mix

def test_flight_keeps_both_totals():
    rng = np.random.Generator(np.random.PCG64(2))
    size = rng.integers(1, 500, 400).astype(float)
    p = np.full(400, 0.3)
    left = fly(size, p, rng.random(403))
    assert len(left) <= 2
    assert abs(p.sum() - 120) < 1e-6 and abs((p * size).sum() - 0.3 * size.sum()) < 1e-3


def targets(sizes):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, total, free = {}, float(sum(sizes.values())), set(names)
    while free:
        unit = total / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit >= 3 * sizes[s]]
        if not over:
            out |= {s: weight[s] * unit for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            total -= out[s]
            free.discard(s)
    return out


def test_mix_targets_and_rerun(spark):
    rows = [(i, ["b", "a", None, "é", "Z"][i % 5] if i % 7 else "tiny", (i * 37) % 200) for i in range(3000)]
    rows += [(None, "none", 0), (5000, "one", 50), (5000, "one", 50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = cube_mix(df, block=300).toPandas()
    again = cube_mix(df.repartition(7), block=300).toPandas()
    key = lambda d: sorted(zip(d.doc_id.astype(str), d.source.astype(str), d["size"], d.copies))
    assert key(got) == key(again) and len(got) == len(rows) and got.copies.between(0, 3).all()
    got["source"] = got.source.where(got.source.notna(), None)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = targets(sizes)
    for s, g in got.groupby(got.source.map(lambda x: x or "\0")):
        s = None if s == "\0" else s
        assert abs(g.target.iloc[0] - want[s]) < 1e-6 and g.source_size.iloc[0] == sizes[s]
        if len(g) > 50:
            assert abs((g["size"] * g.copies).sum() - want[s]) <= 0.01 * want[s] + 5


def plain_mix(docs):
    """The mix in plain Python: targets by the rules, one walk a source with its draws, all landings tried."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted({s for s, _, _ in docs.values()}))}
    words = {s: sum(n for t, n, _ in docs.values() if t == s) for s in weights}
    target, open_ = {}, set(weights)
    while True:
        unit = (sum(words.values()) - sum(target.values())) / max(1, sum(weights[s] for s in open_))
        full = {s for s in open_ if unit * weights[s] >= 3 * words[s]}
        if not full:
            break
        target |= {s: 3 * words[s] for s in full}
        open_ -= full
    target |= {s: unit * weights[s] for s in open_}
    copies = {}
    for s in weights:
        ids = sorted((d for d in docs if docs[d][0] == s), key=lambda d: (-docs[d][1], docs[d][2]))
        ratio = target[s] / words[s]
        whole = int(ratio + 1e-9)
        p = {d: ratio - whole for d in ids}
        draws = iter(np.random.Generator(np.random.PCG64(zlib.crc32(f"{s}|0|0".encode()))).random(len(ids) + 3))
        wait = [] if max(0, ratio - whole) < 1e-9 else [ids[i] for i in sorted({int(x) for x in np.linspace(0, len(ids) - 1, 12)})]
        trio = []
        for d in [d for d in ids if d not in wait]:
            if 1e-9 < p[d] < 1 - 1e-9:
                trio.append(d)
            if len(trio) < 3:
                continue
            u = np.cross([docs[x][1] for x in trio], [1, 1, 1]).astype(float)  # both totals stay
            u = u if u.any() else np.array([1.0, -1.0, 0.0])
            far = [min(((1 - p[x]) if v * way > 0 else p[x]) / abs(v) for x, v in zip(trio, u) if v) for way in (1, -1)]
            step = far[0] if next(draws) * sum(far) < far[1] else -far[1]
            for x, v in zip(trio, u):
                p[x] += step * v
            trio = [x for x in trio if 1e-9 < p[x] < 1 - 1e-9]
        trio += wait

        def miss(bits):
            move = [b - p[x] for b, x in zip(bits, trio)]
            return abs(sum(m * docs[x][1] for m, x in zip(move, trio))) + abs(sum(move))

        best = min((miss([k >> i & 1 for i in range(len(trio))]) for k in range(1 << len(trio))), default=0)
        copies[s] = ({d: whole + round(p[d]) for d in ids if d not in trio}, best, trio, whole, target[s])
    return copies


def test_mix_equals_a_plain_walk(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aaaaabbcdef"), rng.choice([7, 40, rng.randint(1, 900)])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    order = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64(F.struct("doc_id", "source", "size")).alias("h")).collect()}
    docs = {i: (s, n, order[i]) for i, s, n in rows}
    got = {r.doc_id: r for r in cube_mix(df.repartition(5)).collect()}
    for s, (walked, best, trio, whole, target) in plain_mix(docs).items():
        assert {d: got[d].copies for d in walked} == walked
        assert all(abs(got[d].target - target) < 1e-6 for d in walked)
        taken = sum(got[d].copies * docs[d][1] for d in docs if docs[d][0] == s)
        assert abs(taken - target) <= best + 1e-3 and all(got[d].copies - whole in (0, 1) for d in trio)


def test_mix_order_parts_equal_rows(spark):
    df = spark.range(2000).select(F.struct(F.lit("same").alias("x")).alias("row"), F.col("id").alias("k"))
    df = df.unionByName(spark.range(5).select(F.struct(F.col("id").cast("string").alias("x")).alias("row"), "id")
                        .withColumnRenamed("id", "k"))
    got = []
    for n in (1, 4):
        scratch = Scratch(spark, "order")
        rows = scratch.put(df.repartition(n, "k").select("row", F.monotonically_increasing_id().alias("no")))
        got.append(sorted((r.row.x, r.order) for r in ordered(rows, scratch).collect()))
    assert len(set(got[0])) == 2005 and got[0] == got[1]


def test_mix_empty_and_clashing_columns(spark, no_docs, clash):
    assert cube_mix(no_docs.select("doc_id", "source", F.lit(1).alias("size"))).collect() == []
    got = cube_mix(clash.withColumn("size", F.coalesce(F.length("text"), F.lit(0))))
    assert set(got.columns) == set(clash.columns) and got.count() == clash.count()


def test_rotation_in_pieces(spark):
    """Repeated and null turn numbers, and rows without a conversation, come in pieces; nothing is lost."""
    rows = [(None, None, f"u{i % 3}", f"text {i:04d}") for i in range(50)]
    rows += [(1, 3, "ann", f"same turn {i:03d}") for i in range(23)] + [(1, 3, "bob", "same turn 000")] * 9
    rows += [(1, i, "ann" if i % 2 else "system", f"turn {i}") for i in range(40)] + [(2, 0, "ann", "hi"), (2, 1, "bob", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.selectExpr("*", "1 AS part", "2 AS piece", "'x' AS salt", "0 AS no")
    out = chat_rotation(df, part=8).collect()
    assert max(r.n_turns for r in out) <= 8
    by = {}
    for r in sorted(out, key=lambda r: (r.part is None, r.part or 0, r.piece)):
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(by) == {(None, "u0"), (None, "u1"), (None, "u2"), (1, "ann"), (1, "bob"), (2, "ann"), (2, "bob")}
    for (conv, who), parts in by.items():
        turns = sorted(((t is None, t or 0, role, text or "") for c, t, role, text in rows if c == conv))
        want = "".join("<|im_start|>" + ("system" if r == "system" else "assistant" if r == who else f"user name={r}")
                       + f"\n{x}<|im_end|>\n" for _, _, r, x in turns)
        assert "".join(p.text for p in parts) == want
        assert [p.start for p in parts] == [sum(len(q.text) for q in parts[:i]) for i in range(len(parts))]
        said = "".join(p.text[m["start"]:m["end"]] for p in parts for m in p["mask"])
        assert said == "".join(x + "<|im_end|>" for _, _, r, x in turns if r == who)
    assert chat_rotation(df.limit(0)).collect() == []
