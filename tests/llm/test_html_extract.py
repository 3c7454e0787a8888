import random

import numpy as np

from tessera.llm.html_extract import extract_text, page_blocks, suffix_array

SCHEMA = "page_id long, url string, html string, text string, host string"


def text(page):
    return "\n".join(t for t, zone in page_blocks(page) if zone == 0)


def test_article_without_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice"><p>We use cookies</p></div>
    <article class="post"><header><h1>Head &amp; line</h1></header><p>First <b>bold</b>
      text&nbsp;here.<br>Same block.<p>Unclosed <i>second</i>
      <div class="share-buttons">Share <div>this</div></div><aside>See also</aside><form><input><label>Name</label></form>
      <blockquote>A &lt;quote&gt; &#233; &#x1F600;</blockquote><ul><li>one<li>two</ul>
      <section id="comments"><h2>Comments</h2><article class="comment"><p>Great!</p></article></section>
      <p>Last.</p></article><div id="sidebar"><p>Popular</p></div><footer>&copy; me</footer></body></html>"""
    assert text(page) == ("Head & line\nFirst bold text here. Same block.\nUnclosed second\nA <quote> é 😀\none\ntwo\nLast.")


def test_cut_and_broken_pages():
    assert text("<article><h1>Title</h1><p>Text that en") == "Title\nText that en"
    assert text("<article><p>Fish &amp chips &am</p><p>x <a hre") == "Fish & chips &am\nx"
    assert text("<nav><a>menu<article><p>kept</p></article>") == "kept"
    assert text("") == "" and page_blocks("   ") == []
    assert text("<main><h1>A</h1><p>b</p></main><p>outside</p>") == "A\nb"
    assert text("<article><div hidden>no</div><p>a < b and c > d</p></article>") == "a < b and c > d"


def test_repeated_runs_leave_pages_without_markup(spark):
    boiler = "Welcome to our site and please read the terms of use before you go on"
    rows = [(i, f"http://www.example.org/{i}", f"<body><div>{boiler}</div><p>Story number {i} tells its own tale {i}.</p></body>", None, None)
            for i in range(6)]
    rows += [(10 + i, f"http://other{i}.example.org/", f"<body><p>{boiler}</p></body>", None, None) for i in range(5)]  # other hosts
    rows += [(20 + i, "http://copy.example.org/x", "<p>The very same story stands on five pages of one host, word for word.</p>", None, None) for i in range(5)]
    rows += [(30, None, f"<p>{boiler}</p>", None, None), (31, "http://www.example.org/", None, None, None), (32, "no url", "", None, None),
             (32, "no url", "", None, None), (None, "http://www.example.org/a", f"<article>{boiler}</article>", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = extract_text(df)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted(((r.page_id is None, r.page_id or 0), r.text) for r in out.collect())
    want = [((False, i), f"Story number {i} tells its own tale {i}.") for i in range(6)]
    want += [((False, 10 + i), boiler) for i in range(5)]
    want += [((False, 20 + i), "The very same story stands on five pages of one host, word for word.") for i in range(5)]
    want += [((False, 30), boiler), ((False, 31), ""), ((False, 32), ""), ((False, 32), ""), ((True, 0), boiler)]
    assert got == want
    assert extract_text(df.where("page_id > 99")).count() == 0


def test_repeated_runs_decide_a_table_without_article_or_main(spark):
    rows, expected = [], {}
    for i in range(2500):
        host = i % 50
        menu = " ".join(f"menu{host}x{k}" for k in range(12))
        foot = " ".join(f"foot{host}x{k}" for k in range(20))
        body = " ".join(f"body{i}x{k}" for k in range(30))
        rows.append((i, f"http://h{host}.example/{i}", f"<html><body><div>{menu}</div><p>{body}</p><div>{foot}</div></body></html>"))
        expected[i] = body
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    got = {r.page_id: r.text.strip() for r in extract_text(pages).collect()}
    assert got == expected


def test_suffix_array_sorts_like_lists_of_words():
    rng = random.Random(4)
    for depth in (1, 2, 3, 5, 8, 13):
        streams = [[rng.randrange(3) for _ in range(rng.randrange(0, 30))] for _ in range(12)]
        word = np.array([w for s in streams for w in s], np.uint64)
        row = np.repeat(np.arange(12), [len(s) for s in streams])
        suffixes = [tuple(s[i:i + depth]) for s in streams for i in range(len(s))]
        order, rank = suffix_array(word, row, depth)
        assert [suffixes[i] for i in order] == sorted(suffixes)
        distinct = sorted(set(suffixes))
        assert rank.tolist() == [distinct.index(x) for x in suffixes]


def brute(pages, min_run=8, min_pages=3):
    """Open pages without the words that repeated runs cover (one block a page)."""
    where = {}
    for i, (host, text) in enumerate(pages):
        w = text.split()
        for k in range(len(w) - min_run + 1):
            where.setdefault((host, *w[k:k + min_run]), set()).add(text)
    out = []
    for host, text in pages:
        w = text.split()
        gone = [False] * len(w)
        for k in range(len(w) - min_run + 1):
            if len(where[(host, *w[k:k + min_run])]) >= min_pages:
                gone[k:k + min_run] = [True] * min_run
        out.append(" ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_repeated_runs_match_brute_force(spark):
    rng = random.Random(9)
    shared = [[f"s{k}x{i}" for i in range(rng.randrange(6, 25))] for k in range(12)]
    pages = []
    for k in range(200):
        w = [f"own{rng.randrange(60)}" for _ in range(rng.randrange(0, 12))]
        for _ in range(rng.randrange(0, 4)):
            part = rng.choice(shared)
            cut = rng.randrange(len(part))
            w += part[cut:] if rng.random() < 0.3 else part
        pages.append((f"h{rng.randrange(3)}.example", " ".join(w)))
    pages += [pages[0]] * 5 + [("h0.example", " ".join(f"long{i % 997}" for i in range(20_000)))]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", f"<body><p>{t}</p></body>") for i, (h, t) in enumerate(pages)],
                               "page_id long, url string, html string").repartition(9)
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert [got[i] for i in range(len(pages))] == brute(pages)
