import itertools
import random

from docweave.llm import html_text as ht

ARTICLE = "<article><h1>A &amp; B</h1><p>One\n two&nbsp;three <b>bold</b>word<p>Next<br>line<ul><li>i</li><li>j</ul></article>"


def text(html):
    return ht.main_text(ht.read(html, None, {}), 0, {})


def test_blocks_references_and_broken_tags():
    assert text(f"<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><a>menu</a></nav><!-- x -->{ARTICLE}<footer>f</footer>") == "A & B\nOne two three boldword\nNext line\ni\nj"
    assert text("plain text &lt;b&gt;\n here") == "plain text <b> here"
    assert text("<p>a</b></p></div>c<div>d") == "a\nc\nd"
    assert text(None) == text("") == text("<html></html>") == text("<script>x</script>") == ""
    assert text("<p>unclosed <a href='x>y'>link</a> text <img alt='>'> rest") == "unclosed link text rest"


def test_roles_go():
    parts = ['<div class="cookie-notice">c</div>', '<aside>s</aside>', '<form><label>f</label></form>', '<div id="sidebar">x</div>', '<section class="comments"><p>reader</p></section>',
             '<div class="ad">buy</div>', '<div role="navigation">n</div>', '<p hidden>h</p>', '<header><h1>Title</h1><p>by</p></header>', "<noscript>ns</noscript>", "<button>b</button>"]
    assert text(f"<body><main>{''.join(parts)}<p>kept</p></main></body>") == "Title\nby\nkept"
    assert text(f"<body>{''.join(parts)}<p>kept</p></body>") == "kept"
    assert text('<article><div class="adventure header-image">stays</div><p>made</p></article>').endswith("made")


def page(i, body):
    return f"<html><body><div><span>Our site</span></div><div><p>Call us any time</p></div><div><div><p>{body}</p><p>second of {i}</p></div></div><div><p>All rights are ours</p></div></body></html>"


def test_nothing_else_is_dropped(spark):
    links = "<p>See <a href='x'>a long link that is most of this paragraph</a> now</p>"
    assert text(f"<body><div>{links}</div></body>") == "See a long link that is most of this paragraph now"
    assert text("<article><header><h1>T</h1><p>The standfirst</p></header><p>body</p></article>") == "T\nThe standfirst\nbody"
    assert text('<body><p class="top">first</p><div class="related-work"><p>prose</p></div></body>') == "first\nprose"
    deep = "<div>" * 3000
    assert text(f"<body>{deep}<nav>{deep}menu</nav>inner<p>last</p></body>") == "inner\nlast"
    # Beside an article: what varies over the pages of the host is read, what doesn't and link lists are not.
    many = [f"<p>par {i} {j}</p>" for j in range(40) for i in range(40)]
    rows = []
    for i in range(10):
        own = many[40 * i : 40 * i + 40]
        own.insert(i * 3, "<p>Sign up to read more of this</p>")
        rows.append((i, "http://h.example/x", f"<body><p>Best site</p><ul><li><a>next {i}</a></li></ul><article><h1>T{i}</h1>{''.join(own)}</article><p>coda {i}</p></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for r in ht.extract(pages, ["page_id"]).collect():
        lines = r.text.split("\n")
        assert lines[0] == f"T{r.page_id}" and lines[-1] == f"coda {r.page_id}" and len(lines) == 42
        assert "Sign up" not in r.text and "Best site" not in r.text and "next" not in r.text


def test_constant_slots_are_template(spark):
    rows = [(i, f"http://User@Host.example/{i}", page(i, f"story {i}"), "x") for i in range(12)]
    rows += [(20, "http://one.example/a", page(20, "alone"), "x"), (21, None, "<p>no url</p>", "x"), (22, "http://host.example/q", None, "x"), (22, "http://host.example/q", "", "x"), (23, "not a url", "<p>odd</p>", "x")]
    rows += [(30 + i, f"https://copies.example/{i}", page(0, "the same text"), "x") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(5)
    got = {}
    for r in ht.extract(pages, ["page_id", "url"]).collect():
        got.setdefault(r.page_id, r.text)
    assert all(got[i] == f"story {i}\nsecond of {i}" for i in range(12))
    assert got[20].split("\n")[2:4] == ["alone", "second of 20"]
    assert (got[21], got[22], got[23]) == ("no url", "", "odd")
    assert all("the same text" in got[30 + i] for i in range(6))


def fold(pages):
    whole = ht.skeleton(ht.parse(pages[0]))
    for html in pages[1:]:
        ht.merge(whole, ht.skeleton(ht.parse(html)))
    return whole


def test_wrappers_merge_in_any_order():
    pages = [page(i, f"t{i}") if i % 2 else page(i, f"t{i}").replace("<div><p>Call", "<section>new</section><div><p>Call") for i in range(9)]
    a, left = fold(pages), fold(pages[:4])
    ht.merge(left, fold(pages[4:]))
    assert ht.Slot.load(a.dump()).dump() == a.dump() and a.pages == left.pages == 9
    for w in (a, left, fold(pages[::-1])):
        numbers = ht.numbered(w)
        found = [ht.read(p, w, numbers) for p in pages]
        counts = {}
        for f in found:
            for key in {(b[0], b[1]) for b in f}:
                counts[key] = counts.get(key, 0) + 1
        assert all(b[0] >= 0 for f in found for b in f)
        for i, f in enumerate(found):
            assert ht.main_text(f, 9, counts) in (f"t{i}\nsecond of {i}", f"new\nt{i}\nsecond of {i}")


def tree_of(rng, depth):
    out = ht.Slot(rng.choice("ab"))
    if depth:
        out.slots = [tree_of(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return out


def best_match(a, b):
    """All order-keeping pairings, one by one."""
    if a.label != b.label:
        return 0
    best = 0
    for k in range(min(len(a.slots), len(b.slots)) + 1):
        for xs in itertools.combinations(a.slots, k):
            for ys in itertools.combinations(b.slots, k):
                best = max(best, sum(best_match(x, y) for x, y in zip(xs, ys, strict=True)))
    return 1 + best


def test_simple_tree_matching_equals_all_pairings():
    rng = random.Random(5)
    for _ in range(60):
        a, b = tree_of(rng, 3), tree_of(rng, 3)
        assert ht.match(a, b, {}) == best_match(a, b)
        weight, pairs = ht.pairing(a.slots, b.slots, {})
        assert weight == sum(ht.match(a.slots[i], b.slots[j], {}) for i, j in pairs)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)


def test_rare_slots_are_forgotten_and_common_ones_never():
    wrapper = None
    for i in range(3000):
        own = ht.skeleton(ht.parse(f"<body><div class='x{i}'><p>a</p></div>{'<section>s</section>' if i % 2 else ''}<p>b</p></body>"))
        if wrapper is None:
            wrapper = own
            continue
        ht.merge(wrapper, own)
        if wrapper.pages % 50 == 0:
            ht.clear(wrapper, 0.02)
    assert len(ht.numbered(wrapper)) < 200
    labels = [s.label for s in wrapper.slots[0].slots]
    assert "section" in labels and "p" in labels and wrapper.pages == 3000


def test_empty_table(spark):
    assert ht.extract(spark.createDataFrame([], "page_id long, url string, html string"), ["page_id"]).collect() == []
