import random

from docweave.llm import decontaminate as dc


def distance_inside(pattern, text):
    """Least edit distance of pattern to any part of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_equals_the_plain_table():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 90)))
        assert dc.myers(dc.masks(p), len(p), t)[0] == distance_inside(p, t)


def edited(rng, text, k):
    out = list(text)
    for _ in range(k):
        i = rng.randrange(len(out))
        what = rng.choice("sid")
        if what == "s":
            out[i] = rng.choice("abcdefgh ")
        elif what == "i":
            out.insert(i, rng.choice("abcdefgh"))
        elif len(out) > 2:
            del out[i]
    return "".join(out)


def test_finds_what_brute_force_finds(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.randint(8, 40))) for i in range(6)] + [(6, "short one"), (7, None), (8, "")]
    docs = []
    for i in range(60):
        body = [say(rng.randint(0, 60))]
        if i % 2:
            item = items[i % 6][1]
            body += [edited(rng, item, rng.randint(0, int(0.12 * len(item)))).upper(), "\n ", say(rng.randint(0, 30))]
        docs.append((i, " ".join(body), "x"))
    docs += [(200, "a very Short  one, whole", "x"), (201, "abshort onex", "x"), (100, None, "x"), (101, "", "x"), (None, items[0][1], "x"), (5, docs[5][1], "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.id if r.id is not None else -1), r.item, r.distance) for r in dc.matches(d, b).collect())
    want = []
    for i, t, _ in docs:
        text = dc.normalise(t)
        for j, raw in items:
            p = dc.normalise(raw)
            if len(p) >= 24 and text and (m := distance_inside(p, text)) <= int(0.08 * len(p)):
                want.append((i if i is not None else -1, j, m))
    held = {i for i, _, _ in want}
    want.append((200, 6, 0))
    assert got == sorted(want) and len(want) > 15
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(-1 if i is None else i for i, _, _ in docs if (-1 if i is None else i) not in held)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a text that is long enough to count as an item")], "item_id long, text string")
    assert dc.matches(d, b).collect() == []
    assert dc.matches(b.withColumnRenamed("item_id", "doc_id"), d.withColumnRenamed("doc_id", "item_id")).collect() == []
