import random

from docweave.llm import chat


def test_parse_levels_and_introductions():
    text = "Hello,\nAnn wrote:\n> first line\n> second\n>> deeper text here\n> third\n\nmy answer\n> > two marks\nend"
    own, passages = chat.parse(text)
    assert own == "Hello,\n\nmy answer\nend"
    assert passages == [(1, ["first line", "second"]), (2, ["deeper text here"]), (1, ["third"]), (2, ["two marks"])]
    assert chat.parse("a > b\nc") == ("a > b\nc", [])
    assert chat.parse(None) == ("", [])


def brute(rows, params):
    parsed = [(c, t, *chat.parse(x)) for c, t, _, x in rows]
    out = []
    for c, t, own, passages in parsed:
        found = []
        for level, lines in passages:
            for h in chat.hashes("\n".join(lines), params):
                origins = [t2 for c2, t2, own2, _ in parsed if c2 == c and c is not None and t2 is not None and h in chat.hashes(own2, params)]
                if origins and t is not None and min(origins) < t:
                    found.append((-level, min(origins)))
                    break
        out.append((c, t, own, len(passages), len(found), max(found)[1] if found else None))
    reply = {(c, t): r for c, t, _, _, _, r in out}

    def root(c, t):
        while reply.get((c, t)) is not None:
            t = reply[c, t]
        return t

    return sorted(((*o, root(o[0], o[1])) for o in out), key=repr)


def test_links_equal_brute_force(spark):
    rng = random.Random(9)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    say = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 3)))
    rows = []
    for c in range(6):
        texts = []
        for t in range(14):
            text = say()
            if texts and rng.random() < 0.7:
                quoted = rng.choice(texts)
                part = quoted.split("\n")
                part = part if rng.random() < 0.5 else part[: rng.randint(1, len(part))]
                text = "Bob wrote:\n" + "\n".join("> " + p.upper() for p in part) + "\n" + text
            texts.append(text)
            rows.append((c, t, "user", text))
    rows += [(1, 3, "user", rows[17][3]), (None, 1, "user", "> alpha beta\nx"), (2, None, "user", "alpha"), (2, 99, None, None), (3, 50, "a", ""), (4, 7, "b", ">" * 50 + " deep")]
    params = chat.Linking()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, thread string").repartition(5)
    got = chat.conversations(docs).collect()
    assert sorted(((r.conv_id, r.turn, r.text, r.n_passages, r.n_linked, r.reply_to, r.thread) for r in got), key=repr) == brute(rows, params)
    assert sum(r.n_linked for r in got) > 20
    assert all(len(r.unlinked) == r.n_passages - r.n_linked for r in got)
    places = {}
    for r in got:
        places.setdefault(r.conv_id, []).append((r.position, r.thread is not None, r.thread or 0, r.turn is not None, r.turn or 0))
    for held in places.values():
        assert [p[0] for p in sorted(held)] == list(range(1, len(held) + 1)) and sorted(held) == sorted(held, key=lambda p: p[1:])
    assert all(r.chat == f"<|{r.role or 'user'}|>\n{r.text}" for r in got)


def test_what_links_to_nothing_is_kept_and_short_lines_come_last(spark):
    rows = [(1, 1, "u", "yes\nwe will meet at the old mill"), (1, 2, "u", ">>> code()\n>>> more\nso"), (1, 3, "u", "no\nyes"), (1, 4, "u", "> yes\nok"), (1, 5, "u", "> no\n> we will meet at the old mill\nfine")]
    got = {r.turn: r for r in chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[2].text, got[2].unlinked, got[2].reply_to) == ("so", ["code()\nmore"], None)
    assert (got[4].reply_to, got[5].reply_to) == (1, 1) and [got[t].position for t in (1, 4, 5, 2, 3)] == [1, 2, 3, 4, 5]


def test_empty_table(spark):
    assert chat.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
