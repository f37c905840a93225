import zlib

import numpy as np
import pytest

from docweave.llm import repair, tokens
from docweave.llm.tokens import WordEncoder, vocabulary_path


@pytest.mark.parametrize("seed", range(6))
def test_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 400, 50) if seed else np.array([0, 1, 0, 2])
    ids = rng.integers(0, 6 if seed % 2 else 300, int(sizes.sum())).astype(np.uint32)
    if seed == 3:
        ids[:] = 7
    blob = repair.compress(ids, sizes)
    shard = repair.Shard(blob)
    assert shard.ids().tolist() == ids.tolist()
    if seed % 2:
        assert len(shard.symbols) < 0.7 * len(ids) and len(shard.rules)
    ends = np.cumsum(sizes)
    for d in range(len(sizes)):
        own = ids[ends[d] - sizes[d] : ends[d]].tolist()
        assert shard.read(d).tolist() == own
        for start, count in ((0, 3), (5, 10), (len(own), 4), (max(0, len(own) - 2), 9)):
            assert shard.read(d, start, count).tolist() == own[start : start + count]
    exp = [int(x) for x in shard.lengths]
    assert exp == [len(shard.expand(np.array([shard.terminals + i], np.uint32))) for i in range(len(exp))]


def pair_counts(symbols, per_doc):
    """How often each pair comes without overlapping itself, documents apart."""
    counts, at = {}, 0
    for n in per_doc:
        doc, i, seen = symbols[at : at + n], 0, {}
        for i in range(len(doc) - 1):
            pair = (doc[i], doc[i + 1])
            if seen.get(pair, -2) < i - 1 or pair[0] != pair[1]:
                counts[pair] = counts.get(pair, 0) + 1
                seen[pair] = i
        at += n
    return counts


def one_pair_at_a_time(docs, first):
    """Re-Pair as it was published: the most frequent pair goes, until none comes twice; (symbols left, rules)."""
    rules = 0
    while True:
        counts = pair_counts([s for d in docs for s in d], [len(d) for d in docs])
        pair = max(counts, key=counts.get, default=None)
        if pair is None or counts[pair] < 2:
            return sum(map(len, docs)), rules
        out = []
        for d in docs:
            new, i = [], 0
            while i < len(d):
                hit = tuple(d[i : i + 2]) == pair
                new.append(first + rules if hit else d[i])
                i += 2 if hit else 1
            out.append(new)
        docs, rules = out, rules + 1


@pytest.mark.parametrize("seed", range(5))
def test_goes_on_until_no_pair_comes_twice_and_packs_like_the_one_pair_method(seed):
    rng = np.random.default_rng(seed)
    phrases = [rng.integers(0, 40, rng.integers(2, 30)).tolist() for _ in range(12)]
    docs = [[x for _ in range(rng.integers(1, 8)) for x in phrases[rng.integers(0, 12)]] + [1] for _ in range(40)] + [[5] * int(n) for n in rng.integers(0, 60, 5)]
    shard = repair.Shard(repair.compress(np.array([x for d in docs for x in d], np.uint32), np.array(list(map(len, docs)))))
    assert shard.ids().tolist() == [x for d in docs for x in d]
    assert max(pair_counts(shard.symbols.tolist(), shard.per_doc.tolist()).values(), default=0) < 2
    symbols, rules = one_pair_at_a_time(docs, 40)
    assert len(shard.symbols) + 2 * len(shard.rules) <= 1.15 * (symbols + 2 * rules)


ODD = ["", None, "áb café ́x", "İstanbul ΣΑΣ ς", "x<|endoftext|>y <|startoftext|> z<|startoftext|>", "don't I'LL we've. 's",
       "a\x1cb\x85c d e\tf\r\n g", "123abc 4.5,6 ... ,,. a., b.,", "ﬁ ½ ² ⁿ ª º ǆ Ǆ", "汉字 日本語 한국어", "😀👍🏽 a😀b", "ſt K Å", "A" * 500 + " " + "é" * 300 + ".", "  ", "\n\n"]


def reference(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary_path())
    return [np.array([*e.ids, 1], np.uint32).tobytes() for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_encode_as_whole_texts():
    enc = WordEncoder(vocabulary_path(), words=40)
    for _ in range(2):
        for at in range(0, len(ODD), 4):
            assert enc.encode(ODD[at : at + 4]) == reference(ODD[at : at + 4])


def test_runs_of_marks_end_where_they_end():
    data = np.frombuffer(b"a,. b" + b"%" * 40 + b" c. d" + b"!" * 16 + b"e;" + b"?" * 20, np.uint8)
    mark = tokens.IS_MARK[data]
    at = np.flatnonzero(~mark[:-1] & mark[1:]) + 1
    assert tokens._past_marks(mark, at).tolist() == [next((k for k in range(i, len(data)) if not mark[k]), len(data)) for i in at.tolist()]
    texts = ["a,. b" + "%" * 40 + " c. d" + "!" * 16 + "e;" + "?" * 20, "x" + "." * 17 + " y" + "." * 16, "..", "z."]
    assert WordEncoder(vocabulary_path()).encode(texts) == reference(texts)


def test_table_round_trip(spark):
    rows = [(i * 7 % 40, (t or "") + f" doc {i} the same words again and again" if t is not None else None, 1) for i, t in enumerate(ODD * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int").repartition(5)
    got = sorted(repair.read_shards(repair.write_shards(docs, params=repair.Grammar(shard_ids=100))).collect(), key=lambda r: r.start)
    assert len({r[0] for r in rows}) < len(rows)  # repeated ids stand by the hash of their text
    turn = {r.text: r.turn for r in docs.selectExpr("text", "xxhash64(text) AS turn").collect()}
    rows.sort(key=lambda r: (r[0], turn[r[1]]))
    ids = reference([r[1] for r in rows])
    start = 0
    assert [r.id for r in got] == [r[0] for r in rows]
    for r, raw in zip(got, ids, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(raw) // 4, zlib.crc32(raw))
        start += len(raw) // 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repair.read_shards(repair.write_shards(docs)).collect() == []
