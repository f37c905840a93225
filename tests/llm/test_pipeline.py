import random
import re
import zlib

import corpus_pipeline as cp
import test_decontaminate
import test_packing
import test_quality
import test_similar
from docweave.llm import decontaminate, quality, simhash, suffix_dedup

WORDS = "the of and to in a is that it was for on are with as be at this have from house tree river stone cloud window paper garden letter music".split()


def test_stages_filter_and_keep(spark, tmp_path):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(WORDS) + (rng.choice("aeiou") * rng.randint(0, 3) + rng.choice("bcdfg") if rng.random() < 0.3 else "") for _ in range(n))
    passage, item = say(120), say(40)
    rows = [(i, say(200), "en", "s", 0) for i in range(60)]
    rows += [(100, rows[0][1], "en", "s", 0), (101, rows[0][1] + " ", "en", "s", 0), (102, "too short", "en", "s", 0), (103, "%%% " * 100, "en", "s", 0)]
    rows += [(110, say(100) + " " + passage + " " + say(100), "en", "s", 0), (111, say(90) + " " + passage + " " + say(120), "en", "s", 0), (112, say(100) + " " + item + " " + say(60), None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    after = docs
    gone = []
    for name, stage in cp.STAGES[:-1]:
        made = stage(spark, after, str(tmp_path))
        assert made.columns == docs.columns and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema], name
        gone.append(ids(after) - ids(made))
        after = made
    assert gone == [{102, 103}, {100, 101}, set(), {112}]
    texts = {r.doc_id: r for r in after.collect()}
    assert passage in texts[110].text and passage[50:-50] not in texts[111].text and texts[111].n_chars == len(texts[111].text)
    assert all(texts[i].text == rows[i][1] for i in range(60))
    packed = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(texts)
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "packing"]


def test_stages_take_empty_tables_and_odd_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 3, None, "s", 1)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in cp.STAGES:
            assert stage(spark, docs, str(tmp_path)).count() >= 0
    assert quality.keep_good(docs).count() == 0
    assert simhash.keep_one(docs).count() == 2
    assert suffix_dedup.remove_repeats(docs).count() == 4
    assert decontaminate.decontaminate(docs, spark.read.parquet(str(tmp_path / "benchmark.parquet"))).count() == 4


def cut_repeats(rows, window=51, least=400):
    """What the repeats stage leaves, window by window: words in passages and bytes in strings that start earlier too."""
    words = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for _, t in rows]
    seen, out = {}, []
    masks = [bytearray(len(t)) for _, t in rows]
    for n, (_, t) in enumerate(rows):  # rows are in the order of their ids
        for k in range(len(words[n]) - window + 1):
            key = tuple(t[a:b] for a, b in words[n][k : k + window])
            if seen.setdefault(key, (n, k)) != (n, k):
                a, b = words[n][k][0], words[n][k + window - 1][1]
                masks[n][a:b] = b"\1" * (b - a)
    seen = {}
    for n, (_, t) in enumerate(rows):
        for k in range(len(t) - least + 1):
            if seen.setdefault(t[k : k + least], (n, k)) != (n, k):
                masks[n][k : k + least] = b"\1" * least
    for (i, t), m in zip(rows, masks, strict=True):
        rest = bytes(x for x, gone in zip(t, m, strict=True) if not gone)
        if rest.strip():
            out.append((i, rest.decode()))
    return out


def test_whole_pipeline_equals_brute_force_stage_by_stage(spark, tmp_path):
    rng = random.Random(21)
    common = quality.COMMON_WORDS["en"]
    say = lambda n: " ".join(rng.choice(common) if rng.random() < 0.55 else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))
    passage, items = say(56), [(i, say(12)) for i in range(3)]
    rows = [(i, say(rng.randint(60, 160))) for i in range(60)]
    rows += [(100 + i, f"{say(70)} {passage} {say(60)}") for i in range(4)]
    rows += [(200 + i, f"{say(60)} {items[i][1]} {say(40)}") for i in range(3)]
    rows += [(300 + i, rows[i][1].replace(" the ", " thy ", 1)) for i in range(6)] + [(400, rows[2][1]), (401, "too short"), (402, "% # | " * 80), (403, " ".join(["one two three"] * 30)), (404, "")]
    rows.sort()
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    good = test_quality.brute([(i, t, "en") for i, t in rows], quality.Limits())
    left = [(i, t) for i, t in rows if good[i][6]]
    assert 60 < len(left) < len(rows)
    chosen = test_similar.brute_kept(left)
    near = [(i, t) for i, t in left if i in chosen]
    assert len(near) < len(left)
    cut = cut_repeats([(i, t.encode()) for i, t in near])
    assert sum(len(t) for _, t in cut) < sum(len(t) for _, t in near)
    plain = [decontaminate.normalise(t) for _, t in items]
    clean = [(i, t) for i, t in cut if not any(test_decontaminate.distance_inside(p, decontaminate.normalise(t)) <= int(0.08 * len(p)) for p in plain)]
    assert len(clean) < len(cut)

    got = cp.run(spark, sf).collect()
    ids = dict(zip([i for i, _ in clean], test_packing.reference([t for _, t in clean]), strict=True))
    assert {r.doc_id: (r.start, 4 * r.length, r.ids_crc32) for r in got} == {i: (0, len(x), zlib.crc32(x)) for i, x in ids.items()}
    assert len(got) == len(clean)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert held[-1][0] + held[-1][1] <= 4096 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:], strict=False)) and held[0][0] == 0
    assert len(places) == -(-sum(r.length for r in got) // 4096)
