import io
import zipfile

from docweave.sinks import export
from docweave.sources import files, parsers
from docweave.streaming import landing

MARKDOWN = """---
title: Guide
release: 9.0
---
# Guide

Intro text
over two lines.

## Steps

1. first
2. second

```sh
# not a heading
```

| a | b |
|---|---|
| 1 | x\\|y |

Setext
------
> quoted
"""


def kinds(parsed):
    return [(u.kind, u.text.split("\n")[0], u.heading_path) for u in parsed.units]


def test_markdown():
    p = parsers.parse_markdown(MARKDOWN)
    assert p.meta == {"title": "Guide", "release": "9.0"} and p.title == "Guide"
    assert kinds(p) == [
        ("heading", "Guide", ["Guide"]), ("paragraph", "Intro text", ["Guide"]), ("heading", "Steps", ["Guide", "Steps"]), ("list", "1. first", ["Guide", "Steps"]),
        ("code", "# not a heading", ["Guide", "Steps"]), ("table", "| a | b |", ["Guide", "Steps"]), ("heading", "Setext", ["Guide", "Setext"]), ("paragraph", "quoted", ["Guide", "Setext"]),
    ]
    assert parsers.front_matter("---\n- a\n---\nx") == ({}, "---\n- a\n---\nx") and parsers.front_matter("---\na: [\n---\n")[0] == {} and parsers.front_matter("x\n---\na: b\n---\n")[0] == {}


def test_html():
    html = """<html><head><title>T</title><meta name="author" content="Ann"><script type="application/ld+json">{"datePublished": "2024-01-02", "@type": "Article"}</script></head>
    <body><nav>menu</nav><article><h1>Head</h1><p>One &amp; two</p><ul><li>a</li><li>b</li></ul><table><tr><th>k</th><th>v</th></tr><tr><td>1</td></tr></table><pre>x = 1</pre></article><footer>f</footer></body></html>"""
    p = parsers.parse_html(html)
    assert kinds(p) == [("heading", "Head", ["Head"]), ("paragraph", "One & two", ["Head"]), ("list", "- a", ["Head"]), ("table", "| k | v |", ["Head"]), ("code", "x = 1", ["Head"])]
    assert p.units[3].text.endswith("| 1 |  |") and p.meta["author"] == "Ann" and p.meta["datePublished"] == "2024-01-02"


def test_openapi():
    p = parsers.parse_openapi("""
openapi: 3.0.0
info: {title: Pets, description: About pets}
paths:
  /pets/{id}:
    parameters: [{$ref: '#/components/parameters/Id'}]
    get: {tags: [pets], summary: One pet, responses: {200: {description: yes}, 404: {$ref: '#/components/responses/None'}}}
components:
  parameters: {Id: {name: id, in: path, required: true, schema: {type: string}}}
  responses: {None: {description: no pet}}
  schemas: {Pet: {type: object, required: [name], properties: {name: {type: string}, tags: {type: array, items: {$ref: '#/components/schemas/Tag'}}}}}
""")
    text = "\n".join(u.text for u in p.units)
    assert "| id | path | string | yes |  |" in text and "| 200 | yes |" in text and "| 404 | no pet |" in text and "| tags | Tag[] | no |  |" in text
    assert ["Pets", "pets", "GET /pets/{id}"] in [u.heading_path for u in p.units]


def docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    par = lambda t, s="": f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>" if s else ""}<w:r><w:t>{t}</w:t></w:r></w:p>'
    body = par("Title", "Heading1") + par("text") + par("one", "ListBullet") + par("two", "ListBullet") + f"<w:tbl><w:tr><w:tc>{par('c')}</w:tc></w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def test_docx():
    assert [(u.kind, u.text) for u in parsers.parse_docx(docx()).units] == [("heading", "Title"), ("paragraph", "text"), ("list", "- one\n- two"), ("table", "| c |\n| --- |")]


def test_discovery_and_offsets(spark, tmp_path):
    (tmp_path / "_a").mkdir()
    (tmp_path / ".hid").mkdir()
    for name, text in (("_a/x.md", "# H\n\npar"), (".hid/y.txt", "one\n\ntwo"), (".no.txt", "never"), ("z.bin", None), ("b.docx", docx())):
        (tmp_path / name).write_bytes(text if isinstance(text, bytes) else b"\xff\xfe" if text is None else text.encode())
    found = files.read_files(spark, [str(tmp_path)]).collect()
    assert sorted((r.path.rsplit("/", 1)[-1], r.top, r.error is None) for r in found) == [("b.docx", "", True), ("x.md", "_a", True), ("y.txt", ".hid", True), ("z.bin", "", False)]
    u = {(r.text): (r.char_start, r.char_end) for r in files.units(files.read_files(spark, [str(tmp_path / ".hid")])).collect()}
    assert u == {"one": (0, 3), "two": (5, 8)}


def test_records(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"id": "a", "n": 1}\nnot json\n{"id": "b"}\n')
    from pyspark.sql.types import LongType, StringType, StructType

    got = files.read_records(spark, str(tmp_path / "r.jsonl"), StructType().add("id", StringType()).add("n", LongType()))
    assert sorted((r.id, r.n) for r in got.collect()) == [("a", 1), ("b", None)]


def test_export_publish_and_digests(spark, tmp_path):
    df = spark.createDataFrame([("qa", "train", "1", "{}"), ("qa", "cross_split", "2", "{}"), ("qa", None, "3", "{}")], "template string, split string, example_id string, payload string")
    export.export_examples(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out" / "template=qa").iterdir()) == ["split=train", "split=unassigned"]
    for n in (1, 2):
        export.publish(spark, {"t": spark.range(n)}, str(tmp_path / "served"))
    assert spark.read.parquet(str(tmp_path / "served/t")).count() == 2 and spark.read.parquet(str(tmp_path / "served/t_prev")).count() == 1
    a = export.state_digest(df).first()
    assert a == export.state_digest(df.orderBy("example_id", ascending=False)).first() and a.n == 3


def test_landing_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("hello")
    (tmp_path / "in/b.txt").write_text("hello")
    seen = []
    for _ in range(2):
        landing.watch(spark, str(tmp_path / "in"), str(tmp_path / "cp"), lambda df, n: seen.extend(r.units[0].text for r in df.collect())).awaitTermination(60)
    assert seen == ["hello"]


def test_html_rules_and_stated_dates():
    html = """<html><head><meta name="date" content="2020-01-01"><script type="application/ld+json">{"@graph": [{"@type": "x", "dateModified": "2024-05-06", "name": "N"}, {"name": "other"}]}</script></head>
    <body><p>before</p><div role="main" class="a b"><p class="note">go</p><p>stay</p><p>see <img alt="no"> this</p><ul><li>x</ul></div><p>after</p></body></html>"""
    p = parsers.parse_html(html, parsers.HtmlRules(strip=("p.note",)))
    assert [u.text for u in p.units] == ["stay", "see this", "- x"]
    assert p.meta == {"dateModified": "2024-05-06", "name": "N"}
    assert [u.text for u in parsers.parse_html(html, parsers.HtmlRules(main=("#none",))).units][0] == "before"


def test_dispatch():
    kinds_ = {"a.md": b"x", "a.json": b'{"a": 1}', "a.yaml": b"openapi: 3.0.0", "a.raw": b" <!DOCTYPE html><p>", "a.csv": b"x", "a.bin": b"x", "a.pdf": b"", "b": b"%PDF-1"}
    assert [parsers.kind_of(n, d) for n, d in kinds_.items()] == ["markdown", None, "spec", "html", "plain", None, "pdf", "pdf"]
    assert parsers.parse_bytes("x.txt", b"a\xff\n\nb").units[1].text == "b"


def test_openapi_reads_files_beside_it_and_yaml_words_stay(spark):
    spec = "openapi: 3.0.0\ninfo: {title: yes}\npaths:\n  /a:\n    get: {responses: {200: {$ref: './shared.yaml#/ok'}}, tags: [on]}\n"
    rows = [("dir/api.yaml", spec.encode()), ("dir/shared.yaml", b"ok: {description: all is well}"), ("other/shared.yaml", b"ok: {description: wrong}")]
    got = {r.path: r for r in files.parse_contents(spark.createDataFrame(rows, "path string, content binary")).collect()}
    texts = [u.text for u in got["dir/api.yaml"].units]
    assert any("| 200 | all is well |" in t for t in texts) and texts[0] == "yes" and "on" in texts
    assert got["dir/shared.yaml"].error


def test_a_dead_run_is_not_published(spark, tmp_path):
    root = str(tmp_path / "served")
    spark.range(3).write.parquet(f"{root}/t_next")
    export.publish(spark, {"t": spark.range(99)}, root)
    assert spark.read.parquet(f"{root}/t").count() == 99
    spark.range(5).write.parquet(f"{root}/t_next")
    export.publish(spark, {"t": spark.range(5)}, root)
    assert spark.read.parquet(f"{root}/t").count() == 5


def test_datasets_and_statements(spark, tmp_path):
    df = spark.createDataFrame([("qa", "train", "1", "{}"), ("qa", "cross_split", "2", "{}"), ("qa", None, "3", "it's")], "template string, split string, example_id string, payload string")
    export.export_dataset(df, str(tmp_path / "ds"))
    assert spark.read.parquet(str(tmp_path / "ds/data")).count() == 2
    info = spark.read.json(str(tmp_path / "ds/dataset_info.json")).first()
    assert [(s.split, s.num_examples) for s in info.splits] == [("train", 1), ("unassigned", 1)] and len(info.features) == 4
    export.export_statements(df.select("example_id", "split", "payload"), str(tmp_path / "sql"), "t", 1)
    said = sorted(r.value for r in spark.read.text(str(tmp_path / "sql")).collect())
    assert said[2] == "INSERT INTO t (example_id, split, payload) VALUES ('3', NULL, 'it''s');"


def test_the_last_record_of_a_key_stays(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text("".join(f'{{"id": "k{i % 5}", "n": {i}}}\n' for i in range(1000)))
    from pyspark.sql.types import LongType, StringType, StructType

    got = files.read_records(spark, str(tmp_path / "r.jsonl"), StructType().add("id", StringType()).add("n", LongType()))
    assert sorted((r.id, r.n) for r in got.collect()) == [(f"k{i}", 995 + i) for i in range(5)]


def test_listing_by_rounds(spark, tmp_path):
    from docweave.sources.listing import contents, listed

    names = ["a/x.txt", "a/_b/y.txt", "a/_b/.no", "a/.h/z.txt", "c/deep/er/w.md", "c/v.md", "top.txt", ".hidden", "d[1].txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "empty").mkdir()
    (tmp_path / "a" / "link.txt").symlink_to(tmp_path / "top.txt")
    at = lambda *paths: {r.path.removeprefix(str(tmp_path) + "/"): (r.input, r.top) for r in listed(spark, [str(p) for p in paths]).collect()}
    assert at(tmp_path) == {"a/x.txt": (0, "a"), "a/_b/y.txt": (0, "a"), "a/.h/z.txt": (0, "a"), "c/deep/er/w.md": (0, "c"), "c/v.md": (0, "c"), "top.txt": (0, ""), "d[1].txt": (0, "")}
    assert at(tmp_path / "c", tmp_path / "a") == {"c/deep/er/w.md".replace("c/", "c/", 1): (0, "deep"), "c/v.md": (0, ""), "a/x.txt": (1, ""), "a/_b/y.txt": (1, "_b"), "a/.h/z.txt": (1, ".h"), "top.txt": (1, "")}
    assert at(tmp_path / "top.txt", tmp_path / "nothing", tmp_path / ".hidden") == {"top.txt": (0, ""), ".hidden": (2, "")}
    assert at(tmp_path / "*" / "*.md") == {"c/v.md": (0, "")} and set(at(tmp_path / "**" / "*.md")) == {"c/v.md", "c/deep/er/w.md"}
    assert at(tmp_path / "c*") == {"c/v.md": (0, ""), "c/deep/er/w.md": (0, "deep")} and at(tmp_path / "empty") == {} and at() == {}
    assert {r.path[len(str(tmp_path)) + 1 :]: bytes(r.content).decode() for r in contents(listed(spark, [str(tmp_path / "c")])).collect()} == {"c/v.md": "c/v.md", "c/deep/er/w.md": "c/deep/er/w.md"}
    assert {r.path for r in listed(spark, [f"file://{tmp_path}/c"]).collect()} == {f"file://{tmp_path}/c/v.md", f"file://{tmp_path}/c/deep/er/w.md"}


def test_versions_of_files_after_a_restart(spark, tmp_path):
    import os

    from docweave.streaming import versions

    (tmp_path / "in").mkdir()
    put = lambda name, text, at: ((tmp_path / "in" / name).write_text(text), os.utime(tmp_path / "in" / name, (at, at)))
    run = lambda: versions.follow(spark, str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(120)
    live = lambda: sorted((r.source_uri.rsplit("/", 1)[-1], r.version, bytes(r.content).decode()) for r in versions.live(spark, str(tmp_path / "out")).collect())
    put("a.txt", "one", 1000)
    put("b.txt", "bee", 1000)
    run()
    assert live() == [("a.txt", 1, "one"), ("b.txt", 1, "bee")]
    put("a.txt", "two", 2000)
    run()
    put("a.txt", "three", 3000)
    put("b.txt", "bee", 3000)  # touched, not changed
    run()
    run()  # nothing new
    assert live() == [("a.txt", 3, "three"), ("b.txt", 1, "bee")]
    assert sorted((r.source_uri.rsplit("/", 1)[-1], r.version) for r in versions.superseded(spark, str(tmp_path / "out")).collect()) == [("a.txt", 1), ("a.txt", 2)]
    # A batch that runs again replaces what it wrote.
    again = spark.createDataFrame(spark.read.parquet(f"{tmp_path}/out/batch=1").collect(), versions.VERSIONS)
    versions.commit(again, 1, str(tmp_path / "out"))
    assert live() == [("a.txt", 3, "three"), ("b.txt", 1, "bee")] and versions.began(spark, str(tmp_path / "out"), 1)


def test_publishing_what_changed_and_what_refers_to_it(spark, tmp_path):
    root = str(tmp_path / "served")
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, t string")
    chunks = spark.createDataFrame([(10, 1), (11, 2)], "chunk_id long, doc_id long")
    edges = spark.createDataFrame([("e", 10, "accepted"), ("f", 11, "review")], "edge_id string, src long, status string")
    notes = spark.createDataFrame([(1,)], "n long")
    refs = [("chunks", "documents"), ("edges", "chunks"), ("notes", "other")]
    tables = {"documents": docs, "chunks": chunks, "edges": edges, "notes": notes}
    publish = lambda t: export.publish_changed(spark, t, root, refs)
    assert publish(tables) == ["documents", "chunks", "edges", "notes"] and publish(tables) == []
    assert [r.edge_id for r in spark.read.parquet(f"{root}/edges").collect()] == ["e"]
    assert publish(tables | {"notes": notes.selectExpr("n + 1 AS n")}) == ["notes"]
    held = tables | {"notes": notes.selectExpr("n + 1 AS n")}
    assert publish(held | {"documents": docs.where("doc_id = 1")}) == ["documents", "chunks", "edges"]
    assert spark.read.parquet(f"{root}/documents").count() == 1 and spark.read.parquet(f"{root}/documents_prev").count() == 2
    assert export.with_referencing({"a"}, [("b", "a"), ("c", "b"), ("a", "c"), ("d", "x")]) == {"a", "b", "c"}


def test_statements_in_files_of_so_many_bytes(spark, tmp_path):
    rows = spark.createDataFrame([(i, "é" * (i % 40) + ("x" * 900 if i == 7 else "")) for i in range(200)], "k long, t string").coalesce(2)
    export.export_statements(rows, str(tmp_path / "out"), "t", max_bytes=600)
    files_ = list((tmp_path / "out").rglob("part-*"))
    lines = [line for f in files_ for line in f.read_text().splitlines()]
    assert len(lines) == 200 and len(set(lines)) == 200 and len(files_) > 20
    assert all(f.stat().st_size <= 600 or len(f.read_text().splitlines()) == 1 for f in files_)
