"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

from docweave.llm.quality import COMMON_WORDS, Limits, _vocabulary

#: Windows as halves of a hexadecimal string, so that bytes can be counted; spans are gaps and islands over their starts.
SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, j * 512 AS o, h[1024 * j + 1 : 1024 * j + 1824] AS p FROM (SELECT doc_id, h, n, unnest(range(0, (n - 400) // 512 + 1)) AS j FROM d WHERE n >= 400)),
w AS (SELECT doc_id, o + i AS i, md5(p[2 * i + 1 : 2 * i + 800]) AS k FROM (SELECT doc_id, o, p, unnest(range(0, least(512, n - 399 - o))) AS i FROM b)),
hits AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marks AS (SELECT doc_id, i, coalesce(i > lag(i) OVER o + 400, true)::INT AS begins FROM hits WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM marks),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 400 AS e FROM runs GROUP BY doc_id, r),
rest AS (SELECT doc_id, s, h[2 * coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) + 1 : 2 * s] AS part, e FROM spans JOIN d USING (doc_id)),
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
pw AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 50], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 49)) AS i FROM words)),
pc AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i), 51) AS gap FROM pw WHERE k IN (SELECT k FROM pw GROUP BY k HAVING count(*) > 1)),
passages AS (SELECT doc_id, sum(least(51, gap)) AS n FROM pc GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY s) AS before, max(e) AS e, count(*) AS n_spans, sum(e - s) AS gone FROM rest GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h ELSE before || h[2 * k.e + 1 : ] END)) AS kept_sha256, coalesce(p.n, 0)::BIGINT AS n_passage_words
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN passages p USING (doc_id)
"""


def quality(limits: Limits = Limits()) -> str:
    """The quality rules from sums over the same histograms, one row per document and reference language on the way."""
    words = ", ".join("('" + w.replace("'", "''") + f"', {i})" for i, w in enumerate(_vocabulary(), 1))
    langs = ", ".join(f"'{lang}'" for lang in sorted(COMMON_WORDS))
    letters = r"a-z\x{80}-\x{10FFFF}"
    space = r"\x20\x09-\x0D"
    count = lambda p: f"length(regexp_replace(t, '[^{p}]', '', 'g'))"
    term = lambda p, q: f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)"
    classes = " + ".join(term(f"(f.c[{i}] / greatest(f.n, 1)::DOUBLE)", f"r.c[{i}]") for i in range(1, 8))
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^{space}]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS ls FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM g, (VALUES (0), (1), (2)) o(k) WHERE c > 1 GROUP BY doc_id),
f AS (SELECT doc_id, lang, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, {count('#*$%&|<>')} AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, length(t) AS n,
  [{count('A-Z')}, {count('0-9')}, {count(".,;:!?''" + chr(34) + "()" + chr(92) + "-")}, {count(r'#*$%&|<>@=+_/\\~^{}\[\]')}, length(t) - length(array_to_string(ws, '')), octet_length(encode(t)) - length(t)] AS c6 FROM w),
f7 AS (SELECT *, list_append(c6, greatest(0, n - list_sum(c6))) AS c FROM f),
v(word, k) AS (VALUES {words}),
tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(t), '[^{letters}]+')) AS word FROM d),
runs AS (SELECT doc_id, k, count(*) AS c FROM tok JOIN v USING (word) GROUP BY doc_id, k),
refs AS (SELECT lang, sum(n_words) AS words, [sum(c[1]), sum(c[2]), sum(c[3]), sum(c[4]), sum(c[5]), sum(c[6]), sum(c[7])] AS s FROM f7 WHERE lang IN ({langs}) AND n_words > 0 GROUP BY lang HAVING sum(n_words) >= {limits.reference_words}),
r AS (SELECT lang, words, list_transform(s, lambda x: x / list_sum(s)::DOUBLE) AS c FROM refs),
rk AS (SELECT r.lang, k, sum(runs.c) / any_value(r.words)::DOUBLE AS q FROM runs JOIN f7 USING (doc_id) JOIN r ON r.lang = f7.lang GROUP BY r.lang, k),
ro AS (SELECT lang, greatest(0.0, 1.0 - sum(q)) AS q FROM rk GROUP BY lang),
seen AS (SELECT doc_id, lang, sum({term('p', 'q')} - q) AS s FROM (SELECT runs.doc_id, r.lang, runs.c / greatest(f7.n_words, 1)::DOUBLE AS p, coalesce(rk.q, 0) AS q FROM runs JOIN f7 USING (doc_id), r LEFT JOIN rk ON rk.lang = r.lang AND rk.k = runs.k) GROUP BY doc_id, lang),
oth AS (SELECT f7.doc_id, 1 - coalesce(sum(runs.c), 0) / greatest(any_value(f7.n_words), 1)::DOUBLE AS p FROM f7 LEFT JOIN runs USING (doc_id) GROUP BY f7.doc_id),
dist AS (SELECT f.doc_id, r.lang, sqrt(greatest(({classes}) / 2, 0)) AS cd, sqrt(greatest((coalesce(s.s, 0) + {term('o.p', 'ro.q')} - ro.q + 1) / 2, 0)) AS wd
  FROM f7 f CROSS JOIN r JOIN ro ON ro.lang = r.lang JOIN oth o ON o.doc_id = f.doc_id LEFT JOIN seen s ON s.doc_id = f.doc_id AND s.lang = r.lang),
near AS (SELECT doc_id, min(cd) AS cd, min(wd) AS wd, bool_or(cd <= {limits.class_floor} + {limits.class_allowance} / sqrt(greatest(n_words, 1)) AND (n_words < {limits.min_words_for_histogram} OR wd <= {limits.word_floor} + {limits.word_allowance} / sqrt(greatest(n_words, 1)))) AS ok
  FROM dist JOIN f7 USING (doc_id) GROUP BY doc_id),
base AS (SELECT f7.*, coalesce(n_repeat, 0) AS n_repeat, n_words < {limits.min_words} OR 100 * coalesce(n_repeat, 0) > 50 * n_words AS failed FROM f7 LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words, failed AS base_failed,
       NOT failed AND (coalesce(ok, false) OR (lang IS NOT NULL AND lang NOT IN (SELECT lang FROM refs))) AS kept, round(cd, 6) AS class_distance, round(wd, 6) AS word_distance
FROM base LEFT JOIN near USING (doc_id)
"""


def ball_kmeans(k: int = 40, size: int = 64, scale: int = 256, rounds: int = 5, salt: str = "2:") -> str:
    """Lloyd's rounds written out: every vector against every centroid, sums of each component by cluster."""
    steps = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS q FROM embeddings WHERE len(embedding) = {size}"
        f" AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})",
        f"c0 AS (SELECT (row_number() OVER (ORDER BY h, q) - 1)::INT AS cluster, q AS c FROM (SELECT q, sha256('{salt}' || vec_id::VARCHAR) AS h FROM v ORDER BY h, q LIMIT {k}))",
    ]
    square = "list_sum(list_transform(list_zip(v.q, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        steps.append(f"a{r} AS (SELECT vec_id, q, min(struct_pack(d := d, cluster := cluster)) AS best FROM (SELECT v.vec_id, v.q, c.cluster, {square} AS d FROM v, c{r} c) GROUP BY vec_id, q)")
        if r < rounds:
            steps.append(
                f"m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n) ORDER BY i) AS c FROM (SELECT best.cluster AS cluster, i, sum(q[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{r}, range(1, {size + 1}) t(i) GROUP BY 1, 2) GROUP BY cluster)")
            steps.append(f"c{r + 1} AS (SELECT cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (cluster))")
    return f"""
WITH {", ".join(f"{s.split(' AS ', 1)[0]} AS MATERIALIZED {s.split(' AS ', 1)[1]}" for s in steps)}
SELECT vec_id, best.cluster AS cluster, best.d::BIGINT AS distance, (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.cluster = best.cluster
"""
