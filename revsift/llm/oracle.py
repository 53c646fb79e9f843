"""DuckDB SQL for the operators whose contract SQL can express, written from the contracts alone."""

from __future__ import annotations

WORDS = r"regexp_extract_all({x}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(x=LOWER.format(x="coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
SELECT r.a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a"""

OP7 = f"""
WITH w AS (SELECT doc_id, {WORDS.format(x="coalesce(text, '')")} AS ws FROM documents),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT doc_id, i FROM k QUALIFY min(doc_id) OVER (PARTITION BY k) < doc_id),
g AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM f)),
p AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
t AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept FROM p ANTI JOIN g USING (doc_id, p) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(m.n, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM w LEFT JOIN t USING (doc_id) LEFT JOIN m USING (doc_id)"""


def _op10() -> str:
    from revsift.llm.quality_rules import COVERAGE_LIMITS, LINE_CHARS_LIMIT, LINE_LIMIT, MAX_REPEAT_PERCENT, MIN_WORDS

    def grams(n: int) -> str:
        return (f"SELECT doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') AS k FROM (SELECT doc_id, ws, "
                f"unnest(range(1, len(ws) - {n - 2})) AS i FROM w WHERE len(ws) >= {n})")
    parts, joins, tests = [], [], []
    for n, limit in COVERAGE_LIMITS.items():
        parts.append(f"""
l{n} AS (SELECT doc_id, i FROM ({grams(n)}) QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY i) > 1),
c{n} AS (SELECT doc_id, sum(length(x)) AS c FROM (SELECT DISTINCT doc_id, p FROM (
           SELECT doc_id, unnest(range(i, i + {n})) AS p FROM l{n})) JOIN p USING (doc_id, p) GROUP BY doc_id)""")
        joins.append(f"LEFT JOIN c{n} ON c{n}.doc_id = w.doc_id")
        tests.append(f"coalesce(c{n}.c, 0) > {limit!r}::DOUBLE * word_chars")
    word = r"regexp_matches(x, '[^\x20\x09-\x0D]')"
    chars = "list_sum(list_transform({ws}, lambda y: length(y)))"
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format(x="coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
r3 AS (SELECT doc_id, i FROM ({grams(3)}) QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
r AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM r3))
      GROUP BY doc_id),
lines0 AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM w),
lines1 AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id, x ORDER BY i) AS k FROM lines0 WHERE {word}),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k > 1) AS n_dup,
                 coalesce(sum({chars.format(ws=WORDS.format(x="x"))}) FILTER (WHERE k > 1), 0) AS dup_chars
          FROM lines1 GROUP BY doc_id),{",".join(parts)},
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce({chars.format(ws="ws")}, 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(lines.n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             coalesce(lines.n_lines, 0) AS n_lines, coalesce(lines.dup_chars, 0) AS dup_chars
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN lines USING (doc_id)),
v AS (SELECT w.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
             {" OR ".join(tests)} OR n_dup_lines > {LINE_LIMIT!r}::DOUBLE * n_lines
             OR dup_chars > {LINE_CHARS_LIMIT!r}::DOUBLE * word_chars AS repetitive
      FROM b w {" ".join(joins)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT repetitive AS kept FROM v"""


def _op12(heights=(6, 3)) -> str:
    """Trees of at most 16**6 leaves a source and 16**3 sources: every level is a query of its own."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(i) + 1), lambda k: ascii(i[k])::BIGINT)), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
           "lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)")

    def leaf(*values):
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || {v}, '-')" for v in values) + ")"

    def tree(name, height):
        """Levels {name}1.. (g, k, n, run, h) above a table {name}0 (g, k, n, h), and the last node of each group."""
        out = []
        for j in range(height):
            out.append(f"""{name}{j + 1} AS (SELECT g, k // 16 AS k, (n + 15) // 16 AS n, string_agg(h, '' ORDER BY k) AS run, sha256(string_agg(h, '' ORDER BY k)) AS h
      FROM {name}{j} WHERE n > 1 GROUP BY g, k // 16, n)""")
        tops = " UNION ALL ".join(f"SELECT g, h FROM {name}{j} WHERE n = 1" for j in range(height + 1))
        out.append(f"{name}top AS ({tops})")
        return ",\n".join(out)

    def walk(first, columns, steps):
        """f0, f1, ..: from each leaf up, one level a query: h is the folded hash so far, p the siblings so far."""
        out = [f"f0 AS (SELECT {columns} FROM {first})"]
        for m, (name, j, g, k) in enumerate(steps):
            slot = f"({k} // {16 ** j}) % 16"
            left, right = f"substr(run, 1, 64 * ({slot}))", f"substr(run, 64 * ({slot}) + 65)"
            out.append(f"""f{m + 1} AS (SELECT a.* EXCLUDE (h, p), CASE WHEN run IS NULL THEN a.h ELSE sha256({left} || a.h || {right}) END AS h,
      p || coalesce({left} || {right}, '') AS p
      FROM f{m} a LEFT JOIN {name}{j + 1} b ON b.g = {g} AND b.k = {k} // {16 ** (j + 1)})""")
        return ",\n".join(out)
    steps = [("t", j, "tg", "tk") for j in range(heights[0])] + [("r", j, "'all'", "rk") for j in range(heights[1])]
    return f"""
WITH d AS (SELECT *, CAST(doc_id AS VARCHAR) AS i FROM documents),
c AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM d),
l AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf("doc_id", "source", "lang", "n_chars", "text")} AS h,
             {leaf("doc_id", "source", "lang", "n_chars", "changed")} AS t FROM c),
t0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS k, count(*) OVER (PARTITION BY g) AS n FROM l),
{tree("t", heights[0])},
r0 AS (SELECT 'all' AS g, g AS source, h, row_number() OVER (ORDER BY encode(g)) - 1 AS k, count(*) OVER () AS n FROM ttop),
{tree("r", heights[1])},
{walk("t0 JOIN r0 ON r0.source = t0.g", "doc_id, t0.h AS leaf, r0.h AS subroot, r0.k AS rk, t0.g AS tg, t0.k AS tk, t0.t AS h, '' AS p", steps)}
SELECT doc_id, leaf, subroot, rtop.h AS root, sha256(p) AS proof_sha256, f.h AS folded_root, f.h = rtop.h AS verified
FROM f{sum(heights)} f, rtop"""


ORACLE = {"op3_jaccard_join": OP3, "op7_substring_dedup": OP7, "op10_quality_rules": _op10(), "op12_merkle_manifest": _op12()}
