"""SQL for the operators that SQL can express."""

from assaylake.llm.dual_tree_search import TOP
from assaylake.llm.license_scan import TEMPLATES, THRESHOLD
from assaylake.llm.line_dedup import RUN_LINES, SHORT_WORDS
from assaylake.llm.ngram_join import PERCENT, WORDS
from assaylake.llm.quality_rules import BASE, HOST_LIMIT, LEAST_STRENGTH

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def line_dedup_sql(run_lines: int = RUN_LINES, short_words: int = SHORT_WORDS) -> str:
    def of_lines(n: int) -> str:
        """Later occurrences of runs of n lines; shorter ones than run_lines need the words."""
        names = ["s", *[f"s{i}" for i in range(1, n)]]
        words = " + ".join(["words", *[f"words{i}" for i in range(1, n)]])
        where = f"{names[-1]} IS NOT NULL" + (f" AND {words} >= {short_words}" if n < run_lines else "")
        upto = f"pos{n - 1}" if n > 1 else "pos"
        nth = f"row_number() OVER (PARTITION BY {', '.join(names)} ORDER BY doc_id, pos)"
        return f"SELECT doc_id, pos, {upto} AS upto, {nth} AS nth FROM run WHERE {where}"

    later = ", ".join(f"lead({c}, {i}) OVER w AS {c}{i}" for i in range(1, run_lines) for c in ("s", "pos", "words"))
    lengths = " UNION ALL ".join(of_lines(n) for n in range(1, run_lines + 1))
    return f"""
WITH line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL
), content AS (
    SELECT doc_id, pos, trim(line, {_SPACES}) AS s, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM line WHERE trim(line, {_SPACES}) <> ''
), run AS (
    SELECT doc_id, pos, s, words, {later} FROM content WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS ({lengths}), gone AS (
    SELECT DISTINCT l.doc_id, l.pos FROM line l JOIN later r ON l.doc_id = r.doc_id AND l.pos BETWEEN r.pos AND r.upto WHERE r.nth > 1
), kept AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM line l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
    GROUP BY l.doc_id
), n AS (SELECT doc_id, count(*) AS n_lines FROM content GROUP BY doc_id),
m AS (SELECT c.doc_id, count(*) AS n_removed FROM content c JOIN gone g ON c.doc_id = g.doc_id AND c.pos = g.pos GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id"""


def license_sql() -> str:
    rows = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in TEMPLATES)
    grams = "list_distinct(list_transform(generate_series(1, len({w}) - 1), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    clean = "trim(regexp_replace(lower({t}), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'))"
    return f"""
WITH template AS (
    SELECT license_id, {grams.format(w="w")} AS grams
    FROM (SELECT license_id, string_split({clean.format(t="t")}, ' ') AS w FROM (VALUES {rows}) AS v(license_id, t))
), clean AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS c FROM documents),
unit AS (
    SELECT DISTINCT doc_id, trim(replace(u, chr(10), ' ')) AS unit FROM (
        SELECT doc_id, unnest(list_concat(string_split(c, chr(10)), string_split_regex(c, '\\n *\\n'), [c])) AS u FROM clean)
), gram AS (
    SELECT doc_id, unit, {grams.format(w="w")} AS grams FROM (SELECT doc_id, unit, string_split_regex(unit, ' +') AS w FROM unit) WHERE len(w) > 1
), scored AS (
    SELECT doc_id, unit, license_id, 2.0 * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
    FROM gram g JOIN template t ON len(g.grams) BETWEEN len(t.grams) / 4.0 AND len(t.grams) * 4.0
), best AS (
    SELECT doc_id, unit, license_id, dice, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license_id) AS nth
    FROM scored WHERE dice >= {THRESHOLD}
)
SELECT doc_id, license_id, CAST(max(dice) AS DOUBLE) AS dice, count(*) AS n_units FROM best WHERE nth = 1 GROUP BY doc_id, license_id"""


def quality_sql() -> str:
    rules = {
        "short": ("n_words < 10", "n_words < 20"),
        "repeats": ("100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words > 10 * n_words"),
        "symbols": ("100 * n_symbols > 10 * n_words", "100 * n_symbols > 5 * n_words"),
        "lines": ("100 * n_dup_lines > 10 * n_words", "100 * n_dup_lines > 5 * n_words"),
    }
    fails = ", ".join(f"CAST({test} AS INTEGER) AS f_{r}" for r, (test, _) in rules.items())
    base = " OR ".join(rules[r][0] for r in BASE)
    host = ", ".join(f"sum(f_{r}) AS s_{r}" for r in rules)
    prior = ", ".join(
        f"(sum(s_{r}) + 1.0) / (sum(n) + 2.0) AS mean_{r}, "
        f"greatest(0.0, (sum(pow(s_{r} / n, 2)) - pow(sum(s_{r} / n), 2) / count(*)) / (count(*) - 1)) "
        f"- (sum(s_{r}) + 1.0) / (sum(n) + 2.0) * (1 - (sum(s_{r}) + 1.0) / (sum(n) + 2.0)) * sum(1.0 / n) / count(*) AS beyond_{r}"
        for r in rules
    )
    strength = ", ".join(
        f"CASE WHEN hosts < 2 OR beyond_{r} <= 0 THEN average ELSE least(average, greatest({LEAST_STRENGTH}, mean_{r} * (1 - mean_{r}) / beyond_{r} - 1)) END AS k_{r}"
        for r in rules
    )
    verdicts = " OR ".join(
        f"((s_{r} + mean_{r} * k_{r}) / (n + k_{r}) > {HOST_LIMIT} AND {strict})" for r, (_, strict) in rules.items()
    )
    return f"""
WITH word AS (
    SELECT doc_id, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
), five AS (
    SELECT doc_id, i, w, lead(w) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS d, lead(w, 4) OVER o AS e
    FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, b, c, d, e) AS n FROM five WHERE e IS NOT NULL),
repeated AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM often, (VALUES (0), (1), (2), (3), (4)) AS v(j) WHERE n > 1 GROUP BY doc_id
), words AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY doc_id),
line AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos
    FROM documents
), dup AS (
    SELECT doc_id, count(*) AS n_dup_lines FROM (
        SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM line)
    WHERE nth > 1 AND trim(line, {_SPACES}) <> '' GROUP BY doc_id
), measure AS (
    SELECT d.doc_id, d.source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id LEFT JOIN dup u ON u.doc_id = d.doc_id LEFT JOIN repeated r ON r.doc_id = d.doc_id
), failed AS (SELECT *, {fails}, {base} AS base_failed FROM measure),
host AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {host} FROM failed GROUP BY source),
prior AS (SELECT count(*) AS hosts, sum(n) / count(*) AS average, {prior} FROM host),
strength AS (SELECT *, {strength} FROM prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({verdicts}) AS kept
FROM failed JOIN host USING (source) CROSS JOIN strength"""


def ngram_sql(words: int = WORDS, percent: int = PERCENT) -> str:
    rest = "".join(f" || ' ' || coalesce(lead(w, {i}) OVER o, '')" for i in range(1, words))
    return f"""
WITH RECURSIVE word AS (
    SELECT doc_id, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i, len(ws) AS n
    FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
), shingle AS (
    SELECT DISTINCT doc_id, s FROM (SELECT doc_id, i, n, w{rest} AS s FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i))
    WHERE i <= greatest(1, n - {words - 1})
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
often AS (SELECT s FROM shingle GROUP BY s HAVING count(*) > 1),
pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM (SELECT * FROM shingle SEMI JOIN often USING (s)) a
    JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
    SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)
), reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN size s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n"""


def search_sql(top: int = TOP) -> str:
    terms = (
        "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
    )
    return f"""
WITH word AS (SELECT doc_id, {terms} FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {terms} FROM benchmark)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM word SEMI JOIN wanted USING (term) GROUP BY doc_id, term),
weight AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term
), value AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // length)))) AS part
    FROM tf JOIN size USING (doc_id) JOIN weight USING (term), corpus
), scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM wanted JOIN value USING (term) GROUP BY item_id, doc_id),
placed AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {top}"""


SQL = {
    "op1_line_dedup": line_dedup_sql(),
    "op3_license_scan": license_sql(),
    "op4_quality_rules": quality_sql(),
    "op8_ngram_join": ngram_sql(),
    "op13_ranked_search": search_sql(),
}
