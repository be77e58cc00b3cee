"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLES: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = r"[\x20\x09-\x0D]+"

ORACLES["op1_warc_archives"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), h AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS head FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, 5 * (j // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM h
"""

def _permuted(value: str, size: str, key: str, rounds: int = 8) -> str:
    """A swap-or-not permutation as nested subqueries is too long; a list fold says the same."""
    prime = 2147483647
    powers = [pow(48271, 101 + i, prime) for i in range(3 * rounds)]
    a, b, c = (str(powers[i::3]) for i in range(3))
    mirror = f"((({key} % {prime}) + 1) * ({a})[r] - x) % {size}"
    y = f"(({mirror}) + {size}) % {size}"
    mixed = f"((greatest(x, {y}) % {prime}) * ({b})[r] + ({key} % {prime}) * ({c})[r]) % {prime}"
    bit = f"((({mixed}) * ({mixed}) + ({c})[r]) % {prime}) // 1024 % 2"
    return (
        f"list_reduce(range(1, {rounds + 1}), lambda x, r: CASE WHEN {bit} = 1 THEN {y} ELSE x END, CAST({value} AS BIGINT))"
    )


ORACLES["op7_mix"] = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
    CAST('0x' || substr(md5('23:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 1024 AS slice
  FROM documents
),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM d GROUP BY source),
u AS (SELECT *, ([3.0::DOUBLE, 1.0, 2.0])[number % 3 + 1] AS weight, CAST(2 * source_size AS DOUBLE) AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS wanted FROM t),
v AS (
  SELECT *, (wanted - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM u WINDOW before AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
x AS (
  SELECT source, source_size, number, round(least(cap, max(level) OVER () * weight), 6) AS target,
    (source_size + 63) // 64 AS blocks FROM v
),
y AS (SELECT *, least(CAST(round(target * blocks / greatest(source_size, 1)) AS BIGINT), 2 * blocks) AS slots FROM x),
k AS (SELECT number, blocks, unnest(range(slots)) AS k FROM y),
uses AS (SELECT number, {_permuted('k % blocks', 'blocks', '(number * 8 + k // blocks + 100)')} AS block FROM k),
used AS (SELECT number, block, count(*) AS n FROM uses GROUP BY ALL),
o AS (
  SELECT d.*, y.number, y.source_size, y.target,
    coalesce(sum(d.size) OVER (PARTITION BY y.number ORDER BY slice, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source
),
q AS (SELECT doc_id, size, number, start, unnest(range(CAST(start // 64 AS BIGINT), CAST((start + size - 1) // 64 + 1 AS BIGINT))) AS block FROM o WHERE size > 0),
s AS (
  SELECT doc_id, CAST(sum(n * (least(start + size, (q.block + 1) * 64) - greatest(start, q.block * 64))) AS BIGINT) AS taken
  FROM q JOIN used ON q.number = used.number AND q.block = used.block GROUP BY doc_id
)
SELECT o.doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM o LEFT JOIN s ON o.doc_id = s.doc_id
"""

ORACLES["op10_quality"] = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
c AS (
  SELECT doc_id, words, len(words) AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^!]+', '', 'g')) AS n_shouts,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines,
    len(list_filter(words, lambda x: list_contains(string_split(
      'the of and to in a is that for it on as with be was at by this are from de la le et les des un une que qui est du pas pour dans sur der die das und ist von zu den mit nicht ein eine auf sich dem für el los las y en se del por con una su para es no lo',
      ' '), x))) AS n_stop
  FROM w
),
u AS (SELECT doc_id, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM c),
g AS (
  SELECT doc_id, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM g WHERE s IS NOT NULL) WHERE k > 1),
v AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(5) t(j) GROUP BY doc_id),
m AS (
  SELECT c.*, coalesce(v.n, 0) AS n_repeat_words, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    greatest(n_words, 1) AS nw, greatest(len(lines), 1) AS nl,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09]*[-*•]'))) AS n_bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_ellipses
  FROM c LEFT JOIN v ON c.doc_id = v.doc_id
),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN word_chars / nw < 2 OR word_chars / nw > 15 THEN 'mean_word_chars' END,
      CASE WHEN n_symbols / nw > 0.1::DOUBLE THEN 'symbols_per_word' END,
      CASE WHEN n_shouts / nw > 0.2::DOUBLE THEN 'shouts_per_word' END,
      CASE WHEN n_stop / nw < 0.02::DOUBLE AND n_words >= 50 THEN 'stop_word_share' END,
      CASE WHEN n_dup_lines / nl > 0.3::DOUBLE THEN 'dup_line_share' END,
      CASE WHEN n_bullets / nl > 0.9::DOUBLE THEN 'bullet_line_share' END,
      CASE WHEN n_ellipses / nl > 0.3::DOUBLE THEN 'ellipsis_line_share' END) AS failed_rules
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM f
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text of characters up to U+00FF, bit by bit."""
    step = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    codes = (
        f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [CAST(ord(ch) AS BIGINT)] "
        "ELSE [CAST(192 + ord(ch) // 64 AS BIGINT), CAST(128 + ord(ch) % 64 AS BIGINT)] END))"
    )
    each = f"list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), {step})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {each}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


def _climb(name: str, start: str) -> str:
    """Nodes of all levels of the trees in ``start``, and what stands left and right of each in its run."""
    run = "PARTITION BY tree, level, pos // 3 ORDER BY pos ROWS BETWEEN"
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, d, n FROM {start}
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 3, n
), {name}_sides AS (
  SELECT tree, level, pos, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1
)"""


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS d,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS now
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed
), {_climb('low', 'leaves')}, groups AS (
  SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS pos, d, count(*) OVER () AS n FROM low WHERE n = 1
), {_climb('high', 'groups')}, steps AS (
  SELECT 0 AS part, * FROM low_sides UNION ALL SELECT 1, * FROM high_sides
), paths AS (
  SELECT f.doc_id, f.tree, f.pos, s.l, s.r, row_number() OVER (PARTITION BY f.tree, f.pos ORDER BY s.part, s.level) AS k
  FROM leaves f JOIN groups g ON g.name = f.tree
  JOIN steps s ON s.part = 0 AND s.tree = f.tree AND s.pos = f.pos // CAST(pow(3, s.level) AS BIGINT)
    OR s.part = 1 AND s.pos = g.pos // CAST(pow(3, s.level) AS BIGINT)
), fold AS (
  SELECT tree, pos, 0 AS k, now AS x FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, p.k, sha256(p.l || f.x || p.r) FROM fold f JOIN paths p ON p.tree = f.tree AND p.pos = f.pos AND p.k = f.k + 1
), proofs AS (SELECT tree, pos, string_agg(l || r, '' ORDER BY k) AS siblings FROM paths GROUP BY ALL),
ends AS (SELECT tree, pos, arg_max(x, k) AS x FROM fold GROUP BY ALL)
SELECT f.doc_id, f.d AS leaf, g.d AS subroot, (SELECT d FROM high WHERE n = 1) AS root,
  sha256(coalesce(p.siblings, '')) AS proof_sha256, e.x AS folded_root, e.x = (SELECT d FROM high WHERE n = 1) AS verified
FROM leaves f JOIN groups g ON g.name = f.tree JOIN ends e ON e.tree = f.tree AND e.pos = f.pos
LEFT JOIN proofs p ON p.tree = f.tree AND p.pos = f.pos
"""

ORACLES["op12_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), once AS (
  SELECT run, count(*) AS n, {_crc32("concat(doc_id, ':', run)")} AS h FROM runs GROUP BY doc_id, run
), slipped AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM once
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.rest
), best AS (
  SELECT e.word, count(*) AS n_near, arg_min(o.word, (-o.n, o.word)) AS form, max(o.n) AS form_n
  FROM near e JOIN words o ON o.word = e.other GROUP BY e.word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form,
    CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS root, form AS further FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""
