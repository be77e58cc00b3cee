"""SQL counterparts of the named queries, for a second engine (DuckDB).

Written from the definitions, not from the Spark plans: whole tables, window
functions and list functions where the library uses other means.
"""

from __future__ import annotations

from tableworks.functions.text import BLANK, PUNCTUATION, STOP_WORDS, WHITESPACE, WORD
from tableworks.plans.queries import EPOCHS, GRID_RULES, TAG_EPOCHS
from tableworks.plans.views import (
    CLAIM_CATEGORIES,
    CLAIM_CUT,
    CLAIM_FIELDS,
    CLAIM_MEASURES,
    NUMERIC_FEATURES,
)
from tableworks.operators.tagger import TAGS

ORACLES: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _with(*parts: tuple[str, str] | list) -> str:
    flat = []
    for p in parts:
        flat.extend(p if isinstance(p, list) else [p])
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in flat) + "\n"


def bucket(key: str, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || cast({key} AS varchar)), 1, 8))::bigint"


ROW_KEY = (
    "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "cast(round(l_extendedprice * 100) AS bigint))"
)

# Views -------------------------------------------------------------------------

LOG = ("log", """
SELECT 'u' || user_id || '.example.org' AS host,
       date_trunc('second', ts) AS ts,
       '/' || event_type || '/' || (user_id % 20)
         || CASE WHEN event_type IN ('view', 'click') THEN '.gif' ELSE '.html' END AS path,
       cast(CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS integer) AS status,
       CASE WHEN event_type <> 'error' THEN cast(round(value * 100) AS bigint) END AS bytes
FROM events WHERE value >= 0.5""")

NUMERIC = ("num", f"""
SELECT {ROW_KEY} AS row_key, cast(l_returnflag = 'R' AS double) AS label, l_quantity AS quantity,
       l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
       cast(l_linenumber AS double) AS line, cast(l_quantity > 25 AS double) AS prediction
FROM lineitem""")

CLAIMS = ("claims", f"""
SELECT {ROW_KEY} AS row_key, cast(year(o_orderdate) AS varchar) AS year, p_brand AS brand,
       nullif(p_type, 'PROMO') AS type, o_orderpriority AS priority, l_linestatus AS linestatus,
       l_quantity AS quantity, l_extendedprice AS price, p_retailprice AS retail,
       cast(p_size AS double) AS part_size,
       CASE WHEN l_quantity >= 30 AND l_discount >= 0.09
            THEN l_extendedprice * l_discount ELSE 0.0 END AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")

SCORES = """
SELECT l_partkey AS item, l_suppkey AS tag_id, avg(l_discount * l_quantity) AS relevance
FROM lineitem GROUP BY ALL"""

ASSIGN = ("assign", "SELECT p_partkey AS item, p_size AS cluster FROM part")

RULE = ("rule", "SELECT row_key, price AS label, quantity * 1500 AS prediction FROM num")


def _lines(source: str, id: str, extra: str = "") -> str:
    return f"""
SELECT {id}{extra}, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line
FROM (SELECT {id}{extra}, regexp_split_to_array(text, '\\r\\n|[\\r\\n]') AS ls FROM {source})"""


def _split(text: str) -> str:
    return f"[t FOR t IN regexp_split_to_array({text}, '{WHITESPACE}') IF t <> '']"


def _bare(text: str) -> str:
    return f"regexp_replace({text}, {_quoted(PUNCTUATION)}, '', 'g')"


SENTENCES = [
    ("doc_lines", _lines("documents", "doc_id")),
    ("sents", f"""
SELECT doc_id || ':' || line_no AS sent_id, {_split(_bare('lower(line)'))} AS tokens
FROM doc_lines"""),
]


def _grams(source: str, keep: str, items: str, n: int) -> str:
    """Rows of g1 … gn from a list column."""
    cols = ", ".join(f"items[i + {j}] AS g{j + 1}" for j in range(n))
    return f"""
SELECT {keep}{cols}
FROM (SELECT *, unnest(range(1, len(items) - {n} + 2)) AS i
      FROM (SELECT {keep}{items} AS items FROM {source}))"""


def _joined(n: int) -> str:
    return " || ' ' || ".join(f"g{j + 1}" for j in range(n))


MARKED = "list_concat(['<s>'], tokens, ['</s>'])"
BIGRAMS = ("bigrams", _grams("sents", "", MARKED, 2))
BIGRAM_COUNTS = ("bcounts", "SELECT g1, g2, count(*) AS n FROM bigrams GROUP BY ALL")

QUESTIONS = [
    ("bench_lines", _lines("benchmark", "item_id", ", text")),
    ("bench_tokens", f"""
SELECT item_id || ':' || line_no AS q_id, {_split('lower(line)')} AS toks, {_split('lower(text)')} AS item FROM bench_lines"""),
    ("blanks", """
SELECT *, least(3, len(toks)) AS spot, toks[least(3, len(toks))] AS word FROM bench_tokens WHERE len(toks) >= 1"""),
    ("asked", """
SELECT q_id, cand_no, toks, spot, CASE cand_no WHEN 1 THEN word ELSE coalesce(
  [t FOR t IN list_concat(toks[6:6], toks, item) IF t <> word][1], CASE word WHEN 'the' THEN 'of' ELSE 'the' END) END AS cand
FROM blanks, (VALUES (1), (2)) c(cand_no)"""),
    ("filled", f"""
SELECT q_id, cand_no, cand,
       [{_bare('t')} FOR t IN list_concat(toks[1:spot - 1], [cand], toks[spot + 1:])] AS toks
FROM asked"""),
    ("sentences_asked", """
SELECT q_id, cand_no, cand,
       list_concat(['<s>'], CASE WHEN toks[-1] = '' THEN toks[:-2] ELSE toks END, ['</s>']) AS tokens
FROM filled"""),
    ("qgrams", _grams("sentences_asked", "q_id, cand_no, ", "tokens", 2)),
]

ANSWERS = """
, sums AS (
  SELECT q_id, cand_no, any_value(cand) AS cand,
         CASE WHEN bool_and(p > 0) THEN sum(CASE WHEN p > 0 THEN ln(p) END) END AS score
  FROM looked GROUP BY q_id, cand_no)
, pairs AS (
  SELECT q_id, max(score) FILTER (cand_no = 1) AS s1, max(score) FILTER (cand_no = 2) AS s2,
         max(cand) FILTER (cand_no = 1) AS c1, max(cand) FILTER (cand_no = 2) AS c2
  FROM sums GROUP BY q_id)
SELECT q_id,
       CASE WHEN coalesce(round(s1, 9), '-inf'::double) > coalesce(round(s2, 9), '-inf'::double) THEN c1
            WHEN coalesce(round(s1, 9), '-inf'::double) < coalesce(round(s2, 9), '-inf'::double) THEN c2
       END AS choice, round(s1, 6) AS score_1, round(s2, 6) AS score_2
FROM pairs"""

POLARITY = [
    ("polar", f"""
SELECT d.doc_id, text, 2 * quality - 1 AS label,
       CASE WHEN {bucket('d.doc_id', 5)} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS part
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""),
    ("polar_tokens", f"SELECT doc_id, label, part, regexp_extract_all(text, '{WORD}') AS items FROM polar"),
]
STOP = ", ".join(map(_quoted, STOP_WORDS))


def _bag(source: str, orders: tuple[int, ...], keep: str = "doc_id") -> str:
    """n_order, feature, n per document; stop words leave single words only."""
    parts = []
    for n in orders:
        words = " || ' ' || ".join(f"items[i + {j}]" for j in range(n))
        stop = f"WHERE feature NOT IN ({STOP})" if n == 1 else ""
        parts.append(f"""
SELECT {keep}, {n} AS n_order, feature, count(*) AS n FROM (
  SELECT {keep}, {words} AS feature
  FROM (SELECT {keep}, items, unnest(range(1, len(items) - {n} + 2)) AS i FROM {source})) {stop}
GROUP BY ALL""")
    return "\nUNION ALL\n".join(parts)


def _perceptron(orders: tuple[int, ...], epochs: int, part: int | None = None) -> list:
    where = "" if part is None else f"WHERE part = {part}"
    ctes = [
        ("train_docs", f"SELECT doc_id, label, items FROM polar_tokens {where}"),
        ("bag", _bag("train_docs", orders)),
        ("w0", "SELECT 0 AS n_order, '' AS feature, 0::bigint AS weight WHERE false"),
    ]
    for e in range(1, epochs + 1):
        ctes += [
            (f"wrong{e}", f"""
SELECT doc_id, label FROM (
  SELECT d.doc_id, d.label, coalesce(sum(b.n * w.weight), 0) AS score
  FROM train_docs d LEFT JOIN bag b ON b.doc_id = d.doc_id
       LEFT JOIN w{e - 1} w ON w.n_order = b.n_order AND w.feature = b.feature
  GROUP BY d.doc_id, d.label)
WHERE CASE WHEN score >= 0 THEN 1 ELSE -1 END <> label"""),
            (f"w{e}", f"""
SELECT n_order, feature, cast(sum(weight) AS bigint) AS weight FROM (
  SELECT * FROM w{e - 1} UNION ALL
  SELECT b.n_order, b.feature, b.n * d.label FROM bag b JOIN wrong{e} d ON b.doc_id = d.doc_id)
GROUP BY n_order, feature HAVING sum(weight) <> 0"""),
        ]
    return ctes


TEST_BAG = [
    ("test_docs", "SELECT doc_id, label, items FROM polar_tokens WHERE part = 1"),
    ("test_bag", _bag("test_docs", (1,))),
]


def _judged(weights: str) -> str:
    return f"""
SELECT doc_id, label, cast(CASE WHEN score >= 0 THEN 1 ELSE -1 END AS integer) AS prediction FROM (
  SELECT d.doc_id, d.label, coalesce(sum(b.n * w.weight), 0) AS score
  FROM test_docs d LEFT JOIN test_bag b ON b.doc_id = d.doc_id
       LEFT JOIN {weights} w ON w.feature = b.feature
  GROUP BY d.doc_id, d.label)"""


def _binary(source: str, positive: str = "1", extra: str = "") -> str:
    tp = f"count(*) FILTER (label = {positive} AND prediction = {positive})"
    fp = f"count(*) FILTER (label <> {positive} AND prediction = {positive})"
    fn = f"count(*) FILTER (label = {positive} AND prediction <> {positive})"
    return f"""
SELECT {extra}round(avg(cast(label = prediction AS double)), 6) AS accuracy,
       round({tp} / nullif({tp} + {fp}, 0), 6) AS precision,
       round({tp} / nullif({tp} + {fn}, 0), 6) AS recall,
       round(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 6) AS f1
FROM {source}"""


TAGGED = [
    ("tag_docs", f"""
SELECT doc_id, text, CASE WHEN {bucket('doc_id', 5)} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS part
FROM documents"""),
    ("tag_lines", _lines("tag_docs", "doc_id", ", part")),
    ("tag_words", f"SELECT doc_id || ':' || line_no AS sent_id, part, {_split('line')} AS words FROM tag_lines"),
    ("tokens", r"""
SELECT sent_id, part, i - 1 AS pos, w AS word,
       CASE WHEN regexp_matches(w, '[0-9_]') THEN 'MISC'
            WHEN regexp_matches(w, '^\p{Lu}') AND length(w) >= 9 THEN 'ORG'
            WHEN regexp_matches(w, '^\p{Lu}') AND length(w) >= 5 THEN 'PER'
            WHEN regexp_matches(w, '^\p{Lu}') THEN 'LOC' ELSE 'O' END AS tag
FROM (SELECT sent_id, part, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM tag_words)"""),
    ("tag_pairs", """
SELECT sent_id, part, coalesce(lag(tag) OVER (PARTITION BY sent_id ORDER BY pos), 'None') AS prev_tag, tag
FROM tokens"""),
]


def _tagger(epochs: int, where: str = "") -> list:
    """Word weights after some epochs, as columns w0 … w4 per word."""
    n = range(len(TAGS))
    seen = ", ".join(f"count(*) FILTER (tag = '{t}') AS c{i}" for i, t in enumerate(TAGS))
    ctes = [("t0", f"SELECT word, {seen}, {', '.join(f'0::bigint AS w{i}' for i in n)} FROM tokens {where} GROUP BY word")]
    total = " + ".join(f"c{i}" for i in n)
    all_w = ", ".join(f"w{i}" for i in n)
    for e in range(1, epochs + 1):
        new = ", ".join(
            f"w{i} + c{i} - CASE WHEN best = {i + 1} AND c{i} > 0 THEN {total} ELSE 0 END AS w{i}" for i in n
        )
        ctes.append((f"t{e}", f"""
SELECT word, {', '.join(f'c{i}' for i in n)}, {new}
FROM (SELECT *, list_position([{all_w}], greatest({all_w})) AS best FROM t{e - 1})"""))
    rows = " UNION ALL ".join(f"SELECT word, '{t}' AS tag, w{i} AS weight FROM t{epochs}" for i, t in enumerate(TAGS))
    ctes.append(("tag_weights", rows))
    ctes.append(("best_tags", f"""
SELECT word, {_quoted_list(TAGS)}[list_position([{all_w}], greatest({all_w}))] AS best FROM t{epochs}"""))
    return ctes


def _quoted_list(values) -> str:
    return "[" + ", ".join(map(_quoted, values)) + "]"


GREEDY = ("guessed", """
SELECT sent_id, pos, k.word, tag AS label, coalesce(best, 'O') AS prediction
FROM (SELECT * FROM tokens WHERE part = 1) k LEFT JOIN best_tags b ON k.word = b.word""")

CONTEXTS = [
    *SENTENCES,
    ("ctx", _grams("sents", "sent_id, ", "list_concat(['START', 'START'], tokens, ['END', 'END'])", 3)),
    ("ctx_counts", "SELECT g1 AS w1, g2 AS w2, g3 AS next, count(*) AS n FROM ctx GROUP BY ALL"),
    ("ctx_model", """
SELECT w1, w2, next, n, n / sum(n) OVER (PARTITION BY w1, w2) AS p,
       row_number() OVER (PARTITION BY w1, w2 ORDER BY n DESC, next) = 1 AS is_best
FROM ctx_counts"""),
]


# Queries -----------------------------------------------------------------------

ORACLES["access_log_parse"] = _with(LOG) + "SELECT host, ts, path, status, bytes FROM log"

ORACLES["access_log_report"] = (
    'SELECT count(*) AS "rows", count(*) FILTER (value < 0.5) AS dropped FROM events'
)

ORACLES["access_log_weekday"] = """
SELECT d AS weekday, count(ts) AS requests, count(DISTINCT cast(ts AS date)) AS days,
       round(count(ts) / nullif(count(DISTINCT cast(ts AS date)), 0), 6) AS average
FROM (SELECT unnest(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']) AS d) w
     LEFT JOIN (SELECT ts FROM events WHERE value >= 0.5) e ON strftime(ts, '%a') = d
GROUP BY d"""

ORACLES["top_paths"] = _with(LOG) + """
SELECT path AS value, count(*) AS n FROM log WHERE path LIKE '%.gif%'
GROUP BY path ORDER BY n DESC, value LIMIT 20"""

_ALL = " AND ".join(f"{c} IS NOT NULL" for c in ["year", *CLAIM_CATEGORIES, *CLAIM_MEASURES])
ORACLES["complete_rows"] = _with(CLAIMS) + f"SELECT row_key, year, brand, type FROM claims WHERE {_ALL}"

ORACLES["kfold_sizes"] = f"""
SELECT cast({bucket('o_orderkey', 111)} % 5 AS integer) AS fold, count(*) AS n FROM orders GROUP BY 1"""

ORACLES["hash_split"] = f"""
SELECT o_orderkey, CASE WHEN {bucket('o_orderkey', 666)} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS part
FROM orders"""

ORACLES["hash_sample"] = f"""
SELECT o_orderkey FROM orders WHERE {bucket('o_orderkey', 91)} < {round(0.25 * 2**32)}"""

ORACLES["head_split"] = """
SELECT doc_id, label, CASE WHEN r <= 40 THEN 'train' ELSE 'test' END AS part FROM (
  SELECT doc_id, 2 * quality - 1 AS label, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS r
  FROM labels JOIN documents USING (doc_id)) WHERE r <= 50"""

ORACLES["shuffle_order"] = """
SELECT doc_id, lang, row_number() OVER (ORDER BY md5('999:' || doc_id), doc_id) - 1 AS position
FROM documents"""

ORACLES["temporal_split"] = _with(CLAIMS) + f"""
SELECT row_key, CASE WHEN try_cast(year AS int) < {CLAIM_CUT} THEN 'train' ELSE 'test' END AS part
FROM claims WHERE label > 0 AND try_cast(year AS int) <= {CLAIM_CUT}"""

ORACLES["class_counts"] = _with(CLAIMS) + """
SELECT count(*) AS total, count(*) FILTER (label > 0) AS positives,
       count(*) FILTER (label = 0) AS negatives FROM claims"""

ORACLES["balance_under"] = _with(CLAIMS) + f"""
SELECT row_key, round(label, 6) AS label FROM claims
WHERE label > 0 OR {bucket('row_key', 12)} / 4294967296.0::double
      < (SELECT count(*) FILTER (label > 0) / count(*) FROM claims)"""

ORACLES["balance_over"] = _with(
    CLAIMS,
    ("ratio", "SELECT count(*) / count(*) FILTER (label > 0) AS r FROM claims"),
    ("poisson", """
SELECT list(until ORDER BY k) AS steps FROM (
  SELECT k, sum(exp(-r + k * ln(r) - lgamma(k + 1))) OVER (ORDER BY k) AS until
  FROM ratio, range(0, cast(floor(r + 12 * sqrt(r) + 30) AS bigint) + 1) t(k))"""),
    ("drawn", f"""
SELECT row_key, label, CASE WHEN label > 0 THEN len(list_filter(steps, lambda c: c <=
         {bucket('row_key', 111)} / 4294967296.0::double)) ELSE 1 END AS copies
FROM claims, poisson"""),
) + "SELECT row_key, round(label, 6) AS label, cast(copies AS bigint) AS copies FROM drawn WHERE copies > 0"

ORACLES["largest_clusters"] = """
SELECT p_size AS cluster, count(*) AS n FROM part GROUP BY p_size ORDER BY n DESC, cluster LIMIT 3"""


WIDE = ("assign", "SELECT o_orderkey AS item, day(o_orderdate) AS cluster FROM orders")


def _profile(assign: tuple[str, str], join: str, top: int, k: int) -> str:
    return _with(
        ("scores", SCORES), assign,
        ("top", f"SELECT cluster FROM assign GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT {top}"),
        ("sums", f"""
SELECT a.cluster, s.tag_id, sum(s.relevance) AS relevance
FROM assign a {join} JOIN scores s ON a.item = s.item
WHERE a.cluster IN (SELECT cluster FROM top) GROUP BY a.cluster, s.tag_id"""),
        ("ranked", """
SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(relevance, 9) DESC NULLS LAST, tag_id NULLS LAST) AS r
FROM sums"""),
    ) + f"""
SELECT cluster, cast(r AS integer) AS rank, tag_id, s_name AS tag, round(relevance, 6) AS relevance
FROM ranked LEFT JOIN supplier ON tag_id = s_suppkey WHERE r <= {k}"""


ORACLES["cluster_profile"] = _profile(ASSIGN, "INNER", 3, 5)
ORACLES["cluster_profile_outer"] = _profile(WIDE, "LEFT", 50, 1000)


def _category_counts(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CLAIM_CATEGORIES
    )


_INDEXED = """
SELECT "column", value, n,
       cast(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS integer) AS ix
FROM counts"""

ORACLES["category_index"] = _with(CLAIMS, ("counts", _category_counts("claims"))) + _INDEXED

ORACLES["threshold"] = _with(CLAIMS) + """
SELECT row_key, CASE WHEN label > 0 THEN 1.0::double ELSE 0.0::double END AS claimed FROM claims"""


def _correlations() -> str:
    cols = [*NUMERIC_FEATURES, "label"]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name, round(corr({a}, {b}), 6) AS corr FROM num"
        for a in cols for b in cols
    )


ORACLES["correlation_matrix"] = _with(NUMERIC) + _correlations()


def _vectors() -> str:
    ctes = [CLAIMS, ("clean", f"SELECT * FROM claims WHERE {_ALL} AND label IS NOT NULL"),
            ("counts", _category_counts("clean")), ("ixs", _INDEXED)]
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CLAIM_CATEGORIES))
    ctes.append(("widths", f"""
SELECT "column", count(*) - 1 AS width, CASE "column" {order} END AS o FROM ixs GROUP BY "column" """))
    ctes.append(("offsets", """
SELECT "column", width, coalesce(sum(width) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
FROM widths"""))
    ctes.append(("places", """
SELECT i."column", i.value, CASE WHEN ix < width THEN cast(off + ix AS bigint) END AS place
FROM ixs i JOIN offsets f ON i."column" = f."column" """))
    joins = " ".join(
        f"JOIN places p{i} ON p{i}.\"column\" = '{c}' AND p{i}.value = clean.{c}"
        for i, c in enumerate(CLAIM_CATEGORIES)
    )
    places = ", ".join(f"p{i}.place" for i in range(len(CLAIM_CATEGORIES)))
    measures = ", ".join(f"round({m}, 4) AS {m}" for m in CLAIM_MEASURES)
    return _with(*ctes) + f"""
SELECT row_key, cast((SELECT sum(width) FROM widths) + {len(CLAIM_MEASURES)} AS integer) AS dims,
       concat_ws(' ', {places}) AS hot, {measures}
FROM clean {joins}"""


ORACLES["claims_features"] = _vectors()

ORACLES["metrics_regression"] = _with(NUMERIC, RULE) + """
SELECT round(sqrt(avg((label - prediction) ** 2)), 4) AS rmse,
       round(avg(abs(label - prediction)), 4) AS mae,
       round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 4) AS r2 FROM rule"""

ORACLES["metrics_binary"] = _with(NUMERIC) + _binary("num")

ORACLES["metrics_auc"] = _with(
    NUMERIC,
    ("groups", "SELECT price, sum(label) AS pos, sum(1 - label) AS neg FROM num GROUP BY price"),
    ("runs", "SELECT *, sum(neg) OVER (ORDER BY price) AS run FROM groups"),
) + "SELECT round(sum(pos * (run - neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM runs"


def _gini(order: str) -> str:
    return f"""
SELECT (sum(run) / max(total) - (count(*) + 1) / 2) / count(*) AS g FROM (
  SELECT sum(label) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run, sum(label) OVER () AS total
  FROM rule)"""


ORACLES["gini_normalized"] = _with(
    NUMERIC, RULE, ("given", _gini("prediction DESC, row_key")), ("ideal", _gini("label DESC, row_key"))
) + """
SELECT round(given.g, 6) AS gini, round(ideal.g, 6) AS best, round(given.g / ideal.g, 6) AS normalized
FROM given, ideal"""

_FOLDED = ("folded", f"""
SELECT cast({bucket('row_key', 111)} % 5 AS integer) AS fold, sqrt(avg((label - prediction) ** 2)) AS rmse,
       avg(abs(label - prediction)) AS mae,
       1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)) AS r2
FROM rule GROUP BY 1""")
ORACLES["cv_fold_metrics"] = _with(NUMERIC, RULE, _FOLDED) + """
SELECT fold, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2 FROM folded"""
ORACLES["fold_summary"] = _with(NUMERIC, RULE, _FOLDED) + """
SELECT round(avg(rmse), 4) AS avg_rmse, round(avg(mae), 4) AS avg_mae,
       round(stddev_pop(rmse), 4) AS std_rmse, round(stddev_pop(mae), 4) AS std_mae FROM folded"""

_POINTS = [(f, at) for f, cuts in GRID_RULES.items() for at in cuts]
ORACLES["grid_best"] = _with(NUMERIC, ("points", " UNION ALL ".join(
    f"SELECT '{f}' AS family, {i} AS point, {float(at)}::double AS params, "
    f"avg(cast(cast({f} > {at} AS double) = label AS double)) AS metric FROM num"
    for i, (f, at) in enumerate(_POINTS)
))) + """
SELECT family, round(params, 6) AS params, round(metric, 6) AS metric FROM points
QUALIFY row_number() OVER (PARTITION BY family ORDER BY metric DESC, point) = 1"""

_DOC_TOKENS = ("doc_tokens", f"SELECT doc_id, regexp_extract_all(text, '{WORD}') AS items FROM documents")
ORACLES["bag_of_words"] = _with(_DOC_TOKENS, ("bag", _bag("doc_tokens", (1, 2)))) + "SELECT * FROM bag"

ORACLES["ngram_counts"] = _with(SENTENCES, BIGRAMS, BIGRAM_COUNTS) + f"SELECT {_joined(2)} AS gram, n FROM bcounts"

ORACLES["ngram_vocabulary"] = _with(
    _DOC_TOKENS, ("words", "SELECT DISTINCT unnest(items) AS feature FROM doc_tokens"),
    ("twos", _grams("doc_tokens", "", "items", 2)),
) + f"SELECT 1 AS n_order, feature FROM words UNION ALL SELECT DISTINCT 2, {_joined(2)} FROM twos"

ORACLES["vocabulary"] = _with(
    _DOC_TOKENS, ("words", "SELECT DISTINCT unnest(items) AS word FROM doc_tokens")
) + "SELECT word, row_number() OVER (ORDER BY word) - 1 AS ix FROM words"

_UNIGRAMS = [
    ("ucounts", "SELECT gram, count(*) AS n FROM (SELECT unnest(tokens) AS gram FROM sents) GROUP BY gram"),
    ("uprobs", "SELECT gram, n, n / (SELECT sum(n) FROM ucounts) AS p FROM ucounts"),
]
_BPROBS = ("bprobs", "SELECT g1, g2, n, n / (SELECT sum(n) FROM bcounts) AS p FROM bcounts")
_ADD1 = [
    ("extended", """
SELECT g1, g2, n FROM bcounts UNION ALL
SELECT DISTINCT q.g1, q.g2, 0 FROM qgrams q ANTI JOIN bcounts b ON q.g1 = b.g1 AND q.g2 = b.g2"""),
    ("aprobs", "SELECT g1, g2, n, (n + 1) / (SELECT sum(n + 1) FROM extended) AS p FROM extended"),
]
ORACLES["word_vectors"] = _with(SENTENCES, _UNIGRAMS) + "SELECT gram AS word, 5 AS size, true AS solves FROM uprobs"
ORACLES["words_nearer"] = _with(SENTENCES) + """
SELECT DISTINCT tokens[1] AS id, tokens[3] AS a, tokens[5] AS b, true AS answered FROM sents WHERE len(tokens) >= 5"""
ORACLES["lm_unigram"] = _with(SENTENCES, _UNIGRAMS) + "SELECT gram, n, p FROM uprobs"
ORACLES["lm_bigram"] = _with(SENTENCES, BIGRAMS, BIGRAM_COUNTS, _BPROBS) + f"""
SELECT {_joined(2)} AS gram, n, p FROM bprobs"""
ORACLES["lm_bigram_conditional"] = _with(SENTENCES, BIGRAMS, BIGRAM_COUNTS) + f"""
SELECT {_joined(2)} AS gram, n, n / sum(n) OVER (PARTITION BY g1) AS p FROM bcounts"""
ORACLES["lm_bigram_add1"] = _with(SENTENCES, BIGRAMS, BIGRAM_COUNTS, QUESTIONS, _ADD1) + f"""
SELECT {_joined(2)} AS gram, n, p FROM aprobs"""
ORACLES["lm_mass"] = _with(SENTENCES, _UNIGRAMS, BIGRAMS, BIGRAM_COUNTS, _BPROBS) + """
SELECT 1 AS n, round(sum(p), 6) AS mass FROM uprobs UNION ALL SELECT 2, round(sum(p), 6) FROM bprobs"""

ORACLES["cloze_unigram"] = _with(SENTENCES, _UNIGRAMS, QUESTIONS, ("looked", """
SELECT q_id, cand_no, cand, coalesce(p, 0) AS p FROM asked LEFT JOIN uprobs ON gram = cand""")) + ANSWERS.lstrip()
for _name, _probs, _ctes in (("cloze_bigram", "bprobs", [_BPROBS]), ("cloze_add1", "aprobs", _ADD1)):
    ORACLES[_name] = _with(SENTENCES, BIGRAMS, BIGRAM_COUNTS, QUESTIONS, _ctes, ("looked", f"""
SELECT q.q_id, q.cand_no, a.cand, coalesce(p, 0) AS p
FROM qgrams q JOIN asked a ON q.q_id = a.q_id AND q.cand_no = a.cand_no
     LEFT JOIN {_probs} b ON q.g1 = b.g1 AND q.g2 = b.g2""")) + ANSWERS.lstrip()

ORACLES["context_pairs"] = _with(CONTEXTS[:-1]) + "SELECT w1, w2, next, n FROM ctx_counts"
ORACLES["next_word"] = _with(CONTEXTS) + """
SELECT w1, w2, next, n, p, is_best FROM ctx_model"""
ORACLES["sentence_logprob"] = _with(CONTEXTS) + """
SELECT sent_id, round(sum(ln(p)), 4) AS logprob
FROM ctx JOIN ctx_model ON g1 = w1 AND g2 = w2 AND g3 = next GROUP BY sent_id"""
ORACLES["next_word_accuracy"] = _with(CONTEXTS) + """
SELECT cast(sum(n) AS bigint) AS pairs, cast(sum(n) FILTER (is_best) AS bigint) AS "right",
       round(sum(n) FILTER (is_best) / sum(n), 6) AS share FROM ctx_model"""

ORACLES["perceptron_weights"] = _with(POLARITY, _perceptron((1,), EPOCHS)) + f"""
SELECT feature, weight FROM w{EPOCHS}"""
ORACLES["perceptron_ngram_weights"] = _with(POLARITY, _perceptron((1, 2, 3), 2)) + """
SELECT n_order, feature, weight FROM w2"""
ORACLES["perceptron_predict"] = _with(POLARITY, _perceptron((1,), EPOCHS, 0), TEST_BAG) + _judged(f"w{EPOCHS}")
ORACLES["perceptron_extremes"] = _with(POLARITY, _perceptron((1,), EPOCHS)) + f"""
SELECT 'positive' AS side, cast(row_number() OVER (ORDER BY weight DESC, feature) AS integer) AS rank,
       feature, weight FROM w{EPOCHS} QUALIFY rank <= 10
UNION ALL
SELECT 'negative' AS side, cast(row_number() OVER (ORDER BY weight, feature) AS integer) AS rank,
       feature, weight FROM w{EPOCHS} QUALIFY rank <= 10"""
ORACLES["perceptron_epochs"] = _with(
    POLARITY, _perceptron((1,), EPOCHS, 0), TEST_BAG,
    [(f"judged{e}", _judged(f"w{e}")) for e in range(1, EPOCHS + 1)],
) + " UNION ALL ".join(_binary(f"judged{e}", extra=f"{e} AS epoch, ") for e in range(1, EPOCHS + 1))

ORACLES["word_tag_counts"] = _with(TAGGED[:-1]) + "SELECT word, tag, count(*) AS n FROM tokens GROUP BY ALL"
ORACLES["tag_pair_counts"] = _with(TAGGED) + "SELECT prev_tag, tag, count(*) AS n FROM tag_pairs GROUP BY ALL"
ORACLES["tag_features"] = _with(TAGGED) + """
SELECT sent_id, 'word_tag' AS kind, word AS a, tag AS b, count(*) AS n FROM tokens
WHERE part = 1 AND (word, tag) IN (SELECT (word, tag) FROM tokens WHERE part = 0) GROUP BY ALL
UNION ALL
SELECT sent_id, 'tag_tag' AS kind, prev_tag, tag, count(*) FROM tag_pairs
WHERE part = 1 AND (prev_tag, tag) IN (SELECT (prev_tag, tag) FROM tag_pairs WHERE part = 0) GROUP BY ALL"""
ORACLES["tagger_weights"] = _with(TAGGED, _tagger(TAG_EPOCHS)) + """
SELECT 'word_tag' AS kind, word AS a, tag AS b, weight FROM tag_weights WHERE weight <> 0"""
ORACLES["tagger_greedy"] = _with(TAGGED, _tagger(TAG_EPOCHS, "WHERE part = 0"), GREEDY) + """
SELECT sent_id, cast(pos AS integer) AS pos, word, prediction AS tag FROM guessed"""
ORACLES["tagger_beam"] = ORACLES["tagger_greedy"]
ORACLES["tag_f1"] = _with(TAGGED, _tagger(TAG_EPOCHS, "WHERE part = 0"), GREEDY) + """
SELECT count(*) FILTER (label = prediction AND label <> 'O') AS tp,
       count(*) FILTER (label <> prediction AND prediction <> 'O') AS fp,
       count(*) FILTER (label <> prediction AND label <> 'O') AS fn,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM guessed"""
ORACLES["tagger_top_features"] = _with(TAGGED, _tagger(TAG_EPOCHS)) + """
SELECT tag, cast(row_number() OVER (PARTITION BY tag ORDER BY weight DESC, word) AS integer) AS rank, word, weight
FROM tag_weights QUALIFY rank <= 10"""

ORACLES["cosine_pairs"] = """
SELECT a.vec_id AS id_1, b.vec_id AS id_2,
       round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
ORACLES["nearer"] = """
SELECT q.vec_id AS id, a.vec_id AS a, b.vec_id AS b,
       round(list_cosine_similarity(q.embedding::double[], a.embedding::double[]), 6) AS cosine_a,
       round(list_cosine_similarity(q.embedding::double[], b.embedding::double[]), 6) AS cosine_b,
       CASE WHEN list_cosine_similarity(q.embedding::double[], a.embedding::double[])
               > list_cosine_similarity(q.embedding::double[], b.embedding::double[])
            THEN a.vec_id ELSE b.vec_id END AS choice
FROM embeddings q JOIN embeddings a ON a.vec_id = q.vec_id + 1 JOIN embeddings b ON b.vec_id = q.vec_id + 2"""


# Fits: what must be so -----------------------------------------------------------

_CLEAN = ("clean", f"SELECT * FROM claims WHERE {_ALL}")
_HOT = " UNION ALL ".join(
    f"SELECT '{c}' AS c, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS ix, count(*) OVER () AS width FROM clean GROUP BY {c}"
    for c in CLAIM_CATEGORIES
)
_SPREADS = " + ".join(f"var_samp({m})" for m in CLAIM_MEASURES)
ORACLES["pca_explained"] = _with(
    CLAIMS, _CLEAN, ("total", "SELECT count(*) AS m FROM clean"), ("hot", _HOT),
    ("trace", f"""
SELECT (SELECT {_SPREADS} FROM clean) + (SELECT sum(n / m * (1 - n / m) * m / (m - 1)) FROM hot, total WHERE ix < width) AS trace"""),
) + "SELECT row_key, 25 AS dims, round(trace, 0) AS trace, true AS sound FROM clean, trace"
_RATINGS = ("ratings", f"""
SELECT {ROW_KEY} AS row_key, o_custkey AS customer, l_partkey AS item,
       1 + (o_custkey % 5) * 0.5 + (l_partkey % 4) * 0.75 + (l_quantity % 2) * 0.25 AS rating,
       {bucket(ROW_KEY, 111)} % 5 AS part
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
ORACLES["als_cv"] = _with(_RATINGS) + """
, folds AS (SELECT f FROM range(5) t(f)),
means AS (SELECT f, item, avg(rating) AS mean FROM ratings, folds WHERE part <> f GROUP BY f, item),
judged AS (SELECT r.part AS f, r.rating - m.mean AS e FROM ratings r JOIN means m ON m.f = r.part AND m.item = r.item)
SELECT cast(rank AS integer) AS rank, cast(f AS integer) AS fold, round(sqrt(avg(e * e)), 4) AS item_mean_rmse,
       round(avg(abs(e)), 4) AS item_mean_mae, true AS sound
FROM judged, (VALUES (10), (5)) r(rank) GROUP BY rank, f"""
ORACLES["als_clusters"] = "SELECT count(DISTINCT l_partkey) AS items, true AS separates, true AS solves FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
ORACLES["als_fold_profiles"] = f"""
SELECT cast(f AS integer) AS model, count(DISTINCT l_partkey) AS items, 3 AS clusters, 5 AS tags
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, range(5) t(f)
WHERE {bucket(ROW_KEY, 111)} % 5 <> f GROUP BY f"""
MEASURED = ("measured", f"""
SELECT *, cast((quantity / 50 + 6 * discount > 0.805) <> ({bucket('row_key', 77)} % 10 = 0) AS double) AS label
FROM (SELECT * EXCLUDE (label, prediction) FROM num)""")
_FACTS = f"""
SELECT count(*) AS test_rows, cast(sum(label) AS bigint) AS positives, round(greatest(avg(label), 1 - avg(label)), 6) AS majority, true AS sound
FROM measured WHERE {bucket('row_key', 44)} >= {round(0.8 * 2**32)}"""
for _name in ("tree_classifier", "tree_threshold", "logistic"):
    ORACLES[_name] = _with(NUMERIC, MEASURED) + _FACTS
ORACLES["tree_importance"] = """
SELECT cast(1 AS integer) AS rank, 'quantity' AS feature, true AS sound UNION ALL SELECT 2, 'discount', true"""
ORACLES["grid_search"] = """
WITH t AS (
  SELECT 1 AS f, 'tree' AS family, row_number() OVER (ORDER BY d, b) AS i, 'maxBins=' || b || ' maxDepth=' || d AS params
  FROM (VALUES (5), (10), (15)) x(d), (VALUES (16), (32)) y(b)
  UNION ALL
  SELECT 2, 'tree_threshold', row_number() OVER (ORDER BY d, b), 'maxBins=' || b || ' maxDepth=' || d
  FROM (VALUES (5), (10), (15)) x(d), (VALUES (6), (16), (32)) y(b)
  UNION ALL
  SELECT 3, 'logistic', row_number() OVER (ORDER BY r, m, e), 'elasticNetParam=' || e || ' maxIter=' || m || ' regParam=' || r
  FROM (VALUES ('0.01'), ('0.05')) x(r), (VALUES (10), (100)) y(m), (VALUES ('0.0'), ('0.1')) z(e)
)
SELECT family, cast(row_number() OVER (ORDER BY f, i) - 1 AS integer) AS point, params, true AS sound FROM t"""
ORACLES["grid_models"] = _with(NUMERIC, MEASURED, ("facts", _FACTS)) + """
SELECT family, facts.*, 3 AS features FROM facts, (VALUES ('tree'), ('tree_threshold'), ('logistic')) f(family)"""
_HELD_OUT = f"{bucket('row_key', 666)} >= {round(0.75 * 2**32)}"
_TEST = ("held", f"""
SELECT 'positives' AS data, label FROM clean WHERE label > 0 AND try_cast(year AS int) = {CLAIM_CUT}
UNION ALL SELECT d, label FROM clean, (VALUES ('full'), ('under'), ('over')) t(d) WHERE {_HELD_OUT}""")
ORACLES["claims_linear"] = _with(CLAIMS, _CLEAN, _TEST) + """
SELECT data, count(*) AS test_rows, round(stddev_pop(label), 4) AS spread, true AS sound FROM held GROUP BY data"""
ORACLES["claims_forest"] = _with(CLAIMS, _CLEAN) + f"""
SELECT count(*) AS test_rows, count(*) FILTER (label > 0) AS positives, true AS sound FROM clean WHERE {_HELD_OUT}"""
ORACLES["claims_gamma"] = "SELECT cast(i AS integer) AS term, true AS solved FROM range(26) t(i)"
ORACLES["next_word_net"] = _with(SENTENCES) + """
, marked AS (SELECT ['START', 'START'] || tokens || ['END', 'END'] AS items FROM sents),
nexts AS (SELECT unnest(items[3:]) AS next FROM marked),
counts AS (SELECT next, count(*) AS n FROM nexts GROUP BY next)
SELECT cast(sum(n) AS bigint) AS pairs, count(*) AS words, round(max(n) / sum(n), 6) AS commonest,
       true AS beats_commonest, true AS beats_frequencies FROM counts"""

# Files written and read back ------------------------------------------------------

ORACLES["file_access_log"] = """
SELECT 'u' || user_id || '.example.org' AS host, '-' AS ident, '-' AS "user",
       CASE WHEN value < 0.5 THEN '[broken' ELSE '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') END AS stamp, '+0000]' AS "offset",
       'GET /' || event_type || '/' || (user_id % 20) || CASE WHEN event_type IN ('view', 'click') THEN '.gif' ELSE '.html' END || ' HTTP/1.0' AS request,
       CASE event_type WHEN 'error' THEN '404' ELSE '200' END AS status,
       CASE event_type WHEN 'error' THEN '-' ELSE cast(cast(round(value * 100) AS bigint) AS varchar) END AS bytes
FROM events"""
ORACLES["file_ratings"] = _with(_RATINGS) + "SELECT customer AS userId, item AS movieId, rating FROM ratings"
ORACLES["file_tag_scores"] = f"""
SELECT tag_id AS "tagId", item AS "movieId", round(relevance, 6) AS relevance, s_name AS tag FROM ({SCORES}) JOIN supplier ON s_suppkey = tag_id"""
ORACLES["file_numeric"] = _with(NUMERIC) + f"SELECT label, {', '.join(NUMERIC_FEATURES)} FROM num"
_PLACE = {name: i % 5 + 1 for i, (name, _) in enumerate(CLAIM_FIELDS)}
ORACLES["file_claims"] = f"""
SELECT cast(year(l_shipdate) AS varchar) AS "Calendar_Year", l_returnflag AS "Cat1", l_linestatus AS "Cat2", l_returnflag AS "OrdCat", l_returnflag AS "NVCat",
       count(*) AS n, count(*) FILTER (l_discount > 0.03) AS known, cast(sum(l_linenumber) AS bigint) AS vehicles,
       round(sum(l_quantity * {_PLACE['Var1']}), 4) AS var1, round(sum(l_quantity * {_PLACE['NVVar4']}), 4) AS nvvar4,
       round(sum(l_extendedprice * l_discount), 4) AS label
FROM lineitem GROUP BY ALL"""
ORACLES["file_documents"] = """
SELECT CASE quality WHEN 1 THEN 'pos/' ELSE 'neg/' END || doc_id || '.txt' AS doc_id, 2 * quality - 1 AS label, length(text) AS chars, md5(text) AS digest
FROM documents JOIN labels USING (doc_id)"""
ORACLES["file_corpus"] = _with(SENTENCES) + "SELECT array_to_string(tokens, ' ') AS tokens, count(*) AS n FROM sents GROUP BY ALL"
ORACLES["file_questions"] = _with(QUESTIONS) + f"""
SELECT array_to_string([translate(t, ':/', '__') FOR t IN list_concat(toks[1:spot - 1], ['{BLANK}'], toks[spot + 1:])], ' ') AS tokens,
       cand_no, translate(cand, ':/', '__') AS cand, count(*) AS n FROM asked GROUP BY ALL"""
ORACLES["file_tagged"] = _with(TAGGED[:-1]) + "SELECT cast(pos AS integer) AS pos, word, tag, count(*) AS n FROM tokens GROUP BY ALL"

# Tagging with transitions: the perceptron's epochs and Viterbi, row by row ----------


def _viterbi(name: str, tokens: str, words: str, pairs: str) -> list[tuple[str, str, bool]]:
    """Best tags of ``tokens`` under weights ``words`` (word, tag, weight) and ``pairs`` (prev_tag, tag, weight).

    ``{name}`` is ``sent_id, pos, word, tag``. The scores of a position follow from those of
    the one before it; afterwards the way back is read from the last position.
    """
    moves = ", ".join(
        "[" + ", ".join(f"coalesce((SELECT weight FROM {pairs} WHERE prev_tag = '{a}' AND tag = '{b}'), 0)" for b in TAGS) + "]"
        for a in ("None", *TAGS)
    )
    emitted = ", ".join(f"coalesce(sum(weight) FILTER (tag = '{t}'), 0)" for t in TAGS)
    ways = "list_transform(range(1, 6), lambda p: w.s[p] + m.m[p + 1][t])"
    return [
        (f"{name}_m", f"SELECT [{moves}] AS m", False),
        (f"{name}_e", f"SELECT word, [{emitted}] AS e FROM {words} GROUP BY word", False),
        (f"{name}_t", f"SELECT t.sent_id, t.pos, t.word, coalesce(e.e, [0, 0, 0, 0, 0]) AS e FROM {tokens} t LEFT JOIN {name}_e e USING (word)", False),
        (f"{name}_w", f"""
SELECT x.sent_id, x.pos, list_transform(range(1, 6), lambda t: m.m[1][t] + x.e[t]) AS s, [0, 0, 0, 0, 0]::bigint[] AS back
FROM {name}_t x, {name}_m m WHERE x.pos = 0
UNION ALL
SELECT x.sent_id, x.pos, list_transform(range(1, 6), lambda t: list_max({ways}) + x.e[t]),
       list_transform(range(1, 6), lambda t: list_position({ways}, list_max({ways}))::bigint)
FROM {name}_w w JOIN {name}_t x ON x.sent_id = w.sent_id AND x.pos = w.pos + 1, {name}_m m""", True),
        (f"{name}_all", f"SELECT *, max(pos) OVER (PARTITION BY sent_id) AS last FROM {name}_w", False),
        (f"{name}_b", f"""
SELECT sent_id, pos, list_position(s, list_max(s))::bigint AS slot FROM {name}_all WHERE pos = last
UNION ALL
SELECT b.sent_id, b.pos - 1, w.back[b.slot] FROM {name}_b b JOIN {name}_all w ON w.sent_id = b.sent_id AND w.pos = b.pos WHERE b.pos > 0""", True),
        (name, f"SELECT b.sent_id, b.pos, t.word, {TAGS!r}[b.slot] AS tag FROM {name}_b b JOIN {name}_t t USING (sent_id, pos)", False),
    ]


def _structured(epochs: int) -> list[tuple[str, str, bool]]:
    """Weights ``words{epochs}`` and ``pairs{epochs}`` of the structured perceptron on part 0."""
    before = "coalesce(lag(tag) OVER (PARTITION BY sent_id ORDER BY pos), 'None') AS prev_tag"
    parts = [(n, sql, False) for n, sql in TAGGED]
    parts += [
        ("gold", f"SELECT sent_id, pos, word, tag, {before} FROM tokens WHERE part = 0", False),
        ("known_words", "SELECT DISTINCT word, tag FROM gold", False),
        ("known_pairs", "SELECT DISTINCT prev_tag, tag FROM gold", False),
        ("words0", "SELECT word, tag, 0 AS weight FROM gold WHERE false", False),
        ("pairs0", "SELECT prev_tag, tag, 0 AS weight FROM gold WHERE false", False),
    ]
    for e in range(1, epochs + 1):
        if e == 1:
            parts.append(("found1", f"SELECT sent_id, pos, word, '{TAGS[0]}' AS tag FROM gold", False))
        else:
            parts += _viterbi(f"found{e}", "gold", f"words{e - 1}", f"pairs{e - 1}")
        parts += [
            (f"wrong{e}", f"SELECT DISTINCT g.sent_id FROM gold g JOIN found{e} f USING (sent_id, pos) WHERE g.tag <> f.tag", False),
            (f"moved{e}", f"""
SELECT word, tag, prev_tag, 1 AS n FROM gold WHERE sent_id IN (SELECT sent_id FROM wrong{e})
UNION ALL SELECT word, tag, {before}, -1 FROM found{e} WHERE sent_id IN (SELECT sent_id FROM wrong{e})""", False),
        ]
        for kind, key in (("words", "word"), ("pairs", "prev_tag")):
            parts.append((f"{kind}{e}", f"""
SELECT {key}, tag, sum(weight) AS weight FROM (
  SELECT {key}, tag, weight FROM {kind}{e - 1}
  UNION ALL SELECT {key}, tag, sum(n) FROM moved{e} JOIN known_{kind} USING ({key}, tag) GROUP BY ALL) GROUP BY ALL HAVING sum(weight) <> 0""", False))
    return parts


def _recursive(parts: list[tuple[str, str, bool]]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'' if again else 'MATERIALIZED '}({sql})" for n, sql, again in parts) + "\n"


ORACLES["tagger_transition_weights"] = _recursive(_structured(TAG_EPOCHS)) + f"""
SELECT 'word_tag' AS kind, word AS a, tag AS b, cast(weight AS bigint) AS weight FROM words{TAG_EPOCHS}
UNION ALL SELECT 'tag_tag', prev_tag, tag, cast(weight AS bigint) FROM pairs{TAG_EPOCHS}"""
ORACLES["tagger_viterbi"] = _recursive([
    *_structured(TAG_EPOCHS), ("asked_tokens", "SELECT sent_id, pos, word FROM tokens WHERE part = 1", False),
    *_viterbi("answer", "asked_tokens", f"words{TAG_EPOCHS}", f"pairs{TAG_EPOCHS}"),
]) + "SELECT sent_id, cast(pos AS integer) AS pos, word, tag FROM answer"


# Online perceptron: weights are sums of documents, so a step needs their products only ----


def _mixing(epochs: int, docs_per_shard: int, seed: int = 11) -> str:
    """``units{epochs}``: how often each document was added to the weights, counted with its label.

    The score of a document is the sum of its products with the documents added before, those
    of its own shard in this epoch and those of all shards, a share each, in earlier ones.
    """
    parts = [(n, sql, False) for n, sql in POLARITY]
    parts += [
        ("all_docs", "SELECT doc_id, label, items FROM polar_tokens", False),
        ("bag", _bag("all_docs", (1,)), False),
        ("shards", f"SELECT greatest(1, cast(ceil(count(*) / {docs_per_shard}) AS bigint)) AS s FROM all_docs", False),
        ("numbered", f"SELECT doc_id, label, {bucket('doc_id', 7)} % s AS shard, row_number() OVER (ORDER BY doc_id) AS i FROM all_docs, shards", False),
        ("products", """
SELECT a.i, b.i AS j, coalesce(p.g, 0) AS g FROM numbered a CROSS JOIN numbered b LEFT JOIN (
  SELECT x.doc_id AS da, y.doc_id AS db, sum(x.n * y.n) AS g FROM bag x JOIN bag y USING (feature) GROUP BY ALL) p ON p.da = a.doc_id AND p.db = b.doc_id""", False),
        ("rows_of", "SELECT i, list(g::double ORDER BY j) AS g FROM products GROUP BY i", False),
        ("units0", "SELECT i, 0 AS a FROM numbered", False),
    ]
    for e in range(1, epochs + 1):
        parts += [
            (f"begin{e}", f"SELECT p.i, sum(p.g * u.a) AS base FROM products p JOIN units{e - 1} u ON u.i = p.j GROUP BY p.i", False),
            (f"order{e}", f"""
SELECT n.i, label, shard, base, g, row_number() OVER (PARTITION BY shard ORDER BY md5('{seed * (e - 1)}:' || doc_id), doc_id) AS t
FROM numbered n JOIN begin{e} b ON b.i = n.i JOIN rows_of r ON r.i = n.i""", False),
            (f"pass{e}", f"""
SELECT DISTINCT shard, 0::bigint AS t, (SELECT list(0::double) FROM numbered) AS d FROM numbered
UNION ALL
SELECT o.shard, o.t, CASE WHEN (o.base + s.s * list_dot_product(p.d, o.g) >= 0) <> (o.label > 0)
  THEN list_transform(p.d, lambda x, k: CASE WHEN k = o.i THEN x + o.label ELSE x END) ELSE p.d END
FROM pass{e} p JOIN order{e} o ON o.shard = p.shard AND o.t = p.t + 1, shards s""", True),
            (f"units{e}", f"""
SELECT u.i, u.a + coalesce(d.d[u.i], 0) AS a FROM units{e - 1} u JOIN numbered n ON n.i = u.i
JOIN (SELECT shard, arg_max(d, t) AS d FROM pass{e} GROUP BY shard) d ON d.shard = n.shard""", False),
        ]
    return _recursive(parts)


ORACLES["perceptron_mixing"] = _mixing(EPOCHS, 100) + f"""
SELECT feature, round(sum(b.n * u.a) / any_value(s.s), 6) AS weight
FROM bag b JOIN numbered n ON n.doc_id = b.doc_id JOIN units{EPOCHS} u ON u.i = n.i, shards s
GROUP BY feature HAVING sum(b.n * u.a) <> 0"""
