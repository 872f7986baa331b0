"""The named queries of this package, with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import (
    chat_format, collocations, decontaminate, license_scan, line_dedup, ngram_join, packing, periodic_runs, quality_model, quality_rules, span_dedup,
    token_counts, toxicity,
)
from seriesloom.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy word pieces of every document; no SQL (longest match over a vocabulary), tested against brute force."""
    return token_counts.count_tokens(table(spark, folder, "documents"), WORD_BPE)


_RULES = quality_rules.Rules()
_CLASS_PATTERNS = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09-\x0D", "symbol": "#*$%&|<>", "beyond_ascii": r"\x{80}-\x{10FFFF}"}
_CLASS_SQL = ", ".join(f"length(regexp_replace(t, '[^{members}]', '', 'g')) AS c_{name}" for name, members in _CLASS_PATTERNS.items())
_CLASS_NAMES = [f"c_{name}" for name in _CLASS_PATTERNS] + ["c_other"]
_PLOGP = "CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"


def _distance(p: str, q: str) -> str:
    return f"({_PLOGP.format(p=p, q=q)} + {_PLOGP.format(p=q, q=p)}) / 2"


QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
s AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, {_CLASS_SQL} FROM d),
f AS (SELECT *, len(words) AS n_words, length(t) - c_space AS word_chars, c_symbol AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        length(t) - c_lower - c_upper - c_digit - c_space - c_symbol - c_beyond_ascii AS c_other FROM s),
w AS (SELECT doc_id, lang, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM f),
g AS (SELECT doc_id, i, CASE WHEN count(*) OVER v = {quality_rules.WINDOW} THEN list(word) OVER v END AS window_words
      FROM w WINDOW v AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {quality_rules.WINDOW - 1} FOLLOWING)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, window_words) AS n FROM g WHERE window_words IS NOT NULL),
e AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(i, i + {quality_rules.WINDOW})) AS j FROM r WHERE n > 1) GROUP BY doc_id),
l AS (SELECT lang, sum(n_words) AS words, {', '.join(f'sum({c}) AS {c}' for c in _CLASS_NAMES)} FROM f GROUP BY lang),
k AS (SELECT * FROM l WHERE words > 0),
c AS (SELECT lang, word, count(*) AS n, any_value(k.words) AS words FROM w JOIN k USING (lang) GROUP BY lang, word HAVING count(*) >= {_RULES.common_share} * any_value(k.words)),
q AS (SELECT lang, word, n / words AS q FROM c UNION ALL SELECT lang, NULL, 1 - sum(n) / any_value(words) FROM c GROUP BY lang),
o AS (SELECT f.doc_id, q.word, q.q, count(w.word) / any_value(f.n_words) AS p
      FROM f JOIN q USING (lang) LEFT JOIN w ON w.doc_id = f.doc_id AND w.word = q.word
      WHERE f.n_words >= {_RULES.word_min} GROUP BY f.doc_id, q.word, q.q),
o2 AS (SELECT doc_id, word, q, CASE WHEN word IS NULL THEN 1 - sum(p) OVER (PARTITION BY doc_id) ELSE p END AS p FROM o),
wd AS (SELECT doc_id, sqrt(greatest(sum({_distance('p', 'q')}), 0)) AS word_divergence FROM o2 GROUP BY doc_id),
h AS (SELECT f.doc_id, f.{', f.'.join(_CLASS_NAMES)}, length(f.t) AS chars, {', '.join(f'k.{c} AS k_{c}' for c in _CLASS_NAMES)},
        ({' + '.join(f'k.{c}' for c in _CLASS_NAMES)}) AS k_chars FROM f JOIN k USING (lang) WHERE length(f.t) >= {_RULES.char_min}),
cd AS (SELECT doc_id, sqrt(greatest({' + '.join(_distance(f'({c} / chars)', f'(k_{c} / k_chars)') for c in _CLASS_NAMES)}, 0)) AS char_divergence FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_words < {_RULES.min_words} OR 100 * coalesce(n_repeat_words, 0) > {_RULES.max_repeat_percent} * n_words AS base_failed,
    CAST(round(char_divergence * 1e6) AS BIGINT) AS char_millionths, CAST(round(word_divergence * 1e6) AS BIGINT) AS word_millionths,
    NOT (n_words < {_RULES.min_words} OR 100 * coalesce(n_repeat_words, 0) > {_RULES.max_repeat_percent} * n_words)
        AND coalesce(char_divergence <= {_RULES.char_limit}, true) AND coalesce(word_divergence <= {_RULES.word_limit}, true) AS kept
FROM f LEFT JOIN e USING (doc_id) LEFT JOIN cd USING (doc_id) LEFT JOIN wd USING (doc_id)
"""


@query("op2_distribution_rules", QUALITY_SQL)
def op2_distribution_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict of the divergence rules for every document."""
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round(F.col("char_divergence") * 1e6).cast("long").alias("char_millionths"),
        F.round(F.col("word_divergence") * 1e6).cast("long").alias("word_millionths"),
        "kept",
    )


def _escape_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for control in chat_format.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


def _marks_sql(slash: str) -> str:
    cases = " ".join(f"WHEN '{role}' THEN '[{slash}{mark}]'" for role, mark in chat_format.MARKS.items())
    other = f"'[/{chat_format.OTHER}]'" if slash else f"'[{chat_format.OTHER}]' || {_escape_sql('role')} || '{chat_format.COLON}'"
    return f"CASE role {cases} ELSE {other} END"


CHAT_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n FROM c),
s AS (SELECT *, length({_marks_sql('')} || {_escape_sql('text')} || {_marks_sql('/')}) AS chars FROM n),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) + {len(chat_format.OPEN + chat_format.CLOSE)} AS so_far FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i)) AS loss_sha256,
    CAST(sum(CASE WHEN role = 'assistant' OR i = n THEN so_far ELSE 0 END) AS BIGINT) AS formatted_chars,
    CAST(sum(CASE WHEN role = 'assistant' OR i = n THEN 1 ELSE 0 END) AS BIGINT) AS n_examples
FROM p GROUP BY conv_id
"""


@query("op3_prefix_targets", CHAT_SQL)
def op3_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of turns and targets, read back from the formatted examples of every conversation."""
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    examples = chat_format.prefix_targets(rows)
    turns = chat_format.turns_of(F.col("text"))
    as_text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id",
        F.struct("example", chat_format.target_of(examples).alias("target")).alias("target"),
        F.length("text").alias("chars"),
        F.when(F.col("last"), F.struct(F.size(turns).cast("long").alias("n"), F.sha2(as_text, 256).alias("sha"))).alias("turns"),
    )
    loss = F.array_join(F.transform(F.sort_array(F.collect_list("target")), lambda t: t["target"]), "")
    found = read.groupBy("conv_id").agg(
        loss.alias("loss"), F.sum("chars").alias("formatted_chars"), F.max("turns").alias("turns"), F.count("*").alias("n_examples")
    )
    return found.select(
        "conv_id", F.col("turns.n").alias("n_turns"), F.col("turns.sha").alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples",
    )


@query("op5_sum_of_squares")
def op5_sum_of_squares(spark: SparkSession, folder: str) -> DataFrame:
    """Places of all pieces of all documents; no SQL (a tokenizer), tested against the tokenizer and exact bounds."""
    packed = packing.pack(table(spark, folder, "documents"), WORD_BPE)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op8_boosted_quality")
def op8_boosted_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; no SQL (boosted trees), tested by held-out accuracy."""
    documents = table(spark, folder, "documents")
    forest = quality_model.train(documents, table(spark, folder, "labels"))
    return quality_model.score(documents, forest)


_BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
LINES_SQL = rf"""
WITH v AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
        '(?is)<(?:script|style)\b.*?</(?:script|style)\s*>', '', 'g'), '(?i)</?(?:{_BLOCKS})\b[^>]*>', chr(10), 'g') AS h FROM pages),
l AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
        string_split(regexp_replace(regexp_replace(h, '<[^>]*>', '', 'g'), '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g'), chr(10)) AS lines FROM v),
e AS (SELECT page_id, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l),
f AS (SELECT *, regexp_matches(line, '[^\x20\x09\x0B-\x0D]') AS visible FROM e),
t AS (SELECT host, count(*) AS pages FROM l GROUP BY host),
b AS (SELECT host, line FROM f JOIN t USING (host) WHERE visible GROUP BY host, line
      HAVING count(DISTINCT page_id) >= {line_dedup.MIN_PAGES} AND count(DISTINCT page_id) > {line_dedup.RATIO} * any_value(pages)),
r AS (SELECT f.*, b.line IS NOT NULL AND visible AS gone FROM f LEFT JOIN b ON f.host = b.host AND f.line = b.line)
SELECT page_id, host, coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '') AS text,
    CAST(sum(visible::INT) AS BIGINT) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped
FROM r GROUP BY page_id, host
"""


@query("op4_site_lines", LINES_SQL)
def op4_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Visible text of every page without the lines that its host repeats."""
    host, text = line_dedup.host_of(F.col("url")).alias("host"), line_dedup.visible_text(F.col("html")).alias("visible")
    pages = stage(table(spark, folder, "pages").select("page_id", host, text), "pages")
    cleaned = line_dedup.drop_boilerplate(pages, F.col("host"), F.col("visible"))
    return cleaned.select("page_id", "host", "cleaned.text", "cleaned.n_lines", "cleaned.n_dropped")


SPANS_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{span_dedup.SENTENCE}') AS s FROM documents),
e AS (SELECT doc_id, unnest(s) AS piece, generate_subscripts(s, 1) AS i, len(s) AS n FROM d),
w AS (SELECT *, trim(piece, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS sentence,
        len(regexp_extract_all(piece, '[^\x20\x09-\x0D]+')) AS words FROM e),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto, sum(words) OVER (PARTITION BY doc_id) AS total FROM w),
ends AS (SELECT doc_id, upto, min(i) AS stop FROM c GROUP BY doc_id, upto),
heads AS (SELECT doc_id, i, upto - words + {span_dedup.MIN_WORDS} AS target FROM c WHERE upto - words + {span_dedup.MIN_WORDS} <= total),
k AS (SELECT heads.doc_id, i, stop FROM heads ASOF JOIN ends ON heads.doc_id = ends.doc_id AND heads.target <= ends.upto
      UNION SELECT heads.doc_id, max(heads.i), any_value(n) FROM heads JOIN e USING (doc_id) GROUP BY heads.doc_id),
r AS (SELECT k.doc_id, k.i, k.stop, list(sentence ORDER BY c.i) AS run FROM k JOIN c ON c.doc_id = k.doc_id AND c.i BETWEEN k.i AND k.stop GROUP BY ALL),
o AS (SELECT *, first_value(doc_id) OVER v AS doc1, first_value(i) OVER v AS i1 FROM r WINDOW v AS (PARTITION BY run ORDER BY doc_id, i)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, stop + 1)) AS i FROM o WHERE doc_id <> doc1 OR i <> i1)
SELECT d.doc_id, CASE WHEN any_value(len(d.s)) = 0 THEN '' ELSE coalesce(string_agg(CASE WHEN g.i IS NULL THEN e.piece END, '' ORDER BY e.i), '') END AS text,
    any_value(len(d.s)) AS n_sentences, count(g.i) AS n_removed
FROM d LEFT JOIN e USING (doc_id) LEFT JOIN g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY d.doc_id
"""


@query("op10_sentence_spans", SPANS_SQL)
def op10_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that occurred before."""
    return span_dedup.drop_repeated_spans(table(spark, folder, "documents"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), {decontaminate.WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {decontaminate.WINDOW}) + 2)) AS i, w FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM bw),
sizes AS (SELECT DISTINCT n FROM q),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
r AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS run FROM dw),
m AS (SELECT doc_id, item_id, i, n FROM r JOIN q USING (n, run)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op6_positional_index", DECONTAMINATION_SQL)
def op6_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@query("op7_order_filters")
def op7_order_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Components of similar documents; no SQL (components), tested against brute force."""
    return ngram_join.similar_components(table(spark, folder, "documents"), width=4, percent=85)


_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(license_scan.TEMPLATES))
_TERMS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
LICENSE_SQL = f"""
WITH t AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS v(i, license, text)),
tt AS (SELECT i, term, count(*) AS tf FROM (SELECT i, unnest({_TERMS.format(text='text')}) AS term FROM t) GROUP BY i, term),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
lt AS (SELECT doc_id, n, {_TERMS.format(text='line')} AS terms FROM l),
li AS (SELECT doc_id, n, terms, n = max(n) OVER (PARTITION BY doc_id) AS last_line FROM lt WHERE len(terms) > 0),
e AS (SELECT doc_id, n, unnest(terms) AS term FROM li),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM e GROUP BY doc_id, n, term),
total AS (SELECT count(*) AS lines FROM li),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM tt) GROUP BY term),
w AS (SELECT term, ln((1.0 + (SELECT lines FROM total)) / (1 + coalesce(df, 0))) + 1 AS w FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term)),
o AS (SELECT ln((1.0 + lines) / 2) + 1 AS w FROM total),
norms AS (SELECT doc_id, n, sqrt(sum((tf * coalesce(w.w, (SELECT w FROM o))) * (tf * coalesce(w.w, (SELECT w FROM o))))) AS size FROM tf LEFT JOIN w USING (term) GROUP BY doc_id, n),
tn AS (SELECT i, sqrt(sum(tf * w * tf * w)) AS size FROM tt JOIN w USING (term) GROUP BY i),
dots AS (SELECT doc_id, n, tt.i, sum(tf.tf * w.w * tt.tf * w.w) AS dot FROM tf JOIN tt USING (term) JOIN w USING (term) GROUP BY doc_id, n, tt.i),
c AS (SELECT doc_id, n, i, dot / (norms.size * tn.size) AS cosine FROM dots JOIN norms USING (doc_id, n) JOIN tn USING (i)),
k AS (SELECT doc_id, n, i, cosine, row_number() OVER (PARTITION BY doc_id ORDER BY round(cosine, 9) DESC, n, i) AS best FROM c WHERE cosine >= {license_scan.THRESHOLD}),
own AS (SELECT d.doc_id, d.source, d.lang, d.n_chars // 1000 AS bucket, t.license, k.cosine, li.last_line
        FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id AND k.best = 1 LEFT JOIN t USING (i) LEFT JOIN li ON li.doc_id = d.doc_id AND li.n = k.n),
dirs AS (SELECT *, CASE WHEN last_line AND bucket = 0 THEN source WHEN last_line THEN source || '/' || lang
        ELSE source || '/' || lang || '/' || CAST(bucket AS VARCHAR) END AS dir FROM own),
g AS (SELECT dir, license, max(cosine) AS cosine FROM dirs WHERE last_line GROUP BY dir, license),
declared AS (SELECT dir, license AS granted FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY round(cosine, 9) DESC, license) AS r FROM g) WHERE r = 1)
SELECT doc_id, dirs.dir || '/' || CASE WHEN last_line THEN 'LICENSE-' ELSE '' END || CAST(doc_id AS VARCHAR) || '.txt' AS path, license,
    CAST(round(cosine * 1e6) AS BIGINT) AS cosine_millionths, coalesce(license, near.granted, far.granted) AS effective_license,
    CASE WHEN license IS NOT NULL THEN 'own' WHEN coalesce(near.granted, far.granted) IS NOT NULL THEN 'inherited' END AS origin
FROM dirs LEFT JOIN declared AS near ON near.dir = source || '/' || lang LEFT JOIN declared AS far ON far.dir = source
"""


@query("op9_license_scan", LICENSE_SQL)
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents, own and inherited.

    Documents have no paths, so a path is derived: source / language / thousands of characters / file.  A document that ends with a
    licence line is taken as a licence file of its language, or, if it has less than a thousand characters, of its source.
    """
    documents = table(spark, folder, "documents")
    found = license_scan.headers(documents, keep=["source", "lang", "n_chars"])
    found = found.withColumn("cosine", F.round("cosine", 9)).withColumn("bucket", F.floor(F.col("n_chars") / 1000))
    file = F.concat(F.when(F.col("last_line"), "LICENSE-").otherwise(""), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    deep = F.when(F.col("last_line").isNull() | ~F.col("last_line"), F.col("bucket").cast("string"))
    wide = F.when(F.col("last_line").isNull() | ~F.col("last_line") | (F.col("bucket") > 0), F.col("lang"))
    files = found.select("doc_id", F.concat_ws("/", "source", wide, deep, file).alias("path"), "license", "cosine")
    out = license_scan.inherit(files, F.col("path"))
    return out.select("doc_id", "path", "license", F.round(F.col("cosine") * 1e6).cast("long").alias("cosine_millionths"), "effective_license", "origin")


_CRC_BITS = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
_CRC = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))), lambda c, b: {_CRC_BITS}), 4294967295)"
RUNS_SQL = rf"""
WITH d AS (SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o FROM documents),
g AS (SELECT *, len(o) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN o[a + (i - a) % p + 1] ELSE o[i + 1] END) ELSE o END AS words FROM p),
e AS (SELECT doc_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM w),
m AS (SELECT y.doc_id, y.i, y.i - x.i AS lag FROM e AS x JOIN e AS y ON x.doc_id = y.doc_id AND x.word = y.word
      WHERE y.i > x.i AND {periodic_runs.MIN_PERIODS} * (y.i - x.i) <= y.n),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS diagonal FROM m),
l AS (SELECT doc_id, lag, min(i) - lag AS start, count(*) + lag AS length FROM s GROUP BY doc_id, lag, diagonal
      HAVING count(*) + lag >= greatest({periodic_runs.MIN_LENGTH}, {periodic_runs.MIN_PERIODS} * lag)),
r AS (SELECT doc_id, start, length, min(lag) AS period FROM l GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs,
        min(struct_pack(a := -length, b := start, c := period)) AS best FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept FROM e ANTI JOIN x ON e.doc_id = x.doc_id AND e.i = x.i GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, best.b AS start, -best.a AS length, best.c AS period, 1000 * -best.a // best.c AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, by a checksum of their id, repeat a stretch of their words to the end."""
    hashed = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    parts = hashed.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), chosen.alias("words")).withColumn("n", F.size("words"))
    parts = parts.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    parts = parts.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.expr("cast(1 + (n - a) div p as int)")))
    spelled = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), F.lit(1), F.col("n")), " ")
    return parts.select("doc_id", F.when(F.col("n") > 0, spelled).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", RUNS_SQL)
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, of which a tenth get one planted, and what is left when only the first period of each stays."""
    found = periodic_runs.collapse(_with_planted_runs(table(spark, folder, "documents")), with_text=False)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("minus"), (-r["period"]).alias("period"))))
    best = found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.minus")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), "runs_sha256", "collapsed_sha256",
    )
    return best.withColumn("exponent_milli", F.expr("(1000 * length) div period"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLLOCATIONS_SQL = rf"""
WITH t AS (SELECT coalesce(lang, '{collocations.UNKNOWN_LANGUAGE}') AS lang, string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
g AS (SELECT lang, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM p, (SELECT unnest(range(1, {collocations.DEPTH + 1})) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n FROM g GROUP BY ALL),
total AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= {collocations.MIN_COUNT}),
cuts AS (SELECT lang, phrase, k, n AS a, w, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT cuts.lang, cuts.phrase, a, cut, x.n AS l, y.n AS r, CAST(2000000 AS HUGEINT) * a // (x.n + y.n) AS score
      FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:cut], ' ')
                JOIN f AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[cut + 1:], ' ')),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM s) WHERE place = 1),
inner_k AS (SELECT lang, w, k, n, unnest(range(2, k)) AS m FROM c),
inner_i AS (SELECT lang, w, n, m, unnest(range(1, k - m + 2)) AS i FROM inner_k),
covers AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(n) AS most FROM inner_i GROUP BY ALL),
own AS (SELECT lowest.* FROM lowest LEFT JOIN covers USING (lang, phrase) WHERE 100 * coalesce(most, 0) < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM own)
SELECT lang, rank, phrase, a, l, r, CAST(total.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", COLLOCATIONS_SQL)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; no SQL (boosted trees), tested by held-out labels."""
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, folder, "labels")))
