"""The registered queries of this subpackage, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, classifier, decontaminate, language, licenses, neardup, packing, periods, quality, rollups, substrings, turns, urls
from .arrays import table
from .tables import written


def vocabulary() -> str:
    """Place of the tokenizer file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks() -> str:
    """Place of the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
sizes AS (SELECT DISTINCT least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS k, list_slice(w, i, i + least(10, len(w)) - 1) AS g FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT k, min(doc_id) AS first_doc FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (k) WHERE doc_id > first_doc),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
"""


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(list_slice(w, i, i + least(5, len(w)) - 1)) AS g, least(5, len(w)) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.node = d.doc_id LEFT JOIN n USING (doc_id)
"""


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, field)
    return found.select("doc_id", F.coalesce(language.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), ranks())


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(rows))


OP6_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|')) + len(regexp_extract_all(role, '<\\*\|')) + 5 * len(regexp_extract_all(role, chr(10)))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def _rollups(spark: SparkSession, sf_dir: str, counts: DataFrame) -> DataFrame:
    """Three batches and one of them again: all documents come, toxic ones go, and of those labelled as of low quality the words are
    counted anew, with marks as tokens of their own."""
    marked = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    first = counts.where("tokenizer_version <> 'words-2'")
    poor = counts.join(marked.where("toxic = 0 and quality = 0"), "doc_id", "left_semi")
    ledger = rollups.Ledger(spark)
    ledger.commit("1-all", rollups.inserts(first))
    for _ in range(2):  # as a retry would
        ledger.commit("2-toxic", rollups.deletes(first.join(marked.where("toxic = 1"), "doc_id", "left_semi")))
    ledger.compact()
    ledger.commit("3-poor", rollups.revisions(poor.where("tokenizer_version = 'words-1'"), poor.where("tokenizer_version = 'words-2'")))
    return ledger.totals()


def op2_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a byte-level BPE vocabulary, bytes and words."""
    docs = table(spark, sf_dir, "documents")
    return _rollups(spark, sf_dir, written(rollups.token_counts(docs).union(rollups.vocabulary_tokens(docs, vocabulary(), "byte-bpe-50k", ranks())), "counts"))


def rollups_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches of the tokenizers that are rules, which SQL can say."""
    return _rollups(spark, sf_dir, written(rollups.token_counts(table(spark, sf_dir, "documents")), "counts"))


#: The rows of the versions that SQL can say; those of the vocabulary are tested against its tokenizer.
OP2_SQL = r"""
WITH m AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT source, lang, coalesce(text, '') AS text, coalesce(toxic = 1, false) AS gone, coalesce(toxic = 0 AND quality = 0, false) AS poor FROM documents LEFT JOIN m USING (doc_id)),
t AS (SELECT source, lang, gone, poor, 'bytes-1' AS tokenizer_version, strlen(text) AS tokens FROM d
  UNION ALL SELECT source, lang, gone, poor, 'words-1', len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM d
  UNION ALL SELECT source, lang, gone, false, 'words-2', len(regexp_extract_all(text, '[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]')) FROM d WHERE poor),
s AS (SELECT *, NOT gone AND NOT (poor AND tokenizer_version = 'words-1') AS lives FROM t)
SELECT source, lang, tokenizer_version, CAST(sum(CASE WHEN lives THEN 1 ELSE 0 END) AS BIGINT) AS n_docs, CAST(sum(CASE WHEN lives THEN tokens ELSE 0 END) AS BIGINT) AS n_tokens
FROM s GROUP BY source, lang, tokenizer_version
"""


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents are taken for the pages of the same number: bad is toxic or of low quality."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.greatest("toxic", 1 - F.col("quality")).alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), labels)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.coalesce(classifier.held_out(), F.lit(False))
    found = classifier.classify(docs, classifier.train(docs, labels.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.collapse(table(spark, sf_dir, "documents"), damaged=True))


def _crc32(text: str) -> str:
    """The checksum of a text of ASCII characters, bit by bit."""
    bits = f"list_transform(range(8 * length({text})), lambda k: (ascii(substr({text}, CAST(k // 8 + 1 AS BIGINT), 1)) >> CAST(k % 8 AS INTEGER)) & 1)"
    return f"xor(list_reduce(list_transform({bits}, lambda b: CAST(b AS BIGINT)), lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), 4294967295::BIGINT), 4294967295::BIGINT)"


#: Windows of 2**k words are told by their hashes, each made of two of the level before; they suffice for periods up to this power of two.
_LEVELS = 15


def _levels() -> str:
    """Of each level the places where a window of m words is next found q words on, m/2 < q <= m: then q is the smallest period there."""
    out = []
    for k in range(_LEVELS):
        m = 1 << k
        if k:
            out.append(f"t{k} AS MATERIALIZED (SELECT doc_id, i, hash(g, {k}, h) AS g FROM (SELECT doc_id, i, g, lead(g, {m // 2}) OVER (PARTITION BY doc_id ORDER BY i) AS h FROM t{k - 1}) WHERE h IS NOT NULL)")
        out.append(f"c{k} AS (SELECT doc_id, i, q, {m} AS m FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, g ORDER BY i) - i AS q FROM t{k}) WHERE q <= {m} AND 2 * q > {m})")
    return ", ".join(out)


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, w, len(w) AS n, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents)),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, 3 + (h // 10) % 8 AS k FROM d),
x AS (SELECT doc_id, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END] AS word FROM (SELECT doc_id, w, n, a, k, unnest(range(n)) AS i FROM p)),
t0 AS MATERIALIZED (SELECT doc_id, i, hash(word) AS g FROM x), {_levels()},
c AS ({" UNION ALL ".join(f"SELECT * FROM c{k}" for k in range(_LEVELS))}),
r AS (SELECT doc_id, min(i) AS start, count(*) + q + m - 1 AS length, q AS period FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q, m ORDER BY i) AS island FROM c) GROUP BY doc_id, q, m, island HAVING count(*) + q + m - 1 >= greatest(6, 4 * q)),
s AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
b AS (SELECT doc_id, start, length, period FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turns.report(conversations, turns.damage(conversations))


def _step() -> str:
    """The best ways (cost as eight digits, a stroke, letters) to each state after one more turn; null where there is none. Costs are
    in the string's head, so the least string is the cheapest and of equal ones the ASCII-least."""
    plus = lambda way, cost, letter: f"(CASE WHEN {way} IS NOT NULL THEN lpad(CAST(CAST(left({way}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({way}, 9) || '{letter}' END)"
    least = lambda *ways: f"list_min([{', '.join(ways)}])"
    ready = f"SELECT *, {least('u0', plus('n0', 5, 'I'), plus('s0', 5, 'I'), plus('a0', 5, 'I'))} AS u1 FROM w"
    ready = f"SELECT *, {least('a0', plus('u1', 5, 'I'))} AS a1 FROM ({ready})"
    go = lambda way, cost, letter, to: f"CASE WHEN fault NOT IN (1, 2) AND {to} THEN {plus(way, f'{cost} + CASE fault WHEN 3 THEN 5 ELSE 0 END', letter)} END"
    keep = lambda way, c: go(way, 0, "K", f"initial = '{c}'")
    remade = lambda way: go(way, 1, "R", "true")
    to_u = [f(w) for w in ("n0", "s0", "a1") for f in (lambda w: keep(w, "u"), remade)]
    return f"""SELECT conv_id, place + 1 AS place, {plus('n0', 2, 'D')} AS n0, {least(plus('s0', 2, 'D'), keep('n0', 's'))} AS s0, {least(plus('u1', 2, 'D'), *to_u)} AS u0, {least(plus('a1', 2, 'D'), keep('u1', 'a'), remade('u1'))} AS a0
      FROM ({ready.replace('FROM w', 'FROM w JOIN f USING (conv_id, place)')})"""


_END = "CASE WHEN {0} IS NOT NULL THEN lpad(CAST(CAST(left({0}, 8) AS INTEGER) + {1} AS VARCHAR), 8, '0') || substr({0}, 9) || '{2}' END"

OP13_SQL = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind FROM conversations),
m AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM k, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM m),
f AS MATERIALIZED (SELECT conv_id, place, turn, role, text, left(role, 1) AS initial, CASE WHEN last = '' THEN 1 WHEN place > min(place) OVER (PARTITION BY conv_id, role, text) THEN 2 WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM (SELECT *, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last FROM o)),
w AS (SELECT DISTINCT conv_id, 0::BIGINT AS place, '00000000|' AS n0, NULL::VARCHAR AS s0, NULL::VARCHAR AS u0, NULL::VARCHAR AS a0 FROM f UNION ALL {_step()}),
e AS (SELECT conv_id, list_min([n0, a0, {_END.format('u0', 5, 'I')}, {_END.format('s0', 10, 'II')}]) AS way FROM w QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1),
z AS (SELECT conv_id, CAST(left(way, 8) AS BIGINT) AS cost, substr(way, 10) AS audit FROM e),
l AS (SELECT conv_id, i, substr(audit, i, 1) AS edit, CASE WHEN substr(audit, i, 1) <> 'I' THEN i - 1 - length(replace(substr(audit, 1, i), 'I', '_')) + length(replace(substr(audit, 1, i), 'I', '')) END AS place FROM z, unnest(range(1, length(audit) + 1)) AS x(i)),
g AS (SELECT l.conv_id, i, edit, role, text, count(*) OVER (PARTITION BY l.conv_id ORDER BY i) AS nth, max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS system FROM l LEFT JOIN f ON f.conv_id = l.conv_id AND f.place = l.place WHERE edit <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS repaired FROM g GROUP BY conv_id),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated FROM f GROUP BY conv_id),
j AS (SELECT conv_id, count(*) FILTER (WHERE place > 0 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id, place, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM f) GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN z USING (conv_id) LEFT JOIN h USING (conv_id) LEFT JOIN n USING (conv_id) LEFT JOIN j USING (conv_id)
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_rollups": op2_token_rollups,
    "rollups_of_rules": rollups_of_rules,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_filter": op5_url_filter,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_quality_rules": op10_quality_rules,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {"rollups_of_rules": OP2_SQL, "op4_decontaminate": OP4_SQL, "op6_chat_formatting": OP6_SQL, "op7_substring_dedup": OP7_SQL, "op9_near_duplicates": OP9_SQL, "op12_periodic_runs": OP12_SQL, "op13_conversation_repair": OP13_SQL}
