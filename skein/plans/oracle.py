"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the pre-registered parquet views. Regex classes are spelled exactly as
in ``skein.functions.text`` (RE2 and Java agree on the explicit Unicode classes).
"""

from __future__ import annotations

# ---- fixed values shared with skein.functions.text, RE2 spelling ----
WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]"
WS_CLASS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
NON_WORD = r"[^\p{L}\p{N}_]"
WORD_CLASS = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
EMAIL = r"[a-zA-Z0-9\-_.]+@[a-zA-Z0-9\-_.]+"
IPV4 = r"((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)(\.|$)){4}"
# ---------------------------------------------------------------------

COMMENTS = """comments AS (
  SELECT conv_id*100+turn AS pos,
    CASE WHEN (conv_id*5+turn) % 97 = 3 THEN NULL
         WHEN turn > 0 AND (conv_id*13+turn) % 29 = 0 THEN 'c'||lpad(CAST(conv_id*100+turn-1 AS VARCHAR), 12, '0')
         ELSE 'c'||lpad(CAST(conv_id*100+turn AS VARCHAR), 12, '0') END AS id,
    CASE WHEN (conv_id*11+turn) % 89 = 4 THEN NULL
         WHEN (conv_id*3+turn) % 31 = 7 THEN 't1_c'||lpad(CAST(conv_id*100+turn+1 AS VARCHAR), 12, '0')
         WHEN turn = 0 THEN 't3_p'||CAST(conv_id AS VARCHAR)
         ELSE 't1_c'||lpad(CAST(conv_id*100+CAST(floor((turn-1)/2.0) AS BIGINT) AS VARCHAR), 12, '0')
    END AS parent_id,
    CASE WHEN conv_id % 37 = 11 THEN NULL WHEN conv_id % 10 = 9 THEN 'n'||CAST(conv_id % 7 AS VARCHAR)
         ELSE 's'||CAST(conv_id % 7 AS VARCHAR) END AS subreddit,
    CASE WHEN conv_id % 41 = 5 THEN NULL ELSE 't5_'||CAST(conv_id % 7 AS VARCHAR) END AS subreddit_id,
    role AS author,
    CASE WHEN (conv_id*7+turn) % 11 = 0 THEN '[deleted]' ELSE text END AS body
  FROM conversations)"""


def trim_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def pkey(x: str = "parent_id") -> str:
    return f"substr({x}, instr({x}, '_') + 1)"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')"


PREP = f"""prep AS (
  SELECT pos, id, {pkey()} AS parent_id, author, subreddit, subreddit_id, {trim_ws('body')} AS body
  FROM comments WHERE body IS DISTINCT FROM '[deleted]')"""

VERIFIED = """firstpos AS (SELECT id, min(pos) AS fpos FROM prep WHERE id IS NOT NULL GROUP BY id),
vp AS (SELECT c.pos, c.id, c.parent_id FROM prep c JOIN firstpos f ON f.id = c.parent_id AND f.fpos < c.pos)"""

TRAINING_PAIRS = f"""WITH {COMMENTS}, {PREP}, {VERIFIED},
ids AS (SELECT id FROM vp UNION SELECT parent_id FROM vp),
p2 AS (SELECT * FROM prep SEMI JOIN ids ON prep.id IS NOT DISTINCT FROM ids.id)
SELECT c.pos, c.id, c.parent_id, p.pos AS parent_pos, p.body AS parent_body, c.body AS reply_body
FROM p2 c ASOF JOIN p2 p ON p.id = c.parent_id AND c.pos >= p.pos"""

ORACLE: dict[str, str] = {
    "training_pairs": TRAINING_PAIRS,
}


# ---------------------------------------------------------------- helpers

def keep_alnum(x: str) -> str:
    return f"regexp_replace({x}, '{NON_WORD}+', ' ', 'g')"


def strip_digits(x: str) -> str:
    return f"regexp_replace({x}, '{DIGIT}+', ' ', 'g')"


def preprocess_full(x: str) -> str:
    return lower(trim_ws(strip_digits(keep_alnum(x))))


def lower(x: str) -> str:
    return f"lower({x})"


def clean_labelled(x: str) -> str:
    s = f"regexp_replace(lower({x}), '{EMAIL}', '', 'g')"
    s = f"regexp_replace({s}, '{IPV4}', '', 'g')"
    s = f"regexp_replace({s}, '[^{WORD_CLASS}{WS_CLASS}]', '', 'g')"
    return f"regexp_replace({s}, '{DIGIT}', '', 'g')"


def vocab_sql(src: str, min_count: int = 1) -> str:
    """CTEs ex, agg, fi, voc over a CTE ``src(pos, t)`` of token lists."""
    having = f"HAVING count(*) >= {min_count}" if min_count > 1 else ""
    return f"""ex AS (SELECT pos, unnest(t) AS word, unnest(range(len(t))) AS i FROM {src}),
agg AS (SELECT word, count(*) AS count, min(pos) AS fp FROM ex GROUP BY word {having}),
fi AS (SELECT e.word, min(e.i) AS fi FROM ex e JOIN agg a ON a.word = e.word AND e.pos = a.fp GROUP BY e.word),
voc AS (SELECT a.word, row_number() OVER (ORDER BY a.fp, fi.fi) - 1 AS index, a.count
        FROM agg a JOIN fi ON fi.word = a.word)"""


DOC_TOKENS = f"src AS (SELECT doc_id AS pos, {tokens(preprocess_full('text'))} AS t FROM documents)"
R_CTE = f"r AS (SELECT pos, id, parent_id, author, body, {pkey()} AS k FROM base WHERE instr(parent_id, '_c') > 0)"
RP_SELECT = """SELECT c.pos, c.id, c.parent_id, c.author, c.body, p.pos AS p_pos, p.id AS p_id,
       p.parent_id AS p_parent_id, p.author AS p_author, p.body AS p_body
FROM r c ASOF JOIN r p ON p.id = c.k AND c.pos >= p.pos"""
STOP = "(SELECT min(event_id) FROM events WHERE NOT coalesce(value < 300, false))"
UNPIVOT = """(UNPIVOT (SELECT pos, id, parent_id, subreddit, subreddit_id, author, body FROM comments)
   ON id, parent_id, subreddit, subreddit_id, author, body INTO NAME field VALUE val)"""
BODY_PAIRS_ON = """SELECT c.pos, c.id, c.parent_id, p.pos AS parent_pos, p.body AS parent_body, c.body AS reply_body
FROM {t} c ASOF JOIN {t} p ON p.id = c.parent_id AND c.pos >= p.pos"""


def _doc_text(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS text FROM documents"


ORACLE.update({
    # ---- pairs
    "pairs_tsv": f"""WITH {COMMENTS}, {PREP}, {VERIFIED},
ids AS (SELECT id FROM vp UNION SELECT parent_id FROM vp),
p2 AS (SELECT * FROM prep SEMI JOIN ids ON prep.id IS NOT DISTINCT FROM ids.id)
SELECT c.pos, p.body || chr(9) || c.body AS line
FROM p2 c ASOF JOIN p2 p ON p.id = c.parent_id AND c.pos >= p.pos""",
    "parent_key": f"WITH {COMMENTS} SELECT id, {pkey()} AS parent_key FROM comments",
    "list_pairs": f"WITH {COMMENTS} SELECT pos, id, {pkey()} AS parent_id FROM comments WHERE instr(parent_id, '_c') > 0",
    "list_pairs_raw": f"WITH {COMMENTS} SELECT pos, id, parent_id FROM comments WHERE instr(parent_id, '_c') > 0",
    "verified_pairs": f"WITH {COMMENTS}, {PREP}, {VERIFIED} SELECT pos, id, parent_id FROM vp",
    "paired_ids": f"WITH {COMMENTS}, {PREP}, {VERIFIED} SELECT id FROM vp UNION SELECT parent_id FROM vp",
    "body_pairs": f"WITH {COMMENTS}, {PREP} " + BODY_PAIRS_ON.format(t="prep"),
    "record_pairs": f"WITH {COMMENTS}, base AS (SELECT * FROM comments), {R_CTE} {RP_SELECT}",
    "count_reply_pairs": f"""WITH {COMMENTS}, base AS (SELECT * FROM comments WHERE body IS DISTINCT FROM '[deleted]'),
{R_CTE}, pairs AS ({RP_SELECT}) SELECT count(*) AS n_pairs FROM pairs""",
    "direct_replies": f"""WITH {COMMENTS} SELECT p.id, p.pos, r.id AS reply_id, r.pos AS reply_pos
FROM comments p JOIN comments r ON {pkey('r.parent_id')} = p.id""",
    "pair_preprocess": f"""WITH {COMMENTS},
pp AS (SELECT pos, id, {pkey()} AS parent_id, {trim_ws('lower(body)')} AS body FROM comments
       WHERE body IS DISTINCT FROM '[deleted]' AND author = 'user'),
prep AS (SELECT * FROM pp WHERE length(body) >= 20) """ + BODY_PAIRS_ON.format(t="prep"),
    # ---- text
    "trim_whitespace": _doc_text(trim_ws("text")),
    "strip_digits": _doc_text(strip_digits("text")),
    "to_lower": _doc_text("lower(text)"),
    "strip_emails": _doc_text(f"regexp_replace(text, '{EMAIL}', '', 'g')"),
    "strip_ips": _doc_text(f"regexp_replace(text, '{IPV4}', '', 'g')"),
    "remove_specials": _doc_text(f"regexp_replace(text, '[^{WORD_CLASS}{WS_CLASS}]', '', 'g')"),
    "remove_digits": _doc_text(f"regexp_replace(text, '{DIGIT}', '', 'g')"),
    "keep_alnum": f"SELECT page_id, {keep_alnum('html')} AS html FROM pages",
    "tokenize": f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)""",
    "preprocess_full": f"""WITH {DOC_TOKENS}
SELECT pos AS doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens FROM src""",
    "text_length": f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS length,
CAST(len({tokens('text')}) AS BIGINT) AS n_words FROM documents""",
    "clean_labelled": f"""SELECT doc_id AS "index", {clean_labelled('text')} AS "Sentence" FROM documents""",
    # ---- rows and predicates
    "map_project": "SELECT event_id, round((value + 2) * 3, 6) AS value, upper(event_type) AS event_type FROM events",
    "flat_map_range": """SELECT event_id, CAST(unnest(range(event_id % 4)) AS INTEGER) AS elem,
unnest(range(event_id % 4)) AS value FROM events""",
    "flat_map_tokens": f"""SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS elem, unnest(t) AS token
FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)""",
    "filter_rows": "SELECT event_id, event_type, value FROM events WHERE event_type = 'click' AND value > 10",
    "wrap_field": f"WITH {COMMENTS} SELECT id, {keep_alnum('body')} AS body FROM comments",
    "compose_chain": _doc_text(trim_ws(f"lower({keep_alnum('text')})")),
    "with_computed": "SELECT event_id, user_id, user_id * 2 + 1 AS computed FROM events",
    "strip_fields": f"WITH {COMMENTS} SELECT pos, id, parent_id, subreddit_id, body FROM comments",
    "keep_fields": f"WITH {COMMENTS} SELECT id, body FROM comments",
    "peek_observe": "SELECT count(*) AS n, max(event_id) AS max_id, CAST(sum(user_id) AS BIGINT) AS users FROM events",
    "foreach_rows": "SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events",
    "keep_groups": f"WITH {COMMENTS} SELECT pos, id, subreddit FROM comments WHERE subreddit IN ('s1', 's3')",
    "strip_groups": f"""WITH {COMMENTS} SELECT pos, id, subreddit FROM comments
WHERE NOT coalesce(subreddit IN ('s1', 's3'), false)""",
    "strip_groups_null": f"""WITH {COMMENTS} SELECT pos, id, subreddit FROM comments
WHERE subreddit IS NOT NULL AND subreddit NOT IN ('s1', 's3')""",
    "keep_groups_null": f"""WITH {COMMENTS} SELECT pos, id, subreddit FROM comments
WHERE subreddit IS NULL OR subreddit = 's1'""",
    "not_deleted": f"WITH {COMMENTS} SELECT pos, id FROM comments WHERE body IS DISTINCT FROM '[deleted]'",
    "on_comment": f"WITH {COMMENTS} SELECT pos, id FROM comments WHERE instr(parent_id, '_c') > 0",
    "min_length": "SELECT doc_id FROM documents WHERE length(text) >= 1000",
    "max_length": "SELECT doc_id FROM documents WHERE length(text) <= 500",
    # ---- ordered
    "take_n": "SELECT event_id AS pos, event_id, event_type FROM events ORDER BY event_id LIMIT 100",
    "drop_n": "SELECT event_id AS pos, event_id FROM events ORDER BY event_id OFFSET 1000",
    "drop_ties": """SELECT user_id AS pos, count(*) AS n FROM (SELECT CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END
AS user_id FROM events ORDER BY user_id NULLS FIRST OFFSET 777) GROUP BY user_id""",
    "take_while": f"SELECT event_id AS pos, value FROM events WHERE {STOP} IS NULL OR event_id < {STOP}",
    "drop_while": f"SELECT event_id AS pos, value FROM events WHERE event_id >= {STOP}",
    "read_max": f"WITH {COMMENTS} SELECT pos, id FROM comments ORDER BY pos LIMIT 100",
    "process_max": f"""WITH {COMMENTS}, t AS (SELECT * FROM comments WHERE body IS DISTINCT FROM '[deleted]'
ORDER BY pos LIMIT 100) SELECT pos, id, subreddit FROM t WHERE NOT coalesce(subreddit IN ('s1'), false)""",
    "concat_streams": """SELECT event_id AS pos, event_id, event_type, 0 AS src FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id AS pos, event_id, event_type, 1 AS src FROM events
WHERE event_type IS DISTINCT FROM 'click'""",
    "distinct_first": "SELECT user_id, min(event_id) AS first_pos FROM events GROUP BY user_id",
    "count_rows": "SELECT count(*) AS n FROM events",
    "reduce_sum": "SELECT CAST(4 + sum(user_id) AS BIGINT) AS result FROM events",
    "reduce_ordered": "SELECT user_id AS key, arg_min(event_type, event_id) AS value FROM events GROUP BY user_id",
    "to_dict_last": "SELECT user_id AS key, arg_max(event_type, event_id) AS value FROM events GROUP BY user_id",
    "to_dict_merge": """SELECT event_type AS key, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS value
FROM events GROUP BY event_type""",
    "to_set": "SELECT DISTINCT event_type FROM events",
    "to_list": "SELECT row_number() OVER (ORDER BY event_id) - 1 AS index, event_id AS value FROM events",
    "to_string": """WITH l AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS index, CAST(user_id AS VARCHAR) AS value
FROM events), m AS (SELECT max(index) AS mx FROM l)
SELECT index, CASE WHEN index < mx THEN value || ':' ELSE value END AS piece FROM l, m""",
    "reduce_concat": """SELECT event_type, string_agg(CAST(event_id % 10 AS VARCHAR), '' ORDER BY event_id) AS result
FROM events GROUP BY event_type""",
    "reduce_concat_all": "SELECT string_agg(CAST(user_id % 10 AS VARCHAR), '' ORDER BY event_id) AS result FROM events",
    # ---- statistics
    "summary_totals": f"""WITH {COMMENTS}, c AS (SELECT *, coalesce(starts_with({pkey()}, 'c'), false) AS is_pair FROM comments)
SELECT count(*) AS comments, count(*) FILTER (WHERE body = '[deleted]') AS deleted,
count(*) FILTER (WHERE NOT is_pair) AS posts, count(*) FILTER (WHERE is_pair) AS pairs,
count(DISTINCT subreddit_id) + max(CASE WHEN subreddit_id IS NULL THEN 1 ELSE 0 END) AS subreddits FROM c""",
    "summary_groups": f"""WITH {COMMENTS} SELECT subreddit_id, count(*) AS n, arg_min_null(subreddit, pos) AS subreddit,
min(pos) AS first_pos FROM comments GROUP BY subreddit_id""",
    "inconsistent_names": f"""WITH {COMMENTS}, f AS (SELECT subreddit_id, arg_min_null(subreddit, pos) AS first_name
FROM comments GROUP BY subreddit_id)
SELECT c.subreddit_id, c.pos, c.subreddit, f.first_name FROM comments c
JOIN f ON f.subreddit_id IS NOT DISTINCT FROM c.subreddit_id
WHERE c.subreddit IS DISTINCT FROM f.first_name""",
    "group_counts": f"WITH {COMMENTS} SELECT subreddit, count(*) AS n FROM comments GROUP BY subreddit",
    "list_fields": f"WITH {COMMENTS} SELECT DISTINCT field FROM {UNPIVOT}",
    "count_fields": f"WITH {COMMENTS} SELECT field, count(*) AS n, min(pos) AS first_pos FROM {UNPIVOT} GROUP BY field",
    "count_field_values": f"""WITH {COMMENTS} SELECT field, 'STRING' AS value_type, val AS value, count(*) AS n
FROM {UNPIVOT} GROUP BY field, val""",
    "json_scan": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    # ---- vocabulary
    "vocab": f"WITH {DOC_TOKENS}, {vocab_sql('src')} SELECT word, index, count FROM voc",
    "encode": f"""WITH {DOC_TOKENS}, {vocab_sql('src')},
enc AS (SELECT e.pos, string_agg(CAST(v.index AS VARCHAR), ' ' ORDER BY e.i) AS codes, count(*) AS n
        FROM ex e JOIN voc v ON v.word = e.word GROUP BY e.pos)
SELECT s.pos AS doc_id, CAST(coalesce(enc.n, 0) AS BIGINT) AS n_codes, coalesce(enc.codes, '') AS codes
FROM src s LEFT JOIN enc ON enc.pos = s.pos""",
    "vocab_by_count": f"""WITH {DOC_TOKENS}, {vocab_sql('src')}
SELECT word, index, count, row_number() OVER (ORDER BY count DESC, index) - 1 AS rank FROM voc""",
    "vocab_by_word": f"""WITH {DOC_TOKENS}, {vocab_sql('src')}
SELECT word, index, count, row_number() OVER (ORDER BY word, index) - 1 AS rank FROM voc""",
    "vocab_by_index": f"""WITH {DOC_TOKENS}, {vocab_sql('src')} SELECT word, index, count, index AS rank FROM voc""",
    "vocab_by_word_reversed": f"""WITH {DOC_TOKENS}, {vocab_sql('src')}
SELECT word, index, count, row_number() OVER (ORDER BY word DESC, index) - 1 AS rank FROM voc""",
    "vocab_lookup_index": f"""WITH {DOC_TOKENS}, {vocab_sql('src')},
k AS (SELECT DISTINCT n_chars AS index FROM documents)
SELECT k.index, v.word, v.count FROM k LEFT JOIN voc v ON v.index = k.index""",
    "vocab_brief": f"""WITH {DOC_TOKENS}, {vocab_sql('src')}
SELECT count(*) AS vocab_size, CAST(sum(count) AS BIGINT) AS total_words FROM voc""",
    "vocab_lookup": f"""WITH {DOC_TOKENS}, {vocab_sql('src')},
b AS (SELECT DISTINCT unnest({tokens(preprocess_full('text'))}) AS word FROM benchmark)
SELECT b.word, v.index, v.count FROM b LEFT JOIN voc v ON v.word = b.word""",
    "char_vocab": f"""WITH {COMMENTS}, src AS (SELECT pos, regexp_extract_all(body, '(?s).') AS t FROM comments),
{vocab_sql('src')} SELECT word, index, count FROM voc""",
    "vocab_pruned": f"WITH {DOC_TOKENS}, {vocab_sql('src', 5)} SELECT word, index, count FROM voc",
    "vocab_by_group": f"""WITH src AS (SELECT doc_id AS pos, {tokens(preprocess_full('text'))} AS t FROM documents
WHERE lang = 'de'), {vocab_sql('src')} SELECT word, index, count FROM voc""",
})


# ---------------------------------------------------------------- threads

THREAD_CTES = f"""WITH RECURSIVE {COMMENTS},
nodes AS (SELECT c.pos, c.id, c.author, c.body, p.pos AS parent
          FROM comments c LEFT JOIN (SELECT id, min(pos) AS pos FROM comments GROUP BY id) p ON p.id = {pkey('c.parent_id')}),
anc(pos, apos) AS (SELECT pos, pos FROM nodes
                   UNION SELECT a.pos, n.parent FROM anc a JOIN nodes n ON n.pos = a.apos WHERE n.parent IS NOT NULL),
roots AS (SELECT pos, min(apos) AS root FROM anc GROUP BY pos),
tree AS (SELECT n.pos, n.id, n.author, n.body, r.root,
                CASE WHEN r.root = n.pos THEN NULL ELSE n.parent END AS up
         FROM nodes n JOIN roots r ON r.pos = n.pos),
walk(pos, root, level, path) AS (
  SELECT pos, root, 0, [pos] FROM tree WHERE up IS NULL
  UNION ALL SELECT t.pos, w.root, w.level + 1, list_append(w.path, t.pos)
  FROM walk w JOIN tree t ON t.up = w.pos),
placed AS (SELECT r.id AS root_id, w.root AS root_pos, t.id, w.pos, CAST(w.level AS BIGINT) AS level,
                  row_number() OVER (PARTITION BY w.root ORDER BY w.path) - 1 AS rank, t.author, t.body
           FROM walk w JOIN tree t ON t.pos = w.pos JOIN tree r ON r.pos = w.root)"""

ORACLE.update({
    "threads": f"""{THREAD_CTES} SELECT root_id, root_pos, id, pos, level, rank FROM placed""",
    "threads_limited": f"""{THREAD_CTES} SELECT root_id, root_pos, id, pos, level, rank FROM placed
WHERE root_pos IN (SELECT pos FROM tree WHERE up IS NULL ORDER BY pos LIMIT 20)""",
    "thread_transcript": f"""{THREAD_CTES} SELECT root_id, root_pos, rank,
  repeat('    ', level) || '- ' || coalesce(id, 'None') || ', ' || coalesce(author, 'None') || ':' || chr(10)
  || '  ' || repeat('    ', level) || coalesce({trim_ws('body')}, 'None') AS line FROM placed""",
    "group_by_parent": f"""WITH {COMMENTS}, g AS (SELECT parent_id, count(*) AS n, min(pos) AS first_pos FROM comments GROUP BY parent_id)
SELECT c.parent_id, c.pos, c.id, g.n, g.first_pos FROM comments c
JOIN g ON g.parent_id IS NOT DISTINCT FROM c.parent_id""",
})


# ---------------------------------------------------------------- featurizer

def _stop_list() -> str:
    from skein.operators.features import STOP_WORDS
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"


FEAT_CTES = f"""lab AS (SELECT d.doc_id AS idx, CAST(l.quality AS INTEGER) AS cls, {clean_labelled('d.text')} AS s0
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
st AS (SELECT idx, cls, array_to_string(list_filter({tokens('s0')}, lambda w: NOT list_contains({_stop_list()}, w)), ' ') AS s
       FROM lab),
sp AS (SELECT idx, cls, s, CASE WHEN row_number() OVER (ORDER BY md5('0:' || CAST(idx AS VARCHAR)), idx) - 1
                                     < ceil(0.1 * count(*) OVER ()) THEN 'validation' ELSE 'train' END AS split FROM st)"""
ALL_CTES = f"""lab AS (SELECT doc_id AS idx, {clean_labelled('text')} AS s0 FROM documents),
st AS (SELECT idx, array_to_string(list_filter({tokens('s0')}, lambda w: NOT list_contains({_stop_list()}, w)), ' ') AS s
       FROM lab)"""
GRAM_CTES = """tk AS (SELECT idx, regexp_extract_all(lower(s), '[\\p{L}\\p{N}_]{2,}') AS t FROM {src}),
gr AS (SELECT idx, unnest(list_concat(t, list_transform(range(greatest(len(t) - 1, 0)),
                                                      lambda i: t[i + 1] || ' ' || t[i + 2]))) AS term FROM tk),
tc AS (SELECT idx, term, count(*) AS tf FROM gr GROUP BY idx, term)"""
VOCAB_CTES = """ntr AS (SELECT count(*) AS n FROM sp WHERE split = 'train'),
st2 AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM tc
        WHERE idx IN (SELECT idx FROM sp WHERE split = 'train') GROUP BY term),
kept AS (SELECT st2.*, ntr.n FROM st2, ntr WHERE df <= 0.5 * n ORDER BY tf DESC, term LIMIT 50000),
voc AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_index, df, tf, n FROM kept)"""

ORACLE.update({
    "stopwords": f"""WITH {ALL_CTES} SELECT idx AS "index", s AS "Sentence" FROM st""",
    "train_val_split": f"""WITH {FEAT_CTES} SELECT idx AS "index", split FROM sp""",
    "ngrams": f"""WITH {ALL_CTES}, {GRAM_CTES.replace('{src}', 'st')} SELECT idx AS "index", term, tf FROM tc""",
    "tfidf_vocab": f"""WITH {FEAT_CTES}, {GRAM_CTES.replace('{src}', 'sp')}, {VOCAB_CTES}
SELECT term, term_index, df, tf FROM voc""",
    "tfidf": f"""WITH {FEAT_CTES}, {GRAM_CTES.replace('{src}', 'sp')}, {VOCAB_CTES},
w AS (SELECT tc.idx, v.term_index, v.term, tc.tf * (ln((1 + v.n) / (1 + v.df)) + 1) AS w
      FROM tc JOIN voc v ON v.term = tc.term)
SELECT w.idx AS "index", sp.split, sp.cls AS "Class", w.term_index, w.term,
       round(w.w / sqrt(sum(w.w * w.w) OVER (PARTITION BY w.idx)), 6) AS weight
FROM w JOIN sp ON sp.idx = w.idx""",
})

ORACLE.update({
    "row_index": "SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS index FROM documents",
    "processed_records": f"""WITH {COMMENTS}, c AS (SELECT pos, id, parent_id, subreddit,
  lower({trim_ws(keep_alnum('body'))}) AS body FROM comments WHERE body IS DISTINCT FROM '[deleted]')
SELECT * FROM c WHERE length(body) >= 10""",
    "udf_scalar": "SELECT event_id, upper(event_type) AS event_type FROM events",
    "udtf_flat_map": """SELECT event_id, CAST(unnest(range(event_id % 4)) AS INTEGER) AS elem,
unnest(range(event_id % 4)) AS value FROM events""",
    "udaf_reduce": "SELECT event_type, CAST(sum(user_id) AS BIGINT) AS result FROM events GROUP BY event_type",
})

ORACLE.update({
    "stream_clean": f"""WITH {COMMENTS} SELECT pos, id, {trim_ws('body')} AS body FROM comments
WHERE body IS DISTINCT FROM '[deleted]'""",
    "stream_pairs": f"WITH {COMMENTS}, {PREP}, {VERIFIED} SELECT pos, id, parent_id FROM vp",
    "stream_pairs_versions": f"""WITH {COMMENTS}, {PREP}
SELECT c.pos, c.id, c.parent_id, p.pos AS parent_pos, p.body AS parent_body, c.body AS reply_body
FROM prep c ASOF JOIN prep p ON p.id = c.parent_id AND c.pos > p.pos""",
    "stream_late_pairs": f"""WITH {COMMENTS}, {PREP}
SELECT c.pos, c.id, c.parent_id, p.pos AS parent_pos, p.body AS parent_body, c.body AS reply_body
FROM prep c ASOF JOIN prep p ON p.id = c.parent_id AND c.pos > p.pos""",
    "stream_pair_lines": f"""WITH {COMMENTS}, {PREP}
SELECT p.body || chr(9) || c.body AS line FROM prep c ASOF JOIN prep p ON p.id = c.parent_id AND c.pos > p.pos""",
    "stream_summary": f"""WITH {COMMENTS}, c AS (SELECT *, coalesce(starts_with({pkey()}, 'c'), false) AS is_pair FROM comments)
SELECT count(*) AS comments, count(*) FILTER (WHERE body = '[deleted]') AS deleted,
count(*) FILTER (WHERE NOT is_pair) AS posts, count(*) FILTER (WHERE is_pair) AS pairs FROM c""",
    "stream_group_counts": f"WITH {COMMENTS} SELECT subreddit_id, count(*) AS n FROM comments GROUP BY subreddit_id",
    "stream_word_counts": f"""WITH {COMMENTS} SELECT word, count(*) AS count
FROM (SELECT unnest({tokens('body')}) AS word FROM comments) GROUP BY word""",
    "stream_distinct": "SELECT DISTINCT user_id FROM events",
    "stream_field_counts": f"""WITH {COMMENTS} SELECT field, count(*) AS n FROM
(UNPIVOT (SELECT CAST(pos AS VARCHAR) AS pos, id, parent_id, subreddit, subreddit_id, author, body FROM comments)
 ON pos, id, parent_id, subreddit, subreddit_id, author, body INTO NAME field VALUE val) GROUP BY field""",
})

ORACLE.update({
    "explore_vocab": f"""WITH {COMMENTS},
c AS (SELECT * FROM comments WHERE body IS DISTINCT FROM '[deleted]' ORDER BY pos LIMIT 400),
c2 AS (SELECT pos, {tokens(f"lower({trim_ws(keep_alnum('body'))})")} AS t FROM c
       WHERE NOT coalesce(subreddit IN ('s2'), false)),
src AS (SELECT pos, t FROM c2 WHERE len(t) >= 3), {vocab_sql('src')}
SELECT word, index, count, index AS rank FROM voc""",
})

ORACLE.update({
    "stream_vocab": f"""WITH {COMMENTS}, src AS (SELECT pos, {tokens('body')} AS t FROM comments),
{vocab_sql('src')} SELECT word, index, count FROM voc""",
})


# ---------------------------------------------------------------- files

PROPS = """(SELECT event_id AS pos, user_id, value, event_type, event_id % 3 AS m, props FROM events)"""

ORACLE.update({
    "read_bz2": f"""WITH {COMMENTS}
SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, id, parent_id, body FROM comments""",
    "read_first": f"""WITH {COMMENTS}, c AS (SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, id, parent_id, body
FROM comments) SELECT * FROM c WHERE pos < 400 AND body IS DISTINCT FROM '[deleted]'""",
    "read_many": """WITH l AS (SELECT event_type, row_number() OVER (ORDER BY event_type, event_id) - 1 AS n,
CAST(event_id AS VARCHAR) AS value FROM events) SELECT n AS pos, value FROM l
UNION ALL SELECT (SELECT count(*) FROM events) + row_number() OVER (ORDER BY n) - 1, value FROM l
WHERE event_type = (SELECT min(event_type) FROM events)""",
    "read_labelled": """SELECT row_number() OVER (ORDER BY d.doc_id) - 1 AS "index",
CASE WHEN d.text = '' THEN NULL ELSE translate(d.text, chr(9) || chr(10) || chr(13), '   ') END AS "Sentence",
CAST(l.quality AS INTEGER) AS "Class" FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "write_pairs": f"""WITH {COMMENTS}, {PREP}, {VERIFIED},
ids AS (SELECT id FROM vp UNION SELECT parent_id FROM vp),
p2 AS (SELECT * FROM prep SEMI JOIN ids ON prep.id IS NOT DISTINCT FROM ids.id),
o AS (SELECT c.pos, p.body || chr(9) || c.body AS line FROM p2 c ASOF JOIN p2 p ON p.id = c.parent_id AND c.pos >= p.pos)
SELECT row_number() OVER (ORDER BY pos) - 1 AS n, line FROM o""",
    "explore_fields": f"""SELECT field, n, first_pos FROM (
SELECT 'pos' AS field, count(*) AS n, min(pos) AS first_pos FROM {PROPS}
UNION ALL SELECT 'user_id', count(*), min(pos) FROM {PROPS}
UNION ALL SELECT 'mixed', count(*), min(pos) FROM {PROPS} WHERE m <> 2
UNION ALL SELECT 'gone', count(*), min(pos) FROM {PROPS})""",
    "explore_field_values": f"""SELECT 'mixed' AS field, 'STRING' AS value_type, event_type AS value, count(*) AS n
FROM {PROPS} WHERE m = 0 GROUP BY event_type
UNION ALL SELECT 'mixed', 'BOOLEAN', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END, count(*) FROM {PROPS} WHERE m = 1 GROUP BY 3
UNION ALL SELECT 'gone', 'VOID', 'null', count(*) FROM {PROPS}
UNION ALL SELECT 'nested', 'OBJECT<k: BIGINT>', '{{"k":' || CAST(user_id % 4 AS VARCHAR) || '}}', count(*) FROM {PROPS} GROUP BY user_id % 4""",
})
