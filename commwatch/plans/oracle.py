"""DuckDB SQL for the catalogue, written from the definitions and not from the Spark plans.

Token counts use windows here and sorted arrays there; scores use joins here and hash-set look-ups
there.
"""

from commwatch.functions.lexicons import TOPIC
from commwatch.functions.sentences import PLAIN as PLAIN_QUOTES
from commwatch.functions.sentences import SPACE, TYPOGRAPHIC, rules
from commwatch.functions.stopwords import ENGLISH
from commwatch.functions.text import TOKEN_PATTERN
from commwatch.plans.inputs import SPOKEN
from commwatch.plans.phrases import PHRASES
from commwatch.plans.samples import FRAUD, POWER, SENTIMENT


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _list(values):
    return ", ".join(_text(v) for v in values)


STOP_WORDS = _list(ENGLISH)
LEXICON = ", ".join(
    f"({_text(name)}, {class_id}, {_text(word)})"
    for lexicon in (TOPIC, SENTIMENT, POWER, FRAUD)
    for name, class_id, word in lexicon.rows()
)
CLASSES = ", ".join(
    f"({_text(lexicon.name)}, {class_id}, {_text(lexicon.labels[class_id])})"
    for lexicon in (TOPIC, SENTIMENT, POWER, FRAUD)
    for class_id in lexicon.class_ids
)


def _with(*parts):
    return "WITH " + ",\n".join(parts) + "\n"


# --- records derived from the tables

TRANS_LINES = """
trans AS (
  SELECT event_id, ts, 'user' || user_id || '@example.com' AS "user",
         printf('%.2f', value * 100 * CASE WHEN event_type = 'error' THEN -1.0 ELSE 1.0 END)
           AS amount
  FROM events),
lines AS (
  SELECT '127.0.0.1|1235|' || strftime(ts, '%Y%m%d%H%M%S') || '|' || "user" || '|' || amount
           AS value
  FROM trans)"""

DAMAGED_LINES = """
heads AS (
  SELECT event_id % 10 AS way, '127.0.0.1|1235|' ||
           CASE WHEN event_id % 10 = 3 THEN '20130132000000'
                ELSE strftime(ts, '%Y%m%d%H%M%S') END AS stamp,
         'user' || user_id || '@example.com' AS "user", printf('%.2f', value * 100) AS amount
  FROM events),
lines AS (
  SELECT CASE way WHEN 0 THEN stamp
                  WHEN 1 THEN stamp || '|' || "user" || '|' || amount || 'x'
                  WHEN 2 THEN stamp || '|' || "user" || '|' || amount || 'd'
                  WHEN 4 THEN stamp || '|' || "user"
                  WHEN 5 THEN stamp || '|' || "user" || '|' || amount || '|more'
                  WHEN 6 THEN stamp || '|' || "user" || '|'
                  ELSE stamp || '|' || "user" || '|' || amount END AS value
  FROM heads)"""

PARSED_TRANS = r"""
split AS (SELECT value, string_split(value, '|') AS p FROM lines),
numbered AS (
  SELECT value, p, len(p) AS n,
         CASE WHEN regexp_matches(p[5], '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$')
              THEN try_cast(p[5] AS DOUBLE) END AS amount,
         CASE WHEN regexp_matches(p[3], '^[0-9]{14}$')
              THEN try_strptime(p[3], '%Y%m%d%H%M%S') END AS event_time
  FROM split),
parsed AS (
  SELECT value, p[1] AS ip, p[2] AS port, p[3] AS date_time, p[4] AS "user", amount, event_time,
         CASE WHEN n < 5 THEN 'too few fields' WHEN amount IS NULL THEN 'bad amount' END AS reason
  FROM numbered)"""

FLAGS = """
SELECT ip, port, date_time, "user", amount,
       CAST(CASE WHEN abs(amount) >= 10000 AND NOT isnan(amount) THEN 1 ELSE 0 END AS INTEGER)
         AS big_trans,
       CAST(CASE WHEN isodow(event_time) = 7 THEN 1 ELSE 0 END AS INTEGER) AS is_in_odd_day,
       CAST(CASE WHEN hour(event_time) < 7 OR hour(event_time) > 22 THEN 1 ELSE 0 END AS INTEGER)
         AS is_at_odd_time
FROM parsed WHERE reason IS NULL"""


def _header(number, name):
    return f"""CASE ({number}) % 4
           WHEN 0 THEN 'r' || ({number}) || '@example.com'
           WHEN 1 THEN {name} || ' Lee <a' || ({number}) || '@example.com>'
           WHEN 2 THEN 'a' || ({number}) || '@example.com b' || ({number}) || '@example.com a'
                       || ({number}) || '@example.com'
           ELSE 'nobody ' || ({number}) END"""


def _addresses(header):
    return f"""CASE WHEN instr({header}, '@') = 0 THEN CAST([] AS VARCHAR[])
            WHEN instr({header}, ' ') = 0 THEN [{header}]
            ELSE list_distinct(list_filter(string_split({header}, ' '),
                   lambda p: NOT contains(p, '<') AND NOT contains(p, '>'))) END"""


PLAIN = "docs AS (SELECT doc_id, text, lang, source FROM documents)"
PHRASED = f"""
docs AS (
  SELECT doc_id, concat_ws(' ', text, [{_list(PHRASES)}][doc_id % {len(PHRASES)} + 1]) AS text,
         lang, source
  FROM documents)"""

EMAIL_FIELDS = f"""
heads AS (
  SELECT doc_id, {_header("doc_id + 2", "lang")} AS mailfrom,
         {_header("doc_id", "source")} AS torecipients,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1)
              ELSE text END AS subject,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1)
              ELSE '' END AS content
  FROM docs),
emails AS (
  SELECT doc_id, '127.0.0.1' AS ip, '1237' AS port,
         strftime(TIMESTAMP '2013-01-01' + to_seconds(doc_id * 30), '%Y%m%d%H%M%S') AS date_time,
         array_to_string(list_sort({_addresses("mailfrom")}), '~') AS fr,
         array_to_string(list_sort({_addresses("torecipients")}), '~') AS "to",
         translate(subject, '|' || chr(13) || chr(10), '   ') AS subject,
         translate(content, '|' || chr(13) || chr(10), '   ') AS content
  FROM heads)"""


# --- tokens and scores


def _words(table, text, key, found=None):
    """Tokens in order, from 0, of a text column; ``key`` may be several columns.

    ``found`` is SQL for all tokens, if not those of the token pattern.
    """
    found = found or f"regexp_extract_all({text}, {_text(TOKEN_PATTERN)})"
    return rf"""
lists AS (
  SELECT {key}, list_filter({found},
           lambda w: length(w) > 1 AND length(w) <= 30
             AND NOT regexp_matches(w, '[/\\~#_]|--') AND w NOT IN ({STOP_WORDS})) AS ws
  FROM {table}),
words AS (
  SELECT {key}, unnest(ws) AS word, unnest(range(len(ws))) AS position FROM lists)"""


def _spoken():
    text = "text"
    for word, said in SPOKEN:
        text = f"replace({text}, {_text(word)}, {_text(said)})"
    return f"docs AS (SELECT doc_id, {text} AS text FROM documents)"


def _by_sentence(text):
    spaced = f"translate({text}, {_text(TYPOGRAPHIC)}, {_text(PLAIN_QUOTES)})"
    for pattern, replacement in rules():
        spaced = f"regexp_replace({spaced}, {_text(pattern)}, {_text(replacement)}, 'g')"
    return f"string_split_regex({spaced}, {_text(SPACE + '+')})"


SENTENCES = (_spoken(), _words("docs", "text", "doc_id", _by_sentence("text")))


def _counts(key, reset=True):
    if not reset:
        return f"""
counts AS (
  SELECT {key}, lower(word) AS token, count(*) AS n FROM words GROUP BY {key}, lower(word))"""
    return f"""
placed AS (
  SELECT {key}, lower(word) AS token, position,
         max(position) FILTER (WHERE word <> lower(word))
           OVER (PARTITION BY {key}, lower(word)) AS last_capital
  FROM words),
counts AS (
  SELECT {key}, token, count(*) AS n FROM placed
  WHERE last_capital IS NULL OR position >= last_capital
  GROUP BY {key}, token)"""


LEXICON_TABLES = f"""
lexicon(lexicon, class_id, word) AS (VALUES {LEXICON}),
classes(lexicon, class_id, label) AS (VALUES {CLASSES})"""


VOCABULARY_TABLES = (
    _words("documents", "text", "doc_id").replace("lists AS", "all_lists AS")
    .replace("words AS", "all_words AS").replace("FROM lists", "FROM all_lists"),
    """
digits AS (
  SELECT word, instr('0123456789abcdef', md5(word)[1]) - 1 AS digit
  FROM (SELECT DISTINCT lower(word) AS word FROM all_words)),
lexicon AS (
  SELECT CASE WHEN digit < 2 THEN 'sentiment' WHEN digit < 4 THEN 'power'
              WHEN digit = 4 THEN 'fraud' ELSE 'topic' END AS lexicon,
         CASE WHEN digit < 4 THEN digit % 2 WHEN digit = 4 THEN 1 ELSE digit - 5 END AS class_id,
         word
  FROM digits)""",
    f"""
classes(lexicon, class_id, label) AS (VALUES {CLASSES})""",
)


def _hits(table, key):
    return f"""
totals AS (SELECT {key}, sum(n) AS total FROM counts GROUP BY {key}),
found AS (
  SELECT {key}, lexicon, class_id, sum(n) AS hits
  FROM counts JOIN lexicon ON token = word GROUP BY {key}, lexicon, class_id),
hits AS (
  SELECT {key}, lexicon, class_id, label, CAST(coalesce(total, 0) AS BIGINT) AS total,
         CAST(coalesce(hits, 0) AS BIGINT) AS hits
  FROM {table} CROSS JOIN classes
       LEFT JOIN totals USING ({key})
       LEFT JOIN found USING ({key}, lexicon, class_id))"""


def _best(key):
    return f"""
best AS (
  SELECT {key}, lexicon, max(total) AS total, max(hits) AS hits,
         CASE WHEN max(total) = 0 THEN -1 ELSE min(class_id) FILTER (WHERE first_best) END
           AS class_id,
         CASE WHEN max(total) = 0 THEN NULL ELSE min(label) FILTER (WHERE first_best) END AS label
  FROM (SELECT *, row_number() OVER (PARTITION BY {key}, lexicon
                                     ORDER BY hits DESC, class_id) = 1 AS first_best FROM hits)
  GROUP BY {key}, lexicon)"""


PHRASED_HITS = (
    PHRASED,
    _words("docs", "text", "doc_id"),
    _counts("doc_id"),
    LEXICON_TABLES,
    _hits("docs", "doc_id"),
)

SHARE = "CASE WHEN total = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / CAST(total AS DOUBLE) END"


def _label(lexicon):
    return (
        _with(*PHRASED_HITS, _best("doc_id"))
        + f"SELECT doc_id, total, hits, CAST(class_id AS INTEGER) AS {lexicon}, label "
        f"FROM best WHERE lexicon = '{lexicon}'"
    )


FIELD_KEY = "doc_id, field"


def _email_scores(*lexicon_tables):
    return (
        _with(
            PHRASED,
            EMAIL_FIELDS,
            """
texts AS (
  SELECT doc_id, 'subject' AS field, subject AS text FROM emails
  UNION ALL SELECT doc_id, 'content', content FROM emails)""",
            _words("texts", "text", FIELD_KEY),
            _counts(FIELD_KEY),
            *lexicon_tables,
            _hits("texts", FIELD_KEY),
            _best(FIELD_KEY),
            """
jsons AS (
  SELECT doc_id, field,
         '{' || string_agg('"' || token || '":' || n, ',' ORDER BY token) || '}' AS json
  FROM counts GROUP BY doc_id, field),
wide AS (
  SELECT doc_id,
         max(class_id) FILTER (WHERE field = 'subject' AND lexicon = 'sentiment') AS ss,
         max(class_id) FILTER (WHERE field = 'content' AND lexicon = 'sentiment') AS cs,
         max(class_id) FILTER (WHERE field = 'subject' AND lexicon = 'power') AS sp,
         max(class_id) FILTER (WHERE field = 'content' AND lexicon = 'power') AS cp,
         max(class_id) FILTER (WHERE field = 'subject' AND lexicon = 'topic') AS st,
         max(class_id) FILTER (WHERE field = 'content' AND lexicon = 'topic') AS ct,
         max(CASE WHEN total = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / CAST(total AS DOUBLE) END)
           FILTER (WHERE field = 'content' AND lexicon = 'fraud') AS fraud_score
  FROM best GROUP BY doc_id)""",
        )
        + """
SELECT ip, port, date_time, fr, "to",
       coalesce(s.json, '{}') AS subject, coalesce(c.json, '{}') AS content,
       CAST(ss AS INTEGER) AS subject_sentiment, CAST(cs AS INTEGER) AS content_sentiment,
       CAST(sp AS INTEGER) AS subject_power, CAST(cp AS INTEGER) AS content_power,
       CAST(st AS INTEGER) AS subject_topic, CAST(ct AS INTEGER) AS content_topic, fraud_score
FROM emails JOIN wide USING (doc_id)
     LEFT JOIN jsons s ON s.doc_id = emails.doc_id AND s.field = 'subject'
     LEFT JOIN jsons c ON c.doc_id = emails.doc_id AND c.field = 'content'"""
    )


EMAIL_SCORES = _email_scores(LEXICON_TABLES)
EMAIL_TABLE_SCORES = _email_scores(*VOCABULARY_TABLES)


# --- edges and counts


def _edges(emails):
    return f"""
SELECT fr, "to", dt
FROM (SELECT fr, unnest(string_split(tos, '~')) AS "to", dt FROM {emails})
WHERE contains("to", '@') AND length("to") > 5"""


ORDER_EDGES = (
    """WITH mail AS (
  SELECT 'order' || l_orderkey || '@example.com' AS fr, strftime(l_shipdate, '%Y%m%d%H%M%S') AS dt,
         'part' || l_partkey || '@example.com' AS part,
         'supplier' || l_suppkey || '@example.com' AS supplier, l_linenumber
  FROM lineitem WHERE l_returnflag <> 'R'),
addressed AS (
  SELECT fr, dt, CASE l_linenumber WHEN 1 THEN part
                                   WHEN 2 THEN part || '~' || supplier || '~' || part
                                   WHEN 3 THEN 'nobody~' || supplier
                                   WHEN 4 THEN 'a@b.c'
                                   WHEN 5 THEN 'a@b.cd~'
                                   ELSE '' END AS tos FROM mail)"""
    + _edges("addressed")
)

EMAIL_EDGES = _with(PHRASED, EMAIL_FIELDS) + _edges(
    """(SELECT fr, "to" AS tos, date_time AS dt FROM emails)"""
)

MESSAGE_BALANCE = """
SELECT CASE event_id % 5 WHEN 1 THEN 'bad time' WHEN 2 THEN 'too few fields' ELSE 'counted' END
         AS fate, count(*) AS n
FROM events GROUP BY fate"""

MESSAGE_COUNTS = """
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type AS message, count(*) AS n
FROM events GROUP BY ALL"""

TRANS_FLAGS = _with(TRANS_LINES, PARSED_TRANS) + FLAGS

ORACLE = {
    "people_filter": r"""
SELECT DISTINCT address
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\r\n]+')) AS address FROM documents)
WHERE contains(address, '@')""",
    "wire_trans": _with(TRANS_LINES) + "SELECT value FROM lines",
    "wire_email": _with(PLAIN, EMAIL_FIELDS)
    + """SELECT md5(concat_ws('|', ip, port, date_time, fr, "to", subject, content)) AS line_md5
FROM emails""",
    "wire_corpus": _with(PLAIN, EMAIL_FIELDS)
    + """SELECT md5(concat_ws('|', ip, port, '20130101000000', fr, "to", subject, content)) AS line_md5
FROM emails""",
    # a sixteenth is 625 ten-thousandths
    "wire_amounts": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber % 2 = 1 THEN '-' ELSE '' END
         || (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS amount
FROM (SELECT l_orderkey, l_linenumber, (CAST(l_quantity AS BIGINT) * 625 + 50) // 100 AS cents
      FROM lineitem)""",
    "sanitise_text": """
SELECT doc_id, md5(replace(replace(replace(text, '|', ' '), chr(13), ' '), chr(10), ' '))
         AS text_md5
FROM documents""",
    "address_normalise": f"""
SELECT c_custkey, unnest({_addresses("header")}) AS address
FROM (SELECT c_custkey, {_header("c_custkey", "c_name")} AS header FROM customer)""",
    "parse_trans": _with(TRANS_LINES, PARSED_TRANS)
    + """SELECT ip, port, date_time, "user", amount,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time
FROM parsed WHERE reason IS NULL""",
    "trans_flags": TRANS_FLAGS,
    "reject_trans": _with(DAMAGED_LINES, PARSED_TRANS)
    + "SELECT value, reason FROM parsed WHERE reason IS NOT NULL",
    "tolerant_flags": _with(DAMAGED_LINES, PARSED_TRANS) + FLAGS,
    "business_days": "SELECT event_id, user_id FROM events WHERE isodow(ts) <> 7",
    "horizon": "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) <= 1998",
    "parse_email": _with(PLAIN, EMAIL_FIELDS)
    + """SELECT ip, port, date_time, fr, "to", md5(subject) AS subject_md5,
       md5(content) AS content_md5 FROM emails""",
    "doc_tokens": _with(PLAIN, _words("docs", "text", "doc_id"))
    + "SELECT doc_id, position, word AS token FROM words",
    "doc_token_total": _with(PLAIN, _words("docs", "text", "doc_id"), _counts("doc_id"))
    + """SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_tokens,
       CAST(coalesce(total, 0) AS BIGINT) AS total
FROM lists LEFT JOIN (SELECT doc_id, sum(n) AS total FROM counts GROUP BY doc_id) USING (doc_id)""",
    "term_freq": _with(PLAIN, _words("docs", "text", "doc_id"), _counts("doc_id", reset=False))
    + "SELECT doc_id, token, n FROM counts",
    "term_freq_reset": _with(PLAIN, _words("docs", "text", "doc_id"), _counts("doc_id"))
    + "SELECT doc_id, token, n FROM counts",
    "doc_sentence_tokens": _with(*SENTENCES)
    + "SELECT doc_id, position, word AS token FROM words",
    "sentence_term_freq": _with(*SENTENCES, _counts("doc_id"))
    + "SELECT doc_id, token, n FROM counts",
    "freq_json": _with(PLAIN, _words("docs", "text", "doc_id"), _counts("doc_id"))
    + """SELECT doc_id, coalesce(json, '{}') AS counts_json
FROM docs LEFT JOIN (
  SELECT doc_id, '{' || string_agg('"' || token || '":' || n, ',' ORDER BY token) || '}' AS json
  FROM counts GROUP BY doc_id) USING (doc_id)""",
    "topic_hits": _with(*PHRASED_HITS)
    + "SELECT doc_id, CAST(class_id AS INTEGER) AS class_id, hits FROM hits WHERE lexicon = 'topic'",
    "topic_scores": _with(*PHRASED_HITS)
    + f"SELECT doc_id, CAST(class_id AS INTEGER) AS class_id, {SHARE} AS score "
    "FROM hits WHERE lexicon = 'topic'",
    "table_lexicon_hits": _with(
        PLAIN,
        _words("docs", "text", "doc_id"),
        _counts("doc_id"),
        _words("benchmark", "text", "item_id")
        .replace("lists AS", "item_lists AS")
        .replace("words AS", "item_words AS")
        .replace("FROM lists", "FROM item_lists"),
        """
lexicon AS (SELECT DISTINCT lower(word) AS word, length(lower(word)) % 2 AS class_id
            FROM item_words)""",
    )
    + """SELECT doc_id, CAST(coalesce(total, 0) AS BIGINT) AS total,
       CAST(c.class_id AS INTEGER) AS class_id, CAST(coalesce(hits, 0) AS BIGINT) AS hits
FROM docs CROSS JOIN (VALUES (0), (1)) c(class_id)
     LEFT JOIN (SELECT doc_id, sum(n) AS total FROM counts GROUP BY doc_id) USING (doc_id)
     LEFT JOIN (SELECT doc_id, class_id, sum(n) AS hits FROM counts JOIN lexicon ON token = word
                GROUP BY doc_id, class_id) f
       ON f.doc_id = docs.doc_id AND f.class_id = c.class_id""",
    "topic_label": _label("topic"),
    "sentiment": _label("sentiment"),
    "power": _label("power"),
    "fraud_score": _with(*PHRASED_HITS)
    + f"SELECT doc_id, total, hits, {SHARE} AS fraud_score FROM hits WHERE lexicon = 'fraud'",
    "email_scores": EMAIL_SCORES,
    "email_scores_by_table": EMAIL_TABLE_SCORES,
    "edges": ORDER_EDGES,
    "message_balance": MESSAGE_BALANCE,
    "message_counts": MESSAGE_COUNTS,
    "fourth_char_counts": _with(TRANS_LINES)
    + """SELECT substr(field, 4, 1) AS "character", count(*) AS n
FROM (SELECT unnest(string_split(value, '|')) AS field FROM lines)
WHERE length(field) >= 4 GROUP BY ALL""",
    "batch_counts": """
SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
FROM events GROUP BY ALL""",
    "stream_trans": TRANS_FLAGS,
    "stream_batch_rows": """
SELECT event_id % 3 AS batch_id, sink, count(*) AS n, count(*) AS n_read
FROM (SELECT event_id, CASE WHEN event_id % 10 IN (0, 1, 2, 4, 6) THEN 'rejected'
                            ELSE 'trans_stream' END AS sink FROM events)
GROUP BY ALL""",
    "stream_email": EMAIL_SCORES,
    "stream_email_by_table": EMAIL_TABLE_SCORES,
    "stream_email_graph": EMAIL_EDGES,
    "stream_edges": ORDER_EDGES,
    "stream_message_counts": MESSAGE_COUNTS,
    "stream_message_fates": """
WITH told AS (
  SELECT event_id % 3 AS batch, event_id % 5 AS way, date_trunc('second', ts) AS t FROM events),
newest AS (SELECT batch, max(t) AS t FROM told WHERE way NOT IN (1, 2) GROUP BY batch),
marks AS (
  SELECT b.batch, max(n.t) - INTERVAL 10 MINUTE AS mark
  FROM newest b LEFT JOIN newest n ON n.batch < b.batch GROUP BY b.batch)
SELECT CASE way WHEN 1 THEN 'bad time' WHEN 2 THEN 'too few fields'
                ELSE CASE WHEN t + INTERVAL 1 SECOND <= mark THEN 'late' ELSE 'counted' END END AS fate,
       count(*) AS n
FROM told LEFT JOIN marks USING (batch) GROUP BY fate""",
}
ORACLE["topic_hits_joined"] = ORACLE["topic_hits"]
