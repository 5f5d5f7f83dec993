"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from pyspark.sql import functions as F

from commwatch.functions.binding import bind, text_list

SPACES = r"[\x20\x09-\x0D]+"
SPACE_MARKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    (
        "the of and to in is that it for as with on be at by this from or an are was "
        "der die und das ist nicht ein eine zu den mit für von auf des im sich dem es auch als "
        "le la les de et un une du en que qui dans pour est sur par au pas avec "
        "el los las y se con por una su para del al no lo"
    ).split()
)
# (measure, least, most); a bound of None is open. The ratios are per word, or per line with a word.
RULES = (
    ("mean_word_length", 2.0, 16.0),
    ("symbol_ratio", None, 0.1),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.4),
    ("ellipsis_line_ratio", None, 0.3),
)
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words


def _without(text, marks):
    return F.char_length(F.translate(text, marks, ""))


def _repeated(words):
    """Number of words in three-word windows that occur twice or more in the text.

    The windows, as 64-bit hashes with their places, are sorted once: equal ones become
    neighbours. Of two neighbouring marked places at most three words are new to the first.
    """

    def windows(h):
        places = F.when(F.size(h) >= 3, F.sequence(F.lit(0), F.size(h) - 3)).otherwise(
            F.array().cast("array<int>")
        )
        return F.sort_array(
            F.transform(
                places,
                lambda i: F.struct(
                    F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"),
                    i.alias("i"),
                ),
            )
        )

    def marked(h, place):
        found = F.filter(
            F.transform(h, lambda _, k: k),
            lambda k: F.coalesce(
                (F.get(h, k) == F.get(h, k - 1)) | (F.get(h, k) == F.get(h, k + 1)), F.lit(False)
            ),
        )
        return F.array_sort(F.transform(found, lambda k: F.get(place, k)))

    def covered(places):
        steps = F.transform(
            places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, b: a + b)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return bind(
        bind(hashes, windows),
        lambda s: bind(s["h"], lambda h: bind(s["i"], lambda p: bind(marked(h, p), covered))),
    )


def measures(text):
    """A struct of counts of a text: words, characters in words, symbols, lines, repeats."""
    bare = F.btrim(text, F.lit(SPACE_MARKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_MARKS)) != "")

    def of(w, x):
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            _without(text, SPACE_MARKS).cast("bigint").alias("word_chars"),
            (F.char_length(text) - _without(text, SYMBOLS)).cast("bigint").alias("n_symbols"),
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeated(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda v: v.isin(*STOP_WORDS))).cast("bigint").alias("n_stop"),
            F.size(F.filter(x, lambda v: F.rtrim(v).endswith("...") | F.rtrim(v).endswith("…")))
            .cast("bigint")
            .alias("n_ellipsis"),
        )

    return bind(words, lambda w: bind(lines, lambda x: of(w, x)))


def ratios(m):
    """The measures that rules may name, from the counts in the struct column ``m``."""
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "n_words": m["n_words"],
        "mean_word_length": m["word_chars"] / words,
        "symbol_ratio": m["n_symbols"] / words,
        "stop_word_ratio": m["n_stop"] / words,
        "dup_line_ratio": m["n_dup_lines"] / lines,
        "ellipsis_line_ratio": m["n_ellipsis"] / lines,
    }


def compile_rules(m, rules=RULES):
    """Names of the rules that a document breaks, as one array expression."""
    values, broken = ratios(m), []
    for name, least, most in rules:
        for bound, low in ((least, True), (most, False)):
            if bound is not None:
                fails = values[name] < bound if low else values[name] > bound
                broken.append(F.when(fails, F.lit(f"{name} {'<' if low else '>'} {bound:g}")))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def judge_quality(df, rules=RULES, text="text", least_words=LEAST_WORDS):
    """``df`` with the struct column ``quality`` of counts, broken rules and verdicts.

    Null text counts as empty; a text without words fails the base rules. Every row is judged on
    its own, so repeated rows, ties and other columns do not matter, except that a column named
    ``quality`` is replaced. One projection, no shuffle, no user function: the counts are bound
    once per row, and the longest step is one sort of a text's own windows.
    """
    counted = measures(F.coalesce(F.col(text), F.lit("")))

    def verdict(m):
        base = (m["n_words"] < least_words) | (
            100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"]
        )
        failed = compile_rules(m, rules)
        return F.struct(
            m.alias("counts"),
            base.alias("base_failed"),
            failed.alias("failed"),
            (~base & (F.size(failed) == 0)).alias("kept"),
        )

    return df.withColumn("quality", bind(counted, verdict))


def quality_report(df):
    """One row per document: its counts, the rules that it breaks and whether it is kept."""
    counts = F.col("quality.counts")
    return judge_quality(df.select("doc_id", "text")).select(
        "doc_id",
        *(counts[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        )),
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
        F.array_join("quality.failed", ", ").alias("failed"),
    )


_SQL_SPACES = r"[\x20\x09-\x0D]+"
SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SQL_SPACES}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
numbered AS (SELECT row_number() OVER () AS r, * FROM base),
grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered WHERE len(w) >= 3)),
repeated AS (
  SELECT r, count(DISTINCT i + d) AS n FROM grams, (VALUES (0), (1), (2)) AS o(d)
  WHERE grams.n > 1 GROUP BY r),
counted AS (
  SELECT doc_id, t, lines, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{_SQL_SPACES}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({text_list(STOP_WORDS)}))) AS n_stop,
    len(list_filter(lines, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…'))
      AS n_ellipsis
  FROM numbered LEFT JOIN repeated USING (r)),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words
      AS base_failed,
    concat_ws(', ',
      CASE WHEN word_chars / greatest(n_words, 1) < 2 THEN 'mean_word_length < 2' END,
      CASE WHEN word_chars / greatest(n_words, 1) > 16 THEN 'mean_word_length > 16' END,
      CASE WHEN n_symbols / greatest(n_words, 1) > 0.1 THEN 'symbol_ratio > 0.1' END,
      CASE WHEN n_stop / greatest(n_words, 1) < 0.02 THEN 'stop_word_ratio < 0.02' END,
      CASE WHEN n_dup_lines / greatest(len(lines), 1) > 0.4 THEN 'dup_line_ratio > 0.4' END,
      CASE WHEN n_ellipsis / greatest(len(lines), 1) > 0.3 THEN 'ellipsis_line_ratio > 0.3' END
    ) AS failed
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed = '' AS kept, failed
FROM judged
"""
