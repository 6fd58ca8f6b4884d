"""Line-first quality cleaning, in DataFrame expressions only.

Every line of a document is held against the rules of :func:`line_fails`; lines that fail one are removed.  A document
is then rejected if it fails the base rules (too short, or too much of it repeats) or if its kept lines hold less than
``min_kept_share`` of its characters, white space aside.

A line that ends no sentence isn't at fault where lines are broken within sentences.  It is running text (wrapped prose,
verse) if it and the line before or after it have ``RUNNING`` words or more each, its words begin with small letters
at least as often as with capitals, and a line with the end of a sentence or clause is at most ``REACH`` lines away with no blank line
between.  So menus, lists of links and tables fail, whatever their lines' lengths: they have no such line near, or
capitals throughout.  Sentence ends are those of all scripts; a line of which half the characters are of a
script that has none (Thai, Lao, Burmese, Khmer) isn't held to that rule.

Nothing is shuffled: each document is judged from its own text, in one pass over the scan.

Defined results for odd input: a null or empty text has no word, so it fails the base rules and its cleaned text is
empty.  Repeated rows are judged alike, each for itself.  Other columns are neither read nor changed, whatever their
names.  Very long texts need sorting memory in proportion to their own words only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.text import GAP, WORD, n_of, only, whole, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_KEPT_SHARE = 0.5

RUNNING = 5
REACH = 8

#: Phrases that mark a line as page furniture, in English, German, French and Spanish.
BOILERPLATE = (
    r"(?i)\b(?:enable javascript|javascript is (?:disabled|required)|(?:we|this site) uses? cookies|use cookies|cookie (?:policy|settings)|accept (?:all )?cookies|"
    r"privacy (?:policy|notice)|terms (?:of (?:use|service)|and conditions)|all rights reserved|lorem ipsum|sign (?:in|up)|log (?:in|out)|subscribe now|"
    r"click here|read more|share this|follow us|skip to (?:main )?content|back to top|powered by|"
    r"alle rechte vorbehalten|impressum|datenschutzerkl[äÄ]rung|cookies (?:akzeptieren|verwenden)|weiterlesen|jetzt anmelden|"
    r"tous droits r[éÉ]serv[éÉ]s|mentions l[éÉ]gales|politique de confidentialit[éÉ]|accepter les cookies|lire la suite|"
    r"todos los derechos reservados|aviso legal|pol[íÍ]tica de (?:privacidad|cookies)|aceptar (?:las )?cookies|leer m[áÁ]s)"
)
#: Marks that end a sentence or a clause.  Those of the first class count before white space only.
SENTENCE = r"""[.!?;:…]["'”’»)\]]*(?:[\x20\x09-\x0D]|$)|[。．｡！？；：؟۔؛।॥։՞՜።፧။។៕།༎᠃᠉‽⸮]"""
#: Marks within a sentence.
COMMA = r"[,،、，﹐､]"
#: Letters of scripts that end sentences without a mark.
UNMARKED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}]"
#: The beginning of a word, up to its first letter.
START = r"(?:^|[\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]*"
#: Lines by what they hold: no word, the end of a sentence or clause, neither.
BLANK, MARK, PLAIN = "b", "m", "p"
#: A marked line with only plain lines between, before and after.
MARK_BEFORE, MARK_AFTER = f"{MARK}{PLAIN}*$", f"^{PLAIN}*{MARK}"


def kind_of(line: Column, n: Column) -> Column:
    return F.when(n == 0, BLANK).when(line.rlike(SENTENCE) | line.rlike(COMMA), MARK).otherwise(PLAIN)


def running(lines: Column, kinds: Column, x: Column, i: Column) -> Column:
    """Whether the line ``x``, the i-th of ``lines`` from 0, is running text; ``kinds`` are the lines' kinds."""
    beside = lambda j: F.coalesce(F.get(lines, j)["n"], F.lit(0)) >= RUNNING
    cased = F.regexp_count(x["l"], F.lit(START + r"\p{Ll}")) >= F.regexp_count(x["l"], F.lit(START + r"\p{Lu}"))
    first = F.greatest(i - REACH, F.lit(0))
    before, after = F.array_join(F.slice(kinds, first + 1, i - first), ""), F.array_join(F.slice(kinds, i + 2, F.lit(REACH)), "")
    return (x["n"] >= RUNNING) & (beside(i - 1) | beside(i + 1)) & cased & (before.rlike(MARK_BEFORE) | after.rlike(MARK_AFTER))


def line_fails(lines: Column, kinds: Column, x: Column, i: Column) -> Column:
    """Whether ``x``, the i-th line, fails a rule; lines are structs of the line ``l`` and its number of words ``n``."""
    line, n = x["l"], x["n"]
    unmarked = F.regexp_count(line, F.lit(UNMARKED)) * 2 >= F.length(F.regexp_replace(line, GAP, ""))
    rules = (
        # Punctuation: nothing in the line ends a sentence or a clause, and it isn't running text.
        ~line.rlike(SENTENCE) & ~unmarked & ~running(lines, kinds, x, i),
        # Punctuation: symbols, or exclamation marks, on nearly every other word.
        n_of(line, SYMBOLS) * 2 > n,
        (n >= 4) & (n_of(line, "!") * 2 > n),
        # Navigation: a bar or an arrow for every third word.
        (n_of(line, "|") + n_of(line, "»") + n_of(line, "›")) * 3 >= n + 1,
        # Navigation: shouted menus.
        (F.length(line) >= 20) & (F.upper(line) == line) & (F.lower(line) != line),
        # Boilerplate phrases make up a short line.
        (n <= 12) & line.rlike(BOILERPLATE),
    )
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return out


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``body`` (the whole text), its word counts and the base verdict."""
    df = only(docs, id_col, text_col).select(F.col(id_col), whole(F.col(text_col)).alias("body"))
    return measure(df)


def measure(df: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to rows that have ``body``."""
    df = df.withColumns({"_w": words(F.col("body")), "_l": F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))})
    df = df.withColumn("_n", F.size("_w"))
    # Hashes of windows of 1, 2, 4 and then 8 words, each from two of the last; without any if the text is shorter.
    df = df.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    for step in (1, 2, 4):
        df = df.withColumn("_h", F.zip_with("_h", F.slice("_h", step + 1, F.col("_n")), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_h", F.when(F.col("_n") > WINDOW, F.slice("_h", 1, F.col("_n") - (WINDOW - 1))))
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_s", lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"]))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("_p", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    df = df.withColumns(
        {
            "n_words": F.col("_n").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": n_of(F.col("body"), SYMBOLS),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).drop("_w", "_l", "_n", "_h", "_s", "_p")
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def cleaned(df: DataFrame, min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """Adds ``clean`` (the text without failed lines), n_clean_chars (without white space) and ``kept`` to measured rows."""
    df = df.withColumn("_x", F.transform(F.split("body", "\n"), lambda x: F.struct(x.alias("l"), F.regexp_count(x, F.lit(WORD)).alias("n"))))
    df = df.withColumn("_k", F.transform("_x", lambda x: kind_of(x["l"], x["n"])))
    good = F.filter("_x", lambda x, i: (x["n"] == 0) | ~line_fails(F.col("_x"), F.col("_k"), x, i))
    df = df.withColumn("clean", F.array_join(F.transform(good, lambda x: x["l"]), "\n")).drop("_x", "_k")
    df = df.withColumn("n_clean_chars", F.length(F.regexp_replace("clean", GAP, "")).cast("long"))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("n_clean_chars") >= min_kept_share * F.col("word_chars")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """One row per document: id, the counts, base_failed, kept, n_clean_chars and the cleaned text ``clean``."""
    return fixed(cleaned(measured(docs, id_col, text_col), min_kept_share).drop("body"), F.lit(True))


def fixed(df: DataFrame, kept: Column) -> DataFrame:
    """Rows of ``df`` that are ``kept``, as columns that stand for themselves.

    A filter on a computed column would be moved down to the scan with all that the column stands for, nested and so
    computed again and again.  What an array holds isn't moved.
    """
    row = F.struct(*[df[c] for c in df.columns])
    out = df.select(F.explode_outer(F.when(kept, F.array(row))).alias("_out")).filter(F.col("_out").isNotNull())
    return out.select(*[F.col("_out")[c].alias(c) for c in df.columns])


def stage(docs: DataFrame, min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """The documents that pass, with their failed lines removed, in the columns of ``docs``."""
    names = docs.columns
    df = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), whole(docs["text"]).alias("body"))
    df = cleaned(measure(df), min_kept_share)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    df = df.select("kept", *[new.get(c, F.col("_row")[c]).alias(f"_{i}") for i, c in enumerate(names)])
    return fixed(df, F.col("kept")).drop("kept").toDF(*names)


ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
windows AS (
  SELECT doc_id, i, {" || ' ' || ".join(f"lead(w, {k}) OVER d" for k in range(WINDOW))} AS win FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows WHERE win IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) AS r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs),
counted AS (SELECT *, len(regexp_extract_all(l, '{WORD}')) AS n FROM lines),
kinds AS (
  SELECT *, length(regexp_replace(l, '{GAP}', '', 'g')) AS chars, regexp_matches(l, '{SENTENCE.replace("'", "''")}') AS ends,
    CASE WHEN n = 0 THEN '{BLANK}' WHEN regexp_matches(l, '{SENTENCE.replace("'", "''")}') OR regexp_matches(l, '{COMMA}') THEN '{MARK}' ELSE '{PLAIN}' END AS kind
  FROM counted),
ruled AS (
  SELECT *, greatest(lag(n, 1, 0) OVER d, lead(n, 1, 0) OVER d) AS beside,
    coalesce(string_agg(kind, '') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {REACH} PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(kind, '') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND {REACH} FOLLOWING), '') AS after
  FROM kinds WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
judged AS (
  SELECT *, (NOT ends AND NOT len(regexp_extract_all(l, '{UNMARKED}')) * 2 >= chars
      AND NOT (n >= {RUNNING} AND beside >= {RUNNING} AND len(regexp_extract_all(l, '{START}\\p{{Ll}}')) >= len(regexp_extract_all(l, '{START}\\p{{Lu}}'))
        AND (regexp_matches(before, '{MARK_BEFORE}') OR regexp_matches(after, '{MARK_AFTER}'))))
    OR len(regexp_extract_all(l, '[#*$%&|<>]')) * 2 > n
    OR (n >= 4 AND (length(l) - length(replace(l, '!', ''))) * 2 > n)
    OR (length(l) - length(replace(l, '|', '')) + length(l) - length(replace(l, '»', '')) + length(l) - length(replace(l, '›', ''))) * 3 >= n + 1
    OR (length(l) >= 20 AND upper(l) = l AND lower(l) <> l)
    OR (n <= 12 AND regexp_matches(l, '{BOILERPLATE}')) AS fails
  FROM ruled WHERE n > 0),
summed AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE NOT fails), 0) AS n_clean_chars FROM judged GROUP BY doc_id),
base AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_clean_chars, 0) AS n_clean_chars
  FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN summed USING (doc_id)),
verdict AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND n_clean_chars >= {MIN_KEPT_SHARE} * word_chars AS kept, CAST(n_clean_chars AS BIGINT) AS n_clean_chars
FROM verdict
"""
