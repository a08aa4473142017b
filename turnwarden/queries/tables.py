"""Rules fed by tables of terms, up to tens of thousands of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import input_rules as inp
from turnwarden.operators import output_rules as out
from turnwarden.plans.registry import MASKED, VISIBLE, column_rule, scorer_rule, table_rule
from turnwarden.plans.screening import InputSettings, deterministic_input
from turnwarden.queries.common import decided, detail_of, lit, numbered, query, turns, with_turns
from turnwarden.queries.input_stage import block_sql, keyword_sql
from turnwarden.queries.streams import STACK, stack_sql
from turnwarden.sources import dimensions as dim
from turnwarden.sources.turns import read_table

WORD = r"[\p{L}\p{N}_]"
#: Leading hex digits of a word's hash that choose it: about 20,000 of the words of the smaller documents.
CHOSEN = "0123456"
BRANDED = "789abcd"


def words_sql(chosen: str) -> str:
    digits = ", ".join(lit(c) for c in chosen)
    return (f"SELECT DISTINCT w AS term FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD}+')) AS w FROM documents) "
            f"WHERE length(w) >= 6 AND substr(md5(w), 1, 1) IN ({digits})")


def words(spark, folder, chosen: str):
    """Words of the documents that their hash chooses."""
    found = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"{WORD}+"), F.lit(0))))
    return (read_table(spark, folder, "documents").select(found.alias("term")).distinct()
            .filter((F.length("term") >= 6) & F.substring(F.md5("term"), 1, 1).isin(list(chosen))))


PAIRS_SQL = (f"SELECT DISTINCT p AS term FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD}+ {WORD}+')) AS p FROM benchmark) WHERE length(p) >= 6")


def pairs(spark, folder):
    """Two words of the benchmark that stand next to each other."""
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"{WORD}+ {WORD}+"), F.lit(0)))
    return read_table(spark, folder, "benchmark").select(found.alias("term")).filter(F.length("term") >= 6).distinct()


def windows_sql(source: str) -> str:
    """Every text is cut into the windows that begin where a word begins; keys of six characters find the terms that may stand there."""
    return f"""letters AS (SELECT doc_id, lower(text) AS t, string_split(lower(text), '') AS c FROM {source} WHERE text <> ''),
    places AS (SELECT doc_id, t, unnest(list_filter(range(1, len(c) + 1), lambda i: regexp_matches(c[i], '{WORD}')
               AND (i = 1 OR NOT regexp_matches(c[i - 1], '{WORD}')))) AS i FROM letters),
    windows AS (SELECT doc_id, substr(t, i, 64) AS w FROM places)"""


WINDOWS_SQL = windows_sql("documents")


@query("keyword_screen_table", f"""WITH list AS ({words_sql(CHOSEN)} UNION {PAIRS_SQL}),
    terms AS (SELECT row_number() OVER (ORDER BY term DESC) AS ord, term FROM list), {WINDOWS_SQL},
    first AS (SELECT doc_id, arg_min(term, ord) AS term FROM windows JOIN terms ON substr(w, 1, 6) = substr(term, 1, 6)
              WHERE starts_with(w, term) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN term IS NOT NULL THEN 1 END AS blocked_by, 'banned keyword: ''' || term || '''' AS detail, text
    FROM documents LEFT JOIN first USING (doc_id)""")
def _(spark, folder):
    listed = words(spark, folder, CHOSEN).union(pairs(spark, folder)).distinct()
    terms = numbered(listed, F.col("term").desc()).select(F.col("n").alias("ord"), "term")
    return decided(inp.keyword_screen_table(read_table(spark, folder, "documents").select("doc_id", "text"), terms), "doc_id")


# The list that the stack holds in its plan, as the table that a job would load.
@query("keyword_screen_terms", with_turns(block_sql("turns", "turn_id", 1, keyword_sql(fixed.BANNED_KEYWORDS))))
def _(spark, folder):
    return decided(inp.keyword_screen_table(turns(spark, folder), dim.terms(spark).filter("list_name = 'banned'")), "turn_id")


@query("brand_scrub_table", f"""WITH terms AS ({words_sql(BRANDED)}),
    parts AS (SELECT doc_id, regexp_extract_all(text, '{WORD}+|[^\\p{{L}}\\p{{N}}_]+') AS p FROM documents),
    numbered AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS i FROM parts),
    marked AS (SELECT doc_id, i, part, term FROM numbered LEFT JOIN terms ON lower(part) = term),
    done AS (SELECT doc_id, string_agg(CASE WHEN term IS NULL THEN part ELSE {lit(fixed.BRAND_MASK)} END, '' ORDER BY i) AS text,
                    string_agg(DISTINCT term, ', ' ORDER BY term) AS names FROM marked GROUP BY doc_id)
    SELECT doc_id, left('scrubbed: ' || names, 300) AS detail, coalesce(done.text, d.text) AS text FROM documents d LEFT JOIN done USING (doc_id)""")
def _(spark, folder):
    terms = numbered(words(spark, folder, BRANDED), "term").select(F.col("n").alias("ord"), "term")
    done = out.brand_scrub_table(read_table(spark, folder, "documents").select("doc_id", "text"), terms)
    return done.select("doc_id", detail_of().alias("detail"), "text")


# ---------------------------------------------------------------------------------------------- a user's own rules in the stack

def digit_share():
    """A model that a user brings: the share of digits; nothing for an empty text."""
    def model(texts):
        return texts.map(lambda t: sum("0" <= c <= "9" for c in t) / len(t) if t else None).astype(float)
    return model


SHARE = 0.01
OWN_STACK = [STACK[0], STACK[1], STACK[2], (31, "CASE WHEN regexp_matches(text, '[A-Z]{6}') THEN '' END", "visible"), *STACK[3:6], STACK[6],
             (32, "CASE WHEN doc_id IN (SELECT doc_id FROM listed) THEN '' END", "masked"), STACK[7],
             (33, f"CASE WHEN len(regexp_extract_all(text, '[0-9]')) / nullif(length(text), 0) >= {SHARE} THEN '' END", "masked")]


# Three foreign rules at their places: a condition, a table of phrases, a scorer over batches of text.
@query("screen_own_rules", stack_sql(OWN_STACK, f"""terms AS ({PAIRS_SQL}), {windows_sql('masked')},
    listed AS (SELECT DISTINCT doc_id FROM windows JOIN terms ON substr(w, 1, 6) = substr(term, 1, 6) WHERE starts_with(w, term))""")
       + "SELECT doc_id, blocked_by FROM decided")
def _(spark, folder):
    terms = numbered(pairs(spark, folder), "term").select(F.col("n").alias("ord"), "term")
    own = [column_rule(31, "Capitals", lambda t: F.when(t.rlike("[A-Z]{6}"), F.lit("capitals")), VISIBLE, 22),
           table_rule(32, "Listed phrases", terms, MASKED, 1), scorer_rule(33, "Digits", digit_share, SHARE)]
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return deterministic_input(docs, InputSettings(own=own)).select("doc_id", "blocked_by")
