"""Input rules, one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import input_rules as inp
from turnwarden.operators.rate_limit import rate_limit
from turnwarden.queries.common import (TRUST_SQL, URL_SQL, decided, detail_of, lit, query, sql_any, sql_first,
                                       sql_first_contained, sql_labels, sql_rewrite, turns, with_turns)
from turnwarden.sources.turns import read_table


def block_sql(table: str, key: str, number: int, detail: str) -> str:
    return (f"SELECT {key}, CASE WHEN d IS NOT NULL THEN {number} END AS blocked_by, left(d, 300) AS detail, text "
            f"FROM (SELECT {key}, text, {detail} AS d FROM {table})")


def keyword_sql(terms, boundary=True, column="lower(text)") -> str:
    edge = r"\b" if boundary else ""
    return "'banned keyword: ''' || " + "(" + sql_first(column, [(t, edge + t) for t in terms]) + ") || ''''"


@query("keyword_screen", with_turns(block_sql("turns", "turn_id", 1, keyword_sql(fixed.BANNED_KEYWORDS))))
def _(spark, folder):
    return decided(inp.keyword_screen(turns(spark, folder)), "turn_id")


PLAIN = ["worthless", "clown", "license", "token"]


@query("keyword_screen_plain", block_sql("documents", "doc_id", 1, keyword_sql(PLAIN, boundary=False)))
def _(spark, folder):
    return decided(inp.keyword_screen(read_table(spark, folder, "documents"), PLAIN, boundary=False), "doc_id")


COUNTED = fixed.BANNED_KEYWORDS + ["worthless", "clown", "idiot", "license", "the", "ver"]


@query("keyword_hits", " UNION ALL ".join(
    f"SELECT {lit(t)} AS term, count(*) AS texts, CAST(sum(n) AS BIGINT) AS hits FROM "
    f"(SELECT len(regexp_extract_all(lower(text), {lit('(?:^|[^\\p{L}\\p{N}_])' + t)})) AS n FROM documents) "
    f"WHERE n > 0 HAVING count(*) > 0" for t in COUNTED))
def _(spark, folder):
    return inp.keyword_hits(read_table(spark, folder, "documents"), COUNTED)


INJECTION_SQL = "'pattern: ' || (" + sql_first("text", [(p, p) for p in fixed.INJECTION_PATTERNS], "i") + ")"


@query("injection_screen", with_turns(block_sql("turns", "turn_id", 2, INJECTION_SQL)))
def _(spark, folder):
    return decided(inp.injection_screen(turns(spark, folder)), "turn_id")


@query("injection_phrase_screen", with_turns(block_sql(
    "turns", "turn_id", 2, "'phrase: ' || (" + sql_first_contained("lower(text)", fixed.INJECTION_PHRASES) + ")")))
def _(spark, folder):
    return decided(inp.injection_phrase_screen(turns(spark, folder)), "turn_id")


def length_sql(limit: int) -> str:
    return f"CASE WHEN length(text) > {limit} THEN length(text) || ' chars > {limit}' END"


@query("length_screen", with_turns(block_sql("turns", "turn_id", 4, length_sql(2000))))
def _(spark, folder):
    return decided(inp.length_screen(turns(spark, folder)), "turn_id")


@query("length_screen_documents", block_sql("documents", "doc_id", 4, length_sql(4000)))
def _(spark, folder):
    return decided(inp.length_screen(read_table(spark, folder, "documents"), 4000), "doc_id")


def mask_steps_sql(source: str, key: str, labelled) -> str:
    """The masking as a chain of sub-queries, one per kind."""
    q = f"SELECT {key}, text AS raw, text FROM {source}"
    for name, p in labelled:
        q = (f"SELECT {key}, raw, CASE WHEN regexp_matches(raw, {lit(p)}) THEN "
             + sql_rewrite("text", p, "repeat('*', length(m))") + f" ELSE text END AS text FROM ({q})")
    return q


def pii_mask_sql(source: str, key: str) -> str:
    every = fixed.INPUT_PII_PATTERNS + fixed.CUSTOM_PII_PATTERNS
    own, extra = sql_labels("raw", fixed.INPUT_PII_PATTERNS), sql_labels("raw", fixed.CUSTOM_PII_PATTERNS)
    return (f"SELECT {key}, CASE WHEN {own} <> '' THEN 'masked: ' || {own} END AS builtin, "
            f"CASE WHEN {extra} <> '' THEN 'masked: ' || {extra} END AS custom, text "
            f"FROM ({mask_steps_sql(source, key, every)})")


def _pii(df, key):
    done = inp.pii_screen(df, custom=fixed.CUSTOM_PII_PATTERNS)
    return done.select(key, detail_of(5).alias("builtin"), detail_of(6).alias("custom"), "text")


@query("pii_mask", with_turns(pii_mask_sql("turns", "turn_id")))
def _(spark, folder):
    return _pii(turns(spark, folder), "turn_id")


@query("pii_mask_documents", pii_mask_sql("documents", "doc_id"))
def _(spark, folder):
    return _pii(read_table(spark, folder, "documents"), "doc_id")


HEX_TOKEN = ("hex token", r"token\s*=\s*\"[0-9a-f]+\"")
BLOCKING = [fixed.API_KEY_PATTERN, HEX_TOKEN, *fixed.REGIONAL_PII_PATTERNS]


@query("pii_block", "SELECT doc_id, CASE WHEN d <> '' THEN 5 END AS blocked_by, "
                    "CASE WHEN d <> '' THEN 'detected: ' || d END AS detail, text FROM "
                    f"(SELECT doc_id, text, {sql_labels('text', [p for p in fixed.INPUT_PII_PATTERNS if p[0] == 'Email'] + BLOCKING)} AS d "
                    "FROM documents)")
def _(spark, folder):
    return decided(inp.pii_screen(read_table(spark, folder, "documents"), builtin=["Email"], custom=BLOCKING,
                                  mode="block"), "doc_id")


CRISIS_SQL = "'signal: ''' || (" + sql_first_contained("lower(text)", fixed.CRISIS_SIGNALS) + ") || ''''"


@query("crisis_signal_screen", with_turns(block_sql("turns", "turn_id", 16, CRISIS_SQL)))
def _(spark, folder):
    return decided(inp.crisis_signal_screen(turns(spark, folder)), "turn_id")


HIDDEN_SQL = r"[\p{Cf}\p{Co}\x{E0000}-\x{E007F}]"
TAG_SQL = r"[\x{E0000}-\x{E007F}]"
PAYLOAD_SQL = (f"'hidden payload: ''' || array_to_string(list_transform(regexp_extract_all(text, {lit(TAG_SQL)}), "
               "lambda c: chr(unicode(c) - 917504)), '') || ''''")
STRIPPED_SQL = (f"'stripped ' || len(list_distinct(regexp_extract_all(text, {lit(HIDDEN_SQL)}))) "
                "|| ' invisible character type(s)'")


def invisible_sql(source: str, key: str) -> str:
    return f"""
    SELECT {key}, CASE WHEN regexp_matches(text, {lit(TAG_SQL)}) THEN 19 END AS blocked_by,
           CASE WHEN regexp_matches(text, {lit(TAG_SQL)}) THEN {PAYLOAD_SQL}
                WHEN regexp_matches(text, {lit(HIDDEN_SQL)}) THEN {STRIPPED_SQL} END AS detail,
           CASE WHEN regexp_matches(text, {lit(TAG_SQL)}) THEN text
                ELSE regexp_replace(text, {lit(HIDDEN_SQL)}, '', 'g') END AS text
    FROM {source}"""


@query("invisible_text_screen", with_turns(invisible_sql("turns", "turn_id")))
def _(spark, folder):
    return decided(inp.invisible_text_screen(turns(spark, folder)), "turn_id")


@query("invisible_text_block", block_sql(
    "documents", "doc_id", 19, f"CASE WHEN regexp_matches(text, {lit(HIDDEN_SQL)}) THEN 'hidden characters' END"))
def _(spark, folder):
    return decided(inp.invisible_text_screen(read_table(spark, folder, "documents"), strip=False), "doc_id")


SECRETS_SQL = f"CASE WHEN {sql_labels('text', fixed.SECRET_PATTERNS)} <> '' THEN 'found: ' || {sql_labels('text', fixed.SECRET_PATTERNS)} END"


@query("secrets_screen", with_turns(block_sql("turns", "turn_id", 20, SECRETS_SQL)))
def _(spark, folder):
    return decided(inp.secrets_screen(turns(spark, folder)), "turn_id")


SITE_SECRETS = [*fixed.SECRET_PATTERNS, ("Hex token", HEX_TOKEN[1])]


@query("secrets_screen_documents", block_sql(
    "documents", "doc_id", 20,
    f"CASE WHEN {sql_labels('text', SITE_SECRETS)} <> '' THEN 'found: ' || {sql_labels('text', SITE_SECRETS)} END"))
def _(spark, folder):
    return decided(inp.secrets_screen(read_table(spark, folder, "documents"), SITE_SECRETS), "doc_id")


FOUR_ALIKE = "|".join(f"{c}{{4}}" for c in "abcdefghijklmnopqrstuvwxyz")


def gibberish_detail_sql(column: str = "text") -> str:
    words = f"regexp_extract_all({column}, '[A-Za-z]+')"
    mash = (f"len(list_filter({words}, lambda w: length(w) >= 4 AND (NOT regexp_matches(w, '[aeiouy]', 'i') "
            f"OR regexp_matches(w, '[^aeiouy]{{5,}}', 'i') OR regexp_matches(lower(w), '{FOUR_ALIKE}'))))")
    symbols = f"length(regexp_replace({column}, '[\\p{{L}}\\p{{N}}\\s\\p{{Z}}]+', '', 'g'))"
    return (f"CASE WHEN length({column}) >= 20 AND {symbols} / length({column}) > 0.4 THEN 'mostly symbols' "
            f"WHEN len({words}) >= 3 AND {mash} / len({words}) > 0.5 "
            f"THEN CAST(CAST(round_even({mash} / len({words}) * 100, 0) AS INTEGER) AS VARCHAR) || '% gibberish words' END")


@query("gibberish_screen", block_sql("documents", "doc_id", 22, gibberish_detail_sql()))
def _(spark, folder):
    return decided(inp.gibberish_screen(read_table(spark, folder, "documents")), "doc_id")


@query("gibberish_screen_turns", with_turns(block_sql("turns", "turn_id", 22, gibberish_detail_sql())))
def _(spark, folder):
    return decided(inp.gibberish_screen(turns(spark, folder)), "turn_id")


def bad_links_sql(column: str) -> str:
    return (f"list_filter(regexp_extract_all({column}, {lit('(?i:' + URL_SQL + ')')}), "
            f"lambda u: NOT regexp_matches(u, {lit(TRUST_SQL)}, 'i'))")


def url_detail_sql(column: str = "text") -> str:
    return f"CASE WHEN len({bad_links_sql(column)}) > 0 THEN 'blocked: ' || array_to_string({bad_links_sql(column)}, ', ') END"


@query("url_screen", with_turns(block_sql("turns", "turn_id", 23, url_detail_sql())))
def _(spark, folder):
    return decided(inp.url_screen(turns(spark, folder)), "turn_id")


@query("url_screen_pages", block_sql("(SELECT page_id, url || chr(10) || html AS text FROM pages)", "page_id", 23,
                                     url_detail_sql()))
def _(spark, folder):
    pages = read_table(spark, folder, "pages")
    return decided(inp.url_screen(pages.select("page_id", F.concat_ws("\n", "url", "html").alias("text"))), "page_id")


def rate_limit_sql(source: str, key: str, user: str, ts: str, limit: int, seconds: int) -> str:
    """CTE texts (``attempts``, ``fold``): admission by recursion over each user's requests."""
    window = seconds * 1_000_000
    return f"""attempts AS (
        SELECT coalesce(CAST({user} AS VARCHAR), 'anonymous') AS u, epoch_us({ts}) AS tm, {key} AS id,
               row_number() OVER (PARTITION BY coalesce(CAST({user} AS VARCHAR), 'anonymous')
                                  ORDER BY {ts}, {key}) AS rn
        FROM {source}),
      fold AS (
        SELECT u, rn, id, [tm] AS q, true AS admitted FROM attempts WHERE rn = 1
        UNION ALL
        SELECT u, rn, id, CASE WHEN len(kept) < {limit} THEN list_append(kept, tm) ELSE kept END, len(kept) < {limit}
        FROM (SELECT a.u, a.rn, a.id, a.tm, list_filter(f.q, lambda x: a.tm - x <= {window}) AS kept
              FROM fold f JOIN attempts a ON a.u = f.u AND a.rn = f.rn + 1))"""


@query("rate_limit", f"WITH RECURSIVE {rate_limit_sql('events', 'event_id', 'user_id', 'ts', 3, 86400)} "
                     "SELECT id, u AS user, admitted FROM fold")
def _(spark, folder):
    return rate_limit(read_table(spark, folder, "events"), "event_id", "user_id", "ts", 3, 86400)


@query("rate_limit_turns", f"WITH RECURSIVE {with_turns('', '')[5:].rstrip().rstrip(',')}, "
                           f"{rate_limit_sql('turns', 'turn_id', 'user_id', 'ts', 10, 60)} "
                           "SELECT id, u AS user, admitted FROM fold")
def _(spark, folder):
    return rate_limit(turns(spark, folder), "turn_id", "user_id", "ts")


# One row per rule: how many documents each row-local rule would stop. A single pass over the table.
@query("block_counts_by_language", f"""
    SELECT lang, count(*) AS documents,
           count(*) FILTER (WHERE {sql_any('text', fixed.INJECTION_PATTERNS, 'i')}) AS injections,
           count(*) FILTER (WHERE {sql_any('text', [p for _, p in SITE_SECRETS])}) AS secrets,
           count(*) FILTER (WHERE {sql_any('text', [p for _, p in fixed.INPUT_PII_PATTERNS])}) AS personal,
           count(*) FILTER (WHERE length(text) > 2000) AS too_long
    FROM documents GROUP BY lang""")
def _(spark, folder):
    from turnwarden.functions.patterns import any_of
    text = F.col("text")
    return read_table(spark, folder, "documents").groupBy("lang").agg(
        F.count("*").alias("documents"),
        F.count_if(text.rlike(any_of(fixed.INJECTION_PATTERNS, True))).alias("injections"),
        F.count_if(text.rlike(any_of([p for _, p in SITE_SECRETS]))).alias("secrets"),
        F.count_if(text.rlike(any_of([p for _, p in fixed.INPUT_PII_PATTERNS]))).alias("personal"),
        F.count_if(F.length(text) > 2000).alias("too_long"))
