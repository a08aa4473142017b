"""Lookups, history and question-answer pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import lookups as look
from turnwarden.operators.conversations import conversation_pairs, history_context
from turnwarden.queries.common import lit, numbered, query, sql_joined, sql_values, turns, with_turns
from turnwarden.queries.tool_stage import CALLS_SQL, calls
from turnwarden.sources import dimensions as dim
from turnwarden.sources.turns import read_table


def kb_sql(source: str, key: str, kb: list[tuple[str, str]]) -> str:
    hits = [f"CASE WHEN contains(lower(text), {lit(t)}) THEN {lit(f'[{t}] {x}')} END" for t, x in kb]
    joined = sql_joined(hits, "\n")
    return f"SELECT {key}, CASE WHEN {joined} <> '' THEN {joined} ELSE {lit(fixed.KB_MISS)} END AS kb_result FROM {source}"


@query("kb_match", with_turns(kb_sql("turns", "turn_id", fixed.KNOWLEDGE_BASE)))
def _(spark, folder):
    return look.kb_match(turns(spark, folder), dim.knowledge_base(spark)).select("turn_id", "kb_result")


WIDE_KB = fixed.KNOWLEDGE_BASE + [("worthless", "Value."), ("token", "Access."), ("er", "Suffix."), ("über", "Prefix."),
                                  ("license", "Terms."), ("ing", "Form.")]


def _wide_kb(spark, folder):
    kb = dim.table(spark, [(i, t, x) for i, (t, x) in enumerate(WIDE_KB)], "ord int, topic string, text string")
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return look.kb_match(docs, kb).select("doc_id", "kb_result")


@query("kb_match_documents", kb_sql("documents", "doc_id", WIDE_KB))
def _(spark, folder):
    return _wide_kb(spark, folder)


@query("kb_match_joined", kb_sql("documents", "doc_id", WIDE_KB))
def _(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return _wide_kb(spark, folder).join(docs.select("doc_id"), "doc_id", "left_semi")


# A table of entries from the data: topics that no text holds, that many hold, an empty one, some without a text, some repeated.
KB_TABLE_SQL = """kb AS (SELECT CAST(item_id AS INTEGER) AS ord, topic, CASE WHEN item_id % 11 <> 3 THEN 'entry ' || item_id END AS text
    FROM (SELECT item_id, unnest([lower(substr(text, 1, 24)), lower(substr(text, 30, 9)), substr(text, 2, 3),
          CASE WHEN item_id % 20 = 4 THEN '' WHEN item_id % 20 = 5 THEN NULL ELSE 'er' END]) AS topic FROM benchmark))"""


# Every third text is null, every fifth empty; the rows stand twice.
ASKED_SQL = """(SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END AS text FROM documents
    UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN NULL WHEN doc_id % 5 = 1 THEN '' ELSE text END FROM documents)"""


@query("kb_match_table", f"""WITH {KB_TABLE_SQL}, asked AS {ASKED_SQL}, hits AS (
      SELECT text, string_agg('[' || topic || '] ' || entry, chr(10) ORDER BY ord, '[' || topic || '] ' || entry) AS hits
      FROM (SELECT DISTINCT a.text, ord, topic, kb.text AS entry FROM (SELECT DISTINCT text FROM asked WHERE text IS NOT NULL) a
            JOIN kb ON contains(lower(a.text), topic) WHERE kb.text IS NOT NULL) GROUP BY text)
    SELECT doc_id, coalesce(hits, {lit(fixed.KB_MISS)}) AS kb_result FROM asked LEFT JOIN hits USING (text)""")
def _(spark, folder):
    item, text = F.col("item_id"), F.col("text")
    topics = F.array(F.lower(F.substring(text, 1, 24)), F.lower(F.substring(text, 30, 9)), F.substring(text, 2, 3),
                     F.when(item % 20 == 4, F.lit("")).when(item % 20 == 5, F.lit(None)).otherwise(F.lit("er")))
    kb = read_table(spark, folder, "benchmark").select(item.cast("int").alias("ord"), F.explode(topics).alias("topic"), F.when(
        item % 11 != 3, F.concat(F.lit("entry "), item.cast("string"))).alias("text"))
    docs = read_table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 1, F.lit(None)).when(
        F.col("doc_id") % 5 == 1, F.lit("")).otherwise(F.col("text")).alias("text"))
    return look.kb_match(docs.unionByName(docs), kb).select("doc_id", "kb_result")


MEDICATIONS = ["Ibuprofen", " paracetamol ", "aspirin", "SLEEP", "cold\t"]
MEDICATION_SQL = f"[{', '.join(lit(m) for m in MEDICATIONS)}][CAST(k % {len(MEDICATIONS)} + 1 AS INTEGER)]"


@query("medication_lookup", f"""WITH {CALLS_SQL}, asked AS (SELECT call_id, {MEDICATION_SQL} AS medication FROM calls
        WHERE tool_name = 'get_medication_info'), kb AS (SELECT * FROM (VALUES {sql_values(fixed.KNOWLEDGE_BASE)}) v(topic, text))
    SELECT call_id, medication, coalesce(text, 'No AcmeHealth monograph for ''' || medication
           || '''. Always follow your prescriber''s instructions.') AS medication_info
    FROM asked LEFT JOIN kb ON regexp_replace(lower(medication), '^\\s+|\\s+$', '', 'g') = topic""")
def _(spark, folder):
    asked = calls(spark, folder).filter("tool_name = 'get_medication_info'").select("call_id", F.element_at(
        F.array(*[F.lit(m) for m in MEDICATIONS]), F.expr(f"cast(k % {len(MEDICATIONS)} + 1 as int)")).alias("medication"))
    return look.medication_lookup(asked, dim.knowledge_base(spark))


@query("record_lookup", f"""WITH {CALLS_SQL}, asked AS (SELECT call_id, ' p-100' || (k % 4) AS patient_id FROM calls
        WHERE tool_name = 'view_patient_record'), records AS (SELECT * FROM (VALUES {sql_values(fixed.PATIENT_RECORDS)}) v(id, text))
    SELECT call_id, patient_id, coalesce(text, 'No record for ' || patient_id || '.') AS record
    FROM asked LEFT JOIN records ON upper(trim(patient_id)) = id""")
def _(spark, folder):
    asked = calls(spark, folder).filter("tool_name = 'view_patient_record'").select(
        "call_id", F.concat(F.lit(" p-100"), (F.col("k") % 4).cast("string")).alias("patient_id"))
    return look.record_lookup(asked, dim.patient_records(spark))


DOMAINS = fixed.TRUSTED_DOMAINS + ["example.com", "m.thther.example.org", "net"]
SITE_ARTICLES = fixed.ARTICLES + [("/en/", "English."), ("example.com", "Com."), ("example.net", "Net.")]
HOST_SQL = r"lower(regexp_extract(url, '(?i)^https?://([^/?#@:\[]+)', 1))"
TRUSTED_SQL = " OR ".join(f"{HOST_SQL} = '{d}' OR ends_with({HOST_SQL}, '.{d}')" for d in DOMAINS)
FIRST_ARTICLE = "CASE " + " ".join(f"WHEN contains(url, {lit(d)}) THEN {lit(t)}" for d, t in SITE_ARTICLES) + " END"
ARTICLE_SQL = f"""
    SELECT page_id, url, {TRUSTED_SQL} AS trusted, CASE WHEN NOT ({TRUSTED_SQL})
           THEN 'Refused: ' || url || ' is not on the trusted-domain list.'
           ELSE coalesce({FIRST_ARTICLE}, {lit(fixed.ARTICLE_MISS)}) END AS article FROM pages"""


def _articles(spark, folder):
    domains = dim.table(spark, [(d,) for d in DOMAINS], "domain string")
    articles = dim.table(spark, [(i, d, t) for i, (d, t) in enumerate(SITE_ARTICLES)], "ord int, domain string, text string")
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    return look.article_lookup(pages, domains, articles)


@query("article_lookup", ARTICLE_SQL)
def _(spark, folder):
    return _articles(spark, folder)


@query("article_lookup_joined", ARTICLE_SQL)
def _(spark, folder):
    return _articles(spark, folder).dropDuplicates(["page_id", "url"])


# Articles for the paths and hosts that the pages have themselves: more than a pattern takes.
@query("article_lookup_table", f"""WITH parts AS (SELECT DISTINCT substr(url, 9, 12) AS domain FROM pages),
    articles AS (SELECT CAST(row_number() OVER (ORDER BY domain) AS INTEGER) AS ord, domain, 'About ' || domain AS text FROM parts),
    first AS (SELECT url, min(ord) AS ord FROM (SELECT DISTINCT url FROM pages WHERE {TRUSTED_SQL}) u JOIN articles ON contains(url, domain) GROUP BY url)
    SELECT page_id, url, {TRUSTED_SQL} AS trusted, CASE WHEN NOT ({TRUSTED_SQL}) THEN 'Refused: ' || url || ' is not on the trusted-domain list.'
           ELSE coalesce(text, {lit(fixed.ARTICLE_MISS)}) END AS article
    FROM pages LEFT JOIN first USING (url) LEFT JOIN articles USING (ord)""")
def _(spark, folder):
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    parts = pages.select(F.substring("url", 9, 12).alias("domain")).distinct()
    articles = numbered(parts, "domain").select(F.col("n").cast("int").alias("ord"), "domain", F.concat(F.lit("About "), F.col("domain")).alias("text"))
    return look.article_lookup(pages, dim.table(spark, [(d,) for d in DOMAINS], "domain string"), articles)


@query("history_context", with_turns("""
    SELECT turn_id, session_id, array_to_string(coalesce(list(text) OVER (PARTITION BY session_id ORDER BY turn_id
           ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), []), ' | ') AS history FROM turns"""))
def _(spark, folder):
    return history_context(turns(spark, folder)).select("turn_id", "session_id",
                                                        F.array_join("history", " | ").alias("history"))


PAIRS_SQL = """
    SELECT conv_id, turn, text AS question, answer FROM (
      SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE role = 'user' AND next_role = 'assistant'"""


@query("conversation_pairs", PAIRS_SQL)
def _(spark, folder):
    return conversation_pairs(read_table(spark, folder, "conversations"))


@query("requests_per_user_history", """
    SELECT user_id, event_id, array_to_string(coalesce(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id
           ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), []), ' | ') AS history FROM events""")
def _(spark, folder):
    events = read_table(spark, folder, "events").select("user_id", "event_id", "event_type")
    done = history_context(events, session="user_id", order="event_id", content="event_type")
    return done.select("user_id", "event_id", F.array_join("history", " | ").alias("history"))
