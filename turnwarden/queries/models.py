"""Judgements: verdict tables joined in, and scorers trained on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import grounding as gr
from turnwarden.operators import input_rules as inp
from turnwarden.operators import language as lang
from turnwarden.operators import lookups as look
from turnwarden.operators import output_rules as out
from turnwarden.operators import scorers
from turnwarden.operators import tfidf as tf
from turnwarden.operators import verdict_rules as ver
from turnwarden.plans import evaluation as ev
from turnwarden.queries.common import answers, detail_of, lit, query, sql_values, turns, with_turns
from turnwarden.queries.input_stage import INJECTION_SQL, CRISIS_SQL
from turnwarden.queries.lookups import PAIRS_SQL, kb_sql
from turnwarden.queries.output_stage import PROFANITY_SQL
from turnwarden.operators.conversations import conversation_pairs
from turnwarden.sources import dimensions as dim
from turnwarden.sources.turns import read_table

# ---------------------------------------------------------------------------------------------- verdict tables


def verdicts(df):
    """A judge's answers to the laid-over turns; some turns have no answer to some question."""
    none, text = F.lit(None), F.lit(None).cast("string")

    def row(rule, label=text, confidence=none.cast("double"), attack=none.cast("boolean"),
            categories=none.cast("map<string,boolean>"), chunk=0):
        return F.struct(F.lit(rule).alias("rule"), F.lit(chunk).alias("chunk_no"), label.alias("label"),
                        confidence.cast("double").alias("confidence"), attack.cast("boolean").alias("attack"),
                        categories.alias("categories"))
    k = F.col("k")
    flags = F.create_map(F.lit("violence"), k.isin(17, 10), F.lit("harassment"), (k == 17) & (F.col("conv_id") % 2 == 1))
    rows = [
        F.when(k != 39, row(3, F.when(k == 2, F.lit("OFF_TOPIC")).otherwise(F.lit("ON_TOPIC")))),
        F.when(k != 38, row(16, F.when(k == 7, F.lit("YES, RISK")).otherwise(F.lit("NO")))),
        F.when(k != 37, row(7, categories=flags)),
        F.when(k != 36, row(18, F.when(k.isin(8, 20, 21), F.lit("jailbreak")).otherwise(F.lit("none")),
                            F.when(k == 8, F.lit(0.92)).when(k == 20, F.lit(0.4)), k.isin(8, 20, 21))),
        F.when(k == 3, row(18, F.lit("none"), F.lit(0.1), F.lit(False), chunk=1)),
        F.when(k != 35, row(2, F.when(k == 18, F.lit("YES")).otherwise(F.lit("NO")))),
        F.when(k != 34, row(12, F.when(k == 11, F.lit("UNSAFE")).otherwise(F.lit("SAFE")))),
        F.when(k != 33, row(30, F.when(k == 12, F.lit("IRRELEVANT")).otherwise(F.lit("RELEVANT")))),
    ]
    return df.select("turn_id", F.explode(F.array_compact(F.array(*rows))).alias("v")).select("turn_id", "v.*")


def one_detail(df, *keys):
    return df.select(*keys, "blocked_by", detail_of().alias("detail"))


@query("topical_screen", with_turns("""
    SELECT turn_id, CASE WHEN k = 2 THEN 3 END AS blocked_by, CASE k WHEN 39 THEN 'check unavailable (no verdict), failing open'
           WHEN 2 THEN 'judge: OFF_TOPIC' END AS detail FROM turns"""))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.topical_screen(t, verdicts(t)), "turn_id")


@query("topical_screen_closed", with_turns("""
    SELECT turn_id, CASE WHEN k IN (2, 39) THEN 3 END AS blocked_by,
           CASE k WHEN 39 THEN 'check unavailable (no verdict), failing closed' WHEN 2 THEN 'judge: OFF_TOPIC' END AS detail FROM turns"""))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.topical_screen(t, verdicts(t), fail_closed=True), "turn_id")


MODERATION_SQL = ("CASE WHEN k = 37 THEN 'moderation unavailable (no verdict), failing closed' "
                  "WHEN k = 17 AND conv_id % 2 = 1 THEN 'flagged: violence, harassment' "
                  "WHEN k IN (17, 10) THEN 'flagged: violence' END")


@query("moderation_screen", with_turns(
    f"SELECT turn_id, CASE WHEN d IS NOT NULL THEN 7 END AS blocked_by, d AS detail FROM (SELECT turn_id, {MODERATION_SQL} AS d FROM turns)"))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.moderation_screen(t, verdicts(t)), "turn_id")


@query("moderation_screen_categories", with_turns(
    f"SELECT turn_id, CASE WHEN d IS NOT NULL THEN 7 END AS blocked_by, d AS detail FROM (SELECT turn_id, "
    f"CASE WHEN k = 37 OR (k = 17 AND conv_id % 2 = 1) THEN {MODERATION_SQL} END AS d FROM turns)"))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.moderation_screen(t, verdicts(t), ["harassment"]), "turn_id")


@query("crisis_screen", with_turns(f"""
    SELECT turn_id, CASE WHEN s IS NOT NULL OR k = 7 THEN 16 END AS blocked_by,
           CASE WHEN s IS NOT NULL THEN s WHEN k = 38 THEN 'check unavailable (no verdict), failing open'
                WHEN k = 7 THEN 'judge: risk detected' END AS detail FROM (SELECT *, {CRISIS_SQL} AS s FROM turns)"""))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.crisis_judge_screen(inp.crisis_signal_screen(t), verdicts(t)), "turn_id")


@query("injection_with_judge", with_turns(f"""
    SELECT turn_id, CASE WHEN p IS NOT NULL OR k = 18 THEN 2 END AS blocked_by,
           CASE WHEN p IS NOT NULL THEN p WHEN k = 18 THEN 'judge: injection' END AS detail
    FROM (SELECT *, {INJECTION_SQL} AS p FROM turns)"""))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.injection_judge_screen(inp.injection_screen(t), verdicts(t)), "turn_id")


@query("prompt_attack_screen", with_turns("""
    SELECT turn_id, CASE WHEN k IN (8, 21) THEN 18 END AS blocked_by,
           CASE k WHEN 36 THEN 'check unavailable (no verdict), failing open' WHEN 8 THEN 'jailbreak (confidence 0.92)'
                  WHEN 21 THEN CASE WHEN length(text) <= 1500 THEN 'jailbreak (confidence 1.00)' END END AS detail
    FROM (SELECT * FROM turns) WHERE NOT (length(text) > 1500 AND k <> 3)
    UNION ALL
    SELECT turn_id, CASE WHEN k IN (8, 21) THEN 18 END,
           CASE WHEN k IN (8, 21) THEN CASE k WHEN 8 THEN 'jailbreak (confidence 0.92)' ELSE 'jailbreak (confidence 1.00)' END
                ELSE 'check unavailable (no verdict), failing open' END
    FROM turns WHERE length(text) > 1500 AND k <> 3"""))
def _(spark, folder):
    t = turns(spark, folder)
    return one_detail(ver.prompt_attack_screen(t, verdicts(t)), "turn_id")


@query("text_chunks", """
    SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, substr(text, CAST(chunk_no * 1500 + 1 AS BIGINT), 1500) AS chunk
    FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil(length(text) / 1500.0) AS BIGINT), 1))) AS chunk_no FROM documents)""")
def _(spark, folder):
    return ver.text_chunks(read_table(spark, folder, "documents"), "doc_id")


def replaced(df, *keys):
    return df.select(*keys, detail_of().alias("detail"), "text")


@query("moderation_replace", with_turns(f"""
    SELECT turn_id, CASE WHEN k = 37 THEN 'moderation unavailable (no verdict), withheld'
           WHEN k = 17 AND conv_id % 2 = 1 THEN 'flagged: violence, harassment' WHEN k IN (17, 10) THEN 'flagged: violence' END AS detail,
           CASE WHEN k IN (37, 17, 10) THEN {lit(fixed.SAFE_REPLACEMENT)} ELSE text END AS text FROM answers"""))
def _(spark, folder):
    a = answers(spark, folder)
    return replaced(ver.moderation_replace(a, verdicts(a)), "turn_id")


@query("policy_judge", with_turns(f"""
    SELECT turn_id, CASE k WHEN 34 THEN 'judge unavailable (no verdict), failing open'
           WHEN 11 THEN 'judge: UNSAFE, response replaced' END AS detail,
           CASE WHEN k = 11 THEN {lit(fixed.SAFE_REPLACEMENT)} ELSE text END AS text FROM answers"""))
def _(spark, folder):
    a = answers(spark, folder)
    return replaced(ver.policy_judge(a, verdicts(a)), "turn_id")


@query("relevance_check", with_turns(f"""
    SELECT a.turn_id, CASE WHEN t.text IS NULL THEN NULL WHEN a.k = 33 THEN 'judge unavailable (no verdict), failing open'
           WHEN a.k = 12 THEN 'judge: IRRELEVANT, answer replaced' END AS detail,
           CASE WHEN t.text IS NOT NULL AND a.k = 12 THEN {lit(fixed.IRRELEVANT_REPLACEMENT)} ELSE a.text END AS text
    FROM answers a LEFT JOIN turns t ON t.turn_id = a.turn_id - 1"""))
def _(spark, folder):
    a = answers(spark, folder)
    asked = turns(spark, folder).select((F.col("turn_id") + 1).alias("turn_id"), F.col("text").alias("question"))
    return replaced(ver.relevance_check(a.join(asked, "turn_id", "left"), verdicts(a)), "turn_id")


# ---------------------------------------------------------------------------------------------- moderation of documents

@query("moderation_labels", """
    SELECT d.doc_id, CASE WHEN l.toxic IS NULL OR l.toxic = 1 THEN 7 END AS blocked_by,
           CASE WHEN l.toxic IS NULL THEN 'moderation unavailable (no verdict), failing closed'
                WHEN l.toxic = 1 THEN 'flagged: toxic' END AS detail
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(spark, folder):
    docs, labels = read_table(spark, folder, "documents").select("doc_id"), read_table(spark, folder, "labels")
    judged = scorers.moderation_verdicts(labels.withColumn("score", F.col("toxic").cast("double")), "doc_id", "toxic")
    return one_detail(ver.moderation_screen(docs, judged, key="doc_id"), "doc_id")


# ---------------------------------------------------------------------------------------------- grounding, relevance

TOKENS_SQL = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))"
GROUND_SQL = with_turns(f"""
    SELECT a.turn_id, CASE WHEN bad IS NOT NULL THEN left('unsupported: ' || bad, 300) END AS detail,
           CASE WHEN bad IS NOT NULL THEN {lit(fixed.UNGROUNDED_REPLACEMENT)} ELSE text END AS text
    FROM answers a LEFT JOIN (SELECT turn_id, string_agg(left(claim, 120), ' | ' ORDER BY claim_no) AS bad
                              FROM judged WHERE NOT supported GROUP BY turn_id) b USING (turn_id)""",
    "context AS (SELECT turn_id + 1 AS turn_id, text AS result FROM turns)",
    "split AS (SELECT turn_id, list_transform(regexp_extract_all(text, '[^.!?\\n]+[.!?]*'), "
    "lambda c: regexp_replace(c, '^\\s+|\\s+$', '', 'g')) AS cs FROM answers WHERE text <> '')",
    "claims AS (SELECT turn_id, unnest(cs) AS claim, generate_subscripts(cs, 1) - 1 AS claim_no FROM split)",
    "words AS (SELECT turn_id, claim_no, unnest(" + TOKENS_SQL.format("claim") + ") AS word FROM claims)",
    "known AS (SELECT DISTINCT turn_id, unnest(" + TOKENS_SQL.format("result") + ") AS word FROM context)",
    "judged AS (SELECT c.turn_id, c.claim_no, any_value(c.claim) AS claim, "
    "count(k.word) >= 0.1 * count(*) AS supported FROM claims c JOIN words w USING (turn_id, claim_no) "
    "LEFT JOIN known k ON k.turn_id = w.turn_id AND k.word = w.word "
    "WHERE c.turn_id IN (SELECT turn_id FROM context WHERE result <> '') GROUP BY c.turn_id, c.claim_no)")


@query("grounding_check", GROUND_SQL)
def _(spark, folder):
    a = answers(spark, folder)
    context = turns(spark, folder).select((F.col("turn_id") + 1).alias("turn_id"), F.col("text").alias("result"))
    return replaced(gr.grounding_check(a, context, threshold=0.1), "turn_id")


@query("grounding_judged", with_turns(f"""
    SELECT a.turn_id, CASE WHEN t.text IS NULL THEN NULL WHEN a.k = 13 AND contains(lower(a.text), 'cures') THEN 'unsupported: one tablet cures every migraine for good.'
           WHEN a.k NOT IN (13, 14) THEN 'judge unavailable (no verdict), failing open' END AS detail,
           CASE WHEN t.text IS NOT NULL AND a.k = 13 AND contains(lower(a.text), 'cures') THEN {lit(fixed.UNGROUNDED_REPLACEMENT)} ELSE a.text END AS text
    FROM answers a LEFT JOIN turns t ON t.turn_id = a.turn_id - 1 AND t.text <> ''"""))
def _(spark, folder):
    a = answers(spark, folder)
    context = turns(spark, folder).select((F.col("turn_id") + 1).alias("turn_id"), F.col("text").alias("result"))
    judged = (gr.claims(a.filter("k in (13, 14)"), "turn_id")
              .withColumn("supported", ~F.col("claim").contains("cures")))
    return replaced(gr.grounding_check(a, context, judged), "turn_id")


LONG_SQL = TOKENS_SQL
OVERLAP_SQL = (f"coalesce(len(list_intersect({LONG_SQL.format('question')}, {LONG_SQL.format('answer')})) / "
               f"nullif(least(len({LONG_SQL.format('question')}), len({LONG_SQL.format('answer')})), 0), 0.0)")


@query("relevance_labels", f"SELECT conv_id, turn, round(o, 6) AS overlap, CASE WHEN o >= 0.02 THEN 'RELEVANT' ELSE 'IRRELEVANT' END AS label "
                           f"FROM (SELECT *, {OVERLAP_SQL} AS o FROM ({PAIRS_SQL}))")
def _(spark, folder):
    pairs = conversation_pairs(read_table(spark, folder, "conversations"))
    return gr.relevance_labels(pairs, 0.02).select("conv_id", "turn", F.round("overlap", 6).alias("overlap"), "label")


LEXICON = ["headache", "fever", "cold", "ibuprofen", "paracetamol", "sleep", "hydration", "health", "doctor", "dehydration",
           "painkillers", "flu", "dormir", "appointment"]


@query("topic_labels", with_turns(f"""
    SELECT turn_id, CASE WHEN len(list_intersect({TOKENS_SQL.format('text')}, [{', '.join(lit(w) for w in LEXICON)}])) > 0
           THEN 'ON_TOPIC' ELSE 'OFF_TOPIC' END AS label FROM turns"""))
def _(spark, folder):
    return gr.topic_labels(turns(spark, folder), LEXICON).select("turn_id", "label")


# ---------------------------------------------------------------------------------------------- replies of a judge

REPLIES = [
    (18, '{"attack": true, "type": "jailbreak", "confidence": 0.92}'),
    (18, '```json\n{"Attack": false, "Type": "none", "Confidence": 0.1}\n```'),
    (18, 'I think {"attack": true, "type": "injection"} fits.'),
    (18, 'broken {"attack": true, "type": '),
    (18, '"attack": true, I am sure'),
    (18, "{}"),
    (18, ""),
    (3, " off_topic\n"),
    (3, "On_Topic, a health question"),
    (16, "yes, there is a risk"),
    (16, None),
    (12, "Unsafe"),
]
REPLIES_SQL = (f"SELECT doc_id AS turn_id, r.rule, CAST(0 AS INTEGER) AS chunk_no, r.reply FROM documents "
               f"JOIN (VALUES {sql_values([(i, *r) for i, r in enumerate(REPLIES)])}) r(i, rule, reply) ON r.i = doc_id % {len(REPLIES)}")


def reply_rows(spark, folder, listed):
    """A reply of the list for every document, dealt in turn."""
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(listed)], "i int, rule int, reply string")
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").alias("turn_id"), (F.col("doc_id") % len(listed)).cast("int").alias("i"))
    return docs.join(table, "i").withColumn("chunk_no", F.lit(0)).drop("i")


@query("parse_judgements", f"""
    WITH said AS (SELECT turn_id, rule, chunk_no, upper(regexp_replace(reply, '^\\s+|\\s+$', '', 'g')) AS s FROM ({REPLIES_SQL})
                  WHERE regexp_replace(coalesce(reply, ''), '^\\s+|\\s+$', '', 'g') <> ''),
    parsed AS (SELECT *, TRY_CAST(nullif(lower(regexp_extract(s, '(?s)\\{{.*\\}}', 0)), '') AS JSON) AS j FROM said),
    kinds AS (SELECT *, rule = 18 AND coalesce(len(json_keys(j)) > 0, false) AS found FROM parsed)
    SELECT turn_id, rule, chunk_no,
           CASE WHEN found THEN json_extract_string(j, '$.type') WHEN rule = 18 THEN 'unknown' ELSE s END AS label,
           CASE WHEN found THEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) WHEN rule = 18 THEN 1.0 END AS confidence,
           CASE WHEN found THEN coalesce(CAST(json_extract_string(j, '$.attack') AS BOOLEAN), false)
                WHEN rule = 18 THEN contains(s, '"ATTACK": TRUE') END AS attack FROM kinds""")
def _(spark, folder):
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(REPLIES)], "i int, rule int, reply string")
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").alias("turn_id"), (F.col("doc_id") % len(REPLIES)).cast("int").alias("i"))
    replies = docs.join(table, "i").withColumn("chunk_no", F.lit(0)).drop("i")
    return ver.parse_judgements(replies).drop("categories")


MODERATED = ['{"categories": {"violence": true, "hate": false, "Self-Harm": true}}', 'Sure:\n```json\n{"violation": 1, "category": "S2"}\n```', '{"violation": 0, "category": null}',
             '{"violation": 1}', 'broken {"violation": 1, ', "nothing to see", "", None, '{"categories": {}}', '{"violation": 1, "category": "S4"} and more']


# By hand: the categories of each reply, in order of name, and which are flagged.
FLAGS = {0: [("Self-Harm", True), ("hate", False), ("violence", True)], 1: [("S2", True)], 2: [("unspecified", False)], 3: [("unspecified", True)],
         4: [("unspecified", True)], 5: [("unspecified", False)], 8: [], 9: [("S4", True)]}
FLAGS_SQL = "(VALUES " + ", ".join(f"({i}, {lit(n)}, {b})" for i, f in FLAGS.items() for n, b in f) + ") f(i, category, flagged)"


@query("parse_moderation", f"SELECT doc_id AS turn_id, category, flagged FROM documents JOIN {FLAGS_SQL} ON i = doc_id % {len(MODERATED)}")
def _(spark, folder):
    parsed = ver.parse_judgements(reply_rows(spark, folder, [(7, r) for r in MODERATED]))
    return parsed.select("turn_id", F.explode("categories").alias("category", "flagged"))


# Every turn is judged three times, by replies that follow one another in the list; what any of them flagged counts.
@query("moderation_merged", f"""
    WITH asked AS (SELECT doc_id, unnest([doc_id, doc_id + 1, doc_id + 2]) % {len(MODERATED)} AS i FROM documents),
    judged AS (SELECT doc_id, list_sort(list_distinct(list(category) FILTER (WHERE flagged))) AS names, count(*) AS n
               FROM asked LEFT JOIN {FLAGS_SQL} USING (i) WHERE i NOT IN (6, 7) GROUP BY doc_id)
    SELECT doc_id AS turn_id, CASE WHEN n IS NULL OR len(names) > 0 THEN 7 END AS blocked_by,
           CASE WHEN n IS NULL THEN 'unavailable' WHEN len(names) > 0 THEN array_to_string(names, ',') END AS flagged
    FROM documents LEFT JOIN judged USING (doc_id)""")
def _(spark, folder):
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").alias("turn_id"), "text")
    asked = docs.select("turn_id", F.explode(F.array(*[F.col("turn_id") + i for i in range(3)])).alias("place"))
    table = spark.createDataFrame(list(enumerate(MODERATED)), "i int, reply string")
    replies = asked.join(table, (F.col("place") % len(MODERATED)).cast("int") == F.col("i")).select("turn_id", F.lit(7).alias("rule"), F.lit(0).alias("chunk_no"), "reply")
    done = ver.moderation_screen(docs, ver.parse_judgements(replies))
    listed = F.split(F.regexp_extract(detail_of(), "flagged: (.*)", 1), ", ")
    return done.select("turn_id", "blocked_by", F.when(detail_of().contains("unavailable"), "unavailable").when(
        F.col("blocked_by").isNotNull(), F.array_join(F.array_sort(listed), ",")).alias("flagged"))


CLAIMED = ['{"claims": [{"claim": "Ibuprofen Cures Colds.", "supported": false}, {"claim": "Rest helps", "supported": true}, {"claim": "No flag"}]}',
           '```json\n{"claims": [{"claim": "a", "supported": 0}, {"claim": "b", "supported": 1}, {"claim": "c", "supported": null}, {"claim": "d", "supported": ""}]}\n```',
           '{"claims": []}', "{}", '{"claims": [{"claim": "x", "supported": false}', '{"claims": "none"}', '{"claims": [1, 2]}', "no object", "", None,
           'So: {"Claims": [{"Claim": "Upper", "Supported": "no"}, {"supported": false}]}']
CLAIM_ROWS = {0: [("ibuprofen cures colds.", False), ("rest helps", True), ("no flag", True)], 1: [("a", False), ("b", True), ("c", False), ("d", False)],
              2: [(None, True)], 3: [(None, True)], 10: [("upper", True), ("", False)]}
CLAIMS_SQL = "(VALUES " + ", ".join(f"({i}, {n}, {'NULL' if c is None else lit(c)}, {b})" for i, rows in CLAIM_ROWS.items() for n, (c, b) in enumerate(rows)) \
    + ") c(i, claim_no, claim, supported)"


@query("parse_grounding", f"SELECT doc_id AS turn_id, claim_no, claim, supported FROM documents JOIN {CLAIMS_SQL} ON i = doc_id % {len(CLAIMED)}")
def _(spark, folder):
    return ver.parse_grounding(reply_rows(spark, folder, [(14, r) for r in CLAIMED]))


# The grounding check fed by replies, over the answers.
@query("grounding_replies", with_turns(f"""
    SELECT a.turn_id, CASE WHEN t.text IS NULL THEN NULL WHEN n IS NULL THEN 'judge unavailable (no verdict), failing open'
           WHEN bad IS NOT NULL THEN 'unsupported: ' || bad END AS detail,
           CASE WHEN t.text IS NOT NULL AND bad IS NOT NULL THEN {lit(fixed.UNGROUNDED_REPLACEMENT)} ELSE a.text END AS text
    FROM answers a LEFT JOIN turns t ON t.turn_id = a.turn_id - 1 AND t.text <> ''
    LEFT JOIN (SELECT i, count(*) AS n, string_agg(claim, ' | ' ORDER BY claim_no) FILTER (WHERE NOT supported) AS bad FROM {CLAIMS_SQL} GROUP BY i) c
      ON c.i = a.turn_id % {len(CLAIMED)}"""))
def _(spark, folder):
    a = answers(spark, folder)
    context = turns(spark, folder).select((F.col("turn_id") + 1).alias("turn_id"), F.col("text").alias("result"))
    table = spark.createDataFrame(list(enumerate(CLAIMED)), "i int, reply string")
    said = a.select("turn_id", (F.col("turn_id") % len(CLAIMED)).cast("int").alias("i")).join(table, "i")
    return replaced(gr.grounding_check(a, context, ver.parse_grounding(said)), "turn_id")


# ---------------------------------------------------------------------------------------------- language

GRAMS_SQL = "list_transform(range(1, len({0}) - 1), lambda i: {0}[i] || {0}[i + 1] || {0}[i + 2])"
LETTERS_SQL = "regexp_extract_all(' ' || regexp_replace(lower({0}), '[^\\p{{L}}]+', ' ', 'g') || ' ', '(?s).')"


def language_ctes(source: str, key: str) -> list[str]:
    """``best(key, language, p)`` over ``source(key, text)`` with a model fitted on the documents."""
    return [
        f"docgrams AS (SELECT lang, unnest({GRAMS_SQL.format('l')}) AS gram FROM (SELECT lang, {LETTERS_SQL.format('text')} AS l FROM documents))",
        "gramcounts AS (SELECT lang, gram, count(*) AS n FROM docgrams GROUP BY lang, gram)",
        "totals AS (SELECT lang, sum(n) AS total FROM gramcounts GROUP BY lang)",
        f"""model AS (SELECT g.gram, t.lang, CAST(round(ln((coalesce(p.n, 0) + 0.5) /
                (t.total + 0.5 * (SELECT count(DISTINCT gram) FROM gramcounts))) * {lang.SCALE}) AS BIGINT) AS w
            FROM (SELECT DISTINCT gram FROM gramcounts) g CROSS JOIN totals t LEFT JOIN gramcounts p ON p.lang = t.lang AND p.gram = g.gram)""",
        f"asked AS (SELECT {key}, unnest({GRAMS_SQL.format('l')}) AS gram FROM (SELECT {key}, {LETTERS_SQL.format('text')} AS l FROM {source}))",
        f"sums AS (SELECT {key}, lang, sum(w) AS s FROM asked JOIN model USING (gram) GROUP BY {key}, lang)",
        f"""best AS (SELECT {key}, min(lang) FILTER (WHERE s = top) AS language, 1.0 / sum(exp((s - top) / {lang.SCALE}.0)) AS p
            FROM (SELECT *, max(s) OVER (PARTITION BY {key}) AS top FROM sums) GROUP BY {key})""",
    ]


_MODELS: dict = {}


def language_model(spark, folder):
    """The model of the documents; it is fitted and written once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MODELS:
        _MODELS[key] = lang.fit(read_table(spark, folder, "documents"))
    return _MODELS[key]


@query("language_scores", "WITH " + ", ".join(language_ctes("documents", "doc_id")) +
       " SELECT doc_id, language, round(p, 4) AS probability FROM best")
def _(spark, folder):
    docs = read_table(spark, folder, "documents")
    model = lang.fit(docs)
    return lang.score(docs, model, "doc_id", F.col("text")).withColumn("probability", F.round("probability", 4))


FOLD_SQL = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 2"


def held_out_ctes() -> list[str]:
    """``best(doc_id, language)``: every document scored by the model of the other half."""
    return [
        f"halves AS (SELECT doc_id, lang, {FOLD_SQL} AS fold, {LETTERS_SQL.format('text')} AS l FROM documents)",
        f"docgrams AS (SELECT doc_id, fold, lang, unnest({GRAMS_SQL.format('l')}) AS gram FROM halves)",
        "gramcounts AS (SELECT 1 - fold AS fold, lang, gram, count(*) AS n FROM docgrams GROUP BY ALL)",
        "totals AS (SELECT fold, lang, sum(n) AS total FROM gramcounts GROUP BY ALL)",
        "different AS (SELECT fold, count(DISTINCT gram) AS d FROM gramcounts GROUP BY fold)",
        f"""model AS (SELECT g.fold, g.gram, t.lang, CAST(round(ln((coalesce(p.n, 0) + 0.5) / (t.total + 0.5 * d)) * {lang.SCALE}) AS BIGINT) AS w
            FROM (SELECT DISTINCT fold, gram FROM gramcounts) g JOIN totals t USING (fold) JOIN different USING (fold)
            LEFT JOIN gramcounts p ON p.fold = g.fold AND p.lang = t.lang AND p.gram = g.gram)""",
        "sums AS (SELECT doc_id, model.lang, sum(w) AS s FROM docgrams JOIN model USING (fold, gram) GROUP BY ALL)",
        "best AS (SELECT doc_id, min(lang) FILTER (WHERE s = top) AS language FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM sums) GROUP BY doc_id)"]


# Every document is scored by a model that was fitted to the other half of the documents.
@query("language_accuracy", "WITH " + ", ".join(held_out_ctes()) +
       " SELECT d.lang, count(*) AS scored, count(*) FILTER (WHERE d.lang = language) AS correct FROM best "
       "JOIN documents d USING (doc_id) GROUP BY d.lang")
def _(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "lang", "text")
    scored = ev.held_out(docs, "doc_id", 2, lang.fit, lambda df, model: lang.score(df, model, "doc_id", F.col("text")))
    return (scored.join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang")
            .agg(F.count("*").alias("scored"), F.count_if(F.col("lang") == F.col("language")).alias("correct")))


@query("language_screen", with_turns("""
    SELECT turn_id, CASE WHEN length(text) >= 40 AND language <> 'en' AND p >= 0.9 THEN 21 END AS blocked_by,
           CASE WHEN length(text) >= 40 AND language <> 'en' AND p >= 0.9 THEN language END AS language
    FROM turns LEFT JOIN best USING (turn_id)""", *language_ctes("turns", "turn_id")))
def _(spark, folder):
    t = turns(spark, folder)
    model = language_model(spark, folder)
    done = lang.language_screen(t, lang.score(t, model, "turn_id", F.col("text")))
    return done.select("turn_id", "blocked_by", F.nullif(F.regexp_extract(detail_of(), "detected '(.*)' ", 1), F.lit(""))
                       .alias("language"))


# ---------------------------------------------------------------------------------------------- evaluation

PROFANE_N = f"len(regexp_extract_all(text, {lit('(?i:' + PROFANITY_SQL + ')')}))"
RATES = ("round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall")


def eval_sql(predicted: str, label: str) -> str:
    return (f"SELECT *, {RATES} FROM (SELECT count(*) FILTER (WHERE p AND y) AS tp, count(*) FILTER (WHERE p AND NOT y) AS fp, "
            f"count(*) FILTER (WHERE NOT p AND y) AS fn, count(*) FILTER (WHERE NOT p AND NOT y) AS tn FROM "
            f"(SELECT {predicted} AS p, {label} = 1 AS y FROM documents JOIN labels USING (doc_id)))")


@query("toxicity_eval", eval_sql(f"{PROFANE_N} > 0", "toxic"))
def _(spark, folder):
    masked = out.profanity_mask(read_table(spark, folder, "documents").select("doc_id", "text"), counts=True)
    return ev.labelled_eval(masked.withColumn("hit", F.col("masked_words") > 0), read_table(spark, folder, "labels"), "hit", "toxic")


THRESHOLDS = [1, 2, 3, 5, 8]


@query("toxicity_threshold_sweep", " UNION ALL ".join(
    f"SELECT CAST({t} AS DOUBLE) AS threshold, * FROM ({eval_sql(f'{PROFANE_N} >= {t}', 'toxic')})" for t in THRESHOLDS))
def _(spark, folder):
    masked = out.profanity_mask(read_table(spark, folder, "documents").select("doc_id", "text"), counts=True)
    return ev.threshold_sweep(masked, read_table(spark, folder, "labels"), "masked_words", "toxic", THRESHOLDS)


CURVE_SQL = f"""binned AS (SELECT CAST({PROFANE_N} AS DOUBLE) AS threshold, toxic = 1 AS y FROM documents JOIN labels USING (doc_id) WHERE toxic IS NOT NULL),
    counts AS (SELECT threshold, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n FROM binned GROUP BY threshold),
    sums AS (SELECT threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp, CAST(sum(p) OVER () - sum(p) OVER w AS BIGINT) AS fn,
             CAST(sum(n) OVER () - sum(n) OVER w AS BIGINT) AS tn FROM counts WINDOW w AS (ORDER BY threshold DESC)),
    curve AS (SELECT *, {RATES}, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM sums)"""


def _masked_words(spark, folder):
    return out.profanity_mask(read_table(spark, folder, "documents").select("doc_id", "text"), counts=True)


@query("toxicity_curve", f"WITH {CURVE_SQL} SELECT * FROM curve")
def _(spark, folder):
    return ev.precision_recall(_masked_words(spark, folder), read_table(spark, folder, "labels"), "masked_words", "toxic", 1)


@query("toxicity_best_threshold", f"WITH {CURVE_SQL} SELECT * FROM curve ORDER BY f1 DESC NULLS LAST, threshold DESC LIMIT 1")
def _(spark, folder):
    return ev.best_threshold(ev.precision_recall(_masked_words(spark, folder), read_table(spark, folder, "labels"), "masked_words", "toxic", 1))


def held_out_scores(spark, folder, label: str):
    """Every labelled document scored by a model that was trained on the others folds' labelled documents."""
    labelled = read_table(spark, folder, "documents").select("doc_id", "text").join(
        read_table(spark, folder, "labels").select("doc_id", label).filter(F.col(label).isNotNull()), "doc_id")
    return ev.held_out(labelled, "doc_id", 3, lambda df: scorers.train(df, label), lambda df, model: scorers.score(df, model).select("doc_id", "score"))


@query("toxicity_model_scores")
def _(spark, folder):
    return held_out_scores(spark, folder, "toxic").select("doc_id", F.round("score", 3).alias("score"))


@query("quality_model_eval")
def _(spark, folder):
    return ev.precision_recall(held_out_scores(spark, folder, "quality"), read_table(spark, folder, "labels"), "score", "quality", 20)


# ---------------------------------------------------------------------------------------------- TF-IDF

def tfidf_sql(corpus: str, pairs: str, keys: str, low: float, labels: tuple[str, str]) -> str:
    words = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
    scaled = f"CAST(round((ln((1.0 + (SELECT count(*) FROM {corpus})) / (1.0 + {{0}})) + 1.0) * {tf.SCALE}) AS BIGINT)"
    return f"""idf AS (SELECT word, {scaled.format('count(*)')} AS idf FROM (SELECT unnest(list_distinct({words.format('text')})) AS word FROM {corpus}) GROUP BY word),
    sides AS (SELECT {keys}, unnest({words.format('l')}) AS word, 1 AS l, 0 AS r FROM {pairs} UNION ALL SELECT {keys}, unnest({words.format('r')}), 0, 1 FROM {pairs}),
    counted AS (SELECT {keys}, word, sum(l) AS l, sum(r) AS r FROM sides GROUP BY ALL),
    weighed AS (SELECT c.*, CAST(coalesce(idf, {scaled.format('0')}) AS HUGEINT) AS w FROM counted c LEFT JOIN idf USING (word)),
    sums AS (SELECT {keys}, CAST(sum(l * r * w * w) AS DOUBLE) AS dot, CAST(sum(l * l * w * w) AS DOUBLE) AS ll, CAST(sum(r * r * w * w) AS DOUBLE) AS rr FROM weighed GROUP BY ALL),
    cosines AS (SELECT {keys}, round(coalesce(CASE WHEN ll > 0 AND rr > 0 THEN dot / sqrt(ll) / sqrt(rr) END, 0), 6) AS cosine FROM {pairs} LEFT JOIN sums USING ({keys}))
    SELECT *, CASE WHEN cosine >= {low} THEN '{labels[0]}' ELSE '{labels[1]}' END AS label FROM cosines"""


# Answers against their questions; words are weighed over all turns of the conversations.
@query("relevance_tfidf", f"WITH corpus AS (SELECT text FROM conversations), pairs AS (SELECT conv_id, turn, question AS l, answer AS r FROM ({PAIRS_SQL})), "
       + tfidf_sql("corpus", "pairs", "conv_id, turn", tf.RELEVANT, ("RELEVANT", "IRRELEVANT")))
def _(spark, folder):
    table = read_table(spark, folder, "conversations")
    return tf.relevance_tfidf(conversation_pairs(table), ["conv_id", "turn"], tf.fit_idf(table))


TOPIC = "headache fever cold ibuprofen paracetamol sleep hydration health doctor dehydration painkillers flu appointment medicine nurse"


@query("topical_tfidf", with_turns(tfidf_sql("corpus", "pairs", "turn_id", tf.ON_TOPIC, ("ON_TOPIC", "OFF_TOPIC")).split("SELECT *,", 1)[1].join(["SELECT *,", ""]),
       "corpus AS (SELECT text FROM documents)", f"pairs AS (SELECT turn_id, text AS l, {lit(TOPIC)} AS r FROM turns)",
       tfidf_sql("corpus", "pairs", "turn_id", tf.ON_TOPIC, ("ON_TOPIC", "OFF_TOPIC")).split("\n    SELECT *,", 1)[0]))
def _(spark, folder):
    return tf.topical_tfidf(turns(spark, folder), ["turn_id"], TOPIC, tf.fit_idf(read_table(spark, folder, "documents")))


# The check at its default threshold, over what a knowledge-base search found for the question.
@query("grounding_tools", GROUND_SQL.replace("0.1 * count(*)", "0.6 * count(*)").replace(
    "context AS (SELECT turn_id + 1 AS turn_id, text AS result FROM turns)",
    "context AS (SELECT turn_id + 1 AS turn_id, kb_result AS result FROM (" + kb_sql("turns", "turn_id", fixed.KNOWLEDGE_BASE) + "))"))
def _(spark, folder):
    found = look.kb_match(turns(spark, folder), dim.knowledge_base(spark))
    context = found.select((F.col("turn_id") + 1).alias("turn_id"), F.col("kb_result").alias("result"))
    return replaced(gr.grounding_check(answers(spark, folder), context), "turn_id")
