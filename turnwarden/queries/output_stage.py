"""Output rules, one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators import output_rules as out
from turnwarden.queries.common import (TRUST_SQL, URL_SQL, answers, detail_of, lit, query, sql_any, sql_joined,
                                       sql_lines, sql_rewrite, with_turns)
from turnwarden.queries.input_stage import HEX_TOKEN
from turnwarden.sources.turns import read_table


def rewritten(df, *keys):
    return df.select(*keys, detail_of().alias("detail"), "text")


def replace_chain_sql(source: str, key: str, steps: list[tuple[str, str, str]], prefix: str, with_number: bool,
                      flags: str = "") -> str:
    """Count and replace pattern after pattern, one sub-query per pattern."""
    inner = f"SELECT {key}, text FROM {source}"
    option = f", {lit(flags)}" if flags else ""
    wrap = (lambda p: f"(?{flags}:{p})") if flags else (lambda p: p)
    for i, (_, p, r) in enumerate(steps):
        counts = "".join(f", n{j}" for j in range(i))
        inner = (f"SELECT {key}{counts}, len(regexp_extract_all(text, {lit(wrap(p))})) AS n{i}, "
                 f"regexp_replace(text, {lit(wrap(p))}, {lit(r)}, 'g') AS text FROM ({inner})")
    labels = [f"CASE WHEN n{i} > 0 THEN " + (f"n{i} || ' {n}'" if with_number else lit(n)) + " END"
              for i, (n, _, _) in enumerate(steps)]
    listed = sql_joined(labels)
    return f"SELECT {key}, CASE WHEN {listed} <> '' THEN '{prefix}: ' || {listed} END AS detail, text FROM ({inner})"


PII_STEPS = [(n, p, f"[REDACTED_{n}]") for n, p in fixed.OUTPUT_PII_PATTERNS]


@query("pii_redact", replace_chain_sql("documents", "doc_id", PII_STEPS, "redacted", True))
def _(spark, folder):
    return rewritten(out.pii_redact(read_table(spark, folder, "documents")), "doc_id")


@query("pii_redact_answers", with_turns(replace_chain_sql("answers", "turn_id", PII_STEPS, "redacted", True)))
def _(spark, folder):
    return rewritten(out.pii_redact(answers(spark, folder)), "turn_id")


def _counts_sql() -> str:
    chain = "text"
    cols = []
    for n, p, r in PII_STEPS:
        cols.append(f"CAST(sum(len(regexp_extract_all({chain}, {lit(p)}))) AS BIGINT) AS n_{n.lower()}")
        chain = f"regexp_replace({chain}, {lit(p)}, {lit(r)}, 'g')"
    return f"SELECT lang, {', '.join(cols)} FROM documents GROUP BY lang"


@query("pii_counts_by_lang", _counts_sql())
def _(spark, folder):
    done = out.pii_redact(read_table(spark, folder, "documents").select("lang", "text"), counts=True)
    return done.groupBy("lang").agg(*[F.sum(f"n_{n.lower()}").alias(f"n_{n.lower()}") for n, _, _ in PII_STEPS])


SECRETS = [*fixed.SECRET_PATTERNS, ("Hex token", HEX_TOKEN[1])]


def _secret_steps(patterns):
    return [(n, p, f"[REDACTED_{n.upper().replace(' ', '_')}]") for n, p in patterns]


@query("secrets_redact", with_turns(replace_chain_sql("answers", "turn_id", _secret_steps(fixed.SECRET_PATTERNS),
                                                      "redacted", False)))
def _(spark, folder):
    return rewritten(out.secrets_redact(answers(spark, folder)), "turn_id")


@query("secrets_redact_documents", replace_chain_sql("documents", "doc_id", _secret_steps(SECRETS), "redacted", False))
def _(spark, folder):
    return rewritten(out.secrets_redact(read_table(spark, folder, "documents"), SECRETS), "doc_id")


def url_redact_sql(source: str, key: str) -> str:
    keep = f"CASE WHEN regexp_matches(m, {lit(TRUST_SQL)}, 'i') THEN m ELSE '[link removed]' END"
    # list_distinct has no order of its own; keep each link's first position.
    bad = (f"list_filter(regexp_extract_all(text, {lit('(?i:' + URL_SQL + ')')}), "
           f"lambda u: NOT regexp_matches(u, {lit(TRUST_SQL)}, 'i'))")
    once = "list_filter(bad, lambda u, i: list_position(bad, u) = i)"
    return (f"SELECT {key}, CASE WHEN len(bad) > 0 THEN left('removed: ' || array_to_string({once}, ', '), 300) END AS detail, "
            f"CASE WHEN len(bad) > 0 THEN {sql_rewrite('text', URL_SQL, keep, 'i')} ELSE text END AS text "
            f"FROM (SELECT {key}, text, {bad} AS bad FROM {source})")


@query("url_redact", with_turns(url_redact_sql("answers", "turn_id")))
def _(spark, folder):
    return rewritten(out.url_redact(answers(spark, folder)), "turn_id")


@query("url_redact_pages", url_redact_sql("(SELECT page_id, url || chr(10) || html AS text FROM pages)", "page_id"))
def _(spark, folder):
    pages = read_table(spark, folder, "pages").select("page_id", F.concat_ws("\n", "url", "html").alias("text"))
    return rewritten(out.url_redact(pages), "page_id")


def code_sql(source: str, key: str) -> str:
    risky = sql_any("ln", fixed.DANGEROUS_CODE_PATTERNS, "i")
    return f"""
    SELECT {key}, CASE WHEN n > 0 THEN 'removed ' || n || ' line(s)' END AS detail,
           CASE WHEN n > 0 THEN array_to_string(list_transform(ls, lambda ln: CASE WHEN {risky}
                THEN {lit(fixed.COMMAND_MASK)} ELSE ln END), chr(10)) || {lit(fixed.COMMAND_WARNING)} ELSE text END AS text
    FROM (SELECT {key}, text, ls, len(list_filter(ls, lambda ln: {risky})) AS n
          FROM (SELECT {key}, text, {sql_lines('text')} AS ls FROM {source}))"""


@query("dangerous_code_filter", with_turns(code_sql("answers", "turn_id")))
def _(spark, folder):
    return rewritten(out.dangerous_code_filter(answers(spark, folder)), "turn_id")


PLANTED_CODE = "text || CASE WHEN doc_id % 7 = 3 THEN chr(10) || 'sudo rm -rf / ' || chr(10) || 'done' ELSE '' END"


@query("dangerous_code_filter_documents",
       code_sql(f"(SELECT doc_id, {PLANTED_CODE} AS text FROM documents)", "doc_id"))
def _(spark, folder):
    planted = F.when(F.col("doc_id") % 7 == 3, F.lit("\nsudo rm -rf / \ndone")).otherwise(F.lit(""))
    docs = read_table(spark, folder, "documents").select("doc_id", F.concat("text", planted).alias("text"))
    return rewritten(out.dangerous_code_filter(docs), "doc_id")


PROFANITY_SQL = r"\b(?:" + "|".join(fixed.PROFANITY_STEMS) + r")[\p{L}\p{N}_]*"


def profanity_sql(source: str, key: str) -> str:
    n = f"len(regexp_extract_all(text, {lit('(?i:' + PROFANITY_SQL + ')')}))"
    masked = sql_rewrite("text", PROFANITY_SQL, "left(m, 1) || repeat('*', length(m) - 1)", "i")
    return (f"SELECT {key}, CASE WHEN {n} > 0 THEN 'masked ' || {n} || ' word(s)' END AS detail, {masked} AS text "
            f"FROM {source}")


@query("profanity_mask", profanity_sql("documents", "doc_id"))
def _(spark, folder):
    return rewritten(out.profanity_mask(read_table(spark, folder, "documents")), "doc_id")


@query("profanity_mask_answers", with_turns(profanity_sql("answers", "turn_id")))
def _(spark, folder):
    return rewritten(out.profanity_mask(answers(spark, folder)), "turn_id")


def marker_sql(source: str, key: str, markers: list[str]) -> str:
    n = " + ".join(f"contains(text, {lit(m)})::INT" for m in markers)
    cleaned = "text"
    for m in markers:
        cleaned = f"replace({cleaned}, {lit(m)}, '[REDACTED]')"
    return (f"SELECT {key}, CASE WHEN {n} > 0 THEN 'redacted ' || ({n}) || ' internal marker(s)' END AS detail, "
            f"{cleaned} AS text FROM {source}")


@query("marker_leak_redact", with_turns(marker_sql("answers", "turn_id", fixed.LEAK_MARKERS)))
def _(spark, folder):
    return rewritten(out.marker_leak_redact(answers(spark, folder)), "turn_id")


MARKERS = ["token", "License", "worthless"]


@query("marker_leak_redact_documents", marker_sql("documents", "doc_id", MARKERS))
def _(spark, folder):
    return rewritten(out.marker_leak_redact(read_table(spark, folder, "documents"), MARKERS), "doc_id")


BRAND_STEPS = [(t, rf"\b{t}\b", fixed.BRAND_MASK) for t in fixed.COMPETITORS]


@query("brand_scrub", with_turns(replace_chain_sql("answers", "turn_id", BRAND_STEPS, "scrubbed", False, "i")))
def _(spark, folder):
    return rewritten(out.brand_scrub(answers(spark, folder)), "turn_id")


BRANDS = ["worthless", "clown", "the"]


@query("brand_scrub_documents", replace_chain_sql(
    "documents", "doc_id",
    [(t, rf"\b{t}\b", fixed.BRAND_MASK_SHORT) for t in BRANDS], "scrubbed", False, "i"))
def _(spark, folder):
    return rewritten(out.brand_scrub(read_table(spark, folder, "documents"), BRANDS, fixed.BRAND_MASK_SHORT), "doc_id")


@query("append_disclaimer", with_turns(
    f"SELECT turn_id, CASE WHEN text <> '' AND NOT contains(lower(text), 'not medical advice') "
    f"THEN text || {lit(fixed.DISCLAIMER)} ELSE text END AS text FROM answers"))
def _(spark, folder):
    return out.append_disclaimer(answers(spark, folder)).select("turn_id", "text")


@query("append_disclaimer_plain", with_turns(
    f"SELECT turn_id, CASE WHEN text <> '' AND NOT contains(lower(text), 'medical advice') "
    f"THEN text || {lit(fixed.DISCLAIMER_PLAIN)} ELSE text END AS text FROM answers"))
def _(spark, folder):
    return out.append_disclaimer(answers(spark, folder), fixed.DISCLAIMER_NEEDLE_SHORT, fixed.DISCLAIMER_PLAIN) \
        .select("turn_id", "text")


@query("token_budget", "SELECT doc_id, n AS tokens, n > 1500 AS over_budget FROM "
                       "(SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS n FROM documents)")
def _(spark, folder):
    return out.token_budget(read_table(spark, folder, "documents")).select("doc_id", "tokens", "over_budget")


@query("token_budget_by_source", "SELECT source, count(*) AS answers, count(*) FILTER (WHERE n > 1500) AS over_budget, "
                                 "quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.95) AS p95 FROM "
                                 "(SELECT source, len(regexp_extract_all(text, '\\S+')) AS n FROM documents) GROUP BY source")
def _(spark, folder):
    measured = out.token_budget(read_table(spark, folder, "documents").select("source", "text")).drop("text")
    p = F.percentile_approx("tokens", [0.5, 0.95], 10_000)
    return (measured.groupBy("source").agg(F.count("*").alias("answers"), F.count_if("over_budget").alias("over_budget"),
                                           p.alias("_p"))
            .select("source", "answers", "over_budget", F.col("_p")[0].alias("p50"), F.col("_p")[1].alias("p95")))
