"""Rules whose judgement comes from elsewhere: a human, a hosted model, a trained scorer. The judgement is a table.

``verdicts(turn_id, rule, chunk_no, label, confidence, attack, categories)`` has a row where a judge answered. A turn
without a row for a rule means the check was unavailable: the rule then fails open (``skipped``) or closed.

All rules of a stage read one row per turn, so the verdict table is grouped and joined once however many rules use it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.text import chunk_count, chunks, trim_space
from turnwarden.operators.decisions import Step, record, record_all, rewrite, start

VERDICT_SCHEMA = ("turn_id long, rule int, chunk_no int, label string, confidence double, attack boolean, "
                  "categories map<string,boolean>")
NO_ANSWER = "no verdict"
ONE_LABEL_RULES = {3: "topic", 7: "moderation", 12: "policy", 16: "crisis", 2: "injection", 30: "relevance"}


#: What a label must hold for its rule to act.
BLOCKING = {2: "YES", 3: "OFF_TOPIC", 12: "UNSAFE", 16: "YES", 30: "IRRELEVANT"}


def _acts(rule: Column, label: Column) -> Column:
    """Whether the label makes its rule act; rule 16 asks for it at the beginning."""
    return F.coalesce(*[F.when(rule == r, label.startswith(x) if r == 16 else label.contains(x)) for r, x in BLOCKING.items()], F.lit(False))


def _united(lists: Column) -> Column:
    """The distinct names of gathered lists; one list alone keeps its order."""
    return F.array_distinct(F.flatten(F.array_sort(F.collect_set(lists))))


def verdicts_per_turn(verdicts: DataFrame, key: str = "turn_id", *more: str, merged: bool = False) -> DataFrame:
    """One row per turn (``key`` and ``more``): ``_label_<rule>``, ``_flagged`` (moderation categories) and ``_scores`` (chunk -> score).

    A judge may answer again. Then the severe answer counts: a label on which its rule acts before one on which it does not,
    all categories that any answer flagged, and of a chunk's scores the attack with the highest confidence.

    A turn has one row per rule and, for scores, one per chunk of its own text, so the gathered map is bounded by the
    length of one text; repeated answers become one before anything is gathered (``merged`` says that they have).
    """
    rows = verdicts if merged else merge_answers(verdicts, key, *more)
    one = {f"_label_{r}": F.max(F.when((F.col("rule") == r) & F.col("label").isNotNull(), F.struct("severe", "label")))["label"] for r in ONE_LABEL_RULES}
    flagged = F.array_join(_united(F.when(F.col("rule") == 7, F.col("names"))), ", ")
    entry = F.when((F.col("rule") == 18) & F.col("chunk_no").isNotNull() & F.col("score").isNotNull(), F.struct("chunk_no", "score"))
    each = F.array_sort(F.collect_set(entry))  # of a chunk the last one counts
    moderated = F.max(F.when((F.col("rule") == 7) & F.col("names").isNotNull(), F.lit(True)))
    df = rows.groupBy(key, *more).agg(*[c.alias(n) for n, c in one.items()], flagged.alias("_flagged"), each.alias("_each"), moderated.alias("_moderated"))
    last = F.filter("_each", lambda e, i: ~F.coalesce(F.get("_each", i + 1)["chunk_no"] == e["chunk_no"], F.lit(False)))
    value = lambda e: F.struct(e["score"]["attack"].alias("attack"), e["score"]["confidence"].alias("confidence"), e["score"]["label"].alias("label"))
    scores = F.map_from_entries(F.transform(last, lambda e: F.struct(e["chunk_no"].alias("key"), value(e).alias("value"))))
    # Moderation without categories is no answer.
    return df.select(key, *more, *one, F.when(F.col("_moderated"), F.col("_flagged")).alias("_flagged"), scores.alias("_scores"), "_moderated")


def answer_rows(verdicts: DataFrame) -> DataFrame:
    """Verdicts with what is compared between answers: ``severe``, ``names`` (flagged categories) and ``score``."""
    score = F.struct(F.coalesce("attack", F.lit(False)).alias("attack"), F.coalesce("confidence", F.lit(1.0)).alias("c"), "confidence", "label")
    return verdicts.withColumns({"severe": _acts(F.col("rule"), F.col("label")), "names": F.map_keys(F.map_filter("categories", lambda _, v: v)),
                                 "score": F.when(F.col("rule") == 18, score)})


def merge_answers(verdicts: DataFrame, key: str, *more: str) -> DataFrame:
    """One row per turn, rule and chunk of all answers to it."""
    worst = F.max(F.when(F.col("label").isNotNull(), F.struct("severe", "label")))
    answers = answer_rows(verdicts).groupBy(key, *more, "rule", "chunk_no").agg(
        worst.alias("_worst"), F.count("names").alias("_lists"), _united(F.col("names")).alias("names"), F.max("score").alias("score"))
    return answers.select(key, *more, "rule", "chunk_no", F.col("_worst.severe").alias("severe"), F.col("_worst.label").alias("label"),
                          F.when(F.col("_lists") > 0, F.col("names")).alias("names"), "score")


OBJECT = r"(?s)\{.*\}"


def _object(reply: Column) -> Column:
    """The JSON object from the first brace to the last, NULL if there is none."""
    return F.try_parse_json(F.nullif(F.regexp_extract(reply, OBJECT, 0), F.lit("")))


def _kind(value: Column) -> Column:
    """The kind of a value, NULL where there is none; a JSON null is VOID."""
    return F.schema_of_variant(value)


def flagged_categories(reply: Column, found: Column) -> Column:
    """The categories of a moderation reply and whether each is flagged. ``found`` is its JSON object.

    ``{"categories": {name: true, ...}}`` is a map as it stands; ``{"violation": 0 or 1, "category": name}`` is a map of one, named
    ``unspecified`` without a name. A reply without a readable object is flagged only if it says so in words.
    """
    listed = F.try_variant_get(found, "$.categories", "map<string,boolean>")
    named = F.coalesce(F.try_variant_get(found, "$.category", "string"), F.lit("unspecified"))
    single = F.create_map(named, F.coalesce(F.try_variant_get(found, "$.violation", "int"), F.lit(0)) == 1)
    said = F.create_map(F.lit("unspecified"), reply.rlike(r'(?i)"violation"\s*:\s*(1|true)'))
    return F.coalesce(listed, F.when(found.isNotNull(), single), said)


def parse_judgements(replies: DataFrame, key: str = "turn_id", *more: str) -> DataFrame:
    """Verdict rows from what a judge replied (``turn_id, rule, chunk_no, reply``; ``more`` columns are kept). An empty reply gives no
    row: the check was unavailable.

    Rules with one label take the upper-cased reply. Scores of rule 18 are the JSON object from the first brace to the last,
    whatever the letter case; a reply without one, or with an empty one, counts as an attack only if it says so in words. Of
    rule 7 the categories are read, see ``flagged_categories``.
    """
    said = F.upper(trim_space(F.col("reply")))
    rows = replies.filter(said != "").select(key, *more, "rule", "chunk_no", said.alias("_said"), _object(F.col("reply")).alias("_object"), "reply")
    rows = rows.withColumn("_json", _object(F.lower("_said")))
    score, moderation = F.col("rule") == 18, F.col("rule") == 7
    found = score & F.coalesce(F.schema_of_variant("_json") != "OBJECT<>", F.lit(False))

    def value(name: str, kind: str) -> Column:
        return F.try_variant_get("_json", f"$.{name}", kind)

    return rows.select(
        key, *more, "rule", "chunk_no",
        F.when(found, value("type", "string")).when(score, F.lit("unknown")).when(~moderation, F.col("_said")).alias("label"),
        F.when(found, value("confidence", "double")).when(score, F.lit(1.0)).alias("confidence"),
        F.when(found, F.coalesce(value("attack", "boolean"), F.lit(False))).when(
            score, F.contains(F.col("_said"), F.lit('"ATTACK": TRUE'))).alias("attack"),
        F.when(moderation, flagged_categories(F.col("reply"), F.col("_object"))).alias("categories"))


def parse_grounding(replies: DataFrame, key: str = "turn_id") -> DataFrame:
    """What a judge found of an answer's claims (``turn_id, reply``) as rows for the grounding check: key, claim_no, claim, supported.

    The claims are the list ``claims`` of the lower-cased object; a claim without ``supported`` counts as supported, one with
    false, 0, an empty text or null as not. An object without claims is a finding too: one row without a claim. A reply without a
    readable object, or with claims that are no list of objects, gives no row: the check was unavailable.
    """
    found = replies.select(key, _object(F.lower("reply")).alias("_json")).filter("_json is not null")
    none = F.array().cast("array<variant>")
    listed = F.try_variant_get("_json", "$.claims", "variant")
    rows = found.withColumn("_kind", _kind(listed)).withColumn("_claims", F.when(F.col("_kind").isNull(), none).when(
        F.col("_kind").startswith("ARRAY"), F.try_variant_get("_json", "$.claims", "array<variant>")))
    rows = rows.filter(F.col("_claims").isNotNull() & F.forall("_claims", lambda c: F.coalesce(_kind(c).startswith("OBJECT"), F.lit(False))))
    each = rows.select(key, F.posexplode_outer("_claims").alias("claim_no", "_c")).withColumn("_s", F.try_variant_get("_c", "$.supported", "variant"))
    kind = _kind(F.col("_s"))
    held = (F.when(kind.isNull(), True).when(kind == "VOID", False).when(kind == "BOOLEAN", F.try_variant_get("_s", "$", "boolean"))
            .when(kind == "STRING", F.try_variant_get("_s", "$", "string") != "")
            .otherwise(F.coalesce(F.try_variant_get("_s", "$", "double") != 0, F.lit(True))))
    return each.select(key, F.coalesce("claim_no", F.lit(0)).alias("claim_no"), F.when(F.col("_c").isNotNull(), F.coalesce(
        F.try_variant_get("_c", "$.claim", "string"), F.lit(""))).alias("claim"), held.alias("supported"))


VERDICT_COLUMNS = [f"_label_{r}" for r in ONE_LABEL_RULES] + ["_flagged", "_scores", "_moderated"]


def join_verdicts(df: DataFrame, verdicts: DataFrame | None, key: str = "turn_id") -> DataFrame:
    """Attach the verdict columns; without a table every check is unavailable."""
    if "_moderated" in df.columns:
        return df
    if verdicts is None:
        empty = df.sparkSession.createDataFrame([], VERDICT_SCHEMA)
        types = {f.name: f.dataType for f in verdicts_per_turn(empty, "turn_id").schema.fields}
        return df.withColumns({c: F.lit(None).cast(types[c]) for c in VERDICT_COLUMNS})
    return df.join(verdicts_per_turn(verdicts, key), key, "left")


def drop_verdicts(df: DataFrame) -> DataFrame:
    return df.drop(*VERDICT_COLUMNS)


def unavailable(cause: str = NO_ANSWER, closed: bool = False) -> str:
    return f"check unavailable ({cause}), failing {'closed' if closed else 'open'}"


def fail_policy(number: int, name: str, answer: Column, closed: bool = False) -> Step:
    """What a model-backed input check does without an answer: block the text or note that it was skipped."""
    return Step(number, name, "blocked" if closed else "skipped",
                F.when(answer.isNull(), F.lit(unavailable(closed=closed))))


# ---------------------------------------------------------------------------------------------- input rules

def topical_steps(fail_closed: bool = False) -> list[Step]:
    label, name = F.col("_label_3"), "Topical restriction"
    return [fail_policy(3, name, label, fail_closed),
            Step(3, name, "blocked", F.when(label.contains("OFF_TOPIC"), F.lit("judge: OFF_TOPIC")))]


def topical_screen(df: DataFrame, verdicts: DataFrame | None = None, fail_closed: bool = False,
                   key: str = "turn_id") -> DataFrame:
    """Block turns the judge calls OFF_TOPIC."""
    return record_all(join_verdicts(start(df), verdicts, key), topical_steps(fail_closed))


def moderation_steps(categories: list[str] | None = None) -> list[Step]:
    name = "OpenAI moderation (input)"
    flagged = F.nullif(F.col("_flagged"), F.lit(""))
    if categories is not None:  # all flagged categories are reported once one of the chosen ones is flagged
        counts = F.exists(F.split("_flagged", ", "), lambda c: c.isin(categories))
        flagged = F.when(counts, flagged)
    return [Step(7, name, "blocked", F.when(F.col("_moderated").isNull(),
                                            F.lit(f"moderation unavailable ({NO_ANSWER}), failing closed"))),
            Step(7, name, "blocked", F.concat(F.lit("flagged: "), flagged))]


def moderation_screen(df: DataFrame, verdicts: DataFrame | None = None, categories: list[str] | None = None,
                      key: str = "turn_id") -> DataFrame:
    """Block turns with a flagged category (of ``categories`` if given); an unmoderated turn is blocked too."""
    return record_all(join_verdicts(start(df), verdicts, key), moderation_steps(categories))


def crisis_judge_steps() -> list[Step]:
    label, name = F.col("_label_16"), "Crisis safe completion"
    return [fail_policy(16, name, label),
            Step(16, name, "blocked", F.when(label.startswith("YES"), F.lit("judge: risk detected")))]


def crisis_judge_screen(df: DataFrame, verdicts: DataFrame | None = None, key: str = "turn_id") -> DataFrame:
    """The judge's half of the crisis rule: answers that start with YES block, no answer is skipped."""
    return record_all(join_verdicts(start(df), verdicts, key), crisis_judge_steps())


def injection_judge_screen(df: DataFrame, verdicts: DataFrame | None = None, key: str = "turn_id") -> DataFrame:
    """The judge behind the injection patterns, asked only about texts the patterns let through."""
    df = join_verdicts(start(df), verdicts, key)
    return record(df, 2, "Prompt injection (judge)", "blocked",
                  F.when(F.col("_label_2").contains("YES"), F.lit("judge: injection")))


def text_chunks(df: DataFrame, key: str = "turn_id", size: int = fixed.ATTACK_CHUNK_CHARS,
                text: str = "text") -> DataFrame:
    """(key, chunk_no, chunk): the pieces a classifier with a short input scores, over the whole text."""
    return df.select(key, F.posexplode(chunks(F.col(text), size)).alias("chunk_no", "chunk"))


def _confidence(score: Column) -> Column:
    return F.coalesce(score["confidence"], F.lit(1.0))


def prompt_attack_helpers(text: Column, threshold: float = fixed.ATTACK_THRESHOLD, size: int = fixed.ATTACK_CHUNK_CHARS,
                          any_chunk: bool = False) -> dict[str, Column]:
    """``_first``: the score that decides, or that a chunk without a score comes first."""
    each = F.transform(F.sequence(F.lit(0), chunk_count(text, size) - 1),
                       lambda i: F.try_element_at(F.col("_scores"), i))

    def hit(s: Column) -> Column:
        return F.coalesce(s["attack"] & (_confidence(s) >= threshold), F.lit(False))

    if any_chunk:
        best = F.array_sort(F.filter(each, hit), lambda a, b: F.when(_confidence(a) > _confidence(b), -1)
                            .when(_confidence(a) < _confidence(b), 1).otherwise(0))
        missing = F.exists(each, lambda s: s.isNull())
        found = F.when(~missing, F.try_element_at(best, F.lit(1)))
    else:
        telling = F.filter(each, lambda s: s.isNull() | hit(s))
        found = F.try_element_at(telling, F.lit(1))
        missing = (F.size(telling) > 0) & found.isNull()
    return {"_first": F.struct(missing.alias("missing"), found.alias("s"))}


def prompt_attack_steps(fail_closed: bool = False) -> list[Step]:
    name, score = "Prompt-attack classifier", F.col("_first.s")
    detail = F.concat(F.coalesce(score["label"], F.lit("None")), F.lit(" (confidence "),
                      F.format_string("%.2f", _confidence(score)), F.lit(")"))
    return [Step(18, name, "blocked" if fail_closed else "skipped",
                 F.when(F.col("_first.missing"), F.lit(unavailable(closed=fail_closed)))),
            Step(18, name, "blocked", F.when(score.isNotNull(), detail))]


def prompt_attack_screen(df: DataFrame, verdicts: DataFrame | None = None, threshold: float = fixed.ATTACK_THRESHOLD,
                         size: int = fixed.ATTACK_CHUNK_CHARS, fail_closed: bool = False, any_chunk: bool = False,
                         key: str = "turn_id", text: str = "text") -> DataFrame:
    """Block texts of which a chunk is an attack with at least the threshold confidence (missing counts as 1).

    Chunks are read in order: the first attack blocks, but an unscored chunk before it makes the check unavailable.
    ``any_chunk=True`` is the variant that takes the highest score of all chunks.
    """
    return record_all(join_verdicts(start(df), verdicts, key), prompt_attack_steps(fail_closed),
                      prompt_attack_helpers(F.col(text), threshold, size, any_chunk))


# ---------------------------------------------------------------------------------------------- output rules

def moderation_replace(df: DataFrame, verdicts: DataFrame | None = None, text: str = "text",
                       key: str = "turn_id") -> DataFrame:
    """Replace flagged answers, and answers that could not be moderated."""
    df = join_verdicts(start(df), verdicts, key)
    name = "OpenAI moderation (output)"
    has_text = F.col(text) != ""
    withheld = has_text & F.col("_moderated").isNull()
    flagged = has_text & (F.col("_flagged") != "")
    df = record(df, 7, name, "modified", F.when(withheld, F.lit(f"moderation unavailable ({NO_ANSWER}), withheld"))
                .when(flagged, F.concat(F.lit("flagged: "), F.col("_flagged"))))
    return rewrite(df, text, withheld | flagged, F.lit(fixed.SAFE_REPLACEMENT))


def _judge_replace(df: DataFrame, number: int, name: str, needle: str, detail: str, replacement: str, text: str,
                   applies: Column) -> DataFrame:
    label = F.col(f"_label_{number}")
    asked = applies & (F.col(text) != "")
    bad = asked & label.contains(needle)
    df = record(df, number, name, "skipped",
                F.when(asked & label.isNull(), F.lit(f"judge unavailable ({NO_ANSWER}), failing open")))
    df = record(df, number, name, "modified", F.when(bad, F.lit(detail)))
    return rewrite(df, text, bad, F.lit(replacement))


def policy_judge(df: DataFrame, verdicts: DataFrame | None = None, text: str = "text",
                 key: str = "turn_id") -> DataFrame:
    """Replace answers the judge calls UNSAFE under the product's policy."""
    df = join_verdicts(start(df), verdicts, key)
    return _judge_replace(df, 12, "Output safety judge", "UNSAFE", "judge: UNSAFE, response replaced",
                          fixed.SAFE_REPLACEMENT, text, F.lit(True))


def relevance_check(df: DataFrame, verdicts: DataFrame | None = None, question: str = "question", text: str = "text",
                    key: str = "turn_id") -> DataFrame:
    """Replace answers that do not address the question; without a question there is nothing to check."""
    df = join_verdicts(start(df), verdicts, key)
    return _judge_replace(df, 30, "Answer relevance", "IRRELEVANT", "judge: IRRELEVANT, answer replaced",
                          fixed.IRRELEVANT_REPLACEMENT, text, F.col(question).isNotNull())
