"""Mixing sources to target weights: equal-token blocks dealt to sources and their shards by Sainte-Lague.

1. Every document gets its size in words. Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the
   total of all sizes by weight; a target stops at three times its source, and what is over is shared again among the rest.
2. The documents of a source are dealt by hash into shards of about equal words. In a shard they follow one another in
   seeded order, and the row of their words is cut into blocks of (nearly) equal size.
3. Seats, a seat being one use of a block, go to sources and then to the shards of each source by highest quotients
   ``w / (2 s + 1)``, so every shard gets an integer quota, at most three times its blocks.
4. Every block of a shard is used ``quota div blocks`` times, and those first in seeded order once more.

``taken`` counts the words of a document in used blocks, repeats included. Nothing depends on how the table is read, so reruns
agree. Per-source tables are small; a source of any size is spread over its shards.

Defined results: a null or blank text has size 0 and takes 0; a null source is a source; null ids and repeated rows are rows
like others (equal rows may change places); an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnwarden.llm.text import GAP, numbered, words
from turnwarden.sources.shared import settle

#: Most uses of a block, and so the most that a target may be of its source.
MOST = 3
#: Words in a block, at most; small corpora are cut into ``BLOCKS`` blocks, so that targets can be met closely.
BLOCK = 2048
BLOCKS = 20_000
#: Words in a shard, unless that makes more than ``SHARDS`` of them; their number bounds what is ranked per source.
SHARD = 250_000
SHARDS = 1_000_000
WEIGHTS = (1, 2, 3)


def highest_quotients(parties: DataFrame, group: str, key: str, weight: str, cap: str, seats: DataFrame) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group go to the highest of the quotients weight / (s + 1/2).

    With total weight W, P parties and N seats, a quotient above W / (N - P/2) always wins and one below W / (N + P/2) never
    does, which leaves at most two open quotients per party to rank. Ties go by ``key``. No quota exceeds ``cap``.
    """
    total = parties.groupBy(group).agg(F.sum(weight).alias("_w"), F.count("*").alias("_p")).join(seats, group)
    rows = parties.join(total, group)
    sure = F.when(F.col("_n") > F.col("_p") / 2, F.col(weight) * (F.col("_n") - F.col("_p") / 2) / F.col("_w") * (1 - 1e-9) + 0.5)
    open_ = F.col(weight) * (F.col("_n") + F.col("_p") / 2) / F.col("_w") * (1 + 1e-9) + 0.5
    rows = rows.filter("_w > 0").withColumns({
        "_base": F.least(F.col(cap), F.floor(F.coalesce(sure, F.lit(0.0)))), "_top": F.least(F.col(cap), F.floor(open_))})
    left = rows.groupBy(group).agg((F.first("_n") - F.sum("_base")).alias("_left"))
    ranked = rows.filter("_top > _base").withColumn("_s", F.explode(F.sequence("_base", F.col("_top") - 1))).select(
        group, key, (F.col(weight) / (F.col("_s") + 0.5)).alias("_q"))
    won = ranked.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_q"), key))).join(left, group).filter("_r <= _left")
    extra = won.groupBy(group, key).agg(F.count("*").alias("_extra"))
    return rows.join(extra, [group, key], "left").withColumn("quota", F.col("_base") + F.coalesce("_extra", F.lit(0))).select(
        *parties.columns, "quota")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``_sid`` (place in code point order), ``source``, ``source_size``, ``target``.

    Only sums pass through the driver. A round caps at least one more source, or ends.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = settle(numbered(sources, [F.asc_nulls_last("source")], "_sid", "sources").withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_sid") % len(WEIGHTS) + 1).cast("int"))), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        over = F.col("_weight") * F.lit(share) > F.col("source_size") * MOST
        n, held, free = sources.agg(F.count_if(over), F.sum(F.when(over, F.col("source_size") * MOST)), F.sum(F.when(~over, F.col("_weight")))).first()
        if n == capped or not free:
            break
        capped, share = n, (total - (held or 0)) / free
        if capped == 0 and share == 0:
            break
    return sources.withColumn("target", F.least(F.col("_weight") * F.lit(share), (F.col("source_size") * MOST).cast("double")))


def plan(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 7,
         row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The sized documents with their source's target, and the pieces of documents in blocks with the uses of the block. Both
    name a document by ``row``, a number of its own."""
    row = F.monotonically_increasing_id() if row is None else row
    sized = settle(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("_key"), row.alias("_row")), "mix-sizes")
    of = settle(targets(sized), "mix-targets")
    total = of.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, min(BLOCK, total // BLOCKS))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / max(SHARD, total / SHARDS)))
    known = sized.join(of, sized["source"].eqNullSafe(of["source"])).select(sized["*"], "_sid", "source_size", "target")
    # The shard is the high part of one number and the order within it another, so that neither tells the other.
    known = known.withColumns({"_shard": F.pmod("_key", shards), "_order": F.xxhash64(F.col("_key"), F.lit(seed + 1))})
    within = Window.partitionBy("_sid", "_shard").orderBy("_order", "_key", "_row")
    placed = settle(known.withColumn("_from", F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "mix-placed")
    sizes = placed.groupBy("_sid", "_shard").agg(F.sum("size").alias("_words")).filter("_words > 0").withColumn(
        "_blocks", F.greatest(F.lit(1), F.round(F.col("_words") / block)).cast("long"))
    sizes = settle(sizes, "mix-shards")
    # Written, so that the one group is a column to join on.
    parties = settle(sizes.groupBy("_sid").agg(F.sum("_blocks").alias("_blocks")).join(of, "_sid").select(
        "_sid", F.lit(0).alias("_all"), (F.col("target") / F.col("source_size") * F.col("_blocks")).alias("_weight"), (F.col("_blocks") * MOST).alias("_cap")), "mix-parties")
    seats = parties.groupBy("_all").agg(F.round(F.sum("_weight")).cast("long").alias("_n"))
    per_source = highest_quotients(parties, "_all", "_sid", "_weight", "_cap", seats).select("_sid", F.col("quota").alias("_n"))
    quotas = highest_quotients(sizes.withColumns({"_weight": F.col("_blocks").cast("double"), "_cap": F.col("_blocks") * MOST}),
                               "_sid", "_shard", "_weight", "_cap", per_source)
    chosen = quotas.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_sid", "_shard").orderBy(F.xxhash64(F.lit(seed), "_sid", "_shard", "_block"), "_block")))
    uses = F.floor(F.col("quota") / F.col("_blocks")) + F.when(F.col("_rank") <= F.col("quota") % F.col("_blocks"), 1).otherwise(0)
    blocks = chosen.select("_sid", "_shard", "_block", uses.alias("_uses"))

    def border(number: Column) -> Column:  # the first word of a block
        return F.floor(number * F.col("_words") / F.col("_blocks"))

    def holder(word: Column) -> Column:  # the block of a word
        guess = F.floor(word * F.col("_blocks") / F.col("_words"))
        return F.when(border(guess + 1) <= word, guess + 1).otherwise(guess)

    cut = placed.filter("size > 0").join(sizes, ["_sid", "_shard"]).withColumn(
        "_block", F.explode(F.sequence(holder(F.col("_from")), holder(F.col("_from") + F.col("size") - 1))))
    cut = cut.withColumns({"_first": F.greatest(border(F.col("_block")) - F.col("_from"), F.lit(0)),
                           "_end": F.least(border(F.col("_block") + 1) - F.col("_from"), F.col("size"))})
    pieces = cut.select("_row", "doc_id", "_sid", "_shard", "_block", "_first", "_end").join(blocks, ["_sid", "_shard", "_block"])
    return placed, pieces


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 7) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken."""
    placed, pieces = plan(docs, text, source, doc_id, seed)
    taken = pieces.groupBy("_row").agg(F.sum((F.col("_end") - F.col("_first")) * F.col("_uses")).alias("taken"))
    return placed.join(taken, "_row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", n_chars: str | None = "n_chars", seed: int = 7) -> DataFrame:
    """The mix itself, with the columns of ``docs``: the words in used blocks, with the white space before them, once per use.

    Copy k of a document holds the blocks used at least k times; one that holds all of them is the text as it was. Documents
    without words stay as they are. The documents are written with a row number, by which each finds its own plan, whatever its id.
    """
    packed = settle(docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")), "mix-documents")
    _, pieces = plan(packed, f"_doc.{text}", f"_doc.{source}", f"_doc.{doc_id}", seed, F.col("_row"))
    spans = pieces.filter("_uses > 0").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_first", "_end", "_uses"))).alias("_spans"))
    full = F.col(f"_doc.{text}")
    used = packed.join(spans, "_row", "left").withColumn("_size", F.size(words(full)))
    used = used.filter("_size = 0 or _spans is not null")
    copies = F.when(F.col("_size") > 0, F.array_max(F.transform("_spans", lambda s: s["_uses"]))).otherwise(1)
    used = used.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long"))))
    used = used.withColumn("_own", F.filter("_spans", lambda s: s["_uses"] >= F.col("_copy")))
    whole = (F.col("_size") == 0) | (F.aggregate("_own", F.lit(0).cast("long"), lambda a, s: a + s["_end"] - s["_first"]) == F.col("_size"))
    gap = GAP[:-1]
    used = used.withColumn("_parts", F.when(~whole, F.regexp_extract_all(full, F.lit(f"{gap}*[^{gap[1:]}+"), F.lit(0))))
    cut = F.array_join(F.flatten(F.transform("_own", lambda s: F.slice("_parts", (s["_first"] + 1).cast("int"), (s["_end"] - s["_first"]).cast("int")))), "")
    used = used.withColumn("_text", F.when(whole, full).otherwise(cut))
    names = {text: F.col("_text"), **({n_chars: F.length("_text").cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {})}
    return used.select(*[(names[c] if c in names else F.col(f"_doc.{c}")).alias(c) for c in docs.columns])
