"""Sources mixed to target weights by Sainte-Lague apportionment.

The mix is a number of equal-token blocks, dealt to shards in equal parts. Blocks go to
sources one after the other, each to the source with the highest quotient
target / (2 * blocks so far + 1); cut at the shards' borders this gives whole quotas per
shard. The documents of a source lie one behind the other in seeded order, so its stream
of words is cut to blocks, and each shard takes as many of the next blocks as its quota
of the source says, from a seeded start, in a circle. What a document gives to one shard in
one reading is a part of it; the parts are the mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmill.llm.tables import WORD, pick, text_of, word_count
from creditmill.operators.dims import BROADCAST_LIMIT_BYTES, broadcast_if_small, measured_bytes
from creditmill.operators.materialize import computed_once

SHARDS = 256
BLOCKS_PER_SHARD = 256
WEIGHTS = (3, 1, 2)
SHARE, MOST_REPEATS = 1.5, 2
SEED = 20240
# Documents in one run of a source's seeded order, and the least number of runs.
RUN_ROWS, LEAST_RUNS = 100_000, 64


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS
) -> DataFrame:
    """source, rank, source_size, target: shares of `share` times all words by weight, none
    above `most` times its source's size.

    Sources in code point order, the missing one last, weigh `weights` in turn. What is
    above a limit is shared anew by weight among the others. That has a closed form: with
    sources in order of limit / weight, the limited ones are a beginning of that order.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = per.select("source", "source_size", (F.row_number().over(order) - 1).alias("rank")).select(
        "*",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * most).alias("limit"),
        (F.sum("source_size").over(every) * F.lit(share)).alias("all"),
        F.lit(0).alias("one"),
    )
    fill = Window.partitionBy("one").orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select(
        "*",
        F.coalesce(F.sum("limit").over(fill), F.lit(0)).alias("limited"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(fill), F.lit(0))).alias("open"),
    ).withColumn("level", (F.col("all") - F.col("limited")) / F.col("open"))
    # A source is limited if its limit is under the level at its place; the first that is
    # not sets the level of all that follow.
    level = F.min(F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))).over(every)
    return before.withColumn("final", level["level"]).select(
        "source", "rank", "source_size",
        F.when(F.col("final").isNull() | (F.col("limit") <= F.col("final") * F.col("weight")), F.col("limit").cast("double"))
        .otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def shard_quotas(targets: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS_PER_SHARD) -> DataFrame:
    """source, rank, shard, quota: blocks per source and shard, shards of equal size.

    The table of seats holds shards x blocks rows (a parameter, not a matter of the input)
    and at most one candidate more per source.
    """
    seats = shards * blocks
    total = Window.partitionBy()
    offered = targets.where("target > 0").select(
        "source", "rank", "target", (F.col("target") / F.sum("target").over(total) * seats).alias("ideal")
    )
    # Among two or more sources no highest-quotient rule gives one much above its ideal
    # number: half of it more, and two, leaves room in every case that can win.
    candidates = offered.select(
        "source", "rank", "target",
        F.explode(F.sequence(F.lit(0), F.least(F.lit(seats - 1), F.ceil(F.col("ideal") * 1.5 + 2).cast("int")))).alias("k"),
    ).withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    won = candidates.withColumn("seat", F.row_number().over(Window.orderBy(F.desc("quotient"), "rank", "k")) - 1)
    return (
        won.where(F.col("seat") < seats)
        .groupBy("source", "rank", F.floor(F.col("seat") / blocks).cast("int").alias("shard"))
        .agg(F.count(F.lit(1)).alias("quota"))
    )


def shard_segments(plan: DataFrame, quotas: DataFrame, shards: int = SHARDS) -> DataFrame:
    """source, reading, shard, seg_from, seg_to: the words of a source's stream that each
    shard takes in each reading of it, by the quotas.

    The first shard begins at the seeded start, each next one where that before it ends:
    after as many whole blocks as its quota. The last one with a quota closes at the words
    `take` of the source; a source without a block gives its words to the last shard.
    """
    ahead = Window.partitionBy("rank").orderBy("shard")
    upto = quotas.select(F.col("rank").alias("_rank"), "shard", F.sum("quota").over(ahead).alias("upto"))
    ends = plan.where("take > 0").join(upto, F.col("rank") == F.col("_rank"), "left").select(
        "source", "rank", "source_size", "start", F.coalesce("shard", F.lit(shards - 1)).alias("shard"),
        F.when(F.coalesce("upto", F.lit(0)) == F.col("blocks"), F.col("take"))
        .otherwise(F.least(F.col("take"), F.round(F.col("upto") * F.col("block")).cast("bigint"))).alias("_end"),
    )
    spans = ends.select(
        "source", "source_size", "shard",
        (F.col("start") + F.lag("_end", 1, 0).over(ahead)).alias("_lo"), (F.col("start") + F.col("_end")).alias("_hi"),
    ).where("_hi > _lo")
    readings = spans.withColumn("reading", F.explode(F.expr("sequence(_lo div source_size, (_hi - 1) div source_size)")))
    zero = F.col("reading") * F.col("source_size")
    return readings.select(
        "source", F.col("reading").cast("int").alias("reading"), "shard",
        (F.greatest("_lo", zero) - zero).alias("seg_from"), (F.least("_hi", zero + F.col("source_size")) - zero).alias("seg_to"),
    )


def overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def document_sizes(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text", "source").select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size")
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_REPEATS,
    shards: int = SHARDS,
    blocks: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of every row: doc_id, source, size, source_size, target, taken,
    passes, cut_from, cut_to, parts.

    `parts` are the mix: an array of (reading, shard, words_from, words_to), the words of
    the document (0-based, end excluded) that a shard takes in a reading of the source.
    Every shard takes its quota of blocks from every source (see `shard_segments`); a
    closing part of a block, shorter than one, brings the source's words to its target in
    the last of its shards, so that small sources do not vanish. `taken` counts the words of
    all parts, at most `most` * size. Regardless of shards, `passes` counts the whole
    readings of the document, and of one more the words cut_from to cut_to are taken (equal
    if none); taken = passes * size + cut words.

    Null texts have no words and are taken 0 times, as are empty ones; the missing source
    is a source. Rows that repeat a doc_id are documents of their own. Rows that tie in
    the seeded order follow each other by doc_id and size, so reruns agree. An empty table
    gives an empty result.
    """
    sizes = computed_once(
        document_sizes(docs).withColumn("order", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source")))
    )
    rows = sizes.count()
    targets = computed_once(source_targets(sizes, weights, share, most))
    quotas = computed_once(shard_quotas(targets, shards, blocks))
    block = F.greatest(F.lit(1.0), F.sum("target").over(Window.partitionBy()) / (shards * blocks))
    plan = targets.select("*", block.alias("block"))
    held = quotas.groupBy("rank").agg(F.sum("quota").alias("blocks"))
    plan = plan.join(held, "rank", "left").select(
        "source", "rank", "source_size", "target", "block", F.coalesce("blocks", F.lit(0)).alias("blocks"),
        # Whole blocks, corrected by less than a block to the target in whole words.
        F.least(
            F.col("source_size") * most,
            F.greatest(
                F.floor((F.coalesce("blocks", F.lit(0)) - 1) * F.col("block")),
                F.least(F.round("target").cast("bigint"), F.ceil((F.coalesce("blocks", F.lit(0)) + 1) * F.col("block"))),
            ),
        ).cast("bigint").alias("take"),
        F.when(F.col("source_size") > 0, F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), F.col("source")), F.col("source_size")))
        .otherwise(F.lit(0)).alias("start"),
    )
    # Positions in the source's stream: runs of the seeded order are summed first, so that
    # no window holds more than one run, whatever the size of the source.
    runs = max(LEAST_RUNS, -(-rows // RUN_ROWS))
    placed = sizes.withColumn("run", F.pmod(F.shiftright("order", 32), F.lit(runs)).cast("int"))
    run_sums = placed.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    ahead = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    run_sums = run_sums.select("source", "run", "run_size", F.coalesce(F.sum("run_size").over(ahead), F.lit(0)).alias("run_start"))
    starts = run_sums.alias("r").join(broadcast_if_small(plan).alias("p"), same(F.col("r.source"), F.col("p.source"))).select(
        F.col("r.source").alias("_source"), F.col("run").alias("_run"), "run_start", "run_size", "source_size", "target", "take", "start"
    )
    # The segments that meet a run are few, so a document is compared with few of them.
    segments = shard_segments(plan, quotas, shards)
    met = same(F.col("_source"), F.col("source")) & (F.col("seg_from") < F.col("run_start") + F.col("run_size")) & (F.col("seg_to") > F.col("run_start"))
    met_segments = F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("reading", "shard", "seg_from", "seg_to")))
    starts = starts.join(broadcast_if_small(segments), met, "left").groupBy(
        "_source", "_run", "run_start", "source_size", "target", "take", "start"
    ).agg(F.sort_array(met_segments).alias("segments"))
    inside = Window.partitionBy("source", "run").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("_at"))
    joined = within.join(starts, same(F.col("source"), F.col("_source")) & (F.col("run") == F.col("_run")))
    n = F.col("source_size")
    low = F.col("run_start") + F.col("_at")
    passes = F.when(n > 0, F.floor(F.col("take") / F.greatest(n, F.lit(1)))).otherwise(F.lit(0)).cast("bigint")
    rest = F.col("take") - F.col("_passes") * n
    at = joined.select("*", low.alias("_low"), (low + F.col("size")).alias("_high"), passes.alias("_passes"))
    at = at.select("*", rest.alias("_rest"))
    # The range [start, start + rest) of the stream, read in a circle.
    end = F.col("start") + F.col("_rest")
    first = overlap(F.col("_low"), F.col("_high"), F.col("start"), F.least(end, n))
    second = overlap(F.col("_low"), F.col("_high"), F.lit(0), F.greatest(F.lit(0), end - n))
    at = at.select("*", first.alias("_one"), second.alias("_two"))
    whole = (F.col("_one") + F.col("_two")) >= F.col("size")
    cut = F.when(whole, F.lit(0)).otherwise(F.col("_one") + F.col("_two"))
    # A document that both ends of the range cut is read from its beginning and to its end.
    cut_from = F.when(cut == 0, F.lit(0)).when(F.col("_two") > 0, F.lit(0)).otherwise(F.greatest(F.col("start") - F.col("_low"), F.lit(0)))
    own = F.filter("segments", lambda s: (s["seg_from"] < F.col("_high")) & (s["seg_to"] > F.col("_low")) & (F.col("size") > 0))
    parts = F.transform(own, lambda s: F.struct(
        s["reading"].alias("reading"), s["shard"].alias("shard"),
        (F.greatest(s["seg_from"], F.col("_low")) - F.col("_low")).alias("words_from"),
        (F.least(s["seg_to"], F.col("_high")) - F.col("_low")).alias("words_to"),
    ))
    at = at.withColumn("_parts", parts)
    return at.select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["words_to"] - p["words_from"]).alias("taken"),
        (F.col("_passes") + F.when(whole & (F.col("size") > 0), 1).otherwise(0)).cast("bigint").alias("passes"),
        cut_from.cast("bigint").alias("cut_from"), (cut_from + cut).cast("bigint").alias("cut_to"),
        F.col("_parts").alias("parts"),
    )


def mixed_documents(docs: DataFrame, shard: str | None = None, **parameters) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each part of each document.

    A part that is the whole document has its text unchanged, any other its words, joined
    by one space; a column n_chars follows a cut text. `shard` names one more column, at
    the end, with the shard that a row belongs to. Parameters as for `mix_plan`."""
    plan = computed_once(mix_plan(docs, **parameters)).where("taken > 0")
    names = docs.columns
    places = {n: ([i for i, c in enumerate(names) if c == n] or [i for i, c in enumerate(names) if c.lower() == n])[0] for n in ("doc_id", "text", "source")}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text, source = (f"c{places[n]}" for n in ("doc_id", "text", "source"))
    chosen = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "parts")
    alike = same(F.col(key), F.col("_id"))
    if not plan.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        # Rows that share a doc_id are told apart by source and size, and then by number.
        body = F.coalesce(F.col(text).cast("string"), F.lit(""))
        plain = plain.withColumn("_words", word_count(body))
        nth = Window.partitionBy(key, source, "_words").orderBy(F.xxhash64(body))
        plain = plain.withColumn("_nth", F.row_number().over(nth))
        chosen = chosen.withColumn("_number", F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy("parts")))
        alike = alike & same(F.col(source).cast("string"), F.col("_source")) & (F.col("_words") == F.col("_size")) & (F.col("_nth") == F.col("_number"))
    # The limit is meant for all parts, not for one field that holds them.
    small = measured_bytes(chosen.select("*", F.explode("parts").alias("_part")).select("_id", "_source", "_size", "_part.*")) <= BROADCAST_LIMIT_BYTES
    rows = plain.join(F.broadcast(chosen) if small else chosen, alike)
    is_cut = lambda p: (p["words_to"] - p["words_from"]) < F.col("_size")
    # A text is cut to words once, however many parts it has.
    rows = rows.withColumn("_list", F.when(F.exists("parts", is_cut), F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))))
    rows = rows.withColumn("_part", F.explode("parts")).withColumn("_cut", is_cut(F.col("_part")))
    words = F.slice("_list", (F.col("_part.words_from") + 1).cast("int"), (F.col("_part.words_to") - F.col("_part.words_from")).cast("int"))
    new_text = F.when(F.col("_cut"), F.array_join(words, " ")).otherwise(F.col(text))
    columns = []
    for i, name in enumerate(names):
        if i == places["text"]:
            columns.append(new_text.alias(f"c{i}"))
        elif name == "n_chars":
            columns.append(F.when(F.col("_cut"), F.length(new_text)).otherwise(F.col(f"c{i}")).cast(plain.schema[f"c{i}"].dataType).alias(f"c{i}"))
        else:
            columns.append(F.col(f"c{i}"))
    if shard is not None:
        columns.append(F.col("_part.shard"))
        names = [*names, shard]
    return rows.select(*columns).toDF(*names)
