"""Mixing sources to target weights by blocks of words.

Each source is one stream of words, cut into blocks of fixed length.  A source gets
as many slots of the mix as its target asks for.  The slots of all sources are dealt
over the output shards by a pseudorandom permutation of the slot numbers, so the
counts of a shard are a multinomial draw, conditioned on the totals of the whole mix
(plain draws would miss the targets by their sampling error).  A slot takes the block
that a permutation of the source's block numbers gives it; slots beyond the number of
blocks start a second round under another permutation, and no target asks for a third.
Blocks are then joined by source and index.

Everything is DataFrame work.  Permutations are "swap or not" shuffles: a number is
swapped with its mirror image or not, by a bit that both share, in each of a few
rounds; this is a bijection of any range, needs no table and no sort.  Word offsets
are running sums in two steps (inside a slice of a source, then over slices), so the
largest source is never one task's work.  The table of sources is one row per source
and is the only thing handled in one task.

NULL texts have no words; a NULL source is a source of its own, the last one.  Rows
without words take nothing.  Repeated rows are separate documents.  NULL keys are
allowed.  An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tableworks.functions.hashing import bucket
from tableworks.llm.common import WORD, new_folder, stored

BLOCK_WORDS = 64
SLICES = 1024
SLOTS_A_TASK = 200_000
ROUNDS = 8
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: A Mersenne prime and a generator of its field: round constants are its powers.
PRIME, BASE = 2**31 - 1, 48271


def constant(i: int) -> int:
    return pow(BASE, 101 + i, PRIME)


def shuffled(value: str, size: str, key: str) -> Column:
    """``value`` moved by the permutation of [0, size) chosen by ``key`` (SQL expressions)."""
    rounds = ", ".join(
        f"named_struct('a', {constant(3 * r)}L, 'b', {constant(3 * r + 1)}L, 'c', {constant(3 * r + 2)}L)"
        for r in range(ROUNDS)
    )
    chosen = f"pmod(CAST({key} AS BIGINT), {PRIME}L)"
    mixed = f"((greatest(x, y) % {PRIME}L) * r.b + {chosen} * r.c) % {PRIME}L"
    swap = f"exists(array({mixed}), m -> (m * m + r.c) % {PRIME}L div 1024 % 2 = 1)"
    step = f"transform(array(pmod(({chosen} + 1) * r.a - x, {size})), y -> if({swap}, y, x))[0]"
    return F.expr(f"aggregate(array({rounds}), CAST({value} AS BIGINT), (x, r) -> {step})")


def word_sizes(documents: DataFrame, text: str, source: str, key: str, seed: int) -> DataFrame:
    """``key, source, size, slice`` of each document; the text stays where it is."""
    return documents.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.pmod(bucket(key, seed), F.lit(SLICES)).alias("slice"),
    )


def source_table(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                 most: int = MOST, block: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: its number, size, weight, target, blocks, slots and first slot.

    Targets are ``min(most × size, level × weight)`` with the level at which they add
    up to the wanted total: what sharing the excess again and again comes to.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    steps = F.array(*[F.lit(float(w)) for w in weights])
    t = totals.withColumn("number", F.row_number().over(by_name) - 1)
    t = t.withColumn("weight", steps[F.col("number") % len(weights)])
    t = t.withColumn("cap", (most * F.col("source_size")).cast("double"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    t = t.withColumns({
        "wanted": F.sum("source_size").over(every) * F.lit(share),
        "level": (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), zero))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)),
    })
    # The level rises while sources fill up and falls after the right one.
    level = F.max("level").over(every)
    t = t.withColumn("target", F.round(F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap")), 6))
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)))
    slots = F.round(F.col("target") * F.col("blocks") / F.greatest(F.col("source_size"), F.lit(1)))
    t = t.withColumn("slots", F.least(slots.cast("long"), most * F.col("blocks")))
    first = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return t.withColumns({
        "first": F.coalesce(F.sum("slots").over(first), F.lit(0)), "all_slots": F.sum("slots").over(every),
    }).drop("cap", "wanted", "level")


def offsets(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``start``, the words of the source before each document."""
    per_slice = sizes.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = per_slice.select("source", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    here = sizes.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    b = base.withColumnsRenamed({"source": "_source", "slice": "_slice"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice"))
    return here.join(b, same).withColumn("start", F.col("base") + F.col("inner")).drop("_source", "_slice", "base", "inner")


def mix_plan(sources: DataFrame, shard_slots: int = 4096) -> DataFrame:
    """``shard, place, number, block, round``: which block each slot of each output shard takes."""
    step = 4096
    total = sources.agg(F.max("all_slots")).first()[0] or 0
    # A set number of partitions: the rows are few here, but each becomes thousands.
    runs = sources.filter("slots > 0").select(
        "number", "blocks", "slots", "first", "all_slots",
        F.explode(F.expr(f"sequence(0L, (slots - 1) div {step})")).alias("run"),
    ).repartition(int(total // SLOTS_A_TASK) + 1, "number", "run")
    slots = runs.select(
        "number", "blocks", "first", "all_slots",
        F.explode(F.expr(f"sequence(run * {step}, least((run + 1) * {step}, slots) - 1)")).alias("k"),
    ).withColumn("round", F.expr("k div blocks"))
    slots = slots.withColumn("at", shuffled("first + k", "all_slots", "7"))
    slots = slots.withColumn("block", shuffled("k % blocks", "blocks", "number * 8 + round + 100"))
    return slots.select(
        F.expr(f"at div {shard_slots}").alias("shard"), F.expr(f"at % {shard_slots}").alias("place"),
        "number", "block", "round",
    )


def block_pieces(placed: DataFrame, sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and block it has words in: ``number, block, from_word, n``."""
    s = sources.select(F.col("source").alias("_source"), "number")
    docs = placed.filter("size > 0").join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    pieces = docs.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    return pieces.withColumns({
        "from_word": F.expr(f"greatest(0, block * {block} - start)"),
        "n": F.expr(f"least(start + size, (block + 1) * {block}) - greatest(start, block * {block})"),
    })


def mixed(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
          block: int = BLOCK_WORDS, seed: int = 23, shard_slots: int = 4096):
    """``(documents with source figures and start, slots joined with their pieces)``."""
    folder = new_folder(documents.sparkSession, "mix")
    sizes = stored(word_sizes(documents, text, source, key, seed), f"{folder}/sizes")
    sources = stored(source_table(sizes, block=block), f"{folder}/sources")
    placed = offsets(sizes)
    pieces = block_pieces(placed, sources, block)
    # Both sides grow with the words and neither has a hot key: never broadcast one.
    taken = mix_plan(sources, shard_slots).join(pieces.hint("merge"), ["number", "block"])
    s = sources.select(F.col("source").alias("_source"), "source_size", "target")
    docs = placed.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return docs, taken


def taken_words(documents: DataFrame, **names) -> DataFrame:
    """``key, source, size, source_size, target, taken`` of each document."""
    docs, taken = mixed(documents, **names)
    sums = taken.groupBy(F.col("source").alias("_source"), F.col("start").alias("_start")).agg(F.sum("n").alias("_taken"))
    same = (
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    )
    return docs.join(sums, same, "left").select(
        "key", "source", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).alias("taken")
    )


def _dealt(documents: DataFrame, text: str, grouped: DataFrame) -> DataFrame:
    """``own, tokens, plan`` of each row that the mix takes something of.

    ``grouped`` makes one ``plan`` of the pieces of a key and start.  Rows are known by their
    key and a hash of all columns; equal rows are dealt the plans of their name by number.
    """
    plans = grouped.groupBy(F.col("key").alias("name")).agg(F.array_sort(F.collect_list(F.struct("start", "plan"))).alias("plans"))
    joined = documents.select("own", "name").join(plans, "name")
    equal = Window.partitionBy("name").orderBy("name")
    one = joined.withColumn("plan", F.try_element_at("plans", F.row_number().over(equal))["plan"]).filter("plan is not null")
    # Texts are cut to words below the explode, once for each document.
    tokens = F.regexp_extract_all(F.col("own")[text], F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    return one.select("own", "plan", tokens.alias("tokens"))


def _named(documents: DataFrame, text: str, source: str, key: str) -> DataFrame:
    """The caller's row as one struct, so that columns may have any name, and what the mix works on."""
    columns = [F.col(f"`{c}`") for c in documents.columns]
    name = F.concat_ws(":", F.col(f"`{key}`").cast("string"), F.xxhash64(*columns).cast("string"))
    return documents.select(
        F.struct(*columns).alias("own"), name.alias("name"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source")
    )


def _words(piece: Column) -> Column:
    return F.slice("tokens", (piece["from_word"] + 1).cast("int"), piece["n"].cast("int"))


def mixed_documents(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix as documents: the columns of ``documents``, a row for each round of a
    document, its text cut to the words that the round takes (with the white space
    that follows them).  Documents without words give no row."""
    named = _named(documents, text, source, key)
    _, taken = mixed(named, "text", "source", "name")
    rounds = taken.groupBy("key", "start", "round").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "n"))).alias("parts")
    )
    copies = rounds.groupBy("key", "start").agg(F.array_sort(F.collect_list(F.struct("round", "parts"))).alias("plan"))
    one = _dealt(named, text, copies).withColumn("round", F.explode("plan"))
    cut = F.array_join(F.flatten(F.transform("round.parts", _words)), "")
    return one.select(*[(cut if c == text else F.col("own")[c]).alias(c) for c in documents.columns])


def mixed_shards(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
                 shard_slots: int = 4096) -> DataFrame:
    """The mix in its order: ``shard, place, at, key, source, text``.

    A shard is a run of slots, ``place`` a slot in it with one block; ``at`` orders the pieces
    of documents inside the block.  How many slots of a shard a source gets is drawn by the
    permutation of all slots.
    """
    named = _named(documents, text, source, key)
    _, taken = mixed(named, "text", "source", "name", shard_slots=shard_slots)
    slots = taken.groupBy("key", "start").agg(
        F.array_sort(F.collect_list(F.struct("shard", "place", F.col("start").alias("at"), "from_word", "n"))).alias("plan")
    )
    one = _dealt(named, text, slots).withColumn("slot", F.explode("plan"))
    return one.select(
        "slot.shard", "slot.place", "slot.at", F.col("own")[key].alias("key"), F.col("own")[source].alias("source"),
        F.array_join(_words(F.col("slot")), "").alias("text"),
    )


def write_shards(documents: DataFrame, path: str, **names) -> None:
    """The mix as one folder for each shard, its rows in order."""
    order = ["shard", "place", "at"]
    mixed_shards(documents, **names).repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("shard").parquet(path)
