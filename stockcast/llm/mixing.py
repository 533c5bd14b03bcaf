"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame operations only.

A source's target over its size is the number of copies each of its documents should have. The whole
part is taken outright. The fractions are rounded by pivots: two documents swap mass at random until
one fraction is 0 or 1, the other goes on to the next document. Chunks of a few hundred documents are
folded independently, the one unsettled document of each goes up to the next level, and so on until
one per source is left, which a last draw settles. Every document keeps its expected copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockcast.llm.order import hash_bucket, unit_interval
from stockcast.operators.hot_groups import MAX_LISTED
from stockcast.session import write_stage

WORD = r"[^\x20\x09-\x0D]+"
SEED = 42
FAN_IN_BITS = 8  # 256 documents, or residuals, meet in one fold
EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of words split at ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Target size of every source: source, source_rows, source_size, target.

    Sources in code-point order, null last, take the weights in turn. They divide ``share`` times all
    sizes by weight, but none gets more than ``cap`` times its own size; the excess goes to the others.
    That is one water level: a source is full once its cap over its weight lies below the level. A
    source without words has target 0. One row per source passes through one task.
    """
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size"))
    n = len(weights)
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % n + 1).cast("int"))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    full = Window.orderBy("ratio", "place")
    levels = (
        totals.withColumn("place", F.row_number().over(by_code))
        .withColumn("weight", picked)
        .withColumn("most", F.col("source_size") * F.lit(cap))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(share))
        .withColumn("full_before", F.coalesce(F.sum("most").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("open_weight"))
    )
    first = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "place", "level"))).over(Window.partitionBy())
    level = F.col("first.level")
    target = F.when(level.isNull(), F.col("most")).otherwise(F.least(F.col("most"), level * F.col("weight")))
    return levels.withColumn("first", first).select("source", "source_rows", "source_size", target.alias("target"))


_ITEM = "struct<row: struct<doc_id: bigint, source: string, size: bigint, hash: bigint, twin: int>, p: double>"


def _fold(items: str, seed: int, level: int) -> str:
    """SQL that folds an array of (row, p): the unsettled item ``open`` and the settled ones ``done``."""
    draw = f"(shiftrightunsigned(xxhash64({seed}, {level}, acc.open.row, x.row), 11) * {2.0 ** -53!r}D)"
    both = "(acc.open.p + x.p)"
    low = f"""if({draw} * {both} < acc.open.p,
        struct(named_struct('row', acc.open.row, 'p', {both}) AS open, named_struct('row', x.row, 'p', 0D) AS out),
        struct(named_struct('row', x.row, 'p', {both}) AS open, named_struct('row', acc.open.row, 'p', 0D) AS out))"""
    high = f"""if({draw} * (2D - {both}) < 1D - x.p,
        struct(named_struct('row', x.row, 'p', {both} - 1D) AS open, named_struct('row', acc.open.row, 'p', 1D) AS out),
        struct(named_struct('row', acc.open.row, 'p', {both} - 1D) AS open, named_struct('row', x.row, 'p', 1D) AS out))"""
    pivot = f"if({both} < 1D, {low}, {high})"
    # one step computes the pivot once, as a one-element array
    step = f"""element_at(transform(array({pivot}), s -> named_struct('open', s.open, 'done', concat(acc.done, array(s.out)))), 1)"""
    start = f"named_struct('open', cast(null as {_ITEM}), 'done', cast(array() as array<{_ITEM}>))"
    return f"""aggregate({items}, {start}, (acc, x) -> if(acc.open is null,
        named_struct('open', x, 'done', acc.done), {step}))"""


def copies_per_document(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = SEED
) -> DataFrame:
    """How often the mix takes each row of ``sized`` (doc_id long, source, size, hash of the content).

    Returns doc_id, source, size, hash, twin (number among rows equal in all of that), source_size,
    target and copies. Draws depend on the rows alone, so reruns agree. Null sources are one source.
    """
    keys = ["doc_id", "source", "size", "hash"]
    numbered = sized.withColumn("twin", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    numbered = write_stage(numbered, "mix-rows")
    targets = write_stage(source_targets(numbered, weights, share, cap), "mix-targets")  # a list would pass Python workers
    n_sources, rows = targets.agg(F.count(F.lit(1)), F.coalesce(F.max("source_rows"), F.lit(0))).first()
    if n_sources <= MAX_LISTED:
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + EPS))
    targets = targets.withColumn("part", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    same_source = F.col("l.source").eqNullSafe(F.col("r.source"))

    bits = max(0, (max(1, rows) - 1).bit_length() - FAN_IN_BITS)
    row = F.struct(*[F.col(f"l.{c}").alias(c) for c in [*keys, "twin"]]).alias("row")
    spread = F.xxhash64(F.lit(seed), "l.doc_id", "l.size", "l.hash", "l.twin")
    items = numbered.alias("l").join(targets.alias("r"), same_source).select(
        F.col("l.source").alias("source"), hash_bucket(spread, bits).alias("chunk"), row, F.col("part").alias("p"))
    settled = items.where(F.col("p") <= EPS).select("row", F.lit(0.0).alias("p"))
    items = items.where(F.col("p") > EPS)
    done, level = [settled], 0
    while True:
        gathered = items.groupBy("source", "chunk").agg(F.expr(
            "sort_array(collect_list(struct(row.size AS size, row, p)))").alias("items"))
        folded = gathered.select("source", "chunk", F.expr(
            _fold("transform(items, x -> named_struct('row', x.row, 'p', x.p))", seed, level)).alias("f"))
        folded = write_stage(folded.select("source", "chunk", "f.open", "f.done"), "mix-level")
        done.append(folded.select(F.explode("done").alias("d")).select("d.row", "d.p"))
        items = folded.select("source", F.shiftright("chunk", FAN_IN_BITS).alias("chunk"), "open.row", "open.p")
        if bits == 0:
            break
        bits, level = max(0, bits - FAN_IN_BITS), level + 1
    last = unit_interval(F.xxhash64(F.lit(seed), F.lit(-1), "row")) < F.col("p")
    done.append(items.select("row", F.when(last, 1.0).otherwise(0.0).alias("p")))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    rounded = rounded.select("row.*", F.col("p").cast("int").alias("bit"))
    return rounded.alias("l").join(targets.alias("r"), same_source).select(
        *[f"l.{c}" for c in [*keys, "twin"]], "source_size", "target", (F.col("whole") + F.col("bit")).alias("copies"))


def sized_rows(docs: DataFrame) -> DataFrame:
    """The narrow rows that mixing decides on: doc_id, source, size in words, hash of the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))


def mix_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with the columns of ``docs``.

    Documents taken zero times go. Repeated rows are told apart by a number among their equals.
    """
    names = [f"__d{i}" for i in range(len(docs.columns))]
    text, source, doc = (f"__d{docs.columns.index(c)}" for c in ("text", "source", "doc_id"))
    keyed = docs.toDF(*names).withColumns({
        "__id": F.col(doc).cast("long"), "__source": F.col(source).cast("string"),
        "__size": word_count(F.col(text)), "__hash": F.xxhash64(text)})
    keys = ["__id", "__source", "__size", "__hash"]
    keyed = keyed.withColumn("__twin", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    taken = copies_per_document(sized_rows(docs), **options).where(F.col("copies") > 0)
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    match &= (F.col("size") == F.col("__size")) & (F.col("hash") == F.col("__hash")) & (F.col("twin") == F.col("__twin"))
    repeated = keyed.join(taken, match).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
