"""Mixing sources to target weights by Pfair scheduling.

A source with `share` of every `cycle` slots must run its block j, from one, after slot
floor((j - 1) * cycle / share) and by slot ceil(j * cycle / share). One block per slot,
always the released one with the earliest deadline, meets all of these, so that at any
moment each source is less than one block from its weight. The schedule repeats every
cycle and is made once from the shares alone; blocks of documents look their slots up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stored

BLOCK_ROWS = 8
RESOLUTION = 128
LONGEST_CYCLE = 8192


def target_shares(docs: DataFrame, source_column: str = "source", weights: dict[str, int] | None = None) -> DataFrame:
    """(source, n, share): rows of each source, and given whole shares, or tempered ones in proportion to the root of a source's rows.

    Tempered shares run from 1 to `RESOLUTION`, fewer where there are very many sources.
    A source without a given weight gets one share, so that no rows are lost.
    """
    counts = docs.groupBy(F.col(source_column).alias("source")).agg(F.count("*").alias("n"))
    if weights is not None:
        table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
        share = F.lit(1) if table is None else F.coalesce(table[F.coalesce("source", F.lit(""))], F.lit(1))
        return counts.select("source", "n", F.greatest(share, F.lit(1)).cast("int").alias("share"))
    counts = stored(counts)
    most, sources = counts.agg(F.max("n"), F.count("*")).first()
    finest = max(1, min(RESOLUTION, LONGEST_CYCLE // max(sources, 1)))
    share = F.greatest(F.floor(F.lit(finest) * F.sqrt(F.col("n") / F.lit(most))), F.lit(1))
    return counts.select("source", "n", share.cast("int").alias("share"))


def schedule(shares: DataFrame) -> DataFrame:
    """(source, share, nth, slot, cycle): slots of one cycle, numbers from zero.

    One row of shares, sorted by source, folds over the slots of a cycle. Ties of
    deadlines go to the first source in order.
    """
    state = "named_struct('done', transform(s, x -> 0), 'picked', cast(array() as array<int>))"
    deadline = "(a.done[i] + 1) * cycle DIV s[i].share + if((a.done[i] + 1) * cycle % s[i].share > 0, 1, 0)"
    ready = "filter(sequence(0, size(s) - 1), i -> a.done[i] < s[i].share AND a.done[i] * cycle DIV s[i].share <= t)"
    best = f"array_min(transform({ready}, i -> named_struct('deadline', {deadline}, 'i', i))).i"
    step = (
        f"transform(array({best}), p -> named_struct('done', transform(a.done, (n, i) -> n + if(i = p, 1, 0)), "
        "'picked', array_append(a.picked, p)))[0]"
    )
    folded = (
        shares.agg(F.array_sort(F.collect_list(F.struct("source", "share"))).alias("s"), F.sum("share").cast("int").alias("cycle"))
        .where("cycle > 0")
        .select("s", "cycle", F.expr(f"aggregate(sequence(0, cycle - 1), {state}, (a, t) -> {step}, a -> a.picked)").alias("picked"))
        .select("s", "cycle", F.posexplode("picked").alias("slot", "i"))
        .select(F.col("s")[F.col("i")].alias("x"), "slot", "cycle")
    )
    nth = F.row_number().over(Window.partitionBy("x.source").orderBy("slot")) - 1
    return folded.select("x.source", "x.share", nth.alias("nth"), "slot", "cycle")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    weights: dict[str, int] | None = None,
    block_rows: int = BLOCK_ROWS,
    names: tuple[str, str, str] = ("block", "slot", "place"),
) -> DataFrame:
    """All rows and columns, with each row's block in its source, the block's slot, and the place in the block.

    Rows of a source are taken in the order of the MD5 of their id, then id, then as they are
    read; (slot, place) is the order of the mixture. Sources run out at their own
    time; slots of a source that has run out stay empty, and the others go on. A null
    source is a source, null ids come first, repeated rows are rows. The new columns are
    called `names`, which must not clash. An empty table gives no rows.

    Rows are dealt by ranges of source, MD5, id and a number of their own, so that neither a
    hot source nor one id in all rows gathers in a task; a row's number is its place in its
    range, and only the counts of ranges are summed per source.
    """
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist; choose other names")
    block, slot, place = names
    shares = stored(target_shares(docs, source_column, weights))
    totals = shares.agg(F.count("*"), F.sum("share")).first()
    if max(totals[0], totals[1] or 0) > LONGEST_CYCLE:
        raise ValueError(f"sources and their shares come to {LONGEST_CYCLE} at most")
    order = ["key", "digest", "id", "read"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("key"),
        F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("digest"),
        F.col(id_column).alias("id"),
        F.monotonically_increasing_id().alias("read"),
    )
    # number of the range, and place in it, in the upper and lower bits
    dealt = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "key", F.monotonically_increasing_id().alias("at"))
    )
    at = dealt.select("row", "key", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("within"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = at.groupBy("key", "part").agg(F.count("*").alias("size"), F.min("within").alias("from"))
    offsets = sizes.select("key", "part", (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("from")).alias("offset"))
    # sources follow each other, so there are fewer rows than ranges and sources together
    numbered = at.join(F.broadcast(offsets), ["key", "part"]).withColumn("number", F.col("offset") + F.col("within"))
    plan = stored(schedule(shares))
    plan = plan.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))).drop("source")
    # both have LONGEST_CYCLE rows at most
    of_source = F.broadcast(plan.where("nth = 0").select("key", "share", "cycle"))
    slots = F.broadcast(plan.select("key", "nth", F.col("slot").alias("first_slot")))
    looked = (
        numbered.join(of_source, "key")
        .withColumn("block", F.floor(F.col("number") / block_rows))
        .withColumn("nth", (F.col("block") % F.col("share")).cast("int"))
        .join(slots, ["key", "nth"])
    )
    return looked.select(
        "row.*",
        F.col("block").alias(block),
        (F.floor(F.col("block") / F.col("share")) * F.col("cycle") + F.col("first_slot")).alias(slot),
        (F.col("number") % block_rows).alias(place),
    )
