"""Mixing sources to target weights by Sainte-Laguë apportionment, in Spark's own functions.

The mix is made of blocks of ``BLOCK_WORDS`` words. Sources get whole numbers of blocks
by highest quotients, then each source's groups of shards do, then each group's shards;
within a shard, documents lie end to end in a seeded order and a seeded systematic draw
picks the shard's quota of blocks. The draw has a closed form, so blocks are never
listed and a document's share follows from where it starts and ends. A shard's last
block also holds the words that fill no block; it is drawn from word by word, and in a
source's first shard it makes up what whole blocks miss of the source's target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepact.llm.shared import cut

#: Weights of the sources in code-point order, repeating; null is the last source.
WEIGHTS = (3, 1, 2)
#: Size of the mix and most of a source in it, as multiples of what there is.
SHARE, EPOCHS = 1.5, 2
BLOCK_WORDS = 32
#: Words of a shard, and shards of a group: a source, however hot, is dealt out by so
#: many, and one task apportions the groups of a source or the shards of a group.
SHARD_WORDS, GROUP_SHARDS = 1_000_000, 1_000
#: One task lists the sources; more of them are an error.
MAX_SOURCES = 1_000_000
SEED = "mix-1"


def word_count(text: str | Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0).cast("long"))


def _draw(*parts: Column) -> Column:
    """A number below 2**32 from a digest of the parts."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts], F.lit(SEED)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sainte_lague(parties: DataFrame, votes: str, total: str, seats: str, ties: Sequence[Column], within: Sequence[str] = ()) -> DataFrame:
    """``parties`` with ``quota``: the seats of each party among those of its group.

    Seats go to the highest of votes / 1, votes / 3, votes / 5 and so on, ``total``
    being the group's votes; of equal quotients the first by ``ties`` has it. Only
    quotients near the deciding one are listed: with P parties, each gets no fewer
    than its rounded share of seats - P / 2 and no more than that of seats + P / 2.
    """
    group = Window.partitionBy(*(within or [F.lit(0)]))
    v, all_votes, n = (F.col(c).cast("double") for c in (votes, total, seats))
    half = F.count(F.lit(1)).over(group) / 2
    held = F.floor(v * F.greatest(n - half, F.lit(0.0)) / all_votes + 0.5) - 1
    most = F.floor(v * (n + half) / all_votes + 0.5) + 1
    listed = parties.withColumns({
        "_held": F.when(all_votes > 0, F.greatest(held, F.lit(0))).otherwise(0).cast("long"),
        "_most": F.when((all_votes > 0) & (v > 0), most).otherwise(0).cast("long"),
    })
    listed = listed.withColumn("_open", F.col(seats) - F.sum("_held").over(group))
    numbers = F.when(F.expr("_most > _held"), F.sequence(F.expr("_held + 1"), F.col("_most")))
    places = listed.withColumn("_seat", F.explode_outer(numbers))
    quotient = F.col(votes) / (2 * F.col("_seat") - 1)
    rank = F.row_number().over(group.orderBy(quotient.desc_nulls_last(), *ties, "_seat"))
    won = F.when(F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_open")), 1).otherwise(0)
    names = parties.columns
    return (
        places.withColumn("_rank", rank)
        .groupBy(*names, "_held")
        .agg((F.col("_held") + F.sum(won)).alias("quota"))
        .select(*names, "quota")
    )


def source_targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) with weight, total and target.

    A source that would get more than ``EPOCHS`` times its size stops there and the
    rest is shared anew by weight. That ends at one level: words per unit of weight.
    In order of cap per weight, the level is the first that no later source's cap is
    under. One task lists the sources; over ``MAX_SOURCES`` of them raise.
    """
    every = Window.partitionBy(F.lit(0))
    weights = F.array(*map(F.lit, WEIGHTS))
    few = F.count(F.lit(1)).over(every) <= MAX_SOURCES
    sources = sources.withColumn("_few", few).withColumn(
        "source_size",
        F.when(F.col("_few"), F.col("source_size")).otherwise(F.raise_error(f"over {MAX_SOURCES} sources").cast("long")),
    ).drop("_few")
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sources.withColumn("weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int")))
    ranked = ranked.withColumns({
        "cap": EPOCHS * F.col("source_size"),
        "total": SHARE * F.sum("source_size").over(every),
    })
    ranked = ranked.withColumn("per_weight", F.col("cap") / F.col("weight"))
    before = every.orderBy("per_weight", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    less = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    level = (F.col("total") - less("cap")) / (F.sum("weight").over(every) - less("weight"))
    ranked = ranked.withColumn("_level", level)
    fits = F.when(F.col("_level") <= F.col("per_weight"), F.struct("per_weight", "_level"))
    ranked = ranked.withColumn("_level", F.min(fits).over(every)["_level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("_level") * F.col("weight"), F.col("cap").cast("double")))
    return ranked.select("source", "source_size", "weight", "total", target.alias("target"))


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each row of ``docs``.

    Sizes are words, 0 for null and empty texts; a null source is a source, the last
    one. ``taken`` words of a row are in the mix, at most twice its size. Rows that
    share a key, or have none, stay apart; of rows with equal draws the smaller key,
    then the smaller size lies first, so reruns agree. A very long text is one row
    like any other: it makes its shard longer, which changes no target. No rows give
    none. Columns of ``docs`` are read by name; others, whatever they are called, go.
    """
    plain = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size")
    )
    sized = cut(plain.withColumn("draw", _draw(F.col("doc_id"))))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = targets.withColumn("blocks", F.round(F.col("total") / BLOCK_WORDS).cast("long"))
    quotas = sainte_lague(targets, "target", "total", "blocks", [F.col("source").asc_nulls_last()])
    quotas = cut(quotas.select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        F.col("quota").alias("blocks"),
        F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).cast("long").alias("shards"),
        (F.round("target").cast("long") - F.col("quota") * BLOCK_WORDS).alias("rest"),
    ))

    owned = sized.join(quotas, F.col("source").eqNullSafe(F.col("_s")))
    dealt = owned.filter("size > 0").withColumn("shard", F.expr("draw % shards"))
    parts = dealt.groupBy("_s", "source_size", "blocks", "rest", "shard").agg(F.sum("size").alias("shard_size"))
    parts = cut(parts.withColumn("batch", F.floor(F.col("shard") / GROUP_SHARDS)))
    groups = parts.groupBy("_s", "source_size", "blocks", "batch").agg(F.sum("shard_size").alias("batch_size"))
    groups = sainte_lague(groups, "batch_size", "source_size", "blocks", [F.col("batch")], ["_s"])
    groups = groups.select(F.col("_s").alias("_g"), F.col("batch").alias("_b"), "batch_size", F.col("quota").alias("batch_blocks"))
    parts = parts.join(groups, F.col("_s").eqNullSafe(F.col("_g")) & (F.col("batch") == F.col("_b"))).drop("_g", "_b")
    parts = sainte_lague(parts, "shard_size", "batch_size", "batch_blocks", [F.col("shard")], ["_s", "batch"])
    words = F.col("quota") * BLOCK_WORDS + F.when(F.col("shard") == 0, F.col("rest")).otherwise(0)
    parts = parts.withColumns({
        "words": F.least(F.greatest(words, F.lit(0)), EPOCHS * F.col("shard_size")),
        "n": F.greatest(F.floor(F.col("shard_size") / BLOCK_WORDS) - 1, F.lit(0)),
        "seed": _draw(F.col("_s"), F.col("shard"), F.lit("phase")),
    }).withColumn("last", F.col("shard_size") - BLOCK_WORDS * F.col("n"))
    # whole blocks in proportion, but so many that the last one can hold the words left
    least = F.ceil((F.col("words") - EPOCHS * F.col("last")) / BLOCK_WORDS)
    even = F.round(F.col("words") * (F.lit(1) - F.col("last") / F.col("shard_size")) / BLOCK_WORDS).cast("long")
    most = F.least(F.floor(F.col("words") / BLOCK_WORDS), EPOCHS * F.col("n"))
    parts = parts.withColumn("q", F.least(F.greatest(even, least, F.lit(0)), most))
    parts = parts.select(
        F.col("_s").alias("_t"), F.col("shard").alias("_u"), "n", "q", "last", "seed", F.expr(f"words - q * {BLOCK_WORDS}").alias("left")
    )
    lined = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    stop = F.sum("size").over(lined.rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("stop", stop)
    placed = placed.join(parts, F.col("source").eqNullSafe(F.col("_t")) & (F.col("shard") == F.col("_u")))
    taken = (_drawn(F.col("stop")) - _drawn(F.expr("stop - size"))).cast("long")
    names = ["doc_id", "source", "size", "source_size", "target"]
    # rows without words need no place, and may be any number in one shard
    wordless = owned.filter("size = 0").select(*names, F.lit(0).cast("long").alias("taken"))
    return placed.select(*names, taken.alias("taken")).union(wordless)


def _drawn(words: Column) -> Column:
    """Words taken of a shard's first ``words``.

    Of n blocks and a quota q, block b is taken floor((b + 1) q / n) - floor(b q / n)
    times, but for the phase; the last block's words likewise.
    """
    whole = F.least(words, BLOCK_WORDS * F.col("n"))
    block = F.floor(whole / BLOCK_WORDS)
    blocks = F.greatest(F.col("n"), F.lit(1))
    picked = lambda b: F.floor((b * F.col("q") + F.col("seed") % blocks) / blocks)
    of_last = F.floor(((words - whole) * F.col("left") + F.col("seed") % F.col("last")) / F.col("last"))
    return BLOCK_WORDS * picked(block) + (whole - block * BLOCK_WORDS) * (picked(block + 1) - picked(block)) + of_last


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in a mix of one and a half times all words."""
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: (doc_id, source, size, source_size, target, taken) of every document."""
    return mix_sources(docs)


def _sql_draw(*parts: str) -> str:
    joined = " || ':' || ".join([*(f"coalesce(cast({p} as varchar), '')" for p in parts), f"'{SEED}'"])
    return f"cast('0x' || substr(md5({joined}), 1, 8) as bigint)"


def _sql_quota(table: str, names: str, votes: str, total: str, seats: str, ties: str, within: str) -> str:
    group = f"partition by {within}"
    return f"""
    select {names}, any_value(held) + count(*) filter (seat is not null and place <= open) quota from (
        select *, row_number() over ({group} order by {votes} / (2 * seat - 1) desc nulls last, {ties}, seat) place from (
            select *, {seats} - sum(held) over ({group}) open,
                unnest(case when most > held then range(held + 1, most + 1) else [null] end) seat
            from (
                select *,
                    case when {total} > 0 then greatest(cast(floor({votes} * greatest({seats} - half, 0.0::double) / {total} + 0.5::double) as bigint) - 1, 0) else 0 end held,
                    case when {total} > 0 and {votes} > 0 then cast(floor({votes} * ({seats} + half) / {total} + 0.5::double) as bigint) + 1 else 0 end most
                from (select *, count(*) over ({group}) / 2.0::double half from {table})
            )
        )
    ) group by all"""


def sql(documents: str = "documents", columns: str = "doc_id, size, source_size, target, taken") -> str:
    """The mix of a table as one SELECT."""
    block = lambda x: f"(least({x}, {BLOCK_WORDS} * n) // {BLOCK_WORDS})"
    picked = lambda b: f"(({b} * q + seed % greatest(n, 1)) // greatest(n, 1))"
    drawn = lambda x: (
        f"({BLOCK_WORDS} * {picked(block(x))} + (least({x}, {BLOCK_WORDS} * n) % {BLOCK_WORDS}) * "
        f"({picked(f'({block(x)} + 1)')} - {picked(block(x))}) + "
        f"(greatest(({x}) - {BLOCK_WORDS} * n, 0) * \"left\" + seed % \"last\") // \"last\")"
    )
    return f"""
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) size,
        {_sql_draw("doc_id")} draw
    from {documents}
),
s1 as (select source, cast(sum(size) as bigint) source_size from sized group by 1),
s2 as (
    select *, [{", ".join(map(str, WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] weight,
        {EPOCHS} * source_size cap, {SHARE}::double * sum(source_size) over () total
    from s1
),
s3 as (
    select *, cap::double / weight per_weight,
        (total - coalesce(sum(cap) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double lvl
    from s2 window before as (order by cap::double / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
s4 as (
    select source, source_size, total, least(cap::double, coalesce((select arg_min(lvl, per_weight) from s3 where lvl <= per_weight) * weight, cap)) target,
        cast(round(total / {BLOCK_WORDS}) as bigint) blocks, 0 one
    from s3
),
quotas as (
    select source, source_size, target, quota blocks, greatest(cast(ceil(source_size / {SHARD_WORDS}::double) as bigint), 1) shards,
        cast(round(target) as bigint) - quota * {BLOCK_WORDS} rest
    from ({_sql_quota("s4", "source, source_size, target, total", "target", "total", "blocks", "source nulls last", "one")})
),
owned as (select z.*, source_size, target, blocks, rest, shards from sized z join quotas q on z.source is not distinct from q.source),
dealt as (select *, draw % shards shard from owned where size > 0),
p1 as (
    select source, source_size, blocks, rest, shard, shard // {GROUP_SHARDS} batch, cast(sum(size) as bigint) shard_size
    from dealt group by all
),
g1 as (select source, source_size, blocks, batch, cast(sum(shard_size) as bigint) batch_size from p1 group by all),
g2 as ({_sql_quota("g1", "source, batch, batch_size", "batch_size", "source_size", "blocks", "batch", "source")}),
p2 as (
    select p.*, batch_size, g.quota batch_blocks from p1 p join g2 g on p.source is not distinct from g.source and p.batch = g.batch
),
p3 as ({_sql_quota("p2", "source, shard, shard_size, rest", "shard_size", "batch_size", "batch_blocks", "shard", "source, batch")}),
p4 as (
    select *, least(greatest(quota * {BLOCK_WORDS} + case when shard = 0 then rest else 0 end, 0), {EPOCHS} * shard_size) words,
        greatest(shard_size // {BLOCK_WORDS} - 1, 0) n, {_sql_draw("source", "shard", "'phase'")} seed
    from p3
),
p5 as (select *, shard_size - {BLOCK_WORDS} * n "last" from p4),
p6 as (
    select *, least(
        greatest(
            cast(round(words * (1 - "last" / shard_size::double) / {BLOCK_WORDS}::double) as bigint),
            cast(ceil((words - {EPOCHS} * "last") / {BLOCK_WORDS}::double) as bigint), 0
        ),
        least(words // {BLOCK_WORDS}, {EPOCHS} * n)
    ) q
    from p5
),
p7 as (select source, shard, n, q, "last", seed, words - q * {BLOCK_WORDS} "left" from p6),
lined as (
    select *, cast(sum(size) over (partition by source, shard order by draw, doc_id, size rows unbounded preceding) as bigint) stop from dealt
),
mixed as (
    select l.doc_id, l.source, size, source_size, target, {drawn("stop")} - {drawn("(stop - size)")} taken
    from lined l join p7 p on l.source is not distinct from p.source and l.shard = p.shard
    union all
    select doc_id, source, size, source_size, target, 0 from owned where size = 0
)
select {columns} from mixed"""


SQL = sql()
