"""Preference formatting of conversation pairs, in Spark's own functions.

The turns that a chosen and a rejected conversation begin with alike are rendered
once, as the prompt; what follows on either side is a completion, with the spans that
count for training: what the assistant says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the chat markup, and the roles that are trained on
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def render_turn(turn: Column) -> Column:
    """One turn as text; markup within it is broken, so that a text can't end its turn."""
    body = F.regexp_replace(F.coalesce(turn["text"], F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1| >")
    role = F.regexp_replace(F.coalesce(turn["role"], F.lit("unknown")), r"<\|(im_start|im_end)\|>", "< |$1| >")
    return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END), F.lit("\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render_turn), "")


def _spans(turns: Column) -> Column:
    """(start, end) characters of what is trained on, as ``start-end`` texts joined by commas.

    A span is an assistant's text and the mark that ends it, without the head line.
    """
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(render_turn(turn))
        head = F.length(F.concat(F.lit(START + TRAINED + "\n")))
        span = F.concat((state["at"] + head).cast("string"), F.lit("-"), (end - 1).cast("string"))
        ours = turn["role"].eqNullSafe(F.lit(TRAINED))
        spans = F.when(ours, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, empty, step, lambda s: F.array_join(s["spans"], ","))


def format_preferences(turns: DataFrame, pair: str = "pair_id", chosen: str = "chosen") -> DataFrame:
    """One row a pair, from (pair, chosen, turn, role, text) rows of both sides.

    Turns are in order of ``turn`` (null first), then role, then text; exact repeats
    of a turn count once. Turns are alike if role and text are, nulls being alike.
    prompt is the longest common prefix, chosen and rejected what follows, and
    chosen_spans and rejected_spans the trained characters of each. If one side is a
    prefix of the other its completion is empty; a side without turns leaves the
    prompt empty, and usable says that both sides have something to train on. Rows
    whose pair or ``chosen`` is null belong to no pair. Other columns are not read.

    A pair's turns meet in one row, as the result is one; nothing else is grouped.
    """
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    side = lambda wanted: F.array_sort(F.collect_set(F.when(F.col(chosen) == wanted, turn)))
    sides = (
        turns.filter(F.col(pair).isNotNull() & F.col(chosen).isNotNull())
        .groupBy(F.col(pair).alias("pair_id"))
        .agg(side(F.lit(True)).alias("a"), side(F.lit(False)).alias("b"))
    )
    both = F.zip_with("a", "b", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    differs = F.array_position(both, False)
    shared = F.least(F.when(differs > 0, differs - 1), F.size("a"), F.size("b")).cast("int")
    rest = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    cut = sides.withColumn("n", shared).select(
        "pair_id", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), rest("a").alias("a"), rest("b").alias("b")
    )
    return cut.select(
        "pair_id",
        F.col("n").cast("long").alias("n_shared"),
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("a")).alias("chosen"),
        _rendered(F.col("b")).alias("rejected"),
        _spans(F.col("a")).alias("chosen_spans"),
        _spans(F.col("b")).alias("rejected_spans"),
    ).withColumn("usable", (F.col("chosen_spans") != "") & (F.col("rejected_spans") != ""))


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in pairs: those numbered 2k are chosen over those numbered 2k + 1."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"), "turn", "role", "text"
    )
    return format_preferences(turns)


_BROKEN = "regexp_replace(coalesce({}, '{}'), '<\\|(im_start|im_end)\\|>', '< |\\1| >', 'g')"
_TURN = f"'{START}' || {_BROKEN.format('x.role', 'unknown')} || chr(10) || {_BROKEN.format('x.text', '')} || '{END}' || chr(10)"
_HEAD = len(START + TRAINED) + 1


def _sql_side(turns: str) -> tuple[str, str]:
    """Rendered text and trained spans of a list of turns."""
    texts = f"list_transform({turns}, lambda x: {_TURN})"
    text = f"coalesce(array_to_string({texts}, ''), '')"
    spans = (
        f"array_to_string(list_filter(list_transform({turns}, lambda x, i: case when x.role = '{TRAINED}' then "
        f"cast(coalesce(list_sum(list_transform({texts}[:i - 1], lambda y: length(y))), 0) + {_HEAD} as bigint)::varchar || '-' || "
        f"cast(list_sum(list_transform({texts}[:i], lambda y: length(y))) - 1 as bigint)::varchar end), lambda z: z is not null), ',')"
    )
    return text, f"coalesce({spans}, '')"


_PROMPT, _ = _sql_side("p")
_CHOSEN, _CHOSEN_SPANS = _sql_side("a")
_REJECTED, _REJECTED_SPANS = _sql_side("b")
SQL = f"""
with turns as (
    select distinct cast(floor(conv_id / 2) as bigint) pair_id, conv_id % 2 = 0 chosen, turn, role, text
    from conversations where conv_id is not null
),
sides as (
    select pair_id,
        coalesce(list({{'role': role, 'text': text}} order by turn nulls first, role nulls first, text nulls first) filter (chosen), []) a,
        coalesce(list({{'role': role, 'text': text}} order by turn nulls first, role nulls first, text nulls first) filter (not chosen), []) b
    from turns group by 1
),
shared as (
    select pair_id, a, b, coalesce(list_min(list_filter(list_transform(range(1, least(len(a), len(b)) + 1), lambda i:
        case when a[i] is distinct from b[i] then i - 1 end), lambda z: z is not null)), least(len(a), len(b))) n
    from sides
),
parts as (select pair_id, n, a[:n] p, a[n + 1:] a, b[n + 1:] b from shared),
done as (
    select pair_id, n n_shared, {_PROMPT} prompt, {_CHOSEN} chosen, {_REJECTED} rejected,
        {_CHOSEN_SPANS} chosen_spans, {_REJECTED_SPANS} rejected_spans
    from parts
)
select *, chosen_spans <> '' and rejected_spans <> '' usable from done
"""
