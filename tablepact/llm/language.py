"""Language identification by compression against per-language dictionaries.

A text is encoded with zstandard once per language, with raw text of that language
as the dictionary; the language that gives the fewest bytes is the prediction. The
margin is the share of bytes the winner saves against the runner-up.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from tablepact.llm.batches import append_columns, text_bytes, without

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageOptions:
    #: Bound of the training sample: excerpts taken per language, and their characters.
    sample_rows: int = 160
    excerpt_chars: int = 1000
    #: Size of a language's dictionary.
    dictionary_bytes: int = 128 << 10
    #: Texts are encoded in blocks, each by itself, so that a long text's own past
    #: doesn't take the dictionary's place.
    block_bytes: int = 1024
    level: int = 5
    #: Texts whose first margin is below ``recheck`` are encoded again, harder.
    recheck: float = 0.02
    recheck_level: int = 19
    #: A margin below this one is too narrow: the document is rejected.
    min_margin: float = 0.002
    #: Languages there may be; more is an error, as each dictionary goes to every task.
    max_languages: int = 400


def letters(text: bytes) -> bytes:
    """ASCII letters in lower case and all other characters beyond ASCII, in words."""
    return b" ".join(text.translate(_LETTERS).split())


_LETTERS = bytes(
    c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in bytes(range(256)).lower()
)


def training_row(doc_id: Column) -> Column:
    """Rows to learn from; a null id counts as the empty text, which is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0


def fit_dictionaries(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    options: LanguageOptions = LanguageOptions(),
) -> dict[str, bytes]:
    """A raw-content dictionary for each language among the labelled rows, the commonest first.

    The sample is bounded by ``options.sample_rows`` excerpts a language and is
    chosen by a hash of the key, so it doesn't depend on the order of rows. Rows
    without text or language teach nothing; no rows give no dictionaries.
    """
    known = labelled.select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().limit(options.max_languages + 1).collect()
    if len(counts) > options.max_languages:
        raise ValueError(f"more than {options.max_languages} languages")
    if not counts:
        return {}
    # a quarter more than wanted, as chance may leave a sample short
    rates = F.create_map(
        *[F.lit(x) for r in counts for x in (r["lang"], 1.25 * options.sample_rows / r["count"])]
    )
    place = F.xxhash64("key", F.lit("language sample"))
    draw = F.pmod(place, F.lit(1 << 30)) / F.lit(1 << 30)
    room = F.greatest(F.length("text") - options.excerpt_chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("key", F.lit("excerpt")), room.cast("long")).cast("int") + 1
    rows = (
        known.filter(draw < F.element_at(rates, F.col("lang")))
        .select("lang", place.alias("place"), F.substring("text", start, F.lit(options.excerpt_chars)).alias("part"))
        .collect()
    )
    parts: dict[str, list[bytes]] = {r["lang"]: [] for r in counts}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"], r["part"])):
        if len(parts[row["lang"]]) < options.sample_rows:
            parts[row["lang"]].append(letters(row["part"].encode()))
    often = sorted(counts, key=lambda r: (-r["count"], r["lang"]))
    return {r["lang"]: b" ".join(parts[r["lang"]])[: options.dictionary_bytes] for r in often}


def identify_language(
    docs: DataFrame,
    dictionaries: Mapping[str, bytes],
    text: str = "text",
    prefix: str = "",
    options: LanguageOptions = LanguageOptions(),
) -> DataFrame:
    """``docs`` with lang_pred, score (the margin, 0 to 1) and rejected.

    A null text, or one without a letter, is ``und`` with score 0, and so is every
    text if no language is known; all of these are rejected, like margins below
    ``options.min_margin``. Equal sizes go to the language that comes first. Input
    columns with the new names are replaced (``prefix`` makes other names); repeated
    rows get equal results.
    """
    fields = [
        StructField(f"{prefix}lang_pred", StringType()),
        StructField(f"{prefix}score", DoubleType()),
        StructField(f"{prefix}rejected", BooleanType()),
    ]
    shared = docs.sparkSession.sparkContext.broadcast(dict(dictionaries))  # bounded, see options

    def make():
        import zstandard

        def encoders(level: int) -> list:
            made = []
            for content in shared.value.values():
                prior = zstandard.ZstdCompressionDict(
                    content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                prior.precompute_compress(level=level)
                made.append(
                    zstandard.ZstdCompressor(
                        level=level,
                        dict_data=prior,
                        write_content_size=False,
                        write_checksum=False,
                        write_dict_id=False,
                    )
                )
            return made

        names, fast, hard = list(shared.value), encoders(options.level), []

        def rank(content: bytes, by: list) -> tuple[str, float]:
            step = options.block_bytes
            blocks = [content[i : i + step] for i in range(0, len(content), step)]
            sizes = sorted(
                (sum(len(e.compress(b)) for b in blocks), i) for i, e in enumerate(by)
            )
            second = sizes[1][0] if len(sizes) > 1 else max(2 * sizes[0][0], 1)
            return names[sizes[0][1]], (second - sizes[0][0]) / second

        def guess(content: bytes, has_letter: bool) -> tuple[str, float, bool]:
            if not names or not has_letter:
                return UNDETERMINED, 0.0, True
            content = b" " + content + b" "
            name, margin = rank(content, fast)
            if margin < options.recheck:
                if not hard:
                    hard.extend(encoders(options.recheck_level))
                name, margin = rank(content, hard)
            return name, margin, margin < options.min_margin

        def work(batch: pa.RecordBatch) -> list[list]:
            out: list[list] = [[], [], []]
            for raw in text_bytes(batch, text):
                content = letters(raw)
                letter = content.isascii() and bool(content) or any(map(str.isalpha, content.decode(errors="replace")))
                for column, value in zip(out, guess(content, letter), strict=True):
                    column.append(value)
            return out

        return work

    return append_columns(docs, text, fields, make)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    learned = fit_dictionaries(docs.filter(training_row(F.col("doc_id"))))
    found = identify_language(docs.select("doc_id", "text"), learned)
    return found.select(
        "doc_id",
        (~training_row(F.col("doc_id"))).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language is not rejected, unchanged."""
    learned = fit_dictionaries(docs.filter(training_row(F.col("doc_id"))))
    judged = identify_language(docs, learned, prefix="_stage_")
    return without(judged.filter(~F.col("_stage_rejected")), ["_stage_lang_pred", "_stage_score", "_stage_rejected"])
