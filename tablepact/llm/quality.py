"""Quality rules and a calibrated classifier on hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepact.llm.batches import append_columns, pieces, text_bytes
from tablepact.llm.rolling import RollingHash, mix


@dataclass(frozen=True)
class QualityOptions:
    #: Bounds of the training sample: labelled documents of each class, and their bytes.
    sample_rows: int = 1500
    sample_bytes: int = 16 << 20
    #: Bits of a feature number; words, word pairs and character n-grams have tables of their own.
    bits: int = 17
    gram_chars: int = 4
    #: Passes of the trainer over the sample, its step, and the penalty on weights.
    steps: int = 150
    rate: float = 0.3
    penalty: float = 1e-4
    #: A document needs this calibrated probability of being good.
    threshold: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


#: Weights are whole multiples of this, so that sums don't depend on how rows are batched.
_UNIT = 2.0**-24

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class _Piece:
    """Texts laid end to end: word bounds, and the features' numbers with their bounds."""

    def __init__(self, texts: list[bytes], options: QualityOptions, roll: RollingHash) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        # a space after each text keeps words and grams of two texts apart
        self.data = data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.end = np.cumsum(sizes + 1) - 1
        self.start = self.end - sizes
        space = _SPACE[data]
        edge = np.diff(np.r_[True, space].astype(np.int8))
        self.word_start = np.flatnonzero(edge == -1)
        self.word_end = np.flatnonzero(edge == 1)
        self.space = space
        self.words = np.searchsorted(self.word_start, np.r_[self.start, len(data)])
        down = np.uint64(64 - options.bits)
        roll.load(data)
        hashes = roll.span(self.word_start, self.word_end)
        self.word = (mix(hashes) >> down).astype(np.int64)
        # pairs are of words, whatever space lies between; a text's last word opens none
        self.pair = (mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) >> down).astype(np.int64)
        self.pair_stop = np.maximum(self.words[1:] - 1, self.words[:-1])
        self.lead = lead = np.flatnonzero((data & 0xC0) != 0x80)
        self.chars = np.searchsorted(lead, np.r_[self.start, len(data)])
        k = options.gram_chars
        gram = roll.span(lead[:-k], lead[k:]) if len(lead) > k else np.zeros(0, np.uint64)
        self.gram = (mix(gram + np.uint64(1)) >> down).astype(np.int64)
        # k characters must end before the space behind the text
        self.gram_stop = np.maximum(self.chars[1:] - k, self.chars[:-1])

    def families(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers, first, stop) of words, word pairs and character n-grams; texts are first to stop."""
        return [
            (self.word, self.words[:-1], self.words[1:]),
            (self.pair, self.words[:-1], self.pair_stop),
            (self.gram, self.chars[:-1], self.gram_stop),
        ]

    def sums(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Sum of whole values between each start and stop."""
        total = np.r_[0, np.cumsum(values, dtype=np.int64)]
        last = len(total) - 1
        return total[np.minimum(stop, last)] - total[np.minimum(start, last)]


def _train(
    good: np.ndarray, index: np.ndarray, value: np.ndarray, row: np.ndarray, options: QualityOptions
) -> np.ndarray:
    """Weights of a logistic regression by Adam; the classes weigh the same. Last: bias."""
    n, size = len(good), 3 << options.bits
    weight, first, second = (np.zeros(size + 1) for _ in range(3))
    share = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    for step in range(1, options.steps + 1):
        score = np.bincount(row, weight[index] * value, n) + weight[-1]
        error = share * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - good)
        slope = np.r_[np.bincount(index, error[row] * value, size), error.sum()]
        slope[:-1] += options.penalty * weight[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        change = options.rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) / (1 + step / 50)
        weight -= change * first / (np.sqrt(second) + 1e-6)
    return weight


def _calibrate(score: np.ndarray, good: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that turns scores into probabilities (Platt), by Newton."""
    slope, shift = 1.0, 0.0
    # a few observations of either kind short of certainty keep the fit finite
    target = np.where(good, 1 - 1 / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * score + shift, -30, 30)))
        g = share * (p - target)
        h = share * p * (1 - p)
        a, b, c = (h * score * score).sum() + 1e-6, (h * score).sum(), h.sum() + 1e-6
        u, v = (g * score).sum(), g.sum()
        det = a * c - b * b + 1e-12
        slope -= np.clip((c * u - b * v) / det, -2, 2)
        shift -= np.clip((a * v - b * u) / det, -5, 5)
    return float(slope), float(shift)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    options: QualityOptions = QualityOptions(),
) -> tuple[np.ndarray, float, float] | None:
    """(fixed-point weights, slope, shift), or None unless both classes have rows.

    The sample is bounded: about ``options.sample_rows`` labelled documents of each
    class, or all if there are fewer, chosen by a hash of the key, and of these the
    first whose texts have ``options.sample_bytes`` together. A text longer than a
    sixteenth of that teaches nothing. Four fifths of the sample train
    the weights, the rest calibrates, weighted to the classes' true shares. Of rows
    of one key that disagree the worst label counts; null keys, labels and texts
    teach nothing; rows repeated in ``docs`` teach each time. Other columns of either
    table may have any name. Training is one task, as the sample has a bound.
    """
    marked = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key")).agg((F.min(label) > 0).alias("good"))
    )
    counts = {r["good"]: r["count"] for r in marked.groupBy("good").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64("_key", F.lit("quality sample")), F.lit(1 << 30)) / F.lit(1 << 30)
    wanted = {kind: 1.1 * options.sample_rows / n for kind, n in counts.items()}
    rate = F.when(F.col("good"), wanted[True]).otherwise(wanted[False])
    chosen = marked.filter(draw < rate)
    # the sample's keys have a bound, so the texts of other documents need not move
    known = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text"))
    known = known.filter(F.octet_length("text") <= options.sample_bytes // 16)
    known = known.join(F.broadcast(chosen.withColumn("draw", draw)), F.expr("_doc = _key"))
    ahead = Window.partitionBy("good").orderBy("draw", "_key", "text").rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumn("held", F.sum(F.octet_length("text").cast("long")).over(ahead))
    sample = known.filter(F.col("held") <= options.sample_bytes).select(
        F.xxhash64("_key", F.lit("fold")).alias("fold"), "good", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, rows, parts = RollingHash(), 0, [[], [], [], [], []]
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                p = _Piece(text_bytes(piece, "text"), options, roll)
                n = piece.num_rows
                codes, totals = [], []
                for family, (numbers, first, stop) in enumerate(p.families()):
                    of = np.repeat(np.arange(n), stop - first)
                    inside = np.arange(len(of)) + np.repeat(first - (np.cumsum(stop - first) - (stop - first)), stop - first)
                    codes.append(of << 20 | numbers[inside] + (family << options.bits))
                    totals.append(np.maximum(stop - first, 1))
                code, count = np.unique(np.concatenate(codes), return_counts=True)
                row, index = code >> 20, code & (1 << 20) - 1
                total = np.stack(totals)[index >> options.bits, row]
                new = (row + rows, index, count / total * 100,
                       piece.column(0).to_numpy(), piece.column(1).to_numpy(zero_copy_only=False))
                for held, values in zip(parts, new, strict=True):
                    held.append(values)
                rows += n
        if not rows:
            return
        row, index, value, fold, good = (np.concatenate(x) for x in parts)
        order = np.lexsort((value, index, fold[row]))  # sums come out alike however rows arrive
        row, index, value = row[order], index[order], value[order]
        train = np.mod(fold, 5) != 0
        if len(set(good[train])) < 2 or len(set(good[~train])) < 2:
            train = np.ones(rows, bool)
        at = np.flatnonzero(train)
        place = np.full(rows, -1)
        place[at] = np.arange(len(at))
        mine = train[row]
        if len(set(good)) < 2:
            return
        weight = _train(good[at], index[mine], value[mine], place[row[mine]], options)
        fixed = np.round(np.r_[weight[:-1] * 100, weight[-1]] / _UNIT).astype(np.int64)
        score = np.bincount(row, weight[index] * value, rows) + weight[-1]
        rest = ~train if (~train).any() else train
        part = np.where(good[rest], counts[True] / good[rest].sum(), counts[False] / (~good[rest]).sum())
        slope, shift = _calibrate(score[rest], good[rest], part / part.sum() * rest.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([fixed.tobytes()]), pa.array([slope]), pa.array([shift])], names=["weights", "slope", "shift"]
        )

    fitted = sample.repartition(1).mapInArrow(run, "weights binary, slope double, shift double").first()
    return (np.frombuffer(fitted[0], np.int64), fitted[1], fitted[2]) if fitted else None


def score_quality(
    docs: DataFrame,
    model: tuple[np.ndarray, float, float] | None,
    text: str = "text",
    options: QualityOptions = QualityOptions(),
) -> DataFrame:
    """``docs`` with the rules' counts, base_failed, probability and kept.

    Words are what ASCII white space separates. word_chars counts their characters;
    n_symbols those of ``#*$%&|<>`` in the text; n_dup_lines lines with a word that
    equal an earlier line; n_repeat_words words in 3-word windows found twice or
    more. base_failed: too few words or too many repeated ones. probability is the
    model's that the document is good, 1 without a model; kept asks for it to reach
    the threshold and for base_failed to be false. Null and empty texts have no
    words and fail. A very long text is scored whole, equal texts alike; a
    probability that equals the threshold is kept; no rows give none. Input columns
    with the new names are replaced.
    """
    fields = StructType.fromDDL(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, probability double, kept boolean"
    ).fields
    shared = docs.sparkSession.sparkContext.broadcast(model)  # three tables of 2**bits numbers

    def make():
        roll, fitted = RollingHash(), shared.value

        def probability(p: _Piece, n_words: np.ndarray) -> np.ndarray:
            if fitted is None:
                return np.ones(len(n_words))
            weights, slope, shift = fitted
            score = np.full(len(n_words), weights[-1], float)
            for family, (numbers, first, stop) in enumerate(p.families()):
                score += p.sums(weights[numbers + (family << options.bits)], first, stop) / np.maximum(stop - first, 1)
            score *= _UNIT
            return 1 / (1 + np.exp(-np.clip(slope * score + shift, -30, 30)))

        def work(batch: pa.RecordBatch) -> list[list]:
            texts = text_bytes(batch, text)
            p = _Piece(texts, options, roll)
            n_words = np.diff(p.words)
            lead = (p.data & 0xC0) != 0x80
            chars = p.sums(lead & ~p.space, p.start, p.end)
            symbols = p.sums(_SYMBOL[p.data], p.start, p.end)
            lines = np.array([_dup_lines(t) for t in texts], np.int64)
            repeats = np.array([_repeat_words(t.split()) for t in texts], np.int64)
            failed = (n_words < options.min_words) | (100 * repeats > options.max_repeat_percent * n_words)
            good = probability(p, n_words)
            return [n_words, chars, symbols, lines, repeats, failed, good, ~failed & (good >= options.threshold)]

        return work

    return append_columns(docs, text, fields, make)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _repeat_words(words: list[bytes]) -> int:
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pair = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 1 << 21:  # else a window's number would not fit
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(numbers) + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    again = order[np.r_[False, same] | np.r_[same, False]]
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[again + k] = True
    return int(hit.sum())


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).drop("text")
