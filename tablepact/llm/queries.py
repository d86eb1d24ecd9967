"""The queries of this package, one for each operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablepact.llm import lines, mixing, negatives, preferences, wumanber
from tablepact.llm.bpe import op11_pieces
from tablepact.llm.contexts import op3_context_tree
from tablepact.llm.language import op7_language_id
from tablepact.llm.licenses import op2_licenses
from tablepact.llm.lines import op4_line_dedup
from tablepact.llm.mixing import op5_mix
from tablepact.llm.negatives import op13_hard_negatives
from tablepact.llm.preferences import op1_preferences
from tablepact.llm.quality import op8_quality
from tablepact.llm.simhash import op6_simhash
from tablepact.llm.suffixes import op10_suffix_dedup
from tablepact.llm.whitening import op12_whitening
from tablepact.llm.wumanber import op9_decontaminate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_preferences,
        op2_licenses,
        op3_context_tree,
        op4_line_dedup,
        op5_mix,
        op6_simhash,
        op7_language_id,
        op8_quality,
        op9_decontaminate,
        op10_suffix_dedup,
        op11_pieces,
        op12_whitening,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op1_preferences": preferences.SQL,
    "op4_line_dedup": lines.SQL,
    "op5_mix": mixing.SQL,
    "op9_decontaminate": wumanber.SQL,
    "op13_hard_negatives": negatives.SQL,
}
