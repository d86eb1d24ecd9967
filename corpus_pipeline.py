"""A training corpus from ``documents``: five stages, each written before the next reads it.

1. language_id: documents without a letter, or with too narrow a margin, go.
2. simhash_dedup: one document of each near-duplicate class stays.
3. suffix_dedup: repeated strings of 100 bytes are cut from texts; texts with nothing
   else go.
4. decontaminate: documents with a benchmark window go.
5. mix: what is left is mixed to the weights of its sources; the result is one row a
   document with the words the mix takes of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablepact.llm.language import keep_known_languages
from tablepact.llm.mixing import mix
from tablepact.llm.shared import shared_folder
from tablepact.llm.simhash import keep_one_document_of_each_class
from tablepact.llm.suffixes import cut_repeats
from tablepact.llm.wumanber import drop_contaminated

STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_dedup", keep_one_document_of_each_class),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
]

#: SQL has no compression, so it can't express the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents of ``sf_dir`` that the stages before keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
